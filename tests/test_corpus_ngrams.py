"""N-grams of a corpus: counts against brute force, and a plan that adds nothing up before the shuffle."""

import collections
import re

import pytest

from sparkstats.operators import documents as dc

TEXTS = [None, "", " ", "a b c", "Aa bb cc", "aa bb", "aa", "aa bb cc dd", "aa bb cc dd", "x aa y bb z", "of the of the of the", "aa", "Été été  été_1\tσς"] + [
    f"of the w{i} of the w{i % 7}" for i in range(300)]  # one head with a third of all n-grams


def brute(low, high, lower):
    out = collections.Counter()
    for t in TEXTS:
        words = [w for w in re.findall(r"\w+", (t or "").lower() if lower else t or "") if len(w) > 1]
        for n in range(low, high + 1):
            out.update(" ".join(words[i:i + n]) for i in range(len(words) - n + 1))
    return dict(out)


@pytest.mark.parametrize("low,high,lower", [(1, 3, True), (1, 3, False), (2, 3, True), (1, 2, True), (2, 4, True), (3, 3, True), (1, 1, True)])
def test_counts_are_those_of_brute_force(spark, monkeypatch, low, high, lower):
    monkeypatch.setattr(dc, "NGRAM_BYTES", 1000, raising=False)  # several tasks
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string").repartition(3)
    rows = dc.corpus_word_ngrams(df, "t", low, high, lower).collect()
    assert {r["ngram"]: r["cnt"] for r in rows} == brute(low, high, lower)
    assert len(rows) == len(brute(low, high, lower))


@pytest.mark.parametrize("texts", [[], [None], ["", "a"]])
def test_texts_without_words_give_no_rows(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert dc.corpus_word_ngrams(df, "t").collect() == []


def test_a_task_that_cuts_texts_adds_up_nothing_for_the_shuffle(spark, monkeypatch):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")

    def plan(task_bytes):
        monkeypatch.setattr(dc, "NGRAM_BYTES", task_bytes, raising=False)
        return dc.corpus_word_ngrams(df, "t")._jdf.queryExecution().executedPlan().toString()
    above, below = plan(1000).split("Exchange", 1)
    assert "HashAggregate" in above and "Exchange" not in below  # one shuffle, by the head
    assert "Aggregate" not in below and "MapInArrow" in below
    few, many = [int(re.search(r"Exchange hashpartitioning\(.*, (\d+)\)", plan(b)).group(1)) for b in (1000, 100)]
    assert many > 5 * few > 5  # tasks grow with the text
