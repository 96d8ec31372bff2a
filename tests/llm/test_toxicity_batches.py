"""Votes, scores and training rows of a batch of texts against one text, word and spelling at a time."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from sparkstats.llm import toxicity

TEXTS = ["", None, " \t", "!!! ...", "Toxic, toxic. TOXIC toxics!", "straße STRASSE Äöü äÖÜ", "you are (here) #$%", "été étés ÉTÉS", "日本語日本語 a\x00b a\x00b",
         "SHOUTING WORDS HERE", "toxi toxic toxical", "no repeat no repeat", "wow!!"] * 2


def words(text):
    """The distinct words of a text in order; A-Z count as a-z, what stands at a word's edges does not set words apart later."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w.strip(toxicity.EDGES).lower() for w in dict.fromkeys(lower.split())]


def forms(word):
    return [b"=" + word.encode(), *[b"^" + word[:n].encode() for n in (4, 5, 6) if len(word) > n]] if word else []


ALL = sorted({f for t in TEXTS for w in words(t) for f in forms(w)})


@pytest.mark.parametrize("texts", [TEXTS, TEXTS[3:9], TEXTS[:1], TEXTS[1:4], []])
def test_a_batch_is_what_its_texts_are(texts):
    lexicon = {f: i % toxicity.LEXICONS for i, f in enumerate(ALL[::3])}
    weights = {zlib.crc32(f): 0.1 * (i % 7) - 0.3 for i, f in enumerate(ALL) if i % 4} | {zlib.crc32(b"="): 9.0}
    batch = toxicity.Batch(pa.array(["x", *texts, "y"], pa.string()).slice(1, len(texts)))
    votes, scores, sparse = batch.votes(lexicon), batch.scores(weights), batch.sparse()
    assert len(votes) == len(scores) == len(sparse) == len(texts)
    for text, vote, score, (hashes, values) in zip(texts, votes.tolist(), scores, sparse):
        found, raw = words(text), (text or "").encode()
        assert {v for v in range(toxicity.LEXICONS) if vote >> v & 1} == {lexicon[f] for w in found for f in forms(w) if f in lexicon}
        share = lambda some: sum(b in some for b in raw) / max(1, len(raw))
        shape = [share(range(65, 91)) > 0.3, share(b"!") > 0.01, share(b"#*$%&@") > 0.02, any(w.encode() in toxicity.ADDRESS for w in found)]
        assert [bool(vote >> toxicity.LEXICONS + i & 1) for i in range(4)] == shape
        scale = 1 / max(1, len(found)) ** toxicity.POWER
        assert score == pytest.approx(sum(weights.get(zlib.crc32(f), 0.0) for w in found for f in forms(w)) * scale)
        counted = {}
        for w in found:
            for f in forms(w):
                counted[zlib.crc32(f)] = counted.get(zlib.crc32(f), 0) + 1
        assert dict(zip(hashes.tolist(), values.tolist())) == pytest.approx({h: n * scale for h, n in counted.items()})
        assert hashes.tolist() == sorted(counted)


def test_lexicons_count_texts(monkeypatch):
    monkeypatch.setattr(toxicity, "SEEN", 2)
    toxic = np.array([int("toxi" in (t or "").lower()) for t in TEXTS])
    parts = [pa.array(TEXTS[:7]), pa.array(TEXTS[7:])]
    found = toxicity.lexicons(parts, toxic)
    has = lambda f, v: sum(f in {f for w in words(t) for f in forms(w)} for t, y in zip(TEXTS, toxic) if y == v)
    n = [int((toxic == v).sum()) for v in (0, 1)]
    lift = {f: has(f, 1) / n[1] / ((has(f, 0) + 0.5) / n[0]) for f in ALL if has(f, 1) >= 2}
    best = sorted((f for f in lift if lift[f] >= toxicity.LIFT), key=lambda f: (-has(f, 1) * np.log(lift[f]), f))
    assert list(found.items()) == [(f, i % toxicity.LEXICONS) for i, f in enumerate(best)] and len(found) > 3


def test_a_spelling_that_many_words_share_is_looked_up_once(monkeypatch):
    spelled = []

    class Counted:
        @staticmethod
        def crc32(data, start=0):
            spelled.append(data)
            return zlib.crc32(data, start)
    monkeypatch.setattr(toxicity, "zlib", Counted)
    toxicity.Batch(pa.array([" ".join(f"common{i}" for i in range(1000))])).scores({})
    assert len(spelled) < 1100  # 1000 words and their three beginnings, not three beginnings of each word
