"""The text network's rows are dealt by the size they have as full rows of numbers."""

from sparkstats.operators import ensembles


def test_tasks_of_the_text_network_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(ensembles, "TASK_BYTES", 64 * 8 * 50)
    df = spark.range(2000).coalesce(1).selectExpr("if(id % 2 = 0, 'one two three', 'four five') as text", "cast(id % 2 as double) as label")
    dealt = ensembles.spread(df, 64)
    sizes = dealt.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert len(sizes) == 40 and sum(sizes) == 2000 and max(sizes) <= 60
    model = ensembles.fit_text_mlp(df, width=64, hidden=(3,), max_iter=20)
    assert model.transform(df).where("prediction <> label").count() == 0
