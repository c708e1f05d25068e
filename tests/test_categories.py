from __future__ import annotations

import random

from pyspark.ml.feature import StringIndexer

from meterline.ml.categories import category_ranks, with_positions


def table(spark, n=3000):
    rng = random.Random(4)
    return spark.createDataFrame([(i, rng.choice([None, "é", "", "Z", *[f"c{rng.randrange(1 << rng.randrange(9))}" for _ in range(8)]])) for i in range(n)], "id long, c string")


def test_positions_are_those_of_the_indexer(spark):
    df = table(spark)
    model = StringIndexer(inputCol="c", outputCol="position", handleInvalid="keep", stringOrderType="frequencyDesc").fit(df)
    ranks = category_ranks(df.repartition(7), "c")
    assert [r.category for r in ranks.orderBy("position").collect()] == list(model.labels)
    assert [r.position for r in ranks.orderBy("position").collect()] == list(range(len(model.labels)))
    new = table(spark, 50).unionAll(spark.createDataFrame([(99, "never seen")], "id long, c string"))
    want = sorted((r.id, r.position) for r in model.transform(new).collect())
    assert sorted((r.id, r.position) for r in with_positions(new, "c", ranks, "position").collect()) == want


def test_a_hashed_tail(spark):
    df = table(spark)
    ranks = category_ranks(df, "c")
    found = with_positions(df, "c", ranks, "position", head=10, tail=4)
    places = {r.c: r.position for r in found.collect()}
    own = {r.category: r.position for r in ranks.collect()}
    assert all(places[c] == p if p < 10 else 10 <= places[c] < 14 for c, p in own.items()) and places[None] == 14
    assert found.columns == ["id", "c", "position"] and found.count() == df.count()


def test_no_rows_and_numbers(spark):
    none = table(spark).limit(0)
    assert category_ranks(none, "c").count() == 0 and with_positions(none, "c", category_ranks(none, "c"), "p").count() == 0
    assert [tuple(r) for r in category_ranks(spark.range(1), "id").collect()] == [("0", 1, 0)]
