import time

import pytest
from pyspark.sql import functions as F

from packwright.operators import rank


def test_lookups_of_both_levels_are_compiled(spark, monkeypatch):
    # A lambda is interpreted, and the boundaries are then copied for each row of their join.
    monkeypatch.setattr(rank, "MAX_RANGES", 5)
    monkeypatch.setattr(rank, "SENT_BOUNDARIES", 0)
    df = spark.range(3000).selectExpr("id % 97 as a", "id as b")
    ranked = rank.global_rank(df, ["a", "b"], "place", rows_per_range=15)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "__bounds" in plan
    assert "lambda" not in plan


@pytest.mark.parametrize("coarse", [1, 2])
def test_rows_of_a_coarse_range_do_not_copy_its_fine_bounds(spark, monkeypatch, coarse):
    # 100,000 rows of few coarse ranges, each looked up in tens of thousands of boundaries.
    monkeypatch.setattr(rank, "MAX_RANGES", coarse)
    monkeypatch.setattr(rank, "SENT_BOUNDARIES", 0)
    rows = 100_000
    df = spark.range(rows).selectExpr("id % 997 as a", "id as b").repartition(4)
    start = time.monotonic()
    places = rank.global_rank(df, ["a", "b"], "place", rows_per_range=2).collect()
    elapsed = time.monotonic() - start
    order = sorted(range(rows), key=lambda b: (b % 997, b))
    assert {r["b"]: r["place"] for r in places} == {b: place for place, b in enumerate(order)}
    assert elapsed < 30


def test_fine_ranges_of_weights_and_repeated_keys(spark, monkeypatch):
    monkeypatch.setattr(rank, "MAX_RANGES", 3)
    # Two thirds of the rows share a key, so that most boundaries are equal and most ranges empty.
    rows = [(0 if i % 3 else i, i) for i in range(1500)]
    df = spark.createDataFrame(rows, "k int, i int").repartition(3)
    for sent in (0, 10_000):
        monkeypatch.setattr(rank, "SENT_BOUNDARIES", sent)
        places = rank.global_rank(df, ["k"], "place", rows_per_range=4).collect()
        assert sorted(r["place"] for r in places) == list(range(1500))
        assert [r["k"] for r in sorted(places, key=lambda r: r["place"])] == sorted(k for k, _ in rows)
        weighted = df.withColumn("w", (F.col("i") % 5).cast("bigint"))
        found = rank._ranked(weighted, ["k", "i"], "before", "w", rows_per_range=4).collect()
        before, expected = 0, {}
        for _, i in sorted(rows):
            expected[i] = before
            before += i % 5
        assert {r["i"]: r["before"] for r in found} == expected


def test_order_columns_may_have_any_name(spark, monkeypatch):
    monkeypatch.setattr(rank, "SMALL_ROWS", 50)
    df = spark.range(2000).select(((F.col("id") * 7919) % 2000).alias("__key"))
    assert {r["__key"]: r["rank"] for r in rank.global_rank(df, ["__key"]).collect()} == {i: i for i in range(2000)}
    assert rank.value_at(df, ["__key"], 777, 2000) == ["777"]
