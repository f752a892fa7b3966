import random
import time

import pytest
from pyspark.sql import functions as F

from packwright.operators import rank


@pytest.fixture
def small_steps(monkeypatch):
    """Make the refinement loops run on small tables."""
    monkeypatch.setattr(rank, "SMALL_ROWS", 50)
    monkeypatch.setattr(rank, "ROWS_PER_RANGE", 200)


def shuffled(spark, rows, schema, partitions, seed=1):
    rows = list(rows)
    random.Random(seed).shuffle(rows)
    return spark.createDataFrame(rows, schema).repartition(partitions)


def test_global_rank_is_exact(spark, small_steps):
    rows = [(i, (i * 37) % 101 / 4, f"k{i:05d}") for i in range(3000)]
    expected = {r[0]: n for n, r in enumerate(sorted(rows, key=lambda r: (r[1], r[2])))}
    for partitions in (1, 7):
        df = shuffled(spark, rows, "i int, v double, k string", partitions, partitions)
        found = rank.global_rank(df, ["v", "k"])
        assert {r.i: r["rank"] for r in found.collect()} == expected


def test_global_rank_of_hot_keys_and_copies(spark, small_steps):
    rows = [("hot", 1)] * 1000 + [("hot", 2)] * 500 + [(f"k{i}", i % 3) for i in range(700)]
    df = shuffled(spark, rows, "k string, v int", 5)
    found = rank.global_rank(df, ["k"], unique=False).collect()
    assert sorted(r["rank"] for r in found) == list(range(len(rows)))
    by_rank = [(r.k, r.v) for r in sorted(found, key=lambda r: r["rank"])]
    assert [k for k, _ in by_rank] == sorted(k for k, _ in rows)
    assert sorted(by_rank) == sorted(rows)


def test_copies_are_cut_into_chunks(spark):
    df = spark.createDataFrame([("a", 0, 25), ("b", 25, 3)], "k string, r bigint, __copies bigint")
    found = rank._expand_copies(df, "r", chunk=10).select("k", "r").collect()
    assert sorted((r.r, r.k) for r in found) == [(i, "a" if i < 25 else "b") for i in range(28)]


def test_nulls_sort_first_and_empty_tables_work(spark):
    df = spark.createDataFrame([(3,), (None,), (1,)], "v int")
    ranked = {r.v: r["rank"] for r in rank.global_rank(df, ["v"]).collect()}
    assert ranked == {None: 0, 1: 1, 3: 2}
    assert rank.global_rank(df.filter("false"), ["v"]).count() == 0


def test_with_id_comes_first(spark):
    df = spark.createDataFrame([("b",), ("a",)], "k string")
    found = rank.with_id(df, ["k"])
    assert found.columns == ["Id", "k"]
    assert sorted(tuple(r) for r in found.collect()) == [(0, "a"), (1, "b")]


@pytest.mark.parametrize("kind", ["int", "double", "string", "date", "timestamp_ntz"])
def test_value_at_for_each_type(spark, small_steps, kind):
    base = spark.range(2000).select(((F.col("id") * 7919) % 1999).alias("n"))
    value = {
        "int": F.col("n").cast("int"),
        "double": F.col("n") / 8,
        "string": F.format_string("p%05d", "n"),
        "date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("n").cast("int")),
        "timestamp_ntz": F.timestamp_micros(F.col("n") * 1234567).cast("timestamp_ntz"),
    }[kind]
    df = base.select(value.alias("v")).repartition(3)
    expected = [r.v for r in df.orderBy("v").select(F.col("v").cast("string").alias("v")).collect()]
    for position in (0, 3, 777, 1999):
        assert rank.value_at(df, ["v"], position, 2000) == [expected[position]]


def test_value_at_inside_a_hot_value(spark, small_steps):
    df = spark.createDataFrame([(5,)] * 900 + [(i,) for i in range(100)], "v int").repartition(4)
    for position, expected in ((0, "0"), (3, "3"), (5, "5"), (500, "5"), (910, "10"), (999, "99")):
        assert rank.value_at(df, ["v"], position, 1000) == [expected]


@pytest.mark.parametrize("limit", [10, 10_000])
def test_group_rank_with_a_large_group(spark, monkeypatch, limit):
    monkeypatch.setattr(rank, "SMALL_ROWS", limit)
    monkeypatch.setattr(rank, "ROWS_PER_RANGE", 100)
    rows = [("hot", i) for i in range(900)] + [(f"g{i % 40}", i) for i in range(300)]
    df = shuffled(spark, rows, "g string, i int", 5)
    expected, seen = {}, {}
    for g, i in sorted(rows):
        expected[g, i] = seen.get(g, 0)
        seen[g] = seen.get(g, 0) + 1
    found = rank.group_rank(df, ["g"], ["i"]).collect()
    assert {(r.g, r.i): r.ordinal for r in found} == expected


def test_row_keys_are_unique_and_stable(spark):
    rows = [(1, "a")] * 5 + [(2, None), (None, "b")]
    first = shuffled(spark, rows, "x int, y string", 3, 1)
    second = shuffled(spark, rows, "x int, y string", 1, 2)
    keys = [sorted((r.row_key, str(r.x), str(r.y)) for r in rank.row_keys(d).collect()) for d in (first, second)]
    assert keys[0] == keys[1]
    assert len({k for k, _, _ in keys[0]}) == len(rows)


def test_no_table_is_sorted_in_one_task(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    plan = rank.global_rank(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_null_is_a_group(spark, monkeypatch):
    rows = [(None if i % 3 == 0 else i % 3, i) for i in range(30)]
    df = spark.createDataFrame(rows, "g int, o int")
    found = {r.o: r.ordinal for r in rank.group_rank(df, ["g"], ["o"]).collect()}
    assert found == {i: i // 3 for i in range(30)}


def test_keys_of_rows_that_differ_in_microseconds(spark):
    df = spark.sql("select timestamp_micros(1000000 + id) as t from range(20)")
    assert rank.row_keys(df).select("row_key").distinct().count() == 20


@pytest.mark.parametrize("sent", [0, 10_000])
def test_two_levels_of_ranges(spark, monkeypatch, sent):
    monkeypatch.setattr(rank, "MAX_RANGES", 5)
    monkeypatch.setattr(rank, "SENT_BOUNDARIES", sent)
    rows = [(i * 7919 % 2003, None if i % 11 == 0 else f"k{i % 90}") for i in range(2003)]
    df = spark.createDataFrame(rows, "i int, s string").repartition(3)
    found = {r["i"]: r["place"] for r in rank.global_rank(df, ["s", "i"], "place", rows_per_range=15).collect()}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", r[0]))
    assert found == {r[0]: place for place, r in enumerate(order)}
    repeated = df.selectExpr("s", "i % 4 as j")
    places = rank.global_rank(repeated, ["s"], "place", unique=False, rows_per_range=15).collect()
    assert sorted(r["place"] for r in places) == list(range(2003))
    by_place = [r["s"] for r in sorted(places, key=lambda r: r["place"])]
    assert by_place == [r[1] for r in order]
    empty = rank.global_rank(df.limit(0), ["s", "i"], "place", rows_per_range=15)
    assert empty.count() == 0


def test_fine_bounds_of_a_large_coarse_range_in_linear_time(spark, monkeypatch):
    # One coarse range of 60,000 keys; distinct struct keys by array_distinct took minutes.
    monkeypatch.setattr(rank, "MAX_RANGES", 1)
    df = spark.range(60_000).selectExpr("id % 997 as a", "id as b").repartition(4)
    start = time.monotonic()
    places = rank.global_rank(df, ["a", "b"], "place", rows_per_range=2).collect()
    elapsed = time.monotonic() - start
    order = sorted(range(60_000), key=lambda b: (b % 997, b))
    assert {r["b"]: r["place"] for r in places} == {b: place for place, b in enumerate(order)}
    assert elapsed < 30
