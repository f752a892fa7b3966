import hashlib
import random

import pytest
from pyspark.sql import functions as F

from packwright.operators import rank, split


def side_of(found, key):
    return {r[key]: r.split for r in found.collect()}


def expected_random(keys, seed=42):
    ordered = sorted(keys, key=lambda k: hashlib.md5(f"{seed}:{k}".encode()).hexdigest())
    test = set(ordered[: (len(keys) + 4) // 5])
    return {k: "test" if k in test else "train" for k in keys}


@pytest.fixture
def small_steps(monkeypatch):
    monkeypatch.setattr(split, "SMALL_ROWS", 3)
    monkeypatch.setattr(split, "PREFIX", 1)
    monkeypatch.setattr(rank, "SMALL_ROWS", 20)
    monkeypatch.setattr(rank, "ROWS_PER_RANGE", 50)


@pytest.mark.parametrize("rows", [0, 1, 2, 4, 5, 6, 99, 1000])
def test_random_split_sizes_and_members(spark, small_steps, rows):
    df = spark.createDataFrame([(i,) for i in range(rows)], "k int")
    assert side_of(split.random_split(df, "k"), "k") == expected_random(range(rows))


def test_random_split_does_not_depend_on_partitions_or_order(spark):
    keys = [f"k{i}" for i in range(500)]
    results = []
    for seed, partitions in ((1, 1), (2, 7), (3, 3)):
        rows = [(k,) for k in keys]
        random.Random(seed).shuffle(rows)
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        df = spark.createDataFrame(rows, "k string").repartition(partitions)
        results.append(side_of(split.random_split(df, "k"), "k"))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1] == results[2] == expected_random(keys)


def test_random_split_of_other_seed_differs(spark):
    df = spark.range(200)
    assert side_of(split.random_split(df, "id", 7), "id") == expected_random(range(200), 7)


def test_repeated_keys_stay_together(spark, small_steps):
    df = spark.createDataFrame([(i % 10 if i % 2 else 3, i) for i in range(400)], "k int, v int")
    found = split.random_split(df, "k").groupBy("k").agg(F.count_distinct("split").alias("n"))
    assert {r.n for r in found.collect()} == {1}


def test_dimension_split_counts_values_not_rows(spark, small_steps):
    df = spark.createDataFrame([(i if i < 50 else 7,) for i in range(500)], "d int")
    found = split.dimension_split(df, "d")
    assert side_of(found.distinct(), "d") == expected_random(range(50))
    assert found.count() == 500


def test_random_row_split_without_a_key(spark):
    rows = [(1, "hot")] * 400 + [(i, "x") for i in range(103)]
    df = spark.createDataFrame(rows, "a int, b string")
    found = split.random_row_split(df).collect()
    assert sorted((r.a, r.b) for r in found) == sorted(rows)
    assert sum(r.split == "test" for r in found) == (len(rows) + 4) // 5
    hot = [r.split for r in found if r.b == "hot"]
    assert 0.1 < hot.count("test") / len(hot) < 0.3


def quota_model(counts):
    total = sum(counts.values())
    test = (total + 4) // 5
    quota = {k: n * test // total for k, n in counts.items()}
    rest = sorted(counts, key=lambda k: (-(counts[k] * test % total), k))
    for label in rest[: test - sum(quota.values())]:
        quota[label] += 1
    return quota


@pytest.mark.parametrize(
    "counts",
    [{"a": 46, "b": 262, "c": 39, "d": 52}, {"a": 2, "b": 2, "c": 2, "d": 4}, {"x": 300, "y": 3, "z": 7}, {"only": 11}],
)
def test_stratified_split(spark, monkeypatch, counts):
    monkeypatch.setattr(split, "PREFIX", 1)
    rows = [(f"{k}{i}", k) for k, n in counts.items() for i in range(n)]
    df = spark.createDataFrame(rows, "k string, label string")
    if len(counts) > (len(rows) + 4) // 5:
        with pytest.raises(ValueError):
            split.stratified_split(df, "k", "label")
        return
    found = split.stratified_split(df, "k", "label").collect()
    assert len(found) == len(rows)
    quota = quota_model(counts)
    for label, n in counts.items():
        members = sorted((hashlib.md5(f"42:{label}{i}".encode()).hexdigest(), f"{label}{i}") for i in range(n))
        test = {k for _, k in members[: quota[label]]}
        assert {r.k for r in found if r.label == label and r.split == "test"} == test


def test_known_allocation(spark):
    counts = {"a": 46, "b": 262, "c": 39, "d": 52}
    df = spark.createDataFrame(list(counts.items()), "label string, rows bigint")
    found = {r.label: r.quota for r in split.label_quotas(df, "label").collect()}
    assert found == {"a": 9, "b": 53, "c": 8, "d": 10}


@pytest.mark.parametrize("rows", [[("a", "x"), ("b", "y"), ("c", "y")], [("a", None), ("b", "y"), ("c", "y")]])
def test_tables_that_cannot_be_stratified(spark, rows):
    df = spark.createDataFrame(rows, "k string, label string")
    with pytest.raises(ValueError):
        split.stratified_split(df, "k", "label")


@pytest.mark.parametrize("rows", [0, 1, 4, 5, 9, 10, 333])
def test_ordered_split(spark, small_steps, rows):
    paths = [f"d/{i * 7919 % 1000:04d}" for i in range(rows)]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    found = side_of(split.ordered_split(df, ["path"]), "path")
    cut = int(0.8 * rows)
    assert found == {p: "train" if i < cut else "test" for i, p in enumerate(sorted(paths))}


def test_ordered_split_by_two_columns(spark, small_steps):
    rows = [(i % 3, i) for i in range(200)]
    df = spark.createDataFrame(rows, "a int, b int")
    found = {(r.a, r.b): r.split for r in split.ordered_split(df, ["a", "b"]).collect()}
    assert found == {r: "train" if n < 160 else "test" for n, r in enumerate(sorted(rows))}


def test_ordered_split_within_groups(spark):
    rows = [(f"d{i % 3}", f"p{i:04d}") for i in range(100)]
    df = spark.createDataFrame(rows, "dataset string, path string")
    found = {r.path: r.split for r in split.ordered_split_within(df, "dataset", ["path"]).collect()}
    for g in range(3):
        mine = sorted(p for d, p in rows if d == f"d{g}")
        assert [found[p] for p in mine] == ["train" if i < len(mine) * 4 // 5 else "test" for i in range(len(mine))]


def test_time_split_counts_steps(spark, small_steps):
    rows = [(i % 90 if i < 900 else 5,) for i in range(1200)]
    df = spark.createDataFrame(rows, "n int").select(F.timestamp_seconds("n").cast("timestamp_ntz").alias("ts"), "n")
    with_null = df.unionByName(spark.createDataFrame([(None, -1)], df.schema))
    found = side_of(split.time_split(with_null, "ts"), "n")
    assert found == {n: "train" if n < int(90 * 0.8) else "test" for n in range(-1, 90)}
    train, test = split.time_sides(with_null, "ts")
    assert train.count() + test.count() == 1201
    assert {r.n for r in test.collect()} == set(range(72, 90))


def test_time_split_needs_two_steps(spark):
    df = spark.createDataFrame([(1,), (1,)], "ts int")
    with pytest.raises(ValueError):
        split.time_split(df, "ts")


def test_time_sides_reach_the_scan(spark, tmp_path):
    spark.range(100).select(F.timestamp_seconds("id").alias("ts")).write.parquet(f"{tmp_path}/t")
    _, test = split.time_sides(spark.read.parquet(f"{tmp_path}/t"), "ts")
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan


def test_splits_are_narrow_passes(spark):
    df = spark.range(1000)
    for parts in (split.random_split(df, "id"), split.ordered_split(df, ["id"])):
        assert "Exchange" not in parts._jdf.queryExecution().executedPlan().toString()


def test_strategy_order(spark):
    cases = [
        (False, True, ".csv", 99, "skip"),
        (True, True, ".csv", 99, "copy_presplit"),
        (True, False, "unknown", 0, "none"),
        (True, False, ".json", 51, "ordered_files"),
        (True, False, ".csv", 50, "merge_random"),
        (True, False, ".tsv", 1, "merge_random"),
        (True, False, ".nc", 50, "time_or_dimension"),
        (True, False, ".png", 50, "stratified_images"),
        (True, False, ".json", 50, "none"),
        (None, None, None, None, "skip"),
    ]
    df = spark.createDataFrame(
        [(i, *c) for i, c in enumerate(cases)],
        "i int, has_source boolean, presplit boolean, primary_format string, matching_files int, expected string",
    )
    for row in split.choose_strategy(df).collect():
        assert row.strategy == row.expected, row


def test_audit_and_drift(spark):
    rows = [(1, "a", "train"), (2, "a", "test"), (3, "b", "train"), (1, "b", "test")]
    df = spark.createDataFrame(rows, "k int, label string, split string")
    audit = split.audit_split(df, "k").first()
    assert (audit.n, audit.n_train, audit.n_test, audit.shared_keys) == (4, 2, 2, 1)
    assert {r.label: r.drift for r in split.label_drift(df, "label").collect()} == {"a": 0.0, "b": 0.0}
    empty = split.audit_split(df.filter("false"), "k").first()
    assert (empty.n, empty.test_share, empty.shared_keys) == (0, None, 0)


def test_image_files_are_stratified_by_directory(spark):
    labels = ["cat"] * 12 + ["dog"] * 5 + ["owl"] * 8
    rows = [("a", f"a/{x}/{i}.png", f"{x}/{i}.png", ".png", 1) for i, x in enumerate(labels)]
    rows += [("b", f"b/{x}/{i}.png", f"{x}/{i}.png", ".png", 1) for i, x in enumerate(["cat", "cat", "dog"])]
    manifest = spark.createDataFrame(rows, "dataset string, path string, rel_path string, ext string, length int")
    facts = [(d, "stratified_images", ".png", None, None) for d in "ab"]
    schema = "dataset string, strategy string, primary_format string, train_dir string, test_dir string"
    found = split.split_manifest(manifest, spark.createDataFrame(facts, schema)).collect()
    assert len(found) == len(labels) + 3
    # Dataset b has a label with one member.
    assert all((r.part == split.NOT_STRATIFIED) == (r.dataset == "b") for r in found)
    tests = [r.path.split("/")[1] for r in found if r.part == "test"]
    assert {x: tests.count(x) for x in set(labels)} == quota_model({x: labels.count(x) for x in set(labels)})


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_labels_descend_in_step(spark, monkeypatch, digits):
    monkeypatch.setattr(split, "PREFIX", digits)
    rows = [(i, "hot" if i % 10 else f"few{i % 3}") for i in range(3000)] + [(7, "same")] * 400
    df = spark.createDataFrame(rows, "k int, label string").repartition(3)
    found = {(r["k"], r["label"]): r["split"] for r in split.stratified_split(df, "k", "label").collect()}
    quotas = {r["label"]: r["quota"] for r in split.label_quotas(df.groupBy("label").count().withColumnRenamed("count", "rows"), "label").collect()}
    for label in {r[1] for r in rows}:
        hashes = sorted(hashlib.md5(f"42:{k}".encode()).hexdigest() for k, l in rows if l == label)
        cut = hashes[quotas[label] - 1]
        for k in {k for k, l in rows if l == label}:
            assert (found[k, label] == "test") == (hashlib.md5(f"42:{k}".encode()).hexdigest() <= cut)
