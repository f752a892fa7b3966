import pytest

from packwright.operators import joins


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("how", joins.JOIN_TYPES)
def test_hot_keys_do_not_change_the_result(spark, how):
    left = spark.createDataFrame(
        [("hot", i) for i in range(60)] + [(f"k{i}", i) for i in range(20)] + [(None, i) for i in range(40)],
        "k string, v int",
    )
    right = spark.createDataFrame([("hot", 1), ("k3", 2), ("k99", 3), (None, 4)], "k string, w int")
    plain = left.join(right, ["k"], how)
    found = joins.join_unique(left, right, ["k"], how, hot_rows=10)
    assert found.columns == plain.columns
    assert rows(found) == rows(plain)
    assert rows(joins.join_unique(left, right, ["k"], how)) == rows(plain)


def test_unknown_join_type(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        joins.join_unique(df, df, ["id"], "full")


def test_triage_keeps_out_of_range_indexes(spark):
    verdicts = spark.createDataFrame([(1, 0), (1, 1), (1, 3)], "doc_id int, table_index int")
    tables = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "doc_id int, table_index int, name string")
    found = {(r.table_index, r.name, r.status) for r in joins.triage_join(verdicts, tables).collect()}
    assert found == {(0, None, "quarantined"), (1, "a", "ok"), (3, None, "quarantined")}


def test_listed_files_and_skip(spark):
    listed = spark.createDataFrame([("a",), ("b",), ("a",)], "path string")
    manifest = spark.createDataFrame([("a", 1), ("a", 2), ("c", 3)], "path string, n int")
    assert rows(joins.listed_files(listed, manifest, ["path"])) == [("a", True), ("a", True), ("b", False)]
    assert rows(joins.skip_processed(listed, manifest, ["path"])) == [("b",)]


def test_every_hot_key_is_found(spark):
    left = spark.range(600).selectExpr("id % 60 as k")
    assert joins.hot_keys(left, ["k"], hot_rows=5).count() == 60
    assert joins.hot_keys(left, ["k"], hot_rows=10).count() == 0


def test_hot_key_with_several_right_rows_is_an_error(spark):
    left = spark.range(100).selectExpr("1 as k")
    right = spark.createDataFrame([(1, "a"), (1, "b")], "k int, x string")
    with pytest.raises(ValueError):
        joins.join_unique(left, right, ["k"], "left", hot_rows=10)
