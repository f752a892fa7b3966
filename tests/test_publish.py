import pytest

from packwright.operators import split
from packwright.sources import publish, writers

OUTPUTS = ("a/x", "b/y")


def states(spark, root, outputs=OUTPUTS):
    return {r["output"]: (r["status"], r["lines"]) for r in publish.check_package(spark, root, outputs).collect()}


def test_a_writer_that_fails_half_way_publishes_nothing(spark, tmp_path):
    df = spark.range(10)

    def write(folder):
        writers.write_delimited(df, f"{folder}/a/x")
        raise RuntimeError("disk is gone")

    with pytest.raises(RuntimeError, match="disk is gone"):
        publish.publish(spark, f"{tmp_path}/p", OUTPUTS, write)
    assert list(tmp_path.iterdir()) == []
    assert states(spark, f"{tmp_path}/p") == {o: ("unpublished", None) for o in OUTPUTS}


def test_an_output_that_is_not_written_publishes_nothing(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="b/y"):
        publish.publish(spark, f"{tmp_path}/p", OUTPUTS, lambda f: writers.write_delimited(spark.range(3), f"{f}/a/x"))
    assert list(tmp_path.iterdir()) == []


def test_published_changed_and_half_written(spark, tmp_path):
    def write(folder):
        writers.write_delimited(spark.range(10).coalesce(1), f"{folder}/a/x")
        writers.write_delimited(spark.range(0).coalesce(1), f"{folder}/b/y")

    root = f"{tmp_path}/p"
    found = publish.publish(spark, root, OUTPUTS, write)
    assert {r["output"]: r["lines"] for r in found.collect()}["a/x"] == 11
    assert {s for s, _ in states(spark, root).values()} == {"ok"}
    with pytest.raises(FileExistsError):
        publish.publish(spark, root, OUTPUTS, write)
    assert [p.name for p in tmp_path.iterdir()] == ["p"]
    # The same number of lines with other contents.
    writers.write_delimited(spark.range(1, 11).coalesce(1), f"{root}/a/x", mode="overwrite")
    publish.discard(spark, f"{root}/b/y")
    assert states(spark, root) == {"a/x": ("changed", 11), "b/y": ("missing", None)}
    # Copied without its manifest, as an interrupted rename on an object store leaves it.
    publish.discard(spark, f"{root}/{publish.MANIFEST}")
    assert states(spark, root)["a/x"] == ("unpublished", 11)


def test_package(spark, tmp_path):
    df = spark.range(50).selectExpr("id", "id % 7 as x", "cast(id as double) as y")
    publish.publish_package(split.random_split(df, "id"), f"{tmp_path}/p", "id", "y")
    found = states(spark, f"{tmp_path}/p", publish.PACKAGE_OUTPUTS)
    assert {s for s, _ in found.values()} == {"ok"}
