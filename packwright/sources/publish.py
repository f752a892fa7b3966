"""Packages that appear whole or not at all.

The outputs are written to a staging folder beside the package, then counted and digested from
what was stored, then a manifest of them is added and the folder is renamed. A reader sees either
no package or one with a manifest; on stores whose renames are copies, a package without a whole
manifest is a half-written one, which :func:`check_package` reports.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packwright.sources.checkpoints import checkpointed
from packwright.sources.writers import ANSWER_PATH, SAMPLE_PATH, TEST_PATH, TRAIN_PATH, write_package

PACKAGE_OUTPUTS = (TRAIN_PATH, TEST_PATH, SAMPLE_PATH, ANSWER_PATH)
MANIFEST = "_manifest"
_MANIFEST_SCHEMA = "output string, lines bigint, digest string"


def _store(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, folder: str) -> bool:
    store, path = _store(spark, folder)
    return store.exists(path)


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a folder and what is below it."""
    store, path = _store(spark, folder)
    store.delete(path, True)


def facts(spark: SparkSession, root: str, outputs: Sequence[str]) -> DataFrame:
    """``(output, lines, digest)`` of text outputs below ``root``; absent ones have no row.

    The digest adds up hashes of lines, so it does not depend on how they are spread over files.
    """
    found = []
    for output in outputs:
        if exists(spark, f"{root}/{output}"):
            lines = spark.read.option("lineSep", "\n").text(f"{root}/{output}")
            hashed = F.xxhash64("value").cast("decimal(38,0)")
            digest = F.coalesce(F.sum(hashed), F.lit(0)).cast("decimal(38,0)").cast("string")
            found.append(lines.agg(F.count(F.lit(1)).alias("lines"), digest.alias("digest")).select(F.lit(output).alias("output"), "lines", "digest"))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], _MANIFEST_SCHEMA)


def publish(spark: SparkSession, root: str, outputs: Sequence[str], write: Callable[[str], None]) -> DataFrame:
    """Let ``write`` put the outputs into a folder, and make that folder ``root``; its manifest.

    If writing fails, or an output is absent, nothing is published, the staging folder goes and
    the error is raised. A package that exists is never replaced.
    """
    root = root.rstrip("/")
    if exists(spark, root):
        raise FileExistsError(root)
    staging = f"{root}.staging-{uuid.uuid4().hex}"
    store, staged = _store(spark, staging)
    try:
        write(staging)
        found = checkpointed(facts(spark, staging, outputs))
        absent = set(outputs) - {r["output"] for r in found.select("output").collect()}
        if absent:
            raise FileNotFoundError(f"not written: {', '.join(sorted(absent))}")
        found.coalesce(1).write.json(f"{staging}/{MANIFEST}")
        if exists(spark, root) or not store.rename(staged, _store(spark, root)[1]):
            raise FileExistsError(root)
    except BaseException:
        store.delete(staged, True)
        raise
    return found


def publish_package(split: DataFrame, root: str, id_col: str, target: str) -> DataFrame:
    """:func:`packwright.sources.writers.write_package`, published whole; the manifest."""
    return publish(split.sparkSession, root, PACKAGE_OUTPUTS, lambda folder: write_package(split, folder, id_col, target))


def check_package(spark: SparkSession, root: str, outputs: Sequence[str] = PACKAGE_OUTPUTS) -> DataFrame:
    """``(output, lines, status)`` of each output: ``ok``, ``changed``, ``missing`` or ``unpublished``.

    Without a whole manifest nothing is published, whatever is there. ``lines`` are those found.
    """
    root = root.rstrip("/")
    found = facts(spark, root, outputs)
    listed = spark.createDataFrame([(o,) for o in outputs], "output string").join(found, "output", "left")
    if not exists(spark, f"{root}/{MANIFEST}/_SUCCESS"):
        return listed.select("output", "lines", F.lit("unpublished").alias("status"))
    written = spark.read.schema(_MANIFEST_SCHEMA).json(f"{root}/{MANIFEST}")
    written = written.withColumnsRenamed({"lines": "written", "digest": "expected"})
    joined = listed.join(written, "output", "left")
    same = (F.col("lines") == F.col("written")) & (F.col("digest") == F.col("expected"))
    status = F.when(F.col("expected").isNull(), "unpublished").when(F.col("lines").isNull(), "missing").when(same, "ok").otherwise("changed")
    return joined.select("output", "lines", status.alias("status"))
