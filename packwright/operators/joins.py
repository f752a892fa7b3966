"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows from which a key is treated apart.
HOT_ROWS = 2_000_000
#: A key is hot only with more than this fraction of the rows, so there are never more hot keys.
HOT_KEYS = 100_000
JOIN_TYPES = ("inner", "left", "left_semi", "left_anti")


def hot_keys(df: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS, most: int = HOT_KEYS) -> DataFrame:
    """All keys with more than ``hot_rows`` rows and more than 1 / ``most`` of all rows.

    By the second bound there are fewer than ``most`` of them, and a key below it is no more than
    a task's share of a table that large.
    """
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("__rows"))
    return counts.filter(F.col("__rows") > max(hot_rows, df.count() // most)).select(*on)


def join_unique(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot_rows: int | None = None,
) -> DataFrame:
    """Join ``left`` to a ``right`` side that is unique on ``on``.

    ``how`` is one of ``JOIN_TYPES``; for the last two, ``right`` need not be unique. The join is
    an ordinary one: adaptive execution sends a small right side to all tasks and cuts the left
    rows of a frequent key into several tasks, for which its skew handling has to be on.

    With ``hot_rows`` the keys with more rows than that are looked for first (see
    :func:`hot_keys`, also for the bound of their number), in two runs of the left side. Their
    rows then stay where they are and the matching right rows, one per hot key, are broadcast to
    them, whatever adaptive execution does. Raises ``ValueError`` if a hot key has several.
    """
    if how not in JOIN_TYPES:
        raise ValueError(f"unsupported join type: {how}")
    on = list(on)
    if hot_rows is None:
        return left.join(right, on, how)
    keys = hot_keys(left, on, hot_rows).collect()
    if not keys:
        return left.join(right, on, how)
    hot = left.sparkSession.createDataFrame(keys, left.select(*on).schema).dropna()
    hot_right = right.join(F.broadcast(hot), on, "left_semi")
    if how in ("left_semi", "left_anti"):
        hot_right = hot_right.select(*on).distinct()
    elif hot_right.groupBy(*on).agg(F.count(F.lit(1)).alias("__rows")).filter("__rows > 1").head(1):
        raise ValueError("the right side has several rows for a key")
    # A null key matches nothing, so its rows need not travel either.
    is_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    staying = left.join(F.broadcast(hot), on, "left_semi").unionByName(left.filter(is_null))
    moving = left.filter(~is_null).join(F.broadcast(hot), on, "left_anti")
    other_right = right.join(F.broadcast(hot), on, "left_anti")
    return moving.join(other_right, on, how).unionByName(
        staying.join(F.broadcast(hot_right), on, how)
    )


def triage_join(verdicts: DataFrame, tables: DataFrame, key: str = "doc_id") -> DataFrame:
    """Attach each verdict to its table by 1-based index; out-of-range ones are kept aside.

    ``status`` is ``ok`` or ``quarantined``. ``tables`` is unique on ``(key, table_index)``.
    """
    known = tables.withColumn("__known", F.lit(True))
    joined = join_unique(verdicts, known, [key, "table_index"], "left")
    status = F.when(F.col("__known"), "ok").otherwise("quarantined")
    return joined.withColumn("status", status).drop("__known")


def listed_files(listed: DataFrame, manifest: DataFrame, on: Sequence[str]) -> DataFrame:
    """Mark each listed file as present or missing in the manifest.

    The manifest is reduced to distinct keys first, so a repeated path cannot add rows.
    """
    present = manifest.select(*on).distinct().withColumn("__present", F.lit(True))
    joined = join_unique(listed, present, on, "left")
    return joined.withColumn("present", F.coalesce("__present", F.lit(False))).drop("__present")


def skip_processed(todo: DataFrame, done: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key has not been processed yet."""
    return join_unique(todo, done.select(*on).distinct(), on, "left_anti")
