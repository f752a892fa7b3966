"""Profiles of tables and of file collections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packwright.functions.text import extension
from packwright.sources.checkpoints import checkpointed
from packwright.operators.quantiles import GRID, exact_quantiles, moments_and_sketches

# Extensions that count as data, in order of preference on a tie.
DATA_EXTENSIONS = (
    ".csv",
    ".nc",
    ".h5",
    ".hdf5",
    ".jsonl",
    ".json",
    ".parquet",
    ".tsv",
    ".dat",
    ".grib",
    ".grib2",
)
# Image formats can be a primary format too, after every data format.
PRIMARY_EXTENSIONS = (*DATA_EXTENSIONS, ".jpg", ".jpeg", ".png", ".bmp")
UNKNOWN_FORMAT = "unknown"

QUARTILES = (0.25, 0.5, 0.75)


# --- tables ----------------------------------------------------------------------------


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and columns, and the column names."""
    names = F.array(*[F.lit(c) for c in df.columns])
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns"), names.alias("columns")
    )


def column_info(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and number of non-null values."""
    counted = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.col(f"c{i}").alias("non_null"),
        )
        for i, field in enumerate(df.schema)
    ]
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def numeric_summary(
    df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True
) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per numeric column.

    The moments of all columns take one pass. Exact quartiles come from
    :func:`exact_quantiles`, whose sketches are made in that pass; ``exact=False`` takes the
    quartiles from a sketch alone.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    found = moments_and_sketches(df, names) if names else []
    if exact:
        known = exact_quantiles(df, names, QUARTILES, sketched=found)
        quartiles = [known[n] for n in names]
    else:
        quartiles = [[k["grid"] and k["grid"][int(q * GRID)] for q in QUARTILES] for k in found]
    rows = [(n, *[k[c] for c in ("count", "mean", "std", "min")], *q, k["max"]) for n, k, q in zip(names, found, quartiles)]
    numbers = ", ".join(f"{c} double" for c in ("mean", "std", "min", "p25", "p50", "p75", "max"))
    return df.sparkSession.createDataFrame(rows, f"column string, count bigint, {numbers}")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows ``(column, value, freq)``: how often each value occurs in each column.

    The counting combines before the shuffle, so frequent values cost one row per task.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
            for c in columns
        ]
    )
    return (
        df.select(F.inline(pairs))
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("freq"))
    )


def categorical_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, distinct values, most frequent value and its frequency per text column.

    The smallest of equally frequent values is reported. Nulls do not count.
    """
    if columns is None:
        columns = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BooleanType))]
    counted = value_counts(df, list(columns))
    known = F.col("value").isNotNull()
    top = F.min_by(
        F.struct("value", "freq"), F.when(known, F.struct(-F.col("freq"), F.col("value")))
    )
    return (
        counted.groupBy("column")
        .agg(
            F.sum(F.when(known, F.col("freq")).otherwise(0)).alias("count"),
            F.count("value").alias("unique"),
            top.alias("top"),
        )
        .select(
            "column",
            "count",
            "unique",
            F.when(F.col("count") > 0, F.col("top.value")).alias("top"),
            F.when(F.col("count") > 0, F.col("top.freq")).alias("freq"),
        )
    )


#: Cells that values are hashed into, and fullest cells whose values are counted first.
CELLS, FULLEST = 1 << 16, 16


def most_frequent(df: DataFrame, columns: Sequence[str], cells: int = CELLS) -> DataFrame:
    """``(column, count, top, freq)``: the most frequent value of each column, however many there are.

    A first scan counts values per hashed cell, which is all it shuffles. A value is no more
    frequent than its cell, so the second scan counts the values of the fullest cells alone, and
    the best of them rules out every cell that holds fewer rows. What is left, none where one
    value stands out, is counted by a third scan. The smallest of equally frequent values is
    reported; nulls do not count.
    """
    names = list(columns)
    if not names:
        return df.sparkSession.createDataFrame([], "column string, count bigint, top string, freq bigint")
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("string").alias("value")) for i, c in enumerate(names)])
    laid = df.select(F.inline(pairs)).where("value is not null")
    laid = laid.withColumn("cell", F.pmod(F.xxhash64("value"), F.lit(cells)))
    sizes = checkpointed(laid.groupBy("i", "cell").agg(F.count(F.lit(1)).alias("size")))

    def best_of(chosen: DataFrame) -> DataFrame:
        # At most a row per cell and column: a bounded table.
        counted = laid.join(F.broadcast(chosen), ["i", "cell"], "left_semi").groupBy("i", "value").agg(F.count(F.lit(1)).alias("freq"))
        return counted.groupBy("i").agg(F.min_by(F.struct("value", "freq"), F.struct(-F.col("freq"), F.col("value"))).alias("best"))

    order = F.sort_array(F.collect_list(F.struct("size", "cell")), asc=False)
    fullest = checkpointed(sizes.groupBy("i").agg(F.slice(order, 1, FULLEST).alias("cells")).select("i", F.inline("cells")))
    found = checkpointed(best_of(fullest.select("i", "cell")))
    possible = sizes.join(F.broadcast(found), "i").where(F.col("size") >= F.col("best.freq"))
    left = checkpointed(possible.join(fullest, ["i", "cell"], "left_anti").select("i", "cell"))
    if not left.isEmpty():
        found = found.unionByName(best_of(left))
    order_of = F.struct(-F.col("best.freq"), F.col("best.value"))
    best = found.groupBy("i").agg(F.min_by("best", order_of).alias("best"))
    totals = sizes.groupBy("i").agg(F.sum("size").alias("count"))
    listed = df.sparkSession.createDataFrame(list(enumerate(names)), "i int, column string")
    joined = listed.join(F.broadcast(totals.join(best, "i")), "i", "left")
    return joined.select("column", F.coalesce("count", F.lit(0).cast("bigint")).alias("count"), F.col("best.value").alias("top"), F.col("best.freq").alias("freq"))


def status_counts(df: DataFrame, by: Sequence[str] = ("status",)) -> DataFrame:
    """Number of rows per outcome."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def asset_summary(assets: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per source: number of tables, charts and code snippets, and whether there are none."""
    kinds = ("table", "chart", "code")
    counts = [F.count_if(F.col("asset_type") == k).alias(f"n_{k}") for k in kinds]
    return (
        assets.groupBy(key)
        .agg(*counts)
        .withColumn("is_empty", F.col("n_table") + F.col("n_chart") + F.col("n_code") == 0)
    )


# --- file collections ------------------------------------------------------------------


def format_histogram(manifest: DataFrame, by: str = "dataset") -> DataFrame:
    """Files per dataset and lower-cased extension; ``''`` stands for no extension."""
    return (
        manifest.select(by, extension(F.col("path")).alias("ext"))
        .groupBy(by, "ext")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _primary_format(formats: Sequence[str]) -> Column:
    rank = F.array_position(F.array(*[F.lit(e) for e in formats]), F.col("ext"))
    candidate = F.when(rank > 0, F.struct(-F.col("n"), rank))
    return F.coalesce(
        F.min_by(F.when(rank > 0, F.col("ext")), candidate), F.lit(UNKNOWN_FORMAT)
    )


def primary_format(
    manifest: DataFrame, by: str = "dataset", formats: Sequence[str] = DATA_EXTENSIONS
) -> DataFrame:
    """Most frequent data extension per dataset, ``unknown`` if it has none."""
    counts = format_histogram(manifest, by)
    return counts.groupBy(by).agg(_primary_format(formats).alias("primary_format"))


def dataset_profile(
    manifest: DataFrame, by: str = "dataset", formats: Sequence[str] = DATA_EXTENSIONS
) -> DataFrame:
    """One row per dataset: file count, format histogram (a map) and primary format.

    Files without an extension count as files but have no entry in the map.
    """
    named = F.when(F.col("ext") != "", F.struct("ext", "n"))
    return (
        format_histogram(manifest, by)
        .groupBy(by)
        .agg(
            F.sum("n").alias("file_count"),
            F.map_from_entries(F.sort_array(F.collect_list(named))).alias("file_formats"),
            _primary_format(formats).alias("primary_format"),
        )
    )
