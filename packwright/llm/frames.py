"""Helpers for running numpy and Arrow code inside Spark tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packwright.sources.shipping import ship

#: Text bytes that one step of a task works on; longer texts form a step of their own.
STEP_BYTES = 2 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def task_map(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``function`` over the Arrow batches of every partition; the package goes to the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The id and the text as ``id`` and ``text``; other columns, whatever their names, go."""
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


def steps(batches: Iterator[pa.RecordBatch], limit: int = STEP_BYTES, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes, so that memory stays bounded."""
    for batch in batches:
        first, size = 0, 0
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        for i, length in enumerate(lengths.tolist()):
            if size and size + length > limit:
                yield batch.slice(first, i - first)
                first, size = i, 0
            size += length
        if first < batch.num_rows:
            yield batch.slice(first)


def strings(column: pa.Array) -> list[str]:
    """Texts of a column; null is empty, and bytes that are not UTF-8 become U+FFFD."""
    filled = pc.fill_null(column, "")
    try:
        return filled.to_pylist()
    except UnicodeDecodeError:
        return [x.decode("utf-8", "replace") for x in filled.cast(pa.binary()).to_pylist()]


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A record batch with these columns in the order of the schema."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=schema.field(n).type) for n, c in ((n, columns[n]) for n in schema.names)],
        schema=schema,
    )
