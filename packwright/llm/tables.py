"""Counts per hashed cell over all rows: a table of fixed size, whatever the number of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from packwright.llm.frames import task_map

#: Cells that travel in one row, and tasks whose counts meet in one group.
CHUNK, FAN = 1 << 13, 256


def cell_counts(df: DataFrame, cells: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], size: int) -> np.ndarray:
    """How often each of ``size`` cells occurs among what ``cells`` yields from the rows."""

    def count(batches):
        total = np.zeros(size, np.int64)
        for found in cells(batches):
            total += np.bincount(found, minlength=size)
        return total

    return cell_sums(df, count, size)


def cell_sums(df: DataFrame, table: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int) -> np.ndarray:
    """Sum of the tables of ``size`` whole numbers that ``table`` makes from the rows of each task.

    Every task works on its own and sends its table in chunks; those of more than ``FAN`` tasks
    are summed in two steps, so that no group gathers too many. ``size`` numbers reach the
    driver.
    """

    def count(batches):
        from pyspark import TaskContext

        total = table(batches)
        group = TaskContext.get().partitionId() // FAN
        rows = [(i, total[i : i + CHUNK]) for i in range(0, size, CHUNK)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in rows], pa.int64()), pa.array([group] * len(rows), pa.int64()), pa.array([c.tobytes() for _, c in rows], pa.binary())],
            ["cell", "part", "counts"],
        )

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(c, np.int64) for c in table.column("counts").to_pylist()], axis=0)
        return pa.table({"cell": table.column("cell").slice(0, 1), "part": pa.array([0], pa.int64()), "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "cell bigint, part bigint, counts binary"
    partial = task_map(df, count, schema)
    if df.rdd.getNumPartitions() > FAN:
        partial = partial.groupBy("cell", "part").applyInArrow(lambda t: add(t), schema)
    result = np.zeros(size, np.int64)
    for row in partial.groupBy("cell").applyInArrow(lambda t: add(t), schema).collect():
        chunk = np.frombuffer(row["counts"], np.int64)
        result[row["cell"] : row["cell"] + chunk.size] = chunk
    return result
