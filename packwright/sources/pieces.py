"""Delimited text with line breaks inside quotes, read by many tasks from one file.

A block of a file does not know whether it begins inside quotes. A first pass therefore finds, for
every block, where it leads from either beginning; combining these outcomes along each file fixes
how every block really begins. A second pass cuts records at their true ends. A record that
crosses blocks leaves one fragment in each of them; the fragments, at most two a block, are put
together afterwards. Lines without quotes are not looked at.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from packwright.sources.checkpoints import checkpointed
from packwright.sources.shipping import ship

#: Blocks that begin inside quotes, up to which the list of them is sent to all tasks.
SENT_BLOCKS = 1_000_000

_KEY = ["file", "other", "block"]
_OUTCOMES = "file bigint, other bigint, block bigint, from_start boolean, from_quotes boolean"
_CUT = "file bigint, other bigint, block bigint, kind int, text string"
_RECORD, _HEADER, _HEAD, _MIDDLE, _TAIL, _HEADER_TAIL = range(6)


def ends_inside(line: str, inside: bool, sep: str) -> bool:
    """Whether a line that begins inside quotes, or not, ends inside them.

    Quotes open at the beginning of a field only, a doubled one is a character, and what follows
    closing quotes belongs to the field up to the separator.
    """
    opening, at = f'{sep}"', 0
    if not inside and line.startswith('"'):
        inside, at = True, 1
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            at += 1
            if line.startswith('"', at):
                at += 1
            else:
                inside = False
        else:
            at = line.find(opening, at)
            if at < 0:
                return False
            inside, at = True, at + len(opening)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    name = F.col("_metadata.file_path")
    # Two hashes make a key of 128 bits in place of a long name on every line.
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64(name).alias("file"),
        F.xxhash64(F.lit("other"), name).alias("other"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Parts of a batch that lie in one block, with its key."""
    keys = [batch.column(n).to_numpy() for n in _KEY]
    change = np.zeros(max(batch.num_rows - 1, 0), bool)
    for key in keys:
        change |= key[1:] != key[:-1]
    edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
    for start, stop in zip(edges, edges[1:]):
        if stop > start:
            yield tuple(int(k[start]) for k in keys), batch.slice(start, stop - start)


def _with_quotes(values: pa.Array) -> list[int]:
    return np.flatnonzero(pc.match_substring(values, '"').to_numpy(zero_copy_only=False)).tolist()


def _outcomes(batches, sep: str) -> Iterator[pa.RecordBatch]:
    now, ends = None, (False, True)

    def row():
        columns = [pa.array([k], pa.int64()) for k in now] + [pa.array([e]) for e in ends]
        return pa.RecordBatch.from_arrays(columns, [*_KEY, "from_start", "from_quotes"])

    for batch in batches:
        for key, part in _runs(batch):
            if key != now:
                if now is not None:
                    yield row()
                now, ends = key, (False, True)
            values = part.column("value")
            for i in _with_quotes(values):
                line = values[i].as_py()
                found = {e: ends_inside(line, e, sep) for e in set(ends)}
                ends = (found[ends[0]], found[ends[1]])
    if now is not None:
        yield row()


def _beginnings(outcomes: DataFrame) -> DataFrame:
    """Blocks that begin inside quotes.

    A block either leads to one end whatever its beginning, or keeps or turns its beginning. So a
    block begins where the last one of the first kind ended, turned as often as blocks since then
    turn it.
    """
    fixed, turns = F.col("from_start") == F.col("from_quotes"), F.col("from_start") & ~F.col("from_quotes")
    order = Window.partitionBy("file", "other").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    counted = outcomes.withColumn("turned", F.sum(turns.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    since = F.max("turned").over(before) - F.coalesce(F.last(F.when(fixed, F.col("turned")), ignorenulls=True).over(before), F.lit(0))
    start = F.coalesce(F.last(F.when(fixed, F.col("from_start")), ignorenulls=True).over(before), F.lit(False))
    inside = start != (F.coalesce(since, F.lit(0)) % 2 == 1)
    return counted.select(*_KEY, inside.alias("inside")).where("inside")


def _placed(lines: DataFrame, inside: DataFrame, count: int, how: str) -> DataFrame:
    """Lines, in order within their block, with how the block begins."""
    if not count:
        return lines.withColumn("inside", F.lit(None).cast("boolean"))
    if count <= SENT_BLOCKS:
        return lines.join(F.broadcast(inside), _KEY, how)
    joined = lines.withColumn("at", F.monotonically_increasing_id()).join(inside, _KEY, how)
    return joined.repartition(*_KEY).sortWithinPartitions(*_KEY, "at").drop("at")


def _cut(batches, sep: str, header: bool) -> Iterator[pa.RecordBatch]:
    """Records of every block, and fragments of those that are not whole there."""
    now, inside, held, kind = None, False, [], None

    def rows(key, kinds, texts):
        columns = [pa.array([k] * len(kinds), pa.int64()) for k in key]
        return pa.RecordBatch.from_arrays([*columns, pa.array(kinds, pa.int32()), texts], [*_KEY, "kind", "text"])

    def rest():
        if held:
            left = {_HEAD: _MIDDLE, _RECORD: _TAIL, _HEADER: _HEADER_TAIL}[kind]
            yield rows(now, [left], pa.array(["\n".join(held)], pa.string()))

    for batch in batches:
        for key, part in _runs(batch):
            if key != now:
                yield from rest()
                now, inside, held = key, bool(part.column("inside")[0].as_py()), []
                # The first record of a file is its header.
                kind = _HEAD if inside else _HEADER if header and key[2] == 0 else _RECORD
            values, done = part.column("value"), 0
            kinds, texts = [], []
            for i in [*_with_quotes(values), part.num_rows]:
                # Lines before a line with quotes: records of their own, or all part of the open one.
                plain = values.slice(done, i - done)
                if len(plain):
                    if held or inside:
                        held += plain.to_pylist()
                    else:
                        marks = [_RECORD] * len(plain)
                        if kind == _HEADER:
                            first = next((n for n, t in enumerate(plain.to_pylist()) if t not in ("", "\r")), None)
                            if first is not None:
                                marks[first], kind = _HEADER, _RECORD
                        kinds += marks
                        texts.append(plain)
                if i == part.num_rows:
                    break
                line = values[i].as_py()
                held.append(line)
                inside = ends_inside(line, inside, sep)
                if not inside:
                    kinds.append(kind)
                    texts.append(pa.array(["\n".join(held)], pa.string()))
                    held, kind = [], _RECORD
                done = i + 1
            if kinds:
                yield rows(key, kinds, pa.concat_arrays([t.cast(pa.string()) for t in texts]))
    yield from rest()


def _joined_fragments(fragments: DataFrame) -> DataFrame:
    """Whole records from their fragments; each begins with a tail."""
    begins = F.col("kind").isin(_TAIL, _HEADER_TAIL).cast("int")
    order = Window.partitionBy("file", "other").orderBy("block", begins)
    numbered = fragments.withColumn("record", F.sum(begins).over(order))
    parts = F.array_sort(F.collect_list(F.struct("block", begins.alias("begins"), "text")))
    whole = numbered.groupBy("file", "other", "record").agg(parts.alias("parts"), F.max("kind").alias("last"))
    kind = F.when(F.col("last") == _HEADER_TAIL, _HEADER).otherwise(_RECORD)
    return whole.select("file", kind.alias("kind"), F.array_join(F.col("parts.text"), "\n").alias("text"))


def records(spark: SparkSession, path: str, sep: str = ",", header: bool = True) -> DataFrame:
    """``(file, kind, text)``: every record as text; ``kind`` is 1 for a file's header and else 0.

    Lines end with a line feed, before which a carriage return may stand; those inside quotes stay
    as they are. Empty lines are no records. Quotes that never close take the rest of the file but
    its last line feed. The first pass is made at once.
    """
    ship(spark)
    lines = _lines(spark, path)
    outcomes = checkpointed(lines.mapInArrow(lambda b: _outcomes(b, sep), _OUTCOMES))
    inside = checkpointed(_beginnings(outcomes))
    count = inside.count()
    cut = _placed(lines, inside, count, "left").mapInArrow(lambda b: _cut(b, sep, header), _CUT)
    found = cut.where(F.col("kind") <= _HEADER).select("file", "kind", "text")
    if count or not outcomes.where("from_start").isEmpty():
        # Fragments lie only in blocks that begin inside quotes and in those before them.
        order = Window.partitionBy("file", "other").orderBy("block")
        near = outcomes.join(inside, _KEY, "left").withColumn("next", F.lead("inside").over(order))
        last = F.lead("block").over(order).isNull()
        near = near.withColumn("last", last).where("inside or next or last").select(*_KEY, "inside")
        placed = _placed(lines, near, near.count() or 1, "inner")
        fragments = checkpointed(placed.mapInArrow(lambda b: _cut(b, sep, header), _CUT).where(F.col("kind") > _HEADER))
        found = found.unionByName(_joined_fragments(fragments))
    text = F.when(F.endswith("text", F.lit("\r")), F.expr("left(text, length(text) - 1)")).otherwise(F.col("text"))
    return found.select("file", "kind", text.alias("text")).where("text <> ''")


def column_names(header: str, sep: str = ",") -> list[str]:
    """Names of a header; empty ones get their position, those that repeat get it too."""
    fields = next(csv.reader([header], delimiter=sep))
    lowered = [f.lower() for f in fields]
    return [f"_c{i}" if not f else f"{f}{i}" if lowered.count(f.lower()) > 1 else f for i, f in enumerate(fields)]


def read_pieces(spark: SparkSession, path: str, sep: str = ",", schema: T.StructType | str | None = None) -> DataFrame:
    """Delimited text with a header, line breaks inside quotes taken, in parallel pieces.

    Without a schema the names are those of the first file's header and the types are inferred by
    another pass over the records.
    """
    found = records(spark, path, sep)
    options = {"sep": sep, "escape": '"', "multiLine": "true", "lineSep": "\n"}
    rows = found.where(F.col("kind") == _RECORD).select("text")
    if schema is None:
        first = found.where(F.col("kind") == _HEADER).orderBy("file").select("text").first()
        if first is None:
            return spark.createDataFrame([], T.StructType())
        names = column_names(first["text"], sep)
        untyped = T.StructType([T.StructField(n, T.StringType()) for n in names])
        inferred = spark.read.options(**options, inferSchema=True).csv(rows.rdd.map(lambda r: r[0])).schema
        kinds = [f.dataType for f in inferred][: len(names)]
        kinds += [T.StringType()] * (len(names) - len(kinds))
        schema = T.StructType([T.StructField(f.name, k) for f, k in zip(untyped, kinds)])
    text = schema if isinstance(schema, str) else ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
    return rows.select(F.from_csv("text", text, options).alias("row")).select("row.*")
