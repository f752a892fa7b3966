"""Exact global order without sorting the table in one task.

The order is cut into ranges. A sample only proposes the boundaries; any boundaries give the exact
answer, so re-evaluating the plan cannot change the result. The ranges grow in number with the
rows and form an index of two levels: at most ``MAX_RANGES`` coarse ones, whose boundaries are in
the plan and reach the driver with one count each, and within each of them fine ones, whose
boundaries are rows of a table that is joined.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from packwright.operators.joins import join_unique
from packwright.sources.checkpoints import checkpointed

ROWS_PER_RANGE = 2_000_000
#: Coarse ranges, at most.
MAX_RANGES = 1024
#: Boundaries of fine ranges up to which their table is sent to all tasks.
SENT_BOUNDARIES = 100_000
SAMPLE_PER_RANGE = 32
#: Rows at which a search stops narrowing and takes a top-k; the result is the same at any value.
SMALL_ROWS = 100_000


def key_struct(columns: Sequence[str]) -> Column:
    """The order columns as one comparable value."""
    return F.struct(*[F.col(c) for c in columns])


def typed_literal(value: str | None, data_type: T.DataType) -> Column:
    """Literal from the string form of a value; folds to a constant the scan can filter on."""
    return F.lit(value).cast(data_type)


@dataclass(frozen=True)
class Ranges:
    """Sorted literal boundaries; range ``i`` holds keys from boundary ``i-1`` to ``i``."""

    columns: tuple[str, ...]
    schema: T.StructType
    boundaries: tuple[str, ...]

    def _literal(self, items: Sequence[str]) -> Column:
        return F.from_json(F.lit("[" + ",".join(items) + "]"), T.ArrayType(self.schema))

    def place(self, df: DataFrame, name: str) -> DataFrame:
        """Add the number of boundaries not above the key, the range of a row."""
        if not self.boundaries:
            return df.withColumn(name, F.lit(0))

        def boundary(position: Column, step: int) -> Column:
            # Only those that this step can meet, so that the plan holds each boundary once.
            met = self._literal(self.boundaries[step - 1 :: 2 * step])
            return F.get(met, F.shiftright(position, step.bit_length()))

        return _place(df, boundary, self.columns, len(self.boundaries), name)

    def inside(self, index: int) -> Column:
        """Predicate of the rows of one range."""
        key = key_struct(self.columns)
        predicate = F.lit(True)
        if index > 0:
            predicate &= key >= F.get(self._literal(self.boundaries[index - 1 : index]), F.lit(0))
        if index < len(self.boundaries):
            predicate &= key < F.get(self._literal(self.boundaries[index : index + 1]), F.lit(0))
        return predicate


def _place(
    df: DataFrame,
    boundary: Callable[[Column, int], Column],
    columns: Sequence[str],
    most: int,
    name: str,
) -> DataFrame:
    """Add how many of a sorted list of keys, of ``most`` at most, are not above the key.

    ``boundary(position, step)`` is the one at ``position + step - 1``, or null beyond the last.
    Every step of the binary search is a column over the one before. Spark compiles these along
    with the scan or join below them and reads an array of keys where it lies; a lambda function
    would be interpreted, and the array copied for each row of a join.
    """
    placed = df.withColumn("__sought", key_struct(columns)).withColumn(name, F.lit(0))
    for p in reversed(range(most.bit_length())):
        step, position = 1 << p, F.col(name)
        fits = boundary(position, step) <= F.col("__sought")
        placed = placed.withColumn(name, F.when(fits, position + step).otherwise(position))
    return placed.drop("__sought")


def range_count(df: DataFrame, rows: int, rows_per_range: int | None = None) -> int:
    """Ranges for a table of ``rows`` rows: one per few million, at least four per core.

    Ranges are spread over tasks by hash, so a task should get several of them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, 4 * cores, -(-rows // (rows_per_range or ROWS_PER_RANGE)))


def find_ranges(df: DataFrame, columns: Sequence[str], rows: int, ranges: int) -> Ranges:
    """Boundaries that cut ``df`` into about ``ranges`` coarse parts, from a sample of the keys."""
    ranges = min(ranges, MAX_RANGES)
    keys = df.select(*columns)
    if ranges < 2 or rows == 0:
        return Ranges(tuple(columns), keys.schema, ())
    wanted = ranges * SAMPLE_PER_RANGE
    share = min(1.0, wanted / rows)
    sample = keys if share == 1.0 else keys.sample(fraction=share, seed=7)
    sorted_keys = [
        row["boundary"]
        for row in sample.orderBy(*columns)
        .select(F.to_json(key_struct(columns)).alias("boundary"))
        .collect()
    ]
    step = max(1, len(sorted_keys) // ranges)
    boundaries = tuple(dict.fromkeys(sorted_keys[step::step]))
    return Ranges(tuple(columns), keys.schema, boundaries)


def _range_totals(df: DataFrame, found: Ranges) -> dict[int, int]:
    placed = found.place(df, "__range")
    totals = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("__rows")).collect()
    return {row["__range"]: row["__rows"] for row in totals}


def _fine_bounds(df: DataFrame, found: Ranges, rows: int, each: int) -> DataFrame:
    """``(__coarse, __bounds)``: keys that cut each coarse range into about ``each`` fine ones.

    The sample of one coarse range, a few dozen keys per fine one, is sorted by one task. Fewer
    than twice ``each`` of its keys become boundaries; equal ones leave a fine range empty.
    """
    wanted = (len(found.boundaries) + 1) * each * SAMPLE_PER_RANGE
    keys = df.select(*found.columns)
    sample = keys if wanted >= rows else keys.sample(fraction=wanted / rows, seed=11)
    in_range = Window.partitionBy("__coarse")
    numbered = found.place(sample, "__coarse").select(
        "__coarse",
        key_struct(found.columns).alias("__key"),
        (F.row_number().over(in_range.orderBy(*found.columns)) - 1).alias("__place"),
        F.count(F.lit(1)).over(in_range).alias("__size"),
    )
    step = F.greatest(F.lit(1), F.floor(F.col("__size") / each))
    cuts = numbered.filter((F.col("__place") > 0) & (F.col("__place") % step == 0))
    bounds = F.sort_array(F.collect_list("__key")).alias("__bounds")
    return checkpointed(cuts.groupBy("__coarse").agg(bounds))


def _in_ranges(df: DataFrame, found: Ranges, index: DataFrame | None, each: int) -> DataFrame:
    """Rows with their coarse and fine range, and other columns of the index of the latter."""
    placed = found.place(df, "__coarse")
    if index is None:
        return placed.withColumn("__fine", F.lit(0))
    # The key of a single coarse range is a constant, for which Spark might send the rows instead.
    if (len(found.boundaries) + 1) * each <= SENT_BOUNDARIES or not found.boundaries:
        index = F.broadcast(index)
    joined = placed.join(index, "__coarse", "left")

    def boundary(position: Column, step: int) -> Column:
        return F.get("__bounds", position + (step - 1))

    return _place(joined, boundary, found.columns, 2 * each, "__fine").drop("__bounds")


def _with_starts(fine: DataFrame, totals: DataFrame) -> DataFrame:
    """``fine`` with ``__starts``: for each fine range the rows before it in its coarse one."""
    # Every fine range has its place in the array, also those without rows.
    number = F.explode(F.sequence(F.lit(0), F.size("__bounds"))).alias("__fine")
    none = F.lit(0).cast(totals.schema["__rows"].dataType).alias("__rows")
    ranges = totals.unionByName(fine.select("__coarse", number, none))
    ranges = ranges.groupBy("__coarse", "__fine").agg(F.sum("__rows").alias("__rows"))
    before = Window.partitionBy("__coarse").orderBy("__fine").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start")
    listed = F.sort_array(F.collect_list(F.struct("__fine", "__start"))).getField("__start")
    starts = ranges.select("__coarse", "__fine", start).groupBy("__coarse").agg(listed.alias("__starts"))
    return checkpointed(starts.join(fine, "__coarse", "left"))


def _ranked(
    df: DataFrame,
    columns: Sequence[str],
    name: str,
    weight: str | None,
    ties: Sequence[str] = (),
    rows_per_range: int | None = None,
) -> DataFrame:
    """Positions by ``columns``, which alone make up the ranges, and then by ``ties``."""
    rows = df.count()
    ranges = range_count(df, rows, rows_per_range)
    found = find_ranges(df, columns, rows, ranges)
    each = -(-ranges // MAX_RANGES)
    fine = _fine_bounds(df, found, rows, each) if each > 1 else None
    placed = _in_ranges(df, found, fine, each)
    one = F.lit(1) if weight is None else F.col(weight)
    totals = placed.groupBy("__coarse", "__fine").agg(F.sum(one).alias("__rows"))
    totals = totals if fine is None else checkpointed(totals)
    sums = {r[0]: r[1] for r in totals.groupBy("__coarse").agg(F.sum("__rows")).collect()}
    sizes = [sums.get(i, 0) for i in range(len(found.boundaries) + 1)]
    start_of = F.from_json(F.lit(str([0, *accumulate(sizes)][:-1])), "array<bigint>")
    start = F.get(start_of, F.col("__coarse"))
    if fine is not None:
        placed = _in_ranges(df, found, _with_starts(fine, totals), each)
        placed = placed.withColumn("__start", F.get("__starts", F.col("__fine"))).drop("__starts")
        start += F.col("__start")

    in_range = Window.partitionBy("__coarse", "__fine").orderBy(*columns, *ties)
    if weight is None:
        position = F.row_number().over(in_range).cast("bigint") - 1
    else:
        running = in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        position = F.sum(weight).over(running) - F.col(weight)
    ordered = placed.withColumn(name, position + start)
    return ordered.select(*[F.col(f"`{c}`") for c in df.columns], name)


def global_rank(
    df: DataFrame,
    order_cols: Sequence[str],
    name: str = "rank",
    unique: bool = True,
    rows_per_range: int | None = None,
) -> DataFrame:
    """Add the dense 0-based position of each row in the order of ``order_cols``.

    The work is one shuffle by range. The order columns should identify a row. Where they do
    not, pass ``unique=False``: rows that tie are ordered by their other columns, and equal
    rows are counted before the shuffle and expanded after it, so that neither a frequent key
    nor a frequent row ends up in one task. ``rows_per_range`` is what a task sorts at a time.
    """
    if unique:
        return _ranked(df, list(order_cols), name, None, rows_per_range=rows_per_range)
    others = [c for c in df.columns if c not in order_cols]
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies"))
    tie = F.xxhash64(*[F.col(c) for c in others]) if others else F.lit(0)
    keyed = copies.withColumn("__tie", tie)
    ranked = _ranked(keyed, [*order_cols, "__tie"], name, "__copies", others, rows_per_range)
    return _expand_copies(ranked, name).select(*df.columns, name)


def weighted_rank(df: DataFrame, order_cols: Sequence[str], name: str, weight: str) -> DataFrame:
    """Add the sum of ``weight`` over all rows before a row; the order columns identify it."""
    return _ranked(df, list(order_cols), name, weight)


def _expand_copies(ranked: DataFrame, name: str, chunk: int = 1_000_000) -> DataFrame:
    """Number the ``__copies`` equal rows from ``name`` on.

    Rows are unfolded where they are; only those with more copies than a chunk are cut into
    chunks that spread over the tasks.
    """
    last = F.col(name) + F.col("__copies") - 1
    spread = ranked.withColumn("__last", last)

    def unfold(rows: DataFrame, first: Column, upto: Column) -> DataFrame:
        return rows.withColumn(name, F.explode(F.sequence(first, upto))).drop("__from")

    few = unfold(spread.filter(F.col("__copies") <= chunk), F.col(name), F.col("__last"))
    starts = F.explode(F.sequence(F.col(name), F.col("__last"), F.lit(chunk)))
    cut = spread.filter(F.col("__copies") > chunk).withColumn("__from", starts)
    upto = F.least(F.col("__last"), F.col("__from") + chunk - 1)
    many = unfold(cut.repartition("__from", name), F.col("__from"), upto)
    return few.unionByName(many)


def row_keys(df: DataFrame, name: str = "row_key") -> DataFrame:
    """Add a key that identifies each row of a table that has none.

    The key is a digest of the row and, for equal rows, a number. It depends on the rows
    alone, not on how they are partitioned. Equal rows are counted before the shuffle.
    """
    # Whole microseconds, or rows that differ in them alone would get one digest.
    exact = {f: "yyyy-MM-dd'T'HH:mm:ss.SSSSSS" for f in ("timestampFormat", "timestampNTZFormat")}
    digest = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), exact))
    copies = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(
        F.count(F.lit(1)).alias("__copies")
    )
    numbered = _expand_copies(copies.withColumn("__copy", F.lit(0).cast("bigint")), "__copy")
    key = F.concat_ws(":", digest, F.col("__copy"))
    return numbered.withColumn(name, key).select(*[F.col(f"`{c}`") for c in df.columns], name)


def with_id(
    df: DataFrame, order_cols: Sequence[str], name: str = "Id", unique: bool = True
) -> DataFrame:
    """Put a dense 0-based id in front, in the order of ``order_cols``."""
    ranked = global_rank(df, order_cols, name, unique)
    return ranked.select(name, *df.columns)


def value_at(df: DataFrame, order_cols: Sequence[str], position: int, rows: int) -> list[str | None]:
    """Order columns, as strings, of the row at a 0-based position; no full sort.

    Each step counts rows per range and goes on with the one range that holds the position,
    until it is small enough for a top-k.
    """
    columns = list(order_cols)
    part = df.select(*columns)
    as_text = [F.col(c).cast("string").alias(c) for c in columns]
    while rows > SMALL_ROWS:
        found = find_ranges(part, columns, rows, range_count(part, rows))
        totals = _range_totals(part, found)
        for index in range(len(found.boundaries) + 1):
            size = totals.get(index, 0)
            if position < size:
                break
            position -= size
        if size == rows:
            # The sample saw a single key. It begins this part: take its rows off as a whole.
            key = key_struct(columns)
            first = part.select(key.alias("key")).agg(F.min("key").alias("key"))
            text = first.select("key.*").select(*as_text).first()
            literal = F.struct(
                *[typed_literal(text[c], part.schema[c].dataType).alias(c) for c in columns]
            )
            same = part.filter(key <= literal).count()
            if position < same:
                return list(text)
            part, rows, position = part.filter(key > literal), rows - same, position - same
            continue
        part, rows = part.filter(found.inside(index)), size
    return list(part.orderBy(*columns).offset(position).limit(1).select(*as_text).first())


def group_rank(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[str],
    name: str = "ordinal",
    size: str | None = None,
) -> DataFrame:
    """0-based position of each row within its group; a group may span many tasks.

    With ``size`` the number of rows of the group is added under that name.

    ``group_cols + order_cols`` should identify a row; null is a group of its own. The rank is
    the global position minus the group's first position, which comes from a map-side minimum.
    """
    ranked = global_rank(df, [*group_cols, *order_cols], name)
    # A struct is never null itself, so null groups meet their own start.
    ranked = ranked.withColumn("__group", F.struct(*[F.col(c) for c in group_cols]))
    starts = ranked.groupBy("__group").agg(
        F.min(name).alias("__start"), F.count(F.lit(1)).alias("__size")
    )
    joined = join_unique(ranked, starts, ["__group"])
    sizes = [F.col("__size").alias(size)] if size else []
    return joined.select(*df.columns, (F.col(name) - F.col("__start")).alias(name), *sizes)
