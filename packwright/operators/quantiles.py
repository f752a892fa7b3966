"""Exact quantiles of large columns from mergeable sketches and counts.

An exact percentile aggregate keeps every distinct value of a column in one buffer. Here a KLL
sketch per column, made in the same scan as the column's moments, proposes an interval around each
wanted rank. The next scan counts what lies below, in and at the ends of all intervals, which
proves where each rank is, whatever the sketch said. An interval of few values is listed; of many
values, the counting scan makes a sketch as well, so that each further scan narrows it several
hundredfold. All ranks of a column share each scan of it, all columns a job, and frequent
values end up as ends of intervals, where they are only counted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values at which the search ends with a list; the result is the same at any number.
LIST_VALUES = 20_000
#: Size of a sketch, and the share of ranks by which an end lies beyond the wanted rank.
SKETCH_SIZE, MARGIN = 4096, 0.002
#: Ranks at which the sketch of an interval is read.
GRID = 1024
COLUMNS_PER_PASS = 16


@dataclass
class _Interval:
    """Values of a column strictly between two ends, and the wanted positions among them."""

    column: str
    size: int
    positions: dict[int, int]  # position among these values -> position in the column
    low: float | None = None
    high: float | None = None
    grid: Sequence[float] = ()  # values at even ranks, from the interval's sketch

    def inside(self) -> Column:
        return self.within(present(self.column))

    def within(self, value: Column) -> Column:
        """The value where it lies in the interval."""
        predicate = value.isNotNull()
        if self.low is not None:
            predicate &= value > self.low
        if self.high is not None:
            predicate &= value < self.high
        return F.when(predicate, value)

    def clusters(self) -> list[list[int]]:
        """Wanted positions, neighbours together: they share one pair of ends."""
        found: list[list[int]] = []
        for position in sorted(self.positions):
            if found and position - found[-1][-1] <= 1:
                found[-1].append(position)
            else:
                found.append([position])
        return found

    def ends(self) -> list[tuple[float, float]]:
        """A pair of ends around each cluster, read from the grid."""
        steps, found = len(self.grid) - 1, []
        for cluster in self.clusters():
            low = int((cluster[0] / self.size - MARGIN) * steps)
            high = int(((cluster[-1] + 1) / self.size + MARGIN) * steps) + 1
            found.append((self.grid[min(max(low, 0), steps)], self.grid[min(max(high, 0), steps)]))
        return found


def present(column: str) -> Column:
    """The column as a double, NaN counting as missing."""
    value = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(value), value)


def sketch_grid(value: Column) -> Column:
    """Values at ``GRID + 1`` even ranks, from a mergeable sketch; null without values."""
    # One literal text: a literal per rank would take longer than the scan.
    ranks = F.expr(f"array({', '.join(f'{i / GRID!r}D' for i in range(GRID + 1))})")
    sketch = F.kll_sketch_agg_double(value, F.lit(SKETCH_SIZE))
    return F.when(F.count(value) > 0, F.kll_sketch_get_quantile_double(sketch, ranks))


def _each(parts: Sequence[DataFrame]) -> list[dict]:
    """One-row results of one job; each part reads its own column only, in code of its own."""
    if not parts:
        return []
    numbered = [part.withColumn("i", F.lit(i)) for i, part in enumerate(parts)]
    rows = reduce(DataFrame.unionByName, numbered).collect()
    return [r.asDict() for r in sorted(rows, key=lambda r: r["i"])]


def moments_and_sketches(df: DataFrame, columns: Sequence[str]) -> list[dict]:
    """Count, mean, sample deviation, minimum, maximum and grid of every column, from one scan of each."""
    found = []
    for start in range(0, len(columns), COLUMNS_PER_PASS):
        parts = [
            df.select(present(c).alias("v")).agg(
                F.count("v").alias("count"),
                F.avg("v").alias("mean"),
                F.stddev_samp("v").alias("std"),
                F.min("v").alias("min"),
                F.max("v").alias("max"),
                sketch_grid(F.col("v")).alias("grid"),
            )
            for c in columns[start : start + COLUMNS_PER_PASS]
        ]
        found += _each(parts)
    return found


def _narrow(interval: _Interval, ends, regions: dict, answers: dict) -> list[_Interval]:
    """Settle the positions that fall on an end; the others go on in a smaller interval.

    ``regions`` has the count and the grid of each region between and at the sorted ends: region
    ``2 i`` lies below end ``i``, region ``2 i + 1`` at it.
    """
    smaller: dict[tuple, _Interval] = {}
    borders = [interval.low, *ends, interval.high]
    for position, wanted in interval.positions.items():
        region, before = 0, 0
        while position >= before + regions[region][0]:
            before += regions[region][0]
            region += 1
        if region % 2:
            answers[interval.column, wanted] = ends[region // 2]
            continue
        size, grid = regions[region]
        low, high = borders[region // 2], borders[region // 2 + 1]
        part = smaller.setdefault((low, high), _Interval(interval.column, size, {}, low, high, grid or ()))
        part.positions[position - before] = wanted
    return list(smaller.values())


def _counted(df: DataFrame, large: list[_Interval], list_values: int, answers: dict) -> list[_Interval]:
    """One scan: counts in all regions, and sketches of those that are too much to list."""
    parts, ends = [], [sorted({e for pair in i.ends() for e in pair}) for i in large]
    value = F.col("v")
    for interval, borders in zip(large, ends):
        counts = [(F.count_if(value < e), F.count_if(value <= e)) for e in borders]
        wanted = [F.array(*[c for pair in counts for c in pair]).alias("counts")]
        # A pair of ends holds at most about this share of the values.
        many = (2 * MARGIN + 3 / GRID) * interval.size > list_values
        between = [F.when((value > low) & (value < high), value) for low, high in zip(borders, borders[1:])] if many else []
        wanted.append(F.array(*[sketch_grid(b) for b in between]).cast("array<array<double>>").alias("grids"))
        parts.append(df.select(interval.inside().alias("v")).agg(*wanted))
    smaller = []
    for interval, borders, row in zip(large, ends, _each(parts)):
        edges = [0, *row["counts"], interval.size]
        regions = {i: (high - low, None) for i, (low, high) in enumerate(zip(edges, edges[1:]))}
        for i, grid in enumerate(row["grids"]):
            regions[2 * i + 2] = regions[2 * i + 2][0], grid
        smaller += _narrow(interval, borders, regions, answers)
    return smaller


def _listed(df: DataFrame, small: list[_Interval], answers: dict) -> None:
    """One scan: the values of small intervals, and the wanted ones among them."""
    groups = [[i for i in small if i.column == c] for c in dict.fromkeys(i.column for i in small)]
    parts = []
    for group in groups:
        rows = df.select(present(group[0].column).alias("v")).agg(
            *[F.sort_array(F.collect_list(part.within(F.col("v")))).alias(f"values{k}") for k, part in enumerate(group)]
        )
        wanted = [F.array(*[F.get(f"values{k}", F.lit(p)) for p in part.positions]) for k, part in enumerate(group)]
        parts.append(rows.select(F.array(*wanted).alias("chosen")))
    for group, row in zip(groups, _each(parts)):
        for part, values in zip(group, row["chosen"]):
            for place, value in zip(part.positions.values(), values):
                answers[part.column, place] = value


def _search(df: DataFrame, intervals: list[_Interval], list_values: int) -> dict:
    """Value at every wanted position, by (column, position)."""
    answers: dict[tuple[str, int], float] = {}
    small = []
    while intervals:
        small += [i for i in intervals if i.size <= list_values]
        large = [i for i in intervals if i.size > list_values]
        without = [i for i in large if not i.grid]
        if without:
            # A rank outside its ends, as a sketch may have it: look at what is left there.
            parts = [df.select(i.inside().alias("v")).agg(sketch_grid(F.col("v")).alias("grid")) for i in without]
            for interval, row in zip(without, _each(parts)):
                interval.grid = row["grid"]
        intervals = _counted(df, large, list_values, answers) if large else []
    if small:
        _listed(df, small, answers)
    return answers


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    shares: Sequence[float],
    list_values: int = LIST_VALUES,
    sketched: Sequence[dict] | None = None,
) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation per column; null and NaN values do not count.

    ``sketched`` is what :func:`moments_and_sketches` has found, where the caller has it.
    """
    result: dict[str, list[float | None]] = {}
    for start in range(0, len(columns), COLUMNS_PER_PASS):
        group = list(columns[start : start + COLUMNS_PER_PASS])
        part = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys(group)])
        known = moments_and_sketches(part, group) if sketched is None else sketched[start : start + COLUMNS_PER_PASS]
        known = [(k["count"], k["grid"]) for k in known]
        intervals, wanted = [], []
        for column, (size, grid) in zip(group, known):
            result[column] = []
            if size == 0:
                continue
            places = [(size - 1) * share for share in shares]
            wanted += [(column, place, size) for place in places]
            neighbours = {min(int(p) + step, size - 1) for p in places for step in (0, 1)}
            intervals.append(_Interval(column, size, {p: p for p in neighbours}, grid=grid))
        answers = _search(part, intervals, list_values)
        for column, place, size in wanted:
            low = answers[column, int(place)]
            high = answers[column, min(int(place) + 1, size - 1)]
            result[column].append(low if low == high else low + (high - low) * (place - int(place)))
        for column, (size, _) in zip(group, known):
            if size == 0:
                result[column] = [None] * len(shares)
    return result
