"""Exact, repeatable train/test splits.

Sizes follow the usual rule that the test side is rounded up to ``ceil(0.2 n)``. Membership
is decided by comparing each row with one cut value, so the split itself is a narrow pass
over the table: no shuffle and no sort of the full rows. The cut values are found from
counts, which are combined before any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from packwright.operators.joins import join_unique
from packwright.operators.rank import (
    SMALL_ROWS,
    group_rank,
    key_struct,
    row_keys,
    typed_literal,
    value_at,
)
from packwright.sources.checkpoints import checkpointed

TRAIN, TEST = "train", "test"
NOT_STRATIFIED = "not_stratified"
SEED = 42
PREFIX = 4  # hex digits per level: at most 65,536 counts reach the driver
HASH_DIGITS = 32


def split_hash(key: str, seed: int = SEED) -> Column:
    """Hash that decides membership: the same row always gets the same value."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))


def test_size(rows: int) -> int:
    """Rows on the test side: a fifth, rounded up."""
    return (rows + 4) // 5


test_size.__test__ = False


def _side(is_test: Column) -> Column:
    return F.when(is_test, TEST).otherwise(TRAIN)


def _hash_cut(keys: DataFrame, key: str, seed: int) -> str | None:
    """Largest hash on the test side, found by descending through hash prefixes."""
    hashed = keys.select(split_hash(key, seed).alias("h"))
    prefix, wanted, size = "", None, -1
    while True:
        part = hashed.filter(F.startswith("h", F.lit(prefix))) if prefix else hashed
        digits = F.substring("h", len(prefix) + 1, PREFIX).alias("digits")
        counts = part.groupBy(digits).agg(F.count(F.lit(1)).alias("rows")).collect()
        if wanted is None:
            wanted = test_size(sum(row["rows"] for row in counts))
            if wanted == 0:
                return None
        for row in sorted(counts, key=lambda r: r["digits"]):
            if wanted <= row["rows"]:
                break
            wanted -= row["rows"]
        prefix += row["digits"]
        if len(prefix) >= HASH_DIGITS:
            return prefix
        if row["rows"] == size:  # nothing was set apart: perhaps one repeated key
            ends = part.agg(F.min("h"), F.max("h")).first()
            if ends[0] == ends[1]:
                return ends[0]
        size = row["rows"]
        if row["rows"] <= SMALL_ROWS:
            last = hashed.filter(F.startswith("h", F.lit(prefix))).orderBy("h")
            return last.offset(wanted - 1).limit(1).first()["h"]


def random_split(df: DataFrame, key: str, seed: int = SEED) -> DataFrame:
    """Add ``split``: a random fifth of the rows, rounded up, is ``test``.

    ``key`` identifies a row. Rows that share a key always fall on the same side; to split a
    repeated key exactly, use :func:`dimension_split`.
    """
    cut = _hash_cut(df.select(key), key, seed)
    is_test = F.lit(False) if cut is None else split_hash(key, seed) <= cut
    return df.withColumn("split", _side(is_test))


def random_row_split(df: DataFrame, seed: int = SEED) -> DataFrame:
    """:func:`random_split` of a table without a key; equal rows may fall on both sides."""
    keyed = row_keys(df, "__key")
    return random_split(keyed, "__key", seed).drop("__key")


def dimension_split(df: DataFrame, dim: str, seed: int = SEED) -> DataFrame:
    """Split the distinct values of ``dim`` at random; rows follow their value."""
    cut = _hash_cut(checkpointed(df.select(dim).distinct()), dim, seed)
    is_test = F.lit(False) if cut is None else split_hash(dim, seed) <= cut
    return df.withColumn("split", _side(is_test))


def label_quotas(counts: DataFrame, label: str) -> DataFrame:
    """Test rows per label, from ``(label, rows)``: proportional, largest remainders first.

    Integer arithmetic only; labels with equal remainders are served in label order.
    """
    total, labels = counts.agg(F.sum("rows"), F.count(F.lit(1))).first()
    total = total or 0
    wanted = test_size(total)
    share = F.col("rows").cast("decimal(38,0)") * wanted
    quotas = counts.withColumn("remainder", (share % max(total, 1)).cast("bigint")).withColumn(
        "base", ((share - F.col("remainder")) / max(total, 1)).cast("bigint")
    )
    left_over = wanted - (quotas.agg(F.sum("base")).first()[0] or 0)
    served = quotas.withColumn("order", -F.col("remainder"))
    if left_over <= 0:
        return served.select(label, "rows", F.col("base").alias("quota"))
    # One more for every label up to the last one that the left-over rows reach.
    last = value_at(served, ["order", label], int(left_over) - 1, labels)
    values = [typed_literal(v, served.schema[c].dataType) for v, c in zip(last, ("order", label))]
    reached = F.struct(*[v.alias(c) for v, c in zip(values, ("order", label))])
    extra = F.when(key_struct(["order", label]) <= reached, 1).otherwise(0)
    return served.select(label, "rows", (F.col("base") + extra).alias("quota"))


def _prefix_counts(hashed: DataFrame, groups: Sequence[str], start: int = 0) -> DataFrame:
    """Rows per group and block of hash digits from ``start`` on."""
    digits = F.substring("h", start + 1, PREFIX).alias("digits")
    return hashed.groupBy(*groups, digits).agg(F.count(F.lit(1)).alias("in_part"))


def _group_cuts(hashed: DataFrame, parts: DataFrame, quotas: DataFrame, groups: Sequence[str]) -> DataFrame:
    """``(groups, __cut)``: largest test hash per group; groups without a quota are absent.

    All groups descend in step through blocks of hash digits: each round counts rows per group
    and block, at most 65,536 counts a group, and goes on with the rows of the one block that
    holds the group's cut, until the block ends with the quota. ``parts`` are the counts of the
    first round. No task orders the rows of a group, however many it has.
    """
    groups = list(groups)
    wanted = quotas.select(*groups, "quota", F.lit("").alias("prefix"))
    order = Window.partitionBy(*groups).orderBy("digits")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found, start = [], 0
    while True:
        before = F.col("upto") - F.col("in_part")
        holds = (F.col("quota") > before) & (F.col("quota") <= F.col("upto"))
        cut_part = parts.withColumn("upto", F.sum("in_part").over(upto)).join(wanted, groups).filter(holds)
        prefix = F.concat("prefix", "digits").alias("prefix")
        cut_part = checkpointed(cut_part.select(*groups, "digits", prefix, "in_part", (F.col("quota") - before).alias("quota")))
        start += PREFIX
        settled = (F.col("in_part") == F.col("quota")) | F.lit(start >= HASH_DIGITS)
        found.append(cut_part.filter(settled).select(*groups, F.rpad("prefix", HASH_DIGITS, "f").alias("__cut")))
        unsettled = cut_part.filter(~settled)
        if unsettled.isEmpty():
            return reduce(DataFrame.unionByName, found)
        digits = F.substring("h", start - PREFIX + 1, PREFIX)
        inside = hashed.withColumn("digits", digits).join(unsettled.select(*groups, "digits"), [*groups, "digits"], "left_semi")
        hashed, wanted = checkpointed(inside.drop("digits")), unsettled.select(*groups, "quota", "prefix")
        parts = _prefix_counts(hashed, groups, start)


def stratified_split(df: DataFrame, key: str, label: str, seed: int = SEED) -> DataFrame:
    """Add ``split`` so that every label contributes its share of the test rows.

    Raises ``ValueError`` when a label is null or has one member, or when there are more
    labels than test rows: such a table cannot be stratified. Rows that share a key stay
    together, so a label's test side is the shortest run of its keys, in hash order, that holds
    its share of rows. The table is read for the counts per label and hash prefix, for the rows
    at the cuts, for the most frequent labels, and for the result.
    """
    hashed = df.select(label, split_hash(key, seed).alias("h"))
    parts = checkpointed(_prefix_counts(hashed, [label]))
    counts = parts.groupBy(label).agg(F.sum("in_part").alias("rows"))
    labels, rows, smallest, nulls = counts.agg(
        F.count(F.lit(1)), F.sum("rows"), F.min("rows"), F.count_if(F.col(label).isNull())
    ).first()
    if not labels:
        return df.withColumn("split", F.lit(TRAIN))
    if nulls:
        raise ValueError(f"cannot stratify: {label} has null values")
    if smallest < 2:
        raise ValueError("cannot stratify: a label has only one member")
    if labels > test_size(rows):
        raise ValueError("cannot stratify: more labels than test rows")
    cuts = checkpointed(_group_cuts(hashed, parts, label_quotas(counts, label), [label]))
    marked = join_unique(df, cuts, [label], "left")
    is_test = F.coalesce(split_hash(key, seed) <= F.col("__cut"), F.lit(False))
    return marked.withColumn("split", _side(is_test)).select(*df.columns, "split")


def ordered_split(df: DataFrame, order_cols: Sequence[str]) -> DataFrame:
    """Add ``split``: the first four fifths in order, rounded down, are ``train``.

    ``order_cols`` identify a row (a file path, for instance).
    """
    rows = df.count()
    if rows == 0:
        return df.withColumn("split", F.lit(TRAIN))
    return df.withColumn("split", _side(~_before_cut(df, list(order_cols), rows)))


def ordered_split_within(df: DataFrame, group: str, order_cols: Sequence[str]) -> DataFrame:
    """:func:`ordered_split` of each group by itself (the files of each dataset, say)."""
    placed = group_rank(df, [group], list(order_cols), "__place", "__rows")
    is_test = F.col("__place") >= F.expr("__rows * 4 div 5")
    return placed.withColumn("split", _side(is_test)).select(*df.columns, "split")


def _before_cut(df: DataFrame, columns: list[str], rows: int) -> Column:
    first_test = value_at(df, columns, rows * 4 // 5, rows)
    values = [typed_literal(v, df.schema[c].dataType) for v, c in zip(first_test, columns)]
    if len(columns) == 1:
        return F.col(columns[0]) < values[0]
    cut = F.struct(*[v.alias(c) for v, c in zip(values, columns)])
    return key_struct(columns) < cut


def _before_time_cut(df: DataFrame, ts: str) -> Column:
    steps = checkpointed(df.select(ts).filter(F.col(ts).isNotNull()).distinct())
    count = steps.count()
    if count < 2:
        raise ValueError("a time split needs at least two time steps")
    return _before_cut(steps, [ts], count)


def time_split(df: DataFrame, ts: str) -> DataFrame:
    """Add ``split``: the first four fifths of the distinct time steps are ``train``.

    Rows without a time lie on no step and stay in ``train``. Raises ``ValueError`` for
    fewer than two steps.
    """
    return df.withColumn("split", _side(~_before_time_cut(df, ts)))


def time_or_dimension_split(
    df: DataFrame, ts: str | None, dim: str, seed: int = SEED
) -> DataFrame:
    """:func:`time_split` where there are two time steps or more, else :func:`dimension_split`.

    ``ts`` is None, or no column, for a table without times.
    """
    if ts is not None and ts in df.columns:
        steps = df.agg(F.min(ts).alias("a"), F.max(ts).alias("b")).first()
        if steps["a"] != steps["b"]:
            return time_split(df, ts)
    return dimension_split(df, dim, seed)


def time_sides(df: DataFrame, ts: str) -> tuple[DataFrame, DataFrame]:
    """(train, test) of :func:`time_split`, as comparisons the scan can use to skip data."""
    before = _before_time_cut(df, ts)
    return df.filter(before | F.col(ts).isNull()), df.filter(~before)


# --- choosing a strategy ---------------------------------------------------------------

# Formats by kind, the file-count threshold and the merge cap.
IMAGE_FORMATS = (".jpg", ".jpeg", ".png", ".bmp")
IMAGE_FILE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".bmp", ".gif")
TABLE_FORMATS = (".csv", ".parquet", ".tsv")
ARRAY_FORMAT = ".nc"
MULTI_FILE_THRESHOLD = 50
MERGE_FILES = 10


def choose_strategy(profile: DataFrame) -> DataFrame:
    """Add ``strategy`` to rows of ``has_source, presplit, primary_format, matching_files``."""
    fmt = F.col("primary_format")
    files = F.coalesce("matching_files", F.lit(0))
    strategy = (
        F.when(~F.coalesce("has_source", F.lit(False)), "skip")
        .when(F.coalesce("presplit", F.lit(False)), "copy_presplit")
        .when(files == 0, "none")
        .when(files > MULTI_FILE_THRESHOLD, "ordered_files")
        .when(fmt.isin(*TABLE_FORMATS), "merge_random")
        .when(fmt == ARRAY_FORMAT, "time_or_dimension")
        .when(fmt.isin(*IMAGE_FORMATS), "stratified_images")
        .otherwise("none")
    )
    return profile.withColumn("strategy", strategy)


def top_files(manifest: DataFrame, k: int = MERGE_FILES, by: str | None = None) -> DataFrame:
    """The ``k`` largest files, overall or per dataset; equal sizes go by path."""
    largest_first = [F.desc("length"), F.col("path")]
    if by is None:
        return manifest.orderBy(*largest_first).limit(k)
    window = Window.partitionBy(by).orderBy(*largest_first)
    return (
        manifest.withColumn("place", F.row_number().over(window))
        .filter(F.col("place") <= k)
    )


def _stratified_images(files: DataFrame, seed: int = SEED) -> DataFrame:
    """Add ``part`` to image files, stratified by parent directory within each dataset.

    Files of a dataset that cannot be stratified (a directory with one image, or more directories
    than test images) get the part ``not_stratified``.
    """
    label = F.substring_index(F.substring_index("path", "/", -2), "/", 1)
    images = files.withColumns({"label": label, "h": split_hash("path", seed)})
    hashed, groups = images.select("dataset", "label", "h"), ["dataset", "label"]
    parts = checkpointed(_prefix_counts(hashed, groups))
    cells = parts.groupBy(*groups).agg(F.sum("in_part").alias("rows"))
    every = Window.partitionBy("dataset")
    cells = cells.withColumn("total", F.sum("rows").over(every))
    cells = cells.withColumn("wanted", F.expr("(total + 4) div 5")).withColumns(
        {
            "base": F.expr("rows * wanted div total"),
            "remainder": F.expr("rows * wanted % total"),
            "possible": (F.min("rows").over(every) > 1)
            & (F.count(F.lit(1)).over(every) <= F.col("wanted")),
        }
    )
    place = F.row_number().over(every.orderBy(F.desc("remainder"), "label"))
    left_over = F.col("wanted") - F.sum("base").over(every)
    quotas = cells.withColumn("quota", F.col("base") + (place <= left_over).cast("int"))
    quotas = checkpointed(quotas.select(*groups, "quota", "possible"))
    cuts = _group_cuts(hashed, parts, quotas.filter("possible"), groups)
    chosen = join_unique(images, quotas.join(cuts, groups, "left"), groups)
    is_test = F.coalesce(F.col("h") <= F.col("__cut"), F.lit(False))
    side = F.when(F.col("possible"), _side(is_test))
    return chosen.withColumn("part", F.coalesce(side, F.lit(NOT_STRATIFIED)))


def split_manifest(manifest: DataFrame, strategies: DataFrame) -> DataFrame:
    """Carry out the strategies that work on files: ``dataset, path, strategy, part``.

    ``manifest`` has ``dataset, path, rel_path, ext, length``; ``strategies`` has ``dataset,
    strategy, primary_format, train_dir, test_dir``. ``part`` is ``train`` or ``test`` for a
    ready-made, ordered or stratified split, ``merge`` for the largest files of a dataset
    whose rows are to be merged and split, and ``not_stratified`` for images whose dataset cannot
    be stratified. Files that play no part are left out.
    """
    facts = ("strategy", "primary_format", "train_dir", "test_dir")
    files = join_unique(manifest, strategies.select("dataset", *facts), ["dataset"])
    top = F.substring_index("rel_path", "/", 1)
    copied = files.filter(F.col("strategy") == "copy_presplit").withColumn(
        "part", F.when(top == F.col("train_dir"), TRAIN).when(top == F.col("test_dir"), TEST)
    )
    matching = files.filter(F.lower("ext") == F.col("primary_format"))
    ordered = ordered_split_within(
        matching.filter(F.col("strategy") == "ordered_files"), "dataset", ["path"]
    ).withColumnRenamed("split", "part")
    merged = top_files(
        matching.filter(F.col("strategy").isin("merge_random", "time_or_dimension")),
        by="dataset",
    ).withColumn("part", F.lit("merge"))
    images = _stratified_images(
        files.filter(
            (F.col("strategy") == "stratified_images")
            & F.lower("ext").isin(*IMAGE_FILE_EXTENSIONS)
        )
    )
    columns = ("dataset", "path", "strategy", "part")
    return (
        copied.filter(F.col("part").isNotNull())
        .select(*columns)
        .unionByName(ordered.select(*columns))
        .unionByName(merged.select(*columns))
        .unionByName(images.select(*columns))
    )


# --- checking a split ------------------------------------------------------------------


def audit_split(df: DataFrame, key: str) -> DataFrame:
    """One row: sizes, test share and the number of keys found on both sides.

    Keys are reduced to one row each before the shuffle, so a frequent key is no burden.
    """
    is_test = F.col("split") == TEST
    per_key = df.groupBy(key).agg(
        F.count_if(is_test).alias("test"), F.count_if(~is_test).alias("train")
    )
    return per_key.agg(
        F.coalesce(F.sum(F.col("test") + F.col("train")), F.lit(0)).alias("n"),
        F.coalesce(F.sum("train"), F.lit(0)).alias("n_train"),
        F.coalesce(F.sum("test"), F.lit(0)).alias("n_test"),
        F.try_divide(F.sum("test"), F.sum(F.col("test") + F.col("train"))).alias("test_share"),
        F.count_if((F.col("test") > 0) & (F.col("train") > 0)).alias("shared_keys"),
    )


def label_drift(df: DataFrame, label: str) -> DataFrame:
    """Per label: sizes and how far its test share lies from the overall test share."""
    is_test = F.col("split") == TEST
    totals = df.agg(F.count(F.lit(1)), F.count_if(is_test)).first()
    overall = totals[1] / totals[0] if totals[0] else 0.0
    share = F.col("n_test") / F.col("n")
    return (
        df.groupBy(label)
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(is_test).alias("n_test"))
        .withColumn("test_share", share)
        .withColumn("drift", share - F.lit(overall))
    )
