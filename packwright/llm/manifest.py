"""A Merkle manifest of a table: one root, and for every row a proof that leads to it.

A leaf is the digest of a row's fields. Leaves of a source, in the order of their ids, are hashed
three by three, level by level, to a subroot; subroots in the order of their sources are hashed in
the same way to the root. Digests enter further hashes as hex text.

Trees are built from blocks of ``BLOCK`` nodes, each hashed over six levels where it is, so that
a source of any size spreads over all tasks. Proofs come by pointer jumping. Every node begins
with the siblings of its own run, the segment towards its parent. In each round a node appends
the segment that the ancestor it points to holds, and points to where that one points: distances
double, and a join or two suffices for a depth of thousands of millions. After the round for
distance ``s``, only nodes on levels that ``2 s`` divides are asked again, so the table that is
joined shrinks fast, and its keys are hot only where it is so small that Spark sends it to all.

A null source is a source of its own, the first; a null id comes first and is never tampered
with; any other null field counts as ``-``. Rows with equal ids are ordered by their leaves, and
equal rows are leaves of their own. Long texts are hashed whole. Columns that are not named do not
count, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packwright.llm.components import Scratch, stored

#: Nodes of a run, and levels and nodes of a block.
ARITY, HEIGHT = 3, 6
BLOCK = ARITY**HEIGHT

_SEGMENT = "array<struct<l: binary, r: binary>>"
_NODE = ["tree", "level", "idx", "depth", "up", "path", "subroot", "root", "mark"]


def _field(column: Column) -> Column:
    text = column.cast("string")
    return F.when(column.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _hash(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf(columns: Sequence[Column]) -> Column:
    """Hex digest of a row's fields, in this order."""
    return _hash(*[_field(c) for c in columns])


def _placed(leaves: DataFrame, scratch: Scratch) -> DataFrame:
    """Leaves with their position ``idx`` in their tree and its size ``n``.

    One shuffle by range; equal rows are spread by their row number. A tree has at most one
    count per task, from which its parts get their first positions.
    """
    numbered = leaves.withColumn("rid", F.monotonically_increasing_id())
    ordered = numbered.repartitionByRange("tree", "mark.doc_id", "digest", "rid").sortWithinPartitions("tree", "mark.doc_id", "digest", "rid")
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = scratch.stored(ordered.select("tree", "mark", "digest", F.spark_partition_id().alias("task"), in_task.alias("at")))
    parts = rows.groupBy("tree", "task").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    starts = parts.selectExpr(
        "tree", "task", "sum(rows) over (partition by tree order by task) - rows - first as shift", "sum(rows) over (partition by tree) as n"
    )
    return rows.join(starts, ["tree", "task"]).select("tree", (F.col("at") + F.col("shift")).alias("idx"), "n", "digest", "mark")


def _levels(nodes: DataFrame) -> DataFrame:
    """Blocks of ``nodes`` with the digests of their levels as ``d0`` to ``d6``.

    A level ends a tree where only one node of it remains; deeper arrays are then empty.
    """
    members = F.sort_array(F.collect_list(F.struct("idx", "digest", "mark")))
    blocks = nodes.groupBy("tree", "n", (F.col("idx") / BLOCK).cast("bigint").alias("block")).agg(members.alias("members"))
    blocks = blocks.withColumn("d0", F.col("members.digest"))
    for k in range(HEIGHT):
        more = (F.size(f"d{k}") > 0) & (F.ceil(F.col("n") / ARITY**k) > 1)
        blocks = blocks.withColumn(f"d{k + 1}", F.when(more, _parents(f"d{k}")).otherwise(F.array().cast("array<binary>")))
    return blocks


def _parents(level: str) -> Column:
    """Digests of the runs of a level."""
    runs = F.sequence(F.lit(0), F.ceil(F.size(level) / ARITY).cast("int") - 1)
    return F.transform(runs, lambda i: F.unhex(F.sha2(_joined_hex(F.slice(level, i * ARITY + 1, ARITY)).cast("binary"), 256)))


def _joined_hex(digests: Column) -> Column:
    return F.array_join(F.transform(digests, _hex), "")


def _joined(digests: Column) -> Column:
    """Digests one after the other, as bytes."""
    return F.unhex(_joined_hex(digests))


def _block_nodes(blocks: DataFrame, base: int, most: int) -> DataFrame:
    """Every node of the blocks that has a parent there, with the siblings of its run and the depth of its tree."""

    def level(k: int) -> Column:
        digests, above = f"d{k}", F.size(f"d{k + 1}") > 0
        places = F.when(above, F.sequence(F.lit(0), F.size(digests) - 1)).otherwise(F.array().cast("array<int>"))

        def node(i: Column) -> Column:
            start = (i / ARITY).cast("int") * ARITY
            run = F.struct(_joined(F.slice(digests, start + 1, i - start)).alias("l"), _joined(F.slice(digests, i + 2, start + ARITY - 1 - i)).alias("r"))
            mark = F.get(F.col("members.mark"), i) if k == 0 and base == 0 else F.lit(None)
            return F.struct(
                F.lit(base + k).alias("level"),
                (F.col("block") * ARITY ** (HEIGHT - k) + i).alias("idx"),
                run.alias("run"),
                mark.cast(_MARK).alias("mark"),
            )

        return F.transform(places, node)

    found = blocks.select("tree", (base + _depth(F.col("n"), most)).alias("depth"), F.explode(F.concat(*[level(k) for k in range(HEIGHT)])).alias("node"))
    return found.select("tree", "depth", "node.*")


_MARK = "struct<doc_id: bigint, leaf: binary, tampered: binary>"


def _depth(size: Column, most: int) -> Column:
    """Levels above the leaves of a tree of this many leaves, ``most`` at most."""
    powers = F.array(*[F.lit(ARITY**k) for k in range(most)])
    return F.size(F.filter(powers, lambda p: p < size)) if most else F.lit(0)


def _most_levels(size: int) -> int:
    levels = 0
    while ARITY**levels < size:
        levels += 1
    return levels


def build(leaves: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame, int]:
    """``(nodes, roots, depth)`` of all trees over placed leaves ``(tree, idx, n, digest, mark)``.

    Nodes hold the segment towards their parent, roots the digest of each tree.
    """
    largest = leaves.agg(F.max("n")).first()[0] or 0
    deepest = _most_levels(largest)
    tops, nodes, base, now = [], [], 0, leaves
    while True:
        tops.append(now.where("n = 1").select("tree", "digest", F.lit(base).alias("depth"), "mark"))
        if largest <= 1:
            break
        blocks = scratch.stored(_levels(now.where("n > 1")))
        nodes.append(_block_nodes(blocks, base, _most_levels(largest)))
        for k in range(1, HEIGHT):
            ends = (F.col("n") > ARITY ** (k - 1)) & (F.col("n") <= ARITY**k)
            tops.append(blocks.where(ends).select("tree", F.get(f"d{k}", F.lit(0)).alias("digest"), F.lit(base + k).alias("depth"), F.lit(None).cast(_MARK).alias("mark")))
        above = blocks.where(F.col("n") > ARITY ** (HEIGHT - 1))
        now = above.select(
            "tree", F.col("block").alias("idx"), F.ceil(F.col("n") / BLOCK).alias("n"), F.get(f"d{HEIGHT}", F.lit(0)).alias("digest"), F.lit(None).cast(_MARK).alias("mark")
        )
        base, largest = base + HEIGHT, -(-largest // BLOCK)
    roots = reduce(DataFrame.unionByName, tops)
    if not nodes:
        return _no_nodes(leaves), roots, deepest
    found = reduce(DataFrame.unionByName, nodes)
    return found.select(*_first_pointers(F.array(F.col("run")))), roots, deepest


def _first_pointers(path: Column) -> list[Column]:
    nothing = [F.lit(None).cast("binary").alias(c) for c in ("subroot", "root")]
    return ["tree", "level", "idx", "depth", (F.col("level") + 1).alias("up"), path.cast(_SEGMENT).alias("path"), *nothing, "mark"]


def _no_nodes(leaves: DataFrame) -> DataFrame:
    empty = leaves.where(F.lit(False)).select("tree", "idx", F.lit(0).alias("level"), F.lit(0).alias("depth"), "mark")
    return empty.select(*_first_pointers(F.array()))


def jump(nodes: DataFrame, terminals: DataFrame, depth: int, scratch: Scratch) -> DataFrame:
    """Leaves with their whole path; ``terminals`` are the trees' roots, which point beyond them.

    A node that points beyond its tree's root (``up > depth``) is done.
    """
    now, step = nodes.select(*_NODE).unionByName(terminals.select(*_NODE)), 1
    while step <= depth:
        now = scratch.stored(now)
        left = now.where(F.col("level") % (2 * step) == 0)
        right = now.where(F.col("level") % (2 * step) == step)
        right = right.select("tree", F.col("level").alias("up"), F.col("idx").alias("above"), F.col("up").alias("to"), F.col("path").alias("on"), F.col("subroot").alias("s"), F.col("root").alias("t"))
        open_ = left.where("up <= depth").withColumn("above", (F.col("idx") / F.lit(ARITY**step)).cast("bigint"))
        further = open_.join(right, ["tree", "up", "above"]).select(
            "tree", "level", "idx", "depth", F.col("to").alias("up"), F.concat("path", "on").alias("path"), F.col("s").alias("subroot"), F.col("t").alias("root"), "mark"
        )
        now, step = left.where("up > depth").unionByName(further), step * 2
    return now.where("level = 0")


def _terminals(roots: DataFrame, path: Column, subroot: Column, root: Column) -> DataFrame:
    return roots.select(
        "tree",
        F.col("depth").alias("level"),
        F.lit(0).cast("bigint").alias("idx"),
        "depth",
        (F.col("depth") + 1).alias("up"),
        path.cast(_SEGMENT).alias("path"),
        subroot.cast("binary").alias("subroot"),
        root.cast("binary").alias("root"),
        "mark",
    )


def fold(start: Column, path: Column) -> Column:
    """Root, as hex text, that a leaf and its siblings lead to."""
    return F.aggregate(path, start, lambda now, run: F.sha2(F.concat(_hex(run["l"]), now, _hex(run["r"])).cast("binary"), 256))


def proofs(df: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), text_col: str = "text", tamper: Column | None = None) -> DataFrame:
    """``(id_col, leaf, subroot, root, path, tampered)`` of every row.

    ``path`` holds, from the leaf upward, the siblings to the left and to the right in each run.
    ``tampered`` is the leaf of the row where ``tamper`` holds and line breaks are deleted from
    the text, else the leaf itself. All digests but ``path`` are hex text.
    """
    spark = df.sparkSession
    scratch = Scratch(spark)
    named = {c: F.col(f"`{c}`") for c in dict.fromkeys([*fields, id_col, group_col, text_col])}
    broken = {**named, text_col: F.replace(named[text_col], F.lit("\n"), F.lit(""))}
    changed = F.lit(False) if tamper is None else F.coalesce(tamper, F.lit(False))
    rows = df.select(
        F.coalesce(F.concat(F.lit("s"), named[group_col].cast("string")), F.lit("")).alias("tree"),
        named[id_col].cast("bigint").alias("doc_id"),
        F.unhex(leaf([named[c] for c in fields])).alias("leaf"),
        F.when(changed, F.unhex(leaf([broken[c] for c in fields]))).alias("tampered"),
    )
    rows = scratch.stored(rows.select("tree", F.struct("doc_id", "leaf", "tampered").alias("mark"), F.col("leaf").alias("digest")))
    nodes, roots, depth = build(scratch.stored(_placed(rows, scratch)), scratch)
    roots = scratch.stored(roots)

    # The tree over sources: its leaves are the subroots, in the order of the sources.
    tops = roots.select(F.lit("").alias("tree"), F.struct(F.col("tree").alias("source"), "digest", "depth", "mark").alias("kept"), "digest")
    sources = scratch.stored(_ranked_sources(tops))
    upper, top, high = build(sources.select("tree", "idx", "n", "digest", F.lit(None).cast(_MARK).alias("mark")), scratch)
    # One row, the root; of an empty table there is none.
    top = scratch.stored(top)
    ends = _terminals(top, F.array(), F.lit(None), F.col("digest"))
    above = jump(upper, ends, high, scratch).select("idx", F.col("path").alias("onward"), F.col("root").alias("total"))
    ends = sources.join(above, "idx").select(F.col("kept.source").alias("tree"), "kept.depth", "kept.mark", "digest", "onward", "total")
    ends = _terminals(ends, F.col("onward"), F.col("digest"), F.col("total"))
    found = jump(nodes, ends, depth, scratch)
    result = found.select(
        F.col("mark.doc_id").alias(id_col),
        _hex(F.col("mark.leaf")).alias("leaf"),
        _hex(F.col("subroot")).alias("subroot"),
        _hex(F.col("root")).alias("root"),
        "path",
        _hex(F.coalesce("mark.tampered", "mark.leaf")).alias("tampered"),
    )
    kept = stored(result)
    scratch.clear()
    return kept


def _ranked_sources(tops: DataFrame) -> DataFrame:
    """Subroots with the rank of their source; one shuffle by range, as for leaves."""
    ordered = tops.repartitionByRange("kept.source").sortWithinPartitions("kept.source")
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = stored(ordered.select("tree", "kept", "digest", F.spark_partition_id().alias("task"), in_task.alias("at")))
    parts = rows.groupBy("task").agg(F.count(F.lit(1)).alias("rows"))
    starts = parts.selectExpr("task", "sum(rows) over (order by task) - rows as shift", "sum(rows) over () as n")
    return rows.join(starts, "task").select("tree", (F.col("at") + F.col("shift")).alias("idx"), "n", "digest", "kept")


def manifest(df: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), text_col: str = "text", tamper: Column | None = None) -> DataFrame:
    """``(id_col, leaf, subroot, root, proof_sha256, folded_root, verified)`` of every row.

    ``proof_sha256`` is the digest of all siblings on the way to the root, ``folded_root`` what
    the tampered leaf and the original siblings lead to.
    """
    found = proofs(df, id_col, group_col, fields, text_col, tamper)
    siblings = F.array_join(F.transform("path", lambda run: F.concat(_hex(run["l"]), _hex(run["r"]))), "")
    digest = F.sha2(siblings.cast("binary"), 256).alias("proof_sha256")
    folded = found.select(id_col, "leaf", "subroot", "root", digest, fold(F.col("tampered"), F.col("path")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def sql(crc32: str) -> str:
    """DuckDB SQL for :func:`manifest` of ``documents``; ``crc32`` is SQL for the checksum of ``doc_id``."""

    def field(name: str) -> str:
        return f"coalesce(strlen(CAST({name} AS VARCHAR)) || ':' || {name}, '-')"

    def digest(text: str) -> str:
        return "sha256(" + " || ".join(field(c) if c != "text" else field(text) for c in ("doc_id", "source", "lang", "n_chars", "text")) + ")"

    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('s' || source, '') AS tree, {digest("text")} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {crc32} % 2 = 0 THEN {digest("replace(text, chr(10), '')")} ELSE {digest("text")} END AS tampered FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM d),
low(tree, level, idx, digest) AS (
  SELECT tree, 0, idx, leaf FROM leaves
  UNION ALL
  SELECT tree, level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM low) WHERE n > 1 GROUP BY tree, level, idx // 3),
depths AS (SELECT tree, max(level) AS depth FROM low GROUP BY tree),
tops AS (SELECT tree, digest, depth, row_number() OVER (ORDER BY tree) - 1 AS rank FROM low JOIN depths USING (tree) WHERE level = depth),
high(level, idx, digest) AS (
  SELECT 0, rank, digest FROM tops
  UNION ALL
  SELECT level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER () AS n FROM high) WHERE n > 1 GROUP BY level, idx // 3),
total AS (SELECT level AS height, digest AS root FROM high ORDER BY level DESC LIMIT 1),
sides AS (
  SELECT a.tree, a.level, a.idx, coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
    coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM low a JOIN low b ON a.tree = b.tree AND a.level = b.level AND a.idx // 3 = b.idx // 3 GROUP BY ALL),
upper AS (
  SELECT a.level, a.idx, coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
    coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM high a JOIN high b ON a.level = b.level AND a.idx // 3 = b.idx // 3 GROUP BY ALL),
steps AS (
  SELECT x.tree, x.idx, s.level AS step, s.l, s.r
  FROM leaves x JOIN depths USING (tree) JOIN sides s ON s.tree = x.tree AND s.idx = x.idx // CAST(pow(3, s.level) AS BIGINT) AND s.level < depth
  UNION ALL
  SELECT x.tree, x.idx, t.depth + u.level, u.l, u.r
  FROM leaves x JOIN tops t USING (tree) JOIN total ON true JOIN upper u ON u.idx = t.rank // CAST(pow(3, u.level) AS BIGINT) AND u.level < height),
folded(tree, idx, step, now) AS (
  SELECT tree, idx, 0, tampered FROM leaves
  UNION ALL
  SELECT f.tree, f.idx, f.step + 1, sha256(s.l || f.now || s.r) FROM folded f JOIN steps s USING (tree, idx, step)),
paths AS (SELECT tree, idx, sha256(string_agg(l || r, '' ORDER BY step)) AS proof_sha256 FROM steps GROUP BY tree, idx)
SELECT x.doc_id, x.leaf, t.digest AS subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, now AS folded_root, now = root AS verified
FROM leaves x JOIN tops t USING (tree) JOIN total ON true LEFT JOIN paths p ON p.tree = x.tree AND p.idx = x.idx
JOIN (SELECT tree, idx, now FROM folded QUALIFY step = max(step) OVER (PARTITION BY tree, idx)) f ON f.tree = x.tree AND f.idx = x.idx"""
