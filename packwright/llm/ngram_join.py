"""N-gram Jaccard self-join: exact links between texts, and the classes they form.

A text is the set of its distinct runs of ``words`` words; a shorter text is one run of all its
words. Two texts link when ``percent`` of their union is shared. The join is exact:

1. Runs are ordered by how often their hashed cell occurs in all texts (a table of fixed size),
   rare ones first. Two sets that link share a run among the first ``n - ceil(share * n) + 1`` of
   each, so only those few, rare runs are used as keys; a passage that many texts hold comes last.
2. Texts with equal sets count as one node. Keys are grouped, in packed arrays, by hash. The nodes
   of a key are sorted by size and cut into size bands wherever no pair across the cut could link;
   each band is a tile, and large bands become pairs of blocks. Tiles with equal nodes are one.
3. Every node has a bitmap of hashed runs with four bits a run or more. In a tile, the bits that
   only one of two bitmaps has bound the overlap from above; nodes with no possible partner go, and
   the others fall into clusters of possible partners.
4. The sorted arrays of a cluster's nodes, sent once each, are intersected. A cluster stops comparing
   nodes that are already connected, so thousands of near copies cost no quadratic output.

Tiles run twice: first each node meets the smallest node it shares a key with (most classes close
here), then every tile that still holds nodes of different classes. The clusters of the second run
are joined over all tiles, as two nodes may share many.

Null and empty texts have no set and link with nothing. Rows with a null id keep a null class.
Repeated rows are copies. Runs are 64-bit hashes, and a set is known by a 64-bit hash of its runs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packwright.llm.components import Scratch, components, stored
from packwright.llm.frames import batch, keyed, steps, task_map
from packwright.llm.tables import cell_counts
from packwright.llm.words import Words, cut, mixed, runs

#: Cells of the table of run counts.
CELLS = 1 << 18
#: Keys of one group of the key stage.
KEYS = 1 << 21
#: Keys that occur more often than this are dealt to several groups.
HOT = 1 << 21
#: Nodes and runs of one block of a tile.
BLOCK_NODES, BLOCK_RUNS = 1024, 1 << 20
#: Ids that are broadcast to pick texts; beyond, an ordinary join does it.
BROADCAST_IDS = 1 << 20

_BASE, _SHORT = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
_CELL = np.uint64(64 - CELLS.bit_length() + 1)


def all_runs(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs and where each text's begin; a short text gives one of all its words."""
    starts, codes, _ = runs(words, length)
    counts, sizes = words.counts, np.maximum(words.counts - length + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < length))
    places = np.concatenate([[0], np.cumsum(np.where((counts > 0) & (counts < length), 1, sizes))])
    if not short.size:
        return codes, places
    whole = np.zeros(short.size, np.uint64)
    for i in range(length - 1):
        longer = counts[short] > i
        whole[longer] = whole[longer] * _BASE + words.codes[words.first[short[longer]] + i]
    joined = np.zeros(places[-1], np.uint64)
    alone = np.zeros(places[-1], bool)
    alone[places[short]] = True
    joined[alone], joined[~alone] = mixed(whole + counts[short].astype(np.uint64) * _SHORT), codes
    return joined, places


def sets(column: pa.Array, length: int) -> list[np.ndarray]:
    """The sorted distinct runs of every text."""
    codes, places = all_runs(cut(column, lower=True), length)
    return [np.unique(codes[a:b]) for a, b in zip(places[:-1].tolist(), places[1:].tolist(), strict=True)]


def bitmap(runs_: np.ndarray) -> np.ndarray:
    """Bits of hashed runs, at least four a run, as 64-bit words."""
    width = max(64, 1 << int(4 * runs_.size - 1).bit_length())
    bits = np.zeros(width, bool)
    bits[(runs_ & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").view(np.uint64)


def node_of(runs_: np.ndarray) -> int:
    """The number of a set: a hash of its runs."""
    return xxhash.xxh3_64_intdigest(runs_.tobytes()) - (1 << 63)


def _prefix(own: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    size = own.size + 1 - -(-percent * own.size // 100)
    order = np.minimum(counts[(own >> _CELL).astype(np.int64)], (1 << 20) - 1).astype(np.uint64) << np.uint64(44)
    return own[np.argsort(order | (own >> np.uint64(20)), kind="stable")[:size]]


def _signatures(df: DataFrame, length: int, percent: int, counts: Broadcast) -> DataFrame:
    """``(id, n, node, keys, bits)`` of every row; the last three null without words."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("keys", pa.binary()), ("bits", pa.binary())])

    def run(batches):
        for part in steps(batches):
            found = sets(part.column("text"), length)
            yield batch(
                schema,
                id=part.column("id"),
                n=[s.size for s in found],
                node=[node_of(s) if s.size else None for s in found],
                keys=[_prefix(s, counts.value, percent).tobytes() if s.size else None for s in found],
                bits=[bitmap(s).tobytes() if s.size else None for s in found],
            )

    return task_map(df, run, "id bigint, n bigint, node bigint, keys binary, bits binary")


_PACKED = pa.schema([("part", pa.int64()), ("keys", pa.binary()), ("who", pa.binary()), ("nodes", pa.binary()), ("sizes", pa.binary())])


def _deal(groups: int, counts: Broadcast):
    """Keys of nodes in packed arrays by group."""

    def run(batches):
        for part in steps(batches, 8 << 20, "keys"):
            nodes, sizes = part.column("node").to_numpy(), part.column("n").to_numpy()
            lists = [np.frombuffer(k, np.uint64) for k in part.column("keys").to_pylist()]
            keys, who = np.concatenate(lists), np.repeat(np.arange(len(lists)), [k.size for k in lists])
            often = counts.value[(keys >> _CELL).astype(np.int64)]
            hot = np.flatnonzero(often > HOT)
            if hot.size:  # every pair of blocks of such a key meets in a group of its own
                blocks = -(-often[hot] // HOT)
                mine = (mixed(nodes[who[hot]].view(np.uint64)) >> np.uint64(8)).astype(np.int64) % blocks
                more_keys, more_who = [np.delete(keys, hot)], [np.delete(who, hot)]
                for other in range(int(blocks.max())):
                    use = blocks > other
                    pair = np.minimum(mine, other) * blocks + np.maximum(mine, other)
                    more_keys.append(mixed(keys[hot][use] + pair[use].astype(np.uint64) * _SHORT))
                    more_who.append(who[hot][use])
                keys, who = np.concatenate(more_keys), np.concatenate(more_who)
            own = (mixed(keys) >> np.uint64(16)).astype(np.int64) % groups
            order = np.lexsort((keys, own))
            keys, who, own = keys[order], who[order], own[order]
            cuts = np.flatnonzero(np.diff(own, prepend=-1))
            for a, b in zip(cuts, [*cuts[1:], own.size], strict=True):
                used, local = np.unique(who[a:b], return_inverse=True)
                planes = np.ascontiguousarray(keys[a:b].view(np.uint8).reshape(-1, 8).T).tobytes()
                yield batch(_PACKED, part=[int(own[a])], keys=[planes], who=[local.astype(np.uint32).tobytes()],
                            nodes=[nodes[used].tobytes()], sizes=[sizes[used].tobytes()])

    return run


def bands(nodes: np.ndarray, sizes: np.ndarray, percent: int):
    """Blocks of nodes, by size, such that every pair that can link by size is in one of them."""
    order = np.lexsort((nodes, sizes))
    nodes, sizes = nodes[order], sizes[order]
    cuts = np.flatnonzero(100 * sizes[:-1] < percent * sizes[1:]) + 1
    for a, b in zip([0, *cuts], [*cuts, nodes.size], strict=True):
        if b - a < 2:
            continue
        if b - a <= BLOCK_NODES and sizes[a:b].sum() <= BLOCK_RUNS:
            yield nodes[a:b]
            continue
        block = np.maximum(np.arange(b - a) // BLOCK_NODES, np.cumsum(sizes[a:b]) // BLOCK_RUNS)
        edges = [0, *(np.flatnonzero(np.diff(block)) + 1), b - a]
        parts = [(a + x, a + y) for x, y in zip(edges, edges[1:], strict=False)]
        for i, (x, y) in enumerate(parts):
            for v, w in parts[i:]:
                if 100 * sizes[y - 1] >= percent * sizes[v]:
                    yield nodes[x:y] if v == x else np.concatenate([nodes[x:y], nodes[v:w]])


def _tiles(percent: int):
    """Distinct tiles of the keys of one group."""
    schema = pa.schema([("tile", pa.int64()), ("nodes", pa.list_(pa.int64()))])

    def run(table: pa.Table) -> pa.Table:
        keys, who, nodes, sizes, seen = [], [], [], [], 0
        for row in table.to_pylist():
            keys.append(np.ascontiguousarray(np.frombuffer(row["keys"], np.uint8).reshape(8, -1).T).view(np.uint64).reshape(-1))
            who.append(np.frombuffer(row["who"], np.uint32).astype(np.int64) + seen)
            nodes.append(np.frombuffer(row["nodes"], np.int64))
            sizes.append(np.frombuffer(row["sizes"], np.int64))
            seen += nodes[-1].size
        keys, who, nodes, sizes = (np.concatenate(x) for x in (keys, who, nodes, sizes))
        order = np.argsort(keys, kind="stable")
        keys, who = keys[order], who[order]
        same = keys[1:] == keys[:-1]
        shared = np.r_[same, False] | np.r_[False, same]
        keys, who = keys[shared], who[shared]
        if not keys.size:
            return schema.empty_table()
        cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        lengths = np.diff(np.r_[cuts, keys.size])
        # Equal lists have equal sums of mixed node numbers.
        sums = np.add.reduceat(mixed(nodes[who].view(np.uint64)), cuts) + lengths.astype(np.uint64)
        _, first = np.unique(sums, return_index=True)
        found: dict[int, np.ndarray] = {}
        for i in first.tolist():
            own = who[cuts[i] : cuts[i] + lengths[i]]
            for tile in bands(nodes[own], sizes[own], percent):
                found.setdefault(xxhash.xxh3_64_intdigest(np.sort(tile).tobytes()) - (1 << 63), tile)
        return pa.Table.from_arrays([pa.array(list(found), pa.int64()), pa.array([t.tolist() for t in found.values()], pa.list_(pa.int64()))], schema=schema)

    return run


def _by_tile(df: DataFrame, function, schema: str) -> DataFrame:
    """``function`` over the rows of every tile, which end up in one task and next to each other."""

    def run(batches):
        rest = None
        for part in batches:
            table = pa.Table.from_batches([part])
            if rest is not None:
                table = pa.concat_tables([rest, table])
            tiles = table.column("tile").to_numpy()
            cuts = np.flatnonzero(np.diff(tiles)) + 1
            edges = [0, *cuts.tolist()]
            yield from function(table.slice(0, edges[-1]).combine_chunks(), edges)
            rest = table.slice(edges[-1])
        if rest is not None:
            yield from function(rest.combine_chunks(), [0, rest.num_rows])

    return task_map(df.repartition("tile").sortWithinPartitions("tile"), run, schema)


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    return np.bitwise_or.reduce(bits.reshape(-1, width), axis=0)


def _bound(size: int, bits: np.ndarray, sizes: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Largest possible overlap of one set with others, from bits that only one of two has."""
    mine = np.bitwise_count(bits & ~others).sum(1)
    theirs = np.bitwise_count(others & ~bits).sum(1)
    return np.minimum(size - mine.astype(np.int64), sizes - theirs.astype(np.int64))


def _least(size: int, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Overlap from which two sets of these sizes link."""
    return -(-percent * (size + sizes) // (100 + percent))


def _possible(percent: int):
    """Rows of a tile whose bitmap leaves a partner of another class possible.

    ``root`` is one node of the cluster that possible partners form within the tile.
    """

    def run(table: pa.Table, edges: list[int]):
        sizes, classes, nodes = (table.column(c).to_numpy() for c in ("n", "class", "node"))
        maps = [np.frombuffer(b, np.uint64) for b in table.column("bits").to_pylist()]
        root = np.arange(table.num_rows)
        keep = np.zeros(table.num_rows, bool)
        for a, b in zip(edges, edges[1:], strict=False):
            order = a + np.argsort(sizes[a:b], kind="stable")
            own, label = sizes[order], classes[order]
            if (label == label[0]).all():
                continue
            cluster = np.arange(order.size)
            widths = np.array([maps[i].size for i in order])
            stacks = {w: np.stack([maps[i] for i in order[widths == w]]) for w in np.unique(widths).tolist()}
            ranks = {w: np.flatnonzero(widths == w) for w in stacks}
            for i in range(1, order.size):
                low = int(np.searchsorted(own, -(-percent * own[i] // 100)))
                for w, rank in ranks.items():
                    if w > widths[i]:
                        continue
                    x, y = np.searchsorted(rank, (low, i))
                    near = rank[x:y]
                    other = (label[near] != label[i]) & (cluster[near] != cluster[i])
                    if not other.any():
                        continue
                    near = near[other]
                    top = _bound(own[i], _folded(maps[order[i]], w), own[near], stacks[w][x:y][other])
                    near = near[top >= _least(own[i], own[near], percent)]
                    if near.size:
                        keep[order[i]] = True
                        keep[order[near]] = True
                        cluster[np.isin(cluster, cluster[near])] = cluster[i]
            root[order] = order[cluster]
        found = table.select(["tile", "node", "class"]).append_column("root", pa.array(nodes[root]))
        yield from found.filter(pa.array(keep)).to_batches()

    return run


def _links(percent: int):
    """Links of a tile, one for every two classes that they join."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(table: pa.Table, edges: list[int]):
        nodes, classes = table.column("node").to_numpy(), table.column("class").to_numpy()
        own_sets = [np.frombuffer(s, np.uint64) for s in table.column("runs").to_pylist()]
        sizes, found = np.array([s.size for s in own_sets], np.int64), []
        for a, b in zip(edges, edges[1:], strict=False):
            order = a + np.argsort(sizes[a:b], kind="stable")
            own, label = sizes[order], np.unique(classes[order], return_inverse=True)[1]
            if order.size < 2 or not label.any():
                continue
            width = max(1, 1 << int(4 * own[-1] - 1).bit_length() >> 6)
            stack = np.zeros((order.size, width * 64), bool)
            for k, i in enumerate(order):
                stack[k, (own_sets[i] & np.uint64(width * 64 - 1)).astype(np.int64)] = True
            stack = np.packbits(stack, axis=1, bitorder="little").view(np.uint64)
            for i in range(1, order.size):
                near = np.arange(int(np.searchsorted(own, -(-percent * own[i] // 100))), i)
                near = near[label[near] != label[i]]
                if not near.size:
                    continue
                top, least = _bound(own[i], stack[i], own[near], stack[near]), _least(own[i], own[near], percent)
                near = near[top >= least][np.argsort((least - top)[top >= least], kind="stable")]
                while near.size:
                    j = near[0]
                    shared = np.intersect1d(own_sets[order[i]], own_sets[order[j]], assume_unique=True).size
                    if 100 * shared >= percent * (own[i] + own[j] - shared):
                        found.append((nodes[order[i]], nodes[order[j]]))
                        label[label == label[j]] = label[i]
                    near = near[1:]
                    near = near[label[near] != label[i]]
        yield pa.RecordBatch.from_arrays([pa.array([int(x[k]) for x in found], pa.int64()) for k in (0, 1)], schema=schema)

    return run


def _picked(df: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose id is among ``ids``; broadcast only below a counted bound."""
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", "left_semi")


def _candidates(scratch: Scratch, tiles: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """``(tile, node, class, root)`` of nodes with a possible partner, from ``(tile, node, class)``."""
    facts = nodes.select("node", "n", "bits")
    return scratch.stored(_by_tile(tiles.join(facts, "node"), _possible(percent), "tile bigint, node bigint, class bigint, root bigint"))


def _resolve(scratch: Scratch, clusters: DataFrame, nodes: DataFrame, texts: DataFrame, length: int, percent: int) -> DataFrame:
    """Links between nodes of different classes in clusters of ``(tile, node, class)``.

    A cluster too large for a task is dealt to blocks, and every two blocks are a tile.
    """
    size = clusters.join(nodes.select("node", "n"), "node").groupBy("tile").agg(F.count("*").alias("k"), F.sum("n").alias("runs"))
    blocks = F.greatest(F.ceil(F.col("k") / BLOCK_NODES), F.ceil(F.col("runs") / BLOCK_RUNS))
    dealt = clusters.join(size.select("tile", blocks.alias("blocks")), "tile").withColumn("own", F.pmod(F.xxhash64("node"), "blocks"))
    pair = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
    dealt = dealt.select("tile", "node", "class", "own", pair)
    meeting = F.xxhash64("tile", F.least("own", "other"), F.greatest("own", "other"))
    dealt = dealt.select(meeting.alias("tile"), "node", "class")

    ids = scratch.stored(nodes.join(clusters.select("node").distinct(), "node", "left_semi").select("id"))
    schema = pa.schema([("node", pa.int64()), ("runs", pa.binary())])

    def run(batches):
        for part in steps(batches):
            found = [s for s in sets(part.column("text"), length) if s.size]
            yield batch(schema, node=[node_of(s) for s in found], runs=[s.tobytes() for s in found])

    arrays = task_map(_picked(texts, ids), run, "node bigint, runs binary").dropDuplicates(["node"])
    return scratch.stored(_by_tile(dealt.join(arrays, "node"), _links(percent), "a bigint, b bigint"))


def classes(df: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_shingles, component_id)`` of every row.

    ``component_id`` is the smallest id that links reach from a row, itself included.
    """
    kind = dict(df.dtypes)[id_col]
    texts = keyed(df, id_col, text_col).withColumn("id", F.col("id").cast("bigint"))
    spark = df.sparkSession

    def cells(batches):
        for part in steps(batches):
            yield (all_runs(cut(part.column("text"), lower=True), words)[0] >> _CELL).astype(np.int64)

    counts = spark.sparkContext.broadcast(np.minimum(cell_counts(texts, cells, CELLS), 1 << 62))
    scratch, first_scratch = Scratch(spark), Scratch(spark)
    signed = first_scratch.stored(_signatures(texts, words, percent, counts))
    nodes = scratch.stored(
        signed.where("node is not null and id is not null").groupBy("node").agg(F.min("id").alias("id"), *[F.first(c).alias(c) for c in ("n", "keys", "bits")])
    )
    members_of = stored(signed.select("id", "n", "node"))
    first_scratch.clear()
    total = nodes.agg(F.sum(F.length("keys")).alias("bytes")).first()["bytes"] or 0
    dealt = task_map(nodes.select("node", "n", "keys"), _deal(max(1, -(-total // (8 * KEYS))), counts), "part bigint, keys binary, who binary, nodes binary, sizes binary")
    form = _tiles(percent)
    lists = scratch.stored(dealt.groupBy("part").applyInArrow(lambda t: form(t), "tile bigint, nodes array<bigint>").dropDuplicates(["tile"]))

    # First each node meets the smallest node it shares a tile with, in blocks of bounded size.
    members = lists.select("tile", F.array_min("nodes").alias("lead"), F.explode("nodes").alias("node"))
    stars = members.groupBy("node").agg(F.min("lead").alias("lead"))
    sizes = stars.groupBy("lead").agg(F.count("*").alias("k"))
    block = F.pmod(F.xxhash64("node"), F.ceil(F.col("k") / BLOCK_NODES))
    placed = stars.join(sizes, "lead").select("lead", block.alias("block"), "node")
    leads = placed.select("lead", "block", F.col("lead").alias("node")).distinct()
    first = placed.unionByName(leads).distinct().select(F.xxhash64("lead", "block").alias("tile"), "node", F.col("node").alias("class"))
    possible = _candidates(scratch, first, nodes, percent).select(F.xxhash64("tile", "root").alias("tile"), "node", "class")
    links = _resolve(scratch, possible, nodes, texts, words, percent)
    known = components(links)

    # Then the tiles that still hold several classes.
    labelled = members.join(known, "node", "left").select("tile", "node", F.coalesce("component", "node").alias("class"))
    open_ = labelled.groupBy("tile").agg(F.min("class").alias("x"), F.max("class").alias("y")).where("x < y").select("tile")
    possible = _candidates(scratch, labelled.join(open_, "tile", "left_semi"), nodes, percent)
    clusters = components(possible.select(F.col("node").alias("a"), F.col("root").alias("b")))
    possible = possible.select("node", "class").distinct().join(clusters, "node").select(F.col("component").alias("tile"), "node", "class")
    more = _resolve(scratch, scratch.stored(possible), nodes, texts, words, percent)
    known = components(links.unionByName(more))

    named = nodes.select("node", "id").join(known, "node", "left").select("node", "id", F.coalesce("component", "node").alias("class"))
    least = named.groupBy("class").agg(F.min("id").alias("component_id"))
    ends = stored(named.join(least, "class").select("node", "component_id"))
    scratch.clear()
    found = members_of.join(ends, "node", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return found.select(F.col("id").cast(kind).alias(id_col), F.col("n").alias("n_shingles"), component.cast(kind).alias("component_id"))


def representatives(df: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of the rows with the smallest id of their class.

    Rows with a null id stay, and so do all rows that share a kept id.
    """
    found = classes(df, words, percent, id_col, text_col)
    kept = found.where(F.col("component_id") == F.col(id_col)).select(F.col(id_col).alias("kept_id")).distinct()
    named = df.join(kept, df[id_col] == kept["kept_id"], "left_semi")
    return named.unionByName(df.where(df[id_col].isNull()))


#: DuckDB SQL for :func:`classes` over ``documents`` with four words and 85 percent.
SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS shingle FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) c USING (doc_id)"""
