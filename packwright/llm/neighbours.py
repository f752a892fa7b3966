"""Approximate nearest neighbours: inverted lists scanned by dimensions, with early abandonment.

* An index of coarse centres is fitted by k-means on a bounded sample (``SAMPLE`` vectors, chosen
  by a hash of their ids); every vector is put into the list of its nearest centre. How many lists
  a query probes is measured on the same sample: as many as hold the share ``RECALL`` of the true
  neighbours of some of its vectors. Clustered vectors need few lists, others most of them.
* Vectors are rotated by a random orthogonal matrix, which keeps distances and spreads them evenly
  over the dimensions. A probed list is scanned in blocks of columns: after each block a candidate
  whose partial distance is, by a hypothesis test, too large for the current k-th best is abandoned.
* Survivors get their exact distance on the original vectors, in double precision.

Of equal vectors only the ``k + 1`` smallest ids can be among the nearest of any query, so the
others leave before the shuffle; a vector that a third of all rows repeat is no hot group. Long
lists are dealt to several tasks, and so are the queries of a list that many probe: a group holds
at most ``SHARD`` vectors and about ``QUERIES`` queries. Queries that find fewer than ``k`` others in
their lists ask all lists in a second pass.

Vectors that are null, zero, of another length than most, or hold a null, an infinity or NaN take
no part, as queries or candidates. Repeated ids count as rows of their own; a query's own id is
never among its neighbours. Fewer candidates than ``k`` are all returned.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packwright.llm.components import stored
from packwright.llm.frames import task_map

#: Vectors the centres are fitted on, at most.
SAMPLE = 1 << 14
#: Sample vectors that stand in for queries, and the share of their neighbours to be in probed lists.
TRIALS, RECALL = 512, 0.98
#: Vectors of a list that one task scans.
SHARD = 1 << 15
#: Queries of a list that one task answers.
QUERIES = 1 << 14
#: Columns of one block of the scan, and how sure the test is before it abandons.
COLUMNS, CAUTION = 16, 2.1


def valid(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, vec)``, the vectors that take part, as doubles."""
    vec = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), vec.alias("vec")).where("id is not null and vec is not null and size(vec) > 0")
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(~bad & F.exists("vec", lambda x: x != 0))


def _dimension(rows: DataFrame) -> int:
    """The most frequent length, the smaller of two."""
    sizes = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return sizes["d"] if sizes else 0


def fit(sample: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    """Centres of k-means from evenly spaced start vectors; empty lists keep their centre."""
    centres = sample[np.linspace(0, len(sample) - 1, min(lists, len(sample))).astype(int)].copy()
    for _ in range(rounds):
        own = nearest(sample, centres, 1)[:, 0]
        counts = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def nearest(vectors: np.ndarray, centres: np.ndarray, count: int) -> np.ndarray:
    """The nearest centres of each vector, nearest first."""
    found = []
    for at in range(0, len(vectors), 1024):
        part = (centres**2).sum(1) - 2 * vectors[at : at + 1024] @ centres.T
        if count == 1:
            found.append(part.argmin(1)[:, None])
        else:
            near = np.argpartition(part, min(count, part.shape[1]) - 1, 1)[:, :count]
            found.append(np.take_along_axis(near, np.argsort(np.take_along_axis(part, near, 1), 1, kind="stable"), 1))
    return np.concatenate(found) if found else np.zeros((0, count), int)


def probes_needed(sample: np.ndarray, centres: np.ndarray, k: int) -> int:
    """Lists to probe so that they hold the share ``RECALL`` of the neighbours within the sample."""
    own, ranks = nearest(sample, centres, 1)[:, 0], []
    for at in range(0, min(TRIALS, len(sample)), 64):
        asked = sample[at : min(at + 64, TRIALS)]
        far = (sample**2).sum(1) - 2 * asked @ sample.T
        far[np.arange(len(asked)), at + np.arange(len(asked))] = np.inf
        near = np.argpartition(far, min(k, len(sample)) - 1, 1)[:, :k]
        place = np.argsort(np.argsort((centres**2).sum(1) - 2 * asked @ centres.T, 1), 1)
        ranks.append(np.take_along_axis(place, own[near], 1).ravel())
    return int(np.quantile(np.concatenate(ranks), RECALL, method="higher")) + 1 if ranks else 1


def rotation(dimension: int) -> np.ndarray:
    """A random orthogonal matrix, the same every time."""
    q, r = np.linalg.qr(np.random.default_rng(7).normal(size=(dimension, dimension)))
    return q * np.sign(np.diag(r))


def scan(query: np.ndarray, own_id: int, vectors: np.ndarray, turned: np.ndarray, turned_query: np.ndarray, ids: np.ndarray, k: int):
    """Ids and exact distances of the ``k`` nearest in one list, ties to the smaller id."""
    others = np.flatnonzero(ids != own_id)
    start, rest = others[: 8 * k], others[8 * k :]
    exact = np.sqrt(((vectors[start] - query) ** 2).sum(1))
    limit = np.partition(exact, k - 1)[k - 1] if exact.size >= k else math.inf
    if rest.size and limit < math.inf:
        dimension, partial = query.size, np.zeros(rest.size)
        for at in range(0, dimension, COLUMNS):
            block = slice(at, min(at + COLUMNS, dimension))
            partial += ((turned[rest, block] - turned_query[block]) ** 2).sum(1)
            seen = block.stop
            if seen < dimension:
                # A partial distance of seen columns estimates seen/dimension of the square.
                test = limit**2 * (seen / dimension) * (1 + CAUTION / math.sqrt(seen)) ** 2
            else:
                test = limit**2 * (1 + 1e-9)
            alive = partial <= test
            rest, partial = rest[alive], partial[alive]
            if not rest.size:
                break
    if rest.size:
        start, exact = np.r_[start, rest], np.r_[exact, np.sqrt(((vectors[rest] - query) ** 2).sum(1))]
    order = np.lexsort((ids[start], exact))[:k]
    return ids[start[order]], exact[order]


def _assign(rows: DataFrame, centres: Broadcast, probes: int) -> DataFrame:
    """``(id, vec, list)``: each vector with its ``probes`` nearest lists."""

    def run(batches):
        for part in batches:
            if part.num_rows:
                vectors = np.array(part.column("vec").flatten().to_numpy(zero_copy_only=False)).reshape(part.num_rows, -1)
                near = nearest(vectors, centres.value, probes)
                row = np.repeat(np.arange(part.num_rows), near.shape[1])
                yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(row)), part.column("vec").take(pa.array(row)), pa.array(near.ravel(), pa.int64())], ["id", "vec", "list"])

    return task_map(rows, run, "id bigint, vec array<double>, list bigint")


def _search_tiles(k: int, dimension: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        vectors = table.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        turned = vectors @ rotation(dimension)
        rows = np.flatnonzero(~asks)
        vectors_in, turned_in, ids_in = vectors[rows], turned[rows], ids[rows]
        out = [[], [], []]
        for q in np.flatnonzero(asks) if rows.size else ():
            near, scores = scan(vectors[q], ids[q], vectors_in, turned_in, turned[q], ids_in, k)
            for column, values in zip(out, (np.full(near.size, ids[q]), near, scores), strict=True):
                column.append(values)
        columns = [np.concatenate(c) if c else np.zeros(0) for c in out]
        return pa.Table.from_arrays([pa.array(c.astype(t), f.type) for c, f, t in zip(columns, schema, (np.int64, np.int64, float), strict=True)], schema=schema)

    return run


def search(
    df: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", lists: int | None = None, probes: int | None = None
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found for every query row.

    ``lists`` defaults to the square root of the number of vectors, ``probes`` to what
    :func:`probes_needed` measures.
    """
    spark = df.sparkSession
    rows = valid(df, id_col, vector_col)
    dimension = _dimension(rows)
    rows = rows.where(F.size("vec") == dimension)
    asked = valid(queries, id_col, vector_col).where(F.size("vec") == dimension)
    lists = lists or max(1, round(math.sqrt(rows.count())))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vec").collect()
    drawn = np.array([r["vec"] for r in sample]).reshape(len(sample), max(dimension, 1))
    centres = fit(drawn, lists) if sample else np.zeros((1, max(dimension, 1)))
    probes = min(len(centres), probes or probes_needed(drawn, centres, k))
    shared = spark.sparkContext.broadcast(centres)

    # Only the k + 1 smallest ids of equal vectors can be answers; the rank cuts before the shuffle.
    copies = Window.partitionBy("vec").orderBy("id")
    least = rows.withColumn("copy", F.dense_rank().over(copies)).where(F.col("copy") <= k + 1)
    distinct = least.drop("copy").dropDuplicates(["vec", "id"])
    indexed = stored(_assign(distinct, shared, 1))
    wanted = indexed.limit(k + 1).count()
    form = _search_tiles(k, dimension)

    def searched(probing: DataFrame) -> DataFrame:
        """Answers of all probed lists; lists with many vectors or queries are several groups."""
        shards = _parts(indexed, SHARD)
        blocks = _parts(probing, QUERIES)
        each = [_part_count(parts) for parts in (shards, blocks)]
        held = indexed.withColumn("shard", F.pmod(F.xxhash64("id"), each[0])).withColumn("block", F.explode(F.sequence(F.lit(0), each[1] - 1)))
        asking = probing.withColumn("shard", F.explode(F.sequence(F.lit(0), each[0] - 1))).withColumn("block", F.pmod(F.xxhash64("id"), each[1]))
        tiles = held.withColumn("asks", F.lit(False)).unionByName(asking.withColumn("asks", F.lit(True)))
        return tiles.groupBy("list", "shard", "block").applyInArrow(lambda t: form(t), "query_id bigint, vec_id bigint, score double")

    found = stored(searched(stored(_assign(asked, shared, probes))).distinct())
    if probes < len(centres):
        # Queries whose lists held too few others ask all lists.
        answers = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min(k, wanted - 1))
        short = asked.join(answers.select(F.col("query_id").alias("id")), "id", "left_anti")
        if not short.isEmpty():
            found = found.unionByName(searched(stored(_assign(short, shared, len(centres))))).distinct()
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _parts(rows: DataFrame, most: int) -> dict[int, int]:
    """Lists with more than ``most`` rows and how many parts they make; there are few lists."""
    counts = rows.groupBy("list").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    return {r["list"]: -(-r["n"] // most) for r in counts.collect()}


def _part_count(parts: dict[int, int]) -> Column:
    if not parts:
        return F.lit(1)
    return F.coalesce(F.create_map(*[F.lit(x) for pair in parts.items() for x in pair])[F.col("list")], F.lit(1))


def brute_force(df: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", block: int = 2048) -> DataFrame:
    """The exact answer, for measuring recall: queries in bounded blocks against all rows."""
    spark, rows = df.sparkSession, valid(df, id_col, vector_col)
    dimension = _dimension(rows)
    rows = rows.where(F.size("vec") == dimension)
    asked = valid(queries, id_col, vector_col).where(F.size("vec") == dimension)
    blocks, found = max(1, -(-asked.count() // block)), None

    def over(own):
        def run(batches):
            for part in batches:
                if not part.num_rows:
                    continue
                ids = part.column("id").to_numpy()
                vectors = np.array(part.column("vec").flatten().to_numpy(zero_copy_only=False)).reshape(part.num_rows, -1)
                for q, vec in own.value:
                    others = np.flatnonzero(ids != q)
                    score = np.sqrt(((vectors[others] - vec) ** 2).sum(1))
                    best = np.lexsort((ids[others], score))[:k]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(best.size, q)), pa.array(ids[others[best]]), pa.array(score[best])], ["query_id", "vec_id", "score"])

        return run

    for number in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == number).collect()
        shared = spark.sparkContext.broadcast([(r["id"], np.array(r["vec"])) for r in own])
        part = task_map(rows, over(shared), "query_id bigint, vec_id bigint, score double")
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
