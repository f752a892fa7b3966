"""Substring deduplication with prefix-partitioned suffix trees.

The suffixes of all texts, taken word by word and cut off at ``window`` words, are split by their
first words into groups that fit in a task's memory: by the first word where few suffixes start
with it, by two, three or more words where many do. Each group's suffixes, sorted, are its
subtree; a node at depth ``window`` with suffixes of several documents is a repeat, and overlapping
repeats of a document join to its maximal repeated passages.

* One pass counts suffixes per hashed prefix and depth (tables of fixed size) and decides how deep
  each prefix has to go. A second pass sends the suffixes to their groups.
* Before the shuffle a task keeps, of suffixes that are equal, those of its smallest document only;
  the others are known to repeat. So a passage that a third of all documents hold costs an entry
  per task and document block, not one per document.
* Suffixes travel as arrays of 64-bit codes in order of place. Two different runs of words count as equal with
  a chance of 2^-64 per pair of one group.

A word is a run of characters other than ASCII white space. A word is removed if it lies in a
window that also starts in a document with a smaller id; windows are judged on the input. Null and
empty texts have no words. Rows with a null id lose nothing and take nothing from others. Rows that
share an id count as one document: nothing is removed between them. Ids are integers.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packwright.llm.frames import batch, steps, task_map
from packwright.llm.tables import cell_counts
from packwright.llm.words import cut, runs

#: Cells per depth of the table of prefix counts.
CELLS = 1 << 14
#: Suffixes of a group that one task sorts.
GROUP = 3 << 20
#: A prefix with more than this share of a group is split by more words.
HEAVY = 1 / 8
#: Text bytes whose suffixes are sorted together before the shuffle.
BLOCK = 4 << 20

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_BITS = np.uint64(64 - CELLS.bit_length() + 1)


def depths(window: int) -> tuple[int, ...]:
    """Prefix lengths, in words, at which suffixes can be split."""
    return tuple(d for d in (1, 2, 3, 4, 6, 9) if d < window) + (window,)


def _rows(df: DataFrame, id_col: str, text_col: str, rest: Column | None = None) -> DataFrame:
    """Id, text, and a checksum of both that tells rows with one id apart and spreads them."""
    own, text = F.col(id_col).cast("bigint"), F.col(text_col).cast("string")
    mark = F.xxhash64(own, text).bitwiseAND(F.lit(0xFFFFFFFF))
    return df.select(own.alias("id"), text.alias("text"), mark.alias("mark"), *([] if rest is None else [rest.alias("rest")]))


def _plan(rows: DataFrame, window: int) -> tuple[np.ndarray, int]:
    """Which cells of each depth are too heavy, and the number of groups."""
    levels = depths(window)

    def cells(batches):
        for part in steps(batches):
            _, _, prefixes = runs(cut(part.column("text")), window, levels)
            for i, codes in enumerate(prefixes):
                yield (codes >> _BITS).astype(np.int64) + i * CELLS

    counts = cell_counts(rows, cells, len(levels) * CELLS).reshape(len(levels), CELLS)
    heavy = counts > GROUP * HEAVY
    heavy[-1] = False
    return heavy, max(1, -(-int(counts[-1].sum()) // GROUP))


def _groups(prefixes: list[np.ndarray], heavy: np.ndarray, groups: int) -> np.ndarray:
    """The group of each suffix: by its shortest prefix that is not heavy."""
    own, open_ = prefixes[0].copy(), np.arange(prefixes[0].size)
    for level in range(1, len(prefixes)):
        open_ = open_[heavy[level - 1][(prefixes[level - 1][open_] >> _BITS).astype(np.int64)]]
        if not open_.size:
            break
        own[open_] = prefixes[level][open_]
    return ((own & np.uint64(0xFFFFFFFF)) % np.uint64(groups)).astype(np.int64)


def _planes(numbers: np.ndarray) -> bytes:
    """Bytes of the numbers, the first byte of all, then the second: small ones compress."""
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, numbers.itemsize).T).tobytes()


def _unplanes(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


#: Suffixes on their way to a group: codes and gaps between their places in a block of texts, and
#: of each text its mark and the gaps of ids and first places. Known repeats have no codes.
_SENT = pa.schema([("part", pa.int64()), ("codes", pa.binary()), ("gaps", pa.binary()), ("ids", pa.binary()), ("marks", pa.binary()), ("first", pa.binary())])
#: Repeats on their way back to their texts: window starts of several texts of one bucket.
_FOUND = pa.schema([("bucket", pa.int64()), ("ids", pa.binary()), ("marks", pa.binary()), ("counts", pa.binary()), ("places", pa.binary())])


def _packed(schema: pa.Schema, key: str, number: int, **arrays: np.ndarray | bytes) -> pa.RecordBatch:
    columns = {n: [a if isinstance(a, bytes) else a.tobytes()] for n, a in arrays.items()}
    return batch(schema, **{key: [number]}, **columns)


def _by_bucket(ids: np.ndarray, marks: np.ndarray, docs: np.ndarray, places: np.ndarray, buckets: int) -> list[pa.RecordBatch]:
    """Window starts, packed for every bucket of texts."""
    home = marks % buckets
    order = np.lexsort((places, docs, home[docs]))
    docs, places = docs[order], places[order]
    cuts = np.flatnonzero(np.diff(home[docs], prepend=-1))
    found = []
    for a, b in zip(cuts, [*cuts[1:], docs.size], strict=True):
        used, counts = np.unique(docs[a:b], return_counts=True)
        found.append(_packed(_FOUND, "bucket", int(home[docs[a]]), ids=ids[used], marks=marks[used].astype(np.uint32), counts=counts.astype(np.uint32), places=places[a:b].astype(np.uint32)))
    return found


def _sender(window: int, heavy: np.ndarray, groups: int):
    """Suffixes of a task's texts, by group; known repeats in rows of their own."""
    levels = depths(window)

    def send(batches):
        for part in steps(batches, BLOCK):
            part = part.filter(pa.compute.is_valid(part.column("id")))
            part = part.take(pa.compute.sort_indices(part.column("id")))
            ids, marks = part.column("id").to_numpy(), part.column("mark").to_numpy()
            words = cut(part.column("text"))
            starts, codes, prefixes = runs(words, window, levels)
            if not starts.size:
                continue
            own = _groups(prefixes, heavy, groups)
            del prefixes
            docs = np.repeat(np.arange(len(ids)), words.counts)[starts]
            order = np.argsort(codes, kind="stable")  # of equal codes the smallest document is first
            fresh = np.r_[True, codes[order][1:] != codes[order][:-1]]
            least = np.empty(codes.size, np.int64)
            least[order] = ids[docs[order]][fresh][np.cumsum(fresh) - 1]
            later = ids[docs] > least
            if later.any():
                places = (starts - words.first[docs])[later]
                for row in _by_bucket(ids, marks, docs[later], places, groups):
                    found = {n: row.column(n)[0].as_py() for n in ("ids", "marks", "counts", "places")}
                    yield _packed(_SENT, "part", row.column("bucket")[0].as_py(), codes=b"", gaps=found["places"], ids=found["ids"], marks=found["marks"], first=found["counts"])
            keep = np.flatnonzero(~later)
            keep = keep[np.argsort(own[keep], kind="stable")]  # by group, and in order of place
            own = own[keep]
            cuts = np.flatnonzero(np.diff(own, prepend=-1))
            for a, b in zip(cuts, [*cuts[1:], own.size], strict=True):
                at = starts[keep[a:b]]
                used = np.unique(docs[keep[a:b]])
                gaps = np.diff(at, prepend=0).astype(np.uint32)
                yield _packed(_SENT, "part", int(own[a]), codes=codes[keep[a:b]], gaps=_planes(gaps), ids=_planes(np.diff(ids[used], prepend=0)),
                              marks=marks[used].astype(np.uint32), first=_planes(np.diff(words.first[used], prepend=0).astype(np.uint32)))

    return send


def _subtree(groups: int):
    """Repeats in one group: of equal suffixes, those of documents after the smallest."""

    def run(table: pa.Table) -> pa.Table:
        out, codes, docs, places, ids, marks, texts = [], [], [], [], [], [], 0
        for row in table.to_pylist():
            if not row["codes"]:
                out.append(batch(_FOUND, bucket=[row["part"]], ids=[row["ids"]], marks=[row["marks"]], counts=[row["first"]], places=[row["gaps"]]))
                continue
            first = np.cumsum(_unplanes(row["first"], np.uint32).astype(np.int64))
            at = np.cumsum(_unplanes(row["gaps"], np.uint32).astype(np.int64))
            own = np.searchsorted(first, at, "right") - 1
            codes.append(np.frombuffer(row["codes"], np.uint64))
            docs.append((own + texts).astype(np.uint32))
            places.append((at - first[own]).astype(np.uint32))
            ids.append(np.cumsum(_unplanes(row["ids"], np.int64)))
            marks.append(np.frombuffer(row["marks"], np.uint32).astype(np.int64))
            texts += first.size
        if codes:
            codes, docs, places, ids, marks = (np.concatenate(x) for x in (codes, docs, places, ids, marks))
            order = np.argsort(codes, kind="stable")
            same = codes[order][1:] == codes[order][:-1]
            order = order[np.r_[same, False] | np.r_[False, same]]
            if order.size:
                node = np.r_[0, np.cumsum(codes[order][1:] != codes[order][:-1])]
                least = np.full(node[-1] + 1, np.iinfo(np.int64).max)
                np.minimum.at(least, node, ids[docs[order]])
                later = order[ids[docs[order]] > least[node]]
                if later.size:
                    out += _by_bucket(ids, marks, docs[later].astype(np.int64), places[later], groups)
        return pa.Table.from_batches(out, _FOUND)

    return run


def _over_repeats(rows: DataFrame, window: int, function, schema: str) -> DataFrame:
    """``function`` over batches of rows and, by id and mark, the starts of their repeated windows.

    Texts and repeats meet by bucket: in a task, a bucket's repeats come first and are kept while
    its texts stream by.
    """
    heavy, groups = _plan(rows, window)
    sent = task_map(rows, _sender(window, heavy, groups), "part bigint, codes binary, gaps binary, ids binary, marks binary, first binary")
    form = _subtree(groups)
    found = sent.groupBy("part").applyInArrow(lambda t: form(t), "bucket bigint, ids binary, marks binary, counts binary, places binary")
    texts = rows.withColumns({"bucket": F.pmod("mark", F.lit(groups)), "is_text": F.lit(True)})
    both = texts.unionByName(found.withColumn("is_text", F.lit(False)), allowMissingColumns=True)
    both = both.repartition("bucket").sortWithinPartitions("bucket", "is_text")

    def run(batches):
        bucket, known = None, {}
        for part in batches:
            if not part.num_rows:
                continue
            homes, kinds = part.column("bucket").to_numpy(), part.column("is_text").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((homes[1:] != homes[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, part.num_rows], strict=True):
                if homes[a] != bucket:
                    bucket, known = homes[a], {}
                own = part.slice(a, b - a)
                if kinds[a]:
                    for step in steps(iter([own])):
                        yield function(step, [known.get(k) for k in zip(step.column("id").to_pylist(), step.column("mark").to_pylist(), strict=True)])
                    continue
                for row in own.select(["ids", "marks", "counts", "places"]).to_pylist():
                    ends = np.cumsum(np.frombuffer(row["counts"], np.uint32).astype(np.int64))
                    starts = np.split(np.frombuffer(row["places"], np.uint32), ends[:-1])
                    for key, at in zip(zip(np.frombuffer(row["ids"], np.int64).tolist(), np.frombuffer(row["marks"], np.uint32).tolist(), strict=True), starts, strict=True):
                        known.setdefault(key, []).append(at)

    return task_map(both, run, schema)


def covered(n_words: int, starts: list[np.ndarray] | None, window: int) -> np.ndarray:
    """Which words lie in one of the windows."""
    edges = np.zeros(n_words + 1, np.int64)
    for at in starts or ():
        np.add.at(edges, at, 1)
        np.add.at(edges, at + window, -1)
    return np.cumsum(edges)[:n_words] > 0


def _bytes(column: pa.Array) -> list[bytes]:
    return pa.compute.fill_null(column, "").cast(pa.binary()).to_pylist()


def digest(df: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_words, n_removed, kept_sha256)`` of every row: kept words joined by one space."""
    kind = dict(df.dtypes)[id_col]
    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])

    def run(part, repeated):
        total, gone, sums = [], [], []
        for text, starts in zip(_bytes(part.column("text")), repeated, strict=True):
            words = text.split()
            total.append(len(words))
            if starts:
                mask = covered(len(words), starts, window)
                words = [w for w, m in zip(words, mask.tolist(), strict=True) if not m]
            gone.append(total[-1] - len(words))
            sums.append(hashlib.sha256(b" ".join(words)).hexdigest())
        return batch(schema, id=part.column("id"), n_words=total, n_removed=gone, kept_sha256=sums)

    found = _over_repeats(_rows(df, id_col, text_col), window, run, "id bigint, n_words bigint, n_removed bigint, kept_sha256 string")
    return found.select(F.col("id").cast(kind).alias(id_col), "n_words", "n_removed", "kept_sha256")


def passages(df: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, first_word, n_words, passage)``: the maximal repeated passages of later documents."""
    kind = dict(df.dtypes)[id_col]
    schema = pa.schema([("id", pa.int64()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("passage", pa.string())])

    def run(part, repeated):
        rows = []
        for i, text, starts in zip(part.column("id").to_pylist(), _bytes(part.column("text")), repeated, strict=True):
            if starts:
                words = text.split()
                mask = np.r_[False, covered(len(words), starts, window), False]
                edges = np.flatnonzero(mask[1:] != mask[:-1]).reshape(-1, 2).tolist()
                rows += [(i, a, b - a, b" ".join(words[a:b]).decode("utf-8", "replace")) for a, b in edges]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    found = _over_repeats(_rows(df, id_col, text_col), window, run, "id bigint, first_word bigint, n_words bigint, passage string")
    return found.select(F.col("id").cast(kind).alias(id_col), "first_word", "n_words", "passage")


def remove_repeats(df: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns, the text without its repeated words.

    Texts without a repeat stay as they are; of the others the white space around what was cut
    out goes with it. A text that repeats as a whole becomes empty.
    """
    rest = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != text_col])
    rows = _rows(df, id_col, text_col, rest)

    def run(part, repeated):
        texts = []
        for text, starts in zip(part.column("text").cast(pa.binary()).to_pylist(), repeated, strict=True):
            if starts and text:
                spans = [m.span() for m in _WORD.finditer(text)]
                mask = np.r_[True, covered(len(spans), starts, window), True]
                kept = np.flatnonzero(mask[1:] != mask[:-1]).reshape(-1, 2).tolist()
                text = b" ".join(text[spans[a][0] : spans[b - 1][1]] for a, b in kept)
            texts.append(None if text is None else text.decode("utf-8", "replace"))
        return pa.RecordBatch.from_arrays([part.column("rest"), pa.array(texts, pa.string())], ["rest", "text"])

    kind = rows.schema["rest"].dataType.simpleString()
    cleaned = _over_repeats(rows, window, run, f"rest {kind}, text string")
    return cleaned.select(*[F.col("text").alias(c) if c == text_col else F.col("rest").getField(c).alias(c) for c in df.columns])


#: DuckDB SQL for :func:`digest` over ``documents`` with windows of 13 words.
SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
m AS (SELECT run, min(doc_id) AS least FROM g GROUP BY run),
x AS (SELECT DISTINCT doc_id, i + unnest(range(0, 13)) AS i FROM g JOIN m USING (run) WHERE least < doc_id),
k AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n
  FROM (SELECT doc_id, i, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)) a ANTI JOIN x USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)"""
