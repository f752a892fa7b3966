"""Merkle manifests against a plain recursive version."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from packwright.llm import manifest

SCHEMA = "tree string, source string, doc_id bigint, lang string, n_chars bigint, text string, idx string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, text) -> str:
    return digest("".join(map(field, (row[2], row[1], row[3], row[4], text))))


def tree(level: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root, and for every leaf what stands left and right of it on each level."""
    paths, at = [[] for _ in level], [[i] for i in range(len(level))]
    while len(level) > 1:
        for i, below in enumerate(at):
            start = i // 3 * 3
            for leaf in below:
                paths[leaf].append(("".join(level[start:i]), "".join(level[i + 1 : start + 3])))
        level = [digest("".join(level[i : i + 3])) for i in range(0, len(level), 3)]
        at = [[x for below in at[i : i + 3] for x in below] for i in range(0, len(at), 3)]
    return level[0], paths


def expected(rows) -> list[tuple]:
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    members = {s: sorted(groups[s], key=lambda r: (r[2] is not None, r[2] or 0, leaf_of(r, r[5]))) for s in order}
    trees = {s: tree([leaf_of(r, r[5]) for r in members[s]]) for s in order}
    if not order:
        return []
    root, above = tree([trees[s][0] for s in order])
    found = []
    for place, s in enumerate(order):
        for row, path in zip(members[s], trees[s][1], strict=True):
            path = path + above[place]
            text, tampered = row[5], row[2] is not None and zlib.crc32(str(row[2]).encode()) % 2 == 0
            now = leaf_of(row, text.replace("\n", "") if tampered and text is not None else text)
            for left, right in path:
                now = digest(left + now + right)
            found.append((row[2], leaf_of(row, text), trees[s][0], root, digest("".join(a + b for a, b in path)), now, now == root))
    return sorted(found, key=repr)


def rows_of(sizes: dict) -> list[tuple]:
    return [("x", s, i * 3 % (n + 7), "en", i, f"line {i}\nof {s}", None) for s, n in sizes.items() for i in range(n)]


CASES = {
    "empty": [],
    "one": rows_of({"a": 1}),
    "one source": rows_of({"a": 30}),
    "lone leaves": rows_of({"a": 1, "b": 1, "c": 1, "d": 1}),
    "sizes": rows_of({"a": 1, "b": 3, "é": 4, None: 10, "zz": 28, "": 82, "Z": 2}),
    "nulls and repeats": [
        (None, None, None, None, None, None, None),
        (None, None, None, None, None, None, None),
        ("t", "a", None, "en", 3, "x\ny", None),
        ("t", "a", 5, "en", 3, "x\ny", None),
        ("t", "a", 5, "en", 3, "x\ny", None),
        ("t", "a", 5, "en", 4, "other\n", None),
        ("t", "a", 6, None, None, "", None),
        ("t", None, 7, "en", 3, None, None),
        ("t", "a", -8, "en", 3, "long\n" * 300_000, None),
    ],
}


@pytest.mark.parametrize("name", CASES)
def test_equals_plain_trees(spark, name):
    df = spark.createDataFrame(CASES[name], SCHEMA).repartition(3)
    tamper = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    found = manifest.manifest(df, tamper=tamper)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(CASES[name])


def test_trees_of_several_blocks(spark):
    rows = rows_of({"hot": 2200, "a": 729, "b": 730, "c": 728})
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = manifest.manifest(df, tamper=F.crc32(F.col("doc_id").cast("string")) % 2 == 0)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(rows)


def test_proofs_fold_to_the_root_without_tampering(spark):
    df = spark.createDataFrame(rows_of({"a": 40, "b": 5}), SCHEMA)
    found = manifest.proofs(df)
    wrong = found.where(manifest.fold(F.col("leaf"), F.col("path")) != F.col("root"))
    assert found.count() == 45 and wrong.count() == 0
