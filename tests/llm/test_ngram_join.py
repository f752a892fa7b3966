import random
import re

import numpy as np
import pytest

from packwright.llm import components, ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, k, percent):
    """``{id: (shingles, component)}`` by comparing all pairs."""
    sets = {}
    for i, text in rows:
        w = WORD.findall((text or "").lower())
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
    own = {i: i for i in sets}

    def find(i):
        while own[i] != i:
            i = own[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((find(a), find(b)))
                own[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def corpus(seed, count=140):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    base = [[r.choice(words) for _ in range(r.randint(3, 60))] for _ in range(12)]
    line = [r.choice(words) for _ in range(12)]
    rows = []
    for i in range(count):
        w = list(r.choice(base))
        for _ in range(r.choice((0, 0, 1, 2, 4))):
            w[r.randrange(len(w))] = r.choice(words)
        if r.random() < 0.4:
            w = w[: r.randint(1, len(w))] + line
        rows.append((i * 3 + 1, " ".join(w).upper() if r.random() < 0.2 else "\n".join(w)))
    return rows + [(1000, None), (1001, ""), (1002, " \t"), (1003, "one"), (1004, "One"), (1005, "one two"), (1006, "two one")]


def as_dict(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


@pytest.mark.parametrize("seed,k,percent", [(1, 4, 85), (2, 5, 80), (3, 2, 60)])
def test_equals_brute_force(spark, seed, k, percent):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, component_id string")
    assert as_dict(ngram_join.classes(df, k, percent)) == brute(rows, k, percent)


def test_blocks_and_dealt_keys_change_nothing(spark, monkeypatch):
    rows = corpus(4, 90)
    monkeypatch.setattr(ngram_join, "BLOCK_NODES", 7)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert as_dict(ngram_join.classes(df, 4, 70)) == brute(rows, 4, 70)


def test_hot_keys_meet_in_pairs_of_blocks():
    r = np.random.default_rng(5)
    nodes, keys = r.integers(-(2**60), 2**60, 50), np.array([7], np.uint64)

    class Counts:
        value = np.full(ngram_join.CELLS, ngram_join.HOT * 3)

    import pyarrow as pa

    rows = pa.RecordBatch.from_arrays([pa.array(nodes), pa.array([10] * 50), pa.array([keys.tobytes()] * 50)], ["node", "n", "keys"])
    met = set()
    dealt = pa.Table.from_batches(list(ngram_join._deal(4, Counts)(iter([rows]))))
    for part in set(dealt.column("part").to_pylist()):
        own = dealt.filter(pa.compute.equal(dealt.column("part"), part))
        for tile in ngram_join._tiles(80)(own).column("nodes").to_pylist():
            met |= {(a, b) for a in tile for b in tile if a < b}
    assert len(met) == 50 * 49 // 2


def test_null_ids_and_repeated_rows(spark):
    rows = [(5, "a b c d e"), (5, "a b c d e"), (None, "a b c d e"), (9, "A b c d E"), (2, "x y"), (7, "x y")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.classes(df, 4, 85).collect()), key=str)
    assert found == sorted([(5, 2, 5), (5, 2, 5), (None, 2, None), (9, 2, 5), (2, 1, 2), (7, 1, 2)], key=str)
    kept = sorted(str(r["doc_id"]) for r in ngram_join.representatives(df, 4, 85).collect())
    assert kept == ["2", "5", "5", "None"]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert ngram_join.classes(df).count() == 0


def test_components_of_a_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(40)]
    hub = [(100, i) for i in range(101, 130)] + [(200, 200)]
    found = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(chain + hub, "a bigint, b bigint")).collect()}
    assert {found[i] for i in range(41)} == {0} and {found[i] for i in range(100, 130)} == {100}


def test_bitmap_bound_is_never_below_the_overlap():
    r = np.random.default_rng(6)
    for _ in range(50):
        a, b = (np.unique(r.integers(0, 200, r.integers(1, 120)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(2))
        x, y = ngram_join.bitmap(a), ngram_join.bitmap(b)
        width = min(x.size, y.size)
        top = ngram_join._bound(a.size, ngram_join._folded(x, width), np.array([b.size]), ngram_join._folded(y, width)[None])
        assert top[0] >= np.intersect1d(a, b).size
