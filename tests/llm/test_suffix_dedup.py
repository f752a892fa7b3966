import hashlib
import random
import re

import numpy as np
import pytest

from packwright.llm import suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, k):
    """``{id: (words, kept words)}`` with ids unique."""
    least, words = {}, {i: WORD.findall(t or "") for i, t in rows}
    for i, w in words.items():
        for j in range(len(w) - k + 1):
            key = tuple(w[j : j + k])
            least[key] = min(i, least.get(key, i))
    found = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for j in range(len(w) - k + 1):
            if least[tuple(w[j : j + k])] < i:
                gone[j : j + k] = [True] * k
        found[i] = (len(w), [x for x, g in zip(w, gone, strict=True) if not g])
    return found


def corpus(seed):
    r = random.Random(seed)
    shared = [[r.choice("abcdefgh") for _ in range(r.randint(4, 30))] for _ in range(5)]
    rows = []
    for i in range(90):
        w = []
        for _ in range(r.randint(0, 4)):
            w += r.choice(shared) if r.random() < 0.5 else [r.choice("abcdefghijklmnop") * r.randint(1, 12) for _ in range(r.randint(1, 20))]
        rows.append((r.randint(0, 10**6), r.choice([" ", "\n", " \t "]).join(w)))
    rows = list(dict(rows).items())
    return [*rows, (-5, None), (-4, ""), (-3, "é " * 50), (10**7, "é " * 50)]


@pytest.mark.parametrize("seed,k", [(1, 13), (2, 5), (3, 2)])
def test_equals_brute_force(spark, seed, k):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id bigint, text string, n_words int")
    found = {r["doc_id"]: r for r in suffix_dedup.digest(df, k).collect()}
    for i, (count, kept) in brute(rows, k).items():
        assert (found[i]["n_words"], found[i]["n_removed"]) == (count, count - len(kept))
        assert found[i]["kept_sha256"] == hashlib.sha256(" ".join(kept).encode()).hexdigest()


def test_small_groups_split_heavy_prefixes(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP", 64)
    rows = corpus(4)
    heavy, groups = suffix_dedup._plan(suffix_dedup._rows(spark.createDataFrame(rows, "doc_id bigint, text string"), "doc_id", "text"), 6)
    assert groups > 3 and heavy[0].any() and not heavy[-1].any()
    found = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.digest(spark.createDataFrame(rows, "doc_id bigint, text string"), 6).collect()}
    assert found == {i: n - len(kept) for i, (n, kept) in brute(rows, 6).items()}


def test_null_and_repeated_ids(spark):
    text = "a b c d e f"
    rows = [(1, text), (1, text), (None, text), (2, "x " + text), (2, "other words here")]
    found = suffix_dedup.digest(spark.createDataFrame(rows, "doc_id bigint, text string"), 3).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"]) for r in found) == [("1", 6, 0), ("1", 6, 0), ("2", 3, 0), ("2", 7, 6), ("None", 6, 0)]
    assert suffix_dedup.digest(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_passages_and_removed_text(spark):
    rows = [(1, "p q r s t u", "m"), (2, "start  here p q r s t u\nend", "n"), (3, "clean\n text", None), (4, None, "o"), (5, "p q r s t u", "k")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, mark string")
    spans = {(r["doc_id"], r["first_word"], r["n_words"], r["passage"]) for r in suffix_dedup.passages(df, 4).collect()}
    assert spans == {(2, 2, 6, "p q r s t u"), (5, 0, 6, "p q r s t u")}
    cut = {r["doc_id"]: (r["text"], r["mark"]) for r in suffix_dedup.remove_repeats(df, 4).collect()}
    assert cut == {1: ("p q r s t u", "m"), 2: ("start  here end", "n"), 3: ("clean\n text", None), 4: (None, "o"), 5: ("", "k")}


def test_numbers_survive_their_byte_planes():
    x = np.random.default_rng(1).integers(0, 2**63, 99).astype(np.uint64)
    assert (suffix_dedup._unplanes(suffix_dedup._planes(x), np.uint64) == x).all()
