import math

import numpy as np

from packwright.llm import neighbours


def table(spark, vectors, first=0):
    return spark.createDataFrame([(first + i, v if v is None else [None if x is None else float(x) for x in v], i) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>, id int")


def rows(df):
    return {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in df.collect()}


def test_recall_and_exact_scores(spark):
    r = np.random.default_rng(1)
    centres = r.normal(size=(20, 24))
    df = table(spark, (centres[r.integers(0, 20, 1500)] + 0.4 * r.normal(size=(1500, 24))).tolist())
    asked = df.where("vec_id % 50 = 0")
    found, exact = rows(neighbours.search(df, asked, lists=38, probes=12)), rows(neighbours.brute_force(df, asked))
    assert set(found) == set(exact)
    best = {(q, v) for (q, _), (v, _) in exact.items()}
    assert len({(q, v) for (q, _), (v, _) in found.items()} & best) >= 0.9 * len(best)
    values = {r["vec_id"]: np.array(r["embedding"], float) for r in df.collect()}
    assert all(math.isclose(s, float(np.linalg.norm(values[q] - values[v])), rel_tol=1e-12) for (q, _), (v, s) in found.items())


def test_ties_copies_and_shards(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD", 40)
    r = np.random.default_rng(2)
    vectors = [[1.0, 2.0, 3.0]] * 300 + r.normal(size=(200, 3)).tolist()
    df = table(spark, vectors)
    asked = df.where("vec_id in (0, 299, 400)")
    found = rows(neighbours.search(df, asked, probes=10**6))
    assert found == rows(neighbours.brute_force(df, asked))
    assert [found[299, k][0] for k in range(1, 11)] == list(range(10)) and [found[0, k][0] for k in range(1, 11)] == list(range(1, 11))


def test_invalid_vectors_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    df = table(spark, [[1, 0], [0, 1], None, [0, 0], [nan, 1], [1, inf], [None, 1], [], [1, 2, 3], [1, 1]])
    found = rows(neighbours.search(df, df))
    assert {q for q, _ in found} == {0, 1, 9} and {v for v, _ in found.values()} == {0, 1, 9} and len(found) == 6
    assert neighbours.search(df.limit(0), df).count() == 0 and neighbours.search(df, df.limit(0)).count() == 0


def test_repeated_rows_count_once(spark):
    df = table(spark, [[1, 0], [0, 1]]).unionByName(table(spark, [[1, 0], [0, 1]]))
    assert rows(neighbours.search(df, df.where("vec_id = 0"))) == {(0, 1): (1, math.sqrt(2))}


def test_default_path_reaches_the_recall_it_measures(spark):
    r = np.random.default_rng(5)
    centres = r.normal(size=(30, 32))
    df = table(spark, (centres[r.integers(0, 30, 3000)] + 0.3 * r.normal(size=(3000, 32))).tolist())
    asked = df.where("vec_id % 40 = 0")
    found, exact = rows(neighbours.search(df, asked)), rows(neighbours.brute_force(df, asked))
    best = {(q, v) for (q, _), (v, _) in exact.items()}
    assert set(found) == set(exact)
    assert len({(q, v) for (q, _), (v, _) in found.items()} & best) >= 0.9 * len(best)


def test_queries_in_blocks_and_short_answers(spark, monkeypatch):
    r = np.random.default_rng(6)
    df = table(spark, r.normal(size=(200, 4)).tolist() + [[50.0, 50, 50, 50], [51.0, 50, 50, 50]])
    exact = rows(neighbours.brute_force(df, df))
    monkeypatch.setattr(neighbours, "QUERIES", 7)
    monkeypatch.setattr(neighbours, "SHARD", 30)
    assert rows(neighbours.search(df, df, probes=10**6)) == exact
    # The far pair has a list of its own: its answers come from the second pass.
    found = rows(neighbours.search(df, df.where("vec_id >= 200"), lists=20, probes=1))
    assert found == {key: value for key, value in exact.items() if key[0] >= 200}
