import random

import pandas as pd
import pytest

from packwright.operators import verify


def test_target_ranked_once_for_features_that_keep_its_rows(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(float(rng.randrange(40)), float(i % 9), float(rng.randrange(5)), None if i % 4 == 0 else float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "y double, a double, b double, gaps double").repartition(3)
    ranked = []
    centred = verify._centred_ranks
    monkeypatch.setattr(verify, "_centred_ranks", lambda pairs, column, n: ranked.append(column) or centred(pairs, column, n))
    found = {r["feature"]: r for r in verify.rank_correlation(df, "y", ["a", "b", "gaps"]).collect()}
    frame = pd.DataFrame(rows, columns=["y", "a", "b", "gaps"])
    for name in ("a", "b", "gaps"):
        known = frame[[name, "y"]].dropna()
        ranks = known.rank()
        assert found[name]["n"] == len(known)
        assert found[name]["rank_correlation"] == pytest.approx(ranks[name].corr(ranks["y"]), abs=1e-12)
    # a and b keep every row and share one ranking of y; gaps leaves rows out and ranks y anew.
    assert ranked.count("t") == 2
