"""Search with components of any finite size."""

import pytest
from pyspark.sql import functions as F
from test_others import brute_top

from battlelake.llm import search


def test_large_components_take_part(spark, rng, monkeypatch):
    """Large numbers that cancel, beside ordinary vectors; what is small decides the order."""
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(1, 200)]
    rows += [(300 + i, [2.0**34, 2.0**34, rng.uniform(-1, 1), 1.0]) for i in range(40)]
    rows += [(400 + i, [rng.choice([2.0**36, 2.0**44]), 0.0, rng.uniform(-1, 1), 1.0]) for i in range(20)]
    # One query sees large numbers cancel, one meets them with zeros, one has scores near 2**63.
    rows = [(i, v) for i, v in rows if i % 50] + [(50, [0.5, -0.5, 1.0, 1.0]), (100, [0.0, 0.0, 1.0, 1.0]), (150, [-0.25, 1.0, 1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    monkeypatch.setattr(search, "BLOCK_ROWS", 64)
    want = brute_top(rows)
    assert any(w[2] >= 300 for w in want)
    assert {tuple(r) for r in search.top_k(df, F.col("vec_id") % 50 == 0).collect()} == want


def test_scores_that_fit_no_long_are_errors(spark):
    rows = [(50, [2.0**40]), (1, [2.0**40]), (2, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="fits no long"):
        search.top_k(df, F.col("vec_id") == 50).collect()
    # Only among the best: a score far below them is no error.
    low = spark.createDataFrame([(50, [2.0**40]), (1, [-(2.0**40)]), *[(i, [0.25]) for i in range(2, 9)]], "vec_id long, embedding array<double>")
    assert [r["vec_id"] for r in search.top_k(low, F.col("vec_id") == 50).orderBy("rank").collect()] == [2, 3, 4, 5, 6]
