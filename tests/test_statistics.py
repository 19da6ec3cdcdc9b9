"""Exact tests against enumeration, and quantiles without a shuffle of all values."""

import math
import random
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from kohorta.functions import tails
from kohorta.operators import association, summary


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), min_size=3, max_size=3), min_size=2, max_size=4))
def test_network_agrees_with_enumeration(table):
    assert tails.fisher_network(table, 10**9) == pytest.approx(tails.fisher_exact(table), rel=1e-7, abs=1e-12)


def test_network_on_larger_tables():
    rng = random.Random(3)
    for rows, cols, most in ((4, 4, 4), (3, 5, 5), (2, 6, 8)):
        table = [[rng.randrange(most) for _ in range(cols)] for _ in range(rows)]
        assert tails.fisher_network(table, 10**7) == pytest.approx(tails.fisher_exact(table), rel=1e-7)
    assert tails.fisher_network([[50] * 9] * 9, 10_000) == 1.0  # no table is likelier
    assert tails.fisher_network([[40 + 3 * (i * j % 5) for j in range(9)] for i in range(9)], 10_000) is None


def test_bounds_leave_work_out():
    """A table far from independence is decided long before its tables are all there."""
    table = [[30, 2, 1], [1, 28, 3], [2, 1, 33]]
    assert 0 < tails.fisher_network(table, 200_000) < 1e-20


def brute_rank_sum(w, a, b):
    sums = [sum(c) - a * (a - 1) // 2 for c in combinations(range(a + b), a)]
    tail = sum(s <= w for s in sums) if 2 * w <= a * b else sum(s >= w for s in sums)
    return min(1.0, 2 * tail / len(sums))


@pytest.mark.parametrize("a, b", [(1, 1), (1, 6), (3, 4), (5, 5), (7, 3), (6, 8)])
def test_rank_sums_agree_with_enumeration(a, b):
    for w in range(a * b + 1):
        assert tails.rank_sum_exact(w, a, b) == pytest.approx(brute_rank_sum(w, a, b), rel=1e-12)


def test_golden_rank_sums(spark):
    """Published tables: 5 against 5 apart is 2 / 252; the critical value of 20 and 20 at 0.05 is 127."""
    assert tails.rank_sum_exact(0, 5, 5) == pytest.approx(2 / 252)
    assert tails.rank_sum_exact(127, 20, 20) <= 0.05 < tails.rank_sum_exact(128, 20, 20)
    rows = [(float(i), "a") for i in range(5)] + [(float(i + 10), "b") for i in range(5)]
    out = association.compare(spark.createDataFrame(rows, "x double, g string"), "x", "g")
    assert (out["test"], out["statistic"]) == ("rank-sum", 0.0) and out["p_value"] == pytest.approx(2 / 252)
    tied = association.compare(spark.createDataFrame(rows + [(0.0, "b")], "x double, g string"), "x", "g")
    assert tied["p_value"] != pytest.approx(tails.rank_sum_exact(tied["statistic"], 5, 6))


def quantile_rows():
    rng = random.Random(9)
    rows = [("even", rng.gauss(0, 1e6)) for _ in range(6000)]
    rows += [("tied", float(rng.choice([1, 1, 1, 2, 7]))) for _ in range(3000)]
    rows += [("wide", math.copysign(10 ** rng.uniform(-300, 300), rng.random() - 0.5)) for _ in range(3000)]
    return rows + [("one", 4.5), ("two", 1.0), ("two", 2.0), ("none", None)]


@pytest.mark.parametrize("accuracy", [10_000, 60])
def test_exact_quantiles(spark, monkeypatch, accuracy):
    monkeypatch.setattr(summary, "SKETCH_ACCURACY", accuracy)
    rows = quantile_rows()
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    out = summary.exact_quantiles(spark.createDataFrame(rows, "k string, x double").repartition(5), ["k"], "x", probs)
    got = {r["k"]: list(r)[1:] for r in out.collect()}
    for k in ("even", "tied", "wide", "one", "two"):
        assert got[k] == pytest.approx(np.quantile([x for g, x in rows if g == k], probs).tolist(), rel=1e-12)
    assert "none" not in got


def test_few_values_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(summary, "SKETCH_ACCURACY", 1000)
    seen, write = [], summary.durable
    monkeypatch.setattr(summary, "durable", lambda df: seen.append(out := write(df)) or out)
    rows = spark.range(200_000).select(F.lit("k").alias("k"), F.rand(3).alias("x"))
    summary.exact_quantiles(rows, ["k"], "x", [0.25, 0.5, 0.75]).collect()
    cells = next(df for df in seen if "__value" in df.columns)
    assert cells.count() < 200_000 * 3 * 6 / 1000
