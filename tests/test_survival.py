"""Survival models against written-out versions, with many ties, strata and slices."""

import math
import random
import time

import numpy as np
import pytest

from kohorta.functions import tails
from kohorta.functions.efron import tie_sums
from kohorta.operators import survival as sv, timeline


@pytest.mark.parametrize(
    "risk, tied, d",
    [
        (5.0, 5.0, 1), (5.0, 5.0, 16), (5.0, 5.0, 17), (7.3, 2.1, 40), (1e3, 1e3, 1000), (1e6, 3.0, 50),
        (1e12, 1.0, 500), (2.5e5, 2.4999e5, 250_000), (1e6, 1e6, 1_000_000), (4e6, 1.5e6, 1_000_000), (3.0, 1e-300, 20), (3.0, 0.0, 20),
    ],
)
def test_ties_in_closed_form(risk, tied, d):
    j = np.arange(d)
    m = risk - tied * (j / d)
    # Distances from the end are exact where ties are the whole risk set.
    if risk == tied:
        m = risk * (d - j) / d
    want = (math.fsum(np.log(m / risk)), math.fsum(risk / m), math.fsum((risk / m) ** 2))
    got = [float(v[0]) for v in tie_sums(np.array([risk]), np.array([tied]), np.array([d]))]
    for w, g in zip(want, got):
        assert g == pytest.approx(w, rel=1e-9, abs=1e-9)


def dense_log_rank(rows):
    """Statistic from the covariance of all strata."""
    levels = sorted({g for _, _, g in rows})
    k = len(levels)
    diff, cov = np.zeros(k), np.zeros((k, k))
    for t in sorted({t for t, e, _ in rows if e}):
        r = np.array([sum(u >= t and g == lev for u, _, g in rows) for lev in levels], float)
        d = np.array([sum(u == t and e and g == lev for u, e, g in rows) for lev in levels], float)
        n, dead = r.sum(), d.sum()
        diff += d - dead * r / n
        if n > 1:
            share = r / n
            cov += dead * (n - dead) / (n - 1) * (np.diag(share) - np.outer(share, share))
    return float(diff[:-1] @ np.linalg.pinv(cov[:-1, :-1]) @ diff[:-1]), k - 1, diff, np.diag(cov)


def random_rows(n, k, seed, times=25):
    rng = random.Random(seed)
    return [(float(rng.randint(1, times)), int(rng.random() < 0.6), f"g{rng.randrange(k):02d}") for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "t double, e int, g string")


@pytest.mark.parametrize("k", [2, 3, 7, 20])
def test_log_rank_matches_the_dense_one(spark, k):
    rows = random_rows(300, k, k)
    stat, df, diff, variance = dense_log_rank(rows)
    got = sv.log_rank_test(frame(spark, rows), "t", "e", "g")
    assert got["df"] == df
    assert got["statistic"] == pytest.approx(stat, rel=1e-9)
    assert got["p_value"] == pytest.approx(tails.chi_square(stat, df), rel=1e-7)
    table = {r["g"]: r for r in sv.log_rank(frame(spark, rows), "t", "e", "g").collect()}
    for i, g in enumerate(sorted(table)):
        assert table[g]["observed"] - table[g]["expected"] == pytest.approx(diff[i], abs=1e-9)
        assert table[g]["variance"] == pytest.approx(variance[i], rel=1e-9)


def test_log_rank_over_slices(spark, small_tasks):
    rows = random_rows(240, 5, 11, 40)
    stat = dense_log_rank(rows)[0]
    with small_tasks(9):
        assert sv.log_rank_test(frame(spark, rows), "t", "e", "g")["statistic"] == pytest.approx(stat, rel=1e-9)


def test_log_rank_of_apart_strata(spark):
    """Strata that are never at risk together, and one without any event time."""
    rows = [(1.0, 1, "a"), (1.0, 0, "b"), (2.0, 1, "b"), (2.0, 1, "a"), (5.0, 1, "c"), (6.0, 1, "d"), (7.0, 0, "d"), (0.5, 0, "z")]
    stat, df, _, _ = dense_log_rank(rows)
    got = sv.log_rank_test(frame(spark, rows), "t", "e", "g")
    assert got["df"] == df and got["statistic"] == pytest.approx(stat, rel=1e-9)


def test_five_thousand_strata(spark, monkeypatch):
    rows = [(t, e, f"{g}{i}") for i, (t, e, g) in enumerate(random_rows(20_000, 1, 5, 400))]
    rows = [(t, e, f"s{i % 5000}") for i, (t, e, _) in enumerate(rows)]
    plans, each = [], timeline.Timeline.each

    def spied(self, work, schema):
        out = each(self, work, schema)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(timeline.Timeline, "each", spied)
    got = sv.log_rank_test(frame(spark, rows), "t", "e", "g")
    times = np.arange(1, 401)
    risk, dead = np.zeros((401, 5000)), np.zeros((401, 5000))
    for t, e, g in rows:
        risk[int(t), int(g[1:])] += 1
        dead[int(t), int(g[1:])] += e
    risk = risk[::-1].cumsum(0)[::-1]
    n, d = risk[times].sum(1), dead[times].sum(1)
    spread = np.where(n > 1, d * (n - d) / np.maximum(n - 1, 1), 0)
    share = risk[times] / n[:, None]
    diff = (dead[times] - d[:, None] * share).sum(0)[:-1]
    cov = (np.diag(spread @ share) - share.T @ (spread[:, None] * share))[:-1, :-1]
    assert got["df"] == 4999 and got["statistic"] == pytest.approx(float(diff @ np.linalg.solve(cov, diff)), rel=1e-8)
    assert plans and all("Join" not in p and "Exchange" not in p and "s4999" not in p for p in plans)


def efron(rows, levels, beta):
    """Likelihood, score and information written out tie by tie."""
    value, score, info = 0.0, np.zeros(len(levels)), np.zeros((len(levels), len(levels)))
    place = {v: i for i, v in enumerate(levels)}
    w = np.exp(beta)
    for t in sorted({t for t, e, _ in rows if e}):
        r, d = np.zeros(len(levels)), np.zeros(len(levels))
        for u, e, g in rows:
            r[place[g]] += u >= t
            d[place[g]] += u == t and e
        n = int(d.sum())
        value += float(d @ beta)
        score += d
        for j in range(n):
            m = w * (r - j / n * d)
            p = m / m.sum()
            value -= math.log(m.sum())
            score -= p
            info += np.diag(p) - np.outer(p, p)
    return value, score, info


@pytest.mark.parametrize("slice_rows", [None, 7])
def test_cox_levels_over_slices(spark, small_tasks, slice_rows):
    rows = random_rows(200, 4, 3, 12)
    levels = sorted({g for _, _, g in rows})

    def fit():
        return {r["level"]: r for r in sv.cox_univariable(frame(spark, rows), "t", "e", "g").collect()}

    if slice_rows:
        with small_tasks(slice_rows):
            out = fit()
    else:
        out = fit()
    beta = np.array([out[g]["coef"] for g in levels])
    _, score, info = efron(rows, levels, beta)
    assert np.abs(score[1:]).max() < 1e-6
    errors = np.sqrt(np.diag(np.linalg.inv(info[1:, 1:])))
    assert [out[g]["std_err"] for g in levels[1:]] == pytest.approx(errors.tolist(), rel=1e-6)


@pytest.mark.parametrize("slice_rows", [None, 5])
def test_cox_number_with_ties_across_slices(spark, small_tasks, slice_rows):
    """Few times, many values each: a time takes several slices."""
    rng = random.Random(8)
    rows = [(float(rng.randint(1, 4)), int(rng.random() < 0.7), rng.gauss(0, 1)) for _ in range(120)]
    df = spark.createDataFrame(rows, "t double, e int, x double")

    def fit():
        return sv.cox_univariable(df, "t", "e", "x").first()

    if slice_rows:
        with small_tasks(slice_rows):
            out = fit()
    else:
        out = fit()

    def score(b):
        total, info = 0.0, 0.0
        for t in {t for t, e, _ in rows if e}:
            dead = [x for u, e, x in rows if u == t and e]
            risk = [x for u, _, x in rows if u >= t]
            total += sum(dead)
            for j in range(len(dead)):
                m = [sum(math.exp(b * x) * x**k for x in risk) - j / len(dead) * sum(math.exp(b * x) * x**k for x in dead) for k in range(3)]
                total -= m[1] / m[0]
                info += m[2] / m[0] - (m[1] / m[0]) ** 2
        return total, info

    s, info = score(out["coef"])
    assert abs(s) < 1e-6 and out["std_err"] == pytest.approx(1 / math.sqrt(info), rel=1e-6)


def test_three_hundred_levels(spark):
    rng = random.Random(5)
    rows = [(float(rng.randint(1, 60)), int(rng.random() < 0.8), f"g{i % 300:03d}") for i in range(9000)]
    out = sv.cox_univariable(frame(spark, rows), "t", "e", "g").collect()
    assert len(out) == 300 and all(r["converged"] for r in out)
    levels = [r["level"] for r in out]
    place, beta = {g: i for i, g in enumerate(levels)}, np.array([r["coef"] for r in out])
    w, score = np.exp(beta), np.zeros(300)
    for t in range(1, 61):
        r, d = np.zeros(300), np.zeros(300)
        for u, e, g in rows:
            r[place[g]] += u >= t
            d[place[g]] += u == t and e
        n = int(d.sum())
        score += d
        for j in range(n):
            m = w * (r - j / n * d)
            score -= m / m.sum()
    assert np.abs(score).max() < 1e-4


def test_a_step_moves_no_cells(spark, monkeypatch):
    """One narrow pass per Newton step; only its sums are exchanged."""
    plans, each = [], timeline.Timeline.each

    def spied(self, work, schema):
        out = each(self, work, schema)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(timeline.Timeline, "each", spied)
    rows = [(float(i % 50), 1, float(i % 7)) for i in range(2000)]
    started = time.time()
    fit = sv.cox_univariable(spark.createDataFrame(rows, "t double, e int, x double"), "t", "e", "x").first()
    assert fit["converged"] and time.time() - started < 120
    assert plans and all("Exchange" not in p and "Generate" not in p and "Window" not in p for p in plans)
