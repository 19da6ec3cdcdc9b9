"""Kaplan-Meier, log-rank and univariable Cox models from counts per time.

Rows are reduced to counts per (stratum, time) with map-side combine. At-risk
numbers and products are running sums over the distinct times, which are cut
into slices when there are too many for one task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from kohorta.functions import tails
from kohorta.functions.efron import tie_sums
from kohorta.operators.ordered import event_sequence, running_totals
from kohorta.operators.timeline import SLICE, Timeline, lay_out, numbers, runs
from kohorta.session import durable, settled


def _complete(df: DataFrame, *columns: str) -> DataFrame:
    known = df
    for c in columns:
        known = known.filter(F.col(c).isNotNull())
    return known


def _levels(df: DataFrame, by: str, levels: Sequence | None) -> list:
    """The levels a result names one by one: those given, or all in the data, sorted."""
    if levels is not None:
        return list(levels)
    return sorted(r[0] for r in df.select(by).distinct().collect())


def kaplan_meier(df: DataFrame, time: str, event: str, by: str | None = None) -> DataFrame:
    """Survival curve per stratum: at risk, events, censored, survival, std. error."""
    keys = [by] if by else []
    rows = _complete(df, time, event, *keys)
    counts = settled(
        rows.groupBy(*keys, time).agg(
            F.sum(F.col(event).cast("bigint")).alias("n_event"),
            F.count(F.lit(1)).alias("__rows"),
        )
    )
    risk = running_totals(counts, keys, [f"-{time}"], {"n_risk": "__rows"})
    d, n = F.col("n_event"), F.col("n_risk")
    alive = d < n
    terms = risk.withColumns(
        {
            "n_censor": F.col("__rows") - d,
            "__log": F.when(alive, F.log1p(-d / n)).otherwise(F.lit(0.0)),
            "__var": F.when(alive, d / (n.cast("double") * (n - d))).otherwise(F.lit(0.0)),
            # ln(0) would be lost in a sum, so the step to zero is carried apart.
            "__end": F.when(alive, F.lit(0)).otherwise(F.lit(1)),
        }
    )
    sums = running_totals(
        terms, keys, [time], {"__slog": "__log", "__svar": "__var", "__send": "__end"}
    )
    surv = F.when(F.col("__send") > 0, F.lit(0.0)).otherwise(F.exp("__slog"))
    return sums.select(
        *keys,
        time,
        "n_risk",
        "n_event",
        "n_censor",
        surv.alias("surv"),
        (surv * F.sqrt("__svar")).alias("std_err"),
    )


def _cells(rows: DataFrame, time: str, event: str, by: str) -> DataFrame:
    """Events and rows per (time, level) that is there; no time is filled up with levels."""
    return settled(
        rows.groupBy(time, by).agg(F.sum(F.col(event).cast("bigint")).alias("d"), F.count(F.lit(1)).alias("n"))
    )


def _at_times(cells: DataFrame, time: str) -> DataFrame:
    """Per time the weight ``c`` of the covariance, and sums over the times up to it.

    A row is at risk at its own time and all before, so what a level has at risk
    over all event times is a sum over its own cells of such a running sum.
    """
    times = cells.groupBy(time).agg(F.sum("d").alias("d"), F.sum("n").alias("n"))
    risk = running_totals(times, [], [f"-{time}"], {"r": "n"})
    d, r = F.col("d"), F.col("r").cast("double")
    spread = F.when((d > 0) & (r > 1), d * (r - d) / (r - 1)).otherwise(F.lit(0.0))
    terms = risk.select(time, (d / r).alias("e"), (spread / r).alias("s"), (spread / r / r).alias("c"))
    return settled(running_totals(terms, [], [time], {"upto_e": "e", "upto_s": "s", "upto_c": "c"}))


def _by_level(cells: DataFrame, at: DataFrame, time: str, by: str) -> DataFrame:
    """Observed and expected events, diagonal and variance of every level."""
    own = running_totals(cells, [by], [f"-{time}"], {"r_i": "n"})
    n = F.col("n")
    return own.join(at, time).groupBy(by).agg(
        F.sum("d").alias("observed"),
        F.sum(n * F.col("upto_e")).alias("expected"),
        F.sum(n * F.col("upto_s")).alias("diagonal"),
        # The squared number at risk grows by n (2 r - n) at a cell.
        F.sum(n * F.col("upto_s") - n * (2 * F.col("r_i") - n) * F.col("upto_c")).alias("variance"),
    )


def log_rank(
    df: DataFrame, time: str, event: str, by: str, levels: Sequence | None = None
) -> DataFrame:
    """Per stratum: observed and expected events and the variance of the difference.

    The work follows the cells that are there, not times by strata. With
    ``levels`` those have a row each, also without data.
    """
    rows = _complete(df, time, event, by)
    if levels is not None:
        rows = rows.filter(F.col(by).isin(list(levels)))
    cells = _cells(rows, time, event, by)
    out = _by_level(cells, _at_times(cells, time), time, by).select(by, "observed", "expected", "variance")
    if levels is None:
        return out
    named = df.sparkSession.createDataFrame([(x,) for x in levels], df.select(by).schema)
    if not levels:
        return out
    zero = {"observed": 0, "expected": 0.0, "variance": 0.0}
    seen = named.join(out, by, "left")
    return seen.select(by, *[F.coalesce(F.col(c), F.lit(z).cast(dict(out.dtypes)[c])).alias(c) for c, z in zero.items()])


def log_rank_test(
    df: DataFrame, time: str, event: str, by: str, levels: Sequence | None = None
) -> dict[str, float]:
    """Chi-square statistic, degrees of freedom and p-value between the strata.

    With fewer than two strata there is nothing to compare: statistic and p-value
    are missing. The covariance of the strata is never formed: the statistic comes
    from conjugate gradients, each of whose products is a pass over the cells. Per
    stratum the driver holds a few numbers.
    """
    rows = _complete(df, time, event, by)
    if levels is not None:
        rows = rows.filter(F.col(by).isin(list(levels)))
    cells = _cells(rows, time, event, by)
    at = _at_times(cells, time)
    strata = event_sequence(durable(_by_level(cells, at, time, by)), [], [by], "number")
    strata = durable(strata.select(by, (F.col("number") - 1).alias("level"), "observed", "expected", "diagonal"))
    found = strata.select("level", (F.col("observed") - F.col("expected")).alias("difference"), "diagonal").toPandas()
    k = (len(found) if levels is None else len(levels)) - 1
    if k < 1 or not len(found):
        return {"statistic": None, "df": max(k, 0), "p_value": None}
    found = found.sort_values("level")
    placed = cells.join(strata.select(by, "level"), by).join(at.select(time, "c"), time)
    line = lay_out(placed.select(time, "level", "n", "c"), time)
    stat = _quadratic_form(
        found["difference"].to_numpy(), found["diagonal"].to_numpy(), lambda v: _covariance_times(line, v, found["diagonal"].to_numpy())
    )
    return {"statistic": stat, "df": k, "p_value": tails.chi_square(stat, k)}


def _quadratic_form(b: np.ndarray, diagonal: np.ndarray, times: Callable[[np.ndarray], np.ndarray]) -> float:
    """b' V^+ b by conjugate gradients, preconditioned with the diagonal.

    V has no inverse (its rows sum to zero), but b is in its range, so the steps
    converge to one of the solutions, which all give the same form.
    """
    used = diagonal > 1e-12 * max(diagonal.max(), 0.0)
    inverse = np.where(used, 1.0 / np.where(used, diagonal, 1.0), 0.0)
    x, r = np.zeros_like(b), np.where(used, b, 0.0)
    z = inverse * r
    p, rz = z, float(r @ z)
    first = rz
    for _ in range(10 * len(b) + 50):
        if rz <= 1e-26 * first or rz == 0.0:
            break
        q = np.where(used, times(p), 0.0)
        step = rz / float(p @ q)
        x, r = x + step * p, r - step * q
        z = inverse * r
        rz, before = float(r @ z), rz
        p = z + rz / before * p
    return float(b @ x)


def _covariance_times(line: Timeline, v: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
    """V v: the diagonal times v, less the sum over times of c r (r'v).

    r'v at a time is a running sum of n v over the cells from the latest time on;
    summed with the weights c up to each cell's time and added up per level it
    gives the product, without a level's numbers at risk ever being written out.
    """
    time = line.time

    def masses(part):
        starts = runs(part, time)
        n, c = numbers(part, "n", "c")
        return starts, n, c[starts], np.add.reduceat(n * v[part.column("level").to_numpy()], starts)

    later = [0.0] * line.slices  # r'v from the slices of later times
    earlier = [0.0] * line.slices  # weighted sums over the slices of earlier times
    if line.slices > 1:
        found = line.by_slice(lambda _, part: [(float(masses(part)[3].sum()),)], "mass double")
        for s in range(1, line.slices):
            later[s] = later[s - 1] + found.get(s - 1, [0.0])[0]

        def weighted(number, part):
            _, _, c, mass = masses(part)
            return [(float((c * (later[number] + np.cumsum(mass))).sum()),)]

        found = line.by_slice(weighted, "mass double")
        for s in range(line.slices - 2, -1, -1):
            earlier[s] = earlier[s + 1] + found.get(s + 1, [0.0])[0]

    def products(number, part):
        starts, n, c, mass = masses(part)
        y = c * (later[number] + np.cumsum(mass))
        upto = earlier[number] + y.sum() - np.cumsum(y) + y
        each = n * np.repeat(upto, np.diff(np.append(starts, len(n))))
        level, place = np.unique(part.column("level").to_numpy(), return_inverse=True)
        return zip(level.tolist(), np.bincount(place, each).tolist())

    sums = line.each(products, "level bigint, value double").groupBy("level").agg(F.sum("value").alias("value"))
    sums = sums.toPandas()
    out = diagonal * v
    out[sums["level"].to_numpy()] -= sums["value"].to_numpy()
    return out


@dataclass(frozen=True)
class Fit:
    """Coefficients, their covariance, and whether the steps came to rest."""

    beta: np.ndarray
    covariance: np.ndarray
    converged: bool
    iterations: int


def _newton(
    moments: Callable[[np.ndarray], tuple[float, np.ndarray, np.ndarray]],
    size: int,
    steps: int = 30,
    tolerance: float = 1e-10,
) -> Fit:
    """Maximise a concave likelihood.

    Converged means that likelihood and coefficients both stand still: where a
    level has no events the likelihood flattens while the coefficient runs off.
    A step that helps at no length is not taken.
    """
    beta = np.zeros(size)
    value, score, info = moments(beta)
    for step in range(1, steps + 1):
        move = np.linalg.pinv(info) @ score
        better = False
        for _ in range(20):
            new_value, new_score, new_info = moments(beta + move)
            if np.isfinite(new_value) and new_value >= value - 1e-12 * abs(value):
                better = True
                break
            move = move / 2.0
        if not better:
            return Fit(beta, np.linalg.pinv(info), False, step)
        beta = beta + move
        flat = abs(new_value - value) <= tolerance * (abs(value) + tolerance)
        still = np.abs(move).max(initial=0.0) <= 1e-4 * (1.0 + np.abs(beta).max(initial=0.0))
        value, score, info = new_value, new_score, new_info
        if flat:
            return Fit(beta, np.linalg.pinv(info), bool(still), step)
    return Fit(beta, np.linalg.pinv(info), False, steps)


def _with_earlier_risk(line: Timeline, levels: int) -> Timeline:
    """Each slice with what the levels have at risk from the slices before it.

    Such rows have no events and come first, with the slice's latest time, so a
    slice needs no other to be worked on.
    """
    table, time = line.table, line.time
    spark = table.sparkSession
    counts = table.groupBy(SLICE, "level").agg(F.sum("n").alias("n"))
    grid = spark.range(line.slices).select(
        F.col("id").cast("int").alias(SLICE), F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level")
    )
    before = Window.partitionBy("level").orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = grid.join(counts, [SLICE, "level"], "left").withColumn("n", F.sum("n").over(before)).filter("n > 0")
    latest = table.groupBy(SLICE).agg(F.max(time).alias(time))
    carried = carried.join(latest, SLICE).select(time, "level", "n", F.lit(0).cast("bigint").alias("d"), SLICE, F.lit(0).alias("own"))
    both = table.select(time, "level", "n", "d", SLICE, F.lit(1).alias("own")).unionByName(carried)
    both = both.repartition(line.slices, SLICE).sortWithinPartitions(SLICE, "own", F.col(time).desc())
    return Timeline(durable(both), time, line.slices)


# Numbers (times by levels) of a slice that are worked on at once.
CELLS_AT_ONCE = 1_000_000


def _cox_levels(df: DataFrame, time: str, event: str, by: str, levels: Sequence) -> Fit:
    """Coefficients of a categorical covariate against its first level.

    A step is one pass over the cells: in numpy each slice adds its share to the
    likelihood, the score and the matrix of second derivatives, and the entries
    of those are added up by Spark.
    """
    spark, p = df.sparkSession, len(levels)
    named = spark.createDataFrame(list(zip(levels, range(p))), df.select(by).withColumn("level", F.lit(0)).schema)
    cells = _cells(df, time, event, by).join(named, by).select(time, "level", "n", "d")
    line = lay_out(durable(cells), time)
    events = np.zeros(p)
    for r in line.table.groupBy("level").agg(F.sum("d").alias("d")).collect():
        events[r["level"]] = r["d"]
    line = _with_earlier_risk(line, p) if line.slices > 1 else Timeline(line.table.withColumn("own", F.lit(1)), time, 1)
    upper = np.triu_indices(p)

    def moments(beta: np.ndarray):
        free = np.concatenate(([0.0], beta))
        top = free.max()
        weight = np.exp(free - top)

        def work(_, part):
            own = part.column("own").to_numpy() == 1
            level, (n, d) = part.column("level").to_numpy(), numbers(part, "n", "d")
            at_risk = np.bincount(level[~own], n[~own], p)
            part, level, n, d = part.filter(pa.array(own)), level[own], n[own], d[own]
            starts = runs(part, time)
            row = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(n))))
            value, score, info = 0.0, np.zeros(p), np.zeros((p, p))
            step = max(1, CELLS_AT_ONCE // p)
            for a in range(0, len(starts), step):
                here = slice(starts[a], starts[a + step] if a + step < len(starts) else len(n))
                size = min(step, len(starts) - a)
                place = (row[here] - a) * p + level[here]
                risk = np.bincount(place, n[here], size * p).reshape(size, p).cumsum(0) + at_risk
                at_risk = risk[-1]
                dead = np.bincount(place, d[here], size * p).reshape(size, p)
                some = dead.sum(1) > 0
                risk, dead, ties = risk[some] * weight, dead[some] * weight, dead[some].sum(1)
                a_mass, b_mass = risk.sum(1), dead.sum(1)
                log, first, second = tie_sums(a_mass, b_mass, ties)
                value += float((ties * np.log(a_mass) + log).sum())
                q = risk / a_mass[:, None]
                u = np.divide(dead, b_mass[:, None], out=np.zeros_like(dead), where=b_mass[:, None] > 0)
                score += q.T @ first - u.T @ (first - ties)
                mixed = q.T @ ((second - first)[:, None] * u)
                info += q.T @ (second[:, None] * q) - mixed - mixed.T + u.T @ ((second - 2 * first + ties)[:, None] * u)
            return [([value, *score.tolist(), *info[upper].tolist()],)]

        sums = line.each(work, "sums array<double>").select(F.posexplode("sums").alias("at", "value"))
        sums = sums.groupBy("at").agg(F.sum("value").alias("value")).toPandas()
        total = np.zeros(1 + p + len(upper[0]))
        total[sums["at"].to_numpy()] = sums["value"].to_numpy()
        score, info = total[1 : p + 1], np.zeros((p, p))
        info[upper] = total[p + 1 :]
        info = np.diag(score) - (info + np.triu(info, 1).T)
        value = float(events[1:] @ beta) - total[0] - top * float(events.sum())
        return value, (events - score)[1:], info[1:, 1:]

    return _newton(moments, p - 1)


def _cox_number(df: DataFrame, time: str, event: str, x: str) -> Fit:
    """Coefficient of one numeric covariate.

    A step is a narrow pass over the cells, after one more that says what each
    slice passes on where there are several. A time may run over several slices:
    its ties travel on, and the slice where it ends counts it.
    """
    e = F.col(event).cast("bigint")
    middle = df.agg(F.avg(x)).first()[0]
    cells = durable(
        df.groupBy(F.col(time).alias("time"), (F.col(x).cast("double") - F.lit(middle)).alias("x")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(e).alias("d")
        )
    )
    weighted = cells.agg(F.sum(F.col("d") * F.col("x")).alias("s")).first()["s"]
    line = lay_out(cells, "time", ["x"])
    ends = {}
    if line.slices > 1:
        kind = dict(cells.dtypes)["time"]
        ends = line.by_slice(
            lambda _, part: [(part.column("time")[0].as_py(), part.column("time")[-1].as_py(), len(runs(part, "time")) == 1)],
            f"first {kind}, last {kind}, single boolean",
        )
    order = sorted(ends)
    goes_on = {s for s, following in zip(order, order[1:]) if ends[s][1] == ends[following][0]}

    def masses(part, beta):
        starts = runs(part, "time")
        x, n, d = numbers(part, "x", "n", "d")
        w = np.exp(beta * x)
        risk = np.stack([n * w, n * w * x, n * w * x * x])
        tied = np.stack([d, d * w, d * w * x, d * w * x * x])
        return np.add.reduceat(risk, starts, axis=1), np.add.reduceat(tied, starts, axis=1)

    def moments(beta: np.ndarray):
        b = float(beta[0])
        carry: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        if line.slices > 1:

            def totals(_, part):
                risk, tied = masses(part, b)
                return [(risk.sum(1).tolist(), tied[:, -1].tolist())]

            found = line.by_slice(totals, "risk array<double>, tied array<double>")
            risk, tied = np.zeros(3), np.zeros(4)
            for s in order:
                carry[s] = (risk, tied)
                risk = risk + np.array(found[s][0])
                # The ties of the last time travel on, with those that came along it.
                own = np.array(found[s][1]) + (tied if ends[s][2] else 0.0)
                tied = own if s in goes_on else np.zeros(4)

        def work(number, part):
            risk, tied = masses(part, b)
            before, ties = carry.get(number, (np.zeros(3), np.zeros(4)))
            risk = np.cumsum(risk, axis=1) + before[:, None]
            tied[:, 0] += ties
            if number in goes_on:
                risk, tied = risk[:, :-1], tied[:, :-1]
            some = tied[0] > 0
            (r0, r1, r2), (d, d0, d1, d2) = risk[:, some], tied[:, some]
            log, first, second = tie_sums(r0, d0, d)
            q = r1 / r0
            u1, u2 = (np.divide(v, d0, out=np.zeros_like(v), where=d0 > 0) for v in (d1, d2))
            value = (d * np.log(r0) + log).sum()
            score = (q * first - u1 * (first - d)).sum()
            squares = q * q * second - 2 * q * u1 * (second - first) + u1 * u1 * (second - 2 * first + d)
            info = (r2 / r0 * first - u2 * (first - d) - squares).sum()
            return [(float(value), float(score), float(info))]

        out = line.each(work, "l double, g double, h double").agg(*[F.sum(c).alias(c) for c in "lgh"]).first()
        return b * weighted - out["l"], np.array([weighted - out["g"]]), np.array([[out["h"]]])

    return _newton(moments, 1)


COX_SCHEMA = (
    "covariate string, level string, n bigint, n_event bigint, coef double, hazard_ratio double,"
    " std_err double, conf_low double, conf_high double, p_value double, converged boolean, iterations int"
)


def cox_univariable(
    df: DataFrame,
    time: str,
    event: str,
    covariate: str,
    levels: Sequence | None = None,
) -> DataFrame:
    """Proportional hazards model of one covariate, ties by Efron's method.

    Text covariates (or given ``levels``) are compared with their first level;
    numbers get one coefficient. Each Newton step is a pass over counts.
    Where the fit did not converge, ``converged`` is false and there is no
    standard error, limit or p-value.
    """
    rows = _complete(df, time, event, covariate)
    spark = df.sparkSession
    out = []
    nothing = [None] * 8

    def line(level, n, n_event, fit: Fit, i: int):
        coef = float(fit.beta[i])
        ratio = math.exp(coef) if coef < 700 else math.inf
        if not fit.converged:
            return (covariate, level, n, n_event, coef, ratio, *[None] * 4, False, fit.iterations)
        se = math.sqrt(float(fit.covariance[i, i]))
        limits = [coef - 1.959963984540054 * se, coef + 1.959963984540054 * se]
        low, high = [math.exp(v) if v < 700 else math.inf for v in limits]
        p_value = tails.normal_two_sided(coef / se if se else 0.0)
        return (covariate, level, n, n_event, coef, ratio, se, low, high, p_value, True, fit.iterations)

    if levels is not None or dict(df.dtypes)[covariate] == "string":
        names = _levels(rows, covariate, levels)
        rows = rows.filter(F.col(covariate).isin(names))
        size = {
            r[covariate]: (r["n"], r["e"])
            for r in rows.groupBy(covariate)
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(event).cast("bigint")).alias("e"))
            .collect()
        }
        names = [v for v in names if v in size]
        if len(names) < 2 or not any(e for _, e in size.values()):
            # Nothing to compare: the sizes are all there is to say.
            out += [(covariate, str(v), *size[v], *nothing) for v in names]
            return spark.createDataFrame(out, COX_SCHEMA)
        fit = _cox_levels(rows, time, event, covariate, names)
        base = (covariate, str(names[0]), *size[names[0]], 0.0, 1.0, *[None] * 4)
        out.append((*base, fit.converged, fit.iterations))
        out += [line(str(name), *size[name], fit, i) for i, name in enumerate(names[1:])]
    else:
        n, n_event = rows.agg(F.count(F.lit(1)), F.sum(F.col(event).cast("bigint"))).first()
        if not n_event:
            return spark.createDataFrame([(covariate, None, n, n_event, *nothing)], COX_SCHEMA)
        out.append(line(None, n, n_event, _cox_number(rows, time, event, covariate), 0))
    return spark.createDataFrame(out, COX_SCHEMA)
