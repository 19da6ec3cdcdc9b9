"""Golden cases and properties of the event, join, reshape and survival operators."""

import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from frames import rows
from kohorta import session
from kohorta.operators import association as a, events as e, joins as j, ordered as o, reshape as w, summary, survival as sv
from kohorta.operators.collapse import collapse, collapse_two_level
from kohorta.plans import endpoints as ep, therapy as th
from kohorta.sources import tables as io


@pytest.fixture(scope="module")
def events(spark):
    data = [
        (1, "a", 3.0, 1, "x"), (2, "a", 1.0, None, None), (3, "a", None, 0, "y"), (4, "a", 1.0, 0, "z"),
        (5, "b", 2.0, 0, None), (6, "b", 9.0, None, None), (7, "c", None, None, "q"), (8, None, 4.0, 1, "n"),
    ]
    return spark.createDataFrame(data, "id int, k string, t double, ev int, v string")


def test_keep_first_and_sequence(events):
    assert rows(e.keep_first(events, "k", ["t", "id"]), "k", "id") == [("a", 2), ("b", 5), ("c", 7), (None, 8)]
    numbered = o.event_sequence(events, "k", ["t", "id"], "n")
    assert rows(numbered, "id", "n") == [(1, 3), (2, 1), (3, 4), (4, 2), (5, 1), (6, 2), (7, 1), (8, 1)]


def test_fill_directions(events):
    def filled(direction):
        return [r[1] for r in rows(o.fill(events, "v", "k", ["id"], direction), "id", "v")]

    assert filled("updown") == ["x", "y", "y", "z", None, None, "q", "n"]
    assert filled("up") == ["x", "y", "y", "z", None, None, "q", "n"]
    assert filled("down") == ["x", "x", "y", "z", None, None, "q", "n"]


def test_event_or_censor(events):
    got = rows(e.event_or_censor(events, "k", "ev", "t"), "k", "event", "time")
    # b: a known time on an unknown row censors later than the row without event.
    assert got == [("a", 1, 3.0), ("b", 0, 9.0), ("c", None, None), (None, 1, 4.0)]
    strict = e.event_or_censor(events, "k", "ev", "t", censor_from_unknown=False)
    assert ("b", 0, 2.0) in rows(strict, "k", "event", "time")


def test_first_last_ever(events):
    first = e.first_in_group(events, "k", ["id"], {"f": "v"})
    assert ("b", None) in rows(first, "k", "f") and ("a", "x") in rows(first, "k", "f")
    assert set(rows(e.last_non_null(events, "k", ["id"], "t", "l"), "k", "l")) == {
        ("a", 1.0), ("b", 9.0), ("c", None), (None, 4.0),
    }
    flagged = e.ever(events, "k", F.col("ev") == 1, "had", no="No")
    assert set(rows(flagged, "k", "had")) == {("a", "Yes"), ("b", "No"), ("c", "No"), (None, "Yes")}
    kept = e.fallback_first_row(events, "k", ["id"], F.col("ev") == 1, F.col("ev").isNull())
    assert rows(kept, "id") == [(1,), (6,), (7,), (8,)]


def test_dense_rank_order(spark):
    df = spark.createDataFrame(
        [("p", 1, 60.0), ("p", 0, 61.0), ("p", 1, 60.0), ("p", 90, None), ("p", None, 62.0)],
        "k string, line int, age double",
    )
    by_age = o.dense_rank_valid(df, "k", ["age", "line"], "r", fallback="line")
    assert rows(by_age, "r", "age") == [(1, 60.0), (1, 60.0), (2, 61.0), (90, None), (None, 62.0)]
    by_line = o.dense_rank_valid(df, "k", ["line", "age"], "r", fallback="line")
    assert ("p", 0, 61.0, 1) in rows(by_line, "k", "line", "age", "r")


def test_collapse_rules(events):
    def got(nulls):
        return {r["k"]: r["v"] for r in collapse(events, "k", "v", ["id"], "; ", nulls).collect()}

    assert got("strict") == {"a": None, "b": None, "c": "q", None: "n"}
    assert got("skip") == {"a": "x; y; z", "b": None, "c": "q", None: "n"}
    assert got("text") == {"a": "x; NA; y; z", "b": "NA; NA", "c": "q", None: "n"}
    times = {r["k"]: r["t"] for r in collapse(events, "k", "t", ["t"], nulls="text").collect()}
    assert times["a"] == "1; 1; 3; NA"


def test_two_level_collapse(spark):
    df = spark.createDataFrame(
        [(1, "p", 62.0, "c"), (2, "p", 61.0, "b"), (3, "p", 61.0, "a"), (4, "q", None, "d"), (5, "q", 60.0, "e")],
        "id int, k string, stop double, drug string",
    )
    got = rows(collapse_two_level(df, "k", "stop", ["drug"], ["id"]), "k", "drug", "stop")
    assert got == [("p", "b; a; c", "61; 62"), ("q", "e; d", None)]


def test_attribution_and_fallback(spark):
    index = spark.createDataFrame([("P1", "s", 1), ("P2", "s", 2), ("P12", None, 1)], "k string, site string, number_of_dx int")
    ev = spark.createDataFrame(
        [("P1", "s"), ("P1", "unk"), ("P2", "unk"), ("P12", None), ("P12", "unk"), ("P3", "unk")], "k string, where string"
    )
    mine = j.attribute(ev, index, {"k": "k", "where": "site"})
    assert rows(mine) == [("P1", "s"), ("P12", None)]
    strict = j.attribute(ev, index, {"k": "k", "where": "site"}, na_matches=False)
    rescued = j.attribute_fallback(ev, strict, index, "k", F.col("where") == "unk")
    assert rows(rescued) == [("P12", "unk")]
    assert rows(j.attribute_fallback(ev, strict, index, "k", F.col("where") == "unk", mode="present")) == [("P1", "unk")]
    also = j.attribute_fallback(ev, mine, index, "k", F.col("where") == "unk", also=mine.select("k"))
    assert rows(also) == [("P1", "unk"), ("P12", "unk")]


def test_substring_membership(spark):
    ev = spark.createDataFrame([("P1",), ("P12",), ("XP1Y",), ("P2",), (None,), ("",)], "k string")
    keys = spark.createDataFrame([("P1",), ("LONGER-THAN-ALL",), (None,)], "key string")
    assert rows(j.restrict(ev, keys, {"k": "key"})) == [("P1",)]
    assert rows(j.restrict(ev, keys, {"k": "key"}, substring=True)) == [("P1",), ("P12",), ("XP1Y",)]
    assert j.restrict(ev, keys, {"k": "key"}, "anti", substring=True).count() == 3
    assert j.restrict(ev, keys.limit(0), {"k": "key"}, substring=True).count() == 0


def test_nearest(spark):
    ev = spark.createDataFrame([(1, "p", 5.0), (2, "p", 9.0), (3, "p", None), (4, "q", 1.0), (5, "q", None)], "id int, k string, t double")
    anchor = spark.createDataFrame([("p", 6.0), ("q", 6.0)], "k string, t0 double")
    both = j.pick_nearest(ev, anchor, "k", "t", "t0", ["id"])
    ahead = j.pick_nearest(ev, anchor, "k", "t", "t0", ["id"], "forward")
    assert rows(both, "id") == [(1,), (4,)] and rows(ahead, "id") == [(2,), (4,)]


def test_full_join_and_merge(spark):
    a_ = spark.createDataFrame([(1, "a"), (1, "b"), (None, "n")], "k int, l string")
    b_ = spark.createDataFrame([(1, "x"), (2, "y"), (None, "m")], "k int, r string")
    assert rows(j.full_join(a_, b_, "k")) == [(1, "a", "x"), (1, "b", "x"), (2, None, "y"), (None, "n", "m")]
    index = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "k int, t int")
    one = spark.createDataFrame([(1, "p")], "k int, p string")
    two = spark.createDataFrame([(2, "q")], "k int, q string")
    other = spark.createDataFrame([(3, "z"), (1, "w")], "k int, o string")
    assert rows(j.merge_on_index(index, [one, two], [other], "k")) == [(1, 10, "p", None, "w"), (2, 20, None, "q", None)]


@pytest.mark.parametrize("buckets", [1, 4])
def test_merge_on_bucketed_tables(spark, buckets):
    index = spark.createDataFrame([(1, 10), (2, 20), (None, 30), (4, 40)], "k int, t int")
    one = spark.createDataFrame([("p", 1), ("n", None)], "`p(4;14)` string, k int")
    other = spark.createDataFrame([(1, "w"), (1, "w2"), (None, "z"), (2, "y")], "k int, o string")
    merged = j.merge_on_index(index, [one], [other], "k", buckets)
    assert merged.columns == ["k", "t", "p(4;14)", "o"]
    assert rows(merged) == [(1, 10, "p", "w"), (1, 10, "p", "w2")]
    nothing = j.merge_on_index(index.limit(0), [one], [other.limit(0)], "k", buckets)
    assert rows(nothing) == []


def test_bucketed_tables_keep_missing_keys_and_go_with_the_run(spark):
    written = session.bucketed(spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string"), "k", 4)
    assert rows(written) == [(1, "a"), (None, "b")] or rows(written) == [(None, "b"), (1, "a")]
    names = list(session._BUCKETED)
    assert names and all(spark.catalog.tableExists(n) for n in names)
    session.release(spark)
    assert not session._BUCKETED and not any(spark.catalog.tableExists(n) for n in names)


def test_buckets_follow_the_keys():
    assert [session.buckets_for(n) for n in (0, 1, 400_000, 400_001, 10**8)] == [4, 4, 4, 8, 1024]


def test_steps_side_by_side(spark):
    counts = session.together(spark, *[lambda n=n: spark.range(n).count() for n in range(12)])
    assert counts == list(range(12)) and session.together(spark) == []

    def fails():
        raise ValueError("second step")

    with pytest.raises(ValueError, match="second step"):
        session.together(spark, lambda: spark.range(3).count(), fails)


def test_reshape(spark, events):
    wide = w.pivot_occurrence(events, "k", ["v", "t"], 4, ["id"], overflow="error")
    assert rows(wide.filter("k = 'a'"), "v_1", "v_2", "v_3", "v_4", "t_1") == [("x", None, "y", "z", 3.0)]
    with pytest.raises(Exception, match="more than 2 rows"):
        w.pivot_occurrence(events, "k", ["v"], 2, ["id"]).collect()
    assert w.pivot_occurrence(events, "k", ["v"], 2, ["id"], overflow="drop").columns == ["k", "v_1", "v_2"]
    from_data = w.pivot_occurrence(events, "k", ["v"], None, ["id"])
    assert from_data.columns == ["k", "v_1", "v_2", "v_3", "v_4"]
    assert rows(from_data, "v_1", "v_4") == rows(wide, "v_1", "v_4")
    assert w.occurrences_long(events, "k", ["v"], ["id"]).count() == events.count()
    named = w.pivot_named(events, "k", "ev", "v", ["0", "1"])
    assert ("a", "y", "x") in rows(named)
    assert rows(w.pivot_named(events, "k", "ev", "v")) == rows(named)
    with pytest.raises(Exception, match="not listed"):
        w.pivot_named(events, "k", "ev", "v", ["0"]).collect()
    assert w.pivot_named(events, "k", "ev", "v", ["0"], subset=True).columns == ["k", "0"]
    assert rows(w.items_per_key(wide, "k", ["v_1", "v_2", "v_3", "v_4"])) == [("a", 3), ("c", 1), (None, 1)]


def test_first_modality(spark):
    cases = [
        ((1, 2, 3), "Radiation"), ((2, 1, 3), "Surgery"), ((3, 2, 1), "Drugs"), ((1, 1, None), None), ((1, 1, 2), None),
        ((1, None, 1), "Drugs"), ((None, 1, 1), "Surgery"), ((1, 1, 1), "Drugs"), ((None, None, 4), "Drugs"), ((None, None, None), None),
    ]
    df = spark.createDataFrame([(i, *c[0]) for i, c in enumerate(cases)], "i int, r int, s int, m int")
    got = rows(df.select("i", ep.first_modality(F.col("r"), F.col("s"), F.col("m")).alias("f")))
    assert [g[1] for g in got] == [c[1] for c in cases]


def test_prior_and_subsets(spark):
    df = spark.createDataFrame([(1.0, 1.0, "No", None), (2.0, 1.0, "Yes", "Ever"), (None, 1.0, "Yes", None)], "a double, b double, g string, c string")
    assert [r[0] for r in df.select(th.prior_treatment(F.col("a"), F.col("b"))).collect()] == [None, "Yes", None]
    assert [r[0] for r in df.select(th.treatment_subset(F.col("g"), F.col("c"))).collect()] == ["never", "chemo", "non_chemo"]


def test_kaplan_meier_by_hand(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 0), (3.0, 1), (3.0, 1), (4.0, 0), (5.0, 1), (None, 1), (2.0, None)], "t double, e int")
    curve = {r["t"]: r for r in sv.kaplan_meier(df, "t", "e").collect()}
    assert curve[1.0]["surv"] == pytest.approx(5 / 6)
    assert curve[3.0]["surv"] == pytest.approx(5 / 6 * 2 / 4)
    assert (curve[3.0]["n_risk"], curve[3.0]["n_event"], curve[2.0]["n_censor"]) == (4, 2, 1)
    assert curve[5.0]["surv"] == 0.0 and curve[5.0]["std_err"] == 0.0
    assert curve[1.0]["std_err"] == pytest.approx(5 / 6 * math.sqrt(1 / 30))


def _efron_score(data, beta):
    """Log likelihood written out row by row."""
    total = 0.0
    for t in sorted({t for t, ev, _ in data if ev}):
        dead = [x for u, ev, x in data if u == t and ev]
        risk = sum(math.exp(beta * x) for u, _, x in data if u >= t)
        tied = sum(math.exp(beta * x) for x in dead)
        total += beta * sum(dead)
        total -= sum(math.log(risk - i / len(dead) * tied) for i in range(len(dead)))
    return total


def test_cox_by_brute_force(spark):
    data = [(1.0, 1, 0.5), (2.0, 1, 1.5), (2.0, 1, 0.1), (2.0, 0, 2.0), (3.0, 0, 1.0), (4.0, 1, 3.0), (5.0, 1, 0.2), (6.0, 0, 1.1)]
    df = spark.createDataFrame(data, "t double, e int, x double")
    fit = sv.cox_univariable(df, "t", "e", "x").first()
    low, high = -5.0, 5.0
    for _ in range(200):
        a1, b1 = low + (high - low) / 3, high - (high - low) / 3
        low, high = (a1, high) if _efron_score(data, a1) < _efron_score(data, b1) else (low, b1)
    assert fit["coef"] == pytest.approx(low, abs=1e-6)
    h = 1e-4
    second = (_efron_score(data, low + h) - 2 * _efron_score(data, low) + _efron_score(data, low - h)) / h**2
    assert fit["std_err"] == pytest.approx(math.sqrt(-1 / second), rel=1e-4)
    # A 0/1 covariate gives the same model as number and as level.
    coded = df.withColumn("g", F.when(F.col("x") > 1, "yes").otherwise("no")).withColumn("d", (F.col("x") > 1).cast("double"))
    levels = {r["level"]: r for r in sv.cox_univariable(coded, "t", "e", "g").collect()}
    number = sv.cox_univariable(coded, "t", "e", "d").first()
    assert levels["no"]["hazard_ratio"] == 1.0
    assert levels["yes"]["coef"] == pytest.approx(number["coef"], abs=1e-8)
    assert levels["yes"]["std_err"] == pytest.approx(number["std_err"], rel=1e-6)
    assert (levels["yes"]["n"], levels["yes"]["n_event"]) == (4, 2)


def test_cox_three_levels_by_brute_force(spark):
    """The fitted coefficients are a stationary point of the written-out likelihood."""
    import random

    rng = random.Random(3)
    data = [(float(rng.randint(1, 8)), rng.choice([0, 1, 1]), rng.choice("abc")) for _ in range(60)]
    fit = sv.cox_univariable(spark.createDataFrame(data, "t double, e int, g string"), "t", "e", "g")
    beta = {r["level"]: r["coef"] for r in fit.collect()}

    def likelihood(b):
        total = 0.0
        for t in {t for t, ev, _ in data if ev}:
            dead = [b[g] for u, ev, g in data if u == t and ev]
            risk = sum(math.exp(b[g]) for u, _, g in data if u >= t)
            tied = sum(map(math.exp, dead))
            total += sum(dead) - sum(math.log(risk - i / len(dead) * tied) for i in range(len(dead)))
        return total

    for level in "bc":
        up, down = dict(beta), dict(beta)
        up[level] += 1e-4
        down[level] -= 1e-4
        assert likelihood(beta) >= max(likelihood(up), likelihood(down))
        assert (likelihood(up) - likelihood(down)) / 2e-4 == pytest.approx(0.0, abs=1e-5)


def test_cox_without_contrast(spark):
    df = spark.createDataFrame([(1.0, 0, "a", 1.0), (2.0, 0, "b", 2.0), (3.0, 0, "b", 3.0)], "t double, e int, g string, x double")
    assert [(r["level"], r["n"], r["coef"]) for r in sv.cox_univariable(df, "t", "e", "g").collect()] == [("a", 1, None), ("b", 2, None)]
    assert sv.cox_univariable(df, "t", "e", "x").first()["coef"] is None
    assert sv.cox_univariable(df.filter("g = 'b'"), "t", "e", "g").count() == 1


def test_log_rank_by_hand(spark):
    df = spark.createDataFrame([(1.0, 1, "a"), (2.0, 1, "b"), (3.0, 0, "a"), (4.0, 1, "b")], "t double, e int, g string")
    table = {r["g"]: r for r in sv.log_rank(df, "t", "e", "g").collect()}
    assert table["a"]["observed"] == 1 and table["a"]["expected"] == pytest.approx(2 / 4 + 1 / 3 + 0)
    assert table["a"]["variance"] == pytest.approx(1 / 4 + 2 / 9)
    test = sv.log_rank_test(df, "t", "e", "g")
    assert test["statistic"] == pytest.approx((1 - 5 / 6) ** 2 / (1 / 4 + 2 / 9))


def test_fisher_beyond_two_by_two(spark):
    from itertools import permutations

    from kohorta.functions import tails

    table = [[3, 0, 1], [0, 2, 1]]
    rows_, cols = [i for i, r in enumerate(table) for _ in range(sum(r))], [j for r in table for j, n in enumerate(r) for _ in range(n)]

    def likelihood(cells):
        import math

        return 1 / math.prod(math.factorial(n) for r in cells for n in r)

    def cells_of(order):
        out = [[0] * 3, [0] * 3]
        for i, j in zip(rows_, order):
            out[i][j] += 1
        return out

    drawn = [likelihood(cells_of(p)) for p in permutations(cols)]
    want = sum(x <= likelihood(table) * (1 + 1e-9) for x in drawn) / len(drawn)
    assert tails.fisher_exact(table) == pytest.approx(want)
    assert tails.fisher_exact([[3, 1], [1, 3]]) == pytest.approx(34 / 70)


def test_association_choices(spark):
    df = spark.createDataFrame(
        [("a", 1.0, "x"), ("a", 2.0, "x"), ("a", 2.0, "y"), ("b", 2.0, "y"), ("b", 5.0, "y"), ("b", 6.0, "y")], "g string, v double, c string"
    )
    number = a.compare(df, "v", "g")
    assert number["test"] == "rank-sum" and number["statistic"] == pytest.approx(1 + 3 + 3 - 6)
    assert a.compare(df, "c", "g")["test"] == "fisher"
    assert a.compare(df, "c", "g")["p_value"] == pytest.approx(0.4)
    big = df.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(20))))
    assert a.compare(big, "c", "g")["test"] == "chi-square"
    assert a.compare(df, "v", "c")["test"] == "rank-sum"


def test_rare_levels_of_large_tables_are_exact(spark):
    import math

    from kohorta.functions import tails

    # A level of 3 rows, all in a stratum of 1,000 of 4,000.
    counts = spark.createDataFrame([("x", "a", 3), ("y", "a", 997), ("y", "b", 3000)], "c string, g string, n int")
    big = counts.select("c", "g", F.explode(F.sequence(F.lit(1), "n")))
    found = a.compare(big, "c", "g")
    assert found["test"] == "fisher"
    assert found["p_value"] == pytest.approx(math.comb(1000, 3) / math.comb(4000, 3), rel=1e-9)
    third = counts.union(spark.createDataFrame([("y", "d", 2000)], counts.schema))
    found = a.compare(third.select("c", "g", F.explode(F.sequence(F.lit(1), "n"))), "c", "g")
    assert found["test"] == "fisher"
    assert found["p_value"] == pytest.approx(math.comb(1000, 3) / math.comb(6000, 3), rel=1e-6)
    for table in ([[3, 0, 1], [0, 2, 1]], [[2, 1], [5, 9], [40, 33]], [[1, 0, 2, 3], [9, 30, 12, 7]]):
        assert tails.fisher_rare(table) == pytest.approx(tails.fisher_exact(table))
    assert tails.fisher_2x2(2, 0, 10**9 - 2, 10**9) == pytest.approx(0.5, rel=1e-6)


def test_dated_files_and_rows(spark, tmp_path):
    import datetime as dt

    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    day = dt.date(2025, 7, 14)
    paths = io.write_all(df, [("csv", f"{tmp_path}/x"), ("parquet", f"{tmp_path}/x")], day)
    assert paths == [f"{tmp_path}/x_2025-07-14.csv", f"{tmp_path}/x_2025-07-14.parquet"]
    assert rows(io.read_csv(spark, paths[0], "k int, v string")) == rows(spark.read.parquet(paths[1]))
    assert rows(io.add_rows(df, [{"k": 3}])) == [(1, "a"), (2, None), (3, None)]


EVENTS = st.lists(
    st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 5)), st.one_of(st.none(), st.sampled_from("abc"))),
    min_size=1, max_size=25,
)
QUICK = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@QUICK
@given(EVENTS)
def test_properties(spark, data):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "id int, k int, t int, v string")
    shuffled = df.repartition(3, "v")
    first = e.keep_first(df, "k", ["t", "id"])
    assert first.count() == df.select("k").distinct().count()
    assert rows(first) == rows(e.keep_first(shuffled, "k", ["t", "id"]))
    once = o.fill(df, "v", "k", ["id"])
    assert rows(o.fill(once, "v", "k", ["id"]), *df.columns) == rows(once, *df.columns)
    keys = df.filter("t > 2").select("k")
    semi, anti = j.restrict(df, keys, "k"), j.restrict(df, keys, "k", "anti")
    assert rows(semi.unionByName(anti)) == rows(df)
    k = max(r[0] for r in df.groupBy("k").count().select("count").collect())
    wide = w.pivot_occurrence(df, "k", ["v"], k, ["id"])
    long = w.unpivot(wide, "k", [f"v_{i}" for i in range(1, k + 1)])
    assert rows(long, "k", "value") == rows(df.filter("v is not null"), "k", "v")
    curve = sv.kaplan_meier(df.withColumn("e", F.col("v").isNotNull().cast("int")), "t", "e").orderBy("t").collect()
    steps = [1.0, *[r["surv"] for r in curve]]
    assert all(0.0 <= y <= x + 1e-12 for x, y in zip(steps, steps[1:]))


def test_csv_keeps_every_text(spark, tmp_path):
    texts = ['a "b", c', "two\nlines", "", None, "  edges ", 'x""y', "NA", "back\\slash", "\r\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, v string")
    path = io.write_csv(df, f"{tmp_path}/t")
    assert rows(io.read_csv(spark, path, "k int, v string"), "k", "v") == rows(df, "k", "v")
    assert io.read_csv(spark, path, "k int, v string", missing="NA").filter("v IS NULL").count() == 2
    with pytest.raises(Exception):
        io.read_csv(spark, path, "k int, v int").collect()


def test_summary_without_stratum_and_with_the_name_of_the_total(spark):
    df = spark.createDataFrame([("Overall", "x", 1.0), ("a", "y", 3.0), ("a", "y", 5.0), (None, "z", 9.0)], "g string, c string, v double")
    labels = {(r["is_total"], r["stratum"], r["level"]): r["n"] for r in summary.summary_categorical(df, ["c"], "g", overall=True).collect()}
    assert labels == {(False, "Overall", "x"): 1, (False, "a", "y"): 2, (True, "Overall", "x"): 1, (True, "Overall", "y"): 2}
    numbers = {(r["is_total"], r["stratum"]): r["median"] for r in summary.summary_continuous(df, ["v"], "g", overall=True).collect()}
    assert numbers == {(False, "Overall"): 1.0, (False, "a"): 4.0, (True, "Overall"): 3.0}


def test_models_that_do_not_converge_say_so(spark):
    apart = spark.createDataFrame([(float(t), int(g == "b"), g) for t in range(1, 21) for g in "ab"], "t double, e int, g string")
    fit = {r["level"]: r for r in sv.cox_univariable(apart, "t", "e", "g").collect()}
    assert fit["b"]["converged"] is False and fit["b"]["p_value"] is None and fit["b"]["std_err"] is None
    mixed = apart.withColumn("e", (F.col("t") % 3 == 0).cast("int"))
    assert {r["converged"] for r in sv.cox_univariable(mixed, "t", "e", "g").collect()} == {True}
    one = sv.log_rank_test(apart.filter("g = 'a'"), "t", "e", "g")
    assert one == {"statistic": None, "df": 0, "p_value": None}


def test_many_levels(spark):
    df = spark.range(600).select((F.col("id") % 7).cast("double").alias("t"), (F.col("id") % 2).cast("int").alias("e"), F.format_string("g%03d", F.col("id") % 150).alias("g"))
    out = sv.log_rank(df, "t", "e", "g")
    assert out.count() == 150 and out.agg(F.sum("observed"), F.round(F.sum("expected"), 6)).first() == (300, 300.0)


def test_rolling_hashes_are_those_of_the_pieces():
    import random

    rng = random.Random(5)
    for _ in range(200):
        text = "".join(rng.choice("abé🙂 ") for _ in range(rng.randrange(0, 40)))
        found = j.window_hashes(text, [1, 2, 5, 50])
        for n, hashes in found.items():
            pieces = {text[i : i + n] for i in range(len(text) - n + 1)}
            assert sorted(hashes.tolist()) == sorted(j.window_hashes(p, [n])[n][0] for p in pieces)


def test_substring_membership_by_brute_force(spark):
    import random

    rng = random.Random(6)
    texts = ["".join(rng.choice("abcé") for _ in range(rng.randrange(0, 9))) for _ in range(300)] + [None]
    listed = ["".join(rng.choice("abcé") for _ in range(rng.randrange(3, 6))) for _ in range(25)] + [None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, k string")
    keys = spark.createDataFrame([(v,) for v in listed], "key string")
    want = {i for i, t in enumerate(texts) if t is not None and any(v is not None and v in t for v in listed)}
    assert {r["i"] for r in j.restrict(df, keys, {"k": "key"}, substring=True).collect()} == want
    every = j.restrict(df, spark.createDataFrame([("",)], "key string"), {"k": "key"}, substring=True)
    assert every.count() == 300
