"""Groups beyond one task's share give the same results as small ones."""

import random

import pytest
from pyspark.sql import functions as F

from frames import rows
from kohorta import session
from kohorta.catalog.flagship import flagship
from kohorta.operators import association, ordered, summary, survival
from kohorta.operators.collapse import collapse, collapse_two_level
from kohorta.session import large_groups


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(7)
    data = []
    for i in range(600):
        key = rng.choice([1, 1, 1, None, 2, 3, *range(10, 30)])
        data.append(
            (i, key, rng.choice([None, "a", "b", "c"]), rng.choice([None, *range(12)]), rng.random() * 10)
        )
    rng.shuffle(data)
    schema = "id bigint, k bigint, cat string, t bigint, x double"
    return spark.createDataFrame(data, schema).repartition(5).cache()


def same(small_tasks, build, limit=20):
    want = rows(build())
    with small_tasks(limit):
        got = rows(build())
    assert len(want) == len(got)
    for a, b in zip(want, got):
        for x, y in zip(a, b):
            assert x == (pytest.approx(y, rel=1e-9, abs=1e-9) if isinstance(y, float) else y)


def test_finds_only_large_groups(events, small_tasks):
    assert large_groups(events, ["k"]) is None
    with small_tasks(50):
        found = {r["k"] for r in large_groups(events, ["k"]).collect()}
    sizes = {r["k"]: r["count"] for r in events.groupBy("k").count().collect()}
    assert found == {k for k, n in sizes.items() if n > 50} and found


def test_sequence(events, small_tasks):
    same(small_tasks, lambda: ordered.event_sequence(events, "k", ["-t", "id"]))
    same(small_tasks, lambda: ordered.event_sequence(events, [], ["id"]))


@pytest.mark.parametrize("direction", ["up", "down", "updown", "downup"])
def test_fill(events, small_tasks, direction):
    same(small_tasks, lambda: ordered.fill(events, ["cat", "t"], "k", ["-x", "id"], direction))


def test_running_totals(events, small_tasks):
    same(small_tasks, lambda: ordered.running_totals(events, "k", ["-id"], {"a": "t", "b": "x"}))
    same(small_tasks, lambda: ordered.running_totals(events, [], ["id"], {"a": "t"}))


def test_dense_rank(events, small_tasks):
    def build():
        return ordered.dense_rank_valid(events.withColumn("code", F.lit(99)), "k", ["t", "cat"], fallback="code")

    same(small_tasks, build)


@pytest.mark.parametrize("nulls", ["strict", "skip", "text"])
def test_collapse(events, small_tasks, nulls):
    same(small_tasks, lambda: collapse(events, "k", ["cat", "t"], ["t", "id"], "; ", nulls))


def test_two_level_collapse(events, small_tasks):
    same(small_tasks, lambda: collapse_two_level(events, "k", "t", ["cat"], ["id"]))


def test_statistics(events, small_tasks):
    data = events.select(
        F.coalesce("cat", F.lit("d")).alias("g"), F.floor("x").alias("time"), (F.col("id") % 3 == 0).cast("int").alias("e"), "x", "t"
    ).cache()
    same(small_tasks, lambda: survival.kaplan_meier(data, "time", "e", "g"), 2)
    same(small_tasks, lambda: survival.kaplan_meier(data, "time", "e"), 2)
    same(small_tasks, lambda: survival.log_rank(data, "time", "e", "g"), 2)
    same(small_tasks, lambda: survival.cox_univariable(data, "time", "e", "t"), 4)
    same(small_tasks, lambda: association.rank_sums(data, "t", "g"), 3)
    same(small_tasks, lambda: summary.summary_continuous(data, ["x", "t"], "g", overall=True), 10)


def test_joins_at_skew(events, small_tasks):
    """A key that holds a third of all rows is joined where its rows are."""
    from kohorta.operators import events as ev, joins as j

    anchor = events.groupBy("k").agg(F.min("t").alias("t0"), F.max("cat").alias("site")).filter("k is null or k < 20")
    named = anchor.filter("k is not null").cache()
    order = ["t", "id"]
    same(small_tasks, lambda: ev.group_count(events, "k"))
    same(small_tasks, lambda: ev.ever(events, "k", F.col("x") > 9.5, "high", no="No"))
    same(small_tasks, lambda: ev.first_in_group(events, "k", order, {"f": "cat"}))
    same(small_tasks, lambda: ev.last_non_null(events, "k", order, "cat", "l"))
    same(small_tasks, lambda: ev.fallback_first_row(events, "k", ["id"], F.col("cat") == "a", F.col("cat") == "b"))
    same(small_tasks, lambda: ev.index_event(events, "k", "t", F.col("cat") == "a", ["id"]))
    same(small_tasks, lambda: ev.event_or_censor(events, "k", "t", "x", carry=["cat"], order_by=["id"]))
    same(small_tasks, lambda: j.pick_nearest(events, named, "k", "t", "t0", ["id"]))
    same(small_tasks, lambda: j.pick_nearest(events, named, "k", "x", "t0", ["id"], "forward", by=["cat"]))
    same(small_tasks, lambda: j.label_sequence(events, named, "k", "x", "t0", ("b", "a"), "s"))
    same(small_tasks, lambda: j.attribute(events, anchor, {"k": "k", "cat": "site"}, ["t0"]))
    same(small_tasks, lambda: j.restrict(events, named.filter("t0 < 3"), "k", "anti"))
    same(small_tasks, lambda: j.restrict(events, named.filter("t0 < 3"), "k"))
    same(small_tasks, lambda: j.semi_or_anti(events, named, named.filter("k < 4"), "k"))
    same(small_tasks, lambda: j.full_join(events, anchor, "k"))


def test_joins_without_broadcast(events, small_tasks):
    """The other side of the large keys is too big to send: shuffled after all."""
    from kohorta.operators.keys import keyed_join

    many = events.select("k", F.col("id").alias("other")).cache()
    same(small_tasks, lambda: keyed_join(events, many, "k", "inner", na_matches=True), 30)


def test_flagship_in_buckets(spark, tmp_path, monkeypatch, small_tasks):
    rng = random.Random(3)
    customers = [(k, f"S{k % 3}") for k in [*range(40), 5, 5]] + [(None, "S0"), (50, None)]
    days = [f"199{y}-0{m}-11" for y in (5, 6, 7) for m in (1, 4, 9)]
    orders = [
        (i, rng.choice([None, 5, *range(60)]), rng.choice("FOP"), rng.choice([None, *days]), 1.0, rng.choice(["1-URGENT", "5-LOW", None]))
        for i in range(900)
    ]
    spark.createDataFrame(customers, "c_custkey bigint, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, day string, o_totalprice double, o_orderpriority string"
    table = spark.createDataFrame(orders, schema).withColumn("o_orderdate", F.to_date("day")).drop("day")
    table.unionByName(table.limit(50)).write.parquet(f"{tmp_path}/orders.parquet")
    want = rows(flagship(spark, str(tmp_path)))
    monkeypatch.setattr(session, "BYTES_PER_BUCKET", 4096)
    before = len(session._BUCKETED)
    assert rows(flagship(spark, str(tmp_path))) == want and len(session._BUCKETED) == before + 1
    with small_tasks(10):  # a customer beyond one task's share
        assert rows(flagship(spark, str(tmp_path))) == want and len(session._BUCKETED) == before + 1
