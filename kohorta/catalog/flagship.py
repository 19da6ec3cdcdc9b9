"""The flagship query: from two raw tables to survival curves."""

from __future__ import annotations

from pyspark.sql import functions as F

from kohorta.catalog import views as v
from kohorta.catalog.registry import query
from kohorta.operators.events import index_event
from kohorta.operators.joins import pick_nearest, restrict
from kohorta.operators.keys import equi_join
from kohorta.operators.survival import kaplan_meier
from kohorta.session import ordinary, rows_in_buckets
from kohorta.sources.tables import read_table


@query(
    "flagship",
    """WITH i AS (SELECT o_custkey, day AS t0 FROM (
                    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY day, o_orderkey) AS rn
                    FROM ord_n WHERE o_orderpriority = '1-URGENT' AND day IS NOT NULL) WHERE rn = 1),
            f AS (SELECT i.o_custkey, min(o.day - t0) AS gap FROM i JOIN ord_n o
                  ON o.o_custkey = i.o_custkey AND o.o_orderstatus = 'F' AND o.day >= t0 GROUP BY 1),
            l AS (SELECT o_custkey, max(day) AS last_day FROM ord_n GROUP BY 1),
            s AS (SELECT c_mktsegment, coalesce(gap, last_day - t0) AS time, CASE WHEN gap IS NULL THEN 0 ELSE 1 END AS event
                  FROM i LEFT JOIN f ON i.o_custkey = f.o_custkey JOIN l ON i.o_custkey = l.o_custkey
                  JOIN customer ON i.o_custkey = c_custkey),
            c AS (SELECT c_mktsegment, time, CAST(sum(event) AS BIGINT) AS d, count(*) AS k FROM s GROUP BY 1, 2),
            r AS (SELECT *, CAST(sum(k) OVER (PARTITION BY c_mktsegment ORDER BY time DESC) AS BIGINT) AS n FROM c),
            t AS (SELECT *, max(CASE WHEN d = n THEN 1 ELSE 0 END) OVER w AS ended,
                         exp(sum(CASE WHEN d < n THEN ln(1 - d / n::DOUBLE) ELSE 0 END) OVER w) AS alive,
                         sqrt(sum(CASE WHEN d < n THEN d / (n::DOUBLE * (n - d)) ELSE 0 END) OVER w) AS spread
                  FROM r WINDOW w AS (PARTITION BY c_mktsegment ORDER BY time))
       SELECT c_mktsegment, time, n AS n_risk, d AS n_event, k - d AS n_censor,
              round(CASE ended WHEN 1 THEN 0 ELSE alive END, 6) AS surv,
              round(CASE ended WHEN 1 THEN 0 ELSE alive * spread END, 6) AS std_err FROM t""",
)
def flagship(spark, d):
    """Survival from a customer's first urgent order to the next finished one.

    Scan, cohort restriction, index event, first event after it, censoring at
    the last order, Kaplan-Meier by segment.
    """
    customers = read_table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    orders = v.ord_n(spark, d).select("o_custkey", "o_orderkey", "day", "o_orderpriority", "o_orderstatus")
    with ordinary(orders, "o_custkey"):
        return _curve(rows_in_buckets(orders, "o_custkey"), customers)


def _curve(orders, customers):
    orders = restrict(orders, customers, {"o_custkey": "c_custkey"})
    index = index_event(orders, "o_custkey", "day", F.col("o_orderpriority") == "1-URGENT", ["o_orderkey"])
    anchor = index.select("o_custkey", F.col("day").alias("t0"))
    finished = orders.filter(F.col("o_orderstatus") == "F").select("o_custkey", "o_orderkey", "day")
    after = pick_nearest(
        finished, anchor, "o_custkey", "day", "t0", ["day", "o_orderkey"], "forward", distance="gap"
    ).filter(F.col("gap").isNotNull())
    last = orders.groupBy("o_custkey").agg(F.max("day").alias("last_day"))
    rows = equi_join(anchor, after.select("o_custkey", "gap"), "o_custkey", "left")
    rows = equi_join(equi_join(rows, last, "o_custkey"), customers, {"o_custkey": "c_custkey"})
    timed = rows.select(
        "c_mktsegment",
        F.coalesce("gap", F.col("last_day") - F.col("t0")).alias("time"),
        F.col("gap").isNotNull().cast("int").alias("event"),
    )
    curve = kaplan_meier(timed, "time", "event", "c_mktsegment")
    return curve.withColumns({c: F.round(c, 6) for c in ("surv", "std_err")})
