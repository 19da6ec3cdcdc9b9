"""Joins, per-key events, windows, collapse and reshape."""

from __future__ import annotations

from pyspark.sql import functions as F

from kohorta.catalog import views as v
from kohorta.catalog.registry import query
from kohorta.functions.exprs import concat_text, fmt_num, group_max_skip, group_min_strict
from kohorta.operators import events as e, joins as j, ordered as o, reshape as w
from kohorta.operators.collapse import collapse, collapse_to_rows, collapse_two_level
from kohorta.operators.keys import attach, equi_join
from kohorta.session import durable
from kohorta.sources.tables import read_table


@query(
    "join_inner",
    "SELECT o_orderkey, o_custkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey",
)
def join_inner(spark, d):
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_custkey")
    customer = read_table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return equi_join(orders, customer, {"o_custkey": "c_custkey"})


@query(
    "join_left",
    """SELECT e.event_id, e.cat, c.c_name FROM ev e
       LEFT JOIN coh c ON e.user_id IS NOT DISTINCT FROM c.c_custkey""",
)
def join_left(spark, d):
    events = v.ev(spark, d).select("event_id", "cat", "user_id")
    cohort = v.coh(spark, d).select("c_custkey", "c_name")
    return equi_join(events, cohort, {"user_id": "c_custkey"}, "left", na_matches=True).drop("user_id")


@query(
    "join_full",
    """SELECT coalesce(c.c_custkey, o.o_custkey) AS patient, c.c_name, o.o_orderkey FROM coh c
       FULL JOIN (SELECT o_custkey, o_orderkey FROM ord_n WHERE evt IS NULL) o ON c.c_custkey = o.o_custkey""",
)
def join_full(spark, d):
    cohort = v.coh(spark, d).select(F.col("c_custkey").alias("patient"), "c_name")
    orders = v.ord_n(spark, d).filter(F.col("evt").isNull()).select("o_custkey", "o_orderkey")
    return j.full_join(orders.withColumnRenamed("o_custkey", "patient"), cohort, "patient").select(
        "patient", "c_name", "o_orderkey"
    )


@query(
    "join_natural",
    """SELECT a.user_id, a.cat, a.n, b.top FROM (SELECT user_id, cat, count(*) AS n FROM ev GROUP BY user_id, cat) a
       LEFT JOIN (SELECT user_id, cat, max(nval) AS top FROM ev WHERE day > 20 GROUP BY user_id, cat) b
         ON a.user_id = b.user_id AND a.cat IS NOT DISTINCT FROM b.cat""",
)
def join_natural(spark, d):
    events = v.ev(spark, d)
    counts = events.groupBy("user_id", "cat").agg(F.count(F.lit(1)).alias("n"))
    tops = events.filter(F.col("day") > 20).groupBy("user_id", "cat").agg(F.max("nval").alias("top"))
    return j.natural_join(counts, tops)


@query(
    "join_multikey_left",
    """SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, f.returned
       FROM lineitem l LEFT JOIN (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_linenumber, 'Yes' AS returned
                                  FROM lineitem WHERE l_returnflag = 'R') f
         ON l.l_orderkey = f.l_orderkey AND l.l_partkey = f.l_partkey AND l.l_suppkey = f.l_suppkey
        AND l.l_linenumber = f.l_linenumber""",
)
def join_multikey_left(spark, d):
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    items = read_table(spark, d, "lineitem")
    flags = items.filter(F.col("l_returnflag") == "R").select(*keys).distinct()
    return equi_join(items.select(*keys), flags.withColumn("returned", F.lit("Yes")), keys, "left")


@query(
    "join_pairs",
    """WITH g AS (SELECT user_id, day, event_id AS click_id, value AS click_value FROM ev WHERE event_type = 'click'),
            t AS (SELECT user_id, day, event_id AS buy_id, value AS buy_value FROM ev WHERE event_type = 'purchase'),
            pairs AS (SELECT coalesce(g.user_id, t.user_id) AS user_id, coalesce(g.day, t.day) AS day,
                             click_id, buy_id, click_value, buy_value
                      FROM g FULL JOIN t ON g.user_id = t.user_id AND g.day = t.day),
            chosen AS (SELECT user_id, day, min(CASE WHEN event_type = 'click' THEN event_id END) AS click_id,
                              max(CASE WHEN event_type = 'purchase' THEN CASE WHEN value < 40 THEN event_id ELSE -1 END END) AS buy_id
                       FROM ev GROUP BY user_id, day)
       SELECT c.user_id, c.day, c.click_id, c.buy_id, p.click_value, p.buy_value
       FROM chosen c LEFT JOIN pairs p ON c.user_id = p.user_id AND c.day = p.day
        AND c.click_id IS NOT DISTINCT FROM p.click_id AND c.buy_id IS NOT DISTINCT FROM p.buy_id""",
)
def join_pairs(spark, d):
    events = v.ev(spark, d)
    kind, row = F.col("event_type"), F.col("event_id")
    clicks = events.filter(kind == "click").select(
        "user_id", "day", row.alias("c_id"), F.col("value").alias("click_value")
    )
    buys = events.filter(kind == "purchase").select(
        "user_id", "day", row.alias("b_id"), F.col("value").alias("buy_value")
    )
    chosen = events.groupBy("user_id", "day").agg(
        F.min(F.when(kind == "click", row)).alias("click_id"),
        F.max(F.when(kind == "purchase", F.when(F.col("value") < 40, row).otherwise(-1))).alias("buy_id"),
    )
    return j.resolve_pairs(
        chosen, clicks, buys, ["user_id", "day"], {"click_id": "c_id"}, {"buy_id": "b_id"}
    )


@query(
    "join_attribution",
    """SELECT m.o_custkey, m.start, m.drug, m.class, i.t0 FROM med m
       JOIN idx_site i ON m.o_custkey = i.o_custkey AND m.class IS NOT DISTINCT FROM i.site""",
)
def join_attribution(spark, d):
    rows = v.med(spark, d).select("o_custkey", "start", "drug", "class")
    return j.attribute(rows, v.idx_site(spark, d), {"o_custkey": "o_custkey", "class": "site"}, ["t0"])


@query(
    "attribution_fallback",
    """SELECT m.o_custkey, m.start, m.drug FROM med m
       JOIN idx_site i ON m.o_custkey = i.o_custkey AND i.number_of_dx = 1
       WHERE m.class IS NULL AND m.o_custkey NOT IN (
           SELECT a.o_custkey FROM med a JOIN idx_site b ON a.o_custkey = b.o_custkey AND a.class = b.site AND a.line = 1)""",
)
def attribution_fallback(spark, d):
    # Read by every step and by the count of large keys before it: written once.
    rows = durable(v.med(spark, d).select("o_custkey", "start", "drug", "class", "line"))
    index = durable(v.idx_site(spark, d, rows))
    direct = j.attribute(
        rows.filter(F.col("line") == 1), index, {"o_custkey": "o_custkey", "class": "site"}, na_matches=False
    )
    return j.attribute_fallback(rows, direct, index, "o_custkey", F.col("class").isNull()).select(
        "o_custkey", "start", "drug"
    )


@query(
    "asof_nearest",
    """SELECT o_custkey, o_orderkey, gap FROM (
           SELECT o.o_custkey, o_orderkey, abs(nday - t0) AS gap,
                  row_number() OVER (PARTITION BY o.o_custkey ORDER BY abs(nday - t0) NULLS LAST, nday NULLS LAST, o_orderkey) AS rn
           FROM ord_n o JOIN idx i ON o.o_custkey = i.o_custkey WHERE o_orderpriority <> '1-URGENT') WHERE rn = 1""",
)
def asof_nearest(spark, d):
    orders = v.ord_n(spark, d).filter(F.col("o_orderpriority") != "1-URGENT").select("o_custkey", "o_orderkey", "nday")
    picked = j.pick_nearest(orders, v.idx(spark, d), "o_custkey", "nday", "t0", ["nday", "o_orderkey"], distance="gap")
    return picked.select("o_custkey", "o_orderkey", "gap")


@query(
    "asof_forward",
    """SELECT o_custkey, o_orderstatus, o_orderkey, gap FROM (
           SELECT o.o_custkey, o_orderstatus, o_orderkey, CASE WHEN nday >= t0 THEN nday - t0 END AS gap,
                  row_number() OVER (PARTITION BY o.o_custkey, o_orderstatus
                      ORDER BY CASE WHEN nday >= t0 THEN nday - t0 END NULLS LAST, nday NULLS LAST, o_orderkey) AS rn
           FROM ord_n o JOIN idx i ON o.o_custkey = i.o_custkey) WHERE rn = 1""",
)
def asof_forward(spark, d):
    orders = v.ord_n(spark, d).select("o_custkey", "o_orderkey", "o_orderstatus", "nday")
    picked = j.pick_nearest(
        orders, v.idx(spark, d), "o_custkey", "nday", "t0", ["nday", "o_orderkey"],
        direction="forward", by=["o_orderstatus"], distance="gap",
    )
    return picked.select("o_custkey", "o_orderstatus", "o_orderkey", "gap")


@query(
    "anchor_sequence",
    """SELECT o_orderkey, CASE WHEN nday <= t0 THEN 'before' WHEN nday > t0 THEN 'after' END AS sequence
       FROM ord_n o LEFT JOIN idx i ON o.o_custkey = i.o_custkey""",
)
def anchor_sequence(spark, d):
    orders = v.ord_n(spark, d).select("o_orderkey", "o_custkey", "nday")
    return j.label_sequence(
        orders, v.idx(spark, d), "o_custkey", "nday", "t0", ("before", "after"), "sequence"
    ).select("o_orderkey", "sequence")


@query(
    "wide_merge",
    """WITH d1 AS (SELECT c_custkey AS k, c_name FROM coh),
            d2 AS (SELECT o_custkey AS k, count(*) AS n_big FROM orders WHERE o_totalprice > 450000 GROUP BY 1),
            d3 AS (SELECT o_custkey AS k, max(stop) AS last_stop FROM med WHERE class IS NULL AND line IS NULL GROUP BY 1),
            i AS (SELECT o_custkey AS k, t0 FROM idx),
            l1 AS (SELECT user_id AS k, count(*) AS n_events FROM ev GROUP BY 1),
            l2 AS (SELECT o_custkey AS k, max(evt) AS any_f FROM ord_n GROUP BY 1)
       SELECT k, t0, c_name, n_big, last_stop, n_events, any_f
       FROM d1 FULL JOIN d2 USING (k) FULL JOIN d3 USING (k) JOIN i USING (k) LEFT JOIN l1 USING (k) LEFT JOIN l2 USING (k)""",
)
def wide_merge(spark, d):
    orders = v.ord_n(spark, d)
    big = orders.filter(F.col("o_totalprice") > 450000)
    drugs = v.med(spark, d).filter(F.col("class").isNull() & F.col("line").isNull())
    return j.merge_on_index(
        v.idx(spark, d).select(F.col("o_custkey").alias("k"), "t0"),
        [
            v.coh(spark, d).select(F.col("c_custkey").alias("k"), "c_name"),
            big.groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n_big")),
            drugs.groupBy(F.col("o_custkey").alias("k")).agg(F.max("stop").alias("last_stop")),
        ],
        [
            v.ev(spark, d).groupBy(F.col("user_id").alias("k")).agg(F.count(F.lit(1)).alias("n_events")),
            orders.groupBy(F.col("o_custkey").alias("k")).agg(F.max("evt").alias("any_f")),
        ],
        "k",
    )


@query(
    "keep_first",
    """SELECT user_id, day, event_id, nval, cat FROM (
           SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY nval NULLS LAST, event_id) AS rn FROM ev) WHERE rn = 1""",
)
def keep_first(spark, d):
    rows = v.ev(spark, d).select("user_id", "day", "event_id", "nval", "cat")
    return e.keep_first(rows, ["user_id", "day"], ["nval", "event_id"])


@query("group_count", "SELECT event_id, count(*) OVER (PARTITION BY user_id, cat) AS n FROM ev")
def group_count(spark, d):
    return e.group_count(v.ev(spark, d).select("event_id", "user_id", "cat"), ["user_id", "cat"]).select("event_id", "n")


@query(
    "na_min",
    """SELECT event_id, CASE WHEN count(nval) OVER w = count(*) OVER w THEN min(nval) OVER w END AS first_value
       FROM ev WINDOW w AS (PARTITION BY user_id, day)""",
)
def na_min(spark, d):
    rows = v.ev(spark, d).select("event_id", "user_id", "day", "nval")
    return e.group_min(rows, ["user_id", "day"], "nval", "first_value").select("event_id", "first_value")


@query(
    "na_min_conditional",
    """SELECT event_id, CASE WHEN cat = 'purchase' THEN
           CASE WHEN count(CASE WHEN cat = 'purchase' THEN nval END) OVER w = count(CASE WHEN cat = 'purchase' THEN 1 END) OVER w
                THEN min(CASE WHEN cat = 'purchase' THEN nval END) OVER w END END AS first_buy
       FROM ev WINDOW w AS (PARTITION BY user_id, day)""",
)
def na_min_conditional(spark, d):
    rows = v.ev(spark, d).select("event_id", "user_id", "day", "nval", "cat")
    out = e.group_min_where(rows, ["user_id", "day"], "nval", F.col("cat") == "purchase", "first_buy")
    return out.select("event_id", "first_buy")


@query(
    "max_across",
    """SELECT o_orderkey, greatest(coalesce(max(nday) OVER w, max(evt) OVER w), coalesce(max(evt) OVER w, max(nday) OVER w)) AS top
       FROM ord_n WINDOW w AS (PARTITION BY o_custkey)""",
)
def max_across(spark, d):
    rows = v.ord_n(spark, d).select("o_orderkey", "o_custkey", "nday", "evt")
    return attach(rows, "o_custkey", {"top": group_max_skip("nday", "evt")}).select("o_orderkey", "top")


@query(
    "collapse_strict",
    """SELECT user_id, day, CASE WHEN count(cat) = count(*) THEN string_agg(cat, '; ' ORDER BY event_id) END AS cat,
              string_agg(event_type, '; ' ORDER BY event_id) AS event_type FROM ev GROUP BY user_id, day""",
)
def collapse_strict(spark, d):
    return collapse(v.ev(spark, d), ["user_id", "day"], ["cat", "event_type"], ["event_id"])


@query(
    "collapse_text",
    """SELECT user_id, day, string_agg(coalesce(cat, 'NA'), ' + ' ORDER BY event_id) AS cat FROM ev GROUP BY user_id, day""",
)
def collapse_text(spark, d):
    return collapse(v.ev(spark, d), ["user_id", "day"], "cat", ["event_id"], " + ", nulls="text")


@query(
    "collapse_two_level",
    """WITH a AS (SELECT o_custkey, start, line, string_agg(drug, '; ' ORDER BY drug) AS drug FROM med GROUP BY 1, 2, 3)
       SELECT o_custkey, start, string_agg(drug, '; ' ORDER BY line NULLS LAST) AS drug,
              CASE WHEN count(line) = count(*) THEN string_agg(CAST(line AS VARCHAR), '; ' ORDER BY line) END AS line
       FROM a GROUP BY 1, 2""",
)
def collapse_two_level_query(spark, d):
    rows = v.med(spark, d).select("o_custkey", "start", "line", "drug")
    return collapse_two_level(rows, ["o_custkey", "start"], "line", ["drug"], ["drug"])


@query(
    "collapse_skip_null",
    """SELECT e.event_id, c.cat FROM ev e JOIN
           (SELECT user_id, day, string_agg(cat, '; ' ORDER BY event_id) AS cat FROM ev GROUP BY 1, 2) c
         ON e.user_id = c.user_id AND e.day = c.day""",
)
def collapse_skip_null(spark, d):
    rows = v.ev(spark, d).select("event_id", "user_id", "day", "cat")
    return collapse_to_rows(rows, ["user_id", "day"], "cat", ["event_id"]).select("event_id", "cat")


@query(
    "latest_across_tables",
    """SELECT o_custkey, max(last_day) AS last_day FROM (
           SELECT o_custkey, nday AS last_day FROM ord_n UNION ALL SELECT o_custkey, stop FROM med) GROUP BY o_custkey""",
)
def latest_across_tables(spark, d):
    return e.latest_across([(v.ord_n(spark, d), "nday"), (v.med(spark, d), "stop")], "o_custkey", "last_day")


@query(
    "event_sequence",
    "SELECT event_id, row_number() OVER (PARTITION BY user_id, cat ORDER BY day DESC, event_id) AS seq FROM ev",
)
def event_sequence(spark, d):
    rows = v.ev(spark, d).select("event_id", "user_id", "cat", "day")
    return o.event_sequence(rows, ["user_id", "cat"], ["-day", "event_id"], "seq").select("event_id", "seq")


@query(
    "dense_rank_na",
    """WITH m AS (SELECT DISTINCT o_custkey, start, line, drug FROM med)
       SELECT o_custkey, start, line, drug, coalesce(CASE WHEN line IS NOT NULL THEN
              dense_rank() OVER (PARTITION BY o_custkey, line IS NULL ORDER BY start, line) END, 999) AS line_rank FROM m""",
)
def dense_rank_na(spark, d):
    rows = v.med(spark, d).select("o_custkey", "start", "line", "drug").distinct()
    coded = rows.withColumn("code", F.coalesce("line", F.lit(999)))
    return o.dense_rank_valid(coded, "o_custkey", ["start", "line"], "line_rank", fallback="code").drop("code")


@query(
    "first_in_group",
    """SELECT event_id, first_value(cat) OVER w AS first_cat, first_value(nval) OVER w AS first_nval
       FROM ev WINDOW w AS (PARTITION BY user_id, day ORDER BY event_id)""",
)
def first_in_group(spark, d):
    rows = v.ev(spark, d).select("event_id", "user_id", "day", "cat", "nval")
    out = e.first_in_group(rows, ["user_id", "day"], ["event_id"], {"first_cat": "cat", "first_nval": "nval"})
    return out.select("event_id", "first_cat", "first_nval")


@query(
    "last_non_null",
    """SELECT event_id, last_value(nval IGNORE NULLS) OVER (PARTITION BY user_id, day ORDER BY event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_nval FROM ev""",
)
def last_non_null(spark, d):
    rows = v.ev(spark, d).select("event_id", "user_id", "day", "nval")
    return e.last_non_null(rows, ["user_id", "day"], ["event_id"], "nval", "last_nval").select("event_id", "last_nval")


_UP = "first_value({c} IGNORE NULLS) OVER (PARTITION BY {k} ORDER BY {o} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
_DOWN = "last_value({c} IGNORE NULLS) OVER (PARTITION BY {k} ORDER BY {o} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _updown(c: str, k: str, order: str) -> str:
    return f"coalesce({_UP.format(c=c, k=k, o=order)}, {_DOWN.format(c=c, k=k, o=order)})"


@query(
    "fill_updown",
    f"SELECT event_id, {_updown('cat', 'user_id', 'event_id')} AS cat, {_updown('nval', 'user_id', 'event_id')} AS nval FROM ev",
)
def fill_updown(spark, d):
    rows = v.ev(spark, d).select("event_id", "user_id", "cat", "nval")
    return o.fill(rows, ["cat", "nval"], "user_id", ["event_id"]).select("event_id", "cat", "nval")


@query(
    "fill_up",
    f"SELECT event_id, {_UP.format(c='nval', k='user_id', o='value DESC, event_id')} AS nval FROM ev",
)
def fill_up(spark, d):
    rows = v.ev(spark, d).select("event_id", "user_id", "value", "nval")
    return o.fill(rows, "nval", "user_id", ["-value", "event_id"], "up").select("event_id", "nval")


@query(
    "fill_composite_key",
    f"""WITH b AS (SELECT *, CASE WHEN value < 60 THEN day END AS start FROM ev)
        SELECT event_id, start, {_updown('cat', 'user_id, start', 'event_id')} AS cat FROM b""",
)
def fill_composite_key(spark, d):
    rows = v.ev(spark, d).select(
        "event_id", "user_id", "cat", F.when(F.col("value") < 60, F.col("day")).alias("start")
    )
    return o.fill(rows, "cat", ["user_id", "start"], ["event_id"]).select("event_id", "start", "cat")


@query(
    "ever_flag",
    """SELECT event_id, max(CASE WHEN cat = 'purchase' THEN 'Yes' END) OVER w AS bought,
              coalesce(max(CASE WHEN nval > 100 THEN 'Yes' END) OVER w2, 'No') AS large
       FROM ev WINDOW w AS (PARTITION BY user_id, day), w2 AS (PARTITION BY user_id, cat)""",
)
def ever_flag(spark, d):
    rows = v.ev(spark, d).select("event_id", "user_id", "day", "cat", "nval")
    bought = e.ever(rows, ["user_id", "day"], F.col("cat") == "purchase", "bought")
    return e.ever(bought, ["user_id", "cat"], F.col("nval") > 100, "large", no="No").select(
        "event_id", "bought", "large"
    )


@query(
    "fallback_first_row",
    """SELECT event_id, user_id, day, cat FROM (
           SELECT *, row_number() OVER (PARTITION BY user_id, day, cat ORDER BY event_id) AS rn,
                  max(CASE WHEN cat = 'purchase' THEN 1 END) OVER (PARTITION BY user_id, day) AS bought FROM ev)
       WHERE cat = 'purchase' OR (cat = 'view' AND rn = 1 AND bought IS NULL)""",
)
def fallback_first_row(spark, d):
    rows = v.ev(spark, d).select("event_id", "user_id", "day", "cat")
    cat = F.col("cat")
    return e.fallback_first_row(rows, ["user_id", "day"], ["event_id"], cat == "purchase", cat == "view")


_CENSOR = """WITH s AS (SELECT *, row_number() OVER w AS rn, first_value(nday) OVER w AS f,
                          last_value(nday IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS l
                   FROM ord_n {where} WINDOW w AS (PARTITION BY o_custkey ORDER BY evt DESC NULLS LAST, nday NULLS LAST, o_orderkey))
       SELECT o_custkey, o_orderpriority, evt AS event, CASE evt WHEN 1 THEN f WHEN 0 THEN l END AS time FROM s WHERE rn = 1"""


@query("event_or_censor", _CENSOR.format(where=""))
def event_or_censor(spark, d):
    return e.event_or_censor(
        v.ord_n(spark, d), "o_custkey", "evt", "nday", carry=["o_orderpriority"], order_by=["o_orderkey"]
    )


@query("event_or_censor_known", _CENSOR.format(where="WHERE evt IS NOT NULL"))
def event_or_censor_known(spark, d):
    rows = v.ord_n(spark, d)
    known = rows.filter(F.col("evt").isNotNull())
    return e.event_or_censor(
        known, "o_custkey", "evt", "nday", censor_from_unknown=False, carry=["o_orderpriority"], order_by=["o_orderkey"]
    )


KINDS = ["click", "error", "purchase", "signup", "view"]


@query(
    "pivot_category",
    "SELECT user_id, " + ", ".join(
        f"nullif(count(*) FILTER (event_type = '{k}'), 0) AS {k}" for k in KINDS
    ) + " FROM events GROUP BY user_id",
)
def pivot_category(spark, d):
    return w.pivot_named(
        read_table(spark, d, "events"), "user_id", "event_type", {"n": F.count(F.lit(1))}, KINDS, "{name}"
    )


@query(
    "pivot_multi_value",
    "SELECT user_id, day, " + ", ".join(
        f"nullif(count(*) FILTER (event_type = '{k}'), 0) AS {k}_n, max(nval) FILTER (event_type = '{k}') AS {k}_top"
        for k in KINDS
    ) + " FROM ev GROUP BY user_id, day",
)
def pivot_multi_value(spark, d):
    return w.pivot_named(
        v.ev(spark, d), ["user_id", "day"], "event_type",
        {"n": F.count(F.lit(1)), "top": F.max("nval")}, KINDS,
    )


def _paged(width: int, columns: list[str]) -> str:
    return ", ".join(
        f"max(CASE WHEN (rn - 1) % {width} = {i - 1} THEN {c} END) AS {c}_{i}" for c in columns for i in range(1, width + 1)
    )


_NUMBERED = "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM ev"


@query(
    "pivot_occurrence",
    f"SELECT user_id, (rn - 1) // 20 AS page, {_paged(20, ['cat', 'nval', 'day'])} FROM ({_NUMBERED}) GROUP BY ALL",
)
def pivot_occurrence(spark, d):
    rows = v.ev(spark, d).select("user_id", "event_id", "cat", "nval", "day")
    return w.pivot_pages(rows, "user_id", ["cat", "nval", "day"], 20, ["event_id"])


@query(
    "pivot_occurrence_k",
    f"SELECT user_id, cat, (rn - 1) // 9 AS page, {_paged(9, ['nval'])} FROM ({_NUMBERED}) GROUP BY ALL",
)
def pivot_occurrence_k(spark, d):
    rows = v.ev(spark, d).select("user_id", "event_id", "cat", "nval")
    return w.pivot_pages(rows, "user_id", ["nval"], 9, ["event_id"], lhs=["cat"])


_LONG_CATS = f"SELECT user_id, 'cat_' || rn AS name, cat AS drug_name FROM ({_NUMBERED}) WHERE cat IS NOT NULL"


def _long_cats(spark, d):
    rows = v.ev(spark, d).select("user_id", "event_id", "cat")
    return w.occurrences_long(rows, "user_id", ["cat"], ["event_id"]).filter("cat IS NOT NULL")


@query("unpivot_drop_null", _LONG_CATS)
def unpivot_drop_null(spark, d):
    name = F.concat(F.lit("cat_"), F.col("occurrence"))
    return _long_cats(spark, d).select("user_id", name.alias("name"), F.col("cat").alias("drug_name"))


@query("items_per_key", f"SELECT user_id, count(*) AS n_items FROM ({_LONG_CATS}) GROUP BY user_id")
def items_per_key(spark, d):
    return w.count_items(v.ev(spark, d), "user_id", "cat")


_PAGE = f"SELECT user_id, (rn - 1) // 20 AS page, {_paged(20, ['cat'])} FROM ({_NUMBERED}) GROUP BY ALL"


@query(
    "unpivot_pages",
    f"SELECT user_id, page, 'cat_' || ((rn - 1) % 20 + 1) AS name, cat AS drug_name FROM (SELECT *, (rn - 1) // 20 AS page FROM ({_NUMBERED})) WHERE cat IS NOT NULL",
)
def unpivot_pages(spark, d):
    rows = v.ev(spark, d).select("user_id", "event_id", "cat")
    wide = w.pivot_pages(rows, "user_id", ["cat"], 20, ["event_id"])
    return w.unpivot(wide, ["user_id", "page"], wide.columns[2:], "name", "drug_name")


@query("items_per_page", f"SELECT user_id, page, n_items FROM (SELECT user_id, page, {' + '.join(f'(cat_{i} IS NOT NULL)::BIGINT' for i in range(1, 21))} AS n_items FROM ({_PAGE})) WHERE n_items > 0")
def items_per_page(spark, d):
    rows = v.ev(spark, d).select("user_id", "event_id", "cat")
    wide = w.pivot_pages(rows, "user_id", ["cat"], 20, ["event_id"])
    return w.items_per_key(wide, ["user_id", "page"], wide.columns[2:])


@query("occurrences_long", f"SELECT user_id, rn AS occurrence, cat, nval, day FROM ({_NUMBERED})")
def occurrences_long(spark, d):
    rows = v.ev(spark, d).select("user_id", "event_id", "cat", "nval", "day")
    return w.occurrences_long(rows, "user_id", ["cat", "nval", "day"], ["event_id"])


@query(
    "index_event",
    """SELECT o_custkey, o_orderkey, nday, o_orderstatus FROM (
           SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY nday, o_orderkey) AS rn
           FROM ord_n WHERE o_orderpriority = '1-URGENT' AND nday IS NOT NULL) WHERE rn = 1""",
)
def index_event(spark, d):
    return v.index_orders(spark, d).select("o_custkey", "o_orderkey", "nday", "o_orderstatus")


@query(
    "history_text",
    """WITH i AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY nday, o_orderkey) AS rn
                  FROM ord_n WHERE o_orderpriority = '1-URGENT' AND nday IS NOT NULL) WHERE rn = 1),
            t AS (SELECT o.o_custkey, o.nday, o.o_orderkey, i.nday AS t0,
                         'age = ' || o.nday || ', site = ' || o.o_orderpriority || ', histology = ' || o.o_orderstatus AS txt
                  FROM ord_n o JOIN i ON o.o_custkey = i.o_custkey
                  WHERE NOT coalesce(o.o_orderpriority = '1-URGENT' AND o.nday = i.nday, FALSE)),
            h AS (SELECT o_custkey, string_agg(CASE WHEN nday < t0 THEN txt END, '; ' ORDER BY nday, o_orderkey) AS pre_info,
                         string_agg(CASE WHEN nday >= t0 THEN txt END, '; ' ORDER BY nday, o_orderkey) AS post_info FROM t GROUP BY o_custkey)
       SELECT i.o_custkey, i.o_orderkey, h.pre_info, h.post_info FROM i LEFT JOIN h ON i.o_custkey = h.o_custkey""",
)
def history_text(spark, d):
    orders = v.ord_n(spark, d).select("o_custkey", "o_orderkey", "nday", "o_orderpriority", "o_orderstatus")
    text = concat_text(
        F.lit("age = "), fmt_num("nday"), F.lit(", site = "), "o_orderpriority",
        F.lit(", histology = "), "o_orderstatus",
    )
    out = e.index_event_with_history(
        orders, "o_custkey", "nday", F.col("o_orderpriority") == "1-URGENT", ["o_orderkey"], text
    )
    return out.select("o_custkey", "o_orderkey", "pre_info", "post_info")


@query(
    "group_min_long",
    """SELECT o_custkey, CASE WHEN count(start) = count(*) AND count(line) = count(*) THEN least(min(start), min(line)) END AS low
       FROM med GROUP BY o_custkey""",
)
def group_min_long(spark, d):
    return v.med(spark, d).groupBy("o_custkey").agg(group_min_strict("start", "line").alias("low"))
