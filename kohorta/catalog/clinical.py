"""Therapy lines, endpoints, summaries, tests and survival on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from kohorta.catalog import views as v
from kohorta.catalog.registry import query
from kohorta.functions.exprs import group_min_strict
from kohorta.operators import association as a, summary as s, survival as sv
from kohorta.operators.joins import attribute
from kohorta.operators.keys import equi_join
from kohorta.plans import endpoints as ep, therapy as th
from kohorta.session import durable
from kohorta.sources.tables import read_table

_FILL = """coalesce(
    first_value(known IGNORE NULLS) OVER (PARTITION BY o_custkey, start ORDER BY stop, drug, class NULLS LAST, line NULLS LAST
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
    last_value(known IGNORE NULLS) OVER (PARTITION BY o_custkey, start ORDER BY stop, drug, class NULLS LAST, line NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), line_txt)"""
_CODE = (
    "CASE filled WHEN 'Unknown/Not Applicable' THEN 999 "
    + " ".join(f"WHEN '{t}' THEN {n}" for n, t in v.LINE_TEXTS.items())
    + " END"
)


@query(
    "therapy_lines",
    f"""WITH f AS (SELECT *, {_FILL} AS filled
                   FROM (SELECT *, nullif(line_txt, 'Unknown/Not Applicable') AS known FROM lines)),
             c AS (SELECT *, {_CODE} AS code FROM f)
        SELECT o_custkey, start, stop, drug, class, filled AS line_txt,
               dense_rank() OVER (PARTITION BY o_custkey, class ORDER BY start, code) AS regimen_line FROM c""",
)
def therapy_lines(spark, d):
    rows = th.therapy_lines(
        v.lines(spark, d), "o_custkey", "class", "start", "line_txt", ["stop", "drug", "class", "line"]
    )
    return rows.select("o_custkey", "start", "stop", "drug", "class", "line_txt", "regimen_line")


_REGIMEN = """WITH a AS (SELECT o_custkey, start, stop, string_agg(drug, '; ' ORDER BY drug) AS drug,
                  CASE WHEN count(class) = count(*) THEN string_agg(class, '; ' ORDER BY drug, class) END AS class
           FROM med GROUP BY 1, 2, 3),
     g AS (SELECT o_custkey, start, string_agg(drug, '; ' ORDER BY stop) AS drug,
                  CASE WHEN count(class) = count(*) THEN string_agg(class, '; ' ORDER BY stop) END AS class,
                  string_agg(CAST(stop AS VARCHAR), '; ' ORDER BY stop) AS stop FROM a GROUP BY 1, 2)"""


def _regimens(spark, d):
    rows = v.med(spark, d).select("o_custkey", "start", "stop", "drug", "class")
    return th.regimens(rows, ["o_custkey", "start"], "stop", ["drug", "class"], ["drug", "class"])


@query("regimens", f"{_REGIMEN} SELECT o_custkey, start, drug, class, stop FROM g")
def regimens(spark, d):
    return _regimens(spark, d)


@query(
    "exposure_before_anchor",
    f"""{_REGIMEN}, l AS (SELECT g.*, CASE WHEN start <= t0 THEN 'regimen before germline' WHEN start > t0 THEN 'regimen after germline' END AS seq
                          FROM g LEFT JOIN idx i ON g.o_custkey = i.o_custkey)
        SELECT o_custkey, start, drug, seq,
               max(CASE WHEN seq = 'regimen before germline' AND contains(drug, 'bolt') THEN 'Yes' END) OVER w AS received_bolt,
               max(CASE WHEN seq = 'regimen before germline' AND contains(class, 'LARGE') THEN 'Yes' END) OVER w AS received_large
        FROM l WINDOW w AS (PARTITION BY o_custkey)""",
)
def exposure_before_anchor(spark, d):
    flagged = th.exposure_flags(
        _regimens(spark, d), v.idx(spark, d), "o_custkey", "start", "t0",
        {"received_bolt": ("drug", "bolt"), "received_large": ("class", "LARGE")}, sequence="seq",
    )
    return flagged.select("o_custkey", "start", "drug", "seq", "received_bolt", "received_large")


@query(
    "therapy_phase",
    """WITH x AS (SELECT m.*, m.class IS NOT DISTINCT FROM i.site AS inside FROM med m JOIN idx_site i ON m.o_custkey = i.o_custkey),
            f AS (SELECT o_custkey, min(start) AS first_start FROM x WHERE inside GROUP BY 1)
       SELECT x.o_custkey, start, drug,
              CASE WHEN inside THEN '2- drugs for ovarian cancer' WHEN start < first_start THEN '1- drugs for pre cancer'
                   WHEN start > first_start THEN '3- drugs for post cancer' END AS drug_sequence,
              CASE WHEN inside THEN coalesce(CAST(line AS BIGINT), 999) WHEN start < first_start THEN -1 WHEN start > first_start THEN 88 END AS regimen_line
       FROM x JOIN f ON x.o_custkey = f.o_custkey""",
)
def therapy_phase(spark, d):
    rows = v.med(spark, d).select("o_custkey", "start", "drug", "class", "line")
    index = v.idx_site(spark, d).select("o_custkey", "site")
    placed = durable(equi_join(rows, index, "o_custkey"))
    inside = F.col("class").eqNullSafe(F.col("site"))
    mine = placed.filter(inside).withColumn(
        "regimen_line", F.coalesce(F.col("line").cast("bigint"), F.lit(999))
    )
    first = mine.groupBy("o_custkey").agg(F.min("start").alias("first_start"))
    others = equi_join(placed.filter(~inside), first.select("o_custkey"), "o_custkey", "left_semi")
    out = th.therapy_phase(others, mine, first, "o_custkey", "start", "first_start")
    return out.select("o_custkey", "start", "drug", "drug_sequence", "regimen_line")


@query(
    "prior_treatment",
    """WITH e AS (SELECT o_custkey, CASE WHEN count(start) = count(*) THEN min(start) END AS ever FROM med GROUP BY 1),
            m AS (SELECT m.o_custkey, min(start) AS mine FROM med m JOIN idx_site i
                    ON m.o_custkey = i.o_custkey AND m.class IS NOT DISTINCT FROM i.site GROUP BY 1)
       SELECT m.o_custkey, CASE WHEN mine > ever THEN 'Yes' END AS had_prior FROM m JOIN e ON m.o_custkey = e.o_custkey""",
)
def prior_treatment(spark, d):
    rows = v.med(spark, d).select("o_custkey", "start", "class")
    ever = rows.groupBy("o_custkey").agg(group_min_strict("start").alias("ever"))
    mine = (
        attribute(rows, v.idx_site(spark, d), {"o_custkey": "o_custkey", "class": "site"})
        .groupBy("o_custkey")
        .agg(F.min("start").alias("mine"))
    )
    both = equi_join(mine, ever, "o_custkey")
    return both.select("o_custkey", th.prior_treatment(F.col("mine"), F.col("ever")).alias("had_prior"))


@query(
    "split_subsets",
    """SELECT o_custkey, start, drug, CASE WHEN line IS NULL THEN 'never' WHEN class IS NULL THEN 'non_chemo' ELSE 'chemo' END AS subset
       FROM med""",
)
def split_subsets(spark, d):
    given = F.when(F.col("line").isNull(), F.lit("No")).otherwise("Yes")
    return v.med(spark, d).select(
        "o_custkey", "start", "drug", th.treatment_subset(given, F.col("class")).alias("subset")
    )


# Per-customer times by order status stand for contact, laboratory, death and treatments.
_PATIENT = """SELECT o_custkey, min(day) AS age_at_diagnosis,
        max(CASE WHEN o_orderstatus = 'O' THEN nday END) AS age_at_last_contact,
        max(CASE WHEN o_orderstatus = 'P' THEN nday END) AS age_at_lab,
        max(CASE WHEN o_totalprice > 430000 THEN nday END) AS age_at_death,
        min(CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 200000 THEN day // 200 END) AS age_at_first_radiation,
        min(CASE WHEN o_orderpriority = '2-HIGH' AND o_totalprice > 150000 THEN day // 200 END) AS age_at_first_surgery,
        min(CASE WHEN o_orderpriority = '5-LOW' AND o_totalprice > 180000 THEN day // 200 END) AS age_at_med_start_1,
        max(evt) FILTER (o_totalprice < 100000) AS pfs_event,
        max(nday) FILTER (o_totalprice < 100000) AS pfs_age,
        CASE WHEN max(o_totalprice) > 480000 THEN 'Dead' WHEN max(o_totalprice) > 470000 THEN 'Alive'
             WHEN max(o_totalprice) > 460000 THEN 'Lost to follow-up' END AS vital_status,
        max(CASE WHEN o_totalprice < 5000 THEN 'Yes' END) AS had_metastasis,
        max(CASE WHEN o_totalprice < 20000 THEN 'Yes' END) AS has_metastasis_data,
        min(CASE WHEN o_totalprice < 60000 THEN nday END) AS age_at_metastatic_site
    FROM ord_n GROUP BY o_custkey"""


def _patient(spark, d):
    price, day, nday = F.col("o_totalprice"), F.col("day"), F.col("nday")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    step = F.floor(day / 200)

    def first(label: str, above: float):
        return F.min(F.when((priority == label) & (price > above), step))

    low = price < 100000
    return v.ord_n(spark, d).groupBy("o_custkey").agg(
        F.min(day).alias("age_at_diagnosis"),
        F.max(F.when(status == "O", nday)).alias("age_at_last_contact"),
        F.max(F.when(status == "P", nday)).alias("age_at_lab"),
        F.max(F.when(price > 430000, nday)).alias("age_at_death"),
        first("1-URGENT", 200000).alias("age_at_first_radiation"),
        first("2-HIGH", 150000).alias("age_at_first_surgery"),
        first("5-LOW", 180000).alias("age_at_med_start_1"),
        F.max(F.when(low, F.col("evt"))).alias("pfs_event"),
        F.max(F.when(low, nday)).alias("pfs_age"),
        F.when(F.max(price) > 480000, "Dead")
        .when(F.max(price) > 470000, "Alive")
        .when(F.max(price) > 460000, "Lost to follow-up")
        .alias("vital_status"),
        F.max(F.when(price < 5000, "Yes")).alias("had_metastasis"),
        F.max(F.when(price < 20000, "Yes")).alias("has_metastasis_data"),
        F.min(F.when(price < 60000, nday)).alias("age_at_metastatic_site"),
    )


@query(
    "reconcile_last_contact",
    f"""WITH p AS ({_PATIENT})
        SELECT o_custkey,
               CASE WHEN age_at_last_contact >= age_at_lab OR (age_at_last_contact IS NOT NULL AND age_at_lab IS NULL) THEN 'Yes'
                    WHEN age_at_last_contact < age_at_lab THEN 'No' END AS contact_is_last,
               CASE WHEN age_at_death = age_at_last_contact THEN 'Same' WHEN age_at_death > age_at_last_contact THEN 'Yes'
                    WHEN age_at_last_contact IS NOT NULL AND age_at_death IS NULL THEN 'Yes'
                    WHEN age_at_death < age_at_last_contact THEN 'No' END AS death_is_last,
               CASE WHEN age_at_death < age_at_last_contact THEN age_at_death ELSE age_at_last_contact END AS last_contact
        FROM p""",
)
def reconcile_last_contact(spark, d):
    contact, lab, death = F.col("age_at_last_contact"), F.col("age_at_lab"), F.col("age_at_death")
    return _patient(spark, d).select(
        "o_custkey",
        ep.contact_is_latest(contact, lab).alias("contact_is_last"),
        ep.death_is_latest(death, contact).alias("death_is_last"),
        ep.reconcile_last_contact(contact, death).alias("last_contact"),
    )


_FIRST = """CASE WHEN r < least(coalesce(s, 1e9), coalesce(m, 1e9)) THEN 'Radiation'
        WHEN s < least(coalesce(r, 1e9), coalesce(m, 1e9)) THEN 'Surgery'
        WHEN m < least(coalesce(r, 1e9), coalesce(s, 1e9)) THEN 'Drugs'
        WHEN m = r THEN 'Drugs' WHEN m = s THEN 'Surgery' END"""


@query(
    "first_modality",
    f"""WITH p AS (SELECT o_custkey, age_at_first_radiation AS r, age_at_first_surgery AS s, age_at_med_start_1 AS m FROM ({_PATIENT})),
             f AS (SELECT *, {_FIRST} AS first_treatment FROM p)
        SELECT o_custkey, first_treatment,
               CASE first_treatment WHEN 'Radiation' THEN r WHEN 'Surgery' THEN s WHEN 'Drugs' THEN m END AS first_age FROM f""",
)
def first_modality(spark, d):
    ages = [F.col(c) for c in ("age_at_first_radiation", "age_at_first_surgery", "age_at_med_start_1")]
    return (
        _patient(spark, d)
        .withColumn("first_treatment", ep.first_modality(*ages))
        .select("o_custkey", "first_treatment", ep.modality_age(F.col("first_treatment"), *ages).alias("first_age"))
    )


@query(
    "survival_endpoints",
    f"""WITH p AS (SELECT *, age_at_first_radiation AS age_at_first_treatment,
                          CASE vital_status WHEN 'Dead' THEN 1 WHEN 'Alive' THEN 0 WHEN 'Lost to follow-up' THEN 0 END AS os_event,
                          coalesce(age_at_death, age_at_last_contact) AS os_age FROM ({_PATIENT})),
             q AS (SELECT *, CASE WHEN pfs_event = 0 AND os_event = 1 THEN 1 ELSE pfs_event END AS pe,
                          CASE WHEN pfs_event = 0 AND os_event = 1 THEN os_age WHEN pfs_event IS NOT NULL THEN pfs_age END AS pa,
                          CASE WHEN had_metastasis = 'Yes' THEN 1 WHEN has_metastasis_data IS NOT NULL THEN 0 END AS me,
                          coalesce(age_at_metastatic_site, age_at_last_contact) AS ma FROM p)
        SELECT o_custkey, os_event, os_age, os_age - age_at_diagnosis AS os_dx, os_age - age_at_first_treatment AS os_tx,
               pfs_event AS rfs_event, pfs_age - age_at_diagnosis AS rfs_dx, pe AS pfs_event, pa AS pfs_age,
               pa - age_at_first_treatment AS pfs_tx, me AS met_event, ma - age_at_diagnosis AS met_dx,
               (age_at_first_treatment - age_at_diagnosis) * 365 AS days FROM q""",
)
def survival_endpoints(spark, d):
    patient = _patient(spark, d).withColumn("age_at_first_treatment", F.col("age_at_first_radiation"))
    return ep.survival_endpoints(patient).select(
        "o_custkey",
        "os_event",
        "os_age",
        F.col("os_time_from_dx_years").alias("os_dx"),
        F.col("os_time_from_treatment_years").alias("os_tx"),
        "rfs_event",
        F.col("rfs_time_from_dx_years").alias("rfs_dx"),
        "pfs_event",
        "pfs_age",
        F.col("pfs_time_from_treatment_years").alias("pfs_tx"),
        F.col("metastase_event").alias("met_event"),
        F.col("met_time_from_dx_years").alias("met_dx"),
        F.col("time_dx_to_first_treatment_days").alias("days"),
    )


@query(
    "summary_categorical",
    """WITH l AS (SELECT 'cat' AS variable, cat AS level FROM ev UNION ALL SELECT 'event_type', event_type FROM ev),
            b AS (SELECT variable, count(level) AS n_known, count(*) - count(level) AS n_missing FROM l GROUP BY 1)
       SELECT TRUE AS is_total, 'Overall' AS stratum, l.variable, l.level, count(*) AS n, round(count(*) * 100.0 / any_value(n_known), 6) AS percent,
              any_value(n_known) AS n_known, any_value(n_missing) AS n_missing
       FROM l JOIN b ON l.variable = b.variable WHERE level IS NOT NULL GROUP BY 3, 4""",
)
def summary_categorical(spark, d):
    out = s.summary_categorical(v.ev(spark, d), ["cat", "event_type"])
    return out.withColumn("percent", F.round("percent", 6))


@query(
    "summary_continuous",
    """SELECT TRUE AS is_total, 'Overall' AS stratum, variable, count(x) AS n_known, count(*) - count(x) AS n_missing,
              round(quantile_cont(x, 0.5), 6) AS median, round(quantile_cont(x, 0.25), 6) AS q1, round(quantile_cont(x, 0.75), 6) AS q3
       FROM (SELECT 'nval' AS variable, nval AS x FROM ev UNION ALL SELECT 'value', value FROM ev) GROUP BY variable""",
)
def summary_continuous(spark, d):
    out = s.summary_continuous(v.ev(spark, d), ["nval", "value"])
    return out.withColumns({c: F.round(c, 6) for c in ("median", "q1", "q3")})


# Segments with one that is missing and one that has the name of the total.
_STRATA = "CASE c_mktsegment WHEN 'MACHINERY' THEN NULL WHEN 'BUILDING' THEN 'Overall' ELSE c_mktsegment END"


@query(
    "summary_by_stratum",
    f"""WITH k AS (SELECT {_STRATA} AS stratum, event, CASE WHEN time > 400 THEN NULL ELSE time END AS time, c_acctbal FROM surv),
            x AS (SELECT FALSE AS is_total, * FROM k WHERE stratum IS NOT NULL
                  UNION ALL SELECT TRUE, 'Overall', event, time, c_acctbal FROM k WHERE stratum IS NOT NULL)
       SELECT is_total, stratum, variable, level, count(*) AS n, round(count(*) * 100.0 / any_value(total), 6) AS percent,
              any_value(total) AS n_known, 0 AS n_missing, NULL::DOUBLE AS median, NULL::DOUBLE AS q1, NULL::DOUBLE AS q3
       FROM (SELECT is_total, stratum, 'event' AS variable, CAST(event AS VARCHAR) AS level,
                    count(*) OVER (PARTITION BY is_total, stratum) AS total FROM x)
       GROUP BY is_total, stratum, variable, level
       UNION ALL
       SELECT is_total, stratum, 'c_acctbal', NULL, NULL, NULL, count(*), 0, round(quantile_cont(c_acctbal, 0.5), 6),
              round(quantile_cont(c_acctbal, 0.25), 6), round(quantile_cont(c_acctbal, 0.75), 6) FROM x GROUP BY is_total, stratum
       UNION ALL
       SELECT is_total, stratum, 'time', NULL, NULL, NULL, count(time), count(*) - count(time), round(quantile_cont(time, 0.5), 6),
              round(quantile_cont(time, 0.25), 6), round(quantile_cont(time, 0.75), 6) FROM x GROUP BY is_total, stratum""",
)
def summary_by_stratum(spark, d):
    rows = v.surv(spark, d).withColumn("stratum", F.expr(_STRATA))
    rows = rows.withColumn("time", F.when(F.col("time") <= 400, F.col("time")))
    labels = s.summary_categorical(rows, ["event"], "stratum", overall=True)
    numbers = s.summary_continuous(rows, ["c_acctbal", "time"], "stratum", overall=True)
    both = labels.unionByName(numbers, allowMissingColumns=True)
    return both.withColumns({c: F.round(c, 6) for c in ("percent", "median", "q1", "q3")})


@query(
    "summary_frequency_order",
    """WITH k AS (SELECT c_mktsegment AS stratum, event FROM surv),
            x AS (SELECT FALSE AS is_total, * FROM k UNION ALL SELECT TRUE, 'Overall', event FROM k),
            c AS (SELECT is_total, stratum, CAST(event AS VARCHAR) AS level, count(*) AS n FROM x GROUP BY ALL),
            z AS (SELECT *, sum(n) OVER (PARTITION BY is_total, stratum) AS rows FROM c)
       SELECT CAST(row_number() OVER (ORDER BY is_total DESC, rows DESC, stratum, n DESC, level) AS INT) AS place,
              is_total, stratum, level, n FROM z""",
)
def summary_frequency_order(spark, d):
    table = s.by_frequency(s.summary_categorical(v.surv(spark, d), ["event"], "c_mktsegment", overall=True))
    # Few rows: the order of the table is made visible as a column.
    listed = table.select("is_total", "stratum", "level", "n").groupBy().agg(
        F.collect_list(F.struct("is_total", "stratum", "level", "n")).alias("rows")
    )
    return listed.select(F.posexplode("rows").alias("at", "row")).select((F.col("at") + 1).alias("place"), "row.*")


@query(
    "events_per_level",
    "SELECT c_mktsegment, count(*) AS n, CAST(sum(event) AS BIGINT) AS n_event FROM surv GROUP BY c_mktsegment",
)
def events_per_level(spark, d):
    return s.events_per_level(v.surv(spark, d), "c_mktsegment", "event")


@query(
    "discrepancy",
    """WITH l AS (SELECT l_orderkey, CASE WHEN min(l_linestatus) = max(l_linestatus) THEN min(l_linestatus) END AS derived
                  FROM lineitem GROUP BY l_orderkey)
       SELECT o_orderkey, o_orderstatus, derived FROM orders LEFT JOIN l ON o_orderkey = l_orderkey
       WHERE coalesce(o_orderstatus <> derived, TRUE)""",
)
def discrepancy(spark, d):
    low, high = F.min("l_linestatus"), F.max("l_linestatus")
    derived = read_table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.when(low == high, low).alias("derived"))
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return s.discrepancy(
        equi_join(orders, derived, {"o_orderkey": "l_orderkey"}, "left"), "o_orderstatus", "derived"
    )


@query(
    "test_chi_square",
    """WITH c AS (SELECT c_mktsegment AS a, event AS b, count(*) AS o FROM surv GROUP BY 1, 2),
            r AS (SELECT a, sum(o) AS r FROM c GROUP BY 1), k AS (SELECT b, sum(o) AS k FROM c GROUP BY 1),
            t AS (SELECT sum(o) AS n FROM c),
            g AS (SELECT r.a, k.b, r * k * 1.0 / n AS ex FROM r, k, t)
       SELECT round(sum((coalesce(o, 0) - ex) * (coalesce(o, 0) - ex) / ex), 6) AS statistic,
              (SELECT (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) FROM c) AS df,
              (SELECT CAST(n AS BIGINT) FROM t) AS n, round(min(ex), 6) AS least_expected
       FROM g LEFT JOIN c ON g.a = c.a AND g.b = c.b""",
)
def test_chi_square(spark, d):
    out = a.chi_square_statistic(v.surv(spark, d), "c_mktsegment", "event")
    return out.withColumns({c: F.round(c, 6) for c in ("statistic", "least_expected")})


_RANKS = """WITH b AS (SELECT floor(c_acctbal / 100) AS x, event, c_mktsegment FROM surv),
     k AS (SELECT *, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS mid, count(*) OVER (PARTITION BY x) AS t FROM b)"""


@query(
    "test_rank_sum",
    f"""{_RANKS} SELECT event AS stratum, count(*) AS n, sum(mid)::DOUBLE AS rank_sum,
               sum(t::DOUBLE * t - 1)::DOUBLE AS tie_part FROM k GROUP BY event""",
)
def test_rank_sum(spark, d):
    rows = v.surv(spark, d).withColumn("x", F.floor(F.col("c_acctbal") / 100))
    return a.rank_sums(rows, "x", "event")


@query(
    "test_kruskal",
    f"""{_RANKS}, g AS (SELECT c_mktsegment, count(*)::DOUBLE AS n, sum(mid) AS r FROM k GROUP BY 1),
             q AS (SELECT sum(n) AS n, sum(r * r / n) AS s, count(*) AS groups FROM g)
        SELECT round((12.0 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - (SELECT sum(t::DOUBLE * t - 1) FROM k) / (n * n * n - n)), 6) AS statistic,
               groups - 1 AS df, CAST(n AS BIGINT) AS n FROM q""",
)
def test_kruskal(spark, d):
    rows = v.surv(spark, d).withColumn("x", F.floor(F.col("c_acctbal") / 100))
    return a.kruskal_statistic(rows, "x", "c_mktsegment").withColumn("statistic", F.round("statistic", 6))


@query(
    "kaplan_meier",
    """WITH c AS (SELECT c_mktsegment, time, CAST(sum(event) AS BIGINT) AS d, count(*) AS k FROM surv GROUP BY 1, 2),
            r AS (SELECT *, CAST(sum(k) OVER (PARTITION BY c_mktsegment ORDER BY time DESC) AS BIGINT) AS n FROM c)
       SELECT c_mktsegment, time, n AS n_risk, d AS n_event, k - d AS n_censor,
              round(CASE WHEN max(CASE WHEN d = n THEN 1 ELSE 0 END) OVER w = 1 THEN 0
                         ELSE exp(sum(CASE WHEN d < n THEN ln(1 - d / n::DOUBLE) ELSE 0 END) OVER w) END, 6) AS surv,
              round(CASE WHEN max(CASE WHEN d = n THEN 1 ELSE 0 END) OVER w = 1 THEN 0
                         ELSE exp(sum(CASE WHEN d < n THEN ln(1 - d / n::DOUBLE) ELSE 0 END) OVER w) END
                    * sqrt(sum(CASE WHEN d < n THEN d / (n::DOUBLE * (n - d)) ELSE 0 END) OVER w), 6) AS std_err
       FROM r WINDOW w AS (PARTITION BY c_mktsegment ORDER BY time)""",
)
def kaplan_meier(spark, d):
    curve = sv.kaplan_meier(v.surv(spark, d), "time", "event", "c_mktsegment")
    return curve.withColumns({c: F.round(c, 6) for c in ("surv", "std_err")})


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "log_rank",
    """WITH g AS (SELECT DISTINCT c_mktsegment AS s FROM surv), t AS (SELECT DISTINCT time FROM surv),
            c AS (SELECT s, t.time, count(*) FILTER (x.time = t.time AND event = 1) AS d, count(*) FILTER (x.time >= t.time) AS n
                  FROM g, t, surv x WHERE x.c_mktsegment = s GROUP BY 1, 2),
            a AS (SELECT *, sum(d) OVER (PARTITION BY time) AS dd, sum(n) OVER (PARTITION BY time) AS nn FROM c)
       SELECT s AS c_mktsegment, CAST(sum(d) AS BIGINT) AS observed, round(sum(dd * n / nn::DOUBLE), 6) AS expected,
              round(sum(CASE WHEN nn > 1 THEN dd * (nn - dd) / (nn - 1)::DOUBLE * (n / nn::DOUBLE) * (1 - n / nn::DOUBLE) ELSE 0 END), 6) AS variance
       FROM a WHERE dd > 0 GROUP BY s""",
)
def log_rank(spark, d):
    out = sv.log_rank(v.surv(spark, d), "time", "event", "c_mktsegment", SEGMENTS)
    return out.withColumns({c: F.round(c, 6) for c in ("expected", "variance")})


def _cox_sql(x: str, select: str, steps: int = 7) -> str:
    """Newton steps for one covariate ``x``, written out one after the other."""
    parts = [
        f"z AS (SELECT time, event, {x} AS x FROM surv)",
        "b0 AS (SELECT 0.0::DOUBLE AS b, 0.0::DOUBLE AS v)",
    ]
    for i in range(1, steps + 1):
        parts.append(
            f"""b{i} AS (
            SELECT p.b + g / h AS b, 1 / h AS v FROM b{i - 1} p, (
                SELECT (SELECT sum(event * x) FROM z) - sum(s1 / s0) AS g, sum(s2 / s0 - (s1 / s0) * (s1 / s0)) AS h FROM (
                    SELECT r0 - j / d * d0 AS s0, r1 - j / d * d1 AS s1, r2 - j / d * d2 AS s2 FROM (
                        SELECT *, unnest(range(d::BIGINT)) AS j FROM (
                            SELECT time, d, d0, d1, d2, sum(n0) OVER w AS r0, sum(n1) OVER w AS r1, sum(n2) OVER w AS r2 FROM (
                                SELECT time, sum(event)::DOUBLE AS d, sum(e) AS n0, sum(e * x) AS n1, sum(e * x * x) AS n2,
                                       sum(event * e) AS d0, sum(event * e * x) AS d1, sum(event * e * x * x) AS d2
                                FROM (SELECT z.*, exp(b * x) AS e FROM z, b{i - 1}) GROUP BY time)
                            WINDOW w AS (ORDER BY time DESC)) WHERE d > 0))))"""
        )
    return f"WITH {', '.join(parts)} " + select.format(last=f"b{steps}")


_COX = ("coef", "hazard_ratio", "std_err", "conf_low", "conf_high", "p_value")


def _two_sided(z: str) -> str:
    """SQL of the two-sided normal tail: one less the series of the middle part."""
    return (
        f"(1 - 2 * exp(-({z}) * ({z}) / 2) / sqrt(2 * pi()) * list_sum(["
        f"exp((2 * k + 1) * ln({z}) - (k + 1) * ln(2) - lgamma(k + 1.5) + 0.5 * ln(pi())) FOR k IN range(0, 200)]))"
    )


_LOW = "round(exp(b - 1.959963984540054 * sqrt(v)), 6)"
_HIGH = "round(exp(b + 1.959963984540054 * sqrt(v)), 6)"
_P = f"round({_two_sided('abs(b) / sqrt(v)')}, 6)"


@query(
    "cox_univariable",
    _cox_sql(
        "(c_acctbal - (SELECT avg(c_acctbal) FROM surv)) / 1000",
        """SELECT 'balance' AS covariate, (SELECT count(*) FROM z) AS n, (SELECT CAST(sum(event) AS BIGINT) FROM z) AS n_event,
                  round(b, 6) AS coef, round(exp(b), 6) AS hazard_ratio, round(sqrt(v), 6) AS std_err,
                  """ + f"{_LOW} AS conf_low, {_HIGH} AS conf_high, {_P} AS p_value, TRUE AS converged FROM " + "{last}",
    ),
)
def cox_univariable(spark, d):
    rows = v.surv(spark, d).withColumn("balance", F.col("c_acctbal") / 1000)
    fit = sv.cox_univariable(rows, "time", "event", "balance")
    return fit.select("covariate", "n", "n_event", *[F.round(c, 6).alias(c) for c in _COX], "converged")


@query(
    "cox_two_levels",
    _cox_sql(
        "CASE WHEN c_acctbal > 3000 THEN 1.0 ELSE 0.0 END",
        """SELECT CASE x WHEN 1 THEN 'over' ELSE 'low' END AS level, count(*) AS n, CAST(sum(event) AS BIGINT) AS n_event,
                  CASE x WHEN 1 THEN any_value(round(b, 6)) ELSE 0 END AS coef,
                  CASE x WHEN 1 THEN any_value(round(exp(b), 6)) ELSE 1 END AS hazard_ratio,
                  CASE x WHEN 1 THEN any_value(round(sqrt(v), 6)) END AS std_err,
                  """ + ", ".join(f"CASE x WHEN 1 THEN any_value({t}) END AS {n}" for t, n in ((_LOW, "conf_low"), (_HIGH, "conf_high"), (_P, "p_value")))
        + ", TRUE AS converged FROM z, {last} GROUP BY x",
    ),
)
def cox_two_levels(spark, d):
    rows = v.surv(spark, d).withColumn("balance", F.when(F.col("c_acctbal") > 3000, "over").otherwise("low"))
    fit = sv.cox_univariable(rows, "time", "event", "balance")
    return fit.select("level", "n", "n_event", *[F.round(c, 6).alias(c) for c in _COX], "converged")


def _solved(p: int, source: str) -> str:
    """SQL that inverts the p x p matrix h and multiplies it with g, pivot by pivot.

    ``source`` has one row with g_i and h_i_j; the result has s_i, the solution, and v_i, the diagonal of the inverse.
    """
    k = range(p)
    entries = [f"h_{i}_{j} AS a_{i}_{j}" for i in k for j in k] + [f"g_{i} AS a_{i}_{p}" for i in k]
    entries += [f"{1.0 if i == j else 0.0}::DOUBLE AS a_{i}_{p + 1 + j}" for i in k for j in k]
    sql = f"SELECT {', '.join(entries)} FROM ({source})"
    width = 2 * p + 1
    for r in k:
        cells = [f"a_{r}_{c} / a_{r}_{r} AS a_{r}_{c}" for c in range(width)]
        cells += [f"a_{i}_{c} - a_{i}_{r} * a_{r}_{c} / a_{r}_{r} AS a_{i}_{c}" for i in k if i != r for c in range(width)]
        sql = f"SELECT {', '.join(cells)} FROM ({sql})"
    return f"SELECT {', '.join([f'a_{i}_{p} AS s_{i}' for i in k] + [f'a_{i}_{p + 1 + i} AS v_{i}' for i in k])} FROM ({sql})"


def _cox_levels_sql(column: str, levels: list[str], select: str, steps: int = 6) -> str:
    """Newton steps for the levels of a text, against the first one, written out."""
    k, p = range(len(levels)), len(levels) - 1
    weight = lambda i: "1" if i == 0 else f"exp(b_{i - 1})"
    parts = [
        f"""c AS (SELECT time, sum(event)::DOUBLE AS d, {', '.join(f"count(*) FILTER ({column} = '{v}') AS n_{i}, coalesce(sum(event) FILTER ({column} = '{v}'), 0) AS d_{i}" for i, v in enumerate(levels))}
              FROM surv GROUP BY time)""",
        f"r AS (SELECT *, {', '.join(f'sum(n_{i}) OVER w AS r_{i}' for i in k)} FROM c WINDOW w AS (ORDER BY time DESC))",
        f"j AS (SELECT {', '.join(f'r_{i} - j / d * d_{i} AS x_{i}' for i in k)} FROM (SELECT *, unnest(range(d::BIGINT)) AS j FROM r WHERE d > 0))",
        f"o AS (SELECT {', '.join(f'sum(d_{i})::DOUBLE AS o_{i}' for i in k)} FROM c)",
        f"b0 AS (SELECT {', '.join(f'0.0::DOUBLE AS b_{i}, 0.0::DOUBLE AS v_{i}' for i in range(p))})",
    ]
    for step in range(1, steps + 1):
        mass = " + ".join(f"x_{i} * {weight(i)}" for i in k)
        shares = ", ".join(f"x_{i} * {weight(i)} / ({mass}) AS q_{i}" for i in k)
        sums = [f"any_value(o_{i + 1}) - sum(q_{i + 1}) AS g_{i}" for i in range(p)]
        sums += [
            f"sum({f'q_{i + 1}' if i == j else '0'} - q_{i + 1} * q_{j + 1}) AS h_{i}_{j}" for i in range(p) for j in range(p)
        ]
        source = f"SELECT {', '.join(sums)} FROM (SELECT {shares} FROM j, b{step - 1}), o"
        new = ", ".join(f"b_{i} + s_{i} AS b_{i}, s.v_{i} AS v_{i}" for i in range(p))
        parts.append(f"b{step} AS (SELECT {new} FROM b{step - 1} AS b, ({_solved(p, source)}) AS s)")
    lines = [f"SELECT '{levels[0]}' AS level, 0.0::DOUBLE AS b, NULL::DOUBLE AS v"]
    lines += [f"SELECT '{v}', b_{i}, v_{i} FROM b{steps}" for i, v in enumerate(levels[1:])]
    return f"WITH {', '.join(parts)}, e AS ({' UNION ALL '.join(lines)}) {select}"


@query(
    "cox_univariable_levels",
    _cox_levels_sql(
        "c_mktsegment",
        SEGMENTS,
        f"""SELECT 'c_mktsegment' AS covariate, level, count(*) AS n, CAST(sum(event) AS BIGINT) AS n_event, round(any_value(b), 6) AS coef,
                   any_value(round(exp(b), 6)) AS hazard_ratio, any_value(round(sqrt(v), 6)) AS std_err,
                   any_value({_LOW}) AS conf_low, any_value({_HIGH}) AS conf_high,
                   any_value(CASE WHEN v IS NOT NULL THEN {_P} END) AS p_value, TRUE AS converged
            FROM e JOIN surv ON level = c_mktsegment GROUP BY level""",
    ),
)
def cox_univariable_levels(spark, d):
    fit = sv.cox_univariable(v.surv(spark, d), "time", "event", "c_mktsegment")
    return fit.withColumns({c: F.round(c, 6) for c, t in fit.dtypes if t == "double"}).drop("iterations")


@query(
    "log_rank_test",
    f"""WITH z AS (SELECT time, event, CASE WHEN c_acctbal > 3000 THEN 'over' ELSE 'low' END AS s FROM surv),
             c AS (SELECT time, sum(event)::DOUBLE AS d, count(*) AS n, count(*) FILTER (s = 'low') AS n1, sum(event) FILTER (s = 'low') AS d1 FROM z GROUP BY time),
             r AS (SELECT *, sum(n) OVER w AS r, sum(n1) OVER w AS r1 FROM c WINDOW w AS (ORDER BY time DESC)),
             t AS (SELECT sum(coalesce(d1, 0) - d * r1 / r) AS diff,
                          sum(CASE WHEN r > 1 THEN d * (r - d) / (r - 1) * (r1 / r) * (1 - r1 / r) ELSE 0 END) AS v FROM r WHERE d > 0)
        SELECT round(diff * diff / v, 6) AS statistic, 1 AS df, round({_two_sided('abs(diff) / sqrt(v)')}, 6) AS p_value FROM t""",
)
def log_rank_test(spark, d):
    rows = v.surv(spark, d).withColumn("balance", F.when(F.col("c_acctbal") > 3000, "over").otherwise("low"))
    out = sv.log_rank_test(rows, "time", "event", "balance")
    line = (round(out["statistic"], 6), out["df"], round(out["p_value"], 6))
    return spark.createDataFrame([line], "statistic double, df int, p_value double")


# Tail of chi-square with four degrees of freedom.
_CHI4 = "exp(-({x}) / 2) * (1 + ({x}) / 2)"


@query(
    "association_tests",
    f"""{_RANKS},
        g AS (SELECT c_mktsegment, count(*)::DOUBLE AS n, sum(mid) AS r FROM k GROUP BY 1),
        ties AS (SELECT sum(t::DOUBLE * t - 1) AS ties FROM k),
        q AS (SELECT sum(n) AS n, sum(r * r / n) AS s FROM g),
        h AS (SELECT (12.0 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - ties / (n * n * n - n)) AS h FROM q, ties),
        e AS (SELECT count(*) FILTER (event = 0)::DOUBLE AS a, count(*) FILTER (event = 1)::DOUBLE AS b, sum(mid) FILTER (event = 0) AS ra FROM k),
        u AS (SELECT a, b, ra - a * (a + 1) / 2 AS w, sqrt(a * b / 12 * ((a + b + 1) - ties / ((a + b) * (a + b - 1)))) AS sd FROM e, ties),
        z AS (SELECT w, abs(w - a * b / 2) - 0.5 AS shift, sd FROM u),
        c AS (SELECT c_mktsegment AS x, event AS y, count(*)::DOUBLE AS o FROM surv GROUP BY 1, 2),
        m AS (SELECT sum(o * o / (rx * ry)) * any_value(n) - any_value(n) AS chi FROM (
                SELECT o, sum(o) OVER (PARTITION BY x) AS rx, sum(o) OVER (PARTITION BY y) AS ry, sum(o) OVER () AS n FROM c))
        SELECT 'kruskal-wallis' AS test, round(h, 6) AS statistic, round({_CHI4.format(x='h')}, 6) AS p_value FROM h
        UNION ALL SELECT 'rank-sum', round(w, 6), round({_two_sided('shift / sd')}, 6) FROM z
        UNION ALL SELECT 'chi-square', round(chi, 6), round({_CHI4.format(x='chi')}, 6) FROM m""",
)
def association_tests(spark, d):
    rows = v.surv(spark, d).withColumn("x", F.floor(F.col("c_acctbal") / 100)).withColumn("label", F.col("event").cast("string"))
    found = [a.compare(rows, "x", "c_mktsegment"), a.compare(rows, "x", "event"), a.chi_square_test(rows, "label", "c_mktsegment")]
    lines = [(r["test"], round(r["statistic"], 6), round(r["p_value"], 6)) for r in found]
    return spark.createDataFrame(lines, "test string, statistic double, p_value double")
