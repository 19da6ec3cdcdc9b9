"""Sources, projections, filters, scalar functions and recodes."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kohorta.catalog import views as v
from kohorta.catalog.registry import query
from kohorta.functions import exprs as x, recode as r
from kohorta.operators import selectors as s
from kohorta.operators.joins import lookup, restrict, semi_or_anti
from kohorta.operators.reshape import union_by_name
from kohorta.operators.summary import frequency, frequency_ordered
from kohorta.session import shared_folder
from kohorta.sources import tables as io

ORDER_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"
)


def _scratch(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query(
    "scan_csv_roundtrip",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
)
def scan_csv_roundtrip(spark, d):
    orders = io.read_table(spark, d, "orders").select(
        F.monotonically_increasing_id().alias("row"), *[c.split()[0] for c in ORDER_SCHEMA.split(", ")]
    )
    path = io.write_csv(orders, _scratch(spark, "orders"))
    return io.read_csv(spark, path, f"row bigint, {ORDER_SCHEMA}", drop=["row"])


@query(
    "scan_csv_inferred",
    """SELECT o_orderkey, o_totalprice, o_orderpriority || chr(10) || '"' || o_orderstatus || '"' AS note, o_custkey % 2 = 0 AS even
       FROM orders""",
)
def scan_csv_inferred(spark, d):
    note = F.concat("o_orderpriority", F.lit('\n"'), "o_orderstatus", F.lit('"'))
    orders = io.read_table(spark, d, "orders").select(
        "o_orderkey", "o_totalprice", note.alias("note"), (F.col("o_custkey") % 2 == 0).alias("even")
    )
    return io.read_csv(spark, io.write_csv(orders, _scratch(spark, "typed")))


# Texts with line breaks as they are, and with quotes, commas, edge blanks, none and nothing.
_AWKWARD = """CASE doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '"' || text || '", "x""y"'
    WHEN 3 THEN '  ' || text || ' ' WHEN 4 THEN 'NA' ELSE text END"""
_SINK_ROWS = f"SELECT doc_id, {_AWKWARD} AS note FROM documents"


@query(
    "sink_roundtrip",
    f"SELECT kind, doc_id, note FROM ({_SINK_ROWS}), (VALUES ('csv'), ('parquet')) AS t(kind)",
)
def sink_roundtrip(spark, d):
    docs = io.read_table(spark, d, "documents").select("doc_id", F.expr(_AWKWARD).alias("note"))
    base = _scratch(spark, "sink")
    csv, parquet = io.write_all(docs, [("csv", f"{base}/a"), ("parquet", f"{base}/b")])
    return union_by_name(
        io.read_csv(spark, csv, "doc_id bigint, note string").withColumn("kind", F.lit("csv")),
        spark.read.parquet(parquet).withColumn("kind", F.lit("parquet")),
    )


# Fixed values of this check: drugs added to the dimension, upper-case on purpose.
ADDED = [
    {"drug_name": "NEW RING", "general": "targeted_therapy"},
    {"drug_name": "NEW BOLT", "general": "cytotoxic_therapy"},
]


def dimension(spark, d):
    """One row per drug name."""
    part = io.read_table(spark, d, "part")
    return part.groupBy(F.col("p_name").alias("drug_name")).agg(
        F.min("p_type").alias("general"), F.min("p_brand").alias("narrow")
    )


@query(
    "dim_add_rows",
    """WITH dim AS (
           SELECT p_name AS drug_name, min(p_type) AS general FROM part GROUP BY p_name
           UNION ALL SELECT 'NEW RING', 'targeted_therapy' UNION ALL SELECT 'NEW BOLT', 'cytotoxic_therapy'),
       probe AS (SELECT replace(p_name, 'old ', 'new ') AS drug FROM part)
       SELECT drug, general, count(*) AS n FROM probe
       LEFT JOIN (SELECT lower(drug_name) AS k, min(general) AS general FROM dim GROUP BY 1) ON lower(drug) = k
       GROUP BY drug, general""",
)
def dim_add_rows(spark, d):
    dim = io.add_rows(dimension(spark, d), ADDED)
    unique = dim.groupBy(F.lower("drug_name").alias("drug_name")).agg(F.min("general").alias("general"))
    probe = io.read_table(spark, d, "part").select(
        F.replace("p_name", F.lit("old "), F.lit("new ")).alias("drug")
    )
    found = lookup(probe, unique, {"drug": "drug_name"}, normalize=F.lower)
    return found.groupBy("drug", "general").agg(F.count(F.lit(1)).alias("n"))


@query(
    "dim_lookup",
    """SELECT upper(drug) AS medication, general, narrow, count(*) AS n
       FROM med LEFT JOIN (SELECT p_name, min(p_type) AS general, min(p_brand) AS narrow FROM part GROUP BY p_name)
         ON lower(drug) = p_name GROUP BY 1, 2, 3""",
)
def dim_lookup(spark, d):
    rows = v.med(spark, d).select(F.upper("drug").alias("medication"))
    found = lookup(rows, dimension(spark, d), {"medication": "drug_name"}, normalize=F.lower)
    return found.groupBy("medication", "general", "narrow").agg(F.count(F.lit(1)).alias("n"))


@query("project_rename", "SELECT c_custkey AS patient, c_mktsegment AS stratum, c_acctbal AS balance FROM customer")
def project_rename(spark, d):
    customer = io.read_table(spark, d, "customer").drop("c_name", "c_nationkey")
    return customer.select(F.col("c_custkey").alias("patient"), "c_mktsegment", "c_acctbal").withColumnsRenamed(
        {"c_mktsegment": "stratum", "c_acctbal": "balance"}
    )


@query(
    "clean_names",
    """SELECT c_custkey AS cust_key, c_name AS full_name, c_nationkey AS nation_key,
              c_acctbal AS acct_bal_percent, c_mktsegment AS mkt_segment FROM customer""",
)
def clean_names(spark, d):
    messy = io.read_table(spark, d, "customer").toDF("CustKey", "Full.Name", "NATIONKey", "Acct Bal (%)", "mktSegment")
    return s.clean_names(messy)


@query(
    "select_range_prefix",
    """SELECT l_shipdate, l_orderkey, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus FROM lineitem""",
)
def select_range_prefix(spark, d):
    items = io.read_table(spark, d, "lineitem")
    kept = items.select(
        "l_orderkey",
        *s.span(items, "l_quantity", "l_tax"),
        *s.with_substring(items, "status"),
        *s.with_prefix(items, "l_ship"),
    )
    return s.relocate(kept, ["l_shipdate"], before="l_orderkey")


@query(
    "na_if_by_type",
    """SELECT event_id, ts, user_id, nullif(event_type, 'error') AS event_type, value,
              nullif(props, 'error') AS props FROM events""",
)
def na_if_by_type(spark, d):
    events = io.read_table(spark, d, "events")
    return s.across(events, s.of_type(events, "string"), lambda c: x.na_if(c, "error"))


@query("drop_empty_columns", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def drop_empty_columns(spark, d):
    customer = io.read_table(spark, d, "customer").withColumns(
        {"hpv_16": F.lit(None).cast("string"), "hpv_63": x.capture("c_name", "(absent)")}
    )
    return s.drop_empty_columns(customer, s.span(customer, "c_nationkey", "hpv_63"))


@query("filter_eq", "SELECT event_id, user_id, value FROM ev WHERE cat = 'purchase' AND day <> 3")
def filter_eq(spark, d):
    e = v.ev(spark, d)
    return e.filter((F.col("cat") == "purchase") & (F.col("day") != 3)).select("event_id", "user_id", "value")


@query("filter_isin", "SELECT event_id, cat FROM ev WHERE cat IN ('view', 'signup')")
def filter_isin(spark, d):
    return v.ev(spark, d).filter(F.col("cat").isin("view", "signup")).select("event_id", "cat")


@query(
    "filter_null_compound",
    "SELECT event_id, cat, nval FROM ev WHERE (cat IS NULL AND nval IS NOT NULL) OR (cat = 'click' AND nval IS NULL)",
)
def filter_null_compound(spark, d):
    cat, nval = F.col("cat"), F.col("nval")
    kept = (cat.isNull() & nval.isNotNull()) | ((cat == "click") & nval.isNull())
    return v.ev(spark, d).filter(kept).select("event_id", "cat", "nval")


@query(
    "cohort_semi",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM coh)",
)
def cohort_semi(spark, d):
    orders = io.read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return restrict(orders, v.coh(spark, d), {"o_custkey": "c_custkey"})


@query(
    "cohort_anti",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM coh)",
)
def cohort_anti(spark, d):
    orders = io.read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return restrict(orders, v.coh(spark, d), {"o_custkey": "c_custkey"}, "anti")


@query(
    "cohort_substring",
    """WITH keys AS (SELECT DISTINCT 'P' || o_custkey AS patient FROM orders),
            hit AS (SELECT DISTINCT patient FROM keys JOIN (SELECT 'P' || c_custkey AS k FROM coh) ON contains(patient, k))
       SELECT o_orderkey, 'P' || o_custkey AS patient FROM orders WHERE 'P' || o_custkey IN (SELECT patient FROM hit)""",
)
def cohort_substring(spark, d):
    orders = io.read_table(spark, d, "orders").select(
        "o_orderkey", F.concat(F.lit("P"), F.col("o_custkey")).alias("patient")
    )
    keys = v.coh(spark, d).select(F.concat(F.lit("P"), F.col("c_custkey")).alias("k"))
    return restrict(orders, keys, {"patient": "k"}, substring=True)


@query(
    "semi_or_anti",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_custkey NOT IN (SELECT o_custkey FROM idx) OR o_custkey IN (SELECT c_custkey FROM coh)""",
)
def semi_or_anti_query(spark, d):
    orders = io.read_table(spark, d, "orders").select("o_orderkey", "o_custkey")
    cohort = v.coh(spark, d).select(F.col("c_custkey").alias("o_custkey"))
    return semi_or_anti(orders, v.idx(spark, d), cohort, "o_custkey")


@query(
    "regex_flag",
    """SELECT p_partkey, contains(p_name, 'bolt') AS has_bolt, regexp_matches(p_brand, '#1[0-5]$') AS low_brand
       FROM part WHERE NOT contains(p_name, 'old')""",
)
def regex_flag(spark, d):
    name = F.col("p_name")
    return io.read_table(spark, d, "part").filter(~name.contains("old")).select(
        "p_partkey",
        name.contains("bolt").alias("has_bolt"),
        F.col("p_brand").rlike("#1[0-5]$").alias("low_brand"),
    )


@query(
    "any_column_match",
    """WITH p AS (SELECT p_partkey, nullif(p_type, 'PROMO') AS regimen_1, p_name AS regimen_2, nullif(p_brand, 'Brand#2') AS regimen_3 FROM part)
       SELECT p_partkey,
              CASE WHEN contains(regimen_1, 'in') OR contains(regimen_2, 'in') OR contains(regimen_3, 'in') THEN 'Yes'
                   WHEN regimen_1 IS NOT NULL THEN 'No' END AS received_any,
              CASE WHEN contains(regimen_1, 'AR') THEN 'Yes' WHEN regimen_1 IS NOT NULL THEN 'No' END AS received_first
       FROM p""",
)
def any_column_match(spark, d):
    part = io.read_table(spark, d, "part").select(
        "p_partkey",
        x.na_if("p_type", "PROMO").alias("regimen_1"),
        F.col("p_name").alias("regimen_2"),
        x.na_if("p_brand", "Brand#2").alias("regimen_3"),
    )
    known = F.col("regimen_1").isNotNull()
    return part.select(
        "p_partkey",
        x.yes_no(x.any_contains(s.with_substring(part, "regimen_"), "in"), known).alias("received_any"),
        x.yes_no(x.any_contains(["regimen_1"], "AR"), known).alias("received_first"),
    )


@query("distinct_rows", "SELECT DISTINCT p_brand, p_type, p_name FROM part")
def distinct_rows(spark, d):
    return io.read_table(spark, d, "part").select("p_brand", "p_type", "p_name").distinct()


@query("distinct_sorted", "SELECT DISTINCT p_type, p_brand FROM part ORDER BY p_type, p_brand")
def distinct_sorted(spark, d):
    part = io.read_table(spark, d, "part").select("p_type", "p_brand").distinct()
    return part.orderBy(F.col("p_type").asc_nulls_last(), F.col("p_brand").asc_nulls_last())


@query("freq_table", "SELECT cat, count(*) AS n FROM ev GROUP BY cat")
def freq_table(spark, d):
    return frequency(v.ev(spark, d), "cat")


@query("freq_ordered", "SELECT p_name, count(*) AS n FROM part GROUP BY p_name ORDER BY n DESC, p_name")
def freq_ordered(spark, d):
    return frequency_ordered(io.read_table(spark, d, "part"), "p_name")


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def row_count(spark, d):
    return io.read_table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query("sort_nulls_last", "SELECT event_id, day, nval FROM ev ORDER BY day, nval DESC NULLS LAST, event_id")
def sort_nulls_last(spark, d):
    from kohorta.operators.keys import sort_columns

    return v.ev(spark, d).select("event_id", "day", "nval").orderBy(*sort_columns(["day", "-nval", "event_id"]))


@query(
    "union_by_name",
    """SELECT user_id AS key, value AS amount, event_type AS kind, CAST(NULL AS VARCHAR) AS priority FROM events
       UNION ALL SELECT o_custkey, o_totalprice, NULL, o_orderpriority FROM orders""",
)
def union_by_name_query(spark, d):
    events = io.read_table(spark, d, "events").select(
        F.col("user_id").alias("key"), F.col("value").alias("amount"), F.col("event_type").alias("kind")
    )
    orders = io.read_table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("amount"), F.col("o_custkey").alias("key")
    )
    return union_by_name(events, orders)


@query(
    "parse_sentinel",
    """SELECT p_partkey,
              CASE age_txt WHEN 'Age 90 or older' THEN 90.0::DOUBLE WHEN 'Unknown/Not Applicable' THEN NULL
                   ELSE try_cast(age_txt AS DOUBLE) END AS age,
              try_cast(replace(p_brand, 'Brand#', '') AS DOUBLE) AS brand_no,
              try_cast(p_name AS DOUBLE) AS name_no
       FROM age_raw""",
)
def parse_sentinel(spark, d):
    return v.age_raw(spark, d).select(
        "p_partkey",
        x.parse_age("age_txt").alias("age"),
        x.parse_number(x.remove_all("p_brand", "Brand#")).alias("brand_no"),
        x.parse_number("p_name").alias("name_no"),
    )


@query(
    "sentinel_flag",
    """SELECT p_partkey, CASE WHEN age_txt = 'Age 90 or older' THEN 'Age 90 or older' END AS not_real_age FROM age_raw""",
)
def sentinel_flag(spark, d):
    return v.age_raw(spark, d).select("p_partkey", x.sentinel_flag("age_txt").alias("not_real_age"))


@query(
    "coalesce_cols",
    """SELECT event_id, coalesce(nval, CAST(day AS DOUBLE)) AS filled, CASE WHEN nval IS NULL AND day IS NOT NULL THEN 'Yes' END AS imputed,
              coalesce(cat, 'No') AS label FROM ev""",
)
def coalesce_cols(spark, d):
    return v.ev(spark, d).select(
        "event_id",
        F.coalesce("nval", F.col("day").cast("double")).alias("filled"),
        x.imputed_flag("nval", "day").alias("imputed"),
        x.replace_na("cat", "No").alias("label"),
    )


@query(
    "regex_remove_first",
    """SELECT p_partkey, regexp_replace(p_name, ' ring|old | bolt|red ', '') AS stem,
              regexp_replace(p_brand || p_brand, 'Brand|#', '') AS brand FROM part""",
)
def regex_remove_first(spark, d):
    return io.read_table(spark, d, "part").select(
        "p_partkey",
        x.remove_first("p_name", " ring|old | bolt|red ").alias("stem"),
        x.remove_first(F.concat("p_brand", "p_brand"), "Brand|#").alias("brand"),
    )


@query(
    "regex_capture",
    r"""SELECT p_partkey,
              CASE WHEN regexp_matches(p_brand, 'Brand#(1\d)') THEN regexp_extract(p_brand, 'Brand#(1\d)', 1) END AS teen,
              CASE WHEN regexp_matches(p_name, '^(\w+) (ring|bolt)$') THEN regexp_extract(p_name, '^(\w+) (ring|bolt)$', 2) END AS form,
              CASE WHEN contains(p_name, 'hot') THEN 'hot : ' || p_type ELSE p_type END AS label
       FROM part""",
)
def regex_capture(spark, d):
    hot = F.when(F.col("p_name").contains("hot"), F.lit("hot"))
    return io.read_table(spark, d, "part").select(
        "p_partkey",
        x.capture("p_brand", r"Brand#(1\d)").alias("teen"),
        x.capture("p_name", r"^(\w+) (ring|bolt)$", 2).alias("form"),
        F.coalesce(x.concat_strict(hot, "p_type", sep=" : "), "p_type").alias("label"),
    )


@query(
    "text_normalize",
    """SELECT p_partkey, replace(lower(upper(p_name)), ' ', '_') AS marker,
              regexp_replace(p_name, '[aeiou]', '', 'g') AS consonants,
              regexp_replace(p_brand, '[0-9]', 'x', 'g') AS masked FROM part""",
)
def text_normalize(spark, d):
    return io.read_table(spark, d, "part").select(
        "p_partkey",
        x.snake_text(F.upper("p_name")).alias("marker"),
        x.remove_all("p_name", "[aeiou]").alias("consonants"),
        x.replace_all("p_brand", "[0-9]", "x").alias("masked"),
    )


@query(
    "concat_na",
    """SELECT event_id, event_type || ' : ' || cat AS strict,
              'day = ' || day || ', cat = ' || coalesce(cat, 'NA') AS text,
              CASE WHEN nval = floor(nval) THEN CAST(CAST(nval AS BIGINT) AS VARCHAR) END AS whole
       FROM ev""",
)
def concat_na(spark, d):
    return v.ev(spark, d).select(
        "event_id",
        x.concat_strict("event_type", "cat", sep=" : ").alias("strict"),
        x.concat_text(F.lit("day = "), x.fmt_num("day"), F.lit(", cat = "), "cat").alias("text"),
        F.when(F.col("nval") == F.floor("nval"), x.fmt_num("nval")).alias("whole"),
    )


@query(
    "unite_columns",
    """SELECT event_id, concat_ws('_', cat, CASE WHEN nval IS NOT NULL THEN event_type END) AS kept,
              coalesce(cat, 'NA') || '_' || day AS pasted FROM ev""",
)
def unite_columns(spark, d):
    return v.ev(spark, d).select(
        "event_id",
        x.unite(["cat", F.when(F.col("nval").isNotNull(), F.col("event_type"))], na_rm=True).alias("kept"),
        x.unite(["cat", "day"]).alias("pasted"),
    )


@query(
    "recode_rules",
    """SELECT p_partkey,
              CASE WHEN contains(p_name, 'red') THEN 'warm' WHEN p_type IN ('SMALL', 'MEDIUM') OR contains(p_name, 'hot') THEN 'mid'
                   WHEN p_type = 'PROMO' THEN 'Unknown' ELSE p_type END AS grp,
              CASE WHEN contains(p_brand, '1') THEN '1' WHEN contains(p_brand, '2') THEN '2' END AS stage
       FROM part""",
)
def recode_rules(spark, d):
    name, kind, brand = F.col("p_name"), F.col("p_type"), F.col("p_brand")
    return io.read_table(spark, d, "part").select(
        "p_partkey",
        r.recode(
            [
                (name.contains("red"), "warm"),
                (r.equals_any(kind, ["SMALL", "MEDIUM"]) | name.contains("hot"), "mid"),
                (kind == "PROMO", "Unknown"),
            ],
            default=kind,
        ).alias("grp"),
        r.recode([(brand.contains("1"), "1"), (brand.contains("2"), "2")]).alias("stage"),
    )


@query(
    "recode_two_column",
    """SELECT p_partkey,
              CASE WHEN p_type = 'SMALL' AND p_name = 'red bolt' THEN 'Serous'
                   WHEN p_type = 'SMALL' AND p_size > 25 THEN 'Mixed'
                   WHEN p_type = 'LARGE' THEN 'Other' WHEN p_type = 'ECONOMY' THEN 'Exclude' END AS histotype
       FROM part""",
)
def recode_two_column(spark, d):
    kind = F.col("p_type")
    return io.read_table(spark, d, "part").select(
        "p_partkey",
        r.recode(
            [
                ((kind == "SMALL") & (F.col("p_name") == "red bolt"), "Serous"),
                ((kind == "SMALL") & (F.col("p_size") > 25), "Mixed"),
                (kind == "LARGE", "Other"),
                (kind == "ECONOMY", "Exclude"),
            ]
        ).alias("histotype"),
    )


@query(
    "ordinal_map",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 90
              WHEN '4-NOT SPECIFIED' THEN 999 END AS code FROM orders""",
)
def ordinal_map(spark, d):
    codes = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 90, "4-NOT SPECIFIED": 999}
    return io.read_table(spark, d, "orders").select(
        "o_orderkey", r.ordinal(F.col("o_orderpriority"), codes).alias("code")
    )


@query(
    "bin_numeric",
    """SELECT event_id, CASE WHEN nval < 18.5 THEN 'Underweight' WHEN nval >= 18.5 AND nval < 25 THEN 'Healthy'
              WHEN nval >= 25 AND nval < 30 THEN 'Overweight' WHEN nval >= 30 THEN 'Obese' END AS bmi_cat FROM ev""",
)
def bin_numeric(spark, d):
    from kohorta.functions.clinical import BMI_CUTS, BMI_LABELS

    return v.ev(spark, d).select("event_id", r.bin_numeric(F.col("nval"), BMI_CUTS, BMI_LABELS).alias("bmi_cat"))


@query(
    "category_domain",
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('3-MEDIUM', '1-URGENT', '5-LOW') THEN o_orderpriority END AS priority,
              CASE o_orderpriority WHEN '3-MEDIUM' THEN 1::BIGINT WHEN '1-URGENT' THEN 2 WHEN '5-LOW' THEN 3 END AS place
       FROM orders""",
)
def category_domain(spark, d):
    levels = ["3-MEDIUM", "1-URGENT", "5-LOW"]
    p = F.col("o_orderpriority")
    return io.read_table(spark, d, "orders").select(
        "o_orderkey", r.domain(p, levels).alias("priority"), r.domain_rank(p, levels).alias("place")
    )


@query(
    "range_interpretation",
    """WITH b AS (SELECT event_id, nval, CASE WHEN cat = 'signup' THEN 'Not tested' END AS ind,
                         CASE event_type WHEN 'click' THEN 20.0 WHEN 'view' THEN 40.0 ELSE 15.0 END AS lo,
                         CASE event_type WHEN 'click' THEN 60.0 WHEN 'error' THEN NULL ELSE 100.0 END AS hi FROM ev)
       SELECT event_id, coalesce(ind, CASE WHEN nval >= lo AND nval <= hi THEN 'WNL (Within Normal Limits)'
              WHEN nval < lo THEN 'Low' WHEN nval > hi THEN 'High' END) AS interpretation FROM b""",
)
def range_interpretation(spark, d):
    kind = F.col("event_type")
    low = r.recode([(kind == "click", "20"), (kind == "view", "40")], default="15")
    high = r.recode([(kind == "click", "60"), (kind == "error", None)], default="100")
    indicator = F.when(F.col("cat") == "signup", F.lit("Not tested"))
    return v.ev(spark, d).select(
        "event_id", x.in_range_label(F.col("nval"), low, high, indicator).alias("interpretation")
    )
