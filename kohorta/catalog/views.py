"""Tables derived from the given ones, in Spark and as SQL text.

The given tables hold no missing values; these views put them in by rule.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from kohorta.functions.exprs import na_if
from kohorta.functions.recode import recode
from kohorta.operators.events import index_event
from kohorta.operators.keys import equi_join
from kohorta.sources.tables import read_table

# Texts of the line numbers 1..6; 7 stands for an unknown line.
LINE_TEXTS = {
    1: "First Line/Regimen",
    2: "Second Line/Regimen",
    3: "Third Line/Regimen",
    4: "Fourth Line/Regimen",
    5: "Fifth Line/Regimen",
    6: "Sixth Line/Regimen",
}

SQL_VIEWS: dict[str, str] = {
    "ev": """
        SELECT event_id, ts, user_id, event_type, value, props,
               nullif(event_type, 'error') AS cat,
               CASE WHEN value >= 10 THEN value END AS nval,
               CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) AS day
        FROM events""",
    "age_raw": """
        SELECT part.*,
               CASE WHEN p_size >= 48 THEN 'Age 90 or older'
                    WHEN p_size <= 2 THEN 'Unknown/Not Applicable'
                    WHEN p_size = 3 THEN 'bad'
                    ELSE CAST(p_size AS VARCHAR) END AS age_txt
        FROM part""",
    "ord_n": """
        SELECT *, CASE WHEN o_totalprice >= 50000 THEN day END AS nday
        FROM (SELECT orders.*,
                     CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS day,
                     CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS evt
              FROM orders)""",
    "coh": """
        SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'""",
    "idx": """
        SELECT o_custkey, min(day) AS t0, count(*) AS number_of_dx
        FROM ord_n WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey""",
    "med": """
        SELECT o_custkey, day AS start,
               CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) AS stop,
               p_name AS drug, nullif(p_type, 'PROMO') AS class,
               nullif(l_linenumber, 7) AS line
        FROM lineitem JOIN ord_n ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "idx_site": """
        SELECT i.o_custkey, any_value(i.t0) AS t0, any_value(i.number_of_dx) AS number_of_dx,
               min(CASE WHEN m.start = i.t0 THEN m.class END) AS site
        FROM idx i LEFT JOIN med m ON i.o_custkey = m.o_custkey GROUP BY i.o_custkey""",
    "surv": """
        SELECT c_custkey, c_mktsegment, c_acctbal,
               coalesce(first_f, last_day) - t0 AS time,
               CASE WHEN first_f IS NULL THEN 0 ELSE 1 END AS event
        FROM (SELECT o.o_custkey, any_value(i.t0) AS t0, max(o.day) AS last_day,
                     min(CASE WHEN o.o_orderstatus = 'F' AND o.day > i.t0 THEN o.day END) AS first_f
              FROM ord_n o JOIN idx i ON o.o_custkey = i.o_custkey GROUP BY o.o_custkey)
        JOIN customer ON c_custkey = o_custkey""",
    "lines": f"""
        SELECT *, CASE line {' '.join(f"WHEN {n} THEN '{t}'" for n, t in LINE_TEXTS.items())}
                  ELSE 'Unknown/Not Applicable' END AS line_txt
        FROM med""",
}


def with_views(sql: str) -> str:
    """Put the views that the text names in front of it, in dependency order."""
    needed: set[str] = set()

    def find(text: str) -> None:
        for name, body in SQL_VIEWS.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                find(body)

    find(sql)
    views = [f"{n} AS ({b})" for n, b in SQL_VIEWS.items() if n in needed]
    if not views:
        return sql
    head = ",\n".join(views)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"


def _days_since(column: str, origin: str):
    return F.datediff(F.to_date(column), F.lit(origin).cast("date")).cast("bigint")


def ev(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "events").withColumns(
        {
            "cat": na_if("event_type", "error"),
            "nval": F.when(F.col("value") >= 10, F.col("value")),
            "day": _days_since("ts", "2024-01-01"),
        }
    )


def age_raw(spark: SparkSession, d: str) -> DataFrame:
    size = F.col("p_size")
    text = recode(
        [
            (size >= 48, "Age 90 or older"),
            (size <= 2, "Unknown/Not Applicable"),
            (size == 3, "bad"),
        ],
        default=size.cast("string"),
    )
    return read_table(spark, d, "part").withColumn("age_txt", text)


def ord_n(spark: SparkSession, d: str) -> DataFrame:
    orders = read_table(spark, d, "orders").withColumns(
        {
            "day": _days_since("o_orderdate", "1995-01-01"),
            "evt": F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0),
        }
    )
    return orders.withColumn("nday", F.when(F.col("o_totalprice") >= 50000, F.col("day")))


def coh(spark: SparkSession, d: str) -> DataFrame:
    customer = read_table(spark, d, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return customer.select("c_custkey", "c_name", "c_acctbal")


def idx(spark: SparkSession, d: str) -> DataFrame:
    urgent = ord_n(spark, d).filter(F.col("o_orderpriority") == "1-URGENT")
    return urgent.groupBy("o_custkey").agg(
        F.min("day").alias("t0"), F.count(F.lit(1)).alias("number_of_dx")
    )


def med(spark: SparkSession, d: str) -> DataFrame:
    orders = ord_n(spark, d).select("o_orderkey", "o_custkey", F.col("day").alias("start"))
    parts = read_table(spark, d, "part").select(
        "p_partkey", F.col("p_name").alias("drug"), na_if("p_type", "PROMO").alias("class")
    )
    items = read_table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        _days_since("l_shipdate", "1995-01-01").alias("stop"),
        F.nullif("l_linenumber", F.lit(7)).alias("line"),
    )
    rows = equi_join(equi_join(items, orders, {"l_orderkey": "o_orderkey"}), parts, {"l_partkey": "p_partkey"})
    return rows.select("o_custkey", "start", "stop", "drug", "class", "line")


def idx_site(spark: SparkSession, d: str, rows: DataFrame | None = None) -> DataFrame:
    """Index events with the site of the rows that start with them.

    ``rows`` are those of ``med``, where the caller has written them.
    """
    index = idx(spark, d)
    rows = (med(spark, d) if rows is None else rows).select("o_custkey", "start", "class")
    at_index = equi_join(rows, index.select("o_custkey", "t0"), {"o_custkey": "o_custkey", "start": "t0"})
    sites = at_index.groupBy("o_custkey").agg(F.min("class").alias("site"))
    return equi_join(index, sites, "o_custkey", "left")


def surv(spark: SparkSession, d: str) -> DataFrame:
    """First F order strictly after the index order, else the last order."""
    orders = equi_join(ord_n(spark, d), idx(spark, d).select("o_custkey", "t0"), "o_custkey")
    later = (F.col("o_orderstatus") == "F") & (F.col("day") > F.col("t0"))
    per = orders.groupBy("o_custkey").agg(
        F.min("t0").alias("t0"),
        F.max("day").alias("last_day"),
        F.min(F.when(later, F.col("day"))).alias("first_f"),
    )
    customer = read_table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return equi_join(customer, per, {"c_custkey": "o_custkey"}).select(
        "c_custkey",
        "c_mktsegment",
        "c_acctbal",
        (F.coalesce("first_f", "last_day") - F.col("t0")).alias("time"),
        F.when(F.col("first_f").isNull(), 0).otherwise(1).alias("event"),
    )


def lines(spark: SparkSession, d: str) -> DataFrame:
    text = recode(
        [(F.col("line") == n, t) for n, t in LINE_TEXTS.items()], default="Unknown/Not Applicable"
    )
    return med(spark, d).withColumn("line_txt", text)


def index_orders(spark: SparkSession, d: str) -> DataFrame:
    """First urgent order of each customer, whole row."""
    return index_event(
        ord_n(spark, d), "o_custkey", "nday", F.col("o_orderpriority") == "1-URGENT", ["o_orderkey"]
    )
