"""Tests of association between a variable and a stratum.

Spark reduces the data to contingency or value counts; p-values are then
computed from a few aggregated numbers.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from kohorta.functions import tails
from kohorta.operators.ordered import running_totals
from kohorta.operators.selectors import is_number
from kohorta.session import durable


# Exact tests are for 2 x 2 tables, those with few tables of the same margins, at any number of rows, and those
# that take the network at most this many entries; others get chi-square, named as such.
FISHER_TABLES = 200_000
FISHER_ENTRIES = 1_000_000
# Cells of a table that may be taken to the driver for it.
FISHER_CELLS = 100_000
# Samples below this size get the exact rank-sum test if no value is there twice.
EXACT_RANKS = 50


def contingency(df: DataFrame, row: str, col: str) -> DataFrame:
    """(row, col, n) of the rows where both are known."""
    both = df.filter(F.col(row).isNotNull() & F.col(col).isNotNull())
    return both.groupBy(row, col).agg(F.count(F.lit(1)).alias("n"))


def chi_square_statistic(df: DataFrame, row: str, col: str) -> DataFrame:
    """One row: statistic without continuity correction, df, n, least expected.

    Written as n * (sum of n_ij^2 / (r_i c_j)) - n, which needs no empty cells.
    """
    cells = durable(contingency(df, row, col))
    rows = cells.groupBy(row).agg(F.sum("n").alias("__r"))
    cols = cells.groupBy(col).agg(F.sum("n").alias("__c"))
    o, r, c = F.col("n").cast("double"), F.col("__r"), F.col("__c")
    sums = (
        cells.join(rows, row)
        .join(cols, col)
        .agg(
            F.sum("n").alias("n"),
            F.sum(o * o / (r.cast("double") * c)).alias("__s"),
            F.countDistinct(row).alias("__nr"),
            F.countDistinct(col).alias("__nc"),
            F.min(r).alias("__min_r"),
            F.min(c).alias("__min_c"),
        )
    )
    return sums.select(
        (F.col("n") * F.col("__s") - F.col("n")).alias("statistic"),
        ((F.col("__nr") - 1) * (F.col("__nc") - 1)).alias("df"),
        "n",
        (F.col("__min_r").cast("double") * F.col("__min_c") / F.col("n")).alias("least_expected"),
    )


def rank_sums(df: DataFrame, value: str, by: str) -> DataFrame:
    """Per stratum: rows and sum of mid-ranks; plus the tie term of all rows."""
    known = df.filter(F.col(value).isNotNull() & F.col(by).isNotNull())
    cells = known.groupBy(value, by).agg(F.count(F.lit(1)).alias("n"))
    values = cells.groupBy(value).agg(F.sum("n").alias("__ties"))
    ranked = running_totals(values, [], [value], {"__upto": "__ties"})
    midrank = F.col("__upto") - (F.col("__ties") - 1) / F.lit(2.0)
    t = F.col("__ties").cast("double")
    ranks = ranked.select(value, midrank.alias("__rank"), (t * t * t - t).alias("__tie"), t.alias("__t"))
    return (
        cells.join(ranks, value)
        .groupBy(F.col(by).alias("stratum"))
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.col("__rank")).alias("rank_sum"),
            # A tie block is spread over its strata in proportion to their rows.
            F.sum(F.col("__tie") * F.col("n") / F.col("__t")).alias("tie_part"),
        )
    )


def kruskal_statistic(df: DataFrame, value: str, by: str) -> DataFrame:
    """One row: Kruskal-Wallis statistic corrected for ties, df, n."""
    per = rank_sums(df, value, by)
    n = F.sum("n").cast("double")
    s = F.sum(F.col("rank_sum") * F.col("rank_sum") / F.col("n"))
    raw = F.lit(12.0) / (n * (n + 1)) * s - F.lit(3.0) * (n + 1)
    ties = F.lit(1.0) - F.sum("tie_part") / (n * n * n - n)
    return per.agg(
        (raw / ties).alias("statistic"),
        (F.count(F.lit(1)) - 1).alias("df"),
        F.sum("n").alias("n"),
    )


def compare(df: DataFrame, column: str, by: str) -> dict[str, object]:
    """Choose and run the test that suits the column type.

    Numbers: rank-sum for two strata (exact for two samples below ``EXACT_RANKS``
    without ties, else the normal approximation with continuity correction),
    Kruskal-Wallis for more. Labels: chi-square when every expected count is at
    least 5, else Fisher's exact test, unless the table is neither 2 x 2 nor of
    few possible tables (``FISHER_TABLES``) and its network has more than
    ``FISHER_ENTRIES`` entries: then chi-square, named as such.
    """
    if is_number(df, column):
        return _compare_numbers(df, column, by)
    return _compare_labels(df, column, by)


def _compare_numbers(df: DataFrame, column: str, by: str) -> dict[str, object]:
    per = sorted(rank_sums(df, column, by).collect(), key=lambda r: str(r["stratum"]))
    if len(per) < 2:
        return {"test": "none", "statistic": None, "df": None, "p_value": None}
    total = sum(r["n"] for r in per)
    ties = math.fsum(r["tie_part"] for r in per)
    if len(per) == 2:
        a, b = per[0]["n"], per[1]["n"]
        w = per[0]["rank_sum"] - a * (a + 1) / 2.0
        if max(a, b) < EXACT_RANKS and not ties:
            return {"test": "rank-sum", "statistic": w, "df": None, "p_value": tails.rank_sum_exact(w, a, b)}
        spread = math.sqrt(a * b / 12.0 * ((total + 1) - ties / (total * (total - 1.0))))
        shift = w - a * b / 2.0
        z = 0.0 if spread == 0 else (shift - math.copysign(0.5, shift) * (shift != 0)) / spread
        return {"test": "rank-sum", "statistic": w, "df": None, "p_value": tails.normal_two_sided(z)}
    s = math.fsum(r["rank_sum"] ** 2 / r["n"] for r in per)
    h = 12.0 / (total * (total + 1.0)) * s - 3.0 * (total + 1.0)
    correction = 1.0 - ties / (float(total) ** 3 - total)
    h = h / correction if correction else 0.0
    return {
        "test": "kruskal-wallis",
        "statistic": h,
        "df": len(per) - 1,
        "p_value": tails.chi_square(h, len(per) - 1),
    }


def _compare_labels(df: DataFrame, column: str, by: str) -> dict[str, object]:
    s = chi_square_statistic(df, column, by).first()
    if not s["df"]:
        return {"test": "none", "statistic": None, "df": None, "p_value": None}
    if s["least_expected"] < 5 and (p := _fisher(df, column, by, s)) is not None:
        return {"test": "fisher", "statistic": None, "df": None, "p_value": p}
    return _chi_square(s)


def _fisher(df: DataFrame, column: str, by: str, s) -> float | None:
    """Exact p-value, None where the table is too large for it."""
    if s["df"] >= FISHER_CELLS:
        return None
    cells = contingency(df, column, by).collect()
    rows = sorted({r[column] for r in cells})
    cols = sorted({r[by] for r in cells})
    n = {(r[column], r[by]): r["n"] for r in cells}
    table = [[n.get((r, c), 0) for c in cols] for r in rows]
    if s["df"] == 1:
        return tails.fisher_2x2(*table[0], *table[1])
    sides = sorted((tails.rare_tables(t), t) for t in (table, [list(c) for c in zip(*table)]))
    if sides[0][0] <= FISHER_TABLES:
        return tails.fisher_rare(sides[0][1])
    return tails.fisher_network(table, FISHER_ENTRIES)


def chi_square_test(df: DataFrame, column: str, by: str) -> dict[str, object]:
    """Chi-square test whatever the expected counts are."""
    s = chi_square_statistic(df, column, by).first()
    return _chi_square(s) if s["df"] else {"test": "none", "statistic": None, "df": None, "p_value": None}


def _chi_square(s) -> dict[str, object]:
    return {
        "test": "chi-square",
        "statistic": s["statistic"],
        "df": int(s["df"]),
        "p_value": tails.chi_square(s["statistic"], int(s["df"])),
    }
