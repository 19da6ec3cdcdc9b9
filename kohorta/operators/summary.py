"""Descriptive tables: counts per level, exact quantiles, by stratum and overall.

Raw rows are first reduced to counts per distinct value; everything else works
on those counts, so no stratum is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from kohorta.operators.ordered import running_totals
from kohorta.session import durable, settled

OVERALL = "Overall"
KEYS = ["is_total", "stratum", "variable"]


def frequency(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Rows per value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def frequency_ordered(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Values from the most to the least frequent."""
    return frequency(df, column, name).orderBy(
        F.col(name).desc(), F.col(column).asc_nulls_last()
    )


def with_stratum(df: DataFrame, by: str | None) -> DataFrame:
    """Rows without a stratum are left out of a table by stratum, and of its total."""
    return df if by is None else df.filter(F.col(by).isNotNull())


def _long(df: DataFrame, columns: Sequence[str], by: str | None, kind: str) -> DataFrame:
    # Fixed-length list instead of a join: one pass, the stratum on every row.
    stratum = F.col(by).cast("string") if by else F.lit(OVERALL)
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("variable"), F.col(c).cast(kind).alias("value"))
            for c in columns
        ]
    )
    return (
        with_stratum(df, by)
        .select(
            F.lit(by is None).alias("is_total"), stratum.alias("stratum"), F.explode(cells).alias("cell")
        )
        .select("is_total", "stratum", "cell.variable", "cell.value")
    )


def value_counts(
    df: DataFrame,
    columns: Sequence[str],
    by: str | None = None,
    overall: bool = False,
    kind: str = "string",
) -> DataFrame:
    """(is_total, stratum, variable, value, n), totals summed from the strata.

    ``is_total`` tells the total from a stratum that has its name.
    """
    counts = (
        _long(df, columns, by, kind)
        .groupBy(*KEYS, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if by and overall:
        # Every count also adds to the overall table; one more small shuffle.
        both = F.explode(
            F.array(
                F.struct("is_total", "stratum"),
                F.struct(F.lit(True).alias("is_total"), F.lit(OVERALL).alias("stratum")),
            )
        )
        counts = (
            counts.withColumn("both", both)
            .groupBy("both.is_total", "both.stratum", "variable", "value")
            .agg(F.sum("n").alias("n"))
        )
    return counts


def summary_categorical(
    df: DataFrame, columns: Sequence[str], by: str | None = None, overall: bool = False
) -> DataFrame:
    """n and percent of the known values per level, plus the number missing.

    Rows without a stratum are left out. The total has ``is_total``.
    """
    counts = durable(value_counts(df, columns, by, overall))
    known = F.col("value").isNotNull()
    base = counts.groupBy(*KEYS).agg(
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("n_known"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("n_missing"),
    )
    levels = counts.filter(known).withColumnRenamed("value", "level")
    return base.join(levels, KEYS, "left").select(
        *KEYS,
        "level",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        (F.col("n") * 100.0 / F.col("n_known")).alias("percent"),
        "n_known",
        "n_missing",
    )


def by_frequency(table: DataFrame) -> DataFrame:
    """Summary rows, the total first, then the strata and levels by frequency.

    The rank of a stratum is the most rows it has of any variable.
    """
    rows = F.max(F.col("n_known") + F.col("n_missing"))
    sizes = table.groupBy("is_total", "stratum").agg(rows.alias("__rows"))
    return (
        table.join(sizes, ["is_total", "stratum"])
        .orderBy(
            F.col("is_total").desc(), F.col("__rows").desc(), "stratum", "variable",
            F.col("n").desc_nulls_last(), F.col("level").asc_nulls_last(),
        )
        .drop("__rows")
    )


def quantiles(
    counts: DataFrame, keys: Sequence[str], value: str, n: str, probs: Sequence[float]
) -> DataFrame:
    """Exact quantiles (linear interpolation) from a table of value counts.

    Columns ``q_0 .. q_k`` follow ``probs``.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("quantiles needs at least one key column")
    known = counts.filter(F.col(value).isNotNull())
    ranked = running_totals(known, keys, [value], {"__upto": n})
    totals = known.groupBy(*keys).agg(F.sum(n).alias("__total"))
    ranked = ranked.join(totals, keys)

    def place(p: float) -> Column:
        return (F.col("__total") - 1) * F.lit(float(p))

    def at(position: Column) -> Column:
        return F.min(F.when(F.col("__upto") > position, F.col(value)))

    lows = ranked.groupBy(*keys).agg(
        F.max("__total").alias("__total"),
        *[at(F.floor(place(p))).alias(f"__low_{i}") for i, p in enumerate(probs)],
        *[at(F.ceil(place(p))).alias(f"__high_{i}") for i, p in enumerate(probs)],
    )

    def between(i: int, p: float) -> Column:
        low, high = F.col(f"__low_{i}"), F.col(f"__high_{i}")
        return low + (high - low) * (place(p) - F.floor(place(p)))

    return lows.select(*keys, *[between(i, p).alias(f"q_{i}") for i, p in enumerate(probs)])


# Rank error of the sketches that bracket a quantile, as a share of the rows.
SKETCH_ACCURACY = 10_000


def exact_quantiles(rows: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """The same as ``quantiles``, from the rows, without shuffling their values.

    A sketch per group, combined in the tasks, gives two values between which each
    quantile must lie. Then one pass counts the rows below, and shuffles the counts
    of the few values in between alone, so what is shuffled follows the accuracy of
    the sketch and the number of groups. A group whose bracket should not hold its
    quantile is ranked as a whole.
    """
    keys, k = list(keys), range(len(probs))
    known = rows.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("__v"))
    margin = 2.0 / SKETCH_ACCURACY
    shares = [s for p in probs for s in (max(0.0, p - margin), min(1.0, p + margin))]
    marks = F.percentile_approx("__v", shares, SKETCH_ACCURACY)
    brackets = known.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__total"), F.min("__v").alias("__min"), F.max("__v").alias("__max"), marks.alias("__marks")
    )
    low = [F.col("__min") if p - margin <= 0 else F.get("__marks", F.lit(2 * i)) for i, p in enumerate(probs)]
    high = [F.col("__max") if p + margin >= 1 else F.get("__marks", F.lit(2 * i + 1)) for i, p in enumerate(probs)]
    brackets = durable(
        brackets.select(
            *keys, "__total", *[c.alias(f"__l{i}") for i, c in enumerate(low)], *[c.alias(f"__h{i}") for i, c in enumerate(high)]
        )
    )
    inside = [F.col("__v").between(F.col(f"__l{i}"), F.col(f"__h{i}")) for i in k]
    near = reduce(lambda a, b: a | b, inside)
    cells = known.join(brackets, keys).groupBy(*keys, F.when(near, F.col("__v")).alias("__value")).agg(
        F.count(F.lit(1)).alias("__n"), *[F.sum((F.col("__v") < F.col(f"__l{i}")).cast("bigint")).alias(f"__b{i}") for i in k]
    )
    cells = durable(cells)
    # How far the ranks among the shuffled values are from the ranks among all.
    offsets = cells.join(brackets, keys).groupBy(*keys).agg(
        *[
            (F.sum(f"__b{i}") - F.coalesce(F.sum(F.when(F.col("__value") < F.col(f"__l{i}"), F.col("__n"))), F.lit(0))).alias(f"__o{i}")
            for i in k
        ]
    )
    ranked = running_totals(cells.filter(F.col("__value").isNotNull()), keys, ["__value"], {"__upto": "__n"})
    ranked = ranked.join(brackets.join(offsets, keys), keys)

    def place(p: float) -> Column:
        return (F.col("__total") - 1) * F.lit(float(p))

    def at(i: int, position: Column) -> Column:
        here = F.col("__value").between(F.col(f"__l{i}"), F.col(f"__h{i}"))
        return F.min(F.when(here & (F.col("__upto") + F.col(f"__o{i}") > position), F.col("__value")))

    found = ranked.groupBy(*keys).agg(
        F.max("__total").alias("__total"),
        *[at(i, F.floor(place(p))).alias(f"__low_{i}") for i, p in enumerate(probs)],
        *[at(i, F.ceil(place(p))).alias(f"__high_{i}") for i, p in enumerate(probs)],
        # Nothing of the rank looked for may lie below the bracket.
        F.bool_and(reduce(lambda a, b: a & b, [F.col(f"__o{i}") <= F.floor(place(p)) for i, p in enumerate(probs)])).alias("__held"),
    )
    found = durable(found)
    held = F.col("__held") & reduce(lambda a, b: a & b, [F.col(f"__high_{i}").isNotNull() for i in k])

    def between(i: int, p: float) -> Column:
        a, b = F.col(f"__low_{i}"), F.col(f"__high_{i}")
        return a + (b - a) * (place(p) - F.floor(place(p)))

    out = found.filter(held).select(*keys, *[between(i, p).alias(f"q_{i}") for i, p in enumerate(probs)])
    lost = found.filter(~held).select(*keys)
    if lost.isEmpty():
        return out
    whole = known.join(lost, keys, "left_semi").groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__n"))
    return out.unionByName(quantiles(whole, keys, "__v", "__n", probs))


def summary_continuous(
    df: DataFrame, columns: Sequence[str], by: str | None = None, overall: bool = False
) -> DataFrame:
    """Known and missing rows, median and quartiles per variable (and stratum).

    Rows without a stratum are left out. The total has ``is_total``.
    """
    rows = _long(df, columns, by, "double")
    if by and overall:
        # Every row also counts for the total; nothing is shuffled for it.
        both = F.array(
            F.struct("is_total", "stratum"), F.struct(F.lit(True).alias("is_total"), F.lit(OVERALL).alias("stratum"))
        )
        rows = rows.select(F.explode(both).alias("both"), "variable", "value").select("both.*", "variable", "value")
    rows = settled(rows)
    known = F.col("value").isNotNull()
    base = rows.groupBy(*KEYS).agg(
        F.sum(known.cast("bigint")).alias("n_known"), F.sum((~known).cast("bigint")).alias("n_missing")
    )
    q = exact_quantiles(rows, KEYS, "value", [0.25, 0.5, 0.75])
    return base.join(q, KEYS, "left").select(
        *KEYS,
        "n_known",
        "n_missing",
        F.col("q_1").alias("median"),
        F.col("q_0").alias("q1"),
        F.col("q_2").alias("q3"),
    )


def events_per_level(df: DataFrame, level: str, event: str) -> DataFrame:
    """Rows and events per level of a covariate."""
    return df.groupBy(level).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(event).cast("bigint")).alias("n_event")
    )


def discrepancy(df: DataFrame, left: str, right: str, null_differs: bool = True) -> DataFrame:
    """Rows where two sources of one attribute disagree.

    ``null_differs`` counts a missing value as a disagreement, even on both sides.
    """
    a, b = F.col(left), F.col(right)
    return df.filter(F.coalesce(a != b, F.lit(True)) if null_differs else ~a.eqNullSafe(b))
