"""Per-key event operators: first rows, flags, index events, event-or-censor."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from kohorta.functions.exprs import group_min_strict
from kohorta.operators.keys import as_list, attach, equi_join, keyed_join, sort_columns
from kohorta.operators.ordered import event_sequence


def first_rows(df: DataFrame, keys, order_by, k: int = 1, number: str | None = None) -> DataFrame:
    """First ``k`` rows per key. Each task drops the others before the shuffle."""
    name = number or "__n"
    w = Window.partitionBy(*as_list(keys)).orderBy(*sort_columns(order_by))
    out = df.withColumn(name, F.row_number().over(w).cast("int")).filter(F.col(name) <= k)
    return out if number else out.drop(name)


def keep_first(df: DataFrame, keys, order_by) -> DataFrame:
    """One row per key: the first in the given order, with all its columns."""
    return first_rows(df, keys, order_by)


def group_count(df: DataFrame, keys, name: str = "n") -> DataFrame:
    """Number of rows of the group, on every row."""
    return attach(df, keys, {name: F.count(F.lit(1))})


def group_min(df: DataFrame, keys, columns, name: str, strict: bool = True) -> DataFrame:
    """Smallest value of the group, on every row; ``strict`` lets a missing one win."""
    columns = as_list(columns)
    value = group_min_strict(*columns) if strict else F.least(*[F.min(c) for c in columns], F.lit(None))
    return attach(df, keys, {name: value})


def group_min_where(df: DataFrame, keys, column: str, flag: Column, name: str) -> DataFrame:
    """Strict minimum over the flagged rows of the group, shown on those rows only."""
    out = attach(df, keys, {name: group_min_strict(column)}, where=flag)
    return out.withColumn(name, F.when(flag, F.col(name)))


def ever(
    df: DataFrame, keys, condition: Column, name: str, yes: str = "Yes", no: str | None = None
) -> DataFrame:
    """Flag all rows of a key that meets the condition on any row."""
    return ever_flags(df, keys, {name: condition}, yes, no)


def ever_flags(
    df: DataFrame, keys, conditions: Mapping[str, Column], yes: str = "Yes", no: str | None = None
) -> DataFrame:
    """Several ``ever`` flags from one aggregate."""
    keys = as_list(keys)
    any_hit = reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions.values()])
    flagged = attach(df, keys, {n: F.bool_or(c) for n, c in conditions.items()}, where=any_hit)
    return flagged.withColumns(
        {n: F.when(F.col(n), F.lit(yes)).otherwise(F.lit(no)) for n in conditions}
    )


def first_in_group(df: DataFrame, keys, order_by, columns: Mapping[str, str]) -> DataFrame:
    """Value of the group's first row, missing or not: ``{new column: source}``."""
    keys = as_list(keys)
    first = keep_first(df, keys, order_by).select(
        *keys, *[F.col(c).alias(n) for n, c in columns.items()]
    )
    return keyed_join(df, first, keys, "left", na_matches=True)


def last_non_null(df: DataFrame, keys, order_by, column: str, name: str) -> DataFrame:
    """Latest known value of the group, on every row."""
    keys = as_list(keys)
    known = df.filter(F.col(column).isNotNull())
    w = Window.partitionBy(*keys).orderBy(*sort_columns(order_by, backwards=True))
    last = (
        known.withColumn("__n", F.row_number().over(w))
        .filter(F.col("__n") == 1)
        .select(*keys, F.col(column).alias(name))
    )
    return keyed_join(df, last, keys, "left", na_matches=True)


def fallback_first_row(
    df: DataFrame, keys, order_by, wanted: Column, fallback: Column, k: int = 1
) -> DataFrame:
    """All wanted rows; for keys with none, the first ``k`` fallback rows."""
    keys = as_list(keys)
    have = df.filter(wanted).select(*keys).distinct()
    others = keyed_join(df.filter(fallback), have, keys, "left_anti", na_matches=True)
    return df.filter(wanted).unionByName(first_rows(others, keys, order_by, k))


def event_or_censor(
    df: DataFrame,
    key,
    event: str,
    time: str,
    censor_from_unknown: bool = True,
    event_name: str = "event",
    time_name: str = "time",
    carry: Sequence[str] = (),
    order_by: Sequence[str] = (),
) -> DataFrame:
    """One row per key: earliest time of an event, else the last known time.

    ``event`` is 1, 0 or null (unknown). With ``censor_from_unknown`` a known time
    on an unknown row is the censoring time, as such rows sort after the 0 rows.
    ``carry`` takes further columns from the row that decides, ``order_by``
    breaking ties.
    """
    key = as_list(key)
    e, t = F.col(event), F.col(time)
    censored = F.max(F.when(e == 0, t))
    if censor_from_unknown:
        censored = F.coalesce(F.max(F.when(e.isNull(), t)), censored)
    picked = df.groupBy(*key).agg(
        F.max(e).alias(event_name),
        F.when(F.max(e) == 1, F.min(F.when(e == 1, t)))
        .when(F.max(e) == 0, censored)
        .alias(time_name),
    )
    if not carry:
        return picked
    decisive = keep_first(df, key, [f"-{event}", time, *order_by]).select(*key, *carry)
    return equi_join(picked, decisive, key, "left", na_matches=True)


def index_event(df: DataFrame, key, time: str, qualifies: Column, order_by=()) -> DataFrame:
    """First qualifying event with a known time, one row per key.

    Keys without one are dropped.
    """
    candidates = df.filter(qualifies & F.col(time).isNotNull())
    return keep_first(candidates, as_list(key), [time, *as_list(order_by)])


def index_event_with_history(
    df: DataFrame,
    key: str,
    time: str,
    qualifies: Column,
    order_by,
    describe: Column,
    before: str = "pre_info",
    after: str = "post_info",
    sep: str = "; ",
) -> DataFrame:
    """Index event plus text of the key's other events before / from its time on."""
    from kohorta.operators.collapse import collapse

    order = [time, *as_list(order_by)]
    index = index_event(df, key, time, qualifies, order_by)
    t0 = index.select(key, F.col(time).alias("__t0"))
    others = keyed_join(df, t0, key, "inner").filter(
        ~F.coalesce(qualifies & (F.col(time) == F.col("__t0")), F.lit(False))
    )
    texts = others.withColumns(
        {
            before: F.when(F.col(time) < F.col("__t0"), describe),
            after: F.when(F.col(time) >= F.col("__t0"), describe),
        }
    )
    history = collapse(texts, key, [before, after], order, sep, nulls="skip")
    return equi_join(index, history, key, "left")


def latest_across(frames: Sequence[tuple[DataFrame, str]], key: str, name: str) -> DataFrame:
    """Latest time of each key over several tables (null if none is known)."""
    parts = [df.select(key, F.col(time).alias(name)) for df, time in frames]
    stacked = reduce(lambda a, b: a.unionByName(b), parts)
    return stacked.groupBy(key).agg(F.max(name).alias(name))


__all__ = [
    "event_or_censor",
    "event_sequence",
    "ever",
    "ever_flags",
    "fallback_first_row",
    "first_in_group",
    "first_rows",
    "group_count",
    "group_min",
    "group_min_where",
    "index_event",
    "index_event_with_history",
    "keep_first",
    "last_non_null",
    "latest_across",
]
