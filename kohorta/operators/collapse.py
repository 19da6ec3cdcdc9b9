"""Ordered text collapse of a group's values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kohorta.functions.exprs import fmt_num
from kohorta.operators.keys import as_list, keyed_join, order_names, split_by
from kohorta.operators.ordered import event_sequence
from kohorta.session import large_groups, rows_per_task

_RULES = ("strict", "skip", "text")


def collapse(
    df: DataFrame, keys, columns, order_by, sep: str = "; ", nulls: str = "strict"
) -> DataFrame:
    """One row per key with each column's values joined in order.

    Missing values make the result missing ("strict"), are left out ("skip",
    missing when nothing is left) or are written as "NA" ("text").

    Groups beyond one task's share are joined piecewise: runs of consecutive
    rows become texts in their own tasks, and only those texts meet. The
    result itself is one cell, so it must stay below Spark's 2 GB cell size.
    """
    if nulls not in _RULES:
        raise ValueError(f"nulls must be one of {_RULES}")
    keys, columns, order = as_list(keys), as_list(columns), order_names(order_by)
    if any(o.startswith("-") for o in as_list(order_by)):
        raise ValueError("collapse sorts upwards only")
    large = large_groups(df, keys)
    if large is None:
        return _one_level(df, keys, columns, order, sep, nulls)
    small_part, large_part = split_by(df, large, keys)
    return _one_level(small_part, keys, columns, order, sep, nulls).unionByName(
        _two_level(large_part, keys, columns, order, sep, nulls)
    )


def _as_text(df: DataFrame, column: str) -> Column:
    real = dict(df.dtypes)[column] in ("double", "float")
    return fmt_num(column) if real else F.col(column).cast("string")


def _join(values: Column, complete: Column, sep: str, nulls: str) -> Column:
    if nulls == "text":
        return F.array_join(values, sep, "NA")
    text = F.array_join(values, sep)
    if nulls == "strict":
        return F.when(complete, text)
    return F.when(F.exists(values, lambda v: v.isNotNull()), text)


def _lists(df, keys, columns, order) -> DataFrame:
    # A missing order value sorts last: its flag comes before the value. All
    # columns share one list, so a group is shuffled and sorted once.
    place = [p for o in order for p in (F.col(o).isNull().alias(f"n_{o}"), F.col(o).alias(f"o_{o}"))]
    texts = [_as_text(df, c).alias(f"v_{i}") for i, c in enumerate(columns)]
    return df.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(*place, *texts))).alias("__rows"),
        *[(F.count(c) == F.count(F.lit(1))).alias(f"__all_{i}") for i, c in enumerate(columns)],
    )


def _one_level(df, keys, columns, order, sep, nulls) -> DataFrame:
    return _lists(df, keys, columns, order).select(
        *keys,
        *[
            _join(F.col(f"__rows.v_{i}"), F.col(f"__all_{i}"), sep, nulls).alias(c)
            for i, c in enumerate(columns)
        ],
    )


def _two_level(df, keys, columns, order, sep, nulls) -> DataFrame:
    run = max(1, rows_per_task(df.sparkSession))
    numbered = event_sequence(df, keys, order, "__n").withColumn(
        "__run", F.floor((F.col("__n") - 1) / F.lit(run))
    )
    runs = _one_level(numbered, [*keys, "__run"], columns, ["__n"], sep, nulls)
    return _one_level(runs, keys, columns, ["__run"], sep, nulls)


def collapse_to_rows(
    df: DataFrame, keys, columns, order_by, sep: str = "; ", nulls: str = "skip"
) -> DataFrame:
    """Collapse and show the text on every row of the group."""
    keys, columns = as_list(keys), as_list(columns)
    texts = collapse(df, keys, columns, order_by, sep, nulls)
    return keyed_join(df.drop(*columns), texts, keys, "left", na_matches=True).select(*df.columns)


def collapse_two_level(
    df: DataFrame, keys, inner: str, columns, order_by, sep: str = "; "
) -> DataFrame:
    """Collapse per (keys, inner), then over ``inner``, which is collapsed too.

    The inner groups are taken in the order of ``inner``, missing last. With one
    separator both steps give the text of one collapse ordered by inner first,
    so ordinary groups need a single aggregate.
    """
    keys, columns, order = as_list(keys), as_list(columns), order_names(order_by)
    large = large_groups(df, keys)
    if large is None:
        return _two_level_at_once(df, keys, inner, columns, order, sep)
    small_part, large_part = split_by(df, large, keys)
    first = collapse(large_part, [*keys, inner], columns, order_by, sep)
    heavy = collapse(first, keys, [*columns, inner], [inner], sep)
    return _two_level_at_once(small_part, keys, inner, columns, order, sep).unionByName(heavy)


def _two_level_at_once(df, keys, inner, columns, order, sep) -> DataFrame:
    lists = _lists(df, keys, [*columns, inner], [inner, *order])
    inner_values = F.array_distinct(F.col(f"__rows.v_{len(columns)}"))
    return lists.select(
        *keys,
        *[
            _join(F.col(f"__rows.v_{i}"), F.col(f"__all_{i}"), sep, "strict").alias(c)
            for i, c in enumerate(columns)
        ],
        _join(inner_values, F.col(f"__all_{len(columns)}"), sep, "strict").alias(inner),
    )
