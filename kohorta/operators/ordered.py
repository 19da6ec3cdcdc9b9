"""Running values along an order within each group, for groups of any size.

A group that fits one task is one window. A larger one is cut into slices by a
range shuffle on (key, order): each slice is its own window, a small table holds
one summary row per slice, and what earlier slices pass on is joined back.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from kohorta.operators.keys import as_list, equi_join, keyed_join, order_names, sort_columns, split_by
from kohorta.session import durable, fits_one_task, large_groups, rows_per_task, settled

SLICE = "__slice"
ROW = "__row"


@dataclass(frozen=True)
class Sequence_:
    """Row number from 1."""

    backwards = False

    def local(self, w: WindowSpec) -> Column:
        return F.row_number().over(w).cast("bigint")

    def summary(self) -> Column:
        return F.count(F.lit(1))

    def carry(self, part: Column, w: WindowSpec) -> Column:
        return F.sum(part).over(w)

    def combine(self, local: Column, carry: Column) -> Column:
        return local + F.coalesce(carry, F.lit(0))


@dataclass(frozen=True)
class RunningSum:
    """Sum of a column from the group's first row to this one."""

    column: str
    backwards: bool = False

    def local(self, w: WindowSpec) -> Column:
        return F.sum(self.column).over(w.rowsBetween(Window.unboundedPreceding, 0))

    def summary(self) -> Column:
        return F.sum(self.column)

    def carry(self, part: Column, w: WindowSpec) -> Column:
        return F.sum(part).over(w)

    def combine(self, local: Column, carry: Column) -> Column:
        return F.coalesce(local + carry, local, carry)


@dataclass(frozen=True)
class LastKnown:
    """Latest non-missing value of a column at or before this row.

    Read backwards it is the next non-missing value at or after the row.
    """

    column: str
    backwards: bool = False

    def local(self, w: WindowSpec) -> Column:
        return F.last(self.column, ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, 0)
        )

    def summary(self) -> Column:
        known = F.when(F.col(self.column).isNotNull(), F.col(ROW))
        pick = F.min_by if self.backwards else F.max_by
        return pick(F.col(self.column), known)

    def carry(self, part: Column, w: WindowSpec) -> Column:
        return F.last(part, ignorenulls=True).over(w)

    def combine(self, local: Column, carry: Column) -> Column:
        return F.coalesce(local, carry)


def scan(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: str | Sequence[str],
    ops: Mapping[str, object],
) -> DataFrame:
    """Add one running value per entry of ``ops`` to every row.

    ``order_by`` must be a total order within each group where ops depend on
    single rows. Without keys the whole table is one group.
    """
    keys = as_list(keys)
    if not keys:
        df = settled(df)
        if fits_one_task(df):
            return _whole(df, keys, order_by, ops)
        return _sliced(df, keys, order_by, ops, df.count())
    large = large_groups(df, keys)
    if large is None:
        return _whole(df, keys, order_by, ops)
    total = large.agg(F.sum("n")).first()[0]
    small_part, large_part = split_by(df, large, keys)
    return _whole(small_part, keys, order_by, ops).unionByName(
        _sliced(large_part, keys, order_by, ops, total)
    )


def _windows(groups: list[str], order_by) -> tuple[WindowSpec, WindowSpec]:
    base = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    return (
        base.orderBy(*sort_columns(order_by)),
        base.orderBy(*sort_columns(order_by, backwards=True)),
    )


def _whole(df: DataFrame, keys: list[str], order_by, ops) -> DataFrame:
    ahead, behind = _windows(keys, order_by)
    return df.withColumns({n: op.local(behind if op.backwards else ahead) for n, op in ops.items()})


def _sliced(df: DataFrame, keys: list[str], order_by, ops, rows: int) -> DataFrame:
    slices = max(2, math.ceil(rows / rows_per_task(df.sparkSession)))
    spread = df.repartitionByRange(
        slices, *[F.col(k).asc_nulls_last() for k in keys], *sort_columns(order_by)
    ).withColumn(SLICE, F.spark_partition_id())
    ahead, behind = _windows([*keys, SLICE], order_by)
    local = spread.withColumns(
        {n: op.local(behind if op.backwards else ahead) for n, op in ops.items()}
        | {ROW: F.row_number().over(ahead)}
    )
    # Slice numbers come from a sampled range shuffle: fix them before reading twice.
    local = durable(local)
    parts = local.groupBy(*keys, SLICE).agg(
        *[op.summary().alias(f"__part_{i}") for i, op in enumerate(ops.values())]
    )
    by_key = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = by_key.orderBy(F.col(SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    after = by_key.orderBy(F.col(SLICE).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carries = parts.select(
        *keys,
        SLICE,
        *[
            op.carry(F.col(f"__part_{i}"), after if op.backwards else before).alias(f"__carry_{i}")
            for i, op in enumerate(ops.values())
        ],
    )
    joined = equi_join(local, carries, [*keys, SLICE], "left", na_matches=True)
    joined = joined.withColumns(
        {n: op.combine(F.col(n), F.col(f"__carry_{i}")) for i, (n, op) in enumerate(ops.items())}
    )
    return joined.select(*df.columns, *ops)


def event_sequence(df: DataFrame, keys, order_by, name: str = "sequence") -> DataFrame:
    """Number the rows of each group from 1 in the given order."""
    return scan(df, keys, order_by, {name: Sequence_()})


def running_totals(df: DataFrame, keys, order_by, columns: Mapping[str, str]) -> DataFrame:
    """Inclusive running sums: ``{new column: summed column}``."""
    return scan(df, keys, order_by, {n: RunningSum(c) for n, c in columns.items()})


def fill(df: DataFrame, columns, keys, order_by, direction: str = "updown") -> DataFrame:
    """Replace missing values by the nearest known one of the group.

    "down" looks at earlier rows, "up" at later rows, "updown" at later rows
    first and earlier rows where there is none, "downup" the other way round.
    """
    columns = as_list(columns)
    ways = {"up": ["up"], "down": ["down"], "updown": ["up", "down"], "downup": ["down", "up"]}[
        direction
    ]
    ops = {
        f"__{way}_{c}": LastKnown(c, backwards=way == "up") for c in columns for way in ways
    }
    filled = scan(df, keys, order_by, ops)
    return filled.withColumns(
        {c: F.coalesce(*[F.col(f"__{way}_{c}") for way in ways]) for c in columns}
    ).drop(*ops)


def dense_rank_valid(
    df: DataFrame, keys, order_by, name: str = "rank", fallback: str | None = None
) -> DataFrame:
    """Dense rank of the order columns; rows with a missing one get no rank.

    ``fallback`` names a column whose value stands in where there is no rank.
    """
    keys, columns = as_list(keys), order_names(order_by)
    valid = F.lit(True)
    for c in columns:
        valid = valid & F.col(c).isNotNull()
    if large_groups(df, keys) is None:
        w = Window.partitionBy(*keys, "__valid").orderBy(*sort_columns(order_by))
        ranked = df.withColumn("__valid", valid).withColumn(
            name, F.when(F.col("__valid"), F.dense_rank().over(w).cast("bigint"))
        ).drop("__valid")
    else:
        # Number the distinct values instead of the rows, then look them up.
        values = settled(df.filter(valid).select(*keys, *columns).distinct())
        numbered = event_sequence(values, keys, order_by, name)
        ranked = keyed_join(df, numbered, [*keys, *columns], "left", na_matches=True)
    if fallback is None:
        return ranked
    return ranked.withColumn(name, F.coalesce(F.col(name), F.col(fallback).cast("bigint")))
