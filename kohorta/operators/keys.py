"""Key helpers shared by the operators: sort order and null-safe equi-joins."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from kohorta.session import large_groups, rows_per_task

Keys = Sequence[str]
On = Sequence[str] | Mapping[str, str]


def as_list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def order_names(order_by: str | Sequence[str]) -> list[str]:
    return [o.lstrip("-") for o in as_list(order_by)]


def sort_columns(order_by: str | Sequence[str], backwards: bool = False) -> list[Column]:
    """Sort keys with missing values last; a leading "-" sorts downwards.

    ``backwards`` gives the exact reverse of that order.
    """
    out = []
    for item in as_list(order_by):
        col = F.col(item.lstrip("-"))
        down = item.startswith("-")
        if backwards:
            out.append(col.asc_nulls_first() if down else col.desc_nulls_first())
        else:
            out.append(col.desc_nulls_last() if down else col.asc_nulls_last())
    return out


def pairs(on: str | On) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, Mapping):
        return list(on.items())
    return [(k, k) for k in on]


def equi_join(
    left: DataFrame,
    right: DataFrame,
    on: str | On,
    how: str = "inner",
    na_matches: bool = False,
) -> DataFrame:
    """Equi-join on equally or differently named keys; right keys are dropped.

    ``na_matches`` lets a missing key meet a missing key. Other columns that
    both sides have are an error, as the result could not name them.
    """
    keys = pairs(on)
    right_keys = [r for _, r in keys]
    if how not in ("left_semi", "left_anti"):
        clash = (set(left.columns) & set(right.columns)) - set(right_keys)
        clash |= {r for l, r in keys if r in left.columns and r != l}
        if clash:
            raise ValueError(f"columns on both sides of the join: {sorted(clash)}")
    renamed = right.withColumnsRenamed({r: f"__right_{i}" for i, r in enumerate(right_keys)})
    tests = []
    for i, (l, _) in enumerate(keys):
        a, b = left[l], renamed[f"__right_{i}"]
        tests.append(a.eqNullSafe(b) if na_matches else a == b)
    joined = left.join(renamed, reduce(lambda x, y: x & y, tests), how)
    if how in ("left_semi", "left_anti"):
        return joined
    if how in ("full", "full_outer", "outer", "right"):
        joined = joined.withColumns(
            {l: F.coalesce(F.col(l), F.col(f"__right_{i}")) for i, (l, _) in enumerate(keys)}
        )
    return joined.drop(*[f"__right_{i}" for i in range(len(keys))])


def split_by(
    df: DataFrame, large: DataFrame, keys: Keys
) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary keys and rows of the listed large keys.

    The list is broadcast: ``large_groups`` bounds it to rows / rows per task.
    """
    names = F.broadcast(large.select(*keys))
    return (
        equi_join(df, names, keys, "left_anti", na_matches=True),
        equi_join(df, names, keys, "left_semi", na_matches=True),
    )


def keyed_join(
    rows: DataFrame,
    keyed: DataFrame,
    on: str | On,
    how: str = "left",
    na_matches: bool = False,
) -> DataFrame:
    """Join many rows per key to a table with few rows per key, at any skew.

    Rows of ordinary keys are shuffled by key. Keys with more rows than one task
    should take are few, so their share of ``keyed`` is small: it is counted,
    and broadcast to the rows where they are.
    """
    left = [l for l, _ in pairs(on)]
    right = [r for _, r in pairs(on)]
    large = large_groups(rows, left)
    if large is None:
        return equi_join(rows, keyed, on, how, na_matches)
    names = large.select(*[F.col(l).alias(r) for l, r in zip(left, right)])
    theirs = equi_join(keyed, F.broadcast(names), right, "left_semi", na_matches=True)
    if theirs.count() > rows_per_task(rows.sparkSession):
        return equi_join(rows, keyed, on, how, na_matches)
    ordinary, heavy = split_by(rows, large, left)
    return equi_join(ordinary, keyed, on, how, na_matches).unionByName(
        equi_join(heavy, F.broadcast(theirs), on, how, na_matches)
    )


def attach(
    df: DataFrame,
    keys: str | Keys,
    aggregates: Mapping[str, Column | Callable[..., Column]],
    where: Column | None = None,
    na_matches: bool = True,
) -> DataFrame:
    """Add group aggregates to every row.

    The aggregate is combined map-side and joined back, so one very large group
    is never gathered in one task. Aggregates given as functions that take a window
    (``over``) are read off it where every group fits a task: the rows, if they are
    costly to come by, are made once.
    """
    keys = as_list(keys)
    functions = all(not isinstance(c, Column) for c in aggregates.values())
    if functions and where is None and large_groups(df, keys) is None:
        known = F.lit(True) if na_matches else reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        w = Window.partitionBy(*keys)
        kept = df.drop(*aggregates)
        return kept.select("*", *[F.when(known, c(over=w)).alias(n) for n, c in aggregates.items()])
    source = df if where is None else df.filter(where)
    made = {n: c if isinstance(c, Column) else c() for n, c in aggregates.items()}
    totals = source.groupBy(*keys).agg(*[c.alias(n) for n, c in made.items()])
    kept = df.drop(*aggregates)
    return keyed_join(kept, totals, keys, "left", na_matches)
