"""Long to wide and back; columns come from the data or from a checked list."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from kohorta.operators.events import first_rows
from kohorta.operators.keys import as_list
from kohorta.operators.ordered import event_sequence


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Stack tables by column name; columns a table lacks become missing."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# Names of a pivot become columns; beyond this a table is no longer the right form.
MOST_COLUMNS = 10_000


def category_names(df: DataFrame, names: str) -> list[str]:
    """The distinct names of a column, sorted; they are about to become columns."""
    found = df.filter(F.col(names).isNotNull()).select(names).distinct().limit(MOST_COLUMNS + 1).collect()
    if len(found) > MOST_COLUMNS:
        raise ValueError(f"{names} has more than {MOST_COLUMNS} names; keep the long form")
    return sorted(r[0] for r in found)


def pivot_named(
    df: DataFrame,
    ids,
    names: str,
    values: Mapping[str, Column] | str,
    categories: Sequence[str] | None = None,
    template: str = "{name}_{value}",
    subset: bool = False,
) -> DataFrame:
    """One row per id; one column per category, or per category and value.

    ``values`` is a column (its smallest text is taken on repeated cells) or a
    mapping of value name to aggregate. Category columns come grouped together.
    Categories are taken from the data unless listed. A name that is missing from
    the list is an error, unless ``subset`` asks for the listed ones only. Rows
    without a name count for no column.
    """
    single = isinstance(values, str)
    aggregates = {values: F.min(values)} if single else dict(values)
    if categories is None:
        categories = category_names(df, names)
    elif not subset:
        known = F.col(names).isNull() | F.col(names).isin(list(categories))
        message = F.concat(F.lit(f"{names} has a value that is not listed: "), F.col(names).cast("string"))
        df = df.filter(F.assert_true(known, message).isNull())
    if not categories:
        return df.select(*as_list(ids)).distinct()
    wide = df.groupBy(*as_list(ids)).pivot(names, list(categories)).agg(
        *[a.alias(f"v{i}") for i, a in enumerate(aggregates.values())]
    )
    columns = []
    for category in categories:
        for i, value in enumerate(aggregates):
            source = f"{category}" if len(aggregates) == 1 else f"{category}_v{i}"
            target = f"{category}" if single else template.format(name=category, value=value)
            columns.append(F.col(f"`{source}`").alias(target))
    return wide.select(*as_list(ids), *columns)


def most_per_key(df: DataFrame, key) -> int:
    """Rows of the largest group; 0 for an empty table."""
    counts = df.groupBy(*as_list(key)).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0


def pivot_occurrence(
    df: DataFrame,
    key,
    values: Sequence[str],
    k: int | None,
    order_by,
    lhs: Sequence[str] = (),
    overflow: str = "error",
) -> DataFrame:
    """One row per (key, lhs) with ``{value}_1 .. {value}_k`` in event order.

    Occurrences are numbered per key alone. Without ``k`` the largest group gives
    it, by one count (at least 1). With ``k`` a key with more rows is an error;
    only ``overflow="drop"`` asks for the first k alone, and then only k rows per
    key leave each task. ``occurrences_long`` has no width at all.
    """
    key = as_list(key)
    if overflow not in ("drop", "error"):
        raise ValueError("overflow must be 'drop' or 'error'")
    if k is None:
        k = max(1, most_per_key(df, key))
    n = F.col("__n")
    take = k + 1 if overflow == "error" else k
    numbered = first_rows(df, key, order_by, take, "__n")
    # At most ``take`` rows per key are left: one small map instead of k tests per row.
    cells = F.map_from_entries(F.collect_list(F.struct(n, F.struct(*values))))
    wide = numbered.groupBy(*key, *lhs).agg(cells.alias("__cells"), F.max(n).alias("__n"))
    if overflow == "error":
        check = F.assert_true(n <= k, F.lit(f"a key has more than {k} rows"))
        wide = wide.filter(check.isNull())
    return wide.select(
        *key,
        *lhs,
        *[
            F.try_element_at("__cells", F.lit(i)).getField(v).alias(f"{v}_{i}")
            for v in values
            for i in range(1, k + 1)
        ],
    )


def occurrences_long(
    df: DataFrame, key, values: Sequence[str], order_by, lhs: Sequence[str] = (), name: str = "occurrence"
) -> DataFrame:
    """The long form of ``pivot_occurrence``: one row per event with its number.

    For keys with very many rows: no width, and no key is gathered in one cell.
    """
    numbered = event_sequence(df, key, order_by, name)
    return numbered.select(*as_list(key), *lhs, name, *values)


def pivot_pages(
    df: DataFrame, key, values: Sequence[str], width: int, order_by, lhs: Sequence[str] = (), page: str = "page"
) -> DataFrame:
    """``pivot_occurrence`` for any number of events: rows of ``width`` occurrences each.

    Page 0 has ``{value}_1 .. {value}_width`` of occurrences 1 to width, page 1 the
    next ones, and so on, so no key has a row that grows with its events, and a key
    with very many events is numbered in slices and grouped by page.
    """
    n = F.col("__n")
    numbered = event_sequence(df, key, order_by, "__n").select(
        *as_list(key), *lhs, *values, F.floor((n - 1) / width).cast("bigint").alias(page), ((n - 1) % width + 1).alias("__slot")
    )
    cells = F.map_from_entries(F.collect_list(F.struct("__slot", F.struct(*values))))
    wide = numbered.groupBy(*as_list(key), *lhs, page).agg(cells.alias("__cells"))
    return wide.select(
        *as_list(key), *lhs, page,
        *[
            F.try_element_at("__cells", F.lit(i).cast("bigint")).getField(v).alias(f"{v}_{i}")
            for v in values
            for i in range(1, width + 1)
        ],
    )


def occurrence_rows(wide: DataFrame, ids, values: Mapping[str, str], name: str = "occurrence") -> DataFrame:
    """Long form of ``{value}_1 ..`` columns, however many there are; empty occurrences are left out.

    ``values`` maps the beginnings of column names to the names of the long columns.
    """
    found = {v: {int(c[len(v) + 1 :]): c for c in wide.columns if c.startswith(f"{v}_") and c[len(v) + 1 :].isdigit()} for v in values}
    kinds = dict(wide.dtypes)
    width = max((i for own in found.values() for i in own), default=0)
    rows = []
    for i in range(1, width + 1):
        cells = [
            (F.col(own[i]) if i in own else F.lit(None).cast(kinds[next(iter(own.values()))])).alias(values[v])
            for v, own in found.items()
        ]
        rows.append(F.struct(F.lit(i).cast("bigint").alias(name), *cells))
    long = wide.select(*as_list(ids), F.inline(F.array(*rows)))
    return long.filter(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in values.values()]))


def unpivot(
    df: DataFrame,
    ids,
    columns: Sequence[str],
    name: str = "name",
    value: str = "value",
    drop_missing: bool = True,
) -> DataFrame:
    """Wide to long; missing cells are dropped unless asked for."""
    long = df.unpivot(as_list(ids), list(columns), name, value)
    return long.filter(F.col(value).isNotNull()) if drop_missing else long


def items_per_key(df: DataFrame, key, columns: Sequence[str], name: str = "n_items") -> DataFrame:
    """Number of filled cells per key, for keys with at least one.

    Counted in place: unpivoting first would multiply the rows.
    """
    filled = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("bigint") for c in columns])
    counts = df.groupBy(*as_list(key)).agg(F.sum(filled).alias(name))
    return counts.filter(F.col(name) > 0)


def count_items(df: DataFrame, key, value: str, name: str = "n_items") -> DataFrame:
    """``items_per_key`` of the long form: rows with a value per key, for keys with at least one."""
    return df.filter(F.col(value).isNotNull()).groupBy(*as_list(key)).agg(F.count(F.lit(1)).alias(name))
