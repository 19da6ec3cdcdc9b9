"""Column selection and naming helpers over ``df.columns`` / ``df.dtypes``."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def span(df: DataFrame, first: str, last: str) -> list[str]:
    """All columns from ``first`` to ``last`` in table order."""
    names = df.columns
    i, j = names.index(first), names.index(last)
    return names[i : j + 1] if i <= j else names[j : i + 1][::-1]


def with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.lower().startswith(prefix.lower())]


def with_substring(df: DataFrame, text: str) -> list[str]:
    return [c for c in df.columns if text.lower() in c.lower()]


def of_type(df: DataFrame, kind: str) -> list[str]:
    return [c for c, t in df.dtypes if t == kind]


NUMBERS = ("double", "float", "int", "bigint", "smallint", "tinyint")


def is_number(df: DataFrame, column: str) -> bool:
    """Whether reports and tests treat a column as a number rather than as labels."""
    kind = dict(df.dtypes)[column]
    return kind in NUMBERS or kind.startswith("decimal")


def rest(df: DataFrame, *taken: str) -> list[str]:
    """The columns not named yet."""
    return [c for c in df.columns if c not in taken]


def across(df: DataFrame, columns: Sequence[str], fn: Callable[[Column], Column]) -> DataFrame:
    """Apply one expression to several columns in place."""
    return df.withColumns({c: fn(F.col(c)) for c in columns})


def past(df: DataFrame, columns: Sequence[str], step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``step`` on the other columns, with ``columns``, which it does not know, in one cell beside them.

    The columns come back in their old places, new ones after them.
    """
    if not columns:
        return step(df)
    done = step(df.select(F.struct(*columns).alias("__past"), *rest(df, *columns)))
    made = [c for c in done.columns if c not in df.columns and c != "__past"]
    cells = set(columns)
    return done.select(
        *[F.col("__past").getField(c).alias(c) if c in cells else F.col(c) for c in df.columns if c in cells or c in done.columns],
        *made,
    )


def relocate(
    df: DataFrame, columns: Sequence[str], after: str | None = None, before: str | None = None
) -> DataFrame:
    """Move columns next to another one (to the front by default)."""
    others = rest(df, *columns)
    at = others.index(after) + 1 if after else others.index(before) if before else 0
    return df.select(*others[:at], *columns, *others[at:])


def drop_empty_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop those of ``columns`` that hold no value at all (one aggregate pass)."""
    tested = list(columns or df.columns)
    known = df.agg(*[F.max(F.col(c).isNotNull()).alias(c) for c in tested]).first()
    return df.drop(*[c for c in tested if not known[c]])


def snake(name: str) -> str:
    """snake_case form of one column name."""
    text = name.replace("%", "_percent_").replace("#", "_number_").replace("'", "")
    text = re.sub(r"[^0-9A-Za-z]+", "_", text)
    text = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", text)
    text = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", text)
    text = re.sub(r"_+", "_", text).strip("_").lower()
    return f"x{text}" if not text or text[0].isdigit() else text


def clean_names(df: DataFrame) -> DataFrame:
    """snake_case column names; repeated names get a number."""
    seen: dict[str, int] = {}
    names = []
    for raw in df.columns:
        base = snake(raw)
        seen[base] = seen.get(base, 0) + 1
        names.append(base if seen[base] == 1 else f"{base}_{seen[base]}")
    return df.toDF(*names)
