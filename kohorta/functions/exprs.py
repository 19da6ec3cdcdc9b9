"""Column expressions with explicit missing-value rules.

Every function takes and returns Columns, so all of them stay inside generated
code. "Missing" below always means SQL null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, WindowSpec, functions as F

# Age texts that stand for a number or for "not known".
AGE_SENTINELS: dict[str, float | None] = {
    "Age 90 or older": 90.0,
    "Unknown/Not Applicable": None,
}

NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_number(col: Column | str, sentinels: Mapping[str, float | None] | None = None) -> Column:
    """Number from text; sentinels are replaced, anything else unreadable is null."""
    text = _col(col)
    number = F.when(text.rlike(NUMBER_PATTERN), F.trim(text).try_cast("double"))
    if not sentinels:
        return number
    out: Column | None = None
    for label, value in sentinels.items():
        lit = F.lit(value).cast("double")
        out = F.when(text == label, lit) if out is None else out.when(text == label, lit)
    return out.otherwise(number)


def parse_age(col: Column | str) -> Column:
    return parse_number(col, AGE_SENTINELS)


def sentinel_flag(col: Column | str, label: str = "Age 90 or older") -> Column:
    """The sentinel itself where the raw text held it, else null."""
    return F.when(_col(col) == label, F.lit(label))


def imputed_flag(first: Column | str, fallback: Column | str) -> Column:
    """"Yes" where ``first`` is missing and ``fallback`` is not."""
    return F.when(_col(first).isNull() & _col(fallback).isNotNull(), F.lit("Yes"))


def na_if(col: Column | str, *values) -> Column:
    """Null where the value is one of ``values``."""
    return reduce(lambda c, v: F.nullif(c, F.lit(v)), values, _col(col))


def replace_na(col: Column | str, text: str) -> Column:
    return F.coalesce(_col(col), F.lit(text))


def remove_first(col: Column | str, pattern: str) -> Column:
    """Delete the leftmost match of ``pattern`` only."""
    return F.regexp_replace(_col(col), f"(?s)^(.*?)(?:{pattern})", "$1")


def remove_all(col: Column | str, pattern: str) -> Column:
    return F.regexp_replace(_col(col), pattern, "")


def replace_all(col: Column | str, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(_col(col), pattern, replacement)


def snake_text(col: Column | str) -> Column:
    """Lower-case label with blanks turned into underscores."""
    return F.replace(F.lower(_col(col)), F.lit(" "), F.lit("_"))


def capture(col: Column | str, pattern: str, group: int = 1) -> Column:
    """Capture group of the first match; null without a match."""
    text = _col(col)
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def fmt_num(col: Column | str) -> Column:
    """Number as text, integral values without a decimal point."""
    value = _col(col)
    return F.when(value == F.floor(value), value.cast("bigint").cast("string")).otherwise(
        value.cast("string")
    )


def concat_strict(*cols: Column | str, sep: str = "") -> Column:
    """Concatenate; null as soon as one part is null."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i and sep:
            parts.append(F.lit(sep))
        parts.append(_col(c))
    return F.concat(*parts)


def concat_text(*cols: Column | str, sep: str = "", na: str = "NA") -> Column:
    """Concatenate; missing parts are written as ``na``."""
    return F.concat_ws(sep, *[F.coalesce(_col(c).cast("string"), F.lit(na)) for c in cols])


def unite(cols: Sequence[Column | str], sep: str = "_", na_rm: bool = False) -> Column:
    """Paste columns together; missing parts are dropped or written as "NA"."""
    if na_rm:
        return F.concat_ws(sep, *[_col(c).cast("string") for c in cols])
    return concat_text(*cols, sep=sep)


def any_contains(cols: Sequence[Column | str], text: str) -> Column:
    """True when one of the columns contains ``text`` (three-valued)."""
    return reduce(lambda a, b: a | b, [_col(c).contains(text) for c in cols])


def yes_no(hit: Column, known: Column) -> Column:
    """"Yes" on a hit, "No" without one where data are known, else null."""
    return F.when(hit, F.lit("Yes")).when(known, F.lit("No"))


def in_range_label(
    value: Column | str,
    low: Column | str,
    high: Column | str,
    indicator: Column | str | None = None,
    labels: tuple[str, str, str] = ("Low", "WNL (Within Normal Limits)", "High"),
    lexical: bool = False,
) -> Column:
    """Read a value against its range; a given indicator wins.

    Texts are compared as numbers unless ``lexical`` asks for text order.
    """
    v, lo, hi = _col(value), _col(low), _col(high)
    if not lexical:
        v, lo, hi = (parse_number(c.cast("string")) for c in (v, lo, hi))
    below, within, above = labels
    label = (
        F.when((v >= lo) & (v <= hi), F.lit(within))
        .when(v < lo, F.lit(below))
        .when(v > hi, F.lit(above))
    )
    return label if indicator is None else F.coalesce(_col(indicator), label)


def group_min_strict(*cols: Column | str, over: WindowSpec | None = None) -> Column:
    """Aggregate: smallest value of all columns, null if any value is missing.

    ``over`` a window it is the value of the row's group.
    """
    values = [_col(c) for c in cols]
    part = (lambda a: a) if over is None else (lambda a: a.over(over))
    complete = reduce(lambda a, b: a & b, [part(F.count(v)) == part(F.count(F.lit(1))) for v in values])
    smallest = [part(F.min(v)) for v in values]
    return F.when(complete, smallest[0] if len(values) == 1 else F.least(*smallest))


def group_max_skip(*cols: Column | str) -> Column:
    """Aggregate: largest known value over all columns, null if none is known."""
    largest = [F.max(_col(c)) for c in cols]
    return largest[0] if len(cols) == 1 else F.greatest(*largest)
