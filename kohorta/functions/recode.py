"""Rule tables, ordinal maps, bins and label domains."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F


def _value(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def recode(rules: Sequence[tuple[Column, object]], default=None) -> Column:
    """First rule that holds decides; an unknown condition does not hold."""
    head, *rest = rules
    out = F.when(head[0], _value(head[1]))
    for condition, value in rest:
        out = out.when(condition, _value(value))
    return out if default is None else out.otherwise(_value(default))


def equals_any(col: Column, values: Sequence[str], contains: Sequence[str] = ()) -> Column:
    """Membership test, optionally widened by substrings."""
    out = col.isin(*values) if values else None
    for text in contains:
        hit = col.contains(text)
        out = hit if out is None else out | hit
    return out


def ordinal(col: Column, codes: Mapping[str, int]) -> Column:
    """Number of a label; unlisted labels give null."""
    pairs = [F.lit(x) for item in codes.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), col)


def bin_numeric(col: Column, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the left-closed interval that holds the value."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("one label more than cut points is needed")
    out: Column | None = None
    for cut, label in zip(cuts, labels):
        out = F.when(col < cut, F.lit(label)) if out is None else out.when(col < cut, F.lit(label))
    return out.when(col >= cuts[-1], F.lit(labels[-1]))


def domain(col: Column, levels: Sequence[str]) -> Column:
    """Keep listed labels, null the rest."""
    return F.when(col.isin(*levels), col)


def domain_rank(col: Column, levels: Sequence[str]) -> Column:
    """Position of the label in the level list, from 1; null outside it."""
    return F.nullif(F.array_position(F.array(*[F.lit(v) for v in levels]), col), F.lit(0)).cast(
        "bigint"
    )
