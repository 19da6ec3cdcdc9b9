"""Therapy lines, regimens, exposure flags and phases from drug rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from kohorta.functions.recode import ordinal
from kohorta.operators.collapse import collapse_two_level
from kohorta.operators.events import ever_flags
from kohorta.operators.joins import label_sequence
from kohorta.operators.keys import as_list, keyed_join
from kohorta.operators.ordered import dense_rank_valid, fill
from kohorta.session import durable_like

# Codes of the therapy line labels.
UNKNOWN_LINES = ("Unknown/Not Applicable", "Unknown/Not Reported")
LINE_CODES: dict[str, int] = {
    "Unknown/Not Applicable": 999,
    "Unknown/Not Reported": 999,
    "Neoadjuvant Regimen": 0,
    "First Line/Regimen": 1,
    "Second Line/Regimen": 2,
    "Third Line/Regimen": 3,
    "Fourth Line/Regimen": 4,
    "Fifth Line/Regimen": 5,
    "Sixth Line/Regimen": 6,
    "Seventh Line/Regimen": 7,
    "Eighth Line/Regimen": 8,
    "Ninth Line/Regimen": 9,
    "Tenth Line/Regimen": 10,
    "Eleventh Line/Regimen": 11,
    "Twelfth Line/Regimen": 12,
    "Maintenance": 90,
    "Palliative": 91,
}

# Labels and codes of the phase relative to the index therapy.
PHASE_LABELS = ("1- drugs for pre cancer", "2- drugs for ovarian cancer", "3- drugs for post cancer")
PHASE_CODES = (-1, 88)


def fill_line_text(df: DataFrame, key: str, start: str, line: str, order_by) -> DataFrame:
    """Unknown line labels taken from rows of the key that start at the same time."""
    known = df.withColumn("__line", F.when(~F.col(line).isin(*UNKNOWN_LINES), F.col(line)))
    filled = fill(known, "__line", [key, start], order_by, "updown")
    return filled.withColumn(line, F.coalesce("__line", line)).drop("__line")


def rank_lines(
    df: DataFrame,
    key: str,
    site: str | Sequence[str],
    start: str,
    line: str,
    name: str = "regimen_line",
    line_first: bool = False,
) -> DataFrame:
    """Dense rank of (start, line) per key and site; the line code where unranked.

    By default the start time leads, which is the level order of a crossed
    factor; ``line_first`` ranks by line and then by start.
    """
    coded = df.withColumn("__code", ordinal(F.col(line), LINE_CODES))
    order = ["__code", start] if line_first else [start, "__code"]
    ranked = dense_rank_valid(coded, [key, *as_list(site)], order, name, fallback="__code")
    return ranked.drop("__code")


def therapy_lines(
    df: DataFrame,
    key: str,
    site: str | Sequence[str],
    start: str,
    line: str,
    order_by,
    name: str = "regimen_line",
    line_first: bool = False,
) -> DataFrame:
    """Fill the line labels, then number the lines of each key and site."""
    filled = fill_line_text(df, key, start, line, order_by)
    return rank_lines(filled, key, site, start, line, name, line_first)


def regimens(
    df: DataFrame,
    keys: Sequence[str],
    stop: str,
    columns: Sequence[str],
    order_by,
    sep: str = "; ",
) -> DataFrame:
    """Drugs that share the keys (patient, line, start, ..) as one regimen row."""
    return collapse_two_level(df, keys, stop, columns, order_by, sep)


def exposure_flags(
    df: DataFrame,
    anchor: DataFrame,
    key: str,
    start: str,
    anchor_time: str,
    contains: Mapping[str, tuple[str, str]],
    labels: tuple[str, str] = ("regimen before germline", "regimen after germline"),
    sequence: str = "regimen_specimen_sequence",
) -> DataFrame:
    """Label regimens against the anchor and flag keys exposed before it.

    ``contains`` maps a flag to (column, text): any regimen up to the anchor
    whose column holds the text makes the flag "Yes" on all rows of the key.
    """
    labelled = durable_like(label_sequence(df, anchor, key, start, anchor_time, labels, sequence), key, df)
    before = F.col(sequence) == labels[0]
    return ever_flags(
        labelled, key, {n: before & F.col(c).contains(text) for n, (c, text) in contains.items()}
    )


def phase_of(start: Column, first: Column, labels: tuple[str, str, str] = PHASE_LABELS) -> tuple[Column, Column]:
    """Label and line code of a row outside the index therapy."""
    label = F.when(start < first, F.lit(labels[0])).when(start > first, F.lit(labels[2]))
    code = F.when(start < first, F.lit(PHASE_CODES[0])).when(start > first, F.lit(PHASE_CODES[1]))
    return label, code.cast("bigint")


def therapy_phase(
    other: DataFrame,
    index_rows: DataFrame,
    first_start: DataFrame,
    key: str,
    start: str,
    first: str,
    line: str = "regimen_line",
    phase: str = "drug_sequence",
    labels: tuple[str, str, str] = PHASE_LABELS,
) -> DataFrame:
    """Rows outside the index therapy labelled before / after its first start.

    ``other`` are all rows of the same keys that are not index rows; the index
    rows are added with their own label.
    """
    joined = keyed_join(other, first_start.select(key, first), key, "left")
    label, code = phase_of(F.col(start), F.col(first), labels)
    outside = joined.withColumns({phase: label, line: code}).drop(first)
    inside = index_rows.withColumn(phase, F.lit(labels[1]))
    return outside.unionByName(inside, allowMissingColumns=True)


def prior_treatment(first_attributed: Column, first_ever: Column) -> Column:
    """"Yes" where the first attributed treatment came after some earlier one."""
    return F.when(first_attributed > first_ever, F.lit("Yes"))


def treatment_subset(given: Column, chemo: Column) -> Column:
    """never / chemo / non-chemo by the treated flag and a chemotherapy flag."""
    return (
        F.when(given == "No", F.lit("never"))
        .when((given == "Yes") & chemo.isNotNull(), F.lit("chemo"))
        .when((given == "Yes") & chemo.isNull(), F.lit("non_chemo"))
    )
