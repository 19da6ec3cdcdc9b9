"""Drug rows to therapy lines, regimens, a wide drug table and all-drug phases."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from kohorta.functions import clinical as c, exprs as x
from kohorta.operators.events import ever, keep_first
from kohorta.operators.joins import attribute, attribute_fallback, label_sequence, lookup, restrict
from kohorta.operators.keys import attach, equi_join
from kohorta.operators.reshape import pivot_occurrence, union_by_name
from kohorta.operators.selectors import past, rest
from kohorta.plans import therapy
from kohorta.plans.base import KEY, ROW, SOURCE, known_rows, rows_by_patient, site_keys, stacked
from kohorta.session import bucketed, durable, durable_like, ordinary
from kohorta.sources.tables import add_rows

START, STOP, LINE, SITE = "AgeAtMedStart", "AgeAtMedStop", "MedLineRegimen", "MedPrimaryDiagnosisSite"
NARROW, GENERAL = "narrow_drug_class_cytotoxic_only", "general_drug_class"
FIRST_LINES = ("Neoadjuvant Regimen", "First Line/Regimen")
SPECIMEN_LABELS = ("regimen before germline", "regimen after germline")

# Exposure flags and the text that sets them.
EXPOSURES = {
    "received_carboplatin": ("regimen_drugs", "carboplatin"),
    "received_paclitaxel": ("regimen_drugs", "paclitaxel"),
    "received_bev": ("regimen_drugs", "bevacizumab"),
    "received_any_platinum": (NARROW, "platinum"),
    "received_any_taxane": (NARROW, "taxane"),
}


@dataclass(frozen=True)
class Medication:
    rows: DataFrame  # every drug row with its class and line
    therapy: DataFrame  # rows of the index therapy with their line number
    long: DataFrame  # one row per regimen
    wide: DataFrame  # one row per patient
    phases: DataFrame  # all drugs before, in and after the index therapy


def drug_dimension(table: DataFrame) -> DataFrame:
    """Drug classes, one row per lower-case name, with the added drugs."""
    added = [{"drug_name": n, NARROW: a, GENERAL: b} for n, a, b in c.ADDED_DRUG_CLASSES]
    full = add_rows(table.select("drug_name", NARROW, GENERAL), added)
    lower = full.withColumn("drug_name", F.lower("drug_name"))
    return keep_first(lower, "drug_name", [NARROW, GENERAL])


def in_index_therapy() -> Column:
    """Rows that ``index_therapy`` reads: chemotherapy, and patients without any drug."""
    return (F.col("MedicationInd") == "No") | _is_chemo()


def _is_chemo() -> Column:
    return (F.col("MedicationInd") == "Yes") & F.col("received_chemotherapy").isNotNull()


def _filled(rows: DataFrame) -> DataFrame:
    rows = therapy.fill_line_text(rows, KEY, START, LINE, [ROW])
    return attach(rows, KEY, {"ever_first_med_age": partial(x.group_min_strict, START, STOP)}, na_matches=False)


def drug_rows(
    table: DataFrame, cohort: DataFrame, drugs: DataFrame, wanted: Column | None = None
) -> DataFrame:
    """Cohort drug rows with clean names, classes and filled line labels.

    ``wanted`` names the rows that are needed later, where not all are: labels and
    first ages come from all rows, only these are then grouped and written.
    """
    with ordinary(table, KEY):
        mine, buckets = rows_by_patient(table, cohort, [START, STOP])
        rows = known_rows(mine, "MedicationInd")
        # The windows copy every row several times: what they do not read is one cell.
        rows = past(rows, rest(rows, KEY, ROW, START, STOP, LINE), _filled)
        rows = rows.withColumn("Medication", F.lower(c.drug_name(F.col("Medication"))))
        # Written, so that its size is known: the rows are not shuffled by drug for a small table.
        rows = lookup(rows, durable(drug_dimension(drugs)), {"Medication": "drug_name"})
        rows = rows.withColumn(
            "received_chemotherapy", c.chemotherapy_flag(F.col(NARROW), F.col("Medication"))
        )
        if wanted is not None:
            rows = rows.filter(wanted)
        # Equal rows are one record; its number is that of the first of them. The
        # hash decides nearly every comparison of the sort, and the patient comes first still.
        others = [n for n in rows.columns if n != ROW]
        alike = [KEY, F.xxhash64(*others).alias("__hash"), *[n for n in others if n != KEY]]
        records = rows.groupBy(*alike).agg(F.min(ROW).alias(ROW)).select(*others, ROW)
        return durable(records) if buckets is None else bucketed(records, KEY, buckets)


def index_therapy(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Chemotherapy rows of the index cancer, unknown-site rows rescued, lines numbered."""
    with ordinary(rows, KEY):
        return _index_therapy(rows, index)


def _index_therapy(rows: DataFrame, index: DataFrame) -> DataFrame:
    chemo = rows.filter(_is_chemo())
    chemo = durable_like(therapy.rank_lines(chemo, KEY, SITE, START, LINE, "first_rank"), KEY, rows)
    on_site = attribute(chemo, index, site_keys("Med"))
    no_first = ever(on_site, KEY, F.col(LINE).isin(*FIRST_LINES), "has_first").filter(
        F.col("has_first").isNull()
    )
    unknown = F.col(SITE) == c.UNKNOWN
    rescued = attribute_fallback(chemo, no_first.select(KEY).distinct(), index, KEY, unknown, mode="present")
    mine = durable_like(stacked(on_site, rescued), KEY, rows)
    unplaced = attribute_fallback(chemo, mine, index, KEY, unknown)
    never = rows.filter(F.col("MedicationInd") == "No").withColumn("received_chemotherapy", F.lit("Never"))
    together = union_by_name(
        never.withColumn(SOURCE, F.lit(-1)), mine, unplaced.withColumn(SOURCE, F.lit(2))
    )
    unique = keep_first(together, [KEY, START, "Medication", STOP], [SOURCE, "first_rank", ROW])
    order = [SOURCE, "first_rank", ROW]
    return durable_like(therapy.therapy_lines(unique, KEY, SITE, START, LINE, order, "regimen_line"), KEY, rows)


def regimens_long(drugs: DataFrame, cohort: DataFrame) -> DataFrame:
    """Regimens with their place before or after the germline sample."""
    keys = [KEY, "regimen_line", START, "MedicationInd", "ever_first_med_age"]
    with ordinary(drugs, KEY):
        long = therapy.regimens(
            drugs, keys, STOP, ["Medication", NARROW, GENERAL], [SOURCE, "first_rank", ROW]
        ).withColumnRenamed("Medication", "regimen_drugs")
        flagged = therapy.exposure_flags(
            long, cohort, KEY, START, "germline_collection_age", EXPOSURES, SPECIMEN_LABELS
        )
        return durable_like(flagged, KEY, drugs)


def regimens_wide(long: DataFrame) -> DataFrame:
    """One row per patient with ``AgeAtMedStart_n``, ``regimen_n``, ``AgeAtMedStop_n``."""
    wide = pivot_occurrence(
        long.withColumnRenamed("regimen_drugs", "regimen"),
        KEY,
        [START, "regimen", STOP],
        None,
        [START, "regimen_line", "regimen"],
        lhs=["MedicationInd", "ever_first_med_age", *EXPOSURES],
    )
    return wide.withColumnRenamed("MedicationInd", "drugs_ever").withColumns(
        {
            "has_medication_data": F.lit("Yes"),
            "had_prior_medication": therapy.prior_treatment(
                F.col(f"{START}_1"), F.col("ever_first_med_age")
            ),
        }
    )


def drug_phases(rows: DataFrame, index_rows: DataFrame, long: DataFrame, cohort: DataFrame) -> DataFrame:
    """All drugs of treated patients: before, in and after the index therapy."""
    with ordinary(rows, KEY):
        return _drug_phases(rows, index_rows, long, cohort)


def _drug_phases(rows: DataFrame, index_rows: DataFrame, long: DataFrame, cohort: DataFrame) -> DataFrame:
    treated = restrict(rows, index_rows, KEY)
    # Only patient and number go to where equal numbers meet, whoever's they are.
    taken = restrict(treated.select(KEY, ROW), index_rows, ROW).distinct()
    other = equi_join(treated, taken, [KEY, ROW], "left_anti")
    first = long.groupBy(KEY).agg(F.min(START).alias("first_start"))
    phases = therapy.therapy_phase(
        other, index_rows, first, KEY, START, "first_start", phase="drug_sequence_vs_ovarian_drugs"
    )
    labelled = label_sequence(
        phases, cohort, KEY, START, "germline_collection_age", SPECIMEN_LABELS, "regimen_specimen_sequence"
    )
    return labelled.drop(SOURCE, "first_rank")


def medication(
    table: DataFrame, drugs: DataFrame, cohort: DataFrame, index: DataFrame
) -> Medication:
    rows = drug_rows(table, cohort, drugs)
    lines = index_therapy(rows, index)
    long = regimens_long(lines, cohort)
    return Medication(rows, lines, long, regimens_wide(long), drug_phases(rows, lines, long, cohort))


def non_chemotherapy(rows: DataFrame) -> DataFrame:
    """Drug rows that are no chemotherapy."""
    subset = therapy.treatment_subset(F.col("MedicationInd"), F.col("received_chemotherapy"))
    return rows.filter(subset == "non_chemo")


