"""Report tables: each is one aggregation job over the derived patient table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from kohorta.functions.clinical import BMI_GROUPS, INDEX_SITES, KEPT_HISTOLOGIES, RACE_ETH_LEVELS
from kohorta.functions.exprs import capture
from kohorta.operators import association, summary, survival
from kohorta.operators.events import ever
from kohorta.operators.reshape import items_per_key, unpivot
from kohorta.operators.selectors import drop_empty_columns, is_number, span, with_prefix

KEY = "avatar_key"
STRATUM = "ch_status"

# Covariates of the univariable models.
COVARIATES = [
    "ch_status",
    "germline_collection_age",
    "race_eth",
    "clin_group_stage",
    "histology",
    "bmi_cat",
]
# Level order; the first level is the one compared with. Others are sorted.
LEVELS = {"ch_status": ["No CH", "CH"], "race_eth": RACE_ETH_LEVELS, "bmi_cat": BMI_GROUPS}


def primary_site_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("primary_diagnosis_site").isin(*INDEX_SITES))


def kept_histology_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("histology_behavior").isin(*KEPT_HISTOLOGIES))


def histology_discrepancy(df: DataFrame) -> DataFrame:
    """Patients whose sequencing and clinical histology differ (or one is missing)."""
    named = df.withColumn(
        "histology_behavior_sequencing", capture("histology_behavior", "([0-9]*) (.*)", 2)
    )
    rows = summary.discrepancy(named, "histology_behavior_sequencing", "histology")
    return rows.select("histology_behavior_sequencing", "histology")


def characteristics(
    df: DataFrame, columns: Sequence[str], by: str | None = None, categorical: Sequence[str] = ()
) -> DataFrame:
    """Levels with n and percent, numbers with median and quartiles, per stratum.

    Few-valued numbers (0/1 events) named in ``categorical`` are shown as levels.
    """
    numbers = [c for c in columns if is_number(df, c) and c not in categorical]
    labels = [c for c in columns if c not in numbers]
    parts = []
    if labels:
        parts.append(summary.summary_categorical(df, labels, by, overall=by is not None))
    if numbers:
        parts.append(summary.summary_continuous(df, numbers, by, overall=by is not None))
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part, allowMissingColumns=True)
    return table


def tests(df: DataFrame, columns: Sequence[str], by: str = STRATUM) -> DataFrame:
    """One association test per variable."""
    lines = []
    for column in columns:
        r = association.compare(df, column, by)
        lines.append((column, r["test"], r["statistic"], r["df"], r["p_value"]))
    return df.sparkSession.createDataFrame(
        lines, "variable string, test string, statistic double, df int, p_value double"
    )


def regimens_per_patient(df: DataFrame) -> DataFrame:
    """Number of regimens of treated patients, shown as levels."""
    treated = df.filter(F.col("drugs_ever") == "Yes")
    counts = items_per_key(treated, KEY, with_prefix(treated, "regimen_"), "number_of_regimen")
    return summary.summary_categorical(counts, ["number_of_regimen"])


def regimen_frequency(df: DataFrame) -> DataFrame:
    treated = df.filter(F.col("drugs_ever") == "Yes")
    long = unpivot(treated, KEY, with_prefix(treated, "regimen_"), "name", "drug_name")
    return summary.by_frequency(summary.summary_categorical(long, ["drug_name"]))


def ever_received(df: DataFrame, text: str, by: str = STRATUM) -> DataFrame:
    """Patients with a regimen that contains ``text``, by stratum."""
    treated = df.filter(F.col("drugs_ever") == "Yes")
    long = unpivot(treated, [KEY, by], with_prefix(treated, "regimen_"), "name", "drug_name")
    flagged = ever(long, KEY, F.lower("drug_name").contains(text.lower()), "received", no="No")
    return summary.summary_categorical(
        flagged.select(KEY, by, "received").distinct(), ["received"], by, overall=True
    )


def marker_characteristics(df: DataFrame, first: str, last: str) -> DataFrame:
    """Markers of a column range that hold any value."""
    markers = df.select(*span(df, first, last))
    filled = drop_empty_columns(markers)
    return characteristics(filled, filled.columns)


def hazard_ratios(
    df: DataFrame,
    endpoint: str,
    covariates: Sequence[str] = tuple(COVARIATES),
    levels: Mapping[str, Sequence[str]] = LEVELS,
) -> DataFrame:
    """Univariable models of an endpoint ("os" or "pfs") from first treatment.

    ``levels`` orders the levels of a covariate; ratios are against the first.
    """
    time, event = f"{endpoint}_time_from_treatment_years", f"{endpoint}_event"
    models = [survival.cox_univariable(df, time, event, c, levels.get(c)) for c in covariates]
    out = models[0]
    for model in models[1:]:
        out = out.unionByName(model)
    return out


def survival_curves(df: DataFrame, endpoint: str, by: str = STRATUM) -> DataFrame:
    return survival.kaplan_meier(df, f"{endpoint}_time_from_treatment_years", f"{endpoint}_event", by)


def survival_difference(df: DataFrame, endpoint: str, by: str = STRATUM) -> dict[str, float]:
    return survival.log_rank_test(
        df, f"{endpoint}_time_from_treatment_years", f"{endpoint}_event", by
    )


def drugs_without_class(phases: DataFrame) -> DataFrame:
    missing = phases.filter(F.col("general_drug_class").isNull())
    return summary.by_frequency(summary.summary_categorical(missing, ["Medication"]))


def drugs_before_sample(phases: DataFrame, by_phase: bool = False) -> DataFrame:
    before = phases.filter(F.col("regimen_specimen_sequence") == "regimen before germline")
    by = "drug_sequence_vs_ovarian_drugs" if by_phase else None
    return summary.by_frequency(summary.summary_categorical(before, ["Medication"], by))
