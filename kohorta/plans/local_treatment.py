"""Radiation and surgery: long tables around the sample date and wide tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kohorta.functions import clinical as c, exprs as x
from kohorta.operators.events import fallback_first_row, group_min_where
from kohorta.operators.joins import attribute, attribute_fallback, full_join
from kohorta.operators.keys import attach
from kohorta.operators.reshape import pivot_occurrence
from kohorta.plans.base import KEY, ROW, SOURCE, cohort_rows, counted_once, known_rows, site_keys, stacked
from kohorta.plans.therapy import prior_treatment


@counted_once
def radiation(table: DataFrame, cohort: DataFrame, index: DataFrame) -> DataFrame:
    """Radiation rows of the index cancer."""
    start, stop = "AgeAtRadiationStart", "AgeAtRadiationStop"
    rows = known_rows(cohort_rows(table, cohort, [start, stop]), "RadiationTherapyInd")
    rows = rows.withColumn("RadDose", x.parse_number("RadDose"))
    rows = attach(rows, KEY, {"ever_first_rad_age": x.group_min_strict(start)})
    mine = attribute(rows, index, site_keys("Rad"))
    unknown = F.col("RadPrimaryDiagnosisSite") == c.UNKNOWN
    return stacked(mine, attribute_fallback(rows, mine, index, KEY, unknown))


def radiation_wide(rows: DataFrame) -> DataFrame:
    wide = pivot_occurrence(
        rows,
        KEY,
        ["AgeAtRadiationStart", "RadDose", "AgeAtRadiationStop"],
        None,
        [SOURCE, ROW],
        lhs=["RadiationTherapyInd", "ever_first_rad_age"],
    ).withColumnsRenamed(
        {"RadiationTherapyInd": "radiation_ever", "AgeAtRadiationStart_1": "age_at_first_radiation"}
    )
    return wide.withColumns(
        {
            "has_radiation_data": F.lit("Yes"),
            "had_prior_radiation": prior_treatment(
                F.col("age_at_first_radiation"), F.col("ever_first_rad_age")
            ),
        }
    )


@counted_once
def surgery(table: DataFrame, cohort: DataFrame, index: DataFrame) -> DataFrame:
    """Therapeutic surgeries of the index cancer, else the first other one."""
    age, therapeutic = "AgeAtSurgeryBiopsy", F.col("SiteTherapeutic")
    rows = known_rows(cohort_rows(table, cohort, [age]), "SurgeryBiopsyInd").drop("SurgeryBiopsyInd")
    rows = group_min_where(rows, KEY, age, therapeutic == "Yes", "ever_first_surgery_age")
    rows = fallback_first_row(rows, KEY, [ROW], therapeutic == "Yes", therapeutic == "No")
    mine = attribute(rows, index, site_keys())
    # The site is not tested here: any surgery of a single-cancer patient counts.
    return stacked(mine, attribute_fallback(rows, mine, index, KEY))


def surgery_wide(rows: DataFrame) -> DataFrame:
    age = "AgeAtSurgeryBiopsy"
    wide = pivot_occurrence(
        rows, KEY, [age], None, [SOURCE, ROW], lhs=["SiteTherapeutic", "ever_first_surgery_age"]
    ).withColumnsRenamed({"SiteTherapeutic": "surgery_ever", f"{age}_1": "age_at_first_surgery"})
    return wide.withColumns(
        {
            "has_surgery_data": F.lit("Yes"),
            "had_prior_surgery": prior_treatment(
                F.col("age_at_first_surgery"), F.col("ever_first_surgery_age")
            ),
        }
    )


def around_sample(rows: DataFrame, cohort: DataFrame, start: str, word: str) -> DataFrame:
    """Long table with every cohort patient, placed before or after the sample."""
    joined = full_join(rows, cohort.select(KEY, "germline_collection_age"), KEY)
    t, t0 = F.col(start), F.col("germline_collection_age")
    label = F.when(t <= t0, f"{word} before germline").when(t > t0, f"{word} after germline")
    return joined.withColumn(f"{word}_specimen_sequence", label).drop(
        "germline_collection_age", SOURCE
    )
