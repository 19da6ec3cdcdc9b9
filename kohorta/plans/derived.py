"""Derived variables of the wide patient table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kohorta.functions import clinical as c, exprs as x
from kohorta.functions.recode import domain
from kohorta.operators.keys import attach
from kohorta.operators.selectors import clean_names, past, with_substring
from kohorta.plans import endpoints as ep

KEY = "avatar_key"

# Exposure flags over all regimens and the first one.
DRUG_TEXTS = {
    "received_carboplatin": "carboplatin",
    "received_any_platin": "platin",
    "received_any_taxel": "taxel",
    "received_bev": "bevacizumab",
}


# Columns that the steps read or replace, besides the regimens.
READ = [
    "race_eth", "bmi_cat", "clin_group_stage", "path_group_stage", "histology_behavior", "histology",
    "grade_pathological", "age_at_last_contact", "age_at_death", "age_at_lab", "age_at_first_radiation",
    "age_at_first_surgery", "age_at_med_start_1", "has_medication_data", "vital_status", "age_at_diagnosis",
    "pfs_event", "pfs_age", "had_metastasis", "has_metastasis_data", "age_at_metastatic_site",
]


def derive_variables(wide: DataFrame) -> DataFrame:
    """Stage, histotype, grade, last contact, first treatment, exposure, endpoints.

    The steps read few of the columns; the others go past them in one cell, as a
    wide row would else be copied column by column at every step.
    """
    df = clean_names(wide)
    read = {KEY, *READ, *with_substring(df, "regimen_")}
    return past(df, [n for n in df.columns if n not in read], _derived)


def _derived(df: DataFrame) -> DataFrame:
    col = F.col
    df = df.withColumns(
        {
            "race_eth": domain(col("race_eth"), c.RACE_ETH_LEVELS),
            "bmi_cat": c.bmi_group(col("bmi_cat")),
            "clin_group_stage": c.stage_number(col("clin_group_stage")),
            "path_group_stage": c.stage_number(col("path_group_stage")),
            "histology_behavior": c.histology_name(col("histology_behavior")),
        }
    )
    df = attach(df, KEY, {"stage": x.group_max_skip("clin_group_stage", "path_group_stage")})
    df = df.withColumns(
        {
            "stage_cat": c.stage_group(col("stage")),
            "histotype": c.histotype(col("histology_behavior"), col("histology")),
        }
    )
    df = df.withColumn("grade", c.serous_grade(col("histotype"), col("grade_pathological")))
    df = df.withColumn(
        "hgsoc_vs_others", c.outcome_group(col("grade"), col("histology"), col("histotype"))
    )
    df = _last_contact(df)
    df = _first_treatment(df)
    return ep.survival_endpoints(_exposures(df))


def _last_contact(df: DataFrame) -> DataFrame:
    contact, death = F.col("age_at_last_contact"), F.col("age_at_death")
    df = df.withColumns(
        {
            "is_agelastcontact_last_date": ep.contact_is_latest(contact, F.col("age_at_lab")),
            "is_age_death_last_": ep.death_is_latest(death, contact),
        }
    )
    df = df.withColumn("age_at_last_contact", ep.reconcile_last_contact(contact, death))
    return df.withColumn("is_age_death_last", ep.death_is_latest(death, contact))


def _first_treatment(df: DataFrame) -> DataFrame:
    ages = [F.col(a) for a in ("age_at_first_radiation", "age_at_first_surgery", "age_at_med_start_1")]
    df = df.withColumn("first_treatment", ep.first_modality(*ages))
    return df.withColumn("age_at_first_treatment", ep.modality_age(F.col("first_treatment"), *ages))


def _exposures(df: DataFrame) -> DataFrame:
    known = F.col("has_medication_data") == "Yes"
    regimens = with_substring(df, "regimen_")
    flags = {}
    for name, text in DRUG_TEXTS.items():
        flags[f"{name}_any_regimen"] = x.yes_no(x.any_contains(regimens, text), known)
        flags[f"{name}_regimen1"] = x.yes_no(F.col("regimen_1").contains(text), known)
    return df.withColumns(flags)
