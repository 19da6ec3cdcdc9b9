"""Index diagnosis, disease outcomes and metastasis."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kohorta.functions import clinical as c, exprs as x
from kohorta.operators.events import (
    event_or_censor,
    event_sequence,
    group_count,
    index_event_with_history,
    keep_first,
)
from kohorta.operators.joins import attribute, attribute_fallback
from kohorta.operators.selectors import across, span
from kohorta.plans.base import KEY, ROW, SOURCE, cohort_rows, counted_once, site_keys, stacked
from kohorta.operators.joins import restrict


@counted_once
def index_diagnosis(table: DataFrame, cohort: DataFrame) -> DataFrame:
    """First qualifying diagnosis per patient, with texts on the other ones."""
    rows = group_count(restrict(table, cohort, KEY), KEY, "number_of_dx")
    rows = rows.select(
        KEY,
        ROW,
        "number_of_dx",
        "AgeAtFirstContact",
        "AgeAtDiagnosis",
        "YearOfDiagnosis",
        *span(table, "PrimaryDiagnosisSiteCode", "Histology"),
        "ClinGroupStage",
        "PathGroupStage",
        "GradeClinical",
        "GradePathological",
        "CurrentlySeenForPrimaryOrRecurr",
        "PerformStatusAtDiagnosis",
        "OtherStagingSystem",
        "OtherStagingValue",
        x.sentinel_flag("AgeAtDiagnosis").alias("not_real_age"),
    )
    rows = across(rows, ["AgeAtDiagnosis", "AgeAtFirstContact"], x.parse_age)
    # The first contact stands in for an unknown age at diagnosis.
    rows = rows.withColumn(
        "dx_age_is_first_contact_age", x.imputed_flag("AgeAtDiagnosis", "AgeAtFirstContact")
    ).withColumn("AgeAtDiagnosis", F.coalesce("AgeAtDiagnosis", "AgeAtFirstContact"))
    rows = event_sequence(rows, KEY, ["AgeAtDiagnosis", ROW], "diagnosis_sequence")
    text = x.concat_text(
        F.lit("age = "),
        x.fmt_num("AgeAtDiagnosis"),
        F.lit(", site = "),
        "PrimaryDiagnosisSite",
        F.lit(", histology = "),
        "Histology",
    )
    index = index_event_with_history(
        rows,
        KEY,
        "AgeAtDiagnosis",
        c.is_index_site(F.col("PrimaryDiagnosisSite"), F.col("Histology")),
        [ROW],
        text,
        "pre_cancer_info",
        "post_cancer_info",
    )
    age = F.col("AgeAtDiagnosis")
    return index.drop(ROW).withColumns(
        {
            "had_ovarian_cancer": F.lit("Yes"),
            "age_at_ovarian_cancer": age,
            "age_at_first_ovarian_cancer": age,
            "is_first_ovarian_dx": F.lit("Yes"),
        }
    )


@counted_once
def outcomes(table: DataFrame, cohort: DataFrame, index: DataFrame) -> DataFrame:
    """First progression, or last disease check without one, of the index cancer."""
    site = "OutcomesPrimaryDiagnosisSite"
    rows = cohort_rows(table, cohort, ["AgeAtProgRecur", "AgeAtCurrentDiseaseStatus"])
    rows = rows.withColumns(
        {
            "age_at_disease_check": F.coalesce("AgeAtProgRecur", "AgeAtCurrentDiseaseStatus"),
            "progression": c.outcome_event(F.col("ProgRecurInd")),
        }
    )
    mine = attribute(rows, index, site_keys("Outcomes"))
    undated = mine.filter(F.col("age_at_disease_check").isNull()).select(KEY)
    rescued = attribute_fallback(rows, mine, index, KEY, F.col(site) == c.UNKNOWN, also=undated)
    picked = event_or_censor(
        stacked(mine, rescued),
        KEY,
        "progression",
        "age_at_disease_check",
        event_name="pfs_event",
        time_name="pfs_age",
        carry=[f"{site}Code", site],
        order_by=[SOURCE, ROW],
    )
    return picked.withColumn("has_outcomes_data", F.lit("Yes"))


@counted_once
def metastasis(table: DataFrame, cohort: DataFrame, index: DataFrame) -> DataFrame:
    """First metastasis record of the index cancer."""
    age, site = "AgeAtMetastaticSite", "MetsDzPrimaryDiagnosisSite"
    rows = cohort_rows(table, cohort, [age])
    order = [age, site, ROW]
    mine = keep_first(attribute(rows, index, site_keys("MetsDz")), KEY, order)
    unknown = F.col("MetastaticDiseaseSite") == c.UNKNOWN
    rescued = keep_first(attribute_fallback(rows, mine, index, KEY, unknown), KEY, order)
    return mine.unionByName(rescued).select(
        KEY,
        "MetastaticDiseaseSiteCode",
        "MetastaticDiseaseSite",
        F.col("MetastaticDiseaseInd").alias("had_metastasis"),
        age,
        site,
        F.lit("Yes").alias("has_metastasis_data"),
    )
