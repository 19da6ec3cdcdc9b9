"""Patient-level tables: cohort, demographics, history, vitals, exam, markers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from kohorta.functions import clinical as c, exprs as x
from kohorta.functions.recode import bin_numeric
from kohorta.operators.collapse import collapse
from kohorta.operators.events import keep_first, latest_across
from kohorta.operators.joins import attribute, pick_nearest, resolve_pairs, restrict
from kohorta.operators.keys import equi_join
from kohorta.operators.ordered import fill
from kohorta.operators.reshape import pivot_named
from kohorta.operators.selectors import across, of_type, rest
from kohorta.plans.base import KEY, ROW, cohort_rows, counted_once


def _with_key(table: DataFrame) -> DataFrame:
    """Some extracts put a prefix before the name of the key."""
    return table.withColumnsRenamed({n: KEY for n in table.columns if n.endswith(KEY)})


def cohort(samples: DataFrame, linkage: DataFrame) -> DataFrame:
    """Sample list with the collection ages and sites of its germline-tumor pair."""
    named = _with_key(linkage).withColumnsRenamed(
        {
            "Tumor.Germline": "Kind",
            "Age.At.Specimen.Collection": "collection_age",
            "SpecimenSiteOfCollection": "collection_site",
            "Disease.Type": "Disease",
        }
    )

    def kind(label: str, prefix: str, *extra: str) -> DataFrame:
        return named.filter(F.col("Kind") == label).select(
            KEY,
            F.col("WES").alias(f"__{prefix}_wes"),
            F.col("collection_age").alias(f"{prefix}_collection_age"),
            F.col("collection_site").alias(f"{prefix}_SpecimenSiteOfCollection"),
            *extra,
        )

    listed = _with_key(samples).withColumnsRenamed({"Disease.Type": "DiseaseType"})
    paired = resolve_pairs(
        listed,
        kind("Germline", "germline"),
        kind("Tumor", "tumor", "Disease"),
        KEY,
        {"Germline_WES": "__germline_wes"},
        {"Tumor_WES": "__tumor_wes", "DiseaseType": "Disease"},
    )
    return across(paired, ["germline_collection_age", "tumor_collection_age"], x.parse_age)


def sequencing_ages(sequencing: DataFrame) -> DataFrame:
    age = "AgeAtTumorSequencing"
    done = sequencing.filter(F.col("TumorSequencingInd") == "Yes")
    return done.select(
        KEY, x.parse_age(age).alias(age), x.sentinel_flag(age).alias("not_real_sequencing_age")
    )


def cytogenetics(table: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """One column per abnormality with its indicator, positive results only."""
    positive = table.filter(F.col("CytogenAbnormResult") == "Positive")
    unique = positive.select(KEY, "CytogenAbnormName", "CytogenAbnormInd").distinct()
    return pivot_named(unique, KEY, "CytogenAbnormName", "CytogenAbnormInd", names)


def demographics(table: DataFrame, cohort_: DataFrame) -> DataFrame:
    grouped = restrict(table, cohort_, KEY).withColumns(
        {
            "Race": c.race_group(F.col("Race")),
            "Ethnicity": c.ethnicity_group(F.col("Ethnicity")),
        }
    )
    return grouped.withColumn("race_eth", c.race_ethnicity(F.col("Race"), F.col("Ethnicity")))


def history(table: DataFrame, cohort_: DataFrame) -> DataFrame:
    return restrict(table, cohort_, KEY).select(
        KEY,
        "AgeAtLastUpdate",
        c.smoking_group(F.col("SmokingStatus")).alias("SmokingStatus"),
        "AlcoholUse",
        "PreExistHPV",
    )


def vital_status(table: DataFrame, cohort_: DataFrame) -> DataFrame:
    ages = ["AgeAtLastContact", "AgeAtDeath"]
    return cohort_rows(table, cohort_, ages).select(
        KEY, "VitalStatus", *ages, F.lit("Yes").alias("has_os_data")
    )


@counted_once
def exam(table: DataFrame, cohort_: DataFrame, index: DataFrame) -> DataFrame:
    """Body measures nearest to the index diagnosis, gaps filled from later exams."""
    measures = ["BodyWeight", "BodyHeight", "BMI"]
    age = "AgeAtPhysicalExam"
    rows = across(cohort_rows(table, cohort_, [age]), measures, x.parse_number)
    rows = fill(rows.select(KEY, ROW, age, *measures), measures, KEY, [age, ROW], "up")
    nearest = pick_nearest(rows, index, KEY, age, "AgeAtDiagnosis", [age, ROW], how="left")
    return nearest.select(
        KEY, age, *measures, bin_numeric(F.col("BMI"), c.BMI_CUTS, c.BMI_LABELS).alias("bmi_cat")
    )


@counted_once
def markers_long(
    table: DataFrame, flow: DataFrame, cohort_: DataFrame, lexical: bool = False
) -> DataFrame:
    """First result of each marker from tumor collection on, with flow panels.

    ``lexical`` compares values with their range as texts instead of numbers.
    """
    age = "AgeAtTumorMarkerTest"
    rows = cohort_rows(table, cohort_, [age])
    texts = [t for t in of_type(rows, "string") if t not in (KEY, "TumorMarkerKey")]
    rows = across(rows, texts, lambda t: x.na_if(t, c.UNKNOWN))
    rows = rows.withColumns(
        {
            "TMarkerValueUOM": x.na_if("TMarkerValueUOM", "Unknown"),
            "TMarkerRangeIndicator": x.na_if("TMarkerRangeIndicator", "Not Available"),
        }
    )
    result = c.marker_value(
        F.col("TMarkerResult"),
        F.col("TMarkerResultValue"),
        F.col("TMarkerLowRange"),
        F.col("TMarkerHighRange"),
        F.col("TMarkerRangeIndicator"),
        lexical,
    )
    name, full = c.marker_parts(F.col("TMarkerTest"), F.col("marker_result"))
    read = rows.withColumn("marker_result", result).select(
        KEY,
        ROW,
        "TumorMarkerInd",
        "TumorMarkerKey",
        age,
        name.alias("marker_test"),
        F.when(F.col("TMarkerResult") == "Value", F.col("TMarkerValueUOM")).alias("marker_unit"),
        full.alias("marker_result"),
    )
    first = pick_nearest(
        read, cohort_, KEY, age, "tumor_collection_age", [ROW], "forward", by=["marker_test"]
    )
    panels = flow.select(KEY, "TumorMarkerKey", "FlowPanelName", "FlowPanelResult")
    joined = equi_join(first, panels, [KEY, "TumorMarkerKey"], "left", na_matches=True)
    return joined.select(
        KEY,
        "TumorMarkerInd",
        x.unite([x.snake_text("marker_test"), x.snake_text("FlowPanelName")], na_rm=True).alias("marker_test"),
        "marker_unit",
        F.coalesce("marker_result", "FlowPanelResult").alias("marker_result"),
    )


def markers_wide(long: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """One row per patient with unit and result of each marker.

    Where a marker has several rows, one of them gives all its cells: those with
    a result first, then the smallest result and unit.
    """
    cells = rest(long, KEY, "TumorMarkerInd", "marker_test")
    order = ["marker_result", "marker_unit"]
    row = F.min(F.struct(*[t for c in order for t in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]))
    values = {c: row.getField(c) for c in cells}
    return pivot_named(long, [KEY, "TumorMarkerInd"], "marker_test", values, names)


def family_history(table: DataFrame, index: DataFrame) -> DataFrame:
    """Relatives with the patient's index cancer, collapsed to one row."""
    on = {KEY: KEY} | {f"FamilyRelationPrimarySite{s}": f"PrimaryDiagnosisSite{s}" for s in ("Code", "")}
    relatives = keep_first(attribute(table, index, on), [KEY, "FamilyRelation"], [ROW])
    return collapse(
        relatives, [KEY, "CancerInFamilyInd"], ["FamilyRelation", "FamilyRelationAgeGroup"], [ROW], " + "
    )


def last_date(imaging: DataFrame, labs: DataFrame) -> DataFrame:
    """Latest imaging or laboratory age per patient."""
    sources = [(imaging, "AgeAtImageScan"), (labs, "AgeAtLabResults")]
    return latest_across(
        [(t.select(KEY, x.parse_age(a).alias(a)), a) for t, a in sources], KEY, "age_at_lab"
    )
