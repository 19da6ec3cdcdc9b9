"""From the raw clinical tables to one wide row per patient."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from kohorta.operators.joins import merge_on_index
from kohorta.plans import diagnosis as dx, local_treatment as lt, patients as p
from kohorta.plans.base import KEY
from kohorta.plans.medication import Medication, medication
from kohorta.session import buckets_for, durable, together


@dataclass(frozen=True)
class PatientTables:
    wide: DataFrame
    index: DataFrame
    medication: Medication
    radiation_long: DataFrame
    surgery_long: DataFrame
    markers_long: DataFrame


def build_patient_tables(
    tables: Mapping[str, DataFrame],
    marker_names: Sequence[str] | None = None,
    abnormality_names: Sequence[str] | None = None,
) -> PatientTables:
    """All blocks and their merge.

    ``tables`` holds cohort, sample_linkage, patient, history, diagnosis, vital,
    outcome, metastasis, medication, drug_class, radiation, surgery, exam,
    marker, marker_flow, family, imaging, labs and cytogenetics. Columns of the
    wide table come from the data: as many per patient as the patient with most
    events has, one per marker and abnormality. A given list of names must hold
    all that occur.
    """
    cohort = durable(p.cohort(tables["cohort"], tables["sample_linkage"]))
    # Nine blocks read the index diagnosis: written once, it also cuts their lineage.
    index = durable(dx.index_diagnosis(tables["diagnosis"], cohort))

    spark = index.sparkSession

    def radiation():
        rows = durable(lt.radiation(tables["radiation"], cohort, index))
        return rows, lt.radiation_wide(rows)

    def surgery():
        rows = durable(lt.surgery(tables["surgery"], cohort, index))
        return rows, lt.surgery_wide(rows)

    def markers():
        rows = durable(p.markers_long(tables["marker"], tables["marker_flow"], cohort))
        return rows, p.markers_wide(rows, marker_names)

    # The blocks need the cohort and the index diagnosis, not each other.
    drugs_, (rad, rad_wide), (surg, surg_wide), (marks, marks_wide), required, plain = together(
        spark,
        lambda: medication(tables["medication"], tables["drug_class"], cohort, index),
        radiation,
        surgery,
        markers,
        lambda: together(
            spark,
            lambda: p.demographics(tables["patient"], cohort),
            lambda: p.history(tables["history"], cohort),
            lambda: p.vital_status(tables["vital"], cohort),
        ),
        lambda: together(
            spark,
            lambda: p.cytogenetics(tables["cytogenetics"], abnormality_names),
            lambda: p.exam(tables["exam"], cohort, index),
            lambda: dx.outcomes(tables["outcome"], cohort, index),
            lambda: dx.metastasis(tables["metastasis"], cohort, index),
            lambda: p.last_date(tables["imaging"], tables["labs"]),
            lambda: p.family_history(tables["family"], index),
        ),
    )
    cytogenetics, exam, outcomes, metastasis, last_date, family = plain
    wide = merge_on_index(
        index,
        [cohort, *required],
        [cytogenetics, exam, drugs_.wide, rad_wide, surg_wide, outcomes, metastasis, last_date, family, marks_wide],
        KEY,
        buckets_for(index.count()),
    )
    return PatientTables(
        durable(wide),
        index,
        drugs_,
        lt.around_sample(rad, cohort, "AgeAtRadiationStart", "radiation"),
        lt.around_sample(surg, cohort, "AgeAtSurgeryBiopsy", "surgery"),
        marks,
    )
