"""The clinical plans on small tables with the awkward cases."""

import clinical_tables as ct
import pytest
from pyspark.sql import functions as F

from kohorta.plans import reports
from kohorta.plans.derived import derive_variables
from kohorta.operators.selectors import clean_names
from kohorta.plans.patient_table import build_patient_tables
from kohorta.session import durable


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    tables = ct.load(spark, str(tmp_path_factory.mktemp("clinical")))
    return build_patient_tables(tables, ct.MARKERS, ["t(4;14)", "del17"])


@pytest.fixture(scope="module")
def wide(built):
    return {r["AvatarKey"]: r.asDict() for r in built.wide.collect()}


@pytest.fixture(scope="module")
def derived(built):
    return durable(derive_variables(built.wide))


def test_one_row_per_patient_with_an_index_diagnosis(wide):
    assert sorted(wide) == ["P1", "P12", "P3"]


def test_samples(wide):
    p1, p12, p3 = wide["P1"], wide["P12"], wide["P3"]
    assert (p1["germline_collection_age"], p1["tumor_collection_age"]) == (62.0, 61.5)
    # The listed tumor sample does not exist, so the pair is not found at all.
    assert p12["germline_collection_age"] is None and p12["tumor_SpecimenSiteOfCollection"] is None
    assert (p3["germline_collection_age"], p3["tumor_collection_age"]) == (None, 56.0)


def test_index_diagnosis(wide):
    p1, p12, p3 = wide["P1"], wide["P12"], wide["P3"]
    assert (p1["number_of_dx"], p1["diagnosis_sequence"], p1["AgeAtDiagnosis"]) == (4, 2, 60.5)
    assert p1["AgeAtFirstContact"] == 60.0
    assert p1["pre_cancer_info"] == "age = 50, site = Breast, histology = Carcinoma, NOS"
    assert p1["post_cancer_info"] == "age = 65, site = Lung, histology = NA"
    assert (p12["AgeAtDiagnosis"], p12["not_real_age"], p12["pre_cancer_info"]) == (90.0, "Age 90 or older", None)
    assert (p3["AgeAtDiagnosis"], p3["dx_age_is_first_contact_age"]) == (55.0, "Yes")


def test_patient_level_tables(wide):
    p1, p12, p3 = wide["P1"], wide["P12"], wide["P3"]
    assert (p1["race_eth"], p1["SmokingStatus"]) == ("White Non-Hispanic", "Ever")
    assert (p12["Race"], p12["Ethnicity"], p12["race_eth"]) == (
        "Native Hawaiian or Other Pacific Islander",
        "Non-Hispanic",
        None,
    )
    assert (p3["Race"], p3["race_eth"], p3["SmokingStatus"]) == ("Unknown", "Hispanic any race", None)
    assert (p1["t(4;14)"], p1["del17"], p12["del17"]) == ("Yes", None, None)
    # Exam at 60 is nearest to 60.5; its body mass index comes from the next exam.
    assert (p1["AgeAtPhysicalExam"], p1["BodyWeight"], p1["BMI"], p1["bmi_cat"]) == (60.0, 70.0, 26.4, "Overweight")
    assert (p3["BMI"], p3["bmi_cat"]) == (18.0, "Underweight")
    assert (p1["age_at_lab"], p12["age_at_lab"], p3["age_at_lab"]) == (66.2, None, 58.5)
    assert (p1["FamilyRelation"], p1["FamilyRelationAgeGroup"]) == ("Mother + Sister", None)


def test_markers(wide):
    p1, p12, p3 = wide["P1"], wide["P12"], wide["P3"]
    assert p1["ca-125_marker_result"] == "10 : WNL (Within Normal Limits)"
    assert p1["ca-125_marker_unit"] == "U/mL"
    assert p1["her2neu_marker_result"] == "Positive"
    assert p12["her2neu_marker_result"] == "by FISH : Not Amplified"
    assert (p3["flow_panel_cd_4_marker_result"], p3["flow_panel_cd_8_marker_result"]) == ("Positive", "Negative")


def test_outcomes_and_metastasis(wide):
    p1, p12, p3 = wide["P1"], wide["P12"], wide["P3"]
    assert (p1["pfs_event"], p1["pfs_age"]) == (1, 62.5)
    assert (p12["pfs_event"], p12["pfs_age"]) == (0, 90.0)
    assert (p3["pfs_event"], p3["pfs_age"]) == (0, 57.0)
    assert (p1["had_metastasis"], p1["AgeAtMetastaticSite"]) == ("Yes", 63.0)
    assert (p12["had_metastasis"], p3["has_metastasis_data"]) == ("No", None)


def test_medication(wide, built):
    p1, p12, p3 = wide["P1"], wide["P12"], wide["P3"]
    assert (p1["AgeAtMedStart_1"], p1["regimen_1"], p1["AgeAtMedStop_1"]) == (61.0, "carboplatin; paclitaxel", "61.5")
    assert (p1["regimen_2"], p1["AgeAtMedStop_2"]) == ("doxorubicin hydrochloride", "64")
    # One stop age is unknown, so the first-ever age is unknown too.
    assert (p1["ever_first_med_age"], p1["had_prior_medication"]) == (None, None)
    assert (p1["received_carboplatin"], p1["received_any_taxane"], p1["received_bev"]) == ("Yes", "Yes", None)
    assert (p12["drugs_ever"], p12["regimen_1"], p12["has_medication_data"]) == ("No", None, "Yes")
    # Unknown site, single diagnosis: accepted; no germline age, so no exposure flag.
    assert (p3["regimen_1"], p3["received_bev"]) == ("bevacizumab", None)
    phases = {
        (r["AvatarKey"], r["Medication"]): (r["drug_sequence_vs_ovarian_drugs"], r["regimen_line"])
        for r in built.medication.phases.collect()
    }
    assert phases["P1", "tamoxifen"] == ("1- drugs for pre cancer", -1)
    assert phases["P1", "interferon"] == ("3- drugs for post cancer", 88)
    assert phases["P1", "aspirin"] == (None, None)
    assert phases["P1", "paclitaxel"] == ("2- drugs for ovarian cancer", 1)


def test_radiation_and_surgery(wide, built):
    p1, p12, p3 = wide["P1"], wide["P12"], wide["P3"]
    assert (p1["age_at_first_radiation"], p1["RadDose_1"], p1["ever_first_rad_age"], p1["had_prior_radiation"]) == (
        61.2,
        50.4,
        51.0,
        "Yes",
    )
    assert (p12["has_radiation_data"], p3["age_at_first_radiation"]) == (None, 56.5)
    assert (p1["surgery_ever"], p1["age_at_first_surgery"], p1["ever_first_surgery_age"]) == ("Yes", 60.6, 50.1)
    assert (p12["surgery_ever"], p12["age_at_first_surgery"]) == ("No", 89.5)
    long = {(r["AvatarKey"], r["radiation_specimen_sequence"]) for r in built.radiation_long.collect()}
    assert ("P1", "radiation before germline") in long and ("P12", None) in long


def test_derived(derived):
    rows = {r["avatar_key"]: r.asDict() for r in derived.collect()}
    p1, p12, p3 = rows["P1"], rows["P12"], rows["P3"]
    assert (p1["stage"], p1["stage_cat"], p12["stage"], p3["stage"]) == ("3", "3-4", "4", "1")
    assert (p1["histotype"], p1["grade"], p1["hgsoc_vs_others"]) == ("Serous", "High", "High-grade serous/carcinosarcoma")
    assert (p12["histotype"], p12["hgsoc_vs_others"]) == ("Endometrioid", "Others")
    assert p3["hgsoc_vs_others"] == "High-grade serous/carcinosarcoma"
    # A code that ends in 0 has no digit run next to its name.
    assert p3["histology_behavior"] == "Carcinoma, NOS" and p12["histology_behavior"] == "Endometrioid adenocarcinoma, NOS"
    assert (p1["age_at_last_contact"], p1["is_agelastcontact_last_date"]) == (65.5, "No")
    assert (p1["first_treatment"], p1["age_at_first_treatment"]) == ("Surgery", 60.6)
    assert (p3["first_treatment"], p12["first_treatment"]) == ("Radiation", "Surgery")
    assert (p1["received_any_platin_any_regimen"], p1["received_bev_any_regimen"]) == ("Yes", "No")
    assert (p12["received_bev_regimen1"], p3["received_bev_regimen1"]) == ("No", "Yes")
    assert (p1["os_event"], p1["os_age"]) == (1, 65.5)
    assert p1["os_time_from_dx_years"] == pytest.approx(5.0)
    assert (p1["pfs_event"], p1["pfs_age"], p12["pfs_event"]) == (1, 62.5, 0)
    assert (p1["metastase_event"], p3["metastase_event"]) == (1, None)
    assert p1["time_dx_to_first_treatment_days"] == pytest.approx(36.5)


def test_reports(derived, built):
    kept = reports.primary_site_rows(derived)
    assert kept.count() == 3
    table = reports.characteristics(
        kept, ["age_at_diagnosis", "race_eth", "vital_status", "os_event"], "ch_status", ["os_event"]
    )
    cells = {(r["stratum"], r["variable"], r["level"]): r for r in table.collect()}
    assert cells["Overall", "age_at_diagnosis", None]["median"] == 60.5
    assert cells["No CH", "vital_status", "Alive"]["percent"] == 50.0
    assert cells["Overall", "race_eth", "White Non-Hispanic"]["n_missing"] == 1
    names = {r["variable"]: r["test"] for r in reports.tests(kept, ["age_at_diagnosis", "vital_status"]).collect()}
    assert names["age_at_diagnosis"] == "rank-sum"
    assert reports.regimen_frequency(kept).count() == 3
    assert reports.regimens_per_patient(kept).count() == 2
    ever = {(r["stratum"], r["level"]): r["n"] for r in reports.ever_received(kept, "Carboplatin").collect()}
    assert ever == {("CH", "Yes"): 1, ("No CH", "No"): 1, ("Overall", "Yes"): 1, ("Overall", "No"): 1}
    curve = reports.survival_curves(kept, "os").collect()
    assert {r["ch_status"] for r in curve} == {"CH", "No CH"}
    assert reports.survival_difference(kept, "os")["df"] == 1
    assert reports.drugs_without_class(built.medication.phases).filter(F.col("level") == "aspirin").count() == 1
    by_phase = reports.drugs_before_sample(built.medication.phases, by_phase=True)
    assert {r["stratum"] for r in by_phase.collect()} == {"1- drugs for pre cancer", "2- drugs for ovarian cancer"}
    assert reports.marker_characteristics(kept, "ca_125_marker_unit", "flow_panel_cd_8_marker_result").count() > 0
    assert reports.histology_discrepancy(clean_names(built.wide)).count() == 1
