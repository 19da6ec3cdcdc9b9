"""Small raw clinical tables that hold the awkward cases."""

from kohorta.sources.tables import read_tables

UNKNOWN = "Unknown/Not Applicable"
OVARY = ("C56.9", "Ovary")
BREAST = ("C50.9", "Breast")

SCHEMAS = {
    "cohort": "SourceAvatarKey string, Germline_WES string, Tumor_WES string, `Disease.Type` string, ch_status string, histology_behavior string",
    "sample_linkage": "SourceAvatarKey string, `Tumor.Germline` string, WES string, `Age.At.Specimen.Collection` string, `Disease.Type` string, SpecimenSiteOfCollection string",
    "patient": "AvatarKey string, Race string, Ethnicity string, Sex string",
    "history": "AvatarKey string, SmokingStatus string, AgeAtLastUpdate string, AlcoholUse string, PreExistHPV string",
    "diagnosis": "row_id bigint, AvatarKey string, AgeAtFirstContact string, AgeAtDiagnosis string, YearOfDiagnosis string, PrimaryDiagnosisSiteCode string, PrimaryDiagnosisSite string, Histology string, ClinGroupStage string, PathGroupStage string, GradeClinical string, GradePathological string, CurrentlySeenForPrimaryOrRecurr string, PerformStatusAtDiagnosis string, OtherStagingSystem string, OtherStagingValue string",
    "vital": "AvatarKey string, VitalStatus string, AgeAtLastContact string, AgeAtDeath string",
    "outcome": "row_id bigint, AvatarKey string, ProgRecurInd string, AgeAtProgRecur string, AgeAtCurrentDiseaseStatus string, OutcomesPrimaryDiagnosisSiteCode string, OutcomesPrimaryDiagnosisSite string",
    "metastasis": "row_id bigint, AvatarKey string, MetastaticDiseaseInd string, MetastaticDiseaseSite string, MetastaticDiseaseSiteCode string, AgeAtMetastaticSite string, MetsDzPrimaryDiagnosisSiteCode string, MetsDzPrimaryDiagnosisSite string",
    "medication": "row_id bigint, AvatarKey string, MedicationInd string, Medication string, MedLineRegimen string, AgeAtMedStart string, AgeAtMedStop string, MedPrimaryDiagnosisSiteCode string, MedPrimaryDiagnosisSite string",
    "drug_class": "drug_name string, narrow_drug_class_cytotoxic_only string, general_drug_class string",
    "radiation": "row_id bigint, AvatarKey string, RadiationTherapyInd string, AgeAtRadiationStart string, AgeAtRadiationStop string, RadDose string, RadPrimaryDiagnosisSiteCode string, RadPrimaryDiagnosisSite string",
    "surgery": "row_id bigint, AvatarKey string, SurgeryBiopsyInd string, SiteTherapeutic string, AgeAtSurgeryBiopsy string, PrimaryDiagnosisSiteCode string, PrimaryDiagnosisSite string",
    "exam": "row_id bigint, AvatarKey string, AgeAtPhysicalExam string, BodyWeight string, BodyHeight string, BMI string",
    "marker": "row_id bigint, AvatarKey string, TumorMarkerKey string, TumorMarkerInd string, TMarkerTest string, TMarkerResult string, TMarkerResultValue string, TMarkerValueUOM string, TMarkerRangeIndicator string, TMarkerLowRange string, TMarkerHighRange string, AgeAtTumorMarkerTest string",
    "marker_flow": "AvatarKey string, TumorMarkerKey string, FlowPanelName string, FlowPanelResult string",
    "family": "row_id bigint, AvatarKey string, CancerInFamilyInd string, FamilyRelation string, FamilyRelationAgeGroup string, FamilyRelationPrimarySiteCode string, FamilyRelationPrimarySite string",
    "imaging": "AvatarKey string, AgeAtImageScan string",
    "labs": "AvatarKey string, AgeAtLabResults string",
    "cytogenetics": "AvatarKey string, CytogenAbnormResult string, CytogenAbnormName string, CytogenAbnormInd string",
}


def dx(row, key, contact, age, site, histology="Serous cystadenocarcinoma, NOS", stage=(UNKNOWN, "IIIC"), grade="High grade"):
    return (row, key, contact, age, "2015", *site, histology, *stage, None, grade, None, None, None, None)


# P1: breast at 50, ovary at 60.5 (twice), lung later. P12: one ovary, age capped.
# P2: no qualifying site. P3: one tube, age from first contact. P4: not in the cohort.
ROWS = {
    "cohort": [
        ("P1", "g1", "t1", "GYN", "CH", "84413 Serous cystadenocarcinoma, NOS"),
        ("P12", "g2", "wrong", "GYN", "No CH", "83803 Endometrioid adenocarcinoma, NOS"),
        ("P2", "g3", "t3", "GYN", "CH", None),
        ("P3", "g4", "t4", "GYN", "No CH", "80103 Carcinoma, NOS"),
    ],
    "sample_linkage": [
        ("P1", "Germline", "g1", "62", "GYN", "Blood"),
        ("P1", "Germline", "g1b", "61", "GYN", "Blood"),
        ("P1", "Tumor", "t1", "61.5", "GYN", "Ovary"),
        ("P1", "Tumor", "t1b", "70", "GYN", "Omentum"),
        ("P12", "Germline", "g2", "Age 90 or older", "GYN", "Blood"),
        ("P12", "Tumor", "t2", "88", "GYN", "Ovary"),
        ("P3", "Germline", "g4", UNKNOWN, "GYN", "Blood"),
        ("P3", "Tumor", "t4", "56", "GYN", "Ovary"),
    ],
    "patient": [
        ("P1", "White", "Non-Hispanic", "Female"),
        ("P12", "Samoan", "Spanish surname only", "Female"),
        ("P3", "Other", "Mexican", "Female"),
        ("P4", "Black", "Unknown", "Female"),
    ],
    "history": [("P1", "Current", "70", "Yes", "No"), ("P12", "Never", "90", None, None), ("P3", UNKNOWN, None, None, None)],
    "diagnosis": [
        dx(1, "P1", "60", "60.5", OVARY),
        dx(2, "P1", "61", "60.5", OVARY),
        dx(3, "P1", "50", "50", BREAST, "Carcinoma, NOS"),
        dx(4, "P1", None, "65", ("C34", "Lung"), None),
        dx(5, "P12", "89", "Age 90 or older", OVARY, "Endometrioid adenocarcinoma, NOS", ("IV", "II")),
        dx(6, "P2", "40", "40", BREAST),
        dx(7, "P3", "55", UNKNOWN, ("C57.0", "Fallopian tube"), "Carcinosarcoma, NOS", (None, "I")),
        dx(8, "P4", "55", "55", OVARY),
    ],
    "vital": [("P1", "Dead", "66", "65.5"), ("P12", "Alive", "Age 90 or older", None), ("P3", "Lost to follow-up", "58", UNKNOWN)],
    "outcome": [
        (1, "P1", "No", None, "61", *OVARY),
        (2, "P1", "Progression", "63", None, *OVARY),
        (3, "P1", "Recurrence", "62.5", None, *OVARY),
        (4, "P1", "Progression", "51", None, *BREAST),
        (5, "P12", "No", None, UNKNOWN, *OVARY),
        (6, "P12", "No", None, "90", "", UNKNOWN),
        (7, "P3", "No", None, "57", "", UNKNOWN),
        (8, "P3", "No", None, "56", "", UNKNOWN),
    ],
    "metastasis": [
        (1, "P1", "Yes", "Liver", "C22", "64", *OVARY),
        (2, "P1", "Yes", "Lung", "C34", "63", *OVARY),
        (3, "P12", "No", UNKNOWN, None, UNKNOWN, "", UNKNOWN),
        (4, "P3", "Yes", "Bone", "C41", "57", "", UNKNOWN),
    ],
    "medication": [
        (1, "P1", "Yes", "Carboplatin", "First Line/Regimen", "61", "61.5", *OVARY),
        (2, "P1", "Yes", "Paclitaxel Protein-Bound", UNKNOWN, "61", "61.5", *OVARY),
        (3, "P1", "Yes", "Carboplatin", "First Line/Regimen", "61", "61.5", *OVARY),
        (4, "P1", "Yes", "Liposomal Doxorubicin Hydrochloride", "Second Line/Regimen", "63", "64", *OVARY),
        (5, "P1", "Yes", "Tamoxifen", "First Line/Regimen", "51", "56", *BREAST),
        (6, "P1", "Yes", "Aspirin", UNKNOWN, "61", None, *OVARY),
        (7, "P1", "Yes", "Interferon, NOS", UNKNOWN, "66", None, "C34", "Lung"),
        (8, "P12", "No", None, None, None, None, None, None),
        (9, "P3", "Yes", "Bevacizumab", "Maintenance", "57", "57.5", "", UNKNOWN),
        (10, "P3", "(Migrated) Cannot determine from available documentation", None, None, None, None, None, None),
    ],
    "drug_class": [
        ("carboplatin", "platinum", "cytotoxic_therapy"),
        ("paclitaxel", "taxane", "cytotoxic_therapy"),
        ("doxorubicin hydrochloride", "anthracycline", "cytotoxic_therapy"),
        ("tamoxifen", "hormonal_therapy", "hormonal_therapy"),
        ("bevacizumab", "targeted_therapy", "targeted_therapy"),
    ],
    "radiation": [
        (1, "P1", "Yes", "61.2", "61.3", "50.4", *OVARY),
        (2, "P1", "Yes", "51", "51.2", "bad", *BREAST),
        (3, "P3", "Yes", "56.5", None, None, "", UNKNOWN),
    ],
    "surgery": [
        (1, "P1", "Yes", "No", "60.4", *OVARY),
        (2, "P1", "Yes", "Yes", "60.6", *OVARY),
        (3, "P1", "Yes", "Yes", "50.1", *BREAST),
        (4, "P12", "Yes", "No", "89.5", *OVARY),
        (5, "P12", "Yes", "No", "89.6", *OVARY),
    ],
    "exam": [
        (1, "P1", "60", "70", "165", None),
        (2, "P1", "61.5", "72", None, "26.4"),
        (3, "P1", "50", None, None, None),
        (4, "P3", UNKNOWN, "50", "160", "18"),
    ],
    "marker": [
        (1, "P1", "m1", "Yes", "CA-125", "Value", "10", "U/mL", "Not Available", "5", "35", "61.5"),
        (2, "P1", "m2", "Yes", "CA-125", "Value", "9", "U/mL", "High", "5", "35", "63"),
        (3, "P1", "m3", "Yes", "CA-125", "Value", "1", "U/mL", UNKNOWN, "5", "35", "60"),
        (4, "P1", "m4", "Yes", "HER2Neu by FISH", "Amplified", None, "Unknown", None, None, None, "62"),
        (5, "P12", "m5", "Yes", "HER2Neu by FISH", "Not Amplified", None, None, None, None, None, "90"),
        (6, "P3", "m6", "Yes", "Flow Panel", UNKNOWN, None, None, None, None, None, None),
    ],
    "marker_flow": [("P3", "m6", "CD 4", "Positive"), ("P3", "m6", "CD 8", "Negative")],
    "family": [
        (1, "P1", "Yes", "Mother", "50-59", *OVARY),
        (2, "P1", "Yes", "Sister", None, *OVARY),
        (3, "P1", "Yes", "Mother", "60-69", *OVARY),
        (4, "P1", "Yes", "Aunt", "50-59", *BREAST),
    ],
    "imaging": [("P1", "66.2"), ("P12", UNKNOWN)],
    "labs": [("P1", "64"), ("P1", UNKNOWN), ("P3", "58.5")],
    "cytogenetics": [("P1", "Positive", "t(4;14)", "Yes"), ("P1", "Positive", "t(4;14)", "Yes"), ("P12", "Negative", "del17", "Yes")],
}

MARKERS = ["ca-125", "her2neu", "flow_panel_cd_4", "flow_panel_cd_8"]


def load(spark, folder):
    for name, schema in SCHEMAS.items():
        spark.createDataFrame(ROWS[name], schema).write.parquet(f"{folder}/{name}.parquet")
    return read_tables(spark, folder, SCHEMAS)
