"""Raw clinical tables derived from the given tables.

Each text is valid in Spark and in DuckDB: orders play diagnoses, outcomes,
surgeries and the like (by priority), lineitems play drug rows, events markers.
"Ages" are day numbers written as text, with the sentinels put in by price.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kohorta.catalog import views as v
from kohorta.sources.tables import read_table


def _age(text: str, low: int = 15000) -> str:
    return (
        f"CASE WHEN o_totalprice < {low} THEN 'Unknown/Not Applicable' WHEN o_totalprice > 490000 "
        f"THEN 'Age 90 or older' ELSE {text} END"
    )


_DAY = "CAST(day AS STRING) || '.5'"
_KEY = "o_orderkey AS row_id, 'P' || o_custkey AS AvatarKey"


def _site(prefix: str, unknown: str = "P") -> str:
    """Site columns of an event table: ovary, tube, or unknown for one order status."""
    return (
        f"CASE o_orderstatus WHEN '{unknown}' THEN '' WHEN 'F' THEN 'C56' ELSE 'C57' END AS {prefix}PrimaryDiagnosisSiteCode, "
        f"CASE o_orderstatus WHEN '{unknown}' THEN 'Unknown/Not Applicable' WHEN 'F' THEN 'Ovary' ELSE 'Fallopian tube' END "
        f"AS {prefix}PrimaryDiagnosisSite"
    )


RAW: dict[str, str] = {
    "raw_cohort": """
        SELECT 'P' || c_custkey AS AvatarKey, 'G' || c_custkey AS Germline_WES,
               CASE WHEN c_acctbal < 500 THEN 'none' ELSE 'T' || c_custkey END AS Tumor_WES, c_mktsegment AS DiseaseType,
               CASE WHEN c_nationkey < 12 THEN 'CH' ELSE 'No CH' END AS ch_status,
               CASE c_nationkey WHEN 1 THEN '84413 Serous cystadenocarcinoma, NOS' WHEN 2 THEN '83803 Endometrioid adenocarcinoma, NOS'
                    WHEN 3 THEN '84806 Pseudomyxoma peritonei' WHEN 4 THEN '80100 Carcinoma'
                    ELSE '83103 Clear cell adenocarcinoma, NOS' END AS histology_behavior
        FROM {customer} WHERE c_mktsegment <> 'MACHINERY'""",
    "raw_linkage": """
        SELECT 'P' || c_custkey AS AvatarKey, 'Germline' AS Kind, 'G' || c_custkey AS WES,
               CASE WHEN c_acctbal > 9500 THEN 'Age 90 or older' WHEN c_acctbal < 200 THEN 'Unknown/Not Applicable'
                    ELSE CAST(CAST(floor(c_acctbal / 4) AS BIGINT) AS STRING) END AS collection_age,
               c_mktsegment AS Disease, 'Blood' AS collection_site
        FROM {customer}
        UNION ALL
        SELECT 'P' || c_custkey, 'Tumor', 'T' || c_custkey, CAST(CAST(floor(c_acctbal / 5) AS BIGINT) AS STRING),
               CASE WHEN c_nationkey = 7 THEN 'other' ELSE c_mktsegment END, 'Ovary'
        FROM {customer} WHERE c_nationkey <> 9""",
    "raw_patient": """
        SELECT 'P' || c_custkey AS AvatarKey,
               CASE c_nationkey WHEN 0 THEN 'White' WHEN 1 THEN 'Black' WHEN 2 THEN 'American Indian, Aleutian' WHEN 3 THEN 'Other Asian, NOS'
                    WHEN 4 THEN 'Korean' WHEN 5 THEN 'Samoan' WHEN 6 THEN 'Tongan or other' WHEN 7 THEN 'Unknown race' WHEN 8 THEN 'Other'
                    WHEN 9 THEN NULL WHEN 10 THEN 'Melanesian' ELSE 'White' END AS Race,
               CASE WHEN c_acctbal < 1000 THEN 'Unknown whether Spanish' WHEN c_acctbal < 2000 THEN 'Mexican' WHEN c_acctbal < 2500 THEN NULL
                    WHEN c_acctbal < 3000 THEN 'Spanish surname only' ELSE 'Non-Hispanic; Non-Spanish' END AS Ethnicity
        FROM {customer}""",
    "raw_history": """
        SELECT 'P' || c_custkey AS AvatarKey, CASE WHEN c_acctbal < 3000 THEN 'Never' WHEN c_acctbal < 6000 THEN 'Current'
               WHEN c_acctbal < 8000 THEN 'Ever (former)' ELSE 'Unknown' END AS SmokingStatus,
               '70' AS AgeAtLastUpdate, 'Yes' AS AlcoholUse, 'No' AS PreExistHPV FROM {customer}""",
    "raw_dx": f"""
        SELECT {_KEY}, {_age("CAST(day + 3 AS STRING)", 5000)} AS AgeAtFirstContact, {_age(_DAY, 25000)} AS AgeAtDiagnosis,
               CAST(day AS STRING) AS YearOfDiagnosis,
               CASE WHEN o_orderpriority = '2-HIGH' THEN 'C50' WHEN o_orderstatus = 'F' THEN 'C56' WHEN o_orderstatus = 'O' THEN 'C57' ELSE 'C578' END
                   AS PrimaryDiagnosisSiteCode,
               CASE WHEN o_orderpriority = '2-HIGH' THEN 'Breast' WHEN o_orderstatus = 'F' THEN 'Ovary' WHEN o_orderstatus = 'O' THEN 'Fallopian tube'
                    ELSE 'Overlapping lesion of female genital organs' END AS PrimaryDiagnosisSite,
               CASE WHEN o_totalprice > 300000 THEN 'Serous cystadenocarcinoma, NOS' WHEN o_totalprice > 200000 THEN 'Endometrioid adenocarcinoma, NOS'
                    WHEN o_totalprice > 100000 THEN 'Carcinosarcoma, NOS' WHEN o_totalprice > 60000 THEN NULL ELSE 'Other' END AS Histology,
               CASE WHEN o_totalprice > 400000 THEN 'IVB' WHEN o_totalprice > 250000 THEN 'III' WHEN o_totalprice > 90000 THEN 'IA'
                    ELSE 'Unknown' END AS ClinGroupStage,
               CASE o_orderstatus WHEN 'F' THEN 'II' WHEN 'O' THEN NULL ELSE 'IIIC' END AS PathGroupStage,
               'x' AS GradeClinical,
               CASE WHEN day < 800 THEN 'Low grade' WHEN day < 1600 THEN 'Poorly differentiated' ELSE 'Unknown/Not Applicable' END AS GradePathological,
               'P' AS CurrentlySeenForPrimaryOrRecurr, 'ECOG 1' AS PerformStatusAtDiagnosis, 'FIGO' AS OtherStagingSystem, 'v' AS OtherStagingValue
        FROM {{ord_n}} WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
    "raw_vital": """
        SELECT 'P' || o_custkey AS AvatarKey,
               CASE WHEN max(o_totalprice) > 480000 THEN 'Dead' WHEN max(o_totalprice) > 440000 THEN 'Alive' ELSE 'Lost to follow-up' END AS VitalStatus,
               CASE WHEN min(o_totalprice) < 3000 THEN 'Unknown/Not Applicable' ELSE CAST(max(day) AS STRING) END AS AgeAtLastContact,
               CASE WHEN max(o_totalprice) > 480000 THEN CAST(max(CASE WHEN o_totalprice < 400000 THEN day END) + 40 AS STRING) END AS AgeAtDeath
        FROM {ord_n} GROUP BY o_custkey""",
    "raw_outcome": f"""
        SELECT {_KEY}, CASE WHEN o_totalprice > 350000 THEN 'Progression' WHEN o_totalprice > 250000 THEN 'Recurrence'
                     WHEN o_totalprice > 100000 THEN 'No' ELSE 'Unknown/Not Applicable' END AS ProgRecurInd,
               CASE WHEN o_totalprice > 300000 THEN {_age(_DAY)} END AS AgeAtProgRecur,
               CASE WHEN o_totalprice < 280000 THEN {_age(_DAY, 60000)} END AS AgeAtCurrentDiseaseStatus, {_site("Outcomes")}
        FROM {{ord_n}} WHERE o_orderpriority = '3-MEDIUM'""",
    "raw_mets": f"""
        SELECT {_KEY}, CASE WHEN o_totalprice > 200000 THEN 'Yes' ELSE 'No' END AS MetastaticDiseaseInd,
               CASE WHEN o_totalprice < 250000 THEN 'Unknown/Not Applicable' ELSE 'Lung' END AS MetastaticDiseaseSite, 'C34' AS MetastaticDiseaseSiteCode,
               {_age(_DAY, 80000)} AS AgeAtMetastaticSite, {_site("MetsDz")}
        FROM {{ord_n}} WHERE o_orderpriority = '4-NOT SPECIFIED'""",
    "raw_rad": f"""
        SELECT {_KEY}, CASE WHEN o_totalprice < 40000 THEN '(Migrated) Cannot determine from available documentation' WHEN o_totalprice < 90000 THEN 'No'
                     ELSE 'Yes' END AS RadiationTherapyInd,
               {_age(_DAY, 100000)} AS AgeAtRadiationStart, {_age("CAST(day + 9 AS STRING)")} AS AgeAtRadiationStop,
               CASE WHEN o_totalprice > 300000 THEN '50.4' WHEN o_totalprice > 200000 THEN 'see note' END AS RadDose, {_site("Rad")}
        FROM {{ord_n}} WHERE o_orderpriority = '4-NOT SPECIFIED'""",
    "raw_surg": f"""
        SELECT {_KEY}, CASE WHEN o_totalprice < 20000 THEN '(Migrated) Cannot determine from available documentation' ELSE 'Yes' END AS SurgeryBiopsyInd,
               CASE WHEN o_totalprice > 300000 THEN 'Yes' WHEN o_totalprice > 60000 THEN 'No' ELSE 'Unknown/Not Applicable' END AS SiteTherapeutic,
               {_age(_DAY, 70000)} AS AgeAtSurgeryBiopsy, {_site("")}
        FROM {{ord_n}} WHERE o_orderpriority = '5-LOW'""",
    "raw_exam": f"""
        SELECT {_KEY}, {_age(_DAY, 60000)} AS AgeAtPhysicalExam,
               CASE WHEN o_totalprice > 200000 THEN CAST(CAST(floor(o_totalprice / 5000) AS BIGINT) AS STRING) END AS BodyWeight,
               CASE WHEN o_totalprice < 400000 THEN '165' ELSE 'n/a' END AS BodyHeight,
               CASE WHEN o_totalprice > 150000 THEN CAST(CAST(floor(o_totalprice / 12000) AS BIGINT) AS STRING) || '.4' END AS BMI
        FROM {{ord_n}} WHERE o_orderpriority IN ('3-MEDIUM', '5-LOW')""",
    "raw_marker": """
        SELECT event_id AS row_id, 'P' || user_id AS AvatarKey, 'm' || event_id AS TumorMarkerKey, 'Yes' AS TumorMarkerInd,
               CASE event_type WHEN 'click' THEN 'CA-125' WHEN 'view' THEN 'HER2Neu by FISH' WHEN 'purchase' THEN 'HER2Neu by IHC'
                    WHEN 'signup' THEN 'Estrogen receptor (ER)' ELSE 'Flow Panel' END AS TMarkerTest,
               CASE event_type WHEN 'click' THEN 'Value' WHEN 'view' THEN CASE WHEN value < 50 THEN 'Amplified' ELSE 'Not Amplified' END
                    WHEN 'error' THEN 'Unknown/Not Applicable' ELSE CASE WHEN value < 20 THEN 'Positive' ELSE 'Negative' END END AS TMarkerResult,
               CASE WHEN event_type = 'click' THEN CAST(CAST(floor(value) AS BIGINT) AS STRING) END AS TMarkerResultValue,
               CASE WHEN value < 5 THEN 'Unknown' ELSE 'U/mL' END AS TMarkerValueUOM,
               CASE WHEN value < 15 THEN 'Not Available' WHEN value < 25 AND event_type = 'click' THEN 'High' ELSE 'Unknown/Not Applicable' END AS TMarkerRangeIndicator,
               '9' AS TMarkerLowRange, '100' AS TMarkerHighRange,
               CASE WHEN value > 150 THEN 'Unknown/Not Applicable' ELSE CAST(day * 60 AS STRING) END AS AgeAtTumorMarkerTest
        FROM {ev}""",
    "raw_flow": """
        SELECT 'P' || user_id AS AvatarKey, 'm' || event_id AS TumorMarkerKey, CASE WHEN value < 30 THEN 'CD 4' ELSE 'CD 8' END AS FlowPanelName,
               CASE WHEN value < 60 THEN 'Positive' ELSE 'Negative' END AS FlowPanelResult
        FROM {ev} WHERE event_type = 'error'""",
    "raw_family": f"""
        SELECT {_KEY}, 'Yes' AS CancerInFamilyInd, CASE WHEN o_totalprice > 300000 THEN 'Mother' WHEN o_totalprice > 150000 THEN 'Sister' ELSE 'Aunt' END AS FamilyRelation,
               CASE WHEN o_totalprice > 50000 THEN '50-59' END AS FamilyRelationAgeGroup,
               CASE o_orderstatus WHEN 'P' THEN '' WHEN 'F' THEN 'C56' ELSE 'C57' END AS FamilyRelationPrimarySiteCode,
               CASE o_orderstatus WHEN 'P' THEN 'Unknown' WHEN 'F' THEN 'Ovary' ELSE 'Fallopian tube' END AS FamilyRelationPrimarySite
        FROM {{ord_n}} WHERE o_orderpriority IN ('2-HIGH', '3-MEDIUM')""",
    "raw_imaging": f"SELECT 'P' || o_custkey AS AvatarKey, {_age(_DAY)} AS AgeAtImageScan FROM {{ord_n}} WHERE o_orderstatus = 'F'",
    "raw_labs": f"SELECT 'P' || o_custkey AS AvatarKey, {_age(_DAY, 200000)} AS AgeAtLabResults FROM {{ord_n}} WHERE o_orderstatus = 'O'",
    "raw_cyto": """
        SELECT DISTINCT 'P' || user_id AS AvatarKey, CASE WHEN value < 50 THEN 'Positive' ELSE 'Negative' END AS CytogenAbnormResult,
               event_type AS CytogenAbnormName, 'Yes' AS CytogenAbnormInd FROM {ev} WHERE value > 45""",
    "raw_med": """
        SELECT l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber || '-' || CAST(l_quantity AS BIGINT) || '-'
                   || CAST(floor(l_extendedprice * 100) AS BIGINT) AS row_id, 'P' || o_custkey AS AvatarKey,
               CASE WHEN l_quantity < 3 THEN '(Migrated) Cannot determine from available documentation' WHEN l_quantity < 6 THEN 'No' ELSE 'Yes' END AS MedicationInd,
               CASE WHEN l_returnflag = 'A' THEN p_name || ' Sulfate' WHEN l_returnflag = 'R' THEN upper(p_name) ELSE p_name END AS Medication,
               CASE l_linenumber WHEN 1 THEN 'First Line/Regimen' WHEN 2 THEN 'Second Line/Regimen' WHEN 3 THEN 'Neoadjuvant Regimen'
                    WHEN 4 THEN 'Maintenance' WHEN 5 THEN 'Palliative' WHEN 6 THEN 'Unknown/Not Reported' ELSE 'Unknown/Not Applicable' END AS MedLineRegimen,
               CASE WHEN l_quantity > 48 THEN 'Unknown/Not Applicable' ELSE CAST(day AS STRING) END AS AgeAtMedStart,
               CASE WHEN l_tax = 0 THEN NULL ELSE CAST(day + l_linenumber AS STRING) || '.5' END AS AgeAtMedStop,
               CASE o_orderstatus WHEN 'P' THEN '' WHEN 'F' THEN 'C56' ELSE 'C57' END AS MedPrimaryDiagnosisSiteCode,
               CASE o_orderstatus WHEN 'P' THEN 'Unknown/Not Applicable' WHEN 'F' THEN 'Ovary' ELSE 'Fallopian tube' END AS MedPrimaryDiagnosisSite
        FROM {lineitem} JOIN {ord_n} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey""",
    "raw_drug": """
        SELECT p_name AS drug_name, min(p_type) AS narrow_drug_class_cytotoxic_only, min(p_brand) AS general_drug_class
        FROM {part} WHERE p_name LIKE '%bolt' OR p_name LIKE '%ring' GROUP BY p_name""",
}

_TABLES = ("customer", "lineitem", "part")

for _name, _text in RAW.items():
    _plain = {t: t for t in (*_TABLES, "ord_n", "ev")}
    v.SQL_VIEWS[_name] = _text.format(**_plain).replace("STRING", "VARCHAR")


def raw(spark: SparkSession, d: str, name: str) -> DataFrame:
    """One raw table, as Spark reads it."""
    text = RAW[name]
    frames = {t: read_table(spark, d, t) for t in _TABLES if f"{{{t}}}" in text}
    if "{ord_n}" in text:
        frames["ord_n"] = v.ord_n(spark, d)
    if "{ev}" in text:
        frames["ev"] = v.ev(spark, d)
    return spark.sql(text, **frames)
