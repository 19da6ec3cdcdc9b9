"""The clinical plans, block by block, on raw tables derived from the given ones.

The SQL states each rule directly (number, fill, keep the first row, form all
pairs), the plans reach it by aggregates and look-ups; both must agree.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kohorta.catalog import views as v
from kohorta.catalog.raw import raw
from kohorta.catalog.registry import query
from kohorta.functions import clinical as c
from kohorta.functions.exprs import any_contains, yes_no
from kohorta.operators.reshape import occurrence_rows, union_by_name
from kohorta.plans import diagnosis as dx, local_treatment as lt, medication as md, patients as p, reports
from kohorta.plans.base import KEY
from kohorta.plans.derived import derive_variables
from kohorta.plans.patient_table import build_patient_tables
from kohorta.plans.therapy import LINE_CODES
from kohorta.session import durable


def _num(column: str) -> str:
    return (
        f"CASE {column} WHEN 'Age 90 or older' THEN 90.0::DOUBLE WHEN 'Unknown/Not Applicable' THEN NULL "
        f"ELSE try_cast({column} AS DOUBLE) END"
    )


def _fmt(column: str) -> str:
    return f"CASE WHEN {column} = floor({column}) THEN CAST(CAST({column} AS BIGINT) AS VARCHAR) ELSE CAST({column} AS VARCHAR) END"


def _min_strict(column: str, where: str = "TRUE") -> str:
    return f"CASE WHEN count({column}) FILTER ({where}) = count(*) FILTER ({where}) THEN min({column}) FILTER ({where}) END"


_IN_COHORT = "AvatarKey IN (SELECT AvatarKey FROM raw_cohort)"
_SITES = ", ".join(f"'{s}'" for s in c.INDEX_SITES)
_INDEX_SITE, _INDEX_HISTOLOGY = c.INDEX_SITE_WITH_HISTOLOGY


def _mine(table: str, prefix: str) -> str:
    return (
        f"SELECT r.*, 0 AS src FROM {table} r JOIN c_index i ON r.AvatarKey = i.AvatarKey "
        f"AND r.{prefix}PrimaryDiagnosisSiteCode = i.PrimaryDiagnosisSiteCode AND r.{prefix}PrimaryDiagnosisSite = i.PrimaryDiagnosisSite"
    )


def _rescued(table: str, where: str) -> str:
    return (
        f"SELECT r.*, 1 AS src FROM {table} r JOIN c_index i ON r.AvatarKey = i.AvatarKey AND i.number_of_dx = 1 WHERE {where}"
    )


v.SQL_VIEWS |= {
    "c_cohort": f"""
        SELECT c.*, {_num('g_age')} AS germline_collection_age, {_num('t_age')} AS tumor_collection_age
        FROM raw_cohort c LEFT JOIN (
            SELECT coalesce(g.k, t.k) AS k, gw, tw, dis, g_age, t_age
            FROM (SELECT AvatarKey AS k, WES AS gw, collection_age AS g_age FROM raw_linkage WHERE Kind = 'Germline') g
            FULL JOIN (SELECT AvatarKey AS k, WES AS tw, Disease AS dis, collection_age AS t_age FROM raw_linkage WHERE Kind = 'Tumor') t
              ON g.k = t.k) q
          ON c.AvatarKey = q.k AND c.Germline_WES IS NOT DISTINCT FROM gw AND c.Tumor_WES IS NOT DISTINCT FROM tw
         AND c.DiseaseType IS NOT DISTINCT FROM dis""",
    "c_index": f"""
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY AvatarKey ORDER BY diagnosis_sequence) AS nth FROM (
                SELECT *,
                       string_agg(CASE WHEN is_first = 'No' AND first_age > age THEN txt END, '; ') OVER w AS pre_cancer_info,
                       string_agg(CASE WHEN is_first = 'No' AND first_age <= age THEN txt END, '; ') OVER w AS post_cancer_info
                FROM (
                    SELECT *, CASE WHEN first_age = own_age THEN 'Yes' WHEN first_age IS NOT NULL THEN 'No' END AS is_first,
                           'age = ' || coalesce({_fmt('age')}, 'NA') || ', site = ' || coalesce(PrimaryDiagnosisSite, 'NA')
                               || ', histology = ' || coalesce(Histology, 'NA') AS txt
                    FROM (
                        SELECT *, max(had) OVER (PARTITION BY AvatarKey) AS any_had, max(group_first) OVER (PARTITION BY AvatarKey) AS first_age
                        FROM (
                            SELECT *, CASE WHEN had = 'Yes' THEN age END AS own_age,
                                   first_value(CASE WHEN had = 'Yes' THEN age END) OVER (PARTITION BY AvatarKey, had ORDER BY diagnosis_sequence) AS group_first
                            FROM (
                                SELECT *, count(*) OVER (PARTITION BY AvatarKey) AS number_of_dx,
                                       row_number() OVER (PARTITION BY AvatarKey ORDER BY age NULLS LAST, row_id) AS diagnosis_sequence,
                                       CASE WHEN PrimaryDiagnosisSite IN ({_SITES}) THEN 'Yes'
                                            WHEN PrimaryDiagnosisSite = '{_INDEX_SITE}' AND Histology = '{_INDEX_HISTOLOGY}' THEN 'Yes' END AS had
                                FROM (SELECT *, coalesce({_num('AgeAtDiagnosis')}, {_num('AgeAtFirstContact')}) AS age,
                                             CASE WHEN {_num('AgeAtDiagnosis')} IS NULL AND {_num('AgeAtFirstContact')} IS NOT NULL THEN 'Yes' END AS imputed
                                      FROM raw_dx WHERE {_IN_COHORT}))))
                    WHERE any_had = 'Yes')
                WINDOW w AS (PARTITION BY AvatarKey ORDER BY diagnosis_sequence ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
            WHERE is_first = 'Yes')
        WHERE nth = 1""",
    "c_outcome_rows": f"""
        SELECT *, coalesce({_num('AgeAtProgRecur')}, {_num('AgeAtCurrentDiseaseStatus')}) AS checked,
               CASE WHEN ProgRecurInd IN ('Progression', 'Recurrence') THEN 1 WHEN ProgRecurInd = 'No' THEN 0 END AS evt
        FROM raw_outcome WHERE {_IN_COHORT}""",
    "c_outcome_mine": _mine("c_outcome_rows", "Outcomes"),
    "c_outcomes": f"""
        SELECT AvatarKey, evt AS pfs_event, CASE evt WHEN 1 THEN f WHEN 0 THEN l END AS pfs_age, OutcomesPrimaryDiagnosisSite
        FROM (SELECT *, row_number() OVER w AS nth, first_value(checked) OVER w AS f,
                     last_value(checked IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS l
              FROM (SELECT * FROM c_outcome_mine UNION ALL
                    {_rescued('c_outcome_rows', '''r.OutcomesPrimaryDiagnosisSite = 'Unknown/Not Applicable'
                        AND (r.AvatarKey NOT IN (SELECT AvatarKey FROM c_outcome_mine)
                          OR r.AvatarKey IN (SELECT AvatarKey FROM c_outcome_mine WHERE checked IS NULL))''')})
              WINDOW w AS (PARTITION BY AvatarKey ORDER BY evt DESC NULLS LAST, checked NULLS LAST, src, row_id))
        WHERE nth = 1""",
    "c_mets_rows": f"SELECT *, {_num('AgeAtMetastaticSite')} AS age FROM raw_mets WHERE {_IN_COHORT}",
    "c_mets_mine": _mine("c_mets_rows", "MetsDz"),
    "c_metastasis": f"""
        SELECT AvatarKey, MetastaticDiseaseInd AS had_metastasis, age AS AgeAtMetastaticSite, MetsDzPrimaryDiagnosisSite, 'Yes' AS has_metastasis_data
        FROM (SELECT *, row_number() OVER (PARTITION BY AvatarKey ORDER BY src, age NULLS LAST, MetsDzPrimaryDiagnosisSite, row_id) AS nth
              FROM (SELECT * FROM c_mets_mine UNION ALL
                    {_rescued('c_mets_rows', '''r.MetastaticDiseaseSite = 'Unknown/Not Applicable'
                        AND r.AvatarKey NOT IN (SELECT AvatarKey FROM c_mets_mine)''')}))
        WHERE nth = 1""",
    "c_rad_rows": f"""
        SELECT *, {_num('AgeAtRadiationStart')} AS start, {_num('AgeAtRadiationStop')} AS stop, try_cast(RadDose AS DOUBLE) AS dose,
               CASE WHEN count({_num('AgeAtRadiationStart')}) OVER w = count(*) OVER w THEN min({_num('AgeAtRadiationStart')}) OVER w END AS ever_first
        FROM raw_rad WHERE {_IN_COHORT} AND RadiationTherapyInd NOT LIKE '(Migrated)%' WINDOW w AS (PARTITION BY AvatarKey)""",
    "c_rad_mine": _mine("c_rad_rows", "Rad"),
    "c_rad": f"""
        SELECT * FROM c_rad_mine UNION ALL
        {_rescued('c_rad_rows', "r.RadPrimaryDiagnosisSite = 'Unknown/Not Applicable' AND r.AvatarKey NOT IN (SELECT AvatarKey FROM c_rad_mine)")}""",
    "c_surg_rows": f"""
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY AvatarKey, SiteTherapeutic ORDER BY row_id) AS nth,
                   max(CASE WHEN SiteTherapeutic = 'Yes' THEN 'Yes' END) OVER (PARTITION BY AvatarKey) AS any_yes,
                   CASE WHEN SiteTherapeutic = 'Yes' AND count(age) OVER g = count(*) OVER g THEN min(age) OVER g END AS ever_first
            FROM (SELECT *, {_num('AgeAtSurgeryBiopsy')} AS age FROM raw_surg WHERE {_IN_COHORT} AND SurgeryBiopsyInd NOT LIKE '(Migrated)%')
            WINDOW g AS (PARTITION BY AvatarKey, SiteTherapeutic))
        WHERE SiteTherapeutic = 'Yes' OR (SiteTherapeutic = 'No' AND nth = 1 AND any_yes IS NULL)""",
    "c_surg_mine": _mine("c_surg_rows", ""),
    "c_surg": f"""
        SELECT * FROM c_surg_mine UNION ALL
        {_rescued('c_surg_rows', "r.AvatarKey NOT IN (SELECT AvatarKey FROM c_surg_mine)")}""",
    "c_drugs": """
        SELECT k AS drug_name, narrow, general FROM (
            SELECT *, row_number() OVER (PARTITION BY k ORDER BY narrow, general) AS nth FROM (
                SELECT lower(drug_name) AS k, narrow_drug_class_cytotoxic_only AS narrow, general_drug_class AS general FROM raw_drug UNION ALL """
    + " UNION ALL ".join(f"SELECT '{n.lower()}', '{a}', '{b}'" for n, a, b in c.ADDED_DRUG_CLASSES)
    + ")) WHERE nth = 1",
    "c_med": f"""
        SELECT AvatarKey, MedicationInd, med, start, stop, site_code, site, ever_first, narrow, general, chemo, coalesce(filled, line) AS line, min(row_id) AS row_id
        FROM (SELECT *, coalesce(
                     first_value(known IGNORE NULLS) OVER (PARTITION BY AvatarKey, start ORDER BY row_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
                     last_value(known IGNORE NULLS) OVER (PARTITION BY AvatarKey, start ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS filled
              FROM (SELECT m.*, d.narrow, d.general, CASE WHEN d.narrow IS NOT NULL OR med = 'chemo, nos' THEN 'Ever' END AS chemo,
                           CASE WHEN line NOT IN ('Unknown/Not Applicable', 'Unknown/Not Reported') THEN line END AS known
                    FROM (SELECT *, lower(regexp_replace(Medication, '{c.DRUG_SUFFIXES}', '')) AS med,
                                 CASE WHEN count(start) OVER w = count(*) OVER w AND count(stop) OVER w = count(*) OVER w
                                      THEN least(min(start) OVER w, min(stop) OVER w) END AS ever_first
                          FROM (SELECT row_id, AvatarKey, MedicationInd, Medication, MedLineRegimen AS line, {_num('AgeAtMedStart')} AS start,
                                       {_num('AgeAtMedStop')} AS stop, MedPrimaryDiagnosisSiteCode AS site_code, MedPrimaryDiagnosisSite AS site
                                FROM raw_med WHERE {_IN_COHORT} AND MedicationInd NOT LIKE '(Migrated)%')
                          WINDOW w AS (PARTITION BY AvatarKey)) m
                    LEFT JOIN c_drugs d ON m.med = d.drug_name))
        GROUP BY ALL""",
    "c_codes": "SELECT * FROM (VALUES " + ", ".join(f"('{t}', {n})" for t, n in LINE_CODES.items()) + ") AS t(label, code)",
    "c_chemo": """
        SELECT *, coalesce(CASE WHEN start IS NOT NULL THEN dense_rank() OVER (PARTITION BY AvatarKey, site, start IS NULL ORDER BY start, code) END, code) AS rank0
        FROM c_med JOIN c_codes ON line = label WHERE MedicationInd = 'Yes' AND chemo IS NOT NULL""",
    "c_on_site": """
        SELECT r.*, 0 AS src FROM c_chemo r JOIN c_index i ON r.AvatarKey = i.AvatarKey
         AND r.site_code = i.PrimaryDiagnosisSiteCode AND r.site = i.PrimaryDiagnosisSite""",
    "c_line_mine": f"""
        SELECT * FROM c_on_site UNION ALL
        {_rescued('c_chemo', '''r.site = 'Unknown/Not Applicable' AND r.AvatarKey IN (
            SELECT AvatarKey FROM c_on_site GROUP BY AvatarKey
            HAVING count(*) FILTER (line IN ('Neoadjuvant Regimen', 'First Line/Regimen')) = 0)''')}""",
    "c_unique": f"""
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY AvatarKey, start, med, stop ORDER BY src, rank0 NULLS LAST, row_id) AS nth FROM (
            SELECT * FROM c_line_mine UNION ALL
            SELECT * REPLACE (2 AS src) FROM ({_rescued('c_chemo', '''r.site = 'Unknown/Not Applicable'
                AND r.AvatarKey NOT IN (SELECT AvatarKey FROM c_line_mine)''')}) UNION ALL
            SELECT * REPLACE ('Never' AS chemo), NULL, NULL, NULL, -1 FROM c_med WHERE MedicationInd = 'No')) WHERE nth = 1""",
    "c_lines": """
        SELECT u.*, coalesce(CASE WHEN start IS NOT NULL THEN dense_rank() OVER (PARTITION BY AvatarKey, site, start IS NULL ORDER BY start, k.code) END, k.code)
                   AS regimen_line
        FROM (SELECT * EXCLUDE (line, label, code), coalesce(
                  first_value(known IGNORE NULLS) OVER (PARTITION BY AvatarKey, start ORDER BY src, rank0 NULLS LAST, row_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
                  last_value(known IGNORE NULLS) OVER (PARTITION BY AvatarKey, start ORDER BY src, rank0 NULLS LAST, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                  line) AS line
              FROM (SELECT *, CASE WHEN line NOT IN ('Unknown/Not Applicable', 'Unknown/Not Reported') THEN line END AS known FROM c_unique)) u
        JOIN c_codes k ON u.line = k.label""",
    "c_inner": """
        SELECT AvatarKey, regimen_line, start, MedicationInd, ever_first, stop,
               CASE WHEN count(med) = count(*) THEN string_agg(med, '; ' ORDER BY src, rank0 NULLS LAST, row_id) END AS med,
               CASE WHEN count(narrow) = count(*) THEN string_agg(narrow, '; ' ORDER BY src, rank0 NULLS LAST, row_id) END AS narrow
        FROM c_lines GROUP BY AvatarKey, regimen_line, start, MedicationInd, ever_first, stop""",
    "c_long": f"""
        SELECT g.*, CASE WHEN start <= germline_collection_age THEN 'regimen before germline'
                         WHEN start > germline_collection_age THEN 'regimen after germline' END AS seq
        FROM (SELECT AvatarKey, regimen_line, start, MedicationInd, ever_first,
                     CASE WHEN count(med) = count(*) THEN string_agg(med, '; ' ORDER BY stop NULLS LAST) END AS regimen_drugs,
                     CASE WHEN count(narrow) = count(*) THEN string_agg(narrow, '; ' ORDER BY stop NULLS LAST) END AS narrow,
                     CASE WHEN count(stop) = count(*) THEN string_agg({_fmt('stop')}, '; ' ORDER BY stop) END AS stop
              FROM c_inner GROUP BY AvatarKey, regimen_line, start, MedicationInd, ever_first) g
        LEFT JOIN c_cohort c ON g.AvatarKey = c.AvatarKey""",
}


def _cohort(spark, d):
    return durable(p.cohort(raw(spark, d, "raw_cohort"), raw(spark, d, "raw_linkage")))


def _index(spark, d):
    cohort = _cohort(spark, d)
    return cohort, durable(dx.index_diagnosis(raw(spark, d, "raw_dx"), cohort))


@query(
    "clinical_cohort",
    "SELECT AvatarKey, ch_status, germline_collection_age, tumor_collection_age FROM c_cohort",
)
def clinical_cohort(spark, d):
    cohort = p.cohort(raw(spark, d, "raw_cohort"), raw(spark, d, "raw_linkage"))
    return cohort.select("AvatarKey", "ch_status", "germline_collection_age", "tumor_collection_age")


def _labels(pairs: list[tuple[str, str]]) -> str:
    return " ".join(f"WHEN {test} THEN '{value}'" for test, value in pairs)


_RACE = _labels(
    [
        ("contains(Race, 'American Indian')", "American Indian or Alaska Native"),
        ("contains(Race, 'Asian') OR Race = 'Korean'", "Asian"),
        ("Race = 'Samoan' OR contains(Race, 'Tongan')", "Native Hawaiian or Other Pacific Islander"),
        ("contains(Race, 'Unknown') OR Race = 'Other'", "Unknown"),
    ]
)
_ETH = _labels(
    [
        ("Ethnicity = 'Spanish surname only' OR contains(Ethnicity, 'Non-Hispanic')", "Non-Hispanic"),
        ("contains(Ethnicity, 'Unknown')", "Unknown"),
        ("Ethnicity IS NOT NULL", "Hispanic"),
    ]
)
_RACE_ETH = _labels(
    [
        ("Race = 'White' AND Ethnicity = 'Non-Hispanic'", "White Non-Hispanic"),
        ("Race = 'Black' AND Ethnicity = 'Non-Hispanic'", "Black Non-Hispanic"),
        ("Ethnicity = 'Hispanic'", "Hispanic any race"),
    ]
)


@query(
    "clinical_demographics",
    f"""SELECT d.*, CASE WHEN contains(h.SmokingStatus, 'Ever') OR h.SmokingStatus = 'Current' THEN 'Ever'
                         WHEN h.SmokingStatus = 'Never' THEN 'Never' END AS SmokingStatus
        FROM (SELECT *, CASE {_RACE_ETH} END AS race_eth
              FROM (SELECT AvatarKey, CASE {_RACE} ELSE Race END AS Race, CASE {_ETH} END AS Ethnicity FROM raw_patient WHERE {_IN_COHORT})) d
        JOIN raw_history h ON d.AvatarKey = h.AvatarKey""",
)
def clinical_demographics(spark, d):
    cohort = raw(spark, d, "raw_cohort")
    people = p.demographics(raw(spark, d, "raw_patient"), cohort)
    return people.join(p.history(raw(spark, d, "raw_history"), cohort).select(KEY, "SmokingStatus"), KEY)


@query(
    "clinical_index_diagnosis",
    """SELECT AvatarKey, number_of_dx, diagnosis_sequence, age AS AgeAtDiagnosis, imputed AS dx_age_is_first_contact_age, PrimaryDiagnosisSite,
              Histology, CASE WHEN AgeAtDiagnosis = 'Age 90 or older' THEN AgeAtDiagnosis END AS not_real_age, pre_cancer_info, post_cancer_info
       FROM c_index""",
)
def clinical_index_diagnosis(spark, d):
    index = dx.index_diagnosis(raw(spark, d, "raw_dx"), raw(spark, d, "raw_cohort"))
    return index.select(
        KEY, "number_of_dx", "diagnosis_sequence", "AgeAtDiagnosis", "dx_age_is_first_contact_age",
        "PrimaryDiagnosisSite", "Histology", "not_real_age", "pre_cancer_info", "post_cancer_info",
    )


@query("clinical_outcomes", "SELECT * FROM c_outcomes")
def clinical_outcomes(spark, d):
    out = dx.outcomes(raw(spark, d, "raw_outcome"), *_index(spark, d))
    return out.select(KEY, "pfs_event", "pfs_age", "OutcomesPrimaryDiagnosisSite")


@query("clinical_metastasis", "SELECT * FROM c_metastasis")
def clinical_metastasis(spark, d):
    out = dx.metastasis(raw(spark, d, "raw_mets"), *_index(spark, d))
    return out.select(KEY, "had_metastasis", "AgeAtMetastaticSite", "MetsDzPrimaryDiagnosisSite", "has_metastasis_data")


def _wide(names: dict[str, str], k: int) -> str:
    return ", ".join(
        f"max(CASE WHEN nth = {i} THEN {source} END) AS {name}_{i}" for name, source in names.items() for i in range(1, k + 1)
    )


@query(
    "clinical_radiation_wide",
    """SELECT AvatarKey, RadiationTherapyInd AS radiation_ever, ever_first AS ever_first_rad_age, had_prior_radiation,
               nth AS occurrence, start, dose, stop
        FROM (SELECT *, CASE WHEN max(CASE WHEN nth = 1 THEN start END) OVER (PARTITION BY AvatarKey, RadiationTherapyInd, ever_first) > ever_first THEN 'Yes' END AS had_prior_radiation
              FROM (SELECT *, row_number() OVER (PARTITION BY AvatarKey ORDER BY src, row_id) AS nth FROM c_rad))
        WHERE start IS NOT NULL OR dose IS NOT NULL OR stop IS NOT NULL""",
)
def clinical_radiation_wide(spark, d):
    cohort, index = _index(spark, d)
    wide = lt.radiation_wide(lt.radiation(raw(spark, d, "raw_rad"), cohort, index))
    wide = wide.withColumnRenamed("age_at_first_radiation", "AgeAtRadiationStart_1")
    cells = {"AgeAtRadiationStart": "start", "RadDose": "dose", "AgeAtRadiationStop": "stop"}
    return occurrence_rows(wide, [KEY, "radiation_ever", "ever_first_rad_age", "had_prior_radiation"], cells)


@query(
    "clinical_surgery_wide",
    """SELECT AvatarKey, SiteTherapeutic AS surgery_ever, ever_first AS ever_first_surgery_age, had_prior_surgery, nth AS occurrence, age
        FROM (SELECT *, CASE WHEN max(CASE WHEN nth = 1 THEN age END) OVER (PARTITION BY AvatarKey, SiteTherapeutic, ever_first) > ever_first THEN 'Yes' END AS had_prior_surgery
              FROM (SELECT * EXCLUDE (nth), row_number() OVER (PARTITION BY AvatarKey ORDER BY src, row_id) AS nth FROM c_surg))
        WHERE age IS NOT NULL""",
)
def clinical_surgery_wide(spark, d):
    cohort, index = _index(spark, d)
    wide = lt.surgery_wide(lt.surgery(raw(spark, d, "raw_surg"), cohort, index))
    wide = wide.withColumnRenamed("age_at_first_surgery", "AgeAtSurgeryBiopsy_1")
    return occurrence_rows(wide, [KEY, "surgery_ever", "ever_first_surgery_age", "had_prior_surgery"], {"AgeAtSurgeryBiopsy": "age"})


@query(
    "clinical_treatment_around_sample",
    """SELECT coalesce(r.AvatarKey, c.AvatarKey) AS AvatarKey, r.row_id, CASE WHEN start <= germline_collection_age THEN 'radiation before germline'
              WHEN start > germline_collection_age THEN 'radiation after germline' END AS radiation_specimen_sequence
       FROM c_rad r FULL JOIN c_cohort c ON r.AvatarKey = c.AvatarKey""",
)
def clinical_treatment_around_sample(spark, d):
    cohort, index = _index(spark, d)
    rows = lt.radiation(raw(spark, d, "raw_rad"), cohort, index)
    return lt.around_sample(rows, cohort, "AgeAtRadiationStart", "radiation").select(
        KEY, "row_id", "radiation_specimen_sequence"
    )


@query(
    "clinical_exam",
    f"""WITH e AS (SELECT row_id, AvatarKey, {_num('AgeAtPhysicalExam')} AS age, try_cast(BodyWeight AS DOUBLE) AS w,
                          try_cast(BodyHeight AS DOUBLE) AS h, try_cast(BMI AS DOUBLE) AS b FROM raw_exam WHERE {_IN_COHORT}),
             f AS (SELECT row_id, AvatarKey, age, first_value(w IGNORE NULLS) OVER o AS w, first_value(h IGNORE NULLS) OVER o AS h,
                          first_value(b IGNORE NULLS) OVER o AS b FROM e
                   WINDOW o AS (PARTITION BY AvatarKey ORDER BY age NULLS LAST, row_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
             n AS (SELECT f.*, row_number() OVER (PARTITION BY f.AvatarKey ORDER BY abs(f.age - i.age) NULLS LAST, f.age NULLS LAST, f.row_id) AS nth
                   FROM f LEFT JOIN c_index i ON f.AvatarKey = i.AvatarKey)
        SELECT AvatarKey, age AS AgeAtPhysicalExam, w AS BodyWeight, h AS BodyHeight, b AS BMI,
               CASE WHEN b < 18.5 THEN 'Underweight' WHEN b < 25 THEN 'Healthy' WHEN b < 30 THEN 'Overweight' WHEN b >= 30 THEN 'Obese' END AS bmi_cat
        FROM n WHERE nth = 1""",
)
def clinical_exam(spark, d):
    return p.exam(raw(spark, d, "raw_exam"), *_index(spark, d))


MARKERS = ["ca-125", "her2neu", "estrogen_receptor_(er)", "flow_panel_cd_4", "flow_panel_cd_8"]


@query(
    "clinical_markers",
    f"""WITH m AS (SELECT row_id, AvatarKey, TumorMarkerKey, {_num('AgeAtTumorMarkerTest')} AS age, TMarkerTest AS test,
                          nullif(TMarkerResult, 'Unknown/Not Applicable') AS res, CASE WHEN TMarkerResult = 'Value' THEN try_cast(TMarkerResultValue AS DOUBLE) END AS val,
                          CASE WHEN TMarkerResult = 'Value' THEN TMarkerResultValue END AS txt, nullif(TMarkerValueUOM, 'Unknown') AS uom,
                          CASE WHEN TMarkerRangeIndicator NOT IN ('Unknown/Not Applicable', 'Not Available') THEN TMarkerRangeIndicator END AS ind
                   FROM raw_marker WHERE {_IN_COHORT}),
             i AS (SELECT *, CASE WHEN ind IS NOT NULL THEN ind WHEN val >= 9 AND val <= 100 THEN 'WNL (Within Normal Limits)' WHEN val < 9 THEN 'Low'
                                  WHEN val > 100 THEN 'High' END AS meaning FROM m),
             t AS (SELECT *, CASE WHEN res <> 'Value' THEN res WHEN txt IS NOT NULL AND meaning IS NOT NULL THEN txt || ' : ' || meaning
                                  ELSE coalesce(txt, meaning) END AS result0 FROM i),
             h AS (SELECT *, CASE WHEN contains(test, 'HER2') THEN 'HER2Neu' ELSE test END AS marker,
                          CASE WHEN contains(test, 'HER2') THEN replace(test, 'HER2Neu ', '') || ' : ' || result0 ELSE result0 END AS result1 FROM t),
             s AS (SELECT h.*, CASE WHEN marker = 'HER2Neu' AND contains(result1, ': Amplified') THEN 'Positive' ELSE result1 END AS result,
                          row_number() OVER (PARTITION BY h.AvatarKey, marker ORDER BY CASE WHEN age >= tumor_collection_age THEN age - tumor_collection_age END NULLS LAST, row_id) AS nth
                   FROM h JOIN c_cohort c ON h.AvatarKey = c.AvatarKey)
        SELECT s.AvatarKey, concat_ws('_', replace(lower(marker), ' ', '_'), replace(lower(FlowPanelName), ' ', '_')) AS marker_test,
               CASE WHEN res = 'Value' THEN uom END AS marker_unit, coalesce(result, FlowPanelResult) AS marker_result
        FROM s LEFT JOIN raw_flow f ON s.AvatarKey = f.AvatarKey AND s.TumorMarkerKey = f.TumorMarkerKey WHERE nth = 1""",
)
def clinical_markers(spark, d):
    long = p.markers_long(raw(spark, d, "raw_marker"), raw(spark, d, "raw_flow"), _cohort(spark, d))
    return long.drop("TumorMarkerInd")


@query(
    "clinical_family",
    f"""WITH f AS (SELECT r.*, row_number() OVER (PARTITION BY r.AvatarKey, FamilyRelation ORDER BY r.row_id) AS nth FROM raw_family r JOIN c_index i
                   ON r.AvatarKey = i.AvatarKey AND FamilyRelationPrimarySiteCode = i.PrimaryDiagnosisSiteCode AND FamilyRelationPrimarySite = i.PrimaryDiagnosisSite)
        SELECT AvatarKey, CancerInFamilyInd, string_agg(FamilyRelation, ' + ' ORDER BY row_id) AS FamilyRelation,
               CASE WHEN count(FamilyRelationAgeGroup) = count(*) THEN string_agg(FamilyRelationAgeGroup, ' + ' ORDER BY row_id) END AS FamilyRelationAgeGroup
        FROM f WHERE nth = 1 GROUP BY AvatarKey, CancerInFamilyInd""",
)
def clinical_family(spark, d):
    _, index = _index(spark, d)
    return p.family_history(raw(spark, d, "raw_family"), index)


@query(
    "clinical_last_date",
    f"""SELECT AvatarKey, age_at_lab FROM (SELECT *, row_number() OVER (PARTITION BY AvatarKey ORDER BY age_at_lab DESC NULLS LAST) AS nth FROM (
            SELECT AvatarKey, {_num('AgeAtImageScan')} AS age_at_lab FROM raw_imaging UNION ALL
            SELECT AvatarKey, {_num('AgeAtLabResults')} FROM raw_labs)) WHERE nth = 1""",
)
def clinical_last_date(spark, d):
    return p.last_date(raw(spark, d, "raw_imaging"), raw(spark, d, "raw_labs"))


def _medication_rows(spark, d, wanted=None):
    cohort, index = _index(spark, d)
    rows = md.drug_rows(raw(spark, d, "raw_med"), cohort, raw(spark, d, "raw_drug"), wanted)
    return cohort, index, rows


@query(
    "clinical_therapy_lines",
    """SELECT AvatarKey, row_id, MedicationInd, med AS Medication, start AS AgeAtMedStart, stop AS AgeAtMedStop, line AS MedLineRegimen, narrow, chemo, regimen_line
       FROM c_lines""",
)
def clinical_therapy_lines(spark, d):
    _, index, rows = _medication_rows(spark, d, md.in_index_therapy())
    return md.index_therapy(rows, index).select(
        KEY, "row_id", "MedicationInd", "Medication", "AgeAtMedStart", "AgeAtMedStop", "MedLineRegimen",
        F.col(md.NARROW).alias("narrow"), F.col("received_chemotherapy").alias("chemo"), "regimen_line",
    )


@query(
    "clinical_regimens",
    """SELECT AvatarKey, regimen_line, start AS AgeAtMedStart, MedicationInd, ever_first AS ever_first_med_age, regimen_drugs, narrow, stop AS AgeAtMedStop, seq
       FROM c_long""",
)
def clinical_regimens(spark, d):
    cohort, index, rows = _medication_rows(spark, d, md.in_index_therapy())
    long = md.regimens_long(md.index_therapy(rows, index), cohort)
    return long.select(
        KEY, "regimen_line", "AgeAtMedStart", "MedicationInd", "ever_first_med_age", "regimen_drugs",
        F.col(md.NARROW).alias("narrow"), "AgeAtMedStop", F.col("regimen_specimen_sequence").alias("seq"),
    )


@query(
    "clinical_drug_phases",
    """WITH f AS (SELECT AvatarKey, min(start) AS first_start FROM c_long GROUP BY AvatarKey),
            o AS (SELECT m.AvatarKey, m.row_id, med, start, CASE WHEN start < first_start THEN '1- drugs for pre cancer'
                         WHEN start > first_start THEN '3- drugs for post cancer' END AS phase,
                         CASE WHEN start < first_start THEN -1 WHEN start > first_start THEN 88 END AS regimen_line
                  FROM c_med m JOIN f ON m.AvatarKey = f.AvatarKey WHERE m.row_id NOT IN (SELECT row_id FROM c_lines)
                  UNION ALL SELECT AvatarKey, row_id, med, start, '2- drugs for ovarian cancer', regimen_line FROM c_lines)
       SELECT o.AvatarKey, o.row_id, med AS Medication, phase, CAST(regimen_line AS BIGINT) AS regimen_line,
              CASE WHEN start <= germline_collection_age THEN 'regimen before germline' WHEN start > germline_collection_age THEN 'regimen after germline' END AS seq
       FROM o LEFT JOIN c_cohort c ON o.AvatarKey = c.AvatarKey""",
)
def clinical_drug_phases(spark, d):
    cohort, index, rows = _medication_rows(spark, d)
    lines = md.index_therapy(rows, index)
    phases = md.drug_phases(rows, lines, md.regimens_long(lines, cohort), cohort)
    return phases.select(
        KEY, "row_id", "Medication", F.col("drug_sequence_vs_ovarian_drugs").alias("phase"), "regimen_line",
        F.col("regimen_specimen_sequence").alias("seq"),
    )


RAW_NAMES = {
    "cohort": "raw_cohort", "sample_linkage": "raw_linkage", "patient": "raw_patient", "history": "raw_history",
    "diagnosis": "raw_dx", "vital": "raw_vital", "outcome": "raw_outcome", "metastasis": "raw_mets",
    "medication": "raw_med", "drug_class": "raw_drug", "radiation": "raw_rad", "surgery": "raw_surg",
    "exam": "raw_exam", "marker": "raw_marker", "marker_flow": "raw_flow", "family": "raw_family",
    "imaging": "raw_imaging", "labs": "raw_labs", "cytogenetics": "raw_cyto",
}


def _patient_table(spark, d):
    tables = {n: raw(spark, d, r) for n, r in RAW_NAMES.items()}
    return build_patient_tables(tables).wide


v.SQL_VIEWS |= {
    "c_drug_wide": f"""
        SELECT AvatarKey, MedicationInd AS drugs_ever, ever_first AS ever_first_med_age,
               {_wide({'AgeAtMedStart': 'start', 'regimen': 'regimen_drugs'}, 2)}, string_agg(regimen_drugs, ' / ') AS all_regimens,
               'Yes' AS has_medication_data
        FROM (SELECT *, row_number() OVER (PARTITION BY AvatarKey ORDER BY start NULLS LAST, regimen_line NULLS LAST, regimen_drugs) AS nth FROM c_long)
        GROUP BY AvatarKey, MedicationInd, ever_first""",
    "c_rad_wide": """
        SELECT AvatarKey, RadiationTherapyInd, ever_first AS ever_first_rad, max(CASE WHEN nth = 1 THEN start END) AS age_at_first_radiation
        FROM (SELECT *, row_number() OVER (PARTITION BY AvatarKey ORDER BY src, row_id) AS nth FROM c_rad)
        GROUP BY AvatarKey, RadiationTherapyInd, ever_first""",
    "c_surg_wide": """
        SELECT AvatarKey, SiteTherapeutic, ever_first AS ever_first_surg, max(CASE WHEN nth = 1 THEN age END) AS age_at_first_surgery
        FROM (SELECT * EXCLUDE (nth), row_number() OVER (PARTITION BY AvatarKey ORDER BY src, row_id) AS nth FROM c_surg)
        GROUP BY AvatarKey, SiteTherapeutic, ever_first""",
    "c_wide": f"""
        SELECT i.*, c.* EXCLUDE (AvatarKey), x.* EXCLUDE (AvatarKey), m.* EXCLUDE (AvatarKey), r.* EXCLUDE (AvatarKey), s.* EXCLUDE (AvatarKey),
               o.pfs_event, o.pfs_age, t.had_metastasis, t.AgeAtMetastaticSite, t.has_metastasis_data, l.age_at_lab
        FROM c_cohort c FULL JOIN (SELECT AvatarKey, VitalStatus, {_num('AgeAtLastContact')} AS AgeAtLastContact, {_num('AgeAtDeath')} AS AgeAtDeath
                                   FROM raw_vital WHERE {_IN_COHORT}) x ON c.AvatarKey = x.AvatarKey
        JOIN c_index i ON coalesce(c.AvatarKey, x.AvatarKey) = i.AvatarKey
        LEFT JOIN c_drug_wide m ON i.AvatarKey = m.AvatarKey LEFT JOIN c_rad_wide r ON i.AvatarKey = r.AvatarKey
        LEFT JOIN c_surg_wide s ON i.AvatarKey = s.AvatarKey LEFT JOIN c_outcomes o ON i.AvatarKey = o.AvatarKey
        LEFT JOIN c_metastasis t ON i.AvatarKey = t.AvatarKey
        LEFT JOIN (SELECT AvatarKey, max(a) AS age_at_lab FROM (SELECT AvatarKey, {_num('AgeAtImageScan')} AS a FROM raw_imaging
                   UNION ALL SELECT AvatarKey, {_num('AgeAtLabResults')} FROM raw_labs) GROUP BY AvatarKey) l ON i.AvatarKey = l.AvatarKey""",
}

_WIDE_COLUMNS = [
    "AvatarKey", "AgeAtDiagnosis", "PrimaryDiagnosisSite", "germline_collection_age", "ch_status", "VitalStatus", "AgeAtLastContact",
    "AgeAtDeath", "drugs_ever", "ever_first_med_age", "AgeAtMedStart_1", "AgeAtMedStart_2", "regimen_1", "regimen_2",
    "has_medication_data", "age_at_first_radiation", "age_at_first_surgery", "pfs_event", "pfs_age", "had_metastasis", "age_at_lab",
]


@query(
    "clinical_patient_table",
    "SELECT " + ", ".join("age AS AgeAtDiagnosis" if n == "AgeAtDiagnosis" else n for n in _WIDE_COLUMNS) + " FROM c_wide",
)
def clinical_patient_table(spark, d):
    return _patient_table(spark, d).select(*_WIDE_COLUMNS)


def _stage(column: str) -> str:
    return "CASE " + " ".join(f"WHEN contains({column}, '{t}') THEN '{n}'" for t, n in c.STAGE_NUMERALS) + " END"


_DERIVED_COLUMNS = [
    "avatar_key", "stage", "stage_cat", "histology_behavior", "histotype", "grade", "hgsoc_vs_others", "is_agelastcontact_last_date",
    "age_at_last_contact", "first_treatment", "age_at_first_treatment", "received_any_any_regimen", "os_event", "os_age",
    "os_time_from_dx_years", "os_time_from_treatment_years", "rfs_event", "pfs_event", "pfs_age", "pfs_time_from_dx_years",
    "metastase_event", "met_time_from_dx_years", "time_dx_to_first_treatment_days",
]


@query(
    "clinical_derived",
    f"""WITH a AS (SELECT *, max({_stage('ClinGroupStage')}) OVER (PARTITION BY AvatarKey) AS s1, max({_stage('PathGroupStage')}) OVER (PARTITION BY AvatarKey) AS s2,
                          CASE WHEN contains(histology_behavior, '80100') THEN NULL ELSE substr(histology_behavior, 7) END AS hb,
                          CASE WHEN AgeAtDeath < AgeAtLastContact THEN AgeAtDeath ELSE AgeAtLastContact END AS contact,
                          age_at_first_radiation AS r, age_at_first_surgery AS s, AgeAtMedStart_1 AS m FROM c_wide),
             b AS (SELECT *, greatest(coalesce(s1, s2), coalesce(s2, s1)) AS stage,
                          CASE WHEN hb = 'Endometrioid adenocarcinoma, NOS' AND Histology = 'Other' THEN 'Endometrioid'
                               WHEN Histology = 'Serous cystadenocarcinoma, NOS' THEN 'Serous' WHEN Histology = 'Endometrioid adenocarcinoma, NOS' THEN 'Endometrioid'
                               WHEN Histology = 'Carcinosarcoma, NOS' THEN 'Other epithelial' WHEN Histology = 'Other' THEN 'Exclude' END AS histotype,
                          CASE WHEN r < least(coalesce(s, 1e9), coalesce(m, 1e9)) THEN 'Radiation' WHEN s < least(coalesce(r, 1e9), coalesce(m, 1e9)) THEN 'Surgery'
                               WHEN m < least(coalesce(r, 1e9), coalesce(s, 1e9)) THEN 'Drugs' WHEN m = r THEN 'Drugs' WHEN m = s THEN 'Surgery' END AS first_treatment,
                          CASE VitalStatus WHEN 'Dead' THEN 1 WHEN 'Alive' THEN 0 WHEN 'Lost to follow-up' THEN 0 END AS os_event FROM a),
             e AS (SELECT *, CASE WHEN histotype = 'Serous' THEN CASE WHEN GradePathological = 'Low grade' THEN 'Low' ELSE 'High' END END AS grade,
                          CASE first_treatment WHEN 'Radiation' THEN r WHEN 'Surgery' THEN s WHEN 'Drugs' THEN m END AS treated,
                          coalesce(AgeAtDeath, contact) AS os_age, pfs_event = 0 AND os_event = 1 AS died FROM b)
        SELECT AvatarKey AS avatar_key, stage, CASE WHEN stage IN ('1', '2') THEN '1-2' WHEN stage IN ('3', '4') THEN '3-4' END AS stage_cat,
               hb AS histology_behavior, histotype, grade,
               CASE WHEN grade = 'High' OR Histology = 'Carcinosarcoma, NOS' THEN 'High-grade serous/carcinosarcoma' WHEN histotype = 'Exclude' THEN 'Exclude'
                    WHEN grade IS NOT NULL OR histotype IS NOT NULL THEN 'Others' END AS hgsoc_vs_others,
               CASE WHEN AgeAtLastContact >= age_at_lab OR (AgeAtLastContact IS NOT NULL AND age_at_lab IS NULL) THEN 'Yes'
                    WHEN AgeAtLastContact < age_at_lab THEN 'No' END AS is_agelastcontact_last_date,
               contact AS age_at_last_contact, first_treatment, treated AS age_at_first_treatment,
               CASE WHEN contains(all_regimens, 'bolt') THEN 'Yes' WHEN has_medication_data = 'Yes' THEN 'No' END AS received_any_any_regimen,
               os_event, os_age, os_age - age AS os_time_from_dx_years, os_age - treated AS os_time_from_treatment_years, pfs_event AS rfs_event,
               CASE WHEN died THEN 1 ELSE pfs_event END AS pfs_event,
               CASE WHEN died THEN os_age WHEN pfs_event IS NOT NULL THEN pfs_age END AS pfs_age,
               CASE WHEN died THEN os_age WHEN pfs_event IS NOT NULL THEN pfs_age END - age AS pfs_time_from_dx_years,
               CASE WHEN had_metastasis = 'Yes' THEN 1 WHEN has_metastasis_data IS NOT NULL THEN 0 END AS metastase_event,
               coalesce(AgeAtMetastaticSite, contact) - age AS met_time_from_dx_years, (treated - age) * 365 AS time_dx_to_first_treatment_days
        FROM e""",
)
def clinical_derived(spark, d):
    derived = derive_variables(_patient_table(spark, d))
    regimens = [n for n in derived.columns if n.startswith("regimen_")]
    bolt = yes_no(any_contains(regimens, "bolt"), F.col("has_medication_data") == "Yes")
    return derived.withColumn("received_any_any_regimen", bolt).select(*_DERIVED_COLUMNS)


@query("clinical_reports")
def clinical_reports(spark, d):
    """Characteristics by stratum and hazard ratios of the derived table, as one long table."""
    derived = durable(derive_variables(_patient_table(spark, d)))
    numbers = ["age_at_diagnosis", "age_at_med_start_1", "os_time_from_dx_years"]
    labels = ["race_eth", "stage_cat", "histotype", "grade", "bmi_cat", "vital_status", "first_treatment"]
    table = reports.characteristics(derived, numbers + labels, "ch_status")
    tests = reports.tests(derived, ["age_at_diagnosis", "race_eth"]).withColumn("stratum", F.lit("test"))
    hazard = reports.hazard_ratios(derived, "os", ["ch_status", "germline_collection_age"])
    hazard = hazard.withColumnRenamed("covariate", "variable").withColumn("stratum", F.lit("hazard"))
    return union_by_name(table, tests.drop("df"), hazard)
