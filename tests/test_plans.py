"""The physical plans keep the shapes that matter on large tables."""

import re
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from kohorta.catalog import QUERIES, views as v  # noqa: E402
from kohorta import session  # noqa: E402
from kohorta.operators import events as e, joins as j, ordered as o  # noqa: E402
from kohorta.operators.keys import keyed_join  # noqa: E402
from kohorta.operators.selectors import past  # noqa: E402
from kohorta.plans import diagnosis as dx, medication as md  # noqa: E402
from kohorta.sources.tables import read_table  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(pattern, text):
    return len(re.findall(pattern, text))


# The clinical blocks are made of the same operators; they run jobs while they are built.
@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("clinical_")])
def test_no_nested_loops_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert not re.search(r"BroadcastNestedLoopJoin|CartesianProduct|Python|Pandas", text)


def test_first_rows_are_limited_before_the_shuffle(spark):
    text = plan(e.keep_first(v.ev(spark, FOLDER), "user_id", ["day", "event_id"]))
    before = text[text.index("Exchange") :]
    assert "WindowGroupLimit" in before and ", Partial" in before


def test_windows_of_one_key_share_a_shuffle(spark):
    rows = v.ev(spark, FOLDER).select("user_id", "event_id", "cat", "nval", "value")
    filled = o.fill(rows, ["cat", "nval"], "user_id", ["event_id"])
    both = o.running_totals(o.event_sequence(filled, "user_id", ["event_id"], "n"), "user_id", ["event_id"], {"s": "value"})
    text = plan(both)
    assert count(r"Exchange hash", text) == 1
    assert count(r"[+:\-| ]Sort \[", text) <= 3


def test_filters_and_columns_reach_the_scan(spark):
    orders = read_table(spark, FOLDER, "orders").filter(F.col("o_orderstatus") == "F").select("o_custkey", "o_orderstatus")
    text = plan(j.restrict(orders, v.coh(spark, FOLDER), {"o_custkey": "c_custkey"}))
    assert "EqualTo(o_orderstatus,F)" in text and "EqualTo(c_mktsegment,BUILDING)" in text
    assert "o_totalprice" not in text and "c_acctbal" not in text


def test_merge_keeps_one_partitioning(spark):
    index = v.idx(spark, FOLDER)
    sides = [
        v.ord_n(spark, FOLDER).groupBy("o_custkey").agg(F.max(c).alias(f"top_{c}")) for c in ("day", "nday", "evt", "o_totalprice")
    ]
    text = plan(j.merge_on_index(index, sides[:2], sides[2:], "o_custkey"))
    # One shuffle per aggregate, none for the joins.
    assert count(r"Exchange hash", text) == 5 and count(r"SortMergeJoin", text) == 4


def test_merge_of_bucketed_tables_shuffles_nothing(spark):
    index = v.idx(spark, FOLDER)
    sides = [
        v.ord_n(spark, FOLDER).groupBy("o_custkey").agg(F.max(c).alias(f"top; {c}")) for c in ("day", "nday", "evt", "o_totalprice")
    ]
    plain = j.merge_on_index(index, sides[:2], sides[2:], "o_custkey")
    merged = j.merge_on_index(index, sides[:2], sides[2:], "o_custkey", buckets=4)
    text = plan(merged)
    assert "Exchange" not in text and count(r"SortMergeJoin", text) == 4
    assert count(r"Bucketed: true", text) == 5
    assert merged.columns == plain.columns and merged.exceptAll(plain).isEmpty() and plain.exceptAll(merged).isEmpty()


def test_therapy_rows_of_the_fallback_are_joined_once(spark):
    found = QUERIES["attribution_fallback"](spark, FOLDER)
    assert not [f for f in found.inputFiles() if "lineitem" in f or "part.parquet" in f]


def test_drug_rows_stay_in_buckets_by_patient(spark):
    cohort = spark.createDataFrame([("a",), ("b",), (None,)], "AvatarKey string")
    names = ["row_id", "AvatarKey", "MedicationInd", "Medication", "MedLineRegimen", "AgeAtMedStart", "AgeAtMedStop"]
    cells = [(i, k, "Yes", "x", "Maintenance", str(i % 3), "9") for i in range(4) for k in ("a", "b", "c", None)]
    table = spark.createDataFrame(cells, "row_id bigint, " + ", ".join(f"{n} string" for n in names[1:]))
    drugs = spark.createDataFrame([("X", "taxane", "chemo")], f"drug_name string, {md.NARROW} string, {md.GENERAL} string")
    rows = md.drug_rows(table, cohort, drugs)
    got = sorted((r.AvatarKey, r.row_id, r.ever_first_med_age, r[md.NARROW]) for r in rows.collect())
    assert got == [(k, i, 0.0, "taxane") for k in ("a", "b") for i in range(3)]
    first = rows.groupBy("AvatarKey").agg(F.min("AgeAtMedStart").alias("first"))
    both = o.fill(keyed_join(rows, first, "AvatarKey"), ["MedLineRegimen"], ["AvatarKey", "AgeAtMedStart"], ["row_id"])
    assert "Exchange" not in plan(both)


def test_one_count_stands_for_the_frames_of_a_block(spark, small_tasks):
    rows = spark.range(40).select((F.col("id") % 4).alias("k"), "id")
    derived = rows.withColumn("x", F.col("id") + 1)
    with small_tasks(9):
        with session.ordinary(rows, "k", times=1):  # ten rows a key: every frame is counted
            assert session.large_groups(derived, ["k"]).count() == 4
    with small_tasks(40):
        jobs = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup("ordinary", "")
        with session.ordinary(rows, "k"):
            before = len(jobs.getJobIdsForGroup("ordinary"))
            assert session.large_groups(derived, ["k", "id"]) is None
            assert len(jobs.getJobIdsForGroup("ordinary")) == before
        assert session.large_groups(rows.withColumn("y", F.lit(1)), ["k"]) is None
        assert len(jobs.getJobIdsForGroup("ordinary")) > before
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_table_near_the_limit_is_counted_for_its_frames(spark):
    rows = session.durable(spark.range(40).select((F.col("id") % 4).alias("k"), "id"))
    twice = rows.unionByName(rows.withColumn("id", -F.col("id")))
    spark.conf.set(session.BYTES_PER_TASK, str(session.source_bytes(rows)))
    try:
        session._FOUND.clear()
        with session.ordinary(rows, "k"):
            assert session.large_groups(twice, ["k"]) is None
        assert not session._FOUND
    finally:
        spark.conf.unset(session.BYTES_PER_TASK)


def test_drug_rows_are_read_once_and_their_windows_share_an_order(spark, monkeypatch):
    written, keep = [], session.bucketed
    monkeypatch.setattr(md, "bucketed", lambda df, *at: written.append(df) or keep(df, *at))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(1 << 20))
    cells = [
        (1, "a", "Yes", "x Sulfate", "Unknown/Not Applicable", "5", "6"),
        (2, "a", "Yes", "x Sulfate", "Maintenance", "5", "6"),
        (3, "a", "Yes", "y", "Unknown/Not Reported", "5", "6"),
        (4, "a", "Yes", "y", "Palliative", "7", None),
        (5, "b", "Yes", "y", "Maintenance", "3", "4"),
        (6, None, "Yes", "y", "Maintenance", "3", "4"),
    ]
    names = ["row_id", "AvatarKey", "MedicationInd", "Medication", "MedLineRegimen", "AgeAtMedStart", "AgeAtMedStop"]
    table = session.durable(spark.createDataFrame(cells, "row_id bigint, " + ", ".join(f"{n} string" for n in names[1:])))
    cohort = session.durable(spark.createDataFrame([("a",), ("b",), (None,)], "AvatarKey string"))
    drugs = spark.createDataFrame([("X", "taxane", "chemo")], f"drug_name string, {md.NARROW} string, {md.GENERAL} string")
    rows = md.drug_rows(table, cohort, drugs)
    # One order for the first start and the fill, its reverse, one for the equal rows; the table is read once.
    text = plan(written[0])
    assert count(r"[+:\-| ]Sort \[", text) == 3 and count(r"MedLineRegimen.*FileScan|FileScan.*MedLineRegimen", text) == 1
    got = {(r.AvatarKey, r.row_id, r.Medication, r.MedLineRegimen, r.ever_first_med_age) for r in rows.collect()}
    assert got == {("a", 1, "x", "Maintenance", None), ("a", 3, "y", "Maintenance", None), ("a", 4, "y", "Palliative", None), ("b", 5, "y", "Maintenance", 3.0)}


def _drug_tables(spark):
    names = ["row_id", "AvatarKey", "MedicationInd", "Medication", "MedLineRegimen", "AgeAtMedStart", "AgeAtMedStop"]
    cells = [
        (1, "a", "Yes", "x", "Unknown/Not Applicable", "5", "6"),
        (2, "a", "Yes", "y", "Maintenance", "5", "4"),
        (3, "b", "No", None, "Palliative", None, None),
        (4, "b", "Yes", "y", "Palliative", "7", "8"),
        (5, "c", "Yes", "x", "Palliative", "7", "8"),
        (6, None, "Yes", "x", "Palliative", "7", "8"),
    ]
    table = session.durable(spark.createDataFrame(cells, "row_id bigint, " + ", ".join(f"{n} string" for n in names[1:])))
    cohort = session.durable(spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "AvatarKey string"))
    drugs = spark.createDataFrame([("X", "taxane", "chemo")], f"drug_name string, {md.NARROW} string, {md.GENERAL} string")
    return table, cohort, drugs


def test_drug_rows_of_a_large_cohort_are_shuffled_once(spark):
    table, cohort, drugs = _drug_tables(spark)
    with_cohort = md.rows_by_patient(table, cohort, [])[0]  # broadcast joins are off
    # One shuffle of the rows, one of the cohort, and no sort for their meeting.
    assert count(r"Exchange hash", plan(with_cohort)) == 2 and "SortMergeJoin" not in plan(with_cohort)
    assert sorted(r.row_id for r in with_cohort.collect()) == [1, 2, 3, 4]
    large = sorted(tuple(r) for r in md.drug_rows(table, cohort, drugs).select("row_id", "MedLineRegimen").collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(1 << 20))
    assert large == sorted(tuple(r) for r in md.drug_rows(table, cohort, drugs).select("row_id", "MedLineRegimen").collect())


def test_only_wanted_drug_rows_are_written(spark):
    table, cohort, drugs = _drug_tables(spark)
    every, some = md.drug_rows(table, cohort, drugs), md.drug_rows(table, cohort, drugs, md.in_index_therapy())
    assert some.columns == every.columns
    # The label and the first age of row 1 come from row 2, which is not written.
    got = sorted((r.row_id, r.MedLineRegimen, r.ever_first_med_age) for r in some.collect())
    assert got == [(1, "Maintenance", 4.0), (3, "Palliative", None)]
    assert sorted(r.row_id for r in every.collect()) == [1, 2, 3, 4]


def test_a_block_counts_its_table_once(spark, small_tasks):
    names = ["AgeAtFirstContact", "AgeAtDiagnosis", "YearOfDiagnosis", "PrimaryDiagnosisSiteCode", "PrimaryDiagnosisSite", "Histology"]
    names += ["ClinGroupStage", "PathGroupStage", "GradeClinical", "GradePathological", "CurrentlySeenForPrimaryOrRecurr"]
    names += ["PerformStatusAtDiagnosis", "OtherStagingSystem", "OtherStagingValue"]
    table = spark.range(8).select(F.col("id").alias("row_id"), (F.col("id") % 2).cast("string").alias("AvatarKey"), *[F.lit("1").alias(n) for n in names])
    table = table.withColumn("PrimaryDiagnosisSite", F.lit("Ovary"))
    before = dict(session._FOUND)
    with small_tasks(100):
        index = dx.index_diagnosis(table, spark.createDataFrame([("0",), ("1",)], "AvatarKey string"))
        assert set(session._FOUND) == set(before)
    assert sorted((r.AvatarKey, r.number_of_dx) for r in index.collect()) == [("0", 4), ("1", 4)]


def test_derived_variables_carry_unread_columns_in_one_cell(spark):
    wide = spark.range(3).select("id", F.lit("u").alias("a"), F.lit("v").alias("b"), F.lit(1).alias("c"))
    step = lambda df: df.withColumns({"b": F.concat("b", F.lit("!")), "new": F.col("c") + 1})
    seen = []
    out = past(wide, ["id", "a"], lambda df: seen.append(df.columns) or step(df))
    assert seen == [["__past", "b", "c"]]
    assert out.columns == step(wide).columns and sorted(out.collect()) == sorted(step(wide).collect())
