"""Missing-value rules, recodes and tail probabilities on hand-made rows."""

import math

import pytest
from pyspark.sql import functions as F

from frames import rows
from kohorta.functions import clinical as c, exprs as x, recode as r, tails
from kohorta.operators import selectors as s
from kohorta.operators.keys import attach, equi_join, sort_columns


def values(df, column):
    return [row[0] for row in df.orderBy("i").select(column).collect()]


@pytest.fixture(scope="module")
def texts(spark):
    data = ["Age 90 or older", "Unknown/Not Applicable", "63.5", " 7 ", "1d", "abc", "", "-2e1", None]
    return spark.createDataFrame(list(enumerate(data)), "i int, t string")


def test_numbers_from_text(texts):
    assert values(texts, x.parse_age("t")) == [90.0, None, 63.5, 7.0, None, None, None, -20.0, None]
    assert values(texts, x.parse_number("t"))[:3] == [None, None, 63.5]
    assert values(texts, x.sentinel_flag("t"))[:3] == ["Age 90 or older", None, None]


def test_strict_minimum(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 2.0), ("a", None, 0.5), ("b", 3.0, 1.0), ("b", 2.0, 4.0), (None, 5.0, 6.0)],
        "k string, u double, v double",
    )
    got = rows(df.groupBy("k").agg(x.group_min_strict("u", "v").alias("m"), x.group_max_skip("u", "v").alias("x")))
    assert got == [("a", None, 2.0), ("b", 1.0, 4.0), (None, 5.0, 6.0)]
    # The group of the missing key is kept and gets its value back.
    assert (None, 5.0) in rows(attach(df, "k", {"m": x.group_min_strict("u")}), "k", "m")


def test_text_rules(spark):
    df = spark.createDataFrame(
        [(0, "Doxorubicin Hydrochloride Phosphate", 63.0, "a"), (1, "x Sulfate\ny Sulfate", 63.25, None), (2, None, None, "b")],
        "i int, t string, n double, c string",
    )
    assert values(df, x.remove_first("t", c.DRUG_SUFFIXES)) == ["Doxorubicin Phosphate", "x\ny Sulfate", None]
    assert values(df, x.fmt_num("n")) == ["63", "63.25", None]
    assert values(df, x.concat_text(F.lit("v="), x.fmt_num("n"), "c")) == ["v=63a", "v=63.25NA", "v=NAb"]
    assert values(df, x.concat_strict("c", x.fmt_num("n"), sep=" : ")) == ["a : 63", None, None]
    assert values(df, x.unite(["c", x.fmt_num("n")], na_rm=True)) == ["a_63", "63.25", "b"]
    assert values(df, x.unite(["c", x.fmt_num("n")])) == ["a_63", "NA_63.25", "b_NA"]
    assert values(df, x.capture("t", "(D[a-z]+)")) == ["Doxorubicin", None, None]
    assert values(df, x.na_if("c", "a", "b")) == [None, None, None]


def test_range_label(spark):
    df = spark.createDataFrame(
        [(0, "9", "10", "35", None), (1, "20", "10", "35", None), (2, "9", "10", "35", "High"), (3, None, "1", "2", None), (4, "36", None, "35", None)],
        "i int, v string, lo string, hi string, ind string",
    )
    label = x.in_range_label("v", "lo", "hi", "ind")
    assert values(df, label) == ["Low", "WNL (Within Normal Limits)", "High", None, "High"]
    # As texts "9" lies after "35".
    assert values(df, x.in_range_label("v", "lo", "hi", "ind", lexical=True))[0] == "High"


def test_recodes(spark):
    df = spark.createDataFrame(
        [(0, 18.49, "IVB", "84413 Serous carcinoma, NOS"), (1, 18.5, "III", "80100 Carcinoma"), (2, 30.0, "V", None), (3, None, None, "x")],
        "i int, b double, s string, h string",
    )
    assert values(df, r.bin_numeric(F.col("b"), c.BMI_CUTS, c.BMI_LABELS)) == ["Underweight", "Healthy", "Obese", None]
    assert values(df, c.stage_number(F.col("s"))) == ["4", "3", "5", None]
    assert values(df, c.stage_group(c.stage_number(F.col("s")))) == ["3-4", "3-4", None, None]
    assert values(df, c.histology_name(F.col("h"))) == ["Serous carcinoma, NOS", None, None, None]
    assert values(df, r.domain_rank(F.col("s"), ["III", "IVB"])) == [2, 1, None, None]
    assert values(df, r.ordinal(F.col("s"), {"III": 3})) == [None, 3, None, None]


def test_clinical_groups(spark):
    df = spark.createDataFrame(
        [
            (0, "American Indian, Alaska", "Non-Hispanic origin", "Not Amplified"),
            (1, "Other Asian", "Unknown", "Amplified"),
            (2, "Other", "Puerto Rican", None),
            (3, None, None, None),
        ],
        "i int, race string, eth string, res string",
    )
    race, eth = c.race_group(F.col("race")), c.ethnicity_group(F.col("eth"))
    assert values(df, race) == ["American Indian or Alaska Native", "Asian", "Unknown", None]
    assert values(df, eth) == ["Non-Hispanic", "Unknown", "Hispanic", None]
    assert values(df, c.race_ethnicity(race, eth)) == [None, None, "Hispanic any race", None]
    _, full = c.marker_parts(F.lit("HER2Neu by FISH"), F.col("res"))
    assert values(df, full) == ["by FISH : Not Amplified", "Positive", None, None]
    assert values(df, c.histotype(F.lit("Endometrioid adenocarcinoma, NOS"), F.lit("Other"))) == ["Endometrioid"] * 4
    assert values(df, c.histotype(F.lit(None).cast("string"), F.lit("Other"))) == ["Exclude"] * 4


def test_selectors(spark):
    df = spark.createDataFrame([(1, None, "x", 2.0)], "AvatarKey int, `Disease.Type` string, BMI string, `PFS_event2 (%)` double")
    clean = s.clean_names(df)
    assert clean.columns == ["avatar_key", "disease_type", "bmi", "pfs_event2_percent"]
    assert s.drop_empty_columns(clean).columns == ["avatar_key", "bmi", "pfs_event2_percent"]
    assert s.span(clean, "disease_type", "bmi") == ["disease_type", "bmi"]
    assert s.relocate(clean, ["bmi"], after="avatar_key").columns[1] == "bmi"
    assert s.snake("...1") == "x1" and s.snake("AgeAtMedStart_1") == "age_at_med_start_1"
    repeated = spark.createDataFrame([(1, 2)], ["a b", "a.b"])
    assert s.clean_names(repeated).columns == ["a_b", "a_b_2"]


def test_missing_keys_and_order(spark):
    a = spark.createDataFrame([(1, "x"), (None, "y")], "k int, l string")
    b = spark.createDataFrame([(1, "p"), (None, "q")], "k int, r string")
    assert equi_join(a, b, "k").count() == 1
    assert equi_join(a, b, "k", na_matches=True).count() == 2
    assert equi_join(a, b, "k", "full").count() == 3
    with pytest.raises(ValueError, match="both sides"):
        equi_join(a, a, "k")
    df = spark.createDataFrame([(2,), (None,), (1,)], "v int")
    assert [r[0] for r in df.orderBy(*sort_columns("v")).collect()] == [1, 2, None]
    assert [r[0] for r in df.orderBy(*sort_columns("-v")).collect()] == [2, 1, None]
    assert [r[0] for r in df.orderBy(*sort_columns("-v", backwards=True)).collect()] == [None, 1, 2]


def test_tails():
    assert tails.normal_two_sided(1.959963984540054) == pytest.approx(0.05, abs=1e-12)
    assert tails.chi_square(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-12)
    assert tails.chi_square(9.487729036781154, 4) == pytest.approx(0.05, abs=1e-12)
    assert tails.chi_square(4.0, 2) == pytest.approx(math.exp(-2.0), abs=1e-12)
    # Tea tasting: 3 of 4 right; two-sided 34/70.
    assert tails.fisher_2x2(3, 1, 1, 3) == pytest.approx(34 / 70, abs=1e-9)
