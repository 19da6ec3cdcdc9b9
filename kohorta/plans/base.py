"""Conventions of the clinical tables.

Every event table carries ``AvatarKey`` (the patient) and ``row_id``, a number
that gives the rows of the extract their order: Spark tables have none, and
several steps take the first of otherwise equal rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import DataFrame, functions as F

from kohorta.functions.clinical import MIGRATED
from kohorta.functions.exprs import parse_age
from kohorta.operators.joins import restrict
from kohorta.operators.keys import equi_join
from kohorta.operators.selectors import across
from kohorta.session import durable, large_groups, ordinary, planned_broadcast, row_buckets

KEY = "AvatarKey"
ROW = "row_id"
SOURCE = "source"  # 0, 1, .. in the order in which attributed tables are stacked

INDEX_SITE = ("PrimaryDiagnosisSiteCode", "PrimaryDiagnosisSite")


def site_keys(prefix: str = "") -> dict[str, str]:
    """Join keys of an event table whose site columns carry a prefix."""
    return {KEY: KEY} | {f"{prefix}{c}": c for c in INDEX_SITE}


def cohort_rows(table: DataFrame, cohort: DataFrame, ages: Sequence[str]) -> DataFrame:
    """Rows of cohort patients with their age texts read as numbers.

    Most blocks read these rows several times, so they are written once: the
    cohort is a small part of the extract.
    """
    return durable(across(restrict(table, cohort, KEY), ages, parse_age))


def rows_by_patient(table: DataFrame, cohort: DataFrame, ages: Sequence[str]) -> tuple[DataFrame, int | None]:
    """``cohort_rows`` dealt into a number of buckets by patient, and that number.

    For blocks with many steps per patient, which then shuffle nothing more. A
    cohort that is sent to all tasks is met before the shuffle, a larger one in the
    buckets, where its share is small: meeting it before would take a shuffle of its
    own. A patient with more rows than one task should take would fill a bucket, so
    tables with one are written as they come.
    """
    if large_groups(table, [KEY]) is not None:
        return cohort_rows(table, cohort, ages), None
    patients = cohort.select(KEY)
    if planned_broadcast(patients):
        buckets = row_buckets(table)
        mine = equi_join(table, patients.distinct(), KEY, "left_semi").repartition(buckets, KEY)
    else:
        buckets = max(row_buckets(table), row_buckets(cohort))
        # Rows without a patient meet nothing, and would all come to one bucket.
        dealt = table.filter(F.col(KEY).isNotNull()).repartition(buckets, KEY)
        mine = equi_join(dealt, patients.repartition(buckets, KEY).distinct().hint("shuffle_hash"), KEY, "left_semi")
    return across(mine, ages, parse_age), buckets


def counted_once(block: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """One count of a block's table by patient stands for those of all the frames it makes."""

    @wraps(block)
    def counted(table: DataFrame, *args, **kwargs) -> DataFrame:
        with ordinary(table, KEY):
            return block(table, *args, **kwargs)

    return counted


def known_rows(table: DataFrame, indicator: str) -> DataFrame:
    return table.filter(F.col(indicator) != MIGRATED)


def stacked(*frames: DataFrame) -> DataFrame:
    """Tables on top of each other, with their place as ``source``."""
    from kohorta.operators.reshape import union_by_name

    return union_by_name(*[f.withColumn(SOURCE, F.lit(i)) for i, f in enumerate(frames)])
