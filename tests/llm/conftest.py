import random

import pytest
from hard_cases import EXTRA, EXTRA_CELLS, SCHEMA, words


@pytest.fixture(scope="session")
def hard_rows():
    """Nulls in any column, empty and long texts, ties, repeated rows, copies, near copies."""
    rng = random.Random(5)
    base = words(rng, 300)
    near = base.split()
    near[150] = "other"
    long = words(rng, 20_000, 5000)
    return [
        (1, base, "en", "src1", 3),
        (2, base.upper(), "en", "src1", 3),
        (3, " ".join(near), "en", "src2", 3),
        (4, None, "en", "src2", None),
        (5, "", None, "src3", 0),
        (6, "", "de", None, 0),
        (7, "one two", "de", "src4", 7),
        (8, "one two", "de", "src4", 7),
        (8, "one two", "de", "src4", 7),
        (9, long, "fr", "src5", 1),
        (None, words(rng, 100), None, None, None),
        (None, words(rng, 100), "en", "src1", None),
        (None, None, None, None, None),
        (10, " \n\t ", "es", "src6", 4),
        (11, words(rng, 80), "es", "src6", 4),
        (12, "é ü " * 60, "fr", "", 4),
    ]


@pytest.fixture(scope="session")
def hard_docs(spark, hard_rows):
    return spark.createDataFrame([r + EXTRA_CELLS for r in hard_rows], SCHEMA + EXTRA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA + EXTRA)
