"""Reading and writing tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from kohorta.session import durable
from kohorta.sources.csv_records import read_records
from kohorta.sources.releases import Release


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """A snapshot of several tables: one Parquet table per name."""
    return {n: read_table(spark, folder, n) for n in names}


# Stands for a cell with nothing in it while a file is read; no text equals it.
NOTHING = "\u0000"
# Quotes are doubled inside quotes, cells may hold line breaks, nothing between
# two commas is a missing value and "" an empty text (RFC 4180).
CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    drop: Sequence[str] = (),
    missing: str = NOTHING,
) -> DataFrame:
    """CSV with a header line; ``drop`` names index columns.

    Sheets (such as the drug dimension) are read from their CSV export. A cell
    that does not fit its type is an error. A cell with nothing in it is missing;
    ``missing`` may name a text (such as NA) that is missing too. Without a schema
    the types are those that hold all cells. Files of any size are read in ranges,
    also with line breaks in cells, where quotes are used as ``write_csv`` does:
    around whole cells, and doubled inside.
    """
    options = CSV | {"nullValue": missing, "mode": "FAILFAST", "multiLine": True, "emptyValue": ""}
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items() if k != "header"}
    return read_records(spark, path, schema, options).drop(*drop)


def dated(base: str, day: dt.date | None = None) -> str:
    return f"{base}_{(day or dt.date.today()).isoformat()}"


def write_csv(df: DataFrame, base: str, day: dt.date | None = None) -> str:
    path = f"{dated(base, day)}.csv"
    _put(df, "csv", path)
    return path


def write_parquet(df: DataFrame, base: str, day: dt.date | None = None) -> str:
    path = f"{dated(base, day)}.parquet"
    _put(df, "parquet", path)
    return path


ENDINGS = {"csv": "csv", "parquet": "parquet"}


def write_all(df: DataFrame, targets: Sequence[tuple[str, str]], day: dt.date | None = None) -> list[str]:
    """Write one result to several ``(format, base)`` targets, computing it once.

    The first Parquet target, or else a table in the shared folder, is written
    first; the others are copied from it, so all hold the same rows even where
    computing them again would give others. All are written beside their places
    and moved there together (``releases``): a write that fails leaves every
    target as it was, and moves that were cut off are finished by the next run.
    """
    paths = [f"{dated(base, day)}.{ENDINGS[kind]}" for kind, base in targets]
    if not paths:
        return []
    release = Release(df.sparkSession, list(dict.fromkeys(paths)))
    release.finish()
    try:
        _stage(df, [kind for kind, _ in targets], [release.staged(p) for p in paths])
    except BaseException:
        release.withdraw()
        raise
    release.publish()
    return paths


def _stage(df: DataFrame, kinds: Sequence[str], places: Sequence[str]) -> None:
    first = next((i for i, kind in enumerate(kinds) if kind == "parquet"), None)
    if first is None:
        source = durable(df)
    else:
        df.write.mode("overwrite").parquet(places[first])
        source = df.sparkSession.read.schema(df.schema).parquet(places[first])
    for i, (kind, place) in enumerate(zip(kinds, places)):
        if i != first:
            _put(source, kind, place)


def _put(df: DataFrame, kind: str, path: str) -> None:
    if kind == "csv":
        df.write.mode("overwrite").options(**CSV, emptyValue='""').csv(path)
    else:
        df.write.mode("overwrite").parquet(path)


def add_rows(df: DataFrame, rows: Sequence[Mapping[str, object]]) -> DataFrame:
    """Append literal rows; columns a row does not give become missing."""
    names = [c for c in df.columns if any(c in r for r in rows)]
    kinds = dict(df.dtypes)
    literals = [
        F.struct(*[F.lit(r.get(c)).cast(kinds[c]).alias(c) for c in names]) for r in rows
    ]
    extra = df.sparkSession.range(1).select(F.inline(F.array(*literals)))
    return df.unionByName(extra, allowMissingColumns=True)
