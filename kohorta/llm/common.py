"""Helpers of the text operators: table access, row mapping, caches."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from kohorta.session import shared_folder, ship
from kohorta.sources.tables import read_table

__all__ = ["WordCache", "claim", "durable", "fresh", "map_groups", "map_rows", "query", "read_table", "small_batches"]

# Texts can be long: an Arrow batch is bounded by rows and by bytes.
ROWS_PER_BATCH, BYTES_PER_BATCH = 256, 4 << 20
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def durable(df: DataFrame, codec: str = "snappy") -> DataFrame:
    """Writes ``df`` to the shared folder and continues from the written table."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def query(name: str, sql: str | None = None):
    """Registers a query of this subpackage, with its SQL where there is one."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def small_batches(spark: SparkSession) -> None:
    """Bounds an Arrow batch, and so the memory of a Python worker."""
    ship(spark)
    if not 0 < int(spark.conf.get(BATCH)) <= ROWS_PER_BATCH:
        spark.conf.set(BATCH, str(ROWS_PER_BATCH))
    spark.conf.set(BATCH_BYTES, str(BYTES_PER_BATCH))


def map_rows(
    df: DataFrame, columns: list[str], fn: Callable[..., Iterator[tuple]], schema: str
) -> DataFrame:
    """``fn`` gets one list per column of a batch and yields the output rows."""
    small_batches(df.sparkSession)
    target = df.sparkSession.createDataFrame([], schema).schema
    names = target.fieldNames()
    arrow = pa.schema([(f.name, _ARROW[f.dataType.simpleString()]) for f in target.fields])

    def run(batches):
        for batch in batches:
            rows = list(fn(*(c.to_pylist() for c in batch.columns)))
            cells = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t.type) for c, t in zip(cells, arrow)], schema=arrow
            )

    return df.select(*columns).mapInArrow(run, schema)


def map_groups(
    df: DataFrame, keys: list[str], fn: Callable[..., Iterator[tuple]], schema: str
) -> DataFrame:
    """``fn`` gets, for each group, one list per column that is not a key.

    Groups are sorted next to each other in a task and streamed, so a task holds
    one group at a time; the caller bounds how large a group can be.
    """
    small_batches(df.sparkSession)
    target = df.sparkSession.createDataFrame([], schema).schema
    arrow = pa.schema([(f.name, _ARROW[f.dataType.simpleString()]) for f in target.fields])
    values = [c for c in df.columns if c not in keys]
    n = len(keys)

    def packed(rows):
        cells = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cells, arrow)], schema=arrow)

    def groups(batches):
        key, held = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:n] != key:
                    if held:
                        yield key, held
                    key, held = row[:n], []
                held.append(row[n:])
        if held:
            yield key, held

    def run(batches):
        out = []
        for key, rows in groups(batches):
            out += fn(key, *(list(c) for c in zip(*rows)))
            if len(out) >= 10_000:
                yield packed(out)
                out = []
        if out:
            yield packed(out)

    dealt = df.select(*keys, *values).repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, schema)


_ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "boolean": pa.bool_(),
    "binary": pa.binary(),
    "array<bigint>": pa.list_(pa.int64()),
}


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


_CLEAR: dict[str, Callable[[], None]] = {}
_OWNER: list[str] = []


def claim(owner: str, clear: Callable[[], None]) -> None:
    """Called where a task starts: caches that other operators left in this worker go.

    Workers serve one operator after another, and their memory is shared.
    """
    _CLEAR[owner] = clear
    if _OWNER != [owner]:
        for name, forget in _CLEAR.items():
            if name != owner:
                forget()
        _OWNER[:] = [owner]
        give_back()


def give_back() -> None:
    """Returns freed memory to the system, where the C library can."""
    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


class WordCache(dict):
    """Results per distinct word, emptied when it has grown to ``limit`` words.

    A text repeats its words, so most look-ups never reach ``compute``.
    """

    def __init__(self, compute: Callable, limit: int = 500_000):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, word):
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = self.compute(word)
        return value
