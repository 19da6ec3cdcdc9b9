"""Records of CSV files, read by many tasks also where cells hold line breaks.

A line break ends a record only outside quotes, and whether a line begins outside
depends on all quotes before it in the file. Those are counted first, per byte
range of a file: an odd number of quotes before a range means that it begins
inside a cell. Then every range is cut into records from its known state, and
what is left over at the edges of ranges is put together.
"""

from __future__ import annotations

import csv

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from kohorta.session import durable, ship

QUOTE = '"'
# A record, or the beginning, the middle or the end of one that runs over an edge.
WHOLE, BEGUN, WITHIN, ENDED = range(4)
_PIECES = "file string, block bigint, kind int, first boolean, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the files with the range that they begin in."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


def _begin_inside(lines: DataFrame) -> set[tuple[str, int]]:
    """The ranges that begin inside a cell: at most one entry per range of the input."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    ranges = lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    state = ranges.withColumn("inside", F.coalesce(F.sum("quotes").over(before) % 2, F.lit(0)))
    return {(r["file"], r["block"]) for r in state.filter("inside = 1").collect()}


def _pieces(lines: DataFrame, inside: set[tuple[str, int]]) -> DataFrame:
    """Records of every range, and the parts of records at its edges."""
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("kind", pa.int32()), ("first", pa.bool_()), ("record", pa.string())])

    def emit(file, block, kinds, first, records):
        n = len(records)
        cells = [pa.array([file] * n, pa.string()), pa.array([block] * n, pa.int64()), pa.array(kinds, pa.int32()), pa.array(first, pa.bool_())]
        return pa.RecordBatch.from_arrays([*cells, pa.array(records, pa.string())], schema=schema)

    def run(batches):
        now, held, begun, first = None, [], False, False

        def left():
            """What is open at the end of a range."""
            if held:
                yield emit(*now, [BEGUN if begun else WITHIN], [first and begun], ["\n".join(held)])

        for batch in batches:
            files, blocks, values = batch.columns
            changes = np.flatnonzero(
                pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(blocks[1:], blocks[:-1])).to_numpy(zero_copy_only=False)
            )
            cuts = [0, *(changes + 1).tolist(), len(values)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if (here := (files[a].as_py(), blocks[a].as_py())) != now:
                    yield from left()
                    now, held, first = here, [], here[1] == 0
                    begun = now not in inside
                    odd = 0 if begun else 1
                part = values.slice(a, b - a)
                state = (odd + np.cumsum(pc.count_substring(part, QUOTE).to_numpy())) % 2
                odd = int(state[-1])
                ends = np.flatnonzero(state == 0)
                texts, at, kinds, records, firsts = part.to_pylist(), 0, [], [], []
                for end in ends.tolist():
                    record = texts[end] if at == end and not held else "\n".join([*held, *texts[at : end + 1]])
                    kinds.append(WHOLE if begun else ENDED)
                    records.append(record[:-1] if record.endswith("\r") else record)
                    firsts.append(first and begun)
                    held, begun, first, at = [], True, False, end + 1
                held += texts[at:]
                if records:
                    yield emit(*now, kinds, firsts, records)
        yield from left()

    return lines.mapInArrow(run, _PIECES)


def _records(spark: SparkSession, path: str) -> DataFrame:
    """first, record: every record of the files; ``first`` marks a file's header."""
    ship(spark)
    lines = _lines(spark, path)
    inside = _begin_inside(lines)
    pieces = _pieces(lines, inside)
    whole = pieces.filter(F.col("kind") == WHOLE).select("first", "record")
    if not inside:
        return whole
    # Few rows: at most two per range.
    edges = durable(pieces.filter(F.col("kind") != WHOLE))
    upto = Window.partitionBy("file").orderBy("block", F.col("kind") == BEGUN)
    numbered = edges.withColumn("number", F.sum((F.col("kind") == BEGUN).cast("int")).over(upto))
    joined = numbered.groupBy("file", "number").agg(
        F.max("first").alias("first"), F.sort_array(F.collect_list(F.struct("block", "kind", "record"))).alias("parts")
    )
    return whole.unionByName(joined.select("first", F.array_join(F.col("parts.record"), "\n").alias("record")))


def header_names(records: DataFrame) -> list[str]:
    """Column names; all files must have the same."""
    found = [r[0] for r in records.filter("first").select(F.ltrim(F.col("record"), F.lit("\ufeff"))).distinct().limit(2).collect()]
    if len(found) > 1:
        raise ValueError(f"files have different headers: {found}")
    return next(csv.reader([found[0]])) if found else []


def read_records(spark: SparkSession, path: str, schema: StructType | str | None, options: dict[str, str]) -> DataFrame:
    """The table in CSV files with a header; without a schema its types are inferred."""
    records = _records(spark, path)
    names = header_names(records)
    if schema is None:
        target = None
        plain = StructType()
        for name in names:
            plain = plain.add(name, "string")
    else:
        target = plain = spark.createDataFrame([], schema).schema
        if names and names != plain.fieldNames():
            raise ValueError(f"the header has {names}, the schema {plain.fieldNames()}")
    if not len(plain):
        return spark.createDataFrame([], plain)
    rows = records.filter(~F.col("first") & (F.col("record") != ""))
    parsed = rows.select(F.from_csv("record", F.lit(_ddl(plain)), options).alias("cells")).select("cells.*")
    return parsed if target is not None else as_inferred(parsed)


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)


# What a type must look like in every cell; the first that fits a column is its type.
LONG = r"^[+-]?[0-9]{1,18}$"
DOUBLE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
BOOLEAN = r"^(TRUE|FALSE|true|false)$"


def infer_types(table: DataFrame) -> dict[str, str]:
    """Least type that holds all cells of each text column: boolean, bigint, double or string.

    One aggregate over all columns, of one row. A column without any cell stays text.
    """
    def every(c: Column, pattern: str) -> Column:
        return F.bool_and(F.when(c.isNotNull(), c.rlike(pattern)))

    tests = []
    for i, name in enumerate(table.columns):
        c = F.col(f"`{name.replace('`', '``')}`")
        tests += [every(c, p).alias(f"{t}_{i}") for t, p in (("boolean", BOOLEAN), ("bigint", LONG), ("double", DOUBLE))]
    found = table.agg(*tests).first()
    fits = lambda i: next((t for t in ("boolean", "bigint", "double") if found[f"{t}_{i}"]), "string")
    return {name: fits(i) for i, name in enumerate(table.columns)}


def as_inferred(table: DataFrame) -> DataFrame:
    types = infer_types(table)
    return table.select(*[F.col(f"`{n.replace('`', '``')}`").cast(t).alias(n) for n, t in types.items()])
