"""Cells sorted by time in slices, written once and passed over again and again.

An iterative model (Newton steps, conjugate gradients) needs, in every step, sums
over all cells at or after each time. The cells are range-sorted once, the latest
first; a step is then one narrow pass, or two where what a slice adds has to be
known to the slices behind it. No step shuffles cells.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from kohorta.session import durable, rows_per_task, ship

SLICE = "__slice"
# A slice is held by its task as a whole.
ROWS_PER_SLICE = 1_000_000


@dataclass(frozen=True)
class Timeline:
    """``table`` has the cells and their slice; slice 0 has the latest times."""

    table: DataFrame
    time: str
    slices: int

    def each(self, work: Callable[[int, pa.Table], Iterator[tuple]], schema: str) -> DataFrame:
        """The rows that ``work`` makes of each slice, in one narrow pass."""
        columns = [c for c in self.table.columns if c != SLICE]

        def run(batches):
            for number, part in _slices(batches, columns):
                rows = list(work(number, part))
                if rows:
                    cells = [pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)]
                    yield pa.RecordBatch.from_arrays(cells, schema=arrow)

        arrow = to_arrow_schema(self.table.sparkSession.createDataFrame([], schema).schema)
        return self.table.select(SLICE, *columns).mapInArrow(run, schema)

    def by_slice(self, work: Callable[[int, pa.Table], Iterator[tuple]], schema: str) -> dict[int, list]:
        """One short row per slice, on the driver."""
        found = self.each(lambda number, part: ((number, *r) for r in work(number, part)), f"slice int, {schema}")
        return {r[0]: list(r[1:]) for r in found.collect()}


def _slices(batches, columns):
    now, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        numbers = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        for a, b in zip(cuts, cuts[1:]):
            if numbers[a] != now and held:
                yield now, pa.Table.from_batches(held).combine_chunks()
                held = []
            now = int(numbers[a])
            held.append(batch.slice(a, b - a).select(columns))
    if held:
        yield now, pa.Table.from_batches(held).combine_chunks()


def lay_out(cells: DataFrame, time: str, also: Sequence[str] = ()) -> Timeline:
    """Sorts the cells from the latest time to the first and writes them in slices.

    Slices are cut between times, or with ``also`` between (time, *also), so that
    a time with very many cells takes several slices.
    """
    spark = cells.sparkSession
    ship(spark)
    order = [F.col(time).desc(), *[F.col(c) for c in also]]
    slices = max(1, math.ceil(cells.count() / min(rows_per_task(spark), ROWS_PER_SLICE)))
    dealt = cells.repartitionByRange(slices, *order) if slices > 1 else cells.repartition(1)
    # Files hold few rows, so a file is read by one task in the order written.
    table = durable(dealt.withColumn(SLICE, F.spark_partition_id()).sortWithinPartitions(*order))
    return Timeline(table, time, slices)


def runs(part: pa.Table, time: str) -> np.ndarray:
    """Where each distinct time begins."""
    values = part.column(time).combine_chunks()
    if isinstance(values, pa.ChunkedArray):
        values = values.chunk(0)
    other = pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False)
    return np.concatenate(([0], 1 + np.flatnonzero(other)))


def numbers(part: pa.Table, *names: str) -> list[np.ndarray]:
    return [part.column(n).to_numpy().astype(np.float64) for n in names]
