"""Cohort restriction, attribution to an index event, anchor comparisons, merge.

Cohort and index tables grow with the data, so they are not broadcast as a whole:
the optimizer decides by their size, and only the share of very large keys, which
is counted first, is sent to the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from kohorta.operators.events import keep_first
from kohorta.operators.keys import as_list, equi_join, keyed_join, pairs
from kohorta.session import bucketed, fits_broadcast, settled, ship, together


def restrict(
    df: DataFrame, keys: DataFrame, on, how: str = "semi", substring: bool = False
) -> DataFrame:
    """Keep ("semi") or drop ("anti") the rows whose key is in ``keys``.

    ``substring`` also accepts a key that contains one of the listed keys.
    """
    if how not in ("semi", "anti"):
        raise ValueError("how must be 'semi' or 'anti'")
    (left, right), *more = pairs(on)
    if not substring:
        return keyed_join(df, keys.select(*[r for _, r in pairs(on)]).distinct(), on, f"left_{how}")
    if more:
        raise ValueError("substring membership takes one key")
    return keyed_join(df, _containing(df, left, keys, right), left, f"left_{how}")


# Numbers that stand for characters: a piece's hash is the sum of its characters' numbers times powers of an odd base.
_HASH_BASE = 0x9E3779B97F4A7C55
_HASH_MIX = 0xBF58476D1CE4E5B9


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base % (1 << 64), np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def window_hashes(text: str, lengths: Sequence[int]) -> dict[int, np.ndarray]:
    """Per length the distinct 64-bit hashes of all pieces of that length, from one running sum."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    codes = (codes + np.uint64(1)) * np.uint64(_HASH_MIX)
    codes ^= codes >> np.uint64(29)
    n = len(codes)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(codes * _powers(_HASH_BASE, n), out=total[1:])
    back = _powers(pow(_HASH_BASE, -1, 1 << 64), n + 1)
    return {
        k: np.unique(((total[k:] - total[: n + 1 - k]) * back[: n + 1 - k]).view(np.int64)) for k in lengths if 0 < k <= n
    }


def _hashed(values: DataFrame, column: str, lengths: Sequence[int] | None) -> DataFrame:
    """``column``, length, hash: of every piece with one of the lengths, or of the whole text."""
    ship(values.sparkSession)
    names = [column, "__length", "__hash"]

    def run(batches):
        for batch in batches:
            texts = batch.column(0)
            row, length, hashes = [], [], []
            for i, text in enumerate(texts.to_pylist()):
                for k, found in window_hashes(text, lengths if lengths is not None else [len(text)]).items():
                    row.append(np.full(len(found), i))
                    length.append(np.full(len(found), k))
                    hashes.append(found)
            if row:
                cells = [texts.take(pa.array(np.concatenate(row))), pa.array(np.concatenate(length)), pa.array(np.concatenate(hashes))]
                yield pa.RecordBatch.from_arrays(cells, names=names)

    return values.select(F.col(column).cast("string")).mapInArrow(run, f"`{column}` string, __length bigint, __hash bigint")


def _containing(df: DataFrame, left: str, keys: DataFrame, right: str) -> DataFrame:
    """Distinct ``left`` values that contain a listed key, found by equi-join.

    Every piece of the value that has the length of some listed key is looked up by
    a rolling hash, so the work grows with the text and not with the number of key
    pairs, and no piece is ever cut out; matches of the hashes are then verified.
    Only the lengths of the keys are known to the driver. An empty key is in every
    value.
    """
    wanted = keys.select(F.col(right).cast("string").alias("__piece")).filter(F.col(right).isNotNull()).distinct()
    wanted = settled(wanted)
    lengths = sorted(r[0] for r in wanted.select(F.length("__piece")).distinct().collect())
    distinct = df.select(left).filter(F.col(left).isNotNull()).distinct()
    if lengths[:1] == [0] or not lengths:
        return distinct if lengths else distinct.limit(0)
    pieces = _hashed(distinct, left, lengths)
    looked_up = _hashed(wanted, "__piece", None)
    met = pieces.join(looked_up, ["__length", "__hash"])
    return met.filter(F.contains(left, "__piece")).select(left).distinct()


def semi_or_anti(df: DataFrame, absent: DataFrame, present: DataFrame, on: str) -> DataFrame:
    """Rows whose key is not in ``absent`` or is in ``present``."""
    a = absent.select(on).distinct().withColumn("__absent", F.lit(True))
    p = present.select(on).distinct().withColumn("__present", F.lit(True))
    flagged = keyed_join(keyed_join(df, a, on), p, on)
    return flagged.filter(F.col("__absent").isNull() | F.col("__present")).select(*df.columns)


def natural_join(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on all columns that both tables have, missing keys matching."""
    common = [c for c in left.columns if c in right.columns]
    if not common:
        raise ValueError("no common columns")
    return equi_join(left, right, common, how, na_matches=True)


def full_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Full join as a left join plus the unmatched right rows.

    A full outer join cannot split a large key at run time; these two joins can.
    """
    keys = pairs(on)
    both = keyed_join(left, right, on, "left", na_matches=True)
    seen = left.select(*[l for l, _ in keys]).distinct()
    only = equi_join(
        right.withColumnsRenamed({r: l for l, r in keys}), seen, [l for l, _ in keys],
        "left_anti", na_matches=True,
    )
    return both.unionByName(only, allowMissingColumns=True)


def lookup(df: DataFrame, dimension: DataFrame, on: Mapping[str, str], normalize=None) -> DataFrame:
    """Left join to a dimension with one row per name.

    ``normalize`` (for example lower-casing) is applied to both sides for the
    comparison; the table's own column is kept as it is.
    """
    (left, right), = on.items()
    if normalize is None:
        if fits_broadcast(dimension):
            # No row is shuffled, so no name can be too large for a task.
            return equi_join(df, F.broadcast(dimension), on, "left", na_matches=True)
        return keyed_join(df, dimension, on, "left", na_matches=True)
    probe = df.withColumn("__probe", normalize(F.col(left)))
    build = dimension.withColumn(right, normalize(F.col(right)))
    return keyed_join(probe, build, {"__probe": right}, "left", na_matches=True).drop("__probe")


def resolve_pairs(
    cohort: DataFrame,
    left: DataFrame,
    right: DataFrame,
    key: Sequence[str] | str,
    left_on: Mapping[str, str],
    right_on: Mapping[str, str],
) -> DataFrame:
    """Look up chosen (left, right) pairs of a key without forming all pairs.

    Gives the rows of ``cohort`` with the columns of its pair out of the full
    join of ``left`` and ``right`` on ``key``. ``left_on`` / ``right_on`` map
    cohort columns to the columns that identify a row on each side. Both sides
    are looked up on their own: a pair exists when both rows do, or when one row
    does, the key has no rows on the other side and the cohort names none.
    """
    key = as_list(key)

    def side(df: DataFrame, on: Mapping[str, str], tag: str):
        joined_on = {k: k for k in key} | dict(on)
        taken = df.withColumn(f"__{tag}_row", F.lit(True))
        some = df.select(*key).distinct().withColumn(f"__{tag}_any", F.lit(True))
        return joined_on, taken, some

    out = cohort
    for df, on, tag in ((left, left_on, "left"), (right, right_on, "right")):
        joined_on, taken, some = side(df, on, tag)
        out = keyed_join(out, taken, joined_on, "left", na_matches=True)
        out = keyed_join(out, some, key, "left", na_matches=True)

    def present(on: Mapping[str, str], tag: str) -> Column:
        unnamed = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in on])
        return F.col(f"__{tag}_row").isNotNull() | (F.col(f"__{tag}_any").isNull() & unnamed)

    some_row = F.col("__left_any").isNotNull() | F.col("__right_any").isNotNull()
    found = present(left_on, "left") & present(right_on, "right") & some_row
    added = [
        c
        for df, on in ((left, left_on), (right, right_on))
        for c in df.columns
        if c not in key and c not in on.values()
    ]
    return out.select(
        *cohort.columns, *[F.when(found, F.col(c)).alias(c) for c in added]
    )


def attribute(
    events: DataFrame,
    index: DataFrame,
    on: Mapping[str, str],
    columns: Sequence[str] = (),
    na_matches: bool = True,
) -> DataFrame:
    """Events that carry the key and site of the index event."""
    side = index.select(*[r for _, r in pairs(on)], *columns)
    return keyed_join(events, side, on, "inner", na_matches)


def attribute_fallback(
    events: DataFrame,
    attributed: DataFrame,
    index: DataFrame,
    key: str,
    unknown: Column | None = None,
    mode: str = "absent",
    also: DataFrame | None = None,
    count: str = "number_of_dx",
) -> DataFrame:
    """Unknown-site events of keys whose index table counts one diagnosis.

    ``mode`` "absent" takes keys without attributed events ("present" keys with
    one); ``also`` names further keys that are accepted. Without ``unknown``
    the site is not tested.
    """
    if mode == "present":
        open_events = restrict(events, attributed, key)
    elif also is not None:
        open_events = semi_or_anti(events, attributed, also, key)
    else:
        open_events = restrict(events, attributed.select(key).distinct(), key, "anti")
    if unknown is not None:
        open_events = open_events.filter(unknown)
    single = index.filter(F.col(count) == 1).select(key)
    return keyed_join(open_events, single, key, "inner")


def pick_nearest(
    df: DataFrame,
    anchor: DataFrame,
    key: str,
    time: str,
    anchor_time: str,
    order_by,
    direction: str = "both",
    by: Sequence[str] = (),
    how: str = "inner",
    distance: str | None = None,
) -> DataFrame:
    """One row per (key, by): the nearest to the anchor time.

    "both" takes the smallest absolute distance; "forward" the first row at or
    after the anchor, then rows before it or without a time. Rows without a
    distance come last.
    """
    joined = keyed_join(df, anchor.select(key, anchor_time), key, how)
    gap = F.col(time) - F.col(anchor_time)
    gap = F.abs(gap) if direction == "both" else F.when(gap >= 0, gap)
    name = distance or "__gap"
    picked = keep_first(
        joined.withColumn(name, gap), [key, *by], [name, *as_list(order_by)]
    )
    return picked if distance else picked.drop(name)


def label_sequence(
    df: DataFrame,
    anchor: DataFrame,
    key: str,
    time: str,
    anchor_time: str,
    labels: tuple[str, str],
    name: str,
) -> DataFrame:
    """Label events as up to the anchor time or after it."""
    joined = keyed_join(df, anchor.select(key, anchor_time), key, "left")
    t, t0 = F.col(time), F.col(anchor_time)
    label = F.when(t <= t0, F.lit(labels[0])).when(t > t0, F.lit(labels[1]))
    return joined.withColumn(name, label).drop(anchor_time)


def merge_on_index(
    index: DataFrame,
    required_any: Sequence[DataFrame],
    others: Sequence[DataFrame],
    key: str,
    buckets: int | None = None,
) -> DataFrame:
    """Wide table: index rows present in a required table, with all columns.

    Same rows as full-joining the required tables, then inner-joining the index
    and left-joining the others, but every join keeps the index table's
    partitioning, which a chain of full joins would lose. With ``buckets`` the
    tables are written first, side by side, in that many buckets by key: the
    joins then shuffle nothing, and a lost executor costs the joins of its
    buckets, not the tables. That takes tables with few rows per key.
    """
    if buckets is not None:
        # Rows without a key meet nothing, and would all come to one bucket.
        tables = [index, *[t.filter(F.col(key).isNotNull()) for t in (*required_any, *others)]]
        index, *pieces = together(index.sparkSession, *[partial(bucketed, table, key, buckets) for table in tables])
        required_any, others = pieces[: len(required_any)], pieces[len(required_any) :]
    out = index
    flags = []
    for i, table in enumerate(required_any):
        flag = f"__has_{i}"
        flags.append(F.col(flag))
        out = equi_join(out, table.withColumn(flag, F.lit(True)), key, "left")
    if flags:
        out = out.filter(reduce(lambda a, b: a | b, [f.isNotNull() for f in flags]))
        out = out.drop(*[f"__has_{i}" for i in range(len(flags))])
    columns = [*out.columns, *[c for table in others for c in table.columns if c != key]]
    # Wide tables come last, so that their columns pass through few joins.
    for table in sorted(others, key=lambda t: len(t.columns)):
        out = equi_join(out, table, key, "left")
    return out.select(*columns)
