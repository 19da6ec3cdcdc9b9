"""Exact duplicates through a persistent digest index, bucketed and sorted by hash."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kohorta.llm.common import durable, fresh, query, read_table
from kohorta.session import shared_folder

# A group of copies is dealt to this many partial groups before it is joined.
SALTS = 64
# A load goes through the index in this many ranges of doc_id, the largest first.
RANGES = 4
# Digests that a bucket of a new index is made for; a small index has LEAST_BUCKETS.
DIGESTS_PER_BUCKET, LEAST_BUCKETS = 1_000_000, 8
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: Column) -> Column:
    """32 bytes that stand for a text with A-Z lower-cased and nothing else; missing counts as empty.

    In a text of ASCII only, ``lower`` does the same as ``translate``, much faster.
    """
    text = F.coalesce(text.cast("string"), F.lit(""))
    ascii_only = F.length(text) == F.octet_length(text)
    small = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, CAPITALS, SMALL))
    return F.unhex(F.sha2(small.cast("binary"), 256))


def digests(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id`` and the digest of its normalised text."""
    return docs.select(F.col(key).cast("bigint").alias("doc_id"), digest(F.col(text)).alias("digest"))


class DigestIndex:
    """All digests seen so far, in a table bucketed and sorted by digest.

    ``append`` adds the digests that the table does not hold yet: the new rows are
    shuffled to the table's buckets and merged with them in an anti-join, and what
    is left is written bucket by bucket; the stored side is never shuffled. The
    number of buckets follows from the first load and stays with the table, which
    lives in the warehouse, or under ``path``, and is opened by name in later runs.
    """

    SCHEMA = "digest binary, keep_id bigint, load string"

    def __init__(self, spark: SparkSession, name: str, path: str | None = None):
        self.spark, self.name, self.path = spark, name, path

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def create(self, expected: int) -> None:
        """An empty table with buckets for ``expected`` digests."""
        buckets = max(LEAST_BUCKETS, 1 << (math.ceil(expected / DIGESTS_PER_BUCKET) - 1).bit_length())
        self._write(self.spark.createDataFrame([], self.SCHEMA), buckets)

    def buckets(self) -> int:
        described = self.spark.sql(f"DESCRIBE FORMATTED {self.name}").filter("col_name = 'Num Buckets'")
        return int(described.first()["data_type"])

    def _write(self, rows: DataFrame, buckets: int) -> None:
        writer = rows.write.bucketBy(buckets, "digest").sortBy("digest").format("parquet").mode("append")
        (writer.option("path", self.path) if self.path else writer).saveAsTable(self.name)

    def read(self) -> DataFrame:
        return self.spark.read.table(self.name)

    def new(self, groups: DataFrame) -> DataFrame:
        """The rows of ``groups`` (one per digest) that the index does not hold."""
        return groups.hint("merge").join(self.read().select("digest"), "digest", "left_anti")

    def append(self, groups: DataFrame, load: str) -> None:
        """Adds the digests that are new; the anti-join leaves them in the table's buckets."""
        rows = self.new(groups).select("digest", "keep_id", F.lit(load).alias("load"))
        self._write(rows, self.buckets())


def ranges(rows: DataFrame, parts: int = RANGES) -> list[Column]:
    """Conditions that cut the rows by doc_id, the largest first, missing ids last."""
    shares = [i / parts for i in range(1, parts)]
    cuts = rows.agg(F.percentile_approx("doc_id", shares, 1000)).first()[0] or []
    key, upper, out = F.col("doc_id"), None, []
    for cut in sorted(set(cuts), reverse=True):
        out.append(key > cut if upper is None else (key > cut) & (key <= upper))
        upper = cut
    out.append(key.isNotNull() if upper is None else key <= upper)
    return [*out, key.isNull()]


def decide(digest_rows: DataFrame, index: DigestIndex) -> DataFrame:
    """Which document of each group of equal texts stays.

    Columns: doc_id, keep_id, group_size, kept, text_sha256, seen_before. The
    largest doc_id of a group stays; among repeated rows of that doc_id one
    stays. A text that the index held before is not kept again: its keep_id is
    the one in the index. A group whose ids are all missing keeps one row.

    The rows go through the index range by range of doc_id, from the largest
    down, each by anti-join and append: a text met in an earlier range is not
    added again, so the index holds the id that stays, and all verdicts are read
    from it by a merge with its buckets. Groups are counted in two steps, and a
    group's verdict returns to its rows by (digest, salt), so a group with a third
    of all rows is spread out.
    """
    rows = _counted(digest_rows)
    out = rows.join(_verdicts(rows, index), ["digest", "salt"])
    # doc_id is not a join key: a missing id is an id like any other.
    return out.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("time"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "seen_before",
    ).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("time") == 1) & ~F.col("seen_before")).alias("kept"),
        "text_sha256",
        "seen_before",
    )


def _counted(digest_rows: DataFrame, *more: Column) -> DataFrame:
    """One row per distinct (text, id), with the times it is there, and a salt."""
    salted = digest_rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    return durable(salted.groupBy("digest", "salt", "doc_id").agg(F.count(F.lit(1)).alias("times"), *more))


def _verdicts(rows: DataFrame, index: DigestIndex) -> DataFrame:
    """digest, salt, keep_id, group_size, seen_before, after the rows went through the index."""
    part = durable(rows.groupBy("digest", "salt").agg(F.sum("times").alias("group_size")))
    load = uuid.uuid4().hex
    if not index.exists():
        index.create(part.count())
    for own in ranges(rows):
        index.append(rows.filter(own).groupBy("digest").agg(F.max("doc_id").alias("keep_id")), load)
    sizes = part.groupBy("digest").agg(F.sum("group_size").alias("group_size"))
    stays = sizes.hint("merge").join(index.read(), "digest").select(
        "digest", "keep_id", "group_size", (F.col("load") != load).alias("seen_before")
    )
    return part.select("digest", "salt").join(durable(stays), "digest")


def new_index(spark: SparkSession) -> DigestIndex:
    """An empty index in the shared folder, for one run."""
    name = f"digests_{uuid.uuid4().hex}"
    return DigestIndex(spark, name, f"{shared_folder(spark)}/{name}")


def keep_one(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The documents that stay, with all their columns; texts move in one shuffle.

    Rows with the same doc_id and equal texts stay once.
    """
    mark = fresh(docs, "row_mark")

    def marked(key: Column, content: Column) -> Column:
        return F.concat(F.coalesce(key.cast("string"), F.lit("-")), F.lit(":"), content)

    # Names one spelling of a text among those that differ in A-Z only.
    spelling = F.concat_ws(".", F.xxhash64("text"), F.coalesce(F.octet_length("text"), F.lit(-1)))
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), digest(F.col("text")).alias("digest"), spelling.alias("spelling"))
    rows = _counted(narrow, F.max("spelling").alias("spelling"))
    stays = rows.join(_verdicts(rows, index), ["digest", "salt"])
    stays = stays.filter(F.col("doc_id").eqNullSafe(F.col("keep_id")) & ~F.col("seen_before"))
    stays = stays.select(marked(F.col("doc_id"), F.col("spelling")).alias(mark))
    out = docs.withColumn(mark, marked(F.col("doc_id"), spelling))
    # Repeated rows share their mark; one of them stays.
    return out.join(stays, mark, "left_semi").dropDuplicates([mark]).drop(mark)


ORACLE = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
  FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, h AS text_sha256, FALSE AS seen_before
FROM d WINDOW w AS (PARTITION BY h)
"""


@query("op10_exact_dedup", ORACLE)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide(digests(read_table(spark, sf_dir, "documents")), new_index(spark))
