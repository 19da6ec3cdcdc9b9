"""Ranks all documents for each query item by their terms, through tries of documents.

Documents are restricted to the terms of the items, with their terms from the most
to the least frequent one; documents that begin alike share a path of a trie. Every
branch knows the largest tf of each of its terms and the least m of its documents,
so a bound on its scores is at hand, and an item's search leaves out the branches
that cannot reach its ten best.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from kohorta.llm.common import durable, query, read_table, small_batches

TOP = 10
# Items are worked on in blocks of about this many characters, so what is sent to
# the tasks is bounded however many items there are.
ITEM_CHARS = 8_000_000
# A task searches about this many term entries, in tries of at most TREE_ENTRIES.
TASK_ENTRIES, TREE_ENTRIES = 2_000_000, 2_000_000
# Branches of up to this many documents are scored document by document.
LEAF = 128
# Bytes of a path by which documents are dealt to tasks.
PATH_BYTES = 64

# Bytes that end a term become blanks, A-Z become small; all others stand for themselves.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """Runs of letters, figures and characters beyond ASCII, with A-Z lower-cased."""
    return (text or "").encode("utf-8").translate(_TERM_BYTES).split()


@dataclass
class Items:
    """A block of items: their ids, and per item its terms with repeats counted."""

    ids: list
    counts: list[dict[int, int]]
    vocabulary: dict[bytes, int]


def item_blocks(items: DataFrame, text: str, key: str):
    """The distinct items in blocks of bounded size."""
    own = items.select(F.col(key).alias("item_id"), F.col(text).alias("text")).distinct()
    chars = own.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = math.ceil(chars / ITEM_CHARS)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))
    for number in range(blocks):
        rows = own.filter(block == number).collect()
        rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        vocabulary: dict[bytes, int] = {}
        counts = [
            Counter(vocabulary.setdefault(t, len(vocabulary)) for t in terms_of(r["text"])) for r in rows
        ]
        yield Items([r["item_id"] for r in rows], counts, vocabulary)


def restricted_vectors(docs: DataFrame, items: Items, text: str, key: str) -> DataFrame:
    """doc_id, n (all terms), term numbers of the items and their tf, for documents with a term."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(items.vocabulary)
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tf", pa.list_(pa.int32()))])

    def run(batches):
        number = sent.value.get
        for batch in batches:
            n, found, sizes = [], [], []
            for t in batch.column(1).to_pylist():
                words = terms_of(t)
                own = [i for i in map(number, words) if i is not None]
                n.append(len(words))
                sizes.append(len(own))
                found += own
            row = np.repeat(np.arange(len(n), dtype=np.int64), sizes)
            entry, tf = np.unique(row << 32 | np.array(found, np.int64), return_counts=True)
            offsets = pa.array(np.searchsorted(entry >> 32, np.arange(len(n) + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v.astype(np.int32))) for v in (entry & 0xFFFFFFFF, tf)]
            out = pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), *lists], schema=schema)
            yield out.filter(pa.array(np.array(n) > 0))

    frame = docs.select(F.col(key).cast("bigint"), F.col(text))
    return frame.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, tf array<int>")


def weights(vectors: DataFrame, items: Items) -> tuple[int, int, np.ndarray, np.ndarray]:
    """N, L, and per term of the items its weight and its rank by falling frequency."""
    documents, length = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
    seen = np.zeros(len(items.vocabulary), np.int64)
    for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        seen[r["t"]] = r["count"]
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in seen], np.int64)
    rank = np.empty(len(seen), np.int64)
    rank[np.lexsort((np.arange(len(seen)), -seen))] = np.arange(len(seen))
    return documents, length or 0, weight, rank


def paths(vectors: DataFrame, documents: int, length: int, weight: np.ndarray, rank: np.ndarray) -> DataFrame:
    """doc_id, m, path (ranks of the terms with weight, rising, 4 bytes each), tf in that order."""
    sent = vectors.sparkSession.sparkContext.broadcast((weight, rank))
    m = F.expr(f"25L + (75L * n * {documents}L) div {max(length, 1)}L")
    schema = pa.schema([("doc_id", pa.int64()), ("m", pa.int64()), ("path", pa.binary()), ("tf", pa.binary())])

    def run(batches):
        weight, rank = sent.value
        for batch in batches:
            lists, tfs = batch.column(2), batch.column(3)
            terms = lists.flatten().to_numpy()
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            stay = weight[terms] > 0
            place, row, tf = rank[terms[stay]], row[stay], tfs.flatten().to_numpy()[stay]
            order = np.argsort(row << 32 | place)
            offsets = 4 * np.searchsorted(row, np.arange(len(lists) + 1))
            offsets = pa.py_buffer(offsets.astype("<i4"))
            cells = [
                pa.Array.from_buffers(pa.binary(), len(lists), [None, offsets, pa.py_buffer(v[order].astype(kind))])
                for v, kind in ((place, ">u4"), (tf, "<u4"))
            ]
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cells], schema=schema)
            yield out.filter(pa.array(np.diff(np.frombuffer(offsets, "<i4")) > 0))

    return vectors.select("doc_id", m.alias("m"), "terms", "tf").mapInArrow(run, "doc_id bigint, m bigint, path binary, tf binary")


def saturated(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Trie:
    """Documents sorted by path, as a trie whose small branches are kept whole.

    Children of a node are neighbours in the node tables. A node's entries are the
    terms of its documents with what each can add at most.
    """

    def __init__(self, keys: np.ndarray, m: np.ndarray, paths: list[bytes], tfs: list[bytes]):
        self.keys = keys
        size = np.array([len(p) // 4 for p in paths], np.int64)
        self.starts = np.append(0, np.cumsum(size))
        self.ranks = np.frombuffer(b"".join(paths), ">u4").astype(np.int64)
        tf = np.frombuffer(b"".join(tfs), "<u4").astype(np.int64)
        self.values = saturated(tf, np.repeat(m, size))
        # Node tables: documents from low to high, and children from first to last.
        self.low, self.high, self.first, self.last = [0], [len(paths)], [0], [0]
        node, depth = 0, [0]
        while node < len(self.low):
            low, high = self.low[node], self.high[node]
            if high - low > LEAF:
                common = self.shared(low, high, depth[node])
                cuts = self.branches(low, high, common)
                if len(cuts) > 2:
                    self.first[node], self.last[node] = len(self.low), len(self.low) + len(cuts) - 1
                    for a, b in zip(cuts, cuts[1:]):
                        self.low.append(a)
                        self.high.append(b)
                        self.first.append(0)
                        self.last.append(0)
                        depth.append(common)
            node += 1
        self.summaries(tf, m)

    def shared(self, low: int, high: int, depth: int) -> int:
        """Terms that the documents from low to high have in common at their beginning."""
        a, b = self.starts[low], self.starts[high - 1]
        n = min(self.starts[low + 1] - a, self.starts[high] - b)
        other = self.ranks[a + depth : a + n] != self.ranks[b + depth : b + n]
        return depth + (int(other.argmax()) if other.any() else len(other))

    def branches(self, low: int, high: int, depth: int) -> list[int]:
        """Where the next term changes; neighbouring small branches go together."""
        at = self.starts[low:high] + depth
        inside = at < self.starts[low + 1 : high + 1]
        term = np.where(inside, self.ranks[np.minimum(at, len(self.ranks) - 1)], -1)
        cuts = [low, *(low + 1 + np.flatnonzero(np.diff(term))).tolist(), high]
        kept = [low]
        for a, b in zip(cuts[1:], cuts[2:]):
            if b - kept[-1] > LEAF:
                kept.append(a)
        return [*kept, high]

    def summaries(self, tf: np.ndarray, m: np.ndarray) -> None:
        """Largest tf per term and least m of every node, children first."""
        n = len(self.low)
        terms, largest = [np.zeros(0, np.int64)] * n, [np.zeros(0, np.int64)] * n
        self.least_key = np.zeros(n, np.int64)
        values = [np.zeros(0, np.int64)] * n
        for node in range(n - 1, -1, -1):
            low, high = self.low[node], self.high[node]
            children = range(self.first[node], self.last[node])
            if children:
                own, most = np.concatenate([terms[c] for c in children]), np.concatenate([largest[c] for c in children])
            else:
                part = slice(self.starts[low], self.starts[high])
                own, most = self.ranks[part], tf[part]
            order = np.argsort(own, kind="stable")
            own, most = own[order], most[order]
            at = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            terms[node], largest[node] = own[at], np.maximum.reduceat(most, at)
            values[node] = saturated(largest[node], m[low:high].min())
            self.least_key[node] = self.keys[low:high].min()
        self.node_starts = np.append(0, np.cumsum([len(t) for t in terms]))
        self.node_terms, self.node_values = np.concatenate(terms), np.concatenate(values)

    def bounds(self, first: int, last: int, gain: np.ndarray) -> np.ndarray:
        """What a document of each node from first to last can score at most."""
        a, b = self.node_starts[first], self.node_starts[last]
        return np.add.reduceat(gain[self.node_terms[a:b]] * self.node_values[a:b], self.node_starts[first:last] - a)

    def search(self, gain: np.ndarray, best: list[tuple], top: int) -> list[tuple]:
        """``best`` with this trie's documents: up to ``top`` of (-score, key, row)."""
        stack = [(int(self.bounds(0, 1, gain)[0]), 0)]
        while stack:
            bound, node = stack.pop()
            full = len(best) == top
            if not bound or full and (-bound, int(self.least_key[node])) > best[-1][:2]:
                continue
            first, last = self.first[node], self.last[node]
            if first < last:
                bounds = self.bounds(first, last, gain)
                order = np.argsort(bounds, kind="stable")
                stack += zip(bounds[order].tolist(), (first + order).tolist())
                continue
            low, high = self.low[node], self.high[node]
            a, b = self.starts[low], self.starts[high]
            score = np.add.reduceat(gain[self.ranks[a:b]] * self.values[a:b], self.starts[low:high] - a)
            least = max(1, -best[-1][0]) if full else 1
            hits = np.flatnonzero(score >= least)
            if len(hits) > top:
                hits = hits[np.lexsort((self.keys[low + hits], -score[hits]))[:top]]
            if len(hits):
                found = zip((-score[hits]).tolist(), self.keys[low + hits].tolist(), (low + hits).tolist())
                best = sorted([*best, *found], key=lambda x: x[:2])[:top]
        return best


NO_ID = np.iinfo(np.int64).max


def search(paths: DataFrame, items: Items, weight: np.ndarray, rank: np.ndarray, top: int, tasks: int) -> DataFrame:
    """The best documents of every task for every item: item, item_id, doc_id, score.

    Documents are dealt to tasks and sorted by path, so a task's tries are branches
    of the trie of all documents; equal paths (copies) may go to several tasks.
    """
    gains = []
    for counts in items.counts:
        terms = np.array(list(counts), np.int64)
        gains.append((rank[terms], np.array(list(counts.values()), np.int64) * weight[terms]))
    sent = paths.sparkSession.sparkContext.broadcast((items.ids, gains, len(weight)))
    schema = pa.schema([("item", pa.int32()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        ids, gains, size = sent.value
        best: list[list] = [[] for _ in ids]
        gain = np.zeros(size, np.int64)

        def searched(held):
            table = pa.Table.from_batches(held)
            keys = table.column("doc_id").fill_null(NO_ID).to_numpy()
            trie = Trie(keys, table.column("m").to_numpy(), table.column("path").to_pylist(), table.column("tf").to_pylist())
            for i, (terms, values) in enumerate(gains):
                gain[terms] = values
                best[i] = [x[:2] + (0,) for x in trie.search(gain, best[i], top)]
                gain[terms] = 0

        held, entries = [], 0
        for batch in batches:
            held.append(batch)
            entries += batch.column("path").nbytes // 4
            if entries >= TREE_ENTRIES:
                searched(held)
                held, entries = [], 0
        if held:
            searched(held)
        rows = [(i, ids[i], None if k == NO_ID else k, -s) for i, found in enumerate(best) for s, k, _ in found]
        cells = list(zip(*rows)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cells, schema)], schema=schema)

    dealt = paths.repartitionByRange(tasks, F.substring("path", 1, PATH_BYTES), F.xxhash64("doc_id", "m"))
    dealt = dealt.sortWithinPartitions("path").select("doc_id", "m", "path", "tf")
    return dealt.mapInArrow(run, "item int, item_id bigint, doc_id bigint, score bigint")


RESULT = "item_id bigint, rank int, doc_id bigint, score bigint"


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_key: str = "item_id",
) -> DataFrame:
    """item_id, rank, doc_id, score of the ``top`` documents with a score above 0 per item.

    Missing and empty texts have no terms: such documents are not counted and such
    items have no rows. Equal rows of ``items`` are one item; items with the same id
    and other texts are ranked one by one. Repeated rows of a document are ranked
    like any other; of equal scores the smaller doc_id comes first, a missing one
    last.
    """
    out = docs.sparkSession.createDataFrame([], RESULT)
    for block in item_blocks(items, item_text, item_key):
        vectors = durable(restricted_vectors(docs, block, text, key), "zstd")
        documents, length, weight, rank = weights(vectors, block)
        entries = vectors.agg(F.sum(F.size("terms"))).first()[0] or 0
        ordered = durable(paths(vectors, documents, length, weight, rank), "zstd")
        found = search(ordered, block, weight, rank, top, max(1, math.ceil(entries / TASK_ENTRIES)))
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        out = out.unionByName(found.select("item_id", "rank", "doc_id", "score"))
    return out


TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_SMALL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_SMALL.format("text")}, '{TERMS}') AS t FROM documents
), long AS (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d WHERE len(t) > 0
), total AS (SELECT count(DISTINCT r) AS big_n, count(*) AS big_l FROM long
), tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM long GROUP BY ALL
), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term
), i AS (SELECT DISTINCT item_id, text FROM benchmark
), q AS (
  SELECT item_id, text, term, count(*) AS times
  FROM (SELECT item_id, text, unnest(regexp_extract_all({_SMALL.format("text")}, '{TERMS}')) AS term FROM i) GROUP BY ALL
), scores AS (
  SELECT q.item_id, q.text, tf.r, tf.doc_id,
         sum(q.times * CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / (2 * df.df + 1))) AS BIGINT)
             * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (25 + (75 * tf.n * big_n) // big_l)))) AS score
  FROM q JOIN tf USING (term) JOIN df USING (term), total GROUP BY ALL
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= {TOP}
"""


@query("op12_lexical_search", ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
