"""Near duplicates: joins texts whose word 5-grams have a Jaccard similarity of 0.8 or more."""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from kohorta.llm.common import claim, durable, fresh, map_groups, map_rows, query, read_table
from kohorta.llm.components import components

WORDS = 5
SIMILARITY = 0.8
# 24 bands of 4 values: a pair at 0.8 shares no band with probability 3e-6.
BANDS, BAND_VALUES = 24, 4
VALUES = BANDS * BAND_VALUES
# MinHash values are compared in steps of this many.
STEP = 16
# A pair is dropped when the posterior probability of reaching the threshold is below.
TOLERANCE = 1e-6
# A block of texts compared in one task: at most about this many texts and shingles.
BLOCK_TEXTS, BLOCK_SHINGLES = 1024, 500_000
SALTS = 64

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIERS = np.random.default_rng(20240501).integers(1, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# A word's hash is the sum of its bytes' numbers times powers of an odd number.
_BASE = 0x9E3779B97F4A7C55
_BYTE = np.random.default_rng(20240502).integers(1, 2**63, 256, dtype=np.uint64)
_SLICE = 1 << 18
# The bytes at which ``bytes.split`` cuts.
_BLANK = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & 0xFFFFFFFFFFFFFFFF, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, _SLICE + 1), _powers(pow(_BASE, -1, 1 << 64), _SLICE + 1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def _slices(data: bytes):
    """Stretches of about _SLICE bytes that end with a word."""
    at = 0
    while at < len(data):
        to = min(len(data), at + _SLICE)
        while to < len(data) and not _BLANK[data[to]]:
            to += 1
        yield data[at:to]
        at = to


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words of ``data``, which are cut at ASCII white space.

    All words of a slice at once: differences of a running sum, brought to the
    same power. No word becomes an object and none is kept.
    """
    out = []
    for part in _slices(data):
        codes = np.frombuffer(part, np.uint8)
        inside = np.concatenate(([False], ~_BLANK[codes], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edges[::2], edges[1::2]
        n = len(codes)
        up, down = (_UP, _DOWN) if n <= _SLICE else (_powers(_BASE, n + 1), _powers(pow(_BASE, -1, 1 << 64), n + 1))
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[codes] * up[:n], out=total[1:])
        out.append(_mixed((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word 5-grams of each text.

    Words are cut at ASCII white space and lower-cased. A text of one to four
    words has one shingle, all its words; an empty or missing text has none.
    """
    out = []
    for text in texts:
        flat = word_hashes((text or "").lower().encode("utf-8"))
        n = len(flat)
        if n >= WORDS:
            rolled = np.zeros(n - WORDS + 1, np.uint64)
            for i in range(WORDS):
                rolled = rolled * _MIX + flat[i : i + n - WORDS + 1]
            out.append(np.unique(_mixed(rolled)))
        elif n:
            total = n
            for h in flat.tolist():
                total = (total * int(_MIX) + h) & 0xFFFFFFFFFFFFFFFF
            out.append(_mixed(np.array([total], np.uint64)))
        else:
            out.append(flat)
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of MinHash values per set that is not empty."""
    full = [s for s in sets if len(s)]
    if not full:
        return np.zeros((0, VALUES), np.uint32)
    flat = np.concatenate(full)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in full])[:-1]))
    out, buffer = np.empty((len(full), VALUES), np.uint32), np.empty_like(flat)
    for i, m in enumerate(_MULTIPLIERS):
        np.multiply(flat, m, out=buffer)
        out[:, i] = np.minimum.reduceat(buffer, starts) >> np.uint64(32)
    return out


def least_matches(compared: int, similarity: float = SIMILARITY, tolerance: float = TOLERANCE) -> int:
    """Fewest equal values out of ``compared`` with which a pair stays a candidate.

    With a uniform prior, similarity given m matches of n is Beta(m+1, n-m+1);
    its share above the threshold t is the chance of at most m successes in n+1
    trials of chance t.
    """
    n, t, total = compared + 1, similarity, 0.0
    for m in range(n + 1):
        total += comb(n, m) * t**m * (1 - t) ** (n - m)
        if total >= tolerance:
            return m
    return n


def surviving_pairs(sig: np.ndarray, left: np.ndarray, right: np.ndarray, least: list[int]):
    """Pairs (left, right) whose MinHash values keep the threshold possible."""
    keep_left, keep_right = [], []
    for at in range(0, len(left), 200_000):
        a, b = left[at : at + 200_000], right[at : at + 200_000]
        equal = np.zeros(len(a), np.int16)
        for step, least_equal in enumerate(least):
            part = slice(step * STEP, (step + 1) * STEP)
            equal = equal + (sig[a, part] == sig[b, part]).sum(1, dtype=np.int16)
            stay = equal >= least_equal
            a, b, equal = a[stay], b[stay], equal[stay]
        keep_left.append(a)
        keep_right.append(b)
    return np.concatenate(keep_left), np.concatenate(keep_right)


def local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least reachable index for each of ``n`` items."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, left, root[right])
        np.minimum.at(new, right, root[left])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def block_pairs(blocks: np.ndarray, i: int, j: int):
    """Index pairs inside one block, or across two."""
    if i == j:
        return np.triu_indices(len(blocks), 1)
    one, two = np.flatnonzero(blocks == i), np.flatnonzero(blocks == j)
    return np.repeat(one, len(two)), np.tile(two, len(one))


def into_block_pairs(rows: DataFrame, group: str, blocks: str) -> DataFrame:
    """Deals each group to pairs of blocks (i, j), i <= j, by a hash of its nodes.

    ``blocks`` is the number of blocks of the row's group. Every pair of nodes
    meets in exactly one (i, j); a node is sent once per block of its group.
    """
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col(blocks)).cast("long"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1)))
    return rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other", blocks)


def sketches(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, text_hash, node (identity of the shingle set), n_shingles, signature."""

    def rows(keys, texts, hashes):
        claim("near_dedup", list)
        sets = shingle_sets(texts)
        sig = iter(signatures(sets))
        for k, h, s in zip(keys, hashes, sets):
            if len(s):
                yield k, h, hashlib.blake2b(s.tobytes(), digest_size=16).digest(), len(s), next(sig).tobytes()
            else:
                yield k, h, None, 0, None

    frame = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    return map_rows(
        frame,
        ["doc_id", "text", "text_hash"],
        rows,
        "doc_id bigint, text_hash bigint, node binary, n_shingles bigint, signature binary",
    )


def candidate_edges(sets: DataFrame) -> DataFrame:
    """Edges that span the texts joined by surviving candidate pairs.

    ``sets`` has one row per distinct shingle set. Pairs form only among texts
    that share a band. Bands with the same members are looked at once. A bucket
    is cut into blocks that are compared pairwise in separate tasks; what leaves
    a task is a spanning forest, never the pairs.
    """
    parts = [
        F.substring("signature", 1 + 4 * BAND_VALUES * b, 4 * BAND_VALUES) for b in range(BANDS)
    ]
    bands = sets.select("node", F.posexplode(F.array(*parts)).alias("band", "part")).select(
        "node", F.xxhash64("band", "part").alias("bucket")
    )
    buckets = (
        bands.groupBy("bucket")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.bit_xor(F.xxhash64("node")).alias("x"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
        )
        .filter("n > 1")
        .groupBy("n", "x", "y")
        .agg(F.min("bucket").alias("bucket"))
        .select("bucket", F.ceil(F.col("n") / BLOCK_TEXTS).alias("blocks"))
    )
    members = durable(bands.join(durable(buckets), "bucket"))
    members = members.join(sets.select("node", "signature"), "node")
    dealt = into_block_pairs(members, "bucket", "blocks")
    least = [least_matches((s + 1) * STEP) for s in range(VALUES // STEP)]

    def compare(key, nodes, sigs, blocks):
        _, i, j = key
        order = sorted(range(len(nodes)), key=nodes.__getitem__)
        nodes = [nodes[k] for k in order]
        sig = np.frombuffer(b"".join(sigs[k] for k in order), np.uint32).reshape(len(nodes), VALUES)
        left, right = block_pairs(np.array([blocks[k] for k in order]), i, j)
        if not len(left):
            return
        root = local_roots(len(nodes), *surviving_pairs(sig, left, right, least))
        for k, r in enumerate(root):
            if k != r:
                yield nodes[r], nodes[k]

    dealt = dealt.select("bucket", "i", "j", "node", "signature", "block")
    return map_groups(dealt, ["bucket", "i", "j"], compare, "a binary, b binary")


def exact_links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, similarity: float):
    """The pairs of (left, right) whose Jaccard similarity reaches the threshold."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    order = np.argsort(flat)
    row, flat = np.repeat(np.arange(n, dtype=np.int32), sizes)[order], flat[order]
    new = np.concatenate(([True], flat[1:] != flat[:-1]))[: len(flat)]
    del flat, order
    # Shingles of one text only are in no intersection.
    alone = new & np.append(new[1:], True)
    row, new = row[~alone], new[~alone]
    column = np.cumsum(new) - 1
    n_shared = int(new.sum())
    both = np.zeros((n, n), np.float32)
    for at in range(0, n_shared, 4096):
        a, b = np.searchsorted(column, [at, at + 4096])
        member = np.zeros((n, min(4096, n_shared - at)), np.float32)
        member[row[a:b], column[a:b] - at] = 1
        both += member @ member.T  # counts below 2^24 are exact in this type
    inside = both[left, right].astype(np.int64)
    linked = inside >= similarity * (sizes[left] + sizes[right] - inside) - 1e-9
    return left[linked], right[linked]


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", similarity: float = SIMILARITY
) -> DataFrame:
    """doc_id, class_id, n_links, class_size, kept, text_hash of every row.

    Two texts are linked when the Jaccard similarity of their shingle sets is at
    least ``similarity``; classes are the connected components and are named by
    their largest doc_id. ``n_links`` counts the other documents that are linked
    to this one, copies included. Texts without a word have no links and are
    classes of their own. Repeated rows are copies. A row without doc_id counts as
    any other; a class of such rows only has no name. ``kept`` marks the row that
    stands for its class (and its repeated rows, which no column can tell apart).
    """
    rows = durable(sketches(docs, text, key).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))))
    sets = durable(
        rows.filter(F.col("node").isNotNull())
        .groupBy("node")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.max(F.struct("doc_id", "text_hash")).alias("top"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
        )
        .select("node", "copies", "top.doc_id", "top.text_hash", "n_shingles", "signature")
    )
    groups = components(candidate_edges(sets))
    facts = sets.drop("signature")
    inside = durable(facts.join(groups, "node"))
    sizes = inside.groupBy("root").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)
        ).alias("blocks")
    )
    inside = inside.join(sizes, "root").withColumnsRenamed({"doc_id": "of_doc", "text_hash": "of_hash"})
    # Only one text per distinct shingle set is compared.
    texts = docs.select(F.col(key).alias("text_of"), F.col(text).alias("text")).withColumn("hash_of", F.xxhash64("text"))
    matched = inside.join(
        texts,
        (inside.of_hash == texts.hash_of) & inside.of_doc.eqNullSafe(texts.text_of),
    ).select("root", "node", "copies", "blocks", "text")
    dealt = into_block_pairs(matched, "root", "blocks")

    def verify(key, nodes, copies, texts, blocks):
        claim("near_dedup", list)
        _, i, j = key
        # Repeated rows of the same document arrive together; one is enough.
        order = sorted({n: k for k, n in enumerate(nodes)}.items())
        nodes, picked = [n for n, _ in order], [k for _, k in order]
        left, right = block_pairs(np.array([blocks[k] for k in picked]), i, j)
        if not len(left):
            return
        weight = np.array([copies[k] for k in picked])
        left, right = exact_links(shingle_sets([texts[k] for k in picked]), left, right, similarity)
        links = np.zeros(len(nodes), np.int64)
        np.add.at(links, left, weight[right])
        np.add.at(links, right, weight[left])
        for k, r in enumerate(local_roots(len(nodes), left, right)):
            yield nodes[k], int(links[k]), nodes[r]

    dealt = dealt.select("root", "i", "j", "node", "copies", "text", "block")
    verified = durable(
        map_groups(dealt, ["root", "i", "j"], verify, "node binary, links bigint, near binary")
    )
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(verified.select(F.col("node").alias("a"), F.col("near").alias("b")))
    named = facts.join(links, "node", "left").join(classes, "node", "left").select(
        "node", "copies", F.struct("doc_id", "text_hash").alias("top"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("root", "node").alias("class_node"),
    )
    named = durable(named)
    names = named.groupBy("class_node").agg(
        F.max("top").alias("top"), F.sum("copies").alias("class_size")
    )
    named = named.drop("top").join(names, "class_node").select("node", "top", "n_links", "class_size")
    # Copies of one text may be a third of all rows: they are spread over salts.
    spread = rows.filter(F.col("node").isNotNull()).select("node", "salt").distinct().join(named, "node")
    out = rows.select("doc_id", "text_hash", "node", "salt").join(spread, ["node", "salt"], "left")
    alone = F.col("node").isNull()
    return out.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
        (alone | F.struct("doc_id", "text_hash").eqNullSafe(F.col("top"))).alias("kept"),
        "text_hash",
    )


def keep_representatives(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The document with the largest doc_id of each class, with all columns.

    Texts without words stay. Rows with the same doc_id and text stay once.
    """
    mark = fresh(docs, "row_mark")

    def marked(key, text_hash):
        return F.concat(F.coalesce(key.cast("string"), F.lit("-")), F.lit(":"), text_hash.cast("string"))

    kept = near_duplicates(docs, similarity=similarity).filter("kept")
    kept = kept.select(marked(F.col("doc_id"), F.col("text_hash")).alias(mark))
    rows = docs.withColumn(mark, marked(F.col("doc_id"), F.xxhash64("text")))
    return rows.join(kept, mark, "left_semi").dropDuplicates([mark]).drop(mark)


@query("op2_near_duplicates")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
