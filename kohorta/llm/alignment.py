"""Aligns the tokens of two tokenizers and scores the links by how common their id pair is.

Tokens of A and B are linked where their byte ranges overlap. How often a pair of
ids is linked in the corpus comes from an inverted index: per pair and block of
documents a compressed bitmap of the documents that have the pair, and bitmaps of
the binary digits of its further links in a document.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from kohorta.llm.common import claim, durable, query, read_table, small_batches
from kohorta.llm.packing import evenly_spaced
from kohorta.llm.token_counts import byte_symbols, vocabulary_path

# Documents of a block, and the links after which a block ends early.
BLOCK_BITS = 12
BLOCK = 1 << BLOCK_BITS
BLOCK_LINKS = 4_000_000
BITMAP_BYTES = BLOCK // 8
# A pair of ids is one number, a in the upper bits.
ID_BITS = 24
# Stretches of text whose alignment a worker keeps, and how long they may be.
SEGMENTS, SEGMENT_CHARS, SEGMENT_LINKS = 400_000, 48, 8_000_000
# Characters of new segments that go to the libraries in one call.
CALL_CHARS = 16_000

# A space between two other characters: no token of either vocabulary goes across it.
_GAP = re.compile(r"(?<=\S) (?=\S)")
# White space at the beginning or end of a whole text.
_PADDED = re.compile(r"\A\s|\s\Z")
# Texts that tokenizers and tiktoken cut alike.
_PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ0-9.,;:!?|#$%&*\n-]*")


class Aligner:
    """Alignment of both tokenizations of a text, kept per stretch between spaces.

    ``path`` is a byte-level BPE file of ``tokenizers``, ``ranks_path`` the same
    vocabulary as ranks, ``model_path`` a ``sentencepiece`` model whose pieces
    hold the space sign only at their beginning. Then no token of either goes
    across a single space, both end there, and a text is the chain of its parts.
    """

    def __init__(self, path: str, ranks_path: str, model_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import base64

        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path)
        self.a.encode_special_tokens = True
        byte_of = {s: b for b, s in enumerate(byte_symbols())}
        names = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.a_bytes[i] = bytes(byte_of[c] for c in name) if all(c in byte_of for c in name) else name.encode()
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(x): int(n) for x, n in map(bytes.split, file)}
        self.ranks = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.b = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.b_bytes = []
        pieces_part = True
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes.append(bytes([int(piece[3:5], 16)]))
                continue
            self.b_bytes.append(piece.replace("▁", " ").encode("utf-8"))
            pieces_part = pieces_part and "▁" not in piece.lstrip("▁")
        self.sizes = tuple(np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))
        figures = [str(i).encode() for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.decimals = np.array(figures, "S9").view(np.uint8).reshape(len(figures), 9)
        if not pieces_part:
            raise ValueError("a piece of the model holds a space after other characters")
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        self.counts = [array("q"), array("q"), array("q"), array("q")]  # a, b, groups, links
        self.wrong = array("b")
        self.groups: list[str] = []
        self.links = array("Q")
        self.starts = array("q", [0])

    def add(self, segments: list[str], sizes, groups: list[str], links: np.ndarray, wrong: bool = False) -> None:
        first = len(self.groups)
        self.places.update(zip(segments, range(first, first + len(segments))))
        for column, size in zip(self.counts, sizes):
            column.frombytes(np.asarray(size, np.int64).tobytes())
        self.wrong.extend([wrong] * len(segments))
        self.groups += groups
        self.starts.frombytes((len(self.links) + np.cumsum(sizes[3], dtype=np.int64)).tobytes())
        self.links.frombytes(links.tobytes())

    def learn(self, segments: list[str]) -> None:
        """Aligns new segments, many in one text: at the spaces between them both tokens end.

        A segment with white space at an end stays alone, as a blank may go into
        one token with the space that would be put next to it.
        """
        plain, other = [], []
        for segment in segments:
            if _PADDED.search(segment):
                self.learn_joined([segment], self.any_ids)
            else:
                (plain if _PLAIN.fullmatch(segment) else other).append(segment)
        for kind, encode in (plain, self.plain_ids), (other, self.any_ids):
            at = 0
            while at < len(kind):
                to, size = at, 0
                while to < len(kind) and size < CALL_CHARS:
                    size, to = size + len(kind[to]), to + 1
                self.learn_joined(kind[at:to], encode)
                at = to

    def plain_ids(self, text: str) -> list[int]:
        return self.ranks.encode_ordinary(text)

    def any_ids(self, text: str) -> list[int]:
        return self.a.encode(text, add_special_tokens=False).ids

    def learn_joined(self, segments: list[str], encode) -> None:
        text = " ".join(segments)
        a, b = encode(" " + text), self.b.encode(text)
        data = (" " + text).encode("utf-8")
        if data != b"".join([self.a_bytes[i] for i in a]) or data != b"".join([self.b_bytes[i] for i in b]):
            if len(segments) > 1:
                for segment in segments:
                    self.learn_joined([segment], encode)
            else:
                self.add(segments, [[0]] * 4, [""], np.zeros(0, np.uint64), wrong=True)
            return
        ends = np.cumsum([len(s.encode("utf-8")) + 1 for s in segments])
        self.add(segments, *align(np.array(a), np.array(b), self.sizes, ends, self.decimals))

    def documents(self, texts: list[str | None]):
        """Per text the four counts and the digest of its groups; its links over all texts.

        Returns (counts as rows, digests, links as one array, links per text).
        """
        if len(self.groups) > SEGMENTS or len(self.links) > SEGMENT_LINKS:
            self.forget()
        cut = [(t.split(" ") if evenly_spaced(t) else _GAP.split(t)) if t else [] for t in texts]
        known, groups = self.places, self.groups
        new = dict.fromkeys(s for part in cut for s in part if s not in known)
        self.learn(list(new))
        parts = [[known[s] for s in part] for part in cut]
        for s in new:
            if len(s) > SEGMENT_CHARS:
                del known[s]
        ids = np.fromiter(chain.from_iterable(parts), np.int64, sum(map(len, parts)))
        row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        wrong = np.zeros(len(parts), bool)
        wrong[row[np.frombuffer(self.wrong, np.int8)[ids] != 0]] = True
        ids, row = ids[~wrong[row]], row[~wrong[row]]
        sums = []
        for column in self.counts:
            total = np.zeros(len(parts), np.int64)
            if len(ids):
                np.add.at(total, row, np.frombuffer(column, np.int64)[ids])
            sums.append(total)
        digests = [
            hashlib.sha256(";".join([groups[i] for i in p]).encode()).hexdigest() if p and not bad else ""
            for p, bad in zip(parts, wrong.tolist())
        ]
        if not len(ids):
            return sums, digests, np.zeros(0, np.uint64), sums[3]
        starts = np.frombuffer(self.starts, np.int64)
        first, size = starts[ids], starts[ids + 1] - starts[ids]
        before = np.cumsum(size) - size
        at = np.repeat(first - before, size) + np.arange(size.sum())
        return sums, digests, np.frombuffer(self.links, np.uint64)[at], sums[3]


def align(a: np.ndarray, b: np.ndarray, sizes_of: tuple[np.ndarray, np.ndarray], ends: np.ndarray, decimals: np.ndarray):
    """Sizes, groups and links of each segment of a text that both tokenizations cover.

    ``ends`` are the byte ends of the segments, ``decimals`` the figures of every id
    with room for a sign after them. Every stretch between neighbouring ends of
    tokens lies in one A and one B token: those stretches are the links.
    """
    a_size, b_size = sizes_of
    ends_a, ends_b = np.cumsum(a_size[a]), np.cumsum(b_size[b])
    either = np.union1d(ends_a, ends_b)
    in_a, in_b = np.searchsorted(ends_a, either), np.searchsorted(ends_b, either)
    links = a[in_a].astype(np.uint64) << np.uint64(ID_BITS) | b[in_b].astype(np.uint64)
    both = ends_a[np.isin(ends_a, ends_b, assume_unique=True)]
    upto = [np.searchsorted(x, ends, "right") for x in (ends_a, ends_b, both, either)]
    sizes = [np.diff(x, prepend=0) for x in upto]
    # A tokens of a group, then its B tokens, then the next group.
    side = np.concatenate([2 * np.searchsorted(both, ends_a), 2 * np.searchsorted(both, ends_b) + 1])
    order = np.argsort(side, kind="stable")
    side, ids = side[order], np.concatenate([a, b])[order]
    last = np.append(side[1:] != side[:-1], True)
    digits = decimals[ids]
    width = (digits > 0).sum(1)
    digits[np.arange(len(ids)), width] = np.where(last, np.where(side % 2 == 0, ord("|"), ord(";")), ord(","))
    text = digits[digits > 0].tobytes().decode("ascii")
    cuts = np.append(0, np.cumsum(width + 1)[upto[0] + upto[1] - 1]).tolist()
    return sizes, [text[x : y - 1] for x, y in zip(cuts, cuts[1:])], links


_ALIGNERS: dict[tuple, Aligner] = {}


def aligner(*paths: str) -> Aligner:
    """One aligner per worker and vocabularies."""
    if paths not in _ALIGNERS:
        _ALIGNERS[paths] = Aligner(*paths)
    return _ALIGNERS[paths]


# Bitmaps over the documents of a block. One of few documents lists their places in
# 16 bits each, any other is BITMAP_BYTES bytes; the length tells them apart.


def packed_bitmaps(pairs: np.ndarray, places: np.ndarray):
    """Distinct pairs and, per pair, the bitmap of its places.

    Both arrays are sorted by pair, then place. Bitmaps come as one buffer with
    offsets.
    """
    first = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1])))
    size = np.diff(np.append(first, len(pairs)))
    dense = 2 * size >= BITMAP_BYTES
    offsets = np.concatenate(([0], np.cumsum(np.where(dense, BITMAP_BYTES, 2 * size))))
    buffer = np.zeros(offsets[-1], np.uint8)
    row = np.repeat(np.arange(len(first)), size)
    rank = np.arange(len(pairs)) - first[row]
    few = ~dense[row]
    buffer.view("<u2")[offsets[row[few]] // 2 + rank[few]] = places[few]
    for i in np.flatnonzero(dense):
        bits = np.zeros(BLOCK, np.uint8)
        bits[places[first[i] : first[i] + size[i]]] = 1
        buffer[offsets[i] : offsets[i + 1]] = np.packbits(bits)
    return pairs[first], offsets, buffer


def unpacked_bitmaps(offsets: np.ndarray, buffer: np.ndarray):
    """(row of the bitmap, place) of every document in the bitmaps."""
    size = np.diff(offsets)
    few = np.flatnonzero(size != BITMAP_BYTES)
    n = size[few] // 2
    before = np.cumsum(n) - n
    at = np.repeat(offsets[few] - 2 * before, n) + 2 * np.arange(n.sum())
    places = buffer[at].astype(np.int64) | buffer[at + 1].astype(np.int64) << 8
    out_row, out_place = [np.repeat(few, n)], [places]
    for i in np.flatnonzero(size == BITMAP_BYTES):
        found = np.flatnonzero(np.unpackbits(buffer[offsets[i] : offsets[i + 1]]))
        out_row.append(np.full(len(found), i))
        out_place.append(found)
    return np.concatenate(out_row), np.concatenate(out_place)


def or_merged(runs: list[np.ndarray]):
    """(pair, place, links) over runs of pair << BLOCK_BITS | place with repeats."""
    keys = np.concatenate(runs)
    keys.sort()
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    links = np.diff(np.append(first, len(keys)))
    keys = keys[first]
    return keys >> np.uint64(BLOCK_BITS), (keys & np.uint64(BLOCK - 1)).astype(np.int64), links


def planes(runs: list[np.ndarray]):
    """(plane, pairs, offsets, buffer) of a block.

    Plane 0 says which documents have the pair; plane k + 1 says where digit k of
    its further links is set.
    """
    pairs, places, links = or_merged(runs)
    yield 0, *packed_bitmaps(pairs, places)
    more, digit = links - 1, 0
    while (more >> digit).any():
        on = (more >> digit) & 1 == 1
        if on.any():
            yield digit + 1, *packed_bitmaps(pairs[on], places[on])
        digit += 1


_DOCUMENT = [
    ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()),
]
_INDEX = pa.schema(
    [("block", pa.int64()), ("plane", pa.int32()), ("place", pa.int32()), ("pair", pa.int64()), ("bitmap", pa.binary())]
    + _DOCUMENT
)
INDEX = (
    "block bigint, plane int, place int, pair bigint, bitmap binary, doc_id bigint, n_a bigint, n_b bigint, "
    "n_groups bigint, n_links bigint, groups_sha256 string"
)
# Rows of documents lie in the index next to the bitmaps, on a plane of their own.
DOCUMENTS = -1


def pair_index(docs: DataFrame, paths: tuple[str, str, str], text: str = "text", key: str = "doc_id") -> DataFrame:
    """The inverted index, and one row per document with its counts.

    Every task numbers its documents itself, in blocks of BLOCK. Both kinds of
    rows leave the same task in one write, so a task that runs again replaces both.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        claim("alignment", _ALIGNERS.clear)
        own = aligner(*paths)
        block, runs, n_docs, n_links = TaskContext.get().partitionId() << 32, [], 0, 0

        def flushed():
            for plane, pairs, offsets, buffer in planes(runs) if n_links else ():
                n = len(pairs)
                for at in range(0, n, 50_000):
                    to = min(n, at + 50_000)
                    cut = offsets[at : to + 1]
                    data = buffer[cut[0] : cut[-1]]
                    bitmaps = pa.Array.from_buffers(
                        pa.binary(), to - at, [None, pa.py_buffer((cut - cut[0]).astype("<i4")), pa.py_buffer(data)]
                    )
                    columns = [np.full(to - at, block), np.full(to - at, plane), np.zeros(to - at), pairs[at:to]]
                    columns = [pa.array(c.astype(np.int64)).cast(f.type) for c, f in zip(columns, _INDEX)]
                    empty = [pa.nulls(to - at, t) for _, t in _DOCUMENT]
                    yield pa.RecordBatch.from_arrays([*columns, bitmaps, *empty], schema=_INDEX)

        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for at in range(0, len(texts), 256):
                part = texts[at : at + 256]
                n = len(part)
                if n_docs and (n_docs + n > BLOCK or n_links > BLOCK_LINKS):
                    yield from flushed()
                    block, runs, n_docs, n_links = block + 1, [], 0, 0
                sums, digests, links, per_text = own.documents(part)
                places = np.repeat(np.arange(n_docs, n_docs + n, dtype=np.uint64), per_text)
                runs.append(links << np.uint64(BLOCK_BITS) | places)
                columns = [np.full(n, block), np.full(n, DOCUMENTS), np.arange(n_docs, n_docs + n)]
                columns = [pa.array(c).cast(f.type) for c, f in zip(columns, _INDEX)]
                columns += [pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), keys[at : at + n].cast(pa.int64())]
                columns += [*map(pa.array, sums), pa.array(digests, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, schema=_INDEX)
                n_docs, n_links = n_docs + n, n_links + len(links)
        yield from flushed()

    return docs.select(F.col(key).cast("bigint"), F.col(text)).mapInArrow(run, INDEX)


def shifted(number: Column) -> Column:
    """What a document on the row's plane adds, in units of ``number``."""
    return F.call_function("shiftleft", number, F.greatest(F.col("plane") - 1, F.lit(0)))


def pair_counts(index: DataFrame) -> DataFrame:
    """pair, a_id, b_id, n_docs, n_links of every pair of ids that is linked anywhere.

    Blocks share no document, so the popcounts of their bitmaps add up.
    """
    size = F.length("bitmap")
    ones = F.when(size == BITMAP_BYTES, F.bitmap_count("bitmap")).otherwise(size / 2).cast("bigint")
    worth = shifted(F.lit(1).cast("bigint"))
    counts = (
        index.filter(F.col("plane") >= 0)
        .groupBy("pair")
        .agg(F.sum(F.when(F.col("plane") == 0, ones)).alias("n_docs"), F.sum(ones * worth).alias("n_links"))
    )
    a, b = F.shiftright("pair", ID_BITS), F.col("pair").bitwiseAND((1 << ID_BITS) - 1)
    return counts.select("pair", a.alias("a_id"), b.alias("b_id"), "n_docs", "n_links")


RESULT = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
    "groups_sha256 string"
)
_RESULT = pa.schema([*_DOCUMENT[:5], ("n_best", pa.int64()), ("count_sum", pa.int64()), _DOCUMENT[5]])


def posting_scores(index: DataFrame, counts: DataFrame) -> DataFrame:
    """Every document with the links of its pairs added up from their bitmaps.

    The bitmaps of a block meet its documents in one task, which adds pair after
    pair to two numbers per document.
    """
    best = F.max("n_links").over(Window.partitionBy("b_id"))
    scored = counts.select("pair", F.col("n_links").alias("worth"), (F.col("n_links") == best).alias("best"))
    postings = index.filter(F.col("plane") >= 0).select("block", "plane", "pair", "bitmap").join(scored, "pair")
    postings = postings.select(
        "block", "plane", F.lit(0).alias("place"), "bitmap",
        shifted(F.col("worth")).alias("worth"), shifted(F.col("best").cast("bigint")).alias("best"),
    )
    columns = [name for name, _ in _DOCUMENT]
    documents = index.filter(F.col("plane") == DOCUMENTS).select("block", "plane", "place", *columns)
    both = documents.unionByName(postings, allowMissingColumns=True).repartition("block")
    both = both.sortWithinPartitions("block", "plane").select("block", "plane", "place", "bitmap", "worth", "best", *columns)

    def run(batches):
        now, held, sums, n_best = None, [], None, None

        def finished():
            if not held:
                return
            documents = pa.Table.from_batches(held).combine_chunks()
            place = documents.column("place").to_numpy()
            out = [documents.column(c).combine_chunks() for c in columns[:5]]
            out += [pa.array(n_best[place]), pa.array(sums[place]), documents.column(columns[5]).combine_chunks()]
            yield from pa.Table.from_arrays(out, schema=_RESULT).to_batches()

        for batch in batches:
            blocks = batch.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for at, to in zip(cuts, cuts[1:]):
                if at == to:
                    continue
                if blocks[at] != now:
                    yield from finished()
                    now, held = blocks[at], []
                    sums, n_best = np.zeros(BLOCK, np.int64), np.zeros(BLOCK, np.int64)
                part = batch.slice(at, to - at)
                split = int(np.searchsorted(part.column("plane").to_numpy(), 0))
                if split:
                    held.append(part.slice(0, split).select(["place", *columns]))
                part = part.slice(split)
                if not part.num_rows:
                    continue
                bitmaps = pa.concat_arrays([part.column("bitmap")])
                _, offsets, data = bitmaps.buffers()
                offsets = np.frombuffer(offsets, "<i4")[bitmaps.offset : bitmaps.offset + len(bitmaps) + 1].astype(np.int64)
                row, place = unpacked_bitmaps(offsets, np.frombuffer(data, np.uint8))
                np.add.at(sums, place, part.column("worth").to_numpy()[row])
                np.add.at(n_best, place, part.column("best").to_numpy()[row])
        yield from finished()

    return both.mapInArrow(run, RESULT)


def align_tokenizers(
    docs: DataFrame, paths: tuple[str, str, str], text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.

    ``paths`` name the byte-level vocabulary (for ``tokenizers`` and as ranks) and
    the ``sentencepiece`` model, on every executor. A space is put before the text.
    Missing and empty texts, and texts that one of the vocabularies does not give
    back byte for byte, have no tokens: zeros and no digest. Repeated rows, and
    rows without doc_id, count like any other.
    """
    index = durable(pair_index(docs, paths, text, key), "zstd")
    return posting_scores(index, pair_counts(index))


def default_vocabularies() -> tuple[str, str, str]:
    names = ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model")
    return tuple(vocabulary_path(n) for n in names)  # type: ignore[return-value]


@query("op11_token_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(read_table(spark, sf_dir, "documents"), default_vocabularies())
