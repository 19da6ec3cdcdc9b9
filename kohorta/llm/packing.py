"""Packs documents into token sequences in the order of a space-filling curve."""

from __future__ import annotations

import base64
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from kohorta.llm.common import WordCache, claim, durable, map_rows, query, read_table, small_batches
from kohorta.llm.token_counts import vocabulary_path

LENGTH = 1024
END_ID = 0
# Token counts are hashed to this many buckets, then projected to DIMS numbers of BITS bits.
BUCKETS, DIMS, BITS = 256, 3, 16
_PROJECTION = np.random.default_rng(7).normal(size=(BUCKETS, DIMS))
# A space between two other characters: no token goes across it.
_GAP = re.compile(r"(?<=\S) (?=\S)")
# Words for which both libraries' patterns cannot differ.
_PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ0-9.,;:!?|#$%&*\n-]*")


def evenly_spaced(text: str) -> bool:
    """True when all white space is single spaces and line feeds between words."""
    words = text.split()
    blanks = len(text) - sum(map(len, words))
    return blanks == text.count(" ") + text.count("\n") and len(words) == blanks + 1


class Encoder:
    """Token ids of a text as little-endian 16-bit numbers.

    Ids are those of the ``tokenizers`` file at ``path``. Its words are cut at
    single spaces, so a text is the chain of its words' ids, and the ids of a
    word are kept. New plain words are encoded by ``tiktoken`` from the same
    vocabulary given as ranks, all others, and texts that name a special token,
    by ``tokenizers``.
    """

    def __init__(self, path: str, ranks_path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.ranks = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("the vocabulary does not fit 16-bit ids")
        self.words = WordCache(lambda w: self.encode(" " + w))
        self.first = WordCache(self.encode, 100_000)

    def encode(self, text: str) -> bytes:
        if _PLAIN.fullmatch(text, 1 if text[:1] == " " else 0):
            ids = self.ranks.encode_ordinary(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u2").tobytes()

    def ids(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()
        words = text.split(" ") if evenly_spaced(text) else _GAP.split(text)
        head = self.first[words[0]]
        return head + b"".join(map(self.words.__getitem__, words[1:]))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, ranks_path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, ranks_path)
    return _ENCODERS[path]


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of whole numbers below 2^bits.

    Gray-code construction: from the highest bit down, each axis with a set bit
    flips the lower bits of the first axis, or else swaps them with its own.
    """
    axes = [points[:, d].astype(np.int64) for d in range(points.shape[1])]
    n = len(axes)
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for d in range(n):
            is_set = (axes[d] & bit) != 0
            swap = np.where(is_set, 0, (axes[0] ^ axes[d]) & low)
            axes[0] = np.where(is_set, axes[0] ^ low, axes[0] ^ swap)
            axes[d] = axes[d] ^ swap if d else axes[0]
        bit >>= 1
    for d in range(1, n):
        axes[d] = axes[d] ^ axes[d - 1]
    flip, bit = np.zeros_like(axes[0]), 1 << (bits - 1)
    while bit > 1:
        flip = np.where((axes[n - 1] & bit) != 0, flip ^ (bit - 1), flip)
        bit >>= 1
    key = np.zeros_like(axes[0])
    for b in range(bits - 1, -1, -1):
        for d in range(n):
            key = (key << 1) | (((axes[d] ^ flip) >> b) & 1)
    return key


def curve_points(encoded: list[bytes]) -> np.ndarray:
    """Few whole numbers per document: its hashed token counts, projected."""
    counts = np.zeros((len(encoded), BUCKETS))
    for row, data in enumerate(encoded):
        ids = np.frombuffer(data, "<u2")
        counts[row] = np.bincount((ids.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(24), minlength=BUCKETS)
    counts /= np.maximum(np.sqrt((counts**2).sum(1, keepdims=True)), 1e-12)
    spread = 0.5 + 0.5 * np.tanh(0.8 * (counts @ _PROJECTION))
    return np.minimum((spread * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def encoded_documents(
    docs: DataFrame, path: str, ranks_path: str, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """doc_id, ids (16-bit, with the end id) and place on the curve."""

    def rows(keys, texts):
        claim("packing", _ENCODERS.clear)
        ids = encoder(path, ranks_path).ids
        end = np.array([END_ID], "<u2").tobytes()
        encoded = [ids(t or "") + end for t in texts]
        yield from zip(keys, hilbert_keys(curve_points(encoded)).tolist(), encoded)

    return map_rows(docs, [key, text], rows, "doc_id bigint, place bigint, ids binary")


PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)
_NAMES = [c.split()[0] for c in PIECES.split(", ")]


def pack(encoded: DataFrame, length: int = LENGTH) -> DataFrame:
    """Fills sequences of ``length`` tokens along the curve.

    A range sort puts neighbours on the curve into one task; ties are broken by
    doc_id, so many copies of a text do not end in one task. Each task fills its
    sequences to the brim and cuts the document at the end, so only the last
    sequence of a task is padded. ``sequence_id`` has the task in its upper bits.
    """
    small_batches(encoded.sparkSession)

    def run(batches):
        sequence, used = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            out = []
            for doc, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(data, "<u2").astype("<u4")
                start, total = 0, len(ids)
                while start < total:
                    take = min(total - start, length - used)
                    crc = zlib.crc32(ids[start : start + take].tobytes())
                    out.append((doc, start, take, crc, total, sequence, used))
                    start, used = start + take, used + take
                    if used == length:
                        sequence, used = sequence + 1, 0
            cells = list(zip(*out)) if out else [[] for _ in _NAMES]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cells], names=_NAMES)

    ordered = encoded.repartitionByRange("place", "doc_id").sortWithinPartitions("place", "doc_id")
    return ordered.select("doc_id", "ids").mapInArrow(run, PIECES)


def pack_documents(
    docs: DataFrame, path: str, ranks_path: str, length: int = LENGTH, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """One row per piece of a document in a sequence.

    A missing or empty text is the end id alone. Repeated rows, and rows without
    doc_id, are packed like any other. ``path`` and ``ranks_path`` are the same
    vocabulary for the two libraries, on every executor.
    """
    return pack(durable(encoded_documents(docs, path, ranks_path, text, key), "zstd"), length)


def pack_with_default_vocabulary(docs: DataFrame) -> DataFrame:
    return pack_documents(docs, vocabulary_path("byte_bpe_50k.json"), vocabulary_path("byte_bpe_50k.tiktoken"))


@query("op7_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_with_default_vocabulary(read_table(spark, sf_dir, "documents"))
