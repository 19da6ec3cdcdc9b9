"""Token counts by byte-pair merging over a heap and a linked list."""

from __future__ import annotations

import heapq
import json
import os
import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from kohorta.llm.common import WordCache, claim, map_rows, query, read_table

LIMIT = 2048
# Pieces of the vocabulary's tokenizer (fixed by the file's format); L, N and S stand for letters, numbers, white space.
PIECES = "'s|'t|'re|'ve|'m|'ll|'d|[L]+|[N]|[^SLN]+"
WORD_END = "</w>"


def byte_symbols() -> list[str]:
    """The printable symbol that a byte-level vocabulary uses for each byte."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


# Planes with assigned characters; all others are neither letters nor numbers nor white space.
PLANES = (range(0xD800), range(0xE000, 0x40000), range(0xE0000, 0xE1000))


def character_classes(tokenizer) -> dict[str, str]:
    """Letters, numbers and white space as the library's own pattern knows them.

    Libraries follow different versions of Unicode, so the library is asked: with
    a letter behind it a letter stays in one piece, white space is no piece, and
    with a sign behind it any other sign stays in one piece.
    """
    codes = [c for plane in PLANES for c in plane]

    def pieces(after: str) -> dict[int, int]:
        text = "".join(chr(c) + after + "\n" for c in codes)
        return dict(span for _, span in tokenizer.pre_tokenizer.pre_tokenize_str(text))

    by_letter, by_sign = pieces("a"), pieces("!")
    found: dict[str, list[int]] = {"L": [], "N": [], "S": []}
    for i, c in enumerate(codes):
        at = 3 * i
        if at not in by_letter:
            found["S"].append(c)
        elif by_letter[at] == at + 2:
            found["L"].append(c)
        elif by_sign.get(at) != at + 2:
            found["N"].append(c)
    return {name: ranges(members) for name, members in found.items()}


@lru_cache(4)
def piece_pattern(path: str) -> str:
    """The pattern of the pieces with the classes written out."""
    from tokenizers import Tokenizer

    pattern = PIECES
    for name, members in character_classes(Tokenizer.from_file(path)).items():
        pattern = pattern.replace(name, members)
    return pattern


def ranges(codes: list[int]) -> str:
    """Rising code points as the inside of a character class."""
    out, start = [], 0
    for i, c in enumerate(codes):
        if i + 1 == len(codes) or codes[i + 1] != c + 1:
            out.append(f"\\U{codes[start]:08x}-\\U{c:08x}")
            start = i + 1
    return "".join(out)


class MergeCounter:
    """Counts the tokens of a text; no token identifier is ever looked up.

    A piece starts as one symbol per byte, the last one marked as word end.
    Adjacent pairs wait in a heap by merge rank, then place; the lowest is merged
    in a linked list until none is left. Tokens = symbols - merges.
    """

    def __init__(self, path: str, pattern: str | None = None, cache: int = 500_000):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        symbols = byte_symbols()
        numbers: dict[str, int] = {}
        number = lambda s: numbers.setdefault(s, len(numbers))
        self.inner = [number(s) for s in symbols]
        self.last = [number(s + WORD_END) for s in symbols]
        # A pair of symbols is one integer key; its rank leads to the merged symbol.
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(data["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[number(left) << 32 | number(right)] = rank
            self.merged.append(number(left + right))
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        # Its normalizer and its pattern are used, never its merges or ids.
        self.normalize = Tokenizer.from_file(path).normalizer.normalize_str
        self.piece_pattern = re.compile(pattern or piece_pattern(path))
        special = [t["content"] for t in data["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.marks = tuple({t[:2] for t in special})
        self.pieces = WordCache(self.count_piece, cache)
        self.words = WordCache(self.count_word, cache)

    def count_piece(self, piece: str) -> int:
        data = piece.encode("utf-8")
        symbols = [self.inner[b] for b in data]
        symbols[-1] = self.last[data[-1]]
        n = len(symbols)
        rank_of, merged_of, bits = self.ranks.get, self.merged, n.bit_length()
        # A heap entry is rank and place in one integer.
        heap = [
            rank << bits | i
            for i, rank in enumerate([rank_of(a << 32 | b) for a, b in zip(symbols, symbols[1:])])
            if rank is not None
        ]
        if not heap:
            return n
        heapq.heapify(heap)
        push, pop, mask = heapq.heappush, heapq.heappop, (1 << bits) - 1
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        merges = 0
        while heap:
            entry = pop(heap)
            i, rank = entry & mask, entry >> bits
            j, left = after[i], symbols[i]
            # An entry is stale once either side has become part of another symbol.
            if left < 0 or j >= n or rank_of(left << 32 | symbols[j]) != rank:
                continue
            merges += 1
            symbols[i] = new = merged_of[rank]
            symbols[j] = -1
            after[i] = right = after[j]
            if right < n:
                before[right] = i
                found = rank_of(new << 32 | symbols[right])
                if found is not None:
                    push(heap, found << bits | i)
            left = before[i]
            if left >= 0:
                found = rank_of(symbols[left] << 32 | new)
                if found is not None:
                    push(heap, found << bits | left)
        return n - merges

    def count_word(self, word: str) -> int:
        """Tokens of the text between two spaces."""
        word = word.lower() if word.isascii() else self.normalize(word)
        return sum(self.pieces[p] for p in self.piece_pattern.findall(word))

    def count(self, text: str) -> int:
        if self.special is None or not any(m in text for m in self.marks):
            return sum(map(self.words.__getitem__, text.split(" ")))
        parts = self.special.split(text)
        return len(parts) - 1 + sum(sum(map(self.words.__getitem__, p.split(" "))) for p in parts)


_COUNTERS: dict[str, MergeCounter] = {}


def counter(path: str, pattern: str | None = None) -> MergeCounter:
    """One counter per worker and vocabulary; its caches outlive a task."""
    if path not in _COUNTERS:
        _COUNTERS[path] = MergeCounter(path, pattern)
    return _COUNTERS[path]


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_counts(
    docs: DataFrame, path: str, limit: int = LIMIT, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row; a missing text is empty.

    ``path`` is a vocabulary file that every executor has. An empty text has no
    token; repeated rows and missing ids are counted like any other.
    """

    pattern = piece_pattern(path)  # asked of the library once, not by every worker

    def rows(keys, texts):
        claim("token_counts", _COUNTERS.clear)
        count = counter(path, pattern).count
        for k, t in zip(keys, texts):
            t = t or ""
            n = count(t)
            yield k, len(t.encode("utf-8")), n, n > limit

    return map_rows(
        docs, [key, text], rows, f"{key} bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )


@query("op6_token_counts")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"))
