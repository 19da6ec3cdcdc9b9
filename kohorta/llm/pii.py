"""Personal data, also when disguised, with spans in the source text."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right

from pyspark.sql import DataFrame, SparkSession

from kohorta.llm.common import map_rows, query, read_table

KINDS = ("email", "ip", "card", "phone")
# Patterns fixed by the contract. An address is matched from its "@" (``emails``), and a number from its first
# digit only: starting again inside a long run of letters or digits could not succeed.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            done = m.end()
            found.append((start, done))
        at = text.find("@", at + 1)
    return found


def identifiers(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of plain identifiers, leftmost and non-overlapping per kind."""
    found = []
    found += [(start, end, "email") for start, end in emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            # Without its leading zeros a part is short, however long it was.
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in [p.lstrip("0") for p in m[0].split(".")]):
                found.append((m.start(), m.end(), "ip"))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card"))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    found.append((m.start(), m.end(), "phone"))
    return found


# Spelled digits and signs, and letters that look like Latin ones.
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4",
    "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
}
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j",
    "ԁ": "d", "ո": "n", "ν": "v", "ο": "o", "ρ": "p", "α": "a", "ι": "i", "κ": "k", "τ": "t", "υ": "u",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Χ": "X", "ı": "i", "ℓ": "l", "․": ".", "。": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-",
    " ": " ", " ": " ", " ": " ",
}
# Characters without width vanish.
HIDDEN = "​‌‍⁠﻿­"

# Letters beyond ASCII that match i and s where case does not count.
_FOLDED = str.maketrans("İıſ", "iis")
_WORD = "|".join(sorted(SPELLED, key=len, reverse=True))
_ITEM = rf"(?:(?:{_WORD})(?![a-z])|[0-9])"
# A spelled number: spelled or plain digits in a row, at least one of them spelled.
NUMBER = re.compile(
    rf"(?<![A-Za-z0-9])(?:plus[ -]?|\+)?(?:{_ITEM}[ .()-]{{0,3}}){{0,24}}(?:{_WORD})(?![a-z])(?:[ .()-]{{0,3}}{_ITEM}){{0,24}}",
    re.I,
)
NUMBER_PART = re.compile(rf"plus[ -]?|({_WORD})(?![a-z])([ -](?=(?:{_WORD})(?![a-z])))?", re.I)
# The hints are what every match with an edit has in it, so no match depends on the rest of a text.
NUMBER_HINT = re.compile(rf"(?:(?<![a-z])|(?<=plus))(?:{_WORD})(?![a-z])", re.I)
# name (at) host (dot) tld, in brackets or between spaces.
_OPEN, _CLOSE = r"(?:\s?[\[({<]\s?)", r"(?:\s?[\])}>]\s?)"
AT = re.compile(rf"{_OPEN}(?:at|@){_CLOSE}|\s(?:at|@)\s", re.I)
DOT = re.compile(rf"{_OPEN}(?:dot|punkt|punto|point|\.){_CLOSE}|\s(?:dot|\.)\s", re.I)
AT_ADDRESS = re.compile(
    rf"(?<![A-Za-z0-9_%+-])[A-Za-z0-9_%+-]+(?:(?:{DOT.pattern}|\.)[A-Za-z0-9_%+-]+){{0,8}}"
    rf"(?:{AT.pattern}|@)[A-Za-z0-9-]+(?:(?:{DOT.pattern}|\.)[A-Za-z0-9-]+){{1,8}}",
    re.I,
)
# Four or more figures with dots between them; a dot between blanks may end a sentence.
DOTTED = re.compile(rf"(?<![0-9])[0-9]++(?:(?:{DOT.pattern}|\.)[0-9]++){{3,}}", re.I)
DOTTED_HINT = re.compile(rf"[0-9](?:{DOT.pattern})[0-9]", re.I)
AT_HINT = re.compile(rf"{_OPEN}(?:at|@){_CLOSE}|\s@\s|{DOT.pattern}", re.I)


def lookalike(c: str) -> str | None:
    """The ASCII character a character passes for, "" if it has no width, None if none."""
    if c < "\x80":
        return None
    if c in HIDDEN:
        return ""
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    # Full-width forms, mathematical letters and digits of any script.
    plain = unicodedata.normalize("NFKC", c)
    if len(plain) == 1 and plain < "\x80" and plain.isprintable():
        return plain
    digit = unicodedata.digit(c, None)
    return str(digit) if digit is not None and c.isdigit() and c not in "²³¹" else None


_SUSPECT = re.compile(r"[^\x00-\x7fÀ-ſ]|ı")


class Tape:
    """A rewritten text that knows which source characters each piece came from.

    Pieces are (position in the rewritten text, source start, source end,
    changed); unchanged pieces are copied character by character.
    """

    def __init__(self):
        self.parts: list[str] = []
        self.pieces: list[tuple[int, int, int, bool]] = []
        self.keys: list[int] = []
        self.at = 0

    def put(self, out: str, start: int, end: int, changed: bool) -> None:
        if out:
            self.pieces.append((self.at, start, end, changed))
            self.keys.append(self.at)
            self.parts.append(out)
            self.at += len(out)

    @property
    def text(self) -> str:
        return "".join(self.parts)

    def source(self, start: int, end: int) -> tuple[int, int, bool]:
        """Source span of a rewritten span, and whether anything in it was changed."""
        i, j = bisect_right(self.keys, start) - 1, bisect_right(self.keys, end - 1) - 1
        first, last = self.pieces[i], self.pieces[j]
        begin = first[1] if first[3] else first[1] + (start - first[0])
        stop = last[2] if last[3] else last[1] + (end - last[0])
        changed = any(p[3] for p in self.pieces[i : j + 1]) or any(
            a[2] != b[1] for a, b in zip(self.pieces[i:j], self.pieces[i + 1 : j + 1])
        )
        return begin, stop, changed


def transduce(text: str, edits: list[tuple[int, int, str]]) -> Tape:
    """Applies edits (start, end, output), which are in order and do not overlap."""
    tape, done = Tape(), 0
    for start, end, out in edits:
        tape.put(text[done:start], done, start, False)
        tape.put(out, start, end, True)
        done = end
    tape.put(text[done:], done, len(text), False)
    return tape


def glyph_edits(text: str) -> list[tuple[int, int, str]]:
    return [
        (m.start(), m.end(), out)
        for m in _SUSPECT.finditer(text)
        if (out := lookalike(m[0])) is not None
    ] + [(i, i + 1, "") for i, c in enumerate(text) if c == "­"] if not text.isascii() else []


def number_edits(text: str) -> list[tuple[int, int, str]]:
    edits = []
    if NUMBER_HINT.search(text):
        for m in NUMBER.finditer(text):
            for p in NUMBER_PART.finditer(text, m.start(), m.end()):
                out = SPELLED[p[1].translate(_FOLDED).lower()] if p[1] else "+"
                edits.append((p.start(), p.end(), out))
    return edits


def dot_edits(text: str) -> list[tuple[int, int, str]]:
    """Disguised dots of addresses made of figures, where no at sign is near."""
    edits = []
    if DOTTED_HINT.search(text):
        for m in DOTTED.finditer(text):
            dots = [(p.start(), p.end(), ".") for p in DOT.finditer(text, m.start(), m.end())]
            if len(re.findall("[0-9]+", m[0])) > 4:
                dots = [(a, b, out) for a, b, out in dots if text[a:b].strip() != "."]
            edits += dots
    return edits


def address_edits(text: str) -> list[tuple[int, int, str]]:
    edits = []
    if AT_HINT.search(text):
        for m in AT_ADDRESS.finditer(text):
            inside = [(p.start(), p.end(), "@") for p in AT.finditer(text, m.start(), m.end())]
            dots = [(p.start(), p.end(), ".") for p in DOT.finditer(text, m.start(), m.end())]
            # A bare " at " counts only with a disguised dot beside it.
            if dots or any(text[a:b].strip().lower() != "at" for a, b, _ in inside):
                edits += inside + dots
    return edits


def disguised(text: str, base: list[tuple]) -> list[tuple[int, int, str]]:
    """Identifiers that appear only once the disguises are undone.

    The transducers run one after the other (glyphs, spelled digits, at/dot
    signs: dots between figures, then addresses); each passes its spans back
    through the one before.
    """
    tapes, current = [], text
    for edits_of in (glyph_edits, number_edits, dot_edits, address_edits):
        edits = sorted(edits_of(current))
        if edits:
            tapes.append(transduce(current, edits))
            current = tapes[-1].text
    if not tapes:
        return []
    plain, out = set(base), []
    for start, end, kind in identifiers(current):
        changed = False
        for tape in reversed(tapes):
            start, end, here = tape.source(start, end)
            changed |= here
        if changed and (start, end, kind) not in plain:
            out.append((start, end, kind))
    return out


def joined_spans(spans: list[tuple]) -> str:
    """kind:start:end by start, then kind as listed, comma-joined."""
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered)


def find_personal_data(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Personal data of every document; a missing text is empty.

    n_email .. n_phone count the plain identifiers, n_disguised the added ones;
    ``spans`` has both, in code points of the source text.
    """

    def rows(keys, texts):
        for k, t in zip(keys, texts):
            t = t or ""
            base = identifiers(t)
            added = disguised(t, base)
            count = [sum(s[2] == kind for s in base) for kind in KINDS]
            digest = hashlib.sha256(joined_spans(base).encode()).hexdigest()
            yield k, *count, digest, joined_spans(base + added), len(added)

    return map_rows(
        docs,
        [key, text],
        rows,
        "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
        "base_sha256 string, spans string, n_disguised bigint",
    )


@query("op1_pii")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(read_table(spark, sf_dir, "documents"))
