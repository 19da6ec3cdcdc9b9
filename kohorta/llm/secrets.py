"""Secret scan: keyword automaton, anchored patterns near its hits, checksums."""

from __future__ import annotations

import hashlib
import re
import zlib

from pyspark.sql import DataFrame, SparkSession

from kohorta.llm.common import map_rows, query, read_table

KINDS = ("assign", "access", "hex", "checked")
# Patterns fixed by the contract.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_SAMPLE = re.compile(r"[0-9a-f](?=[0-9a-f]{2})")
HEX_STEP, HEX_LEAST = 8, 24
# Tokens that end in a base-62 CRC-32 of their random part.
CHECKED = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "checked": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"),
}
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def checksum(part: str) -> str:
    """Six base-62 digits of the CRC-32 of a token's random part."""
    value, digits = zlib.crc32(part.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits


class SecretScanner:
    """Spans of secrets in one text, as (start, end, kind) in code points."""

    def __init__(self):
        import ahocorasick

        self.keywords = ahocorasick.Automaton()
        for kind, words in KEYWORDS.items():
            for word in words:
                self.keywords.add_word(word, (kind, len(word)))
        self.keywords.make_automaton()

    def scan(self, text: str) -> tuple[list[tuple], list[tuple]]:
        """Base spans and added spans. A pattern runs only where its keyword is."""
        base, added = [], []
        lowered = text.lower()
        if len(lowered) != len(text):
            lowered = text.translate(_LOWER)
        hits = [(end - size + 1, kind) for end, (kind, size) in self.keywords.iter(lowered)]
        assigned = accessed = 0
        # The automaton reports by end; leftmost matching needs starts in order.
        for start, kind in sorted(hits):
            if kind == "assign" and start >= assigned:
                if m := ASSIGN.match(text, start):
                    assigned = m.end()
                    if m.end(2) - m.start(2) >= 6:
                        base.append((start, m.end(), kind))
            elif kind == "access" and start >= accessed:
                if m := ACCESS.match(text, start):
                    accessed = m.end()
                    if m.end() - start >= 20:
                        base.append((start, m.end(), kind))
            elif kind == "checked":
                if (m := CHECKED.match(text, start)) and checksum(m[1]) == m[2]:
                    added.append((start, m.end(), kind))
        base += [(a, b, "hex") for a, b in hex_runs(text)]
        return base, added


def hex_runs(text: str) -> list[tuple[int, int]]:
    """Runs of at least 24 hex digits.

    Such a run covers three places in a row of every eighth character, so only
    around those the text itself is looked at.
    """
    runs, done = [], 0
    for m in HEX_SAMPLE.finditer(text[::HEX_STEP]):
        start = m.start() * HEX_STEP
        if start < done:
            continue
        while start > done and text[start - 1] in "0123456789abcdef":
            start -= 1
        end = HEX.match(text, start).end()
        if end - start >= HEX_LEAST:
            runs.append((start, end))
        done = max(done, end)
    return runs


def joined_spans(spans: list[tuple], kinds=KINDS) -> str:
    """kind:start:end of the spans by start, then kind as listed, comma-joined."""
    ordered = sorted(spans, key=lambda s: (s[0], kinds.index(s[2]), s[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered)


def find_secrets(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Secrets of every document; a missing text is empty.

    n_assign, n_access, n_hex count the base spans, n_checked the tokens added
    because their embedded checksum is right. ``spans`` has both.
    """

    def rows(keys, texts):
        scanner = SecretScanner()
        for k, t in zip(keys, texts):
            base, added = scanner.scan(t or "")
            count = [sum(s[2] == kind for s in base) for kind in KINDS[:3]]
            digest = hashlib.sha256(joined_spans(base).encode()).hexdigest()
            yield k, *count, digest, joined_spans(base + added), len(added)

    return map_rows(
        docs,
        [key, text],
        rows,
        "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, "
        "base_sha256 string, spans string, n_checked bigint",
    )


@query("op3_secret_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(read_table(spark, sf_dir, "documents"))
