"""Finds licences by an exact set-similarity join of text blocks with templates.

Everything is DataFrame and SQL functions. Tokens are put in one order, from the
rarest in the corpus to the most frequent; a block meets a template only through
one of the template's rarest tokens, and only if lengths and places leave room for
the overlap that the threshold asks for.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kohorta.llm.common import durable, query, read_table

CONTAINMENT = 0.9

# The phrases of the contract and their labels.
PHRASES = [
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
]

# Notices of public licences.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the Software), to deal in the Software without restriction",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
    ),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation",
    ),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def small(text: Column) -> Column:
    """A text in which A-Z are lower-cased, for comparison with ASCII words.

    ``lower`` is much faster than ``translate``. Beyond ASCII it may change letters
    too, but only the Kelvin sign becomes an ASCII letter, and it is replaced first.
    """
    return F.lower(F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("\u212a"), F.lit("\u0138")))


def words_of(text: Column) -> Column:
    """ASCII words as they are after lower-casing A-Z, others up to their case; a missing text has none."""
    return F.array_remove(F.split(small(text), BETWEEN), "")


def template_tokens(text: str) -> list[str]:
    """Distinct words of a template, in its order; the words are those of ``words_of``."""
    return list(dict.fromkeys(template_words(text)))


def template_words(text: str) -> list[str]:
    """Words of a template, which is to be in ASCII."""
    if not text.isascii():
        raise ValueError(f"a template is in ASCII: {text}")
    return re.findall("[0-9a-z]+", text.lower())


def span_of(text: str) -> int:
    """Words from one block's start to the next: a power of two that holds the template."""
    return 1 << max(2, (len(template_words(text)) - 1).bit_length())


def literals(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def no_blocks() -> Column:
    return F.array().cast("array<struct<span:int,start:bigint,tokens:array<string>>>")


def token_order(docs: DataFrame, tokens: Sequence[str], text: str) -> list[str]:
    """``tokens`` from the one in fewest documents to the one in most; ties by name.

    One count per token comes back, so its size is that of the templates.
    """
    own = docs.select(F.explode(F.array_intersect(literals(tokens), words_of(F.col(text)))).alias("token"))
    seen = {r["token"]: r["count"] for r in own.groupBy("token").count().collect()}
    return sorted(tokens, key=lambda t: (seen.get(t, 0), t))


class Index:
    """Templates as ordered token sets, and their rarest tokens as an inverted index.

    Templates whose blocks are of one size form a class. A template of n tokens
    asks for ``need`` common ones, so one of its first n - need + 1 is common.
    """

    def __init__(self, templates: Sequence[tuple[str, str]], order: Sequence[str], containment: float):
        rank = {t: i for i, t in enumerate(order)}
        self.postings: list[tuple] = []
        self.classes: dict[int, dict] = {}
        for number, (label, text) in enumerate(templates):
            tokens = sorted(template_tokens(text), key=rank.__getitem__)
            if not tokens:
                continue
            # 1e-9: a product such as 0.9 * 10 is not to be rounded up.
            need = max(1, math.ceil(containment * len(tokens) - 1e-9))
            span = span_of(text)
            own = self.classes.setdefault(span, {"tokens": set(), "prefix": set(), "need": need})
            own["tokens"].update(tokens)
            own["need"] = min(own["need"], need)
            for place, token in enumerate(tokens[: len(tokens) - need + 1]):
                own["prefix"].add(token)
                self.postings.append((span, token, number, label, place, len(tokens), need, tokens))
        for own in self.classes.values():
            own["tokens"] = sorted(own["tokens"], key=rank.__getitem__)
            own["prefix"] = sorted(own["prefix"], key=rank.__getitem__)

    def frame(self, spark: SparkSession) -> DataFrame:
        schema = "of_span int, of_token string, template int, label string, at int, size int, need int, all array<string>"
        return spark.createDataFrame(self.postings, schema)

    def blocks(self, words: Column, n: Column) -> Column:
        """Blocks of a text that can match: their start, span and tokens in the order.

        Blocks are 2 * span words long and start every span words, so any passage
        of span words lies whole in one. Tokens of no template are left out, which
        changes no overlap.
        """
        prefix = literals(sorted({t for own in self.classes.values() for t in own["prefix"]}))
        found = F.concat(*[self.class_blocks(span, own, words, n) for span, own in self.classes.items()])
        return F.when((n > 0) & F.arrays_overlap(words, prefix), found).otherwise(no_blocks())

    @staticmethod
    def class_blocks(span: int, own: dict, words: Column, n: Column) -> Column:
        tokens, prefix = literals(own["tokens"]), literals(own["prefix"])

        def block(b):
            part = F.slice(words, b * span + 1, F.lit(2 * span))
            return F.struct(
                F.lit(span).alias("span"), (b * span).cast("long").alias("start"),
                F.array_intersect(tokens, part).alias("tokens"),
            )

        def can_match(x):
            return (F.size(x["tokens"]) >= own["need"]) & F.arrays_overlap(x["tokens"], prefix)

        starts = F.sequence(F.lit(0), ((n - 1) / span).cast("int"))
        return F.filter(F.transform(starts, block), can_match)


def places(words: Column, n: Column, text: Column, phrase: str) -> Column:
    """Where the words of a phrase stand consecutively, by the number of the first one."""
    parts = phrase.split(" ")
    starts = F.sequence(F.lit(0), F.greatest(n - len(parts), F.lit(0)))

    def stands(i):
        found = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            found = found & (F.get(words, i + k) == part)
        return found

    # The text says cheaply where there is nothing to look for.
    possible = F.lit(True)
    for part in parts:
        possible = possible & F.contains(text, F.lit(part))
    return F.when(possible, F.filter(starts, stands)).otherwise(F.array().cast("array<int>"))


def matches(rows: DataFrame, index: Index) -> DataFrame:
    """row, template, label, start, containment of every block that holds a template.

    Prefix filter: block and template share a token that is among the first of
    both. Position filter: what is left of both behind it can still give the
    overlap. A pair is verified at its first common token, once.
    """
    spark = rows.sparkSession
    blocks = rows.select("row", F.explode("blocks").alias("b")).select("row", "b.span", "b.start", "b.tokens")
    n = F.size("tokens")
    least = F.lit(0)
    for span, own in index.classes.items():
        least = F.when(F.col("span") == span, F.lit(own["need"])).otherwise(least)
    probes = blocks.withColumn("n", n).select(
        "row", "span", "start", "tokens", "n", F.posexplode(F.slice("tokens", F.lit(1), n - least + 1)).alias("place", "token")
    )
    # The index is as small as the templates, which are a parameter.
    met = probes.join(
        F.broadcast(index.frame(spark)),
        (F.col("span") == F.col("of_span"))
        & (F.col("token") == F.col("of_token"))
        & (F.col("n") >= F.col("need"))
        & (F.col("place") <= F.col("n") - F.col("need"))
        & (F.least(F.col("size") - F.col("at"), F.col("n") - F.col("place")) >= F.col("need")),
    )
    common = met.withColumn("common", F.array_intersect("tokens", "all"))
    common = common.filter((F.get("common", F.lit(0)) == F.col("token")) & (F.size("common") >= F.col("need")))
    return common.select("row", "template", "label", "start", (F.size("common") / F.col("size")).alias("containment"))


def scan_licenses(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    containment: float = CONTAINMENT,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_blocks.

    ``labels`` adds those of the templates of which a block holds at least the
    share ``containment`` of the distinct words; a text has the labels of all
    templates that it contains. ``score`` is 1 with a phrase, else the largest
    containment found, else 0; ``n_blocks`` counts (block, template) matches.
    A missing or empty text has no words and no labels. Repeated rows, and rows
    without doc_id, are scanned like any other.
    """
    vocabulary = sorted({t for _, x in templates for t in template_tokens(x)})
    index = Index(templates, token_order(docs, vocabulary, text) if vocabulary else [], containment)
    texts = docs.select(F.col(key).cast("bigint").alias("doc_id"), small(F.col(text)).alias("text"))
    texts = texts.select("doc_id", "text", F.array_remove(F.split("text", BETWEEN), "").alias("words"))
    words, n = F.col("words"), F.size("words")
    found = [places(words, n, F.col("text"), p).alias(f"p{i}") for i, (_, p) in enumerate(PHRASES)]
    texts = texts.select(
        "doc_id", n.cast("long").alias("n_words"), *found, (index.blocks(words, n) if index.classes else no_blocks()).alias("blocks")
    )
    spots = F.concat(*[F.col(f"p{i}") for i in range(len(PHRASES))])
    labels = F.array_compact(
        F.array(*[F.when(F.size(f"p{i}") > 0, F.lit(label)) for i, (label, _) in enumerate(PHRASES)])
    )
    rows = texts.select(
        "doc_id", "n_words", F.size(spots).cast("long").alias("n_base"),
        F.array_min(spots).cast("long").alias("first_word"), F.array_max(spots).cast("long").alias("last_word"),
        F.array_sort(labels).alias("base"), "blocks",
    )
    # Written once: the row numbers stay, and the texts are not read again.
    rows = durable(rows.withColumn("row", F.monotonically_increasing_id()))
    found = matches(rows.filter(F.size("blocks") > 0), index)
    found = found.groupBy("row").agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("best"), F.count(F.lit(1)).alias("n_blocks")
    )
    out = rows.drop("blocks").join(found, "row", "left")
    every = F.array_union("base", F.coalesce("more", F.array().cast("array<string>")))
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        F.coalesce("n_blocks", F.lit(0)).cast("long").alias("n_blocks"),
    )


def oracle(templates: Sequence[tuple[str, str]] = TEMPLATES, containment: float = CONTAINMENT) -> str:
    """The same by comparing every block of every text with every template."""

    def quoted(values):
        return "[" + ", ".join(f"'{v}'" for v in values) + "]"

    spots = []
    for _, phrase in PHRASES:
        parts = phrase.split(" ")
        stands = " AND ".join(f"w[i + {k + 1}] = '{p}'" for k, p in enumerate(parts))
        spots.append(f"list_filter(range(0, greatest(len(w) - {len(parts) - 1}, 0)), lambda i: {stands})")
    scores, labels = [], []
    for label, text in templates:
        tokens, span = template_tokens(text), span_of(text)
        need = max(1, math.ceil(containment * len(tokens) - 1e-9))
        overlap = f"len(list_intersect({quoted(tokens)}, w[b * {span} + 1 : b * {span} + {2 * span}]))"
        scores.append(
            f"list_filter(list_transform(range(0, (len(w) + {span} - 1) // {span}), lambda b: {overlap} / {len(tokens)}), "
            f"lambda x: x >= {need} / {len(tokens)})"
        )
        labels.append(label)
    m = ", ".join(f"{s} AS m{i}" for i, s in enumerate(scores))
    p = ", ".join(f"{s} AS p{i}" for i, s in enumerate(spots))
    base = ", ".join(f"CASE WHEN len(p{i}) > 0 THEN '{label}' END" for i, (label, _) in enumerate(PHRASES))
    more = ", ".join(f"CASE WHEN len(m{i}) > 0 THEN '{label}' END" for i, label in enumerate(labels))
    best = ", ".join(f"list_max(m{i})" for i in range(len(labels)))
    n_base = " + ".join(f"len(p{i})" for i in range(len(PHRASES)))
    n_blocks = " + ".join(f"len(m{i})" for i in range(len(labels)))

    def joined(values):
        return f"coalesce(array_to_string(list_sort(list_distinct(list_filter([{values}], lambda x: x IS NOT NULL))), ','), '')"

    return f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}'), '{_WORD}') AS w FROM documents
), f AS (SELECT doc_id, len(w) AS n_words, {p}, {m} FROM d)
SELECT doc_id, n_words, CAST({n_base} AS BIGINT) AS n_base,
       least({", ".join(f"p{i}[1]" for i in range(len(PHRASES)))}) AS first_word,
       greatest({", ".join(f"p{i}[-1]" for i in range(len(PHRASES)))}) AS last_word,
       {joined(base)} AS base_labels, {joined(base + ", " + more)} AS labels,
       CASE WHEN {n_base} > 0 THEN 1.0::DOUBLE ELSE coalesce(greatest({best}), 0.0)::DOUBLE END AS score,
       CAST({n_blocks} AS BIGINT) AS n_blocks
FROM f
"""


@query("op13_license_scan", oracle())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))
