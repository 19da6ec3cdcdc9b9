"""Ranked search against plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from kohorta.llm import lexical_search as search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id bigint, text string, rank int, doc_id bigint, score bigint, item int"


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=10):
    """The contract, one document and item after the other."""
    found = [(k, Counter(terms(t)), len(terms(t))) for k, t in docs]
    found = [x for x in found if x[2]]
    big_n, big_l = len(found), sum(x[2] for x in found)
    df = Counter(t for _, c, _ in found for t in c)
    weight = {t: math.floor(1000 * math.log((2 * big_n + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item, text in sorted(set(items), key=str):
        asked = Counter(terms(text))
        scores = []
        for key, tf, n in found:
            m = 100 - 75 + 75 * n * big_n // big_l
            score = sum(
                times * weight[t] * (10**9 * tf[t] // (1000 * tf[t] + 8 * m)) for t, times in asked.items() if tf[t]
            )
            if score > 0:
                scores.append((-score, key is None, key or 0))
        for rank, (score, missing, key) in enumerate(sorted(scores)[:top], 1):
            out.append((item, rank, None if missing else key, -score))
    return sorted(out, key=str)


def result(docs, items, **more):
    return sorted((tuple(r) for r in search.rank_documents(docs, items, **more).collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    """Skewed word counts, copies, near copies, a very long text, missing and empty texts."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    text = lambda n: " ".join(rng.choices(words, weights, k=n))
    rows = [(i, text(rng.randrange(1, 60))) for i in range(900)]
    copy = text(50)
    rows += [(2000 + i, copy) for i in range(450)]
    rows += [(3000 + i, copy.replace("w1", "v1") + f" w{i}") for i in range(60)]
    rows += [(4000, text(20_000)), (4001, None), (4002, ""), (4003, " .,- "), (None, copy), (None, None), (7, rows[7][1]), (7, rows[7][1])]
    rows += [(4004, "Été W1 w1 x-y_z 3.14"), (4005, "ÉTÉ été")]
    return rows, [rng.choice(rows[:900])[1] for _ in range(12)] + [copy, "w1", "w399 w399 w399 w2", "Été W1", "nowhere at all", "", None]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus[0], "doc_id bigint, text string").repartition(4)


def items_of(spark, texts):
    rows = [(i, t, 1, 2, 3, 4) for i, t in enumerate(texts)]
    rows += [rows[0], (0, "w3 w4", 1, 2, 3, 4), (None, "w5 w6", 1, 2, 3, 4)]
    return spark.createDataFrame(rows, ITEMS), [r[:2] for r in rows]


@pytest.mark.parametrize("leaf, entries", [(128, 2_000_000), (2, 2_000_000), (8, 3_000)])
def test_against_plain_scoring(spark, docs, corpus, monkeypatch, leaf, entries):
    monkeypatch.setattr(search, "LEAF", leaf)
    monkeypatch.setattr(search, "TREE_ENTRIES", entries)
    monkeypatch.setattr(search, "TASK_ENTRIES", 20_000)
    items, rows = items_of(spark, corpus[1])
    assert result(docs, items) == brute(corpus[0], rows)


def test_blocks_of_items(spark, docs, corpus, monkeypatch):
    monkeypatch.setattr(search, "ITEM_CHARS", 1500)
    items, rows = items_of(spark, corpus[1])
    assert result(docs, items, top=3) == brute(corpus[0], rows, 3)


def test_hard_rows(spark, hard_docs):
    rows = [(r["doc_id"], r["text"]) for r in hard_docs.select("doc_id", "text").collect()]
    items, asked = items_of(spark, ["w1 W2 w3", "one two", "é ü", "w1 w1 w4999"])
    assert result(hard_docs, items) == brute(rows, asked)


def test_nothing_to_search(spark, no_docs, docs):
    items, _ = items_of(spark, ["w1"])
    assert result(no_docs, items) == []
    assert result(docs, items.limit(0)) == []
    assert result(docs, items.filter("item_id IS NULL").withColumn("text", items.text.substr(0, 0))) == []


def test_bounds_hold_and_branches_are_left_out(monkeypatch):
    """No document scores above the bound of any branch it is in, and pruning leaves some out."""
    monkeypatch.setattr(search, "LEAF", 4)
    rng = np.random.default_rng(3)
    vectors = []
    for _ in range(600):
        ranks = np.sort(rng.choice(40, rng.integers(1, 12), replace=False, p=np.arange(40, 0, -1) / 820))
        vectors.append((ranks.astype(">u4").tobytes(), rng.integers(1, 5, len(ranks)).astype("<u4").tobytes()))
    vectors.sort()
    m = rng.integers(25, 400, len(vectors))
    trie = search.Trie(np.arange(len(vectors)), m, [v[0] for v in vectors], [v[1] for v in vectors])
    gain = np.zeros(40, np.int64)
    gain[[0, 3, 17, 30]] = [5, 700, 900, 2000]
    scores = np.add.reduceat(gain[trie.ranks] * trie.values, trie.starts[:-1])
    for node in range(len(trie.low)):
        assert trie.bounds(node, node + 1, gain)[0] >= scores[trie.low[node] : trie.high[node]].max()
    seen = []
    bounds = trie.bounds
    monkeypatch.setattr(trie, "bounds", lambda a, b, g: seen.append(b - a) or bounds(a, b, g))
    best = trie.search(gain, [], 10)
    want = sorted((-s, i) for i, s in enumerate(scores.tolist()) if s > 0)[:10]
    assert [x[:2] for x in best] == want
    assert sum(seen) < len(trie.low)
