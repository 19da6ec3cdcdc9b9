"""License scan against every block of every text, and against its SQL."""

import math
import random
import re

import pytest

from kohorta.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, templates=licenses.TEMPLATES, share=licenses.CONTAINMENT):
    out = []
    for key, text in rows:
        w = words_of(text)
        spots, base = [], set()
        for label, phrase in licenses.PHRASES:
            p = phrase.split(" ")
            own = [i for i in range(len(w)) if w[i : i + len(p)] == p]
            spots += own
            base |= {label} if own else set()
        best, labels, n_blocks = 0.0, set(base), 0
        for label, template in templates:
            own = licenses.template_tokens(template)
            span = licenses.span_of(template)
            for b in range(0, len(w), span):
                common = len(set(own) & set(w[b : b + 2 * span]))
                if own and common >= math.ceil(share * len(own) - 1e-9):
                    best, n_blocks = max(best, common / len(own)), n_blocks + 1
                    labels.add(label)
        out.append((
            key, len(w), len(spots), min(spots, default=None), max(spots, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if base else best, n_blocks,
        ))
    return sorted(out, key=str)


def result(docs, **more):
    return sorted((tuple(r) for r in licenses.scan_licenses(docs, **more).collect()), key=str)


@pytest.fixture(scope="module")
def texts():
    """Whole, cut, shuffled and torn notices in texts of common words."""
    rng = random.Random(8)
    common = "the of license under and version free work 2 0 4 is to in software general public".split()
    out = ["CC BY cc-by Cc.By ccby", "all rights\nreserved, All Rights reserved all all rights reserved", "général public license",
           "Kelvin worK is licensed", "İ all rights reserved", "reserved rights all", "x" * 5000]
    for _, notice in licenses.TEMPLATES:
        w = notice.split(" ")
        for _ in range(6):
            part = list(w)
            if rng.random() < 0.5:
                part = part[: len(part) - rng.randrange(3)]
            if rng.random() < 0.3:
                rng.shuffle(part)
            part = [x for p in part for x in [p, *rng.choices(common, k=rng.randrange(2))]]
            before, after = rng.choices(common, k=rng.randrange(70)), rng.choices(common, k=rng.randrange(40))
            out.append(rng.choice([" ", "\n", " - "]).join(before + part + after))
    out.append(" ".join(rng.choices(common, k=5000)) + " " + licenses.TEMPLATES[2][1])
    return out


@pytest.mark.parametrize("share", [0.5, 0.8, 0.9, 1.0])
def test_every_block_is_found(spark, texts, share):
    rows = list(enumerate(texts)) + [(None, texts[0]), (1, None), (1, texts[3]), (1, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert result(docs, containment=share) == brute(rows, share=share)


def test_hard_rows(spark, hard_docs):
    rows = [(r["doc_id"], r["text"]) for r in hard_docs.select("doc_id", "text").collect()]
    assert result(hard_docs) == brute(rows)
    odd = [("short", "one two"), ("empty", " . "), ("long", " ".join(f"w{i}" for i in range(60))), ("short", "two one three")]
    assert result(hard_docs, templates=odd, containment=0.3) == brute(rows, odd, 0.3)


def test_no_templates_and_no_documents(spark, no_docs, hard_docs):
    assert result(no_docs) == []
    rows = [(r["doc_id"], r["text"]) for r in hard_docs.select("doc_id", "text").collect()]
    assert result(hard_docs, templates=[]) == brute(rows, [])


def test_rarest_tokens_are_asked_first(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    tokens = licenses.template_tokens(licenses.TEMPLATES[0][1])
    order = licenses.token_order(docs, tokens, "text")
    seen = {t: sum(t in words_of(x) for x in texts) for t in tokens}
    assert [seen[t] for t in order] == sorted(seen.values())
    index = licenses.Index(licenses.TEMPLATES[:1], order, 0.9)
    (own,) = index.classes.values()
    assert own["prefix"] == order[: len(order) - own["need"] + 1]


def test_no_python_in_the_plan(spark, hard_docs):
    found = licenses.scan_licenses(hard_docs.limit(3))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
