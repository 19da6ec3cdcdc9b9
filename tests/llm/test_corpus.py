"""Operators and stages that look at all documents."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from hard_cases import words
from kohorta.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from kohorta.llm.components import components
from kohorta.llm.token_counts import vocabulary_path
from hard_cases import words

IDS = vocabulary_path("byte_bpe_50k.json")
RANKS = vocabulary_path("byte_bpe_50k.tiktoken")


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


# Exact duplicates


def test_exact_rows(spark, hard_docs, no_docs):
    out = exact_dedup.decide(exact_dedup.digests(hard_docs), exact_dedup.new_index(spark)).collect()
    assert len(out) == 16
    by = defaultdict(list)
    for r in out:
        by[r.doc_id].append(r)
    assert by[1][0].keep_id == 2 and not by[1][0].kept and by[2][0].kept and by[1][0].group_size == 2
    assert by[4][0].keep_id == by[5][0].keep_id == 6 and by[6][0].group_size == 4
    assert sorted(r.kept for r in by[8]) == [False, True] and by[7][0].group_size == 3
    assert sum(r.kept for r in by[None]) == 2
    assert exact_dedup.decide(exact_dedup.digests(no_docs), exact_dedup.new_index(spark)).count() == 0
    kept = exact_dedup.keep_one(hard_docs, exact_dedup.new_index(spark))
    assert kept.columns == hard_docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([2, 3, 6, 8, 9, None, None, 10, 11, 12])
    assert exact_dedup.keep_one(no_docs, exact_dedup.new_index(spark)).count() == 0


def test_index_grows_by_what_is_new(spark):
    index = exact_dedup.new_index(spark)
    first = exact_dedup.decide(exact_dedup.digests(docs_of(spark, [(1, "a"), (2, "b"), (3, "A")])), index)
    assert {(r.doc_id, r.kept) for r in first.collect()} == {(1, False), (2, True), (3, True)}
    again = exact_dedup.decide(exact_dedup.digests(docs_of(spark, [(4, "b"), (5, "c"), (6, "c")])), index)
    assert {(r.doc_id, r.keep_id, r.kept, r.seen_before) for r in again.collect()} == {
        (4, 2, False, True), (5, 6, False, False), (6, 6, True, False)
    }
    assert {r.keep_id for r in index.read().collect()} == {2, 3, 6}
    plan = index.new(index.read().select("digest", "keep_id"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan


def test_ranges_go_through_the_index(spark, monkeypatch):
    """Every range but the first finds texts that a larger doc_id has put there."""
    rng = random.Random(6)
    rows = [(rng.randrange(-50, 200), rng.choice("abcdefgABCDEFG") * rng.randrange(4)) for _ in range(600)]
    rows += [(None, "only"), (None, "Only"), (None, "a"), (5, None)]
    held, plans = [], []
    append = exact_dedup.DigestIndex.append

    def spied(self, groups, load):
        plans.append(self.new(groups)._jdf.queryExecution().executedPlan().toString())
        before, asked = self.read().count(), groups.count()
        append(self, groups, load)
        held.append((asked, self.read().count() - before))

    monkeypatch.setattr(exact_dedup.DigestIndex, "append", spied)
    index = exact_dedup.new_index(spark)
    out = exact_dedup.decide(exact_dedup.digests(docs_of(spark, rows).repartition(4)), index).collect()
    assert len(held) == exact_dedup.RANGES + 1 and sum(n for _, n in held) == index.read().count()
    assert all(added < asked for asked, added in held[1:])
    assert all("SortMergeJoin" in p and "LeftAnti" in p and "Bucketed: true" in p for p in plans)
    small = lambda t: (t or "").translate(str.maketrans(exact_dedup.CAPITALS, exact_dedup.SMALL))
    groups = defaultdict(list)
    for k, t in rows:
        groups[small(t)].append(k)
    want = Counter()
    for t, keys in groups.items():
        top = max((k for k in keys if k is not None), default=None)
        for place, k in enumerate(sorted(keys, key=lambda k: (k is None, k or 0))):
            want[(k, top, len(keys), hashlib.sha256(t.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out) == want
    assert sum(r.kept for r in out) == len(groups) and all(r.doc_id == r.keep_id for r in out if r.kept)


def test_buckets_follow_the_first_load(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "DIGESTS_PER_BUCKET", 10)
    index = exact_dedup.new_index(spark)
    exact_dedup.decide(exact_dedup.digests(docs_of(spark, [(i, f"t{i}") for i in range(150)])), index)
    assert index.buckets() == 16
    exact_dedup.decide(exact_dedup.digests(docs_of(spark, [(i, f"t{i}") for i in range(400)])), index)
    assert index.buckets() == 16 and index.read().count() == 400


def test_digest_is_that_of_the_lowered_text(spark):
    texts = ["", None, "AbC", "ÀÉ Kelvin K İ ß Σς", "x" * 10_000 + "É"]
    got = exact_dedup.digests(docs_of(spark, list(enumerate(texts)))).collect()
    small = str.maketrans(exact_dedup.CAPITALS, exact_dedup.SMALL)
    for r in got:
        assert bytes(r.digest) == hashlib.sha256((texts[r.doc_id] or "").translate(small).encode()).digest()


# Near duplicates


def brute_classes(rows):
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links, root = [0] * len(rows), list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = root[i], root[j]
                root = [a if r == b else r for r in root]
    top = defaultdict(list)
    for r, (k, _) in zip(root, rows):
        top[r].append(k)
    return {k: (max(top[r]), n, len(top[r])) for (k, _), r, n in zip(rows, root, links)}


def near_rows():
    rng = random.Random(3)
    rows, key = [], 0
    for group in (1, 1, 1, 2, 5, 40):
        base = words(rng, 200, 3000).split()
        for _ in range(group):
            text = list(base)
            for _ in range(rng.randrange(6)):
                text[rng.randrange(len(text))] = "x%d" % rng.randrange(99)
            rows.append((key, " ".join(text)))
            key += 1
    shared = words(rng, 60, 3000)
    rows += [(key + i, shared + " " + words(rng, 150, 3000)) for i in range(20)]
    rows += [(900, rows[4][1]), (901, rows[4][1]), (902, "a b c"), (903, "a b c"), (904, ""), (905, None)]
    return rows


def test_near_duplicates_match_brute_force(spark, monkeypatch):
    rows = near_rows()
    want = brute_classes(rows)
    for block in (1024, 7):  # the second cuts the larger groups into blocks
        monkeypatch.setattr(near_dedup, "BLOCK_TEXTS", block)
        got = near_dedup.near_duplicates(docs_of(spark, rows).repartition(5)).collect()
        assert {r.doc_id: (r.class_id, r.n_links, r.class_size) for r in got} == want


def test_near_rows(hard_docs, no_docs):
    out = near_dedup.near_duplicates(hard_docs).collect()
    assert len(out) == 16 and {r.class_id for r in out if r.doc_id in (1, 2, 3)} == {3}
    kept = near_dedup.keep_representatives(hard_docs)
    assert kept.columns == hard_docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([3, 4, 5, 6, 8, 9, None, None, None, 10, 11, 12])
    assert near_dedup.near_duplicates(no_docs).count() == 0
    assert near_dedup.keep_representatives(no_docs).count() == 0


def test_pruning_keeps_pairs_above_the_threshold():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 2**63, 800, dtype=np.uint64))
    sets = [base, np.unique(np.concatenate([base[60:], rng.integers(0, 2**63, 60, dtype=np.uint64)])), rng.integers(0, 2**63, 800, dtype=np.uint64)]
    sig = near_dedup.signatures(sets)
    least = [near_dedup.least_matches(n) for n in range(16, 97, 16)]
    a, b = near_dedup.surviving_pairs(sig, np.array([0, 0, 1]), np.array([1, 2, 2]), least)
    assert list(zip(a, b)) == [(0, 1)]
    assert least == sorted(least) and least[0] < 8 and least[-1] > 45


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 40)]
    edges += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    root = {r.node: r.root for r in components(frame).collect()}
    parent = {n: n for e in edges for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    got, want = defaultdict(set), defaultdict(set)
    for n in parent:
        want[find(n)].add(n)
    for n, r in root.items():
        got[r].add(n)
    single = {frozenset(v) for v in want.values() if len(v) > 1}
    assert {frozenset(v) for v in got.values()} == single


# Toxicity


def toxic_rows(n):
    rng = random.Random(9)
    out = []
    for i in range(n):
        text = words(rng, 40).split()
        if i % 4 == 0:
            text[rng.randrange(40)] = rng.choice(["idiot", "moron", "scumbag", "scumface"])
        out.append((i, " ".join(text), "en", int(i % 4 == 0)))
    return out


@pytest.fixture(scope="module")
def toxic(spark):
    rows = toxic_rows(900)
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows] + [(None, 1), (5, None)], "doc_id bigint, toxic int")
    return docs, labels, toxicity.train(docs, labels, toxicity.Settings(steps=400))


def test_held_out_accuracy(toxic):
    docs, _, model = toxic
    out = toxicity.score(docs, model).collect()
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)


def test_toxicity_rows(spark, toxic, hard_docs, no_docs):
    _, labels, model = toxic
    out = toxicity.score(hard_docs, model).collect()
    assert len(out) == 16 and len({r.score for r in out if r.doc_id in (4, 5, 6, 10)}) == 1
    kept = toxicity.keep_clean(hard_docs, model)
    assert kept.columns == hard_docs.columns and kept.count() == 16 - sum(r.flagged for r in out)
    assert toxicity.score(no_docs, model).count() == 0 and toxicity.keep_clean(no_docs, model).count() == 0
    untaught = toxicity.train(no_docs, labels)
    assert all(r.predicted == 0 for r in toxicity.score(hard_docs, untaught).collect())


def test_toxicity_learns_from_long_texts(spark):
    rng = random.Random(4)
    rows = [(i, words(rng, 12_000) + (" scumbag" if i % 2 else ""), "en", i % 2) for i in range(60)]
    assert all(len(r[1]) > 30_000 for r in rows)
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id bigint, toxic int")
    out = toxicity.score(docs, toxicity.train(docs, labels, toxicity.Settings(steps=60))).collect()
    assert sum(r.predicted == r.doc_id % 2 for r in out) >= 54


def test_toxicity_takes_all_labelled_rows_in_shards(spark, toxic):
    docs, labels, _ = toxic
    settings = toxicity.Settings(rows=48, rounds=3, steps=400, width=4)
    rows = toxicity._labelled(docs.union(docs), labels, settings)
    assert sorted(r.doc_id for r in rows.select("doc_id").collect()) == [i for i in range(900) if zlib.crc32(str(i).encode()) % 3 != 1]
    model = toxicity.train(docs, labels, settings)
    held = toxicity.score(docs, model).filter("held_out").collect()
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.95 * len(held)
    again = toxicity.train(docs.repartition(7), labels.repartition(3), settings)
    assert all((a == b).all() for a, b in zip(model.parameters(), again.parameters()))
    assert (model.scale, model.thresholds) == (again.scale, again.thresholds)


# Mixing


def test_water_level(spark):
    rows = [("a", 10, 1.0), ("b", 100, 1.0), ("c", 1000, 2.0)]
    frame = spark.createDataFrame(rows, "name string, capacity bigint, weight double")
    for asked, want in ((400.0, (10, 100, 290)), (40.0, (10, 10, 20)), (30.0, (7.5, 7.5, 15)), (5000.0, (10, 100, 1000))):
        from pyspark.sql import functions as F

        out = mixing.share_out(frame.withColumn("asked", F.lit(asked)), [], "name", "asked", "got")
        assert tuple(r.got for r in out.orderBy("name").collect()) == pytest.approx(want)


def test_mixing_rows(hard_docs, no_docs):
    out = mixing.mix_sources(hard_docs, mixing.Mix(budget=2.0, epochs=2)).collect()
    # All is asked for: every document with tokens is taken in both epochs.
    assert {r.epoch for r in out} == {0, 1} and all(r.take_tokens == r.n_tokens for r in out)
    assert sum(r.doc_id == 8 for r in out) == 4
    half = mixing.mix_sources(hard_docs, mixing.Mix(budget=0.5, epochs=1)).collect()
    total = sum(r.n_tokens for r in out) // 2
    assert total // 2 - 16 <= sum(r.take_tokens for r in half) <= total // 2
    kept = mixing.keep_mixed(hard_docs, mixing.Mix(budget=1.0, epochs=1))
    assert kept.columns == hard_docs.columns
    assert Counter(r.doc_id for r in kept.collect()) >= Counter([1, 2, 3, 7, 8, 8, 9, None, None, 11, 12])
    assert mixing.mix_sources(no_docs).count() == 0 and mixing.keep_mixed(no_docs, mixing.Mix()).count() == 0


def test_mixing_stays_in_the_jvm(spark):
    plan = mixing.mix_sources(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


# Packing


def test_hilbert_steps_are_neighbours():
    points = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    keys = packing.hilbert_keys(points, 3)
    assert sorted(keys) == list(range(512))
    assert np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(1).max() == 1


def test_ids_match_library():
    own = packing.Encoder(IDS, RANKS)
    rng = random.Random(3)
    parts = ["a", "b", " ", " ", "  ", "\n", "\t", "é", "1", "'s", "\xa0", "　", "\x1c", "\x85", "日", "🙂", "<|endoftext|>", "The", "́", "$$$", "\r"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert own.ids(text) == np.array(own.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()


def check_packing(rows, docs, length):
    tokenizer = packing.Encoder(IDS, RANKS).tokenizer
    whole = Counter()
    for r in docs.collect():
        whole[(r["doc_id"], len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1)] += 1
    assert Counter((r.doc_id, r.doc_tokens) for r in rows if r.start == 0) == whole
    assert sum(r.length for r in rows) == sum(n * k for (_, n), k in whole.items())
    filled = defaultdict(list)
    for r in rows:
        filled[r.sequence_id].append((r.offset, r.length))
    for pieces in filled.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= length
    return filled


def test_packing(spark, hard_docs, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = packing.pack_with_default_vocabulary(docs).collect()
    filled = check_packing(rows, docs, 1024)
    assert len(filled) * 1024 - sum(r.length for r in rows) <= 1024 * 4  # one sequence per task
    tokenizer = packing.Encoder(IDS, RANKS).tokenizer
    ids = {r.doc_id: np.array(tokenizer.encode(r.text, add_special_tokens=False).ids + [0], "<u4") for r in docs.collect()}
    assert all(zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in rows)
    check_packing(packing.pack_with_default_vocabulary(hard_docs).collect(), hard_docs, 1024)
    assert packing.pack_with_default_vocabulary(no_docs).count() == 0


# Pipeline


def test_pipeline_against_its_parts(spark):
    """The stages in plain Python over what the classifier keeps."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    clean = corpus_pipeline.drop_toxic(spark, docs, folder)
    clean_rows = [(r.doc_id, r.text) for r in clean.collect()]
    by = {}
    for k, t in clean_rows:
        key = "".join(c.lower() if c.isascii() else c for c in t)
        by[key] = max(by.get(key, (k, t)), (k, t))
    unique = sorted(by.values())
    single = [k for k, (top, _, _) in brute_classes(unique).items() if k == top]
    frame = spark.createDataFrame(unique, "doc_id bigint, text string").filter("false")
    assert frame.count() == 0
    mixed = corpus_pipeline.mix(spark, docs.filter(docs.doc_id.isin(single)), folder)
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in got} == {r.doc_id for r in mixed.collect()}
    check_packing(got, mixed, 1024)


def test_stages_keep_columns_and_take_nothing(spark, hard_docs, no_docs):
    for docs in (hard_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs_out = stage(spark, docs, "/root/testdata/sf0.001")
            assert docs_out.columns == docs.columns
