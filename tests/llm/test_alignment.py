"""Alignment of two tokenizers against the libraries on whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from kohorta.llm import alignment

PATHS = alignment.default_vocabularies()
ODD = [
    "", " ", "  two  blanks ", "a\n\nb \n c", "tab\tand   no-break", "<s> </s> <|endoftext|> <0x41>", "▁x ▁ y",
    "naïve café 你好 世界 🙂🙂", "é ́x", "x" * 3000, "it's we'll 'tis 3.14 1,000", " em space", "a\x00b c\x1fd",
    "end. \nNext\r\nline", "ﬁ ① Ａ", "trailing blank ", "a  b   c    d",
]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[2])
    own = alignment.Aligner(*PATHS)
    return a, b, own


def whole(text, a, b, own):
    """(groups, links) of the whole text by the libraries; None without tokens."""
    if not text:
        return None
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a, bytes_b = [own.a_bytes[i] for i in ids_a], [own.b_bytes[i] for i in ids_b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return None
    ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
    starts_a, starts_b = np.append(0, ends_a[:-1]), np.append(0, ends_b[:-1])
    links = []
    for i in range(len(ids_a)):
        first = np.searchsorted(ends_b, starts_a[i], "right")
        last = np.searchsorted(starts_b, ends_a[i], "left")
        links += [(ids_a[i], ids_b[j]) for j in range(first, last)]
    groups, i, j = [], 0, 0
    for end in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
        to_i, to_j = int(np.searchsorted(ends_a, end)) + 1, int(np.searchsorted(ends_b, end)) + 1
        groups.append((ids_a[i:to_i], ids_b[j:to_j]))
        i, j = to_i, to_j
    return groups, links


def brute(rows, libraries):
    """The contract's columns for (doc_id, text) rows."""
    found = [(k, whole(t, *libraries)) for k, t in rows]
    count = Counter(link for _, f in found if f for link in f[1])
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    out = []
    for k, f in found:
        if f is None:
            out.append((k, 0, 0, 0, 0, 0, 0, ""))
            continue
        groups, links = f
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((
            k, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
            sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links), hashlib.sha256(text.encode()).hexdigest(),
        ))
    return out


def in_order(rows):
    return sorted(rows, key=str)


def results(docs):
    return in_order(tuple(r) for r in alignment.align_tokenizers(docs, PATHS).collect())


def check_text(text, libraries):
    own = libraries[2]
    sums, digests, links, per_text = own.documents([text])
    want = brute([(0, text)], libraries)[0]
    assert (sums[0][0], sums[1][0], sums[2][0], sums[3][0], digests[0]) == (*want[1:5], want[7])
    found = whole(text, *libraries)
    pairs = Counter((x >> alignment.ID_BITS, x & ((1 << alignment.ID_BITS) - 1)) for x in links.tolist())
    assert pairs == Counter(found[1] if found else [])


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text, libraries):
    check_text(text, libraries)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab e's.1 \n\t▁<>|é"), st.characters(codec="utf-8")), max_size=60))
def test_parts_of_a_text_are_the_text(libraries, text):
    check_text(text, libraries)


def test_long_text_without_blanks(libraries):
    rng = random.Random(2)
    check_text("".join(rng.choice("abcdeéß🙂") for _ in range(20_000)), libraries)


def test_kept_segments_are_renewed(libraries, monkeypatch):
    monkeypatch.setattr(alignment, "SEGMENTS", 5)
    for text in ["one two three four five six seven", "one two", "three four zwei"]:
        check_text(text, libraries)


def test_blanks_at_the_ends_of_texts_stay_with_their_text(libraries):
    own = libraries[2]
    texts = ["abc ", "  def", "ghi\n", "\njkl", " ", "mno  ", "pqr", "   ", "\tstu\u3000", " é ", " ü", "x"]
    for order in texts, texts[::-1]:
        own.forget()
        sums, digests, links, per_text = own.documents(order)
        ends = np.cumsum(per_text)
        for i, text in enumerate(order):
            want = brute([(0, text)], libraries)[0]
            assert (*[int(s[i]) for s in sums], digests[i]) == (*want[1:5], want[7])
            pairs = Counter((x >> alignment.ID_BITS, x & ((1 << alignment.ID_BITS) - 1)) for x in links[ends[i] - per_text[i] : ends[i]].tolist())
            assert pairs == Counter(whole(text, *libraries)[1])


def test_bitmaps_round_trip():
    rng = np.random.default_rng(1)
    keys = np.concatenate([(i << np.uint64(alignment.BLOCK_BITS)) | rng.integers(0, alignment.BLOCK, n, dtype=np.uint64)
                           for i, n in ((np.uint64(3), 1), (np.uint64(5), 40), (np.uint64(9), 9000), (np.uint64(1 << 40), 700))])
    want = Counter(keys.tolist())
    got = Counter()
    for plane, pairs, offsets, buffer in alignment.planes(np.array_split(keys, 4)):
        row, place = alignment.unpacked_bitmaps(offsets, buffer)
        for r, p in zip(row.tolist(), place.tolist()):
            got[(int(pairs[r]) << alignment.BLOCK_BITS) | p] += 1 << max(0, plane - 1)
    assert got == want


def test_against_the_libraries(spark, hard_docs, libraries):
    rows = [(r["doc_id"], r["text"]) for r in hard_docs.select("doc_id", "text").collect()]
    assert results(hard_docs) == in_order(brute(rows, libraries))


def test_counts_over_many_blocks(spark, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_LINKS", 50)
    rng = random.Random(3)
    words = ["alpha", "beta", "gammas", "naïve", "x1", "can't", "größe"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(40)))) for i in range(700)]
    rows += [(1000 + i, "one group of copies") for i in range(400)] + [(2000, None), (None, "alpha beta"), (5, "beta " * 300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert results(docs) == in_order(brute(rows, libraries))


def test_pair_counts(spark, libraries):
    rows = [(1, "a b a b"), (2, "a"), (3, "b a")]
    index = alignment.pair_index(spark.createDataFrame(rows, "doc_id bigint, text string"), PATHS)
    got = {(r.a_id, r.b_id): (r.n_docs, r.n_links) for r in alignment.pair_counts(index.cache()).collect()}
    found = [whole(t, *libraries)[1] for _, t in rows]
    want = Counter(x for f in found for x in f)
    docs = Counter(x for f in found for x in set(f))
    assert got == {x: (docs[x], n) for x, n in want.items()}


def test_no_documents(no_docs):
    assert results(no_docs) == []
