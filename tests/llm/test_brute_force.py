"""Operators without SQL against slow, plain versions of themselves."""

import html
import random
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from hard_cases import words
from kohorta.llm import html_text, pii, quality, token_counts, toxicity

# Personal data: any number of leading zeros.


@pytest.mark.parametrize("zeros", [0, 1, 5000, 200_000])
def test_parts_of_leading_zeros(zeros):
    text = "0" * zeros + "1.1.1.1 " + "0" * zeros + "256.1.1.1 1." + "0" * (zeros + 1) + ".1.255"
    n = zeros
    assert pii.identifiers(text) == [(0, n + 7, "ip"), (2 * n + 18, 3 * n + 27, "ip")]


def test_spelled_zeros():
    text = "zero " * 5000 + "one dot one dot one dot one"
    pii.disguised(text, pii.identifiers(text))


# Token counts: every code point as the library knows it.

VOCABULARY = token_counts.vocabulary_path("word_bpe_49k.json")
CODES = [c for plane in token_counts.PLANES for c in plane] + [0x50000, 0xF0000, 0x10FFFF]


@pytest.mark.parametrize("around", ["{}", "{}a", "a{}", "1{}!"])
def test_every_code_point(around):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    counter = token_counts.counter(VOCABULARY)
    texts = [around.format(chr(c)) for c in CODES]
    for at in range(0, len(texts), 50_000):
        part = texts[at : at + 50_000]
        want = [len(e.ids) for e in library.encode_batch(part, add_special_tokens=False)]
        assert [counter.count(t) for t in part] == want


# Quality: the verdict of hosts from the definition.


def test_host_verdicts_match_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for host in [f"h{i}" for i in range(25)] + ["big", None]:
        bad = rng.random()
        for _ in range(400 if host == "big" else rng.randrange(1, 12)):
            rows.append((len(rows), words(rng, 20 if rng.random() < bad else 80, 3000), host))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    failed = {k: len(t.split()) < 50 or 100 * quality.measures(t)[4] > 50 * len(t.split()) for k, t, _ in rows}
    hosts = defaultdict(list)
    for k, _, h in rows:
        hosts[h].append(failed[k])
    own = [v for h, v in hosts.items() if h is not None]
    n, f = np.array([len(v) for v in own], float), np.array([sum(v) for v in own], float)
    mean = f.sum() / n.sum()
    # Method of moments: between-host variance from the weighted squares about the mean.
    spread = (n * (f / n - mean) ** 2).sum() - (len(n) - 1) * mean * (1 - mean)
    between = spread / (n.sum() - (n**2).sum() / n.sum())
    weight = mean * (1 - mean) / between - 1
    out = quality.quality_verdicts(docs).collect()
    assert len(out) == len(rows) and between > 0
    for r in out:
        if r.host is None:
            assert r.kept == (not failed[r.doc_id]) and r.shrunk_rate is None
            continue
        rate = (sum(hosts[r.host]) + mean * weight) / (len(hosts[r.host]) + weight)
        assert r.shrunk_rate == pytest.approx(rate, rel=1e-9)
        assert r.kept == (not failed[r.doc_id] and rate <= quality.HOST_RATE)
    assert {r.kept for r in out if not failed[r.doc_id] and r.host} == {True, False}


# Toxicity: one text, one filter and one place at a time.


def small_model(rng):
    s = toxicity.Settings(buckets=64, width=3, filters=2, spans=(1, 2, 3), prefixes=(3, 4))
    model = toxicity.Model.start(s, np.arange(0, 64, 2))
    for p in model.parameters():
        p += rng.normal(0, 0.3, p.shape).astype(np.float32)
    model.table[0] = 0
    return model


def naive_probability(model, text):
    s = model.settings
    rows = [sum(model.table[model.row_of[f]].astype(np.float64) for f in toxicity.word_features(w, s)) for w in toxicity.words_of(text)]
    pooled = []
    for span, kernel in zip(s.spans, model.kernels):
        for f in range(s.filters):
            best = -np.inf
            # A filter may reach past the end; a text always has room for one.
            for at in range(max(1, len(rows)) if rows else 1):
                best = max(best, sum(rows[at + i] @ kernel[i][:, f] for i in range(span) if at + i < len(rows)) if rows else 0.0)
            if rows:
                best = max(best, 0.0) if places_of_padding(s) else best
            pooled.append(best)
    z = (np.array(pooled) + model.bias) @ model.out + model.out_bias[0]
    return 1 / (1 + np.exp(-(model.scale[0] * z + model.scale[1])))


def places_of_padding(s):
    """Whether a place in the padding alone counts: it does where there is more padding than the widest filter needs."""
    return max(2, max(s.spans)) - (max(s.spans) - 1) > 0


def test_scores_match_a_naive_forward_pass():
    rng = np.random.default_rng(5)
    model = small_model(rng)
    model.scale = (1.3, -0.2)
    texts = [" ".join(f"w{chr(97 + c)}{chr(97 + c // 3)}xyz" for c in rng.integers(0, 20, n)) for n in (0, 1, 2, 3, 10, 40)]
    texts += [None, "Über naïve 123 _x_"]
    got = toxicity.score_rows(model, toxicity.vocabulary_of(model), texts)
    assert got == pytest.approx([naive_probability(model, t) for t in texts], abs=1e-5)


def test_gradients_match_differences():
    rng = np.random.default_rng(6)
    model = small_model(rng)
    # In double precision, so that differences are of use.
    model.table = model.table.astype(np.float64)
    model.kernels = [k.astype(np.float64) for k in model.kernels]
    model.bias, model.out, model.out_bias = (p.astype(np.float64) for p in (model.bias, model.out, model.out_bias))
    vocabulary = toxicity.vocabulary_of(model)
    coded = [vocabulary.encode([t])[0] for t in ("wax wbx wcx wdx", "wex wax", "wfx wgx whx wbx wax")]
    features = vocabulary.take()
    features = np.concatenate([np.zeros((1, features.shape[1]), np.int32), model.row_of[features]])
    flat, starts = np.concatenate(coded), np.concatenate(([0], np.cumsum([len(c) for c in coded])))
    distinct, ids = np.unique(flat, return_inverse=True)
    y = np.array([1.0, 0.0, 1.0])

    def loss():
        embedded = model.table[features[distinct]].sum(1)
        projected = embedded @ np.concatenate([k[i] for k in model.kernels for i in range(len(k))], 1)
        pooled = model.pooled(model.responses(projected, ids), starts)
        z = (pooled + model.bias) @ model.out + model.out_bias[0]
        return float(np.mean(np.log1p(np.exp(z)) - y * z))

    # Responses are kept in single precision, which bounds what differences can show.
    gradients = toxicity._gradients(model, features, distinct, ids, starts, y)
    for p, g in zip(model.parameters(), gradients):
        spots = [np.unravel_index(i, p.shape) for i in rng.choice(p.size, min(p.size, 25), replace=False)]
        for at in spots:
            if p is model.table and at[0] == 0:
                continue
            before, step = p[at], 1e-3
            p[at] = before + step
            up = loss()
            p[at] = before - step
            down = loss()
            p[at] = before
            assert g[at] == pytest.approx((up - down) / (2 * step), abs=2e-3)


def test_long_texts_are_searched_piece_by_piece(monkeypatch):
    rng = np.random.default_rng(8)
    model = small_model(rng)
    vocabulary = toxicity.vocabulary_of(model)
    texts = [" ".join(f"w{chr(97 + c)}x" for c in rng.integers(0, 20, n)) for n in (3, 40, 0, 1, 7, 23, 2)]
    ids, starts = vocabulary.encode(texts)
    starts = np.append(starts, len(ids))
    projected = np.concatenate([np.zeros((1, 12), np.float32), model.projected(vocabulary.take())])
    want = model.pooled(model.responses(projected, ids), starts)
    for piece in (1, 5, 11, 1000):
        monkeypatch.setattr(toxicity, "PIECE", piece)
        pooled, places = toxicity._peaks(model, projected, ids, starts)
        assert (pooled == want).all()
        assert (places >= starts[:-1, None]).all() and (places < starts[1:, None] - 2).all()


# Page text: stacks walked as a whole, neighbours looked for one by one.


def naive_blocks(page):
    blocks, parts, stack, pieces = [], [], [], []
    links = anchors = mains = articles = place = 0

    def close(at):
        for *_, part in stack[at:]:
            if part:
                part.end, part.holds_main = len(blocks), mains > part.mains
        del stack[at:]

    def flush():
        nonlocal links
        text = " ".join(html.unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            inside = any(t in ("article", "main") for t, *_ in stack)
            article = -1 if not inside else 0 if any(t == "main" for t, *_ in stack) else articles
            heading = any(t in html_text.HEADINGS for t, *_ in stack)
            blocks.append(html_text.Block(text, min(links, len(text)), heading, any(a for _, a, _ in stack), inside, article))
        links = 0

    def add(raw):
        nonlocal links
        pieces.append(raw)
        if anchors:
            links += len(" ".join(html.unescape(raw).split()))

    for m in html_text.iter_tags(page):
        if m.start() > place:
            add(page[place : m.start()])
        place = m.end()
        tag = (m[2] or "").lower()
        if tag and m[1]:
            if tag == "a":
                anchors = max(0, anchors - 1)
            if tag in html_text.BLOCKS:
                flush()
                found = [k for k, (t, *_) in enumerate(stack) if t == tag]
                if found and not (tag == "p" and any(t != "p" for t, *_ in stack[found[-1] :])):
                    close(found[-1])
        elif tag:
            anchors += tag == "a"
            if tag == "br":
                pieces.append(" ")
            if tag in html_text.BLOCKS:
                flush()
                if stack and stack[-1][0] == "p":
                    close(len(stack) - 1)
                if stack and stack[-1][0] in html_text.CLOSES.get(tag, ()):
                    close(len(stack) - 1)
                if tag not in html_text.VOID and not m[3].rstrip().endswith("/"):
                    outer = any(t in ("article", "main") for t, *_ in stack)
                    articles += tag == "article" and not outer
                    inside = outer or tag in ("article", "main")
                    found = html_text.attributes(m[3]) if m[3] else {}
                    mains += tag == "main"
                    part = None
                    if said := html_text.part_of(tag, found, inside):
                        part = html_text.Part(said, len(blocks), mains)
                        parts.append(part)
                    stack.append((tag, html_text.is_around(tag, found, inside), part))
    if place < len(page):
        add(page[place:])
    flush()
    close(0)
    html_text.mark_parts(blocks, parts)
    return blocks


def naive_labels(blocks):
    """Second pass by walking from each undecided block to both sides."""
    marked, known = html_text.marks_article(blocks), html_text.known_language(blocks)
    for b in blocks:
        b.inside = b.inside and marked
    first = [html_text.classify(b, known) if b.inside or not marked else "bad" for b in blocks]
    out = list(first)
    for i, b in enumerate(blocks):
        if first[i] in ("good", "bad"):
            continue
        if not any(x in ("good", "bad") for x in first):
            out[i] = "good" if first[i] == "near-good" else "bad"
            continue
        sides = []
        for step in (-1, 1):
            j = i + step
            while 0 <= j < len(blocks) and first[j] not in ("good", "bad"):
                j += step
            there = 0 <= j < len(blocks)
            label = first[j] if there and blocks[j].inside == b.inside else "good" if b.inside else "bad"
            sides.append((label, abs(j - i) if there else len(blocks)))
        (before, left), (after, right) = sides
        if before == after:
            out[i] = before
        elif first[i] == "near-good":
            out[i] = "good"
        elif b.heading:
            out[i] = after
        else:
            out[i] = before if left < right else after if right < left else "bad"
    return out


TAGS = "div p article main nav header h1 h2 ul li td tr table a span aside section br hr script dl dt dd".split()
NAMES = "nav x comment site-footer menu related content".split()
PIECE = st.one_of(
    st.sampled_from([f"<{t}>" for t in TAGS] + [f"</{t}>" for t in TAGS]),
    st.builds("<{} class={}>".format, st.sampled_from(TAGS), st.sampled_from(NAMES)),
    st.builds(lambda n: "the word and it " * n, st.integers(1, 20)),
    st.sampled_from(["x ", "Warszawa jest miastem ", "日本語の文章です。", "&amp; "]),
)


@settings(max_examples=1500, deadline=None)
@given(st.lists(PIECE, max_size=40))
def test_pages_match_the_naive_version(parts):
    page = "".join(parts)
    want = naive_blocks(page)
    assert html_text.split_blocks(page) == want
    labels = naive_labels(naive_blocks(page))
    assert html_text.main_text(page) == "\n".join(b.text for b, x in zip(want, labels) if x == "good")


@pytest.mark.parametrize(
    "small",
    ["<div>", "<div></span></p>", "<div class=nav>x", "<p>x</div>", "<li>x", "<h1>x", "<article>x", "<div><p>", "<a href=x>y", "<!--"],
)
def test_time_follows_the_length(small):
    """Ten times the page takes about ten times as long, not a hundred times."""
    took = []
    for n in (4_000, 40_000):
        page = small * n + "</p></div>" * (n // 4)
        started = time.process_time()
        html_text.main_text(page)
        took.append(time.process_time() - started)
    assert took[1] < 40 * took[0] + 0.5


JAPANESE = "東京は日本の首都であり、人口が最も多い都市です。政治、経済、文化の中心として発展してきました。" * 3
POLISH = "Warszawa jest stolicą Polski i największym miastem kraju, położonym nad Wisłą, gdzie mieszka prawie dwa miliony ludzi. " * 3


@pytest.mark.parametrize("text", [JAPANESE, POLISH])
def test_other_languages_keep_their_text(text):
    page = f"<body><div><a href=/>x</a> <a href=/y>yy</a></div><div>{text}</div><div>{text}</div><div>© 2024</div></body>"
    one = " ".join(text.split())
    assert html_text.main_text(page) == f"{one}\n{one}"


def test_linked_words_stay_in_a_marked_article():
    long = "This is the text of the article and it has to be long enough for the rules to see that it is one of them. " * 3
    linked = "See <a href=/r>the report on the state of the rivers and of the lakes in the north</a> for more."
    page = f"<article><p>{long}</p><p>{linked}</p><ul><li><a href=/1>More</a></li></ul></article>"
    text = html_text.main_text(page).split("\n")
    assert text == [" ".join(long.split()), "See the report on the state of the rivers and of the lakes in the north for more."]


def test_every_word_counts_once():
    assert Counter(toxicity.words_of("A b A_c 1")) == {"a": 2, "b": 1, "c": 1}
