"""Operators that look at one text at a time."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings, strategies as st

from kohorta.llm import html_text, pii, quality, secrets, token_counts

VOCABULARY = token_counts.vocabulary_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY)


def collected(df):
    return {r[0]: r for r in df.collect()}


# Personal data


def brute_identifiers(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        total = sum(sum(divmod(2 * x, 10)) if i % 2 else x for i, x in enumerate(d[::-1]))
        if 14 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sorted(out)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a1234567890 .-+()@_é", max_size=60))
def test_identifiers_match_brute_force(text):
    assert sorted(pii.identifiers(text)) == brute_identifiers(text)


@pytest.mark.parametrize(
    "text, hidden, kind",
    [
        ("write joe dot smith at example dot com now", "joe dot smith at example dot com", "email"),
        ("x joe [at] example [dot] org y", "joe [at] example [dot] org", "email"),
        ("x ｊｏｅ＠example.com y", "ｊｏｅ＠example.com", "email"),
        ("x j​oe@ex​ample.com y", "j​oe@ex​ample.com", "email"),
        ("call plus one four one five five five five one two three four", "plus one four one five five five five one two three four", "phone"),
        ("ip １２.34.56.７８ end", "１２.34.56.７８", "ip"),
    ],
)
def test_disguised(text, hidden, kind):
    found = pii.disguised(text, pii.identifiers(text))
    assert (text.index(hidden), text.index(hidden) + len(hidden), kind) in found


@pytest.mark.parametrize(
    "hidden",
    [
        "192[.]168[.]0[.]1", "192 dot 168 dot 0 dot 1", "192.168[.]0.1", "10 (dot) 0 (dot) 0 (dot) 7", "10 . 0 . 0 . 7",
        "one nine two dot one six eight dot zero dot one", "１０[.]0[.]0[.]７",
    ],
)
@pytest.mark.parametrize("around", ["{}", "x {} y", "see {}, or mail joe@example.com"])
def test_disguised_ip(hidden, around):
    text = around.format(hidden)
    found = pii.disguised(text, pii.identifiers(text))
    assert found == [(text.index(hidden), text.index(hidden) + len(hidden), "ip")]


@pytest.mark.parametrize("text", ["300[.]1[.]1[.]1", "1[.]2[.]3", "at 5 . 10.0.0.1 is up", "10.0.0.1 . 10.0.0.2", "we met at noon and sat at the dot", "one two", "plain", "É at ü . com", "a\xadb"])
def test_nothing_disguised(text):
    assert pii.disguised(text, pii.identifiers(text)) == []


@pytest.mark.parametrize(
    "hidden, kind",
    [
        ("plus four.one.five.five.five.five.one.two.three.four", "phone"),
        ("plus four  one  five  five  five  five  one  two  three  four", "phone"),
        ("plusfour-(one)-five-(five)-five-(five)-one-(two)-three-(four)", "phone"),
        ("1.2.3.four", "ip"),
        ("jane at example . com", "email"),
        ("jane@example . com", "email"),
    ],
)
@pytest.mark.parametrize("around", ["{}", "x {} y", "{} and one two, joe [at] home"])
def test_disguised_wherever_it_stands(hidden, kind, around):
    text = around.format(hidden)
    where = text.index(hidden)
    found = pii.disguised(text, pii.identifiers(text))
    assert any(start == where and end in (where + len(hidden), where + len(hidden) - 1) and k == kind for start, end, k in found)


PIECES = ["plus", "+", "one", "Two", "oh", "7", "12", " ", "  ", ".", "-", "(", ")", "[", "]", "at", "@", "dot", "punto", "jane", "com", "x", "ſ", "ſix", "fıve", "SİX", "É", "\n"]


@settings(max_examples=1000, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14))
def test_hints_lose_no_edit(parts):
    class Always:
        def search(self, text):
            return True

    text = "".join(parts)
    edits = pii.number_edits(text), pii.dot_edits(text), pii.address_edits(text)
    with pytest.MonkeyPatch.context() as patch:
        for hint in ("NUMBER_HINT", "DOTTED_HINT", "AT_HINT"):
            patch.setattr(pii, hint, Always())
        assert edits == (pii.number_edits(text), pii.dot_edits(text), pii.address_edits(text))


def test_every_lookalike_is_looked_at():
    assert [c for c in pii.LOOKALIKES if c > "\x7f" and not pii._SUSPECT.search(c)] == []
    assert pii.disguised("x jım@example.com", pii.identifiers("x jım@example.com")) == [(2, 17, "email")]


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000 + " @ . (at) one two", "1" * 300_000 + ".1", "+1" * 100_000, "x@" * 100_000, "a.b@c" * 50_000):
        pii.disguised(text, pii.identifiers(text))
    secrets.SecretScanner().scan("token " * 50_000 + "ab" * 100_000 + "AKIA" * 50_000)
    html_text.main_text("<option>" * 20_000 + "<" * 20_000 + "<!-" * 20_000)


def test_tape_maps_back():
    tape = pii.transduce("ab four five cd", [(3, 8, "4"), (8, 12, "5")])
    assert tape.text == "ab 45 cd" and tape.source(3, 5) == (3, 12, True) and tape.source(6, 8) == (13, 15, False)


def test_personal_data_rows(hard_docs, no_docs):
    rows = pii.find_personal_data(hard_docs).collect()
    assert len(rows) == 16 and all(r.spans == "" for r in rows)
    assert rows[0].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.find_personal_data(no_docs).count() == 0


# Secrets


def test_checksum_tokens():
    part = "aB3dE6gH9jK2mN5pQ8sT1vW4xY7zA0"
    good = f"ghp_{part}{secrets.checksum(part)}"
    scanner = secrets.SecretScanner()
    assert scanner.scan(f"x {good} y")[1] == [(2, 2 + len(good), "checked")]
    assert scanner.scan(f"x ghp_{part}AAAAAA y")[1] == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["password", "Token", "api_key", "APIKEY", "secret", "=", ":", '"', " ", "abcdef", "0123456789", "AKIA", "ABCDEFGHIJKLMNOPQ", "-", "İ", "Key"]), max_size=14))
def test_secrets_match_brute_force(parts):
    text = "".join(parts)
    want = [(m.start(), m.end(), "assign") for m in secrets.ASSIGN.finditer(text) if len(m[2]) >= 6]
    want += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    want += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    assert sorted(secrets.SecretScanner().scan(text)[0]) == sorted(want)


def test_hex_runs_match_brute_force():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice("0123456789abcdefg" if rng.random() < 0.97 else "xyz") for _ in range(rng.randrange(160)))
        want = [m.span() for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        assert secrets.hex_runs(text) == want


def test_secret_rows(hard_docs, no_docs):
    assert secrets.find_secrets(hard_docs).count() == 16
    assert secrets.find_secrets(no_docs).count() == 0


# Quality


def brute_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "é", " ", "\n", "\t", "\xa0", "\x1c", "#"]), max_size=40))
def test_measures_match_brute_force(parts):
    text = " ".join(parts)
    assert quality.measures(text) == brute_measures(text)
    assert quality.measures("".join(parts)) == brute_measures("".join(parts))


def test_host_verdicts(spark):
    good, bad = " ".join(f"w{i}" for i in range(60)), "short"
    rows = [(i, good, "clean") for i in range(200)] + [(1000 + i, bad, "spam") for i in range(200)]
    rows += [(2000, good, "spam"), (3000, bad, "tiny"), (3001, good, "tiny"), (4000, good, None)]
    out = collected(quality.quality_verdicts(spark.createDataFrame(rows, "doc_id bigint, text string, source string")))
    assert out[5].kept and not out[1005].kept
    assert not out[2000].kept and not out[2000].base_failed  # a good document of a bad host
    assert not out[3000].kept and out[4000].kept and out[4000].host is None
    assert 1.0 > out[1005].shrunk_rate > 0.9 > out[3001].shrunk_rate > 0.4


def test_beta_prior_edges():
    assert quality.beta_prior(0, None, None, None, None) == (0.0, 1.0)
    assert quality.beta_prior(1, 10, 5, 2.5, 100) == (0.5, 1.0)
    assert quality.beta_prior(2, 20, 0, 0.0, 200)[0] == 0.0
    # 100 hosts of 100 documents, half at 0.7 and half at 0.3.
    mean, weight = quality.beta_prior(100, 10_000, 5000, 5000 * 0.7**2 + 5000 * 0.3**2, 1_000_000)
    assert mean == 0.5 and 5 < weight < 6.5


def test_quality_rows(hard_docs, no_docs):
    rows = quality.quality_verdicts(hard_docs).collect()
    assert len(rows) == 16
    assert {r.doc_id for r in rows if r.doc_id in (4, 5, 6, 10) and r.kept} == set()
    assert quality.quality_verdicts(no_docs).count() == 0


# Token counts


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["The", "ing", "É", "x́", "Σ", "日本", "🙂", " ", "  ", "\n", "\x1c", "\xa0", "'ll", "12", "½", "<|endoftext|>", "<|", "$$", "İ"]), max_size=15))
def test_counts_match_library(library, parts):
    text = "".join(parts)
    assert token_counts.counter(VOCABULARY).count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_counts_of_documents(spark, library, hard_docs, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = collected(token_counts.token_counts(docs, VOCABULARY))
    for r in docs.collect():
        n = len(library.encode(r.text, add_special_tokens=False).ids)
        assert out[r.doc_id][1:] == (len(r.text.encode()), n, n > 2048)
    rows = token_counts.token_counts(hard_docs, VOCABULARY).collect()
    assert len(rows) == 16 and {r.n_tokens for r in rows if r.doc_id in (4, 5, 6, 10)} == {0}
    assert token_counts.token_counts(no_docs, VOCABULARY).count() == 0


def test_one_long_word_without_spaces(library):
    text = "abcde" * 4000
    assert token_counts.counter(VOCABULARY).count(text) == len(library.encode(text, add_special_tokens=False).ids)


# Pages

BODY = "This is the text of the page that we want to have, and it is long enough for the rules. " * 4


def test_page_parts():
    page = f"""<html><head><title>T</title><style>p</style><script>var a="</p>";</script></head><body>
    <header><a href="/">Site</a></header><nav><ul><li><a href="/a">All</a></ul></nav><div class="ad">Buy this now</div>
    <article><header><h1>Name&nbsp;of &amp; page</h1></header><p>{BODY}<p>Short<br>one.</p>
    <ul><li>first<li>second</ul><div class="comments"><p>{BODY}</p></div><form><p>Enter it</p></form></article>
    <aside><p>{BODY}</p></aside><footer>&copy; all</footer></body></html>"""
    assert html_text.main_text(page).split("\n") == ["Name of & page", BODY.strip(), "Short one.", "first", "second"]


def test_page_without_article():
    page = f'<div><a href="x">Home</a></div><h2>Title</h2><p>{BODY}</p><p>Short.</p><p>{BODY}</p><p>Login</p><div><a href="y">More</a></div>'
    assert html_text.main_text(page).split("\n") == ["Title", BODY.strip(), "Short.", BODY.strip()]


@pytest.mark.parametrize("wrapper", ['class="no-sidebar"', 'class="page-with-sidebar"', 'class="sidebar"', 'id="content-sidebar"', 'role="form"'])
@pytest.mark.parametrize("inner", ["article", "div", "main"])
def test_names_of_wrappers(wrapper, inner):
    page = f'<div {wrapper}><{inner}><p>{BODY}</p></{inner}><div class="sidebar"><p>Some words on the site.</p></div></div>'
    assert html_text.main_text(page).split("\n")[0] == BODY.strip()


@pytest.mark.parametrize("name", ['id="side-effects"', 'id="form-of-government"', 'id="discussion"', 'class="review"', 'id="related"', 'class="overflow-hidden"'])
def test_names_of_content(name):
    page = f"<article><p>{BODY}</p><p>{BODY}</p><section {name}><h2>Part</h2><p>{BODY}</p></section></article>"
    assert html_text.main_text(page).split("\n") == [BODY.strip(), BODY.strip(), "Part", BODY.strip()]


@pytest.mark.parametrize("name", ['class="comments-area"', 'id="comments"', 'class="box ad"', 'class="ad-box"', 'class="related-posts"', 'role="complementary"'])
def test_names_of_parts(name):
    page = f"<article><p>{BODY}</p><p>{BODY}</p><div {name}><p>{BODY}</p></div></article>"
    assert html_text.main_text(page).split("\n") == [BODY.strip(), BODY.strip()]


def test_unsure_names_need_confirming():
    page = f'<article><p>{BODY}</p><div class="social"><a href="x">Like this page</a></div><div id="tags"><p>Red Blue Green</p></div></article>'
    assert html_text.main_text(page) == BODY.strip()


@pytest.mark.parametrize(
    "others",
    [
        "<div class='comments'><article><p>{0}</p></article><article><p>{0}</p></article></div>",
        "<div class='comments'><article><p>{0}{0}{0}{0}</p></article></div>",
        "<aside><article><p>{0}</p></article></aside>",
        "<div class='related'><article><p>{0}</p></article></div>",
        "<article class='comment'><p>{0}</p></article>",
        "<div><article><a href='x'>One</a></article><article><a href='y'>Two</a></article></div>",
    ],
)
def test_other_articles_do_not_mark_the_text(others):
    page = f"<div><h1>Name</h1><p>{BODY}</p><p>{BODY}{BODY}</p></div>{others.format(BODY)}<footer><p>{BODY}</p></footer>"
    assert html_text.main_text(page).split("\n") == ["Name", BODY.strip(), (BODY + BODY).strip()]


def test_own_article_with_comments_as_articles():
    page = f"<p>{BODY}</p><article><p>{BODY}{BODY}</p></article><div class='comments'><article><p>{BODY}</p></article></div>"
    assert html_text.main_text(page) == (BODY + BODY).strip()
    assert html_text.main_text("<p>Home</p><article><h1>News</h1><p>Rain falls</p></article>") == "News\nRain falls"


def test_several_articles():
    page = "".join(f"<article><h2>Part {i}</h2><p>{BODY}</p></article>" for i in range(3))
    assert len(html_text.main_text(page).split("\n")) == 6
    page = f"<p>{BODY}</p><p>{BODY}{BODY}{BODY}</p><article><p>I liked this.</p></article><article><p>So did I.</p></article>"
    assert html_text.main_text(page).startswith(BODY.strip())


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<!-- open", "<script>x", "</p></div>", "<a><a><p>", "&#x110000; &amp"])
def test_odd_pages(page):
    assert isinstance(html_text.main_text(page), str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</div>", "<article>", "</article>", "<b>", "text of the", "<a href='", "'>", "<script>", "</script>", "<!--", "-->", "&lt;", "<li>"]), max_size=25))
def test_any_page(parts):
    html_text.main_text("".join(parts))


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    out = collected(html_text.extract_text(pages))
    import html

    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?p>|</?h1>", article))
        want = "\n".join(b for b in blocks if b)
        assert out[r.page_id].text == want and out[r.page_id].n_chars == len(want)
    odd = spark.createDataFrame([(None, None, None), (1, "u", ""), (1, "u", "")], "page_id bigint, url string, html string")
    assert [r.n_chars for r in html_text.extract_text(odd).collect()] == [0, 0, 0]
