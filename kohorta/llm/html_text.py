"""Main text of web pages by two passes of block rules."""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession

from kohorta.llm.common import map_rows, query, read_table

# Frequent function words of the supported languages.
STOP_WORDS = frozenset(
    """
    a an and are as at be been but by can do for from had has have he her his i if in is it its
    no not of on one or our she so than that the their there they this to up was we were what when
    which who will with would you your
    al como con de del el en es esta este la las lo los mas no o para pero por que se sin su sus
    un una y ya
    als am an auch auf aus bei bin bis das dass dem den der des die doch ein eine einem einen einer
    er es für hat ich ihr im in ist ja kann man mit nach nicht noch nur oder sich sie sind so über um
    und uns von vor war wie wir wird zu zum zur
    à au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui mais
    même ne nous on ou où par pas plus pour qu que qui sa se ses si son sur un une vous
    """.split()
)

# Elements whose content is never text of the page.
SKIPPED = frozenset("script style noscript template svg math iframe object head title textarea select option button".split())
# Elements that stand around the article.
AROUND = frozenset("nav footer aside form menu dialog".split())
BLOCKS = frozenset(
    """
    address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol
    p pre search section summary table tbody td tfoot th thead tr ul
    """.split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# A start tag of the first closes an open element of the second.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
# Words in class, id or role that name parts around the article. A name counts as a whole: each of its words is one of
# these or says only where or what kind of box it is ("site-footer", but not "side-effects" or "no-sidebar").
# Comments and adverts are never around the article.
ASIDES = frozenset(
    """
    ad ads advert adverts advertisement advertorial promoted sponsor sponsored
    comment comments commentlist disqus respond replies
    """.split()
)
PARTS = frozenset(
    """
    banner promo nav navbar navigation breadcrumb breadcrumbs pagination pager masthead topbar footer colophon
    sidebar rail widget related recommended trending more-stories cookie cookies gdpr popup modal overlay
    newsletter subscribe signup login paywall share sharing contentinfo complementary
    """.split()
)
# Also names of content: the text decides.
MAYBE = frozenset(
    """
    menu toc header foot copyright side aside popular notice alert consent disclaimer discussion review reviews
    reply social follow tags search form skip hidden dialog
    """.split()
)
PLACES = frozenset(
    """
    site page main top bottom left right list box wrapper wrap container area section block bar button buttons link
    links item items post posts article articles content primary secondary global inner outer
    """.split()
)
LANDMARKS = frozenset("navigation banner complementary contentinfo search dialog alertdialog menu menubar".split())
NO_NAME, MAY_BE, IS_PART, IS_ASIDE = range(4)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
COPYRIGHT = re.compile(r"(?:©|\(c\)|copyright\b)", re.I)
WORD = re.compile(r"[^\W\d_]+")

# Limits of the block rules.
MAX_LINK_DENSITY, MAX_LINKS_INSIDE = 0.3, 0.9
SHORT_CHARS, LONG_CHARS = 70, 200
STOP_LOW, STOP_HIGH = 0.10, 0.20


@dataclass
class Block:
    """A run of text between block tags, with what the rules look at."""

    text: str
    link_chars: int
    heading: bool
    around: bool
    inside: bool
    article: int = -1  # number of the outermost article around it; 0 is any main
    label: str = ""


@dataclass
class Part:
    """An element named like a part around the article: its blocks, and how sure the name is."""

    sure: int
    start: int
    mains: int
    end: int = -1
    holds_main: bool = False


def attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(source)}


def is_around(tag: str, found: dict[str, str], inside: bool) -> bool:
    """Whether an element holds a part around the article, whatever its name."""
    if tag in AROUND:
        return True
    if tag == "header":
        return not inside  # an article's own header has its title
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return True
    return bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I))


def name_says(name: str, inside: bool) -> int:
    """How surely one class or id names a part around the article."""
    words = [name] if name in PARTS else [w for w in re.split(r"[-_]+", name) if w]
    said = NO_NAME
    for w in words:
        if w in ASIDES:
            said = max(said, IS_ASIDE)
        elif w in PARTS:
            said = max(said, IS_PART)
        elif w in MAYBE:
            if not (w == "header" and inside):
                said = max(said, MAY_BE)
        elif w not in PLACES:
            return NO_NAME
    return said


def part_of(tag: str, found: dict[str, str], inside: bool) -> int:
    """How surely class, role or id name an element as a part around the article."""
    if tag in ("html", "body", "main") or tag in HEADINGS:
        return NO_NAME
    said = max((name_says(c, inside) for c in found.get("class", "").lower().split()), default=NO_NAME)
    for role in found.get("role", "").lower().split():
        said = max(said, IS_PART if role in LANDMARKS else name_says(role, inside) and MAY_BE)
    by_id = name_says(found.get("id", "").strip().lower(), inside)
    # Sections and the parts of an article often have ids made from their titles.
    if tag == "section" or (inside and by_id < IS_ASIDE):
        by_id = min(by_id, MAY_BE)
    said = max(said, by_id)
    # An article may be a comment; otherwise it is what is looked for.
    return NO_NAME if tag == "article" and said < IS_ASIDE else said


class Stack:
    """Open elements, with counts and places at hand, so no step walks through them."""

    def __init__(self):
        self.tags: list[str] = []
        self.kinds: list[tuple[bool, Part | None]] = []
        self.paragraphs: list[int] = []  # p elements in a row up to each element
        self.places: dict[str, list[int]] = {}
        self.around = 0

    def count(self, tags) -> int:
        return sum(len(self.places[t]) for t in tags if t in self.places)

    @property
    def inside(self) -> int:
        return self.count(("article", "main"))

    @property
    def heading(self) -> bool:
        return self.count(HEADINGS) > 0

    def top(self) -> str:
        return self.tags[-1] if self.tags else ""

    def push(self, tag: str, around: bool, part: Part | None) -> None:
        self.paragraphs.append((self.paragraphs[-1] if self.paragraphs else 0) + 1 if tag == "p" else 0)
        self.places.setdefault(tag, []).append(len(self.tags))
        self.tags.append(tag)
        self.kinds.append((around, part))
        self.around += around

    def pop(self) -> Part | None:
        tag, (around, part) = self.tags.pop(), self.kinds.pop()
        self.paragraphs.pop()
        self.places[tag].pop()
        self.around -= around
        return part

    def place_to_close(self, tag: str) -> int | None:
        """Where the element that an end tag closes is; None for a stray end tag."""
        places = self.places.get(tag)
        if not places:
            return None
        at = places[-1]
        # A stray </p> does not close an article around it.
        return None if tag == "p" and self.paragraphs[-1] < len(self.tags) - at else at


def split_blocks(page: str) -> list[Block]:
    """Cuts a page at block tags; elements that are left open are closed by their parents.

    The time is in proportion to the page, however deep its elements are.
    """
    blocks: list[Block] = []
    parts: list[Part] = []
    stack = Stack()
    pieces: list[str] = []
    links = anchors = mains = articles = 0
    place = 0

    def close(at: int) -> None:
        while len(stack.tags) > at:
            if part := stack.pop():
                part.end, part.holds_main = len(blocks), mains > part.mains

    def flush() -> None:
        nonlocal links
        text = " ".join(html.unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            inside = stack.inside > 0
            article = -1 if not inside else 0 if stack.count(("main",)) else articles
            blocks.append(Block(text, min(links, len(text)), stack.heading, stack.around > 0, inside, article))
        links = 0

    def add(raw: str) -> None:
        nonlocal links
        pieces.append(raw)
        if anchors:
            links += len(" ".join(html.unescape(raw).split()))

    for m in iter_tags(page):
        if m.start() > place:
            add(page[place : m.start()])
        place = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "a":
                anchors = max(0, anchors - 1)
            if tag in BLOCKS:
                flush()
                at = stack.place_to_close(tag)
                if at is not None:
                    close(at)
            continue
        if tag == "a":
            anchors += 1
        if tag == "br":
            pieces.append(" ")
        if tag in BLOCKS:
            flush()
            if stack.top() == "p":
                close(len(stack.tags) - 1)
            if stack.top() in CLOSES.get(tag, ()):
                close(len(stack.tags) - 1)
            if tag not in VOID and not m[3].rstrip().endswith("/"):
                outer = stack.inside > 0
                articles += tag == "article" and not outer
                inside = outer or tag in ("article", "main")
                found = attributes(m[3]) if m[3] else {}
                mains += tag == "main"
                part = None
                if said := part_of(tag, found, inside):
                    part = Part(said, len(blocks), mains)
                    parts.append(part)
                stack.push(tag, is_around(tag, found, inside), part)
    if place < len(page):
        add(page[place:])
    flush()
    close(0)
    mark_parts(blocks, parts)
    return blocks


def sums(values) -> list[int]:
    return [0, *accumulate(values)]


def covered(n: int, parts: list[Part]) -> list[bool]:
    """Which of n blocks lie in any of the parts."""
    steps = [0] * (n + 1)
    for p in parts:
        steps[p.start] += 1
        steps[p.end] -= 1
    return [k > 0 for k in accumulate(steps[:n])]


def mark_parts(blocks: list[Block], parts: list[Part]) -> None:
    """Marks the blocks of named parts as around the article.

    An element with a ``main`` or with most of the page's text is a wrapper,
    whatever it is called; only comments and adverts may be longer than the text.
    A name that content may have too counts when the links or the few stop words
    of the whole part confirm it.
    """
    parts = [p for p in parts if p.start < p.end and not p.holds_main]
    if not parts:
        return
    asides = covered(len(blocks), [p for p in parts if p.sure == IS_ASIDE])
    texts = sums(0 if b.around or a else len(b.text) - b.link_chars for b, a in zip(blocks, asides))
    chars, links = sums(len(b.text) for b in blocks), sums(b.link_chars for b in blocks)
    words, stops = [0], [0]
    if any(p.sure == MAY_BE for p in parts):
        found = [stop_words(b.text) for b in blocks]
        words, stops = sums(n for n, _ in found), sums(k for _, k in found)

    def counts(p: Part) -> bool:
        if p.sure == IS_ASIDE:
            return True
        if 2 * (texts[p.end] - texts[p.start]) > texts[-1]:
            return False
        if p.sure == IS_PART or links[p.end] - links[p.start] > MAX_LINK_DENSITY * (chars[p.end] - chars[p.start]):
            return True
        return stops[p.end] - stops[p.start] < STOP_LOW * max(1, words[p.end] - words[p.start])

    for b, named in zip(blocks, covered(len(blocks), [p for p in parts if counts(p)])):
        b.around |= named


def iter_tags(page: str):
    """Tags in order; the content of skipped elements is passed over as a whole."""
    place, open_ended = 0, set()
    while m := TOKEN.search(page, place):
        yield m
        place = m.end()
        tag = (m[2] or "").lower()
        if tag in SKIPPED and not m[1] and not (m[3] or "").rstrip().endswith("/"):
            end = None
            if tag not in open_ended:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, place)
            if end is None:
                open_ended.add(tag)  # no end further on: not looked for again
            stop = end.end() if end else place if tag in ("head", "option", "select", "button") else len(page)
            yield _Gap(m.end(), stop)
            place = stop


class _Gap:
    """Stands for a skipped stretch of the page."""

    def __init__(self, start: int, end: int):
        self._start, self._end = start, end

    def start(self) -> int:
        return self._start

    def end(self) -> int:
        return self._end

    def __getitem__(self, group: int) -> str:
        return ""


def stop_words(text: str) -> tuple[int, int]:
    """Words, and stop words among them."""
    words = WORD.findall(text.lower())
    return len(words), sum(w in STOP_WORDS for w in words)


def stop_density(text: str) -> float:
    n, stops = stop_words(text)
    return stops / max(1, n)


# Scripts whose characters are syllables or words and stand without blanks.
DENSE = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uac00-\ud7af]")


def weight(text: str) -> int:
    """Length of a text, with characters of dense scripts counted as three."""
    return len(text) + 2 * len(DENSE.findall(text))


def known_language(blocks: list[Block]) -> bool:
    """Whether some longer block of text is written in a language of the stop words."""
    return any(
        len(b.text) >= SHORT_CHARS
        and b.link_chars <= MAX_LINK_DENSITY * len(b.text)
        and stop_density(b.text) >= STOP_HIGH
        for b in blocks
    )


def classify(block: Block, known: bool = True) -> str:
    """First pass: good, bad, near-good or short, from the block alone.

    Link density decides first, then stop-word density and length; on a page of
    no known language length alone. Where the page marks its article, a block in
    it is bad only if it is nearly all link or for its part, and one of few stop
    words is left to its neighbours.
    """
    most = MAX_LINKS_INSIDE if block.inside else MAX_LINK_DENSITY
    if block.around or block.link_chars > most * len(block.text):
        return "bad"
    if block.inside:
        return "good" if stop_density(block.text) >= STOP_LOW else "near-good"
    if COPYRIGHT.match(block.text):
        return "bad"
    length = len(block.text) if known else weight(block.text)
    if length < SHORT_CHARS:
        return "bad" if block.link_chars else "short"
    if not known:
        return "good" if length >= LONG_CHARS else "near-good"
    density = stop_density(block.text)
    if density >= STOP_HIGH:
        return "good" if length >= LONG_CHARS else "near-good"
    return "near-good" if density >= STOP_LOW else "bad"


def marks_article(blocks: list[Block]) -> bool:
    """Whether the page's article or main elements hold its text.

    Blocks around the article do not count: comments and teasers are often
    article elements too. A ``main``, or one article of some length, is enough;
    several articles or a short one must hold more text than the good blocks
    outside.
    """
    own = [b for b in blocks if b.inside and not b.around]
    length = sum(len(b.text) - b.link_chars for b in own)
    if not length:
        return False
    places = {b.article for b in own}
    if 0 in places or (len(places) == 1 and length >= LONG_CHARS):
        return True
    known = known_language(blocks)
    return length >= sum(len(b.text) for b in blocks if not b.inside and classify(b, known) == "good")


def label_blocks(blocks: list[Block]) -> None:
    """Second pass: undecided blocks take the label of the nearest decided ones.

    With equal neighbours theirs is taken. Between a good and a bad one, a
    near-good block is good, a heading goes with what follows, and a short block
    goes with the nearer one, counted in blocks; at the same distance it is bad.
    A missing neighbour counts as bad, in a marked article as good. If nothing is
    decided, near-good is good and short is bad. Where the page marks an article,
    blocks outside are bad.
    """
    marked, known = marks_article(blocks), known_language(blocks)
    for b in blocks:
        b.inside &= marked
        b.label = classify(b, known) if b.inside or not marked else "bad"
    decided = [i for i, b in enumerate(blocks) if b.label in ("good", "bad")]
    first = [b.label for b in blocks]
    for i, b in enumerate(blocks):
        if b.label in ("good", "bad"):
            continue
        at = bisect_left(decided, i)
        left = decided[at - 1] if at else None
        right = decided[at] if at < len(decided) else None
        edge = "good" if b.inside else "bad"
        before = first[left] if left is not None and blocks[left].inside == b.inside else edge
        after = first[right] if right is not None and blocks[right].inside == b.inside else edge
        if not decided:
            b.label = "good" if b.label == "near-good" else "bad"
        elif before == after:
            b.label = before
        elif b.label == "near-good":
            b.label = "good"
        elif b.heading:
            b.label = after
        else:
            to_left = i - left if left is not None else len(blocks)
            to_right = right - i if right is not None else len(blocks)
            b.label = before if to_left < to_right else after if to_right < to_left else "bad"


def main_text(page: str | None) -> str:
    blocks = split_blocks(page or "")
    label_blocks(blocks)
    return "\n".join(b.text for b in blocks if b.label == "good")


def extract_text(pages: DataFrame, html_column: str = "html", key: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, url, text, n_chars of every page; a missing page has empty text.

    Repeated rows and missing ids are treated like any other row.
    """

    def rows(keys, urls, pages):
        for k, u, page in zip(keys, urls, pages):
            text = main_text(page)
            yield k, u, text, len(text)

    return map_rows(pages, [key, url, html_column], rows, f"{key} bigint, {url} string, text string, n_chars bigint")


@query("op9_html_text")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read_table(spark, sf_dir, "pages"))
