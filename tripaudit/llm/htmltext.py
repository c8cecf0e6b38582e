"""Main text of web pages from flat text blocks and a decision tree.

A page is read once, tag by tag, into flat blocks of text.  Every block is described by its
number of words and link density, those of its neighbours, and where it stands (within
marked boilerplate, within a marked article, as a heading).  A decision tree, grown at start
on the small labelled table below, tells main text from boilerplate; the kept blocks in
page order, one per line, are the page's text.

A mark by a word in a class or id can be outvoted: it does not count for an element that
holds the page's article (or most of its unlinked words) and leaves little outside, such as
``content-sidebar-wrap`` or ``post comments-open`` (see ``outvoted``).

Reading takes time linear in the page: no construct looks ahead further than its own end,
and an attribute value that is never closed is met once.

Defined results: null or empty html gives an empty text; a page without main text gives an
empty text; markup that is cut off or not closed ends with the page; repeated rows give the
same text; columns of the input named ``text`` or ``n_chars`` are replaced.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripaudit.llm.tables import pieces, table

# Element names of HTML and the words sites commonly mark boilerplate with.
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol
    optgroup option p pre section summary table tbody td tfoot th thead tr ul""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title xmp iframe noembed noframes".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILER_TAGS = frozenset("""nav footer aside form menu dialog noscript template button select svg math canvas object
    audio video label fieldset""".split())
MAIN_TAGS = frozenset("article main".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
BOILER_WORDS = frozenset("""ad ads adv advert adverts advertisement advertisements advertising alert banner breadcrumb
    breadcrumbs byline comment commentlist comments consent cookie cookies copyright dialog discussion disqus footer
    form gdpr hidden legal login menu modal nav navbar navigation newsletter notice notices notification overlay pager
    pagination popup privacy promo promotion recommended related replies reply respond search share sharing sidebar
    signup skip social sponsor sponsored subscribe subscription toolbar widget""".split())
HEADER_WORDS = frozenset("header masthead".split())
COMMENT_WORDS = frozenset("comment commentlist comments discussion disqus replies reply respond".split())
MAIN_WORDS = frozenset("article content entry main post story".split())
FEATURES = ("words", "links", "before_words", "before_links", "after_words", "after_links",
            "boiler", "article", "elsewhere", "heading")

_TAG_END = re.compile(r"""(?:[^"'>]++|"[^"]*+"|'[^']*+')*+>""")
_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_ATTR = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
_MARKS = ("class", "id", "role", "hidden", "aria-hidden", "style")
_HUMP = re.compile(r"([a-z0-9])([A-Z])")
_PART = re.compile(r"[A-Za-z]+")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    boiler: int
    article: int
    heading: int


@dataclass
class Named:
    """An element marked as boilerplate by its class or id alone: its blocks are
    ``start`` to ``end``, ``mains`` the article and main elements it is or holds."""
    above: int | None
    firm: bool
    start: int
    mains: int
    end: int = 0


@dataclass
class _Open:
    tag: str
    boiler: bool
    article: bool
    inline: bool
    named: bool = False
    firm: bool = False
    number: int | None = None


@dataclass
class _Page:
    """State while a page is read."""

    blocks: list[Block] = field(default_factory=list)
    stack: list[_Open] = field(default_factory=list)
    open: Counter = field(default_factory=Counter)
    text: list[str] = field(default_factory=list)
    link_text: list[str] = field(default_factory=list)
    in_link: bool = False
    boiler: int = 0
    article: int = 0
    muted: int = 0
    heading: int = 0
    mains: int = 0
    named: list[Named] = field(default_factory=list)
    within: list[int] = field(default_factory=list)
    silent: list[_Open] = field(default_factory=list)

    def add(self, s: str) -> None:
        if self.muted or not s:
            return
        self.text.append(s)
        if self.in_link:
            self.link_text.append(s)

    def flush(self) -> None:
        if self.text:
            raw = "".join(self.text)
            clean = " ".join((entities.unescape(raw) if "&" in raw else raw).split())
            if clean:
                self.blocks.append(Block(clean, clean.count(" ") + 1, len(" ".join(self.link_text).split()),
                                         self.boiler, int(self.article > 0), self.heading))
            self.text = []
        self.link_text = []

    def push(self, tag: str, boiler: bool, article: bool, inline: bool, named: bool = False, firm: bool = False,
             mains: int = 0) -> None:
        top = _Open(tag, boiler, article, inline, named, firm)
        self.stack.append(top)
        self.open[tag] += 1
        self.article += article
        if not named:
            self.boiler += boiler and not inline
            self.muted += boiler and inline
        elif inline:
            self.muted += 1
            self.silent.append(top)
        else:
            self.name(top)
        self.mains += mains

    def name(self, top: _Open) -> None:
        top.number = len(self.named)
        self.named.append(Named(self.within[-1] if self.within else None, top.firm, len(self.blocks), self.mains))
        self.within.append(top.number)

    def unmute(self) -> None:
        """Inline elements marked by name that turn out to hold blocks are no inline text."""
        for top in self.silent:
            top.inline = False
            self.muted -= 1
            self.name(top)
        self.silent.clear()

    def pop(self) -> _Open:
        if self.stack[-1].number is not None:
            self.flush()
        top = self.stack.pop()
        self.open[top.tag] -= 1
        self.article -= top.article
        if not top.named:
            self.boiler -= top.boiler and not top.inline
            self.muted -= top.boiler and top.inline
        elif top.inline:
            self.muted -= 1
            self.silent.pop()
        else:
            self.end(self.within.pop())
        return top

    def end(self, number: int) -> None:
        e = self.named[number]
        e.end, e.mains = len(self.blocks), self.mains - e.mains

    def close(self, tag: str) -> None:
        if self.open[tag]:
            while self.pop().tag != tag:
                pass


#: Times the unmarked words elsewhere that an element must hold to outvote its mark: one that
#: holds an article, one that does not, one whose name is a boilerplate word and nothing else.
HOLDER, OTHER, FIRM = 1, 2, 10
#: Least words of an element without an article element.
FEW = 10


def outvoted(blocks: list[Block], named: list[Named]) -> None:
    """Count in every block the marks by name that stand.

    Words are unlinked ones outside elements marked by tag, role or style, and only those of
    articles where the page has any.  Marks are decided from the outside in, compound names
    (``has-sidebar``) before plain ones (``sidebar``), against the words free so far.
    """
    usable = [b.words - min(b.linked, b.words) if not b.boiler else 0 for b in blocks]
    if any(w and b.article for w, b in zip(usable, blocks, strict=True)):
        usable = [w * b.article for w, b in zip(usable, blocks, strict=True)]
    upto = np.concatenate([[0], np.cumsum(usable, dtype=np.int64)])
    inside = [int(upto[e.end] - upto[e.start]) for e in named]
    below: list[list[int]] = [[] for _ in named]
    level = []
    for i, e in enumerate(named):
        (level if e.above is None else below[e.above]).append(i)
    total = int(upto[-1])
    free = total - sum(inside[i] for i in level)
    stands = [True] * len(named)
    while level:
        deeper = []
        for firm in (False, True):
            freed = 0
            for i in level:
                e, n = named[i], inside[i]
                if e.firm != firm or not n:
                    continue
                times = FIRM if firm else HOLDER if e.mains else OTHER
                if n > times * free and (e.mains or n >= FEW and 2 * n > total):
                    stands[i] = False
                    freed += n - sum(inside[j] for j in below[i])
                    deeper += below[i]
            free += freed
        level = deeper
    marks = [0] * (len(blocks) + 1)
    for e, stand in zip(named, stands, strict=True):
        marks[e.start] += stand
        marks[e.end] -= stand
    count = 0
    for b, step in zip(blocks, marks):
        count += step
        b.boiler += count


def marked(tag: str, attrs: str, in_article: bool) -> tuple[bool, bool, bool, bool, bool]:
    """Whether an element is marked as boilerplate, as main text, as boilerplate by its class or
    id alone, firmly so, and whether it is an article or main element."""
    boiler = tag in BOILER_TAGS or tag == "header" and not in_article
    main = holder = tag in MAIN_TAGS
    named = firm = False
    if attrs and any(m in attrs.lower() for m in _MARKS):
        words, tokens = set(), set()
        for name, value in _ATTR.findall(attrs):
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id"):
                parts = {x.lower() for x in _PART.findall(_HUMP.sub(r"\1 \2", value))}
                named = named or not parts.isdisjoint(BOILER_WORDS)
                named = named or not in_article and not parts.isdisjoint(HEADER_WORDS) and tag not in HEADINGS
                main = main or tag in ("div", "section") and not parts.isdisjoint(MAIN_WORDS)
                words |= parts
                tokens.update(value.lower().split())
            elif name == "role":
                boiler = boiler or value.lower() in BOILER_ROLES
                holder = holder or value.lower() in ("main", "article")
                main = main or holder
            elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                boiler = True
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                boiler = True
        firm = not tokens.isdisjoint(BOILER_WORDS) or not words.isdisjoint(COMMENT_WORDS) and words.isdisjoint(MAIN_WORDS)
    # Page-wide elements carry theme classes; they hold everything.
    if tag in ("html", "body"):
        return False, False, False, False, False
    return boiler, main, named and not boiler, firm, holder


def read_blocks(page: str) -> list[Block]:
    """Flat text blocks of a page."""
    p, at, n, quoted = _Page(), 0, len(page), True
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            p.add(page[at:])
            break
        p.add(page[at:lt])
        nxt = page[lt + 1:lt + 2]
        if nxt == "!" and page.startswith("<!--", lt):
            if page.startswith(">", lt + 4) or page.startswith("->", lt + 4):
                at = page.index(">", lt) + 1
            else:
                end = page.find("-->", lt + 4)
                at = n if end < 0 else end + 3
            continue
        closing = nxt == "/"
        m = _NAME.match(page, lt + 1 + closing)
        if not m:
            if nxt and nxt in "!?/":  # declarations and the like end at the next >
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                p.add("<")
                at = lt + 1
            continue
        end_at = _TAG_END.match(page, m.end()) if quoted else None
        if end_at:
            end = end_at.end()
        else:
            quoted = False  # an open quote: from here on tags end at the next >
            end = page.find(">", m.end()) + 1
            if not end:
                break
        tag, attrs, at = m[0].lower(), page[m.end():end - 1], end
        if closing:
            if tag == "a":
                p.in_link = False
                p.close(tag)
            elif tag in BLOCK_TAGS:
                p.flush()
                p.close(tag)
                p.in_link = False
                if tag in HEADINGS:
                    p.heading = 0
            elif tag == "br":
                p.add(" ")
            else:
                p.close(tag)
            continue
        if tag in RAW_TAGS:
            stop = _raw_end(tag).search(page, at)
            if not stop:
                break
            after = page.find(">", stop.end() - 1)
            at = n if after < 0 else after + 1
            continue
        if tag == "br":
            p.add(" ")
            continue
        if tag == "a":
            p.in_link = "href" in attrs.lower()
        block = tag in BLOCK_TAGS
        if block:
            p.unmute()
            p.flush()
            # A paragraph ends where another block begins, a list item where the next one does.
            if p.stack and p.stack[-1].tag == "p" or tag in ("li", "dt", "dd", "td", "th", "tr", "option") \
                    and p.stack and p.stack[-1].tag == tag:
                p.pop()
            p.heading = int(tag in HEADINGS)
        if tag in VOID_TAGS or attrs.endswith("/") and not block:
            continue
        boiler, main, named, firm, holder = marked(tag, attrs, p.article > 0)
        if block or boiler or named:
            p.push(tag, boiler, main, not block, named, firm, holder)
    p.flush()
    for number in p.within:
        p.end(number)
    outvoted(p.blocks, p.named)
    return p.blocks


@cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}[\s/>]", re.I)


def block_features(blocks: list[Block]) -> np.ndarray:
    """One row of FEATURES per block; beyond the page's ends there are blocks of no words."""
    out = np.zeros((len(blocks), len(FEATURES)))
    if blocks:
        words = np.array([b.words for b in blocks], float)
        links = np.array([min(b.linked / b.words, 1.0) for b in blocks])
        out[:, 0], out[:, 1] = words, links
        out[1:, 2], out[1:, 3] = words[:-1], links[:-1]
        out[:-1, 4], out[:-1, 5] = words[1:], links[1:]
        out[:, 6] = [b.boiler for b in blocks]
        out[:, 7] = [b.article for b in blocks]
        out[:, 8] = 1 - out[:, 7] if out[:, 7].any() else 0
        out[:, 9] = [b.heading for b in blocks]
    return out


# Labelled table: pages as rows of (main text?, words, linked words, boiler, article, heading).
LABELLED: list[list[tuple[int, int, int, int, int, int]]] = [
    # A marked article between menus, an advert and a footer.
    [(0, 1, 1, 1, 0, 0), (0, 2, 2, 1, 0, 0), (0, 6, 0, 1, 0, 0), (1, 9, 0, 0, 1, 1), (1, 80, 2, 0, 1, 0),
     (1, 2, 0, 0, 1, 0), (1, 45, 0, 0, 1, 0), (0, 8, 0, 1, 0, 0)],
    [(0, 1, 1, 1, 0, 0), (0, 1, 1, 1, 0, 0), (0, 20, 0, 1, 0, 0), (1, 3, 0, 0, 1, 1), (1, 1, 0, 0, 1, 0),
     (1, 1, 0, 0, 1, 0), (0, 30, 0, 1, 0, 0)],
    # Notices, related links and reader comments inside the article element.
    [(0, 5, 5, 1, 0, 0), (1, 6, 0, 0, 1, 1), (0, 4, 1, 1, 1, 0), (1, 120, 5, 0, 1, 0), (0, 25, 0, 1, 1, 0),
     (1, 60, 0, 0, 1, 0), (0, 6, 6, 1, 1, 0), (0, 40, 0, 2, 1, 0), (0, 90, 0, 2, 1, 0)],
    # Links within the article: a list of them and a paragraph that is one link.
    [(0, 3, 3, 1, 0, 0), (1, 7, 0, 0, 1, 1), (1, 5, 5, 0, 1, 0), (1, 4, 4, 0, 1, 0), (1, 30, 12, 0, 1, 0),
     (0, 4, 4, 1, 0, 0)],
    [(0, 3, 3, 1, 0, 0), (1, 6, 6, 0, 1, 1), (1, 90, 1, 0, 1, 0), (1, 8, 8, 0, 1, 0), (1, 50, 30, 0, 1, 0),
     (1, 70, 0, 0, 1, 0), (0, 4, 4, 1, 0, 0)],
    # An article, and unmarked text elsewhere on the page.
    [(0, 4, 0, 0, 0, 0), (0, 3, 3, 0, 0, 0), (1, 8, 0, 0, 1, 1), (1, 70, 0, 0, 1, 0), (0, 25, 2, 0, 0, 0),
     (0, 60, 0, 0, 0, 0), (0, 5, 2, 0, 0, 0)],
    [(0, 12, 0, 0, 0, 1), (1, 10, 0, 0, 1, 0), (1, 15, 0, 0, 1, 0), (0, 40, 0, 0, 0, 0), (0, 9, 0, 0, 0, 0)],
    # No article element: marked boilerplate around plain blocks.
    [(0, 2, 2, 1, 0, 0), (1, 6, 0, 0, 0, 1), (1, 55, 0, 0, 0, 0), (1, 3, 0, 0, 0, 0), (1, 70, 4, 0, 0, 0),
     (0, 30, 0, 1, 0, 0), (0, 90, 0, 2, 0, 0)],
    [(1, 5, 0, 0, 0, 1), (1, 20, 0, 0, 0, 0), (1, 4, 0, 0, 0, 0), (1, 35, 0, 0, 0, 0), (0, 7, 0, 1, 0, 0)],
    # Nothing marked at all: link density and neighbours decide.
    [(0, 1, 1, 0, 0, 0), (0, 2, 2, 0, 0, 0), (0, 3, 3, 0, 0, 0), (1, 7, 0, 0, 0, 1), (1, 65, 0, 0, 0, 0),
     (1, 40, 3, 0, 0, 0), (1, 5, 0, 0, 0, 0), (1, 50, 9, 0, 0, 0), (0, 4, 4, 0, 0, 0), (0, 6, 5, 0, 0, 0),
     (0, 4, 0, 0, 0, 0)],
    [(0, 2, 2, 0, 0, 0), (0, 1, 1, 0, 0, 0), (0, 12, 9, 0, 0, 0), (1, 30, 0, 0, 0, 0), (1, 18, 1, 0, 0, 0),
     (1, 90, 20, 0, 0, 0), (1, 45, 10, 0, 0, 0), (0, 8, 6, 0, 0, 0), (0, 3, 3, 0, 0, 0), (0, 5, 0, 0, 0, 0)],
    [(0, 2, 0, 0, 0, 0), (0, 1, 1, 0, 0, 0), (0, 2, 2, 0, 0, 0), (1, 5, 0, 0, 0, 1), (1, 35, 6, 0, 0, 0),
     (1, 2, 0, 0, 0, 0), (1, 25, 0, 0, 0, 0), (0, 9, 4, 0, 0, 0), (0, 2, 2, 0, 0, 0), (0, 3, 0, 0, 0, 0)],
    [(0, 1, 1, 0, 0, 0), (0, 1, 1, 0, 0, 0), (1, 50, 0, 0, 0, 0), (1, 45, 0, 0, 0, 0), (0, 1, 1, 0, 0, 0)],
    # Marked articles with every kind of short block.
    [(0, 1, 1, 1, 0, 0), (1, 1, 0, 0, 1, 1), (1, 1, 0, 0, 1, 0), (1, 1, 1, 0, 1, 0), (1, 1, 0, 0, 1, 0),
     (1, 1, 1, 0, 1, 0), (1, 1, 1, 0, 1, 0), (0, 1, 0, 1, 0, 0)],
    [(1, 2, 2, 0, 1, 0), (1, 90, 80, 0, 1, 0), (1, 2, 0, 0, 1, 0), (1, 90, 0, 0, 1, 0), (0, 90, 0, 0, 0, 0)],
    # A text of one or two lines and nothing else.
    [(1, 6, 0, 0, 0, 0)],
    [(1, 2, 0, 0, 0, 1), (1, 25, 0, 0, 0, 0)],
]


#: Where an article is marked, its blocks are main text at any length: such pages count at
#: these scales too.
SCALES = (0.02, 0.2, 1.0, 5.0)


def labelled_rows() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the labelled table."""
    xs, ys = [], []
    for page in LABELLED:
        for scale in SCALES if any(row[4] for row in page) else (1.0,):
            blocks = []
            for _, words, linked, boiler, article, heading in page:
                n = max(1, round(words * scale))
                blocks.append(Block("", n, min(n, round(linked * n / words)), boiler, article, heading))
            xs.append(block_features(blocks))
            ys += [row[0] for row in page]
    return np.concatenate(xs), np.array(ys)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6):
    """Decision tree by Gini impurity: a label, or (feature, threshold, low, high)."""
    ones = int(y.sum())
    if depth == 0 or ones in (0, len(y)):
        return int(2 * ones > len(y))
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for t in (values[:-1] + values[1:]) / 2:
            low = x[:, f] <= t
            impurity = sum(m.sum() * (p := y[m].mean()) * (1 - p) for m in (low, ~low))
            if best is None or impurity < best[0] - 1e-12:
                best = impurity, f, float(t), low
    if best is None:
        return int(2 * ones > len(y))
    _, f, t, low = best
    return f, t, grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)


def classify(tree, rows: np.ndarray) -> list[bool]:
    out = []
    for row in rows:
        node = tree
        while isinstance(node, tuple):
            f, t, low, high = node
            node = low if row[f] <= t else high
        out.append(bool(node))
    return out


def main_text(page: str | None, tree) -> str:
    if not page:
        return ""
    blocks = read_blocks(page)
    keep = classify(tree, block_features(blocks))
    return "\n".join(b.text for b, ok in zip(blocks, keep, strict=True) if ok)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """Replace ``html`` by the main ``text`` of every page and its length ``n_chars``."""
    tree = grow(*labelled_rows())

    def read(batches):
        for batch in batches:
            for part in pieces(batch):
                texts = [main_text(t, tree) for t in part.column(part.schema.get_field_index(html)).to_pylist()]
                cols = dict(zip(part.schema.names, part.columns, strict=True))
                del cols[html]
                cols |= {"text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())}
                yield pa.record_batch(list(cols.values()), list(cols))

    blank = pages.withColumn("text", F.lit("")).withColumn("n_chars", F.lit(0).cast("bigint"))
    return blank.mapInArrow(read, blank.drop(html).schema)


def op1_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages", "page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
