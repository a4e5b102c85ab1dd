"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks: the text between starts and ends of block-level elements. A logistic classifier, trained below on
labelled snippets, gives each block a cost for either label from its own text, its links and what its ancestors say against it; the
costs become the capacities of edges from the source and to the sink. Blocks that follow each other, and consecutive blocks of one
parent, are joined by edges whose capacity falls with their distance in the tree, and blocks within an article (or what else
says that it is the main text) are joined to a node for it. The node's pull to the source grows with its blocks, so that a long
article is no easier to lose than a short one. A minimum cut of this graph labels the
blocks: a heading or a short line without a sentence goes with what is around it, at the least total cost.

What an element's class says against its text is judged by whole names: "sidebar" and "site-sidebar" are one, "has-sidebar" and "ad-free-content"
aren't. A name of which only the last word is against it ("article-share-wrap") counts for less than the text of a paragraph. It is set aside
where an article or main element lies inside, a clear one by a main element only; a form, where either lies inside; all for an element that holds most of the page's text and its
first h1, or no h1 being there, unless it is of readers' comments.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import deque
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careerlake.llm.common import map_arrow

# HTML's element kinds, and words of class and id attributes that tell parts of a page.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul button label".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object canvas audio video noframes noembed xmp datalist".split())
CLOSES_P = BLOCKS - {"body", "html", "head", "option", "optgroup", "button", "label", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "legend"}
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option", "optgroup"}, "optgroup": {"optgroup"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}}
SCOPES = frozenset("table ul ol dl select article section div main body html aside nav header footer form blockquote td th".split())
AWAY = frozenset("nav footer aside form menu dialog search".split())
CONTROLS = frozenset("button label select option optgroup legend fieldset summary".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
AWAY_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alertdialog alert tablist toolbar".split())
AWAY_WORDS = frozenset("nav navbar navigation menu submenu header masthead topbar footer foot sidebar side rail aside ad ads adv advert adverts advertisement advertisements advertising adsense adbox adslot sponsor sponsored sponsors promo promoted promotion promotions banner cookie cookies consent gdpr notice notices notification notifications alert alerts disclaimer comment comments commentlist disqus respond replies reply discussion social share sharing sharebar follow related recommended recommendations recirc outbrain taboola breadcrumb breadcrumbs newsletter newsletters subscribe subscription signup signin login register modal popup overlay widget widgets copyright legal pagination pager paging toc tags taglist toolbar skip search searchbox paywall popular trending".split())
MAIN_WORDS = frozenset("article content contents post entry story main body text maincontent articlebody prose hentry".split())
#: Words of a class name that say how a page is built, not what an element holds; and words that say neither.
STATE_WORDS = frozenset("has is no not with without js layout template theme enabled disabled free hide show visible active type single mode support supports can body below above before after".split())
PLAIN_WORDS = frozenset("wrap wrapper container box area inner outer block section list item items row col column group holder region site page global primary secondary left right top bottom mobile desktop posts articles stories news links link message inline fixed sticky large small new bar panel slot unit module cta button buttons icon icons law feed zone strip elementor wp the of and".split())
READERS_WORDS = frozenset("comment comments commentlist disqus respond replies reply discussion".split())
HEAD_WORDS = frozenset("header masthead banner".split())
TEXT_TAGS = frozenset("p pre blockquote li dd dt td figcaption h1 h2 h3 h4 h5 h6".split())
NAME = re.compile(r"</?[A-Za-z][^\s/>]*")
MARKS = re.compile("[>\"']")
ATTRIBUTE = re.compile(r"""([^\s=>/"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORD_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SENTENCE = re.compile(r"[.!?…。](?:\s|$|[\"'”’)])")


@cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I)


WEAK, STRONG = 1, 2


def against(name: str, within: bool) -> tuple[int, bool]:
    """What a class or id name says against an element's text, and whether it is of readers' words; within: the element is in the main text."""
    parts = [w.lower() for w in WORD_PARTS.findall(name)]
    if STATE_WORDS.intersection(parts) and len(parts) > 1:
        return 0, False
    core = [w for w in parts if w not in PLAIN_WORDS]
    main = MAIN_WORDS.intersection(core)
    away = AWAY_WORDS.intersection(core) - (HEAD_WORDS if within or main else frozenset())
    if not away:
        return 0, False
    readers = not READERS_WORDS.isdisjoint(core)
    if not main:
        return (STRONG if away.issuperset(core) else WEAK), readers
    return ((STRONG if readers else WEAK) if core[-1] in away else 0), readers


class Element:
    __slots__ = ("tag", "depth", "up", "is_main", "main", "region", "mark", "by_name", "readers", "strong", "weak", "form", "hidden", "control", "last", "chars", "first")

    def __init__(self, tag: str, up: Element | None, attributes: str):
        self.tag, self.up = tag, up
        self.depth = up.depth + 1 if up else 0
        self.main = up.main if up else False
        self.region = up.region if up else None  # the innermost element that says it holds the main text
        self.hidden = up.hidden if up else False
        self.control = (up.control if up else False) or tag in CONTROLS
        self.last = -1  # its last block
        self.chars, self.first = 0, False  # its text outside links, and whether the page's first h1 is in it
        self.mark, self.by_name, self.readers = 0, False, False  # what it says against its text, and whether by its name alone
        self.strong = self.weak = self.form = 0  # the marks that count against its blocks
        names: list[str] = []
        role = ""
        if attributes and tag not in ("html", "body"):
            for name, a, b, c in ATTRIBUTE.findall(attributes):
                name, value = name.lower(), a or b or c
                if name in ("class", "id"):
                    names += value.split()
                elif name == "role":
                    role = value.strip().lower()
                elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                    self.hidden = True
        within = self.main
        named = [against(n, within) for n in names] if tag not in ("article", "main") else []
        says_main = tag in ("div", "section", "td") and any(MAIN_WORDS.intersection(w.lower() for w in WORD_PARTS.findall(n)) and not against(n, within)[0] for n in names)
        self.is_main = 2 if tag == "main" or role == "main" else 1 if tag == "article" or role == "article" or says_main else 0
        if self.is_main:
            self.main, self.region = True, self
        self.mark = max((m for m, _ in named), default=0)
        self.by_name, self.readers = self.mark > 0, any(r for _, r in named)
        if tag == "header" and within or tag == "form":  # an article has a head of its own; some pages are one form
            pass
        elif tag == "header" or tag in AWAY or role in AWAY_ROLES:
            self.mark, self.by_name = STRONG, False

    def judge(self, chars: int, first: bool) -> None:
        """Which marks count here: the parent's, its own; chars is the page's text, first whether it has an h1."""
        up = self.up
        self.strong, self.weak, self.form = (up.strong, up.weak, up.form) if up and self.is_main < 2 else (0, 0, 0)
        if self.is_main:
            self.weak = self.form = 0
        most = 2 * self.chars >= chars > 0
        alone = not first or self.mark == WEAK and self.main  # no title elsewhere, or the article's text is in it
        if most and (self.by_name or self.tag == "form") and (self.first or alone and not self.readers):
            return
        self.strong += self.mark == STRONG
        self.weak += self.mark == WEAK
        self.form += self.tag == "form"


class Block:
    __slots__ = ("at", "text", "linked", "before")

    def __init__(self, at: Element, text: str, linked: int):
        self.at, self.text, self.linked = at, text, linked
        self.before = at.last  # the block before it of the same parent


class Tags:
    """A page's tags from left to right, in time linear in its length whatever it holds."""

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.unended: set[int] = set()  # places from where no tag ends, with every quote closed before

    def end(self, place: int) -> int:
        """Where the tag whose name ends here ends, by its quotes; if those don't close, at the next >."""
        page, at, seen = self.page, place, []
        while at not in self.unended:
            m = MARKS.search(page, at)
            if m is None:
                break
            if m[0] == ">":
                return m.start()
            close = page.find(m[0], m.end()) if m.end() <= self.last else -1
            if close < 0:
                break
            seen.append(at)
            at = close + 1
        self.unended.update(seen)
        return page.find(">", place)

    def next(self, place: int) -> tuple[int, int, str, str]:
        """Start and end of the next tag or comment, its name (with a slash if it closes, empty if neither) and attributes; the page's end if there is none."""
        page = self.page
        while True:
            start = page.find("<", place)
            if start < 0:
                return len(page), len(page), "", ""
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, end + 3 if end >= 0 else len(page), "", ""
            if start > self.last:
                return len(page), len(page), "", ""
            if page.startswith(("<!", "<?"), start):
                return start, page.find(">", start) + 1, "", ""
            m = NAME.match(page, start)
            if m is None:
                place = start + 1
                continue
            end = self.end(m.end())
            return start, end + 1, m[0][1:], page[m.end() : end]


class Open:
    """The open elements: the current one, and the innermost of each name."""

    def __init__(self):
        self.here = Element("", None, "")
        self.all = [self.here]  # in order, parents first
        self.of: dict[str, list[Element]] = {}
        self.scopes: list[int] = [-1]  # depths of open elements that end the search for some others

    def start(self, tag: str, attributes: str) -> None:
        self.here = Element(tag, self.here, attributes)
        self.all.append(self.here)
        self.of.setdefault(tag, []).append(self.here)
        if tag in SCOPES:
            self.scopes.append(self.here.depth)

    def up(self) -> None:
        self.of[self.here.tag].pop()
        if self.here.tag in SCOPES:
            self.scopes.pop()
        self.here = self.here.up

    def end(self, tag: str, within: tuple[str, ...] = ()) -> None:
        """Ends the innermost element of this name and what is in it; within: not beyond scopes and these."""
        found = self.of.get(tag)
        if not found:
            return
        e = found[-1]
        if within and (e.depth < self.scopes[-1] or any(self.of.get(t) and e.depth < self.of[t][-1].depth for t in within)):
            return
        while self.here is not e.up:
            self.up()


def blocks(page: str) -> list[Block]:
    """The page's blocks in order, without those of head, scripts, styles and other raw elements."""
    out: list[Block] = []
    at = Open()
    parts: list[str] = []
    in_link = linked = 0
    place = 0

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                b = Block(at.here, text, min(linked, len(text)))
                at.here.last = len(out)
                out.append(b)
        parts, linked = [], 0

    def add(raw: str) -> None:
        nonlocal linked
        text = entities.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if in_link:
            linked += len(text)

    size, tags = len(page), Tags(page)
    while place < size:
        start, following, name, attributes = tags.next(place)
        if start > place:
            add(page[place:start])
        place = following
        if not name:
            continue
        closing, tag = name[0] == "/", name.lstrip("/").lower()
        if tag in RAW:
            if not closing and not attributes.rstrip().endswith("/"):
                end = _raw_end(tag).search(page, place)
                place = end.end() if end else size
            continue
        if tag == "a":
            in_link = 0 if closing else 1
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in BLOCKS:
            continue
        flush()
        if tag == "hr":
            continue
        in_link = 0 if tag not in HEADINGS and tag != "div" and tag != "p" else in_link
        if closing:
            at.end(tag, ("",) if tag in ("p", "li", "dt", "dd") else ())
            continue
        for of, by in ENDED_BY.items():
            if tag in by and at.here.tag == of:
                at.up()
                break
        if tag in CLOSES_P and at.here.tag == "p":
            at.up()
        if tag in HEADINGS and at.here.tag in HEADINGS:
            at.up()
        if tag == "body" and at.here.tag == "head":
            at.up()
        if tag == "li":
            at.end("li", ("menu",))
        at.start(tag, attributes)
    flush()
    found = [b for b in out if not _in_head(b)]
    for b in found:
        b.at.chars += len(b.text) - b.linked
    title = next((b.at for b in found if b.at.tag == "h1"), None)
    e = title
    while e is not None:
        e.first, e = True, e.up
    for e in reversed(at.all[1:]):
        e.up.chars += e.chars
    for e in at.all:
        e.judge(at.all[0].chars, title is not None)
    return found


def _in_head(b: Block) -> bool:
    return b.at.tag == "head"


FEATURES = ("bias", "strong", "weak", "hidden", "control", "heading", "linked", "length", "sentence")


def describe(b: Block) -> list[float]:
    e, n = b.at, b.text.count(" ") + 1
    return [
        1.0,
        float(e.strong + e.form > 0),
        float(e.weak > 0),
        float(e.hidden),
        float(e.control),
        float(e.tag in HEADINGS),
        b.linked / len(b.text),
        min(1.0, math.log1p(n) / 5),
        float(SENTENCE.search(b.text) is not None),
    ]


PENALTY, ADJACENCY, PROXIMITY, REGION = 0.1, 1.5, 1.5, 2.5
#: What a weak mark costs at most: less than a paragraph's text and an article's pull together.
MOST_WEAK = 2.0
PROSE = "The committee met again on Tuesday to weigh the second proposal, which had drawn letters from most of the region. No vote was taken."
LINE = "Rain fell over the lower valley all night."
SHORT = "Nothing more was said"
#: Labelled snippets: page, and what of its blocks is content (1) or not (0), in order.
EXAMPLES = (
    (f"<nav><ul><li><a href=/>Home</a><li><a href=/news>News</a></ul></nav><article><h1>A plan for the river</h1><p>{PROSE}<p>Yes.<p>{PROSE}</article><footer>&copy; River Times. All rights reserved.</footer>", "00111" + "10"),
    (f"<header><h2>River Times</h2><p>Daily since 1901.</p></header><main><h2>Budget</h2><p>{PROSE}</p><ul><li>First point.<li>Second</ul><blockquote>{PROSE}</blockquote></main><aside><h3>Most read</h3><p>{PROSE}</p><p><a href=/x>More</a></p></aside>", "00" + "11111" + "000"),
    (f"<div class=ad>Buy one, get one free today.</div><div class='post-content'><h1>On maps</h1><p>{PROSE}</p><p>{PROSE}</p><pre>x = 1</pre></div><div class='related'><a href=/1>Old maps</a></div><div id=comments><p>{PROSE}</p><p>Great post!</p></div>", "0" + "1111" + "000"),
    (f"<article><header><h1>Bridges</h1><p>By A. Writer</p></header><p>{PROSE}</p><div class=ad>Sale ends soon. Order now.</div><h2>Later</h2><p>{PROSE}</p><section class=comments><h3>Comments</h3><p>{PROSE}</p></section><footer><a href=/t>Tags</a></footer></article>", "111" + "0" + "11" + "00" + "0"),
    (f"<div class='cookie-notice'><p>We use cookies to improve this site. By staying you agree.</p><button>Accept</button></div><h1>Weather</h1><p>{PROSE}</p><p>{PROSE}</p><form><label>Mail</label><button>Send</button><p>Subscribe to our letter. It is free.</p></form>", "00" + "111" + "000"),
    (f"<div><a href=/a>Start</a></div><div><a href=/b>Archive</a></div><p>{PROSE}</p><p>{PROSE}</p><table><tr><td>{PROSE}</td><td>Rain, wind and snow were measured.</td></tr></table><div>Copyright</div><div><a href=/c>Contact</a></div>", "00" + "1111" + "00"),
    (f"<article><h1>Short</h1><p>No.</p><p>Rain</p><figcaption>The old mill</figcaption><table><tr><td>12</td><td>Mill</td></tr></table><div hidden><p>{PROSE}</p></div><nav><a href=/2>Next</a></nav></article><div class=sidebar><p>{PROSE}</p></div>", "111" + "1" + "11" + "0" + "0" + "0"),
    (f"<main><p><a href=/s>The whole report on the second proposal is here</a></p><p>{PROSE}</p><div>Plain words in a box</div></main><section class=newsletter><p>{PROSE}</p></section><div role=navigation><p>You are here</p></div>", "111" + "0" + "0"),
    (f"<div><a href=/>Menu</a></div><h1>Notes</h1><p>{LINE}</p><p>{SHORT}</p><p>{PROSE}</p><p>12 | 14</p><p>{LINE}</p><div><a href=/m>Sitemap</a></div>", "0" + "111111" + "0"),
    (f"<section><h3>Method</h3><p>{PROSE}</p><div>{LINE}</div><div>{PROSE}</div></section><nav><p>{LINE}</p></nav><footer><p>{PROSE}</p></footer>", "1111" + "0" + "0"),
    (f"<article><h1>{SHORT}</h1><p>{SHORT}</p></article><aside>{LINE}</aside><div class=comments><article><p>{LINE}</p><p>{PROSE}</p></article></div>", "11" + "0" + "00"),
    (f"<article><h2>Wells</h2><p>{PROSE}</p><p style='display: none'>{PROSE}</p><p aria-hidden=true>{LINE}</p></article><div hidden>{PROSE}</div><section hidden><h2>{LINE}</h2><p>{PROSE}</p></section>", "11" + "00" + "0" + "00"),
    (f"<article><h1>Steps</h1><ul><li>Dig a pit <button>Save</button></li><li>Fill it <button>Save</button></li></ul><p>{SHORT}</p><p>{PROSE}</p></article><div><button>More</button></div>", "1" + "10" + "10" + "11" + "0"),
    (f"<div class='site has-sidebar'><div class=site-header><a href=/>River Times</a></div><h1>Mills</h1><p>{LINE}</p><p>{SHORT}</p><p>{PROSE}</p><div class=related-posts><p>{LINE}</p></div><div class='site-footer'><p>{PROSE}</p></div></div>", "0" + "1111" + "00"),
    (f"<article><h1>Wind</h1><p>{PROSE}</p><p>{PROSE}</p><div class=article-share><p>Share</p><p>Print</p></div><div class=post-tags><p>Wind</p></div></article>", "111" + "00" + "0"),
    (f"<article><div class=share><a href=/f>Share</a></div><p>{PROSE}</p><aside><p>{PROSE}</p></aside><form><p>{PROSE}</p><label>Name</label></form></article>", "0" + "1" + "0" + "00"),
)
#: Labelled lines on their own: what pages say around their text without marking it, and text.
AROUND = ("Menu", "Log in", "Share", "Read more", "Subscribe now", "Next page", "Site map", "Contact us", "All rights reserved", "Print this page", "Back to top", "Privacy policy", "Terms of use", "Most popular", "Follow us", "5 comments", "Advertisement", "Skip to content", "Copyright", "Sign up today", "Search", "Previous", "Home", "About the site", "Tags")
TEXT = (PROSE, PROSE, LINE, LINE, LINE + " " + PROSE, "No vote was taken.", "The river rose by two metres in a day, said the mayor.", PROSE + " " + LINE, "They left in June.", LINE + " " + LINE)


@cache
def weights() -> np.ndarray:
    """The classifier, fitted to EXAMPLES by damped Newton steps with an L2 penalty that keeps its log odds moderate.

    It sees a block alone, not whether it lies in an article: that comes from its neighbours, by the cut.
    """
    x, y = [], []
    for page, labels in EXAMPLES:
        found = blocks(page)
        if len(found) != len(labels):
            raise ValueError(f"{len(found)} blocks, {len(labels)} labels: {[b.text for b in found]}")
        x += [describe(b) for b in found]
        y += [int(c) for c in labels]
    page = "".join(f"<div>{line}</div>" for line in AROUND + TEXT)
    x += [describe(b) for b in blocks(page)]
    y += [0] * len(AROUND) + [1] * len(TEXT)
    a, t = np.array(x), np.array(y, float)
    w = np.zeros(a.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-a @ w))
        g = a.T @ (p - t) + PENALTY * w
        h = (a * (p * (1 - p))[:, None]).T @ a + PENALTY * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step / max(1.0, np.abs(step).max() / 2)
    w[FEATURES.index("weak")] = max(w[FEATURES.index("weak")], -MOST_WEAK)
    return w


def tree_distance(a: Element, b: Element) -> int:
    n = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.up
        else:
            b = b.up
        n += 1
    return n


def _title_region(found: list[Block]) -> Element | None:
    """On a page where nothing says that it holds the main text: the innermost element around the first h1 that holds more than it."""
    if any(b.at.region is not None for b in found):
        return None
    e = next((b.at for b in found if b.at.tag == "h1" and not b.at.strong and not b.at.hidden), None)
    own = e.chars if e is not None else 0
    while e is not None and e.chars == own:
        e = e.up
    return e


def _inside(e: Element, of: Element) -> bool:
    while e.depth > of.depth:
        e = e.up
    return e is of


def graph_of(found: list[Block], gain: list[float], adjacency: float = ADJACENCY, proximity: float = PROXIMITY, region: float = REGION) -> tuple[list[float], list[tuple[int, int, float]]]:
    """Gains of the blocks and, after them, of the elements that hold the main text; edges between blocks and to those.

    Without such an element, paragraphs, lists and headings after the first h1, in what is around it, are joined to a node of their own.
    """
    out, gain = [], list(gain)
    for i in range(1, len(found)):
        out.append((i - 1, i, adjacency / (1 + tree_distance(found[i - 1].at, found[i].at))))
    last: dict[int, int] = {}
    nodes: dict[int, int] = {}
    around, begun = _title_region(found), False
    for i, b in enumerate(found):
        up = id(b.at.up)
        if up in last and last[up] != i - 1:
            out.append((last[up], i, proximity / (1 + tree_distance(found[last[up]].at, b.at))))
        last[up] = i
        e = b.at.region
        begun = begun or b.at.tag == "h1"
        if e is None and around is not None and begun and b.at.tag in TEXT_TAGS and _inside(b.at, around):
            e = around
        if e is not None and not (b.at.strong or b.at.form or b.at.hidden or b.at.control):  # what is marked against being text isn't drawn in
            if id(e) not in nodes:
                nodes[id(e)] = len(gain)
                gain.append(2 * region)
            gain[nodes[id(e)]] += region  # so that its blocks can't outvote it by their number
            out.append((nodes[id(e)], i, region))
    return gain, out


def minimum_cut(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source's side, for terminal capacities of difference gain and undirected edges.

    A node whose gain outweighs all of its edges is on its own side in every minimum cut, so it is fixed and its edges
    are added to its neighbours' gains. What is left is cut by shortest augmenting paths.
    """
    n = len(gain)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    pull, side = list(gain), [None] * n
    tied = [sum(x.values()) for x in near]
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if side[i] is None and abs(pull[i]) >= tied[i] - 1e-12:
            side[i] = pull[i] > 0
            for j, w in near[i].items():
                pull[j] += w if side[i] else -w
                tied[j] -= w
                del near[j][i]
                queue.append(j)
            near[i], tied[i] = {}, 0.0
    rest = [i for i in range(n) if side[i] is None]
    if not rest:
        return side
    # residual capacities; terminals are n (source) and n + 1 (sink)
    left: dict[int, dict[int, float]] = {i: dict(near[i]) for i in rest}
    left[n], left[n + 1] = {}, {}
    for i in rest:
        if pull[i] > 0:
            left[n][i] = pull[i]
            left[i][n] = 0.0
        else:
            left[i][n + 1] = -pull[i]
            left[n + 1][i] = 0.0
    while True:
        level, queue = {n: 0}, deque([n])
        while queue:
            i = queue.popleft()
            for j, c in left[i].items():
                if c > 1e-12 and j not in level:
                    level[j] = level[i] + 1
                    queue.append(j)
        if n + 1 not in level:
            break
        # a blocking flow along levels, without recursion
        todo = {i: list(left[i]) for i in level}
        path = [n]
        while path:
            i = path[-1]
            if i == n + 1:
                flow = min(left[a][b] for a, b in zip(path, path[1:], strict=False))
                for a, b in zip(path, path[1:], strict=False):
                    left[a][b] -= flow
                    left[b][a] = left[b].get(a, 0.0) + flow
                cut = next(k for k, (a, b) in enumerate(zip(path, path[1:], strict=False)) if left[a][b] <= 1e-12)
                del path[cut + 1 :]
                continue
            while todo[i]:
                j = todo[i][-1]
                if left[i].get(j, 0.0) > 1e-12 and level.get(j) == level[i] + 1:
                    path.append(j)
                    break
                todo[i].pop()
            else:
                path.pop()
                if path:
                    todo[path[-1]].pop()
    for i in rest:
        side[i] = i in level
    return side


def extract(page: str, w: np.ndarray | None = None) -> str:
    """The main text: content blocks in page order, joined by newlines; empty if there are none."""
    found = blocks(page)
    if not found:
        return ""
    w = weights() if w is None else w
    gain = (np.array([describe(b) for b in found]) @ w).tolist()
    content = minimum_cut(*graph_of(found, gain))
    return "\n".join(b.text for b, c in zip(found, content, strict=False) if c)


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: id, url, text and n_chars (code points) of the page's main text.

    Null html is empty and gives an empty text; a null url stays null. Repeated rows each give a row; further columns are ignored;
    an empty table gives an empty result. Bytes that aren't UTF-8 become U+FFFD. Pages of any length are done whole.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.make_valid_utf8(F.col(html_col).cast("string")), F.lit("")).alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    w = weights()

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [extract(t, w) for t in batch.column(2).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())], names=["page_id", "url", "text", "n_chars"])

        return run

    return map_arrow(rows, make, f"page_id {kind}, url string, text string, n_chars long")
