"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree of its block elements, with its text blocks as leaves. Every node has a hidden
state: main content, a wrapper around it, or other. The model has

* a unary potential per node: the node's features (tag, class and id words; for text blocks their share
  of links) given its state, and
* a potential per edge: the child's state given its parent's, apart for elements and text blocks.

Both are smoothed counts over labelled pages, summed by key in Spark; features are hashed into
``BUCKETS`` numbers, so the trained tables have a fixed size. Sum-product message passing, once upward
and once downward, gives the exact marginal of every node; text blocks whose marginal of being content
passes one half are the main text.

Training rows are pages with their main text. Where no such rows are given, ``labelled_sample`` takes a
bounded sample of pages that mark their article with an article or main element, and ``TEMPLATES``
adds hand-labelled layouts for parts that such pages may lack (sidebars, notices, forms, comments).

Defined results: null and empty html gives the empty text; broken markup is read as far as it goes
(unclosed elements, comments and quotes included); a head without an end tag ends where something
stands that no head may hold; "/>" closes svg, math and the elements in them; pages of any length are read whole; repeated rows
give repeated rows. Other columns are ignored. Without any training page all potentials are even.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache
from math import exp
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.words import map_arrow

BUCKETS = 4096
SAMPLE_PAGES = 2000
SMOOTH = 0.5
TEMPLATE_SHARE = 0.25

# Element groups of the HTML standard.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html label legend li main "
    "menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body button caption html label legend tbody td tfoot th thead tr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
UNSEEN = frozenset("canvas datalist head noscript object select svg template".split())
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
FOREIGN = frozenset("math svg".split())
SPACE = " \t\n\f\r"
# An opening tag ends these open elements, up to the given container.
IMPLIED_END = {
    "li": (("li",), ("ol", "ul", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)),
    "thead": (("tbody", "thead", "tfoot"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot"), ("table",)),
    "body": (("head",), ("template",)),
}
P_SCOPE = frozenset("button caption html object table td th".split())

TOKEN = re.compile(
    r"<!--(?:>|->|.*?-->|.*\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>"
    r"|<[!?/][^>]*+>",
    re.DOTALL,
)
CUT_TAG = re.compile(r"<[a-zA-Z/!?]")
NAMES = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Page:
    """Tree of a page: parallel lists over nodes, parents before children."""

    __slots__ = ("parent", "tag", "names", "text", "linked")

    def __init__(self):
        self.parent: list[int] = []
        self.tag: list[str] = []
        self.names: list[tuple[str, ...]] = []
        self.text: list[str | None] = []  # of text blocks
        self.linked: list[int] = []  # characters inside links, of text blocks

    def add(self, parent: int, tag: str, names=(), text=None, linked=0) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.names.append(names)
        self.text.append(text)
        self.linked.append(linked)
        return len(self.parent) - 1


@lru_cache(maxsize=4096)
def _names(attributes: str) -> tuple[str, ...]:
    found = (a or b or c for a, b, c in NAMES.findall(attributes))
    return tuple(dict.fromkeys(w.lower() for value in found for w in NAME_PART.findall(value)))


def parse(source: str) -> Page:
    """Tree of block elements and text blocks of a page."""
    page = Page()
    stack: list[tuple[str, int, bool]] = [("", page.add(-1, "#page"), False)]  # tag, node, in a link
    pieces: list[str] = []
    linked = unseen = 0

    def close_block() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            page.add(stack[-1][1], "#text", (), text, min(linked, len(text)))
        pieces.clear()
        linked = 0

    def pop_to(depth: int) -> None:
        nonlocal unseen
        if any(stack[i][0] in BLOCK for i in range(depth, len(stack))):
            close_block()
        for tag, _, _ in stack[depth:]:
            unseen -= tag in UNSEEN
        del stack[depth:]

    def end_implied(tags, stop) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in stop:
                return
            if stack[depth][0] in tags:
                pop_to(depth)
                return

    def put(text: str) -> None:
        nonlocal linked
        if stack[-1][0] == "head" and text.strip(SPACE):
            pop_to(len(stack) - 1)
        if text and not unseen:
            text = html.unescape(text) if "&" in text else text
            pieces.append(text)
            if stack[-1][2]:
                linked += len(text)

    # no tag ends behind the last ">", so a tag that is cut off there is dropped
    at, search, size, last = 0, TOKEN.search, len(source), source.rfind(">") + 1
    while at < size:
        found = search(source, at, last) if at < last else None
        if found is None:
            cut = CUT_TAG.search(source, max(at, last))
            put(source[at:cut.start() if cut else size])
            break
        begin, end = found.span()
        if begin > at:
            put(source[at:begin])
        at = end
        if source.startswith("<!--", begin) and not source.endswith("-->", begin, end):
            break
        closing, name, attributes, closing2, name2, attributes2 = found.groups()
        tag = (name or name2 or "").lower()
        if not tag:
            continue
        if closing or closing2:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    pop_to(depth)
                    break
            continue
        attributes = attributes if name else attributes2
        if stack[-1][0] == "head" and tag not in IN_HEAD:
            pop_to(len(stack) - 1)
        if attributes.endswith("/") and tag not in VOID:
            if tag in FOREIGN or any(t in FOREIGN for t, _, _ in stack):
                continue
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(source, at)
            at = close.end() if close else size
            continue
        if tag == "br":
            put(" ")
        if tag == "hr":
            close_block()
        if tag in VOID:
            continue
        if tag in CLOSES_P:
            end_implied(("p",), P_SCOPE)
        if tag in IMPLIED_END:
            end_implied(*IMPLIED_END[tag])
        in_link = stack[-1][2] or tag == "a"
        node = stack[-1][1]
        if tag in BLOCK:
            close_block()
            node = page.add(node, tag, _names(attributes) if "=" in attributes else ())
        unseen += tag in UNSEEN
        stack.append((tag, node, in_link))
    close_block()
    return page


@lru_cache(maxsize=1 << 16)
def _bucket(feature: str) -> int:
    return crc32(feature.encode()) % BUCKETS


def _features(page: Page, i: int) -> list[int]:
    """Hashed features of a node."""
    text = page.text[i]
    if text is None:
        return [_bucket("tag " + page.tag[i]), *[_bucket("name " + n) for n in page.names[i]]]
    share = 3 * page.linked[i] // len(text)
    return [_bucket(f"links {share}")]


WRAPPER, CONTENT, OTHER = range(3)


def label(page: Page, main: str) -> list[int]:
    """States of a labelled page's nodes: a text block is content if it is a line of the main text.

    Lines count in order, so a repeated line elsewhere stays out. The deepest element around all
    content is content, as are the elements in it with more content than other text; the
    elements around it are wrappers.
    """
    lines = [" ".join(x.split()) for x in main.split("\n")]
    state = [OTHER] * len(page.parent)
    blocks = [i for i, t in enumerate(page.text) if t is not None]
    texts = [page.text[i] for i in blocks]
    # the run of blocks that equals the lines, else any block that is a line
    n = len(lines)
    run = next((k for k in range(len(texts) - n + 1) if texts[k:k + n] == lines), None)
    chosen = blocks[run:run + n] if run is not None else [i for i in blocks if page.text[i] in set(lines)]
    for i in chosen:
        state[i] = CONTENT
    some, other = [0] * len(state), [0] * len(state)
    for i in range(len(state) - 1, -1, -1):
        if page.text[i] is not None:
            (some if state[i] == CONTENT else other)[i] = len(page.text[i])
        if page.parent[i] >= 0:
            some[page.parent[i]] += some[i]
            other[page.parent[i]] += other[i]
    if not some[0]:
        return state
    top = max(i for i, t in enumerate(page.text) if t is None and some[i] == some[0])
    inside = [i == top for i in range(len(state))]
    for i in range(len(state)):
        inside[i] = inside[i] or (i > 0 and inside[page.parent[i]])
        if page.text[i] is None and some[i]:
            if not inside[i]:
                state[i] = WRAPPER
            elif some[i] > other[i] or i == top:
                state[i] = CONTENT
    return state


# Counts are kept in one array: [state, bucket] features, then [is text, parent, child] edges.
EDGES = 3 * BUCKETS
SIZE = EDGES + 18


def count(page: Page, state: list[int], into: np.ndarray, weight: int = 1) -> None:
    """Add a labelled page's features and edges to the counts."""
    for i, s in enumerate(state):
        for f in _features(page, i):
            into[s * BUCKETS + f] += weight
        if page.parent[i] >= 0:
            into[EDGES + 9 * (page.text[i] is not None) + 3 * state[page.parent[i]] + s] += weight


class Model:
    """Potentials from counts, and the marginals of pages."""

    def __init__(self, counts: np.ndarray):
        features = counts[:EDGES].reshape(3, BUCKETS).astype(float) + SMOOTH
        logs = np.log(features / features.sum(axis=1, keepdims=True))
        self.unary = [tuple(x) for x in (logs - logs.max(axis=0)).T.tolist()]
        edges = counts[EDGES:].reshape(2, 3, 3).astype(float) + SMOOTH
        self.edge = (edges / edges.sum(axis=2, keepdims=True)).reshape(2, 9).tolist()

    def marginals(self, page: Page) -> list[float]:
        """Probability that each node is main content, by sum-product over the tree."""
        n, parent, text, unary, edge = len(page.parent), page.parent, page.text, self.unary, self.edge
        belief = []
        for i in range(n):
            w = c = o = 0.0
            for f in _features(page, i):
                x = unary[f]
                w, c, o = w + x[0], c + x[1], o + x[2]
            top = max(w, c, o)
            belief.append((exp(w - top), exp(c - top), exp(o - top)))
        message = [(1.0, 1.0, 1.0)] * n
        for i in range(n - 1, 0, -1):  # upward, children before parents
            w, c, o = belief[i]
            e = edge[text[i] is not None]
            a = e[0] * w + e[1] * c + e[2] * o
            b = e[3] * w + e[4] * c + e[5] * o
            d = e[6] * w + e[7] * c + e[8] * o
            message[i] = (a, b, d)
            w, c, o = belief[parent[i]]
            w, c, o = w * a, c * b, o * d
            scale = 1.0 / (w + c + o)
            belief[parent[i]] = (w * scale, c * scale, o * scale)
        for i in range(1, n):  # downward: the parent's belief without what came from the child
            e, (a, b, d) = edge[text[i] is not None], message[i]
            w, c, o = belief[parent[i]]
            w, c, o = w / a, c / b, o / d
            a, b, d = belief[i]
            a *= e[0] * w + e[3] * c + e[6] * o
            b *= e[1] * w + e[4] * c + e[7] * o
            d *= e[2] * w + e[5] * c + e[8] * o
            scale = 1.0 / (a + b + d)
            belief[i] = (a * scale, b * scale, d * scale)
        return [b[CONTENT] for b in belief]

    def main_text(self, source: str) -> str:
        page = parse(source)
        belief = self.marginals(page)
        return "\n".join(t for t, p in zip(page.text, belief) if t is not None and p > 0.5)


# Hand-labelled layouts: (html, main text).
TEMPLATES = (
    ("<body><header class='masthead'><a href='/'>Site</a></header><nav class='menu'><a href='/a'>One</a>"
     "<a href='/b'>Two</a></nav><main><article><header><h1>A title</h1></header><p>First text of the "
     "story.</p><h2>A part</h2><p>Second text, with more words in it.</p><ul><li>An item.</li></ul>"
     "<blockquote><p>Quoted words.</p></blockquote><table><tr><td>A cell</td></tr></table><figure>"
     "<figcaption>What is shown</figcaption></figure><pre>code</pre></article></main><aside class='sidebar'><h3>"
     "More</h3><ul><li><a href='/c'>Another story</a></li></ul></aside><footer><p>Terms</p></footer></body>",
     "A title\nFirst text of the story.\nA part\nSecond text, with more words in it.\nAn item.\nQuoted "
     "words.\nA cell\nWhat is shown\ncode"),
    ("<body><div id='header'><div class='logo'>Site</div></div><div id='nav'><ul><li><a href='/'>Home</a></li>"
     "</ul></div><div id='content' class='post entry'><h1>Title</h1><p>Some text here.</p><p>More of it "
     "follows, in a longer line.</p></div><div id='sidebar' class='widget'><h4>Popular</h4><p>Read this "
     "next.</p></div><div id='comments' class='comment list'><h3>Comments</h3><div class='comment'><p>I do "
     "not agree with this at all.</p></div></div><div id='footer'><p>All rights reserved.</p></div></body>",
     "Title\nSome text here.\nMore of it follows, in a longer line."),
    ("<body><div class='cookie notice banner consent'><p>We use cookies.</p><button>Accept</button></div>"
     "<div class='ad advert'>Buy now!</div><div class='main article body'><h1>Title</h1><p>The text "
     "begins.</p><div class='advertisement sponsored promo'><p>Our partner offers this.</p></div><p>The "
     "text goes on.</p><div class='share social'><a href='/s'>Share</a></div></div><form class='newsletter "
     "subscribe signup'><label>Mail</label><p>Get our letter.</p><button>Send</button></form><section "
     "class='related recommended'><h2>Related</h2><a href='/r'>Other</a></section></body>",
     "Title\nThe text begins.\nThe text goes on."),
    ("<body><article><h1>Title</h1><p>Words of the article.</p><p>The last words.</p><aside><p>See also this."
     "</p></aside><section class='comments' id='comments'><h2>Replies</h2><ol><li><p>A reader says so."
     "</p></li><li><p>Another reader says no.</p></li></ol></section><footer><p>Filed under news</p></footer>"
     "<form><label>Your reply</label><button>Post</button></form></article></body>",
     "Title\nWords of the article.\nThe last words."),
    ("<body><div class='breadcrumb breadcrumbs'><a href='/'>Home</a></div><div class='alert notice warning'><p>"
     "Service is down today.</p></div><article class='story'><p>Only text.</p><div class='text content'><p>"
     "Further text stands here.</p></div><nav class='pagination pager'><a href='/2'>Next</a></nav><div "
     "class='author bio'><p>Someone writes here.</p></div></article><div class='popup modal login'><p>Please "
     "log in.</p></div><div class='search'><p>Search here</p></div><section class='reviews responses "
     "discussion'><p>I liked it.</p></section></body>",
     "Only text.\nFurther text stands here."),
    ("<body><nav><ul><li><a href='/a'>One</a></li></ul></nav><article><h1>Steps</h1><p>What is needed:</p><ul>"
     "<li>Some flour</li><li>Two eggs, and milk.</li><li><p>A little salt.</p></li></ul><ol><li>Mix it all.</li>"
     "<li>Wait for an <a href='/h'>hour</a>, then bake.</li></ol><dl><dt>Time</dt><dd>One hour</dd></dl></article>"
     "<footer><ul><li><a href='/t'>Terms</a></li></ul></footer></body>",
     "Steps\nWhat is needed:\nSome flour\nTwo eggs, and milk.\nA little salt.\nMix it all.\nWait for an hour, "
     "then bake.\nTime\nOne hour"),
    ("<body><main><h1>Title</h1><p>The opening words.</p><aside class='box'><h3>Also</h3><p>A side remark, set "
     "apart.</p></aside><p>The closing words.</p></main><aside><p>About us</p><p>We are a paper.</p></aside></body>",
     "Title\nThe opening words.\nThe closing words."),
    # a page is mostly its article
    ("<body><nav><a href='/'>Home</a></nav><article><h1>A long read</h1>"
     + "".join(f"<p>Paragraph {i} of the story.</p>" for i in range(40)) + "</article><footer>(c)</footer></body>",
     "\n".join(["A long read", *[f"Paragraph {i} of the story." for i in range(40)]])),
)
MARKED = re.compile(r"<(?:article|main)\b", re.I)
OUTSIDE = frozenset("nav aside footer form button label fieldset menu dialog search".split())
OUTSIDE_NAMES = frozenset(
    "ad ads advert advertisement sponsored promo comment comments sidebar menu footer notice cookie "
    "banner related share social newsletter subscribe breadcrumb breadcrumbs pagination".split()
)


def marked_text(source: str) -> str | None:
    """Main text as the markup itself tells it: the text of one article or main element.

    None if the page marks none or several; parts that are named otherwise inside are left out.
    """
    page = parse(source)
    marked = [i for i, t in enumerate(page.tag) if t == "article"]
    marked = marked or [i for i, t in enumerate(page.tag) if t == "main"]
    if len(marked) != 1:
        return None
    inside, lines = [False] * len(page.parent), []
    for i in range(1, len(page.parent)):
        named = page.tag[i] in OUTSIDE or not OUTSIDE_NAMES.isdisjoint(page.names[i])
        inside[i] = i == marked[0] or (inside[page.parent[i]] and not named)
        if inside[i] and page.text[i] is not None:
            lines.append(page.text[i])
    return "\n".join(lines)


def labelled_sample(pages: DataFrame, html_col: str, rows: int = SAMPLE_PAGES) -> DataFrame:
    """(html, main) of about ``rows`` pages that mark their article, chosen by a hash of the page.

    ``main`` is null where ``marked_text`` finds no label; such pages do not train.
    """
    source = pages.select(F.col(html_col).alias("html"))
    n = pages.count()
    share = min(1.0, rows / n) if n else 1.0
    chosen = source.where(F.pmod(F.xxhash64("html"), F.lit(1_000_003)) < int(share * 1_000_003))

    def mark(batch: pa.RecordBatch):
        texts = batch.column("html")
        main = [marked_text(t) if t else None for t in texts.to_pylist()]
        yield pa.RecordBatch.from_arrays([texts, pa.array(main, pa.string())], names=["html", "main"])

    return map_arrow(chosen, mark, "html string, main string")


def train(labelled: DataFrame) -> Model:
    """Model from (html, main) rows and the templates, each of which counts as a share of the rows."""

    def over(batches):
        counts = np.zeros(SIZE + 1, dtype=np.int64)  # the last one counts pages
        for batch in batches:
            for source, main in zip(*(batch.column(c).to_pylist() for c in ("html", "main"))):
                if source and main is not None:
                    page = parse(source)
                    count(page, label(page, main), counts)
                    counts[-1] += 1
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["at", "n"])

    found = labelled.select("html", "main").mapInArrow(over, "at long, n long")
    counts = np.zeros(SIZE + 1, dtype=np.int64)
    for row in found.groupBy("at").agg(F.sum("n").alias("n")).collect():  # at most SIZE + 1 rows
        counts[row.at] = row.n
    weight = max(1, round(TEMPLATE_SHARE * counts[-1]))
    for source, main in TEMPLATES:
        page = parse(source)
        count(page, label(page, main), counts, weight)
    return Model(counts[:-1])


def extract(
    pages: DataFrame, model: Model, keys: tuple[str, ...] = ("page_id", "url"), html_col: str = "html",
) -> DataFrame:
    """(keys, text) of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(model)
    names = [f"key{i}" for i in range(len(keys))]
    rows = pages.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)],
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    )

    def over(batch: pa.RecordBatch):
        main_text = shared.value.main_text
        texts = [main_text(s) for s in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in names], pa.array(texts, pa.string())], names=[*names, "text"]
        )

    kinds = [f"{n} {rows.schema[n].dataType.simpleString()}" for n in names]
    out = map_arrow(rows, over, ", ".join([*kinds, "text string"]))
    return out.select(*[F.col(n).alias(k) for k, n in zip(keys, names)], "text")


def main_texts(pages: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """(page_id, url, text) of every page; trained on ``labelled`` (html, main) or on marked pages."""
    rows = labelled if labelled is not None else labelled_sample(pages, "html")
    return extract(pages, train(rows))
