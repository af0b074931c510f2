"""Operator 11: the main text of web pages by tag-path ratios.

1. A page is read once into text blocks.  Block elements and the ends of paragraphs part blocks; inline
   elements do not.  A block has the path of tags (with class names, digits blanked) from the root to the
   element it stands in; equal paths of a page are one path.  Scripts, styles, heads, form controls and
   comments are not text.  Paths through menus, headers, footers, sidebars, notices, adverts, forms and
   reader comments, told by tag, ``role`` or whole words of ``class`` and ``id``, are struck out.
2. Per path: characters, punctuation marks, link characters and blocks.  Text ratio (characters
   outside links a block) and punctuation ratio (marks a block) are fused, ``log(1 + text) * (1 + log(1 + marks))``.
3. The fused values are smoothed over neighbouring paths, those with the same parent, by characters.
4. Content paths have at least ``THRESHOLD`` of the page's mean (by characters).  Their mass, smoothed value
   times characters, chooses the content node: the heaviest element marked as an article; else the heaviest
   marked as main part; else one goes down from the root while a child holds ``HEAVY`` of the mass.
5. A marked article gives all its blocks that are not struck out; other nodes the blocks on content
   paths.  Lists of nothing but links go.  A single ``h1`` outside the node comes first.

Tags are read as browsers do as far as blocks need it: quoted attributes, elements closed by the next
one of their kind, raw text up to its end tag, a tag cut off by the end of the page dropped.  Time and memory are linear
in the page (paths are kept as a tree of names, not as strings).

Cases: null and empty pages give an empty text of 0 characters; so do pages without content; repeated rows
give repeated results; null ``page_id`` and ``url`` are kept; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import blocks

THRESHOLD, HEAVY = 0.5, 0.6

_TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)
    |<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|["'=])*+)(?P<end>>|\Z)""",
                    re.S | re.X)
_ATTR = re.compile(r"""([^\s"'>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_PUNCTUATION = re.compile(r"[.,;:!?…、。，！？]")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_DIGITS = re.compile(r"\d+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter nobr output
    progress q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr""".split())
# elements whose text is never content
NO_TEXT = frozenset("""head script style template noscript iframe object svg canvas audio video textarea title select
    button xmp noembed noframes datalist map""".split())
BOILER_TAGS = frozenset("nav footer aside form menu dialog".split())
BOILER_ROLES = frozenset("""navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar
    toolbar tablist""".split())
BOILER_WORDS = frozenset("""ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored
    sponsors promo promos promotion promoted banner banners cookie cookies consent gdpr notice notices alert popup modal overlay
    nav navbar navigation menu menus menubar breadcrumb breadcrumbs header masthead topbar footer sidebar sidebars rail
    widget widgets related recommended recommendations share sharing social comment comments commentlist commenters
    disqus replies reply respond responses newsletter subscribe subscription signup login search pagination pager
    toolbar skip copyright""".split())
CONTENT_WORDS = frozenset("article post entry story content main".split())
NOT_PLACES = frozenset("has have with without no is".split())     # "has-sidebar" says nothing about the element
ARTICLE_NAMES = frozenset("""article articlebody articlecontent articletext postbody postcontent posttext entrycontent
    entrybody storybody storycontent""".split())
MAIN_NAMES = frozenset("main maincontent content contentmain pagecontent post entry story".split())
# a start tag closes these open elements, up to the nearest of the second list
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "option": ({"option"}, {"select"}), "body": ({"head"}, set())}
_CLOSES_P = frozenset("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul""".split())
_P_SCOPE = frozenset("html body table td th caption button object template article section div".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


class _Node:
    """An open element: its tag, path, and the marks it passes on to what stands in it."""
    __slots__ = ("tag", "path", "up", "gone", "mute", "linked", "article", "heading", "number", "kind", "home")


class _Path:
    """A path of the page; ``text`` to ``blocks`` count what stands at its end."""
    __slots__ = ("up", "children", "text", "marks", "links", "blocks", "value")

    def __init__(self, up):
        self.up, self.children = up, {}
        self.text = self.marks = self.links = self.blocks = 0
        self.value = 0.0


def _marks(tag: str, attrs: str) -> tuple[str, bool, str]:
    """Label for the path, whether the element is struck out, and "article", "main" or ""."""
    names, roles, kind = [], (), "article" if tag == "article" else "main" if tag == "main" else ""
    label = tag
    if attrs and "=" in attrs:
        for m in _ATTR.finditer(attrs):
            key = m[1].lower()
            value = unescape(m[2] or m[3] or m[4] or "")
            if key in ("class", "id"):
                names += value.split()
                if key == "class":
                    label += "." + _DIGITS.sub("#", value)
            elif key == "role":
                roles = value.lower().split()
            elif key == "itemprop" and value.lower() == "articlebody":
                kind = "article"
    if tag in ("html", "body"):
        return label, False, ""
    gone = tag in BOILER_TAGS or any(r in BOILER_ROLES for r in roles)
    for name in names:
        words = [w.lower() for w in _NAME.findall(name)]
        own = CONTENT_WORDS.intersection(words)
        for before, word in zip([""] + words, words):
            if word in BOILER_WORDS and before not in NOT_PLACES and not (own and word == "header"):
                gone = True
        whole = "".join(words)
        if whole in ARTICLE_NAMES:
            kind = "article"
        elif whole in MAIN_NAMES and not kind:
            kind = "main"
    if "article" in roles:
        kind = "article"
    elif "main" in roles and not kind:
        kind = "main"
    return label, gone, kind


class Page:
    """The blocks of a page: ``blocks`` of (text, path, node), in page order, struck-out ones left out."""

    def __init__(self, html: str):
        root = _Node()
        root.tag, root.path, root.up, root.kind = "", _Path(None), None, ""
        root.gone = root.mute = root.linked = root.article = root.heading = False
        root.number, root.home = 0, root
        self.root = root.path
        self.stack, self.open_tags = [root], {}
        self.nodes = [root]
        self.blocks: list[tuple[str, _Path, _Node, bool]] = []
        self.pieces: list[str] = []
        self.links = 0
        self._read(html)
        self._end_block()

    def _end_block(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                node = self.stack[-1].home            # the block element that the text stands in
                path = node.path
                path.text += len(text)
                path.links += min(self.links, len(text))
                path.marks += len(_PUNCTUATION.findall(text))
                path.blocks += 1
                self.blocks.append((text, path, node, self.links >= 0.9 * len(text)))
            self.pieces = []
        self.links = 0

    def _text(self, raw: str) -> None:
        top = self.stack[-1]
        if top.gone or top.mute:
            return
        text = unescape(raw) if "&" in raw else raw
        self.pieces.append(text)
        if top.linked:
            self.links += len(text.strip())

    def _push(self, tag: str, attrs: str) -> None:
        top = self.stack[-1]
        label, gone, kind = _marks(tag, attrs)
        if tag == "header":
            gone = gone or not top.article
        node = _Node()
        node.tag, node.up, node.kind = tag, top, kind
        if tag in INLINE:
            node.path, node.home = top.path, top.home
        else:
            node.home = node
            node.path = top.path.children.get(label)
            if node.path is None:
                node.path = top.path.children[label] = _Path(top.path)
        node.gone = top.gone or gone
        node.mute = top.mute or tag in NO_TEXT
        node.linked = top.linked or tag == "a"
        node.article = top.article or (kind == "article" and not node.gone)
        node.heading = top.heading or tag in _HEADINGS
        node.number = len(self.nodes)
        self.nodes.append(node)
        self.stack.append(node)
        self.open_tags[tag] = self.open_tags.get(tag, 0) + 1

    def _pop_to(self, place: int) -> None:
        for node in self.stack[place:]:
            self.open_tags[node.tag] -= 1
        del self.stack[place:]

    def _close(self, tags, scope) -> None:
        """Close the innermost open element of ``tags`` unless one of ``scope`` stands inside it."""
        if not any(self.open_tags.get(t) for t in tags):
            return
        for place in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[place].tag
            if tag in tags:
                self._pop_to(place)
                return
            if tag in scope:
                return

    def _start(self, tag: str, attrs: str) -> None:
        if tag == "br":
            self._text(" ")
            return
        block = tag not in INLINE
        if block:
            self._end_block()
        if tag in _CLOSES_P:
            self._close(("p",), _P_SCOPE)
        if tag in _CLOSES:
            self._close(*_CLOSES[tag])
        elif tag not in NO_TEXT and tag not in ("html", "base", "link", "meta"):
            self._close(("head",), ())
        if tag in _HEADINGS and self.stack[-1].tag in _HEADINGS:
            self._pop_to(len(self.stack) - 1)
        if tag not in VOID:
            self._push(tag, attrs)

    def _end(self, tag: str) -> None:
        if tag in ("body", "html", "br"):
            if tag == "br":
                self._text(" ")
            return
        inline = tag in INLINE
        if not inline:
            self._end_block()
        if not self.open_tags.get(tag):
            return
        for place in range(len(self.stack) - 1, 0, -1):
            own = self.stack[place].tag
            if own == tag:
                self._pop_to(place)
                return
            if inline and own not in INLINE:          # it was opened outside this block
                return

    def _read(self, html: str) -> None:
        at, n = 0, len(html)
        while at < n:
            m = _TOKEN.search(html, at)
            if m is None:
                self._text(html[at:])
                return
            if m.start() > at:
                self._text(html[at:m.start()])
            at = m.end()
            tag = m["tag"]
            if tag is None:
                continue
            if not m["end"]:                          # cut off by the end of the page
                return
            tag = tag.lower()
            if m["close"]:
                self._end(tag)
                continue
            self._start(tag, m["attrs"])
            if tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
                if close is None:
                    return
                at = close.start()


def _score(page: Page) -> None:
    """Fused ratios of all paths, smoothed over those with the same parent."""
    stack = [page.root]
    while stack:
        path = stack.pop()
        children = list(path.children.values())
        stack += children
        own = []
        for p in children:
            if p.blocks:
                value = math.log1p((p.text - p.links) / p.blocks) * (1 + math.log1p(p.marks / p.blocks))
                own.append((p, value))
        total = sum(p.text for p, _ in own)
        mean = sum(v * p.text for p, v in own) / total if total else 0.0
        for p, value in own:
            p.value = (value + mean) / 2
    root = page.root
    if root.blocks:
        root.value = math.log1p((root.text - root.links) / root.blocks) * (1 + math.log1p(root.marks / root.blocks))


def _content_node(page: Page, wanted: set) -> _Node:
    """The node that the mass of the content paths points to."""
    mass = [0.0] * len(page.nodes)
    for text, path, node, _ in page.blocks:
        weight = path.value * len(text) if path in wanted else 0.0
        mass[node.number] += weight + 1e-9 * len(text)
    for node in reversed(page.nodes[1:]):             # children come after their parents
        mass[node.up.number] += mass[node.number]
    for kind in ("article", "main"):
        marked = [x for x in page.nodes if x.kind == kind and not x.gone and mass[x.number]]
        if marked:
            best = max(marked, key=lambda x: (mass[x.number], -x.number))
            return best
    children: dict[int, list[_Node]] = {}
    for node in page.nodes[1:]:
        if mass[node.number]:
            children.setdefault(node.up.number, []).append(node)
    node = page.nodes[0]
    while True:
        below = max(children.get(node.number, []), key=lambda x: mass[x.number], default=None)
        if below is None or below.tag in INLINE or below.tag == "p" or mass[below.number] < HEAVY * mass[node.number]:
            return node
        node = below


def _inside(page: Page, top: _Node) -> list[bool]:
    held = [False] * len(page.nodes)
    held[top.number] = True
    for node in page.nodes[top.number + 1:]:
        held[node.number] = held[node.up.number]
    return held


def main_text(html: str) -> str:
    """The blocks of the page's article, one a line."""
    page = Page(html)
    if not page.blocks:
        return ""
    _score(page)
    paths = {id(p): p for _, p, _, _ in page.blocks}.values()
    total = sum(p.text for p in paths)
    least = THRESHOLD * sum(p.value * p.text for p in paths) / total
    wanted = {p for p in paths if p.value >= least}
    top = _content_node(page, wanted)
    held = _inside(page, top)
    # lists of nothing but links
    listed: dict[int, list[bool]] = {}
    for _, _, node, link in page.blocks:
        if node.tag in ("li", "dd", "dt") and node.up.tag in ("ul", "ol", "dl", "menu"):
            listed.setdefault(node.up.number, []).append(link)
    menus = {k for k, links in listed.items() if len(links) > 2 and all(links)}
    out = []
    heads = [(text, node) for text, _, node, _ in page.blocks if node.tag == "h1"]
    if len(heads) == 1 and not held[heads[0][1].number] and heads[0][1].number < top.number:
        out.append(heads[0][0])
    for text, path, node, _ in page.blocks:
        if not held[node.number] or node.up is not None and node.up.number in menus and node.tag in ("li", "dd", "dt"):
            continue
        if top.kind == "article" or path in wanted or node.heading:
            out.append(text)
    return "\n".join(out)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "html"):
            texts = [main_text(h) if h else "" for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = dict(pages.dtypes)
    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return own.mapInArrow(run, f"page_id {kind[id_col]}, url {kind[url_col]}, text string, n_chars bigint")
