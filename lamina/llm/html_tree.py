"""Main text of web pages by site style trees.

The pages of a host are merged into one tree of style nodes: elements with the same path of
tags, classes and ids are one node. A node's importance has two parts, both entropies over
the host's pages: how varied the styles below its parent are, and how varied its content
is; a node whose text repeats from page to page, or that consists of links, says little.
A host with few pages says little about its nodes, so the importance leans toward that of
the same style on all hosts, the more the fewer pages have it; there is no least number.
Branches of low importance are removed from each page.

Two things are known without a tree. Elements that cannot hold an article (scripts, forms,
menus, footers and so on), and those whose names say what they are, are removed before.
Where a page marks an article, only that is taken, and of several the one that the page is
about: the longest. Inside it a name counts only if it says nothing else and can mean no
part of an article (`commentList` goes, `share-price` and the `menu` of a restaurant stay),
and the tree removes only nodes that are mostly links: what repeats inside an article, such
as its headings, stays.

Pages need `page_id`, `url` and `html`. A null or empty html has no text. A node that holds
most of what is left of a page is never removed. Equal importance is treated alike, and
columns of other names are left out. Rows are kept as they are, also repeated ones and null
ids; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.sources import stored

#: Pages that the importance of a style on all hosts weighs as.
PRIOR_PAGES = 8.0
IMPORTANCE = 0.25
DAMPING = 0.9
#: A node with at least this share of a page's text is its main text.
MAIN_SHARE = 0.5
ROWS = 256

# Elements by how they are laid out or what they hold.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title iframe noscript noembed xmp".split())
BLOCK = frozenset(
    """address article aside blockquote body br center caption dd details dialog dir div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend
    li main menu nav ol option p pre search section select summary table tbody td tfoot th
    thead title tr ul""".split()
)
NOISE = frozenset(
    """aside button canvas datalist dialog embed footer form head iframe input menu nav
    noscript object script search select style svg template textarea title""".split()
)
MAIN = frozenset({"article", "main"})
NOISE_ROLES = frozenset(
    """alert alertdialog banner complementary contentinfo dialog form menu menubar navigation
    search toolbar""".split()
)
NOISE_NAMES = frozenset(
    """ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment
    comments consent cookie cookies disqus disclaimer footer gdpr header login masthead menu
    modal nav navbar navigation newsletter notice notification pager pagination popup promo
    promotion recommended related replies reply share sharing sidebar signup social sponsor
    sponsored subscribe subscription toolbar widget""".split()
)
# Of these names those that can mean no part of an article, and words that say
# nothing of their own beside them.
NEVER_ARTICLE = frozenset(
    """ad ads adsbygoogle advert advertisement adverts advertising breadcrumb breadcrumbs
    comment comments consent cookie cookies disqus feedback gdpr newsletter pager pagination
    popup promo promotion recommended related replies reply share sharing social sponsor
    sponsored subscribe subscription""".split()
)
FILLERS = frozenset(
    """area bar block box button buttons by container content count feed form google group
    icon icons inner item items left link links list module outer panel reader readers right
    row section slot space text thread top unit user widget wrap wrapper zone""".split()
)
# Elements whose end tag is left out: what starting one of the keys closes, and within what.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=/\"'>]+)"
)
_NAME = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_HOST = re.compile(r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", re.I)


@dataclass
class Element:
    tag: str
    parent: int
    noise: bool
    style: str
    path: int
    common: int
    block: bool
    children: list[str] = field(default_factory=list)
    has_main: bool = False
    in_main: bool = False


@dataclass
class Block:
    """A run of text between block boundaries: fragments and the elements they stand in."""

    owner: int
    fragments: list[tuple[int, str]]


@dataclass
class Part:
    """A block that is left: its style node, the node above, its text and characters in links."""

    node: int
    parent: int
    text: str
    link_chars: int
    style: int
    marked: bool = False


def _hash(*parts: str | int) -> int:
    return xxhash.xxh64_intdigest("\x00".join(map(str, parts))) - 2**63


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare, alone in _ATTRIBUTE.findall(source):
        found.setdefault((name or alone).lower(), unescape(double or single or bare))
    return found


def _names(attributes: dict[str, str]) -> Iterator[set[str]]:
    """The words of each class and of the id; `AdSlot`, `ad-slot` and `ad_slot` are alike."""
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        yield {word.lower() for word in _NAME.findall(name)}


def _declared_noise(tag: str, attributes: dict[str, str], in_main: bool) -> bool:
    """Whether an element says that it is no part of an article."""
    if tag in MAIN:
        return any(words & {"comment", "comments", "reply", "teaser"} for words in _names(attributes))
    if tag in NOISE or (tag == "header" and not in_main):
        return True
    if not attributes or tag in ("html", "body"):
        return False
    if "hidden" in attributes or _HIDDEN.search(attributes.get("style", "").lower()):
        return True
    if attributes.get("role", "").lower() in NOISE_ROLES:
        return True
    if in_main:
        return any(
            words & NEVER_ARTICLE and words <= NEVER_ARTICLE | FILLERS for words in _names(attributes)
        )
    return any(words & (NOISE_NAMES | NEVER_ARTICLE) for words in _names(attributes))


class Page:
    """The elements and blocks of one page."""

    def __init__(self, html: str, host: str):
        self.elements = [Element("", -1, False, "", _hash(host), _hash(""), True)]
        self.blocks: list[Block] = []
        self._stack, self._open = [0], []
        self._count: Counter[str] = Counter()  # open elements by tag
        self._parse(html)
        self._flush()

    def _text(self, text: str) -> None:
        if text:
            self._open.append((self._stack[-1], unescape(text)))

    def _flush(self) -> None:
        if self._open:
            owner = self._stack[-1]
            while not self.elements[owner].block:
                owner = self.elements[owner].parent
            self.blocks.append(Block(owner, self._open))
            self._open = []

    def _close(self, depth: int) -> None:
        if any(self.elements[i].block for i in self._stack[depth:]):
            self._flush()
        for i in self._stack[depth:]:
            self._count[self.elements[i].tag] -= 1
        del self._stack[depth:]

    def _close_implied(self, tag: str) -> None:
        if tag in CLOSES:
            ends, within = CLOSES[tag]
            for depth in range(len(self._stack) - 1, 0, -1):
                name = self.elements[self._stack[depth]].tag
                if name in within:
                    return
                if name in ends:
                    self._close(depth)
        elif tag in BLOCK and tag != "br":
            for depth in range(len(self._stack) - 1, 0, -1):
                name = self.elements[self._stack[depth]].tag
                if name == "p":
                    self._close(depth)
                    return
                if name in BLOCK:
                    return

    def _start(self, tag: str, source: str) -> None:
        if tag in BLOCK:
            self._close_implied(tag)
            self._flush()
        if tag in VOID:
            return
        attributes = _attributes(source) if source.strip(" /\n\t\r") else {}
        above = self._stack[-1]
        in_main = self.elements[above].in_main
        block = tag in BLOCK
        style = ".".join(
            [tag, *sorted(attributes.get("class", "").lower().split()), attributes.get("id", "")]
        )
        parent = self.elements[above]
        path = _hash(parent.path, style) if block else parent.path
        common = _hash(parent.common, style) if block else parent.common
        if block and parent.children[-1:] != [style]:
            parent.children.append(style)
        noise = _declared_noise(tag, attributes, in_main)
        if attributes.get("role", "").lower() == "main":
            tag = "main"
        inside = in_main or tag in MAIN
        self.elements.append(Element(tag, above, noise, style, path, common, block, in_main=inside))
        self._stack.append(len(self.elements) - 1)
        self._count[tag] += 1
        if tag in MAIN and not noise:
            at = above
            while at >= 0 and not self.elements[at].has_main:
                self.elements[at].has_main = True
                at = self.elements[at].parent

    def _end(self, tag: str) -> None:
        if tag == "br" or (tag == "p" and not self._count["p"]):
            self._flush()
            return
        if not self._count[tag] and not self._count["main"]:
            return
        for depth in range(len(self._stack) - 1, 0, -1):
            name = self.elements[self._stack[depth]].tag
            if name == tag or (name == "main" and tag == self.elements[self._stack[depth]].style.split(".")[0]):
                self._close(depth)
                return
            if name in MAIN and tag not in ("body", "html") and tag not in MAIN:
                return

    def _parse(self, html: str) -> None:
        at = 0
        while (found := _TAG.search(html, at)) is not None:
            self._text(html[at : found.start()])
            at = found.end()
            if found[1]:
                self._end(found[1].lower())
                continue
            tag = (found[2] or found[4] or "").lower()
            if not tag:
                continue
            source = found[3] if found[2] else found[5]
            self._start(tag, source)
            if tag in RAW and not source.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
                at = end.end() if end else len(html)
                self._end(tag)
        self._text(html[at:])

    def parts(self) -> list[Part]:
        """The blocks that no element declares away; of the page's own marked article only, if
        it marks one."""
        dropped, linked, roots = [False], [False], [0]
        for number, element in enumerate(self.elements[1:], start=1):
            up = element.parent
            noise = element.noise and not element.has_main
            dropped.append(dropped[up] or noise)
            linked.append(linked[up] or element.tag == "a")
            # The outermost article that an element is in, or else the main element.
            marks = element.tag in MAIN and not element.noise
            above = self.elements[roots[up]].tag
            roots.append(number if marks and (not above or above == "main") else roots[up])
        kept = []
        for block in self.blocks:
            real = [(at, text) for at, text in block.fragments if not dropped[at]]
            text = " ".join("".join(text for _, text in real).split())
            if text:
                links = sum(len("".join(t.split())) for at, t in real if linked[at])
                owner = self.elements[block.owner]
                above = self.elements[max(owner.parent, 0)]
                root = roots[block.owner]
                kept.append((root, Part(owner.path, above.path, text, links, owner.common, root > 0)))
        sizes: Counter[int] = Counter()
        for root, part in kept:
            sizes[root] += len(part.text)
        marked = [root for root in sizes if root]
        if not marked:
            return [part for _, part in kept]
        own = max(marked, key=lambda root: (sizes[root], -root))
        return [part for root, part in kept if root == own]

    def styles(self) -> list[tuple[int, int, int]]:
        """Each node's path, a hash of the styles below it, and how many these are."""
        return [
            (e.path, _hash(*e.children), len(set(e.children)))
            for e in self.elements
            if e.block and e.children
        ]


def _features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`node`, `feature`, `kind` and sums for each page, each feature once a page.

    Kinds: 0 the node is on the page, below the feature; 1 the styles below it; 2 its text;
    3 its style on all hosts.
    """
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            piece = batch.slice(start, ROWS)
            rows: list[tuple] = []
            for url, html in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                page = Page(html, host_of(url))
                styles = {path: (path, below, 1, n, 0, 0) for path, below, n in page.styles()}
                rows += styles.values()
                nodes: dict[int, list[int]] = {}
                texts = set()
                for part in page.parts():
                    sums = nodes.setdefault(part.node, [0, 0, part.parent, part.style])
                    sums[0] += len(part.text)
                    sums[1] += part.link_chars
                    texts.add((part.node, _hash(part.text)))
                rows += [(node, s[2], 0, 0, s[0], s[1]) for node, s in nodes.items()]
                rows += [(node, s[3], 3, 0, 0, 0) for node, s in nodes.items()]
                rows += [(node, feature, 2, 0, 0, 0) for node, feature in texts]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["node", "feature", "kind", "styles", "chars", "links"],
            )


def node_importance(
    pages: DataFrame, damping: float = DAMPING, prior_pages: float = PRIOR_PAGES
) -> DataFrame:
    """`node`, `pages` that have it, whether it is mostly `linked`, and its `importance`, 0 to 1.

    A node's key holds its host, so hosts are merged by grouping nodes; a host with a third
    of all pages has its nodes combined before the shuffle.
    """
    given = pages.select(F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")))
    schema = "node long, feature long, kind long, styles long, chars long, links long"
    counted = stored(
        given.mapInArrow(_features, schema)
        .groupBy("node", "kind", "feature")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("styles").alias("styles"),
            F.sum("chars").alias("chars"),
            F.sum("links").alias("links"),
        ),
        "style-tree",
    )
    n = F.col("n").cast("double")
    # Entropy of the styles below a node, to the base of its pages: ln m - sum(n ln n) / m.
    style = (
        counted.where("kind = 1")
        .groupBy("node")
        .agg(F.sum(n).alias("m"), F.sum(n * F.log(n)).alias("nln"), F.max("styles").alias("below"))
        .select(
            F.col("node").alias("parent"),
            F.when(F.col("m") > 1, (F.log("m") - F.col("nln") / F.col("m")) / F.log("m"))
            .otherwise(1.0)
            .alias("variety"),
            "below",
        )
    )
    there = (
        counted.where("kind = 0")
        .groupBy("node")
        .agg(
            F.sum("n").alias("pages"),
            F.min("feature").alias("parent"),
            F.sum("chars").alias("chars"),
            F.sum("links").alias("links"),
        )
    )
    texts = counted.where("kind = 2").groupBy("node").agg(
        F.sum(F.log(n)).alias("ln"), F.count(F.lit(1)).alias("texts")
    )
    m = F.col("pages").cast("double")
    content = F.when(m > 1, 1 - F.col("ln") / F.col("texts") / F.log(m)).otherwise(1.0)
    weight = F.pow(F.lit(damping), F.coalesce(F.col("below"), F.lit(1)))
    variety = F.coalesce(F.col("variety"), F.lit(1.0))
    plain = 1 - F.col("links") / F.greatest("chars", F.lit(1))
    whole = ((1 - weight) * variety + weight * content) * F.greatest(plain, F.lit(0.0))
    shared = counted.where("kind = 3").groupBy("node").agg(F.min("feature").alias("common"))
    known = stored(
        there.join(texts, "node")
        .join(style, "parent", "left")
        .join(shared, "node")
        .select(
            "node",
            "common",
            "pages",
            whole.alias("own"),
            (F.col("links") * 2 >= F.col("chars")).alias("linked"),
        ),
        "style-nodes",
    )
    # One page says nothing of what repeats, so a node's evidence is its further pages. It
    # leans toward the same style on all hosts, and that toward full importance.
    evidence = F.col("pages") - 1
    everywhere = known.groupBy("common").agg(
        F.sum(evidence * F.col("own")).alias("sum"), F.sum(evidence).alias("weight")
    )
    expected = (F.col("sum") + prior_pages) / (F.col("weight") + prior_pages)
    leaning = (evidence * F.col("own") + prior_pages * expected) / (evidence + prior_pages)
    return known.join(everywhere, "common").select(
        "node", "pages", "linked", leaning.alias("importance")
    )


def _page_nodes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            piece = batch.slice(start, ROWS)
            keys, nodes = [], []
            for key, url, html in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                for node in {part.node for part in Page(html, host_of(url)).parts()}:
                    keys.append(key)
                    nodes.append(node)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(nodes, pa.int64())], names=["row", "node"]
            )


def main_text(html: str, host: str, low: set[int], main_share: float = MAIN_SHARE) -> str:
    """A page's main text without the nodes in `low`, unless one holds most of it.

    Inside a marked article only blocks that are mostly links go.
    """
    parts = Page(html, host).parts()
    if low:
        total = sum(len(part.text) for part in parts)
        sizes: dict[int, int] = {}
        for part in parts:
            sizes[part.node] = sizes.get(part.node, 0) + len(part.text)
        low = {node for node in low if sizes.get(node, 0) < main_share * total}
        parts = [
            part
            for part in parts
            if part.node not in low or (part.marked and 2 * part.link_chars < len(part.text))
        ]
    return " ".join(part.text for part in parts)


def _extracted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            piece = batch.slice(start, ROWS)
            ids, urls, htmls, lows = (c.to_pylist() for c in piece.columns)
            texts = [
                main_text(html, host_of(url), set(low or ()))
                for url, html, low in zip(urls, htmls, lows, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), piece.column(1), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"],
            )


def extract(pages: DataFrame, importance: float = IMPORTANCE) -> DataFrame:
    """`page_id`, `url`, `text` and `n_chars`, its code points.

    The pages with branches to remove are few numbers each; where these fit the broadcast
    threshold, no html is shuffled.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("row", F.xxhash64("page_id", "url", "html"))
    low = stored(
        node_importance(rows)
        .where(F.col("importance") < importance)
        .select("node"),
        "low-importance",
    )
    nodes = rows.select("row", "url", "html").mapInArrow(_page_nodes, "row long, node long")
    removed = stored(
        nodes.distinct().join(low, "node").groupBy("row").agg(F.collect_set("node").alias("low")),
        "removed-branches",
    )
    joined = rows.join(removed, "row", "left").select("page_id", "url", "html", "low")
    texts = joined.mapInArrow(_extracted, "page_id long, url string, text string")
    return texts.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
