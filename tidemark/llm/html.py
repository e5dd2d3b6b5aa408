"""Main text of web pages by site style trees.

The DOMs of one host are merged into one tree: a style node is a path of presentations (tag with its class and id
words), and holds, over all pages of the host that have it, how often each sequence of children (its presentation) and
each own text (its content) occurs. The importance of a node is the entropy of these distributions, as a share of the
largest possible for its number of pages, weighted by how much of it is plain text and not links. Text repeated on
every page, and menus, have importance near 0. A branch none of whose nodes is important enough goes from each page of
the host. Pages of a host with equal text count once. Inline elements belong to the block around them, so a link goes
only with its block.

The tree also picks the branch of a page that is its main text. Article and main elements come first, but one that the
tree finds unimportant gives way to another that is not, or to a longer important text outside. Inside the one picked
links count as text, and only boxes with a word of a kind that may be noise (share, related) are judged: headings and
notes that a host repeats belong to its articles.

Kinds of elements that never hold main text (scripts, forms, navigation, adverts, comments, by tag or class) are fixed
values: their importance is 0 whatever their entropy, since adverts and menus may change from page to page. A class
counts where all its words are of such kinds or places; inside an article where it is one such word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b
from html.parser import HTMLParser
from itertools import compress

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import NO_ID, as_list, with_id, without_id
from tidemark.llm.url_filter import host_and_path
from tidemark.session import cut_lineage

# Elements by tag, and words of class, id or role, that hold no main text.
NOISE_TAGS = frozenset(
    "head title script style noscript template nav header footer aside form button input select textarea label fieldset "
    "option iframe object embed svg canvas audio video map dialog menu".split()
)
# Inside an article its own header, labels and groups are text.
TEXT_INSIDE = frozenset("header label fieldset".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent notice "
    "notices notification alert popup modal overlay newsletter subscribe signup login menu menus nav navbar navigation "
    "breadcrumb breadcrumbs sidebar aside header footer masthead comment comments reply replies discussion disqus share "
    "sharing social related recommended recommendations widget widgets pagination pager toolbar search form skip hidden".split()
)
# Words that say where such an element stands or how it is built. A name of other words too (form-results,
# social-science) is that of a text.
PLACE_WORDS = frozenset(
    "site page main top bottom left right global primary secondary box bar container wrapper block section area list item "
    "items link links content inner outer header footer nav".split()
)
NOISE_NAMES = NOISE_WORDS | PLACE_WORDS
# Names that hold no main text inside an article either.
NOISE_INSIDE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent notice notices "
    "newsletter menu menus nav navbar navigation sidebar footer comment comments reply replies discussion disqus form".split()
)
# Words of a box inside an article that leave it to the style tree; an article's own headers and headings are text.
DOUBTFUL_WORDS = NOISE_WORDS - {"header"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that begin and end a block of text.
BLOCK_TAGS = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th "
    "blockquote pre figure figcaption address hr br nav header footer aside form fieldset details summary dialog".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# A start of one of these ends an open element of the second kind, up to the nearest element of the third.
_PARAGRAPH_ENDS = BLOCK_TAGS - {"br"}
ENDS = {
    "li": (("li",), ("ul", "ol")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
ROOTS = ("article", "main")
# How strongly a tag says that what it holds is the main text.
LEVELS = {"main": 1, "article": 2}
# A branch stays from this importance on.
THRESHOLD = 0.2
# Below so many pages of a host a node says nothing about the site.
LEAST_PAGES = 3
WORD = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")


@dataclass
class Node:
    style: str
    noise: bool
    # inside an article or main element, to be judged by the style tree
    doubtful: bool = False
    children: list[Node | str] = field(default_factory=list)


def _is_noise(tag: str, names: list[list[str]], inside: bool) -> bool:
    """Whether an element never holds main text, by its tag and the words of its class, id and role names."""
    if inside:
        # an article knows fewer kinds, and only by their whole names: text about a subject may be named for it
        by_name = any(len(name) == 1 and name[0] in NOISE_INSIDE for name in names)
        return (tag in NOISE_TAGS and tag not in TEXT_INSIDE) or (by_name and tag not in (*ROOTS, "header", "label"))
    if tag in NOISE_TAGS:
        return True
    if tag in ("html", "body", *ROOTS):
        return False
    return any(name and not NOISE_WORDS.isdisjoint(name) and NOISE_NAMES.issuperset(name) for name in names)


class _Tree(HTMLParser):
    """A forgiving DOM: open elements end where their parent ends; paragraphs end at the next block."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", False)
        self.open = [("", self.root)]
        # open elements that are articles or main
        self.main = 0

    def _close(self, at: int) -> None:
        self.main -= sum(name in ROOTS for name, _ in self.open[at:])
        del self.open[at:]

    def _end(self, names: tuple[str, ...], stop: tuple[str, ...]) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            name = self.open[at][0]
            if name in names:
                self._close(at)
                return
            if name in stop:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _PARAGRAPH_ENDS:
            self._end(("p",), ("table", "td", "th", "article", "section", "div", "li", "blockquote", "body"))
        if tag in ENDS:
            self._end(*ENDS[tag])
        words: set[str] = set()
        names: list[list[str]] = []
        for key, value in attrs:
            if value and key in ("class", "id", "role"):
                names += [WORD.findall(name) for name in value.lower().split()]
        for name in names:
            words.update(name)
        style = tag + "".join("." + w for w in sorted(words))
        parent = self.open[-1][1]
        inside = self.main > 0
        noise = _is_noise(tag, names, inside)
        doubtful = inside and tag not in ROOTS and tag not in HEADINGS and not DOUBTFUL_WORDS.isdisjoint(words)
        node = Node(style, noise, doubtful)
        parent.children.append(node)
        if tag not in VOID_TAGS:
            self.open.append((tag, node))
            self.main += tag in ROOTS

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] == tag:
                self._close(at)
                return

    def handle_data(self, data: str) -> None:
        self.open[-1][1].children.append(data)


def parse(html: str | None) -> Node:
    tree = _Tree()
    if html:
        tree.feed(html)
        tree.close()
    return tree.root


def _tag(node: Node) -> str:
    return node.style.split(".", 1)[0]


def _level(node: Node, around: int) -> int:
    return max(around, LEVELS.get(_tag(node), 0))


def number_of(text: str) -> int:
    """A 64-bit number of a text, the same in every process."""
    digest = blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


ROOT = number_of("")
# Style nodes around a text, the nearest first: a number, and the rest.
Chain = tuple[int, "Chain | None"]


def below(path: int, style: str) -> int:
    """The number of a style node, from that of the one above it: deep pages have no long paths."""
    return number_of(f"{path}/{style}")


def _numbers(chain: Chain | None) -> tuple[int, ...]:
    out = []
    while chain is not None:
        number, chain = chain
        out.append(number)
    return tuple(out)


def branches(root: Node) -> tuple[list[tuple[str, int, int, tuple[int, ...]]], int]:
    """Texts of a page without noise, in page order: text, number of its block, level, style nodes that decide on it;
    and the highest level of its elements: 2 with an article, 1 with a main element, else 0.

    Elements of a block kind end a block, also where they are left out. Only blocks are style nodes. On a text inside
    an article or main element decide that element and the doubtful boxes in it, elsewhere all blocks around it.
    """
    out: list[tuple[str, int, int, tuple[int, ...]]] = []
    block = highest = 0
    # an element or text with its level and the style nodes around it, or the end of a block
    waiting: list[tuple[Node | str | None, int, int, Chain | None]] = [(root, ROOT, 0, None)]
    while waiting:
        item, path, level, around = waiting.pop()
        if item is None:
            block += 1
        elif isinstance(item, str):
            out.append((item, block, level, _numbers(around)))
        else:
            if _tag(item) in BLOCK_TAGS:
                block += 1
                waiting.append((None, path, level, None))
            if item.noise:
                continue
            if item is not root:
                path = below(path, item.style)
                own = _level(item, level)
                if own > level:
                    # what is around an article says nothing about it
                    level, around = own, (path, None)
                    highest = max(highest, level)
                elif _is_block(item) and (level == 0 or item.doubtful):
                    around = (path, around)
            waiting.extend((child, path, level, around) for child in reversed(item.children))
    return out, highest


def segments(root: Node) -> list[tuple[str, int, tuple[int, ...]]]:
    """The ``branches`` of a page's highest level: its articles, else its main elements, else all of it."""
    parts, highest = branches(root)
    return [(text, block, around) for text, block, level, around in parts if level == highest]


def joined(texts: list[str], numbers: list[int]) -> str:
    """Texts of a block as they stand, white space as one space; blocks by one space."""
    out, at = [], 0
    while at < len(texts):
        end = at + 1
        while end < len(texts) and numbers[end] == numbers[at]:
            end += 1
        text = SPACE.sub(" ", "".join(texts[at:end])).strip()
        if text:
            out.append(text)
        at = end
    return " ".join(out)


def _is_block(node: Node) -> bool:
    return not node.style or _tag(node) in BLOCK_TAGS


def _inside(block: Node, path: int, linked: bool) -> tuple[list[tuple[str, bool]], list[str], list[tuple[Node, int, bool]]]:
    """Of a block with its inline elements: its texts, and whether they are links; styles; the next blocks below."""
    texts: list[tuple[str, bool]] = []
    styles: list[str] = []
    blocks: list[tuple[Node, int, bool]] = []
    waiting: list[tuple[Node | str, int, bool]] = [(c, path, linked) for c in reversed(block.children)]
    while waiting:
        item, path, linked = waiting.pop()
        if isinstance(item, str):
            texts.append((item, linked))
            continue
        styles.append(item.style)
        if item.noise:
            continue
        path = below(path, item.style)
        linked = linked or _tag(item) == "a"
        if _is_block(item):
            blocks.append((item, path, linked))
        else:
            waiting += [(c, path, linked) for c in reversed(item.children)]
    return texts, styles, blocks


def _plain(texts: list[str]) -> str:
    return SPACE.sub(" ", " ".join(texts)).strip()


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per page: its branches, a hash of its text, and per style node hashes of presentation and own text, and
    lengths of text and links."""
    for batch in batches:
        rows = []
        for page, url, host, html in zip(batch["page_id"], batch["url"], batch["host"], as_list(batch["html"]), strict=True):
            root = parse(html)
            nodes: dict[int, list] = {}
            waiting = [(root, ROOT, False, None, 0)]
            while waiting:
                node, path, linked, parent, around = waiting.pop()
                level = _level(node, around)
                texts, inner, blocks = _inside(node, path, linked)
                held = nodes.setdefault(path, [parent, [], [], 0, 0, level > 0, level == 0 or level > around or node.doubtful])
                held[1].append(" ".join(inner))
                if own := _plain([t for t, _ in texts]):
                    held[2].append(own)
                    held[3] += len(_plain([t for t, link in texts if not link]))
                    held[4] += len(_plain([t for t, link in texts if link]))
                waiting += [(*c, path, level) for c in reversed(blocks)]
            styles = [
                {
                    "path": path,
                    "parent": NO_ID if parent is None else parent,
                    "shape": number_of("|".join(shapes)),
                    "content": number_of("|".join(texts)) if texts else NO_ID,
                    "plain": plain,
                    "link": link,
                    "inside": inside,
                    "judged": judged,
                }
                for path, (parent, shapes, texts, plain, link, inside, judged) in nodes.items()
            ]
            parts, highest = branches(root)
            texts, numbers, levels = [t for t, _, _, _ in parts], [n for _, n, _, _ in parts], [x for _, _, x, _ in parts]
            whole = number_of(joined(texts, numbers))
            rows.append((page, url, host, whole, styles, texts, numbers, levels, highest, [list(a) for _, _, _, a in parts]))
        if rows:
            names = ["page_id", "url", "host", "whole", "styles", "texts", "blocks", "levels", "highest", "around"]
            yield pd.DataFrame(rows, columns=names)


PARSED = (
    "page_id bigint, url string, host string, whole bigint, "
    "styles array<struct<path:bigint,parent:bigint,shape:bigint,content:bigint,plain:bigint,link:bigint,inside:boolean,"
    "judged:boolean>>, texts array<string>, blocks array<int>, levels array<int>, highest int, around array<array<bigint>>"
)


def _evenness(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Entropy of ``key`` over the pages of a style node, as a share of the largest possible."""
    counts = rows.where(F.col(key).isNotNull()).groupBy("host", "path", key).agg(F.count(F.lit(1)).alias("c"))
    sums = counts.groupBy("host", "path").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.log("c")).alias("clogc"))
    entropy = F.log("m") - F.col("clogc") / F.col("m")
    return sums.select("host", "path", F.when(F.col("m") > 1, entropy / F.log("m")).otherwise(1.0).alias(name))


def unimportant(parsed: DataFrame, threshold: float = THRESHOLD, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``host``, ``removed``: judged style nodes (path numbers) of each host that hold nothing important, nor do those
    below.

    ``parsed`` has a host, a number of the text and the style nodes of each page. Pages of a host with equal text are
    one page. A node's own importance is that of its presentation or of its content, whichever is larger, times its
    share of plain text outside articles; a branch is as important as its most important node, which its ancestors
    learn in rounds that double the distance, so that a deep host takes a round per power of two of its depth.
    """
    pages = parsed.select("host", "whole", "styles").dropDuplicates(["host", "whole"])
    rows = pages.select("host", F.inline("styles")).withColumns({c: without_id(c) for c in ("parent", "content")})
    totals = rows.groupBy("host", "path").agg(
        F.first("parent").alias("parent"),
        F.count(F.lit(1)).alias("pages"),
        F.sum("plain").alias("plain"),
        F.sum("link").alias("link"),
        F.max("inside").alias("inside"),
        F.max("judged").alias("judged"),
    )
    content, shape = _evenness(rows, "content", "content"), _evenness(rows, "shape", "shape")
    text_share = F.coalesce(F.col("plain") / F.nullif(F.col("plain") + F.col("link"), F.lit(0)), F.lit(0.0))
    own = F.when(F.col("pages") < least_pages, 1.0).otherwise(
        F.when(F.col("inside"), 1.0).otherwise(text_share) * F.greatest(F.coalesce("content", F.lit(0.0)), F.coalesce("shape", F.lit(0.0)))
    )
    nodes = totals.join(content, ["host", "path"], "left").join(shape, ["host", "path"], "left")
    nodes = nodes.select("host", "path", "judged", F.col("parent").alias("up"), (own >= threshold).alias("live"))
    nodes = cut_lineage(nodes, "nodes")
    while not nodes.where("up is not null").isEmpty():
        nodes = cut_lineage(_doubled(nodes), "nodes")
    return nodes.where("judged and not live").groupBy("host").agg(F.collect_set("path").alias("removed"))


def _doubled(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``live`` told to the ancestor ``up``, and ``up`` moved on to the ancestor's own."""
    told = nodes.where("live and up is not null").select("host", F.col("up").alias("path"), F.lit(True).alias("told")).distinct()
    above = nodes.select("host", F.col("path").alias("up"), F.col("up").alias("next"))
    marked = nodes.join(above, ["host", "up"], "left").join(told, ["host", "path"], "left")
    return marked.select("host", "path", "judged", F.col("next").alias("up"), (F.col("live") | F.coalesce("told", F.lit(False))).alias("live"))


def picked(texts: list[str], numbers: list[int], levels: list[int], highest: int, live: list[bool]) -> str:
    """The main text of a page: what is important of its highest level, unless the tree finds nothing important there
    and a longer important text at a lower one."""

    def of(level: int, important: bool) -> str:
        stay = [at == level and (alive or not important) for at, alive in zip(levels, live, strict=True)]
        return joined(list(compress(texts, stay)), list(compress(numbers, stay)))

    main = of(highest, True)
    if main or highest == 0:
        return main
    named = of(highest, False)
    if named:
        for level in range(highest - 1, -1, -1):
            if len(other := of(level, True)) > len(named):
                return other
    return named


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ("texts", "blocks", "levels", "highest", "around", "removed")
    for batch in batches:
        out = []
        for texts, numbers, levels, highest, around, removed in zip(*(batch[c] for c in columns), strict=True):
            gone = frozenset() if removed is None else frozenset(int(x) for x in removed)
            live = [not gone or gone.isdisjoint(int(x) for x in chain) for chain in around]
            out.append(picked(list(texts), list(numbers), list(levels), int(highest), live))
        yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": out})


def extract(pages: DataFrame, threshold: float = THRESHOLD, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``page_id``, ``url``, ``text`` for every row of ``pages`` (``page_id``, ``url``, ``html``).

    Character references are decoded, white space in a block becomes one space, and blocks are joined by one space.
    Null or empty html gives an empty text. Pages without a host share the empty host. Repeated rows are extracted
    each. Empty input gives no rows. Other columns are ignored. Pages are parsed once, and their branches written.
    """
    host, _ = host_and_path(F.col("url"))
    url, html = F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    rows = pages.select(with_id("page_id"), url, html, host.alias("host"))
    parsed = cut_lineage(rows.mapInPandas(_parsed, PARSED), "parsed")
    noise = unimportant(parsed.select("host", "whole", "styles"), threshold, least_pages)
    kept = parsed.drop("styles", "whole").join(noise, "host", "left").drop("host")
    return kept.mapInPandas(_texts, "page_id bigint, url string, text string").select(without_id("page_id"), "url", "text")
