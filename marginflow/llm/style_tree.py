"""Main text of web pages by a site style tree.

The DOMs of a host are merged: nodes with the same path of tags and classes are one tree node.
Equal pages of a host count as one page, so copies make no text a template.
A node has *presentation* importance, the entropy over its pages of the tag sequences of its
children, and leaves have *content* importance, one less the entropy of a text's spread over
the pages: what is the same on every page tells nothing. The composite importance of a branch
weighs both; a branch below ``LEAST_IMPORTANCE`` that enough pages have is noise, and it is
removed from each page. Elements that say themselves what they are (``nav``, ``aside``, class
``sidebar``, comments and so on) have no importance whatever their text; where a page marks
its article, what stands outside has none either. Inside a marked article one generic word of a
name (``social-history``, ``entry-header``, ``search``) tells nothing: there a whole class or id
must be one of ``STRONG_NAMES``, or all words of a class of several be noise words. The id of a
heading names its text, never noise. An inline element that says so loses its own text only.

How it scales: one pass over the pages counts (host, node, feature), combined in each batch and
again before the shuffle, so a host with a third of all pages is no hot task; entropies are
sums over these counts. Copies are found by digests, combined before the shuffle, and each of k
equal pages counts 1/k; the digests that stand more than once are broadcast while
``BROADCAST_DIGESTS`` bound them, and joined beyond. What goes back to the pages is, for each host, the set of unimportant
nodes; it is broadcast while ``BROADCAST_NODES`` bound it, and joined by host beyond. A second
pass extracts. No page is moved in the usual case.

Defined results: null or empty html gives an empty text. A null url has the host "". Broken
markup is read as browsers do: unclosed elements end with their parent, stray end tags are
skipped, elements below 512 open ones are siblings, an unfinished tag at the end is no text. A raw
element (script, svg and so on) that is closed in its own tag or never costs no text after it. Very
long pages take time in proportion. Only an attribute's own name makes it a class, id, role or
``hidden``. Other columns, whatever their names, are not read. An empty table gives no rows. Hosts of fewer than ``LEAST_PAGES`` pages
are judged by their elements alone. Repeated rows give repeated results.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginflow.llm.common import short_batches, stored

LEAST_IMPORTANCE = 0.12
#: A node is judged by the tree only if at least so many pages of the host have it.
LEAST_PAGES = 8
#: Attenuation of what lies below a node with several presentations.
GAMMA = 0.9
#: Unimportant nodes are broadcast up to so many (some 60 bytes each).
BROADCAST_NODES = 200_000
#: Digests of pages that stand more than once are broadcast up to so many (some 150 bytes each).
BROADCAST_DIGESTS = 200_000
#: Where no article is marked, blocks with more of their characters in links are menus.
MOST_LINKS = 0.5

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "iframe", "svg", "textarea", "title", "object", "canvas", "select")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
NOISE_TAGS = frozenset("nav footer aside form menu dialog button fieldset head".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup login sidebar side aside widget widgets menu nav navbar navigation breadcrumb breadcrumbs "
    "topbar masthead header footer foot share sharing social related recommended recommendations comment comments reply replies respond disqus search "
    "pagination pager copyright legal disclaimer form toolbar skip".split()
)
#: Whole classes or ids that are evidence enough inside an article.
STRONG_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense sponsored sidebar widget widgets nav navbar navigation breadcrumb breadcrumbs "
    "topbar masthead newsletter popup modal comments replies respond disqus pagination pager toolbar".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words that begin so say the same (commentlist, sidebarinner).
NOISE_STEMS = ("commentlist", "commentbox", "advert", "sidebar", "breadcrumb", "newsletter", "cookiebar", "cookiebanner", "navbar", "adsense")
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
CONTENT_TAGS = frozenset(("article", "main"))
#: Words that say nothing beside a noise word (``social-bar``, ``comment-list``).
NEUTRAL_WORDS = frozenset("site page main global top bottom left right bar box block wrap wrapper container inner outer area list item items link links icon icons btn button buttons js is has el u posts post stories articles".split())
#: Noise words that hold inside an article with neutral ones beside them.
CORE_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored sidebar breadcrumb breadcrumbs newsletter cookie cookies subscribe share sharing related recommended comment comments reply replies pagination nav".split())
#: Open elements that a path names; deeper ones count as siblings, as in browsers.
DEPTH = 512
#: Start tags that end an open paragraph, and siblings that end each other.
ENDS_P = frozenset(
    "address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
ENDS_OWN = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
OUTER = frozenset(("table", "ul", "ol", "dl"))
SCOPES = frozenset(("table", "ul", "ol", "dl", "body", "html", "article", "section", "div", "td", "th", "li"))

#: Comments, CDATA, declarations and tags; a quote without its partner ends with the tag.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/><]*)(?=[\s/>]|\Z)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<tag2>[A-Za-z][^\s/><]*)(?=[\s/>])[^>]*(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW}
_NEXT_TAG = re.compile(r"<[A-Za-z/!]")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_NAME = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


def says_noise(classes: str, ids: str, strict: bool) -> bool:
    """Whether the names of an element say noise; ``strict`` inside a marked article. One generic word
    among others that say something else (``form-guide``, ``legal-history``) does not."""
    for name in (*classes.split(), *ids.split()):
        words = _NAME.findall(name)
        if strict:
            if name in STRONG_NAMES or (name.isalpha() and name.startswith(NOISE_STEMS)):
                return True
            if len(words) > 1 and any(w in CORE_WORDS for w in words) and all(w in NOISE_WORDS or w in NEUTRAL_WORDS for w in words):
                return True
        elif any(w in NOISE_WORDS or w.startswith(NOISE_STEMS) for w in words) and all(w in NOISE_WORDS or w in NEUTRAL_WORDS or w.startswith(NOISE_STEMS) for w in words):
            return True
    parts = map(_NAME.findall, classes.split())
    return strict and any(len(x) > 1 and all(w in NOISE_WORDS for w in x) for x in parts)


def attributes(text: str) -> dict[str, str]:
    """Attributes of a start tag by lower-case name; the first of a name counts, as in browsers."""
    out: dict[str, str] = {}
    for name, a, b, c in _ATTR.findall(text):
        out.setdefault(name.lower(), a or b or c)
    return out


def is_hidden(attrs: dict[str, str]) -> bool:
    return "hidden" in attrs or attrs.get("aria-hidden", "").strip().lower() == "true" or _NO_DISPLAY.search(attrs.get("style", "")) is not None


class Block:
    """A run of text in one block element."""

    __slots__ = ("path", "parts", "noise", "inside", "links", "chars")

    def __init__(self, path: tuple[str, ...], noise: bool, inside: bool):
        self.path, self.noise, self.inside = path, noise, inside
        self.parts: list[str] = []
        self.links = self.chars = 0

    @property
    def text(self) -> str:
        return _SPACE.sub(" ", "".join(self.parts)).strip()


class Open(NamedTuple):
    """An open element; ``noise`` counts its ancestors' too, ``said`` is an inline element's own."""

    tag: str
    path: tuple[str, ...]
    noise: bool
    inside: bool
    inline: bool
    said: bool


def parse(page: str) -> tuple[list[Block], dict[tuple[str, ...], list[str]]]:
    """Blocks with text in page order, and the child tags of every element path. Time is in
    proportion to the page: tags that are not open are not looked for, and elements below
    ``DEPTH`` open ones are siblings."""
    blocks: list[Block] = []
    children: dict[tuple[str, ...], list[str]] = {}
    stack: list[Open] = [Open("", (), False, False, False, False)]
    held: list[Open] = [stack[0]]  # the open block elements
    is_open: Counter = Counter()
    no_end: set[str] = set()
    links = muted = 0
    block: Block | None = None

    def text(s: str) -> None:
        nonlocal block
        if not s or muted:
            return
        if block is None:
            if not s.strip():
                return
            top = held[-1]
            block = Block(top.path, top.noise, top.inside)
            blocks.append(block)
        s = entities.unescape(s) if "&" in s else s
        block.parts.append(s)
        block.chars += len(s)
        if links:
            block.links += len(s)

    def close(k: int) -> None:
        nonlocal links, muted, block
        for x in stack[k:]:
            is_open[x.tag] -= 1
            links -= x.tag == "a"
            muted -= x.said
            if not x.inline:
                held.pop()
                block = None
        del stack[k:]

    def nearest(tags, stop=frozenset()) -> int:
        """The place of the innermost open element of ``tags``, looked for up to one of ``stop``."""
        if not any(is_open[t] > 0 for t in tags):
            return 0
        return next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag in tags or stack[k].tag in stop), 0)

    def push(x: Open) -> None:
        stack.append(x)
        is_open[x.tag] += 1
        if not x.inline:
            held.append(x)

    at = 0
    while m := _TOKEN.search(page, at):
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if tag is None:
            continue
        tag = tag.lower()
        given = m["attrs"] or ""
        if m["end"] or m["end2"]:
            k = nearest((tag,))
            if k and (tag not in INLINE or all(x.inline for x in stack[k:])):
                close(k)
            elif tag == "br":
                text(" ")
            continue
        if tag == "br":
            if block is not None:
                text(" ")
            continue
        if tag in _RAW_END:
            # what a raw element holds goes; without an end tag it holds nothing (code: up to the next tag)
            if not given.rstrip().endswith("/"):
                end = None if tag in no_end else _RAW_END[tag].search(page, at)
                if end is None:
                    no_end.add(tag)
                    if tag in ("script", "style"):
                        after = _NEXT_TAG.search(page, at)
                        at = after.start() if after else len(page)
                else:
                    at = end.end()
            continue
        inline = tag in INLINE
        if not inline:
            block = None
            if tag in ENDS_P and (k := nearest(("p",), SCOPES)) and stack[k].tag == "p":
                close(k)
            if (own := ENDS_OWN.get(tag)) and (k := nearest(own, OUTER)) and stack[k].tag in own:
                close(k)
        if tag in VOID:
            continue
        attrs = attributes(given) if given.strip(" /\n\t") else {}
        classes, ids, role = attrs.get("class", "").lower(), attrs.get("id", "").lower(), attrs.get("role", "").strip().lower()
        up = stack[-1]
        said = bool(classes or ids) and says_noise(classes, "" if tag in HEADINGS else ids, up.inside)
        said = said or (bool(attrs) and is_hidden(attrs))
        if inline:
            muted += said
            push(Open(tag, up.path, up.noise, up.inside, True, said))
            links += tag == "a"
            continue
        mark = tag + "".join("." + w for w in _NAME.findall(f"{classes} {ids}"))
        children.setdefault(up.path, []).append(mark)
        path = (*up.path, mark) if len(up.path) < DEPTH else up.path
        children.setdefault(path, [])
        inside = up.inside or tag in CONTENT_TAGS or role == "main"
        content = tag in CONTENT_TAGS or tag in ("body", "html")
        noise = tag in NOISE_TAGS or (tag == "header" and not up.inside) or (not content and said) or role in NOISE_ROLES
        push(Open(tag, path, up.noise or noise, inside, False, False))
    text(page[at:])
    return [b for b in blocks if b.text], children


def key_of(path: tuple[str, ...]) -> int:
    return int.from_bytes(blake2b(">".join(path).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _feature(s: str) -> int:
    return int.from_bytes(blake2b(s.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def main_text(page: str, unimportant: frozenset[int] = frozenset()) -> str:
    """The article of a page, given the unimportant nodes of its host."""
    blocks, _ = parse(page)
    good = [b for b in blocks if not b.noise]
    if unimportant:
        low: dict[tuple[str, ...], bool] = {}

        def noisy(path: tuple[str, ...]) -> bool:
            if path not in low:
                low[path] = bool(path) and (key_of(path) in unimportant or noisy(path[:-1]))
            return low[path]

        good = [b for b in good if not noisy(b.path)]
    marked = [b for b in good if b.inside]
    if not marked:
        marked = [b for b in good if b.links <= MOST_LINKS * b.chars]
    return "\n".join(b.text for b in marked)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def style_tree(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(host, node, importance, n_pages): the composite importance of every tree node."""
    short_batches(pages.sparkSession, 256)
    src = pages.select(host_of(F.col(url_col)).alias("host"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("_html"))
    src = src.withColumn("_digest", F.sha2("_html", 256))
    copies = src.groupBy("host", "_digest").agg(F.count(F.lit(1)).alias("_copies")).filter("_copies > 1")
    copies = stored(copies, "copies")
    if copies.limit(BROADCAST_DIGESTS + 1).count() <= BROADCAST_DIGESTS:
        copies = F.broadcast(copies)
    src = src.join(copies, ["host", "_digest"], "left").select("host", "_html", F.coalesce("_copies", F.lit(1)).alias("_copies"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # kind: "s" a presentation of a node, "c" a text of a leaf, "p" a page of a node
        for b in batches:
            c: Counter = Counter()
            up: dict[int, list[int]] = {}
            for host, page, copies in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                part = 1.0 / copies
                blocks, children = parse(page.as_py())
                for path, tags in children.items():
                    # runs of one tag are one presentation, so that the number of paragraphs tells nothing
                    node = key_of(path)
                    c[host, node, "s", _feature(",".join(t for k, t in enumerate(tags) if not k or tags[k - 1] != t)), 0] += part
                    c[host, node, "p", 0, 0] += part
                for x in blocks:
                    node = key_of(x.path)
                    if node not in up:
                        up[node] = [key_of(x.path[:k]) for k in range(1, len(x.path) + 1)]
                    c[host, node, "c", _feature(x.text), x.chars] += part
            rows = [(*k, n, up.get(k[1], []) if k[2] == "c" else []) for k, n in c.items()]
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int64()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["host", "node", "kind", "feature", "chars", "n", "up"])

    rows = src.mapInArrow(count, "host string, node long, kind string, feature long, chars long, n double, up array<long>")
    # the parts of equal pages sum to whole numbers
    f = rows.groupBy("host", "node", "kind", "feature").agg(F.round(F.sum("n")).alias("n"), F.max("chars").alias("chars"), F.max("up").alias("up"))
    x = F.col("n").cast("double")
    f = f.groupBy("host", "node", "kind").agg(F.sum(x).alias("m"), F.sum(x * F.log(x)).alias("nlogn"), F.count(F.lit(1)).alias("kinds"), F.sum(x * F.col("chars")).alias("chars"), F.max("up").alias("up"))
    entropy = F.when(F.col("m") > 1, (F.log("m") - F.col("nlogn") / F.col("m")) / F.log("m")).otherwise(1.0)
    f = stored(f.withColumn("entropy", entropy), "style-tree")
    # a text that stands once has spread 0, one that stands everywhere 1: spread = 1 - entropy of the texts
    leaves = f.filter("kind = 'c'").select("host", F.explode("up").alias("node"), "chars", F.col("entropy").alias("content"))
    below = leaves.groupBy("host", "node").agg((F.sum(F.col("chars") * F.col("content")) / F.sum("chars")).alias("content"))
    shape = f.filter("kind = 's'").select("host", "node", F.col("kinds").alias("l"), F.col("entropy").alias("shape"))
    n = f.filter("kind = 'p'").select("host", "node", F.col("m").alias("n_pages"))
    j = below.join(shape, ["host", "node"], "left").join(n, ["host", "node"], "left")
    keep = F.pow(F.lit(GAMMA), F.coalesce("l", F.lit(1)))
    return j.select("host", "node", ((1 - keep) * F.coalesce("shape", F.lit(0.0)) + keep * F.col("content")).alias("importance"), "n_pages")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A row per page: id, url, ``text``, ``n_chars``."""
    tree = style_tree(pages, url_col, html_col)
    low = tree.filter((F.col("importance") < LEAST_IMPORTANCE) & (F.col("n_pages") >= LEAST_PAGES))
    low = stored(low.select("host", "node"), "unimportant")
    src = pages.select(F.col(id_col).alias(id_col), F.col(url_col).alias("_url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("_html"))
    src = src.withColumn("_host", host_of(F.col("_url")))
    known = None
    if low.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES:
        nodes: dict[str, set[int]] = {}
        for r in low.toLocalIterator():
            nodes.setdefault(r.host, set()).add(r.node)
        known = pages.sparkSession.sparkContext.broadcast({h: frozenset(x) for h, x in nodes.items()})
        src = src.select(id_col, "_url", "_html", "_host", F.lit(None).cast("array<bigint>").alias("_low"))
    else:
        by_host = low.groupBy(F.col("host").alias("_host")).agg(F.collect_list("node").alias("_low"))
        src = src.join(by_host, "_host", "left").select(id_col, "_url", "_html", "_host", "_low")
    kind = src.schema[id_col].dataType.simpleString()
    short_batches(pages.sparkSession, 256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = dict(known.value) if known is not None else {}  # one set a host and batch
            texts = []
            for page, host, nodes in zip(b.column(2), b.column(3).to_pylist(), b.column(4), strict=True):
                if host not in sets:
                    sets[host] = frozenset(nodes.as_py() or ())
                texts.append(main_text(page.as_py(), sets[host]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    return src.mapInArrow(run, f"`{id_col}` {kind}, `{url_col}` string, text string, n_chars long")
