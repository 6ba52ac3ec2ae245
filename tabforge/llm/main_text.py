"""Main text of web pages: site templates and marked furniture are removed, the article's blocks stay.

A page is read into a tree of its block elements. The subtrees are hashed, Spark counts on how many
different pages of a host each hash stands, and subtrees that recur on many of them are the host's
template. Inside an article a subtree is hashed with its place (the chain of elements around it and a
neighbour, or the edge), and only containers are: a sentence that many articles hold stays. Extraction
takes the article (or the main element, or the body), leaves out template subtrees and elements that say
by name, role or class that they are menus, notices, forms and the like, and returns the remaining blocks.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.session import materialize

#: A subtree belongs to a host's template when it stands on so many of its different pages.
LEAST_PAGES = 3

# Names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img br math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup mover munder munderover mstyle mspace semantics".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote figure figcaption dd dt caption td th tr tbody thead tfoot html body article main".split())
#: Elements inside an article that are no template, wherever they recur.
KEPT_INSIDE = PROSE | {"li", "header"}
WHOLE = frozenset("html body article main".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section summary table ul li dd dt".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
FENCES = frozenset("table ul ol dl td th template object html body article main section div".split())
FURNITURE = frozenset("head nav header footer aside form script style noscript template iframe svg canvas button select textarea menu dialog object title audio video map".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar status form".split())
CLASS_WORDS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted sidebar menu nav navbar navigation breadcrumb breadcrumbs masthead header footer cookie cookies consent gdpr notice notices alert banner popup modal overlay newsletter subscribe subscription signup social share sharing related recommended comment comments reply replies disqus respond form login search widget toolbar pagination pager skip".split())
REMARKS = frozenset("comment comments reply replies".split())
CONTENT_WORDS = frozenset("article content post entry story".split())
#: Parts of a class name that leave its meaning to the others.
NEUTRAL_WORDS = frozenset("area bar block body bottom box col column container end footer global group header holder id inner item items left link links list main mobile outer page panel primary right row secondary section site slot small start sticky the top unit wrap wrapper".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_COMMENT = re.compile(r"<!--.*?(?:--!?>|\Z)", re.S)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_OTHER = re.compile(r"<[!?/][^>]*+>", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


class Node:
    """A block element; ``parts`` are its texts and child elements in page order."""

    __slots__ = ("tag", "parts", "marked", "named", "content", "digest", "holds", "headed")

    def __init__(self, tag: str, marked: bool = False, named: bool = False, content: bool = False):
        self.tag, self.parts, self.marked, self.content, self.digest = tag, [], marked, content, 0
        self.named = named  # furniture by its attributes, not by its tag alone
        self.holds = False  # an article or main element
        self.headed = tag in HEADINGS  # is or holds a heading


def _says(words: str, wanted: frozenset[str]) -> bool:
    """Whether a class or id name is made of wanted words, and of neutral ones beside them."""
    for token in words.split():
        parts = [w.lower() for w in _WORDS.findall(token)]
        if any(w in wanted for w in parts) and all(w in wanted or w in NEUTRAL_WORDS for w in parts):
            return True
    return False


def _marks(tag: str, attributes: str) -> tuple[bool, bool, bool]:
    """(furniture, furniture by its attributes, content) as an element's name and attributes say."""
    named, content = False, tag in ("article", "main")
    if tag not in ("html", "body") and attributes.strip(" /"):
        values = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)}
        names = f"{values.get('class', '')} {values.get('id', '')}"
        if tag in ("article", "main"):
            named = tag == "article" and _says(names, REMARKS)
            return named, named, not named
        role, style = values.get("role", "").lower(), values.get("style", "").replace(" ", "").lower()
        named = _says(names, CLASS_WORDS) or role in ROLES or "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in style
        content |= role in ("main", "article") or _says(names, CONTENT_WORDS)
    marked = named or tag in FURNITURE
    return marked, named, content and not marked


def parse(page: str) -> Node:
    """The tree of block elements; inline markup and comments leave only their text, scripts and styles nothing."""
    root = Node("html")
    stack = [root]
    still = Counter()  # open elements by tag

    def close(k: int) -> None:
        still.subtract(s.tag for s in stack[k:])
        del stack[k:]

    at, n, last, tags = 0, len(page), page.rfind(">"), _TAG
    while at < n:
        begin = page.find("<", at)
        if begin < 0 or begin > last and not page.startswith("<!--", begin):
            stack[-1].parts.append(page[at:])
            break
        if begin > at:
            stack[-1].parts.append(page[at:begin])
        m = (_COMMENT if page.startswith("<!--", begin) else _OTHER).match(page, begin)
        if m is not None and not page[begin + 1 : begin + 3].strip("/")[:1].isalpha():
            at = m.end()
            continue
        m = tags.match(page, begin)
        if m is None and tags is _TAG and _PLAIN_TAG.match(page, begin):
            tags = _PLAIN_TAG  # a quote that nothing closes: from here on a tag ends at the next >
            m = tags.match(page, begin)
        if m is None:
            stack[-1].parts.append("<")
            at = begin + 1
            continue
        at = m.end()
        tag = m[2].lower()
        if m[1]:
            if tag in INLINE or tag in VOID or not still[tag]:
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    close(k)
                    break
            continue
        if tag in RAW:
            end = _RAW_ENDS[tag].search(page, at)
            at = n if end is None else max(page.find(">", end.end()) + 1, end.end())
            continue
        if tag == "br":
            stack[-1].parts.append(" ")
            continue
        if tag in INLINE:
            continue
        if tag in CLOSES_P and still["p"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag in ("table", "td", "th", "caption", "button", "object", "template"):
                    break
        if tag in SIBLINGS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in SIBLINGS[tag]:
                    close(k)
                    break
                if stack[k].tag in FENCES:
                    break
        if tag in ("html", "body") and (tag == "html" or still["body"]):
            continue
        node = Node(tag, *_marks(tag, m[3]))
        stack[-1].parts.append(node)
        if tag not in VOID:
            stack.append(node)
            still[tag] += 1
    return root


def spaced(text: str) -> str:
    """Character references decoded, runs of white space as one space, trimmed."""
    return " ".join(entities.unescape(text).split())


def _digest(root: Node) -> None:
    """Hash of each subtree: its tag and, in order, its texts and the hashes of its children; and whether it holds an article."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(p for p in node.parts if isinstance(p, Node))
    for node in reversed(order):  # children before parents
        h = xxhash.xxh64(node.tag)
        for part in node.parts:
            if isinstance(part, Node):
                h.update(part.digest.to_bytes(8, "little"))
                node.holds |= part.holds or part.tag in ("article", "main")
                node.headed |= part.headed
            elif text := " ".join(part.split()):
                h.update(b"\0" + text.encode("utf-8", "surrogatepass"))
        node.digest = h.intdigest()


def _side(parts: list, i: int, step: int) -> bytes:
    """What stands before or after a part: the hash of an element, a text, or nothing at the edge."""
    i += step
    while 0 <= i < len(parts):
        if isinstance(parts[i], Node):
            return parts[i].digest.to_bytes(8, "little")
        if text := " ".join(parts[i].split()):
            return b"\0" + text.encode("utf-8", "surrogatepass")
        i += step
    return b"\1"


def below(chain: int, tag: str) -> int:
    """Hash of a chain of elements, longer by one; never 0, which stands for outside of articles."""
    return xxhash.xxh64_intdigest(tag, seed=chain) | 1


def places(chain: int, parts: list, i: int, before: int, after: int) -> set[int]:
    """Hashes of an element inside an article, each with the chain of elements around it and one fact about its place:
    how many elements precede or follow it, what stands before it, what after it."""
    own = parts[i].digest.to_bytes(8, "little") + chain.to_bytes(8, "little")
    facts = (b"n<%d" % before, b"n>%d" % after, b"<" + _side(parts, i, -1), b">" + _side(parts, i, 1))
    return {xxhash.xxh64_intdigest(own + fact) for fact in facts}


def _elements(node: Node) -> int:
    return sum(isinstance(p, Node) for p in node.parts)


def subtrees(root: Node, prose: bool = False) -> tuple[set[int], set[int]]:
    """Hashes of the elements that a site's template may hold, and those of them that no mark removes anyway.

    Containers, outside articles with ``prose`` also paragraphs, headings, cells and so on. Inside an
    article, and inside a main element that holds none, an element counts by its ``places``.
    """
    found: set[int] = set()
    live: set[int] = set()
    never = WHOLE if prose else PROSE
    stack: list[tuple[Node, int, bool]] = [(root, 0, False)]
    while stack:
        node, chain, gone = stack.pop()
        n, k = _elements(node), 0
        for i, part in enumerate(node.parts):
            if not isinstance(part, Node):
                continue
            dead = gone or part.marked and not _own_header(part, chain)
            own: set[int] = set()
            if chain:
                if part.tag not in KEPT_INSIDE:
                    own = places(chain, node.parts, i, k, n - k - 1)
            elif part.tag not in never:
                own = {part.digest}
            found |= own
            if not dead:
                live |= own
            stack.append((part, _chain_of(part, chain), dead))
            k += 1
    return found, live


def _own_header(node: Node, chain: int) -> bool:
    """An article's header, furniture by its tag alone, which stays."""
    return bool(chain) and node.tag == "header" and not node.named


def _chain_of(node: Node, chain: int) -> int:
    inside = chain or node.tag == "article" or node.tag == "main" and not node.holds
    return below(chain, node.tag) if inside else 0


def content_key(root: Node) -> int | None:
    """Hash of the outermost articles, else main elements, of a page; None if it has none."""
    for tag in ("article", "main"):
        found, stack = [], [root]
        while stack:
            node = stack.pop()
            if node.tag == tag and not node.marked:
                found.append(node.digest)
            else:
                stack.extend(p for p in reversed(node.parts) if isinstance(p, Node))
        if found:
            return xxhash.xxh64_intdigest(b"".join(d.to_bytes(8, "little") for d in found))
    return None


def main_nodes(root: Node, template: frozenset[int]) -> list[Node]:
    """The outermost articles; else main elements, else elements whose role or class says content, else the whole page."""
    levels: dict[str, list[Node]] = {"article": [], "main": [], "content": []}
    stack = [(root, frozenset())]
    while stack:
        node, above = stack.pop()
        if node.marked or node.digest in template and not node.holds:
            continue
        kind = node.tag if node.tag in ("article", "main") else "content" if node.content else ""
        if kind and kind not in above:
            levels[kind].append(node)
            above = above | {kind}
        stack.extend((p, above) for p in reversed(node.parts) if isinstance(p, Node))
    return levels["article"] or levels["main"] or levels["content"] or [root]


def blocks(node: Node, template: frozenset[int], chain: int = 0) -> Iterator[str]:
    """Texts of the blocks below ``node`` in page order, furniture and template subtrees left out.

    ``chain`` is 0 outside articles. An article's own header stays; an article without a heading inside
    another one is a reader's comment.
    """
    stack = [(node, 0, 0, _elements(node), chain, [])]
    while stack:
        node, i, k, n, chain, text = stack.pop()
        descended = False
        while i < len(node.parts):
            part, i = node.parts[i], i + 1
            if isinstance(part, str):
                text.append(part)
                continue
            k += 1
            if block := spaced("".join(text)):
                yield block
            text = []
            if part.marked and not _own_header(part, chain) or chain and part.tag == "article" and not part.headed:
                continue
            if template:
                if not chain:
                    if part.digest in template:
                        continue
                elif part.tag not in KEPT_INSIDE and not template.isdisjoint(places(chain, node.parts, i - 1, k - 1, n - k)):
                    continue
            stack.append((node, i, k, n, chain, text))
            stack.append((part, 0, 0, _elements(part), _chain_of(part, chain), []))
            descended = True
            break
        if not descended and (block := spaced("".join(text))):
            yield block


def main_text(page: str, template: frozenset[int] = frozenset()) -> str:
    root = parse(page)
    _digest(root)
    return "\n".join(b for node in main_nodes(root, template) for b in blocks(node, template, _chain_of(node, 0)))


def host_of(url_col: str):
    """Host of a url, in small letters, without user and port; null if there is none."""
    host = F.lower(F.regexp_extract(F.col(url_col).cast("string"), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def templates(pages: DataFrame, url_col: str = "url", html_col: str = "html", least_pages: int = LEAST_PAGES, least_share: float = 0.0, prose: bool = False) -> DataFrame:
    """(host, page, hashes): those subtrees of a page, of the ones no mark removes, that stand on at least ``least_pages`` different pages of its host.

    ``page`` is the hash of the html. Pages with equal html, or with equal articles (else main elements),
    count once, so copies of a page or of its article don't make it a template. ``prose`` elements are
    counted where asked. A ``least_share`` asks for that share of a host's different pages as well.
    """
    schema = T.StructType([T.StructField("host", T.StringType()), T.StructField("page", T.LongType()), T.StructField("content", T.LongType()), T.StructField("hashes", T.ArrayType(T.LongType())), T.StructField("live", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents, found, live = [], [], []
            for key, page in zip(batch.column(1), batch.column(2)):
                root = parse(page.as_py())
                _digest(root)
                own = content_key(root)
                contents.append(key.as_py() if own is None else _signed(own))
                for out, hashes in zip((found, live), subtrees(root, prose)):
                    out.append([_signed(h) for h in hashes])
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(contents, pa.int64()), *[pa.array(x, pa.list_(pa.int64())) for x in (found, live)]], names=schema.names)

    html = F.col(html_col).cast("string")
    rows = pages.select(host_of(url_col).alias("host"), F.xxhash64(html).alias("page"), html.alias("html")).filter("host is not null and html is not null")
    seen = materialize(rows.mapInArrow(run, schema).groupBy("host", "page").agg(F.first("content").alias("content"), F.first("hashes").alias("hashes"), F.first("live").alias("live")), "subtrees")
    pairs = seen.select("host", "page", "content", F.explode("hashes").alias("hash"))
    often = pairs.groupBy("host", "hash").agg(F.count_distinct("content").alias("n")).filter(F.col("n") >= least_pages)
    if least_share > 0:
        sizes = seen.groupBy("host").agg(F.count_distinct("content").alias("n_pages"))
        often = often.join(sizes, "host").filter(F.col("n") >= F.col("n_pages") * least_share)
    # Only what a page would still show: its menus, which the whole host shares, are no keys of this join.
    own = seen.select("host", "page", F.explode("live").alias("hash")).join(often.select("host", "hash"), ["host", "hash"])
    return own.groupBy("host", "page").agg(F.collect_list("hash").alias("hashes"))


def _signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


def extract(pages: DataFrame, id_cols: list[str] | None = None, url_col: str = "url", html_col: str = "html", **limits) -> DataFrame:
    """``id_cols`` (default: page_id and the url) of every row with ``text``; an id column of that name becomes ``text_in``.

    Null and empty html give an empty text. A page without a host has no template. Repeated rows are
    extracted alike; no row, block or length is dropped. A page without an article or main element
    keeps all that neither its host's template nor an element's marks remove. With ``prose`` in ``limits``
    recurring paragraphs, headings, cells and so on outside articles are template too, else only containers are.
    """
    own = id_cols or ["page_id", url_col]
    names = [f"k{i}" for i in range(len(own))]
    found = materialize(templates(pages, url_col, html_col, **limits), "templates")
    rows = pages.select(*[F.col(c).alias(n) for c, n in zip(own, names)], host_of(url_col).alias("host"), F.col(html_col).cast("string").alias("html"))
    rows = rows.withColumn("page", F.xxhash64("html")).join(found, ["host", "page"], "left").select(*names, "html", "hashes")
    schema = T.StructType([*[f for f in rows.schema if f.name in names], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, hashes in zip(batch.column(len(names)), batch.column(len(names) + 1)):
                page = page.as_py()
                texts.append(main_text(page, frozenset(h & 0xFFFFFFFFFFFFFFFF for h in hashes.as_py() or ())) if page else "")
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(texts, pa.string())], names=[*names, "text"])

    return rows.mapInArrow(run, schema).select(*[F.col(n).alias("text_in" if c.lower() == "text" else c) for n, c in zip(names, own)], "text")
