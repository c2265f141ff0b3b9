"""HTML extraction by inferred wrappers (union-free regular expressions).

A page is a stream of tags and texts. Repeats in it are folded into groups
``( ... )+``. The folded streams of one host are aligned one after the other:
equal tags match, differing texts become text slots, groups match groups and
are aligned inside, and what only one side has becomes optional. What is left is
the host's wrapper. It tells the page's main container (the element that holds most
of the text that varies and is neither links nor page furniture) and which texts
are the same on page after page where a page has no such container.

Every page of a host takes part: tasks fold their pages into one stream per
host and structure, and these are aligned in two rounds (by host and a salt, then by
host), each streaming over its rows, so that a host with a third of all
pages is neither one group nor one task's work. For extraction, the wrapper names the
container, and a page gives all texts under it that are no furniture, those that are the
same on every page included (a heading that all articles share looks no different from a
notice). Only a page of a host without a container is aligned with the wrapper, and gives
the texts that are not constant there.

Page furniture is known by its element or by a word in its class, id or role
(see the fixed lists); scripts, styles, forms and comments never give text. An element
is a sure sign; a word is evidence only, a whole value more than a part of one: inside an
article parts do not count, and a word is set aside on hosts where the elements it marks
hold the only article or most of the text that varies (``release``).

Defined edge cases: null or empty html gives "" ; a page without a host in its url
(or without a url) belongs to host ""; very long pages are read whole; a host with
one page has that page as its wrapper; a page without the main container gives all
text outside furniture; an element
such as svg or object that is never closed holds text up to the next block or its parent's end; rows that repeat a page_id are pages of their own; an
empty table gives an empty result; further columns do not matter.
"""

from __future__ import annotations

import html as entities
import marshal
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import cut, slices

# HTML elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())  # no tags inside; without an end tag they hold the rest of the page
OPAQUE = frozenset("noscript template iframe object svg math canvas select".split())  # nothing inside is text of the page
BLOCK = frozenset("address article aside blockquote dd details div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main "
                  "nav ol p pre section table ul".split())
FURNITURE = frozenset("nav footer aside form menu dialog button head".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr".split())
MAIN = frozenset("article main".split())
FRAME = frozenset("html body article main".split())  # never furniture by the words in their class
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words in a class, id or role that mark page furniture.
FURNITURE_WORDS = frozenset("ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent "
                            "cookie cookies copyright disclaimer disqus footer header login masthead menu modal nav navbar navigation "
                            "newsletter notice notification pager pagination popup promo promotion recommended related respond share "
                            "sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split())
# Two words that count as one whole value.
FURNITURE_PAIRS = frozenset("ad-banner ad-box ad-container ad-slot ad-unit ad-wrapper alert-banner author-social comment-form comment-list "
                            "comment-respond comment-section comments-area comments-list comments-section cookie-banner cookie-bar "
                            "cookie-consent cookie-notice login-form main-menu main-nav nav-bar nav-menu newsletter-form "
                            "newsletter-signup page-footer promo-box related-articles related-content related-links related-posts "
                            "related-stories share-bar share-buttons share-links sharing-buttons side-bar sidebar-left sidebar-right "
                            "site-footer site-header site-navigation social-buttons social-icons social-links social-media "
                            "social-share sponsored-content user-comments".split())
OTHERS = frozenset("comment comments disqus recommended related respond".split())  # texts of readers and of other pages, often long
# Words that name readers' comments and adverts in whatever company, and words that say how a page
# deals with them ("has-comments", "ad-free") rather than what an element holds.
INTRUDERS = frozenset("ad ads advert adverts advertisement advertising comment comments disqus newsletter promo promotion sponsor "
                      "sponsored".split())
STATES = frozenset("allow allowed closed content count disabled enabled free has hide layout main no open page show with without".split())
WEAK, STRONG, APART = "~", "!", "!!"  # last part of a marked element's label: part of a value, whole value, whole value of OTHERS

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
                   r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.DOTALL)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
LONGEST_UNIT = 12  # tokens of a repeated unit that is found directly; longer ones fold from inside out
SALTS = 16
CONSTANT_PAGES = 3  # pages that must agree before a text without a container counts as furniture


@dataclass
class Node:
    """A tag (label), a text (label ``#``) or a repeated group (label ``+``)."""
    label: str
    text: str | None = None  # constant text, None for a slot
    optional: bool = False
    pages: int = 1
    chars: dict[tuple[str, ...], int] = field(default_factory=dict)  # length of a text by the marks around it
    inner: list[Node] = field(default_factory=list)
    where: list[int] = field(default_factory=list)  # tokens of the page at hand
    key: str = ""

    def __post_init__(self):
        self.key = self.key or (f"({' '.join(n.key for n in self.inner)})+" if self.label == "+" else self.label)


@dataclass
class Token:
    label: str  # name.words, /name or #
    name: str
    text: str = ""
    furniture: bool = False  # by its element
    article: bool = False
    linked: bool = False
    marks: tuple[str, ...] = ()  # labels of the marked elements around it, outer first, "" for an article element


def _values(rest: str) -> list[tuple[str, list[str]]]:
    """Attribute and words of every value in class, id and role."""
    return [(name.lower(), [w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", v).lower()) if w])
            for name, a, b, c in ATTRIBUTE.findall(rest) for v in (a or b or c).split()]


def _mark(name: str, values: list[tuple[str, list[str]]], article: bool, inside: bool) -> str:
    """How the words of an element mark it: not at all, WEAK, STRONG or APART."""
    found = ""
    for attribute, words in values:
        marked = FURNITURE_WORDS.intersection(words)
        if (not marked or name in FRAME and not (name == "article" and "comment" in marked)
                or attribute == "id" and (name in HEADINGS or name == "section" and article and not marked & INTRUDERS)
                or article and marked <= {"header"}):
            continue
        if len(words) == 1 or "-".join(words) in FURNITURE_PAIRS:
            found = APART if found == APART or marked & OTHERS else STRONG
        elif name not in HEADINGS and marked & INTRUDERS:
            found = APART if marked & OTHERS and not STATES.intersection(words) else found or WEAK
        elif not inside and name not in HEADINGS and not (attribute == "id" and name == "section"):
            found = found or WEAK
    return found


def _hidden(marks: tuple[str, ...], free: frozenset[str]) -> bool:
    return any(m and m not in free for m in marks)


def _events(page: str) -> list[tuple[str, str, str]]:
    """Tags and texts as (kind, name, rest or text), kind "<", "/" or "#", without what stands in RAW and OPAQUE
    elements. One of OPAQUE that its parent's end (or the page's) finds open ends where the first block in it starts."""
    out: list[tuple[str, str, str]] = []
    opaque: list[int] = []  # places of the OPAQUE start tags
    at, end = 0, len(page)
    while at < end:
        found = TOKEN.search(page, at)
        stop = found.start() if found else end
        if stop > at and not page[at:stop].isspace():
            out.append(("#", "#", page[at:stop]))
        if not found:
            break
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        if name in RAW and not found["end"]:
            close = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
            at = close.end() if close else end
            continue
        if name in OPAQUE and not found["end"]:
            if found["rest"].endswith("/"):
                continue
            opaque.append(len(out))
        out.append(("/" if found["end"] else "<", name, found["rest"]))
    if not opaque:
        return out
    stack: list[tuple[str, int]] = []
    blocks: dict[int, int] = {}  # place of an OPAQUE start tag -> place of the first block in it
    waiting: list[int] = []
    ends: dict[int, int] = {}  # place of an OPAQUE start tag -> place behind what it holds

    def leave(depth: int, place: int, closed: bool):
        for i, (name, start) in enumerate(stack[depth:]):
            if name in OPAQUE:
                ends[start] = place + 1 if closed and i == 0 else blocks.get(start, place)
        del stack[depth:]

    for place, (kind, name, rest) in enumerate(out):
        if kind == "/":
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None:
                leave(depth, place, True)
        elif kind == "<":
            if name in BLOCK:
                blocks.update(dict.fromkeys(waiting, place))
                waiting.clear()
            if name not in VOID and not rest.endswith("/"):
                stack.append((name, place))
                if name in OPAQUE:
                    waiting.append(place)
    leave(0, len(out), False)
    kept, at = [], 0
    for start in opaque:
        if start >= at:
            kept += out[at:start]
            at = ends[start]
    return kept + out[at:]


def tokens(page: str) -> list[Token]:
    """Tags and texts of a page, each with the zone it stands in."""
    out: list[Token] = []
    stack: list[tuple] = []  # name, furniture, article, link, marks, inside an article element
    zone: tuple = (False, False, False, (), False)
    for kind, name, rest in _events(page):
        if kind == "#":
            out.append(Token("#", "#", rest, *zone[:4]))
            continue
        if kind == "/":
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None:
                del stack[depth:]
                zone = stack[-1][1:] if stack else (False, False, False, (), False)
                out.append(Token(f"/{name}", name, "", *zone[:4]))
            continue
        values = _values(rest) if rest else []
        furniture, article, linked, marks, inside = zone
        furniture |= name in FURNITURE or name == "header" and not article
        empty = name in VOID or rest.endswith("/")
        mark = _mark(name, values, article, inside) if values and not empty else ""
        label = ".".join([name, *sorted({w for _, words in values for w in words}), *([mark] if mark else [])])
        marks += (label,) * bool(mark) + ("",) * (name in MAIN and mark in ("", WEAK))
        zone_here = (furniture, article or name in MAIN, linked or name == "a", marks, inside or name == "article")
        out.append(Token(label, name, "", *zone_here[:4]))
        if not empty:
            stack.append((name, *zone_here))
            zone = zone_here
    return out


def release(texts: Iterable[tuple[tuple[str, ...], int]], pages: int) -> frozenset[str]:
    """Labels of marked elements that are no furniture, from the marks around the texts
    and their length. Innermost marks are looked at first, until nothing changes."""
    sizes: dict[tuple[str, ...], int] = {}
    for marks, chars in texts:
        if chars:
            sizes[marks] = sizes.get(marks, 0) + chars
    out: set[str] = set()
    while True:
        held: dict[str, int] = {}
        mains: dict[str, int] = {}
        plain, article = 0, False
        for marks, chars in sizes.items():
            at = next((i for i in range(len(marks) - 1, -1, -1) if marks[i] and marks[i] not in out), None)
            if at is None:
                plain += chars
                article |= "" in marks
            else:
                held[marks[at]] = held.get(marks[at], 0) + chars
                if "" in marks[at + 1:]:
                    mains[marks[at]] = mains.get(marks[at], 0) + chars
        rest = plain + sum(n for x, n in held.items() if not x.endswith(APART))

        def whole(x: str) -> bool:
            if not article and x in mains and (x.endswith(WEAK) or mains[x] > plain):
                return True
            if x.endswith(APART):
                return not rest
            return 2 * held[x] > rest and (x.endswith(WEAK) or pages >= CONSTANT_PAGES or not plain)

        new = {x for x in held if whole(x)}
        if not new:
            return frozenset(out)
        out |= new


def _fold(nodes: list[Node]) -> list[Node]:
    """Adjacent equal units become one group each, short units first."""
    unit = 1
    while unit <= min(LONGEST_UNIT, len(nodes) // 2):
        keys, out, i, folded = [n.key for n in nodes], [], 0, False
        while i < len(nodes):
            first = keys[i:i + unit]
            j = i + unit
            while keys[j:j + unit] == first and len(first) == unit:
                j += unit
            if j > i + unit and not (unit == 1 and nodes[i].label == "+"):
                group = nodes[i:i + unit]
                for k in range(i + unit, j, unit):
                    group = [_same(a, b) for a, b in zip(group, nodes[k:k + unit], strict=True)]
                out.append(Node("+", inner=group))
                i, folded = j, True
            else:
                out.append(nodes[i])
                i += 1
        nodes = out
        unit = 1 if folded and unit > 1 else unit + 1
    return nodes


def _sum(a: dict, b: dict) -> dict:
    return {k: a.get(k, 0) + b.get(k, 0) for k in (*a, *b)} if a and b else dict(a or b)


def _same(a: Node, b: Node) -> Node:
    """Two nodes of one structure on the same page or on pages of the same structure."""
    inner = [_same(x, y) for x, y in zip(a.inner, b.inner, strict=True)]
    return Node(a.label, a.text if a.text == b.text else None, a.optional or b.optional, max(a.pages, b.pages),
                _sum(a.chars, b.chars), inner, a.where + b.where, a.key)


def _seen_together(a: Node, b: Node) -> Node:
    """The same node on further pages: pages add up."""
    out = _same(a, b)
    out.pages = a.pages + b.pages
    out.inner = [_seen_together(x, y) for x, y in zip(a.inner, b.inner, strict=True)]
    return out


def folded(stream: list[Token]) -> list[Node]:
    nodes = [Node(t.label, " ".join(t.text.split()) if t.label == "#" else None,
                  chars={} if t.label != "#" or t.furniture or t.linked else {t.marks: len(t.text)}, where=[i])
             for i, t in enumerate(stream)]
    return _fold(nodes)


def _meets(a: Node, b: Node) -> bool:
    return a.label == b.label and (a.label != "+" or a.inner[0].key == b.inner[0].key)


def paired(a: list[Node], b: list[Node]) -> list[tuple[int, int]]:
    """A longest common alignment as (place in a, place in b), ends first."""
    lo = 0
    while lo < min(len(a), len(b)) and _meets(a[lo], b[lo]):
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and _meets(a[-1 - hi], b[-1 - hi]):
        hi += 1
    x, y = a[lo:len(a) - hi], b[lo:len(b) - hi]
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(len(y) - 1, -1, -1):
            row[j] = 1 + below[j + 1] if _meets(x[i], y[j]) else max(below[j], row[j + 1])
    out, i, j = [(k, k) for k in range(lo)], 0, 0
    while i < len(x) and j < len(y):
        if _meets(x[i], y[j]):
            out.append((lo + i, lo + j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out + [(len(a) - hi + k, len(b) - hi + k) for k in range(hi)]


def align(a: list[Node], b: list[Node]) -> list[Node]:
    """The wrapper of everything that ``a`` and ``b`` stand for."""
    out, i, j = [], 0, 0
    for x, y in [*paired(a, b), (len(a), len(b))]:
        for extra in (*a[i:x], *b[j:y]):
            extra.optional = True
            out.append(extra)
        if x < len(a):
            p, q = a[x], b[y]
            inner = align(p.inner, q.inner) if p.label == "+" else []
            out.append(Node(p.label, p.text if p.text == q.text else None, p.optional or q.optional, p.pages + q.pages,
                            _sum(p.chars, q.chars), inner))
        i, j = x + 1, y + 1
    return out


def pattern(nodes: list[Node]) -> str:
    """The wrapper as a readable union-free expression."""
    def one(n: Node) -> str:
        body = (f"({pattern(n.inner)})+" if n.label == "+" else "#TEXT" if n.label == "#" and n.text is None
                else n.text if n.label == "#" else f"<{n.label}>")
        return f"({body})?" if n.optional else body

    return " ".join(map(one, nodes))


def stored(nodes: list[Node]) -> bytes:
    def plain(n: Node) -> tuple:
        return n.label, n.text, n.optional, n.pages, n.chars, [plain(x) for x in n.inner]

    return marshal.dumps([plain(n) for n in nodes])


def restored(data: bytes) -> list[Node]:
    def node(label, text, optional, pages, chars, inner) -> Node:
        return Node(label, text, optional, pages, chars, [node(*x) for x in inner])

    return [node(*x) for x in marshal.loads(data)]


def _flat(nodes: list[Node]) -> Iterator[Node]:
    for n in nodes:
        if n.label == "+":
            yield from _flat(n.inner)
        else:
            yield n


def _varies(n: Node) -> bool:
    return n.label == "#" and (n.text is None or n.pages < CONSTANT_PAGES)


def released(wrapper: list[Node]) -> frozenset[str]:
    """Labels of marked elements that are no furniture on this host."""
    texts = [n for n in _flat(wrapper) if _varies(n)]
    return release((x for n in texts for x in n.chars.items()), max((n.pages for n in texts), default=0))


def main_label(wrapper: list[Node], free: frozenset[str] = frozenset()) -> str | None:
    """The start tag of the main container: an article element if there is one,
    else the innermost element with half of the varying text, None for the page."""
    held: dict[str, int] = {}
    depth: dict[str, int] = {}
    stack: list[str] = []
    total = 0
    for n in _flat(wrapper):
        name = n.label.split(".")[0]
        if n.label == "#":
            if _varies(n):
                chars = sum(size for marks, size in n.chars.items() if not _hidden(marks, free))
                total += chars
                for label in set(stack):
                    held[label] = held.get(label, 0) + chars
        elif name.startswith("/"):
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].split(".")[0] == name[1:]), None)
            if at is not None:
                del stack[at:]
        elif name not in VOID and name not in INLINE and name != "p":
            stack.append(n.label)
            depth[n.label] = max(depth.get(n.label, 0), len(stack))
    articles = [x for x in held if x.split(".")[0] in MAIN and held[x]]
    if articles:
        return max(articles, key=lambda x: (held[x], depth[x], x))
    half = [x for x in held if 2 * held[x] > total and x.split(".")[0] not in FRAME]
    return max(half, key=lambda x: (depth[x], held[x], x)) if half else None


def _constant(nodes: list[Node], wrapper: list[Node], out: set[int]) -> None:
    """Tokens of the page whose text the wrapper has as constant."""
    for i, j in paired(wrapper, nodes):
        if nodes[j].label == "+":
            _constant(nodes[j].inner, wrapper[i].inner, out)
        elif nodes[j].label == "#" and wrapper[i].text is not None and wrapper[i].pages >= CONSTANT_PAGES:
            out.update(nodes[j].where)


def main_text(page: str | None, wrapper: list[Node] | None, container: str | None, free: frozenset[str] = frozenset()) -> str:
    """The blocks of the page's main text, one per line."""
    stream = tokens(page or "")

    def furniture(t: Token) -> bool:
        return t.furniture or _hidden(t.marks, free)

    if not any((t.label == container if container else t.label == "#") and not furniture(t) for t in stream):
        free |= release(((t.marks, len(t.text)) for t in stream if t.label == "#" and not t.furniture and not t.linked), 1)
        if container is not None and not any(t.label == container and not furniture(t) for t in stream):
            container = next((t.label for t in stream if t.name in MAIN and not furniture(t)), None)
    constant: set[int] = set()
    if wrapper and container is None:
        _constant(folded(stream), wrapper, constant)
    blocks: list[list[str]] = [[]]
    inside, name = 0, container.split(".")[0] if container else ""
    for i, t in enumerate(stream):
        if t.label == "#":
            if (container is None or inside) and i not in constant and not furniture(t):
                blocks[-1].append(entities.unescape(t.text))
            continue
        if container is not None:
            if t.label == container and not inside and not furniture(t):
                inside = 1
            elif inside and t.name == name:
                inside += -1 if t.label.startswith("/") else 1
        if t.name == "br":
            blocks[-1].append(" ")
        elif t.name not in INLINE:
            blocks.append([])
    lines = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def host_of(url: str = "url"):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _aligned(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.RecordBatch]:
    """One wrapper per key, from rows sorted by it; holds one wrapper at a time."""
    last, wrapper, schema = None, None, None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([v], schema.field(k).type) for k, v in zip(key, last, strict=True)]
                                          + [pa.array([stored(wrapper)], pa.binary())], [*key, "nodes"])

    for batch in batches:
        schema = batch.schema
        for *k, nodes in zip(*(batch.column(n).to_pylist() for n in (*key, "nodes")), strict=True):
            nodes = restored(nodes)
            if k != last:
                if last is not None:
                    yield row()
                last, wrapper = k, nodes
            else:
                wrapper = align(wrapper, nodes)
    if last is not None:
        yield row()


def infer(pages: DataFrame) -> DataFrame:
    """host, nodes: the stored wrapper of every host, from all of its pages."""
    def structures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], list[Node]] = {}

        def emit():
            for (host, structure), nodes in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([host]), pa.array([structure]), pa.array([stored(nodes)], pa.binary())],
                                                 ["host", "structure", "nodes"])

        for part in slices(batches):
            for host, page in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                nodes = folded(tokens(page))
                for n in _flat(nodes):
                    n.where = []
                key = (host, " ".join(n.key for n in nodes))
                held[key] = [_seen_together(a, b) for a, b in zip(held[key], nodes, strict=True)] if key in held else nodes
            if len(held) > 2000:
                yield from emit()
                held.clear()
        yield from emit()

    parts = (pages.select(host_of().alias("host"), "html").where("html IS NOT NULL")
             .mapInArrow(structures, "host string, structure string, nodes binary")
             .withColumn("salt", F.pmod(F.xxhash64("structure"), F.lit(SALTS)).cast("int")))
    salted = (parts.repartition("host", "salt").sortWithinPartitions("host", "salt", F.length("structure"), "structure")
              .select("host", "salt", "nodes").mapInArrow(lambda b: _aligned(b, ["host", "salt"]), "host string, salt int, nodes binary"))
    return (salted.repartition("host").sortWithinPartitions("host", "salt").select("host", "nodes")
            .mapInArrow(lambda b: _aligned(b, ["host"]), "host string, nodes binary"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``."""
    wrappers = cut(infer(pages), "wrappers")
    joined = pages.select("page_id", "url", "html", host_of().alias("host")).join(wrappers, "host", "left")
    schema = T.StructType([pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple] = {}
        for part in slices(batches):
            texts = []
            for host, page, nodes in zip(*(part.column(n).to_pylist() for n in ("host", "html", "nodes")), strict=True):
                if host not in known:
                    if len(known) >= 256:
                        known.clear()
                    wrapper = restored(nodes) if nodes else None
                    free = released(wrapper) if wrapper else frozenset()
                    known[host] = (wrapper, main_label(wrapper, free) if wrapper else None, free)
                texts.append(main_text(page, *known[host]))
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, schema)
