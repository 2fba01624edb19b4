"""Main text of web pages by consensus host paths.

Every page's containers are scored by the clean text they hold and by how
little else they hold. Containers are named by their generalised path (tags
with classes, digits taken off, from the body down); each page of a
host votes for its best path, and each page is read again from the containers
on its host's winning path. A page without that path falls back on its own
best container.

Within the container go: scripts, styles, forms, menus, footers, sidebars,
notices, adverts and reader comments, and headers but for their headings. They
are known by their tag, or as blocks (never headings, paragraphs or inline
elements) by a role, class or id that says nothing else and by their looks: a
plain name such as ``ad`` counts for a block that is mostly links, short or less
than half of the page, a name that article sections may also have such as
``search`` only for one that is mostly links, or little text without a heading.
A name with a marking word among others counts only for a block that is mostly
links; one with ``comment`` also for a block of several like parts, or of several
parts without a heading, or where the page has several such blocks. Character references are decoded, white space becomes
one space, blocks are joined in page order by one space.

Cases: null and empty html give an empty text; null urls share one host;
unclosed and stray tags are repaired as they come, at any depth; an unclosed comment or
script runs to the end; repeated rows give repeated rows; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulus.llm.common import row_slices, scratch_table
from cumulus.operators.joins import bounded_broadcast

MAX_HOSTS_BROADCAST = 200_000
LONGEST_PATH = 400  # characters; a longer path goes on from the hash of its upper part
_OPEN = re.compile(r"<!--|<(?=/?[a-zA-Z])|<[!?]")
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>"']*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_NAMES = re.compile(r"""(?i)\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
# Element kinds of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title template iframe select".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "svg math noscript mi mn mo ms mtext mrow msub msup msubsup mfrac msqrt mroot mover munder munderover mstyle mspace semantics".split()
)
CONTAINERS = frozenset("body article main section div td".split())
DROPPED = frozenset("nav footer aside form button menu dialog head".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FOREIGN = frozenset({"svg", "math"})  # within them "/>" closes and no tag closes a paragraph
SHORT = 500  # characters of a plainly named block that need no comparison with the page
NAMED = frozenset("div section ul ol dl table td li header".split())  # blocks that names can mark
ROLES = frozenset("navigation search contentinfo complementary banner menu menubar toolbar dialog".split())
# Names that mark boilerplate: a class or id made of them and of words for its place only.
PLAIN = frozenset(
    "ad ads adsbygoogle advert advertisement adverts breadcrumb breadcrumbs consent cookie cookies footer gdpr masthead nav navbar newsletter "
    "pager pagination sidebar signup sponsored".split()
)
READERS = frozenset("commentlist comments disqus respond replies".split())  # may be longer than the article
COMMENT = frozenset({"comment"})
LOOSE = frozenset(
    "alert banner header menu modal navigation notice popup promo related search share sharing social sponsor subscribe tags toolbar widget".split()
)
LINKED = frozenset("more read readmore stories".split())  # of a block of links
PLACES = frozenset(
    "area article bar block bottom box button buttons container entry global icons inner item items left link links list main outer page panel "
    "post posts primary reader readers right secondary section site slot top user wrap wrapper".split()
)
_MARKING = PLAIN | READERS | COMMENT | LOOSE
_PARTS = frozenset("li div article section dl blockquote".split())
_WORD = re.compile(r"[a-z]+")
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

# Open elements at which the search for one to close implicitly stops, or that it closes.
_MARKS = CONTAINERS | {"p", "ul", "ol", "dl", "table"}.union(*_SAME.values())


def _below(path: str, own: str) -> str:
    path = f"{path}/{own}"
    return path if len(path) <= LONGEST_PATH else "~" + hashlib.blake2b(path.encode("utf-8", "replace"), digest_size=16).hexdigest()


class _Element:
    __slots__ = ("tag", "path", "dropped", "header", "heading", "link", "clean", "total", "out", "container", "foreign", "named", "heads", "parts")

    def __init__(self, tag="", path="", parent=None, dropped=False):
        self.tag, self.path = tag, path
        self.clean = self.total = 0
        self.out = None
        self.container = tag in CONTAINERS or parent is None  # the page itself is one
        self.named = None
        self.heads = 0
        self.parts = []  # tags of the blocks right below
        if parent is None:
            self.dropped = self.header = self.heading = self.link = self.foreign = False
            return
        self.dropped = parent.dropped or tag in DROPPED or dropped
        self.foreign = parent.foreign or tag in FOREIGN
        self.header = tag == "header" or parent.header
        self.heading = tag in HEADINGS or parent.heading
        self.link = tag == "a" or parent.link


def _kind(names: list[str]) -> str:
    """``readers``, ``plain``, ``comment``, ``loose`` or ``linked`` if one of the classes and ids marks boilerplate, else empty."""
    found = set()
    for name in names:
        words = set(_WORD.findall(name.lower())) - PLACES
        if not words <= _MARKING:
            if words & _MARKING or words <= LINKED:
                found.add("linked")
            continue
        for kind, marks in (("plain", PLAIN), ("readers", READERS), ("comment", COMMENT), ("loose", LOOSE)):
            if words & marks:
                found.add(kind)
    return next((k for k in ("readers", "plain", "comment", "loose", "linked") if k in found), "")


def _looks_so(kind: str, clean: int, total: int, heads: int, parts: list[str], page_clean: int, comments: int) -> bool:
    """Whether a named block of ``clean`` of ``total`` characters outside links looks like boilerplate."""
    if 2 * clean <= total:
        return True
    if kind == "linked":
        return False
    if kind == "comment":
        alike = max((parts.count(t) for t in _PARTS.intersection(parts)), default=0)
        if comments > 1 or alike > 1 or len(parts) > 1 and not heads:
            return clean < page_clean
        kind = "loose"
    if kind == "loose":
        return not heads and 20 * clean < page_clean
    if kind == "readers":
        return clean < page_clean
    return clean < SHORT or 2 * clean < page_clean


def _tag_ends(page: str, start: int) -> Callable[[int], int]:
    """From ``start`` on: the first ``>`` outside quotes behind a place, or -1; one pass over quotes and brackets."""
    spots = [m.start() for m in re.compile("[\"'>]").finditer(page, start)]
    ends, later = [-1] * (len(spots) + 1), {}
    for k in range(len(spots) - 1, -1, -1):
        mark = page[spots[k]]
        if mark == ">":
            ends[k] = spots[k]
        else:
            ends[k] = ends[later[mark] + 1] if mark in later else -1
            later[mark] = k
    return lambda place: ends[bisect_left(spots, place)]


def _pieces(page: str):
    """``(text, None, None)``, ``(None, tag, attributes)`` or ``(None, "/" + tag, None)`` in page order.

    A ``<`` whose tag never ends is text. No part of a page is looked at more
    than a few times: the first such tag makes a table of all later tag ends.
    """
    at = look = 0
    n, last, ends = len(page), page.rfind(">"), None
    while m := _OPEN.search(page, look):
        opened = m.start()
        if m.group() == "<!--":
            end = page.find("-->", m.end())
            stop = n if end < 0 else end + 3
            piece = None
        elif opened > last:
            look = m.end()
            continue
        elif m.group() != "<":
            stop, piece = page.find(">", m.end()) + 1, None
        else:
            found = _TAG.match(page, opened, last + 1) if ends is None else None
            if found is None:
                ends = ends or _tag_ends(page, opened)
                end = ends(m.end())
                found = _TAG.match(page, opened, end + 1) if end >= 0 else None
            if found is None:
                look = m.end()
                continue
            closing, tag, attributes = found.groups()
            tag, stop = tag.lower(), found.end()
            if closing:
                piece = None, "/" + tag, None
            elif tag in RAW:
                piece = None
                if not attributes.endswith("/"):
                    # Up to the last ">" every end tag has an end, so the search stops at the first one.
                    end = re.compile(f"(?i)</{re.escape(tag)}\\b[^>]*>").search(page, stop, last + 1)
                    stop = n if end is None else end.end()
            else:
                piece = None, tag, attributes
        if opened > at:
            yield page[at:opened], None, None
        if piece:
            yield piece
        at = look = stop
    if at < n:
        yield page[at:], None, None


def boilerplate(page: str) -> frozenset[int]:
    """Numbers, in page order, of the named blocks that look like boilerplate."""
    blocks: list[tuple[int, str, int, int, int, list[str]]] = []
    if _NAMES.search(page):
        walk(page, None, frozenset(), blocks)
    if not blocks:
        return frozenset()
    page_clean = blocks.pop()[2]
    comments = sum(b[1] == "comment" for b in blocks)
    return frozenset(b[0] for b in blocks if _looks_so(*b[1:], page_clean, comments))


def walk(
    page: str, take: str | None = None, gone: frozenset[int] | None = None, blocks: list | None = None
) -> tuple[dict[str, float], list[str]]:
    """Scores of the page's container paths, and the clean text of the containers on path ``take``.

    Of the named blocks those numbered in ``gone`` (by default as ``boilerplate``
    finds them) are dropped; ``blocks`` is given the number, kind, clean and total
    characters, headings and tags of the parts of each, and the page's own last.
    """
    if gone is None:
        gone = boilerplate(page)
    n_named = 0
    page_element = _Element()
    stack = [page_element]
    marks: list[int] = []  # places in the stack of tags in _MARKS
    open_tags: Counter[str] = Counter()
    scores: dict[str, float] = {}
    taken: list[str] = []
    taking = int(take == "")  # open containers on the wanted path

    def close(down_to: int):
        nonlocal taking
        while len(stack) > down_to:
            e = stack.pop()
            open_tags[e.tag] -= 1
            if e.container and not e.dropped and e.total:
                bonus = 1.2 if e.tag in ("article", "main") else 1.0
                scores[e.path] = scores.get(e.path, 0.0) + bonus * e.clean * e.clean / e.total
            if e.out:
                taking -= 1
            stack[-1].clean += e.clean
            stack[-1].total += e.total
            stack[-1].heads += e.heads
            if e.named and blocks is not None and not e.dropped:
                blocks.append((*e.named, e.clean, e.total, e.heads, e.parts))
        while marks and marks[-1] >= down_to:
            marks.pop()

    for text, tag, attributes in _pieces(page):
        top = stack[-1]
        if text is not None:
            size = len(text) - text.count(" ")
            top.total += size
            if not (top.dropped or top.header and not top.heading):
                if not top.link:
                    top.clean += size
                if taking:
                    taken.append(html.unescape(text) if "&" in text else text)
            continue
        if tag[0] == "/":
            name = tag[1:]
            if open_tags[name] > 0:
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == name))
            if name not in INLINE and taking:
                taken.append(" ")
            continue
        if tag not in INLINE:
            if taking:
                taken.append(" ")
            if tag in VOID:
                continue
            for k in reversed(marks) if not top.foreign else ():
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag in _SAME.get(tag, ()):
                    close(k)
                    break
                if stack[k].container or stack[k].tag in ("ul", "ol", "dl", "table"):
                    break
        elif tag in VOID:
            continue
        if tag == "html" or attributes.endswith("/") and (tag in INLINE or top.foreign):
            continue
        classes, dropped, named = "", False, None
        if "=" in attributes:
            found = [(m[0].lower(), m[1] or m[2] or m[3]) for m in _NAMES.findall(attributes)]
            if tag in NAMED:
                dropped = any(k == "role" and not ROLES.isdisjoint(v.lower().split()) for k, v in found)
                if kind := _kind([c for k, v in found if k != "role" for c in v.split()]):
                    dropped = dropped or n_named in gone
                    named = (n_named, kind)
                    n_named += 1
            classes = ".".join(sorted({re.sub(r"\d+", "", c) for k, v in found if k == "class" for c in v.split()}))
        parent = stack[-1]
        own = tag + ("." + classes if classes else "")
        element = _Element(tag, _below(parent.path, own) if tag in CONTAINERS else parent.path, parent, dropped)
        element.named = named
        element.heads = int(tag in HEADINGS)
        if parent.named and tag not in INLINE:
            parent.parts.append(tag)
        if element.container and element.path == take and not element.dropped:
            element.out = True
            taking += 1
        if tag in _MARKS:
            marks.append(len(stack))
        open_tags[tag] += 1
        stack.append(element)
    close(1)
    if blocks:
        blocks.append((-1, "", page_element.clean, page_element.total, page_element.heads, page_element.parts))
    if page_element.total:
        scores[""] = page_element.clean**2 / page_element.total
    return scores, taken


def best_path(scores: dict[str, float]) -> str | None:
    return min(scores, key=lambda p: (-scores[p], len(p), p)) if scores else None


def main_text(page: str | None, path: str | None) -> str:
    """The page's text from the containers on ``path``, else from its own best container."""
    if not page:
        return ""
    gone = boilerplate(page)
    scores, taken = walk(page, path, gone)
    if path is None or path not in scores:
        own = best_path(scores)
        taken = walk(page, own, gone)[1] if own is not None else []
    return " ".join("".join(taken).split())


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""

    def vote(batches):
        for batch in batches:
            for part in row_slices(batch, 1):
                paths = [best_path(walk(page or "")[0]) for page in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(paths, pa.string())], ["host", "path"])

    def read(batches):
        for batch in batches:
            for part in row_slices(batch, 2):
                texts = [main_text(h, p) for h, p in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"), host.alias("host"))
    votes = rows.select("host", "html").mapInArrow(vote, "host string, path string").filter("path is not null")
    sums = votes.groupBy("host", "path").agg(F.count("*").alias("votes"))
    order = F.struct(-F.col("votes"), F.length("path"), F.col("path"))
    winners = sums.groupBy("host").agg(F.min_by("path", order).alias("path"))
    winners = bounded_broadcast(scratch_table(winners, "paths"), MAX_HOSTS_BROADCAST)
    kind = pages.schema[id_col].dataType.simpleString()
    return rows.join(winners, "host", "left").select("page_id", "url", "html", "path").mapInArrow(
        read, f"page_id {kind}, url string, text string, n_chars long"
    )
