"""Main text of web pages: per-host template removal on hashed element subtrees.

1. Every page is read into elements; each gets the hash of its subtree (name, attributes, texts, hashes of its children).
2. Spark counts, per host and hash, the pages that hold the subtree - pages with equal main text count once, so copies of an
   article do not make it a template.  Subtrees on at least ``LEAST`` pages of the host are templates, however many pages it has.
3. Every page is read again without them, and without elements that are no content by their name, role or class
   (menus, headers, footers, sidebars, notices, adverts, forms, scripts, reader comments).  A class is taken as a whole:
   all its words must name such a part or a box around one (``ad-slot``, not ``share-price``).  Within an article only
   classes of containers count, never headings, paragraphs or ids (but for reader comments); an element around the article is never one of these.

Where a page has ``article`` (else ``main``) elements, its text is what they hold; otherwise it is the body's.  Inside them
only containers can be templates, never a paragraph or heading: sentences that articles share are content.

Blocks are delimited by the tags of block elements; within a block, character references are decoded, white space becomes
one space, the ends are trimmed; empty blocks go; blocks are joined by two line feeds in page order.

The templates are sent to all tasks while there are at most ``SENT`` of them; beyond that each page
gets the hashes to remove by a join.  A null or empty html has an empty text; a url without host has the empty host;
repeated rows are pages of their own; broken markup never fails: what cannot be read as a tag is text; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import parked

LEAST, SENT = 8, 200_000

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))")

# Element names by their part in a page.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp svg math template".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot "
    "thead tr ul".split()
)
_DROPPED = frozenset(
    "script style noscript template iframe svg math object embed canvas audio video map head title nav aside footer form "
    "button select textarea input label menu dialog noembed noframes xmp".split()
)
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th tr tbody table caption figcaption hgroup".split())
_ENDS_P = _BLOCK - {"body", "html", "option", "optgroup", "legend", "caption", "tbody", "thead", "tfoot", "tr"}
_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form status".split())
_CLASSES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner promo promoted promotion sponsor sponsored sidebar "
    "menu nav navbar navigation breadcrumb breadcrumbs masthead footer cookie cookies consent gdpr notice notices popup modal overlay "
    "newsletter subscribe subscription signup comment comments commentlist disqus respond replies share sharing social related "
    "recommended recommendations widget login search pagination pager toolbar skip".split()
)
_COMMENTS = frozenset("comment comments commentlist disqus respond replies".split())
_HEADERS = frozenset("header topbar".split())
_BOXES = frozenset(
    "area bar block body bottom box button buttons card container content form group holder inner item items left link links list "
    "main module outer page panel post posts article articles reader readers region right row section site slot small space top unit "
    "user users view wrap wrapper zone icon icons message messages thread".split()
)
_CONTAINERS = frozenset("div section ul ol dl figure details center ins".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}


_VALUE = re.compile(r"=\s*(?:\"[^\"]*\"|'[^']*'|\S+)")


@cache
def _names_a_part(name: str, inside: bool) -> bool:
    """Whether a class or id means a part of the page that is no content: ``ad-slot`` does, ``share-price`` does not."""
    words = {w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()) if w}
    parts = _CLASSES if inside else _CLASSES | _HEADERS
    return bool(words & parts) and words <= parts | _BOXES


@dataclass
class Element:
    name: str
    attributes: str
    parent: Element | None
    children: list = field(default_factory=list)
    digest: int = 0

    def dropped(self, inside: bool) -> bool:
        """No content by name, role or class; ``inside``: within the page's article."""
        if self.name in _DROPPED or (self.name == "header" and not inside):
            return True
        if not self.attributes or self.name in ("article", "main", "body", "html"):
            return False
        values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(self.attributes)}
        if values.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", values.get("style", "")):
            return True
        if re.search(r"(?:^|\s)hidden(?:\s|/|$)", _VALUE.sub(" ", self.attributes)):
            return True
        if inside and self.name not in _CONTAINERS:
            return False
        if values.get("role", "").lower() in _ROLES:
            return True
        names, own = values.get("class", "").split(), values.get("id", "")
        if not inside or set(re.split(r"[^a-z]+", own.lower())) & _COMMENTS:
            names.append(own)
        return any(_names_a_part(name, inside) for name in names)


def read(page: str) -> Element:
    """The page as elements with their texts and the hashes of their subtrees."""
    root = at = Element("", "", None)
    end, size = 0, len(page)

    def close(e: Element) -> None:
        h = blake2b(f"{e.name} {e.attributes.strip()}".encode("utf-8", "surrogatepass"), digest_size=8)
        for c in e.children:
            h.update(c.digest.to_bytes(8, "big") if isinstance(c, Element) else b"\0" + " ".join(c.split()).encode("utf-8", "surrogatepass"))
        e.digest = int.from_bytes(h.digest(), "big")

    def up_to(names: set[str], stops: set[str]) -> None:
        """Close the innermost element of these names, unless one of ``stops`` comes first."""
        nonlocal at
        e = at
        while e.parent is not None and e.name not in names:
            if e.name in stops:
                return
            e = e.parent
        if e.parent is None:
            return
        while True:
            close(at)
            done, at = at is e, at.parent
            if done:
                return

    while (m := _TAG.search(page, end)) is not None:
        if m.start() > end:
            at.children.append(page[end : m.start()])
        end = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue  # a comment or declaration
        if m[1] or m[4]:
            up_to({name}, set())
            continue
        if name in _ENDS_P:
            up_to({"p"}, {"table", "td", "th", "button", "article", "section", "div", "li", "blockquote"})
        if name in _CLOSES:
            up_to(_CLOSES[name], _STOPS[name])
        attributes = m[3] or m[6] or ""
        e = Element(name, attributes, at)
        at.children.append(e)
        if name in _VOID or (attributes.endswith("/") and name not in _BLOCK):
            close(e)
        elif name in _RAW:
            stop = re.compile(f"</{re.escape(name)}", re.I).search(page, end)
            e.children.append(page[end : stop.start() if stop else size])
            close(e)
            if stop:
                gt = page.find(">", stop.end())
                end = size if gt < 0 else gt + 1
            else:
                end = size
        else:
            at = e
    if end < size:
        at.children.append(page[end:])
    while at is not None:
        close(at)
        at = at.parent
    return root


def _tops(root: Element, names: set[str]) -> list[Element]:
    """Outermost elements of these names that are no comments and do not lie in a menu, sidebar or footer."""
    out, stack = [], [root]
    while stack:
        e = stack.pop()
        for c in reversed(e.children):
            if isinstance(c, Element):
                if c.name in names and not _comment(c):
                    out.append(c)
                elif c.name not in _DROPPED and not (c.name in _CONTAINERS and c.dropped(False)):
                    stack.append(c)
    return out


def _comment(e: Element) -> bool:
    return bool(set(re.split(r"[^a-z]+", e.attributes.lower())) & {"comment", "comments", "reply", "related", "teaser", "promo"})


def content(root: Element) -> tuple[list[Element], bool]:
    """The elements that hold the page's text, and whether they are articles."""
    for names in ({"article"}, {"main"}):
        if tops := _tops(root, names):
            return tops, True
    marked = [e for e in _walk(root) if re.search(r"role\s*=\s*[\"']?main", e.attributes)]
    return (marked[:1], True) if marked else ([root], False)


def _walk(root: Element) -> Iterator[Element]:
    stack = [root]
    while stack:
        e = stack.pop()
        yield e
        stack.extend(c for c in reversed(e.children) if isinstance(c, Element))


def text_of(tops: list[Element], inside: bool, gone) -> tuple[str, list[int]]:
    """The text without dropped and ``gone`` subtrees, and the hashes of the containers that were kept."""
    blocks, now, kept = [], [], []

    def flush() -> None:
        text = " ".join(html.unescape("".join(now)).split())
        if text:
            blocks.append(text)
        now.clear()

    for top in tops:
        stack: list = [top]
        while stack:
            c = stack.pop()
            if c is None:
                flush()
            elif isinstance(c, str):
                now.append(c)
            elif c.name == "br" or c.name in ("td", "th"):
                now.append(" ")
                stack.extend(reversed(c.children))
            elif c is top or not (c.dropped(inside) or (c.name == "article" and inside and _comment(c))):
                if c is not top and c.children and not (inside and c.name in _PROSE) and c.name in _BLOCK and c.name not in ("body", "html", "main"):
                    if c.digest in gone:
                        flush()
                        continue
                    kept.append(c.digest)
                if c.name in _BLOCK:
                    flush()
                    stack.append(None)
                stack.extend(reversed(c.children))
            elif c.name in _BLOCK:
                flush()
        flush()
    return "\n\n".join(blocks), kept


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _subtrees(pages: DataFrame, row: str | None = None) -> DataFrame:
    """Distinct (host, page, subtree).

    ``page`` is the hash of the page's text, or what the column ``row`` holds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: set[tuple] = set()
            for host, page, name in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "name")), strict=True):
                text, kept = text_of(*content(read(page or "")), ())
                if name is None:
                    name = _signed(int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big"))
                found.update((host, name, _signed(h)) for h in kept)
            columns = list(zip(*found, strict=True)) if found else [[]] * 3
            kinds = [pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["host", row or "page", "subtree"])

    name = F.col(row) if row else F.lit(None).cast("long")
    rows = pages.select("host", "html", name.alias("name"))
    return rows.mapInArrow(run, f"host string, {row or 'page'} long, subtree long").distinct()


def templates(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(host, subtree) of the subtrees that recur across pages of their host."""
    counts = _subtrees(pages).where("subtree is not null").groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= least).select("host", "subtree")


def main_text(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html", least: int = LEAST, sent: int = SENT
) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    host = F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    pages = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), host.alias("host"), F.col(page).alias("html"))
    found = parked(templates(pages, least), "templates")
    empty: frozenset[int] = frozenset()
    if found.limit(sent + 1).count() <= sent:
        of_host: dict[str, set[int]] = {}
        for name, subtree in found.toPandas().itertuples(index=False):
            of_host.setdefault(name, set()).add(subtree % (1 << 64))
        rows = pages.withColumn("gone", F.lit(None).cast("array<long>"))
    else:  # each page gets the templates among its own subtrees, by joins on (host, subtree) and on the page
        of_host = {}
        keyed = pages.withColumn("row", F.xxhash64("page_id", "url", "html"))
        own = _subtrees(keyed, "row").join(found, ["host", "subtree"]).groupBy("row").agg(F.collect_set("subtree").alias("gone"))
        rows = keyed.join(own, "row", "left").drop("row")
    shared = pages.sparkSession.sparkContext.broadcast(of_host)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for name, page, gone in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "gone")), strict=True):
                removed = shared.value.get(name, empty) if gone is None else {x % (1 << 64) for x in gone}
                texts.append(text_of(*content(read(page or "")), removed)[0])
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    out = rows.select("page_id", "url", "host", "html", "gone").mapInArrow(run, f"page_id {kind}, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
