"""Main text of web pages, less the templates of their sites.

Every container element of a page is known by two hashes: of its whole subtree as it is written, and of its shape (tags,
classes and how they nest; repeated neighbours count once, text is left out). Spark counts for each host on how many pages
of different main text a subtree occurs, and of how many occurrences of a shape the exact subtree comes back on other
pages. Templates are

* subtrees that occur on MIN_PAGES pages or more of a host, and
* shapes on MIN_PAGES pages or more which are mostly links (menus differ from page to page, but not in shape), or of which
  a good share of the occurrences (RECURRING) come back on other pages (notices and adverts that rotate).

Containers of a template are deleted, but not within the main text (an article or main element, or the innermost container of most
paragraphs): there only links, and what the rules below know, go for coming back as they are, and nothing goes by
its shape. What counts can't tell (hosts of few pages) is left to rules: an element that is never
part of an article goes by its tag or whole class name, unless it wraps an article, main or h1 with paragraphs; and where a
page has an article (or main) element, text outside it is left out. Pages are parsed twice: once for their hashes, of which
only numbers are stored and counted, and once to take the text without the templates found.
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.session import materialize

#: A subtree is template from so many pages of different main text of one host on.
MIN_PAGES = 10
#: A shape is template if so large a share of its occurrences comes back on other pages.
RECURRING = 0.3
#: A container is a menu if so large a share of its text is in links.
LINKS = 0.5

# Elements of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template svg iframe object math".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("aside details div dl figure form footer header nav ol section table ul".split())
NEVER = frozenset("head nav aside form footer button select dialog menu".split())
CLOSED_BY = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select",)}
NEVER_NAMED = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb "
    "breadcrumbs sidebar footer cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup "
    "share sharing social comment comments commentlist respond disqus related recommended widget toolbar pagination pager skip login".split()
)
HEADERS_NAMED = frozenset("header masthead topbar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*+)>|<[!?][^>]*+(?:>|\Z)|<[a-zA-Z/][^<>]*+\Z",
    re.S,
)
#: Elements that may wrap a page's main text, whatever their names.
WRAPPERS = frozenset("div section form table center fieldset span".split())
_WRAPPER = re.compile(rf"<(/?)({'|'.join(sorted(WRAPPERS))})\b", re.I)
_MAIN = re.compile(r"<(?:article|main|h1)\b", re.I)
_PARAGRAPH = re.compile(r"<p\b", re.I)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_SPACE = re.compile(r"\s+")


def _names(attributes: str) -> set[str]:
    return {t for m in _NAMES.finditer(attributes) for t in (m[1] or m[2] or m[3] or "").lower().split()}


class Wrappers:
    """Which elements of a page hold an article, main or h1, and a paragraph after it, outside comments: found in one pass."""

    def __init__(self, page: str):
        self.page, self.ends, self.mains = page, None, []

    def _scan(self) -> None:
        self.ends = {}
        open_: dict[str, list[int]] = {}
        for m in _WRAPPER.finditer(self.page):
            own = open_.setdefault(m[2].lower(), [])
            if not m[1]:
                own.append(m.start())
            elif own:
                self.ends[own.pop()] = m.start()
        paragraphs = [m.start() for m in _PARAGRAPH.finditer(self.page)]
        for m in _MAIN.finditer(self.page):
            shut = self.page.find(">", m.end())
            if shut >= 0 and not _names(self.page[m.end() : shut]) & {"comment", "comments"}:
                i = bisect.bisect_left(paragraphs, shut)
                if i < len(paragraphs):
                    self.mains.append((m.start(), paragraphs[i]))

    def holds(self, at: int) -> bool:
        """at: where the element's tag begins. Of the main elements behind it the first has the first paragraph."""
        if self.ends is None:
            self._scan()
        i = bisect.bisect_right(self.mains, (at, len(self.page)))
        return i < len(self.mains) and self.mains[i][1] < self.ends.get(at, len(self.page))


@dataclass
class Box:
    """A container element: the one around it, its hashes, whether it is mostly links or left out by the rules, whether its shape
    may tell (it holds no main text), and whether it lies within the main text."""

    parent: int = -1
    exact: int = 0
    shape: int = 0
    links: bool = False
    listed: bool = False
    small: bool = False
    chars: int = 0
    wraps: bool = False
    inside: bool = False


@dataclass
class Block:
    """A block of text, the number of the box around it, whether it is a paragraph, and what the rules say of it."""

    text: str
    box: int
    paragraph: bool
    listed: bool
    article: bool
    main: bool


def _signed(raw: str) -> int:
    return xxhash.xxh3_64_intdigest(raw) - (1 << 63)


def parse(page: str) -> tuple[list[Block], list[Box]]:
    """The blocks of a page in order, and its containers."""
    stack: list[list] = []  # tag, left out, box or -1, kind, hash, characters and link characters before, shapes of children, names
    blocks: list[Block] = []
    boxes: list[Box] = []
    around: list[int] = []
    text: list[str] = []
    out = articles = mains = anchors = 0  # open elements that are left out, are articles, mains, links
    hidden = 0  # open ones that are left out within a line of text
    chars = linked = fed = 0
    wrappers, hashes = Wrappers(page), []

    def feed(end: int) -> None:
        """Gives the source up to end to the innermost container's hash."""
        nonlocal fed
        if hashes and end > fed:
            hashes[-1].update(_SPACE.sub(" ", page[fed:end]).encode())
        fed = max(fed, end)

    def mark() -> None:
        """The containers around hold main text; those around one that is marked are."""
        for i in reversed(around):
            if boxes[i].wraps:
                break
            boxes[i].wraps = True

    def flush() -> None:
        if text:
            s = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if s:
                blocks.append(Block(s, around[-1] if around else -1, bool(stack) and stack[-1][0] == "p", out > 0, articles > 0, mains > 0))

    def put(raw: str) -> None:
        nonlocal chars, linked
        if raw:
            if not hidden:
                text.append(raw)
            chars += len(raw)
            linked += len(raw) if anchors else 0

    def close(to: int, end: int) -> None:
        nonlocal out, articles, mains, anchors, hidden
        while len(stack) > to:
            tag, left, number, kind, own, c, k, shapes, names = stack.pop()
            out -= left
            hidden -= left and tag not in BLOCKS
            articles -= kind == 1
            mains -= kind == 2
            anchors -= tag == "a"
            shape = f"{tag}.{names}({','.join(shapes)})"
            if len(shape) > 200:
                shape = f"{tag}.{names}(#{_signed(shape)})"
            if stack and (not stack[-1][7] or stack[-1][7][-1] != shape):
                stack[-1][7].append(shape)
            if number >= 0:
                around.pop()
                feed(end)
                hashes.pop()
                if hashes:
                    hashes[-1].update(own.digest())
                box = boxes[number]
                box.exact, box.shape, box.chars = own.intdigest() - (1 << 63), _signed(shape), chars - c
                box.links = linked - k >= LINKS * max(1, box.chars)
                if box.wraps:
                    mark()

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            put(page[at:])
            break
        put(page[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag = tag.lower()
        block = tag in BLOCKS
        if m[1] or m[4]:  # a closing tag
            if block:
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close(i, at)
                    break
                if not block and stack[i][0] in BLOCKS:
                    break
            continue
        attributes = m[3] or m[6] or ""
        if tag == "br":
            text.append(" ")
            continue
        if tag in RAW:
            if not attributes.endswith("/"):
                shut = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = shut.end() if shut else n
            continue
        if block:
            flush()
            if stack and stack[-1][0] == "p" and tag not in ("option", "optgroup"):
                close(len(stack) - 1, m.start())
            if tag in CLOSED_BY:
                same = ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,)
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in same:
                        close(i, m.start())
                        break
                    if stack[i][0] in CLOSED_BY[tag]:
                        break
        if tag in VOID:
            continue
        names = _names(attributes) if attributes else set()
        left, kind, wraps = _ruled(wrappers, tag, names, attributes, m.start(), articles, out)
        if tag == "article" and not left:
            kind = 1
        number = -1
        if tag in CONTAINERS:
            number = len(boxes)
            feed(m.start())
            hashes.append(xxhash.xxh3_64())
            boxes.append(Box(around[-1] if around else -1, listed=out + left > 0, inside=articles + mains > 0))
            around.append(number)
        if wraps or kind or tag in ("h1", "article", "main"):
            mark()
        stack.append([tag, int(left), number, kind, hashes[-1] if number >= 0 else None, chars, linked, [], ".".join(sorted(names)) if number >= 0 else ""])
        out += left
        hidden += left and not block
        articles += kind == 1
        mains += kind == 2
        anchors += tag == "a"
    flush()
    close(0, n)
    _main_text(blocks, boxes)
    for box in boxes:
        box.small = not box.wraps and not box.inside and 2 * box.chars <= chars
    return blocks, boxes


def _main_text(blocks: list[Block], boxes: list[Box]) -> None:
    """Marks what lies within the innermost container of most of a page's paragraphs as inside, as within articles."""
    held = [0] * len(boxes)
    total = 0
    for b in blocks:
        if b.paragraph and not b.listed:
            total += len(b.text)
            if b.box >= 0:
                held[b.box] += len(b.text)
    for i in range(len(boxes) - 1, -1, -1):  # a box comes behind the one around it
        if boxes[i].parent >= 0:
            held[boxes[i].parent] += held[i]
    inner = max((i for i, n in enumerate(held) if total and n > 0.5 * total), default=-1)
    for i, box in enumerate(boxes):
        if box.parent >= 0 and (box.parent == inner or boxes[box.parent].inside):
            box.inside = True


def _ruled(wrappers: Wrappers, tag: str, names: set[str], attributes: str, at: int, articles: int, out: int) -> tuple[bool, int, bool]:
    """Whether an element is left out by the rules; 2 for a main element; whether it was found to wrap the main text."""
    left, kind, wraps = tag in NEVER or (tag == "header" and not articles), 0, False
    if tag == "form" and not out and wrappers.holds(at):
        left, wraps = False, True
    if not left and names:
        left = bool(names & NEVER_NAMED) and tag not in ("html", "body", "article", "main") or (not articles and bool(names & HEADERS_NAMED) and tag not in ("html", "body"))
        if left and not out and tag in WRAPPERS and wrappers.holds(at):
            left, wraps = False, True
        if tag == "article" and names & {"comment", "comments"}:
            left = True
        if "main" in names and "role" in attributes.lower():
            kind = 2
    if tag == "main":
        kind = 2
    return left, kind, wraps


def choose(blocks: list[Block], boxes: list[Box], exact: frozenset[int] = frozenset(), shapes: frozenset[int] = frozenset()) -> tuple[list[str], tuple[int, int, int]]:
    """The texts of a page without its templates, and how many other blocks were left out as template, by the lists of tags
    and names, and as outside of the article or main element."""
    gone = [False] * (len(boxes) + 1)  # the last is that of blocks without a box
    for i, x in enumerate(boxes):  # each comes behind the one around it
        told = (x.exact in exact and (x.links or x.listed or not x.inside)) or (x.small and x.shape in shapes)
        gone[i] = told or gone[x.parent]
    kept = [b for b in blocks if not gone[b.box]]
    free = [b for b in kept if not b.listed]
    inside = [b for b in free if b.article] if any(b.article for b in free) else [b for b in free if b.main] if any(b.main for b in free) else free
    return [b.text for b in inside], (len(blocks) - len(kept), len(kept) - len(free), len(free) - len(inside))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, x, main, e, s, links): the containers of each page, s null where the shape can't tell."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            host, x, main, e, s, links = [], [], [], [], [], []
            for h, key, t in zip(*(some.column(c).to_pylist() for c in ("host", "x", "h")), strict=True):
                blocks, boxes = parse(t)
                text = _signed("\n".join(choose(blocks, boxes)[0]))
                for box in {b.exact: b for b in boxes}.values():
                    host.append(h)
                    x.append(key)
                    main.append(text)
                    e.append(box.exact)
                    s.append(box.shape if box.small else None)
                    links.append(box.links)
            yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), *(pa.array(v, pa.int64()) for v in (x, main, e, s)), pa.array(links, pa.bool_())], names=["host", "x", "main", "e", "s", "links"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages packed for their way to their templates."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        z = [pack((h or "").encode()) for h in batch.column("h").to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("p", "u", "x")), pa.array(z, pa.binary())], names=["p", "u", "x", "z"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            text, ruled = [], []
            for z, exact, shapes in zip(*(some.column(c).to_pylist() for c in ("z", "es", "ss")), strict=True):
                texts, by = choose(*parse(unpack(z).decode()), frozenset(exact or ()), frozenset(shapes or ()))
                text.append("\n\n".join(texts))
                ruled.append(by)
            by = zip(*ruled, strict=True)
            yield pa.RecordBatch.from_arrays([some.column("p"), some.column("u"), pa.array(text, pa.string()), *(pa.array(v, pa.int64()) for v in by)], names=["p", "u", "text", *RULES])


#: Numbers of blocks left out as template, by the lists, and as outside of the article or main element.
RULES = ("n_template", "n_listed", "n_outside")


def templates(boxes: DataFrame, min_pages: int = MIN_PAGES, recurring: float = RECURRING) -> tuple[DataFrame, DataFrame]:
    """Keys (host, e) of exact subtrees and (host, s) of shapes that are template. boxes: host, main, e, s, links.

    Pages of equal main text count once, so copies of a page make no template.
    """
    once = boxes.select("host", "main", "e", "s", "links").distinct()
    subtrees = materialize(once.groupBy("host", "e", "s").agg(F.count("*").alias("n"), F.max("links").alias("links")).where((F.col("n") > 1) | F.col("s").isNotNull()), "subtrees")
    exact = subtrees.where(F.col("n") >= min_pages).select("host", "e").distinct()
    pages = once.where("s is not null").select("host", "s", "main").distinct().groupBy("host", "s").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages)
    share = subtrees.where("s is not null").groupBy("host", "s").agg(F.sum("n").alias("all"), F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("again"), F.sum(F.when(F.col("links"), F.col("n")).otherwise(0)).alias("menus"))
    told = (F.col("again") >= recurring * F.col("all")) | (F.col("menus") >= 0.5 * F.col("all"))
    return exact, share.where(told).join(pages, ["host", "s"], "left_semi").select("host", "s")


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html", min_pages: int = MIN_PAGES, recurring: float = RECURRING) -> DataFrame:
    """For each row of pages: page_id, url, text, and n_template, n_listed, n_outside: the blocks each rule left out.

    text: the blocks of the page's articles, else of its main element, else of all of it, in page order, joined by two
    newlines; within a block character references are decoded and white space is one space. Only whole containers are
    template; paragraphs and headings outside of those never go for recurring. A null or empty page, or one without such
    text, has the empty text. Pages of a null url, or one without a host, count as one host. Repeated rows are treated
    alike and all stay; other columns are not read; an empty table gives no rows.
    """
    host = F.regexp_extract(F.lower(F.coalesce(F.col(url), F.lit(""))), r"^[a-z][a-z0-9+.\-]*://([^/?#]*)", 1)
    body = F.coalesce(F.col(page), F.lit(""))
    base = pages.select(F.col(page_id).cast("long").alias("p"), F.col(url).alias("u"), F.xxhash64(body, host).alias("x"), host.alias("host"), body.alias("h"))
    boxes = materialize(base.select("host", "x", "h").mapInArrow(_hashed, "host string, x long, main long, e long, s long, links boolean").distinct(), "boxes")
    exact, shapes = templates(boxes, min_pages, recurring)
    none = F.lit(None).cast("long")
    gone = boxes.join(exact, ["host", "e"], "left_semi").select("x", "e", none.alias("s")).unionByName(boxes.join(shapes, ["host", "s"], "left_semi").select("x", none.alias("e"), "s"))
    gone = materialize(gone.groupBy("x").agg(F.collect_set("e").alias("es"), F.collect_set("s").alias("ss")), "templates")
    schema = "p long, u string, text string, " + ", ".join(f"{r} long" for r in RULES)
    packed = base.select("p", "u", "x", "h").mapInArrow(_packed, "p long, u string, x long, z binary")
    # the templates found grow with the pages, so they are never broadcast
    out = packed.join(gone.hint("merge"), "x", "left").select("p", "u", "z", "es", "ss").mapInArrow(_texts, schema)
    return out.withColumnsRenamed({"p": page_id, "u": url})


def op6_html_text(spark, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    out = extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


ORACLE_SQL = None
