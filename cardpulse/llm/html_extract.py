"""The main text of web pages: page structure, and differencing against the nearest page of the same host."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from html import unescape

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardpulse.llm.shared import running_last, written
from cardpulse.llm.url_filter import host_of, path_of

# Elements whose text is never part of an article, elements that end a block, and elements whose content is no markup
# (fixed values of HTML).
OUTSIDE = frozenset(
    "head title script style noscript template svg math canvas iframe object nav header footer aside form button select "
    "option textarea input dialog menu audio video".split())
BLOCKS = frozenset(
    "p div h1 h2 h3 h4 h5 h6 li ul ol dl dt dd section article main body html table thead tbody tfoot tr td th caption "
    "blockquote pre figure figcaption hr address details summary fieldset center".split())
RAW = frozenset("script style textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Block elements outside an article; what ends at the start of which element, unless one of the last ones was opened
# since; elements that hide what is open around them; and what stands in a head (fixed values of HTML).
OUTSIDE_BLOCKS = frozenset("nav header footer aside form menu dialog".split())
HIDING = ("table", "td", "th", "caption", "template", "object")
SECTIONS = ("tbody", "thead", "tfoot")
ENDED_BY_START = [
    (BLOCKS | OUTSIDE_BLOCKS, ("head",), ("noscript", "template")),
    (BLOCKS | OUTSIDE_BLOCKS, ("p",), ("button", *HIDING)),
    (frozenset(["li"]), ("li",), ("ul", "ol", "menu", *HIDING)),
    (frozenset(["dt", "dd"]), ("dt", "dd"), ("dl", *HIDING)),
    (frozenset(["td", "th", "tr", *SECTIONS]), ("td", "th"), ("tr", "table")),
    (frozenset(["tr", *SECTIONS]), ("tr",), (*SECTIONS, "table")),
    (frozenset(SECTIONS), SECTIONS, ("table",)),
    (frozenset(["option", "optgroup"]), ("option",), ("select",)),
    (frozenset(["optgroup"]), ("optgroup",), ("select",)),
]
ENDING_STARTS = frozenset().union(*(starts for starts, _, _ in ENDED_BY_START))
IN_TABLES = frozenset(["table", "caption", "tr", "td", "th", *SECTIONS])
# A page that shares this part of its text with another, or the other with it, is a copy: numerator and denominator.
COPIED = (4, 5)
# Words of class, id and role attributes that mark what surrounds an article (fixed values).
MARKED_OUTSIDE = frozenset(
    "ad ads advert adverts advertisement advertising sponsored sponsor promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay sidebar side-bar menu menubar nav navbar navigation breadcrumb breadcrumbs "
    "footer site-footer page-footer site-header page-header masthead comments comment comment-list comment-section "
    "user-comments disqus replies respond share sharing social related recommended newsletter subscribe subscription "
    "signup login search pagination pager toolbar complementary contentinfo".split())
_TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^'\">]|\"[^\"]*\"|'[^']*')*+)>|</?[a-zA-Z][^>]*>", re.S)
# What a form that wraps a page's text holds, and the ends of forms.
_FORM = re.compile(r"<(?:(article|main|h1)\b|/form\b)", re.I)
_MARK = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


def _is_marked(attributes: str) -> bool:
    return any(
        word in MARKED_OUTSIDE for found in _MARK.findall(attributes) for word in "".join(found).lower().split())


class OpenElements:
    """The stack of open elements of a page. Every step is constant or ends elements, so the work is linear."""

    def __init__(self):
        self.names: list[str] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def last(self, *names: str) -> int:
        """The depth of the innermost open element of these names, or -1."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def cut(self, depth: int):
        while len(self.names) > depth:
            name = self.names.pop()
            self.places[name].pop()
            if name in BLOCKS or name in OUTSIDE:
                self.blocks.pop()

    def start(self, name: str):
        """End what the start of ``name`` ends."""
        if name in ENDING_STARTS:
            for starts, ended, unless in ENDED_BY_START:
                if name in starts and (at := self.last(*ended)) > self.last(*unless):
                    self.cut(at)

    def push(self, name: str):
        self.places.setdefault(name, []).append(len(self.names))
        if name in BLOCKS or name in OUTSIDE:
            self.blocks.append(len(self.names))
        self.names.append(name)

    def end(self, name: str):
        """End the innermost ``name`` and all within it; an end without a start, or of an inline element around a block,
        ends nothing.
        """
        at = self.last(name)
        if name in BLOCKS or name in OUTSIDE:
            hidden = at < self.last(*(("table",) if name in IN_TABLES else HIDING)) and name not in ("body", "html")
        else:
            hidden = bool(self.blocks) and at < self.blocks[-1]
        if at >= 0 and not hidden:
            self.cut(at)


def page_blocks(html: str) -> list[tuple[str, bool]]:
    """(text, inside) of the blocks of a page in order, without those of elements outside an article. ``inside`` tells
    whether an article or main element holds the block. An article whose marks say that it is a comment or the like is
    outside; a form that holds an article, a main element or a first heading wraps the page and is not. Unclosed elements end where HTML ends them: at the start of a
    sibling or block, or with the element around them; cut-off pages are taken as they come.
    """
    blocks: list[tuple[str, bool]] = []
    held: list[str] = []
    opened = OpenElements()
    skipped, at, length = -1, 0, len(html)  # the depth of the element that is skipped
    inside = False
    forms = [(m.start(), bool(m[1])) for m in _FORM.finditer(html)] if "<form" in html.lower() else []

    def wraps_text(start: int) -> bool:
        """Whether the form that begins before ``start`` holds a page's text."""
        following = bisect_left(forms, (start, False))
        return following < len(forms) and forms[following][1]

    def end_block():
        if held:
            if text := " ".join(unescape("".join(held)).split()):
                blocks.append((text, inside))
            held.clear()

    while at < length:
        found = _TAG.search(html, at)
        if skipped < 0:
            inside = opened.last("article", "main") >= 0
            text = html[at:found.start() if found else length]
            if text:
                held.append(text)
        if not found:
            break
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        closing = bool(found[1])
        if not closing and name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(html, at)
            at = end.end() if end else length
            continue
        if skipped < 0 and name == "br":
            held.append(" ")
            continue
        if skipped < 0 and (name in BLOCKS or name in OUTSIDE):
            end_block()
        if closing:
            opened.end(name)
        else:
            opened.start(name)
        if len(opened.names) <= skipped:
            skipped = -1
        if closing or name in VOID:
            continue
        closed = found[3].endswith("/")
        if skipped < 0:
            if name == "header" and opened.last("article", "main") >= 0 or name in ("body", "html", "main"):
                outside = False
            elif name == "form" and wraps_text(at):
                outside = False
            else:
                outside = name in OUTSIDE or bool(found[3]) and _is_marked(found[3])
            if outside and not closed:
                end_block()
                skipped = len(opened.names)
        if not closed or name in ("article", "main"):
            opened.push(name)
    end_block()
    return blocks


def shared_lines(own: list[int], other: list[int]) -> set[int]:
    """Positions in ``own`` of a longest common subsequence with ``other``. The k-th of equal lines stands against the
    k-th, so the work is n log n however often a line repeats.
    """
    def numbered(lines):
        seen: dict[int, int] = {}
        for line in lines:
            seen[line] = seen.get(line, 0) + 1
            yield line, seen[line]

    places = {line: at for at, line in enumerate(numbered(other))}
    pairs = [(at, places[line]) for at, line in enumerate(numbered(own)) if line in places]
    tails: list[int] = []
    last: list[int] = []
    before = [-1] * len(pairs)
    for i, (_, there) in enumerate(pairs):
        k = bisect_left(tails, there)
        tails[k:k + 1] = [there]
        last[k:k + 1] = [i]
        before[i] = last[k - 1] if k else -1
    out = set()
    i = last[-1] if last else -1
    while i >= 0:
        out.add(pairs[i][0])
        i = before[i]
    return out


def main_text(blocks: list[tuple[str, bool]], lines: list[int], neighbour: list[int]) -> str:
    """A page's blocks without the lines it shares with its neighbour, joined by blank lines.

    Blocks inside an article or main element always stay, since an article that appears under two urls must not vanish;
    differencing decides the others. A page without such an element of which nearly everything would go (its neighbour is
    a copy) keeps all its blocks.
    """
    shared = shared_lines(lines, neighbour)
    left = [text for at, (text, inside) in enumerate(blocks) if inside or at not in shared]
    if not any(inside for _, inside in blocks) and is_copied([len(text) for text, _ in blocks], shared):
        left = [text for text, _ in blocks]
    return "\n\n".join(left)


def is_copied(sizes: list[int], shared: set[int]) -> bool:
    """Whether the lines at ``shared`` are ``COPIED`` or more of the text of a page whose lines have these sizes."""
    return COPIED[1] * sum(sizes[at] for at in shared) >= COPIED[0] * sum(sizes) > 0


def _line_hashes(blocks):
    from xxhash import xxh64_intdigest

    return [xxh64_intdigest(text.encode()) - (1 << 63) for text, _ in blocks]


def _lines(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        pages = [page_blocks(h.as_py() or "") for h in batch.column(0)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([_line_hashes(p) for p in pages], pa.list_(pa.int64())),
             pa.array([[len(text) for text, _ in p] for p in pages], pa.list_(pa.int32())), *batch.columns[1:]],
            names=["lines", "sizes", *batch.schema.names[1:]])


def _compared(batches: Iterator) -> Iterator:
    """From rows (lines, sizes, near_lines, near_sizes, others): whether one of both pages is a copy of the other, and
    whether the first has no line of its own.
    """
    import pyarrow as pa

    for batch in batches:
        copies, whole = [], []
        for row in zip(*batch.columns[:4]):
            own, sizes, near, near_sizes = (v.as_py() or [] for v in row)
            shared = shared_lines(own, near)
            copies.append(is_copied(sizes, shared) or is_copied(near_sizes, shared_lines(near, own)))
            whole.append(len(shared) == len(own))
        yield pa.RecordBatch.from_arrays(
            [pa.array(copies, pa.bool_()), pa.array(whole, pa.bool_()), *batch.columns[4:]],
            names=["copy", "whole", *batch.schema.names[4:]])


def _packed(batches: Iterator) -> Iterator:
    """Blocks in compressed form, so that the shuffle moves less than the pages themselves."""
    import json

    import pyarrow as pa
    import zstandard

    pack = zstandard.ZstdCompressor(level=6).compress
    for batch in batches:
        packed = [pack(json.dumps(page_blocks(h.as_py() or ""), ensure_ascii=False).encode("utf-8", "surrogatepass"))
                  for h in batch.column(0)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(packed, pa.binary()), *batch.columns[1:]], names=["packed", *batch.schema.names[1:]])


def _texts(batches: Iterator) -> Iterator:
    import json

    import pyarrow as pa
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        texts = []
        for packed, neighbour in zip(batch.column(0), batch.column(1)):
            blocks = [tuple(b) for b in json.loads(unpack(packed.as_py()).decode("utf-8", "surrogatepass"))]
            texts.append(main_text(blocks, _line_hashes(blocks), neighbour.as_py() or []))
        yield pa.RecordBatch.from_arrays(
            [pa.array(texts, pa.string()), *batch.columns[2:]], names=["text", *batch.schema.names[2:]])


def nearest_pages(pages: DataFrame) -> DataFrame:
    """(page_id, near_id) for pages (page_id, host, path, one row each): the page before it in the order of paths of
    its host, or the one after it for the first; null for the only page of a host.

    Pages are ordered by ranges, so a large host spans many tasks; only the two ends of each range are passed on.
    """
    order = ["host", "path", "page_id"]
    ranged = written(
        pages.select(*order).repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "html-order")
    here = F.struct("host", "page_id")
    by = Window.partitionBy("_range").orderBy(*order)
    ends = ranged.groupBy("_range").agg(F.min(F.struct(*order)).alias("_f"), F.max(F.struct(*order)).alias("_l"))
    over = Window.orderBy("_range")
    ends = ends.select(
        "_range", F.lag(F.struct("_l.host", "_l.page_id")).over(over).alias("_before"),
        F.lead(F.struct("_f.host", "_f.page_id")).over(over).alias("_after"))
    placed = ranged.select(
        *order, "_range", F.lag(here).over(by).alias("_lag"), F.lead(here).over(by).alias("_lead"))
    placed = placed.join(F.broadcast(ends), "_range").withColumn(
        "_lag", F.coalesce("_lag", "_before")).withColumn("_lead", F.coalesce("_lead", "_after"))
    return placed.select("page_id", F.when(F.col("_lag.host") == F.col("host"), F.col("_lag.page_id")).when(
        F.col("_lead.host") == F.col("host"), F.col("_lead.page_id")).alias("near_id"))


def differing_pages(lines: DataFrame) -> DataFrame:
    """(page_id, near_id) for pages (page_id, host, path, lines, sizes, one row each): the nearest page of the host in
    the order of paths that is not a copy; null where there is none.

    Neighbours that copy each other are a run, whatever its length. The page before the run is taken, or the one after
    it for the first run of a host. A page without a line of its own keeps its neighbour.
    """
    kind = lines.schema["page_id"].dataType.simpleString()
    order = ["host", "path", "page_id"]
    other = lines.select(F.col("page_id").alias("_other"), F.col("path").alias("_path"), F.col("lines").alias("near_lines"),
                         F.col("sizes").alias("near_sizes"))
    pairs = lines.join(nearest_pages(lines), "page_id").join(other, F.col("near_id") == F.col("_other"), "left").select(
        "lines", "sizes", "near_lines", "near_sizes", *order, "near_id",
        F.coalesce(F.struct("_path", "_other") > F.struct("path", "page_id"), F.lit(False)).alias("after"))
    pairs = written(pairs.mapInArrow(
        _compared, f"copy boolean, whole boolean, host string, path string, page_id {kind}, near_id {kind}, after boolean"),
        "html-copies")
    before = F.when(~F.col("after"), F.col("near_id"))  # null for the first page of a host
    first = before.isNull()
    runs = running_last(
        pairs.withColumn("_start", F.when(first | ~F.col("copy"), F.struct(before.alias("id")))), "_start", order, "_run", "html-runs")
    own = ~F.col("copy") | F.col("whole")
    runs = runs.select("page_id", "host", F.when(own, F.col("near_id")).otherwise(F.col("_run.id")).alias("near_id"),
                       (~own & F.col("_run.id").isNull()).alias("_later"))
    second = pairs.where(~first & ~F.col("copy")).groupBy(F.col("host").alias("_host")).agg(
        F.min(F.struct("path", "page_id")).alias("_second"))
    later = runs.where("_later").join(second, F.col("host") == F.col("_host"), "left").select(
        "page_id", F.col("_second.page_id").alias("near_id"))
    return runs.where("not _later").select("page_id", "near_id").union(later)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page, from its whole html.

    Null html is empty and gives an empty text. Rows with one id stay separate rows and share a neighbour; a null id
    has no neighbour and is none; urls without host are one host. Other columns are ignored; an empty table gives an
    empty result.
    """
    base = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    lines = base.select("html", "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    kind = base.schema["page_id"].dataType.simpleString()
    lines = lines.mapInArrow(_lines, f"lines array<bigint>, sizes array<int>, page_id {kind}, host string, path string")
    lines = written(lines.where("page_id is not null").groupBy("page_id").agg(F.min(F.struct("host", "path", "lines", "sizes")).alias("p")).select(
        "page_id", "p.*"), "html-lines")
    near = differing_pages(lines).join(
        lines.select(F.col("page_id").alias("_other"), F.col("lines").alias("near_lines")),
        F.col("near_id").eqNullSafe(F.col("_other")) & F.col("near_id").isNotNull(), "left").select(
        F.col("page_id").alias("_id"), "near_lines")
    packed = base.select("html", "page_id", "url").mapInArrow(_packed, f"packed binary, page_id {kind}, url string")
    both = packed.join(near, F.col("page_id").eqNullSafe(F.col("_id")), "left")
    texts = both.select("packed", "near_lines", "page_id", "url").mapInArrow(
        _texts, f"text string, page_id {kind}, url string")
    return texts.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
