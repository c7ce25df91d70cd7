"""Main text of web pages: lines that a page shares with its nearest neighbour on the host are not its own.

Pages are paired by URL path within their host, their lines aligned by longest common subsequence, and shared
lines deleted. The page's own markup then corrects what one neighbour cannot show: lines of menus, adverts and the
like go even where they differ, and a marked article stays where the neighbour carries it as a whole.
"""

from __future__ import annotations

import html
import os
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .common import staged

# Neither pattern goes back over what it has read, and a tag ends at the next `<` outside quotes, so truncated pages cost no more than others.
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/<>]*+)((?:"[^"]*"|'[^']*'|[^'"<>])*+)>|<[!?][^>]*>""", re.S)
ATTRIBUTE = re.compile(r"""(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]++))""")
SPACE = re.compile(r"\s+")
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
          "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "img", "wbr", "br"}
CHROME = {"head", "nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "object", "audio", "video", "canvas", "map"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar", "form"}
NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie",
         "cookies", "disqus", "footer", "gdpr", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices",
         "popup", "promo", "promoted", "related", "replies", "reply", "respond", "share", "sharing", "sidebar", "social", "sponsor",
         "sponsored", "subscribe", "toolbar", "widget"}
ARTICLE = {"article", "main"}
SAME_ARTICLE = 0.9  # of the characters of a marked article; a neighbour that has so many carries it as a whole
OTHER, OWN, REMOVED = 0, 1, 2
FEW_MATCHES = 8          # equal places a line: below it they are listed one by one
TABLE_BYTES = 16 << 20   # of rows kept at once in an alignment


def _is_chrome(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in CHROME or (tag == "header" and not in_article):
        return True
    if tag in ARTICLE or tag in ("html", "body") or not attributes:
        return False
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        value, name = (a or b or c).lower(), name.lower()
        if name == "role" and value in ROLES:
            return True
        if name in ("class", "id") and not NAMES.isdisjoint(re.split(r"[^a-z0-9]+", value)):
            return True
    return False


class Open:
    """The open elements, each with its zone, and what is asked of them at every tag."""

    def __init__(self):
        self.stack: list[tuple[str, int]] = []
        self.count: Counter = Counter()
        self.blocks: list[int] = []  # places of the elements that are not inline

    def zone(self) -> int:
        return self.stack[-1][1] if self.stack else OTHER

    def push(self, tag: str, zone: int) -> None:
        if tag not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append((tag, zone))
        self.count[tag] += 1

    def cut(self, size: int) -> None:
        while len(self.stack) > size:
            self.count[self.stack.pop()[0]] -= 1
        while self.blocks and self.blocks[-1] >= size:
            self.blocks.pop()

    def end(self, tag: str) -> None:
        """Closes the innermost element of the tag with all in it; an end without a start is nothing."""
        if self.count[tag]:
            at = len(self.stack) - 1
            while self.stack[at][0] != tag:
                at -= 1
            self.cut(at)

    def reopen(self, tag: str) -> None:
        """A new paragraph or item ends an open one, with the inline elements in it."""
        if self.blocks and self.stack[self.blocks[-1]][0] == tag:
            self.cut(self.blocks[-1])


def lines_of(page: str) -> list[tuple[str, int]]:
    """(text, zone) of the blocks of a page, in order: OWN in a marked article, REMOVED in page furniture, else OTHER."""
    out: list[tuple[str, int]] = []
    open_ = Open()
    held: list[str] = []

    def close() -> None:
        if held:
            text = SPACE.sub(" ", html.unescape("".join(held))).strip()
            if text:
                out.append((text, open_.zone()))
            held.clear()

    at, size = 0, len(page)
    last = page.rfind(">") + 1  # behind it no tag ends, only a comment can begin
    while at < size:
        m = TAG.search(page, at, last) if at < last else None
        if not m:
            comment = page.find("<!--", at)
            held.append(page[at:] if comment < 0 else page[at:comment])
            break
        held.append(page[at:m.start()])
        at = m.end()
        if m[0].startswith("<!--") and not m[0].endswith("-->"):
            break
        if not m[2]:
            continue
        tag, zone = m[2].lower(), open_.zone()
        if tag not in INLINE:
            close()
        if tag == "br":
            held.append(" ")
        elif m[1]:
            open_.end(tag)
        elif tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else size
        elif tag not in VOID and not m[3].endswith("/"):
            if tag == "p" or tag == "li":
                open_.reopen(tag)
                zone = open_.zone()
            if zone != REMOVED:
                zone = REMOVED if _is_chrome(tag, m[3], zone == OWN) else OWN if tag in ARTICLE else zone
            open_.push(tag, zone)
    close()
    return out


def common_lines(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Indices in `a` of one longest common subsequence with `b`, in order.

    Equal ends are cut off first. Where few places match, piles of them are kept patience-style; where many do, rows of the
    classic table are made 64 cells at a time, and halved until those that are kept fit TABLE_BYTES.
    """
    n = min(len(a), len(b))
    same = np.flatnonzero(a[:n] != b[:n])
    head = int(same[0]) if len(same) else n
    a, b, n = a[head:], b[head:], n - head
    same = np.flatnonzero(a[len(a) - n:][::-1] != b[len(b) - n:][::-1])
    tail = int(same[0]) if len(same) else n
    length = len(a)
    a, b = a[:length - tail], b[:len(b) - tail]
    values, x = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = x[:len(a)], x[len(a):]
    here = np.bincount(y, minlength=len(values))
    matches = int(here[x].sum())
    middle = (_piles if matches <= FEW_MATCHES * (len(a) + len(b)) else _table)(x, y) if matches else []
    return [*range(head), *(head + i for i in middle), *range(head + length - tail, head + length)]


def _piles(a: np.ndarray, b: np.ndarray) -> list[int]:
    where: dict[int, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        where.setdefault(int(b[j]), []).append(j)
    ends: list[int] = []
    links: list[tuple] = []
    for i, x in enumerate(a.tolist()):
        for j in where.get(x, ()):
            k = bisect_left(ends, j)
            node = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(node)
            else:
                ends[k], links[k] = j, node
    out, node = [], links[-1] if links else None
    while node:
        out.append(node[0])
        node = node[1]
    return out[::-1]


def _rows(a: np.ndarray, b: np.ndarray) -> Iterator[int]:
    """A row of the table after each line of `a`: a number whose bit j is 0 where b[:j + 1] shares one line more than b[:j]."""
    places: dict[int, list[int]] = {}
    for j, x in enumerate(b.tolist()):
        places.setdefault(x, []).append(j)
    often: dict[int, int] = {}
    full = (1 << len(b)) - 1
    row = full
    for x in a.tolist():
        own = places.get(x)
        if own:
            if len(own) <= 8:
                mask = sum(1 << j for j in own)
            elif (mask := often.get(x)) is None:
                bits = np.zeros(len(b), np.uint8)
                bits[own] = 1
                mask = often[x] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
            hit = row & mask
            row = ((row + hit) | (row - hit)) & full
        yield row


def _shared_with_prefixes(row: int, size: int) -> np.ndarray:
    """Lines shared with b[:0], b[:1] ... by the row's bits."""
    bits = np.unpackbits(np.frombuffer(row.to_bytes(size // 8 + 1, "little"), np.uint8), bitorder="little")[:size]
    return np.concatenate(([0], np.cumsum(1 - bits.astype(np.int64))))


def _table(a: np.ndarray, b: np.ndarray) -> list[int]:
    n, m = len(a), len(b)
    if not n or not m:
        return []
    if n * m > 8 * TABLE_BYTES and n > 1:
        half = n // 2
        for first in _rows(a[:half], b):
            pass
        for second in _rows(a[half:][::-1], b[::-1]):
            pass
        at = int(np.argmax(_shared_with_prefixes(first, m) + _shared_with_prefixes(second, m)[::-1]))
        return _table(a[:half], b[:at]) + [half + i for i in _table(a[half:], b[at:])]
    rows, out, j = list(_rows(a, b)), [], m
    i = n
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
            continue
        i -= 1
        if not i or rows[i - 1] >> (j - 1) & 1:
            out.append(i)
            j -= 1
    return out[::-1]


def candidate_lines(page: str) -> tuple[bool, list[str]]:
    """Whether the page marks its article, and the lines that may be main text: those inside it, or all that are not furniture."""
    lines = lines_of(page)
    marked = any(zone == OWN for _, zone in lines)
    return marked, [text for text, zone in lines if zone == (OWN if marked else OTHER)]


def shared_lines(own: np.ndarray, near: np.ndarray, far: np.ndarray, marked: bool) -> list[int]:
    """Lines that go: shared with the nearer neighbour; in a marked article, those shared with both that stand at its edges.

    A sentence that one neighbour repeats, or that stands between lines of the article's own, is no furniture.
    """
    shared = common_lines(own, near)
    if marked and shared:
        both = set(shared).intersection(common_lines(own, far))
        head = next((i for i in range(len(own)) if i not in both), len(own))
        tail = next((i for i in range(len(own), head, -1) if i - 1 not in both), head)
        shared = [*range(head), *range(tail, len(own))]
    return shared


def own_text(marked: bool, texts: list[str], shared: list[int]) -> str:
    """The lines that are not shared; all of a marked article of which the neighbours have SAME_ARTICLE, as all carry it."""
    gone = set(shared)
    kept = [t for i, t in enumerate(texts) if i not in gone]
    if marked and sum(map(len, kept)) <= (1 - SAME_ARTICLE) * sum(map(len, texts)):
        kept = texts
    return "\n".join(kept)


def common_prefix(a: str | None, b: str | None) -> int:
    """Characters that two paths share from the start; -1 where one is missing."""
    return -1 if a is None or b is None else len(os.path.commonprefix([a, b]))


def neighbours(paths: DataFrame) -> DataFrame:
    """(host, path, near, far): for each path of a host the `uid` of the paths sorted before and after it, first the one with
    which it has more characters in common from the start; the one before where they have as many. Null where there is none.

    Paths are sorted over all tasks; only the first and last row of every task meet in one place.
    """
    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before, held = None, None  # the row before, and the row that waits for its successor

        def row(after, last: bool) -> tuple:
            a, b = (x if x and x[0] == held[0] else (None, None, None) for x in (before, after))
            return (*held, a[2], b[2], common_prefix(held[1], a[1]), common_prefix(held[1], b[1]), before is None, last)

        for frame in batches:
            rows = []
            for now in frame.itertuples(index=False, name=None):
                if held:
                    rows.append(row(now, False))
                    before = held
                held = now
            yield pd.DataFrame(rows, columns=columns)
        if held:
            yield pd.DataFrame([row(None, True)], columns=columns)

    columns = ["host", "path", "uid", "before", "after", "n_before", "n_after", "first", "last"]
    schema = "host string, path string, uid string, before string, after string, n_before int, n_after int, first boolean, last boolean"
    rows = staged(paths.repartitionByRange("host", "path").sortWithinPartitions("host", "path").mapInPandas(stream, schema), "paths")
    order = Window.orderBy("host", "path")  # two rows a task

    def beside(step, own: str, column: str):
        return F.when(step("host").over(order) == F.col("host"), step(column).over(order)).alias(own)

    # As common_prefix, for two rows a task.
    common = ("CASE WHEN {0} IS NULL THEN -1 ELSE aggregate(sequence(1, greatest(1, least(length(path), length({0})))), 0,"
              " (n, i) -> IF(n = i - 1 AND i <= length(path) AND substr(path, i, 1) = substr({0}, i, 1), i, n)) END")
    edges = (rows.where("first OR last")
             .select("host", "path", beside(F.lag, "_before", "uid"), beside(F.lag, "_path_before", "path"),
                     beside(F.lead, "_after", "uid"), beside(F.lead, "_path_after", "path"))
             .select("host", "path", "_before", "_after", F.expr(common.format("_path_before")).alias("_n_before"),
                     F.expr(common.format("_path_after")).alias("_n_after")))
    joined = rows.join(edges, ["host", "path"], "left")
    before, n_before = (F.when(F.col("first"), F.col(f"_{c}")).otherwise(F.col(c)) for c in ("before", "n_before"))
    after, n_after = (F.when(F.col("last"), F.col(f"_{c}")).otherwise(F.col(c)) for c in ("after", "n_after"))
    swap = n_after > n_before
    return joined.select("host", "path", F.when(swap, after).otherwise(before).alias("near"), F.when(swap, before).otherwise(after).alias("far"))


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars.

    Lines are those that may be main text, on either side of a comparison. Null html is empty, null urls share a nameless host and path; pages alone on their host lose no line. Pages of one
    path are never paired with each other. Repeated rows repeat their result; an empty table gives no rows.
    """
    url = F.coalesce("url", F.lit(""))
    page = F.coalesce("html", F.lit(""))
    parts = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)([^?#]*)"
    rows = pages.select("page_id", "url", page.alias("html"), F.md5(F.concat_ws("\n", F.col("page_id").cast("string"), url, page)).alias("uid"),
                        F.lower(F.regexp_extract(url, parts, 1)).alias("host"), F.regexp_extract(url, parts, 2).alias("path"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [candidate_lines(p.as_py()) for p in b.column("html")]
            lines = [np.asarray([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64).tobytes() for _, texts in found]
            yield pa.RecordBatch.from_arrays([b.column("uid"), b.column("host"), b.column("path"), pa.array([m for m, _ in found], pa.bool_()),
                                              pa.array(lines, pa.binary())], names=["uid", "host", "path", "marked", "lines"])

    lines = rows.select("uid", "host", "path", "html").mapInArrow(hashed, "uid string, host string, path string, marked boolean, lines binary")
    lines = staged(lines.dropDuplicates(["uid"]), "lines")
    pairs = neighbours(lines.groupBy("host", "path").agg(F.min("uid").alias("uid"))).where("near IS NOT NULL")
    near = lines.select(F.col("uid").alias("near"), F.col("lines").alias("near_lines"))
    far = lines.select(F.col("uid").alias("far"), F.col("lines").alias("far_lines"))
    aligned = lines.join(pairs, ["host", "path"]).join(near, "near").join(far, "far", "left").select("uid", "marked", "lines", "near_lines", "far_lines")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hashes(value: pa.Scalar) -> np.ndarray:
            return np.frombuffer(value.as_buffer() if value.is_valid else b"", np.uint64)

        for b in batches:
            shared = [shared_lines(*map(hashes, values), marked.as_py())
                      for marked, *values in zip(*(b.column(c) for c in ("marked", "lines", "near_lines", "far_lines")))]
            yield pa.RecordBatch.from_arrays([b.column("uid"), pa.array(shared, pa.list_(pa.int32()))], names=["uid", "shared"])

    shared = aligned.mapInArrow(align, "uid string, shared array<int>").where(F.size("shared") > 0)

    # What may be main text travels to the join, compressed, not the page around it; no line holds a line end.
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [candidate_lines(p.as_py()) for p in b.column("html")]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), b.column("uid"), pa.array([m for m, _ in found], pa.bool_()),
                 pa.array([zlib.compress("\n".join(texts).encode()) for _, texts in found], pa.binary())], names=["page_id", "url", "uid", "marked", "texts"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [own_text(marked.as_py(), [t for t in zlib.decompress(held.as_py()).decode().split("\n") if t], shared.as_py() or [])
                    for marked, held, shared in zip(*(b.column(c) for c in ("marked", "texts", "shared")))]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(text, pa.string()),
                                              pa.array([len(t) for t in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    held = rows.select("page_id", "url", "html", "uid").mapInArrow(read, f"page_id {kind}, url string, uid string, marked boolean, texts binary")
    whole = held.join(shared, "uid", "left").select("page_id", "url", "marked", "texts", "shared")
    return whole.mapInArrow(cut, f"page_id {kind}, url string, text string, n_chars long")
