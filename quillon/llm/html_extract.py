"""Main text of web pages by nearest-URL page differencing.

Pages are sorted by path within each host; a page's neighbour is the one before or after it whose path has the longer common
beginning. Both are cut into lines (one per HTML block), the lines are aligned by longest common subsequence, and shared ones
are deleted: a site's template repeats from page to page. What two lines must have in common depends on where they stand:

* A template's wording changes from page to page (menus, dates, adverts), its places don't. So lines outside the article's
  element, and those in elements that by tag or class can't be article text, are compared by their place: the path of
  elements and classes to them, a run of lines in one place as one.
* Lines that stand in the article's element under a tag or class that may be either (a header, a box for sharing) are compared
  by their text: if the neighbour has it too, it goes.
* Other lines in the article's element stay though the neighbour may have them: articles repeat passages.
* On pages that mark no article, lines in no suspicious element are compared by their text.

Structure decides only what differencing leaves open, for pages that are alone on their host and lines whose place the
neighbour lacks: lines outside a marked article, and in elements that can't be article text, go.

Scale: the sorted keys (host, path, a hash of the row), without the pages, give bounds of equal parts; pages are shuffled once,
by part, so that a hot host spreads over many tasks, and the first and the last page of each part go to the part next to it
as well. Neighbours are therefore the same at any number of partitions. A task streams its pages and holds three at a time.
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm import textkernel
from quillon.llm.url_filter import host_and_path
from quillon.plans.lineage import cut

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|</?[a-zA-Z][^\s/>]*(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>?", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"\s(?:hidden(?=[\s/>=])|aria-hidden\s*=\s*[\"']?true)", re.I)
_SPLIT = re.compile(r"[^a-zA-Z0-9]+|(?<=[a-z0-9])(?=[A-Z])")
#: HTML's elements without content, those whose raw content is no text of the page, and those that begin a block.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea iframe template noembed noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li listing main "
    "menu nav ol optgroup option p plaintext pre search section select summary table tbody td tfoot th thead tr ul xmp".split()
)
#: Elements, and words of class, id or role, that can't be article text, and those that may be.
_NEVER = frozenset("nav footer aside form menu button select dialog fieldset".split())
_NEVER_WORDS = frozenset(
    "nav navbar navigation menu menubar masthead footer contentinfo sidebar aside complementary ad ads advert adverts advertisement advertisements sponsor sponsored "
    "cookie cookies consent gdpr notice notices popup modal newsletter subscribe signup comment comments discussion respond replies breadcrumb breadcrumbs pagination".split()
)
_MAYBE = frozenset(["header"])
_MAYBE_WORDS = frozenset("header banner promo share sharing social related widget toolbar search login".split())
_MAIN = frozenset(["article", "main"])
_MAIN_WORDS = frozenset("main article articlebody maincontent content post entry story".split())
#: "with-sidebar" tells what an element has, not what it is.
_NOT_ITSELF = frozenset("with has no".split())
#: Bits of an alignment table that is kept whole (larger ones are split), and of a row that is taken at once.
TABLE_BITS, BLOCK = 1 << 22, 1 << 12


@dataclass(frozen=True)
class Line:
    """A block's text, its place (a hash of the elements and classes to it, for comparison within a process), and whether it stands in the article's element, in one that can't be article text, and in one
    that may be (inside the article's, if there is one)."""

    text: str
    place: int
    main: bool = False
    never: bool = False
    maybe: bool = False


def lines_of(page: str) -> list[Line]:
    """The lines of a page, in its order; blocks without text have none."""
    out: list[Line] = []
    stack: list[tuple[str, int, bool, bool, bool]] = []
    text: list[str] = []
    opened: dict[str, int] = {}
    main = never = maybe = 0
    at, size = 0, len(page)

    def flush() -> None:
        if text:
            if line := " ".join(html.unescape("".join(text)).split()):
                out.append(Line(line, stack[-1][1] if stack else 0, main > 0, never > 0, maybe > 0))
            text.clear()

    while at < size:
        m = _TOKEN.search(page, at)
        if not m:
            text.append(page[at:])
            break
        if m.start() > at:
            text.append(page[at : m.start()])
        at = m.end()
        tag = m[0]
        if tag[1] in "!?":
            continue
        name = _NAME.match(tag)[1].lower()
        if name == "br":
            text.append(" ")
        elif name in _BLOCK:
            flush()
        if tag[1] == "/":
            while opened.get(name):
                if any(stack[-1][2:]):
                    flush()
                closed, _, was_main, was_never, was_maybe = stack.pop()
                main, never, maybe = main - was_main, never - was_never, maybe - was_maybe
                opened[closed] -= 1
                if closed == name:
                    break
            continue
        if name in _RAW:
            if not tag.endswith("/>"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
                at = end.end() if end else size
            continue
        if name in _VOID:
            continue
        words: set[str] = set()
        for marks in _MARKS.findall(tag):
            words |= {x.lower() for x in _SPLIT.split("".join(marks)) if x}
        own = name not in ("html", "body")
        itself = not words & _NOT_ITSELF
        is_never = own and name not in _MAIN and (name in _NEVER or (itself and bool(words & _NEVER_WORDS)))
        is_maybe = own and not is_never and name not in _MAIN and (name in _MAYBE or (itself and bool(words & _MAYBE_WORDS)) or bool(_HIDDEN.search(tag)))
        is_main = own and not is_never and not is_maybe and (name in _MAIN or bool(words & _MAIN_WORDS))
        if is_main or is_never or is_maybe:
            flush()
        place = stack[-1][1] if stack else 0
        if name in _BLOCK or is_main or is_never or is_maybe:
            # Numbers in a class or id tell places of a template apart no better than its names do.
            place = hash((place, name, *sorted(w for w in words if w.isalpha())))
        stack.append((name, place, is_main, is_never, is_maybe))
        opened[name] = opened.get(name, 0) + 1
        main, never, maybe = main + is_main, never + is_never, maybe + is_maybe
    flush()
    return out


def _places(b: list) -> dict:
    out: dict = {}
    for k, x in enumerate(b):
        out[x] = out.get(x, 0) | 1 << k
    return out


def _lengths(a: list, b: list) -> np.ndarray:
    """Lengths of the longest common subsequence of ``a`` with each beginning of ``b``.

    A row of the alignment is a number, whose bits are 0 where the subsequence grows; it is taken in blocks of b, and what a
    block carries over to the next is kept for each line of a.
    """
    carry, grows = bytearray(len(a)), [np.zeros(1, np.int64)]
    for low in range(0, len(b), BLOCK):
        part = b[low : low + BLOCK]
        places, n = _places(part), len(part)
        v = full = (1 << n) - 1
        for i, x in enumerate(a):
            u = v & places.get(x, 0)
            if u or carry[i]:
                t = v + u + carry[i]
                carry[i] = t >> n
                v = (t | (v - u)) & full
        bits = np.unpackbits(np.frombuffer(v.to_bytes(n // 8 + 1, "little"), np.uint8), bitorder="little")[:n]
        grows.append(1 - bits.astype(np.int64))
    return np.cumsum(np.concatenate(grows))


def shared_lines(a: list, b: list) -> set[int]:
    """The places in ``a`` of a longest common subsequence with ``b``; bits stand for the lines of b.

    A table of all rows serves up to TABLE_BITS; beyond, a is halved and b is cut where the halves' subsequences add up to the
    longest, so that memory grows with the lines and not with their square.
    """
    found: set[int] = set()
    parts = [(list(range(len(a))), b)]
    while parts:
        rows, cols = parts.pop()
        both = {a[k] for k in rows} & set(cols)
        rows, cols = [k for k in rows if a[k] in both], [x for x in cols if x in both]
        if not rows:
            continue
        if len(rows) > 1 and len(rows) * len(cols) > TABLE_BITS:
            half = len(rows) // 2
            upper = _lengths([a[k] for k in rows[:half]], cols)
            lower = _lengths([a[k] for k in reversed(rows[half:])], cols[::-1])[::-1]
            j = int((upper + lower).argmax())
            parts += [(rows[:half], cols[:j]), (rows[half:], cols[j:])]
            continue
        places, full, saved = _places(cols), (1 << len(cols)) - 1, []
        v = full
        for k in rows:
            u = v & places[a[k]]
            v = ((v + u) | (v - u)) & full
            saved.append(v)
        row, col = len(rows), len(cols)
        while row and col:
            if saved[row - 1] >> (col - 1) & 1:
                col -= 1
            else:
                row -= 1
                if not row or saved[row - 1] >> (col - 1) & 1:
                    col -= 1
                    found.add(rows[row])
    return found


def _compared(lines: list[Line]) -> tuple[list[tuple[bool, int | str]], list[int]]:
    """What stands for the lines in an alignment, (by place, place or text), and the place in it of each line."""
    marked = any(x.main and not x.never for x in lines)
    keys: list[tuple[bool, int | str]] = []
    at = []
    for x in lines:
        by_place = x.never or (marked and not x.main) or (x.maybe and not marked)
        key = (by_place, x.place if by_place else x.text)
        if not (by_place and keys and keys[-1] == key):
            keys.append(key)
        at.append(len(keys) - 1)
    return keys, at


def main_text(lines: list[Line], neighbour: list[Line] | None) -> tuple[str, int]:
    """The text of a page's article, given its neighbour's lines, and the number of lines that differencing deletes."""
    marked = any(x.main and not x.never for x in lines)
    keys, at = _compared(lines)
    shared = shared_lines(keys, _compared(neighbour)[0]) if neighbour else set()
    kept, deleted = [], 0
    for x, k in zip(lines, at, strict=True):
        repeats = x.main and not x.never and not x.maybe  # an article's own passage
        if k in shared and not repeats:
            deleted += 1
        elif not x.never and (x.main if marked else not x.maybe):
            kept.append(x.text)
    return " ".join(kept), deleted


def _alike(a: str, b: str) -> int:
    """How many characters two paths have in common from the beginning."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    return low


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (host, path, ghost, html, kept columns ...) of whole parts in order; a ghost only serves as a neighbour."""

    def pages() -> Iterator[tuple | None]:
        nonlocal names, kinds
        for batch in batches:
            names, kinds = batch.schema.names[4:], batch.schema.types[4:]
            for host, path, ghost, page, *row in zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns)), strict=True):
                yield host, path, ghost, lines_of(page), row, len(page)
        yield None

    names, kinds, rows, held = [], [], [], 0
    before = this = None
    for after in pages():
        if this and not this[2]:
            near = [x for x in (before, after) if x and x[0] == this[0]]
            neighbour = max(near, key=lambda x: _alike(x[1], this[1])) if near else None
            rows.append((this[4], *main_text(this[3], neighbour[3] if neighbour else None)))
            held += this[5]
        if rows and (held > 1 << 22 or not after):
            kept = [pa.array([r[0][k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array([r[1] for r in rows], pa.string()), pa.array([len(r[1]) for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())], names=[*names, "text", "n_chars", "n_shared"])
            rows, held = [], 0
        before, this = this, after


def _parts_of(keys: DataFrame, parts: int) -> tuple[list[tuple], list[tuple]]:
    """The first and the last key of each of some ``parts`` equal parts of the sorted keys: two short rows a part."""
    order = list(keys.columns)
    placed = cut(keys.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "keys")
    ends = placed.groupBy("part").agg(F.min(F.struct(*order)).alias("first"), F.max(F.struct(*order)).alias("last")).collect()
    return sorted(tuple(r["first"]) for r in ends), sorted(tuple(r["last"]) for r in ends)


def _numbers(firsts: list[tuple], lasts: list[tuple]):
    """A function of key columns: the parts that a page goes to, its own first."""
    last_of = {x: k for k, x in enumerate(lasts)}
    first_of = {x: k for k, x in enumerate(firsts)}

    @F.pandas_udf("array<int>")
    def numbers(host: pd.Series, path: pd.Series, tie: pd.Series) -> pd.Series:
        out = []
        for key in zip(host, path, tie, strict=True):
            own = bisect.bisect_right(firsts, key) - 1
            out.append([own, *([last_of[key] + 1] if last_of.get(key, len(lasts)) < len(lasts) - 1 else []), *([first_of[key] - 1] if first_of.get(key, 0) else [])])
        return pd.Series(out)

    return numbers


def extract(pages: DataFrame, url: str = "url", page: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` with ``text`` (empty if none), ``n_chars``, its code points, and ``n_shared``, the lines that
    differencing deleted.

    Null and empty pages have no text. Null URLs, and those without ``://``, count as one host of empty name. Ties in the
    path go by a hash of the columns ``keep``; repeated rows are each other's neighbours. A page without neighbour on its host is judged
    by its structure. Pages of any length are read whole. An empty table gives none. Columns of ``keep`` that are called like
    the results are replaced; others don't matter.
    """
    keep = tuple(k for k in keep if k not in ("text", "n_chars", "n_shared"))
    host, path = host_and_path(F.col(url))
    kinds = dict(pages.dtypes)
    carried = [F.col(f"`{k}`").alias(f"_keep_{i}") for i, k in enumerate(keep)]
    tie = F.xxhash64(F.lit(0), *[F.col(f"`{k}`").cast("string") for k in keep if k != page])
    rows = pages.select(host.alias("_host"), path.alias("_path"), tie.alias("_tie"), F.coalesce(F.col(page), F.lit("")).alias("_html"), *carried)
    partitions = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    firsts, lasts = _parts_of(rows.select("_host", "_path", "_tie"), partitions)
    parts = F.posexplode(_numbers(firsts, lasts)("_host", "_path", "_tie")).alias("_ghost", "_part")
    order = ["_part", "_host", "_path", "_tie"]
    dealt = rows.select("*", parts).repartitionById(partitions, F.col("_part")).sortWithinPartitions(*order)
    inner = ["_host", "_path", (F.col("_ghost") > 0).alias("_ghost"), "_html", *[c for c in rows.columns if c.startswith("_keep_")]]
    schema = ", ".join([*(f"_keep_{i} {kinds[k]}" for i, k in enumerate(keep)), "text string, n_chars long, n_shared long"])
    told = textkernel.mapped(dealt.select(*inner), _extract, schema)
    return told.select(*[F.col(f"_keep_{i}").alias(k) for i, k in enumerate(keep)], "text", "n_chars", "n_shared")
