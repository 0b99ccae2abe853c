"""Main text of web pages by differencing pages of neighbouring URLs.

Pages are ordered by (host, URL path, canonical URL). The partners of a page are
those of the same host next to it in that order: on each side the first one of
another canonical URL (the query may differ, tracking parameters don't count)
and the first one of another path, however many pages stand between. Pages
without a URL all differ. The partner is the one whose path shares the longer
prefix (of equally near ones, the one that shares more lines). Both pages
become text lines (blocks), the lines are aligned by a longest common
subsequence, and the lines shared with the partner are deleted: menus, notices
and footers recur, articles don't.

Pages can also share prose: copies of an article, or a common opening line. So
a copy is no partner if there is another one, and nothing is deleted if there is
none. Copies are pages that are equal but for a few words, or that share nearly
all of their text, most of it in long lines (a short article under the same long
menus is no copy). And an exact check follows the differencing: a shared line
stays if the markup says that it is article text (inside ``article`` or
``main``), and lines that the markup says are no content (menus, forms, adverts,
comments) go even if the partner lacks them. All other lines stay if they are
the page's own and go if they are shared, on pages with and without articles.

To give each page its partners, the keys alone are range-partitioned once to
learn each range's first and last key, and the first and last of another URL and
of another path than these (a row a range on the driver). Then each page goes to
its range, and the partners that a range lacks also there. Every task walks its
sorted pages; those of one path wait for the next path in a temporary file, so a
handful of pages are in memory.

Defined results: null or empty html gives an empty text. White space is what
Python's ``str.split`` takes for it, so a no-break space becomes a space too. A
tag in which the page is cut is no text. A null URL is host "" and path "". Equal pages are each answered. A page without a partner keeps all
lines but those the markup excludes. An empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import bisect
import html
import pickle
import re
import tempfile
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOCK, pieces
from .revisits import canonical_url

#: Ranges per shuffle partition, and MB of waiting pages that a task holds in memory.
RANGES, WAITING_MB = 4, 8
#: Copies differ in so many words at most, or share this much of their text, most of it in lines of so many words.
COPY_WORDS, COPY_SHARE, PROSE_WORDS = 5, 0.9, 10

ARTICLE, OTHER, BOILER = 0, 1, 2
#: Roles of open elements only: excluded by a class word, and inside a form. Their lines are BOILER, but an article in them is one.
_WORDED, _FORM = 3, 4
#: Share of a page's text that isn't excluded above which a form is the page's wrapper.
WRAPPER_SHARE = 0.5

#: Element names by role.
_RAW = frozenset("script style noscript template textarea svg iframe".split())
_BOILER = frozenset("head nav footer aside form button select dialog menu".split())
#: Elements that have no content, and those whose start ends a paragraph.
_VOID = frozenset("area base basefont br col embed frame hr img input keygen link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main "
    "menu nav ol p pre section table ul".split())
#: Elements that a start tag ends without an end tag, and the elements that shield them from it.
_ITEM = "ul ol menu dir table article section main".split()
_IMPLIED = {
    "li": (("li",), _ITEM), "dt": (("dt", "dd"), ["dl", *_ITEM]), "dd": (("dt", "dd"), ["dl", *_ITEM]), "td": (("td", "th"), ["table"]),
    "th": (("td", "th"), ["table"]), "tr": (("tr",), ["table"]), "a": (("a",), ["table"])}
_SHIELDS = {"p": "button table td th caption".split()} | {t: x for t, (_, x) in _IMPLIED.items() if t != "a"}
_INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
#: Words in class, id or role that mark an element as no content.
_MARKED = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments complementary contentinfo consent cookie cookies footer "
    "hidden login masthead menu modal nav navbar navigation newsletter notice notification overlay popup promo related replies search share sharing sidebar "
    "signup social sponsor sponsored subscribe subscription toolbar widget".split())
#: Class words that mark as they are, and what may stand before and after a marked word in one.
_MARKED_WHOLE = frozenset("site-header site-top topbar top-bar commentlist sharedaddy".split())
_BEFORE = frozenset("site top main page global primary secondary left right bottom post entry article blog user users reader readers single".split())
_AFTER = frozenset(
    "area author authors avatar bar block body box button buttons child children container content count date depth even footer form group header heading icon "
    "icons inline inner item items label left level link links list main meta metadata odd outer panel parent reply right row section text thread time title top "
    "tools wrap wrapper".split())

#: A tag that never ends runs to the end of the page, so that no text is looked through twice.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>])*+)(?:>|(\Z))|<[!?][^>]*+(?:>|(\Z))", re.S)
#: A page cut before a tag's name, and inside a tag: nothing but a name, or attributes with values.
_CUT = re.compile(r"</?\Z")
_CUT_TAG = re.compile(r"</?[^\s=]*+(?:\s*+|[^=]*+=.*+)", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?")
_UNSEEN = re.compile(r"display\s*:\s*none")
_PARTS = re.compile(r"[-_]+")
#: Elements that no class word excludes, and those that nothing excludes.
_WHOLE = frozenset("html body main article".split())
_PAGE = frozenset("html body".split())


def _marked(word: str) -> bool:
    """Whether a class word is a marked word with nothing but a place before it and parts of such an element after it.

    ``cookie-banner``, ``ad-1``, ``main-menu`` and ``comment-list`` are; ``has-sidebar``,
    ``share-price`` and ``content-sidebar-wrap`` are not.
    """
    if word in _MARKED_WHOLE:
        return True
    parts = [x for x in _PARTS.split(word) if x and not x.isdigit()]
    while len(parts) > 1 and parts[0] in _BEFORE:
        del parts[0]
    return bool(parts) and parts[0] in _MARKED and all(x in _MARKED or x in _AFTER for x in parts[1:])


def _excluded(tag: str, attributes: str) -> int | None:
    """The role by which its attributes exclude an element: BOILER if it is not seen, _WORDED by a class word."""
    found = None
    if tag in _PAGE:
        return None
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id", "role"):
            if found is None and tag not in _WHOLE and any(map(_marked, value.split())):
                found = _WORDED
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _UNSEEN.search(value):
            return BOILER
    return found


class _Open:
    """The open elements, where each tag stands among them, and which of them set a role."""

    def __init__(self):
        self.stack: list[str] = [""]
        self.places: dict[str, list[int]] = {}
        self.marks: list[tuple[int, int]] = [(0, OTHER)]

    @property
    def role(self) -> int:
        return self.marks[-1][1]

    @property
    def outer(self) -> int:
        """The role around the element that set the present one."""
        return self.marks[-2][1]

    def last(self, tag: str) -> int:
        """Place of the last open ``tag``, 0 if there is none."""
        at = self.places.get(tag)
        return at[-1] if at else 0

    def push(self, tag: str, role: int | None) -> None:
        if role is not None and not (role == _WORDED and self.role == BOILER):
            self.marks.append((len(self.stack), role))
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append(tag)

    def cut(self, place: int) -> None:
        """Ends the element at ``place`` and all that are open inside it."""
        while len(self.stack) > place:
            if tag := self.stack.pop():
                self.places[tag].pop()
        while self.marks[-1][0] >= place:
            self.marks.pop()

    def end(self, tag: str, shields: Iterable[str] = ()) -> None:
        """Ends the last ``tag``, unless a shield is open inside it."""
        place = self.last(tag)
        if place and all(self.last(x) < place for x in shields):
            self.cut(place)

    def end_inline(self, tag: str) -> None:
        """Ends the last ``tag``; blocks that were opened inside it and not ended stay open."""
        place = self.last(tag)
        if not place:
            return
        if all(x in _INLINE for x in self.stack[place + 1: place + 9]) and len(self.stack) <= place + 9:
            self.cut(place)
            return
        self.places[tag].pop()
        self.stack[place] = ""
        i = bisect.bisect_left(self.marks, (place, -1))
        if i < len(self.marks) and self.marks[i][0] == place:
            del self.marks[i]


def _self_closed(attributes: str) -> bool:
    """Whether a tag ends in a slash that is not part of an unquoted value."""
    s = attributes.rstrip()
    return s.endswith("/") and "=" not in s[max(s.rfind(c) for c in " \t\n\r\f\"'") + 1:]


def lines_of(page: str) -> list[tuple[int, str]]:
    """(role, text) of each block of a page in order; a block ends at every tag that is not inline.

    End tags may be left out as HTML allows: a paragraph ends at the next block,
    an item or cell at the next one. What is left open inside an element ends with it.

    An article inside a form or an element excluded by a class word is article
    text, unless that element is itself inside an article (comments, related
    ones). A form with most of the text that nothing else excludes wraps the
    page: its lines have the role that they have without it.
    """
    out: list[tuple[int, str]] = []
    buf: list[str] = []
    opened = _Open()
    forms: list[list[tuple[int, int]]] = []  # for each form, its lines and their roles without it

    def end_block() -> None:
        text = " ".join(html.unescape("".join(buf)).split())
        buf.clear()
        if text:
            role = opened.role
            if role == _FORM:
                forms[-1].append((len(out), opened.outer))
            out.append((min(role, BOILER), text))

    at = 0
    while m := _TOKEN.search(page, at):
        buf.append(page[at: m.start()])
        at = m.end()
        if m[4] is not None or m[5] is not None:
            if m[2] is not None and not _CUT_TAG.fullmatch(m[0]) and buf[-1].strip():
                buf.append(m[0])  # words after a smaller-than sign
            break
        if m[2] is None:
            continue
        tag, closing, attributes = m[2].lower(), bool(m[1]), m[3]
        if tag in _INLINE:
            excluded = _excluded(tag, attributes) if attributes and not closing else None
            if tag in _VOID or excluded is None and not opened.last(tag):
                continue
            end_block()
            if closing:
                opened.end_inline(tag)
                continue
            if tag == "a":
                opened.end_inline(tag)
            if not _self_closed(attributes) and (excluded is not None or opened.last(tag)):
                opened.push(tag, excluded)
            continue
        if tag in _RAW and not closing:
            whole = _self_closed(attributes)
            if whole and tag in ("script", "style"):  # browsers don't heed the slash here
                stop = re.compile(rf"<(/?){tag}\b", re.I).search(page, at)
                whole = not (stop and stop[1])
            if not whole:
                stop = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = stop.end() if stop else len(page)
            continue
        end_block()
        if closing:
            opened.end(tag, _SHIELDS.get(tag, ()))
            continue
        if tag in _BLOCKS:
            opened.end("p", _SHIELDS["p"])
        for x in _IMPLIED[tag][0] if tag in _IMPLIED else ():
            opened.end(x, _IMPLIED[tag][1])
        if tag in _VOID or _self_closed(attributes):
            continue
        outer, role = opened.role, _excluded(tag, attributes) if attributes else None
        if tag == "form" and role is None and outer in (ARTICLE, OTHER):
            role = _FORM
            forms.append([])
        elif tag == "form":
            pass
        elif tag in _BOILER or tag == "header" and outer != ARTICLE:
            role = BOILER
        elif tag in ("article", "main") and role is None and outer != BOILER and (outer in (ARTICLE, OTHER) or not opened.last("article")):
            role = ARTICLE
        opened.push(tag, role)
    buf.append(_CUT.sub("", page[at:]))  # nothing is left after a cut tag
    end_block()
    sizes = [sum(len(out[i][1]) for i, _ in form) for form in forms]
    every = sum(sizes) + sum(len(x) for role, x in out if role != BOILER)
    for form, size in zip(forms, sizes, strict=True):
        if size > WRAPPER_SHARE * every:
            for i, role in form:
                out[i] = (role, out[i][1])
    return out


def _row(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and each prefix of ``b``, by bit-parallel steps."""
    n = len(b)
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << n) - 1
    v = full
    for x in a:
        if p := places.get(x):
            u = v & p
            v = ((v + u) | (v - u)) & full
    bits = np.unpackbits(np.frombuffer((full & ~v).to_bytes(n // 8 + 1, "little"), np.uint8), bitorder="little")[:n]
    return np.concatenate(([0], np.cumsum(bits)))


def shared_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b`` (halving, so memory stays linear)."""
    out: list[int] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            out.append(i)
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            out.append(j - 1)
            j, m = j - 1, m - 1
        if i == j or k == m:
            continue
        if j - i == 1:
            if a[i] in b[k:m]:
                out.append(i)
            continue
        mid = (i + j) // 2
        total = _row(a[i:mid], b[k:m]) + _row(a[mid:j][::-1], b[k:m][::-1])[::-1]
        cut = k + int(np.argmax(total))
        todo += [(i, mid, k, cut), (mid, j, cut, m)]
    return sorted(out)


def kept_lines(lines: list[tuple[int, str]], shared: set[int]) -> list[str]:
    """Differencing deletes ``shared``; the markup check puts article text back and takes marked boilerplate out."""
    return [text for i, (role, text) in enumerate(lines) if role == ARTICLE or role == OTHER and i not in shared]


@dataclass
class _Page:
    key: tuple
    own: bool
    blob: bytes

    def __post_init__(self):
        raw = zlib.decompress(self.blob).decode()
        self.lines = [(int(x[0]), x[1:]) for x in raw.split("\n")] if raw else []
        self.hashes = [hash(x) for _, x in self.lines]
        self.size = sum(len(x) for _, x in self.lines)


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def _copies(a: _Page, b: _Page, shared: list[int]) -> bool:
    """Whether two pages are equal, or nearly: see the module's text."""
    left = Counter(a.hashes[i] for i in shared)

    def own(page: _Page) -> Counter[str]:
        """Words of the lines that the other page lacks."""
        rest, out = left.copy(), Counter()
        for (_, x), h in zip(page.lines, page.hashes, strict=True):
            if rest[h]:
                rest[h] -= 1
            else:
                out.update(x.split())
        return out

    if not shared:
        return False
    size = sum(len(a.lines[i][1]) for i in shared)
    if size < COPY_SHARE * max(a.size, b.size):
        return False
    mine, others = own(a), own(b)
    if max((mine - others).total(), (others - mine).total()) <= COPY_WORDS:
        return True
    return 2 * sum(len(x) for x in (a.lines[i][1] for i in shared) if len(x.split()) >= PROSE_WORDS) > size


def _compared(page: _Page, near: list[_Page]) -> tuple[_Page | None, list[int], bool]:
    """The partner, the lines shared with it, and whether they go: the nearest page that is no copy, or else a copy."""
    host, path, canonical = page.key[:3]
    by_prefix: dict[int, list[_Page]] = {}
    for p in near:
        if p.key[0] == host and p.key[2] != canonical:
            by_prefix.setdefault(_common(path, p.key[1]), []).append(p)
    copy = None
    for _, pages in sorted(by_prefix.items(), reverse=True):
        found = [(p, shared_lines(page.hashes, p.hashes)) for p in pages]
        differ = [x for x in found if not _copies(page, *x)]
        if differ:
            return *max(differ, key=lambda x: len(x[1])), True
        copy = copy or max(found, key=lambda x: len(x[1]))
    return (*copy, False) if copy else (None, [], False)


class _Waiting:
    """Pages of one path in order, in memory up to a size and beyond it in a temporary file."""

    def __init__(self):
        self.file = tempfile.SpooledTemporaryFile(WAITING_MB << 20)
        self.n = 0

    def add(self, page: _Page) -> None:
        pickle.dump((page.key, page.own, page.blob), self.file)
        self.n += 1

    def pages(self) -> Iterator[_Page]:
        """All in order; several readers may take turns."""
        at = 0
        for _ in range(self.n):
            self.file.seek(at)
            page = _Page(*pickle.load(self.file))
            at = self.file.tell()
            yield page


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages sorted by (range, key): answer each one of the range with the pages around it."""

    def rows() -> Iterator[tuple[int, _Page]]:
        for batch in batches:
            for part in pieces(batch, "blob"):
                for r in part.to_pylist():
                    yield r["area"], _Page(tuple(r[c] for c in _KEY), r["own"], r["blob"])

    def answered(before: _Page | None, run: _Waiting, after: _Page | None) -> Iterator[tuple]:
        """The pages of one path, between the last of the path before and the first of the path after."""
        last = page = None  # the last page of another URL, and the last one
        ahead = run.pages() if run.n > 1 else iter(())
        following = next(ahead, None)
        passed = 0  # pages up to ``following``
        for i, new in enumerate(run.pages()):
            if page is not None and page.key[2] != new.key[2]:
                last = page
            page = new
            while following is not None and (passed <= i or following.key[2] == page.key[2]):
                following, passed = next(ahead, None), passed + 1
            if page.own:
                other, shared, gone = _compared(page, [p for p in (before, last, following, after) if p is not None])
                text = " ".join(kept_lines(page.lines, set(shared) if gone else set()))
                yield page.key[3], page.key[4], text, len(text), len(page.lines), len(shared), other.key[4] if other else None
        run.file.close()

    def answers() -> Iterator[tuple]:
        area = before = page = None
        run = _Waiting()
        for new_area, new in rows():
            if page is not None and (area != new_area or page.key[:2] != new.key[:2]):
                yield from answered(before, run, new if area == new_area else None)
                before, run = page if area == new_area else None, _Waiting()
            run.add(new)
            area, page = new_area, new
        if page is not None:
            yield from answered(before, run, None)

    done: list[tuple] = []

    def flush() -> pa.RecordBatch:
        cols = list(zip(*done, strict=True)) if done else [()] * 7
        done.clear()
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=_NAMES)

    size = 0
    for row in answers():
        done.append(row)
        size += row[3] + 100
        if size > BLOCK:
            yield flush()
            size = 0
    yield flush()


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one range of sorted keys: the first and last, and the first and last of another URL and of another path than these."""
    first = last = None
    second: list[tuple | None] = [None] * len(_LEVELS)
    changed = second.copy()  # the last key before the present URL, and before the present path
    for batch in batches:
        for r in batch.to_pylist():
            key = tuple(r[c] for c in _KEY)
            if first is None:
                first = key
            else:
                for i, n in enumerate(_LEVELS):
                    if key[:n] != last[:n]:
                        second[i], changed[i] = second[i] or key, last
            last = key
    if first is not None:
        found = [None if k is None else dict(zip(_KEY, k, strict=True)) for k in (first, last, *second, *changed)]
        kind = pa.struct([(c, pa.int64() if c == "page_id" else pa.string()) for c in _KEY])
        yield pa.RecordBatch.from_arrays([pa.array([k], kind) for k in found], names=_BORDERS)


def _wanted(borders: list[tuple]) -> dict[tuple, set[int]]:
    """Ranges that need a page of another range, by its key. ``borders``: the keys _BORDERS of each range."""
    out: dict[tuple, set[int]] = {}

    def carry(order: Iterable[int], near: int, far: int, inner: int, n: int) -> None:
        """On one side: the next page whose first ``n`` parts of the key differ from those at the end of a range."""
        page = other = None  # the last page passed, and the last one that differs from it
        for i in order:
            b = borders[i]
            if page is not None:
                needed = page if page[:n] != b[near][:n] else other
                if needed is not None and needed[0] == b[near][0]:
                    out.setdefault(needed, set()).add(i)
            if b[inner] is not None:
                other = b[inner]
            elif page is not None and page[:n] != b[far][:n]:
                other = page
            page = b[far]

    every = range(len(borders))
    for i, n in enumerate(_LEVELS):
        carry(every, 0, 1, 2 + len(_LEVELS) + i, n)
        carry(reversed(every), 1, 0, 2 + i, n)
    return out


_NAMES = ["page_id", "url", "text", "n_chars", "n_lines", "n_shared", "partner"]
_RESULT = "page_id long, url string, text string, n_chars long, n_lines long, n_shared long, partner string"
_NONE = -(1 << 63)
_KEY = ["host", "path", "canonical", "page_id", "url"]
#: Parts of the key that make a URL and a path, and the keys that are known of each range.
_LEVELS = (3, 2)
_BORDERS = ["first", "last", "second_url", "second_path", "changed_url", "changed_path"]


def extract(pages: DataFrame, ranges: int = RANGES) -> DataFrame:
    """page_id, url, text, n_chars, and n_lines, n_shared, partner (the URL compared with) of each page."""
    spark = pages.sparkSession
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    # Null ids and URLs get stand-ins in the key, so that keys compare alike everywhere.
    no_host = F.when(url == "", F.concat(F.lit("#"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))).otherwise(url)
    canonical = canonical_url(url)
    keyed = pages.select(
        F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1).alias("path"),
        F.when(canonical.rlike("^[?]|^$"), no_host).otherwise(canonical).alias("canonical"),
        F.coalesce(F.col("page_id").cast("long"), F.lit(_NONE)).alias("page_id"), url.alias("url"),
        F.col("url").isNull().alias("no_url"), F.col("html").cast("string").alias("text"))
    key = _KEY
    n = int(spark.conf.get("spark.sql.shuffle.partitions")) * ranges
    of_key = "struct<" + ",".join(f"{c}:{'long' if c == 'page_id' else 'string'}" for c in key) + ">"
    found = (
        keyed.select(*key).repartitionByRange(n, *key).sortWithinPartitions(*key)
        .mapInArrow(_borders, ", ".join(f"{c} {of_key}" for c in _BORDERS)).collect()  # a row a range
    )
    borders = sorted((tuple(None if k is None else tuple(k) for k in r) for r in found), key=lambda b: b[0])
    lasts, wanted = [b[1] for b in borders], _wanted(borders)
    names = ["area", "own", *key, "blob"]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = set()  # of rows with one key, the ranges that lack them need one
        for batch in batches:
            for part in pieces(batch, "text"):
                out = []
                for r in part.to_pylist():
                    k = tuple(r[c] for c in key)
                    blob = zlib.compress("\n".join(f"{role}{x}" for role, x in lines_of(r["text"] or "")).encode(), 6)
                    area = bisect.bisect_left(lasts, k)
                    out.append((area, True, *k, blob))
                    if k in wanted and k not in sent:
                        sent.add(k)
                        out += ((other, False, *k, blob) for other in wanted[k])
                cols = list(zip(*out, strict=True))
                kinds = (pa.int32(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

    sent = keyed.mapInArrow(send, "area int, own boolean, host string, path string, canonical string, page_id long, url string, blob binary")
    walked = sent.repartition(n, "area").sortWithinPartitions("area", *key, "own").mapInArrow(_walk, _RESULT)
    blank = F.col("page_id") == _NONE
    return walked.withColumn("page_id", F.when(~blank, F.col("page_id")))
