"""Secrets in texts and in what is encoded inside them.

Each text is the first layer of a worklist. A layer is scanned for the kinds of
secret; what it holds in an encoded form is unwrapped into further layers,
which are scanned and unwrapped in turn until nothing new appears:

* ``url``: all percent escapes of the layer (a form's ``+`` stays);
* ``unicode``: all ``\\uXXXX``, ``\\u{X}``, ``\\UXXXXXXXX``, ``\\xXX``,
  ``&#N;`` and ``&#xX;`` escapes, and backslashes before quotes, slashes and backslashes;
* ``base64``: each run in the usual or the URL-safe alphabet, also over lines,
  if what it says is text or compressed;
* ``compressed``: gzip, zlib, bzip2 and xz, wherever base64 says such bytes.

A layer knows which code points of the text it came from: one to one for
escapes and base64, the whole run for compressed bytes. So every span found in
any layer is named by its place in the text. A layer that equals one already
done at the same place is not done again, so endless nesting (a text that
unwraps to itself, an archive that holds itself) ends. Work is linear in the
length of all layers together. Compressed bytes are opened up to ``MOST``
bytes a layer, which bounds a worker's memory against bombs; a layer beyond
is left closed and counted in ``n_closed``, never scanned in part.

Defined results: null and empty texts have no spans. A span that several
layers give is listed once. Repeated rows are each answered; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces

#: The kinds of secret in their order, the group that is the secret, and its least length.
KINDS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
)
#: Bytes that one compressed layer may open to.
MOST = 64 << 20
#: Characters that a run of base64 must have.
LEAST_RUN = 16

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"\\[\\\"'/]|(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});")
_RUN = re.compile(r"[A-Za-z0-9+/_-]{%d,}(?:\r?\n[A-Za-z0-9+/_-]{4,})*={0,2}" % LEAST_RUN)
_LINE = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % LEAST_RUN)
_NOT_TEXT = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
_OPENERS = (
    (b"\x1f\x8b", lambda: zlib.decompressobj(31)),
    (b"\x78\x01", zlib.decompressobj), (b"\x78\x5e", zlib.decompressobj), (b"\x78\x9c", zlib.decompressobj), (b"\x78\xda", zlib.decompressobj),
    (b"BZh", bz2.BZ2Decompressor),
    (b"\xfd7zXZ\x00", lzma.LZMADecompressor),
)


@dataclass
class Layer:
    """A text, and for each of its code points the places [starts, stops) in the first text."""

    text: str
    starts: np.ndarray
    stops: np.ndarray
    path: str = ""

    def place(self, a: int, b: int) -> tuple[int, int]:
        return int(self.starts[a]), int(self.stops[b - 1])

    def key(self) -> tuple:
        at = (int(self.starts[0]), int(self.stops[-1])) if self.text else (0, 0)
        return (hashlib.blake2b(self.text.encode("utf-8", "surrogatepass"), digest_size=16).digest(), *at)


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, stop) of the secrets in a text, leftmost and not overlapping within a kind."""
    return [(kind, *m.span()) for kind, pattern, group, least in KINDS for m in pattern.finditer(text) if len(m[group]) >= least]


def _utf8(raw: bytes) -> list[tuple[str, int, int]]:
    """Characters of bytes with the bytes [a, b) of each; bytes that are no UTF-8 are one replacement character each."""
    out, i = [], 0
    while i < len(raw):
        n = 1 if raw[i] < 0x80 else 2 if raw[i] < 0xE0 else 3 if raw[i] < 0xF0 else 4
        try:
            c = raw[i: i + n].decode("utf-8")
        except UnicodeDecodeError:
            c, n = "�", 1
        out.append((c, i, i + n))
        i += n
    return out


def _percent(m: re.Match) -> list[tuple[str, int, int]]:
    return [(c, m.start() + 3 * a, m.start() + 3 * b) for c, a, b in _utf8(bytes.fromhex(m[0].replace("%", "")))]


def _code(n: int, as_is: str) -> str:
    return chr(n) if n < 0xD800 or 0xE000 <= n <= 0x10FFFF else as_is


def _escape(m: re.Match) -> list[tuple[str, int, int]]:
    s, a, b = m[0], m.start(), m.end()
    if len(s) == 2:
        return [(s[1], a, b)]
    if s.startswith("&"):
        n = int(s[3:-1], 16) if s[2] in "xX" else int(s[2:-1])
    elif s.startswith("\\u") and s[2] != "{":
        units, out, i = [int(x, 16) for x in s.split("\\u")[1:]], [], 0
        while i < len(units):
            pair = i + 1 < len(units) and 0xD800 <= units[i] < 0xDC00 <= units[i + 1] < 0xE000
            n = 0x10000 + ((units[i] - 0xD800) << 10) + units[i + 1] - 0xDC00 if pair else units[i]
            out.append((_code(n, "�"), a + 6 * i, a + 6 * (i + 1 + pair)))
            i += 1 + pair
        return out
    else:
        n = int(s[3:-1] if s[2] == "{" else s[2:], 16)
    return [(_code(n, "�"), a, b)]


def _unescaped(layer: Layer, pattern: re.Pattern, decode, name: str) -> Layer | None:
    """The layer with every match decoded, None if there is none."""
    parts, starts, stops, at = [], [], [], 0
    for m in pattern.finditer(layer.text):
        parts.append(layer.text[at: m.start()])
        starts.append(layer.starts[at: m.start()])
        stops.append(layer.stops[at: m.start()])
        chars = decode(m)
        parts.append("".join(c for c, _, _ in chars))
        starts.append(layer.starts[[a for _, a, _ in chars]])
        stops.append(layer.stops[[b - 1 for _, _, b in chars]])
        at = m.end()
    if not parts:
        return None
    parts.append(layer.text[at:])
    return Layer("".join(parts), np.concatenate([*starts, layer.starts[at:]]), np.concatenate([*stops, layer.stops[at:]]), f"{layer.path}/{name}")


def open_compressed(raw: bytes, most: int = MOST) -> tuple[bytes | None, bool]:
    """What compressed bytes hold (None if they are not), and whether they were left closed as larger than ``most``."""
    for magic, opener in _OPENERS:
        if raw.startswith(magic):
            box = opener()
            try:
                out = box.decompress(raw, most + 1)
            except (zlib.error, OSError, ValueError, EOFError, lzma.LZMAError):
                continue
            while box.unused_data.startswith(magic) and len(out) <= most:  # archives end to end
                rest, box = box.unused_data, opener()
                try:
                    out += box.decompress(rest, most + 1 - len(out))
                except (zlib.error, OSError, ValueError, EOFError, lzma.LZMAError):
                    break
            if len(out) > most:
                return None, True
            if box.eof or out:
                return out, False
    return None, False


def _said(raw: bytes) -> str | None:
    """Bytes as a text, None if they are none."""
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return None if not text or _NOT_TEXT.search(text) else text


def _base64(layer: Layer, most: int) -> Iterator[Layer | None]:
    """Layers that runs of base64 say; None for each that was left closed."""
    def tried(a: int, b: int) -> list[Layer | None]:
        body = layer.text[a:b].translate({13: None, 10: None, 61: None, 45: 43, 95: 47})
        if len(body) % 4 == 1:
            return []
        raw = binascii.a2b_base64(body + "=" * (-len(body) % 4))
        text = _said(raw)
        if text is not None:
            run = np.frombuffer(layer.text[a:b].encode(), np.uint8)
            at = a + np.flatnonzero((run != 13) & (run != 10) & (run != 61))
            sizes = np.ones(len(text), np.int64) if text.isascii() else np.array([len(c.encode()) for c in text])
            stop = np.cumsum(sizes)  # byte i lies in the characters from 4 i / 3 on
            return [Layer(text, layer.starts[at[(stop - sizes) * 8 // 6]], layer.stops[at[(stop * 8 - 1) // 6]], f"{layer.path}/base64")]
        opened, closed, path = raw, False, f"{layer.path}/base64"
        seen = set()
        while opened is not None and not closed and (d := hashlib.blake2b(opened, digest_size=16).digest()) not in seen:
            seen.add(d)  # an archive that holds itself ends here
            text = _said(opened) if path.endswith("compressed") else None
            if text is not None:
                x, y = layer.place(a, b)
                return [Layer(text, np.full(len(text), x), np.full(len(text), y), path)]
            opened, closed = open_compressed(opened, most)
            path += "/compressed"
        return [None] if closed else []

    for m in _RUN.finditer(layer.text):
        found = tried(*m.span())
        if not found and "\n" in m[0]:  # lines of their own rather than one run
            found = [x for line in _LINE.finditer(layer.text, *m.span()) for x in tried(*line.span())]
        yield from found


def find(text: str, most: int = MOST) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int, str]], int]:
    """(kind, start, stop) of the text itself, (kind, start, stop, path) of all layers, and the number of closed layers.

    ``path`` names what was unwrapped, the shortest way if several give a span.
    """
    base = scan(text)
    found: dict[tuple[str, int, int], str] = dict.fromkeys(base, "")
    closed = 0
    if "%" not in text and "\\" not in text and "&#" not in text and not _LINE.search(text):
        return base, [(*s, "") for s in base], 0
    everywhere = np.arange(len(text) + 1)
    first = Layer(text, everywhere[:-1], everywhere[1:])
    work, done = deque([first]), {first.key()}
    while work:
        layer = work.popleft()
        if layer.path:
            for kind, a, b in scan(layer.text):
                found.setdefault((kind, *layer.place(a, b)), layer.path)
        inner = [_unescaped(layer, _PERCENT, _percent, "url") if "%" in layer.text else None,
                 _unescaped(layer, _ESCAPE, _escape, "unicode") if "\\" in layer.text or "&#" in layer.text else None]
        inner = [x for x in inner if x is not None]
        for x in _base64(layer, most):
            if x is None:
                closed += 1
            else:
                inner.append(x)
        for x in inner:
            if (k := x.key()) not in done:
                done.add(k)
                work.append(x)
    return base, [(*s, path) for s, path in found.items()], closed


_ORDER = {kind: i for i, (kind, *_) in enumerate(KINDS)}
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("path", pa.string())]))


def _listed(spans) -> list[dict]:
    ordered = sorted(spans, key=lambda s: (s[1], _ORDER[s[0]], s[2]))
    return [{"kind": s[0], "start": s[1], "stop": s[2], "path": s[3] if len(s) > 3 else ""} for s in ordered]


def find_secrets(docs: DataFrame, most: int = MOST) -> DataFrame:
    """doc_id, base and spans (arrays of kind, start, stop, path by start, then kind), n_closed; map only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                base, spans, closed = [], [], []
                for text in part.column("text").to_pylist():
                    own, every, n = find(text or "", most)
                    base.append(_listed(own))
                    spans.append(_listed(every))
                    closed.append(n)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(base, _SPANS), pa.array(spans, _SPANS), pa.array(closed, pa.int32())], names=["doc_id", "base", "spans", "n_closed"])

    span = "array<struct<kind:string,start:int,stop:int,path:string>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id long, base {span}, spans {span}, n_closed int")


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def secret_digest(found: DataFrame) -> DataFrame:
    """doc_id, the number of base spans of each kind, base_sha256, spans, and n_closed."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *(count(kind) for kind, *_ in KINDS), F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"), "n_closed")
