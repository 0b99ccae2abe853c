"""Secrets: base spans by hand-walked matching, nested layers by exact round trips through every encoding."""

from __future__ import annotations

import base64
import bz2
import gzip
import hashlib
import json
import lzma
import random
import string
import urllib.parse
import zlib

import pytest

from footfall.llm import queries, secrets

SF = "/root/testdata/sf0.001"
SECRET = "api_key = Zx81QpLmTTw0093kd"
WORD = set(string.ascii_letters + string.digits + "+/_.=-")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")


def base(t):
    """(kind, start, stop) by walking the text, no regular expressions."""
    out = []
    i = 0
    while i < len(t):
        low = "".join(c.lower() if c.isascii() else c for c in t[i: i + 8])
        name = next((n for n in NAMES if low.startswith(n)), None)
        stop = None
        for quote in (True, False):
            if name is None:
                break
            j = i + len(name)
            if quote and t[j: j + 1] in ("'", '"') and t[j: j + 1]:
                j += 1
            while t[j: j + 1] == " ":
                j += 1
            if t[j: j + 1] not in (":", "=") or not t[j: j + 1]:
                continue
            j += 1
            while t[j: j + 1] == " ":
                j += 1
            if t[j: j + 1] in ("'", '"') and t[j: j + 1]:
                j += 1
            k = j
            while k < len(t) and t[k] in WORD:
                k += 1
            if k > j:
                stop = k
                break
        if stop is None:
            i += 1
            continue
        if stop - j >= 12:
            out.append(("assign", i, stop))
        i = stop
    for kind, chars, head, least in (("access", set(string.ascii_uppercase + string.digits), "AKIA", 18), ("hex", set("0123456789abcdef"), "", 16)):
        i = 0
        while i < len(t):
            j = i + len(head)
            if not t.startswith(head, i) or j >= len(t) or t[j] not in chars:
                i += 1
                continue
            while j < len(t) and t[j] in chars:
                j += 1
            if j - i >= least:
                out.append((kind, i, j))
            i = j
    rank = {"assign": 0, "access": 1, "hex": 2}
    return sorted(out, key=lambda s: (s[1], rank[s[0]]))


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


ROWS = [
    (0, None), (1, ""), (2, SECRET), (2, SECRET), (3, "TOKEN='abcdefghijkl' AKIA" + "Q" * 14 + " AKIA" + "Q" * 13), (None, "secret:" + "a1" * 10),
    (4, "é日 password=short token=password: abcdefghijklmnop"), (5, "ſecret: abcdefghijklmnop toKen=abcdefghijklmnop"),
    (6, "x" * 400_000 + " " + SECRET), (7, "api-key=abcdefghijklmn passwd\":  \"0123456789abcdef0123"), (8, "%" * 3000 + "\\u" * 3000 + "&#" * 3000), (9, "secret=" * 2000),
    (10, "token" + " " * 20000), (11, "A" * 50_001), (12, base64.b64encode(SECRET.encode()).decode()),
]


def test_awkward_rows(spark, tmp_path):
    spark.createDataFrame([(*r, 1, "b") for r in ROWS], "doc_id long, text string, spans int, base string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    check(spark, str(tmp_path), ROWS)


def test_given_rows(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check(spark, SF, rows)


def test_no_rows(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.QUERIES["op12_nested_secrets"](spark, str(tmp_path)).collect() == []


def check(spark, sf, rows):
    got = queries.QUERIES["op12_nested_secrets"](spark, sf).collect()
    want = []
    for d, t in rows:
        spans = base(t or "")
        want.append((d, *(sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")), hashlib.sha256(joined(spans).encode()).hexdigest()))
    assert sorted(map(str, (tuple(r)[:5] for r in got))) == sorted(map(str, want))
    for r in got:
        every = set(filter(None, r["spans"].split(",")))
        if r["doc_id"] is not None:
            assert any(d == r["doc_id"] and set(filter(None, joined(base(t or "")).split(","))) <= every for d, t in rows)


def u16(s):
    return "".join(f"\\u{x:04x}" for x in memoryview(s.encode("utf-16-le")).cast("H"))


COATS = {
    "url": lambda s: urllib.parse.quote(s, safe=""),
    "url_all": lambda s: "".join(f"%{b:02X}" for b in s.encode()),
    "unicode": u16,
    "braces": lambda s: "".join(f"\\u{{{ord(c):x}}}" for c in s),
    "long": lambda s: "".join(f"\\U{ord(c):08x}" for c in s),
    "hexes": lambda s: "".join(f"\\x{ord(c):02x}" if ord(c) < 256 else c for c in s),
    "entities": lambda s: "".join(f"&#{ord(c)};" if i % 2 else f"&#x{ord(c):X};" for i, c in enumerate(s)),
    "json": lambda s: json.dumps("é" + s)[1:-1],
    "base64": lambda s: base64.b64encode(s.encode()).decode(),
    "urlsafe": lambda s: base64.urlsafe_b64encode(s.encode()).decode().rstrip("="),
    "lines": lambda s: base64.encodebytes(s.encode() * 1).decode().strip(),
    "gzip": lambda s: base64.b64encode(gzip.compress(s.encode(), mtime=0)).decode(),
    "zlib": lambda s: base64.b64encode(zlib.compress(s.encode())).decode(),
    "bz2": lambda s: base64.b64encode(bz2.compress(s.encode())).decode(),
    "xz": lambda s: base64.b64encode(lzma.compress(s.encode())).decode(),
    "twice": lambda s: base64.b64encode(gzip.compress(bz2.compress(s.encode()), mtime=0)).decode(),
}


@pytest.mark.parametrize("outer", sorted(COATS))
@pytest.mark.parametrize("inner", sorted(COATS))
def test_every_pair_of_coats(outer, inner):
    hidden = COATS[outer](COATS[inner](SECRET + " end"))
    text = f"日 before {hidden} after"
    own, spans, closed = secrets.find(text)
    assert closed == 0 and set(own) <= {s[:3] for s in spans}
    at = text.index(hidden)
    assert any(s[0] == "assign" and at <= s[1] < s[2] <= at + len(hidden) for s in spans)


def test_places_are_exact_for_escapes_and_base64():
    text = "see " + base64.b64encode(b"xxx " + SECRET.encode() + b" yyy").decode()
    (span,) = [s for s in secrets.find(text)[1] if s[0] == "assign"]
    assert span[1:3] == (4 + 4 * 8 // 6, 4 + -(-(4 + len(SECRET)) * 8 // 6)) and span[3] == "/base64"
    text = "a %41 pass%77ord=%30123456789AZ z"
    assert secrets.find(text)[1] == [("assign", 6, len(text) - 2, "/url")]


def test_random_depth_round_trips():
    rnd = random.Random(3)
    for _ in range(60):
        s, names = SECRET, [rnd.choice(sorted(COATS)) for _ in range(rnd.randint(1, 5))]
        for n in names:
            s = COATS[n](s + " ;")
        assert any(x[0] == "assign" for x in secrets.find(s)[1]), names


def test_endless_nesting_ends():
    # a text that percent escapes leave as it is, layer by layer, and one that meets itself again
    assert secrets.find("%25" * 500 + "41")[2] == 0
    s = SECRET
    for _ in range(12):
        s = base64.b64encode(s.encode()).decode()
    assert any(x[0] == "assign" for x in secrets.find(s + " " + s)[1])


def test_bombs_stay_closed_and_are_counted():
    bomb = base64.b64encode(gzip.compress(b"a" * 3_000_000 + b" " + SECRET.encode())).decode()
    assert secrets.find(bomb, most=1_000_000)[1:] == ([], 1)
    assert [s[0] for s in secrets.find(bomb)[1]] == ["assign", "hex"] and secrets.find(bomb)[2] == 0


def test_archives_end_to_end():
    two = base64.b64encode(gzip.compress(b"first ") + gzip.compress(SECRET.encode())).decode()
    assert [s[0] for s in secrets.find(two)[1]] == ["assign"]
