"""Plain single-machine answers to the query contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def line_dedup(docs):
    """doc_id -> (n_lines, n_dropped, kept_sha256)"""
    def key(x):
        return x.strip(" \t\n\x0b\x0c\r").translate(FOLD)

    held = defaultdict(set)
    for d, t in docs:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 20 and d is not None:
                held[key(x)].add(d)
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 20 or len(held[key(x)]) < 3 or max(held[key(x)]) == d]
        out.append((d, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def contamination(docs, items):
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)"""
    windows = defaultdict(set)
    for i, t in items:
        w = tuple(ALNUM.findall((t or "").translate(FOLD)))
        if w:
            n = min(10, len(w))
            for k in range(len(w) - n + 1):
                windows[w[k: k + n]].add("" if i is None else str(i))
    sizes = sorted({len(w) for w in windows})
    out = []
    for d, t in docs:
        w = ALNUM.findall((t or "").translate(FOLD))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k: k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[x]
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def fingerprint(t):
    w = SPACED.findall((t or "").translate(FOLD))
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(w[i: i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(ids, fps, bits=2):
    """Least id reachable over fingerprints at most ``bits`` apart."""
    fp = np.array(fps, np.uint64)
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= bits):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return [least[find(i)] for i in range(len(ids))]


def quality(t):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    t = t or ""
    w = SPACED.findall(t)
    n = Counter(zip(w, w[1:], w[2:]))
    rep = {i + j for i, g in enumerate(zip(w, w[1:], w[2:])) if n[g] > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if SPACED.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep),
            len(w) < 50 or 100 * len(rep) > 50 * len(w))


def quality_votes(t):
    """One vote a rule: -1 bad, 1 good, 0 none."""
    t = t or ""
    w = SPACED.findall(t)
    if not w:
        return [0] * 10
    n_words, chars, symbols, _, repeat, _ = quality(t)
    whole = [x for x in t.split("\n") if SPACED.search(x)]
    lines = [x.strip(" \t\n\x0b\x0c\r") for x in whole]
    upper, lower = len(re.findall("[A-Z]", t)), len(re.findall("[a-z]", t))

    def share(flags):
        return sum(flags) / len(lines) if len(lines) >= 3 else None

    value = [
        (symbols / n_words, 0.05, 0.30),
        (repeat / n_words, 0.20, 0.40),
        (share(x in whole[:i] for i, x in enumerate(whole)), 0.15, 0.40),
        (upper / (upper + lower) if upper + lower >= 20 else None, 0.25, 0.60),
        (sum(x.endswith("!") for x in w) / n_words, 0.08, 0.30),
        (sum(not re.search(r"[0-9A-Za-z]|[^\x00-\x7f]", x) for x in w) / n_words, 0.05, 0.20),
        (max(2 - chars / n_words, chars / n_words - 12, 0), 0.0, 6.0),
        (sum(x[-1] in "#*$%&|<>" for x in w) / n_words, 0.02, 0.10),
        (share(x[-1] not in ".!?:;\"')…。！？”’" for x in lines), 0.05, 0.30),
        (share(len(x.split()) < 5 for x in lines), 0.15, 0.30),
    ]
    return [0 if v is None else -1 if v > bad else 1 if v <= good else 0 for v, good, bad in value]


def em_kept(votes):
    """Whether the posterior of each document's votes says good: EM over documents, one after the other."""
    if not votes:
        return []
    rules = range(len(votes[0]))
    voting = [v for v in votes if any(v)]
    kinds = list(rules)

    def posterior(v, classes):
        p = []
        for share, rates in classes:
            x = share
            for r in rules:
                x *= rates[r] if v[r] == -1 else 1 - rates[r] if v[r] == 1 else 1
            p.append(x)
        return [x / sum(p) for x in p]

    while True:
        first = [[0.9 if r == k else 0.1 for r in rules] for k in kinds]
        prior = [9.0] + [1 / len(kinds) for _ in kinds]
        classes = [(p / sum(prior), rates) for p, rates in zip(prior, [[0.01] * len(rules), *first])]
        for _ in range(300):
            weights = [posterior(v, classes) for v in voting]
            mass = [sum(w[c] for w in weights) + prior[c] for c in range(len(classes))]
            junk = sum(mass[1:])
            if junk > mass[0]:
                mass = mass[:1] + [x * mass[0] / junk for x in mass[1:]]
            after = []
            for c in range(len(classes)):
                rates = []
                for r in rules:
                    said = sum(w[c] for w, v in zip(weights, voting) if v[r] == -1)
                    cast = sum(w[c] for w, v in zip(weights, voting) if v[r])
                    if c == 0:
                        rates.append(min(max((said + 0.5) / (cast + 50), 1e-6), 0.5))
                    else:
                        rates.append(min(max((said + 0.1 * first[c - 1][r]) / (cast + 0.1), after[0][1][r]), 0.999))
                after.append((mass[c] / sum(mass), rates))
            moved = max(abs(x - y) for a, b in zip(after, classes) for x, y in zip(a[1], b[1]))
            classes = after
            if moved < 1e-10:
                break
        borne = [k for k, (_, rates) in zip(kinds, classes[1:]) if any(rates[r] > 0.5 for r in rules if r != k)]
        if borne == kinds:
            return [posterior(v, classes)[0] >= 0.5 for v in votes]
        kinds = borne


def minimax(sizes, k):
    """Smallest capacity for k runs, and the run number of each size."""
    def runs(c):
        out, n, at = [], 0, 0
        for s in sizes:
            if at + s > c:
                n, at = n + 1, 0
            at += s
            out.append(n)
        return out

    lo, hi = max(sizes), sum(sizes)
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if runs(mid)[-1] < k else (mid + 1, hi)
    return lo, runs(lo)


def shards(docs, k=8):
    """(doc_id, text) index -> (size, crc, shard)"""
    size = [len((t or "").encode()) + 1 for _, t in docs]
    key = ["" if t is None else sha(t) for _, t in docs]
    group = Counter()
    for x, s in zip(key, size):
        group[x] += s
    order = sorted(group)
    cap, run = minimax([group[x] for x in order], k)
    of = dict(zip(order, run))
    return cap, [(s, zlib.crc32((t or "").encode()), of[x]) for (_, t), s, x in zip(docs, size, key)]


def targets(sizes, weights=(1, 2, 3), most=3):
    """source -> target, by resharing the excess until none is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = float(sum(sizes.values())), set(names), {}
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if w[s] * level > most * sizes[s]}
        if not over:
            out |= {s: w[s] * level for s in free}
            break
        for s in over:
            out[s] = float(most * sizes[s])
            left -= out[s]
        free -= over
    return out


PII = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
)


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def pii(t):
    """(n_email, n_ip, n_card, n_phone, base list)"""
    counts, spans = [], []
    for kind, rx in PII:
        n = 0
        for m in rx.finditer(t or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                  "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                n += 1
                spans.append(f"{kind}:{m.start()}:{m.end()}")
        counts.append(n)
    return (*counts, ",".join(spans))


def pii_scores(text, kind, chars=40):
    """(start, end, score) of every match of a kind, by slices of the text and a walk along the matches."""
    import regex

    out, last, label = [], 0, False
    for m in regex.finditer(kind.pattern, text or "", flags=regex.ASCII):
        s, e = m.span()
        left, right = text[max(0, s - chars): s], text[e: e + chars]
        if s > chars and regex.match(r"\w", text[s - chars - 1], flags=regex.ASCII):
            left = regex.sub(r"^\w+", "", left, flags=regex.ASCII)
        if e + chars < len(text) and regex.match(r"\w", text[e + chars], flags=regex.ASCII):
            right = regex.sub(r"\w+$", "", right, flags=regex.ASCII)
        gap = text[last:s]
        if len(gap) > chars or regex.search(r"[.!?]\s|\n\s*\n", gap):
            label = False
        label = label or any(regex.search(kind.context, x, flags=regex.ASCII) for x in (left, right))
        out.append((s, e, min(1.0, kind.score + 0.4 * label)))
        last = e
    return out
