"""DuckDB SQL for the queries that SQL can express, on the same tables.

The others (tokenizer, HTML, link components, span offsets, EM) are held
against brute-force versions in tests/llm.
"""

from __future__ import annotations

from .common import LOWER, UPPER

_FOLD = f"translate({{}}, '{UPPER}', '{LOWER}')"
_DOCS = "SELECT row_number() OVER () AS rid, doc_id, text, source FROM documents"

_REVISITS = r"""
WITH p AS (
  SELECT coalesce(page_id, 0) AS n, trim(url) AS url, sha256(coalesce(html, '')) AS d, coalesce(strlen(html), 0) AS size FROM pages),
c AS (
  SELECT *, regexp_replace(url, '#.*$', '') AS rest FROM p),
q AS (
  SELECT *, list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'),
      lambda x: x <> '' AND NOT regexp_full_match(x, '(?i)(utm_[a-z]+|ref|gclid|fbclid|sessionid)=[^&]*'))) AS asked
  FROM c),
u AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)), '^www\.', ''), ':(80|443)$', '')
    || regexp_replace(regexp_extract(rest, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1), '/+$', '')
    || CASE WHEN len(asked) > 0 THEN '?' || array_to_string(asked, '&') ELSE '' END AS canonical_url,
    'Last-Modified: day ' || (n % 97) AS modified, '"' || d[1:16] || '"' AS tag
  FROM q),
r AS (
  SELECT 'r' || n AS record_id, canonical_url, make_timestamp((1700000000 + n * 37) * 1000000) AS captured, d, size, modified, tag,
    ['ETag: ' || tag, modified, 'Content-Length: ' || size, 'Content-Type: text/html', 'Cache-Control: max-age=60'] AS headers
  FROM u),
v AS (
  SELECT 'v' || n AS record_id, canonical_url, make_timestamp((1700000000 + n * 37 + 604800) * 1000000) AS captured, modified, n % 4 AS turn,
    CASE n % 4 WHEN 0 THEN 'ETag: ' || tag WHEN 2 THEN 'etag: W/' || tag WHEN 3 THEN 'ETag: "changed"' END AS etag,
    CASE n % 4 WHEN 1 THEN NULL WHEN 3 THEN '"changed"' ELSE tag END AS own_tag
  FROM u),
best AS (
  SELECT v.record_id, max({'t': r.captured, 'id': r.record_id}) AS b FROM v JOIN r ON r.canonical_url = v.canonical_url AND r.captured < v.captured GROUP BY v.record_id),
found AS (
  SELECT v.*, r.record_id AS rid, r.d, r.tag AS their_tag, r.modified AS their_modified, r.size,
    CASE WHEN r.record_id IS NULL THEN 'missing' WHEN own_tag IS NOT NULL AND own_tag <> r.tag THEN 'mismatch'
         WHEN own_tag IS NULL AND v.modified <> r.modified THEN 'mismatch' ELSE 'resolved' END AS resolution
  FROM v LEFT JOIN best USING (record_id) LEFT JOIN r ON r.record_id = best.b.id)
SELECT record_id, canonical_url, captured, 'full' AS resolution, record_id AS source_id, d AS body_digest,
  array_to_string(list_sort(headers), chr(10)) AS headers FROM r
UNION ALL
SELECT record_id, canonical_url, captured, resolution, CASE WHEN resolution = 'resolved' THEN rid END, CASE WHEN resolution = 'resolved' THEN d END,
  array_to_string(list_sort(CASE WHEN resolution = 'resolved'
    THEN [coalesce(etag, 'ETag: ' || their_tag), modified, 'Content-Length: ' || size, 'Content-Type: text/html', 'Cache-Control: max-age=3600']
    ELSE list_filter([etag, modified, 'Content-Length: 0', 'Cache-Control: max-age=3600', 'Connection: close, X-Trace', 'X-Trace: 1'], lambda x: x IS NOT NULL) END), chr(10))
FROM found
"""

_LINES = f"""
WITH d AS ({_DOCS}),
l AS (
  SELECT rid, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM d),
k AS (SELECT *, {_FOLD.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM l),
s AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, s.key IS NOT NULL AND (doc_id IS NULL OR doc_id <> keeper) AS gone FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id
"""

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WINDOWS = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '{_WORD}') AS w FROM benchmark),
bi AS (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
bg AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM bi),
di AS (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bg) WHERE len(w) >= n),
h AS (SELECT rid, i, n, item FROM (SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM di) JOIN bg USING (n, g)),
hw AS (SELECT rid, count(DISTINCT x) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS x FROM h) GROUP BY rid),
hi AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hw USING (rid) LEFT JOIN hi USING (rid)
"""


def _crc_table() -> str:
    """Remainder v8 of each byte b."""
    table = "SELECT x AS b, x AS v0 FROM (SELECT unnest(range(256)) AS x)"
    for n in range(8):
        table = f"SELECT b, CASE WHEN v{n} % 2 = 1 THEN xor(v{n} // 2, 3988292384) ELSE v{n} // 2 END AS v{n + 1} FROM ({table})"
    return table


def _shards(k: int = 8) -> str:
    """The capacity by dynamic programming over group prefixes, then greedy cuts; CRC-32 byte by byte."""
    best = ["f1 AS (SELECT i, p AS v FROM t)"]
    for n in range(2, k + 1):
        best.append(f"f{n} AS (SELECT t.i, min(greatest(f{n - 1}.v, t.p - u.p)) AS v FROM t JOIN t u ON u.i <= t.i JOIN f{n - 1} ON f{n - 1}.i = u.i GROUP BY t.i)")
    cuts = ["c0 AS (SELECT 0 AS p)"]
    for n in range(1, k):
        cuts.append(f"c{n} AS (SELECT max(t.p) AS p FROM t, c{n - 1}, cap WHERE t.p <= c{n - 1}.p + cap.v)")
    number = " + ".join(f"CAST(g.p > (SELECT p FROM c{n}) AS INTEGER)" for n in range(1, k))
    table = _crc_table()
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(strlen(text), 0) + 1 AS size, coalesce(sha256(text), '') AS key, hex(encode(coalesce(text, ''))) AS h FROM documents),
tab AS (SELECT list(v8 ORDER BY b) AS t FROM ({table})),
crc AS (
  SELECT rid, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(len(h) // 2), lambda i: CAST('0x' || h[2 * i + 1:2 * i + 2] AS BIGINT))),
    lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), CAST(4294967295 AS BIGINT)) AS crc FROM d, tab),
s AS (SELECT key, sum(size) AS s FROM d GROUP BY key),
g AS (SELECT key, CAST(sum(s) OVER (ORDER BY key) AS BIGINT) AS p, row_number() OVER (ORDER BY key) AS i FROM s),
t AS (SELECT i, p FROM g UNION ALL SELECT 0, 0),
{", ".join(best)},
cap AS (SELECT v FROM f{k} ORDER BY i DESC LIMIT 1),
{", ".join(cuts)},
o AS (SELECT d.*, {number} AS shard FROM d JOIN g USING (key))
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 3), key, doc_id NULLS FIRST) - 1 AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM o JOIN crc USING (rid)
"""


_SIZE = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"
_MIX = f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, source, CAST({_SIZE} AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'text ' || coalesce(text, ''))), 1, 15) AS BIGINT) AS place FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s0),
s2 AS (SELECT *, CAST(rank % 3 + 1 AS DOUBLE) AS w, CAST(3 * source_size AS DOUBLE) AS cap FROM s1),
s3 AS (
  SELECT *, cap / w AS ratio, (SELECT CAST(sum(source_size) AS DOUBLE) FROM s2) - coalesce(sum(cap) OVER (ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
    sum(w) OVER (ORDER BY cap / w, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM s2),
f AS (SELECT ratio AS fr, rank AS fk, left_over AS fl, rest AS fs FROM s3 WHERE left_over / rest <= ratio ORDER BY ratio, rank LIMIT 1),
s4 AS (SELECT source, source_size, rank, CASE WHEN fr IS NOT NULL AND (ratio, rank) >= (fr, fk) THEN least(w * fl / fs, cap) ELSE cap END AS target FROM s3 LEFT JOIN f ON true),
o AS (
  SELECT d.*, s4.source_size, s4.rank, s4.target, CAST(round(target) AS BIGINT) AS goal,
    coalesce(CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY place, doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS before
  FROM d JOIN s4 ON d.source IS NOT DISTINCT FROM s4.source),
e AS (
  SELECT *, greatest(least(goal - before, size), 0) AS t0, greatest(least(goal - before - source_size, size), 0) AS t1, greatest(least(goal - before - 2 * source_size, size), 0) AS t2 FROM o),
x AS (
  SELECT *, CAST(t0 * 2 >= size AND t0 > 0 OR size = 0 AS INTEGER) AS w0, CAST(t1 * 2 >= size AND t1 > 0 AS INTEGER) AS w1, CAST(t2 * 2 >= size AND t2 > 0 AS INTEGER) AS w2,
    least(greatest(before / greatest(target, 1e-300), 0.0), 1.0) AS y FROM e),
c AS (
  SELECT rid, doc_id, size, rank, least(greatest((before + k * source_size) / greatest(target, 1e-300), 0.0), 1.0) AS y
  FROM x, (SELECT unnest([0, 1, 2]) AS k) WHERE CASE k WHEN 0 THEN w0 WHEN 1 THEN w1 ELSE w2 END = 1),
t AS (
  SELECT rid, doc_id, size, least(CASE rank % 3
    WHEN 0 THEN 2 * y / (1.5 + sqrt(greatest(2.25 - 2 * y, 0.0)))
    WHEN 1 THEN y
    ELSE CASE WHEN y < 0.375 THEN 2 * y / (0.5 + sqrt(0.25 + 2 * y)) ELSE 0.5 + 2 * (y - 0.375) / (1 + sqrt(1 + 2 * (y - 0.375))) END END, 1.0) AS t FROM c),
p AS (SELECT rid, string_agg(CAST(p AS VARCHAR), ',' ORDER BY p) AS positions FROM (SELECT rid, row_number() OVER (ORDER BY t, doc_id, size) - 1 AS p FROM t) GROUP BY rid)
SELECT doc_id, size, source_size, target, CAST(t0 + t1 + t2 AS BIGINT) AS taken, CAST(w0 + w1 + w2 AS BIGINT) AS copies,
  CASE WHEN w0 = 1 THEN round(CASE rank % 3
    WHEN 0 THEN 2 * y / (1.5 + sqrt(greatest(2.25 - 2 * y, 0.0)))
    WHEN 1 THEN y
    ELSE 2 * y / (0.5 + sqrt(0.25 + 2 * y)) END, 6) END AS first_time,
  coalesce(positions, '') AS positions
FROM x LEFT JOIN p USING (rid)
"""

_PHRASES = rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_FOLD.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, k, g, count(*) AS f FROM g GROUP BY ALL),
t AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, g, f AS a, string_split(g, ' ') AS w FROM f WHERE k > 1 AND f >= 100),
held AS (
  SELECT DISTINCT s.lang, s.g FROM c s JOIN c x ON x.lang = s.lang AND x.k > s.k AND contains(' ' || x.g || ' ', ' ' || s.g || ' ') AND 100 * x.a >= 100 * s.a),
cut AS (
  SELECT lang, g, a, j, array_to_string(w[1:j], ' ') AS x, array_to_string(w[j + 1:], ' ') AS y
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c ANTI JOIN held USING (lang, g))),
s AS (
  SELECT cut.*, l.f AS l, r.f AS r, t.n, (1000::HUGEINT * a * t.n) // (l.f::HUGEINT * r.f) AS score
  FROM cut JOIN f l ON l.lang = cut.lang AND l.g = x JOIN f r ON r.lang = cut.lang AND r.g = y JOIN t ON t.lang = cut.lang
  QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.g ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank, g AS phrase,
  CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM s QUALIFY rank <= 2000
"""


def _field(name: str) -> str:
    text = f"CAST({name} AS VARCHAR)"
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


def _manifest() -> str:
    """Trees by recursion over levels, then each document's path by recursion over its siblings."""
    leaf, head = " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", "text"))), " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))
    up = """
  SELECT tree, 0 AS level, place, n, hash FROM {0}
  UNION ALL
  SELECT tree, level + 1, place // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY place)) FROM {1} WHERE n > 1 GROUP BY tree, level, place // 3, n"""
    beside = """
  SELECT tree, level, place, n,
    coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {0} WINDOW w AS (PARTITION BY tree, level, place // 3 ORDER BY place)"""
    climb = """
  SELECT rid, {2} AS tree, 0 AS level, {3} AS place, node, seen FROM {4}
  UNION ALL
  SELECT rid, f.tree, f.level + 1, f.place // 3, sha256(l || node || r), seen || l || r
  FROM {0} f JOIN {1} s ON s.tree = f.tree AND s.level = f.level AND s.place = f.place WHERE s.n > 1"""
    return f"""
WITH RECURSIVE tab AS (SELECT list(v8 ORDER BY b) AS t FROM ({_crc_table()})),
d AS (
  SELECT row_number() OVER () AS rid, *, coalesce('=' || source, '') AS tree, sha256({leaf}) AS hash,
    hex(encode(coalesce(CAST(doc_id AS VARCHAR), ''))) AS h FROM documents),
c AS (
  SELECT d.*, doc_id IS NOT NULL AND xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(len(h) // 2), lambda i: CAST('0x' || h[2 * i + 1:2 * i + 2] AS BIGINT))),
    lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), CAST(4294967295 AS BIGINT)) % 2 = 0 AS struck FROM d, tab),
leaves AS (
  SELECT rid, doc_id, tree, hash, CASE WHEN struck AND text IS NOT NULL THEN sha256({head} || strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), '')) ELSE hash END AS suspect,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, hash) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n FROM c),
nodes AS ({up.format("leaves", "nodes")}),
tops AS (SELECT '' AS tree, tree AS source, hash, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM nodes WHERE n = 1),
summit AS ({up.format("tops", "summit")}),
beside AS ({beside.format("nodes")}),
summit_beside AS ({beside.format("summit")}),
starts AS (SELECT rid, tree, place, suspect AS node, '' AS seen FROM leaves),
paths AS ({climb.format("paths", "beside", "tree", "place", "starts")}),
ends AS (
  SELECT rid, t.place, node, seen, t.hash AS subroot FROM paths p JOIN tops t ON t.source = p.tree
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY level DESC) = 1),
summit_paths AS ({climb.format("summit_paths", "summit_beside", "''", "place", "ends")}),
folded AS (SELECT rid, node, seen FROM summit_paths QUALIFY row_number() OVER (PARTITION BY rid ORDER BY level DESC) = 1),
top AS (SELECT hash AS root FROM summit WHERE n = 1)
SELECT doc_id, hash AS leaf, subroot, root, sha256(f.seen) AS proof_sha256, f.node AS folded_root, f.node = root AS verified
FROM leaves JOIN ends USING (rid) JOIN folded f USING (rid), top
"""


ORACLE_SQL: dict[str, str] = {
    "op1_revisits": _REVISITS,
    "op4_line_dedup": _LINES,
    "op5_minimax_shards": _shards(),
    "op6_winnowing": _WINDOWS,
    "op9_curriculum_mix": _MIX,
    "op11_collocations": _PHRASES,
    "op13_merkle_manifest": _manifest(),
}
