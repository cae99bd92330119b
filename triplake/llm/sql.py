"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

# One edit apart is tested as: equal lengths with one place that differs, or
# lengths that differ by one and a place whose removal makes the lines equal.
OP9_LINES = r"""
WITH split AS (
  SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
every AS (
  SELECT doc_id, unnest(range(len(parts))) AS pos, unnest(parts) AS raw FROM split),
trimmed AS (
  SELECT doc_id, pos, raw,
    trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line FROM every),
firsts AS (
  SELECT line, length(line) AS n, min({'d': doc_id, 'a': pos}) AS first
  FROM trimmed WHERE line <> '' GROUP BY line),
halves AS (
  SELECT *, left(line, n // 2) AS head, right(line, n // 2) AS tail,
    left(line, (n - 1) // 2) AS head1, right(line, (n - 1) // 2) AS tail1
  FROM firsts WHERE n >= 20),
same AS (
  SELECT a.line AS x, b.line AS y, a.first AS fx, b.first AS fy FROM halves a
  JOIN halves b ON a.n = b.n AND a.head = b.head AND a.first > b.first
  UNION
  SELECT a.line, b.line, a.first, b.first FROM halves a
  JOIN halves b ON a.n = b.n AND a.tail = b.tail AND a.first > b.first),
longer AS (
  SELECT a.line AS x, b.line AS y, a.first AS fx, b.first AS fy, a.n FROM halves a
  JOIN halves b ON b.n = a.n + 1 AND a.head = b.head1
  UNION
  SELECT a.line, b.line, a.first, b.first, a.n FROM halves a
  JOIN halves b ON b.n = a.n + 1 AND a.tail = b.tail1),
near AS (
  SELECT x AS line FROM same WHERE len(list_filter(
    list_zip(string_split(x, ''), string_split(y, '')), lambda z: z[1] <> z[2])) = 1
  UNION
  SELECT CASE WHEN fx > fy THEN x ELSE y END FROM longer WHERE len(list_filter(
    range(n + 1), lambda i: left(x, i) = left(y, i) AND right(x, n - i) = right(y, n - i))) > 0),
judged AS (
  SELECT t.doc_id, t.pos, t.raw,
    t.line <> '' AND {'d': t.doc_id, 'a': t.pos} <> f.first AS again,
    t.line <> '' AND {'d': t.doc_id, 'a': t.pos} = f.first AND t.line IN (SELECT line FROM near)
      AS near
  FROM trimmed t LEFT JOIN firsts f ON t.line = f.line)
SELECT d.doc_id,
  CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(string_agg(j.raw, chr(10) ORDER BY j.pos)
    FILTER (WHERE NOT coalesce(j.again, false) AND NOT coalesce(j.near, false)), '') END AS text,
  count_if(coalesce(j.again, false))::BIGINT AS n_exact,
  count_if(coalesce(j.near, false))::BIGINT AS n_near
FROM documents d LEFT JOIN judged j ON d.doc_id = j.doc_id
GROUP BY d.doc_id, d.text
"""

OP11_DECONTAMINATE = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
items AS (
  SELECT item_id, w, least(len(w), 10) AS span FROM item_words WHERE len(w) > 0),
places AS (
  SELECT item_id, w, span, unnest(range(len(w) - span + 1)) AS i FROM items),
windows AS (
  SELECT DISTINCT item_id, span, array_to_string(w[i + 1 : i + span], ' ') AS win FROM places),
spans AS (SELECT DISTINCT span FROM items),
tried AS (
  SELECT doc_id, w, span, unnest(range(len(w) - span + 1)) AS i
  FROM doc_words, spans WHERE len(w) >= span),
found AS (
  SELECT t.doc_id, t.i, t.span, x.item_id FROM (
    SELECT doc_id, i, span, array_to_string(w[i + 1 : i + span], ' ') AS win FROM tried) t
  JOIN windows x ON t.span = x.span AND t.win = x.win),
hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (
    SELECT doc_id, unnest(range(i, i + span)) AS place FROM found) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (
    SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL)
  GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(d.w), 0)::BIGINT AS n_words,
  coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(l.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(l.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit h ON d.doc_id = h.doc_id LEFT JOIN listed l ON d.doc_id = l.doc_id
"""

OP12_NEGATIVES = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS alike,
    list_sum(list_transform(list_zip(a.x, r.x), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM usable a JOIN usable r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
ranked AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS place
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.alike
    AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, place::INTEGER AS "rank", negative_id, positive_score, negative_score
FROM ranked WHERE place <= 10
"""

# Five hexadecimal digits of the SHA-1 are four signs of base 32.
OP5_WARC = """
WITH payloads AS (
  SELECT page_id, url, coalesce(html, '') AS payload FROM pages),
firsts AS (SELECT payload, min(page_id) AS first FROM payloads GROUP BY payload),
hashed AS (
  SELECT p.page_id, p.url, strlen(p.payload) AS payload_bytes, sha1(p.payload) AS digest, f.first
  FROM payloads p JOIN firsts f ON p.payload = f.payload),
groups AS (
  SELECT *, list_transform(range(8),
    lambda g: CAST('0x' || substr(digest, 5 * g + 1, 5) AS BIGINT)) AS numbers FROM hashed)
SELECT page_id, url, payload_bytes::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((numbers[i // 4 + 1] // [32768, 1024, 32, 1][i % 4 + 1]) % 32 + 1)::BIGINT, 1)), '')
    AS payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to
FROM groups
"""

OP10_JACCARD = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (
  SELECT doc_id, w, least(len(w), 3) AS k, unnest(range(len(w) - least(len(w), 3) + 1)) AS i
  FROM words WHERE len(w) > 0),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + k], ' ') || ' ' || k AS shingle FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM shingles a
  JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM pairs JOIN sizes s ON x = s.doc_id JOIN sizes t ON y = t.doc_id
  WHERE 100 * common >= 90 * (s.n + t.n - common)),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reached AS (
  SELECT x, y FROM edges UNION SELECT r.x, e.y FROM reached r JOIN edges e ON r.y = e.x)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles,
  least(d.doc_id, coalesce(r.low, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id
LEFT JOIN (SELECT x, min(y) AS low FROM reached GROUP BY x) r ON d.doc_id = r.x
"""

ORACLE: dict[str, str] = {
    "op5_warc": OP5_WARC,
    "op10_jaccard": OP10_JACCARD,
    "op9_lines": OP9_LINES,
    "op11_decontaminate": OP11_DECONTAMINATE,
    "op12_negatives": OP12_NEGATIVES,
}
