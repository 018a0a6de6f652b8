"""DuckDB SQL for the text operators that SQL can express."""

from .sharding import SEED


def _crc_step(c: str) -> str:
    return f"xor({c} >> 1, (({c}) & 1) * 3988292384)"


def _crc_entry() -> str:
    """One entry of the byte table of CRC-32 (polynomial 0xEDB88320) for byte i."""
    rows = "SELECT i, i AS c FROM range(256) t(i)"
    for _ in range(8):
        rows = f"SELECT i, {_crc_step('c')} AS c FROM ({rows})"
    return f"SELECT list(c ORDER BY i) AS tab FROM ({rows})"


SHARDING = f"""
WITH crc AS ({_crc_entry()}),
bytes AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS b
  FROM documents),
summed AS (
  SELECT doc_id, source, octet_length(encode(text))::BIGINT + 1 AS size,
         CASE WHEN len(b) = 0 THEN 0 ELSE
           xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) END AS text_crc32
  FROM bytes, crc),
base AS (SELECT *, md5(concat_ws(':', '{SEED}', coalesce(doc_id::VARCHAR, ''), text_crc32::BIGINT, size)) AS digest FROM summed),
ranked AS (
  SELECT *, (2 * row_number() OVER (PARTITION BY source ORDER BY digest, doc_id, text_crc32, size) - 1)::DOUBLE
            / (2 * count(*) OVER (PARTITION BY source))::DOUBLE AS fraction
  FROM base),
placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, source NULLS FIRST) - 1 AS pos, count(*) OVER () AS total FROM ranked)
SELECT doc_id, size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, ((pos * 16) // total)::INT AS shard,
       (pos - ((((pos * 16) // total) * total + 15) // 16))::BIGINT AS slot, NULL::INT AS grown_shard, source
FROM placed
"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Groups of near copies from all pairs that share a shingle; equal sets are one node.
NEAR_DUP = rf"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[\x09-\x0D ]+'), lambda w: w <> '') AS ws
  FROM documents),
sets AS (
  SELECT row_id, doc_id, list_sort(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END) AS items
  FROM words),
nodes AS (SELECT min(row_id) AS node, items, len(items) AS n FROM sets WHERE len(items) > 0 GROUP BY items),
member AS (SELECT node, n, unnest(items) AS item FROM nodes),
pairs AS (SELECT a.node AS x, b.node AS y, a.n AS nx, b.n AS ny, count(*) AS shared FROM member a JOIN member b ON a.item = b.item AND a.node < b.node GROUP BY ALL),
links AS (SELECT x, y FROM pairs WHERE 100 * shared >= 85 * (nx + ny - shared)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT node, node AS other FROM nodes UNION SELECT r.node, e.y FROM reach r JOIN edges e ON e.x = r.other),
rows_of AS (SELECT s.row_id, s.doc_id, s.items, n.node FROM sets s LEFT JOIN nodes n ON n.items = s.items),
least AS (SELECT r.node, min(o.doc_id) AS component_id FROM reach r JOIN rows_of o ON o.node = r.other GROUP BY r.node)
SELECT doc_id, len(items)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id, doc_id IS NOT DISTINCT FROM coalesce(component_id, doc_id) AS kept
FROM rows_of LEFT JOIN least USING (node)
"""

_LOWER = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"

#: Shares over every pair of a group and a kept term of its language.
DIVERGENCE = rf"""
WITH docs AS (SELECT row_number() OVER () AS row_id, {_LOWER} AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
words AS (SELECT row_id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT row_id) >= 30),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
vocabulary AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
sums AS (SELECT lang, source, sum(c) AS n FROM counts GROUP BY ALL),
whole AS (SELECT lang, term, sum(c) AS c, sum(sum(c)) OVER (PARTITION BY lang) AS n FROM counts GROUP BY lang, term),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c,
         1 + (1000000000::HUGEINT * (coalesce(c, 0) + 5)) // (coalesce(s.n, 0) + 5 * v)::HUGEINT AS p,
         1 + (1000000000::HUGEINT * (w_c + 5)) // (w_n + 5 * v)::HUGEINT AS q
  FROM groups g JOIN kept k USING (lang) JOIN vocabulary USING (lang)
    JOIN (SELECT lang, term, c AS w_c, n AS w_n FROM whole) USING (lang, term)
    LEFT JOIN counts USING (lang, source, term) LEFT JOIN sums s USING (lang, source)),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS f
               FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) d
    ON d.lang = a.lang AND d.source = a.source AND d.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM shares WHERE c > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

COLLOCATIONS = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces),
places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM words),
grams AS (SELECT lang, size, array_to_string(ws[i:i + size - 1], ' ') AS phrase FROM places, range(1, 6) t(size) WHERE i + size - 1 <= len(ws)),
counted AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(ws)) AS n FROM words GROUP BY lang),
cuts AS (
  SELECT lang, size, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[:k], ' ') AS head, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rest
  FROM counted, range(1, 5) t(k) WHERE k < size),
scored AS (
  SELECT c.lang, c.size, c.phrase, a, k, x.f AS l, y.f AS r, n, (1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = c.head JOIN counted y ON y.lang = c.lang AND y.phrase = c.rest JOIN totals t ON t.lang = c.lang),
least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
alone AS (
  SELECT * FROM least s WHERE NOT EXISTS (
    SELECT 1 FROM counted b WHERE b.lang = s.lang AND b.size > s.size AND b.f >= s.a AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ')))
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM alone) WHERE rank <= 2000
"""

#: Every window by its words, with the least document that holds it.
REPEATS = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x09-\x0D ]+'), lambda w: w <> '') AS ws FROM documents),
windows AS (
  SELECT row_id, doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS w
  FROM (SELECT row_id, doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM docs WHERE len(ws) >= 50)),
hit AS (SELECT row_id, i, doc_id > min(doc_id) OVER (PARTITION BY w) AS again FROM windows),
gone AS (SELECT DISTINCT row_id, i + unnest(range(50)) AS i FROM hit WHERE again),
words AS (SELECT row_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM docs),
kept AS (
  SELECT row_id, count(*) AS n_words, count(gone.i) AS n_removed, string_agg(word, ' ' ORDER BY words.i) FILTER (WHERE gone.i IS NULL) AS kept
  FROM words LEFT JOIN gone USING (row_id, i) GROUP BY row_id)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (row_id)
"""
