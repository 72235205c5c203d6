"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

MIXING_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place
  FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), weighed AS (
  SELECT source, source_size, CAST(3 * source_size AS DOUBLE) AS cap,
         CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3] AS DOUBLE) AS weight,
         row_number() OVER (ORDER BY source ASC NULLS LAST) AS nr
  FROM per
), levels AS (
  SELECT *,
         (sum(source_size) OVER () - coalesce(sum(cap) OVER f, 0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER f, 0)) AS level
  FROM weighed
  WINDOW f AS (ORDER BY cap / weight, nr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size,
         CASE WHEN level * weight >= cap THEN cap
              ELSE max(CASE WHEN level * weight < cap THEN level END) OVER () * weight END AS target
  FROM levels
), queued AS (
  SELECT d.*, t.source_size, t.target, row_number() OVER () AS rid,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), copies AS (
  SELECT rid, size, epoch, coalesce('s' || source, 'n') AS source_key, place, doc_id,
         CAST(epoch * source_size + before + size AS DOUBLE) / target AS finish
  FROM queued, (SELECT unnest([0, 1, 2]) AS epoch)
  WHERE size > 0 AND target > 0
), placed AS (
  SELECT rid, size,
         coalesce(sum(size) OVER (ORDER BY finish, source_key, epoch, place, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS mixed_before
  FROM copies
), taken AS (
  SELECT rid, sum(size) AS taken FROM placed
  WHERE mixed_before < (SELECT sum(size) FROM d) GROUP BY rid
)
SELECT q.doc_id, q.size, q.source_size, q.target, CAST(coalesce(t.taken, 0) AS BIGINT) AS taken
FROM queued q LEFT JOIN taken t USING (rid)
"""

NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+'), []) AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) > 1
           THEN list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) ELSE ws END) AS gram
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT c.a, c.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
    FROM s x JOIN s y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY 1, 2) c
  JOIN n na ON na.doc_id = c.a JOIN n nb ON nb.doc_id = c.b
  WHERE 100 * common >= 80 * (na.n + nb.n - common)
), sides AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT a AS doc_id, b AS other FROM sides
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN sides l ON r.other = l.a
), least AS (
  SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id
)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       least(w.doc_id, coalesce(l.other, w.doc_id)) AS component_id,
       w.doc_id = least(w.doc_id, coalesce(l.other, w.doc_id)) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least l USING (doc_id)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical_sql(column: str) -> str:
    from lotcast.llm.licenses import LOWER, RULES, UPPER
    out = f"translate({column}, '{UPPER}', '{LOWER}')"
    for pattern, replacement in RULES:
        new = "chr(10)" if replacement == r"\n" else _quoted(replacement)
        out = f"regexp_replace({out}, {_quoted(pattern)}, {new}, 'g')"
    return out


def license_sql() -> str:
    from lotcast.llm.license_texts import KNOWN
    values = ",\n  ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in KNOWN)
    return f"""
WITH known AS (
  SELECT DISTINCT license, sha256(trim(regexp_replace({_canonical_sql('text')}, '[ \\n]+', ' ', 'g'))) AS digest
  FROM (VALUES {values}) k(license, text)
), d AS (
  SELECT doc_id, row_number() OVER () AS rid, {_canonical_sql('text')} AS form FROM documents
), forms AS (
  SELECT doc_id, rid, sha256(trim(regexp_replace(form, '[ \\n]+', ' ', 'g'))) AS digest FROM d
), lines AS (
  SELECT rid, nr, line FROM (
    SELECT rid, unnest(string_split(form, chr(10))) AS line, unnest(range(len(string_split(form, chr(10))))) AS nr FROM d)
), hits AS (
  SELECT l.rid, l.nr, k.license FROM lines l JOIN known k ON sha256(trim(l.line)) = k.digest
), names AS (
  SELECT rid, license FROM hits
  UNION SELECT f.rid, k.license FROM forms f JOIN known k ON f.digest = k.digest
)
SELECT f.doc_id, f.digest, k.license,
       (SELECT count(*) FROM hits h WHERE h.rid = f.rid) AS n_notices,
       (SELECT string_agg(license, ',' ORDER BY license) FROM names n WHERE n.rid = f.rid) AS licenses
FROM forms f LEFT JOIN known k ON f.digest = k.digest
"""


QUOTES_SQL = r"""
WITH RECURSIVE said AS (
  SELECT conv_id, turn, role, text,
         md5(concat_ws(chr(0), '=' || coalesce('c' || conv_id, 'n'), coalesce('=' || turn, '-'),
                       coalesce('=' || role, '-'), coalesce('=' || text, '-'))) AS message,
         coalesce('c' || conv_id, 'n') AS conv
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)
), raw AS (
  SELECT message, conv, turn, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS nr
  FROM said
), lines AS (
  SELECT *, len(regexp_replace(regexp_extract(line, '^[ \t>]*>', 0), '[^>]', '', 'g')) AS level,
         regexp_replace(line, '^[ \t>]*>', '') AS body
  FROM raw
), clean AS (
  SELECT message, regexp_replace(coalesce(string_agg(body, chr(10) ORDER BY nr) FILTER (level = 0), ''),
                                 '^[ \t\r\n]+|[ \t\r\n]+$', '', 'g') AS text
  FROM lines GROUP BY message
), normal AS (
  SELECT *, nr - row_number() OVER (PARTITION BY message, level ORDER BY nr) AS island,
         trim(regexp_replace(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[ \t\r]+', ' ', 'g')) AS said
  FROM lines
), passages AS (
  SELECT message, conv, turn, level, island, 0 AS kind, string_agg(said, ' ' ORDER BY nr) AS said
  FROM normal WHERE said <> '' GROUP BY ALL
  UNION ALL
  SELECT message, conv, turn, level, island, 1, said FROM normal WHERE said <> ''
), originals AS (
  SELECT conv, said, min(turn) AS original FROM passages WHERE level = 0 AND turn IS NOT NULL GROUP BY ALL
), found AS (
  SELECT p.*, o.original FROM passages p JOIN originals o USING (conv, said)
  WHERE p.level > 0 AND o.original < coalesce(p.turn, 9223372036854775807)
), counted AS (
  SELECT message, count(*) AS n_quotes FROM passages WHERE level > 0 AND kind = 0 GROUP BY message
), linked AS (
  SELECT message, conv, turn, count(DISTINCT (level, island)) AS n_linked,
         arg_min(original, (level, kind, -original)) AS reply_to
  FROM found GROUP BY ALL
), parents AS (
  SELECT conv, turn, min(reply_to) AS parent FROM linked WHERE turn IS NOT NULL GROUP BY ALL
), climb AS (
  SELECT conv, turn, parent AS root FROM parents
  UNION
  SELECT c.conv, c.turn, p.parent FROM climb c JOIN parents p ON c.conv = p.conv AND c.root = p.turn
), roots AS (
  SELECT conv, turn, min(root) AS root FROM climb GROUP BY ALL
), placed AS (
  SELECT s.*, c.text AS clean, q.n_quotes, l.n_linked, l.reply_to,
         CASE WHEN l.reply_to IS NOT NULL THEN coalesce(r.root, l.reply_to) ELSE s.turn END AS thread
  FROM said s JOIN clean c USING (message) LEFT JOIN counted q USING (message)
  LEFT JOIN linked l USING (message) LEFT JOIN roots r ON r.conv = s.conv AND r.turn = s.turn
)
SELECT conv_id, turn, role, clean AS text,
       CAST(row_number() OVER (PARTITION BY conv ORDER BY coalesce(thread, 9223372036854775807),
            coalesce(turn, 9223372036854775807), role NULLS FIRST, message) - 1 AS BIGINT) AS position,
       thread, reply_to, CAST(coalesce(n_quotes, 0) AS BIGINT) AS n_quotes,
       CAST(coalesce(n_linked, 0) AS BIGINT) AS n_linked
FROM placed
"""

_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"coalesce(regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

CONTAMINATION_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS ws FROM documents
), i AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, ws, least(len(ws), 10) AS width
  FROM (SELECT item_id, {_TERMS} AS ws FROM benchmark) WHERE len(ws) > 0
), strings AS (
  SELECT DISTINCT item_id, width, array_to_string(list_slice(ws, pos, pos + width - 1), ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(ws) - width + 2)) AS pos FROM i)
), places AS (
  SELECT rid, width, pos, array_to_string(list_slice(ws, pos, pos + width - 1), ' ') AS gram
  FROM (SELECT rid, ws, width, unnest(range(1, len(ws) - width + 2)) AS pos
        FROM d, (SELECT DISTINCT width FROM strings) WHERE len(ws) >= width)
), found AS (
  SELECT p.rid, p.pos, p.width, s.item_id FROM places p JOIN strings s ON p.width = s.width AND p.gram = s.gram
), hit AS (
  SELECT rid, count(DISTINCT pos) AS n_hit
  FROM (SELECT rid, unnest(range(pos, pos + width)) AS pos FROM found) GROUP BY rid
), named AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT rid, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY rid
)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(n.items, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit h USING (rid) LEFT JOIN named n USING (rid)
"""

SEARCH_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS ws FROM documents
), sized AS (
  SELECT rid, doc_id, CAST(len(ws) AS BIGINT) AS n FROM d WHERE len(ws) > 0
), totals AS (
  SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sized
), counts AS (
  SELECT rid, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT rid, unnest(ws) AS term FROM d) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM counts, totals GROUP BY term, n_docs
), i AS (
  SELECT item_id, nr, term, count(*) AS times
  FROM (SELECT item_id, nr, unnest(ws) AS term
        FROM (SELECT item_id, text, row_number() OVER () AS nr, {_TERMS} AS ws
              FROM (SELECT DISTINCT item_id, text FROM benchmark))) GROUP BY ALL
), scored AS (
  SELECT i.item_id, i.nr, s.rid, s.doc_id,
         CAST(sum(i.times * w.w * ((1000000000 * c.tf) // (1000 * c.tf + 12 * (100 - 25 + (25 * s.n * t.n_docs) // t.n_terms))))
              AS BIGINT) AS score
  FROM i JOIN counts c USING (term) JOIN weights w USING (term) JOIN sized s ON s.rid = c.rid, totals t
  GROUP BY i.item_id, i.nr, s.rid, s.doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY nr ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""

NEGATIVES_SQL = """
WITH r AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), a AS (
  SELECT * FROM r WHERE vec_id % 100 = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id, r.label,
         CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM a JOIN r ON a.vec_id <> r.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), negatives AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
   AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= 10
"""
