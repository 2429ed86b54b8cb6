"""SQL over the given tables for the queries of this subpackage that have it."""

from __future__ import annotations

OP2 = r"""
WITH turns AS (
  SELECT conv_id, turn, role, text, coalesce(length(text), 0) AS n,
    coalesce(regexp_extract(text, '[A-Za-z]+', 0), '') AS word
  FROM conversations
), calls AS (
  SELECT conv_id, turn, 'c' || turn AS id, n, word,
    CASE n % 3 WHEN 0 THEN 'search' WHEN 1 THEN 'measure' ELSE 'note' END AS name
  FROM turns WHERE role = 'assistant'
), told AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, id ORDER BY turn, name, n, word) - 1 AS again
  FROM calls
), results AS (
  SELECT conv_id, turn, 'c' || (turn - 1) AS id, text,
    row_number() OVER (PARTITION BY conv_id, turn ORDER BY text NULLS FIRST) - 1 AS again
  FROM turns WHERE role = 'user' AND turn > 0
), linked AS (
  SELECT c.conv_id, c.turn, c.n % 6 = 0 AND EXISTS (
    SELECT 1 FROM told d WHERE d.conv_id = c.conv_id AND d.turn = c.turn + 2) AS forward
  FROM told c WHERE c.again = 0
), chains AS (
  SELECT conv_id, turn, min(turn) FILTER (NOT forward) OVER (
    PARTITION BY conv_id, turn % 2 ORDER BY turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    AS chain_end
  FROM linked
), behind AS (
  SELECT c.*, CASE WHEN c.n % 6 = 0 AND h.turn IS NOT NULL THEN h.chain_end ELSE c.turn END AS place,
    CASE WHEN c.n % 6 = 0 AND h.turn IS NOT NULL THEN (h.chain_end - c.turn) // 2 ELSE 0 END AS hops
  FROM told c LEFT JOIN chains h ON h.conv_id = c.conv_id AND h.turn = c.turn + 2
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY place, hops, turn, id, again)
    AS position
  FROM behind
), checked AS (
  SELECT *, CASE name
      WHEN 'search' THEN '{"limit":' || n || ',"query":"' || word || '"}'
      WHEN 'measure' THEN '{"unit":"' || CASE WHEN n % 4 = 0 THEN 'bytes' ELSE 'chars' END
        || '","value":' || CASE WHEN n % 5 = 0 THEN '"' || n || '"' ELSE n::VARCHAR END || '}'
      ELSE CASE WHEN n % 11 = 0 THEN 'null' ELSE '{' || CASE WHEN n % 7 = 0
        THEN '"mood":null,' ELSE '' END || '"tags":["b","a"],"text":"' || word || '"}' END
      END AS shown,
    CASE name
      WHEN 'search' THEN ''
      WHEN 'measure' THEN concat_ws('; ', CASE WHEN n % 4 = 0 THEN 'unit: not allowed' END,
        CASE WHEN n % 5 = 0 THEN 'value: not integer' END)
      ELSE CASE WHEN n % 11 = 0 THEN 'not JSON' WHEN n % 7 = 0 THEN 'mood: unknown' ELSE '' END
      END AS problems
  FROM placed
)
SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.position, 0) AS position, coalesce(c.id, r.id) AS call_id,
  c.name,
  CASE WHEN c.id IS NULL THEN 'orphan' WHEN r.id IS NULL THEN 'pending'
       WHEN r.turn < c.turn THEN 'early' ELSE 'linked' END AS status,
  CASE WHEN c.id IS NOT NULL THEN c.problems END AS problems, false AS cyclic,
  coalesce(c.again, r.again) AS again,
  '{"arguments":' || coalesce(c.shown, 'null') || ',"id":' || to_json(coalesce(c.id, r.id))
    || ',"name":' || coalesce(to_json(c.name), 'null') || ',"result":'
    || coalesce(to_json(r.text), 'null') || '}' AS json
FROM checked c FULL JOIN results r
  ON c.conv_id = r.conv_id AND c.id = r.id AND c.again = r.again
"""

OP5 = r"""
WITH rows AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY source
), weighed AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][
    CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS weight
  FROM sources
), levels AS (
  SELECT *, 2.0::DOUBLE * source_size AS most, 2.0::DOUBLE * source_size / weight AS fills,
    (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER (
       ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
), goals AS (
  SELECT source, source_size, coalesce(least(most, weight * (
      SELECT arg_min(level, fills) FROM levels WHERE level < fills)), most) AS target
  FROM levels
), budgets AS (
  SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS words,
    CASE WHEN source_size > 0
         THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS whole
  FROM goals
), alike AS (
  SELECT source, key, count(*) AS n, sum(size) AS words FROM rows GROUP BY source, key
), placed AS (
  SELECT *, sum(words) OVER (PARTITION BY source ORDER BY key) - words AS before FROM alike
)
SELECT r.doc_id, r.size, b.source_size, b.target,
  CAST(b.whole * r.size + CASE
    WHEN b.words - b.whole * b.source_size - p.before >= p.words THEN r.size
    WHEN b.words - b.whole * b.source_size > p.before
      THEN (b.words - b.whole * b.source_size - p.before) // p.n
    ELSE 0 END AS BIGINT) AS taken
FROM rows r
JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source
JOIN placed p ON r.source IS NOT DISTINCT FROM p.source AND r.key = p.key
"""

OP10 = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id,
    list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.row AS q_row, q.vec_id AS query_id, c.vec_id,
    CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.row <> c.row AND len(q.x) = len(c.x)
  WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (
    PARTITION BY q_row ORDER BY score DESC, vec_id NULLS LAST) AS INT) AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

OP11 = r"""
WITH counted AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words,
    row_number() OVER () AS r
  FROM documents WHERE text IS NOT NULL),
sized AS (SELECT r, doc_id, words, len(words)::BIGINT AS n FROM counted WHERE len(words) > 0),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM sized),
asked AS (
  SELECT q, item_id, word, count(*) AS times FROM (
    SELECT row_number() OVER () AS q, item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS word
    FROM benchmark)
  GROUP BY ALL),
postings AS (
  SELECT r, doc_id, n, word, count(*) AS tf FROM (
    SELECT r, doc_id, n, unnest(words) AS word FROM sized)
  WHERE word IN (SELECT word FROM asked) GROUP BY ALL),
weights AS (
  SELECT word, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT word, count(*) AS df FROM postings GROUP BY word), corpus),
scored AS (
  SELECT q, item_id, doc_id, sum(times * w * ((1000000000 * tf)
    // (1000 * tf + 12 * (75 + (25 * n * docs) // total))))::BIGINT AS score
  FROM asked JOIN weights USING (word) JOIN postings USING (word), corpus
  GROUP BY q, item_id, r, doc_id),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY q ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
