"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tickhouse.llm.mixing import MAX_READINGS

# The characters that end words and are stripped from lines.
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def mixing(docs: str = "documents") -> str:
    """CTEs up to ``mixed``: unit rows with their finish times and readings."""
    readings = ", ".join(str(n) for n in range(MAX_READINGS))
    return rf"""
sized AS (
  SELECT doc_id, source,
         coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM {docs}),
units AS (
  SELECT doc_id, source, size, count(*) AS copies,
         ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS key
  FROM sized GROUP BY ALL),
totals AS (SELECT source, sum(size * copies)::BIGINT AS source_size FROM units GROUP BY source),
ranked AS (
  SELECT source, source_size, 3 * source_size AS ceiling,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM totals),
levelled AS (
  SELECT *, ceiling::DOUBLE / weight AS ratio,
         ((SELECT sum(source_size) FROM totals)
          - coalesce(sum(ceiling) OVER (ORDER BY ceiling::DOUBLE / weight, source NULLS LAST
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         )::DOUBLE / sum(weight) OVER (ORDER BY ceiling::DOUBLE / weight, source NULLS LAST
                                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked),
shares AS (
  SELECT source, source_size, least(ceiling::DOUBLE, weight * (
    SELECT level FROM levelled WHERE level * weight <= ceiling ORDER BY ratio, level LIMIT 1)
  ) AS target
  FROM levelled),
queued AS (
  SELECT u.*, s.source_size, s.target,
         sum(size * copies) OVER (PARTITION BY u.source ORDER BY key, doc_id, size
                                  ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
  FROM units u JOIN shares s ON u.source IS NOT DISTINCT FROM s.source),
times AS (
  SELECT *, (n * source_size + upto)::DOUBLE / target AS finish
  FROM queued, (SELECT unnest([{readings}]) AS n) WHERE n * source_size < target),
within AS (
  SELECT finish, sum(sum(size * copies)) OVER (ORDER BY finish) AS used
  FROM times GROUP BY finish),
cut AS (SELECT max(finish) AS finish FROM within
        WHERE used <= (SELECT sum(source_size) FROM totals)),
mixed AS (
  SELECT q.doc_id, q.source, q.size, q.copies, q.source_size, q.target,
         (SELECT count(*) FROM times t WHERE t.doc_id IS NOT DISTINCT FROM q.doc_id
            AND t.source IS NOT DISTINCT FROM q.source AND t.size = q.size
            AND t.finish <= (SELECT finish FROM cut)) AS readings
  FROM queued q)"""


def lines(docs: str = "documents") -> str:
    """CTEs up to ``kept``: documents with their lines and what is left of them."""
    return f"""
split_up AS (
  SELECT *, string_split(coalesce(text, ''), chr(10)) AS all_lines FROM {docs}),
line_rows AS (
  SELECT doc_id, unnest(all_lines) AS line, generate_subscripts(all_lines, 1) AS pos
  FROM split_up),
line_keys AS (
  SELECT doc_id, pos, line,
         translate(trim(line, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS key
  FROM line_rows),
common AS (
  SELECT key, max(doc_id) AS last_doc FROM line_keys WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT l.doc_id, l.pos, l.line, c.key IS NOT NULL AND l.doc_id <> c.last_doc AS gone
  FROM line_keys l LEFT JOIN common c ON l.key = c.key),
kept AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept_text
  FROM marked GROUP BY doc_id)"""


_WORD = r"'[^\x20\x09-\x0D]+'"
_LOWER = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz')")

TOP_K = """
WITH parts AS (
  SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i,
         len(embedding) AS d
  FROM embeddings),
whole AS (
  SELECT vec_id, i, floor(1024 * x)::BIGINT AS x, d FROM parts
  WHERE vec_id NOT IN (SELECT vec_id FROM parts WHERE x IS NULL OR NOT isfinite(x))),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
  FROM whole q JOIN whole c ON q.i = c.i AND q.d = c.d
  WHERE q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
  GROUP BY ALL)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER
         AS rank, vec_id, score
FROM scores QUALIFY rank <= 10"""

# Least vertex that links reach, from each vertex: the links are a handful.
_REACH = """
linked AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, other) AS (
  SELECT a, b FROM linked
  UNION
  SELECT r.id, l.b FROM reach r JOIN linked l ON r.other = l.a),
classes AS (SELECT id, least(id, min(other)) AS component_id FROM reach GROUP BY id)"""

VECTORS = f"""
WITH RECURSIVE parts AS (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i,
         len(embedding) AS d
  FROM embeddings WHERE label IS NOT NULL),
norms AS (
  SELECT vec_id, sqrt(sum(x * x)) AS norm FROM parts GROUP BY vec_id
  HAVING bool_and(x IS NOT NULL AND isfinite(x)) AND sum(x * x) > 0),
ok AS (SELECT p.*, norm FROM parts p JOIN norms USING (vec_id)),
links AS (
  SELECT p.vec_id AS a, q.vec_id AS b
  FROM ok p JOIN ok q ON p.label = q.label AND p.i = q.i AND p.d = q.d AND p.vec_id < q.vec_id
  GROUP BY p.vec_id, q.vec_id HAVING sum(p.x / p.norm * (q.x / q.norm)) >= 0.93),
{_REACH.strip()},
counts AS (SELECT a AS id, count(*) AS n FROM linked GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
       vec_id = coalesce(component_id, vec_id) AS kept
FROM embeddings e LEFT JOIN classes c ON e.vec_id = c.id LEFT JOIN counts k ON e.vec_id = k.id"""

SUBSTRINGS = f"""
WITH listed AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
placed AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i, len(w) AS n, w FROM listed),
windows AS (
  SELECT doc_id, word, i, n, CASE WHEN i <= n - 49 THEN md5(array_to_string(w[i:i+49], ' ')) END AS h
  FROM placed),
owned AS (SELECT h, min(doc_id) AS owner FROM windows WHERE h IS NOT NULL GROUP BY h),
marked AS (
  SELECT p.doc_id, p.word, p.i, p.n,
         max(CASE WHEN owner < p.doc_id THEN 1 ELSE 0 END) OVER (
           PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM windows p LEFT JOIN owned o ON p.h = o.h),
kept AS (
  SELECT doc_id, sum(gone)::BIGINT AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY i) FILTER (gone = 0), '') AS left_text
  FROM marked GROUP BY doc_id)
SELECT l.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(left_text, '')) AS kept_sha256
FROM listed l LEFT JOIN kept k ON l.doc_id = k.doc_id"""

NEAR = f"""
WITH RECURSIVE listed AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, {_WORD}) AS w FROM documents),
starts AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM listed WHERE len(w) > 0),
sets AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS shingle FROM starts),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
  SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS shared
  FROM sets p JOIN sets q ON p.shingle = q.shingle AND p.doc_id < q.doc_id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
{_REACH.strip()}
SELECT l.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, l.doc_id) AS component_id,
       l.doc_id = coalesce(component_id, l.doc_id) AS kept
FROM listed l LEFT JOIN sizes s ON l.doc_id = s.doc_id LEFT JOIN classes c ON l.doc_id = c.id"""

INFILL = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
numbers AS (
  SELECT doc_id, text, n, ('0x' || h[1:8])::BIGINT % (n + 1) AS x,
         ('0x' || h[9:16])::BIGINT % (n + 1) AS y, ('0x' || h[17:24])::BIGINT % 100 AS z,
         ('0x' || h[25:32])::BIGINT % 100 AS u
  FROM drawn),
formed AS (
  SELECT doc_id, text, n, least(x, y) AS a, greatest(x, y) AS b,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>')
                OR contains(text, '<M>') OR z >= 90 THEN 'plain'
              WHEN u < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers),
parts AS (
  SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle,
         substr(text, b + 1) AS suffix
  FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                   WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                   ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END
       ) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts"""

# The letters of a run are one or two bytes in UTF-8. Near words are equal without the
# letter at one place, or one is the other without some letter.
SPELLING = """
WITH RECURSIVE table_of AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _:
           CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) AS r(i)),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
counted AS (SELECT doc_id, run, count(*) AS k FROM runs WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (
  SELECT run, k, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
           string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c:
           CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
                ELSE [192 + unicode(c) // 64, 128 + unicode(c) % 64]::BIGINT[] END))),
           lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) AS h
  FROM counted, table_of),
words AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run))
                || substr(run, (h % length(run)) + 2) ELSE run END AS word, k
  FROM hashed),
vocabulary AS (
  SELECT word, sum(k)::BIGINT AS n FROM words WHERE length(word) >= 6
  GROUP BY word HAVING sum(k) >= 5),
less AS (
  SELECT word, n, i, length(word) AS size, substr(word, 1, i) || substr(word, i + 2) AS part
  FROM vocabulary, unnest(range(length(word) + 1)) AS r(i)),
near AS (
  SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n
  FROM less a JOIN less b ON a.part = b.part AND a.word <> b.word
  WHERE a.i = b.i AND a.size = b.size
     OR a.i = a.size AND b.size = a.size + 1 OR b.i = b.size AND a.size = b.size + 1),
best AS (
  SELECT word, count(*) AS n_near,
         first(near ORDER BY near_n DESC, near COLLATE "C") AS near, max(near_n) AS near_n
  FROM near GROUP BY word),
formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN near_n >= 5 * v.n THEN near END AS form,
         CASE WHEN near_n >= 5 * v.n THEN near_n END AS form_n
  FROM vocabulary v LEFT JOIN best b ON v.word = b.word),
walk(word, root, form) AS (
  SELECT word, word, form FROM formed
  UNION ALL
  SELECT w.word, f.word, f.form FROM walk w JOIN formed f ON w.form = f.word)
SELECT f.word, f.form, w.root, f.n, f.n_near, f.form_n
FROM formed f JOIN walk w ON f.word = w.word AND w.form IS NULL"""

ORACLES = {
    "op12_infill": INFILL,
    "op13_spelling": SPELLING,
    "op2_topk": TOP_K,
    "op5_vectors": VECTORS,
    "op6_substrings": SUBSTRINGS,
    "op8_minhash": NEAR,
    "op3_mixing": f"""WITH {mixing()}
SELECT doc_id, size, source_size, target, (size * readings)::BIGINT AS taken
FROM mixed, unnest(range(copies)) AS c(i)""",
    "op9_lines": f"""WITH {lines()}
SELECT doc_id, n_lines, n_dropped, sha256(kept_text) AS kept_sha256 FROM kept""",
}
