"""DuckDB SQL for the queries of this subpackage that SQL can express."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^\\\\\\[<]', '', 'g')) + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 4
    ELSE 14 + length(role) + length(regexp_replace(role, '[^\\\\\\[<\\]]', '', 'g')) END AS chars FROM turns
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (3 + sum(chars))::BIGINT AS formatted_chars, 0::BIGINT AS rewrites
FROM sized GROUP BY conv_id
"""

OP2 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words
), sizes AS (SELECT doc_id, len(s) AS n FROM sets),
items AS (SELECT doc_id, unnest(s) AS x FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
  JOIN sizes na ON na.doc_id = a.doc_id JOIN sizes nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)
SELECT s.doc_id, s.n AS n_shingles, min(r.b) AS component_id FROM sizes s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.n
"""

OP3 = """
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words)
), low AS (SELECT x, min(doc_id) AS low FROM windows GROUP BY x),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM windows JOIN low USING (x) WHERE low < doc_id
), each AS (
  SELECT doc_id, w[i] AS word, i FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words)
), kept AS (
  SELECT e.doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n FROM each e ANTI JOIN gone g USING (doc_id, i) GROUP BY e.doc_id
)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, (len(w.w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM words w LEFT JOIN kept k USING (doc_id)
"""

OP10 = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), sized AS (SELECT item_id, w, least(10, len(w)) AS k FROM items WHERE len(w) > 0),
wanted AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS x FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM sized)
), windows AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS x
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT DISTINCT k FROM sized))
), hits AS (SELECT doc_id, i, k, item_id FROM windows JOIN wanted USING (k, x)),
spots AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) FROM hits) GROUP BY doc_id),
names AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(s.n, 0)::BIGINT AS n_hit, coalesce(m.n, 0)::BIGINT AS n_items,
       sha256(coalesce(m.ids, '')) AS items_sha256, coalesce(s.n, 0) > 0 AS contaminated
FROM words w LEFT JOIN spots s USING (doc_id) LEFT JOIN names m USING (doc_id)
"""



def _lloyd(rounds: int = 4, parts: int = 4, entries: int = 256) -> str:
    """The rounds unrolled; whole numbers are kept as doubles, which hold them exactly."""

    def nearest(book: str) -> str:
        return f"""
  SELECT r, p, min(struct_pack(d := list_dot_product(a.v, a.v) - 2 * list_dot_product(a.v, c.v) + list_dot_product(c.v, c.v), k := c.k)) AS best
  FROM parts a JOIN {book} c USING (p) GROUP BY r, p"""

    steps = []
    for n in range(rounds):
        steps.append(f"a{n} AS MATERIALIZED ({nearest(f'c{n}')})")
        steps.append(f"""m{n} AS (
  SELECT p, k, list(x ORDER BY i) AS v FROM (
    SELECT p, best.k AS k, i, floor(sum(v[i]) / count(*)) AS x
    FROM parts JOIN a{n} USING (r, p), LATERAL (SELECT unnest(range(1, len(v) + 1)) AS i) GROUP BY p, best.k, i
  ) GROUP BY p, k)""")
        steps.append(f"c{n + 1} AS MATERIALIZED (SELECT c.p, c.k, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN m{n} m ON m.p = c.p AND m.k = c.k)")
    return f"""
WITH whole AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, label NULLS FIRST, embedding) AS r, vec_id, label,
         list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS x
  FROM embeddings WHERE len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
), parts AS MATERIALIZED (
  SELECT r, p, x[p * (len(x) // {parts}) + 1 : (p + 1) * (len(x) // {parts})] AS v FROM whole, (SELECT unnest(range({parts})) AS p)
), c0 AS MATERIALIZED (SELECT p, r - 1 AS k, v FROM parts WHERE r <= {entries}),
{(", " + chr(10)).join(steps)},
last AS MATERIALIZED ({nearest(f'c{rounds}')}),
codes AS (
  SELECT r, string_agg(lpad(lower(to_hex(best.k)), 2, '0'), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM last GROUP BY r
), books AS (
  SELECT sha256(string_agg(array_to_string(list_transform(v, lambda x: x::BIGINT::VARCHAR), ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM c{rounds}
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM whole JOIN codes USING (r), books
"""


ORACLE_SQL = {"op1_chat_formatting": OP1, "op2_jaccard_join": OP2, "op3_substring_dedup": OP3, "op10_decontamination": OP10, "op12_vector_codes": _lloyd()}
