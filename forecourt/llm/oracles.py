"""Results of those queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from forecourt.llm.licences import TEMPLATES

_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOW + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _licence_scan() -> str:
    templates = ", ".join(f"({_quote(n)}, {_quote(t)})" for n, t in TEMPLATES.items())
    plain = r"trim(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
    bigrams = "list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))])"
    return f"""
WITH made AS (
  SELECT licence, {bigrams} AS b FROM (
    SELECT licence, string_split({plain.format('t')}, ' ') AS w FROM (VALUES {templates}) v(licence, t))
), units AS (
  SELECT doc_id, i AS place, string_split({plain.format('line')}, ' ') AS w FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents
    UNION ALL SELECT doc_id, text, -1 FROM documents WHERE text LIKE '%' || chr(10) || '%')
), sets AS (
  SELECT doc_id, place, {bigrams} AS b FROM units WHERE len(w) BETWEEN 2 AND 400
), parts AS (
  SELECT doc_id, place, len(b) AS n, unnest(b) AS g FROM sets
), of_made AS (
  SELECT licence, len(b) AS n, unnest(b) AS g FROM made
), shared AS (
  SELECT p.doc_id, p.place, m.licence, 2 * count(*)::DOUBLE / (any_value(p.n) + any_value(m.n)) AS dice
  FROM parts p JOIN of_made m USING (g) GROUP BY ALL HAVING dice >= 0.8
), best AS (
  SELECT doc_id, place, arg_min(licence, (-dice, licence)) AS licence, max(dice) AS dice FROM shared GROUP BY ALL
), of_doc AS (
  SELECT doc_id, count(*) AS n, string_agg(DISTINCT licence, ',' ORDER BY licence) AS names, max(dice) AS dice FROM best GROUP BY 1
)
SELECT d.doc_id, coalesce(n, 0) AS n_notices, coalesce(names, '') AS licences, coalesce(dice, 0.0::DOUBLE) AS best_dice
FROM documents d LEFT JOIN of_doc USING (doc_id)
"""


_NEAR_DEDUP = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOW.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) END AS s FROM words
), parts AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM parts a JOIN parts b ON a.g = b.g AND a.doc_id <> b.doc_id
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY ALL HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
), reach AS (
  SELECT a AS doc_id, least(a, b) AS low FROM links
  UNION SELECT l.b, r.low FROM reach r JOIN links l ON l.a = r.doc_id WHERE r.low <= l.b
), low AS (
  SELECT doc_id, min(low) AS low FROM reach GROUP BY 1
)
SELECT s.doc_id, len(s.s) AS n_shingles, coalesce(low, s.doc_id) AS component_id, coalesce(low, s.doc_id) = s.doc_id AS kept
FROM sets s LEFT JOIN low USING (doc_id)
"""

_LM_SCORING = f"""
WITH tok AS (
  SELECT doc_id, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS target, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i
  FROM (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents)
), uni AS (
  SELECT w, count(*) AS n, count(*) FILTER (target) AS nt FROM tok GROUP BY w
), tot AS (
  SELECT sum(n) AS n, sum(nt) AS nt FROM uni
), known AS (
  SELECT uni.* FROM uni WHERE uni.n >= 3
), voc AS (
  SELECT w, n, nt FROM known UNION ALL SELECT '', tot.n - (SELECT sum(n) FROM known), tot.nt - (SELECT sum(nt) FROM known) FROM tot
), one AS (
  SELECT w, n, nt, (n + 1.0::DOUBLE) / (SELECT sum(n) + count(*) FROM voc) AS p, (nt + 1.0::DOUBLE) / (SELECT sum(nt) + count(*) FROM voc) AS pt
  FROM voc
), seq AS (
  SELECT doc_id, i, target, coalesce(k.w, '') AS w, lag(coalesce(k.w, '')) OVER (PARTITION BY doc_id ORDER BY i) AS h
  FROM tok LEFT JOIN known k USING (w)
), pairs AS (
  SELECT h, w, count(*) AS n, count(*) FILTER (target) AS nt FROM seq WHERE h IS NOT NULL GROUP BY ALL
), rest AS (
  SELECT o.w AS h, greatest(o.n, 1) AS n, greatest(o.nt, 1) AS nt, 1 - 0.7::DOUBLE * coalesce(sum(p.n), 0) / greatest(o.n, 1) AS r,
    1 - 0.7::DOUBLE * coalesce(sum(p.nt), 0) / greatest(o.nt, 1) AS rt
  FROM one o LEFT JOIN pairs p ON p.h = o.w GROUP BY o.w, o.n, o.nt
), loss AS (
  SELECT s.doc_id, -log2(CASE WHEN s.h IS NULL THEN o.p ELSE 0.7::DOUBLE * coalesce(p.n, 0) / r.n + r.r * o.p END) AS b,
    -log2(CASE WHEN s.h IS NULL THEN o.pt ELSE 0.7::DOUBLE * coalesce(p.nt, 0) / r.nt + r.rt * o.pt END) AS t
  FROM seq s JOIN one o ON o.w = s.w LEFT JOIN rest r ON r.h = s.h LEFT JOIN pairs p ON p.h = s.h AND p.w = s.w
), of_doc AS (
  SELECT doc_id, count(*) AS n, avg(t) AS t, avg(b) AS b FROM loss GROUP BY 1
)
SELECT d.doc_id, coalesce(n, 0) AS n_tokens, round(t, 6) AS target_bits, round(b, 6) AS background_bits, round(t - b, 6) AS difference
FROM documents d LEFT JOIN of_doc USING (doc_id)
"""

_DECONTAMINATION = f"""
WITH items AS (
  SELECT item_id, {_WORDS.format("coalesce(text, '')")} AS w FROM benchmark WHERE item_id IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, len(w[i:i + 9]) AS n, array_to_string(w[i:i + 9], ' ') AS t FROM (
    SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), docs AS (
  SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents
), places AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), hits AS (
  SELECT p.doc_id, p.i, p.n, m.item_id FROM places p JOIN windows m ON m.t = p.t AND m.n = p.n
), inside AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY 1
), found AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
  FROM hits GROUP BY 1
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN inside USING (doc_id) LEFT JOIN found USING (doc_id)
"""

_TOOL_CALLS = """
WITH RECURSIVE turns AS (
  SELECT conv_id, turn, role, text, length(text) AS n, to_json(text)::VARCHAR AS q FROM conversations
), calls AS (
  SELECT conv_id, turn, n, 'call_' || turn AS call_id, CASE WHEN n % 2 = 0 THEN turn - 2 END AS up,
    CASE n % 4 WHEN 0 THEN 'search' WHEN 1 THEN 'translate' WHEN 2 THEN 'summarise' ELSE 'lookup' END AS name,
    CASE WHEN n % 11 = 0 THEN 'null'
      WHEN n % 4 = 0 AND n % 7 = 0 THEN '{"limit":"many","query":' || q || '}'
      WHEN n % 4 = 0 THEN '{"limit":' || n % 10 || ',"query":' || q || '}'
      WHEN n % 4 = 1 AND n % 5 = 0 THEN '{"text":' || q || '}'
      WHEN n % 4 = 1 THEN '{"text":' || q || ',"to":"en"}'
      WHEN n % 4 = 2 AND n % 6 = 0 THEN '{"brief":true,"text":' || q || ',"words":' || n || '}'
      WHEN n % 4 = 2 THEN '{"text":' || q || ',"words":' || n || '}'
      ELSE '{"key":' || q || '}' END AS arguments
  FROM turns WHERE role = 'user'
), results AS (
  SELECT conv_id, turn AS result_turn, turn - 1 AS turn, q FROM turns WHERE role = 'assistant'
), parents AS (
  SELECT c.conv_id, c.turn, p.turn AS up FROM calls c LEFT JOIN calls p ON p.conv_id = c.conv_id AND p.turn = c.up
), levels AS (
  SELECT conv_id, turn, 0 AS level FROM parents WHERE up IS NULL
  UNION ALL SELECT p.conv_id, p.turn, l.level + 1 FROM levels l JOIN parents p ON p.conv_id = l.conv_id AND p.up = l.turn
)
SELECT conv_id, coalesce(c.call_id, 'call_' || r.turn) AS call_id, coalesce(c.turn, r.result_turn) AS turn, c.name,
  l.level::BIGINT AS level,
  CASE WHEN c.turn IS NULL THEN 'orphan' WHEN r.turn IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
  CASE WHEN c.turn IS NULL THEN '' ELSE concat_ws(',',
    CASE WHEN c.n % 11 = 0 THEN 'arguments' END, CASE WHEN c.n % 4 = 3 THEN 'tool' END,
    CASE WHEN c.n % 11 = 0 THEN NULL WHEN c.n % 4 = 0 AND c.n % 7 = 0 THEN 'type:limit'
      WHEN c.n % 4 = 1 AND c.n % 5 = 0 THEN 'missing:to' WHEN c.n % 4 = 2 AND c.n % 6 = 0 THEN 'unknown:brief' END,
    CASE WHEN c.up IS NOT NULL AND p.up IS NULL THEN 'parent' END) END AS errors,
  '{"arguments":' || coalesce(c.arguments, 'null') || ',"id":"' || coalesce(c.call_id, 'call_' || r.turn) || '","name":'
    || coalesce('"' || c.name || '"', 'null') || ',"result":' || coalesce(r.q, 'null') || '}' AS message
FROM calls c FULL JOIN results r USING (conv_id, turn) LEFT JOIN parents p USING (conv_id, turn) LEFT JOIN levels l USING (conv_id, turn)
"""


_FILL_MIDDLE = """
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS d FROM documents
), drawn AS (
  SELECT doc_id, t, length(t) AS n, ('0x' || substr(d, 1, 8))::UBIGINT AS h1, ('0x' || substr(d, 9, 8))::UBIGINT AS h2,
    ('0x' || substr(d, 17, 8))::UBIGINT AS h3, ('0x' || substr(d, 25, 8))::UBIGINT AS h4 FROM hashed
), cut AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1))::BIGINT AS a, greatest(h1 % (n + 1), h2 % (n + 1))::BIGINT AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn
), parts AS (
  SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1, n - b) AS s FROM cut
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a::DOUBLE END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN (b - a)::DOUBLE END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM parts
"""


_HARD_NEGATIVES = """
WITH valid AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor, b.vec_id AS other, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS s
  FROM valid a JOIN valid b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT * FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY s DESC, other) <= 5
)
SELECT p.anchor AS anchor_id, p.other AS positive_id,
  (row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.s DESC, n.other))::INT AS rank, n.other AS negative_id,
  p.s AS positive_score, n.s AS negative_score
FROM positives p JOIN scores n ON n.anchor = p.anchor AND NOT n.same AND 30 * p.s <= 100 * n.s AND 100 * n.s <= 90 * p.s
QUALIFY rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_licence_scan": _licence_scan(),
        "op4_near_dedup": _NEAR_DEDUP,
        "op7_lm_scoring": _LM_SCORING,
        "op9_decontamination": _DECONTAMINATION,
        "op10_tool_calls": _TOOL_CALLS,
        "op12_fill_middle": _FILL_MIDDLE,
        "op13_hard_negatives": _HARD_NEGATIVES,
    }
