"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

from lakeward.llm.adaptive_rules import MAX_REPEAT_PERCENT, MIN_WORDS, PRIOR_ROWS, SLACK, SPREADS, STEPS
from lakeward.llm.queries import URL_RULES

_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)

OP1 = rf"""
WITH cut AS (
  SELECT page_id, CASE WHEN url IS NOT NULL AND strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(r_host, r_path, r_verdict) AS (VALUES {_RULES}),
fits AS (
  SELECT page_id, arg_max(r_host || r_path, length(r_host || r_path)) AS rule, arg_max(r_verdict, length(r_host || r_path)) AS verdict
  FROM (SELECT DISTINCT page_id, host, path FROM parts) JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
  GROUP BY page_id)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM parts p LEFT JOIN fits f USING (page_id)"""

_WORDS = r"""regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"""
_SHARE = {"symbols": ("n_symbols", "word_chars"), "dup_lines": ("n_dup_lines * 10", "n_words"), "repeats": ("n_repeat_words", "n_words")}
_STEP = {k: f"least({STEPS}, CASE WHEN {b} > 0 THEN {STEPS} * {a} // {b} ELSE 0 END)" for k, (a, b) in _SHARE.items()}
_CELLS = " UNION ALL ".join(f"SELECT lang, source, '{k}' AS ratio, {v} AS step FROM stats WHERE NOT base_failed" for k, v in _STEP.items())
_SLACK = "CASE ratio " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in SLACK.items()) + " END"
_FENCE = "\n".join(f"LEFT JOIN fences f_{k} ON f_{k}.ratio = '{k}' AND f_{k}.lang IS NOT DISTINCT FROM s.lang AND f_{k}.source IS NOT DISTINCT FROM s.source" for k in SLACK)
_INSIDE = " AND ".join(f"coalesce({v} <= f_{k}.fence, true)" for k, v in _STEP.items())

QUALITY_STATS = rf"""
docs AS (SELECT doc_id, row_number() OVER () AS r, lang, source, text, {_WORDS} AS w FROM documents),
tri AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM docs)),
again AS (SELECT r, i FROM tri JOIN (SELECT r, t FROM tri GROUP BY r, t HAVING count(*) > 1) USING (r, t)),
hit AS (SELECT r, count(DISTINCT i + j) AS n FROM again, (VALUES (0), (1), (2)) o(j) GROUP BY r),
line AS (SELECT r, unnest(string_split(coalesce(text, ''), chr(10))) AS l FROM docs),
dup AS (SELECT r, sum(c - 1) AS n FROM (SELECT r, l, count(*) AS c FROM line WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r, l) GROUP BY r),
counted AS (
  SELECT doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS n_symbols,
         coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(hit.n, 0)::BIGINT AS n_repeat_words
  FROM docs LEFT JOIN dup USING (r) LEFT JOIN hit USING (r)),
stats AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counted),
cells AS (SELECT lang, source, ratio, step, count(*)::DOUBLE AS n FROM ({_CELLS}) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source, ratio FROM cells),
merged AS (
  SELECT lang, source, ratio, step, sum(n) AS n FROM (
    SELECT * FROM cells
    UNION ALL
    SELECT g.lang, g.source, g.ratio, l.step, l.n FROM groups g JOIN (
      SELECT lang, ratio, step, {PRIOR_ROWS} * sum(n) / sum(sum(n)) OVER (PARTITION BY lang, ratio) AS n FROM cells GROUP BY lang, ratio, step) l
      ON g.lang IS NOT DISTINCT FROM l.lang AND g.ratio = l.ratio
    UNION ALL
    SELECT g.lang, g.source, g.ratio, a.step, a.n FROM groups g JOIN (
      SELECT ratio, step, {PRIOR_ROWS} * sum(n) / sum(sum(n)) OVER (PARTITION BY ratio) AS n FROM cells GROUP BY ratio, step) a USING (ratio))
  GROUP BY lang, source, ratio, step),
upto AS (
  SELECT lang, source, ratio, step, round(sum(n) OVER (PARTITION BY lang, source, ratio ORDER BY step ROWS UNBOUNDED PRECEDING)
         / sum(n) OVER (PARTITION BY lang, source, ratio), 9) AS u FROM merged),
fences AS (
  SELECT lang, source, ratio, q3 + greatest({SPREADS} * (q3 - q1), {_SLACK}) AS fence
  FROM (SELECT lang, source, ratio, min(step) FILTER (u >= 0.25) AS q1, min(step) FILTER (u >= 0.75) AS q3 FROM upto GROUP BY lang, source, ratio))"""

OP3 = f"""WITH {QUALITY_STATS}
SELECT s.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {_INSIDE} AS kept
FROM stats s {_FENCE}"""

OP4 = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM docs WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
near AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2)
  JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * n_both >= 80 * (p.n + q.n - n_both)),
edges AS MATERIALIZED (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach AS (SELECT doc_id AS node, doc_id AS low FROM docs UNION SELECT e.b, r.low FROM reach r JOIN edges e ON e.a = r.node),
comp AS (SELECT node, min(low) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM docs d JOIN comp ON node = d.doc_id LEFT JOIN size USING (doc_id)"""

OP8 = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM docs)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS nth FROM win) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM late, range(20) o(j)),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM docs),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id)::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM docs d LEFT JOIN kept USING (doc_id)"""

OP5 = r"""
WITH RECURSIVE rows AS (SELECT conv_id, turn::BIGINT AS turn, role, text FROM conversations),
calls AS (
  SELECT conv_id, 'c' || conv_id || '_' || turn AS call_id, 'c' || conv_id || '_' || (turn - 2) AS parent_id, turn,
         CASE WHEN length(coalesce(text, '')) <= 200 THEN 'search' ELSE 'summarise' END AS name, text FROM rows WHERE role = 'user'),
results AS (SELECT conv_id, 'c' || conv_id || '_' || (turn - 1) AS call_id, turn, text AS content FROM rows WHERE role = 'assistant'),
deep AS (
  SELECT call_id, 0 AS depth FROM calls WHERE parent_id NOT IN (SELECT call_id FROM calls)
  UNION ALL SELECT c.call_id, d.depth + 1 FROM calls c JOIN deep d ON c.parent_id = d.call_id)
SELECT c.conv_id, c.call_id, c.turn, d.depth::BIGINT AS depth, c.name, CASE WHEN r.call_id IS NULL THEN 'no_result' ELSE 'linked' END AS status,
       c.name = 'search' AS args_valid, (CASE WHEN r.call_id IS NULL THEN 0 ELSE 1 END)::BIGINT AS n_results,
       '{"arguments":' || CASE WHEN c.name = 'search' THEN '{"query":' || to_json(c.text) || ',"turn":' || c.turn || '}' ELSE '{"text":' || to_json(c.text) || '}' END
         || ',"id":' || to_json(c.call_id) || ',"name":' || to_json(c.name) || ',"parent":' || to_json(c.parent_id)
         || CASE WHEN r.content IS NULL THEN '' ELSE ',"result":' || to_json(r.content) END || '}' AS json
FROM calls c LEFT JOIN results r USING (conv_id, call_id) LEFT JOIN deep d USING (call_id)
UNION ALL
SELECT r.conv_id, r.call_id, r.turn, NULL, NULL, 'no_call', NULL, 1, NULL FROM results r ANTI JOIN calls c USING (conv_id, call_id)"""

OP11 = r"""
WITH pieces AS (
  SELECT lang, p, row_number() OVER () AS id FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
split AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang),
freq AS MATERIALIZED (
  SELECT lang, phrase, k, count(*) AS f FROM (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (
      SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM split, (VALUES (1), (2), (3), (4)) l(k)))
  GROUP BY ALL HAVING count(*) >= 30),
inner_parts AS (
  SELECT lang, f, array_to_string(w[s:s + m - 1], ' ') AS phrase FROM (
    SELECT lang, f, w, m, unnest(range(1, k - m + 2)) AS s FROM (
      SELECT lang, f, k, string_split(phrase, ' ') AS w, unnest(range(2, k)) AS m FROM freq WHERE k > 2))),
around AS (SELECT lang, phrase, max(f) AS most FROM inner_parts GROUP BY ALL),
kept AS (SELECT x.lang, x.phrase, x.k, x.f AS a FROM freq x LEFT JOIN around y USING (lang, phrase)
         WHERE k > 1 AND (most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * x.f)),
cuts AS (
  SELECT lang, phrase, a, c, array_to_string(w[1:c], ' ') AS head, array_to_string(w[c + 1:k], ' ') AS tail
  FROM (SELECT lang, phrase, k, a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS c FROM kept)),
scored AS (
  SELECT q.lang, q.phrase, a, c, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f::HUGEINT + y.f))::BIGINT AS score
  FROM cuts q JOIN freq x ON x.lang = q.lang AND x.phrase = head JOIN freq y ON y.lang = q.lang AND y.phrase = tail),
lowest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS nth FROM scored) WHERE nth = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest) JOIN total USING (lang) WHERE rank <= 2000"""

OP13 = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS key, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
asked AS (
  SELECT item_id, row_number() OVER () AS item, unnest(list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS t FROM benchmark),
total AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM docs),
tf AS (SELECT key, t, count(*) AS tf FROM (SELECT key, unnest(w) AS t FROM docs) WHERE t IN (SELECT t FROM asked) GROUP BY key, t),
weight AS (SELECT t, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), total),
score AS (
  SELECT a.item_id, a.item, d.doc_id, d.key, sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * (50 + (50 * len(d.w) * n_docs) // n_terms))))::BIGINT AS score
  FROM asked a JOIN tf USING (t) JOIN weight w USING (t) JOIN docs d USING (key), total GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST, key) AS rank FROM score WHERE score > 0) WHERE rank <= 50"""

ORACLE = {"op1_url_cascade": OP1, "op3_adaptive_rules": OP3, "op4_odd_sketch": OP4, "op5_tool_calls": OP5, "op8_seed_extend": OP8, "op11_son_phrases": OP11,
          "op13_norm_buckets": OP13}
