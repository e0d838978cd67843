"""The registered queries of the subpackage and what DuckDB can check of them."""

from vigil.llm.bpe import op1_bpe
from vigil.llm.decontaminate import op11_decontamination
from vigil.llm.extract import op7_html_extraction
from vigil.llm.hnsw import op3_embedding_near_dedup
from vigil.llm.jaccard import op8_ngram_join
from vigil.llm.language import op4_language_id
from vigil.llm.licences import op5_licence_scan
from vigil.llm.lines import op9_line_dedup
from vigil.llm.mixing import op2_mixing
from vigil.llm.phrases import op12_phrases
from vigil.llm.quality import op6_quality_rules
from vigil.llm.repair import op13_conversation_repair
from vigil.llm.scoring import op10_lm_scores

QUERIES = {f.__name__: f for f in (
    op1_bpe, op2_mixing, op3_embedding_near_dedup, op4_language_id, op5_licence_scan, op6_quality_rules,
    op7_html_extraction, op8_ngram_join, op9_line_dedup, op10_lm_scores,
    op11_decontamination, op12_phrases, op13_conversation_repair)}

_REACH = """reach(id, other) AS (
  SELECT id, id FROM every UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other)"""

ORACLE = {
    "op3_embedding_near_dedup": f"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
good AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v
  WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM good p JOIN good q ON p.vec_id <> q.vec_id AND len(p.e) = len(q.e)
  WHERE list_dot_product(p.e, q.e) / (p.n * q.n) >= 0.95),
every AS (SELECT vec_id AS id FROM v),
{_REACH}
SELECT id AS vec_id, (SELECT count(*) FROM links WHERE a = id)::BIGINT AS n_links, min(other) AS component_id, id = min(other) AS kept
FROM reach GROUP BY id""",
    "op8_ngram_join": f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
shingled AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM worded WHERE len(w) > 0)),
sized AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id),
shared AS (
  SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c
  FROM shingled p JOIN shingled q ON p.s = q.s AND p.doc_id <> q.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
every AS (SELECT doc_id AS id FROM documents),
{_REACH}
SELECT id AS doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN sized ON sized.doc_id = id GROUP BY id""",
    "op11_decontamination": """
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id::VARCHAR AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 10) AS span, array_to_string(w[i:i + 9], ' ') AS s
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
place AS (
  SELECT row, span, i, array_to_string(w[i:i + span - 1], ' ') AS s
  FROM (SELECT row, w, span, unnest(range(1, len(w) - span + 2)) AS i FROM d, (SELECT DISTINCT span FROM win) WHERE len(w) >= span)),
hit AS (
  SELECT row, span, i, s FROM place WHERE (span, s) IN (SELECT (span, s) FROM win)),
covered AS (
  SELECT row, count(DISTINCT j) AS n FROM (SELECT row, unnest(range(i, i + span)) AS j FROM hit) GROUP BY row),
named AS (
  SELECT row, string_agg(item, ',' ORDER BY item) AS names, count(*) AS n
  FROM (SELECT DISTINCT row, item FROM hit JOIN win USING (span, s) WHERE item IS NOT NULL) GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(covered.n, 0)::BIGINT AS n_hit, coalesce(named.n, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (row) LEFT JOIN named USING (row)""",
    "op12_phrases": """
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p
  FROM documents),
worded AS (
  SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM piece),
gram AS (
  SELECT lang, m AS len, w[i:i + m - 1] AS g, count(*) AS f
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM worded, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m)
  GROUP BY 1, 2, 3),
total AS (
  SELECT lang, sum(f) AS n FROM gram WHERE len = 1 GROUP BY lang),
cand AS (
  SELECT * FROM gram WHERE len > 1 AND f >= 30),
cut AS (
  SELECT c.lang, c.g, c.f AS a, k, l.f AS l, r.f AS r, (2000000 * c.f::HUGEINT) // (l.f::HUGEINT + r.f) AS score
  FROM (SELECT *, unnest(range(1, len)) AS k FROM cand) c
  JOIN gram l ON l.lang = c.lang AND l.g = c.g[:k] JOIN gram r ON r.lang = c.lang AND r.g = c.g[k + 1:]),
best AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inside AS (
  SELECT lang, g[i:i + m - 1] AS g, max(f) AS top
  FROM (SELECT lang, g, f, m, unnest(range(1, len - m + 2)) AS i FROM cand, (SELECT unnest([2, 3]) AS m) WHERE len > m) GROUP BY 1, 2),
kept AS (
  SELECT best.*, array_to_string(g, ' ') AS phrase FROM best LEFT JOIN inside USING (lang, g)
  WHERE top IS NULL OR 100 * top::HUGEINT < 80 * a::HUGEINT)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
       n::BIGINT AS n, score::BIGINT AS score
FROM kept JOIN total USING (lang) QUALIFY rank <= 2000""",
}
