"""The queries opN_<name> of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import decontaminate, language_id, language_model, line_dedup, mixing, quality_model, rules, tool_calls, toxicity
from .common import table
from .minhash import near_duplicates


def op1_tool_calls(spark, sf_dir):
    calls, results = tool_calls.conversation_calls(table(spark, sf_dir, "conversations"))
    found = tool_calls.link(calls, results, {"reply": tool_calls.REPLY})
    return found.select("conv_id", "call_id", "status", "place_turn", F.col("place_index").cast("long").alias("place_index"), F.col("hops").cast("long").alias("hops"), "cycle", "valid", F.md5("json").alias("json_md5"))


def op2_golden_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def op3_fuzzy_lines(spark, sf_dir):
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op4_gru_lm(spark, sf_dir):
    return language_model.held_out_scores(table(spark, sf_dir, "documents"))


def op5_quadratic_quality(spark, sf_dir):
    return quality_model.held_out_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_bigru_toxicity(spark, sf_dir):
    return toxicity.held_out_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_zstd_language(spark, sf_dir):
    return language_id.held_out_predictions(table(spark, sf_dir, "documents"))


def op8_positional_index(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), slop=4)


def op9_hyperminhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


def op10_rule_projection(spark, sf_dir):
    return rules.judge(table(spark, sf_dir, "documents"))


def queries():
    found = (op1_tool_calls, op2_golden_mix, op3_fuzzy_lines, op4_gru_lm, op5_quadratic_quality, op6_bigru_toxicity, op7_zstd_language, op8_positional_index, op9_hyperminhash, op10_rule_projection)
    return {f.__name__: f for f in found}


_OP1 = """
WITH RECURSIVE t AS (SELECT conv_id, turn, role, text FROM conversations),
ones AS (SELECT conv_id, conv_id || '-' || turn AS call_id, turn, 0 AS idx, text, CASE turn % 8 WHEN 0 THEN [conv_id || '-' || (turn + 4)] WHEN 2 THEN [conv_id || '-' || (turn - 2)]
  WHEN 6 THEN [conv_id || '-' || (turn - 2), conv_id || '-' || (turn - 4)] WHEN 4 THEN CASE WHEN conv_id % 5 = 0 THEN [conv_id || '-' || (turn - 2)] ELSE [] END ELSE [] END AS deps FROM t WHERE role = 'user'),
calls AS (SELECT * FROM ones UNION ALL SELECT conv_id, call_id || 'b', turn, 1, text, [call_id] FROM ones WHERE turn % 8 = 2),
e AS (SELECT c.call_id AS a, d.call_id AS b FROM (SELECT call_id, unnest(deps) AS dep FROM calls) c JOIN calls d ON c.dep = d.call_id),
walk AS (SELECT a AS src, b AS node FROM e UNION SELECT w.src, e.b FROM walk w JOIN e ON w.node = e.a),
ring AS (SELECT DISTINCT src FROM walk WHERE src = node),
path AS (SELECT call_id AS src, call_id AS node, 0 AS len FROM calls UNION SELECT p.src, e.b, p.len + 1 FROM path p JOIN e ON p.node = e.a WHERE p.node NOT IN (SELECT src FROM ring)),
place AS (SELECT p.src, max([CAST(c.turn AS BIGINT), CAST(c.idx AS BIGINT), CAST(p.len AS BIGINT)]) AS k FROM path p JOIN calls c ON p.node = c.call_id GROUP BY p.src),
placed AS (SELECT c.*, k[1] AS place_turn, k[2] AS place_index, k[3] AS hops, c.call_id IN (SELECT src FROM ring) AS cycle FROM calls c JOIN place ON c.call_id = place.src),
results AS (SELECT conv_id, conv_id || '-' || (turn - 1) AS call_id, min(turn) AS turn, arg_min(text, (turn, text)) AS content FROM t WHERE role = 'assistant' GROUP BY 1, 2)
SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id,
  CASE WHEN c.call_id IS NULL THEN 'no_call' WHEN r.call_id IS NULL THEN 'no_result' ELSE 'linked' END AS status, place_turn, place_index, hops, cycle,
  CASE WHEN c.call_id IS NOT NULL THEN length(coalesce(c.text, '')) >= 1 END AS valid,
  md5('{"arguments":' || CASE WHEN c.call_id IS NULL THEN 'null' ELSE '{"prompt":' || CAST(to_json(coalesce(c.text, '')) AS VARCHAR) || ',"turn":' || c.turn || '}' END
    || ',"id":' || CAST(to_json(coalesce(c.call_id, r.call_id)) AS VARCHAR) || ',"name":' || CASE WHEN c.call_id IS NULL THEN 'null' ELSE '"reply"' END
    || ',"result":' || CASE WHEN r.call_id IS NULL THEN 'null' ELSE CAST(to_json(r.content) AS VARCHAR) END || '}') AS json_md5
FROM placed c FULL JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id
"""

_OP2 = r"""
WITH sized AS (SELECT doc_id, source, coalesce(CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT), 0) AS size FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, encode(source)) AS k FROM sized GROUP BY source),
w AS (SELECT *, CASE (k - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight, 2.0::DOUBLE * source_size AS bound FROM src),
lv AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(bound) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM w WINDOW before AS (ORDER BY bound / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (SELECT k, source, source_size, CASE WHEN level * weight >= bound THEN bound ELSE weight * max(CASE WHEN level * weight < bound THEN level END) OVER () END AS target FROM lv),
g AS (SELECT *, CAST(floor(target) AS BIGINT) AS goal, CAST(ceil(source_size / 4096.0e0) AS BIGINT) AS blocks FROM goals),
n AS (SELECT *, (goal // source_size) * blocks + CAST(ceil((goal % source_size) / 4096.0e0) AS BIGINT) AS need, coalesce(sum(target) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0e0) AS lo FROM g WHERE target > 0),
whole AS (SELECT CAST(sum(need) AS BIGINT) AS slots, max(lo + target) AS top FROM n),
points AS (SELECT id, ((id + 1) * GOLDEN - floor((id + 1) * GOLDEN)) * top AS u FROM (SELECT unnest(range(slots)) AS id, top FROM whole)),
drawn AS (SELECT k, id AS slot, row_number() OVER (PARTITION BY k ORDER BY id) - 1 AS rank FROM points JOIN n ON u >= lo AND u < lo + target),
short AS (SELECT n.k, need - coalesce(c, 0) AS more, coalesce(c, 0) AS c FROM n LEFT JOIN (SELECT k, count(*) AS c FROM drawn GROUP BY k) d ON n.k = d.k WHERE need > coalesce(c, 0)),
closing AS (SELECT k, slots + coalesce(sum(more) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first, c, unnest(range(more)) AS j FROM short, whole),
every_ AS (SELECT k, slot, rank FROM drawn UNION ALL SELECT k, first + j, c + j FROM closing),
turns AS (SELECT n.k, slot, (rank % blocks) * 4096 AS b, least(4096, source_size - (rank % blocks) * 4096, goal - (rank // blocks) * source_size - (rank % blocks) * 4096) AS words FROM every_ JOIN n ON every_.k = n.k WHERE rank < need),
laid AS (SELECT sized.*, g.* EXCLUDE (source), coalesce(CAST(sum(size) OVER (PARTITION BY sized.source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS start
  FROM sized JOIN g ON sized.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, floor(target * 1e6 + 0.5) / 1e6 AS target,
  CAST(CASE WHEN source_size = 0 THEN 0 ELSE (goal // source_size) * size + greatest(0, least(start + size, goal % source_size) - start) END AS BIGINT) AS taken,
  (SELECT CAST(min(slot) AS BIGINT) FROM turns WHERE turns.k = laid.k AND greatest(start, b) < least(start + size, b + words)) AS first_slot
FROM laid
""".replace("GOLDEN", f"{mixing.GOLDEN!r}e0")

_STOPS = ", ".join("'" + w + "'" for w in rules.STOP_WORDS)
_OP10 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(length(array_to_string(w, '')), 0) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines, w FROM d),
tri AS (SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY 1),
f AS (SELECT m.doc_id, n_words, word_chars, n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
  len(lines) AS nl, len(list_filter(lines, lambda x: contains(x, '|'))) AS bars, len(list_filter(w, lambda x: lower(x) IN ({_STOPS}))) AS stops FROM m LEFT JOIN cov ON m.doc_id = cov.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND word_chars / greatest(n_words, 1) BETWEEN 2.0 AND 14.0 AND n_symbols / greatest(n_words, 1) <= 0.15
  AND n_repeat_words / greatest(n_words, 1) <= 0.5 AND n_dup_lines / greatest(nl, 1) <= 0.5 AND stops / greatest(n_words, 1) >= 0.02 AND bars / greatest(nl, 1) <= 0.6 AS kept
FROM f
"""


def oracle_sql():
    return {"op1_tool_calls": _OP1, "op2_golden_mix": _OP2, "op10_rule_projection": _OP10}
