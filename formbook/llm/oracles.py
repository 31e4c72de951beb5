"""DuckDB SQL of the registered queries, where SQL can express them."""

WORDS = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, v.turn, v.role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)
), sized AS (
  SELECT *, len(regexp_extract_all(text, '{WORDS}')) + 4 AS tokens,
    length(replace(replace(role, '\', '\s'), '<|', '\l')) + length(replace(replace(text, '\', '\s'), '<|', '\l'))
      + length('<|turn|><|text|><|end|>') AS chars,
    row_number() OVER o = 1 AND role = 'system' AS head
  FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text)
), headed AS (
  SELECT *, max(CASE WHEN head THEN tokens ELSE 0 END) OVER c AS sys_tokens, max(CASE WHEN head THEN chars ELSE 0 END) OVER c AS sys_chars
  FROM sized WINDOW c AS (PARTITION BY conv_id)
), started AS (
  SELECT *, greatest(384 - sys_tokens, 128) AS stride,
    CASE WHEN head THEN -1 ELSE coalesce(sum(tokens) OVER (
      PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - sys_tokens END AS start
  FROM headed
), spanned AS (
  SELECT *, CASE WHEN NOT head THEN 2 * (start // stride) + CASE WHEN start // stride = (start + tokens - 1) // stride THEN 0 ELSE 1 END END AS key
  FROM started
), keyed AS (
  SELECT *, coalesce(key, lead(key) OVER (PARTITION BY conv_id ORDER BY start), 0) AS span FROM spanned
), opened AS (
  SELECT conv_id, span, min(start) AS start, bool_or(head) AS head, max(sys_chars) AS sys_chars FROM keyed GROUP BY ALL
), past AS (
  SELECT o.conv_id, o.span, any_value(o.sys_chars) + coalesce(sum(k.chars), 0) AS chars
  FROM opened o LEFT JOIN keyed k
    ON k.conv_id IS NOT DISTINCT FROM o.conv_id AND NOT k.head AND k.start >= o.start - 128 AND k.start < o.start
  WHERE NOT o.head GROUP BY ALL
), totals AS (
  SELECT conv_id, sum(chars) AS chars FROM (SELECT conv_id, chars FROM keyed UNION ALL SELECT conv_id, chars FROM past) GROUP BY ALL
), read AS (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256
  FROM t GROUP BY conv_id
)
SELECT r.*, t.chars::BIGINT AS formatted_chars FROM read r JOIN totals t ON r.conv_id IS NOT DISTINCT FROM t.conv_id
"""

OP4 = rf"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS ws FROM documents
), starts AS (
  SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS a, unnest(ws[2:]) AS b, unnest(ws[3:]) AS c FROM w
), tri AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM starts WHERE c IS NOT NULL
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM tri, (VALUES (0), (1), (2)) v(k) WHERE n > 1 GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(line) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w) WHERE regexp_matches(line, '{WORDS}') GROUP BY doc_id
), stats AS (
  SELECT doc_id, source, len(ws) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)
), base AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM stats
), hosts AS (
  SELECT source, count(*)::DOUBLE AS n, count(*) FILTER (base_failed) AS failed FROM base WHERE source IS NOT NULL GROUP BY source
), fit AS (
  SELECT sum(failed) / sum(n) AS mean, sum(failed * failed / n) / sum(n) AS square, count(*) / sum(n) AS share FROM hosts
), prior AS (
  SELECT mean, square - mean * mean - share * mean * (1 - mean) AS between_hosts FROM fit
), strong AS (
  SELECT mean, between_hosts, CASE WHEN between_hosts > 0 THEN greatest(mean * (1 - mean) / between_hosts - 1, 0) END AS strength FROM prior
), rates AS (
  SELECT source, CASE WHEN mean IN (0, 1) OR between_hosts <= 0 THEN mean ELSE (failed + strength * mean) / (n + strength) END AS rate FROM hosts, strong
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(rate <= 0.5, TRUE) AS kept
FROM base LEFT JOIN rates USING (source)
"""

ORACLES = {"op1_chat_format": OP1, "op4_quality_rules": OP4}
