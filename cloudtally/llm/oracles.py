"""What the queries return, as DuckDB SQL."""

from __future__ import annotations

from cloudtally.llm import pfair_mix, rule_ledger

OP7 = r"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), t AS (
  SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss,
    8 + length(role) + 1 + length(text) + 8 + length(text) - length(replace(text, '\', ''))
      + len(regexp_extract_all(text, '<\||</?s>|\[/?INST\]')) AS n
  FROM m
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(length(loss)) AS BIGINT) AS loss_chars,
  sha256(string_agg(loss, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

OP10 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS key,
    row_number() OVER (PARTITION BY source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id) - 1 AS number
  FROM documents
), b AS (
  SELECT *, number // {pfair_mix.BLOCK_DOCS} AS block, number % {pfair_mix.BLOCK_DOCS} AS place FROM d
), s AS (
  SELECT key, sqrt(count(*)) AS w, max(block) + 1 AS blocks, row_number() OVER (ORDER BY key) - 1 AS i FROM b GROUP BY key
), f AS (
  SELECT key, i, blocks, CAST(round(w / (SELECT max(w) FROM s) * {pfair_mix.FINE}) AS BIGINT) AS fine FROM s
), g AS (
  SELECT key, i, blocks, greatest(fine, (SELECT CAST(sum(fine) AS BIGINT) FROM f) // {pfair_mix.PERIOD} + 1) AS fine FROM f
), a AS (
  SELECT list(fine ORDER BY i) AS us, CAST(sum(fine) AS BIGINT) AS total FROM g
), h AS (
  SELECT least(max((blocks * total + fine - 1) // fine),
    greatest({pfair_mix.PERIOD}, max((total + fine - 1) // fine))) AS slots FROM g, a
), e AS (
  SELECT 0 AS t, list_transform(us, lambda x: 0) AS done, CAST(-1 AS BIGINT) AS pick FROM a
  UNION ALL
  SELECT t + 1, list_transform(done, lambda d, j: CASE WHEN j - 1 = p THEN d + 1 ELSE d END), p
  FROM (
    SELECT t, done, list_min(list_transform(range(len(us)), lambda j: CASE
      WHEN (done[j + 1] * total) // us[j + 1] <= t
      THEN (((done[j + 1] + 1) * total + us[j + 1] - 1) // us[j + 1]) * 1000000 + j END)) % 1000000 AS p
    FROM e, a
  ) WHERE t < (SELECT slots FROM h)
), x AS (
  SELECT g.key, e.t - 1 AS slot, row_number() OVER (PARTITION BY g.i ORDER BY e.t) - 1 AS unit,
    count(*) OVER (PARTITION BY g.i) AS units
  FROM e JOIN g ON g.i = e.pick
), y AS (
  SELECT DISTINCT key, units FROM x
)
SELECT doc_id, source, block, place, block // y.units * slots + x.unit * total // fine AS release,
  block // y.units * slots + ((x.unit + 1) * total + fine - 1) // fine AS deadline, block // y.units * slots + x.slot AS slot
FROM b JOIN g USING (key) JOIN y USING (key) JOIN x ON x.key = b.key AND x.unit = block % y.units, a, h
"""

OP5 = r"""
WITH l AS (
  SELECT doc_id, unnest(x) AS line, generate_subscripts(x, 1) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)
), f AS (
  SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p,
    strlen(line) AS n
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), v AS (
  SELECT doc_id, p, line AS a, lead(line) OVER d AS b, lead(line, 2) OVER d AS c, lead(line, 3) OVER d AS x,
    lead(line, 4) OVER d AS y, lag(line) OVER d AS l1, lag(line, 2) OVER d AS l2,
    CASE WHEN n >= 200 THEN 1 WHEN n + lead(n) OVER d >= 200 THEN 2 WHEN lead(n, 2) OVER d IS NOT NULL THEN 3 END AS size
  FROM f WINDOW d AS (PARTITION BY doc_id ORDER BY p)
), w AS (
  SELECT doc_id, p, size, l1, l2, CASE size WHEN 1 THEN [a] WHEN 2 THEN [a, b] ELSE [a, b, c] END AS lines,
    CASE size WHEN 1 THEN b WHEN 2 THEN c ELSE x END AS r1, CASE size WHEN 1 THEN c WHEN 2 THEN x ELSE y END AS r2
  FROM v WHERE size IS NOT NULL
), g AS (
  SELECT *, row_number() OVER o AS nth, first_value({'l1': l1, 'l2': l2, 'r1': r1, 'r2': r2}) OVER o AS o
  FROM w WINDOW o AS (PARTITION BY lines ORDER BY doc_id, p)
), m AS (
  SELECT doc_id, p - CASE WHEN l1 = o.l1 THEN CASE WHEN l2 = o.l2 THEN 2 ELSE 1 END ELSE 0 END AS first_line,
    p + size + CASE WHEN r1 = o.r1 THEN CASE WHEN r2 = o.r2 THEN 2 ELSE 1 END ELSE 0 END AS past
  FROM g WHERE nth > 1
), r AS (
  SELECT DISTINCT doc_id, unnest(range(first_line, past)) AS p FROM m
), e AS (
  SELECT doc_id, count(*) AS n_removed,
    count(*) FILTER (NOT EXISTS (SELECT 1 FROM r AS q WHERE q.doc_id = r.doc_id AND q.p = r.p - 1)) AS n_runs
  FROM r GROUP BY doc_id
), k AS (
  SELECT l.doc_id, count(*) AS n_lines,
    coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (r.p IS NULL), '') AS kept
  FROM l LEFT JOIN f USING (doc_id, i) LEFT JOIN r ON r.doc_id = f.doc_id AND r.p = f.p GROUP BY l.doc_id
)
SELECT k.doc_id, n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_runs, 0) AS n_runs, sha256(kept) AS kept_sha256
FROM k LEFT JOIN e USING (doc_id)
"""

OP2 = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), w AS (
  SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, unnest(list_transform(range(1, len(ws) - 1),
    lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS win FROM t
), r AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM (SELECT doc_id, i FROM w QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1), (VALUES (0), (1), (2)) AS v(k)
  GROUP BY doc_id
), m AS (
  SELECT t.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(r.n, 0) AS n_repeat_words, len(lines) AS n_lines, len(regexp_extract_all(text, '[A-Z]')) AS n_upper,
    len(regexp_extract_all(text, '[A-Za-z]')) AS n_letters
  FROM t LEFT JOIN r ON r.doc_id = t.doc_id
), b AS (
  SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words AND n_symbols >= 20 THEN 4 ELSE 0 END
    + CASE WHEN n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN n_letters >= 100 AND 100 * n_upper > 60 * n_letters THEN 16 ELSE 0 END
    + CASE WHEN word_chars > 20 * n_words OR word_chars < 2 * n_words THEN 32 ELSE 0 END AS fail_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits & 3 <> 0 AS base_failed,
  fail_bits & 7 = 0 AS kept, CAST(fail_bits AS BIGINT) AS fail_bits
FROM b
"""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP8 = rf"""
WITH items AS (
  SELECT item_id, {_WORDS} AS ws FROM benchmark
), wins AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS size, unnest(list_transform(range(1, len(ws) - least(13, len(ws)) + 2),
    lambda i: array_to_string(ws[i : i + least(13, len(ws)) - 1], ' '))) AS win
  FROM items WHERE len(ws) > 0
), docs AS (
  SELECT doc_id, {_WORDS} AS ws FROM documents
), places AS (
  SELECT doc_id, size, unnest(range(1, len(ws) - size + 2)) AS i,
    unnest(list_transform(range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i : i + size - 1], ' '))) AS win
  FROM docs, (SELECT DISTINCT size FROM wins) WHERE len(ws) >= size
), hits AS (
  SELECT doc_id, item_id, i, places.size FROM places JOIN wins ON wins.win = places.win AND wins.size = places.size
), words AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS word FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT docs.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(ws) AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""

OP12 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
    CAST(list_sum(list_transform(generate_series(1, len(a.e)), lambda i: a.e[i] * r.e[i])) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""

_RULES = ", ".join(
    f"('{version}', '{rule.name}', {1 << rule.bit}, {rule_ledger.mask_of(policy)})"
    for version, policy in rule_ledger.POLICIES.items()
    for rule in rule_ledger.RULES
    if rule.name in policy
)
OP2_ABLATION = f"""
WITH l AS ({OP2}), r(policy, rule, bit, mask) AS (VALUES {_RULES})
SELECT policy, rule,
  CAST(count(*) FILTER (fail_bits & bit <> 0) AS BIGINT) AS n_failed,
  CAST(count(*) FILTER (fail_bits & mask = bit) AS BIGINT) AS n_failed_alone,
  CAST(count(*) FILTER (fail_bits & (mask - bit) = 0) AS BIGINT) AS n_kept_without,
  bit_or(fail_bits & mask) AS any_bits
FROM l, r GROUP BY policy, rule
"""
