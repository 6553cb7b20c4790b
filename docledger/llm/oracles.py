"""DuckDB statements for the operators that SQL can express in reasonable time, by query name."""

from __future__ import annotations

# Every window of 50 words as one string; a window goes if a document with a smaller id has the same one.
WORD_REPEATS = r"""
WITH words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i, len(w) AS n
  FROM (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents)),
windows AS (
  SELECT doc_id, i, n, md5(string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)) AS h
  FROM words),
firsts AS (SELECT h, min(doc_id) AS first FROM windows WHERE i + 50 <= n GROUP BY h),
hits AS (SELECT w.doc_id, w.i FROM windows w JOIN firsts f ON w.h = f.h WHERE w.i + 50 <= w.n AND f.first < w.doc_id),
marked AS (
  SELECT w.doc_id, w.i, w.word, count(h.i) OVER (PARTITION BY w.doc_id ORDER BY w.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) > 0 AS gone
  FROM words w LEFT JOIN hits h ON h.doc_id = w.doc_id AND h.i = w.i),
kept AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

MIXING = r"""
WITH sized AS (
  SELECT d.doc_id, d.source, CAST(len(regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         -ln((CAST('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656)
           / coalesce(q.weight, 1.0::DOUBLE) AS key
  FROM documents d LEFT JOIN (
    SELECT doc_id, CASE WHEN max(quality) > 0 THEN 2.0::DOUBLE WHEN max(quality) <= 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS weight
    FROM labels GROUP BY doc_id) q ON q.doc_id = d.doc_id),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][CAST(1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS INT)] AS weight
  FROM totals),
levels AS (
  SELECT *, 2.0::DOUBLE * source_size / weight AS level,
         (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0))
           / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS here
  FROM weighed
  WINDOW before AS (ORDER BY 2.0::DOUBLE * source_size / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         least(2.0::DOUBLE * source_size, weight * (SELECT arg_min(here, level) FROM levels WHERE here <= level)) AS target
  FROM levels),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS epochs FROM targets)
SELECT s.doc_id, s.size, b.source_size, b.target,
       CAST(b.epochs * s.size + greatest(0, least(s.size, CAST(floor(b.target + 0.5) AS BIGINT) - b.epochs * b.source_size
         - coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)))
         AS BIGINT) AS taken
FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
"""

_KINDS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+""",
    "access": r"AKIA[A-Z0-9]{14,}",
    "hex": r"[0-9a-f]{16,}",
    "opaque": r"[A-Za-z0-9_-]{20,}",
}
# A match's place: the lengths of the pieces before it and of the matches before it.
_MATCHES = "\nUNION ALL\n".join(
    f"""SELECT doc_id, source, '{kind}' AS kind, {rank} AS rank, m[i] AS match,
       CAST(list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS INT) AS a
FROM (SELECT doc_id, source, m, p, unnest(range(1, len(m) + 1)) AS i
      FROM (SELECT doc_id, source, regexp_extract_all(text, '{pattern}') AS m, string_split_regex(text, '{pattern}') AS p FROM documents))"""
    for rank, (kind, pattern) in enumerate(_KINDS.items(), 1)
)
SECRETS = rf"""
WITH matches AS ({_MATCHES}),
spans AS (
  SELECT *, a + length(match) AS e FROM (
    SELECT *, CASE WHEN kind = 'assign' THEN regexp_extract(match, '^[^:=]*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1) ELSE match END AS value FROM matches)
  WHERE length(value) >= 12),
owners AS (SELECT value, count(DISTINCT source) + max(CASE WHEN source IS NULL THEN 1 ELSE 0 END) AS owners FROM spans GROUP BY value),
judged AS (
  SELECT s.*, CASE WHEN o.owners >= 3 THEN 'example'
    WHEN len(list_distinct(string_split(s.value, ''))) >= 10 AND (
      CAST(regexp_matches(s.value, '[a-z]') AS INT) + CAST(regexp_matches(s.value, '[A-Z]') AS INT) + CAST(regexp_matches(s.value, '[0-9]') AS INT)
        + CAST(regexp_matches(s.value, '[^A-Za-z0-9]') AS INT) >= 3
      OR (regexp_full_match(s.value, '[0-9a-f]+') AND regexp_matches(s.value, '[0-9]') AND regexp_matches(s.value, '[a-f]'))
      OR regexp_full_match(s.value, 'AKIA[A-Z0-9]{{14,}}')) THEN 'live' ELSE 'weak' END AS verdict
  FROM spans s JOIN owners o ON o.value = s.value),
found AS (
  SELECT * FROM judged j WHERE kind <> 'opaque' OR verdict = 'live' AND NOT EXISTS (
    SELECT 1 FROM judged b WHERE b.doc_id = j.doc_id AND b.kind <> 'opaque' AND b.a < j.e AND j.a < b.e)),
listed AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
         count(*) FILTER (WHERE kind = 'hex') AS n_hex, count(*) FILTER (WHERE verdict = 'live') AS n_live, count(*) FILTER (WHERE verdict = 'example') AS n_example,
         string_agg(kind || ':' || a || ':' || e, ',' ORDER BY a, rank) FILTER (WHERE kind <> 'opaque') AS base,
         string_agg(kind || ':' || a || ':' || e, ',' ORDER BY a, rank) AS spans
  FROM found GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM documents d LEFT JOIN listed l ON l.doc_id = d.doc_id
"""

FILL_IN_MIDDLE = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
drawn AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS x, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS y,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM units),
parts AS (
  SELECT *, coalesce(array_to_string(u[1:least(x, y)], ''), '') AS p, coalesce(array_to_string(u[least(x, y) + 1:greatest(x, y)], ''), '') AS m,
         coalesce(array_to_string(u[greatest(x, y) + 1:], ''), '') AS s
  FROM drawn),
put AS (
  SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS o
  FROM parts),
marked AS (SELECT *, instr(o, '<P>') AS at_p, instr(o, '<S>') AS at_s, instr(o, '<M>') AS at_m FROM put)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(o) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN o
                WHEN 'psm' THEN substr(o, 4, at_s - 4) || substr(o, at_m + 3) || substr(o, at_s + 3, at_m - at_s - 3)
                ELSE substr(o, at_p + 3, at_m - at_p - 3) || substr(o, at_m + 3) || substr(o, 4, at_p - 4) END) AS restored_sha256
FROM marked
"""

ORACLES = {
    "op4_secret_ownership": SECRETS,
    "op9_suffix_automaton_dedup": WORD_REPEATS,
    "op10_mix_sources": MIXING,
    "op11_fill_in_middle": FILL_IN_MIDDLE,
}
