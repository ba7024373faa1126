"""DuckDB SQL for the operators that SQL can express, over whole tables."""

from __future__ import annotations

from scholion.llm import decontamination, quality_rules, sharding

_RULES = quality_rules.RULES
_RATES = ",\n".join(f"""  CASE WHEN hosts = 0 THEN 0.0 WHEN v_{r} <= {quality_rules.FLAT} OR a_{r} * (1 - a_{r}) <= v_{r} THEN round(all_{r} / docs, 6)
    ELSE round((f_{r} + a_{r} * (a_{r} * (1 - a_{r}) / v_{r} - 1)) / (n_docs + (a_{r} * (1 - a_{r}) / v_{r} - 1)), 6) END AS rate_{r}""" for r in _RULES)

QUALITY = rf"""
WITH base AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM base),
windows AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS x FROM (
  SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
again AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, x) > 1),
repeated AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY rid),
lines AS (SELECT rid, count(*) AS n, count(DISTINCT x) AS d FROM (SELECT rid, unnest(string_split(t, chr(10))) AS x FROM base)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (SELECT base.rid, doc_id, host, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: len(x))), 0)::BIGINT AS word_chars,
    len(regexp_replace(t, '[^{quality_rules.SYMBOLS}]', '', 'g')) AS n_symbols, coalesce(lines.n - lines.d, 0) AS n_dup_lines,
    coalesce(repeated.n, 0) AS n_repeat_words, coalesce(lines.n, 0) AS n_lines
  FROM base JOIN w USING (rid) LEFT JOIN lines USING (rid) LEFT JOIN repeated USING (rid)),
ruled AS (SELECT *, n_words < {quality_rules.MIN_WORDS} AS short, 100 * n_repeat_words > {quality_rules.REPEAT_PERCENT} * n_words AS repetitive,
    100 * n_symbols > {quality_rules.SYMBOL_PERCENT} * word_chars AS symbols,
    100 * n_dup_lines > {quality_rules.DUP_LINE_PERCENT} * n_lines AS dup_lines FROM m),
sums AS (SELECT host, count(*) AS n_docs, {", ".join(f"sum({r}::INT)::BIGINT AS f_{r}" for r in _RULES)} FROM ruled GROUP BY host),
rated AS (SELECT *, {", ".join(f"round(f_{r} / n_docs, 9)::DECIMAL(10,9) AS q_{r}" for r in _RULES)} FROM sums),
moments AS (SELECT count(*) AS hosts, sum(n_docs) AS docs, {", ".join(f"sum(f_{r}) AS all_{r}, sum(q_{r})::DOUBLE / count(*) AS a_{r}, sum(q_{r}::DECIMAL(19,9) * q_{r})::DOUBLE / count(*) AS b_{r}" for r in _RULES)} FROM rated),
prior AS (SELECT *, {", ".join(f"b_{r} - a_{r} * a_{r} AS v_{r}" for r in _RULES)} FROM moments),
rates AS (SELECT host,
{_RATES}
  FROM sums, prior),
verdicts AS (SELECT host, CASE WHEN greatest({", ".join(f"rate_{r}" for r in _RULES)}) >= {quality_rules.REJECT_RATE} THEN 'reject'
    WHEN greatest({", ".join(f"rate_{r}" for r in _RULES)}) >= {quality_rules.WATCH_RATE} THEN 'watch' ELSE 'trust' END AS verdict FROM rates)
SELECT doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repetitive AS base_failed, verdict AS host_verdict,
  NOT (short OR repetitive) AND CASE verdict WHEN 'reject' THEN false WHEN 'watch' THEN NOT (symbols OR dup_lines) ELSE true END AS kept
FROM ruled JOIN verdicts USING (host)
"""


def sharded(shards: int) -> str:
    return rf"""
WITH RECURSIVE tbl AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::BIGINT, range(8)),
    lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t),
rows AS (SELECT row_number() OVER () AS rid, doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda c, b: xor(c >> 8, t[((xor(c, b) & 255) + 1)::BIGINT])), 4294967295) AS text_crc32 FROM documents, tbl),
jumps AS (
  SELECT rid, -1::BIGINT AS b, 0::BIGINT AS j, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, chr(0) || 'null')), 1, 16))::UBIGINT::HUGEINT AS key FROM rows
  UNION ALL
  SELECT rid, j, floor((j + 1) * (2147483648.0::DOUBLE / ((nxt // 8589934592) + 1)::DOUBLE))::BIGINT, nxt
  FROM (SELECT rid, j, (key * {sharding.MULTIPLIER}::HUGEINT + 1) % 18446744073709551616::HUGEINT AS nxt FROM jumps WHERE j < {shards + 1})),
placed AS (SELECT rid, max(b) FILTER (b < {shards}) AS shard, max(b) AS grown_shard FROM jumps WHERE b < {shards + 1} GROUP BY rid),
cells AS (SELECT rows.*, shard, grown_shard,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, chr(0) || 'null') || ',' || size || ',' || text_crc32), 1, 8))::BIGINT % {sharding.CELLS} AS cell
  FROM rows JOIN placed USING (rid))
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INT AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY cell, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard::INT AS grown_shard
FROM cells
"""


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{decontamination.WORD_CHARACTERS}')"
DECONTAMINATION = f"""
WITH items AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS ws FROM benchmark WHERE item_id IS NOT NULL),
windows AS (SELECT DISTINCT item, array_to_string(list_slice(ws, i, i + {decontamination.WIDTH - 1}), ' ') AS x, least(len(ws), {decontamination.WIDTH}) AS size
  FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - {decontamination.WIDTH - 1}, 1) + 1)) AS i FROM items WHERE len(ws) > 0)),
docs AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS ws FROM documents),
sizes AS (SELECT DISTINCT size FROM windows),
stretches AS (SELECT rid, size, i, array_to_string(list_slice(ws, i, i + size - 1), ' ') AS x
  FROM (SELECT rid, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM docs, sizes WHERE len(ws) >= size)),
found AS (SELECT rid, i, s.size, item FROM stretches s JOIN windows w ON s.x = w.x AND s.size = w.size),
hits AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT rid, i, size FROM found)) GROUP BY rid),
owners AS (SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid)
SELECT doc_id, len(ws) AS n_words, coalesce(hits.n, 0) AS n_hit, coalesce(owners.n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(hits.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (rid) LEFT JOIN owners USING (rid)
"""

COLLOCATIONS = r"""
WITH plain AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM plain),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces),
totals AS (SELECT lang, sum(len(ws))::HUGEINT AS n FROM words GROUP BY lang),
places AS (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM words, (VALUES (1), (2), (3), (4), (5)) AS lengths(k)),
known AS (
  SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, count(*)::HUGEINT AS f
  FROM (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM places) GROUP BY lang, k, phrase HAVING count(*) >= 100),
cuts AS (SELECT lang, phrase, ws, k, f, unnest(range(1, k)) AS cut FROM known WHERE k > 1),
scores AS (
  SELECT c.lang, c.phrase, c.f AS a, x.f AS l, y.f AS r, t.n, c.cut, (1000 * c.f * t.n) // (x.f * y.f) AS score
  FROM cuts AS c JOIN totals AS t ON t.lang = c.lang
  JOIN known AS x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:c.cut], ' ')
  JOIN known AS y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.cut + 1:], ' ')),
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
kept AS (
  SELECT * FROM best AS b WHERE NOT EXISTS (
    SELECT 1 FROM known AS o WHERE o.lang = b.lang AND o.k > len(string_split(b.phrase, ' ')) AND o.f >= b.a
    AND contains(' ' || o.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM kept QUALIFY rank <= 2000
"""
