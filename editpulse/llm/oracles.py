"""The same queries in DuckDB's SQL, where SQL can express them at bearable cost."""

from __future__ import annotations

# A CRC-32 of each text's UTF-8 bytes, a byte at a time; the table's entries come from the polynomial.
_CRC = """
crc_step(n, k, v) AS (
  SELECT n, 0, n::BIGINT FROM range(256) t(n)
  UNION ALL SELECT n, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc_step WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY n) AS t FROM crc_step WHERE k = 8),
hexed AS (SELECT doc_id, source, text, hex(encode(coalesce(text, ''))) AS h FROM documents),
bytes AS (
  SELECT doc_id, source, text, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) AS b FROM hexed),
summed AS (
  SELECT doc_id, source, coalesce(strlen(text), 0) + 1 AS size,
    xor(4294967295, list_reduce(b, lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]), 4294967295)) AS text_crc32
  FROM bytes, crc_table)"""

_OP1 = f"""
WITH RECURSIVE {_CRC},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('20240229-' || coalesce(doc_id::VARCHAR, ''))) AS r,
    count(*) OVER (PARTITION BY source) AS n FROM summed),
placed AS (
  SELECT *, row_number() OVER (ORDER BY (2 * r - 1) / (2 * n)::DOUBLE, coalesce('=' || source, ''), r) - 1 AS p, count(*) OVER () AS rows FROM ranked)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, (p * 16 // rows)::INTEGER AS shard,
  (p - ((p * 16 // rows) * rows + 15) // 16)::BIGINT AS slot, NULL::INTEGER AS grown_shard, source
FROM placed"""

_OP4 = r"""
WITH captures AS (
  SELECT page_id, url, (TIMESTAMP '2024-01-01' + to_seconds((page_id * 7919 * 613) % (366 * 86400))) AS fetch_time,
    rtrim(lower(regexp_extract(coalesce(url, ''), '^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?([^?#]*)', 1)), '.') AS host,
    regexp_extract(coalesce(url, ''), '^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?([^?#]*)', 2) AS path
  FROM pages),
split AS (
  SELECT *, regexp_extract(path, '^/([^/]+)', 1) AS segment, regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) AS site,
    string_split(host, '.') AS labels FROM captures),
named AS (
  SELECT DISTINCT site AS entry, list FROM split, (VALUES ('adult'), ('spam')) l(list) WHERE site <> ''
  UNION ALL SELECT DISTINCT site || '/' || segment, 'sections' FROM split WHERE site <> '' AND segment <> ''),
drawn AS (
  SELECT *, list_transform(range(4), lambda i: ('0x' || substr(md5(list || '|' || entry), (4 * i + 1)::BIGINT, 4))::BIGINT) AS d FROM named),
days AS (
  SELECT list, entry, d[2] % 366 AS a, d[2] % 366 + 1 + d[3] % 120 AS b, d[2] % 366 + 1 + d[3] % 120 + 1 + d[4] % 120 AS c
  FROM drawn WHERE d[1] % 8 = 0),
intervals AS (
  SELECT list, entry, TIMESTAMP '2024-01-01' + to_days(a::INTEGER) AS f, TIMESTAMP '2024-01-01' + to_days(b::INTEGER) AS u FROM days
  UNION ALL SELECT list, entry, TIMESTAMP '2024-01-01' + to_days(c::INTEGER), TIMESTAMP '9999-12-31' FROM days),
below AS (
  SELECT page_id, url, fetch_time, segment,
    unnest(CASE WHEN host = '' THEN [] ELSE list_transform(range(1, len(labels) + 1), lambda i: array_to_string(labels[i:], '.')) END) AS suffix FROM split),
candidates AS (
  SELECT page_id, url, fetch_time, suffix AS entry FROM below
  UNION ALL SELECT page_id, url, fetch_time, suffix || '/' || segment FROM below WHERE segment <> ''),
met AS (
  SELECT page_id, list, entry, f FROM candidates JOIN intervals USING (entry) WHERE fetch_time >= f AND fetch_time < u),
summed AS (
  SELECT page_id, count(*) AS n_active, array_to_string(list_sort(list(DISTINCT list)), ',') AS lists,
    arg_min(entry, (f, entry)) AS first_entry FROM met GROUP BY page_id)
SELECT page_id, url, fetch_time, host, 1::BIGINT AS copies, coalesce(n_active, 0) AS n_active, coalesce(lists, '') AS lists, first_entry,
  coalesce(n_active, 0) > 0 AS blocked
FROM split LEFT JOIN summed USING (page_id)"""

_RULES = (
    "n_words < 10", "100 * n_repeat_words > 20 * n_words", "100 * n_symbols > 10 * word_chars",
    "n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines", "n_lines >= 4 AND 100 * dup_line_chars > 30 * n_chars_all",
    "n_words >= 10 AND 100 * n_upper > 50 * word_chars", "n_words >= 10 AND 100 * n_shouts > 30 * n_words",
    "n_words >= 10 AND word_chars < 2 * n_words", "word_chars > 20 * n_words", "longest_word > 1000",
)
_RULE_NAMES = (
    "few_words", "repeated_windows", "symbols", "duplicate_lines", "duplicate_line_text", "upper_case", "exclamations", "short_words", "long_words", "endless_word",
)
_ONLY = " ".join(f"WHEN {1 << place} THEN '{name}'" for place, name in enumerate(_RULE_NAMES))
_BITS = " + ".join(f"CASE WHEN {rule} THEN {1 << place} ELSE 0 END" for place, rule in enumerate(_RULES))

_OP6 = rf"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 3)) AS place, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS five
  FROM texts WHERE len(w) >= 5),
again AS (SELECT doc_id, place, count(*) OVER (PARTITION BY doc_id, five) AS n FROM windows),
covered AS (
  SELECT doc_id, count(DISTINCT word) AS n_repeat_words FROM (SELECT doc_id, unnest(range(place, place + 5)) AS word FROM again WHERE n > 1) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts),
line_counts AS (
  SELECT doc_id, line, count(*) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line),
line_sums AS (
  SELECT doc_id, sum(n)::BIGINT AS n_lines, sum(n - 1)::BIGINT AS n_dup_lines, sum((n - 1) * length(line))::BIGINT AS dup_line_chars FROM line_counts GROUP BY doc_id),
measured AS (
  SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines, coalesce(dup_line_chars, 0) AS dup_line_chars, length(text) AS n_chars_all,
    len(regexp_extract_all(text, '\p{{Lu}}')) AS n_upper, len(regexp_extract_all(text, '!')) AS n_shouts,
    coalesce(list_max(list_transform(w, lambda x: length(x))), 0) AS longest_word
  FROM texts LEFT JOIN covered USING (doc_id) LEFT JOIN line_sums USING (doc_id)),
judged AS (SELECT *, ({_BITS})::BIGINT AS failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed,
  failed & 127 = 0 AS kept_v2, count(*) OVER (PARTITION BY failed) AS n_pattern, CASE failed {_ONLY} END AS only_rule FROM judged"""

_OP11 = rf"""
WITH RECURSIVE crc_step(n, k, v) AS (
  SELECT n, 0, n::BIGINT FROM range(256) t(n)
  UNION ALL SELECT n, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc_step WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY n) AS t FROM crc_step WHERE k = 8),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
drawn AS (
  SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(list_transform(range(1, length(k) + 1), lambda i: ascii(substr(k, i, 1))::BIGINT),
    lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]), 4294967295)) % 20 AS d FROM keyed, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
    CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE d WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM drawn),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, substr(role, 1, 1) AS r FROM ordered),
judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'b' WHEN again THEN 'd' WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 't' ELSE '' END AS f,
    lag(r) OVER (PARTITION BY conv_id ORDER BY i) AS q FROM placed),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 'b') AS blank, count(*) FILTER (f = 'd') AS duplicate,
    count(*) FILTER (f = 't') AS truncated, count(*) FILTER (i > 1 AND q || r NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM judged GROUP BY conv_id),
heads AS (SELECT DISTINCT conv_id FROM conversations),
-- States of a repaired prefix, each the least (cost, audit): nothing kept, after a system turn, after a user's, after an assistant's.
walk(conv_id, i, nothing, sys, usr, asst) AS (
  SELECT conv_id, 0::BIGINT, {{'c': 0, 'a': ''}}, {{'c': 99999999, 'a': ''}}, {{'c': 2, 'a': 'I'}}, {{'c': 4, 'a': 'II'}} FROM heads
  UNION ALL
  SELECT conv_id, i, nothing, sys, usr, list_min([asst, {{'c': usr.c + 2, 'a': usr.a || 'I'}}])
  FROM (
    SELECT conv_id, i, nothing, sys, asst,
      list_min([usr, {{'c': nothing.c + 2, 'a': nothing.a || 'I'}}, {{'c': sys.c + 2, 'a': sys.a || 'I'}}, {{'c': asst.c + 2, 'a': asst.a || 'I'}}]) AS usr
    FROM (
      SELECT w.conv_id, j.i, {{'c': w.nothing.c + 3, 'a': w.nothing.a || 'D'}} AS nothing,
        list_min([{{'c': w.sys.c + 3, 'a': w.sys.a || 'D'}}, {{'c': w.nothing.c + CASE WHEN j.f IN ('b', 'd') OR j.r <> 's' THEN 99999999 WHEN j.f = 't' THEN 1 ELSE 0 END, 'a': w.nothing.a || 'K'}}]) AS sys,
        list_min([{{'c': w.usr.c + 3, 'a': w.usr.a || 'D'}}]
          || list_transform([w.nothing, w.sys, w.asst], lambda x: {{'c': x.c + CASE WHEN j.f IN ('b', 'd') THEN 99999999 WHEN j.f = 't' THEN 1 ELSE 0 END + CASE WHEN j.r = 'u' THEN 0 ELSE 2 END,
            'a': x.a || CASE WHEN j.r = 'u' THEN 'K' ELSE 'R' END}})) AS usr,
        list_min([{{'c': w.asst.c + 3, 'a': w.asst.a || 'D'}},
          {{'c': w.usr.c + CASE WHEN j.f IN ('b', 'd') THEN 99999999 WHEN j.f = 't' THEN 1 ELSE 0 END + CASE WHEN j.r = 'a' THEN 0 ELSE 2 END,
            'a': w.usr.a || CASE WHEN j.r = 'a' THEN 'K' ELSE 'R' END}}]) AS asst
      FROM walk w JOIN judged j ON w.conv_id IS NOT DISTINCT FROM j.conv_id AND j.i = w.i + 1))),
ended AS (
  SELECT w.conv_id, list_min([w.nothing, w.asst]) AS best FROM walk w LEFT JOIN counted c ON w.conv_id IS NOT DISTINCT FROM c.conv_id WHERE w.i = coalesce(c.n, 0)),
edits AS (
  SELECT conv_id, best.a AS audit, unnest(range(1, length(best.a) + 1)) AS p FROM ended),
steps AS (
  SELECT conv_id, p, substr(audit, p, 1) AS e, count(*) FILTER (substr(audit, p, 1) <> 'I') OVER o AS i, count(*) FILTER (substr(audit, p, 1) <> 'D') OVER o AS k
  FROM edits WINDOW o AS (PARTITION BY conv_id ORDER BY p)),
kept AS (
  SELECT s.*, j.role, j.text, bool_or(s.e = 'K' AND s.k = 1 AND j.r = 's') OVER (PARTITION BY s.conv_id) AS led
  FROM steps s LEFT JOIN judged j ON s.conv_id IS NOT DISTINCT FROM j.conv_id AND s.i = j.i WHERE s.e <> 'D'),
texts AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (k + CASE WHEN led THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS whole
  FROM kept GROUP BY conv_id)
SELECT h.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, best.c::BIGINT AS cost, best.a AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM heads h LEFT JOIN counted c ON h.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ended d ON h.conv_id IS NOT DISTINCT FROM d.conv_id
  LEFT JOIN texts t ON h.conv_id IS NOT DISTINCT FROM t.conv_id"""

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_OP12 = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS w FROM documents),
total AS (SELECT count(*) FILTER (len(w) > 0)::BIGINT AS n_docs, greatest(1, coalesce(sum(len(w)), 0))::BIGINT AS n_terms FROM docs),
held AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM docs) GROUP BY r, term),
wanted AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY item_id, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS weight
  FROM (SELECT term, count(*) AS df FROM held SEMI JOIN wanted USING (term) GROUP BY term), total),
gains AS (
  SELECT item_id, r, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(w) * n_docs) // n_terms)))) AS score
  FROM wanted JOIN weights USING (term) JOIN held USING (term) JOIN docs USING (r), total GROUP BY item_id, r),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST, r)::INTEGER AS rank, doc_id, score::BIGINT AS score
  FROM gains JOIN docs USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20"""


def oracle_sql() -> dict[str, str]:
    return {"op1_interleaved_shards": _OP1, "op4_url_lists": _OP4, "op6_rule_ledger": _OP6, "op11_conversation_repair": _OP11, "op12_lexical_search": _OP12}
