"""DuckDB SQL with the rows of those queries that SQL can express."""

_MEASURES = r"""
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT r, doc_id, text,
    list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM docs),
grams AS (
  SELECT r, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM split WHERE len(words) >= 3)),
often AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM grams) WHERE n > 1),
repeated AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM often) GROUP BY r),
measures AS (
  SELECT split.r, doc_id, text,
    len(words)::BIGINT AS n_words,
    length(array_to_string(words, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    length(regexp_replace(array_to_string(words, ''), '[^A-Z]', '', 'g'))::BIGINT AS n_upper,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(repeated.n, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN repeated ON repeated.r = split.r),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
      + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_upper > word_chars THEN 8 ELSE 0 END
      + CASE WHEN 2 * n_dup_lines > (SELECT len(lines) FROM split s WHERE s.r = measures.r) THEN 16 ELSE 0 END
      + CASE WHEN word_chars > 40 * n_words THEN 32 ELSE 0 END + CASE WHEN word_chars < 2 * n_words THEN 64 ELSE 0 END)::BIGINT AS failed
  FROM measures)
"""

_QUALITY = f"""
WITH {_MEASURES}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  failed & (1 + 2 + 4 + 8 + 32 + 64) = 0 AS kept, failed, failed = 0 AS kept_strict, sole_rule,
  CASE WHEN sole_rule IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY sole_rule) END AS sole_rule_docs
FROM (SELECT *, CASE failed & (1 + 2 + 4 + 8 + 32 + 64) WHEN 1 THEN 'few_words' WHEN 2 THEN 'repeated_words' WHEN 4 THEN 'symbols' WHEN 8 THEN 'upper_case'
  WHEN 32 THEN 'long_words' WHEN 64 THEN 'short_words' END AS sole_rule FROM judged)
"""

_URLS = r"""
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS url,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
rules(rule_host, rule_path, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
numbered AS (SELECT row_number() OVER () AS r, * FROM parts),
fitting AS (
  SELECT r, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM numbered JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY r)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN regexp_matches(
    translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '://([^/?#]*\.)?(spam-farm|cheap-pills|free-bets)\.|://([^/?#]*[.-])?(casino|poker|jackpot|lottery|betting|pills|payday|replica|escort|adult|xxx|warez|torrent|keygen|crack)[.-]|://[^/?#]*/(user|account)/login\b|/calendar/[0-9]{4}/[0-9]{2}/') THEN 'block' ELSE 'allow' END) AS verdict
FROM numbered LEFT JOIN fitting USING (r)
"""

_WARC = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((
    (((instr('0123456789abcdef', substr(hex, 1 + (5 * i) // 4, 1)) - 1) * 16
      + CASE WHEN (5 * i) // 4 + 2 <= 40 THEN instr('0123456789abcdef', substr(hex, 2 + (5 * i) // 4, 1)) - 1 ELSE 0 END)
    >> (3 - (5 * i) % 4)) & 31))::INTEGER, 1)), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to,
  true AS digest_ok
FROM payloads
"""

ORACLE_SQL = {"op4_quality_rules": _QUALITY, "op5_url_rules": _URLS, "op9_warc": _WARC}
