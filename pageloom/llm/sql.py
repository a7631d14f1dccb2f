"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

OP4 = rf"""
WITH base AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS text, {_WORDS} AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), spread AS (
  SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM base WHERE len(words) > 8
), grams AS (
  SELECT rid, i, array_to_string(words[i:i+7], ' ') AS g FROM spread
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM grams) WHERE n > 1
), covered AS (
  SELECT rid, count(*) AS n FROM (SELECT DISTINCT rid, i + k AS p FROM twice, range(8) AS t(k)) GROUP BY rid
), measured AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words,
    CAST(len(lines) AS BIGINT) AS n_lines,
    length(text) - length(regexp_replace(text, '[A-Za-z]', '', 'g')) AS n_letters,
    length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper,
    length(text) - length(regexp_replace(text, '!', '', 'g')) AS n_bangs,
    length(text) - length(regexp_replace(text, '[|]', '', 'g')) AS n_bars
  FROM base LEFT JOIN covered USING (rid)
), judged AS (
  SELECT *, CAST((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT
    + 4 * (10 * n_symbols > 3 * n_words)::INT + 8 * (2 * n_upper > n_letters)::INT
    + 16 * (2 * n_bangs > n_words)::INT + 32 * (4 * n_bars > n_words)::INT
    + 64 * (2 * n_dup_lines > n_lines)::INT + 128 * (word_chars > 25 * n_words)::INT
    + 256 * (2 * word_chars < 3 * n_words)::INT AS BIGINT) AS fail_bits
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits
FROM judged
"""

OP7 = rf"""
WITH RECURSIVE base AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS words FROM documents
), grams AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i+4], ' ') AS g
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM base WHERE len(words) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM grams x JOIN grams y USING (g)
    WHERE x.doc_id <> y.doc_id GROUP BY ALL
  ) JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE 100 * o >= 75 * (s.n + t.n - o)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM base
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)
"""


OP3 = rf"""
WITH copies AS (
  SELECT source, lang, text, doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS later FROM documents
), kept AS (
  SELECT source, lang, translate(coalesce(text, ''), '#*$%&|<>', '') AS text FROM copies WHERE NOT later
)
SELECT source, lang, 'words-1' AS tokenizer, count(*) AS docs,
  CAST(sum(len({_WORDS})) AS BIGINT) AS tokens FROM kept GROUP BY ALL
UNION ALL
SELECT source, lang, 'characters-1', count(*), CAST(sum(length(text)) AS BIGINT) FROM kept GROUP BY ALL
"""

# The pages given hold one article each, in its own element; the operator does not rely on it.
_ARTICLE = "regexp_extract(coalesce(html, ''), '(?is)<article[^>]*>(.*?)</article>', 1)"
_BLOCKS = f"regexp_replace({_ARTICLE}, '(?i)</?(p|h1|br)\\b[^>]*>', ' ', 'g')"
_PLAIN = f"regexp_replace({_BLOCKS}, '<[^>]*>', '', 'g')"
for _name, _char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
    _PLAIN = f"replace({_PLAIN}, '&{_name};', '{_char}')"

OP11 = rf"""
WITH texts AS (
  SELECT page_id, url, trim(regexp_replace({_PLAIN}, '[\s\x0B\x1C-\x1F\x{{85}}\pZ]+', ' ', 'g')) AS text FROM pages
)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM texts
"""

_UNITS = "regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]')"
_DIGEST = "sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), ''))"


def _number(i: int) -> str:
    return f"CAST('0x' || substr(h, {8 * i + 1}, 8) AS BIGINT)"


OP12 = rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text, {_UNITS} AS units, {_DIGEST} AS h FROM documents
), cut AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n,
    least({_number(0)} % (len(units) + 1), {_number(1)} % (len(units) + 1)) AS a,
    greatest({_number(0)} % (len(units) + 1), {_number(1)} % (len(units) + 1)) AS b
  FROM base
), parts AS (
  SELECT doc_id, n, text,
    CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR {_number(2)} % 100 >= 90 THEN 'plain'
      WHEN {_number(3)} % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
    array_to_string(units[b + 1:], '') AS suffix
  FROM cut
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""

# CRC-32 of a decimal number's digits, bit by bit.
_CRC = """xor(4294967295, list_reduce(
    list_transform(range(1, len(CAST(conv_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(conv_id AS VARCHAR), i, 1)) AS BIGINT)),
    lambda c, y: list_reduce(range(8), lambda x, k: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END), xor(c, y)),
    CAST(4294967295 AS BIGINT)))"""

OP13 = rf"""
WITH named AS (
  SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
    sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS name
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({{'name': name, 'chars': chars}} ORDER BY turn NULLS FIRST) AS turns
  FROM named GROUP BY conv_id
), rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns, [])[1:h], o.turns[h + 1:]) AS turns
  FROM (SELECT *, {_CRC} % 6 AS h FROM own) o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100
), paths AS (
  SELECT conv_id, d, len(turns) AS size, coalesce(turns[d].chars, 0) AS chars,
    array_to_string(list_transform(turns[1:d], lambda x: x.name), ',') AS key,
    array_to_string(list_transform(turns[1:d - 1], lambda x: x.name), ',') AS up
  FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT key, d, min(conv_id) AS conv_id, count(*) AS n_convs, min(up) AS up, min(chars) AS chars,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = d), '') AS ends
  FROM paths GROUP BY key, d
), children AS (
  SELECT up, count(*) AS n FROM nodes WHERE d > 0 GROUP BY up
), full_nodes AS (
  SELECT x.*, coalesce(c.n, 0) AS n_children FROM nodes x LEFT JOIN children c ON c.up = x.key
), sums AS (
  SELECT p.key, count(*) FILTER (x.n_children = 0) AS n_leaves,
    CAST(sum((x.n_convs - 1) * x.chars) AS BIGINT) AS saved_tokens
  FROM full_nodes x JOIN paths p ON p.conv_id = x.conv_id AND p.d <= x.d GROUP BY p.key
)
SELECT x.conv_id, CAST(x.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, x.n_convs, x.n_children,
  n_leaves, saved_tokens, sha256(x.ends) AS ends_sha256
FROM full_nodes x JOIN sums USING (key) LEFT JOIN nodes u ON u.key = x.up AND u.d = x.d - 1
"""


def all_queries() -> dict[str, str]:
    return {
        "op3_token_rollup": OP3,
        "op4_quality_ledger": OP4,
        "op7_similar_components": OP7,
        "op11_main_text": OP11,
        "op12_fill_in_middle": OP12,
        "op13_prefix_trie": OP13,
    }
