"""DuckDB SQL for the operators that SQL can express, by meaning and not by method."""

from __future__ import annotations

ORACLES: dict[str, str] = {}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES["op1_decontaminate"] = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
item_windows AS (
  SELECT item_id, n, array_to_string(w[i + 1 : i + n], ' ') AS win
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(0, len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS i FROM d JOIN sizes ON len(w) >= n)),
hits AS (SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (n, win)),
points AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)),
h AS (SELECT doc_id, count(*) AS n_hit FROM points GROUP BY doc_id),
names AS (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits),
m AS (SELECT doc_id, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM names GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN m USING (doc_id)
"""

ORACLES["op3_url_filter"] = rf"""
WITH p AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(rule, verdict, own, start) AS (VALUES
  ('net/', 'block', 'net', '/'), ('example.net/en/', 'allow', 'example.net', '/en/'),
  ('example.com/de/', 'block', 'example.com', '/de/'), ('org/fr/', 'allow', 'org', '/fr/')),
fit AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM h JOIN r ON ('.' || host) LIKE ('%.' || own) AND starts_with(path, start) GROUP BY page_id)
SELECT h.page_id, host, path, rule, coalesce(verdict, CASE WHEN len(list_intersect(
    regexp_split_to_array(host, '[.-]'), ['casino', 'pills', 'bets', 'win', 'adult', 'xxx', 'loan', 'viagra'])) > 0
  THEN 'block' ELSE 'allow' END) AS verdict
FROM h LEFT JOIN fit USING (page_id)
"""


def _place(kind: str, pattern: str, check: str) -> str:
    """Matches of a pattern with their places, from the pieces between them."""
    return f"""
  SELECT doc_id, '{kind}' AS kind, s, a, a + length(s) AS b FROM (
    SELECT doc_id, unnest(found) AS s, unnest(list_transform(range(1, len(found) + 1), lambda i:
      list_sum(list_transform(pieces[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0))) AS a
    FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS found, string_split_regex(t, '{pattern}') AS pieces FROM d))
  WHERE {check}"""


_DIGITS = "regexp_replace(s, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: CASE WHEN i % 2 = 1
  THEN CAST(substr(reverse({_DIGITS}), i, 1) AS INT) ELSE CAST(substr('0246813579', CAST(substr(reverse({_DIGITS}), i, 1) AS INT) + 1, 1) AS INT) END)) % 10 = 0"""
_TIGHT = "replace(s, ' ', '')"
_MOD97 = f"""list_reduce(list_concat([0::HUGEINT], list_transform(string_split(substr({_TIGHT}, 5) || substr({_TIGHT}, 1, 4), ''),
  lambda c: CAST(CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END AS HUGEINT))),
  lambda x, y: CASE WHEN y < 10 THEN (x * 10 + y) % 97 ELSE (x * 100 + y) % 97 END) = 1"""

ORACLES["op9_pii"] = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
email AS ({_place("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true")}),
ip AS ({_place("ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "list_bool_and(list_transform(string_split(s, '.'), lambda x: coalesce(try_cast(x AS HUGEINT) <= 255, false)))")}),
card AS ({_place("card", r"[0-9](?:[\x20-]?[0-9])+", f"length({_DIGITS}) BETWEEN 13 AND 19 AND {_LUHN}")}),
phone AS ({_place("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15")}),
iban AS ({_place("iban", r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}\b", f"length({_TIGHT}) BETWEEN 15 AND 34 AND {_MOD97}")}),
spans AS (
  SELECT 1 AS k, * FROM email UNION ALL SELECT 2, * FROM ip UNION ALL SELECT 3, * FROM card
  UNION ALL SELECT 4, * FROM phone UNION ALL SELECT 5, * FROM iban),
s AS (
  SELECT doc_id, count(*) FILTER (k = 1) AS n_email, count(*) FILTER (k = 2) AS n_ip, count(*) FILTER (k = 3) AS n_card,
    count(*) FILTER (k = 4) AS n_phone,
    string_agg(kind || ':' || CAST(a AS BIGINT) || ':' || CAST(b AS BIGINT), ',' ORDER BY k, a) FILTER (k < 5) AS base,
    string_agg(kind || ':' || CAST(a AS BIGINT) || ':' || CAST(b AS BIGINT), ',' ORDER BY k, a) AS spans
  FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN s USING (doc_id)
"""

ORACLES["op11_quality_rules"] = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, r, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
windows AS (SELECT r, i, array_to_string(w[i:i + 2], ' ') AS win FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
often AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
covered AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(range(i, i + 3)) AS p FROM often) GROUP BY r),
c AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bullets,
    len(list_filter(lines, lambda x: regexp_matches(x, '(?:\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipses,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z\x{80}-\x{10FFFF}]'))) AS n_letter_words,
    len(regexp_extract_all(t, '[A-Za-z]')) AS n_letters, len(regexp_extract_all(t, '[A-Z]')) AS n_capitals,
    len(regexp_extract_all(t, '!')) AS n_shouts
  FROM w LEFT JOIN covered USING (r)),
v AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    10 * n_symbols > n_words OR word_chars < 3 * n_words OR word_chars > 10 * n_words OR 2 * n_dup_lines > n_lines
    OR 10 * n_bullets > 9 * n_lines OR 10 * n_ellipses > 3 * n_lines OR 10 * n_letter_words < 8 * n_words
    OR 2 * n_capitals > n_letters OR 10 * n_shouts > 3 * n_words AS failed
  FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT failed AS kept FROM v
"""

ORACLES["op13_fill_in_middle"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (
  SELECT *, regexp_extract_all(t, '(?s)[A-Za-z]+|[^A-Za-z]') AS u, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1,
    CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (
  SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
    CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CAST(CASE WHEN form <> 'plain' THEN length(pre) END AS BIGINT) AS prefix_chars,
  CAST(CASE WHEN form <> 'plain' THEN length(mid) END AS BIGINT) AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""

ORACLES["op10_near_duplicates"] = rf"""
WITH RECURSIVE
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id < b.doc_id GROUP BY x, y),
links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT x, y FROM edges UNION SELECT r.x, e.y FROM reach r JOIN edges e ON e.x = r.y),
low AS (SELECT x AS doc_id, min(y) AS m FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id, d.doc_id <= coalesce(m, d.doc_id) AS kept
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN low USING (doc_id)
"""
