"""SQL that gives the rows of registered queries of this subpackage."""

from __future__ import annotations

import re

from tabloom.llm.url_filters import HOST_RULES, PATTERN_RULES

FILL_MIDDLE = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), parts AS (
  SELECT *, string_split(text, chr(10)) AS pieces,
         length(text) - length(replace(text, chr(10), '')) + CAST(text <> '' AND NOT suffix(text, chr(10)) AS INTEGER) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM texts
), cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM parts
), heads AS (
  SELECT *, CASE WHEN a = 0 THEN '' WHEN a = n THEN text ELSE array_to_string(pieces[1:a], chr(10)) || chr(10) END AS upto_a,
         CASE WHEN b = 0 THEN '' WHEN b = n THEN text ELSE array_to_string(pieces[1:b], chr(10)) || chr(10) END AS upto_b
  FROM cuts
), three AS (
  SELECT *, upto_a AS pre, substr(upto_b, length(upto_a) + 1) AS mid, substr(text, length(upto_b) + 1) AS suf FROM heads
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM three
"""


def _pattern(rule: str) -> str:
    """The regular expression of a pattern rule, as DuckDB takes it."""
    body = rule.removeprefix("|").removesuffix("|")
    body = "".join({"*": ".*", "^": r"(?:[^0-9A-Za-z_.%-]|\z)"}.get(c, re.escape(c)) for c in body)
    return "(?is)" + "^" * rule.startswith("|") + body + r"\z" * rule.endswith("|")


def _values(rows: list[tuple[str, ...]]) -> str:
    return ", ".join("(" + ", ".join("'" + value.replace("'", "''") + "'" for value in row) + ")" for row in rows)


URL_FILTERS = rf"""
WITH rests AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1) AS behind,
         row_number() OVER () AS row_id
  FROM rests
), parts AS (
  SELECT page_id, row_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(behind, '^[^?#]*') AS path, behind
  FROM split
), hosts(rule, verdict) AS (VALUES {_values([(r.removeprefix("||"), v) for r, v in HOST_RULES])}
), patterns(rule, verdict, pattern) AS (VALUES {_values([(r, v, _pattern(r)) for r, v in PATTERN_RULES])}
), by_host AS (
  SELECT row_id, max(struct_pack(n := length(rule), allow := verdict = 'allow', rule := rule)) AS best FROM parts, hosts
  WHERE (host = split_part(rule, '/', 1) OR suffix(host, '.' || split_part(rule, '/', 1)))
    AND prefix(path, substr(rule, strpos(rule, '/')))
  GROUP BY row_id
), by_pattern AS (
  SELECT row_id, max(struct_pack(allow := verdict = 'allow', rule := rule)) AS best FROM parts, patterns
  WHERE regexp_matches(host || behind, pattern) AND (host <> '' OR behind <> '')
  GROUP BY row_id
)
SELECT page_id, host, path, h.best.rule AS rule,
       CASE WHEN coalesce(h.best.allow, p.best.allow, true) THEN 'allow' ELSE 'block' END AS verdict,
       CASE WHEN h.best.rule IS NULL THEN p.best.rule END AS pattern
FROM parts LEFT JOIN by_host h USING (row_id) LEFT JOIN by_pattern p USING (row_id)
"""

COLLOCATIONS = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), pieces AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts
), worded AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces
), sizes(k) AS (VALUES (1), (2), (3), (4)
), grams AS (
  SELECT lang, k, unnest(list_transform(generate_series(1, len(words) - k + 1), lambda i: array_to_string(words[i:i + k - 1], ' '))) AS phrase
  FROM worded, sizes WHERE len(words) >= k
), counted AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, k, phrase, f, string_split(phrase, ' ') AS words FROM counted WHERE k >= 2 AND f >= 30
), places(s, e) AS (VALUES (1, 2), (2, 3), (3, 4), (1, 3), (2, 4)
), around AS (
  SELECT lang, array_to_string(words[s:e], ' ') AS phrase, max(f) AS most
  FROM candidates, places WHERE e <= k AND e - s + 1 < k GROUP BY ALL
), cuts AS (
  SELECT lang, phrase, f, unnest(generate_series(1, k - 1)) AS cut, words, k FROM candidates
), scored AS (
  SELECT c.lang, c.phrase, c.f AS a, c.cut, x.f AS l, y.f AS r,
         (2000000 * CAST(c.f AS HUGEINT)) // (CAST(x.f AS HUGEINT) + y.f) AS score
  FROM cuts c
  JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1:c.cut], ' ')
  JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[c.cut + 1:c.k], ' ')
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), kept AS (
  SELECT w.* FROM lowest w LEFT JOIN around o ON o.lang = w.lang AND o.phrase = w.phrase
  WHERE o.most IS NULL OR 100 * CAST(o.most AS HUGEINT) < 80 * CAST(w.a AS HUGEINT)
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN totals USING (lang)
WHERE rank <= 2000
"""
