"""What SQL can say of the queries of this package, for DuckDB."""

import string

from moodwell.llm.urlrules import ADDRESS_RULES, PATTERN_RULES


def _sql(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _rule_rows() -> str:
    """Rules as rows: kind, verdict, rule; hosts and paths apart, patterns as expressions of RE2."""
    rows = []
    for verdict, rule in ADDRESS_RULES:
        host, slash, path = rule.partition("/")
        rows.append(("address", verdict, rule, host, slash + path, ""))
    for verdict, rule in PATTERN_RULES:
        start = r"^(?:[^/?#]*\.)?" if rule.startswith("||") else "^" if rule.startswith("|") else ""
        body = "".join(
            {"*": ".*", "^": "(?:[^A-Za-z0-9]|^|$)"}.get(c, c if c.isalnum() else "\\" + c)
            for c in rule.removeprefix("||").removeprefix("|").removesuffix("|")
        )
        rows.append(("pattern", verdict, rule, "", "", "(?si)" + start + body + "$" * rule.endswith("|")))
    return ",\n    ".join("(" + ", ".join(map(_sql, row)) + ")" for row in rows)


URL_FILTER_SQL = rf"""
WITH rules(kind, verdict, rule, rule_host, rule_path, regex) AS (VALUES
    {_rule_rows()}
), cut AS (
  SELECT page_id,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS behind
  FROM pages
), parts AS (
  SELECT page_id, behind,
    translate(regexp_extract(behind, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_replace(behind, '^[^/?#]*', '') AS rest
  FROM cut
), pathed AS (
  SELECT *, regexp_extract(rest, '^[^?#]*') AS path FROM parts
), addresses AS (
  SELECT DISTINCT behind, host, rest, path FROM pathed
), fits AS (
  SELECT behind, kind, rule, verdict,
    row_number() OVER (PARTITION BY behind, kind ORDER BY length(rule) DESC, verdict, rule DESC) AS place
  FROM addresses JOIN rules ON CASE WHEN kind = 'address'
    THEN (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    ELSE regexp_matches(host || rest, regex) END
), first_fits AS (
  SELECT behind, max(CASE WHEN kind = 'address' THEN rule END) AS rule,
    max(CASE WHEN kind = 'address' THEN verdict END) AS by_address,
    max(CASE WHEN kind = 'pattern' THEN rule END) AS pattern,
    max(CASE WHEN kind = 'pattern' THEN verdict END) AS by_pattern
  FROM fits WHERE place = 1 GROUP BY behind
)
SELECT page_id, host, path, rule, coalesce(by_address, by_pattern, 'allow') AS verdict, pattern
FROM pathed LEFT JOIN first_fits USING (behind)
"""

_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase
_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

#: Every run of item words is held against every run of as many document words.
DECONTAMINATE_SQL = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size,
    array_to_string(w[p : p + least(len(w), 13) - 1], ' ') AS run
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p FROM items WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, size, p, array_to_string(w[p : p + size - 1], ' ') AS run
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM docs, sizes WHERE len(w) >= size)
),
met AS (SELECT doc_id, item_id, size, p FROM places JOIN windows USING (size, run)),
hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + size)) AS place FROM (SELECT DISTINCT doc_id, p, size FROM met)) GROUP BY 1
),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS held
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY 1
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(held, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)
"""
