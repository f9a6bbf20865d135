"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES["op10_decontamination"] = f"""
WITH items AS (SELECT cast(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, words, len(string_split(words, ' ')) AS n FROM (
    SELECT item, unnest([array_to_string(w[i + 1 : i + 13], ' ') FOR i IN range(greatest(len(w) - 13, 0) + 1)]) AS words
    FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
places AS (
  SELECT doc_id, n, unnest(range(len(w) - n + 1)) AS pos, w
  FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
hits AS (
  SELECT p.doc_id, p.n, p.pos, x.item
  FROM (SELECT doc_id, n, pos, array_to_string(w[pos + 1 : pos + n], ' ') AS words FROM places) p JOIN windows x USING (words)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM hits) GROUP BY 1),
hit_items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items,
  sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(d.w) AS contaminated
FROM docs d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items i USING (doc_id)
"""

# The kinds in order: pattern, least length of the counted group, and that group.
_KINDS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 12, 2, True),
    ("access", r"AKIA[A-Z0-9]+", 18, 0, True),
    ("hex", r"[0-9a-f]+", 16, 0, True),
    ("issued", r"(?:^|[^A-Za-z0-9])(gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})", 1, 1, False),
    ("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 1, 0, False),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1, 0, False),
]


def _matches(rank: int, kind: str, pattern: str, least: int, group: int, base: bool) -> str:
    """(doc, rank, kind, start, end, value): positions from the lengths of what stands between the matches."""
    return f"""
  SELECT doc_id, owner, repository, {rank} AS rank, '{kind}' AS kind, {str(base).lower()} AS base, value,
    (sum(length(gap)) OVER w + sum(length(hit)) OVER w - length(hit){" + length(hit) - length(value)" if kind == "issued" else ""})::BIGINT AS start,
    (sum(length(gap)) OVER w + sum(length(hit)) OVER w)::BIGINT AS stop
  FROM (
    SELECT doc_id, owner, repository, unnest(range(1, len(hits) + 1)) AS k, unnest(hits) AS hit, unnest(counted) AS value, unnest(gaps[1 : len(hits)]) AS gap
    FROM (
      SELECT doc_id, source AS owner, [source, lang] AS repository, regexp_extract_all(text, '{pattern}', 0) AS hits,
        regexp_extract_all(text, '{pattern}', {group}) AS counted, string_split_regex(text, '{pattern}') AS gaps
      FROM texts))
  WINDOW w AS (PARTITION BY doc_id ORDER BY k)
  QUALIFY length(value) >= {least}"""


ORACLES["op1_secrets"] = f"""
WITH texts AS (SELECT doc_id, source, lang, coalesce(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join(_matches(i, *k) for i, k in enumerate(_KINDS))}),
owned AS (SELECT value, count(DISTINCT coalesce(owner, '')) <= 2 AND count(DISTINCT repository) <= 4 AS live FROM found GROUP BY 1),
kept AS (SELECT * FROM found JOIN owned USING (value) WHERE base OR live),
digests AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, rank) FILTER (base) AS base_spans,
    string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, rank) AS spans,
    count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example
  FROM kept GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_example, 0)::BIGINT AS n_example
FROM texts LEFT JOIN digests USING (doc_id)
"""

ORACLES["op3_url_filter"] = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    CASE WHEN regexp_extract(rest, '^[^/?#]*(.?)', 1) = '/' THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM rest),
rules(rule, verdict) AS (
  VALUES ('com/', 'allow'), ('example.com/en/', 'block'), ('www.example.com/en/', 'allow'), ('net/es/', 'block'), ('net/fr/', 'block')),
ranked AS (
  SELECT p.page_id, p.host, p.path, max_by(r.rule, length(r.rule)) AS rule, max_by(r.verdict, length(r.rule)) AS verdict
  FROM parts p LEFT JOIN rules r ON (p.host = split_part(r.rule, '/', 1) OR ends_with(p.host, concat('.', split_part(r.rule, '/', 1))))
    AND starts_with(p.path, substr(r.rule, instr(r.rule, '/')))
  GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN regexp_matches(host,
  '(^|[-.])(casino|poker|free[-.]bets|betting|jackpot|slots|adult|porn|xxx|escort|cheap[-.]pills|viagra|payday[-.]loans|spam[-.]farm|link[-.]farm|ads[-.]track|adserver|tracker|malware|warez)([-.]|$)')
  THEN 'block' ELSE 'allow' END) AS verdict
FROM ranked
"""
