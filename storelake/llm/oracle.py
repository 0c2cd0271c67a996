"""DuckDB twins of the training-data queries that SQL can express."""

from __future__ import annotations

SQL = {}

SQL["op4_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
owners AS (SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10 GROUP BY k),
marked AS (SELECT keyed.*, coalesce(owner < doc_id, false) AS dropped FROM keyed LEFT JOIN owners USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def _pii_kind(rank: int, kind: str, pattern: str, near: str, prior: float, valid: str) -> str:
    """Confirmed spans of one kind; the pieces between the matches give their places."""
    return rf"""
SELECT doc_id, {rank} AS rank, '{kind}' AS kind, start, start + length(m) AS stop,
       least(1.0, {prior} + CASE WHEN regexp_matches(right(piece, 40), '(?i)(?:{near})') THEN 0.4 ELSE 0.0 END) AS score
FROM (SELECT doc_id, found[i] AS m, pieces[i] AS piece,
             CAST(list_sum([length(x) for x in pieces[:i]]) + coalesce(list_sum([length(x) for x in found[:i - 1]]), 0)
                  AS BIGINT) AS start
      FROM (SELECT doc_id, pieces, found, unnest(range(1, len(found) + 1)) AS i
            FROM (SELECT doc_id, string_split_regex(t, '{pattern}') AS pieces, regexp_extract_all(t, '{pattern}') AS found
                  FROM d)))
WHERE {valid}"""


# RE2 has no look-behind: plain forms of the base expressions, word boundaries for the further kinds
_LUHN = """list_sum([CASE WHEN (length(g) - k) % 2 = 0 THEN CAST(g[k] AS INTEGER)
                          WHEN CAST(g[k] AS INTEGER) > 4 THEN 2 * CAST(g[k] AS INTEGER) - 9
                          ELSE 2 * CAST(g[k] AS INTEGER) END for k in range(1, length(g) + 1)]) % 10 = 0"""
_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_IBAN = """list_reduce([0] || [CASE WHEN ch BETWEEN 'A' AND 'Z' THEN ascii(ch) - 55 ELSE CAST(ch AS INTEGER) END
                               for ch in string_split(replace(m, ' ', '')[5:] || m[1:4], '')],
                       lambda a, x: (CASE WHEN x > 9 THEN a * 100 ELSE a * 10 END + x) % 97) = 1"""

SQL["op1_pii"] = "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), spans AS (" + " UNION ALL ".join([
    _pii_kind(0, "email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "mail|contact|write|reply|e-mail", 0.9, "true"),
    _pii_kind(1, "ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "ip|address|host|server|login|client", 0.6,
              "list_max([CAST(x AS HUGEINT) for x in string_split(m, '.')]) <= 255"),
    _pii_kind(2, "card", "[0-9](?:[ -]?[0-9])+", "card|visa|master|amex|credit|debit|payment|pay", 0.8,
              f"length({_DIGITS}) BETWEEN 12 AND 19 AND {_LUHN.replace('g[', _DIGITS + '[').replace('length(g)', f'length({_DIGITS})')}"),
    _pii_kind(3, "phone", r"\+[0-9][ ().0-9-]+[0-9]", "phone|tel|call|mobile|cell|fax|dial", 0.6,
              f"length({_DIGITS}) BETWEEN 9 AND 15"),
    _pii_kind(4, "iban", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}\b", "iban|bank|account|transfer|konto|cuenta|compte", 0.9, _IBAN),
    _pii_kind(5, "ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "ssn|social|security|taxpayer", 0.3,
              "NOT regexp_matches(m, '^(?:000|666|9)|-00-|-0000$') "
              "AND regexp_matches(right(piece, 40), '(?i)(?:ssn|social|security|taxpayer)')"),
]) + """),
own AS (
  SELECT doc_id, count(*) FILTER (rank = 0) AS n_email, count(*) FILTER (rank = 1) AS n_ip,
         count(*) FILTER (rank = 2) AS n_card, count(*) FILTER (rank = 3) AS n_phone,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 4) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans,
         string_agg(printf('%.1f', score), ',' ORDER BY start, rank) AS scores
  FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(scores, '') AS scores
FROM d LEFT JOIN own USING (doc_id)"""


def _window_coverage(n: int, what: str) -> str:
    """Words inside ``n``-word windows found twice or more (``all``) or seen before (``seen``) in their text."""
    return f"""
SELECT DISTINCT doc, place + unnest(range({n})) AS place FROM (
  SELECT doc, place, count(*) OVER (PARTITION BY doc, win) AS times, row_number() OVER (PARTITION BY doc, win ORDER BY place) AS turn
  FROM (SELECT doc, i AS place, list_slice(w, i, i + {n - 1}) AS win
        FROM (SELECT doc, w, unnest(range(1, len(w) - {n - 2})) AS i FROM d WHERE len(w) >= {n})))
WHERE {"times > 1" if what == "all" else "turn > 1"}"""


def _quality_rules() -> str:
    top, seen, lines, symbols = {2: 20, 3: 18, 4: 16}, {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}, (30, 20), 10
    parts = ["""
t AS (SELECT row_number() OVER () AS doc, doc_id, coalesce(text, '') AS text FROM documents),
d AS (SELECT doc, doc_id, text, list_filter(string_split_regex(text, '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '') AS w FROM t),
wd AS (SELECT doc, unnest(range(1, len(w) + 1)) AS place, unnest(w) AS word FROM d),
ln AS (SELECT doc, line, length(regexp_replace(line, '[ \\t\\n\\v\\f\\r]', '', 'g')) AS chars, count(*) AS times
       FROM (SELECT doc, unnest(string_split(text, chr(10))) AS line FROM t)
       WHERE regexp_matches(line, '[^ \\t\\n\\v\\f\\r]') GROUP BY doc, line),
lines AS (SELECT doc, sum(times) AS n_lines, sum(times - 1) AS n_dup_lines, sum((times - 1) * chars) AS dup_line_chars
          FROM ln GROUP BY doc),
repeated AS (SELECT doc, count(*) AS n FROM (""" + _window_coverage(3, "all") + """) GROUP BY doc)"""]
    columns, joins = [], []
    for n in top:
        parts.append(f"""
top_{n} AS (SELECT doc, max(chars) AS chars FROM (
  SELECT doc, win, count(*) * length(list_reduce([''] || win, lambda a, b: a || b)) AS chars FROM (
    SELECT doc, list_slice(w, i, i + {n - 1}) AS win
    FROM (SELECT doc, w, unnest(range(1, len(w) - {n - 2})) AS i FROM d WHERE len(w) >= {n}))
  GROUP BY doc, win HAVING count(*) > 1) GROUP BY doc)""")
        columns.append((f"top_{n}_chars", f"top_{n}.chars", top[n]))
        joins.append(f"LEFT JOIN top_{n} USING (doc)")
    for n in seen:
        parts.append(f"""
dup_{n} AS (SELECT c.doc, sum(length(word)) AS chars FROM ({_window_coverage(n, "seen")}) c JOIN wd ON c.doc = wd.doc AND c.place = wd.place
            GROUP BY c.doc)""")
        columns.append((f"dup_{n}_chars", f"dup_{n}.chars", seen[n]))
        joins.append(f"LEFT JOIN dup_{n} USING (doc)")
    over = " OR ".join(f"100 * {c} > {share} * word_chars" for c, _, share in columns)
    return f"""
WITH {",".join(parts)},
m AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(text, '[ \\t\\n\\v\\f\\r]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(repeated.n, 0) AS n_repeat_words,
         {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in ("n_lines", "n_dup_lines", "dup_line_chars"))},
         {", ".join(f"CAST(coalesce({expr}, 0) AS BIGINT) AS {c}" for c, expr, _ in columns)}
  FROM d LEFT JOIN lines USING (doc) LEFT JOIN repeated USING (doc) {" ".join(joins)}),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT *, NOT (base_failed OR 100 * n_symbols > {symbols} * n_words OR 100 * n_dup_lines > {lines[0]} * n_lines
               OR 100 * dup_line_chars > {lines[1]} * word_chars OR {over}) AS kept
FROM v"""


SQL["op11_quality_rules"] = _quality_rules()

SQL["op12_hard_negatives"] = """
WITH v AS (
  SELECT DISTINCT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND NOT list_bool_or([x IS NULL OR NOT isfinite(x) for x in embedding])),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
         CAST(list_sum([a.q[i] * r.q[i] for i in range(1, len(a.q) + 1)]) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 10
"""
