"""SQL for the operators that SQL can express."""

from __future__ import annotations

from subtide.llm.licences import TEMPLATES, THRESHOLD
from subtide.llm.quality_rules import BITS, FENCE, MEASURES, MIN_DOCS, ROUNDS, TAILS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _plain_words(text: str) -> str:
    return rf"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


DECONTAMINATION = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_plain_words("text")} AS ws FROM documents),
b AS (SELECT row_number() OVER () AS bid, item_id::VARCHAR AS item, {_plain_words("text")} AS ws FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, k, array_to_string(ws[i:i + k - 1], ' ') AS w
  FROM (SELECT item, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
        FROM (SELECT *, least(13, len(ws)) AS k FROM b WHERE len(ws) > 0))),
doc_windows AS (
  SELECT rid, i, k, array_to_string(ws[i:i + k - 1], ' ') AS w
  FROM (SELECT rid, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
        FROM d, (SELECT DISTINCT k FROM item_windows) WHERE len(ws) >= k)),
found AS (SELECT rid, i, k, item FROM doc_windows JOIN item_windows USING (k, w)),
hits AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT rid, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT rid, i, k FROM found)) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT rid, item FROM found WHERE item IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hits USING (rid) LEFT JOIN items USING (rid)
"""

_TEMPLATES = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in TEMPLATES.items())


def _bigrams(source: str, key: str) -> str:
    return f"""
  SELECT {key}, n, w, count(*) AS c
  FROM (SELECT {key}, len(ws) - 1 AS n, ws[i] || ' ' || ws[i + 1] AS w
        FROM (SELECT *, unnest(range(1, len(ws))) AS i FROM {source} WHERE len(ws) > 1)) GROUP BY ALL"""


LICENCES = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
units AS (
  SELECT row_number() OVER () AS uid, rid, {_plain_words("u")} AS ws
  FROM (SELECT rid, text AS u FROM d
        UNION ALL SELECT rid, unnest(string_split(text, chr(10))) FROM d WHERE contains(text, chr(10)))),
templates AS (SELECT name, {_plain_words("t")} AS ws FROM (VALUES {_TEMPLATES}) AS v(name, t)),
ub AS ({_bigrams("units", "uid")}),
tb AS ({_bigrams("templates", "name")}),
pairs AS (
  SELECT uid, name, (2 * sum(least(ub.c, tb.c)))::DOUBLE / (any_value(ub.n) + any_value(tb.n)) AS dice
  FROM ub JOIN tb USING (w) GROUP BY uid, name),
best AS (SELECT uid, max(dice) AS dice FROM pairs WHERE dice >= {THRESHOLD}::DOUBLE GROUP BY uid),
named AS (SELECT uid, dice, min(name) AS name FROM best JOIN pairs USING (uid, dice) GROUP BY uid, dice),
places AS (
  SELECT rid, q, n, ws[q] || ' ' || ws[q + 1] AS w
  FROM (SELECT rid, ws, len(ws) - 1 AS n, unnest(range(1, len(ws))) AS q FROM (SELECT rid, {_plain_words("text")} AS ws FROM d) WHERE len(ws) > 1)),
covered AS (
  SELECT rid, name, tb.n AS m, w, tb.c AS c, unnest(range(greatest(1, q - tb.n + 1), least(q, places.n - tb.n + 1) + 1)) AS p
  FROM places JOIN tb USING (w) WHERE places.n >= tb.n),
windows AS (
  SELECT rid, name, p, sum(least(k, c))::DOUBLE / any_value(m) AS dice
  FROM (SELECT rid, name, p, w, any_value(m) AS m, any_value(c) AS c, count(*) AS k FROM covered GROUP BY rid, name, p, w)
  GROUP BY rid, name, p),
hits AS (
  SELECT rid, name, dice, 1 AS u, 0 AS v FROM named JOIN units USING (uid)
  UNION ALL SELECT rid, name, dice, 0, 1 FROM windows WHERE dice >= {THRESHOLD}::DOUBLE),
per_doc AS (SELECT rid, sum(u) AS n_units, sum(v) AS n_windows, max(dice) AS dice FROM hits GROUP BY rid),
chosen AS (SELECT rid, dice, n_units, n_windows, min(name) AS name FROM per_doc JOIN hits USING (rid, dice) GROUP BY ALL)
SELECT doc_id, coalesce(name, '') AS licence, round(coalesce(dice, 0::DOUBLE), 6) AS dice, coalesce(n_units, 0)::BIGINT AS n_units,
  coalesce(n_windows, 0)::BIGINT AS n_windows
FROM d LEFT JOIN chosen USING (rid)
"""

_PER_THOUSAND = ", ".join(
    f"('{m}', {m} * 1000 // greatest(n_words, 1), {least})" for m, least in MEASURES.items()
)



def _round(n: int) -> str:
    """Limits from the documents that all limits of the round before accept, and the documents outside of them."""
    return f"""
ranked{n} AS (
  SELECT *, row_number() OVER (PARTITION BY lvl, l, s, measure ORDER BY b) AS rn,
    count(*) OVER (PARTITION BY lvl, l, s, measure) AS total FROM scoped ANTI JOIN outside{n - 1} USING (rid)),
marks{n} AS (
  SELECT lvl, l, s, measure, least, total, min(b) FILTER (rn * 100 >= total * 25) AS q25,
    min(b) FILTER (rn * 100 >= total * 50) AS middle, min(b) FILTER (rn * 100 >= total * 75) AS q75,
    min(b) FILTER (rn * 100 >= total * {TAILS[0]}) AS lowest, min(b) FILTER (rn * 100 >= total * {TAILS[1]}) AS highest
  FROM ranked{n} GROUP BY ALL),
fences{n} AS (
  SELECT lvl, l, s, measure, total,
    CASE WHEN total < {MIN_DOCS} THEN q25 - greatest((q75 - q25) * {FENCE}, least)
      WHEN q75 > q25 THEN q25 - (q75 - q25) * {FENCE} ELSE 2 * lowest - middle END AS low,
    CASE WHEN total < {MIN_DOCS} THEN q75 + greatest((q75 - q25) * {FENCE}, least)
      WHEN q75 > q25 THEN q75 + (q75 - q25) * {FENCE} ELSE 2 * highest - middle END AS high
  FROM marks{n}),
judged{n} AS (
  SELECT rid, b, low, high FROM scoped JOIN fences{n} USING (lvl, l, s, measure) WHERE total >= {MIN_DOCS} OR lvl = 0
  QUALIFY row_number() OVER (PARTITION BY rid, measure ORDER BY lvl DESC) = 1),
outside{n} AS (SELECT DISTINCT rid FROM judged{n} WHERE b < low OR b > high)"""


QUALITY_RULES = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
windows AS (
  SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS s
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) > 2)),
twice AS (SELECT rid, s FROM windows GROUP BY rid, s HAVING count(*) > 1),
repeated AS (
  SELECT rid, count(DISTINCT p) AS n
  FROM (SELECT rid, unnest(range(i, i + 3)) AS p FROM windows JOIN twice USING (rid, s)) GROUP BY rid),
lines AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (
  SELECT w.rid, doc_id, lang, source, len(ws)::BIGINT AS n_words,
    length(array_to_string(ws, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN repeated USING (rid) LEFT JOIN lines USING (rid)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
v AS (
  SELECT rid, lang, source, base_failed, u.measure, u.v, u.least
  FROM f, LATERAL (SELECT * FROM (VALUES {_PER_THOUSAND}) AS t(measure, v, least)) AS u),
bins AS (
  SELECT *, (1::BIGINT << greatest(length(bin(v)) - {BITS}, 0)) AS step FROM v WHERE NOT base_failed),
scoped AS (
  SELECT rid, measure, least, step * (v // step) AS b, lvl,
    CASE WHEN lvl > 0 THEN coalesce('=' || lang, '') ELSE '' END AS l, CASE WHEN lvl > 1 THEN coalesce('=' || source, '') ELSE '' END AS s
  FROM bins, (VALUES (0), (1), (2)) AS levels(lvl)),
outside0 AS (SELECT NULL::BIGINT AS rid WHERE false),
{", ".join(_round(n) for n in range(1, ROUNDS + 1))}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND outside{ROUNDS}.rid IS NULL AS kept
FROM f LEFT JOIN outside{ROUNDS} USING (rid)
"""

SQL = {
    "op3_licences": LICENCES,
    "op4_decontamination": DECONTAMINATION,
    "op9_quality_rules": QUALITY_RULES,
}
