"""DuckDB SQL of the queries that SQL can express over whole tables."""

from __future__ import annotations

import re

from strata.llm import license_scan, quality_ledger
from strata.llm.chat_format import Template
from strata.llm.queries import MIX

_WORD = r"[^\x20\x09-\x0D]+"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _chat() -> str:
    t = Template()
    marks = len(t.turn_start) + len(t.role_end) + len(t.turn_end)
    found = "|".join(re.escape(c[0]) + f"{t.escape}*" + re.escape(c[1:]) for c in t.controls).replace("\\<", "<").replace("\\>", ">")
    size = lambda x: f"(length({x}) + len(regexp_extract_all({x}, {_q(found)})))"
    return f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum({marks} + {size("role")} + {size("text")}) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id"""


def _mix() -> str:
    entropy = lambda a: f"(ln(list_sum(list_transform(ps, lambda p: pow(p, {a})))) - {a} * list_sum(list_transform(ps, lambda p: pow(p, {a}) * ln(p))) / list_sum(list_transform(ps, lambda p: pow(p, {a}))))"
    often = lambda a: f"(pow(list_min(ps), {a} - 1) / list_sum(list_transform(ps, lambda p: pow(p, {a}))) > {MIX.max_repeats})"
    return f"""
WITH RECURSIVE tok AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS mark, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS tokens FROM documents),
docs AS (SELECT doc_id, source, mark, CAST(sum(tokens) AS BIGINT) AS tokens FROM tok GROUP BY ALL),
per AS (SELECT source, CAST(sum(tokens) AS BIGINT) AS total FROM tok GROUP BY source),
al AS (SELECT CAST(sum(total) AS BIGINT) AS budget FROM per),
sh AS (SELECT list(total / CAST(budget AS DOUBLE) ORDER BY source) AS ps, {MIX.entropy} * ln(count(*)) AS target FROM per, al WHERE total > 0),
one(k, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE UNION ALL
  SELECT k + 1, CASE WHEN {entropy("((lo + hi) / 2)")} >= target THEN (lo + hi) / 2 ELSE lo END,
    CASE WHEN {entropy("((lo + hi) / 2)")} >= target THEN hi ELSE (lo + hi) / 2 END FROM one, sh WHERE k < 54),
a1 AS (SELECT CASE WHEN len(ps) = 1 OR {entropy("1.0")} >= target THEN 1.0 ELSE lo END AS a FROM one, sh WHERE k = 54),
two(k, lo, hi) AS (
  SELECT 0, a, 1.0::DOUBLE FROM a1 UNION ALL
  SELECT k + 1, CASE WHEN {often("((lo + hi) / 2)")} THEN (lo + hi) / 2 ELSE lo END,
    CASE WHEN {often("((lo + hi) / 2)")} THEN hi ELSE (lo + hi) / 2 END FROM two, sh WHERE k < 54),
a2 AS (SELECT CASE WHEN a < 1 AND {often("a")} THEN hi ELSE a END AS a FROM two, a1, sh WHERE k = 54),
w AS (SELECT source, total, CASE WHEN total > 0 THEN pow(total / CAST(budget AS DOUBLE), a) / list_sum(list_transform(ps, lambda p: pow(p, a))) ELSE 0 END AS weight, budget,
  ceil(budget / {MIX.block_tokens}.0) AS blocks FROM per, al, a2, sh),
q AS (SELECT *, CAST(floor(weight * budget + 1e-6) AS BIGINT) AS quota FROM w),
passes AS (
  SELECT d.doc_id, d.source, d.mark, d.tokens, q.total, q.quota, CAST(greatest(ceil(q.quota / q.blocks), 1) AS BIGINT) AS part,
    unnest(range(0, (q.quota - 1) // q.total + 1)) AS epoch
  FROM docs d JOIN q ON d.source IS NOT DISTINCT FROM q.source WHERE q.quota > 0),
slots AS (SELECT *, md5('{MIX.seed}:' || epoch || ':' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || mark) AS slot FROM passes),
ends AS (SELECT *, epoch * total + sum(tokens) OVER (PARTITION BY source, epoch ORDER BY slot RANGE UNBOUNDED PRECEDING) AS stop FROM slots)
SELECT doc_id, source, CAST(epoch AS BIGINT) AS epoch, CAST((stop - tokens) // part AS BIGINT) AS block, tokens, slot FROM ends WHERE stop <= quota"""


#: The rules in the order of their bits.
FAILS = {
    "few_words": "n_words < 50", "repeated_words": "100 * n_repeat_words > 50 * n_words", "symbols": "10 * n_symbols > n_words",
    "shouting": "100 * n_upper > 40 * word_chars", "bangs": "10 * n_bangs > n_words", "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "short_words": "10 * word_chars < 20 * n_words", "long_words": "word_chars > 20 * n_words",
}


def _quality() -> str:
    bits = " + ".join(f"CASE WHEN {FAILS[name]} THEN {1 << bit} ELSE 0 END" for bit, (name) in enumerate(FAILS))
    kept = " AND ".join(f"NOT ({FAILS[n]})" for n in quality_ledger.POLICIES[2])
    return f"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ls FROM documents),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM t)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT pos) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS pos FROM twice) GROUP BY doc_id),
m AS (SELECT t.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
    len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(regexp_extract_all(t, '[A-Z]')) AS n_upper, len(regexp_extract_all(t, '!')) AS n_bangs
  FROM t LEFT JOIN rep USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed, ({kept}) AS kept, CAST({bits} AS BIGINT) AS failed FROM m"""


def _ablation() -> str:
    bits = {name: 1 << bit for bit, name in enumerate(FAILS)}
    policy = quality_ledger.POLICIES[2]
    whole = sum(bits[n] for n in policy)
    rows = [f"SELECT '{n}' AS rule, count(*) AS n, count(CASE WHEN failed & {whole} = 0 THEN 1 END) AS kept, count(CASE WHEN failed & {bits[n]} <> 0 THEN 1 END) AS n_failed, count(CASE WHEN failed & {whole} = {bits[n]} THEN 1 END) AS n_only, "
            f"count(CASE WHEN failed & {whole - bits[n]} = 0 THEN 1 END) AS n_kept_without FROM book" for n in policy]
    return f"WITH book AS ({_quality()}) " + " UNION ALL ".join(rows)


def _license() -> str:
    """All windows that share enough bigrams, by counting: each bigram that a
    text has in common with a template lies in as many windows as the
    template has bigrams."""
    t = 0.8
    rows = ", ".join(f"({k}, {_q(n)}, {len(license_scan.template_words(b))}, [{', '.join(map(_q, license_scan.template_bigrams(b)))}])" for k, (n, b) in enumerate(license_scan.TEMPLATES))
    return f"""
WITH tpl(k, license, w, grams) AS (VALUES {rows}),
one AS (SELECT k, license, w, len(grams) AS b, unnest(grams) AS gram FROM tpl),
d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '{license_scan.WORD}') AS ws FROM documents),
p AS (SELECT doc_id, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) AS pairs FROM d WHERE len(ws) > 1),
g AS (SELECT doc_id, unnest(pairs) AS gram, generate_subscripts(pairs, 1) - 1 AS i FROM p),
m AS (SELECT doc_id, k, license, w, b, gram, unnest(range(i - w + 2, i + 1)) AS s FROM g JOIN one USING (gram)),
c AS (SELECT doc_id, k, license, w, b, s, count(DISTINCT gram) AS shared FROM m GROUP BY ALL HAVING count(DISTINCT gram) >= b * {t / (2 - t)} - 1e-9),
x AS (SELECT c.*, len(pairs) AS total, len(list_distinct(list_slice(pairs, greatest(s, 0) + 1, least(s + w - 1, len(pairs))))) AS a FROM c JOIN p USING (doc_id)),
f AS (SELECT doc_id, license, greatest(s, 0) AS lo, least(s + w, total + 1) AS hi, 2.0 * shared / (a + b) AS dice FROM x WHERE CAST(2.0 * shared / (a + b) AS DOUBLE) >= {t}),
o AS (SELECT *, lo >= max(hi) OVER (PARTITION BY doc_id, license ORDER BY lo, hi, dice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS apart FROM f),
n AS (SELECT *, sum(CASE WHEN coalesce(apart, true) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, license ORDER BY lo, hi, dice ROWS UNBOUNDED PRECEDING) AS place FROM o),
r AS (SELECT doc_id, license, place, min(lo) AS lo, max(hi) AS hi, max(CAST(dice AS DOUBLE)) AS dice FROM n GROUP BY ALL),
best AS (SELECT * FROM r WHERE NOT EXISTS (SELECT 1 FROM r q WHERE q.doc_id = r.doc_id AND q.license <> r.license AND q.lo < r.hi AND r.lo < q.hi
  AND (q.dice > r.dice OR (q.dice = r.dice AND q.license < r.license)))),
per AS (SELECT doc_id, count(*) AS n, array_to_string(list_sort(list_distinct(list(license))), ',') AS licenses, max(dice) AS dice FROM best GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_matches, coalesce(licenses, '') AS licenses, round(dice, 6) AS best_dice
FROM documents d LEFT JOIN per USING (doc_id)"""


def _join() -> str:
    return f"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ') ELSE ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] END AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM t WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
both_in AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM both_in JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)),
reach(a, b) AS (SELECT doc_id, doc_id FROM t UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT r.a AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id FROM reach r LEFT JOIN n ON n.doc_id = r.a GROUP BY r.a"""


def _negatives() -> str:
    return """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_dot_product(a.x, r.x) AS BIGINT) AS score
  FROM e a JOIN e r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
pos AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM pos JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5"""


ORACLE = {
    "op1_chat_format": _chat(),
    "op4_mix_sources": _mix(),
    "op5_quality_ledger": _quality(),
    "quality_ablation": _ablation(),
    "op6_license_scan": _license(),
    "op7_ngram_jaccard_join": _join(),
    "op12_hard_negatives": _negatives(),
}
