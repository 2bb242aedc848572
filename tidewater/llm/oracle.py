"""DuckDB statements for the queries of the training-data operators."""

from __future__ import annotations

from .quality_rules import (BOILERPLATE, BOILERPLATE_MAX_WORDS, MAX_LOST_PERCENT, MAX_REPEAT_PERCENT, MIN_WORDS,
                            NAVIGATION, NAVIGATION_MAX_WORDS)

WORD = r"[^\x20\x09-\x0D]+"

_list = lambda words: ", ".join(f"'{w}'" for w in words)


def quality_ctes(docs: str) -> str:
    """CTEs from ``docs`` (doc_id, text) to ``verdict``: counts, base_failed, kept and clean_text per document."""
    return rf"""
q_docs AS (SELECT doc_id, coalesce(text, '') AS t FROM {docs}),
q_words AS (SELECT doc_id, unnest(ws) AS w1, generate_subscripts(ws, 1) AS p
            FROM (SELECT doc_id, regexp_extract_all(t, '{WORD}') AS ws FROM q_docs)),
q_grams AS (SELECT *, lead(w1, 1) OVER w AS w2, lead(w1, 2) OVER w AS w3, lead(w1, 3) OVER w AS w4, lead(w1, 4) OVER w AS w5
            FROM q_words WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
q_found AS (SELECT doc_id, p, w5 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, w1, w2, w3, w4, w5) > 1 AS again
            FROM q_grams),
q_covered AS (SELECT doc_id, bool_or(again) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS c
              FROM q_found),
q_repeats AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (c) AS n_repeat_words FROM q_covered GROUP BY doc_id),
q_split AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i
            FROM (SELECT doc_id, string_split(t, chr(10)) AS ls FROM q_docs)),
q_lines AS (SELECT doc_id, line, i, regexp_extract_all(line, '{WORD}') AS ws,
                   length(regexp_replace(line, '[^#*$%&|<>!]', '', 'g')) AS marks
            FROM q_split WHERE regexp_matches(line, '{WORD}')),
q_judged AS (SELECT doc_id, line, i, len(ws) AS n,
    row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS dup,
    (marks >= 3 AND 3 * marks >= len(ws))
    OR (len(ws) >= 4 AND 2 * len(list_filter(list_zip(ws[:-2], ws[2:]), lambda x: x[1] = x[2])) >= len(ws))
    OR (len(ws) <= {NAVIGATION_MAX_WORDS} AND 2 * len(list_filter(ws, lambda x: lower(x) IN ({_list(NAVIGATION)}))) >= len(ws))
    OR (len(ws) <= {BOILERPLATE_MAX_WORDS} AND regexp_matches(lower(line), '{"|".join(BOILERPLATE)}')) AS failed
    FROM q_lines),
q_sums AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dup) AS n_dup_lines, count(*) FILTER (failed) AS lost_lines,
                  coalesce(sum(n) FILTER (failed), 0) AS lost_words,
                  coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT failed), '') AS clean_text
           FROM q_judged GROUP BY doc_id),
q_all AS (SELECT d.doc_id, t, coalesce(n_words, 0) AS n_words, coalesce(n_repeat_words, 0) AS n_repeat_words,
                 coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
                 coalesce(lost_lines, 0) AS lost_lines, coalesce(lost_words, 0) AS lost_words,
                 coalesce(clean_text, '') AS clean_text
          FROM q_docs d LEFT JOIN q_repeats USING (doc_id) LEFT JOIN q_sums USING (doc_id)),
verdict AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
                   NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)
                   AND 100 * lost_words <= {MAX_LOST_PERCENT} * n_words AS kept FROM q_all)"""


OP1 = rf"""WITH {quality_ctes("documents")}
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words,
       CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
       CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, kept,
       CAST(n_lines AS BIGINT) AS n_lines, CAST(lost_lines AS BIGINT) AS lost_lines, CAST(lost_words AS BIGINT) AS lost_words
FROM verdict"""

OP4 = r"""WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept, sha256(t) AS text_sha256
FROM n"""

# Escaping as op9's template does it: |> first, so that both halves of <|> are seen.
OP9 = r"""WITH all_turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
pipes AS (SELECT *, regexp_replace(role, '\|(\\*>)', '|\\\1', 'g') AS r1, regexp_replace(text, '\|(\\*>)', '|\\\1', 'g') AS t1 FROM all_turns),
marks AS (SELECT *, regexp_replace(r1, '([<\[])(\\*(?:\||/?s>|</?SYS>>|/?INST\]))', '\1\\\2', 'g') AS r2,
                 regexp_replace(t1, '([<\[])(\\*(?:\||/?s>|</?SYS>>|/?INST\]))', '\1\\\2', 'g') AS t2 FROM pipes)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|' || r2 || '|>' || chr(10) || t2 || '<|end|>' || chr(10))) AS BIGINT) AS formatted_chars
FROM marks GROUP BY conv_id"""

# Every kept term against every group and every pair of groups, one by one.
OP12 = r"""WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t
           FROM documents),
w AS (SELECT doc, lang, source, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                          '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS l FROM w GROUP BY 1, 2 HAVING count(DISTINCT doc) >= 3),
groups AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(l) AS ln FROM kept GROUP BY 1),
found AS (SELECT lang, source, term, count(*) AS g FROM w JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
n AS (SELECT lang, source, sum(g) AS n FROM found GROUP BY 1, 2),
shares AS (SELECT g.lang, g.source, k.term, coalesce(f.g, 0) AS g,
                  1 + 1000000000 * (CAST(coalesce(f.g, 0) AS HUGEINT) + 1) // (coalesce(n.n, 0) + v.v) AS p,
                  1 + 1000000000 * (CAST(k.l AS HUGEINT) + 1) // (v.ln + v.v) AS q
           FROM groups g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN n USING (lang, source)
           LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
         FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
pair_rows AS (SELECT lang, source, 'pair' AS part, item, coalesce(value, 0) AS value FROM pairs LEFT JOIN sums USING (lang, source, item)),
term_rows AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM shares WHERE g > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
           FROM (SELECT * FROM pair_rows UNION ALL SELECT * FROM term_rows))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200"""

# Row by row, the cheapest way into every state: no grammar, no matrices.
OP13 = r"""WITH RECURSIVE raw AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
hit AS (SELECT *, xor(CAST(4294967295 AS UBIGINT), list_reduce(
            list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(k, ''), lambda c: CAST(ascii(c) AS UBIGINT))),
            lambda crc, b: list_reduce(list_prepend(xor(crc, b), [CAST(0 AS UBIGINT) FOR z IN range(8)]),
                lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS UBIGINT)) ELSE x >> 1 END))) % 20 AS kind
        FROM raw),
hurt AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
         FROM (SELECT *, unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM hit)),
numbered AS (SELECT *, substr(role, 1, 1) AS c, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed,
                    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) AS i FROM hurt),
rows_ AS (SELECT *, CASE WHEN trimmed = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                         WHEN trimmed[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                 lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c AS pair FROM numbered),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                  count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                  count(*) FILTER (fault = 'truncated') AS truncated,
                  count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM rows_ GROUP BY conv_id),
ins(s0, s1, n, lines) AS (VALUES ('0', '0', 0, []::VARCHAR[]), ('0', 'u', 1, ['user:']), ('0', 'a', 2, ['user:', 'assistant:']),
    ('s', 's', 0, []), ('s', 'u', 1, ['user:']), ('s', 'a', 2, ['user:', 'assistant:']), ('u', 'u', 0, []), ('u', 'a', 1, ['assistant:']),
    ('a', 'a', 0, []), ('a', 'u', 1, ['user:'])),
dp AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, '0' AS s, CAST(0 AS BIGINT) AS cost, '' AS audit, []::VARCHAR[] AS lines FROM raw
    UNION ALL
    SELECT conv_id, i, s, cost, audit, lines FROM (
        SELECT d.conv_id, r.i, CASE e.op WHEN 'D' THEN t.s1 WHEN 'K' THEN r.c ELSE CASE t.s1 WHEN 'u' THEN 'a' ELSE 'u' END END AS s,
               d.cost + 2 * t.n + e.cost + CASE WHEN e.op <> 'D' AND r.fault = 'truncated' THEN 1 ELSE 0 END AS cost,
               d.audit || repeat('I', t.n) || e.op AS audit,
               d.lines || t.lines || CASE e.op WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [r.role || ':' || r.text]
                   ELSE [CASE t.s1 WHEN 'u' THEN 'assistant:' ELSE 'user:' END || r.text] END AS lines
        FROM dp d JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM d.conv_id AND r.i = d.i + 1 JOIN ins t ON t.s0 = d.s
        JOIN (VALUES ('D', 3), ('K', 0), ('R', 2)) e(op, cost)
          ON e.op = 'D' OR (r.fault NOT IN ('blank', 'duplicate') AND (e.op = 'R' OR (r.c = 's' AND t.s1 = '0')
             OR r.c = CASE t.s1 WHEN 'u' THEN 'a' ELSE 'u' END)))
    QUALIFY row_number() OVER (PARTITION BY conv_id, s ORDER BY cost, audit) = 1),
ends AS (SELECT conv_id, i, cost + CASE s WHEN 's' THEN 4 WHEN 'u' THEN 2 ELSE 0 END AS cost,
                audit || CASE s WHEN 's' THEN 'II' WHEN 'u' THEN 'I' ELSE '' END AS audit,
                lines || CASE s WHEN 's' THEN ['user:', 'assistant:'] WHEN 'u' THEN ['assistant:'] ELSE []::VARCHAR[] END AS lines FROM dp),
best AS (SELECT e.* FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id WHERE e.i = coalesce(c.n, 0)
         QUALIFY row_number() OVER (PARTITION BY e.conv_id ORDER BY e.cost, e.audit) = 1)
SELECT b.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(b.cost AS BIGINT) AS cost, b.audit,
       sha256(array_to_string(b.lines, chr(10))) AS repaired_sha256
FROM best b LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id"""

LLM_ORACLE = {"op1_quality_rules": OP1, "op4_exact_dedup": OP4, "op9_chat_format": OP9, "op12_source_divergence": OP12,
              "op13_conversation_repair": OP13}
