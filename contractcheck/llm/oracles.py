"""The operators' results in plain SQL, for DuckDB, over whole tables."""

from __future__ import annotations

from contractcheck.llm.divergence import MIN_DOCS, SMOOTH, TERM, TOP, UNIT
from contractcheck.llm.licences import LOWER, NOTICES, THRESHOLD, UPPER, bigrams_of
from contractcheck.llm.rules import POLICIES, RULES, policy_mask

LOW = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
BLANK_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

LEDGER_SQL = rf"""
docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, {BLANK_WORDS.format('t')} AS words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM docs),
g AS (SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
      FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) > 2)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT i + o) AS n FROM twice, (VALUES (0), (1), (2)) AS x(o) GROUP BY rid),
m AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(length(regexp_replace(t, '[^A-Z]', '', 'g')) AS BIGINT) AS n_upper,
        CAST(length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS BIGINT) AS n_letters,
        CAST(coalesce(list_max(list_transform(words, lambda x: strlen(x))), 0) AS BIGINT) AS longest_word
      FROM w LEFT JOIN covered c USING (rid)),
ledger AS (SELECT *, CAST({' + '.join(f'CASE WHEN {c} THEN {1 << i} ELSE 0 END' for i, c in enumerate(RULES.values()))} AS BIGINT) AS bits FROM m)
"""

RULES_SQL = f"""
WITH {LEDGER_SQL}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       bits & {policy_mask('base-1')} <> 0 AS base_failed, bits & {policy_mask('base-1') | policy_mask('web-1')} = 0 AS kept, bits
FROM ledger
"""

_ENTRIES = ", ".join(f"('{p}', '{r}', {policy_mask(chosen)}, {1 << list(RULES).index(r)})" for p, chosen in POLICIES.items() for r in chosen)
ABLATION_SQL = f"""
WITH {LEDGER_SQL}
SELECT policy, rule, count(*) AS n_docs, count(*) FILTER (bits & mask <> 0) AS n_removed,
       count(*) FILTER (bits & mask & bit <> 0) AS n_failed, count(*) FILTER (bits & mask = bit) AS n_only
FROM ledger, (VALUES {_ENTRIES}) AS e(policy, rule, mask, bit) GROUP BY policy, rule
"""

JACCARD_SQL = f"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS rid, doc_id, {BLANK_WORDS.format(LOW)} AS words FROM documents),
s AS (SELECT DISTINCT rid, CASE WHEN len(words) < 5 THEN array_to_string(words, ' ')
        ELSE array_to_string(words[i:i + 4], ' ') END AS g
      FROM (SELECT rid, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
links AS (SELECT x.rid AS a, y.rid AS b FROM s x JOIN s y ON x.g = y.g AND x.rid <> y.rid
          JOIN n p ON p.rid = x.rid JOIN n q ON q.rid = y.rid
          GROUP BY x.rid, y.rid HAVING count(*) >= 0.8 * (max(p.n) + max(q.n) - count(*)) - 1e-9),
reach AS (SELECT rid AS a, rid AS b FROM w UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
class AS (SELECT r.a AS rid, min(w.doc_id) AS class_id FROM reach r JOIN w ON w.rid = r.b GROUP BY r.a)
SELECT doc_id, class_id, (SELECT count(*) FROM links l WHERE l.a = w.rid) AS n_links FROM w JOIN class USING (rid)
"""

MIX_SQL = rf"""
WITH d AS (SELECT doc_id, source, CAST(len({BLANK_WORDS.format("coalesce(text, '')")}) AS BIGINT) AS size,
             CAST('0x' || substr(md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')), 1, 6) AS BIGINT) AS u FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS k FROM d GROUP BY source),
c AS (SELECT *, ([5.0, 2.0, 1.0])[(k - 1) % 3 + 1]::DOUBLE AS w, CAST(2 * source_size AS DOUBLE) AS cap, (SELECT sum(source_size) FROM s) * 1.5::DOUBLE AS whole FROM s),
f AS (SELECT *, whole - coalesce(sum(cap) OVER (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room,
        sum(w) OVER (ORDER BY cap / w, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open, row_number() OVER (ORDER BY cap / w, k) AS nth FROM c),
lvl AS (SELECT nth, room, open FROM f WHERE NOT (w * room / open >= cap) ORDER BY nth LIMIT 1),
t AS (SELECT f.source, f.source_size, CASE WHEN lvl.nth IS NULL OR f.nth < lvl.nth THEN f.cap ELSE f.w * lvl.room / lvl.open END AS target FROM f LEFT JOIN lvl ON true),
a AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS times FROM t),
u AS (SELECT source, u, sum(size) AS z FROM d GROUP BY source, u),
run AS (SELECT u.source, u.u, u.z, a.target - a.times * a.source_size AS extra,
          sum(u.z) OVER (PARTITION BY u.source ORDER BY u.u) AS upto FROM u JOIN a ON u.source IS NOT DISTINCT FROM a.source),
edge AS (SELECT source, arg_min(u, u) + CASE WHEN arg_min(extra - (upto - z), u) >= arg_min(z, u) / 2 THEN 1 ELSE 0 END AS cut FROM run WHERE upto >= extra GROUP BY source)
SELECT d.doc_id, d.size, a.source_size, a.target, CAST(d.size * (a.times + CASE WHEN d.u < coalesce(e.cut, 0) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN a ON d.source IS NOT DISTINCT FROM a.source LEFT JOIN edge e ON d.source IS NOT DISTINCT FROM e.source
"""

LETTER_WORDS = r"regexp_extract_all({}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')".format(LOW)
CONTAMINATION_SQL = rf"""
WITH i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {LETTER_WORDS} AS words FROM benchmark),
win AS (SELECT DISTINCT item, k, array_to_string(words[p:p + k - 1], ' ') AS g
        FROM (SELECT item, words, least(len(words), 10) AS k, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS p FROM i WHERE len(words) > 0)),
d AS (SELECT row_number() OVER () AS rid, doc_id, {LETTER_WORDS} AS words FROM documents),
grams AS (SELECT rid, k, unnest(range(1, len(words) - k + 2)) AS p,
            unnest(list_transform(range(1, len(words) - k + 2), lambda p: array_to_string(words[p:p + k - 1], ' '))) AS g
          FROM d, (SELECT DISTINCT k FROM win) WHERE len(words) >= k),
occ AS (SELECT rid, p, k, item FROM grams JOIN win USING (k, g)),
hit AS (SELECT rid, count(DISTINCT p + o) AS n FROM (SELECT rid, p, unnest(range(k)) AS o FROM occ) GROUP BY rid),
items AS (SELECT rid, count(DISTINCT item) AS n, array_to_string(list_sort(list(DISTINCT item)), ',') AS ids FROM occ GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)
"""

_NOTICES = ", ".join("('{}', '{}', [{}])".format(n, family, ", ".join("'" + g.replace("'", "''") + "'" for g in bigrams_of(text))) for n, (family, text) in NOTICES.items())
LICENCE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_replace({LOW}, '[^a-z0-9.\n]+', ' ', 'g') AS t FROM documents),
p AS (SELECT DISTINCT rid, unnest(list_concat(list_transform(string_split(t, chr(10)), lambda x: trim(x, ' ')),
        list_transform(regexp_split_to_array(t, '\n ?\n'), lambda x: trim(regexp_replace(x, '[ \n]+', ' ', 'g'), ' ')),
        [trim(regexp_replace(t, '[ \n]+', ' ', 'g'), ' ')])) AS said FROM d),
b AS (SELECT rid, said, CASE WHEN len(x) > 1 THEN list_distinct(list_transform(range(1, len(x)), lambda k: x[k] || ' ' || x[k + 1])) ELSE x END AS grams
      FROM (SELECT rid, said, string_split(said, ' ') AS x FROM p WHERE said <> '')),
m AS (SELECT rid, said, licence, family, 2.0::DOUBLE * len(list_intersect(b.grams, n.grams)) / (len(b.grams) + len(n.grams)) AS dice
      FROM b, (VALUES {_NOTICES}) AS n(licence, family, grams)
      WHERE len(b.grams) BETWEEN {THRESHOLD / (2 - THRESHOLD)!r} * len(n.grams) AND {(2 - THRESHOLD) / THRESHOLD!r} * len(n.grams)),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY dice DESC, licence DESC) AS nth FROM m WHERE dice >= {THRESHOLD}),
c AS (SELECT rid, count(DISTINCT said) AS n FROM r GROUP BY rid)
SELECT doc_id, licence, family, dice, coalesce(c.n, 0) AS n_passages
FROM d LEFT JOIN r ON r.rid = d.rid AND r.nth = 1 LEFT JOIN c ON c.rid = d.rid
"""

FIM_SQL = """
WITH h AS (SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
             sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
d AS (SELECT doc_id, t, n, CAST('0x' || substr(x, 1, 8) AS BIGINT) % (n + 1) AS i, CAST('0x' || substr(x, 9, 8) AS BIGINT) % (n + 1) AS j,
        CAST('0x' || substr(x, 17, 8) AS BIGINT) % 100 AS h3, CAST('0x' || substr(x, 25, 8) AS BIGINT) % 100 AS h4 FROM h),
f AS (SELECT doc_id, t, n, least(i, j) AS a, greatest(i, j) AS b,
        CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
             WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
c AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM c
"""

DIVERGENCE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all({LOW}, '{TERM}') AS words FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT rid) AS d FROM (SELECT lang, source, rid, unnest(words) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS total FROM c GROUP BY ALL HAVING sum(d) >= {MIN_DOCS}),
v AS (SELECT lang, count(*) AS v, sum(total) AS lang_size FROM kept GROUP BY lang),
k AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, total, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS size
      FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
p AS (SELECT k.*, 1 + (CAST({UNIT} AS HUGEINT) * (n + {SMOOTH})) // (size + {SMOOTH} * v) AS p,
        1 + (CAST({UNIT} AS HUGEINT) * (total + {SMOOTH})) // (lang_size + {SMOOTH} * v) AS q FROM k JOIN v USING (lang)),
far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, CAST(coalesce(far.value, 0) AS BIGINT) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
terms AS (SELECT lang, source, term AS item, CAST(p - q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL
SELECT * FROM (SELECT lang, source, 'term', item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM terms)
WHERE rank <= {TOP}
"""
