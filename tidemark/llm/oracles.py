"""DuckDB SQL for those queries that SQL can express; the others are held against brute force in tests/llm."""

from __future__ import annotations

from . import license_scan, risk_rules

_SPACES = r"[\x09-\x0D\x20]+"


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


LINES = r"""WITH lines AS (SELECT doc_id, unnest(range(0, len(l))) AS line_no, unnest(l) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
sets AS (SELECT doc_id, line_no, doc_id * 1000000 + line_no AS place, list_sort(list_distinct(list_filter(string_split(line, ' '), lambda x: x <> ''))) AS w FROM lines WHERE trim(line, ' ') <> ''),
firsts AS (SELECT w, min(place) AS place, len(w) AS n FROM sets GROUP BY w),
words AS (SELECT place, n, unnest(w) AS word FROM firsts),
counted AS (SELECT word, count(*) AS df FROM words GROUP BY 1),
ranked AS (SELECT place, n, word, row_number() OVER (PARTITION BY place ORDER BY df, word) AS pos FROM words JOIN counted USING (word)),
heads AS (SELECT * FROM ranked WHERE pos <= n - ceil(0.9 * n - 1e-9) + 1),
near AS (SELECT DISTINCT x.place AS x, y.place AS y FROM heads x JOIN heads y ON x.word = y.word AND y.place < x.place AND 10 * y.n >= 9 * x.n AND 10 * x.n >= 9 * y.n),
matched AS (SELECT DISTINCT x FROM near JOIN firsts a ON a.place = x JOIN firsts b ON b.place = y WHERE 10 * len(list_intersect(a.w, b.w)) >= 9 * (a.n + b.n - len(list_intersect(a.w, b.w)))),
judged AS (SELECT s.doc_id, s.line_no, s.place <> f.place OR m.x IS NOT NULL AS removed FROM sets s JOIN firsts f ON s.w = f.w LEFT JOIN matched m ON m.x = f.place),
by_doc AS (SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN removed THEN 1 ELSE 0 END) AS BIGINT) AS n_removed, coalesce(string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) FILTER (WHERE removed), '') AS removed FROM judged GROUP BY 1)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed FROM documents d LEFT JOIN by_doc USING (doc_id)"""

_PHRASES = ", ".join(f"({_list(p.split())}, '{label}')" for p, label in license_scan.BASE)
_TEMPLATES = ", ".join(f"('{t.label}', {_list(t.words)}, {_list(t.key_words)}, {t.key_at})" for t in license_scan.TEMPLATES)
LICENCES = rf"""WITH texts AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{license_scan.UPPER}', '{license_scan.LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
phrases(p, label) AS (VALUES {_PHRASES}), templates(label, t, k, pos) AS (VALUES {_TEMPLATES}),
hits AS (SELECT doc_id, label, i - 1 AS i FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM texts) JOIN phrases ON w[i] = p[1] AND w[i:i + len(p) - 1] = p),
base AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM hits GROUP BY 1),
keys AS (SELECT doc_id, label, t, w, i - 1 - pos AS start FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM texts) JOIN templates ON w[i] = k[1] AND w[i:i + len(k) - 1] = k WHERE i - 1 - pos >= 0),
covered AS (SELECT doc_id, label, len(list_filter(range(1, len(t) + 1), lambda j: coalesce(w[start + j] = t[j], false))) / len(t) AS coverage FROM keys),
found AS (SELECT doc_id, max(coverage) AS coverage FROM covered WHERE coverage >= {license_scan.COVERAGE} GROUP BY 1),
every AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM hits UNION ALL SELECT doc_id, label FROM covered WHERE coverage >= {license_scan.COVERAGE}) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, greatest(coalesce(coverage, 0), CASE WHEN n_base > 0 THEN 0.5 ELSE 0 END)::DOUBLE AS score
FROM texts LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id) LEFT JOIN every USING (doc_id)"""

NEAR_COPIES = rf"""WITH RECURSIVE words AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{license_scan.UPPER}', '{license_scan.LOWER}'), '{_SPACES}'), lambda x: x <> '') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w] ELSE list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) END) AS s FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT s.a, reached.r FROM reached JOIN sides s ON s.b = reached.doc_id),
least AS (SELECT doc_id, min(r) AS component_id FROM reached GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM least LEFT JOIN sizes USING (doc_id)"""

_SHOWN = "'<|' || role || '|>' || chr(10) || replace({}, '<|', '<\\|') || '<|end|>' || chr(10)"
_SIDE = "md5(coalesce(string_agg(" + _SHOWN + ", '' ORDER BY i) FILTER (WHERE i {} n_common), ''))"
CHATS = f"""WITH t AS (SELECT conv_id, role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i FROM conversations),
last AS (SELECT conv_id, max(i) FILTER (WHERE role = 'assistant') AS last FROM t GROUP BY 1),
answers AS (SELECT t.conv_id, text AS answer FROM t JOIN last ON last.conv_id = t.conv_id AND i = last),
pairs AS (SELECT t.conv_id, i, role, text AS c, CASE WHEN i = last THEN coalesce(answer, '') ELSE text END AS r FROM t JOIN last ON last.conv_id = t.conv_id LEFT JOIN answers a ON a.conv_id = xor(t.conv_id, 1)),
common AS (SELECT conv_id, coalesce(min(i) FILTER (WHERE c <> r) - 1, max(i)) AS n_common FROM pairs GROUP BY 1)
SELECT conv_id, first(n_common) AS n_common, {_SIDE.format('c', '<=')} AS prompt_md5, {_SIDE.format('c', '>')} AS chosen_md5, {_SIDE.format('r', '>')} AS rejected_md5,
CAST(coalesce(sum(length(replace(c, '<|', '<\\|'))) FILTER (WHERE role = 'assistant' AND i > n_common), 0) AS BIGINT) AS chosen_learned, CAST(coalesce(sum(length(replace(r, '<|', '<\\|'))) FILTER (WHERE role = 'assistant' AND i > n_common), 0) AS BIGINT) AS rejected_learned
FROM pairs JOIN common USING (conv_id) GROUP BY conv_id"""

_ALPHA, _DELTA, _RULES = 0.05, 0.05, risk_rules.RULES
_SHARE = _ALPHA / len(_RULES)
_LEVEL = _DELTA / ((len(risk_rules.LANGUAGES) + 1) * sum(len(r.grid) for r in _RULES))
_GRID = ", ".join(f"('{r.name}', {g}, {c}::DOUBLE)" for r in _RULES for g, c in enumerate(r.grid))
_STATS = " UNION ALL ".join(f"SELECT doc_id, stratum, '{r.name}' AS rule, {r.statistic.replace('/ ', '/ nullif(')}, 0)::DOUBLE AS x FROM stats" for r in _RULES)
RULES = rf"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, CASE WHEN lang IN ({', '.join(f"'{x}'" for x in risk_rules.LANGUAGES)}) THEN lang ELSE 'other' END AS stratum, list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACES}'), lambda x: x <> '') AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x09-\x0D\x20]')) AS l FROM documents),
runs AS (SELECT doc_id, i, w[i:i + 7] AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM texts)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, run) AS c FROM runs) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(0, 8) r(k) GROUP BY 1),
stats AS (SELECT doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '{_SPACES}', '', 'g')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(length(regexp_replace(text, '\P{{Lu}}', '', 'g')) AS BIGINT) AS n_capitals, CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words FROM texts LEFT JOIN covered USING (doc_id)),
measured AS ({_STATS}), grid(rule, g, cutoff) AS (VALUES {_GRID}),
good AS (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY 1 HAVING min(quality) = 1),
counts AS (SELECT stratum, rule, g, cutoff, count(*) AS n, CAST(sum(CASE WHEN x > cutoff THEN 1 ELSE 0 END) AS BIGINT) AS k FROM measured JOIN good USING (doc_id) JOIN grid USING (rule) WHERE x IS NOT NULL OR rule = 'none' GROUP BY ALL),
proven AS (SELECT stratum, rule, arg_max(cutoff, g) AS cutoff FROM counts WHERE k < n * {_SHARE} AND list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_SHARE}) + (n - i) * ln(1 - {_SHARE})))) <= {_LEVEL} GROUP BY 1, 2),
rejected AS (SELECT DISTINCT doc_id FROM measured JOIN proven USING (stratum, rule) WHERE x > cutoff)
SELECT s.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND r.doc_id IS NULL AS kept FROM stats s LEFT JOIN rejected r ON r.doc_id = s.doc_id"""

_PARTS, _ENTRIES, _ROUNDS = 8, 16, 6


def _vector_codes() -> str:
    """Each round's assignment and codebooks as tables of their own."""
    # cut: part p of each vector; book0: parts of the smallest ids; near1: nearest entries by book0; book1: after one round.
    tables = [
        "whole AS (SELECT vec_id, label, list_transform(embedding, lambda v: CAST(floor(4096 * CAST(v AS DOUBLE)) AS BIGINT)) AS x FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0)",
        f"cut AS MATERIALIZED (SELECT vec_id, label, p, x[p * len(x) // {_PARTS} + 1:(p + 1) * len(x) // {_PARTS}] AS x FROM whole, range(0, {_PARTS}) r(p))",
        f"book0 AS MATERIALIZED (SELECT p, i, x AS e FROM cut JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS i FROM whole ORDER BY vec_id LIMIT {_ENTRIES}) USING (vec_id))",
    ]
    for k in range(_ROUNDS + 1):
        squares = "list_sum(list_transform(list_zip(x, e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
        tables.append(f"near{k} AS MATERIALIZED (SELECT vec_id, label, p, x, min(ROW({squares}, i)) AS b FROM cut JOIN book{k} USING (p) GROUP BY ALL)")
        if k < _ROUNDS:
            floor = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"
            tables += [
                f"sum{k} AS (SELECT p, i, d, sum(v) AS s, count(*) AS n FROM (SELECT p, struct_extract(b, 2) AS i, unnest(range(1, len(x) + 1)) AS d, unnest(x) AS v FROM near{k}) GROUP BY ALL)",
                f"book{k + 1} AS MATERIALIZED (SELECT p, i, coalesce(m.e, o.e) AS e FROM book{k} o LEFT JOIN (SELECT p, i, list({floor} ORDER BY d) AS e FROM sum{k} GROUP BY ALL) m USING (p, i))",
            ]
    last = _ROUNDS
    return f"""WITH {", ".join(tables)},
rows AS (SELECT vec_id, label, string_agg(printf('%02x', struct_extract(b, 2)), '' ORDER BY p) AS code, CAST(sum(struct_extract(b, 1)) AS BIGINT) AS error FROM near{last} GROUP BY ALL),
digest AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, i, d)) AS codebooks_sha256 FROM (SELECT p, i, unnest(range(0, len(e))) AS d, unnest(e) AS v FROM book{last}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM rows, digest"""


ORACLES = {"op2_line_dedup": LINES, "op3_license_scan": LICENCES, "op6_minhash_forest": NEAR_COPIES, "op8_chat_format": CHATS, "op9_risk_rules": RULES, "op11_va_codes": _vector_codes()}
