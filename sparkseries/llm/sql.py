"""DuckDB SQL that must give the rows of the registered queries."""

from __future__ import annotations

from sparkseries.llm.licenses import NOTICES, PHRASES, need
from sparkseries.llm.lines import BOILERPLATE, BOILERPLATE_LINE_WORDS, MIN_WORDS, SEPARATORS, SYMBOLS, TERMINAL

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACED = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str, pattern: str, lower: bool) -> str:
    return f"regexp_extract_all({LOWER.format(text) if lower else text}, '{pattern}')"


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_PHRASE_WORDS = ", ".join(f"({_list(t.text.split())}, '{t.label}')" for t in PHRASES)
_NOTICE_WORDS = ", ".join(
    f"({_list(t.text.split())}, '{t.label}', {len(t.text.split())}, {need(t, len(set(t.text.split())))})" for t in NOTICES)

LICENSES = f"""
WITH d AS (SELECT doc_id, coalesce({words('text', ALNUM, True)}, []) AS w FROM documents),
p AS (SELECT * FROM (VALUES {_PHRASE_WORDS}) AS p(words, label)),
places AS (
    SELECT doc_id, label, i - 1 AS place
    FROM d, p, unnest(generate_series(1, len(w))) AS u(i)
    WHERE w[i] = words[1] AND list_slice(w, i, i + len(words) - 1) = words
),
base AS (
    SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
           list(DISTINCT label) AS labels
    FROM places GROUP BY doc_id
),
t AS (SELECT * FROM (VALUES {_NOTICE_WORDS}) AS t(words, label, size, need)),
starts AS (
    SELECT DISTINCT doc_id, words, label, size, need, greatest(i - o, 1) AS s
    FROM d, t, unnest(generate_series(1, len(w))) AS u(i), unnest(generate_series(0, size - 1)) AS v(o)
    WHERE list_contains(words, w[i])
      AND len(list_intersect(w, words)) >= need
),
blocks AS (
    SELECT doc_id, label, len(list_intersect(list_slice(w, s, s + size - 1), words)) / len(list_distinct(words)) AS held
    FROM starts JOIN d USING (doc_id)
    WHERE len(list_intersect(list_slice(w, s, s + size - 1), words)) >= need
),
notices AS (SELECT doc_id, list(DISTINCT label) AS labels, max(held) AS held FROM blocks GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(notices.labels, [])))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(held, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN notices USING (doc_id)
"""

_SYMBOL_CLASS = "[#*$%&|<>]"
_TERMINAL_CLASS = "(" + "|".join(("\\" + c if c in ".?)]|" else c.replace("'", "''")) for c in TERMINAL) + ")$"
_PHRASES = _list(" " + p + " " for p in BOILERPLATE)

LINES = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, {words('text', SPACED, False)} AS w FROM d),
grams AS (
    SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
    FROM w, unnest(generate_series(1, len(w) - 2)) AS u(i)
),
twice AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (
    SELECT doc_id, count(DISTINCT i + o) AS n FROM twice, unnest([0, 1, 2]) AS u(o) GROUP BY doc_id
),
lines AS (
    SELECT doc_id, line, {words('line', SPACED, False)} AS lw
    FROM d, unnest(string_split(text, chr(10))) AS u(line)
),
judged AS (
    SELECT doc_id, line, len(lw) AS n,
           regexp_matches(lw[len(lw)], '{_TERMINAL_CLASS}')
           AND 5 * len(list_filter(lw, lambda x: x IN ({_list(SEPARATORS)[1:-1]}))) < len(lw)
           AND 2 * len(regexp_extract_all(line, '{_SYMBOL_CLASS}')) < len(lw)
           AND NOT (len(lw) <= {BOILERPLATE_LINE_WORDS} AND len(list_filter({_PHRASES}, lambda p:
               contains(' ' || array_to_string({words('line', ALNUM, True)}, ' ') || ' ', p))) > 0) AS good
    FROM lines WHERE len(lw) > 0
),
by_line AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines,
           sum(CASE WHEN good THEN n ELSE 0 END) AS n_clean
    FROM judged GROUP BY doc_id
),
base AS (
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(length(array_to_string(w, '')), 0)::BIGINT AS word_chars,
           len(regexp_extract_all(text, '{_SYMBOL_CLASS}'))::BIGINT AS n_symbols,
           coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
           coalesce(n_clean, 0) AS n_clean
    FROM w LEFT JOIN by_line USING (doc_id) LEFT JOIN covered USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words) AND 2 * n_clean >= n_words AS kept
FROM base
"""
assert set(SYMBOLS) == set("#*$%&|<>")

CONTAMINATION = f"""
WITH d AS (SELECT doc_id, coalesce({words('text', ALNUM, True)}, []) AS w FROM documents),
b AS (SELECT item_id, {words('text', ALNUM, True)} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS words
    FROM b, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS u(i) WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
    SELECT doc_id, i, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS words
    FROM d, sizes, unnest(generate_series(1, len(w) - size + 1)) AS u(i)
),
hits AS (SELECT doc_id, item_id, i, p.size FROM places p JOIN windows USING (words)),
inside AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM hits, unnest(generate_series(0, size - 1)) AS u(o) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(DISTINCT item_id) AS n, array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS ids
    FROM hits GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(inside.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(inside.n, 0) > 0 AS contaminated
FROM d LEFT JOIN inside USING (doc_id) LEFT JOIN items USING (doc_id)
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce({words('text', SPACED, True)}, []) AS w FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 2), ' ') AS g
    FROM d, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS u(i) WHERE len(w) > 0
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
    SELECT a, b FROM pairs JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
    WHERE 100 * common >= 85 * (x.n + y.n - common)
),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(low.b, d.doc_id)) AS component_id,
       least(d.doc_id, coalesce(low.b, d.doc_id)) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low ON d.doc_id = low.a
"""

WARC = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS low FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND low <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND low <> page_id THEN low END AS refers_to
FROM f
"""


def _weights(level: str, weights) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {float(v)}" for k, v in weights.items())
    return f"CASE {level} {cases} ELSE 1.0 END::DOUBLE" if cases else "1.0::DOUBLE"


def mixing(levels: dict[str, str], weights, share: float, max_epochs: int, seed: int, source: str = "documents") -> str:
    """SQL of `mixed` with its id in doc_id."""
    names = list(levels)
    parts = [f"""rows AS (
    SELECT doc_id, {', '.join(f"coalesce({e}, '(none)') AS {k}" for k, e in levels.items())},
           coalesce(len({words('text', SPACED, False)}), 0)::BIGINT AS n_tokens FROM {source}
)""", f"leaves AS (SELECT {', '.join(names)}, sum(n_tokens)::BIGINT AS tokens FROM rows GROUP BY ALL)",
             f"node0 AS (SELECT least(round(sum(tokens) * {share}::DOUBLE), sum(tokens) * {max_epochs})::DOUBLE AS given FROM leaves)"]
    for d, level in enumerate(names):
        key = names[:d]
        family = f"PARTITION BY {', '.join(key)}" if key else ""
        using = f"JOIN node{d} USING ({', '.join(key)})" if key else f"CROSS JOIN node{d}"
        cols = ", ".join([*key, level])
        parts += [
            f"c{d} AS (SELECT {cols}, sum(tokens) * {max_epochs} AS cap, {_weights(level, weights.get(level, {}))} AS weight FROM leaves GROUP BY ALL)",
            f"r{d} AS (SELECT c{d}.*, given, CASE WHEN weight > 0 THEN cap / weight ELSE 'inf'::DOUBLE END AS ratio FROM c{d} {using})",
            f"""s{d} AS (SELECT *, coalesce(sum(cap) OVER ({family} ORDER BY ratio, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps,
       sum(weight) OVER ({family} ORDER BY ratio, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM r{d})""",
            f"t{d} AS (SELECT *, weight > 0 AND cap * ws <= weight * (given - caps) AS filled FROM s{d})",
            f"""u{d} AS (SELECT *, sum(CASE WHEN filled THEN cap ELSE 0 END) OVER ({family}) AS taken,
       sum(CASE WHEN filled THEN 0.0 ELSE weight END) OVER ({family}) AS free FROM t{d})""",
            f"""node{d + 1} AS (SELECT {cols}, CASE WHEN filled THEN cap WHEN free > 0 THEN weight * (given - taken) / free ELSE 0 END::DOUBLE AS given FROM u{d})""",
        ]
    cols = ", ".join(names)
    parts += [
        f"budgets AS (SELECT leaves.*, round(given)::BIGINT AS budget FROM leaves JOIN node{len(names)} USING ({cols}))",
        "split AS (SELECT *, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS epochs FROM budgets)",
        f"""ordered AS (
    SELECT doc_id, {cols}, n_tokens, epochs, budget - epochs * tokens AS rest,
           sum(n_tokens) OVER (PARTITION BY {cols} ORDER BY md5('{seed}:' || epochs || ':' || coalesce(doc_id::VARCHAR, '')), n_tokens
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS reached
    FROM rows JOIN split USING ({cols})
)""",
        "times AS (SELECT *, epochs + CASE WHEN rest > 0 AND reached <= rest THEN 1 ELSE 0 END AS n FROM ordered)",
    ]
    return f"WITH {', '.join(parts)} SELECT doc_id, {cols}, n_tokens, e::BIGINT AS epoch FROM times, unnest(generate_series(0, n - 1)) AS x(e) WHERE n > 0"

_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"

DIVERGENCE = f"""
WITH d AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           {words("coalesce(text, '')", _TERM, True)} AS w
    FROM documents
),
t AS (SELECT id, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 10),
groups AS (SELECT DISTINCT lang, source FROM d),
counts AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
dense AS (
    SELECT g.lang, g.source, k.term, coalesce(n, 0)::HUGEINT AS n,
           sum(coalesce(n, 0)) OVER (PARTITION BY g.lang, g.source) AS total, count(*) OVER (PARTITION BY g.lang, g.source) AS v
    FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
shares AS (SELECT lang, source, term, n, (1 + (1000000000 * (n + 2)) // (total + 2 * v))::HUGEINT AS p FROM dense),
totals AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM counts GROUP BY ALL),
sums AS (SELECT lang, sum(n) AS total, count(*) AS v FROM totals GROUP BY ALL),
whole AS (SELECT lang, term, (1 + (1000000000 * (n + 2)) // (total + 2 * v))::HUGEINT AS q FROM totals JOIN sums USING (lang)),
pairs AS (
    SELECT g.lang, g.source, 'pair' AS part, o.source AS item,
           coalesce(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)), 0)::BIGINT AS value
    FROM groups g JOIN groups o ON g.lang = o.lang AND g.source <> o.source
    LEFT JOIN shares a ON a.lang = g.lang AND a.source = g.source
    LEFT JOIN shares b ON b.lang = o.lang AND b.source = o.source AND b.term = a.term
    WHERE a.term IS NULL OR b.term IS NOT NULL
    GROUP BY ALL
),
terms AS (
    SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
    FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""

_UNITS = "regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]')"

INFILL = f"""
WITH d AS (
    SELECT doc_id, text, {_UNITS} AS u, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
),
c AS (
    SELECT *, len(u) AS n, {', '.join(f"('0x' || substr(h, {8 * k + 1}, 8))::BIGINT AS h{k + 1}" for k in range(4))} FROM d
),
f AS (
    SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                   WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
           least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b
    FROM c
),
p AS (
    SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:n], '') AS suf FROM f
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                   ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
