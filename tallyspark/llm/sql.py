"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from . import chat, quality

WORDS = "list_filter(regexp_split_to_array({x}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"

QUALITY = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, {WORDS.format(x="x")} AS ws, list_filter(string_split(x, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS ls FROM t),
g AS (SELECT r, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
d AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS k FROM g) WHERE k > 1),
rep AS (SELECT r, CAST(sum(least(3, coalesce(i - before, 3))) AS BIGINT) AS n FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM d) GROUP BY r),
m AS (SELECT w.r, doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda q: length(q))), 0) AS BIGINT) AS word_chars,
 CAST(length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, len(ls) AS n_lines
 FROM w LEFT JOIN rep ON w.r = rep.r),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, n_symbols / greatest(n_words, 1) AS symbol_rate, n_dup_lines / greatest(n_lines, 1) AS dup_line_rate,
 n_repeat_words / greatest(n_words, 1) AS repeat_rate, word_chars / greatest(n_words, 1) AS word_length FROM m),
"""


def _quality() -> str:
    def fences(prefix: str) -> str:
        out = ["count(*) AS n"]
        for m, (low, high, slack) in quality.METRICS.items():
            q = {p: f"quantile_disc({m}, {p})" for p in (0.25, 0.75)}
            reach = f"{quality.REACH} * ({q[0.75]} - {q[0.25]}) + {slack}"
            out += [f"{q[0.25]} - ({reach}) AS {m}_low"] * low + [f"{q[0.75]} + ({reach}) AS {m}_high"] * high
        return ", ".join(out)

    sides = [(m, side) for m, (low, high, _) in quality.METRICS.items() for side, on in (("low", low), ("high", high)) if on]
    pick = lambda m, side: f"CASE WHEN s.n >= {quality.ENOUGH} THEN s.{m}_{side} WHEN l.n >= {quality.ENOUGH} THEN l.{m}_{side} ELSE a.{m}_{side} END"
    inside = " AND ".join(f"f.{m} {'>=' if side == 'low' else '<='} {pick(m, side)}" for m, side in sides)
    return QUALITY + (
        f"s AS (SELECT lang, source, {fences('s')} FROM f WHERE NOT base_failed GROUP BY lang, source), l AS (SELECT lang, {fences('l')} FROM f WHERE NOT base_failed GROUP BY lang), "
        f"a AS (SELECT {fences('a')} FROM f WHERE NOT base_failed) SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce({inside}, false) AS kept "
        "FROM f LEFT JOIN s ON f.lang IS NOT DISTINCT FROM s.lang AND f.source IS NOT DISTINCT FROM s.source LEFT JOIN l ON f.lang IS NOT DISTINCT FROM l.lang CROSS JOIN a"
    )


def _chat() -> str:
    names = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in chat.NAMES.items())
    return f"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
 UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
 f AS (SELECT *, length('{chat.OPEN}' || CASE role {names} ELSE '@' || role END || '{chat.MIDDLE}')
 + length(replace(replace(replace(text, '\\', '\\\\'), '###', '\\###'), '</turn>', '\\</turn>')) + {len(chat.CLOSE)} AS k FROM c)
 SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
 CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
 sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256, CAST(sum(k) AS BIGINT) AS formatted_chars FROM f GROUP BY conv_id"""


JACCARD = f"""
WITH RECURSIVE t AS (SELECT doc_id, {WORDS.format(x="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 4], ' ') END AS g
 FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM t WHERE len(ws) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, w.b FROM reach r JOIN both_ways w ON w.a = r.other)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = d.doc_id
"""

TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(range(1, len(c.e) + 1), lambda i: c.e[i] * q.e[i])) AS BIGINT) AS score
 FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""

AUDIT = f"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, {WORDS.format(x="x")} AS ws, coalesce(doc_id > min(doc_id) OVER (PARTITION BY x), false) AS copy FROM t),
known AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT part, [len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws), 100 * (length(x) - length(regexp_replace(x, '[A-Z]', '', 'g'))) > 3 * length(x), regexp_matches(x, '[#$%&*|]'), copy] AS f,
 coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM w LEFT JOIN known USING (doc_id)),
c AS (SELECT part, f, good, toxic, count(*) AS n FROM d GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
p AS (SELECT filter_order, CAST(step AS INT) AS step, ascii(filter_order[step]) - 64 AS k, list_transform(range(1, step), lambda i: ascii(filter_order[i]) - 64) AS before FROM o, range(1, 6) r(step)),
e AS (SELECT part, filter_order, step, k, n, good, toxic, f[k] AS fails, len(list_filter(before, lambda b: f[b])) > 0 AS earlier, len(list_filter(f, lambda v: v)) = 1 AS once FROM c, p),
s AS (SELECT part, filter_order, step, k, sum(CASE WHEN NOT fails AND NOT earlier THEN n ELSE 0 END) AS kept, sum(CASE WHEN fails AND NOT earlier THEN n ELSE 0 END) AS removed, sum(CASE WHEN fails AND earlier THEN n ELSE 0 END) AS redundant,
 sum(CASE WHEN fails AND once THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN fails AND NOT earlier AND good THEN n ELSE 0 END) AS good_lost, sum(CASE WHEN fails AND NOT earlier AND toxic THEN n ELSE 0 END) AS toxic_lost FROM e GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
 CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, k) AS BIGINT) AS shapley FROM s
"""

LOWER = "translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TERMS = "regexp_extract_all(" + LOWER + ", '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

LEXICAL = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, {TERMS.format(x="coalesce(text, '')")} AS ts FROM documents),
z AS (SELECT count(*) FILTER (len(ts) > 0) AS n, CAST(sum(len(ts)) AS BIGINT) AS l FROM t),
d AS (SELECT r, doc_id, 100 - 25 + (25 * len(ts) * z.n) // z.l AS m FROM t, z WHERE len(ts) > 0),
f AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM t) GROUP BY r, term),
q AS (SELECT i, item_id, term, count(*) AS k FROM (SELECT i, item_id, unnest({TERMS.format(x="coalesce(text, '')")}) AS term FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)) GROUP BY i, item_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * z.n + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM f GROUP BY term), z),
s AS (SELECT i, item_id, r, CAST(sum(k * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score FROM q JOIN w USING (term) JOIN f USING (term) JOIN d USING (r) GROUP BY i, item_id, r)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (SELECT item_id, d.doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, d.doc_id) AS rank FROM s JOIN d USING (r) WHERE score > 0) WHERE rank <= 20
"""

SQL = {
    "op2_quality_rules": _quality(),
    "op7_chat_formatting": _chat(),
    "op8_ngram_jaccard_join": JACCARD,
    "op9_exact_top_k": TOP_K,
    "op11_filter_interaction_audit": AUDIT,
    "op13_ranked_lexical_search": LEXICAL,
}
