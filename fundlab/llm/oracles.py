"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

_WS = r"[\x20\x09-\x0D]"
#: The rule of each measure: quantile (per mille), multiple of its distance to the median, distance where that is 0.
_RULES = {"symbols": (900, 8, 5), "dup_lines": (995, 1, 50), "repeats": (995, 1, 50), "word_length": (750, 8, 5), "capitals": (900, 6, 3)}
_PRIOR = 200


def _limits() -> str:
    long = " UNION ALL ".join(f"SELECT gl, gs, '{m}' AS measure, {m} AS b, {p} AS p, {c} AS c, {least} AS least FROM m WHERE NOT base_failed" for m, (p, c, least) in _RULES.items())
    levels = []
    for depth, keys in enumerate(("measure", "gl, measure", "gl, gs, measure")):
        levels.append(f"""c{depth} AS (SELECT {keys}, b, p, c, least, sum(count(*)) OVER (PARTITION BY {keys} ORDER BY b) AS upto, sum(count(*)) OVER (PARTITION BY {keys}) AS total FROM long GROUP BY {keys}, b, p, c, least),
            h{depth} AS (SELECT {keys}, max(total) AS total, max(c) AS c, max(least) AS least, min(b) FILTER (upto * 2 >= total) AS middle, min(b) FILTER (upto * 1000 >= total * p) AS high FROM c{depth} GROUP BY {keys}),
            q{depth} AS (SELECT {keys}, CAST(total AS BIGINT) AS n, CAST(high + c * CASE WHEN high > middle THEN high - middle ELSE least END AS BIGINT) AS fence FROM h{depth})""")
    return f"long AS ({long}), " + ", ".join(levels)


def op10() -> str:
    lang = f"(coalesce(b.n * b.fence, 0) + {_PRIOR} * c.fence) // (coalesce(b.n, 0) + {_PRIOR})"
    limit = lambda x: f"SELECT (coalesce(a.n * a.fence, 0) + {_PRIOR} * ({lang})) // (coalesce(a.n, 0) + {_PRIOR}) FROM q0 c LEFT JOIN q1 b ON b.gl = m.gl AND b.measure = c.measure LEFT JOIN q2 a ON a.gl = m.gl AND a.gs = m.gs AND a.measure = c.measure WHERE c.measure = '{x}'"
    over = " OR ".join(f"coalesce(m.{x} > l.{x}, false)" for x in _RULES)
    limits = "SELECT gl, gs, " + ", ".join(f"({limit(x)}) AS {x}" for x in _RULES) + " FROM (SELECT DISTINCT gl, gs FROM m) m"
    return rf"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce('=' || lang, '') AS gl, coalesce('=' || source, '') AS gs FROM documents),
        w AS (SELECT *, list_filter(regexp_split_to_array(t, '{_WS}+'), lambda x: x <> '') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
        g AS (SELECT rid, unnest(list_transform(range(1, len(ws) - 1), lambda i: {{'i': i, 'k': ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]}}), recursive := true) FROM w WHERE len(ws) >= 3),
        r AS (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY rid, k) AS n FROM g) WHERE n > 1), cov AS (SELECT rid, count(DISTINCT p) AS n FROM r GROUP BY 1),
        c AS (SELECT w.*, len(ws) AS n_words, length(regexp_replace(t, '{_WS}+', '', 'g')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
            coalesce(cov.n, 0) AS n_repeat_words, length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS caps FROM w LEFT JOIN cov USING (rid)),
        m AS (SELECT *, n_symbols * 1000 // greatest(length(t), 1) AS symbols, n_dup_lines * 1000 // greatest(len(ls), 1) AS dup_lines, n_repeat_words * 1000 // greatest(n_words, 1) AS repeats,
            CASE WHEN word_chars * 100 // greatest(n_words, 1) < 2000 THEN word_chars * 100 // greatest(n_words, 1) ELSE 2000 + length(bin(word_chars * 100 // greatest(n_words, 1))) END AS word_length,
            caps * 1000 // greatest(word_chars, 1) AS capitals, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed FROM c), {_limits()}, l AS ({limits})
        SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
            base_failed, NOT base_failed AND NOT ({over}) AS kept FROM m JOIN l ON l.gl = m.gl AND l.gs = m.gs"""


def op8() -> str:
    text, role = "coalesce(text, '')", "coalesce(role, '')"
    escaped = lambda c: rf"regexp_replace({c}, '<(\\*)\|', '<\\\1|', 'g')"
    return f"""WITH c AS (SELECT conv_id, turn, {role} AS role, {text} AS text FROM conversations UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 0, 'assistant', '</s>[INST] ok [/INST]'),
        o AS (SELECT *, CASE WHEN conv_id = -7 AND role = 'user' THEN -1 ELSE coalesce(turn, -9223372036854775807) END AS place FROM c)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place, role, text)) AS turns_sha256, CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY place, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, CAST(sum(length({escaped("role")}) + length({escaped("text")}) + 23) AS BIGINT) AS formatted_chars FROM o GROUP BY conv_id"""


def _crc_table() -> str:
    """The 256 steps of CRC-32 by byte as a list."""
    rows = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ 0xEDB88320 * (byte & 1)
        rows.append(str(byte))
    return f"[{', '.join(rows)}]::BIGINT[]"


def _crc32(text: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of a text's UTF-8 bytes."""
    digit = lambda at: f"(instr('0123456789ABCDEF', substr(hex({text}), {at}, 1)) - 1)"
    octets = f"list_transform(range(1, length(hex({text})), 2), lambda i: {digit('i')} * 16 + {digit('i + 1')})"
    step = f"xor(c >> 8, ({_crc_table()})[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, b: {step}), 4294967295)"


def op11() -> str:
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    split = rf"regexp_extract_all({low}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    pairs = "list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])"
    noise = "((CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)) + 0.5) / 4294967296"
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {split} AS ws FROM documents), b AS (SELECT {split} AS ws FROM benchmark),
        df AS (SELECT rid, unnest(list_concat(ws, {pairs})) AS f FROM d), bf AS (SELECT unnest(list_concat(ws, {pairs})) AS f FROM b),
        k AS (SELECT f, {_crc32("f")} % 10000 AS bucket FROM (SELECT f FROM df UNION SELECT f FROM bf)),
        s AS (SELECT bucket, count(*) AS n FROM df JOIN k USING (f) GROUP BY 1), t AS (SELECT bucket, count(*) AS n FROM bf JOIN k USING (f) GROUP BY 1),
        g AS (SELECT s.bucket, CAST(floor(1000.0::DOUBLE * ln(((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM df) + 10000)::DOUBLE) / ((s.n + 1)::DOUBLE * ((SELECT count(*) FROM bf) + 10000)::DOUBLE))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket)),
        w AS (SELECT rid, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight, count(*) AS n_features FROM df JOIN k USING (f) JOIN g USING (bucket) GROUP BY 1),
        c AS (SELECT rid, doc_id, len(ws) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000.0::DOUBLE * ln(-ln(({noise})::DOUBLE))) AS BIGINT) AS score FROM d LEFT JOIN w USING (rid)),
        r AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place FROM c)
        SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN n_words >= 20 AND place <= (SELECT 25 * count(*) // 100 FROM c WHERE n_words >= 20) THEN place END AS rank FROM r"""


def op12() -> str:
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({low}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
        x AS (SELECT rid, doc_id, list_sort(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3] || ' ' || ws[i + 4]) END)) AS s FROM d),
        node AS (SELECT min(rid) AS node, s, min(doc_id) AS least, len(s) AS n FROM x WHERE len(s) > 0 GROUP BY s),
        e AS (SELECT node, n, unnest(s) AS f FROM node), p AS (SELECT a.node AS a, b.node AS b FROM e a JOIN e b ON a.f = b.f AND a.node < b.node GROUP BY a.node, b.node, a.n, b.n HAVING count(*) * 100 >= 80 * (a.n + b.n - count(*))),
        links AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p), reach AS (SELECT node AS a, node AS b FROM node UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
        c AS (SELECT a AS node, min(least) AS component_id FROM reach JOIN node ON node.node = reach.b GROUP BY 1)
        SELECT x.doc_id, CAST(len(x.s) AS BIGINT) AS n_shingles, CASE WHEN len(x.s) = 0 THEN x.doc_id ELSE c.component_id END AS component_id FROM x LEFT JOIN node ON node.s = x.s AND len(x.s) > 0 LEFT JOIN c USING (node)"""


def op13() -> str:
    return rf"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws, {_crc32("CAST(doc_id AS VARCHAR)")} AS h FROM documents),
        e AS (SELECT rid, doc_id, h, len(ws) AS n, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN (h // 10) % len(ws) END AS a, ws FROM d), f AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM e),
        o AS (SELECT rid, unnest(range(n)) AS i, unnest(ws) AS w FROM f),
        w AS (SELECT o.rid, o.i, s.w, f.n FROM o JOIN f USING (rid) JOIN o s ON s.rid = o.rid AND s.i = CASE WHEN f.a IS NULL OR o.i < f.a THEN o.i ELSE f.a + (o.i - f.a) % f.p END),
        t AS (SELECT *, lead(w, 1) OVER x AS w1, lead(w, 2) OVER x AS w2 FROM w WINDOW x AS (PARTITION BY rid ORDER BY i)),
        m AS (SELECT x.rid, x.i, y.i - x.i AS q FROM t x JOIN t y ON x.rid = y.rid AND x.w = y.w AND x.w1 = y.w1 AND x.w2 = y.w2 AND y.i > x.i WHERE (y.i - x.i) * 4 <= x.n),
        g AS (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM m),
        r AS (SELECT rid, "start", length, min(q) AS period FROM (SELECT rid, q, min(i) AS "start", count(*) + 2 + q AS length FROM g GROUP BY rid, q, island) WHERE length >= greatest(6, 4 * q) GROUP BY ALL),
        best AS (SELECT rid, count(*) AS n_runs, min(struct_pack(l := -length, s := "start", p := period)) AS b, string_agg("start" || ',' || length || ',' || period || chr(10), '' ORDER BY "start", period) AS told FROM r GROUP BY rid),
        gone AS (SELECT DISTINCT rid, unnest(range("start" + period, "start" + length)) AS i FROM r), kept AS (SELECT rid, string_agg(w, ' ' ORDER BY i) AS text FROM w ANTI JOIN gone USING (rid, i) GROUP BY rid)
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS "start", -b.l AS length, b.p AS period, 1000 * -b.l // b.p AS exponent_milli, sha256(coalesce(told, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
        FROM f LEFT JOIN best USING (rid) LEFT JOIN kept USING (rid)"""


def sql() -> dict[str, str]:
    return {"op8_chat": op8(), "op10_quality_rules": op10(), "op11_resample": op11(), "op12_jaccard_join": op12(), "op13_runs": op13()}
