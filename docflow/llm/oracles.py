"""DuckDB SQL for those numbered queries that SQL can express."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = rf"""
WITH dw AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), iw AS (
    SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), ig AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM iw WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM ig), dg AS (
    SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS g
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)
), hit AS (SELECT doc_id, item_id, i, ig.n FROM dg JOIN ig ON dg.g = ig.g AND dg.n = ig.n), words AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP1 = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages
), b AS (SELECT page_id, n, h, CAST(CAST(unhex(h) AS BIT) AS VARCHAR) AS bits, min(page_id) OVER (PARTITION BY h, n) AS origin FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * CAST(substr(bits, 5 * i + 1, 1) AS INT)
        + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT) + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT)
        + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT) + CAST(substr(bits, 5 * i + 5, 1) AS INT), 1)), '') AS payload_digest,
    CASE WHEN page_id = origin THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> origin THEN origin END AS refers_to
FROM b
"""

OP2 = r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
    SELECT *, length(role) + length(text)
        + length(regexp_replace(role || chr(10) || text, '[^\\]', '', 'g'))
        + len(regexp_extract_all(role || chr(10) || text, '<\||<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>')) AS n FROM c
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(n + 12 + 10 + 10) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def _matches(kind: int, pattern: str, group: int, least: int, whole: str = "") -> str:
    """Rows (doc_id, kind, s, e) of a pattern's matches whose group has at least `least` characters.

    whole: a further pattern that a match must fit from end to end.
    """
    fits = f" AND regexp_full_match(w[i], '{whole}')" if whole else ""
    return f"""
    SELECT doc_id, {kind} AS kind, CAST(pos AS BIGINT) AS s, CAST(pos + length(w[i]) AS BIGINT) AS e
    FROM (SELECT doc_id, w, g, i, coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(w[1:i - 1], lambda x: length(x))), 0) AS pos
        FROM (SELECT doc_id, w, p, g, unnest(range(1, len(w) + 1)) AS i
            FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS w, regexp_extract_all(t, '{pattern}', {group}) AS g, string_split_regex(t, '{pattern}') AS p FROM d)))
    WHERE length(g[i]) >= {least}{fits}"""


_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_IDENT = r"""(?i)(?:access_?key_?id|client_?id|account_?id|login|user_?name)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9_.@-]{3,}"""
_ENDPOINT = r"""(?:https?|s3|jdbc:[a-z]+|redis|mongodb|postgres(?:ql)?|mysql|amqps?)://[^\x00-\x20"''<>\x7F]+"""
_KEY = "[A-Za-z0-9+/=_-]+"

OP4 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), strong AS (
    {_matches(0, _ASSIGN, 2, 6)} UNION ALL {_matches(1, "AKIA[A-Z0-9]+", 0, 20)} UNION ALL {_matches(2, "[0-9a-f]+", 0, 24)}
), weak AS (
    SELECT * FROM ({_matches(3, _KEY, 0, 40, "[A-Za-z0-9+/]{40}")} UNION ALL {_matches(4, _IDENT, 0, 1)} UNION ALL {_matches(5, _ENDPOINT, 0, 1)}) w
), parts AS (SELECT *, CASE WHEN kind IN (0, 2, 3) THEN 'secret' WHEN kind IN (1, 4) THEN 'access' ELSE 'endpoint' END AS role FROM (SELECT * FROM strong UNION ALL SELECT * FROM weak)
), linked AS (
    SELECT doc_id, kind, s, e FROM weak w
    WHERE NOT EXISTS (SELECT 1 FROM strong b WHERE b.doc_id = w.doc_id AND b.s < w.e AND w.s < b.e)
    AND (kind = 4 OR EXISTS (SELECT 1 FROM parts p WHERE p.doc_id = w.doc_id AND role = 'access' AND p.s <= w.e + 200 AND w.s <= p.e + 200))
    AND (kind = 3 OR EXISTS (SELECT 1 FROM parts p WHERE p.doc_id = w.doc_id AND role = 'secret' AND p.s <= w.e + 200 AND w.s <= p.e + 200))
), named AS (
    SELECT doc_id, kind, s, e, ['assign', 'access', 'hex', 'key', 'ident', 'endpoint'][kind + 1] || ':' || s || ':' || e AS span, kind < 3 AS base
    FROM (SELECT * FROM strong UNION ALL SELECT * FROM linked)
), told AS (
    SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
        string_agg(span, ',' ORDER BY s, kind, e) FILTER (WHERE base) AS base, string_agg(span, ',' ORDER BY s, kind, e) AS spans
    FROM named GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN told USING (doc_id)
"""


def _op11(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Lloyd's rounds spelled out, one after another; a distance and its entry make one number, so the least is the first nearest."""
    far = "list_sum(list_transform(list_zip(c, b), lambda t: (t[1] - t[2]) * (t[1] - t[2])))"
    ctes = [
        """k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"p AS MATERIALIZED (SELECT vec_id, label, part, v[part * len(v) // {parts} + 1 : (part + 1) * len(v) // {parts}] AS c FROM k, range({parts}) AS r(part))",
        f"b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id, c) - 1 AS entry, c AS b FROM p QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id, c) <= {entries})",
    ]
    for n in range(rounds + 1):
        ctes.append(f"a{n} AS MATERIALIZED (SELECT vec_id, label, p.part, any_value(c) AS c, min({far} * {entries} + entry) AS best FROM p JOIN b{n} USING (part) GROUP BY ALL)")
        if n < rounds:
            ctes.append(f"""m{n} AS (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS b
            FROM (SELECT part, best % {entries} AS entry, i, sum(c[i]) AS s, count(*) AS n FROM a{n}, range(1, len(c) + 1) AS r(i) GROUP BY ALL) GROUP BY ALL)""")
            ctes.append(f"b{n + 1} AS MATERIALIZED (SELECT part, entry, CAST(coalesce(m{n}.b, b{n}.b) AS BIGINT[]) AS b FROM b{n} LEFT JOIN m{n} USING (part, entry))")
    ctes.append(f"told AS (SELECT vec_id, label, string_agg(printf('%02x', best % {entries}), '' ORDER BY part) AS code, CAST(sum(best // {entries}) AS BIGINT) AS error FROM a{rounds} GROUP BY ALL)")
    ctes.append(f"books AS (SELECT sha256(string_agg(array_to_string(b, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})")
    return "WITH " + ", ".join(ctes) + " SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM told, books"


OP11 = _op11()

_CRC32 = """xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
        lambda c, b: list_reduce([xor(c, b)] || list_transform(range(8), lambda x: 0::BIGINT), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295)"""

OP13 = f"""
WITH t AS (
    SELECT conv_id, d, n_text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) AS pos, count(*) OVER (PARTITION BY conv_id) AS n
    FROM (SELECT conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d, length(coalesce(text, '')) AS n_text FROM conversations WHERE conv_id IS NOT NULL)
), c AS (
    SELECT conv_id, base, n, h, least(h, coalesce(n_base, 0)) AS taken
    FROM (SELECT DISTINCT conv_id, n, conv_id - conv_id % 100 AS base, {_CRC32} % 6 AS h FROM t) LEFT JOIN (SELECT DISTINCT conv_id AS base, n AS n_base FROM t) USING (base)
), r AS (
    SELECT conv_id, pos - h + taken AS depth, d, n_text FROM t JOIN c USING (conv_id) WHERE pos > h
    UNION ALL SELECT c.conv_id, pos, d, n_text FROM c JOIN t ON t.conv_id = c.base AND pos <= taken
), p AS (
    SELECT conv_id, depth, n_text, string_agg(d, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM r
    UNION ALL SELECT conv_id, 0, 0, '' FROM c
), ended AS (SELECT conv_id, arg_max(path, depth) AS path FROM p GROUP BY conv_id
), n AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(n_text) AS n_text FROM p GROUP BY path, depth
), kids AS (SELECT path[: -65] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1
), k AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (path)
), below AS (
    SELECT a.path, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves, CAST(sum((b.n_convs - 1) * b.n_text) AS BIGINT) AS saved_tokens
    FROM k a JOIN k b ON starts_with(b.path, a.path) GROUP BY a.path
), e AS (SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM ended GROUP BY path)
SELECT k.conv_id, CAST(k.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, k.n_convs, k.n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM k JOIN below USING (path) LEFT JOIN e USING (path) LEFT JOIN n up ON k.depth > 0 AND up.path = k.path[: -65]
"""
