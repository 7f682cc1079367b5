"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from basketry.llm import secrets
from basketry.llm.url_templates import DEPTH, LOWER, UPPER


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit: a code is folded in, then eight shifts follow it."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bits}), lambda a, x: {step}), 4294967295)"


_DIGIT = "strpos('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz', c) - 1"
CRC_TOKEN = (
    f"list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split(right(m, 6), ''), lambda c: CAST({_DIGIT} AS BIGINT))),"
    f" lambda a, x: a * 62 + x) = {crc32_sql('substr(right(m, 36), 1, 30)')}"
)
_DIGITS = "list_reverse(list_transform(regexp_extract_all(regexp_extract(m, pat, 1), '[0-9]'), lambda c: CAST(c AS INT)))"
LUHN = (
    f"list_sum(list_transform({_DIGITS}, lambda x, i: CASE WHEN i % 2 = 1 THEN x ELSE x * 2 - CASE WHEN x > 4 THEN 9 ELSE 0 END END)) % 10 = 0"
)

CHAT = """
WITH RECURSIVE t AS (
  SELECT conv_id, COALESCE(turn, 9223372036854775807) AS turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS o,
         len(regexp_extract_all(text, '[\\p{L}\\p{N}]+|[^\\p{L}\\p{N}\\s]')) + 3 AS tok,
         23 + length(replace(replace(role, '\\', '\\\\'), '<|', '<\\|'))
            + length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|')) AS frame
  FROM t
), sys AS (
  SELECT conv_id, turn, role, text, tok, frame FROM n WHERE role = 'system'
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY o) = 1
), w AS (
  SELECT n.conv_id, CAST(1 AS BIGINT) AS o, CAST(n.tok AS HUGEINT) AS s, CAST(0 AS HUGEINT) AS base, TRUE AS opens
  FROM n WHERE n.o = 1
  UNION ALL
  SELECT n.conv_id, n.o, w.s + n.tok,
         CASE WHEN (n.o - 1) % 512 = 0 OR w.s + n.tok - w.base > greatest(1, 1024 - COALESCE(sys.tok, 0) - 256) THEN w.s ELSE w.base END,
         (n.o - 1) % 512 = 0 OR w.s + n.tok - w.base > greatest(1, 1024 - COALESCE(sys.tok, 0) - 256)
  FROM w JOIN n ON n.conv_id IS NOT DISTINCT FROM w.conv_id AND n.o = w.o + 1
         LEFT JOIN sys ON sys.conv_id IS NOT DISTINCT FROM w.conv_id
), win AS (
  SELECT conv_id, o, lead(o) OVER (PARTITION BY conv_id ORDER BY o) AS nxt FROM w WHERE opens
), hist AS (
  SELECT win.conv_id, win.o, win.nxt,
         CASE WHEN a.tok <= 256 THEN CASE WHEN a.tok + b.tok <= 256 THEN 2 ELSE 1 END ELSE 0 END AS nh,
         a.frame AS fa, b.frame AS fb
  FROM win LEFT JOIN n a ON a.conv_id IS NOT DISTINCT FROM win.conv_id AND a.o = win.o - 1
           LEFT JOIN n b ON b.conv_id IS NOT DISTINCT FROM win.conv_id AND b.o = win.o - 2
), again AS (
  SELECT h.conv_id, sum(
    CASE WHEN nh >= 1 THEN fa ELSE 0 END + CASE WHEN nh = 2 THEN fb ELSE 0 END
    + CASE WHEN sys.role IS NOT NULL AND NOT EXISTS (
        SELECT 1 FROM n x WHERE x.conv_id IS NOT DISTINCT FROM h.conv_id AND x.o >= h.o - h.nh AND (h.nxt IS NULL OR x.o < h.nxt)
          AND x.turn = sys.turn AND x.role = sys.role AND x.text = sys.text) THEN sys.frame ELSE 0 END) AS repeated
  FROM hist h LEFT JOIN sys ON sys.conv_id IS NOT DISTINCT FROM h.conv_id GROUP BY h.conv_id
), c AS (
  SELECT conv_id, count(*) AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY o)) AS turns_sha256,
         CAST(COALESCE(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
         sha256(COALESCE(string_agg(text, '' ORDER BY o) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
         sum(frame) AS frames
  FROM n GROUP BY conv_id
)
SELECT c.conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, CAST(frames + repeated AS BIGINT) AS formatted_chars
FROM c JOIN again ON again.conv_id IS NOT DISTINCT FROM c.conv_id
"""


def url_sql(rules: list[tuple[str, str]], strength: float = 5.0, prior: float = 0.2, reject_at: float = 0.8) -> str:
    """The rules, then the template tree level by level, with the defaults of ``filter_urls``."""
    fits = []
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        host, slash, path = rule.partition("/")
        cond = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash}{path}')"
        fits.append((cond, rule, verdict))
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in fits) + " END"
    levels = []
    for k in range(DEPTH):
        apart = " OR ".join(
            f"COALESCE(e{x} > 0 AND abs(c{x} / cn - (a{x} - c{x}) / rest) > 3.0 * e{x}, FALSE)" for x in ("b", "g")
        )
        err = ", ".join(f"sqrt((a{x} / total) * (1 - a{x} / total) * (1 / cn + 1 / rest)) AS e{x}" for x in ("b", "g"))
        levels.append(f"""
k{k} AS (SELECT host, template, segs[{k + 1}] AS token, sum(n) AS cn, sum(bad) AS cb, sum(good) AS cg
         FROM t{k} WHERE len(segs) > {k} GROUP BY ALL),
p{k} AS (SELECT host, template, count(*) AS kids, sum(cn) AS total, sum(cb) AS ab, sum(cg) AS ag FROM k{k} GROUP BY ALL),
j{k} AS (SELECT *, {err} FROM (SELECT k.*, kids, total, ab, ag, NULLIF(total - cn, 0) AS rest
         FROM k{k} k JOIN p{k} p ON k.host = p.host AND k.template = p.template)),
s{k} AS (SELECT host, template, token,
                CASE WHEN kids > 1 AND NOT ({apart}) THEN '*' ELSE token END AS shown FROM j{k}),
t{k + 1} AS (SELECT t.host, t.segs, t.n, t.bad, t.good,
                    CASE WHEN s.shown IS NULL THEN t.template ELSE t.template || '/' || s.shown END AS template
             FROM t{k} t LEFT JOIN s{k} s ON len(t.segs) > {k} AND s.host = t.host AND s.template = t.template
                                          AND s.token = t.segs[{k + 1}])""")
    return f"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), a AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), b AS (
  SELECT *, {rule} AS rule, {verdict} AS rv,
         string_split(regexp_replace(regexp_replace(path, '^/', ''), '[0-9]+', '#', 'g'), '/') AS parts FROM a
), r AS (
  SELECT page_id, host, path, rule, rv,
         CASE WHEN len(parts) > {DEPTH}
              THEN list_append(parts[1:{DEPTH - 1}], array_to_string(parts[{DEPTH}:], '/')) ELSE parts END AS segs FROM b
), t0 AS (
  SELECT host, segs, count(*) AS n, count(*) FILTER (WHERE rv = 'block') AS bad, count(*) FILTER (WHERE rv = 'allow') AS good,
         '' AS template FROM r GROUP BY host, segs
), {",".join(levels)},
q AS (SELECT host, template, (sum(bad) + {strength * prior}) / (sum(bad) + sum(good) + {strength}) AS purity
      FROM t{DEPTH} GROUP BY ALL)
SELECT r.page_id, r.host, r.path, r.rule,
       COALESCE(r.rv, CASE WHEN q.purity >= {reject_at} THEN 'block' ELSE 'allow' END) AS verdict, t.template, q.purity
FROM r JOIN t{DEPTH} t ON t.host = r.host AND t.segs = r.segs JOIN q ON q.host = t.host AND q.template = t.template
"""


def secrets_sql() -> str:
    """Every kind by splitting the text at its matches; checksums bit by bit and digit by digit."""
    kinds = [
        ("assign", secrets.ASSIGN, "length(regexp_extract(m, pat, 2)) >= 6", ""),
        ("access", secrets.ACCESS, "length(m) >= 20", ""),
        ("hex", secrets.HEX_RUN, "length(m) >= 24", ""),
        ("host_token", secrets.HOST_TOKEN, CRC_TOKEN, ""),
        ("package_token", secrets.PACKAGE_TOKEN, CRC_TOKEN, ""),
        ("card", secrets.CARD, LUHN, "length(m) - length(regexp_extract(m, pat, 1))"),
    ]
    parts = []
    for i, (kind, pattern, holds, lead) in enumerate(kinds):
        quoted = pattern.replace("'", "''")
        parts.append(f"""
  SELECT doc_id, rid, {i} AS k, '{kind}' AS kind, start + {lead or 0} AS start, start + length(m) AS stop
  FROM (SELECT doc_id, rid, pat, hits[i] AS m,
               CAST(list_sum(list_transform(gaps[:i], lambda x: length(x))) + COALESCE(list_sum(list_transform(hits[:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start
        FROM (SELECT doc_id, rid, pat, hits, regexp_split_to_array(text, pat) AS gaps, unnest(range(1, len(hits) + 1)) AS i
              FROM (SELECT doc_id, rid, text, '{quoted}' AS pat, regexp_extract_all(text, '{quoted}') AS hits FROM d)))
  WHERE {holds}""")
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, COALESCE(text, '') AS text FROM documents), s AS ({" UNION ALL".join(parts)}
), j AS (
  SELECT rid, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access, count(*) FILTER (WHERE k = 2) AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) FILTER (WHERE k < 3) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) AS spans
  FROM s GROUP BY rid
)
SELECT d.doc_id, COALESCE(n_assign, 0) AS n_assign, COALESCE(n_access, 0) AS n_access, COALESCE(n_hex, 0) AS n_hex,
       sha256(COALESCE(base, '')) AS base_sha256, COALESCE(spans, '') AS spans
FROM d LEFT JOIN j ON j.rid = d.rid
"""


SEARCH = """
WITH t AS (
  SELECT rid, doc_id, unnest(words) AS term, len(words) AS n
  FROM (SELECT rid, doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
        FROM (SELECT row_number() OVER () AS rid, * FROM documents))
), p AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM t GROUP BY ALL),
c AS (SELECT count(DISTINCT rid) AS n_docs, count(*) AS total FROM t),
d AS (SELECT term, count(*) AS df FROM p GROUP BY term),
q AS (
  SELECT DISTINCT qid, item_id, unnest(regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS qid, * FROM benchmark)
), s AS (
  SELECT qid, item_id, rid, doc_id,
         sum(CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT)
             * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // total))))) AS score
  FROM q JOIN p USING (term) JOIN d USING (term), c GROUP BY ALL
)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= 50
"""


TRIE = f"""
WITH t AS (
  SELECT conv_id, turn, substr(sha256(strlen(COALESCE(role, '')) || ':' || COALESCE(role, '') || COALESCE(text, '')), 1, 32) AS id,
         strlen(COALESCE(text, '')) AS size
  FROM conversations WHERE conv_id IS NOT NULL
), n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) - 1 AS pos FROM t
), c AS (
  SELECT conv_id, n, {crc32_sql("CAST(conv_id AS VARCHAR)")} % 9 AS h, conv_id - conv_id % 5 AS base
  FROM (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id)
), r AS (
  SELECT c.conv_id, n.pos, n.id, n.size FROM c JOIN n ON n.conv_id = c.base AND n.pos < c.h
  UNION ALL
  SELECT c.conv_id, least(c.h, COALESCE(b.n, 0)) + n.pos - c.h, n.id, n.size
  FROM c JOIN n ON n.conv_id = c.conv_id AND n.pos >= c.h LEFT JOIN c b ON b.conv_id = c.base
), s AS (
  SELECT c.conv_id, COALESCE(list(r.id ORDER BY r.pos) FILTER (WHERE r.id IS NOT NULL), []) AS ids,
         COALESCE(list(r.size ORDER BY r.pos) FILTER (WHERE r.id IS NOT NULL), []) AS sizes
  FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id
), p AS (
  SELECT conv_id, d, array_to_string(ids[:d], '') AS key, array_to_string(ids[:d - 1], '') AS up, sizes[d] AS size, len(ids) = d AS ends
  FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS d FROM s)
), v AS (
  SELECT key, d, min(CASE WHEN d > 0 THEN up END) AS up, min(conv_id) AS conv_id, count(*) AS n, COALESCE(min(size), 0) AS size,
         sha256(COALESCE(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM p GROUP BY key, d
), k AS (SELECT up AS key, count(*) AS kids FROM v WHERE d > 0 GROUP BY up),
a AS (SELECT v.*, COALESCE(k.kids, 0) AS kids FROM v LEFT JOIN k ON k.key = v.key),
w AS (
  SELECT substr(key, 1, 32 * e) AS key, sum(CASE WHEN kids = 0 THEN 1 ELSE 0 END) AS leaves, sum((n - 1) * size) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM a) GROUP BY 1
)
SELECT a.conv_id, CAST(a.d AS BIGINT) AS depth, o.conv_id AS parent_conv_id, a.n AS n_convs, a.kids AS n_children,
       CAST(w.leaves AS BIGINT) AS n_leaves, CAST(w.saved AS BIGINT) AS saved_tokens, a.ends_sha256
FROM a JOIN w ON w.key = a.key LEFT JOIN v o ON o.key = a.up AND a.d > 0
"""
