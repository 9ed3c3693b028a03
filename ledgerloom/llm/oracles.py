"""The registered queries as SQL over the tables."""

from __future__ import annotations

from ledgerloom.llm import pii, url_filter


def _hits(kind: str, order: int, pattern: str) -> str:
    pattern = pattern.replace("'", "''")
    return (
        f"SELECT rid, t, '{kind}' AS kind, {order} AS k, regexp_extract_all(t, '{pattern}') AS hits, "
        f"string_split_regex(t, '{pattern}') AS gaps FROM d"
    )


_IBAN = r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}\b"
_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_BARE = "replace(v, ' ', '')"

PII = f"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), m AS (
    {_hits("email", 1, pii.EMAIL)}
    UNION ALL {_hits("ip", 2, pii.IP)}
    UNION ALL {_hits("card", 3, pii.CARD)}
    UNION ALL {_hits("phone", 4, pii.PHONE)}
    UNION ALL {_hits("iban", 5, _IBAN)}
    UNION ALL {_hits("ssn", 6, "[0-9A-Za-z_-]*[0-9]{3}-[0-9]{2}-[0-9]{4}[0-9A-Za-z_-]*")}
), u AS (
    SELECT rid, t, kind, k, hits[i] AS v,
        coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)
            + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS s
    FROM m, unnest(range(1, len(hits) + 1)) AS n(i)
), c AS (
    SELECT *, {_DIGITS} AS g, length({_DIGITS}) AS n,
        list_transform(string_split(substr({_BARE}, 5) || substr({_BARE}, 1, 4), ''),
            lambda x: CASE WHEN ascii(x) >= 65 THEN CAST(ascii(x) - 55 AS VARCHAR) ELSE x END) AS turned
    FROM u
), ok AS (
    SELECT rid, kind, k, CAST(s AS BIGINT) AS s, CAST(s + length(v) AS BIGINT) AS e FROM c
    WHERE CASE kind
        WHEN 'ip' THEN list_bool_and(list_transform(string_split(v, '.'),
            lambda x: length(ltrim(x, '0')) <= 3 AND CAST('0' || right(ltrim(x, '0'), 4) AS INT) <= 255))
        WHEN 'card' THEN n BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, n + 1), lambda i:
            CASE WHEN i % 2 = 1 THEN CAST(substr(reverse(g), i, 1) AS INT)
                WHEN CAST(substr(reverse(g), i, 1) AS INT) > 4 THEN 2 * CAST(substr(reverse(g), i, 1) AS INT) - 9
                ELSE 2 * CAST(substr(reverse(g), i, 1) AS INT) END)) % 10 = 0
        WHEN 'phone' THEN n BETWEEN 8 AND 15
        WHEN 'iban' THEN list_reduce(list_transform(string_split(array_to_string(turned, ''), ''),
            lambda x: CAST(x AS INT)), lambda a, b: (a * 10 + b) % 97) = 1
        WHEN 'ssn' THEN length(v) = 11 AND regexp_matches(
            lower(substr(t, greatest(CAST(s AS INT) - 39, 1), least(CAST(s AS INT), 40))), '{pii.CONTEXT_WORDS["ssn"]}')
        ELSE true END
), j AS (
    SELECT rid,
        count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
        count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) FILTER (k <= 4) AS base,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) AS spans
    FROM ok GROUP BY rid
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
    coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN j USING (rid)
"""


def _fits(host: str, path: str) -> str:
    return (
        f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"
    )


_BY_LENGTH = sorted(url_filter.RULES, key=lambda r: (-len(r[0] + r[1]), -len(r[0])))
_RULE = " ".join(f"WHEN {_fits(h, p)} THEN '{h}{p}'" for h, p, _ in _BY_LENGTH)
_VERDICT = " ".join(f"WHEN rule = '{h}{p}' THEN '{v}'" for h, p, v in _BY_LENGTH)

URL_FILTER = f"""
WITH r AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), p AS (
    SELECT page_id, rest,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
        list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), '&'),
            lambda x: x <> '' AND NOT regexp_matches(x, '{url_filter.TRACKING}'))) AS params
    FROM r
), c AS (
    SELECT page_id, host, path, CASE {_RULE} END AS rule,
        CASE WHEN host <> '' THEN host || regexp_replace(path, '/+$', '')
            || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS canonical
    FROM p
), l AS (
    SELECT canonical FROM c WHERE canonical IS NOT NULL GROUP BY canonical HAVING count(*) > 1
), f AS (
    SELECT c.page_id, host, path, rule, l.canonical IS NOT NULL AS listed FROM c LEFT JOIN l USING (canonical)
)
SELECT page_id, host, path, rule, CASE {_VERDICT} WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed
FROM f
"""

TOP_K = """
WITH v AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, max(CAST(list_inner_product(q.v, c.v) AS BIGINT)) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
    GROUP BY ALL
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank,
    vec_id, score
FROM s QUALIFY rank <= 10
"""

CONVERSATIONS = """
WITH m AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
), t AS (
    SELECT conv_id, turn, bool_or(trim(text) <> '') AS says FROM m GROUP BY ALL
), o AS (
    SELECT conv_id, turn, lag(turn) OVER w AS parent_turn, first_value(turn) OVER w AS root_turn,
        row_number() OVER w - 1 AS depth
    FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
), q AS (
    SELECT a.conv_id, a.turn, count(*) AS n FROM t a JOIN t b
    ON a.conv_id = b.conv_id AND b.turn IN (a.turn - 1, a.turn - 2) AND b.says GROUP BY ALL
)
SELECT m.conv_id, m.turn, role, trim(text, chr(10)) AS text, parent_turn, root_turn, depth,
    coalesce(n, 0) AS n_quotes, coalesce(n, 0) AS n_linked
FROM m LEFT JOIN o USING (conv_id, turn) LEFT JOIN q USING (conv_id, turn)
"""


# --- spelling variants ---------------------------------------------------------------------------


def _crc32_table() -> list[int]:
    """The table of the CRC-32 checksum, by its rule."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


def _lower(text: str) -> str:
    """A to Z in lower case, all else as it is."""
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


SPELLING = f"""
WITH RECURSIVE crc AS (SELECT {_crc32_table()}::BIGINT[] AS t),
runs AS (
  SELECT doc_id, run, COUNT(*) AS k FROM (
    SELECT doc_id, UNNEST(regexp_extract_all({_lower('text')}, '[a-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 5 GROUP BY 1, 2),
bytes AS (SELECT *, hex(encode(COALESCE(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM runs),
hashed AS (
  SELECT run, k, xor(4294967295, list_reduce(list_transform(range(0, length(x) // 2),
    lambda i: CAST('0x' || substr(x, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)),
    lambda c, b: xor(c >> 8, crc.t[xor(c & 255, b) + 1]), CAST(4294967295 AS BIGINT))) AS h
  FROM bytes, crc),
slipped AS (
  SELECT CASE WHEN h % 97 <> 0 THEN run
    ELSE substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) END AS word, k FROM hashed),
words AS (
  SELECT word, CAST(SUM(k) AS BIGINT) AS n FROM slipped WHERE length(word) >= 5 GROUP BY 1 HAVING SUM(k) >= 3),
holes AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, UNNEST(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON w.word = h.rest
  UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON w.word = h.rest),
best AS (
  SELECT word, COUNT(*) AS n_near, FIRST(other ORDER BY other_n DESC, other) AS other, MAX(other_n) AS other_n
  FROM near GROUP BY 1),
formed AS (
  SELECT word, n, COALESCE(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * n THEN other END AS form,
    CASE WHEN other_n >= 2 * n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
steps AS (
  SELECT word, word AS at FROM words
  UNION SELECT s.word, f.form FROM steps s JOIN formed f ON f.word = s.at WHERE f.form IS NOT NULL),
roots AS (SELECT s.word, s.at AS root FROM steps s JOIN formed f ON f.word = s.at WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
"""


# --- phrases -------------------------------------------------------------------------------------

PHRASES = f"""
WITH pieces AS (
  SELECT COALESCE(lang, 'und') AS lang, UNNEST(string_split_regex({_lower("COALESCE(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\x09]+'), lambda x: x <> '') AS ws FROM pieces),
runs AS (SELECT lang, UNNEST(list_zip(ws, ws[2:], ws[3:])) AS t FROM lists),
words AS (SELECT lang, t[1] AS x, t[2] AS y, t[3] AS z FROM runs),
sizes AS (SELECT lang, COUNT(*) AS n FROM words GROUP BY 1),
f1 AS (SELECT lang, x, COUNT(*) AS f FROM words GROUP BY ALL HAVING COUNT(*) >= 10),
f2 AS (SELECT lang, x, y, COUNT(*) AS f FROM words WHERE y IS NOT NULL GROUP BY ALL HAVING COUNT(*) >= 10),
f3 AS (SELECT lang, x, y, z, COUNT(*) AS f FROM words WHERE z IS NOT NULL GROUP BY ALL HAVING COUNT(*) >= 10),
inside AS (SELECT lang, x, y, f FROM f3 UNION ALL SELECT lang, y, z, f FROM f3),
longer AS (SELECT lang, x, y, MAX(f) AS f FROM inside GROUP BY ALL),
cuts AS (
  SELECT c.lang, c.x || ' ' || c.y AS phrase, c.f AS a, 1 AS k, p.f AS l, q.f AS r
  FROM f2 c JOIN f1 p ON p.lang = c.lang AND p.x = c.x JOIN f1 q ON q.lang = c.lang AND q.x = c.y
  LEFT JOIN longer i ON i.lang = c.lang AND i.x = c.x AND i.y = c.y WHERE i.f IS NULL OR 100 * i.f < 50 * c.f
  UNION ALL SELECT c.lang, c.x || ' ' || c.y || ' ' || c.z, c.f, 1, p.f, q.f
  FROM f3 c JOIN f1 p ON p.lang = c.lang AND p.x = c.x JOIN f2 q ON q.lang = c.lang AND q.x = c.y AND q.y = c.z
  UNION ALL SELECT c.lang, c.x || ' ' || c.y || ' ' || c.z, c.f, 2, p.f, q.f
  FROM f3 c JOIN f2 p ON p.lang = c.lang AND p.x = c.x AND p.y = c.y JOIN f1 q ON q.lang = c.lang AND q.x = c.z),
scored AS (SELECT *, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
low AS (SELECT * FROM scored QUALIFY ROW_NUMBER() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, CAST(ROW_NUMBER() OVER w AS BIGINT) AS rank, phrase, a, l, r, n, score
FROM low JOIN sizes USING (lang) WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY ROW_NUMBER() OVER w <= 2000
"""


# --- near-duplicate vectors ----------------------------------------------------------------------

EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
usable AS (
  SELECT vec_id, label, e FROM v
  WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
lowest AS (SELECT a AS vec_id, MIN(b) AS component_id FROM reach GROUP BY 1),
counts AS (SELECT a AS vec_id, COUNT(*) AS n FROM links GROUP BY 1)
SELECT vec_id, COALESCE(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM lowest LEFT JOIN counts USING (vec_id)
"""
