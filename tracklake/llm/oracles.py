"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# The polynomial of the CRC-32 of zip files is a fixed value.
CRC = """crc_table AS (SELECT list(v ORDER BY n) AS t FROM (SELECT n, list_reduce(range(8), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, n) AS v FROM (SELECT unnest(range(256)) AS n))),
digits AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
bytes AS (SELECT doc_id, list_transform(range(0, length(h) // 2), lambda i: (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', h[2 * i + 2]) - 1) AS b FROM digits),
crcs AS (SELECT doc_id, xor(list_reduce(b, lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]), 4294967295), 4294967295) AS text_crc32 FROM bytes, crc_table)"""


def kd_shards(levels: int = 4) -> str:
    """The tree level by level: coordinates by shares of bytes, and in each node the first key at which
    the running sum of bytes passes half; that key's rows go where they bring the halves closer."""
    parts = [
        CRC,
        "base AS (SELECT doc_id, (octet_length(encode(coalesce(text, ''))) + 1)::BIGINT AS size, source, lang, ('0x' || substr(CASE number WHEN 1 THEN own ELSE md5(own || ':' || number) END, 1, 10))::BIGINT AS spread FROM (SELECT *, md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS own, row_number() OVER (PARTITION BY doc_id, text) AS number FROM documents))",
        "valued AS (SELECT *, floor(log2(size::DOUBLE) * 64)::BIGINT AS octave FROM base)",
    ]
    for i, value in enumerate(("source", "lang", "octave")):
        parts.append(f"""codes_{i} AS (SELECT {value} AS v, least(1048575, floor((2 * upto - own)::DOUBLE / (2 * whole) * 1048576))::BIGINT AS code_{i} FROM (SELECT {value}, own, sum(own) OVER (ORDER BY {value} NULLS FIRST) AS upto, sum(own) OVER () AS whole FROM (SELECT {value}, sum(size) AS own FROM valued GROUP BY 1)))""")
    parts.append("level_0 AS (SELECT doc_id, size, spread, code_0, code_1, code_2, 0 AS node FROM valued JOIN codes_0 ON source IS NOT DISTINCT FROM codes_0.v JOIN codes_1 ON lang IS NOT DISTINCT FROM codes_1.v JOIN codes_2 ON octave IS NOT DISTINCT FROM codes_2.v)")
    for k in range(levels):
        half = 1 << (levels - 1 - k)
        parts += [
            f"axis_{k} AS (SELECT node, sum(size) / 2.0 AS need, CASE WHEN w0 >= w1 AND w0 >= w2 THEN 0 WHEN w1 >= w2 THEN 1 ELSE 2 END AS axis FROM (SELECT node, size, max(code_0) OVER n - min(code_0) OVER n AS w0, max(code_1) OVER n - min(code_1) OVER n AS w1, max(code_2) OVER n - min(code_2) OVER n AS w2 FROM level_{k} WINDOW n AS (PARTITION BY node)) GROUP BY ALL)",
            f"keyed_{k} AS (SELECT l.*, a.need, (CASE axis WHEN 0 THEN code_0 WHEN 1 THEN code_1 ELSE code_2 END) * 1099511627776 + spread AS key FROM level_{k} l JOIN axis_{k} a USING (node))",
            f"sums_{k} AS (SELECT node, key, need, s, sum(s) OVER (PARTITION BY node ORDER BY key) AS upto FROM (SELECT node, key, need, sum(size) AS s FROM keyed_{k} GROUP BY ALL))",
            f"cuts_{k} AS (SELECT node, key AS cut, 2 * (need - (upto - s)) >= s AS whole FROM sums_{k} WHERE upto > need QUALIFY row_number() OVER (PARTITION BY node ORDER BY key) = 1)",
            f"level_{k + 1} AS (SELECT doc_id, size, spread, code_0, code_1, code_2, node + CASE WHEN key > cut OR (key = cut AND NOT whole) THEN {half} ELSE 0 END AS node FROM keyed_{k} JOIN cuts_{k} USING (node))",
        ]
    return f"""WITH {", ".join(parts)} SELECT doc_id, size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, node::INT AS shard, (row_number() OVER (PARTITION BY node ORDER BY spread, doc_id, size, text_crc32) - 1)::BIGINT AS slot, NULL::INT AS grown_shard FROM level_{levels} JOIN crcs USING (doc_id)"""


NEAR = rf"""WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({LOWER}, '{WORD}') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN coalesce(len(w), 0) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM flat a JOIN flat b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT doc_id, doc_id FROM sets UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, min(r.b) AS component_id, doc_id = min(r.b) AS kept FROM sets JOIN reach r ON r.a = doc_id GROUP BY doc_id, s"""

EXACT = """WITH usable AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (SELECT q.vec_id AS query_id, o.vec_id AS vec_id, list_inner_product(q.v, o.v)::BIGINT AS score FROM usable q JOIN usable o ON o.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)) WHERE rank <= 20"""

MIX = rf"""WITH sizes AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 9))::BIGINT AS place FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY 1),
ranked AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, (3 * source_size)::DOUBLE AS cap FROM totals),
levels AS (SELECT *, cap / weight AS ratio, (sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ranked WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
shared AS (SELECT *, (SELECT level FROM levels WHERE level <= ratio ORDER BY ratio, level LIMIT 1) AS held FROM levels),
targets AS (SELECT source, source_size, least(cap, weight * coalesce(held, ratio)) AS target FROM shared),
budgets AS (SELECT *, CASE WHEN source_size > 0 THEN least(3.0, floor(target / source_size))::BIGINT ELSE 0 END AS whole FROM targets),
cells AS (SELECT s.source, place, sum(size) AS size, sum(sum(size)) OVER (PARTITION BY s.source ORDER BY place) AS upto, any_value(target - whole * source_size) AS need FROM sizes s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source GROUP BY s.source, place),
cuts AS (SELECT source, place + CASE WHEN 2 * (need - upto + size) >= size THEN 1 ELSE 0 END AS cut FROM cells WHERE upto > need QUALIFY row_number() OVER (PARTITION BY source ORDER BY place) = 1)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM (SELECT s.*, source_size, target, whole + CASE WHEN place < coalesce(cut, 0) THEN 1 ELSE 0 END AS copies FROM sizes s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source LEFT JOIN cuts c ON s.source IS NOT DISTINCT FROM c.source)"""

PRIVATE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    "ip": (r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "len(list_filter(string_split(v, '.'), lambda p: p::DOUBLE > 255)) = 0"),
    "card": (r"[0-9](?:[\x20-]?[0-9])+", "length(d) BETWEEN 16 AND 19 AND list_sum(list_transform(range(length(d)), lambda i: CASE WHEN i % 2 = 0 THEN d[length(d) - i]::INT WHEN d[length(d) - i]::INT > 4 THEN 2 * d[length(d) - i]::INT - 9 ELSE 2 * d[length(d) - i]::INT END)) % 10 = 0"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "length(d) BETWEEN 8 AND 15"),
}


def _found(name: str, source: str, pattern: str, more: str = "") -> str:
    """Matches of a pattern with their places in code points, from the matches and the gaps between them."""
    return f"""{name}_lists AS (SELECT doc_id{more}, regexp_extract_all(t, '{pattern}') AS f, regexp_split_to_array(t, '{pattern}') AS g FROM {source}),
{name} AS (SELECT doc_id{more}, f[i] AS v, (list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0))::BIGINT AS a FROM (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM {name}_lists))"""


def private() -> str:
    """Base spans by kind; then the terms that tell of their values, counted over distinct texts."""
    ctes = ["docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)"]
    for kind, (pattern, test) in PRIVATE.items():
        ctes.append(_found(f"all_{kind}", "docs", pattern))
        ctes.append(f"own_{kind} AS (SELECT doc_id, '{kind}' AS kind, a, a + length(v) AS b, v FROM (SELECT *, regexp_replace(v, '[^0-9]', '', 'g') AS d FROM all_{kind}) WHERE {test})")
    ctes += [
        "base AS (" + " UNION ALL ".join(f"SELECT *, {k} AS k FROM own_{kind}" for k, kind in enumerate(PRIVATE)) + ")",
        "held AS (SELECT DISTINCT doc_id, kind || ':' || lower(v) AS entity FROM base)",
        "texts AS (SELECT min(doc_id) AS doc_id, t FROM docs GROUP BY t)",
        "known AS (SELECT entity, count(*) AS n_entity FROM held SEMI JOIN texts USING (doc_id) GROUP BY 1 HAVING count(*) >= 3)",
        r"terms AS (SELECT doc_id, unnest(list_distinct(list_filter(regexp_split_to_array(lower(t), '[\x20\x09-\x0D]+'), lambda w: regexp_matches(w, '\p{L}')))) AS term FROM texts)",
        "n_term AS (SELECT term, count(*) AS n_term FROM terms GROUP BY 1)",
        "both_counts AS (SELECT entity, any_value(n_entity) AS n_entity, term, count(*) AS n_both FROM held JOIN known USING (entity) JOIN terms USING (doc_id) GROUP BY entity, term HAVING count(*) >= 3 AND NOT contains(entity, term))",
        "flagged AS (SELECT entity, term FROM both_counts JOIN n_term USING (term), (SELECT count(*) AS n FROM texts) WHERE ln(n::DOUBLE * n_both / (greatest(n_term, n_both) * n_entity)) >= 0.8 * ln(n::DOUBLE / n_entity))",
        "tellers AS (SELECT d.doc_id, t FROM docs d SEMI JOIN (SELECT doc_id FROM held JOIN flagged USING (entity)) h ON d.doc_id = h.doc_id)",
        _found("placed", "tellers", WORD),
        r"hits AS (SELECT DISTINCT p.doc_id, a, a + length(v) AS b FROM placed p JOIN held h ON p.doc_id = h.doc_id JOIN flagged f ON f.entity = h.entity AND f.term = lower(p.v) WHERE regexp_matches(v, '\p{L}'))",
        "free AS (SELECT * FROM hits h WHERE NOT EXISTS (SELECT 1 FROM base x WHERE x.doc_id = h.doc_id AND x.a < h.b AND h.a < x.b))",
        "shown AS (SELECT doc_id, kind, k, a, kind || ':' || a || ':' || b AS s FROM base UNION ALL SELECT doc_id, 'term', 9, a, 'term:' || a || ':' || b FROM free)",
    ]
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in PRIVATE)
    return f"""WITH {", ".join(ctes)} SELECT docs.doc_id, {counts}, sha256(coalesce(string_agg(s, ',' ORDER BY k, a) FILTER (kind <> 'term'), '')) AS base_sha256, coalesce(string_agg(s, ',' ORDER BY k, a), '') AS spans FROM docs LEFT JOIN shown ON docs.doc_id = shown.doc_id GROUP BY docs.doc_id"""

# The phrases of a language with their counts, their cuts, and what a longer phrase with most of the count takes out.
PHRASES = rf"""WITH texts AS (SELECT coalesce(lang, 'und') AS lang, {LOWER.replace("text,", "coalesce(text, ''),")} AS t FROM documents),
cut AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM texts),
split AS (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM cut),
piece AS (SELECT lang, w, count(*) AS m FROM split WHERE len(w) > 0 GROUP BY ALL),
total AS (SELECT lang, sum(m * len(w))::BIGINT AS n FROM piece GROUP BY 1),
gram AS (SELECT lang, k AS size, array_to_string(w[i:i + k - 1], ' ') AS phrase, sum(m)::BIGINT AS f FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT *, unnest([1, 2, 3, 4]) AS k FROM piece) WHERE len(w) >= k) GROUP BY ALL HAVING sum(m) >= 30),
candidate AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM gram WHERE size > 1),
parts AS (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest FROM (SELECT *, unnest(range(1, size)) AS k FROM candidate)),
scored AS (SELECT p.lang, p.phrase, a, k, x.f AS l, y.f AS r, ((2000000::HUGEINT * a) // (x.f + y.f))::BIGINT AS score FROM parts p JOIN gram x ON x.lang = p.lang AND x.phrase = p.first JOIN gram y ON y.lang = p.lang AND y.phrase = p.rest),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_parts AS (SELECT lang, a, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT *, unnest(range(1, size - k + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS k FROM candidate WHERE size > 2))),
covers AS (SELECT lang, phrase, max(a) AS cover FROM inner_parts GROUP BY ALL)
SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT w.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst w LEFT JOIN covers c USING (lang, phrase) WHERE cover IS NULL OR 100::HUGEINT * cover < 80::HUGEINT * a) JOIN total USING (lang) WHERE rank <= 2000"""

# Row by row, the cheapest edits that reach each state of the roles (0 none, 1 system, 2 user, 3 assistant).
REPAIR = r"""WITH RECURSIVE crc_table AS (SELECT list(v ORDER BY n) AS t FROM (SELECT n, list_reduce(range(8), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, n) AS v FROM (SELECT unnest(range(256)) AS n))),
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
hit AS (SELECT *, xor(list_reduce(list_transform(range(1, length(k) + 1), lambda i: ascii(k[i])::BIGINT), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 20 AS what FROM named, crc_table),
hurt AS (SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role, CASE what WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN what = 3 THEN 2 ELSE 1 END)) AS copy FROM hit WHERE what <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again, right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS tip FROM hurt),
judged AS (SELECT conv_id, i, turn, role, text, left(role, 1) AS c, CASE WHEN tip = '' THEN 1 WHEN again > 1 THEN 2 WHEN tip NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM placed),
insertion(q, q1, put, said) AS (VALUES (0, 0, 0, ''), (0, 2, 3, 'I'), (0, 3, 6, 'II'), (1, 1, 0, ''), (1, 2, 3, 'I'), (1, 3, 6, 'II'), (2, 2, 0, ''), (2, 3, 3, 'I'), (3, 3, 0, ''), (3, 2, 3, 'I')),
edit(q1, c, q2, price, letter) AS (VALUES (0, 's', 1, 0, 'K'), (0, 'u', 2, 0, 'K'), (1, 'u', 2, 0, 'K'), (3, 'u', 2, 0, 'K'), (2, 'a', 3, 0, 'K'), (0, NULL, 2, 3, 'R'), (1, NULL, 2, 3, 'R'), (3, NULL, 2, 3, 'R'), (2, NULL, 3, 3, 'R'), (0, NULL, 0, 4, 'D'), (1, NULL, 1, 4, 'D'), (2, NULL, 2, 4, 'D'), (3, NULL, 3, 4, 'D')),
best(conv_id, i, q, b) AS (SELECT DISTINCT conv_id, 0::BIGINT, 0, {'cost': 0, 'audit': ''} FROM conversations
UNION ALL SELECT b.conv_id, j.i, e.q2, min({'cost': b.b.cost + s.put + e.price + CASE WHEN j.fault = 3 AND e.letter <> 'D' THEN 3 ELSE 0 END, 'audit': b.b.audit || s.said || e.letter})
FROM best b JOIN judged j ON j.conv_id IS NOT DISTINCT FROM b.conv_id AND j.i = b.i + 1 JOIN insertion s ON s.q = b.q JOIN edit e ON e.q1 = s.q1 AND (e.c IS NULL OR e.c = j.c) AND (j.fault IN (0, 3) OR e.letter = 'D') GROUP BY b.conv_id, j.i, e.q2),
ends AS (SELECT b.conv_id, min({'cost': b.b.cost + s.put, 'audit': b.b.audit || s.said}) AS b FROM best b JOIN (SELECT conv_id, max(i) AS i FROM best GROUP BY 1) m ON m.conv_id IS NOT DISTINCT FROM b.conv_id AND m.i = b.i JOIN insertion s ON s.q = b.q AND s.q1 IN (0, 3) GROUP BY b.conv_id),
letters AS (SELECT conv_id, p, b.audit[p] AS letter, length(replace(b.audit[1:p], 'I', '')) AS i, length(replace(b.audit[1:p], 'D', '')) AS place FROM (SELECT *, unnest(range(1, length(b.audit) + 1)) AS p FROM ends)),
said AS (SELECT l.*, j.role, j.text, j.c, max(CASE WHEN l.letter = 'K' AND j.c = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS head FROM letters l LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM l.conv_id AND j.i = l.i),
mended AS (SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - head) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS t FROM said WHERE letter <> 'D' GROUP BY 1),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (before || c NOT IN ('su', 'ua', 'au')) AS illegal FROM (SELECT *, lag(c) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM judged) GROUP BY 1)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, e.b.cost::BIGINT AS cost, e.b.audit AS audit, sha256(coalesce(m.t, '')) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN mended m ON m.conv_id IS NOT DISTINCT FROM e.conv_id"""


ORACLE_SQL = {"op2_kd_shards": kd_shards(), "op4_near_duplicates": NEAR, "op6_sanitise": private(), "op7_va_file": EXACT, "op9_mix_sources": MIX, "op11_collocations": PHRASES, "op13_conversation_repair": REPAIR}
