"""DuckDB SQL of the queries of this subpackage that SQL can express."""

from __future__ import annotations


def all_oracles() -> dict[str, str]:
    return {
        "op1_exact_dedup": OP1, "op2_quote_links": OP2, "op4_byte_shards": OP4, "op6_benchmark_containment": OP6,
        "op8_jaccard_links": OP8, "op9_weighted_mixture": OP9, "op10_repeated_passages": OP10,
        "op12_prefix_trie": OP12, "op13_importance_resampling": OP13,
    }


OP1 = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256,
         length(coalesce(text, '')) AS n
  FROM documents
), r AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w = 1 AS kept,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM r
"""

# Lower-cased words of a text, as a list.
_WORDS = (
    r"list_filter(string_split_regex(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[\x20\x09-\x0D]+'), lambda x: x <> '')"
)

OP6 = f"""
WITH b AS (SELECT item_id, {_WORDS.format(text="text")} AS w FROM benchmark),
i AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS s
  FROM (SELECT *, least(5, len(w)) AS n, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS p FROM b WHERE len(w) > 0)
),
size AS (SELECT item_id, count(*) AS n_shingles FROM i GROUP BY item_id),
d AS (SELECT doc_id, {_WORDS.format(text="text")} AS w FROM documents WHERE text IS NOT NULL),
lengths AS (SELECT DISTINCT n FROM i),
s AS (
  SELECT DISTINCT doc_id, n, array_to_string(w[p:p + n - 1], ' ') AS s
  FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM d, lengths)
),
m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM s JOIN i USING (n, s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment
FROM m JOIN size USING (item_id) WHERE 100 * n_shared >= 80 * n_shingles
"""

OP10 = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
),
p AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
),
o AS (SELECT h, min(doc_id) AS origin FROM p GROUP BY h),
f AS (SELECT doc_id, list(i ORDER BY i) AS s FROM p JOIN o USING (h) WHERE doc_id > origin GROUP BY doc_id),
g AS (SELECT doc_id, list_distinct(flatten(list_transform(s, lambda x: range(x, x + 50)))) AS gone FROM f),
x AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (
  SELECT x.doc_id, string_agg(w[x.i], ' ' ORDER BY x.i) AS kept, count(*) AS n
  FROM x LEFT JOIN (SELECT doc_id, unnest(gone) AS i FROM g) r ON r.doc_id = x.doc_id AND r.i = x.i
  WHERE r.i IS NULL GROUP BY x.doc_id
)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

OP8 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + n - 1], ' ') AS s, n
  FROM (SELECT *, least(5, len(w)) AS n, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS p FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
  FROM s a JOIN s b ON a.s = b.s AND a.n = b.n AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
l AS (
  SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)
),
r AS (SELECT doc_id, doc_id AS seen FROM d UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.seen)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY doc_id) c USING (doc_id)
"""


def _level(number: int, path: str, parent: str, weight: str) -> str:
    """Budgets of one level: water-filling among the children of each parent."""
    over = f"PARTITION BY {parent}" if parent else ""
    join = f"JOIN g{number - 1} USING ({parent})" if parent else ", (SELECT least(0.5 * sum(n_words), sum(cap)) AS given FROM leaf)"
    name = path.split(", ")[-1]
    return f"""
n{number} AS (
  SELECT {path}, c.cap, {weight} AS wt, given AS budget, c.cap / {weight} AS need
  FROM (SELECT {path}, sum(cap) AS cap FROM leaf GROUP BY {path}) c {join}
),
f{number} AS (
  SELECT *, cap * sum(wt) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    <= wt * (budget - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS is_full
  FROM n{number} WINDOW w AS ({over} ORDER BY need, {name})
),
g{number} AS (
  SELECT {path}, CASE WHEN is_full THEN cap ELSE wt
    * (budget - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({over}))
    / sum(CASE WHEN is_full THEN 0 ELSE wt END) OVER ({over}) END AS given
  FROM f{number}
)"""


OP9 = r"""
WITH d AS (
  SELECT doc_id, 'd' || (CAST(regexp_extract(source, '[0-9]+') AS INT) // 5) AS domain, lang, source,
         len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n_words
  FROM documents
),
leaf AS (SELECT domain, lang, source, sum(n_words)::DOUBLE AS n_words, sum(n_words)::DOUBLE * 4 AS cap FROM d GROUP BY ALL),
""" + ",".join([
    _level(1, "domain", "", "CASE domain WHEN 'd0' THEN 0.4::DOUBLE WHEN 'd1' THEN 0.3 WHEN 'd2' THEN 0.2 WHEN 'd3' THEN 0.1 ELSE 1 END"),
    _level(2, "domain, lang", "domain", "CASE lang WHEN 'en' THEN 0.4::DOUBLE WHEN 'de' THEN 0.2 WHEN 'fr' THEN 0.2 WHEN 'es' THEN 0.2 ELSE 1 END"),
    _level(3, "domain, lang, source", "domain, lang", "1::DOUBLE"),
]) + r""",
b AS (
  SELECT domain, lang, source, floor(given + 1e-6)::BIGINT // greatest(n_words, 1)::BIGINT AS epochs,
         floor(given + 1e-6)::BIGINT % greatest(n_words, 1)::BIGINT AS rest
  FROM g3 JOIN leaf USING (domain, lang, source)
),
k AS (
  SELECT d.*, epochs, rest, sum(n_words) OVER (
    PARTITION BY domain, lang, source ORDER BY md5('42:' || epochs || ':' || doc_id), CAST(doc_id AS VARCHAR)) AS upto
  FROM d JOIN b USING (domain, lang, source)
)
SELECT doc_id, domain, lang, source, n_words, unnest(range(epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END)) AS epoch
FROM k
"""


def _crc_steps() -> list[int]:
    """CRC-32 of each half byte, by the polynomial of the standard."""
    steps = []
    for value in range(16):
        for _ in range(4):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        steps.append(value)
    return steps


# The checksum runs over the half bytes of a text, the lower one of each byte first.
OP4 = f"""
WITH h AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size,
         flatten(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
           lambda b: [strpos('0123456789ABCDEF', b[2]) - 1, strpos('0123456789ABCDEF', b[1]) - 1])) AS halves
  FROM documents
),
d AS (
  SELECT doc_id, size, xor(list_reduce(halves,
    lambda a, x: xor(a >> 4, {_crc_steps()}[(xor(a, x) & 15) + 1]), 4294967295::BIGINT), 4294967295) AS text_crc32
  FROM h
),
p AS (
  SELECT *, least(39, (2 * (sum(size) OVER w - size) + size) * 40 // (2 * sum(size) OVER ()))::INT AS shard
  FROM d WINDOW w AS (ORDER BY doc_id, text_crc32, size ROWS UNBOUNDED PRECEDING)
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot, NULL::INT AS grown_shard
FROM p
"""


def _crc32(value: str) -> str:
    """The CRC-32 of a string, as a number."""
    halves = (
        f"flatten(list_transform(regexp_extract_all(hex(encode({value})), '..'), "
        "lambda b: [strpos('0123456789ABCDEF', b[2]) - 1, strpos('0123456789ABCDEF', b[1]) - 1]))"
    )
    step = f"xor(a >> 4, {_crc_steps()}[(xor(a, x) & 15) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {halves}), lambda a, x: {step}), 4294967295)"


OP12 = rf"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
n AS (SELECT c, count(*) AS n, c - c % 100 AS b, {_crc32("c::VARCHAR")} % 6 AS h FROM t GROUP BY c),
k AS (SELECT n.*, least(n.h, coalesce(x.n, 0)) AS k FROM n LEFT JOIN n x ON x.c = n.b),
r AS (
  SELECT k.c, pos AS d, role, text FROM k JOIN t ON t.c = k.b AND pos <= k.h
  UNION ALL SELECT k.c, pos - h + k, role, text FROM k JOIN t ON t.c = k.c AND pos > h
),
p AS (
  SELECT c, d, length(text) AS chars,
         md5(string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY d)) AS key
  FROM r
  UNION ALL SELECT c, 0, 0, '' FROM n
),
v AS (SELECT d, key, min(c) AS c, count(*) AS n, max(chars) AS chars FROM p GROUP BY d, key),
o AS (SELECT p.c, p.d, v.c AS owner FROM p JOIN v USING (d, key)),
e AS (SELECT owner AS c, d, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM o
      WHERE (c, d) IN (SELECT c, max(d) FROM p GROUP BY c) GROUP BY owner, d),
u AS (SELECT v.c, v.d, v.n, v.chars, o.owner AS parent FROM v LEFT JOIN o ON o.c = v.c AND o.d = v.d - 1),
m AS (SELECT parent AS c, d - 1 AS d, count(*) AS n_children FROM u WHERE d > 0 GROUP BY ALL),
w AS (SELECT u.*, coalesce(n_children, 0) AS n_children FROM u LEFT JOIN m USING (c, d)),
s AS (
  SELECT o.owner AS c, o.d, count_if(n_children = 0) AS n_leaves, sum((n - 1) * chars)::BIGINT AS saved_tokens
  FROM w JOIN o ON o.c = w.c AND o.d <= w.d GROUP BY ALL
)
SELECT c AS conv_id, d AS depth, parent AS parent_conv_id, n AS n_convs, n_children, n_leaves, saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM w JOIN s USING (c, d) LEFT JOIN e USING (c, d)
"""

OP13 = rf"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
),
b AS (
  SELECT unnest(list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS f FROM benchmark
),
dw AS (SELECT doc_id, f, count(*) AS n FROM (SELECT doc_id, unnest(w) AS f FROM d) GROUP BY ALL),
s1 AS (SELECT f, sum(n)::BIGINT AS n FROM dw GROUP BY f),
t1 AS (SELECT f, count(*) AS n FROM b GROUP BY f),
v AS (SELECT f, {_crc32("f")} % 10000 AS bucket FROM (SELECT f FROM s1 UNION SELECT f FROM t1)),
s AS (SELECT bucket, sum(n)::BIGINT AS n FROM s1 JOIN v USING (f) GROUP BY bucket),
t AS (SELECT bucket, sum(n)::BIGINT AS n FROM t1 JOIN v USING (f) GROUP BY bucket),
g AS (
  SELECT v.f, floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE)
    / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM v LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)
),
k AS (SELECT doc_id, sum(n * gain)::BIGINT AS weight FROM dw JOIN g USING (f) GROUP BY doc_id),
c AS (
  SELECT doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN k USING (doc_id)
),
r AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () * 10 // 100 AS drawn
  FROM c WHERE n_features >= 20
)
SELECT c.doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank
FROM c LEFT JOIN r USING (doc_id)
"""


def _passages(text: str) -> str:
    squeezed = r"list_transform(string_split_regex({}, '\n\s*\n'), lambda p: lower(trim(regexp_replace(p, '\s+', ' ', 'g'))))"
    return f"list_filter({squeezed.format(text)}, lambda p: p <> '')"


# Turns written as mail quote the turn before, every fourth the one three before.
OP2 = rf"""
WITH RECURSIVE m AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS own,
         CASE WHEN turn % 4 = 3 THEN lag(coalesce(text, ''), 3) OVER w ELSE lag(coalesce(text, ''), 1) OVER w END AS told,
         CASE WHEN turn % 4 = 2 THEN lag(coalesce(text, ''), 2) OVER w END AS older
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
),
said AS (SELECT conv_id, turn, unnest({_passages("own")}) AS p FROM m),
quoted AS (
  SELECT conv_id, turn, 1 AS level, unnest({_passages("told")}) AS p FROM m
  UNION ALL SELECT conv_id, turn, 2, unnest({_passages("older")}) FROM m
),
quoted_once AS (SELECT *, row_number() OVER () AS n FROM quoted),
found AS (
  SELECT q.conv_id, q.turn, level, n, max(s.turn) AS source
  FROM quoted_once q JOIN said s ON s.conv_id = q.conv_id AND s.p = q.p AND s.turn < q.turn GROUP BY ALL
),
votes AS (SELECT conv_id, turn, level, source, count(*) AS v FROM found GROUP BY ALL),
parents AS (
  SELECT conv_id, turn, source AS parent_turn FROM votes
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, v DESC, source DESC) = 1
),
threads AS (
  SELECT conv_id, turn, turn AS thread_turn, 0 AS depth FROM m ANTI JOIN parents USING (conv_id, turn)
  UNION ALL
  SELECT p.conv_id, p.turn, t.thread_turn, t.depth + 1
  FROM parents p JOIN threads t ON t.conv_id = p.conv_id AND t.turn = p.parent_turn
)
SELECT m.conv_id, m.turn, role, regexp_replace(own, '^\s+|\s+$', '', 'g') AS text, parent_turn, thread_turn, depth,
       row_number() OVER (PARTITION BY m.conv_id ORDER BY thread_turn, m.turn) - 1 AS position
FROM m JOIN threads t USING (conv_id, turn) LEFT JOIN parents p USING (conv_id, turn)
"""
