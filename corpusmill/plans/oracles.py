"""The same results in plain SQL, written independently of the operators."""

from __future__ import annotations

from corpusmill.functions.separators import LANGUAGE_SEPARATORS

# Whitespace characters as a regular-expression class.
_WS = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_NOT_WS = _WS.replace("[", "[^", 1)
_NL = "chr(10)"


def _clean(text: str) -> str:
    squashed = f"regexp_replace({text}, '{_WS}+', ' ', 'g')"
    return rf"trim(regexp_replace({squashed}, '[\x00-\x08\x0e-\x1b\x7f]', '', 'g'))"


def _words(cleaned: str) -> str:
    return f"(CASE WHEN {cleaned} = '' THEN []::VARCHAR[] ELSE string_split_regex({cleaned}, ' +') END)"


_KEPT = f"""
kept AS (
  SELECT doc_id, lang, source, cleaned AS text, {_words('cleaned')} AS words
  FROM (SELECT *, {_clean('text')} AS cleaned FROM documents)
  WHERE length(cleaned) >= 50
)"""

_LABELLED = f"""{_KEPT},
labelled AS (
  SELECT *, CASE WHEN rank <= floor(n * 0.9::DOUBLE) THEN 'train' ELSE 'val' END AS split
  FROM (
    SELECT *, md5('42:' || doc_id) AS split_key,
           row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS rank,
           count(*) OVER () AS n
    FROM kept
  )
)"""

_VOCAB = """
vocab AS (
  SELECT row_number() OVER (ORDER BY n DESC, token) + 256 AS token_id, token, n
  FROM (
    SELECT token, count(*) AS n FROM (SELECT unnest(words) AS token FROM kept) GROUP BY token
    ORDER BY n DESC, token LIMIT 65278
  )
)"""

# A word outside the vocabulary is the id 256 and its bytes.
_IDS = """CASE WHEN token_id IS NOT NULL THEN [token_id] ELSE list_concat([256::BIGINT],
  list_transform(regexp_extract_all(hex(encode(w.token)), '..'), lambda x: ('0x' || x)::BIGINT)) END"""

_PLACED = f"""{_LABELLED}, {_VOCAB},
placed AS (
  SELECT *, unnest(ids) AS id, generate_subscripts(ids, 1) AS sub
  FROM (
    SELECT doc_id, split, split_key, pos, {_IDS} AS ids
    FROM (
      SELECT doc_id, split, split_key, unnest(words) AS token, generate_subscripts(words, 1) AS pos
      FROM labelled
    ) w LEFT JOIN vocab v ON w.token = v.token
  )
)"""

_STREAM = f"""{_PLACED},
stream AS (
  SELECT *, row_number() OVER (PARTITION BY split ORDER BY split_key, doc_id, pos, sub) - 1 AS gpos FROM placed
)"""

_LOSSES = f"""{_STREAM},
moves AS (
  SELECT split, gpos // 128 AS block_id, id AS a,
         lead(id) OVER (PARTITION BY split, gpos // 128 ORDER BY gpos) AS b,
         count(*) OVER (PARTITION BY split, gpos // 128) AS n
  FROM stream
),
pairs AS (SELECT a, b, count(*) AS c FROM moves WHERE split = 'train' AND b IS NOT NULL GROUP BY a, b),
contexts AS (SELECT a, sum(c) AS u FROM pairs GROUP BY a),
losses AS (
  SELECT block_id, any_value(n) AS n_tokens,
         avg(-ln((coalesce(c, 0) + 1)::DOUBLE / (coalesce(u, 0) + (SELECT count(*) + 257 FROM vocab))::DOUBLE)) AS loss
  FROM moves LEFT JOIN pairs USING (a, b) LEFT JOIN contexts USING (a)
  WHERE split = 'val' AND n = 128 AND b IS NOT NULL
  GROUP BY block_id
)"""

_PERPLEXITY = """
SELECT round(exp(avg(loss)), 2) AS perplexity, round(avg(loss), 6) AS avg_loss,
       count(*) AS num_samples, sum(n_tokens)::BIGINT AS total_tokens FROM
"""

_SCORES = f"""
scored AS (
  SELECT *,
    CASE WHEN len(w) > 0 THEN len(list_distinct(w))::DOUBLE / len(w) END AS repetition_score,
    CASE WHEN len(w) >= 4 THEN
      len(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])))::DOUBLE / (len(w) - 1)
    END AS diversity_score
  FROM (SELECT *, {_words(_clean('text'))} AS w FROM corpus)
)"""

_LOG = f"""
corpus AS (SELECT text FROM conversations WHERE role = 'assistant'), {_SCORES},
log AS (SELECT *, len(w) AS tokens, length(text) / 50.0::DOUBLE + 1.0::DOUBLE AS seconds FROM scored)
"""

_STATS = f"""{_PLACED},
stats AS (
  SELECT split, sum(n)::BIGINT AS total_tokens, count(*) AS num_documents,
         sum(n)::DOUBLE / count(*) AS avg_tokens, min(n)::BIGINT AS min_tokens, max(n)::BIGINT AS max_tokens
  FROM (SELECT doc_id, split, count(*) AS n FROM placed GROUP BY doc_id, split) GROUP BY split
)"""

# What each suffix of the named files means.
_SUFFIXES = """
suffixes(source, suffix, mime, archive, allowed) AS (VALUES
  ('src0', '', NULL, 'unknown', false),
  ('src1', '.csv', 'text/csv', 'unknown', true),
  ('src2', '.TSV', 'text/tab-separated-values', 'unknown', true),
  ('src3', '.json', 'application/json', 'unknown', true),
  ('src4', '.jsonl', 'application/json', 'unknown', true),
  ('src5', '.txt', 'text/plain', 'unknown', true),
  ('src6', '.md', 'text/markdown', 'unknown', true),
  ('src7', '.rst', 'text/x-rst', 'unknown', true),
  ('src8', '.xlsx', 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet', 'unknown', true),
  ('src9', '.html', 'text/html', 'unknown', true),
  ('src10', '.tar.gz', NULL, 'tar.gz', true),
  ('src11', '.zip', NULL, 'zip', true),
  ('src12', '.py', 'text/x-python', 'unknown', false),
  ('src13', '.eml', 'message/rfc822', 'unknown', true),
  ('src14', '.tar.xz', NULL, 'unknown', false),
  ('src15', '.txt.gz', 'text/plain', 'gz', true),
  ('src16', '.unknown', NULL, 'unknown', false),
  ('src17', '.tbz2', NULL, 'tar.bz2', false),
  ('src18', '.pdf', NULL, 'unknown', true),
  ('src19', '.ndjson', NULL, 'unknown', false)
)"""

_ROUTED = r"""
routed AS (
  SELECT *, CASE WHEN mime_type = 'text/csv' THEN 'csv'
    WHEN mime_type = 'text/tab-separated-values' THEN 'tsv'
    WHEN mime_type = 'application/json' THEN CASE WHEN suffix IN ('.jsonl', '.ndjson') THEN 'jsonl' ELSE 'json' END
    WHEN mime_type LIKE 'text/%' THEN 'text' END AS loader
  FROM (
    SELECT doc_id, text, suffix, archive, coalesce(mime,
      CASE WHEN regexp_extract(text, '^[^\r\n]*') LIKE '%,%' THEN 'text/csv'
           WHEN len(list_filter(b, lambda x: x BETWEEN '20' AND '7E' OR x IN ('09', '0A', '0D'))) > 0.7 * len(b)
             THEN 'text/plain' ELSE 'application/octet-stream' END) AS mime_type
    FROM (SELECT *, regexp_extract_all(substr(hex(encode(text)), 1, 1024), '..') AS b FROM documents)
    JOIN suffixes USING (source)
  )
)"""

_BATCHES = """
batches AS (
  SELECT doc_id, text, doc_id // 50 AS bucket,
         ['zip', 'tar.gz', 'tar'][(doc_id // 50) % 3 + 1] AS kind,
         'batch' || (doc_id // 50) || '.' || ['zip', 'tar.gz', 'tar'][(doc_id // 50) % 3 + 1] AS name
  FROM documents
)"""


def _pretty_event() -> str:
    lines = [
        "'{' || NL || '  \"event_id\": ' || event_id || ','",
        "NL || '  \"event_type\": \"' || event_type || '\",'",
        "NL || '  \"value\": ' || value || ','",
        "NL || '  \"props\": {' || NL || '    \"k\": ' || k || NL || '  }' || NL || '}'",
    ]
    return " || ".join(lines).replace("NL", _NL)


_EVENTS = r"ev AS (SELECT *, regexp_extract(props, '\d+') AS k, event_id // 100 AS bucket FROM events)"
_LINES = """
lines AS (
  SELECT *, event_id // 1000 AS bucket,
         row_number() OVER (PARTITION BY event_id // 1000 ORDER BY event_id) - 1 AS line_number
  FROM events
)"""


def _split_pieces(pieces: str) -> str:
    return f"""
WITH parts AS (
  SELECT doc_id, lang, list_filter({pieces}, lambda p: p <> '') AS p FROM documents
)
SELECT doc_id, lang, unnest(range(len(p))) AS chunk_index, unnest(p) AS chunk FROM parts"""


def _windows(size: int, step: int, source: str, others: str, columns: str, chunk: str = "{}", glue: str = " ") -> str:
    joined = f"array_to_string(w[i * {step} + 1 : i * {step} + {size}], '{glue}')"
    return f"""
windows AS (
  SELECT *, unnest(range(CASE WHEN len(w) = 0 THEN 0 WHEN len(w) <= {size} THEN 1
                         ELSE ceil((len(w) - {size}) / {step}::DOUBLE)::BIGINT + 1 END)) AS i
  FROM {source}
)
SELECT {others}, i AS chunk_index, {columns},
       {chunk.format(joined)} AS chunk
FROM windows"""


# The text of bytes written as hexadecimal pairs; a character cut by the edges is left out.
_SPELLED = (
    "decode(unhex(replace(regexp_replace(regexp_replace(regexp_replace({}, '^20 ?', ''), '^([89AB][0-9A-F] ?)+', ''), "
    "'( [CD][0-9A-F]| E[0-9A-F]( [89AB][0-9A-F])?| F[0-9A-F]( [89AB][0-9A-F]){{0,2}})$', ''), ' ', '')))"
)


def all_oracles() -> dict[str, str]:
    sql = {
        "clean_text": f"SELECT doc_id, {_clean('text')} AS text FROM documents",
        "min_length_filter": f"WITH {_KEPT} SELECT doc_id, length(text) AS clean_length FROM kept",
        "max_length_truncate": f"WITH {_KEPT} SELECT doc_id, substr(text, 1, 1000) AS text FROM kept",
        "corpus_funnel": f"""
WITH {_KEPT}, n AS (SELECT count(*) AS p FROM kept)
SELECT (SELECT count(*) FROM documents) AS total_documents, p AS processed_documents,
       floor(p * 0.9::DOUBLE)::BIGINT AS train_documents, p - floor(p * 0.9::DOUBLE)::BIGINT AS val_documents
FROM n""",
        "train_val_split": f"WITH {_LABELLED} SELECT doc_id, split_key, split FROM labelled",
        "word_vocab": f"WITH {_KEPT}, {_VOCAB} SELECT token_id, token, n AS count FROM vocab",
        "token_stats": f"""
WITH {_STATS} SELECT split, total_tokens, num_documents, round(avg_tokens, 6) AS avg_tokens_per_doc,
       min_tokens, max_tokens, round(total_tokens * 2 / 1048576.0::DOUBLE, 9) AS file_size_mb FROM stats""",
        "processing_stats": f"""
WITH {_STATS}
SELECT (SELECT count(*) FROM documents) AS total_documents, (SELECT count(*) FROM kept) AS processed_documents,
       t.num_documents AS train_documents, v.num_documents AS val_documents,
       t.total_tokens AS train_total_tokens, t.num_documents AS train_num_documents,
       t.min_tokens AS train_min_tokens, t.max_tokens AS train_max_tokens,
       v.total_tokens AS val_total_tokens, v.num_documents AS val_num_documents,
       v.min_tokens AS val_min_tokens, v.max_tokens AS val_max_tokens,
       (SELECT count(*) + 257 FROM vocab) AS vocab_size
FROM stats t, stats v WHERE t.split = 'train' AND v.split = 'val'""",
        "token_ids": f"""
WITH {_STREAM} SELECT doc_id, split, count(*) AS n_tokens, string_agg(id::VARCHAR, ' ' ORDER BY pos, sub) AS token_ids
FROM stream GROUP BY doc_id, split""",
        "utf8_token_counts": f"""
WITH {_KEPT}, bytes AS (SELECT *, regexp_extract_all(hex(encode(text)), '..') AS b FROM kept)
SELECT doc_id, strlen(text) AS n_tokens,
       list_sum(list_transform(b, lambda x: ('0x' || x)::BIGINT))::BIGINT AS token_sum, text AS decoded FROM bytes""",
        "pack_blocks": f"""
WITH {_STREAM} SELECT split, gpos // 128 AS block_id, string_agg(id::VARCHAR, ' ' ORDER BY gpos) AS token_ids
FROM stream GROUP BY split, gpos // 128""",
        "verify_tokens": f"""
WITH {_STREAM} SELECT split, count(*) AS n_tokens, max(id) AS max_token,
       count(*) > 100 AND max(id) < (SELECT count(*) + 257 FROM vocab) AS ok FROM stream GROUP BY split""",
        "data_budget": f"""
WITH {_STATS} SELECT total_tokens AS available_tokens, 81920000::BIGINT AS required_tokens,
       CASE WHEN total_tokens >= 81920000 THEN 10000 ELSE greatest(100, total_tokens // 8192) END AS max_iters
FROM stats WHERE split = 'train'""",
        "training_windows": f"""
WITH {_STREAM}, train AS (SELECT gpos, id FROM stream WHERE split = 'train'),
starts AS (
  SELECT i AS window_id,
         ('0x' || substr(md5('42:' || i), 1, 12))::BIGINT % ((SELECT count(*) FROM train) - 64) AS start
  FROM range(256) t(i)
)
SELECT window_id, start,
       string_agg(id::VARCHAR, ' ' ORDER BY gpos) FILTER (WHERE gpos < start + 64) AS x,
       string_agg(id::VARCHAR, ' ' ORDER BY gpos) FILTER (WHERE gpos > start) AS y
FROM starts JOIN train ON gpos BETWEEN start AND start + 64 GROUP BY window_id, start""",
        "token_bin_roundtrip": f"WITH {_STREAM} SELECT split, gpos AS position, id AS token FROM stream",
        "token_bin_ranges": f"""
WITH {_STREAM} SELECT gpos AS position, id AS token FROM stream
WHERE split = 'train' AND gpos >= 1000 AND gpos < 2000""",
        "text_splits_roundtrip": f"WITH {_LABELLED} SELECT split, text FROM labelled",
        "repetition_score": f"""
WITH corpus AS (SELECT * FROM documents), {_SCORES}
SELECT doc_id, round(repetition_score, 9) AS repetition_score FROM scored""",
        "diversity_score": f"""
WITH corpus AS (SELECT * FROM documents), {_SCORES}
SELECT doc_id, round(diversity_score, 9) AS diversity_score FROM scored""",
        "coherence_by_lang": f"""
WITH corpus AS (SELECT * FROM documents), {_SCORES}
SELECT lang, round(coalesce(avg(repetition_score), 0), 6) AS avg_repetition_score,
       round(coalesce(avg(diversity_score), 0), 6) AS avg_diversity_score,
       count(repetition_score) AS scored_texts FROM scored GROUP BY lang""",
        "block_losses": f"WITH {_LOSSES} SELECT block_id, n_tokens, round(loss, 6) AS loss FROM losses",
        "benchmark_losses": f"""
WITH {_LOSSES},
items AS (SELECT item_id, {_words(_clean('text'))} AS w FROM benchmark),
item_ids AS (
  SELECT item_id, pos, unnest(ids) AS id, generate_subscripts(ids, 1) AS sub
  FROM (
    SELECT item_id, pos, {_IDS} AS ids
    FROM (SELECT item_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM items) w
    LEFT JOIN vocab v ON w.token = v.token
  )
),
steps AS (
  SELECT item_id, id AS a, lead(id) OVER (PARTITION BY item_id ORDER BY pos, sub) AS b,
         count(*) OVER (PARTITION BY item_id) AS n FROM item_ids
)
SELECT item_id, coalesce(any_value(n), 0) AS n_tokens,
       round(avg(-ln((coalesce(c, 0) + 1)::DOUBLE / (coalesce(u, 0) + (SELECT count(*) + 257 FROM vocab))::DOUBLE))
         FILTER (WHERE b IS NOT NULL), 6) AS loss
FROM items LEFT JOIN steps USING (item_id) LEFT JOIN pairs USING (a, b) LEFT JOIN contexts USING (a) GROUP BY item_id""",
        "bigram_perplexity": f"WITH {_LOSSES} {_PERPLEXITY} losses",
        "sampled_perplexity": f"""
WITH {_LOSSES} {_PERPLEXITY}
(SELECT * FROM losses ORDER BY md5('42:' || block_id), block_id LIMIT 100)""",
        "generation_log_summary": f"""
WITH {_LOG} SELECT round(avg(seconds), 6) AS avg_generation_time,
       round(avg(tokens / seconds), 6) AS avg_tokens_per_second,
       round(avg(tokens), 6) AS avg_generated_length, count(*) AS total_prompts FROM log""",
        "evaluation_report": f"""
WITH {_LOSSES}, {_LOG},
summary AS (
  SELECT avg(seconds) AS avg_generation_time, avg(tokens / seconds) AS avg_tokens_per_second,
         avg(tokens) AS avg_generated_length, count(*)::DOUBLE AS total_prompts,
         coalesce(avg(repetition_score), 0) AS avg_repetition_score,
         coalesce(avg(diversity_score), 0) AS avg_diversity_score,
         count(repetition_score)::DOUBLE AS scored_texts,
         (SELECT exp(avg(loss)) FROM losses) AS perplexity, (SELECT avg(loss) FROM losses) AS avg_loss,
         (SELECT count(*) FROM losses)::DOUBLE AS num_samples,
         (SELECT sum(n_tokens) FROM losses)::DOUBLE AS total_tokens
  FROM log
)
SELECT metric, round(value, 2) AS value FROM (UNPIVOT summary ON COLUMNS(*) INTO NAME metric VALUE value)""",
        "dataframe_documents": """
SELECT text AS page_content, json_object('doc_id', doc_id::VARCHAR, 'lang', lang, 'source', source,
       'n_chars', n_chars::VARCHAR)::VARCHAR AS metadata FROM documents""",
        "elements_single": f"""
SELECT 'conv-' || conv_id AS source,
       string_agg(text, {_NL} || {_NL} ORDER BY turn) AS page_content, count(*) AS n_elements
FROM conversations GROUP BY conv_id""",
        "elements_paged": f"""
SELECT 'conv-' || conv_id AS source, (turn // 3 + 1)::INTEGER AS page_number,
       string_agg(text || {_NL} || {_NL}, '' ORDER BY turn) AS page_content, count(*) AS n_elements,
       arg_max(role, turn) AS last_category, md5(any_value(conv_id) || ':' || max(turn)) AS last_element_id
FROM conversations GROUP BY conv_id, turn // 3""",
        "elements_rows": f"""
SELECT 'conv-' || conv_id AS source, turn AS seq, lower({_clean('text')}) AS page_content,
       json_object('category', role, 'element_id', md5(conv_id || ':' || turn),
                   'page_number', (turn // 3 + 1)::VARCHAR)::VARCHAR AS metadata FROM conversations""",
        "elements_by_source": f"""
SELECT source, string_agg(text, {_NL} || {_NL} ORDER BY doc_id) AS page_content,
       count(*) AS n_elements FROM documents GROUP BY source""",
        "document_json": """
SELECT json_object('lc', 1, 'type', 'constructor', 'id', ['langchain', 'schema', 'document', 'Document'],
       'kwargs', json_object('id', doc_id::VARCHAR, 'metadata', json_object('lang', lang),
                             'page_content', text, 'type', 'Document'))::VARCHAR AS json FROM documents""",
        "csv_documents": f"""
SELECT o_orderkey // 5000 AS bucket,
       row_number() OVER (PARTITION BY o_orderkey // 5000 ORDER BY o_orderkey) - 1 AS row,
       'o_orderkey: ' || o_orderkey || {_NL} || 'o_custkey: ' || o_custkey || {_NL} ||
       'o_orderstatus: ' || o_orderstatus || {_NL} ||
       'o_totalprice: ' || o_totalprice::DECIMAL(15, 2) || {_NL} ||
       'o_orderdate: ' || strftime(o_orderdate, '%Y-%m-%d') || {_NL} ||
       'o_orderpriority: ' || o_orderpriority || ', "x"' AS page_content FROM orders""",
        "csv_mixed_headers": f"""
SELECT o_orderkey // 5000 AS bucket, row_number() OVER (PARTITION BY o_orderkey // 5000 ORDER BY o_orderkey) - 1 AS row,
       CASE o_orderkey // 5000 % 3
         WHEN 0 THEN 'o_orderkey: ' || o_orderkey || {_NL} || 'note: ' || o_orderpriority || {_NL} || '"' || o_orderkey
         WHEN 1 THEN 'note: ' || o_orderpriority || {_NL} || '"' || o_orderkey || {_NL} || 'o_orderkey: ' || o_orderkey
         ELSE 'o_orderkey: ' || o_custkey END AS page_content,
       o_orderstatus AS status FROM orders""",
        "csv_columns": f"""
SELECT conv_id::VARCHAR AS source,
       row_number() OVER (PARTITION BY conv_id // 50 ORDER BY conv_id, turn) - 1 AS row,
       'role: ' || role || {_NL} || 'text: ' || trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS page_content,
       json_object('turn', turn::VARCHAR, 'role', role)::VARCHAR AS metadata FROM conversations""",
        "csv_ragged": f"""
SELECT c_custkey::VARCHAR AS key, row_number() OVER (PARTITION BY c_custkey // 500 ORDER BY c_custkey) - 1 AS row,
       'name: ' || CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '' ELSE c_name END || {_NL} ||
       'nation: ' || CASE c_mktsegment WHEN 'BUILDING' THEN 'None' WHEN 'HOUSEHOLD' THEN ''
                     WHEN 'MACHINERY' THEN '' ELSE c_nationkey::VARCHAR END ||
       CASE WHEN c_mktsegment = 'MACHINERY' THEN {_NL} || 'None: a, "b",z' ELSE '' END AS page_content
FROM customer""",
        "tsv_documents": f"""
SELECT p_partkey // 1000 AS bucket,
       row_number() OVER (PARTITION BY p_partkey // 1000 ORDER BY p_partkey) - 1 AS row,
       'key: ' || p_partkey || {_NL} || 'name: ' || p_name || {_NL} || 'brand: ' || p_brand || {_NL} ||
       'type: ' || p_type || ' ' || p_brand AS page_content FROM part""",
        "json_documents": f"""
WITH {_EVENTS}
SELECT '/in/' || bucket || '.json' AS source, row_number() OVER (PARTITION BY bucket ORDER BY event_id) - 1 AS seq_num,
       {_pretty_event()} AS page_content,
       json_object('parent_key', 'events', 'context_bucket', bucket::VARCHAR, 'context_name', 'log',
                   'event_id', event_id::VARCHAR, 'event_type', event_type, 'value', value::VARCHAR)::VARCHAR AS metadata
FROM ev""",
        "json_array_documents": f"""
WITH {_EVENTS}
SELECT '/in/' || bucket || '.json' AS source, row_number() OVER (PARTITION BY bucket ORDER BY event_id) - 1 AS seq_num,
       event_type AS page_content,
       json_object('event_id', event_id::VARCHAR, 'props', '{{"k":' || k || '}}')::VARCHAR AS metadata FROM ev""",
        "json_props": f"""
WITH {_EVENTS}
SELECT 'event-' || event_id AS source, 0::BIGINT AS seq_num,
       '{{' || {_NL} || '  "k": ' || k || {_NL} || '}}' AS page_content, k FROM ev""",
        "jsonl_documents": f"""
WITH {_LINES} SELECT bucket, line_number AS seq_num, event_type AS page_content,
       json_object('event_id', event_id::VARCHAR, 'value', value::VARCHAR)::VARCHAR AS metadata
FROM lines WHERE event_type <> 'error' AND value >= 1""",
        "jsonl_rejects": f"""
WITH {_LINES} SELECT bucket, line_number, '{{broken ' || event_id AS line FROM lines WHERE event_type = 'error'""",
        "text_documents": """
SELECT '/in/' || doc_id || '.txt' AS source, text AS page_content, 'utf-8' AS charset FROM documents""",
        "decode_fallback": """
SELECT '/in/' || doc_id || '.txt' AS source, text AS page_content,
       CASE WHEN lang = 'en' THEN 'utf-8' ELSE 'utf-16' END AS charset FROM documents""",
        "gzip_text": f"""
SELECT doc_id // 100 AS bucket, string_agg({_clean('text')} || {_NL}, '' ORDER BY doc_id) AS page_content
FROM documents GROUP BY doc_id // 100""",
        "blob_strings": """
SELECT CASE WHEN url LIKE 'https:%' THEN url ELSE '/web/' || page_id || '.html' END AS source, html AS text,
       strlen(html) AS n_bytes, 'text/html' AS mimetype FROM pages""",
        "token_window_chunks": f"""
WITH base AS (
  SELECT doc_id, lang,
         regexp_extract_all(text, '{_WS}*{_NOT_WS}+({_WS}+\\z)?|{_WS}+\\z') AS w FROM documents
),
{_windows(200, 160, 'base', 'doc_id', 'lang', glue='')}""",
        "token_decode": f"WITH {_KEPT} SELECT doc_id, text FROM kept",
        "token_id_windows": f"""
WITH {_PLACED},
base AS (
  SELECT doc_id, list(CASE WHEN id < 256 THEN printf('%02X', id) WHEN id = 256 THEN '20'
    ELSE '20 ' || array_to_string(regexp_extract_all(hex(encode(token)), '..'), ' ') END ORDER BY pos, sub) AS w
  FROM placed LEFT JOIN vocab ON id = token_id GROUP BY doc_id
),
{_windows(256, 224, 'base', 'doc_id', 'len(w[i * 224 + 1 : i * 224 + 256])::BIGINT AS n_tokens', _SPELLED)}""",
        "regex_split_drop": _split_pieces(r"string_split_regex(text, '[.!?]\s+')"),
        "regex_split_start": _split_pieces(
            r"string_split(regexp_replace(text, '(\s+[A-Z])', chr(1) || '\1', 'g'), chr(1))"
        ),
        "literal_split_end": _split_pieces("string_split(replace(text, '. ', '. ' || chr(1)), chr(1))"),
        "packed_chunks": r"""
WITH RECURSIVE pieces AS (SELECT doc_id, regexp_extract_all(text, '[^ ]* |[^ ]+') AS p FROM documents),
sums AS (
  SELECT doc_id, any_value(p) AS p, list(upto ORDER BY i) AS upto
  FROM (
    SELECT doc_id, p, i, sum(length(p[i])) OVER (PARTITION BY doc_id ORDER BY i) AS upto
    FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM pieces)
  ) GROUP BY doc_id
),
cuts AS (
  SELECT doc_id, 0::BIGINT AS a, greatest(1, len(list_filter(upto, lambda x: x <= 1000)))::BIGINT AS b FROM sums
  UNION ALL
  SELECT doc_id, b, greatest(b + 1, len(list_filter(upto, lambda x: x <= upto[b] + 1000)))::BIGINT
  FROM cuts JOIN sums USING (doc_id) WHERE b < len(upto)
)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY a) - 1 AS chunk_index,
       array_to_string(p[a + 1 : b], '') AS chunk FROM cuts JOIN sums USING (doc_id)""",
        "lossless_chunks": f"""
SELECT doc_id, {sorted(LANGUAGE_SEPARATORS)}[doc_id % {len(LANGUAGE_SEPARATORS)} + 1] AS preset, text FROM documents""",
        "mixed_documents": f"""
SELECT '/in/orders' || o_orderkey // 500 || '.csv' AS source,
       row_number() OVER (PARTITION BY o_orderkey // 500 ORDER BY o_orderkey) - 1 AS seq_num,
       'o_orderkey: ' || o_orderkey || {_NL} || 'o_orderstatus: ' || o_orderstatus AS page_content,
       json_object('row', (row_number() OVER (PARTITION BY o_orderkey // 500 ORDER BY o_orderkey) - 1)::VARCHAR)::VARCHAR AS metadata
FROM orders
UNION ALL
SELECT '/in/events' || event_id // 1000 || '.jsonl',
       row_number() OVER (PARTITION BY event_id // 1000 ORDER BY event_id) - 1,
       '{{' || {_NL} || '  "event_id": ' || event_id || ',' || {_NL} || '  "event_type": "' || event_type || '",' || {_NL}
         || '  "value": ' || value || {_NL} || '}}',
       json_object('event_id', event_id::VARCHAR, 'event_type', event_type, 'value', value::VARCHAR)::VARCHAR
FROM events
UNION ALL
SELECT '/in/doc' || doc_id || '.txt', 0, text, '{{}}' FROM documents""",
        "file_manifest": """
SELECT '20231114_221320_page_' || page_id || '.html_' || substr(md5('/web/page ' || page_id || '.html'), 1, 12) AS upload_id, 'page ' || page_id || '.html' AS original_filename,
       '/web/page ' || page_id || '.html' AS file_path, strlen(html) AS file_size,
       CASE WHEN strlen(html) <= 4000 THEN 'text/html' END AS mime_type,
       CASE WHEN strlen(html) <= 4000 THEN sha256(html) END AS checksum,
       CASE WHEN strlen(html) <= 4000 THEN 'completed' ELSE 'failed' END AS status,
       CASE WHEN strlen(html) > 4000 THEN 'File too large: ' || strlen(html) || ' bytes (max: 4000 bytes)' END AS error_message
FROM pages""",
        "manifest_roundtrip": """
SELECT stamp || '_page_' || page_id || '.html_' || substr(md5(folder || 'page ' || page_id || '.html'), 1, 12) AS upload_id,
       folder || 'page ' || page_id || '.html' AS file_path,
       CASE folder WHEN '/copy/' THEN 'processing' ELSE 'completed' END AS status, strlen(html) AS file_size, 0::BIGINT AS rows_before
FROM pages, (VALUES ('/web/', '20231114_221500'), ('/copy/', '20231114_221320')) f(folder, stamp)
WHERE strlen(html) <= 4000""",
        "mime_detect": f"WITH {_SUFFIXES}, {_ROUTED} SELECT doc_id, mime_type, loader FROM routed",
        # Documents hold prose, so the ones named .json are broken and the ones named
        # .jsonl hold no valid line; a table is empty if nothing follows its first line.
        "file_outcomes": f"""
WITH {_SUFFIXES}, {_ROUTED}, {_BATCHES},
judged AS (
  SELECT CASE WHEN archive = 'unknown' THEN loader END AS loader,
         CASE WHEN archive <> 'unknown' OR loader IS NULL THEN 'unsupported'
              WHEN loader = 'json' THEN 'failed'
              WHEN loader = 'jsonl' THEN 'empty'
              WHEN loader IN ('csv', 'tsv') AND NOT regexp_matches(text, '\\n[^\\n]') THEN 'empty'
              ELSE 'completed' END AS status
  FROM routed
  UNION ALL SELECT 'text', 'completed' FROM batches
)
SELECT loader, status, count(*) AS files FROM judged GROUP BY loader, status""",
        "archive_types": f"""
WITH {_SUFFIXES} SELECT doc_id, archive AS archive_type, archive <> 'unknown' AS is_archive, allowed AS is_allowed
FROM documents JOIN suffixes USING (source)""",
        "safe_filenames": r"""
SELECT page_id, rtrim(regexp_replace(url, '[^\p{L}\p{N}]', '_', 'g'), '_') AS safe_name,
       trim(regexp_replace(regexp_replace(trim(replace(url, '/', ' ')), '\s+', '_', 'g'), '[^A-Za-z0-9_.-]', '', 'g'), '._') AS upload_name
FROM pages""",
        "expand_archives": f"""
WITH {_BATCHES} SELECT '/in/' || name AS upload_path,
       '/in/' || name || CASE WHEN kind = 'tar' THEN '!/inner.zip' ELSE '' END AS source_archive,
       'docs/' || doc_id || '.txt' AS relative_path, sha256(text) AS checksum, NULL::VARCHAR AS error FROM batches""",
        "damaged_archives": f"""
WITH {_BATCHES} SELECT '/in/batch' || bucket || '.zip' AS upload_path, 'docs/' || doc_id || '.txt' AS relative_path,
       CASE WHEN doc_id <> min(doc_id) OVER (PARTITION BY bucket) THEN sha256(text) END AS checksum,
       doc_id = min(doc_id) OVER (PARTITION BY bucket) AS failed FROM batches""",
        "list_archive": f"""
WITH {_BATCHES}
SELECT '/in/' || name AS path, 'docs/' || doc_id || '.txt' AS member, NULL::VARCHAR AS error FROM batches WHERE kind <> 'tar'
UNION ALL
SELECT DISTINCT '/in/' || name, unnest(CASE WHEN kind = 'tar' THEN ['inner.zip']
       ELSE ['__MACOSX/x.txt', '../evil.txt', 'docs/._y.txt'] END), NULL FROM batches""",
        "process_files": f"""
WITH {_BATCHES} SELECT '20231114_221320_' || name || '_' || substr(md5('/in/' || name), 1, 12) AS upload_id, name AS original_filename,
       'docs/' || doc_id || '.txt' AS relative_path, 'text/plain' AS detected_mime_type,
       sha256(text) AS content_hash FROM batches""",
        "manifest_status": f"""
WITH {_BATCHES}, {_SUFFIXES}
SELECT DISTINCT '/in/' || name AS file_path, 'completed' AS status, NULL::VARCHAR AS error_message FROM batches
UNION ALL
SELECT '/in/doc' || doc_id || suffix, CASE WHEN archive = 'unknown' THEN 'completed' ELSE 'failed' END,
       CASE WHEN archive <> 'unknown' THEN 'No processable files found after extraction' END
FROM documents JOIN suffixes USING (source)""",
        "stream_ingest": f"""
SELECT doc_id // 100 AS bucket, 0::BIGINT AS seq_num,
       string_agg({_clean('text')} || {_NL}, '' ORDER BY doc_id) AS page_content, 'text/plain' AS detected_mime_type
FROM documents GROUP BY doc_id // 100""",
    }
    sql["stats_json"] = sql["processing_stats"]
    return sql
