"""One named query per operator, over the whole of the given tables."""

from __future__ import annotations

import gzip
import io
import tarfile
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import jsontext, names
from corpusmill.functions import text as tx
from corpusmill.functions.binding import lookup
from corpusmill.functions.separators import LANGUAGE_SEPARATORS
from corpusmill.operators import (
    bigrams,
    chunks,
    clean,
    manifest,
    packing,
    quality,
    splits,
    tokens,
)
from corpusmill.plans import corpus, evaluation, ingest
from corpusmill.session import materialize, scratch_path, ship_package, spread
from corpusmill.sinks import documents as document_sinks
from corpusmill.sinks import tokens as token_sinks
from corpusmill.sources import archives, delimited, files, jsonlike, tables, textual
from corpusmill.streaming import ingest as streaming

BLOCK = 128
CONTEXT = 64
WINDOWS = 256
# The suffix given to each document source, to exercise detection.
SUFFIXES = {
    "src0": "", "src1": ".csv", "src2": ".TSV", "src3": ".json", "src4": ".jsonl", "src5": ".txt",
    "src6": ".md", "src7": ".rst", "src8": ".xlsx", "src9": ".html", "src10": ".tar.gz",
    "src11": ".zip", "src12": ".py", "src13": ".eml", "src14": ".tar.xz", "src15": ".txt.gz",
    "src16": ".unknown", "src17": ".tbz2", "src18": ".pdf", "src19": ".ndjson",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def _joined(column: str) -> Column:
    return F.array_join(F.col(column).cast("array<string>"), " ")


# --- cleaning, splits and tokens -------------------------------------------------


def clean_text(spark, sf_dir):
    return clean.clean_text(_documents(spark, sf_dir)).select("doc_id", "text")


def min_length_filter(spark, sf_dir):
    kept = clean.drop_short(clean.clean_text(_documents(spark, sf_dir)), 50)
    return kept.select("doc_id", F.length("text").cast("bigint").alias("clean_length"))


def max_length_truncate(spark, sf_dir):
    return clean.prepare(_documents(spark, sf_dir), 50, 1000).select("doc_id", "text")


def corpus_funnel(spark, sf_dir):
    return clean.funnel(_documents(spark, sf_dir))


def train_val_split(spark, sf_dir):
    kept = clean.prepare(_documents(spark, sf_dir)).select("doc_id")
    return splits.train_val_split(materialize(kept, "kept-ids"))


def word_vocab(spark, sf_dir):
    return tokens.word_vocab(clean.prepare(_documents(spark, sf_dir)), cleaned=True)


def token_stats(spark, sf_dir):
    stats = corpus.corpus_token_stats(_documents(spark, sf_dir))
    return stats.select(
        "split", "total_tokens", "num_documents",
        F.round("avg_tokens_per_doc", 6).alias("avg_tokens_per_doc"),
        F.col("min_tokens").cast("bigint").alias("min_tokens"),
        F.col("max_tokens").cast("bigint").alias("max_tokens"),
        F.round("file_size_mb", 9).alias("file_size_mb"),
    )


def processing_stats(spark, sf_dir):
    return _flat_stats(corpus.processing_stats(_documents(spark, sf_dir)))


def _flat_stats(row):
    splits_ = [
        F.col(f"{split}.{name}").cast("bigint").alias(f"{split}_{name}")
        for split in ("train", "val")
        for name in ("total_tokens", "num_documents", "min_tokens", "max_tokens")
    ]
    return row.select("total_documents", "processed_documents", "train_documents", "val_documents", *splits_, "vocab_size")


def token_ids(spark, sf_dir):
    tokenized, _ = corpus.tokenized_corpus(_documents(spark, sf_dir))
    return tokenized.select(
        "doc_id", "split", F.col("n_tokens").cast("bigint").alias("n_tokens"), _joined("tokens").alias("token_ids")
    )


def token_decode(spark, sf_dir):
    tokenized, tokenizer = corpus.tokenized_corpus(_documents(spark, sf_dir))
    return tokenized.select("doc_id", tokenizer.decode(F.col("tokens")).alias("text"))


def utf8_token_counts(spark, sf_dir):
    tokenizer = tokens.utf8_tokenizer()
    encoded = tokens.tokenize(clean.prepare(_documents(spark, sf_dir)), tokenizer)
    total = F.aggregate("tokens", F.lit(0).cast("bigint"), lambda a, t: a + t)
    return encoded.select(
        "doc_id",
        F.col("n_tokens").cast("bigint").alias("n_tokens"),
        total.alias("token_sum"),
        tokenizer.decode(F.col("tokens")).alias("decoded"),
    )


def _packed(spark, sf_dir):
    tokenized, tokenizer = corpus.tokenized_corpus(_documents(spark, sf_dir))
    return packing.pack_blocks(tokenized, BLOCK), tokenizer


def pack_blocks(spark, sf_dir):
    blocks, _ = _packed(spark, sf_dir)
    return blocks.select("split", "block_id", _joined("tokens").alias("token_ids"))


def verify_tokens(spark, sf_dir):
    blocks, tokenizer = _packed(spark, sf_dir)
    return tokens.verify_tokens(blocks, tokenizer.vocab_size).select(
        "split", "n_tokens", F.col("max_token").cast("bigint").alias("max_token"), "ok"
    )


def data_budget(spark, sf_dir):
    stats = corpus.corpus_token_stats(_documents(spark, sf_dir))
    return tokens.training_budget(stats, max_iters=10_000, batch_size=64, block_size=BLOCK)


def training_windows(spark, sf_dir):
    blocks = materialize(_packed(spark, sf_dir)[0], "blocks")
    windows = packing.sample_windows(blocks, BLOCK, CONTEXT, WINDOWS)
    return windows.select("window_id", "start", _joined("x").alias("x"), _joined("y").alias("y"))


def _packed_with_lengths(spark, sf_dir):
    tokenized, tokenizer = corpus.tokenized_corpus(_documents(spark, sf_dir))
    totals = tokenized.groupBy("split").agg(F.sum("n_tokens").alias("n")).collect()
    return packing.pack_blocks(tokenized, BLOCK), tokenizer, {r["split"]: r["n"] for r in totals}


def token_bin_roundtrip(spark, sf_dir):
    blocks, tokenizer, lengths = _packed_with_lengths(spark, sf_dir)
    folders = {split: scratch_path(spark, f"{split}-bin") for split in ("train", "val")}
    token_sinks.write_token_streams(blocks, folders, BLOCK, tokenizer.vocab_size, lengths=lengths)
    parts = [
        token_sinks.read_token_runs(spark, path, 4096).select(
            F.lit(split).alias("split"), "position", F.posexplode("tokens").alias("place", "token")
        )
        for split, path in folders.items()
    ]
    position = (F.col("position") + F.col("place")).alias("position")
    return parts[0].unionByName(parts[1]).select("split", position, F.col("token").cast("bigint").alias("token"))


def token_bin_ranges(spark, sf_dir):
    """A stretch in the middle of the stream, found by a position filter that reaches the files."""
    blocks, tokenizer, lengths = _packed_with_lengths(spark, sf_dir)
    path = scratch_path(spark, "train-bin")
    token_sinks.write_token_stream(blocks, path, "train", BLOCK, tokenizer.vocab_size, lengths=lengths)
    stream = token_sinks.read_token_stream(spark, path)
    wanted = stream.filter((F.col("position") >= 1000) & (F.col("position") < 2000))
    return wanted.select("position", F.col("token").cast("bigint").alias("token"))


def text_splits_roundtrip(spark, sf_dir):
    kept = materialize(clean.prepare(_documents(spark, sf_dir)).select("doc_id", "text"), "cleaned")
    path = scratch_path(spark, "text-splits")
    document_sinks.write_text_splits(splits.train_val_split(kept), path)
    lines = spark.read.text(path).filter("value <> ''")
    return lines.select("split", F.col("value").alias("text"))


def stats_json(spark, sf_dir):
    path = scratch_path(spark, "stats")
    document_sinks.write_stats(corpus.processing_stats(_documents(spark, sf_dir)), path)
    return _flat_stats(spark.read.json(path))


# --- quality ---------------------------------------------------------------------


def _scored(spark, sf_dir):
    return quality.score_texts(_documents(spark, sf_dir))


def repetition_score(spark, sf_dir):
    return _scored(spark, sf_dir).select("doc_id", F.round("repetition_score", 9).alias("repetition_score"))


def diversity_score(spark, sf_dir):
    return _scored(spark, sf_dir).select("doc_id", F.round("diversity_score", 9).alias("diversity_score"))


def coherence_by_lang(spark, sf_dir):
    return quality.coherence(_scored(spark, sf_dir), "lang").select(
        "lang",
        F.round("avg_repetition_score", 6).alias("avg_repetition_score"),
        F.round("avg_diversity_score", 6).alias("avg_diversity_score"),
        "scored_texts",
    )


def _losses(spark, sf_dir, max_samples=None):
    blocks, tokenizer = _packed(spark, sf_dir)
    blocks = materialize(blocks, "blocks")
    chosen = bigrams.sample_blocks(blocks, BLOCK, "val", max_samples)
    if max_samples is not None:
        chosen = materialize(chosen, "sampled-blocks")
    train = blocks.filter("split = 'train'")
    return bigrams.block_losses(train, chosen, tokenizer.vocab_size)


def block_losses(spark, sf_dir):
    return _losses(spark, sf_dir).select("block_id", "n_tokens", F.round("loss", 6).alias("loss"))


def _rounded_perplexity(losses):
    return quality.perplexity(losses).select(
        F.round("perplexity", 2).alias("perplexity"), F.round("avg_loss", 6).alias("avg_loss"),
        "num_samples", "total_tokens",
    )


def benchmark_losses(spark, sf_dir):
    """The benchmark passages scored by the model fitted on the training split."""
    tokenized, tokenizer = corpus.tokenized_corpus(_documents(spark, sf_dir))
    train = packing.pack_blocks(tokenized.filter("split = 'train'"), BLOCK)
    items = clean.clean_text(table(spark, sf_dir, "benchmark")).select(
        F.col("item_id").alias("block_id"), tokenizer.encode(F.col("text")).alias("tokens")
    )
    losses = bigrams.block_losses(materialize(train, "train-blocks"), materialize(items, "items"), tokenizer.vocab_size)
    return losses.select(F.col("block_id").alias("item_id"), "n_tokens", F.round("loss", 6).alias("loss"))


def bigram_perplexity(spark, sf_dir):
    return _rounded_perplexity(_losses(spark, sf_dir))


def sampled_perplexity(spark, sf_dir):
    return _rounded_perplexity(_losses(spark, sf_dir, max_samples=100))


def _generation_log(spark, sf_dir):
    """Assistant turns as generation records; time at a steady reading speed."""
    turns = table(spark, sf_dir, "conversations").filter("role = 'assistant'")
    return turns.select(
        F.col("text").alias("generated_text"),
        F.size(tx.words(F.col("text"))).alias("generated_tokens"),
        (F.length("text") / 50.0 + 1.0).alias("generation_time"),
    )


def generation_log_summary(spark, sf_dir):
    summary = quality.generation_summary(_generation_log(spark, sf_dir))
    return summary.select(
        *[F.round(c, 6).alias(c) for c in summary.columns if c != "total_prompts"], "total_prompts"
    )


def evaluation_report(spark, sf_dir):
    report = evaluation.report(_generation_log(spark, sf_dir), _losses(spark, sf_dir))
    return report.select("metric", F.round("value", 2).alias("value"))


# --- tables as documents -----------------------------------------------------------


def dataframe_documents(spark, sf_dir):
    loaded = tables.table_documents(_documents(spark, sf_dir))
    return loaded.select("page_content", F.to_json("metadata").alias("metadata"))


def _elements(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("conv-"), F.col("conv_id")).alias("source"),
        F.col("turn").alias("seq"),
        (F.floor(F.col("turn") / 3) + 1).cast("int").alias("page_number"),
        F.col("role").alias("category"),
        F.md5(F.concat_ws(":", "conv_id", "turn").cast("binary")).alias("element_id"),
        "text",
    )


def elements_single(spark, sf_dir):
    return tables.element_documents(_elements(spark, sf_dir), "single")


def elements_paged(spark, sf_dir):
    return tables.element_documents(_elements(spark, sf_dir), "paged")


def elements_rows(spark, sf_dir):
    rows = tables.element_documents(_elements(spark, sf_dir), "elements", [tx.cleaned, F.lower])
    return rows.select("source", "seq", "page_content", F.to_json("metadata").alias("metadata"))


def elements_by_source(spark, sf_dir):
    docs = _documents(spark, sf_dir).select(
        "source", F.col("doc_id").alias("seq"), F.lit(None).cast("int").alias("page_number"),
        F.lit("doc").alias("category"), F.lit(None).cast("string").alias("element_id"), "text",
    )
    return tables.element_documents(docs, "single")


def document_json(spark, sf_dir):
    loaded = tables.table_documents(_documents(spark, sf_dir).select("doc_id", "lang", "text"))
    ident = F.element_at("metadata", "doc_id")
    rest = F.map_filter("metadata", lambda k, _: k != "doc_id")
    return loaded.select(document_sinks.document_json(F.col("page_content"), rest, ident).alias("json"))


# --- file formats -------------------------------------------------------------------


def _bucket_of(column: str) -> Column:
    return F.regexp_extract(F.col(column), r"bucket=(\d+)", 1).cast("bigint")


def _write_bucketed(df, path, order, writer):
    """One file per value of ``bucket``, whose size is bounded by the caller."""
    arranged = df.repartition("bucket").sortWithinPartitions("bucket", order)
    writer(arranged.drop(order).write.partitionBy("bucket"), path)


def csv_documents(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.floor(F.col("o_orderkey") / 5000).alias("bucket"),
        F.col("o_orderkey").alias("_order"),
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.col("o_totalprice").cast("decimal(15,2)").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias(" o_orderdate "),
        F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(', "x" ')).alias("o_orderpriority"),
    )
    path = scratch_path(spark, "orders-csv")
    _write_bucketed(orders, path, "_order", lambda w, p: w.option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(p, header=True))
    loaded = delimited.csv_documents(spark, path)
    return loaded.select(_bucket_of("source").alias("bucket"), F.col("row").cast("bigint").alias("row"), "page_content")


def csv_mixed_headers(spark, sf_dir):
    """Files of three headers: two orders of columns, and one that names a column twice."""
    orders = table(spark, sf_dir, "orders").select(
        F.floor(F.col("o_orderkey") / 5000).alias("bucket"), F.col("o_orderkey").alias("_order"),
        F.col("o_orderkey").cast("string").alias("key"), F.col("o_custkey").cast("string").alias("cust"),
        F.concat("o_orderpriority", F.lit('\n"'), "o_orderkey").alias("note"), F.col("o_orderstatus").alias("status"),
    )
    headers = [
        {"o_orderkey": "key", "status": "status", "note": "note"}, {"note": "note", "o_orderkey": "key", "status": "status"},
        {"o_orderkey": "key", "status": "status", " o_orderkey": "cust"},
    ]
    path = scratch_path(spark, "mixed-csv")
    for kind, header in enumerate(headers):
        own = orders.filter(F.col("bucket") % 3 == kind)
        names = own.groupBy("bucket").agg(F.lit(-1).cast("bigint").alias("_order"), *[F.lit(n.strip()).alias(f"c{i}") for i, n in enumerate(header)])
        values = own.select("bucket", "_order", *[F.col(c).alias(f"c{i}") for i, c in enumerate(header.values())])
        _write_bucketed(names.unionByName(values), f"{path}/kind={kind}", "_order", lambda w, p: w.option("escape", '"').csv(p))
    loaded = delimited.csv_documents(spark, path, metadata_columns=["status"])
    return loaded.select(
        _bucket_of("source").alias("bucket"), F.col("row").cast("bigint").alias("row"), "page_content",
        F.element_at("metadata", "status").alias("status"),
    )


def csv_columns(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(
        F.floor(F.col("conv_id") / 50).alias("bucket"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("_order"),
        "conv_id", "turn", "role", "text",
    )
    path = scratch_path(spark, "turns-csv")
    _write_bucketed(turns, path, "_order", lambda w, p: w.option("escape", '"').csv(p, header=True))
    loaded = delimited.csv_documents(
        spark, path, source_column="conv_id", metadata_columns=["turn", "role"], content_columns=["text", "role"]
    )
    return loaded.select("source", F.col("row").cast("bigint").alias("row"), "page_content", F.to_json("metadata").alias("metadata"))


def csv_ragged(spark, sf_dir):
    """Customer lines with missing, empty and surplus values."""
    c = table(spark, sf_dir, "customer")
    segment = F.col("c_mktsegment")
    line = (
        F.when(segment == "BUILDING", F.concat_ws(",", "c_custkey", "c_name"))
        .when(segment == "MACHINERY", F.concat(F.concat_ws(",", "c_custkey", "c_name"), F.lit(',,"a, ""b"" ", z')))
        .when(segment == "HOUSEHOLD", F.concat(F.col("c_custkey").cast("string"), F.lit(",,")))
        .otherwise(F.concat_ws(",", "c_custkey", "c_name", "c_nationkey"))
    )
    lines = c.select(
        F.floor(F.col("c_custkey") / 500).alias("bucket"), F.col("c_custkey").alias("_order"), line.alias("value")
    )
    path = scratch_path(spark, "customer-ragged")
    _write_bucketed(lines, path, "_order", lambda w, p: w.text(p))
    loaded = delimited.csv_documents(spark, path, fieldnames=["key", "name", "nation"], metadata_columns=["key"])
    return loaded.select(F.element_at("metadata", "key").alias("key"), F.col("row").cast("bigint").alias("row"), "page_content")


def tsv_documents(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        F.floor(F.col("p_partkey") / 1000).alias("bucket"), F.col("p_partkey").alias("_order"),
        "p_partkey", "p_name", "p_brand", F.concat("p_type", F.lit(" "), "p_brand").alias("p_type"),
    )
    path = scratch_path(spark, "part-tsv")
    _write_bucketed(parts, path, "_order", lambda w, p: w.option("sep", "\t").csv(p))
    loaded = delimited.tsv_documents(spark, path, fieldnames=["key", "name", "brand", "type"])
    return loaded.select(_bucket_of("source").alias("bucket"), F.col("row").cast("bigint").alias("row"), "page_content")


def _event_files(spark, sf_dir, shape):
    """JSON files of at most 100 events each, as rows."""
    events = table(spark, sf_dir, "events")
    item = F.struct("event_id", "event_type", "value", F.from_json("props", "k int").alias("props"))
    groups = events.groupBy(F.floor(F.col("event_id") / 100).alias("bucket")).agg(
        F.array_sort(F.collect_list(item)).alias("events")
    )
    files_ = groups.select(
        F.concat(F.lit("/in/"), "bucket", F.lit(".json")).alias("path"),
        F.to_json(shape).cast("binary").alias("content"),
    )
    return spread(materialize(files_, "event-files"))


def json_documents(spark, sf_dir):
    shape = F.struct(
        F.struct(F.lit(1).alias("v")).alias("meta"), F.array().cast("array<int>").alias("none"),
        F.col("bucket"), F.lit("log").alias("name"), F.col("events"), F.array(F.lit(1)).alias("later"),
    )
    loaded = jsonlike.json_documents(_event_files(spark, sf_dir, shape))
    return loaded.select("source", "seq_num", "page_content", F.to_json("metadata").alias("metadata"))


def json_array_documents(spark, sf_dir):
    loaded = jsonlike.json_documents(
        _event_files(spark, sf_dir, F.col("events")), content_key="event_type", metadata_keys=["event_id", "props"]
    )
    return loaded.select("source", "seq_num", "page_content", F.to_json("metadata").alias("metadata"))


def json_props(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("event-"), "event_id").alias("path"), F.col("props").cast("binary").alias("content")
    )
    loaded = jsonlike.json_documents(events)
    return loaded.select("source", "seq_num", "page_content", F.element_at("metadata", "k").alias("k"))


def _jsonl_folder(spark, sf_dir):
    """Events as JSON Lines; error events become broken lines, idle ones blank lines."""
    events = table(spark, sf_dir, "events")
    good = F.to_json(F.struct("event_id", "event_type", "value"))
    line = F.when(F.col("event_type") == "error", F.concat(F.lit("{broken "), "event_id")).otherwise(
        F.when(F.col("value") < 1, "   ").otherwise(good)
    )
    lines = events.select(
        F.floor(F.col("event_id") / 1000).alias("bucket"), F.col("event_id").alias("_order"), line.alias("value")
    )
    path = scratch_path(spark, "events-jsonl")
    _write_bucketed(lines, path, "_order", lambda w, p: w.text(p))
    return path


def jsonl_documents(spark, sf_dir):
    loaded = jsonlike.jsonl_documents(spark, _jsonl_folder(spark, sf_dir), content_key="event_type")
    return loaded.select(
        _bucket_of("source").alias("bucket"), "seq_num", "page_content", F.to_json("metadata").alias("metadata")
    )


def jsonl_rejects(spark, sf_dir):
    bad = jsonlike.jsonl_rejects(spark, _jsonl_folder(spark, sf_dir))
    return bad.select(_bucket_of("source").alias("bucket"), F.col("line_number").cast("bigint").alias("line_number"), "line")


def _document_files(spark, sf_dir, text):
    return _documents(spark, sf_dir).select(
        F.concat(F.lit("/in/"), "doc_id", F.lit(".txt")).alias("path"), text.alias("content"), "lang"
    )


def text_documents(spark, sf_dir):
    dos = F.replace(F.col("text"), F.lit("\n"), F.lit("\r\n")).cast("binary")
    return textual.text_documents(_document_files(spark, sf_dir, dos))


def decode_fallback(spark, sf_dir):
    raw = F.when(F.col("lang") == "en", F.col("text").cast("binary")).otherwise(F.encode("text", "UTF-16"))
    return textual.text_documents(_document_files(spark, sf_dir, raw), autodetect=True)


def gzip_text(spark, sf_dir):
    docs = clean.clean_text(_documents(spark, sf_dir)).select(
        F.floor(F.col("doc_id") / 100).alias("bucket"), F.col("doc_id").alias("_order"), F.col("text").alias("value")
    )
    path = scratch_path(spark, "text-gz")
    _write_bucketed(docs, path, "_order", lambda w, p: w.option("compression", "gzip").text(p))
    loaded = textual.read_gzip_text(spark, path)
    return loaded.select(_bucket_of("source").alias("bucket"), "page_content")


def blob_strings(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    secure = F.startswith("url", F.lit("https:"))
    metadata = F.when(secure, F.create_map(F.lit("source"), F.col("url"))).otherwise(
        F.create_map().cast("map<string,string>")
    )
    path = F.concat(F.lit("/web/"), "page_id", F.lit(".html"))
    content = F.col("html").cast("binary")
    return pages.select(
        files.blob_source(metadata, path).alias("source"),
        files.decoded(content)["text"].alias("text"),
        F.length(content).cast("bigint").alias("n_bytes"),
        names.mime_type(path).alias("mimetype"),
    )


# --- chunks --------------------------------------------------------------------------


def _chunked(spark, sf_dir, splitter):
    docs = _documents(spark, sf_dir).select("doc_id", "lang", "text")
    return chunks.split_documents(docs, splitter).withColumn("chunk_index", F.col("chunk_index").cast("bigint"))


def token_window_chunks(spark, sf_dir):
    return _chunked(spark, sf_dir, chunks.word_windows(200, 40))


def token_id_windows(spark, sf_dir):
    tokenized, tokenizer = corpus.tokenized_corpus(_documents(spark, sf_dir))
    parts = tokenized.select(
        "doc_id", F.posexplode(chunks.token_windows(F.col("tokens"), 256, 32)).alias("chunk_index", "ids")
    )
    return parts.select(
        "doc_id", F.col("chunk_index").cast("bigint").alias("chunk_index"),
        F.size("ids").cast("bigint").alias("n_tokens"), tokenizer.decode(F.col("ids")).alias("chunk"),
    )


def regex_split_drop(spark, sf_dir):
    return _chunked(spark, sf_dir, chunks.separated(r"[.!?]\s+", False, is_regex=True))


def regex_split_start(spark, sf_dir):
    return _chunked(spark, sf_dir, chunks.separated(r"\s+[A-Z]", "start", is_regex=True))


def literal_split_end(spark, sf_dir):
    return _chunked(spark, sf_dir, chunks.separated(". ", "end"))


def recursive_chunks(spark, sf_dir):
    return _chunked(spark, sf_dir, chunks.recursive(600, 60))


def recursive_chunks_by_words(spark, sf_dir):
    return _chunked(spark, sf_dir, chunks.recursive(100, 10, length="words", keep="end"))


def packed_chunks(spark, sf_dir):
    """Words packed into chunks of 1,000 characters, nothing lost between them."""
    splitter = chunks.recursive(1000, 0, separators=[" "], keep="end", strip=False)
    return _chunked(spark, sf_dir, splitter).select("doc_id", "chunk_index", "chunk")


def lossless_chunks(spark, sf_dir):
    """Every language preset over a share of the documents; the chunks together are the text."""
    presets = F.array(*[F.lit(name) for name in sorted(LANGUAGE_SEPARATORS)])
    language = F.element_at(presets, (F.col("doc_id") % len(LANGUAGE_SEPARATORS) + 1).cast("int"))
    split = chunks.recursive(200, 0, strip=False, language=F.col("preset"))
    docs = _documents(spark, sf_dir).select("doc_id", "text", language.alias("preset"))
    cut = docs.select("doc_id", "preset", split(F.col("text")).alias("parts"))
    return cut.select(
        "doc_id", "preset", F.array_join(F.transform("parts", lambda p: p["chunk"]), "").alias("text")
    )


def language_chunks(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.lit("html").alias("language"), F.col("html").alias("text"))
    return chunks.split_documents(pages, chunks.recursive(500, 50, language=F.col("language")))


# --- manifest, archives and processing --------------------------------------------------


def _page_files(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    content = F.col("html").cast("binary")
    return pages.select(
        F.concat(F.lit("/web/page "), "page_id", F.lit(".html")).alias("path"),
        F.length(content).cast("bigint").alias("length"), content.alias("content"),
    )


def _page_manifest(spark, sf_dir):
    when = F.timestamp_seconds(F.lit(1_700_000_000))
    return manifest.build_manifest(_page_files(spark, sf_dir), max_size=4000, uploaded_at=when)


def file_manifest(spark, sf_dir):
    return _page_manifest(spark, sf_dir).drop("upload_timestamp")


def manifest_roundtrip(spark, sf_dir):
    """Pages uploaded to two folders under the same names, those of one folder twice.

    Failed uploads are deleted from the stored manifest, the copies get another status,
    and the log is compacted; the newest entry of each path is left.
    """
    path, pages = scratch_path(spark, "manifest"), _page_files(spark, sf_dir)
    known = manifest.read_manifest(spark, path).count()
    copies = pages.withColumn("path", F.replace("path", F.lit("/web/"), F.lit("/copy/")))
    for uploads, second in ((pages.unionByName(copies), 1_700_000_000), (pages, 1_700_000_100)):
        when = F.timestamp_seconds(F.lit(second))
        manifest.append_manifest(manifest.build_manifest(uploads, max_size=4000, uploaded_at=when), path)
    stored = manifest.read_manifest(spark, path)
    manifest.delete_stored(spark, path, stored.filter("status = 'failed'"))
    left = manifest.read_manifest(spark, path)
    copied = left.filter(F.col("file_path").startswith("/copy/"))
    manifest.append_manifest(manifest.mark_processing(copied, copied), path)
    manifest.compact_manifest(spark, path)
    kept = manifest.newest_entries(manifest.read_manifest(spark, path))
    return kept.select(
        "upload_id", "file_path", "status", "file_size", F.lit(known).cast("bigint").alias("rows_before")
    )


def _named_files(spark, sf_dir):
    suffix = lookup(SUFFIXES, F.col("source"))
    content = F.col("text").cast("binary")
    return _documents(spark, sf_dir).select(
        "doc_id", F.concat(F.lit("/in/doc"), "doc_id", suffix).alias("path"),
        F.length(content).cast("bigint").alias("length"), content.alias("content"),
    )


def mime_detect(spark, sf_dir):
    found = _named_files(spark, sf_dir).withColumn("mime_type", names.mime_type(F.col("path"), F.col("content")))
    return found.select("doc_id", "mime_type", names.loader(F.col("path"), F.col("mime_type")).alias("loader"))


def archive_types(spark, sf_dir):
    path = F.col("path")
    return _named_files(spark, sf_dir).select(
        "doc_id", names.archive_type(path).alias("archive_type"), names.is_archive(path).alias("is_archive"),
        names.is_allowed(names.base_name(path)).alias("is_allowed"),
    )


def safe_filenames(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select(
        "page_id", names.safe_filename(F.col("url")).alias("safe_name"), names.upload_name(F.col("url")).alias("upload_name")
    )


_ARCHIVE_FIELDS = "path string, content binary"


def _pack_archive(group: pd.DataFrame) -> pd.DataFrame:
    """One archive of a bounded group: zip, tar.gz or a zip inside a tar."""
    bucket = int(group["bucket"].iloc[0])
    members = [(f"docs/{d}.txt", t.encode()) for d, t in sorted(zip(group["doc_id"], group["text"]))]
    members += [("__MACOSX/x.txt", b"x"), ("../evil.txt", b"x"), ("docs/._y.txt", b"y")]

    def zipped(items):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as box:
            for name, data in items:
                box.writestr(name, data)
        return out.getvalue()

    def tarred(items):
        out = io.BytesIO()
        with tarfile.open(fileobj=out, mode="w") as box:
            for name, data in items:
                info = tarfile.TarInfo(name)
                info.size = len(data)
                box.addfile(info, io.BytesIO(data))
        return out.getvalue()

    kind = ("zip", "tar.gz", "tar")[bucket % 3]
    if kind == "zip":
        content = zipped(members)
    elif kind == "tar.gz":
        content = gzip.compress(tarred(members))
    else:
        content = tarred([("inner.zip", zipped(members))])
    return pd.DataFrame({"path": [f"/in/batch{bucket}.{kind}"], "content": [content]})


def _archives(spark, sf_dir):
    docs = _documents(spark, sf_dir).select(F.floor(F.col("doc_id") / 50).alias("bucket"), "doc_id", "text")
    packed = docs.groupBy("bucket").applyInPandas(_pack_archive, _ARCHIVE_FIELDS)
    return spread(materialize(packed, "archives"))


def expand_archives(spark, sf_dir):
    found = archives.expand_archives(_archives(spark, sf_dir))
    return found.select(
        "upload_path", "source_archive", "relative_path", F.sha2("content", 256).alias("checksum"), "error"
    )


def _pack_damaged(group: pd.DataFrame) -> pd.DataFrame:
    """A zip of a bounded group; what its first member was packed to is overwritten."""
    members = sorted(zip(group["doc_id"], group["text"]))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as box:
        for ident, text in members:
            box.writestr(f"docs/{ident}.txt", text)
    content = bytearray(out.getvalue())
    start = 30 + len(f"docs/{members[0][0]}.txt")
    content[start : start + 4] = b"\xff" * 4
    return pd.DataFrame({"path": [f"/in/batch{int(group['bucket'].iloc[0])}.zip"], "content": [bytes(content)]})


def damaged_archives(spark, sf_dir):
    docs = _documents(spark, sf_dir).select(F.floor(F.col("doc_id") / 50).alias("bucket"), "doc_id", "text")
    packed = materialize(docs.groupBy("bucket").applyInPandas(_pack_damaged, _ARCHIVE_FIELDS), "archives")
    return archives.expand_archives(packed).select(
        "upload_path", "relative_path", F.sha2("content", 256).alias("checksum"), F.col("error").isNotNull().alias("failed")
    )


def list_archive(spark, sf_dir):
    return archives.list_archive(_archives(spark, sf_dir))


def _upload_files(spark, sf_dir):
    """Archives of documents next to single files of every kind."""
    return _archives(spark, sf_dir).unionByName(_named_files(spark, sf_dir).select("path", "content"))


def process_files(spark, sf_dir):
    """Archives uploaded twice; their documents come once, with the later upload."""
    uploads = _archives(spark, sf_dir)
    sized = uploads.withColumn("length", F.length("content").cast("bigint"))
    entries = [
        manifest.build_manifest(sized, uploaded_at=F.timestamp_seconds(F.lit(second)))
        for second in (1_699_999_000, 1_700_000_000)
    ]
    known = entries[0].unionByName(entries[1])
    loaded, _ = ingest.process_files(uploads, known)
    return loaded.select(
        "upload_id", "original_filename", "relative_path", "detected_mime_type",
        F.sha2("page_content", 256).alias("content_hash"),
    )


def file_outcomes(spark, sf_dir):
    _, outcomes = ingest.process_files(_upload_files(spark, sf_dir))
    return outcomes.groupBy("loader", "status").agg(F.count("*").alias("files"))


def _lines_in_files(df, path, line, order, head=""):
    """``(path, content)``: a file for each ``bucket`` with its lines in order."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct(order, line.alias("line")))), lambda x: x["line"])
    files_ = df.groupBy("bucket").agg(F.array_join(lines, "\n").alias("lines"))
    text = F.concat(F.lit(head), "lines", F.lit("\n"))
    return files_.select(F.format_string(path, "bucket").alias("path"), text.cast("binary").alias("content"))


def mixed_documents(spark, sf_dir):
    """Orders as CSV files, events as JSON Lines and documents as text files, loaded in one pass."""
    orders = table(spark, sf_dir, "orders").withColumn("bucket", F.floor(F.col("o_orderkey") / 500))
    events = table(spark, sf_dir, "events").withColumn("bucket", F.floor(F.col("event_id") / 1000))
    rows = F.concat_ws(",", "o_orderkey", "o_orderstatus")
    values = F.to_json(F.struct("event_id", "event_type", "value"))
    texts = _documents(spark, sf_dir).select(
        F.concat(F.lit("/in/doc"), "doc_id", F.lit(".txt")).alias("path"), F.col("text").cast("binary").alias("content")
    )
    mixed = (
        _lines_in_files(orders, "/in/orders%d.csv", rows, "o_orderkey", "o_orderkey,o_orderstatus\n")
        .unionByName(_lines_in_files(events, "/in/events%d.jsonl", values, "event_id"))
        .unionByName(texts)
    )
    loaded, _ = ingest.process_files(mixed)
    return loaded.select("source", "seq_num", "page_content", F.to_json("metadata").alias("metadata"))


def manifest_status(spark, sf_dir):
    uploads = _upload_files(spark, sf_dir)
    built = manifest.build_manifest(
        uploads.withColumn("length", F.length("content").cast("bigint")),
        uploaded_at=F.timestamp_seconds(F.lit(1_700_000_000)),
    )
    # Used twice below, and each use would read all files for their lengths.
    known = materialize(built.select("upload_id", "file_path", "status", "error_message"), "manifest")
    running = manifest.mark_processing(known, known.filter("status = 'completed'"))
    _, outcomes = ingest.process_files(uploads)
    return manifest.apply_outcomes(running, outcomes).select("file_path", "status", "error_message")


def stream_ingest(spark, sf_dir):
    docs = clean.clean_text(_documents(spark, sf_dir)).select(
        F.floor(F.col("doc_id") / 100).alias("bucket"), F.col("doc_id").alias("_order"), F.col("text").alias("value")
    )
    folder, target = scratch_path(spark, "incoming"), scratch_path(spark, "ingested")
    _write_bucketed(docs, folder, "_order", lambda w, p: w.text(p))
    streaming.ingest_available(spark, folder, target, scratch_path(spark, "progress"))
    loaded = spark.read.parquet(target)
    return loaded.select(_bucket_of("source").alias("bucket"), "seq_num", "page_content", "detected_mime_type")


_QUERIES = [
    clean_text, min_length_filter, max_length_truncate, corpus_funnel, train_val_split, word_vocab, token_decode,
    token_stats, processing_stats, token_ids, utf8_token_counts, pack_blocks, verify_tokens, data_budget,
    training_windows, token_bin_roundtrip, token_bin_ranges, text_splits_roundtrip, stats_json,
    repetition_score, diversity_score, coherence_by_lang, block_losses, benchmark_losses, bigram_perplexity,
    sampled_perplexity, generation_log_summary, evaluation_report,
    dataframe_documents, elements_single, elements_paged, elements_rows, elements_by_source, document_json,
    csv_documents, csv_mixed_headers, csv_columns, csv_ragged, tsv_documents, json_documents, json_array_documents, json_props,
    jsonl_documents, jsonl_rejects, text_documents, decode_fallback, gzip_text, blob_strings,
    token_window_chunks, token_id_windows, regex_split_drop, regex_split_start, literal_split_end,
    recursive_chunks, recursive_chunks_by_words, language_chunks, packed_chunks, lossless_chunks,
    file_manifest, manifest_roundtrip, mime_detect, archive_types, safe_filenames,
    expand_archives, damaged_archives, list_archive, process_files, file_outcomes, mixed_documents, manifest_status,
    stream_ingest,
]


def all_queries():
    """Name to callable ``(spark, sf_dir) -> DataFrame``."""

    def prepared(query):
        return lambda spark, sf_dir: query(ship_package(spark), sf_dir)

    return {query.__name__: prepared(query) for query in _QUERIES}
