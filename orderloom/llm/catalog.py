"""One query per operator over its whole table, and SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import (
    bpe, collocations, embedding_dedup, jaccard_join, lexical_search, packing, quality_classifier, quality_rules, suffix_dedup, token_output, tokens, toxicity, twins, url_filters, warc,
)
from orderloom.llm.common import cut_lineage, read_table, shared_folder


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.url_filter(pages).drop("url")


def packed_documents(spark: SparkSession, docs: DataFrame, capacity: int = 1024) -> DataFrame:
    """Pieces of the texts of ``docs`` with their place in the packed sequences."""
    ranks = tokens.ranks_of(spark, public_tokenizers.path("byte_bpe_50k.json"))
    pieces = cut_lineage(tokens.token_pieces(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN, capacity), "pieces")
    lean = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(lean, ["doc_id", "piece", "start", "ids_crc32"], capacity)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(spark, read_table(spark, sf_dir, "documents"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_dedup.suffix_dedup(docs)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.round_trip(docs, ranks, public_tokenizers.PATTERN, keep_text=False)
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"))


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of 512 tokens at most, written in training order and read back from the shards."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = tokens.ranks_of(spark, public_tokenizers.path("byte_bpe_50k.json"))
    pieces = tokens.token_pieces(docs, ranks, public_tokenizers.PATTERN, 512, width=2)
    folder = shared_folder(spark, "tokens")
    index = token_output.write(pieces, folder, 20260101, 512, ["doc_id", "piece", "start"])
    # What is read back is as large as the corpus, though its plan begins at the small manifest: never broadcast.
    back = token_output.read(spark, folder).select("slot", F.col("length").alias("read_length"), F.crc32("ids").alias("ids_crc32"))
    return index.hint("merge").join(back.hint("merge"), "slot").select("doc_id", "piece", "start", "length", "slot", "shard", "byte_offset", "read_length", "ids_crc32")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    judged = quality_rules.quality_rules(docs, keep_text=False)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive(read_table(spark, sf_dir, "pages"))
    records = warc.read(spark, folder, with_payload=False)
    return records.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").where(~toxicity.held_out()).select("doc_id", "toxic")
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model, into="score")
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").where(~toxicity.held_out()).select("doc_id", "quality")
    scored = quality_classifier.score(docs, quality_classifier.fit(docs, labels), into="score")
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build(read_table(spark, sf_dir, "documents"))
    return lexical_search.search(spark, index, read_table(spark, sf_dir, "benchmark"))


_ALL = (
    op1_url_filters, op2_best_fit_packing, op3_embedding_dedup, op4_suffix_dedup, op5_byte_bpe, op6_jaccard_join, op7_token_output, op8_quality_rules, op9_warc, op10_toxicity,
    op11_quality_classifier, op12_collocations, op13_lexical_search,
)
QUERIES = {f.__name__: f for f in _ALL}
ORACLES = {
    "op3_embedding_dedup": twins.EMBEDDING_DEDUP,
    "op6_jaccard_join": twins.JACCARD_JOIN,
    "op8_quality_rules": twins.QUALITY_RULES,
    "op12_collocations": twins.COLLOCATIONS,
    "op13_lexical_search": twins.LEXICAL_SEARCH,
}
