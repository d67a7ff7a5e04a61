"""One query per operator, each over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import best_fit, block_search, byte_bpe, context_tree, html_layout, interleave, license_scan, line_rules, ngram_join, phrases, quality_net, repair, toxicity_mil
from strata.llm.common import fold, read_table


def op1_block_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_search.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score(read_table(spark, sf_dir, "documents"), fold() == 1)


def op3_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_rules.judged(read_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "kept_chars", "kept_words")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(read_table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = byte_bpe.round_trip(read_table(spark, sf_dir, "documents"))
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(read_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity_mil.score(docs, toxicity_mil.fit(docs, read_table(spark, sf_dir, "labels")))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licences(read_table(spark, sf_dir, "documents")).drop("matches")


def op9_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_layout.extracted(read_table(spark, sf_dir, "pages"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality_net.score(docs, quality_net.fit(docs, read_table(spark, sf_dir, "labels")))


def op11_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", interleave.size().alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.md5(text).alias("digest"))
    placed = interleave.shards(docs, content=F.col("digest"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repair.damaged(read_table(spark, sf_dir, "conversations"))
    return repair.audits(rows, F.col("dropped")).drop("made")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents")).drop("first_doc", "first_start")


QUERIES = {
    f.__name__: f
    for f in (
        op1_block_search,
        op2_context_tree,
        op3_line_rules,
        op4_ngram_join,
        op5_byte_bpe,
        op6_best_fit,
        op7_toxicity,
        op8_license_scan,
        op9_html_layout,
        op10_quality,
        op11_interleave,
        op12_repair,
        op13_phrases,
    )
}

#: SQL for DuckDB; the other operators are learned, approximate or iterative and are tested by brute force.
ORACLE: dict[str, str] = {"op3_line_rules": line_rules.oracle(), "op11_interleave": interleave.oracle(), "op12_repair": repair.oracle(), "op13_phrases": phrases.oracle()}
