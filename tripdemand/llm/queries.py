"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripdemand.llm.burst_trie import prefix_trie
from tripdemand.llm.common import read
from tripdemand.llm.decontaminate import decontaminate
from tripdemand.llm.html_extract import extract_main_text
from tripdemand.llm.langid import identify_language
from tripdemand.llm.lattice_dedup import lattice_near_dedup
from tripdemand.llm.line_dedup import WIDTH, dedup_lines
from tripdemand.llm.merkle import manifest
from tripdemand.llm.ngram_join import ngram_jaccard_join
from tripdemand.llm.nn_descent import nearest
from tripdemand.llm.oracle import OP6, OP7, OP11, OP13
from tripdemand.llm.pii import find_personal_data
from tripdemand.llm.sentencepiece_np import encode_digest
from tripdemand.llm.suffix_dedup import remove_repeats
from tripdemand.llm.toxicity import score_toxicity

#: A SentencePiece model; read on the driver only.
PIECE_MODEL = os.environ.get("SENTENCEPIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(read(spark, sf_dir, "documents"))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read(spark, sf_dir, "pages"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_near_dedup(read(spark, sf_dir, "embeddings"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = find_personal_data(read(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                      F.sha2(F.concat_ws(",", "base_spans"), 256).alias("base_sha256"), F.concat_ws(",", "spans").alias("spans"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digest(read(spark, sf_dir, "documents"), PIECE_MODEL)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = dedup_lines(read(spark, sf_dir, "documents"), width=WIDTH)
    return got.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(read(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return got.select("doc_id", "held_out", "score", "predicted")


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = remove_repeats(read(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(read(spark, sf_dir, "documents"))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_embedding_near_dedup": op2_embedding_near_dedup,
    "op3_personal_data": op3_personal_data,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_line_dedup": op5_line_dedup,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_language_id": op8_language_id,
    "op9_toxicity": op9_toxicity,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_nearest_neighbours": op12_nearest_neighbours,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLE_SQL: dict[str, str] = {"op6_ngram_jaccard_join": OP6, "op7_benchmark_decontamination": OP7, "op11_merkle_manifest": OP11, "op13_prefix_trie": OP13}
