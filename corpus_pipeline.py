"""Corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripdemand.llm.common import bounded_broadcast, materialize, read
from tripdemand.llm.decontaminate import benchmark_hits
from tripdemand.llm.line_dedup import WIDTH, dedup_lines
from tripdemand.llm.ngram_join import ngram_jaccard_join
from tripdemand.llm.queries import PIECE_MODEL
from tripdemand.llm.sentencepiece_np import encode_texts
from tripdemand.llm.toxicity import score_toxicity


#: Ids (8 bytes each) that may be broadcast to filter the texts where they are; more are joined by a shuffle.
BROADCAST_IDS = 2_000_000


def without(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Rows of ``docs`` whose ``key`` is not in ``gone``."""
    gone = materialize(gone.select(key).distinct(), "stage-gone")
    return docs.join(bounded_broadcast(gone, BROADCAST_IDS), key, "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.3 or more go."""
    scored = score_toxicity(docs, read(spark, sf_dir, "labels"))
    return scored.where("predicted = 0").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-copies of a line the first over all documents stays; rows stay, n_chars follows the text."""
    out = dedup_lines(docs, width=WIDTH).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of 3-word shingle Jaccard >= 0.9 stays: the one of the smallest doc_id.

    Every row is judged by its own text: rows that share a doc_id, or have none (these count as the
    largest), are documents of their own, and repeated rows are copies of each other. Documents without
    words (emptied by the line stage, for one) link with nothing and stay.
    """
    rows = materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "stage-rows")
    groups = ngram_jaccard_join(rows.select(F.col("_row").alias("doc_id"), "text")) \
        .select(F.col("doc_id").alias("_row"), "component_id")
    groups = materialize(groups.join(rows.select("_row", "doc_id"), "_row"), "stage-groups")
    stays = groups.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row"))["_row"].alias("stays"))
    gone = groups.join(stays, "component_id").where("_row <> stays")
    return without(rows, gone, "_row").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window (10 words) go; rows that share a doc_id, or have none, each by its own text."""
    hits = materialize(benchmark_hits(docs, read(spark, sf_dir, "benchmark")).select("doc_id", "text_hash").distinct(), "stage-gone")
    d, h = docs.alias("d"), bounded_broadcast(hits, BROADCAST_IDS).alias("h")
    return d.join(h, F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.xxhash64("d.text") == F.col("h.text_hash")), "left_anti") \
        .select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left: doc_id, n_tokens, ids."""
    return encode_texts(docs.select("doc_id", "text"), PIECE_MODEL).select("doc_id", "n_tokens", "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

#: The first, second and last stage are not expressible in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
