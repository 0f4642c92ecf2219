"""The registered queries: every operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depot.llm import centroids, chat, cube, decontam, html_blocks, maxent, minmax, pii, quality, rendezvous, resample, toxicity, warc
from depot.llm.common import table
from depot.llm.oracle import ORACLE

SHARDS = 24


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", planted), (-7, 1, "assistant", planted)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_turns(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    return maxent.score(table(spark, sf_dir, "documents"), held_out)


def op5_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(table(spark, sf_dir, "pages"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), min_bytes=0)
    return warc.read_archives(manifest, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.mix(table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "taken")


def op10_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendezvous.shard(table(spark, sf_dir, "documents"), [1.0] * SHARDS)


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents")).withColumn("spans", pii.joined())


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


_ALL = [op1_chat_format, op2_quality_rules, op3_decontaminate, op4_lm_score, op5_minmax_dedup, op6_toxicity,
        op7_html_extract, op8_warc, op9_mix_sources, op10_shard, op11_pii, op12_resample, op13_centroids, pipeline]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _ALL}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
