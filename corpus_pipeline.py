"""A corpus pipeline over ``documents``: each stage is one operator, its result
is written as Parquet and read again as the next stage's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from depot.llm import cube, decontam, minmax, rendezvous, toxicity
from depot.llm.common import table
from depot.session import discard, scratch_path

SHARDS = 24


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of a toxic grade reaches one half go.  Null
    and empty texts stay, unless toxic texts are the rule; an empty table stays one."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays.  Null, empty and
    wordless texts are in no group; repeated rows are; an empty table stays one."""
    return minmax.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.  Null and empty texts hold none;
    without benchmark or documents nothing changes."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (0 to 2 times).  A null text
    has size 0, a null source is a source; an empty table stays one."""
    return cube.draw_rows(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, null ids and repeated rows included;
    none for an empty table."""
    return rendezvous.shard(docs, [1.0] * SHARDS)


STAGES = [("toxicity", remove_toxic), ("near_dedup", deduplicate), ("decontamination", decontaminate),
          ("mixing", mix_sources), ("sharding", shard)]

#: The classifier, the signatures and the balanced draw are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order.  A stage's documents are deleted once the next
    stage's stand, so at most two copies are there at a time."""
    docs, before = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        kept = stage(spark, docs, sf_dir)
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if before:
            discard(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
