"""Sharding by rendezvous (highest-random-weight) hashing.

Every record key is hashed with every shard's name; the shard with the
smallest ``-ln(u) / weight`` owns the record.  Adding a shard can only take
records for itself, removing one only deals out its own: nothing else moves.
All native expressions; the two shuffles carry ids and sizes, never texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depot.llm.common import repeated


def draw(key: Column, shard: int, seed: str = "shard") -> Column:
    """u in (0, 1) from the key and the shard's number: 52 bits of an md5."""
    digest = F.md5(F.concat(F.lit(f"{seed}/{shard}/"), key))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def owner(key: Column, weights: Sequence[float], seed: str = "shard") -> Column:
    """Struct (score, shard) of the shard that owns ``key``; equal scores go to the lower number."""
    scores = [F.struct((-F.ln(draw(key, j, seed)) / F.lit(float(w))).alias("score"), F.lit(j).alias("shard"))
              for j, w in enumerate(weights)]
    return F.least(*scores) if len(scores) > 1 else scores[0]


def shard(docs: DataFrame, weights: Sequence[float], key: str = "doc_id", text: str = "text",
          grown: Sequence[float] | None = None, seed: str = "shard", rows_a_part: int = 50_000) -> DataFrame:
    """Deal ``docs`` into ``len(weights)`` shards.

    Returns one row per input row: key, ``size`` (UTF-8 bytes of the text plus
    8; null text: 8), ``text_crc32``, ``law`` ('key'), ``shard``, ``slot``
    (gapless from 0 within the shard, by a fixed pseudo-random order of key,
    size and crc) and ``grown_shard`` (owner among ``grown`` weights, one more
    shard of mean weight by default).

    A null key is a key of its own.  Equal rows are counted first and get
    adjoining slots, so rows repeated any number of times cost one group row;
    slots come from part totals (a part: a hash range of a shard, about
    ``rows_a_part`` rows), so no task holds a shard.  An empty table gives an
    empty result; further columns are ignored."""
    weights = list(weights)
    grown = list(grown) if grown is not None else [*weights, sum(weights) / len(weights)]
    name = F.coalesce(F.col(key).cast("string"), F.lit("\x00null"))
    rows = docs.select(
        F.col(key).alias(key),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"))
    groups = rows.groupBy(key, "size", "text_crc32").agg(F.count(F.lit(1)).alias("_n"))
    placed = groups.withColumn("_own", owner(name, weights, seed)).withColumn("shard", F.col("_own")["shard"].cast("int"))
    if grown[:len(weights)] == weights and len(grown) == len(weights) + 1:
        # the new shard wins or nothing changes: its score against the owner's
        new = -F.ln(draw(name, len(weights), seed)) / F.lit(float(grown[-1]))
        moved = F.when(new < F.col("_own")["score"], F.lit(len(weights))).otherwise(F.col("shard"))
    else:
        moved = owner(name, grown, seed)["shard"]
    placed = placed.withColumn("grown_shard", moved.cast("int")).drop("_own")
    # parts: hash ranges of the shard; their number grows with the rows
    parts = parts_for(docs, rows_a_part * len(weights))
    order = F.xxhash64(F.col(key), F.col("size"), F.col("text_crc32"))
    placed = placed.withColumn("_order", order).withColumn("_part", F.pmod(F.col("_order"), F.lit(parts)).cast("int"))
    totals = placed.groupBy("shard", "_part").agg(F.sum("_n").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("shard", "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("shard", "_part").orderBy("_order", F.col(key).asc_nulls_first(), "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    return (repeated(ranked.join(offsets, ["shard", "_part"]), "_n", "_i")
            .select(key, "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("_off") + F.col("_in") + F.col("_i")).alias("slot"), "grown_shard"))


def parts_for(df: DataFrame, rows_a_part: int) -> int:
    """Number of parts of about ``rows_a_part`` rows, by a count of the input."""
    return max(1, -(-df.count() // rows_a_part))
