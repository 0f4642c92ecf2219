"""Mixing sources to target weights by the cube method.

Targets: every source's share of the wanted words by weight, capped at a
multiple of what the source has; the excess is shared again by weight until
no source is above its cap (a closed-form water filling over the sources).

Sampling: a document is taken ``floor(r)`` times whole, ``r`` = target /
source size, plus once more with probability ``r - floor(r)``.  The flight
phase moves these probabilities along the null space of the balancing
constraints (documents and words of the source), three documents at a time,
inside blocks of bounded size; at most two or three documents per block stay
undecided and are dealt into fewer blocks, again and again, until one small
block per source is left, whose last documents land by a fixed draw.  Blocks
are dealt by hash, so one source with most rows is many blocks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from depot.llm.common import WORD, digests, fresh, map_groups, repeated, split, stored
from depot.session import scratch_path, scratch_scope


def targets(sizes: DataFrame, weights: Sequence[float], total_factor: float, cap_factor: float) -> DataFrame:
    """Per source: ``source_size``, ``source_rows`` and ``target`` (words).

    ``sizes`` has one row per source (source, source_size, source_rows).
    Water filling without iteration: with sources in rising order of
    cap / weight, the first k are at their cap where k is the longest prefix
    whose next cap / weight does not exceed the level left for the rest.
    Number of sources: a dimension, but no collect or broadcast is forced."""
    w = Window.orderBy(F.col("source").asc_nulls_last())
    n = len(weights)
    pick = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(w) - 1, F.lit(n)) + 1).cast("int"))
    s = sizes.withColumn("_w", pick).withColumn("_cap", F.col("source_size") * float(cap_factor))
    order = Window.orderBy((F.col("_cap") / F.col("_w")).asc(), F.col("source").asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    s = (s.withColumn("_caps", F.sum("_cap").over(upto) - F.col("_cap"))          # caps of those before
         .withColumn("_rest", F.sum("_w").over(after))                            # weight from here on
         .withColumn("_wanted", F.lit(float(total_factor)) * F.sum("source_size").over(Window.partitionBy())))
    # level if all before are full; a source is full while its cap / weight is at most that level
    s = s.withColumn("_level", (F.col("_wanted") - F.col("_caps")) / F.col("_rest"))
    s = s.withColumn("_full", F.col("_cap") <= F.col("_level") * F.col("_w"))
    s = s.withColumn("_open", F.min(F.when(~F.col("_full"), F.struct(F.col("_cap") / F.col("_w"), F.col("_level")))).over(Window.partitionBy()))
    return s.select("source", "source_size", "source_rows",
                    F.when(F.col("_full"), F.col("_cap")).otherwise(F.col("_open")["_level"] * F.col("_w")).cast("double").alias("target"))


def flight(prob: np.ndarray, size: np.ndarray, landing: np.ndarray | None) -> np.ndarray:
    """Move probabilities to 0 or 1 keeping sum(prob) and sum(prob * size).

    Takes three undecided documents at a time; (1, size) has a null vector
    over them, and a step to the nearer or farther wall, chosen by a draw of
    the documents' own keys so that the expected move is nil, decides at least
    one.  What cannot move stays fractional, or (``landing``: a draw for each
    document) is rounded by its draw."""
    p = prob.astype(float).copy()
    rng = np.random.default_rng(int(np.sum(size) * 1000003 + len(size)) & 0x7FFFFFFF)
    eps = 1e-9
    p[p < eps], p[p > 1 - eps] = 0.0, 1.0
    todo = list(np.flatnonzero((p > 0) & (p < 1))[::-1])
    live: list[int] = []
    draws = rng.random(max(1, 2 * len(todo) + 8))
    k = 0
    while True:
        while len(live) < 3 and todo:
            live.append(int(todo.pop()))
        if len(live) < 2:
            break
        if len(live) == 3:
            a, b, c = (float(size[i]) for i in live)
            u = [b - c, c - a, a - b]                   # (1,1,1).u = 0 and (a,b,c).u = 0
            if u == [0.0, 0.0, 0.0]:
                u = [1.0, -1.0, 0.0]
        else:
            a, b = (float(size[i]) for i in live)
            if a != b:
                break                                   # two documents of different size: nothing keeps both sums
            u = [1.0, -1.0]
        up = down = np.inf
        for i, x in zip(live, u):
            if x > 0:
                up, down = min(up, (1 - p[i]) / x), min(down, p[i] / x)
            elif x < 0:
                up, down = min(up, p[i] / -x), min(down, (1 - p[i]) / -x)
        step = up if draws[k % len(draws)] < down / (up + down) else -down
        k += 1
        for i, x in zip(live, u):
            v = p[i] + step * x
            p[i] = 0.0 if v < eps else 1.0 if v > 1 - eps else v
        live = [i for i in live if 0.0 < p[i] < 1.0]
    if landing is not None:
        rest = [*live, *todo]
        # the sum of what is left is rounded once: the documents with the lowest draws are taken
        wanted = sum(p[i] for i in rest)
        n = int(wanted) + (1 if rest and landing[rest[0]] < wanted - int(wanted) else 0)
        for j, i in enumerate(sorted(rest, key=lambda i: landing[i])):
            p[i] = 1.0 if j < n else 0.0
    return p


def _fly(last: bool):
    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(tables))         # one block: bounded by construction
        order = np.lexsort([t.column(c).to_numpy() for c in ("_i", "_key")])
        t = t.take(pa.array(order))
        draw = (t.column("_key").to_numpy().astype(np.uint64) >> np.uint64(11)) / float(1 << 53)
        p = flight(t.column("prob").to_numpy(), t.column("size").to_numpy(), draw if last else None)
        t = t.set_column(t.schema.get_field_index("prob"), "prob", pa.array(p))
        yield from t.to_batches()
    return run


def mix(docs: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), total_factor: float = 1.5, cap_factor: float = 2.0,
        key: str = "doc_id", text: str = "text", source: str = "source", block: int = 2048) -> DataFrame:
    """Draw a mix of ``docs``.

    Returns one row per input row: key, source, ``size`` (words), ``source_size``,
    ``target``, ``copies`` (times the document is in the mix) and ``taken``
    (size * copies).  Sources are numbered by code point, null last; null text
    has size 0 (its copies do not change any word total); a null key is a value
    like any other; equal rows are told apart by their count, so any number of
    repeats is dealt into blocks evenly; an empty table gives an empty result;
    further columns are ignored.  Every choice comes from hashes of the row, so
    reruns agree.  ``block``: documents in a block of the flight phase."""
    docs = docs.select(F.col(key).alias("_id"), F.col(source).alias("source"),
                       F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    rows = stored(docs.groupBy("_id", "source", "size").agg(F.count(F.lit(1)).alias("_m")), "mix-rows")
    per_source = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("_m")).alias("source_size"), F.sum("_m").alias("source_rows"))
    goal = stored(targets(per_source, weights, total_factor, cap_factor), "mix-targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    units = (repeated(rows, "_m", "_i").drop("_m")
             .join(goal.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
             .withColumn("_base", F.floor(ratio + 1e-12)).withColumn("prob", F.greatest(ratio - F.col("_base"), F.lit(0.0)))
             .withColumn("_key", F.xxhash64("_id", "source", "size", "_i"))
             .select("_id", "source", "size", "source_size", "source_rows", "target", "_base", "_i", "_key", "prob"))
    undecided = (F.col("prob") > 0) & (F.col("prob") < 1)
    done, open_ = [units.where(~undecided)], units.where(undecided)
    # blocks of each level: at most two documents of a block stay undecided
    most = goal.agg(F.max("source_rows")).first()[0] or 0       # one number: rows of the largest source
    blocks, most = F.ceil(F.col("source_rows") / F.lit(block)), -(-most // block)
    level = 0
    while most:
        dealt = open_.withColumn("_block", F.pmod(F.xxhash64(F.lit(level), "_key"), blocks).cast("long"))
        flown = map_groups(dealt, ["source", "_block"], _fly(most == 1), dealt.schema).drop("_block")
        flown = stored(flown, f"mix-level{level}")
        done.append(flown.where(~undecided))
        if most == 1:
            break
        open_, level = flown.where(undecided), level + 1
        blocks, most = F.ceil(blocks * 2 / F.lit(block)), -(-2 * most // block)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    copies = (F.col("_base") + F.round(F.col("prob"))).cast("long")
    return out.select(F.col("_id").alias(key), F.col("source"), "size", "source_size", "target",
                      copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def draw_rows(docs: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), total_factor: float = 1.5, cap_factor: float = 2.0,
              key: str = "doc_id", text: str = "text", source: str = "source", block: int = 2048) -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, each as often as it is taken.

    Rows are told apart by key, source and size; the copies of such a group
    are dealt over its rows evenly, the first by a hash taking one more.  How
    often a row is taken is settled on digests of the rows, a list for once, one
    for twice and so on; texts stay where they are (``common.split``).  Equal rows
    are counted first, so any number of repeats is one row.  Nulls as in ``mix``."""
    spark = docs.sparkSession
    k, s, z, one, two, times, i = fresh(docs, "_k", "_s", "_z", "_digest", "_digest2", "_times", "_i")
    marked = digests(docs, one, two)
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    path = scratch_path(spark, "mix-times")
    with scratch_scope(spark):
        goal = (mix(docs, weights, total_factor, cap_factor, key, text, source, block).groupBy(F.col(key).alias("k"), F.col(source).alias("s"), F.col("size").alias("z"))
                .agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")).where("copies > 0"))
        rows = (marked.select(F.col(key).alias(k), F.col(source).alias(s), size.alias(z), one, two)
                .groupBy(k, s, z, one, two).agg(F.count(F.lit(1)).alias("same")))
        group = rows.join(goal, F.col(k).eqNullSafe(F.col("k")) & F.col(s).eqNullSafe(F.col("s")) & (F.col(z) == F.col("z")))
        order = Window.partitionBy(k, s, z).orderBy(one, two).rowsBetween(Window.unboundedPreceding, -1)
        before, more = F.coalesce(F.sum("same").over(order), F.lit(0)), F.pmod(F.col("copies"), F.col("rows"))
        dealt = F.floor(F.col("copies") / F.col("rows")) * F.col("same") + F.greatest(F.least(F.col("same"), more - before), F.lit(0))
        (group.select(one, two, "same", dealt.cast("long").alias("taken")).where("taken > 0").write.parquet(path))
    taken = spark.read.schema(f"{one} long, {two} long, same long, taken long").parquet(path)
    # rows that stand once are taken 0 to n times, each time by a list of its own; a repeated row
    # is taken as often as its rows together
    names = [F.col(f"`{c}`") for c in docs.columns]
    alone, several = taken.where("same = 1"), taken.where("same > 1")
    out, left = None, marked
    if several.limit(1).count():
        group, left = split(left, several.select(one, two), one, two)
        out = repeated(group.dropDuplicates([one, two]).join(several.select(one, two, F.col("taken").alias(times)), [one, two]), times, i).select(*names)
    most = alone.agg(F.max("taken")).first()[0] or 0
    for n in range(1, most + 1):
        left, _ = split(left, alone.where(F.col("taken") >= n).select(one, two), one, two)
        out = left.select(*names) if out is None else out.unionByName(left.select(*names))
    return out if out is not None else docs.limit(0)
