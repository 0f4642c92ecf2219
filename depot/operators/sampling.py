"""Repeatable samplers built on keyed draws (F ops).

Every draw is ``u(seed, salt, key)``, a pure function of the row key, so a
sample does not change with partitioning, retries or lost executors, and an
SQL engine can reproduce it exactly.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depot.functions.draws import keyed_uniform
from depot.operators.selection import smallest
from depot.operators.windows import top_n


def sample_rows(df: DataFrame, n: int, key_cols: Sequence[str], seed: int = 42) -> DataFrame:
    """At most ``n`` rows without replacement (F2): ordered by the keyed
    draw and limited; Spark plans it as a distributed TakeOrdered (each task
    keeps its n best)."""
    u = keyed_uniform(seed, "sample", *key_cols)
    return df.withColumn("_u", u).orderBy("_u", *key_cols).limit(n).drop("_u")


def fraction_sample(df: DataFrame, frac: float, key_cols: Sequence[str], seed: int = 42,
                    salt: str = "fraction") -> DataFrame:
    """Each row kept with probability ``frac`` (F3): a filter, no shuffle."""
    return df.filter(keyed_uniform(seed, salt, *key_cols) < frac)


def sample_exact_fraction(df: DataFrame, rate: float, key_cols: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly max(1, round(n x rate)) rows (F4), those with the smallest keyed
    draws: the last draw that stays is found by histograms (``selection``), and
    the sample is a filter on it.  No rows are sorted or written."""
    n = df.count()
    k = max(1, math.floor(n * rate + 0.5))
    u = keyed_uniform(seed, "exact", *key_cols)
    return smallest(df.withColumn("_u", u), F.col("_u"), k, n, key_cols).drop("_u")


def weighted_sample(df: DataFrame, group_cols: Sequence[str], weight_col: str, k: int,
                    key_cols: Sequence[str], seed: int = 42) -> DataFrame:
    """``k`` rows per group without replacement, with probability
    proportional to ``weight_col`` (F5): Efraimidis-Spirakis key
    -ln(u) / w, smallest k per group.  The rank filter becomes a map-side
    group limit, so a hot group sends at most k rows per task."""
    u = keyed_uniform(seed, "weighted", *key_cols)
    es = F.round(-F.log(F.greatest(u, F.lit(1e-12))) / F.col(weight_col).cast("double"), 9)
    return top_n(df.withColumn("es_key", es), group_cols, [F.col("es_key"), *[F.col(c) for c in key_cols]], k,
                 rank_col="sample_rank")


def weighted_category(u: Column, categories: Sequence[str], weights: Sequence[float]) -> Column:
    """Category whose cumulative cut point first exceeds the draw."""
    total = float(sum(weights))
    acc = 0.0
    expr = None
    for cat, w in zip(categories[:-1], weights[:-1]):
        acc += w / total
        expr = F.when(u < acc, F.lit(cat)) if expr is None else expr.when(u < acc, F.lit(cat))
    last = F.lit(categories[-1])
    return last if expr is None else expr.otherwise(last)


def impute_category(df: DataFrame, group_cols: Sequence[str], category_col: str, missing: Column,
                    key_cols: Sequence[str], seed: int = 42) -> DataFrame:
    """The rows whose category is ``missing``, with one drawn by the shares that
    the other rows of their group have (F6 with measured weights).

    The shares are one aggregate of (group, category) counts; their running sums
    cut 0..total into an interval per category, and a row takes the category in
    whose interval ``floor(u * total)`` lies.  Rows meet the cut points of their
    group in an equi-join (a hot group is split by the adaptive skew join; no
    group is collected).  A null group is a group, a null category is missing, and a row
    whose group holds no known category gets null."""
    missing = F.coalesce(missing, F.lit(False)) | F.col(category_col).isNull()
    counts = df.where(~missing).groupBy(*group_cols, category_col).agg(F.count(F.lit(1)).alias("_n"))
    own = Window.partitionBy(*group_cols)
    cuts = counts.select(*[F.col(c).alias(f"_g{k}") for k, c in enumerate(group_cols)], F.col(category_col).alias("_category"),
                         (F.sum("_n").over(own.orderBy(category_col)) - F.col("_n")).alias("_lo"), "_n", F.sum("_n").over(own).alias("_total"))
    rows = df.where(missing).drop(category_col).withColumn("_u", keyed_uniform(seed, "impute", *key_cols))
    at = F.floor(F.col("_u") * F.col("_total"))
    on = (at >= F.col("_lo")) & (at < F.col("_lo") + F.col("_n"))
    for k, c in enumerate(group_cols):
        on = on & F.col(c).eqNullSafe(F.col(f"_g{k}"))
    kept = [c for c in rows.columns if c != "_u"]
    return rows.join(cuts, on, "left").select(*kept, F.col("_category").alias(category_col))


def pick_one(df: DataFrame, group_cols: Sequence[str], choice_col: str, seed: int = 42,
             salt: str = "pick") -> DataFrame:
    """One ``choice_col`` value per group, uniformly by keyed draw (F7):
    ``min_by`` combines map-side, so a hot group never sits in one task."""
    u = keyed_uniform(seed, salt, *group_cols, choice_col)
    return df.groupBy(*group_cols).agg(F.min_by(F.col(choice_col), F.struct(u, F.col(choice_col))).alias(choice_col))


def conditional_bernoulli(df: DataFrame, prob: Column, key_cols: Sequence[str], seed: int = 42,
                          salt: str = "keep") -> DataFrame:
    """Row kept when its draw is <= its own probability (F8)."""
    return df.filter(keyed_uniform(seed, salt, *key_cols) <= prob)
