"""Distributed selection: the value at a rank, without sorting or storing rows.

A first aggregate gives the row count and, from Spark's quantile sketch, a
bracket around the rank.  Each further pass counts the rows below the bracket
and in ``BUCKETS`` equal parts of it and goes on with the part that holds the
rank, until that is a single value or has few enough distinct rows to count
them one by one.  A pass returns ``BUCKETS`` rows at most; a value that most
rows share ends the search at once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

BUCKETS = 1024
#: Rows that are counted value by value instead of being narrowed further.
FEW = 10_000

_BELOW, _ABOVE, _INF, _NAN = -1, BUCKETS, BUCKETS + 1, BUCKETS + 2       # and -2 for -inf


def _near(values: DataFrame, rank: int, n: int) -> tuple[float, float, float, float]:
    """(least, greatest finite value, bracket) for a rank of ``n`` values."""
    x = F.when(~F.isnan("x") & (F.abs("x") != float("inf")), F.col("x"))
    p = rank / n
    near = [max(0.0, p - 0.001), min(1.0, p + 0.001)]
    r = values.agg(F.min(x).alias("a"), F.max(x).alias("b"), F.percentile_approx(x, near, 10_000).alias("q")).first()
    return (r["a"], r["b"], *r["q"]) if r["a"] is not None else (0.0, 0.0, 0.0, 0.0)


def value_at(values: DataFrame, rank: int, n: int) -> tuple[float, int, int]:
    """(value, rows below it, rows equal to it) at the 1-based ``rank`` of ``n``
    doubles in column ``x`` (no nulls; NaN is above all, as Spark sorts)."""
    least, greatest, lo, hi = _near(values, rank, n)
    while True:
        width = hi / 2 - lo / 2
        part = F.floor((F.col("x") / 2 - lo / 2) / F.lit(width) * BUCKETS) if width > 0 else F.lit(0)
        bucket = (F.when(F.isnan("x"), _NAN).when(F.col("x") == float("inf"), _INF).when(F.col("x") == float("-inf"), -2)
                  .when(F.col("x") < lo, _BELOW).when(F.col("x") > hi, _ABOVE).otherwise(F.least(part, F.lit(BUCKETS - 1))))
        counts = values.groupBy(bucket.cast("int").alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()
        seen = 0
        for r in sorted(counts, key=lambda r: r["b"]):
            if seen + r["n"] >= rank:
                break
            seen += r["n"]
        if r["b"] in (-2, _INF, _NAN) or r["lo"] == r["hi"]:
            return r["lo"], seen, r["n"]
        lo, hi = r["lo"], r["hi"]                    # the least and greatest value there: the part shrinks every time
        if r["n"] <= FEW:
            for v in sorted(values.filter(F.col("x").between(lo, hi)).groupBy("x").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda v: v["x"]):
                if seen + v["n"] >= rank:
                    return v["x"], seen, v["n"]
                seen += v["n"]


def kept_values(df: DataFrame, x) -> DataFrame:
    """The non-null values of ``x`` as column ``x``, held by the executors (on
    disk where memory is short) for the passes; a lost one computes its part again."""
    return df.select(x.cast("double").alias("x")).filter(F.col("x").isNotNull()).persist(StorageLevel.MEMORY_AND_DISK)


def interpolated(df: DataFrame, col: str, p: float) -> float | None:
    """Exact percentile with linear interpolation; None without values."""
    values = kept_values(df, F.col(col))
    try:
        n = values.count()
        if not n:
            return None
        at = p * (n - 1)                            # 0-based, as percentile() counts
        low, below, same = value_at(values, math.floor(at) + 1, n)
        if at == math.floor(at) or below + same >= math.floor(at) + 2:
            return low
        high = values.agg(F.min(F.when(F.col("x") > low, F.col("x")))).first()[0]
        return low + (at - math.floor(at)) * (high - low)
    finally:
        values.unpersist()


def smallest(df: DataFrame, draw, k: int, n: int, tie_cols: Sequence[str]) -> DataFrame:
    """The ``k`` of ``n`` rows with the smallest ``draw`` (a column without
    nulls), ties by ``tie_cols``; ranks are only taken among the rows that share the last draw."""
    from depot.operators.keys import dense_keys

    if k >= n:
        return df
    values = kept_values(df, draw)
    try:
        last, below, same = value_at(values, k, n)
    finally:
        values.unpersist()
    first = df.filter(draw < last)
    ties = df.filter(draw == last)
    if k - below < same:
        ties = dense_keys(ties, list(tie_cols), "_tie").filter(F.col("_tie") <= k - below).drop("_tie")
    return first.unionByName(ties)
