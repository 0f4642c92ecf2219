"""Aggregate operators: exact quantile, min-max scaling, counts and
profiles.  Global statistics are one-row aggregates joined back with a
broadcast (size 1 by construction), never an unpartitioned window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depot.operators import selection


def exact_percentile(df: DataFrame, col: str, p: float, tie_cols: Sequence[str] = ()) -> DataFrame:
    """Exact percentile with linear interpolation (D10), as one row ``value``.

    ``percentile()`` keeps every distinct value in one aggregation buffer;
    here histograms narrow the range around the rank (``selection``): no sort,
    and nothing is written.  ``tie_cols`` are not needed and stay for callers
    that name them.  Eager: the value is found when this is called."""
    value = selection.interpolated(df, col, p)
    return df.sparkSession.range(1).select(F.lit(value).cast("double").alias("value"))


def by_order(lines: DataFrame, orders: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lines joined with their orders and summed per order and ``keys`` (D4):
    units ``_q``, revenue ``_m`` and ``order_date``.  Orders per key are then a
    plain count of these rows, which a further aggregate takes in the shuffle
    that it needs anyway; a distinct count would expand and shuffle the join."""
    j = (lines.select("order_id", "item_id", "quantity_ordered", "extended_price")
         .join(orders.select("order_id", "customer_id", "order_date"), "order_id"))
    return j.groupBy("order_id", *keys).agg(F.sum("quantity_ordered").alias("_q"), F.sum("extended_price").alias("_m"),
                                            F.max("order_date").alias("order_date"))


def minmax_normalize(df: DataFrame, col: str, out: str) -> DataFrame:
    """(x - min) / (max - min) over the whole column; a constant column -> 0.5."""
    mm = df.agg(F.min(F.col(col).cast("double")).alias("_mn"), F.max(F.col(col).cast("double")).alias("_mx"))
    x = F.col(col).cast("double")
    return (df.crossJoin(F.broadcast(mm))
            .withColumn(out, F.when(F.col("_mx") == F.col("_mn"), F.lit(0.5))
                        .otherwise((x - F.col("_mn")) / (F.col("_mx") - F.col("_mn"))))
            .drop("_mn", "_mx"))


def record_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table plus a TOTAL row (D13), via ``rollup``."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
             for name, df in tables.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return (u.rollup("table_name").agg(F.sum("n").cast("long").alias("row_count"))
            .select(F.coalesce("table_name", F.lit("TOTAL")).alias("table_name"), "row_count"))


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, columns and null cells per table (D14): one pass per table."""
    parts = []
    for name, df in tables.items():
        nulls: Column = F.lit(0).cast("long")
        for c in df.columns:
            nulls = nulls + F.count_if(F.col(c).isNull())
        parts.append(df.agg(F.count(F.lit(1)).cast("long").alias("row_count"), nulls.alias("null_cells"))
                     .select(F.lit(name).alias("table_name"), "row_count",
                             F.lit(len(df.columns)).alias("column_count"), "null_cells"))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u
