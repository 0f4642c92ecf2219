"""Gap-free key assignment (dense 1..N ids) without a one-partition window.

``row_number() OVER (ORDER BY k)`` with no PARTITION BY moves every row into
one task.  Here Spark's own range partitioning does the ordering:

1. the input is stored once, so what stands upstream runs once however
   often the rows are read again (a plain table is read where it lies);
2. ``repartitionByRange`` on all sort columns and ``sortWithinPartitions``
   put the rows in global order (a hot leading value is split by the columns
   after it); ``monotonically_increasing_id`` then holds the range number and
   the position in the range, and the result is stored once;
3. rows per range (a partial aggregate, one row per range, stored) give each
   range its offset; id = offset + position.

Nothing is collected.  Ids are a function of the order alone: number and
bounds of the ranges do not matter, and a lost executor reads stored rows.
Assigning ids is an eager step (its writes go to the shared scratch folder); the
first copy is deleted once the second stands, the second stays as long as the
result is read (``session.scratch_scope`` frees it).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depot.session import discard, scratch_path, stored, write_compact

_BITS = 33                                  # of the position in monotonically_increasing_id


def _n_ranges(df: DataFrame, rows: int) -> int:
    """Ranges by rows: 100,000 rows each while that does not exceed four
    waves of tasks, up to 1,000,000 rows each beyond."""
    waves = 4 * df.sparkSession.sparkContext.defaultParallelism
    return max(1, min(-(-rows // 100_000), waves), -(-rows // 1_000_000))


def dense_keys(df: DataFrame, order_cols: Sequence[str], id_col: str, start: int | Column = 1,
               n_ranges: int | None = None, keep: Sequence[Column] | None = None, plain: bool = False) -> DataFrame:
    """Add ``id_col`` = start, start+1, ... following the ascending order of
    ``order_cols`` (nulls first; a total order gives repeatable ids).

    ``keep``: what to store of the ordered rows, where not all columns are
    wanted behind the id.  ``plain``: ``df`` only reads and renames the columns
    of a stored table, so it is read again instead of being stored first."""
    spark = df.sparkSession
    if plain:
        staged = df
    else:
        source = scratch_path(spark, "keys-input")
        write_compact(df, source)
        staged = spark.read.schema(df.schema).parquet(source)
    n = n_ranges or _n_ranges(staged, staged.count())
    ordered = staged.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    placed = stored(ordered.select(*(keep or df.columns), F.monotonically_increasing_id().alias("_place")), "keys-ordered")
    if not plain:
        discard(spark, source)                  # only the ordered copy is read from here on
    columns = [c for c in placed.columns if c != "_place"]
    placed = placed.select(*columns, F.shiftright("_place", _BITS).alias("_range"),
                           F.col("_place").bitwiseAND(F.lit((1 << _BITS) - 1)).alias("_at"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range: a single-task window of bounded size
    offsets = stored(placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
                     .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")), "keys-offsets")
    start_col = start if isinstance(start, Column) else F.lit(start)
    return (placed.join(F.broadcast(offsets), "_range")
            .withColumn(id_col, (F.col("_off") + F.col("_at") + start_col).cast("long"))
            .drop("_range", "_at", "_off"))
