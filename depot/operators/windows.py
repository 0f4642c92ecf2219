"""Ranking, versioning and per-group sequence operators.

Per-group work avoids windows over an unbounded group where a skew-safe
form exists: group totals are partial aggregates joined back (AQE splits a
hot key on the join), per-group sequences come from the global dense rank
minus the group's first rank, and top-N uses ``row_number() <= n`` which
Catalyst turns into a map-side group limit before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depot.operators.keys import dense_keys


def seq_within(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], out: str) -> DataFrame:
    """1, 2, ... within each group in ``order_cols`` order.

    Global dense rank over (group, order) minus the group's first rank: no
    task ever holds a whole group, so one hot group does not serialise."""
    g = dense_keys(df, list(group_cols) + list(order_cols), "_grank")
    first = g.groupBy(*group_cols).agg(F.min("_grank").alias("_gfirst"))
    return (g.join(first, list(group_cols))
            .withColumn(out, (F.col("_grank") - F.col("_gfirst") + 1).cast("long"))
            .drop("_grank", "_gfirst"))


def group_totals(df: DataFrame, group_cols: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    """Attach group aggregates to every row (skew-safe windowed sum, D15)."""
    totals = df.groupBy(*group_cols).agg(*[c.alias(n) for n, c in aggs.items()])
    return df.join(totals, list(group_cols), "left")


def top_n(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column], n: int,
          rank_col: str | None = None) -> DataFrame:
    """Keep the first ``n`` rows per group (E3); ``order`` must be a total
    order (add a unique tie key).  Up to ``spark.sql.optimizer.windowGroupLimitThreshold``
    (1,000) a task sends at most ``n`` rows of a group; for a larger ``n`` all
    rows of a group meet in one task."""
    w = Window.partitionBy(*group_cols).orderBy(*order)
    rn = rank_col or "_rn"
    out = df.withColumn(rn, F.row_number().over(w).cast("long")).filter(F.col(rn) <= n)
    return out if rank_col else out.drop(rn)


def latest_per_key(df: DataFrame, key_cols: Sequence[str], order_col: str,
                   tie_cols: Sequence[str] = ()) -> DataFrame:
    """Last version per key by ``order_col`` (E4), as an aggregate:
    ``max_by(struct(row), (order, ties))`` combines map-side, unlike a window."""
    others = [c for c in df.columns if c not in key_cols]
    ordering = F.struct(*[F.col(c) for c in [order_col, *tie_cols]])
    picked = df.groupBy(*key_cols).agg(F.max_by(F.struct(*others), ordering).alias("_v"))
    return picked.select(*key_cols, *[F.col(f"_v.{c}").alias(c) for c in others])


def first_per_key(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Earliest row per key (E5) via ``min_by``."""
    others = [c for c in df.columns if c not in key_cols]
    ordering = F.struct(*[F.col(c) for c in order_cols])
    # where the order is all there is of a row, the least one is the row
    least = F.min(ordering) if set(others) == set(order_cols) else F.min_by(F.struct(*others), ordering)
    picked = df.groupBy(*key_cols).agg(least.alias("_v"))
    return picked.select(*key_cols, *[F.col(f"_v.{c}").alias(c) for c in others])


def version_intervals(df: DataFrame, key_cols: Sequence[str], start_col: str,
                      end_col: str = "end_date") -> DataFrame:
    """end = next start - 1 day, null on the last version."""
    w = Window.partitionBy(*key_cols).orderBy(start_col)
    return df.withColumn(end_col, F.date_sub(F.lead(start_col).over(w), 1))


def compounded_walk(start: Column, factors: Column, floor: float = 0.01, scale: int = 4) -> Column:
    """Price path p[0] = max(floor, start), p[i] = max(floor, round(p[i-1] x f[i], scale))
    over an ordered array of factors (E7), in exact decimals.  ``aggregate``
    keeps the sequential floor exact, which an exp(sum(ln)) window cannot."""
    t = f"decimal(18,{scale})"
    lo = F.lit(floor).cast(t)
    init = F.array(F.greatest(lo, start.cast(t)))

    def step(acc, f):
        nxt = F.greatest(lo, F.round(F.element_at(acc, -1) * f, scale).cast(t))
        return F.concat(acc, F.array(nxt))

    return F.aggregate(factors, init, step)
