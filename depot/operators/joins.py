"""Join operators: lookups with defaults, range and as-of joins, scaffolds.

Dimension lookups are plain joins: Spark broadcasts a side only when its
estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` (a checked
bound) and otherwise shuffles both sides; AQE re-decides at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depot.session import stored


def lookup(df: DataFrame, dim: DataFrame, on: str | Sequence[str], defaults: Mapping[str, object] | None = None,
           how: str = "left") -> DataFrame:
    """Left lookup of dimension columns; missing matches take ``defaults``."""
    out = df.join(dim, on, how)
    for c, v in (defaults or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out


def first_non_null(*cols: Column | str, default=None) -> Column:
    """Fallback chain (C4): the first non-null of the candidates, else ``default``."""
    cs = [F.col(c) if isinstance(c, str) else c for c in cols]
    if default is not None:
        cs.append(F.lit(default))
    return F.coalesce(*cs)


def cross_literals(df: DataFrame, name: str, values: Sequence) -> DataFrame:
    """Cross a DataFrame with a literal list (C8, C9) via ``explode``: no join."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def range_join(points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, how: str = "inner") -> DataFrame:
    """Rows of ``points`` whose date or timestamp ``at`` lies in [start, end] of an interval.

    Each interval is exploded into its days, so the match is an equi-join on
    the day plus the interval test: no nested loop, both sides may be large, and
    the keys are as many as there are days (a hot day is split by the adaptive
    skew join).  An end that is a date is that day's midnight, as in SQL.  An
    open end (null) runs to the last point (a one-row aggregate); an interval
    that ends before it starts has no days."""
    last = points.agg(F.max(at).alias("_last_point"))
    end_eff = F.coalesce(F.col(end), F.greatest(F.col("_last_point"), F.col(start)))
    iv = (intervals.crossJoin(last).filter(F.col(start) <= end_eff)
          .withColumn("_day", F.explode(F.sequence(F.col(start).cast("date"), end_eff.cast("date"), F.expr("INTERVAL 1 DAY"))))
          .drop("_last_point"))
    inside = (points[at] >= iv[start]) & (iv[end].isNull() | (points[at] <= iv[end]))
    return points.join(iv, (points[at].cast("date") == iv["_day"]) & inside, how).drop("_day")


def asof_join(facts: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, start: str,
              end: str | None = None, how: str = "left", max_rows: int = 1_000_000) -> DataFrame:
    """For each fact row, the version of its key in force at ``at`` (C15): the
    last one that starts at or before it, if it has not ended by then.

    Facts and versions are merged: one run per key in the order of time, in
    which the last version seen is carried along, so the work is linear in
    facts + versions however many versions a key has.  A key with more than
    ``max_rows`` rows is cut into slices of time; each slice starts with a
    border row, the last version before it, and facts of one instant that fill
    several slices are dealt over these.

    Without ``end`` a version lasts until the next one of its key; with it a
    fact after the end has no version.  Of versions that start together the
    one with the greatest columns counts (they must be orderable).  A fact with
    a null key or time has none."""
    keys = list(keys)
    held = [c for c in versions.columns if c not in keys]
    f = facts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(at).alias("_t"), F.lit(1).alias("_kind"),
                     F.struct(*facts.columns).alias("_f"))
    known = versions.filter(_and([F.col(c).isNotNull() for c in [*keys, start]]))
    v = known.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(start).alias("_t"), F.lit(0).alias("_kind"),
                     F.struct(*held).alias("_v"))
    ks = [f"_k{i}" for i in range(len(keys))]
    rows = f.unionByName(v, allowMissingColumns=True)
    sizes = rows.groupBy(*ks).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_rows)
    most = sizes.agg(F.max("_n")).first()[0]
    rows = rows.withColumn("_slice", F.lit(0)) if most is None else _sliced(rows, sizes, ks, -(-most // max_rows))
    run = Window.partitionBy(*ks, "_slice").orderBy("_t", "_kind", "_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = rows.withColumn("_v", F.last("_v", ignorenulls=True).over(run)).filter(F.col("_kind") == 1)
    if end is not None:
        merged = merged.withColumn("_v", F.when(F.col(f"_v.{end}").isNull() | (F.col("_t") <= F.col(f"_v.{end}")), F.col("_v")))
    if how == "inner":
        merged = merged.filter(F.col("_v").isNotNull())
    elif how != "left":
        raise ValueError(f"an as-of join is left or inner, not {how!r}")
    return merged.select("_f.*", *[F.col(f"_v.{c}").alias(c) for c in held])


def _sliced(rows: DataFrame, sizes: DataFrame, ks: list[str], pieces: int) -> DataFrame:
    """``rows`` with ``_slice``: keys of ``sizes`` cut at ``pieces - 1`` quantiles
    of their times, and a border row at the head of each slice but the first."""
    cuts = [i / pieces for i in range(1, pieces)]
    bounds = stored(rows.filter(F.col("_t").isNotNull()).join(sizes.select(*ks), ks, "left_semi").groupBy(*ks)
                    .agg(F.percentile_approx("_t", cuts, 10 * pieces).alias("_cuts")), "asof-cuts")
    cut = rows.join(bounds, ks, "left")
    below = F.size(F.filter("_cuts", lambda b: b < F.col("_t")))
    upto = F.size(F.filter("_cuts", lambda b: b <= F.col("_t")))
    # a version stands in the first slice that its time begins; facts at that time in any of them
    deal = F.when(F.col("_kind") == 1, F.pmod(F.xxhash64("_f"), F.greatest(upto - below, F.lit(1)))).otherwise(0)
    at = F.when(F.col("_cuts").isNull() | F.col("_t").isNull(), 0).when(upto > below, below + 1 + deal).otherwise(below)
    cut = cut.withColumn("_slice", at.cast("int")).drop("_cuts")
    last = (cut.filter(F.col("_kind") == 0).join(bounds.select(*ks), ks, "left_semi").groupBy(*ks, "_slice")
            .agg(F.max(F.struct("_t", "_v")).alias("_last")))
    each = bounds.select(*ks, F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))).alias("_slice"))
    before = Window.partitionBy(*ks).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)       # a row per slice
    border = (each.join(last, [*ks, "_slice"], "left").withColumn("_last", F.last("_last", ignorenulls=True).over(before))
              .filter(F.col("_last").isNotNull()).select(*ks, "_last._t", F.lit(0).alias("_kind"), "_last._v", "_slice"))
    return cut.unionByName(border, allowMissingColumns=True)


def _and(conds):
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out
