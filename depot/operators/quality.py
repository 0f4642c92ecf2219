"""Data-quality checks against declared schemas (K ops) and schema
conformance (A7).  Every check returns a DataFrame of findings (never raises
and never collects), so a report can be written or joined like any table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depot.sources.schemas import TableSpec


def conform_to_schema(df: DataFrame, schema: T.StructType, safe: bool = True) -> DataFrame:
    """Cast every declared column to its type, in declared order.
    ``try_cast`` turns dirty values into nulls instead of failing the job;
    decimals are rounded half-up to their declared scale by the cast.
    Declared columns missing from ``df`` become typed nulls."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            c = F.col(f.name)
            cols.append((c.try_cast(f.dataType) if safe else c.cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def conform_losses(df: DataFrame, schema: T.StructType) -> DataFrame:
    """What ``conform_to_schema`` turns into null: (column_name, lost) for
    every declared column of ``df``, in one aggregate."""
    cols = [f for f in schema.fields if f.name in df.columns]
    lost = df.agg(*[F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name) for f in cols])
    rows = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).cast("long").alias("lost")) for f in cols])
    return lost.select(F.inline(rows))


def check_declared(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec]) -> DataFrame:
    """All checks that the declared specs call for on the given tables:
    (table_name, check_name, subject, failures), a row per check, kept or broken.

    Rows of a table are read as the declared types.  One aggregate per table
    counts empty tables (``non_empty``), nulls in NOT NULL columns
    (``not_null``) and values that the cast turns to null (``lost_in_cast``).
    One shuffle per key does the rest: the values of the key and of every column
    that refers to it meet in one aggregate, which counts values that occur
    twice (``unique``) and rows whose value the parent lacks (``foreign_key``).
    Null keys and references are in neither.  References to tables that are not
    given, and specs without a table, are left out."""
    given = {n: specs[n] for n in tables}
    conformed = {n: conform_to_schema(tables[n], spec.struct) for n, spec in given.items()}
    out = []
    for name, spec in given.items():
        out.append(_table_checks(name, tables[name], spec))
        for key in spec.keys:
            links = [(child, c) for child, s in given.items() for c, parent, pc in s.foreign if parent == name and [pc] == key]
            out.append(_key_checks(name, key, conformed[name], [(child, c, conformed[child]) for child, c in links]))
    return _union(out)


def _findings(row: DataFrame, checks: Sequence[tuple[str, str, str, Column]]) -> DataFrame:
    """One row of counts as a row per (table, check, subject, count)."""
    return row.select(F.inline(F.array(*[F.struct(F.lit(t).alias("table_name"), F.lit(check).alias("check_name"), F.lit(what).alias("subject"),
                                                  F.coalesce(n, F.lit(0)).cast("long").alias("failures")) for t, check, what, n in checks])))


def _table_checks(name: str, df: DataFrame, spec: TableSpec) -> DataFrame:
    have = set(df.columns)
    aggs, checks = [F.count(F.lit(1)).alias("n")], [(name, "non_empty", "", (F.col("n") == 0).cast("long"))]
    for f in spec.struct.fields:
        cast = F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None)
        if not f.nullable:
            aggs.append(F.count_if(cast.isNull()).alias(f"nn_{f.name}"))
            checks.append((name, "not_null", f.name, F.col(f"nn_{f.name}")))
        if f.name in have:
            aggs.append(F.count_if(F.col(f.name).isNotNull() & cast.isNull()).alias(f"lost_{f.name}"))
            checks.append((name, "lost_in_cast", f.name, F.col(f"lost_{f.name}")))
    return _findings(df.agg(*aggs), checks)


def _key_checks(name: str, key: Sequence[str], parent: DataFrame, links: Sequence[tuple[str, str, DataFrame]]) -> DataFrame:
    sides = [parent.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(key)], F.lit(0).alias("side"))]
    sides += [child.select(F.col(c).cast(parent.schema[key[0]].dataType).alias("k0"), F.lit(i).alias("side")) for i, (_, c, child) in enumerate(links, 1)]
    ks = [f"k{i}" for i in range(len(key))]
    rows = _union(sides).filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in ks]))
    per_value = rows.groupBy(*ks).agg(*[F.count_if(F.col("side") == i).alias(f"n{i}") for i in range(len(sides))])
    total = per_value.agg(F.count_if(F.col("n0") > 1).alias("twice"), *[F.sum(F.when(F.col("n0") == 0, F.col(f"n{i}"))).alias(f"lone{i}") for i in range(1, len(sides))])
    return _findings(total, [(name, "unique", ",".join(key), F.col("twice")),
                             *[(child, "foreign_key", c, F.col(f"lone{i}")) for i, (child, c, _) in enumerate(links, 1)]])


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def check_unique(tables: Mapping[str, tuple[DataFrame, Sequence[Sequence[str]]]]) -> DataFrame:
    """Key values that occur more than once (K1): (table, key, value, n)."""
    out = []
    for name, (df, keys) in tables.items():
        for key in keys:
            g = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
            out.append(g.select(F.lit(name).alias("table_name"), F.lit(",".join(key)).alias("key_columns"),
                                F.concat_ws("|", *[F.col(k).cast("string") for k in key]).alias("key_value"),
                                "n"))
    return _union(out)


def check_foreign_keys(links: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Orphan count per foreign key (K2, C14): (fk, orphans).  Null child
    keys are not orphans (SQL semantics, quirk Q12)."""
    out = []
    for fk, child, ccol, parent, pcol in links:
        kids = child.select(F.col(ccol).alias("_k")).filter(F.col("_k").isNotNull())
        orphans = kids.join(parent.select(F.col(pcol).alias("_k")), "_k", "left_anti")
        out.append(orphans.agg(F.count(F.lit(1)).alias("orphans")).select(F.lit(fk).alias("foreign_key"), "orphans"))
    return _union(out)


def check_not_null(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Null count per NOT NULL column (K3), one aggregate per table."""
    out = []
    for name, (df, cols) in tables.items():
        agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        stacked = agg.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                          F.col(c).cast("long").alias("null_count"))
                                                 for c in cols])).alias("s"))
        out.append(stacked.select(F.lit(name).alias("table_name"), "s.column_name", "s.null_count"))
    return _union(out)


def check_non_empty(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """One row per table: is it missing or empty (K4)?  ``limit(1)`` stops
    each scan at the first row."""
    spark = next(df for df in tables.values() if df is not None).sparkSession
    out = []
    for name, df in tables.items():
        if df is None:
            out.append(spark.range(1).select(F.lit(name).alias("table_name"), F.lit(True).alias("failed"),
                                             F.lit("missing").alias("reason")))
            continue
        n = df.limit(1).agg(F.count(F.lit(1)).alias("_n"))
        out.append(n.select(F.lit(name).alias("table_name"), (F.col("_n") == 0).alias("failed"),
                            F.when(F.col("_n") == 0, F.lit("empty")).otherwise(F.lit("ok")).alias("reason")))
    return _union(out)


def check_sequential_ids(tables: Mapping[str, tuple[DataFrame, str]], start: int = 1) -> DataFrame:
    """Ids unique and exactly start..start+N-1 (K5): one aggregate each.

    Whole numbers are counted in blocks of 64, a bit for each id: what is shuffled
    is a row per block and task, far less than a row per id where a task
    meets neighbouring ids, and a row per id at most."""
    out = []
    for name, (df, col) in tables.items():
        if isinstance(df.schema[col].dataType, T.IntegralType):
            x = F.col(col).cast("long")
            blocks = df.groupBy(F.shiftright(x, 6).alias("block")).agg(
                F.count(F.lit(1)).alias("n"), F.min(x).alias("low"), F.max(x).alias("high"),
                F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63)).cast("int"))).alias("seen"))
            a = blocks.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                           F.coalesce(F.sum(F.bit_count("seen").cast("long")), F.lit(0)).alias("n_distinct"),
                           F.min("low").alias("min_id"), F.max("high").alias("max_id"))
        else:
            a = df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(col).alias("n_distinct"),
                       F.min(col).cast("long").alias("min_id"), F.max(col).cast("long").alias("max_id"))
        ok = ((F.col("n") == F.col("n_distinct")) & (F.col("min_id") == start)
              & (F.col("max_id") == F.col("n") + start - 1)) | (F.col("n") == 0)
        out.append(a.select(F.lit(name).alias("table_name"), "n", "n_distinct", "min_id", "max_id", ok.alias("ok")))
    return _union(out)
