"""File sources and sinks (A ops): catalog CSV, postal TSV, CSV/Parquet
sinks, appended parts, compaction, bulk load and table previews.

All paths are caller-given; scratch output goes under the cluster-shared
folder (``spark.checkpoint.dir``), never a machine-local temp folder.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depot.config import CATALOG_COLUMNS, POSTAL_FIELDS, TIMESTAMP_FORMAT
from depot.functions.rules import normalize_timestamp
from depot.session import scratch_path
from depot.sources import versions

# the item fields the catalog columns map to, and their types
CATALOG_RENAMES = {"product_code": "item_sku", "description": "item_description", "product_category": "category",
                   "produc_subcategory": "subcategory", "weight_lbs": "weight_lb", "cubic_ft": "cube_ft"}
CATALOG_TYPES = {"unit_cost": "decimal(12,2)", "unit_price": "decimal(12,2)",
                 "shipping_cost_per_unit": "decimal(12,2)", "length_in": "int", "width_in": "int",
                 "height_in": "int", "weight_lbs": "decimal(12,4)", "cubic_ft": "double"}


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV scan with a fixed string schema (no inference), renames,
    trims and casts (A1).  Dirty numbers become nulls (``try_cast``)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in CATALOG_COLUMNS])
    raw = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    cols = []
    for c in CATALOG_COLUMNS:
        v = F.trim(F.col(c))
        v = v.try_cast(CATALOG_TYPES[c]) if c in CATALOG_TYPES else v
        cols.append(v.alias(CATALOG_RENAMES.get(c, c)))
    return raw.select(*cols)


def write_catalog(items: DataFrame, path: str) -> None:
    """Write an item table in the catalog file layout (header CSV)."""
    items.select(*[F.col(CATALOG_RENAMES.get(c, c)).cast("string").alias(c) for c in CATALOG_COLUMNS]) \
        .write.mode("overwrite").option("header", True).csv(path)


def read_postal(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated, headerless postal scan (A2): rows with fewer than five
    fields or a blank zip, city or state are dropped; values trimmed;
    projected to (city, state, zip)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in POSTAL_FIELDS])
    raw = spark.read.schema(schema).option("sep", "\t").option("header", False).csv(path)
    out = raw.filter(F.col("admin_code1").isNotNull()).select(
        F.trim("place_name").alias("city"), F.trim("admin_code1").alias("state"), F.trim("postal_code").alias("zip"))
    return out.filter((F.coalesce(F.col("zip"), F.lit("")) != "") & (F.coalesce(F.col("city"), F.lit("")) != "")
                      & (F.coalesce(F.col("state"), F.lit("")) != ""))


def write_csv(df: DataFrame, path: str, timestamp_cols: Sequence[str] = (), mode: str = "overwrite") -> None:
    """CSV sink with header; timestamps normalised and written as
    ``yyyy-MM-dd HH:mm:ss`` text (A3, B18)."""
    out = df
    for c in timestamp_cols:
        out = out.withColumn(c, normalize_timestamp(F.col(c), TIMESTAMP_FORMAT))
    out.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Parquet sink (A4).  ``overwrite`` replaces the table whole: the new
    version is staged beside the old one, which stays readable until the new one
    stands and for good if the write fails; ``append`` adds to the current
    version.  Read it with ``read_parquet``."""
    if mode == "overwrite":
        versions.replace(df, path, partition_by)
    elif mode == "append":
        versions.append(df, path, partition_by)
    else:
        raise ValueError(f"mode {mode!r} is neither overwrite nor append")


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The current version of a table that ``write_parquet`` wrote."""
    return versions.read(spark, path, schema)


def append_parts(chunks: Sequence[DataFrame], path: str, partition_by: Sequence[str] = (), fmt: str = "parquet",
                 timestamp_cols: Sequence[str] = ()) -> None:
    """Append each chunk to one table (A5), as Parquet or as CSV with a header."""
    for ch in chunks:
        if fmt == "csv":
            write_csv(ch, path, timestamp_cols, mode="append")
        else:
            write_parquet(ch, path, partition_by, mode="append")


def compact_parts(spark: SparkSession, path: str, partition_by: Sequence[str] = (), target_bytes: int = versions.TARGET_BYTES,
                  schema: T.StructType | None = None, sort_cols: Sequence[str] = ()) -> DataFrame:
    """Rewrite many small part files as files of about ``target_bytes``, in
    place (A6), and return the compacted table.  The bytes of the listing decide
    how many files there are; the old version stays until the new one stands."""
    return versions.compact(spark, path, partition_by, target_bytes, sort_cols, schema)


def bulk_load(spark: SparkSession, tables: Mapping[str, tuple[str, T.StructType | None]],
              prefix: str = "") -> DataFrame:
    """Load tables of the Parquet sink as named temp views (A8) and return (table,
    rows).  Load order does not matter in Spark; foreign keys are checked separately (K2)."""
    counts = []
    for name, (path, schema) in tables.items():
        read_parquet(spark, path, schema).createOrReplaceTempView(prefix + name)
        counts.append(spark.table(prefix + name).agg(F.count(F.lit(1)).alias("row_count"))
                      .select(F.lit(name).alias("table_name"), "row_count"))
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def load_bucketed(spark: SparkSession, tables: Mapping[str, tuple[DataFrame, str]], buckets: int) -> dict[str, DataFrame]:
    """Load tables laid out for joins (A8): each (table, key) is stored bucketed
    and sorted by its key, one file a bucket, as a table of its own under the
    shared scratch folder.  Tables with equal buckets join on that key, and
    aggregate by it, without a shuffle.  Choose ``buckets`` so that a bucket of
    the largest table fits a task, and as a multiple of the cores."""
    out = {}
    for name, (df, key) in tables.items():
        path = scratch_path(spark, f"bucketed-{name}")
        table = path.rsplit("/", 1)[-1].replace("-", "_")
        (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
         .option("path", path).format("parquet").saveAsTable(table))
        out[name] = spark.table(table)
    return out


def preview_tables(tables: Mapping[str, tuple[DataFrame, Sequence[str]]], names: Sequence[str], n: int,
                   out_dir: str | None = None, seed: int = 42, fmt: str = "parquet") -> DataFrame:
    """Preview (A10): the selected tables in canonical order, each capped at
    ``n`` rows by a seeded sample (F2), optionally written (Parquet or CSV), and
    profiled (D14).  Tables not selected are never computed."""
    from depot.operators.aggregates import table_profile
    from depot.operators.sampling import sample_rows
    chosen = [nm for nm in tables if nm in set(names)]
    samples = {}
    for nm in chosen:
        df, keys = tables[nm]
        s = sample_rows(df, n, keys, seed)
        path = f"{out_dir.rstrip('/')}/{nm}" if out_dir else None
        if path and fmt == "csv":
            write_csv(s, path, [f.name for f in s.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))])
            s = df.sparkSession.read.schema(", ".join(f"`{c}` string" for c in s.columns)).option("header", True).csv(path)
        elif path:
            write_parquet(s, path)
            s = read_parquet(df.sparkSession, path)
        samples[nm] = s
    return table_profile(samples)
