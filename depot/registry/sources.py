"""Sources and sinks: each writes a derived table with the
sink under test into the shared scratch folder and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from depot import config as C
from depot.functions.draws import keyed_uniform_sql
from depot.registry import register
from depot.session import scratch_path
from depot.sources import files as FI
from depot.sources.tables import STATE_CODES, STATE_SQL
from depot.plans.fulfillment import tracking_milestones


# ---- A1
@register("scan_catalog_csv", """
SELECT item_sku, item_description, category, subcategory, CAST(unit_cost AS DECIMAL(12,2)) AS unit_cost,
       CAST(unit_price AS DECIMAL(12,2)) AS unit_price, CAST(shipping_cost_per_unit AS DECIMAL(12,2)) AS shipping_cost_per_unit,
       length_in, width_in, height_in, CAST(weight_lb AS DECIMAL(12,4)) AS weight_lb, cube_ft
FROM v_items""")
def q_scan_catalog_csv(t):
    path = scratch_path(t.spark, "catalog-csv")
    FI.write_catalog(t.v_items, path)
    return FI.read_catalog(t.spark, path)


# ---- A2
def _postal_lines(t):
    """A postal file in the 12-field layout, built from the customer table:
    every 23rd row is short (4 fields), every 17th has a blank zip, and the
    place names carry padding to be trimmed."""
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    zip_ = F.when(F.col("c_custkey") % 17 == 0, F.lit("")).otherwise(
        F.lpad((F.col("c_custkey") % 100000).cast("string"), 5, "0"))
    state = F.get(F.array(*[F.lit(x) for x in STATE_CODES]), F.col("n_nationkey"))
    full = F.concat_ws("\t", F.lit("US"), zip_, F.concat(F.lit("  "), F.col("n_name"), F.lit(" ")), F.col("n_name"),
                       state, F.lit("County"), F.lit(""), F.lit(""), F.lit(""), F.lit("0.0"), F.lit("0.0"), F.lit("4"))
    short = F.concat_ws("\t", F.lit("US"), zip_, F.col("n_name"), F.col("n_name"))
    return c.select(F.when(F.col("c_custkey") % 23 == 0, short).otherwise(full).alias("value"))


@register("scan_postal_tsv", f"""
SELECT trim('  ' || n_name || ' ') AS city, {STATE_SQL} AS state,
       lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS zip
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_custkey % 23 <> 0 AND c_custkey % 17 <> 0""")
def q_scan_postal_tsv(t):
    path = scratch_path(t.spark, "postal-tsv")
    _postal_lines(t).write.mode("overwrite").text(path)
    return FI.read_postal(t.spark, path)


# ---- A3
@register("sink_csv", """
SELECT shipment_id, milestone_seq, strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS event_timestamp, event_type
FROM x_milestones""")
def q_sink_csv(t):
    path = scratch_path(t.spark, "csv-sink")
    ev = tracking_milestones(t.v_shipments, t.v_dcs).select("shipment_id", "milestone_seq", "event_timestamp",
                                                             "event_type")
    FI.write_csv(ev, path, ["event_timestamp"])
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ev.columns])
    back = t.spark.read.schema(schema).option("header", True).csv(path)
    return back.select(F.col("shipment_id").cast("long").alias("shipment_id"),
                       F.col("milestone_seq").cast("int").alias("milestone_seq"), "event_timestamp", "event_type")


# ---- A4
@register("sink_parquet", "SELECT * FROM v_shipments")
def q_sink_parquet(t):
    path = scratch_path(t.spark, "parquet-sink")
    FI.write_parquet(t.v_shipments, path)
    return FI.read_parquet(t.spark, path, t.v_shipments.schema)


# ---- A5, A6
def _appended(t):
    path = scratch_path(t.spark, "appended")
    o = t.v_orders.withColumn("order_year", F.year("order_date"))
    # the first chunk also takes the rows without a date
    year = F.coalesce("order_year", F.lit(0))
    chunks = [o.filter(year < 1997), o.filter(year.between(1997, 1999)), o.filter(year >= 2000)]
    FI.append_parts(chunks, path, ["order_year"])
    return path, o.schema


@register("append_parts", "SELECT *, CAST(year(order_date) AS INT) AS order_year FROM v_orders")
def q_append_parts(t):
    path, schema = _appended(t)
    return FI.read_parquet(t.spark, path, schema)


@register("compact_parts", "SELECT *, CAST(year(order_date) AS INT) AS order_year FROM v_orders")
def q_compact_parts(t):
    path, schema = _appended(t)
    return FI.compact_parts(t.spark, path, ["order_year"], schema=schema)


# ---- A8
@register("bulk_load_tables", """
SELECT 'orders' AS table_name, count(*) AS row_count FROM v_orders
UNION ALL SELECT 'customers', count(*) FROM v_customers
UNION ALL SELECT 'items', count(*) FROM v_items""")
def q_bulk_load_tables(t):
    base = scratch_path(t.spark, "bulk")
    specs = {}
    for name, df in [("orders", t.v_orders), ("customers", t.v_customers), ("items", t.v_items)]:
        FI.write_parquet(df, f"{base}/{name}")
        specs[name] = (f"{base}/{name}", df.schema)
    return FI.bulk_load(t.spark, specs, prefix="depot_")


# ---- A10
_ITEM_COLS = ["item_id", "item_sku", "item_description", "category", "subcategory", "lead_time_days", "length_in",
              "width_in", "height_in", "weight_lb", "cube_ft", "unit_price", "unit_cost", "shipping_cost_per_unit"]
_ORDER_COLS = ["order_id", "customer_id", "order_date", "dc_id", "ship_via", "order_status"]


def _preview_sql(name, view, key, cols, n=50):
    u = keyed_uniform_sql(C.SEED, "sample", key)
    nulls = " + ".join(f"count_if({c} IS NULL)" for c in cols)
    return (f"SELECT '{name}' AS table_name, count(*) AS row_count, {len(cols)} AS column_count, "
            f"CAST({nulls} AS BIGINT) AS null_cells FROM (SELECT * FROM {view} ORDER BY {u}, {key} LIMIT {n}) s")


@register("preview_tables", _preview_sql("orders", "v_orders", "order_id", _ORDER_COLS) + " UNION ALL "
          + _preview_sql("items", "v_items", "item_id", _ITEM_COLS))
def q_preview_tables(t):
    tables = {"customers": (t.v_customers, ["customer_id"]), "orders": (t.v_orders, ["order_id"]),
              "items": (t.v_items, ["item_id"])}
    return FI.preview_tables(tables, ["items", "orders"], 50, scratch_path(t.spark, "preview"), C.SEED)
