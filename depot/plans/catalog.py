"""Item master, DC dimension and item forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depot.functions import rules as R
from depot.operators.expand import month_series
from depot.operators.keys import dense_keys


def build_items(items: DataFrame) -> DataFrame:
    """Item master enrichment (I27): cube filled from dimensions (B4),
    density and dimensional weight (B5), freight class (B6)."""
    cube = R.fill_cube("cube_ft", "length_in", "width_in", "height_in")
    i = items.withColumn("cube_ft", F.round(cube, 4).cast("decimal(12,4)"))
    return i.select("item_id", "item_sku", "item_description", "category", "subcategory", "lead_time_days",
                    "length_in", "width_in", "height_in", F.col("weight_lb").cast("decimal(12,4)").alias("weight_lb"),
                    "cube_ft",
                    F.round(R.density("weight_lb", "cube_ft"), 4).cast("decimal(18,4)").alias("density_lb_per_cuft"),
                    F.round(R.dim_weight("length_in", "width_in", "height_in"), 4).cast("decimal(18,4)")
                    .alias("dim_weight_lb"),
                    R.freight_class("subcategory", "category", R.density("weight_lb", "cube_ft")).alias("nmfc_class"),
                    F.col("unit_price").cast("decimal(12,2)").alias("unit_price"),
                    F.col("unit_cost").cast("decimal(12,2)").alias("unit_cost"))


def build_dcs(dcs: DataFrame) -> DataFrame:
    """DC dimension with its time zone."""
    return dcs.select("dc_id", "dc_name", "city", "state", "zip", "region", "capacity_units",
                      R.time_zone("state").alias("time_zone"))


def build_item_forecast(lines: DataFrame, orders: DataFrame, items: DataFrame, as_of, months_forward: int = 12,
                        abc: dict | None = None, xyz: dict | None = None) -> DataFrame:
    """Monthly forecast per item for ``months_forward`` months from ``as_of``
    (I17).  Velocity = measured units per month over the 12 months before
    ``as_of`` (at least 1); ABC by that revenue and XYZ by velocity (B9,
    thresholds are parameters), lifecycle (B10), seasonality (B14), error
    (B15); quantity = max(1, int(velocity x seasonality))."""
    abc = abc or {}
    xyz = xyz or {}
    start = F.add_months(F.trunc(F.lit(as_of), "month"), -12)
    recent = (lines.select("order_id", "item_id", "quantity_ordered", "extended_price")
              .join(orders.select("order_id", "order_date")
                    .filter((F.col("order_date") >= start) & (F.col("order_date") < F.trunc(F.lit(as_of), "month"))),
                    "order_id")
              .groupBy("item_id").agg(F.sum("quantity_ordered").alias("_u"), F.sum("extended_price").alias("_rev")))
    it = items.select("item_id", "category").join(recent, "item_id", "left")
    it = it.select("item_id", "category",
                   F.greatest(F.lit(1), (F.coalesce("_u", F.lit(0)) / 12).cast("int")).alias("velocity"),
                   F.coalesce("_rev", F.lit(0)).alias("_rev"))
    it = it.select("*", R.abc_class("_rev", **abc).alias("abc_class"), R.xyz_class("velocity", **xyz).alias("xyz_class"),
                   R.lifecycle_stage("item_id").alias("lifecycle_stage"))
    m = it.select("*", F.explode(month_series(as_of, months_forward)).alias("forecast_month"))
    season = R.seasonality_index("category", F.month("forecast_month"))
    mape, mad = R.forecast_error("abc_class", "xyz_class")
    out = m.select("item_id", "forecast_month",
                   F.greatest(F.lit(1), (F.col("velocity") * season).cast("int")).alias("forecast_quantity"),
                   "abc_class", "xyz_class", season.cast("decimal(8,4)").alias("seasonality_index"),
                   "lifecycle_stage", mape.cast("decimal(10,4)").alias("forecast_error_mape"),
                   mad.cast("decimal(10,4)").alias("forecast_error_mad"))
    return dense_keys(out, ["item_id", "forecast_month"], "forecast_id")
