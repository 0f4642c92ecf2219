"""Vendor scorecard and vendor-item terms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depot.functions import rules as R
from depot.operators.keys import dense_keys


def vendor_scorecard(vendors: DataFrame, purchase_orders: DataFrame, returns: DataFrame,
                     lines: DataFrame) -> DataFrame:
    """Measured vendor performance (I22): on-time rate and mean days late
    over received POs, fill rate = received / ordered over non-cancelled
    POs, defect rate = damaged or defective returns per line sold.  Returns that
    carry their line's ``vendor_id`` are not joined with the lines again."""
    po = purchase_orders.filter(F.col("po_status") != "Cancelled")
    recv = F.col("actual_receipt_date").isNotNull()
    pm = po.groupBy("vendor_id").agg(
        F.avg(F.when(recv, F.when(F.col("actual_receipt_date") <= F.col("expected_receipt_date"), 1.0)
                     .otherwise(0.0))).alias("_ot"),
        F.avg(F.when(recv, F.greatest(F.lit(0), F.datediff("actual_receipt_date", "expected_receipt_date"))))
        .alias("_late"),
        (F.sum("qty_received") / F.sum("qty_ordered")).alias("_fill"))
    lv = lines.select("order_line_id", "vendor_id")
    bad = returns.filter(F.col("condition_code").isin("Damaged", "Defective"))
    if "vendor_id" not in returns.columns:
        bad = bad.select("order_line_id").join(lv, "order_line_id")
    rm = bad.groupBy("vendor_id").agg(F.count(F.lit(1)).alias("_bad"))
    lm = lv.groupBy("vendor_id").agg(F.count(F.lit(1)).alias("_lines"))
    j = (vendors.select("vendor_id").join(pm, "vendor_id", "left").join(rm, "vendor_id", "left")
         .join(lm, "vendor_id", "left"))
    return j.select("vendor_id",
                    F.round("_ot", 4).cast("decimal(6,4)").alias("on_time_delivery_rate"),
                    F.round("_late", 2).cast("decimal(8,2)").alias("avg_days_late"),
                    F.round(F.coalesce("_bad", F.lit(0)) / F.col("_lines"), 4).cast("decimal(6,4)").alias("defect_rate"),
                    F.round("_fill", 4).cast("decimal(6,4)").alias("fill_rate"))


def build_vendor_items(lines: DataFrame, vendors: DataFrame, items: DataFrame, scorecard: DataFrame,
                       base_moq: int = 24, default_rate: float = 0.9) -> DataFrame:
    """Vendor-item pairs observed in the lines (D9) with vendor rank (B25),
    minimum order quantity and order multiple scaled by rank/3, and the
    vendor item number (B17)."""
    pairs = lines.select("vendor_id", "item_id").dropDuplicates()
    sc = scorecard.select("vendor_id", F.coalesce(F.col("fill_rate").cast("double"), F.lit(default_rate)).alias("_fr"),
                          F.coalesce(F.col("on_time_delivery_rate").cast("double"), F.lit(default_rate)).alias("_ot"))
    j = (pairs.join(sc, "vendor_id", "left").join(vendors.select("vendor_id", "vendor_name"), "vendor_id", "left")
         .join(items.select("item_id", "cube_ft"), "item_id", "left"))
    rank = R.vendor_rank(F.coalesce("_fr", F.lit(default_rate)), F.coalesce("_ot", F.lit(default_rate)))
    j = j.withColumn("vendor_rank", rank)
    out = j.select("vendor_id", "item_id", R.vendor_item_number("vendor_name", "item_id").alias("vendor_item_number"),
                   "vendor_rank", R.scaled_qty(F.lit(base_moq), "vendor_rank").alias("min_order_qty"),
                   R.scaled_qty(R.order_multiple_base("cube_ft"), "vendor_rank").alias("order_multiple"))
    return dense_keys(out, ["vendor_id", "item_id"], "vendor_item_id")
