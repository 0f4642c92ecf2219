"""Streaming operators and the reload of streamed output.

Each query runs the stream to completion (``availableNow``) and returns
the sink read back as a batch DataFrame."""

from __future__ import annotations

from pyspark.sql import functions as F

from depot.operators.quality import check_sequential_ids
from depot.plans.fulfillment import shipment_totals
from depot.registry import register
from depot.streaming import pipeline as P

@register("stream_order_pipeline", "SELECT * FROM x_built_shipments")
def q_stream_order_pipeline(t):
    sink = P.stream_order_pipeline(t)
    cols = ["shipment_id", "order_id", "dc_id", "carrier_id", "ship_date", "promised_date", "delivery_date",
            "shipment_type", "total_weight_lb", "total_cube_ft", "estimated_cost", "actual_cost"]
    return P.read_sink(t.spark, sink, "shipments").select(*cols)


@register("stream_dense_ids", """
SELECT 'shipment_lines' AS table_name, count(*) AS n, count(*) AS n_distinct, CAST(1 AS BIGINT) AS min_id,
       CAST(count(*) AS BIGINT) AS max_id, true AS ok FROM x_sl_base
UNION ALL
SELECT 'tracking_events', count(*), count(*), CAST(1 AS BIGINT), CAST(count(*) AS BIGINT), true FROM x_tracking""")
def q_stream_dense_ids(t):
    sink = P.stream_order_pipeline(t, names=["shipment_lines", "tracking_events"])
    return check_sequential_ids({
        "shipment_lines": (P.read_sink(t.spark, sink, "shipment_lines"), "shipment_line_id"),
        "tracking_events": (P.read_sink(t.spark, sink, "tracking_events"), "tracking_event_id")})


@register("reload_streamed", """
SELECT s.shipment_id, CAST(round(coalesce(w, 0), 3) AS DECIMAL(18,3)) AS total_weight_lb,
       CAST(round(coalesce(c, 0), 4) AS DECIMAL(18,4)) AS total_cube_ft
FROM v_shipments s LEFT JOIN (SELECT shipment_id, sum(line_weight_lb) AS w, sum(line_cube_ft) AS c
                              FROM x_shipment_lines GROUP BY shipment_id) t ON s.shipment_id = t.shipment_id""")
def q_reload_streamed(t):
    sink = P.stream_order_pipeline(t, names=["shipments"])
    return shipment_totals(P.read_sink(t.spark, sink, "shipments").select("shipment_id"),
                           P.read_sink(t.spark, sink, "shipment_lines"))


@register("stream_milestones", "SELECT * FROM x_milestones")
def q_stream_milestones(t):
    return P.stream_milestones(t)


@register("stream_progress_counts", """
SELECT 'orders' AS table_name, count(*) AS row_count FROM v_orders
UNION ALL SELECT 'order_lines', count(*) FROM v_lines l SEMI JOIN v_orders o ON l.order_id = o.order_id
UNION ALL SELECT 'shipments', count(*) FROM v_shipments
UNION ALL SELECT 'shipment_lines', count(*) FROM x_sl_base
UNION ALL SELECT 'tracking_events', 4 * count(*) FROM v_shipments
UNION ALL SELECT 'shipment_costs', count(*) FROM v_shipments""")
def q_stream_progress_counts(t):
    return P.running_counts(t.spark, P.stream_order_pipeline(t)).select("table_name", F.col("row_count").cast("long").alias("row_count"))
