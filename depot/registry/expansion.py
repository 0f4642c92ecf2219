"""Set operations and row expansion (2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from depot import config as C
from depot.functions.draws import keyed_uniform, keyed_uniform_sql
from depot.operators import expand as X
from depot.operators.sets import concat_chunks
from depot.plans import costs as CO
from depot.plans import fulfillment as FUL
from depot.registry import register
from depot.sources.adapter_sql import define_view

AS_OF = C.AS_OF.isoformat()
SEED = C.SEED


# ---- G2
@register("concat_chunks", """
SELECT shipment_id, CASE WHEN coalesce(year(ship_date), 0) < 1997 THEN 1 WHEN year(ship_date) < 2000 THEN 2 ELSE 3 END AS chunk
FROM v_shipments""")
def q_concat_chunks(t):
    # the first chunk also takes the rows without a date
    s = t.v_shipments.select("shipment_id", F.coalesce(F.year("ship_date"), F.lit(0)).alias("y"))
    chunks = [s.filter(F.col("y") < 1997).select("shipment_id", F.lit(1).alias("chunk")),
              s.filter((F.col("y") >= 1997) & (F.col("y") < 2000)).select("shipment_id", F.lit(2).alias("chunk")),
              s.filter(F.col("y") >= 2000).select("shipment_id", F.lit(3).alias("chunk"))]
    return concat_chunks(chunks)


# ---- H1
define_view("x_milestones", """
SELECT s.shipment_id, m.k AS milestone_seq, CAST(s.ship_date AS TIMESTAMP) + to_hours(m.h) AS event_timestamp, m.event_type,
       d.city AS location_city, d.state AS location_state, d.zip AS location_zip, m.location_type
FROM v_shipments s LEFT JOIN v_dcs d ON s.dc_id = d.dc_id
CROSS JOIN (VALUES (0, 0, 'departed_dc', 'DC'), (1, 6, 'arrived_hub', 'carrier_facility'),
                   (2, 12, 'out_for_delivery', 'carrier_facility'), (3, 18, 'delivered', 'carrier_facility'))
           AS m(k, h, event_type, location_type)""")


@register("tracking_milestones", "SELECT * FROM x_milestones")
def q_tracking_milestones(t):
    return FUL.tracking_milestones(t.v_shipments, t.v_dcs)


# ---- H2
@register("repeat_by_count", """
SELECT order_line_id, CAST(unnest(range(1, quantity_ordered % 5 + 2)) AS INTEGER) AS unit_no FROM v_lines""")
def q_repeat_by_count(t):
    return X.repeat_by_count(t.v_lines.select("order_line_id", "quantity_ordered"),
                             F.col("quantity_ordered") % 5 + 1, "unit_no").select("order_line_id", "unit_no")


# ---- H3
@register("month_series", f"""
SELECT item_id, CAST(unnest(generate_series(DATE '{AS_OF}' - INTERVAL (day(DATE '{AS_OF}') - 1) DAY,
                                            DATE '{AS_OF}' - INTERVAL (day(DATE '{AS_OF}') - 1) DAY + INTERVAL 11 MONTH,
                                            INTERVAL 1 MONTH)) AS DATE) AS forecast_month
FROM v_items""")
def q_month_series(t):
    return t.v_items.select("item_id", F.explode(X.month_series(C.AS_OF, 12)).alias("forecast_month"))


# ---- H4
@register("week_series", """
SELECT CAST(unnest(generate_series(date_trunc('week', min(order_date)), max(order_date), INTERVAL 7 DAY)) AS DATE)
       AS week_start_date FROM v_orders""")
def q_week_series(t):
    span = t.v_orders.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    return span.select(F.explode(X.week_series(F.col("lo"), F.col("hi"))).alias("week_start_date"))


# ---- H5
@register("cost_unpivot", """
SELECT carrier_id, cost_type, rate_amount
FROM (UNPIVOT v_rates ON hourly, per_mile, per_stop INTO NAME cost_type VALUE rate_amount) u""")
def q_cost_unpivot(t):
    return CO.cost_unpivot(t.v_rates).select("carrier_id", "cost_type", "rate_amount")


# ---- H6
@register("spread_dates", f"""
SELECT item_id, lo + CAST(CASE WHEN i = 0 THEN 0 WHEN i = n - 1 THEN total
                               ELSE least(greatest(CAST(trunc(i * total / (n - 1)) AS INT) + jitter, 0), total) END AS INT) AS count_date
FROM (SELECT *, CAST(floor({keyed_uniform_sql(SEED, 'spread', 'item_id', 'i')} * 21) AS INT) - 10 AS jitter
      FROM (SELECT *, unnest(range(n)) AS i
            FROM (SELECT item_id, count(*) AS n, min(lo) AS lo, date_diff('day', min(lo), max(hi)) AS total
                  FROM (SELECT l.item_id, date_trunc('month', o.order_date) AS month, min(o.order_date) AS lo, max(o.order_date) AS hi
                        FROM v_lines l JOIN v_orders o ON l.order_id = o.order_id
                        WHERE o.order_date IS NOT NULL GROUP BY ALL) m GROUP BY item_id) s) k) d""")
def q_spread_dates(t):
    """Cycle counts: each item is counted as often as there are months in which it
    was ordered, spread over its own selling period (at most a date per month of it)."""
    sold = t.v_lines_noid.select("order_id", "item_id").join(
        t.v_orders.where(F.col("order_date").isNotNull()).select("order_id", "order_date"), "order_id")
    months = sold.groupBy("item_id", F.trunc("order_date", "month").alias("month")).agg(
        F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    items = months.groupBy("item_id").agg(F.count(F.lit(1)).cast("int").alias("n"), F.min("lo").alias("lo"),
                                          F.datediff(F.max("hi"), F.min("lo")).alias("total"))

    def jitter(k):
        return F.floor(keyed_uniform(SEED, "spread", "item_id", k) * 21).cast("int") - 10
    offs = X.spread_offsets(F.col("n"), F.col("total"), jitter)
    return items.select("item_id", "lo", F.explode(offs).alias("off")).select(
        "item_id", F.date_add("lo", F.col("off").cast("int")).alias("count_date"))
