"""Joins over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from depot import config as C
from depot.functions.draws import keyed_uniform_sql
from depot.functions import rules as R
from depot.operators import joins as J
from depot.operators.windows import first_per_key
from depot.plans import pricing as PR
from depot.plans import customers as CU
from depot.registry import register
from depot.sources.adapter_sql import define_view


# ---- C1
@register("join_lines_shipments", """
SELECT l.order_line_id, l.order_id, s.shipment_id, l.item_id, l.quantity_ordered, s.ship_date
FROM v_lines l JOIN v_shipments s ON l.order_id = s.order_id""")
def q_join_lines_shipments(t):
    return (t.v_lines.select("order_line_id", "order_id", "item_id", "quantity_ordered")
            .join(t.v_shipments.select("order_id", "shipment_id", "ship_date"), "order_id"))


# ---- C2
@register("lookup_item_carrier", """
SELECT l.order_line_id, CAST(i.weight_lb AS DECIMAL(12,4)) AS weight_lb, CAST(i.cube_ft AS DECIMAL(12,4)) AS cube_ft,
       c.carrier_type
FROM v_lines l JOIN v_shipments s ON l.order_id = s.order_id
LEFT JOIN v_items i ON l.item_id = i.item_id LEFT JOIN v_carriers c ON s.carrier_id = c.carrier_id""")
def q_lookup_item_carrier(t):
    j = (t.v_lines.select("order_line_id", "order_id", "item_id")
         .join(t.v_shipments.select("order_id", "carrier_id"), "order_id"))
    j = J.lookup(j, t.v_items.select("item_id", F.col("weight_lb").cast("decimal(12,4)").alias("weight_lb"),
                                      F.col("cube_ft").cast("decimal(12,4)").alias("cube_ft")), "item_id")
    j = J.lookup(j, t.v_carriers.select("carrier_id", "carrier_type"), "carrier_id")
    return j.select("order_line_id", "weight_lb", "cube_ft", "carrier_type")


# ---- C3 (and D3)
define_view("x_avg_available", """
SELECT item_id, CAST(trunc(avg(greatest(0, qty_on_hand - qty_on_order))) AS BIGINT) AS avg_available
FROM v_stock GROUP BY item_id""")


def avg_available(t):
    """Mean available quantity per item over all DC stock rows (D3)."""
    return t.v_stock.groupBy("item_id").agg(
        F.avg(F.greatest(F.lit(0), F.col("qty_on_hand") - F.col("qty_on_order"))).cast("long").alias("avg_available"))


@register("left_join_default", """
SELECT l.order_line_id, coalesce(a.avg_available, 0) AS avg_available, coalesce(i.lead_time_days, 7) AS lead_time_days
FROM v_lines l LEFT JOIN x_avg_available a ON l.item_id = a.item_id LEFT JOIN v_items i ON l.item_id = i.item_id""")
def q_left_join_default(t):
    j = J.lookup(t.v_lines.select("order_line_id", "item_id"), avg_available(t), "item_id", {"avg_available": 0})
    j = J.lookup(j, t.v_items.select("item_id", "lead_time_days"), "item_id", {"lead_time_days": 7})
    return j.select("order_line_id", "avg_available", "lead_time_days")


# ---- C4
define_view("x_vendor_item_cost", """
SELECT vendor_id, item_id, CAST(round(min(CAST(unit_price AS DECIMAL(12,2))) * CAST(0.7 AS DECIMAL(3,2)), 2) AS DECIMAL(12,2)) AS vi_cost
FROM v_lines WHERE return_flag = 'N' GROUP BY vendor_id, item_id""")


def vendor_item_cost(t):
    return (t.v_lines_noid.filter(F.col("return_flag") == "N")
            .groupBy("vendor_id", "item_id")
            .agg(F.round(F.min(F.col("unit_price").cast("decimal(12,2)")) * F.lit(0.7).cast("decimal(3,2)"), 2)
                 .cast("decimal(12,2)").alias("vi_cost")))


@register("multi_key_cost_join", """
SELECT s.dc_id, s.item_id, s.vendor_id,
       CAST(coalesce(v.vi_cost, s.last_cost, s.avg_cost, 0) AS DECIMAL(12,2)) AS po_unit_cost
FROM v_stock s LEFT JOIN x_vendor_item_cost v ON s.vendor_id = v.vendor_id AND s.item_id = v.item_id""")
def q_multi_key_cost_join(t):
    j = t.v_stock.join(vendor_item_cost(t), ["vendor_id", "item_id"], "left")
    return j.select("dc_id", "item_id", "vendor_id",
                    J.first_non_null("vi_cost", "last_cost", "avg_cost", default=0).cast("decimal(12,2)")
                    .alias("po_unit_cost"))


# ---- C5
@register("map_lookup_discount", """
SELECT o.order_id, CAST(coalesce(c.discount_percentage, 0) AS DECIMAL(5,2)) AS discount_percentage
FROM v_orders o LEFT JOIN v_customers c ON o.customer_id = c.customer_id""")
def q_map_lookup_discount(t):
    j = J.lookup(t.v_orders.select("order_id", "customer_id"),
                 t.v_customers.select("customer_id", F.col("discount_percentage").cast("decimal(5,2)")),
                 "customer_id", {"discount_percentage": 0})
    return j.select("order_id", F.col("discount_percentage").cast("decimal(5,2)").alias("discount_percentage"))


# ---- C6
@register("range_join_promos", """
SELECT o.order_id, p.promo_id FROM v_orders o JOIN v_promotions p ON o.order_date BETWEEN p.start_date AND p.end_date""")
def q_range_join_promos(t):
    j = J.range_join(t.v_orders.select("order_id", "order_date"), t.v_promotions, "order_date",
                     "start_date", "end_date")
    return j.select("order_id", "promo_id")


# ---- C7
@register("cross_dc_item", "SELECT d.dc_id, i.item_id FROM v_dcs d CROSS JOIN v_items i")
def q_cross_dc_item(t):
    return t.v_items.select("item_id").crossJoin(t.v_dcs.select("dc_id")).select("dc_id", "item_id")


# ---- C8
_DEPTS = list(R.DEPARTMENT_BASE_HOURS)


def week_scaffold(t):
    """Mondays from the week of the first order to the last order date (H4)."""
    span = t.v_orders.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    return span.select(F.explode(F.sequence(F.date_trunc("week", "lo").cast("date"), F.col("hi").cast("date"),
                                            F.expr("INTERVAL 7 DAYS"))).alias("week_start_date"))


@register("cross_dc_dept_week", """
SELECT d.dc_id, dept.department, w.week_start_date
FROM v_dcs d CROSS JOIN (VALUES """ + ", ".join(f"('{x}')" for x in _DEPTS) + """) dept(department)
CROSS JOIN (SELECT CAST(unnest(generate_series(date_trunc('week', min(order_date)), max(order_date), INTERVAL 7 DAY)) AS DATE)
                   AS week_start_date FROM v_orders) w""")
def q_cross_dc_dept_week(t):
    dd = J.cross_literals(t.v_dcs.select("dc_id"), "department", _DEPTS)
    return week_scaffold(t).crossJoin(dd).select("dc_id", "department", "week_start_date")


# ---- C9
@register("cross_state_fuel", """
SELECT DISTINCT d.state, f.fuel_type FROM v_dcs d CROSS JOIN (VALUES ('diesel'), ('gasoline')) f(fuel_type)""")
def q_cross_state_fuel(t):
    from depot.sources.tables import FUEL_TYPES
    return J.cross_literals(t.v_dcs.select("state").distinct(), "fuel_type", FUEL_TYPES)


# ---- C10
@register("secondary_rep", f"""
SELECT customer_id, primary_rep_id, secondary_rep_id FROM x_contact_reps WHERE segment IN ('Corporate', 'Government')""")
def q_secondary_rep(t):
    return CU.contact_reps(t.v_customers, t.v_reps).filter(F.col("segment").isin("Corporate", "Government")) \
        .select("customer_id", "primary_rep_id", "secondary_rep_id")


# ---- C11
@register("account_hierarchy", """
SELECT m.customer_id AS master_id, count(*) AS n_accounts, CAST(sum(a.credit_limit) AS DECIMAL(18,2)) AS total_credit_limit
FROM v_customers a JOIN v_customers m ON a.master_id = m.customer_id AND NOT m.is_sub
GROUP BY m.customer_id""")
def q_account_hierarchy(t):
    return CU.account_hierarchy(t.v_customers)


# ---- C12 (and E5)
define_view("x_eligible_lines", """
SELECT l.order_line_id, l.order_id, l.item_id, l.quantity_ordered, l.unit_price, o.customer_id, s.shipment_id, s.ship_date
FROM v_lines l JOIN v_orders o ON l.order_id = o.order_id AND o.order_status = 'Complete'
JOIN (SELECT order_id, min({'d': ship_date, 's': shipment_id}).s AS shipment_id, min(ship_date) AS ship_date
      FROM v_shipments GROUP BY order_id) s ON l.order_id = s.order_id
WHERE s.ship_date IS NOT NULL""")


def eligible_lines(t, lines=None, carry=()):
    """Lines of complete orders with their first shipment (C12).  ``lines``: of
    these only; ``carry`` names further columns of them to keep."""
    lines = t.v_lines if lines is None else lines
    first = first_per_key(t.v_shipments.select("order_id", "ship_date", "shipment_id"), ["order_id"],
                          ["ship_date", "shipment_id"])
    return (lines.select("order_line_id", "order_id", "item_id", "quantity_ordered", "unit_price", *carry)
            .join(t.v_orders.filter(R.status_is("order_status", "Complete")).select("order_id", "customer_id"),
                  "order_id")
            .join(first, "order_id")
            .filter(F.col("ship_date").isNotNull()))


@register("eligible_lines_chain", """
SELECT order_line_id, order_id, shipment_id, ship_date, customer_id FROM x_eligible_lines""")
def q_eligible_lines_chain(t):
    return eligible_lines(t).select("order_line_id", "order_id", "shipment_id", "ship_date", "customer_id")


# ---- C13
@register("semi_orders_with_lines", """
SELECT order_id, customer_id FROM v_orders o WHERE EXISTS (SELECT 1 FROM v_lines l WHERE l.order_id = o.order_id)""")
def q_semi_orders_with_lines(t):
    return t.v_orders.select("order_id", "customer_id").join(t.v_lines_noid.select("order_id"), "order_id", "left_semi")


# ---- C14
@register("anti_orphans", """
SELECT 'order_without_lines' AS kind, order_id AS key FROM v_orders o
WHERE NOT EXISTS (SELECT 1 FROM v_lines l WHERE l.order_id = o.order_id)
UNION ALL
SELECT 'line_without_order' AS kind, order_id AS key FROM v_lines l
WHERE NOT EXISTS (SELECT 1 FROM v_orders o WHERE l.order_id = o.order_id)""")
def q_anti_orphans(t):
    lines = t.v_lines_noid.select("order_id")
    orders = t.v_orders.select("order_id")
    a = orders.join(lines, "order_id", "left_anti").select(F.lit("order_without_lines").alias("kind"),
                                                           F.col("order_id").alias("key"))
    b = lines.join(orders, "order_id", "left_anti").select(F.lit("line_without_order").alias("kind"),
                                                           F.col("order_id").alias("key"))
    return a.unionByName(b)


# ---- C15
define_view("x_monthly_price", """
SELECT item_id, month, min(p) AS list_price FROM
  (SELECT l.item_id, CAST(date_trunc('month', o.order_date) AS DATE) AS month, CAST(l.unit_price AS DECIMAL(12,2)) AS p
   FROM v_lines l JOIN v_orders o ON l.order_id = o.order_id) x GROUP BY item_id, month""")
define_view("x_price_history", """
SELECT row_number() OVER (ORDER BY item_id, effective_date) AS price_history_id, item_id, CAST(NULL AS BIGINT) AS customer_id,
       effective_date, CAST(lead(effective_date) OVER (PARTITION BY item_id ORDER BY effective_date) - 1 AS DATE) AS end_date,
       list_price, CAST(0 AS DECIMAL(5,2)) AS discount_pct, list_price AS net_price, false AS promo_flag, 'Standard' AS channel
FROM (SELECT item_id, month AS effective_date, list_price,
             lag(list_price) OVER (PARTITION BY item_id ORDER BY month) AS prev FROM x_monthly_price) m
WHERE prev IS NULL OR prev <> list_price""")


@register("asof_price", """
SELECT l.order_line_id, p.effective_date, p.list_price
FROM v_lines l JOIN v_orders o ON l.order_id = o.order_id
LEFT JOIN x_price_history p ON l.item_id = p.item_id AND o.order_date >= p.effective_date
                            AND o.order_date <= coalesce(p.end_date, DATE '9999-12-31')""")
def q_asof_price(t):
    ph = PR.build_price_history(t.v_lines_noid, t.v_orders, with_ids=False)
    facts = (t.v_lines.select("order_line_id", "order_id", "item_id")
             .join(t.v_orders.select("order_id", "order_date"), "order_id"))
    j = J.asof_join(facts, ph.select("item_id", "effective_date", "end_date", "list_price"), ["item_id"],
                    "order_date", "effective_date", "end_date")
    return j.select("order_line_id", "effective_date", "list_price")



define_view("x_contact_reps", f"""
SELECT customer_id, segment, is_sub, region, primary_rep_id,
       pool2[CAST(floor({keyed_uniform_sql(C.SEED, 'rep2', 'customer_id')} * len(pool2)) AS INT) + 1] AS secondary_rep_id
FROM (
  SELECT *, CASE WHEN len(list_filter(pool, lambda x: x <> primary_rep_id)) > 0 THEN list_filter(pool, lambda x: x <> primary_rep_id)
                 WHEN len(list_filter(all_ids, lambda x: x <> primary_rep_id)) > 0 THEN list_filter(all_ids, lambda x: x <> primary_rep_id)
                 ELSE all_ids END AS pool2
  FROM (
    SELECT c.customer_id, c.segment, c.is_sub, c.region, coalesce(r.ids, a.all_ids) AS pool, a.all_ids,
           coalesce(r.ids, a.all_ids)[(c.customer_id % len(coalesce(r.ids, a.all_ids))) + 1] AS primary_rep_id
    FROM v_customers c
    LEFT JOIN (SELECT region, list_sort(array_agg(rep_id)) AS ids FROM v_reps GROUP BY region) r ON c.region = r.region
    CROSS JOIN (SELECT array_agg(rep_id ORDER BY region, rep_id) AS all_ids FROM v_reps) a) x) y""")
