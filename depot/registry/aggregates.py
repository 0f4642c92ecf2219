"""Aggregations over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from depot.operators import aggregates as A
from depot.plans import costs as CO
from depot.plans import customers as CU
from depot.plans import fulfillment as FUL
from depot.registry import register
from depot.sources.adapter_sql import define_view
from depot.sources.tables import BASE_TABLES


# ---- D3
@register("avg_available_by_item", "SELECT * FROM x_avg_available")
def q_avg_available_by_item(t):
    from depot.registry.joins import avg_available
    return avg_available(t)


# ---- D4
define_view("x_rfm", """
SELECT o.customer_id, l.item_id, CAST(sum(l.quantity_ordered) AS BIGINT) AS total_qty,
       CAST(sum(l.extended_price) AS DECIMAL(18,2)) AS total_revenue, max(o.order_date) AS last_order_date,
       count(DISTINCT l.order_id) AS n_orders
FROM v_lines l JOIN v_orders o ON l.order_id = o.order_id GROUP BY o.customer_id, l.item_id""")


def rfm(t):
    """Per customer-item: units, revenue, last order date, distinct orders."""
    per_order = A.by_order(t.v_lines_noid, t.v_orders, ["customer_id", "item_id"])
    return per_order.groupBy("customer_id", "item_id").agg(
        F.sum("_q").cast("long").alias("total_qty"),
        F.sum("_m").cast("decimal(18,2)").alias("total_revenue"),
        F.max("order_date").alias("last_order_date"),
        F.count(F.lit(1)).alias("n_orders"))


@register("rfm_aggregate", "SELECT * FROM x_rfm")
def q_rfm_aggregate(t):
    return rfm(t)


# ---- D5, D6
@register("invoice_merchandise", """
SELECT order_id, CAST(sum(quantity_ordered * CAST(unit_price AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS merchandise_total
FROM x_order_lines GROUP BY order_id""")
def q_invoice_merchandise(t):
    return FUL.invoice_merchandise(FUL.build_order_lines(t.v_lines_noid, t.v_orders, t.v_customers, t.v_items))


@register("invoice_freight", "SELECT order_id, freight_billed FROM x_invoices")
def q_invoice_freight(t):
    return FUL.invoice_freight(FUL.build_order_lines(t.v_lines_noid, t.v_orders, t.v_customers, t.v_items),
                               t.v_items)


# ---- D7
@register("reps_by_region", """
SELECT region, row_number() OVER (PARTITION BY region ORDER BY rep_id) AS place, rep_id,
       count(*) OVER (PARTITION BY region) AS n_reps
FROM v_reps""")
def q_reps_by_region(t):
    return CU.reps_by_region(t.v_reps)


# ---- D8
@register("distinct_categories", """
SELECT category, (SELECT count(DISTINCT category) FROM v_items) AS n_categories
FROM (SELECT DISTINCT category FROM v_items) d""")
def q_distinct_categories(t):
    cats = t.v_items.select("category").distinct()
    n = t.v_items.agg(F.countDistinct("category").alias("n_categories"))
    return cats.crossJoin(F.broadcast(n))        # n: one row


# ---- D9
@register("drop_duplicate_pairs", "SELECT DISTINCT vendor_id, item_id FROM v_lines")
def q_drop_duplicate_pairs(t):
    return t.v_lines_noid.select("vendor_id", "item_id").dropDuplicates()


# ---- D10
@register("score_quantile", """
SELECT CAST(round(quantile_cont(CAST(total_revenue AS DOUBLE), 0.8), 2) AS DECIMAL(18,2)) AS p80,
       (SELECT count(*) FROM x_rfm WHERE CAST(total_revenue AS DOUBLE) >=
          (SELECT quantile_cont(CAST(total_revenue AS DOUBLE), 0.8) FROM x_rfm)) AS n_at_or_above
FROM x_rfm""")
def q_score_quantile(t):
    r = rfm(t)
    p = A.exact_percentile(r, "total_revenue", 0.8, tie_cols=["customer_id", "item_id"])
    above = (r.filter(F.col("total_revenue").cast("double") >= p.select("value").scalar())
             .agg(F.count(F.lit(1)).alias("n_at_or_above")))
    return p.crossJoin(above).select(F.round("value", 2).cast("decimal(18,2)").alias("p80"), "n_at_or_above")


# ---- D11
@register("minmax_normalize", """
SELECT customer_id, item_id,
       CAST(round(CASE WHEN mx = mn THEN 0.5 ELSE (CAST(total_revenue AS DOUBLE) - mn) / (mx - mn) END, 6) AS DECIMAL(10,6)) AS revenue_norm
FROM x_rfm CROSS JOIN (SELECT min(CAST(total_revenue AS DOUBLE)) AS mn, max(CAST(total_revenue AS DOUBLE)) AS mx FROM x_rfm) m""")
def q_minmax_normalize(t):
    n = A.minmax_normalize(rfm(t), "total_revenue", "revenue_norm")
    return n.select("customer_id", "item_id", F.round("revenue_norm", 6).cast("decimal(10,6)").alias("revenue_norm"))


# ---- D12
define_view("x_company_rates", """
SELECT r.carrier_id, r.cost_type, r.carrier_type = 'company' AS company_driver,
       CAST(round(CASE WHEN r.carrier_type = 'company'
                       THEN coalesce(CAST(m.ltl_min AS DECIMAL(12,4)),
                                     CAST(CASE r.cost_type WHEN 'hourly' THEN 18.0 WHEN 'per_mile' THEN 0.30 ELSE 8.0 END AS DECIMAL(12,4)))
                            * CAST(0.8 AS DECIMAL(3,2))
                       ELSE r.rate_amount END, 4) AS DECIMAL(12,4)) AS rate_amount
FROM (UNPIVOT v_rates ON hourly, per_mile, per_stop INTO NAME cost_type VALUE rate_amount) r
LEFT JOIN (SELECT cost_type, min(rate_amount) AS ltl_min
           FROM (UNPIVOT v_rates ON hourly, per_mile, per_stop INTO NAME cost_type VALUE rate_amount) u
           WHERE carrier_type = 'LTL' GROUP BY cost_type) m ON r.cost_type = m.cost_type""")


@register("company_driver_rates", "SELECT * FROM x_company_rates")
def q_company_driver_rates(t):
    return CO.company_driver_rates(t.v_rates)


# ---- D13, D14
def _base(t):
    return {n: getattr(t, n) for n in BASE_TABLES}


@register("record_counts", " UNION ALL ".join(
    [f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in BASE_TABLES])
    + " UNION ALL SELECT 'TOTAL', (" + " + ".join(f"(SELECT count(*) FROM {n})" for n in BASE_TABLES) + ")")
def q_record_counts(t):
    return A.record_counts(_base(t))


def _profile_sql(name: str, cols: list[str]) -> str:
    nulls = " + ".join(f"count_if({c} IS NULL)" for c in cols)
    return (f"SELECT '{name}' AS table_name, count(*) AS row_count, {len(cols)} AS column_count, "
            f"CAST({nulls} AS BIGINT) AS null_cells FROM {name}")


GIVEN_COLUMNS = {
    "region": ["r_regionkey", "r_name"], "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"], "embeddings": ["vec_id", "embedding", "label"],
    "pages": ["page_id", "url", "html"], "benchmark": ["item_id", "text"], "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}


@register("table_profile", " UNION ALL ".join(_profile_sql(n, c) for n, c in GIVEN_COLUMNS.items()))
def q_table_profile(t):
    return A.table_profile(_base(t))


# ---- D15
@register("carton_weight_flag", """
SELECT shipment_id, CAST(sum(weight_lb * quantity_ordered) AS DECIMAL(18,4)) AS ship_weight_lb,
       sum(weight_lb * quantity_ordered) > 250 AS over_250_lb
FROM x_sl_base GROUP BY shipment_id""")
def q_carton_weight_flag(t):
    base = (t.v_lines_noid.select("order_id", "item_id", "quantity_ordered")
            .join(t.v_shipments.select("shipment_id", "order_id"), "order_id")
            .join(t.v_items.select("item_id", F.col("weight_lb").cast("decimal(12,4)").alias("w")), "item_id", "left"))
    s = base.groupBy("shipment_id").agg(F.sum(F.col("w") * F.col("quantity_ordered")).alias("_sw"))
    return s.select("shipment_id", F.col("_sw").cast("decimal(18,4)").alias("ship_weight_lb"),
                    (F.col("_sw") > 250).alias("over_250_lb"))
