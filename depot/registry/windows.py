"""Window, ranking and versioning operators and samplers (2.6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from depot import config as C
from depot.functions.draws import keyed_uniform, keyed_uniform_sql
from depot.functions import rules as R
from depot.operators import sampling as S
from depot.operators.keys import dense_keys
from depot.operators.windows import (compounded_walk, first_per_key, latest_per_key, seq_within, top_n)
from depot.plans import pricing as PR
from depot.registry import register

SEED = C.SEED


def u_sql(salt, *keys):
    return keyed_uniform_sql(SEED, salt, *keys)


# ---- E1
@register("carton_sequence", """
SELECT order_line_id, order_id, row_number() OVER (PARTITION BY order_id ORDER BY order_line_id) AS carton_seq,
       CAST(order_id AS VARCHAR) || '-C' || CAST(row_number() OVER (PARTITION BY order_id ORDER BY order_line_id) AS VARCHAR) AS carton_number
FROM v_lines""")
def q_carton_sequence(t):
    s = seq_within(t.v_lines.select("order_line_id", "order_id"), ["order_id"], ["order_line_id"], "carton_seq")
    return s.select("order_line_id", "order_id", "carton_seq", R.carton_code("order_id", "carton_seq").alias("carton_number"))


# ---- E2
@register("freight_upcharge", "SELECT shipment_line_id, shipment_id, freight_upcharge FROM x_shipment_lines")
def q_freight_upcharge(t):
    from depot.registry.tables import shipment_lines
    return shipment_lines(t).select("shipment_line_id", "shipment_id", "freight_upcharge")


# ---- E3
@register("top_n_items_per_customer", """
SELECT customer_id, item_id, item_rank FROM (
  SELECT customer_id, item_id, row_number() OVER (PARTITION BY customer_id ORDER BY total_revenue DESC, item_id) AS item_rank
  FROM x_rfm) r WHERE item_rank <= 5""")
def q_top_n_items_per_customer(t):
    from depot.registry.aggregates import rfm
    r = rfm(t)
    return top_n(r, ["customer_id"], [F.col("total_revenue").desc(), F.col("item_id")], 5, rank_col="item_rank") \
        .select("customer_id", "item_id", "item_rank")


# ---- E4
@register("latest_cost_version", """
SELECT item_id, max(effective_date) AS effective_date, arg_max(list_price, effective_date) AS list_price
FROM x_price_history GROUP BY item_id""")
def q_latest_cost_version(t):
    ph = PR.build_price_history(t.v_lines_noid, t.v_orders, with_ids=False)
    return latest_per_key(ph.select("item_id", "effective_date", "list_price"), ["item_id"], "effective_date")


# ---- E5
@register("first_shipment", """
SELECT order_id, min({'d': ship_date, 's': shipment_id}).s AS shipment_id, min(ship_date) AS ship_date
FROM v_shipments GROUP BY order_id""")
def q_first_shipment(t):
    return first_per_key(t.v_shipments.select("order_id", "ship_date", "shipment_id"), ["order_id"],
                         ["ship_date", "shipment_id"])


# ---- E6
@register("price_intervals", "SELECT item_id, effective_date, end_date FROM x_price_history")
def q_price_intervals(t):
    return PR.build_price_history(t.v_lines_noid, t.v_orders, with_ids=False).select("item_id", "effective_date", "end_date")


# ---- E7
@register("price_walk", """
SELECT item_id, v AS version, p AS price FROM (
  WITH RECURSIVE f AS (
      SELECT item_id, row_number() OVER w - 1 AS v, CAST(list_price AS DECIMAL(18,4)) AS list_price,
             CAST((20000 * n + lag(n) OVER w) // (2 * lag(n) OVER w) AS DECIMAL(12,0)) * CAST(0.0001 AS DECIMAL(4,4)) AS factor
      FROM (SELECT *, CAST(CAST(list_price AS DECIMAL(18,4)) * 10000 AS BIGINT) AS n FROM x_price_history) h WINDOW w AS (PARTITION BY item_id ORDER BY effective_date)),
    walk AS (
      SELECT item_id, v, greatest(CAST(0.01 AS DECIMAL(18,4)), list_price) AS p FROM f WHERE v = 0
      UNION ALL
      SELECT w.item_id, f.v, CAST(greatest(CAST(0.01 AS DECIMAL(18,4)), CAST(round(w.p * f.factor, 4) AS DECIMAL(18,4))) AS DECIMAL(18,4))
      FROM walk w JOIN f ON f.item_id = w.item_id AND f.v = w.v + 1)
  SELECT * FROM walk) z""")
def q_price_walk(t):
    # the item's first observed price, moved by the observed changes from price to price
    # (a row per item and month at most, so an item's list is short)
    ph = PR.build_price_history(t.v_lines_noid, t.v_orders, with_ids=False)
    n = (F.col("list_price").cast("decimal(18,4)") * 10000).cast("long")
    per = ph.groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("effective_date", F.col("list_price").alias("p"), n.alias("n")))).alias("h"))
    # the ratio of two prices to four places, half up, in whole numbers
    change = F.expr("transform(slice(h, 2, size(h)), (x, i) -> "
                    "cast((20000 * x.n + h[i].n) div (2 * h[i].n) AS decimal(12,0)) * cast(0.0001 AS decimal(4,4)))")
    path = compounded_walk(F.get(F.col("h"), F.lit(0))["p"], change)
    return per.select("item_id", F.posexplode(path).alias("version", "price")) \
        .select("item_id", "version", F.col("price").cast("decimal(18,4)").alias("price"))


# ---- E8
@register("dense_keys", """
SELECT event_id, row_number() OVER (ORDER BY ts, event_id) + 999 AS seq_id FROM events""")
def q_dense_keys(t):
    return dense_keys(t.events.select("event_id", "ts"), ["ts", "event_id"], "seq_id", start=1000) \
        .select("event_id", "seq_id")


# ---- F1
@register("multi_key_sort", """
SELECT order_id, order_date, row_number() OVER (ORDER BY order_date DESC, order_id ASC) AS sort_pos FROM v_orders""")
def q_multi_key_sort(t):
    o = t.v_orders.select("order_id", "order_date").withColumn("_neg_day", -F.unix_date("order_date"))
    return dense_keys(o, ["_neg_day", "order_id"], "sort_pos").select("order_id", "order_date", "sort_pos")


# ---- F2
@register("sample_rows", f"""
SELECT order_id, customer_id, order_date FROM v_orders ORDER BY {u_sql('sample', 'order_id')}, order_id LIMIT 100""")
def q_sample_rows(t):
    return S.sample_rows(t.v_orders.select("order_id", "customer_id", "order_date"), 100, ["order_id"], SEED)


# ---- F3
@register("stratified_fraction", f"""
SELECT dc_id, item_id FROM v_stock WHERE {u_sql('strat', 'dc_id', 'item_id')} < 0.4""")
def q_stratified_fraction(t):
    return S.fraction_sample(t.v_stock.select("dc_id", "item_id"), 0.4, ["dc_id", "item_id"], SEED, "strat")


# ---- F4
@register("sample_exact_fraction", f"""
SELECT order_line_id FROM (
  SELECT order_line_id, row_number() OVER (ORDER BY {u_sql('exact', 'order_line_id')}, order_line_id) AS r,
         count(*) OVER () AS n
  FROM x_eligible_lines) x
WHERE r <= greatest(1, round(n * 0.05))""")
def q_sample_exact_fraction(t):
    from depot.registry.joins import eligible_lines
    return S.sample_exact_fraction(eligible_lines(t).select("order_line_id"), 0.05, ["order_line_id"], SEED)


# ---- F5
_VEL = "greatest(1, CAST(trunc(120.0 / greatest(1.0, CAST(i.unit_price AS DOUBLE)) * 1.25) AS INT))"


@register("weighted_sample", f"""
SELECT dc_id, item_id, es_key, sample_rank FROM (
  SELECT s.dc_id, s.item_id, es_key,
         row_number() OVER (PARTITION BY s.dc_id ORDER BY es_key, s.dc_id, s.item_id) AS sample_rank
  FROM (SELECT s.dc_id, s.item_id,
               round(-ln(greatest({u_sql('weighted', 's.dc_id', 's.item_id')}, 1e-12)) / CAST({_VEL} AS DOUBLE), 9) AS es_key
        FROM v_stock s JOIN v_items i ON s.item_id = i.item_id) s) x
WHERE sample_rank <= 10""")
def q_weighted_sample(t):
    s = t.v_stock.select("dc_id", "item_id").join(
        t.v_items.select("item_id", R.price_velocity("unit_price").alias("velocity")), "item_id")
    return S.weighted_sample(s, ["dc_id"], "velocity", 10, ["dc_id", "item_id"], SEED).select(
        "dc_id", "item_id", "es_key", "sample_rank")


# ---- F6
UNKNOWN_PRIORITY = "4-NOT SPECIFIED"


@register("weighted_category", f"""
WITH o AS (SELECT o_orderkey, o_orderpriority, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
n AS (SELECT c_mktsegment, o_orderpriority, count(*) AS n FROM o WHERE o_orderpriority <> '{UNKNOWN_PRIORITY}' GROUP BY ALL),
cuts AS (SELECT c_mktsegment, o_orderpriority, n, sum(n) OVER (PARTITION BY c_mktsegment ORDER BY o_orderpriority) - n AS lo,
                sum(n) OVER (PARTITION BY c_mktsegment) AS total FROM n),
m AS (SELECT o_orderkey, c_mktsegment, {u_sql('impute', 'o_orderkey')} AS u FROM o
      WHERE o_orderpriority IS NULL OR o_orderpriority = '{UNKNOWN_PRIORITY}')
SELECT m.o_orderkey AS order_id, m.c_mktsegment AS market_segment, c.o_orderpriority AS priority
FROM m LEFT JOIN cuts c ON m.c_mktsegment IS NOT DISTINCT FROM c.c_mktsegment
     AND floor(m.u * CAST(c.total AS DOUBLE)) >= c.lo AND floor(m.u * CAST(c.total AS DOUBLE)) < c.lo + c.n""")
def q_weighted_category(t):
    """Orders without a priority get one by the shares of their customers' market segment."""
    o = t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("market_segment")),
                      "o_custkey", "left")
    o = o.select(F.col("o_orderkey").alias("order_id"), "market_segment", F.col("o_orderpriority").alias("priority"))
    return S.impute_category(o, ["market_segment"], "priority", F.col("priority") == UNKNOWN_PRIORITY, ["order_id"], SEED)


# ---- F7
@register("pick_one_active", f"""
SELECT o.order_id, min({{'u': {u_sql('pick', 'o.order_id', 'p.promo_id')}, 'p': p.promo_id}}).p AS promo_id
FROM v_orders o JOIN v_promotions p ON o.order_date BETWEEN p.start_date AND p.end_date GROUP BY o.order_id""")
def q_pick_one_active(t):
    from depot.operators.joins import range_join
    j = range_join(t.v_orders.select("order_id", "order_date"), t.v_promotions, "order_date", "start_date", "end_date")
    return S.pick_one(j.select("order_id", "promo_id"), ["order_id"], "promo_id", SEED)


# ---- F8
@register("conditional_bernoulli", f"""
SELECT order_line_id FROM v_lines
WHERE {u_sql('keep', 'order_line_id')} <= 0.08 + 0.6 * least(1.0, quantity_ordered / 50.0)""")
def q_conditional_bernoulli(t):
    p = F.lit(0.08) + F.lit(0.6) * F.least(F.lit(1.0), F.col("quantity_ordered") / F.lit(50.0))
    return S.conditional_bernoulli(t.v_lines.select("order_line_id", "quantity_ordered"), p, ["order_line_id"],
                                   SEED).select("order_line_id")
