"""SQL twins of the business views, for the independent (DuckDB) oracle.

Each entry is a CTE body; ``with_views(sql)`` prefixes a query with the CTEs
it references (transitively), in dependency order.
"""

from __future__ import annotations

import re

ADAPTER_SQL: dict[str, str] = {
    "v_dcs": """
SELECT CAST(n_nationkey + 1 AS BIGINT) AS dc_id, concat('DC ', n_name) AS dc_name, n_name AS city,
       (['AL', 'AK', 'AZ', 'AR', 'CA', 'CO', 'CT', 'DE', 'FL', 'GA', 'HI', 'ID', 'IL',
         'IN', 'IA', 'KS', 'KY', 'LA', 'ME', 'MD', 'MA', 'MI', 'MN', 'MS', 'MO'])[n_nationkey + 1] AS state,
       lpad(CAST(10000 + 137*n_nationkey AS VARCHAR(5)), 5, '0') AS zip, r_name AS region,
       20000 + 18000*n_nationkey AS capacity_units
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "v_customers": """
SELECT c_custkey AS customer_id,
       CASE WHEN c_custkey % 5 < 3 THEN c_custkey ELSE c_custkey - c_custkey % 5 END AS master_id,
       c_custkey % 5 >= 3 AS is_sub, c_name AS customer_name,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Dealer' WHEN 'FURNITURE' THEN 'Retailer' WHEN 'BUILDING' THEN 'Corporate'
            WHEN 'HOUSEHOLD' THEN 'Education' ELSE 'Government' END AS segment,
       r_name AS region, CAST(c_acctbal AS DECIMAL(12,2)) AS credit_limit,
       CAST(c_custkey % 51 AS DECIMAL(5,2)) / 10 AS discount_percentage,
       CASE WHEN c_custkey % 20 = 0 THEN 'y' ELSE 'N' END AS tax_exempt_flag,
       (c_custkey % 9 + 1) / CAST(10 AS DOUBLE) AS risk_score
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "v_items": """
SELECT p_partkey AS item_id, concat('SKU-', CAST(p_partkey AS VARCHAR(20))) AS item_sku, p_name AS item_description,
       CASE p_type WHEN 'ECONOMY' THEN 'Office Supplies' WHEN 'LARGE' THEN 'Furniture' WHEN 'MEDIUM' THEN 'Cleaning Chemicals'
            WHEN 'PROMO' THEN 'Break Room' WHEN 'SMALL' THEN 'Technology' ELSE 'Industrial' END AS category,
       CASE WHEN p_partkey % 11 = 0 THEN 'Copiers' WHEN p_partkey % 11 = 1 THEN 'Paper' ELSE p_brand END AS subcategory,
       CAST(p_partkey % 30 + 1 AS INT) AS lead_time_days,
       p_size AS length_in, CAST(1 + p_partkey % 24 AS INT) AS width_in, CAST(1 + p_partkey % 12 AS INT) AS height_in,
       CAST(p_size * (1 + p_partkey % 7) AS DECIMAL(10,3)) / 10 AS weight_lb,
       CASE WHEN p_partkey % 13 = 0 THEN NULL
            ELSE round(p_size * (1 + p_partkey % 24) * (1 + p_partkey % 12) / CAST(1728 AS DOUBLE), 4) END AS cube_ft,
       CAST(1 + p_partkey % 200 AS DECIMAL(12,2)) AS unit_price,
       CAST(1 + p_partkey % 200 AS DECIMAL(12,2)) * 7 / 10 AS unit_cost,
       CAST(1 + p_size % 9 AS DECIMAL(12,2)) / 4 AS shipping_cost_per_unit
FROM part""",
    "v_vendors": """
SELECT s_suppkey AS vendor_id, s_name AS vendor_name FROM supplier""",
    "v_carriers": """
SELECT CAST(s_suppkey + 1 AS INTEGER) AS carrier_id, s_name AS carrier_name,
       (['parcel', 'parcel', 'parcel', 'LTL', 'LTL', 'courier', 'courier', 'parcel', 'company', 'company'])[s_suppkey % 10 + 1] AS carrier_type
FROM supplier""",
    "v_reps": """
SELECT CAST(s_suppkey + 1 AS INTEGER) AS rep_id, r_name AS region
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey < 4""",
    "v_orders": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
       o_orderkey % 25 + 1 AS dc_id,
       CASE WHEN o_orderpriority IN ('1-URGENT') THEN 'Overnight' WHEN o_orderpriority IN ('2-HIGH') THEN '2-Day' ELSE 'Ground' END AS ship_via,
       CASE WHEN o_orderstatus = 'F' THEN 'Complete' WHEN o_orderstatus = 'O' THEN 'Open'
            WHEN o_orderkey % 10 < 3 THEN 'Cancelled' ELSE 'Backordered' END AS order_status
FROM orders""",
    "v_lines": """
SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
                          l_tax, l_returnflag, l_linestatus, l_shipdate) AS order_line_id,
       l_orderkey AS order_id, l_partkey AS item_id, l_suppkey AS vendor_id, CAST(l_quantity AS INT) AS quantity_ordered,
       CAST(floor((2*round(l_extendedprice*100) + l_quantity) / (2*l_quantity)) AS DECIMAL(14,0)) / 100 AS unit_price,
       CAST(l_extendedprice AS DECIMAL(12,2)) AS extended_price, l_returnflag AS return_flag, CAST(l_shipdate AS DATE) AS line_ship_date
FROM lineitem""",
    "v_shipments": """
SELECT order_id AS shipment_id, order_id, dc_id, CAST(order_id % 10 + 1 AS INT) AS carrier_id,
       order_date + CAST(order_id % 4 AS INT) AS ship_date,
       order_date + CAST(order_id % 4 + order_id % 7 + 1 AS INT) AS promised_date,
       order_date + CAST(order_id % 4 + order_id % 7 + 1 + order_id % 5 - 2 AS INT) AS delivery_date,
       CASE WHEN order_id % 20 < 5 THEN 'local' WHEN order_id % 20 < 7 THEN 'wrap_and_label' WHEN order_id % 20 < 9 THEN 'drop_ship'
            WHEN order_id % 20 < 16 THEN 'standard' WHEN order_id % 20 < 18 THEN 'expedited' ELSE 'freight' END AS shipment_type
FROM v_orders""",
    "v_promotions": """
SELECT CAST(12*y + m AS INT) AS promo_id, make_date(y, m, 1 + (y + 3*m) % 20) AS start_date,
       make_date(y, m, 1 + (y + 3*m) % 20) + CAST(6 + (y * m) % 24 AS INT) AS end_date,
       CASE WHEN m % 20 < 7 THEN 'PCTOFF' WHEN m < 11 THEN 'FIXEDOFF' ELSE 'BOGO' END AS discount_type
FROM (SELECT DISTINCT CAST(year(order_date) AS INT) AS y, CAST(month(order_date) AS INT) AS m FROM v_orders) d""",
    "v_payments": """
SELECT o_orderkey AS invoice_id,
       CASE WHEN o_orderkey % 10 <= 5 THEN 1.0 WHEN o_orderkey % 10 <= 7 THEN 0.9 ELSE 0.3 END::DOUBLE AS paid_ratio
FROM orders WHERE o_orderkey % 10 <> 9""",
}



def define_view(name: str, sql: str) -> str:
    """Add a shared derived view (used by several oracle queries)."""
    ADAPTER_SQL[name] = sql
    return name


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the CTEs it needs (adapters + ``extra`` CTEs)."""
    pool = dict(ADAPTER_SQL)
    order = list(ADAPTER_SQL)
    if extra:
        pool.update(extra)
        order += [k for k in extra if k not in ADAPTER_SQL]
    need: dict[str, None] = {}

    def add(text: str, above: tuple[str, ...] = ()) -> None:
        for name in order:
            if name not in need and name not in above and re.search(rf"\b{name}\b", text):
                add(pool[name], (*above, name))     # what it reads stands before it, whichever module defined it first
                need[name] = None

    add(sql)
    if not need:
        return sql
    ctes = ",\n".join(f"{name} AS ({pool[name]}\n)" for name in need)
    return f"WITH {ctes}\n{sql}"


# ---- second group of views (twins of the properties added by _more_views)
define_view("v_returned_lines", """
SELECT order_line_id,
       CASE WHEN order_line_id % 20 < 11 THEN 'Resalable' WHEN order_line_id % 20 < 15 THEN 'Damaged'
            WHEN order_line_id % 20 < 18 THEN 'Defective' ELSE 'Destroyed' END AS condition_code,
       (['Damaged', 'Wrong Item', 'Not as Described', 'Overshipment', 'Customer Preference', 'Defective'])[order_line_id % 6 + 1]
           AS reason_code,
       greatest(1, least(quantity_ordered, CAST(floor(quantity_ordered * 3 / 5) AS INT))) AS qty_returned
FROM v_lines WHERE return_flag = 'R'""")

define_view("v_stock", """
SELECT a.dc_id, a.item_id, qty_on_hand, qty_on_order,
       CAST(round(CAST(i.unit_cost AS DECIMAL(12,2)) * CAST(1.015 AS DECIMAL(10,6)), 2) AS DECIMAL(12,2)) AS std_cost,
       CAST(round(CAST(i.unit_cost AS DECIMAL(12,2)) * CAST(1.015 AS DECIMAL(10,6)) * CAST(1.005 AS DECIMAL(10,6)), 2) AS DECIMAL(12,2)) AS last_cost,
       CAST(round((CAST(i.unit_cost AS DECIMAL(12,2)) * CAST(1.015 AS DECIMAL(10,6))
                   + CAST(i.unit_cost AS DECIMAL(12,2)) * CAST(1.015 AS DECIMAL(10,6)) * CAST(1.005 AS DECIMAL(10,6)))
                  * CAST(0.5 AS DECIMAL(2,1)), 2) AS DECIMAL(12,2)) AS avg_cost,
       least(50, greatest(5, CAST(trunc(qty_on_hand / 12) AS INT))) AS reorder_point,
       printf('A%d-%d-%d', a.item_id % 50 + 1, a.dc_id % 20 + 1, (a.item_id + a.dc_id) % 10 + 1) AS stocking_location,
       vendor_id, last_restock_date
FROM (SELECT o.dc_id, l.item_id, CAST(sum(l.quantity_ordered) AS BIGINT) AS qty_on_hand,
             CAST(sum(CASE WHEN o.order_status IN ('Open', 'Backordered') THEN l.quantity_ordered ELSE 0 END) AS BIGINT) AS qty_on_order,
             max(l.line_ship_date) AS last_restock_date,
             max({'d': l.line_ship_date, 'v': l.vendor_id}).v AS vendor_id
      FROM v_lines l JOIN v_orders o ON l.order_id = o.order_id GROUP BY o.dc_id, l.item_id) a
LEFT JOIN v_items i ON a.item_id = i.item_id""")

define_view("v_po_status", """
SELECT dc_id, item_id, CASE WHEN (dc_id * 31 + item_id) % 20 < 14 THEN 'Received' WHEN (dc_id * 31 + item_id) % 20 < 17 THEN 'Partial'
                            WHEN (dc_id * 31 + item_id) % 20 < 19 THEN 'Open' ELSE 'Cancelled' END AS po_status
FROM v_stock""")

define_view("v_movements", """
SELECT coalesce(o.dc_id, p.dc_id) AS dc_id, coalesce(o.item_id, p.item_id) AS item_id, coalesce(o.month, p.month) AS month,
       CAST(coalesce(p.qty_in, 0) AS BIGINT) AS qty_in, CAST(coalesce(o.qty_out, 0) AS BIGINT) AS qty_out
FROM (SELECT dc_id, item_id, month, qty_out FROM
        (SELECT o.dc_id, l.item_id, CAST(date_trunc('month', o.order_date) AS DATE) AS month,
                CAST(sum(l.quantity_ordered) AS BIGINT) AS qty_out
         FROM v_lines l JOIN v_orders o ON l.order_id = o.order_id GROUP BY ALL) x) o
FULL JOIN (SELECT o.dc_id, l.item_id, CAST(date_trunc('month', o.order_date) + INTERVAL 1 MONTH AS DATE) AS month,
                  CAST(ceil(sum(l.quantity_ordered) * 1.1) AS BIGINT) AS qty_in
           FROM v_lines l JOIN v_orders o ON l.order_id = o.order_id GROUP BY ALL) p
  ON o.dc_id = p.dc_id AND o.item_id = p.item_id AND o.month = p.month""")

define_view("v_adjustments", """
SELECT event_id AS adjustment_id, event_id % 25 + 1 AS dc_id, user_id AS item_id,
       CASE event_type WHEN 'signup' THEN 'Cycle Count' WHEN 'error' THEN 'Damage' WHEN 'click' THEN 'Shrink'
                       WHEN 'view' THEN 'Return to Stock' WHEN 'purchase' THEN 'Administrative Correction' END AS adjustment_type,
       ([['Count Variance', 'Recount Adjustment', 'Audit Correction'],
         ['Crushed', 'Leaking', 'Broken', 'Packaging Damage'],
         ['Lost', 'Misplaced', 'Theft Suspected'],
         ['Customer Return', 'Restock', 'RMA'],
         ['Data Entry Error', 'Unit of Measure Correction', 'Transfer Correction']])[event_id % 5 + 1][event_id % 3 + 1] AS reason_code,
       greatest(1, CAST(trunc(value) AS INT)) AS quantity, ts AS adjustment_timestamp
FROM events""")

define_view("v_rates", """
SELECT carrier_id, carrier_type, CAST(18.0 + carrier_id * 1.5 AS DECIMAL(8,2)) AS hourly,
       CAST(0.30 + carrier_id * 0.04 AS DECIMAL(8,2)) AS per_mile, CAST(8.0 + carrier_id * 1.5 AS DECIMAL(8,2)) AS per_stop
FROM v_carriers""")

define_view("v_fuel", """
SELECT state, fuel_type, CAST(CASE WHEN fuel_type = 'diesel' THEN 3.50 + dc_id * 0.05 ELSE 2.80 + dc_id * 0.05 END AS DECIMAL(6,3))
           AS cost_per_gallon
FROM v_dcs CROSS JOIN (VALUES ('diesel'), ('gasoline')) f(fuel_type)""")
