"""Business-rule columns, each run over whole given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from depot import config as C
from depot.functions import rules as R
from depot.registry import register


def dec(col, scale: int, precision: int = 18):
    return F.round(col, scale).cast(f"decimal({precision},{scale})")


# ---- B1
@register("filter_complete_orders", """
SELECT order_id, customer_id, order_date, dc_id FROM v_orders WHERE order_status = 'Complete'""")
def q_filter_complete_orders(t):
    return t.v_orders.filter(R.status_is("order_status", "Complete")).select(
        "order_id", "customer_id", "order_date", "dc_id")


# ---- B2
@register("coerce_clean_numeric", """
SELECT event_id,
       least(greatest(coalesce(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER), 0), 0), 50) AS k_clean,
       CAST(round(least(greatest(coalesce(TRY_CAST(value AS DOUBLE), 0.0), 0.0), 100.0), 2) AS DECIMAL(12,2)) AS value_clean,
       coalesce(TRY_CAST(event_type AS DOUBLE), -1.0) AS type_as_number
FROM events""")
def q_coerce_clean_numeric(t):
    e = t.events
    return e.select(
        "event_id",
        R.coerce_numeric(F.get_json_object("props", "$.k"), default=0, lo=0, hi=50, to="int").alias("k_clean"),
        dec(R.coerce_numeric(F.col("value"), default=0.0, lo=0.0, hi=100.0), 2, 12).alias("value_clean"),
        R.coerce_numeric(F.col("event_type"), default=-1.0).alias("type_as_number"))


# ---- B3
@register("discounted_line_price", """
SELECT l.order_line_id,
       CAST(round(greatest(0, CAST(l.unit_price AS DECIMAL(12,2)) * (1 - coalesce(CAST(c.discount_percentage AS DECIMAL(5,2)), 0) * CAST(0.01 AS DECIMAL(3,2)))), 2) AS DECIMAL(12,2)) AS net_unit_price,
       CAST(round(greatest(0, CAST(l.unit_price AS DECIMAL(12,2)) * (1 - coalesce(CAST(c.discount_percentage AS DECIMAL(5,2)), 0) * CAST(0.01 AS DECIMAL(3,2)))) * l.quantity_ordered, 2) AS DECIMAL(14,2)) AS net_extended_price
FROM v_lines l JOIN v_orders o ON l.order_id = o.order_id LEFT JOIN v_customers c ON o.customer_id = c.customer_id""")
def q_discounted_line_price(t):
    j = t.v_lines.select("order_line_id", "order_id", "unit_price", "quantity_ordered") \
        .join(t.v_orders.select("order_id", "customer_id"), "order_id") \
        .join(t.v_customers.select("customer_id", F.col("discount_percentage").cast("decimal(5,2)").alias("d")),
              "customer_id", "left")
    unit = F.col("unit_price").cast("decimal(12,2)")
    net = F.greatest(F.lit(0), unit * (F.lit(1) - F.coalesce("d", F.lit(0)) * F.lit(0.01).cast("decimal(3,2)")))
    return j.select("order_line_id", dec(net, 2, 12).alias("net_unit_price"),
                    dec(net * F.col("quantity_ordered"), 2, 14).alias("net_extended_price"))


# ---- B4
@register("item_cube", """
SELECT item_id, CAST(round(CASE WHEN cube_ft IS NOT NULL THEN cube_ft
                                WHEN length_in IS NOT NULL AND width_in IS NOT NULL AND height_in IS NOT NULL
                                THEN CAST(length_in AS DOUBLE) * width_in * height_in / 1728.0 END, 4) AS DECIMAL(12,4)) AS cube_ft
FROM v_items""")
def q_item_cube(t):
    return t.v_items.select("item_id", dec(R.fill_cube("cube_ft", "length_in", "width_in", "height_in"), 4, 12)
                            .alias("cube_ft"))


# ---- B5
@register("item_density_dimweight", """
SELECT item_id,
       CAST(round(CASE WHEN cube_ft IS NULL OR cube_ft = 0 THEN NULL ELSE CAST(weight_lb AS DOUBLE) / cube_ft END, 4) AS DECIMAL(18,4)) AS density_lb_per_cuft,
       CAST(round(CAST(length_in AS DOUBLE) * width_in * height_in / 139.0, 4) AS DECIMAL(18,4)) AS dim_weight_lb
FROM v_items""")
def q_item_density_dimweight(t):
    i = t.v_items
    return i.select("item_id", dec(R.density("weight_lb", "cube_ft"), 4).alias("density_lb_per_cuft"),
                    dec(R.dim_weight("length_in", "width_in", "height_in"), 4).alias("dim_weight_lb"))


# ---- B6
_NMFC_CASE = "CASE {} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.NMFC_OVERRIDES.items()) + " END"
_DENSITY_CASE = ("CASE WHEN d IS NULL THEN '150' "
                 + " ".join(f"WHEN d < {b} THEN '{c}'" for b, c in C.NMFC_DENSITY_STEPS) + " ELSE '70' END")


@register("freight_class", f"""
SELECT item_id, coalesce({_NMFC_CASE.format('subcategory')}, {_NMFC_CASE.format('category')}, {_DENSITY_CASE}) AS freight_class
FROM (SELECT *, CASE WHEN cube_ft IS NULL OR cube_ft = 0 THEN NULL ELSE CAST(weight_lb AS DOUBLE) / cube_ft END AS d
      FROM v_items) x""")
def q_freight_class(t):
    i = t.v_items
    return i.select("item_id", R.freight_class("subcategory", "category", R.density("weight_lb", "cube_ft"))
                    .alias("freight_class"))


# ---- B7, B8
_VELOCITY_SQL = "greatest(1, CAST(trunc(120.0 / greatest(1.0, CAST(unit_price AS DOUBLE)) * 1.25) AS INT))"


@register("item_velocity", f"SELECT item_id, {_VELOCITY_SQL} AS velocity FROM v_items")
def q_item_velocity(t):
    return t.v_items.select("item_id", R.price_velocity("unit_price").alias("velocity"))


@register("velocity_class", f"""
SELECT item_id, velocity, CASE WHEN velocity > 80 THEN 'A' WHEN velocity > 30 THEN 'B' ELSE 'C' END AS velocity_class
FROM (SELECT item_id, {_VELOCITY_SQL} AS velocity FROM v_items) v""")
def q_velocity_class(t):
    v = t.v_items.select("item_id", R.price_velocity("unit_price").alias("velocity"))
    return v.select("item_id", "velocity", R.velocity_class("velocity").alias("velocity_class"))


# ---- B9 (measured units and revenue; thresholds as percentages of the average item's
# share of the measured totals, so that the classes do not depend on the size of the data)
ABC_PERCENT = dict(a_min=120, b_min=90)
XYZ_PERCENT = dict(x_min=115, y_min=85)
define_abc = f"""
SELECT item_id, revenue, units,
       CASE WHEN 100 * n * revenue > {ABC_PERCENT['a_min']} * all_revenue THEN 'A'
            WHEN 100 * n * revenue > {ABC_PERCENT['b_min']} * all_revenue THEN 'B' ELSE 'C' END AS abc_class,
       CASE WHEN 100 * n * units > {XYZ_PERCENT['x_min']} * all_units THEN 'X'
            WHEN 100 * n * units > {XYZ_PERCENT['y_min']} * all_units THEN 'Y' ELSE 'Z' END AS xyz_class
FROM (SELECT *, count(*) OVER () AS n, CAST(sum(revenue) OVER () AS DECIMAL(38,2)) AS all_revenue, sum(units) OVER () AS all_units
      FROM (SELECT item_id, CAST(sum(extended_price) AS DECIMAL(18,2)) AS revenue, CAST(sum(quantity_ordered) AS BIGINT) AS units
            FROM v_lines GROUP BY item_id) m) s"""


def abc_xyz(t):
    m = t.v_lines_noid.groupBy("item_id").agg(F.sum("extended_price").cast("decimal(18,2)").alias("revenue"),
                                              F.sum("quantity_ordered").cast("long").alias("units"))
    total = m.agg(F.count(F.lit(1)).alias("_n"), F.sum("revenue").cast("decimal(28,2)").alias("_revenue"), F.sum("units").cast("decimal(28,0)").alias("_units"))
    wide = lambda c: F.col("_n").cast("decimal(10,0)") * 100 * F.col(c)
    s = m.crossJoin(F.broadcast(total))                     # one row
    abc = R.abc_class(wide("revenue"), **{k: F.col("_revenue") * p for k, p in ABC_PERCENT.items()})
    xyz = R.xyz_class(wide("units"), **{k: F.col("_units") * p for k, p in XYZ_PERCENT.items()})
    return s.select("item_id", "revenue", "units", abc.alias("abc_class"), xyz.alias("xyz_class"))


@register("abc_xyz_class", define_abc)
def q_abc_xyz_class(t):
    return abc_xyz(t)


# ---- B10
@register("lifecycle_stage", """
SELECT item_id, CASE WHEN item_id % 10 = 0 THEN 'End of Life' WHEN item_id % 7 = 0 THEN 'Mature'
                     WHEN item_id % 5 = 0 THEN 'Growth' ELSE 'New' END AS lifecycle_stage FROM v_items""")
def q_lifecycle_stage(t):
    return t.v_items.select("item_id", R.lifecycle_stage("item_id").alias("lifecycle_stage"))


# ---- B11 - B13
_DUTY_SQL = ("CASE WHEN category IS NULL THEN 0.0 "
             + " ".join("WHEN " + " OR ".join(f"contains(lower(category), '{w}')" for w in ws) + f" THEN {r}"
                        for ws, r in R.DUTY_RATES) + f" ELSE {R.DUTY_OTHER} END")
_FREIGHT_SQL = ("greatest(CAST(0.05 AS DECIMAL(4,2)), CAST(0.15 AS DECIMAL(4,2)) "
                "+ coalesce(CAST(cube_ft AS DECIMAL(12,4)), 0) * CAST(0.125 AS DECIMAL(8,4)) "
                "+ coalesce(CAST(weight_lb AS DECIMAL(12,4)), 0) * CAST(0.0065 AS DECIMAL(8,5)))")


@register("duty_rate", f"SELECT item_id, CAST({_DUTY_SQL} AS DECIMAL(10,4)) AS duty_rate FROM v_items")
def q_duty_rate(t):
    return t.v_items.select("item_id", R.duty_rate("category").cast("decimal(10,4)").alias("duty_rate"))


@register("unit_freight", f"SELECT item_id, CAST(round({_FREIGHT_SQL}, 4) AS DECIMAL(18,4)) AS freight_cost FROM v_items")
def q_unit_freight(t):
    return t.v_items.select("item_id", dec(R.unit_freight("cube_ft", "weight_lb"), 4).alias("freight_cost"))


@register("landed_map_cost", f"""
SELECT item_id, CAST(round(uc * duty, 4) AS DECIMAL(18,4)) AS duty_amount,
       CAST(round(uc + fr + uc * duty, 4) AS DECIMAL(18,4)) AS landed_cost,
       CAST(round(round(uc + fr + uc * duty, 4) * CAST(1.045 AS DECIMAL(10,4)), 4) AS DECIMAL(18,4)) AS replacement_cost,
       CAST(round(greatest(CAST(unit_price AS DECIMAL(18,6)) * CAST(0.8 AS DECIMAL(3,2)),
                           round(uc + fr + uc * duty, 4) * CAST(1.225 AS DECIMAL(10,4))), 4) AS DECIMAL(18,4)) AS map_price
FROM (SELECT item_id, unit_price, CAST(unit_cost AS DECIMAL(18,6)) AS uc,
             CAST(round({_FREIGHT_SQL}, 4) AS DECIMAL(18,6)) AS fr, CAST({_DUTY_SQL} AS DECIMAL(10,4)) AS duty
      FROM v_items) x""")
def q_landed_map_cost(t):
    i = t.v_items.select("item_id", "unit_price", "unit_cost",
                         dec(R.unit_freight("cube_ft", "weight_lb"), 4).alias("fr"),
                         R.duty_rate("category").cast("decimal(10,4)").alias("duty"))
    lc = R.landed_costs("unit_cost", "unit_price", "fr", "duty")
    return i.select("item_id", *[v.alias(k) for k, v in lc.items()])


# ---- B14, B15
_SEASON_SQL = """CASE WHEN contains(lower(category), 'office') THEN CASE WHEN m IN (8, 9) THEN 1.175 ELSE 1.0 END
     WHEN contains(lower(category), 'clean') THEN CASE WHEN m IN (3, 4, 5) THEN 1.2 ELSE 0.975 END
     WHEN contains(lower(category), 'break') THEN CASE WHEN m IN (11, 12) THEN 1.25 ELSE 0.975 END ELSE 1.0 END"""


@register("seasonality_index", f"""
SELECT category, m AS month, CAST({_SEASON_SQL} AS DECIMAL(8,4)) AS seasonality_index
FROM (SELECT DISTINCT category FROM v_items) c CROSS JOIN (SELECT DISTINCT CAST(month(order_date) AS INT) AS m FROM v_orders) o""")
def q_seasonality_index(t):
    months = t.v_orders.select(F.month("order_date").cast("int").alias("month")).distinct()      # 12 rows at most
    x = t.v_items.select("category").distinct().crossJoin(months)
    return x.select("category", "month", R.seasonality_index("category", "month").cast("decimal(8,4)")
                    .alias("seasonality_index"))


@register("forecast_error", f"""
SELECT item_id, abc_class, xyz_class,
       CAST(round(mape, 4) AS DECIMAL(10,4)) AS forecast_error_mape, CAST(round(round(mape, 4) * 14.0, 4) AS DECIMAL(10,4)) AS forecast_error_mad
FROM (SELECT *, CASE abc_class WHEN 'A' THEN 0.05 WHEN 'B' THEN 0.10 ELSE 0.18 END
               * CASE xyz_class WHEN 'X' THEN 0.8 WHEN 'Y' THEN 1.2 ELSE 1.8 END * 1.05 AS mape
      FROM ({define_abc}) a) b""")
def q_forecast_error(t):
    a = abc_xyz(t)
    mape, mad = R.forecast_error("abc_class", "xyz_class")
    return a.select("item_id", "abc_class", "xyz_class", mape.cast("decimal(10,4)").alias("forecast_error_mape"),
                    mad.cast("decimal(10,4)").alias("forecast_error_mad"))


# ---- B16
_TZ_SQL = ("CASE " + " ".join("WHEN state IN (" + ", ".join(f"'{s}'" for s in sts) + f") THEN '{z}'"
                             for z, sts in C.TIME_ZONES.items()) + f" ELSE '{C.DEFAULT_TIME_ZONE}' END")


@register("dc_time_zone", f"SELECT dc_id, state, {_TZ_SQL} AS time_zone FROM v_dcs")
def q_dc_time_zone(t):
    return t.v_dcs.select("dc_id", "state", R.time_zone("state").alias("time_zone"))


# ---- B17
@register("format_codes", """
SELECT o.order_id, printf('INV-%08d', o.order_id) AS invoice_number,
       printf('PO-%03d-%08d', o.dc_id, o.order_id) AS po_number,
       printf('PROMO-%d-%04d', year(o.order_date), o.order_id) AS promo_code,
       CASE WHEN c.is_sub THEN printf('S%06d', c.customer_id) ELSE printf('M%06d', c.master_id) END AS account_number,
       upper(substr(v.vendor_name, 1, 3)) || '-' || printf('%06d', o.order_id) AS vendor_item_number,
       CAST(o.order_id AS VARCHAR) || '-C1' AS first_carton
FROM v_orders o LEFT JOIN v_customers c ON o.customer_id = c.customer_id
LEFT JOIN v_vendors v ON v.vendor_id = o.customer_id % (SELECT count(*) FROM v_vendors)""")
def q_format_codes(t):
    # an order's vendor: the customer's number modulo the vendors there are
    n = t.v_vendors.agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("_vendors"))
    o = (t.v_orders.join(t.v_customers.select("customer_id", "master_id", "is_sub"), "customer_id", "left")
         .crossJoin(n).withColumn("_vendor", F.col("customer_id") % F.col("_vendors"))
         .join(t.v_vendors, F.col("vendor_id") == F.col("_vendor"), "left"))
    return o.select(
        "order_id", R.invoice_number("order_id").alias("invoice_number"),
        R.po_number("dc_id", "order_id").alias("po_number"),
        R.promo_code(F.year("order_date"), F.col("order_id")).alias("promo_code"),
        F.when(F.col("is_sub"), R.account_number("S", "customer_id"))
        .otherwise(R.account_number("M", "master_id")).alias("account_number"),
        R.vendor_item_number("vendor_name", F.col("order_id")).alias("vendor_item_number"),
        R.carton_code("order_id", F.lit(1)).alias("first_carton"))


# ---- B18
@register("normalize_timestamps", """
SELECT event_id, strftime(CASE WHEN (month(ts) = 3 AND day(ts) BETWEEN 8 AND 14 AND dayofweek(ts) = 0 AND hour(ts) = 2)
                                  OR (month(ts) = 11 AND day(ts) BETWEEN 1 AND 7 AND dayofweek(ts) = 0 AND hour(ts) = 1)
                             THEN ts + INTERVAL 1 HOUR ELSE ts END, '%Y-%m-%d %H:%M:%S') AS ts_text
FROM events""")
def q_normalize_timestamps(t):
    return t.events.select("event_id", R.normalize_timestamp(F.col("ts")).alias("ts_text"))


# ---- B19
@register("invoice_tax", f"""
SELECT o.order_id, CAST(CASE WHEN upper(coalesce(c.tax_exempt_flag, 'N')) = 'Y' THEN 0.0 ELSE {C.DEFAULT_TAX_RATE} END AS DECIMAL(4,2)) AS tax_rate
FROM v_orders o LEFT JOIN v_customers c ON o.customer_id = c.customer_id""")
def q_invoice_tax(t):
    j = t.v_orders.select("order_id", "customer_id").join(
        t.v_customers.select("customer_id", "tax_exempt_flag"), "customer_id", "left")
    return j.select("order_id", R.tax_rate("tax_exempt_flag").cast("decimal(4,2)").alias("tax_rate"))


# ---- B20
@register("payment_terms_due_date", """
SELECT order_id, payment_terms, invoice_date, due_date, discount_amount FROM x_invoices""")
def q_payment_terms_due_date(t):
    from depot.registry.tables import invoices
    return invoices(t).select("order_id", "payment_terms", "invoice_date", "due_date", "discount_amount")


# ---- B21
@register("aging_bucket", f"""
SELECT invoice_id, CAST(dpd AS INTEGER) AS days_past_due,
       CASE WHEN dpd = 0 THEN 'Current' WHEN dpd BETWEEN 1 AND 30 THEN '1-30' WHEN dpd BETWEEN 31 AND 60 THEN '31-60'
            WHEN dpd BETWEEN 61 AND 90 THEN '61-90' WHEN dpd BETWEEN 91 AND 9999 THEN '90+' ELSE 'Unknown' END AS aging_bucket
FROM (SELECT i.invoice_id, CASE WHEN i.total_amount * (1 - coalesce(p.paid_ratio, 0)) <= 0 THEN 0
                                ELSE greatest(0, DATE '{C.AS_OF.isoformat()}' - i.due_date) END AS dpd
      FROM x_invoices i LEFT JOIN v_payments p ON i.invoice_id = p.invoice_id) x""")
def q_aging_bucket(t):
    from depot.registry.tables import invoices
    j = invoices(t).join(t.v_payments, "invoice_id", "left")
    bal = F.col("total_amount") * (F.lit(1) - F.coalesce("paid_ratio", F.lit(0.0)))
    j = j.select("invoice_id", R.days_past_due(F.lit(C.AS_OF), F.col("due_date"), bal).alias("days_past_due"))
    return j.select("invoice_id", "days_past_due", R.aging_bucket("days_past_due").alias("aging_bucket"))


# ---- B22
@register("return_credit", """
SELECT r.order_line_id, r.condition_code,
       CAST(round(CAST(l.unit_price AS DECIMAL(12,2)) * r.qty_returned
                  * CAST(CASE r.condition_code WHEN 'Resalable' THEN 1.00 WHEN 'Damaged' THEN 0.50
                              WHEN 'Defective' THEN 0.25 WHEN 'Destroyed' THEN 0.00 END AS DECIMAL(4,2)), 2) AS DECIMAL(14,2)) AS credit_amount,
       r.condition_code = 'Resalable' AS restock_flag
FROM v_returned_lines r JOIN v_lines l ON r.order_line_id = l.order_line_id""")
def q_return_credit(t):
    j = t.v_returned_lines.join(t.v_lines.select("order_line_id", "unit_price"), "order_line_id")
    return j.select("order_line_id", "condition_code",
                    R.return_credit("unit_price", "qty_returned", "condition_code").alias("credit_amount"),
                    R.restock_flag("condition_code").alias("restock_flag"))


# ---- B23, B24
@register("slotting_rank", f"""
SELECT item_id, greatest(1, CAST(trunc(100 - {_VELOCITY_SQL}
                                        + coalesce(nullif(CAST(cube_ft AS DOUBLE), 0.0), 0.1) * 10
                                        + coalesce(nullif(CAST(weight_lb AS DOUBLE), 0.0), 1.0) * 0.5) AS INT)) AS slotting_rank
FROM v_items""")
def q_slotting_rank(t):
    i = t.v_items.select("item_id", "cube_ft", "weight_lb", R.price_velocity("unit_price").alias("v"))
    return i.select("item_id", R.slotting_rank("v", "cube_ft", "weight_lb").alias("slotting_rank"))


@register("location_code", """
SELECT item_id, code AS location_code,
       CAST(regexp_extract(code, '^A(\\d+)-B(\\d+)-L(\\d+)$', 1) AS INT) AS aisle,
       CAST(regexp_extract(code, '^A(\\d+)-B(\\d+)-L(\\d+)$', 2) AS INT) AS bay,
       CAST(regexp_extract(code, '^A(\\d+)-B(\\d+)-L(\\d+)$', 3) AS INT) AS level
FROM (SELECT item_id, printf('A%02d-B%02d-L%02d', item_id % 40 + 1, (item_id // 40) % 30 + 1, (item_id // 1200) % 6 + 1) AS code
      FROM v_items) x""")
def q_location_code(t):
    i = t.v_items.select("item_id", R.location_code(F.col("item_id") % 40 + 1,
                                                    F.floor(F.col("item_id") / 40) % 30 + 1,
                                                    F.floor(F.col("item_id") / 1200) % 6 + 1).alias("location_code"))
    parts = R.split_location("location_code")
    return i.select("item_id", "location_code", *[v.alias(k) for k, v in parts.items()])


# ---- B31
@register("shipment_dates", """
SELECT order_id, order_date + CAST(order_id % 4 AS INT) AS ship_date,
       order_date + CAST(order_id % 4 + order_id % 7 + 1 AS INT) AS promised_date,
       order_date + CAST(order_id % 4 + order_id % 7 + 1 + order_id % 5 - 2 AS INT) AS delivery_date
FROM v_orders""")
def q_shipment_dates(t):
    o = t.v_orders
    d = R.shipment_dates("order_date", F.col("order_id") % 4, F.col("order_id") % 7 + 1, F.col("order_id") % 5 - 2)
    return o.select("order_id", *[v.alias(k) for k, v in d.items()])


# ---- B33
@register("contact_role", """
SELECT customer_id, CASE WHEN segment IN ('Government', 'Education') THEN 'CS Rep'
                         WHEN is_sub THEN 'Inside Sales' ELSE 'Account Manager' END AS role
FROM v_customers""")
def q_contact_role(t):
    return t.v_customers.select("customer_id", R.contact_role("segment", "is_sub").alias("role"))
