"""Order-to-cash tables: priced lines, shipments, shipment lines, tracking,
invoices, receivables.  Each ``build_*`` takes DataFrames and returns a lazy
DataFrame; nothing is collected.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depot import config as C
from depot.functions import rules as R
from depot.functions.draws import keyed_uniform
from depot.operators.keys import dense_keys

# ---------------------------------------------------------------- I1
def build_order_lines(lines: DataFrame, orders: DataFrame, customers: DataFrame,
                      items: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Priced order lines: list price x (1 - customer discount %), 2 dp;
    extended = unrounded price x qty, 2 dp.  Missing customer -> no discount.
    ``carry`` names item columns to keep on the line, so that a later step
    need not join the items again."""
    disc = customers.select("customer_id", F.col("discount_percentage").cast("decimal(5,2)").alias("_d"))
    factor = F.greatest(F.lit(0).cast("decimal(5,4)"),
                        F.lit(1).cast("decimal(5,4)") - F.coalesce(F.col("_d"), F.lit(0).cast("decimal(5,2)"))
                        * F.lit(0.01).cast("decimal(3,2)"))
    price = F.col("list_price") * factor
    ids = ["order_line_id"] if "order_line_id" in lines.columns else []   # ids only when given
    return (lines.select(*ids, "order_id", "item_id", "quantity_ordered")
            .join(orders.select("order_id", "customer_id"), "order_id", "left")
            .join(disc, "customer_id", "left")
            .join(items.select("item_id", F.col("unit_price").alias("list_price"), *carry), "item_id", "left")
            .select(*ids, *carry, "order_id", "item_id", "quantity_ordered",
                    F.col("quantity_ordered").alias("quantity_shipped"),
                    F.round(price, 2).cast("decimal(12,2)").alias("unit_price"),
                    F.round(price * F.col("quantity_ordered"), 2).cast("decimal(14,2)").alias("extended_price")))


# ---------------------------------------------------------------- I2
def build_shipment_lines(shipments: DataFrame, lines: DataFrame, items: DataFrame,
                         carriers: DataFrame, orders: DataFrame,
                         upcharge_weight: float = C.UPCHARGE_WEIGHT_LB,
                         upcharge: float = C.UPCHARGE_AMOUNT, start_id=1, with_ids: bool = True) -> DataFrame:
    """One shipment line per order line of each shipment.
    Without ``with_ids`` there is no ranking pass, and no ``shipment_line_id``
    or ``carton_number``; the other columns are the same."""
    base = (lines.select("order_line_id", "order_id", "item_id", "quantity_ordered")
            .join(shipments.select("shipment_id", "order_id", "dc_id", "carrier_id", "shipment_type"),
                  "order_id")
            .join(orders.select("order_id", "customer_id"), "order_id", "left")
            .join(items.select("item_id", "weight_lb", F.col("cube_ft").cast("decimal(12,4)").alias("cube_ft")),
                  "item_id", "left")
            .join(carriers.select("carrier_id", "carrier_type"), "carrier_id", "left"))
    # one global rank serves as the line id and, minus the order's first
    # rank, as the carton sequence within the order; the ranked rows are
    # stored, so the rollups below do not run the joins again
    keyed = dense_keys(base, ["order_id", "order_line_id", "shipment_id"], "shipment_line_id", start=start_id) if with_ids else base
    per_ship = keyed.groupBy("shipment_id").agg(
        F.sum(F.col("weight_lb") * F.col("quantity_ordered")).alias("_ship_weight"),
        F.min("order_line_id").alias("_first_line"))
    ids, carton = [], []
    if with_ids:
        first = keyed.groupBy("order_id").agg(F.min("shipment_line_id").alias("_first_rank"))
        keyed = keyed.join(first, "order_id").withColumn("_carton_seq", F.col("shipment_line_id") - F.col("_first_rank") + 1)
        ids, carton = ["shipment_line_id"], [R.carton_code("order_id", "_carton_seq").alias("carton_number")]
    out = keyed.join(per_ship, "shipment_id", "left")
    heavy = (F.col("order_line_id") == F.col("_first_line")) & (F.col("_ship_weight") > upcharge_weight)
    return out.select(
        *ids, "shipment_id", "order_line_id", "item_id",
        F.col("quantity_ordered").alias("quantity_shipped"), *carton,
        F.round(F.col("weight_lb") * F.col("quantity_ordered"), 3).cast("decimal(14,3)").alias("line_weight_lb"),
        F.round(F.col("cube_ft") * F.col("quantity_ordered"), 4).cast("decimal(16,4)").alias("line_cube_ft"),
        F.when(heavy, F.lit(upcharge)).otherwise(F.lit(0.0)).cast("decimal(8,2)").alias("freight_upcharge"),
        F.lit("DC").alias("from_location_type"),
        F.col("dc_id").alias("from_location_id"),
        F.lit("customer").alias("to_location_type"),
        F.col("customer_id").alias("to_location_id"),
        ((F.col("carrier_type") == "courier") | (F.col("shipment_type") == "local")).alias("is_courier"))


# ---------------------------------------------------------------- D1, D2, I3
def shipment_totals(shipments: DataFrame, shipment_lines: DataFrame) -> DataFrame:
    """Total weight (3 dp) and cube (4 dp) per shipment; no lines -> 0."""
    t = shipment_lines.groupBy("shipment_id").agg(F.sum("line_weight_lb").alias("w"),
                                                  F.sum("line_cube_ft").alias("c"))
    return (shipments.select("shipment_id").join(t, "shipment_id", "left")
            .select("shipment_id",
                    F.round(F.coalesce("w", F.lit(0)), 3).cast("decimal(18,3)").alias("total_weight_lb"),
                    F.round(F.coalesce("c", F.lit(0)), 4).cast("decimal(18,4)").alias("total_cube_ft")))


def shipment_costs(shipments: DataFrame, shipment_lines: DataFrame, items: DataFrame,
                   actual_factor: float = 1.0) -> DataFrame:
    """Estimated cost = sum(shipping cost per unit x qty); actual = estimated x factor."""
    cost = (shipment_lines.select("shipment_id", "item_id", "quantity_shipped")
            .join(items.select("item_id", "shipping_cost_per_unit"), "item_id", "left")
            .groupBy("shipment_id")
            .agg(F.sum(F.coalesce(F.col("shipping_cost_per_unit"), F.lit(0)) * F.col("quantity_shipped"))
                 .alias("est")))
    est = F.coalesce(F.col("est"), F.lit(0))
    return (shipments.select("shipment_id").join(cost, "shipment_id", "left")
            .select("shipment_id", F.round(est, 2).cast("decimal(14,2)").alias("estimated_cost"),
                    F.round(est * F.lit(actual_factor), 2).cast("decimal(14,2)").alias("actual_cost")))


def build_shipments(shipments: DataFrame, shipment_lines: DataFrame, items: DataFrame,
                    actual_factor: float = 1.0) -> DataFrame:
    """Shipment headers with rolled-up weight, cube and cost (I3).  One pass
    over the lines computes all totals."""
    t = (shipment_lines.select("shipment_id", "item_id", "quantity_shipped", "line_weight_lb", "line_cube_ft")
         .join(items.select("item_id", "shipping_cost_per_unit"), "item_id", "left")
         .groupBy("shipment_id")
         .agg(F.sum("line_weight_lb").alias("w"), F.sum("line_cube_ft").alias("c"),
              F.sum(F.coalesce(F.col("shipping_cost_per_unit"), F.lit(0)) * F.col("quantity_shipped")).alias("est")))
    est = F.coalesce(F.col("est"), F.lit(0))
    return (shipments.join(t, "shipment_id", "left")
            .select(*shipments.columns,
                    F.round(F.coalesce("w", F.lit(0)), 3).cast("decimal(18,3)").alias("total_weight_lb"),
                    F.round(F.coalesce("c", F.lit(0)), 4).cast("decimal(18,4)").alias("total_cube_ft"),
                    F.round(est, 2).cast("decimal(14,2)").alias("estimated_cost"),
                    F.round(est * F.lit(actual_factor), 2).cast("decimal(14,2)").alias("actual_cost")))


# ---------------------------------------------------------------- H1, I4
MILESTONES = C.MILESTONES


def tracking_milestones(shipments: DataFrame, dcs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Four milestone rows per shipment at ship date + 0/6/12/18 h (H1);
    ``carry`` names shipment columns to keep."""
    steps = F.array(*[F.struct(F.lit(i).alias("k"), F.lit(h).alias("h"), F.lit(e).alias("event_type"),
                               F.lit(t).alias("location_type")) for i, h, e, t in MILESTONES])
    return (shipments.select("shipment_id", "dc_id", "ship_date", *carry)
            .join(dcs.select("dc_id", "city", "state", "zip"), "dc_id", "left")
            .select("*", F.explode(steps).alias("m"))
            .select(*carry, "shipment_id",
                    F.col("m.k").alias("milestone_seq"),
                    (F.col("ship_date").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("m.h")))
                    .alias("event_timestamp"),
                    F.col("m.event_type").alias("event_type"),
                    F.col("city").alias("location_city"), F.col("state").alias("location_state"),
                    F.col("zip").alias("location_zip"), F.col("m.location_type").alias("location_type")))


def build_tracking_events(shipments: DataFrame, dcs: DataFrame, start_id=1) -> DataFrame:
    """Milestone log with ids continuing from ``start_id`` (I4): ids are
    ranked over shipments (4 per shipment), then expanded."""
    ranked = dense_keys(shipments.select("shipment_id", "dc_id", "ship_date"), ["shipment_id"], "_srank")
    ev = tracking_milestones(ranked, dcs, ("_srank",))
    start = start_id if not isinstance(start_id, int) else F.lit(start_id)
    return ev.select(((F.col("_srank") - 1) * 4 + F.col("milestone_seq") + start).cast("long")
                     .alias("tracking_event_id"),
                     "shipment_id", "event_timestamp", "event_type", "location_city", "location_state",
                     "location_zip", "location_type")


# ---------------------------------------------------------------- D5, D6, I5
def invoice_merchandise(order_lines: DataFrame) -> DataFrame:
    """Per order: sum(qty x 2-dp unit price) (D5, quirk Q5)."""
    return order_lines.groupBy("order_id").agg(
        F.sum(F.col("quantity_ordered") * F.col("unit_price").cast("decimal(12,2)"))
        .cast("decimal(18,2)").alias("merchandise_total"))


def invoice_freight(order_lines: DataFrame, items: DataFrame, base: float = C.FREIGHT_BASE,
                    per_cuft: float = C.FREIGHT_PER_CUFT, per_50lb: float = C.FREIGHT_PER_50LB) -> DataFrame:
    """Per order: base + sum(cube x qty) x a + sum(weight x qty) / 50 x b, with
    missing dims 0.1 ft3 / 1 lb, 2 dp, at least 0 (D6)."""
    j = (order_lines.select("order_id", "item_id", "quantity_ordered")
         .join(items.select("item_id", "cube_ft", "weight_lb"), "item_id", "left"))
    cube = F.coalesce(F.col("cube_ft").cast("decimal(12,4)"), F.lit(C.FREIGHT_DEFAULT_CUBE).cast("decimal(12,4)"))
    wt = F.coalesce(F.col("weight_lb").cast("decimal(12,4)"), F.lit(C.FREIGHT_DEFAULT_WEIGHT).cast("decimal(12,4)"))
    agg = j.groupBy("order_id").agg(F.sum(cube * F.col("quantity_ordered")).alias("tc"),
                                    F.sum(wt * F.col("quantity_ordered")).alias("tw"))
    f = (F.lit(base).cast("decimal(8,2)") + F.col("tc") * F.lit(per_cuft).cast("decimal(8,4)")
         + F.col("tw") * F.lit(per_50lb / 50.0).cast("decimal(10,6)"))
    return agg.select("order_id", F.greatest(F.lit(0), F.round(f, 2)).cast("decimal(14,2)").alias("freight_billed"))


def order_totals(order_lines: DataFrame, items: DataFrame | None = None, base: float = C.FREIGHT_BASE,
                 per_cuft: float = C.FREIGHT_PER_CUFT, per_50lb: float = C.FREIGHT_PER_50LB, extra: dict | None = None) -> DataFrame:
    """Merchandise (D5) and freight (D6) per order, and any ``extra`` sums,
    in one aggregate pass.  Lines that carry ``cube_ft`` and ``weight_lb``
    need no items table."""
    j = order_lines
    if "cube_ft" not in j.columns:
        j = (j.select("order_id", "item_id", "quantity_ordered", "unit_price")
             .join(items.select("item_id", "cube_ft", "weight_lb"), "item_id", "left"))
    cube = F.coalesce(F.col("cube_ft").cast("decimal(12,4)"), F.lit(C.FREIGHT_DEFAULT_CUBE).cast("decimal(12,4)"))
    wt = F.coalesce(F.col("weight_lb").cast("decimal(12,4)"), F.lit(C.FREIGHT_DEFAULT_WEIGHT).cast("decimal(12,4)"))
    more = [c.alias(n) for n, c in (extra or {}).items()]
    agg = j.groupBy("order_id").agg(
        F.sum(F.col("quantity_ordered") * F.col("unit_price").cast("decimal(12,2)")).cast("decimal(18,2)")
        .alias("merchandise_total"),
        F.sum(cube * F.col("quantity_ordered")).alias("tc"), F.sum(wt * F.col("quantity_ordered")).alias("tw"), *more)
    f = (F.lit(base).cast("decimal(8,2)") + F.col("tc") * F.lit(per_cuft).cast("decimal(8,4)")
         + F.col("tw") * F.lit(per_50lb / 50.0).cast("decimal(10,6)"))
    return agg.select("order_id", "merchandise_total",
                      F.greatest(F.lit(0), F.round(f, 2)).cast("decimal(14,2)").alias("freight_billed"), *(extra or {}))


def payment_terms(order_id) -> dict:
    """Terms chosen by order key over the fixed list."""
    idx = F.pmod(F.col(order_id) if isinstance(order_id, str) else order_id, F.lit(len(C.PAYMENT_TERMS)))
    name = F.element_at(F.array(*[F.lit(t[0]) for t in C.PAYMENT_TERMS]), (idx + 1).cast("int"))
    days = F.element_at(F.array(*[F.lit(t[1]) for t in C.PAYMENT_TERMS]), (idx + 1).cast("int"))
    disc = F.element_at(F.array(*[F.lit(t[2]).cast("decimal(4,2)") for t in C.PAYMENT_TERMS]),
                        (idx + 1).cast("int"))
    return {"payment_terms": name, "terms_days": days, "early_pay_share": disc}


def build_invoices(orders: DataFrame, order_lines: DataFrame, customers: DataFrame, items: DataFrame | None = None,
                   seed: int = C.SEED, discount_taken_rate: float = C.DISCOUNT_TAKEN_RATE,
                   invoice_lag_days: int = C.INVOICE_LAG_DAYS, totals: DataFrame | None = None) -> DataFrame:
    """One invoice per order that has lines (C13): merchandise + freight + tax
    - early-pay discount, 2 dp (I5).  invoice_id = order_id.  ``totals``:
    order totals made before (columns beyond the two sums are kept)."""
    totals = order_totals(order_lines, items) if totals is None else totals
    kept = [c for c in totals.columns if c not in ("order_id", "merchandise_total", "freight_billed")]
    terms = payment_terms("order_id")
    taken = keyed_uniform(seed, "discount", "order_id") < discount_taken_rate
    base = (orders.select("order_id", "customer_id", "order_date")
            .join(totals, "order_id")           # semi-join effect: orders with lines only
            .join(customers.select("customer_id", "tax_exempt_flag"), "customer_id", "left"))
    tax = F.round((F.col("merchandise_total") + F.col("freight_billed"))
                  * R.tax_rate("tax_exempt_flag").cast("decimal(4,2)"), 2)
    disc = F.when(taken & (terms["early_pay_share"] > 0),
                  F.round(F.col("merchandise_total") * terms["early_pay_share"], 2)).otherwise(F.lit(0))
    inv_date = F.date_add("order_date", invoice_lag_days)
    out = base.select(
        F.col("order_id").alias("invoice_id"),
        R.invoice_number("order_id").alias("invoice_number"),
        "order_id", "customer_id",
        inv_date.alias("invoice_date"),
        F.date_add(inv_date, terms["terms_days"]).alias("due_date"),
        "merchandise_total", "freight_billed",
        tax.cast("decimal(14,2)").alias("tax_amount"),
        disc.cast("decimal(14,2)").alias("discount_amount"),
        terms["payment_terms"].alias("payment_terms"), *kept)
    return out.withColumn("total_amount", F.round(F.col("merchandise_total") + F.col("freight_billed")
                                                  + F.col("tax_amount") - F.col("discount_amount"), 2)
                          .cast("decimal(16,2)"))


# ---------------------------------------------------------------- I6, I7
def build_ar_ledger(invoices: DataFrame, payments: DataFrame, customers: DataFrame,
                    as_of: _dt.date = C.AS_OF, posting_lag_days: int = C.POSTING_LAG_DAYS,
                    default_risk: float = 0.5, carry: tuple[str, ...] = ()) -> DataFrame:
    """Receivables from invoices and *given* payments (paid_ratio per invoice).
    Rules in order: balance, aging at ``as_of``, hold candidate, write-off
    candidate (which zeroes the balance and resets aging)."""
    kept = [c for c in carry if c in invoices.columns]
    j = (invoices.select("invoice_id", "customer_id", "invoice_date", "due_date", "total_amount", *kept)
         .join(payments.select("invoice_id", "paid_ratio"), "invoice_id", "left")
         .join(customers.select("customer_id", "risk_score"), "customer_id", "left"))
    due = F.col("total_amount").cast("decimal(16,2)")
    paid0 = F.round(due * F.coalesce(F.col("paid_ratio"), F.lit(0.0)).cast("decimal(6,4)"), 2)
    j = j.withColumn("_paid0", paid0).withColumn("_bal0", due - F.col("_paid0"))
    dpd = R.days_past_due(F.lit(as_of), F.col("due_date"), F.col("_bal0"))
    j = j.withColumn("days_past_due", dpd)
    risk = F.coalesce(F.col("risk_score"), F.lit(default_risk))
    hold = (F.col("_bal0") > 0) & (risk > C.AR_HOLD_RISK) & (F.col("days_past_due") > C.AR_HOLD_DAYS)
    wo = ((F.col("_bal0") > 0) & (F.col("days_past_due") > C.AR_WRITE_OFF_DAYS)
          & (F.col("_bal0") < C.AR_WRITE_OFF_BALANCE))
    return j.select(
        F.col("invoice_id").alias("ar_entry_id"), "invoice_id", "customer_id",
        F.date_add("invoice_date", posting_lag_days).alias("posting_date"),
        due.alias("amount_due"),
        F.when(wo, due).otherwise(F.col("_paid0")).cast("decimal(16,2)").alias("amount_paid"),
        F.when(wo, F.lit(0)).otherwise(F.col("_bal0")).cast("decimal(16,2)").alias("balance"),
        F.when(wo, F.lit(0)).otherwise(F.col("days_past_due")).alias("days_past_due"),
        F.when(wo, F.lit("Current")).otherwise(R.aging_bucket("days_past_due")).alias("aging_bucket"),
        hold.alias("credit_hold_flag"),
        F.when(wo, F.lit("Small Balance Write-off")).alias("writeoff_reason"), *kept)


def ar_aging_summary(ledger: DataFrame) -> DataFrame:
    """Open balance by customer x aging bucket, pivoted (I7), with the
    balances beyond the last bucket as ``bal_unknown``, so that nothing is
    lost.  The pivot values are fixed: no extra pass to find them."""
    return (ledger.withColumn("aging_bucket", F.when(F.col("aging_bucket").isin(C.AGING_BUCKETS), F.col("aging_bucket")).otherwise("Unknown"))
            .groupBy("customer_id").pivot("aging_bucket", [*C.AGING_BUCKETS, "Unknown"])
            .agg(F.sum("balance").cast("decimal(18,2)"))
            .select("customer_id", *[F.coalesce(F.col(b), F.lit(0).cast("decimal(18,2)")).alias(
                "bal_" + b.replace("-", "_").replace("+", "_plus").lower()) for b in [*C.AGING_BUCKETS, "Unknown"]]))


# ---------------------------------------------------------------- I9
def build_returns(eligible: DataFrame, returned: DataFrame, min_days: int = 5, max_days: int = 45,
                  with_ids: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """Returns of complete, shipped lines flagged as returned (I9): return
    date = first ship date + 5..45 days (by key), quantity checked to
    1..qty, credit by condition (B22), restock flag; dense ids.  ``carry``
    names columns of the eligible lines to keep."""
    j = eligible.join(returned, "order_line_id")
    delay = (F.lit(min_days) + F.col("order_line_id") % (max_days - min_days + 1)).cast("int")
    qty = F.least(F.greatest(F.col("qty_returned"), F.lit(1)), F.greatest(F.col("quantity_ordered"), F.lit(1)))
    j = j.withColumn("qty_returned", qty.cast("int"))
    out = j.select("order_id", "order_line_id", "shipment_id", "item_id", "customer_id",
                   F.date_add("ship_date", delay).alias("return_date"), "reason_code", "condition_code",
                   "qty_returned", R.restock_flag("condition_code").alias("restock_flag"),
                   R.return_credit("unit_price", "qty_returned", "condition_code").alias("credit_amount"), *carry)
    return dense_keys(out, ["order_line_id"], "return_id") if with_ids else out
