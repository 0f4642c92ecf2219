"""Stock tables: current inventory, monthly snapshots, slotting, adjustments,
backorders and purchase orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from depot import config as C
from depot.functions import rules as R
from depot.operators.keys import dense_keys
from depot.session import stored


def build_inventory(lines: DataFrame, orders: DataFrame, items: DataFrame,
                    region_factor: float = 1.015, dc_factor: float = 1.0, last_factor: float = 1.005) -> DataFrame:
    """Current DC-item stock as aggregates of the order lines.

    on hand = units moved; on order = units of open or backordered orders;
    last restock = last ship date; vendor = vendor of the latest line;
    std/last/avg cost from the item cost (B28); reorder point = monthly
    demand clipped to 5..50."""
    j = (lines.select("order_id", "item_id", "vendor_id", "quantity_ordered", "line_ship_date")
         .join(orders.select("order_id", "dc_id", "order_status"), "order_id"))
    open_qty = F.when(F.col("order_status").isin("Open", "Backordered"), F.col("quantity_ordered")).otherwise(0)
    agg = j.groupBy("dc_id", "item_id").agg(
        F.sum("quantity_ordered").cast("long").alias("qty_on_hand"),
        F.sum(open_qty).cast("long").alias("qty_on_order"),
        F.max(F.struct("line_ship_date", "vendor_id")).alias("_last"))
    costs = items.select("item_id", "unit_cost")
    uc = F.col("unit_cost").cast("decimal(12,2)")
    std = uc * F.lit(region_factor * dc_factor).cast("decimal(10,6)")
    last = std * F.lit(last_factor).cast("decimal(10,6)")
    return (agg.join(costs, "item_id", "left")
            .select("dc_id", "item_id", "qty_on_hand", "qty_on_order",
                    F.round(std, 2).cast("decimal(12,2)").alias("std_cost"),
                    F.round(last, 2).cast("decimal(12,2)").alias("last_cost"),
                    F.round((std + last) * F.lit(0.5).cast("decimal(2,1)"), 2).cast("decimal(12,2)").alias("avg_cost"),
                    F.least(F.lit(50), F.greatest(F.lit(5), (F.col("qty_on_hand") / 12).cast("int"))).alias("reorder_point"),
                    F.format_string("A%d-%d-%d", F.col("item_id") % 50 + 1, F.col("dc_id") % 20 + 1,
                                    (F.col("item_id") + F.col("dc_id")) % 10 + 1).alias("stocking_location"),
                    F.col("_last.vendor_id").alias("vendor_id"), F.col("_last.line_ship_date").alias("last_restock_date")))



# ---------------------------------------------------------------- I8
BACKORDER_REASONS = C.BACKORDER_REASONS


def build_backorders(lines: DataFrame, orders: DataFrame, stock: DataFrame, items: DataFrame, as_of,
                     base_rate: float = 0.08, seed: int = 42) -> DataFrame:
    """Backorders (I8): shortage = max(0, qty - int(mean available of the
    item)) (C3, D3, quirk Q18); a row for every line short of stock, with
    the backorder probability 0.08 + 0.6 x shortage ratio kept as a score;
    created on the order date (Q17); filled at created + lead time when that
    is on or before ``as_of``; reason by keyed draw."""
    from depot.functions.draws import keyed_uniform
    from depot.operators.joins import lookup
    avail = stock.groupBy("item_id").agg(
        F.avg(F.greatest(F.lit(0), F.col("qty_on_hand") - F.col("qty_on_order"))).cast("long").alias("avail"))
    j = (lines.select("order_line_id", "order_id", "item_id", "quantity_ordered")
         .join(orders.select("order_id", "order_date"), "order_id"))
    j = lookup(j, avail, "item_id", {"avail": 0})
    j = lookup(j, items.select("item_id", "lead_time_days"), "item_id", {"lead_time_days": 7})
    short = F.greatest(F.lit(0), F.col("quantity_ordered") - F.col("avail"))
    j = j.withColumn("qty_backordered", short).filter(F.col("qty_backordered") > 0)
    prob = F.lit(base_rate) + F.col("qty_backordered") / F.col("quantity_ordered") * 0.6
    fill = F.date_add("order_date", F.col("lead_time_days").cast("int"))
    filled = fill <= F.lit(as_of)
    u = keyed_uniform(seed, "bo_reason", "order_line_id")
    reason = F.element_at(F.array(*[F.lit(r) for r in BACKORDER_REASONS]),
                          (F.floor(u * len(BACKORDER_REASONS)) + 1).cast("int"))
    out = j.select("order_id", "order_line_id", "item_id", F.col("qty_backordered").cast("int").alias("qty_backordered"),
                   F.round(prob, 4).cast("decimal(6,4)").alias("backorder_probability"),
                   F.col("order_date").alias("date_created"),
                   F.when(filled, fill).alias("date_filled"),
                   F.when(filled, F.col("lead_time_days").cast("int")).alias("days_backordered"),
                   reason.alias("reason_code"), filled.alias("is_filled_flag"))
    return dense_keys(out, ["order_line_id"], "backorder_id")


# ---------------------------------------------------------------- I10
def vendor_fill_rates(lines: DataFrame) -> DataFrame:
    """Measured fill rate per vendor: share of its lines not returned,
    cleaned to [0.5, 1.0] with default 0.9 (B2)."""
    r = lines.groupBy("vendor_id").agg(F.avg(F.when(F.col("return_flag") == "R", 0.0).otherwise(1.0)).alias("_fr"))
    return r.select("vendor_id", R.coerce_numeric(F.round("_fr", 4), default=0.9, lo=0.5, hi=1.0).alias("fill_rate"))


def build_purchase_orders(stock: DataFrame, items: DataFrame, status: DataFrame | None, vendor_cost: DataFrame,
                          fill_rates: DataFrame, partial_multiplier: float = 0.675, with_ids: bool = True) -> DataFrame:
    """One purchase order per stock row with quantity on order (I10): cost
    fallback vendor-item cost -> last -> avg -> 0 (C4), lead time cleaned
    (default 7, at least 1), dates (B26), receipt quantity by status and
    fill rate (B27), numbered per DC (B17).  ``status``: None where the stock
    carries its ``po_status``."""
    from depot.operators.joins import first_non_null, lookup
    s = stock.filter(R.coerce_numeric(F.col("qty_on_order"), default=0, to="int") > 0)
    s = lookup(s, items.select("item_id", "lead_time_days"), "item_id")
    s = s.withColumn("lead_time_days", R.coerce_numeric(F.col("lead_time_days"), default=7, lo=1, to="int"))
    s = lookup(s, fill_rates, "vendor_id", {"fill_rate": 0.9})
    s = s.join(vendor_cost, ["vendor_id", "item_id"], "left")
    if status is not None:
        s = s.join(status, ["dc_id", "item_id"], "left")
    s = s.withColumn("unit_cost", first_non_null("vi_cost", "last_cost", "avg_cost", default=0).cast("decimal(12,2)"))
    offset = ((F.col("dc_id") + F.col("item_id")) % 7 - 2).cast("int")
    d = R.po_dates("last_restock_date", "lead_time_days", "po_status", offset_days=0)
    s = s.select("*", d["po_date"].alias("po_date"), d["expected_receipt_date"].alias("expected_receipt_date"),
                 F.when(F.col("po_status") == "Open", F.lit(None).cast("date"))
                 .otherwise(F.greatest(F.date_add(d["expected_receipt_date"], offset), d["po_date"]))
                 .alias("actual_receipt_date"))
    s = s.withColumn("qty_received", R.po_received_qty("po_status", F.col("qty_on_order").cast("int"), "fill_rate",
                                                       partial_multiplier))
    keyed = dense_keys(s, ["dc_id", "item_id"], "purchase_order_id") if with_ids else s
    ids = ["purchase_order_id", R.po_number("dc_id", "purchase_order_id").alias("po_number")] if with_ids else []
    return keyed.select(*ids, "vendor_id", "dc_id", "item_id", "po_date", "expected_receipt_date", "actual_receipt_date",
                        F.col("qty_on_order").cast("int").alias("qty_ordered"), "qty_received", "unit_cost",
                        "po_status")


# ---------------------------------------------------------------- I18
def build_inventory_snapshot(movements: DataFrame, items: DataFrame, abc: DataFrame, as_of, months_back: int = 12,
                             allocated_share: float = 0.15) -> DataFrame:
    """Month-end stock per DC, item and month for the ``months_back``
    months up to ``as_of`` (I18).  On hand = running sum of (in - out) over
    all earlier movements (floor 0); every pair that ever moved gets a row
    for every month of the window (C7 x H3); aging split (B29), availability
    and days on hand, excess and obsolete by lifecycle (B30), cycle-count
    accuracy by ABC class.  The movements are stored once; the running window is
    partitioned by DC-item, whose rows are one per month (bounded).  A month
    more needs no full run: see ``advance_balances`` and ``snapshot_month``."""
    from pyspark.sql import Window
    from depot.operators.expand import month_series
    end = F.trunc(F.lit(as_of), "month")
    movements = stored(movements, "movements")
    # ids: pairs are ranked once, each pair owns months_back consecutive ids
    pairs = dense_keys(movements.select("dc_id", "item_id").distinct(), ["dc_id", "item_id"], "_prank")
    grid = pairs.select("dc_id", "item_id", "_prank",
                        F.posexplode(month_series(F.add_months(end, -(months_back - 1)), months_back))
                        .alias("_mi", "month")).withColumn("_delta", F.lit(0).cast("long")).withColumn("_grid", F.lit(True))
    moves = movements.filter(F.col("month") <= end).select(
        "dc_id", "item_id", F.lit(None).cast("long").alias("_prank"), F.lit(None).cast("int").alias("_mi"), "month",
        (F.col("qty_in") - F.col("qty_out")).alias("_delta"), F.lit(False).alias("_grid"))
    w = Window.partitionBy("dc_id", "item_id").orderBy("month", "_grid").rowsBetween(Window.unboundedPreceding, 0)
    bal = (grid.unionByName(moves).withColumn("_bal", F.sum("_delta").over(w))
           .filter(F.col("_grid")).select("dc_id", "item_id", F.col("month").alias("snapshot_month"),
                                          ((F.col("_prank") - 1) * months_back + F.col("_mi") + 1).alias("snapshot_id"),
                                          F.col("_bal").alias("balance")))
    return _snapshot_rows(bal, items, abc, allocated_share, ("snapshot_id",))


def advance_balances(last: DataFrame | None, movements: DataFrame, month) -> DataFrame:
    """Month-end balances (dc_id, item_id, balance) from those of the month
    before and the movements of ``month`` alone.  ``last`` None: from the
    beginning, by all movements up to ``month``."""
    at = F.trunc(F.lit(month), "month")
    moves = movements.filter((F.col("month") <= at) if last is None else (F.col("month") == at)) \
        .select("dc_id", "item_id", (F.col("qty_in") - F.col("qty_out")).alias("balance"))
    both = moves if last is None else last.select("dc_id", "item_id", "balance").unionByName(moves)
    return both.groupBy("dc_id", "item_id").agg(F.sum("balance").cast("long").alias("balance"))


def snapshot_month(balances: DataFrame, items: DataFrame, abc: DataFrame, month, allocated_share: float = 0.15) -> DataFrame:
    """The snapshot rows of one month (without ids) from its balances: those of
    the full run for every pair that has moved by then."""
    return _snapshot_rows(balances.withColumn("snapshot_month", F.trunc(F.lit(month), "month")), items, abc, allocated_share)


def _snapshot_rows(bal: DataFrame, items: DataFrame, abc: DataFrame, allocated_share: float, ids: tuple[str, ...] = ()) -> DataFrame:
    bal = bal.withColumn("quantity_on_hand", F.greatest(F.lit(0), F.col("balance")).cast("long")).drop("balance")
    it = items.select("item_id", R.price_velocity("unit_price").alias("_vel"),
                      R.lifecycle_stage("item_id").alias("_life")).join(abc.select("item_id", "abc_class"),
                                                                           "item_id", "left")
    b = bal.join(it, "item_id", "left").withColumn(
        "quantity_allocated", (F.col("quantity_on_hand") * allocated_share).cast("long"))
    health = R.stock_health("quantity_on_hand", "quantity_allocated", "_vel", "_life")
    aging = R.aging_split("quantity_on_hand")
    acc = R.map_lookup(R.CYCLE_COUNT_ACCURACY, F.coalesce(F.col("abc_class"), F.lit("C")))
    return b.select(*ids, "dc_id", "item_id", "snapshot_month", "quantity_on_hand", "quantity_allocated",
                   health["quantity_available"].alias("quantity_available"),
                   health["days_on_hand"].alias("days_on_hand"),
                   health["excess_quantity"].alias("excess_quantity"),
                   health["obsolete_quantity"].alias("obsolete_quantity"),
                   *[v.cast("long").alias(k) for k, v in aging.items()],
                   acc.cast("decimal(4,2)").alias("cycle_count_accuracy"))


# ---------------------------------------------------------------- I20
def build_slotting(dcs: DataFrame, items: DataFrame, pick_share_b: float = 0.6, seed: int = 42,
                   stock: DataFrame | None = None) -> DataFrame:
    """Slotting for every DC-item pair (I20): price velocity (B7) and class
    (B8), rank (B23); locations handed out in rank order within each DC
    (B24): A items get a pick and a reserve slot, B items a pick slot with
    probability ``pick_share_b`` (keyed draw), C items reserve only.

    Ids follow (DC, item).  All ranking runs over the item table and over the
    DCs, never over their product: a DC that is given m times holds each item m
    times in a row, so its k-th copy has place (item's place) x m + k, and the
    id is that of the DC's first row plus (item's rank) x m + k.

    ``stock``: the (dc_id, item_id) pairs to slot instead; one ranking by (DC,
    slotting rank, item) is then the id, and minus the DC's first rank the place."""
    from depot.functions.draws import keyed_uniform
    it = items.select("item_id", "cube_ft", "weight_lb", R.price_velocity("unit_price").alias("velocity"))
    it = it.select("item_id", R.slotting_rank("velocity", "cube_ft", "weight_lb").alias("slotting_rank"), R.velocity_class("velocity").alias("velocity_class"))
    if stock is None:
        it = dense_keys(it, ["slotting_rank", "item_id"], "_pos", start=0)
        it = dense_keys(it, ["item_id"], "_irank", start=0)
        same_dc = Window.partitionBy("dc_id")                                   # a handful of rows: copies of a DC
        d = dense_keys(dcs.select("dc_id"), ["dc_id"], "_drank", start=0)
        d = d.select("dc_id", F.min("_drank").over(same_dc).alias("_before"), F.count(F.lit(1)).over(same_dc).alias("_m"),
                     (F.col("_drank") - F.min("_drank").over(same_dc)).alias("_k"))
        n_items = items.agg(F.count(F.lit(1)).alias("_n"))
        placed = it.crossJoin(F.broadcast(d.crossJoin(n_items)))                 # every DC slots every item
        placed = placed.withColumn("slotting_id", F.col("_before") * F.col("_n") + F.col("_irank") * F.col("_m") + F.col("_k") + 1)
        p = F.col("_pos") * F.col("_m") + F.col("_k")
    else:
        pairs = stock.select("dc_id", "item_id").distinct().join(it, "item_id")
        ranked = dense_keys(pairs.select("dc_id", "item_id", "slotting_rank", "velocity_class"), ["dc_id", "slotting_rank", "item_id"], "slotting_id")
        placed = ranked.join(ranked.groupBy("dc_id").agg(F.min("slotting_id").alias("_first")), "dc_id")
        p = F.col("slotting_id") - F.col("_first")
    # as many aisles as the items need: a location is never handed out twice
    pick_code = R.location_code(F.floor(p / 180) + 1, F.floor(p / 6) % 30 + 1, p % 6 + 1)
    repl_code = R.location_code(F.floor(p / 300) + 1, F.floor(p / 10) % 30 + 1, p % 10 + 1)
    u = keyed_uniform(seed, "pick", "dc_id", "item_id")
    has_pick = (F.col("velocity_class") == "A") | ((F.col("velocity_class") == "B") & (u < pick_share_b))
    return placed.select("slotting_id", "dc_id", "item_id", F.when(has_pick, pick_code).alias("pick_location"),
                         repl_code.alias("replenishment_location"), "slotting_rank", "velocity_class")


# ---------------------------------------------------------------- I21
def adjustment_report(adjustments: DataFrame, items: DataFrame, reasons: dict) -> DataFrame:
    """Adjustment log by DC, type and reason (I21): count, net quantity,
    last time, quantity as a share of item velocity, and whether the reason
    belongs to the type (``array_contains`` over a literal type->reasons map)."""
    m = F.create_map(*[x for k, v in reasons.items() for x in (F.lit(k), F.array(*[F.lit(r) for r in v]))])
    valid = F.coalesce(F.array_contains(m[F.col("adjustment_type")], F.col("reason_code")), F.lit(False))
    a = (adjustments.join(items.select("item_id", R.price_velocity("unit_price").alias("_vel")), "item_id", "left")
         .withColumn("reason_valid", valid))
    return a.groupBy("dc_id", "adjustment_type", "reason_code", "reason_valid").agg(
        F.count(F.lit(1)).alias("n_adjustments"),
        F.sum("quantity").cast("long").alias("net_quantity"),
        F.max("adjustment_timestamp").alias("last_adjustment"),
        F.round(F.sum("quantity") / F.sum(F.coalesce("_vel", F.lit(1))), 4).cast("decimal(12,4)")
        .alias("share_of_velocity"))
