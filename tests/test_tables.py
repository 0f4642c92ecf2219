"""Invariants of the composite tables on the smallest fixture."""

from pyspark.sql import functions as F

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def q(spark, name):
    return E.queries()[name](spark, SF)


def test_tracking_ids_continue_over_chunks(spark):
    """Two chunks of two shipments give 16 events with ids exactly 1..16."""
    import datetime as dt
    from depot.plans.fulfillment import build_tracking_events
    ships = spark.createDataFrame([(i, dt.date(2025, 1, 1), 1) for i in range(1, 5)],
                                  "shipment_id long, ship_date date, dc_id long")
    dcs = spark.createDataFrame([(1, "Dallas", "TX", "75001")], "dc_id long, city string, state string, zip string")
    a = build_tracking_events(ships.filter("shipment_id <= 2"), dcs, start_id=1)
    b = build_tracking_events(ships.filter("shipment_id > 2"), dcs, start_id=9)
    ids = sorted(r.tracking_event_id for r in a.unionByName(b).collect())
    assert ids == list(range(1, 17))


def test_invoice_total_identity(spark):
    bad = q(spark, "build_invoices").filter(
        F.col("total_amount") != F.col("merchandise_total") + F.col("freight_billed") + F.col("tax_amount")
        - F.col("discount_amount"))
    assert bad.count() == 0


def test_ar_paid_plus_balance(spark):
    bad = q(spark, "build_ar_ledger").filter(F.col("amount_paid") + F.col("balance") != F.col("amount_due"))
    assert bad.count() == 0


def test_po_received_le_ordered(spark):
    assert q(spark, "build_purchase_orders").filter(F.col("qty_received") > F.col("qty_ordered")).count() == 0


def test_returns_quantity_bounds(spark):
    r = q(spark, "build_returns").join(E.queries()["build_order_lines"](spark, SF).select(
        "order_line_id", "quantity_ordered"), "order_line_id")
    assert r.filter((F.col("qty_returned") < 1) | (F.col("qty_returned") > F.col("quantity_ordered"))).count() == 0


def test_snapshot_aging_sums(spark):
    s = q(spark, "build_inventory_snapshot")
    bad = s.filter(F.col("aging_0_30") + F.col("aging_31_60") + F.col("aging_61_90") + F.col("aging_90_plus")
                   != F.col("quantity_on_hand"))
    assert bad.count() == 0


def test_sequential_ids_ok(spark):
    assert all(r.ok for r in q(spark, "check_sequential_ids").collect())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"dc_id", "aging_bucket", "n_invoices", "amount_due", "balance", "shipping_cost"}


def test_every_query_has_oracle():
    from depot import registry
    assert set(registry.queries()) == set(registry.oracle_sql())


def test_a_view_stands_after_the_views_it_reads():
    """Whichever module defined it first."""
    from depot.sources.adapter_sql import with_views
    sql = with_views("SELECT * FROM x_late", {"x_late": "SELECT * FROM x_mid JOIN x_base", "x_mid": "SELECT * FROM x_base", "x_base": "SELECT 1 AS a"})
    assert sql.index("x_base AS (") < sql.index("x_mid AS (") < sql.index("x_late AS (")


def test_scorecard_meets_lines_and_orders_once_for_each_part(tables):
    """Stock and returned lines are each joined once: no second stock for the
    status of the purchase orders, no lines again for the vendor of a return."""
    from depot.registry.tables import scorecard
    plan = scorecard(tables)._jdf.queryExecution().optimizedPlan().toString()
    reads = [x.split("[")[1] for x in plan.splitlines() if "Relation [" in x]
    assert sum("o_orderkey" in x for x in reads) == 3           # stock, complete orders, shipments
    assert sum("_place" in x for x in reads) == 3               # eligible and returned lines, lines of a vendor


def test_scorecard_with_or_without_carried_vendors(spark):
    from depot.plans.vendors import vendor_scorecard
    vendors = spark.createDataFrame([(1,), (2,), (3,)], "vendor_id long")
    lines = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (4, None)], "order_line_id long, vendor_id long")
    back = spark.createDataFrame([(1, "Damaged"), (2, "Resalable"), (3, "Defective"), (4, "Damaged")], "order_line_id long, condition_code string")
    po = spark.createDataFrame([(1, "Received", None, None, 1, 2)], "vendor_id long, po_status string, actual_receipt_date date, "
                               "expected_receipt_date date, qty_received int, qty_ordered int")
    plain = vendor_scorecard(vendors, po, back, lines)
    carried = vendor_scorecard(vendors, po, back.join(lines, "order_line_id"), lines)
    assert sorted(plain.collect()) == sorted(carried.collect())
    assert {r.vendor_id: r.defect_rate and float(r.defect_rate) for r in carried.collect()} == {1: 0.5, 2: 1.0, 3: None}


def test_stock_carries_its_last_line(spark):
    from depot.plans.inventory import build_inventory
    lines = spark.sql("""SELECT * FROM VALUES (1L, 7L, 5L, 1, DATE '2020-01-01'), (1L, 7L, 4L, 1, DATE '2020-02-01'), (1L, 7L, 9L, 1, NULL),
                         (1L, NULL, 3L, 1, NULL) AS t (order_id, item_id, vendor_id, quantity_ordered, line_ship_date)""")
    orders = spark.sql("SELECT 1L AS order_id, 2L AS dc_id, 'Open' AS order_status")
    items = spark.sql("SELECT 7L AS item_id, CAST(2 AS DECIMAL(12,2)) AS unit_cost")
    got = {r.item_id: (r.vendor_id, str(r.last_restock_date)) for r in build_inventory(lines, orders, items).collect()}
    assert got == {7: (4, "2020-02-01"), None: (3, "None")}


def test_items_given_twice_give_the_purchase_orders_of_a_joined_status(spark):
    from types import SimpleNamespace
    from depot.plans import inventory as INV
    from depot.registry.joins import vendor_item_cost
    from depot.registry.tables import purchase_orders
    from depot.sources.tables import po_status
    lines = spark.sql("""SELECT * FROM VALUES (1L, 7L, 5L, 2, DATE '2020-01-01'), (1L, 8L, 4L, 3, DATE '2020-02-01'), (1L, 9L, 4L, 3, DATE '2020-02-01'),
                         (1L, NULL, 3L, 1, DATE '2020-02-01') AS t (order_id, item_id, vendor_id, quantity_ordered, line_ship_date)""")
    lines = lines.selectExpr("*", "'N' AS return_flag", "CAST(3 AS DECIMAL(16,2)) AS unit_price")
    orders = spark.sql("SELECT 1L AS order_id, 2L AS dc_id, 'Open' AS order_status")
    items = spark.sql("SELECT id AS item_id, CAST(2 AS DECIMAL(12,2)) AS unit_cost, 5 AS lead_time_days FROM VALUES 7L, 8L, 8L AS t (id)")
    stock = INV.build_inventory(lines, orders, items)
    t = SimpleNamespace(v_stock=stock, v_items=items, v_lines_noid=lines)
    joined = INV.build_purchase_orders(stock, items, stock.select("dc_id", "item_id", po_status()), vendor_item_cost(t),
                                       INV.vendor_fill_rates(lines), with_ids=False)
    got = purchase_orders(t, False)
    assert got.count() == 1 + 8 + 1 + 1
    assert sorted(map(str, got.collect())) == sorted(map(str, joined.collect()))
