"""Bucketed tables join without a shuffle; snapshots advance by a month; classes and slots at any size."""

import datetime as dt
import re

from pyspark.sql import functions as F

from depot import config as C
from depot.operators.aggregates import by_order
from depot.plans import inventory as INV
from depot.registry import tables as RT
from depot.registry.rules import abc_xyz
from depot.sources.tables import Tables

SF = "/root/testdata/sf0.001"


def test_loaded_tables_join_without_a_shuffle(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain, loaded = Tables(spark, SF), Tables(spark, SF).load(4)
        want = sorted(map(str, RT.flagship(plain).collect()))
        assert sorted(map(str, RT.flagship(loaded).collect())) == want

        def order_shuffles(t):
            j = by_order(t.v_lines_noid, t.v_orders, ["customer_id", "item_id"])
            plan = j._jdf.queryExecution().executedPlan().toString()
            return len(re.findall(r"Exchange hashpartitioning\(order_id", plan))

        assert order_shuffles(plain) == 2 and order_shuffles(loaded) == 0
        flagship = RT.flagship(loaded)._jdf.queryExecution().executedPlan().toString()
        first_join = flagship[flagship.rindex("SortMergeJoin [order_id"):]       # the lowest: lines with orders
        assert "Bucketed: true" in flagship and "Exchange hashpartitioning(order_id" not in first_join
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_adding_a_month_equals_the_full_run(tables):
    months = [dt.date(C.AS_OF.year, C.AS_OF.month, 1)]
    for _ in range(3):
        months.insert(0, (months[0] - dt.timedelta(days=1)).replace(day=1))
    moves, abc = tables.v_movements, abc_xyz(tables)
    full = INV.build_inventory_snapshot(moves, tables.v_items, abc, C.AS_OF, 4).drop("snapshot_id")
    balances = None
    for m in months:
        balances = INV.advance_balances(balances, moves, m)
        got = INV.snapshot_month(balances, tables.v_items, abc, m)
        want = full.filter(F.col("snapshot_month") == F.lit(m)).join(balances.select("dc_id", "item_id"), ["dc_id", "item_id"], "left_semi")
        assert got.count() == want.count() > 0 and got.exceptAll(want.select(*got.columns)).count() == 0
    later = full.filter(F.col("snapshot_month") == F.lit(months[-1])).join(balances, ["dc_id", "item_id"], "left_anti")
    assert later.filter("quantity_on_hand <> 0").count() == 0


def test_a_month_reads_only_its_own_movements(spark, tables):
    balances = spark.createDataFrame([(1, 1, 5)], "dc_id long, item_id long, balance long")
    plan = INV.advance_balances(balances, tables.v_movements, C.AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    assert "month" in plan and re.search(r"Filter .*month.* = ", plan)


def test_classes_do_not_depend_on_the_size(spark, tables):
    """The same lines ten times over give the same classes."""
    class Ten:
        v_lines_noid = tables.v_lines_noid.crossJoin(spark.range(10)).drop("id")

    one = {r.item_id: (r.abc_class, r.xyz_class) for r in abc_xyz(tables).collect()}
    assert {r.item_id: (r.abc_class, r.xyz_class) for r in abc_xyz(Ten).collect()} == one
    assert {c for x in one.values() for c in x} == set("ABCXYZ")


def test_stocked_pairs_get_locations_of_their_own(spark, tables):
    slots = RT.q_build_slotting(tables)
    plan = slots._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan
    n = slots.agg(F.count(F.lit(1)), F.countDistinct("dc_id", "replenishment_location"), F.countDistinct("slotting_id"), F.max("slotting_id")).first()
    assert n[0] == n[1] == n[2] == n[3] == tables.v_stock.count()
    assert slots.filter("pick_location is not null").groupBy("dc_id", "pick_location").count().filter("count > 1").count() == 0
