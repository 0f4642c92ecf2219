"""Rows, balances, codes and ids that must survive: null dates, late buckets,
many items, a damaged record, a master without a shared folder."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from depot.plans import fulfillment as FUL
from depot.plans import inventory as INV
from depot.session import scratch_path, shared_dir


class _Order:
    """A Tables stand-in with one order view."""

    def __init__(self, spark, orders):
        self.spark, self.v_orders = spark, orders
        self.v_shipments = orders.select(F.col("order_id").alias("shipment_id"), F.col("order_date").alias("ship_date"))


def test_rows_without_a_date_are_kept(spark):
    from depot.registry.expansion import q_concat_chunks
    from depot.registry.sources import q_append_parts, q_compact_parts
    rows = [(1, dt.date(1995, 1, 1)), (2, dt.date(1998, 1, 1)), (3, dt.date(2001, 1, 1)), (4, None)]
    t = _Order(spark, spark.createDataFrame(rows, "order_id long, order_date date"))
    for q in (q_append_parts, q_compact_parts):
        assert sorted(r.order_id for r in q(t).collect()) == [1, 2, 3, 4]
    assert sorted(r.shipment_id for r in q_concat_chunks(t).collect()) == [1, 2, 3, 4]


def test_aging_summary_keeps_every_balance(spark):
    led = spark.createDataFrame([(1, "Current", 10.0), (1, "Unknown", 500.0), (2, "90+", 7.0), (2, None, 3.0)], "customer_id long, aging_bucket string, balance double")
    out = FUL.ar_aging_summary(led)
    total = sum(float(r[c]) for r in out.collect() for c in out.columns if c.startswith("bal_"))
    assert total == 520.0


def test_locations_are_unique_for_many_items(spark):
    items = spark.range(20_000).select(F.col("id").alias("item_id"), F.lit(1.0).alias("cube_ft"), F.lit(2.0).cast("decimal(10,3)").alias("weight_lb"),
                                       (F.col("id") % 90 + 1).cast("decimal(12,2)").alias("unit_price"))
    slots = INV.build_slotting(spark.createDataFrame([(1,)], "dc_id long"), items)
    n = slots.agg(F.countDistinct("replenishment_location"), F.countDistinct("pick_location"), F.count("pick_location"), F.countDistinct("slotting_id")).first()
    assert n[0] == 20_000 and n[1] == n[2] and n[3] == 20_000


def test_damaged_record_fails_the_batch(spark, tables):
    from depot.streaming import commits
    from depot.streaming.pipeline import order_pipeline_batch
    sink = scratch_path(spark, "damaged")
    run = order_pipeline_batch(tables, sink)
    assert commits.Batch(spark, sink, 5).earlier("shipment_lines") == 0
    with open(f"{sink}/_commits/4.json", "w") as f:
        f.write('{"batch_id": 4, "attem')
    with pytest.raises(Exception):  # noqa: B017
        commits.Batch(spark, sink, 5).earlier("shipment_lines")
    with pytest.raises(Exception):  # noqa: B017
        run(tables.v_orders.limit(5), 5)


def test_stream_writes_all_sinks(spark, tables):
    from depot.streaming import pipeline as P
    sink = P.stream_order_pipeline(tables)
    n = {name: P.read_sink(spark, sink, name).count() for name in P.SINKS}
    orders, lines = tables.v_orders.count(), tables.v_lines_noid.count()
    assert n == {"orders": orders, "order_lines": lines, "shipments": orders, "shipment_lines": lines,
                 "tracking_events": 4 * orders, "shipment_costs": orders}
    batch = FUL.build_order_lines(tables.v_lines, tables.v_orders, tables.v_customers, tables.v_items)
    got = P.read_sink(spark, sink, "order_lines").select(*batch.columns)
    assert got.exceptAll(batch).count() == 0


def test_a_cluster_must_name_its_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return self

        def get(self, *_):
            return None

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Context()

    with pytest.raises(ValueError):
        shared_dir(Session())


@pytest.mark.parametrize("key", ["shipment_totals", "shipment_cost_rollup", "build_shipments", "conform_to_schema"])
def test_rollups_rank_nothing(spark, key):
    import __spark_entry__ as E
    plan = E.queries()[key](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "monotonically_increasing_id" not in plan and "keys-ordered" not in plan

