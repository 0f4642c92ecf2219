"""Structured Streaming forms of the order pipeline (J ops).

Orders arrive as files in a landing folder.  ``readStream`` picks them up and
``foreachBatch`` turns each micro-batch into priced order lines, shipments,
shipment lines, cost rollups and tracking events (the same ``build_*``
functions as the batch path).  The tables of a batch become visible together,
by a commit record written last (``streaming.commits``): a batch that broke
half way is seen in none of them, and a replay of a committed batch changes
nothing.  The record carries the rows of each table, observed while they were
written; ids continue from these (J2) and running counts are read from them (J4).
``trigger(availableNow=True)`` drains what has landed and stops; checkpoints
live under the shared scratch folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depot.plans import fulfillment as FUL
from depot.session import scratch_path, scratch_scope, stored
from depot.sources.tables import shipments_from_orders
from depot.streaming import commits

SINKS = ["orders", "order_lines", "shipments", "shipment_lines", "tracking_events", "shipment_costs"]


def land_chunks(df: DataFrame, path: str, key: str, n_chunks: int, files_per_chunk: int = 2) -> None:
    """Write ``df`` to a landing folder as ``n_chunks x files_per_chunk``
    key-range files in one pass (the file source then feeds them to the
    stream, ``maxFilesPerTrigger`` at a time)."""
    df.repartitionByRange(n_chunks * files_per_chunk, key).write.mode("append").parquet(path)


def order_pipeline_batch(tables, sink: str, static_lines: DataFrame | None = None,
                         names: Sequence[str] = SINKS) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` body of J1/J2 over a stream of orders.

    ``static_lines``: the order lines (with ids) as a table stored in order of
    ``order_id``; each batch reads only the row groups between its first and
    last order, once: its own lines are stored for the tables made of them, and
    freed with everything else that the batch stored on its way.  ``names``:
    the tables to write."""
    spark = tables.spark
    all_lines = static_lines if static_lines is not None else tables.v_lines
    commits.start(spark, sink)

    def run(batch: DataFrame, batch_id: int) -> None:
        now = commits.Batch(spark, sink, batch_id)
        if now.committed():
            return
        with scratch_scope(spark):
            orders = now.write(batch, "orders")
            low, high = orders.agg(F.min("order_id"), F.max("order_id")).first()
            near = all_lines.filter(F.col("order_id").between(low, high)) if low is not None else all_lines.limit(0)
            lines = near.join(orders.select("order_id"), "order_id", "left_semi")
            if {"order_lines", "shipment_lines", "shipments", "shipment_costs"} & set(names):
                lines = stored(lines, "batch-lines")
            ships = shipments_from_orders(orders)
            if {"shipment_lines", "shipments", "shipment_costs"} & set(names):
                sl = FUL.build_shipment_lines(ships, lines, tables.v_items, tables.v_carriers, orders,
                                              start_id=now.earlier("shipment_lines") + 1)
                sl = now.write(sl, "shipment_lines")
            if "order_lines" in names:
                now.write(FUL.build_order_lines(lines, orders, tables.v_customers, tables.v_items), "order_lines")
            if "shipments" in names:
                now.write(FUL.build_shipments(ships, sl, tables.v_items), "shipments")
            if "tracking_events" in names:
                now.write(FUL.build_tracking_events(ships, tables.v_dcs, start_id=now.earlier("tracking_events") + 1), "tracking_events")
            if "shipment_costs" in names:
                now.write(FUL.shipment_costs(ships, sl, tables.v_items), "shipment_costs")
            now.commit()

    return run


def stream_order_pipeline(tables, n_chunks: int = 2, max_files: int = 2, names: Sequence[str] = SINKS) -> str:
    """Run J1 end to end over the orders of ``tables``: land them as chunks,
    stream them through the pipeline with ``availableNow``, and return the
    sink folder (one sub-folder per table)."""
    spark = tables.spark
    landing = scratch_path(spark, "landing-orders")
    sink = scratch_path(spark, "stream-sink")
    ckpt = scratch_path(spark, "stream-ckpt")
    orders = tables.v_orders
    land_chunks(orders, landing, "order_id", n_chunks)
    lines = tables.v_lines          # stored once, in order of order_id
    stream = (spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", max_files).parquet(landing))
    q = (stream.writeStream.foreachBatch(order_pipeline_batch(tables, sink, lines, names))
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return sink


def read_sink(spark: SparkSession, sink: str, name: str) -> DataFrame:
    """Read a streamed table back (A9): the committed batches only."""
    return commits.read(spark, sink, name)


def running_counts(spark: SparkSession, sink: str) -> DataFrame:
    """Rows so far per streamed table, as observed while its batches were
    written: (table_name, row_count).  Torn batches do not count."""
    return commits.row_counts(spark, sink).groupBy("table_name").agg(F.sum("row_count").alias("row_count"))


def stream_milestones(tables, n_chunks: int = 3) -> DataFrame:
    """A stream of shipments expanded to milestone events with a
    stream-static join to the DC dimension, appended to a Parquet sink."""
    spark = tables.spark
    landing = scratch_path(spark, "landing-shipments")
    sink = scratch_path(spark, "milestones")
    ckpt = scratch_path(spark, "milestones-ckpt")
    ships = tables.v_shipments
    land_chunks(ships, landing, "shipment_id", n_chunks)
    stream = spark.readStream.schema(ships.schema).option("maxFilesPerTrigger", 2).parquet(landing)
    events = FUL.tracking_milestones(stream, tables.v_dcs)
    q = (events.writeStream.format("parquet").option("path", sink).option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(events.schema).parquet(sink)
