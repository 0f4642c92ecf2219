"""Stream equals batch; ids continue over micro-batches."""

import pytest

from tests.test_oracle import _canon, con  # noqa: F401  (fixture reuse)
import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", ["stream_order_pipeline", "stream_dense_ids", "reload_streamed",
                                 "stream_milestones", "stream_progress_counts"])
def test_stream_matches_batch_sql(spark, con, key):  # noqa: F811
    df = E.queries()[key](spark, SF)
    s_cols, s_rows = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[key])
    d_cols, d_rows = _canon([d[0] for d in res.description], res.fetchall())
    assert s_cols == d_cols and s_rows == d_rows


def test_replayed_batch_keeps_its_ids(spark, tables):
    """Running a batch body twice (a replay) rewrites the same ids."""
    from depot.session import scratch_path
    from depot.streaming.pipeline import order_pipeline_batch, read_sink
    sink = scratch_path(spark, "replay")
    run = order_pipeline_batch(tables, sink)
    orders = tables.v_orders
    first, second = orders.filter("order_id % 2 = 0"), orders.filter("order_id % 2 = 1")
    run(first, 0)
    run(second, 1)
    ids1 = sorted(r[0] for r in read_sink(spark, sink, "tracking_events").select("tracking_event_id").collect())
    run(second, 1)   # replay of batch 1
    ids2 = sorted(r[0] for r in read_sink(spark, sink, "tracking_events").select("tracking_event_id").collect())
    assert ids1 == ids2 == list(range(1, len(ids1) + 1))


def test_a_broken_batch_is_seen_in_no_table_until_its_replay(spark, tables, monkeypatch):
    from depot.plans import fulfillment as FUL
    from depot.session import scratch_path
    from depot.streaming import commits
    from depot.streaming.pipeline import SINKS, order_pipeline_batch, read_sink, running_counts
    sink = scratch_path(spark, "torn")
    run = order_pipeline_batch(tables, sink)
    first, second = tables.v_orders.filter("order_id % 2 = 0"), tables.v_orders.filter("order_id % 2 = 1")
    run(first, 0)
    before = {n: read_sink(spark, sink, n).count() for n in SINKS}

    def broken(*_, **__):
        raise RuntimeError("lost")

    whole = FUL.build_tracking_events
    for name in ("build_tracking_events", "shipment_costs"):        # between the tables, and before the record
        keep = getattr(FUL, name)
        monkeypatch.setattr(FUL, name, broken)
        with pytest.raises(RuntimeError):
            run(second, 1)
        monkeypatch.setattr(FUL, name, keep)
        assert {n: read_sink(spark, sink, n).count() for n in SINKS} == before
        assert commits.records(spark, sink).count() == 1
    assert FUL.build_tracking_events is whole
    run(second, 1)
    after = {n: read_sink(spark, sink, n).count() for n in SINKS}
    assert after["orders"] == tables.v_orders.count() and after["shipments"] > before["shipments"]
    ids = sorted(r[0] for r in read_sink(spark, sink, "tracking_events").select("tracking_event_id").collect())
    assert ids == list(range(1, len(ids) + 1))
    assert {r["table_name"]: r["row_count"] for r in running_counts(spark, sink).collect()} == after
    run(second, 1)                                                  # the replay of a committed batch changes nothing
    assert {n: read_sink(spark, sink, n).count() for n in SINKS} == after


def test_a_batch_frees_what_it_stored_and_the_attempts_it_replaces(spark, tables):
    import os

    from depot.session import scratch_path, shared_dir
    from depot.sources import storage
    from depot.streaming.pipeline import order_pipeline_batch
    tables.v_lines                                                  # stored once per session, stays
    sink, few = scratch_path(spark, "frees"), tables.v_orders.filter("order_id < 100")
    run = order_pipeline_batch(tables, sink)
    top = shared_dir(spark)
    for n in ("orders", "shipment_lines"):
        spark.range(3).write.parquet(f"{sink}/{n}/batch_id=0/attempt=torn")
    before = set(os.listdir(top))
    run(few, 0)
    assert set(os.listdir(top)) == before
    assert len(storage.folders(spark, f"{sink}/orders/batch_id=0")) == 1


def test_an_empty_batch_commits(spark, tables):
    from depot.session import scratch_path
    from depot.streaming.pipeline import SINKS, order_pipeline_batch, read_sink
    sink = scratch_path(spark, "empty-batch")
    order_pipeline_batch(tables, sink)(tables.v_orders.limit(0), 0)
    assert [read_sink(spark, sink, n).count() for n in SINKS] == [0] * 6


def test_a_damaged_record_fails_the_reader(spark, tables):
    from depot.session import scratch_path
    from depot.streaming import commits
    with pytest.raises(Exception):
        commits.read(spark, scratch_path(spark, "no-sink"), "orders")
