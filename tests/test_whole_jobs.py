"""Queries whose job had been cut, and steps whose tasks must stay small at any size."""

from pyspark.sql import functions as F

from depot import config as C
from depot.plans import inventory as INV
from depot.registry import _QUERIES, _load


def _items(spark, n):
    return spark.range(n).select(F.col("id").alias("item_id"), F.lit(1.0).alias("cube_ft"), F.lit(2.0).cast("decimal(10,3)").alias("weight_lb"),
                                 (F.col("id") * 37 % 90 + 1).cast("decimal(12,2)").alias("unit_price"))


def test_every_dc_slots_every_item(spark):
    """Also items that the DC does not stock."""
    class Given:
        v_dcs, v_items = spark.createDataFrame([(3,), (1,)], "dc_id long"), _items(spark, 50)
        v_stock = spark.createDataFrame([(1, 4)], "dc_id long, item_id long")

    _load()
    rows = sorted(_QUERIES["build_slotting"](Given).collect())
    assert [(r.slotting_id, r.dc_id, r.item_id) for r in rows] == [(1 + k, (1, 3)[k // 50], k % 50) for k in range(100)]


def test_a_dc_that_comes_twice_has_locations_of_its_own(spark):
    dcs = spark.createDataFrame([(2,), (None,), (2,)], "dc_id long")
    rows = INV.build_slotting(dcs, _items(spark, 20), seed=C.SEED).collect()
    assert sorted(r.slotting_id for r in rows) == list(range(1, 61))
    assert len({(r.dc_id, r.replenishment_location) for r in rows}) == 60
    second = [r for r in rows if r.dc_id == 2]
    by_place = sorted(second, key=lambda r: r.replenishment_location)
    assert [(r.slotting_rank, r.item_id) for r in by_place] == sorted((r.slotting_rank, r.item_id) for r in second)


def test_lines_are_ranked_in_one_write(spark, tmp_path):
    """A plain table is not stored again before or after the ranking; only the view's columns are."""
    from pathlib import Path

    from depot.session import shared_dir
    from depot.sources.tables import Tables
    here = Path(shared_dir(spark).removeprefix("file:"))
    before = set(here.glob("*-*"))
    t = Tables(spark, "/root/testdata/sf0.001")
    lines = t.v_lines
    new = [x for x in here.glob("*-*") if x not in before and x.is_dir() and x.name.split("-")[0] in ("keys", "v_lines")]
    assert sorted(x.name.rsplit("-", 1)[0] for x in new) == ["keys-offsets", "keys-ordered"]
    stored = next(x for x in new if "ordered" in x.name)
    assert "l_tax" not in spark.read.parquet(str(stored)).columns
    n = lines.agg(F.count(F.lit(1)), F.min("order_line_id"), F.max("order_line_id"), F.countDistinct("order_line_id")).first()
    assert n[0] == n[2] == n[3] == t.lineitem.count() and n[1] == 1


def test_lines_that_repeat_keep_ids_of_their_own(spark, tmp_path):
    from depot.sources.tables import Tables
    given = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").limit(40)
    blank = given.limit(3).withColumn("l_orderkey", F.lit(None).cast("long"))
    given.unionByName(given).unionByName(blank).write.parquet(f"{tmp_path}/lineitem.parquet")
    ids = [r.order_line_id for r in Tables(spark, str(tmp_path)).v_lines.collect()]
    assert sorted(ids) == list(range(1, 84))


def test_shuffles_begin_with_more_partitions_for_larger_tables(spark):
    from depot.session import spread_shuffles
    names = ["spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    had = [spark.conf.get(n, None) for n in names]
    try:
        spread_shuffles(spark, 1_000_000)
        assert spark.conf.get(names[0], None) == had[0]                 # 8 partitions are enough
        spread_shuffles(spark, 36_000_000)
        assert spark.conf.get(names[0]) == "144" and int(spark.conf.get(names[1])) <= 16 << 20
        spread_shuffles(spark, 1_000)
        assert spark.conf.get(names[0]) == "144"
    finally:
        for n, x in zip(names, had):
            spark.conf.unset(n) if x is None else spark.conf.set(n, x)


def test_many_shuffle_partitions_do_not_leave_a_task_more(spark):
    # 200 partitions are more than the rows ask for, yet adaptive execution would join them to 64 MB each
    from depot.session import _ADVISORY, _PARTITIONS, spread_shuffles

    at, was = "spark.sql.shuffle.partitions", {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", _PARTITIONS, _ADVISORY)}
    try:
        spark.conf.unset(_PARTITIONS)
        spark.conf.set(at, "200")
        spark.conf.set(_ADVISORY, "64MB")
        spread_shuffles(spark, 1_000)
        assert spark.conf.get(_ADVISORY) == "64MB"                    # small tables leave the session as it is
        spread_shuffles(spark, 36_000_000)
        assert spark.conf.get(_PARTITIONS, None) is None and int(spark.conf.get(_ADVISORY)) == 16 << 20
        spark.conf.set(_ADVISORY, "4m")
        spread_shuffles(spark, 36_000_000)
        assert spark.conf.get(_ADVISORY) == "4m"                      # finer than needed: kept
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
