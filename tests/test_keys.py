"""Dense keys: exact 1..N ranks without a one-partition window."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from depot.operators.keys import dense_keys
from depot.operators.windows import seq_within


def _expected(df, cols):
    return df.withColumn("want", F.row_number().over(Window.orderBy(*cols)))


def test_dense_keys_match_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("a"), (F.col("id") % 3).alias("b"))
    got = dense_keys(df, ["a", "b"], "rid", n_ranges=7)
    j = got.join(_expected(df, ["a", "b"]), ["a", "b"])
    assert j.filter(F.col("rid") != F.col("want")).count() == 0
    assert got.agg(F.min("rid"), F.max("rid"), F.countDistinct("rid")).first() == (1, 5000, 5000)


def test_dense_keys_hot_leading_key(spark):
    # a third of the rows share one leading key: bounds must split it
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(42)).otherwise(F.col("id")).alias("k"),
                                     F.col("id").alias("t"))
    got = dense_keys(df, ["k", "t"], "rid", n_ranges=8)
    j = got.join(_expected(df, ["k", "t"]), ["k", "t"])
    assert j.filter(F.col("rid") != F.col("want")).count() == 0


def test_dense_keys_start_offset_and_partition_invariance(spark):
    df = spark.range(0, 1000).select((F.col("id") * 37 % 1000).alias("a"))
    one = {r.a: r.rid for r in dense_keys(df, ["a"], "rid", start=1001, n_ranges=1).collect()}
    many = {r.a: r.rid for r in dense_keys(df, ["a"], "rid", start=1001, n_ranges=13).collect()}
    assert one == many
    assert min(one.values()) == 1001 and max(one.values()) == 2000


def test_seq_within_groups(spark):
    df = spark.createDataFrame([(1, 10), (1, 11), (2, 5), (1, 12), (2, 7)], "g long, o long")
    got = {(r.g, r.o): r.s for r in seq_within(df, ["g"], ["o"], "s").collect()}
    assert got == {(1, 10): 1, (1, 11): 2, (1, 12): 3, (2, 5): 1, (2, 7): 2}


def test_empty_input(spark):
    df = spark.createDataFrame([], "a long")
    assert dense_keys(df, ["a"], "rid").count() == 0


def test_dense_keys_over_a_daylight_saving_gap(spark):
    # zone-less timestamps keep their own order in any session zone
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.range(0, 8640).select(F.expr("timestamp_ntz'2024-03-10 00:00:00' + make_dt_interval(0, 0, 0, id * 10)").alias("ts"),
                                         F.col("id"))
        got = dense_keys(df, ["ts", "id"], "rid", n_ranges=600)
        assert got.filter(F.col("rid") != F.col("id") + 1).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_dense_keys_many_ranges(spark):
    df = spark.range(0, 20000).select((F.col("id") * 7919 % 20000).alias("a"))
    got = dense_keys(df, ["a"], "rid", n_ranges=700)
    assert got.filter(F.col("rid") != F.col("a") + 1).count() == 0


def test_stored_ids_cost_little_on_disk(spark, tmp_path):
    from depot.session import write_compact
    ids = spark.range(0, 200_000, 1, 1)
    ids.write.parquet(str(tmp_path / "plain"))
    write_compact(ids, str(tmp_path / "compact"))
    plain, compact = (sum(f.stat().st_size for f in (tmp_path / n).glob("*.parquet")) for n in ("plain", "compact"))
    assert compact * 10 < plain
    kinds = spark.sql("""SELECT id, id = 1 AS b, CAST(id AS DECIMAL(12,2)) AS d, CAST(id AS DECIMAL(30,4)) AS w, CAST(id AS STRING) AS s,
                         IF(id = 2, NULL, DATE '2020-01-01' + CAST(id AS INT)) AS day, TIMESTAMP_NTZ '2020-01-01 00:00:00' AS t,
                         CAST(id AS FLOAT) AS f, CAST(id AS DOUBLE) AS x, CAST(id AS SHORT) AS h FROM range(5)""")
    write_compact(kinds, str(tmp_path / "kinds"))
    assert spark.read.parquet(str(tmp_path / "kinds")).orderBy("id").collect() == kinds.orderBy("id").collect()
