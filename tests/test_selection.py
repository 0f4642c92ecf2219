"""Selection by histograms and the merged as-of join against plain Python."""

import bisect
import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from depot.operators import joins as J
from depot.operators import sampling as S
from depot.operators import selection
from depot.operators.aggregates import exact_percentile
from depot.session import shared_dir


def percentile(values, p):
    s = sorted(values)
    at = p * (len(s) - 1)
    lo = math.floor(at)
    return s[lo] if at == lo else s[lo] + (at - lo) * (s[lo + 1] - s[lo])


@pytest.mark.parametrize("name", ["uniform", "one value", "two ends", "heavy tail", "tiny", "steps"])
def test_percentile_is_exact(spark, name, monkeypatch):
    monkeypatch.setattr(selection, "FEW", 20)
    rng = random.Random(6)
    values = {"uniform": [rng.random() for _ in range(5000)], "one value": [7.0] * 4500 + [rng.random() * 20 for _ in range(500)],
              "two ends": [-1.7e308] * 50 + [1.7e308] * 50 + [float(i) for i in range(300)], "heavy tail": [math.exp(rng.random() * 600 - 300) for _ in range(3000)],
              "tiny": [3.0], "steps": [float(rng.randrange(5)) for _ in range(2000)]}[name]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(-1, None)], "k int, x double").repartition(6)
    for p in (0.0, 0.1, 0.5, 0.8, 0.999, 1.0):
        assert exact_percentile(df, "x", p).first().value == percentile(values, p), p


def test_infinities_nan_and_no_values(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, float("inf"), float("-inf"), float("nan"), 2.0]], "x double")
    got = [exact_percentile(df, "x", p).first().value for p in (0.0, 0.25, 0.5, 0.75, 1.0)]
    assert got[:4] == [float("-inf"), 1.0, 2.0, float("inf")] and math.isnan(got[4])
    assert exact_percentile(df.limit(0), "x", 0.5).first().value is None


def test_selection_stores_no_rows(spark):
    import os
    before = set(os.listdir(shared_dir(spark)))
    df = spark.range(20_000).withColumn("x", F.col("id").cast("double"))
    assert exact_percentile(df, "x", 0.25).first().value == percentile(range(20_000), 0.25)
    assert S.sample_exact_fraction(df, 0.1, ["id"]).count() == 2000
    assert set(os.listdir(shared_dir(spark))) == before


def test_exact_sample_with_a_key_that_most_rows_share(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, 5).otherwise(F.col("id")).alias("k"), F.col("id").alias("row"))
    for rate in (0.02, 0.5, 0.95, 1.0):
        got = S.sample_exact_fraction(df, rate, ["k"])
        assert got.count() == round(1000 * rate) == got.select("row").distinct().count()


def asof(facts, versions, ended=False):
    by = {}
    for key, start, end, price in sorted((v for v in versions if v[0] is not None and v[1] is not None), key=lambda v: (v[0], v[1], v[2] or v[1], v[3])):
        by.setdefault(key, []).append((start, price, end))
    out = []
    for fid, key, t in facts:
        vs = by.get(key, [])
        i = bisect.bisect_right([v[0] for v in vs], t) if t is not None else 0
        hit = vs[i - 1] if i else None
        out.append((fid, hit[1] if hit and not (ended and hit[2] is not None and t > hit[2]) else None))
    return sorted(out)


@pytest.mark.parametrize("max_rows", [1_000_000, 300])
def test_asof_with_a_hot_item_and_a_hot_day(spark, max_rows):
    rng = random.Random(1)
    day = lambda i: dt.date(2020, 1, 1) + dt.timedelta(days=i)
    versions = [(1, day(2 * i), day(2 * i) if i % 3 == 0 else None, float(i)) for i in range(1000)]     # every second day, some end at once
    versions += [(k, day(rng.randrange(2000)), None, float(rng.randrange(1 << 40))) for k in range(2, 20) for _ in range(3)]
    versions += [(None, day(1), None, -1.0), (1, None, None, -2.0)]
    facts = [(i, 1, day(rng.randrange(-20, 2100))) for i in range(2500)] + [(5000 + i, 1, day(600)) for i in range(1500)]
    facts += [(9000 + i, rng.randrange(2, 25), day(rng.randrange(2100))) for i in range(300)] + [(9500, None, day(5)), (9501, 1, None)]
    f = spark.createDataFrame(facts, "fid int, item int, d date").repartition(5)
    v = spark.createDataFrame(versions, "item int, start date, stop date, price double").repartition(3)
    got = J.asof_join(f, v, ["item"], "d", "start", "stop", max_rows=max_rows)
    assert got.columns == ["fid", "item", "d", "start", "stop", "price"]
    assert sorted((r.fid, r.price) for r in got.collect()) == asof(facts, versions, ended=True)
    got = J.asof_join(f, v.drop("stop"), ["item"], "d", "start", how="inner", max_rows=max_rows)
    assert sorted((r.fid, r.price) for r in got.collect()) == [x for x in asof(facts, versions) if x[1] is not None]
    if max_rows == 300:
        slices = J._sliced(*_parts(f, v, 300))
        most = slices.groupBy("_k0", "_slice").count().agg(F.max("count")).first()[0]
        assert most < 1200 and slices.count() < len(facts) + len(versions) + 30      # 5,002 rows of one item; linear


def _parts(f, v, max_rows):
    rows = (f.select(F.col("item").alias("_k0"), F.col("d").alias("_t"), F.lit(1).alias("_kind"), F.struct("fid").alias("_f"))
            .unionByName(v.filter("item is not null and start is not null").select(F.col("item").alias("_k0"), F.col("start").alias("_t"), F.lit(0).alias("_kind"),
                                                                                  F.struct("price").alias("_v")), allowMissingColumns=True))
    sizes = rows.groupBy("_k0").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_rows)
    return rows, sizes, ["_k0"], -(-sizes.agg(F.max("_n")).first()[0] // max_rows)


def test_asof_plan_compares_no_pairs(spark):
    f = spark.createDataFrame([(1, 2, dt.date(2024, 1, 1))], "fid int, item int, d date")
    v = spark.createDataFrame([(2, dt.date(2023, 1, 1), 1.0)], "item int, start date, price double")
    plan = J.asof_join(f, v, ["item"], "d", "start")._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Join" not in plan


def test_range_join_takes_points_with_a_time_of_day(spark):
    points = spark.createDataFrame([(1, dt.datetime(2024, 1, 31)), (2, dt.datetime(2024, 2, 5, 15, 30)), (3, dt.datetime(2024, 2, 10, 0, 0, 1)),
                                    (4, dt.datetime(2024, 1, 30, 23, 59))], "k int, d timestamp_ntz")
    iv = spark.createDataFrame([(7, dt.date(2024, 1, 31), dt.date(2024, 2, 10)), (8, dt.date(2024, 2, 10), None)], "p int, s date, e date")
    assert sorted((r.k, r.p) for r in J.range_join(points, iv, "d", "s", "e").collect()) == [(1, 7), (2, 7), (3, 8)]
