"""Edge cases of the business rules (hand-written rows)."""

import datetime as dt

from pyspark.sql import functions as F

from depot.functions import rules as R


def _one(spark, expr, schema, rows):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_aging_buckets(spark):
    days = [0, 1, 30, 31, 60, 61, 90, 91, 10000]
    got = _one(spark, R.aging_bucket("d"), "d int", [(d,) for d in days])
    assert got == ["Current", "1-30", "1-30", "31-60", "31-60", "61-90", "61-90", "90+", "Unknown"]


def test_days_past_due_zero_balance(spark):
    df = spark.createDataFrame([(dt.date(2001, 1, 1), 10.0), (dt.date(2001, 1, 1), 0.0),
                                (dt.date(2002, 1, 1), 5.0)], "due date, bal double")
    got = [r[0] for r in df.select(R.days_past_due(F.lit(dt.date(2001, 1, 31)), F.col("due"), F.col("bal"))).collect()]
    assert got == [30, 0, 0]


def test_density_classes(spark):
    rows = [(1.0, None), (1.0, 0.0), (0.99, 1.0), (1.0, 1.0), (2.0, 1.0), (4.0, 1.0), (6.0, 1.0), (8.0, 1.0),
            (10.0, 1.0)]
    got = _one(spark, R.density_class(R.density("w", "c")), "w double, c double", rows)
    assert got == ["150", "150", "300", "250", "150", "125", "100", "92.5", "70"]


def test_freight_class_overrides(spark):
    got = _one(spark, R.freight_class("s", "c", F.lit(0.5)), "s string, c string",
               [("Copiers", "Furniture"), ("Other", "Furniture"), ("Other", "Other")])
    assert got == ["92.5", "125", "300"]


def test_velocity_class_edges(spark):
    got = _one(spark, R.velocity_class("v"), "v int", [(30,), (31,), (80,), (81,)])
    assert got == ["C", "B", "B", "A"]


def test_cube_fill(spark):
    got = _one(spark, R.fill_cube("c", "l", "w", "h"), "c double, l int, w int, h int",
               [(None, 12, 12, 12), (0.5, 12, 12, 12), (None, None, 12, 12)])
    assert got == [1.0, 0.5, None]


def test_dst_shift(spark):
    df = spark.createDataFrame([("2024-03-10 02:30:00",), ("2024-11-03 01:30:00",), ("2024-11-03 03:30:00",),
                                ("not a time",)], "t string")
    got = [r[0] for r in df.select(R.normalize_timestamp("t")).collect()]
    assert got == ["2024-03-10 03:30:00", "2024-11-03 02:30:00", "2024-11-03 03:30:00", None]


def test_codes_do_not_truncate(spark):
    got = _one(spark, R.invoice_number("o"), "o long", [(7,), (1234567890,)])
    assert got == ["INV-00000007", "INV-1234567890"]


def test_coerce_numeric(spark):
    got = _one(spark, R.coerce_numeric(F.col("x"), default=0.0, lo=0.0, hi=10.0), "x string",
               [("3.5",), ("abc",), (None,), ("-4",), ("99",)])
    assert got == [3.5, 0.0, 0.0, 0.0, 10.0]


def test_tax_rate(spark):
    got = _one(spark, R.tax_rate("f"), "f string", [("y",), ("Y",), ("N",), (None,)])
    assert got == [0.0, 0.0, 0.07, 0.07]


def test_aging_split_sums(spark):
    df = spark.createDataFrame([(q,) for q in [0, 1, 7, 100, 12345]], "q long")
    parts = R.aging_split("q")
    rows = df.select("q", *[v.alias(k) for k, v in parts.items()]).collect()
    for r in rows:
        assert r.aging_0_30 + r.aging_31_60 + r.aging_61_90 + r.aging_90_plus == r.q


def test_po_received_bounds(spark):
    df = spark.createDataFrame([("Received", 10, 1.0), ("Received", 10, 0.55), ("Partial", 1, 0.5),
                                ("Open", 10, 1.0)], "s string, q int, f double")
    got = [r[0] for r in df.select(R.po_received_qty("s", "q", "f")).collect()]
    assert got == [10, 6, 1, 0]
