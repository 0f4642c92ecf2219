"""Joins, samplers and aggregates on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from depot.operators import joins as J
from depot.operators import sampling as S
from depot.operators.aggregates import exact_percentile, minmax_normalize
from depot.plans.customers import contact_reps
from depot.plans.fulfillment import build_ar_ledger


def test_range_join_inclusive_ends(spark):
    orders = spark.createDataFrame([(1, dt.date(2024, 1, 31)), (2, dt.date(2024, 2, 10)), (3, dt.date(2024, 2, 11)),
                                    (4, dt.date(2024, 1, 30))], "order_id int, d date")
    promos = spark.createDataFrame([(7, dt.date(2024, 1, 31), dt.date(2024, 2, 10))], "promo_id int, s date, e date")
    got = sorted(r.order_id for r in J.range_join(orders, promos, "d", "s", "e").collect())
    assert got == [1, 2]


def test_asof_boundary_day(spark):
    facts = spark.createDataFrame([(1, 5, dt.date(2024, 3, 1)), (2, 5, dt.date(2024, 2, 29)),
                                   (3, 5, dt.date(2023, 1, 1))], "fid int, item_id int, d date")
    versions = spark.createDataFrame([(5, dt.date(2024, 1, 1), 10.0), (5, dt.date(2024, 3, 1), 12.0)],
                                     "item_id int, start date, price double")
    got = {r.fid: r.price for r in J.asof_join(facts, versions, ["item_id"], "d", "start").collect()}
    assert got == {1: 12.0, 2: 10.0, 3: None}


def test_minmax_constant_column(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0)], "k int, x double")
    assert [r.n for r in minmax_normalize(df, "x", "n").collect()] == [0.5, 0.5]


def test_exact_percentile_matches_interpolation(spark):
    vals = [float(v) for v in [3, 1, 4, 1, 5, 9, 2, 6, 5, 3]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "k int, x double")
    got = exact_percentile(df, "x", 0.8, tie_cols=["k"]).first().value
    s = sorted(vals)
    pos = 0.8 * (len(s) - 1)
    lo = int(pos)
    assert abs(got - (s[lo] + (pos - lo) * (s[lo + 1] - s[lo]))) < 1e-12


def test_sample_exact_fraction_size(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "k")
    assert S.sample_exact_fraction(df, 0.05, ["k"]).count() == 50
    assert S.sample_exact_fraction(df.limit(3), 0.05, ["k"]).count() == 1


def test_samples_repeatable(spark):
    df = spark.range(0, 500).withColumnRenamed("id", "k")
    a = {r.k for r in S.sample_rows(df, 20, ["k"]).collect()}
    b = {r.k for r in S.sample_rows(df.repartition(7), 20, ["k"]).collect()}
    assert a == b and len(a) == 20


def test_region_without_reps_falls_back(spark):
    customers = spark.createDataFrame([(1, "Corporate", False, "EAST"), (2, "Corporate", False, "NOWHERE")],
                                      "customer_id long, segment string, is_sub boolean, region string")
    reps = spark.createDataFrame([(1, "EAST"), (2, "EAST"), (3, "WEST")], "rep_id int, region string")
    got = {r.customer_id: (r.primary_rep_id, r.secondary_rep_id) for r in contact_reps(customers, reps).collect()}
    p, s2 = got[1]
    assert p in (1, 2) and s2 in (1, 2) and p != s2
    p, s2 = got[2]
    assert p in (1, 2, 3) and s2 != p


def test_write_off_threshold(spark):
    inv = spark.createDataFrame([(1, 1, dt.date(2000, 1, 1), dt.date(2000, 1, 31), 199.99),
                                 (2, 1, dt.date(2000, 1, 1), dt.date(2000, 1, 31), 200.00)],
                                "invoice_id long, customer_id long, invoice_date date, due_date date, total_amount double")
    pay = spark.createDataFrame([], "invoice_id long, paid_ratio double")
    cust = spark.createDataFrame([(1, 0.9)], "customer_id long, risk_score double")
    rows = {r.invoice_id: r for r in build_ar_ledger(inv, pay, cust, as_of=dt.date(2001, 1, 1)).collect()}
    assert rows[1].writeoff_reason is not None and float(rows[1].balance) == 0.0 and rows[1].aging_bucket == "Current"
    assert rows[2].writeoff_reason is None and float(rows[2].balance) == 200.0 and rows[2].aging_bucket == "90+"
    assert rows[2].credit_hold_flag


def test_range_join_open_end(spark):
    orders = spark.createDataFrame([(1, dt.date(2024, 1, 5)), (2, dt.date(2024, 6, 1)), (3, dt.date(2023, 12, 31))],
                                   "order_id int, d date")
    promos = spark.createDataFrame([(7, dt.date(2024, 1, 1), None)], "promo_id int, s date, e date")
    got = sorted(r.order_id for r in J.range_join(orders, promos, "d", "s", "e").collect())
    assert got == [1, 2]


def test_imputed_category_follows_the_shares_of_its_group(spark):
    rows = [(k, "a", "x" if k % 4 else "y") for k in range(4000)] + [(k, None, "z") for k in range(4000, 4010)]
    rows += [(k, "a", "?") for k in range(5000, 9000)] + [(9000, None, None), (9001, "lone", "?"), (9002, "lone", None)]
    df = spark.createDataFrame(rows, "k int, g string, c string")
    got = {r.k: r.c for r in S.impute_category(df, ["g"], "c", F.col("c") == "?", ["k"]).collect()}
    assert sorted(got) == list(range(5000, 9003))                     # each missing row once, no other
    drawn = [got[k] for k in range(5000, 9000)]
    assert set(drawn) == {"x", "y"} and abs(drawn.count("y") / 4000 - 0.25) < 0.03
    assert got[9000] == "z" and got[9001] is None and got[9002] is None
    again = {r.k: r.c for r in S.impute_category(df.repartition(7), ["g"], "c", F.col("c") == "?", ["k"]).collect()}
    assert again == got


def test_imputed_category_of_empty_table(spark):
    df = spark.createDataFrame([], "k int, g string, c string")
    assert S.impute_category(df, ["g"], "c", F.col("c") == "?", ["k"]).collect() == []


def test_weighted_category_cut_points(spark):
    df = spark.createDataFrame([(0.0,), (0.49,), (0.5,), (0.99,)], "u double")
    got = [r.c for r in df.select(S.weighted_category(F.col("u"), ["a", "b"], [3, 3]).alias("c")).collect()]
    assert got == ["a", "a", "b", "b"]


def test_spread_offsets_pins_both_ends(spark):
    from depot.operators.expand import spread_offsets
    df = spark.createDataFrame([(1, 0), (2, 9), (5, 100)], "n int, total int")
    got = [r.o for r in df.select(spread_offsets(F.col("n"), F.col("total"), lambda i: i * 0 - 30).alias("o")).collect()]
    assert got == [[0], [0, 9], [0, 0, 20, 45, 100]]
