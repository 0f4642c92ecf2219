"""Prices and costs: effective-dated list prices, contract prices, item
cost versions, promotions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depot.operators.aggregates import by_order
from depot.operators.keys import dense_keys
from depot.operators.windows import version_intervals
from pyspark.sql import Window


def monthly_prices(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Observed price per item and month: the lowest unit price paid."""
    return (lines.select("order_id", "item_id", F.col("unit_price").cast("decimal(12,2)").alias("p"))
            .join(orders.select("order_id", F.trunc("order_date", "month").alias("month")), "order_id")
            .groupBy("item_id", "month").agg(F.min("p").alias("list_price")))


def build_price_history(lines: DataFrame, orders: DataFrame, with_ids: bool = True) -> DataFrame:
    """Effective-dated list-price versions (I12): a new version starts in
    each month whose observed price differs from the previous observed
    month; end = next start - 1 day (E6), open on the last version.

    The change-detection window is partitioned by item over one row per
    item-month (already aggregated), so its groups are small."""
    m = monthly_prices(lines, orders)
    w = Window.partitionBy("item_id").orderBy("month")
    changed = m.withColumn("_prev", F.lag("list_price").over(w)).filter(
        F.col("_prev").isNull() | (F.col("_prev") != F.col("list_price")))
    v = version_intervals(changed.select("item_id", F.col("month").alias("effective_date"), "list_price"),
                          ["item_id"], "effective_date")
    ids = ["price_history_id"] if with_ids else []      # the ranking pass runs only when ids are wanted
    if with_ids:
        v = dense_keys(v, ["item_id", "effective_date"], "price_history_id")
    return v.select(*ids, "item_id", F.lit(None).cast("long").alias("customer_id"),
                    "effective_date", "end_date", "list_price",
                    F.lit(0).cast("decimal(5,2)").alias("discount_pct"),
                    F.col("list_price").alias("net_price"), F.lit(False).alias("promo_flag"),
                    F.lit("Standard").alias("channel"))


# ---------------------------------------------------------------- I11
def build_preferences(lines: DataFrame, orders: DataFrame, as_of, min_score: float = 5.0,
                      top_n_per_customer: int = 50, with_ids: bool = True) -> DataFrame:
    """Customer-item preference scores (I11): RFM aggregate (D4), global
    min-max scaling (D11) of frequency, monetary value and recency,
    score = 100 x (0.4 F + 0.4 M + 0.2 (1 - R)); keep score >= ``min_score``
    and the top ``top_n_per_customer`` per customer (E3); dense ids."""
    agg = by_order(lines, orders, ["customer_id", "item_id"]).groupBy("customer_id", "item_id").agg(
        F.sum("_m").cast("double").alias("_m"),
        F.count(F.lit(1)).cast("double").alias("_f"),
        F.max("order_date").alias("last_purchased_date"))
    agg = agg.withColumn("_r", F.greatest(F.lit(0), F.datediff(F.lit(as_of), "last_purchased_date")).cast("double"))
    mm = agg.agg(*[f(c).alias(f"{c}_{n}") for c in ["_f", "_m", "_r"] for n, f in [("mn", F.min), ("mx", F.max)]])

    def norm(c):
        lo, hi = F.col(f"{c}_mn"), F.col(f"{c}_mx")
        return F.when(hi == lo, F.lit(0.5)).otherwise((F.col(c) - lo) / (hi - lo))

    scored = agg.crossJoin(F.broadcast(mm)).withColumn(
        "_score", (F.lit(0.4) * norm("_f") + F.lit(0.4) * norm("_m") + F.lit(0.2) * (F.lit(1.0) - norm("_r")))
        * F.lit(100.0))
    kept = scored.filter(F.col("_score") >= min_score)
    from depot.operators.windows import top_n
    top = top_n(kept, ["customer_id"], [F.col("_score").desc(), F.col("item_id")], top_n_per_customer)
    ids = ["preference_id"] if with_ids else []
    keyed = (dense_keys(top.withColumn("_neg", -F.col("_score")), ["customer_id", "_neg", "item_id"], "preference_id")
             if with_ids else top)
    return keyed.select(*ids, "customer_id", "item_id",
                        F.round("_score", 4).cast("decimal(10,4)").alias("preference_score"),
                        "last_purchased_date", F.col("_score").alias("score_raw"))


# ---------------------------------------------------------------- I13, G1
def contract_prices(preferences: DataFrame, price_history: DataFrame, quantile: float = 0.8,
                    discount: float = 0.10) -> DataFrame:
    """Contract prices (I13) for customer-item pairs whose score is at or
    above the exact ``quantile`` of all scores (D10): the item's latest list
    price (E4) less ``discount`` (midpoint of 5-15%), 4 dp."""
    from depot.operators.aggregates import exact_percentile
    from depot.operators.windows import latest_per_key
    thr = exact_percentile(preferences, "score_raw", quantile, tie_cols=["customer_id", "item_id"])
    top = (preferences.filter(F.col("score_raw") >= thr.select("value").scalar())
           .select("customer_id", "item_id").dropDuplicates())
    latest = latest_per_key(price_history.select("item_id", "effective_date", "list_price"), ["item_id"],
                            "effective_date")
    d = F.lit(discount).cast("decimal(5,4)")
    return top.join(latest, "item_id").select(
        "item_id", "customer_id", "effective_date", F.lit(None).cast("date").alias("end_date"),
        F.col("list_price").cast("decimal(12,4)").alias("list_price"), d.alias("discount_pct"),
        F.round(F.col("list_price") * (F.lit(1) - d), 4).cast("decimal(12,4)").alias("net_price"),
        F.lit(False).alias("promo_flag"), F.lit("Contract").alias("channel"))


def union_price_rows(list_rows: DataFrame, contract_rows: DataFrame) -> DataFrame:
    """List and contract price rows in one table (G1), aligned by name."""
    from depot.operators.sets import union_aligned
    lr = list_rows.drop("price_history_id").withColumn("list_price", F.col("list_price").cast("decimal(12,4)")) \
        .withColumn("net_price", F.col("net_price").cast("decimal(12,4)")) \
        .withColumn("discount_pct", F.col("discount_pct").cast("decimal(5,4)"))
    return union_aligned([lr, contract_rows])


# ---------------------------------------------------------------- I14
def build_item_costs(price_history: DataFrame, items: DataFrame, cost_ratio: float = 0.7,
                     keep_versions: int = 3) -> DataFrame:
    """Effective-dated cost versions (I14): the last ``keep_versions`` list
    price versions per item; unit cost = price x ``cost_ratio``; freight
    (B12), duty (B11), landed, replacement and MAP (B13)."""
    from depot.functions import rules as R
    from depot.operators.windows import top_n
    v = top_n(price_history.select("item_id", "effective_date", "list_price"), ["item_id"],
              [F.col("effective_date").desc()], keep_versions)
    j = v.join(items.select("item_id", "category", "cube_ft", "weight_lb", "shipping_cost_per_unit"), "item_id", "left")
    uc = F.round(F.col("list_price") * F.lit(cost_ratio).cast("decimal(4,2)"), 4).cast("decimal(18,4)")
    j = j.withColumn("unit_cost", uc).withColumn(
        "freight_cost", F.round(R.unit_freight("cube_ft", "weight_lb"), 4).cast("decimal(18,4)")).withColumn(
        "duty_rate", R.duty_rate("category").cast("decimal(10,4)"))
    lc = R.landed_costs("unit_cost", "list_price", "freight_cost", "duty_rate")
    out = j.select("item_id", "effective_date", "unit_cost",
                   F.col("list_price").cast("decimal(18,4)").alias("unit_price"),
                   F.col("shipping_cost_per_unit").cast("decimal(18,4)").alias("shipping_cost_per_unit"),
                   "freight_cost", "duty_rate", lc["landed_cost"].alias("landed_cost"),
                   lc["replacement_cost"].alias("replacement_cost"), lc["map_price"].alias("map_price"))
    return dense_keys(out, ["item_id", "effective_date"], "item_cost_id")


# ---------------------------------------------------------------- I16, I15
PROMO_VALUE = {"PCTOFF": 15.00, "FIXEDOFF": 27.50, "BOGO": 1.00}   # midpoints of the value ranges


def build_promotions(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Promo calendar (I16): one promotion per order month x item category;
    start day and length follow from the month, the end is clipped to the
    last order date; type by a 60/25/15 rule, value by type; code by year."""
    months = orders.select(F.year("order_date").cast("int").alias("y"),
                           F.month("order_date").cast("int").alias("m")).distinct()
    cats = items.select("category").filter(F.col("category").isNotNull()).distinct()
    end_all = orders.agg(F.max("order_date").alias("_period_end"))
    grid = months.crossJoin(cats).crossJoin(F.broadcast(end_all))        # months x categories; end: one row
    start = F.make_date("y", "m", F.lit(1) + (F.col("y") + F.col("m") * 3) % 20)
    length = F.lit(7) + (F.col("y") * F.col("m") + F.length("category")) % 24
    k = (F.col("m") + F.length("category")) % 20
    dtype = F.when(k < 12, "PCTOFF").when(k < 17, "FIXEDOFF").otherwise("BOGO")
    g = grid.select("y", "m", "category", start.alias("start_date"),
                    F.least(F.date_add(start, (length - 1).cast("int")), F.col("_period_end")).alias("end_date"),
                    dtype.alias("discount_type"))
    g = dense_keys(g, ["y", "m", "category"], "promo_id")
    from depot.functions import rules as R
    return g.select("promo_id", F.format_string("Promotion %04d", F.col("promo_id")).alias("promo_name"),
                    R.promo_code("y", "promo_id").alias("promo_code"), "start_date", "end_date", "discount_type",
                    R.map_lookup(PROMO_VALUE, F.col("discount_type")).cast("decimal(8,2)").alias("discount_value"),
                    F.lit("CATEGORY").alias("applies_to"), "category",
                    F.lit(None).cast("string").alias("customer_segment"))


def build_promo_orders(promotions: DataFrame, orders: DataFrame, rate: float = 1.0, seed: int = 42) -> DataFrame:
    """Order-promotion bridge (I15): orders placed inside an active window
    (C6), one promotion per order by keyed draw (F7), optionally only a
    ``rate`` share of orders (F8); dense ids by order."""
    from depot.operators.joins import range_join
    from depot.operators.sampling import pick_one, fraction_sample
    j = range_join(orders.select("order_id", "order_date"), promotions.select("promo_id", "start_date", "end_date"),
                   "order_date", "start_date", "end_date")
    one = pick_one(j.select("order_id", "promo_id"), ["order_id"], "promo_id", seed)
    if rate < 1.0:
        one = fraction_sample(one, rate, ["order_id"], seed, "promo_tag")
    return dense_keys(one, ["order_id"], "promo_order_id").select(
        "promo_order_id", "promo_id", "order_id")
