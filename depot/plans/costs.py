"""Carrier driver costs and DC labor costs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depot.config import COMPANY_SHARE, COST_TYPES
from depot.config import DRIVER_RATE_FLOOR as LTL_FLOOR   # fallback when there is no LTL carrier
from depot.functions import rules as R
from depot.operators.joins import cross_literals
from depot.operators.keys import dense_keys


def cost_unpivot(rates: DataFrame) -> DataFrame:
    """Carrier rate columns to (cost_type, rate_amount) rows (H5)."""
    return rates.unpivot(["carrier_id", "carrier_type"], COST_TYPES, "cost_type", "rate_amount")


def company_driver_rates(rates: DataFrame) -> DataFrame:
    """Company carriers pay 0.8 x the lowest LTL rate per cost type (range
    floor when there is no LTL carrier); others keep their own rate (D12)."""
    long = cost_unpivot(rates)
    ltl_min = (long.filter(F.col("carrier_type") == "LTL").groupBy("cost_type")
               .agg(F.min("rate_amount").alias("_ltl_min")))
    floor = F.create_map(*[F.lit(x) for kv in LTL_FLOOR.items() for x in kv])
    j = long.join(ltl_min, "cost_type", "left")
    company = F.col("carrier_type") == "company"
    rate = F.when(company, F.coalesce(F.col("_ltl_min").cast("decimal(12,4)"),
                                      floor[F.col("cost_type")].cast("decimal(12,4)"))
                  * F.lit(COMPANY_SHARE).cast("decimal(3,2)")).otherwise(F.col("rate_amount"))
    return j.select("carrier_id", "cost_type", company.alias("company_driver"),
                    F.round(rate, 4).cast("decimal(12,4)").alias("rate_amount"))


def build_driver_costs(rates: DataFrame) -> DataFrame:
    """Driver rate table with the company rule and dense ids."""
    d = company_driver_rates(rates)
    return dense_keys(d, ["carrier_id", "cost_type"], "driver_cost_id").select(
        "driver_cost_id", "carrier_id", "company_driver", "cost_type", "rate_amount")


def weekly_load(orders: DataFrame) -> DataFrame:
    """Load factor per DC and week: the week's order count over the DC's
    mean weekly count (1.0 when the DC had no orders that week)."""
    wk = (orders.select("dc_id", F.date_trunc("week", "order_date").cast("date").alias("week_start_date"))
          .groupBy("dc_id", "week_start_date").agg(F.count(F.lit(1)).alias("_n")))
    mean = wk.groupBy("dc_id").agg(F.avg("_n").alias("_mean"))
    return wk.join(mean, "dc_id").select("dc_id", "week_start_date",
                                         F.round(F.col("_n") / F.col("_mean"), 4).alias("load_factor"))


def build_labor_costs(dcs: DataFrame, weeks: DataFrame, orders: DataFrame,
                      overtime_share_threshold: float = 1.25) -> DataFrame:
    """Weekly labor plan and cost by DC and department.

    hours = base[dept] x capacity scale x load factor (floor 1, 2 dp); a
    week whose load exceeds ``overtime_share_threshold`` is Overtime (x1.5
    rate); cost = hours x rate; headcount = max(1, floor(hours / 40))."""
    dd = cross_literals(dcs.select("dc_id", "capacity_units"), "department", list(R.DEPARTMENT_BASE_HOURS))
    grid = weeks.crossJoin(dd)                           # the plan has a row for each by definition
    load = weekly_load(orders)
    g = grid.join(load, ["dc_id", "week_start_date"], "left").withColumn(
        "load_factor", F.coalesce(F.col("load_factor"), F.lit(1.0)))
    g = g.withColumn("labor_type", F.when(F.col("load_factor") > overtime_share_threshold, "Overtime")
                     .otherwise("Regular"))
    g = g.withColumn("hours_worked", R.labor_hours("department", "capacity_units", F.col("load_factor")))
    g = g.withColumn("cost_per_hour", R.labor_rate("department", "labor_type"))
    out = g.select("dc_id", "week_start_date", "department",
                   R.map_lookup(R.DEPARTMENT_ROLE, F.col("department")).alias("role"), "labor_type",
                   F.col("hours_worked").cast("decimal(10,2)").alias("hours_worked"),
                   F.col("cost_per_hour").cast("decimal(8,2)").alias("cost_per_hour"),
                   F.round(F.col("hours_worked").cast("decimal(10,2)") * F.col("cost_per_hour").cast("decimal(8,2)"), 2)
                   .cast("decimal(14,2)").alias("total_cost"),
                   R.headcount("hours_worked").alias("headcount"))
    return dense_keys(out, ["dc_id", "department", "week_start_date"], "labor_id")
