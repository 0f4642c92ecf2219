"""Customer-side tables: account hierarchy, account master, rep assignment
and customer contacts."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depot import config as C
from depot.functions import rules as R
from depot.functions.draws import keyed_uniform
from depot.operators.keys import dense_keys
from depot.operators.windows import seq_within
from depot.session import stored


def reps_by_region(reps: DataFrame) -> DataFrame:
    """The reps of each region in order of their id (D7): a row per rep with
    its place in the region and the region's size, never a list of a region."""
    placed = seq_within(reps.select("region", "rep_id"), ["region"], ["rep_id"], "place")
    sizes = placed.groupBy("region").agg(F.count(F.lit(1)).alias("n_reps"))
    return placed.join(sizes, "region").select("region", "place", "rep_id", "n_reps")


def account_hierarchy(customers: DataFrame) -> DataFrame:
    """Masters with their sub-accounts: account count and rolled-up credit
    limit (C11).  A self-join on the master id, then an aggregate."""
    masters = customers.filter(~F.col("is_sub")).select(F.col("customer_id").alias("master_id"))
    return (customers.select("master_id", "credit_limit").join(masters, "master_id")
            .groupBy("master_id").agg(F.count(F.lit(1)).alias("n_accounts"),
                                      F.sum("credit_limit").cast("decimal(18,2)").alias("total_credit_limit")))


def build_customers(customers: DataFrame) -> DataFrame:
    """Account master (I28): master/sub account codes (B17) and the credit
    limit held at master level (subs carry their master's limit)."""
    masters = customers.filter(~F.col("is_sub")).select(F.col("customer_id").alias("master_id"),
                                                        F.col("credit_limit").alias("master_limit"))
    return (customers.join(masters, "master_id", "left")
            .select("customer_id", "customer_name",
                    R.account_number("M", "master_id").alias("master_account_number"),
                    F.when(F.col("is_sub"), R.account_number("S", "customer_id")).alias("sub_account_number"),
                    "segment", "region",
                    F.coalesce("master_limit", "credit_limit").cast("decimal(12,2)").alias("credit_limit"),
                    F.col("discount_percentage").cast("decimal(5,2)").alias("discount_percentage")))


def contact_reps(customers: DataFrame, reps: DataFrame, seed: int = C.SEED) -> DataFrame:
    """Primary rep (balanced by key over the region's reps, any rep when
    the region has none) and a secondary rep (another rep of the region,
    else any other rep, else any) for every customer (C10, D7).

    Reps are ranked once, by region and id: the rank is the place over all, and
    minus the region's first rank the place in the region.  A customer's choice
    is such a place, met by an equi-join on (pool, place).  No list of reps is
    collected and no customer x rep pairs are formed."""
    every = dense_keys(reps.select("rep_id", "region"), ["region", "rep_id"], "_all")
    first = every.groupBy("region").agg(F.min("_all").alias("_first"))
    regional = every.join(first, "region").withColumn("_own", F.col("_all") - F.col("_first") + 1)
    name = F.concat(F.lit("region/"), F.col("region"))
    pools = stored(regional.select(name.alias("_pool"), (F.col("_own") - 1).alias("_at"), "rep_id", (F.col("_all") - 1).alias("_all_at"))
                   .unionByName(every.select(F.lit("all").alias("_pool"), (F.col("_all") - 1).alias("_at"), "rep_id", (F.col("_all") - 1).alias("_all_at"))),
                   "rep-pools")
    sizes = pools.groupBy("_pool").agg(F.count(F.lit(1)).alias("_size"))
    total = pools.filter("_pool = 'all'").agg(F.count(F.lit(1)).alias("_total"))
    c = (customers.select("customer_id", "segment", "is_sub", name.alias("_region"))
         .join(sizes.select(F.col("_pool").alias("_region"), "_size"), "_region", "left").crossJoin(total))
    c = (c.withColumn("_pool", F.when(F.col("_size").isNotNull(), F.col("_region")).otherwise("all"))
         .withColumn("_size", F.coalesce("_size", "_total")).withColumn("_at", F.expr("pmod(customer_id, _size)")))
    c = c.join(pools.withColumnRenamed("rep_id", "primary_rep_id"), ["_pool", "_at"])
    # the secondary: a place among the others of the pool, else among all others, else the one rep there is
    u = keyed_uniform(seed, "rep2", "customer_id")
    own, other = F.floor(u * (F.col("_size") - 1)), F.floor(u * (F.col("_total") - 1))
    skip = lambda place, taken: place + F.when(place >= taken, 1).otherwise(0)
    c = c.select("customer_id", "segment", "is_sub", "primary_rep_id",
                 F.when(F.col("_size") > 1, F.col("_pool")).otherwise("all").alias("_pool"),
                 F.when(F.col("_size") > 1, skip(own, F.col("_at")))
                 .when(F.col("_total") > 1, skip(other, F.col("_all_at"))).otherwise(F.lit(0)).cast("long").alias("_at"))
    return (c.join(pools.select("_pool", "_at", F.col("rep_id").alias("secondary_rep_id")), ["_pool", "_at"])
            .select("customer_id", "segment", "is_sub", "primary_rep_id", "secondary_rep_id"))


def build_customer_contacts(customers: DataFrame, reps: DataFrame, as_of: _dt.date = C.AS_OF,
                            seed: int = C.SEED) -> DataFrame:
    """One contact per customer with its primary rep and role (B33), plus an
    Inside Sales contact with the secondary rep for Corporate and Government
    accounts (I26).  Ids are dense over (customer, contact order)."""
    r = contact_reps(customers, reps, seed)
    first = r.select("customer_id", F.lit(0).alias("seq"), F.col("primary_rep_id").alias("rep_id"),
                     R.contact_role("segment", "is_sub").alias("role"),
                     F.date_sub(F.lit(as_of), (F.col("customer_id") % 181).cast("int")).alias("last_contact_date"))
    second = (r.filter(F.col("segment").isin("Corporate", "Government"))
              .select("customer_id", F.lit(1).alias("seq"), F.col("secondary_rep_id").alias("rep_id"),
                      F.lit("Inside Sales").alias("role"),
                      F.date_sub(F.lit(as_of), (F.col("customer_id") * 7 % 181).cast("int")).alias("last_contact_date")))
    both = first.unionByName(second)
    return dense_keys(both, ["customer_id", "seq"], "contact_id").select(
        "contact_id", "customer_id", "rep_id", "role", "last_contact_date")
