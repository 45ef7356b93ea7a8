"""Customer snapshot built from the star schema (customer, orders, lineitem).

One row per customer with order history before the cut-off date. Lines are
pre-aggregated per order before the join and orders per customer after it,
so a hot order or customer is reduced map-side. Money and quantities have two
decimals and are summed as whole hundredths, which keeps the sums exact and
independent of task order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the snapshot definition.
CUTOFF = "2001-01-01"
RECENT_FROM = "2000-07-05"
PRIOR_FROM = "2000-01-07"
RETENTION_FROM = "2000-10-03"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hundredths(c: str) -> Column:
    return F.rint(F.col(c) * 100).cast("bigint")


def _ratio(recent: Column, prior: Column) -> Column:
    return F.round((recent - prior) / F.nullif(prior, F.lit(0.0)), 6)


def build_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        _hundredths("o_totalprice").alias("price"),
        F.col("o_orderdate").cast("date").alias("day"))
    qty = _hundredths("l_quantity")
    lines = (
        read_table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sum(qty).alias("qty"),
             F.sum(F.when(F.col("l_discount") >= 0.08, qty)).alias("over_qty"),
             F.count_if(F.col("l_returnflag") == "R").alias("returned")))

    cutoff = F.lit(CUTOFF).cast("date")
    history = F.col("day") < cutoff
    recent = history & (F.col("day") >= F.lit(RECENT_FROM).cast("date"))
    prior = (F.col("day") >= F.lit(PRIOR_FROM).cast("date")) & (
        F.col("day") < F.lit(RECENT_FROM).cast("date"))
    urgent = (history & (F.col("day") >= F.lit(RETENTION_FROM).cast("date"))
              & (F.col("o_orderpriority") == "1-URGENT"))

    def total(measure: str, where: Column) -> Column:
        return F.sum(F.when(where, F.col(measure))) / 100.0

    activity = (
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .groupBy("o_custkey")
        .agg(
            F.count_if(history).alias("n_history"),
            F.count_if(~history).alias("n_after"),
            total("price", recent).alias("rev_recent"),
            total("price", prior).alias("rev_prior"),
            total("price", history).alias("rev_all"),
            total("qty", recent).alias("qty_recent"),
            total("qty", prior).alias("qty_prior"),
            total("qty", history).alias("qty_all"),
            total("over_qty", history).alias("qty_over"),
            F.sum(F.when(history, F.col("returned"))).alias("returned"),
            F.count_if(history & (F.col("o_orderstatus") == "P")).alias("care"),
            F.count_if(history & (F.col("day") >= F.lit(PRIOR_FROM).cast("date"))).alias("active"),
            F.min(F.when(history, F.col("day"))).alias("first_day"),
            F.max(F.when(history, F.col("day"))).alias("last_day"),
            F.count_if(urgent).alias("urgent"),
            F.count_if(urgent & (F.col("o_orderstatus") == "F")).alias("urgent_done"))
        .where(F.col("n_history") > 0))

    key, bal, nation = F.col("c_custkey"), F.col("c_acctbal"), F.col("c_nationkey")
    no_household = key % 53 == 0
    credit = (F.when(bal < 0, "7-Lowest").when(bal < 1500, "6-VeryLow").when(bal < 3000, "5-Low")
              .when(bal < 4500, "4-Medium").when(bal < 6000, "3-Good").when(bal < 8000, "2-High")
              .otherwise("1-Highest"))
    area = F.concat(F.lpad(nation.cast("string"), 3, "0"),
                    F.upper(F.substring("c_mktsegment", 1, 3)),
                    F.lpad((key % 1000).cast("string"), 3, "0"))
    zero = F.lit(0.0)
    return activity.join(customer, F.col("o_custkey") == key).select(
        key.cast("bigint").alias("customer_id"),
        F.when(F.col("n_after") == 0, "Yes").otherwise("No").alias("churn"),
        F.round(F.col("rev_recent") / 6, 4).alias("monthly_revenue"),
        _ratio(F.col("rev_recent"), F.col("rev_prior")).alias("perc_change_revenues"),
        F.coalesce("qty_all", zero).alias("monthly_minutes"),
        F.coalesce("qty_over", zero).alias("overage_minutes"),
        (F.col("rev_all") / F.col("n_history")).alias("total_recurring_charge"),
        _ratio(F.col("qty_recent"), F.col("qty_prior")).alias("perc_change_minutes"),
        F.coalesce("returned", F.lit(0)).cast("double").alias("dropped_blocked_calls"),
        F.col("care").cast("double").alias("customer_care_calls"),
        F.col("active").cast("double").alias("active_subs"),
        F.floor(F.datediff(cutoff, "first_day") / 30.0).cast("double").alias("months_in_service"),
        F.datediff(cutoff, "last_day").cast("double").alias("current_equipment_days"),
        F.when(no_household, F.lit(None)).when(nation % 3 == 0, zero)
        .otherwise((20 + key % 50).cast("double")).alias("age_hh1"),
        F.when(no_household, F.lit(None)).when(nation % 2 == 0, zero)
        .otherwise((18 + key % 60).cast("double")).alias("age_hh2"),
        F.when(key % 97 != 0, area).alias("service_area"),
        F.when(bal < 0, "Unknown")
        .otherwise((F.floor(bal / 100) * 10).cast("bigint").cast("string")).alias("handset_price"),
        credit.alias("credit_rating"),
        F.when(key % 3 == 0, "Yes").when(key % 3 == 1, "No").otherwise("Unknown")
        .alias("marital_status"),
        F.when(key % 7 == 0, "No").otherwise("Yes").alias("handset_web_capable"),
        F.col("urgent").cast("double").alias("retention_calls"),
        F.col("urgent_done").cast("double").alias("retention_offers_accepted"),
        F.when(F.col("urgent") > 0, "Yes").otherwise("No").alias("made_call_to_retention_team"))
