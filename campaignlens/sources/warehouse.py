"""Raw customer table assembled from customer, order, line and event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from campaignlens.functions.numeric import count_where
from campaignlens.settings import CAMPAIGN_COLUMNS

WAREHOUSE_REFERENCE_YEAR = 2001
WAREHOUSE_REFERENCE_DATE = "2001-12-31"
DEAL_DISCOUNT = 0.085
CAMPAIGN_ORDER_VALUE = 450000
FIRST_CAMPAIGN_YEAR = 1995
USERS_PER_EVENT_ID = 10


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def order_history(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Order behaviour per customer, from one pass over orders.

    Lines are reduced to the ids of discounted orders before they meet the orders, and the
    per-customer sums are combined on the map side, so a customer with very many orders is
    only one row per task in the shuffle.
    """
    deal_orders = (
        lineitem.where(F.col("l_discount") > DEAL_DISCOUNT)
        .select(F.col("l_orderkey").alias("o_orderkey"))
        .distinct()
        .withColumn("has_deal", F.lit(True))
    )
    priority = F.col("o_orderpriority")
    year = F.year("o_orderdate")
    large = F.col("o_totalprice") > CAMPAIGN_ORDER_VALUE
    campaigns = [
        F.max(F.when(large & (year == FIRST_CAMPAIGN_YEAR + k), 1).otherwise(0)).alias(name)
        for k, name in enumerate(CAMPAIGN_COLUMNS)
    ]
    return (
        orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")
        .join(deal_orders, "o_orderkey", "left")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.min("o_orderdate").alias("first_order"),
            count_where(priority.isin("1-URGENT", "2-HIGH")).alias("web"),
            count_where(priority == "3-MEDIUM").alias("catalog"),
            count_where(priority.isin("4-NOT SPECIFIED", "5-LOW")).alias("store"),
            count_where(F.col("has_deal")).alias("deals"),
            *campaigns,
        )
    )


def view_counts(events: DataFrame) -> DataFrame:
    return (
        events.where(F.col("event_type") == "view")
        .groupBy(F.col("user_id").alias("visitor"))
        .agg(F.count(F.lit(1)).alias("visits"))
    )


def simulated_response(customer: Column, prior: Column, income: Column) -> Column:
    """Deterministic response flag whose rate rises with prior acceptances and income."""
    draw = F.conv(F.substring(F.md5(F.concat(customer.cast("string"), F.lit("|resp")).cast("binary")), 1, 8), 16, 10)
    cut = F.lit(8) + F.lit(15) * prior + F.when(income > 80000, F.lit(8)).otherwise(F.lit(0))
    return (F.pmod(draw.cast("bigint"), F.lit(100)) < cut).cast("int")


def raw_customers(spark: SparkSession, directory: str) -> DataFrame:
    """The raw customer table (one row per customer, 15 columns)."""
    customer = read_table(spark, directory, "customer").select("c_custkey", "c_acctbal")
    history = order_history(read_table(spark, directory, "orders"), read_table(spark, directory, "lineitem"))
    views = view_counts(read_table(spark, directory, "events"))

    joined = (
        customer.join(history, "c_custkey", "left")
        .withColumn("visitor", F.floor(F.col("c_custkey") / USERS_PER_EVENT_ID))
        .join(views, "visitor", "left")
        .withColumn("income", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") * 10))
    )
    count = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("int")
    prior = sum((count(c) for c in CAMPAIGN_COLUMNS), F.lit(0))
    return joined.select(
        F.col("c_custkey").alias("ID"),
        (F.lit(1927) + F.pmod(F.col("c_custkey") * 37, F.lit(60))).cast("int").alias("Year_Birth"),
        F.col("income").alias("Income"),
        F.date_format("first_order", "dd-MM-yyyy").alias("Dt_Customer"),
        count("web").alias("NumWebPurchases"),
        count("catalog").alias("NumCatalogPurchases"),
        count("store").alias("NumStorePurchases"),
        count("deals").alias("NumDealsPurchases"),
        count("visits").alias("NumWebVisitsMonth"),
        *[count(c).alias(c) for c in CAMPAIGN_COLUMNS],
        simulated_response(F.col("c_custkey"), prior, F.coalesce(F.col("income"), F.lit(0.0))).alias("Response"),
    )
