"""Inputs of the queries: the given tables and the sales model derived from them, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregate import aggregate_sales
from ..operators.enrich import enrich_product_transaction
from ..operators.split import time_series_split

CUTOFF = "2000-07-01"  # first day of a month, so that a cut of the fact is a cut of the months
PROMOTION_LEFT_OUT = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales_fact(spark: SparkSession, sf_dir: str, since: str | None = None, before: str | None = None) -> DataFrame:
    """One row per sold line: order_date, sales_amount, product_id, customer_id, promotion_id.

    ``since`` and ``before`` bound the order date in the scan of the orders.
    """
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    if since:
        orders = time_series_split(orders, since, "o_orderdate")[1]
    if before:
        orders = time_series_split(orders, before, "o_orderdate")[0]
    amount = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_orderdate").alias("order_date"),
        amount.alias("sales_amount"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_custkey").alias("customer_id"),
        F.round(F.col("l_discount") * 100).cast("int").alias("promotion_id"),
    )


FACT = """fact AS (
  SELECT o_orderdate AS order_date, l_extendedprice * (1 - l_discount) AS amount,
         CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS sales_amount,
         l_partkey AS product_id, o_custkey AS customer_id, CAST(round(l_discount * 100) AS INTEGER) AS promotion_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_id"), "p_brand", "p_type")


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"), "c_mktsegment", "c_nationkey")


def promo_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promotions found in the sales lines, without one, so that some lines have none."""
    ids = table(spark, sf_dir, "lineitem").select(F.round(F.col("l_discount") * 100).cast("int").alias("promotion_id"))
    known = ids.where(F.col("promotion_id") != PROMOTION_LEFT_OUT).distinct()
    deep = F.when(F.col("promotion_id") >= 5, "deep").otherwise("light")
    return known.withColumns({"promo_name": F.concat(F.lit("promo-"), "promotion_id"), "promo_class": deep})


PROMO = f"""promo AS (
  SELECT DISTINCT CAST(round(l_discount * 100) AS INTEGER) AS promotion_id,
         'promo-' || CAST(round(l_discount * 100) AS INTEGER) AS promo_name,
         CASE WHEN round(l_discount * 100) >= 5 THEN 'deep' ELSE 'light' END AS promo_class
  FROM lineitem WHERE CAST(round(l_discount * 100) AS INTEGER) <> {PROMOTION_LEFT_OUT})"""


def four_decimals(total: str) -> Column:
    """A sum of amounts with four decimals, without what the order of the additions leaves in the last bits."""
    return F.rint(F.col(total) * 1e4) / 1e4


def summed_sales(fact: DataFrame, groups: list[str] | None, freq: str = "M") -> DataFrame:
    sums = aggregate_sales(fact, "sales_amount", groups, freq)
    return sums.withColumn("sales_amount", four_decimals("sales_amount"))


def sales_by(spark: SparkSession, sf_dir: str, groups: list[str], freq: str = "M", **dates: str) -> DataFrame:
    enriched = enrich_product_transaction(sales_fact(spark, sf_dir, **dates), product_dim(spark, sf_dir))
    return summed_sales(enriched, groups, freq)


def brand_months(spark: SparkSession, sf_dir: str, **dates: str) -> DataFrame:
    """Monthly sales per brand: p_brand, period, sales_amount, yearmonth."""
    return sales_by(spark, sf_dir, ["p_brand"], **dates)


def part_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly sales per product; most series have gaps."""
    return summed_sales(sales_fact(spark, sf_dir), ["product_id"])


BRAND_MONTHS = f"""{FACT}, monthly AS (
  SELECT p_brand, CAST(date_trunc('month', order_date) AS TIMESTAMP) AS period,
         CAST(sum(sales_amount) AS DOUBLE) AS sales_amount, strftime(date_trunc('month', order_date), '%Y-%m') AS yearmonth
  FROM fact JOIN part ON product_id = p_partkey GROUP BY ALL)"""

PART_MONTHS = f"""{FACT}, part_monthly AS (
  SELECT product_id, CAST(date_trunc('month', order_date) AS TIMESTAMP) AS period,
         CAST(sum(sales_amount) AS DOUBLE) AS sales_amount, strftime(date_trunc('month', order_date), '%Y-%m') AS yearmonth
  FROM fact GROUP BY ALL)"""


def total_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series: total sales per month."""
    return summed_sales(sales_fact(spark, sf_dir), None)


TOTAL_MONTHS = f"""{FACT}, total AS (
  SELECT CAST(date_trunc('month', order_date) AS TIMESTAMP) AS period, CAST(sum(sales_amount) AS DOUBLE) AS sales_amount,
         strftime(date_trunc('month', order_date), '%Y-%m') AS yearmonth
  FROM fact GROUP BY ALL)"""


def brand_panel(spark: SparkSession, sf_dir: str, **dates: str) -> DataFrame:
    """unique_id, ds, y of the monthly brand sales."""
    return brand_months(spark, sf_dir, **dates).select(
        F.col("p_brand").alias("unique_id"), F.col("period").cast("timestamp_ntz").alias("ds"), F.col("sales_amount").alias("y")
    )


PANEL = f"""{BRAND_MONTHS}, panel AS (
  SELECT p_brand AS unique_id, CAST(period AS TIMESTAMP) AS ds, sales_amount AS y FROM monthly)"""


def brand_panel_with_orders(spark: SparkSession, sf_dir: str, **dates: str) -> DataFrame:
    """The brand panel with one regressor: the number of lines sold."""
    enriched = enrich_product_transaction(sales_fact(spark, sf_dir, **dates), product_dim(spark, sf_dir))
    month = F.date_trunc("month", "order_date").cast("timestamp_ntz")
    sums = enriched.groupBy(F.col("p_brand").alias("unique_id"), month.alias("ds")).agg(
        F.sum("sales_amount").alias("y"), F.count(F.lit(1)).cast("double").alias("n_lines")
    )
    return sums.withColumn("y", four_decimals("y"))


PANEL_X = f"""{FACT}, panel AS (
  SELECT p_brand AS unique_id, CAST(date_trunc('month', order_date) AS TIMESTAMP) AS ds,
         CAST(sum(sales_amount) AS DOUBLE) AS y, CAST(count(*) AS DOUBLE) AS n_lines
  FROM fact JOIN part ON product_id = p_partkey GROUP BY ALL)"""


def seasonal_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual monthly brand sales and, as forecast, the sales of 12 rows before."""
    from ..operators.features import add_lag_features

    lagged = add_lag_features(brand_months(spark, sf_dir), "sales_amount", ["p_brand"], [12], ["period"], "short")
    return lagged.where("sales_amount_lag12 IS NOT NULL").select(
        "p_brand", "period", F.col("sales_amount").alias("actual"), F.col("sales_amount_lag12").alias("forecast")
    )


PAIRS = f"""{BRAND_MONTHS}, lagged AS (
  SELECT p_brand, period, sales_amount AS actual, lag(sales_amount, 12) OVER (PARTITION BY p_brand ORDER BY period) AS forecast
  FROM monthly), pairs AS (SELECT * FROM lagged WHERE forecast IS NOT NULL)"""
