"""Readers, saved artifacts, joins and sums."""

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from ..functions.calendar import ensure_datetime
from ..operators.enrich import enrich_product_customer, enrich_product_promotion, enrich_product_transaction
from ..session import scratch_path
from ..sources.artifacts import load_model, load_object, save_object
from ..sources.readers import get_loader, preview, read_csv
from .inputs import (
    BRAND_MONTHS, FACT, PART_MONTHS, PROMO, TOTAL_MONTHS, brand_months, customer_dim, four_decimals, part_months,
    product_dim, promo_dim, sales_by, sales_fact, summed_sales, table, total_months,
)
from .registry import register, rounded


@register(
    "s1_csv_scan",
    f"""WITH {FACT} SELECT order_date, amount AS sales_amount, product_id, customer_id,
    CAST(promotion_id AS BIGINT) AS promotion_id FROM fact""",
)
def s1_csv_scan(spark, sf_dir):
    path = scratch_path(spark, "sales-csv")
    sales_fact(spark, sf_dir).write.option("header", True).csv(path)
    return ensure_datetime(get_loader(spark, {"type": "csv", "filepath": path}).load())


@register(
    "s1_csv_scan_hard_cells",
    """SELECT event_id + 9000000000000000000 AS event_id, user_id AS blank_user,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id + 9000000000000000000 AS VARCHAR) END AS gappy_id,
    '9' || (event_id + 9000000000000000000) AS beyond_64_bits, event_type || ', first' || chr(10) || 'second "line"' AS note
    FROM events""",
)
def s1_csv_scan_hard_cells(spark, sf_dir):
    """Ids of 19 digits with and without gaps, blanks around numbers, separators, quotes and line breaks in texts."""
    path = scratch_path(spark, "events-csv")
    long_id = F.col("event_id") + 9000000000000000000
    cells = table(spark, sf_dir, "events").select(
        long_id.alias("event_id"),
        F.concat(F.lit(" "), F.col("user_id").cast("string"), F.lit("  ")).alias("blank_user"),
        F.when(F.col("event_id") % 3 != 0, long_id).alias("gappy_id"),
        F.concat(F.lit("9"), long_id.cast("string")).alias("beyond_64_bits"),
        F.concat("event_type", F.lit(', first\nsecond "line"')).alias("note"),
    )
    writer = cells.write.option("header", True).option("escape", '"').option("quoteAll", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    read = get_loader(spark, {"type": "csv", "filepath": path, "multi_line": True}).load()
    return read.withColumn("gappy_id", F.col("gappy_id").cast("string"))


@register("s1_csv_scan_semicolon", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s1_csv_scan_semicolon(spark, sf_dir):
    path = scratch_path(spark, "customer-csv")
    customers = table(spark, sf_dir, "customer")
    customers.write.option("header", True).option("sep", ";").csv(path)
    return read_csv(spark, path, ";", customers.schema)


@register("s2_table_scan", "SELECT * FROM part")
def s2_table_scan(spark, sf_dir):
    table(spark, sf_dir, "part").createOrReplaceTempView("sales_part")
    return get_loader(spark, {"type": "table", "table_id": "sales_part"}).load()


@register(
    "s3_query_scan",
    "SELECT p_brand, count(*) AS products, max(p_size) AS largest FROM part WHERE p_size > 10 GROUP BY p_brand",
)
def s3_query_scan(spark, sf_dir):
    table(spark, sf_dir, "part").createOrReplaceTempView("sales_part")
    return get_loader(spark, {"type": "table"}).load(
        query="SELECT p_brand, count(*) AS products, max(p_size) AS largest FROM sales_part WHERE p_size > 10 GROUP BY p_brand"
    )


@register("s4_loader_factory", "SELECT * FROM supplier")
def s4_loader_factory(spark, sf_dir):
    return get_loader(spark, {"type": "parquet", "filepath": f"{sf_dir}/supplier.parquet"}).load()


@register(
    "s7_s8_table_round_trip",
    f"WITH {BRAND_MONTHS} SELECT p_brand, period, round(sales_amount, 6) AS sales_amount, yearmonth FROM monthly",
)
def s7_s8_table_round_trip(spark, sf_dir):
    path = f"{scratch_path(spark, 'artifact')}/nested/table"
    save_object(path, brand_months(spark, sf_dir))
    return rounded(load_object(spark, path))


@register(
    "s7_s8_model_round_trip",
    """WITH line AS (SELECT regr_slope(o_totalprice, o_custkey) AS b, regr_intercept(o_totalprice, o_custkey) AS a FROM orders)
    SELECT o_orderkey, round(a + b * o_custkey, 3) AS prediction FROM orders, line""",
)
def s7_s8_model_round_trip(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    line = LinearRegression(featuresCol="x", labelCol="o_totalprice", solver="normal", standardization=False)
    model = Pipeline(stages=[VectorAssembler(inputCols=["o_custkey"], outputCol="x"), line]).fit(orders)
    path = scratch_path(spark, "model")
    save_object(path, model)
    return rounded(load_model(path).transform(orders).select("o_orderkey", "prediction"), 3)


# --- joins ----------------------------------------------------------------------------------------


@register(
    "j1_sales_with_product",
    f"""WITH {FACT} SELECT order_date, amount AS sales_amount, product_id, customer_id, promotion_id,
    p_brand, p_type FROM fact LEFT JOIN part ON product_id = p_partkey""",
)
def j1_sales_with_product(spark, sf_dir):
    return enrich_product_transaction(sales_fact(spark, sf_dir), product_dim(spark, sf_dir))


@register(
    "j2_sales_with_customer",
    f"""WITH {FACT} SELECT order_date, amount AS sales_amount, product_id, customer_id, promotion_id,
    c_mktsegment, c_nationkey FROM fact LEFT JOIN customer ON customer_id = c_custkey""",
)
def j2_sales_with_customer(spark, sf_dir):
    return enrich_product_customer(sales_fact(spark, sf_dir), customer_dim(spark, sf_dir))


@register(
    "j3_sales_with_promotion",
    f"""WITH {FACT}, {PROMO} SELECT order_date, amount AS sales_amount, product_id, customer_id,
    fact.promotion_id, promo_name, promo_class FROM fact LEFT JOIN promo ON fact.promotion_id = promo.promotion_id""",
)
def j3_sales_with_promotion(spark, sf_dir):
    return enrich_product_promotion(sales_fact(spark, sf_dir), promo_dim(spark, sf_dir))


@register(
    "j3_missing_promotion_matches_missing",
    f"""WITH {FACT}, {PROMO}, f AS (SELECT * REPLACE (nullif(promotion_id, 0) AS promotion_id) FROM fact),
    d AS (SELECT * REPLACE (nullif(promotion_id, 0) AS promotion_id) FROM promo)
    SELECT promo_name, count(*) AS lines, CAST(sum(sales_amount) AS DOUBLE) AS sales_amount
    FROM f LEFT JOIN d ON f.promotion_id IS NOT DISTINCT FROM d.promotion_id GROUP BY promo_name""",
)
def j3_missing_promotion_matches_missing(spark, sf_dir):
    no_zero = {"promotion_id": F.nullif("promotion_id", F.lit(0))}
    fact, promo = sales_fact(spark, sf_dir).withColumns(no_zero), promo_dim(spark, sf_dir).withColumns(no_zero)
    joined = enrich_product_promotion(fact, promo)
    return joined.groupBy("promo_name").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("sales_amount").alias("sales_amount")
    ).withColumn("sales_amount", four_decimals("sales_amount"))


# --- sums -----------------------------------------------------------------------------------------


@register(
    "g1_monthly_sales",
    f"WITH {BRAND_MONTHS} SELECT p_brand, period, round(sales_amount, 6) AS sales_amount, yearmonth FROM monthly",
)
def g1_monthly_sales(spark, sf_dir):
    return rounded(brand_months(spark, sf_dir))


@register(
    "g1_monthly_sales_by_product",
    f"WITH {PART_MONTHS} SELECT product_id, period, round(sales_amount, 6) AS sales_amount, yearmonth FROM part_monthly",
)
def g1_monthly_sales_by_product(spark, sf_dir):
    return rounded(part_months(spark, sf_dir))


@register(
    "g2_weekly_sales",
    f"""WITH {FACT} SELECT p_brand, CAST(date_trunc('week', order_date) AS TIMESTAMP) AS period,
    round(CAST(sum(sales_amount) AS DOUBLE), 6) AS sales_amount
    FROM fact JOIN part ON product_id = p_partkey GROUP BY ALL""",
)
def g2_weekly_sales(spark, sf_dir):
    return rounded(sales_by(spark, sf_dir, ["p_brand"], "W").drop("yearmonth"))


@register(
    "g3_sales_by_date",
    f"""WITH {FACT} SELECT p_type, order_date AS period, round(CAST(sum(sales_amount) AS DOUBLE), 6) AS sales_amount,
    strftime(order_date, '%Y-%m') AS yearmonth FROM fact JOIN part ON product_id = p_partkey GROUP BY ALL""",
)
def g3_sales_by_date(spark, sf_dir):
    return rounded(sales_by(spark, sf_dir, ["p_type"], "D"))


@register(
    "g4_total_monthly_sales",
    f"WITH {TOTAL_MONTHS} SELECT period, round(sales_amount, 6) AS sales_amount, yearmonth FROM total",
)
def g4_total_monthly_sales(spark, sf_dir):
    return rounded(total_months(spark, sf_dir))


@register(
    "g5_week_label",
    f"""WITH {FACT} SELECT CAST(date_trunc('week', order_date) AS TIMESTAMP) AS period,
    strftime(date_trunc('week', order_date), '%Y-%m') AS yearmonth, round(CAST(sum(sales_amount) AS DOUBLE), 6) AS sales_amount
    FROM fact GROUP BY ALL""",
)
def g5_week_label(spark, sf_dir):
    return rounded(summed_sales(sales_fact(spark, sf_dir), None, "W"))


@register("g6_first_year", "SELECT CAST(min(year(o_orderdate)) AS INTEGER) AS first_year FROM orders")
def g6_first_year(spark, sf_dir):
    return table(spark, sf_dir, "orders").agg(F.min(F.year("o_orderdate")).alias("first_year"))


@register(
    "o1_sorted_sales",
    f"""WITH {BRAND_MONTHS} SELECT p_brand, period, round(sales_amount, 6) AS sales_amount, yearmonth FROM monthly
    ORDER BY p_brand, period""",
)
def o1_sorted_sales(spark, sf_dir):
    return rounded(brand_months(spark, sf_dir)).orderBy("p_brand", "period")


@register("o6_preview", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 5")
def o6_preview(spark, sf_dir):
    return preview(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice"), ["o_orderdate", "o_orderkey"])
