"""Streams over the given tables."""

from pyspark.sql import functions as F

from ..session import scratch_path
from ..streaming.sums import append_closed_days, closed_days, daily_sums, monthly_sums
from .registry import register, rounded

_DAYS = """last AS (SELECT max(ts) - INTERVAL 2 DAY AS mark FROM events WHERE event_type IS NOT NULL),
  days AS (SELECT event_type, date_trunc('day', ts) AS day, count(*) AS n_rows, count(value) AS n_values, sum(value) AS amount
    FROM events, last WHERE event_type IS NOT NULL AND date_trunc('day', ts) + INTERVAL 1 DAY <= mark GROUP BY ALL)"""


def _closed(spark, sf_dir):
    """The days of ``events`` that its watermark closes, through a file stream."""
    path = f"{sf_dir}/events.parquet"
    pattern = f"{sf_dir}/events.parque[t]"  # a file stream takes a single file only by a pattern
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(pattern)
    days = daily_sums(stream.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "value", ["event_type"])
    folder = scratch_path(spark, "closed-days")
    append_closed_days(days, folder, scratch_path(spark, "checkpoint"))
    return closed_days(spark, folder, days)


@register(
    "h2_closed_days",
    f"WITH {_DAYS} SELECT event_type, CAST(day AS TIMESTAMP) AS day, n_rows, n_values, round(amount, 4) AS amount FROM days",
)
def h2_closed_days(spark, sf_dir):
    return rounded(_closed(spark, sf_dir), 4)


@register(
    "h2_monthly_sums_of_closed_days",
    f"""WITH {_DAYS} SELECT event_type, CAST(date_trunc('month', day) AS TIMESTAMP) AS month, count(DISTINCT day) AS n_days,
    CAST(sum(n_rows) AS BIGINT) AS n_rows, round(sum(amount), 4) AS amount FROM days GROUP BY ALL""",
)
def h2_monthly_sums_of_closed_days(spark, sf_dir):
    return rounded(monthly_sums(_closed(spark, sf_dir), ["event_type"]), 4)
