"""Sums per day of a stream, closed by a watermark, and sums per month over the closed days.

Months are no fixed windows, so the state holds days: a day is final, and leaves the state, once the watermark (the
latest time seen less the delay) has passed its end. Rows that come after that are dropped. Closed days are appended to a
table; a stream that is restarted goes on from its checkpoint and writes no day twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DELAY = "2 days"


def daily_sums(stream: DataFrame, time_col: str, value_col: str, group_cols: Sequence[str] = (), delay: str = DELAY) -> DataFrame:
    """group columns, day, n_rows, n_values and amount of every closed day; a missing time or group has no day."""
    value = F.col(value_col).cast("double")
    known = stream.where(" AND ".join(f"`{c}` IS NOT NULL" for c in (time_col, *group_cols)))
    days = known.withWatermark(time_col, delay).groupBy(F.window(time_col, "1 day"), *group_cols)
    sums = days.agg(F.count(F.lit(1)).alias("n_rows"), F.count(value).alias("n_values"), F.sum(value).alias("amount"))
    return sums.select(*group_cols, F.to_date("window.start").alias("day"), "n_rows", "n_values", "amount")


def append_closed_days(days: DataFrame, folder: str, checkpoint: str) -> None:
    """Read all there is now and append the days that this closes to ``folder``."""
    writer = days.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start(folder).awaitTermination()


def closed_days(spark: SparkSession, folder: str, days: DataFrame) -> DataFrame:
    """What has been appended so far."""
    return spark.read.schema(days.schema).parquet(folder)


def monthly_sums(closed: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """group columns, month, n_days, n_rows and amount over closed days."""
    month = F.trunc("day", "month").alias("month")
    return closed.groupBy(*group_cols, month).agg(
        F.count_distinct("day").alias("n_days"), F.sum("n_rows").alias("n_rows"), F.sum("amount").alias("amount")
    )
