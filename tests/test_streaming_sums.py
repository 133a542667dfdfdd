"""Sums per day closed by a watermark: late rows, restarts, missing values."""

from datetime import date

from pyspark.sql import functions as F

from seriesmill.streaming.sums import append_closed_days, closed_days, daily_sums, monthly_sums

SCHEMA = "ts timestamp, kind string, value double"


def test_late_rows_and_restart(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))

    def add(*rows):
        df = spark.createDataFrame(rows, "ts string, kind string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(source)

    def run():
        days = daily_sums(spark.readStream.schema(SCHEMA).parquet(source), "ts", "value", ["kind"], "1 day")
        append_closed_days(days, out, check)
        found = closed_days(spark, out, days)
        return sorted(tuple(r) for r in found.collect()), found

    add(("2024-01-30 10:00:00", "a", 1.0), ("2024-01-30 11:00:00", "a", None), ("2024-01-31 23:59:59", "b", 2.0),
        ("2024-02-03 00:00:00", "a", 4.0), (None, "a", 9.0), ("2024-01-30 10:00:00", None, 9.0))
    first = [("a", date(2024, 1, 30), 2, 1, 1.0), ("b", date(2024, 1, 31), 1, 1, 2.0)]
    assert run()[0] == first
    assert run()[0] == first  # started again, nothing new
    # 30 January is closed, so its row is too late; 2 and 3 February are open
    add(("2024-01-30 12:00:00", "a", 100.0), ("2024-02-02 12:00:00", "a", 8.0), ("2024-02-03 05:00:00", "a", 16.0), ("2024-02-09 00:00:00", "a", 32.0))
    got, found = run()
    assert got == sorted([*first, ("a", date(2024, 2, 2), 1, 1, 8.0), ("a", date(2024, 2, 3), 2, 2, 20.0)])
    months = sorted(tuple(r) for r in monthly_sums(found, ["kind"]).collect())
    assert months == [("a", date(2024, 1, 1), 1, 2, 1.0), ("a", date(2024, 2, 1), 2, 3, 28.0), ("b", date(2024, 1, 1), 1, 1, 2.0)]
