"""Frequencies, future dates, regressor rows, baselines and the update stream."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesmill.forecasting import arima
from seriesmill.forecasting.arima import ArimaSpec
from seriesmill.forecasting.baselines import fit_baselines, forecast_baselines
from seriesmill.forecasting.dates import future_date, infer_frequency, parse_frequency
from seriesmill.forecasting.differencing import difference_polynomial
from seriesmill.forecasting.exog import last_rows, padded_future, unknown_ids
from seriesmill.streaming.updates import latest, publish, update_from_stream

DATES = {
    "MS": pd.date_range("2020-11-01", periods=5, freq="MS"),
    "ME": pd.date_range("2020-11-30", periods=5, freq="ME"),
    "QS": pd.date_range("2020-01-01", periods=5, freq="QS"),
    "QE": pd.date_range("2020-03-31", periods=5, freq="QE"),
    "YS": pd.date_range("2017-01-01", periods=4, freq="YS"),
    "2MS": pd.date_range("2020-01-01", periods=4, freq="2MS"),
    "D": pd.date_range("2021-02-26", periods=5, freq="D"),
    "3D": pd.date_range("2021-02-26", periods=5, freq="3D"),
    "W-SUN": pd.date_range("2021-01-03", periods=4, freq="W-SUN"),
    "W-MON": pd.date_range("2021-01-04", periods=4, freq="W-MON"),
    "B": pd.date_range("2021-01-06", periods=8, freq="B"),
    "h": pd.date_range("2021-01-01 22:00", periods=5, freq="h"),
    "15min": pd.date_range("2021-01-01", periods=5, freq="15min"),
    "250ms": pd.date_range("2021-01-01 23:59:59.5", periods=5, freq="250ms"),
    "1500us": pd.date_range("2021-01-01", periods=5, freq="1500us"),
}


def dated(spark, series):
    rows = [(u, d.to_pydatetime()) for u, ds in series.items() for d in ds]
    return spark.createDataFrame(rows, "unique_id string, ds timestamp_ntz").repartition(3)


def test_frequencies_and_next_dates(spark):
    found = infer_frequency(dated(spark, DATES))
    assert {r.unique_id: r.freq for r in found.collect()} == {u: u for u in DATES}
    last = spark.createDataFrame([(u, ds[-1].to_pydatetime()) for u, ds in DATES.items()], "unique_id string, last timestamp_ntz")
    steps = found.join(last, "unique_id").withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(4))))
    got = steps.select("unique_id", "i", future_date(F.col("last"), F.col("freq_unit"), F.col("freq_step"), F.col("i")).alias("ds"))
    by_id = got.orderBy("i").toPandas().groupby("unique_id")["ds"].apply(list)
    for u, ds in DATES.items():
        assert by_id[u] == list(pd.date_range(ds[-1], periods=5, freq=u)[1:]), u


def test_frequencies_do_not_depend_on_the_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        days = {"D": pd.date_range("2021-03-10", periods=8), "W-SUN": pd.date_range("2021-03-07", periods=4, freq="W-SUN")}
        assert {r.unique_id: r.freq for r in infer_frequency(dated(spark, days)).collect()} == {"D": "D", "W-SUN": "W-SUN"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_irregular_and_short_series_count_as_daily(spark):
    odd = {"gap": pd.to_datetime(["2021-01-01", "2021-02-01", "2021-04-01"]), "two": pd.to_datetime(["2021-01-01", "2021-02-01"])}
    assert {r.unique_id: r.freq for r in infer_frequency(dated(spark, odd)).collect()} == {"gap": "D", "two": "D"}


def test_month_end_sticks_to_the_end(spark):
    d = spark.createDataFrame([(dt.datetime(2021, 1, 31),), (dt.datetime(2021, 1, 15),)], "d timestamp_ntz")
    step = [future_date(F.col("d"), F.lit("month_end"), F.lit(1), F.lit(i)).alias(f"s{i}") for i in (1, 2)]
    got = [tuple(x.strftime("%m-%d") for x in r) for r in d.select(*step).collect()]
    assert got == [("02-28", "03-31"), ("01-31", "02-28")]


def test_weekday_dates_from_a_weekend(spark):
    d = spark.createDataFrame([(dt.datetime(2021, 1, 9),), (dt.datetime(2021, 1, 8),)], "d timestamp_ntz")
    got = [r[0].day for r in d.select(future_date(F.col("d"), F.lit("weekdays"), F.lit(1), F.lit(1))).collect()]
    assert got == [11, 11]


def test_parse_frequency():
    assert parse_frequency("MS") == ("MS", "month_start", 1)
    assert parse_frequency("2W") == ("2W", "seconds", 14 * 86400)
    assert parse_frequency("QE-DEC") == ("QE-DEC", "month_end", 3)
    assert parse_frequency("??")[0] == "D"


def test_difference_polynomial():
    assert difference_polynomial(2, 0, 0) == [1, -2, 1]
    want = np.convolve([1, -1], [1, 0, 0, 0, -1])
    assert difference_polynomial(1, 1, 4) == want.astype(int).tolist()


def test_padded_future(spark):
    fitted = spark.createDataFrame([("a",), ("b",), ("c",)], "unique_id string")
    rows = [("a", 3, 30.0), ("a", 1, 10.0), ("a", 2, None), ("b", 1, 5.0), ("z", 1, 1.0)]
    future = spark.createDataFrame(rows, "unique_id string, ds int, x double")
    got = padded_future(fitted, future, ["x"], 4).orderBy("unique_id", "step").collect()
    assert [tuple(r) for r in got] == [
        ("a", 1, 10.0), ("a", 2, None), ("a", 3, 30.0), ("a", 4, 30.0), ("b", 1, 5.0), ("b", 2, 5.0), ("b", 3, 5.0), ("b", 4, 5.0),
    ]
    assert [r[0] for r in unknown_ids(future, fitted).collect()] == ["z"]
    assert last_rows(future, "unique_id", "ds").where("unique_id = 'a'").first().x == 30.0


def test_baselines(spark):
    y = [3.0, 1.0, 4.0, 1.0, 5.0]
    ds = pd.date_range("2021-01-01", periods=5, freq="MS")
    df = spark.createDataFrame([("a", d.to_pydatetime(), v) for d, v in zip(ds, y)], "unique_id string, ds timestamp_ntz, y double")
    got = forecast_baselines(fit_baselines(df, season=3), 4).orderBy("step").toPandas()
    assert got["mean"].tolist() == [2.8] * 4 and got.naive.tolist() == [5.0] * 4
    assert got.seasonal_naive.tolist() == [4.0, 1.0, 5.0, 4.0]
    assert got.drift.tolist() == [5.5, 6.0, 6.5, 7.0]
    assert got.ds.tolist() == list(pd.date_range("2021-06-01", periods=4, freq="MS"))


def test_stream_of_updates_equals_fit_on_everything(spark, tmp_path):
    rng = np.random.default_rng(9)
    ds = pd.date_range("2015-01-01", periods=60, freq="MS")
    y = {u: np.cumsum(rng.normal(size=60)) for u in ("a", "b")}

    def rows(lo, hi):
        data = [(u, ds[i].to_pydatetime(), float(v[i])) for u, v in y.items() for i in range(lo, hi)]
        return spark.createDataFrame(data, "unique_id string, ds timestamp_ntz, y double")

    spec, folder, source = ArimaSpec((1, 1, 0), trend="c"), f"{tmp_path}/params", f"{tmp_path}/new"
    publish(folder, arima.fit(rows(0, 40), spec, freq="MS"))
    for lo, hi, checkpoint in ((40, 50, "cp"), (50, 55, "cp"), (55, 60, "cp-new")):
        if checkpoint == "cp-new":
            source += "-new"
        rows(lo, hi).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("unique_id string, ds timestamp_ntz, y double").parquet(source)
        writer = update_from_stream(stream, folder, update_params=True).option("checkpointLocation", f"{tmp_path}/{checkpoint}")
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
    got = latest(spark, folder).toPandas().set_index("unique_id")
    want = arima.fit(rows(0, 60), spec, freq="MS").toPandas().set_index("unique_id")
    for u in y:
        assert got.loc[u, "n_obs"] == 60
        np.testing.assert_allclose(got.loc[u, "ar"], want.loc[u, "ar"], rtol=1e-8)
        np.testing.assert_allclose(got.loc[u, "y_tail"], want.loc[u, "y_tail"])
    with pytest.raises(Exception, match="late or repeated"):
        arima.update_incremental(latest(spark, folder), rows(58, 60), update_params=False)
    with pytest.raises(Exception):
        rows(0, 1).withColumn("unique_id", F.lit("zz")).write.mode("append").parquet(source)
        update_from_stream(stream, folder).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
