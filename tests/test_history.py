"""Stored observations: pruned buckets, states that stay, failed appends, and updates of models that use them."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesmill.forecasting.history import BUCKET, VERSION, SeriesHistory
from seriesmill.forecasting.models import ArimaModel

from .test_arima import to_panel


def observed(df):
    return sorted(map(tuple, df.select("unique_id", "ds", "y").collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_states_stay_and_plans_do_not_grow(spark, capsys):
    rows = to_panel(spark, {f"s{k}": [float(k), 2.0, np.nan] for k in range(20)} | {None: [1.0]})
    states = [SeriesHistory.create(rows, buckets=8)]
    for k in range(10):
        states.append(states[-1].append(to_panel(spark, {"s3": [k + 0.5], "new": [1.0]}, start=f"2016-{k + 1:02}-01")))
    assert observed(states[0].rows()) == observed(rows)
    assert [s.rows().count() for s in states] == [61 + 2 * k for k in range(11)]
    some = rows.where("unique_id IN ('s3', 's5')").select("unique_id")
    assert observed(states[0].rows_of(some)) == observed(rows.where("unique_id IN ('s3', 's5')"))
    first, last = plan(states[1].rows_of(some)), plan(states[10].rows_of(some))
    assert len(first.splitlines()) == len(last.splitlines()) and "Union" not in last
    # Spark lists and reads only partitions that pass these filters
    states[10].rows_of(some).explain("formatted")
    filters = next(line for line in capsys.readouterr().out.splitlines() if line.startswith("PartitionFilters") and BUCKET in line)
    picked = re.search(rf"\({BUCKET}#\d+ = \d+\)|{BUCKET}#\d+ IN \(([\d,]+)\)", filters)
    assert picked and len((picked[1] or "one").split(",")) <= 2
    small = states[10].compact()
    assert small.version == 0 and observed(small.rows()) == observed(states[10].rows())
    assert states[0].rows_of(some.limit(0)).count() == 0


def test_a_failed_append_can_be_made_again(spark):
    rows = to_panel(spark, {f"s{k}": [1.0, 2.0] for k in range(9)})
    state = SeriesHistory.create(rows, buckets=4)
    broken = rows.withColumn("y", F.when(F.col("unique_id") == "s7", F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("y")))
    with pytest.raises(Exception, match="lost"):
        state.append(broken)
    assert observed(state.rows()) == observed(rows)
    assert state.append(rows).rows().count() == 36
    with pytest.raises(ValueError, match=VERSION):
        SeriesHistory.create(rows.withColumn(BUCKET, F.lit(1)))


def test_empty_history(spark):
    rows = to_panel(spark, {"a": [1.0]})
    state = SeriesHistory.create(rows.limit(0))
    assert state.rows().count() == 0
    assert observed(state.append(rows).rows()) == observed(rows)


def test_models_update_from_buckets_as_from_frames(spark):
    rng = np.random.default_rng(4)
    series = {f"s{k}": rng.normal(size=40).cumsum().tolist() for k in range(4)}
    train = to_panel(spark, {u: y[:30] for u, y in series.items()})
    later = to_panel(spark, {u: series[u][30:] for u in ("s1", "s2")}, start="2017-07-01")
    late = to_panel(spark, {"s1": [0.25]}, start="2016-01-01")
    found = []
    for buckets in (None, 4):
        model = ArimaModel((1, 1, 0)).fit(train, fh=3, freq="MS", layout="whole", history_buckets=buckets)
        model.update(later).update(late)
        found.append(sorted(map(tuple, model.predict().collect())))
    assert isinstance(model.history, SeriesHistory)
    for a, b in zip(*found):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2])
