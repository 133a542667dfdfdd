import os
import subprocess
import sys
from pathlib import Path

from seriesmill.operators.features import add_lag_features
from seriesmill.session import scratch_scope

ROOT = Path(__file__).resolve().parents[1]

FIT_ELSEWHERE = """
from seriesmill.session import build_session
from seriesmill.forecasting import arima
from seriesmill.forecasting.arima import ArimaSpec
spark = build_session("ship", "local[2]", **{"spark.sql.shuffle.partitions": "2", "spark.driver.host": "localhost"})
rows = spark.range(60).selectExpr("'a' AS unique_id", "timestamp_ntz'2020-01-01' + make_interval(0, 0, 0, cast(id AS int)) AS ds", "sin(id) + id / 10 AS y")
print("FITTED", arima.fit(rows, ArimaSpec((1, 1, 0), trend="c"), freq="D", layout="whole").count())
"""


def test_workers_get_the_package(tmp_path):
    """The package lies on the driver's path only: workers start in another folder."""
    code = f"import sys; sys.path.insert(0, {str(ROOT)!r})\n" + FIT_ELSEWHERE
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "FITTED 1" in done.stdout, done.stderr[-2000:]


def test_scratch_scope_deletes_what_was_written(spark):
    df = spark.range(30).selectExpr("id % 3 AS g", "id AS i", "id * 1.0 AS y")
    with scratch_scope(spark) as paths:
        assert add_lag_features(df, "y", ["g"], [1], ["i"], "blocks").count() == 30
        kept = [p.removeprefix("file://") for p in paths]
        assert kept and all(os.path.isdir(p) for p in kept)
    assert not any(os.path.exists(p) for p in kept)
