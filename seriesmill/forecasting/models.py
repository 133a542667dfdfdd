"""Models with fit / predict / update over a whole panel; they hold a parameter table and the history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from . import arima
from .arima import ArimaSpec
from .history import SeriesHistory


class _PanelModel:
    def __init__(self, order: tuple, seasonal_order: tuple, trend: str | None, estimator: str):
        self.order, self.seasonal_order, self.trend = tuple(order), tuple(seasonal_order), trend or "n"
        self.estimator = estimator
        self.params: DataFrame | None = None
        self.history: arima.History | None = None
        self._columns = ("unique_id", "y", "ds")

    def fit(
        self,
        df: DataFrame,
        id_col: str = "unique_id",
        y_col: str = "y",
        ds_col: str = "ds",
        exog_cols: Sequence[str] | None = None,
        fh: int | None = None,
        freq: str | None = None,
        layout: str = "auto",
        history_buckets: int | None = None,
    ):
        """Fit one model per series. ``fh`` is the horizon of ``predict`` calls that give none; ``freq``
        overrides the inferred frequency. With ``history_buckets`` the observations are written in so many buckets of series
        (``SeriesHistory``), and updates append to them and read only the buckets they touch."""
        spec = ArimaSpec(self.order, self.seasonal_order, self.trend, tuple(exog_cols or ()), estimator=self.estimator)
        self._columns, self._horizon, self._freq, self._layout = (id_col, y_col, ds_col), fh, freq, layout
        rows = df.select(id_col, y_col, ds_col, *spec.exog_cols)
        self.history = rows
        if history_buckets:
            self.history = SeriesHistory.create(rows, id_col, buckets=history_buckets)
            rows = self.history.rows()
        self.params = arima.fit(rows, spec, id_col, y_col, ds_col, freq, layout)
        return self

    def _fitted(self) -> DataFrame:
        if self.params is None:
            raise ValueError("the model has not been fitted yet")
        return self.params

    def _forecast(self, horizon: int | None, X: DataFrame | None, alpha: float, id_col=None, ds_col=None) -> DataFrame:
        params = self._fitted()
        horizon = horizon or self._horizon
        if not horizon:
            raise ValueError("predict needs a horizon, here or as fh in fit")
        return arima.forecast(params, horizon, X, alpha, id_col or self._columns[0], ds_col or self._columns[2])

    def _refit(self, df: DataFrame) -> None:
        self.params, self.history = arima.refit(
            self._fitted(), self.history, df, *self._columns, freq=self._freq, layout=self._layout
        )


class ArimaModel(_PanelModel):
    """ARIMA with an intercept by default; two-stage least squares, or ``estimator="likelihood"`` for short series."""

    def __init__(
        self, order: tuple = (1, 1, 1), seasonal_order: tuple = (0, 0, 0, 0), trend: str | None = "c", estimator: str = "two_stage"
    ):
        super().__init__(order, seasonal_order, trend, estimator)

    def predict(self, horizon: int | None = None, X: DataFrame | None = None) -> DataFrame:
        return self._forecast(horizon, X, 0.05).select("unique_id", "ds", "yhat")

    def update(self, df: DataFrame, update_params: bool = True):
        """Add observations. Coefficients are re-estimated with ``update_params``, else only the state moves."""
        if arima.needs_refit(arima.spec_of(self._fitted()), update_params):
            self._refit(df)
        else:  # series with late or repeated dates are fitted again
            self.params, self.history = arima.update(
                self.params, self.history, df, *self._columns, freq=self._freq, layout=self._layout, update_params=update_params
            )
        return self


class SarimaModel(_PanelModel):
    """Seasonal ARIMA, without trend terms by default; forecasts carry an interval.

    Seasonal and moving-average terms are estimated by exact likelihood, plain autoregressions by least squares, unless
    ``estimator`` names one. Series too long for one array need ``estimator="two_stage"``.
    """

    def __init__(
        self, order: tuple = (1, 1, 1), seasonal_order: tuple = (1, 1, 1, 12), trend: str | None = None, estimator: str | None = None
    ):
        plain = not any(seasonal_order) and not order[2]
        super().__init__(order, seasonal_order, trend, estimator or ("two_stage" if plain else "likelihood"))

    def predict(
        self,
        horizon: int | None = None,
        X: DataFrame | None = None,
        id_col: str | None = None,
        ds_col: str | None = None,
        alpha: float = 0.05,
    ) -> DataFrame:
        return self._forecast(horizon, X, alpha, id_col, ds_col)

    def update(self, df: DataFrame, refit: bool = True):
        """Append observations and fit again the series they belong to."""
        if not refit:
            raise NotImplementedError("an update without refit is not implemented; set refit=True")
        self._refit(df)
        return self
