"""The queries of the engine over the given tables."""

from .registry import QUERIES, Query


def all_queries() -> dict[str, Query]:
    from . import calendar_queries, evaluation_queries, feature_queries, forecast_queries, source_queries, streaming_queries  # noqa: F401

    return QUERIES
