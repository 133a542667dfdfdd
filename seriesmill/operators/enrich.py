"""Left joins of the sales fact to its dimensions.

No join carries a broadcast hint: Catalyst and AQE broadcast a dimension when its measured size is under
``spark.sql.autoBroadcastJoinThreshold``; a larger one is shuffled, and AQE splits the fact side of a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_merge(fact: DataFrame, dim: DataFrame, key: str, unique: bool = False) -> DataFrame:
    """Left join on ``key`` where a missing key matches a missing key.

    Other columns present on both sides get the suffixes ``_x`` and ``_y``. A repeated dimension key
    repeats the fact row; with ``unique=True`` it raises instead.
    """
    if unique and not dim.groupBy(key).count().where("count > 1").isEmpty():
        raise ValueError(f"dimension key {key!r} is not unique")
    shared = (set(fact.columns) & set(dim.columns)) - {key}
    left = fact.withColumnsRenamed({c: f"{c}_x" for c in shared})
    right = dim.withColumnsRenamed({c: f"{c}_y" for c in shared} | {key: f"__dim_{key}"})
    joined = left.join(right, F.col(key).eqNullSafe(F.col(f"__dim_{key}")), "left")
    return joined.drop(f"__dim_{key}")


def enrich_product_transaction(df: DataFrame, product_dim: DataFrame) -> DataFrame:
    return left_merge(df, product_dim, "product_id")


def enrich_product_customer(df: DataFrame, customer_dim: DataFrame) -> DataFrame:
    return left_merge(df, customer_dim, "customer_id")


def enrich_product_promotion(df: DataFrame, promo_dim: DataFrame) -> DataFrame:
    return left_merge(df, promo_dim, "promotion_id")
