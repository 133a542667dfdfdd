"""Calendar columns, scalar functions and simple filters, over all orders (all events for hours)."""

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.scalars import expm1, log1p, round_half_even
from ..operators.metrics import residual
from ..operators.split import time_series_split
from .inputs import CUTOFF, PAIRS, PANEL, brand_panel, seasonal_pairs, table
from .registry import register, rounded

_D = "o_orderdate"

# name -> (column, output name, SQL expression)
_COLUMNS = {
    "p2_year": (cal.year, "year", f"CAST(year({_D}) AS INTEGER)"),
    "p3_month": (cal.month, "month", f"CAST(month({_D}) AS INTEGER)"),
    "p4_day": (cal.day, "day", f"CAST(day({_D}) AS INTEGER)"),
    "p6_weekday": (cal.weekday, "weekday", f"CAST(isodow({_D}) - 1 AS INTEGER)"),
    "p7_iso_week": (cal.iso_week, "week", f"CAST(weekofyear({_D}) AS INTEGER)"),
    "p8_iso_week_as_double": (lambda c: cal.iso_week(c).cast("double"), "weekofyear", f"CAST(weekofyear({_D}) AS DOUBLE)"),
    "p9_yearmonth": (cal.yearmonth, "yearmonth", f"strftime({_D}, '%Y-%m')"),
    "p13_is_weekend": (cal.is_weekend, "is_weekend", f"CAST(isodow({_D}) >= 6 AS INTEGER)"),
    "p14_is_friday_to_sunday": (cal.is_friday_to_sunday, "is_wknd", f"CAST(isodow({_D}) >= 5 AS INTEGER)"),
    "p15_is_month_start": (cal.is_month_start, "is_month_start", f"CAST(day({_D}) = 1 AS INTEGER)"),
    "p16_is_month_end": (cal.is_month_end, "is_month_end", f"CAST(CAST({_D} AS DATE) = last_day({_D}) AS INTEGER)"),
    "p17_quarter": (cal.quarter, "quarter", f"CAST(quarter({_D}) AS INTEGER)"),
    "p18_day_of_year": (cal.day_of_year, "dayofyear", f"CAST(dayofyear({_D}) AS INTEGER)"),
}


def _register_column(name, column, out, expression):
    @register(name, f"SELECT o_orderkey, {expression} AS {out} FROM orders")
    def run(spark, sf_dir):
        return table(spark, sf_dir, "orders").select("o_orderkey", column(_D).alias(out))


for _name, _parts in _COLUMNS.items():
    _register_column(_name, *_parts)


@register("p1_text_to_datetime", "SELECT o_orderkey, o_orderdate FROM orders")
def p1_text_to_datetime(spark, sf_dir):
    text = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(_D, "yyyy-MM-dd").alias(_D))
    return cal.ensure_datetime(text, _D)


@register("p5_hour", "SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour FROM events")
def p5_hour(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", cal.hour("ts").alias("hour"))


@register(
    "p10_month_number",
    """SELECT o_orderkey, CAST((year(o_orderdate) - (SELECT min(year(o_orderdate)) FROM orders)) * 12 + month(o_orderdate)
    AS INTEGER) AS month_number FROM orders""",
)
def p10_month_number(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", cal.month_number(orders, _D).alias("month_number"))


def _cycle_sql(out, fn, number, length):
    return f"round({fn}(2 * pi() * ({number}) / {length}), 6) AS {out}"


_CYCLES = {
    "month_sin": _cycle_sql("month_sin", "sin", "month(o_orderdate)", 12),
    "month_cos": _cycle_sql("month_cos", "cos", "month(o_orderdate)", 12),
    "weekday_sin": _cycle_sql("weekday_sin", "sin", "isodow(o_orderdate) - 1", 7),
    "weekday_cos": _cycle_sql("weekday_cos", "cos", "isodow(o_orderdate) - 1", 7),
}


def _register_cycles(name, outs):
    @register(name, f"SELECT o_orderkey, {', '.join(_CYCLES[o] for o in outs)} FROM orders")
    def run(spark, sf_dir):
        columns = cal.cyclical(_D)
        return rounded(table(spark, sf_dir, "orders").select("o_orderkey", *[columns[o].alias(o) for o in outs]))


_register_cycles("p11_month_cycle", ["month_sin", "month_cos"])
_register_cycles("p12_weekday_cycle", ["weekday_sin", "weekday_cos"])


def time_features_sql(source, key, d):
    cycles = ", ".join(_CYCLES.values()).replace("o_orderdate", d)
    return f"""SELECT {key}, {d}, CAST(year({d}) AS INTEGER) AS year, CAST(month({d}) AS INTEGER) AS month,
    CAST(day({d}) AS INTEGER) AS day, CAST(hour({d}) AS INTEGER) AS hour, CAST(isodow({d}) - 1 AS INTEGER) AS weekday,
    CAST(weekofyear({d}) AS INTEGER) AS week, strftime({d}, '%Y-%m') AS yearmonth,
    CAST((year({d}) - (SELECT min(year({d})) FROM {source})) * 12 + month({d}) AS INTEGER) AS month_number, {cycles},
    CAST(isodow({d}) >= 6 AS INTEGER) AS is_weekend, CAST(day({d}) = 1 AS INTEGER) AS is_month_start,
    CAST(CAST({d} AS DATE) = last_day({d}) AS INTEGER) AS is_month_end FROM {source}"""


@register("p19_time_features", time_features_sql("orders", "o_orderkey", "o_orderdate"))
def p19_time_features(spark, sf_dir):
    return rounded(cal.create_time_features(table(spark, sf_dir, "orders").select("o_orderkey", _D), _D))


@register("p19_time_features_of_events", time_features_sql("events", "event_id", "ts"))
def p19_time_features_of_events(spark, sf_dir):
    return rounded(cal.create_time_features(table(spark, sf_dir, "events").select("event_id", "ts"), "ts"))


@register(
    "p20_series_date_columns",
    f"""SELECT o_orderkey, CAST(isodow({_D}) - 1 AS INTEGER) AS dayofweek, CAST(quarter({_D}) AS INTEGER) AS quarter,
    CAST(month({_D}) AS INTEGER) AS month, CAST(year({_D}) AS INTEGER) AS year, CAST(dayofyear({_D}) AS INTEGER) AS dayofyear,
    CAST(day({_D}) AS INTEGER) AS dayofmonth, CAST(weekofyear({_D}) AS DOUBLE) AS weekofyear,
    CAST(isodow({_D}) >= 5 AS INTEGER) AS is_wknd, CAST(day({_D}) = 1 AS INTEGER) AS is_month_start,
    CAST(CAST({_D} AS DATE) = last_day({_D}) AS INTEGER) AS is_month_end FROM orders""",
)
def p20_series_date_columns(spark, sf_dir):
    columns = [c.alias(n) for n, c in cal.series_date_columns(_D).items()]
    return table(spark, sf_dir, "orders").select("o_orderkey", *columns)


@register("p21_log1p", "SELECT event_id, round(ln(1 + value), 6) AS log_value FROM events")
def p21_log1p(spark, sf_dir):
    return rounded(table(spark, sf_dir, "events").select("event_id", log1p("value").alias("log_value")))


@register("p22_expm1", "SELECT event_id, round(exp(value / 100) - 1, 6) AS grown FROM events")
def p22_expm1(spark, sf_dir):
    return rounded(table(spark, sf_dir, "events").select("event_id", expm1(F.col("value") / 100).alias("grown")))


@register(
    "p28_casts",
    """SELECT event_id, CAST(floor(value) AS INTEGER) AS whole, CAST(event_id AS DOUBLE) AS id_number,
    CAST(user_id AS VARCHAR) AS user_text, CAST(value > 50 AS INTEGER) AS is_large FROM events""",
)
def p28_casts(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.floor("value").cast("int").alias("whole"),
        F.col("event_id").cast("double").alias("id_number"),
        F.col("user_id").cast("string").alias("user_text"),
        (F.col("value") > 50).cast("int").alias("is_large"),
    )


@register(
    "p29_scalar_math",
    """SELECT event_id, abs(value - 100) AS distance, round(sqrt(value), 6) AS root, round(value * value, 6) AS square,
    round_even(value, 1) AS rounded FROM events""",
)
def p29_scalar_math(spark, sf_dir):
    value = F.col("value")
    out = {"distance": F.abs(value - 100), "root": F.round(F.sqrt(value), 6), "square": F.round(value * value, 6)}
    out["rounded"] = round_half_even(value, 1)
    return table(spark, sf_dir, "events").select("event_id", *[c.alias(n) for n, c in out.items()])


def _register_cutoff(name, part, comparison):
    @register(name, f"SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate {comparison} TIMESTAMP '{CUTOFF}'")
    def run(spark, sf_dir):
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
        return time_series_split(orders, CUTOFF, _D)[part]


_register_cutoff("p23_rows_before_cutoff", 0, "<")
_register_cutoff("p23_rows_from_cutoff", 1, ">=")


@register("p24_one_series", f"WITH {PANEL} SELECT unique_id, ds, round(y, 6) AS y FROM panel WHERE unique_id = 'Brand#7'")
def p24_one_series(spark, sf_dir):
    return rounded(brand_panel(spark, sf_dir).where(F.col("unique_id") == "Brand#7"))


@register("p25_features_without_target", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders")
def p25_features_without_target(spark, sf_dir):
    return table(spark, sf_dir, "orders").drop("o_totalprice")


@register(
    "p26_compare_actual_predicted",
    f"""WITH {PAIRS} SELECT p_brand, period, round_even(actual, 2) AS "Actual", round_even(forecast, 2) AS "Predicted",
    round_even(abs(forecast - actual), 2) AS "Residual" FROM pairs""",
)
def p26_compare_actual_predicted(spark, sf_dir):
    from ..operators.metrics import compare_actual_predicted

    return rounded(compare_actual_predicted(seasonal_pairs(spark, sf_dir), "actual", "forecast", ["p_brand", "period"]))


@register("p27_signed_residual", f"WITH {PAIRS} SELECT p_brand, period, round(actual - forecast, 6) AS residual FROM pairs")
def p27_signed_residual(spark, sf_dir):
    pairs = seasonal_pairs(spark, sf_dir)
    return rounded(pairs.select("p_brand", "period", residual("actual", "forecast").alias("residual")))
