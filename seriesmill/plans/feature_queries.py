"""Window features: on monthly series (one row per period) and on all orders by priority (transaction rows)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.features import (
    add_diff_features,
    add_lag_features,
    add_rolling_features,
    create_time_series_features,
    prepare_features,
)
from ..operators.layout import BLOCK_ROWS
from ..session import materialize
from .calendar_queries import time_features_sql
from .inputs import BRAND_MONTHS, PART_MONTHS, brand_months, part_months, sales_by, table
from .registry import register, rounded

# Sums per period hold at most one row per series and period, so one window partition per series is bounded.
SUMMED = "short"

_W = "OVER (PARTITION BY p_brand ORDER BY period)"
_KEYS = "p_brand, period"


def _frame(n, part="p_brand", order="period"):
    return f"OVER (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"


def _full(agg, col, n, name, part="p_brand", order="period", need=None, digits=6):
    f = _frame(n, part, order)
    return f"round(CASE WHEN count({col}) {f} >= {need or n} THEN {agg}({col}) {f} END, {digits}) AS {name}"


def _lag_sql(lags, col="sales_amount", w=_W):
    return ", ".join(f"round(lag({col}, {k}) {w}, 6) AS sales_amount_lag{k}" for k in lags)


def _rolling_sql(windows, part="p_brand"):
    return ", ".join(
        f"{_full('avg', 'sales_amount', n, f'sales_amount_rolling_mean_{n}', part)}, "
        f"{_full('stddev_samp', 'sales_amount', n, f'sales_amount_rolling_std_{n}', part, digits=4)}"
        for n in windows
    )


def _diff_sql(periods, w=_W):
    return ", ".join(
        f"round(sales_amount - lag(sales_amount, {p}) {w}, 6) AS sales_amount_diff_{p}, "
        f"round(sales_amount / lag(sales_amount, {p}) {w} - 1, 6) AS sales_amount_pct_change_{p}"
        for p in periods
    )


def _std_digits(df):
    return rounded(df, 6, **{c: 4 for c in df.columns if "_std_" in c or "_ewm_" in c})


@register("w1_lags", f"WITH {BRAND_MONTHS} SELECT {_KEYS}, {_lag_sql([1, 3, 6])} FROM monthly")
def w1_lags(spark, sf_dir):
    out = add_lag_features(brand_months(spark, sf_dir), "sales_amount", ["p_brand"], [1, 3, 6], ["yearmonth"], SUMMED)
    return rounded(out.drop("sales_amount", "yearmonth"))


@register(
    "w1_lags_of_gappy_products",
    f"""WITH {PART_MONTHS} SELECT product_id, period,
    {_lag_sql([1, 3, 6], w='OVER (PARTITION BY product_id ORDER BY period)')} FROM part_monthly""",
)
def w1_lags_of_gappy_products(spark, sf_dir):
    out = add_lag_features(part_months(spark, sf_dir), "sales_amount", ["product_id"], [1, 3, 6], ["period"], SUMMED)
    return rounded(out.drop("sales_amount", "yearmonth"))


@register(
    "w2_rolling_mean",
    f"WITH {BRAND_MONTHS} SELECT {_KEYS}, "
    + ", ".join(_full("avg", "sales_amount", n, f"sales_amount_rolling_mean_{n}") for n in (3, 6, 12))
    + " FROM monthly",
)
def w2_rolling_mean(spark, sf_dir):
    out = add_rolling_features(brand_months(spark, sf_dir), "sales_amount", ["p_brand"], [3, 6, 12], ["period"], SUMMED)
    return rounded(out.select("p_brand", "period", *[c for c in out.columns if "_mean_" in c]))


@register(
    "w3_rolling_std",
    f"WITH {BRAND_MONTHS} SELECT {_KEYS}, "
    + ", ".join(_full("stddev_samp", "sales_amount", n, f"sales_amount_rolling_std_{n}", digits=4) for n in (3, 6, 12))
    + " FROM monthly",
)
def w3_rolling_std(spark, sf_dir):
    out = add_rolling_features(brand_months(spark, sf_dir), "sales_amount", ["p_brand"], [3, 6, 12], ["period"], SUMMED)
    return _std_digits(out.select("p_brand", "period", *[c for c in out.columns if "_std_" in c]))


def _w4_w5(spark, sf_dir, kind):
    out = add_diff_features(brand_months(spark, sf_dir), "sales_amount", ["p_brand"], [1, 12], ["period"], SUMMED)
    return rounded(out.select("p_brand", "period", *[c for c in out.columns if kind in c]))


@register(
    "w4_differences",
    f"""WITH {BRAND_MONTHS} SELECT {_KEYS}, round(sales_amount - lag(sales_amount, 1) {_W}, 6) AS sales_amount_diff_1,
    round(sales_amount - lag(sales_amount, 12) {_W}, 6) AS sales_amount_diff_12 FROM monthly""",
)
def w4_differences(spark, sf_dir):
    return _w4_w5(spark, sf_dir, "_diff_")


@register(
    "w5_percent_changes",
    f"""WITH {BRAND_MONTHS} SELECT {_KEYS}, round(sales_amount / lag(sales_amount, 1) {_W} - 1, 6) AS sales_amount_pct_change_1,
    round(sales_amount / lag(sales_amount, 12) {_W} - 1, 6) AS sales_amount_pct_change_12 FROM monthly""",
)
def w5_percent_changes(spark, sf_dir):
    return _w4_w5(spark, sf_dir, "_pct_change_")


_HOLES = "CASE WHEN month(period) % 4 = 0 THEN NULL ELSE sales_amount END"


@register(
    "w5_percent_changes_over_missing",
    f"""WITH {BRAND_MONTHS}, holes AS (SELECT p_brand, period, {_HOLES} AS sales_amount FROM monthly),
    filled AS (SELECT *, last_value(sales_amount IGNORE NULLS) OVER (PARTITION BY p_brand ORDER BY period
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f FROM holes)
    SELECT {_KEYS}, round(f / lag(f, 1) {_W} - 1, 6) AS sales_amount_pct_change_1,
    round(f / lag(f, 12) {_W} - 1, 6) AS sales_amount_pct_change_12 FROM filled""",
)
def w5_percent_changes_over_missing(spark, sf_dir):
    holes = brand_months(spark, sf_dir).withColumn("sales_amount", F.expr(_HOLES))
    out = add_diff_features(holes, "sales_amount", ["p_brand"], [1, 12], ["period"], SUMMED)
    return rounded(out.select("p_brand", "period", *[c for c in out.columns if "_pct_change_" in c]))


# --- transaction rows: every order, by priority ------------------------------------------------------

_ORDERS = ("o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice")
_OW = "OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey)"
_OPART, _OORDER = "o_orderpriority", "o_orderdate, o_orderkey"


def _order_features(spark, sf_dir, layout="auto", **flags):
    orders = table(spark, sf_dir, "orders").select(*_ORDERS)
    out = create_time_series_features(
        orders, "o_totalprice", ["o_orderdate", "o_orderkey"], "o_orderpriority",
        date_related=False, date_col="o_orderdate", layout=layout, **flags,
    )
    return _std_digits(out.drop("o_orderdate", "o_orderpriority", "o_totalprice"))


@register(
    "w6_lags_of_rows",
    f"SELECT o_orderkey, lag(o_totalprice, 1) {_OW} AS sales_lag_1, lag(o_totalprice, 7) {_OW} AS sales_lag_7 FROM orders",
)
def w6_lags_of_rows(spark, sf_dir):
    return _order_features(spark, sf_dir, lag=True, lags=[1, 7])


@register(
    "w6_lags_of_rows_in_blocks",
    f"SELECT o_orderkey, lag(o_totalprice, 1) {_OW} AS sales_lag_1, lag(o_totalprice, 7) {_OW} AS sales_lag_7 FROM orders",
)
def w6_lags_of_rows_in_blocks(spark, sf_dir):
    return _order_features(spark, sf_dir, layout="blocks", lag=True, lags=[1, 7])


def _rows_sql(agg, name, digits=6, windows=(3, 6), need=2):
    cols = ", ".join(_full(agg, "o_totalprice", n, f"sales_roll_{name}_{n}", _OPART, _OORDER, need, digits) for n in windows)
    return f"SELECT o_orderkey, {cols} FROM orders"


@register("w7_rolling_mean_of_rows", _rows_sql("avg", "mean"))
def w7_rolling_mean_of_rows(spark, sf_dir):
    return _order_features(spark, sf_dir, roll=True, roll_mean=True, windows=[3, 6], min_periods=2)


@register("w8_rolling_std_of_rows", _rows_sql("stddev_samp", "std", 4))
def w8_rolling_std_of_rows(spark, sf_dir):
    return _order_features(spark, sf_dir, roll=True, roll_std=True, windows=[3, 6], min_periods=2)


@register("w9_rolling_min_of_rows", _rows_sql("min", "min"))
def w9_rolling_min_of_rows(spark, sf_dir):
    return _order_features(spark, sf_dir, roll=True, roll_min=True, windows=[3, 6], min_periods=2)


@register("w10_rolling_max_of_rows", _rows_sql("max", "max"))
def w10_rolling_max_of_rows(spark, sf_dir):
    return _order_features(spark, sf_dir, roll=True, roll_max=True, windows=[3, 6], min_periods=2)


# Weights below 1e-18 do not change the sums: the SQL joins each row to the rows before it that still count.
def ewm_sql(source, keys, part, order, col, alphas, lags, reach):
    sums = ", ".join(
        f"sum(CASE WHEN b.n >= a.n - {reach[a]} THEN pow(1 - {a}, a.n - b.n) * b.x END) / "
        f"sum(CASE WHEN b.n >= a.n - {reach[a]} THEN pow(1 - {a}, a.n - b.n) END) AS e{i}"
        for i, a in enumerate(alphas)
    )
    cols = ", ".join(
        f"round(lag(e{i}, {k}) OVER (PARTITION BY g ORDER BY n), 4) AS \"sales_ewm_w_{a}_lag_{k}\""
        for i, a in enumerate(alphas)
        for k in lags
    )
    return f"""numbered AS (SELECT {keys}, {part} AS g, {col} AS x,
      row_number() OVER (PARTITION BY {part} ORDER BY {order}) AS n FROM {source}),
    means AS (SELECT {', '.join(f'any_value(a.{k.strip()}) AS {k.strip()}' for k in keys.split(','))}, a.g, a.n, {sums}
      FROM numbered a JOIN numbered b ON a.g = b.g AND b.n <= a.n AND b.n >= a.n - {max(reach.values())} GROUP BY a.g, a.n)
    SELECT {keys}, {cols} FROM means"""


@register(
    "w11_ewm",
    f"WITH {BRAND_MONTHS}, " + ewm_sql("monthly", "p_brand, period", "p_brand", "period", "sales_amount",
                                       [0.95, 0.5, 0.1], [1, 3], {0.95: 20, 0.5: 70, 0.1: 100}),
)
def w11_ewm(spark, sf_dir):
    out = create_time_series_features(
        brand_months(spark, sf_dir), "sales_amount", "period", "p_brand", lags=[1, 3], weights=[0.95, 0.5, 0.1],
        date_related=False, ewm=True, layout=SUMMED,
    )
    return _std_digits(out.drop("sales_amount", "yearmonth"))


@register(
    "w11_ewm_of_rows",
    "WITH " + ewm_sql("orders", "o_orderkey", _OPART, _OORDER, "o_totalprice", [0.9, 0.5], [1], {0.9: 20, 0.5: 70}),
)
def w11_ewm_of_rows(spark, sf_dir):
    return _order_features(spark, sf_dir, ewm=True, weights=[0.9, 0.5], lags=[1])


# Every series starts with a huge value, and every seventh order has none: means over very different magnitudes.
_HUGE_FIRST = f"""huge AS (SELECT o_orderkey, o_orderdate, o_orderpriority, CASE
    WHEN row_number() {_OW} = 1 THEN 1e30 WHEN o_orderkey % 7 = 3 THEN NULL ELSE o_totalprice END AS y FROM orders)"""


def _ewm_all_sql(alphas, lags):
    """Means over all rows before, as leading digits and power of ten."""
    sums = ", ".join(
        f"sum(pow(1 - {a}, a.n - b.n) * b.x) / sum(CASE WHEN b.x IS NOT NULL THEN pow(1 - {a}, a.n - b.n) END) AS e{i}"
        for i, a in enumerate(alphas)
    )
    lagged = ", ".join(
        f"lag(e{i}, {k}) OVER (PARTITION BY g ORDER BY n) AS e{i}_{k}" for i in range(len(alphas)) for k in lags
    )
    cols = ", ".join(
        f"CAST(floor(log10(e{i}_{k})) AS BIGINT) AS power_{i}_{k}, round(e{i}_{k} / pow(10, floor(log10(e{i}_{k}))), 7) AS digits_{i}_{k}"
        for i in range(len(alphas))
        for k in lags
    )
    return f"""WITH {_HUGE_FIRST}, numbered AS (SELECT o_orderkey, o_orderpriority AS g, y AS x, row_number() {_OW} AS n FROM huge),
    means AS (SELECT any_value(a.o_orderkey) AS o_orderkey, a.g, a.n, {sums}
      FROM numbered a JOIN numbered b ON a.g = b.g AND b.n <= a.n GROUP BY a.g, a.n),
    lagged AS (SELECT o_orderkey, {lagged} FROM means) SELECT o_orderkey, {cols} FROM lagged"""


def _huge_first(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(*_ORDERS)
    # Only the orders that share the first place of a series are ranked, so that no task sorts a whole series.
    place = F.struct("o_orderdate", "o_orderkey")
    firsts = orders.groupBy(F.col("o_orderpriority").alias("series")).agg(F.min(place).alias("first"))
    placed = orders.join(F.broadcast(firsts), F.col("o_orderpriority").eqNullSafe(F.col("series")))
    tied = placed.where(place == F.col("first"))
    n = F.row_number().over(Window.partitionBy("o_orderpriority").orderBy("o_orderdate", "o_orderkey"))
    ranked = placed.where(place != F.col("first")).withColumn("n", F.lit(0)).unionByName(tied.withColumn("n", n))
    y = F.when(F.col("n") == 1, 1e30).when(F.col("o_orderkey") % 7 != 3, F.col("o_totalprice"))
    return ranked.select("o_orderkey", "o_orderdate", "o_orderpriority", y.alias("y"))


def _ewm_digits(spark, sf_dir, layout, alphas, lags, **flags):
    out = create_time_series_features(
        _huge_first(spark, sf_dir), "y", ["o_orderdate", "o_orderkey"], "o_orderpriority", lags=lags, weights=alphas,
        date_related=False, ewm=True, date_col="o_orderdate", layout=layout, **flags,
    )
    cols = {f"{i}_{k}": F.col(f"`sales_ewm_w_{a}_lag_{k}`") for i, a in enumerate(alphas) for k in lags}
    power = {n: F.floor(F.log10(c)) for n, c in cols.items()}
    digits = [F.round(c / F.pow(F.lit(10.0), power[n].cast("double")), 7).alias(f"digits_{n}") for n, c in cols.items()]
    return out.select("o_orderkey", *[p.cast("bigint").alias(f"power_{n}") for n, p in power.items()], *digits)


@register("w11_ewm_over_magnitudes", _ewm_all_sql([0.5, 0.02], [1]))
def w11_ewm_over_magnitudes(spark, sf_dir):
    return _ewm_digits(spark, sf_dir, "whole", [0.5, 0.02], [1])


@register("w11_ewm_in_blocks", _ewm_all_sql([0.5, 0.02], [1]))
def w11_ewm_in_blocks(spark, sf_dir):
    return _ewm_digits(spark, sf_dir, "blocks", [0.5, 0.02], [1], block_rows=200)


def _weight_sql(win_type, i, n):
    """The weight of place i of n in SQL, apart from the code that is checked."""
    if win_type == "triang":
        return f"(1 - abs(2.0 * {i} - {n - 1}) / {n + n % 2})"
    return f"(0.54 - 0.46 * cos(2 * pi() * {i} / {n - 1}))"


def _weighted_sql(win_type, n):
    q = [_weight_sql(win_type, i, n) for i in range(n)]
    lags = [f"lag(sales_amount, {n - i}) {_W}" for i in range(n)]
    total = "(" + " + ".join(q) + ")"
    mean = "(" + " + ".join(f"{w} * {x}" for w, x in zip(q, lags)) + f") / {total}"
    spread = " + ".join(f"{w} * pow(x{i} - m, 2)" for i, w in enumerate(q))
    lag_cols = ", ".join(f"{x} AS x{i}" for i, x in enumerate(lags))
    return f"""WITH {BRAND_MONTHS}, w AS (SELECT p_brand, period, {mean} AS m, {lag_cols} FROM monthly)
    SELECT p_brand, period, round(m, 6) AS sales_roll_mean_{n},
    round(sqrt(({spread}) / {total} * {n} / {n - 1}), 4) AS sales_roll_std_{n} FROM w"""


def _register_weighted(name, win_type, n):
    @register(name, _weighted_sql(win_type, n))
    def run(spark, sf_dir):
        out = create_time_series_features(
            brand_months(spark, sf_dir), "sales_amount", "period", "p_brand", windows=[n], win_type=win_type,
            date_related=False, roll=True, roll_mean=True, roll_std=True, layout=SUMMED,
        )
        return _std_digits(out.drop("sales_amount", "yearmonth"))


_register_weighted("w12_triangular_rolling", "triang", 3)
_register_weighted("w12_hamming_rolling", "hamming", 6)


def _prepared_sql(source, groups):
    w = f"OVER (PARTITION BY {groups} ORDER BY period)"
    dated = time_features_sql(source, f"{groups}, sales_amount", "period").replace("SELECT", "SELECT yearmonth AS label,", 1)
    return f"""dated AS ({dated}) SELECT * EXCLUDE (label, sales_amount), round(sales_amount, 6) AS sales_amount,
    {_lag_sql([1, 3, 6], w=w)}, {_rolling_sql([3, 6, 12], groups)}, {_diff_sql([1, 12], w)} FROM dated"""


def _prepared(sums, groups):
    # month_number needs the first year of the table: the sums are written once, so that the fact is not read twice.
    out = prepare_features(materialize(sums, "sums"), "sales_amount", groups, date_col="period", layout=SUMMED)
    return _std_digits(out)


@register("w13_prepare_features", f"WITH {BRAND_MONTHS}, {_prepared_sql('monthly', 'p_brand')}")
def w13_prepare_features(spark, sf_dir):
    return _prepared(brand_months(spark, sf_dir), ["p_brand"])


@register("w13_prepare_features_by_product", f"WITH {PART_MONTHS}, {_prepared_sql('part_monthly', 'product_id')}")
def w13_prepare_features_by_product(spark, sf_dir):
    return _prepared(part_months(spark, sf_dir), ["product_id"])


_LOG = "ln(1 + o_totalprice)"
_ROW_EWM = ewm_sql("orders", "o_orderkey", _OPART, _OORDER, _LOG, [0.9], [1, 7], {0.9: 20})


@register(
    "w14_time_series_features",
    f"""WITH logged AS (SELECT o_orderkey, o_orderdate, o_orderpriority, {_LOG} AS y FROM orders),
    ewm AS (WITH {_ROW_EWM})
    SELECT o_orderkey, o_orderpriority, o_orderdate, round(y, 6) AS o_totalprice,
    CAST(isodow(o_orderdate) - 1 AS INTEGER) AS dayofweek, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
    CAST(month(o_orderdate) AS INTEGER) AS month, CAST(year(o_orderdate) AS INTEGER) AS year,
    CAST(dayofyear(o_orderdate) AS INTEGER) AS dayofyear, CAST(day(o_orderdate) AS INTEGER) AS dayofmonth,
    CAST(weekofyear(o_orderdate) AS DOUBLE) AS weekofyear, CAST(isodow(o_orderdate) >= 5 AS INTEGER) AS is_wknd,
    CAST(day(o_orderdate) = 1 AS INTEGER) AS is_month_start,
    CAST(CAST(o_orderdate AS DATE) = last_day(o_orderdate) AS INTEGER) AS is_month_end,
    round(lag(y, 1) {_OW}, 6) AS sales_lag_1, round(lag(y, 7) {_OW}, 6) AS sales_lag_7,
    """
    + ", ".join(
        _full(fn, "y", n, f"sales_roll_{name}_{n}", _OPART, _OORDER, 1 if name != "std" else 2, 4 if name == "std" else 6)
        for name, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
        for n in (3, 12)
    )
    + ', "sales_ewm_w_0.9_lag_1", "sales_ewm_w_0.9_lag_7" FROM logged JOIN ewm USING (o_orderkey)',
)
def w14_time_series_features(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(*_ORDERS)
    out = create_time_series_features(
        orders, "o_totalprice", ["o_orderdate", "o_orderkey"], "o_orderpriority", lags=[1, 7], windows=[3, 12],
        weights=[0.9], min_periods=1, lag=True, log_transformation=True, roll=True, ewm=True, roll_mean=True,
        roll_std=True, roll_min=True, roll_max=True, date_col="o_orderdate",
    )
    return _std_digits(out)


@register(
    "w14_time_series_features_in_blocks",
    f"""WITH logged AS (SELECT o_orderkey, o_orderdate, o_orderpriority, {_LOG} AS y FROM orders), ewm AS (WITH {_ROW_EWM})
    SELECT o_orderkey, round(y, 6) AS o_totalprice, round(lag(y, 1) {_OW}, 6) AS sales_lag_1, round(lag(y, 7) {_OW}, 6) AS sales_lag_7,
    """
    + ", ".join(
        _full(fn, "y", n, f"sales_roll_{name}_{n}", _OPART, _OORDER, 1, 6) for name, fn in (("mean", "avg"), ("min", "min")) for n in (3, 12)
    )
    + ', "sales_ewm_w_0.9_lag_1", "sales_ewm_w_0.9_lag_7" FROM logged JOIN ewm USING (o_orderkey)',
)
def w14_time_series_features_in_blocks(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(*_ORDERS)
    out = create_time_series_features(
        orders, "o_totalprice", ["o_orderdate", "o_orderkey"], "o_orderpriority", lags=[1, 7], windows=[3, 12],
        weights=[0.9], min_periods=1, lag=True, log_transformation=True, roll=True, ewm=True, roll_mean=True,
        roll_min=True, date_related=False, date_col="o_orderdate", layout="blocks", block_rows=200,
    )
    return _std_digits(out.drop("o_orderdate", "o_orderpriority"))


_WIDE = [365, 5000]
# Of logarithms: means of prices in cents fall on the middle of two roundings.
_WIDE_SQL = f"WITH logged AS (SELECT o_orderkey, o_orderdate, o_orderpriority, {_LOG} AS y FROM orders) SELECT o_orderkey, " + ", ".join(
    _full(fn, "y", n, f"sales_roll_{name}_{n}", _OPART, _OORDER, 2)
    for name, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
    for n in _WIDE
) + " FROM logged"


def _wide_windows(spark, sf_dir, layout, block_rows=BLOCK_ROWS):
    out = create_time_series_features(
        table(spark, sf_dir, "orders").select(*_ORDERS), "o_totalprice", ["o_orderdate", "o_orderkey"], "o_orderpriority",
        windows=_WIDE, min_periods=2, log_transformation=True, roll=True, roll_mean=True, roll_std=True, roll_min=True,
        roll_max=True, date_related=False, layout=layout, block_rows=block_rows,
    )
    return rounded(out.drop("o_orderdate", "o_orderpriority", "o_totalprice"))


@register("w2_w7_wide_windows", _WIDE_SQL)
def w2_w7_wide_windows(spark, sf_dir):
    return _wide_windows(spark, sf_dir, "whole")


@register("w2_w7_wide_windows_in_blocks", _WIDE_SQL)
def w2_w7_wide_windows_in_blocks(spark, sf_dir):
    return _wide_windows(spark, sf_dir, "blocks", 2000)


@register(
    "o3_rows_in_date_order",
    f"""SELECT o_orderkey, row_number() {_OW} AS n FROM orders""",
)
def o3_rows_in_date_order(spark, sf_dir):
    from ..operators.layout import lay_out

    orders = table(spark, sf_dir, "orders").select(*_ORDERS)
    rows = lay_out(orders, ["o_orderpriority"], ["o_orderdate", "o_orderkey"], "blocks").with_row_number("n")
    return rows.to_frame().select("o_orderkey", "n")


# Orders of the last day of a month lose their date: they come last in their series.
_SOME_DATES = "CASE WHEN CAST(o_orderdate AS DATE) = last_day(o_orderdate) THEN NULL ELSE o_orderdate END"


@register(
    "o2_missing_dates_last",
    f"""WITH some_dates AS (SELECT o_orderkey, o_orderpriority, o_totalprice, {_SOME_DATES} AS d FROM orders)
    SELECT o_orderkey, lag(o_totalprice) OVER (PARTITION BY o_orderpriority ORDER BY d ASC NULLS LAST, o_orderkey)
    AS o_totalprice_lag1 FROM some_dates""",
)
def o2_missing_dates_last(spark, sf_dir):
    some = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice", F.expr(_SOME_DATES).alias("d"))
    out = add_lag_features(some, "o_totalprice", ["o_orderpriority"], [1], ["d", "o_orderkey"])
    return out.select("o_orderkey", "o_totalprice_lag1")


# --- wide weighted windows ------------------------------------------------------------------------

_HAMMING = 365
_HAMMING_SQL = f"""WITH q AS (SELECT list(0.54 - 0.46 * cos(2 * pi() * i / {_HAMMING - 1}) ORDER BY i) AS ws FROM range({_HAMMING}) t(i)),
    logged AS (SELECT o_orderkey, o_orderdate, o_orderpriority, {_LOG} AS y FROM orders),
    w AS (SELECT o_orderkey, list(y) OVER (PARTITION BY {_OPART} ORDER BY {_OORDER}
      ROWS BETWEEN {_HAMMING} PRECEDING AND 1 PRECEDING) AS xs FROM logged),
    m AS (SELECT o_orderkey, xs, ws, CASE WHEN len(xs) = {_HAMMING} THEN list_dot_product(xs, ws) / list_sum(ws) END AS mean FROM w, q)
    SELECT o_orderkey, round(mean, 6) AS sales_roll_mean_{_HAMMING}, CASE WHEN mean IS NOT NULL THEN
      round(sqrt(list_dot_product(list_transform(xs, lambda x: pow(x - mean, 2)), ws) / list_sum(ws) * {_HAMMING} / {_HAMMING - 1}), 6)
      END AS sales_roll_std_{_HAMMING} FROM m"""


def _hamming(spark, sf_dir, layout, block_rows=BLOCK_ROWS):
    out = create_time_series_features(
        table(spark, sf_dir, "orders").select(*_ORDERS), "o_totalprice", ["o_orderdate", "o_orderkey"], "o_orderpriority",
        windows=[_HAMMING], win_type="hamming", log_transformation=True, roll=True, roll_mean=True, roll_std=True,
        date_related=False, layout=layout, block_rows=block_rows,
    )
    return rounded(out.drop("o_orderdate", "o_orderpriority", "o_totalprice"))


@register("w12_wide_hamming", _HAMMING_SQL)
def w12_wide_hamming(spark, sf_dir):
    return _hamming(spark, sf_dir, "whole")


@register("w12_wide_hamming_in_blocks", _HAMMING_SQL)
def w12_wide_hamming_in_blocks(spark, sf_dir):
    return _hamming(spark, sf_dir, "blocks", 500)
