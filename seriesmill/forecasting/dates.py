"""Frequency of a series and the dates that follow it."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.layout import SeriesRows, lay_out

DAY = 86_400
FALLBACK = ("D", "seconds", DAY)

# Names of weekly frequencies by weekday (Monday = 0), and seconds of unit letters.
WEEKLY = ["W-MON", "W-TUE", "W-WED", "W-THU", "W-FRI", "W-SAT", "W-SUN"]
UNIT_MICROSECONDS = {"ms": 1000, "us": 1}
UNIT_SECONDS = {"D": DAY, "W": 7 * DAY, "H": 3600, "h": 3600, "T": 60, "min": 60, "S": 1, "s": 1}
MONTH_STARTS = {"MS": 1, "QS": 3, "YS": 12, "AS": 12}
MONTH_ENDS = {"M": 1, "ME": 1, "Q": 3, "QE": 3, "Y": 12, "YE": 12, "A": 12}


def parse_frequency(freq: str) -> tuple[str, str, int]:
    """(name, unit, step) of a name like ``MS``, ``ME``, ``W-SUN``, ``B``, ``14D`` or ``H``.

    Names that cannot be read count as daily.
    """
    match = re.fullmatch(r"(\d*)([A-Za-z]+)(?:-[A-Z]{3})?", freq)
    if not match:
        return FALLBACK
    times, base = int(match[1] or 1), match[2]
    if base == "B":
        return freq, "weekdays", times
    for unit, names in (("month_start", MONTH_STARTS), ("month_end", MONTH_ENDS), ("seconds", UNIT_SECONDS), ("microseconds", UNIT_MICROSECONDS)):
        if base in names:
            return freq, unit, names[base] * times
    return FALLBACK


def given_frequency(freq: str) -> tuple[str, str, int]:
    """As ``parse_frequency`` for a name that a caller passes; raises where it cannot be read."""
    found = parse_frequency(freq)
    if found == FALLBACK and freq != FALLBACK[0]:
        raise ValueError(f"frequency {freq!r} is not known")
    return found


def _seconds(c: Column) -> Column:
    """Seconds since 1970 of a zone-free timestamp, with their fraction, whatever the session's time zone."""
    days = F.datediff(c, F.lit("1970-01-01").cast("date")).cast("long")
    return days * DAY + F.hour(c) * 3600 + F.minute(c) * 60 + F.extract(F.lit("SECOND"), c)


def gap_columns(w: WindowSpec, ds_col: str) -> dict[str, Column]:
    ds, prev = F.col(ds_col), F.lag(ds_col, 1).over(w)
    months = F.year(ds) * 12 + F.month(ds)
    return {
        "__gap": _seconds(ds) - _seconds(prev),
        "__months": months - (F.year(prev) * 12 + F.month(prev)),
    }


def frequency_columns(ds_col: str) -> dict[str, Column]:
    """Aggregates over the rows of one series that carry ``__gap`` and ``__months``."""
    ds = F.col(ds_col)
    day_only = F.bool_and(_seconds(ds) % DAY == 0)
    even_gap = (F.min("__gap") == F.max("__gap")) & (F.min("__gap") > 0)
    even_months = (F.min("__months") == F.max("__months")) & (F.min("__months") > 0) & day_only
    monday = F.weekday(ds) == 0
    weekdays = day_only & F.bool_and(
        (F.weekday(ds) < 5) & (F.col("__gap").isNull() | (F.col("__gap") == F.when(monday, 3 * DAY).otherwise(DAY)))
    )
    step_months, step_seconds = F.min("__months"), F.min("__gap")
    unit = (
        F.when(F.count(F.lit(1)) < 3, None)
        .when(even_months & F.bool_and(F.dayofmonth(ds) == 1), "month_start")
        .when(even_months & F.bool_and(F.to_date(ds) == F.last_day(ds)), "month_end")
        .when(even_gap & (F.min("__gap") % 1 == 0), "seconds")
        .when(even_gap, "microseconds")
        .when(weekdays, "weekdays")
    )
    return {
        "__unit": unit,
        "__step": F.when(unit.isin("month_start", "month_end"), step_months)
        .when(unit == "seconds", step_seconds)
        .when(unit == "microseconds", step_seconds * 1_000_000)
        .when(unit == "weekdays", 1)
        .cast("long"),
        "__weekday": F.weekday(F.max(ds)),
    }


def _multiple(n: Column, name: str) -> Column:
    return F.when(n == 1, name).otherwise(F.concat(n.cast("string"), F.lit(name)))


def _name(unit: Column, step: Column, weekday: Column) -> Column:
    def monthly(suffix: str) -> Column:
        return F.when(step == 3, f"Q{suffix}").when(step == 12, f"Y{suffix}").otherwise(_multiple(step, f"M{suffix}"))

    weekly = F.element_at(F.array(*[F.lit(n) for n in WEEKLY]), weekday + 1)
    timed = (
        F.when(step == 7 * DAY, weekly)
        .when(step % DAY == 0, _multiple(F.floor(step / DAY), "D"))
        .when(step % 3600 == 0, _multiple(F.floor(step / 3600), "h"))
        .when(step % 60 == 0, _multiple(F.floor(step / 60), "min"))
        .otherwise(_multiple(step, "s"))
    )
    return (
        F.when(unit == "month_start", monthly("S"))
        .when(unit == "month_end", F.when(step == 3, "QE").when(step == 12, "YE").otherwise(_multiple(step, "ME")))
        .when(unit == "weekdays", "B")
        .when(unit == "seconds", timed)
        .when(unit == "microseconds", F.when(step % 1000 == 0, _multiple(F.floor(step / 1000), "ms")).otherwise(_multiple(step, "us")))
    )


def with_gaps(rows: SeriesRows, ds_col: str) -> SeriesRows:
    return rows.with_columns(1, lambda w: gap_columns(w, ds_col))


def name_frequency(stats: DataFrame) -> DataFrame:
    """Turn the aggregates of ``frequency_columns`` into ``freq``, ``freq_unit`` and ``freq_step``."""
    name, unit, step = FALLBACK
    return stats.withColumns(
        {
            "freq": F.coalesce(_name(F.col("__unit"), F.col("__step"), F.col("__weekday")), F.lit(name)),
            "freq_unit": F.coalesce("__unit", F.lit(unit)),
            "freq_step": F.coalesce("__step", F.lit(step).cast("long")),
        }
    ).drop("__unit", "__step", "__weekday")


def with_frequency(stats: DataFrame, freq: str | None) -> DataFrame:
    """The given frequency for every series, or the one its aggregates show."""
    if freq is None:
        return name_frequency(stats)
    name, unit, step = given_frequency(freq)
    return stats.withColumns({"freq": F.lit(name), "freq_unit": F.lit(unit), "freq_step": F.lit(step).cast("long")})


def infer_frequency(df: DataFrame, id_col: str = "unique_id", ds_col: str = "ds", layout: str = "auto") -> DataFrame:
    """Frequency of every series from its gaps; daily when there are under three dates or no pattern."""
    rows = with_gaps(lay_out(df.select(id_col, ds_col), [id_col], [ds_col], layout), ds_col)
    stats = rows.to_frame().groupBy(id_col).agg(*[c.alias(n) for n, c in frequency_columns(ds_col).items()])
    return name_frequency(stats)


def future_date(last: Column, unit: Column, step: Column, i: Column) -> Column:
    """The ``i``-th date (from 1) after ``last``."""
    n = (step * i).try_cast("int")
    month_start = F.add_months(F.trunc(last, "month"), n)
    at_end = F.to_date(last) == F.last_day(last)
    month_end = F.last_day(F.add_months(F.trunc(last, "month"), F.when(at_end, n).otherwise(n - step.cast("int"))))
    from_day = F.least(F.weekday(last), F.lit(4)) + n
    back = F.greatest(F.weekday(last) - 4, F.lit(0))
    weekdays = F.date_add(F.to_date(last), (n - back + 2 * F.floor(from_day / 5)).cast("int"))
    timed = F.timestamp_add("SECOND", (step * i).cast("long"), last)
    return (
        F.when(unit == "month_start", month_start.cast("timestamp_ntz"))
        .when(unit == "month_end", month_end.cast("timestamp_ntz"))
        .when(unit == "weekdays", weekdays.cast("timestamp_ntz"))
        .when(unit == "microseconds", F.timestamp_add("MICROSECOND", (step * i).cast("long"), last))
        .otherwise(timed)
    )


def _elapsed(rows: DataFrame, ds_col: str, since: str, unit: str) -> Column:
    """Whole months, or seconds as a double, from column ``since`` to ``ds_col``."""
    ds, first = F.col(ds_col), F.col(since)
    if unit == "month_start":
        return F.year(ds) * 12 + F.month(ds) - F.year(first) * 12 - F.month(first)
    kind = rows.schema[ds_col].dataType
    if isinstance(kind, T.DateType):
        return (F.datediff(ds, first) * DAY).cast("double")
    seconds = (lambda c: c.cast("double")) if isinstance(kind, T.TimestampType) else _seconds
    return (seconds(ds) - seconds(first)).cast("double")


def fill_dates(df: DataFrame, freq: str = "MS", id_col: str = "unique_id", ds_col: str = "ds") -> DataFrame:
    """The rows, and one with nulls for every date of the frequency that a series leaves out between its first and last.

    ``freq``: month starts or steps of days and below. Rows without an id leave out every date. One shuffle brings the rows
    of a series together, and each row adds the dates up to the next: the result is still dealt by ``id_col``.
    """
    _, unit, step = given_frequency(freq)
    if unit not in ("month_start", "seconds"):
        raise ValueError(f"dates of frequency {freq!r} cannot be filled")

    def on_grid(k: Column) -> Column:
        n = k * step
        return F.col("__first") + (F.make_ym_interval(F.lit(0), n.cast("int")) if unit == "month_start" else F.make_dt_interval(secs=n))

    # As many tasks as Spark is set to: joined by the bytes of the rows that are known, they would hold many times more.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = df.where(F.col(ds_col).isNotNull()).repartition(tasks, id_col)
    w = Window.partitionBy(id_col).orderBy(ds_col)
    rows = known.withColumns({"__first": F.first(ds_col).over(w), "__next": F.lead(ds_col).over(w)})
    rows = rows.withColumns({"__at": _elapsed(rows, ds_col, "__first", unit), "__to": _elapsed(rows, "__next", "__first", unit)})
    ds, after, last, no_id = F.col(ds_col), F.col("__next"), F.col("__next").isNull(), F.col(id_col).isNull()
    # One place more on either side than can be left out; which of them are is decided by the dates.
    places = F.sequence(F.greatest(F.floor(F.col("__at") / step), F.lit(0)), F.ceil(F.coalesce("__to", "__at") / step))
    left_out = F.filter(
        F.transform(places, on_grid),
        lambda d: ((d > ds) | (no_id & (d == ds))) & F.when(last, d <= ds).otherwise(d < after),
    )
    dates = F.concat(
        F.array(F.struct(ds.alias("date"), F.lit(True).alias("known"))),
        F.transform(left_out, lambda d: F.struct(d.alias("date"), F.lit(False).alias("known"))),
    )
    some = F.when((after > ds) | (no_id & last), dates).otherwise(F.slice(dates, 1, 1))
    out = rows.withColumn("__date", F.explode(some))
    keep = {id_col: F.col(id_col), ds_col: F.col("__date.date")}
    return out.select([keep.get(c, F.when(F.col("__date.known"), F.col(f"`{c}`"))).alias(c) for c in df.columns])
