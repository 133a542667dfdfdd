"""Records of CSV files with line breaks inside quoted texts, cut by many tasks.

Whether a byte range begins inside a quoted text follows from the number of quotation marks before it in its file. A
first scan counts them per range, and a running parity over the ranges (one row each) gives the state every range begins
in. A second scan then joins the lines of a range to records. Only the fragments at the ends of ranges, two a range at
most, meet those of other ranges; a record may reach over any number of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import named
from ..session import materialize

_RANGE = ["file", "range"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, range (its first byte), line, odd (whether the line has an odd number of quotation marks), blank."""
    lines = spark.read.option("lineSep", "\n").text(path)
    line = F.regexp_replace("value", "\r$", "")
    marks = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range"),
        line.alias("line"),
        (marks % 2).alias("odd"),
        (F.trim(line) == "").alias("blank"),
    )


def _ranges(lines: DataFrame) -> DataFrame:
    """For every range: whether it begins inside a quoted text, and in which range its file's header begins."""
    counted = lines.groupBy(*_RANGE).agg(F.sum("odd").alias("odd"), F.bool_or(~F.col("blank")).alias("text"))
    file = Window.partitionBy("file")
    before = file.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select(
        *_RANGE,
        (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).alias("inside"),
        F.min(F.when(F.col("text"), F.col("range"))).over(file).alias("header_range"),
    )


def _fragments(lines: DataFrame, ranges: DataFrame) -> DataFrame:
    """Pieces of records, one row for each range a record has lines in: number 0 goes on from the range before.

    Shuffled once, by range; a range is as long as ``spark.sql.files.maxPartitionBytes`` at most.
    """
    numbered = lines.withColumn("at", F.monotonically_increasing_id()).join(ranges, _RANGE)
    in_range = Window.partitionBy(*_RANGE)
    earlier = in_range.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    inside = (F.col("inside") + F.coalesce(F.sum("odd").over(earlier), F.lit(0))) % 2 == 1
    numbered = numbered.withColumn("inside", inside).where(F.col("inside") | ~F.col("blank"))
    starts = F.sum((~F.col("inside")).cast("long")).over(in_range.orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    pieces = numbered.withColumn("number", starts).groupBy(*_RANGE, "number", "header_range").agg(
        F.array_sort(F.collect_list(F.struct("at", "line"))).alias("lines")
    )
    return pieces.select(
        *_RANGE,
        "number",
        F.array_join("lines.line", "\n").alias("record"),
        ((F.col("number") == 0) | (F.col("number") == F.max("number").over(in_range))).alias("at_end"),
        ((F.col("range") == F.col("header_range")) & (F.col("number") == 1)).alias("header"),
    )


def split_records(spark: SparkSession, path: str) -> DataFrame:
    """``record``: the records of all files without their header records, line breaks inside as ``\\n``.

    Blank lines outside quoted texts are no records. Quotation marks inside a quoted text are doubled; one in a text
    without quotes opens a quoted text here. A text that is never closed takes the rest of its file.
    """
    lines = _lines(spark, path)
    pieces = materialize(_fragments(lines, _ranges(lines)), "csv-records")
    inner = pieces.where(~F.col("at_end") & ~F.col("header")).select("record")
    # a record's first piece has a number, those in later ranges are 0
    in_file = Window.partitionBy("file").orderBy("range", "number").rowsBetween(Window.unboundedPreceding, 0)
    ends = pieces.where("at_end").withColumn("chain", F.sum((F.col("number") > 0).cast("long")).over(in_file))
    joined = ends.groupBy("file", "chain").agg(
        F.array_sort(F.collect_list(F.struct("range", "number", "record"))).alias("pieces"), F.bool_or("header").alias("header")
    )
    return inner.unionByName(joined.where(~F.col("header")).select(F.array_join("pieces.record", "\n").alias("record")))


def surplus_fields(record: Column, sep: str, width: int) -> Column:
    """Whether a record has more than ``width`` fields, an empty last one included."""
    wider = ", ".join(f"c{k} string" for k in range(width + 1))
    options = {"sep": sep, "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
    parsed = F.from_csv(F.concat(record, F.lit("x")), wider, options)[f"c{width}"].isNotNull()
    breaks = F.length(record) - F.length(F.replace(record, F.lit(sep), F.lit("")))
    return (breaks >= width * len(sep)) & parsed


def parse_records(records: DataFrame, names: list[str], sep: str) -> DataFrame:
    """The fields of ``record`` as text columns; missing ones at the end are missing values, more than ``names`` raise."""
    record = named("record")
    message = F.concat(F.lit("more fields than the header has: "), record)
    sound = F.when(surplus_fields(record, sep, len(names)), F.raise_error(message).cast("boolean")).otherwise(True)
    schema = ", ".join(f"c{k} string" for k in range(len(names)))
    fields = F.from_csv(record, schema, {"sep": sep, "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"})
    parsed = records.where(sound).select(fields.alias("fields"))
    return parsed.select(*[F.col("fields")[f"c{k}"].alias(name) for k, name in enumerate(names)])
