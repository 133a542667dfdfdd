"""Readers: CSV with pandas-like typing, catalog tables, queries, and the config-driven factory."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import named
from .records import parse_records, split_records, surplus_fields

# The texts a CSV reader takes for a missing value.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Texts that read as a whole number and as a number.
WHOLE_PATTERN = r"^[+-]?\d+$"
NUMBER_PATTERN = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))$"

# What a cell can be read as; a column's type follows from the set of kinds seen in it. A long whole number is one
# that a double may not hold.
_MISSING, _WHOLE, _NUMBER, _FLAG, _TEXT, _LONG_WHOLE = range(6)
_EXACT_DIGITS = 15
_LINE = "_line"


def _raw_frame(spark: SparkSession, path: str, sep: str, multi_line: bool | str = False) -> DataFrame:
    """All columns as text; a line with more fields than the header, or a path that does not exist, raises."""
    reader = spark.read.option("header", True).option("sep", sep).option("escape", '"').option("multiLine", bool(multi_line))
    names = reader.csv(path).columns
    if multi_line and multi_line != "file":
        return parse_records(split_records(spark, path), names, sep)
    schema = T.StructType([*[T.StructField(c, T.StringType()) for c in names], T.StructField(_LINE, T.StringType())])
    # fields are counted only where all of them are parsed
    raw = reader.option("columnNameOfCorruptRecord", _LINE).option("columnPruning", False).schema(schema).csv(path)
    # a line with fewer fields ends with missing values; one with more would lose the rest
    surplus = surplus_fields(F.col(_LINE), sep, len(names))
    # named so that the line is never read alone, which Spark refuses
    surplus &= F.length(_LINE) >= F.length(F.coalesce(named(names[0]), F.lit("")))
    message = F.concat(F.lit("more fields than the header has: "), F.col(_LINE))
    return raw.where(F.when(F.col(_LINE).isNotNull() & surplus, F.raise_error(message).cast("boolean")).otherwise(True)).drop(_LINE)


def _check_quotes(spark: SparkSession, path: str) -> None:
    """Raise where a quoted text goes on in the next line, which is only read as such with ``multi_line``."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    if not spark.read.text(path).where(quotes % 2 == 1).isEmpty():
        raise ValueError(f"{path} has quoted line breaks: read it with multi_line=True")


def _is_missing(cell: Column) -> Column:
    return cell.isNull() | cell.isin(MISSING_TEXTS)


def _kind(cell: Column) -> Column:
    number = F.trim(cell)
    long = F.when(number.try_cast("bigint").isNull(), _TEXT).otherwise(_LONG_WHOLE)
    return (
        F.when(_is_missing(cell), _MISSING)
        .when(number.rlike(WHOLE_PATTERN), F.when(F.length(number) <= _EXACT_DIGITS, _WHOLE).otherwise(long))
        .when(number.rlike(NUMBER_PATTERN), _NUMBER)
        .when(F.lower(cell).isin("true", "false"), _FLAG)
        .otherwise(_TEXT)
    )


def _column_type(seen: set[int]) -> T.DataType:
    found = seen - {_MISSING}
    if found == {_FLAG}:
        return T.StringType() if _MISSING in seen else T.BooleanType()
    if found & {_FLAG, _TEXT}:
        return T.StringType()
    if _NUMBER not in found and (_LONG_WHOLE in found or seen == {_WHOLE}):
        return T.LongType()
    return T.DoubleType()


def infer_types(raw: DataFrame) -> T.StructType:
    """Whole numbers without gaps are bigint, other numbers double, true/false boolean, the rest text.

    Whole numbers of more than 15 digits are bigint with gaps too, and text beyond 64 bits: a double would lose
    digits. Blanks around a number do not count. Dates stay text. One aggregate over the file collects a bit set of kinds per column; give a schema to
    avoid reading the file a second time.
    """
    bits = [F.bit_or(F.call_function("shiftleft", F.lit(1), _kind(named(c)))).alias(f"c{i}") for i, c in enumerate(raw.columns)]
    masks = raw.agg(*bits).first()
    kinds = [{k for k in range(6) if (mask or 0) >> k & 1} for mask in masks]
    return T.StructType([T.StructField(c, _column_type(seen)) for c, seen in zip(raw.columns, kinds)])


def read_csv(
    spark: SparkSession, path: str, sep: str = ",", schema: T.StructType | str | None = None, multi_line: bool | str = False
) -> DataFrame:
    """CSV with a header row. Without a schema the column types are inferred from all rows.

    A line with more fields than the header raises when it is read. ``multi_line=True`` allows line breaks inside quoted
    texts, in as many tasks as the files have ranges (``records.split_records``), for two scans and one shuffle.
    ``multi_line="file"`` leaves it to Spark's reader, one task for a file; only needed where texts without quotes hold quotation marks.
    """
    raw = _raw_frame(spark, path, sep, multi_line)
    if schema is None and not multi_line:
        _check_quotes(spark, path)
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    schema = schema or infer_types(raw)

    def cell(f: T.StructField) -> Column:
        text = named(f.name)
        value = text if isinstance(f.dataType, T.StringType) else F.trim(text)
        return F.when(~_is_missing(text), value).cast(f.dataType).alias(f.name)

    return raw.select(*[cell(f) for f in schema])


def read_table(spark: SparkSession, *name_parts: str | None) -> DataFrame:
    """``SELECT *`` of a catalog table named by its non-empty parts."""
    return spark.table(".".join(f"`{p}`" for p in name_parts if p))


def read_query(spark: SparkSession, query: str) -> DataFrame:
    return spark.sql(query)


@dataclass(frozen=True)
class Loader:
    """A configured source. ``load(query=...)`` runs SQL instead, where the source is a warehouse."""

    spark: SparkSession
    config: dict[str, Any]
    read: Callable[[SparkSession, dict[str, Any]], DataFrame]
    takes_query: bool = False

    def load(self, query: str | None = None) -> DataFrame:
        if query is not None and self.takes_query:
            return read_query(self.spark, query)
        return self.read(self.spark, self.config)


def _load_csv(spark: SparkSession, c: dict[str, Any]) -> DataFrame:
    return read_csv(spark, c["filepath"], c.get("sep", ","), c.get("schema"), c.get("multi_line", False))


def _load_table(spark: SparkSession, c: dict[str, Any]) -> DataFrame:
    if not c.get("table_id"):
        raise ValueError("table_id is needed when no query is given")
    return read_table(spark, c.get("project_id"), c.get("dataset_id"), c["table_id"])


def _load_parquet(spark: SparkSession, c: dict[str, Any]) -> DataFrame:
    return spark.read.parquet(c["filepath"])


def _load_sql(spark: SparkSession, c: dict[str, Any]) -> DataFrame:
    return read_query(spark, c["query"])


# Source types; "bigquery" and "table" name a table the session catalog knows, as catalog.schema.table.
_SOURCES = {
    "csv": (_load_csv, False),
    "parquet": (_load_parquet, False),
    "sql": (_load_sql, True),
    "table": (_load_table, True),
    "bigquery": (_load_table, True),
}


def get_loader(spark: SparkSession, config: dict[str, Any]) -> Loader:
    kind = config.get("type")
    if kind not in _SOURCES:
        raise ValueError(f"loader type {kind!r} is not one of {', '.join(_SOURCES)}")
    read, takes_query = _SOURCES[kind]
    return Loader(spark, config, read, takes_query)


def preview(df: DataFrame, order_by: list[str], rows: int = 5) -> DataFrame:
    """The first rows in a stated order (a top-k, not a full sort)."""
    return df.orderBy(*order_by).limit(rows)
