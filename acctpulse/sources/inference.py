"""Column types of CSV files, inferred from every value.

The types form a lattice: boolean, bigint < double, date, timestamp, and text
above all (dates and timestamps in one column make it text).  A value stands for
the set of types it can be read as, kept as a bit mask; a NULL can be read as
any.  The types of a column are the intersection of its values' sets, so masks
merge by bitwise AND in any order: in a task, between tasks, between files, and
with a state stored from earlier files.  One aggregate over the whole input folds
them; nothing is sampled, so a value that first departs from its column's type
in the last row still counts.  A column without a value is text.

Digits after a leading zero are text, so that identifiers keep their zeros, and
whole numbers beyond 64 bits are double.  Dates and timestamps are read in ISO
form only; other forms, times of day and zoned timestamps stay text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The types from the narrowest; of those that all values of a column can be read as, the first is taken.
LATTICE = ("boolean", "bigint", "double", "date", "timestamp_ntz", "string")
_ANY = (1 << len(LATTICE)) - 1
_TEXT = 1 << LATTICE.index("string")

BOOLEANS = ("true", "false", "t", "f", "yes", "no")
_INTEGER = r"^\s*-?(0|[1-9][0-9]{0,18})\s*$"
_NUMBER = r"^\s*-?((0|[1-9][0-9]*)(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_DATE = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\s*$"
_TIMESTAMP = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?\s*$"


def readable_as(value: Column) -> Column:
    """The set of types a text value can be read as; NULL can be read as all."""
    trimmed = F.trim(value)

    def bit(name: str, holds: Column) -> Column:
        return F.when(holds, F.lit(1 << LATTICE.index(name))).otherwise(F.lit(0))

    bits = [
        bit("boolean", F.lower(trimmed).isin(*BOOLEANS)),
        bit("bigint", value.rlike(_INTEGER) & trimmed.try_cast("bigint").isNotNull()),
        bit("double", value.rlike(_NUMBER)),
        bit("date", value.rlike(_DATE) & trimmed.try_cast("date").isNotNull()),
        bit("timestamp_ntz", value.rlike(_TIMESTAMP) & trimmed.try_cast("timestamp_ntz").isNotNull()),
    ]
    return F.when(value.isNull(), F.lit(_ANY)).otherwise(reduce(Column.bitwiseOR, bits, F.lit(_TEXT)))


def type_state(text_columns: DataFrame) -> DataFrame:
    """(place, column_name, mask, filled): the folded sets of all columns, in one aggregate."""
    names = text_columns.columns
    quoted = ["`" + c.replace("`", "``") + "`" for c in names]
    folded = text_columns.agg(
        *[F.coalesce(F.bit_and(readable_as(F.col(q))), F.lit(_ANY)).alias(f"m{i}") for i, q in enumerate(quoted)],
        *[F.count(F.col(q)).alias(f"n{i}") for i, q in enumerate(quoted)])
    rows = [F.struct(F.lit(i).alias("place"), F.lit(c).alias("column_name"), F.col(f"m{i}").alias("mask"), F.col(f"n{i}").alias("filled"))
            for i, c in enumerate(names)]
    return folded.select(F.inline(F.array(*rows)))


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of several inputs together, from their states alone."""
    return (reduce(DataFrame.unionByName, states).groupBy("column_name")
            .agg(F.min("place").alias("place"), F.bit_and("mask").alias("mask"), F.sum("filled").alias("filled"))
            .select("place", "column_name", "mask", "filled"))


def inferred_schema(state: DataFrame, declared: T.StructType | None = None) -> T.StructType:
    """The schema of a state (one row per column); declared columns keep their declared type."""
    own = {f.name: f.dataType for f in declared or []}
    fields = []
    for row in state.orderBy("place", "column_name").collect():
        name = "string" if not row.filled else next(t for i, t in enumerate(LATTICE) if row.mask >> i & 1)
        fields.append(T.StructField(row.column_name, own.get(row.column_name, T._parse_datatype_string(name))))
    return T.StructType(fields)


def read_text_csv(spark: SparkSession, path: str | list[str], null_value: str = "") -> DataFrame:
    """All columns of a header CSV as text."""
    return spark.read.option("header", True).option("inferSchema", False).option("nullValue", null_value).option("mode", "FAILFAST").csv(path)


def typed(text_columns: DataFrame, schema: T.StructType) -> DataFrame:
    """The text columns cast to a schema that all their values can be read as."""
    def column(field: T.StructField) -> Column:
        own = F.col("`" + field.name.replace("`", "``") + "`")
        return (own if field.dataType == T.StringType() else F.trim(own).cast(field.dataType)).alias(field.name)

    return text_columns.select(*[column(f) for f in schema])


def read_csv_inferred(spark: SparkSession, path: str | list[str], null_value: str = "", declared: T.StructType | None = None) -> DataFrame:
    """A header CSV with the types of all its values; a declared column keeps its declared type."""
    text = read_text_csv(spark, path, null_value)
    return typed(text, inferred_schema(type_state(text), declared))
