"""Present a frame in engine-neutral types for cross-engine comparison:
dates and timestamps as ISO text, decimals as double, every integer as
bigint.  The library's own frames keep their native types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def portable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(t, T.FloatType):
            c = c.cast("double")
        elif isinstance(t, T.BooleanType):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)
