"""Raw inputs and outputs.

* explicit schemas for the three raw tables (no inference on the job path;
  dates and timestamps arrive as text and are typed in staging),
* ``read_raw_csv``: a header CSV with the explicit schema,
* ``read_raw_table``: a raw table by logical name from a name -> location map
  (a catalog table ``db.name`` or a Parquet folder),
* ``register_views``: staged / intermediate frames as temporary views,
* ``write_mart``: full-refresh write of the mart as a table or Parquet folder,
* ``load_raw``: CSV -> Parquet tables before a run; ``load_raw_with_rejects``
  keeps the rows that do not fit in a table of their own.

Columns without a declared schema are read by ``inference``; a mart that is read
while it is refreshed is kept by ``versions``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_SCHEMAS: dict[str, T.StructType] = {
    "accounts": T.StructType([
        T.StructField("account_id", T.StringType()),
        T.StructField("account_name", T.StringType()),
        T.StructField("division", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("customer_since", T.StringType()),
        T.StructField("csm_owner", T.StringType()),
        T.StructField("renewal_date", T.StringType()),
    ]),
    "subscriptions": T.StructType([
        T.StructField("subscription_id", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("product", T.StringType()),
        T.StructField("arr_usd", T.DecimalType(18, 4)),
        T.StructField("term_start_date", T.StringType()),
        T.StructField("term_end_date", T.StringType()),
        T.StructField("status", T.StringType()),
    ]),
    "submissions": T.StructType([
        T.StructField("submission_id", T.StringType()),
        T.StructField("submission_date", T.StringType()),
        T.StructField("submission_timestamp", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("product", T.StringType()),
        T.StructField("user_id", T.StringType()),
    ]),
}
RAW_NAMES = tuple(RAW_SCHEMAS)
# NULL marker of the CSV files this package writes, so '' and NULL stay apart
NULL_MARK = "\\N"


def read_raw_csv(spark: SparkSession, path: str, table: str, null_value: str = "") -> DataFrame:
    """A header CSV of one raw table with its explicit schema; a malformed
    value fails the read.  With the default ``null_value`` an empty field is
    NULL (blank text included); files written by ``write_raw_csv`` mark NULL
    as ``NULL_MARK`` so blanks survive."""
    return (spark.read.schema(RAW_SCHEMAS[table]).option("header", True)
            .option("nullValue", null_value).option("mode", "FAILFAST").csv(path))


def read_raw_table(spark: SparkSession, name: str, locations: dict[str, str]) -> DataFrame:
    """Resolve a logical raw-table name through ``locations``.  A value
    containing '/' or ':' is a Parquet folder, anything else a catalog table."""
    where = locations[name]
    if "/" in where or ":" in where:
        return spark.read.parquet(where)
    return spark.table(where)


def read_raw_tables(spark: SparkSession, locations: dict[str, str]) -> dict[str, DataFrame]:
    return {name: read_raw_table(spark, name, locations) for name in RAW_NAMES}


def register_views(frames: dict[str, DataFrame]) -> list[str]:
    """S3: expose each frame as a temporary view under its key."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)


def register_permanent_views(spark: SparkSession, folders: dict[str, str]) -> list[str]:
    """S3 for other sessions: a catalog view over each Parquet folder, with its
    columns listed; replaced in one step when it exists."""
    for name, folder in folders.items():
        columns = ", ".join("`" + c.replace("`", "``") + "`" for c in spark.read.parquet(folder).columns)
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM parquet.`{folder}`")
    return list(folders)


def write_mart(df: DataFrame, target: str, fmt: str = "parquet") -> None:
    """Full refresh.  A target containing '/' or ':' is a folder, else a table name."""
    writer = df.write.mode("overwrite").format(fmt)
    if "/" in target or ":" in target:
        writer.save(target)
    else:
        writer.saveAsTable(target)


def write_raw_csv(frames: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Write raw frames as header CSV folders (the shape ``load_raw`` reads)."""
    paths = {}
    for name, df in frames.items():
        path = f"{folder.rstrip('/')}/{name}.csv"
        df.write.mode("overwrite").option("header", True).option("nullValue", NULL_MARK).csv(path)
        paths[name] = path
    return paths


def load_raw(spark: SparkSession, csv_paths: dict[str, str], target_folder: str,
             null_value: str = NULL_MARK) -> dict[str, str]:
    """Load each raw CSV with its explicit schema into a Parquet table and
    return the name -> location map for ``read_raw_tables``."""
    locations = {}
    for name, path in csv_paths.items():
        out = f"{target_folder.rstrip('/')}/{name}"
        read_raw_csv(spark, path, name, null_value).write.mode("overwrite").parquet(out)
        locations[name] = out
    return locations


REJECTED, LINE = "rejected", "_line"


class TooManyRejects(Exception):
    """A load with more rows that do not fit than allowed: (table, rejected rows, rows)."""


def load_raw_with_rejects(spark: SparkSession, csv_paths: dict[str, str], target_folder: str, null_value: str = NULL_MARK,
                          max_rejected_share: float = 0.01) -> tuple[dict[str, str], DataFrame]:
    """S5 for files with bad rows: rows that fit the declared schema go to the table,
    the others with their line and the reason to a quarantine beside it, in one pass
    over each file.  Returns the locations for ``read_raw_tables`` and the rejected
    rows (table_name, reason, line).  More rejects than the share allows fail the load."""
    locations, quarantine = {}, []
    for name, path in csv_paths.items():
        schema = RAW_SCHEMAS[name]
        out = f"{target_folder.rstrip('/')}/{name}"
        rows = (spark.read.schema(T.StructType([*schema, T.StructField(LINE, T.StringType())])).option("header", True)
                .option("nullValue", null_value).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE).csv(path))
        rows.withColumn(REJECTED, F.col(LINE).isNotNull()).write.mode("overwrite").partitionBy(REJECTED).parquet(out)
        written = spark.read.schema(T.StructType([*rows.schema, T.StructField(REJECTED, T.BooleanType())])).parquet(out)
        counts = written.agg(F.count_if(F.col(REJECTED)).alias("bad"), F.count(F.lit(1)).alias("n")).first()
        if counts.bad > max_rejected_share * counts.n:
            raise TooManyRejects((name, counts.bad, counts.n))
        locations[name] = f"{out}/{REJECTED}=false"
        # a line with the right number of fields can only have failed by a value
        texts = ", ".join(f"c{i} string" for i in range(len(schema))) + ", bad string"
        parsed = F.from_csv(F.col(LINE), texts, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"})
        reason = F.when(parsed["bad"].isNotNull(), F.lit("number of fields")).otherwise(F.lit("value"))
        quarantine.append(written.filter(F.col(REJECTED)).select(F.lit(name).alias("table_name"), reason.alias("reason"), F.col(LINE).alias("line")))
    rejected = quarantine[0]
    for more in quarantine[1:]:
        rejected = rejected.unionByName(more)
    return locations, rejected


def read_loaded_table(spark: SparkSession, name: str, locations: dict[str, str]) -> DataFrame:
    """A table of ``load_raw_with_rejects``, with its declared columns only."""
    schema = RAW_SCHEMAS[name]
    return spark.read.schema(schema).parquet(locations[name])
