"""Load arriving raw submission files (S5 on arrival).

A Structured Streaming file source reads new CSV files with the explicit raw
schema and adds them to the raw table, one folder per query (named after its
checkpoint) and batch.  A replayed batch replaces its own folder and nothing
else, so rows are neither doubled nor erased by another query.  A malformed row
fails the load, as the batch reader does.  The scores compare whole windows and peer groups: rebuild the mart in
batch (``plans.models.publish``) over ``read_loaded_submissions``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.raw import RAW_SCHEMAS


def submission_file_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None,
                           null_value: str = "") -> DataFrame:
    reader = (spark.readStream.schema(RAW_SCHEMAS["submissions"]).option("header", True)
              .option("nullValue", null_value).option("mode", "FAILFAST"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(folder)


def load_submissions(spark: SparkSession, incoming_folder: str, raw_table: str, checkpoint_location: str,
                     available_now: bool = False, every: str = "5 minutes", null_value: str = "") -> StreamingQuery:
    """Start the load; ``available_now`` processes what is there and stops."""
    load = hashlib.md5(checkpoint_location.rstrip("/").encode()).hexdigest()

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{raw_table.rstrip('/')}/load={load}/epoch={epoch_id}")

    writer = (submission_file_stream(spark, incoming_folder, null_value=null_value).writeStream
              .foreachBatch(on_batch).option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()


def read_loaded_submissions(spark: SparkSession, raw_table: str) -> DataFrame:
    """The loaded raw submissions, without the folder columns."""
    schema = RAW_SCHEMAS["submissions"]
    return spark.read.schema(schema).parquet(raw_table).select(*schema.fieldNames())
