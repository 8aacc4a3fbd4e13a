"""Incremental intake of a growing form (S1 re-aimed for a stream).

The original form is re-read in full on every run.  Here each export of
the form lands as a file in a folder; a Structured Streaming query picks up
new files and appends to a Parquet table, which the batch jobs read, every
submission that the table doesn't have yet — however late it comes.  A batch
that is repeated after a failure finds its rows there and adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def start_form_intake(spark: SparkSession, source_dir: str, schema: T.StructType,
                      table_dir: str, checkpoint_location: str, fmt: str = "csv",
                      key: str = "submission_id", once: bool = False) -> StreamingQuery:
    """Start the intake; ``once=True`` processes what is there and stops."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        # check header names against the schema instead of mapping by position
        reader = reader.option("header", "true").option("enforceSchema", "false")
    spark.createDataFrame([], schema).write.mode("append").parquet(table_dir)  # there from the start

    def add(batch: DataFrame, _: int) -> None:
        known = batch.sparkSession.read.schema(schema).parquet(table_dir).select(key)
        rows = batch.dropDuplicates([key])
        rows.join(known, rows[key].eqNullSafe(known[key]), "left_anti").write.mode("append").parquet(table_dir)

    writer = reader.load(source_dir).writeStream.foreachBatch(add).option(
        "checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    return writer.start()
