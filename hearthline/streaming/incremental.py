"""Incremental load of daily files with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hearthline.sources.readers import csv_options


def new_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    file_format: str = "csv",
    files_per_batch: int | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """A stream of the rows of files that appear in a folder."""
    reader = spark.readStream.schema(schema).format(file_format)
    if file_format == "csv":
        reader = reader.options(**csv_options(multi_line))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def drain(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, str], None]) -> StreamingQuery:
    """Hand every new micro-batch, as a plain DataFrame with a load id, to ``write``, then stop.

    A batch that is repeated after a failure has the same load id again; a new
    checkpoint gives other ids.
    """

    def one(batch: DataFrame, number: int) -> None:
        # The stream's id lives in its checkpoint, so a restart has the same.
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        write(batch, f"{stream_id}-{number}")

    query = (
        stream.writeStream.foreachBatch(one)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def load_available(
    stream: DataFrame, target: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df
) -> StreamingQuery:
    """Process everything that is there, then stop; the next run takes the rest.

    Each micro-batch is prepared as a plain DataFrame and replaces the folder
    of its own stream and number, so a batch that is repeated after a failure
    does not double its rows, and two batches never touch each other's, also
    when a new checkpoint starts counting from zero again.
    """

    def write(batch: DataFrame, load_id: str) -> None:
        (
            prepare(batch).withColumn("load_id", F.lit(load_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("load_id")
            .parquet(target)
        )

    return drain(stream, checkpoint, write)
