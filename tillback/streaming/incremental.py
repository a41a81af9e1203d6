"""Loading only the files that were not loaded before.

A repeated load skips files it has already taken; here the checkpoint of a file stream keeps that
record, and every run takes what has landed since the last one and then ends.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillback.sources.landing import CSV_FORMAT, text_schema, typed_rows


def copy_new_files(
    spark: SparkSession, table: str, landing: str, target: str, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Append the rows of new files in ``landing`` to the parquet folder ``target``.

    All new files are taken, in batches of at most ``files_per_batch`` files.
    """
    reader = spark.readStream.options(**CSV_FORMAT).schema(text_schema(table)).option("maxFilesPerTrigger", files_per_batch)
    stream = (
        typed_rows(reader.csv(landing), table)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    return stream
