"""Incremental staging of a growing folder of extracts as a stream.

An alternative to the load manifest for one table whose extract arrives in
several files: Spark's own checkpoint remembers which files have been taken.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carestrata.functions.parsing import null_tokens_to_null
from carestrata.sources.delimited import STAGING_NULLS


def stage_new_files(
    spark: SparkSession,
    folder: str,
    columns: list[str],
    target: str,
    checkpoint: str,
    max_files: int = 1000,
) -> None:
    """Append all files not yet taken to the Parquet table ``target``, then stop.

    ``columns`` are those of the headers, in order; a file with another header stops
    the stream instead of being read into the wrong columns.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("maxFilesPerTrigger", max_files)
        .csv(folder)
    )
    query = (
        null_tokens_to_null(rows, STAGING_NULLS)
        .withColumn("source_file", F.input_file_name())
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
