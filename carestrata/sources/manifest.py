"""Resumable loads: which files are already in, unchanged and complete."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata.operators.fingerprints import DIGEST, digest
from carestrata.operators.quality import row_counts
from carestrata.runtime import materialise
from carestrata.sources.datasets import open_table, write_table
from carestrata.sources.delimited import check_names, list_files, read_staging

MANIFEST = "load_manifest"
_MANIFEST_SCHEMA = "table_name string, signature string, loaded_rows bigint, loaded_at timestamp"


def pending_files(files: DataFrame, manifest: DataFrame, stored: DataFrame) -> DataFrame:
    """Files that must be loaded.

    A file is done when its latest entry has the same signature and the stored
    table still holds the recorded number of rows.
    """
    latest = manifest.groupBy("table_name").agg(
        F.max_by(F.struct("signature", "loaded_rows"), "loaded_at").alias("m")
    ).select("table_name", "m.signature", F.col("m.loaded_rows").alias("row_count"))
    current = latest.join(stored, ["table_name", "row_count"], "left_semi")
    return files.join(current, ["table_name", "signature"], "left_anti")


def with_contents(files: DataFrame) -> DataFrame:
    """Extracts whose signature is a digest of their lines instead of size and time.

    Reads every file once. The order of lines and how they are cut into files do not
    matter, since they do not change a table.
    """
    spark = files.sparkSession
    digests = [
        digest(spark.read.text(row.path, recursiveFileLookup=True)).select(
            F.lit(row.table_name).alias("table_name"),
            F.concat_ws("|", "n_rows", *DIGEST).alias("signature"),
            F.lit(row.path).alias("path"),
        )
        for row in files.select("table_name", "path").collect()
    ]
    return reduce(DataFrame.unionByName, digests) if digests else files


def load_folder(spark: SparkSession, folder: str, dataset: str, by_contents: bool = False) -> list[str]:
    """Bring a dataset's staging tables up to date with a folder of extracts.

    Each pending table is replaced whole, and only then recorded, so a load that
    dies leaves it pending. The loop runs over file names, not over data. With
    ``by_contents`` an edit that keeps size and time is found too, and a touched file
    is not loaded again, at the cost of reading every file.
    """
    files = check_names(list_files(spark, folder))
    if by_contents:
        files = materialise(with_contents(files), "contents")
    manifest = open_table(spark, dataset, MANIFEST)
    manifest = manifest if manifest is not None else spark.createDataFrame([], _MANIFEST_SCHEMA)
    tables = {
        row.table_name: table
        for row in files.select("table_name").collect()
        if (table := open_table(spark, dataset, row.table_name)) is not None
    }
    stored = row_counts(tables) if tables else spark.createDataFrame([], "table_name string, row_count bigint")
    loaded = []
    for row in pending_files(files, manifest, stored).orderBy("table_name").collect():
        write_table(read_staging(spark, row.path), dataset, row.table_name)
        rows = open_table(spark, dataset, row.table_name).count()
        entry = spark.createDataFrame([(row.table_name, row.signature, rows)], "table_name string, signature string, loaded_rows bigint")
        write_table(entry.withColumn("loaded_at", F.current_timestamp()), dataset, MANIFEST, "append")
        loaded.append(row.table_name)
    return loaded
