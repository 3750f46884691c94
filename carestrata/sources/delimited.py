"""Scans of comma and tab separated extracts, every column read as text."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata.functions.parsing import blank_to_null, compact_date, null_to_blank, null_tokens_to_null
from carestrata.schema import VOCABULARY, column_type

# Tokens that stand for null in staging and in vocabulary files.
STAGING_NULLS = ("", "NULL")
VOCABULARY_NULLS = ("", "NA")

# Vocabulary files, each named like its table in upper case.
VOCABULARY_FILES = (
    "CONCEPT.csv",
    "CONCEPT_ANCESTOR.csv",
    "CONCEPT_CLASS.csv",
    "CONCEPT_RELATIONSHIP.csv",
    "CONCEPT_SYNONYM.csv",
    "DOMAIN.csv",
    "DRUG_STRENGTH.csv",
    "RELATIONSHIP.csv",
    "VOCABULARY.csv",
)

# Date columns in YYYYMMDD form, text columns that may not be null
# and flags in which an empty text means null.
COMPACT_DATES = {t: ("valid_start_date", "valid_end_date") for t in ("concept", "concept_relationship", "drug_strength")}
NOT_NULL_TEXT = {
    "concept": ("concept_name", "domain_id", "vocabulary_id", "concept_class_id", "concept_code"),
    "concept_relationship": ("relationship_id",),
    "concept_synonym": ("concept_synonym_name", "language_concept_id"),
    "domain": ("domain_name", "domain_concept_id"),
    "relationship": ("relationship_name", "is_hierarchical", "defines_ancestry", "invalid_reason"),
    "vocabulary": ("vocabulary_name", "vocabulary_reference", "vocabulary_version"),
}
NULLABLE_FLAGS = {
    "concept": ("invalid_reason", "standard_concept"),
    "concept_relationship": ("invalid_reason",),
    "drug_strength": ("invalid_reason",),
    "relationship": ("invalid_reason",),
}


def list_files(spark: SparkSession, folder: str, suffix: str = ".csv") -> DataFrame:
    """Extracts of a folder: table name, signature and path.

    An extract is one file of the folder itself, or a folder there of that name
    holding its parts; folders below are other matters. The signature is total size, latest modification and number of files. Contents
    are not read: only the listing columns of the scan are used.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{suffix}")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "length", "modificationTime")
    )
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    top = re.escape(re.sub(r"^[a-z0-9]+:/+", "/", store.makeQualified(place).toString()).rstrip("/"))
    extract = rf"^([a-z0-9]*:?/*?(?:[^/]*?){top}/([^/]*?)\{suffix})(?:/[^/]*)?$"
    root, first = (F.regexp_extract("path", extract, group) for group in (1, 2))
    return (
        files.filter(root != "")
        .groupBy(F.lower(first).alias("table_name"), root.alias("path"))
        .agg(
            F.concat_ws(
                "|",
                F.sum("length").cast("string"),
                F.unix_millis(F.max("modificationTime")).cast("string"),
                F.count(F.lit(1)).cast("string"),
            ).alias("signature")
        )
        .select("table_name", "signature", "path")
    )


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def check_names(files: DataFrame) -> DataFrame:
    """``files``, unless two of them would be one table: names differ by case only."""
    twice = [r[0] for r in files.groupBy("table_name").count().filter("count > 1").select("table_name").collect()]
    if twice:
        raise ValueError(f"several extracts for one table: {', '.join(sorted(twice))}")
    return files


def read_staging(
    spark: SparkSession, path: str, nulls: tuple[str, ...] = STAGING_NULLS, multi_line: bool = False
) -> DataFrame:
    """A comma separated extract as text columns named by its header.

    Only the header line is read ahead. Files are split by Spark's input
    partitions (``spark.sql.files.maxPartitionBytes``), so no file, however
    large, passes through one task. Parts whose header differs, and rows that do not
    fit it, are errors and not read as something else. ``multi_line`` allows line ends
    within quotes; such a file is then read by one task.
    """
    df = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
        .csv(path)
    )
    return null_tokens_to_null(lower_names(df), nulls)


def read_vocabulary(
    spark: SparkSession, path: str, table: str, nulls: tuple[str, ...] = VOCABULARY_NULLS
) -> DataFrame:
    """A tab separated vocabulary file, unquoted, typed and with its nulls restored.

    Rows that do not fit the header are errors; ``sources.quarantine`` sets them aside.
    """
    reader = spark.read.option("header", True).option("sep", "\t").option("quote", "")
    raw = lower_names(reader.option("enforceSchema", False).option("mode", "FAILFAST").csv(path))
    return standardise_vocabulary(null_tokens_to_null(raw, nulls), table)


def standardise_vocabulary(df: DataFrame, table: str) -> DataFrame:
    """Dates parsed, mandatory text filled, nullable flags emptied, types set.

    Filling comes before emptying: a flag that is listed in both ends up null,
    because "still valid" is tested as null.
    """
    dates = [c for c in COMPACT_DATES.get(table, ()) if c in df.columns]
    df = df.withColumns({c: compact_date(c) for c in dates}) if dates else df
    df = null_to_blank(df, NOT_NULL_TEXT.get(table, ()))
    df = blank_to_null(df, NULLABLE_FLAGS.get(table, ()))
    known = VOCABULARY.get(table, ())
    typed = {
        c: F.col(c).try_cast(column_type(c))
        for c in df.columns
        if c in known and c not in dates and column_type(c) != "string"
    }
    return df.withColumns(typed) if typed else df


def read_staging_folder(
    spark: SparkSession, folder: str, multi_line: bool = False, unloaded: tuple[str, ...] = ()
) -> dict[str, DataFrame]:
    """Every extract of a folder by table name. The listing is one row per file.

    Tables in ``unloaded`` keep their columns and no rows.
    """
    listed = check_names(list_files(spark, folder)).select("table_name", "path").collect()
    tables = {row.table_name: read_staging(spark, row.path, multi_line=multi_line) for row in listed}
    return {name: df.limit(0) if name in unloaded else df for name, df in tables.items()}
