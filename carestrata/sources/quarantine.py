"""Text extracts with the rows that do not fit them set aside instead of lost.

A reader that refuses a whole file for one bad row loses the good ones, and a
permissive one pads or cuts rows without notice. Here both halves arrive: typed rows
as the plain readers give them, and rejected rows with their text and a reason.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carestrata.functions.parsing import null_tokens_to_null
from carestrata.operators.quality import percentage
from carestrata.sources.datasets import write_table
from carestrata.sources.delimited import (
    STAGING_NULLS,
    VOCABULARY_NULLS,
    check_names,
    list_files,
    lower_names,
    standardise_vocabulary,
)

#: Name of the table of rejected rows in a dataset.
REJECTED = "rejected_rows"

#: Least share of a table's rows that must fit it, in per cent.
MIN_ACCEPTED_PCT = 100.0

_TEXT = "_unfit_text"


@dataclass(frozen=True)
class Extract:
    """One text extract. ``scanned`` has its columns as text and the text of unfit rows."""

    table: str
    scanned: DataFrame
    separator: str
    quoted: bool
    nulls: tuple[str, ...]
    vocabulary: bool

    @property
    def _unfit(self) -> Column:
        """The text of an unfit row. Spark reads that column only beside another one, so this always names the first."""
        first = F.coalesce(F.col(f"`{self.scanned.columns[0]}`"), F.lit(""))
        return F.when(F.length(F.concat(first, _TEXT)) >= 0, F.col(_TEXT))

    @property
    def rows(self) -> DataFrame:
        """The rows that fit, as the plain reader gives them."""
        fit = self.scanned.filter(self._unfit.isNull()).drop(_TEXT)
        named = null_tokens_to_null(lower_names(fit), self.nulls)
        return standardise_vocabulary(named, self.table) if self.vocabulary else named

    @property
    def rejected(self) -> DataFrame:
        """(table_name, file, line, reason) of the rows that do not fit."""
        width = len(self.scanned.columns) - 1
        return self.scanned.filter(self._unfit.isNotNull()).select(
            F.lit(self.table).alias("table_name"),
            F.col("_metadata.file_path").alias("file"),
            F.col(_TEXT).alias("line"),
            F.concat(self._fields().cast("string"), F.lit(f" fields for {width} columns")).alias("reason"),
        )

    def _fields(self) -> Column:
        """Fields of an unfit row: separators outside quotes and one."""
        bare = F.regexp_replace(_TEXT, '"[^"]*"', "") if self.quoted else F.col(_TEXT)
        return F.length(bare) - F.length(F.replace(bare, F.lit(self.separator), F.lit(""))) + 1

    def counts(self) -> DataFrame:
        """One row: table, rows that fit, rows that do not, from one scan."""
        return self.scanned.agg(
            F.count(F.when(self._unfit.isNull(), 1)).alias("accepted"), F.count(self._unfit).alias("rejected")
        ).select(F.lit(self.table).alias("table_name"), "accepted", "rejected")


def _scan(spark: SparkSession, path: str, multi_line: bool, **options: str) -> DataFrame:
    """All columns of the header as text, and the text of rows with more or fewer fields.

    The header decides the columns and is compared in every part. All columns are
    parsed, not only those in use, so whether a row fits never depends on the query.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).options(**options)
    names = reader.csv(path).columns
    fields = [T.StructField(n, T.StringType()) for n in [*names, _TEXT]]
    reader = spark.read.option("header", True).option("multiLine", multi_line).options(**options)
    reader = reader.option("enforceSchema", False).option("mode", "PERMISSIVE").option("columnPruning", False)
    return reader.option("columnNameOfCorruptRecord", _TEXT).schema(T.StructType(fields)).csv(path)


def staging_extract(
    spark: SparkSession, path: str, table: str, nulls: tuple[str, ...] = STAGING_NULLS, multi_line: bool = False
) -> Extract:
    """A comma separated extract; parts with another header are errors still."""
    return Extract(table, _scan(spark, path, multi_line, escape='"'), ",", True, nulls, False)


def vocabulary_extract(
    spark: SparkSession, path: str, table: str, nulls: tuple[str, ...] = VOCABULARY_NULLS
) -> Extract:
    """A tab separated, unquoted vocabulary file."""
    return Extract(table, _scan(spark, path, False, sep="\t", quote=""), "\t", False, nulls, True)


def staging_extracts(spark: SparkSession, folder: str, multi_line: bool = False) -> dict[str, Extract]:
    """Every extract of a folder by table name."""
    listed = check_names(list_files(spark, folder)).select("table_name", "path").collect()
    return {r.table_name: staging_extract(spark, r.path, r.table_name, multi_line=multi_line) for r in listed}


def vocabulary_extracts(spark: SparkSession, folder: str, tables: tuple[str, ...]) -> dict[str, Extract]:
    """The vocabulary files of ``tables`` that a folder has, by table name in lower case."""
    listed = check_names(list_files(spark, folder)).select("table_name", "path").collect()
    wanted = {re.sub(r"\.csv$", "", t.lower()) for t in tables}
    return {r.table_name: vocabulary_extract(spark, r.path, r.table_name) for r in listed if r.table_name in wanted}


def rejected_rows(extracts: dict[str, Extract]) -> DataFrame:
    """The rejected rows of all extracts."""
    return reduce(DataFrame.unionByName, [e.rejected for e in extracts.values()])


def keep_rejected(extracts: dict[str, Extract], dataset: str) -> None:
    """Write the rejected rows beside the tables of a dataset."""
    write_table(rejected_rows(extracts), dataset, REJECTED)


def accepted_gate(extracts: dict[str, Extract], min_pct: float = MIN_ACCEPTED_PCT) -> DataFrame:
    """(metric, value, threshold, status) per extract: the share of its rows that fit.

    An extract without rows passes: nothing of it was refused.
    """
    counted = reduce(DataFrame.unionByName, [e.counts() for e in extracts.values()])
    pct = F.coalesce(percentage("accepted", F.col("accepted") + F.col("rejected")), F.lit(100.0))
    return counted.select(
        F.concat(F.lit("accepted_pct of "), "table_name").alias("metric"),
        pct.alias("value"),
        F.lit(float(min_pct)).alias("threshold"),
        F.when(pct >= F.lit(float(min_pct)), "PASS").otherwise("FAIL").alias("status"),
    )
