"""A dataset is a folder with one Parquet table per name.

These are thin uses of Spark's reader and writer: which tables exist, create
what is missing, copy or share, rebuild what is stale.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from carestrata.schema import POPULATED, REQUIRED_VOCABULARY, UNPOPULATED, VOCABULARY, table_schema

BUILD_INFO = "map_build_info"


def table_path(dataset: str, name: str) -> str:
    return f"{dataset}/{name}"


def open_table(spark: SparkSession, dataset: str, name: str) -> DataFrame | None:
    """The table, or None where the dataset has none of that name.

    A folder that is there but cannot be read as a table is an error.
    """
    try:
        return spark.read.parquet(table_path(dataset, name))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_table(df: DataFrame, dataset: str, name: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(table_path(dataset, name))


def has_rows(df: DataFrame | None) -> bool:
    return df is not None and not df.isEmpty()


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(0).select(nulls).coalesce(1)


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return no_rows(spark, table_schema(name))


def header_only(df: DataFrame) -> DataFrame:
    """Same columns, no rows: a table that exists but is not loaded."""
    return df.limit(0)


def ensure_tables(spark: SparkSession, dataset: str) -> list[str]:
    """Create the missing model tables empty; present ones are not touched."""
    missing = [
        name for name in (*POPULATED, *UNPOPULATED) if open_table(spark, dataset, name) is None
    ]
    for name in missing:
        write_table(empty_table(spark, name), dataset, name, "errorifexists")
    return missing


def clear_tables(spark: SparkSession, dataset: str, names: list[str]) -> list[str]:
    """Empty the tables that exist, keeping their schemas, ahead of a clean load."""
    cleared = []
    for name in names:
        table = open_table(spark, dataset, name)
        if table is not None:
            write_table(no_rows(spark, table.schema), dataset, name)
            cleared.append(name)
    return cleared


def load_missing(spark: SparkSession, dataset: str, loaders: dict[str, Callable[[], DataFrame]]) -> list[str]:
    """Load the tables that are absent or empty; leave the others alone."""
    pending = [name for name in loaders if not has_rows(open_table(spark, dataset, name))]
    for name in pending:
        write_table(loaders[name](), dataset, name, "append")
    return pending


def copy_vocabulary(spark: SparkSession, target: str, source: str) -> list[str]:
    """Fill the target's empty vocabulary tables from another dataset.

    Nothing happens when the target has a vocabulary of its own; tables that
    either side lacks are passed over.
    """
    if has_rows(open_table(spark, target, "concept")):
        return []
    copied = []
    for name in VOCABULARY:
        theirs, ours = open_table(spark, source, name), open_table(spark, target, name)
        if theirs is not None and ours is not None and not has_rows(ours):
            write_table(theirs, target, name)
            copied.append(name)
    return copied


def share_tables(spark: SparkSession, dataset: str, names: list[str], prefix: str = "") -> list[str]:
    """Expose tables of one dataset to all queries of the session, uncopied."""
    shared = []
    for name in names:
        table = open_table(spark, dataset, name)
        if table is not None:
            table.createOrReplaceTempView(f"{prefix}{name}")
            shared.append(f"{prefix}{name}")
    return shared


def probe_tables(
    spark: SparkSession, tables: dict[str, DataFrame | None], required: dict[str, tuple[str, ...]]
) -> DataFrame:
    """Per required table: is it there, has it rows, which columns are missing."""
    report = []
    for name, columns in required.items():
        table = tables.get(name)
        missing = sorted(set(columns) - set(table.columns if table is not None else ()))
        report.append((name, table is not None, has_rows(table), ",".join(missing)))
    return spark.createDataFrame(
        report, "table_name string, present boolean, has_rows boolean, missing_columns string"
    )


def conform(df: DataFrame, name: str) -> DataFrame:
    """Columns of the model table in order: cast, or typed nulls where absent."""
    return df.select(
        [
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in table_schema(name).fields
        ]
    )


def vocabulary_is_loaded(spark: SparkSession, dataset: str) -> bool:
    return all(has_rows(open_table(spark, dataset, name)) for name in REQUIRED_VOCABULARY)


def pick_dataset(candidates: list[str], default: str, has_persons: Callable[[str], bool]) -> str:
    """The default if it has persons, else the highest ``_<n>`` that has.

    A name without such a suffix comes last; without any hit the default stays.
    """
    if has_persons(default):
        return default

    def suffix(name: str) -> int:
        found = re.search(r"_([0-9]+)$", name)
        return int(found.group(1)) if found else -1

    for name in sorted(candidates, key=suffix, reverse=True):
        if has_persons(name):
            return name
    return default


def pick_layout(spark: SparkSession, layouts: list[tuple[str, str]]) -> str | None:
    """First ``(dataset, table)`` that exists, by its dataset."""
    for dataset, probe in layouts:
        if open_table(spark, dataset, probe) is not None:
            return dataset
    return None


def is_stale(
    recorded_version: str | None,
    recorded_builder: int | None,
    live_version: str | None,
    builder: int,
    tables_present: bool,
    force: bool = False,
) -> bool:
    """Whether derived maps must be rebuilt.

    What cannot be shown to be current is stale. Maps of a newer builder are
    neither stale nor usable: that is refused, since rebuilding would set back
    what others rely on.
    """
    if recorded_builder is not None and recorded_builder > builder:
        raise ValueError(f"maps were built by builder {recorded_builder}, this is {builder}")
    return (
        force
        or not tables_present
        or live_version is None
        or recorded_version != live_version
        or recorded_builder is None
        or recorded_builder < builder
    )


def rebuild_if_stale(
    spark: SparkSession,
    dataset: str,
    live_version: str | None,
    builder: int,
    builders: dict[str, Callable[[], DataFrame]],
    force: bool = False,
) -> bool:
    """Rebuild derived tables and their stamp when stale; tell whether it was done."""
    stamp = open_table(spark, dataset, BUILD_INFO)
    last = None if stamp is None else stamp.orderBy(F.col("built_at").desc()).limit(1).first()
    present = all(open_table(spark, dataset, name) is not None for name in builders)
    recorded_builder = last.builder_version if last and "builder_version" in stamp.columns else None
    if not is_stale(last.vocab_version if last else None, recorded_builder, live_version, builder, present, force):
        return False
    for name, build in builders.items():
        write_table(build(), dataset, name)
    info = [(live_version, builder, datetime.now(timezone.utc))]
    info_df = spark.createDataFrame(info, "vocab_version string, builder_version int, built_at timestamp")
    counts = {f"{name}_rows": F.lit(open_table(spark, dataset, name).count()).cast("long") for name in builders}
    write_table(info_df.withColumns(counts), dataset, BUILD_INFO)
    return True


def write_report(df: DataFrame, path: str) -> None:
    """An aggregate report as one CSV file with a header."""
    df.repartition(1).write.mode("overwrite").option("header", True).csv(path)


def write_summary(df: DataFrame, path: str) -> None:
    """A one-row summary as one JSON document with snake case names."""
    snake = [re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", c).lower() for c in df.columns]
    df.toDF(*snake).repartition(1).write.mode("overwrite").json(path)
