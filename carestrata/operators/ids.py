"""Surrogate ids over a total order, without a one-task window, and ids that last over builds."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carestrata.runtime import materialise

# monotonically_increasing_id keeps the row number within a partition in its
# low 33 bits.
_ROW_BITS = (1 << 33) - 1


def with_surrogate_id(df: DataFrame, name: str, order_by: list[str], first: int = 1) -> DataFrame:
    """Number the rows of ``df`` from ``first`` in the order of ``order_by``.

    ``order_by`` must be a total order, so that ids do not depend on the plan.
    Rows are range partitioned and sorted, which spreads even a key holding a
    third of the table because the later columns split it. The sorted rows are
    written once (range bounds come from sampling, so both uses below must see
    the same rows); then each partition starts where the one before it ends.
    """
    placed = materialise(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))),
        f"ids-{name}",
    )
    # One row per partition: this window and this broadcast are bounded by the
    # number of partitions, not by the data.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_offset") + F.col("_pos") + F.lit(first)).cast("long"))
        .drop("_part", "_pos", "_offset")
        .select(name, *df.columns)
    )


def _generations(spark: SparkSession, registry: str) -> list[tuple[int, bool]]:
    """(number, whether it is complete) of the generations of a registry, in order."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(registry)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(place):
        return []
    found = []
    for entry in store.listStatus(place):
        number = re.fullmatch(r"generation-(\d+)", entry.getPath().getName())
        if number:
            found.append((int(number[1]), store.exists(jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS"))))
    return sorted(found)


def registered_ids(spark: SparkSession, registry: str) -> DataFrame | None:
    """Every key with its id, or None before the first generation. Aborted generations do not count."""
    paths = [f"{registry}/generation-{n:06d}" for n, complete in _generations(spark, registry) if complete]
    return spark.read.parquet(*paths) if paths else None


def _same(left: DataFrame, right: DataFrame, keys: list[str]):
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_known_{k}"]) for k in keys])


def with_lasting_id(df: DataFrame, name: str, keys: list[str], registry: str, first: int = 1) -> DataFrame:
    """``df`` with the id that ``registry`` keeps for each row's ``keys``.

    A key keeps its id over all builds. Only keys that are not registered yet are
    sorted, numbered in the order of ``keys`` after the largest id given so far, and
    written as one more generation; an id once given is never given again, even if its
    key is gone. Null keys are keys too. Rows that share their keys share the id.

    A generation counts once it is complete, so a build that fails in between leaves
    the ids it had not yet written free. Two builds at a time collide on the name of
    the generation: the second one fails.
    """
    spark = df.sparkSession
    known = registered_ids(spark, registry)
    wanted = df.select(*keys).distinct()
    largest = first - 1
    if known is not None:
        renamed = known.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
        wanted = wanted.join(renamed, _same(wanted, renamed, keys), "left_anti")
        largest = max(largest, known.agg(F.max(name)).first()[0] or largest)
    fresh = with_surrogate_id(wanted, name, keys, first=largest + 1)
    number = max((n for n, _ in _generations(spark, registry)), default=-1) + 1
    fresh.write.parquet(f"{registry}/generation-{number:06d}")
    ids = registered_ids(spark, registry).select(F.col(name).alias("_id"), *[F.col(k).alias(f"_known_{k}") for k in keys])
    return df.join(ids, _same(df, ids, keys)).select(F.col("_id").cast("long").alias(name), *[df[c] for c in df.columns])


def with_copy_number(df: DataFrame, name: str = "copy") -> DataFrame:
    """Equal rows told apart by a number from 1; they are counted, not ranked."""
    columns = [F.col(c) for c in df.columns]
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    return counted.select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias(name))
