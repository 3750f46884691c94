"""Digests of contents: what changed between two versions of a table, and where.

The digest of a set of rows is a sum over its rows, so it depends neither on their
order nor on partitions, repeated rows count as often as they occur, and the digest
of a node is the sum of those below it. Two 64-bit hashes are summed in pieces of
16 bits, which leaves room for 2^47 rows.

Nulls are told apart from every value and from one another's places. Keys should not
be floating point numbers; map columns cannot be hashed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Leaves of a tree by default, and how many nodes share a parent.
LEAVES, FANOUT = 4096, 64

_PIECE_BITS = 16
_PIECES = [(seed, shift) for seed in range(2) for shift in range(0, 64, _PIECE_BITS)]
DIGEST = [f"d{i}" for i in range(len(_PIECES))]


def _hash(columns: list[Column], seed: int = 0) -> Column:
    """Hash of values and of which of them are null, since hashing skips nulls."""
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(F.lit(seed), nulls, *columns)


def _pieces(columns: list[Column]) -> list[Column]:
    hashes = [_hash(columns, seed) for seed in range(2)]
    return [
        F.shiftrightunsigned(hashes[seed], shift).bitwiseAND(F.lit((1 << _PIECE_BITS) - 1)).alias(name)
        for name, (seed, shift) in zip(DIGEST, _PIECES, strict=True)
    ]


def _named(names: list[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def digest(df: DataFrame) -> DataFrame:
    """One row: number of rows and the digest of all columns; zeros for an empty table."""
    return df.select(_pieces(_named(df.columns))).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.coalesce(F.sum(d), F.lit(0)).alias(d) for d in DIGEST]
    )


def _leaf(keys: list[str], leaves: int) -> Column:
    return F.pmod(_hash(_named(keys)), F.lit(leaves)).cast("int")


def _depth(leaves: int, fanout: int) -> int:
    """Levels below the root."""
    depth = 0
    while fanout**depth < leaves:
        depth += 1
    return depth


def hash_tree(df: DataFrame, keys: list[str], leaves: int = LEAVES, fanout: int = FANOUT) -> DataFrame:
    """Digests per ``(level, node)``: rows by a hash of their keys, and sums of these up to the root.

    Rows are summed below the shuffle, so a hot key sends one row per task. Level 0 is
    the root. An empty table has no nodes.
    """
    depth = _depth(leaves, fanout)
    summed = [F.sum(c).alias(c) for c in ("n_rows", *DIGEST)]
    bottom = (
        df.select(_leaf(keys, leaves).alias("leaf"), F.lit(1).cast("long").alias("n_rows"), *_pieces(_named(df.columns)))
        .groupBy("leaf")
        .agg(*summed)
    )
    path = F.array(
        *[
            F.struct(F.lit(level).alias("level"), F.floor(F.col("leaf") / F.lit(fanout ** (depth - level))).cast("int").alias("node"))
            for level in range(depth + 1)
        ]
    )
    return (
        bottom.withColumn("at", F.explode(path))
        .groupBy(F.col("at.level").alias("level"), F.col("at.node").alias("node"))
        .agg(*summed)
    )


def differing_leaves(left: DataFrame, right: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Leaves whose digests differ, found from the root down.

    Both trees must have the same number of leaves. Equal nodes are not opened: a level
    is compared below the differing nodes of the level above only.
    """
    depth = max(tree.agg(F.max("level")).first()[0] or 0 for tree in (left, right))
    differing = None
    for level in range(depth + 1):
        both = left.unionByName(right).where(F.col("level") == level).drop("level")
        if differing is not None:
            above = differing.withColumnRenamed("node", "parent")
            both = both.withColumn("parent", F.floor(F.col("node") / fanout).cast("int")).join(above, "parent", "left_semi")
        # A node that is equal on both sides is there twice.
        differing = both.groupBy("node", "n_rows", *DIGEST).count().where("count = 1").select("node").distinct()
    return differing.withColumnRenamed("node", "leaf")


def write_version(df: DataFrame, path: str, keys: list[str], leaves: int = LEAVES, fanout: int = FANOUT) -> None:
    """Store a version of a table, ordered by leaf, with its tree beside it.

    Files are cut by parents of leaves; a parent with many rows gets several files.
    """
    rows = df.select(_leaf(keys, leaves).alias("leaf"), F.struct(*_named(df.columns)).alias("row"))
    rows = rows.withColumn("branch", F.floor(F.col("leaf") / fanout).cast("int"))
    rows.hint("rebalance", "branch").sortWithinPartitions("branch", "leaf").write.partitionBy("branch").parquet(f"{path}/rows")
    # An empty table has no files of rows, so the columns are kept apart.
    rows.limit(0).coalesce(1).write.parquet(f"{path}/columns")
    stored = read_version(df.sparkSession, path)
    hash_tree(stored, keys, leaves, fanout).coalesce(1).write.parquet(f"{path}/tree")


def _placed_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{path}/columns").schema).parquet(f"{path}/rows")


def read_version(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a stored version."""
    return _placed_rows(spark, path).select("row.*")


def row_difference(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose rows differ: ``left`` or ``right`` only, or ``changed``, and in which columns.

    Rows that share a key are compared as a bag. ``changed_columns`` lists, in the order
    of the table, the columns whose values differ as bags; it is empty where the same
    values are put together differently. Null keys are keys of their own.
    """
    if dict(left.dtypes) != dict(right.dtypes):
        raise ValueError(f"columns differ: {sorted(set(left.dtypes) ^ set(right.dtypes))}")
    names, others = left.columns, [c for c in left.columns if c not in keys]
    parts = len(DIGEST)

    def side(df: DataFrame, sign: int) -> DataFrame:
        columns = [p for name in others for p in _pieces(_named([name]))]
        whole = [*_pieces(_named(names)), *columns]
        # Signed sums of both sides vanish where they agree.
        signed = [(F.lit(sign) * p).alias(f"p{i}") for i, p in enumerate(whole)]
        on_left = F.lit(int(sign > 0)).cast("long")
        return df.select(F.struct(*_named(keys)).alias("key"), on_left.alias("on_left"), *signed)

    sums = [f"p{i}" for i in range(parts * (1 + len(others)))]
    unlike = lambda group: " or ".join(f"{p} <> 0" for p in group)
    counted = (
        side(left, 1)
        .unionByName(side(right, -1))
        .groupBy("key")
        .agg(F.sum("on_left").alias("n_left"), F.count(F.lit(1)).alias("n"), *[F.sum(p).alias(p) for p in sums])
        .where(unlike(sums[:parts]))
    )
    listed = [
        F.when(F.expr(unlike(sums[parts * i : parts * (i + 1)])), F.lit(name)) for i, name in enumerate(others, start=1)
    ]
    only = F.when(F.col("n_left") == F.col("n"), "left").when(F.col("n_left") == 0, "right").otherwise("changed")
    columns = F.array_compact(F.array(*listed)) if listed else F.array().cast("array<string>")
    return counted.select(
        "key.*",
        only.alias("difference"),
        "n_left",
        (F.col("n") - F.col("n_left")).alias("n_right"),
        F.when(only == "changed", F.concat_ws(",", columns)).otherwise("").alias("changed_columns"),
    )


def dataset_difference(spark: SparkSession, left: str, right: str, keys: list[str], fanout: int = FANOUT) -> DataFrame:
    """:func:`row_difference` of two stored versions, reading only leaves that differ.

    The numbers of differing leaves (at most as many as the trees have leaves, a
    parameter of :func:`write_version`) reach the driver, so that the scans prune files
    and row groups by them.
    """
    trees = [spark.read.parquet(f"{path}/tree") for path in (left, right)]
    found = [r.leaf for r in differing_leaves(*trees, fanout).collect()]
    wanted = F.col("branch").isin(sorted({leaf // fanout for leaf in found})) & F.col("leaf").isin(sorted(found))
    sides = [_placed_rows(spark, path).where(wanted).select("row.*") for path in (left, right)]
    return row_difference(*sides, keys)
