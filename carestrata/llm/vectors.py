"""Vectors dealt into shards and query blocks, shared by the two vector searches.

A search compares a stated set of queries with all rows, block by shard. Shards
hold at most about ``SHARD_ROWS`` vectors and blocks at most about ``BLOCK_ROWS``
queries, both dealt by a hash of the id, so neither a frequent vector nor a
frequent id makes one of them large.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carestrata.runtime import materialise

#: Vectors of a shard and queries of a block, on average.
SHARD_ROWS, BLOCK_ROWS = 8192, 1024


def usable_vectors(df: DataFrame, id_col: str, vec_col: str, allow_zero: bool) -> DataFrame:
    """Columns ``id``, ``vec`` (doubles) and ``dim``, one row per id.

    Rows without an id, without a vector, with an empty vector or with null or
    non-finite components are left out, and zero vectors unless ``allow_zero``.
    Repeated rows of an id count once; if they differ, the smallest vector counts.
    """
    x = df.select(
        F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")
    )
    fine = F.forall(
        "vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    )
    x = x.where(F.col("id").isNotNull() & (F.size("vec") > 0)).where(fine)
    if not allow_zero:
        x = x.where(F.exists("vec", lambda v: v != 0.0))
    return x.groupBy("id").agg(F.min("vec").alias("vec")).withColumn("dim", F.size("vec"))


def share(parts: Column | int, seed: int) -> Column:
    """Which of ``parts`` equal shares an id belongs to."""
    return F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(parts).cast("long")).cast("int")


def matrix(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a group, by ascending id."""
    pdf = pdf.sort_values("id", kind="stable")
    return pdf["id"].to_numpy(np.int64), np.array(pdf["vec"].tolist(), dtype=np.float64)


def query_blocks(queries: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """Rows (dim, block, ids, points) of about ``BLOCK_ROWS`` queries each, and how many blocks."""
    blocks = max(1, -(-rows // BLOCK_ROWS))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, x = matrix(pdf)
        head = pdf.iloc[0]
        return pd.DataFrame(
            {"dim": [head["dim"]], "block": [head["block"]], "ids": [ids.tobytes()], "points": [x.tobytes()]}
        )

    packed = (
        queries.withColumn("block", share(blocks, 7))
        .groupBy("dim", "block")
        .applyInPandas(pack, "dim int, block int, ids binary, points binary")
    )
    return packed, blocks


def search_pairs(
    pairs: DataFrame,
    answer: Callable[[dict], tuple[np.ndarray, np.ndarray, np.ndarray]],
    score_type: str,
    k: int,
) -> DataFrame:
    """Runs ``answer`` on every (block, shard) row and keeps each query's ``k`` best.

    ``answer`` gives query ids, found ids and scores. The best of each shard meet
    in a ranked window, of which Spark keeps ``k`` rows per query before it shuffles.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.to_dict("records"):
                q, v, s = answer(row)
                yield pd.DataFrame({"query_id": q, "vec_id": v, "score": s})

    found = pairs.mapInPandas(run, f"query_id long, vec_id long, score {score_type}")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def best(owner: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best entries of each owner, best first, ties to smaller ids."""
    order = np.lexsort((ids, -scores, owner))
    o = owner[order]
    first = np.flatnonzero(np.r_[True, o[1:] != o[:-1]]) if len(o) else np.zeros(0, int)
    rank = np.arange(len(o)) - np.repeat(first, np.diff(np.r_[first, len(o)]))
    return order[rank < k]


def stored(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """The frame as a table in the shared folder, and its row count."""
    table = materialise(df, label)
    return table, table.count()
