"""Exact top-k inner products: vectors grouped by length, pruned bucket by bucket."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carestrata.llm.vectors import SHARD_ROWS, best, matrix, query_blocks, search_pairs, share, stored, usable_vectors

#: Longest over shortest vector of a bucket.
RATIO = 1.05
#: Rows of the seed that gives every query its first threshold.
SEED_ROWS = 512
#: From this local cosine threshold on, coordinates prune better than length does.
COORDINATE_FROM = 0.5
#: Coordinates looked at, those in which the query is largest.
FOCUS = 3


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of two sets of integer-valued vectors.

    Doubles are exact while every partial sum is below 2^53. Beyond that Python's
    integers are used, and what a long cannot hold becomes the nearest long.
    """
    if not len(q) or not len(x):
        return np.zeros((len(q), len(x)), dtype=np.int64)
    bound = float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1]
    if bound < 2.0**53:
        return (q @ x.T).astype(np.int64)
    as_ints = [np.array([[int(v) for v in r] for r in m], dtype=object) for m in (q, x)]
    most = 2**63 - 1
    return np.vectorize(lambda v: max(-most, min(most, v)), otypes=[np.int64])(as_ints[0] @ as_ints[1].T)


def candidates(q: np.ndarray, q_len: float, floor: float, x: np.ndarray, length: np.ndarray) -> np.ndarray | None:
    """Positions of a bucket that may reach ``floor``; None if all of it may.

    ``x`` is sorted by falling ``length``. The local cosine threshold is what the
    bucket's longest vector would need. Above one the bucket is done. A high one
    bounds each coordinate of a unit vector around the query's; else only vectors
    long enough are kept.
    """
    if not len(x):
        return np.zeros(0, int)
    if floor <= 0 or q_len == 0:
        return None
    need = floor / q_len * (1 - 1e-9)
    cosine = need / length[0]
    if cosine > 1:
        return np.zeros(0, int)
    long_enough = int(np.searchsorted(-length, -need, side="right"))
    if cosine < COORDINATE_FROM:
        return np.arange(long_enough)
    unit = q / q_len
    keep = np.arange(long_enough)
    for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS]:
        low, high = coordinate_range(unit[f], cosine)
        value = x[keep, f] / length[keep]
        keep = keep[(value >= low - 1e-9) & (value <= high + 1e-9)]
    return keep


def coordinate_range(u: float, cosine: float) -> tuple[float, float]:
    """Where a coordinate lies in unit vectors within ``cosine`` of one that has ``u`` there."""
    spread = math.sqrt(max(0.0, (1 - u * u) * (1 - cosine * cosine)))
    return (-1.0 if u <= -cosine else u * cosine - spread), (1.0 if u >= cosine else u * cosine + spread)


def retrieve(q: np.ndarray, q_ids: np.ndarray, floors: np.ndarray, x: np.ndarray, ids: np.ndarray, length: np.ndarray, k: int):
    """Each query's ``k`` best of one bucket shard, given what it has to reach."""
    q_len = np.sqrt((q * q).sum(axis=1))
    owner, at, score = [], [], []
    whole = []
    for i in range(len(q)):
        near = candidates(q[i], q_len[i], floors[i], x, length)
        if near is None or 2 * len(near) > len(x):
            whole.append(i)
        elif len(near):
            s = products(q[i : i + 1], x[near])[0]
            owner.append(np.full(len(near), i)), at.append(near), score.append(s)
    for part in (whole[i : i + 128] for i in range(0, len(whole), 128)):
        s = products(q[part], x)
        enough = np.minimum(k + 1, s.shape[1])
        cut = np.partition(s, s.shape[1] - enough, axis=1)[:, s.shape[1] - enough]
        a, b = np.nonzero(s >= np.maximum(cut, np.floor(np.nan_to_num(floors[part], neginf=-(2.0**62))).astype(np.int64) - 1)[:, None])
        owner.append(np.array(part)[a]), at.append(b), score.append(s[a, b])
    if not owner:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    o, p, s = np.concatenate(owner), np.concatenate(at), np.concatenate(score)
    other = ids[p] != q_ids[o]
    o, p, s = o[other], p[other], s[other]
    keep = best(o, ids[p], s, k)
    return q_ids[o[keep]], ids[p[keep]], s[keep]


def norm_bucketed_top(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """The ``k`` highest integer inner products of each query, exactly.

    Components become ``floor(scale * x)``. Returns (query_id, rank, vec_id, score).
    Vectors are grouped into buckets by length (a factor of ``RATIO`` each), large
    buckets dealt into shards by a hash of the id. The longest ``SEED_ROWS``
    vectors give each query a first threshold; every bucket is then pruned by it
    and the rest verified.

    Left out: rows without id or vector, empty vectors, null or non-finite
    components; zero vectors take part. Repeated rows of an id count once (the
    smallest vector if they differ), and a row is no candidate for its own id.
    Vectors of different lengths are not compared. Empty tables give no rows; with
    fewer than ``k`` candidates all are returned; ties go to the smaller id.
    """
    x = usable_vectors(vectors, id_col, vec_col, allow_zero=True)
    x = x.withColumn("vec", F.transform("vec", lambda v: _floor(v * scale)))
    x = x.withColumn("length", F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, v: s + v * v)))
    x, _ = stored(
        x.withColumn("bucket", F.when(F.col("length") > 0, F.floor(F.log(F.col("length")) / math.log(RATIO)).cast("int")).otherwise(-1)),
        "topk-vectors",
    )
    sizes = x.groupBy("dim", "bucket").agg(F.count("*").alias("n"))
    # At most one row per length of vectors and power of RATIO that doubles can have.
    dealt = x.join(F.broadcast(sizes), ["dim", "bucket"]).withColumn(
        "shard", share(F.ceil(F.col("n") / SHARD_ROWS), 5)
    )

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, points = matrix(pdf)
        length = np.sqrt((points * points).sum(axis=1))
        order = np.argsort(-length, kind="stable")
        head = pdf.iloc[0]
        return pd.DataFrame(
            {"dim": [head["dim"]], "bucket": [head["bucket"]], "shard": [head["shard"]], "longest": [length.max()],
             "v_ids": [ids[order].tobytes()], "v_points": [points[order].tobytes()]}
        )

    packed = "dim int, bucket int, shard int, longest double, v_ids binary, v_points binary"
    buckets = dealt.groupBy("dim", "bucket", "shard").applyInPandas(pack, packed)
    head = x.withColumn("place", F.row_number().over(Window.partitionBy("dim").orderBy(F.desc("length"), "id")))
    seed = (
        head.where(F.col("place") <= SEED_ROWS)
        .withColumn("shard", F.lit(0))
        .withColumn("bucket", F.lit(0))
        .groupBy("dim")
        .applyInPandas(pack, packed)
        .select("dim", "v_ids", "v_points")
    )
    queries = x.where(is_query)
    blocks, n_blocks = query_blocks(queries.select("id", "vec", "dim"), queries.count())
    # The seed has at most SEED_ROWS vectors of each length: it is small enough to broadcast.
    blocks = blocks.join(F.broadcast(seed), "dim")

    def thresholds(batches):
        for pdf in batches:
            for row in pdf.to_dict("records"):
                q_ids, q, ids, points, _ = _unpack(row)
                s = products(q, points).astype(np.float64)
                s[q_ids[:, None] == ids[None, :]] = -np.inf
                floors = np.partition(s, -k, axis=1)[:, -k] if s.shape[1] >= k else np.full(len(q), -np.inf)
                q_len = np.sqrt((q * q).sum(axis=1))
                need = np.where((floors > 0) & (q_len > 0), floors / np.maximum(q_len, 1e-300), 0.0)
                yield pd.DataFrame(
                    {"dim": [row["dim"]], "block": [row["block"]], "ids": [row["ids"]], "points": [row["points"]],
                     "floors": [floors.tobytes()], "least": [need.min() * (1 - 1e-9)]}
                )

    blocks = blocks.mapInPandas(thresholds, "dim int, block int, ids binary, points binary, floors binary, least double")
    places = dealt.select("dim", "bucket", "shard").distinct().withColumn("longest", F.pow(F.lit(RATIO), F.col("bucket") + 1) * (1 + 1e-9))
    meetings = places.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    visits = blocks.join(meetings, ["dim", "block"]).where((F.col("least") <= 0) | (F.col("longest") >= F.col("least"))).drop("longest")

    def answer(row: dict):
        q_ids, q, ids, points, length = _unpack(row)
        return retrieve(q, q_ids, np.frombuffer(row["floors"], np.float64), points, ids, length, k)

    return search_pairs(visits.join(buckets, ["dim", "bucket", "shard"]), answer, "long", k)


def _floor(v: Column) -> Column:
    """Floor as a double: Spark's gives a long, which huge components overflow."""
    near = F.rint(v)
    return F.when(near > v, near - 1).otherwise(near)


def _unpack(row: dict):
    q_ids, ids = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["v_ids"], np.int64)
    q = np.frombuffer(row["points"], np.float64).reshape(len(q_ids), -1)
    points = np.frombuffer(row["v_points"], np.float64).reshape(len(ids), -1)
    return q_ids, q, ids, points, np.sqrt((points * points).sum(axis=1))
