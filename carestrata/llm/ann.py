"""Nearest neighbours by inner product: vantage-point trees per shard."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestrata.llm.vectors import SHARD_ROWS, best, matrix, query_blocks, search_pairs, share, stored, usable_vectors

LEAF = 256
_NODE = np.dtype(
    [("vp", "<i4"), ("start", "<i4"), ("end", "<i4"), ("inner", "<i4"), ("outer", "<i4"),
     ("in_lo", "<f8"), ("in_hi", "<f8"), ("out_lo", "<f8"), ("out_hi", "<f8")]
)


def augmented(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Points with one more coordinate, so that all have the longest one's length.

    Between a query with a zero there and such a point, the squared distance is
    ``|q|^2 + longest^2 - 2 q.x``: the nearest point has the largest product.
    """
    sq = np.einsum("ij,ij->i", x, x)
    top = float(sq.max())
    return np.hstack([x, np.sqrt(np.maximum(top - sq, 0.0))[:, None]]), top


def build_tree(x: np.ndarray, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of a vantage-point tree and the order in which leaves hold the points.

    A node splits its points at the median distance from a point of its own and
    keeps the least and largest distance on either side.
    """
    rng = np.random.default_rng(seed)
    order = np.arange(len(x))
    nodes: list[tuple] = []

    def grow(start: int, end: int) -> int:
        me = len(nodes)
        nodes.append((-1, start, end, -1, -1, 0.0, 0.0, 0.0, 0.0))
        if end - start <= LEAF:
            return me
        own = order[start:end]
        vp = int(own[rng.integers(len(own))])
        d = np.sqrt(((x[own] - x[vp]) ** 2).sum(axis=1))
        by = np.argsort(d, kind="stable")
        own, d = own[by], d[by]
        order[start:end] = own
        half = len(own) // 2
        spans = (d[0], d[half - 1], d[half], d[-1])
        inner, outer = grow(start, start + half), grow(start + half, end)
        nodes[me] = (vp, start, end, inner, outer, *spans)
        return me

    grow(0, len(x))
    return np.array(nodes, dtype=_NODE), order


class Found:
    """The ``k`` best products of each query so far."""

    def __init__(self, q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int):
        self.q, self.q_ids, self.x, self.ids, self.k = q, q_ids, x, ids, k
        self.score = np.full((len(q), k), -np.inf)
        self.at = np.full((len(q), k), -1)
        self.slack = 1e-12 * (1 + np.sqrt((q * q).sum(1).max() * (x * x).sum(1).max()))

    def look(self, who: np.ndarray, start: int, end: int) -> None:
        """Compares the queries ``who`` with the points from ``start`` to ``end``.

        A matrix product finds what may enter; entrants are scored again, row by
        row, so that equal vectors have equal scores wherever they lie.
        """
        rough = self.q[who] @ self.x[start:end].T
        a, b = np.nonzero(rough >= (self.score[who, -1] - self.slack)[:, None])
        own, at = who[a], start + b
        other = self.ids[at] != self.q_ids[own]
        own, at = own[other], at[other]
        if not len(own):
            return
        if len(own) > 4 * self.k * len(who):  # a first look: only the best of the rough ones count
            keep = best(own, self.ids[at], rough[a, b][other], self.k)
            floor = np.full(len(self.q), -np.inf)
            last = np.full(len(self.q), 0)
            np.add.at(last, own[keep], 1)
            full = last >= self.k
            low = np.full(len(self.q), np.inf)
            np.minimum.at(low, own[keep], rough[a, b][other][keep])
            floor[full] = low[full] - self.slack
            strong = rough[a, b][other] >= floor[own]
            own, at = own[strong], at[strong]
        exact = np.concatenate(
            [(self.q[own[i : i + 65536]] * self.x[at[i : i + 65536]]).sum(axis=1) for i in range(0, len(own), 65536)]
        )
        rows = np.unique(own)
        o = np.concatenate([np.repeat(rows, self.k), own])
        s = np.concatenate([self.score[rows].ravel(), exact])
        p = np.concatenate([self.at[rows].ravel(), at])
        tie = np.where(p >= 0, self.ids[p], np.iinfo(np.int64).max)
        keep = best(o, tie, s, self.k)
        self.score[rows] = s[keep].reshape(len(rows), self.k)
        self.at[rows] = p[keep].reshape(len(rows), self.k)


def search_tree(found: Found, nodes: np.ndarray, x: np.ndarray, top: float, factor: float) -> None:
    """First each query's home leaf, then every subtree the bound leaves open.

    A side whose distances from the vantage point all differ from the query's by
    more than the radius of its ``k`` best cannot hold a better one. The radius is
    divided by ``factor``: one is exact, more skips more. Ties stay inside.
    """
    q = np.hstack([found.q, np.zeros((len(found.q), 1))])
    q_sq = (found.q * found.q).sum(axis=1)

    def far(node: np.void, who: np.ndarray) -> np.ndarray:
        return np.sqrt(((q[who] - x[node["vp"]]) ** 2).sum(axis=1))

    def go_home() -> np.ndarray:
        home = np.zeros(len(q), dtype=int)
        todo = [(0, np.arange(len(q)))]
        while todo:
            i, who = todo.pop()
            node = nodes[i]
            if node["inner"] < 0:
                home[who] = i
                found.look(who, node["start"], node["end"])
                continue
            inside = far(node, who) <= (node["in_hi"] + node["out_lo"]) / 2
            todo += [(j, w) for j, w in ((node["inner"], who[inside]), (node["outer"], who[~inside])) if len(w)]
        return home

    home = go_home()
    todo = [(0, np.arange(len(q)))]
    while todo:
        i, who = todo.pop()
        node = nodes[i]
        if node["inner"] < 0:
            who = who[home[who] != i]
            if len(who):
                found.look(who, node["start"], node["end"])
            continue
        d = far(node, who)
        left = q_sq[who] + top - 2 * found.score[who, -1]
        reach = np.sqrt(np.maximum(left, 0.0)) / factor + 1e-7 * (1 + np.sqrt(top + q_sq[who]))
        for child, lo, hi in ((node["outer"], node["out_lo"], node["out_hi"]), (node["inner"], node["in_lo"], node["in_hi"])):
            open_ = who[(d - hi <= reach) & (lo - d <= reach)]
            if len(open_):
                todo.append((child, open_))


def vp_neighbours(
    vectors: DataFrame, is_query: Column, k: int = 20, factor: float = 1.0, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """The ``k`` rows of largest inner product with each query, by trees over shards.

    Returns (query_id, rank, vec_id, score). ``is_query`` is a condition on the id,
    given as column ``id``. Every vector is indexed, in shards dealt by a hash of
    its id; each block of queries visits each shard. ``factor`` relaxes the
    triangle-inequality pruning; one is exact.

    Left out: rows without id or vector, empty and zero vectors, null or non-finite
    components. Repeated rows of an id count once (the smallest vector if they
    differ) and a row is no candidate for its own id. Vectors are compared with
    those of their own length only. An empty table gives no rows; with fewer than
    ``k`` candidates all are returned; ties go to the smaller id. Other columns of
    the table are not read.
    """
    x, n = stored(usable_vectors(vectors, id_col, vec_col, allow_zero=False), "ann-vectors")
    shards = max(1, -(-n // SHARD_ROWS))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, points = matrix(pdf)
        nodes, order = build_tree(augmented(points)[0])
        back = np.argsort(order)
        inner = nodes["vp"] >= 0
        nodes["vp"][inner] = back[nodes["vp"][inner]]
        head = pdf.iloc[0]
        return pd.DataFrame(
            {"dim": [head["dim"]], "shard": [head["shard"]], "v_ids": [ids[order].tobytes()],
             "v_points": [points[order].tobytes()], "nodes": [nodes.tobytes()]}
        )

    index = (
        x.withColumn("shard", share(shards, 3))
        .groupBy("dim", "shard")
        .applyInPandas(build, "dim int, shard int, v_ids binary, v_points binary, nodes binary")
    )
    queries = x.where(is_query)
    blocks, _ = query_blocks(queries, queries.count())
    visits = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def answer(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        q_ids, ids = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["v_ids"], np.int64)
        q = np.frombuffer(row["points"], np.float64).reshape(len(q_ids), -1)
        points = np.frombuffer(row["v_points"], np.float64).reshape(len(ids), -1)
        found = Found(q, q_ids, points, ids, k)
        longer, top = augmented(points)
        search_tree(found, np.frombuffer(row["nodes"], _NODE), longer, top, factor)
        who, _ = np.nonzero(found.at >= 0)
        at = found.at[found.at >= 0]
        return q_ids[who], ids[at], found.score[found.at >= 0]

    return search_pairs(visits.join(index, ["dim", "shard"]), answer, "double", k)
