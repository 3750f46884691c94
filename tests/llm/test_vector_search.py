import numpy as np
import pytest
from pyspark.sql import functions as F

from carestrata.llm.ann import Found, augmented, build_tree, search_tree, vp_neighbours
from carestrata.llm.topk import candidates, coordinate_range, norm_bucketed_top, products

rng = np.random.default_rng(5)


def brute(vectors, is_query, k, allow_zero, value):
    """Smallest vector per id; all others of its length by falling product, then id."""
    one = {}
    for i, v in vectors:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        if not allow_zero and not any(v):
            continue
        one[i] = min(one.get(i, v), v)
    out = []
    for q, v in one.items():
        if is_query(q):
            scores = [(-value(v, w), i) for i, w in one.items() if i != q and len(w) == len(v)]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def frame(spark, vectors):
    rows = [(i, v, "x", 0.5) for i, v in vectors]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, id string, score double").repartition(4)


def some_vectors():
    spread = [(i, [float(x) for x in np.float32(rng.normal(size=6) * 1.1 ** (i % 40))]) for i in range(300)]
    same = [(1000 + i, [1.0, 2.0, 3.0, -1.0, 0.5, 2.0]) for i in range(60)]
    odd = [(None, [1.0] * 6), (2000, None), (2020, []), (2040, [0.0] * 6), (2060, [1.0, None] + [1.0] * 4)]
    odd += [(2080, [float("nan")] + [1.0] * 5), (2100, [float("inf")] * 6), (2120, [1.0, 1.0]), (2140, [2.0, 1.0])]
    odd += [(20, [9.0] * 6), (20, [9.0] * 6), (40, [-1.0] * 6)]
    return spread + same + odd


def dot(v, w):
    return float(sum(np.float64(a) * np.float64(b) for a, b in zip(v, w, strict=True)))


def whole(v, w):
    return sum(int(np.floor(256 * a)) * int(np.floor(256 * b)) for a, b in zip(v, w, strict=True))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_exact_trees_equal_brute_force(spark):
    vectors = some_vectors()
    got = rows(vp_neighbours(frame(spark, vectors), F.col("id") % 20 == 0, k=7))
    expected = brute(vectors, lambda i: i % 20 == 0, 7, False, dot)
    assert [r[:3] for r in got] == [r[:3] for r in expected]
    assert np.allclose([r[3] for r in got], [r[3] for r in expected])


def test_norm_buckets_equal_brute_force(spark):
    vectors = some_vectors()
    got = rows(norm_bucketed_top(frame(spark, vectors), F.col("id") % 20 == 0, k=5))
    assert got == brute(vectors, lambda i: i % 20 == 0, 5, True, whole)


def test_no_vectors_no_rows(spark):
    empty = frame(spark, [(None, [1.0])]).where("vec_id is not null")
    assert vp_neighbours(empty, F.col("id") % 20 == 0).collect() == []
    assert norm_bucketed_top(empty, F.col("id") % 20 == 0).collect() == []


@pytest.mark.parametrize("factor", [1.0, 1.5, 4.0])
def test_factor_trades_recall_for_work(factor):
    centres = rng.normal(size=(20, 8)) * 4
    x = np.concatenate([c + rng.normal(size=(150, 8)) * 0.3 for c in centres])
    ids = np.arange(len(x))
    q = x[::50]
    nodes, order = build_tree(augmented(x)[0])
    back = np.argsort(order)
    nodes["vp"][nodes["vp"] >= 0] = back[nodes["vp"][nodes["vp"] >= 0]]
    points, names = x[order], ids[order]
    found = Found(q, ids[::50], points, names, 10)
    longer, top = augmented(points)
    search_tree(found, nodes, longer, top, factor)
    truth = [set(sorted((i for i in ids if i != 50 * n), key=lambda i: -(q[n] @ x[i]))[:10]) for n in range(len(q))]
    recall = np.mean([len(t & set(names[a])) / 10 for t, a in zip(truth, found.at, strict=True)])
    assert recall == 1.0 if factor == 1.0 else recall >= 0.6


def test_pruning_never_loses_a_candidate():
    x = np.floor(rng.normal(size=(400, 5)) * 50)
    length = np.sqrt((x * x).sum(axis=1))
    order = np.argsort(-length)
    x, length = x[order], length[order]
    for q in np.floor(rng.normal(size=(60, 5)) * 50):
        q_len = float(np.sqrt(q @ q))
        for share in (0.2, 0.6, 0.9, 0.99):
            floor = share * q_len * length[0]
            near = candidates(q, q_len, floor, x, length)
            kept = set(range(len(x))) if near is None else set(near.tolist())
            assert {i for i in range(len(x)) if x[i] @ q >= floor} <= kept
    assert coordinate_range(0.9, 0.5)[1] == 1.0 and coordinate_range(-0.9, 0.5)[0] == -1.0


def test_products_are_exact_beyond_doubles():
    a = np.array([[2.0**40, 1.0]])
    assert products(a, a)[0, 0] == 2**63 - 1
    assert products(np.array([[2.0**30, 1.0]]), np.array([[2.0**30, 1.0]]))[0, 0] == 2**60 + 1
