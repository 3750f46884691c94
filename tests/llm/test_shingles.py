import random

import numpy as np
import pytest

import corpus_pipeline
from carestrata.llm import shingles

FOLDER = "/root/testdata/sf0.01"


def brute_kept(rows, words=5):
    """The smallest id of each group of texts linked by true similarity, from the words themselves."""
    texts = [" ".join((t or "").lower().split()) for _, t in rows]
    sets = [frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))) if (w := t.split()) else None for t in texts]
    holders = {}
    for i, s in enumerate(sets):
        for x in s or ():
            holders.setdefault(x, []).append(i)
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, s in enumerate(sets):
        if s is None:
            near = [j for j in range(i) if sets[j] is None]
        else:
            near = [j for j in {j for x in s for j in holders[x] if j < i} if 5 * len(s & sets[j]) >= 4 * len(s | sets[j])]
        for j in near:
            a, b = sorted((root(i), root(j)))
            group[b] = a
    least = {}
    for i, (name, _) in enumerate(rows):
        least.setdefault(root(i), []).append(name)
    return sorted(str(min((x for x in ids if x is not None), default=None)) for ids in least.values())


@pytest.mark.parametrize("bucket, cell", [(64, 1024), (2, 4)])
def test_all_near_copies_are_found(spark, monkeypatch, bucket, cell):
    monkeypatch.setattr(shingles, "BUCKET", bucket)
    monkeypatch.setattr(shingles, "CELL", cell)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    line = " ".join(rng.choices(words, k=25))
    rows = []
    for base in range(12):
        text = rng.choices(words, k=rng.randint(40, 200))
        for copy in range(8):
            edited = list(text)
            for _ in range(copy):
                edited[rng.randrange(len(edited))] = rng.choice(words)
            rows.append((base * 100 + copy, line + " " + " ".join(edited) if base % 2 else " ".join(edited)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(str(r["doc_id"]) for r in shingles.one_of_each_near_copy(docs).collect())
    assert got == brute_kept(rows)
    assert 12 <= len(got) < len(rows)


def test_stage_keeps_no_two_near_copies(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = sorted(str(r["doc_id"]) for r in corpus_pipeline.keep_one_of_each_group(spark, docs, FOLDER).collect())
    assert got == brute_kept([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_near_copies_of_awkward_rows(spark, awkward, nothing):
    kept = shingles.one_of_each_near_copy(awkward)
    assert kept.columns == awkward.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == brute_kept([tuple(r) for r in awkward.select("doc_id", "text").collect()])
    assert shingles.one_of_each_near_copy(nothing).collect() == []


def test_cells_link_by_true_similarity():
    base = np.arange(100)
    sets = [base, np.r_[base[:90], 1000:1010], np.r_[base[:60], 2000:2040], np.arange(5000, 5100)]
    a, b = shingles.near_in_cell(sets, np.zeros(4, np.int64))
    assert list(zip(a, b, strict=True)) == [(0, 1)]


def test_texts_are_marked_by_one_python_worker_a_task(spark, monkeypatch):
    plans, write = {}, shingles.materialise

    def seen(df, label, *more):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, label, *more)

    monkeypatch.setattr(shingles, "materialise", seen)
    docs = spark.createDataFrame([(1, "One two."), (2, "one  two."), (None, None)], "doc_id long, text string")
    kept = shingles.one_of_each_near_copy(docs).collect()
    assert {r["doc_id"] for r in kept} == {1, None} and plans["shingle-marked"].count("MapInArrow") == 1
