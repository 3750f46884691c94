import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from carestrata.llm import sentences


def left(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {r["doc_id"]: (r["n_removed"], r["text"]) for r in sentences.remove_repeated_spans(docs).collect()}


def words(rng, n):
    return ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 8))) for _ in range(n)]


def marked(rng, n, mean):
    out = words(rng, n)
    return [w + rng.choice(".,;:!?") if rng.random() < 1 / mean else w for w in out]


@pytest.mark.parametrize("mean", [4, 12, 40, 10**9])
def test_planted_passages_lose_a_run(spark, mean):
    rng = random.Random(mean)
    rows, passages = [], []
    for i in range(60):
        passage = marked(rng, 50, mean)
        passages.append({w.strip(".,;:!?") for w in passage})
        for j in (2 * i, 2 * i + 1):
            rows.append((j, " ".join(marked(rng, rng.randint(0, 30), mean) + passage + marked(rng, rng.randint(0, 30), mean))))
    got = left(spark, rows)
    texts = dict(rows)
    for i, own in enumerate(passages):
        assert got[2 * i] == (0, texts[2 * i])
        kept = {w.strip(".,;:!?") for w in got[2 * i + 1][1].split()}
        assert len(own & kept) <= len(own) - sentences.WORDS
        assert {w.strip(".,;:!?") for w in texts[2 * i + 1].split()} - own <= kept


def test_last_sentences_of_a_passage_go(spark):
    rng = random.Random(2)
    sentence = lambda n: " ".join(words(rng, n)) + ". "
    passage = "".join(sentence(n) for n in (9, 9, 8, 9, 3, 2))
    got = left(spark, [(1, passage + sentence(8)), (2, passage + (own := sentence(7)))])
    assert got[2][1] == own


def test_scripts_without_spaces(spark):
    rng = random.Random(5)
    some = lambda n: "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(n))
    passage = some(18) + "。" + some(17) + "，" + some(25)
    first, second = some(30) + passage + some(20), some(12) + "。" + passage + some(33)
    got = left(spark, [(1, first), (2, second)])
    assert got[1] == (0, first)
    assert len(got[2][1]) <= len(second) - 40


def test_texts_are_told_apart_by_more_than_32_bits(spark):
    """Two texts without ids and with one ``F.hash``, of which only one repeats a passage."""
    rng = random.Random(1)
    passage = ". ".join(" ".join(words(rng, 9)) for _ in range(4)) + ". "
    ids = spark.range(300_000).select(F.col("id").cast("string").alias("i"))
    long = ids.select(F.concat(F.lit(passage + "end "), "i").alias("x"))
    short = ids.select(F.concat(F.lit("short "), "i").alias("y"))
    x, y = long.join(short, F.hash("x") == F.hash("y")).orderBy("x", "y").first()
    got = sentences.remove_repeated_spans(spark.createDataFrame([(1, passage), (None, x), (None, y)], "doc_id long, text string"))
    assert sorted(r["text"] for r in got.where("doc_id is null").collect()) == sorted([x[len(passage) :], y])


def test_runs_end_at_every_sentence():
    first, last = sentences.runs_of(np.array([30, 25, 3, 2]))
    assert (1, 3) in set(zip(first.tolist(), last.tolist(), strict=True))
