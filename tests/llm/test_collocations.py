import random
import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from carestrata.llm import collocations as col


def brute(rows, support=10, longest=3, percent=50, top=None):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang, text = lang or "und", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f[lang][tuple(words[i : i + m])] += 1
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if a >= support and len(p) > 1}
        inner = defaultdict(int)
        for p, a in found.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inner[p[i : i + m]] = max(inner[p[i : i + m]], a)
        ranked = []
        for p, a in found.items():
            if p in inner and 100 * inner[p] >= percent * a:
                continue
            score, _, k = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def found(df, **kw):
    columns = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r[c] for c in columns) for r in col.collocations(df, **kw).select(*columns).collect())


def random_texts(seed, docs, words=8):
    draw = random.Random(seed)
    vocabulary = ["Aa", "b", "cé", "dd\x00", "E", "ff", "gg\u00a0g", "𝒳"][:words]
    marks = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "?!"]
    return [(draw.choice(["en", "fr", None, "und"]), "".join(draw.choice(vocabulary) + draw.choice(marks) for _ in range(draw.randint(0, 60)))) for _ in range(docs)]


@pytest.mark.parametrize(
    ("seed", "docs", "support", "longest", "shards", "size"),
    [(1, 60, 10, 3, 4, 1 << 20), (2, 200, 10, 3, 9, 40), (3, 40, 2, 4, 4, 64), (4, 50, 3, 2, 1, 100), (5, 60, 5, 5, 3, 33)],
)
def test_equals_brute_force(spark, seed, docs, support, longest, shards, size):
    """Small chunks cut texts inside pieces; several shards lower the support of each."""
    rows = random_texts(seed, docs)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(7)
    assert found(df, support=support, longest=longest, shards=shards, size=size) == brute(rows, support, longest)


def test_top_and_percent(spark):
    rows = random_texts(6, 120, 5)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert found(df, top=3, percent=20) == brute(rows, top=3, percent=20)


def test_awkward_rows(awkward, nothing):
    rows = [(None, r["text"]) for r in awkward.collect()]
    named = awkward.withColumnRenamed("taken", "key").selectExpr("*", "cast(null as string) as lang", "1 as shard", "'x' as phrase", "2 as n")
    assert found(named) == brute(rows)
    assert col.collocations(nothing.selectExpr("*", "'en' as lang")).count() == 0
    assert found(named.select("lang", "text"), support=1, size=50) == brute(rows, support=1)


def test_large_counts_stay_exact(spark):
    phrases = spark.createDataFrame([("en", "a b c", 3, 10**12 - 1)], "lang string, phrase string, words int, a long")
    parts = [("en", "a", 10**12 + 7), ("en", "b c", 10**12 + 3), ("en", "a b", 10**12), ("en", "c", 10**12 + 11)]
    r = col.scored(phrases, spark.createDataFrame(parts, "lang string, phrase string, n long")).first()
    a = 10**12 - 1
    assert (r["score"], r["l"], r["r"]) == min((1000000 * a * a // (x * y), x, y) for x, y in ((10**12 + 7, 10**12 + 3),))
    assert r["score"] == 999999


@pytest.mark.parametrize("size", [1, 7, 30, 1000])
@pytest.mark.parametrize("context", [0, 1, 2])
def test_segments_hold_every_word_once(size, context):
    text = b"one two three. four\tfive six seven eight nine, " + b"x" * 50 + b" y z"
    parts = list(col.segments(text, size, context))
    words = [w for part, lead in parts for piece in re.split(rb"[.,]", part) for w in [piece.split()]]
    fresh = []
    for part, lead in parts:
        flat = re.split(rb"[\s.,]+", part.strip(b" .,\t"))
        fresh += [w for w in flat if w][lead:]
    assert fresh == [w for w in re.split(rb"[\s.,]+", text) if w]
    assert words


def test_supports_of_shards_leave_no_phrase_out(spark):
    rows = [("en", s, f"w{s}", n, n) for s, n in enumerate([1, 7, 50, 3])] + [("fr", 2, "w", 1, 4)]
    words = spark.createDataFrame(rows, "lang string, shard int, word string, key long, n long")
    least = {r["part"]: r["least"] for r in col.shares(words, 10).collect()}
    en, fr = zlib.crc32(b"en") * 16, zlib.crc32(b"fr") * 16
    assert least == {en: 1, en + 1: 2, en + 2: 9, en + 3: 1, fr + 2: 10}
    assert sum(v - 1 for part, v in least.items() if part < fr or part > fr + 15) < 10


def test_bitmap_knows_its_keys(spark):
    keys = [hash(("key", i)) for i in range(3000)] + [-1, 0, 1, 2**63 - 1, -(2**63)]
    bits = col.bitmap_of(spark.createDataFrame([(k,) for k in keys], "key long"))
    import numpy as np

    has = col.Bitmap(np.frombuffer(bits, dtype=np.uint8)).has
    assert has(np.array(keys, dtype=np.int64).view(np.uint64)).all()
    assert has(np.random.default_rng(1).integers(0, 2**63, 10000).astype(np.uint64)).mean() < 0.2


def test_chunks_are_bounded():
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "fr"] * 500), pa.array([b"some words here " * 3] * 1000)], names=["lang", "text"])
    made = list(col.chunks(iter([batch]), 500, 2))
    assert sum(int(c.fresh.sum()) for c in made) == 9000 and max(len(c.ids) for c in made) <= 11 * 9
