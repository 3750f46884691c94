"""Near copies by the true similarity of word shingles, found by prefixes of rare shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestrata.llm.components import component_roots
from carestrata.llm.rows import SLICE, add_columns, give_back
from carestrata.llm.simhash import fingerprint, fingerprint_links
from carestrata.runtime import broadcast_when_small, discard, materialise

#: Near copies share at least four fifths of the shingles that either has.
PART, WHOLE = 4, 5
#: Shingles in at least so many prefixes count as common, the most frequent ``COMMON`` of them.
OFTEN, COMMON = 4, 200_000
#: Documents of a bucket that are paired by a join; larger ones are dealt into cells of two parts.
BUCKET, CELL = 64, 1024
#: Counters of a sketch.
BINS = 64
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93], dtype=np.uint64)


def shingles_of(tokens: list[bytes], words: int) -> np.ndarray:
    """The distinct word shingles of a text as sorted 64-bit hashes; one if it has fewer words."""
    import xxhash

    if not tokens:
        return np.zeros(0, np.int64)
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(w) for w in tokens], dtype=np.uint64)
    k = min(words, len(h))
    out = np.full(len(h) - k + 1, k, dtype=np.uint64)
    for j in range(k):
        out = (out ^ h[j : len(h) - k + 1 + j]) * _MIX[j % len(_MIX)]
        out ^= out >> np.uint64(29)
    return np.unique(out.view(np.int64))


def prefix_length(n: np.ndarray | int) -> np.ndarray | int:
    """So many first shingles, in any order all texts share, that near copies have one in common."""
    return n - (PART * n + WHOLE - 1) // WHOLE + 1


def enough(shared: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether sets of ``sizes`` shingles together that share so many are near copies."""
    return (PART + WHOLE) * shared >= PART * sizes


def with_digest_and_fingerprint(docs: DataFrame, words: int, text_col: str) -> DataFrame:
    """``docs`` with ``_hi`` and ``_lo``, a digest of a text's lower-cased words, and ``_fp``, its fingerprint.

    Both are made in one pass: each pass of a task has a Python worker of its own, and
    an executor keeps all its workers, and their memory, for the stages that follow.
    """

    def compute(texts: list[str | None]) -> list:
        import xxhash

        raw = [(t or "").encode("utf-8", "replace") for t in texts]
        both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(b" ".join(t.lower().split())) for t in raw), dtype="<i8").reshape(-1, 2)
        return [both[:, 0], both[:, 1], np.array([fingerprint(t, words) for t in raw], dtype=np.uint64).view(np.int64)]

    return add_columns(docs, [text_col], "_hi long, _lo long, _fp long", compute)


def shingle_sets(texts: DataFrame, words: int) -> DataFrame:
    """(node, n, sketch, shingles) of every text with words; ``sketch`` counts shingles by their last bits."""

    def compute(texts: list[str | None]) -> list:
        sets = [shingles_of((t or "").encode("utf-8", "replace").lower().split(), words) for t in texts]
        sketch = [np.minimum(np.bincount(s & (BINS - 1), minlength=BINS), 255).astype(np.uint8).tobytes() for s in sets]
        return [[len(s) for s in sets], sketch, sets]

    return add_columns(texts, ["text"], "n int, sketch binary, shingles array<long>", compute, drop=("text",)).where("n > 0")


def prefixes(texts: DataFrame, words: int, common: np.ndarray) -> DataFrame:
    """(key, node, n, place) of the first shingles of every text (node, text): rare ones, then common ones, each by value.

    The shingles themselves stay in the task that makes them.
    """

    def first(s: np.ndarray) -> np.ndarray:
        take = prefix_length(len(s))
        if not len(common):
            return s[:take]
        found = common[np.minimum(np.searchsorted(common, s), len(common) - 1)] == s
        rare = s[~found][:take]
        return rare if len(rare) == take else np.r_[rare, s[found][: take - len(rare)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, SLICE) for whole in batches for at in range(0, whole.num_rows, SLICE)):
            keys, nodes, sizes = [], [], []
            for node, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist(), strict=True):
                s = shingles_of((text or "").encode("utf-8", "replace").lower().split(), words)
                if len(s):
                    keys.append(first(s)), nodes.append(node), sizes.append(len(s))
            if keys:
                many = [len(k) for k in keys]
                place = np.concatenate([np.arange(k, dtype=np.int32) for k in many])
                arrays = [np.concatenate(keys), np.repeat(np.array(nodes, np.int64), many), np.repeat(np.array(sizes, np.int32), many), place]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["key", "node", "n", "place"])
        give_back()

    return texts.select("node", "text").mapInArrow(run, "key long, node long, n int, place int")


def _could(n: Column, place: Column, m: Column, other: Column) -> Column:
    """Whether sets of n and m shingles whose first common one has these places can be near copies."""
    return (PART + WHOLE) * F.least(n - place, m - other) >= PART * (n + m)


def near_in_cell(sets: list[np.ndarray], places: np.ndarray) -> tuple[list[int], list[int]]:
    """Links that join all near copies of a cell; pairs that are joined already are passed over."""
    n = np.array([len(s) for s in sets])
    names, local = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(n)
    starts = ends - n
    sketch = np.zeros((len(sets), BINS), np.int16)
    np.add.at(sketch, (np.repeat(np.arange(len(sets)), n), np.concatenate(sets) & (BINS - 1)), 1)
    left, root = n - places, np.arange(len(sets))
    mark = np.zeros(len(names), bool)
    a, b = [], []
    for i in range(len(sets) - 1):
        j = np.arange(i + 1, len(sets))
        total = n[i] + n[j]
        j = j[(root[j] != root[i]) & enough(np.minimum(left[i], left[j]), total)]
        if len(j):
            j = j[(PART + WHOLE) * np.abs(sketch[j] - sketch[i]).sum(axis=1, dtype=np.int64) <= (WHOLE - PART) * (n[i] + n[j])]
        if not len(j):
            continue
        own = local[starts[i] : ends[i]]
        mark[own] = True
        lengths = n[j]
        at = np.cumsum(lengths) - lengths
        flat = np.repeat(starts[j] - at, lengths) + np.arange(lengths.sum())
        shared = np.add.reduceat(mark[local[flat]].astype(np.int64), at)
        mark[own] = False
        for k in j[enough(shared, n[i] + lengths)].tolist():
            if root[k] != root[i]:
                a.append(i), b.append(k)
                root[root == root[k]] = root[i]
    return a, b


def near_fingerprints(prints: DataFrame, texts: DataFrame, words: int, radius: int = 2) -> DataFrame:
    """Links (a, b) of near copies whose SimHash fingerprints, ``prints`` (node, fp), lie within ``radius`` bits.

    Equal fingerprints are linked to one of them, which stands for all when
    fingerprints are compared in bit-sliced form. A link counts if the shingles of both
    texts confirm it, since fingerprints of different texts may be close.
    """
    per = materialise(prints.groupBy("fp").agg(F.min("node").alias("b")), "shingle-fps")
    equal = prints.join(per, "fp").select(F.col("node").alias("a"), "b")
    close = fingerprint_links(per.select("fp"), radius)
    close = close.join(per.select(F.col("fp").alias("a"), F.col("b").alias("x")), "a").join(per.select(F.col("fp").alias("b"), F.col("b").alias("y")), "b")
    both = equal.union(close.select("x", "y")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = materialise(both.where("a <> b").distinct(), "shingle-close")
    links = materialise(confirmed(pairs, held_sets(pairs, texts, words)), "shingle-fp-links")
    discard(pairs)
    return links


def held_sets(pairs: DataFrame, texts: DataFrame, words: int, more: DataFrame | None = None) -> DataFrame:
    """(node, shingles) of the texts in ``pairs``, and of the nodes ``more``, stored."""
    needed = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    needed = (needed.union(more) if more is not None else needed).distinct()
    needed = broadcast_when_small(materialise(needed, "shingle-needed"))
    return materialise(shingle_sets(texts.join(needed, "node", "left_semi"), words).select("node", "shingles"), "shingle-sets")


def confirmed(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) whose shingles in ``held`` make them near copies."""
    left, right = held.toDF("a", "sa"), held.toDF("b", "sb")
    met = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(left, "a").join(right, "b").where((PART + WHOLE) * met >= PART * (F.size("sa") + F.size("sb"))).select("a", "b")


def near_links(texts: DataFrame, prints: DataFrame, words: int) -> DataFrame:
    """Links (a, b) of ``texts`` (node, text) that join exactly what near copies join.

    Copies with close fingerprints, ``prints`` (node, fp), are linked by those; pairs
    that these links join are not looked at again. Near copies of similarity 0.8 may
    differ in 10 to 14 bits, so the others are found by their shingles. Two sets with at least four fifths in common share a shingle of their first fifths,
    whatever the order of shingles, so each set goes to the buckets of its first fifth.
    Common shingles come last in the order, which keeps boilerplate out of the
    buckets. Pairs of buckets up to ``BUCKET`` are sifted by sizes, places and sketches
    (bounds that never reject a near copy) and confirmed by the sets. In larger ones
    every pair meets in a cell, where only pairs not joined yet are confirmed. Shingles
    are made anew for each pass, since all of them take more room than the texts; those
    of texts that need to be confirmed are stored.
    """
    sets = shingle_sets(texts, words)
    drawings = materialise(sets.select("node", "n", "sketch"), "shingle-sketches")
    known = near_fingerprints(prints, texts, words)
    roots = materialise(component_roots(known), "shingle-roots")
    nothing = np.zeros(0, np.int64)
    often = prefixes(texts, words, nothing).groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= OFTEN)
    often = often.orderBy(F.desc("n"), "key").limit(COMMON).select("key").toPandas()["key"].to_numpy(np.int64)
    rows = prefixes(texts, words, np.sort(often))
    sizes = materialise(rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "shingle-sizes")
    shared = materialise(rows.join(broadcast_when_small(sizes), "key"), "shingle-buckets")

    x = shared.where(F.col("size") <= BUCKET).select("key", F.col("node").alias("a"), "n", "place")
    y = x.select("key", F.col("a").alias("b"), F.col("n").alias("m"), F.col("place").alias("other"))
    pairs = x.join(y, "key").where((F.col("a") < F.col("b")) & _could(F.col("n"), F.col("place"), F.col("m"), F.col("other")))
    root_of = broadcast_when_small(roots)
    pairs = pairs.select("a", "b").distinct().join(root_of.toDF("a", "ra"), "a", "left").join(root_of.toDF("b", "rb"), "b", "left")
    pairs = materialise(pairs.where(~F.coalesce(F.col("ra") == F.col("rb"), F.lit(False))).select("a", "b"), "shingle-pairs")

    def sifted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x, y = (np.frombuffer(b"".join(pdf[c]), np.uint8).reshape(-1, BINS).astype(np.int16) for c in ("sa", "sb"))
                apart = np.abs(x - y).sum(axis=1, dtype=np.int64)
                yield pdf.loc[(PART + WHOLE) * apart <= (WHOLE - PART) * (pdf["na"] + pdf["nb"]).to_numpy(np.int64), ["a", "b"]]

    def side(table: DataFrame, c: str, *names: str) -> DataFrame:
        return table.select(F.col("node").alias(c), *(F.col(name).alias(name[0] + c) for name in names))

    drawn = pairs.join(side(drawings, "a", "n", "sketch"), "a").join(side(drawings, "b", "n", "sketch"), "b")
    likely = materialise(drawn.mapInPandas(sifted, "a long, b long"), "shingle-likely")
    wide = shared.where(F.col("size") > BUCKET)
    held = held_sets(likely, texts, words, wide.select("node"))
    small = confirmed(likely, held)

    def cell(pdf: pd.DataFrame) -> pd.DataFrame:
        nodes = pdf["node"].to_numpy(np.int64)
        a, b = near_in_cell([np.asarray(s, np.int64) for s in pdf["shingles"]], pdf["place"].to_numpy(np.int64))
        return pd.DataFrame({"a": nodes[a], "b": nodes[b]})

    parts = F.ceil(F.col("size") / CELL).cast("int")
    large = wide.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    large = large.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    large = large.select("node", "place", F.xxhash64("key", F.least("part", "with"), F.greatest("part", "with")).alias("cell"))
    large = large.join(held, "node").groupBy("cell").applyInPandas(cell, "a long, b long")
    links = materialise(small.union(large).union(known), "shingle-links")
    for table in (sizes, shared, pairs, likely, drawings, held, known, roots):
        discard(table)
    return links


def one_of_each_near_copy(docs: DataFrame, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their group: of each, one of the smallest id.

    Texts are lower-cased (A-Z) and split at ASCII white space. Two are linked if they
    have the same words or share at least four fifths of the distinct ``words``-word
    shingles that either has, which their SimHash fingerprints tell first and prefixes of
    shingles where those are too far apart; groups are what links reach. Texts of fewer words are one
    shingle; null, empty and blank texts are one group. Null ids come last, and of rows
    that repeat an id the first written stays. All columns are returned.
    """
    marked = with_digest_and_fingerprint(docs, words, text_col).withColumn("_row", F.monotonically_increasing_id())
    marked = materialise(marked, "shingle-marked")
    first = F.struct(F.col(id_col).isNull().alias("unnamed"), F.col(id_col).cast("long").alias("id"), F.col("_row").alias("row"))
    firsts = materialise(marked.groupBy("_hi", "_lo").agg(F.min(first).alias("first"), F.min("_fp").alias("fp")).select("first", "fp", F.col("first.row").alias("node")), "shingle-firsts")
    nodes = firsts.select("node")
    few = broadcast_when_small(nodes)
    texts = marked.select(F.col("_row").alias("node"), F.col(text_col).alias("text")).join(few, "node", "left_semi")
    links = near_links(texts if few is not nodes else materialise(texts, "shingle-texts"), firsts.select("node", "fp"), words)
    named = firsts.join(component_roots(links).withColumnRenamed("root", "_root"), "node", "left").withColumn("_root", F.coalesce("_root", "node"))
    kept = named.groupBy("_root").agg(F.min("first").alias("first"))
    kept = broadcast_when_small(materialise(kept.select(F.col("first.row").alias("_row")), "shingle-kept"))
    return marked.join(kept, "_row", "left_semi").select(docs.columns)
