"""Near-duplicates by SimHash fingerprints, compared in bit-sliced form."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestrata.llm.components import component_roots
from carestrata.llm.rows import add_columns
from carestrata.runtime import broadcast_when_small, materialise

BITS, BLOCKS = 64, 4
#: Fingerprints of a bucket that are compared with one another; larger buckets are dealt anew.
BUCKET = 256
#: Bit planes updated between two looks at what is still within the radius.
STRIDE = 8
#: Words (of 64 fingerprints) of a plane that are compared together.
SPAN = 1024


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """SimHash of a text's word shingles, repeats included; 0 for no words."""
    import xxhash

    tokens = text.lower().split()
    if not tokens:
        return 0
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(b" ".join(tokens), seed)
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
    starts = np.r_[0, ends[:-1]][: len(tokens) - words + 1].tolist()
    stops = (ends[words - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], seed) for a, b in zip(starts, stops, strict=True)], dtype=np.uint64)
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(h), 65_536):
        part = h[i : i + 65_536].astype("<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((np.uint64(1) << np.flatnonzero(2 * counts > len(h)).astype(np.uint64)).sum(dtype=np.uint64))


def with_fingerprint(docs: DataFrame, words: int, text_col: str, fp_col: str) -> DataFrame:
    """``docs`` with the fingerprint of every whole text as a signed long."""

    def compute(texts: list[str | None]) -> list:
        return [np.array([fingerprint((t or "").encode("utf-8", "replace"), words) for t in texts], dtype=np.uint64).view(np.int64)]

    return add_columns(docs, [text_col], f"`{fp_col}` long", compute)


def bit_planes(values: np.ndarray) -> np.ndarray:
    """One row of 64-bit words per bit; bit i of a plane belongs to value i."""
    padded = np.zeros(-(-len(values) // 64) * 64, dtype="<u8")
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def within_radius(planes: np.ndarray, live: np.ndarray, by: int, radius: int) -> np.ndarray:
    """Plane of the i whose value i and value i + ``by`` differ in at most ``radius`` bits.

    Carry-save counters hold the distances vertically: two planes count to three and
    a third remembers what went beyond the radius. After every ``STRIDE`` planes,
    words in which nothing is left are abandoned.
    """
    out = np.zeros_like(live)
    at = np.flatnonzero(live)
    other = at + by // 64
    bits = np.uint64(by % 64)
    ones, twos, over = (np.zeros(len(at), np.uint64) for _ in range(3))
    width = planes.shape[1]
    for first in range(0, BITS, STRIDE):
        if not len(at):
            return out
        for plane in planes[first : first + STRIDE]:
            far = plane[np.minimum(other, width - 1)]
            if bits:
                after = np.where(other + 1 < width, plane[np.minimum(other + 1, width - 1)], np.uint64(0))
                far = (far >> bits) | (after << (np.uint64(64) - bits))
            differ = plane[at] ^ far
            carry = ones & differ
            ones ^= differ
            spill = twos & carry
            twos ^= carry
            over |= spill
            over |= {0: ones | twos, 1: twos, 2: ones & twos}[radius]
        keep = np.flatnonzero(live[at] & ~over)
        at, other, ones, twos, over = at[keep], other[keep], ones[keep], twos[keep], over[keep]
    out[at] = live[at] & ~over
    return out


def linked(keys: np.ndarray, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of linked values of one key; rows are sorted by key.

    Value i meets value i + s for every s below the largest group, all i at once.
    """
    n = len(keys)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    size = np.diff(np.r_[first, n])
    left = n - 1 - np.arange(n) - (n - np.repeat(first + size, size))  # members after this one
    planes = bit_planes(values)
    a, b = [], []
    for s in range(1, int(size.max())):
        live = np.zeros(planes.shape[1] * 8, np.uint8)
        packed = np.packbits(left >= s, bitorder="little")
        live[: len(packed)] = packed
        live = live.view("<u8")
        for start in range(0, len(live), SPAN):
            part = np.zeros_like(live)
            part[start : start + SPAN] = live[start : start + SPAN]
            if not part.any():
                continue
            hit = within_radius(planes, part, s, radius)
            i = np.flatnonzero(np.unpackbits(hit.view(np.uint8), bitorder="little"))
            a.append(i), b.append(i + s)
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, int), np.zeros(0, int))


def forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of the given ones: fewer than ``n``."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        p, q = root(x), root(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            kept.append(i)
    return a[kept], b[kept]


def compare_buckets(rows: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) within the buckets of ``rows`` (key, fp); a forest of them per batch.

    Partitions are sorted by key and read in batches; the last key of a batch waits
    for the next one, so a task holds a batch and a bucket at most.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[np.ndarray] = []

        def links(k: np.ndarray, v: np.ndarray) -> pd.DataFrame:
            same = np.r_[np.zeros(min(1, len(k)), bool), k[1:] == k[:-1]]
            many = same | np.r_[same[1:], np.zeros(min(1, len(k)), bool)]
            k, v = k[many], v[many]
            if not len(k):
                return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
            a, b = forest(len(k), *linked(k, v.view(np.uint64), radius))
            return pd.DataFrame({"a": v[a], "b": v[b]})

        for pdf in batches:
            k, v = pdf["key"].to_numpy(np.int64), pdf["fp"].to_numpy(np.int64)
            if rest:
                k, v = np.r_[rest[0], k], np.r_[rest[1], v]
            if not len(k):
                continue
            cut = int(np.flatnonzero(k == k[-1])[0])
            rest = [k[cut:], v[cut:]]
            yield links(k[:cut], v[:cut])
        if rest:
            yield links(*rest)

    ordered = rows.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp")
    return ordered.mapInPandas(run, "a long, b long")


def fingerprint_links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Links (a, b) that join exactly what fingerprints within ``radius`` bits join.

    Of four blocks of 16 bits, a pair within two bits shares at least two: each
    fingerprint goes to six buckets by two blocks each. Buckets of at most ``BUCKET``
    are compared inside. In a larger bucket each fingerprint is listed with itself and
    with every change of one of the bits the bucket leaves open: two within two bits
    share such a neighbour, and one neighbour has at most 33 of them. No pair is lost
    and no group is larger than ``BUCKET``.
    """
    if not 0 <= radius <= 2:
        raise ValueError("the radius is 0, 1 or 2 bits")
    width = BITS // BLOCKS
    masks = []
    for i, j in combinations(range(BLOCKS), 2):
        mask = sum(((1 << width) - 1) << (width * b) for b in (i, j))
        masks.append(mask - (1 << BITS) if mask >> 63 else mask)
    choices = F.array([F.struct(F.lit(n).alias("n"), F.lit(m).cast("long").alias("mask")) for n, m in enumerate(masks)])
    rows = fps.select("fp", F.explode(choices).alias("c"))
    bucket = F.col("fp").bitwiseAND(F.col("c.mask"))
    rows = materialise(rows.select("fp", F.col("c.mask").alias("mask"), F.xxhash64("c.n", bucket).alias("key")), "simhash-buckets")
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    sizes = materialise(sizes, "simhash-sizes")
    shared = rows.join(sizes, "key")
    small = compare_buckets(shared.where(F.col("n") <= BUCKET), radius)
    flips = F.array([F.lit(0).cast("long"), *(F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(BITS))])
    open_bits = F.filter(flips, lambda f: f.bitwiseAND(F.col("mask")) == 0)
    near = shared.where(F.col("n") > BUCKET).select("fp", F.explode(open_bits).alias("flip"))
    near = near.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("near")).distinct()
    if radius < 2:
        return small.union(compare_buckets(near.withColumn("key", F.col("near")), radius))
    star = near.groupBy("near").agg(F.min("fp").alias("b"), F.collect_list("fp").alias("all")).where(F.size("all") > 1)
    star = star.select(F.explode("all").alias("a"), "b").where("a <> b").distinct()
    return small.union(star)


def _roots(fps: DataFrame, radius: int) -> DataFrame:
    """(fp, root): the smallest fingerprint that links reach, for distinct ``fps``."""
    links = materialise(fingerprint_links(fps, radius), "simhash-links")
    roots = component_roots(links).withColumnRenamed("node", "fp")
    return fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def simhash_components(docs: DataFrame, words: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every document.

    Texts are lower-cased (A-Z) and split at ASCII white space; a bit of the
    fingerprint is set if it is in over half the XXH64 (seed 42) of the word shingles.
    Fingerprints within ``radius`` bits are linked; ``component_id`` is the smallest
    id that links reach, the document's own included.

    Copies share a fingerprint, so links and rounds see distinct fingerprints only.
    Texts of fewer words are one shingle; null, empty and blank texts have
    fingerprint zero and are linked like any other. Null ids are kept: they join
    groups but never name one (a group of null ids only has a null component).
    Repeated rows come back each. An empty table gives no rows. Other columns are not
    read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = materialise(with_fingerprint(rows, words, "text", "fp").drop("text"), "simhash-rows")
    least = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-fps")
    named = materialise(_roots(least.select("fp"), radius).join(least, "fp"), "simhash-named")
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    table = broadcast_when_small(materialise(named.join(names, "root").select("fp", "component_id"), "simhash-components"))
    return rows.join(table, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, words: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their group: of each, one of the smallest id.

    Groups are those of :func:`simhash_components`; null ids come last, and of rows
    that repeat an id the first written stays. All columns are returned. The rows are
    written with a number each, so that exactly one per group is kept.
    """
    marked = with_fingerprint(docs, words, text_col, "_fp").withColumn("_row", F.monotonically_increasing_id())
    marked = materialise(marked, "simhash-marked")
    first = F.struct(F.col(id_col).isNull().alias("unnamed"), F.col(id_col).cast("long").alias("id"), F.col("_row").alias("row"))
    per_fp = materialise(marked.groupBy(F.col("_fp").alias("fp")).agg(F.min(first).alias("first")), "simhash-fps")
    kept = _roots(per_fp.select("fp"), radius).join(per_fp, "fp").groupBy("root").agg(F.min("first").alias("first"))
    kept = broadcast_when_small(materialise(kept.select(F.col("first.row").alias("_row")), "simhash-kept"))
    return marked.join(kept, "_row", "left_semi").select(docs.columns)
