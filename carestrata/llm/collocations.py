"""Phrases whose words occur together more often than apart, by partitioned mining.

Texts are mined in a few shards (the SON scheme). A phrase with ``support``
occurrences has, in one shard at least, its share of them: ``support`` times the
shard's share of all words. So each shard is mined completely at that lowered support,
level by level (words, then phrases of two words, and so on), what is frequent in
some shard is united, and one more pass counts these candidates in all texts exactly.

A shard is mined by many tasks. A task cuts its texts into chunks of ``CHUNK`` bytes,
counts the phrases of a chunk in numpy arrays and hands on one row per phrase and
chunk; Spark adds them up per shard. Between the passes frequent phrases travel as a
bitmap of hashes of bounded size: what it lets through by chance only costs time,
since every phrase is counted by its words in the end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carestrata.runtime import broadcast_when_small, discard, materialise

#: Shards of the texts. Up to nine, a phrase seen once in each need not be frequent.
SHARDS = 3
#: Bytes of text counted at one time.
CHUNK = 1 << 22
#: Bounds of a bitmap's size, as powers of two.
FEWEST_BITS, MOST_BITS = 15, 28
#: Bits of one row of a bitmap (what ``bitmap_construct_agg`` makes).
_ROW_BITS = 1 << 15

_BLANKS, _MARKS = b" \t", b".,;:!?\n\x0b\x0c\r"
_KIND = bytes(1 if c in _BLANKS else 2 if c in _MARKS else 0 for c in range(256))
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Chunk:
    """The words of some texts in order.

    ``ids`` are places in ``words``; ``joined`` says that a word follows the one
    before it in the same piece, ``fresh`` that it is not repeated from another chunk.
    """

    lang: str
    words: pa.Array
    ids: np.ndarray
    joined: np.ndarray
    fresh: np.ndarray


def segments(text: bytes, size: int, context: int) -> Iterator[tuple[bytes, int]]:
    """Parts of about ``size`` bytes of a text, with how many words each repeats.

    A text is cut after a mark. Where a window has none, it is cut at a blank, and the
    next part begins with the last ``context`` words once more. A longer word stays whole.
    """
    lead = 0
    while len(text) > size:
        window = text[:size]
        cut = 1 + max(window.rfind(bytes([c])) for c in _MARKS)
        if cut:
            yield window[:cut], lead
            text, lead = text[cut:], 0
            continue
        cut = 1 + max(window.rfind(bytes([c])) for c in _BLANKS)
        again = window[:cut].split()
        if len(again) <= max(lead, context):
            size *= 2
            continue
        again = again[-context:] if context else []
        yield window[:cut], lead
        text, lead = b" ".join([*again, text[cut:]]), len(again)
    yield text, lead


def chunk_of(lang: str, parts: list[tuple[bytes, int]]) -> Chunk:
    """The words of the parts of texts of one language."""
    data = b"\n" + b"\n".join(p for p, _ in parts) + b"\n"
    kinds = np.frombuffer(data.translate(_KIND), dtype=np.uint8)
    inside = kinds == 0
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    offsets = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    packed = data.translate(_LOWER, _BLANKS + _MARKS)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
    encoded = words.dictionary_encode()
    piece = np.searchsorted(np.flatnonzero(kinds == 2), starts)
    joined = np.zeros(len(starts), dtype=bool)
    joined[1:] = piece[1:] == piece[:-1]
    fresh = np.ones(len(starts), dtype=bool)
    at = 1
    for part, lead in parts:
        if lead:
            first = int(np.searchsorted(starts, at))
            fresh[first : first + lead] = False
        at += len(part) + 1
    return Chunk(lang, encoded.dictionary, encoded.indices.to_numpy().astype(np.int64), joined, fresh)


def chunks(batches: Iterator[pa.RecordBatch], size: int, context: int) -> Iterator[Chunk]:
    """The texts of a task by language, ``size`` bytes or a little more at a time."""
    held: dict[str, list[tuple[bytes, int]]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for lang, text in zip(langs, (v.as_py() for v in batch.column(1)), strict=True):
            for part in segments(text, size, context):
                held.setdefault(lang, []).append(part)
                sizes[lang] = sizes.get(lang, 0) + len(part[0])
                if sizes[lang] >= size or sum(sizes.values()) >= 4 * size:
                    most = max(sizes, key=sizes.__getitem__)
                    sizes.pop(most)
                    yield chunk_of(most, held.pop(most))
    while held:
        yield chunk_of(*held.popitem())


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(32))


def word_hashes(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """A hash per distinct word, and the same as a phrase of the chunk's language."""
    plain = np.fromiter((xxhash.xxh64_intdigest(w.as_py()) for w in chunk.words), dtype=np.uint64, count=len(chunk.words))
    return plain, _mixed(plain + np.uint64(xxhash.xxh64_intdigest(chunk.lang)))


@dataclass
class Bitmap:
    """Which hashes may be in a set: surely not where the bit is unset."""

    bits: np.ndarray

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys & np.uint64(len(self.bits) * 8 - 1)
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap_of(keys: DataFrame) -> bytes:
    """A bitmap of the column ``key``; a row per 4 KB of it reaches the driver.

    It has sixteen bits per key between ``2 ** FEWEST_BITS`` and ``2 ** MOST_BITS`` bits
    (32 MB). Beyond, more phrases pass by chance and are counted for nothing.
    """
    size = 1 << min(MOST_BITS, max(FEWEST_BITS, (16 * keys.count() - 1).bit_length()))
    at = F.col("key").bitwiseAND(F.lit(size - 1))
    rows = (
        keys.groupBy(F.shiftright(at, 15).alias("row"))
        .agg(F.bitmap_construct_agg(at.bitwiseAND(F.lit(_ROW_BITS - 1))).alias("bits"))
        .collect()
    )
    whole = bytearray(size // 8)
    for r in rows:
        whole[r["row"] * _ROW_BITS // 8 : (r["row"] + 1) * _ROW_BITS // 8] = r["bits"]
    return bytes(whole)


@dataclass
class Level:
    """Phrases of a number of words in a chunk: which, how often, and their hashes."""

    members: np.ndarray
    counts: np.ndarray
    keys: np.ndarray


def levels(chunk: Chunk, maps: list[Bitmap], longest: int) -> Iterator[Level]:
    """The phrases of 2 to ``longest`` words of a chunk, level by level.

    A phrase counts at its last word. Its two parts without the last and without the
    first word must be in the bitmap of their length; a last level without a bitmap of
    its own gives all phrases that are left.
    """
    plain, key_of = word_hashes(chunk)
    n = len(chunk.words)
    alive = maps[0].has(key_of)[chunk.ids]
    code, key = chunk.ids, key_of[chunk.ids]
    for length in range(2, longest + 1):
        ends = np.flatnonzero(alive[1:] & alive[:-1] & chunk.joined[1:]) + 1
        found, first, inverse = np.unique(code[ends - 1] * n + chunk.ids[ends], return_index=True, return_inverse=True)
        last_words = chunk.ids[ends[first]]
        keys = _mixed(key[ends[first] - 1] * _ODD + plain[last_words])
        keep = maps[length - 1].has(keys) if len(maps) >= length else np.ones(len(found), dtype=bool)
        counts = np.bincount(inverse[chunk.fresh[ends]], minlength=len(found))
        told = keep & (counts > 0)
        places = ends[first[told]][:, None] + np.arange(1 - length, 1)
        yield Level(chunk.ids[places], counts[told], keys[told])
        if length < longest:
            code, key = np.zeros_like(code), np.zeros_like(key)
            code[ends], key[ends] = inverse, keys[inverse]
            alive = np.zeros_like(alive)
            alive[ends] = keep[inverse]


def _passes(docs: DataFrame, schema: str, size: int, context: int, rows: Callable[[Chunk], Iterator[list]]) -> DataFrame:
    """A table made of the chunks of all texts, one list of columns at a time.

    Columns of one value for a whole chunk are given as that value.
    """
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, size, context):
            for columns in rows(chunk):
                n = len(columns[-1])
                if n:
                    yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.repeat(c, n) for c in columns], names=names)

    return docs.mapInArrow(run, schema)


def _ints(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.int64))


def _signed(keys: np.ndarray) -> pa.Array:
    return pa.array(keys.view(np.int64))


def word_counts(docs: DataFrame, shards: int = SHARDS, size: int = CHUNK) -> DataFrame:
    """(lang, shard, word, key, n): occurrences of each word per shard.

    The shard is the number of the reading task, modulo ``shards``.
    """

    def rows(chunk: Chunk) -> Iterator[list]:
        _, keys = word_hashes(chunk)
        counts = np.bincount(chunk.ids[chunk.fresh], minlength=len(chunk.words))
        shard = TaskContext.get().partitionId() % shards
        yield [chunk.lang, pa.scalar(shard, pa.int32()), chunk.words.cast(pa.large_string()).cast(pa.string()), _signed(keys), _ints(counts)]

    found = _passes(docs, "lang string, shard int, word string, key bigint, n bigint", size, 0, rows)
    return found.groupBy("lang", "shard", "word").agg(F.max("key").alias("key"), F.sum("n").alias("n"))


def shares(words: DataFrame, support: int) -> DataFrame:
    """(part, least): the support of a language in a shard, in proportion to its words.

    ``least`` is rounded up, so the supports of all shards less one each stay below
    ``support``: a phrase that misses every one of them is not frequent. ``part`` numbers
    language and shard; languages that share a number by chance take the lower support.
    """
    per_shard = words.groupBy("lang", "shard").agg(F.sum("n").alias("here"))
    total = per_shard.groupBy("lang").agg(F.sum("here").alias("all"))
    part = F.crc32(F.col("lang").cast("binary")) * 16 + F.col("shard")
    share = F.lit(support) * F.col("here").cast("decimal(20,0)") / F.col("all").cast("decimal(20,0)")
    each = per_shard.join(total, "lang").select(part.alias("part"), F.greatest(F.lit(1), F.ceil(share).cast("long")).alias("least"))
    return each.groupBy("part").agg(F.min("least").alias("least"))


def mined(docs: DataFrame, least: DataFrame, maps: list[bytes], shards: int, size: int) -> DataFrame:
    """``key`` of every phrase of ``len(maps) + 1`` words that is frequent in some shard."""
    length = len(maps) + 1
    sent = docs.sparkSession.sparkContext.broadcast(maps)

    def rows(chunk: Chunk) -> Iterator[list]:
        part = crc32(chunk.lang.encode()) * 16 + TaskContext.get().partitionId() % shards
        bits = [Bitmap(np.frombuffer(m, dtype=np.uint8)) for m in sent.value]
        *_, last = levels(chunk, bits, length)
        yield [pa.scalar(part, pa.int64()), _signed(last.keys), _ints(last.counts)]

    found = _passes(docs, "part bigint, key bigint, n bigint", size, length - 1, rows)
    summed = found.groupBy("part", "key").agg(F.sum("n").alias("n"))
    enough = F.col("n") >= F.coalesce("least", F.lit(1))
    return summed.join(broadcast_when_small(least), "part", "left").where(enough).select("key").distinct()


def counted(docs: DataFrame, maps: list[bytes], support: int, size: int) -> DataFrame:
    """(lang, phrase, words, a): occurrences of every candidate with ``support`` of them."""
    longest = len(maps)
    sent = docs.sparkSession.sparkContext.broadcast(maps)

    def rows(chunk: Chunk) -> Iterator[list]:
        bits = [Bitmap(np.frombuffer(m, dtype=np.uint8)) for m in sent.value]
        text = chunk.words.cast(pa.large_string()).cast(pa.string())
        for level in levels(chunk, bits, longest):
            members = [text.take(pa.array(column)) for column in level.members.T]
            yield [chunk.lang, pc.binary_join_element_wise(*members, " "), pa.scalar(len(members), pa.int32()), _ints(level.counts)]

    found = _passes(docs, "lang string, phrase string, words int, a bigint", size, longest - 1, rows)
    return found.groupBy("lang", "phrase", "words").agg(F.sum("a").alias("a")).where(F.col("a") >= support)


def outdone(phrases: DataFrame, percent: int) -> DataFrame:
    """(lang, phrase) of those inside a longer phrase with ``percent`` of their occurrences."""
    word = F.split("phrase", " ")
    inner = F.expr("""flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1),
        i -> array_join(slice(word, i, m), ' '))))""")
    longer = phrases.where("words > 2").select("lang", "words", "a", word.alias("word"))
    holds = longer.select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    return phrases.join(holds, ["lang", "phrase"]).where(F.col("longer") * 100 >= F.col("a") * percent).select("lang", "phrase")


def scored(phrases: DataFrame, parts: DataFrame) -> DataFrame:
    """``phrases`` with l, r and score of the cut that binds least, all in whole numbers."""
    cut = F.expr("""transform(sequence(1, words - 1), k -> struct(k as k,
        array_join(slice(split(phrase, ' '), 1, k), ' ') as head,
        array_join(slice(split(phrase, ' '), k + 1, words - k), ' ') as tail))""")
    cuts = phrases.select("lang", "phrase", "a", F.inline(cut))
    heads = parts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tails = parts.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    both = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    exact = "(cast(a as decimal(15,0)) * cast(a as decimal(15,0)) * 1000000) div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))"
    least = F.min(F.struct(F.expr(exact).alias("score"), "k", "l", "r")).alias("cut")
    return both.groupBy("lang", "phrase", "a").agg(least).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(
    docs: DataFrame,
    support: int = 10,
    longest: int = 3,
    percent: int = 50,
    top: int | None = None,
    shards: int = SHARDS,
    size: int = CHUNK,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the phrases of 2 to ``longest`` words.

    A-Z are lower-cased, texts split into pieces at ``. , ; : ! ?`` and line ends, pieces
    into words at blanks; nothing crosses a piece. Per language, n counts all words and a
    the phrase, which needs ``support`` occurrences (overlaps count). Of all ways to cut
    a phrase in two, with l and r occurrences, the one with the lowest score
    ``floor(1000000 * a * a / (l * r))`` counts, the first of equals. Phrases inside a longer
    one that has ``percent`` of their occurrences are left out. Ranks go by score, a
    (both falling) and phrase in byte order; ``top`` keeps the first of each language.

    A null language is ``und``, a null text empty; repeated rows count each; blank and
    empty texts add nothing; texts of any length are counted whole, in parts. An empty
    table gives no rows. Counts up to 10 ** 15 are exact. Other columns are not read.
    """
    if not 1 <= shards <= 9:
        raise ValueError("1 to 9 shards")
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    )
    words = materialise(word_counts(texts, shards, size), "phrase-words")
    least = materialise(shares(words, support), "phrase-shares")
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = words.groupBy("lang", "word").agg(F.sum("n").alias("n"), F.max("key").alias("key")).where(F.col("n") >= support)
    frequent = materialise(frequent, "phrase-frequent")
    maps = [bitmap_of(frequent)]
    for _ in range(2, longest + 1):
        found = materialise(mined(texts, least, maps, shards, size), "phrase-found")
        maps.append(bitmap_of(found))
        discard(found)
    phrases = materialise(counted(texts, maps, support, size), "phrase-counted")
    parts = phrases.select("lang", "phrase", F.col("a").alias("n")).union(frequent.select("lang", F.col("word").alias("phrase"), "n"))
    left = phrases.join(outdone(phrases, percent), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored(left, parts).withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    ranked = materialise(ranked, "phrase-ranked")
    return ranked.join(broadcast_when_small(total), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
