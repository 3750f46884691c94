"""Repeated passages found by hashing runs of consecutive sentences."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestrata.llm.collocations import Bitmap, bitmap_of
from carestrata.llm.rows import add_columns, give_back
from carestrata.runtime import discard, materialise

#: A run has at least so many sentences and words, and no more sentences than that takes.
SENTENCES, WORDS = 2, 20
#: Parts of more words without a mark are cut at words that are the least of so many neighbours by hash.
LONG, WINDOW = 10, 6
#: Characters of text that are worked on at one time (a longer text alone).
SLICE = 1 << 20
_MARKS = ".!?\n,;:。！？｡…؟।，、；："
#: Scripts without spaces between words: each character counts as a word.
_BARE = "฀-໿က-႟ក-៿぀-ヿ㐀-鿿豈-﫿\U00020000-\U0003ffff"
_WORD = re.compile(f"[{_BARE}]|[^\\s{_BARE}]+")
_SPACE, _MARK, _ALONE = 1, 2, 4
#: Characters from here on are words of their own and have no case.
_FAR = 0x20000
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


@cache
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """Kind and lower case of every character below ``_FAR``, and of one that stands for all others."""
    kinds, lower = np.zeros(_FAR + 1, np.uint8), np.arange(_FAR + 1, dtype=np.uint32)
    for i in range(_FAR):
        c = chr(i)
        if c.isspace():
            kinds[i] = _SPACE
        low = c.lower()
        if len(low) == 1 and ord(low) < _FAR:
            lower[i] = ord(low)
    for first, last in re.findall(r"(.)-(.)", _BARE):
        kinds[ord(first) : ord(last) + 1] |= _ALONE
    kinds[[ord(c) for c in _MARKS]] |= _MARK
    return kinds, lower


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _A
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


def words_of(text: str) -> list[str]:
    """The lower-cased words of a text; characters of scripts without spaces are words."""
    return _WORD.findall(text.lower())


@dataclass
class Pieces:
    """The sentences of some texts: where each starts in the joined texts, its text and its words.

    Words have two hashes of 64 bits; those of a sentence follow each other.
    """

    starts: np.ndarray
    owner: np.ndarray
    words: np.ndarray
    hashes: tuple[np.ndarray, np.ndarray]


def _word_hashes(codes: np.ndarray, solid: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums of mixed (character, place in its word) per word, so many characters at a time."""
    one, two = np.zeros(len(begins), np.uint64), np.zeros(len(begins), np.uint64)
    lower = _characters()[1]
    at = 0
    while at < len(begins):
        upto = max(at + 1, int(np.searchsorted(begins, begins[at] + SLICE)))
        end = begins[upto] if upto < len(begins) else len(codes)
        place = np.flatnonzero(solid[begins[at] : end]) + begins[at]
        first = np.searchsorted(place, begins[at:upto])
        c = codes[place]
        c = np.where(c < _FAR, lower[np.minimum(c, _FAR)], c).astype(np.uint64)
        within = np.arange(len(place)) - np.repeat(first, np.diff(np.r_[first, len(place)]))
        x = _mixed(c * _C + within.astype(np.uint64) * _B + _A)
        one[at:upto] = np.add.reduceat(x, first)
        two[at:upto] = np.add.reduceat((x ^ _C) * (x >> np.uint64(31) | np.uint64(1)), first)
        at = upto
    return one, two


def _least_of_windows(h: np.ndarray, part: np.ndarray) -> np.ndarray:
    """The word of least hash (the last of equals) in every window of ``WINDOW`` words of a long part, but for first words."""
    if len(h) < WINDOW:
        return np.zeros(0, np.int64)
    at = np.arange(len(h) - WINDOW + 1)
    at = at[(part[at] == part[at + WINDOW - 1]) & (np.bincount(part)[part[at]] > LONG)]
    best = at.copy()
    for k in range(1, WINDOW):
        best = np.where(h[at + k] <= h[best], at + k, best)
    best = np.unique(best)
    return best[(best > 0) & (part[best] == part[best - 1])]


def pieces_of(texts: list[str]) -> Pieces:
    """The sentences of all texts.

    A sentence ends after marks (line ends, . ! ? , ; : and the like of other scripts)
    and the spaces about them; what still has more than ``LONG`` words is cut where
    every window of ``WINDOW`` words has its least hash. A cut depends on the words of
    its windows only, so a passage is cut alike wherever it stands.
    """
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    opens = np.r_[0, np.cumsum(sizes)][:-1]
    n = len(codes)
    kinds = _characters()[0][np.minimum(codes, _FAR)]
    kinds[codes >= _FAR] = _ALONE
    start = np.zeros(n, bool)
    start[opens[sizes > 0]] = True
    marks = np.r_[0, np.cumsum(kinds & _MARK > 0, dtype=np.int32)]
    core = np.flatnonzero(kinds & (_SPACE | _MARK) == 0)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    seen = np.maximum(marks[np.r_[0, core[:-1]]] if len(core) else marks[:0], marks[opens[owner[core]]])
    start[core[marks[core] > seen]] = True

    solid = kinds & _SPACE == 0
    begins = solid & start
    begins[1:] |= solid[1:] & (~solid[:-1] | (kinds[1:] & _ALONE > 0) | (kinds[:-1] & _ALONE > 0))
    if n:
        begins[0] = solid[0]
    begins = np.flatnonzero(begins)
    hashes = _word_hashes(codes, solid, begins)
    part = np.cumsum(start)[begins]
    start[begins[_least_of_windows(hashes[0], part)]] = True
    starts = np.flatnonzero(start)
    words = np.bincount(np.cumsum(start)[begins] - 1, minlength=len(starts)) if n else np.zeros(0, np.int64)
    return Pieces(starts, owner[starts], words.astype(np.int64), hashes)


def sentences_of(text: str) -> list[str]:
    """The sentences of a text, white space after them included; joined, they are the text."""
    at = [*pieces_of([text]).starts.tolist(), len(text)]
    return [text[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def _runs(counts: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(counts)
    upto = np.r_[0, np.cumsum(counts)]
    at = np.arange(n)
    least, most = np.searchsorted(owner, owner), np.searchsorted(owner, owner, side="right")
    last = np.maximum(np.searchsorted(upto, upto[:-1] + WORDS) - 1, at + SENTENCES - 1)
    first = np.minimum(np.searchsorted(upto, upto[1:] - WORDS, side="right") - 1, at - SENTENCES + 1)
    on, back = last < most, first >= least
    both = np.unique(np.r_[at[on] * n + last[on], first[back] * n + at[back]])
    return both // max(n, 1), both % max(n, 1)


def runs_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) of the shortest run from every sentence on, and of that up to every sentence.

    Sentences without words are passed over by the caller.
    """
    return _runs(counts, np.zeros(len(counts), np.int32))


@dataclass
class Spans:
    """Runs of sentences: the text of each, its first and last sentence (of those with words) there, two hashes."""

    owner: np.ndarray
    first: np.ndarray
    last: np.ndarray
    hashes: list[np.ndarray]


def spans_of(texts: list[str]) -> Spans:
    """Every run of the texts, hashed over its words one by one."""
    pieces = pieces_of(texts)
    real = pieces.words > 0
    counts, owner = pieces.words[real], pieces.owner[real]
    first, last = _runs(counts, owner)
    upto = np.r_[0, np.cumsum(counts)]
    begin, length = upto[first], upto[last + 1] - upto[first] if len(first) else first
    hashes = [length.astype(np.uint64), length.astype(np.uint64) + _C]
    left = np.arange(len(first))
    for k in range(int(length.max(initial=0))):
        if k >= WORDS:
            left = left[length[left] > k]
        for lane, words in zip(hashes, pieces.hashes, strict=True):
            lane[left] = _mixed(lane[left] ^ words[begin[left] + k])
    low = np.searchsorted(owner, owner)[first]
    return Spans(owner[first], first - low, last - low, hashes)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The batch and its texts, ``SLICE`` characters or one text at a time."""
    start, held, size = 0, [], 0
    for i, value in enumerate(batch.column("text")):
        text = value.as_py() or ""
        if held and size + len(text) > SLICE:
            yield batch.slice(start, len(held)), held
            start, held, size = i, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield batch.slice(start, len(held)), held


def repeated_runs(rows: DataFrame) -> DataFrame:
    """``key`` of every run that stands more than once in the texts of ``rows``: the first hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in _slices(batch):
                yield pa.RecordBatch.from_arrays([pa.array(spans_of(texts).hashes[0].view(np.int64))], names=["key"])
        give_back()

    return rows.select("text").mapInArrow(run, "key long").groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")


def likely_spans(rows: DataFrame, bits: bytes) -> DataFrame:
    """(doc, mark, hash, check, first, last) of the runs whose first hash is in the bitmap."""
    sent = rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Bitmap(np.frombuffer(sent.value, dtype=np.uint8))
        for batch in batches:
            for part, texts in _slices(batch):
                spans = spans_of(texts)
                keep = np.flatnonzero(known.has(spans.hashes[0]))
                of = pa.array(spans.owner[keep])
                numbers = (spans.hashes[0].view(np.int64), spans.hashes[1].view(np.int64), spans.first.astype(np.int32), spans.last.astype(np.int32))
                arrays = [part.column("doc").take(of), part.column("mark").take(of), *(pa.array(x[keep]) for x in numbers)]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc", "mark", "hash", "check", "first", "last"])
        give_back()

    return rows.select("doc", "mark", "text").mapInArrow(run, "doc long, mark binary, hash long, check long, first int, last int")


def remove_repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_sentences, n_removed, text) for every document.

    Runs of consecutive sentences (at least ``SENTENCES`` of them and ``WORDS`` words)
    are hashed and joined over all documents. The first occurrence of a run, by id,
    text and place, stays; sentences that any later one covers are removed. ``text``
    is what is left of the whole text; texts that lose nothing stay as they are.

    Two passes read the texts: the first counts the hashes alone, the second makes the
    runs anew and keeps those that a bitmap of the repeated hashes lets through (at most
    32 MB, see :func:`bitmap_of`). What passes by chance meets no other run of its 128
    bits, so it removes nothing.

    Null texts stay null; texts shorter than a run stay. Null ids come last. Rows that
    repeat both id and text (by a digest of 128 bits) are one document: each has that
    document's result. Pieces have at most ``LONG`` words, so a passage of 50 words holds
    a whole run wherever it stands. Runs are counted before they meet, and the join back has one row per run on one side,
    so a passage in a third of all documents can be split. An empty table gives no
    rows. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.unhex(F.md5(text.cast("binary"))).alias("mark"), F.col(text_col).alias("text"))
    again = materialise(repeated_runs(rows), "sentence-again")
    bits = bitmap_of(again)
    discard(again)
    shared = materialise(likely_spans(rows, bits), "sentence-shared")
    place = F.struct(F.col("doc").isNull().alias("unnamed"), "doc", "mark", "first")
    one = shared.groupBy("hash", "check").agg(F.min(place).alias("one"), F.count("*").alias("n"))
    one = materialise(one.where("n > 1").select("hash", "check", "one"), "sentence-one")
    later = shared.join(one, ["hash", "check"]).where(place > F.col("one"))
    gone = later.groupBy("doc", "mark").agg(F.collect_set(F.struct("first", "last")).alias("gone"))
    gone = materialise(gone, "sentence-gone").withColumnsRenamed({"doc": "_doc", "mark": "_mark"})
    discard(shared)
    discard(one)

    def cut(texts: list[str | None], gone: list) -> list:
        pieces = pieces_of([t or "" for t in texts])
        opens = np.r_[0, np.cumsum([len(t or "") for t in texts])]
        kept, count, removed = [], [], []
        for i, (old, runs) in enumerate(zip(texts, gone, strict=True)):
            a, b = np.searchsorted(pieces.owner, i), np.searchsorted(pieces.owner, i, side="right")
            real = np.flatnonzero(pieces.words[a:b] > 0)
            bad = np.zeros(b - a, bool)
            for r in runs or []:
                bad[real[r["first"] : r["last"] + 1]] = True
            if bad.any():
                at = (np.r_[pieces.starts[a:b], opens[i + 1]] - opens[i]).tolist()
                old = "".join(old[at[k] : at[k + 1]] for k in np.flatnonzero(~bad).tolist())
            kept.append(old), count.append(len(real)), removed.append(int(bad.sum()))
        return [count, removed, kept]

    same = F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("mark") == F.col("_mark"))
    judged = rows.join(gone, same, "left").select(F.col("doc").alias("doc_id"), "text", "gone")
    return add_columns(judged, ["text", "gone"], "n_sentences long, n_removed long, text string", cut, drop=("gone",))
