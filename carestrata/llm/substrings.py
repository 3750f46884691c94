"""Repeated substrings found with suffix arrays, over shards dealt by content."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestrata.llm.rows import add_columns
from carestrata.llm.sais import permuted_common_prefixes, suffix_array
from carestrata.runtime import broadcast_when_small, discard, materialise

#: Bytes of the gram that names a window's shard.
GRAM = 48
#: Distinct cuts of one gram that stay together; more are cut finer.
TOGETHER = 256
#: How many starts a cut of each round has at most (0: as many as the gram gives).
ROUNDS = (0, 16, 4, 1)
#: Bytes of cuts in a shard, on average.
SHARD_BYTES = 1_000_000
_CHUNK = 1 << 18
_CUT = "owner binary, first int, key long, lead int, starts int, body binary"


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from every position on."""
    h = data.astype(np.uint64) + np.uint64(1)
    power = 0x9E3779B97F4A7C15
    parts, size = {1: h}, 1
    while size * 2 <= GRAM:
        h = h[:-size] * np.uint64(power) + h[size:]
        power = power * power % 2**64
        size *= 2
        parts[size] = h
    rest = GRAM - size
    while rest:
        step = 1 << (rest.bit_length() - 1)
        tail = parts[step][size : size + len(h)]
        n = len(tail)
        h = h[:n] * np.uint64(pow(0x9E3779B97F4A7C15, step, 2**64)) + tail
        size, rest = size + step, rest - step
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if width > size else values


def anchor_runs(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """(text, first, last, anchor, key) of the runs of windows that share an anchor.

    The anchor of a window of ``length`` bytes is its gram of the least hash, the
    leftmost of equal ones: a property of the window's bytes, so equal windows have
    their anchors at the same place and hence the same key.
    """
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    none = tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),)
    if len(data) < length:
        return none
    h = gram_hashes(data)
    place = np.uint64(0xFFFFFFFF)
    least = sliding_least((h & ~place) | np.arange(len(h), dtype=np.uint64), length - GRAM + 1)
    anchor = (least & place).astype(np.int64)
    owner = np.searchsorted(ends, np.arange(len(anchor)), side="right")
    fine = np.arange(len(anchor)) + length <= ends[owner]
    starts = np.flatnonzero(fine & np.r_[True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])])
    if not len(starts):
        return none
    stop = np.flatnonzero(fine & np.r_[(anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]) | ~fine[1:], True])
    base = (ends - sizes)[owner[starts]]
    return owner[starts], starts - base, stop - base, anchor[starts] - base, h[anchor[starts]]


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of some ``_CHUNK`` bytes together, and where they begin."""
    at = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= _CHUNK:
            yield at, texts[at : i + 1]
            at, size = i + 1, 0
    if at < len(texts):
        yield at, texts[at:]


def anchors_of(docs: DataFrame, length: int) -> DataFrame:
    """(owner, key, first, last, anchor, cut): the runs of every text of ``docs``.

    ``owner`` is the MD5 of a text and ``cut`` a hash of the bytes that the windows
    of the run cover. A task lists a text once, however many copies it meets.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[bytes] = set()
        for pdf in batches:
            texts, owners = [], []
            for t in pdf["text"]:
                text = bytes(t)
                if len(text) >= length and (digest := hashlib.md5(text).digest()) not in seen:
                    seen.add(digest)
                    texts.append(text)
                    owners.append(digest)
            for at, part in _chunks(texts):
                who, first, last, anchor, key = anchor_runs(part, length)
                if len(who):
                    cuts = [
                        int.from_bytes(hashlib.blake2b(part[w][a : b + length], digest_size=8, salt=(c - a).to_bytes(4, "little")).digest(), "little", signed=True)
                        for w, a, b, c in zip(who.tolist(), first.tolist(), last.tolist(), anchor.tolist(), strict=True)
                    ]
                    yield pd.DataFrame(
                        {"owner": [owners[at + w] for w in who], "key": key.view(np.int64), "first": first, "last": last, "anchor": anchor, "cut": cuts}
                    )

    return docs.select("text").mapInPandas(run, "owner binary, key long, first int, last int, anchor int, cut long")


def _cut_out(texts: DataFrame, length: int) -> DataFrame:
    """Cuts with their bytes, from rows (owner, text, runs)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seen: set[bytes] = set()
            rows = []
            for owner, text, runs in zip(pdf["owner"], pdf["text"], pdf["runs"], strict=True):
                if owner not in seen:
                    seen.add(owner)
                    rows += [(owner, r["first"], r["key"], r["anchor"] - r["first"], r["last"] - r["first"] + 1, text[r["first"] : r["last"] + length]) for r in runs]
            yield pd.DataFrame(rows, columns=["owner", "first", "key", "lead", "starts", "body"])

    return texts.mapInPandas(run, _CUT)


def shard_repeats(shard: pd.DataFrame, length: int) -> pd.DataFrame:
    """Runs of starts in a shard's cuts whose windows occur in another cut of it.

    The cuts are joined into one text with separators, its suffix array is induced,
    and the suffixes that are windows' starts are kept: those that share ``length``
    bytes with a neighbour in the order are repeated.
    """
    shard = shard.sort_values("cut_id", kind="stable")
    bodies = [bytes(b) for b in shard["body"]]
    sizes = np.array([len(b) for b in bodies], dtype=np.int64)
    body = np.frombuffer(b"\0".join(bodies) + b"\0" * (length + 9), dtype=np.uint8)
    ends = np.cumsum(sizes + 1) - 1
    total = int(ends[-1]) + 1
    text = body[:total].astype(np.uint16) + 2
    text[ends] = 1
    order = suffix_array(np.r_[text, 0].astype(np.uint16), 258)[1:]
    base = ends - sizes
    starts = shard["starts"].to_numpy(np.int64)
    is_start = np.zeros(total + 1, dtype=np.int64)
    np.add.at(is_start, base, 1)
    np.add.at(is_start, base + starts, -1)
    is_start = np.cumsum(is_start)[:total] > 0
    at, shared = permuted_common_prefixes(body, order[is_start[order]], length)
    hit = at[shared >= length]
    ids = shard["cut_id"].to_numpy()
    if not len(hit):
        return pd.DataFrame({"cut_id": ids[:0], "lo": np.zeros(0, int), "hi": np.zeros(0, int)})
    owner = np.searchsorted(ends, hit, side="right")
    new = np.r_[True, (hit[1:] != hit[:-1] + 1) | (owner[1:] != owner[:-1])]
    lo = hit[new] - base[owner[new]]
    hi = hit[np.r_[new[1:], True]] - base[owner[new]]
    return pd.DataFrame({"cut_id": ids[owner[new]], "lo": lo, "hi": hi})


def _finer(cuts: DataFrame, length: int, starts: int) -> DataFrame:
    """Cuts of at most ``starts`` starts each, keyed by all that their windows share."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for owner, key, lead, count, body in zip(pdf["cut_id"], pdf["key"], pdf["lead"], pdf["starts"], pdf["body"], strict=True):
                at = 0
                while at < count:
                    group = (lead - at) // starts  # counted from the anchor, so equal windows agree
                    upto = min(count, lead - group * starts + 1)
                    base = lead - group * starts - starts + 1  # where a whole group begins
                    core = body[lead - group * starts : base + length]
                    name = hashlib.blake2b(core, digest_size=8, salt=group.to_bytes(4, "little")).digest()
                    rows.append((owner, at, int.from_bytes(name, "little", signed=True), lead - at, upto - at, body[at : upto - 1 + length]))
                    at = upto
            yield pd.DataFrame(rows, columns=["owner", "first", "key", "lead", "starts", "body"])

    return cuts.select("cut_id", "key", "lead", "starts", "body").mapInPandas(run, _CUT)


def repeated_starts(cuts: DataFrame, length: int, level: int = 0) -> DataFrame:
    """(owner, lo, hi): runs of starts whose window occurs at another start of ``cuts``.

    Equal cuts are one from here on; one that occurs twice is repeated as a whole.
    Cuts of a gram that has only few are sorted in a shard. A gram with more of them
    (a frequent passage in ever other surroundings) is cut finer, each piece keyed by
    the bytes that all its windows share, and goes through the same again; in the last
    round a cut is one window, and equal windows are one cut.
    """
    cut_id = F.unhex(F.md5(F.concat(F.col("body"), F.encode(F.concat_ws(":", F.lit(""), "lead", "starts"), "UTF-8"))))
    named = materialise(cuts.withColumn("cut_id", cut_id), "substring-cuts")
    places = named.select("cut_id", "owner", "first")
    whole = named.groupBy("cut_id").agg(
        *(F.max(c).alias(c) for c in ("key", "lead", "starts")),
        F.max("body").alias("body"),
        (F.min(F.xxhash64("owner", "first")) < F.max(F.xxhash64("owner", "first"))).alias("twice"),
    )
    whole = materialise(whole, "substring-whole")
    found = whole.where("twice").select("cut_id", F.lit(0).alias("lo"), (F.col("starts") - 1).alias("hi"))
    if ROUNDS[level] != 1:
        sizes = broadcast_when_small(materialise(whole.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "substring-sizes"))
        shared = whole.join(sizes, "key")
        few = shared.where(F.col("n") <= TOGETHER)
        size = few.agg(F.sum(F.length("body"))).first()[0]
        if size:
            shards = -(-size // SHARD_BYTES)
            sorted_ = (
                few.select("cut_id", "starts", "body", F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"))
                .groupBy("shard")
                .applyInPandas(lambda pdf: shard_repeats(pdf, length), "cut_id binary, lo int, hi int")
            )
            found = found.union(sorted_)
        many = shared.where(F.col("n") > TOGETHER)
        if not many.isEmpty():
            inner = repeated_starts(_finer(many, length, ROUNDS[level + 1]), length, level + 1)
            found = found.union(inner.withColumnRenamed("owner", "cut_id"))
    found = materialise(found, "substring-found")
    discard(whole)
    runs = places.join(found, "cut_id").select("owner", (F.col("first") + F.col("lo")).alias("lo"), (F.col("first") + F.col("hi")).alias("hi"))
    return runs


def repeated_runs(docs: DataFrame, length: int) -> DataFrame:
    """(owner, runs): per distinct text the runs (lo, hi) of repeated windows."""
    listed = materialise(anchors_of(docs, length), "substring-anchors")
    place = F.xxhash64("owner", "first")
    keys = listed.groupBy("key").agg(F.min(place).alias("p"), F.max(place).alias("q"), F.min("cut").alias("c"), F.max("cut").alias("d"))
    keys = materialise(keys.where("p < q").select("key", (F.col("c") < F.col("d")).alias("mixed")), "substring-keys")
    again = materialise(listed.join(broadcast_when_small(keys), "key").dropDuplicates(["owner", "first"]), "substring-again")
    discard(listed)
    discard(keys)
    # A gram with one cut only needs no bytes: every window of it is repeated.
    plain = again.where(~F.col("mixed")).select("owner", F.col("first").alias("lo"), F.col("last").alias("hi"))
    mixed = again.where("mixed").groupBy("owner").agg(F.collect_list(F.struct("first", "last", "anchor", "key")).alias("runs"))
    texts = docs.select(F.unhex(F.md5("text")).alias("owner"), "text").where(F.length("text") >= length)
    mixed = materialise(mixed, "substring-mixed")
    cuts = _cut_out(texts.join(mixed, "owner"), length)
    runs = plain.union(repeated_starts(cuts, length))
    return runs.groupBy("owner").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))


def without(text: bytes, runs: list, length: int) -> tuple[bytes, int, int]:
    """A text without the bytes of the windows in ``runs``: it, bytes and spans removed."""
    kept, at, removed, spans, end = [], 0, 0, 0, -1
    for lo, hi in sorted((r["lo"], r["hi"]) for r in runs):
        stop = hi + length
        if lo > end:
            kept.append(text[at:lo])
            spans += 1
            removed += stop - lo
            at = end = stop
        elif stop > end:
            removed += stop - end
            at = end = stop
    kept.append(text[at:])
    return b"".join(kept), removed, spans


def remove_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) for every document.

    ``kept`` are the bytes of the text that no string of ``length`` bytes covers which
    also starts anywhere else, in this or another document. Texts are UTF-8 bytes,
    null is empty; matches do not cross documents; all is judged on the input.

    Every window goes where its anchor gram sends it, so equal windows meet. Grams
    that occur once are dropped, and equal cuts are one before any bytes are shuffled.
    Texts that occur twice are removed as a whole if long enough. Null and repeated
    ids and repeated rows are judged and returned row by row. An empty table gives no
    rows. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text)
    if length <= GRAM:
        raise ValueError(f"a string has more than {GRAM} bytes")
    owner = F.unhex(F.md5("text"))
    copies = rows.where(F.length("text") >= length).groupBy(owner.alias("owner")).agg(F.count("*").alias("n"), F.max(F.length("text")).alias("size")).where("n > 1")
    whole = copies.select("owner", F.array(F.struct(F.lit(0).alias("lo"), (F.col("size") - length).cast("int").alias("hi"))).alias("whole"))
    runs = repeated_runs(rows, length).join(whole, "owner", "full").select("owner", F.coalesce("whole", "runs").alias("runs"))
    runs = materialise(runs, "substring-runs")

    def cut(texts: list[bytes], runs: list) -> list:
        done = [without(t, r or [], length) for t, r in zip(texts, runs, strict=True)]
        return [list(map(len, texts)), [d[1] for d in done], [d[2] for d in done], [d[0] for d in done]]

    judged = rows.withColumn("owner", owner).join(runs, "owner", "left").select("doc_id", "text", "runs")
    made = "n_bytes long, n_removed long, n_spans long, kept binary"
    return add_columns(judged, ["text", "runs"], made, cut, drop=("text", "runs"))
