"""Documents packed into token sequences: first-fit decreasing in random groups."""

from __future__ import annotations

import os
import sys
from itertools import product
from string import ascii_lowercase, punctuation
from types import ModuleType
from typing import TYPE_CHECKING

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestrata.llm.rows import add_columns

if TYPE_CHECKING:
    from tokenizers import Tokenizer

#: Documents of a group, on average.
GROUP_DOCS = 2048

#: Words whose ids a Python worker remembers, and as many without punctuation.
MOST_WORDS = 150_000

MARKS = punctuation.encode()


class WordIds:
    """Token ids of texts as bytes, made from those of their words.

    For tokenizers that drop white space and join nothing across it, a text's ids are
    those of its words in turn, so each word is encoded once while it is remembered
    (about ``most`` words, and as many without punctuation; beyond that those of the
    texts at hand stay). Others encode whole texts.
    """

    def __init__(self, path: str, most: int = MOST_WORDS):
        # Spark runs a worker per core; threads of their own would only hold memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 65_536 else "<u4")
        self.words: dict[bytes, bytes] = {}
        self.plain: dict[bytes, bytes | None] = {}
        self.by_word = self._ids("Aa bb") == self._ids("Aa") + self._ids("bb")
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        if suffix:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        # A word may be taken apart from its case and its punctuation only where the
        # tokenizer does so itself.
        parts = [punctuation, *punctuation]
        self.units = bool(
            self.ends.any()
            and self._ids("AbC") == self._ids("abc")
            and all(self._ids("ab" + p) == self._ids("ab") + self._ids(p) for p in parts)
        )
        # Words of a to z need neither normalising nor splitting by patterns where the
        # model alone gives the same, which half of the time goes to otherwise.
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = WhitespaceSplit()
        probe = " ".join([*map("".join, product(ascii_lowercase, repeat=2)), ascii_lowercase * 9])
        if self._ids(probe, self.letters) != self._ids(probe):
            self.letters = self.tokenizer

    @classmethod
    def of_worker(cls, path: str) -> WordIds:
        """The one of this Python process, which Spark keeps from task to task."""
        kept = sys.modules.setdefault("_carestrata_word_ids", ModuleType("_carestrata_word_ids")).__dict__
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def _ids(self, text: str, tokenizer: Tokenizer | None = None) -> bytes:
        return np.array((tokenizer or self.tokenizer).encode(text, add_special_tokens=False).ids, dtype=self.kind).tobytes()

    def texts(self, texts: list[bytes]) -> list[bytes]:
        """Ids of whole texts, which are split at ASCII white space only."""
        if not self.by_word:
            return [self._ids(t.decode("utf-8", "replace")) for t in texts]
        split = [t.split() for t in texts]
        met: set[bytes] = set()
        for words in split:
            met.update(words)
        if len(self.words) > self.most:
            self.words = {w: self.words[w] for w in met.intersection(self.words)}
        self._learn(list(met.difference(self.words)))
        ids = self.words.__getitem__
        return [b"".join(map(ids, words)) for words in split]

    def _learn(self, new: list[bytes]) -> None:
        """Encodes new words: letters without the punctuation after them, many at a time."""
        if not self.units:
            self.words.update((w, self._ids(w.decode("utf-8", "replace"))) for w in new)
            return
        # Of bytes, so that only ASCII letters change here, and only those are letters.
        heads = [w.rstrip(MARKS).lower() for w in new]
        met = set(heads)
        if len(self.plain) > self.most:
            self.plain = {h: self.plain[h] for h in met.intersection(self.plain)}
        unknown = met.difference(self.plain)
        self._learn_plain([h for h in unknown if h.isalpha()], self.letters)
        others = [h for h in unknown if not h.isalpha()]
        letters = {h for h in others if not h.isascii() and h.decode("utf-8", "replace").isalpha()}
        self._learn_plain(list(letters), self.tokenizer)
        plain, words = self.plain, self.words
        # Whatever is more than letters and the punctuation after them is encoded whole.
        plain.update((h, None) for h in others if h not in letters)
        for word, head in zip(new, heads, strict=True):
            ids = plain[head]
            if ids is None:
                ids = self._ids(word.decode("utf-8", "replace"))
            elif len(head) < len(word):
                tail = word[len(head) :]
                if tail not in plain:
                    plain[tail] = self._ids(tail.decode())
                ids += plain[tail]
            words[word] = ids

    def _learn_plain(self, heads: list[bytes], tokenizer: Tokenizer) -> None:
        """Words of letters only are one unit each, whose last token ends a word."""
        if not heads:
            return
        lines = [b" ".join(heads[i : i + 64]).decode() for i in range(0, len(heads), 64)]
        found = tokenizer.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.array([i for line in found for i in line.ids], dtype=self.kind)
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(heads):
            self.plain.update((h, self._ids(h.decode())) for h in heads)
            return
        raw, at = ids.tobytes(), 0
        for head, stop in zip(heads, (stops * self.kind.itemsize).tolist(), strict=True):
            self.plain[head] = raw[at:stop]
            at = stop


def tokenised(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Columns ``doc``, ``part`` (input partition), ``width`` (bytes of an id) and ``ids``."""

    def compute(texts: list[bytes]) -> list:
        words = WordIds.of_worker(tokenizer_path)
        end = np.array([end_id], dtype=words.kind).tobytes()
        ids = [i + end for at in range(0, len(texts), 256) for i in words.texts(texts[at : at + 256])]
        return [[words.kind.itemsize] * len(ids), ids]

    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.spark_partition_id().alias("part"), text)
    return add_columns(rows, ["text"], "width int, ids binary", compute, drop=("text",))


def first_fit(sizes: np.ndarray, room: int) -> list[list[int]]:
    """Bins of positions in ``sizes`` (falling, at most ``room``), by first fit.

    A tournament tree holds the largest room left below each inner node, so the
    first bin that fits is found on the way down from the root.
    """
    width = 1 << max(0, int(len(sizes) - 1).bit_length())
    tree = [room] * (2 * width)
    bins: list[list[int]] = []
    for i, size in enumerate(sizes.tolist()):
        node = 1
        while node < width:
            node *= 2
            if tree[node] < size:
                node += 1
        at = node - width
        if at == len(bins):
            bins.append([])
        bins[at].append(i)
        tree[node] -= size
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
    return bins


def pack_group(lengths: np.ndarray, room: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of a group's documents.

    Whole multiples of ``room`` are cut off first and the rests packed. As many of
    the fullest bins as the rests can fill are then topped up to ``room`` by cutting
    the pieces of the others. What is left is shorter than one sequence and goes to
    sequences whose lengths are powers of two, which need no padding.
    """
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    for d in np.flatnonzero(lengths >= room):
        for start in range(0, int(lengths[d]) // room * room, room):
            pieces.append((int(d), start, room, sequence, 0))
            sequence += 1
    rest = lengths % room
    order = np.argsort(-rest, kind="stable")
    order = order[rest[order] > 0]
    if not len(order):
        return pieces
    bins = first_fit(rest[order], room)
    fill = np.array([int(rest[order[b]].sum()) for b in bins])
    by_fill = np.argsort(-fill, kind="stable")
    full = int(fill.sum()) // room
    loose = [[int(order[i]), int(lengths[order[i]] - rest[order[i]]), int(rest[order[i]])] for b in by_fill[full:] for i in bins[b]]
    loose.reverse()

    def pour(offset: int, want: int) -> None:
        """Moves ``want`` tokens of the loose pieces into the current sequence."""
        while want:
            doc, start, length = loose[-1]
            take = min(want, length)
            pieces.append((doc, start, take, sequence, offset))
            offset, want = offset + take, want - take
            if take == length:
                loose.pop()
            else:
                loose[-1] = [doc, start + take, length - take]

    for b in by_fill[:full]:
        offset = 0
        for i in bins[b]:
            d, r = int(order[i]), int(rest[order[i]])
            pieces.append((d, int(lengths[d]) - r, r, sequence, offset))
            offset += r
        pour(offset, room - offset)
        sequence += 1
    left = sum(piece[2] for piece in loose)
    while left:
        power = 1 << (left.bit_length() - 1)
        pour(0, power)
        sequence, left = sequence + 1, left - power
    return pieces


def packed_sequences(
    docs: DataFrame, tokenizer_path: str, room: int = 4096, end_id: int = 2, seed: int = 17, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every token of every document in exactly one piece of one sequence.

    Returns (doc_id, start, length, ids, doc_tokens, sequence_id, offset), where
    ``ids`` holds the piece's tokens as little-endian unsigned 32-bit numbers. A
    document's tokens are its text's and ``end_id``. Documents are dealt into random
    groups of about ``GROUP_DOCS`` (a hash of id and input partition, so that rows
    repeated in many partitions do not meet in one group); each group is packed on
    its own by first-fit decreasing and leaves no sequence that needs padding.

    A null or empty text is the end token alone. Null and repeated ids are packed
    row by row like any other. An empty table gives no pieces. Other columns are not
    read. Texts of any length are cut at multiples of ``room``.
    """
    groups = max(1, -(-docs.count() // GROUP_DOCS))
    rows = tokenised(docs, tokenizer_path, end_id, id_col, text_col)
    group = F.pmod(F.xxhash64(F.lit(seed), "doc", "part"), F.lit(groups)).alias("group")

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc", "ids"], kind="stable", na_position="last")
        kind = np.dtype("<u2" if int(pdf["width"].iloc[0]) == 2 else "<u4")
        ids = [np.frombuffer(b, kind) for b in pdf["ids"]]
        lengths = np.array([len(a) for a in ids], dtype=np.int64)
        pieces = pack_group(lengths, room)
        doc = pdf["doc"].to_numpy()
        columns = list(zip(*pieces, strict=True))
        owner = np.array(columns[0])
        return pd.DataFrame(
            {
                "doc_id": doc[owner],
                "start": columns[1],
                "length": columns[2],
                "ids": [ids[d][s : s + n].astype("<u4").tobytes() for d, s, n, _, _ in pieces],
                "doc_tokens": lengths[owner],
                "sequence_id": np.array(columns[3], dtype=np.int64) + (int(pdf["group"].iloc[0]) << 32),
                "offset": columns[4],
            }
        )

    # Ids go through pandas as text, which has room for null and for all longs.
    pieces = (
        rows.select("*", group)
        .withColumn("doc", F.col("doc").cast("string"))
        .groupBy("group")
        .applyInPandas(
            pack,
            "doc_id string, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
        )
    )
    return pieces.withColumn("doc_id", F.col("doc_id").cast("long"))
