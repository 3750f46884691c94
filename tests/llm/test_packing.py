import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from carestrata import runtime
from carestrata.llm.packing import WordIds, first_fit, pack_group, packed_sequences
from carestrata.llm.queries import op3_tournament_packing, tokenizer_path
from carestrata.llm.rows import add_columns

FOLDER = "/root/testdata/sf0.001"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=60))
def test_first_fit_is_first_fit(sizes):
    sizes = sorted(sizes, reverse=True)
    bins, left = [], []
    for i, s in enumerate(sizes):
        at = next((b for b, r in enumerate(left) if r >= s), None)
        if at is None:
            bins.append([]), left.append(40)
            at = len(bins) - 1
        bins[at].append(i)
        left[at] -= s
    assert first_fit(np.array(sizes), 40) == bins


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=40))
def test_pieces_partition_documents_without_padding(lengths):
    lengths = np.array(lengths, dtype=np.int64)
    pieces = pack_group(lengths, 64)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for d, start, n, sequence, offset in pieces:
        assert n > 0
        by_doc[d].append((start, n))
        by_sequence[sequence].append((offset, n))
    for d, total in enumerate(lengths):
        at = 0
        for start, n in sorted(by_doc[d]):
            assert start == at
            at += n
        assert at == total
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 64 and at & (at - 1) == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_words_give_the_ids_of_whole_texts(name):
    import public_tokenizers

    path = public_tokenizers.path(name)
    whole, words = Tokenizer.from_file(path), WordIds(path)
    texts = [
        "İstanbul, ΣΑΣ. don't it's 'S we'LL", "a b c \x1cd\x85e", "<|endoftext|> x<|startoftext|>y", "", "  ",
        "étude ́x ﬁn Ǆ", "数学 12345 a1b2... !!a ...b c'd", "KK İı", "𝒳𝒴 ok,.;ok", "Word, word. WORD; word:word?! a.b",
    ]
    got = [np.frombuffer(b, words.kind).tolist() for b in words.texts([t.encode() for t in texts])]
    assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def check_pieces(pieces, texts):
    """Pieces against direct tokenisation; ``texts`` are (id, text) rows."""
    whole = Tokenizer.from_file(tokenizer_path())
    wanted = defaultdict(int)
    for i, t in texts:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 2]
        wanted[i, len(ids)] += len(ids)
        for r in pieces:
            if len(texts) < 300 and r["doc_id"] == i and r["doc_tokens"] == len(ids) and sum(x[0] == i for x in texts) == 1:
                part = np.array(ids[r["start"] : r["start"] + r["length"]], dtype="<u4").tobytes()
                assert r["ids_crc32"] == zlib.crc32(part)
    got, room = defaultdict(int), defaultdict(list)
    for r in pieces:
        got[r["doc_id"], r["doc_tokens"]] += r["length"]
        room[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == wanted
    for parts in room.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 4096 and at & (at - 1) == 0


def test_query_round_trip(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    check_pieces(op3_tournament_packing(spark, FOLDER).collect(), [tuple(r) for r in docs])


def test_awkward_rows(spark, awkward, nothing):
    from pyspark.sql import functions as F

    pieces = packed_sequences(awkward, tokenizer_path()).withColumn("ids_crc32", F.crc32("ids"))
    check_pieces(pieces.collect(), [tuple(r) for r in awkward.select("doc_id", "text").collect()])
    assert packed_sequences(nothing, tokenizer_path()).collect() == []


@pytest.mark.parametrize("lower", [False, True])
def test_words_of_other_tokenizers(tmp_path, lower):
    """A tokenizer that keeps case, or does not split punctuation, is never given words taken apart."""
    from tokenizers import models, normalizers, pre_tokenizers

    vocabulary = {t: i for i, t in enumerate(["a</w>", "b</w>", "a", "b", "A", "H", "i", "i</w>", ",", ",</w>", "B", "H</w>", "A</w>"])}
    made = Tokenizer(models.BPE(vocab=vocabulary, merges=[], end_of_word_suffix="</w>"))
    made.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    if lower:
        made.normalizer = normalizers.Lowercase()
    path = f"{tmp_path}/t.json"
    made.save(path)
    words = WordIds(path)
    for text in ("Aa bb", "Hi, ab", "a,b Ab,"):
        ids = np.frombuffer(words.texts([text.encode()])[0], words.kind).tolist()
        assert ids == made.encode(text, add_special_tokens=False).ids, text


def test_texts_go_to_python_in_batches_of_bounded_bytes(spark):
    key = runtime._BYTES_PER_BATCH
    before = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        docs = spark.range(1200, numPartitions=1).select(F.col("id").alias("doc_id"), F.expr("repeat('ab ', 5000)").alias("text"))
        sizes = add_columns(docs, ["text"], "n int", lambda texts: [[len(texts)] * len(texts)]).select("n").distinct()
        assert max(r[0] for r in sizes.collect()) <= runtime.BYTES_PER_BATCH // 15_000 + 1
        # What the session itself sets stays.
        spark.conf.set(key, "9000000")
        add_columns(docs, ["text"], "n int", lambda texts: [[0] * len(texts)])
        assert spark.conf.get(key) == "9000000"
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_remembered_words_stay_small():
    """A worker keeps tens of MB of ids at most, however many words there are."""
    words, most = WordIds(tokenizer_path()), 0
    for at in range(0, 400_000, 20_000):
        words.texts([b" ".join(b"w" + bytes(49 + c for c in b"%d" % i) + b"," for i in range(at, at + 20_000))])
        kept = [words.words, words.plain]
        most = max(most, sum(map(len, kept)))
    assert most < 400_000


def test_words_at_hand_are_not_encoded_again():
    words, text = WordIds(tokenizer_path(), most=10), b"Some words, more than ten: they stay as long as texts bring them again. AND again!"
    first = words.texts([text])
    words.tokenizer = words.letters = None
    assert words.texts([text]) == first


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_letters_alone_take_the_model_alone_where_it_gives_the_same(name):
    import public_tokenizers

    words = WordIds(public_tokenizers.path(name))
    assert (words.letters is words.tokenizer) == (name != "word_bpe_49k.json")
    texts = ["THE the The, tHE. café CAFÉ, Café ẖ H̱ don't <|endoftext|> ***  a1 K 'tis it's,", "zzzz qqq!! " * 3]
    got = [np.frombuffer(b, words.kind).tolist() for b in words.texts([t.encode() for t in texts])]
    assert got == [words.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
