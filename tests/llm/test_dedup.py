import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from carestrata.llm import sentences, simhash, substrings
from carestrata.llm.components import component_roots
from carestrata.llm.queries import op2_suffix_array_dedup, op5_sentence_span_dedup, op6_bit_sliced_simhash
from carestrata.llm.sais import doubled_order, suffix_array

FOLDER = "/root/testdata/sf0.001"


def texts_of(spark):
    return [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]


# Suffix arrays and repeated substrings


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=80), st.integers(1, 3))
def test_suffix_array_sorts_suffixes(symbols, times):
    text = np.array(symbols * times + [0], dtype=np.uint16)
    expected = sorted(range(len(text)), key=lambda i: text[i:].tolist())
    assert suffix_array(text, 5).tolist() == expected
    assert doubled_order(text).tolist() == expected


def brute_repeats(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[p : p + length] for _, t in texts for p in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for p in range(len(t)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_substring_query_equals_brute_force(spark):
    got = sorted((tuple(r) for r in op2_suffix_array_dedup(spark, FOLDER).collect()), key=str)
    assert got == brute_repeats(texts_of(spark), 200)


@pytest.mark.parametrize("together", [256, 1])
def test_frequent_passages_in_ever_other_surroundings(spark, monkeypatch, together):
    monkeypatch.setattr(substrings, "TOGETHER", together)
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 7)))
    passage = " ".join(word() for _ in range(60))
    base = " ".join(word() for _ in range(80))
    rows = []
    for i in range(40):
        rows.append((i, " ".join(word() for _ in range(12)) + passage + " ".join(word() for _ in range(12))))
        at = rng.randrange(len(base))
        rows.append((100 + i, base[:at] + word().upper() + base[at:]))
    rows += [(300, "xyz" * 200), (301, "q" * 260), (302, base), (302, base)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = substrings.remove_repeats(docs, 200).collect()
    found = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in got), key=str)
    assert found == brute_repeats(rows, 200)


def test_substrings_of_awkward_rows(spark, awkward, nothing):
    rows = [tuple(r) for r in awkward.select("doc_id", "text").collect()]
    got = substrings.remove_repeats(awkward, 200).collect()
    found = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in got), key=str)
    assert found == brute_repeats(rows, 200)
    assert substrings.remove_repeats(nothing, 200).collect() == []


# Sentence spans


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab .,!\n", max_size=300))
def test_sentences_join_to_the_text(text):
    assert "".join(sentences.sentences_of(text)) == text


def brute_spans(rows):
    """The text each distinct (id, text) keeps, and how many sentences it loses."""
    where = defaultdict(list)
    for i, t in set(rows):
        words = [w for w in (s.lower().split() for s in sentences.sentences_of(t or "")) if w]
        for a, b in zip(*sentences.runs_of(np.array([len(w) for w in words], dtype=np.int64)), strict=True):
            where[" ".join(w for s in words[a : b + 1] for w in s)].append((i is None, i or 0, t, int(a), int(b)))
    gone = defaultdict(set)
    for found in where.values():
        for none, i, t, a, b in sorted(found)[1:]:
            gone[None if none else i, t] |= set(range(a, b + 1))
    out = {}
    for i, t in set(rows):
        parts = sentences.sentences_of(t) if t is not None else []
        real = [k for k, s in enumerate(parts) if s.strip()]
        bad = {real[k] for k in gone[i, t]}
        out[i, t] = (len(real), len(bad), t if t is None else "".join(s for k, s in enumerate(parts) if k not in bad))
    return out


def test_span_query_equals_brute_force(spark):
    rows = texts_of(spark)
    got = {r["doc_id"]: (r["n_sentences"], r["n_removed"], r["text"]) for r in op5_sentence_span_dedup(spark, FOLDER).collect()}
    expected = brute_spans(rows)
    assert got == {i: v for (i, _), v in expected.items()}
    assert sum(v[1] for v in got.values()) > 0


def test_spans_of_awkward_rows(spark, awkward, nothing):
    expected = brute_spans([tuple(r) for r in awkward.select("doc_id", "text").collect()])
    counts = Counter((r["doc_id"], *expected[r["doc_id"], r["text"]]) for r in awkward.collect())
    got = Counter((r["doc_id"], r["n_sentences"], r["n_removed"], r["text"]) for r in sentences.remove_repeated_spans(awkward).collect())
    assert got == counts
    assert sentences.remove_repeated_spans(nothing).collect() == []


def test_runs_are_long_enough_and_reach_the_end():
    first, last = sentences.runs_of(np.array([30, 1, 1, 10, 12, 3]))
    # The shortest from each piece on are (0, 1), (1, 4), (2, 4), (3, 4); those up to each also (0, 2), (0, 3), (3, 5).
    assert list(zip(first.tolist(), last.tolist(), strict=True)) == [(0, 1), (0, 2), (0, 3), (1, 4), (2, 4), (3, 4), (3, 5)]
    assert len(sentences.runs_of(np.array([5, 5]))[0]) == 0


# SimHash


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\x09\x0a\x0b\x0c\x0d":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def brute_components(rows):
    prints = [brute_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2 and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    least = {}
    for (i, _), g in zip(rows, group, strict=True):
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    return sorted(((i, f"{p:016x}", least[g]) for (i, _), p, g in zip(rows, prints, group, strict=True)), key=str)


def test_simhash_query_equals_brute_force(spark):
    got = sorted((tuple(r) for r in op6_bit_sliced_simhash(spark, FOLDER).collect()), key=str)
    assert got == brute_components(texts_of(spark))


def test_simhash_of_awkward_rows(spark, awkward, nothing):
    rows = [tuple(r) for r in awkward.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in simhash.simhash_components(awkward).collect()), key=str) == brute_components(rows)
    kept = simhash.one_of_each_group(awkward)
    assert kept.columns == awkward.columns
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    assert ids == sorted({str(c) for _, _, c in brute_components(rows)})
    assert simhash.simhash_components(nothing).collect() == []
    assert simhash.one_of_each_group(nothing).collect() == []


@pytest.mark.parametrize("bucket", [256, 2])
@pytest.mark.parametrize("radius", [0, 1, 2])
def test_links_join_what_the_radius_joins(spark, monkeypatch, bucket, radius):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(radius)
    values = {rng.getrandbits(64) for _ in range(30)} | {0, (1 << 63) | 5}
    for v in list(values):
        for _ in range(6):
            v ^= 1 << rng.randrange(64)
            v ^= (1 << rng.randrange(64)) if rng.random() < 0.4 else 0
            values.add(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = dict(tuple(r) for r in simhash._roots(fps, radius).collect())
    group = {v: v for v in signed}
    changed = True
    near = {v: [w for w in signed if ((v ^ w) & (2**64 - 1)).bit_count() <= radius] for v in signed}
    while changed:
        low = {v: min(group[w] for w in near[v]) for v in signed}
        changed = low != group
        group = low
    assert roots == group


def test_bit_sliced_distances():
    rng = np.random.default_rng(1)
    values = np.sort(rng.integers(0, 2**63, 300, dtype=np.uint64))
    values[50:200] = values[50] ^ (np.uint64(1) << rng.integers(0, 64, 150).astype(np.uint64))
    keys = np.repeat([1, 2, 3], [100, 150, 50])
    for radius in (0, 1, 2):
        a, b = simhash.linked(keys, values, radius)
        expected = {(i, j) for i in range(300) for j in range(i + 1, 300) if keys[i] == keys[j] and int(values[i] ^ values[j]).bit_count() <= radius}
        assert set(zip(a.tolist(), b.tolist(), strict=True)) == expected


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(7, 200 + i) for i in range(30)] + [(230, 231)]
    edges = spark.createDataFrame([*path, *star, (5, 5)], "a long, b long")
    roots = dict(tuple(r) for r in component_roots(edges).collect())
    assert {roots[i] for i in range(100, 141)} == {100}
    assert {roots[200 + i] for i in range(30)} == {7} and roots[231] == 230
