import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from carestrata.llm import secrets

KEY = "Zk8Qv3Xn7Lw2Rt9Ym4Pb6"
HEX = "0123456789abcdef"
TEXTS = [
    f"deploykey-{HEX}-{KEY}",
    f"é {KEY}_{HEX}_{KEY[::-1]} and on",
    f"{KEY}{HEX}",
    f"https//host/sample/{KEY}Hd5Js1",
    f"{KEY}Hd5Js1/path/of/example/data",
    f"{KEY}Hd5Js1example{KEY[::-1]}Gf4",
    "an/example9/of/the/path/of/words/1",
    "Zk8Qv3Xexample7Lw2Rt",
    f"password={KEY}",
    f"token={KEY}/{HEX}+{KEY}",
    f"x{HEX}y{HEX}z",
]


def brute_added(text):
    """Entropy spans window by window."""
    base = [(m.start(), m.end()) for m in re.finditer(f"[0-9a-f]{{{secrets.HEX_LEAST},}}|AKIA[A-Z0-9]{{14,}}", text)]
    base += [(m.start(), m.end()) for m in re.finditer(secrets.ASSIGN, text) if len(m[2]) >= secrets.ASSIGN_LEAST]
    out = []
    for m in re.finditer(secrets.CANDIDATE, text):
        run = m[0]
        if any(re.search(p, run) for p in secrets.ALLOWED):
            continue
        _, alphabet, bits = next(c for c in secrets.CLASSES if re.search(c[0], run))
        own = run.lower() if alphabet == alphabet.lower() else run
        pieces = {}
        for i in range(len(own) - secrets.WINDOW + 1):
            a, b = m.start() + i, m.start() + i + secrets.WINDOW
            counts = Counter(own[i : i + secrets.WINDOW]).values()
            high = math.log2(secrets.WINDOW) - sum(c * math.log2(c) for c in counts) / secrets.WINDOW >= bits - 1e-6
            if high and not any(s < b and a < e for s, e in base) and not re.search(secrets.SAMPLES, text[a:b]):
                pieces.setdefault(sum(e <= a for _, e in base), []).append((a, b))
        for hits in pieces.values():
            first, last = hits[0][0], hits[-1][1]
            for w in re.finditer(secrets.SAMPLES, run):
                s, e = m.start() + w.start(), m.start() + w.end()
                first, last = s if s < first < e else first, e if s < last < e else last
            out.append((first, last))
    return sorted(out)


def test_pieces_outside_base_spans_and_sample_words(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    for r in secrets.secret_scan(docs).collect():
        got = [tuple(map(int, s.split(":")[1:])) for s in r["spans"].split(",") if s.startswith("entropy")]
        assert sorted(got) == brute_added(TEXTS[r["doc_id"]]), TEXTS[r["doc_id"]]
    assert sum(len(brute_added(t)) for t in TEXTS) == 6


@pytest.mark.parametrize("text", TEXTS[:6])
def test_no_key_is_left_in_clear(spark, text):
    got = secrets.redacted(spark.createDataFrame([(text,)], "text string")).first()[0]
    assert KEY[3:] not in got and KEY[::-1][:-3] not in got


def test_samples_stay(spark):
    docs = spark.createDataFrame([(t,) for t in TEXTS[6:8]], "text string")
    assert sorted(r[0] for r in secrets.redacted(docs).where(F.lit(True)).collect()) == sorted(TEXTS[6:8])


def test_long_runs_of_every_kind(spark):
    """A megabyte of words and separators, rulers, letters and keys: no pattern recurses per repeat."""
    n = 1_000_000
    runs = ["ab-" * (n // 3), "a/b" * (n // 3), "=-" * (n // 2), "z" * n, "/" + "word_" * (n // 5) + "x", "password=" + "ab-" * (n // 3), "0f" * (n // 2)]
    docs = spark.createDataFrame(list(enumerate(runs)), "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: r["spans"] for r in secrets.secret_scan(docs).collect()}
    assert got == {0: "", 1: "", 2: "", 3: "", 4: "", 5: f"assign:0:{len(runs[5])}", 6: f"hex:0:{n}"}


def test_a_long_run_of_keys_is_found(spark):
    run = "".join(KEY[i % 21 :] + KEY[: i % 21] for i in range(5000))
    docs = spark.createDataFrame([(1, run)], "doc_id long, text string").repartition(1)
    assert secrets.secret_scan(docs).first()["spans"] == f"entropy:0:{len(run)}"


@pytest.mark.parametrize("run", ["ab-cd-ef", "/ab/cd", "ab--cd", "//ab/cd", "-ab-cd", "ab", "/ab", "ab-", "a" * 20 + "-b", "a" * 19 + "-b", "ab-" + "c" * 20, "/ab//", "ab/", "=+=", "a1-b2"])
def test_allowed_paths_of_words(spark, run):
    plain = re.fullmatch(r"[-_=+/]+|/?([A-Za-z]{1,19}[-_/=+])+[A-Za-z]{0,19}", run) is not None
    df = spark.createDataFrame([(run,)], "run string")
    assert df.select(F.col("run").rlike("|".join(f"(?:{p})" for p in secrets.ALLOWED))).first()[0] == plain


def test_helper_names_of_documents_stay(spark):
    docs = spark.createDataFrame([(1, f"token={KEY}", "b", 5, "h")], "doc_id long, text string, _base string, _ADDED int, added_ string")
    assert secrets.redacted(docs).first() == (1, "[secret]", "b", 5, "h")
