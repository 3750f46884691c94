from collections import Counter, defaultdict

from pyspark.sql import functions as F
from .test_packing import check_pieces
from .test_scoring_mixing import brute_spans
from .test_shingles import brute_kept

import __spark_entry__ as driver
import corpus_pipeline
from carestrata.llm.queries import llm_queries
from carestrata.runtime import materialise

FOLDER = "/root/testdata/sf0.01"


def test_every_query_is_registered():
    names = {f"op{n}_" for n in range(1, 14)}
    assert {n.split("_")[0] + "_" for n in llm_queries()} == names
    assert set(llm_queries()) | {"pipeline"} <= set(driver.queries())


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "simhash", "secrets", "mixing", "packing"]

    scored = llm_queries()["op4_nnpu_toxicity"](spark, FOLDER).where("predicted = 0")
    kept = materialise(stages["toxicity"](spark, docs, FOLDER), "t")
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in scored.collect()}

    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    single = materialise(stages["simhash"](spark, kept, FOLDER), "s")
    assert sorted(str(r["doc_id"]) for r in single.collect()) == brute_kept(rows)

    clean = materialise(stages["secrets"](spark, single, FOLDER), "c")
    before = {r["doc_id"]: r["text"] for r in single.collect()}
    for r in clean.collect():
        base, added = brute_spans(before[r["doc_id"]])
        assert (r["text"] == before[r["doc_id"]]) == (not base + added)
        assert r["n_chars"] == len(r["text"]) and brute_spans(r["text"])[0] == []

    mix = materialise(stages["mixing"](spark, clean, FOLDER), "m")
    times = Counter(r["doc_id"] for r in mix.collect())
    assert max(times.values()) == 2
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    longest = clean.agg(F.max(words)).first()[0]
    have = {r["source"]: r["n"] for r in clean.groupBy("source").agg(F.sum(words).alias("n")).collect()}
    got = defaultdict(int, {r["source"]: r["n"] for r in mix.groupBy("source").agg(F.sum(words).alias("n")).collect()})
    from carestrata.llm.mixing import capped_targets

    names = sorted(have)
    for name, target in zip(names, capped_targets([have[n] for n in names], 1.5 * sum(have.values()), 2.0), strict=True):
        assert abs(got[name] - target) <= longest / 2 + 1

    pieces = stages["packing"](spark, mix, FOLDER).withColumn("ids_crc32", F.crc32("ids")).collect()
    check_pieces(pieces, [(r["doc_id"], r["text"]) for r in mix.collect()])


def test_stages_keep_awkward_columns(spark, awkward, nothing):
    for rows in (awkward, nothing):
        docs = rows
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = materialise(stage(spark, docs, FOLDER), name)
            assert docs.columns == awkward.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() >= docs.count()


def test_stages_keep_columns_of_helper_names(spark):
    """Columns named like those that stages make for themselves come back with their own values."""
    names = ["_row", "_hi", "_lo", "_toxicity", "_source", "_size", "_key", "_times", "_base", "_added", "_TAKEN", "kept0"]
    docs = spark.createDataFrame(
        [(i, f"word {i} token=abcdefgh12345678", "s", 9, *[f"{n}{i}" for n in names]) for i in range(3)],
        ", ".join(["doc_id long", "text string", "source string", "n_chars long", *[f"{n} string" for n in names]]),
    )
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns, name
        assert {r["doc_id"]: [r[n] for n in names] for r in out.collect()} == {i: [f"{n}{i}" for n in names] for i in range(3)}, name
