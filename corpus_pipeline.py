"""The training-data pipeline: documents in, packed token sequences out.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it
kept; :func:`run` writes each result to the shared folder and reads it again. All but
the last return the columns of ``docs``, whatever they are; columns of their own are
underscored and dropped.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata.llm.mixing import measured, mixing_plan, with_taken
from carestrata.llm.packing import packed_sequences
from carestrata.llm.queries import tokenizer_path
from carestrata.llm.secrets import redacted
from carestrata.llm.shingles import one_of_each_near_copy
from carestrata.llm.toxicity import fit_toxicity, score_toxicity
from carestrata.runtime import materialise, read_table

#: Score from which a document is rejected as toxic.
TOXIC = 0.7


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``TOXIC``; null and empty texts stay."""
    model = fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model, score_col="_toxicity").where(F.col("_toxicity") < TOXIC).select(docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near-duplicates.

    SimHash fingerprints of five-word shingles are compared in bit-sliced form and what
    lies within 2 bits is linked, if the shingles confirm a similarity of 0.8. Documents
    that share that much but have fingerprints further apart are linked as well, all of
    them. Rows that repeat that id stand for one document: one of them stays. A group of null ids only keeps one of its rows.
    """
    return one_of_each_near_copy(docs, words=5)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, secrets in its text replaced by a mark and ``n_chars`` counted anew."""
    clean = redacted(docs, text_col="text")
    if "n_chars" in clean.columns:
        clean = clean.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return clean.select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it is taken, none beyond twice.

    What the plan takes of a document in part (at most one document per source but for
    repeats of a row) counts as taken if it is at least half of it. Documents without
    words stay once: they take no room.
    """
    units = materialise(measured(docs).select("_source", "_size", "_key"), "mix-units")
    taken = with_taken(measured(docs), mixing_plan(units))
    times = F.when(F.col("_size") > 0, F.round(F.col("_taken") / F.col("_size"))).otherwise(F.lit(1)).cast("int")
    return taken.withColumn("_times", F.explode(F.array_repeat(F.lit(1), times))).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of 4096, with their ids."""
    return packed_sequences(docs, tokenizer_path(), room=4096, end_id=2)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def whatever_names(stage: Stage) -> Stage:
    """A stage for documents of any columns: names like the helpers' are put aside meanwhile."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        taken, aside = {c.lower() for c in docs.columns}, {}
        for name in (c for c in docs.columns if c.startswith("_")):
            free = next(f"kept{i}" for i in count() if f"kept{i}" not in taken)
            aside[name] = free
            taken.add(free)
        plain = docs.toDF(*[aside.get(c, c) for c in docs.columns])
        return stage(spark, plain, sf_dir).select(plain.columns).toDF(*docs.columns)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", whatever_names(reject_toxic)),
    ("simhash", whatever_names(keep_one_of_each_group)),
    ("secrets", whatever_names(redact_secrets)),
    ("mixing", whatever_names(mix_sources)),
    ("packing", pack_sequences),
]

#: SQL cannot express a trained classifier, near copies or tokenisation.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
