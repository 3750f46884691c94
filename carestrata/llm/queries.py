"""The registered queries of the subpackage over a folder of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata.llm.ann import vp_neighbours
from carestrata.llm.collocations import collocations
from carestrata.llm.dialogues import damaged, repair_report
from carestrata.llm.mixing import mixed
from carestrata.llm.packing import packed_sequences
from carestrata.llm.quality import quality_scores
from carestrata.llm.secrets import secret_scan
from carestrata.llm.sentences import remove_repeated_spans
from carestrata.llm.simhash import simhash_components
from carestrata.llm.substrings import remove_repeats
from carestrata.llm.topk import norm_bucketed_top
from carestrata.llm.toxicity import toxicity_scores
from carestrata.llm.urls import judged_urls
from carestrata.runtime import read_table

Query = Callable[[SparkSession, str], DataFrame]

#: Rules for the pages.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Vocabulary file of the packed sequences, in the package that brings it.
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_vp_tree_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest of every twentieth vector."""
    return vp_neighbours(read_table(spark, folder, "embeddings"), F.col("id") % 20 == 0, k=20, factor=1.0)


def op2_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without strings of 200 bytes that occur twice."""
    kept = remove_repeats(read_table(spark, folder, "documents"), length=200)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_tournament_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document in sequences of 4096 tokens."""
    pieces = packed_sequences(read_table(spark, folder, "documents"), tokenizer_path(), room=4096, end_id=2)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_nnpu_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of every document."""
    return toxicity_scores(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def op5_sentence_span_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the passages that an earlier one has."""
    kept = remove_repeated_spans(read_table(spark, folder, "documents"))
    return kept.withColumn("kept_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))


def op6_bit_sliced_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    return simhash_components(read_table(spark, folder, "documents"), words=3, radius=2)


def op7_qda_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The quality of every document."""
    return quality_scores(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def op8_min_cost_flow_mix(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixed(read_table(spark, folder, "documents"), share=1.5, epochs=2)


def op9_norm_bucketed_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The 5 highest integer products of every fiftieth vector."""
    return norm_bucketed_top(read_table(spark, folder, "embeddings"), F.col("id") % 50 == 0, k=5)


def op10_entropy_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The secrets of every document."""
    return secret_scan(read_table(spark, folder, "documents"))


def op11_son_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The first 2000 phrases of every language."""
    return collocations(read_table(spark, folder, "documents"), support=10, longest=3, percent=50, top=2000)


def op12_markov_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on every page's URL."""
    return judged_urls(read_table(spark, folder, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op13_rank_convergence_repair(spark: SparkSession, folder: str) -> DataFrame:
    """The cheapest repair of every conversation, damaged first."""
    rows = read_table(spark, folder, "conversations")
    return repair_report(damaged(rows), ids=rows)


def llm_queries() -> dict[str, Query]:
    """All registered queries of the subpackage but the pipeline."""
    return {
        f.__name__: f
        for f in (
            op1_vp_tree_search,
            op2_suffix_array_dedup,
            op3_tournament_packing,
            op4_nnpu_toxicity,
            op5_sentence_span_dedup,
            op6_bit_sliced_simhash,
            op7_qda_quality,
            op8_min_cost_flow_mix,
            op9_norm_bucketed_top_k,
            op10_entropy_secret_scan,
            op11_son_collocations,
            op12_markov_url_filter,
            op13_rank_convergence_repair,
        )
    }
