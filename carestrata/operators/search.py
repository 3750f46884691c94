"""Search of many terms at once, by postings of short character grams.

One term against a vocabulary is a scan. A table of terms would be a scan per term or
every pair of term and name; here names are looked up by grams of up to three
characters: each term picks its rarest grams, the names that hold all of them are its
candidates, and the substring rule confirms them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carestrata.operators.vocab import FEW_HITS, TOP_NAMES, TOP_SYNONYMS, _SHOWN, is_valid_standard
from carestrata.runtime import broadcast_bounded, materialise

#: Length of a gram, and how many of a term's grams are looked up.
GRAM, RAREST = 3, 2


def grams(text: Column, sizes: Column) -> Column:
    """The distinct substrings of ``text`` of the given lengths; that of length 0 is the empty text."""

    def of_size(n: Column) -> Column:
        last = F.length(text) - n + 1
        starts = F.when(n == 0, F.array(F.lit(1))).when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.expr("array()"))
        return F.transform(starts, lambda i: F.substring(text, i, n))

    return F.array_distinct(F.flatten(F.transform(sizes, of_size)))


def _term_grams(terms: DataFrame) -> DataFrame:
    """(low, gram) of every distinct term in lower case; a term shorter than a gram is its own."""
    size = F.least(F.length("low"), F.lit(GRAM))
    return terms.select("low").distinct().select("low", F.explode(grams(F.col("low"), F.array(size))).alias("gram"))


def names_of_terms(names: DataFrame, terms: DataFrame) -> DataFrame:
    """Pairs of ``names`` (node, name) and ``terms`` (low) where the lower-cased name holds the term.

    Only grams that some term has are posted. A term looks up its ``RAREST`` grams that
    the fewest names hold, so a gram of a third of all names is looked up only by terms
    that have no rarer one; what meets is a posting per name and looked-up gram. A term
    with a gram that no name holds finds nothing and is left out at once.
    """
    wanted = materialise(_term_grams(terms), "term-grams")
    in_use = broadcast_bounded(wanted.select("gram").distinct(), "grams-in-use")
    lengths = F.array(*[F.lit(n) for n in range(GRAM + 1)])
    posted = names.filter("name is not null").select("node", F.explode(grams(F.lower("name"), lengths)).alias("gram"))
    posted = materialise(posted.join(in_use, "gram", "left_semi"), "postings")
    often = posted.groupBy("gram").agg(F.count(F.lit(1)).alias("n_names"))
    known = wanted.join(often, "gram", "left")
    lost = known.groupBy("low").agg(F.count(F.when(F.col("n_names").isNull(), 1)).alias("lost"))
    order = Window.partitionBy("low").orderBy("n_names", "gram")
    rarest = (
        known.join(lost.filter("lost = 0"), "low", "left_semi")
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= RAREST)
        .withColumn("looked_up", F.count(F.lit(1)).over(Window.partitionBy("low")))
        .select("low", "gram", "looked_up")
    )
    met = posted.join(broadcast_bounded(rarest, "rarest-grams"), "gram").groupBy("low", "node")
    held = met.agg(F.count(F.lit(1)).alias("n"), F.first("looked_up").alias("looked_up")).filter("n = looked_up")
    return held.select("low", "node").join(names, "node").filter(F.contains(F.lower("name"), F.col("low")))


def search_concepts_batch(concept: DataFrame, synonym: DataFrame, terms: DataFrame) -> DataFrame:
    """(term_id, position, concept columns): :func:`vocab.search_concepts` for every row of ``terms``.

    ``terms`` has ``term_id``, ``term`` and ``domain_id`` (null: every domain); ids are
    unique. Names come first, exact ones before shorter ones, at most ``TOP_NAMES``; a
    term with fewer than ``FEW_HITS`` of them gets up to ``TOP_SYNONYMS`` by synonyms as
    well. Null terms find nothing, empty ones the shortest names. Ranks are cut below
    the shuffle, so a term that hits a third of the vocabulary sends a few rows a task.
    """
    asked = materialise(terms.select("term_id", F.lower("term").alias("low"), F.col("domain_id").alias("_domain")).filter("low is not null"), "terms")
    valid = concept.filter(is_valid_standard()).select(_SHOWN)
    in_domain = F.col("_domain").isNull() | (F.col("_domain") == F.col("domain_id"))

    found = names_of_terms(valid.select(F.col("concept_id").alias("node"), F.col("concept_name").alias("name")), asked)
    by_name = found.select("low", F.col("node").alias("concept_id")).join(valid, "concept_id")
    exact = F.when(F.lower("concept_name") == F.col("low"), 0).otherwise(1)
    rank = Window.partitionBy("term_id").orderBy(exact, F.length("concept_name"), "concept_name", "concept_id")
    direct = (
        by_name.join(asked, "low")
        .filter(in_domain)
        .withColumn("place", F.row_number().over(rank))
        .filter(F.col("place") <= TOP_NAMES)
        .select("term_id", *_SHOWN, F.lit(0).alias("kind"), "place")
    )
    direct = materialise(direct, "direct-hits")

    satisfied = direct.groupBy("term_id").count().filter(F.col("count") >= FEW_HITS)
    rest = materialise(asked.join(satisfied, "term_id", "left_anti"), "open-terms")
    # A concept may have several synonyms: each is a node of its own text.
    texts = synonym.select(F.struct("concept_id", "concept_synonym_name").alias("node"), F.col("concept_synonym_name").alias("name"))
    hits = names_of_terms(texts.distinct(), rest).select("low", "node.concept_id", F.length("name").alias("size"))
    near = Window.partitionBy("term_id").orderBy("size", "concept_name", "concept_id")
    more = (
        hits.join(valid, "concept_id")
        .join(rest, "low")
        .filter(in_domain)
        .withColumn("place", F.row_number().over(near))
        .filter(F.col("place") <= TOP_SYNONYMS)
        .select("term_id", *_SHOWN, F.lit(1).alias("kind"), "place")
    )
    best = direct.unionByName(more).groupBy("term_id", *_SHOWN).agg(F.min(F.struct("kind", "place")).alias("at"))
    return best.select("term_id", F.row_number().over(Window.partitionBy("term_id").orderBy("at")).alias("position"), *_SHOWN)
