"""Whether the codes at hand can populate the cohorts that need them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carestrata.operators.documents import (
    CUSTOM_LABEL,
    concept_set_items,
    document_keys,
    primary_criteria,
    required_sets,
)
from carestrata.operators.vocab import map_codes_to_concepts, sets_with_hits, shared_set_hits
from carestrata.runtime import materialise

# Texts of the report in words of our own, and how many example labels a row shows.
NOTE_VISIT_MET = "visit entry event not evaluated; its required criteria are covered"
NOTE_VISIT_ONLY = "visit-only cohort: visit types come from encounter classes, not from codes"
DETAIL_MISSING = "no module code reaches concept set(s) "
DETAIL_NOT_EMPTY = "declared expected_empty but the module can emit it"
DETAIL_EMPTY = "expected empty"
PROVIDED_CUSTOM, PROVIDED_BOTH, PROVIDED_BUILT_IN = "custom module", "custom + built-in", "built-in only"
EXAMPLES = 2


def cohort_verdicts(primary: DataFrame, required: DataFrame, hits: DataFrame) -> DataFrame:
    """COVERED, NOT_COVERED or NOT_EVALUABLE per cohort, with the missing sets.

    ``primary``: ``cohort_id, primary_sets, unevaluable, visit_entry``;
    ``required``: ``cohort_id, requirement, set_id``; ``hits``: distinct
    ``cohort_id, set_id`` that some code reaches.

    The first rule that applies decides: requirements without a hit, since nobody can
    meet them; an entry set with a hit; met requirements where entry is by visits;
    and last whether the entry can be judged at all.
    """
    keys = document_keys(primary)
    hit = hits.select(*keys, "set_id").distinct().withColumn("hit", F.lit(True))
    flagged = required.join(hit, [*keys, "set_id"], "left")
    requirements = flagged.groupBy(*keys, "requirement").agg(
        F.max(F.coalesce("hit", F.lit(False))).alias("met"),
        F.collect_set("set_id").alias("sets"),
    )
    per_cohort = requirements.groupBy(*keys).agg(
        F.min("met").alias("all_met"),
        F.array_sort(
            F.array_distinct(F.flatten(F.collect_list(F.when(~F.col("met"), F.col("sets")))))
        ).alias("unmet_sets"),
    )
    entry_hit = (
        primary.select(*keys, F.explode("primary_sets").alias("set_id"))
        .join(hit, [*keys, "set_id"], "left_semi")
        .select(*keys)
        .distinct()
        .withColumn("entry_hit", F.lit(True))
    )
    rows = (
        primary.join(per_cohort, keys, "left")
        .join(entry_hit, keys, "left")
        .withColumn("has_requirement", F.col("all_met").isNotNull())
    )
    unmet = F.col("has_requirement") & ~F.col("all_met")
    status = (
        F.when(unmet, "NOT_COVERED")
        .when(F.col("entry_hit"), "COVERED")
        .when(F.col("visit_entry") & F.col("has_requirement"), "COVERED")
        .when(F.col("visit_entry") | F.col("unevaluable"), "NOT_EVALUABLE")
        .otherwise("NOT_COVERED")
    )
    nothing = F.array().cast("array<int>")
    return rows.select(
        *keys,
        status.alias("status"),
        F.when(unmet, F.col("unmet_sets"))
        .when(
            F.col("entry_hit").isNull() & ~F.col("visit_entry") & ~F.col("unevaluable"),
            F.array_sort("primary_sets"),
        )
        .otherwise(nothing)
        .alias("missing_sets"),
        F.when(unmet | F.coalesce("entry_hit", F.lit(False)) | ~F.col("visit_entry"), "")
        .when(F.col("has_requirement"), NOTE_VISIT_MET)
        .otherwise(NOTE_VISIT_ONLY)
        .alias("note"),
    )


def needed_sets(primary: DataFrame, required: DataFrame) -> DataFrame:
    """Distinct concept sets that entry or requirements refer to."""
    keys = document_keys(primary)
    return (
        primary.select(*keys, F.explode("primary_sets").alias("set_id"))
        .unionByName(required.select(*keys, "set_id"))
        .distinct()
    )


def codes_by_concept(codes: DataFrame, concept: DataFrame, relationship: DataFrame) -> DataFrame:
    """Concepts the codes map to, with the module and state that emit them."""
    mapped = map_codes_to_concepts(codes, concept, relationship)
    return codes.join(mapped, ["system", "code"]).select("module", "state", "display", "concept_id")


def _first_labels(rows: DataFrame, key: list[str]) -> DataFrame:
    """The first labels per key in text order; ranked before the shuffle as well."""
    order = Window.partitionBy(*key).orderBy("label")
    ranked = rows.select(*key, "label").distinct().withColumn("_rank", F.row_number().over(order))
    return ranked.filter(F.col("_rank") <= EXAMPLES).drop("_rank")


def provider_labels(matched: DataFrame, sources: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """Who provides the concepts each cohort matched, and two example labels.

    ``matched``: distinct ``cohort_id, concept_id``; ``sources``: ``concept_id,
    module, display``. With ``members`` (``cohort_id, content``), ``matched`` has the
    concepts of each ``content`` instead, which cohorts share. A concept that many
    modules emit is reduced to its flags and its own first labels before it meets the
    cohorts, and so is a content; the first labels of a cohort are among those.
    """
    keys = document_keys(matched if members is None else members)
    group = keys if members is None else ["content"]
    custom = F.col("module") == CUSTOM_LABEL
    flags = sources.groupBy("concept_id").agg(F.min(custom).alias("all_custom"), F.max(custom).alias("any_custom"))
    labels = _first_labels(
        sources.select("concept_id", F.concat("display", F.lit(" ["), "module", F.lit("]")).alias("label")),
        ["concept_id"],
    )
    both = [F.min("all_custom").alias("all_custom"), F.max("any_custom").alias("any_custom")]
    classes = matched.join(flags, "concept_id").groupBy(*group).agg(*both)
    first = _first_labels(matched.join(labels, "concept_id"), group)
    if members is not None:
        shared = members.select(*keys, "content").distinct()
        classes = shared.join(classes, "content").groupBy(*keys).agg(*both)
        first = _first_labels(shared.join(first, "content"), keys)
    provided = (
        F.when(F.col("all_custom"), PROVIDED_CUSTOM).when(F.col("any_custom"), PROVIDED_BOTH).otherwise(PROVIDED_BUILT_IN)
    )
    examples = first.groupBy(*keys).agg(F.concat_ws("; ", F.array_sort(F.collect_list("label"))).alias("example_codes"))
    return classes.select(*keys, provided.alias("provided_by")).join(examples, keys)


def coverage_report(
    documents: DataFrame,
    expected_empty: DataFrame,
    codes: DataFrame,
    concept: DataFrame,
    relationship: DataFrame,
    closure: DataFrame,
) -> DataFrame:
    """Verdict per cohort document, with its provider and example labels.

    ``documents``: ``cohort_id, document``; ``expected_empty``: ``cohort_id``. With a
    ``study`` in both, cohorts are told apart by study and id throughout.
    A cohort that is known to stay empty is not reported as uncovered.
    """
    keys = document_keys(documents)
    # All four are used more than once below and are small next to their inputs.
    primary = materialise(primary_criteria(documents), "primary")
    required = materialise(required_sets(documents), "required")
    sources = materialise(codes_by_concept(codes, concept, relationship), "sources")
    items = concept_set_items(documents).join(
        needed_sets(primary, required), [*keys, "set_id"], "left_semi"
    )
    members, hits = shared_set_hits(items, closure, sources, [*keys, "set_id"])
    verdicts = cohort_verdicts(primary, required, sets_with_hits(members, hits))
    labels = provider_labels(hits, sources, members)
    known_empty = expected_empty.select(*keys).distinct().withColumn("is_expected_empty", F.lit(True))
    expected = F.coalesce("is_expected_empty", F.lit(False))
    missing = F.when(
        F.size("missing_sets") > 0,
        F.concat(
            F.lit(DETAIL_MISSING),
            F.concat_ws(", ", F.col("missing_sets").cast("array<string>")),
        ),
    ).otherwise(F.when(F.col("note") != "", F.col("note")))
    remark = F.when(
        expected,
        F.when(F.col("status") == "COVERED", DETAIL_NOT_EMPTY).otherwise(DETAIL_EMPTY),
    )
    return (
        verdicts.join(known_empty, keys, "left")
        .join(labels, keys, "left")
        .select(
            *keys,
            F.when(expected & (F.col("status") == "NOT_COVERED"), "EXPECTED_EMPTY")
            .otherwise(F.col("status"))
            .alias("status"),
            F.concat_ws("; ", missing, remark).alias("detail"),
            F.coalesce("provided_by", F.lit("")).alias("provided_by"),
            F.coalesce("example_codes", F.lit("")).alias("example_codes"),
        )
    )
