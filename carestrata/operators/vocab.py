"""Vocabulary: source maps, concept search, closure and code resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carestrata.functions.codes import MAPS_TO, is_valid_standard, vocabulary_of_system
from carestrata.functions.parsing import contains_ignoring_case
from carestrata.runtime import broadcast_bounded, is_small, materialise

# Sizes of the search reports, and how few direct hits call for
# the synonyms.
TOP_NAMES, TOP_SYNONYMS, TOP_DESCENDANTS, FEW_HITS = 20, 10, 10, 3

# Rows of concept sets that one task writes out, and the sets or concepts
# of one content in a block: a task holds the rows of one pair of blocks at a time.
ROWS_PER_TASK, BLOCK = 20_000_000, 256

# Fixed value: the vocabulary row that carries the release name.
RELEASE_ROW = "None"

_SOURCE = ["source_code", "source_concept_id", "source_vocabulary_id", "source_domain_id"]


def _source_side(concept: DataFrame) -> DataFrame:
    return concept.select(
        F.col("concept_code").alias("source_code"),
        F.col("concept_id").alias("source_concept_id"),
        F.col("vocabulary_id").alias("source_vocabulary_id"),
        F.col("domain_id").alias("source_domain_id"),
    )


def _target_side(concept: DataFrame) -> DataFrame:
    return concept.select(
        F.col("concept_id").alias("target_concept_id"),
        F.col("domain_id").alias("target_domain_id"),
        F.col("vocabulary_id").alias("target_vocabulary_id"),
        F.col("standard_concept").alias("target_standard_concept"),
        F.col("invalid_reason").alias("target_invalid_reason"),
    )


def _custom_side(custom_map: DataFrame) -> DataFrame:
    """Still valid rows of a user supplied source-to-concept map."""
    return custom_map.filter("invalid_reason is null").select(
        "source_code",
        "source_concept_id",
        "source_vocabulary_id",
        F.lit(None).cast("string").alias("source_domain_id"),
        "target_concept_id",
    )


def source_to_standard_map(
    concept: DataFrame, relationship: DataFrame, custom_map: DataFrame | None = None
) -> DataFrame:
    """Source code to target concept through valid ``Maps to`` relationships.

    The relationship name is compared without regard to case. A code with
    several targets yields several rows.
    """
    maps_to = relationship.filter(
        (F.lower("relationship_id") == MAPS_TO.lower()) & F.col("invalid_reason").isNull()
    ).select(
        F.col("concept_id_1").alias("source_concept_id"),
        F.col("concept_id_2").alias("target_concept_id"),
    )
    mapped = _source_side(concept).join(maps_to, "source_concept_id")
    if custom_map is not None:
        mapped = mapped.unionByName(_custom_side(custom_map))
    return mapped.join(_target_side(concept), "target_concept_id").select(
        *_SOURCE,
        "target_concept_id",
        "target_domain_id",
        "target_vocabulary_id",
        "target_standard_concept",
        "target_invalid_reason",
    )


def source_to_source_map(concept: DataFrame, custom_map: DataFrame | None = None) -> DataFrame:
    """Each code with its own concept, and the custom codes with their targets."""
    own = _source_side(concept).select(
        *_SOURCE,
        F.col("source_concept_id").alias("target_concept_id"),
        F.col("source_vocabulary_id").alias("target_vocabulary_id"),
    )
    if custom_map is None:
        return own
    custom = _custom_side(custom_map).join(
        _target_side(concept).select("target_concept_id", "target_vocabulary_id"), "target_concept_id"
    )
    return own.unionByName(custom.select(own.columns))


def states_map(states: DataFrame, concept: DataFrame) -> DataFrame:
    """State name and abbreviation to the standard location concept of that name.

    ``states`` has ``state`` and ``state_abbreviation``. Names are compared
    without regard to case; of equal names the smallest concept id is taken.
    """
    places = (
        concept.filter((F.col("domain_id") == "Geography") & is_valid_standard())
        .groupBy(F.lower("concept_name").alias("_name"))
        .agg(F.min("concept_id").alias("country_concept_id"))
    )
    return (
        states.withColumn("_name", F.lower("state"))
        .join(places, "_name", "left")
        .select("state", "state_abbreviation", F.coalesce("country_concept_id", F.lit(0).cast("long")).alias("state_concept_id"))
    )


def vocabulary_release(vocabulary: DataFrame) -> DataFrame:
    """Release name of the loaded vocabulary: one row, or none if it is absent."""
    return vocabulary.filter(F.col("vocabulary_id") == RELEASE_ROW).select("vocabulary_version").limit(1)


# -- search ------------------------------------------------------------------

# The columns of the search reports.
_SHOWN = [
    "concept_id",
    "concept_name",
    "domain_id",
    "vocabulary_id",
    "concept_class_id",
    "standard_concept",
    "concept_code",
]


def _searchable(concept: DataFrame, domain: str | None) -> DataFrame:
    valid = concept.filter(is_valid_standard())
    return valid.filter(F.col("domain_id") == domain) if domain else valid


def _name_rank(term: str) -> list[Column]:
    """Exact match first, then the shortest name, then by name."""
    return [
        F.when(F.lower("concept_name") == term.lower(), 0).otherwise(1),
        F.length("concept_name"),
        F.col("concept_name"),
        F.col("concept_id"),
    ]


def search_names(concept: DataFrame, term: str, domain: str | None = None) -> DataFrame:
    """Best twenty names holding ``term``: exact first, then shortest, then by name."""
    hits = _searchable(concept, domain).filter(contains_ignoring_case("concept_name", term))
    return (
        hits.orderBy(*_name_rank(term))
        .limit(TOP_NAMES)
        .select(_SHOWN)
    )


def search_synonyms(concept: DataFrame, synonym: DataFrame, term: str, domain: str | None = None) -> DataFrame:
    """Best ten synonyms holding ``term``: shortest first, then by concept name."""
    hits = synonym.filter(contains_ignoring_case("concept_synonym_name", term)).select(
        "concept_id", "concept_synonym_name"
    )
    return (
        _searchable(concept, domain)
        .join(hits, "concept_id")
        .orderBy(F.length("concept_synonym_name"), "concept_name", "concept_id")
        .limit(TOP_SYNONYMS)
        .select(*_SHOWN, F.length("concept_synonym_name").alias("_length"))
    )


def search_concepts(concept: DataFrame, synonym: DataFrame, term: str, domain: str | None = None) -> DataFrame:
    """Name search; the synonyms join in only when it finds fewer than three.

    Both searches are cut to their report size first, so the window that counts
    the direct hits sees thirty rows at most. Direct hits come first, in their own
    order; the others keep the order of the synonym search.
    """
    direct = search_names(concept, term, domain).withColumn("_length", F.lit(0)).withColumn("_direct", F.lit(1))
    more = search_synonyms(concept, synonym, term, domain).withColumn("_direct", F.lit(0))
    hits = F.sum("_direct").over(Window.partitionBy())
    return (
        direct.unionByName(more)
        .withColumn("_hits", hits)
        .filter((F.col("_direct") == 1) | (F.col("_hits") < FEW_HITS))
        .groupBy(_SHOWN)
        .agg(F.max("_direct").alias("_direct"), F.min("_length").alias("_length"))
        .orderBy(
            F.col("_direct").desc(),
            *(F.when(F.col("_direct") == 1, c) for c in _name_rank(term)),
            "_length",
            "concept_name",
            "concept_id",
        )
        .select(_SHOWN)
    )


def top_descendants(concept: DataFrame, closure: DataFrame, ancestors: DataFrame) -> DataFrame:
    """First ten valid standard descendants of each ancestor by level and name."""
    below = (
        closure.filter("min_levels_of_separation > 0")
        .join(broadcast_bounded(ancestors.select("ancestor_concept_id"), "ancestors"), "ancestor_concept_id", "left_semi")
        .select(
            "ancestor_concept_id",
            F.col("descendant_concept_id").alias("concept_id"),
            F.col("min_levels_of_separation").alias("levels_below"),
        )
    )
    shown = concept.filter(is_valid_standard()).select("concept_id", "concept_name", "domain_id", "vocabulary_id")
    # The rank filter is pushed below the shuffle, so each task sends at most
    # ten rows per ancestor.
    order = Window.partitionBy("ancestor_concept_id").orderBy("levels_below", "concept_name", "concept_id")
    return (
        below.join(shown, "concept_id")
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= TOP_DESCENDANTS)
        .select("ancestor_concept_id", "concept_id", "concept_name", "domain_id", "vocabulary_id", "levels_below")
    )


# -- code resolution ---------------------------------------------------------


def valid_maps_to(relationship: DataFrame) -> DataFrame:
    """Pairs of the valid ``Maps to`` relationship, by its exact name."""
    return relationship.filter(
        (F.col("relationship_id") == MAPS_TO) & F.col("invalid_reason").isNull()
    ).select("concept_id_1", "concept_id_2")


def coded_concepts(codes: DataFrame, concept: DataFrame) -> DataFrame:
    """Distinct ``(system, code)`` of known systems with the concepts of that code."""
    known = (
        codes.select("system", "code")
        .distinct()
        .withColumn("vocabulary_id", vocabulary_of_system("system"))
        .filter("vocabulary_id is not null")
    )
    listed = concept.select(
        "vocabulary_id", F.col("concept_code").alias("code"), "concept_id", "standard_concept"
    )
    return known.join(listed, ["vocabulary_id", "code"])


def map_codes_to_concepts(codes: DataFrame, concept: DataFrame, relationship: DataFrame) -> DataFrame:
    """``(system, code)`` to standard concepts; codes without one are absent."""
    targets = valid_maps_to(relationship).join(
        concept.select(F.col("concept_id").alias("target_id")),
        F.col("concept_id_2") == F.col("target_id"),
        "left",
    )
    own = F.when(F.col("standard_concept") == "S", F.col("concept_id"))
    found = coded_concepts(codes, concept)
    return (
        found.join(targets, found.concept_id == targets.concept_id_1, "left")
        .select("system", "code", F.coalesce("target_id", own).alias("concept_id"))
        .filter("concept_id is not null")
        .distinct()
    )


def code_resolution(codes: DataFrame, concept: DataFrame, relationship: DataFrame) -> DataFrame:
    """Per code of a known system, whether it is standard or has a valid target."""
    found = coded_concepts(codes, concept)
    targets = valid_maps_to(relationship).select(F.col("concept_id_1").alias("concept_id")).distinct()
    ok = F.when((F.col("standard_concept") == "S") | F.col("has_target"), 1).otherwise(0)
    resolved = (
        found.join(targets.withColumn("has_target", F.lit(True)), "concept_id", "left")
        .groupBy("vocabulary_id", "code")
        .agg(F.max(ok).alias("resolves"))
    )
    wanted = (
        codes.withColumn("vocabulary_id", vocabulary_of_system("system"))
        .filter("vocabulary_id is not null")
        .select("vocabulary_id", "code")
        .distinct()
    )
    return wanted.join(resolved, ["vocabulary_id", "code"], "left").select(
        "vocabulary_id", "code", F.coalesce("resolves", F.lit(0)).alias("resolves")
    )


def unresolved_codes(codes: DataFrame, concept: DataFrame, relationship: DataFrame) -> DataFrame:
    """Codes that would fall to concept 0, with the states that emit them."""
    resolving = code_resolution(codes, concept, relationship).filter("resolves = 1")
    return (
        codes.withColumn("vocabulary_id", vocabulary_of_system("system"))
        .filter("vocabulary_id is not null")
        .join(resolving, ["vocabulary_id", "code"], "left_anti")
        .select("vocabulary_id", "code", "state")
        .distinct()
    )


def unknown_systems(codes: DataFrame) -> DataFrame:
    """Code systems that belong to no known vocabulary."""
    return codes.filter(vocabulary_of_system("system").isNull()).select("system").distinct()


# -- concept sets ------------------------------------------------------------


def shared_set_hits(items: DataFrame, closure: DataFrame, available: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Available concepts inside concept sets: (``keys, content``) of each set, (``content, concept_id``).

    ``items`` has ``keys``, ``concept_id``, ``descendants`` and ``excluded``; a
    concept is hit when an included item reaches it and no excluded item does.
    Sets of the same items share a ``content`` and are searched once. The closure is
    first cut down to the available descendants, so a set at the root of the hierarchy
    costs no more than the concepts at hand.
    """
    item = ["concept_id", "descendants", "excluded"]
    listed = items.groupBy(*keys).agg(F.array_sort(F.collect_set(F.struct(*item))).alias("_items"))
    members = materialise(listed.withColumn("content", F.sha2(F.to_json("_items"), 256)), "set-contents")
    items = members.dropDuplicates(["content"]).select("content", F.inline("_items"))
    # Distinct concept ids of the codes in use; beyond the bound the joins below
    # are shuffled on the concept.
    at_hand = broadcast_bounded(available.select("concept_id").distinct(), "available")
    direct = items.join(at_hand, "concept_id", "left_semi").select("content", "concept_id", "excluded")
    reach = closure.select(
        "ancestor_concept_id", F.col("descendant_concept_id").alias("concept_id")
    ).join(at_hand, "concept_id", "left_semi")
    inherited = (
        items.filter("descendants")
        .select("content", F.col("concept_id").alias("ancestor_concept_id"), "excluded")
        .join(reach, "ancestor_concept_id")
        .select("content", "concept_id", "excluded")
    )
    hits = (
        direct.unionByName(inherited)
        .groupBy("content", "concept_id")
        .agg(F.max("excluded").alias("_excluded"))
        .filter(~F.col("_excluded"))
        .drop("_excluded")
    )
    return members.drop("_items"), materialise(hits, "set-hits")


def sets_of(members: DataFrame, hits: DataFrame) -> DataFrame:
    """The sets of :func:`shared_set_hits` that hold an available concept, with their content."""
    return members.join(hits.select("content").distinct(), "content", "left_semi")


def sets_with_hits(members: DataFrame, hits: DataFrame) -> DataFrame:
    """The sets of :func:`shared_set_hits` that hold an available concept."""
    return sets_of(members, hits).drop("content")


def _in_blocks(rows: DataFrame, columns: list[str], name: str) -> DataFrame:
    """The ``columns`` of each ``content`` as sorted arrays of about ``BLOCK`` rows, dealt by a hash."""
    counted = rows.groupBy("content").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("_blocks"))
    return (
        rows.join(counted, "content")
        .groupBy("content", F.pmod(F.xxhash64(*columns), F.col("_blocks")).alias("_block"))
        .agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(name))
        .drop("_block")
    )


def concept_set_hits(items: DataFrame, closure: DataFrame, available: DataFrame, keys: list[str]) -> DataFrame:
    """Available concepts inside each concept set, one row each.

    What sets of the same items share (:func:`shared_set_hits`) is written out for each
    of them, which is sets times concepts. So only blocks of sets and blocks of concepts
    are joined, one row per pair of blocks, and dealt to as many tasks as the rows take,
    which are counted first; a task writes a pair out row by row. A concept stands beside
    all sets of its block before the next one comes: in a columnar file its id is one
    run, and the keys of the sets repeat after at most a block.
    """
    members, hits = shared_set_hits(items, closure, available, keys)
    per_content = hits.groupBy("content").agg(F.count(F.lit(1)).alias("_hits"))
    rows = members.groupBy("content").agg(F.count(F.lit(1)).alias("_count")).join(per_content, "content")
    total = rows.agg(F.sum(F.col("_hits") * F.col("_count"))).first()[0] or 0
    sets = _in_blocks(sets_of(members, hits), keys, "_sets")
    concepts = _in_blocks(hits, ["concept_id"], "_concepts")
    pairs = sets.join(F.broadcast(concepts) if is_small(hits) else concepts, "content")
    dealt = pairs.select("_sets", "_concepts").repartition(total // ROWS_PER_TASK + 1)
    return dealt.select("_sets", F.inline("_concepts")).select("concept_id", F.inline("_sets")).select(*keys, "concept_id")


# -- closure -----------------------------------------------------------------


def build_closure(edges: DataFrame) -> DataFrame:
    """Closure of ``(parent, child)`` edges with the least and greatest distance.

    Every node is its own ancestor at level 0. Paths are doubled: a round knows the
    distances of all paths of at most n steps and the pairs that exactly n steps join,
    and puts a path of exactly n steps before each of them. So a hierarchy of a thousand
    levels takes about ten rounds, and a pair is made once per node n steps below its
    ancestor, not once per length. Each round is written out. Any depth is walked; a
    node that reaches itself lies on a cycle, which is refused.
    """
    edges = materialise(edges.select(F.col("parent").alias("a"), F.col("child").alias("d")).distinct(), "edges")
    nodes = edges.select("a").union(edges.select("d")).distinct()
    known = edges.select("a", "d", F.lit(1).alias("least"), F.lit(1).alias("most"))
    exact, steps = edges, 1
    while True:
        if not known.where("a = d").isEmpty():
            raise ValueError("the hierarchy has a cycle")
        onward = exact.withColumnRenamed("d", "m")
        tails = known.select(F.col("a").alias("m"), "d", "least", "most")
        longer = onward.join(tails, "m").select("a", "d", (F.col("least") + steps).alias("least"), (F.col("most") + steps).alias("most"))
        joined = known.unionByName(longer).groupBy("a", "d").agg(F.min("least").alias("least"), F.max("most").alias("most"))
        ends = exact.select(F.col("a").alias("m"), "d")
        exact = materialise(onward.join(ends, "m").select("a", "d").distinct(), "closure-exact")
        known = materialise(joined, "closure-paths")
        steps *= 2
        if exact.isEmpty():
            break
    paths = known.unionByName(nodes.select("a", F.col("a").alias("d"), F.lit(0).alias("least"), F.lit(0).alias("most")))
    return paths.select(
        F.col("a").alias("ancestor_concept_id"),
        F.col("d").alias("descendant_concept_id"),
        F.col("least").alias("min_levels_of_separation"),
        F.col("most").alias("max_levels_of_separation"),
    )
