"""Encounters to visits, and encounters to the visit that absorbs them.

Encounters: ``encounter_id, patient, encounterclass, start_date, stop_date``.
Visits: ``visit_occurrence_id, encounter_id, patient, encounterclass,
visit_start_date, visit_end_date``, where ``encounter_id`` is the smallest
encounter of the visit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carestrata.functions.codes import MAPS_TO
from carestrata.functions.encounter_classes import (
    class_group,
    visit_concept,
    visit_priority,
)
from carestrata.functions.parsing import two_digit_code, typed_null
from carestrata.operators.ids import with_lasting_id, with_surrogate_id
from carestrata.operators.intervals import collapse_intervals
from carestrata.runtime import broadcast_bounded, materialise

# Id distance between a visit and its detail row; type concept of
# a visit taken from an encounter record; vocabulary of discharge codes.
DETAIL_ID_OFFSET = 1_000_000
VISIT_TYPE_CONCEPT = 32827
DISCHARGE_VOCABULARY = "UB04 Pt dis status"

# The tree of days in which encounters meet visits: 2 ** 22 days from 0001-01-01 on.
TREE_DEPTH, FIRST_DAY = 22, -719162

# Sets of visits that an encounter is looked up in, best first: the class groups and all.
ANY = "any"
SETS = ("inpatient", "emergency", "outpatient", ANY)

_INTERVAL = ["patient", "encounterclass", "start_date", "stop_date"]


def closed(encounters: DataFrame) -> DataFrame:
    """Encounters whose missing end, or end before the start, is their start."""
    return encounters.withColumn("stop_date", F.greatest("stop_date", "start_date"))


def visit_intervals(encounters: DataFrame, inpatient_gap_days: int = 1) -> DataFrame:
    """Roll encounters up to visits, without id.

    Inpatient encounters of a patient merge when they overlap or lie within
    ``inpatient_gap_days``; emergency and outpatient ones merge per class and
    start date. Other classes open no visit of their own.
    """
    encounters = closed(encounters)
    columns = ["encounter_id", "patient", "encounterclass", "start_date", "stop_date"]
    group = class_group("encounterclass")
    inpatient = collapse_inpatient(
        encounters.filter(group == "inpatient").select(columns), inpatient_gap_days
    )
    same_day = (
        encounters.filter(group.isin("emergency", "outpatient"))
        .groupBy("patient", "encounterclass", "start_date")
        .agg(
            F.min("encounter_id").alias("encounter_id"),
            F.max(F.greatest("stop_date", "start_date")).alias("stop_date"),
        )
    )
    return inpatient.unionByName(same_day).select(
        "encounter_id",
        "patient",
        "encounterclass",
        F.col("start_date").alias("visit_start_date"),
        F.col("stop_date").alias("visit_end_date"),
    )


def collapse_inpatient(encounters: DataFrame, gap_days: int) -> DataFrame:
    return collapse_intervals(
        encounters,
        ["patient", "encounterclass"],
        "start_date",
        "stop_date",
        gap_days,
        count=None,
        smallest=("encounter_id",),
    )


def all_visits(encounters: DataFrame, inpatient_gap_days: int = 1, registry: str | None = None) -> DataFrame:
    """Visits with an id over the total order patient, class, start, encounter.

    With a ``registry`` a visit keeps its id over all builds as long as its patient,
    class and start stay; a visit whose start moves is another visit.
    """
    found = visit_intervals(encounters, inpatient_gap_days)
    if registry is not None:
        return with_lasting_id(found, "visit_occurrence_id", ["patient", "encounterclass", "visit_start_date"], registry)
    return with_surrogate_id(
        found,
        "visit_occurrence_id",
        ["patient", "encounterclass", "visit_start_date", "encounter_id"],
    )


def _leaf(date: str) -> str:
    """A date as a leaf of the tree of days: its nodes are numbered from 1, top down."""
    return f"least(greatest(unix_date({date}) + {-FIRST_DAY}, 0), {(1 << TREE_DEPTH) - 1}) + {1 << TREE_DEPTH}"


def covering_nodes(start: str, end: str):
    """The fewest nodes of the tree of days that make up an interval, at most two a level.

    Going up from both ends, a node counts that sticks out of its parent: the left
    end's if it is a right child, the one before the right end if that is one.
    """
    low, past = _leaf(start), f"{_leaf(end)} + 1"
    left = f"shiftright({low} + shiftleft(1, i) - 1, i)"
    right = f"shiftright({past}, i)"
    nodes = f"""flatten(transform(sequence(0, {TREE_DEPTH}), i -> if({left} < {right},
        array(if({left} % 2 = 1, {left}, null), if({right} % 2 = 1, {right} - 1, null)), array(null, null))))"""
    return F.array_compact(F.expr(nodes))


def candidate_intervals(encounters: DataFrame, visits: DataFrame) -> DataFrame:
    """Each distinct encounter interval with every visit that contains it.

    Days are the leaves of a binary tree. A visit is cut into the nodes that make it
    up, at most two a level, however long it stays open; an encounter's start lies
    below one node of each level, so it meets each visit around it at exactly one node.
    Equal encounters are reduced to one row first. The rows that join are as many as
    there are visits around the starts, and a busy patient is spread over many nodes.
    """
    cover = materialise(
        visits.select(
            "patient",
            F.col("visit_occurrence_id").alias("visit_occurrence_id_new"),
            F.col("encounterclass").alias("visit_type"),
            "visit_start_date",
            "visit_end_date",
            F.explode(covering_nodes("visit_start_date", "visit_end_date")).alias("_node"),
        ),
        "visit-nodes",
    )
    # Of the 23 levels only those that some visit uses: usually few, as stays are short.
    level = F.expr(f"{TREE_DEPTH} - floor(log2(_node + 0.5))").cast("int")
    used = sorted(r[0] for r in cover.select(level).distinct().collect())
    above = F.array(*[F.expr(f"shiftright({_leaf('start_date')}, {n})") for n in used]) if used else F.array().cast("array<int>")
    distinct = encounters.select(_INTERVAL).distinct().withColumn("_node", F.explode(above))
    return distinct.join(cover, ["patient", "_node"]).filter("start_date >= visit_start_date and stop_date <= visit_end_date").drop("_node")


def assign_all_visit_ids(encounters: DataFrame, visits: DataFrame) -> DataFrame:
    """All candidate visits of each encounter; one row with nulls if it has none."""
    encounters = closed(encounters)
    return encounters.select("encounter_id", *_INTERVAL).join(
        candidate_intervals(encounters, visits), _INTERVAL, "left"
    )


def _best():
    """Smallest candidate by priority, start, end and id; combines map-side."""
    return F.min(
        F.struct(
            visit_priority("encounterclass", "visit_type", "visit_occurrence_id_new").alias("priority"),
            "visit_start_date",
            "visit_end_date",
            "visit_occurrence_id_new",
        )
    )


def final_visit_ids(candidates: DataFrame) -> DataFrame:
    """One row per encounter of :func:`assign_all_visit_ids`: its best visit.

    Encounters without a suitable candidate stay, with a null id if they have no
    candidate at all.
    """
    return (
        candidates.groupBy("encounter_id")
        .agg(_best().alias("best"))
        .select("encounter_id", F.col("best.visit_occurrence_id_new"))
    )


def first_to_reach(visits: DataFrame) -> DataFrame:
    """For each patient and set of visits, the first visit that lasts to a given day.

    The sets are the class groups and ``any``. In the order of start, end and id
    a visit matters only if it lasts longer than all before it; it is then the
    first to reach the days from there to its end. Those days never overlap
    within a set, so a set holds at most one row per calendar day. One order per
    patient serves all sets.
    """
    earlier = (
        Window.partitionBy("patient")
        .orderBy("visit_start_date", "visit_end_date", "visit_occurrence_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    in_set = {s: F.lit(True) if s == ANY else class_group("encounterclass") == s for s in SETS}
    reached = {f"_reached_{s}": F.max(F.when(member, F.col("visit_end_date"))).over(earlier) for s, member in in_set.items()}
    longer = [
        F.when(member & F.expr(f"_reached_{s} is null or visit_end_date > _reached_{s}"), F.struct(F.lit(s).alias("set"), F.col(f"_reached_{s}").alias("day")))
        for s, member in in_set.items()
    ]
    return (
        visits.withColumns(reached)
        .withColumn("_longer", F.explode(F.array_compact(F.array(*longer))))
        .select(
            "patient",
            F.col("visit_occurrence_id").alias("visit_occurrence_id_new"),
            "visit_start_date",
            "visit_end_date",
            F.col("_longer.set").alias("_set"),
            F.greatest("visit_start_date", F.date_add("_longer.day", 1)).alias("_from"),
        )
    )


def resolve_visits(encounters: DataFrame, visits: DataFrame) -> DataFrame:
    """:func:`final_visit_ids` without forming the candidates.

    Of the visits around an encounter the first by start, end and id counts, and
    that is the first one to reach its last day, if it starts in time. So the last
    days of each patient are looked up in all sets at once (the class groups and any):
    visits and days are put in one order per patient, at most one row per set and
    calendar day however long a visit is open, and a day takes the last visit of each
    set that begins to count by then. The answers are unique per patient and day, so a
    busy patient's encounters can be split when they join. Of the answers an encounter
    takes that of inpatient stays, of its own class group or of any, the first there is.
    """
    encounters = closed(encounters)
    visit = F.struct("visit_start_date", "visit_end_date", "visit_occurrence_id_new")
    reached = first_to_reach(visits).select("patient", F.col("_from").alias("_day"), "_set", visit.alias("_visit"))
    days = (
        encounters.select("patient", F.col("stop_date").alias("_day"))
        .filter("patient is not null and _day is not null")
        .distinct()
        .select("*", F.lit(None).cast("string").alias("_set"), F.lit(None).cast(reached.schema["_visit"].dataType).alias("_visit"))
    )
    upto = Window.partitionBy("patient").orderBy("_day").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = {f"_{s}": F.last(F.when(F.col("_set") == s, F.col("_visit")), ignorenulls=True).over(upto) for s in SETS}
    lasting = [
        F.when(F.expr(f"_day <= _{s}.visit_end_date"), F.struct(f"_{s}.visit_start_date", f"_{s}.visit_occurrence_id_new")).alias(f"_{s}")
        for s in SETS
    ]
    # A visit of any set is one of the set of all.
    found = (
        reached.unionByName(days)
        .withColumns(last)
        .filter("_set is null")
        .select("patient", F.col("_day").alias("stop_date"), *lasting)
        .filter(f"_{ANY} is not null")
    )
    around = {s: F.when(F.expr(f"_{s}.visit_start_date <= start_date"), F.col(f"_{s}")) for s in SETS}
    mine = class_group("encounterclass")
    own = [F.when(mine.isNotNull(), around["inpatient"]), *(F.when(mine == s, around[s]) for s in SETS if s not in ("inpatient", ANY))]
    best = F.when(F.col("encounterclass").isNotNull(), F.coalesce(*own, around[ANY]))
    return (
        encounters.select("encounter_id", *_INTERVAL)
        .join(found, ["patient", "stop_date"], "left")
        .select("encounter_id", best["visit_occurrence_id_new"].alias("visit_occurrence_id_new"))
    )


def selected_visits(visits: DataFrame, final_ids: DataFrame) -> DataFrame:
    """Visits that some encounter resolved to."""
    chosen = final_ids.select(F.col("visit_occurrence_id_new").alias("visit_occurrence_id"))
    return visits.join(
        chosen.filter("visit_occurrence_id is not null").distinct(), "visit_occurrence_id", "left_semi"
    )


def visit_occurrence(visits: DataFrame, final_ids: DataFrame, person: DataFrame) -> DataFrame:
    """Visit rows; the discharge columns are filled by :func:`enrich_discharge`."""
    people = person.select("person_id", F.col("person_source_value").alias("patient"))
    return (
        selected_visits(visits, final_ids)
        .join(people, "patient")
        .select(
            "visit_occurrence_id",
            "person_id",
            visit_concept("encounterclass").alias("visit_concept_id"),
            "visit_start_date",
            "visit_end_date",
            F.lit(VISIT_TYPE_CONCEPT).alias("visit_type_concept_id"),
            F.col("encounter_id").cast("string").alias("visit_source_value"),
            F.lit(0).cast("long").alias("discharged_to_concept_id"),
            typed_null("string").alias("discharged_to_source_value"),
        )
    )


def visit_detail(visits: DataFrame, final_ids: DataFrame, person: DataFrame) -> DataFrame:
    """One detail row per visit, its id a fixed distance from the visit id."""
    return visit_occurrence(visits, final_ids, person).select(
        (F.col("visit_occurrence_id") + DETAIL_ID_OFFSET).alias("visit_detail_id"),
        "person_id",
        F.col("visit_concept_id").alias("visit_detail_concept_id"),
        F.col("visit_start_date").alias("visit_detail_start_date"),
        F.col("visit_end_date").alias("visit_detail_end_date"),
        F.col("visit_type_concept_id").alias("visit_detail_type_concept_id"),
        F.col("visit_source_value").alias("visit_detail_source_value"),
        "visit_occurrence_id",
    )


def discharge_codes(encounters: DataFrame, final_ids: DataFrame, discharge: str = "discharge") -> DataFrame:
    """Largest non-empty discharge code over all encounters of a visit."""
    coded = encounters.select("encounter_id", two_digit_code(discharge).alias("discharge")).filter(
        "discharge is not null"
    )
    return (
        final_ids.filter("visit_occurrence_id_new is not null")
        .join(coded, "encounter_id")
        .groupBy(F.col("visit_occurrence_id_new").alias("visit_occurrence_id"))
        .agg(F.max("discharge").alias("discharge"))
    )


def discharge_concepts(
    concept: DataFrame, relationship: DataFrame, vocabulary: str = DISCHARGE_VOCABULARY
) -> DataFrame:
    """Discharge code to concept: the standard target, else the code's own concept.

    Of several standard targets the smallest id is taken.
    """
    own = concept.filter((F.col("vocabulary_id") == vocabulary) & F.col("invalid_reason").isNull())
    targets = concept.filter("standard_concept = 'S' and invalid_reason is null").select(
        F.col("concept_id").alias("standard_id")
    )
    maps_to = relationship.filter(
        (F.col("relationship_id") == MAPS_TO) & F.col("invalid_reason").isNull()
    ).select(F.col("concept_id_1").alias("concept_id"), F.col("concept_id_2").alias("standard_id"))
    return (
        own.select("concept_code", "concept_id")
        .join(maps_to.join(targets, "standard_id", "left_semi"), "concept_id", "left")
        .groupBy(F.col("concept_code").alias("discharge"))
        .agg(
            F.coalesce(F.min("standard_id"), F.min("concept_id")).cast("long").alias("discharge_concept_id")
        )
    )


def enrich_discharge(
    visit_rows: DataFrame,
    final_ids: DataFrame,
    encounters: DataFrame,
    concept: DataFrame,
    relationship: DataFrame,
    discharge: str = "discharge",
    vocabulary: str = DISCHARGE_VOCABULARY,
) -> DataFrame:
    """Rewrite both discharge columns of the visits that have a discharge code.

    Visits without one keep what they have, so running it twice, or on a source
    that carries no codes, changes nothing.
    """
    codes = discharge_codes(encounters, final_ids, discharge).join(
        broadcast_bounded(discharge_concepts(concept, relationship, vocabulary), "discharge"),
        "discharge",
        "left",
    )
    has_code = F.col("discharge").isNotNull()
    return (
        visit_rows.join(codes, "visit_occurrence_id", "left")
        .withColumn(
            "discharged_to_concept_id",
            F.when(has_code, F.coalesce("discharge_concept_id", F.lit(0).cast("long"))).otherwise(
                F.col("discharged_to_concept_id")
            ),
        )
        .withColumn(
            "discharged_to_source_value",
            F.when(has_code, F.col("discharge")).otherwise(F.col("discharged_to_source_value")),
        )
        .select(visit_rows.columns)
    )
