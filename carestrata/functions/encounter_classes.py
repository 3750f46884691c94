"""Encounter classes: visit concepts, equivalence groups and match priority."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carestrata.functions.parsing import as_column

# Visit concept of each encounter class. Urgent care has a concept
# of its own, so that it never counts as an emergency room visit.
VISIT_CONCEPTS = {
    "inpatient": 9201,
    "ambulatory": 9202,
    "outpatient": 9202,
    "wellness": 9202,
    "emergency": 9203,
    "urgent": 9203,
    "urgentcare": 8782,
}

# Classes that resolve to one another.
INPATIENT = ("inpatient",)
EMERGENCY = ("emergency", "urgent", "urgentcare")
OUTPATIENT = ("ambulatory", "wellness", "outpatient")

# Match priority, best first.
ABSORBED_BY_INPATIENT, SAME_GROUP, NO_MATCH = 1, 2, 99


def class_group(col: Column | str) -> Column:
    """``inpatient``, ``emergency``, ``outpatient`` or null for other classes."""
    c = as_column(col)
    return (
        F.when(c.isin(*INPATIENT), "inpatient")
        .when(c.isin(*EMERGENCY), "emergency")
        .when(c.isin(*OUTPATIENT), "outpatient")
    )


def visit_concept(col: Column | str) -> Column:
    """Visit concept of an encounter class, 0 when the class has none."""
    c = as_column(col)
    expr = F.when(F.lit(False), F.lit(0))
    for name, concept in VISIT_CONCEPTS.items():
        expr = expr.when(c == name, F.lit(concept))
    return expr.otherwise(F.lit(0))


def visit_priority(encounter_class: Column | str, visit_type: Column | str, visit_id: Column | str) -> Column:
    """How well a candidate visit suits an encounter (1 best, 99 not at all)."""
    mine, theirs = class_group(encounter_class), class_group(visit_type)
    usable = as_column(visit_id).isNotNull() & mine.isNotNull()
    return (
        F.when(usable & (theirs == "inpatient"), ABSORBED_BY_INPATIENT)
        .when(usable & (mine == theirs), SAME_GROUP)
        .otherwise(NO_MATCH)
    )
