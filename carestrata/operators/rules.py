"""Rules on the rows of clinical tables, many kinds in one scan of a table.

A rule is a condition that a row violates. All rules of a table become counts of one
aggregate. Rules about a person's life (birth, death, observation, gender) look up one
row per person, and rules about concepts one row per concept, both joined once a table,
whatever the number of rules. A rule that cannot be evaluated, say since its column is
missing, is reported as an error and does not stop the others.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestrata.operators.intervals import collapse_intervals
from carestrata.runtime import broadcast_when_small


@dataclass(frozen=True)
class Rule:
    """A check of ``field``; ``bound`` is what it is compared with.

    The check fails if over ``threshold_pct`` of the rows violate it.
    """

    check: str
    field: str
    bound: Any = None
    threshold_pct: float = 0.0


def _day(name: str) -> Column:
    return F.col(f"row.`{name}`").cast("date")


def _value(rule: Rule) -> Column:
    return F.col(f"row.`{rule.field}`")


def _outside_observation(rule: Rule) -> Column:
    inside = F.exists("life.periods", lambda p: _day(rule.field).between(p["start"], p["end"]))
    return _day(rule.field).isNotNull() & ~F.coalesce(inside, F.lit(False))


def _wrong_gender(rule: Rule) -> Column:
    concepts, gender = rule.bound
    return _value(rule).isin(*concepts) & (F.coalesce("life.gender_concept_id", F.lit(0)) != gender)


def _wrong_unit(rule: Rule) -> Column:
    concepts, unit_field, units = rule.bound
    unit = F.col(f"row.`{unit_field}`")
    return _value(rule).isin(*concepts) & ~F.coalesce(unit.isin(*units), F.lit(False))


def _implausible_value(rule: Rule) -> Column:
    concepts, number_field, low, high = rule.bound
    return _value(rule).isin(*concepts) & ~F.col(f"row.`{number_field}`").between(low, high)


def _concept(rule: Rule, part: str) -> Column:
    return F.col(f"`concept of {rule.field}`.{part}")


def _recorded(rule: Rule) -> Column:
    return _value(rule).isNotNull() & (_value(rule) != 0)


#: By name of the check: its level and the condition that a row violates. A null in what
#: is compared violates nothing, except where the rule says so.
CHECKS = {
    "is_required": ("FIELD", lambda r: _value(r).isNull()),
    "is_one_of": ("FIELD", lambda r: ~_value(r).isin(*r.bound)),
    "is_like": ("FIELD", lambda r: ~_value(r).cast("string").rlike(r.bound)),
    "fits_width": ("FIELD", lambda r: F.length(_value(r)) > r.bound),
    "plausible_low": ("FIELD", lambda r: _value(r) < r.bound),
    "plausible_high": ("FIELD", lambda r: _value(r) > r.bound),
    "starts_before_end": ("FIELD", lambda r: _day(r.field) > _day(r.bound)),
    "is_known_person": ("FIELD", lambda r: _value(r).isNotNull() & F.col("life").isNull()),
    "plausible_after_birth": ("FIELD", lambda r: _day(r.field) < F.col("life.birth")),
    "plausible_before_death": ("FIELD", lambda r: _day(r.field) > F.date_add("life.death", r.bound or 0)),
    "within_observation": ("FIELD", _outside_observation),
    "concept_recorded": ("CONCEPT", lambda r: _value(r) == 0),
    "concept_exists": ("CONCEPT", lambda r: _recorded(r) & _concept(r, "domain_id").isNull()),
    "concept_is_standard": (
        "CONCEPT",
        lambda r: _recorded(r) & ~((F.coalesce(_concept(r, "standard_concept"), F.lit("")) == "S") & _concept(r, "invalid_reason").isNull()),
    ),
    "concept_in_domain": ("CONCEPT", lambda r: _recorded(r) & (_concept(r, "domain_id") != r.bound)),
    "plausible_gender": ("CONCEPT", _wrong_gender),
    "plausible_unit": ("CONCEPT", _wrong_unit),
    "plausible_value": ("CONCEPT", _implausible_value),
}

_OF_LIFE = {"is_known_person", "plausible_after_birth", "plausible_before_death", "within_observation", "plausible_gender"}
_OF_CONCEPT = {"concept_exists", "concept_is_standard", "concept_in_domain"}


def lives(person: DataFrame, death: DataFrame, observation_period: DataFrame) -> DataFrame:
    """One row per person: birth, death, gender and periods under observation.

    A missing month or day of birth is the first, so that nothing counts as before birth
    that may not be. Of several births, deaths or genders the smallest counts. Periods
    that overlap or touch are one, so a person has at most one per two days.
    """
    birth = F.make_date("year_of_birth", F.coalesce("month_of_birth", F.lit(1)), F.coalesce("day_of_birth", F.lit(1)))
    born = person.groupBy("person_id").agg(F.min(birth).alias("birth"), F.min("gender_concept_id").alias("gender_concept_id"))
    died = death.groupBy("person_id").agg(F.min(F.col("death_date").cast("date")).alias("death"))
    begin, end = (F.col(f"observation_period_{edge}_date").cast("date") for edge in ("start", "end"))
    spans = observation_period.select("person_id", begin.alias("start"), end.alias("end")).dropna().where(F.col("start") <= F.col("end"))
    periods = (
        collapse_intervals(spans, ["person_id"], "start", "end", gap_days=1)
        .groupBy("person_id")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("periods"))
    )
    return born.join(died, "person_id", "left").join(periods, "person_id", "left")


def _evaluable(joined: DataFrame, rules: list[Rule]) -> dict[int, Column]:
    """Conditions by position of the rule, without those that Spark cannot resolve."""
    found = {}
    for i, rule in enumerate(rules):
        try:
            condition = CHECKS[rule.check][1](rule)
            joined.select(condition.cast("boolean")).schema  # noqa: B018
        except (AnalysisException, KeyError, TypeError, ValueError):
            continue
        found[i] = condition
    return found


def table_checks(
    df: DataFrame,
    table: str,
    rules: list[Rule],
    life: DataFrame | None = None,
    concept: DataFrame | None = None,
    person: str = "person_id",
) -> DataFrame:
    """One row per rule with its counts and flags, from one scan of ``df``.

    ``life`` comes from :func:`lives`, ``concept`` is the vocabulary; a rule that needs
    one that is not given is an error, as is an unknown check or a missing column. The
    person side has one row per person, so adaptive execution can split a hot person.
    The check of an empty table does not apply and counts as passed; an error does neither
    fail nor pass.
    """
    used = {rule.field for rule in rules} | {person}
    for rule in rules:
        extra = rule.bound if isinstance(rule.bound, tuple) else (rule.bound,)
        used |= {b for b in extra if isinstance(b, str)}
    kept = [c for c in df.columns if c in used]
    joined = df.select(F.struct(*[F.col(f"`{c}`") for c in kept] or [F.lit(1).alias("_")]).alias("row"))
    if life is not None and person in df.columns and any(r.check in _OF_LIFE for r in rules):
        sides = life.select(F.col("person_id").alias("of person"), F.struct(*life.columns).alias("life"))
        joined = joined.join(sides, F.col(f"row.`{person}`") == F.col("`of person`"), "left")
    looked_up = sorted({r.field for r in rules if r.check in _OF_CONCEPT and r.field in kept})
    if concept is not None and looked_up:
        known = concept.select("concept_id", F.struct("domain_id", "standard_concept", "invalid_reason").alias("c"))
        known = broadcast_when_small(known.dropDuplicates(["concept_id"]))
        for field in looked_up:
            side = known.select(F.col("concept_id").alias(f"id of {field}"), F.col("c").alias(f"concept of {field}"))
            joined = joined.join(side, F.col(f"row.`{field}`") == F.col(f"`id of {field}`"), "left")
    conditions = _evaluable(joined, rules)
    counted = joined.agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count(F.when(c, 1)).alias(f"v{i}") for i, c in conditions.items()]
    )
    entries = [
        F.struct(
            F.lit(CHECKS[r.check][0] if r.check in CHECKS else "FIELD").alias("check_level"),
            F.lit(r.check).alias("check_name"),
            F.lit(r.field).alias("field_name"),
            F.lit(float(r.threshold_pct)).alias("threshold_pct"),
            (F.col(f"v{i}") if i in conditions else F.lit(None).cast("long")).alias("n_violated"),
        )
        for i, r in enumerate(rules)
    ]
    rows = counted.select("n_rows", F.explode(F.array(*entries)).alias("r")).select("n_rows", "r.*")
    error = F.col("n_violated").isNull()
    failed = (F.col("n_rows") > 0) & (F.col("n_violated") * 100.0 > F.col("n_rows") * F.col("threshold_pct"))
    return rows.select(
        "check_level",
        "check_name",
        F.lit(table).alias("table_name"),
        "field_name",
        "n_violated",
        "n_rows",
        (~error & failed).cast("int").alias("failed"),
        (~error & ~failed).cast("int").alias("passed"),
        error.cast("int").alias("is_error"),
        (~error & (F.col("n_rows") == 0)).cast("int").alias("not_applicable"),
    )


def all_checks(
    tables: dict[str, DataFrame], rules: dict[str, list[Rule]], life: DataFrame | None = None, concept: DataFrame | None = None
) -> DataFrame:
    """The checks of several tables; rules of a table that is not there are errors."""
    spark = next(iter(tables.values())).sparkSession
    missing = spark.createDataFrame([], "_ int")
    found = [table_checks(tables.get(name, missing), name, listed, life, concept) for name, listed in rules.items()]
    return reduce(DataFrame.unionByName, found)
