"""Persons, places, providers, periods, deaths, payer plans, costs and metadata.

Where the rules of a table are not public, the definition here is our own and
says so in its docstring.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carestrata.functions.parsing import as_column, death_date, typed_null
from carestrata.operators.ids import with_surrogate_id

# Code of a death certification event, type concept of a death.
DEATH_CERTIFICATION_CODE = "308646001"
DEATH_TYPE_CONCEPT = 32817

# Fixed value: type concept of a cost row.
COST_TYPE_CONCEPT = 32814

# Gender concepts.
GENDER_CONCEPTS = {"M": 8507, "F": 8532}


def location(places: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct places with an id over all their columns (own definition)."""
    distinct = places.select(columns).distinct()
    return with_surrogate_id(distinct, "location_id", columns).withColumn(
        "location_source_value", F.concat_ws("|", *columns)
    )


def care_site(sites: DataFrame, name: str, place: str) -> DataFrame:
    """Distinct sites of care with an id (own definition)."""
    distinct = sites.select(
        F.col(name).alias("care_site_name"), F.col(place).alias("place_of_service_source_value")
    ).distinct()
    return with_surrogate_id(
        distinct, "care_site_id", ["care_site_name", "place_of_service_source_value"]
    ).withColumn("place_of_service_concept_id", F.lit(0))


def provider(providers: DataFrame, source_value: str, name: str) -> DataFrame:
    """Distinct providers with an id (own definition)."""
    distinct = providers.select(
        F.col(source_value).cast("string").alias("provider_source_value"),
        F.col(name).alias("provider_name"),
    ).distinct()
    return with_surrogate_id(
        distinct, "provider_id", ["provider_source_value", "provider_name"]
    ).withColumn("specialty_concept_id", F.lit(0))


def gender_concept(col: Column | str) -> Column:
    c = F.upper(as_column(col))
    expr = F.when(F.lit(False), F.lit(0))
    for code, concept in GENDER_CONCEPTS.items():
        expr = expr.when(c == code, F.lit(concept))
    return expr.otherwise(F.lit(0))


def with_state_abbreviation(patients: DataFrame, states: DataFrame) -> DataFrame:
    """Patients with their state's full name replaced by its abbreviation."""
    known = states.select("state", "state_abbreviation")
    return (
        patients.join(known, "state", "left")
        .withColumn("state", F.col("state_abbreviation"))
        .drop("state_abbreviation")
    )


def person(patients: DataFrame, locations: DataFrame, place: list[str]) -> DataFrame:
    """One row per patient ``id``, numbered by it (own definition).

    ``patients`` has ``id, birthdate (date), gender`` and the ``place`` columns,
    by which the location is found; nulls among them count as equal.
    """
    p, where = patients.alias("p"), locations.alias("w")
    same_place = reduce(lambda a, b: a & b, [F.col(f"p.{c}").eqNullSafe(F.col(f"w.{c}")) for c in place])
    rows = p.join(where, same_place, "left").select(
        gender_concept("p.gender").alias("gender_concept_id"),
        F.year("p.birthdate").alias("year_of_birth"),
        F.month("p.birthdate").alias("month_of_birth"),
        F.dayofmonth("p.birthdate").alias("day_of_birth"),
        F.lit(0).alias("race_concept_id"),
        F.lit(0).alias("ethnicity_concept_id"),
        F.col("w.location_id"),
        F.col("p.id").alias("person_source_value"),
        F.col("p.gender").alias("gender_source_value"),
    )
    return with_surrogate_id(rows, "person_id", ["person_source_value"])


def observation_period(encounters: DataFrame, person_rows: DataFrame, period_type: int = 32882) -> DataFrame:
    """First to last day of any encounter of a person (own definition)."""
    spans = encounters.groupBy("patient").agg(
        F.min("start_date").alias("observation_period_start_date"),
        F.max("stop_date").alias("observation_period_end_date"),
    )
    rows = spans.join(
        person_rows.select("person_id", F.col("person_source_value").alias("patient")), "patient"
    ).drop("patient")
    return with_surrogate_id(rows, "observation_period_id", ["person_id"]).withColumn(
        "period_type_concept_id", F.lit(period_type)
    )


def _deaths(day: Column, cause: Column, cause_source: Column) -> list[Column]:
    return [
        F.col("person_id"),
        day.alias("death_date"),
        day.cast("timestamp").alias("death_datetime"),
        F.lit(DEATH_TYPE_CONCEPT).alias("death_type_concept_id"),
        cause.cast("long").alias("cause_concept_id"),
        cause_source.cast("string").alias("cause_source_value"),
        F.lit(0).alias("cause_source_concept_id"),
    ]


def certified_deaths(
    encounters: DataFrame, person_rows: DataFrame, reasons: DataFrame, code: str = DEATH_CERTIFICATION_CODE
) -> DataFrame:
    """Deaths from certification events, with the mapped reason as cause.

    ``encounters`` has ``patient, code, start_date, reasoncode``; ``reasons`` maps
    ``reasoncode`` to ``cause_concept_id``, 0 when there is none.
    """
    people = person_rows.select("person_id", F.col("person_source_value").alias("patient"))
    return (
        encounters.filter(F.col("code") == code)
        .join(people, "patient")
        .join(reasons, "reasoncode", "left")
        .select(
            *_deaths(
                F.col("start_date"), F.coalesce("cause_concept_id", F.lit(0)), F.col("reasoncode")
            )
        )
    )


def recovered_deaths(
    patients: DataFrame, encounters: DataFrame, person_rows: DataFrame, code: str = DEATH_CERTIFICATION_CODE
) -> DataFrame:
    """Deaths known from the patient row alone: a date but no certification event.

    No cause is recorded for them, so it is 0.
    """
    certified = encounters.filter(F.col("code") == code).select(F.col("patient").alias("id")).distinct()
    dated = patients.select("id", death_date("deathdate").alias("_day")).filter("_day is not null")
    people = person_rows.select("person_id", F.col("person_source_value").alias("id"))
    return (
        dated.join(certified, "id", "left_anti")
        .join(people, "id")
        .select(*_deaths(F.col("_day"), F.lit(0), typed_null("string")))
    )


def death(patients: DataFrame, encounters: DataFrame, person_rows: DataFrame, reasons: DataFrame,
          code: str = DEATH_CERTIFICATION_CODE) -> DataFrame:
    """Certified deaths, and those recovered from the patient rows."""
    return certified_deaths(encounters, person_rows, reasons, code).unionByName(
        recovered_deaths(patients, encounters, person_rows, code)
    )


def payer_plan_period(
    payers: DataFrame, transitions: DataFrame, patients: DataFrame, person_rows: DataFrame
) -> DataFrame:
    """Payer, transition, patient and person joined, numbered (own definition).

    ``payers`` has ``payer, payer_name``; ``transitions`` has ``patient, payer,
    start_date, end_date``. Equal transitions make one period.
    """
    people = person_rows.select("person_id", F.col("person_source_value").alias("patient"))
    rows = (
        transitions.select("patient", "payer", "start_date", "end_date")
        .distinct()
        .join(payers.select("payer", "payer_name"), "payer")
        .join(patients.select(F.col("id").alias("patient")), "patient", "left_semi")
        .join(people, "patient")
        .select(
            "person_id",
            F.col("start_date").alias("payer_plan_period_start_date"),
            F.col("end_date").alias("payer_plan_period_end_date"),
            F.lit(0).alias("payer_concept_id"),
            F.col("payer_name").alias("payer_source_value"),
            F.lit(0).alias("plan_concept_id"),
        )
    )
    return with_surrogate_id(
        rows,
        "payer_plan_period_id",
        [
            "person_id",
            "payer_plan_period_start_date",
            "payer_plan_period_end_date",
            "payer_source_value",
        ],
    )


def owned_days(plan_periods: DataFrame) -> DataFrame:
    """The days on which each plan period is the first of its person to apply.

    Periods are numbered by start, so the smallest id holding a day belongs to
    the earliest start. A period therefore owns the days after the latest end of
    the periods before it, up to its own end. Owned days never overlap, so a
    claim meets at most one period per day.
    """
    start, end = F.col("payer_plan_period_start_date"), F.col("payer_plan_period_end_date")
    earlier = (
        Window.partitionBy("person_id")
        .orderBy("payer_plan_period_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        plan_periods.withColumn("_covered", F.max(end).over(earlier))
        .select(
            "person_id",
            "payer_plan_period_id",
            F.greatest(start, F.date_add("_covered", 1)).alias("owned_from"),
            end.alias("owned_to"),
        )
        .filter("owned_from <= owned_to")
    )


def claim_costs(claims: DataFrame, transactions: DataFrame, plan_periods: DataFrame) -> DataFrame:
    """Charges and payments per claim, with the plan period of the service date.

    ``claims`` has ``claim_id, person_id, encounter_id, service_date``;
    ``transactions`` has ``claim_id, transfer_type, amount``. The transactions,
    by far the largest input, are summed per claim before anything joins them.
    Of several plan periods holding the date the smallest id counts. An amount that
    is no number or out of range counts for nothing (:func:`refused_amounts`).

    The period of a day is the last one that owns days from then or before: periods
    and days of a person are put together in one order, at most one row per calendar
    day of either kind, so neither open-ended periods nor busy persons make it large.
    """
    # Exact sums, so that they do not depend on the order of addition.
    amount = F.col("amount").try_cast("decimal(18,4)")
    sums = transactions.groupBy("claim_id").agg(
        F.sum(F.when(F.col("transfer_type") == "CHARGE", amount)).cast("double").alias("total_charge"),
        F.sum(F.when(F.col("transfer_type") == "PAYMENT", amount)).cast("double").alias("total_paid"),
    )
    owned = owned_days(plan_periods)
    days = claims.select("person_id", F.col("service_date").alias("_day")).filter("_day is not null").distinct()
    period = F.struct("owned_to", "payer_plan_period_id")
    both = owned.select("person_id", F.col("owned_from").alias("_day"), period.alias("_period")).unionByName(
        days.withColumn("_period", F.lit(None).cast("struct<owned_to:date,payer_plan_period_id:bigint>"))
    )
    upto = Window.partitionBy("person_id").orderBy("_day").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    plan_of = (
        both.withColumn("_last", F.last("_period", ignorenulls=True).over(upto))
        .filter("_period is null and _day <= _last.owned_to")
        .select("person_id", F.col("_day").alias("service_date"), F.col("_last.payer_plan_period_id").alias("payer_plan_period_id"))
    )
    return claims.join(sums, "claim_id").join(plan_of, ["person_id", "service_date"], "left")


def refused_amounts(transactions: DataFrame) -> DataFrame:
    """How many amounts of each kind of transaction cannot be counted."""
    refused = F.col("amount").isNotNull() & F.col("amount").try_cast("decimal(18,4)").isNull()
    return transactions.groupBy("transfer_type").agg(F.count(F.when(refused, 1)).alias("refused_amounts"))


def billable(events: DataFrame, event_id: str, domain: str) -> DataFrame:
    """Events of one domain as a branch of the cost table."""
    return events.select(
        F.col(event_id).alias("cost_event_id"),
        F.lit(domain).alias("cost_domain_id"),
        F.col("encounter").alias("encounter_id"),
        "person_id",
    )


def cost(costs: DataFrame, branches: list[DataFrame]) -> DataFrame:
    """Costs of the billed events of all branches (own definition).

    The branches are put together before they meet the costs of their encounter
    and person, so both are read and shuffled once.
    """
    rows = (
        reduce(DataFrame.unionByName, branches)
        .join(costs, ["encounter_id", "person_id"])
        .select(
            "cost_event_id",
            "claim_id",
            "cost_domain_id",
            F.lit(COST_TYPE_CONCEPT).alias("cost_type_concept_id"),
            "total_charge",
            "total_paid",
            "payer_plan_period_id",
        )
    )
    return with_surrogate_id(rows, "cost_id", ["cost_domain_id", "cost_event_id", "claim_id"])


def cdm_source(name: str, abbreviation: str, holder: str, vocabulary: DataFrame,
               released: str, version: str = "v5.4") -> DataFrame:
    """One row about the dataset; the vocabulary version is read from its table."""
    row = vocabulary.agg(
        F.max(F.when(F.col("vocabulary_id") == "None", F.col("vocabulary_version"))).alias("vocabulary_version")
    )
    return row.select(
        F.lit(name).alias("cdm_source_name"),
        F.lit(abbreviation).alias("cdm_source_abbreviation"),
        F.lit(holder).alias("cdm_holder"),
        F.lit(released).cast("date").alias("cdm_release_date"),
        F.lit(version).alias("cdm_version"),
        "vocabulary_version",
    )
