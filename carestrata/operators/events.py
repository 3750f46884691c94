"""Coded events to domain rows of the common data model.

Events carry ``patient, encounter, code`` and whatever dates and values their
table has. The domain of the concept a code maps to decides the table of its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestrata.functions.codes import is_valid_standard
from carestrata.functions.parsing import text_prefix, tolerant_double, typed_null
from carestrata.operators.visits import DETAIL_ID_OFFSET
from carestrata.runtime import broadcast_for

# Type concept of rows taken from observation records.
OBSERVATION_TYPE_CONCEPT = 38000280

# Vocabularies whose codes are only mapped to concepts of their own.
OWN_TARGETS = ("SNOMED", "HCPCS")


def standard_targets(standard_map: DataFrame, domain: str, vocabulary: str) -> DataFrame:
    """Valid standard targets of one domain and vocabulary, per source code."""
    return standard_map.filter(
        (F.col("target_domain_id") == domain)
        & (F.col("target_vocabulary_id") == vocabulary)
        & is_valid_standard("target_standard_concept", "target_invalid_reason")
    ).select(F.col("source_code").alias("code"), "target_concept_id")


def code_map(
    standard_map: DataFrame, source_map: DataFrame, domains: list[str], vocabularies: list[str]
) -> DataFrame:
    """Target and source concept per code, for some domains and vocabularies.

    A row is for a ``code`` of a ``vocabulary``, the one the code is written in. A
    target counts with the source concept of the same code, vocabulary and domain;
    codes of ``OWN_TARGETS`` take targets of their own vocabulary only, others those
    of any. Both maps are joined before the events see them, so the events are joined
    once, however many vocabularies a domain takes. A code with several targets keeps
    all of them: each is a row of its own in the result.
    """
    own = ~F.col("source_vocabulary_id").isin(*OWN_TARGETS) | (
        F.col("source_vocabulary_id") == F.col("target_vocabulary_id")
    )
    targets = standard_map.filter(
        F.col("target_domain_id").isin(domains)
        & F.col("source_vocabulary_id").isin(vocabularies)
        & own
        & is_valid_standard("target_standard_concept", "target_invalid_reason")
    ).select(
        F.col("source_code").alias("code"),
        F.col("source_vocabulary_id").alias("vocabulary"),
        "target_domain_id",
        "target_concept_id",
    )
    sources = source_map.filter(
        F.col("source_vocabulary_id").isin(vocabularies) & F.col("source_domain_id").isin(domains)
    ).select(
        F.col("source_code").alias("code"),
        F.col("source_vocabulary_id").alias("vocabulary"),
        F.col("source_domain_id").alias("target_domain_id"),
        "source_concept_id",
    )
    return targets.join(sources, ["code", "vocabulary", "target_domain_id"])


def unmapped_events(events: DataFrame, codes: DataFrame) -> DataFrame:
    """Per ``source_table`` its events, and those whose code has no target in their systems."""
    known = codes.groupBy("code").agg(F.collect_set("vocabulary").alias("_known"))
    mapped = F.coalesce(F.arrays_overlap("systems", "_known"), F.lit(False))
    return (
        events.join(known, "code", "left")
        .groupBy("source_table")
        .agg(F.count(F.lit(1)).alias("events"), F.count(F.when(~mapped, 1)).alias("unmapped"))
    )


def encounter_context(encounters: DataFrame, final_ids: DataFrame, provider: DataFrame) -> DataFrame:
    """Visit, patient and provider of every encounter, so events look it up once."""
    by_source = provider.select("provider_id", F.col("provider_source_value").alias("provider"))
    return (
        encounters.select("encounter_id", F.col("patient").alias("_patient"), "provider")
        .join(by_source, "provider", "left")
        .join(final_ids, "encounter_id", "left")
        .select(
            F.col("encounter_id").alias("encounter"),
            "_patient",
            "provider_id",
            F.col("visit_occurrence_id_new").alias("visit_occurrence_id"),
        )
    )


def map_events(
    events: DataFrame,
    codes: DataFrame,
    encounters: DataFrame,
    final_ids: DataFrame,
    provider: DataFrame,
    person: DataFrame,
) -> DataFrame:
    """Events with person, target and source concept, visit, detail and provider.

    Events whose code has no target, or whose patient is unknown, are left out;
    those without a visit or provider stay with nulls. The provider counts only
    when the encounter belongs to the event's own patient. Events with a column
    ``systems`` take the targets of those vocabularies only, so a code that several
    vocabularies use means what it means in the event's own table.

    The map holds a row per code and is broadcast after a check of its size; the
    events then shuffle by encounter, which events joined to theirs need not do again, and
    by patient. Adaptive execution splits a
    busy patient or the events without an encounter over several tasks, since
    the other side is unique per key.
    """
    targets = broadcast_for(codes, events, "code", "codes")
    people = person.select("person_id", F.col("person_source_value").alias("patient"))
    context = encounter_context(encounters, final_ids, provider)
    coded = events.join(targets, "code")
    if "systems" in events.columns:
        coded = coded.filter(F.array_contains("systems", F.col("vocabulary"))).drop("systems")
    return (
        coded.drop("vocabulary")
        .join(context, "encounter", "left")
        .join(people, "patient")
        .withColumn("provider_id", F.when(F.col("patient") == F.col("_patient"), F.col("provider_id")))
        .withColumn("visit_detail_id", F.col("visit_occurrence_id") + DETAIL_ID_OFFSET)
        .drop("_patient")
    )


def _shared(prefix: str, type_concept: Column) -> dict[str, Column]:
    return {
        "person_id": F.col("person_id"),
        f"{prefix}_concept_id": F.col("target_concept_id"),
        f"{prefix}_type_concept_id": type_concept,
        "provider_id": F.col("provider_id"),
        "visit_occurrence_id": F.col("visit_occurrence_id"),
        "visit_detail_id": F.col("visit_detail_id"),
        f"{prefix}_source_value": F.col("code"),
        f"{prefix}_source_concept_id": F.col("source_concept_id"),
    }


def _project(mapped: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return mapped.select(*[c.alias(name) for name, c in columns.items()])


def observation(mapped: DataFrame, type_concept: int = OBSERVATION_TYPE_CONCEPT) -> DataFrame:
    """Observation rows; needs ``date, value, units``."""
    zero = F.lit(0)
    return _project(
        mapped,
        _shared("observation", F.lit(type_concept))
        | {
            "observation_date": F.col("date"),
            "observation_datetime": F.col("date").cast("timestamp"),
            "value_as_number": tolerant_double("value"),
            "value_as_string": typed_null("string"),
            "value_as_concept_id": zero,
            "qualifier_concept_id": zero,
            "unit_concept_id": zero,
            "unit_source_value": text_prefix("units"),
            "qualifier_source_value": typed_null("string"),
            "value_source_value": text_prefix("value"),
            "observation_event_id": typed_null("long"),
            "obs_event_field_concept_id": typed_null("int"),
        },
    )


def measurement(mapped: DataFrame, type_concept: int) -> DataFrame:
    """Measurement rows; needs ``date, value, units``."""
    return _project(
        mapped,
        _shared("measurement", F.lit(type_concept))
        | {
            "measurement_date": F.col("date"),
            "value_as_number": tolerant_double("value"),
            "value_as_concept_id": F.lit(0),
            "unit_concept_id": F.lit(0),
            "unit_source_value": text_prefix("units"),
            "value_source_value": text_prefix("value"),
        },
    )


def procedure_occurrence(mapped: DataFrame, type_concept: int) -> DataFrame:
    """Procedure rows; needs ``date``."""
    return _project(
        mapped,
        _shared("procedure", F.lit(type_concept))
        | {"procedure_date": F.col("date"), "quantity": typed_null("int")},
    )


def condition_occurrence(mapped: DataFrame, type_concept: int) -> DataFrame:
    """Condition rows; needs ``start_date`` and ``stop_date``."""
    return _project(
        mapped,
        _shared("condition", F.lit(type_concept))
        | {
            "condition_start_date": F.col("start_date"),
            "condition_end_date": F.col("stop_date"),
        },
    )


def drug_exposure(mapped: DataFrame, type_concept: int) -> DataFrame:
    """Drug rows; needs ``start_date`` and ``stop_date``.

    The supply is the number of days to the end, null while the end is open.
    """
    return _project(
        mapped,
        _shared("drug", F.lit(type_concept))
        | {
            "drug_exposure_start_date": F.col("start_date"),
            "drug_exposure_end_date": F.col("stop_date"),
            "days_supply": F.datediff("stop_date", "start_date"),
        },
    )


def device_exposure(mapped: DataFrame, type_concept: int) -> DataFrame:
    """Device rows; needs ``start_date`` and ``stop_date``."""
    return _project(
        mapped,
        _shared("device", F.lit(type_concept))
        | {
            "device_exposure_start_date": F.col("start_date"),
            "device_exposure_end_date": F.col("stop_date"),
        },
    )
