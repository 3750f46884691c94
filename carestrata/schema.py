"""Schemas of the common data model, by table name.

Column types follow from the names: ids and concepts are integers, dates are
dates, and so on. Only the columns that break the rule are listed.
"""

from __future__ import annotations

from pyspark.sql import types as T

_EXCEPTIONS = {
    "language_concept_id": "long",
    "concept_code": "string",
    "domain_id": "string",
    "vocabulary_id": "string",
    "concept_class_id": "string",
    "relationship_id": "string",
    "reverse_relationship_id": "string",
    "source_vocabulary_id": "string",
    "target_vocabulary_id": "string",
    "cost_domain_id": "string",
    "condition_status_source_value": "string",
    "year_of_birth": "int",
    "month_of_birth": "int",
    "day_of_birth": "int",
    "quantity": "double",
    "days_supply": "int",
    "refills": "int",
    "gap_days": "long",
    "drug_exposure_count": "long",
    "condition_occurrence_count": "long",
    "min_levels_of_separation": "int",
    "max_levels_of_separation": "int",
    "value_as_number": "double",
    "range_low": "double",
    "range_high": "double",
    "amount_value": "double",
    "numerator_value": "double",
    "denominator_value": "double",
    "box_size": "int",
    "latitude": "double",
    "longitude": "double",
    "dose_value": "double",
    "episode_number": "int",
    "unique_device_id": "string",
    "production_id": "string",
    "specimen_source_id": "string",
    "paid_by_payer": "double",
    "paid_by_patient": "double",
    "paid_patient_copay": "double",
    "paid_patient_coinsurance": "double",
    "paid_patient_deductible": "double",
    "paid_by_primary": "double",
    "paid_ingredient_cost": "double",
    "paid_dispensing_fee": "double",
}

_SUFFIX_TYPES = (
    ("_datetime", "timestamp"),
    ("_date", "date"),
    ("_id", "long"),
    ("_id_1", "long"),
    ("_id_2", "long"),
    ("_allowed", "double"),
    ("total_charge", "double"),
    ("total_cost", "double"),
    ("total_paid", "double"),
)


def column_type(name: str) -> str:
    """Type of a column by its name."""
    if name in _EXCEPTIONS:
        return _EXCEPTIONS[name]
    return next((t for suffix, t in _SUFFIX_TYPES if name.endswith(suffix)), "string")


def _columns(text: str) -> tuple[str, ...]:
    return tuple(text.split())


def _event(prefix: str, key: str, middle: str) -> tuple[str, ...]:
    """Columns shared by every coded event, around those of its own table."""
    return _columns(
        f"{key} person_id {prefix}_concept_id {middle} {prefix}_type_concept_id provider_id "
        f"visit_occurrence_id visit_detail_id {prefix}_source_value {prefix}_source_concept_id"
    )


def _span(prefix: str) -> str:
    return " ".join(f"{prefix}_{edge}_{kind}" for edge in ("start", "end") for kind in ("date", "datetime"))


def _moment(prefix: str) -> str:
    return f"{prefix}_date {prefix}_datetime"


# Tables the pipelines fill.
POPULATED = {
    "person": _columns(
        "person_id gender_concept_id year_of_birth month_of_birth day_of_birth birth_datetime "
        "race_concept_id ethnicity_concept_id location_id provider_id care_site_id "
        "person_source_value gender_source_value gender_source_concept_id race_source_value "
        "race_source_concept_id ethnicity_source_value ethnicity_source_concept_id"
    ),
    "location": _columns("location_id address_1 address_2 city state zip county location_source_value "
        "country_concept_id country_source_value latitude longitude"),
    "care_site": _columns(
        "care_site_id care_site_name place_of_service_concept_id location_id "
        "care_site_source_value place_of_service_source_value"
    ),
    "provider": _columns(
        "provider_id provider_name npi dea specialty_concept_id care_site_id year_of_birth gender_concept_id "
        "provider_source_value specialty_source_value specialty_source_concept_id gender_source_value "
        "gender_source_concept_id"
    ),
    "observation_period": _columns(
        "observation_period_id person_id observation_period_start_date "
        "observation_period_end_date period_type_concept_id"
    ),
    "visit_occurrence": _columns(
        f"visit_occurrence_id person_id visit_concept_id {_span('visit')} visit_type_concept_id "
        "provider_id care_site_id visit_source_value visit_source_concept_id admitted_from_concept_id "
        "admitted_from_source_value discharged_to_concept_id discharged_to_source_value preceding_visit_occurrence_id"
    ),
    "visit_detail": _columns(
        f"visit_detail_id person_id visit_detail_concept_id {_span('visit_detail')} "
        "visit_detail_type_concept_id provider_id care_site_id visit_detail_source_value "
        "visit_detail_source_concept_id admitted_from_concept_id admitted_from_source_value "
        "discharged_to_concept_id discharged_to_source_value preceding_visit_detail_id parent_visit_detail_id "
        "visit_occurrence_id"
    ),
    "condition_occurrence": _event(
        "condition",
        "condition_occurrence_id",
        _span("condition") + " condition_status_concept_id stop_reason condition_status_source_value",
    ),
    "observation": _event(
        "observation",
        "observation_id",
        _moment("observation")
        + " value_as_number value_as_string value_as_concept_id qualifier_concept_id unit_concept_id "
        "unit_source_value qualifier_source_value value_source_value observation_event_id "
        "obs_event_field_concept_id",
    ),
    "measurement": _event(
        "measurement",
        "measurement_id",
        _moment("measurement")
        + " measurement_time operator_concept_id value_as_number value_as_concept_id unit_concept_id range_low "
        "range_high unit_source_value unit_source_concept_id value_source_value measurement_event_id "
        "meas_event_field_concept_id",
    ),
    "procedure_occurrence": _event("procedure", "procedure_occurrence_id", _moment("procedure")
        + " procedure_end_date procedure_end_datetime modifier_concept_id quantity modifier_source_value"),
    "drug_exposure": _event("drug", "drug_exposure_id", _span("drug_exposure")
        + " verbatim_end_date stop_reason refills quantity days_supply sig route_concept_id lot_number "
        "route_source_value dose_unit_source_value"),
    "condition_era": _columns(
        "condition_era_id person_id condition_concept_id condition_era_start_date "
        "condition_era_end_date condition_occurrence_count"
    ),
    "drug_era": _columns(
        "drug_era_id person_id drug_concept_id drug_era_start_date drug_era_end_date "
        "drug_exposure_count gap_days"
    ),
    "cdm_source": _columns(
        "cdm_source_name cdm_source_abbreviation cdm_holder source_description source_documentation_reference "
        "cdm_etl_reference source_release_date cdm_release_date cdm_version cdm_version_concept_id vocabulary_version"
    ),
    "device_exposure": _event("device", "device_exposure_id", _span("device_exposure")
        + " unique_device_id production_id quantity unit_concept_id unit_source_value unit_source_concept_id"),
    "death": _columns(
        "person_id death_date death_datetime death_type_concept_id cause_concept_id "
        "cause_source_value cause_source_concept_id"
    ),
    "payer_plan_period": _columns(
        "payer_plan_period_id person_id payer_plan_period_start_date payer_plan_period_end_date "
        "payer_concept_id payer_source_value payer_source_concept_id plan_concept_id plan_source_value "
        "plan_source_concept_id sponsor_concept_id sponsor_source_value sponsor_source_concept_id "
        "family_source_value stop_reason_concept_id stop_reason_source_value stop_reason_source_concept_id"
    ),
    "cost": _columns(
        "cost_id cost_event_id cost_domain_id cost_type_concept_id currency_concept_id total_charge total_cost "
        "total_paid paid_by_payer paid_by_patient paid_patient_copay paid_patient_coinsurance "
        "paid_patient_deductible paid_by_primary paid_ingredient_cost paid_dispensing_fee payer_plan_period_id "
        "amount_allowed revenue_code_concept_id revenue_code_source_value drg_concept_id drg_source_value"
    ),
}

# Tables that must exist and stay empty.
UNPOPULATED = {
    "note": _columns(
        "note_id person_id note_date note_datetime note_type_concept_id note_class_concept_id note_title note_text "
        "encoding_concept_id language_concept_id provider_id visit_occurrence_id visit_detail_id note_source_value "
        "note_event_id note_event_field_concept_id"
    ),
    "note_nlp": _columns(
        "note_nlp_id note_id section_concept_id snippet offset lexical_variant note_nlp_concept_id "
        "note_nlp_source_concept_id nlp_system nlp_date nlp_datetime term_exists term_temporal term_modifiers"
    ),
    "specimen": _columns(
        "specimen_id person_id specimen_concept_id specimen_type_concept_id specimen_date specimen_datetime "
        "quantity unit_concept_id anatomic_site_concept_id disease_status_concept_id specimen_source_id "
        "specimen_source_value unit_source_value anatomic_site_source_value disease_status_source_value"
    ),
    "fact_relationship": _columns(
        "domain_concept_id_1 fact_id_1 domain_concept_id_2 fact_id_2 relationship_concept_id"
    ),
    "dose_era": _columns(
        "dose_era_id person_id drug_concept_id unit_concept_id dose_value dose_era_start_date dose_era_end_date"
    ),
    "episode": _columns(
        "episode_id person_id episode_concept_id episode_start_date episode_start_datetime episode_end_date "
        "episode_end_datetime episode_parent_id episode_number episode_object_concept_id episode_type_concept_id "
        "episode_source_value episode_source_concept_id"
    ),
    "episode_event": _columns("episode_id event_id episode_event_field_concept_id"),
    "metadata": _columns(
        "metadata_id metadata_concept_id metadata_type_concept_id name value_as_string value_as_concept_id "
        "value_as_number metadata_date metadata_datetime"
    ),
}

VOCABULARY = {
    "concept": _columns(
        "concept_id concept_name domain_id vocabulary_id concept_class_id standard_concept "
        "concept_code valid_start_date valid_end_date invalid_reason"
    ),
    "concept_ancestor": _columns(
        "ancestor_concept_id descendant_concept_id min_levels_of_separation max_levels_of_separation"
    ),
    "concept_class": _columns("concept_class_id concept_class_name concept_class_concept_id"),
    "concept_relationship": _columns(
        "concept_id_1 concept_id_2 relationship_id valid_start_date valid_end_date invalid_reason"
    ),
    "concept_synonym": _columns("concept_id concept_synonym_name language_concept_id"),
    "domain": _columns("domain_id domain_name domain_concept_id"),
    "drug_strength": _columns(
        "drug_concept_id ingredient_concept_id amount_value amount_unit_concept_id numerator_value "
        "numerator_unit_concept_id denominator_value denominator_unit_concept_id box_size "
        "valid_start_date valid_end_date invalid_reason"
    ),
    "relationship": _columns(
        "relationship_id relationship_name is_hierarchical defines_ancestry reverse_relationship_id "
        "relationship_concept_id invalid_reason"
    ),
    "vocabulary": _columns(
        "vocabulary_id vocabulary_name vocabulary_reference vocabulary_version vocabulary_concept_id"
    ),
    "source_to_concept_map": _columns(
        "source_code source_concept_id source_vocabulary_id source_code_description target_concept_id "
        "target_vocabulary_id valid_start_date valid_end_date invalid_reason"
    ),
}

# Without these three a vocabulary is of no use.
REQUIRED_VOCABULARY = ("concept", "concept_ancestor", "concept_relationship")

# Tables derived while building; the first three map codes, the others visits.
MAP_TABLES = ("source_to_standard_vocab_map", "source_to_source_vocab_map", "states_map")
VISIT_TABLES = ("all_visits", "assign_all_visit_ids", "final_visit_ids")

ALL_TABLES = POPULATED | UNPOPULATED | VOCABULARY


def table_schema(name: str) -> T.StructType:
    """Schema of a table, all columns nullable."""
    ddl = ", ".join(f"`{c}` {column_type(c)}" for c in ALL_TABLES[name])
    return T.StructType.fromDDL(ddl.replace(" long", " bigint"))
