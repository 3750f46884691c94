"""From staging tables to a complete dataset, and from a dataset to its checks.

Each table is a DataFrame function of the ones before it; the only actions are
the writes, plus the size checks ahead of broadcasts. The order is: maps, visit
tables, the nineteen model tables, and the tables that stay empty.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata.functions.parsing import staging_date
from carestrata.operators import demographics, events, intervals, quality, rules, sketches, visits, vocab
from carestrata.operators.ids import with_copy_number, with_lasting_id, with_surrogate_id
from carestrata.runtime import materialise, scratch
from carestrata.schema import MAP_TABLES, POPULATED, REQUIRED_VOCABULARY, VISIT_TABLES
from carestrata.sources import datasets, quarantine

# Vocabularies whose codes occur in the staging tables, and the
# type concept of a record taken from them.
CODE_VOCABULARIES = ["SNOMED", "LOINC", "RxNorm", "CVX", "HCPCS", "CPT4", "ICD10CM"]
RECORD_TYPE_CONCEPT = 32827

PLACE = ["city", "state", "county", "zip"]

#: Tables whose keys are checked.
RULED_TABLES = ("person", "visit_occurrence", "condition_occurrence", "drug_exposure", "procedure_occurrence", "measurement")

#: Report of a build: events per staging table, and those whose code has no target.
UNMAPPED = "unmapped_events"

# Staging tables of coded events, with the columns that hold begin and end, and the
# vocabularies that their codes are written in.
CODED_TABLES = {
    "conditions": ("start", "stop", ("SNOMED", "ICD10CM")),
    "observations": ("date", "date", ("SNOMED", "LOINC")),
    "procedures": ("start", "stop", ("SNOMED", "CPT4", "HCPCS")),
    "medications": ("start", "stop", ("RxNorm",)),
    "immunizations": ("date", "date", ("CVX",)),
    "devices": ("start", "stop", ("SNOMED", "HCPCS")),
    "allergies": ("start", "stop", ("SNOMED", "RxNorm")),
}

# Target domain, its table, and the name of that table's id.
DOMAIN_TABLES = {
    "Condition": ("condition_occurrence", events.condition_occurrence),
    "Measurement": ("measurement", events.measurement),
    "Procedure": ("procedure_occurrence", events.procedure_occurrence),
    "Drug": ("drug_exposure", events.drug_exposure),
    "Device": ("device_exposure", events.device_exposure),
    "Observation": ("observation", events.observation),
}
BILLED = {"Condition": "condition", "Procedure": "procedure", "Drug": "drug", "Device": "device"}


def _or_null(df: DataFrame, *names: str) -> DataFrame:
    """Add the named text columns that a source does not have, as nulls."""
    absent = {n: F.lit(None).cast("string") for n in names if n not in df.columns}
    return df.withColumns(absent) if absent else df


def typed_encounters(encounters: DataFrame) -> DataFrame:
    """Encounters with dates; the discharge code is null where a source lacks it."""
    return _or_null(encounters, "discharge", "reasoncode").select(
        F.col("id").alias("encounter_id"),
        "patient",
        "encounterclass",
        staging_date("start").alias("start_date"),
        staging_date("stop").alias("stop_date"),
        "provider",
        "code",
        "reasoncode",
        "discharge",
    )


def typed_patients(patients: DataFrame, states: DataFrame) -> DataFrame:
    """Patients with a birth date and the abbreviation of their state."""
    typed = _or_null(patients, *PLACE, "gender", "deathdate").withColumn("birthdate", staging_date("birthdate"))
    return demographics.with_state_abbreviation(typed, states)


def coded_events(staging: dict[str, DataFrame], tables: dict[str, tuple] = CODED_TABLES) -> DataFrame:
    """All coded staging rows in one frame; a code's domain decides its table.

    ``systems`` are the vocabularies of the table a row comes from: the same code may
    mean something else in another one.
    """
    found = [
        _or_null(staging[name], "value", "units", "stop").select(
            "patient",
            "encounter",
            "code",
            staging_date(begin).alias("date"),
            staging_date(begin).alias("start_date"),
            staging_date(end).alias("stop_date"),
            "value",
            "units",
            F.lit(name).alias("source_table"),
            F.lit(list(systems)).alias("systems"),
        )
        for name, (begin, end, systems) in tables.items()
        if name in staging
    ]
    return reduce(DataFrame.unionByName, found)


def build_dataset(
    spark: SparkSession,
    staging: dict[str, DataFrame],
    vocabulary: dict[str, DataFrame],
    states: DataFrame,
    target: str,
    released: str,
    coded_tables: dict[str, tuple] = CODED_TABLES,
    registry: str | None = None,
) -> None:
    """Build every table of the model below ``target``, replacing what is there.

    ``staging`` holds text tables by name, ``vocabulary`` typed ones; ``states``
    maps state names to abbreviations; ``coded_tables`` says which staging tables hold
    codes, between which dates and of which vocabularies. With a ``registry`` folder, ids
    of visits and of coded events last over builds. Without a loaded vocabulary nothing is built.
    Tables of an earlier build are cleared first, so that a build that fails leaves
    none of them beside new ones, and what is stored on the way is removed at the end.
    """
    empty = [name for name in REQUIRED_VOCABULARY if name not in vocabulary or vocabulary[name].isEmpty()]
    if empty:
        raise ValueError(f"vocabulary tables without rows: {', '.join(empty)}")
    datasets.clear_tables(spark, target, [*POPULATED, *MAP_TABLES, *VISIT_TABLES, UNMAPPED])
    with scratch(spark):
        _build(spark, staging, vocabulary, states, target, released, coded_tables, registry)


def _build(
    spark: SparkSession,
    staging: dict[str, DataFrame],
    vocabulary: dict[str, DataFrame],
    states: DataFrame,
    target: str,
    released: str,
    coded_tables: dict[str, tuple],
    registry: str | None,
) -> None:
    def numbered(df: DataFrame, table: str) -> DataFrame:
        """Rows equal in every column are interchangeable, so all columns are a total order."""
        if registry is None:
            return with_surrogate_id(df, f"{table}_id", df.columns)
        single = with_copy_number(df)
        return with_lasting_id(single, f"{table}_id", single.columns, f"{registry}/{table}").drop("copy")

    def save(df: DataFrame, name: str) -> DataFrame:
        datasets.write_table(df, target, name)
        return datasets.open_table(spark, target, name)

    def save_model(df: DataFrame, name: str) -> DataFrame:
        return save(datasets.conform(df, name), name)

    concept, relationship = vocabulary["concept"], vocabulary["concept_relationship"]
    closure, custom = vocabulary["concept_ancestor"], vocabulary.get("source_to_concept_map")

    standard = save(vocab.source_to_standard_map(concept, relationship, custom), "source_to_standard_vocab_map")
    source = save(vocab.source_to_source_map(concept, custom), "source_to_source_vocab_map")
    save(vocab.states_map(states, concept), "states_map")

    encounters = materialise(typed_encounters(staging["encounters"]), "encounters")
    patients = typed_patients(staging["patients"], states)
    rolled = save(visits.all_visits(encounters, registry=registry and f"{registry}/visit_occurrence"), "all_visits")
    final_ids = save(visits.resolve_visits(encounters, rolled), "final_visit_ids")

    location = materialise(demographics.location(patients, PLACE), "location")
    save_model(location, "location")
    person = save_model(demographics.person(patients, location, PLACE), "person")
    save_model(demographics.care_site(staging["organizations"], "name", "id"), "care_site")
    provider = save_model(demographics.provider(staging["providers"], "id", "name"), "provider")
    save_model(demographics.observation_period(encounters, person), "observation_period")

    occurrence = visits.visit_occurrence(rolled, final_ids, person)
    save_model(visits.enrich_discharge(occurrence, final_ids, encounters, concept, relationship), "visit_occurrence")
    save_model(visits.visit_detail(rolled, final_ids, person), "visit_detail")

    # One pass over the texts of all coded events; each domain then reads its own folder.
    routes = events.code_map(standard, source, list(DOMAIN_TABLES), CODE_VOCABULARIES)
    coded = materialise(coded_events(staging, coded_tables), "coded")
    save(events.unmapped_events(coded, routes), UNMAPPED)
    mapped = materialise(
        events.map_events(coded, routes, encounters, final_ids, provider, person),
        "mapped",
        by="target_domain_id",
    )
    billed = []
    for domain, (name, project) in DOMAIN_TABLES.items():
        own = mapped.filter(F.col("target_domain_id") == domain)
        table = project(own) if domain == "Observation" else project(own, RECORD_TYPE_CONCEPT)
        save_model(numbered(table, name), name)
        if domain in BILLED:
            distinct = own.select("person_id", "encounter", "code", "date").distinct()
            events_of = with_surrogate_id(distinct, "event_id", distinct.columns)
            billed.append(demographics.billable(events_of, "event_id", domain))

    exposures = datasets.open_table(spark, target, "drug_exposure")
    save_model(intervals.with_era_id(intervals.drug_eras(exposures, concept, closure), "drug"), "drug_era")
    conditions = datasets.open_table(spark, target, "condition_occurrence")
    save_model(intervals.with_era_id(intervals.condition_eras(conditions), "condition"), "condition_era")

    causes = (
        events.standard_targets(standard, "Condition", "SNOMED")
        .groupBy(F.col("code").alias("reasoncode"))
        .agg(F.min("target_concept_id").alias("cause_concept_id"))
    )
    save_model(demographics.death(_or_null(staging["patients"], "deathdate"), encounters, person, causes), "death")

    payers = staging["payers"].select(F.col("id").alias("payer"), F.col("name").alias("payer_name"))
    transitions = staging["payer_transitions"].select(
        "patient", "payer", staging_date("start_date").alias("start_date"), staging_date("end_date").alias("end_date")
    )
    plans = save_model(
        demographics.payer_plan_period(payers, transitions, staging["patients"], person), "payer_plan_period"
    )
    people = person.select("person_id", F.col("person_source_value").alias("patientid"))
    claims = (
        staging["claims"]
        .join(people, "patientid")
        .select(
            F.col("id").alias("claim_id"),
            "person_id",
            F.col("appointmentid").alias("encounter_id"),
            staging_date("servicedate").alias("service_date"),
        )
    )
    claims = materialise(claims, "claims")
    moves = staging["claims_transactions"].select(
        F.col("claimid").alias("claim_id"),
        F.col("type").alias("transfer_type"),
        "amount",
    )
    save_model(demographics.cost(demographics.claim_costs(claims, moves, plans), billed), "cost")
    save_model(
        demographics.cdm_source("synthetic patients", "SYN", "", vocabulary["vocabulary"], released), "cdm_source"
    )
    datasets.ensure_tables(spark, target)


def rule_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Keys of the model: ids are unique, and rows belong to a known person."""
    person = tables["person"]
    checks = [quality.primary_key_check(df, name, [f"{name}_id"]) for name, df in tables.items()]
    checks += [
        quality.foreign_key_check(df, name, "person_id", person, "person_id") for name, df in tables.items() if name != "person"
    ]
    return quality.check_results(checks)


def _rules_of_events(start: str, end: str, concept: str | None = None) -> list[rules.Rule]:
    """Rules of a table of dated events (own definitions): dates fit the person's life."""
    return [
        rules.Rule("is_required", start),
        rules.Rule("starts_before_end", start, end),
        rules.Rule("is_known_person", "person_id"),
        rules.Rule("plausible_after_birth", start, None, 1.0),
        rules.Rule("plausible_before_death", start, 60, 1.0),
        rules.Rule("within_observation", start, None, 5.0),
    ] + ([rules.Rule("concept_recorded", concept, None, 5.0)] if concept else [])


#: Rules of the built tables; thresholds are percentages of rows.
CLINICAL_RULES = {
    "visit_occurrence": _rules_of_events("visit_start_date", "visit_end_date"),
    "condition_occurrence": _rules_of_events("condition_start_date", "condition_end_date", "condition_concept_id"),
    "drug_exposure": _rules_of_events("drug_exposure_start_date", "drug_exposure_end_date", "drug_concept_id"),
}


def clinical_checks(spark: SparkSession, dataset: str) -> DataFrame:
    """The clinical rules over a built dataset; persons' lives are stored once and read per table."""
    table = lambda name: datasets.open_table(spark, dataset, name)
    life = materialise(rules.lives(table("person"), table("death"), table("observation_period")), "lives")
    return rules.all_checks({name: table(name) for name in CLINICAL_RULES}, CLINICAL_RULES, life)


def dataset_profile(spark: SparkSession, dataset: str, names: tuple[str, ...] = RULED_TABLES) -> DataFrame:
    """Profile of every column of the named tables, each table read once."""
    made = [sketches.column_sketches(datasets.open_table(spark, dataset, name), name) for name in names]
    return sketches.sketched_profile(reduce(DataFrame.unionByName, made))


def check_dataset(
    spark: SparkSession,
    staging: dict[str, DataFrame],
    dataset: str,
    as_of_year: int,
    min_person_rows: int = quality.MIN_PERSON_ROWS,
    min_mapped_pct: float = quality.MIN_MAPPED_PCT,
    extracts: dict[str, quarantine.Extract] | None = None,
    min_accepted_pct: float = quarantine.MIN_ACCEPTED_PCT,
) -> dict[str, DataFrame]:
    """Reports on a built dataset by name; ``failures`` is empty when it passes.

    With the ``extracts`` that the staging tables were read from, rows that did not fit
    them are reported, and an extract of which too many did not fails.
    """
    table = lambda name: datasets.open_table(spark, dataset, name)
    summary = materialise(
        quality.dataset_summary(
            staging,
            table("person"),
            table("visit_occurrence"),
            table("procedure_occurrence"),
            table("condition_occurrence"),
            table("condition_era"),
            table("drug_era"),
        ),
        "summary",
    )
    gate = quality.threshold_gate(summary, min_person_rows, min_mapped_pct)
    failures = quality.stage_failures(gate, "dataset summary")
    unfit = {}
    if extracts:
        accepted = materialise(quarantine.accepted_gate(extracts, min_accepted_pct), "accepted")
        unfit = {"rejected_rows": quarantine.rejected_rows(extracts), "accepted": accepted}
        failures = failures.unionByName(quality.stage_failures(accepted, "staging"))
    checks = materialise(rule_checks({name: table(name) for name in RULED_TABLES}), "rules")
    moves = staging.get("claims_transactions")
    refused = {} if moves is None else {"refused_amounts": demographics.refused_amounts(moves.withColumnRenamed("type", "transfer_type"))}
    return refused | unfit | {
        "unmapped_events": table(UNMAPPED),
        "rule_checks": checks,
        "rule_summary": quality.check_summary(checks),
        "condition_counts": quality.concept_counts(table("condition_occurrence"), "condition_concept_id"),
        "drug_months": quality.month_counts(table("drug_exposure"), "drug_exposure_start_date"),
        "staged_counts": quality.row_counts(staging),
        "summary": quality.mapped_percentage(summary),
        "age_profile": quality.age_profile(table("person"), as_of_year),
        "discharge": quality.discharge_verdict(quality.discharge_summary(table("visit_occurrence"))),
        "gate": gate,
        "failures": failures,
    }
