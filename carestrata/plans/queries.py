"""Registered queries: every operator over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata.functions import codes as code_fn
from carestrata.functions import encounter_classes as classes
from carestrata.functions import parsing
from carestrata.operators import (
    cohorts,
    coverage,
    demographics,
    documents,
    edges,
    events,
    fingerprints,
    intervals,
    quality,
    rules,
    search,
    sketches,
    visits,
    vocab,
    windows,
)
from carestrata.operators.ids import with_surrogate_id
from carestrata.plans import pipeline
from carestrata.plans.bindings import BILLED_DOMAINS, CLINICAL_TYPE, PLACE, VOCABULARIES, Bound
from carestrata.runtime import materialise, scratch_path
from carestrata.schema import POPULATED, UNPOPULATED
from carestrata.sources import datasets, delimited, manifest, quarantine
from carestrata.streaming.staging import stage_new_files

Query = Callable[[Bound], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a function of the bound inputs under its own name."""
    _REGISTRY[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def over(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: fn(Bound(spark, folder))

    return {name: over(fn) for name, fn in _REGISTRY.items()}


# -- scans and sinks ---------------------------------------------------------


def _customer_extract(b: Bound) -> DataFrame:
    return b.table("customer").selectExpr(
        "cast(c_custkey as string) as C_CUSTKEY",
        "if(c_acctbal < 0, 'NULL', concat(c_name, ', \"', c_mktsegment, '\"')) as C_NAME",
        "if(c_mktsegment = 'BUILDING', '', c_mktsegment) as C_MKTSEGMENT",
    )


def _write_extract(df: DataFrame, folder: str, name: str) -> None:
    df.write.option("header", True).option("escape", '"').option("emptyValue", "").csv(f"{folder}/{name}.csv")


@query
def staging_scan(b: Bound) -> DataFrame:
    folder = scratch_path(b.spark, "extract")
    _write_extract(_customer_extract(b), folder, "customer")
    return delimited.read_staging(b.spark, f"{folder}/customer.csv")


@query
def staging_folder(b: Bound) -> DataFrame:
    folder = scratch_path(b.spark, "extract")
    for name in ("customer", "orders", "part"):
        _write_extract(b.table(name), folder, name.upper())
    return quality.row_counts(delimited.read_staging_folder(b.spark, folder))


@query
def vocabulary_scan(b: Bound) -> DataFrame:
    path = f"{scratch_path(b.spark, 'vocabulary')}/CONCEPT.csv"
    upper = b.concept.selectExpr(
        "concept_id as CONCEPT_ID",
        "if(concept_class_id = 'Ingredient', 'NA', concept_name) as CONCEPT_NAME",
        "domain_id as DOMAIN_ID",
        "coalesce(standard_concept, '') as STANDARD_CONCEPT",
        "concat('\"', concept_code) as CONCEPT_CODE",
        "if(domain_id = 'Drug', 'bad', '19700101') as VALID_START_DATE",
        "coalesce(invalid_reason, 'NA') as INVALID_REASON",
    )
    upper.write.option("header", True).option("sep", "\t").option("quote", "").option("emptyValue", "").csv(path)
    return delimited.read_vocabulary(b.spark, path, "concept")


def _ragged_extracts(b: Bound) -> dict[str, quarantine.Extract]:
    """Customers and concepts as text, of which some rows have too few or too many fields."""
    folder = scratch_path(b.spark, "ragged")
    customer = b.table("customer").select(
        F.expr("""c_custkey || ',"' || c_name || '"' || case when c_acctbal < 0 then ''
            when c_mktsegment = 'BUILDING' then ',' || c_mktsegment || ',"more, of it"' else ',' || c_mktsegment end""")
        .alias("id,name,segment")
    )
    concept = b.concept.select(
        F.expr("cast(concept_id as string) || if(domain_id = 'Drug', '', '\\t' || concept_name || '\\t' || domain_id)").alias(
            "concept_id\tconcept_name\tdomain_id"
        )
    )
    for df, name in ((customer, "customer"), (concept, "CONCEPT")):
        lines = df.write.option("header", True).option("sep", "\x01").option("quote", "")
        lines = lines.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        lines.csv(f"{folder}/{name}.csv")
    return {
        "customer": quarantine.staging_extract(b.spark, f"{folder}/customer.csv", "customer"),
        "concept": quarantine.vocabulary_extract(b.spark, f"{folder}/CONCEPT.csv", "concept"),
    }


@query
def rejected_rows(b: Bound) -> DataFrame:
    return quarantine.rejected_rows(_ragged_extracts(b)).drop("file")


@query
def quarantined_staging(b: Bound) -> DataFrame:
    return _ragged_extracts(b)["customer"].rows


@query
def quarantined_vocabulary(b: Bound) -> DataFrame:
    return _ragged_extracts(b)["concept"].rows


@query
def accepted_gate(b: Bound) -> DataFrame:
    return quarantine.accepted_gate(_ragged_extracts(b), 80.0)


@query
def load_missing_tables(b: Bound) -> DataFrame:
    dataset = scratch_path(b.spark, "dataset")
    datasets.write_table(b.concept, dataset, "concept")
    datasets.write_table(datasets.header_only(b.closure), dataset, "concept_ancestor")
    loaders = {
        "concept": lambda: b.concept,
        "concept_ancestor": lambda: b.closure,
        "concept_relationship": lambda: b.relationship,
    }
    datasets.load_missing(b.spark, dataset, loaders)
    return quality.row_counts({n: datasets.open_table(b.spark, dataset, n) for n in loaders})


@query
def resumable_load(b: Bound) -> DataFrame:
    folder, dataset = scratch_path(b.spark, "extract"), scratch_path(b.spark, "dataset")
    for name in ("customer", "supplier"):
        _write_extract(b.table(name), folder, name)
    manifest.load_folder(b.spark, folder, dataset)
    _write_extract(b.table("orders"), folder, "orders")
    manifest.load_folder(b.spark, folder, dataset)
    loads = datasets.open_table(b.spark, dataset, manifest.MANIFEST)
    return loads.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_loads"), F.max("loaded_rows").alias("loaded_rows")
    )


@query
def header_only_staging(b: Bound) -> DataFrame:
    """A folder of extracts of which one table is to stay empty: what was read, by table."""
    folder = scratch_path(b.spark, "extract")
    _write_extract(b.table("customer").select("c_custkey", "c_name"), folder, "customer")
    _write_extract(b.table("supplier").select("s_suppkey", "s_name"), folder, "supplier")
    tables = delimited.read_staging_folder(b.spark, folder, unloaded=("supplier",))
    return (
        tables["customer"]
        .selectExpr("'customer' as table_name", "c_custkey as id", "c_name as name")
        .unionByName(tables["supplier"].selectExpr("'supplier' as table_name", "s_suppkey as id", "s_name as name"))
    )


@query
def layout_probe(b: Bound) -> DataFrame:
    """The first of several dataset layouts that has its table, and the rows there."""
    root = scratch_path(b.spark, "layouts")
    datasets.write_table(b.table("supplier"), f"{root}/second", "person")
    datasets.write_table(b.table("customer"), f"{root}/third", "person")
    layouts = [(f"{root}/{n}", "person") for n in ("first", "second", "third")]
    picked = datasets.pick_layout(b.spark, layouts)
    return quality.row_counts({picked.rsplit("/", 1)[-1]: datasets.open_table(b.spark, picked, "person")})


@query
def copied_vocabulary(b: Bound) -> DataFrame:
    source, target = scratch_path(b.spark, "dataset"), scratch_path(b.spark, "dataset")
    tables = {"concept": b.concept, "concept_ancestor": b.closure, "concept_synonym": b.synonym}
    for name, df in tables.items():
        datasets.write_table(df, source, name)
        datasets.write_table(datasets.header_only(df), target, name)
    datasets.copy_vocabulary(b.spark, target, source)
    return quality.row_counts({n: datasets.open_table(b.spark, target, n) for n in tables})


@query
def shared_vocabulary(b: Bound) -> DataFrame:
    dataset = scratch_path(b.spark, "dataset")
    datasets.write_table(b.concept, dataset, "concept")
    datasets.share_tables(b.spark, dataset, ["concept", "concept_ancestor"], prefix="shared_")
    return b.spark.sql("select domain_id, count(*) as n_concepts from shared_concept group by domain_id")


@query
def stamped_map_build(b: Bound) -> DataFrame:
    dataset = scratch_path(b.spark, "dataset")
    builders = {
        "source_to_standard_vocab_map": lambda: vocab.source_to_standard_map(b.concept, b.relationship, b.custom_map),
        "source_to_source_vocab_map": lambda: vocab.source_to_source_map(b.concept, b.custom_map),
    }
    release = vocab.vocabulary_release(b.vocabulary).first()
    built = [
        datasets.rebuild_if_stale(b.spark, dataset, release.vocabulary_version, version, builders)
        for version in (1, 1, 2)
    ]
    info = datasets.open_table(b.spark, dataset, datasets.BUILD_INFO)
    return (
        info.orderBy(F.col("built_at").desc())
        .limit(1)
        .drop("built_at")
        .withColumn("n_builds", F.lit(sum(built)))
    )


@query
def csv_report_sink(b: Bound) -> DataFrame:
    path = scratch_path(b.spark, "report")
    counts = quality.row_counts({n: b.table(n) for n in ("orders", "lineitem", "events")})
    datasets.write_report(counts, path)
    return b.spark.read.schema("table_name string, row_count bigint").option("header", True).csv(path)


@query
def streamed_staging(b: Bound) -> DataFrame:
    folder, base = scratch_path(b.spark, "stream"), scratch_path(b.spark, "stream")
    columns = ["event_id", "event_type", "props"]
    for first in (True, False):
        part = b.table("events").filter(F.col("event_type").isin("view", "click") == F.lit(first))
        rows = part.select(F.col("event_id").cast("string"), F.expr("if(event_type = 'error', 'NULL', event_type)").alias("event_type"), "props")
        rows.write.mode("append").option("header", True).option("escape", '"').csv(folder)
        stage_new_files(b.spark, folder, columns, f"{base}/table", f"{base}/checkpoint")
    return b.spark.read.parquet(f"{base}/table").select(columns)


@query
def ensured_tables(b: Bound) -> DataFrame:
    dataset = scratch_path(b.spark, "dataset")
    datasets.write_table(datasets.conform(b.persons, "person"), dataset, "person")
    datasets.write_table(b.plan_periods, dataset, "payer_plan_period")
    datasets.clear_tables(b.spark, dataset, ["payer_plan_period", "death"])
    datasets.ensure_tables(b.spark, dataset)
    return quality.row_counts({n: datasets.open_table(b.spark, dataset, n) for n in (*POPULATED, *UNPOPULATED)})


@query
def table_probe(b: Bound) -> DataFrame:
    tables = {"concept": b.concept, "concept_ancestor": datasets.header_only(b.closure), "person": b.persons}
    required = {
        "concept": ("concept_id", "concept_code"),
        "concept_ancestor": ("ancestor_concept_id",),
        "concept_relationship": ("concept_id_1", "concept_id_2"),
        "person": ("person_id", "run_name"),
    }
    return datasets.probe_tables(b.spark, tables, required)


@query
def picked_dataset(b: Bound) -> DataFrame:
    """The highest numbered dataset that has persons, with their number."""
    root = scratch_path(b.spark, "datasets")
    people = {
        "study": datasets.header_only(b.table("customer")),
        "study_2": b.table("customer"),
        "study_9": b.table("supplier"),
        "study_10": datasets.header_only(b.table("supplier")),
    }
    for name, df in people.items():
        datasets.write_table(df, f"{root}/{name}", "person")
    has_persons = lambda n: datasets.has_rows(datasets.open_table(b.spark, f"{root}/{n}", "person"))
    chosen = datasets.pick_dataset(list(people), "study", has_persons)
    return quality.row_counts({chosen: datasets.open_table(b.spark, f"{root}/{chosen}", "person")})


def _staging_extracts(b: Bound) -> dict[str, DataFrame]:
    """The bound inputs as text extracts, the way a source system would hand them over."""
    encounters = b.order_encounters.selectExpr(
        "encounter_id as ID", "patient as PATIENT", "encounterclass as ENCOUNTERCLASS",
        "concat(start_date, 'T00:00:00Z') as START", "concat(stop_date, 'T23:59:59Z') as STOP",
        "provider as PROVIDER", "code as CODE", "reasoncode as REASONCODE",
    )
    lines = b.coded_events.selectExpr(
        "patient as PATIENT", "encounter as ENCOUNTER", "code as CODE", "date", "stop_date", "value", "units"
    )
    return {
        "patients": b.patients.selectExpr("id as ID", "birthdate as BIRTHDATE", "deathdate as DEATHDATE", "gender as GENDER", "state as STATE", "county as COUNTY"),
        "encounters": encounters,
        "observations": lines.filter("stop_date is null").selectExpr("PATIENT", "ENCOUNTER", "CODE", "date as DATE", "value as VALUE", "units as UNITS"),
        "conditions": lines.filter("stop_date is not null").selectExpr("PATIENT", "ENCOUNTER", "CODE", "date as START", "stop_date as STOP"),
        "organizations": b.table("nation").selectExpr("n_nationkey as ID", "n_name as NAME"),
        "providers": b.table("supplier").selectExpr("s_suppkey as ID", "s_name as NAME"),
        "payers": b.payers.selectExpr("payer as ID", "payer_name as NAME"),
        "payer_transitions": b.transitions.selectExpr("patient as PATIENT", "payer as PAYER", "start_date as START_DATE", "end_date as END_DATE"),
        "claims": b.order_encounters.selectExpr("encounter_id as ID", "patient as PATIENTID", "encounter_id as APPOINTMENTID", "start_date as SERVICEDATE"),
        "claims_transactions": b.transactions.selectExpr("claim_id as CLAIMID", "transfer_type as TYPE", "amount as AMOUNT"),
    }


@query
def built_dataset(b: Bound) -> DataFrame:
    """Extracts to files, files to staging, staging to a whole dataset: rows per table."""
    folder, target = scratch_path(b.spark, "extract"), scratch_path(b.spark, "dataset")
    for name, df in _staging_extracts(b).items():
        _write_extract(df, folder, name)
    vocabulary = {
        "concept": b.concept,
        "concept_relationship": b.relationship,
        "concept_ancestor": b.closure,
        "vocabulary": b.vocabulary,
        "source_to_concept_map": b.custom_map,
    }
    staging = delimited.read_staging_folder(b.spark, folder)
    coded = {"observations": ("date", "date", VOCABULARIES), "conditions": ("start", "stop", VOCABULARIES)}
    pipeline.build_dataset(b.spark, staging, vocabulary, b.states, target, "2024-01-01", coded)
    return quality.row_counts({n: datasets.open_table(b.spark, target, n) for n in (*POPULATED, *UNPOPULATED)})


# -- column functions --------------------------------------------------------


@query
def tolerant_dates(b: Bound) -> DataFrame:
    return b.patients.select("id", parsing.staging_date("birthdate").alias("birthdate"))


@query
def death_dates(b: Bound) -> DataFrame:
    return b.patients.select("id", parsing.death_date("deathdate").alias("death_date"))


@query
def compact_dates(b: Bound) -> DataFrame:
    token = F.when(F.col("o_orderstatus") == "P", "19991332").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return b.table("orders").select("o_orderkey", parsing.compact_date(token).alias("order_date"))


@query
def discharge_code_repair(b: Bound) -> DataFrame:
    return b.event_encounters.select("encounter_id", parsing.two_digit_code("discharge").alias("discharge"))


@query
def tolerant_numbers(b: Bound) -> DataFrame:
    return (
        b.coded_events.select(
            parsing.tolerant_double("value").alias("number"), parsing.text_prefix("units").alias("units")
        )
        .groupBy("number", "units")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def visit_class_concepts(b: Bound) -> DataFrame:
    return (
        b.order_encounters.select(
            "encounterclass",
            classes.visit_concept("encounterclass").alias("visit_concept_id"),
            classes.class_group("encounterclass").alias("class_group"),
        )
        .groupBy("encounterclass", "visit_concept_id", "class_group")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def visit_match_priority(b: Bound) -> DataFrame:
    priority = classes.visit_priority("encounterclass", "visit_type", "visit_occurrence_id_new")
    return (
        visits.assign_all_visit_ids(b.event_encounters, b.event_visits)
        .groupBy("encounterclass", "visit_type", priority.alias("priority"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def run_filter(b: Bound) -> DataFrame:
    tagged = b.table("events").withColumn("run_name", F.col("event_type"))
    return quality.row_counts(
        {"events": quality.of_run(tagged, "purchase"), "orders": quality.of_run(b.table("orders"), "purchase")}
    )


@query
def source_prefix_filter(b: Bound) -> DataFrame:
    named = b.table("customer").selectExpr(
        "c_custkey as person_id", "if(c_acctbal < 0, c_name, concat('csv:', c_name)) as person_source_value"
    )
    return quality.with_source_prefix(named, "csv:")


@query
def valid_standard_concepts(b: Bound) -> DataFrame:
    return (
        b.concept.filter(code_fn.is_valid_standard())
        .groupBy("domain_id", "vocabulary_id")
        .agg(F.count(F.lit(1)).alias("n_concepts"))
    )


@query
def identifier_slug(b: Bound) -> DataFrame:
    return b.table("part").select(
        "p_partkey", parsing.slug(F.concat_ws(" -- ", "p_name", "p_brand", "p_type")).alias("slug")
    )


# -- interval collapse -------------------------------------------------------


def _event_eras(b: Bound, gap: int) -> DataFrame:
    eras = intervals.collapse_intervals(
        b.event_intervals, ["person_id", "concept"], "start_date", "end_date", gap, count="n_events"
    )
    return eras


@query
def event_eras_gap_0(b: Bound) -> DataFrame:
    return _event_eras(b, 0)


@query
def event_eras_gap_1(b: Bound) -> DataFrame:
    return _event_eras(b, 1)


@query
def event_eras_gap_2(b: Bound) -> DataFrame:
    return _event_eras(b, 2)


@query
def ingredient_map(b: Bound) -> DataFrame:
    return intervals.ingredient_map(b.exposures, b.concept, b.closure)


@query
def imputed_exposures(b: Bound) -> DataFrame:
    return (
        intervals.ingredient_exposures(b.exposures, b.concept, b.closure)
        .groupBy("person_id", "ingredient_concept_id", "start_date", "end_date")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def sub_exposures(b: Bound) -> DataFrame:
    return intervals.sub_exposures(intervals.ingredient_exposures(b.exposures, b.concept, b.closure))


@query
def drug_era(b: Bound) -> DataFrame:
    return intervals.with_era_id(intervals.drug_eras(b.exposures, b.concept, b.closure), "drug")


@query
def drug_era_gap_180(b: Bound) -> DataFrame:
    return intervals.drug_eras(b.exposures, b.concept, b.closure, 180)


@query
def condition_era(b: Bound) -> DataFrame:
    return intervals.with_era_id(intervals.condition_eras(b.conditions, 1), "condition")


@query
def condition_era_gap_30(b: Bound) -> DataFrame:
    return intervals.condition_eras(b.conditions)


@query
def surrogate_ids(b: Bound) -> DataFrame:
    orders = b.table("orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return with_surrogate_id(orders, "order_number", ["o_custkey", "o_orderdate", "o_orderkey"])


# -- visits ------------------------------------------------------------------


@query
def all_visits(b: Bound) -> DataFrame:
    return visits.all_visits(b.event_encounters)


@query
def lasting_visit_ids(b: Bound) -> DataFrame:
    """Visits of two builds over one registry: up to the last week's encounters, then of all.

    ``given_before`` is the id of the first build, which the second keeps.
    """
    registry = scratch_path(b.spark, "registry")
    last = b.event_encounters.agg(F.date_sub(F.max("start_date"), 6).alias("_last"))
    early = b.event_encounters.join(F.broadcast(last), F.col("start_date") < F.col("_last")).drop("_last")
    keys = ["patient", "encounterclass", "visit_start_date"]
    before = materialise(visits.all_visits(early, registry=registry), "first-build")
    after = visits.all_visits(b.event_encounters, registry=registry)
    given = before.select(*keys, F.col("visit_occurrence_id").alias("given_before"))
    return after.join(given, keys, "left").select("visit_occurrence_id", *keys, "given_before")


@query
def assign_all_visit_ids(b: Bound) -> DataFrame:
    return visits.assign_all_visit_ids(b.event_encounters, b.event_visits)


@query
def final_visit_ids(b: Bound) -> DataFrame:
    return visits.final_visit_ids(visits.assign_all_visit_ids(b.event_encounters, b.event_visits))


@query
def resolved_visits(b: Bound) -> DataFrame:
    return visits.resolve_visits(b.event_encounters, b.event_visits)


@query
def selected_visits(b: Bound) -> DataFrame:
    return visits.selected_visits(b.event_visits, b.event_final_ids)


@query
def visit_occurrence(b: Bound) -> DataFrame:
    return visits.visit_occurrence(b.order_visits, b.order_final_ids, b.persons)


@query
def visit_detail(b: Bound) -> DataFrame:
    return visits.visit_detail(b.order_visits, b.order_final_ids, b.persons)


@query
def discharge_per_visit(b: Bound) -> DataFrame:
    return visits.discharge_codes(b.event_encounters, b.event_final_ids)


@query
def discharge_enrichment(b: Bound) -> DataFrame:
    return _enriched(b)


def _enriched(b: Bound) -> DataFrame:
    rows = visits.visit_occurrence(b.event_visits, b.event_final_ids, b.event_persons)
    return visits.enrich_discharge(rows, b.event_final_ids, b.event_encounters, b.concept, b.relationship)


# -- vocabulary --------------------------------------------------------------


@query
def source_to_standard_map(b: Bound) -> DataFrame:
    return vocab.source_to_standard_map(b.concept, b.relationship, b.custom_map)


@query
def source_to_source_map(b: Bound) -> DataFrame:
    return vocab.source_to_source_map(b.concept, b.custom_map)


@query
def states_map(b: Bound) -> DataFrame:
    return vocab.states_map(b.states, b.concept)


@query
def vocabulary_release(b: Bound) -> DataFrame:
    return vocab.vocabulary_release(b.vocabulary)


@query
def concept_search(b: Bound) -> DataFrame:
    return vocab.search_concepts(b.concept, b.synonym, "BOLT")


@query
def concept_search_in_domain(b: Bound) -> DataFrame:
    return vocab.search_concepts(b.concept, b.synonym, "brand#1", "Drug")


@query
def concept_search_synonyms(b: Bound) -> DataFrame:
    return vocab.search_concepts(b.concept, b.synonym, "syn economy")


@query
def concept_search_batch(b: Bound) -> DataFrame:
    words = b.concept.select(F.split("concept_name", " ")[0].alias("term")).distinct()
    terms = words.select(F.explode(F.array(F.lit("all"), F.lit("drugs"))).alias("scope"), "term")
    domain = F.when(F.col("scope") == "drugs", "Drug").alias("domain_id")
    return search.search_concepts_batch(b.concept, b.synonym, terms.select(F.concat_ws(":", "scope", "term").alias("term_id"), "term", domain))


@query
def top_descendants(b: Bound) -> DataFrame:
    ancestors = b.concept.filter("concept_class_id = 'Ingredient'").selectExpr("concept_id as ancestor_concept_id")
    return vocab.top_descendants(b.concept, b.closure, ancestors)


@query
def code_mapping(b: Bound) -> DataFrame:
    return vocab.map_codes_to_concepts(b.module_codes, b.concept, b.relationship)


@query
def code_resolution(b: Bound) -> DataFrame:
    return vocab.code_resolution(b.module_codes, b.concept, b.relationship)


@query
def unresolved_codes(b: Bound) -> DataFrame:
    return vocab.unresolved_codes(b.module_codes, b.concept, b.relationship)


@query
def unknown_code_systems(b: Bound) -> DataFrame:
    return vocab.unknown_systems(b.module_codes)


@query
def placeholder_codes(b: Bound) -> DataFrame:
    return b.module_codes.filter(code_fn.is_placeholder("code")).groupBy("system").agg(F.count(F.lit(1)).alias("n"))


@query
def hierarchy_closure(b: Bound) -> DataFrame:
    customer = b.table("customer").selectExpr("1000 + c_nationkey as parent", "1000000 + c_custkey as child")
    nation = b.table("nation").selectExpr("cast(n_regionkey as bigint) as parent", "cast(1000 + n_nationkey as bigint) as child")
    return vocab.build_closure(nation.unionByName(customer.selectExpr("cast(parent as bigint) as parent", "child")))


@query
def concept_set_hits(b: Bound) -> DataFrame:
    return vocab.concept_set_hits(*_set_inputs(b))


def _set_inputs(b: Bound) -> tuple[DataFrame, DataFrame, DataFrame, list[str]]:
    items = documents.concept_set_items(b.cohort_documents)
    sources = coverage.codes_by_concept(b.module_codes, b.concept, b.relationship)
    return items, b.closure, sources, ["cohort_id", "set_id"]


# -- domain tables -----------------------------------------------------------

@query
def observation(b: Bound) -> DataFrame:
    return events.observation(b.mapped(["Observation"], VOCABULARIES))


@query
def measurement(b: Bound) -> DataFrame:
    return events.measurement(b.mapped(["Measurement"], VOCABULARIES), CLINICAL_TYPE)


@query
def condition_occurrence(b: Bound) -> DataFrame:
    return events.condition_occurrence(b.mapped(["Condition"], VOCABULARIES), CLINICAL_TYPE)


@query
def procedure_occurrence(b: Bound) -> DataFrame:
    return events.procedure_occurrence(b.mapped(["Procedure"], VOCABULARIES), CLINICAL_TYPE)


@query
def drug_exposure(b: Bound) -> DataFrame:
    return events.drug_exposure(b.mapped(["Drug"], VOCABULARIES), CLINICAL_TYPE)


@query
def device_exposure(b: Bound) -> DataFrame:
    return events.device_exposure(b.mapped(["Device"], VOCABULARIES), CLINICAL_TYPE)


@query
def person(b: Bound) -> DataFrame:
    return demographics.person(b.placed_patients, b.locations, PLACE)


@query
def location(b: Bound) -> DataFrame:
    return demographics.location(b.placed_patients, PLACE)


@query
def care_site(b: Bound) -> DataFrame:
    return demographics.care_site(b.table("customer"), "c_mktsegment", "c_nationkey")


@query
def provider(b: Bound) -> DataFrame:
    return demographics.provider(b.table("supplier"), "s_suppkey", "s_name")


@query
def observation_period(b: Bound) -> DataFrame:
    return demographics.observation_period(b.order_encounters, b.persons)


def _causes(b: Bound) -> DataFrame:
    targets = events.standard_targets(b.standard_map, "Condition", "SNOMED")
    return targets.groupBy(F.col("code").alias("reasoncode")).agg(
        F.min("target_concept_id").alias("cause_concept_id")
    )


@query
def death(b: Bound) -> DataFrame:
    return demographics.death(b.patients, b.order_encounters, b.persons, _causes(b))


@query
def recovered_deaths(b: Bound) -> DataFrame:
    return demographics.recovered_deaths(b.patients, b.order_encounters, b.persons)


@query
def payer_plan_period(b: Bound) -> DataFrame:
    return demographics.payer_plan_period(b.payers, b.transitions, b.patients, b.persons)


@query
def claim_costs(b: Bound) -> DataFrame:
    return demographics.claim_costs(b.claims, b.transactions, b.plan_periods)


@query
def refused_amounts(b: Bound) -> DataFrame:
    """Amounts as text; those above 100,000 are written with a separator that no number has."""
    text = F.expr("if(amount > 100000, format_number(amount, 2), cast(amount as string))")
    return demographics.refused_amounts(b.transactions.withColumn("amount", text))


@query
def cost(b: Bound) -> DataFrame:
    costs = demographics.claim_costs(b.claims, b.transactions, b.plan_periods)
    branches = [demographics.billable(b.billed_events(d), "event_id", d) for d in BILLED_DOMAINS]
    return demographics.cost(costs, branches)


@query
def cdm_source(b: Bound) -> DataFrame:
    return demographics.cdm_source("driver tables", "DT", "nobody", b.vocabulary, "2024-01-01")


# -- cohorts -----------------------------------------------------------------


@query
def cohort_instantiation(b: Bound) -> DataFrame:
    return cohorts.instantiate_cohorts(
        b.cohort_definitions, b.entry_concepts, b.concept_events, b.event_periods, b.inclusion_concepts,
        era_pad=1, exit_at="end_date",
    )


@query
def cohort_to_period_end(b: Bound) -> DataFrame:
    return cohorts.instantiate_cohorts(b.cohort_definitions, b.entry_concepts, b.concept_events, b.event_periods)


@query
def cohort_era_collapse(b: Bound) -> DataFrame:
    return cohorts.collapse_cohorts(b.cohort, 2)


@query
def cohort_subjects(b: Bound) -> DataFrame:
    return cohorts.subject_counts(b.cohort)


@query
def cohort_overlap(b: Bound) -> DataFrame:
    return cohorts.target_overlap(b.cohort, b.studies, b.manifest)


@query
def cohort_thresholds(b: Bound) -> DataFrame:
    return cohorts.evaluate_thresholds(b.manifest, b.studies, cohorts.counts_and_overlap(b.cohort, b.studies))


@query
def cohort_qc(b: Bound) -> DataFrame:
    return cohorts.cohort_qc(b.cohort, b.studies, b.manifest)


@query
def study_problems(b: Bound) -> DataFrame:
    return cohorts.study_problems(b.studies, b.manifest)


def _windows(b: Bound) -> DataFrame:
    return windows.cohort_windows(
        b.window_targets, b.window_outcomes, b.window_outcome_ids, b.window_periods, b.window_deaths, b.window_settings
    )


@query
def cohort_windows(b: Bound) -> DataFrame:
    return _windows(b)


@query
def cohort_incidence(b: Bound) -> DataFrame:
    return windows.incidence(_windows(b))


@query
def membership_difference(b: Bound) -> DataFrame:
    buyers = b.event_intervals.filter("concept = 'purchase'").select("person_id", "start_date")
    failing = b.event_intervals.filter("concept = 'error'").select("person_id", "start_date")
    return edges.membership_difference(buyers, failing, ["person_id", "start_date"])


# -- documents and coverage --------------------------------------------------


@query
def emitted_codes(b: Bound) -> DataFrame:
    return documents.emitted_codes(documents.label_modules(b.custom_modules, b.built_in_modules))


@query
def concept_set_items(b: Bound) -> DataFrame:
    return documents.concept_set_items(b.cohort_documents)


@query
def primary_criteria(b: Bound) -> DataFrame:
    return documents.primary_criteria(b.cohort_documents).withColumn(
        "primary_sets", F.concat_ws(",", F.col("primary_sets").cast("array<string>"))
    )


@query
def required_sets(b: Bound) -> DataFrame:
    return documents.required_sets(b.cohort_documents)


@query
def cohort_verdicts(b: Bound) -> DataFrame:
    primary, required = documents.primary_criteria(b.cohort_documents), documents.required_sets(b.cohort_documents)
    hits = vocab.sets_with_hits(*vocab.shared_set_hits(*_set_inputs(b)))
    return coverage.cohort_verdicts(primary, required, hits).withColumn(
        "missing_sets", F.concat_ws(",", F.col("missing_sets").cast("array<string>"))
    )


@query
def coverage_report(b: Bound) -> DataFrame:
    return coverage.coverage_report(
        b.cohort_documents, b.expected_empty, b.module_codes, b.concept, b.relationship, b.closure
    )


# -- quality -----------------------------------------------------------------

_STAGED = ("customer", "orders", "lineitem", "events")


@query
def table_row_counts(b: Bound) -> DataFrame:
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    return quality.row_counts({n: b.table(n) for n in names})


def _summary(b: Bound) -> DataFrame:
    staged = {n: b.table(n) for n in _STAGED} | {"none": datasets.header_only(b.table("orders"))}
    people = b.event_persons
    return quality.dataset_summary(
        staged,
        people,
        b.table("orders"),
        b.table("orders").withColumnRenamed("o_custkey", "person_id"),
        b.conditions.withColumn(
            "condition_concept_id", F.when(F.col("condition_concept_id") == 3, 0).otherwise(F.col("condition_concept_id"))
        ),
        b.condition_era_rows,
        b.drug_era_rows,
    )


@query
def dataset_summary(b: Bound) -> DataFrame:
    return _summary(b)


@query
def summary_document(b: Bound) -> DataFrame:
    path = scratch_path(b.spark, "summary")
    datasets.write_summary(quality.age_profile(b.persons, 2024).withColumnRenamed("n_people", "nPeople"), path)
    return b.spark.read.schema(
        "n_people bigint, age_under_18_count bigint, min_year_of_birth int, max_year_of_birth int"
    ).json(path)


@query
def threshold_gate(b: Bound) -> DataFrame:
    return quality.threshold_gate(_summary(b), 100, 90.0)


@query
def stage_failures(b: Bound) -> DataFrame:
    return quality.stage_failures(quality.threshold_gate(_summary(b), 10**9, 0.0), "summary")


@query
def age_profile(b: Bound) -> DataFrame:
    return quality.age_profile(b.persons, 2024)


@query
def discharge_summary(b: Bound) -> DataFrame:
    return quality.discharge_summary(_enriched(b))


@query
def discharge_verdict(b: Bound) -> DataFrame:
    return quality.discharge_verdict(quality.discharge_summary(_enriched(b)))


@query
def column_profile(b: Bound) -> DataFrame:
    return quality.column_profile(
        b.table("documents"), "documents", {"text": 8000, "lang": 2, "source": 4}
    )


@query
def field_profile(b: Bound) -> DataFrame:
    return quality.field_profile(b.conditions, "condition_occurrence")


def _lines_in_batches(b: Bound) -> DataFrame:
    """Sketches of the order lines, made per return flag and merged."""
    lines = b.table("lineitem").drop("l_shipdate")
    flags = ("A", "N", "R")
    return sketches.merge_sketches(
        [sketches.column_sketches(lines.where(F.col("l_returnflag") == flag), "lineitem") for flag in flags]
    )


@query
def sketched_profile(b: Bound) -> DataFrame:
    """Exact counts beside whether the sketches of merged batches are within their stated error."""
    exact = quality.field_profile(b.table("lineitem").drop("l_shipdate"), "lineitem")
    guess = sketches.sketched_profile(_lines_in_batches(b)).select(
        "column_name",
        F.struct("n_rows", "n_null").alias("counted"),
        F.col("n_distinct").alias("estimate"),
    )
    off = F.abs(F.col("estimate") - F.col("n_distinct"))
    return exact.join(guess, "column_name").select(
        "table_name",
        "column_name",
        "n_rows",
        "n_null",
        "n_distinct",
        (F.col("counted") == F.struct("n_rows", "n_null")).alias("counts_agree"),
        (off <= F.lit(sketches.DISTINCT_ERROR) * F.col("n_distinct")).alias("distinct_within"),
    )


@query
def frequent_values(b: Bound) -> DataFrame:
    """Values of columns that hold fewer than are tracked, so that the counts are exact."""
    found = _lines_in_batches(b).where("column_name in ('l_returnflag', 'l_linestatus', 'l_linenumber')")
    return sketches.frequent_values(found, 100)


@query
def dataset_difference(b: Bound) -> DataFrame:
    """Orders against a version with orders gone, new, moved to another customer and repriced."""
    orders = b.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    new = orders.where("o_orderkey % 1000 = 7").withColumn("o_orderkey", -F.col("o_orderkey"))
    edited = orders.where("o_orderkey % 1000 <> 1").withColumn(
        "o_custkey", F.expr("if(o_orderkey % 1000 = 2, o_custkey + 1, o_custkey)")
    )
    edited = edited.withColumn("o_orderstatus", F.expr("if(o_orderkey % 1000 in (2, 3), cast(null as string), o_orderstatus)"))
    paths = [scratch_path(b.spark, "version") for _ in range(2)]
    for df, path in ((orders, paths[0]), (edited.unionByName(new), paths[1])):
        fingerprints.write_version(df, path, ["o_orderkey"])
    return fingerprints.dataset_difference(b.spark, *paths, ["o_orderkey"])


@query
def concept_counts(b: Bound) -> DataFrame:
    return quality.concept_counts(b.conditions, "condition_concept_id")


@query
def month_counts(b: Bound) -> DataFrame:
    return quality.month_counts(b.exposures, "drug_exposure_start_date")


def _checks(b: Bound) -> DataFrame:
    small_parts = b.table("part").filter("p_size <= 25")
    return quality.check_results(
        [
            quality.field_checks(
                b.table("lineitem"),
                "lineitem",
                [
                    ("is_required", "l_shipdate", None, 0.0),
                    ("plausible_low", "l_quantity", 2.0, 5.0),
                    ("plausible_high", "l_quantity", 49.0, 1.0),
                ],
            ),
            quality.field_checks(b.exposures, "drug_exposure", [
                ("is_required", "drug_exposure_end_date", None, 10.0),
                ("concept_recorded", "drug_concept_id", None, 50.0),
            ]),
            quality.field_checks(
                datasets.header_only(b.table("orders")), "empty_orders", [("is_required", "o_custkey", None, 0.0)]
            ),
            quality.primary_key_check(b.table("lineitem"), "lineitem", ["l_orderkey", "l_linenumber"], 1.0),
            quality.primary_key_check(b.table("orders"), "orders", ["o_orderkey"]),
            quality.foreign_key_check(b.table("lineitem"), "lineitem", "l_partkey", small_parts, "p_partkey", 10.0),
            quality.foreign_key_check(b.table("orders"), "orders", "o_custkey", b.table("customer"), "c_custkey"),
            quality.field_checks(b.table("region"), "region", [("is_required", "r_name", None, 0.0)]),
        ],
        exclude=("region",),
    )


@query
def quality_checks(b: Bound) -> DataFrame:
    return _checks(b)


@query
def quality_check_summary(b: Bound) -> DataFrame:
    return quality.check_summary(_checks(b))


def _customer_lives(b: Bound) -> DataFrame:
    """Customers as persons; each is observed in two spans, around the first and the last order."""
    born = F.date_add(F.lit("1930-01-01").cast("date"), (F.col("c_custkey") % 30000).cast("int"))
    customer = b.table("customer")
    person = customer.select(
        F.col("c_custkey").alias("person_id"),
        F.year(born).alias("year_of_birth"),
        F.month(born).alias("month_of_birth"),
        F.dayofmonth(born).alias("day_of_birth"),
        F.expr("if(c_mktsegment = 'MACHINERY', 8507, 8532)").alias("gender_concept_id"),
    )
    death = customer.where("c_acctbal < 0").selectExpr(
        "c_custkey as person_id", "date_add(date'2000-01-01', cast(floor(c_acctbal) as int)) as death_date"
    )
    span = b.table("orders").groupBy(F.col("o_custkey").alias("person_id")).agg(
        F.min(F.col("o_orderdate").cast("date")).alias("first"), F.max(F.col("o_orderdate").cast("date")).alias("last")
    )
    periods = [
        span.selectExpr("person_id", f"{start} as observation_period_start_date", f"{end} as observation_period_end_date")
        for start, end in (("first", "date_add(first, 400)"), ("date_add(last, -300)", "last"))
    ]
    return rules.lives(person.where("person_id % 50 <> 0"), death, periods[0].unionByName(periods[1]))


@query
def clinical_rules(b: Bound) -> DataFrame:
    """Sixteen kinds of rules over drug exposures and one over their ids; two of them cannot be evaluated."""
    start, drug, even = "drug_exposure_start_date", "drug_concept_id", tuple(range(10000000, 10000100, 2))
    listed = [
        rules.Rule("is_required", "drug_exposure_end_date", None, 10.0),
        rules.Rule("is_one_of", "days_supply", tuple(range(30)), 50.0),
        rules.Rule("is_like", drug, "^(0|1000[0-9]{4})$", 1.0),
        rules.Rule("plausible_low", "days_supply", 0, 5.0),
        rules.Rule("plausible_high", "days_supply", 36, 5.0),
        rules.Rule("starts_before_end", start, "drug_exposure_end_date"),
        rules.Rule("is_known_person", "person_id", None, 5.0),
        rules.Rule("plausible_after_birth", start, None, 1.0),
        rules.Rule("plausible_before_death", start, 30, 1.0),
        rules.Rule("within_observation", start, None, 50.0),
        rules.Rule("concept_recorded", drug, None, 20.0),
        rules.Rule("concept_exists", drug),
        rules.Rule("concept_is_standard", drug, None, 5.0),
        rules.Rule("concept_in_domain", drug, "Drug", 50.0),
        rules.Rule("plausible_gender", drug, (even, 8532), 0.5),
        rules.Rule("plausible_value", drug, (even, "days_supply", 0, 20), 0.5),
        rules.Rule("fits_width", "sig", 10),
        rules.Rule("plausible_unit", drug, (even, "unit_concept_id", (8576,))),
    ]
    keys = quality.primary_key_check(b.table("lineitem"), "lineitem", ["l_orderkey", "l_linenumber"], 1.0)
    found = rules.all_checks({"drug_exposure": b.exposures}, {"drug_exposure": listed}, _customer_lives(b), b.concept)
    return found.unionByName(keys)


@query
def top_warnings(b: Bound) -> DataFrame:
    late = b.ordered_lines.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_lines"))
    return quality.top_warnings(late, ["n_lines", "o_custkey"])


# -- edge lists --------------------------------------------------------------


@query
def edges_missing_target(b: Bound) -> DataFrame:
    nodes = b.table("part").filter("p_size <= 25").select(F.col("p_partkey").alias("name"))
    lines = b.table("lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"))
    return edges.missing_targets(nodes, lines)


@query
def nodes_without_inbound(b: Bound) -> DataFrame:
    nodes = b.table("orders").select(F.col("o_orderkey").alias("name"))
    lines = b.table("lineitem").select(F.col("l_partkey").alias("src"), F.col("l_orderkey").alias("dst"))
    return edges.without_inbound(nodes, lines, root=0)


def _weighted(b: Bound) -> DataFrame:
    """Discounts per order; those of one priority are scaled to sum to 1."""
    lines = b.table("lineitem").groupBy("l_orderkey").agg(
        F.sum(F.col("l_discount").cast("decimal(18,2)")).alias("total")
    )
    rows = b.table("lineitem").join(lines, "l_orderkey").join(
        b.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority"), "l_orderkey"
    )
    return rows.selectExpr(
        "l_orderkey as src",
        "l_partkey as dst",
        "case when o_orderpriority = '1-URGENT' and total > 0 then l_discount / cast(total as double) "
        "when o_orderpriority = '5-LOW' and l_returnflag = 'R' then null else l_discount end as weight",
    )


@query
def unbalanced_weights(b: Bound) -> DataFrame:
    return edges.unbalanced_weights(_weighted(b)).select("src", F.round("weight_sum", 6).alias("weight_sum"))


@query
def graph_problems(b: Bound) -> DataFrame:
    """Problems of one graph per order status: orders lead to parts, parts to orders."""
    orders = b.table("orders").select("o_orderkey", "o_orderstatus")
    nodes = orders.selectExpr("o_orderstatus", "concat('o', o_orderkey) as name")
    lines = b.table("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    links = lines.selectExpr(
        "o_orderstatus", "concat('p', l_partkey) as src", "concat('o', l_orderkey) as dst", "cast(null as double) as weight"
    ).unionByName(
        lines.filter("l_returnflag = 'R'").selectExpr(
            "o_orderstatus", "concat('o', l_orderkey) as src", "concat('p', l_partkey) as dst", "l_discount as weight"
        )
    )
    return edges.graph_problems(nodes, links, ("o_orderstatus",), root="o0")
