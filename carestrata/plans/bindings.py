"""The driver tables seen as clinical inputs.

Persons come from customers, encounters from orders or from events, coded events
from order lines, and the vocabulary from parts, nations and regions. Every
binding is a projection or join of whole tables, so it grows with them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata.functions.parsing import staging_date
from carestrata.operators import demographics, documents, events, intervals, visits, vocab
from carestrata.operators.ids import with_surrogate_id
from carestrata.runtime import fit_shuffles, materialise, read_table

# Fixed values of the bindings: part type to domain, priority and event type to
# encounter class, event type to concept.
DOMAIN_OF_TYPE = {
    "ECONOMY": "Observation",
    "LARGE": "Measurement",
    "MEDIUM": "Condition",
    "PROMO": "Procedure",
    "SMALL": "Drug",
    "STANDARD": "Device",
}
CLASS_OF_PRIORITY = {
    "1-URGENT": "emergency",
    "2-HIGH": "inpatient",
    "3-MEDIUM": "urgentcare",
    "4-NOT SPECIFIED": "ambulatory",
    "5-LOW": "wellness",
}
CLASS_OF_EVENT = {
    "purchase": "inpatient",
    "error": "emergency",
    "signup": "urgentcare",
    "view": "ambulatory",
    "click": "wellness",
}
CONCEPT_OF_EVENT = {"purchase": 1, "error": 2, "signup": 3, "view": 4, "click": 5}

BILLED_DOMAINS = ("Condition", "Procedure", "Drug", "Device")
VOCABULARIES = ["SNOMED", "HCPCS"]
PLACE = ["state", "county"]

CLINICAL_TYPE = 32827


def _case(col: str, values: dict[str, object]):
    expr = F.when(F.lit(False), F.lit(next(iter(values.values()))))
    for key, value in values.items():
        expr = expr.when(F.col(col) == key, F.lit(value))
    return expr


# Tables that a dataset stores once and every later step reads: the vocabulary, its
# maps, persons and visits. Kept per application, folder and state of its files, so
# changed files are read again.
_stored: dict[tuple[str, str, str, str], DataFrame] = {}


def folder_files(spark: SparkSession, folder: str) -> list:
    """Status of all files below a folder."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files, found = store.listFiles(place, True), []
    while files.hasNext():
        found.append(files.next())
    return found


def folder_state(spark: SparkSession, folder: str) -> str:
    """Sizes and times of all files below a folder; contents are not read."""
    found = [f"{f.getPath().toString()}:{f.getLen()}:{f.getModificationTime()}" for f in folder_files(spark, folder)]
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


def stored(fn: Callable[[Bound], DataFrame]) -> cached_property:
    """A binding that is written to the shared folder on first use."""

    def once(self: Bound) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.folder, self.state, fn.__name__)
        if key not in _stored:
            _stored[key] = materialise(fn(self), fn.__name__)
        return _stored[key]

    prop = cached_property(once)
    prop.__set_name__(None, fn.__name__)
    return prop


_CONCEPT = "concept_id concept_name domain_id vocabulary_id concept_class_id standard_concept concept_code invalid_reason".split()


@dataclass(frozen=True)
class Bound:
    """Inputs of the operators over one folder of driver tables."""

    spark: SparkSession
    folder: str

    def __post_init__(self) -> None:
        fit_shuffles(self.spark, sum(file.getLen() for file in folder_files(self.spark, self.folder)))

    @cached_property
    def state(self) -> str:
        return folder_state(self.spark, self.folder)

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)

    # -- vocabulary ----------------------------------------------------------

    @cached_property
    def parts(self) -> DataFrame:
        return self.table("part").select(
            "p_partkey",
            "p_name",
            "p_brand",
            "p_type",
            "p_size",
            F.expr("cast(substr(p_brand, 7) as bigint)").alias("b"),
            (F.array_position(F.lit(list(DOMAIN_OF_TYPE)), F.col("p_type"))).cast("long").alias("t"),
            _case("p_type", DOMAIN_OF_TYPE).alias("domain_id"),
        )

    @stored
    def concept(self) -> DataFrame:
        parts, nation = self.parts, self.table("nation")
        leaf = parts.selectExpr(
            "10000000 + p_partkey as concept_id",
            "concat(p_name, ' ', p_partkey) as concept_name",
            "domain_id",
            "if(p_size <= 25, 'SNOMED', 'HCPCS') as vocabulary_id",
            "'Clinical Finding' as concept_class_id",
            "if(p_size % 3 = 0, 'S', null) as standard_concept",
            "cast(p_partkey as string) as concept_code",
            "if(p_size % 10 = 0, 'D', null) as invalid_reason",
        )
        pair = parts.selectExpr(
            "10000 + b * 10 + t as concept_id",
            "concat(p_type, ' ', p_brand) as concept_name",
            "domain_id",
            "if(b % 2 = 0, 'SNOMED', 'HCPCS') as vocabulary_id",
            "'Disorder' as concept_class_id",
            "'S' as standard_concept",
            "concat('G', 10000 + b * 10 + t) as concept_code",
            "cast(null as string) as invalid_reason",
        ).distinct()
        brand = parts.selectExpr(
            "1000 + b as concept_id",
            "p_brand as concept_name",
            "'Drug' as domain_id",
            "'RxNorm' as vocabulary_id",
            "'Ingredient' as concept_class_id",
            "'S' as standard_concept",
            "concat('B', b) as concept_code",
            "cast(null as string) as invalid_reason",
        ).distinct()
        discharge = nation.selectExpr(
            "cast(900000 + n_nationkey as bigint) as concept_id",
            "n_name as concept_name",
            "'Visit' as domain_id",
            f"'{visits.DISCHARGE_VOCABULARY}' as vocabulary_id",
            "'Visit' as concept_class_id",
            "cast(null as string) as standard_concept",
            "lpad(n_nationkey, 2, '0') as concept_code",
            "if(n_regionkey = 4, 'D', null) as invalid_reason",
        )
        place = self.table("region").selectExpr(
            "cast(910000 + r_regionkey as bigint) as concept_id",
            "r_name as concept_name",
            "'Visit' as domain_id",
            "'CMS Place of Service' as vocabulary_id",
            "'Visit' as concept_class_id",
            "if(r_regionkey = 3, null, 'S') as standard_concept",
            "cast(r_regionkey as string) as concept_code",
            "cast(null as string) as invalid_reason",
        )
        geography = nation.selectExpr(
            "cast(920000 + n_nationkey as bigint) as concept_id",
            "lower(n_name) as concept_name",
            "'Geography' as domain_id",
            "'OSM' as vocabulary_id",
            "'4th level' as concept_class_id",
            "if(n_regionkey = 2, null, 'S') as standard_concept",
            "cast(n_nationkey as string) as concept_code",
            "cast(null as string) as invalid_reason",
        )
        out = leaf
        for more in (pair, brand, discharge, place, geography):
            out = out.unionByName(more)
        return out.select(_CONCEPT)

    @stored
    def relationship(self) -> DataFrame:
        loose = self.parts.filter("p_size % 3 <> 0")
        name = "if(p_size % 11 = 0, 'maps to', 'Maps to') as relationship_id"
        invalid = "if(p_size % 7 = 0, 'D', null) as invalid_reason"
        to_pair = loose.selectExpr(
            "10000000 + p_partkey as concept_id_1", "10000 + b * 10 + t as concept_id_2", name, invalid
        )
        to_brand = loose.filter("p_size between 40 and 45").selectExpr(
            "10000000 + p_partkey as concept_id_1", "1000 + b as concept_id_2", name, invalid
        )
        to_place = self.table("nation").filter("n_regionkey <> 1").selectExpr(
            "cast(900000 + n_nationkey as bigint) as concept_id_1",
            "cast(910000 + n_regionkey as bigint) as concept_id_2",
            "'Maps to' as relationship_id",
            "cast(null as string) as invalid_reason",
        )
        is_a = self.parts.selectExpr(
            "10000 + b * 10 + t as concept_id_1",
            "1000 + b as concept_id_2",
            "'Is a' as relationship_id",
            "cast(null as string) as invalid_reason",
        ).distinct()
        return to_pair.unionByName(to_brand).unionByName(to_place).unionByName(is_a)

    @stored
    def closure(self) -> DataFrame:
        rows = self.parts.select(
            F.explode(
                F.expr(
                    """array(
                    struct(10000000 + p_partkey as a, 10000000 + p_partkey as d, 0 as n),
                    struct(10000 + b * 10 + t as a, 10000000 + p_partkey as d, 1 as n),
                    struct(1000 + b as a, 10000000 + p_partkey as d, 2 as n),
                    struct(10000 + b * 10 + t as a, 10000 + b * 10 + t as d, 0 as n),
                    struct(1000 + b as a, 10000 + b * 10 + t as d, 1 as n),
                    struct(1000 + b as a, 1000 + b as d, 0 as n))"""
                )
            ).alias("r")
        )
        return rows.select(
            F.col("r.a").alias("ancestor_concept_id"),
            F.col("r.d").alias("descendant_concept_id"),
            F.col("r.n").alias("min_levels_of_separation"),
            F.col("r.n").alias("max_levels_of_separation"),
        ).distinct()

    @stored
    def synonym(self) -> DataFrame:
        return self.parts.selectExpr(
            "10000000 + p_partkey as concept_id",
            "concat('syn ', p_type, ' ', p_name) as concept_synonym_name",
            "cast(4180186 as bigint) as language_concept_id",
        )

    @stored
    def vocabulary(self) -> DataFrame:
        return self.table("region").selectExpr(
            "if(r_regionkey = 0, 'None', r_name) as vocabulary_id",
            "r_name as vocabulary_name",
            "concat('v5.0 ', r_name) as vocabulary_version",
        )

    @stored
    def custom_map(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "s_name as source_code",
            "cast(0 as bigint) as source_concept_id",
            "'SUPPLIER' as source_vocabulary_id",
            "1000 + s_nationkey + 1 as target_concept_id",
            "if(s_acctbal < 0, 'D', null) as invalid_reason",
        )

    @stored
    def standard_map(self) -> DataFrame:
        return vocab.source_to_standard_map(self.concept, self.relationship, self.custom_map)

    @stored
    def source_map(self) -> DataFrame:
        return vocab.source_to_source_map(self.concept, self.custom_map)

    # -- events as intervals and encounters ----------------------------------

    @cached_property
    def event_intervals(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id",
            "user_id as person_id",
            "event_type as concept",
            "cast(ts as date) as start_date",
            "date_add(cast(ts as date), cast(floor(value) as int) % 3) as end_date",
        )

    @cached_property
    def event_encounters(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_id").alias("encounter_id"),
            F.col("user_id").cast("string").alias("patient"),
            _case("event_type", CLASS_OF_EVENT).alias("encounterclass"),
            F.expr("cast(ts as date)").alias("start_date"),
            F.expr("date_add(cast(ts as date), cast(floor(value) as int) % 3)").alias("stop_date"),
            F.expr(
                "case event_type when 'view' then ' ' when 'click' then null "
                "else concat(' ', cast(floor(value) as int) % 30) end"
            ).alias("discharge"),
        )

    @stored
    def event_visits(self) -> DataFrame:
        return visits.all_visits(self.event_encounters)

    @stored
    def event_final_ids(self) -> DataFrame:
        return visits.resolve_visits(self.event_encounters, self.event_visits)

    @cached_property
    def event_persons(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey as person_id", "cast(c_custkey as string) as person_source_value"
        )

    @cached_property
    def conditions(self) -> DataFrame:
        """Event types as conditions; the end of a purchase is unknown."""
        return self.event_intervals.select(
            "person_id",
            _case("concept", CONCEPT_OF_EVENT).cast("long").alias("condition_concept_id"),
            F.col("start_date").alias("condition_start_date"),
            F.when(F.col("concept") != "purchase", F.col("end_date")).alias("condition_end_date"),
        )

    @cached_property
    def concept_events(self) -> DataFrame:
        return self.event_intervals.select(
            "person_id",
            _case("concept", CONCEPT_OF_EVENT).cast("long").alias("concept_id"),
            "start_date",
            "end_date",
        )

    @cached_property
    def event_periods(self) -> DataFrame:
        return self.event_intervals.groupBy("person_id").agg(
            F.min("start_date").alias("observation_period_start_date"),
            F.max("end_date").alias("observation_period_end_date"),
        )

    # -- order lines as exposures and coded events ---------------------------

    @cached_property
    def ordered_lines(self) -> DataFrame:
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        return self.table("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    @cached_property
    def exposures(self) -> DataFrame:
        return self.ordered_lines.selectExpr(
            "o_custkey as person_id",
            "if(l_linestatus = 'O' and l_returnflag = 'N', 0, 10000000 + l_partkey) as drug_concept_id",
            "cast(l_shipdate as date) as drug_exposure_start_date",
            "if(l_returnflag = 'R', date_add(cast(l_shipdate as date), cast(l_quantity as int) % 30), null)"
            " as drug_exposure_end_date",
            "if(l_linestatus = 'F' and l_returnflag = 'A', null, cast(l_quantity as int) % 40 - 2) as days_supply",
        )

    @cached_property
    def coded_events(self) -> DataFrame:
        return self.ordered_lines.selectExpr(
            "if(l_linenumber = 7, cast(l_suppkey as string), cast(o_custkey as string)) as patient",
            "l_orderkey as encounter",
            "cast(l_partkey as string) as code",
            "cast(l_shipdate as date) as date",
            "cast(l_shipdate as date) as start_date",
            "if(l_returnflag = 'R', date_add(cast(l_shipdate as date), cast(l_quantity as int) % 30), null)"
            " as stop_date",
            "if(l_returnflag = 'N', concat(l_returnflag, '-', l_linestatus), cast(cast(l_quantity as int) as string))"
            " as value",
            "repeat(l_linestatus, l_linenumber * 10) as units",
        )

    @cached_property
    def order_encounters(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("encounter_id"),
            F.col("o_custkey").cast("string").alias("patient"),
            _case("o_orderpriority", CLASS_OF_PRIORITY).alias("encounterclass"),
            F.expr("cast(o_orderdate as date)").alias("start_date"),
            F.expr("date_add(cast(o_orderdate as date), cast(floor(o_totalprice) as int) % 40)").alias("stop_date"),
            F.expr("cast(cast(floor(o_totalprice) as bigint) % 120 as string)").alias("provider"),
            F.expr(
                "if(o_orderstatus = 'P' and o_orderpriority = '1-URGENT', "
                f"'{demographics.DEATH_CERTIFICATION_CODE}', '185345009')"
            ).alias("code"),
            F.expr("cast(cast(floor(o_totalprice) as bigint) % 2000 as string)").alias("reasoncode"),
        )

    @cached_property
    def patients(self) -> DataFrame:
        """Birth and death dates in mixed encodings; many have no death date."""
        nation = self.table("nation").select("n_nationkey", "n_name", "n_regionkey")
        born = "date_add(date'1930-01-01', cast(c_custkey % 30000 as int))"
        died = "date_add(date'2000-01-01', cast(floor(c_acctbal) as int))"
        days = "cast(datediff({0}, date'1970-01-01') as string)"
        return (
            self.table("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .selectExpr(
                "cast(c_custkey as string) as id",
                f"if(c_mktsegment = 'BUILDING', {days.format(born)}, cast({born} as string)) as birthdate",
                f"case when c_acctbal < 0 then {days.format(died)} when c_acctbal > 8000 then cast({died} as string) "
                "when c_acctbal > 6000 then '  ' when c_acctbal > 5000 then 'unknown' end as deathdate",
                "case c_mktsegment when 'MACHINERY' then 'M' when 'FURNITURE' then 'f' when 'BUILDING' then 'F' "
                "when 'AUTOMOBILE' then 'M' end as gender",
                "n_name as state",
                "cast(n_regionkey as string) as county",
            )
        )

    @cached_property
    def states(self) -> DataFrame:
        return self.table("nation").selectExpr(
            "n_name as state", "concat('N', n_nationkey) as state_abbreviation"
        )

    @stored
    def locations(self) -> DataFrame:
        return demographics.location(self.placed_patients, PLACE)

    @stored
    def providers(self) -> DataFrame:
        return demographics.provider(self.table("supplier"), "s_suppkey", "s_name")

    @stored
    def persons(self) -> DataFrame:
        return demographics.person(self.placed_patients, self.locations, PLACE)

    @cached_property
    def placed_patients(self) -> DataFrame:
        # A small file of customers is one task; parsing their dates takes far longer than reading it.
        typed = self.patients.repartition("id").withColumn("birthdate", staging_date("birthdate"))
        return demographics.with_state_abbreviation(typed, self.states)

    @stored
    def order_visits(self) -> DataFrame:
        return visits.all_visits(self.order_encounters)

    @stored
    def order_final_ids(self) -> DataFrame:
        return visits.resolve_visits(self.order_encounters, self.order_visits)

    def mapped(self, domains: list[str], vocabularies: list[str]) -> DataFrame:
        """Order lines of some domains with person, concepts, visit and provider."""
        codes = events.code_map(self.standard_map, self.source_map, domains, vocabularies)
        return events.map_events(
            self.coded_events, codes, self.order_encounters, self.order_final_ids, self.providers, self.persons
        )

    @stored
    def all_billed_events(self) -> DataFrame:
        """Distinct events of the billed domains, numbered within their domain.

        All domains are mapped and numbered together, so the order lines are joined and
        sorted once; a domain's numbers then start at 1 again.
        """
        columns = ["person_id", "encounter", "code", "date"]
        rows = self.mapped(list(BILLED_DOMAINS), VOCABULARIES).select(F.col("target_domain_id").alias("domain"), *columns)
        numbered = materialise(with_surrogate_id(rows.distinct(), "event_id", ["domain", *columns]), "billed-events")
        first = F.broadcast(numbered.groupBy("domain").agg(F.min("event_id").alias("_first")))
        own = (F.col("event_id") - F.col("_first") + 1).alias("event_id")
        return numbered.join(first, "domain").select(own, *columns, "domain")

    def billed_events(self, domain: str) -> DataFrame:
        return self.all_billed_events.filter(F.col("domain") == domain)

    @cached_property
    def payers(self) -> DataFrame:
        return self.table("region").selectExpr("cast(r_regionkey as string) as payer", "r_name as payer_name")

    @cached_property
    def transitions(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "cast(o_custkey as string) as patient",
            "substr(o_orderpriority, 1, 1) as payer",
            "cast(o_orderdate as date) as start_date",
            "date_add(cast(o_orderdate as date), cast(floor(o_totalprice) as int) % 365) as end_date",
        )

    @stored
    def plan_periods(self) -> DataFrame:
        return demographics.payer_plan_period(self.payers, self.transitions, self.patients, self.persons)

    @cached_property
    def claims(self) -> DataFrame:
        people = self.persons.select("person_id", F.col("person_source_value").alias("patient"))
        return self.order_encounters.join(people, "patient").select(
            F.col("encounter_id").alias("claim_id"), "person_id", "encounter_id",
            F.col("start_date").alias("service_date"),
        )

    @cached_property
    def transactions(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_orderkey as claim_id",
            "case l_returnflag when 'R' then 'PAYMENT' when 'A' then 'CHARGE' else 'TRANSFER' end as transfer_type",
            "l_extendedprice as amount",
        )

    @stored
    def drug_era_rows(self) -> DataFrame:
        return intervals.drug_eras(self.exposures, self.concept, self.closure)

    @stored
    def condition_era_rows(self) -> DataFrame:
        return intervals.condition_eras(self.conditions)

    # -- cohorts -------------------------------------------------------------

    @cached_property
    def studies(self) -> DataFrame:
        return self.table("region").selectExpr(
            "r_name as study",
            "if(r_name = 'EUROPE', null, 1) as target_id",
            "cast(5 + r_regionkey * 10 as bigint) as min_target_subjects",
            "cast(if(r_regionkey = 2, null, 20) as bigint) as min_outcome_subjects",
        )

    @cached_property
    def manifest(self) -> DataFrame:
        return self.table("region").selectExpr("r_name", "explode(sequence(1, 6)) as cohort_id").selectExpr(
            "r_name as study",
            "cohort_id",
            "concat('cohort ', cohort_id) as cohort_name",
            "cohort_id in (2, 6) as is_outcome",
            "cohort_id = 6 as expected_empty",
            "if(cohort_id = 5 and r_name = 'ASIA', 'FAILED', null) as failed",
            "cohort_id = 4 as hand_authored",
        )

    @stored
    def cohort(self) -> DataFrame:
        """Users by the event types they have, one study per region of theirs."""
        home = (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("c_custkey").alias("subject_id"), F.col("r_name").alias("study"))
        )
        return (
            self.event_intervals.withColumnRenamed("person_id", "subject_id")
            .join(home, "subject_id")
            .select(
                "study",
                _case("concept", CONCEPT_OF_EVENT).alias("cohort_id"),
                "subject_id",
                F.col("start_date").alias("cohort_start_date"),
                F.col("end_date").alias("cohort_end_date"),
            )
        )

    @cached_property
    def cohort_definitions(self) -> DataFrame:
        return self.table("region").selectExpr("r_name", "r_regionkey", "explode(sequence(1, 3)) as cohort_id").selectExpr(
            "r_name as study",
            "cohort_id",
            "r_regionkey as prior_days",
            "if(cohort_id = 3, 2, 0) as post_days",
            "cohort_id = 1 as first_only",
        )

    @cached_property
    def entry_concepts(self) -> DataFrame:
        return self.table("region").selectExpr(
            "r_name as study",
            "explode(array(struct(1 as c, 1L as k), struct(2 as c, 2L as k), struct(3 as c, 4L as k), "
            "struct(3 as c, 5L as k))) as e",
        ).selectExpr("study", "e.c as cohort_id", "e.k as concept_id")

    @cached_property
    def inclusion_concepts(self) -> DataFrame:
        return self.table("region").selectExpr(
            "r_name as study",
            "explode(array(struct(1 as r, 10 + r_regionkey as n, 1L as k), struct(2 as r, 1 as n, 2L as k))) as e",
        ).selectExpr("study", "3 as cohort_id", "e.r as rule", "e.n as min_count", "e.k as concept_id")

    @cached_property
    def window_settings(self) -> DataFrame:
        """A study per region, each with windows of its own."""
        return self.table("region").selectExpr(
            "r_name as study",
            "r_regionkey as prior_days",
            "if(r_regionkey = 4, null, 2 * r_regionkey) as washout_days",
            "if(r_regionkey = 3, 0, 1) as risk_start",
            "case r_regionkey when 1 then 9000000 when 2 then null else 10 end as risk_end",
            "r_regionkey = 3 as risk_from_end",
            "if(r_regionkey = 0, null, r_regionkey <> 4) as censor_at_outcome",
        )

    @cached_property
    def window_targets(self) -> DataFrame:
        """Rows of each study's purchases; every fifth subject's are still open."""
        return self.cohort.filter("cohort_id = 1").selectExpr(
            "study",
            "cohort_id as target_id",
            "subject_id",
            "cohort_start_date as index_date",
            "if(subject_id % 5 = 0, null, cohort_end_date) as end_date",
        )

    @cached_property
    def window_outcomes(self) -> DataFrame:
        return self.cohort.filter("cohort_id in (2, 3)").selectExpr(
            "study", "cohort_id as outcome_id", "subject_id", "cohort_start_date as outcome_date"
        )

    @cached_property
    def window_outcome_ids(self) -> DataFrame:
        return self.table("region").selectExpr("r_name as study", "explode(array(2, 3, 9)) as outcome_id")

    @cached_property
    def window_periods(self) -> DataFrame:
        """Two periods a person, some open, some far in the future, the second overlapping for some."""
        days = self.event_periods.selectExpr(
            "person_id",
            "observation_period_start_date as a",
            "observation_period_end_date as b",
            "date_add(observation_period_start_date, cast(datediff(observation_period_end_date, observation_period_start_date) / 2 as int)) as m",
        )
        early = days.selectExpr("person_id", "a as observation_period_start_date", "if(person_id % 3 = 0, date_add(m, 2), date_sub(m, 1)) as observation_period_end_date")
        late = days.selectExpr(
            "person_id",
            "if(person_id % 3 = 1, date_add(m, 1), m) as observation_period_start_date",
            "case when person_id % 7 = 0 then null when person_id % 11 = 0 then date'9999-12-31' else b end as observation_period_end_date",
        )
        return early.unionByName(late)

    @cached_property
    def window_deaths(self) -> DataFrame:
        return self.event_intervals.filter("concept = 'signup'").selectExpr("person_id", "if(person_id % 4 = 0, end_date, null) as death_date")

    # -- documents -----------------------------------------------------------

    @cached_property
    def module_documents(self) -> DataFrame:
        """One module per part, with codes at several depths and ones not emitted."""

        def code(system: str, value: str, display: str = "null") -> str:
            return f"named_struct('system', {system}, 'code', {value}, 'display', {display})"

        part_code = code("system", "code", "p_name")
        # A small file of parts is one task; its documents are a hundred times as large.
        return self.parts.repartition("p_partkey").selectExpr(
            "*",
            "if(p_size <= 25, 'SNOMED-CT', 'HCPCS') as system",
            "if(p_size = 1, 'REPLACE_ME', cast(p_partkey as string)) as code",
            "if(p_type = 'LARGE', 'NOPE', 'LOINC') as lab_system",
        ).selectExpr(
            "p_partkey",
            "p_type",
            f"""to_json(named_struct('name', 'm', 'states', named_struct(
                'Initial', named_struct('type', 'Initial', 'direct_transition', 'Onset'),
                'Onset', named_struct(
                    'type', 'ConditionOnset',
                    'codes', array({part_code}),
                    'conditional_transition', array(named_struct(
                        'condition', named_struct('codes', array({code("'SNOMED-CT'", "'GUARD'")})),
                        'transition', 'Lab'))),
                'Lab', named_struct(
                    'type', 'Observation',
                    'value_code', {code("lab_system", "concat('L', t)")},
                    'parts', array(array(named_struct('deep', {code("'RxNorm'", "concat('B', b)", "p_brand")}))),
                    'direct_transition', 'Stop'),
                'Stop', named_struct(
                    'type', 'ConditionEnd',
                    'codes', array({code("'SNOMED-CT'", "'END'")})))))
            as document""",
        )

    @cached_property
    def custom_modules(self) -> DataFrame:
        return self.module_documents.filter("p_type = 'PROMO'").selectExpr(
            "concat(p_partkey, '.json') as path", "document"
        )

    @cached_property
    def built_in_modules(self) -> DataFrame:
        return self.module_documents.selectExpr(
            "concat(p_type, '/', p_partkey, '.json') as path", "document"
        )

    @stored
    def module_codes(self) -> DataFrame:
        return documents.emitted_codes(documents.label_modules(self.custom_modules, self.built_in_modules))

    @cached_property
    def cohort_documents(self) -> DataFrame:
        """One cohort definition per supplier, in five entry and four rule shapes."""

        def item(concept: str, descendants: str = "null", excluded: str = "null") -> str:
            return (
                f"named_struct('concept', named_struct('CONCEPT_ID', cast({concept} as bigint)), "
                f"'includeDescendants', cast({descendants} as boolean), 'isExcluded', cast({excluded} as boolean))"
            )

        def criterion(kind: str, codeset: str) -> str:
            return f"map('{kind}', named_struct('CodesetId', {codeset}))"

        def counted(kind: str, codeset: int, occurrence: int, least: int) -> str:
            return (
                f"named_struct('Criteria', {criterion(kind, str(codeset))}, "
                f"'Occurrence', named_struct('Type', {occurrence}, 'Count', {least}))"
            )

        def concept_set(number: int, items: str) -> str:
            return f"named_struct('id', {number}, 'expression', named_struct('items', {items}))"

        brand = item("1000 + s_nationkey + 1", "true", "false")
        pair = item("10000 + (s_nationkey + 1) * 10 + 1", "true", "true")
        one, zero = counted("Measurement", 1, 2, 1), counted("Measurement", 2, 0, 0)
        visit = counted("VisitOccurrence", 2, 2, 1)
        first, third = counted("DrugExposure", 0, 2, 1), counted("DrugExposure", 2, 0, 1)

        def group(kind: str, criteria: str, groups: str) -> str:
            return (
                f"array(named_struct('expression', named_struct('Type', '{kind}', "
                f"'CriteriaList', {criteria}, 'Groups', {groups})))"
            )

        no_groups = (
            f"filter(array(named_struct('Type', 'ANY', 'CriteriaList', array({one}))), g -> false)"
        )
        sub_group = f"array(named_struct('Type', 'ANY', 'CriteriaList', array({one}, {third})))"
        sets = ", ".join(
            [
                concept_set(0, f"if(s_nationkey % 3 = 0, array({brand}, {pair}), array({brand}))"),
                concept_set(1, f"array({item('10000000 + s_suppkey')})"),
                concept_set(2, f"array({item('999')})"),
            ]
        )
        return self.table("supplier").selectExpr(
            "s_suppkey as cohort_id",
            f"""case s_nationkey % 5
                when 0 then array({criterion('ConditionOccurrence', '0')})
                when 1 then array({criterion('DrugExposure', '1')}, {criterion('ConditionOccurrence', '2')})
                when 2 then array({criterion('VisitOccurrence', '2')})
                when 3 then array({criterion('ObservationPeriod', 'cast(null as int)')})
                else array({criterion('Measurement', '2')}) end as entry""",
            f"""case s_nationkey % 4
                when 1 then {group('ALL', f'array({one}, {zero}, {visit})', no_groups)}
                when 2 then {group('Any', f'array({first}, {third})', no_groups)}
                when 3 then {group('ALL', f'filter(array({one}), c -> false)', sub_group)}
                end as rules""",
            f"array({sets}) as sets",
        ).selectExpr(
            "cohort_id",
            "to_json(named_struct('ConceptSets', sets, 'PrimaryCriteria', named_struct('CriteriaList', entry), "
            "'InclusionRules', rules)) as document",
        )

    @cached_property
    def expected_empty(self) -> DataFrame:
        return self.table("supplier").filter("s_acctbal < 0").selectExpr("s_suppkey as cohort_id")
