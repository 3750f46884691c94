import random
from datetime import timedelta

import pytest
from conftest import day, in_order, rows

from carestrata.operators import demographics, events

MAP = (
    "source_code string, source_concept_id long, source_vocabulary_id string, source_domain_id string, "
    "target_concept_id long, target_domain_id string, target_vocabulary_id string, target_standard_concept string, "
    "target_invalid_reason string"
)


@pytest.fixture()
def maps(spark):
    standard = [
        ("A", 1, "SNOMED", "Observation", 10, "Observation", "SNOMED", "S", None),
        ("A", 1, "SNOMED", "Observation", 11, "Observation", "SNOMED", "S", None),
        ("A", 1, "SNOMED", "Observation", 12, "Condition", "SNOMED", "S", None),
        ("A", 1, "SNOMED", "Observation", 13, "Observation", "SNOMED", None, None),
        ("B", 2, "SNOMED", "Observation", 14, "Observation", "SNOMED", "S", "D"),
        ("C", 3, "HCPCS", "Observation", 15, "Observation", "HCPCS", "S", None),
        ("E", 5, "SNOMED", "Condition", 16, "Observation", "SNOMED", "S", None),
    ]
    source = [(r[0], r[1], r[2], r[3], r[4], r[6]) for r in standard if r[4] in (10, 14, 15, 16)]
    return (
        spark.createDataFrame(standard, MAP),
        spark.createDataFrame(
            source,
            "source_code string, source_concept_id long, source_vocabulary_id string, source_domain_id string, "
            "target_concept_id long, target_vocabulary_id string",
        ),
    )


def mapped(spark, maps, vocabularies):
    data = [
        ("p", 1, "A", day("2020-01-01"), "5", "u" * 60),
        ("q", 1, "A", day("2020-01-01"), "x" * 60, None),
        ("p", None, "C", day("2020-01-02"), None, None),
        ("p", 2, "B", day("2020-01-03"), "1", None),
        ("p", 2, "E", day("2020-01-03"), "1", None),
        ("stranger", 1, "A", day("2020-01-04"), "1", None),
    ]
    return events.map_events(
        spark.createDataFrame(data, "patient string, encounter long, code string, date date, value string, units string"),
        events.code_map(*maps, ["Observation"], vocabularies),
        spark.createDataFrame([(1, "p", "d1"), (2, "p", "none")], "encounter_id long, patient string, provider string"),
        spark.createDataFrame([(1, 70), (2, None)], "encounter_id long, visit_occurrence_id_new long"),
        spark.createDataFrame([(9, "d1")], "provider_id long, provider_source_value string"),
        spark.createDataFrame([(100, "p"), (200, "q")], "person_id long, person_source_value string"),
    )


def test_observation_rows(spark, maps):
    got = events.observation(mapped(spark, maps, ["SNOMED", "HCPCS"]))
    columns = ("person_id", "observation_concept_id", "provider_id", "visit_occurrence_id", "visit_detail_id", "value_as_number")
    # A has two valid targets, so its events count twice; the second patient is
    # not the encounter's own, so no provider.
    assert rows(got, *columns) == [
        (100, 10, 9, 70, 1000070, 5.0),
        (100, 11, 9, 70, 1000070, 5.0),
        (100, 15, None, None, None, None),
        (200, 10, None, 70, 1000070, None),
        (200, 11, None, 70, 1000070, None),
    ]
    assert {len(v) for (v,) in rows(got, "value_source_value") if v} == {1, 50}
    assert {r[0] for r in rows(got, "observation_type_concept_id")} == {38000280}
    assert events.observation(mapped(spark, maps, ["HCPCS"])).count() == 1


def test_deaths(spark):
    patients = spark.createDataFrame(
        [("a", "2001-11-28"), ("b", "11654"), ("c", ""), ("d", None), ("e", "unknown"), ("f", "2001-01-01"), ("z", "1")],
        "id string, deathdate string",
    )
    encounters = spark.createDataFrame(
        [("a", "308646001", day("2001-11-29"), "R1"), ("b", "other", day("2001-01-01"), None), ("c", "308646001", day("2002-02-02"), "R2")],
        "patient string, code string, start_date date, reasoncode string",
    )
    person = spark.createDataFrame([(i, p) for i, p in enumerate("abcdef")], "person_id long, person_source_value string")
    reasons = spark.createDataFrame([("R1", 77)], "reasoncode string, cause_concept_id long")
    got = demographics.death(patients, encounters, person, reasons)
    assert rows(got, "person_id", "death_date", "cause_concept_id", "cause_source_value") == [
        (0, day("2001-11-29"), 77, "R1"),
        (1, day("2001-11-28"), 0, None),
        (2, day("2002-02-02"), 0, "R2"),
        (5, day("2001-01-01"), 0, None),
    ]


def test_claim_costs_equal_brute_force(spark):
    rng = random.Random(3)
    base = day("2019-06-01")
    spans = sorted(
        {
            (p, base + timedelta(a), base + timedelta(a + n), f"payer{k}")
            for p, a, n, k in (
                (rng.choice([1, 1, 1, 2, 3]), rng.randrange(900), rng.choice([0, 1, 30, 400]), rng.randrange(3))
                for _ in range(120)
            )
        }
    )
    periods = spark.createDataFrame(
        [(i + 1, *s) for i, s in enumerate(spans)],
        "payer_plan_period_id long, person_id long, payer_plan_period_start_date date, payer_plan_period_end_date date, payer string",
    )
    claims = [(i, rng.randrange(1, 5), i, base + timedelta(rng.randrange(-5, 1300))) for i in range(300)]
    lines = [(rng.randrange(320), rng.choice(["CHARGE", "PAYMENT", "X"]), round(rng.random() * 100, 2)) for _ in range(900)]
    got = demographics.claim_costs(
        spark.createDataFrame(claims, "claim_id long, person_id long, encounter_id long, service_date date"),
        spark.createDataFrame(lines, "claim_id long, transfer_type string, amount double"),
        periods,
    )
    expected = []
    for claim, person, _, when in claims:
        own = [(kind, amount) for c, kind, amount in lines if c == claim]
        if own:
            total = lambda k: (round(sum(a for kind, a in own if kind == k), 2) if any(kind == k for kind, _ in own) else None)
            plan = next((i + 1 for i, s in enumerate(spans) if s[0] == person and s[1] <= when <= s[2]), None)
            expected.append((claim, total("CHARGE"), total("PAYMENT"), plan))
    assert rows(got, "claim_id", "total_charge", "total_paid", "payer_plan_period_id") == in_order(expected)


def test_equal_transitions_make_one_period(spark):
    payers = spark.createDataFrame([("1", "one")], "payer string, payer_name string")
    moves = spark.createDataFrame(
        [("a", "1", day("2020-01-01"), day("2020-02-01"))] * 2 + [("a", "9", day("2020-01-01"), day("2020-02-01")), ("x", "1", day("2020-01-01"), day("2020-02-01"))],
        "patient string, payer string, start_date date, end_date date",
    )
    patients = spark.createDataFrame([("a",)], "id string")
    person = spark.createDataFrame([(1, "a")], "person_id long, person_source_value string")
    got = demographics.payer_plan_period(payers, moves, patients, person)
    assert rows(got, "payer_plan_period_id", "person_id", "payer_source_value") == [(1, 1, "one")]


def test_metadata_row(spark):
    vocabulary = spark.createDataFrame([("None", "v5"), ("X", "x")], "vocabulary_id string, vocabulary_version string")
    got = demographics.cdm_source("n", "a", "h", vocabulary, "2024-01-01").first()
    assert (got.vocabulary_version, got.cdm_version) == ("v5", "v5.4")


def test_a_code_means_what_it_means_in_its_own_system(spark, maps):
    """One code in two vocabularies, and one whose standard target is in another vocabulary."""
    standard = spark.createDataFrame(
        [("161", 1, "CVX", "Drug", 10, "Drug", "CVX", "S", None), ("161", 2, "RxNorm", "Drug", 20, "Drug", "RxNorm", "S", None),
         ("E11", 3, "ICD10CM", "Drug", 30, "Drug", "SNOMED", "S", None), ("X", 4, "SNOMED", "Drug", 40, "Drug", "RxNorm", "S", None)],
        MAP,
    )
    source = standard.select(maps[1].columns)
    codes = events.code_map(standard, source, ["Drug"], ["CVX", "RxNorm", "ICD10CM", "SNOMED"])
    coded = spark.createDataFrame(
        [("p", 1, "161", ["CVX"], "immunizations"), ("p", 1, "161", ["RxNorm"], "medications"),
         ("p", 1, "E11", ["SNOMED", "ICD10CM"], "conditions"), ("p", 1, "X", ["SNOMED"], "conditions")],
        "patient string, encounter long, code string, systems array<string>, source_table string",
    )
    mapped = events.map_events(
        coded,
        codes,
        spark.createDataFrame([(1, "p", "d1")], "encounter_id long, patient string, provider string"),
        spark.createDataFrame([(1, 70)], "encounter_id long, visit_occurrence_id_new long"),
        spark.createDataFrame([(9, "d1")], "provider_id long, provider_source_value string"),
        spark.createDataFrame([(100, "p")], "person_id long, person_source_value string"),
    )
    assert rows(mapped, "source_table", "target_concept_id") == [("conditions", 30), ("immunizations", 10), ("medications", 20)]
    assert rows(events.unmapped_events(coded, codes)) == [("conditions", 2, 1), ("immunizations", 1, 0), ("medications", 1, 0)]


def test_amounts_out_of_range_count_for_nothing(spark):
    claims = spark.createDataFrame([("k", 1, "e", day("9000-01-01"))], "claim_id string, person_id long, encounter_id string, service_date date")
    moves = spark.createDataFrame([("k", "CHARGE", "1e20"), ("k", "CHARGE", "2.5"), ("k", "CHARGE", "x")], "claim_id string, transfer_type string, amount string")
    plans = spark.createDataFrame(
        [(1, 7, day("2000-01-01"), day("9999-12-31"))],
        "person_id long, payer_plan_period_id long, payer_plan_period_start_date date, payer_plan_period_end_date date",
    )
    got = demographics.claim_costs(claims, moves, plans)
    assert rows(got, "total_charge", "payer_plan_period_id") == [(2.5, 7)]
    assert rows(demographics.refused_amounts(moves)) == [("CHARGE", 2)]
