import random
from datetime import timedelta

from conftest import day, rows

from carestrata.operators import visits

BASE = day("2020-01-01")
ENCOUNTERS = "encounter_id long, patient string, encounterclass string, start_date date, stop_date date, discharge string"


def encounters(spark, data):
    return spark.createDataFrame(
        [(i, p, c, BASE + timedelta(a), BASE + timedelta(b), d) for i, p, c, a, b, d in data], ENCOUNTERS
    )


def random_encounters(n, seed=1):
    rng = random.Random(seed)
    kinds = ["inpatient", "emergency", "urgent", "urgentcare", "ambulatory", "wellness", "outpatient", "hospice"]
    out = []
    for i in range(n):
        a = rng.randrange(0, 120)
        patient = "hot" if rng.random() < 0.4 else f"p{rng.randrange(8)}"
        out.append((i, patient, rng.choice(kinds), a, a + rng.choice([0, 0, 1, 2, 5, 70]), None))
    return out


def best_by_hand(enc, found):
    groups = {"inpatient": 0, "emergency": 1, "urgent": 1, "urgentcare": 1, "ambulatory": 2, "wellness": 2, "outpatient": 2}
    out = []
    for e in enc:
        options = []
        for v in found:
            if v.patient == e.patient and v.visit_start_date <= e.start_date and e.stop_date <= v.visit_end_date:
                mine, theirs = groups.get(e.encounterclass), groups[v.encounterclass]
                rank = 99 if mine is None else 1 if theirs == 0 else 2 if mine == theirs else 99
                options.append((rank, v.visit_start_date, v.visit_end_date, v.visit_occurrence_id))
        out.append((e.encounter_id, min(options)[3] if options else None))
    return sorted(out)


def test_visit_rollup(spark):
    enc = encounters(
        spark,
        [
            (1, "a", "inpatient", 0, 3, None),
            (2, "a", "inpatient", 4, 6, None),  # the next day: same stay
            (3, "a", "inpatient", 8, 9, None),  # two days later: new stay
            (4, "a", "urgentcare", 1, 1, None),
            (5, "a", "urgentcare", 1, 2, None),
            (6, "a", "emergency", 1, 1, None),
            (7, "a", "hospice", 1, 1, None),
        ],
    )
    got = visits.all_visits(enc)
    assert rows(got, "visit_occurrence_id", "encounter_id", "encounterclass", "visit_start_date", "visit_end_date") == [
        (1, 6, "emergency", day("2020-01-02"), day("2020-01-02")),
        (2, 1, "inpatient", day("2020-01-01"), day("2020-01-07")),
        (3, 3, "inpatient", day("2020-01-09"), day("2020-01-10")),
        (4, 4, "urgentcare", day("2020-01-02"), day("2020-01-03")),
    ]
    final = dict(rows(visits.resolve_visits(enc, got)))
    # Absorbed by the stay where there is one; the hospice encounter has no class
    # of its own and takes the earliest visit around it.
    assert final == {1: 2, 2: 2, 3: 3, 4: 2, 5: 2, 6: 2, 7: 2}


def test_both_resolutions_equal_brute_force(spark):
    enc = encounters(spark, random_encounters(600))
    found = visits.all_visits(enc)
    expected = best_by_hand(enc.collect(), found.collect())
    assert sorted(tuple(r) for r in visits.resolve_visits(enc, found).collect()) == expected
    candidates = visits.assign_all_visit_ids(enc, found)
    assert sorted(tuple(r) for r in visits.final_visit_ids(candidates).collect()) == expected


def test_encounter_without_candidates_stays_with_a_null_visit(spark):
    enc = encounters(spark, [(1, "a", "hospice", 0, 9, None), (2, "b", "emergency", 0, 0, None)])
    found = visits.all_visits(enc)
    assert rows(visits.resolve_visits(enc, found)) == [(1, None), (2, 1)]
    assert rows(visits.final_visit_ids(visits.assign_all_visit_ids(enc, found))) == [(1, None), (2, 1)]


def test_long_visits_cover_many_slices(spark):
    enc = encounters(spark, [(1, "a", "inpatient", 0, 400, None), (2, "a", "emergency", 390, 395, None)])
    found = visits.all_visits(enc)
    assert dict(rows(visits.resolve_visits(enc, found)))[2] == dict(rows(visits.resolve_visits(enc, found)))[1]


def test_discharge_enrichment(spark):
    enc = encounters(
        spark,
        [
            (1, "a", "inpatient", 0, 3, None),
            (2, "a", "inpatient", 1, 2, " 1"),
            (3, "a", "inpatient", 1, 3, ""),
            (4, "b", "emergency", 0, 0, "62"),
            (5, "c", "emergency", 0, 0, "99"),
            (6, "d", "emergency", 0, 0, " "),
        ],
    )
    person = spark.createDataFrame([(i, p) for i, p in enumerate("abcd")], "person_id long, person_source_value string")
    concept = spark.createDataFrame(
        [
            (101, "UB04 Pt dis status", "01", None, None),
            (162, "UB04 Pt dis status", "62", None, None),
            (500, "X", "x", "S", None),
            (400, "X", "y", "S", None),
            (300, "X", "z", None, None),
        ],
        "concept_id long, vocabulary_id string, concept_code string, standard_concept string, invalid_reason string",
    )
    relationship = spark.createDataFrame(
        [(101, 500, "Maps to", None), (101, 400, "Maps to", None), (162, 300, "Maps to", None)],
        "concept_id_1 long, concept_id_2 long, relationship_id string, invalid_reason string",
    )
    found = visits.all_visits(enc)
    final = visits.resolve_visits(enc, found)
    before = visits.visit_occurrence(found, final, person)
    once = visits.enrich_discharge(before, final, enc, concept, relationship)
    expected = [(0, 400, "01"), (1, 162, "62"), (2, 0, "99"), (3, 0, None)]
    columns = ("person_id", "discharged_to_concept_id", "discharged_to_source_value")
    assert rows(once, *columns) == expected
    twice = visits.enrich_discharge(once, final, enc, concept, relationship)
    assert rows(twice) == rows(once)
    assert rows(visits.visit_detail(found, final, person), "visit_detail_id") == [
        (i + 1_000_000,) for (i,) in rows(before, "visit_occurrence_id")
    ]


def test_open_and_far_future_stays(spark):
    """An open encounter counts as its first day; an open-ended visit needs no row per month."""
    data = [(1, "a", "inpatient", BASE, None), (2, "a", "emergency", BASE, BASE), (3, "b", "inpatient", BASE, day("9999-12-31"))]
    data += [(4, "b", "wellness", BASE + timedelta(4000), None), (5, "c", "inpatient", None, None)]
    enc = spark.createDataFrame([(*r, None) for r in data], ENCOUNTERS)
    found = visits.all_visits(enc)
    ids = {r.encounter_id: r.visit_occurrence_id for r in found.collect()}
    got = dict(rows(visits.resolve_visits(enc, found)))
    assert got == {1: ids[1], 2: ids[1], 3: ids[3], 4: ids[3], 5: None}
    every = visits.final_visit_ids(visits.assign_all_visit_ids(enc, found))
    assert dict(rows(every)) == got
    assert visits.candidate_intervals(visits.closed(enc), found).count() < 20


def test_encounters_are_looked_up_in_all_sets_at_once(spark):
    enc = encounters(spark, random_encounters(20))
    found = spark.createDataFrame([], "visit_occurrence_id long, encounterclass string, patient string, visit_start_date date, visit_end_date date")
    plan = visits.resolve_visits(enc, found)._jdf.queryExecution().analyzed().toString()
    # The days are made distinct and joined once; encounters are not multiplied by their sets.
    assert (plan.count("Join "), plan.count("Deduplicate"), plan.count("Aggregate ["), plan.count("Generate ")) == (1, 1, 0, 1)
    assert set(rows(visits.resolve_visits(enc, found))) == {(i, None) for i in range(20)}


def test_encounters_without_class_or_dates_have_no_visit(spark):
    enc = encounters(spark, [(1, "a", "inpatient", 0, 3, None), (2, "a", None, 1, 1, None), (3, None, "inpatient", 1, 1, None)])
    undated = spark.createDataFrame([(4, "a", "inpatient", None, day("2020-01-02"), None)], ENCOUNTERS)
    found = visits.all_visits(enc.filter("encounter_id = 1"))
    assert rows(visits.resolve_visits(enc.union(undated), found)) == [(1, 1), (2, None), (3, None), (4, None)]
