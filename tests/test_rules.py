from conftest import day, rows

from carestrata.operators import rules
from carestrata.operators.rules import Rule
from carestrata.plans import pipeline
from carestrata.sources import datasets

PERSON = "person_id long, year_of_birth int, month_of_birth int, day_of_birth int, gender_concept_id int"
EVENTS = "person_id long, at date, until date, concept_id long, unit long, amount double, note string"


def life(spark):
    person = spark.createDataFrame([(1, 2000, 5, 10, 8507), (2, 1990, None, None, 8532), (3, None, None, None, None), (1, 2000, 5, 11, 8507)], PERSON)
    death = spark.createDataFrame([(1, day("2020-01-01")), (1, day("2021-01-01"))], "person_id long, death_date date")
    spans = [(1, "2005-01-01", "2005-12-31"), (1, "2006-01-01", "2006-06-30"), (1, "2010-01-01", "9999-12-31"), (2, "2000-01-01", None), (2, "2001-01-02", "2001-01-01")]
    periods = spark.createDataFrame(
        [(p, day(a), day(b) if b else None) for p, a, b in spans],
        "person_id long, observation_period_start_date date, observation_period_end_date date",
    )
    return rules.lives(person, death, periods)


def events(spark):
    data = [
        (1, "2000-05-09", None, 7, 1, 5.0, "x"),  # before birth, out of observation
        (1, "2006-03-01", "2006-02-01", 8, 2, 50.0, "long note"),  # ends before it starts
        (1, "2020-01-15", None, 0, None, None, None),  # after death
        (2, "1990-01-01", None, 7, None, 5.0, "y"),  # no period
        (3, None, None, 99, 1, -1.0, "z"),
        (4, "2005-01-01", None, 9, 1, 5.0, "z"),  # unknown person
        (None, "2005-01-01", None, None, 1, 5.0, "z"),
    ]
    return spark.createDataFrame([(p, a and day(a), b and day(b), *rest) for p, a, b, *rest in data], EVENTS)


def concepts(spark):
    data = [(7, "Drug", "S", None), (8, "Drug", None, None), (9, "Condition", "S", "D"), (7, "Drug", "S", None)]
    return spark.createDataFrame(data, "concept_id long, domain_id string, standard_concept string, invalid_reason string")


EXPECTED = [
    (Rule("is_required", "concept_id"), 1),
    (Rule("is_one_of", "note", ("x", "y", "z")), 1),
    (Rule("is_like", "note", "^[a-z]$"), 1),
    (Rule("fits_width", "note", 3), 1),
    (Rule("plausible_low", "amount", 0), 1),
    (Rule("plausible_high", "amount", 10), 1),
    (Rule("starts_before_end", "at", "until"), 1),
    (Rule("is_known_person", "person_id"), 1),
    (Rule("plausible_after_birth", "at"), 1),
    (Rule("plausible_before_death", "at"), 1),
    (Rule("plausible_before_death", "at", 30), 0),
    (Rule("within_observation", "at"), 4),
    (Rule("concept_recorded", "concept_id"), 1),
    (Rule("concept_exists", "concept_id"), 1),
    (Rule("concept_is_standard", "concept_id"), 3),
    (Rule("concept_in_domain", "concept_id", "Drug"), 1),
    (Rule("plausible_gender", "concept_id", ((7, 99), 8507)), 2),
    (Rule("plausible_unit", "concept_id", ((7, 8), "unit", (1,))), 2),
    (Rule("plausible_value", "concept_id", ((7, 8), "amount", 0, 20)), 1),
]


def test_every_kind_of_rule(spark):
    got = rules.table_checks(events(spark), "t", [r for r, _ in EXPECTED], life(spark), concepts(spark)).collect()
    assert len(got) == len(EXPECTED) and {r.check for r, _ in EXPECTED} == set(rules.CHECKS)
    for row, (rule, violated) in zip(got, EXPECTED, strict=True):
        assert (row.check_name, row.n_violated, row.n_rows) == (rule.check, violated, 7), rule
        assert (row.failed, row.passed, row.is_error) == (int(violated > 0), int(violated == 0), 0)


def test_thresholds_and_empty_tables(spark):
    at = lambda pct: Rule("is_required", "concept_id", None, pct)
    got = rules.table_checks(events(spark), "t", [at(14.0), at(14.3)])
    assert [r.failed for r in got.collect()] == [1, 0]
    empty = rules.table_checks(events(spark).limit(0), "t", [r for r, _ in EXPECTED], life(spark), concepts(spark))
    assert empty.where("not_applicable = 1 and passed = 1 and n_rows = 0").count() == len(EXPECTED)


def test_rules_that_cannot_be_evaluated_are_errors(spark):
    broken = [Rule("is_required", "absent"), Rule("no such check", "at"), Rule("plausible_after_birth", "at"), Rule("concept_exists", "concept_id"), Rule("is_one_of", "note"), Rule("is_required", "note")]
    got = rules.all_checks({"t": events(spark)}, {"t": broken, "gone": [Rule("is_required", "x")]})
    assert [(r.is_error, r.failed, r.passed) for r in got.collect()] == [(1, 0, 0)] * 5 + [(0, 1, 0), (1, 0, 0)]


def test_clashing_names_and_one_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").selectExpr("o_custkey as person_id", "cast(o_orderdate as date) as life", "o_orderstatus as row")
    listed = [Rule("plausible_after_birth", "life"), Rule("is_required", "row"), Rule("within_observation", "life")]
    checks = rules.table_checks(df, "t", listed, life(spark))
    assert rows(checks, "is_error") == [(0,)] * 3
    assert checks._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1


def test_rules_and_profile_of_a_dataset(spark, tmp_path):
    dataset = str(tmp_path)
    dates = lambda name: events(spark).selectExpr("person_id", f"at as {name}_start_date", f"until as {name}_end_date", "concept_id")
    stored = {
        "person": spark.createDataFrame([(1, 2000, 5, 10, 8507), (2, 1990, 1, 1, 8532)], PERSON),
        "death": spark.createDataFrame([(1, day("2020-01-01"))], "person_id long, death_date date"),
        "observation_period": spark.createDataFrame(
            [(1, day("2000-01-01"), day("2020-01-01"))],
            "person_id long, observation_period_start_date date, observation_period_end_date date",
        ),
        "visit_occurrence": dates("visit"),
        "condition_occurrence": dates("condition").withColumnRenamed("concept_id", "condition_concept_id"),
        "drug_exposure": dates("drug_exposure"),
    }
    for name, df in stored.items():
        datasets.write_table(df, dataset, name)
    got = {(r.table_name, r.check_name): r for r in pipeline.clinical_checks(spark, dataset).collect()}
    assert len(got) == 20
    assert got["visit_occurrence", "is_known_person"].n_violated == 2
    assert got["condition_occurrence", "concept_recorded"].n_violated == 1
    assert [k for k, r in got.items() if r.is_error] == [("drug_exposure", "concept_recorded")]
    profile = pipeline.dataset_profile(spark, dataset, ("person", "death"))
    assert rows(profile.where("column_name = 'person_id'"), "table_name", "n_rows", "n_distinct") == [("death", 1, 1), ("person", 2, 2)]
