import pytest
from conftest import rows

from carestrata.operators import quality

VISITS = "visit_occurrence_id long, discharged_to_source_value string, discharged_to_concept_id long"


@pytest.mark.parametrize(
    "codes, expected",
    [
        ([("01", 1), ("01 ", 1), ("03", 2), ("62", 3)], ["PASS"] * 4),
        ([(None, 0), (None, 0)], ["FAIL"] * 4),
        ([("01", 0), ("03", 0), ("62", 0)], ["FAIL", "PASS", "PASS", "PASS"]),
        ([("01", 1), ("01", 1), ("01", None)], ["FAIL", "PASS", "PASS", "FAIL"]),
        ([("01", 1), ("01", 1), ("01", 1)], ["PASS", "PASS", "PASS", "FAIL"]),
    ],
)
def test_discharge_verdict(spark, codes, expected):
    visits = spark.createDataFrame([(i, s, c) for i, (s, c) in enumerate(codes)], VISITS)
    got = quality.discharge_verdict(quality.discharge_summary(visits), min_visits=3, min_non_home=2 if len(codes) > 3 else 1)
    status = dict(rows(got, "check_name", "status"))
    assert [
        status["discharge_codes_mapped_pct"],
        status["discharge_dispositions_present"],
        status["home_discharge_present"],
        status["non_home_discharge_present"],
    ] == expected


def test_discharge_per_study(spark):
    visits = spark.createDataFrame([("a", 1, "01", 5), ("b", 2, None, 0)], "study string, " + VISITS)
    got = quality.discharge_verdict(quality.discharge_summary(visits, ["study"]), keys=["study"])
    assert got.filter("study = 'a' and status = 'PASS'").count() == 3


def test_row_counts_list_empty_tables(spark):
    df = spark.range(3)
    assert rows(quality.row_counts({"a": df, "b": df.limit(0)})) == [("a", 3), ("b", 0)]


def summary(spark, persons=3, conditions=((1, 5), (1, 0), (9, 5))):
    person = spark.range(persons).selectExpr("id as person_id")
    schema = "person_id long, condition_concept_id long"
    cond = spark.createDataFrame([*conditions], schema)
    eras = spark.createDataFrame([(1,), (9,)], "person_id long")
    return quality.dataset_summary({"x": person, "y": person.limit(0)}, person, eras, eras, cond, eras, eras)


def test_summary_counts_known_persons_only(spark):
    row = summary(spark).first().asDict()
    assert row == {
        "staged_rows": 3, "staged_tables_with_rows": 1, "person_rows": 3, "visit_rows": 2, "procedure_rows": 1,
        "condition_rows": 2, "mapped_condition_rows": 1, "condition_era_rows": 1, "drug_era_rows": 1,
    }
    assert quality.mapped_percentage(summary(spark)).first().mapped_condition_pct == 50.0


def test_gate_fails_on_null_percentage(spark):
    empty = summary(spark, conditions=())
    assert rows(quality.threshold_gate(empty), "metric", "status") == [("mapped_condition_pct", "FAIL"), ("person_rows", "PASS")]
    failures = quality.stage_failures(quality.threshold_gate(empty), "summary")
    assert rows(failures, "stage") == [("summary",)]
    assert rows(quality.threshold_gate(summary(spark), 4, 50.0), "metric", "status") == [
        ("mapped_condition_pct", "PASS"), ("person_rows", "FAIL"),
    ]


def test_run_filter_and_prefix_filter(spark):
    df = spark.createDataFrame([("r1", "csv:1"), ("r2", "2")], "run_name string, person_source_value string")
    assert quality.of_run(df, "r1").count() == 1
    assert quality.of_run(df.drop("run_name"), "r1").count() == 2
    assert quality.with_source_prefix(df, "csv:").count() == 1
    assert quality.with_source_prefix(df, "none:").count() == 2


def test_age_profile(spark):
    person = spark.createDataFrame([(2006,), (2005,), (1950,)], "year_of_birth int")
    assert tuple(quality.age_profile(person, 2024).first()) == (3, 1, 1950, 2006)


@pytest.mark.parametrize("length, width", [(0, 64), (63, 64), (64, 128), (100, 128), (127, 128), (128, 256), (5000, 8192)])
def test_suggested_width(spark, length, width):
    df = spark.createDataFrame([(length,)], "n int")
    assert df.select(quality.suggested_width("n")).first()[0] == width


def test_column_profile(spark):
    df = spark.createDataFrame([("abc", "x" * 70, 1), (None, "y", 2)], "a string, b string, n int")
    got = quality.column_profile(df, "t", {"a": 3, "b": 50})
    assert rows(got, "column_name", "max_length", "suggested_width", "must_widen") == [("a", 3, 3, False), ("b", 70, 128, True)]


def test_field_profile(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 3)], "s string, n int")
    assert rows(quality.field_profile(df, "t"), "column_name", "n_rows", "n_null", "n_distinct") == [("n", 3, 1, 2), ("s", 3, 1, 1)]


def test_checks_flag_violations(spark):
    df = spark.createDataFrame([(1, 5), (1, None), (2, 50)], "k int, v int")
    parent = spark.createDataFrame([(1,)], "p int")
    results = quality.check_results(
        [
            quality.field_checks(df, "t", [("is_required", "v", None, 50.0), ("plausible_high", "v", 10, 0.0)]),
            quality.field_checks(df.limit(0), "empty", [("is_required", "v", None, 0.0)]),
            quality.primary_key_check(df, "t", ["k"]),
            quality.foreign_key_check(df, "t", "k", parent, "p"),
            quality.field_checks(df, "skipped", [("is_required", "v", None, 0.0)]),
        ],
        exclude=("skipped",),
    )
    assert rows(results, "check_name", "n_violated", "failed", "not_applicable") == [
        ("is_foreign_key", 1, 1, 0),
        ("is_primary_key", 2, 1, 0),
        ("is_required", 0, 0, 1),
        ("is_required", 1, 0, 0),
        ("plausible_high", 1, 1, 0),
    ]
    assert tuple(quality.check_summary(results).first()) == (3, 2, 0, 1, 5)


def test_warnings_are_a_top_fifty(spark):
    assert quality.top_warnings(spark.range(80), ["id"]).count() == 50
