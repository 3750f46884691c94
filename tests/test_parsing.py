import re

import pytest
from conftest import day
from pyspark.sql import functions as F

from carestrata.functions import codes, encounter_classes, parsing


def apply(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in sorted(df.select("i", fn("v").alias("o")).collect())]


def test_staging_dates_take_integers_before_dates(spark):
    values = ["-12592", "11654", "2020-01-02T03:04:05Z", "2020-01-02", "", "abc", None, "2020", "99999999999"]
    assert apply(spark, values, parsing.staging_date) == [
        day("1935-07-12"),
        day("2001-11-28"),
        day("2020-01-02"),
        day("2020-01-02"),
        None,
        None,
        None,
        day("1975-07-14"),
        None,
    ]


def test_staging_timestamp_keeps_the_wall_clock(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        got = apply(spark, ["2020-01-02T03:04:05Z"], lambda c: parsing.staging_timestamp(c).cast("string"))
        assert got == ["2020-01-02 03:04:05"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_death_dates(spark):
    values = ["2001-11-28", "11654", "-12592", "  ", "", "n/a", "1 2", None, "2001-13-45"]
    assert apply(spark, values, parsing.death_date) == [
        day("2001-11-28"), day("2001-11-28"), day("1935-07-12"), None, None, None, None, None, None,
    ]


def test_compact_dates(spark):
    assert apply(spark, ["19700101", "20991231", "19991332", "1970-01-01", None], parsing.compact_date) == [
        day("1970-01-01"), day("2099-12-31"), None, None, None,
    ]


def test_two_digit_codes_never_lose_digits(spark):
    assert apply(spark, ["1", "01", " 3 ", "", "123", " ", None], parsing.two_digit_code) == [
        "01", "01", "03", None, "123", None, None,
    ]


def test_numbers_prefixes_slugs_and_search(spark):
    assert apply(spark, ["1.5", "x", None], parsing.tolerant_double) == [1.5, None, None]
    assert apply(spark, ["a" * 60], parsing.text_prefix) == ["a" * 50]
    assert apply(spark, ["Study A--b (2)"], parsing.slug) == ["study_a_b_2_"]
    assert apply(spark, ["50% Off", "500 off"], lambda c: parsing.contains_ignoring_case(c, "50% o")) == [True, False]


def test_blank_and_null_conversions_respect_types(spark):
    df = spark.createDataFrame([("", None, None), ("x", "y", 1)], "a string, b string, n int")
    assert [tuple(r) for r in parsing.blank_to_null(df, ("a", "missing")).collect()] == [(None, None, None), ("x", "y", 1)]
    assert [tuple(r) for r in parsing.null_to_blank(df, ("b", "n")).collect()] == [("", "", None), ("x", "y", 1)]


def test_visit_concepts_keep_urgent_care_out_of_the_emergency_room(spark):
    got = apply(spark, ["inpatient", "wellness", "emergency", "urgentcare", "hospice"], encounter_classes.visit_concept)
    assert got == [9201, 9202, 9203, 8782, 0]


@pytest.mark.parametrize(
    "mine, theirs, visit, expected",
    [
        ("emergency", "inpatient", 1, 1),
        ("urgentcare", "emergency", 1, 2),
        ("urgentcare", "ambulatory", 1, 99),
        ("wellness", "outpatient", 1, 2),
        ("inpatient", "inpatient", 1, 1),
        ("inpatient", "emergency", 1, 99),
        ("emergency", "inpatient", None, 99),
        ("hospice", "inpatient", 1, 99),
    ],
)
def test_visit_priority(spark, mine, theirs, visit, expected):
    df = spark.createDataFrame([(mine, theirs, visit)], "a string, b string, v long")
    assert df.select(encounter_classes.visit_priority("a", "b", "v")).first()[0] == expected


def test_code_systems(spark):
    assert apply(spark, ["SNOMED-CT", "CPT", "NUBC", "Other"], codes.vocabulary_of_system) == ["SNOMED", "CPT4", "NUBC", None]
    assert apply(spark, ["REPLACE_ME", "x"], codes.is_placeholder) == [True, False]
    df = spark.createDataFrame([("S", None), ("S", ""), ("C", None)], "standard_concept string, invalid_reason string")
    assert df.filter(codes.is_valid_standard()).count() == 1


def test_standardise_staging_touches_known_columns_only(spark):
    df = spark.createDataFrame([("11654", "11654")], "birthdate string, code string")
    out = parsing.standardise_staging(df).select(F.col("birthdate").cast("string"), "code").first()
    assert tuple(out) == ("2001-11-28 00:00:00", "11654")


def test_texts_are_looked_at_before_they_are_cast(spark):
    """A cast that refuses a text takes some twenty times as long as a look at it."""
    df = spark.createDataFrame([("x",)], "v string").repartition(1)
    looks = {"int": r"RLIKE(v, ^[\s\p{Cntrl}]*[+-]?[0-9]+[\s\p{Cntrl}]*$)", "double": "RLIKE(v, ^"}
    for fn, kind in ((parsing.staging_date, "int"), (parsing.death_date, "int"), (parsing.tolerant_double, "double")):
        plan = re.sub(r"#\d+", "", df.select(fn("v").alias("o"))._jdf.queryExecution().optimizedPlan().toString())
        assert 0 <= plan.find(looks[kind]) < plan.index(f"try_cast(v as {kind})")


def test_looking_first_changes_no_date_and_no_number(spark):
    values = [
        "12", " 12 ", "+5", "-5", "\t7\n", "\x1f8\x7f", "1.5", "5-", "--5", "+", "-", "", " ", "1 2", "1e3", "0x1p3", "5d", "5f", "5L",
        "2020-1-2", " 2020-01-02", "2020-01-02 ", "2020-01-02x", "2020-01-02T03:04:05Z", "2020-13-45", "12020-01-02", "-2020-01-02",
        "99999999999", "2147483647", "-719162", "-719163", "2932896", "2932897", "٣", " 5", " 5", "NaN", " nan ", "-inf", "+Infinity",
        "infinit", "nano", ".5", "-.5", "5.", ".", "$5", "x5", "5x", "N-O", "\n3", "3\r\n", "\u00855", None,
    ]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").repartition(2)
    day_number = F.expr("try_cast(v as int)")
    days = F.when(day_number.between(-719162, 2932896), F.date_add(F.lit("1970-01-01").cast("date"), day_number)).cast("timestamp_ntz")
    moment = F.when(day_number.isNotNull(), days).when(F.col("v").rlike(r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"), F.expr("try_cast(v as timestamp_ntz)"))
    got = df.select("i", "v", parsing.staging_timestamp("v").cast("string").alias("t"), moment.cast("string").alias("was"), parsing.tolerant_double("v").cast("string").alias("n"), F.expr("cast(try_cast(v as double) as string)").alias("n_was"))
    wrong = [tuple(r) for r in got.collect() if (r.t, r.n) != (r.was, r.n_was)]
    assert not wrong
