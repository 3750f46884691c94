import random
from datetime import timedelta

import pytest
from conftest import day, in_order, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from carestrata.operators import intervals
from carestrata.operators.ids import with_surrogate_id

BASE = day("2020-01-01")


def frame(spark, spans):
    data = [(k, BASE + timedelta(a), BASE + timedelta(b)) for k, a, b in spans]
    return spark.createDataFrame(data, "k int, start_date date, end_date date")


def brute_force(spans, gap):
    """Merge by repeated pairwise comparison."""
    out = []
    for key in {k for k, _, _ in spans}:
        islands = [[a, max(a, b), 1] for k, a, b in spans if k == key]
        merged = True
        while merged:
            merged = False
            for i in range(len(islands)):
                for j in range(i + 1, len(islands)):
                    x, y = islands[i], islands[j]
                    if x[0] <= y[1] + gap and y[0] <= x[1] + gap:
                        islands[i] = [min(x[0], y[0]), max(x[1], y[1]), x[2] + y[2]]
                        del islands[j]
                        merged = True
                        break
                if merged:
                    break
        out += [(key, BASE + timedelta(a), BASE + timedelta(b), n) for a, b, n in islands]
    return in_order(out)


def collapse(spark, spans, gap, **kwargs):
    return intervals.collapse_intervals(frame(spark, spans), ["k"], "start_date", "end_date", gap, **kwargs)


@pytest.mark.parametrize(
    "spans, gap, islands",
    [
        ([(1, 0, 5), (1, 5, 9)], 0, 1),  # touching
        ([(1, 0, 5), (1, 6, 9)], 0, 2),
        ([(1, 0, 5), (1, 35, 40)], 30, 1),  # exactly the gap
        ([(1, 0, 5), (1, 36, 40)], 30, 2),
        ([(1, 0, 50), (1, 10, 20), (1, 45, 60)], 0, 1),  # contained, then overlapping
        ([(1, 0, 2), (1, 0, 9), (1, 0, 1)], 0, 1),  # equal starts
        ([(1, 0, 5), (2, 3, 9)], 0, 2),  # other key
        ([(1, 9, 5), (1, 9, 9)], 0, 1),  # end before start counts as its start
    ],
)
def test_hand_cases(spark, spans, gap, islands):
    got = collapse(spark, spans, gap)
    assert got.count() == islands
    assert rows(got) == brute_force(spans, gap)


spans_strategy = st.lists(
    st.tuples(st.integers(1, 3), st.integers(0, 60), st.integers(0, 12)).map(lambda t: (t[0], t[1], t[1] + t[2])),
    min_size=1,
    max_size=40,
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(spans=spans_strategy, gap=st.sampled_from([0, 1, 5]))
def test_equals_brute_force(spark, spans, gap):
    got = collapse(spark, spans, gap)
    assert rows(got) == brute_force(spans, gap)
    again = intervals.collapse_intervals(got, ["k"], "start_date", "end_date", gap, count="n_intervals")
    assert rows(again) == rows(got)
    assert sum(r[3] for r in rows(got)) == len(spans)


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_same_result_for_any_partitioning(spark, partitions):
    spans = [(i % 3, (i * 7) % 200, (i * 7) % 200 + i % 9) for i in range(300)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        df = frame(spark, spans).repartition(partitions)
        got = intervals.collapse_intervals(df, ["k"], "start_date", "end_date", 2)
        numbered = with_surrogate_id(got, "id", ["k", "start_date"])
        assert rows(got) == brute_force(spans, 2)
        assert [r[0] for r in sorted(rows(numbered, "id", "k", "start_date"))] == list(range(1, got.count() + 1))
        in_order = [r[1:] for r in sorted(rows(numbered, "id", "k", "start_date"))]
        assert in_order == sorted(in_order)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_one_key_with_most_rows_reaches_the_window_as_days(spark):
    """A hot key is combined to one row per start date ahead of the window."""
    df = spark.range(200_000).selectExpr(
        "if(id % 3 = 0, id, 7) as k", "date_add(date'2020-01-01', cast(id % 30 as int)) as start_date"
    ).withColumn("end_date", F.date_add("start_date", 1))
    got = intervals.collapse_intervals(df, ["k"], "start_date", "end_date", 1)
    hot = got.filter("k = 7").collect()
    assert [(r.start_date, r.n_intervals) for r in hot] == [(BASE + timedelta(1), 133_333)]


def test_smallest_and_total_columns(spark):
    df = frame(spark, [(1, 0, 3), (1, 2, 5), (1, 9, 9)]).withColumn("v", F.dayofmonth("start_date").cast("long"))
    got = intervals.collapse_intervals(
        df.withColumn("w", F.col("v")), ["k"], "start_date", "end_date", count=None, smallest=("v",), total=("w",)
    )
    assert rows(got, "start_date", "v", "w") == [(day("2020-01-01"), 1, 4), (day("2020-01-10"), 10, 10)]


EXPOSURES = (
    "person_id long, drug_concept_id long, drug_exposure_start_date date, drug_exposure_end_date date, days_supply int"
)


@pytest.fixture()
def drugs(spark):
    concept = spark.createDataFrame(
        [(1, "RxNorm", "Ingredient"), (2, "RxNorm", "Ingredient"), (3, "ATC", "Ingredient")],
        "concept_id long, vocabulary_id string, concept_class_id string",
    )
    closure = spark.createDataFrame(
        [(1, 10), (2, 10), (1, 11), (3, 11), (1, 1)], "ancestor_concept_id long, descendant_concept_id long"
    )
    return concept, closure


def test_exposure_end_is_imputed(spark, drugs):
    start = day("2020-01-01")
    data = [
        (1, 11, start, day("2020-02-01"), 5),
        (2, 11, start, None, 5),
        (3, 11, start, None, 0),
        (4, 11, start, None, None),
        (5, 11, start, None, -1),
        (6, 0, start, None, 5),
        (7, 99, start, None, 5),
    ]
    got = intervals.ingredient_exposures(spark.createDataFrame(data, EXPOSURES), *drugs)
    assert rows(got, "person_id", "end_date") == [
        (1, day("2020-02-01")), (2, day("2020-01-06")), (3, day("2020-01-02")), (4, day("2020-01-02")),
    ]


def test_drug_era_counts_exposures_and_gap_days(spark, drugs):
    data = [
        (1, 10, day("2020-01-01"), day("2020-01-11"), None),
        (1, 11, day("2020-01-11"), day("2020-01-21"), None),
        (1, 11, day("2020-02-20"), day("2020-02-25"), None),  # 30 days later: same era
        (1, 11, day("2020-03-27"), day("2020-03-28"), None),  # 31 days later: new era
    ]
    eras = intervals.with_era_id(intervals.drug_eras(spark.createDataFrame(data, EXPOSURES), *drugs), "drug")
    assert rows(eras) == [
        (1, 1, 1, day("2020-01-01"), day("2020-02-25"), 3, 30),
        (2, 1, 1, day("2020-03-27"), day("2020-03-28"), 1, 0),
        (3, 1, 2, day("2020-01-01"), day("2020-01-11"), 1, 0),
    ]


def eras_in_two_passes(ingredient_rows, gap):
    """Stretches first, then eras of stretches."""
    eras = intervals.collapse_intervals(
        intervals.sub_exposures(ingredient_rows), ["person_id", "ingredient_concept_id"], "start_date", "end_date", gap,
        count="drug_exposure_count", total=("days_exposed",), distinct_starts=True,
    )
    gaps = F.datediff("end_date", "start_date") - F.col("days_exposed")
    return eras.select("person_id", "ingredient_concept_id", "start_date", "end_date", "drug_exposure_count", gaps.alias("g"))


@pytest.mark.parametrize("gap", [-3, 0, 4, 30])
def test_eras_in_one_order_are_those_of_two_passes(spark, drugs, gap):
    rng = random.Random(gap)
    when = lambda a: None if a is None else BASE + timedelta(a)
    data = [(p, 10, when(None), when(rng.choice([None, 3, 40])), None) for p in range(0, 60, 2)]
    for _ in range(500):
        a = rng.randrange(80)
        end = rng.choice([None, a + rng.randrange(-3, 20)])
        data.append((rng.choice([None, *range(60)]), rng.choice([10, 11]), when(a), when(end), rng.choice([None, 0, 4])))
    exposures = spark.createDataFrame(data, EXPOSURES)
    expected = eras_in_two_passes(intervals.ingredient_exposures(exposures, *drugs), gap)
    got = intervals.drug_eras(exposures, *drugs, gap)
    assert rows(got) == rows(expected)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("Aggregate")  # nothing is held by era, only sorted once


@pytest.mark.parametrize("gap", [0, 3])
def test_counted_intervals_are_sorted_once(spark, gap):
    rng = random.Random(gap)
    when = lambda a: None if a is None else BASE + timedelta(a)
    days = [None, *range(60)]
    data = [(rng.choice([None, *range(20)]), when(a := rng.choice(days)), when(None if a is None else a + rng.randrange(-2, 6)), 1) for _ in range(400)]
    data += [(k, None, when(rng.choice([2, 30])), 1) for k in range(0, 20, 3)]
    df = spark.createDataFrame(data, "k int, start_date date, end_date date, n int")
    expected = intervals.collapse_intervals(df, ["k"], "start_date", "end_date", gap, count="n")
    got = intervals.collapse_intervals(df.drop("n"), ["k"], "start_date", "end_date", gap, count="n")
    assert got.columns == expected.columns and rows(got) == rows(expected)
    bare = intervals.collapse_intervals(df.drop("n"), ["k"], "start_date", "end_date", gap, count=None)
    assert rows(bare) == rows(expected, "k", "start_date", "end_date")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("Aggregate")


def test_condition_era_ends_the_next_day_when_open(spark):
    data = [(1, 5, day("2020-01-01"), None), (1, 5, day("2020-02-01"), None), (1, 5, day("2020-03-05"), day("2020-03-06"))]
    df = spark.createDataFrame(
        data, "person_id long, condition_concept_id long, condition_start_date date, condition_end_date date"
    )
    assert rows(intervals.condition_eras(df)) == [
        (1, 5, day("2020-01-01"), day("2020-02-02"), 2), (1, 5, day("2020-03-05"), day("2020-03-06"), 1),
    ]


def test_ids_split_a_hot_leading_key(spark):
    df = spark.range(5000).selectExpr("if(id % 3 = 0, id, -1) as a", "id as b")
    got = with_surrogate_id(df, "n", ["a", "b"]).orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 5001))
    assert [(r.a, r.b) for r in got] == sorted((r.a, r.b) for r in got)
