from conftest import day, in_order, rows

from carestrata.operators import cohorts, edges

COHORT = "study string, cohort_id int, subject_id long, cohort_start_date date, cohort_end_date date"
START, END = day("2020-06-01"), day("2020-06-02")


def cohort(spark, members):
    data = [("s", c, p, START, END) for c, people in members.items() for p in people]
    return spark.createDataFrame(data + data[:1], COHORT)


def studies(spark, target=1, least=(100, 10, 1), study="s"):
    return spark.createDataFrame(
        [(study, target, *least)],
        "study string, target_id int, min_target_subjects long, min_outcome_subjects long, min_covariate_subjects long",
    )


def manifest(spark, outcomes=(2,), empty=(), failed=(), hand=(), ids=(1, 2, 3, 4), study="s"):
    return spark.createDataFrame(
        [(study, i, f"c{i}", i in outcomes, i in empty, "FAILED" if i in failed else None, i in hand) for i in ids],
        "study string, cohort_id int, cohort_name string, is_outcome boolean, expected_empty boolean, "
        "failed string, hand_authored boolean",
    )


def counts(spark, data):
    return spark.createDataFrame(
        [("s", *r) for r in data], "study string, cohort_id int, subjects long, subjects_in_target long"
    )


def statuses(df):
    return dict(rows(df, "cohort_id", "status"))


def test_thresholds(spark):
    got = cohorts.evaluate_thresholds(
        manifest(spark, failed=(3,), hand=(4,)),
        studies(spark),
        counts(spark, [(1, 120, 120), (2, 50, 8), (3, 5, 0)]),
    )
    assert statuses(got) == {1: "PASS", 2: "FAIL", 3: "FAIL", 4: "FAIL"}
    by_id = {r.cohort_id: r for r in got.collect()}
    assert [by_id[i].role for i in (1, 2, 3, 4)] == ["target", "outcome", "covariate", "covariate"]
    assert by_id[2].metric == "subjects_in_target" and by_id[2].subjects_in_target == 8
    assert by_id[1].subjects_in_target is None
    assert "generation failed" in by_id[3].note and "hand-authored" in by_id[4].note
    assert by_id[4].subjects == 0


def test_expected_empty_has_no_minimum(spark):
    found = counts(spark, [(1, 120, 120), (2, 50, 20)])
    got = cohorts.evaluate_thresholds(manifest(spark, outcomes=(2, 4), empty=(4,)), studies(spark), found)
    by_id = {r.cohort_id: r for r in got.collect()}
    assert by_id[4].status == "PASS" and "expected empty" in by_id[4].note and by_id[4].threshold == 0
    assert statuses(cohorts.evaluate_thresholds(manifest(spark, outcomes=(2, 4)), studies(spark), found))[4] == "FAIL"


def test_missing_thresholds_take_the_defaults(spark):
    plain = spark.createDataFrame([("s", 1)], "study string, target_id int")
    got = cohorts.evaluate_thresholds(manifest(spark), plain, counts(spark, []))
    assert dict(rows(got, "cohort_id", "threshold")) == {1: 100, 2: 10, 3: 1, 4: 1}


def test_qc_end_to_end(spark):
    people = cohort(spark, {1: range(1, 11), 2: [1, 2, 3, 4, 11, 12], 3: [1]})
    got = cohorts.cohort_qc(people, studies(spark, least=(5, 3, 2)), manifest(spark, ids=(1, 2, 3)))
    assert rows(got, "cohort_id", "subjects", "subjects_in_target", "status") == [
        (1, 10, None, "PASS"), (2, 6, 4, "PASS"), (3, 1, None, "FAIL"),
    ]
    assert rows(cohorts.target_overlap(people, studies(spark), manifest(spark)), "cohort_id", "subjects_in_target") == [(2, 4)]


def test_studies_without_roles_are_rows_not_errors(spark):
    all_studies = studies(spark).unionByName(studies(spark, None, study="t")).unionByName(studies(spark, 9, study="u"))
    listed = manifest(spark).unionByName(manifest(spark, study="t")).unionByName(manifest(spark, study="u"))
    found = cohorts.study_problems(all_studies, listed)
    assert [r[0] for r in rows(found, "study")] == ["t", "u"]
    got = cohorts.cohort_qc(cohort(spark, {1: [1]}), all_studies, listed)
    assert {r[0] for r in rows(got, "study")} == {"s"}


EVENTS = "person_id long, concept_id long, start_date date, end_date date"


def instantiate(spark, events, first_only=True, inclusion=None, prior=0, post=0, pad=0, exit_at="end_date"):
    definitions = spark.createDataFrame(
        [("s", 1, prior, post, first_only)], "study string, cohort_id int, prior_days int, post_days int, first_only boolean"
    )
    entry = spark.createDataFrame([("s", 1, 100)], "study string, cohort_id int, concept_id long")
    periods = spark.createDataFrame(
        [(p, day("2020-01-01"), day("2020-12-31")) for p in range(1, 6)],
        "person_id long, observation_period_start_date date, observation_period_end_date date",
    )
    rules = inclusion and spark.createDataFrame(
        [("s", 1, *r) for r in inclusion], "study string, cohort_id int, rule int, min_count int, concept_id long"
    )
    df = spark.createDataFrame([(p, c, day(a), day(b)) for p, c, a, b in events], EVENTS)
    got = cohorts.instantiate_cohorts(definitions, entry, df, periods, rules, pad, exit_at)
    return rows(got, "subject_id", "cohort_start_date", "cohort_end_date")


def test_first_event_in_the_observation_window(spark):
    events = [
        (1, 100, "2019-12-31", "2020-01-05"),
        (1, 100, "2020-03-01", "2020-03-02"),
        (1, 100, "2020-02-01", "2020-02-09"),
        (1, 100, "2020-02-01", "2020-02-03"),
        (2, 200, "2020-02-01", "2020-02-03"),
    ]
    assert instantiate(spark, events) == [(1, day("2020-02-01"), day("2020-02-03"))]
    assert instantiate(spark, events, prior=45) == [(1, day("2020-03-01"), day("2020-03-02"))]
    assert instantiate(spark, events, post=335) == []
    assert instantiate(spark, events, exit_at="observation_period_end_date") == [(1, day("2020-02-01"), day("2020-12-31"))]
    assert instantiate(spark, events, first_only=False, pad=30) == [(1, day("2020-02-01"), day("2020-03-02"))]


def test_every_rule_needs_its_number_of_events(spark):
    events = [(p, 100, "2020-02-01", "2020-02-02") for p in (1, 2, 3)]
    events += [(1, 7, "2020-03-01", "2020-03-01"), (1, 7, "2020-03-02", "2020-03-02"), (1, 8, "2020-03-01", "2020-03-01")]
    events += [(2, 7, "2020-03-01", "2020-03-01"), (2, 8, "2020-03-01", "2020-03-01")]
    events += [(3, 7, "2020-03-01", "2020-03-01")] * 2
    assert [r[0] for r in instantiate(spark, events, inclusion=[(1, 2, 7), (2, 1, 8)])] == [1]
    assert [r[0] for r in instantiate(spark, events, inclusion=[(1, 1, 7), (1, 1, 8)])] == [1, 2, 3]


def test_membership_difference(spark):
    left = spark.createDataFrame([("a",), ("b",), ("b",)], "s string")
    right = spark.createDataFrame([("b",), ("c",)], "s string")
    assert rows(edges.membership_difference(left, right, ["s"])) == [("a", "right"), ("c", "left")]


def graph(spark, links, names=("Initial", "Branch", "A", "Terminal")):
    nodes = spark.createDataFrame([(n,) for n in names], "name string")
    return nodes, spark.createDataFrame(links, "src string, dst string, weight double")


SOUND = [("Initial", "Branch", None), ("Branch", "A", 0.3), ("Branch", "Terminal", 0.7), ("A", "Terminal", None)]


def test_sound_graph(spark):
    assert rows(edges.graph_problems(*graph(spark, SOUND))) == []


def test_broken_graphs(spark):
    dangling = graph(spark, SOUND[:3] + [("A", "Nowhere", None)])
    assert rows(edges.graph_problems(*dangling)) == [("missing target", "Nowhere")]
    orphan = graph(spark, SOUND + [("Orphan", "Terminal", None)], ("Initial", "Branch", "A", "Terminal", "Orphan"))
    assert rows(edges.graph_problems(*orphan)) == [("no inbound edge", "Orphan")]
    heavy = graph(spark, [SOUND[0], ("Branch", "A", 0.5), ("Branch", "Terminal", 0.7), SOUND[3]])
    assert rows(edges.unbalanced_weights(heavy[1])) == [("Branch", 1.2)]
    tiny = graph(spark, [SOUND[0], ("Branch", "A", 0.3 + 5e-7), ("Branch", "Terminal", 0.7), SOUND[3]])
    assert rows(edges.graph_problems(*tiny)) == []


def test_many_graphs_at_once(spark):
    nodes, links = graph(spark, SOUND)
    both = lambda df: df.selectExpr("'a' as g", "*").unionByName(df.selectExpr("'b' as g", "*"))
    extra = spark.createDataFrame([("b", "A", "Gone", None)], "g string, src string, dst string, weight double")
    got = edges.graph_problems(both(nodes), both(links).unionByName(extra), ("g",))
    assert rows(got) == [("b", "missing target", "Gone")]


def test_collapse_keeps_cohorts_apart(spark):
    data = [("s", c, 1, day("2020-01-01"), day("2020-01-05")) for c in (1, 2)] + [
        ("s", 1, 1, day("2020-01-07"), day("2020-01-09"))
    ]
    got = cohorts.collapse_cohorts(spark.createDataFrame(data, COHORT), 2)
    assert rows(got, "cohort_id", "cohort_end_date") == in_order([(1, day("2020-01-09")), (2, day("2020-01-05"))])
