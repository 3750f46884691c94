import json

import pytest
from conftest import rows

from carestrata.operators import coverage, documents, vocab


def code(system, value, display=None):
    return {"system": system, "code": value} | ({"display": display} if display else {})


def modules(spark, **docs):
    return spark.createDataFrame(
        [(name, json.dumps({"states": states})) for name, states in docs.items()], "module string, document string"
    )


STATES = {
    "Onset": {"type": "ConditionOnset", "codes": [code("SNOMED-CT", "C1", "one")], "direct_transition": "Proc"},
    "Proc": {
        "type": "Procedure",
        "codes": [code("SNOMED-CT", "P1"), code("SNOMED-CT", "P1")],
        "conditional_transition": [{"condition": {"codes": [code("SNOMED-CT", "GUARD")]}, "transition": "Lab"}],
    },
    "Lab": {"type": "Observation", "codes": [code("LOINC", "L1")], "value_code": code("SNOMED-CT", "V1")},
    "Plan": {"type": "Other", "goals": [{"observation": {"deep": [[code("LOINC", 77)]]}}], "note": "system"},
    "Odd": {"type": "Other", "system": {"nested": 1}, "code": "x"},
    "Stop": {"type": "ConditionEnd", "codes": [code("SNOMED-CT", "END")]},
    "Untyped": {"codes": [code("SNOMED-CT", "U1")]},
}


def test_emitted_codes_skip_guards_and_end_states(spark):
    got = documents.emitted_codes(modules(spark, m=STATES))
    assert rows(got, "state", "state_type", "code", "display") == [
        ("Lab", "Observation", "L1", ""),
        ("Lab", "Observation", "V1", ""),
        ("Onset", "ConditionOnset", "C1", "one"),
        ("Plan", "Other", "77", ""),
        ("Proc", "Procedure", "P1", ""),
        ("Untyped", "", "U1", ""),
    ]


def test_broken_and_stateless_documents_emit_nothing(spark):
    df = spark.createDataFrame([("a", "not json"), ("b", "{}"), ("c", '{"states": []}')], "module string, document string")
    assert documents.emitted_codes(df).count() == 0


def test_documents_are_searched_at_any_depth(spark):
    nested = code("X", "1")
    for depth in range(2 * documents.LEVELS_AT_ONCE + 2):
        nested = {"k": nested, "other": [code("Y", str(depth))]}
    got = documents.emitted_codes(modules(spark, m={"S": nested}))
    found = set(rows(got, "system", "code"))
    assert found == {("X", "1")} | {("Y", str(d)) for d in range(2 * documents.LEVELS_AT_ONCE + 2)}


def test_custom_modules_are_not_counted_twice(spark):
    schema = "path string, document string"
    custom = spark.createDataFrame([("x/mine.json", "1")], schema)
    built_in = spark.createDataFrame([("mine.json", "1"), ("sub/other.json", "2")], schema)
    assert rows(documents.label_modules(custom, built_in)) == [("built-in:sub/other.json", "2"), ("custom", "1")]


def item(concept, descendants=None, excluded=None):
    out = {"concept": {"CONCEPT_ID": concept, "CONCEPT_NAME": "n"}}
    if descendants is not None:
        out["includeDescendants"] = descendants
    if excluded is not None:
        out["isExcluded"] = excluded
    return out


def counted(codeset, kind="Measurement", occurrence=2, least=1):
    inner = {"CodesetId": codeset} if codeset is not None else {}
    return {"Criteria": {kind: inner}, "Occurrence": {"Type": occurrence, "Count": least}}


def group(kind, criteria, groups=()):
    return {"Type": kind, "CriteriaList": criteria, "Groups": list(groups)}


def definition(primary, rules=(), sets=None):
    return json.dumps(
        {
            "ConceptSets": [
                {"id": i, "name": str(i), "expression": {"items": items}} for i, items in (sets or {}).items()
            ],
            "PrimaryCriteria": {
                "CriteriaList": [{kind: {} if s is None else {"CodesetId": s}} for kind, s in primary]
            },
            "InclusionRules": [{"name": "r", "expression": g} for g in rules],
        }
    )


def cohort_documents(spark, **docs):
    return spark.createDataFrame(list(docs.items()), "cohort_id string, document string")


def requirement_lists(spark, *groups):
    df = documents.required_sets(cohort_documents(spark, c=definition([("ConditionOccurrence", 0)], groups)))
    found = {}
    for _, requirement, set_id in rows(df):
        found.setdefault(requirement, []).append(set_id)
    return sorted(found.values())


def test_concept_set_flags_default_to_false(spark):
    docs = cohort_documents(spark, c=definition([], sets={4: [item(9), item(8, True, True)], 5: []}))
    assert rows(documents.concept_set_items(docs)) == [("c", 4, 8, True, True, False), ("c", 4, 9, False, False, False)]


def test_all_groups_any_groups_and_absences(spark):
    assert requirement_lists(
        spark,
        group("ALL", [counted(1), counted(7, occurrence=0, least=0), counted(8, occurrence=1, least=3)]),
        group("any", [counted(0)]),
    ) == [[0], [1]]


def test_any_group_is_one_requirement_and_skipped_if_mixed(spark):
    assert requirement_lists(spark, group("ANY", [counted(1), counted(2), counted(2)])) == [[1, 2]]
    assert requirement_lists(spark, group("ANY", [counted(1), counted(2, occurrence=0, least=0)])) == []
    assert requirement_lists(spark, group("ANY", [counted(1), counted(None)])) == []
    assert requirement_lists(spark, group("ANY", [counted(1)], [group("ALL", [counted(2)])])) == []
    assert requirement_lists(spark, group("AT_LEAST", [counted(1)])) == []


def test_visit_criteria_require_nothing(spark):
    assert requirement_lists(spark, group("ALL", [counted(1, "VisitOccurrence"), counted(2, "VisitDetail")])) == []
    assert requirement_lists(spark, group("ANY", [counted(1), counted(2, "VisitDetail")])) == []


def test_sub_groups_of_all_groups_are_walked(spark):
    inner = group("ALL", [counted(3)], [group("ANY", [counted(4), counted(5)])])
    assert requirement_lists(spark, group("ALL", [counted(1)], [inner])) == [[1], [3], [4, 5]]


def test_groups_nest_to_any_depth(spark):
    nested = group("ALL", [counted(1)])
    for depth in range(documents.LEVELS_AT_ONCE + 2):
        nested = group("ALL", [counted(depth + 2)], [nested])
    assert requirement_lists(spark, nested) == [[i] for i in range(1, documents.LEVELS_AT_ONCE + 4)]


def test_quoted_ids_are_read_and_broken_documents_reported(spark):
    text = definition([], sets={4: [item("9")], 5: [item("nine")]})
    docs = cohort_documents(spark, a=text, b="{broken")
    assert rows(documents.concept_set_items(docs), "set_id", "concept_id") == [(4, 9), (5, None)]
    assert rows(documents.document_problems(docs)) == [("a", "concept id is no number"), ("b", "document cannot be read")]


def test_primary_criteria(spark):
    docs = cohort_documents(
        spark,
        a=definition([("ConditionOccurrence", 0), ("DrugExposure", 0), ("Measurement", 2)]),
        b=definition([("ConditionOccurrence", 0), ("ObservationPeriod", None)]),
        c=definition([("VisitOccurrence", 0)]),
        d=definition([]),
    )
    assert rows(documents.primary_criteria(docs)) == [
        ("a", [0, 2], False, False), ("b", [0], True, False), ("c", [], False, True), ("d", [], True, False),
    ]


def verdict(spark, primary, rules, hits):
    docs = cohort_documents(spark, c=definition(primary, rules))
    found = spark.createDataFrame([("c", s) for s in hits], "cohort_id string, set_id int")
    row = coverage.cohort_verdicts(documents.primary_criteria(docs), documents.required_sets(docs), found).first()
    return row.status, row.missing_sets, row.note != ""


COND, VISIT, NONE = "ConditionOccurrence", "VisitOccurrence", "ObservationPeriod"


@pytest.mark.parametrize(
    "primary, rules, hits, expected",
    [
        ([(COND, 0), (COND, 1)], [group("ALL", [counted(2)])], [0, 2], ("COVERED", [], False)),
        ([(COND, 0), (COND, 1)], [group("ALL", [counted(2)])], [0], ("NOT_COVERED", [2], False)),
        ([(COND, 0), (COND, 1)], [group("ALL", [counted(2)])], [2], ("NOT_COVERED", [0, 1], False)),
        ([(COND, 0), (NONE, None)], [], [], ("NOT_EVALUABLE", [], False)),
        ([(COND, 0), (NONE, None)], [], [0], ("COVERED", [], False)),
        ([(VISIT, 0)], [], [], ("NOT_EVALUABLE", [], True)),
        ([(VISIT, 0)], [group("ALL", [counted(1)])], [1], ("COVERED", [], True)),
        ([(VISIT, 0)], [group("ALL", [counted(1)])], [], ("NOT_COVERED", [1], False)),
        ([(COND, 0)], [group("ANY", [counted(1), counted(2)])], [0, 2], ("COVERED", [], False)),
        ([(COND, 0)], [group("ANY", [counted(1), counted(2)])], [0], ("NOT_COVERED", [1, 2], False)),
    ],
)
def test_verdicts(spark, primary, rules, hits, expected):
    assert verdict(spark, primary, rules, hits) == expected


def test_coverage_end_to_end(spark):
    concept = spark.createDataFrame(
        [(8001, "S1", "SNOMED", None), (8002, "S2", "SNOMED", None)]
        + [(i, str(i), "X", "S") for i in (910001, 910002, 910003, 910009)],
        "concept_id long, concept_code string, vocabulary_id string, standard_concept string",
    )
    relationship = spark.createDataFrame(
        [(8001, 910001, "Maps to", None), (8002, 910002, "Maps to", None)],
        "concept_id_1 long, concept_id_2 long, relationship_id string, invalid_reason string",
    )
    closure = spark.createDataFrame(
        [(i, i) for i in (910001, 910002, 910003, 910009)] + [(910001, 910003)],
        "ancestor_concept_id long, descendant_concept_id long",
    )
    codes = documents.emitted_codes(
        modules(
            spark,
            custom={
                "A": {"type": "ConditionOnset", "codes": [code("SNOMED-CT", "S1", "one")]},
                "B": {"type": "ConditionOnset", "codes": [code("SNOMED-CT", "S2", "two")]},
            },
        )
    )
    sets = {
        "11": [item(910003)],
        "12": [item(910001, True)],
        "13": [item(910009, True)],
        "14": [item(910001, True), item(910001, True, True)],
        "15": [item(910009)],
    }
    docs = cohort_documents(spark, **{k: definition([(COND, 0)], sets={0: v}) for k, v in sets.items()})
    expected_empty = spark.createDataFrame([("15",)], "cohort_id string")
    report = coverage.coverage_report(docs, expected_empty, codes, concept, relationship, closure)
    got = {r.cohort_id: r for r in report.collect()}
    assert {k: r.status for k, r in got.items()} == {
        "11": "NOT_COVERED", "12": "COVERED", "13": "NOT_COVERED", "14": "NOT_COVERED", "15": "EXPECTED_EMPTY",
    }
    assert got["12"].provided_by == "custom module" and got["12"].example_codes == "one [custom]"
    assert got["15"].detail == "no module code reaches concept set(s) 0; expected empty"


def test_labels_of_a_popular_cohort_stay_two(spark):
    sources = spark.range(500).selectExpr(
        "id as concept_id", "if(id = 0, 'custom', concat('built-in:', id)) as module", "concat('d', id) as display"
    )
    matched = sources.selectExpr("if(concept_id >= 0, 'c', 'd') as cohort_id", "concept_id")
    assert rows(coverage.provider_labels(matched, sources)) == [
        ("c", "custom + built-in", "d0 [custom]; d1 [built-in:1]")
    ]
    plan = coverage.provider_labels(matched, sources)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_unresolved_codes_name_their_states(spark):
    concept = spark.createDataFrame([(1, "A", "SNOMED", "S")], "concept_id long, concept_code string, vocabulary_id string, standard_concept string")
    relationship = spark.createDataFrame([], "concept_id_1 long, concept_id_2 long, relationship_id string, invalid_reason string")
    codes = spark.createDataFrame([("SNOMED-CT", "A", "x"), ("SNOMED-CT", "Z", "y")], "system string, code string, state string")
    assert rows(vocab.unresolved_codes(codes, concept, relationship)) == [("SNOMED", "Z", "y")]


def test_studies_keep_their_cohorts_apart(spark):
    """Two studies with a cohort of the same id: one is covered, the other is not."""
    docs = spark.createDataFrame(
        [("a", 1, definition([("ConditionOccurrence", 0)], sets={0: [item(5)]})),
         ("b", 1, definition([("ConditionOccurrence", 0)], sets={0: [item(6)]}))],
        "study string, cohort_id int, document string",
    )
    concept = spark.createDataFrame(
        [(5, "SNOMED", "C5", "S"), (6, "SNOMED", "C6", "S")], "concept_id long, vocabulary_id string, concept_code string, standard_concept string"
    )
    relationship = spark.createDataFrame([], "concept_id_1 long, concept_id_2 long, relationship_id string, invalid_reason string")
    closure = spark.createDataFrame([(5, 5), (6, 6)], "ancestor_concept_id long, descendant_concept_id long")
    codes = spark.createDataFrame([("custom", "S", "SNOMED-CT", "C5", "five")], "module string, state string, system string, code string, display string")
    empty = spark.createDataFrame([("b", 1)], "study string, cohort_id int")
    got = coverage.coverage_report(docs, empty, codes, concept, relationship, closure)
    assert rows(got, "study", "cohort_id", "status") == [("a", 1, "COVERED"), ("b", 1, "EXPECTED_EMPTY")]
