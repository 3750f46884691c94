import pytest
from conftest import rows

from carestrata.operators import vocab

CONCEPT = (
    "concept_id long, concept_name string, domain_id string, vocabulary_id string, concept_class_id string, "
    "standard_concept string, concept_code string, invalid_reason string"
)
RELATIONSHIP = "concept_id_1 long, concept_id_2 long, relationship_id string, invalid_reason string"


def concepts(spark, *data):
    """Rows given as (id, name, vocabulary, standard, code[, domain[, invalid]])."""
    full = [
        (i, n, (rest[0] if rest else "Condition"), v, "Class", s, c, (rest[1] if len(rest) > 1 else None))
        for i, n, v, s, c, *rest in data
    ]
    return spark.createDataFrame(full, CONCEPT)


@pytest.fixture()
def small(spark):
    concept = concepts(
        spark,
        (1, "source a", "SNOMED", None, "A"),
        (2, "source b", "SNOMED", None, "B"),
        (3, "standard c", "SNOMED", "S", "C"),
        (4, "unmapped d", "SNOMED", None, "D"),
        (10, "target", "X", "S", "T"),
        (11, "other target", "X", "S", "U"),
    )
    relationship = spark.createDataFrame(
        [
            (1, 10, "Maps to", None),
            (1, 11, "maps to", None),
            (2, 10, "Maps to", "D"),
            (3, 999, "Maps to", None),
        ],
        RELATIONSHIP,
    )
    return concept, relationship


def test_standard_map_ignores_case_and_invalid_rows(small):
    got = vocab.source_to_standard_map(*small)
    assert rows(got, "source_code", "target_concept_id") == [("A", 10), ("A", 11)]


def test_custom_map_joins_both_maps(spark, small):
    custom = spark.createDataFrame(
        [("L1", 0, "LOCAL", 10, None), ("L2", 0, "LOCAL", 10, "D")],
        "source_code string, source_concept_id long, source_vocabulary_id string, target_concept_id long, invalid_reason string",
    )
    standard = vocab.source_to_standard_map(*small, custom)
    assert ("L1", 10) in rows(standard, "source_code", "target_concept_id")
    assert "L2" not in [r[0] for r in rows(standard, "source_code")]
    assert ("L1", 10) in rows(vocab.source_to_source_map(small[0], custom), "source_code", "target_concept_id")


def test_codes_map_by_exact_name_or_to_themselves(spark, small):
    codes = spark.createDataFrame(
        [("SNOMED-CT", c) for c in "ABCDE"] + [("Unknown", "A")], "system string, code string"
    )
    got = vocab.map_codes_to_concepts(codes, *small)
    # C points to a concept that is not there, so it stands for itself.
    assert rows(got) == [("SNOMED-CT", "A", 10), ("SNOMED-CT", "C", 3)]
    resolved = vocab.code_resolution(codes, *small)
    assert rows(resolved, "code", "resolves") == [("A", 1), ("B", 0), ("C", 1), ("D", 0), ("E", 0)]
    assert rows(vocab.unknown_systems(codes)) == [("Unknown",)]


def test_name_search_prefers_exact_then_short(spark):
    concept = concepts(
        spark,
        (1, "Knee pain", "V", "S", "1"),
        (2, "pain", "V", "S", "2"),
        (3, "Pain, chronic", "V", "S", "3", "Observation"),
        (4, "pain old", "V", "S", "4", "Condition", "D"),
        (5, "pain nonstandard", "V", None, "5"),
        (6, "Ache", "V", "S", "6"),
    )
    synonym = spark.createDataFrame([(6, "dull pain"), (2, "painful")], "concept_id long, concept_synonym_name string")
    found = [r.concept_id for r in vocab.search_names(concept, "PAIN").collect()]
    assert found == [2, 1, 3]
    assert rows(vocab.search_concepts(concept, synonym, "pain"), "concept_id") == [(1,), (2,), (3,)]
    # Two direct hits in the domain: synonyms join in, and are not repeated.
    found = [r.concept_id for r in vocab.search_concepts(concept, synonym, "pain", "Condition").collect()]
    assert found == [2, 1, 6]


def test_search_reports_are_bounded_and_deterministic(spark):
    concept = concepts(spark, *[(i, "same name", "V", "S", str(i)) for i in range(1, 40)])
    synonym = spark.createDataFrame([(1, "x")], "concept_id long, concept_synonym_name string")
    first = rows(vocab.search_concepts(concept, synonym, "name"), "concept_id")
    again = rows(vocab.search_concepts(concept.repartition(7), synonym, "name"), "concept_id")
    assert first == again and len(first) == 20


def test_top_descendants(spark):
    concept = concepts(spark, *[(i, f"n{i:03d}", "V", "S", str(i)) for i in range(1, 30)], (50, "gone", "V", None, "50"))
    closure = spark.createDataFrame(
        [(1, i, 1 if i > 10 else 2) for i in range(2, 30)] + [(1, 1, 0), (1, 50, 1)],
        "ancestor_concept_id long, descendant_concept_id long, min_levels_of_separation int",
    )
    ancestors = spark.createDataFrame([(1,)], "ancestor_concept_id long")
    got = rows(vocab.top_descendants(concept, closure, ancestors), "concept_id")
    assert got == [(i,) for i in range(11, 21)]


def test_closure_of_a_diamond_with_a_shortcut(spark):
    edges = spark.createDataFrame([(1, 2), (1, 3), (2, 4), (3, 4), (1, 4), (4, 5)], "parent long, child long")
    got = {(r[0], r[1]): (r[2], r[3]) for r in vocab.build_closure(edges).collect()}
    assert got[(1, 4)] == (1, 2) and got[(1, 5)] == (2, 3) and got[(5, 5)] == (0, 0)
    assert len(got) == 5 + 4 + 2 + 2 + 1


def test_closure_refuses_a_cycle(spark):
    edges = spark.createDataFrame([(1, 2), (2, 1)], "parent long, child long")
    with pytest.raises(ValueError, match="cycle"):
        vocab.build_closure(edges)


def test_concept_set_hits(spark):
    closure = spark.createDataFrame(
        [(1, 1), (1, 2), (1, 3), (2, 2), (3, 3), (2, 4), (1, 4)], "ancestor_concept_id long, descendant_concept_id long"
    )
    items = spark.createDataFrame(
        [
            ("all", 1, True, False),
            ("minus", 1, True, False),
            ("minus", 2, True, True),
            ("self", 1, False, False),
            ("self minus self", 3, False, False),
            ("self minus self", 3, False, True),
        ],
        "s string, concept_id long, descendants boolean, excluded boolean",
    )
    available = spark.createDataFrame([(1,), (3,), (4,)], "concept_id long")
    assert rows(vocab.concept_set_hits(items, closure, available, ["s"])) == [
        ("all", 1), ("all", 3), ("all", 4), ("minus", 1), ("minus", 3), ("self", 1),
    ]


@pytest.mark.parametrize("small", [True, False])
def test_sets_of_equal_items_are_searched_once(spark, monkeypatch, small):
    monkeypatch.setattr(vocab, "is_small", lambda df: small)
    closure = spark.createDataFrame([(1, d) for d in range(1, 6)], "ancestor_concept_id long, descendant_concept_id long")
    equal = [(c, 0, 1, True, False) for c in range(50)] + [(c, 0, 2, False, True) for c in range(50)]
    items = spark.createDataFrame(
        [*equal, (None, 0, 2, False, True), (None, 0, 1, True, False), (7, None, 3, False, False), (7, 1, 99, True, False)],
        "c long, s int, concept_id long, descendants boolean, excluded boolean",
    )
    available = spark.createDataFrame([(2,), (3,), (4,), (3,)], "concept_id long")
    members, hits = vocab.shared_set_hits(items, closure, available, ["c", "s"])
    assert members.count() == 53 and hits.count() == 3
    sets = {(c, 0) for c in [*range(50), None]}
    assert {tuple(r) for r in vocab.sets_with_hits(members, hits).collect()} == sets | {(7, None)}
    got = [tuple(r) for r in vocab.concept_set_hits(items, closure, available, ["c", "s"]).collect()]
    assert len(got) == 103 and set(got) == {(*k, x) for k in sets for x in (3, 4)} | {(7, None, 3)}


@pytest.mark.parametrize("block", [2, 256])
def test_a_concept_stands_beside_the_sets_of_its_block(spark, monkeypatch, block):
    monkeypatch.setattr(vocab, "BLOCK", block, raising=False)
    closure = spark.createDataFrame([(1, d) for d in range(1, 21)], "ancestor_concept_id long, descendant_concept_id long")
    items = spark.createDataFrame(
        [(c, 1, True, False) for c in [None, *range(299)]] + [(1000, 5, False, False)],
        "c long, concept_id long, descendants boolean, excluded boolean",
    )
    available = spark.createDataFrame([(i,) for i in range(1, 21)], "concept_id long")
    got = [tuple(r) for r in vocab.concept_set_hits(items, closure, available, ["c"]).collect()]
    assert len(got) == 6001 and set(got) == {(c, i) for c in [None, *range(299)] for i in range(1, 21)} | {(1000, 5)}
    runs = sum(a[1] != b[1] for a, b in zip(got, got[1:]))
    assert runs <= 6001 / min(block, 50) * 2


def test_release_and_states(spark):
    vocabulary = spark.createDataFrame([("None", "v5"), ("X", "x")], "vocabulary_id string, vocabulary_version string")
    assert rows(vocab.vocabulary_release(vocabulary)) == [("v5",)]
    concept = concepts(spark, (7, "Ohio", "G", "S", "1", "Geography"), (5, "ohio", "G", "S", "2", "Geography"))
    states = spark.createDataFrame([("OHIO", "OH"), ("Utah", "UT")], "state string, state_abbreviation string")
    assert rows(vocab.states_map(states, concept)) == [("OHIO", "OH", 5), ("Utah", "UT", 0)]


def test_closure_has_no_depth_limit(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(70)], "parent long, child long")
    got = vocab.build_closure(edges)
    assert got.count() == 71 * 72 // 2
    assert got.agg({"max_levels_of_separation": "max"}).first()[0] == 70
