from carestrata.operators import search, vocab

CONCEPT = """concept_id long, concept_name string, domain_id string, vocabulary_id string, concept_class_id string,
    standard_concept string, concept_code string, invalid_reason string"""


def tables(spark):
    names = ["Acute bronchitis", "bronchitis", "Chronic bronchitis", "Aspirin", "aspirin 81 MG", "ab", "x", None, "Naïve – ÉTUDE", "aaaa"]
    names += [f"tablet {i} mg of thing" for i in range(40)]
    rows = [(i, n, "Drug" if i % 3 else "Condition", "V", "C", "S" if i % 7 else None, str(i), None if i % 5 else "D") for i, n in enumerate(names, 1)]
    synonyms = [(i, s) for i in range(1, 51) for s in (f"syn {i}", "wheeze and cough" if i % 4 == 0 else f"other {i}", "wheeze")]
    return spark.createDataFrame(rows, CONCEPT), spark.createDataFrame(synonyms, "concept_id long, concept_synonym_name string")


def test_batch_equals_each_term(spark):
    concept, synonym = tables(spark)
    terms = ["bronchitis", "BRONCHITIS", "asp", "a", "ab", "", "zzz", "bronchzitis", "étude", "tablet", "wheeze", "syn 1", "%", "mg of", "aaaaa"]
    asked = [(i, t, d) for i, (t, d) in enumerate((t, d) for t in terms for d in (None, "Drug"))] + [(999, None, None)]
    got = {}
    for r in search.search_concepts_batch(concept, synonym, spark.createDataFrame(asked, "term_id long, term string, domain_id string")).collect():
        got.setdefault(r["term_id"], []).append((r["position"], r["concept_id"]))
    assert 999 not in got
    for i, term, domain in asked[:-1]:
        expected = [r["concept_id"] for r in vocab.search_concepts(concept, synonym, term, domain).collect()]
        assert [c for _, c in sorted(got.get(i, []))] == expected, (term, domain)


def test_no_terms_and_no_names(spark):
    concept, synonym = tables(spark)
    none = spark.createDataFrame([], "term_id long, term string, domain_id string")
    assert search.search_concepts_batch(concept, synonym, none).collect() == []
    some = spark.createDataFrame([(1, "asp", None)], "term_id long, term string, domain_id string")
    assert search.search_concepts_batch(concept.limit(0), synonym.limit(0), some).collect() == []
