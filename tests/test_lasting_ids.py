import random
from datetime import date, timedelta

import pytest
from conftest import rows
from test_pipeline import FILES, vocabulary

from carestrata.operators import ids, visits, vocab
from carestrata.plans import pipeline
from carestrata.runtime import remove_path
from carestrata.sources import datasets, delimited

SCHEMA = "a string, b long, c string"


def test_ids_last_and_new_keys_follow(spark, tmp_path):
    registry = f"{tmp_path}/registry"
    first = spark.createDataFrame([("x", 2, "p"), ("x", None, "q"), (None, 1, "r"), ("x", 2, "s")], SCHEMA)
    got = rows(ids.with_lasting_id(first, "id", ["a", "b"], registry), "c", "id")
    assert got == [("p", 3), ("q", 2), ("r", 1), ("s", 3)]
    more = spark.createDataFrame([("a", 0, "n"), ("x", 2, "p"), (None, None, "m"), (None, 1, "r")], SCHEMA)
    assert rows(ids.with_lasting_id(more, "id", ["a", "b"], registry), "c", "id") == [("m", 4), ("n", 5), ("p", 3), ("r", 1)]
    # A key that is gone keeps its id to itself; nothing new sorts nothing.
    assert rows(ids.with_lasting_id(first, "id", ["a", "b"], registry), "c", "id") == got
    assert ids.registered_ids(spark, registry).count() == 5


def test_an_aborted_generation_does_not_count(spark, tmp_path):
    registry = f"{tmp_path}/registry"
    df = spark.createDataFrame([("x", 1, "p")], SCHEMA)
    ids.with_lasting_id(df, "id", ["a"], registry)
    ids.with_lasting_id(df.selectExpr("'y' as a", "b", "c"), "id", ["a"], registry)
    remove_path(spark, f"{registry}/generation-000001/_SUCCESS")
    assert rows(ids.with_lasting_id(df.selectExpr("'z' as a", "b", "c"), "id", ["a"], registry), "a", "id") == [("z", 2)]
    assert ids.registered_ids(spark, registry).count() == 2


def test_equal_rows_get_ids_of_their_own(spark, tmp_path):
    df = spark.createDataFrame([("x", 1, "p")] * 3 + [("y", None, None)] * 2, SCHEMA)
    single = ids.with_copy_number(df)
    got = ids.with_lasting_id(single, "id", single.columns, f"{tmp_path}/r").drop("copy")
    assert sorted(r["id"] for r in got.collect()) == [1, 2, 3, 4, 5]
    assert rows(got.drop("id")) == rows(df)


def test_no_id_of_a_built_dataset_moves(spark, tmp_path):
    """A second build with more encounters and events keeps every id of the first."""
    folder = tmp_path / "extracts"
    folder.mkdir()
    for name, text in FILES.items():
        (folder / f"{name}.csv").write_text(text)
    states = spark.createDataFrame([("Ohio", "OH")], "state string, state_abbreviation string")

    def built(target):
        staging = delimited.read_staging_folder(spark, str(folder))
        pipeline.build_dataset(spark, staging, vocabulary(spark), states, target, "2024-01-01", registry=f"{tmp_path}/registry")
        read = lambda name, *columns: set(rows(datasets.open_table(spark, target, name), *columns))
        visit = ("visit_occurrence_id", "person_id", "visit_start_date", "visit_source_value")
        return read("visit_occurrence", *visit), read("condition_occurrence", "condition_occurrence_id", "person_id", "condition_start_date")

    before = built(f"{tmp_path}/one")
    with (folder / "encounters.csv").open("a") as f:
        f.write("e0,2000-01-01T00:00:00Z,2000-01-02T00:00:00Z,a,d1,inpatient,1,\n")
    with (folder / "conditions.csv").open("a") as f:
        f.write("2000-01-01,,a,e0,C1\n")
    after = built(f"{tmp_path}/two")
    for old, new in zip(before, after, strict=True):
        assert old < new and len(new) == len(old) + 1
        assert len({r[0] for r in new}) == len(new)


def test_tree_of_days_equals_brute_force(spark):
    """Open-ended, one-day and reversed intervals, hot patients, dates at both ends of the calendar."""
    draw = random.Random(3)
    some_day = lambda: date(2019, 12, 1) + timedelta(days=draw.randint(0, 400))
    patient = lambda: "hot" if draw.random() < 0.4 else f"p{draw.randint(0, 9)}"
    stays = []
    for i in range(300):
        start = draw.choice([some_day(), some_day(), some_day(), date(1, 1, 1), None])
        end = draw.choice([some_day(), start, date(9999, 12, 31), None])
        stays.append((i, i, patient(), "inpatient", start, end))
    met = [(i, patient(), "emergency", d, draw.choice([d, d + timedelta(days=draw.randint(0, 9))])) for i, d in enumerate(some_day() for _ in range(300))]
    met.append((300, "hot", "emergency", date(9999, 12, 31), date(9999, 12, 31)))
    visit = spark.createDataFrame(stays, "visit_occurrence_id long, encounter_id long, patient string, encounterclass string, visit_start_date date, visit_end_date date")
    encounter = spark.createDataFrame(met, "encounter_id long, patient string, encounterclass string, start_date date, stop_date date")
    got = visits.assign_all_visit_ids(encounter, visit)
    expected = []
    for e, p, _, start, stop in met:
        around = [v for v, _, q, _, s, t in stays if q == p and s and t and s <= start and stop <= t]
        expected += [(e, v) for v in around] or [(e, None)]
    assert sorted(rows(got, "encounter_id", "visit_occurrence_id_new"), key=str) == sorted(expected, key=str)
    assert "sequence(" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert rows(visits.assign_all_visit_ids(encounter.limit(2), visit.limit(0)), "visit_occurrence_id_new") == [(None,), (None,)]


def test_a_deep_chain_takes_rounds_in_its_logarithm(spark, monkeypatch):
    tables = []
    real = vocab.materialise
    monkeypatch.setattr(vocab, "materialise", lambda df, label, by=None: (tables.append(label), real(df, label, by))[1])
    depth = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(depth)] + [(0, 5), (7, 9)], "parent long, child long")
    got = {(r[0], r[1]): (r[2], r[3]) for r in vocab.build_closure(edges).collect()}
    assert len(got) == (depth + 1) * (depth + 2) // 2
    assert got[(0, depth)] == (depth - 5, depth) and got[(6, 8)] == (2, 2) and got[(3, 3)] == (0, 0)
    assert tables.count("closure-paths") == 9


def test_random_hierarchies_equal_brute_force(spark):
    draw = random.Random(8)
    edges = sorted({tuple(sorted(draw.sample(range(25), 2))) for _ in range(60)})
    lengths = {(n, n): {0} for e in edges for n in e}
    children = {}
    for a, b in edges:
        children.setdefault(a, []).append(b)
    for a in sorted({n for e in edges for n in e}, reverse=True):
        for b in children.get(a, []):
            for (x, d), found in list(lengths.items()):
                if x == b:
                    lengths.setdefault((a, d), set()).update(n + 1 for n in found)
    df = spark.createDataFrame(edges, "parent long, child long")
    assert {(r[0], r[1]): (r[2], r[3]) for r in vocab.build_closure(df).collect()} == {k: (min(v), max(v)) for k, v in lengths.items()}
    with pytest.raises(ValueError, match="cycle"):
        vocab.build_closure(df.union(spark.createDataFrame([(edges[0][1], edges[0][0])], "parent long, child long")))
