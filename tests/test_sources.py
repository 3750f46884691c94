import re

import pytest
from pathlib import Path

from conftest import day, rows

from carestrata.runtime import broadcast_when_small, materialise
from carestrata.schema import ALL_TABLES, POPULATED, UNPOPULATED, table_schema
from carestrata.sources import datasets, delimited, manifest
from carestrata.schema import ALL_TABLES, table_schema
from carestrata.streaming.staging import stage_new_files


def put(folder: Path, name: str, text: str) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_staging_scan(spark, tmp_path):
    put(tmp_path, "Patients.csv", 'ID,Name,Start\n1,"a ""b"", c",2020-01-01\n2,NULL,\n3,"",NULLS\n')
    got = delimited.read_staging(spark, f"{tmp_path}/Patients.csv")
    assert got.columns == ["id", "name", "start"] and set(dict(got.dtypes).values()) == {"string"}
    assert rows(got) == [("1", 'a "b", c', "2020-01-01"), ("2", None, None), ("3", None, "NULLS")]


def test_folder_discovery_takes_files_and_folders_of_parts(spark, tmp_path):
    put(tmp_path, "Patients.csv", "id\n1\n")
    put(tmp_path / "Visits.csv", "part-0.csv", "id\n1\n2\n")
    put(tmp_path / "Visits.csv", "part-1.csv", "id\n3\n")
    put(tmp_path, "notes.txt", "x")
    found = delimited.read_staging_folder(spark, str(tmp_path))
    assert {n: df.count() for n, df in found.items()} == {"patients": 1, "visits": 3}


def test_vocabulary_scan(spark, tmp_path):
    put(
        tmp_path,
        "CONCEPT.csv",
        "CONCEPT_ID\tCONCEPT_NAME\tSTANDARD_CONCEPT\tVALID_START_DATE\tINVALID_REASON\n"
        '1\tsay "hi\tS\t19700101\t\n2\t\t\t2099123\tD\n3\tNA\tNA\t20991231\tNA\n',
    )
    got = delimited.read_vocabulary(spark, f"{tmp_path}/CONCEPT.csv", "concept")
    assert rows(got) == [
        (1, 'say "hi', "S", day("1970-01-01"), None),
        (2, "", None, None, "D"),
        (3, "", None, day("2099-12-31"), None),
    ]
    kept = delimited.read_vocabulary(spark, f"{tmp_path}/CONCEPT.csv", "concept", nulls=("",))
    assert rows(kept, "concept_name")[1:] == [("NA",), ('say "hi',)]


def test_schemas_cover_all_tables(spark):
    assert len(POPULATED) == 19 and len(UNPOPULATED) == 8 and len(ALL_TABLES) == 37
    person = dict((f.name, f.dataType.simpleString()) for f in table_schema("person"))
    assert person["person_id"] == "bigint" and person["year_of_birth"] == "int" and person["birth_datetime"] == "timestamp"
    assert dict((f.name, f.dataType.simpleString()) for f in table_schema("concept"))["domain_id"] == "string"


def test_only_missing_tables_are_created(spark, tmp_path):
    root = str(tmp_path)
    datasets.write_table(spark.range(5).withColumnRenamed("id", "person_id"), root, "person")
    made = datasets.ensure_tables(spark, root)
    assert len(made) == 26 and "person" not in made
    assert datasets.open_table(spark, root, "person").count() == 5
    assert datasets.open_table(spark, root, "note").count() == 0
    assert datasets.ensure_tables(spark, root) == []
    assert datasets.clear_tables(spark, root, ["person", "absent"]) == ["person"]
    assert datasets.open_table(spark, root, "person").columns == ["person_id"]
    assert not datasets.has_rows(datasets.open_table(spark, root, "person"))


def test_load_missing_and_copy(spark, tmp_path):
    a, b = f"{tmp_path}/a", f"{tmp_path}/b"
    concept = spark.range(3).withColumnRenamed("id", "concept_id")
    for name in ("concept", "concept_ancestor", "concept_relationship"):
        datasets.write_table(concept, a, name)
        datasets.write_table(concept.limit(0), b, name)
    assert datasets.vocabulary_is_loaded(spark, a) and not datasets.vocabulary_is_loaded(spark, b)
    assert datasets.load_missing(spark, b, {"domain": lambda: concept}) == ["domain"]
    assert datasets.load_missing(spark, b, {"domain": lambda: concept}) == []
    assert datasets.copy_vocabulary(spark, b, a) == ["concept", "concept_ancestor", "concept_relationship"]
    assert datasets.copy_vocabulary(spark, b, a) == []
    assert datasets.share_tables(spark, a, ["concept", "absent"], "v_") == ["v_concept"]
    assert spark.table("v_concept").count() == 3


def test_probe(spark):
    report = datasets.probe_tables(
        spark, {"a": spark.range(1), "b": spark.range(0)}, {"a": ("id", "x"), "b": ("id",), "c": ("id",)}
    )
    assert rows(report) == [("a", True, True, "x"), ("b", True, False, ""), ("c", False, False, "id")]


def test_pick_dataset():
    names = ["d", "d_2", "d_10", "d_x"]
    pick = lambda *full: datasets.pick_dataset(names, "main", lambda n: n in full)
    assert pick("main", "d_10") == "main"
    assert pick("d_2", "d_10") == "d_10"
    assert pick("d", "d_2") == "d_2"
    assert pick() == "main"


def test_pick_layout(spark, tmp_path):
    new = f"{tmp_path}/new"
    layouts = [(f"{tmp_path}/old", "patients_stage"), (new, "patients")]
    assert datasets.pick_layout(spark, layouts) is None
    datasets.write_table(spark.range(1), new, "patients")
    assert datasets.pick_layout(spark, layouts) == new


@pytest.mark.parametrize(
    "recorded, builder, live, present, force, stale",
    [
        ("v1", 2, "v1", True, False, False),
        ("v1", 2, "v1", True, True, True),
        ("v1", 2, "v1", False, False, True),
        ("v1", 2, "v2", True, False, True),
        ("v1", 2, None, True, False, True),
        (None, None, "v1", True, False, True),
        ("v1", None, "v1", True, False, True),
        ("v1", 1, "v1", True, False, True),
    ],
)
def test_staleness(recorded, builder, live, present, force, stale):
    assert datasets.is_stale(recorded, builder, live, 2, present, force) is stale


def test_newer_builders_are_refused():
    with pytest.raises(ValueError, match="builder 3"):
        datasets.is_stale("v1", 3, "v1", 2, True, True)


def test_rebuild_if_stale(spark, tmp_path):
    builders = {"m": lambda: spark.range(4)}
    build = lambda **kw: datasets.rebuild_if_stale(spark, str(tmp_path), "v1", 1, builders, **kw)
    assert [build(), build(), build(force=True)] == [True, False, True]
    info = datasets.open_table(spark, str(tmp_path), datasets.BUILD_INFO)
    assert rows(info, "vocab_version", "builder_version", "m_rows") == [("v1", 1, 4)]


def test_resumable_load(spark, tmp_path):
    folder, root = tmp_path / "in", f"{tmp_path}/out"
    put(folder, "a.csv", "id\n1\n2\n")
    put(folder, "b.csv", "id\n1\n")
    load = lambda: manifest.load_folder(spark, str(folder), root)
    assert load() == ["a", "b"]
    assert load() == []
    put(folder, "a.csv", "id\n1\n2\n3\n")  # changed file
    assert load() == ["a"]
    assert datasets.open_table(spark, root, "a").count() == 3
    datasets.write_table(spark.range(7), root, "b")  # table edited by hand
    assert load() == ["b"]
    assert rows(datasets.open_table(spark, root, "b")) == [("1",)]


def test_streamed_staging_takes_each_file_once(spark, tmp_path):
    folder, target, checkpoint = tmp_path / "in", f"{tmp_path}/t", f"{tmp_path}/c"
    put(folder, "1.csv", "id,name\n1,NULL\n")
    stage_new_files(spark, str(folder), ["id", "name"], target, checkpoint)
    put(folder, "2.csv", "id,name\n2,x\n")
    stage_new_files(spark, str(folder), ["id", "name"], target, checkpoint)
    stage_new_files(spark, str(folder), ["id", "name"], target, checkpoint)
    assert rows(spark.read.parquet(target), "id", "name") == [("1", None), ("2", "x")]


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "personRows int, label string")
    datasets.write_report(df, f"{tmp_path}/r")
    assert len(list((tmp_path / "r").glob("*.csv"))) == 1
    datasets.write_summary(df, f"{tmp_path}/s")
    assert spark.read.json(f"{tmp_path}/s").columns == ["label", "person_rows"]


def test_materialise_and_checked_broadcast(spark):
    df = materialise(spark.range(10), "test")
    assert df.count() == 10
    big = spark.range(100)
    small_plan = big.join(broadcast_when_small(df, 10), "id")._jdf.queryExecution().analyzed().toString()
    large_plan = big.join(broadcast_when_small(df, 9), "id")._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" in small_plan and "strategy=broadcast" not in large_plan


def test_only_the_folder_itself_is_read_and_equal_names_are_refused(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.csv").write_text("id\n1\n")
    (tmp_path / "sub" / "A.csv").write_text("id\n2\n")
    assert rows(delimited.read_staging_folder(spark, str(tmp_path))["a"]) == [("1",)]
    (tmp_path / "A.csv").write_text("id\n3\n")
    with pytest.raises(ValueError, match="several extracts"):
        delimited.read_staging_folder(spark, str(tmp_path))


def test_another_header_or_a_ragged_row_is_an_error(spark, tmp_path):
    for folder, second in (("swapped", "T,ID\nx,1\n"), ("ragged", "ID,T\n1,x,more\n")):
        parts = tmp_path / folder / "p.csv"
        parts.mkdir(parents=True)
        (parts / "1.csv").write_text("ID,T\n1,x\n")
        (parts / "2.csv").write_text(second)
        with pytest.raises(Exception, match="header|FAILED_READ_FILE|MALFORMED"):
            delimited.read_staging(spark, str(parts)).collect()
    (tmp_path / "m.csv").write_text('id,t\n1,"x\ny"\n')
    assert rows(delimited.read_staging(spark, f"{tmp_path}/m.csv", multi_line=True)) == [("1", "x\ny")]


def test_chosen_tables_stay_empty(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text("id\n1\n")
    got = delimited.read_staging_folder(spark, str(tmp_path), unloaded=("b",))
    assert got["a"].count() == 1 and got["b"].count() == 0 and got["b"].columns == ["id"]


def test_vocabulary_files_have_typed_ids(spark, tmp_path):
    (tmp_path / "CONCEPT_RELATIONSHIP.csv").write_text("concept_id_1\tconcept_id_2\trelationship_id\n4\t10\tMaps to\n")
    got = delimited.read_vocabulary(spark, f"{tmp_path}/CONCEPT_RELATIONSHIP.csv", "concept_relationship")
    assert dict(got.dtypes)["concept_id_1"] == dict(got.dtypes)["concept_id_2"] == "bigint"
    named = [(t, f.name, f.dataType.typeName()) for t in ALL_TABLES for f in table_schema(t).fields]
    texts = ("domain_id", "vocabulary_id", "class_id", "relationship_id", "device_id", "production_id", "source_id")
    assert all(kind == "long" for _, name, kind in named if re.search("_id(_[12])?$", name) and not name.endswith(texts))
