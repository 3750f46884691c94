import pytest
from conftest import rows

from carestrata.operators.quality import stage_failures
from carestrata.sources import datasets, delimited, quarantine


def write(path, *lines):
    path.write_text("".join(f"{x}\n" for x in lines), encoding="utf-8")


def test_good_rows_of_a_bad_file_arrive(spark, tmp_path):
    write(tmp_path / "patients.csv", "ID,Name,City", '1,"a, ""b""",x', "2,b", "3,c,y,z", "4,NULL,", '5,"q,r",s,"t,u"', "", "6,d,w")
    found = quarantine.staging_extracts(spark, str(tmp_path))["patients"]
    assert rows(found.rows) == [("1", 'a, "b"', "x"), ("4", None, None), ("6", "d", "w")]
    assert rows(found.rejected, "table_name", "line", "reason") == [
        ("patients", "2,b", "2 fields for 3 columns"),
        ("patients", "3,c,y,z", "4 fields for 3 columns"),
        ("patients", '5,"q,r",s,"t,u"', "4 fields for 3 columns"),
    ]
    assert found.rejected.filter("file like '%patients.csv'").count() == 3


def test_fit_does_not_depend_on_the_columns_in_use(spark, tmp_path):
    write(tmp_path / "a.csv", "id,name", "1,x", "2", "3,y,z")
    found = quarantine.staging_extract(spark, f"{tmp_path}/a.csv", "a")
    assert rows(found.rows.select("id")) == [("1",)]
    assert found.rows.count() == 1 and found.rejected.count() == 2
    assert rows(found.counts()) == [("a", 1, 2)]


def test_vocabulary_rows_are_neither_padded_nor_cut(spark, tmp_path):
    write(
        tmp_path / "CONCEPT.csv",
        "concept_id\tconcept_name\tdomain_id\tvalid_start_date",
        '1\tA "x\tDrug\t19700101',
        "2",
        "3\tB\tC\t19700101\tmore",
        "4\tNA\tDrug\tbad",
    )
    found = quarantine.vocabulary_extracts(spark, str(tmp_path), delimited.VOCABULARY_FILES)["concept"]
    assert rows(found.rows, "concept_id", "concept_name") == [(1, 'A "x'), (4, "")]
    assert rows(found.rejected, "line") == [("2",), ("3\tB\tC\t19700101\tmore",)]
    with pytest.raises(Exception, match="(?i)malformed"):
        delimited.read_vocabulary(spark, f"{tmp_path}/CONCEPT.csv", "concept").collect()


def test_gate_and_table_of_rejected_rows(spark, tmp_path):
    write(tmp_path / "a.csv", "id,name", "1,x", "2", "3,y", "4,z")
    write(tmp_path / "b.csv", "id", "1")
    write(tmp_path / "c.csv", "id,name")
    found = quarantine.staging_extracts(spark, str(tmp_path))
    gate = quarantine.accepted_gate(found)
    assert rows(gate) == [
        ("accepted_pct of a", 75.0, 100.0, "FAIL"),
        ("accepted_pct of b", 100.0, 100.0, "PASS"),
        ("accepted_pct of c", 100.0, 100.0, "PASS"),
    ]
    assert rows(quarantine.accepted_gate(found, 75.0), "status") == [("PASS",)] * 3
    assert rows(stage_failures(gate, "staging"), "message") == [("accepted_pct of a is below its threshold",)]
    quarantine.keep_rejected(found, str(tmp_path / "out"))
    assert rows(datasets.open_table(spark, str(tmp_path / "out"), quarantine.REJECTED), "line") == [("2",)]


def test_parts_with_another_header_are_errors(spark, tmp_path):
    (tmp_path / "a.csv").mkdir()
    write(tmp_path / "a.csv" / "1.csv", "id,name", "1,x")
    write(tmp_path / "a.csv" / "2.csv", "name,id", "y,2")
    with pytest.raises(Exception, match="(?i)header"):
        quarantine.staging_extract(spark, f"{tmp_path}/a.csv", "a").rows.collect()
