from conftest import day, rows

from carestrata.plans import pipeline
from carestrata.schema import POPULATED, UNPOPULATED, table_schema
from carestrata.sources import datasets, delimited, quarantine

FILES = {
    "patients": "Id,BIRTHDATE,DEATHDATE,GENDER,STATE,COUNTY\na,-12592,11654,M,Ohio,X\nb,1980-05-01,,F,Ohio,X\nc,1990-01-01,NULL,F,Nowhere,\n",
    "encounters": (
        "Id,START,STOP,PATIENT,PROVIDER,ENCOUNTERCLASS,CODE,DISCHARGE\n"
        "e1,2001-01-01T00:00:00Z,2001-01-03T00:00:00Z,a,d1,inpatient,1,\n"
        "e2,2001-01-02T00:00:00Z,2001-01-02T01:00:00Z,a,d1,emergency,1,1\n"
        "e3,2001-02-01T00:00:00Z,2001-02-01T01:00:00Z,b,d9,urgentcare,308646001,\n"
    ),
    "conditions": "START,STOP,PATIENT,ENCOUNTER,CODE\n2001-01-01,2001-01-05,a,e1,C1\n2001-02-03,,a,e1,C1\n2001-02-01,,b,e3,ZZ\n",
    "medications": "START,STOP,PATIENT,ENCOUNTER,CODE\n2001-01-01,2001-01-11,a,e1,M1\n2001-02-01,2001-02-03,a,e1,M1\n",
    "observations": "DATE,PATIENT,ENCOUNTER,CODE,VALUE,UNITS\n2001-01-01,a,e1,O1,7.5,mm\n2001-01-01,a,,O1,high,\n",
    "organizations": "Id,NAME\no1,Clinic\n",
    "providers": "Id,NAME\nd1,Doctor\n",
    "payers": "Id,NAME\np1,Payer\n",
    "payer_transitions": "PATIENT,PAYER,START_DATE,END_DATE\na,p1,2000-01-01,2002-01-01\n",
    "claims": "Id,PATIENTID,APPOINTMENTID,SERVICEDATE\nk1,a,e1,2001-01-01\n",
    "claims_transactions": "CLAIMID,TYPE,AMOUNT\nk1,CHARGE,10.5\nk1,CHARGE,2\nk1,PAYMENT,x\n",
}


def vocabulary(spark):
    concept = [
        (1, "c", "Condition", "SNOMED", "Finding", "S", "C1"),
        (2, "o", "Observation", "LOINC", "Lab", "S", "O1"),
        (3, "m", "Drug", "RxNorm", "Drug", "S", "M1"),
        (4, "i", "Drug", "RxNorm", "Ingredient", "S", "I1"),
        (5, "home", "Visit", "UB04 Pt dis status", "Visit", None, "01"),
        (6, "Home", "Visit", "CMS", "Visit", "S", "h"),
    ]
    maps = [(1, 1), (2, 2), (3, 3), (4, 4), (5, 6)]
    return {
        "concept": spark.createDataFrame(
            [(*r, None) for r in concept],
            "concept_id long, concept_name string, domain_id string, vocabulary_id string, concept_class_id string, "
            "standard_concept string, concept_code string, invalid_reason string",
        ),
        "concept_relationship": spark.createDataFrame(
            [(a, b, "Maps to", None) for a, b in maps],
            "concept_id_1 long, concept_id_2 long, relationship_id string, invalid_reason string",
        ),
        "concept_ancestor": spark.createDataFrame(
            [(4, 3), (4, 4)], "ancestor_concept_id long, descendant_concept_id long"
        ),
        "vocabulary": spark.createDataFrame([("None", "v5")], "vocabulary_id string, vocabulary_version string"),
    }


def test_folder_to_dataset_to_checks(spark, tmp_path):
    folder = tmp_path / "extracts"
    folder.mkdir()
    for name, text in FILES.items():
        (folder / f"{name}.csv").write_text(text)
    target = f"{tmp_path}/dataset"
    staging = delimited.read_staging_folder(spark, str(folder))
    states = spark.createDataFrame([("Ohio", "OH")], "state string, state_abbreviation string")
    pipeline.build_dataset(spark, staging, vocabulary(spark), states, target, "2024-01-01")

    table = lambda name: datasets.open_table(spark, target, name)
    for name in (*POPULATED, *UNPOPULATED):
        assert table(name).columns == [f.name for f in table_schema(name)], name
    assert rows(table("person"), "person_id", "gender_concept_id", "year_of_birth", "location_id") == [
        (1, 8507, 1935, 2), (2, 8532, 1980, 2), (3, 8532, 1990, 1),
    ]
    assert rows(table("visit_occurrence"), "visit_occurrence_id", "visit_concept_id", "discharged_to_concept_id") == [
        (2, 9201, 6), (3, 8782, 0),
    ]
    assert rows(table("condition_era"), "person_id", "condition_era_start_date", "condition_era_end_date") == [
        (1, day("2001-01-01"), day("2001-02-04")),
    ]
    assert rows(table("drug_era"), "drug_concept_id", "drug_exposure_count", "gap_days") == [(4, 2, 21)]
    assert rows(table("observation"), "value_as_number", "visit_occurrence_id", "provider_id") == [(7.5, 2, 1), (None, None, None)]
    assert rows(table("death"), "person_id", "death_date") == [(1, day("2001-11-28")), (2, day("2001-02-01"))]
    # One charge per billed event of the encounter: two conditions, two drugs.
    assert rows(table("cost"), "total_charge", "total_paid", "payer_plan_period_id") == [(12.5, None, 1)] * 4

    reports = pipeline.check_dataset(spark, staging, target, 2024, min_mapped_pct=50.0)
    assert rows(reports["summary"], "person_rows", "condition_rows", "mapped_condition_pct") == [(3, 2, 100.0)]
    assert reports["failures"].count() == 0
    assert dict(rows(reports["staged_counts"]))["conditions"] == 3
    assert dict(rows(reports["discharge"], "check_name", "status"))["home_discharge_present"] == "PASS"
    assert dict(rows(reports["refused_amounts"])) == {"CHARGE": 0, "PAYMENT": 1}
    failing = pipeline.check_dataset(spark, staging, target, 2024, min_person_rows=4)["failures"]
    assert rows(failing, "message") == [("person_rows is below its threshold",)]

    with (folder / "conditions.csv").open("a") as file:
        file.write("one,two\n")
    extracts = quarantine.staging_extracts(spark, str(folder))
    checked = pipeline.check_dataset(spark, {n: e.rows for n, e in extracts.items()}, target, 2024, extracts=extracts)
    assert rows(checked["rejected_rows"], "table_name", "line") == [("conditions", "one,two")]
    assert rows(checked["failures"]) == [("staging", "accepted_pct of conditions is below its threshold")]
    assert dict(rows(checked["staged_counts"]))["conditions"] == 3
