"""How work is dealt out over tasks."""

from pyspark.sql import functions as F

from carestrata import runtime
from carestrata.plans import bindings
from carestrata.plans.bindings import BILLED_DOMAINS, Bound

FOLDER = "/root/testdata/sf0.001"
KEYS = (runtime._FIRST_PARTITIONS, runtime._READ_PER_TASK)


def test_shuffles_start_with_partitions_in_proportion_to_the_input(spark, monkeypatch):
    before = {k: spark.conf.get(k, None) for k in KEYS}
    monkeypatch.setattr(runtime, "_fitted", {})
    try:
        for k in KEYS:
            spark.conf.unset(k)
        base = int(spark.conf.get("spark.sql.shuffle.partitions"))
        for size, wanted in ((1000, base), (400 * runtime.INPUT_PER_PARTITION, 400), (1000, 400)):
            runtime.fit_shuffles(spark, size)
            assert spark.conf.get(runtime._FIRST_PARTITIONS) == str(wanted)
        assert spark.conf.get(runtime._READ_PER_TASK) == str(runtime.READ_PER_TASK)
        # What the session itself sets stays.
        monkeypatch.setattr(runtime, "_fitted", {})
        spark.conf.set(runtime._FIRST_PARTITIONS, "17")
        runtime.fit_shuffles(spark, 400 * runtime.INPUT_PER_PARTITION)
        assert spark.conf.get(runtime._FIRST_PARTITIONS) == "17"
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_each_session_of_an_application_gets_its_partitions(spark, monkeypatch):
    monkeypatch.setattr(runtime, "_fitted", {})
    first, second = spark.newSession(), spark.newSession()
    for session in (first, second):
        session.conf.unset(KEYS[0])
        runtime.fit_shuffles(session, 400 * runtime.INPUT_PER_PARTITION)
        assert session.conf.get(KEYS[0]) == "400"


def test_documents_are_spread_before_they_are_written(spark):
    plan = Bound(spark, FOLDER).module_documents._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [p_partkey" in plan


def test_patients_are_spread_before_their_dates_are_parsed(spark):
    plan = Bound(spark, FOLDER).placed_patients._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [id" in plan


def test_billed_domains_are_mapped_together_and_numbered_apart(spark, monkeypatch):
    calls, mapped = [], Bound.mapped
    monkeypatch.setattr(bindings, "_stored", {})
    monkeypatch.setattr(Bound, "mapped", lambda self, domains, v: calls.append(domains) or mapped(self, domains, v))
    b = Bound(spark, FOLDER)
    rows = b.all_billed_events.collect()
    assert calls == [list(BILLED_DOMAINS)]
    for domain in BILLED_DOMAINS:
        own = [(r["person_id"], r["encounter"], r["code"], r["date"]) for r in rows if r["domain"] == domain]
        ids = [r["event_id"] for r in rows if r["domain"] == domain]
        alone = mapped(b, [domain], bindings.VOCABULARIES).select("person_id", "encounter", "code", F.col("date")).distinct()
        assert [x for _, x in sorted(zip(ids, own, strict=True))] == sorted(tuple(r) for r in alone.collect())
        assert sorted(ids) == list(range(1, len(own) + 1))
