"""Times the headline queries over one folder of tables and prints one JSON line.

The stored inputs (vocabulary, maps, persons, visits) are built first; each is timed
under its own name (``stored_...``). ``built_dataset``, the whole way from extract
files to a dataset, runs once, cold. Every other query runs twice to a sink that
discards its rows; the second, warm time counts. The value is the sum of all times.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from carestrata.plans.bindings import Bound
from carestrata.plans.queries import all_queries

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINES = (
    "event_eras_gap_1",
    "drug_era",
    "condition_era",
    "all_visits",
    "resolved_visits",
    "discharge_enrichment",
    "source_to_standard_map",
    "observation",
    "condition_occurrence",
    "drug_exposure",
    "person",
    "death",
    "payer_plan_period",
    "claim_costs",
    "cost",
    "concept_search",
    "hierarchy_closure",
    "emitted_codes",
    "coverage_report",
    "cohort_instantiation",
    "cohort_qc",
    "dataset_summary",
    "quality_checks",
    "graph_problems",
    "staging_scan",
)

STORED = (
    "concept",
    "relationship",
    "closure",
    "synonym",
    "vocabulary",
    "custom_map",
    "standard_map",
    "source_map",
    "locations",
    "providers",
    "persons",
    "event_visits",
    "event_final_ids",
    "order_visits",
    "order_final_ids",
    "plan_periods",
    "all_billed_events",
    "drug_era_rows",
    "condition_era_rows",
    "cohort",
    "module_codes",
)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    times: dict[str, float] = {}

    bound = Bound(spark, FOLDER)
    for name in STORED:
        started = time.perf_counter()
        getattr(bound, name)
        times[f"stored_{name}"] = round(time.perf_counter() - started, 3)

    for name in ("built_dataset", *HEADLINES):
        for _ in range(1 if name == "built_dataset" else 2):
            started = time.perf_counter()
            queries[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - started, 3)

    print(
        json.dumps(
            {
                "metric": "total_time_with_stored_inputs",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
