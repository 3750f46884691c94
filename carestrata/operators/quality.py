"""Row counts, dataset summary, profiles and pass/fail gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carestrata.functions.parsing import as_column

# Least persons and least mapped percentage of a dataset.
MIN_PERSON_ROWS, MIN_MAPPED_PCT = 1, 0.0

# Discharge thresholds and the code of a discharge to home.
MIN_DISCHARGE_VISITS, MIN_MAPPED_DISCHARGE_PCT, MIN_NON_HOME_VISITS = 1, 90.0, 1
HOME_CODE = "01"

# Least suggested width of a text column, length of the warning list.
MIN_TEXT_WIDTH, TOP_WARNINGS = 64, 50

# Fixed value: a person born this many years ago or later counts as a minor.
ADULT_AGE = 18


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, one row each, empty tables included.

    All tables are one union that is counted by name in one shuffle; the scans
    read no column, and every scan task sends one row per table. A row of weight
    zero per name keeps the empty tables in.
    """
    spark = next(iter(tables.values())).sparkSession
    names = spark.range(1).select(
        F.explode(F.array(*[F.lit(n) for n in tables])).alias("table_name"), F.lit(0).cast("long").alias("_n")
    )
    counted = [df.select(F.lit(n).alias("table_name"), F.lit(1).cast("long").alias("_n")) for n, df in tables.items()]
    return _union([names, *counted]).groupBy("table_name").agg(F.sum("_n").alias("row_count"))


def of_run(df: DataFrame, run_name: str | None) -> DataFrame:
    """Rows of one run, where the table keeps a ``run_name`` at all."""
    if run_name is not None and "run_name" in df.columns:
        return df.filter(F.col("run_name") == run_name)
    return df


def with_source_prefix(person: DataFrame, prefix: str, source: str = "person_source_value") -> DataFrame:
    """Persons whose source value has ``prefix``, or all persons if none has."""
    prefixed = person.filter(F.col(source).startswith(prefix))
    return person if prefixed.isEmpty() else prefixed


def percentage(part: Column | str, whole: Column | str) -> Column:
    """100 * part / whole, null for an empty whole."""
    return F.lit(100.0) * as_column(part) / F.nullif(as_column(whole), F.lit(0))


def dataset_summary(
    staged: dict[str, DataFrame],
    person: DataFrame,
    visits: DataFrame,
    procedures: DataFrame,
    conditions: DataFrame,
    condition_eras: DataFrame,
    drug_eras: DataFrame,
) -> DataFrame:
    """One row of counts over the staged and the built tables.

    All but the visits are counted for the given persons only, after counting per
    person, so what meets the persons is one row each. Every table yields a few
    ``(metric, value)`` rows; they are folded into columns at the end, so no
    table is ever crossed with another.
    """
    ids = person.select("person_id").distinct()

    def one(df: DataFrame, metric: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(metric).alias("metric"), "value")

    def of_persons(df: DataFrame, **counts: Column) -> DataFrame:
        per_person = df.groupBy("person_id").agg(*[F.count(c).alias(name) for name, c in counts.items()])
        totals = per_person.join(ids, "person_id", "left_semi").agg(
            *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counts]
        )
        return totals.unpivot([], list(counts), "metric", "value")

    rows = F.lit(1)
    staged_counts = row_counts(staged).agg(
        F.sum("row_count").alias("staged_rows"),
        F.sum(F.when(F.col("row_count") > 0, 1).otherwise(0)).alias("staged_tables_with_rows"),
    )
    metrics = [
        staged_counts.unpivot([], ["staged_rows", "staged_tables_with_rows"], "metric", "value"),
        of_persons(
            conditions,
            condition_rows=rows,
            mapped_condition_rows=F.when(F.col("condition_concept_id") > 0, 1),
        ),
        one(person, "person_rows"),
        one(visits, "visit_rows"),
        of_persons(procedures, procedure_rows=rows),
        of_persons(condition_eras, condition_era_rows=rows),
        of_persons(drug_eras, drug_era_rows=rows),
    ]
    names = [
        "staged_rows",
        "staged_tables_with_rows",
        "person_rows",
        "visit_rows",
        "procedure_rows",
        "condition_rows",
        "mapped_condition_rows",
        "condition_era_rows",
        "drug_era_rows",
    ]
    return _union(metrics).agg(
        *[F.max(F.when(F.col("metric") == n, F.col("value"))).cast("long").alias(n) for n in names]
    )


def mapped_percentage(summary: DataFrame) -> DataFrame:
    """The summary with the share of conditions that have a concept."""
    return summary.withColumn(
        "mapped_condition_pct", percentage("mapped_condition_rows", "condition_rows")
    )


def threshold_gate(
    summary: DataFrame, min_person_rows: int = MIN_PERSON_ROWS, min_mapped_pct: float = MIN_MAPPED_PCT
) -> DataFrame:
    """One row per threshold with its status; a null value fails."""
    pct = mapped_percentage(summary)
    checks = pct.select(
        F.expr(
            f"""stack(2,
                'person_rows', cast(person_rows as double), cast({min_person_rows} as double),
                'mapped_condition_pct', mapped_condition_pct, cast({min_mapped_pct} as double))
            as (metric, value, threshold)"""
        )
    )
    return checks.withColumn(
        "status", F.when(F.col("value") >= F.col("threshold"), "PASS").otherwise("FAIL")
    )


def age_profile(person: DataFrame, as_of_year: int) -> DataFrame:
    """Persons, minors, and the span of birth years."""
    return person.agg(
        F.count(F.lit(1)).alias("n_people"),
        F.count(F.when(F.col("year_of_birth") >= as_of_year - ADULT_AGE, 1)).alias("age_under_18_count"),
        F.min("year_of_birth").alias("min_year_of_birth"),
        F.max("year_of_birth").alias("max_year_of_birth"),
    )


# -- discharge ---------------------------------------------------------------


def discharge_summary(visits: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Visits with a discharge code, mapped ones, home and other, in one pass."""
    source, concept = F.col("discharged_to_source_value"), F.col("discharged_to_concept_id")
    coded = source.isNotNull()
    home = F.trim(source) == HOME_CODE
    return visits.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("visits_total"),
        F.count(F.when(coded, 1)).alias("visits_with_source"),
        F.count(F.when(coded & (concept != 0), 1)).alias("visits_mapped"),
        F.count(F.when(home, 1)).alias("home_visits"),
        F.count(F.when(coded & ~home, 1)).alias("non_home_visits"),
    )


def discharge_verdict(
    summary: DataFrame,
    min_visits: int = MIN_DISCHARGE_VISITS,
    min_non_home: int = MIN_NON_HOME_VISITS,
    min_mapped_pct: float = MIN_MAPPED_DISCHARGE_PCT,
    keys: list[str] | None = None,
) -> DataFrame:
    """Four checks per row of :func:`discharge_summary`."""
    mapped = F.when(
        F.col("visits_with_source") > 0, F.lit(100.0) * F.col("visits_mapped") / F.col("visits_with_source")
    ).otherwise(F.lit(0.0))
    checks = summary.withColumn("_pct", mapped).select(
        *(keys or []),
        F.expr(
            f"""stack(4,
            'discharge_dispositions_present', cast(visits_with_source as double), cast({min_visits} as double),
            'discharge_codes_mapped_pct', _pct, cast({min_mapped_pct} as double),
            'home_discharge_present', cast(home_visits as double), cast(1 as double),
            'non_home_discharge_present', cast(non_home_visits as double), cast({min_non_home} as double))
            as (check_name, value, threshold)"""
        ),
    )
    shown = F.when(F.col("check_name") == "discharge_codes_mapped_pct", F.round("value", 1)).otherwise(F.col("value"))
    return checks.select(
        *(keys or []),
        "check_name",
        shown.alias("value"),
        "threshold",
        F.when(shown >= F.col("threshold"), "PASS").otherwise("FAIL").alias("status"),
    )


# -- profiles ----------------------------------------------------------------


def suggested_width(length: Column | str) -> Column:
    """Power of two above ``length``, at least 64; its bits give the exponent."""
    bits = F.length(F.bin(as_column(length)))
    return F.greatest(F.lit(MIN_TEXT_WIDTH).cast("long"), F.call_function("shiftleft", F.lit(1).cast("long"), bits))


def column_profile(df: DataFrame, table: str, declared: dict[str, int] | None = None) -> DataFrame:
    """Longest text per string column against its declared width, in one pass.

    ``declared`` gives widths; a column without one has no limit.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    longest = df.agg(*[F.coalesce(F.max(F.length(F.col(c))), F.lit(0)).alias(c) for c in text])
    widths = declared or {}
    declared_width = reduce(
        lambda expr, c: expr.when(F.col("column_name") == c, F.lit(widths[c])),
        widths,
        F.when(F.lit(False), F.lit(0)),
    )
    rows = longest.unpivot([], text, "column_name", "max_length").withColumn("declared_width", declared_width)
    too_long = F.col("declared_width").isNotNull() & (F.col("max_length") > F.col("declared_width"))
    return rows.select(
        F.lit(table).alias("table_name"),
        "column_name",
        F.col("max_length").cast("long").alias("max_length"),
        F.col("declared_width").cast("long").alias("declared_width"),
        F.when(too_long, suggested_width("max_length"))
        .otherwise(F.col("declared_width").cast("long"))
        .alias("suggested_width"),
        F.coalesce(too_long, F.lit(False)).alias("must_widen"),
    )


def field_profile(
    df: DataFrame, table: str, columns: list[str] | None = None, unique: tuple[str, ...] = ()
) -> DataFrame:
    """Rows, nulls and distinct values per column.

    Rows and nulls of all columns are one aggregate without a shuffle of values.
    Distinct values are counted per column on the typed value, each from a scan of
    that column alone and combined map-side; columns in ``unique`` are declared keys,
    whose values need no comparing: all that are not null are distinct.
    """
    names = columns or df.columns
    filled = df.agg(F.count(F.lit(1)).alias("n_rows"), *(F.count(F.col(c)).alias(f"v{i}") for i, c in enumerate(names)))
    entries = ", ".join(f"'{c}', v{i}" for i, c in enumerate(names))
    base = filled.select("n_rows", F.expr(f"stack({len(names)}, {entries}) as (column_name, n_filled)"))
    counted = [
        df.select(F.col(c).alias("value")).distinct().agg(F.count("value").alias("n")).select(F.lit(c).alias("column_name"), "n")
        for c in names
        if c not in unique
    ]
    rows = base.join(_union(counted), "column_name", "left") if counted else base.withColumn("n", F.lit(None).cast("long"))
    return rows.select(
        F.lit(table).alias("table_name"),
        "column_name",
        "n_rows",
        (F.col("n_rows") - F.col("n_filled")).alias("n_null"),
        F.coalesce("n", "n_filled").alias("n_distinct"),
    )


def concept_counts(df: DataFrame, concept: str, person: str = "person_id") -> DataFrame:
    """Rows and distinct persons per concept."""
    return (
        df.groupBy(F.col(concept).alias("concept_id"), person)
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("concept_id")
        .agg(F.sum("_n").alias("n_rows"), F.count(F.lit(1)).alias("n_persons"))
    )


def month_counts(df: DataFrame, date: str, concept: str | None = None) -> DataFrame:
    """Rows per calendar month, and per concept if one is named."""
    month = F.trunc(F.col(date).cast("date"), "month").alias("month")
    keys = [month] + ([F.col(concept).alias("concept_id")] if concept else [])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


# -- rule checks -------------------------------------------------------------

#: Violations of one rule as an aggregate, by the name of the check.
_FIELD_CHECKS = {
    "is_required": lambda c, _: F.count(F.when(c.isNull(), 1)),
    "plausible_low": lambda c, bound: F.count(F.when(c < F.lit(bound), 1)),
    "plausible_high": lambda c, bound: F.count(F.when(c > F.lit(bound), 1)),
    "concept_recorded": lambda c, _: F.count(F.when(c == 0, 1)),
}


def _verdict(rows: DataFrame) -> DataFrame:
    """Flags of a check row: failed, passed, error and not applicable.

    A check of a table without rows does not apply and counts as passed.
    """
    failed = (F.col("n_rows") > 0) & (
        F.col("n_violated") * 100.0 > F.col("n_rows") * F.col("threshold_pct")
    )
    return rows.select(
        "check_level",
        "check_name",
        "table_name",
        "field_name",
        "n_violated",
        "n_rows",
        failed.cast("int").alias("failed"),
        (~failed).cast("int").alias("passed"),
        F.lit(0).alias("is_error"),
        (F.col("n_rows") == 0).cast("int").alias("not_applicable"),
    )


def _check_rows(level: str, check: str, table: str, field: str, threshold: float, counts: DataFrame) -> DataFrame:
    return counts.select(
        F.lit(level).alias("check_level"),
        F.lit(check).alias("check_name"),
        F.lit(table).alias("table_name"),
        F.lit(field).alias("field_name"),
        F.lit(float(threshold)).alias("threshold_pct"),
        F.col("n_violated").cast("long").alias("n_violated"),
        F.col("n_rows").cast("long").alias("n_rows"),
    )


def field_checks(df: DataFrame, table: str, rules: list[tuple]) -> DataFrame:
    """Rules ``(check, field, bound, threshold_pct)`` of one table in one pass."""
    violated = [
        _FIELD_CHECKS[check](F.col(field), bound).alias(f"v{i}")
        for i, (check, field, bound, _) in enumerate(rules)
    ]
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"), *violated)
    level = lambda check: "CONCEPT" if check == "concept_recorded" else "FIELD"
    entries = ", ".join(
        f"'{level(check)}', '{check}', '{field}', {float(threshold)}D, v{i}"
        for i, (check, field, _, threshold) in enumerate(rules)
    )
    rows = counted.select(
        "n_rows",
        F.expr(f"stack({len(rules)}, {entries}) as (check_level, check_name, field_name, threshold_pct, n_violated)"),
    )
    return _verdict(rows.withColumn("table_name", F.lit(table)))


def primary_key_check(df: DataFrame, table: str, keys: list[str], threshold: float = 0.0) -> DataFrame:
    """Rows whose key is shared with another row."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("n_violated"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
    )
    return _verdict(_check_rows("TABLE", "is_primary_key", table, ",".join(keys), threshold, counts))


def foreign_key_check(
    df: DataFrame, table: str, field: str, parent: DataFrame, parent_field: str, threshold: float = 0.0
) -> DataFrame:
    """Rows whose non-null key has no parent.

    Keys are counted before they meet the parent table, so a hot key is one row.
    """
    keys = df.groupBy(F.col(field).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_field).alias("k")).distinct().withColumn("known", F.lit(True))
    counts = keys.join(known, "k", "left").agg(
        F.coalesce(
            F.sum(F.when(F.col("k").isNotNull() & F.col("known").isNull(), F.col("n"))), F.lit(0)
        ).alias("n_violated"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
    )
    return _verdict(_check_rows("FIELD", "is_foreign_key", table, field, threshold, counts))


def check_results(checks: list[DataFrame], exclude: tuple[str, ...] = ()) -> DataFrame:
    """All check rows together, without the excluded tables."""
    rows = _union(checks)
    return rows.filter(~F.col("table_name").isin(*exclude)) if exclude else rows


def check_summary(results: DataFrame) -> DataFrame:
    """How many checks failed, passed, erred or did not apply. Flags may overlap."""
    flag = lambda c: F.count(F.when(F.col(c) == 1, 1))
    return results.agg(
        flag("failed").alias("failed_checks"),
        flag("passed").alias("passed_checks"),
        flag("is_error").alias("error_checks"),
        flag("not_applicable").alias("not_applicable_checks"),
        F.count(F.lit(1)).alias("total_checks"),
    )


def top_warnings(warnings: DataFrame, order_by: list[str]) -> DataFrame:
    """First fifty warnings of the report."""
    return warnings.orderBy(*order_by).limit(TOP_WARNINGS)


def stage_failures(results: DataFrame, stage: str) -> DataFrame:
    """Failed rows of a stage as ``(stage, message)``; a run with any is not clean."""
    return results.filter("status = 'FAIL'").select(
        F.lit(stage).alias("stage"),
        F.concat(F.col("metric"), F.lit(" is below its threshold")).alias("message"),
    )
