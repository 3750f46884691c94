"""Interval collapse and the era tables built on it.

Ordering by start, a row opens a new island when its start lies more than the
allowed gap beyond the largest end seen so far. Only the largest end per start
date matters for that test, so rows are first combined per (keys, start date).
That step runs map-side, and it bounds what one window group can hold by the
number of calendar days, however many rows one person and concept may have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carestrata.operators.ids import with_surrogate_id
from carestrata.runtime import broadcast_bounded

# Days allowed between two parts of an era.
ERA_GAP_DAYS = 30


def collapse_intervals(
    df: DataFrame,
    keys: list[str],
    start: str,
    end: str,
    gap_days: int = 0,
    count: str | None = "n_intervals",
    smallest: tuple[str, ...] = (),
    total: tuple[str, ...] = (),
    distinct_starts: bool = False,
) -> DataFrame:
    """Merge date intervals that overlap, touch or lie within ``gap_days``.

    Returns ``keys``, ``start``, ``end``, the number of merged rows as ``count``
    (or the sum of an existing ``count`` column), the minimum of each column in
    ``smallest`` and the sum of each in ``total``. An end before its start is
    read as the start. ``distinct_starts`` says that no two rows share keys and
    start, which makes the combining step needless.
    """
    merged = {c: F.min(c).alias(c) for c in smallest} | {c: F.sum(c).alias(c) for c in total}
    if count:
        source = F.col(count) if count in df.columns else F.lit(1)
        merged[count] = F.sum(source.cast("long")).alias(count)

    if distinct_starts:
        days = df.select(
            *keys, start, end, *smallest, *total,
            *([F.col(count)] if count and count in df.columns else []),
            *([F.lit(1).alias(count)] if count and count not in df.columns else []),
        )
    else:
        days = _by_day(df, keys, start, end, merged)
    if count:
        merged[count] = F.sum(F.col(count).cast("long")).alias(count)

    if gap_days >= 0 and not (distinct_starts or smallest or total or (count and count in df.columns)):
        return _collapse_in_order(days, keys, start, end, gap_days, count)
    by_start = Window.partitionBy(*keys).orderBy(start)
    return (
        days.withColumn("_reach", F.max(end).over(by_start.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("_opens", _opens(start, gap_days))
        .withColumn("_island", F.sum("_opens").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_island")
        .agg(F.min(start).alias(start), F.max(end).alias(end), *merged.values())
        .drop("_island")
    )


def _by_day(df: DataFrame, keys: list[str], start: str, end: str, merged: dict[str, Column]) -> DataFrame:
    """Rows combined per keys and start; an end before the start is the start."""
    return df.groupBy(*keys, start).agg(F.max(F.greatest(end, start)).alias(end), *merged.values())


def _opens(start: str, gap_days: int) -> Column:
    """1 if a row's start lies more than the gap beyond ``_reach``, else 0, also for nulls."""
    return F.when(F.col(start) > F.date_add("_reach", gap_days), 1).otherwise(0)


def _collapse_in_order(days: DataFrame, keys: list[str], start: str, end: str, gap_days: int, count: str | None) -> DataFrame:
    """:func:`collapse_intervals` of rows by day that are only counted, by one sort and no hash table.

    An island is its last row: the largest end so far is its end, and its count the
    difference of running counts there and before its first row.
    """
    by_start = Window.partitionBy(*keys).orderBy(start)
    upto = by_start.rowsBetween(Window.unboundedPreceding, 0)
    marked = (
        days.withColumn("_row", F.row_number().over(by_start))
        .withColumn("_reach", F.max(end).over(by_start.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("_opens", _opens(start, gap_days))
        .withColumn("_last", F.coalesce(F.lead("_opens").over(by_start), F.lit(1)) == 1)
        .withColumn("_all", F.sum(count).over(upto) if count else F.lit(0))
    )
    opening = F.struct(F.col(start).alias("start"), (F.col("_all") - F.col(count) if count else F.lit(0)).alias("n"))
    opened = F.last(F.when((F.col("_row") == 1) | (F.col("_opens") == 1), opening), ignorenulls=True).over(upto)
    islands = (
        marked.withColumn("_open", opened)
        .withColumn("_first_start", F.min(start).over(upto))
        .filter("_last")
        .withColumn(end, F.greatest("_reach", end))
        # Rows of no start come first, so only the first island can lack one where it opens.
        .withColumn(start, F.coalesce("_open.start", "_first_start"))
    )
    counted = [(F.col("_all") - F.col("_open.n")).alias(count)] if count else []
    return islands.select(*keys, start, end, *counted)


def exposure_end(start: str, end: str, days_supply: str):
    """Given end; else start plus supply when that differs; else the next day."""
    supplied = F.date_add(F.col(start), F.col(days_supply).cast("int"))
    return F.coalesce(F.col(end), F.nullif(supplied, F.col(start)), F.date_add(F.col(start), 1))


def ingredient_map(exposures: DataFrame, concept: DataFrame, closure: DataFrame) -> DataFrame:
    """Distinct (drug, ingredient) pairs for the drugs that occur in ``exposures``.

    The closure table is cut down from both sides before anything is joined to
    the exposures: by the ingredients and by the drugs in use.
    """
    in_use = exposures.filter("drug_concept_id <> 0").select("drug_concept_id").distinct()
    ingredients = concept.filter(
        "vocabulary_id = 'RxNorm' and concept_class_id = 'Ingredient'"
    ).select(F.col("concept_id").alias("ancestor_concept_id"))
    return (
        closure.select(
            F.col("descendant_concept_id").alias("drug_concept_id"), "ancestor_concept_id"
        )
        .join(ingredients, "ancestor_concept_id", "left_semi")
        .join(in_use, "drug_concept_id", "left_semi")
        .select("drug_concept_id", F.col("ancestor_concept_id").alias("ingredient_concept_id"))
        .distinct()
    )


def ingredient_exposures(exposures: DataFrame, concept: DataFrame, closure: DataFrame) -> DataFrame:
    """Exposures with an imputed end, one row per ingredient of the drug."""
    pairs = broadcast_bounded(ingredient_map(exposures, concept, closure), "ingredients")
    return (
        exposures.filter("drug_concept_id <> 0 and coalesce(days_supply, 0) >= 0")
        .join(pairs, "drug_concept_id")
        .select(
            "person_id",
            "ingredient_concept_id",
            F.col("drug_exposure_start_date").alias("start_date"),
            exposure_end("drug_exposure_start_date", "drug_exposure_end_date", "days_supply").alias("end_date"),
        )
    )


def sub_exposures(ingredient_rows: DataFrame) -> DataFrame:
    """First pass, gap 0: one row per uninterrupted stretch, with its length."""
    return collapse_intervals(
        ingredient_rows,
        ["person_id", "ingredient_concept_id"],
        "start_date",
        "end_date",
        count="drug_exposure_count",
    ).withColumn("days_exposed", F.datediff("end_date", "start_date").cast("long"))


def drug_eras(
    exposures: DataFrame, concept: DataFrame, closure: DataFrame, gap_days: int = ERA_GAP_DAYS
) -> DataFrame:
    """Eras per person and ingredient, without id.

    An era opens where an uninterrupted stretch (:func:`sub_exposures`) opens that lies
    more than the gap beyond all before it. Both tests compare a row with the largest
    end so far, so one order by start serves both: the days of a stretch are those that
    its rows add to the largest end, and what an era sums up are differences of running
    sums at its last row and before its first. So a task holds one sort and no hash table
    beyond the combining step.
    """
    keys = ["person_id", "ingredient_concept_id"]
    rows = ingredient_exposures(exposures, concept, closure)
    count = {"_n": F.sum(F.lit(1).cast("long")).alias("_n")}
    days = _by_day(rows, keys, "start_date", "end_date", count)
    by_start = Window.partitionBy(*keys).orderBy("start_date")
    upto = by_start.rowsBetween(Window.unboundedPreceding, 0)
    before = by_start.rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("_row") == 1
    # Rows of no start come first; the stretch that goes on from them starts with its first start.
    starts = (F.col("_stretch") == 1) | F.col("_previous").isNull()
    added = F.when(starts, F.datediff(F.greatest("_reach", "end_date"), "start_date")).otherwise(
        F.greatest(F.datediff("end_date", "_reach"), F.lit(0))
    )
    marked = (
        days.withColumn("_row", F.row_number().over(by_start))
        .withColumn("_reach", F.max("end_date").over(before))
        .withColumn("_previous", F.lag("start_date").over(by_start))
        .withColumn("_stretch", _opens("start_date", 0))
        .withColumn("_opens", F.when(F.col("_stretch") == 1, _opens("start_date", gap_days)).otherwise(0))
        .withColumn("_added", added.cast("long"))
        .withColumn("_all_n", F.sum("_n").over(upto))
        .withColumn("_all_added", F.coalesce(F.sum("_added").over(upto), F.lit(0)))
        .withColumn("_last", F.coalesce(F.lead("_opens").over(by_start), F.lit(1)) == 1)
    )
    opening = F.struct(
        F.col("start_date").alias("start"),
        (F.col("_all_n") - F.col("_n")).alias("n"),
        (F.col("_all_added") - F.coalesce("_added", F.lit(0))).alias("added"),
    )
    opened = F.last(F.when(first | (F.col("_opens") == 1), opening), ignorenulls=True).over(upto)
    start = F.coalesce("_open.start", "_first_start")
    end = F.greatest("_reach", "end_date")
    eras = (
        marked.withColumn("_open", opened)
        .withColumn("_first_start", F.min("start_date").over(upto))
        .filter("_last")
        .select(
            *keys,
            start.alias("start_date"),
            end.alias("end_date"),
            (F.col("_all_n") - F.col("_open.n")).alias("drug_exposure_count"),
            (F.col("_all_added") - F.col("_open.added")).alias("days_exposed"),
        )
    )
    return eras.select(
        "person_id",
        F.col("ingredient_concept_id").alias("drug_concept_id"),
        F.col("start_date").alias("drug_era_start_date"),
        F.col("end_date").alias("drug_era_end_date"),
        "drug_exposure_count",
        (F.datediff("end_date", "start_date") - F.col("days_exposed")).cast("long").alias("gap_days"),
    )


def condition_eras(conditions: DataFrame, gap_days: int = ERA_GAP_DAYS) -> DataFrame:
    """Eras per person and condition, without id. A missing end is the next day."""
    eras = collapse_intervals(
        conditions.select(
            "person_id",
            "condition_concept_id",
            F.col("condition_start_date").alias("start_date"),
            F.coalesce("condition_end_date", F.date_add("condition_start_date", 1)).alias("end_date"),
        ),
        ["person_id", "condition_concept_id"],
        "start_date",
        "end_date",
        gap_days,
        count="condition_occurrence_count",
    )
    return eras.select(
        "person_id",
        "condition_concept_id",
        F.col("start_date").alias("condition_era_start_date"),
        F.col("end_date").alias("condition_era_end_date"),
        "condition_occurrence_count",
    )


def with_era_id(eras: DataFrame, kind: str) -> DataFrame:
    """Number eras by person, concept and dates, which is a total order."""
    return with_surrogate_id(
        eras,
        f"{kind}_era_id",
        ["person_id", f"{kind}_concept_id", f"{kind}_era_start_date", f"{kind}_era_end_date"],
    )
