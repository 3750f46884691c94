"""Prior observation, washout and time at risk around the index dates of a cohort.

Target rows: ``study, target_id, subject_id, index_date, end_date``. Outcome rows:
``study, outcome_id, subject_id, outcome_date``. Periods: ``person_id,
observation_period_start_date, observation_period_end_date`` (a missing end is still
open). Deaths: ``person_id, death_date``. Settings, one row per study: ``prior_days,
washout_days, risk_start, risk_end, risk_from_end, censor_at_outcome``.

Nothing is joined with all dates of a person: index dates and what they look for are put
in one order of days, and frames over that order find the last date before and the
first one after.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carestrata.operators.intervals import collapse_intervals
from carestrata.runtime import broadcast_bounded

#: What became of an index date.
NOT_OBSERVED, SHORT_PRIOR, WASHED_OUT, NO_TIME = "not observed", "short prior observation", "prior outcome", "no time at risk"
CASE, NO_CASE = "case", "no case"

#: End of a period that has none.
OPEN_END = "9999-12-31"

_INDEX = ["study", "target_id", "subject_id", "index_date"]


def _date(text: str) -> Column:
    return F.lit(text).cast("date")


def _shifted(date: Column, days: Column) -> Column:
    """``date`` moved by ``days``, at most to the last day there is."""
    return F.least(F.date_add(date, F.least(days, F.datediff(_date(OPEN_END), date))), _date(OPEN_END))


def observed_periods(periods: DataFrame) -> DataFrame:
    """Periods of a person without overlaps; adjoining ones count as one, open ends as ``OPEN_END``."""
    end = F.coalesce("observation_period_end_date", _date(OPEN_END))
    filled = periods.select("person_id", F.col("observation_period_start_date").alias("start_date"), end.alias("end_date"))
    return collapse_intervals(filled.filter("start_date is not null and end_date >= start_date"), ["person_id"], "start_date", "end_date", 1, count=None)


def with_period(index: DataFrame, periods: DataFrame) -> DataFrame:
    """Index dates with the period around them (``period_start``, ``period_end``; null if none).

    A person's days and periods meet in one order: the last period to begin by a day is
    the only one that can hold it, since periods do not overlap.
    """
    days = index.select("subject_id", F.col("index_date").alias("_day")).distinct()
    span = F.struct(F.col("start_date").alias("period_start"), F.col("end_date").alias("period_end"))
    begun = observed_periods(periods).select(F.col("person_id").alias("subject_id"), F.col("start_date").alias("_day"), span.alias("_span"))
    upto = Window.partitionBy("subject_id").orderBy("_day").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    found = (
        begun.unionByName(days.withColumn("_span", F.lit(None).cast(begun.schema["_span"].dataType)))
        .withColumn("_last", F.last("_span", ignorenulls=True).over(upto))
        .filter("_span is null and _day <= _last.period_end")
        .select("subject_id", F.col("_day").alias("index_date"), "_last.period_start", "_last.period_end")
    )
    return index.join(found, ["subject_id", "index_date"], "left")


def around_index(probes: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Per index date and outcome: the last outcome before it and the first from the risk start on.

    ``probes`` has the index columns, ``outcome_id`` and ``risk_start_date``. Each is put
    twice among the days of its subject and outcome, at the index date and at the risk
    start. Equal days are combined before, so a subject brings at most one row per
    calendar day and kind to a window. The frames run forward and backward in
    order, never from each row to the end.
    """
    keys = ["study", "outcome_id", "subject_id"]
    happened = outcomes.filter("outcome_date is not null").select(*keys, "outcome_date").distinct()
    at = F.array(
        F.struct(F.lit("index").alias("_kind"), F.col("index_date").alias("_date")),
        F.struct(F.lit("risk").alias("_kind"), F.col("risk_start_date").alias("_date")),
    )
    asked = probes.select(*keys, "target_id", "index_date", F.inline(at))
    rows = asked.unionByName(happened.withColumn("_kind", F.lit("outcome")).withColumnRenamed("outcome_date", "_date"), allowMissingColumns=True)
    rows = rows.withColumn("_day", F.unix_date("_date")).withColumn("_hit", F.when(F.col("_kind") == "outcome", F.col("_date")))
    before = Window.partitionBy(*keys).orderBy("_day").rangeBetween(Window.unboundedPreceding, -1)
    onward = Window.partitionBy(*keys).orderBy(F.desc("_day")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    seen = rows.withColumn("_before", F.max("_hit").over(before)).withColumn("_onward", F.min("_hit").over(onward))
    return (
        seen.filter("_kind <> 'outcome'")
        .groupBy(*keys, "target_id", "index_date")
        .agg(
            F.max(F.when(F.col("_kind") == "index", F.col("_before"))).alias("last_outcome_date"),
            F.max(F.when(F.col("_kind") == "risk", F.col("_onward"))).alias("next_outcome_date"),
        )
    )


def cohort_windows(
    targets: DataFrame, outcomes: DataFrame, outcome_ids: DataFrame, periods: DataFrame, deaths: DataFrame, settings: DataFrame
) -> DataFrame:
    """One row per index date and outcome of its study, with its windows and status.

    ``outcome_ids`` lists (study, outcome_id). An index date counts if an observation
    period holds it and ``prior_days`` before it, and no outcome lies in the
    ``washout_days`` before it (null: at any time before). The time at risk runs from
    ``risk_start`` days after the index date to ``risk_end`` days after it, or after the
    cohort row's end if ``risk_from_end`` (null: to the end of observation); it ends early
    with the period, with death, and on the day of the first outcome if
    ``censor_at_outcome``. An outcome within it makes a case.

    Rows of a target without an index date or a study without settings are left out; a
    missing ``end_date`` is the end of the period, one before the index date is that date.
    Repeated rows of one index date count once, with the latest end.
    """
    setting = broadcast_bounded(
        settings.select(
            "study", "prior_days", "washout_days", "risk_start", "risk_end",
            F.coalesce("risk_from_end", F.lit(False)).alias("risk_from_end"),
            F.coalesce("censor_at_outcome", F.lit(False)).alias("censor_at_outcome"),
        ),
        "windows",
    )
    open_row = F.max(F.col("end_date").isNull())
    index = targets.filter("index_date is not null").groupBy(*_INDEX).agg(F.when(~open_row, F.max("end_date")).alias("end_date"))
    placed = with_period(index, periods).join(setting, "study").join(broadcast_bounded(outcome_ids.select("study", "outcome_id").distinct(), "outcome-ids"), "study")
    died = deaths.filter("death_date is not null").groupBy(F.col("person_id").alias("subject_id")).agg(F.min("death_date").alias("death_date"))
    observed_end = F.least(F.coalesce("period_end", _date(OPEN_END)), F.coalesce("death_date", _date(OPEN_END)))
    row_end = F.greatest("index_date", F.coalesce("end_date", "period_end"))
    planned = F.when(F.col("risk_end").isNull(), F.col("observed_end")).when(F.col("risk_from_end"), _shifted(row_end, F.col("risk_end"))).otherwise(_shifted(F.col("index_date"), F.col("risk_end")))
    timed = (
        placed.join(died, "subject_id", "left")
        .withColumn("observed_end", observed_end)
        .withColumn("risk_start_date", _shifted(F.col("index_date"), F.coalesce("risk_start", F.lit(0))))
        .withColumn("risk_end_date", F.least(planned, F.col("observed_end")))
    )
    met = timed.join(around_index(timed, outcomes), [*_INDEX, "outcome_id"])
    outcome = F.when((F.col("next_outcome_date") <= F.col("risk_end_date")) & (F.col("risk_start_date") <= F.col("risk_end_date")), F.col("next_outcome_date"))
    prior = F.datediff("index_date", "period_start")
    since = F.datediff("index_date", "last_outcome_date")
    end = F.when(F.col("censor_at_outcome"), F.least("risk_end_date", "outcome_date")).otherwise(F.col("risk_end_date"))
    days = F.greatest(F.datediff(end, "risk_start_date") + 1, F.lit(0))
    status = (
        F.when(F.col("period_start").isNull() | (F.col("index_date") > F.col("observed_end")), NOT_OBSERVED)
        .when(prior < F.coalesce("prior_days", F.lit(0)), SHORT_PRIOR)
        .when(F.col("last_outcome_date").isNotNull() & (F.col("washout_days").isNull() | (since <= F.col("washout_days"))), WASHED_OUT)
        .when(F.col("risk_start_date") > F.col("risk_end_date"), NO_TIME)
        .when(F.col("outcome_date").isNotNull(), CASE)
        .otherwise(NO_CASE)
    )
    counts = F.col("status").isin(CASE, NO_CASE)
    return met.withColumn("outcome_date", outcome).withColumn("status", status).select(
        *_INDEX, "outcome_id", prior.cast("long").alias("prior_observation_days"), "last_outcome_date",
        *[F.when(counts, F.col(c)).alias(c) for c in ("risk_start_date", "risk_end_date")],
        F.when(counts, F.col("outcome_date")).alias("outcome_date"),
        F.when(counts, days).otherwise(0).cast("long").alias("days_at_risk"), "status",
    )


def incidence(windows: DataFrame) -> DataFrame:
    """Per study, target and outcome: index dates by status, cases, and days at risk."""
    count = lambda *names: F.count(F.when(F.col("status").isin(*names), 1))
    return windows.groupBy("study", "target_id", "outcome_id").agg(
        F.count(F.lit(1)).alias("index_dates"),
        count(NOT_OBSERVED, SHORT_PRIOR).alias("without_history"),
        count(WASHED_OUT).alias("washed_out"),
        count(NO_TIME).alias("without_time"),
        count(CASE).alias("cases"),
        F.sum("days_at_risk").alias("days_at_risk"),
    )
