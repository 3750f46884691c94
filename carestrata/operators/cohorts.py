"""Cohorts: instantiation, subject counts, overlap and thresholds.

All studies sit in one frame keyed by ``study``; nothing loops over them.

Cohort rows: ``study, cohort_id, subject_id, cohort_start_date,
cohort_end_date``. Studies: ``study, target_id, min_target_subjects,
min_outcome_subjects, min_covariate_subjects``. Manifest: ``study, cohort_id,
cohort_name, is_outcome, expected_empty, failed, hand_authored``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carestrata.operators.intervals import collapse_intervals
from carestrata.runtime import broadcast_bounded, broadcast_for

# Least subjects per role unless a study says otherwise.
MIN_TARGET_SUBJECTS, MIN_OUTCOME_SUBJECTS, MIN_COVARIATE_SUBJECTS = 100, 10, 1

# Texts of the notes on a judged cohort.
NOTE_FAILED = "generation failed: "
NOTE_EMPTY, NOTE_EMPTY_END = "expected empty on synthetic data (", " found)"
NOTE_BY_HAND = "hand-authored: checked on its placeholder definition"

_COHORT = ["study", "cohort_id"]


def cohort_role(cohort_id: str = "cohort_id", target_id: str = "target_id", is_outcome: str = "is_outcome") -> Column:
    """``target`` if it is the target, ``outcome`` if listed, else ``covariate``."""
    return (
        F.when(F.col(cohort_id) == F.col(target_id), "target")
        .when(F.col(is_outcome), "outcome")
        .otherwise("covariate")
    )


def with_default_thresholds(studies: DataFrame) -> DataFrame:
    defaults = {
        "min_target_subjects": MIN_TARGET_SUBJECTS,
        "min_outcome_subjects": MIN_OUTCOME_SUBJECTS,
        "min_covariate_subjects": MIN_COVARIATE_SUBJECTS,
    }
    return studies.withColumns(
        {
            c: F.coalesce(F.col(c).cast("long"), F.lit(v).cast("long"))
            if c in studies.columns
            else F.lit(v).cast("long")
            for c, v in defaults.items()
        }
    )


def members(cohort: DataFrame) -> DataFrame:
    """Each subject of each cohort once. Combines map-side before it shuffles."""
    return cohort.select(*_COHORT, "subject_id").distinct()


def subject_counts(cohort: DataFrame) -> DataFrame:
    """Distinct subjects per cohort."""
    return members(cohort).groupBy(*_COHORT).agg(F.count(F.lit(1)).alias("subjects"))


def with_target_flag(cohort: DataFrame, studies: DataFrame) -> DataFrame:
    """Members with ``in_target``: is the subject in the study's target cohort too.

    A subject has at most one row per cohort of its study here, so looking over
    them takes the place of joining the table to itself.
    """
    targets = broadcast_bounded(studies.select("study", "target_id"), "targets")
    is_target = F.coalesce(F.col("cohort_id") == F.col("target_id"), F.lit(False))
    return (
        members(cohort)
        .join(targets, "study")
        .withColumn("in_target", F.max(is_target).over(Window.partitionBy("study", "subject_id")))
        .drop("target_id")
    )


def target_overlap(cohort: DataFrame, studies: DataFrame, manifest: DataFrame) -> DataFrame:
    """Distinct subjects of each outcome cohort who are also in the study's target."""
    outcomes = broadcast_bounded(manifest.filter("is_outcome").select(_COHORT), "outcomes")
    return (
        with_target_flag(cohort, studies)
        .filter("in_target")
        .join(outcomes, _COHORT, "left_semi")
        .groupBy(*_COHORT)
        .agg(F.count(F.lit(1)).alias("subjects_in_target"))
    )


def counts_and_overlap(cohort: DataFrame, studies: DataFrame) -> DataFrame:
    """Subjects per cohort and how many of them are in the target, in one pass."""
    return (
        with_target_flag(cohort, studies)
        .groupBy(*_COHORT)
        .agg(
            F.count(F.lit(1)).alias("subjects"),
            F.count(F.when(F.col("in_target"), 1)).alias("subjects_in_target"),
        )
    )


def evaluate_thresholds(manifest: DataFrame, studies: DataFrame, counts: DataFrame) -> DataFrame:
    """PASS or FAIL per cohort of the manifest.

    ``counts`` has ``subjects`` and ``subjects_in_target``; a missing cohort
    counts 0. Outcomes are judged on the overlap, all others on their subjects.
    A cohort expected to be empty has the threshold 0; a failed generation fails
    whatever the counts say.
    """
    role = cohort_role()
    is_outcome = F.col("role") == "outcome"
    rows = (
        manifest.join(with_default_thresholds(studies), "study")
        .join(counts, _COHORT, "left")
        .withColumn("role", role)
        .withColumn("subjects", F.coalesce("subjects", F.lit(0)).cast("long"))
        .withColumn(
            "subjects_in_target",
            F.when(is_outcome, F.coalesce("subjects_in_target", F.lit(0)).cast("long")),
        )
        .withColumn(
            "threshold",
            F.when(F.col("expected_empty"), F.lit(0).cast("long"))
            .when(F.col("role") == "target", F.col("min_target_subjects"))
            .when(is_outcome, F.col("min_outcome_subjects"))
            .otherwise(F.col("min_covariate_subjects")),
        )
        .withColumn("metric", F.when(is_outcome, "subjects_in_target").otherwise("subjects"))
        .withColumn("_value", F.when(is_outcome, F.col("subjects_in_target")).otherwise(F.col("subjects")))
    )
    note = F.concat_ws(
        "; ",
        F.when(F.col("failed").isNotNull(), F.concat(F.lit(NOTE_FAILED), F.col("failed"))),
        F.when(
            F.col("expected_empty"),
            F.concat(F.lit(NOTE_EMPTY), F.col("_value").cast("string"), F.lit(NOTE_EMPTY_END)),
        ),
        F.when(F.col("hand_authored"), NOTE_BY_HAND),
    )
    return rows.select(
        "study",
        "cohort_id",
        "cohort_name",
        "role",
        "subjects",
        "subjects_in_target",
        "threshold",
        "metric",
        F.when(F.col("failed").isNull() & (F.col("_value") >= F.col("threshold")), "PASS")
        .otherwise("FAIL")
        .alias("status"),
        note.alias("note"),
    )


def study_problems(studies: DataFrame, manifest: DataFrame) -> DataFrame:
    """Studies that cannot be checked at all, one row per reason.

    A study without a target or without outcomes has no roles; a target missing
    from the manifest cannot be counted. Such studies are rows here rather than
    an error, so the others are still judged.
    """
    listed = manifest.groupBy("study").agg(
        F.max(F.when(F.col("is_outcome"), 1).otherwise(0)).alias("_outcomes")
    )
    joined = studies.select("study", "target_id").join(listed, "study", "left")
    no_roles = joined.filter("target_id is null or coalesce(_outcomes, 0) = 0").select(
        "study", F.lit("no target or no outcome cohort").alias("problem")
    )
    no_target = (
        studies.filter("target_id is not null")
        .select("study", F.col("target_id").alias("cohort_id"))
        .join(manifest.select(_COHORT), _COHORT, "left_anti")
        .select("study", F.concat(F.lit("target cohort not in the manifest: "), F.col("cohort_id").cast("string")).alias("problem"))
    )
    return no_roles.unionByName(no_target)


def cohort_qc(cohort: DataFrame, studies: DataFrame, manifest: DataFrame) -> DataFrame:
    """Thresholds for every study that can be checked."""
    checkable = studies.join(study_problems(studies, manifest).select("study"), "study", "left_anti")
    counts = counts_and_overlap(cohort, checkable)
    return evaluate_thresholds(manifest, checkable, counts)


def instantiate_cohorts(
    definitions: DataFrame,
    entry_concepts: DataFrame,
    events: DataFrame,
    observation_periods: DataFrame,
    inclusion_concepts: DataFrame | None = None,
    era_pad: int = 0,
    exit_at: str = "observation_period_end_date",
) -> DataFrame:
    """Cohort rows from entry events (own definition of the rules).

    ``definitions``: ``study, cohort_id, prior_days, post_days, first_only``.
    ``entry_concepts``: ``study, cohort_id, concept_id``, any of which enters.
    ``inclusion_concepts``: ``study, cohort_id, rule, min_count, concept_id``;
    every rule of a cohort must find that many events of the person.
    ``events``: ``person_id, concept_id, start_date, end_date``.

    An entry counts inside an observation period that extends ``prior_days``
    before and ``post_days`` after it. The cohort row runs to the end of that
    period (or to ``end_date`` of the event), and rows of one subject merge when
    they lie within ``era_pad`` days.
    """
    wanted = broadcast_for(entry_concepts, events, "concept_id", "entry")
    periods = observation_periods.select(
        "person_id", "observation_period_start_date", "observation_period_end_date"
    )
    entries = (
        events.join(wanted, "concept_id")
        .join(broadcast_bounded(definitions, "definitions"), _COHORT)
        .join(periods, "person_id")
        .filter(
            (F.col("start_date") >= F.date_add("observation_period_start_date", F.col("prior_days")))
            & (F.col("start_date") <= F.date_sub("observation_period_end_date", F.col("post_days")))
        )
        .select(
            *_COHORT,
            F.col("person_id").alias("subject_id"),
            "first_only",
            F.col("start_date").alias("cohort_start_date"),
            F.col(exit_at).alias("cohort_end_date"),
        )
    )
    if inclusion_concepts is not None:
        entries = meeting_rules(entries, inclusion_concepts, events)
    return collapse_intervals(
        limit_to_first(entries),
        [*_COHORT, "subject_id"],
        "cohort_start_date",
        "cohort_end_date",
        era_pad,
        count=None,
        distinct_starts=True,
    )


def limit_to_first(entries: DataFrame) -> DataFrame:
    """Earliest entry of a subject where the definition asks for it, else all.

    Entries are first combined per start date (the shortest for a cohort that
    takes only the first, the longest otherwise), so one subject brings no more
    rows to the window than there are days.
    """
    keys = [*_COHORT, "subject_id"]
    days = entries.groupBy(*keys, "first_only", "cohort_start_date").agg(
        F.min("cohort_end_date").alias("_shortest"), F.max("cohort_end_date").alias("_longest")
    )
    first = F.min("cohort_start_date").over(Window.partitionBy(*keys))
    return (
        days.withColumn("_first", first)
        .filter(~F.col("first_only") | (F.col("cohort_start_date") == F.col("_first")))
        .select(
            *keys,
            "cohort_start_date",
            F.greatest(
                "cohort_start_date",
                F.when(F.col("first_only"), F.col("_shortest")).otherwise(F.col("_longest")),
            ).alias("cohort_end_date"),
        )
    )


def meeting_rules(entries: DataFrame, inclusion_concepts: DataFrame, events: DataFrame) -> DataFrame:
    """Entries of subjects that meet all rules, and those of cohorts without rules."""
    ruled = inclusion_concepts.select(_COHORT).distinct().withColumn("_ruled", F.lit(True))
    passed = included_subjects(inclusion_concepts, events).withColumn("_passed", F.lit(True))
    return (
        entries.join(broadcast_bounded(ruled, "ruled"), _COHORT, "left")
        .join(passed, [*_COHORT, "subject_id"], "left")
        .filter(F.col("_ruled").isNull() | F.col("_passed"))
        .drop("_ruled", "_passed")
    )


def included_subjects(inclusion_concepts: DataFrame, events: DataFrame) -> DataFrame:
    """Subjects for whom every inclusion rule of the cohort finds enough events.

    A concept that a rule lists twice counts its events once.
    """
    inclusion_concepts = inclusion_concepts.distinct()
    wanted = broadcast_for(inclusion_concepts, events, "concept_id", "inclusion")
    rules = inclusion_concepts.groupBy(*_COHORT).agg(F.countDistinct("rule").alias("_rules"))
    met = (
        events.join(wanted, "concept_id")
        .groupBy(*_COHORT, "rule", "min_count", "person_id")
        .agg(F.count(F.lit(1)).alias("_events"))
        .filter("_events >= min_count")
        .groupBy(*_COHORT, F.col("person_id").alias("subject_id"))
        .agg(F.count(F.lit(1)).alias("_met"))
    )
    return met.join(rules, _COHORT).filter("_met = _rules").select(*_COHORT, "subject_id")


def collapse_cohorts(cohort: DataFrame, era_pad: int = 0) -> DataFrame:
    """Merge the rows of one subject in one cohort that lie within ``era_pad`` days."""
    return collapse_intervals(
        cohort,
        [*_COHORT, "subject_id"],
        "cohort_start_date",
        "cohort_end_date",
        era_pad,
        count=None,
    )
