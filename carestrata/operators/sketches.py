"""Profiles from mergeable sketches: one scan a table, and none when batches are added.

A table yields one row per column with counts and three sketches: distinct values,
quantiles (numbers, dates and times) and frequent values. Sketches of batches merge, so
a profile over reloads reads only what was loaded. Counts of rows and nulls are exact.

Errors: distinct values are within 5 % (three standard errors at the default size), and
exact below about a hundred; quantiles are within 2 % of the rows in rank; a frequent
value's count exceeds the truth by at most 3.5 / (tracked / 0.75) of the rows, and is
exact while a column has no more distinct values than are tracked. ``field_profile``
counts exactly. Quantile sketches choose at random, so estimates vary in that range.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Log of the registers of a distinct sketch, size of a quantile sketch, values tracked.
DISTINCT_BITS, QUANTILE_SIZE, TRACKED = 12, 256, 512

#: Relative error of a distinct count, error in rank of a quantile.
DISTINCT_ERROR, RANK_ERROR = 0.05, 0.02

#: Groups of scan tasks whose sketches are merged first.
LANES = 64

PROBABILITIES = (0.0, 0.25, 0.5, 0.75, 1.0)


def _number(column: Column, kind: T.DataType) -> Column | None:
    """The column as a double where it has an order of numbers; days and seconds for dates and times."""
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")) / F.lit(1e6)
    if isinstance(kind, T.NumericType):
        value = column.cast("double")
        return F.when(~F.isnan(value), value)
    return None


def _text(column: Column, kind: T.DataType) -> Column:
    return F.to_json(F.struct(column.alias("v"))) if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)) else column.cast("string")


def column_sketches(df: DataFrame, table: str, columns: list[str] | None = None, tracked: int = TRACKED) -> DataFrame:
    """Counts and sketches per column, from one scan of the table.

    Scan tasks send one row of sketches each; these are merged in ``LANES`` groups, and
    per column after that, so no task takes the sketches of all scan tasks. An empty
    table yields rows of zeros.
    """
    fields = [df.schema[c] for c in (columns or df.columns)]
    aggregates = [F.count(F.lit(1)).alias("rows")]
    entries = []
    for i, field in enumerate(fields):
        column = F.col(f"`{field.name}`")
        text, number = _text(column, field.dataType), _number(column, field.dataType)
        aggregates += [
            F.count(column).alias(f"n{i}"),
            F.hll_sketch_agg(text, DISTINCT_BITS).alias(f"d{i}"),
            F.call_function("approx_top_k_accumulate", text, F.lit(tracked)).alias(f"f{i}"),
        ]
        if number is not None:
            aggregates.append(F.kll_sketch_agg_double(number, QUANTILE_SIZE).alias(f"q{i}"))
        quantiles = F.col(f"q{i}") if number is not None else F.lit(None).cast("binary")
        entries.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.col("rows").alias("n_rows"),
                F.col(f"n{i}").alias("n_filled"),
                F.col(f"d{i}").alias("distinct_values"),
                quantiles.alias("quantiles"),
                F.col(f"f{i}").alias("frequent_values"),
            )
        )
    lanes = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(LANES)).alias("lane")).agg(*aggregates)
    rows = lanes.select(F.explode(F.array(*entries)).alias("c")).select(F.lit(table).alias("table_name"), "c.*")
    names = df.sparkSession.range(1).select(
        F.lit(table).alias("table_name"), F.explode(F.array(*[F.lit(f.name) for f in fields])).alias("column_name")
    )
    merged = names.join(merge_sketches([rows], tracked), ["table_name", "column_name"], "left")
    return merged.fillna(0, ["n_rows", "n_filled"])


def merge_sketches(batches: list[DataFrame], tracked: int = TRACKED) -> DataFrame:
    """Sketches of several batches, added up per table and column."""
    return (
        reduce(DataFrame.unionByName, batches)
        .groupBy("table_name", "column_name")
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.sum("n_filled").alias("n_filled"),
            F.hll_union_agg("distinct_values").alias("distinct_values"),
            F.kll_merge_agg_double("quantiles").alias("quantiles"),
            F.call_function("approx_top_k_combine", "frequent_values", F.lit(tracked)).alias("frequent_values"),
        )
    )


def latest_sketches(stored: DataFrame, batch: str = "batch", order: str = "loaded_at") -> DataFrame:
    """Of each batch the sketches recorded last: a batch loaded again replaces its former self."""
    values = [c for c in stored.columns if c not in ("table_name", "column_name", batch, order)]
    return (
        stored.groupBy("table_name", "column_name", batch)
        .agg(F.max_by(F.struct(*values), order).alias("s"))
        .select("table_name", "column_name", batch, "s.*")
    )


def sketched_profile(sketches: DataFrame, probabilities: tuple[float, ...] = PROBABILITIES) -> DataFrame:
    """Rows, nulls, estimated distinct values and quantiles per column.

    Quantiles are null where a column has no numbers.
    """
    filled = F.col("quantiles").isNotNull() & (F.kll_sketch_get_n_double("quantiles") > 0)
    at = F.array(*[F.lit(float(p)) for p in probabilities])
    return sketches.select(
        "table_name",
        "column_name",
        "n_rows",
        (F.col("n_rows") - F.col("n_filled")).alias("n_null"),
        F.coalesce(F.hll_sketch_estimate("distinct_values"), F.lit(0)).alias("n_distinct"),
        F.when(filled, F.kll_sketch_get_quantile_double("quantiles", at)).alias("quantiles"),
    )


def frequent_values(sketches: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` values a column holds most often, as text, with estimated counts. Nulls are no values."""
    top = F.call_function("approx_top_k_estimate", "frequent_values", F.lit(k))
    return (
        sketches.where("n_filled > 0")
        .select("table_name", "column_name", F.explode(top).alias("t"))
        .select("table_name", "column_name", F.col("t.item").alias("value"), F.col("t.count").alias("n_rows"))
        .where("value is not null")
    )
