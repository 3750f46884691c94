"""Tolerant conversions for loosely typed text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Staging columns that hold dates in mixed encodings.
STAGING_DATE_COLUMNS = (
    "birthdate",
    "startdate",
    "stopdate",
    "start",
    "stop",
    "start_date",
    "stop_date",
)

# Day numbers of 0001-01-01 and 9999-12-31 counted from 1970-01-01.
_FIRST_DAY, _LAST_DAY = -719162, 2932896

_ISO_START = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"

# How a text must look to be a whole number, and how it must begin to be any number.
# A cast that refuses a text takes some twenty times as long as such a look at it.
_WHOLE = r"^[\s\p{Cntrl}]*[+-]?[0-9]+[\s\p{Cntrl}]*$"
_NUMBER_START = r"^[\s\p{Cntrl}]*[+-]?([0-9.]|(?i:nan|inf))"


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _whole_number(col: Column) -> Column:
    return F.when(col.rlike(_WHOLE), col.try_cast("int"))


def _epoch_days(col: Column) -> Column:
    days = _whole_number(col)
    in_calendar = days.between(_FIRST_DAY, _LAST_DAY)
    return F.when(in_calendar, F.date_add(F.lit("1970-01-01").cast("date"), days))


def staging_timestamp(col: Column | str) -> Column:
    """Day number since 1970-01-01, ISO timestamp or ISO date; otherwise null.

    Only what begins like an ISO date is read as one: a bare ``11654`` would otherwise
    be taken for a year. No text is both, and most are dates, so those are looked for
    first. The wall-clock reading is kept, whatever the session time zone.
    """
    c = as_column(col)
    return F.when(c.rlike(_ISO_START), c.try_cast("timestamp_ntz")).otherwise(_epoch_days(c).cast("timestamp_ntz"))


def staging_date(col: Column | str) -> Column:
    """Date part of :func:`staging_timestamp`."""
    return staging_timestamp(col).cast("date")


def death_date(col: Column | str) -> Column:
    """Two dashes mean an ISO date; digits and minus only mean a day number."""
    c = as_column(col)
    return (
        F.when(c.like("%-%-%"), F.when(c.rlike(_ISO_START), c.try_cast("date")))
        .when(F.trim(c) == "", F.lit(None).cast("date"))
        .when(c.rlike(r"^[0-9-]+$"), _epoch_days(c))
    )


def compact_date(col: Column | str) -> Column:
    """``YYYYMMDD`` text or integer to a date, null when it is no such date."""
    text = as_column(col).cast("string")
    return F.when(
        text.rlike(r"^[0-9]{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date")
    )


def null_tokens_to_null(df: DataFrame, tokens: tuple[str, ...]) -> DataFrame:
    """Replace each of ``tokens`` by null in every string column."""
    return df.select(
        *[
            F.when(~F.col(f"`{f.name}`").isin(*tokens), F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def blank_to_null(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Empty text back to null in the listed columns that exist."""
    present = {c: F.nullif(F.col(c), F.lit("")) for c in columns if c in df.columns}
    return df.withColumns(present) if present else df


def null_to_blank(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Null to empty text in the listed columns that exist and hold strings."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    present = {c: F.coalesce(F.col(c), F.lit("")) for c in columns if c in text}
    return df.withColumns(present) if present else df


def two_digit_code(col: Column | str) -> Column:
    """Trim; blank is null; one character gets a leading zero; longer text stays."""
    c = F.trim(as_column(col))
    return F.when(F.length(c) == 1, F.concat(F.lit("0"), c)).when(c != "", c)


def tolerant_double(col: Column | str) -> Column:
    """Number or null, never an error."""
    c = as_column(col)
    return F.when(c.cast("string").rlike(_NUMBER_START), c.try_cast("double"))


def text_prefix(col: Column | str, length: int = 50) -> Column:
    """First ``length`` characters, for a target column of that width."""
    return F.substring(as_column(col), 1, length)


def typed_null(type_name: str) -> Column:
    return F.lit(None).cast(type_name)


def contains_ignoring_case(col: Column | str, term: str) -> Column:
    """Literal, case-insensitive substring test (no wildcards in ``term``)."""
    return F.contains(F.lower(as_column(col)), F.lit(term.lower()))


def slug(col: Column | str) -> Column:
    """Lower case with every run of other than letters and digits made ``_``."""
    return F.regexp_replace(F.lower(as_column(col)), "[^a-z0-9]+", "_")


def standardise_staging(df: DataFrame) -> DataFrame:
    """Parse the known mixed-encoding date columns of a staging table."""
    return df.withColumns(
        {c: staging_timestamp(c) for c in df.columns if c in STAGING_DATE_COLUMNS}
    )
