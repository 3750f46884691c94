"""Code systems and concept validity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carestrata.functions.parsing import as_column

# Code-system name to vocabulary id.
SYSTEM_TO_VOCABULARY = {
    "SNOMED-CT": "SNOMED",
    "RxNorm": "RxNorm",
    "LOINC": "LOINC",
    "CVX": "CVX",
    "ICD-10-CM": "ICD10CM",
    "ICD-9-CM": "ICD9CM",
    "CPT": "CPT4",
    "HCPCS": "HCPCS",
    "NUBC": "NUBC",
}

# Fixed value: stands for a code that has not been chosen yet.
PLACEHOLDER_CODE = "REPLACE_ME"

# Fixed value: relationship from a source concept to its standard concept.
MAPS_TO = "Maps to"


def vocabulary_of_system(col: Column | str) -> Column:
    """Vocabulary id of a code-system name, null for an unknown system."""
    c = as_column(col)
    expr = F.when(F.lit(False), F.lit(""))
    for system, vocabulary in SYSTEM_TO_VOCABULARY.items():
        expr = expr.when(c == system, F.lit(vocabulary))
    return expr


def is_placeholder(col: Column | str) -> Column:
    return as_column(col) == PLACEHOLDER_CODE


def is_valid_standard(standard: Column | str = "standard_concept", invalid: Column | str = "invalid_reason") -> Column:
    """Standard and still valid. Validity is a null test, not a blank test."""
    return (as_column(standard) == "S") & as_column(invalid).isNull()
