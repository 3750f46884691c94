"""Spark DataFrame operators for patient-level observational data.

The package reads loosely typed extracts, maps source codes to a standard
vocabulary, resolves encounters into visits, collapses exposures and diagnoses
into eras, derives the tables of a common data model, counts cohorts, judges
whether the available codes can cover a set of definitions, and reports data
quality. Everything is a function from DataFrames to a DataFrame.
"""

__version__ = "0.1.0"
