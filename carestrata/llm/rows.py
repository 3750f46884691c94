"""Columns computed from texts in Arrow batches; all other columns pass untouched."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from carestrata.runtime import fit_batches

#: Rows whose texts are Python objects at one time.
SLICE = 512


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores more as keep it apart from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def give_back() -> None:
    """Returns freed memory to the system: Spark keeps a Python worker, and what it holds, from task to task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def add_columns(df: DataFrame, sources: list[str], new: str, compute: Callable[..., list], drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` without ``drop`` and with the columns that the DDL ``new`` names.

    ``compute`` gets a list of values per source column and gives one per new column.
    A column of ``df`` that has a new one's name gives way to it.
    """
    fit_batches(df.sparkSession)
    fields = StructType.fromDDL(new)
    gone = {*drop, *fields.names}
    kept = [f for f in df.schema.fields if f.name not in gone]
    schema = StructType(kept + fields.fields)
    types = list(to_arrow_schema(fields).types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, SLICE) for whole in batches for at in range(0, whole.num_rows, SLICE)):
            made = compute(*(batch.column(s).to_pylist() for s in sources))
            columns = [batch.column(f.name) for f in kept] + [pa.array(v, type=t) for v, t in zip(made, types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        give_back()

    return df.mapInArrow(run, schema)
