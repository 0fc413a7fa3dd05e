"""Arrow batches in, Arrow batches out: how the operators run Python beside the data.

A worker reads a batch in slices, so that the Python objects alive at a time are bounded
by ``SLICE_ROWS`` rows and not by the size of the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tallyline.session import ship_package

SLICE_ROWS = 512


def column(name: str) -> Column:
    """A column by its exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def texts(values: pa.Array) -> Iterator[str]:
    """The strings of an Arrow column, a missing one as the empty text."""
    for start in range(0, len(values), SLICE_ROWS):
        for text in values.slice(start, SLICE_ROWS).to_pylist():
            yield text or ""


def add_columns(
    df: DataFrame, inputs: Sequence[str], prepare: Callable[[], Callable[..., list]], ddl: str
) -> DataFrame:
    """``df`` with the columns of ``ddl`` appended.

    ``prepare`` runs once per task and returns a function of the Arrow arrays of
    ``inputs`` that gives one sequence per new column. A column of ``df`` whose name is
    that of a new one (in any case) gives way to it.
    """
    ship_package(df.sparkSession)
    new = StructType.fromDDL(ddl)
    taken = {f.name.lower() for f in new}
    kept = [c for c in df.columns if c.lower() not in taken]
    arguments = [column(c).alias(f"_argument_{i}") for i, c in enumerate(inputs)]
    # Numbered names inside, as any character may stand in those of the table.
    source = df.select(*[column(c).alias(f"_column_{i}") for i, c in enumerate(kept)], *arguments)
    schema = StructType([source.schema[i] for i in range(len(kept))] + list(new))
    arrow_types = [f.type for f in to_arrow_schema(new)]
    width = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = prepare()
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(start, SLICE_ROWS)
                results = work(*batch.columns[width:])
                made = [
                    r if isinstance(r, pa.Array) else pa.array(r, type=t)
                    for r, t in zip(results, arrow_types, strict=True)
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns[:width], *made], names=schema.names)

    return source.mapInArrow(run, schema).toDF(*kept, *new.names)


def rows_of(
    df: DataFrame, prepare: Callable[[], Callable[[Iterator[pa.RecordBatch]], Iterator[dict]]], ddl: str
) -> DataFrame:
    """Other rows from the rows of ``df``: ``prepare`` runs once per task and returns a
    function from its batches to dictionaries of columns (Arrow arrays or sequences)."""
    ship_package(df.sparkSession)
    schema = StructType.fromDDL(ddl)
    arrow_schema = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in prepare()(batches):
            arrays = [
                c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, type=f.type) for f in arrow_schema
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return df.mapInArrow(run, schema)
