"""Running numpy code over text columns in Arrow batches, with bounded slices."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from agentlake.llm.words import SLICE_BYTES, slices


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns called like results; results take the place of input columns of the same name."""
    taken = {n.lower() for n in names}
    return df.select(*(df[f"`{c}`"] for c in df.columns if c.lower() not in taken))


def map_texts(
    df: DataFrame,
    fields: Sequence[tuple[str, T.DataType]],
    make: Callable[[], Callable[[pa.RecordBatch], Sequence]],
    text: str = "text",
    keep: Sequence[str] | None = None,
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """Append columns computed from slices of rows. ``make()`` runs once in each task and returns a function from a
    slice to one array (or list) per field. ``keep`` names the input columns to return (default: all); input columns
    called like a field are replaced."""
    taken = {name.lower() for name, _ in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(n, t) for n, t in fields])
    types = [pa.int32() if isinstance(t, T.IntegerType) else pa.int64() if isinstance(t, T.LongType)
             else pa.float64() if isinstance(t, T.DoubleType) else pa.string() if isinstance(t, T.StringType)
             else pa.bool_() if isinstance(t, T.BooleanType) else pa.binary() if isinstance(t, T.BinaryType)
             else pa.list_(pa.string()) for _, t in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, text, limit):
                made = [x if isinstance(x, pa.Array) else pa.array(x, type=t) for x, t in zip(work(part), types)]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + made, names=[*kept, *(n for n, _ in fields)])

    return df.mapInArrow(run, schema)
