"""User-written operators.

``Operator`` works on whole DataFrames and is the normal case. ``BatchOperator``
is for Python logic that neither the DataFrame API nor SQL can express: it gets
Arrow tables of at most ``batch_size`` rows, in no particular order or grouping
(a ``GroupBatchOperator`` of whole groups in order, see ``groups``).
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .sessions import compact_sessions
from .turn_index import carry_turn_index
from .turns import compact_turns, errors_in_turns


def named_outputs(result: Any, outputs: tuple[str, ...], convert: Callable[[Any], Any]) -> dict[str, Any]:
    """Match what an operator returned with the outputs it declares."""
    if not isinstance(result, dict):
        if len(outputs) > 1:
            raise ValueError(f"one table returned, but outputs {list(outputs)} are declared")
        result = {outputs[0]: result}
    if result.keys() != set(outputs):
        raise ValueError(f"outputs {sorted(result)} returned, but {sorted(outputs)} are declared")
    return {name: convert(table) for name, table in result.items()}


def checked_batch_size(size: int | None) -> int | None:
    if size is not None and size < 1:
        raise ValueError(f"batch_size must be at least 1, not {size}")
    return size


class Operator:
    """Subclass with ``outputs`` and ``transform(ctx, df)``, which returns one
    DataFrame or a dict with one DataFrame per declared output."""

    outputs: tuple[str, ...] = ("out",)

    def __init__(self, batch_size: int | None = None):
        """``batch_size`` has no effect: these operators see the whole frame."""
        self.batch_size = checked_batch_size(batch_size)

    def transform(self, ctx: Any, df: DataFrame) -> DataFrame | dict[str, DataFrame]:
        raise NotImplementedError


class BatchOperator:
    """Subclass with ``schemas`` (output name -> schema) and ``transform(ctx, batch)``.

    ``batch`` is a ``pyarrow.Table``; so is each result, or anything with a
    ``to_arrow`` method. ``ctx`` is None: batches run on executors.
    """

    schemas: dict[str, T.StructType | str] = {}

    def __init__(self, batch_size: int | None = None):
        self.batch_size = checked_batch_size(batch_size)

    @property
    def outputs(self) -> tuple[str, ...]:
        return tuple(self.schemas)

    def transform(self, ctx: Any, batch: pa.Table) -> Any:
        raise NotImplementedError

    def arranged(self, df: DataFrame) -> DataFrame:
        """The rows as the batches are cut from them."""
        return df

    def results(self, batches: Iterator[pa.RecordBatch], convert: Callable[[Any], Any]) -> Iterator[tuple[str, Any]]:
        """(output, table) of each batch of a task."""
        for table in sized_batches(batches, self.batch_size):
            yield from named_outputs(self.transform(None, table), self.outputs, convert).items()


def apply(op: Operator | BatchOperator, df: DataFrame, ctx: Any = None,
          storage_level: StorageLevel | None = None, folder: str | None = None) -> dict[str, DataFrame]:
    """Apply ``op`` to ``df``; returns one DataFrame per output.

    Several outputs come from the same work, which is lazy and done once for each output that is used. There are two
    ways to do it once for all of them. With a ``folder``, one pass writes the rows of all outputs there, each under its
    output's name, and the outputs are read from there: nothing is repeated, whatever executors are lost. With a
    ``storage_level``, a batch operator's results are kept, and an operator finds the level as ``self.storage_level``
    to keep what its outputs share; ``op.shared`` is the kept frame, to unpersist.
    """
    if isinstance(op, BatchOperator):
        if folder is not None:
            return _written_once(_tagged_batches(op, df), _schemas(op), folder)
        return _apply_batches(op, df, storage_level)
    if storage_level is not None:
        op.storage_level = storage_level
    outputs = named_outputs(op.transform(ctx, df), op.outputs, _dataframe)
    if folder is None:
        return outputs
    schemas = {name: output.schema for name, output in outputs.items()}
    # one query, in which Spark does the shuffles that the outputs share once
    tagged = [output.select(*(F.struct(*(F.col(f"`{c}`") for c in output.columns)).alias(n) if n == name else F.lit(None).cast(s).alias(n)
                              for n, s in schemas.items())) for name, output in outputs.items()]
    return _written_once(functools.reduce(DataFrame.union, tagged), schemas, folder)


#: The column of output names in a folder of outputs.
OUTPUT = "_output"


def _written_once(mixed: DataFrame, schemas: dict[str, T.StructType], folder: str) -> dict[str, DataFrame]:
    """Write rows that hold a struct in the column of their output, and read each output back."""
    tag = F.coalesce(*(F.when(F.col(f"`{n}`").isNotNull(), F.lit(n)) for n in schemas))
    mixed.withColumn(OUTPUT, tag).write.partitionBy(OUTPUT).parquet(folder)
    whole = mixed.sparkSession.read.schema(T.StructType([*mixed.schema, T.StructField(OUTPUT, T.StringType())])).parquet(folder)
    return {n: whole.where(F.col(OUTPUT) == n).select(f"`{n}`.*") for n in schemas}


def _dataframe(value: Any) -> DataFrame:
    if not isinstance(value, DataFrame):
        raise TypeError(f"operators return DataFrames, not {type(value)!r}")
    return value


def _arrow_table(value: Any) -> pa.Table:
    if not isinstance(value, pa.Table) and hasattr(value, "to_arrow"):
        value = value.to_arrow()
    if not isinstance(value, pa.Table):
        raise TypeError(f"batch operators return Arrow tables, not {type(value)!r}")
    return value


def sized_batches(batches: Iterator[pa.RecordBatch], size: int | None) -> Iterator[pa.Table]:
    """Regroup a stream of record batches into tables of exactly ``size`` rows
    (the last one may be shorter), holding no more than that at a time."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if size is None:
            yield pa.Table.from_batches([batch])
            continue
        while rows + batch.num_rows >= size:
            head = batch.slice(0, size - rows)
            batch = batch.slice(size - rows)
            yield pa.Table.from_batches([*held, head])
            held, rows = [], 0
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


def _struct_type(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _schemas(op: BatchOperator) -> dict[str, T.StructType]:
    return {name: _struct_type(s) for name, s in op.schemas.items()}


def _results(op: BatchOperator, arrow: dict[str, pa.Schema], batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.RecordBatch]]:
    for name, result in op.results(batches, _arrow_table):
        for part in result.select(arrow[name].names).cast(arrow[name]).to_batches():
            yield name, part


def _tagged_batches(op: BatchOperator, df: DataFrame) -> DataFrame:
    """All outputs out of one pass, as one struct column per output; each row has one of them."""
    schemas = _schemas(op)
    arrow = {name: to_arrow_schema(s) for name, s in schemas.items()}
    structs = {n: pa.struct(list(s)) for n, s in arrow.items()}

    def rows_of_all(batches):
        for name, part in _results(op, arrow, batches):
            own = pa.StructArray.from_arrays(part.columns, fields=list(arrow[name]))
            columns = [own if n == name else pa.nulls(len(own), structs[n]) for n in schemas]
            yield pa.RecordBatch.from_arrays(columns, names=list(schemas))

    return op.arranged(df).mapInArrow(rows_of_all, T.StructType([T.StructField(n, s) for n, s in schemas.items()]))


def _apply_batches(op: BatchOperator, df: DataFrame, storage_level: StorageLevel | None) -> dict[str, DataFrame]:
    schemas = _schemas(op)
    if len(schemas) == 1:
        name, schema = next(iter(schemas.items()))
        arrow = {name: to_arrow_schema(schema)}
        return {name: op.arranged(df).mapInArrow(lambda batches: (part for _, part in _results(op, arrow, batches)), schema)}
    mixed = _tagged_batches(op, df)
    if storage_level is not None:
        mixed = op.shared = mixed.persist(storage_level)
    return {n: mixed.where(F.col(n).isNotNull()).select(f"`{n}`.*") for n in schemas}


def map_pandas(df: DataFrame, function: Callable, schema: T.StructType | str) -> DataFrame:
    """Apply ``function(pandas frame) -> pandas frame`` to batches of ``df``."""
    return df.mapInPandas(lambda frames: map(function, frames), schema)


def batch_sql(df: DataFrame, query: str, **names: Any) -> DataFrame:
    """SQL over the whole of ``df``, which the query calls ``{batch}``."""
    return df.sparkSession.sql(query, batch=df, **names)


class BuildTurnsAndErrors(Operator):
    """Compact turns and errors of raw events.

    Both outputs read the same numbered events. With ``storage_level`` these are
    persisted for the two of them (``shared`` holds the frame to unpersist).
    """

    outputs = ("turns", "errors")

    def __init__(self, storage_level: StorageLevel | None = None, *, batch_size: int | None = None):
        super().__init__(batch_size)
        self.storage_level = storage_level
        self.shared: DataFrame | None = None

    def transform(self, ctx: Any, df: DataFrame) -> dict[str, DataFrame]:
        numbered = carry_turn_index(df)
        if self.storage_level is not None:
            numbered = self.shared = numbered.persist(self.storage_level)
        return {"turns": compact_turns(numbered), "errors": errors_in_turns(numbered)}


class BuildSessions(Operator):
    """Compact sessions of compact turns."""

    outputs = ("sessions",)

    def transform(self, ctx: Any, df: DataFrame) -> DataFrame:
        return compact_sessions(df)
