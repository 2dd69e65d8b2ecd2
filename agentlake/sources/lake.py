"""Tables in a Parquet lake: catalog, filtered reads, writes, views and SQL."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.apply import BatchOperator, Operator, apply
from .partitions import Directories, Wanted, partition_directories
from .snapshots import SnapshotStore, escape_glob


@dataclass(frozen=True)
class TableSpec:
    """``format``: ``parquet``, files in partition directories that any tool can read, or ``snapshot``, a table of a
    ``SnapshotStore`` at ``path``, whose writes appear whole or not at all."""

    name: str
    path: str
    format: str = "parquet"
    schema_version: str = "v2"
    partition_keys: tuple[str, ...] = ()
    description: str = ""
    #: With a schema, a table without files reads as an empty one.
    schema: T.StructType | None = None


class Catalog:
    """Table specs by name; registering a name again replaces its spec."""

    def __init__(self, specs: Iterable[TableSpec] = ()):
        self._specs = {spec.name: spec for spec in specs}

    def get(self, table: str) -> TableSpec:
        try:
            return self._specs[table]
        except KeyError:
            raise KeyError(f"no table {table!r}; known tables: {self.list()}") from None

    def register(self, table: str, spec: TableSpec) -> None:
        self._specs[table] = spec

    def list(self) -> list[str]:
        return sorted(self._specs)


# The tables of the default lake, their folders and partition columns.
DEFAULT_TABLES = {
    "raw_events": ("raw/events", ("dt", "app_id", "session_id"), "Events as they were logged."),
    "sessions": ("derived/sessions", ("dt", "app_id"), "One row per session."),
    "turns": ("derived/turns", ("dt", "app_id"), "One row per turn."),
    "turn_features": ("derived/turn_features", ("dt", "app_id"), "Features of turns."),
    "errors": ("derived/errors", ("dt", "app_id", "error_type"), "Errors inside turns."),
    "eval_runs": ("derived/eval_runs", ("dt", "benchmark", "model"), "Results of evaluation runs."),
}


def default_catalog(lake_root: str, schema_version: str = "v2", format: str = "parquet") -> Catalog:
    root = str(lake_root).rstrip("/")
    return Catalog(
        TableSpec(name, f"{root}/{folder}", format, schema_version, keys, text)
        for name, (folder, keys, text) in DEFAULT_TABLES.items()
    )


@dataclass(frozen=True)
class ReadFilters:
    """Partition filter. ``dt`` wins over the inclusive range ``dt_from`` to
    ``dt_to``; one end of the range alone stands for that single day."""

    dt: str | None = None
    dt_from: str | None = None
    dt_to: str | None = None
    app_id: str | None = None
    session_id: str | None = None

    def _days(self) -> tuple[str, str] | None:
        if self.dt:
            return self.dt, self.dt
        if self.dt_from and self.dt_to:
            return date.fromisoformat(self.dt_from).isoformat(), date.fromisoformat(self.dt_to).isoformat()
        one = self.dt_from or self.dt_to
        return (one, one) if one else None

    def _equal(self, spec: TableSpec) -> dict[str, str]:
        named = {"app_id": self.app_id, "session_id": self.session_id if "session_id" in spec.partition_keys else None}
        return {key: value for key, value in named.items() if value}

    def conditions(self, spec: TableSpec) -> list[Column]:
        found, days = [], self._days()
        if days:
            found.append(F.col("dt") == days[0] if days[0] == days[1] else F.col("dt").between(*days))
        return found + [F.col(key) == value for key, value in self._equal(spec).items()]

    def wanted(self, spec: TableSpec) -> dict[str, Wanted]:
        """Partition values that these filters leave, for those columns that are partition columns."""
        found, days = {key: Wanted((value,)) for key, value in self._equal(spec).items()}, self._days()
        if days:
            found["dt"] = Wanted((days[0],)) if days[0] == days[1] else Wanted(test=lambda day: days[0] <= day <= days[1])
        return found


def equal_to(values: Mapping[str, Any]) -> Column:
    """Condition that every named column has its value; None stands for null."""
    parts = [F.col(c).isNull() if v is None else F.col(c) == F.lit(v) for c, v in values.items()]
    return functools.reduce(Column.__and__, parts, F.lit(True))


@contextmanager
def _partition_values_as_text(spark: SparkSession):
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 wanted: Mapping[str, Wanted] | None = None) -> DataFrame:
    """Parquet with partition values kept as text (no ``007`` turned into 7).

    With ``schema``, a path without files, or that does not exist yet, gives an empty table. With ``wanted``, only the
    partition directories that hold wanted values are listed and read; rows are not filtered otherwise.
    """
    if schema is not None and not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    root = str(path).rstrip("/")
    chosen = partition_directories(spark, root, wanted) if wanted else None
    with _partition_values_as_text(spark):
        reader = spark.read if schema is None else spark.read.schema(schema)
        if chosen is None:
            return reader.parquet(path)
        reader = reader.option("basePath", root)
        if chosen:
            return reader.parquet(*map(escape_glob, chosen))
        # no such partition: the columns are those of any one directory
        return reader.parquet(escape_glob(_first_directory(spark, root))).where(F.lit(False))


def _first_directory(spark: SparkSession, root: str) -> str:
    directories, path = Directories(spark, root), root
    while inside := directories.children(path):
        path = inside[0][2]
    return path


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                  mode: str = "append") -> None:
    """Write Parquet; ``overwrite`` replaces everything under ``path``.

    Partitioned writes are rebalanced by the partition columns, so that a
    partition gets few files; Spark splits the rows of a large one over tasks.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be 'append' or 'overwrite', not {mode!r}")
    keys = list(partition_by or ())
    if keys:
        df = df.hint("rebalance", *[F.col(k) for k in keys])
    writer = df.write.mode(mode).option("partitionOverwriteMode", "static")
    (writer.partitionBy(*keys) if keys else writer).parquet(path)


class Lake:
    """Read, apply and write over the tables of a catalog."""

    def __init__(self, spark: SparkSession, catalog: Catalog):
        self.spark = spark
        self.catalog = catalog

    def read(self, table: str, *, filters: ReadFilters | None = None,
             columns: Sequence[str] | None = None) -> DataFrame:
        spec = self.catalog.get(table)
        df = self._scan(spec, filters.wanted(spec) if filters else {})
        for condition in filters.conditions(spec) if filters else ():
            df = df.where(condition)
        return df.select(*columns) if columns else df

    def _scan(self, spec: TableSpec, wanted: Mapping[str, Wanted]) -> DataFrame:
        if spec.format == "snapshot":
            return SnapshotStore(self.spark, spec.path).read(spec.name, wanted=wanted, schema=spec.schema)
        if spec.format != "parquet":
            raise ValueError(f"no such table format: {spec.format!r}")
        return read_parquet(self.spark, spec.path, spec.schema, wanted)

    def dataset(self, table: str, filters: Mapping[str, Any] | None = None) -> DataFrame:
        """Table rows on which every named column has the given value."""
        wanted = {c: Wanted((v,)) for c, v in (filters or {}).items() if isinstance(v, str) and v}
        return self._scan(self.catalog.get(table), wanted).where(equal_to(filters or {}))

    def write(self, df: DataFrame, table: str, *, path: str | None = None,
              partition_by: Sequence[str] | None = None, mode: str = "append") -> None:
        """``path`` overrides the place of the catalog. Plain Parquet tables are replaced file by file; of ``snapshot``
        tables readers see all of a write or nothing."""
        spec = self.catalog.get(table) if path is None or table in self.catalog.list() else TableSpec(table, path)
        if spec.format == "snapshot":
            SnapshotStore(self.spark, path or spec.path).write({table: df}, partition_by={table: partition_by or ()}, mode=mode)
        else:
            write_parquet(df, path or spec.path, partition_by, mode)

    def view(self, table: str, df: DataFrame | None = None) -> None:
        """Make a table, or ``df`` under that name, available to ``sql``."""
        (self.read(table) if df is None else df).createOrReplaceTempView(table)

    def sql(self, query: str, params: Sequence[Any] | None = None) -> DataFrame:
        """SQL with positional ``?`` parameters."""
        return self.spark.sql(query, args=list(params or ()))

    def apply(self, op: Operator | BatchOperator, df: DataFrame) -> dict[str, DataFrame]:
        return apply(op, df, self)
