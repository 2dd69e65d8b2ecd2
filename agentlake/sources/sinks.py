"""Reports as JSON records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _finite(df: DataFrame) -> DataFrame:
    """JSON has no infinity and no NaN; they become null."""
    columns = []
    for field in df.schema:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            odd = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
            value = F.when(~odd, value)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def write_reports(reports: Mapping[str, Mapping[str, DataFrame]], out_dir: str) -> None:
    """Write each table of each report as JSON lines to ``out_dir/report/table``."""
    root = str(out_dir).rstrip("/")
    for report, tables in reports.items():
        for name, df in tables.items():
            _finite(df).write.mode("overwrite").option("ignoreNullFields", "false").json(
                f"{root}/{report}/{name}"
            )
