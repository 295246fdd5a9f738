"""CSV scans with declared schemas, lenient casts, and load audit columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.functions.exprs import instant
from mercato.schemas import TableSpec


def csv_options(spec: TableSpec) -> dict[str, str]:
    """Reader options: header skipped, quotes doubled inside quotes, a bad row fails the load.

    Any text may hold quoted line ends, so a file is read by one task: land many files of bounded size.
    """
    return {
        "header": "true",
        "quote": '"',
        "escape": '"',
        "mode": "FAILFAST",
        "enforceSchema": "false",
        "multiLine": "true",
    }


def read_table(spark: SparkSession, spec: TableSpec, path: str | list[str]) -> DataFrame:
    """Typed scan of one table's CSV files; a NULL in a required column fails the job."""
    raw = spark.read.schema(spec.schema).options(**csv_options(spec)).csv(path)
    return enforce_required(raw, spec)


def enforce_required(df: DataFrame, spec: TableSpec, *extra: str) -> DataFrame:
    """Raise on NULL in required columns, inside the scan: file reads ignore ``nullable=False``."""
    def checked(name: str) -> Column:
        message = F.lit(f"{spec.name}.{name} is required but NULL")
        return F.coalesce(F.col(name), F.raise_error(message)).alias(name)

    return df.select(*[checked(c) if c in spec.required else F.col(c) for c in spec.columns], *extra)


def coerce_types(df: DataFrame, timestamps: list[str] = (), integers: list[str] = ()) -> DataFrame:
    """Unparsable timestamps and non-integral numbers become NULL instead of failing the load."""
    casts = {c: F.col(c).try_cast("timestamp_ntz") for c in timestamps}
    for c in integers:
        exact = F.col(c).try_cast("decimal(38,9)")
        casts[c] = F.when(exact == F.floor(exact), exact.try_cast("bigint"))
    return df.withColumns(casts) if casts else df


def with_audit(df: DataFrame, source_file: str | Column, loaded_at: datetime) -> DataFrame:
    """Add ``_source_file`` and ``_loaded_at``; the time is passed in so that reruns repeat."""
    source = F.lit(source_file) if isinstance(source_file, str) else source_file
    return df.withColumns({
        "_source_file": source,
        "_loaded_at": instant(loaded_at),
    })
