"""Helpers shared by the training-data operators."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


BATCH_ROWS = 1000  # texts of a batch that Python gets; a batch is in memory several times over


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once a session, for those that do not have it installed, and let the
    session's Arrow batches hold few rows, as texts can be long."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= BATCH_ROWS:
        spark.conf.set(setting, str(BATCH_ROWS))
    context = spark.sparkContext
    if getattr(context, "_mercato_shipped", False):
        return
    import tempfile

    archive = os.path.join(tempfile.mkdtemp(prefix="mercato-code-"), "mercato-code.zip")  # read by the driver alone
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(PACKAGE)))
    context.addPyFile(archive)
    context._mercato_shipped = True


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def map_values(function: Callable, result_type, *columns: Column) -> Column:
    """``function`` of each row's values, called in Arrow batches; columns that it does not take stay in the JVM.

    A struct is returned as a tuple or dict of its fields; values are taken one by one, so that no second copy of
    a batch of long texts is made.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import DataType, _parse_datatype_string

    kind = result_type if isinstance(result_type, DataType) else _parse_datatype_string(result_type)
    names = kind.names if hasattr(kind, "names") else None
    arrow_type = to_arrow_type(kind)

    def run(batches: Iterator) -> Iterator[pa.Array]:
        for batch in batches:
            arrays = batch if isinstance(batch, tuple) else (batch,)
            results = (function(*(v.as_py() for v in row)) for row in zip(*arrays))
            if names:
                results = (dict(zip(names, r)) if isinstance(r, tuple) else r for r in results)
            yield pa.array(list(results), type=arrow_type)

    if len(columns) == 1:
        def mapped(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            return run(batches)
    else:
        def mapped(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            return run(batches)
    return F.arrow_udf(mapped, kind)(*columns)


def driver_file(path: str) -> bytes:
    """A small file that the driver has, as bytes to broadcast; a vocabulary's size does not depend on the corpus."""
    with io.open(path, "rb") as file:
        return file.read()
