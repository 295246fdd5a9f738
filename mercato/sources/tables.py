"""Path-based parquet tables: rebuilt whole behind a pointer, merged by bucket, kept as history; plain appends and views."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.schemas import TABLES, TableSpec

BUCKETS = 64  # partition folders of a table merged by key
PART = "_part"
PIECE = "_piece"


class _Pointed:
    """A folder with a pointer: a small file per version, whose newest counts. It remembers the last batch that each
    writer brought in, so that a replayed one is recognised. One writer at a time; the pointer is created without
    overwriting, so the later of two fails (on stores without such a create, let one writer do it)."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    @cached_property
    def _fs(self):
        return self._hadoop_path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _hadoop_path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _pointer(self) -> dict:
        folder = self._hadoop_path("_versions")
        names = sorted(s.getPath().getName() for s in self._fs.listStatus(folder)) if self._fs.exists(folder) else []
        names = [n for n in names if n.endswith(".json")]
        if not names:
            return {"version": 0, "data": None, "applied": {}}
        stream = self._fs.open(self._hadoop_path(f"_versions/{names[-1]}"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    @property
    def version(self) -> int:
        return self._pointer()["version"]

    def applied(self, writer: str) -> int:
        """Number of the last batch ``writer`` brought in, -1 if none."""
        return self._pointer()["applied"].get(writer, -1)

    def _move(self, data: str | None, base_version: int, writer: str | None, batch_id: int) -> int:
        """Point to the next version."""
        pointer = self._pointer()
        if pointer["version"] != base_version:
            raise RuntimeError(f"{self.path} moved to version {pointer['version']} during the write")
        applied = pointer["applied"] | ({} if writer is None else {writer: batch_id})
        version = base_version + 1
        try:
            out = self._fs.create(self._hadoop_path(f"_versions/{version:012d}.json"), False)
        except Exception as error:
            raise RuntimeError(f"{self.path} version {version} was published by another writer") from error
        out.write(bytearray(json.dumps({"version": version, "data": data, "applied": applied}), "utf-8"))
        out.close()
        return version


class VersionedTable(_Pointed):
    """A parquet table that is rebuilt whole: a folder per version, and a pointer to the current one.

    Readers keep the version they opened, and a failed write is never visible. Folders are not deleted: which old ones
    may go is for the store's own retention rules.
    """

    def read(self) -> DataFrame:
        """The current version; an empty table if nothing was published yet."""
        data = self._pointer()["data"]
        return self.read_staged(data) if data else self.spark.createDataFrame([], self.schema)

    def stage(self, df: DataFrame) -> str:
        """Write ``df`` to a new, still invisible folder and return its name."""
        data = f"data-{uuid.uuid4().hex}"
        df.select(*self.schema.fieldNames()).write.parquet(f"{self.path}/{data}")
        return data

    def read_staged(self, data: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{data}")

    def switch(self, data: str, base_version: int, writer: str | None = None, batch_id: int = -1) -> int:
        """Make a staged folder the table; fails if another writer published since ``base_version``."""
        return self._move(data, base_version, writer, batch_id)

    def publish(self, df: DataFrame, writer: str | None = None, batch_id: int = -1) -> int:
        """Stage ``df`` and switch to it. A batch its writer already published is skipped."""
        if writer is not None and self.applied(writer) >= batch_id:
            return self.version
        base = self.version
        return self.switch(self.stage(df), base, writer, batch_id)


class PartedTable(_Pointed):
    """A parquet table in partition folders, of which a write replaces those it has rows for, by Spark's dynamic partition
    overwrite, and leaves all others as they are.

    Writing the same rows again gives the same folders, so a write that failed is simply repeated. The pointer counts
    the writes. Readers that opened the table before a write may have to open it again.
    """

    def read(self) -> DataFrame:
        return self.read_parts().drop(PART)

    def read_parts(self, parts: Iterable[int] | None = None) -> DataFrame:
        """Rows with the number of their folder; of some folders only, if named."""
        fields = T.StructType([*self.schema.fields, T.StructField(PART, T.LongType())])
        if not self._fs.exists(self._hadoop_path("rows")):
            return self.spark.createDataFrame([], fields)
        rows = self.spark.read.schema(fields).parquet(f"{self.path}/rows")
        return rows if parts is None else rows.filter(F.col(PART).isin(list(parts)))

    def holds_parts(self) -> bool:
        """Whether any folder was written yet, be it by a write that was not counted."""
        rows = self._hadoop_path("rows")
        return self._fs.exists(rows) and any(s.getPath().getName().startswith(f"{PART}=") for s in self._fs.listStatus(rows))

    def write_parts(self, df: DataFrame) -> None:
        """Replace the folders that ``df`` has rows for. Deal its rows by folder first (hint ``rebalance``)."""
        (df.select(*self.schema.fieldNames(), PART)
         .write.mode("overwrite").options(partitionOverwriteMode="dynamic", compression="zstd")
         .partitionBy(PART).parquet(f"{self.path}/rows"))

    def count_up(self, base_version: int, writer: str | None = None, batch_id: int = -1) -> int:
        return self._move(None, base_version, writer, batch_id)


class MergedTable(PartedTable):
    """A raw table, merged by key: a key's hash says which of ``buckets`` folders it is in. A table merged by full row only
    ever gains rows, so each merge has a folder of its own. The number of buckets must not change."""

    def __init__(self, spark: SparkSession, path: str, spec: TableSpec, buckets: int = BUCKETS):
        super().__init__(spark, path, spec.schema)
        self.spec, self.buckets = spec, buckets

    def part_of(self) -> Column:
        """The folder of a row of a table merged by key."""
        return F.pmod(F.xxhash64(*self.spec.keys), F.lit(self.buckets)).cast("bigint").alias(PART)

    def dealt(self, rows: DataFrame, pieces: int) -> DataFrame:
        """Rows of a table merged by key, sent to one task for each of the ``pieces`` of a folder, which their keys decide;
        their piece is kept as a column, :meth:`part_of_piece` says whose it is."""
        within = F.pmod(F.hash(*self.spec.keys), F.lit(pieces))  # another hash than the folder's
        piece = (self.part_of() * pieces + within).cast("int").alias(PIECE)
        return rows.select("*", piece).repartitionById(self.buckets * pieces, F.col(PIECE))

    def part_of_piece(self, pieces: int) -> Column:
        return F.floor(F.col(PIECE) / pieces).cast("bigint").alias(PART)


class HistoryTable:
    """A type-2 history in two parts: closed versions, a folder per run that closed them, and the open ones, replaced by
    every run. A run writes what it closed and the open side, whatever the length of the history. ``schema`` has
    ``valid_from`` and ``valid_to``."""

    WRITER = "snapshot"

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.closed = PartedTable(spark, f"{path.rstrip('/')}/closed", schema)
        self.open = VersionedTable(spark, f"{path.rstrip('/')}/open", schema)

    @property
    def last_run(self) -> int:
        """Number of the last whole run, -1 before the first."""
        return self.open.applied(self.WRITER)

    def read(self) -> DataFrame:
        # a run that failed midway may have left its closed rows, which count only once the open side is replaced
        closed = self.closed.read_parts().filter(F.col(PART) <= self.last_run).drop(PART)
        return closed.unionByName(self.open.read())

    def replace(self, advanced: DataFrame, run: int) -> int:
        """Bring in a run: the next state of the open versions, some of them closed by it. Returns the runs so far."""
        self.closed.write_parts(advanced.filter("valid_to IS NOT NULL").withColumn(PART, F.lit(run).cast("bigint")))
        return self.open.publish(advanced.filter("valid_to IS NULL"), self.WRITER, run)


def write_mart(df: DataFrame, root: str, name: str, cluster_by: list[str] | None = None) -> VersionedTable:
    """Full rebuild of one mart table.

    ``cluster_by`` range-partitions and sorts the files, so that filters on its first column skip row
    groups. End it with the table's key: ranges over a unique tuple stay even if one value is very common.
    """
    table = VersionedTable(df.sparkSession, f"{root.rstrip('/')}/{name}", df.schema)
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    table.publish(df)
    return table


def append_rows(df: DataFrame, path: str) -> None:
    """Append to a table folder. A rerun doubles the rows; use the upsert where that matters."""
    df.write.mode("append").parquet(path)


def append_tables(tables: dict[str, DataFrame], root: str) -> list[str]:
    """Append each table below ``root``, parents before the tables that refer to them; returns the order."""
    order = [name for name in TABLES if name in tables]
    for name in order:
        append_rows(tables[name].select(*TABLES[name].columns), f"{root.rstrip('/')}/{name}")
    return order


def register_views(layer: str, tables: dict[str, DataFrame]) -> None:
    """Expose a layer as temp views named ``<layer>_<table>``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{layer}_{name}")
