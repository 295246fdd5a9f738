"""Files landing in a folder, merged into stored tables by a file stream."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.operators.upsert import Merged, merge_into, merge_reports
from mercato.schemas import TABLES, TableSpec, spec_for_file
from mercato.session import Scratch, materialise, short_shuffles
from mercato.sources.files import csv_options, enforce_required
from mercato.sources.tables import PART, PIECE, MergedTable, PartedTable


ARRIVED = "_arrived"
PIECE_BYTES = 16 << 20  # of landed files, compressed or not, for a file of a table's first rows


def arrival(file: str = "file_path") -> Column:
    """Place of a row's file in the order of arrival. Files of one folder may go by ``file_name``, which is shorter."""
    return F.struct(F.col("_metadata.file_modification_time").alias("at"), F.col(f"_metadata.{file}").alias("file"))


def collapse_files(rows: DataFrame, spec: TableSpec, dealt: tuple[str, ...] = ()) -> DataFrame:
    """What merging the files of ``rows`` one after the other would leave of them, as one batch.

    By key, the row of the last file wins, since an update replaces all columns; a key repeated inside one
    file raises. By full row, the copies in the first file that holds a row stay and later ones match it.

    ``dealt`` names columns that keyed rows have been sent by already, which a key decides and the result keeps.
    """
    if spec.full_row:
        # written, so that the copies of a hot row can be split in the join
        first = materialise(rows.groupBy(*spec.columns).agg(F.min(ARRIVED).alias("_first")), "first-arrivals")
        met = rows.join(first, spec.columns).filter(F.col(ARRIVED) == F.col("_first"))
        return met.select(*spec.columns)
    keys = list(spec.keys)
    if not dealt:  # once; else the distinct count would send the rows twice, with keys and files doubled
        rows = rows.repartition(*keys)
    # one grouping: the last file's row, and whether a file holds a key twice
    last = rows.groupBy(*keys, *dealt).agg(
        F.max_by(F.struct(*spec.columns), ARRIVED).alias("_row"), F.count("*").alias("_rows"),
        F.count_distinct(ARRIVED).alias("_files"))
    repeated = F.raise_error(F.concat(
        F.lit(f"file of {spec.name}: repeated key {keys}: "), F.to_json(F.struct(*keys)))).cast("bigint")
    checked = last.withColumn("_rows", F.when(F.col("_rows") > F.col("_files"), repeated).otherwise(F.col("_rows")))
    return checked.filter("_rows > 0").select("_row.*", *dealt)


def _merge_arrived(table: MergedTable, arrived: DataFrame, writer: str, batch_id: int, size: int | None = None) -> Merged:
    """Merge the files of one micro-batch, collapsed first, so that a table is written once per batch and not per file.

    If the files' ``size`` in bytes is known, a table's first rows are collapsed where they are written, and so are sent
    and written only once.
    """
    spec = table.spec
    if table.applied(writer) >= batch_id:
        return Merged(table.version, 0, 0, 0)
    dealt = size is not None and not spec.full_row and not table.holds_parts()
    with Scratch(table.spark) as scratch:
        arrived = enforce_required(arrived, spec, ARRIVED)
        if spec.full_row:  # both the first arrivals and the rows themselves are read from the parsed copy
            collapsed = collapse_files(scratch.materialise(arrived, f"arrived-{spec.name}"), spec)
        elif dealt:
            pieces = max(1, -(-size // (table.buckets * PIECE_BYTES)))
            collapsed = collapse_files(table.dealt(arrived, pieces), spec, (PIECE,)).select(
                *spec.columns, table.part_of_piece(pieces))
        else:
            collapsed = collapse_files(arrived, spec)
        return merge_into(table, collapsed, writer, batch_id, validate=False, dealt=dealt)


def stream_upsert(table: MergedTable, landing: str, checkpoint: str, files_per_trigger: int | None = None) -> int:
    """Merge every file of one table's landing folder not seen before, then stop; returns the table's version.

    The stream's checkpoint replaces an "already loaded" marker. Files merge in order of arrival. A batch replayed after a
    failure is skipped by its number, which the table remembers, or repeated without harm.
    """
    spark, spec = table.spark, table.spec
    reader = spark.readStream.schema(spec.schema).options(**csv_options(spec))
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    arrivals = reader.csv(landing).select(*spec.columns, arrival().alias(ARRIVED))
    writer = f"{spec.name}@{checkpoint}"

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        _merge_arrived(table, batch, writer, batch_id)

    _run(arrivals, merge_batch, checkpoint)
    return table.version


def _run(arrivals: DataFrame, merge_batch, checkpoint: str) -> None:
    query = (
        arrivals.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def load_log(spark: SparkSession, path: str) -> PartedTable:
    """Which tables each batch of a landing stream loaded, and what it did to them; a folder per batch."""
    counts = [T.StructField(f"rows_{done}", T.LongType()) for done in ("staged", "inserted", "updated", "merged")]
    return PartedTable(spark, path, T.StructType([T.StructField("table_name", T.StringType()), *counts]))


def stream_landing(
    spark: SparkSession, landing: str, tables: dict[str, MergedTable], checkpoint: str, log: PartedTable, prefix: str = "",
    suffix: str = "_dataset", files_per_trigger: int = 1000,
) -> dict[str, int]:
    """Merge the files of one landing folder into the tables their names say; others are left alone.

    One stream, so one listing per trigger: it brings the names of new files alone, ``spec_for_file`` says whose each is,
    and every table's files are read and merged side by side. What each merge did goes to ``log`` with the same batch,
    so a table is in it once it is loaded; ``batch_completeness`` asks the log. A replayed batch skips the tables that have
    it and rewrites its folder of the log. Returns each table's version.
    """
    # the content column is never read, so a file costs its name
    names = (
        spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
        .option("maxFilesPerTrigger", files_per_trigger).load(landing).select("path", "length"))
    writer = f"landing@{checkpoint}"

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        files: dict[str, dict[str, int]] = {}
        for row in batch.collect():  # at most files_per_trigger names
            spec = spec_for_file(row["path"], prefix, suffix)
            if spec and spec.name in tables:
                files.setdefault(spec.name, {})[row["path"]] = row["length"]

        def merge_table(name: str) -> Merged:
            spec = TABLES[name]
            read = spark.read.schema(spec.schema).options(**csv_options(spec)).csv(list(files[name]))
            file = "file_name" if len({path.rsplit("/", 1)[0] for path in files[name]}) == 1 else "file_path"
            arrived = read.select(*spec.columns, arrival(file).alias(ARRIVED))
            return _merge_arrived(tables[name], arrived, writer, batch_id, sum(files[name].values()))

        with ThreadPoolExecutor(max(1, len(files))) as pool:
            merged = dict(zip(files, pool.map(merge_table, files)))
        log.write_parts(merge_reports(spark, merged).withColumn(PART, F.lit(batch_id).cast("bigint")))

    with short_shuffles(spark):
        _run(names, merge_batch, checkpoint)
    return {name: table.version for name, table in tables.items()}


def batch_completeness(expected: DataFrame, load_log: DataFrame) -> DataFrame:
    """One row per expected table: whether it was loaded, and how many of all expected ones were."""
    loaded = load_log.select("table_name").distinct().withColumn("_loaded", F.lit(True))
    marked = expected.select("table_name").distinct().join(loaded, "table_name", "left").select(
        "table_name", F.coalesce("_loaded", F.lit(False)).alias("is_loaded"))
    tally = marked.agg(F.struct(
        F.count_if("is_loaded").alias("tables_loaded"), F.count("*").alias("tables_expected"))).scalar()
    return marked.withColumn("_tally", tally).select(
        "table_name", "is_loaded", "_tally.tables_loaded", "_tally.tables_expected",
        (F.col("_tally.tables_loaded") == F.col("_tally.tables_expected")).alias("is_complete"),
    )


def expected_tables(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(name,) for name in TABLES], "table_name string")
