"""Keyed and full-row upserts, as plans and onto stored tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mercato.schemas import TableSpec
from mercato.session import Scratch, materialise
from mercato.sources.tables import PART, MergedTable


class DuplicateKeyError(ValueError):
    """A batch holds two rows for one key, so the update would be ambiguous."""


def require_unique(df: DataFrame, keys: list[str], what: str) -> None:
    """Raise if any key occurs twice; map-side counts keep a hot key from travelling row by row."""
    repeated = df.groupBy(*keys).count().filter("count > 1").limit(3).collect()
    if repeated:
        shown = ", ".join(str(tuple(row[k] for k in keys)) for row in repeated)
        raise DuplicateKeyError(f"{what}: repeated key {keys}: {shown}")


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], validate: bool = True) -> DataFrame:
    """Insert new keys, replace **all** columns of matched ones, keep the rest, delete nothing.

    A matched target row contributes nothing to the result, so an anti-join on the keys plus a union
    replaces the outer join: only the batch's keys are shuffled or, when measured small, broadcast.
    """
    if validate:
        require_unique(batch, keys, "upsert batch")
    untouched = target.join(batch.select(*keys), keys, "left_anti").select(*target.columns)
    return untouched.unionByName(batch.select(*target.columns))


def upsert_full_row(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Insert batch rows that are not in the target as a whole; copies inside a batch all stay.

    Plain equality: a row with a NULL never matches.
    """
    return target.unionByName(new_rows(target, batch))


def new_rows(target: DataFrame, batch: DataFrame) -> DataFrame:
    """The rows of ``batch`` that the target does not hold as a whole, all copies.

    Every join stands on written tables, so a row with very many copies on either side can be split.
    """
    columns = target.columns
    batch = batch.select(*columns)
    sent = materialise(batch.distinct(), "sent-rows")
    met = materialise(sent.join(target, columns).distinct(), "met-rows")  # at most as many as were sent
    return batch.join(met, columns, "left_anti").select(*columns)


def with_action(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The batch with ``_action``: ``update`` where the key is in the target, else ``insert``."""
    known = target.select(*keys).distinct().withColumn("_known", F.lit(True))
    action = F.when(F.col("_known"), F.lit("update")).otherwise(F.lit("insert"))
    return batch.join(known, keys, "left").select(*batch.columns, action.alias("_action"))


def merge_report(target: DataFrame, batch: DataFrame, spec: TableSpec) -> DataFrame:
    """One row: rows staged, inserted and updated by merging ``batch`` into ``target``.

    Full-row tables only insert, so their matches count as neither.
    """
    sent = batch.groupBy(*spec.merge_keys).count()  # counted first: copies of a hot row are one row in the join
    counts = (
        with_action(target, sent, spec.merge_keys)
        .groupBy("_action").agg(F.sum("count").alias("count"))
        .agg(
            F.coalesce(F.sum("count"), F.lit(0)).alias("rows_staged"),
            F.coalesce(F.sum(F.when(F.col("_action") == "insert", F.col("count"))), F.lit(0)).alias("rows_inserted"),
            F.coalesce(F.sum(F.when(F.col("_action") == "update", F.col("count"))), F.lit(0)).alias("matched"),
        )
    )
    updated = F.lit(0).cast("bigint") if spec.full_row else F.col("matched")
    return counts.select(
        F.lit(spec.name).alias("table_name"), "rows_staged", "rows_inserted", updated.alias("rows_updated"),
        (F.col("rows_inserted") + updated).alias("rows_merged"),
    )


def merge(target: DataFrame, batch: DataFrame, spec: TableSpec, validate: bool = True) -> DataFrame:
    """The upsert that fits the table: by key, or by full row where there is none."""
    if spec.full_row:
        return upsert_full_row(target, batch)
    return upsert(target, batch, list(spec.keys), validate)


class Merged(NamedTuple):
    """What a merge did: the table's version, and rows sent, inserted and updated."""

    version: int
    staged: int
    inserted: int
    updated: int


def merge_into(
    table: MergedTable,
    batch: DataFrame,
    writer: str | None = None,
    batch_id: int = -1,
    validate: bool = True,
    settled: bool = False,
    dealt: bool = False,
) -> Merged:
    """Merge ``batch`` into a table, creating it on first use.

    By key, the folders of the buckets that hold a key of the batch are replaced by their other rows and the batch's; by
    full row, the batch's new rows become a folder. All other folders stay as they are. A batch the writer already
    brought in is skipped; one that failed is repeated, which gives the same rows. The counts are observed by the write
    itself: rows that stay are counted as they are written, and a bucket's rows before come from file footers.

    ``settled`` says that the batch is a written table already; else it is written once to shared storage, as the key
    check, the search for buckets and the write each read it. A table without rows takes a batch whose keys need no check
    as it is, since nothing else reads it; if it is ``dealt``, with the folders of its rows as a column, they stay where
    they are.
    """
    spec = table.spec
    if writer is not None and table.applied(writer) >= batch_id:
        return Merged(table.version, 0, 0, 0)
    base = table.version
    if not table.holds_parts() and (spec.full_row or not validate):
        if spec.full_row:
            inserted = _written(table, batch.select(*spec.columns, F.lit(base + 1).cast("bigint").alias(PART)))
        else:
            inserted = _written(table, batch.select(*spec.columns, PART if dealt else table.part_of()), dealt)
        return Merged(table.count_up(base, writer, batch_id), inserted, inserted, 0)
    with Scratch(table.spark) as scratch:
        batch = batch.select(*spec.columns)
        if not settled:
            batch = scratch.materialise(batch, f"batch-{spec.name}")
        staged = batch.count()
        if not staged:
            return Merged(table.count_up(base, writer, batch_id), 0, 0, 0)
        if spec.full_row:
            own = base + 1  # a repeated write finds its own folder, and replaces it
            before = table.read_parts().filter(F.col(PART) != own).drop(PART)
            inserted = _written(table, new_rows(before, batch).withColumn(PART, F.lit(own).cast("bigint")))
            return Merged(table.count_up(base, writer, batch_id), staged, inserted, 0)
        keys = list(spec.keys)
        if validate:
            require_unique(batch, keys, f"batch of {spec.name}")
        touched = [r[0] for r in batch.select(table.part_of()).distinct().collect()]  # as many as there are buckets
        target = table.read_parts(touched)
        held = target.count()
        stayed = _written(table, upsert(target, batch.select("*", table.part_of()), keys, validate=False)) - staged
        updated = held - stayed
        return Merged(table.count_up(base, writer, batch_id), staged, staged - updated, updated)


def _written(table: MergedTable, rows: DataFrame, dealt: bool = False) -> int:
    """Write ``rows``, dealt by folder before or now, and return their number, observed in the write's last stage."""
    seen = Observation()
    dealt_rows = rows if dealt else rows.hint("rebalance", PART)
    table.write_parts(dealt_rows.observe(seen, F.count("*").alias("rows")))
    return seen.get["rows"]


def merge_reports(spark: SparkSession, merged: dict[str, Merged]) -> DataFrame:
    """Merges as rows: table_name, rows_staged, rows_inserted, rows_updated, rows_merged."""
    return spark.createDataFrame(
        [(name, m.staged, m.inserted, m.updated, m.inserted + m.updated) for name, m in merged.items()],
        "table_name string, rows_staged long, rows_inserted long, rows_updated long, rows_merged long")
