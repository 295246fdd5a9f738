from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.schemas import TABLES, TableSpec, spec_for_file
from mercato.session import materialise, shared_root
from mercato.sources.files import coerce_types, read_table, with_audit
from mercato.operators.history import snapshot_check
from mercato.plans.build import snapshot_run
from mercato.sources.tables import HistoryTable, PartedTable, VersionedTable, append_rows, append_tables, register_views, write_mart

PAIR = TableSpec("pair", "pair", T.StructType([
    T.StructField("a", T.LongType(), False), T.StructField("b", T.StringType(), True)]), ("a",))


def test_bom_and_quoted_newline(spark, tmp_path, rows):
    path = tmp_path / "pair.csv"
    path.write_bytes(b'\xef\xbb\xbfa,b\n1,"x\ny"\n2,z\n3,"say ""hi"", twice"\n')
    df = read_table(spark, PAIR, str(path))
    assert df.columns == ["a", "b"]
    assert rows(df) == [(1, "x\ny"), (2, "z"), (3, 'say "hi", twice')]


def test_bad_row_fails_the_load(spark, tmp_path):
    path = tmp_path / "pair.csv"
    path.write_text("a,b\n1,x\nnot-a-number,y\n")
    with pytest.raises(Exception, match="FAILFAST"):
        read_table(spark, PAIR, str(path)).collect()


def test_required_null_fails_the_load(spark, tmp_path):
    path = tmp_path / "pair.csv"
    path.write_text("a,b\n1,\n,y\n")
    with pytest.raises(Exception, match="pair.a is required"):
        read_table(spark, PAIR, str(path)).collect()


def test_typed_orders_csv(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text(
        ",".join(TABLES["orders"].columns)
        + "\no1,c1,delivered,2017-10-02 10:56:33,2017-10-02 11:07:15,,2017-10-10 21:25:13,2017-10-18 00:00:00\n")
    row = read_table(spark, TABLES["orders"], str(path)).collect()[0]
    assert row["order_purchase_timestamp"] == datetime(2017, 10, 2, 10, 56, 33)
    assert row["order_delivered_carrier_date"] is None


@pytest.mark.parametrize("file,table", [
    ("landing/orders.csv", "orders"), ("acme_order_items_dataset.csv", "order_items"), ("sellers_dataset.csv", "sellers"),
    ("acme_geolocation_dataset.csv", "geolocation_raw"), ("acme_orders.csv", "orders"), ("cancelled_orders.csv", None),
    ("top_sellers.csv", None), ("backup_customers_dataset.csv", None), ("order_reviews.csv", "order_reviews"),
    ("product_category_name_translation.csv", "category_translation"), ("notes.csv", None), ("orders.txt", None),
])
def test_registry_by_file(file, table):
    spec = spec_for_file(file, prefix="acme_")
    assert (spec.name if spec else None) == table


@pytest.mark.parametrize("file,table", [
    ("acme_order_items_dataset-00003.csv", "order_items"), ("orders-123456.csv", "orders"), ("orders-2024.csv", None),
    ("orders_00001.csv", None), ("cancelled_orders-00001.csv", None)])
def test_numbered_files_belong_to_their_table(file, table):
    spec = spec_for_file(file, prefix="acme_")
    assert (spec.name if spec else None) == table


@pytest.mark.parametrize("file,table", [
    ("acme_order_items_dataset-00003.csv.gz", "order_items"), ("orders-123456.csv.gz", "orders"), ("orders.csv.gz", None),
    ("cancelled_orders-00001.csv.gz", None), ("orders-00001.gz", None), ("orders-00001.csv.gz.tmp", None)])
def test_numbered_files_may_be_compressed(file, table):
    spec = spec_for_file(file, prefix="acme_")
    assert (spec.name if spec else None) == table


def test_registry_covers_nine_tables():
    assert len(TABLES) == 9
    assert TABLES["geolocation_raw"].full_row and TABLES["geolocation_raw"].merge_keys == TABLES["geolocation_raw"].columns
    assert all(spec.keys or spec.full_row for spec in TABLES.values())


def test_coerce_types(spark, rows):
    df = spark.createDataFrame(
        [("2017-01-02 03:04:05", "40.0"), ("soon", "n/a"), (None, "7"), ("2017-01-02", "1.5")], "ts string, n string")
    assert rows(coerce_types(df, ["ts"], ["n"])) == [
        (None, 7), (None, None), (datetime(2017, 1, 2), None), (datetime(2017, 1, 2, 3, 4, 5), 40)]


def test_audit_columns(spark):
    row = with_audit(spark.range(1), "orders.csv", datetime(2024, 5, 6, 7, 8)).collect()[0]
    assert (row["_source_file"], row["_loaded_at"]) == ("orders.csv", datetime(2024, 5, 6, 7, 8))


def test_versioned_table(spark, tmp_path, rows):
    schema = T.StructType([T.StructField("id", T.LongType())])
    table = VersionedTable(spark, str(tmp_path / "t"), schema)
    assert table.version == 0 and table.read().count() == 0
    assert table.publish(spark.range(2)) == 1
    opened = table.read()
    # reading and rewriting the same table is safe: a new folder, then the switch
    assert table.publish(table.read().unionByName(spark.range(5, 6))) == 2
    assert rows(opened) == [(0,), (1,)]
    assert rows(table.read()) == [(0,), (1,), (5,)]
    again = VersionedTable(spark, str(tmp_path / "t"), schema)
    assert again.version == 2


def test_replayed_batch_is_skipped(spark, tmp_path, rows):
    table = VersionedTable(spark, str(tmp_path / "t"), T.StructType([T.StructField("id", T.LongType())]))
    assert table.publish(spark.range(1), "stream", 0) == 1
    assert table.publish(spark.range(9), "stream", 0) == 1
    assert table.publish(spark.range(3)) == 2
    assert table.applied("stream") == 0
    assert table.publish(spark.range(9), "stream", 0) == 2
    assert rows(table.read()) == [(0,), (1,), (2,)]


def test_concurrent_writer_loses(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), T.StructType([T.StructField("id", T.LongType())]))
    staged = table.stage(spark.range(1))
    table.publish(spark.range(2))
    with pytest.raises(RuntimeError, match="moved to version 1"):
        table.switch(staged, 0)
    assert table.read().count() == 2


def test_clustered_mart_is_sorted_by_file(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 7).alias("day"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = write_mart(df, str(tmp_path), "m", cluster_by=["day", "id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spans = (
        table.read().groupBy(F.input_file_name()).agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
        .orderBy("lo", "hi").collect()
    )
    assert len(spans) > 1
    assert all(a["hi"] <= b["lo"] for a, b in zip(spans, spans[1:]))


def test_append_doubles_and_views(spark, tmp_path):
    for _ in range(2):
        append_rows(spark.range(3), str(tmp_path / "a"))
    df = spark.read.parquet(str(tmp_path / "a"))
    assert df.count() == 6
    register_views("stg", {"numbers": df})
    assert spark.table("stg_numbers").count() == 6


def test_materialise_uses_the_shared_folder(spark):
    df = materialise(spark.range(3), "probe")
    assert all(shared_root(spark).split(":")[-1] in f for f in df.inputFiles())


def test_parents_load_first(spark, tmp_path, small):
    m = small(spark)
    order = append_tables({t: m.raw[t] for t in ("order_items", "orders", "customers", "sellers", "products")}, str(tmp_path))
    assert order == ["customers", "sellers", "products", "orders", "order_items"]
    assert spark.read.parquet(str(tmp_path / "orders")).count() == 1500


def test_shared_folder_must_be_named(spark, monkeypatch):
    from mercato import session

    class Unset:
        class conf:  # noqa: N801
            get = staticmethod(lambda name, default: default)

    monkeypatch.setattr(session, "_root_where_unset", None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(Unset)


def test_scratch_is_deleted(spark):
    import os

    from mercato.session import Scratch

    with Scratch(spark) as scratch:
        kept = scratch.materialise(spark.range(3), "probe")
        folder = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert kept.count() == 3 and os.path.exists(folder)
    assert not os.path.exists(folder)


def _written(folder):
    return {p: (p.stat().st_mtime_ns, p.stat().st_size) for p in folder.rglob("part-*.parquet")}


def test_parted_table_replaces_only_the_folders_it_has_rows_for(spark, tmp_path, rows):
    table = PartedTable(spark, str(tmp_path / "t"), T.StructType([T.StructField("id", T.LongType())]))
    assert table.read().count() == 0
    table.write_parts(spark.range(10).withColumn("_part", F.col("id") % 3))
    before = _written(tmp_path)
    table.write_parts(spark.range(100, 102).withColumn("_part", F.lit(1).cast("bigint")))
    after = _written(tmp_path)
    assert {p for p in before if "_part=1" not in str(p)} <= set(after) and all(after[p] == before[p] for p in set(before) & set(after))
    assert rows(table.read()) == sorted([(i,) for i in (0, 2, 3, 5, 6, 8, 9, 100, 101)], key=str)
    assert rows(table.read_parts([1]), "id") == [(100,), (101,)]


HISTORY = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("city", T.StringType()),
    T.StructField("valid_from", T.TimestampNTZType()), T.StructField("valid_to", T.TimestampNTZType())])


def _run(spark, table, day, moved):
    src = spark.range(1000).select("id", F.when(F.col("id") < moved, f"day {day}").otherwise("home").alias("city"))
    return snapshot_run(table, src, "id", ["city"], datetime(2024, 1, day))


def test_history_writes_follow_the_changes(spark, tmp_path):
    """Closed versions are written once, however many runs follow; the same rows as one comparison after the other."""
    table = HistoryTable(spark, str(tmp_path / "h"), HISTORY)
    known = None
    for day, moved in ((1, 0), (2, 400), (3, 10), (4, 10)):
        before = _written(tmp_path / "h" / "closed")
        assert _run(spark, table, day, moved) == day
        after = _written(tmp_path / "h" / "closed")
        assert before.items() <= after.items()
        src = spark.range(1000).select("id", F.when(F.col("id") < moved, f"day {day}").otherwise("home").alias("city"))
        known = snapshot_check(known, src, "id", ["city"], datetime(2024, 1, day))
        known = materialise(known, "known")
        assert sorted(map(str, table.read().collect())) == sorted(map(str, known.collect()))
        fresh = sum(spark.read.parquet(str(p)).count() for p in set(after) - set(before))
        assert fresh == known.filter(F.col("valid_to") == F.lit(datetime(2024, 1, day)).cast("timestamp_ntz")).count()
    assert _run(spark, table, 4, 500) == 4  # a replay changes nothing


def test_a_run_that_failed_midway_is_not_seen_and_is_repeated(spark, tmp_path, monkeypatch):
    table = HistoryTable(spark, str(tmp_path / "h"), HISTORY)
    _run(spark, table, 1, 0)
    before = sorted(map(str, table.read().collect()))
    with monkeypatch.context() as broken:
        broken.setattr(table.open, "publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            _run(spark, table, 2, 300)
    assert sorted(map(str, table.read().collect())) == before
    _run(spark, table, 2, 300)
    assert table.read().count() == 1300 and table.read().filter("valid_to IS NULL").count() == 1000


def test_csv_roundtrip_finds_what_differs(spark, monkeypatch):
    """Rows meet by digests, so no row's values are sent; a row lost, doubled or changed shows."""
    from workload import queries

    run, read = queries.all_queries()["csv_roundtrip"], queries.read_table
    plan = run(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_d1" in plan and "hashpartitioning(order" not in plan

    def spoiled(spark, spec, path):
        df = read(spark, spec, path)
        if spec.name == "sellers":
            df = df.filter("seller_id <> '1'").unionByName(df.filter("seller_id = '2'"))
        if spec.name == "orders":
            status = F.when(F.col("order_id") == df.agg(F.min("order_id")).collect()[0][0], F.lit(None)).otherwise(F.col("order_status"))
            df = df.withColumn("order_status", status)
        return df

    monkeypatch.setattr(queries, "read_table", spoiled)
    found = {r["table_name"]: (r["rows"], r["differ"]) for r in run(spark, "/root/testdata/sf0.001").collect()}
    assert found["sellers"][1] == 2 and found["orders"][1] == 2 and {n for n, (_, d) in found.items() if d} == {"sellers", "orders"}
