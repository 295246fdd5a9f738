import time

import pytest

from mercato.schemas import TABLES
from mercato.sources.tables import MergedTable
from mercato.streaming.ingest import batch_completeness, expected_tables, load_log, stream_landing, stream_upsert

SPEC = TABLES["sellers"]
HEADER = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"


def _land(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(HEADER + "".join(line + "\n" for line in lines))
    time.sleep(1.1)  # file times order the arrivals


def _table(spark, tmp_path):
    return MergedTable(spark, str(tmp_path / "raw_sellers"), SPEC, buckets=4)


@pytest.mark.parametrize("files_per_trigger,versions", [(1, 3), (None, 1)])
def test_files_merge_in_arrival_order(spark, tmp_path, rows, files_per_trigger, versions):
    landing, table = tmp_path / "landing", _table(spark, tmp_path)
    _land(landing, "z.csv", "s1,1,old,A", "s2,2,stay,B")
    _land(landing, "m.csv", "s1,1,newer,A", "s3,3,x,C")
    _land(landing, "a.csv", "s1,1,newest,A")
    version = stream_upsert(table, str(landing), str(tmp_path / "ck"), files_per_trigger)
    assert version == versions
    assert rows(table.read(), "seller_id", "seller_city") == [("s1", "newest"), ("s2", "stay"), ("s3", "x")]


@pytest.mark.parametrize("files_per_trigger", [1, None])
def test_full_rows_match_across_files_but_not_inside_one(spark, tmp_path, rows, files_per_trigger):
    spec = TABLES["geolocation_raw"]
    header = ",".join(spec.columns) + "\n"
    landing = tmp_path / "landing"
    landing.mkdir()
    for name, lines in [("b.csv", ["1,0.5,0.5,c,S"] * 2 + ["2,0.5,0.5,c,S"]),
                        ("a.csv", ["1,0.5,0.5,c,S"] * 3 + ["3,0.5,0.5,c,S"] * 2)]:
        (landing / name).write_text(header + "".join(line + "\n" for line in lines))
        time.sleep(1.1)
    table = MergedTable(spark, str(tmp_path / "raw_geo"), spec, buckets=4)
    stream_upsert(table, str(landing), str(tmp_path / "ck"), files_per_trigger)
    assert rows(table.read(), "geolocation_zip_code_prefix") == [(1,), (1,), (2,), (3,), (3,)]


def test_key_repeated_inside_one_file_raises(spark, tmp_path):
    landing, table = tmp_path / "landing", _table(spark, tmp_path)
    _land(landing, "one.csv", "s1,1,x,A", "s1,2,y,B")
    with pytest.raises(Exception, match="repeated key"):
        stream_upsert(table, str(landing), str(tmp_path / "ck"))
    assert table.version == 0


def test_text_with_newlines_streams(spark, tmp_path, rows):
    spec = TABLES["order_reviews"]
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "r.csv").write_bytes(
        b"\xef\xbb\xbf" + ",".join(spec.columns).encode()
        + b'\nr1,o1,5,,"two\nlines",2018-01-01 00:00:00,2018-01-02 00:00:00\n')
    table = MergedTable(spark, str(tmp_path / "raw_reviews"), spec, buckets=4)
    stream_upsert(table, str(landing), str(tmp_path / "ck"))
    assert rows(table.read(), "review_comment_title", "review_comment_message") == [(None, "two\nlines")]


def test_a_second_run_loads_only_new_files(spark, tmp_path, rows):
    landing, table = tmp_path / "landing", _table(spark, tmp_path)
    run = lambda: stream_upsert(table, str(landing), str(tmp_path / "ck"))
    _land(landing, "one.csv", "s1,1,x,A")
    assert run() == 1
    assert run() == 1
    _land(landing, "two.csv", "s2,2,y,B")
    assert run() == 2
    assert rows(table.read(), "seller_id") == [("s1",), ("s2",)]


def test_lost_progress_reloads_without_harm(spark, tmp_path, rows):
    """At-least-once delivery: every file again under a new checkpoint gives the same rows."""
    landing, table = tmp_path / "landing", _table(spark, tmp_path)
    _land(landing, "one.csv", "s1,1,x,A", "s2,2,y,B")
    stream_upsert(table, str(landing), str(tmp_path / "ck1"))
    before = rows(table.read())
    stream_upsert(table, str(landing), str(tmp_path / "ck2"))
    assert rows(table.read()) == before


def test_completeness(spark, rows):
    expected = spark.createDataFrame([("a",), ("b",)], "table_name string")
    log = spark.createDataFrame([("a",), ("a",), ("other",)], "table_name string")
    assert rows(batch_completeness(expected, log)) == [("a", True, 1, 2, False), ("b", False, 1, 2, False)]
    both = spark.createDataFrame([("a",), ("b",)], "table_name string")
    assert all(r["is_complete"] for r in batch_completeness(expected, both).collect())


def test_one_landing_folder_for_all_tables(spark, tmp_path, rows):
    landing = tmp_path / "landing"
    _land(landing, "sellers.csv", "s1,1,x,A")
    _land(landing, "acme_sellers_dataset.csv", "s2,2,y,B")
    _land(landing, "top_sellers.csv", "s9,9,z,C")
    header = ",".join(TABLES["customers"].columns) + "\n"
    (landing / "customers.csv").write_text(header + 'c1,u1,1,"two\nlines",A\n')
    tables = {n: MergedTable(spark, str(tmp_path / n), TABLES[n], buckets=4) for n in ("sellers", "customers")}
    log = load_log(spark, str(tmp_path / "log"))

    def run():
        return stream_landing(spark, str(landing), tables, str(tmp_path / "ck"), log, prefix="acme_")

    assert run() == {"sellers": 1, "customers": 1}
    assert rows(tables["sellers"].read(), "seller_id") == [("s1",), ("s2",)]
    assert rows(tables["customers"].read(), "customer_city") == [("two\nlines",)]
    assert rows(log.read()) == [("customers", 1, 1, 0, 1), ("sellers", 2, 2, 0, 2)]
    assert {r["table_name"] for r in batch_completeness(expected_tables(spark), log.read()).filter("is_loaded").collect()} == set(tables)

    _land(landing, "sellers_dataset.csv", "s2,3,y,B", "s3,1,z,C")
    assert run() == {"sellers": 2, "customers": 1} and run() == {"sellers": 2, "customers": 1}
    assert rows(tables["sellers"].read(), "seller_id", "seller_zip_code_prefix") == [("s1", 1), ("s2", 3), ("s3", 1)]
    assert rows(log.read()) == [("customers", 1, 1, 0, 1), ("sellers", 2, 1, 1, 2), ("sellers", 2, 2, 0, 2)]
    # one stream lists the folder for all tables
    assert len(list((tmp_path / "ck" / "sources").iterdir())) == 1


def test_a_landing_batch_that_failed_is_repeated(spark, tmp_path, rows):
    landing = tmp_path / "landing"
    _land(landing, "sellers.csv", "s1,1,x,A")
    (landing / "customers.csv").write_text(",".join(TABLES["customers"].columns) + "\nc1,u1,1,x,A\nc1,u1,1,y,A\n")  # a key twice
    tables = {n: MergedTable(spark, str(tmp_path / n), TABLES[n], buckets=4) for n in ("sellers", "customers")}
    log = load_log(spark, str(tmp_path / "log"))
    with pytest.raises(Exception, match="repeated key"):
        stream_landing(spark, str(landing), tables, str(tmp_path / "ck"), log)
    assert log.read().count() == 0 and tables["customers"].version == 0
    (landing / "customers.csv").write_text(",".join(TABLES["customers"].columns) + "\nc1,u1,1,x,A\n")
    assert stream_landing(spark, str(landing), tables, str(tmp_path / "ck"), log) == {"sellers": 1, "customers": 1}
    assert {r["table_name"] for r in log.read().collect()} == {"sellers", "customers"}


def test_a_table_lands_in_more_files_the_more_rows_it_has(spark, monkeypatch, rows):
    """A file is read by one task, so no file may grow with its table."""
    from workload import queries

    names = []

    def seen(spark, folder, *args, **options):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        listed = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
        names.append(sorted(s.getPath().getName() for s in listed))
        return stream_landing(spark, folder, *args, **options)

    monkeypatch.setattr(queries.ingest, "stream_landing", seen)
    run = queries.all_queries()["landing_routed"]
    plain = rows(run(spark, "/root/testdata/sf0.001"))
    monkeypatch.setattr(queries, "FILE_ROWS", 500)
    assert rows(run(spark, "/root/testdata/sf0.001")) == plain
    one, several = ([n for n in names[i] if n.startswith("acme_order_items_dataset")] for i in (0, 2))
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    assert one == ["acme_order_items_dataset.csv"] and len(several) == -(-lines // 500)


def _items(spark, n, price):
    spec = TABLES["order_items"]
    return spark.range(n).selectExpr(
        "concat('o', id) AS order_id", "id % 3 AS order_item_id", "'p' AS product_id", "'s' AS seller_id",
        "timestamp_ntz'2018-01-01 00:00:00' AS shipping_limit_date", f"CAST({price} AS DECIMAL(28,9)) AS price",
        "CAST(1 AS DECIMAL(28,9)) AS freight_value").select(*spec.columns)


def test_arrived_rows_are_sent_once(spark):
    from pyspark.sql import functions as F

    from mercato.streaming import ingest

    spec = TABLES["order_items"]
    rows = _items(spark, 10, 1).withColumn(ingest.ARRIVED, F.struct(F.lit(1).alias("at"), F.lit("f").alias("file")))
    table = MergedTable(spark, "/nowhere", spec, buckets=4)
    for collapsed in (ingest.collapse_files(rows, spec), ingest.collapse_files(table.dealt(rows, 3), spec, (ingest.PIECE,))):
        plan = collapsed._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1


def test_first_rows_of_a_landed_table_are_written_once(spark, tmp_path, rows, monkeypatch):
    """Nothing is kept beside the table, and each row is in the folder that later merges look for it in."""
    from mercato.session import Scratch
    from mercato.streaming import ingest

    spec, landing = TABLES["order_items"], tmp_path / "landing"
    landing.mkdir()

    def land(df, name):
        df.toPandas().to_csv(landing / name, index=False)
        time.sleep(1.1)

    land(_items(spark, 300, 1), "order_items-00000.csv.gz")
    land(_items(spark, 200, 2), "order_items-00001.csv.gz")
    table = MergedTable(spark, str(tmp_path / "items"), spec, buckets=4)
    log = load_log(spark, str(tmp_path / "log"))

    def run():
        return stream_landing(spark, str(landing), {"order_items": table}, str(tmp_path / "ck"), log)

    with monkeypatch.context() as first:
        first.setattr(ingest, "PIECE_BYTES", 100)  # several pieces of each folder
        first.setattr(Scratch, "materialise", lambda *_: 1 / 0)
        assert run() == {"order_items": 1}
    parts = table.read_parts()
    assert parts.filter(parts["_part"] != table.part_of()).isEmpty() and parts.select("_part").distinct().count() == 4
    prices = rows(table.read().groupBy("price").count())
    assert [(int(p), n) for p, n in prices] == [(1, 100), (2, 200)]
    land(_items(spark, 400, 3), "order_items.csv")
    assert run() == {"order_items": 2}
    assert rows(table.read().groupBy().agg({"price": "min", "*": "count"})) == [(3, 400)]
    assert rows(log.read()) == [("order_items", 300, 300, 0, 300), ("order_items", 400, 100, 300, 400)]


def test_a_first_landing_that_failed_leaves_no_row(spark, tmp_path, rows):
    landing, table = tmp_path / "landing", _table(spark, tmp_path)
    log = load_log(spark, str(tmp_path / "log"))
    _land(landing, "sellers-00001.csv", *[f"s{i},1,x,A" for i in range(50)])
    _land(landing, "sellers-00002.csv", "s1,1,x,A", "s1,2,y,B")
    with pytest.raises(Exception, match="repeated key"):
        stream_landing(spark, str(landing), {"sellers": table}, str(tmp_path / "ck"), log)
    assert table.version == 0 and table.read().count() == 0
    (landing / "sellers-00002.csv").write_text(HEADER + "s1,2,y,B\n")
    assert stream_landing(spark, str(landing), {"sellers": table}, str(tmp_path / "ck"), log) == {"sellers": 1}
    assert table.read().count() == 50 and rows(table.read().filter("seller_id = 's1'")) == [("s1", 2, "y", "B")]


def test_several_files_of_a_table_land_compressed(spark, tmp_path, small, monkeypatch):
    from workload import queries

    monkeypatch.setattr(queries, "FILE_ROWS", 300)
    m, spec = small(spark), TABLES["order_items"]
    queries._land_as(m, _items(spark, 1000, 1), str(tmp_path / "files"), "order_items.csv", spec.merge_keys)
    queries._land_as(m, _items(spark, 200, 1), str(tmp_path / "files"), "orders.csv", spec.merge_keys)
    names = sorted(p.name for p in (tmp_path / "files").iterdir() if not p.name.startswith("."))
    assert names == [f"order_items-{i:05d}.csv.gz" for i in range(4)] + ["orders.csv"]
    assert spark.read.option("header", "true").csv(str(tmp_path / "files" / "order_items-*")).count() == 1000


def test_shuffles_end_with_what_made_them(spark, tmp_path):
    from mercato.session import short_shuffles

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in files.split("\n") if "shuffle_" in f}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffled(), spark.conf.get(key, None)
    with short_shuffles(spark):
        spark.range(1000).repartition(7, "id").write.parquet(str(tmp_path / "short"))
        assert not shuffled() - before
    assert spark.conf.get(key, None) == setting and spark.read.parquet(str(tmp_path / "short")).count() == 1000
