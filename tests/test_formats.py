import datetime
import json
import os
import re
import subprocess
import sys
from types import SimpleNamespace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidewell import avro
from tidewell.errors import BadInputError, ConcurrencyError, IoError, SourceError, TableFormatError, UnsupportedTypeError
from tidewell.operators.delta import open_delta, read_delta, write_delta
from tidewell.operators.iceberg import HINT, current_version, open_iceberg, read_iceberg, with_retries, write_iceberg
from tidewell.operators import layout
from tidewell.operators.layout import write_layout
from tidewell.plans import queries
from tidewell.plans.cli import parser, source_of
from tidewell.plans.fixture import t1
from tidewell.plans.loader import load
from tidewell.sources.rowsets import JdbcSource, ParquetSource, SqlSource, arrow_batches, described, jdbc_options, spark_dialect, strict_types
from tidewell.storage import Store, check_url, env_options, hadoop_settings, scratch_url, table_name


def files(spark, url):
    return [e.path for e in Store(spark, url).files(hidden=True)]


# --- layout


@pytest.mark.parametrize(("rows", "sizes"), [(0, [0]), (100, [100]), (200, [100, 100]), (250, [100, 100, 50])])
def test_exact_rollover(spark, url, rows, sizes):
    found = write_layout(spark.range(0, rows, 1, 1), Store(spark, url), "", "exact", 100, 40)
    assert [f.rows for f in found] == sizes
    assert all(n <= 40 for f in found for n in f.groups)
    assert files(spark, url) == [f.path for f in found]


def test_parallel_layout_caps_files(spark, url):
    found = write_layout(spark.range(0, 1000, 1, 4), Store(spark, url), "data", "parallel", 100)
    assert sum(f.rows for f in found) == 1000
    assert max(f.rows for f in found) <= 100
    assert len(found) == 12


def test_many_and_long_footers(spark, url, monkeypatch):
    monkeypatch.setattr(layout, "TAIL_BYTES", 16)
    found = write_layout(spark.range(0, 80, 1, 40), Store(spark, url), "")
    assert [f.columns["id"]["least"] for f in found] == list(range(0, 80, 2))


def test_layout_refuses_names_that_occur_twice(spark, url):
    with pytest.raises(BadInputError):
        write_layout(spark.range(3).select("id", F.col("id").alias("ID")), Store(spark, url), "", "p-{number}")
    assert files(spark, url) == []


# --- Delta


def test_delta_create(spark, url):
    done = write_delta(t1(spark, 100).orderBy("id"), url, layout="exact")
    assert not done.skipped
    names = files(spark, url)
    assert names[:2] == ["_delta_log/00000000000000000000.json", "_delta_log/00000000000000000001.json"]
    assert len(names) == 3
    assert re.fullmatch(r"load-[0-9a-f-]{36}/part-00000-[0-9a-f-]{36}-c000\.snappy\.parquet", names[2])
    table = open_delta(spark, url)
    assert table.version == 1
    assert table.meta["name"] == "table"
    assert table.read().count() == 101
    assert table.read().exceptAll(t1(spark, 100)).count() == 0
    assert open_delta(spark, url, 0).adds == {}


def test_delta_protocol_follows_the_types(spark, url, tmp_path):
    write_delta(t1(spark, 3), url)
    first = Store(spark, url).read("_delta_log/00000000000000000000.json").decode()
    assert '"readerFeatures":["timestampNtz"]' in first
    other = f"file://{tmp_path}/plain"
    write_delta(spark.range(3), other)
    assert '"minReaderVersion":1,"minWriterVersion":1' in Store(spark, other).read("_delta_log/00000000000000000000.json").decode()


def test_delta_stats(spark, url):
    write_delta(t1(spark, 50).withColumn("long", F.repeat(F.lit("x"), 100)).withColumn("nan", F.lit(float("nan"))), url, layout="exact")
    found = json.loads(next(iter(open_delta(spark, url).adds.values()))["stats"])
    assert found["numRecords"] == 51
    assert (found["minValues"]["id"], found["maxValues"]["id"]) == (1, 51)
    assert found["nullCount"]["ctext"] == 1
    assert found["minValues"]["cdate"] == "2024-01-02"
    assert found["minValues"]["ctimestamp"] == "2024-01-01T00:00:01.000"
    assert found["minValues"]["ctimestamptz"] == "2024-01-01T00:00:01.000Z"
    assert found["minValues"]["cnumeric"] == -99999.999
    assert found["minValues"]["long"] == "x" * 32
    assert found["maxValues"]["long"] > "x" * 100
    assert "nan" not in found["minValues"]


def test_delta_skips_what_is_there(spark, url):
    write_delta(spark.range(3), url)
    before = files(spark, url)
    assert write_delta(spark.range(9), url).skipped
    assert files(spark, url) == before


def test_delta_skips_any_foreign_file(spark, url):
    Store(spark, url).write("notes.txt", b"x")
    assert write_delta(spark.range(9), url).skipped
    assert files(spark, url) == ["notes.txt"]


def test_delta_overwrite_clears_all(spark, url):
    write_delta(spark.range(3), url)
    Store(spark, url).write("deep/notes.txt", b"x")
    write_delta(spark.range(7), url, overwrite=True)
    assert read_delta(spark, url).count() == 7
    assert len([f for f in files(spark, url) if f.startswith("_delta_log")]) == 2
    assert "deep/notes.txt" not in files(spark, url)


def test_delta_keeps_the_old_table_when_rows_fail(spark, url):
    write_delta(spark.range(3), url)
    with pytest.raises(SourceError):
        write_delta(spark.range(3).select(F.raise_error(F.lit("bad")).cast("long").alias("id")), url, overwrite=True)
    assert read_delta(spark, url).count() == 3
    with pytest.raises(UnsupportedTypeError):
        write_delta(spark.sql("select null as a"), url, overwrite=True)
    assert read_delta(spark, url).count() == 3
    assert len({f.split("/")[0] for f in files(spark, url) if f.startswith("load-")}) == 1


def test_delta_nested_and_empty(spark, url):
    rows = spark.createDataFrame([([1, 2], {"a": 1.5}, (1, "x"))], "l array<int>, m map<string,double>, s struct<p: int, q: string>")
    write_delta(rows, url)
    assert read_delta(spark, url).collect() == rows.collect()
    write_delta(rows.limit(0), url, overwrite=True)
    assert read_delta(spark, url).count() == 0
    assert len(open_delta(spark, url).adds) == 1


def test_delta_reader_errors(spark, url):
    with pytest.raises(IoError):
        open_delta(spark, url)
    write_delta(spark.range(3), url)
    with pytest.raises(IoError):
        open_delta(spark, url, 7)
    os.unlink(f"{url[7:]}/_delta_log/00000000000000000000.json")
    with pytest.raises(TableFormatError):
        open_delta(spark, url)


# --- Iceberg


def rowset(spark, n=5):
    return spark.range(n).select(F.col("id").cast("int").alias("a"), F.col("id").alias("b"), F.col("id").cast("string").alias("c"), (F.col("id") > 2).alias("d"))


def test_iceberg_life(spark, url):
    write_iceberg(rowset(spark), url, layout="exact")
    first = files(spark, url)
    assert len(first) == 5
    assert [f for f in first if re.fullmatch(r"data/load-[0-9a-f-]{36}/part-00000-[0-9a-f-]{36}-c000\.parquet", f)]
    assert "metadata/v0.metadata.json" in first
    with pytest.raises(IoError, match="pass overwrite"):
        write_iceberg(rowset(spark), url)
    with pytest.raises(BadInputError):
        write_iceberg(rowset(spark).withColumn("b", F.col("b").cast("string")), url, overwrite=True)
    assert files(spark, url) == first
    write_iceberg(rowset(spark, 7).toDF("w", "x", "y", "z"), url, overwrite=True, layout="exact")
    assert len(files(spark, url)) == 9
    table = open_iceberg(spark, url)
    assert table.version == 1
    assert [s["sequence-number"] for s in table.snapshots()] == [1, 2]
    assert table.read().columns == ["a", "b", "c", "d"]
    assert table.read().count() == 7
    assert table.read(table.snapshots()[0]["snapshot-id"]).count() == 5
    assert [s["summary"]["operation"] for s in table.snapshots()] == ["append", "overwrite"]
    assert table.snapshots()[1]["parent-snapshot-id"] == table.snapshots()[0]["snapshot-id"]


@pytest.mark.parametrize("keys", [range(5000), [None] * 50, []])
def test_bounds_of_files_without_any(spark, tmp_path, keys):
    """A row group of several splits leaves the first one, and so the first data file, without rows."""
    rows = [(k, 1, "x" * (k or 0), 2.0) for k in keys]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderpriority string, o_totalprice double").coalesce(1).write.option("compression", "none").parquet(str(tmp_path / "orders.parquet"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        got = queries.iceberg_bounds(spark, str(tmp_path)).head()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    some = [k for k in keys if k is not None]
    assert tuple(got) == (len(keys), len(keys) - len(some), min(some, default=None), max(some, default=None))


def test_iceberg_append(spark, url):
    for n in (2, 3, 4):
        write_iceberg(rowset(spark, n), url, append=True)
    table = open_iceberg(spark, url)
    assert table.read().count() == 9
    assert table.snapshots()[-1]["summary"]["total-records"] == "9"
    assert [table.read(s["snapshot-id"]).count() for s in table.snapshots()] == [2, 5, 9]


def test_iceberg_flags(spark, url):
    with pytest.raises(BadInputError, match="overwrite and append exclude each other"):
        write_iceberg(rowset(spark), url, overwrite=True, append=True)
    with pytest.raises(BadInputError):
        write_iceberg(spark.range(1).select(F.col("id").cast("short").alias("a")), url)


def test_field_ids_are_in_the_files(spark, url):
    write_iceberg(rowset(spark), url, layout="exact")
    path = open_iceberg(spark, url).entries()[0]["data_file"]["file_path"]
    schema = pq.read_schema(path[7:])
    assert [f.metadata[b"PARQUET:field_id"] for f in schema] == [b"1", b"2", b"3", b"4"]


def test_required_columns_stay_required(spark, url, tmp_path):
    path = f"{tmp_path}/in.parquet"
    pq.write_table(pa.table({"a": [1, 2]}, pa.schema([pa.field("a", pa.int64(), False)])), path)
    load(spark, ParquetSource(path), url, "iceberg")
    assert open_iceberg(spark, url).meta["schemas"][0]["fields"][0]["required"]
    load(spark, ParquetSource(path), url, "iceberg", append=True)
    with pytest.raises(BadInputError, match="required"):
        load(spark, SqlSource("select cast(1 as bigint) as a"), url, "iceberg", append=True)


def test_a_lost_race_leaves_nothing_and_is_tried_again(spark, url):
    write_iceberg(rowset(spark), url)
    before = files(spark, url)
    rival = lambda: write_iceberg(rowset(spark, 1), url, append=True)
    with pytest.raises(ConcurrencyError):
        write_iceberg(rowset(spark, 2), url, append=True, before_commit=rival)
    assert len([f for f in files(spark, url) if f not in before and not f.startswith("data/")]) == 3  # the rival's
    assert read_iceberg(spark, url).count() == 6

    turns = iter([rival, rival, None])
    done = with_retries(lambda: write_iceberg(rowset(spark, 2), url, append=True, before_commit=next(turns)))
    assert done.version == 4
    assert read_iceberg(spark, url).count() == 10
    turns = iter([rival, rival, rival])
    with pytest.raises(ConcurrencyError):
        with_retries(lambda: write_iceberg(rowset(spark, 2), url, append=True, before_commit=next(turns)))


def test_a_hint_that_was_left_behind(spark, url):
    write_iceberg(rowset(spark), url)
    write_iceberg(rowset(spark), url, append=True)
    store = Store(spark, url)
    store.write(HINT, b"0\n")
    assert current_version(store) == 1
    write_iceberg(rowset(spark), url, append=True)
    assert read_iceberg(spark, url).count() == 15


def test_bad_metadata(spark, url):
    write_iceberg(rowset(spark), url)
    store = Store(spark, url)
    store.write("metadata/v0.metadata.json", b"{")
    with pytest.raises(TableFormatError):
        open_iceberg(spark, url)
    for bad in (b"x", b"-1", b""):
        store.write(HINT, bad)
        with pytest.raises(TableFormatError):
            open_iceberg(spark, url)


def test_avro_round_trip():
    schema = {"type": "record", "name": "r", "fields": [{"name": "a", "type": ["null", "long"]}, {"name": "b", "type": "string"}, {"name": "c", "type": {"type": "array", "items": "bytes"}}]}
    rows = [{"a": x, "b": "é" * k, "c": [b"\0", b""] * k} for k, x in enumerate((None, 0, -1, 5, 63, 64, -65, 5_000_000_000, -(1 << 63), (1 << 63) - 1))]
    back, meta = avro.read(avro.write(schema, rows, {"k": "v"}))
    assert back == rows
    assert meta["k"] == "v"
    assert avro.read(avro.write(schema, [], {}))[0] == []
    with pytest.raises(TableFormatError):
        avro.read(b"no")


def test_sparks_own_avro_reads_our_files(spark, tmp_path):
    schema = {"type": "record", "name": "r", "fields": [{"name": "a", "type": ["null", "long"], "default": None}]}
    path = f"{tmp_path}/x.avro"
    with open(path, "wb") as file:
        file.write(avro.write(schema, [{"a": None}, {"a": 5}], {}))
    jvm = spark._jvm
    reader = jvm.org.apache.avro.file.DataFileReader(jvm.java.io.File(path), jvm.org.apache.avro.generic.GenericDatumReader())
    assert [str(reader.next().get("a")), str(reader.next().get("a")), reader.hasNext()] == ["None", "5", False]


# --- sources, storage and the command line


def test_t1_in_batches(spark):
    found = list(arrow_batches(t1(spark).orderBy("id"), 10_000))
    assert [b.num_rows for b in found] == [10000, 10000, 5001]
    assert found[0].column(2)[:3].to_pylist() == [None, -127, -126]
    assert [str(x) for x in found[0].column("cnumeric")[:9].to_pylist()] == ["None", "0.000", "0.001", "-0.002", "3.000", "-4.000", "50.001", "99999.999", "-99999.999"]
    assert found[0].column("cbytea")[1:3].to_pylist() == [b"\0\0\0\1", b"\0\0\0\2"]


def test_sources_say_what_is_wrong(spark, tmp_path):
    with pytest.raises(IoError):
        ParquetSource(f"{tmp_path}/none.parquet").open(spark)
    bad = tmp_path / "bad.parquet"
    bad.write_bytes(b"not parquet")
    with pytest.raises(SourceError):
        ParquetSource(str(bad)).open(spark)
    with pytest.raises(SourceError):
        SqlSource("select from where").open(spark)
    with pytest.raises(UnsupportedTypeError):
        SqlSource("select array(1) as a").open(spark)
    with pytest.raises(BadInputError):
        SqlSource(" ").open(spark)
    with pytest.raises(SourceError):
        JdbcSource("postgres://u@localhost/db", "select 1").open(spark)


def test_dialect():
    assert spark_dialect("select a::text as text, 'x::text' from t") == "select a::string as text, 'x::text' from t"
    assert spark_dialect("select a::timestamp, b::timestamptz, c::numeric(8,3)") == "select a::timestamp_ntz, b::timestamp, c::decimal(8,3)"


def test_jdbc_options():
    found = jdbc_options("postgres://u%40x:p@h:1/db?sslmode=require", "select 1", 7, {"PGPASSWORD": "e"})
    assert found["url"] == "jdbc:postgresql://h:1/db?sslmode=require"
    assert (found["user"], found["password"], found["fetchsize"]) == ("u@x", "e", "7")
    assert jdbc_options("postgres://u:p@h/db", "q", env={})["password"] == "p"
    with pytest.raises(BadInputError):
        jdbc_options("mysql://h/db", "q")


def test_urls_and_environment(spark):
    assert check_url("file:///a/b//") == "file:///a/b"
    assert table_name("s3://bucket/a/b/") == "b"
    with pytest.raises(BadInputError):
        load(spark, SqlSource("select 1 as a"), "/no/scheme")
    env = {"AWS_ENDPOINT": "http://h", "GOOGLE_X": "g", "AZURE_Y": "a"}
    assert env_options("s3://b", env) == {"aws_endpoint": "http://h"}
    assert env_options("abfss://b", env) == {"azure_y": "a"}
    assert env_options("file:///b", env) == {}
    assert hadoop_settings(env_options("s3a://b", env))["fs.s3a.endpoint"] == "http://h"


def test_keys_of_all_schemes():
    google = env_options("gs://b/t", {"GOOGLE_APPLICATION_CREDENTIALS": "/key.json"})
    assert hadoop_settings(google) == {"fs.gs.auth.type": "SERVICE_ACCOUNT_JSON_KEYFILE", "fs.gs.auth.service.account.json.keyfile": "/key.json"}
    azure = {"AZURE_STORAGE_ACCOUNT_NAME": "acc", "AZURE_STORAGE_ACCOUNT_KEY": "k"}
    assert hadoop_settings(env_options("abfss://c@acc.dfs.core.windows.net/t", azure)) == {"fs.azure.account.key.acc.dfs.core.windows.net": "k"}
    oauth = {"AZURE_STORAGE_ACCOUNT_NAME": "acc", "AZURE_CLIENT_ID": "i", "AZURE_CLIENT_SECRET": "s", "AZURE_TENANT_ID": "t"}
    found = hadoop_settings(env_options("az://c/t", oauth))
    assert found["fs.azure.account.auth.type.acc.dfs.core.windows.net"] == "OAuth" and len(found) == 5
    assert hadoop_settings(env_options("az://c/t", {"AZURE_STORAGE_ACCOUNT_NAME": "a", "AZURE_STORAGE_SAS_TOKEN": "?x"}))["fs.azure.sas.fixed.token.a.dfs.core.windows.net"] == "x"


@pytest.mark.parametrize("table_format", ["delta", "iceberg"])
def test_targets_that_only_hadoop_knows(spark, tmp_path, table_format):
    (tmp_path / "in").mkdir()
    spark._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.{table_format}.link./lake", f"file://{tmp_path}/in")
    target = f"viewfs://{table_format}/lake/table"
    done = load(spark, SqlSource("select id, cast(id as string) as name from range(100)"), target, table_format)
    assert done.rows == 100
    rows = read_delta(spark, target) if table_format == "delta" else read_iceberg(spark, target)
    assert rows.agg(F.sum("id")).head()[0] == 4950
    rows.write.parquet(f"viewfs://{table_format}/lake/plain")
    assert ParquetSource(f"viewfs://{table_format}/lake/plain").open(spark).rows.count() == 100


def test_an_unclear_commit_keeps_its_files(spark, url, monkeypatch):
    write_iceberg(spark.range(3), url)
    plain = Store.create

    def lost(self, name, data):
        done = plain(self, name, data)
        if name.endswith(("v1.metadata.json", "1.json")):
            raise OSError("the answer was lost")
        return done

    def full(self, name, data):
        if name.endswith("1.json"):
            raise OSError("no space")
        return plain(self, name, data)

    monkeypatch.setattr(Store, "create", lost)
    write_iceberg(spark.range(5), url, append=True)
    assert read_iceberg(spark, url).count() == 8
    with pytest.raises(OSError):
        write_delta(spark.range(4), url + "-delta")
    assert read_delta(spark, url + "-delta").count() == 4
    monkeypatch.setattr(Store, "create", full)
    with pytest.raises(OSError):
        write_delta(spark.range(4), url + "-full")
    assert files(spark, url + "-full") == []


def test_views_of_the_session_come_back(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("own_view")
    rows = SqlSource("select count(*) as n from own_view join new_view using (id)", {"own_view": spark.range(9), "new_view": spark.range(7)}).open(spark).rows
    assert rows.head()[0] == 7
    assert spark.table("own_view").count() == 3 and not spark.catalog.tableExists("new_view")
    spark.catalog.dropTempView("own_view")


def test_a_shared_folder_is_needed_on_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: default)
    context = SimpleNamespace(getConf=lambda: SimpleNamespace(get=lambda key: None), master="spark://host:7077")
    session = SimpleNamespace(conf=spark.conf, sparkContext=context)
    with pytest.raises(BadInputError, match="checkpoint"):
        scratch_url(session, "x")
    context.master = "local[2]"
    assert scratch_url(session, "x").startswith("file:///")


@pytest.fixture(scope="module")
def database(spark):
    """An in-memory database with the fixture's first columns; its driver comes with Spark."""
    link = "jdbc:derby:memory:tidewell;create=true"
    jvm = spark._jvm
    connection = jvm.java.sql.DriverManager.getConnection(link, jvm.java.util.Properties())
    run = connection.createStatement().execute
    run("create table t1 (id bigint primary key, c2 smallint, c4 int, r real, d double, n decimal(8,3), t timestamp, day date, s varchar(20), b boolean, x varchar(4) for bit data)")
    for k in range(1, 41):
        run(f"insert into t1 values ({k}, {k}, {k}, {k}.5, {k}.5, {k}.001, timestamp('2024-01-01 00:00:{k:02d}'), date('2024-02-01'), 'row {k}', {str(k % 2 == 1).lower()}, X'000000{k:02x}')")
    run("insert into t1 (id) values (41)")
    connection.close()
    return link


@pytest.mark.parametrize("table_format", ["delta", "iceberg"])
def test_a_database_is_loaded(spark, database, url, table_format):
    source = JdbcSource(database, "select * from t1", 10, "ID", 4)
    query = "select cast(c4 as int) as C4, id as ID, n as N, t as T, day as DAY, s as S, b as B, x as X from t1"
    rows = source.open(spark).rows
    assert rows.rdd.getNumPartitions() == 4 and rows.count() == 41
    done = load(spark, JdbcSource(database, query, 10, "ID", 3), url, table_format)
    got = {r.ID: r for r in (read_delta(spark, url) if table_format == "delta" else read_iceberg(spark, url)).collect()}
    assert done.rows == len(got) == 41 and got[41].S is None
    assert (got[7].C4, str(got[7].N), got[7].S, got[7].B, bytes(got[7].X)) == (7, "7.001", "row 7", True, b"\0\0\0\x07")
    assert got[7]["T"] == datetime.datetime(2024, 1, 1, 0, 0, 7)
    with pytest.raises(SourceError):
        JdbcSource(database, "select nothing from nowhere").open(spark)


def test_a_database_describes_its_columns(spark, database):
    found = described(spark, {"url": database, "query": "select id, n, s from t1"})
    assert found == [("ID", "BIGINT", 19, 0), ("N", "DECIMAL", 8, 3), ("S", "VARCHAR", 20, 0)]


def test_types_of_a_database_are_strict():
    schema = strict_types([("a", "int4", 10, 0), ("b", "numeric", 8, 3), ("c", "char", 1, 0), ("d", "timestamptz", 35, 6)])
    assert schema.simpleString() == "struct<a:int,b:decimal(8,3),c:tinyint,d:timestamp>"
    for kind in (("u", "uuid", 0, 0), ("j", "json", 0, 0), ("n", "numeric", 0, 0), ("n", "numeric", 39, 0), ("t", "interval", 0, 0), ("a", "_int4", 10, 0)):
        with pytest.raises(UnsupportedTypeError):
            strict_types([kind])


def test_create_is_exclusive(spark, url):
    store = Store(spark, url)
    assert store.create("a/b", b"1")
    assert not store.create("a/b", b"2")
    assert store.read("a/b") == b"1"
    assert files(spark, url) == ["a/b"]


def test_parser():
    args = parser().parse_args(["pg-to-iceberg", "postgres://h/d", "file:///t", "-q", "select 1", "--append"])
    assert (args.command, args.append, args.overwrite, args.batch_size) == ("pg-to-iceberg", True, False, 10000)
    assert source_of(args) == JdbcSource("postgres://h/d", "select 1", 10000)
    args = parser().parse_args(["parquet-to-delta", "f.parquet", "file:///t", "-o"])
    assert args.overwrite
    for bad in (["pg-to-delta", "postgres://h/d", "file:///t"], ["parquet-to-delta", "f", "file:///t", "--append"], []):
        with pytest.raises(SystemExit):
            parser().parse_args(bad)


def test_load_rules(spark, url, tmp_path):
    with pytest.raises(BadInputError):
        load(spark, SqlSource("select 1 as a"), url, "delta", append=True)
    with pytest.raises(BadInputError):
        load(spark, SqlSource("select 1 as a"), url, "csv")
    done = load(spark, SqlSource("select * from v", {"v": spark.range(3)}), url)
    assert (done.rows, done.version, done.skipped) == (3, 1, False)
    assert load(spark, SqlSource("select 1 as a"), url).skipped


def test_the_library_does_without_the_text_operators():
    code = "import sys, pkgutil, importlib, tidewell\nfor p in ('', '.operators', '.sources', '.functions', '.plans', '.streaming'):\n    for m in pkgutil.iter_modules(importlib.import_module('tidewell' + p).__path__, 'tidewell' + p + '.'):\n        if not m.name.endswith(('.llm', '__main__')): importlib.import_module(m.name)\nassert not [m for m in sys.modules if m.startswith('tidewell.llm')]"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(__file__)))
