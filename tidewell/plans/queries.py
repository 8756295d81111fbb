"""Queries that exercise each part of the library, and the same rowsets in SQL.

A query that loads a table writes it to a folder of its own, reads it back from the log or metadata, and returns its rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.errors import LoadError
from tidewell.functions import decode
from tidewell.operators.delta import open_delta, read_delta, write_delta
from tidewell.operators.iceberg import open_iceberg, read_iceberg, write_iceberg, write_mode
from tidewell.operators.layout import write_layout
from tidewell.plans.fixture import t1
from tidewell.plans.loader import load
from tidewell.sources.rowsets import ParquetSource, SqlSource, batch_of
from tidewell.storage import Store, env_options, scratch_url
from tidewell.types import PG_TYPES, align, pg_type_to_spark

Query = Callable[[SparkSession, str], DataFrame]

SCALAR_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "benchmark", "labels", "conversations")


def _path(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"


def _views(sf_dir: str, *names: str) -> dict[str, str]:
    return {n: _path(sf_dir, n) for n in names}


def scan(name: str) -> Query:
    return lambda spark, sf_dir: ParquetSource(_path(sf_dir, name)).open(spark).rows


def parquet_to_delta(name: str, layout: str = "parallel") -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        url = scratch_url(spark, f"delta-{name}")
        load(spark, ParquetSource(_path(sf_dir, name)), url, layout=layout)
        return read_delta(spark, url)

    return run


def parquet_to_iceberg(name: str, layout: str = "parallel") -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        url = scratch_url(spark, f"iceberg-{name}")
        load(spark, ParquetSource(_path(sf_dir, name)), url, "iceberg", layout=layout)
        return read_iceberg(spark, url)

    return run


# Name, tables, text for Spark, and text for the oracle where the dialects differ.
SQL_LOADS: dict[str, tuple[tuple[str, ...], str, str | None]] = {
    "projection": (("orders",), "select o_orderkey, o_orderdate, o_totalprice from orders", None),
    "star_ordered": (("supplier",), "select * from supplier order by s_suppkey", None),
    "cast": (("orders",), "select o_orderkey, o_custkey::text as custkey_text, cast(o_totalprice as numeric(12,2)) as price from orders", "select o_orderkey, o_custkey::varchar as custkey_text, cast(o_totalprice as decimal(12,2)) as price from orders"),
    "arith_alias": (("lineitem",), "select l_orderkey + 1 l_orderkey, l_linenumber * 2 as twice, l_extendedprice * (1 - l_discount) as net from lineitem", None),
    "filter": (("lineitem",), "select l_orderkey, l_linenumber, l_quantity from lineitem where l_shipdate >= timestamp '1995-01-01 00:00:00' and l_discount between 0.05 and 0.07 and l_quantity < 24", None),
    "join": (("orders", "customer", "nation"), "select o.o_orderkey, c.c_name, n.n_name from orders o join customer c on o.o_custkey = c.c_custkey join nation n on c.c_nationkey = n.n_nationkey", None),
    "outer_join": (("customer", "orders"), "select c.c_custkey, o.o_orderkey from customer c left join orders o on o.o_custkey = c.c_custkey and o.o_totalprice > 300000", None),
    "theta_join": (("region", "nation"), "select r.r_regionkey, n.n_nationkey from region r join nation n on n.n_regionkey < r.r_regionkey", None),
    "semi": (("customer", "orders"), "select c_custkey, c_name from customer c where exists (select 1 from orders o where o.o_custkey = c.c_custkey and o.o_totalprice > 200000)", None),
    "anti": (("customer", "orders"), "select c_custkey, c_name from customer c where not exists (select 1 from orders o where o.o_custkey = c.c_custkey and o.o_totalprice > 300000)", None),
    "groupby": (("lineitem",), "select l_returnflag, l_linestatus, count(*) as n, cast(sum(l_quantity) as bigint) as qty, min(l_shipdate) as first_ship, max(l_shipdate) as last_ship from lineitem group by l_returnflag, l_linestatus having count(*) > 1", None),
    "agg_filter": (("orders",), "select o_orderstatus, count(*) filter (where o_totalprice > 100000) as big, count(distinct o_custkey) as customers from orders group by o_orderstatus", None),
    "rollup": (("orders",), "select o_orderstatus, o_orderpriority, count(*) as n from orders group by rollup (o_orderstatus, o_orderpriority)", None),
    "cube": (("lineitem",), "select l_returnflag, l_linestatus, count(*) as n from lineitem group by cube (l_returnflag, l_linestatus)", None),
    "grouping_sets": (("lineitem",), "select l_returnflag, l_linestatus, count(*) as n from lineitem group by grouping sets ((l_returnflag), (l_linestatus), ())", None),
    "window": (("orders",), "select o_orderkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as place, lag(o_orderkey) over (partition by o_custkey order by o_orderdate, o_orderkey) as previous from orders", None),
    "window_frame": (("orders",), "select o_orderkey, count(*) over (partition by o_custkey order by o_orderdate, o_orderkey rows between 2 preceding and current row) as near from orders", None),
    "union": (("customer", "supplier"), "select c_nationkey as nationkey from customer union select s_nationkey as nationkey from supplier", None),
    "union_all": (("customer", "supplier"), "select c_nationkey as nationkey from customer union all select s_nationkey as nationkey from supplier", None),
    "intersect": (("customer", "supplier"), "select c_nationkey as nationkey from customer intersect select s_nationkey as nationkey from supplier", None),
    "except": (("customer", "orders"), "select c_custkey as custkey from customer except select o_custkey as custkey from orders where o_totalprice > 300000", None),
    "intersect_all": (("customer", "supplier"), "select c_nationkey as nationkey from customer intersect all select s_nationkey as nationkey from supplier", None),
    "except_all": (("customer", "supplier"), "select c_nationkey as nationkey from customer except all select s_nationkey as nationkey from supplier", None),
    # As of each shipment the last order with its key: both sides in one order, and the last order before. One shuffle.
    "asof_join": (("orders", "lineitem"), "with both as (select o_custkey as k, o_orderdate as at, 0 as later, o_orderkey, cast(null as bigint) as l_orderkey, cast(null as int) as l_linenumber from orders union all select l_suppkey, l_shipdate, 1, null, l_orderkey, l_linenumber from lineitem) select l_orderkey, l_linenumber, at as l_shipdate, last_order from (select *, last_value(o_orderkey) ignore nulls over (partition by k order by at, later, o_orderkey rows between unbounded preceding and current row) as last_order from both) where later = 1", "select l.l_orderkey, l.l_linenumber, l.l_shipdate, o.o_orderkey as last_order from lineitem l asof left join (select o_custkey, o_orderdate, max(o_orderkey) as o_orderkey from orders group by all) o on o.o_custkey = l.l_suppkey and l.l_shipdate >= o.o_orderdate"),
    # The same by one order of both sides, within bands of balances: a band without a customer before takes the last of the bands below it.
    "asof_lateral": (("supplier", "customer"), "with best as (select c_nationkey as k, c_acctbal as at, min(c_custkey) as c_custkey from customer where c_nationkey is not null and c_acctbal is not null group by 1, 2), sides as (select k, at, 0 as later, named_struct('at', at, 'c_custkey', c_custkey) as found, cast(null as bigint) as s_suppkey from best union all select s_nationkey, s_acctbal, 1, null, s_suppkey from supplier), both as (select *, round(at, -2) as band from sides), bands as (select k, band, last_value(top) ignore nulls over (partition by k order by band rows between unbounded preceding and 1 preceding) as below from (select k, band, max(found) as top from both group by k, band)), within as (select *, last_value(found) ignore nulls over (partition by k, band order by at, later rows between unbounded preceding and current row) as last from both) select s_suppkey, coalesce(last, below).c_custkey as c_custkey, coalesce(last, below).at as c_acctbal from within w left join bands b on w.k = b.k and w.band = b.band where later = 1", "select s.s_suppkey, c.c_custkey, c.c_acctbal from supplier s left join lateral (select c_custkey, c_acctbal from customer where c_nationkey = s.s_nationkey and c_acctbal <= s.s_acctbal order by c_acctbal desc, c_custkey limit 1) c on true"),
    "topk": (("orders",), "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 100", None),
    "distinct": (("part",), "select distinct p_brand, p_type from part", None),
    "cte": (("orders", "customer"), "with big as (select o_custkey, count(*) as n from orders group by o_custkey) select c.c_name, b.n from big b join customer c on c.c_custkey = b.o_custkey where b.n > (select avg(n) from big)", None),
    "recursive": ((), "with recursive t(n) as (select 1 union all select n + 1 from t where n < 50) select n from t", None),
    "functions": (("customer",), "select c_custkey, upper(c_name) as name, length(c_mktsegment) as size, coalesce(c_mktsegment, 'none') as segment, case when c_acctbal < 0 then 'debit' else 'credit' end as side, abs(c_acctbal) as amount from customer", None),
    "date_functions": (("orders",), "select o_orderkey, cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month, cast(o_orderdate as date) as day from orders", None),
}

RECURSIVE_ORACLE = "select n::int as n from range(1, 51) t(n)"


def sql_to_delta(text: str, tables: tuple[str, ...]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        url = scratch_url(spark, "delta-sql")
        load(spark, SqlSource(text, _views(sf_dir, *tables)), url)
        return read_delta(spark, url)

    return run


ICEBERG_SQL = "select o_orderkey, o_custkey, o_orderpriority, o_totalprice > 100000 as big from orders"
ICEBERG_RENAMED = "select o_orderkey + 1 as renamed_key, o_custkey as renamed_customer, o_orderstatus as renamed_text, o_totalprice > 200000 as renamed_flag from orders"


def _orders(spark: SparkSession, sf_dir: str, text: str = ICEBERG_SQL) -> SqlSource:
    return SqlSource(text, _views(sf_dir, "orders"))


def delta_skip_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = scratch_url(spark, "delta-skip")
    load(spark, ParquetSource(_path(sf_dir, "customer")), url)
    second = load(spark, ParquetSource(_path(sf_dir, "supplier")), url)
    return read_delta(spark, url).withColumn("second_skipped", F.lit(second.skipped))


def delta_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = scratch_url(spark, "delta-overwrite")
    load(spark, ParquetSource(_path(sf_dir, "customer")), url)
    load(spark, ParquetSource(_path(sf_dir, "supplier")), url, overwrite=True)
    return read_delta(spark, url)


def delta_log_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = scratch_url(spark, "delta-log")
    load(spark, ParquetSource(_path(sf_dir, "nation")), url, layout="exact")
    files = [e.path for e in Store(spark, url).files()]
    return spark.createDataFrame([(len([f for f in files if f.startswith("_delta_log/")]), len([f for f in files if "/part-00000-" in f]))], "log_files int, data_files int")


def delta_add_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics of all Add actions, put together."""
    url = scratch_url(spark, "delta-stats")
    load(spark, ParquetSource(_path(sf_dir, "lineitem")), url)
    adds = spark.createDataFrame([(a["stats"],) for a in open_delta(spark, url).adds.values()], "stats string")
    shape = "numRecords bigint, minValues struct<l_orderkey: bigint, l_quantity: double, l_returnflag: string>, maxValues struct<l_orderkey: bigint, l_quantity: double, l_returnflag: string>, nullCount struct<l_orderkey: bigint, l_shipdate: bigint>"
    s = adds.select(F.from_json("stats", shape).alias("s"))
    least = [F.min(f"s.minValues.{c}").alias(f"min_{c}") for c in ("l_orderkey", "l_quantity", "l_returnflag")]
    most = [F.max(f"s.maxValues.{c}").alias(f"max_{c}") for c in ("l_orderkey", "l_quantity", "l_returnflag")]
    nulls = [F.sum(f"s.nullCount.{c}").alias(f"nulls_{c}") for c in ("l_orderkey", "l_shipdate")]
    return s.agg(F.sum("s.numRecords").alias("num_records"), *least, *most, *nulls)


def iceberg_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = scratch_url(spark, "iceberg-create")
    load(spark, _orders(spark, sf_dir), url, "iceberg")
    return read_iceberg(spark, url)


def iceberg_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = scratch_url(spark, "iceberg-append")
    load(spark, _orders(spark, sf_dir), url, "iceberg")
    load(spark, _orders(spark, sf_dir, ICEBERG_RENAMED), url, "iceberg", append=True)
    return read_iceberg(spark, url)


def _overwritten(spark: SparkSession, sf_dir: str) -> str:
    url = scratch_url(spark, "iceberg-overwrite")
    load(spark, _orders(spark, sf_dir), url, "iceberg")
    load(spark, _orders(spark, sf_dir, ICEBERG_RENAMED), url, "iceberg", overwrite=True)
    return url


def iceberg_overwrite_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_iceberg(spark, _overwritten(spark, sf_dir))


def iceberg_time_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = open_iceberg(spark, _overwritten(spark, sf_dir))
    return table.read(table.snapshots()[0]["snapshot-id"])


def iceberg_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = open_iceberg(spark, _overwritten(spark, sf_dir))
    rows = [(s["sequence-number"], s["summary"]["operation"], int(s["summary"]["total-records"]), "parent-snapshot-id" in s) for s in table.snapshots()]
    return spark.createDataFrame(rows, "sequence long, operation string, records long, has_parent boolean")


def iceberg_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and nulls of the first column, summed over the manifests' files."""
    url = scratch_url(spark, "iceberg-bounds")
    load(spark, _orders(spark, sf_dir), url, "iceberg")
    files = [e["data_file"] for e in open_iceberg(spark, url).entries()]
    first = lambda f, name: next((p["value"] for p in f[name] if p["key"] == 1), None)
    # A file without rows, or of nulls only, has no bounds; all have counts.
    bound = lambda raw: None if raw is None else int.from_bytes(raw, "little", signed=True)
    rows = [(f["record_count"], int(first(f, "null_value_counts")), bound(first(f, "lower_bounds")), bound(first(f, "upper_bounds"))) for f in files]
    return spark.createDataFrame(rows, "n long, nulls long, least long, most long").agg(F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.min("least").alias("least"), F.max("most").alias("most"))


# Name, incoming and existing columns (type and whether required), and whether they fit.
ALIGNMENTS = (
    ("required_into_optional_and_required", "string! int! boolean!", "string? int! boolean!", True),
    ("renamed", "string! int! boolean!", "string! int! boolean!", True),
    ("required_into_optional", "string! int! boolean!", "string? int? boolean?", True),
    ("added_column", "string! int! boolean! boolean!", "string! int! boolean!", False),
    ("other_type", "string! int! int!", "string! int! boolean!", False),
    ("reordered", "int! string! boolean!", "string! int! boolean!", False),
    ("optional_into_required", "string? int! boolean!", "string! int! boolean!", False),
)


def shorthand(columns: str, prefix: str) -> T.StructType:
    kinds = {"string": T.StringType(), "int": T.IntegerType(), "boolean": T.BooleanType()}
    return T.StructType([T.StructField(f"{prefix}{k}", kinds[c[:-1]], c[-1] == "?") for k, c in enumerate(columns.split())])


def _fits(check: Callable[[], object]) -> str:
    try:
        check()
    except LoadError as e:
        return type(e).__name__
    return "ok"


def schema_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(name, _fits(lambda a=a, b=b: align(shorthand(a, "x"), shorthand(b, "a")))) for name, a, b, _ in ALIGNMENTS]
    return spark.createDataFrame(rows, "name string, outcome string")


def write_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of flags on a missing table and on one that is there; rows after the load."""
    one, rows = spark.range(2).toDF("n"), []
    for overwrite in (False, True):
        for append in (False, True):
            for there in (False, True):
                url = scratch_url(spark, "iceberg-modes")
                if there:
                    write_iceberg(one, url)
                outcome = _fits(lambda u=url, o=overwrite, a=append: write_iceberg(one, u, o, a))
                n = read_iceberg(spark, url).count() if outcome == "ok" or there else 0
                rows.append(("iceberg", overwrite, append, there, outcome, n))
        for there in (False, True):
            url = scratch_url(spark, "delta-modes")
            if there:
                write_delta(one, url)
            rows.append(("delta", overwrite, False, there, "skipped" if write_delta(one, url, overwrite).skipped else "ok", read_delta(spark, url).count()))
    return spark.createDataFrame(rows, "format string, overwrite boolean, append boolean, table_exists boolean, outcome string, n long")


def pg_type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(n, pg_type_to_spark(n).simpleString()) for n in PG_TYPES] + [("numeric", pg_type_to_spark("numeric", 524295).simpleString())]
    rows += [(n, _fits(lambda n=n: pg_type_to_spark(n))) for n in ("bpchar", "uuid", "json", "numeric_unbounded")]
    return spark.createDataFrame(rows, "pg string, spark string")


TYPMODS = (524295, 655366, 2490372, 65540, -1)


def typmod_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    mods = spark.createDataFrame([(t,) for t in TYPMODS], "typmod int")
    return mods.select("typmod", decode.typmod_precision(F.col("typmod")).alias("precision"), decode.typmod_scale(F.col("typmod")).alias("scale"))


# Words of a numeric, as hex: digits, weight, sign, display scale, then the digits; and its value at three places.
NUMERICS = (
    ("zero", "0000 0000 0000 0000", "0.000"),
    ("thousandth", "0001 ffff 0000 0003 000a", "0.001"),
    ("minus_two_thousandths", "0001 ffff 4000 0003 0014", "-0.002"),
    ("three", "0001 0000 0000 0000 0003", "3.000"),
    ("minus_four", "0001 0000 4000 0000 0004", "-4.000"),
    ("fifty", "0002 0000 0000 0003 0032 000a", "50.001"),
    ("most", "0003 0001 0000 0003 0009 270f 2706", "99999.999"),
    ("least", "0003 0001 4000 0003 0009 270f 2706", "-99999.999"),
    ("cut_off", "0002 0000 0000 0004 0001 0009", "1.000"),
    ("cut_off_minus", "0002 0000 4000 0004 0001 0009", "-1.000"),
    ("cut_off_far", "0003 0000 0000 000c 0001 0081 2328", "1.012"),
    ("far_digit", "0003 0000 0000 0008 0001 0000 0009", "1.000"),
)


def numeric_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.createDataFrame([(n, h.replace(" ", "")) for n, h, _ in NUMERICS], "name string, words string")
    return raw.select("name", decode.decode_numeric(F.unhex("words"), 8, 3).alias("value"))


def date_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.createDataFrame([("00000102",), ("ffffffff",), ("00000000",)], "bytes string")
    return raw.select("bytes", decode.decode_date(F.unhex("bytes")).alias("day"))


def timestamp_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.createDataFrame([("0000000000000102",), ("ffffffffffffffff",)], "bytes string")
    return raw.select("bytes", F.unix_micros(decode.decode_timestamp(F.unhex("bytes"))).alias("micros"))


def batch_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t1(spark).withColumn("batch", batch_of([F.col("id")])).groupBy("batch").agg(F.count("*").alias("n"))


def _layout_counts(spark: SparkSession, **options) -> list:
    store = Store(spark, scratch_url(spark, "layout"))
    return write_layout(spark.range(0, 2500, 1, 1), store, "", "exact", **options)


def file_rollover_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(k, f.rows) for k, f in enumerate(_layout_counts(spark, file_rows=1000))]
    return spark.createDataFrame(rows, "file int, n long")


def row_group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(k, n) for f in _layout_counts(spark, file_rows=None, group_rows=1000) for k, n in enumerate(f.groups)]
    return spark.createDataFrame(rows, "row_group int, n long")


def env_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    env = {"AWS_ENDPOINT": "http://h", "GOOGLE_KEY": "g", "AZURE_KEY": "a", "OTHER": "x"}
    rows = [(s, k, v) for s in ("s3", "s3a", "gs", "az", "adl", "azure", "abfs", "abfss", "file") for k, v in env_options(f"{s}://b/t", env).items()]
    return spark.createDataFrame(rows, "scheme string, name string, value string")


def t1_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """t1 by way of a Delta table; its binary and its instant as text."""
    url = scratch_url(spark, "delta-t1")
    load(spark, SqlSource("select * from t1 order by id", {"t1": t1(spark)}), url)
    return read_delta(spark, url).withColumns({"cbytea": F.lower(F.hex("cbytea")), "ctimestamptz": F.unix_micros("ctimestamptz")})


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem to a Delta table, and a report on what the table's log leads to."""
    loaded = parquet_to_delta("lineitem")(spark, sf_dir)
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return loaded.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(net), 2).alias("sum_net"), F.count("*").alias("n"))


def _flat(query: Query) -> Query:
    """Embeddings with plain columns: a row for each value of each list."""
    return lambda spark, sf_dir: query(spark, sf_dir).select("vec_id", "label", F.posexplode_outer("embedding").alias("place", "value")).withColumn("place", F.col("place").cast("long"))


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {f"scan_{t}": scan(t) for t in SCALAR_TABLES} | {"scan_embeddings": _flat(scan("embeddings"))}
    found |= {f"load_delta_{t}": parquet_to_delta(t) for t in ("lineitem", "orders", "documents")} | {"load_delta_embeddings": _flat(parquet_to_delta("embeddings"))}
    found |= {"load_delta_exact": parquet_to_delta("orders", "exact"), "load_iceberg_customer": parquet_to_iceberg("customer"), "load_iceberg_lineitem": parquet_to_iceberg("lineitem"), "load_iceberg_exact": parquet_to_iceberg("orders", "exact")}
    found |= {f"sql_to_delta_{n}": sql_to_delta(text, tables) for n, (tables, text, _) in SQL_LOADS.items()}
    own = (delta_skip_existing, delta_overwrite, delta_log_shape, delta_add_stats, iceberg_create, iceberg_append, iceberg_overwrite_renamed, iceberg_time_travel, iceberg_snapshots, iceberg_bounds, schema_alignment, write_modes, pg_type_map, typmod_decode, numeric_decode, date_decode, timestamp_decode, batch_row_counts, file_rollover_counts, row_group_counts, env_keys, t1_fixture, flagship)
    return found | {f.__name__: f for f in own}


def _values(rows: list[tuple], columns: str) -> str:
    def text(x: object) -> str:
        return "null" if x is None else str(x).lower() if isinstance(x, bool) else f"'{x}'" if isinstance(x, str) else str(x)

    return f"select * from (values {', '.join('(' + ', '.join(map(text, r)) + ')' for r in rows)}) t({columns})"


# Outcomes and rows of the write modes: format, overwrite, append, table there, outcome, rows.
WRITE_MODES = [
    ("iceberg", False, False, False, "ok", 2), ("iceberg", False, False, True, "IoError", 2),
    ("iceberg", False, True, False, "ok", 2), ("iceberg", False, True, True, "ok", 4),
    ("iceberg", True, False, False, "ok", 2), ("iceberg", True, False, True, "ok", 2),
    ("iceberg", True, True, False, "BadInputError", 0), ("iceberg", True, True, True, "BadInputError", 2),
    ("delta", False, False, False, "ok", 2), ("delta", False, False, True, "skipped", 2),
    ("delta", True, False, False, "ok", 2), ("delta", True, False, True, "ok", 2),
]

PG_MAP = [
    ("bool", "boolean"), ("char", "tinyint"), ("int2", "smallint"), ("int4", "int"), ("int8", "bigint"), ("float4", "float"),
    ("float8", "double"), ("timestamp", "timestamp_ntz"), ("timestamptz", "timestamp"), ("date", "date"), ("text", "string"),
    ("varchar", "string"), ("bytea", "binary"), ("numeric", "decimal(8,3)"), ("bpchar", "UnsupportedTypeError"),
    ("uuid", "UnsupportedTypeError"), ("json", "UnsupportedTypeError"), ("numeric_unbounded", "UnsupportedTypeError"),
]

T1_SQL = """
with g as (select unnest(range(1, 25002)) as id), s as (select id, id - 1 as s from g)
select id,
    case when s > 0 then s % 2 = 1 end as cbool,
    case when s > 0 then (s % 256 - 128)::tinyint end as cchar,
    case when s > 0 then s::smallint end as cint2,
    case when s > 0 then s::int end as cint4,
    case when s > 0 then s end as cint8,
    case when s > 0 then (s + 0.5)::float end as cfloat4,
    case when s > 0 then (s + 0.5)::double end as cfloat8,
    case when s > 0 then make_timestamp((s + 1704067200) * 1000000) end as ctimestamp,
    case when s > 0 then (s + 1704067200) * 1000000 end as ctimestamptz,
    case when s > 0 then date '2024-01-01' + s::int end as cdate,
    case id when 1 then null when 2 then 0 when 3 then 0.001 when 4 then -0.002 when 5 then 3 when 6 then -4 when 7 then 50.001
        when 8 then 99999.999 when 9 then -99999.999 else (s::decimal(8,0) / 1000)::decimal(8,3) end::decimal(8,3) as cnumeric,
    case when s > 0 then s::varchar end as ctext,
    case when s > 0 then lpad(lower(hex(s)), 8, '0') end as cbytea
from s
"""


def oracle_sql() -> dict[str, str]:
    flat = "select vec_id, label, unnest(range(len(embedding)))::bigint as place, unnest(embedding) as value from embeddings"
    found = {f"scan_{t}": f"select * from {t}" for t in SCALAR_TABLES} | {"scan_embeddings": flat, "load_delta_embeddings": flat}
    found |= {f"load_delta_{t}": f"select * from {t}" for t in ("lineitem", "orders", "documents")}
    found |= {"load_delta_exact": "select * from orders", "load_iceberg_customer": "select * from customer", "load_iceberg_lineitem": "select * from lineitem", "load_iceberg_exact": "select * from orders"}
    found |= {f"sql_to_delta_{n}": oracle or text for n, (_, text, oracle) in SQL_LOADS.items()}
    renamed = "select o_orderkey + 1 as o_orderkey, o_custkey, o_orderstatus as o_orderpriority, o_totalprice > 200000 as big from orders"
    columns = ("l_orderkey", "l_quantity", "l_returnflag")
    return found | {
        "sql_to_delta_recursive": RECURSIVE_ORACLE,
        "delta_skip_existing": "select *, true as second_skipped from customer",
        "delta_overwrite": "select * from supplier",
        "delta_log_shape": "select 2::int as log_files, 1::int as data_files",
        "delta_add_stats": f"select count(*) as num_records, {', '.join(f'min({c}) as min_{c}, max({c}) as max_{c}' for c in columns)}, (count(*) - count(l_orderkey))::bigint as nulls_l_orderkey, (count(*) - count(l_shipdate))::bigint as nulls_l_shipdate from lineitem",
        "iceberg_create": ICEBERG_SQL,
        "iceberg_append": f"{ICEBERG_SQL} union all {renamed}",
        "iceberg_overwrite_renamed": renamed,
        "iceberg_time_travel": ICEBERG_SQL,
        "iceberg_snapshots": "select 1::bigint as sequence, 'append' as operation, count(*) as records, false as has_parent from orders union all select 2, 'overwrite', count(*), true from orders",
        "iceberg_bounds": "select count(*) as n, (count(*) - count(o_orderkey))::bigint as nulls, min(o_orderkey) as least, max(o_orderkey) as most from orders",
        "schema_alignment": _values([(n, "ok" if fits else "BadInputError") for n, _, _, fits in ALIGNMENTS], "name, outcome"),
        "write_modes": "select * replace (n::bigint as n) from (" + _values(WRITE_MODES, "format, overwrite, append, table_exists, outcome, n") + ")",
        "pg_type_map": _values(PG_MAP, "pg, spark"),
        "typmod_decode": f"select typmod::int as typmod, ((typmod - 4) >> 16 & 65535)::int as precision, (xor((typmod - 4) & 2047, 1024) - 1024)::int as scale from (select unnest([{', '.join(map(str, TYPMODS))}]) as typmod)",
        "numeric_decode": f"select name, value::decimal(8,3) as value from ({_values([(n, v) for n, _, v in NUMERICS], 'name, value')})",
        "date_decode": "select * from (values ('00000102', date '2000-01-01' + 258), ('ffffffff', date '1999-12-31'), ('00000000', date '2000-01-01')) t(bytes, day)",
        "timestamp_decode": "select bytes, micros::bigint as micros from (values ('0000000000000102', 946684800000258), ('ffffffffffffffff', 946684799999999)) t(bytes, micros)",
        "batch_row_counts": "select batch::bigint as batch, count(*) as n from (select unnest(range(25001)) // 10000 as batch) group by all",
        "file_rollover_counts": "select file::int as file, count(*) as n from (select unnest(range(2500)) // 1000 as file) group by all",
        "row_group_counts": "select row_group::int as row_group, count(*) as n from (select unnest(range(2500)) // 1000 as row_group) group by all",
        "env_keys": _values([("s3", "aws_endpoint", "http://h"), ("s3a", "aws_endpoint", "http://h"), ("gs", "google_key", "g"), *[(s, "azure_key", "a") for s in ("az", "adl", "azure", "abfs", "abfss")]], "scheme, name, value"),
        "t1_fixture": T1_SQL,
        "flagship": "select l_returnflag, l_linestatus, sum(l_quantity) as sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) as sum_net, count(*) as n from lineitem group by all",
    }
