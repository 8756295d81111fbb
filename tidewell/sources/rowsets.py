"""Sources of rowsets. Each yields a DataFrame, and the schema with the nullability that the sink is to take."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Protocol
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.window import Window

from tidewell.errors import BadInputError, IoError, SourceError
from tidewell.operators.layout import file_schema
from tidewell.storage import Store
from tidewell.types import TYPMOD_HEADER, all_nullable, check_sql_types, pg_type_to_spark

BATCH_ROWS = 10_000


@dataclass(frozen=True)
class Rowset:
    rows: DataFrame
    schema: T.StructType


class Source(Protocol):
    def open(self, spark: SparkSession) -> Rowset: ...


def _with_scheme(path: str) -> str:
    return path if urlsplit(path).scheme else f"file://{os.path.abspath(path)}"


@dataclass(frozen=True)
class ParquetSource:
    """All rows and columns of a Parquet file, or of a folder of them. Nullability is that of the (first) file's footer."""

    path: str

    def open(self, spark: SparkSession) -> Rowset:
        url = _with_scheme(self.path)
        folder, _, name = url.rpartition("/")
        store = Store(spark, folder)
        if not store.exists(name):
            raise IoError(f"{self.path} doesn't exist")
        try:
            rows = spark.read.parquet(url)
            files = [e for e in store.files(name) if e.path.endswith(".parquet") or e.path == name]
            required = {f.name for f in file_schema(store, files[0]) if not f.nullable} if files else set()
        except (PySparkException, Py4JJavaError, pa.ArrowInvalid) as e:
            raise SourceError(f"{self.path}: {e}") from e
        return Rowset(rows, T.StructType([T.StructField(f.name, f.dataType, f.name not in required) for f in rows.schema]))


_QUOTED = re.compile(r"('(?:[^']|'')*'|\"[^\"]*\"|`[^`]*`|--[^\n]*|/\*.*?\*/)", re.DOTALL)
# Database type names in casts, and Spark's.
_TYPE_NAMES = {"text": "string", "bool": "boolean", "int2": "smallint", "int4": "int", "int8": "bigint", "float4": "float", "float8": "double", "bytea": "binary", "numeric": "decimal", "timestamptz": "timestamp"}
_CAST = re.compile(r"(::\s*|\bas\s+)(text|varchar|timestamp|" + "|".join(_TYPE_NAMES) + r")\b(?=\s*[),(]|\s|$|[^\w])", re.IGNORECASE)


def spark_dialect(query: str) -> str:
    """The query with the database's type names in casts as Spark has them; quoted text and comments stay."""

    def name(m: re.Match) -> str:
        own = m[2].lower()
        if m[1].lower().startswith("as") and not re.match(r"\s*(\([0-9, ]+\)\s*)?\)", m.string[m.end() :]):
            return m[0]  # an alias
        if own == "timestamp":
            return m[1] + "timestamp_ntz"
        return m[1] + ("string" if own == "varchar" else _TYPE_NAMES[own])

    parts = _QUOTED.split(query)
    return "".join(p if k % 2 else _CAST.sub(name, p) for k, p in enumerate(parts))


@dataclass(frozen=True)
class SqlSource:
    """The result of a query over the session's views, and over the given ones: names of Parquet files or DataFrames."""

    query: str
    views: Mapping[str, str | DataFrame] = field(default_factory=dict)

    def open(self, spark: SparkSession) -> Rowset:
        if not self.query or not self.query.strip():
            raise BadInputError("a query is needed")
        with _views(spark, self.views):
            try:
                found = spark.sql(spark_dialect(self.query))
            except PySparkException as e:
                raise SourceError(str(e)) from e
        check_sql_types(found.schema)
        return Rowset(found, all_nullable(found.schema))


@contextmanager
def _views(spark: SparkSession, views: Mapping[str, str | DataFrame]) -> Iterator[None]:
    """Views for the time in which a query's names are resolved; the session's own of the same names come back."""
    held = {t.name.lower(): spark.table(t.name) for t in spark.catalog.listTables() if t.isTemporary and not t.namespace} if views else {}
    try:
        for name, rows in views.items():
            (rows if isinstance(rows, DataFrame) else spark.read.parquet(rows)).createOrReplaceTempView(name)
        yield
    except PySparkException as e:
        raise SourceError(str(e)) from e
    finally:
        for name in views:
            if name.lower() in held:
                held[name.lower()].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)


def jdbc_options(connection: str, query: str, batch_rows: int = BATCH_ROWS, env: Mapping[str, str] = os.environ) -> dict[str, str]:
    """JDBC options of a postgres:// URL, or of a jdbc: one. A password in PGPASSWORD goes before the URL's."""
    if connection.startswith("jdbc:"):
        return {"url": connection, "query": query, "fetchsize": str(batch_rows), "preferTimestampNTZ": "true"}
    url = urlsplit(connection)
    if url.scheme not in ("postgres", "postgresql") or not url.hostname:
        raise BadInputError("the connection string must be postgres://user:password@host:port/database")
    options = {"url": f"jdbc:postgresql://{url.hostname}:{url.port or 5432}{url.path}" + (f"?{url.query}" if url.query else ""), "query": query, "fetchsize": str(batch_rows), "driver": "org.postgresql.Driver", "preferTimestampNTZ": "true"}
    if url.username:
        options["user"] = unquote(url.username)
    password = env.get("PGPASSWORD") or (unquote(url.password) if url.password else None)
    return options | ({"password": password} if password else {})


def described(spark: SparkSession, options: Mapping[str, str]) -> list[tuple[str, str, int, int]]:
    """Name, the database's type, precision and scale of a query's columns, as the database says when it prepares it."""
    jvm, login = spark._jvm, spark._jvm.java.util.Properties()
    for key in ("user", "password"):
        if key in options:
            login.setProperty(key, options[key])
    if "driver" in options:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(options["driver"])
    connection = jvm.java.sql.DriverManager.getConnection(options["url"], login)
    try:
        said = connection.prepareStatement(options["query"]).getMetaData()
        return [(said.getColumnLabel(k), said.getColumnTypeName(k), said.getPrecision(k), said.getScale(k)) for k in range(1, said.getColumnCount() + 1)]
    finally:
        connection.close()


def strict_types(columns: list[tuple[str, str, int, int]]) -> T.StructType:
    """The types of a PostgreSQL query's columns; those that loads don't take are refused by the database's own names."""
    found = []
    for name, kind, precision, scale in columns:
        typmod = (precision << 16 | scale & 0x7FF) + TYPMOD_HEADER if kind == "numeric" and precision else -1
        found.append(T.StructField(name, pg_type_to_spark(kind, typmod)))
    return T.StructType(found)


@dataclass(frozen=True)
class JdbcSource:
    """The result of a query in a database. It needs the database's JDBC driver on Spark's class path.

    One task reads it or, by ranges of a column of whole numbers, days or times, as many as partitions says.
    """

    connection: str
    query: str
    batch_rows: int = BATCH_ROWS
    partition_column: str | None = None
    partitions: int = 1

    def open(self, spark: SparkSession) -> Rowset:
        options = jdbc_options(self.connection, self.query, self.batch_rows)
        try:
            kinds = strict_types(described(spark, options)) if options["url"].startswith("jdbc:postgresql:") else None
            rows = spark.read.format("jdbc").options(**self._ranges(spark, options)).load()
        except (PySparkException, Py4JJavaError) as e:
            raise SourceError(f"the database can't be read: {e}") from e
        if kinds:
            cast = lambda c, t: F.ascii(c).cast(t) if isinstance(t, T.ByteType) and rows.schema[c].dataType == T.StringType() else F.col(f"`{c}`").cast(t)
            rows = rows.select(*[cast(f.name, f.dataType).alias(f.name) if rows.schema[f.name].dataType != f.dataType else f"`{f.name}`" for f in kinds])
        check_sql_types(rows.schema)
        return Rowset(rows, all_nullable(rows.schema))

    def _ranges(self, spark: SparkSession, options: dict[str, str]) -> dict[str, str]:
        if self.partition_column is None or self.partitions < 2:
            return options
        column, whole = self.partition_column, f"({self.query}) rowset"
        quoted = '"' + column.replace('"', '""') + '"'
        ends = spark.read.format("jdbc").options(**options | {"query": f"select min({quoted}) as a, max({quoted}) as b from {whole}"}).load().head()
        if ends[0] is None:
            return options
        rest = {k: v for k, v in options.items() if k != "query"}
        return rest | {"dbtable": whole, "partitionColumn": quoted, "lowerBound": str(ends[0]), "upperBound": str(ends[1]), "numPartitions": str(self.partitions)}


def arrow_batches(rows: DataFrame, batch_rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The rows in order, in record batches of batch_rows and a last one of the rest. One partition at a time is held.

    Rows come from the tasks as Arrow data, and are never Python objects.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema) as stream:
                stream.write_batch(batch)
            yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["data"])

    schema = _arrow_schema(rows.schema)
    held = schema.empty_table()
    for (data,) in rows.mapInArrow(packed, "data binary").toLocalIterator(prefetchPartitions=False):
        held = pa.concat_tables([held, pa.ipc.open_stream(bytes(data)).read_all().rename_columns(schema.names).cast(schema)])
        while held.num_rows >= batch_rows:
            yield held.slice(0, batch_rows).combine_chunks().to_batches()[0]
            held = held.slice(batch_rows)
    if held.num_rows:
        yield held.combine_chunks().to_batches()[0]


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema, timestamp_utc=True)


def batch_of(order: list[Column], batch_rows: int = BATCH_ROWS) -> Column:
    """The batch of each row, from 0, when rows in the given order are cut into batches of batch_rows.

    It numbers all rows in one task, and suits tests: loads don't batch rows, tasks write as they read.
    """
    return F.floor((F.row_number().over(Window.orderBy(*order)) - 1) / batch_rows)


def arrow_to_spark(schema: pa.Schema) -> T.StructType:
    return from_arrow_schema(schema)
