"""Data files: rows capped for each file and row group, written by Spark, and described by their footers.

A load's files lie in a folder of their own, under Spark's names, from the first: nothing is renamed, which on object
stores would copy all data, and until the table's log or metadata names them they are no part of it.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from tidewell.errors import BadInputError, SourceError
from tidewell.storage import Entry, Store
from tidewell.types import check_names

#: Rows of a data file, and of a row group, at most.
FILE_ROWS, GROUP_ROWS = 2 * 1024 * 1024, 122_880
#: Row groups end by rows: this size is beyond what those take.
GROUP_BYTES = 1 << 30
#: Footers that are read at a time, and bytes of a file's end that are read at once.
FOOTERS, TAIL_BYTES = 32, 1 << 16


@dataclass(frozen=True)
class DataFile:
    """A data file: its path in the table, size, rows, rows of its row groups, and each column's least, most and nulls."""

    path: str
    size: int
    rows: int
    groups: list[int]
    columns: dict[str, dict[str, Any]] = field(default_factory=dict)


_lock = threading.Lock()
_writing: dict[SparkSession, list] = {}


@contextmanager
def _micros(spark: SparkSession) -> Iterator[None]:
    """Timestamps in files are microseconds. The setting is the session's: the first of its loads sets it, the last one back."""
    key = "spark.sql.parquet.outputTimestampType"
    with _lock:
        held = _writing.setdefault(spark, [0, spark.conf.get(key)])
        held[0] += 1
        spark.conf.set(key, "TIMESTAMP_MICROS")
    try:
        yield
    finally:
        with _lock:
            held[0] -= 1
            if not held[0]:
                spark.conf.set(key, _writing.pop(spark)[1])


def _parquet(store: Store, file: Entry) -> pq.ParquetFile:
    """A file's footer, read from its end; nothing else of the file is."""
    tail = store.tail(file.path, file.size, TAIL_BYTES)
    if len(tail) < file.size and (needed := int.from_bytes(tail[-8:-4], "little") + 8) > len(tail):
        tail = store.tail(file.path, file.size, needed)
    return pq.ParquetFile(pa.BufferReader(tail))


def read_footer(store: Store, file: Entry) -> dict[str, Any]:
    """Rows, rows by group and, of each top-level column of a plain type, least, most and nulls, where the footer says so."""
    meta = _parquet(store, file).metadata
    out: dict[str, dict[str, Any]] = {}
    for k in range(meta.num_columns):
        name = meta.schema.column(k).path
        if name != meta.schema.column(k).name:
            continue  # inside a nested column
        found = [meta.row_group(g).column(k) for g in range(meta.num_row_groups)]
        said = [c.statistics for c in found]
        column: dict[str, Any] = {"bytes": sum(c.total_compressed_size for c in found)}
        if all(s is not None and s.has_null_count for s in said):
            column["nulls"] = sum(s.null_count for s in said)
        some = [(s, c) for s, c in zip(said, found) if s is None or not s.has_null_count or s.null_count < c.num_values]
        if some and all(s is not None and s.has_min_max for s, _ in some):
            column |= {"least": min(s.min for s, _ in some), "most": max(s.max for s, _ in some)}
        out[name] = column
    return {"rows": meta.num_rows, "groups": [meta.row_group(g).num_rows for g in range(meta.num_row_groups)], "columns": out}


def file_schema(store: Store, file: Entry) -> pa.Schema:
    """The schema in a file's footer, with its columns' nullability."""
    return _parquet(store, file).schema_arrow


def write_layout(df: DataFrame, store: Store, folder: str, layout: str = "parallel", file_rows: int | None = FILE_ROWS, group_rows: int | None = GROUP_ROWS, compression: str = "snappy") -> list[DataFile]:
    """Writes the rows of df to files in a new folder below folder, one for the load.

    Layout `parallel` lets tasks write, each file within file_rows. Layout `exact` has one task write all rows in order, in
    files of file_rows each but the last; it suits tests and small loads. No rows give one empty file. On failure none is
    left. The driver reads the files' footers, FOOTERS at a time, as it writes what they say into the log.
    """
    if layout not in ("parallel", "exact"):
        raise BadInputError(f"unknown layout {layout}")
    check_names(df.schema)
    spark = df.sparkSession
    own = f"{folder + '/' if folder else ''}load-{uuid.uuid4()}"
    rows = df.coalesce(1) if layout == "exact" else df
    writer = rows.write.option("compression", compression).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    if file_rows:
        writer = writer.option("maxRecordsPerFile", file_rows)
    if group_rows:
        writer = writer.option("parquet.block.row.count.limit", group_rows).option("parquet.block.size", GROUP_BYTES)
    try:
        with _micros(spark):
            writer.parquet(store.full(own))
        files = [e for e in store.files(own) if e.path.endswith(".parquet")]
        with ThreadPoolExecutor(FOOTERS) as pool:
            footers = list(pool.map(lambda e: read_footer(store, e), files))
    except BaseException as e:
        store.delete(own)
        if isinstance(e, (PySparkException, Py4JJavaError)):
            raise SourceError(str(e)) from e
        raise
    return [DataFile(e.path, e.size, f["rows"], f["groups"], f["columns"]) for e, f in zip(files, footers)]
