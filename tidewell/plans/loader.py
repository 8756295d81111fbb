"""A load: a source, a target, and how to treat a table that is there."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from tidewell.errors import BadInputError
from tidewell.operators.delta import write_delta
from tidewell.operators.iceberg import with_retries, write_iceberg, write_mode
from tidewell.operators.layout import DataFile
from tidewell.sources.rowsets import Source
from tidewell.storage import check_url

FORMATS = ("delta", "iceberg")


@dataclass(frozen=True)
class LoadResult:
    """What a load did: skipped is true where a Delta table was there and stayed as it was."""

    skipped: bool
    version: int | None
    snapshot_id: int | None = None
    files: list[DataFile] = field(default_factory=list)

    @property
    def rows(self) -> int:
        return sum(f.rows for f in self.files)


def load(spark: SparkSession, source: Source, target_url: str, table_format: str = "delta", overwrite: bool = False, append: bool = False, layout: str = "parallel") -> LoadResult:
    """Loads a source's rows into a table.

    Delta: a table that is there is left alone, or with overwrite made anew; it can't be appended to. Iceberg: a table that
    is there is an error, unless its rows are to be replaced or added to. Only Iceberg loads are tried again, with the
    source read anew, when another writer commits first.
    """
    if table_format not in FORMATS:
        raise BadInputError(f"unknown table format {table_format}")
    check_url(target_url)
    if table_format == "delta":
        if append:
            raise BadInputError("Delta tables can't be appended to")
        rowset = source.open(spark)
        done = write_delta(rowset.rows, target_url, overwrite, layout, rowset.schema)
        return LoadResult(done.skipped, done.version, None, done.files)
    write_mode(overwrite, append)

    def attempt():
        rowset = source.open(spark)
        return write_iceberg(rowset.rows, target_url, overwrite, append, layout, rowset.schema)

    won = with_retries(attempt)
    return LoadResult(False, won.version, won.snapshot_id, won.files)
