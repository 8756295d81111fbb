"""The command line: one command for each pair of source and sink."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from tidewell.errors import LoadError
from tidewell.plans.loader import load
from tidewell.sources.rowsets import BATCH_ROWS, JdbcSource, ParquetSource, SqlSource

log = logging.getLogger("tidewell")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser("tidewell", description="Load rowsets into Delta and Iceberg tables.")
    commands = top.add_subparsers(dest="command", required=True)
    for source in ("parquet", "pg", "sql"):
        for sink in ("delta", "iceberg"):
            own = commands.add_parser(f"{source}-to-{sink}")
            if source == "parquet":
                own.add_argument("source_file")
            elif source == "pg":
                own.add_argument("connection_string")
            else:
                own.add_argument("--view", action="append", default=[], metavar="NAME=PATH", help="a Parquet file to query")
            own.add_argument("target_url")
            own.add_argument("-o", "--overwrite", action="store_true")
            if sink == "iceberg":
                own.add_argument("--append", action="store_true")
            if source != "parquet":
                own.add_argument("-q", "--query", required=True)
            if source == "pg":
                own.add_argument("-b", "--batch-size", type=int, default=BATCH_ROWS)
                own.add_argument("--partition-column", help="a column by whose ranges several tasks read")
                own.add_argument("--partitions", type=int, default=1)
            own.add_argument("--layout", choices=("parallel", "exact"), default="parallel")
    return top


def source_of(args: argparse.Namespace):
    kind = args.command.partition("-")[0]
    if kind == "parquet":
        return ParquetSource(args.source_file)
    if kind == "pg":
        return JdbcSource(args.connection_string, args.query, args.batch_size, args.partition_column, args.partitions)
    return SqlSource(args.query, dict(v.split("=", 1) for v in args.view))


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO)
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("tidewell").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        done = load(spark, source_of(args), args.target_url, args.command.rpartition("-")[2], args.overwrite, getattr(args, "append", False), args.layout)
    except LoadError as e:
        log.error("%s: %s", type(e).__name__, e)
        return 1
    if done.skipped:
        log.info("%s exists; pass -o to overwrite it", args.target_url)
    else:
        log.info("loaded %d rows in %d files, version %s", done.rows, len(done.files), done.version)
    return 0


if __name__ == "__main__":
    sys.exit(main())
