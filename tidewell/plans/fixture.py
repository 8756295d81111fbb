"""The table t1: a row of nulls, then rows that follow from a number s, in all types that a SQL source returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS = 25_000
# Cnumeric of ids 2 to 9.
NUMERICS = ("0", "0.001", "-0.002", "3", "-4", "50.001", "99999.999", "-99999.999")


def t1(spark: SparkSession, rows: int = ROWS) -> DataFrame:
    s, id_ = F.col("id") - 1, F.col("id")
    numeric = F.lit(None).cast("decimal(8,3)")
    for k, value in enumerate(NUMERICS, 2):
        numeric = F.when(id_ == k, F.lit(value).cast("decimal(8,3)")).otherwise(numeric)
    columns = {
        "cbool": s % 2 == 1,
        "cchar": (s % 256 - 128).cast("byte"),
        "cint2": s.cast("short"),
        "cint4": s.cast("int"),
        "cint8": s,
        "cfloat4": (s + 0.5).cast("float"),
        "cfloat8": s + 0.5,
        "ctimestamp": F.timestamp_micros((s + 1704067200) * 1_000_000).cast("timestamp_ntz"),
        "ctimestamptz": F.timestamp_micros((s + 1704067200) * 1_000_000),
        "cdate": F.date_from_unix_date((s + 19723).cast("int")),
        "cnumeric": F.coalesce(numeric, (s / 1000).cast("decimal(8,3)")),
        "ctext": s.cast("string"),
        "cbytea": F.unhex(F.lpad(F.hex(s), 8, "0")),
    }
    return spark.range(1, rows + 2).select("id", *[F.when(id_ > 1, c).alias(n) for n, c in columns.items()])
