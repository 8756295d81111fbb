"""What the operators share: shared storage, written intermediate tables and prefix sums over a global order."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. A local master without one (tests) gets a new folder.

    A path without a scheme means the default file system. On a cluster the setting is needed: executors don't see each
    other's disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tidewell-")
        spark.sparkContext.setCheckpointDir(root)
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", root):
        return root
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of df has it, in whatever case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder's URI under the shared root."""
    return f"{shared_root(spark).rstrip('/')}/tidewell/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a written and reread table: its lineage is cut, and a lost executor costs no recomputation."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def col_or_null(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column, or nulls of the given type where the table has no such column."""
    return F.col(f"`{name}`").cast(kind) if name in df.columns else F.lit(None).cast(kind)


def word_count(text: Column) -> Column:
    """Number of runs of characters that are not ASCII white space (null: 0)."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return F.when(F.length(flat) == 0, F.lit(0)).otherwise(F.length(flat) - F.length(F.replace(flat, F.lit(" "))) + 1).cast("long")


def prefix_sum(df: DataFrame, order: Sequence[Column], value: str, out: str, name: str) -> DataFrame:
    """df with column out: the sum of value over all rows before each row in the given total order.

    Rows are dealt to range partitions and written; each partition's total (one row a partition) goes to the driver, and
    a running sum inside each partition is lifted by the totals before it. No task holds more than a range of rows.
    """
    spark, (part,) = df.sparkSession, unused(df, "_part")
    ranged = df.repartitionByRange(partitions(spark), *order).withColumn(part, F.spark_partition_id())
    ranged = written(ranged, name)
    totals = dict(ranged.groupBy(part).agg(F.sum(value).alias("n")).collect())
    before, offsets = 0, []
    for k in range(max(totals, default=0) + 1):
        offsets.append(before)
        before += totals.get(k) or 0
    offset = F.element_at(F.lit(offsets).cast("array<bigint>"), F.col(part) + 1)
    running = F.sum(value).over(Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return ranged.withColumn(out, (F.coalesce(running, F.lit(0)) + offset).cast("long")).drop(part)
