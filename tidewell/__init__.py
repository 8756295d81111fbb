"""Tidewell loads rowsets into Delta and Iceberg tables on Spark.

A rowset is a Parquet file, or the result of SQL over registered views or a JDBC database. Relational work is Spark's; the
table formats' logs and metadata are written here, on the driver, beside data files that executors write.
"""

from tidewell.errors import BadInputError, ConcurrencyError, IoError, LoadError, SourceError, TableFormatError, UnsupportedTypeError
from tidewell.plans.loader import LoadResult, load

__all__ = ["BadInputError", "ConcurrencyError", "IoError", "LoadError", "LoadResult", "SourceError", "TableFormatError", "UnsupportedTypeError", "load"]
