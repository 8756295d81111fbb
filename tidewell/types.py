"""Types: Postgres to Spark, Spark to Delta and Iceberg, and the fit of a rowset to an existing table."""

from __future__ import annotations

from typing import Any

from pyspark.sql import types as T

from tidewell.errors import BadInputError, TableFormatError, UnsupportedTypeError

ADVICE = "Cast such columns to text, or to another type that is taken, in the query"

# The database types that a SQL source may return, and what each becomes.
PG_TYPES: dict[str, T.DataType] = {
    "bool": T.BooleanType(), "char": T.ByteType(), "int2": T.ShortType(), "int4": T.IntegerType(), "int8": T.LongType(),
    "float4": T.FloatType(), "float8": T.DoubleType(), "timestamp": T.TimestampNTZType(), "timestamptz": T.TimestampType(),
    "date": T.DateType(), "text": T.StringType(), "varchar": T.StringType(), "bytea": T.BinaryType(),
}

#: A numeric's type modifier begins after a header of this size.
TYPMOD_HEADER = 4
MOST_DIGITS = 38


def numeric_precision(typmod: int) -> int:
    return ((typmod - TYPMOD_HEADER) >> 16) & 0xFFFF


def numeric_scale(typmod: int) -> int:
    """The low eleven bits, as a signed number."""
    return (((typmod - TYPMOD_HEADER) & 0x7FF) ^ 0x400) - 0x400


def pg_type_to_spark(name: str, typmod: int = -1) -> T.DataType:
    """The Spark type of a database type; numeric takes its precision and scale from the type modifier."""
    if name == "numeric":
        precision, scale = numeric_precision(typmod), numeric_scale(typmod)
        if not 1 <= precision <= MOST_DIGITS or not 0 <= scale <= precision:
            raise UnsupportedTypeError(f"Unsupported precision {precision} and scale {scale} of a numeric: cast it to numeric(p,s), or to text")
        return T.DecimalType(precision, scale)
    if name not in PG_TYPES:
        raise UnsupportedTypeError(f"Unsupported type: {name}. {ADVICE}")
    return PG_TYPES[name]


_SQL_SOURCE = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.TimestampNTZType, T.TimestampType, T.DateType, T.DecimalType, T.StringType, T.BinaryType)


def check_sql_types(schema: T.StructType) -> None:
    """A SQL source returns the types of PG_TYPES and numeric, and nothing else."""
    for field in schema:
        if not isinstance(field.dataType, _SQL_SOURCE):
            raise UnsupportedTypeError(f"Unsupported type: {field.dataType.simpleString()} of column {field.name}. {ADVICE}")


def check_names(schema: T.StructType) -> None:
    seen: set[str] = set()
    for name in (f.name.lower() for f in schema):
        if name in seen:
            raise BadInputError(f"Column {name} occurs twice")
        seen.add(name)


def all_nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema])


# --- Delta -----------------------------------------------------------------------------------------------------------


def _parts(kind: T.DataType) -> list[T.DataType]:
    """The type and all types inside it."""
    if isinstance(kind, T.ArrayType):
        return [kind, *_parts(kind.elementType)]
    if isinstance(kind, T.MapType):
        return [kind, *_parts(kind.keyType), *_parts(kind.valueType)]
    if isinstance(kind, T.StructType):
        return [kind, *(x for f in kind for x in _parts(f.dataType))]
    return [kind]


_DELTA = (*_SQL_SOURCE, T.ArrayType, T.MapType, T.StructType)


def delta_schema(schema: T.StructType) -> str:
    """Delta's schema text, which is Spark's own; types that the format lacks are refused."""
    for field in schema:
        for kind in _parts(field.dataType):
            if not isinstance(kind, _DELTA):
                raise UnsupportedTypeError(f"Delta has no type {kind.simpleString()} (column {field.name}). {ADVICE}")
    return T.StructType([T.StructField(f.name, f.dataType, f.nullable) for f in schema]).json()


def has_zoneless(schema: T.StructType) -> bool:
    return any(isinstance(x, T.TimestampNTZType) for f in schema for x in _parts(f.dataType))


# --- Iceberg ---------------------------------------------------------------------------------------------------------

# The format's names of primitive types.
_ICEBERG = {
    T.BooleanType: "boolean", T.IntegerType: "int", T.LongType: "long", T.FloatType: "float", T.DoubleType: "double",
    T.DateType: "date", T.TimestampNTZType: "timestamp", T.TimestampType: "timestamptz", T.StringType: "string", T.BinaryType: "binary",
}
_FROM_ICEBERG = {name: kind for kind, name in _ICEBERG.items()}


def iceberg_type(kind: T.DataType) -> str:
    if isinstance(kind, T.DecimalType):
        return f"decimal({kind.precision}, {kind.scale})"
    if type(kind) not in _ICEBERG:
        hint = "cast it to int" if isinstance(kind, (T.ByteType, T.ShortType)) else ADVICE
        raise BadInputError(f"Iceberg has no type {kind.simpleString()}: {hint}")
    return _ICEBERG[type(kind)]


def iceberg_schema(schema: T.StructType, schema_id: int = 0) -> dict[str, Any]:
    """The schema with ids 1 to n for its columns in order."""
    fields = [{"id": i, "name": f.name, "required": not f.nullable, "type": iceberg_type(f.dataType)} for i, f in enumerate(schema, 1)]
    return {"type": "struct", "schema-id": schema_id, "fields": fields}


def spark_type(name: str) -> T.DataType:
    if not isinstance(name, str):
        raise TableFormatError("nested Iceberg types aren't supported")
    if name.startswith("decimal("):
        precision, scale = name[8:-1].split(",")
        return T.DecimalType(int(precision), int(scale))
    if name not in _FROM_ICEBERG:
        raise TableFormatError(f"unknown Iceberg type {name}")
    return _FROM_ICEBERG[name]()


def spark_schema(iceberg: dict[str, Any]) -> T.StructType:
    """Spark's schema, each column with its field id."""
    return T.StructType([T.StructField(f["name"], spark_type(f["type"]), not f["required"], {"parquet.field.id": f["id"]}) for f in iceberg["fields"]])


def align(incoming: T.StructType, existing: T.StructType) -> None:
    """Raises unless rows of the incoming schema fit the existing one, column by column in order; names don't count.

    Types must be equal. A required column takes no optional one; an optional column takes a required one.
    """
    if len(incoming) != len(existing):
        raise BadInputError(f"The table has {len(existing)} columns, the rowset {len(incoming)}")
    for place, (new, old) in enumerate(zip(incoming, existing), 1):
        if new.dataType != old.dataType:
            raise BadInputError(f"Column {place} is {old.name} {old.dataType.simpleString()} in the table, {new.name} {new.dataType.simpleString()} in the rowset")
        if new.nullable and not old.nullable:
            raise BadInputError(f"Column {place}, {old.name}, is required in the table and optional in the rowset")
