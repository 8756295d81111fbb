import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.errors import BadInputError, UnsupportedTypeError
from tidewell.functions import decode
from tidewell.plans.queries import ALIGNMENTS, NUMERICS, shorthand
from tidewell.types import align, check_sql_types, delta_schema, has_zoneless, iceberg_schema, numeric_precision, numeric_scale, pg_type_to_spark, spark_schema


def test_typmod():
    assert (numeric_precision(524295), numeric_scale(524295)) == (8, 3)
    assert (numeric_precision(-1), numeric_scale(-1)) == (65535, -5)
    assert pg_type_to_spark("numeric", 524295) == T.DecimalType(8, 3)
    for bad in (-1, (39 << 16) + 4, ((8 << 16) | (0x7FF & -2)) + 4):
        with pytest.raises(UnsupportedTypeError):
            pg_type_to_spark("numeric", bad)


def test_unknown_type_says_what_to_do():
    with pytest.raises(UnsupportedTypeError, match="Cast such columns to text"):
        pg_type_to_spark("uuid")
    with pytest.raises(UnsupportedTypeError):
        check_sql_types(T.StructType([T.StructField("a", T.ArrayType(T.StringType()))]))
    with pytest.raises(UnsupportedTypeError):
        check_sql_types(T.StructType([T.StructField("a", T.NullType())]))


@pytest.mark.parametrize(("name", "incoming", "existing", "fits"), ALIGNMENTS)
def test_alignment(name, incoming, existing, fits):
    if fits:
        align(shorthand(incoming, "x"), shorthand(existing, "a"))
    else:
        with pytest.raises(BadInputError):
            align(shorthand(incoming, "x"), shorthand(existing, "a"))


def test_iceberg_types_round_trip():
    kinds = [T.BooleanType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DecimalType(9, 2), T.DateType(), T.TimestampType(), T.TimestampNTZType(), T.StringType(), T.BinaryType()]
    schema = T.StructType([T.StructField(f"c{k}", kind, k % 2 == 0) for k, kind in enumerate(kinds)])
    back = spark_schema(iceberg_schema(schema))
    assert [(f.name, f.dataType, f.nullable) for f in back] == [(f.name, f.dataType, f.nullable) for f in schema]
    assert [f.metadata["parquet.field.id"] for f in back] == list(range(1, len(kinds) + 1))
    for bad in (T.ByteType(), T.ShortType(), T.ArrayType(T.IntegerType())):
        with pytest.raises(BadInputError):
            iceberg_schema(T.StructType([T.StructField("a", bad)]))


def test_delta_schema():
    schema = T.StructType([T.StructField("a", T.ArrayType(T.StructType([T.StructField("t", T.TimestampNTZType())])))])
    assert T.StructType.fromJson(__import__("json").loads(delta_schema(schema))) == schema
    assert has_zoneless(schema)
    with pytest.raises(UnsupportedTypeError):
        delta_schema(T.StructType([T.StructField("a", T.NullType())]))


def _one(spark, words, column):
    return spark.createDataFrame([(words.replace(" ", ""),)], "w string").select(column(F.unhex("w")).alias("v")).head()[0]


def test_numeric_vectors(spark):
    rows = spark.createDataFrame([(n, w.replace(" ", "")) for n, w, _ in NUMERICS], "n string, w string")
    got = {r.n: r.v for r in rows.select("n", decode.decode_numeric(F.unhex("w"), 8, 3).alias("v")).collect()}
    assert got == {n: Decimal(v) for n, _, v in NUMERICS}


def test_numeric_of_38_digits_and_no_scale(spark):
    words = f"000a 0009 0000 0000 {' '.join(['0063', *['270f'] * 9])}"
    assert _one(spark, words, lambda c: decode.decode_numeric(c, 38, 0)) == Decimal("99" + "9999" * 9)
    assert _one(spark, "0001 0000 4000 0000 0007", lambda c: decode.decode_numeric(c, 5, 0)) == Decimal(-7)


@pytest.mark.parametrize("words", ["0000 0000 c000 0000", "0000 0000 d000 0000", "0000 0000 f000 0000", "0001 0000", "0002 0000 0000 0000 0001"])
def test_numeric_refusals(spark, words):
    with pytest.raises(PySparkException):
        _one(spark, words, lambda c: decode.decode_numeric(c, 8, 3))


def test_dates_and_timestamps(spark):
    assert _one(spark, "00000102", decode.decode_date) == datetime.date(2000, 9, 15)
    assert _one(spark, "ffffffff", decode.decode_date) == datetime.date(1999, 12, 31)
    micros = lambda c: F.unix_micros(decode.decode_timestamp(c))
    assert _one(spark, "0000000000000102", micros) == 946684800000258
    assert _one(spark, "ffffffffffffffff", micros) == 946684799999999
    for words, column in (("7fffffff", decode.decode_date), ("80000000", decode.decode_date), ("7fffffffffffffff", micros), ("8000000000000000", micros), ("0001", decode.decode_date), ("00000001", micros)):
        with pytest.raises(PySparkException):
            _one(spark, words, column)


def test_null_values_stay_null(spark):
    row = spark.createDataFrame([(None,)], "w binary").select(decode.decode_numeric(F.col("w"), 8, 3), decode.decode_date(F.col("w")), decode.decode_timestamp(F.col("w"))).head()
    assert list(row) == [None, None, None]
