from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from rangehaul.functions import types as Y
from rangehaul.functions.types import SourceColumn as C
from rangehaul.operators import conform as K


@pytest.mark.parametrize(
    "kind, expected",
    [("tinyint", "smallint"), ("money", "decimal(19,4)"), ("smallmoney", "decimal(10,4)"), ("bit", "boolean"), ("real", "float"),
     ("rowversion", "binary"), ("datetime2", "timestamp_ntz"), ("datetimeoffset", "timestamp"), ("time", "string"), ("UniqueIdentifier", "string")],
)
def test_sqlserver_types(spark, kind, expected):
    assert Y.source_schema([C("c", kind)])[0].dataType.simpleString() == expected


@pytest.mark.parametrize(
    "kind, precision, scale, expected",
    [("NUMBER", None, None, "double"), ("NUMBER", 18, 0, "bigint"), ("NUMBER", 19, 0, "decimal(19,0)"), ("NUMBER", 14, 2, "decimal(14,2)"),
     ("BINARY_FLOAT", None, None, "float"), ("CLOB", None, None, "string"), ("LONG RAW", None, None, "binary"), ("DATE", None, None, "timestamp_ntz"),
     ("TIMESTAMP(6)", None, 6, "timestamp_ntz"), ("BOOLEAN", None, None, "boolean")],
)
def test_oracle_types(spark, kind, precision, scale, expected):
    assert Y.source_schema([C("c", kind, precision, scale)], "oracle")[0].dataType.simpleString() == expected


def test_planner_types():
    assert [Y.planner_type(*t) for t in (("NUMBER", 18, 0), ("NUMBER", 9, 0), ("NUMBER", 14, 2), ("NUMBER", None, None), ("TIMESTAMP(6)", None, 6), ("DATE", None, None), ("BINARY_DOUBLE", None, None), ("VARCHAR2", None, None))] == [
        "bigint", "int", "decimal", "decimal", "datetime2", "datetime2", "float", "varchar2",
    ]


def test_unsupported_types_fail_before_reading():
    with pytest.raises(Y.UnsupportedType, match="'shape'.*'geometry'"):
        Y.sqlserver_type(C("shape", "geometry"))
    with pytest.raises(Y.UnsupportedType, match="'x'"):
        Y.oracle_type(C("x", "SDO_GEOMETRY"))
    with pytest.raises(Y.UnsupportedType, match="NUMBER\\(60\\)"):
        Y.oracle_type(C("n", "NUMBER", 60, 0))
    assert Y.oracle_type(C("n", "NUMBER", 60, 0), long_decimals_as_text=True) == "string"


def test_source_projection():
    assert K.source_projection([C("a]b", "int"), C("t", "tinyint"), C("x", "ntext")]) == (
        "[a]]b], CAST([t] AS smallint) AS [t], CAST([x] AS nvarchar(max)) AS [x]"
    )
    assert K.source_projection([C("A", "NUMBER", 9, 0), C("Z", "TIMESTAMP(6) WITH TIME ZONE")], "oracle") == (
        '"A", CAST(SYS_EXTRACT_UTC("Z") AS TIMESTAMP) AS "Z"'
    )


def test_typed_projection_and_overflow(spark):
    frame = spark.createDataFrame([(1, "7", 300)], "a bigint, b string, c int")
    typed = K.typed_projection(frame, [C("b", "int"), C("a", "smallint")])
    assert typed.schema.simpleString() == "struct<b:int,a:smallint>" and tuple(typed.first()) == (7, 1)
    big = spark.createDataFrame([(70000,)], "a int")
    with pytest.raises(PySparkException):
        K.typed_projection(big, [C("a", "smallint")]).collect()


@pytest.mark.parametrize(
    "a, b, expected",
    [("int", "bigint", "bigint"), ("smallint", "tinyint", "smallint"), ("int", "double", "double"), ("float", "float", "float"), ("float", "bigint", "double"),
     ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("decimal(5,2)", "int", "decimal(12,2)"), ("date", "timestamp_ntz", "timestamp_ntz"), ("void", "string", "string")],
)
def test_wider_types(spark, a, b, expected):
    parse = lambda t: T.NullType() if t == "void" else T.DataType.fromDDL(t)
    assert Y.wider_type(parse(a), parse(b)).simpleString() == expected
    assert Y.wider_type(parse(b), parse(a)).simpleString() == expected


def test_no_common_type(spark):
    for a, b in (("string", "int"), ("decimal(38,0)", "decimal(38,10)"), ("boolean", "int")):
        with pytest.raises(Y.UnsupportedType):
            Y.wider_type(T.DataType.fromDDL(a), T.DataType.fromDDL(b))


def test_union_of_differing_frames(spark):
    left = spark.createDataFrame([(1, "x")], "a int, b string")
    right = spark.createDataFrame([("y", 2**40, 1.5)], "b string, a bigint, c double")
    merged = K.unify_union([left, right])
    assert merged.schema.simpleString() == "struct<a:bigint,b:string,c:double>"
    assert sorted(map(tuple, merged.collect())) == [(1, "x", None), (2**40, "y", 1.5)]


def test_compatibility_of_files(spark):
    frame = spark.createDataFrame([("f1", "a", "int32"), ("f2", "a", "int64"), ("f1", "b", "string")], "path string, column string, type string")
    assert {r["column"]: (r["files"], r["types"], r["same_type"]) for r in K.schema_compat(frame).collect()} == {
        "a": (2, ["int32", "int64"], False), "b": (1, ["string"], True),
    }


def test_keys_from_text(spark):
    frame = spark.createDataFrame(
        [("12.5", "decimal"), ("x", "int"), ("2025-02-03T04:05:06", "date"), ("2025-02-03 00:00:00", "date"), ("2025-02-03T04:05:06.5", "datetime2"), (None, "bigint")],
        "text string, sql_type string",
    )
    got = [tuple(r)[2:] for r in K.parse_keys(frame).collect()]
    assert got == [
        (Decimal("12.500000"), None, None), (None, None, None), (None, date(2025, 2, 3), None), (None, date(2025, 2, 3), None),
        (None, None, datetime(2025, 2, 3, 4, 5, 6, 500000)), (None, None, None),
    ]
