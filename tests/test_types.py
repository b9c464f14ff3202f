import pytest
from pyspark.sql import functions as F, types as T

from sluicegate.functions import types


@pytest.mark.parametrize(
    "name, family",
    [("int", "numeric"), ("DECIMAL", "numeric"), ("money", "numeric"), ("real", "numeric"), ("timestamp", "binary"),
     ("smalldatetime", "minute"), ("datetime", "datetime"), ("datetime2", "datetime"), ("datetimeoffset", "datetime"),
     ("date", "datetime"), ("bit", None), ("varchar", None), ("time", None)],
)
def test_watermark_family(name, family):
    assert types.watermark_family(name) == family


@pytest.mark.parametrize(
    "name, base",
    [("int", "INTEGER"), ("INTEGER", "INTEGER"), ("timestamp", "STRING"), ("bit", "BOOLEAN"), ("xml", "STRING"),
     ("date", "DATE"), ("smalldatetime", "TIMESTAMP"), ("smallmoney", "NUMERIC"), ("float", "FLOAT"),
     ("USER_DEFINED_TYPE", "STRING")],
)
def test_base_type(name, base):
    assert types.base_type(name) == base


def test_column_rules_agree_with_name_rules(spark):
    names = sorted({n for group in types.BASE_TYPES.values() for n in group} | {"xml", "timestamp", "time", "INT"})
    df = spark.createDataFrame([(n,) for n in names], "t string")
    for t, base, family in df.select("t", types.base_type_col(F.col("t")), types.watermark_family_col(F.col("t"))).collect():
        assert (base, family) == (types.base_type(t), types.watermark_family(t))


@pytest.mark.parametrize(
    "data_type, default, unwrapped",
    [("int", "((12345))", "12345"), ("int", "12345", "12345"), ("decimal", "((123.45))", "123.45"),
     ("decimal", "123.45", "123.45"), ("varchar", "((12345))", "((12345))"), ("varchar", "12345", "12345"),
     ("INT", "((-1))", "-1"), ("int", None, None)],
)
def test_default_unwrap(spark, data_type, default, unwrapped):
    df = spark.createDataFrame([(data_type, default)], "t string, d string")
    assert df.select(types.default_unwrap_col(F.col("t"), F.col("d"))).first()[0] == unwrapped


@pytest.mark.parametrize(
    "data_type, precision, scale, chars, length",
    [("datetime", 23, 3, None, None), ("decimal", 10, 2, None, "10,2"), ("int", 10, 0, 4, "10"), ("int", 10, None, 4, "10"),
     ("varchar", None, None, 55, "55"), ("varchar", 0, 0, -1, None), ("text", 0, 0, 16, None), ("ntext", 0, 0, 16, "16"),
     ("xml", None, None, None, None)],
)
def test_field_length(spark, data_type, precision, scale, chars, length):
    row = [(data_type, precision, scale, chars)]
    df = spark.createDataFrame(row, "t string, p int, s int, n int")
    assert df.select(types.field_length_col(*(F.col(c) for c in "tpsn"))).first()[0] == length


def test_source_type_comes_from_metadata_or_spark_type(spark):
    df = types.with_source_types(spark.createDataFrame([(1, "a")], "id long, doc string"), {"doc": "XML"})
    assert [types.source_type(f) for f in df.schema.fields] == ["bigint", "xml"]
    with pytest.raises(TypeError):
        types.source_type(T.StructField("a", T.ArrayType(T.StringType())))
