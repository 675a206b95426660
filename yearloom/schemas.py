"""Declared schemas of the tables the library reads and writes."""

from pyspark.sql import types as T

OBSERVATIONS = T.StructType([
    T.StructField("series_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("unit", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

SERIES_PAYLOAD = T.StructType([
    T.StructField("series_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("units", T.StringType()),
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("year", T.StringType()),   # text: a point that fails to parse is reported, not lost
        T.StructField("value", T.StringType()),
    ]))),
])

TEMPLATE = T.StructType([
    T.StructField("variable", T.StringType()),
    T.StructField("unit", T.StringType()),
])

LONG_COLUMNS = ["model", "scenario", "region", "variable", "unit", "year", "value"]
WIDE_ID_COLUMNS = ["model", "scenario", "region", "variable", "unit"]
