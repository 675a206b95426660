"""Operators without a catalogue query of their own: S4, P2/O3, P7, L9, L14, O6."""

from pyspark.sql import functions as F

from conftest import rows
from yearloom.functions.text import ceil_div, grepl
from yearloom.operators.columns import relocate, rename, select_existing
from yearloom.operators.reshape import sort_existing
from yearloom.sources.readers import template_units_from_mapping


def test_template_units_from_mapping_s4(spark):
    m = spark.createDataFrame([("V1", "EJ/yr", "x"), ("V1", "EJ/yr", "y"), ("V2", "GW", "z")],
                              "Variable string, EMF_Units string, Series_ID string")
    assert rows(template_units_from_mapping(m)) == [("V1", "EJ/yr"), ("V2", "GW")]


def test_select_relocate_rename_sort(spark):
    df = spark.createDataFrame([(2, "b", "x"), (1, None, "y")], "year int, unit string, dataset string")
    assert select_existing(df, ["dataset", "missing", "year"]).columns == ["dataset", "year"]
    assert relocate(df, ["dataset", "unit"]).columns == ["dataset", "unit", "year"]
    assert rename(df, {"dataset": "model", "nope": "x"}).columns == ["year", "unit", "model"]
    assert [r.year for r in sort_existing(df, ["unit", "gone"]).collect()] == [2, 1]      # missing unit last


def test_grepl_and_ceil_div(spark):
    df = spark.createDataFrame([("Primary Energy|Coal",), ("Emissions|CO2|Energy",), (None,)], "v string")
    got = df.select(grepl("v", "coal", ignore_case=True).alias("a"),
                    grepl("v", "Emissions|CO2", fixed=True).alias("b"),
                    grepl("v", "Emissions|CO2").alias("c")).collect()
    assert [r.a for r in got] == [True, False, False]
    assert [r.b for r in got] == [False, True, False]     # fixed: '|' is literal
    assert [r.c for r in got] == [False, True, False]     # regex: alternation, missing -> false
    n = spark.range(1, 202).select(ceil_div(F.col("id"), 100).alias("b")).distinct()
    assert sorted(r.b for r in n.collect()) == [1, 2, 3]
