"""Reshape (A7, A8, O1-O4), text parsing (L10), rounding (T5) and quality checks (Q1-Q8)."""

import pytest
from pyspark.sql import functions as F

from conftest import FIXTURES, rows
from yearloom.functions.text import below_threshold, parse_number_text
from yearloom.operators.columns import (drop_by_pattern, remove_empty, round_numeric, where_matches, where_present)
from yearloom.operators.quality import (QualityError, assert_empty, coverage_gaps, nonmatch, unique_rows,
                                        unit_differences, unit_map_violations, warn_unit_differences)
from yearloom.operators.reshape import pivot_longer, pivot_wider, sort_nulls_last, union_by_name, year_columns
from yearloom.operators.units.algebra import unit_factor_table
from yearloom.plans.harmonize import change_tracker, clean_inventory, wide_table
from yearloom.sources.readers import read_base_csv

IDS = ["model", "scenario", "region", "variable", "unit"]


def _long(spark):
    return spark.createDataFrame([
        ("AEO.2021", "REF2021", "USA", "V1", "EJ/yr", 2020, 1.0),
        ("AEO.2021", "REF2021", "USA", "V1", "EJ/yr", 2030, 2.0),
        ("EIAHistoric", "Historic", "USA", "V1", "EJ/yr", 2020, 3.0),
        ("EIA_STEO", "Ref", "USA", "V2", "GW", 2021, 4.0),
        ("Other", "Other", "USA", "V3", "GW", 2021, 5.0),
    ], "model string, scenario string, region string, variable string, unit string, year int, value double")


def test_pivot_then_unpivot_is_long_minus_missing(spark):
    long = _long(spark)
    wide = pivot_wider(long, IDS, "year", "value", [2020, 2021, 2030])
    assert wide.columns == IDS + ["2020", "2021", "2030"]
    back = pivot_longer(wide, IDS, ["2020", "2021", "2030"]).where(F.col("value").isNotNull())
    back = back.withColumn("year", F.col("year").cast("int"))
    assert rows(back.select(*IDS, "year", "value")) == rows(long)


def test_wide_table_tags_sources_and_drops_untagged(spark):
    w = wide_table(_long(spark), [2020, 2021, 2030])
    got = {(r.model, r.variable): r for r in w.collect()}
    assert set(got) == {("AEO.2021", "V1"), ("EIA_Historic", "V1"), ("EIA_STEO", "V2")}
    assert got[("AEO.2021", "V1")]["2030"] == 2.0


def test_duplicate_cells_are_rejected_t11(spark):
    long = union_by_name([_long(spark), _long(spark).where("model = 'EIA_STEO'")])
    with pytest.raises(QualityError, match="more than one value"):
        wide_table(long, [2021])


def test_union_by_name_fills_missing_columns(spark):
    a = spark.createDataFrame([("m", 1.0)], "model string, `2020` double")
    b = spark.createDataFrame([("n", 2.0, 3.0)], "model string, `2030` double, `1990` double")
    u = union_by_name([a, b])
    assert u.columns == ["model", "2020", "2030", "1990"]
    assert rows(u) == [("m", 1.0, None, None), ("n", None, 2.0, 3.0)]
    assert year_columns(u) == ["2020", "2030", "1990"]


def test_sort_nulls_last(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "v string")
    assert [r.v for r in sort_nulls_last(df, ["v"]).collect()] == ["a", "b", None]
    assert [r.v for r in sort_nulls_last(df, ["v"], descending=True).collect()] == ["b", "a", None]


def test_inventory_golden_cells(spark):
    raw = read_base_csv(spark, str(FIXTURES / "inventory_wide.csv"))
    years = [str(y) for y in range(1990, 2021)]
    assert raw.count() == 56
    long = pivot_longer(raw.drop("model", "scenario"), ["variable", "region", "unit"], years, "year", "cell")
    stats = long.agg(
        F.count_if(F.col("cell") == "+").alias("plus"),
        F.count_if(F.col("cell").contains(",")).alias("comma"),
        F.count_if(parse_number_text("cell").isNotNull() & ~F.col("cell").contains(",")).alias("plain"),
        F.count_if(below_threshold("cell")).alias("flag"),
    ).first()
    assert (stats.plain, stats.comma, stats.plus, stats.flag) == (1404, 122, 210, 210)
    first = long.where("variable = 'Emissions|CO2|Energy' AND year = '1990'").select(parse_number_text("cell")).first()[0]
    assert first == pytest.approx(4731.2)
    assert raw.select("variable").distinct().count() == 29


def test_clean_inventory(spark):
    raw = spark.createDataFrame([("A", "USA", "MMTCO2e", "1", "x"), ("", "USA", "MMTCO2e", "2", "x"),
                                 ("B", "USA", "kt", "3", "x")], "variable string, region string, unit string, `1990` string, gas string")
    got = clean_inventory(raw).collect()
    assert len(got) == 1 and got[0].unit == "MMTCO2/yr" and got[0].model == "EPA.GHGI" and "gas" not in got[0]


def test_round_half_up_on_decimal_t5(spark):
    df = spark.createDataFrame([("m", "s", "r", "v", "u", 0.285, 0.125, 2.675)],
                               "model string, scenario string, region string, variable string, unit string, "
                               "`2020` double, `2030` double, `2040` double")
    got = change_tracker(df, [2020, 2030, 2040]).first()
    assert (got["2020"], got["2030"], got["2040"]) == (0.29, 0.13, 2.68)


def test_filters_and_columns(spark):
    df = spark.createDataFrame([("AEO.2021", 1.0, "x", None), ("aeo.x", float("nan"), "y", None), (None, 2.0, "z", None)],
                               "model string, value double, Comments_a string, notes_b string")
    assert where_matches(df, "model", "AEO").count() == 2
    assert where_present(df, "value").count() == 2
    assert drop_by_pattern(df, regex="comments", prefix="NOTES").columns == ["model", "value"]
    assert remove_empty(df).columns == ["model", "value", "Comments_a"]
    r = round_numeric(spark.createDataFrame([(1.005, "a")], "x double, s string")).first()
    assert r.x == 1.01 and r.s == "a"


def test_quality_violations(spark):
    long = _long(spark)
    dup = union_by_name([long, long.limit(1)])
    assert unique_rows(dup, IDS + ["year"]).count() == 1
    with pytest.raises(QualityError):
        assert_empty(unique_rows(dup, IDS + ["year"]), "dup")
    xw = spark.createDataFrame([("a", "x"), ("a", None), ("b", "y"), ("b", "y")], "from_unit string, to_unit string")
    assert [(r.from_unit, r.n_targets) for r in unit_map_violations(xw).collect()] == [("a", 2)]
    conv = long.withColumn("emf_units", F.when(F.col("variable") == "V1", "EJ/yr").when(F.col("variable") == "V2", "MW"))
    assert rows(nonmatch(conv).select("variable")) == [("V2",)]          # V3 has no template unit: passes
    bench = spark.createDataFrame([("V1", "EJ/yr"), ("V2", "MW")], "variable string, unit string")
    diff = unit_differences(long, bench)
    assert rows(diff.select("variable", "unit", "benchmark_unit")) == [("V2", "GW", "MW")]
    with pytest.warns(UserWarning):
        warn_unit_differences(long, bench)


def test_coverage_gaps(spark):
    data = spark.createDataFrame([("V1",), ("V9",)], "variable string")
    template = spark.createDataFrame([("V1", "EJ/yr"), ("V2", "GW")], "variable string, unit string")
    smap = spark.createDataFrame([("s", "V1")], "series_id string, variable string")
    pairs = unit_factor_table(spark.createDataFrame([("GW", "EJ/yr"), ("TJ", "EJ/yr")], "from_unit string, to_unit string"))
    got = rows(coverage_gaps(data, template, smap, pairs))
    assert got == [("template_variable_unmapped", "V2"), ("unit_not_convertible", "GW -> EJ/yr"),
                   ("variable_not_in_template", "V9")]


def test_frequency_violations_t14(spark):
    from yearloom.operators.quality import frequency_violations

    obs = spark.createDataFrame([("STEO.GDPQXUS", 2020, 1.0), ("STEO.GDPQXUS", 2020, 2.0), ("X.A", 2020, 3.0)],
                                "series_id string, year int, value double")
    assert rows(frequency_violations(obs)) == [("STEO.GDPQXUS", 2020, 2)]
