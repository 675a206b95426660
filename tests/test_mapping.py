"""Mapping side: F1 on the real mapping files, F2 grid, F3/L3 interpolation, W2 batches."""

from collections import Counter

from pyspark.sql import functions as F

from conftest import FIXTURES, rows
from yearloom.functions.text import interpolate_template, paste0, when_r
from yearloom.operators.aggregate import key_batches
from yearloom.plans.mapping import (build_series_map, clean_mapping, expand_industry_map, instantiate_template,
                                    series_key_batches, tag_mapping)
from yearloom.sources.readers import read_mapping_csv


def _clean(spark, name):
    return clean_mapping(read_mapping_csv(spark, str(FIXTURES / name)))


def test_clean_steo_mapping(spark):
    raw = read_mapping_csv(spark, str(FIXTURES / "mapping_short_term.csv"))
    assert raw.columns[0] == "Variable" and raw.count() == 37       # byte-order mark handled
    df = _clean(spark, "mapping_short_term.csv")
    assert df.columns == ["variable", "series_name", "series_id", "factor"]
    got = df.collect()
    assert len(got) == 31
    assert len({r.variable for r in got}) == 31 and len({r.series_id for r in got}) == 31
    assert Counter(r.factor for r in got) == {1.0: 29, 365.0: 2}


def test_clean_historical_mapping(spark):
    got = _clean(spark, "mapping_historical.csv").collect()
    assert len(got) == 61
    assert len({r.variable for r in got}) == 49 and len({r.series_id for r in got}) == 48
    assert Counter(r.factor for r in got) == {1.0: 55, -1.0: 6}
    multi = [v for v, n in Counter(r.variable for r in got).items() if n > 1]
    assert len(multi) == 10


def test_tag_and_union(spark):
    steo = tag_mapping(_clean(spark, "mapping_short_term.csv"), "EIA_STEO", "Ref")
    hist = tag_mapping(_clean(spark, "mapping_historical.csv"), "EIAHistoric", "Historic")
    m = build_series_map(steo, hist)
    assert m.columns == ["dataset", "scenario", "region", "series_id", "variable", "factor"]
    assert m.count() == 92
    b = series_key_batches(m, 10).collect()
    assert len(b) == 31 + 48 and max(r.batch for r in b) == 8
    assert sorted(r.key_index for r in b) == list(range(1, 80))


def test_interpolation_first_occurrence_only(spark):
    df = spark.createDataFrame([("{EIA_pub}.{EIA_scenario}.RESTOFIT5678",), ("{EIA_pub}.{EIA_pub}.X",), ("NOPLACE",)],
                               "t string")
    out = df.select(interpolate_template(F.col("t"), {"EIA_pub": "AEO.2021", "EIA_scenario": "REF2021"}).alias("k"))
    assert [r.k for r in out.collect()] == ["AEO.2021.REF2021.RESTOFIT5678", "AEO.2021.{EIA_pub}.X", "NOPLACE"]


def test_instantiate_template_grid(spark):
    t = spark.createDataFrame([("V|A", "{EIA_dataset}.{EIA_scenario}.A", 1.0)], "variable string, series_template string, factor double")
    out = instantiate_template(t)
    got = out.collect()
    assert len(got) == 9
    assert {r.series_id for r in got} == {f"{d}.{s}.A" for d in ("AEO.2020", "AEO.2021", "AEO.2022")
                                          for s in ("REF2020", "REF2021", "REF2022")}
    assert all(r.series_id.startswith(r.dataset + "." + r.scenario) for r in got)


def test_paste0_and_r_ifelse(spark):
    df = spark.createDataFrame([("a", None), ("", "x"), (None, "y")], "s string, t string")
    out = df.select(paste0(F.col("s"), "-", F.col("t")).alias("p"),
                    when_r(F.col("s") != "", F.lit("yes"), F.lit("no")).alias("w")).collect()
    assert [r.p for r in out] == ["a-NA", "-x", "NA-y"]
    assert [r.w for r in out] == ["yes", "no", None]


def test_expand_industry_map(spark):
    ind = spark.createDataFrame([
        ("Iron", "Heavy", "IS", "", "Industrial", "n1"),
        ("Iron", "Heavy", "IS", "", "Industrial", "n1"),       # duplicate row: distinct
        ("", "Heavy", "XX", "", "Industrial", "n2"),           # blank name: dropped
        ("Food", "Light", "FD", "Bakery", "Industrial", None),
    ], "EMF_industry_name string, EMF_main_sector string, EIA_abbrev string, EIA_subsector string, "
       "EIA_main_sector string, notes_ind_map string")
    var = spark.createDataFrame([
        ("Electricity", "Energy", "CNSM_", "ELC", "_NA", "electricity", "v1"),
        ("CO2", "Emissions", "EMI_", "CO2", "_NA", "co2", "v2"),
        ("Value", "Output", "OUT_", "VAL", None, "value", "v3"),
        ("Weird", "Other", "W_", "W", "", "weird", "v4"),
    ], "EMF_subcategory string, EMF_category string, EIA_prefix string, EIA_energy_code string, "
       "EIA_suffix string, EIA_category_name string, notes_var_map string")
    base = spark.createDataFrame([("Base|Var", "{EIA_dataset}.{EIA_scenario}.B", "base", 1.0)],
                                 "Variable string, Series_template string, Series_Name string, Factor double")
    out = expand_industry_map(ind, var, base)
    got = out.collect()
    assert len(got) == 1 + 2 * 4
    by = {(r.Series_template): r for r in got}
    r = by["{EIA_dataset}.{EIA_scenario}.CNSM_IS_ELC_NA"]
    assert r.Variable == "Final Energy|Industry|Heavy|Iron|Electricity"
    assert r.Series_Name == "Industrial : electricity"
    assert by["{EIA_dataset}.{EIA_scenario}.EMI_FD_CO2_NA"].Variable == "Emissions|CO2|Energy|Demand|Industry|Light|Food"
    assert by["{EIA_dataset}.{EIA_scenario}.EMI_FD_CO2_NA"].Series_Name == "Industrial : Bakery : co2"
    assert by["{EIA_dataset}.{EIA_scenario}.OUT_IS_VALNA"].Variable == "Output|Industry|Heavy|Iron|Value"
    assert by["{EIA_dataset}.{EIA_scenario}.W_IS_W"].Variable is None        # unknown category -> dropped by F1
    assert by["{EIA_dataset}.{EIA_scenario}.EMI_FD_CO2_NA"].notes == "v2. NA"


def test_key_batches_distributed_numbering(spark):
    keys = spark.range(0, 2500).select((F.col("id") * 7 % 2503).alias("k")).union(spark.createDataFrame([(None,)], "k long"))
    got = rows(key_batches(keys, "k", 100))
    assert len(got) == 2500
    ordered = sorted(got)
    assert [r[1] for r in ordered] == list(range(1, 2501))
    assert all(r[2] == (r[1] + 99) // 100 for r in ordered)


def test_interpolate_key_column_drops_parameters(spark):
    from yearloom.functions.text import interpolate_key_column

    df = spark.createDataFrame([("{EIA_pub}.{EIA_scenario}.RESTOFIT5678", "AEO.2020", "REF2020", 1)],
                               "EIA_template string, EIA_pub string, EIA_scenario string, other int")
    out = interpolate_key_column(df, {"EIA_pub": "AEO.2021", "EIA_scenario": "REF2021"})
    assert out.columns == ["other", "EIA_key"]
    assert out.first().EIA_key == "AEO.2021.REF2021.RESTOFIT5678"


def test_catalog_and_template_subset(spark):
    from yearloom.plans.mapping import VALID_REGIONS, restrict_to_catalog, template_subset

    assert len(VALID_REGIONS) == 51 and VALID_REGIONS[0] == "USA"
    m = spark.createDataFrame([("REF2020", "USA"), ("REF2020", "XX"), ("ODD", "CA")], "scenario string, region string")
    assert rows(restrict_to_catalog(m)) == [("REF2020", "USA")]
    t = spark.createDataFrame([("a", "beta", 1), ("b", "beta", 3), ("c", "alpha", 1)], "variable string, round string, tier int")
    assert [r.variable for r in template_subset(t).collect()] == ["a"]
