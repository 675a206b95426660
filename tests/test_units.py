"""Unit names, registry, factor algebra and relabel rules."""

import csv
import math

import pytest
from pyspark.sql import functions as F

from conftest import FIXTURES
from yearloom.functions.unit_names import (SOURCE_UNIT_ALIASES, TEMPLATE_DISPLAY_NAMES, map_whole_values,
                                           relabel_units, standardize_unit_names, standardize_unit_names_alt)
from yearloom.operators.units.algebra import resolve_unit_expressions, unit_factor_table, unit_lookup
from yearloom.operators.units.registry import UnitDef, registry_rows, unit_registry

GOLDEN = list(csv.DictReader(open(FIXTURES / "unit_crosswalk_golden.csv")))

# Factor column of the golden table (10 significant digits), derived from the
# unit definitions with Btu = 1055.05585262 J.
EXPECTED_FACTORS = {
    "2019 $/b": 0.1658322226, "2019 $/MMBtu": 0.9449119655, "2020 $/b": 0.1697606428,
    "2020 $/MMBtu": 0.9672961027, "2021 $/b": 0.1530035272, "2021 $/MMBtu": 0.8718140622,
    "billion 2012  $": 1.045187953, "billion 2012 $": 1.045187953, "Billion Btu": 1.055055853e-06,
    "billion chained 2012 dollars (seasonally-adjusted annual rate)": 1.045187953,
    "billion cubic_feet": 0.001094092919, "billion kilowatthours": 0.0036, "BkWh": 0.0036,
    "cents per kilowatt hour": 2.777777778, "dollars per million Btu": 0.9478171203, "GW": 1.0,
    "million barrelnew": 0.006011708, "million kilowatts": 1.0, "million metric tons CO2": 1.0,
    "Million Metric Tons of Carbon Dioxide": 1.0, "million short_tons_coal": 0.01991417922, "MMmt CO2": 1.0,
    "quadrillion Btu": 1.055055853, "Quadrillion Btu": 1.055055853, "quads": 1.055055853,
    "thousand megawatthours": 3.6e-06, "trillion Btu": 0.001055055853, "Trillion Btu": 0.001055055853,
}


def test_alias_fold_reproduces_the_28_golden_rows(spark):
    df = spark.createDataFrame([(r["from_unit"], r["to_unit"]) for r in GOLDEN], "f string, t string")
    got = df.select("f", standardize_unit_names(F.col("f")).alias("fs"), standardize_unit_names(F.col("t")).alias("ts"))
    got = {r.f: (r.fs, r.ts) for r in got.collect()}
    assert len(got) == 28
    for r in GOLDEN:
        assert got[r["from_unit"]] == (r["from_units_unit"], r["to_units_unit"]), r["from_unit"]


def test_alias_fold_order_and_per_rule(spark):
    df = spark.createDataFrame([("percent",), ("2019 $/b",), ("2019 cents",), ("Mt CO2/yr",)], "u string")
    got = [r[0] for r in df.select(standardize_unit_names(F.col("u"))).collect()]
    # "per" is rewritten last and also hits "percent"; order keeps the longer aliases first
    assert got == ["/cent", "US_2019_Dollar/barrelnew", "US_2019_cent", "Million_ton_CO2_yr"]


def test_golden_factors(spark):
    pairs = spark.createDataFrame([(r["from_unit"], r["to_unit"]) for r in GOLDEN], "from_unit string, to_unit string")
    got = {r.from_unit: r for r in unit_factor_table(pairs).collect()}
    for unit, expected in EXPECTED_FACTORS.items():
        assert got[unit].convertible, unit
        assert math.isclose(got[unit].factor, expected, rel_tol=1e-9), (unit, got[unit].factor, expected)


def test_doc_example_five_million_btu_is_five_mmbtu(spark):
    pairs = spark.createDataFrame([("Btu", "MMBtu")], "from_unit string, to_unit string")
    f = unit_factor_table(pairs).first().factor
    assert math.isclose(5_000_000 * f, 5.0, rel_tol=1e-12)


def test_inconvertible_and_unknown(spark):
    pairs = spark.createDataFrame([("GW", "EJ/yr"), ("quads", "Mt CO2/yr"), ("furlongs", "EJ/yr"), ("EJ", "EJ/yr")],
                                  "from_unit string, to_unit string")
    got = {(r.from_unit, r.to_unit): r for r in unit_factor_table(pairs).collect()}
    assert not got[("GW", "EJ/yr")].convertible and got[("GW", "EJ/yr")].factor is None
    assert not got[("quads", "Mt CO2/yr")].convertible
    assert not got[("furlongs", "EJ/yr")].convertible
    assert got[("EJ", "EJ/yr")].factor == 1.0


def test_resolution_rules(spark):
    exprs = spark.createDataFrame([("kilowatts",), ("Billion btu",), ("kg m m / s s",), ("mW",), ("mw",), ("3 kWh",)],
                                  "expr string")
    got = {r.expr: r for r in resolve_unit_expressions(exprs).collect()}
    assert got["kilowatts"].resolved and got["kilowatts"].scale == 1000.0     # plural + prefix
    assert got["Billion btu"].resolved                                          # case variants registered
    dims = {d.dim: d.exp for d in got["kg m m / s s"].dims}
    assert dims == {"kg": 1, "m": 2, "s": -2}                                   # product and quotient
    assert got["mW"].scale == pytest.approx(1e-3)
    assert not got["mw"].resolved                                               # symbols are case-sensitive
    assert got["3 kWh"].scale == pytest.approx(3 * 3.6e6)                      # numeric tokens


def test_registry_is_bounded_and_extensible(spark):
    rows = registry_rows()
    assert 300 < len(rows) < 2000
    names = {r[0] for r in rows}
    assert {"GJ", "EJ", "kWh", "megawatthour", "barrelnew", "US_2021_cent"} <= names
    extra = [UnitDef(("US_2022_Dollar",), multiplier=106.10422 / 120.0, of="US_2018_Dollar")]
    reg = unit_registry(spark, extra=extra)
    pairs = spark.createDataFrame([("US_2022_Dollar", "USD")], "from_unit string, to_unit string")
    f = unit_factor_table(pairs, rename_fun=lambda c: c, registry=reg).first().factor
    assert math.isclose(f, 106.10422 / 120.0, rel_tol=1e-12)


def test_variant_registry(spark):
    lk = unit_lookup(registry_rows(variant=True))
    pairs = spark.createDataFrame([("MMTCO2e", "kt"), ("hundredweight", "pound")], "from_unit string, to_unit string")
    got = {r.from_unit: r.factor for r in unit_factor_table(pairs, rename_fun=lambda c: c, registry=lk).collect()}
    assert math.isclose(got["MMTCO2e"], 1000.0, rel_tol=1e-12)   # 1e6 t = 1000 kt
    assert math.isclose(got["hundredweight"], 100.0, rel_tol=1e-12)


RELABEL_CASES = [
    # variable, unit, expected (rules R1-R5, trap T1)
    ("Supply|Liquids", "million barrels per day", "million barrelnew"),
    ("Supply|Gas", "billion cubic feet per day", "billion cubic_feet"),
    ("Emissions|CO2|Energy", "million metric tons", "million metric tons CO2"),
    ("EmissionsXCO2", "million metric tons", "million metric tons"),          # '|' is literal, not alternation
    ("Primary Energy|Coal", "million short tons", "million short_tons_coal"),
    ("Primary Energy|coal", "Million Short Tons", "Million Short Tons"),     # guard matches, replacement does not
    ("Primary Energy|Gas", "million short tons", "million short tons"),
    ("X", "million barrels", "million barrelnew"),                            # longest match: not 'barrelnews'
    ("X", "million barrel", "million barrelnew"),
    (None, "million metric tons", "million metric tons"),                     # missing guard -> keep
]


def test_relabel_rules(spark):
    df = spark.createDataFrame([(v, u) for v, u, _ in RELABEL_CASES], "variable string, unit string")
    got = [r[0] for r in df.select(relabel_units(F.col("variable"), F.col("unit"))).collect()]
    assert got == [e for _, _, e in RELABEL_CASES]


def test_alt_normaliser_and_whole_value_maps(spark):
    df = spark.createDataFrame([("Tg CO2 Eq.",), ("quads",), ("cwt. per acre",), ("MMmt CO2",)], "u string")
    alt = [r[0] for r in df.select(standardize_unit_names_alt(F.col("u"), [["MMTCO2e", "Tg CO2 Eq."]])).collect()]
    assert alt[0] == "MMTCO2e"
    assert alt[1] == "quadrillion Btu"   # alias applied after spaces became '*'

    assert alt[2] == "hundredweight/acre"
    disp = [r[0] for r in df.select(map_whole_values(F.col("u"), TEMPLATE_DISPLAY_NAMES)).collect()]
    assert disp[3] == "Mt CO2/yr" and disp[1] == "quads"
    src = [r[0] for r in df.select(map_whole_values(F.col("u"), SOURCE_UNIT_ALIASES)).collect()]
    assert src[3] == "MMTCO2e"


def test_factor_algebra_is_consistent(spark):
    """Property over registry units of the same dimension: a->b times b->a is 1,
    and a->b times b->c equals a->c."""
    import random

    energy = ["Btu", "MMBtu", "kWh", "GJ", "EJ", "barrelnew", "cubic_feet", "short_tons_coal", "megawatthour", "TJ"]
    money = ["cent", "dollar", "US_2012_Dollar", "US_2019_Dollar", "US_2021_cent"]
    rnd = random.Random(7)
    triples = [tuple(rnd.sample(group, 3)) for group in (energy, money) for _ in range(6)]
    pairs = {(a, b) for t in triples for a, b in ((t[0], t[1]), (t[1], t[0]), (t[1], t[2]), (t[0], t[2]))}
    df = spark.createDataFrame(sorted(pairs), "from_unit string, to_unit string")
    f = {(r.from_unit, r.to_unit): r.factor for r in unit_factor_table(df, rename_fun=lambda c: c).collect()}
    for a, b, c in triples:
        assert math.isclose(f[(a, b)] * f[(b, a)], 1.0, rel_tol=1e-12)
        assert math.isclose(f[(a, b)] * f[(b, c)], f[(a, c)], rel_tol=1e-12)
