"""Conversion modes (U4-U12), crosswalk checks (Q2, T7, T9, T10), properties."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from yearloom.operators.units.convert import (UnitConversionError, convert_crosswalk, convert_from_set,
                                              convert_rowwise, convert_to_single, convert_units, convert_value_columns,
                                              pack_units, unpack_units)

Q_BTU = 1e15 * 1055.05585262 / 1e18


@pytest.fixture()
def facts(spark):
    return spark.createDataFrame([
        (1, "quadrillion Btu", 2.0), (2, "GW", 5.0), (3, "million metric tons CO2", 7.0),
        (4, "billion kilowatthours", 10.0), (5, "EJ/yr", 1.0), (6, None, 3.0),
    ], "id int, unit string, value double")


def _by_id(df):
    return {r.id: (r.unit, r.value) for r in df.collect()}


def test_rowwise(spark, facts):
    to = (F.when(F.col("unit") == "GW", F.lit(None)).when(F.col("unit").contains("CO2"), F.lit("Mt CO2/yr"))
          .otherwise(F.lit("EJ/yr")))
    got = _by_id(convert_rowwise(facts, to))
    assert got[1][0] == "EJ/yr" and math.isclose(got[1][1], 2 * Q_BTU, rel_tol=1e-12)
    assert got[2] == ("GW", 5.0)                          # missing target: untouched
    assert got[3] == ("Mt CO2/yr", 7.0)
    assert got[5] == ("EJ/yr", 1.0)                       # same unit: no conversion
    assert got[6] == (None, 3.0)


def test_rowwise_inconvertible_raises_or_keeps(spark, facts):
    with pytest.raises(Exception, match="cannot convert 'GW' to 'EJ/yr'"):
        convert_rowwise(facts, F.lit("EJ/yr")).collect()
    got = _by_id(convert_rowwise(facts, F.lit("EJ/yr"), on_inconvertible="keep"))
    assert got[2] == ("GW", 5.0) and got[4][0] == "EJ/yr"


def test_single_target_converts_only_convertible(spark, facts):
    got = _by_id(convert_to_single(facts, "EJ/yr"))
    assert got[1][0] == "EJ/yr" and got[4] == ("EJ/yr", pytest.approx(0.036))
    assert got[2] == ("GW", 5.0) and got[3] == ("million metric tons CO2", 7.0)


def test_from_set(spark, facts):
    got = _by_id(convert_from_set(facts, ["billion kilowatthours"], "EJ/yr"))
    assert got[4][0] == "EJ/yr" and got[1] == ("quadrillion Btu", 2.0)


def test_crosswalk_list_and_frame(spark, facts):
    xw = [("quadrillion Btu", "EJ/yr"), ("GW", None)]
    a = rows(convert_crosswalk(facts, xw))
    b = rows(convert_crosswalk(facts, spark.createDataFrame(xw, "from_unit string, to_unit string")))
    assert a == b
    assert dict((r[0], r[1]) for r in a)[2] == "GW"


def test_crosswalk_two_targets_is_an_error_t9(spark, facts):
    with pytest.raises(UnitConversionError, match="more than one target"):
        convert_crosswalk(facts, [("GW", "GW"), ("GW", None)])
    with pytest.raises(UnitConversionError, match="more than one target"):
        convert_crosswalk(facts, spark.createDataFrame([("GW", "GW"), ("GW", "MW")], "from_unit string, to_unit string"))
    got = _by_id(convert_crosswalk(facts, [("GW", "MW"), ("GW", None)], strict=False))
    assert got[2] == ("MW", pytest.approx(5000.0))


def test_crosswalk_inconvertible_pair_t10(spark, facts):
    with pytest.raises(Exception, match="cannot convert"):
        convert_crosswalk(facts, [("GW", "EJ/yr")])
    got = _by_id(convert_crosswalk(facts, [("GW", "EJ/yr")], on_inconvertible="keep"))
    assert got[2] == ("GW", 5.0)


def test_rowwise_joins_on_from_and_to_t7(spark):
    # the same from-unit with two different row targets converts each row to its own target
    df = spark.createDataFrame([(1, "GW", 1.0, "MW"), (2, "GW", 1.0, "kW")], "id int, unit string, value double, t string")
    got = _by_id(convert_rowwise(df, F.col("t")).drop("t"))
    assert got == {1: ("MW", pytest.approx(1000.0)), 2: ("kW", pytest.approx(1e6))}


def test_dispatcher(spark, facts):
    assert rows(convert_units(facts, to_unit="EJ/yr")) == rows(convert_to_single(facts, "EJ/yr"))
    assert rows(convert_units(facts, from_unit=["GW"], to_unit="MW")) == rows(convert_from_set(facts, ["GW"], "MW"))
    with pytest.raises(UnitConversionError):
        convert_units(facts, from_unit=["GW", "EJ"], to_unit=["MW", "TJ", "PJ"])


def test_there_and_back_is_identity(spark, facts):
    there = convert_crosswalk(facts, [("quadrillion Btu", "EJ/yr"), ("billion kilowatthours", "TJ")])
    back = convert_crosswalk(there.withColumn("orig", F.lit(1)), [("EJ/yr", "quadrillion Btu"), ("TJ", "billion kilowatthours")])
    a, b = _by_id(facts), _by_id(back)
    for k in (1, 4):
        assert a[k][0] == b[k][0] and math.isclose(a[k][1], b[k][1], rel_tol=1e-12)


def test_value_columns_and_pack_unpack(spark):
    df = spark.createDataFrame([(2.0, "GW", "MW"), (3.0, "GW", "GW"), (1.0, "GW", "EJ")],
                               "v double, f string, t string")
    got = [r.to_value for r in convert_value_columns(df, "v", "f", "t").orderBy("v").collect()]
    assert got[0] is None and got[1] == pytest.approx(2000.0) and got[2] == 3.0
    facts = spark.createDataFrame([(1, "GW", 2.0)], "id int, unit string, value double")
    packed = pack_units(facts)
    assert packed.columns == ["id", "quantity"]
    assert rows(unpack_units(packed)) == [(1, 2.0, "GW")]


def test_input_checks(spark):
    with pytest.raises(UnitConversionError):
        convert_to_single(spark.createDataFrame([(1.0,)], "value double"), "EJ")
    with pytest.raises(UnitConversionError):
        convert_to_single(spark.createDataFrame([(1.0, 2)], "value double, unit int"), "EJ")


def test_convert_with_default_targets_u11(spark):
    from yearloom.plans.harmonize import convert_with_default_targets

    df = spark.createDataFrame([(1, "quads", 2.0, "EJ"), (2, "GW", 3.0, None), (3, "MMmt CO2", 4.0, "Mt CO2/yr")],
                               "id int, unit string, value double, emf_units string")
    got = _by_id(convert_with_default_targets(df))
    assert got[1][0] == "EJ/yr" and math.isclose(got[1][1], 2 * Q_BTU, rel_tol=1e-12)   # display name mapped back
    assert got[2] == ("GW", 3.0)                                                       # default target: own unit
    assert got[3] == ("Mt CO2/yr", 4.0)
