"""Roll-up (A1, W1), joins (J1-J3) and the full-outer rewrite (4.2, T2, T4, T6, T12)."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from yearloom.operators.aggregate import first_per_key, group_total_keep_rows
from yearloom.operators.joins import full_outer_join, full_outer_with_dim, join_dim, semi_join
from yearloom.plans.harmonize import attach_units, map_and_rollup, template_units_present

MAP_SCHEMA = "dataset string, scenario string, region string, series_id string, variable string, factor double"
OBS_SCHEMA = "series_id string, name string, year int, unit string, value double"


def test_negative_factor_rollup_and_missing_member(spark):
    # Emissions|CO2|Energy|Demand|Buildings = TECCEUS + TERCEUS - ESRCEUS - ESCCEUS
    m = spark.createDataFrame([("H", "Historic", "USA", s, "Buildings", f) for s, f in
                               [("TEC", 1.0), ("TER", 1.0), ("ESR", -1.0), ("ESC", -1.0)]], MAP_SCHEMA)
    obs = spark.createDataFrame([("TEC", "n", 2020, "mmt", 10.0), ("TER", "n", 2020, "mmt", 20.0),
                                 ("ESR", "n", 2020, "mmt", 3.0), ("ESC", "n", 2020, "mmt", 4.0),
                                 ("TEC", "n", 2021, "mmt", 10.0), ("TER", "n", 2021, "mmt", 20.0),
                                 ("ESR", "n", 2021, "mmt", None), ("ESC", "n", 2021, "mmt", 4.0),
                                 ("TEC", "n", 2022, "mmt", float("nan")), ("TER", "n", 2022, "mmt", 1.0)], OBS_SCHEMA)
    got = {r.year: r.value for r in map_and_rollup(obs, m).collect()}
    assert got == {2020: 23.0, 2021: None, 2022: None}       # missing (NULL or NaN) poisons the group


def test_rollup_columns_and_one_to_many(spark):
    m = spark.createDataFrame([("D", "S", "USA", "A", "V1", 1.0), ("D", "S", "USA", "A", "V2", 365.0)], MAP_SCHEMA)
    obs = spark.createDataFrame([("A", "n", 2020, "u", 2.0)], OBS_SCHEMA)
    out = map_and_rollup(obs, m)
    assert out.columns == ["model", "scenario", "region", "variable", "year", "unit", "value"]
    assert rows(out.select("variable", "value")) == [("V1", 2.0), ("V2", 730.0)]


def _random_frames(spark, seed):
    rnd = random.Random(seed)
    sids = ["a", "b", "c", None]
    obs = [(rnd.choice(sids), "n", rnd.choice([2020, 2021]), rnd.choice(["u1", "u2"]),
            rnd.choice([1.0, 2.5, None, -3.0])) for _ in range(rnd.randint(0, 25))]
    mp = [("D", "S", "USA", rnd.choice(sids + ["z"]), rnd.choice(["V1", "V2", None]), rnd.choice([1.0, -1.0, 365.0, None]))
          for _ in range(rnd.randint(0, 6))]
    return spark.createDataFrame(obs, OBS_SCHEMA), spark.createDataFrame(mp, MAP_SCHEMA)


@settings(max_examples=8, deadline=None)
@given(st.integers(min_value=0, max_value=10_000))
def test_rewrite_equals_literal_pipeline(spark, seed):
    """Property: inner broadcast join + left template join (the rewrite) keeps
    exactly the rows the literal full-outer form keeps after the value filter."""
    obs, mp = _random_frames(spark, seed)
    tmpl = spark.createDataFrame([("V1", "EJ/yr"), ("V3", "GW")], "variable string, emf_units string")

    def run(literal):
        rolled = map_and_rollup(obs, mp, literal=literal)
        tu = template_units_present(tmpl.withColumnRenamed("emf_units", "unit"), rolled) if literal else tmpl
        return rows(attach_units(rolled, tu, literal=literal)
                    .select("model", "scenario", "region", "variable", "year", "unit", "value", "emf_units"))

    assert run(True) == run(False)


def test_full_outer_with_dim_matches_literal_and_null_keys(spark):
    fact = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("a", 4)], "k string, v int")
    dim = spark.createDataFrame([("a", "A"), ("c", "C"), (None, "N")], "k string, d string")
    got = rows(full_outer_with_dim(fact, dim, ["k"]).select("k", "v", "d"))
    lit = rows(full_outer_join(fact, dim, ["k"]).select("k", "v", "d"))
    assert got == lit
    assert (None, 3, "N") in got                     # missing keys match each other
    assert ("c", None, "C") in got and ("b", 2, None) in got


def test_semi_join_null_safe(spark):
    left = spark.createDataFrame([("a",), (None,), ("z",)], "variable string")
    right = spark.createDataFrame([("a",), (None,)], "variable string")
    assert rows(semi_join(left, right, ["variable"])) == [(None,), ("a",)]


def test_group_total_keep_rows(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 2.0), ("y", 5.0), ("y", None), ("z", float("nan"))],
                               "g string, value double")
    got = rows(group_total_keep_rows(df, ["g"]).select("g", "group_total"))
    assert [r[1] for r in got if r[0] == "x"] == [3.0, 3.0]
    assert all(r[1] is None for r in got if r[0] in ("y", "z"))


def test_first_per_key_total_order(spark):
    df = spark.createDataFrame([("k", 2, 1, "late"), ("k", 1, 9, "early-b"), ("k", 1, 3, "early-a"), ("j", 5, 1, "only")],
                               "key string, ts int, id int, payload string")
    got = rows(first_per_key(df, ["key"], ["ts", "id"]))
    assert got == [("j", 5, 1, "only"), ("k", 1, 3, "early-a")]


def test_join_dim_broadcasts_checked_dimension(spark):
    fact = spark.range(1000).select((F.col("id") % 3).cast("string").alias("k"))
    dim = spark.createDataFrame([("0", "zero"), ("1", "one")], "k string, name string")
    plan = join_dim(fact, dim, ["k"], "left")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
