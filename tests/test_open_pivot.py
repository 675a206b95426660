"""Pivots whose columns the data names, cells with several values, and the full outer join in one pass over the facts."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from yearloom.operators import joins
from yearloom.operators.joins import full_outer_join, full_outer_with_dim, marked_numbers
from yearloom.operators.quality import QualityError
from yearloom.operators.reshape import PivotError, pivot_open, pivot_wider
from yearloom.plans.harmonize import wide_table
from yearloom.schemas import LONG_COLUMNS


def cells(spark, *data):
    return spark.createDataFrame(data, "k string, year string, value double, o int")


def test_columns_come_from_the_data(spark):
    df = cells(spark, ("a", "2021", 1.0, 1), ("a", None, 2.0, 1), ("b", "1999", None, 1), (None, "2021", 4.0, 1))
    wide = pivot_open(df, ["k"])
    assert wide.columns == ["k", "1999", "2021", "NA"]
    assert rows(wide) == [(None, None, 4.0, None), ("a", None, 1.0, 2.0), ("b", None, None, None)]
    assert pivot_open(df.limit(0), ["k"]).columns == ["k"] and pivot_open(df.limit(0), ["k"]).count() == 0
    assert rows(pivot_wider(df, ["k"])) == rows(wide)


def test_cells_with_several_values(spark):
    df = cells(spark, ("a", "1", 5.0, 2), ("a", "1", 7.0, 1), ("a", "2", 1.0, 1), ("b", "1", None, 1), ("b", "1", 2.0, 2))
    with pytest.raises(PivotError, match="2 cells have more than one value"):
        pivot_open(df, ["k"])
    listed = pivot_open(df, ["k"], on_duplicates="list", order_by=["o"])
    assert [(r.k, r["1"], r["2"]) for r in listed.orderBy("k").collect()] == [("a", [7.0, 5.0], [1.0]), ("b", [None, 2.0], None)]
    by_value = pivot_open(df, ["k"], on_duplicates="list")
    assert [(r.k, r["1"]) for r in by_value.orderBy("k").collect()] == [("a", [5.0, 7.0]), ("b", [2.0, None])]
    for rule, want in (("sum", [12.0, None]), ("max", [7.0, 2.0]), ("min", [5.0, 2.0]), ("first", [5.0, 2.0])):
        assert [r["1"] for r in pivot_open(df, ["k"], on_duplicates=rule).orderBy("k").collect()] == want, rule
    assert pivot_open(df, ["k"], on_duplicates="first", order_by=["o"]).orderBy("k").first()["1"] == 7.0


def test_stated_bounds(spark):
    df = spark.range(40).select(F.lit("k").alias("k"), F.col("id").cast("string").alias("year"), F.col("id").cast("double").alias("value"))
    with pytest.raises(PivotError, match="40 columns, more than 39"):
        pivot_open(df, ["k"], max_columns=39)
    assert len(pivot_open(df, ["k"], max_columns=40).columns) == 41
    with pytest.raises(PivotError, match="40 values, more than 39"):
        pivot_open(df.withColumn("year", F.lit("1")), ["k"], on_duplicates="list", max_list=39)
    with pytest.raises(PivotError, match="id columns: k"):
        pivot_open(df.withColumn("year", F.lit("k")), ["k"], on_duplicates="max")


def test_wide_table_without_years_checks_its_cells(spark):
    long = spark.createDataFrame([("AEO.2020", "R", "USA", "V", "EJ", y, 1.0) for y in (2031, 2020, 2020)],
                                 "model string, scenario string, region string, variable string, unit string, year int, value double").select(*LONG_COLUMNS)
    with pytest.raises(QualityError, match="more than one value per cell"):
        wide_table(long)
    assert wide_table(long.distinct()).columns[-2:] == ["2020", "2031"]


@pytest.mark.parametrize("numbers", [[], [0], [5, 5, 0, 32767, 32768, 65536, 3 << 33, (3 << 33) + 9, None]])
def test_marked_numbers(spark, numbers):
    df = spark.createDataFrame([(n,) for n in numbers * 3], "n long")
    assert sorted(r.n for r in marked_numbers(df, "n").collect()) == sorted({n for n in numbers if n is not None})


def test_full_outer_scans_the_facts_once(spark, tmp_path, monkeypatch):
    """Over every table that is written and the result: one scan of the facts."""
    facts = str(tmp_path / "facts")
    spark.range(500).select((F.col("id") % 40).cast("string").alias("k"), "id").withColumn("k", F.nullif("k", F.lit("3"))).write.parquet(facts)
    dim = spark.createDataFrame([(str(k), k) for k in range(30, 50)] + [(None, -1), ("31", 99), ("gone", 7)], "k string, d int")
    fact, plans = spark.read.parquet(facts), []
    monkeypatch.setattr(joins, "materialize", lambda df, keep=joins.materialize: plans.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df))
    out = full_outer_with_dim(fact, dim, ["k"])
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert sum(len(re.findall(r"Scan parquet.*" + re.escape(facts), p)) for p in plans) == 1
    assert "Exchange" not in plans[1] or "BroadcastExchange" in plans[1]
    assert rows(out.select("k", "id", "d")) == rows(full_outer_join(fact, dim, ["k"]).select("k", "id", "d"))
