"""Outputs appear whole or not at all; checks that ride on a write; aliases as a table; classes of convertible units."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from yearloom.functions.unit_names import UNIT_ALIASES, standardize_unit_names, with_aliases_replaced
from yearloom.operators import reshape
from yearloom.operators.units.algebra import convertibility_classes, unit_factor_table
from yearloom.operators.units.convert import input_violations
from yearloom.plans import harmonize
from yearloom.plans.job import run_job
from yearloom.sources.sinks import Publication, PublishError, read_manifest, write_csv, write_csv_quoted, write_parquet, write_tsv
from test_corrupt_input import LINES, job


def failing(spark, n=50):
    return spark.range(n).select(F.when(F.col("id") < n - 1, F.col("id").cast("string")).otherwise(F.raise_error(F.lit("a failing task"))).alias("k"))


@pytest.mark.parametrize("write", [write_csv, write_tsv, write_csv_quoted, write_parquet])
def test_a_failed_write_keeps_the_old_output(spark, tmp_path, write):
    path = str(tmp_path / "out")
    write(spark.range(5).select(F.col("id").cast("string").alias("k")), path)
    before = sorted(os.listdir(path))
    with pytest.raises(Exception, match="a failing task"):
        write(failing(spark), path)
    assert sorted(os.listdir(path)) == before and os.listdir(tmp_path) == ["out"]
    write(spark.range(7).select(F.col("id").cast("string").alias("k")), path)
    manifest = read_manifest(spark, path)
    assert manifest["rows"] == 7 and manifest["columns"] == ["k"] and os.listdir(tmp_path) == ["out"]
    assert all(os.path.getsize(f"{path}/{f['file']}") == f["bytes"] for f in manifest["files"]) and manifest["files"]


def test_partitions_and_cells_with_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([("a", "x\ny", 1), ("b", 'q "u" ote', 2), ("b", None, 3)], "p string, t string, n int")
    write_parquet(df, str(tmp_path / "p"), partition_by=["p"])
    assert rows(spark.read.parquet(str(tmp_path / "p")).select("p", "t", "n")) == rows(df)
    assert {f["file"].split("/")[0] for f in read_manifest(spark, str(tmp_path / "p"))["files"]} == {"p=a", "p=b"}
    write_csv(df, str(tmp_path / "c"))
    assert read_manifest(spark, str(tmp_path / "c"))["rows"] == 3


def test_outputs_appear_together(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "deep" / "b")
    write_parquet(spark.range(2), a)
    with pytest.raises(ValueError, match="later"):
        with Publication(spark) as pub:
            write_parquet(spark.range(9), a, publication=pub)
            write_parquet(spark.range(9), b, publication=pub)
            raise ValueError("later")
    assert spark.read.parquet(a).count() == 2 and not os.path.exists(b) and sorted(os.listdir(tmp_path)) in (["a"], ["a", "deep"])
    with Publication(spark) as pub:
        write_parquet(spark.range(9), a, publication=pub)
        write_parquet(spark.range(3), b, publication=pub)
        assert spark.read.parquet(a).count() == 2
    assert spark.read.parquet(a).count() == 9 and spark.read.parquet(b).count() == 3


def test_lost_rows_are_noticed(spark, tmp_path):
    with pytest.raises(PublishError, match="10 rows were to be written, 4 are there"):
        with Publication(spark) as pub:
            pub.add(spark.range(10), str(tmp_path / "x"), lambda w, to: w.parquet(to), lambda to: spark.read.parquet(to).limit(4))
    assert os.listdir(tmp_path) == []


def test_a_commit_that_fails_goes_back(spark, tmp_path):
    a = str(tmp_path / "a")
    write_parquet(spark.range(2), a)
    pub = Publication(spark)
    write_parquet(spark.range(5), a, publication=pub)
    write_parquet(spark.range(5), str(tmp_path / "b"), publication=pub)
    pub.staged[1].stage += "-gone"
    with pytest.raises(Exception):
        pub.commit()
    assert spark.read.parquet(a).count() == 2 and not os.path.exists(tmp_path / "b")


def test_a_failed_job_keeps_the_last_run(spark, tmp_path):
    good = "Variable,Series_ID,Factor\nV,S,1\n"
    spec = job(str(tmp_path), good, LINES[0])
    paths = run_job(spark, spec)
    before = rows(spark.read.parquet(paths["long_parquet"]))
    spec.tracker_years = [1066]  # fails after the first outputs were written
    with pytest.raises(ValueError, match="1066"):
        run_job(spark, spec)
    assert rows(spark.read.parquet(paths["long_parquet"])) == before and sorted(os.listdir(tmp_path / "out")) == sorted(os.path.basename(p) for p in paths.values())


def test_checks_ride_on_the_writes(spark, monkeypatch):
    """Clean data: conversion and layout write what they write, and read nothing again to check it."""
    long = spark.createDataFrame([("AEO.2020", "R", "USA", f"V{k}", "EJ/yr", 2020 + k % 3, float(k), "EJ/yr") for k in range(9)],
                                 "model string, scenario string, region string, variable string, unit string, year int, value double, emf_units string")
    used = []
    for module, name in ((harmonize, "assert_empty"), (reshape, "PivotError")):
        monkeypatch.setattr(module, name, lambda *a, name=name: used.append(name))
    tracker, group = spark.sparkContext.statusTracker(), "checks-on-writes"
    spark.sparkContext.setJobGroup(group, group)
    try:
        harmonize.wide_table(long.select(*harmonize.LONG_COLUMNS), [2020, 2021, 2022])
        jobs = len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not used and jobs <= 3  # the cells: a map stage, their write, and the written table's schema


ALIASES = [(k, a, b) for k, (a, b) in enumerate(UNIT_ALIASES)]


def test_alias_table_equals_the_list(spark):
    texts = ["2019 $/b", "quads", "million metric tons CO2", "percent", "cents per kilowatt hour", "2012  $", "", None, "GW"]
    df = spark.createDataFrame([(t,) for t in texts], "u string")
    table = spark.createDataFrame([*reversed(ALIASES), (99, None, "x"), (99, "", "x"), (99, "GW", None)], "rank int, alias string, name string")
    got = with_aliases_replaced(df, {"a": "u", "b": "u"}, table).select("u", "a", "b", standardize_unit_names(F.col("u")).alias("want")).collect()
    assert all(r.a == r.b == r.want for r in got) and len(got) == len(texts)
    with pytest.raises(ValueError, match="more than 5 aliases"):
        with_aliases_replaced(df, {"a": "u"}, table, max_aliases=5)
    assert rows(with_aliases_replaced(df, {"a": "u"}, table.limit(0)).select("a")) == rows(df)


def test_classes_agree_with_convertibility(spark):
    units = ["quadrillion Btu", "EJ/yr", "GWh", "GW", "million kilowatts", "2019 $/b", "US$2018/GJ", "furlong", "Mt CO2/yr", "percent", "thousand"]
    df = spark.createDataFrame([(u,) for u in units * 2 + [None]], "unit string")
    got = {r.unit: r.class_id for r in convertibility_classes(df).collect()}
    assert set(got) == set(units) and got["furlong"] is None
    pairs = spark.createDataFrame([(a, b) for a in units for b in units], "from_unit string, to_unit string")
    for r in unit_factor_table(pairs).collect():
        assert r.convertible == (got[r.from_unit] is not None and got[r.from_unit] == got[r.to_unit]), (r.from_unit, r.to_unit)
    for u, c in got.items():
        assert c is None or c == min(v for v in units if got[v] == c)


def test_input_violations(spark):
    df = spark.createDataFrame([(None, 1.0), ("", 2.0), (" ", None), ("EJ", float("nan")), ("EJ", float("inf")), ("EJ", 1.0), (None, None)], "unit string, value double")
    assert rows(input_violations(df)) == [("blank unit", "", 1), ("blank unit", " ", 1), ("value is not a number", "EJ", 2), ("value without a unit", None, 1)]
    assert rows(input_violations(df.drop("unit"))) == [("missing column", "unit", None)]
    assert rows(input_violations(spark.range(1).select(F.col("id").alias("unit"), F.lit("x").alias("value")))) == [
        ("unit is not text", "unit", None), ("value is not a number", "value", None)]
    assert rows(input_violations(df.limit(0))) == []
