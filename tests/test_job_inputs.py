"""What the file job reads is kept or reported: text years, comma factors, missing
units, years outside the list; and the unit rules that only odd inputs show."""

import json
import math
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import rows
from yearloom.functions.unit_names import standardize_unit_names_alt
from yearloom.operators.aggregate import first_per_key
from yearloom.operators.columns import round_numeric
from yearloom.operators.joins import anti_join, cross_with_bounded, join_dim, semi_join
from yearloom.operators.quality import QualityError
from yearloom.operators.units.algebra import unit_factor_table, unit_lookup
from yearloom.operators.units.convert import UnitConversionError, convert_crosswalk, convert_rowwise, convert_units
from yearloom.plans.harmonize import change_tracker, export_inventory, wide_table
from yearloom.plans.job import JobSpec, run_job
from yearloom.schemas import LONG_COLUMNS
from yearloom.session import ensure_checkpoint_dir, scratch_dir
from yearloom.sources.readers import factor_violations, read_mapping_csv, read_observations, read_payload


def _long(spark, *years):
    return spark.createDataFrame([("AEO.2020", "REF2020", "USA", "V", "EJ/yr", y, float(k)) for k, y in enumerate(years)],
                                 "model string, scenario string, region string, variable string, unit string, year int, value double").select(*LONG_COLUMNS)


def test_comma_factor_is_a_number_and_a_bad_one_is_reported(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="yearloom-map-"), "map.csv")
    with open(path, "w") as f:
        f.write('Variable,Series_ID,Factor\nA,S1,"1,000"\nB,S2,1e3\nC,S3,ten\nD,S4,\nE,S5,NA\nF,S6,inf\n')
    assert [r.Factor for r in read_mapping_csv(spark, path).collect()] == [1000.0, 1000.0, None, None, None, None]
    assert sorted(r.Factor for r in factor_violations(spark, path).collect()) == ["inf", "ten"]


def test_a_year_outside_the_list_is_refused(spark):
    with pytest.raises(QualityError, match="outside the list"):
        wide_table(_long(spark, 2020, 2050), [2020])
    assert wide_table(_long(spark, 2020, 2050), [2020, 2050]).columns[-2:] == ["2020", "2050"]


def test_a_missing_year_has_its_own_column(spark):
    wide = wide_table(_long(spark, 2020, None))
    assert wide.columns[-2:] == ["2020", "NA"] and tuple(wide.first())[-2:] == (0.0, 1.0)


def test_tracker_years_must_exist(spark):
    with pytest.raises(ValueError, match="2050"):
        change_tracker(wide_table(_long(spark, 2020)), [2020, 2050])


def test_rounds_once(spark):
    values = [1.00499999999, 0.28499999999, 0.285, -2.675, 1e17, 1.5e-7, float("inf"), None, 123456789012.345]
    got = [r.v for r in round_numeric(spark.createDataFrame([(v,) for v in values], "v double")).collect()]
    assert got == [1.0, 0.28, 0.29, -2.68, 1e17, 0.0, float("inf"), None, 123456789012.35]


def test_missing_order_value_is_last_and_maps_pass(spark):
    df = spark.createDataFrame([("a", None, {"x": 1}), ("a", 5, {"x": 2}), ("b", None, {"x": 3})], "k string, o int, m map<string,int>")
    assert sorted((r.k, r.o, r.m["x"]) for r in first_per_key(df, ["k"], ["o"]).collect()) == [("a", 5, 2), ("b", None, 3)]


def _convertible(spark, *pairs, **kw):
    table = unit_factor_table(spark.createDataFrame(pairs, "from_unit string, to_unit string"), rename_fun=lambda c: c, **kw)
    return {(r.from_unit, r.to_unit): r.factor if r.convertible else None for r in table.collect()}


def test_knot_and_number_tokens(spark):
    got = _convertible(spark, ("kt", "Mt"), ("kt", "m/s"), ("inf", "million"), ("1d", "million"), ("NaN", "million"), ("2.5e3", "thousand"))
    assert got[("kt", "Mt")] is None and math.isclose(got[("kt", "m/s")], 1852 / 3600)
    assert got[("inf", "million")] is None and got[("1d", "million")] is None and got[("NaN", "million")] is None
    assert got[("2.5e3", "thousand")] == 2.5
    assert math.isclose(_convertible(spark, ("kt", "Mt"), registry=unit_lookup(variant=True))[("kt", "Mt")], 1e-3)


def test_overlapping_sets_take_the_first(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "u string")
    got = [r[0] for r in df.select(standardize_unit_names_alt(F.col("u"), [["b", "a"], ["c", "b"]])).collect()]
    assert got == ["b", "b", "c", "d"]


def test_registry_table_agrees_with_the_list(spark):
    from yearloom.operators.units.registry import registry_rows

    table = spark.createDataFrame([(n, k, float(s), [{"dim": d, "exp": int(e)} for d, e in dims]) for n, k, s, dims in registry_rows(False, None)],
                                  "name string, kind string, scale double, dims array<struct<dim:string,exp:int>>")
    pairs = [("quadrillion Btu", "EJ"), ("MILLION Barrelnews", "GJ"), ("GW", "EJ"), ("furlong", "EJ"), ("cents/kwh", "US_2018_Dollar/GJ"), ("", "EJ"), ("2 million", "thousand")]
    assert _convertible(spark, *pairs, registry=table) == _convertible(spark, *pairs)


def test_dispatcher_accepts_a_list_of_one(spark):
    df = spark.createDataFrame([("quadrillion Btu", 1.0), ("GWh", 1.0)], "unit string, value double")
    want = rows(convert_units(df, "EJ/yr", ["quadrillion Btu", "GWh"]))
    assert rows(convert_units(df, ["EJ/yr"], ["quadrillion Btu", "GWh"])) == want
    with pytest.raises(UnitConversionError, match="needs to_unit"):
        convert_units(df, from_unit=["GWh"])


def test_grid_beyond_the_bound(spark):
    a, b = spark.range(5).withColumnRenamed("id", "a"), spark.range(7).withColumnRenamed("id", "b")
    assert rows(cross_with_bounded(a, b, max_rows=1)) == rows(cross_with_bounded(a, b))


def test_salted_joins_give_the_same_rows(spark):
    fact = spark.range(3000).select((F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.col("id").cast("string"))).alias("k"), "id")
    dim = spark.createDataFrame([("hot", 1), (None, 2), ("7", 3)], "k string, d int")
    for join in (semi_join, anti_join):
        plain, salted = join(fact, dim, ["k"]), join(fact, dim, ["k"], max_broadcast_rows=1, salt_buckets=4)
        assert rows(salted) == rows(plain) and "__salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    assert rows(join_dim(fact, dim, ["k"], "left", max_broadcast_rows=1, salt_buckets=4)) == rows(join_dim(fact, dim, ["k"], "left"))


def test_salted_factor_join(spark):
    df = spark.range(900).select(F.when(F.col("id") % 3 == 0, "quadrillion Btu").when(F.col("id") % 3 == 1, "GWh").alias("unit"), F.col("id").cast("double").alias("value"))
    for convert in (lambda **kw: convert_rowwise(df, F.lit("EJ/yr"), **kw), lambda **kw: convert_crosswalk(df, [("GWh", "EJ/yr"), ("quadrillion Btu", "EJ/yr")], **kw)):
        salted = convert(max_broadcast_rows=1, salt_buckets=4)
        assert rows(salted) == rows(convert()) and "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()


def test_start_reaches_the_scan_and_the_arrays(spark):
    d = tempfile.mkdtemp(prefix="yearloom-start-")
    spark.createDataFrame([("s", "n", y, "u", 1.0) for y in (1999, 2000, 2001)], "series_id string, name string, year int, unit string, value double").write.parquet(f"{d}/flat")
    flat = read_observations(spark, f"{d}/flat", start=2000)
    assert flat.count() == 2 and "GreaterThanOrEqual(year,2000)" in flat._jdf.queryExecution().executedPlan().toString()
    with open(f"{d}/p.json", "w") as f:
        f.write(json.dumps({"series_id": "s", "name": "n", "units": "u", "data": [{"year": "1999", "value": 1}, {"year": "2001", "value": "1,5"}]}) + "\n")
    landed = read_payload(spark, f"{d}/p.json", start=2000)
    assert [(r.year, r.value) for r in landed.collect()] == [(2001, 15.0)]


def _job(spark, payload, **kw):
    d = tempfile.mkdtemp(prefix="yearloom-job-")
    with open(f"{d}/map.csv", "w") as f:
        f.write('Variable,Series_ID,Factor,notes\nA,S1,"1,000",x\nB,S2,1,x\n')
    with open(f"{d}/template.csv", "w") as f:
        f.write("Variable,Unit\nA,EJ/yr\nC,EJ/yr\n")
    with open(f"{d}/payload.json", "w") as f:
        f.writelines(json.dumps({"series_id": s, "name": s, "units": u, "data": [{"year": y, "value": v} for y, v in points]}) + "\n" for s, u, points in payload)
    spec = JobSpec(tagged_mappings=[(f"{d}/map.csv", "EIA_STEO", "Ref")], template_path=f"{d}/template.csv", output_dir=f"{d}/out",
                   payload_path=f"{d}/payload.json", tracker_years=[2020], strict=False, **kw)
    return d, run_job(spark, spec)


def test_job_keeps_and_reports(spark):
    _, paths = _job(spark, [("S1", "quadrillion Btu", [("2020", "2"), (2021, 3.0), ("n/a", 9)]), ("S2", None, [(2020, 7), (None, 8), ("20x", 1)]),
                            ("S2", "GW", [(2020, 5), (2020, 6)])], keep_scratch=True)
    long = {(r.variable, r.unit, r.year): r.value for r in spark.read.parquet(paths["long_parquet"]).collect()}
    assert math.isclose(long[("A", "EJ/yr", 2020)], 2 * 1000 * 1.05505585262, rel_tol=1e-9) and ("A", "EJ/yr", None) in long
    assert long[("B", None, 2020)] == 7.0 and long[("B", "GW", 2020)] == 11.0
    bad = sorted((r.series_id, r.field, r.cell) for r in spark.read.parquet(paths["ingest_violations"]).fillna("").collect())
    assert bad == [("S1", "year", "n/a"), ("S2", "unit and year", ""), ("S2", "unit and year", "20x"), ("S2", "year", "20x")]
    gaps = {(r.gap, r.key) for r in spark.read.parquet(paths["coverage_gaps"]).collect()}
    assert gaps == {("variable_not_in_template", "B"), ("template_variable_unmapped", "C")}
    assert [(r.series_id, r.year, r.n_rows) for r in spark.read.parquet(paths["frequency_violations"]).where("series_id = 'S2' and year = 2020").collect()] == [("S2", 2020, 3)]


def test_job_with_the_industry_grid(spark):
    d = tempfile.mkdtemp(prefix="yearloom-grid-")
    files = {
        "base.csv": 'Variable,Series_template,Series_Name,Factor,notes,notes_variable\nBase,{EIA_dataset}.{EIA_scenario}.X,base,1,,\n',
        "ind.csv": "EMF_industry_name,EMF_main_sector,EIA_abbrev,EIA_subsector,EIA_main_sector,notes_ind_map\nSteel,Metals,STL,,Industrial,i\n,Metals,NON,,Industrial,i\n",
        "var.csv": "EMF_subcategory,EMF_category,EIA_prefix,EIA_energy_code,EIA_suffix,EIA_category_name,notes_var_map\nGas,Energy,P_,NG,_S,gas use,v\n",
        "map.csv": "Variable,Series_ID,Factor\nA,S1,1\n", "template.csv": "Variable,Unit\nA,EJ/yr\n"}
    for name, text in files.items():
        with open(f"{d}/{name}", "w") as f:
            f.write(text)
    with open(f"{d}/payload.json", "w") as f:
        f.write(json.dumps({"series_id": "AEO.2020.REF2020.P_STL_NG_S", "name": "x", "units": "EJ", "data": [{"year": 2020, "value": 4}]}) + "\n")
    paths = run_job(spark, JobSpec(
        tagged_mappings=[(f"{d}/map.csv", "EIA_STEO", "Ref")], template_path=f"{d}/template.csv", output_dir=f"{d}/out", payload_path=f"{d}/payload.json",
        key_template_path=f"{d}/base.csv", industry_path=f"{d}/ind.csv", industry_var_path=f"{d}/var.csv", datasets=["AEO.2020"], scenarios=["REF2020"],
        tracker_years=[2020], single_file=True))
    text = "".join(open(os.path.join(paths["key_template_expanded"], f)).read() for f in os.listdir(paths["key_template_expanded"]) if f.endswith(".csv")).splitlines()
    assert text[1].startswith('"Final Energy|Industry|Metals|Steel|Gas"') and text[2].startswith('"Base"') and len(text) == 3
    assert not os.path.exists(scratch_dir(spark).removeprefix("file:"))  # removed once the outputs are written
    long = spark.read.parquet(paths["long_parquet"]).collect()
    assert [(r.variable, r.value) for r in long] == [("Final Energy|Industry|Metals|Steel|Gas", 4.0)]


def test_inventory_export(spark):
    d = tempfile.mkdtemp(prefix="yearloom-inv-")
    raw = spark.createDataFrame([("B", "USA", "MMTCO2e", "1,0", "x"), ("A", "USA", "MMTCO2e", "+", "x"), ("", "USA", "MMTCO2e", "3", "x"), ("C", "USA", "kt", "3", "x")],
                                "variable string, region string, unit string, `1990` string, gas string")
    path = export_inventory(raw, f"{d}/inv", single_file=True)
    text = "".join(open(os.path.join(path, f)).read() for f in os.listdir(path) if f.endswith(".csv")).splitlines()
    assert text == ['"variable","region","unit","1990","model","scenario"', '"A","USA","MMTCO2/yr","+","EPA.GHGI","2022"', '"B","USA","MMTCO2/yr","1,0","EPA.GHGI","2022"']


def test_a_cluster_refuses_a_local_checkpoint_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {"spark.checkpoint.dir": "file:///tmp/x"}

    with pytest.raises(RuntimeError, match="share"):
        ensure_checkpoint_dir(Session())


def test_fact_table_is_scanned_once(spark):
    """One pass over orders for the variables present, one for the attached table."""
    from yearloom.plans import catalog

    for query in (catalog.q_template_units_present, catalog.q_attach_units_full):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "orders.parquet" not in plan  # what is left reads the written table
