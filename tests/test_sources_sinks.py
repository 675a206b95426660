"""Sources and sinks (S1-S9) and blank/missing text."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from conftest import rows
from yearloom.sources.readers import explode_payload, read_base_csv, read_mapping_csv, read_payload, read_template
from yearloom.sources.sinks import write_csv, write_csv_quoted, write_tsv


def _tmp():
    return tempfile.mkdtemp(prefix="yearloom-test-")


def test_blank_vs_missing_t13(spark):
    d = _tmp()
    p = os.path.join(d, "m.csv")
    with open(p, "w") as f:
        f.write('Variable,Series_ID,Factor,notes\nA,S1,1,\n"",S2,NA,x\nNA,S3,2,"y"\n,S4,bad,z\n')
    s1 = read_mapping_csv(spark, p).collect()
    assert [r.Variable for r in s1] == ["A", None, None, None]           # readr style: blank and NA missing
    assert [r.Factor for r in s1] == [1.0, None, 2.0, None]               # bad number -> missing, no error
    s2 = read_base_csv(spark, p).collect()
    assert [r.Variable for r in s2][:2] == ["A", ""]                      # base style: blank stays ""


def test_template_reader_lowercases(spark):
    d = _tmp()
    p = os.path.join(d, "t.csv")
    with open(p, "w") as f:
        f.write("Variable,Unit,Round,Tier\nPrimary Energy,EJ/yr,beta,1\n")
    t = read_template(spark, p)
    assert t.columns == ["variable", "unit", "round", "tier"]


def test_payload_ingest(spark):
    d = _tmp()
    with open(os.path.join(d, "batch1.json"), "w") as f:
        for sid, pts in (("A", [(2019, 1.0), (2020, 2.0)]), ("B", [(2020, 5.0)])):
            f.write(json.dumps({"series_id": sid, "name": sid.lower(), "units": "GW",
                                "data": [{"year": y, "value": v} for y, v in pts]}) + "\n")
    with open(os.path.join(d, "batch2.json"), "w") as f:
        f.write(json.dumps({"series_id": "C", "name": "c", "units": "EJ", "data": [{"year": 2021, "value": 7.5}]}) + "\n")
    long = read_payload(spark, d)
    assert long.columns == ["series_id", "name", "year", "unit", "value"]
    assert rows(long) == [("A", "a", 2019, "GW", 1.0), ("A", "a", 2020, "GW", 2.0), ("B", "b", 2020, "GW", 5.0),
                          ("C", "c", 2021, "EJ", 7.5)]
    assert read_payload(spark, d, start=2020).count() == 3


def test_explode_payload_from_frame(spark):
    p = spark.createDataFrame([("A", "a", "GW", [(2020, 1.0)])],
                              "series_id string, name string, units string, data array<struct<year:int,value:double>>")
    assert rows(explode_payload(p)) == [("A", "a", 2020, "GW", 1.0)]


def test_sinks_write_na_and_quotes(spark):
    df = spark.createDataFrame([("b", None), ("a", 1.5)], "variable string, `2020` double")
    d = _tmp()
    write_csv(df, os.path.join(d, "csv"), order_by=["variable"], single_file=True)
    text = "".join(open(os.path.join(d, "csv", f)).read() for f in sorted(os.listdir(os.path.join(d, "csv")))
                   if f.endswith(".csv"))
    assert text.splitlines() == ["variable,2020", "a,1.5", "b,NA"]
    write_tsv(df, os.path.join(d, "tsv"), order_by=["variable"], single_file=True)
    tsv = [f for f in os.listdir(os.path.join(d, "tsv")) if f.endswith(".csv")]
    assert open(os.path.join(d, "tsv", tsv[0])).read().splitlines()[1] == "a\t1.5"
    write_csv_quoted(df.where(F.col("variable") == "a"), os.path.join(d, "q"), single_file=True)
    q = [f for f in os.listdir(os.path.join(d, "q")) if f.endswith(".csv")]
    assert open(os.path.join(d, "q", q[0])).read().splitlines()[1] == '"a","1.5"'


def test_exports(spark):
    from yearloom.plans.harmonize import export_change_tracker, export_wide

    wide = spark.createDataFrame([("m2", "s", "USA", "v", "EJ/yr", 1.234, 2.0), ("m1", "s", "USA", "v", "EJ/yr", None, 0.285)],
                                 "model string, scenario string, region string, variable string, unit string, "
                                 "`2020` double, `2030` double")
    d = _tmp()
    export_wide(wide, os.path.join(d, "wide"))
    f = [x for x in os.listdir(os.path.join(d, "wide")) if x.endswith(".csv")]
    lines = open(os.path.join(d, "wide", f[0])).read().splitlines()
    assert lines[0] == "model,scenario,region,variable,unit,2020,2030" and lines[1].startswith("m1,") and ",NA," in lines[1]
    export_change_tracker(wide, os.path.join(d, "tsv"), [2030])
    f = [x for x in os.listdir(os.path.join(d, "tsv")) if x.endswith(".csv")]
    lines = open(os.path.join(d, "tsv", f[0])).read().splitlines()
    assert lines[1].split("\t") == ["m1", "s", "USA", "v", "EJ/yr", "0.29"]


def test_payload_from_parquet(spark):
    d = _tmp()
    p = spark.createDataFrame([("A", "a", "GW", [(2020, 1.0), (2021, None)])],
                              "series_id string, name string, units string, data array<struct<year:int,value:double>>")
    p.write.parquet(os.path.join(d, "landed"))
    got = rows(read_payload(spark, os.path.join(d, "landed"), fmt="parquet"))
    assert got == [("A", "a", 2020, "GW", 1.0), ("A", "a", 2021, "GW", None)]
