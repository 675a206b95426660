"""Rows that aren't whole come out as violations with their raw text."""

import json
import os
import tempfile

import pytest

from conftest import rows
from yearloom.operators.quality import QualityError
from yearloom.plans.job import JobSpec, run_job
from yearloom.sources.readers import corrupt_csv_rows, load_payload, payload_violations, read_mapping_csv, read_payload

CSV = 'Variable,Series_ID,Factor\na,1,2\nb,2,3,extra\nc,3\n"d,4,5\ne,5,"6\n"f, ""q""",6,7\n\n"g",8,NA\n,9,\n'
BAD = [("cells", "b,2,3,extra"), ("cells", "c,3"), ("quote", '"d,4,5'), ("quote", 'e,5,"6')]


def write(name, text):
    path = os.path.join(tempfile.mkdtemp(prefix="yearloom-corrupt-"), name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_csv_rows_that_are_not_whole(spark):
    assert rows(corrupt_csv_rows(spark, write("m.csv", CSV))) == BAD
    assert rows(corrupt_csv_rows(spark, write("m.csv", "\ufeff" + CSV.replace("\n", "\r\n")))) == BAD
    assert rows(corrupt_csv_rows(spark, write("m.csv", "a,b c\n1,2\n"))) == []
    assert rows(corrupt_csv_rows(spark, write("m.csv", "a,b\n"))) == []


def test_csv_with_a_schema_or_tabs(spark):
    path = write("m.tsv", "k\tv\na\t1\nb\tx\nc\n")
    assert rows(corrupt_csv_rows(spark, path, "k string, v int", sep="\t")) == [("cells", "b\tx"), ("cells", "c")]


def test_csv_with_line_breaks_in_cells(spark):
    path = write("m.csv", 'k,v\n"a\nb",1\nc,2,3\nd\n')
    assert rows(corrupt_csv_rows(spark, path, multi_line=True)) == [("cells", "c,2,3"), ("cells", "d")]
    assert [r.k for r in read_mapping_csv(spark, path, multi_line=True).collect()][0] == "a\nb"


LINES = [json.dumps({"series_id": "S", "name": "n", "units": "quads", "data": [{"year": "2020", "value": "1"}, {"year": "x", "value": "2"}]}),
         '{"series_id":"cut","name":"n","units":"u","data":[{"ye', '{"series_id":"T","name":"n","units":"u","data":"oops"}', "[1,2]", "not json",
         '{"series_id":"U","name":"n","units":"u","data":[{"year":"2020","value":"1"},{"year":["no"],"value":"2"}]}', ""]


def test_payload_lines(spark):
    path = write("p.json", "\n".join(LINES) + "\n")
    found = rows(payload_violations(load_payload(spark, path)))
    assert sorted(c for _, f, c in found if f == "record") == sorted(LINES[1:5])
    assert [(s, f, c) for s, f, c in found if f != "record"] == [("S", "year", "x"), ("U", "year", '["no"]')]
    assert [(r.series_id, r.year, r.value) for r in read_payload(spark, path).collect()] == [("S", 2020, 1.0), ("S", None, 2.0), ("U", 2020, 1.0), ("U", None, 2.0)]


def job(tmp, mapping, payload):
    os.makedirs(f"{tmp}/payload")
    for name, text in (("map.csv", mapping), ("template.csv", "variable,unit\nV,EJ/yr\n"), ("payload/p.json", payload)):
        with open(f"{tmp}/{name}", "w") as f:
            f.write(text)
    return JobSpec(tagged_mappings=[(f"{tmp}/map.csv", "EIA_STEO", "Ref")], template_path=f"{tmp}/template.csv", payload_path=f"{tmp}/payload",
                   output_dir=f"{tmp}/out", tracker_years=[2020], keep_scratch=True)


def test_job_reports_payload_records_and_refuses_mapping_rows(spark):
    good = "Variable,Series_ID,Factor\nV,S,1\n"
    paths = run_job(spark, job(tempfile.mkdtemp(prefix="yearloom-job-"), good, "\n".join([LINES[0], LINES[1], LINES[2]])))
    found = {(r.field, r.cell) for r in spark.read.parquet(paths["ingest_violations"]).collect()}
    assert found == {("year", "x"), ("record", LINES[1]), ("record", LINES[2])}
    with pytest.raises(QualityError, match="aren't whole.*W,S,1,2"):
        run_job(spark, job(tempfile.mkdtemp(prefix="yearloom-job-"), good + "W,S,1,2\n", LINES[0]))
