"""End to end from files: real mapping CSVs, landed payloads, template CSV ->
wide CSV, change-tracker TSV, QA crosswalk, long Parquet."""

import csv
import json
import math
import os
import tempfile

import pytest

from conftest import FIXTURES
from yearloom.operators.units.convert import UnitConversionError
from yearloom.plans.job import JobSpec, run_job

# landed payloads for a few series of the real mapping files
SERIES = {
    "STEO.TETCCO2.A": ("million metric tons", {2020: 4500.0, 2021: 4800.0}),
    "STEO.CONSRUS.A": ("billion chained 2012 dollars (seasonally-adjusted annual rate)", {2020: 13000.0}),
    "TOTAL.TECCEUS.A": ("Million Metric Tons of Carbon Dioxide", {2020: 10.0, 2021: 11.0}),
    "TOTAL.TERCEUS.A": ("Million Metric Tons of Carbon Dioxide", {2020: 20.0, 2021: 21.0}),
    "TOTAL.ESRCEUS.A": ("Million Metric Tons of Carbon Dioxide", {2020: 3.0, 2021: None}),
    "TOTAL.ESCCEUS.A": ("Million Metric Tons of Carbon Dioxide", {2020: 4.0, 2021: 5.0}),
}


def _write_inputs(d):
    pay = os.path.join(d, "payload")
    os.makedirs(pay)
    with open(os.path.join(pay, "part-0.json"), "w") as f:
        for sid, (unit, pts) in SERIES.items():
            f.write(json.dumps({"series_id": sid, "name": sid, "units": unit,
                                "data": [{"year": y, "value": v} for y, v in pts.items()]}) + "\n")
    tpl = os.path.join(d, "template.csv")
    with open(tpl, "w") as f:
        f.write("Variable,Unit\n")
        f.write("Emissions|CO2|Energy,Mt CO2/yr\n")
        f.write("GDP|Consumption,billion US$2018/yr\n")
        f.write("Emissions|CO2|Energy|Demand|Buildings,Mt CO2/yr\n")
    return pay, tpl


def test_run_job_end_to_end(spark):
    d = tempfile.mkdtemp(prefix="yearloom-job-")
    pay, tpl = _write_inputs(d)
    spec = JobSpec(
        tagged_mappings=[(str(FIXTURES / "mapping_short_term.csv"), "EIA_STEO", "Ref"),
                         (str(FIXTURES / "mapping_historical.csv"), "EIAHistoric", "Historic")],
        template_path=tpl, output_dir=os.path.join(d, "out"), payload_path=pay, tracker_years=[2020, 2021])
    # the same source unit feeds a template variable and a variable outside the
    # template: two targets, one missing -> error in strict mode (trap T9)
    with pytest.raises(UnitConversionError, match="more than one target"):
        run_job(spark, spec)
    spec.strict = False
    spec.output_dir = os.path.join(d, "out2")
    paths = run_job(spark, spec)
    wide_file = [f for f in os.listdir(paths["wide_csv"]) if f.endswith(".csv")][0]
    rows = list(csv.DictReader(open(os.path.join(paths["wide_csv"], wide_file))))
    by = {(r["model"], r["variable"]): r for r in rows}
    # STEO CO2 in million metric tons -> relabelled to CO2 -> template unit, factor 1
    steo = by[("EIA_STEO", "Emissions|CO2|Energy")]
    assert steo["unit"] == "Mt CO2/yr" and float(steo["2020"]) == 4500.0
    # GDP in chained 2012 dollars -> 2018 dollars
    gdp = by[("EIA_STEO", "GDP|Consumption")]
    assert gdp["unit"] == "billion US$2018/yr"
    assert math.isclose(float(gdp["2020"]), 13000.0 * 106.10422 / 101.51688, rel_tol=1e-12)
    # Historic buildings = TEC + TER - ESR - ESC; ESR 2021 is reported missing -> missing ("NA")
    b = by[("EIA_Historic", "Emissions|CO2|Energy|Demand|Buildings")]
    assert float(b["2020"]) == 23.0 and b["2021"] == "NA"
    # non-strict: the crosswalk is keyed by the from-unit, so a variable outside
    # the template that shares the unit is converted with it
    ind = by[("EIA_Historic", "Emissions|CO2|Energy|Demand|Buildings|Indirect")]
    assert ind["unit"] == "Mt CO2/yr" and float(ind["2020"]) == 7.0
    qa_file = [f for f in os.listdir(paths["unit_crosswalk_qa"]) if f.endswith(".csv")][0]
    qa = list(csv.DictReader(open(os.path.join(paths["unit_crosswalk_qa"], qa_file))))
    assert {"from_unit": "million metric tons CO2", "from_units_unit": "Million_ton_CO2_yr",
            "to_units_unit": "Million_ton_CO2_yr", "to_unit": "Mt CO2/yr"} in qa
    assert os.path.isdir(os.path.join(paths["long_parquet"], "model=EIA_STEO"))
