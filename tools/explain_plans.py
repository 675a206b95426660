"""Print the physical plan trees of the main operators (``explain("formatted")``
heads) so plan regressions are easy to spot:

    python tools/explain_plans.py [sf_dir] > /tmp/plans.txt
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from yearloom.operators.aggregate import first_per_key, group_total_keep_rows  # noqa: E402
from yearloom.operators.joins import full_outer_with_dim  # noqa: E402
from yearloom.operators.units.convert import convert_crosswalk  # noqa: E402
from yearloom.plans import catalog as c  # noqa: E402
from yearloom.plans import fixtures as fx  # noqa: E402
from yearloom.plans.harmonize import attach_units, map_and_rollup  # noqa: E402
from yearloom.session import build_session  # noqa: E402


def tree(df) -> str:
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return text.split("\n\n")[0]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]")
    obs, smap, template = c.flagship_inputs(spark, sf)
    tu = template.select("variable", F.col("unit").alias("emf_units")).distinct()
    attached = attach_units(map_and_rollup(obs, smap), tu, template_rows=len(fx.TEMPLATE))
    li = c._line_units(spark, sf)
    e = c._t(spark, sf, "events")
    plans = {
        "flagship fact pass (map join, strict roll-up, template join, relabel)": attached,
        "crosswalk conversion on the facts": convert_crosswalk(li, c.LINE_CROSSWALK),
        "full outer join with a dimension (fact side not shuffled)":
            full_outer_with_dim(fx.orders_obs(spark, sf).drop("name"), c._series_map(spark), ["series_id"]),
        "group total kept on rows": group_total_keep_rows(
            c._lineitem_poison(spark, sf).select("l_suppkey", "year", "value"), ["l_suppkey", "year"]),
        "first row per key": first_per_key(e, ["event_type", "user_id"], ["ts", "event_id"]),
    }
    for title, df in plans.items():
        print(f"### {title}\n\n```\n{tree(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
