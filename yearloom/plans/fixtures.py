"""Small dimension tables used by the catalogue queries over the driver tables.

Observations are derived from ``orders`` (15 series: status x priority digit)
and ``lineitem`` (projection-style keys); these dims map them. They are plain
lists so the same rows feed the Spark query and the SQL oracle.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yearloom.session import local_frame

D = Decimal

# Historical-style series map (series -> variable, factor); one
# series feeds two variables, one factor is -1, per-day series carry 365, one
# mapping row has no data.
HIST_MAP = [
    ("S.F.1", "Primary Energy|Oil", D("1")),
    ("S.F.2", "Secondary Energy|Electricity", D("1")),
    ("S.F.3", "Supply|Liquids", D("365")),
    ("S.F.4", "GDP|MER", D("1")),
    ("S.F.5", "Emissions|CO2|Energy", D("1")),
    ("S.P.5", "Final Energy|Coal", D("1")),
    ("S.F.1", "Primary Energy|Oil|Net", D("1")),
    ("S.P.1", "Primary Energy|Oil|Net", D("-1")),
    ("S.P.4", "Memo|Electricity", D("1")),
    ("S.X.9", "Capacity|Electricity", D("1")),
]
# Short-term-outlook-style series map.
STEO_MAP = [
    ("S.O.1", "Primary Energy|Oil", D("1")),
    ("S.O.2", "Secondary Energy|Electricity", D("1")),
    ("S.O.3", "Supply|Liquids", D("365")),
    ("S.O.5", "Emissions|CO2|Energy", D("1")),
]
# Projection key templates, instantiated over the dataset x scenario grid.
AEO_TEMPLATE = [
    ("Primary Energy|Gas", "{EIA_dataset}.{EIA_scenario}.LA", D("1")),
    ("Primary Energy|Gas", "{EIA_dataset}.{EIA_scenario}.LN", D("1")),
    ("Secondary Energy|Liquids", "{EIA_dataset}.{EIA_scenario}.LR", D("365")),
]
# Reporting template (variable -> required unit).
TEMPLATE = [
    ("Primary Energy|Oil", "EJ/yr"),
    ("Primary Energy|Oil|Net", "EJ/yr"),
    ("Secondary Energy|Electricity", "EJ/yr"),
    ("Supply|Liquids", "EJ/yr"),
    ("GDP|MER", "billion US$2018/yr"),
    ("Emissions|CO2|Energy", "Mt CO2/yr"),
    ("Final Energy|Coal", "EJ/yr"),
    ("Primary Energy|Gas", "EJ/yr"),
    ("Secondary Energy|Liquids", "EJ/yr"),
    ("Capacity|Electricity", "GW"),
]
YEARS = list(range(1995, 2002))

MAP_DDL = ("dataset string, scenario string, region string, series_id string, variable string, "
           "factor decimal(10,2)")
MAP_SCHEMA = T.StructType([
    T.StructField("dataset", T.StringType()), T.StructField("scenario", T.StringType()),
    T.StructField("region", T.StringType()), T.StructField("series_id", T.StringType()),
    T.StructField("variable", T.StringType()), T.StructField("factor", T.DecimalType(10, 2)),
])


def orders_obs(spark: SparkSession, sf_dir: str, with_key: bool = False) -> DataFrame:
    """Observations from ``orders``: series 'S.<status>.<priority digit>', year of
    the order date, a unit per priority, value = total price as DECIMAL(18,2)."""
    from yearloom.plans.catalog import _t

    o = _t(spark, sf_dir, "orders")
    prio = F.substring("o_orderpriority", 1, 1)
    status = F.col("o_orderstatus")
    unit = (F.when(prio == "1", "quadrillion Btu")
            .when(prio == "2", "billion kilowatthours")
            .when(prio == "3", "million barrels per day")
            .when(prio == "4", F.when(status == "P", "thousand megawatthours").otherwise("billion 2012 $"))
            .otherwise(F.when(status == "P", "million short tons").otherwise("million metric tons")))
    cols = [F.concat(F.lit("S."), status, F.lit("."), prio).alias("series_id"),
            F.col("o_orderpriority").alias("name"),
            F.year("o_orderdate").cast("int").alias("year"), unit.alias("unit"),
            F.col("o_totalprice").cast(T.DecimalType(18, 2)).alias("value")]
    if with_key:
        cols = [F.col("o_orderkey")] + cols
    return o.select(*cols)


def lineitem_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projection-style observations from ``lineitem``."""
    from yearloom.plans.catalog import _t

    li = _t(spark, sf_dir, "lineitem")
    prefix = F.when(F.col("l_linestatus") == "F", "AEO.2020.REF2020.L").otherwise("AEO.2021.REF2021.L")
    return li.select(F.concat(prefix, F.col("l_returnflag")).alias("series_id"),
                     F.col("l_returnflag").alias("name"),
                     F.year("l_shipdate").cast("int").alias("year"),
                     F.when(F.col("l_returnflag") == "R", "million barrels per day").otherwise("trillion Btu").alias("unit"),
                     F.col("l_extendedprice").cast(T.DecimalType(18, 2)).alias("value"))


def map_frame(spark: SparkSession, rows, dataset: str, scenario: str) -> DataFrame:
    return local_frame(spark, [(dataset, scenario, "USA", s, v, f) for s, v, f in rows], MAP_DDL)


def aeo_template_frame(spark: SparkSession) -> DataFrame:
    return local_frame(spark, AEO_TEMPLATE, "variable string, series_template string, factor decimal(10,2)")


def template_frame(spark: SparkSession, rows=None) -> DataFrame:
    return local_frame(spark, rows if rows is not None else TEMPLATE, "variable string, unit string")


# --- SQL text for the same dims -------------------------------------------------

def sql_lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, Decimal):
        return f"CAST({v} AS DECIMAL(10,2))"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("'", "''") + "'"


def sql_values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(sql_lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


OBS_SQL = """
SELECT 'S.' || o_orderstatus || '.' || substr(o_orderpriority, 1, 1) AS series_id,
       o_orderpriority AS name,
       CAST(year(o_orderdate) AS INTEGER) AS year,
       CASE substr(o_orderpriority, 1, 1)
         WHEN '1' THEN 'quadrillion Btu'
         WHEN '2' THEN 'billion kilowatthours'
         WHEN '3' THEN 'million barrels per day'
         WHEN '4' THEN CASE WHEN o_orderstatus = 'P' THEN 'thousand megawatthours' ELSE 'billion 2012 $' END
         ELSE CASE WHEN o_orderstatus = 'P' THEN 'million short tons' ELSE 'million metric tons' END
       END AS unit,
       CAST(o_totalprice AS DECIMAL(18,2)) AS value,
       o_orderkey
FROM orders
"""

LOBS_SQL = """
SELECT CASE WHEN l_linestatus = 'F' THEN 'AEO.2020.REF2020.L' ELSE 'AEO.2021.REF2021.L' END || l_returnflag AS series_id,
       l_returnflag AS name,
       CAST(year(l_shipdate) AS INTEGER) AS year,
       CASE WHEN l_returnflag = 'R' THEN 'million barrels per day' ELSE 'trillion Btu' END AS unit,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS value
FROM lineitem
"""


def smap_sql(hist=HIST_MAP, steo=STEO_MAP) -> str:
    cols = ["series_id", "variable", "factor"]
    return (f"SELECT 'EIAHistoric' AS dataset, 'Historic' AS scenario, 'USA' AS region, series_id, variable, factor "
            f"FROM {sql_values(hist, cols)} "
            f"UNION ALL SELECT 'EIA_STEO', 'Ref', 'USA', series_id, variable, factor FROM {sql_values(steo, cols)}")


def aeo_map_sql() -> str:
    combos = [(d, s) for d in ("AEO.2020", "AEO.2021", "AEO.2022") for s in ("REF2020", "REF2021", "REF2022")]
    return (
        "SELECT ds AS dataset, sc AS scenario, 'USA' AS region, "
        "replace(replace(tmpl, '{EIA_dataset}', ds), '{EIA_scenario}', sc) AS series_id, variable, factor "
        f"FROM {sql_values(AEO_TEMPLATE, ['variable', 'tmpl', 'factor'])} CROSS JOIN {sql_values(combos, ['ds', 'sc'])}"
        .replace("AS t(ds, sc)", "AS c(ds, sc)")
    )


def template_sql(rows=None) -> str:
    return f"SELECT variable, unit FROM {sql_values(rows if rows is not None else TEMPLATE, ['variable', 'unit'])}"
