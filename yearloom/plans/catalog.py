"""Query catalogue: one Spark job per operator family, each over the driver's
tables, plus an equivalent SQL text for an independent engine.

Keys follow the survey's catalogue. Every query reads whole tables; values are
summed as DECIMAL and cast to double once so two engines agree bit for bit.
The SQL factor table below is derived by hand from the unit definitions (not
generated by the Spark code), so the conversion checks are independent.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yearloom.functions.text import below_threshold, parse_number_text
from yearloom.functions.unit_names import (TEMPLATE_DISPLAY_NAMES, UNIT_ALIASES, relabel_units,
                                           standardize_unit_names)
from yearloom.operators.aggregate import first_per_key, group_total_keep_rows, key_batches, scaled_rollup
from yearloom.operators.columns import where_matches
from yearloom.operators.joins import full_outer_with_dim, join_dim
from yearloom.operators.quality import (coverage_gaps, frequency_violations, nonmatch, unique_rows, unit_differences,
                                       unit_map_violations)
from yearloom.operators.reshape import pivot_longer, pivot_wider, union_by_name
from yearloom.operators.units.algebra import unit_factor_table
from yearloom.operators.units.convert import (convert_crosswalk, convert_from_set, convert_rowwise, convert_to_single,
                                              convert_value_columns, pack_units, unpack_units)
from yearloom.plans import fixtures as fx
from yearloom.plans.harmonize import (attach_units, change_tracker, clean_inventory, crosswalk_qa, display_unit_names,
                                      harmonize, map_and_rollup, template_units_present)
from yearloom.plans.mapping import build_series_map, clean_mapping, expand_industry_map, instantiate_template
from yearloom.sources.readers import explode_payload
from yearloom.session import materialize

Query = Callable[[SparkSession, str], DataFrame]


_TABLES: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table ``name``: resolved once per session (file listing and
    footer schema), like a catalog table; the tables are immutable inputs."""
    per_session = _TABLES.setdefault(spark, {})
    key = (sf_dir, name)
    df = per_session.get(key)
    if df is None:
        df = per_session[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df


def _dbl(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


# ---------------------------------------------------------------------------
# The 28 published unit pairs of the conversion QA crosswalk, in
# its order (from-unit, template unit).
# ---------------------------------------------------------------------------
GOLDEN_PAIRS = [
    ("2019 $/b", "US$2018/GJ"), ("2019 $/MMBtu", "US$2018/GJ"), ("2020 $/b", "US$2018/GJ"),
    ("2020 $/MMBtu", "US$2018/GJ"), ("2021 $/b", "US$2018/GJ"), ("2021 $/MMBtu", "US$2018/GJ"),
    ("billion 2012  $", "billion US$2018/yr"), ("billion 2012 $", "billion US$2018/yr"), ("Billion Btu", "EJ/yr"),
    ("billion chained 2012 dollars (seasonally-adjusted annual rate)", "billion US$2018/yr"),
    ("billion cubic_feet", "EJ/yr"), ("billion kilowatthours", "EJ/yr"), ("BkWh", "EJ/yr"),
    ("cents per kilowatt hour", "US$2018/GJ"), ("dollars per million Btu", "US$2018/GJ"), ("GW", "GW"),
    ("million barrelnew", "EJ/yr"), ("million kilowatts", "GW"), ("million metric tons CO2", "Mt CO2/yr"),
    ("Million Metric Tons of Carbon Dioxide", "Mt CO2/yr"), ("million short_tons_coal", "EJ/yr"),
    ("MMmt CO2", "Mt CO2/yr"), ("quadrillion Btu", "EJ/yr"), ("Quadrillion Btu", "EJ/yr"), ("quads", "EJ/yr"),
    ("thousand megawatthours", "EJ/yr"), ("trillion Btu", "EJ/yr"), ("Trillion Btu", "EJ/yr"),
]
# Pairs that must not convert (power vs energy, emissions vs energy, money vs
# energy, an unknown word).
INCONVERTIBLE_PAIRS = [("GW", "EJ/yr"), ("quads", "Mt CO2/yr"), ("BkWh", "GW"), ("2019 $/b", "EJ/yr"),
                       ("million kilowatts", "EJ/yr"), ("furlongs", "EJ/yr")]

# Hand-derived factors as SQL arithmetic (DOUBLE literals), same operation
# order as the definitions: scale(from) / scale(to), each scale a numerator
# product over a denominator product. Btu = 1055.05585262 J, Wh = 3600 J,
# barrelnew = 6.011708 GJ, cubic_feet = 1037 Btu, short_tons_coal = 18875000 Btu,
# US_YYYY_Dollar = (106.10422 / PPI_YYYY) x 100 cent.
_BTU = "1055.05585262e0"
_US = {y: f"((106.10422e0/{p})*100e0)" for y, p in
       (("2012", "101.51688e0"), ("2019", "106.43044e0"), ("2020", "103.96754e0"), ("2021", "115.35418e0"))}
_MMBTU = f"(1e6*{_BTU})"
_BARRELNEW = "(6.011708e0*1e9)"
_USD_PER_GJ = "(100e0/1e9)"
ORACLE_FACTORS = {
    ("2019 $/b", "US$2018/GJ"): f"(({_US['2019']}/{_BARRELNEW})/{_USD_PER_GJ})",
    ("2019 $/MMBtu", "US$2018/GJ"): f"(({_US['2019']}/{_MMBTU})/{_USD_PER_GJ})",
    ("2020 $/b", "US$2018/GJ"): f"(({_US['2020']}/{_BARRELNEW})/{_USD_PER_GJ})",
    ("2020 $/MMBtu", "US$2018/GJ"): f"(({_US['2020']}/{_MMBTU})/{_USD_PER_GJ})",
    ("2021 $/b", "US$2018/GJ"): f"(({_US['2021']}/{_BARRELNEW})/{_USD_PER_GJ})",
    ("2021 $/MMBtu", "US$2018/GJ"): f"(({_US['2021']}/{_MMBTU})/{_USD_PER_GJ})",
    ("billion 2012  $", "billion US$2018/yr"): f"((1e9*{_US['2012']})/(1e9*100e0))",
    ("billion 2012 $", "billion US$2018/yr"): f"((1e9*{_US['2012']})/(1e9*100e0))",
    ("Billion Btu", "EJ/yr"): f"((1e9*{_BTU})/1e18)",
    ("billion chained 2012 dollars (seasonally-adjusted annual rate)", "billion US$2018/yr"):
        f"((1e9*{_US['2012']})/(1e9*100e0))",
    ("billion cubic_feet", "EJ/yr"): f"((1e9*(1037e0*{_BTU}))/1e18)",
    ("billion kilowatthours", "EJ/yr"): "((1e9*(1e3*3600e0))/1e18)",
    ("BkWh", "EJ/yr"): "((1e9*(1e3*3600e0))/1e18)",
    ("cents per kilowatt hour", "US$2018/GJ"): f"((1e0/(1e3*3600e0))/{_USD_PER_GJ})",
    ("dollars per million Btu", "US$2018/GJ"): f"((100e0/{_MMBTU})/{_USD_PER_GJ})",
    ("GW", "GW"): "(1e9/1e9)",
    ("million barrelnew", "EJ/yr"): f"((1e6*{_BARRELNEW})/1e18)",
    ("million kilowatts", "GW"): "((1e6*1e3)/1e9)",
    ("million metric tons CO2", "Mt CO2/yr"): "1e0",
    ("Million Metric Tons of Carbon Dioxide", "Mt CO2/yr"): "1e0",
    ("million short_tons_coal", "EJ/yr"): f"((1e6*(18875000e0*{_BTU}))/1e18)",
    ("MMmt CO2", "Mt CO2/yr"): "1e0",
    ("quadrillion Btu", "EJ/yr"): f"((1e15*{_BTU})/1e18)",
    ("Quadrillion Btu", "EJ/yr"): f"((1e15*{_BTU})/1e18)",
    ("quads", "EJ/yr"): f"((1e15*{_BTU})/1e18)",
    ("thousand megawatthours", "EJ/yr"): "((1e3*(1e6*3600e0))/1e18)",
    ("trillion Btu", "EJ/yr"): f"((1e12*{_BTU})/1e18)",
    ("Trillion Btu", "EJ/yr"): f"((1e12*{_BTU})/1e18)",
}


def factors_sql(pairs=None) -> str:
    pairs = pairs if pairs is not None else list(ORACLE_FACTORS)
    rows = ", ".join(f"({fx.sql_lit(a)}, {fx.sql_lit(b)}, {ORACLE_FACTORS[(a, b)]})" for a, b in pairs)
    return f"(VALUES {rows}) AS f(from_unit, to_unit, factor)"


def std_sql(expr: str) -> str:
    """Ordered literal replace-all chain for the alias list (SQL side)."""
    out = expr
    for a, b in UNIT_ALIASES:
        out = f"replace({out}, {fx.sql_lit(a)}, {fx.sql_lit(b)})"
    return out


RELABEL_SQL = """regexp_replace(
  CASE WHEN regexp_matches(variable, 'coal', 'i') AND regexp_matches(u3, 'short tons', 'i')
       THEN regexp_replace(u3, 'short tons', 'short_tons_coal', 'g') ELSE u3 END,
  'barrels?', 'barrelnew', 'g')"""


def relabel_sql(variable: str, unit: str) -> tuple[str, str, str]:
    """The three CASE steps of rules R1-R3 (SQL side); R4 and R5 are RELABEL_SQL."""
    u1 = f"CASE WHEN {unit} = 'million barrels per day' THEN 'million barrels' ELSE {unit} END"
    u2 = f"CASE WHEN u1 = 'billion cubic feet per day' THEN 'billion cubic_feet' ELSE u1 END"
    u3 = ("CASE WHEN coalesce(contains(variable, 'Emissions|CO2') AND u2 = 'million metric tons', false) "
          "THEN 'million metric tons CO2' ELSE u2 END")
    return u1, u2, u3


def _relabel_select(src: str, cols: str, variable: str = "variable", unit: str = "unit") -> str:
    u1, u2, u3 = relabel_sql(variable, unit)
    return (f"SELECT {cols}, {RELABEL_SQL.replace('variable', variable)} AS unit FROM ("
            f"SELECT *, {u3} AS u3 FROM (SELECT *, {u2} AS u2 FROM (SELECT *, {u1} AS u1 FROM ({src}))))")


# ===========================================================================
# Mapping side
# ===========================================================================

def q_mapping_clean(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    raw = p.select(
        F.when(F.col("p_type") == "PROMO", F.lit(None)).otherwise(
            F.concat(F.lit("Part|"), "p_type", F.lit("|"), "p_brand")).alias("Variable"),
        F.col("p_name").alias("Series_Name"),
        F.concat(F.lit("P."), F.col("p_partkey").cast("string")).alias("Series_ID"),
        F.col("p_size").cast("double").alias("Factor"),
        F.lit("from part table").alias("notes"),
        F.col("p_brand").alias("Comments_brand"),
        F.lit(None).cast("string").alias("Empty"),
        F.lit("").alias("notes_variable"),
    )
    return clean_mapping(raw)


SQL_MAPPING_CLEAN = """
SELECT 'Part|' || p_type || '|' || p_brand AS variable, p_name AS series_name,
       'P.' || CAST(p_partkey AS VARCHAR) AS series_id, CAST(p_size AS DOUBLE) AS factor
FROM part WHERE p_type <> 'PROMO'
"""


def _industry_dims(spark, sf_dir):
    s, n, r, p = (_t(spark, sf_dir, x) for x in ("supplier", "nation", "region", "part"))
    sn = join_dim(s, n.withColumnRenamed("n_nationkey", "s_nationkey"), ["s_nationkey"], "inner", null_safe=False)
    snr = join_dim(sn, r.withColumnRenamed("r_regionkey", "n_regionkey"), ["n_regionkey"], "inner", null_safe=False)
    ind = snr.select(
        F.when(F.col("s_acctbal") < 0, F.lit("")).otherwise(F.col("s_name")).alias("EMF_industry_name"),
        F.col("r_name").alias("EMF_main_sector"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("EIA_abbrev"),
        F.when(F.col("s_nationkey") < 5, F.lit("")).otherwise(F.col("n_name")).alias("EIA_subsector"),
        F.lit("Industrial").alias("EIA_main_sector"),
        F.concat(F.lit("ind "), F.col("s_suppkey").cast("string")).alias("notes_ind_map"),
    )
    t = F.col("p_type")
    var = p.select(
        t.alias("EMF_subcategory"),
        F.when(t.isin("ECONOMY", "SMALL"), "Energy").when(t == "PROMO", "Emissions").when(t == "STANDARD", "Output")
         .when(t == "LARGE", F.lit(None)).otherwise("Other").alias("EMF_category"),
        F.lit("CNSM_").alias("EIA_prefix"),
        F.substring(t, 1, 3).alias("EIA_energy_code"),
        F.when(t == "MEDIUM", F.lit(None)).otherwise(F.lit("_NA")).alias("EIA_suffix"),
        F.lower(t).alias("EIA_category_name"),
        F.lit("var").alias("notes_var_map"),
    ).distinct()
    base = r.select(F.concat(F.lit("Region|"), "r_name").alias("Variable"),
                    F.concat(F.lit("{EIA_dataset}.{EIA_scenario}.R"), F.col("r_regionkey").cast("string")).alias("Series_template"),
                    F.col("r_name").alias("Series_Name"), F.lit(1.0).alias("Factor"))
    return ind, var, base


def q_grid_expand(spark, sf_dir):
    ind, var, base = _industry_dims(spark, sf_dir)
    return expand_industry_map(ind, var, base)


SQL_GRID_EXPAND = """
WITH ind AS (
  SELECT CASE WHEN s_acctbal < 0 THEN '' ELSE s_name END AS EMF_industry_name, r_name AS EMF_main_sector,
         'N' || CAST(s_nationkey AS VARCHAR) AS EIA_abbrev,
         CASE WHEN s_nationkey < 5 THEN '' ELSE n_name END AS EIA_subsector,
         'Industrial' AS EIA_main_sector, 'ind ' || CAST(s_suppkey AS VARCHAR) AS notes_ind_map
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
var AS (
  SELECT DISTINCT p_type AS EMF_subcategory,
         CASE WHEN p_type IN ('ECONOMY','SMALL') THEN 'Energy' WHEN p_type = 'PROMO' THEN 'Emissions'
              WHEN p_type = 'STANDARD' THEN 'Output' WHEN p_type = 'LARGE' THEN NULL ELSE 'Other' END AS EMF_category,
         'CNSM_' AS EIA_prefix, substr(p_type, 1, 3) AS EIA_energy_code,
         CASE WHEN p_type = 'MEDIUM' THEN NULL ELSE '_NA' END AS EIA_suffix,
         lower(p_type) AS EIA_category_name, 'var' AS notes_var_map
  FROM part),
g AS (
  SELECT * FROM (SELECT DISTINCT * FROM ind WHERE EMF_industry_name <> '') i
  CROSS JOIN (SELECT DISTINCT EMF_subcategory FROM var) s
  LEFT JOIN var USING (EMF_subcategory))
SELECT CASE WHEN EMF_category IS NULL THEN NULL
            WHEN EMF_category = 'Energy' THEN 'Final Energy|Industry|' || EMF_main_sector || '|' || EMF_industry_name || '|' || EMF_subcategory
            WHEN EMF_category = 'Emissions' THEN 'Emissions|CO2|Energy|Demand|Industry|' || EMF_main_sector || '|' || EMF_industry_name
            WHEN EMF_category = 'Output' THEN 'Output|Industry|' || EMF_main_sector || '|' || EMF_industry_name || '|Value'
            ELSE NULL END AS Variable,
       '{EIA_dataset}.{EIA_scenario}.' || coalesce(EIA_prefix,'NA') || coalesce(EIA_abbrev,'NA') || '_'
         || coalesce(EIA_energy_code,'NA') || coalesce(EIA_suffix,'NA') AS Series_template,
       CASE WHEN EIA_subsector IS NULL THEN NULL
            WHEN EIA_subsector <> '' THEN coalesce(EIA_main_sector,'NA') || ' : ' || EIA_subsector || ' : ' || coalesce(EIA_category_name,'NA')
            ELSE coalesce(EIA_main_sector,'NA') || ' : ' || coalesce(EIA_category_name,'NA') END AS Series_Name,
       coalesce(notes_var_map,'NA') || '. ' || coalesce(notes_ind_map,'NA') AS notes,
       1.0::DOUBLE AS Factor, '' AS notes_variable
FROM g
UNION ALL
SELECT 'Region|' || r_name, '{EIA_dataset}.{EIA_scenario}.R' || CAST(r_regionkey AS VARCHAR), r_name, NULL, 1.0::DOUBLE, NULL
FROM region
"""


def q_key_interpolate(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    tmpl = p.select(
        F.concat(F.lit("Part|"), "p_type").alias("variable"),
        F.concat(F.lit("{EIA_dataset}.{EIA_scenario}."), "p_brand", F.lit("."), F.col("p_partkey").cast("string"),
                 F.when(F.col("p_size") > 25, F.lit(".{EIA_dataset}")).otherwise(F.lit(""))).alias("series_template"),
        F.col("p_size").cast("double").alias("factor"))
    return instantiate_template(tmpl)


SQL_KEY_INTERPOLATE = """
WITH tmpl AS (
  SELECT 'Part|' || p_type AS variable,
         '{EIA_dataset}.{EIA_scenario}.' || p_brand || '.' || CAST(p_partkey AS VARCHAR)
           || CASE WHEN p_size > 25 THEN '.{EIA_dataset}' ELSE '' END AS t,
         CAST(p_size AS DOUBLE) AS factor
  FROM part),
g AS (SELECT * FROM tmpl CROSS JOIN (VALUES ('AEO.2020'), ('AEO.2021'), ('AEO.2022')) d(ds)
                         CROSS JOIN (VALUES ('REF2020'), ('REF2021'), ('REF2022')) s(sc)),
s1 AS (SELECT *, CASE WHEN strpos(t, '{EIA_dataset}') > 0
                      THEN substr(t, 1, strpos(t, '{EIA_dataset}') - 1) || ds || substr(t, strpos(t, '{EIA_dataset}') + 13)
                      ELSE t END AS t1 FROM g),
s2 AS (SELECT *, CASE WHEN strpos(t1, '{EIA_scenario}') > 0
                      THEN substr(t1, 1, strpos(t1, '{EIA_scenario}') - 1) || sc || substr(t1, strpos(t1, '{EIA_scenario}') + 14)
                      ELSE t1 END AS t2 FROM s1)
SELECT ds AS dataset, sc AS scenario, 'USA' AS region, t2 AS series_id, variable, factor FROM s2
"""


def q_key_batches(spark, sf_dir):
    return key_batches(_t(spark, sf_dir, "orders"), "o_custkey", 100)


SQL_KEY_BATCHES = """
SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) AS key_index,
       CAST(ceil(row_number() OVER (ORDER BY o_custkey) / 100.0) AS BIGINT) AS batch
FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL)
"""


def q_payload_explode(spark, sf_dir):
    """Payload rows (one per series, points nested) built from events, then
    ingested. Each series' array is bounded by its number of periods: points
    are aggregated per (series, period) before the nesting."""
    e = _t(spark, sf_dir, "events")
    points = (e.groupBy(F.concat_ws(".", "event_type", F.col("user_id").cast("string")).alias("series_id"),
                        F.col("event_type").alias("name"),
                        (F.lit(2000) + F.dayofmonth("ts")).cast("int").alias("year"))
              .agg(F.sum(F.col("value").cast(T.DecimalType(18, 2))).cast("double").alias("value")))
    payload = (points.groupBy("series_id", "name")
               .agg(F.collect_list(F.struct("year", "value")).alias("data"))
               .withColumn("units", F.lit("events")))
    return explode_payload(payload)


SQL_PAYLOAD_EXPLODE = """
SELECT event_type || '.' || CAST(user_id AS VARCHAR) AS series_id, event_type AS name,
       CAST(2000 + dayofmonth(ts) AS INTEGER) AS year, 'events' AS unit,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM events GROUP BY 1, 2, 3
"""


# ===========================================================================
# Joins and roll-up
# ===========================================================================

def _series_map(spark):
    return build_series_map(fx.map_frame(spark, fx.HIST_MAP, "EIAHistoric", "Historic"),
                            fx.map_frame(spark, fx.STEO_MAP, "EIA_STEO", "Ref"))


FULL_JOIN_EXTRA_MAP = [(None, "Unkeyed", Decimal("1"))]


def q_series_map_full_join(spark, sf_dir):
    obs = fx.orders_obs(spark, sf_dir).withColumn("series_id", F.nullif(F.col("series_id"), F.lit("S.P.3")))
    m = union_by_name([_series_map(spark), fx.map_frame(spark, FULL_JOIN_EXTRA_MAP, "EIAHistoric", "Historic")])
    out = full_outer_with_dim(obs.drop("name"), m, ["series_id"])
    return _dbl(out, ["value", "factor"])


def _full_map_sql():
    extra = "SELECT 'EIAHistoric', 'Historic', 'USA', CAST(NULL AS VARCHAR), 'Unkeyed', CAST(1 AS DECIMAL(10,2))"
    return f"{fx.smap_sql()} UNION ALL {extra}"


SQL_SERIES_MAP_FULL_JOIN = f"""
WITH obs AS (SELECT nullif(series_id, 'S.P.3') AS series_id, year, unit, value FROM ({fx.OBS_SQL})),
m AS ({_full_map_sql()})
SELECT coalesce(o.series_id, m.series_id) AS series_id, o.year, o.unit, CAST(o.value AS DOUBLE) AS value,
       m.dataset, m.scenario, m.region, m.variable, CAST(m.factor AS DOUBLE) AS factor
FROM obs o FULL OUTER JOIN m ON o.series_id IS NOT DISTINCT FROM m.series_id
"""


def q_scaled_rollup(spark, sf_dir):
    return _dbl(map_and_rollup(fx.orders_obs(spark, sf_dir), _series_map(spark)), ["value"])


SQL_ROLLUP_CORE = f"""
SELECT dataset AS model, scenario, region, variable, year, unit,
       CASE WHEN count(*) = count(v) THEN sum(v) END AS value
FROM (SELECT m.dataset, m.scenario, m.region, m.variable, o.year, o.unit, o.value * m.factor AS v
      FROM ({fx.OBS_SQL}) o JOIN ({fx.smap_sql()}) m ON o.series_id = m.series_id)
GROUP BY dataset, scenario, region, variable, year, unit
"""

SQL_SCALED_ROLLUP = f"SELECT model, scenario, region, variable, year, unit, CAST(value AS DOUBLE) AS value FROM ({SQL_ROLLUP_CORE})"


def _lineitem_poison(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        F.concat(F.lit("L"), "l_returnflag").alias("dataset"), F.col("l_linestatus").alias("scenario"),
        F.lit("USA").alias("region"), F.concat(F.lit("Supplier|"), F.col("l_suppkey").cast("string")).alias("variable"),
        F.lit("units").alias("unit"), F.year("l_shipdate").cast("int").alias("year"),
        F.nullif(F.col("l_quantity"), F.lit(50.0)).cast(T.DecimalType(18, 2)).alias("value"),
        F.lit(Decimal("1")).cast(T.DecimalType(10, 2)).alias("factor"))


def q_rollup_null_poison(spark, sf_dir):
    return _dbl(scaled_rollup(_lineitem_poison(spark, sf_dir)), ["value"])


SQL_ROLLUP_NULL_POISON = """
SELECT 'L' || l_returnflag AS model, l_linestatus AS scenario, 'USA' AS region,
       'Supplier|' || CAST(l_suppkey AS VARCHAR) AS variable, CAST(year(l_shipdate) AS INTEGER) AS year, 'units' AS unit,
       CASE WHEN count(*) = count(v) THEN CAST(sum(v) AS DOUBLE) END AS value
FROM (SELECT *, CAST(nullif(l_quantity, 50.0) AS DECIMAL(18,2)) AS v FROM lineitem)
GROUP BY 1, 2, 3, 4, 5, 6
"""


def q_group_total_keep_rows(spark, sf_dir):
    li = _lineitem_poison(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_suppkey", "year", "value")
    out = group_total_keep_rows(li, ["l_suppkey", "year"], "value", "group_total")
    return _dbl(out, ["value", "group_total"])


SQL_GROUP_TOTAL_KEEP_ROWS = """
SELECT l_orderkey, l_linenumber, l_suppkey, year, CAST(v AS DOUBLE) AS value,
       CASE WHEN count(*) OVER w = count(v) OVER w THEN CAST(sum(v) OVER w AS DOUBLE) END AS group_total
FROM (SELECT l_orderkey, l_linenumber, l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year,
             CAST(nullif(l_quantity, 50.0) AS DECIMAL(18,2)) AS v FROM lineitem)
WINDOW w AS (PARTITION BY l_suppkey, year)
"""


def q_template_units_present(spark, sf_dir):
    data = join_dim(fx.orders_obs(spark, sf_dir), _series_map(spark), ["series_id"], "inner")
    return template_units_present(fx.template_frame(spark), data)


SQL_TEMPLATE_UNITS_PRESENT = f"""
SELECT DISTINCT variable, unit AS emf_units FROM ({fx.template_sql()}) t
WHERE variable IN (SELECT m.variable FROM ({fx.OBS_SQL}) o JOIN ({fx.smap_sql()}) m ON o.series_id = m.series_id)
"""

NULL_VAR_MAP = [("S.P.2", None, Decimal("1"))]
NULL_VAR_TEMPLATE = fx.TEMPLATE + [(None, "EJ/yr")]


def q_attach_units_full(spark, sf_dir):
    m = union_by_name([_series_map(spark), fx.map_frame(spark, NULL_VAR_MAP, "EIAHistoric", "Historic")])
    rolled = map_and_rollup(fx.orders_obs(spark, sf_dir), m)
    t = fx.template_frame(spark, NULL_VAR_TEMPLATE).withColumnRenamed("unit", "emf_units")
    return _dbl(full_outer_with_dim(rolled, t, ["variable"]), ["value"])


SQL_ATTACH_UNITS_FULL = f"""
WITH m AS ({fx.smap_sql(hist=fx.HIST_MAP + NULL_VAR_MAP)}),
r AS (SELECT dataset AS model, scenario, region, variable, year, unit,
             CASE WHEN count(*) = count(v) THEN sum(v) END AS value
      FROM (SELECT m.dataset, m.scenario, m.region, m.variable, o.year, o.unit, o.value * m.factor AS v
            FROM ({fx.OBS_SQL}) o JOIN m ON o.series_id = m.series_id)
      GROUP BY ALL),
t AS ({fx.template_sql(NULL_VAR_TEMPLATE)})
SELECT r.model, r.scenario, r.region, coalesce(r.variable, t.variable) AS variable, r.year, r.unit,
       CAST(r.value AS DOUBLE) AS value, t.unit AS emf_units
FROM r FULL OUTER JOIN t ON r.variable IS NOT DISTINCT FROM t.variable
"""

# ===========================================================================
# Unit names, factors, conversion
# ===========================================================================

# Units cycled over part rows for the relabel rules.
RELABEL_UNITS = ["million barrels per day", "billion cubic feet per day", "million metric tons", "million short tons",
                 "Million Short Tons", "million barrels", "million barrel", "thousand barrels", "short tons",
                 "quadrillion Btu"]


def _pick(key_col: str, values) -> F.Column:
    idx = (F.col(key_col) % len(values)).cast("int")
    expr = F.lit(None).cast("string")
    for i, v in enumerate(values):
        expr = F.when(idx == i, F.lit(v)).otherwise(expr)
    return expr


def _pick_sql(key_col: str, values) -> str:
    body = " ".join(f"WHEN {i} THEN {fx.sql_lit(v)}" for i, v in enumerate(values))
    return f"CASE CAST({key_col} % {len(values)} AS INTEGER) {body} END"


def _relabel_part(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    t = F.col("p_type")
    variable = (F.when(t == "ECONOMY", "Primary Energy|Coal").when(t == "PROMO", "Emissions|CO2|Energy")
                .when(t == "SMALL", "Final Energy|coal|Industry").when(t == "LARGE", "Emissions|CO2 Intensity")
                .otherwise(F.concat(F.lit("Secondary Energy|"), t)))
    return p.select("p_partkey", variable.alias("variable"), _pick("p_partkey", RELABEL_UNITS).alias("unit_in"))


def q_unit_relabel(spark, sf_dir):
    df = _relabel_part(spark, sf_dir)
    return df.withColumn("unit", relabel_units(F.col("variable"), F.col("unit_in")))


SQL_UNIT_RELABEL = _relabel_select(f"""
SELECT p_partkey,
       CASE p_type WHEN 'ECONOMY' THEN 'Primary Energy|Coal' WHEN 'PROMO' THEN 'Emissions|CO2|Energy'
                   WHEN 'SMALL' THEN 'Final Energy|coal|Industry' WHEN 'LARGE' THEN 'Emissions|CO2 Intensity'
                   ELSE 'Secondary Energy|' || p_type END AS variable,
       {_pick_sql('p_partkey', RELABEL_UNITS)} AS unit_in
FROM part""", "p_partkey, variable, unit_in", unit="unit_in")


def _golden_part(spark, sf_dir, pairs):
    p = _t(spark, sf_dir, "part")
    return p.select("p_partkey", _pick("p_size", [a for a, _ in pairs]).alias("from_unit"),
                    _pick("p_size", [b for _, b in pairs]).alias("to_unit"))


def _golden_part_sql(pairs) -> str:
    return (f"SELECT p_partkey, {_pick_sql('p_size', [a for a, _ in pairs])} AS from_unit, "
            f"{_pick_sql('p_size', [b for _, b in pairs])} AS to_unit FROM part")


def q_unit_standardize(spark, sf_dir):
    df = _golden_part(spark, sf_dir, GOLDEN_PAIRS)
    return df.select("p_partkey", "from_unit", standardize_unit_names(F.col("from_unit")).alias("from_units_unit"),
                     standardize_unit_names(F.col("to_unit")).alias("to_units_unit"), "to_unit")


SQL_UNIT_STANDARDIZE = f"""
SELECT p_partkey, from_unit, {std_sql('from_unit')} AS from_units_unit, {std_sql('to_unit')} AS to_units_unit, to_unit
FROM ({_golden_part_sql(GOLDEN_PAIRS)})
"""


def q_unit_factors(spark, sf_dir):
    pairs = _golden_part(spark, sf_dir, GOLDEN_PAIRS).select("from_unit", "to_unit").distinct()
    return unit_factor_table(pairs)


SQL_UNIT_FACTORS = f"""
SELECT p.from_unit, p.to_unit, {std_sql('p.from_unit')} AS from_units_unit, {std_sql('p.to_unit')} AS to_units_unit,
       f.factor, true AS convertible
FROM (SELECT DISTINCT from_unit, to_unit FROM ({_golden_part_sql(GOLDEN_PAIRS)})) p
JOIN {factors_sql()} ON p.from_unit = f.from_unit AND p.to_unit = f.to_unit
"""

ALL_PAIRS = GOLDEN_PAIRS + INCONVERTIBLE_PAIRS


def q_unit_convertible(spark, sf_dir):
    pairs = _golden_part(spark, sf_dir, ALL_PAIRS).select("from_unit", "to_unit").distinct()
    return unit_factor_table(pairs).select("from_unit", "to_unit", "convertible")


SQL_UNIT_CONVERTIBLE = f"""
SELECT DISTINCT from_unit, to_unit,
       NOT ((from_unit, to_unit) IN ({', '.join(f"({fx.sql_lit(a)}, {fx.sql_lit(b)})" for a, b in INCONVERTIBLE_PAIRS)}))
         AS convertible
FROM ({_golden_part_sql(ALL_PAIRS)})
"""

# A unit per (return flag, line status) of lineitem.
LINE_UNITS = {("A", "F"): "quadrillion Btu", ("A", "O"): "trillion Btu", ("N", "F"): "million barrelnew",
              ("N", "O"): "billion kilowatthours", ("R", "F"): "million metric tons CO2", ("R", "O"): "GW"}


def _line_units(spark, sf_dir, with_target: bool = False):
    li = _t(spark, sf_dir, "lineitem")
    unit = F.lit(None).cast("string")
    for (rf, ls), u in LINE_UNITS.items():
        unit = F.when((F.col("l_returnflag") == rf) & (F.col("l_linestatus") == ls), F.lit(u)).otherwise(unit)
    df = li.select("l_orderkey", "l_linenumber", unit.alias("unit"), F.col("l_extendedprice").alias("value"))
    if with_target:
        to = (F.when(F.col("l_linenumber") == 7, F.col("unit"))
              .when(F.col("unit") == "GW", F.lit(None))
              .when(F.col("unit") == "million metric tons CO2", F.lit("Mt CO2/yr"))
              .otherwise(F.lit("EJ/yr")))
        df = df.withColumn("target", to)
    return df


def _line_units_sql(with_target: bool = False) -> str:
    body = " ".join(f"WHEN l_returnflag = '{rf}' AND l_linestatus = '{ls}' THEN {fx.sql_lit(u)}"
                    for (rf, ls), u in LINE_UNITS.items())
    base = f"SELECT l_orderkey, l_linenumber, CASE {body} END AS unit, l_extendedprice AS value FROM lineitem"
    if not with_target:
        return base
    return (f"SELECT *, CASE WHEN l_linenumber = 7 THEN unit WHEN unit = 'GW' THEN NULL "
            f"WHEN unit = 'million metric tons CO2' THEN 'Mt CO2/yr' ELSE 'EJ/yr' END AS target FROM ({base})")


def _convert_sql(src: str, join_on: str, cols: str = "l_orderkey, l_linenumber", pairs=None) -> str:
    return (f"SELECT {cols}, CASE WHEN f.factor IS NULL THEN s.unit ELSE f.to_unit END AS unit, "
            f"CASE WHEN f.factor IS NULL THEN s.value ELSE s.value * f.factor END AS value "
            f"FROM ({src}) s LEFT JOIN {factors_sql(pairs)} ON {join_on}")


_LINE_PAIRS = [("quadrillion Btu", "EJ/yr"), ("trillion Btu", "EJ/yr"), ("million barrelnew", "EJ/yr"),
               ("billion kilowatthours", "EJ/yr"), ("million metric tons CO2", "Mt CO2/yr")]


def q_convert_rowwise(spark, sf_dir):
    df = _line_units(spark, sf_dir, with_target=True)
    return convert_rowwise(df, F.col("target")).drop("target")


SQL_CONVERT_ROWWISE = _convert_sql(_line_units_sql(True), "s.unit = f.from_unit AND s.target = f.to_unit",
                                   pairs=_LINE_PAIRS)


def q_convert_single_target(spark, sf_dir):
    return convert_to_single(_line_units(spark, sf_dir), "EJ/yr")


SQL_CONVERT_SINGLE_TARGET = _convert_sql(
    _line_units_sql(), "s.unit = f.from_unit AND f.to_unit = 'EJ/yr'",
    pairs=[p for p in _LINE_PAIRS if p[1] == "EJ/yr"])


def q_convert_from_set(spark, sf_dir):
    return convert_from_set(_line_units(spark, sf_dir), ["quadrillion Btu", "billion kilowatthours"], "EJ/yr")


SQL_CONVERT_FROM_SET = _convert_sql(
    _line_units_sql(), "s.unit = f.from_unit",
    pairs=[("quadrillion Btu", "EJ/yr"), ("billion kilowatthours", "EJ/yr")])

LINE_CROSSWALK = _LINE_PAIRS + [("GW", None)]


def q_convert_crosswalk(spark, sf_dir):
    return convert_crosswalk(_line_units(spark, sf_dir), LINE_CROSSWALK)


SQL_CONVERT_CROSSWALK = _convert_sql(_line_units_sql(), "s.unit = f.from_unit", pairs=_LINE_PAIRS)


def _value_column_spec(df):
    return df.withColumn("to_unit", F.when(F.col("l_linenumber") == 7, F.lit("EJ/yr"))
                         .when(F.col("unit") == "GW", F.lit("GW"))
                         .when(F.col("unit") == "million metric tons CO2", F.lit("Mt CO2/yr"))
                         .otherwise(F.lit("EJ/yr")))


def q_convert_value_columns(spark, sf_dir):
    """A converted value column next to the original; same unit -> factor 1,
    an inconvertible pair (line 7 asks GW or CO2 in EJ/yr) -> missing."""
    df = _value_column_spec(_line_units(spark, sf_dir))
    return convert_value_columns(df, "value", "unit", "to_unit", "to_value")


SQL_CONVERT_VALUE_COLUMNS = f"""
SELECT s.l_orderkey, s.l_linenumber, s.unit, s.value, s.to_unit,
       CASE WHEN s.unit = s.to_unit THEN s.value * 1e0 ELSE s.value * f.factor END AS to_value
FROM (SELECT *, CASE WHEN l_linenumber = 7 THEN 'EJ/yr' WHEN unit = 'GW' THEN 'GW'
                     WHEN unit = 'million metric tons CO2' THEN 'Mt CO2/yr' ELSE 'EJ/yr' END AS to_unit
      FROM ({_line_units_sql()})) s
LEFT JOIN {factors_sql(_LINE_PAIRS)} ON s.unit = f.from_unit AND s.to_unit = f.to_unit
"""


def q_frequency_violations(spark, sf_dir):
    """Series with more than one observation in a year."""
    return frequency_violations(fx.orders_obs(spark, sf_dir))


SQL_FREQUENCY_VIOLATIONS = f"""
SELECT series_id, year, count(*) AS n_rows FROM ({fx.OBS_SQL}) GROUP BY series_id, year HAVING count(*) > 1
"""


def q_pack_unpack_units(spark, sf_dir):
    """The packed quantity goes through an aggregate (the largest of each order, by value then unit) before it is unpacked."""
    packed = pack_units(_line_units(spark, sf_dir))
    return unpack_units(packed.groupBy("l_orderkey").agg(F.max("quantity").alias("quantity"), F.count("*").alias("n_lines")))


SQL_PACK_UNPACK_UNITS = f"""
SELECT l_orderkey, count(*) OVER (PARTITION BY l_orderkey) AS n_lines, value, unit FROM ({_line_units_sql()})
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY value DESC, unit DESC NULLS LAST) = 1
"""


def q_lookup_reverse_names(spark, sf_dir):
    obs = fx.orders_obs(spark, sf_dir, with_key=True)
    j = join_dim(obs, _series_map(spark), ["series_id"], "inner")
    j = join_dim(j, fx.template_frame(spark).withColumnRenamed("unit", "emf_units"), ["variable"], "left")
    named = display_unit_names(j.withColumn("target_unit", F.coalesce("emf_units", "unit")), ["target_unit"])
    return named.select("o_orderkey", "variable", "unit", "target_unit", F.col("target_unit_display").alias("display_unit"))


def _display_sql(x: str) -> str:
    body = " ".join(f"WHEN {x} = {fx.sql_lit(a)} THEN {fx.sql_lit(b)}" for a, b in TEMPLATE_DISPLAY_NAMES)
    return f"CASE {body} ELSE {x} END"


SQL_LOOKUP_REVERSE_NAMES = f"""
SELECT o_orderkey, variable, unit, target_unit, {_display_sql('std')} AS display_unit
FROM (SELECT *, {std_sql('target_unit')} AS std FROM (
  SELECT o.o_orderkey, m.variable, o.unit, coalesce(t.unit, o.unit) AS target_unit
  FROM ({fx.OBS_SQL}) o JOIN ({fx.smap_sql()}) m ON o.series_id = m.series_id
  LEFT JOIN ({fx.template_sql()}) t ON m.variable = t.variable))
"""

# ===========================================================================
# The flagship pipeline and what hangs off it
# ===========================================================================


def flagship_inputs(spark, sf_dir):
    obs = union_by_name([fx.orders_obs(spark, sf_dir), fx.lineitem_obs(spark, sf_dir)])
    aeo = instantiate_template(fx.aeo_template_frame(spark))
    smap = build_series_map(aeo, fx.map_frame(spark, fx.HIST_MAP, "EIAHistoric", "Historic"),
                            fx.map_frame(spark, fx.STEO_MAP, "EIA_STEO", "Ref"))
    return obs, smap, fx.template_frame(spark)


def _attached(spark, sf_dir):
    obs, smap, template = flagship_inputs(spark, sf_dir)
    rolled = map_and_rollup(obs, smap)
    tu = template.select("variable", F.col("unit").alias("emf_units")).distinct()
    return materialize(attach_units(rolled, tu, template_rows=len(fx.TEMPLATE)))


def q_harmonize_flagship(spark, sf_dir):
    obs, smap, template = flagship_inputs(spark, sf_dir)
    return harmonize(obs, smap, template, years=fx.YEARS)["wide"]


_FLAG_PAIRS = [("quadrillion Btu", "EJ/yr"), ("billion kilowatthours", "EJ/yr"), ("million barrelnew", "EJ/yr"),
               ("billion 2012 $", "billion US$2018/yr"), ("million metric tons CO2", "Mt CO2/yr"),
               ("million short_tons_coal", "EJ/yr"), ("trillion Btu", "EJ/yr")]

SQL_FLAG_ATTACHED = f"""
WITH obs AS (SELECT series_id, year, unit, value FROM ({fx.OBS_SQL}) UNION ALL SELECT series_id, year, unit, value FROM ({fx.LOBS_SQL})),
m AS ({fx.aeo_map_sql()} UNION ALL {fx.smap_sql()}),
r AS (SELECT dataset AS model, scenario, region, variable, year, unit,
             CASE WHEN count(*) = count(v) THEN sum(v) END AS value
      FROM (SELECT m.dataset, m.scenario, m.region, m.variable, o.year, o.unit, o.value * m.factor AS v
            FROM obs o JOIN m ON o.series_id = m.series_id)
      GROUP BY ALL),
a AS (SELECT r.*, t.unit AS emf_units FROM r LEFT JOIN ({fx.template_sql()}) t ON r.variable = t.variable
      WHERE r.value IS NOT NULL)
{_relabel_select("SELECT * FROM a", "model, scenario, region, variable, year, value, emf_units")}
"""

SQL_FLAG_LONG = f"""
SELECT model, scenario, region, variable, CASE WHEN f.factor IS NULL THEN s.unit ELSE f.to_unit END AS unit, year,
       CASE WHEN f.factor IS NULL THEN CAST(s.value AS DOUBLE) ELSE CAST(s.value AS DOUBLE) * f.factor END AS value,
       emf_units
FROM ({SQL_FLAG_ATTACHED}) s LEFT JOIN {factors_sql(_FLAG_PAIRS)} ON s.unit = f.from_unit
"""

_YEAR_COLS = ", ".join(f'max(CASE WHEN year = {y} THEN value END) AS "{y}"' for y in fx.YEARS)

SQL_FLAG_TAGGED = f"""
SELECT model, scenario, region, variable, unit, year, value FROM ({SQL_FLAG_LONG}) WHERE lower(model) LIKE '%aeo%'
UNION ALL
SELECT 'EIA_Historic', scenario, region, variable, unit, year, value FROM ({SQL_FLAG_LONG}) WHERE lower(scenario) LIKE '%historic%'
UNION ALL
SELECT 'EIA_STEO', scenario, region, variable, unit, year, value FROM ({SQL_FLAG_LONG}) WHERE lower(model) LIKE '%steo%'
"""

SQL_HARMONIZE_FLAGSHIP = f"""
SELECT model, scenario, region, variable, unit, {_YEAR_COLS}
FROM ({SQL_FLAG_TAGGED}) GROUP BY model, scenario, region, variable, unit
"""


def q_crosswalk_qa(spark, sf_dir):
    return crosswalk_qa(_attached(spark, sf_dir))


SQL_CROSSWALK_QA = f"""
SELECT from_unit, {std_sql('from_unit')} AS from_units_unit, {std_sql('to_unit')} AS to_units_unit, to_unit
FROM (SELECT DISTINCT unit AS from_unit, emf_units AS to_unit FROM ({SQL_FLAG_ATTACHED}))
"""


def q_pivot_years(spark, sf_dir):
    obs, smap, template = flagship_inputs(spark, sf_dir)
    long = harmonize(obs, smap, template, years=fx.YEARS, build_wide=False)["long"]
    aeo = where_matches(long, "model", "AEO")
    return pivot_wider(aeo, ["model", "scenario", "region", "variable", "unit"], "year", "value", fx.YEARS)


SQL_PIVOT_YEARS = f"""
SELECT model, scenario, region, variable, unit, {_YEAR_COLS}
FROM ({SQL_FLAG_LONG}) WHERE lower(model) LIKE '%aeo%' GROUP BY model, scenario, region, variable, unit
"""

CHANGE_YEARS = [1996, 1998, 2000]


def q_change_tracker(spark, sf_dir):
    wide = q_harmonize_flagship(spark, sf_dir)
    return change_tracker(wide, CHANGE_YEARS)


SQL_CHANGE_TRACKER = f"""
SELECT model, scenario, region, variable, unit,
       {', '.join(f'CAST(round(CAST(CAST("{y}" AS VARCHAR) AS DECIMAL(38,21)), 2) AS DOUBLE) AS "{y}"' for y in CHANGE_YEARS)}
FROM ({SQL_HARMONIZE_FLAGSHIP})
"""


def q_violations_unique(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").cast("int").alias("year"))
    return unique_rows(o, ["o_custkey", "year"])


SQL_VIOLATIONS_UNIQUE = """
SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_rows
FROM orders GROUP BY 1, 2 HAVING count(*) > 1
"""


def _unit_map_crosswalk(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    rf = F.col("l_returnflag")
    frm = F.when(rf == "A", "quadrillion Btu").when(rf == "N", "billion kilowatthours").otherwise("GW")
    to = F.when(F.col("l_linestatus") == "F", F.lit("EJ/yr")).otherwise(
        F.when(rf == "R", F.lit("GW")).when(rf == "N", F.lit(None)).otherwise(F.lit("EJ/yr")))
    return li.select(frm.alias("from_unit"), to.alias("to_unit"))


def q_violations_unit_map(spark, sf_dir):
    return unit_map_violations(_unit_map_crosswalk(spark, sf_dir)).select("from_unit", "n_targets")


SQL_VIOLATIONS_UNIT_MAP = """
SELECT from_unit, count(*) AS n_targets FROM (
  SELECT DISTINCT
    CASE l_returnflag WHEN 'A' THEN 'quadrillion Btu' WHEN 'N' THEN 'billion kilowatthours' ELSE 'GW' END AS from_unit,
    CASE WHEN l_linestatus = 'F' THEN 'EJ/yr'
         ELSE CASE l_returnflag WHEN 'R' THEN 'GW' WHEN 'N' THEN NULL ELSE 'EJ/yr' END END AS to_unit
  FROM lineitem)
GROUP BY from_unit HAVING count(*) > 1
"""

PARTIAL_SET = ["quadrillion Btu", "trillion Btu"]


def q_violations_nonmatch(spark, sf_dir):
    conv = convert_from_set(_attached(spark, sf_dir), PARTIAL_SET, "EJ/yr")
    return _dbl(nonmatch(conv), ["value"])


SQL_VIOLATIONS_NONMATCH = f"""
SELECT model, scenario, region, variable, year, unit, value, emf_units FROM (
  SELECT model, scenario, region, variable, year, emf_units,
         CASE WHEN f.factor IS NULL THEN s.unit ELSE f.to_unit END AS unit,
         CASE WHEN f.factor IS NULL THEN CAST(s.value AS DOUBLE) ELSE CAST(s.value AS DOUBLE) * f.factor END AS value
  FROM ({SQL_FLAG_ATTACHED}) s LEFT JOIN {factors_sql([(u, 'EJ/yr') for u in PARTIAL_SET])} ON s.unit = f.from_unit)
WHERE unit <> emf_units
"""


def q_unit_differences(spark, sf_dir):
    attached = _attached(spark, sf_dir)
    return unit_differences(attached, fx.template_frame(spark))


SQL_UNIT_DIFFERENCES = f"""
SELECT c.model, c.scenario, c.variable, c.unit, t.unit AS benchmark_unit
FROM (SELECT DISTINCT model, scenario, variable, unit FROM ({SQL_FLAG_ATTACHED})) c
LEFT JOIN ({fx.template_sql()}) t ON c.variable = t.variable
WHERE c.unit <> t.unit
"""

# Template and map variants for the coverage report.
COVERAGE_TEMPLATE = fx.TEMPLATE + [("Memo|Electricity", "GW"), ("Secondary Energy|Hydrogen", "EJ/yr")]
COVERAGE_EXTRA_MAP = [("S.P.2", "Memo|Unlisted", Decimal("1"))]


def q_coverage_gaps(spark, sf_dir):
    m = build_series_map(_series_map(spark), fx.map_frame(spark, COVERAGE_EXTRA_MAP, "EIAHistoric", "Historic"))
    rolled = map_and_rollup(fx.orders_obs(spark, sf_dir), m)
    template = fx.template_frame(spark, COVERAGE_TEMPLATE)
    tu = template.select("variable", F.col("unit").alias("emf_units")).distinct()
    attached = materialize(attach_units(rolled, tu, template_rows=len(COVERAGE_TEMPLATE)))
    pairs = (attached.where(F.col("emf_units").isNotNull())
             .select(F.col("unit").alias("from_unit"), F.col("emf_units").alias("to_unit")).distinct())
    return coverage_gaps(attached, template, m, unit_factor_table(pairs))


SQL_COVERAGE_GAPS = f"""
WITH m AS ({fx.smap_sql(hist=fx.HIST_MAP + COVERAGE_EXTRA_MAP)}),
t AS ({fx.template_sql(COVERAGE_TEMPLATE)}),
r AS (SELECT m.variable, o.unit, sum(o.value * m.factor) AS s, count(*) = count(o.value * m.factor) AS ok
      FROM ({fx.OBS_SQL}) o JOIN m ON o.series_id = m.series_id GROUP BY m.dataset, m.scenario, m.region, m.variable, o.year, o.unit),
a AS (SELECT r.variable, r.unit, t.unit AS emf_units FROM r LEFT JOIN t ON r.variable = t.variable WHERE r.ok),
rl AS ({_relabel_select("SELECT * FROM a", "variable, emf_units")})
SELECT 'variable_not_in_template' AS gap, variable AS key FROM (SELECT DISTINCT variable FROM rl)
  WHERE variable NOT IN (SELECT variable FROM t)
UNION ALL
SELECT 'template_variable_unmapped', variable FROM (SELECT DISTINCT variable FROM t) WHERE variable NOT IN (SELECT variable FROM m)
UNION ALL
SELECT DISTINCT 'unit_not_convertible', unit || ' -> ' || emf_units FROM rl
  WHERE emf_units IS NOT NULL AND (unit, emf_units) IN (('thousand megawatthours', 'GW'))
"""


def q_first_per_key(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    return first_per_key(e, ["event_type", "user_id"], ["ts", "event_id"])


SQL_FIRST_PER_KEY = """
SELECT event_id, ts, user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) = 1
"""

UNION_YEARS_ORDERS = list(range(1995, 2002))
UNION_YEARS_LINES = list(range(1995, 2003))


def q_union_wide(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select(
        F.lit("ORD").alias("model"), F.col("o_orderstatus").alias("variable"), F.lit("USD").alias("unit"),
        F.year("o_orderdate").alias("year"), F.col("o_totalprice").cast(T.DecimalType(18, 2)).alias("value"))
    li = _t(spark, sf_dir, "lineitem").select(
        F.lit("LIN").alias("model"), F.col("l_returnflag").alias("variable"), F.lit("USD").alias("unit"),
        F.year(F.add_months("l_shipdate", 6)).alias("year"),
        F.col("l_extendedprice").cast(T.DecimalType(18, 2)).alias("value"))
    ids = ["model", "variable", "unit"]
    wo = pivot_wider(o, ids, "year", "value", UNION_YEARS_ORDERS, agg="sum")
    wl = pivot_wider(li, ids, "year", "value", UNION_YEARS_LINES, agg="sum")
    out = union_by_name([wo, wl])
    return _dbl(out, [str(y) for y in UNION_YEARS_LINES])


def _sum_cols(years):
    return ", ".join(f'CAST(sum(CASE WHEN year = {y} THEN value END) AS DOUBLE) AS "{y}"' for y in years)


SQL_UNION_WIDE = f"""
SELECT model, variable, unit, {_sum_cols(UNION_YEARS_ORDERS)}, CAST(NULL AS DOUBLE) AS "2002"
FROM (SELECT 'ORD' AS model, o_orderstatus AS variable, 'USD' AS unit, year(o_orderdate) AS year,
             CAST(o_totalprice AS DECIMAL(18,2)) AS value FROM orders) GROUP BY 1, 2, 3
UNION ALL
SELECT model, variable, unit, {_sum_cols(UNION_YEARS_LINES)}
FROM (SELECT 'LIN' AS model, l_returnflag AS variable, 'USD' AS unit, year(l_shipdate + INTERVAL 6 MONTH) AS year,
             CAST(l_extendedprice AS DECIMAL(18,2)) AS value FROM lineitem) GROUP BY 1, 2, 3
"""

INVENTORY_THRESHOLD = 3000


def _inventory_raw(spark, sf_dir):
    """An inventory in the published wide text form: one text cell per year with
    thousands separators, and the sentinel ``+`` below a threshold."""
    o, c, n = (_t(spark, sf_dir, x) for x in ("orders", "customer", "nation"))
    oc = join_dim(o, c.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), ["o_custkey"], "inner",
                  null_safe=False)
    ocn = join_dim(oc, n.select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey"), ["c_nationkey"],
                   "inner", null_safe=False)
    cells = (ocn.groupBy(
        F.when(F.col("n_regionkey") == 4, F.lit("")).otherwise(F.concat(F.lit("Emissions|"), "n_name")).alias("variable"),
        F.col("o_orderstatus").alias("region"),
        F.when(F.col("o_orderstatus") == "P", F.lit("kt")).otherwise(F.lit("MMTCO2e")).alias("unit"),
        F.year("o_orderdate").alias("year"))
        .agg((F.sum(F.col("o_totalprice").cast(T.DecimalType(18, 2))).cast("long") / F.lit(1000)).cast("long").alias("k")))
    text = F.when(F.col("k") < INVENTORY_THRESHOLD, F.lit("+")).otherwise(F.format_number(F.col("k"), 2))
    wide = pivot_wider(cells.withColumn("cell", text), ["variable", "region", "unit"], "year", "cell", fx.YEARS)
    return wide.withColumns({"gas": F.lit("CO2"), "notes": F.lit(""), "chapter": F.lit("Energy")})


def q_inventory_unpivot(spark, sf_dir):
    clean = clean_inventory(_inventory_raw(spark, sf_dir))
    ids = ["variable", "region", "unit", "model", "scenario"]
    long = pivot_longer(clean, ids, [str(y) for y in fx.YEARS], "year", "cell")
    return long.select(*ids, F.col("year").cast("int").alias("year"), parse_number_text(F.col("cell")).alias("value"),
                       below_threshold(F.col("cell")).alias("below_threshold"))


SQL_INVENTORY_UNPIVOT = f"""
WITH cells AS (
  SELECT CASE WHEN n_regionkey = 4 THEN '' ELSE 'Emissions|' || n_name END AS variable, o_orderstatus AS region,
         CASE WHEN o_orderstatus = 'P' THEN 'kt' ELSE 'MMTCO2e' END AS unit, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS BIGINT) // 1000 AS k
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2, 3, 4),
ids AS (SELECT DISTINCT variable, region, unit FROM cells WHERE variable <> '' AND unit = 'MMTCO2e'),
grid AS (SELECT * FROM ids CROSS JOIN (VALUES {', '.join(f'({y})' for y in fx.YEARS)}) y(year))
SELECT g.variable, g.region, 'MMTCO2/yr' AS unit, 'EPA.GHGI' AS model, '2022' AS scenario, g.year,
       CASE WHEN c.k IS NULL OR c.k < {INVENTORY_THRESHOLD} THEN NULL ELSE CAST(c.k AS DOUBLE) END AS value,
       coalesce(c.k < {INVENTORY_THRESHOLD}, false) AS below_threshold
FROM grid g LEFT JOIN cells c ON g.variable = c.variable AND g.region = c.region AND g.unit = c.unit AND g.year = c.year
"""


QUERIES: dict[str, Query] = {
    "mapping_clean": q_mapping_clean,
    "grid_expand": q_grid_expand,
    "key_interpolate": q_key_interpolate,
    "key_batches": q_key_batches,
    "payload_explode": q_payload_explode,
    "series_map_full_join": q_series_map_full_join,
    "scaled_rollup": q_scaled_rollup,
    "rollup_null_poison": q_rollup_null_poison,
    "group_total_keep_rows": q_group_total_keep_rows,
    "template_units_present": q_template_units_present,
    "attach_units_full": q_attach_units_full,
    "unit_relabel": q_unit_relabel,
    "unit_standardize": q_unit_standardize,
    "unit_factors": q_unit_factors,
    "unit_convertible": q_unit_convertible,
    "convert_rowwise": q_convert_rowwise,
    "convert_single_target": q_convert_single_target,
    "convert_from_set": q_convert_from_set,
    "convert_crosswalk": q_convert_crosswalk,
    "convert_value_columns": q_convert_value_columns,
    "pack_unpack_units": q_pack_unpack_units,
    "lookup_reverse_names": q_lookup_reverse_names,
    "crosswalk_qa": q_crosswalk_qa,
    "violations_unique": q_violations_unique,
    "violations_unit_map": q_violations_unit_map,
    "frequency_violations": q_frequency_violations,
    "violations_nonmatch": q_violations_nonmatch,
    "unit_differences": q_unit_differences,
    "coverage_gaps": q_coverage_gaps,
    "pivot_years": q_pivot_years,
    "first_per_key": q_first_per_key,
    "union_wide": q_union_wide,
    "change_tracker": q_change_tracker,
    "inventory_unpivot": q_inventory_unpivot,
    "harmonize_flagship": q_harmonize_flagship,
}

ORACLE_SQL: dict[str, str] = {
    "mapping_clean": SQL_MAPPING_CLEAN,
    "grid_expand": SQL_GRID_EXPAND,
    "key_interpolate": SQL_KEY_INTERPOLATE,
    "key_batches": SQL_KEY_BATCHES,
    "payload_explode": SQL_PAYLOAD_EXPLODE,
    "series_map_full_join": SQL_SERIES_MAP_FULL_JOIN,
    "scaled_rollup": SQL_SCALED_ROLLUP,
    "rollup_null_poison": SQL_ROLLUP_NULL_POISON,
    "group_total_keep_rows": SQL_GROUP_TOTAL_KEEP_ROWS,
    "template_units_present": SQL_TEMPLATE_UNITS_PRESENT,
    "attach_units_full": SQL_ATTACH_UNITS_FULL,
    "unit_relabel": SQL_UNIT_RELABEL,
    "unit_standardize": SQL_UNIT_STANDARDIZE,
    "unit_factors": SQL_UNIT_FACTORS,
    "unit_convertible": SQL_UNIT_CONVERTIBLE,
    "convert_rowwise": SQL_CONVERT_ROWWISE,
    "convert_single_target": SQL_CONVERT_SINGLE_TARGET,
    "convert_from_set": SQL_CONVERT_FROM_SET,
    "convert_crosswalk": SQL_CONVERT_CROSSWALK,
    "convert_value_columns": SQL_CONVERT_VALUE_COLUMNS,
    "pack_unpack_units": SQL_PACK_UNPACK_UNITS,
    "lookup_reverse_names": SQL_LOOKUP_REVERSE_NAMES,
    "crosswalk_qa": SQL_CROSSWALK_QA,
    "violations_unique": SQL_VIOLATIONS_UNIQUE,
    "violations_unit_map": SQL_VIOLATIONS_UNIT_MAP,
    "frequency_violations": SQL_FREQUENCY_VIOLATIONS,
    "violations_nonmatch": SQL_VIOLATIONS_NONMATCH,
    "unit_differences": SQL_UNIT_DIFFERENCES,
    "coverage_gaps": SQL_COVERAGE_GAPS,
    "pivot_years": SQL_PIVOT_YEARS,
    "first_per_key": SQL_FIRST_PER_KEY,
    "union_wide": SQL_UNION_WIDE,
    "change_tracker": SQL_CHANGE_TRACKER,
    "inventory_unpivot": SQL_INVENTORY_UNPIVOT,
    "harmonize_flagship": SQL_HARMONIZE_FLAGSHIP,
}
