"""More catalogue queries: ingest and its checks, the file sinks, missing keys in the
roll-up, and the operators the first catalogue leaves to unit tests. Same rules: whole
driver tables, an equivalent SQL text for each."""

from __future__ import annotations

import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.functions.text import interpolate_key_column
from yearloom.functions.unit_names import SOURCE_UNIT_ALIASES, map_whole_values, standardize_unit_names_alt, with_aliases_replaced
from yearloom.operators.aggregate import first_per_key
from yearloom.operators.columns import round_numeric
from yearloom.operators.quality import warn_unit_differences
from yearloom.operators.reshape import pivot_longer, pivot_open, sort_existing, sort_nulls_last, union_by_name, year_columns
from yearloom.operators.units.algebra import convertibility_classes, unit_factor_table, unit_lookup
from yearloom.operators.units.convert import convert_units, input_violations
from yearloom.operators.units.definitions import prefix_table, resolve_definitions
from yearloom.plans import fixtures as fx
from yearloom.plans.catalog import (INVENTORY_THRESHOLD, SQL_CONVERT_FROM_SET, SQL_CONVERT_ROWWISE, SQL_CONVERT_SINGLE_TARGET, SQL_GRID_EXPAND,
                                    _LINE_PAIRS, _dbl, _display_sql, _industry_dims, _inventory_raw, _line_units, _line_units_sql,
                                    _series_map, _t, factors_sql, std_sql)
from yearloom.plans.harmonize import convert_with_default_targets, export_inventory, export_wide, map_and_rollup, wide_table
from yearloom.plans.mapping import (DEFAULT_DATASETS, DEFAULT_SCENARIOS, VALID_REGIONS, VALID_SCENARIOS, build_series_map,
                                    clean_mapping, expand_industry_map, instantiate_template, restrict_to_catalog, tag_mapping,
                                    template_subset)
from yearloom.session import scratch_dir
from yearloom.sources.readers import (corrupt_csv_rows, explode_payload, load_payload, payload_violations, read_base_csv, read_mapping_csv, read_payload,
                                      read_template, template_units_from_mapping)
from yearloom.sources.sinks import read_manifest, write_csv, write_csv_quoted, write_parquet, write_tsv


def _case(branches, otherwise: str | None = None):
    """(condition, SQL value) branches as one CASE text; Spark and DuckDB read it alike."""
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in branches) + (f" ELSE {otherwise}" if otherwise else "") + " END"


# --- ingest ----------------------------------------------------------------------------------------------------------

# Cells as they land: mostly numbers, some years and values that aren't.
_YEAR_TEXT = _case([("event_id % 10 = 0", "'n/a'"), ("event_id % 10 = 1", "NULL")], "CAST(year(ts) AS VARCHAR(10))")
_VALUE_TEXT = _case([("event_id % 7 = 0", "'1,234.5'"), ("event_id % 11 = 0", "'x'"), ("event_id % 17 = 0", "'--'"), ("event_id % 19 = 0", "'inf'")],
                    "CAST(event_id AS VARCHAR(20))")
_UNITS = _case([("event_id % 13 = 0", "NULL")], "'units'")


def _event_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir, "events")
    point = F.struct(F.expr(_YEAR_TEXT).alias("year"), F.expr(_VALUE_TEXT).alias("value"))
    return e.select(F.col("event_type").alias("series_id"), F.col("user_id").cast("string").alias("name"),
                    F.expr(_UNITS).alias("units"), F.array(point).alias("data"))


_PAYLOAD_SQL = f"""
SELECT event_type AS series_id, CAST(user_id AS VARCHAR) AS name, {_UNITS} AS unit, {_YEAR_TEXT} AS y, {_VALUE_TEXT} AS v FROM events
"""


def q_ingest_violations(spark, sf_dir):
    """Cells of landed points that don't parse, and points without unit and year."""
    return payload_violations(_event_payload(spark, sf_dir))


SQL_INGEST_VIOLATIONS = f"""
WITH p AS ({_PAYLOAD_SQL})
SELECT series_id, 'year' AS field, y AS cell FROM p WHERE y = 'n/a'
UNION ALL SELECT series_id, 'value', v FROM p WHERE v IN ('x', 'inf')
UNION ALL SELECT series_id, 'unit and year', y FROM p WHERE unit IS NULL AND (y IS NULL OR y = 'n/a')
"""


def q_ingest_text_numbers(spark, sf_dir):
    """Text years and values with thousands commas become numbers."""
    return explode_payload(_event_payload(spark, sf_dir))


SQL_INGEST_TEXT_NUMBERS = f"""
SELECT series_id, name, TRY_CAST(y AS INTEGER) AS year, unit,
       CASE WHEN v = '1,234.5' THEN 1234.5::DOUBLE WHEN v IN ('x', '--', 'inf') THEN NULL ELSE CAST(v AS DOUBLE) END AS value
FROM ({_PAYLOAD_SQL})
"""


def q_payload_json(spark, sf_dir):
    """S5 / O5 / F6 over files: payloads written as JSON lines, read back, points before 1997 dropped."""
    obs = fx.orders_obs(spark, sf_dir)
    payload = obs.select("series_id", "name", F.col("unit").alias("units"),
                         F.array(F.struct("year", F.col("value").cast("double").alias("value"))).alias("data"))
    path = f"{scratch_dir(spark)}/payload-{uuid.uuid4().hex}"
    payload.write.json(path)
    return read_payload(spark, path, start=1997)


SQL_PAYLOAD_JSON = f"""
SELECT series_id, name, year, unit, CAST(value AS DOUBLE) AS value FROM ({fx.OBS_SQL}) WHERE year >= 1997
"""

# A payload line for each event, some cut off, some with text where the points should be.
_LINE = ("concat('{\"series_id\":\"E', CAST(event_id AS VARCHAR(20)), '\",\"name\":\"', event_type, '\",\"units\":\"u\",\"data\":[{\"year\":\"', "
         "CAST(year(ts) AS VARCHAR(4)), '\",\"value\":', CAST(user_id AS VARCHAR(20)), '}]}')")
_CUT_LINE = _case([("event_id % 9 = 0", f"substring({_LINE}, 1, 40)"), ("event_id % 9 = 1", f"replace({_LINE}, '[{{', '\"oops\",\"rest\":[{{')")], _LINE)


def q_corrupt_records(spark, sf_dir):
    """Landed JSON lines that were cut or hold another form come out whole, as text; the others' points are read."""
    path = f"{scratch_dir(spark)}/lines-{uuid.uuid4().hex}"
    _t(spark, sf_dir, "events").select(F.expr(_CUT_LINE).alias("value")).write.text(path)
    payload = load_payload(spark, path)
    points = explode_payload(payload).select("series_id", F.lit("point").alias("field"), F.concat_ws(" ", F.col("year").cast("string"), F.col("value").cast("long").cast("string")).alias("cell"))
    bad = payload_violations(payload)
    return points.unionByName(bad.withColumn("series_id", F.when(F.col("field") != "record", F.col("series_id"))))


SQL_CORRUPT_RECORDS = f"""
SELECT CASE WHEN event_id % 9 > 1 THEN 'E' || CAST(event_id AS VARCHAR) END AS series_id, CASE WHEN event_id % 9 > 1 THEN 'point' ELSE 'record' END AS field,
       CASE WHEN event_id % 9 > 1 THEN CAST(year(ts) AS VARCHAR) || ' ' || CAST(user_id AS VARCHAR) ELSE {_CUT_LINE} END AS cell FROM events
"""

_ROW = "concat('\"', replace(p_name, '\"', ''), '\",P', CAST(p_partkey AS VARCHAR(20)), ',', CAST(p_size AS VARCHAR(20)))"
_CUT_ROW = _case([("p_partkey % 8 = 0", f"concat({_ROW}, ',more')"), ("p_partkey % 8 = 1", "concat('P', CAST(p_partkey AS VARCHAR(20)), ',1')"),
                  ("p_partkey % 8 = 2", f"concat({_ROW}, '\"')"), ("p_partkey % 8 = 3", f"substring({_ROW}, 1, 3)")], _ROW)


def q_corrupt_csv_rows(spark, sf_dir):
    """Rows with cells too many or too few, and with a quote that never ends."""
    path = f"{scratch_dir(spark)}/rows-{uuid.uuid4().hex}"
    _t(spark, sf_dir, "part").select(F.expr(_CUT_ROW).alias("value")).write.text(path)
    return corrupt_csv_rows(spark, path, "Variable string, Series_ID string, Factor string", header=False)


SQL_CORRUPT_CSV_ROWS = f"""
SELECT CASE WHEN p_partkey % 8 >= 2 THEN 'quote' ELSE 'cells' END AS problem, {_CUT_ROW} AS record FROM part WHERE p_partkey % 8 < 4
"""

_NOTE = _case([("o_orderkey % 5 = 0", "NULL"), ("o_orderkey % 5 = 1", "''"), ("o_orderkey % 5 = 2", "'a, \"quoted\" note'")], "o_orderpriority")


def q_sink_roundtrip(spark, sf_dir):
    """S6, S7, S9 written to the scratch folder and read back by S1 and S2: missing is NA, blanks stay blank in the quoted file."""
    rows = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("key"), F.expr(_NOTE).alias("note"),
                                              F.col("o_totalprice").alias("Factor"))
    folder = f"{scratch_dir(spark)}/sinks-{uuid.uuid4().hex}"
    csv = read_mapping_csv(spark, write_csv(rows, f"{folder}/csv", order_by=["key"]))
    tsv = spark.read.option("header", True).option("sep", "\t").option("nullValue", "NA").option("escape", '"').csv(write_tsv(rows, f"{folder}/tsv"))
    quoted = read_base_csv(spark, write_csv_quoted(rows, f"{folder}/quoted"))
    return union_by_name([csv.withColumn("sink", F.lit("csv")),
                          tsv.withColumn("Factor", F.col("Factor").cast("double")).withColumn("note", F.nullif("note", F.lit(""))).withColumn("sink", F.lit("tsv")),
                          quoted.withColumn("Factor", F.col("Factor").cast("double")).withColumn("sink", F.lit("quoted"))])


SQL_SINK_ROUNDTRIP = f"""
WITH r AS (SELECT CAST(o_orderkey AS VARCHAR) AS key, {_NOTE} AS note, o_totalprice AS "Factor" FROM orders)
SELECT key, nullif(note, '') AS note, "Factor", 'csv' AS sink FROM r
UNION ALL SELECT key, nullif(note, ''), "Factor", 'tsv' FROM r
UNION ALL SELECT key, coalesce(note, 'NA'), "Factor", 'quoted' FROM r
"""


# --- roll-up, rounding, order ----------------------------------------------------------------------------------------

_MISSING_UNIT, _MISSING_YEAR = "CASE WHEN name LIKE '2%' THEN NULL ELSE unit END", "CASE WHEN series_id LIKE '%P%' AND name NOT LIKE '2%' THEN NULL ELSE year END"


def q_rollup_missing_unit(spark, sf_dir):
    """Observations without a unit, or without a year, form groups of their own."""
    obs = fx.orders_obs(spark, sf_dir).withColumns({"unit": F.expr(_MISSING_UNIT), "year": F.expr(_MISSING_YEAR)})
    return _dbl(map_and_rollup(obs, _series_map(spark)), ["value"])


SQL_ROLLUP_MISSING_UNIT = f"""
SELECT m.dataset AS model, m.scenario, m.region, m.variable, o.year, o.unit, CAST(sum(o.value * m.factor) AS DOUBLE) AS value
FROM (SELECT series_id, {_MISSING_YEAR} AS year, {_MISSING_UNIT} AS unit, value FROM ({fx.OBS_SQL})) o
JOIN ({fx.smap_sql()}) m ON o.series_id = m.series_id GROUP BY ALL
"""

_ROUNDED = _case([("l_linenumber = 1", "1.00499999999e0"), ("l_linenumber = 2", "0.28499999999e0"), ("l_linenumber = 3", "0.285e0"),
                  ("l_linenumber = 4", "-2.675e0"), ("l_linenumber = 5", "1e17")], "l_extendedprice * l_discount")


def q_rounded_values(spark, sf_dir):
    """Half-up on the decimal text, once."""
    li = _t(spark, sf_dir, "lineitem")
    return round_numeric(li.select("l_orderkey", "l_linenumber", F.expr(_ROUNDED.replace("e0", "D").replace("1e17", "1e17D")).alias("value")))


SQL_ROUNDED_VALUES = f"""
SELECT l_orderkey, l_linenumber, CASE WHEN abs(v) >= 1e16 THEN v ELSE CAST(round(CAST(CAST(v AS VARCHAR) AS DECIMAL(38, 21)), 2) AS DOUBLE) END AS value
FROM (SELECT l_orderkey, l_linenumber, {_ROUNDED} AS v FROM lineitem)
"""

_SOME_TS = "CASE WHEN event_id % 3 = 0 THEN NULL ELSE ts END"


def q_first_per_key_nulls(spark, sf_dir):
    """A missing order value comes last."""
    e = _t(spark, sf_dir, "events").withColumn("ts", F.expr(_SOME_TS))
    return first_per_key(e, ["event_type", "user_id"], ["ts", "event_id"])


SQL_FIRST_PER_KEY_NULLS = f"""
SELECT * FROM (SELECT event_id, {_SOME_TS} AS ts, user_id, event_type, value, props FROM events)
QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts NULLS LAST, event_id) = 1
"""


def q_sorted_rank(spark, sf_dir):
    """O1-O3: brands and sizes in ascending order, missing last, with their positions (of a summary table)."""
    p = _t(spark, sf_dir, "part").select(F.nullif("p_brand", F.lit("Brand#13")).alias("brand"), F.nullif("p_size", F.lit(7)).alias("size"))
    kinds = p.groupBy("brand", "size").count()
    up = sort_existing(kinds, ["brand", "no such column", "size"]).withColumn("_at", F.monotonically_increasing_id())
    down = sort_nulls_last(kinds, ["brand", "size"], descending=True).withColumn("_at", F.monotonically_increasing_id())
    rank = "row_number() OVER (ORDER BY _at)"  # rows of the summary, not of the table
    return union_by_name([x.select("brand", "size", F.expr(rank).cast("long").alias("position"), F.lit(o).alias("sort_order"))
                          for x, o in ((up, "up"), (down, "down"))])


SQL_SORTED_RANK = """
WITH k AS (SELECT DISTINCT nullif(p_brand, 'Brand#13') AS brand, nullif(p_size, 7) AS size FROM part)
SELECT brand, size, row_number() OVER (ORDER BY brand ASC NULLS LAST, size ASC NULLS LAST) AS position, 'up' AS sort_order FROM k
UNION ALL SELECT brand, size, row_number() OVER (ORDER BY brand DESC NULLS LAST, size DESC NULLS LAST), 'down' FROM k
"""


# --- mapping ---------------------------------------------------------------------------------------------------------

_SCENARIO = _case([("p_size % 3 = 0", "'REF2020'"), ("p_size % 3 = 1", "'HIGHMACRO'")], "'OTHER'")
_REGION = _case([("p_partkey % 4 = 0", "'USA'"), ("p_partkey % 4 = 1", "'TX'")], "'XX'")
_ROUND = _case([("p_brand < 'Brand#3'", "'beta'")], "'final'")


def q_catalog_filter(spark, sf_dir):
    """Rows of known scenarios and regions; template rows of a round and some tiers."""
    p = _t(spark, sf_dir, "part").select("p_partkey", F.expr(_SCENARIO).alias("scenario"), F.expr(_REGION).alias("region"),
                                         F.expr(_ROUND).alias("round"), (F.col("p_size") % 4).alias("tier"))
    known = restrict_to_catalog(p).withColumn("kept_by", F.lit("catalog"))
    return union_by_name([known, template_subset(p).withColumn("kept_by", F.lit("template"))])


SQL_CATALOG_FILTER = f"""
WITH p AS (SELECT p_partkey, {_SCENARIO} AS scenario, {_REGION} AS region, {_ROUND} AS round, p_size % 4 AS tier FROM part)
SELECT *, 'catalog' AS kept_by FROM p WHERE scenario IN ({', '.join(map(fx.sql_lit, VALID_SCENARIOS))}) AND region IN ({', '.join(map(fx.sql_lit, VALID_REGIONS))})
UNION ALL SELECT *, 'template' FROM p WHERE round = 'beta' AND tier IN (1, 2)
"""


def q_interpolate_columns(spark, sf_dir):
    """The key column from a template column, other columns of its prefix dropped; year columns picked by name."""
    p = _t(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.lit("{EIA_dataset}.{EIA_scenario}.P"), F.col("p_size").cast("string"), F.lit("{EIA_dataset}")).alias("EIA_template"),
        F.col("p_brand").alias("EIA_dataset"), F.col("p_type").alias("EIA_scenario"), F.col("p_size").alias("2020"), F.lit(1).alias("note2021"))
    keyed = interpolate_key_column(p, {"EIA_dataset": F.col("EIA_dataset"), "EIA_scenario": F.col("EIA_scenario")})
    return keyed.select("p_partkey", "EIA_key", *year_columns(keyed))


SQL_INTERPOLATE_COLUMNS = """
SELECT p_partkey, p_brand || '.' || p_type || '.P' || CAST(p_size AS VARCHAR) || '{EIA_dataset}' AS "EIA_key", p_size AS "2020" FROM part
"""


def q_tagged_maps(spark, sf_dir):
    """F1 + F4 + F5 + S4: cleaned maps with their tags, united; distinct units of the map's variables."""
    raw = _t(spark, sf_dir, "part").select(
        F.nullif("p_type", F.lit("PROMO")).alias("Variable"), F.concat(F.lit("P."), F.col("p_partkey").cast("string")).alias("Series_ID"),
        F.col("p_size").cast("double").alias("Factor"), F.col("p_brand").alias("EMF_Units"), F.lit("x").alias("notes"))
    clean = clean_mapping(raw)
    maps = build_series_map(tag_mapping(clean, "EIAHistoric", "Historic"), tag_mapping(clean, "EIA_STEO", "Ref", "TX"))
    units = template_units_from_mapping(raw.where("Variable is not null"))
    return union_by_name([maps.withColumn("emf_units", F.lit(None).cast("string")), units])


SQL_TAGGED_MAPS = """
WITH m AS (SELECT 'P.' || CAST(p_partkey AS VARCHAR) AS series_id, p_type AS variable, CAST(p_size AS DOUBLE) AS factor, p_brand FROM part WHERE p_type <> 'PROMO')
SELECT 'EIAHistoric' AS dataset, 'Historic' AS scenario, 'USA' AS region, series_id, variable, factor, NULL::VARCHAR AS emf_units FROM m
UNION ALL SELECT 'EIA_STEO', 'Ref', 'TX', series_id, variable, factor, NULL FROM m
UNION ALL SELECT DISTINCT NULL, NULL, NULL, NULL, variable, NULL, p_brand FROM m
"""


def q_grid_to_series_map(spark, sf_dir):
    """F2 -> F1 -> F3 -> F4: the industry grid as a key template, cleaned and instantiated."""
    template = clean_mapping(expand_industry_map(*_industry_dims(spark, sf_dir)))
    return build_series_map(instantiate_template(template))


SQL_GRID_TO_SERIES_MAP = f"""
SELECT d AS dataset, s AS scenario, 'USA' AS region,
       replace(replace("Series_template", '{{EIA_dataset}}', d), '{{EIA_scenario}}', s) AS series_id, "Variable" AS variable, "Factor" AS factor
FROM ({SQL_GRID_EXPAND}) CROSS JOIN (VALUES {', '.join(f"('{d}')" for d in DEFAULT_DATASETS)}) x(d)
CROSS JOIN (VALUES {', '.join(f"('{s}')" for s in DEFAULT_SCENARIOS)}) y(s) WHERE "Variable" IS NOT NULL
"""


# --- pivots ----------------------------------------------------------------------------------------------------------

_OPEN_YEAR = _case([("o_orderkey % 100 = 7", "'2045'"), ("o_orderkey % 100 = 9", "NULL")], "CAST(year(o_orderdate) AS VARCHAR(4))")


def q_pivot_open(spark, sf_dir):
    """A7 / F11 without a list: the columns are the years of the data, one of which no list names, and NA."""
    o = _t(spark, sf_dir, "orders").select("o_orderpriority", F.col("o_custkey"), F.expr(_OPEN_YEAR).alias("year"), "o_totalprice")
    return pivot_open(o, ["o_custkey", "o_orderpriority"], "year", "o_totalprice", on_duplicates="max")


SQL_PIVOT_OPEN = f"""
SELECT o_custkey, o_orderpriority, {', '.join(f'max(o_totalprice) FILTER (WHERE y = {fx.sql_lit(y)}) AS "{y}"' for y in [*map(str, range(1995, 2002)), '2045', 'NA'])}
FROM (SELECT *, coalesce({_OPEN_YEAR}, 'NA') AS y FROM orders) GROUP BY o_custkey, o_orderpriority
"""


def q_pivot_lists(spark, sf_dir):
    """Cells with several values as ordered lists (shown as text), and their sums."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linestatus", F.col("l_quantity").cast("long").alias("q"), "l_linenumber")
    lists = pivot_open(li, ["l_orderkey"], "l_linestatus", "q", on_duplicates="list", order_by=["l_linenumber", "q"])
    sums = pivot_open(li, ["l_orderkey"], "l_linestatus", "q", on_duplicates="sum")
    shown = lists.select("l_orderkey", *[F.array_join(F.col(c).cast("array<string>"), ",").alias(f"list_{c}") for c in ("F", "O")])
    return shown.join(sums.withColumnsRenamed({"F": "sum_F", "O": "sum_O"}), "l_orderkey")


SQL_PIVOT_LISTS = "SELECT l_orderkey, " + ", ".join(
    f"array_to_string(list(CAST(l_quantity AS BIGINT) ORDER BY l_linenumber, l_quantity) FILTER (WHERE l_linestatus = '{c}'), ',') AS \"list_{c}\", "
    f"CAST(sum(CAST(l_quantity AS BIGINT)) FILTER (WHERE l_linestatus = '{c}') AS BIGINT) AS \"sum_{c}\"" for c in ("F", "O")) + " FROM lineitem GROUP BY l_orderkey"


# --- units -----------------------------------------------------------------------------------------------------------

def q_convert_default_targets(spark, sf_dir):
    """Rows without a target keep their unit, under its display name; source aliases beside it."""
    df = _line_units(spark, sf_dir, with_target=True).withColumnRenamed("target", "emf_units")
    out = convert_with_default_targets(df)
    return out.withColumn("alias", map_whole_values(F.col("emf_units"), SOURCE_UNIT_ALIASES))


_ALIAS_SQL = "CASE " + " ".join(f"WHEN emf_units = {fx.sql_lit(a)} THEN {fx.sql_lit(b)}" for a, b in SOURCE_UNIT_ALIASES) + " ELSE emf_units END"

SQL_CONVERT_DEFAULT_TARGETS = f"""
SELECT l_orderkey, l_linenumber, {_display_sql('std')} AS unit, value, emf_units, {_ALIAS_SQL} AS alias FROM (
  SELECT l_orderkey, l_linenumber, s.target AS emf_units, CASE WHEN f.factor IS NULL THEN {std_sql('s.unit')} ELSE {std_sql('s.target')} END AS std,
         CASE WHEN f.factor IS NULL THEN s.value ELSE s.value * f.factor END AS value
  FROM ({_line_units_sql(True)}) s LEFT JOIN {factors_sql(_LINE_PAIRS)} ON s.unit = f.from_unit AND s.target = f.to_unit)
"""


def q_dispatch_modes(spark, sf_dir):
    """U8: the mode follows from the parameters' types."""
    df = _line_units(spark, sf_dir, with_target=True)
    plain = df.drop("target")
    some = ["quadrillion Btu", "billion kilowatthours"]
    return union_by_name([
        convert_units(df, F.col("target")).drop("target").withColumn("mode", F.lit("rowwise")),
        convert_units(plain, "EJ/yr").withColumn("mode", F.lit("single")),
        convert_units(plain, "EJ/yr", some).withColumn("mode", F.lit("set")),
        convert_units(plain, ["EJ/yr"], some).withColumn("mode", F.lit("list of one")),
        convert_units(plain, ["EJ/yr", "EJ/yr"], some).withColumn("mode", F.lit("lists")),
        convert_units(plain, crosswalk=[(u, "EJ/yr") for u in some]).withColumn("mode", F.lit("crosswalk"))])


SQL_DISPATCH_MODES = " UNION ALL ".join(
    f"SELECT *, {fx.sql_lit(mode)} AS mode FROM ({sql})" for mode, sql in (
        ("rowwise", SQL_CONVERT_ROWWISE), ("single", SQL_CONVERT_SINGLE_TARGET), ("set", SQL_CONVERT_FROM_SET),
        ("list of one", SQL_CONVERT_FROM_SET), ("lists", SQL_CONVERT_FROM_SET), ("crosswalk", SQL_CONVERT_FROM_SET)))

# Units of the variant registry by (return flag, line status), their targets and factors (as SQL).
VARIANT_PAIRS = [("A", "F", "MMTCO2e", "kt", "((1e6*1e3)/1e6)"), ("A", "O", "hundredweight", "pound", "((100e0*0.45359237e0)/0.45359237e0)"),
                 ("N", "F", "dozen", "hundred", "(12e0/1e2)"), ("N", "O", "MMT", "kt", "((1e6*1e3)/1e6)"), ("R", "F", "bales", "head", "NULL"),
                 ("R", "O", "cents", "dollars", "(1e-2/1e0)")]
EQUIVALENT_UNITS = [["head", "hd"], ["pound", "head"], ["dozen", "hundred"]]


def q_units_variant(spark, sf_dir):
    """U1 (variant set), U13 and L6: the second registry's factors, and its name normaliser, over lineitem's units."""
    li = _t(spark, sf_dir, "lineitem")
    pick = lambda k: F.expr(_case([(f"l_returnflag = '{p[0]}' AND l_linestatus = '{p[1]}'", fx.sql_lit(p[k])) for p in VARIANT_PAIRS]))
    pairs = li.select(pick(2).alias("from_unit"), pick(3).alias("to_unit")).where("from_unit is not null").distinct()
    table = unit_factor_table(pairs, rename_fun=lambda c: c, registry=unit_lookup(variant=True))
    return table.select("from_unit", "to_unit", "factor", "convertible",
                        standardize_unit_names_alt(F.col("to_unit"), EQUIVALENT_UNITS).alias("to_normal"))


_NORMAL = {"kt": "kt", "pound": "pound", "hundred": "dozen", "head": "head", "dollars": "dollars"}

SQL_UNITS_VARIANT = f"""
SELECT DISTINCT f.from_unit, f.to_unit, f.factor, f.factor IS NOT NULL AS convertible, f.normal AS to_normal
FROM lineitem JOIN (VALUES {', '.join(f"('{a}', '{b}', {fx.sql_lit(c)}, {fx.sql_lit(d)}, {e}::DOUBLE, {fx.sql_lit(_NORMAL[d])})" for a, b, c, d, e in VARIANT_PAIRS)})
  AS f(rf, ls, from_unit, to_unit, factor, normal) ON l_returnflag = f.rf AND l_linestatus = f.ls
"""

_PART_SCALE = "p_size * 0.5e0 + 1e0"


def q_unit_factors_registry(spark, sf_dir):
    """U2 / U3 with a registry table: one unit a part, its dimension by its size; the pairs that lineitem holds."""
    p = _t(spark, sf_dir, "part")
    dims = F.array(F.struct(F.when(F.col("p_size") % 2 == 0, "m").otherwise("s").alias("dim"), F.lit(1).alias("exp")))
    registry = p.select(F.concat(F.lit("u"), F.col("p_partkey").cast("string")).alias("name"), F.lit("name").alias("kind"),
                        (F.col("p_size") * 0.5 + 1.0).alias("scale"), dims.alias("dims"))
    pairs = _t(spark, sf_dir, "lineitem").select(F.concat(F.lit("U"), F.col("l_partkey").cast("string"), F.lit("s")).alias("from_unit"),
                                                 F.concat(F.lit("u"), F.col("l_suppkey").cast("string")).alias("to_unit"))
    return unit_factor_table(pairs, rename_fun=lambda c: c, registry=registry).drop("from_units_unit", "to_units_unit")


SQL_UNIT_FACTORS_REGISTRY = f"""
WITH r AS (SELECT p_partkey AS k, {_PART_SCALE} AS scale, p_size % 2 AS dim FROM part),
x AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)
SELECT 'U' || CAST(l_partkey AS VARCHAR) || 's' AS from_unit, 'u' || CAST(l_suppkey AS VARCHAR) AS to_unit,
       CASE WHEN a.dim = b.dim THEN a.scale / b.scale END AS factor, coalesce(a.dim = b.dim, false) AS convertible
FROM x LEFT JOIN r a ON l_partkey = a.k LEFT JOIN r b ON l_suppkey = b.k
"""


_CHAIN_OF = _case([("p_partkey % 16 = 0", "NULL"), ("p_partkey % 97 = 0", "concat('nowhere', CAST(p_partkey AS VARCHAR(20)))"),
                   ("p_partkey % 101 = 0", "concat('2 p', CAST(p_partkey AS VARCHAR(20)))")],
                  "concat('p', CAST(p_partkey - 1 AS VARCHAR(20)))")
_CHAIN_BASE = _case([("p_partkey % 16 = 0", _case([("p_partkey % 48 = 0", "'m'"), ("p_partkey % 48 = 16", "'s'")], "'kg'"))])
_CHAIN_TIMES = _case([(f"p_partkey % 5 = {k}", v) for k, v in ((0, "0.0625e0"), (1, "2e0"), (2, "2e0"), (3, "0.5e0"))], "8e0")


def q_unit_definitions(spark, sf_dir):
    """Units as data, most defined by the part before; what leads nowhere or to itself is a violation."""
    text = lambda sql: F.expr(sql.replace("e0", "D"))
    p = _t(spark, sf_dir, "part").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("name"), text(_CHAIN_TIMES).alias("multiplier"),
                                         F.expr(_CHAIN_OF).alias("of"), F.expr(_CHAIN_BASE).alias("base"))
    units = resolve_definitions(p)
    found = units.registry.select("name", "scale", F.element_at("dims", 1)["dim"].alias("dim"), F.lit(None).cast("string").alias("problem"))
    return union_by_name([found.withColumn("detail", F.col("problem")),
                          units.violations.select("name", F.lit(None).cast("double").alias("scale"), F.lit(None).cast("string").alias("dim"), "problem", "detail")])


SQL_UNIT_DEFINITIONS = f"""
WITH RECURSIVE d AS (SELECT p_partkey AS k, {_CHAIN_TIMES} AS times, {_CHAIN_BASE} AS base, {_CHAIN_OF} AS expr FROM part),
r(k, scale, dim, problem, detail) AS (
  SELECT k, CASE WHEN base IS NOT NULL THEN CAST(times AS DOUBLE) END, base,
         CASE WHEN base IS NULL THEN CASE WHEN k % 101 = 0 AND k % 97 <> 0 THEN 'cycle' ELSE 'unknown' END END,
         CASE WHEN base IS NULL AND (k % 101 <> 0 OR k % 97 = 0) THEN expr END
  FROM d WHERE base IS NOT NULL OR k % 97 = 0 OR k % 101 = 0 OR k - 1 NOT IN (SELECT k FROM d)
  UNION ALL
  SELECT d.k, r.scale * d.times, r.dim, r.problem, r.detail FROM r JOIN d ON d.k = r.k + 1
  WHERE d.base IS NULL AND d.k % 97 <> 0 AND d.k % 101 <> 0)
SELECT 'p' || CAST(k AS VARCHAR) AS name, CAST(scale AS DOUBLE) AS scale, dim, problem, detail FROM r
"""

_PREFIX = _case([("l_linenumber = 1", "'kilo'"), ("l_linenumber = 2", "'k'"), ("l_linenumber = 3", "'Mega'"), ("l_linenumber = 4", "'da'"), ("l_linenumber = 5", "'d'")], "''")


def q_unit_prefixes(spark, sf_dir):
    """Prefixes before the units of a registry table; symbols take symbols, names take names, some units take none."""
    registry = _t(spark, sf_dir, "part").select(
        F.concat(F.lit("u"), F.col("p_partkey").cast("string")).alias("name"), F.when(F.col("p_size") % 2 == 0, "symbol").otherwise("name").alias("kind"),
        (F.col("p_size") * 0.5 + 1.0).alias("scale"), F.array(F.struct(F.lit("m").alias("dim"), F.lit(1).alias("exp"))).alias("dims"),
        (F.col("p_size") % 5 != 0).alias("prefixable"))
    pairs = _t(spark, sf_dir, "lineitem").select(F.concat(F.expr(_PREFIX), F.lit("u"), F.col("l_partkey").cast("string")).alias("from_unit"),
                                                 F.concat(F.lit("u"), F.col("l_suppkey").cast("string")).alias("to_unit"))
    lookup = unit_lookup(registry, prefixes=prefix_table(spark))
    return unit_factor_table(pairs, rename_fun=lambda c: c, registry=lookup).drop("from_units_unit", "to_units_unit")


SQL_UNIT_PREFIXES = f"""
WITH r AS (SELECT p_partkey AS k, {_PART_SCALE} AS scale, p_size % 2 = 0 AS symbol, p_size % 5 <> 0 AS prefixable FROM part),
x AS (SELECT DISTINCT l_partkey, l_suppkey, {_PREFIX} AS prefix FROM lineitem),
f AS (
  SELECT x.*, CASE WHEN prefix = '' THEN 1e0 WHEN NOT a.prefixable OR a.symbol <> (prefix IN ('k', 'da', 'd')) THEN NULL
                   ELSE CASE prefix WHEN 'kilo' THEN 1e3 WHEN 'k' THEN 1e3 WHEN 'Mega' THEN 1e6 WHEN 'da' THEN 1e1 ELSE 1e-1 END END * a.scale AS from_scale, b.scale AS to_scale
  FROM x LEFT JOIN r a ON l_partkey = a.k LEFT JOIN r b ON l_suppkey = b.k)
SELECT prefix || 'u' || CAST(l_partkey AS VARCHAR) AS from_unit, 'u' || CAST(l_suppkey AS VARCHAR) AS to_unit,
       CAST(from_scale / to_scale AS DOUBLE) AS factor, from_scale IS NOT NULL AND to_scale IS NOT NULL AS convertible FROM f
"""


def q_alias_table(spark, sf_dir):
    """L5 with aliases as data: each brand's name, in an order of rank that lets earlier results meet later aliases."""
    p = _t(spark, sf_dir, "part")
    aliases = p.groupBy("p_brand").agg(F.max("p_size").alias("s")).select(
        F.substring("p_brand", 7, 3).cast("int").alias("rank"), F.substring("p_brand", 5, 3).alias("alias"),
        F.concat(F.lit("<"), F.substring("p_brand", 7, 1), F.lit(">")).alias("name"))
    texts = p.select(F.concat_ws(" ", "p_brand", "p_name", "p_type").alias("text")).distinct()
    return with_aliases_replaced(texts, {"folded": "text"}, aliases)


SQL_ALIAS_TABLE = """
WITH RECURSIVE a AS (
  SELECT DISTINCT CAST(substr(p_brand, 7, 3) AS INTEGER) AS rank, substr(p_brand, 5, 3) AS alias, '<' || substr(p_brand, 7, 1) || '>' AS name FROM part),
n AS (SELECT *, row_number() OVER (ORDER BY rank, alias, name) AS i FROM a),
f(text, folded, i) AS (
  SELECT DISTINCT p_brand || ' ' || p_name || ' ' || p_type, p_brand || ' ' || p_name || ' ' || p_type, 0::BIGINT FROM part
  UNION ALL SELECT f.text, replace(f.folded, n.alias, n.name), n.i FROM f JOIN n ON n.i = f.i + 1)
SELECT text, folded FROM f WHERE i = (SELECT max(i) FROM n)
"""

_CLASS_DIMS = {0: "m", 1: "s", 2: "kg"}


def q_unit_classes(spark, sf_dir):
    """Quotients of part units that convert into one another, by the class of their dimensions."""
    p = _t(spark, sf_dir, "part")
    dim = F.element_at(F.create_map(*[F.lit(x) for k in _CLASS_DIMS.items() for x in k]), (F.col("p_size") % 3).cast("int"))
    registry = p.select(F.concat(F.lit("u"), F.col("p_partkey").cast("string")).alias("name"), F.lit("symbol").alias("kind"),
                        F.lit(2.0).alias("scale"), F.array(F.struct(dim.alias("dim"), F.lit(1).alias("exp"))).alias("dims"))
    units = _t(spark, sf_dir, "lineitem").select(F.concat(F.lit("u"), F.col("l_partkey").cast("string"), F.lit("/u"), F.col("l_suppkey").cast("string")).alias("unit"))
    return convertibility_classes(units, rename_fun=lambda c: c, registry=registry)


SQL_UNIT_CLASSES = f"""
WITH r AS (SELECT p_partkey AS k, {_case([(f"p_size % 3 = {k}", fx.sql_lit(v)) for k, v in _CLASS_DIMS.items()])} AS dim FROM part),
x AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem),
u AS (SELECT 'u' || CAST(l_partkey AS VARCHAR) || '/u' || CAST(l_suppkey AS VARCHAR) AS unit,
             CASE WHEN a.dim IS NULL OR b.dim IS NULL THEN NULL WHEN a.dim = b.dim THEN ''
                  WHEN a.dim < b.dim THEN a.dim || '^1 ' || b.dim || '^-1' ELSE b.dim || '^-1 ' || a.dim || '^1' END AS dims
      FROM x LEFT JOIN r a ON l_partkey = a.k LEFT JOIN r b ON l_suppkey = b.k)
SELECT unit, dims, CASE WHEN dims IS NOT NULL THEN min(unit) OVER (PARTITION BY dims) END AS class_id FROM u
"""


# --- checks and published files --------------------------------------------------------------------------------------

_SHAPE_UNIT = _case([("l_linenumber = 1", "NULL"), ("l_linenumber = 2", "' '")], "l_returnflag")


def q_input_violations(spark, sf_dir):
    """Q7: rows that conversion couldn't use, counted by unit; and a table without the columns it needs."""
    li = _t(spark, sf_dir, "lineitem")
    rows = li.select(F.expr(_SHAPE_UNIT).alias("unit"), F.when(F.col("l_quantity") > 40, F.lit(float("nan"))).when(
        F.col("l_quantity") > 38, F.lit(float("-inf"))).when(F.col("l_quantity") > 3, F.col("l_quantity").cast("double")).alias("value"))
    shape = input_violations(li.select(F.col("l_orderkey").alias("unit")))
    return input_violations(rows).withColumn("of", F.lit("rows")).unionByName(shape.withColumn("of", F.lit("shape")))


SQL_INPUT_VIOLATIONS = f"""
WITH r AS (SELECT {_SHAPE_UNIT} AS unit, l_quantity AS q FROM lineitem)
SELECT 'value without a unit' AS problem, unit AS detail, count(*) AS n_rows, 'rows' AS of FROM r WHERE unit IS NULL AND q > 3 GROUP BY unit
UNION ALL SELECT 'blank unit', unit, count(*), 'rows' FROM r WHERE unit = ' ' GROUP BY unit
UNION ALL SELECT 'value is not a number', unit, count(*), 'rows' FROM r WHERE q > 38 GROUP BY unit
UNION ALL SELECT 'missing column', 'value', NULL, 'shape' UNION ALL SELECT 'unit is not text', 'unit', NULL, 'shape'
"""


def q_difference_warning(spark, sf_dir):
    """Q5: combinations whose unit differs from the template's, and that the check warned of them."""
    o = _t(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("model"), F.lit("S").alias("scenario"), F.col("o_orderpriority").alias("variable"),
                                           F.concat(F.lit("u"), F.year("o_orderdate").cast("string")).alias("unit"))
    template = _t(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("variable")).agg(
        F.concat(F.lit("u"), F.min(F.year("o_orderdate")).cast("string")).alias("unit"))
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        found = warn_unit_differences(o, template)
    said = sum("differ from the template" in str(w.message) for w in caught)
    return found.select("model", "scenario", "variable", "unit", "benchmark_unit", F.lit(said).alias("warnings"))


SQL_DIFFERENCE_WARNING = """
WITH t AS (SELECT o_orderpriority AS variable, 'u' || CAST(min(year(o_orderdate)) AS VARCHAR) AS benchmark_unit FROM orders GROUP BY 1),
o AS (SELECT DISTINCT o_orderstatus AS model, 'S' AS scenario, o_orderpriority AS variable, 'u' || CAST(year(o_orderdate) AS VARCHAR) AS unit FROM orders)
SELECT model, scenario, variable, unit, benchmark_unit, 1 AS warnings FROM o JOIN t USING (variable) WHERE unit <> benchmark_unit
"""


def q_template_file(spark, sf_dir):
    """S3: the reporting template written as CSV and as Parquet, read back with lower-cased names."""
    t = _t(spark, sf_dir, "part").select(F.concat_ws("|", "p_type", "p_name").alias("Variable"), F.nullif("p_brand", F.lit("Brand#1")).alias("Unit"),
                                         F.col("p_size").cast("string").alias("Tier"))
    folder = f"{scratch_dir(spark)}/template-{uuid.uuid4().hex}"
    csv = read_template(spark, write_csv(t, f"{folder}/csv"))
    parquet = read_template(spark, write_parquet(t, f"{folder}/parquet"), "parquet")
    return union_by_name([csv.withColumn("read_as", F.lit("csv")), parquet.withColumn("read_as", F.lit("parquet"))])


SQL_TEMPLATE_FILE = """
WITH t AS (SELECT p_type || '|' || p_name AS variable, nullif(p_brand, 'Brand#1') AS unit, CAST(p_size AS VARCHAR) AS tier FROM part)
SELECT *, 'csv' AS read_as FROM t UNION ALL SELECT *, 'parquet' FROM t
"""


def q_wide_published(spark, sf_dir):
    """F11 + F12: the wide table laid out from the data's years, published over an earlier output, and read back."""
    o = _t(spark, sf_dir, "orders")
    long = o.groupBy(F.concat(F.lit("AEO."), "o_orderstatus").alias("model"), F.col("o_orderpriority").alias("scenario"), F.year("o_orderdate").alias("year")).agg(
        F.count("*").cast("double").alias("value")).select("model", "scenario", F.lit("USA").alias("region"), F.lit("Orders").alias("variable"),
                                                         F.lit("1").alias("unit"), "year", "value")
    path = f"{scratch_dir(spark)}/wide-{uuid.uuid4().hex}"
    export_wide(wide_table(long.where("year < 1997")), path)
    back = read_base_csv(spark, export_wide(wide_table(long), path))
    total = read_manifest(spark, path)["rows"]
    years = [c for c in back.columns if c.isdigit()]
    return back.select("model", "scenario", "region", "variable", "unit", *[F.nullif(F.col(y), F.lit("NA")).cast("double").alias(f"y{y}") for y in years],
                       F.lit(total).cast("long").alias("published"))


SQL_WIDE_PUBLISHED = f"""
SELECT 'AEO.' || o_orderstatus AS model, o_orderpriority AS scenario, 'USA' AS region, 'Orders' AS variable, '1' AS unit,
       {', '.join(f'CAST(nullif(count(*) FILTER (WHERE year(o_orderdate) = {y}), 0) AS DOUBLE) AS y{y}' for y in range(1995, 2002))},
       count(*) OVER () AS published
FROM orders GROUP BY o_orderstatus, o_orderpriority
"""


def q_inventory_published(spark, sf_dir):
    """F14 with its tail: the cleaned inventory, all cells quoted, read back as text."""
    back = read_base_csv(spark, export_inventory(_inventory_raw(spark, sf_dir), f"{scratch_dir(spark)}/inventory-{uuid.uuid4().hex}"))
    ids = ["variable", "region", "unit", "model", "scenario"]
    return pivot_longer(back, ids, [c for c in back.columns if c.isdigit()], "year", "cell").select(*ids, F.col("year").cast("int").alias("year"), "cell")


SQL_INVENTORY_PUBLISHED = f"""
WITH cells AS (
  SELECT 'Emissions|' || n_name AS variable, o_orderstatus AS region, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS BIGINT) // 1000 AS k
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey <> 4 AND o_orderstatus <> 'P' GROUP BY 1, 2, 3),
grid AS (SELECT * FROM (SELECT DISTINCT variable, region FROM cells) CROSS JOIN (VALUES {', '.join(f'({y})' for y in fx.YEARS)}) y(year))
SELECT g.variable, g.region, 'MMTCO2/yr' AS unit, 'EPA.GHGI' AS model, '2022' AS scenario, g.year,
       CASE WHEN c.k IS NULL THEN 'NA' WHEN c.k < {INVENTORY_THRESHOLD} THEN '+' ELSE format('{{:,.2f}}', CAST(c.k AS DOUBLE)) END AS cell
FROM grid g LEFT JOIN cells c ON g.variable = c.variable AND g.region = c.region AND g.year = c.year
"""


QUERIES = {
    "ingest_violations": q_ingest_violations,
    "ingest_text_numbers": q_ingest_text_numbers,
    "payload_json": q_payload_json,
    "corrupt_records": q_corrupt_records,
    "corrupt_csv_rows": q_corrupt_csv_rows,
    "sink_roundtrip": q_sink_roundtrip,
    "rollup_missing_unit": q_rollup_missing_unit,
    "rounded_values": q_rounded_values,
    "first_per_key_nulls": q_first_per_key_nulls,
    "sorted_rank": q_sorted_rank,
    "catalog_filter": q_catalog_filter,
    "interpolate_columns": q_interpolate_columns,
    "tagged_maps": q_tagged_maps,
    "grid_to_series_map": q_grid_to_series_map,
    "pivot_open": q_pivot_open,
    "pivot_lists": q_pivot_lists,
    "convert_default_targets": q_convert_default_targets,
    "dispatch_modes": q_dispatch_modes,
    "units_variant": q_units_variant,
    "unit_factors_registry": q_unit_factors_registry,
    "unit_definitions": q_unit_definitions,
    "unit_prefixes": q_unit_prefixes,
    "alias_table": q_alias_table,
    "unit_classes": q_unit_classes,
    "input_violations": q_input_violations,
    "difference_warning": q_difference_warning,
    "template_file": q_template_file,
    "wide_published": q_wide_published,
    "inventory_published": q_inventory_published,
}

ORACLE_SQL = {
    "ingest_violations": SQL_INGEST_VIOLATIONS,
    "ingest_text_numbers": SQL_INGEST_TEXT_NUMBERS,
    "payload_json": SQL_PAYLOAD_JSON,
    "corrupt_records": SQL_CORRUPT_RECORDS,
    "corrupt_csv_rows": SQL_CORRUPT_CSV_ROWS,
    "sink_roundtrip": SQL_SINK_ROUNDTRIP,
    "rollup_missing_unit": SQL_ROLLUP_MISSING_UNIT,
    "rounded_values": SQL_ROUNDED_VALUES,
    "first_per_key_nulls": SQL_FIRST_PER_KEY_NULLS,
    "sorted_rank": SQL_SORTED_RANK,
    "catalog_filter": SQL_CATALOG_FILTER,
    "interpolate_columns": SQL_INTERPOLATE_COLUMNS,
    "tagged_maps": SQL_TAGGED_MAPS,
    "grid_to_series_map": SQL_GRID_TO_SERIES_MAP,
    "pivot_open": SQL_PIVOT_OPEN,
    "pivot_lists": SQL_PIVOT_LISTS,
    "convert_default_targets": SQL_CONVERT_DEFAULT_TARGETS,
    "dispatch_modes": SQL_DISPATCH_MODES,
    "units_variant": SQL_UNITS_VARIANT,
    "unit_factors_registry": SQL_UNIT_FACTORS_REGISTRY,
    "unit_definitions": SQL_UNIT_DEFINITIONS,
    "unit_prefixes": SQL_UNIT_PREFIXES,
    "alias_table": SQL_ALIAS_TABLE,
    "unit_classes": SQL_UNIT_CLASSES,
    "input_violations": SQL_INPUT_VIOLATIONS,
    "difference_warning": SQL_DIFFERENCE_WARNING,
    "template_file": SQL_TEMPLATE_FILE,
    "wide_published": SQL_WIDE_PUBLISHED,
    "inventory_published": SQL_INVENTORY_PUBLISHED,
}
