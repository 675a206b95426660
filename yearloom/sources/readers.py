"""Sources (S1-S5).

Mapping and template tables are small text files read with declared schemas
(no ``inferSchema`` pass); observations are columnar (Parquet) or landed API
payloads (JSON / Parquet with a nested ``data`` array).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yearloom import schemas
from yearloom.functions.text import parse_number_text

# Where Spark's readers put the raw text of a record that isn't of the declared form.
CORRUPT = "_corrupt_record"

# Cells that stand for a missing number in landed payloads.
MISSING_NUMBERS = ["", "NA", "null", "--"]


def _normalise_strings(df: DataFrame, blank_as: str) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.nullif(c, F.lit("")) if blank_as == "null" else F.coalesce(c, F.lit(""))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def read_mapping_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                     multi_line: bool = False) -> DataFrame:
    """S1 (``readr::read_csv``): header row, ``NA`` and blank -> missing.

    Without a schema every column is read as text and ``Factor`` is parsed as a
    number with optional thousands commas; a cell that isn't one becomes missing
    and is reported by ``factor_violations``.
    A UTF-8 byte-order mark is handled by the reader. ``multi_line`` only for
    files with line breaks inside quoted cells (such a file is read by one task)."""
    r = (spark.read.option("header", True).option("nullValue", "NA").option("multiLine", multi_line)
         .option("escape", '"'))
    if schema is not None:
        df = r.schema(schema).csv(path)
    else:
        df = r.option("inferSchema", False).csv(path)
        df = df.toDF(*[c.lstrip("﻿") for c in df.columns])
        if "Factor" in df.columns:
            df = df.withColumn("Factor", parse_number_text(F.col("Factor")))
    return _normalise_strings(df, "null")


def factor_violations(spark: SparkSession, path: str, factor_col: str = "Factor") -> DataFrame:
    """S1 check: rows of a mapping file whose factor cell is neither blank, ``NA``
    nor a number (``path, factor`` and the row's other cells as read)."""
    df = spark.read.option("header", True).option("nullValue", "NA").option("escape", '"').csv(path)
    df = df.toDF(*[c.lstrip("\ufeff") for c in df.columns])
    if factor_col not in df.columns:
        return df.limit(0)
    cell = F.col(factor_col)
    return df.where((F.trim(cell) != "") & parse_number_text(cell).isNull())


def corrupt_csv_rows(spark: SparkSession, path: str, schema: T.StructType | str | None = None, sep: str = ",",
                     multi_line: bool = False, header: bool = True) -> DataFrame:
    """S1 / S2 / S3 check: ``problem, record`` of rows that aren't whole, with their raw text.

    ``problem`` is ``cells`` (more or fewer than the header or ``schema`` has, or one that
    isn't of the schema's type) or ``quote`` (a quoted cell that never ends; in the last
    cell no number of cells gives it away). Blank lines are no rows. With ``multi_line``
    cells may hold line breaks, records come as Spark's reader delimits them, and an open
    quote shows as ``cells``. One scan of the file's lines, no shuffle."""
    if schema is None:
        names = spark.read.option("header", True).option("sep", sep).option("multiLine", multi_line).option("escape", '"').csv(path).columns
        schema = T.StructType([T.StructField(n.lstrip("\ufeff"), T.StringType()) for n in names])
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    if multi_line:
        # every column is parsed whatever is selected, so that all cells are seen
        rows = (spark.read.schema(whole).option("header", header).option("sep", sep).option("nullValue", "NA").option("multiLine", True)
                .option("escape", '"').option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False).csv(path))
        # Spark refuses a scan of the raw text alone: an empty part of a parsed cell makes it read that too
        nothing = F.substring(F.col(f"`{whole.fields[0].name}`").cast("string"), 1, 0)
        return rows.where(F.col(CORRUPT).isNotNull()).select(F.concat_ws("", F.lit("cells"), nothing).alias("problem"), F.col(CORRUPT).alias("record"))
    head = spark.read.text(path).first() if header else None
    record = F.regexp_replace("value", "\r$", "")
    lines = spark.read.text(path).where(F.trim("value") != "")
    if head is not None:
        lines = lines.where(F.col("value") != head[0])  # every file's first line
    options = {"sep": sep, "nullValue": "NA", "escape": '"', "columnNameOfCorruptRecord": CORRUPT}
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in whole.fields)
    parsed = lines.select(record.alias("record"), F.from_csv(record, columns, options).alias("row"))
    quotes = F.length("record") - F.length(F.replace("record", F.lit('"'), F.lit("")))
    problem = F.when(quotes % 2 == 1, "quote").when(F.col("row").getField(CORRUPT).isNotNull(), "cells")
    return parsed.select(problem.alias("problem"), "record").where("problem is not null")


def read_base_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                  multi_line: bool = False) -> DataFrame:
    """S2 (``read.csv``): blank text cells stay ``""`` so ``!= ""`` tests behave."""
    r = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    df = r.schema(schema).csv(path) if schema is not None else r.csv(path)
    df = df.toDF(*[c.lstrip("﻿") for c in df.columns])
    return _normalise_strings(df, "blank")


def read_template(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """S3: the reporting template (variable -> unit [, round, tier]); names lower-cased.
    Delivered as CSV or Parquet (spreadsheet decoding is out of scope)."""
    df = spark.read.parquet(path) if fmt == "parquet" else read_mapping_csv(spark, path)
    return df.toDF(*[c.lower() for c in df.columns])


def template_units_from_mapping(mapping: DataFrame, variable_col: str = "Variable", unit_col: str = "EMF_Units") -> DataFrame:
    """Distinct (variable, emf_units) of a mapping table, names lower-cased."""
    return mapping.select(F.col(variable_col).alias("variable"), F.col(unit_col).alias("emf_units")).distinct()


def _payload_points(payload: DataFrame) -> DataFrame:
    point = F.col("p")
    return payload.select("series_id", "name", F.col("units").alias("unit"), F.explode("data").alias("p")).select(
        "series_id", "name", "unit", point["year"].cast("string").alias("year_text"), point["value"].cast("string").alias("value_text"))


def explode_payload(payload: DataFrame, start: int | None = None) -> DataFrame:
    """S5 after the read: one row per series with a ``data`` array of
    ``(year, value)`` points -> the long observation table
    ``series_id, name, year, unit, value``. Years and values may be text; one that
    doesn't parse is missing here and listed by ``payload_violations``. ``start``
    drops earlier points inside the arrays, before they become rows. Records that were
    landed corrupt (``load_payload``) give no points, not even the part that parsed."""
    if CORRUPT in payload.columns:
        payload = payload.where(F.col(CORRUPT).isNull())
    if start is not None:
        payload = payload.withColumn("data", F.filter("data", lambda p: p["year"].cast("string").try_cast("int") >= F.lit(start)))
    return _payload_points(payload).select(
        "series_id", "name", F.col("year_text").try_cast("int").alias("year"), "unit",
        parse_number_text(F.col("value_text")).alias("value"))


def payload_violations(payload: DataFrame) -> DataFrame:
    """S5 check: ``series_id, field, cell`` of points whose year or value is present
    but isn't a number, of points without a unit and a year (``field`` is
    ``unit and year``), which no roll-up group can hold, and of landed records that
    aren't of the payload's form (``record``: the cell is their raw text)."""
    if CORRUPT in payload.columns:
        broken = payload.where(F.col(CORRUPT).isNotNull()).select("series_id", F.lit("record").alias("field"), F.col(CORRUPT).alias("cell"))
        return payload_violations(payload.where(F.col(CORRUPT).isNull()).drop(CORRUPT)).unionByName(broken)
    points = _payload_points(payload)
    year, value = F.col("year_text"), F.col("value_text")
    bad_year = year.isNotNull() & year.try_cast("int").isNull()
    bad_value = value.isNotNull() & ~F.trim(value).isin(MISSING_NUMBERS) & parse_number_text(value).isNull()
    neither = F.col("unit").isNull() & year.try_cast("int").isNull()
    found = F.filter(F.array(
        F.when(bad_year, F.struct(F.lit("year").alias("field"), year.alias("cell"))),
        F.when(bad_value, F.struct(F.lit("value").alias("field"), value.alias("cell"))),
        F.when(neither, F.struct(F.lit("unit and year").alias("field"), year.alias("cell")))), lambda x: x.isNotNull())
    return points.select("series_id", F.explode(found).alias("f")).select("series_id", "f.field", "f.cell")


def load_payload(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """All landed payload files in one distributed read (O5), as landed. A JSON
    line that is cut, or that has a field of another form, keeps its raw text in
    ``_corrupt_record`` (``payload_violations`` lists it)."""
    if fmt != "json":
        return spark.read.parquet(path)
    landed = T.StructType([*schemas.SERIES_PAYLOAD.fields, T.StructField(CORRUPT, T.StringType())])
    # from lines, not by the JSON source: that one parses only the fields a query selects, and misses faults in the others
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", landed, {"columnNameOfCorruptRecord": CORRUPT}).alias("r"))
    broken = F.when(F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull(), F.col("value"))
    return parsed.select(*[F.col(f"r.{f.name}") for f in schemas.SERIES_PAYLOAD.fields], broken.alias(CORRUPT))


def read_payload(spark: SparkSession, path: str, fmt: str = "json", start: int | None = None) -> DataFrame:
    """Landed payload files, exploded to observations."""
    return explode_payload(load_payload(spark, path, fmt), start)


def read_observations(spark: SparkSession, path: str, start: int | None = None) -> DataFrame:
    """Flat observations in Parquet; a ``start`` filter reaches the scan."""
    df = spark.read.schema(schemas.OBSERVATIONS).parquet(path)
    return df.where(F.col("year") >= F.lit(start)) if start is not None else df
