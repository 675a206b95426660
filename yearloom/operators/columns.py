"""Projections, renames and row filters.

Column-name operations (P2-P4, P6, P16) are driver-side list work on
``df.columns`` / ``df.schema`` and add nothing to the plan but a projection.
Row filters are plain ``where`` clauses, so Catalyst pushes them to the scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def add_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Constant tag columns (dataset / scenario / region / model)."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def select_existing(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """P2 with ``any_of`` semantics: keep those of ``cols`` that exist, in that order."""
    have = set(df.columns)
    return df.select(*[c for c in cols if c in have])


def relocate(df: DataFrame, first: Iterable[str]) -> DataFrame:
    """P2 ``relocate``: move ``first`` to the front, keep the rest in order."""
    first = [c for c in first if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])


def drop_by_pattern(df: DataFrame, regex: str | None = None, prefix: str | None = None) -> DataFrame:
    """Drop columns whose name matches ``regex`` (search, case-insensitive) or
    starts with ``prefix`` (case-insensitive)."""
    keep = []
    for c in df.columns:
        if regex is not None and re.search(regex, c, flags=re.IGNORECASE):
            continue
        if prefix is not None and c.lower().startswith(prefix.lower()):
            continue
        keep.append(c)
    return df.select(*[F.col(f"`{c}`") for c in keep])


def _blank(c: str, dtype) -> Column:
    """Missing cell: NULL, or NaN for floating columns (text "" is a value)."""
    col = F.col(f"`{c}`")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def remove_empty(df: DataFrame, rows: bool = True, cols: bool = True) -> DataFrame:
    """P5: drop rows whose every cell is missing and columns with no value.

    Dropping columns is data dependent, so it runs one aggregate action (one
    count per column). Meant for dimension tables, never the fact table."""
    if rows and df.columns:
        all_blank = None
        for f in df.schema.fields:
            b = _blank(f.name, f.dataType)
            all_blank = b if all_blank is None else all_blank & b
        df = df.where(~all_blank)
    if cols and df.columns:
        counts = df.agg(*[F.count_if(~_blank(f.name, f.dataType)).alias(f"c{i}")
                          for i, f in enumerate(df.schema.fields)]).first()
        keep = [f.name for i, f in enumerate(df.schema.fields) if counts[f"c{i}"] > 0]
        df = df.select(*[F.col(f"`{c}`") for c in keep])
    return df


def lower_names(df: DataFrame) -> DataFrame:
    """P6."""
    return df.toDF(*[c.lower() for c in df.columns])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """P7."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def drop_na_any_of(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop rows missing any of those ``cols`` that exist."""
    subset = [c for c in cols if c in df.columns]
    return df.dropna(how="any", subset=subset) if subset else df


def where_not_blank(df: DataFrame, col: str) -> DataFrame:
    """Keep rows whose ``col`` is neither missing nor ``""``."""
    return df.where(F.col(col) != "")


def where_present(df: DataFrame, col: str = "value") -> DataFrame:
    """Keep rows whose value is present (not NULL, not NaN)."""
    dt = df.schema[col].dataType
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return df.where(F.col(col).isNotNull() & ~F.isnan(col))
    return df.where(F.col(col).isNotNull())


def where_matches(df: DataFrame, col: str, pattern: str, ignore_case: bool = True) -> DataFrame:
    """Regex filter, case-insensitive by default; missing never matches."""
    pat = f"(?i){pattern}" if ignore_case else pattern
    return df.where(F.coalesce(F.col(col).rlike(pat), F.lit(False)))


def round_numeric(df: DataFrame, digits: int = 2) -> DataFrame:
    """P16 + L12: round every numeric column, half-up on the decimal value.

    A double is rounded once, on its shortest decimal text (0.285 -> 0.29,
    1.00499999999 -> 1.00). Doubles of 1e16 and more have no fraction and stay, and so
    do NaN and the infinities."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exact = F.round(c.cast("string").try_cast(T.DecimalType(38, 21)), digits).cast("double")
            out.append(F.when(F.abs(c) < F.lit(1e16), exact).otherwise(c).alias(f.name))
        elif isinstance(f.dataType, T.DecimalType):
            out.append(F.round(c, digits).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)
