"""Data-quality operators (Q1-Q8): each returns a DataFrame of violations.

Only ``assert_empty`` is an action, and it reads at most a few rows, so a check
costs one aggregate (map-side combined) over the checked table.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.operators.aggregate import duplicate_groups
from yearloom.operators.joins import anti_join, join_dim
from yearloom.operators.units.convert import crosswalk_violations


class QualityError(AssertionError):
    pass


def assert_empty(violations: DataFrame, what: str, show: int = 10) -> DataFrame:
    """Raise if ``violations`` has a row; the message carries up to ``show`` rows and
    the full count."""
    rows = violations.limit(show).collect()
    if rows:
        raise QualityError(f"{what} ({violations.count()} rows): " + "; ".join(str(r.asDict()) for r in rows))
    return violations


def unique_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q1: groups of ``cols`` holding more than one row (``n_rows``)."""
    return duplicate_groups(df, cols)


def frequency_violations(obs: DataFrame, keys: Sequence[str] = ("series_id", "year")) -> DataFrame:
    """Series with more than one observation in a year (a sub-annual series
    whose points the roll-up would add up)."""
    return duplicate_groups(obs, list(keys))


def unit_map_violations(crosswalk: DataFrame, from_col: str = "from_unit", to_col: str = "to_unit") -> DataFrame:
    """Q2: from-units mapping to more than one target; a missing target counts."""
    return crosswalk_violations(crosswalk, from_col, to_col)


def nonmatch(df: DataFrame, unit_col: str = "unit", target_col: str = "emf_units") -> DataFrame:
    """Q3: rows left in a unit other than the template unit (rows without a
    template unit pass: the comparison is missing)."""
    return df.where(F.col(unit_col) != F.col(target_col))


def unit_differences(df: DataFrame, benchmark: DataFrame, comparison_col: str = "unit",
                     keys: Sequence[str] = ("model", "scenario", "variable", "unit")) -> DataFrame:
    """Q4: distinct (model, scenario, variable, unit) whose unit differs from the
    benchmark's unit for that variable. ``benchmark`` has ``variable`` and
    ``comparison_col``; it is joined as a dimension."""
    combos = df.select(*keys).distinct()
    bench = benchmark.select("variable", F.col(comparison_col).alias("benchmark_unit"))
    return join_dim(combos, bench, ["variable"], "left").where(F.col("unit") != F.col("benchmark_unit"))


def warn_unit_differences(df: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """Q5: Q4 plus a Python warning when there is any difference."""
    diff = unit_differences(df, benchmark, **kw)
    if not diff.isEmpty():
        warnings.warn("variable/unit combinations differ from the template", stacklevel=2)
    return diff


def coverage_gaps(data: DataFrame, template: DataFrame, series_map: DataFrame, convertible_pairs: DataFrame | None = None
                  ) -> DataFrame:
    """Q8: ``gap, key`` rows for

    * ``variable_not_in_template`` - data variables the template lacks,
    * ``template_variable_unmapped`` - template variables no mapping row feeds,
    * ``unit_not_convertible`` - (unit -> template unit) pairs that cannot be converted
      (``convertible_pairs``: output of ``unit_factor_table``).
    """
    dv = data.select("variable").distinct()
    tv = template.select("variable").distinct()
    mv = series_map.select("variable").distinct()
    out = (anti_join(dv, tv, ["variable"]).select(F.lit("variable_not_in_template").alias("gap"), F.col("variable").alias("key"))
           .unionByName(anti_join(tv, mv, ["variable"]).select(F.lit("template_variable_unmapped").alias("gap"),
                                                               F.col("variable").alias("key"))))
    if convertible_pairs is not None:
        bad = convertible_pairs.where(~F.col("convertible")).select(
            F.lit("unit_not_convertible").alias("gap"),
            F.concat_ws(" -> ", F.col("from_unit"), F.col("to_unit")).alias("key"))
        out = out.unionByName(bad)
    return out
