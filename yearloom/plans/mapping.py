"""Mapping-side flows (F1-F5): clean mapping tables, expand the industry grid,
instantiate series-key templates over the dataset x scenario grid, tag and
union the maps, list and batch the series keys.

All of these work on dimension-sized tables; the one product with data (F3) is
a literal-grid ``explode``, linear in the template.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.functions.text import interpolate_template, paste0, when_r
from yearloom.operators.aggregate import key_batches
from yearloom.operators.columns import (add_constants, drop_by_pattern, drop_na_any_of, lower_names,
                                        remove_empty, where_not_blank)
from yearloom.operators.joins import cross_with_bounded, expand_literal_grid, join_dim, parameter_grid
from yearloom.operators.reshape import union_by_name
from yearloom.session import materialize

SERIES_MAP_COLUMNS = ["dataset", "scenario", "region", "series_id", "variable", "factor"]

# Core projection scenarios of one edition, and the regions a
# projection may be requested for (the nation and the 50 state abbreviations).
VALID_SCENARIOS = ["REF2020", "HIGHMACRO", "LOWMACRO", "HIGHPRICE", "LOWPRICE", "HIGHOGS", "LOWOGS", "HIRENCST",
                   "LORENCST"]
VALID_REGIONS = ["USA", "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS",
                 "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC",
                 "ND", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY"]

# The default dataset x scenario grid for projection templates.
DEFAULT_DATASETS = ["AEO.2020", "AEO.2021", "AEO.2022"]
DEFAULT_SCENARIOS = ["REF2020", "REF2021", "REF2022"]


def clean_mapping(raw: DataFrame) -> DataFrame:
    """drop comment/notes columns, empty rows and columns, lower-case names,
    drop rows missing ``variable`` / ``series_id`` / ``series_template``."""
    df = drop_by_pattern(raw, regex="Comments", prefix="notes")
    df = remove_empty(df, rows=True, cols=True)
    df = lower_names(df)
    return drop_na_any_of(df, ["variable", "series_id", "series_template"])


def expand_industry_map(industry_dim: DataFrame, industry_var_dim: DataFrame, base_template: DataFrame | None = None,
                        *, max_subcategories: int = 10_000) -> DataFrame:
    """distinct industries x distinct subcategories, attributes joined on
    ``EMF_subcategory``, key template / series name / variable path built, then
    appended to the base template.

    An unknown category gives a missing ``Variable`` (the row is dropped later by
    F1); a missing ``EIA_subsector`` or category gives missing text per R's
    if_else rule."""
    ind = where_not_blank(industry_dim, "EMF_industry_name")
    # used twice (the subcategory list and the attribute join): written once
    industry_var_dim = materialize(industry_var_dim)
    subcats = industry_var_dim.select("EMF_subcategory")
    grid = cross_with_bounded(ind, subcats, max_rows=max_subcategories)
    attrs = industry_var_dim.drop(*[c for c in industry_var_dim.columns if c in ind.columns and c != "EMF_subcategory"])
    g = join_dim(grid, attrs, ["EMF_subcategory"], "left", null_safe=False)
    c = F.col
    series_template = paste0("{EIA_dataset}.{EIA_scenario}.", c("EIA_prefix"), c("EIA_abbrev"), "_",
                             c("EIA_energy_code"), c("EIA_suffix"))
    series_name = when_r(c("EIA_subsector") != "",
                         paste0(c("EIA_main_sector"), " : ", c("EIA_subsector"), " : ", c("EIA_category_name")),
                         paste0(c("EIA_main_sector"), " : ", c("EIA_category_name")))
    cat = c("EMF_category")
    variable = (F.when(cat.isNull(), F.lit(None))
                .when(cat == "Energy", paste0("Final Energy|Industry|", c("EMF_main_sector"), "|",
                                              c("EMF_industry_name"), "|", c("EMF_subcategory")))
                .when(cat == "Emissions", paste0("Emissions|CO2|Energy|Demand|Industry|", c("EMF_main_sector"), "|",
                                                 c("EMF_industry_name")))
                .when(cat == "Output", paste0("Output|Industry|", c("EMF_main_sector"), "|", c("EMF_industry_name"),
                                              "|Value"))
                .otherwise(F.lit(None)))
    expanded = g.select(
        variable.cast("string").alias("Variable"),
        series_template.alias("Series_template"),
        series_name.cast("string").alias("Series_Name"),
        paste0(c("notes_var_map"), ". ", c("notes_ind_map")).alias("notes"),
    ).withColumn("Factor", F.lit(1.0)).withColumn("notes_variable", F.lit(""))
    if base_template is None:
        return expanded
    return union_by_name([base_template, expanded])


def instantiate_template(template: DataFrame, datasets: Sequence[str] = DEFAULT_DATASETS,
                         scenarios: Sequence[str] = DEFAULT_SCENARIOS, region: str = "USA",
                         template_col: str = "series_template") -> DataFrame:
    """each template row x every (dataset, scenario) pair; ``{EIA_dataset}``
    and ``{EIA_scenario}`` in the key template are replaced (first occurrence)."""
    grid = parameter_grid(EIA_dataset=list(datasets), EIA_scenario=list(scenarios))
    g = expand_literal_grid(template, grid)
    sid = interpolate_template(F.col(template_col), [("EIA_dataset", F.col("EIA_dataset")),
                                                     ("EIA_scenario", F.col("EIA_scenario"))])
    return g.select(F.col("EIA_dataset").alias("dataset"), F.col("EIA_scenario").alias("scenario"),
                    F.lit(region).alias("region"), sid.alias("series_id"), "variable",
                    F.col("factor"))


def tag_mapping(mapping: DataFrame, dataset: str, scenario: str, region: str = "USA") -> DataFrame:
    """tag a clean mapping with its dataset / scenario / region."""
    df = add_constants(mapping, {"dataset": dataset, "scenario": scenario, "region": region})
    return df.select(*SERIES_MAP_COLUMNS)


def build_series_map(*maps: DataFrame) -> DataFrame:
    """one series map from all sources."""
    return union_by_name(maps).select(*SERIES_MAP_COLUMNS)


def restrict_to_catalog(series_map: DataFrame, scenarios: Sequence[str] | None = VALID_SCENARIOS,
                        regions: Sequence[str] | None = VALID_REGIONS) -> DataFrame:
    """keep mapping rows whose scenario / region are in the catalogues
    (``None`` = no restriction on that column)."""
    out = series_map
    if scenarios is not None:
        out = out.where(F.col("scenario").isin(list(scenarios)))
    if regions is not None:
        out = out.where(F.col("region").isin(list(regions)))
    return out


def template_subset(template: DataFrame, round_: str = "beta", tiers: Sequence[int] = (1, 2)) -> DataFrame:
    """Template rows of one review round and the given tiers."""
    return template.where((F.col("round") == round_) & F.col("tier").isin(list(tiers)))


def series_key_batches(series_map: DataFrame, batch_size: int = 100) -> DataFrame:
    """distinct series keys, numbered and cut into request batches."""
    return key_batches(series_map, "series_id", batch_size)
