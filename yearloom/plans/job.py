"""The whole harmonisation job from files to published outputs.

Inputs (any Spark-readable location): mapping CSVs for tagged sources
(dataset, scenario), an optional projection key template with a dataset x
scenario grid, the reporting template (CSV or Parquet), and landed series
payloads (JSON lines or Parquet with a nested ``data`` array) or flat
observations (Parquet). Outputs: the combined wide CSV, the rounded
change-tracking TSV, the unit-conversion QA crosswalk, the long table, and the
checks: what failed to parse, coverage gaps and series with several points a year.
With industry tables the grid expansion writes the key template first.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.functions.text import parse_number_text
from yearloom.operators.quality import assert_empty, coverage_gaps, frequency_violations
from yearloom.operators.reshape import sort_nulls_last
from yearloom.operators.units.algebra import unit_factor_table
from yearloom.plans.harmonize import export_change_tracker, export_wide, harmonize
from yearloom.plans.mapping import (build_series_map, clean_mapping, expand_industry_map, instantiate_template,
                                    tag_mapping)
from yearloom.session import materialize, remove_scratch
from yearloom.sources.readers import (corrupt_csv_rows, explode_payload, factor_violations, load_payload, payload_violations,
                                      read_base_csv, read_mapping_csv, read_observations, read_template)
from yearloom.sources.sinks import Publication, write_csv, write_csv_quoted, write_parquet


@dataclass
class JobSpec:
    """Where the inputs are and where the outputs go."""

    tagged_mappings: Sequence[tuple[str, str, str]]          # (csv path, dataset, scenario)
    template_path: str
    output_dir: str
    payload_path: str | None = None                          # landed payloads (json / parquet)
    payload_format: str = "json"
    observations_path: str | None = None                     # or flat observations (parquet)
    key_template_path: str | None = None                     # projection key template csv
    industry_path: str | None = None                         # industry dimension csv, and
    industry_var_path: str | None = None                     # its subcategories: expand the key template by their grid
    datasets: Sequence[str] = ()
    scenarios: Sequence[str] = ()
    region: str = "USA"
    years: Sequence[int] | None = None
    tracker_years: Sequence[int] = field(default_factory=lambda: [2020, 2030, 2040])
    start_year: int | None = None
    strict: bool = True        # a unit with a template target and a missing one is an error (False: keep it)
    max_broadcast_rows: int = 50_000   # series-map rows up to which the map is broadcast
    salt_buckets: int = 0              # > 1: salt the map join when the map is beyond the bound
    single_file: bool = False          # published tables as one file each (small results only)
    keep_scratch: bool = False         # keep the lineage-cut tables after the outputs are written


def expand_key_template(spark: SparkSession, spec: JobSpec) -> str:
    """the key template with the industry grid appended, ordered by descending
    variable, as an all-quoted CSV (blank cells stay blank); returns its path."""
    for path in (spec.key_template_path, spec.industry_path, spec.industry_var_path):
        assert_empty(corrupt_csv_rows(spark, path), f"{path}: rows that aren't whole")
    base = read_base_csv(spark, spec.key_template_path)
    base = base.withColumn("Factor", parse_number_text(F.col("Factor")))
    grid = expand_industry_map(read_base_csv(spark, spec.industry_path), read_base_csv(spark, spec.industry_var_path), base)
    ordered = sort_nulls_last(grid, ["Variable"], descending=True)
    return write_csv_quoted(ordered, f"{spec.output_dir.rstrip('/')}/key_template_expanded", single_file=spec.single_file)


def load_series_map(spark: SparkSession, spec: JobSpec) -> DataFrame:
    """F1 + F3 + F4 + F5: clean every mapping, tag it, instantiate the key
    template over the grid, and union them. A row that isn't whole (a cell too many
    or too few, an open quote) or a factor cell that isn't a number is an error: the
    strict sum would lose the row's variable, or make it missing as a whole."""
    maps = []
    for path, ds, sc in spec.tagged_mappings:
        assert_empty(corrupt_csv_rows(spark, path), f"{path}: rows that aren't whole")
        assert_empty(factor_violations(spark, path), f"{path}: factor cells that aren't numbers")
        maps.append(tag_mapping(clean_mapping(read_mapping_csv(spark, path)), ds, sc, spec.region))
    if spec.key_template_path:
        path = spec.key_template_path if spec.industry_path is None else expand_key_template(spark, spec)
        assert_empty(corrupt_csv_rows(spark, path), f"{path}: rows that aren't whole")
        assert_empty(factor_violations(spark, path), f"{path}: factor cells that aren't numbers")
        tmpl = clean_mapping(read_mapping_csv(spark, path))
        maps.append(instantiate_template(tmpl, list(spec.datasets), list(spec.scenarios), spec.region))
    return build_series_map(*maps)


def load_observations(spark: SparkSession, spec: JobSpec) -> tuple[DataFrame, DataFrame]:
    """observations from landed payloads (one distributed read) or a flat table,
    and the records and points that failed to parse. Only rows without unit and year are left out
    (and reported): no group of the roll-up could hold them."""
    if spec.payload_path:
        payload = load_payload(spark, spec.payload_path, spec.payload_format)
        obs, bad = explode_payload(payload, spec.start_year), payload_violations(payload)
    else:
        obs = read_observations(spark, spec.observations_path, spec.start_year)
        bad = obs.where(F.col("unit").isNull() & F.col("year").isNull()).select(
            "series_id", F.lit("unit and year").alias("field"), F.lit(None).cast("string").alias("cell"))
    return obs.where(F.col("unit").isNotNull() | F.col("year").isNotNull()), bad


def run_job(spark: SparkSession, spec: JobSpec) -> dict[str, str]:
    """Run the job and publish its outputs, all together; returns the output paths. A run that fails leaves an earlier run's outputs."""
    series_map = load_series_map(spark, spec)
    obs, bad = load_observations(spark, spec)
    parquet = spec.template_path.endswith(".parquet")
    if not parquet:
        assert_empty(corrupt_csv_rows(spark, spec.template_path), f"{spec.template_path}: rows that aren't whole")
    template = read_template(spark, spec.template_path, "parquet" if parquet else "csv")
    result = harmonize(obs, series_map, template.select("variable", "unit"), years=spec.years, strict=spec.strict,
                       max_broadcast_rows=spec.max_broadcast_rows, salt_buckets=spec.salt_buckets)
    wide = materialize(result["wide"])  # pivoted once for both exports
    crosswalk = materialize(result["crosswalk_qa"])
    pairs = crosswalk.where("to_unit is not null").select("from_unit", "to_unit")
    out = spec.output_dir.rstrip("/")
    with Publication(spark) as pub:  # all outputs appear together, or none
        paths = {
            "wide_csv": export_wide(wide, f"{out}/wide_csv", spec.single_file, publication=pub),
            "change_tracker_tsv": export_change_tracker(wide, f"{out}/change_tracker_tsv", spec.tracker_years, spec.single_file, publication=pub),
            "unit_crosswalk_qa": write_csv(crosswalk, f"{out}/unit_crosswalk_qa", order_by=["from_unit", "to_unit"], single_file=True, publication=pub),
            "long_parquet": write_parquet(result["long"], f"{out}/long_parquet", partition_by=["model"], publication=pub),
            "ingest_violations": write_parquet(bad, f"{out}/ingest_violations", publication=pub),
            "coverage_gaps": write_parquet(coverage_gaps(result["long"], template, series_map, unit_factor_table(pairs, cut_lineage=False)),
                                           f"{out}/coverage_gaps", publication=pub),
            "frequency_violations": write_parquet(frequency_violations(obs), f"{out}/frequency_violations", publication=pub),
        }
    if spec.industry_path is not None:
        paths["key_template_expanded"] = f"{out}/key_template_expanded"
    if not spec.keep_scratch:
        remove_scratch(spark)
    return paths
