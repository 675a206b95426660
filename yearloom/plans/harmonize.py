"""The harmonisation job (F6-F14) composed from the operators.

Physical shape on the fact table (``harmonize``):

    scan(obs) -> BroadcastHashJoin(series_map) -> partial agg -> shuffle -> final agg
    -> BroadcastHashJoin(template units) -> filter -> relabel        [aggregate-sized]
    -> checkpoint -> convert (broadcast factor join) -> pivot -> sink

The only fact-sized exchange is the partial aggregate's output (already
combined per task). Everything after the roll-up is sized by the number of
(variable, unit, year) groups and is cut from its lineage once, because the
long table feeds the crosswalk, the conversion, the conformance check and the
pivot.

``literal=True`` builds the reference's literal form (full outer joins) for the
equivalence tests of the rewrite.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from yearloom.functions.unit_names import (TEMPLATE_DISPLAY_NAMES, map_whole_values, relabel_units,
                                           standardize_unit_names)
from yearloom.operators.aggregate import scaled_rollup
from yearloom.operators.columns import add_constants, round_numeric, where_present
from yearloom.operators.joins import full_outer_join, join_dim, semi_join
from yearloom.operators.quality import QualityError, assert_empty, nonmatch
from yearloom.operators.reshape import PivotError, pivot_open
from yearloom.operators.units.convert import convert_crosswalk, convert_rowwise
from yearloom.schemas import LONG_COLUMNS, WIDE_ID_COLUMNS
from yearloom.session import DEFAULT_BROADCAST_ROWS, materialize, row_count_at_most
from yearloom.sources.sinks import Publication, write_csv, write_csv_quoted, write_tsv

# Source tags (case-insensitive patterns) and the model label each
# split is published under (None = keep the model column).
SOURCE_SPLITS = [
    ("model", "AEO", None),
    ("scenario", "Historic", "EIA_Historic"),
    ("model", "STEO", "EIA_STEO"),
]


def map_and_rollup(obs: DataFrame, series_map: DataFrame, *, literal: bool = False,
                   max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, salt_buckets: int = 0) -> DataFrame:
    """observations x series map, ``value * factor`` summed per
    (dataset, scenario, variable, region, unit, year).

    The rewrite joins inner with the map broadcast: map-only rows would form
    groups with missing unit/year/value and data-only rows get a missing factor;
    both are removed later by the missing-value filter. An observation without a
    unit, or without a year, forms a group of its own and is kept; one without both
    is a violation at ingest (``payload_violations``)."""
    if literal:
        joined = full_outer_join(obs, series_map, ["series_id"])
    else:
        joined = join_dim(obs, series_map, ["series_id"], "inner", max_broadcast_rows=max_broadcast_rows,
                          salt_buckets=salt_buckets)
    return scaled_rollup(joined)


def template_units_present(template: DataFrame, data: DataFrame, unit_col: str = "unit") -> DataFrame:
    """F8: template (variable, emf_units) rows whose variable occurs in the data.
    Runs one job over ``data``: its distinct variables are written once."""
    t = template.select("variable", F.col(unit_col).alias("emf_units")).distinct()
    return semi_join(t, materialize(data.select("variable").distinct()), ["variable"])


def attach_units(rolled: DataFrame, template_units: DataFrame, *, literal: bool = False, template_rows: int | None = None,
                 max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, salt_buckets: int = 0) -> DataFrame:
    """attach the template unit (J2), drop missing values (P11), relabel.

    A template variable without data would only add rows with a missing value,
    so the left join (dimension broadcast) equals the reference's full merge
    after the filter."""
    if literal:
        j = full_outer_join(rolled, template_units, ["variable"])
    else:
        j = join_dim(rolled, template_units, ["variable"], "left", dim_rows=template_rows, max_broadcast_rows=max_broadcast_rows,
                     salt_buckets=salt_buckets)
    j = where_present(j, "value")
    return j.withColumn("unit", relabel_units(F.col("variable"), F.col("unit")))


def convert_to_template(df: DataFrame, *, strict: bool = True, check: bool = True, df_is_written: bool = False,
                        max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, salt_buckets: int = 0) -> DataFrame:
    """convert each row to its template unit with the data's own crosswalk
    (U7), then require every row with a template unit to be in it (Q3).
    ``df_is_written``: ``df`` is already a written table, so its crosswalk needs
    no lineage cut of its own."""
    xw = df.select(F.col("unit").alias("from_unit"), F.col("emf_units").alias("to_unit"))
    converted = convert_crosswalk(df, xw, strict=strict, cut_lineage=not df_is_written,
                                  max_broadcast_rows=max_broadcast_rows, salt_buckets=salt_buckets)
    # counted while the rows are written; only a count above zero reads them again
    seen = Observation()
    out = materialize(converted.observe(seen, F.count_if(F.col("unit") != F.col("emf_units")).alias("off")))
    if check and seen.get["off"]:
        assert_empty(nonmatch(out), "rows not in the template unit")
    return out


def crosswalk_qa(df: DataFrame) -> DataFrame:
    """Q6: distinct (from_unit, to_unit) with both standardised names."""
    xw = df.select(F.col("unit").alias("from_unit"), F.col("emf_units").alias("to_unit")).distinct()
    return xw.select("from_unit", standardize_unit_names(F.col("from_unit")).alias("from_units_unit"),
                     standardize_unit_names(F.col("to_unit")).alias("to_units_unit"), "to_unit")


def long_table(converted: DataFrame) -> DataFrame:
    """F10 tail: the published long table (sorted only at a sink)."""
    return converted.drop("emf_units").select(*LONG_COLUMNS)


def tag_sources(long: DataFrame, splits=SOURCE_SPLITS) -> DataFrame:
    """F11 first half: rows of the source splits (P13), ``model`` relabelled where the
    split says so; a row of several splits comes once for each, a row of none is
    dropped. One pass over ``long``."""
    labels = F.array(*[F.when(F.coalesce(F.col(col).rlike(f"(?i){pattern}"), F.lit(False)),
                              F.struct((F.col("model") if label is None else F.lit(label)).alias("model")))
                       for col, pattern, label in splits])
    hit = F.explode(F.filter(labels, lambda x: x.isNotNull())).alias("__split")
    rows = long.select("*", hit)
    return rows.select(*[F.col("__split.model").alias("model") if c == "model" else F.col(c) for c in long.columns])


def wide_table(long: DataFrame, years: Sequence[int] | None = None, *, check_unique: bool = True) -> DataFrame:
    """F11 + F12: one pivot over the tagged rows (instead of three), year columns in
    ascending order, one row per (model, scenario, region, variable, unit) - which
    makes the reference's keep-first dedupe (A4) a no-op. Rows without a year go to a
    column ``NA``.

    The cells are aggregated and written once (``pivot_open``); a cell with two
    values (``check_unique``) and a year outside a given ``years`` list are errors,
    counted while the cells are written. Without a list the years are the data's."""
    tagged = tag_sources(long).withColumn("year", F.coalesce(F.col("year").cast("string"), F.lit("NA")))
    try:
        return pivot_open(tagged, WIDE_ID_COLUMNS, on_duplicates="error" if check_unique else "max", columns=None if years is None else [str(y) for y in years])
    except PivotError as e:
        raise QualityError(f"more than one value per cell (T11) or a year outside the list: {e}") from e


def harmonize(obs: DataFrame, series_map: DataFrame, template: DataFrame, *, years: Sequence[int] | None = None,
              literal: bool = False, strict: bool = True, build_wide: bool = True,
              max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, salt_buckets: int = 0) -> dict[str, DataFrame]:
    """The whole job (F7-F12): returns ``long``, ``crosswalk_qa`` and (unless
    ``build_wide=False``) ``wide``.

    Jobs: one pass over the facts (scan, broadcast map join, partial aggregate)
    writing the attached long table; small jobs for the crosswalk, its factors
    and the conversion; conformance and uniqueness checks on written tables."""
    rolled = map_and_rollup(obs, series_map, literal=literal, max_broadcast_rows=max_broadcast_rows,
                            salt_buckets=salt_buckets)
    if literal:
        tu = template_units_present(template, rolled)
    else:
        # F8's semi join only narrows the template to variables present in the
        # data; under the left join from the data it changes nothing, and it
        # would cost a second pass over the facts.
        tu = template.select("variable", F.col("unit").alias("emf_units")).distinct()
    # the template is a dimension: bound it once (its distinct units are no more)
    t_rows = max_broadcast_rows if row_count_at_most(template, max_broadcast_rows) else max_broadcast_rows + 1
    sizes = {"max_broadcast_rows": max_broadcast_rows, "salt_buckets": salt_buckets}
    attached = materialize(attach_units(rolled, tu, literal=literal, template_rows=t_rows, **sizes))
    converted = convert_to_template(attached, strict=strict, df_is_written=True, **sizes)
    long = long_table(converted)
    out = {"long": long, "crosswalk_qa": crosswalk_qa(attached)}
    if build_wide:
        out["wide"] = wide_table(long, years)
    return out


def display_unit_names(df: DataFrame, cols: Sequence[str], *, display_names=TEMPLATE_DISPLAY_NAMES,
                       max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """L5 + L16: for each of ``cols`` add ``<col>_std`` (registry name) and
    ``<col>_display`` (template display name). The alias fold runs on the distinct
    units only, which are written once and joined back."""
    values = None
    for c in cols:
        v = df.select(F.col(c).alias("__u"))
        values = v if values is None else values.union(v)
    std = standardize_unit_names(F.col("__u"))
    names = materialize(values.where("__u is not null").distinct()).select("__u", std.alias("__s"))
    few = row_count_at_most(names, max_broadcast_rows)
    names = names.select("*", map_whole_values(F.col("__s"), display_names).alias("__d"))
    for c in cols:
        own = names.select(F.col("__u").alias(f"__{c}"), F.col("__s").alias(f"{c}_std"), F.col("__d").alias(f"{c}_display"))
        own = F.broadcast(own) if few else own
        df = df.join(own, F.col(c) == F.col(f"__{c}"), "left").drop(f"__{c}")
    return df


def convert_with_default_targets(df: DataFrame, *, target_col: str = "emf_units",
                                 display_names=TEMPLATE_DISPLAY_NAMES) -> DataFrame:
    """The table form of conversion. A row without a template unit targets
    its own unit (L15); units are converted rowwise on their standardised names;
    resulting names are mapped back to the template's display names (L16). Runs
    the jobs for the distinct units and pairs."""
    spec = df.withColumn("__target", F.coalesce(F.col(target_col), F.col("unit"))).withColumnRenamed("unit", "__unit")
    spec = display_unit_names(spec, ["__unit", "__target"], display_names=display_names)
    spec = spec.withColumn("unit", F.col("__unit_std"))
    out = convert_rowwise(spec, F.col("__target_std"), rename_fun=lambda c: c)
    # a converted row holds its target's name, any other its own
    shown = F.when(F.col("unit") == F.col("__target_std"), F.col("__target_display")).otherwise(F.col("__unit_display"))
    return out.withColumn("unit", shown).select(*df.columns)


def export_wide(wide: DataFrame, path: str, single_file: bool = False, publication: Publication | None = None) -> str:
    """the combined wide table as CSV, ordered by model, scenario, region,
    variable; missing cells as NA. ``single_file`` only for small results."""
    return write_csv(wide, path, order_by=["model", "scenario", "region", "variable"], single_file=single_file, publication=publication)


def export_change_tracker(wide: DataFrame, path: str, years: Sequence[int | str], single_file: bool = False,
                          publication: Publication | None = None) -> str:
    """the rounded change-tracking TSV, ordered by the id columns."""
    return write_tsv(change_tracker(wide, years), path, order_by=WIDE_ID_COLUMNS, single_file=single_file, publication=publication)


def change_tracker(wide: DataFrame, years: Sequence[int | str], digits: int = 2) -> DataFrame:
    """the id columns and the selected years, numbers rounded (half-up on the
    decimal value). A year that the table lacks is an error. Sorted at the sink."""
    names = [str(y) for y in years]
    missing = [y for y in names if y not in wide.columns]
    if missing:
        raise ValueError(f"the wide table has no column for {', '.join(missing)}")
    return round_numeric(wide.select(*WIDE_ID_COLUMNS, *names), digits)


def clean_inventory(raw: DataFrame, *, unit_filter: str = "MMTCO2e", unit_label: str = "MMTCO2/yr",
                    model: str = "EPA.GHGI", scenario: str = "2022",
                    drop: Sequence[str] = ("var_coverage", "notes", "chapter", "table", "rownum", "rowlabel",
                                           "category", "gas")) -> DataFrame:
    """emissions inventory in the wide text form: rows with a variable, in
    the selected unit, relabelled and tagged."""
    df = raw.where(F.col("variable") != "").drop(*[c for c in drop if c in raw.columns])
    df = df.where(F.col("unit") == unit_filter).withColumn("unit", F.lit(unit_label))
    return add_constants(df, {"model": model, "scenario": scenario})


def export_inventory(raw: DataFrame, path: str, single_file: bool = False, **options) -> str:
    """F14 tail: the cleaned inventory, ordered by variable, unit and region, as an
    all-quoted CSV (O1 + S9)."""
    clean = clean_inventory(raw, **options)
    return write_csv_quoted(clean, path, order_by=[c for c in ("variable", "unit", "region") if c in clean.columns],
                            single_file=single_file)
