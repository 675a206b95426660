"""Unit conversion of fact tables.

Plan shape, whatever the mode: the conversion *spec* (from-unit -> target) is
reduced to its distinct pairs (a partial+final aggregate that map-side combines
to a handful of rows, or no pass at all when the crosswalk is given), factors are
computed on those pairs only (``unit_factor_table``), the small factor table is
cut from its lineage and size-checked, and the facts take one broadcast hash join
plus a projection. The fact table is never shuffled by a conversion.

Modes are chosen by parameter type instead of by argument length:

* ``convert_rowwise(df, to_unit=Column)``  - U4, each row names its target.
* ``convert_to_single(df, "EJ/yr")``       - U5, convertible units change, the rest pass.
* ``convert_from_set(df, [..], "EJ/yr")``  - U6, a set of from-units to one target.
* ``convert_crosswalk(df, crosswalk)``     - U7, (from, to) pairs, list or DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yearloom.functions.unit_names import standardize_unit_names
from yearloom.operators.units.algebra import unit_factor_table
from yearloom.session import DEFAULT_BROADCAST_ROWS, broadcast_checked, local_frame, materialize, row_count_at_most

RenameFun = Callable[[Column], Column]


class UnitConversionError(ValueError):
    pass


def check_input(df: DataFrame, unit_col: str = "unit", value_col: str = "value") -> None:
    """Q7: the input is a DataFrame with a unit and a value column, unit is text."""
    if not isinstance(df, DataFrame):
        raise TypeError("convert_units expects a DataFrame")
    missing = [c for c in (unit_col, value_col) if c not in df.columns]
    if missing:
        raise UnitConversionError(f"missing columns: {missing}")
    if not isinstance(df.schema[unit_col].dataType, T.StringType):
        raise UnitConversionError(f"{unit_col} must be a string column")


def input_violations(df: DataFrame, unit_col: str = "unit", value_col: str = "value") -> DataFrame:
    """Q7 as rows (``problem, detail, n_rows``): a column that is missing or of the wrong type; and, where both are there, values
    without a unit, blank units, and values that are no numbers (NaN, infinite), counted by unit. One aggregate, no job."""
    spark = df.sparkSession
    schema = "problem string, detail string, n_rows long"
    types = {c: df.schema[c].dataType if c in df.columns else None for c in (unit_col, value_col)}
    shape = [("missing column", c, None) for c, t in types.items() if t is None]
    if types[unit_col] is not None and not isinstance(types[unit_col], T.StringType):
        shape.append(("unit is not text", unit_col, None))
    if types[value_col] is not None and not isinstance(types[value_col], T.NumericType):
        shape.append(("value is not a number", value_col, None))
    if shape:
        return local_frame(spark, shape, schema)
    unit, value = F.col(unit_col), F.col(value_col)
    bad = F.array_compact(F.array(
        F.when(unit.isNull() & value.isNotNull(), "value without a unit"), F.when(F.trim(unit) == "", "blank unit"),
        F.when(F.isnan(value.cast("double")) | (F.abs(value.cast("double")) == float("inf")), "value is not a number")))
    return df.select(F.explode(bad).alias("problem"), unit.alias("detail")).groupBy("problem", "detail").agg(F.count("*").alias("n_rows"))


def _fact_pairs(pairs: DataFrame, max_broadcast_rows: int) -> tuple[DataFrame, int | None]:
    """Distinct (from, to) pairs taken from a fact table: written once (one
    column-pruned, map-side combined pass over the facts) and counted up to the
    bound. Returns the table and a proven row bound (None when beyond it)."""
    p = materialize(pairs.distinct())
    return p, (max_broadcast_rows if row_count_at_most(p, max_broadcast_rows) else None)


def _factors(pairs: DataFrame, rename_fun: RenameFun, registry, on_inconvertible: str) -> DataFrame:
    """Factor table for small distinct pairs (already a literal or a written
    table). Inconvertible pairs raise - at once: the table is written here so the
    error surfaces when the conversion is built - or are dropped; then there is
    nothing to fail fast and the few rows are computed inside the broadcast."""
    ft = unit_factor_table(pairs, "from_unit", "to_unit", rename_fun, registry, cut_lineage=False)
    if on_inconvertible == "error":
        msg = F.concat(F.lit("cannot convert '"), F.coalesce("from_unit", F.lit("NA")), F.lit("' to '"),
                       F.coalesce("to_unit", F.lit("NA")), F.lit("' ("), F.coalesce("from_units_unit", F.lit("NA")),
                       F.lit(" -> "), F.coalesce("to_units_unit", F.lit("NA")), F.lit(")"))
        ft = ft.withColumn("factor", F.when(F.col("convertible"), F.col("factor")).otherwise(F.raise_error(msg).cast("double")))
    elif on_inconvertible == "keep":
        return ft.where("convertible").select("from_unit", "to_unit", "factor")
    else:
        raise ValueError("on_inconvertible must be 'error' or 'keep'")
    return materialize(ft.select("from_unit", "to_unit", "factor"))


def _apply(df: DataFrame, factors: DataFrame, keys: list[tuple[Column, str]], unit_col: str, value_col: str,
           max_broadcast_rows: int, factor_rows: int | None, salt_buckets: int = 0) -> DataFrame:
    """Join the factor table and rewrite unit/value; a row without a factor
    keeps its unit and value. The factor table is broadcast when its row count
    is known to be within the bound (it has at most as many rows as the distinct
    pairs); otherwise this is a shuffle join that AQE may re-plan, or with
    ``salt_buckets > 1`` a salted one: few units hold most rows."""
    f = factors.select(F.col("from_unit").alias("_cf"), F.col("to_unit").alias("_ct"), F.col("factor").alias("_cfac"))
    cols = df.columns
    if factor_rows is not None and factor_rows <= max_broadcast_rows:
        f = F.broadcast(f)
    elif salt_buckets > 1:
        df = df.withColumn("_salt", F.floor(F.rand(29) * salt_buckets).cast("int"))
        f = f.withColumn("_fsalt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
        keys = [*keys, (F.col("_salt"), "_fsalt")]
    cond = None
    for left, right in keys:
        c = left.eqNullSafe(F.col(right))
        cond = c if cond is None else cond & c
    j = df.join(f, cond, "left")
    has = F.col("_cfac").isNotNull()
    out = j.withColumn(value_col, F.when(has, F.col(value_col) * F.col("_cfac")).otherwise(F.col(value_col))) \
           .withColumn(unit_col, F.when(has, F.col("_ct")).otherwise(F.col(unit_col)))
    return out.select(*cols)


def convert_rowwise(df: DataFrame, to_unit: Column | str, *, unit_col: str = "unit", value_col: str = "value",
                    rename_fun: RenameFun = standardize_unit_names, registry=None,
                    on_inconvertible: str = "error", max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, salt_buckets: int = 0) -> DataFrame:
    """U4: each row's target is ``to_unit`` (a column); a missing target leaves the
    row untouched; an inconvertible pair raises (or, with ``keep``, passes). Runs a
    job over the facts: the distinct pairs are written once."""
    check_input(df, unit_col, value_col)
    to = F.col(to_unit) if isinstance(to_unit, str) else to_unit
    spec = df.withColumn("_to_unit", to)
    pairs = (spec.select(F.col(unit_col).alias("from_unit"), F.col("_to_unit").alias("to_unit"))
             .where(F.col("to_unit") != F.col("from_unit")))   # a missing side drops the pair
    pairs, n = _fact_pairs(pairs, max_broadcast_rows)
    factors = _factors(pairs, rename_fun, registry, on_inconvertible)
    out = _apply(spec, factors, [(F.col(unit_col), "_cf"), (F.col("_to_unit"), "_ct")], unit_col, value_col,
                 max_broadcast_rows, n, salt_buckets)
    return out.drop("_to_unit")


def convert_to_single(df: DataFrame, to_unit: str, *, unit_col: str = "unit", value_col: str = "value",
                      rename_fun: RenameFun = standardize_unit_names, registry=None,
                      max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, salt_buckets: int = 0) -> DataFrame:
    """Every unit convertible to ``to_unit`` is converted; others pass through.
    Runs a job over the facts: the distinct units are written once."""
    check_input(df, unit_col, value_col)
    pairs = (df.select(F.col(unit_col).alias("from_unit")).where(F.col("from_unit").isNotNull())
             .where(F.col("from_unit") != F.lit(to_unit)))
    pairs, n = _fact_pairs(pairs, max_broadcast_rows)
    factors = _factors(pairs.withColumn("to_unit", F.lit(to_unit)), rename_fun, registry, "keep")
    return _apply(df, factors, [(F.col(unit_col), "_cf")], unit_col, value_col, max_broadcast_rows, n, salt_buckets)


def crosswalk_violations(crosswalk: DataFrame, from_col: str = "from_unit", to_col: str = "to_unit") -> DataFrame:
    """Q2: from-units that map to more than one target (a missing target counts)."""
    return (crosswalk.select(F.col(from_col).alias("from_unit"), F.col(to_col).alias("to_unit")).distinct()
            .groupBy("from_unit").agg(F.count(F.lit(1)).alias("n_targets"),
                                      F.min("to_unit").alias("first_target"), F.max("to_unit").alias("last_target"))
            .where("n_targets > 1"))


def _list_violations(rows) -> list[tuple[str, list]]:
    targets: dict = {}
    for a, b in rows:
        targets.setdefault(a, set()).add(b)
    return [(a, sorted(t, key=lambda x: (x is None, x or ""))) for a, t in targets.items() if len(t) > 1]


def convert_crosswalk(df: DataFrame, crosswalk: DataFrame | Sequence[tuple[str, str | None]], *, unit_col: str = "unit",
                      value_col: str = "value", rename_fun: RenameFun = standardize_unit_names,
                      registry=None, strict: bool = True, on_inconvertible: str = "error",
                      max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, salt_buckets: int = 0, cut_lineage: bool = True) -> DataFrame:
    """Convert by a crosswalk of (from, to) pairs.

    ``strict`` keeps the reference rule that a from-unit with two targets - a
    missing target counts as one - is an error; ``strict=False`` first drops
    missing targets. Units not in the crosswalk pass through unchanged.

    A crosswalk given as a list is checked on the driver and needs no pass over
    the facts; a crosswalk DataFrame (possibly derived from the facts) is written
    once, counted and checked in one small aggregate; beyond the broadcast bound
    its factors are joined with a shuffle join instead. ``cut_lineage=False``
    skips writing the distinct pairs when the crosswalk already comes from a
    written (small) table."""
    check_input(df, unit_col, value_col)
    spark = df.sparkSession
    if isinstance(crosswalk, DataFrame):
        xw = crosswalk.select(F.col(crosswalk.columns[0]).alias("from_unit"), F.col(crosswalk.columns[1]).alias("to_unit"))
        if not strict:
            xw = xw.where(F.col("to_unit").isNotNull())
        xw = materialize(xw.distinct()) if cut_lineage else xw.distinct()
        # one small aggregate gives both the size bound and the Q2 verdict
        per_from = xw.groupBy("from_unit").agg(F.count(F.lit(1)).alias("n"))
        stats = per_from.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("pairs"),
                             F.count_if(F.col("n") > 1).alias("bad")).first()
        n = int(stats["pairs"])
        if n > max_broadcast_rows:
            n = None          # beyond the bound: the factor join stays a shuffle join
        bad = ([(r.from_unit, f"{r.n_targets} targets, {r.first_target} to {r.last_target}") for r in crosswalk_violations(xw).limit(20).collect()]
               if stats["bad"] else [])
    else:
        rows = sorted({(a, b) for a, b in crosswalk if strict or b is not None}, key=lambda r: (r[0] or "", r[1] or ""))
        bad = _list_violations(rows)
        xw, n = local_frame(spark, rows, "from_unit string, to_unit string"), len(rows)
    if bad:
        detail = "; ".join(f"{a} -> {t}" for a, t in bad)
        count = len(bad) if not isinstance(crosswalk, DataFrame) else stats["bad"]
        raise UnitConversionError(f"{count} source units have more than one target unit (a missing one counts): {detail}")
    pairs = xw.where(F.col("to_unit").isNotNull() & (F.col("to_unit") != F.col("from_unit")))
    factors = _factors(pairs, rename_fun, registry, on_inconvertible)
    return _apply(df, factors, [(F.col(unit_col), "_cf")], unit_col, value_col, max_broadcast_rows, n, salt_buckets)


def convert_from_set(df: DataFrame, from_units: Sequence[str], to_unit: str, **kw) -> DataFrame:
    """Each unit of ``from_units`` converts to the single ``to_unit``."""
    return convert_crosswalk(df, [(u, to_unit) for u in from_units], **kw)


def convert_units(df: DataFrame, to_unit=None, from_unit=None, crosswalk=None, **kw) -> DataFrame:
    """Dispatcher (U8) by parameter type: Column -> rowwise; str -> single target;
    str (or a list of one) + from_unit list -> set; lists of one length -> pairs;
    crosswalk -> crosswalk."""
    if crosswalk is not None:
        return convert_crosswalk(df, crosswalk, **kw)
    if from_unit is not None:
        from_unit = [from_unit] if isinstance(from_unit, str) else list(from_unit)
        if to_unit is None or isinstance(to_unit, Column):
            raise UnitConversionError("from_unit needs to_unit as a string or a list")
        if isinstance(to_unit, str) or len(to_unit) == 1:
            return convert_from_set(df, from_unit, to_unit if isinstance(to_unit, str) else to_unit[0], **kw)
        if len(from_unit) != len(to_unit):
            raise UnitConversionError("from_unit and to_unit must be of compatible size")
        return convert_crosswalk(df, list(zip(from_unit, to_unit)), **kw)
    if isinstance(to_unit, Column):
        return convert_rowwise(df, to_unit, **kw)
    if isinstance(to_unit, str):
        return convert_to_single(df, to_unit, **kw)
    raise UnitConversionError("to_unit must be a Column (rowwise), a string, or give a crosswalk")


def convert_value_columns(df: DataFrame, value_col: str, from_col: str, to_col: str, out_col: str = "to_value", *,
                          rename_fun: RenameFun = standardize_unit_names, registry: DataFrame | None = None,
                          max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Add ``out_col`` = value converted from ``from_col`` to ``to_col``.

    Same unit -> factor 1; an inconvertible or missing pair gives a missing value
    (no keep-original fallback)."""
    pairs = df.select(F.col(from_col).alias("from_unit"), F.col(to_col).alias("to_unit")).distinct()
    ft = materialize(unit_factor_table(pairs, rename_fun=rename_fun, registry=registry)
                     .select("from_unit", "to_unit", "factor"))
    f = broadcast_checked(ft.select(F.col("from_unit").alias("_cf"), F.col("to_unit").alias("_ct"),
                                    F.col("factor").alias("_cfac")), max_broadcast_rows)
    j = df.join(f, F.col(from_col).eqNullSafe(F.col("_cf")) & F.col(to_col).eqNullSafe(F.col("_ct")), "left")
    factor = F.when(F.col(from_col) == F.col(to_col), F.lit(1.0)).otherwise(F.col("_cfac"))
    return j.withColumn(out_col, F.col(value_col) * factor).drop("_cf", "_ct", "_cfac")


def pack_units(df: DataFrame, value_col: str = "value", unit_col: str = "unit", out_col: str = "quantity") -> DataFrame:
    """Value + unit -> one struct column (one path for single and mixed units)."""
    return df.withColumn(out_col, F.struct(F.col(value_col).alias("value"), F.col(unit_col).alias("unit"))) \
             .drop(value_col, unit_col)


def unpack_units(df: DataFrame, col: str = "quantity") -> DataFrame:
    """Struct column -> ``value`` and ``unit`` columns."""
    rest = [c for c in df.columns if c != col]
    return df.select(*rest, F.col(f"{col}.value").alias("value"), F.col(f"{col}.unit").alias("unit"))
