"""Reshaping, ordering and set operations.

Pivots take an explicit value list so the output schema is fixed and no extra
job is needed to discover it; ``pivot_open`` reads the columns from the data, up to
a stated width. Sorting is for sinks only.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from yearloom.session import materialize


MAX_PIVOT_COLUMNS = 10_000
MAX_LIST_CELL = 1_000_000


class PivotError(ValueError):
    """A pivot that can't be laid out: too many columns, or cells with several values where one is expected."""


def pivot_wider(df: DataFrame, ids: Sequence[str], names_from: str = "year", values_from: str = "value",
                values: Sequence | None = None, agg: str = "max") -> DataFrame:
    """Long -> wide, one column per value of ``names_from`` (as text).

    With ``values`` the plan is one aggregate; rows of other names are left out.
    Without, the names are those of the data (``pivot_open``). Each cell must come
    from one row (check with ``quality.unique_rows`` first); ``agg`` only decides how
    a forbidden duplicate would collapse."""
    if values is None:
        return pivot_open(df, ids, names_from, values_from, on_duplicates=agg)
    fn = {"max": F.max, "min": F.min, "first": F.first, "sum": F.sum}[agg]
    return df.groupBy(*ids).pivot(names_from, list(values)).agg(fn(values_from))


def pivot_open(df: DataFrame, ids: Sequence[str], names_from: str = "year", values_from: str = "value", *, on_duplicates: str = "error",
               order_by: Sequence[str] = (), columns: Sequence[str] | None = None, max_columns: int = MAX_PIVOT_COLUMNS,
               max_list: int = MAX_LIST_CELL) -> DataFrame:
    """Long -> wide; the columns are ``columns`` (a name outside them is an error) or, without these, all names of the data in
    ascending order (a missing name is ``NA``).

    One pass over ``df``: its cells, one row per ids and name, are aggregated (map-side first) and written, and the cells with
    several values or names outside ``columns`` counted on the way; names and wide rows come from that table. A wide row is put together from a map of its own cells,
    so a task sends as many entries as it has cells, however wide the table. More than ``max_columns`` names are an error, which
    says how many there are; no more than that are read.

    ``on_duplicates`` says what becomes of a cell with several values (T11): ``error`` (raised before the wide rows are made),
    ``list`` (every cell an array, in the order of ``order_by``, else of the values, missing last; cells with more than ``max_list``
    values are an error, found by a count before any list is made), or an aggregate: ``sum`` (missing with a missing member),
    ``max``, ``min``, ``first`` (in the order of ``order_by``)."""
    from yearloom.operators.aggregate import strict_sum

    ids = list(ids)
    name = F.coalesce(F.col(names_from).cast("string"), F.lit("NA"))
    rows = df.withColumn("__name", name)
    value = F.col(values_from)
    order = F.struct(*[x for c in (order_by or [values_from]) for x in (F.col(c).isNull(), F.col(c))])
    keys = [*ids, "__name"]
    if on_duplicates == "list":
        most = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        if most > max_list:
            raise PivotError(f"a cell has {most} values, more than {max_list}")
        listed = F.transform(F.sort_array(F.collect_list(F.struct(order.alias("o"), value.alias("v")))), lambda x: x["v"])
        cell = listed
    elif on_duplicates == "first":
        cell = F.min_by(value, order)
    elif on_duplicates == "sum":
        cell = strict_sum(value, df.schema[values_from].dataType)
    else:
        cell = {"error": F.max, "max": F.max, "min": F.min}[on_duplicates](value)
    seen = Observation()
    outside = ~F.col("__name").isin(list(columns)) if columns is not None else F.lit(False)
    cells = materialize(rows.groupBy(*keys).agg(cell.alias("__cell"), F.count(F.lit(1)).alias("__n")).observe(
        seen, F.count_if(F.col("__n") > 1).alias("twice"), F.count_if(outside).alias("outside")))
    if on_duplicates == "error" and seen.get["twice"]:
        some = cells.where("__n > 1").drop("__cell").limit(5).collect()
        raise PivotError(f"{seen.get['twice']} cells have more than one value, e.g. " + "; ".join(str(r.asDict()) for r in some))
    if seen.get["outside"]:
        some = cells.where(outside).select("__name").distinct().limit(5).collect()
        raise PivotError(f"names outside the list ({seen.get['outside']} cells), e.g. {', '.join(r[0] for r in some)}")
    if columns is not None:
        found = list(columns)
    else:
        names = cells.select("__name").distinct()
        found = sorted(r[0] for r in names.limit(max_columns + 1).collect())
        if len(found) > max_columns:
            raise PivotError(f"{names.count()} columns, more than {max_columns}")
    clash = sorted(set(found) & set(ids))
    if clash:
        raise PivotError(f"names that are also id columns: {', '.join(clash)}")
    wide = cells.groupBy(*ids).agg(F.map_from_entries(F.collect_list(F.struct("__name", "__cell"))).alias("__m"))
    return wide.select(*ids, *[F.try_element_at("__m", F.lit(c)).alias(c) for c in found])


def pivot_longer(df: DataFrame, ids: Sequence[str], value_cols: Sequence[str] | None = None,
                 names_to: str = "year", values_to: str = "value") -> DataFrame:
    """Wide -> long. Missing cells stay as rows with a missing value."""
    value_cols = list(value_cols) if value_cols is not None else [c for c in df.columns if c not in ids]
    return df.unpivot(list(ids), value_cols, names_to, values_to)


def year_columns(df: DataFrame, pattern: str = r"^\d{4}$") -> list[str]:
    """O6-style column subset by regex (driver-side list work)."""
    return [c for c in df.columns if re.match(pattern, c)]


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Bind rows by name; columns missing in a frame are NULL; column
    order is first-frame-first."""
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def sort_nulls_last(df: DataFrame, cols: Sequence[str | Column], descending: bool = False) -> DataFrame:
    """O1 / O2: ascending (or descending) multi-key sort with missing values last."""
    exprs = []
    for c in cols:
        col = F.col(c) if isinstance(c, str) else c
        exprs.append(col.desc_nulls_last() if descending else col.asc_nulls_last())
    return df.orderBy(*exprs)


def sort_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """O3: sort by those of ``cols`` that exist."""
    return sort_nulls_last(df, [c for c in cols if c in df.columns])
