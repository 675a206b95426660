"""Aggregation, distinct and window-style operators.

Every aggregate here is a hash aggregate with a map-side partial step, so a hot
key (even one holding a third of all rows) is combined inside each input task
before the shuffle; nothing collects a group into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yearloom.session import DEFAULT_BROADCAST_ROWS, broadcast_checked, materialize

ROLLUP_KEYS = ("dataset", "scenario", "variable", "region", "unit", "year")


def _missing(c: Column, dtype) -> Column:
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def strict_sum(c: Column, dtype) -> Column:
    """Sum that is missing when any member is missing (R ``sum`` without ``na.rm``).

    NULL and NaN both count as missing. Composed of two native aggregates, so the
    partial/final split still applies."""
    return F.when(F.count_if(_missing(c, dtype)) == 0, F.sum(c))


def scaled_rollup(df: DataFrame, keys: Sequence[str] = ROLLUP_KEYS, value_col: str = "value",
                  factor_col: str = "factor", rename_dataset: bool = True) -> DataFrame:
    """A1: ``value * factor`` summed per key, one row per group; a group with a
    missing member is missing (T2). ``dataset`` becomes ``model``.

    Output columns: model, scenario, region, variable, year, unit, value (the
    reference's order) when the default keys are used."""
    scaled = (F.col(value_col) * F.col(factor_col)).alias("_v")
    tmp = df.select(*keys, scaled)
    dtype = tmp.schema["_v"].dataType
    out = tmp.groupBy(*keys).agg(strict_sum(F.col("_v"), dtype).alias(value_col))
    if rename_dataset and "dataset" in keys:
        out = out.withColumnRenamed("dataset", "model")
        order = [c for c in ("model", "scenario", "region", "variable", "year", "unit") if c in out.columns]
        out = out.select(*order, *[c for c in out.columns if c not in order and c != value_col], value_col)
    return out


def group_total_keep_rows(df: DataFrame, keys: Sequence[str], value_col: str = "value", out_col: str = "group_total",
                          *, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, salt_buckets: int = 0) -> DataFrame:
    """The group's (strict) total attached to every row. Runs a job: the totals
    are written once.

    Written as aggregate + join back instead of ``sum().over(partitionBy)``: the
    window would put a hot group into one task, while the aggregate combines it
    map-side. The totals are broadcast when they fit the bound; otherwise the join
    is a shuffle join whose skewed partitions AQE splits (the totals side has one
    row per key, so replicating it for a split is cheap). ``salt_buckets > 1``
    salts that join explicitly instead (see ``joins.salted_join``)."""
    keys = list(keys)
    dtype = df.schema[value_col].dataType
    totals = df.groupBy(*keys).agg(strict_sum(F.col(value_col), dtype).alias(out_col))
    totals = materialize(totals)
    t = totals.select(*[F.col(k).alias(f"__t_{k}") for k in keys], out_col)
    hinted = broadcast_checked(t, max_broadcast_rows)
    if hinted is t and salt_buckets > 1:
        from yearloom.operators.joins import salted_join

        out = salted_join(df, t, [(k, f"__t_{k}") for k in keys], "left", salt_buckets)
        return out.drop(*[f"__t_{k}" for k in keys])
    t = hinted
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"__t_{k}"))
        cond = c if cond is None else cond & c
    return df.join(t, cond, "left").drop(*[f"__t_{k}" for k in keys])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first whole row per key, ascending with missing order values last.

    A ``row_number() = 1`` filter: Spark keeps only each task's first row per key
    before the shuffle (window group limit), so a hot key never reaches one task
    whole. Works for any column type, maps included."""
    order_cols = [(F.col(o) if isinstance(o, str) else o).asc_nulls_last() for o in order]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_cols))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def key_batches(keys_df: DataFrame, key_col: str, batch_size: int = 100, *, partitions: int | None = None) -> DataFrame:
    """A5 + W2: distinct non-missing keys in ascending order, numbered 1..n, and cut
    into blocks of ``batch_size`` (``ceil(index / batch_size)``). Runs a job: the
    numbering is written once.

    A global ``row_number`` would run in one task. This is the two-pass
    zipWithIndex pattern in DataFrame form: range-partition the distinct keys,
    number rows inside each partition, count each partition (a table with one row
    per partition, bounded by ``partitions``), turn the counts into offsets, and
    add them back with a broadcast join."""
    spark = keys_df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct_keys = keys_df.select(F.col(key_col).alias("key")).where(F.col("key").isNotNull()).distinct()
    ranged = (distinct_keys.repartitionByRange(n, "key").sortWithinPartitions("key")
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = materialize(ranged)  # freeze the numbering against recomputation
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    offsets = broadcast_checked(offsets.select("_pid", "_first", "_offset"), known_rows=n)
    idx = (F.col("_offset") + (F.col("_mid") - F.col("_first")) + 1).cast("long")
    return (ranged.join(offsets, "_pid")
            .select(F.col("key").alias(key_col), idx.alias("key_index"),
                    F.ceil(idx / F.lit(batch_size)).cast("long").alias("batch")))


def duplicate_groups(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Groups of ``cols`` with more than one row, with their size."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
