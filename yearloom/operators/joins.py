"""Joins (J1-J11).

Every join against a dimension is a broadcast hash join behind a size check
(``broadcast_checked``), with missing keys matching each other where the
reference does (``eqNullSafe``). A full outer join of a fact table with a
dimension is rewritten so the fact side is never shuffled (see
``full_outer_with_dim``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.session import DEFAULT_BROADCAST_ROWS, broadcast_checked, materialize, row_count_at_most


SIDE_ONLY = ("left_semi", "semi", "leftsemi", "left_anti", "anti", "leftanti")  # joins that return left columns only


def salted_join(fact: DataFrame, dim: DataFrame, cond_keys: Sequence[tuple[str, str]], how: str,
                buckets: int, seed: int = 17) -> DataFrame:
    """Shuffle join that spreads every key of ``fact`` over ``buckets`` tasks:
    each fact row gets a random salt, each ``dim`` row is replicated once per salt,
    and the join is on (keys, salt). For a dimension-like side with one row (or
    few) per key, a key holding a third of the fact rows is split ``buckets`` ways
    without relying on AQE. Any salt assignment gives the same result, so a
    recomputed task may draw different salts."""
    f = fact.withColumn("__salt", F.floor(F.rand(seed) * buckets).cast("int"))
    d = dim.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    cond = f["__salt"] == d["__salt"]
    for fk, dk in cond_keys:
        cond = cond & f[fk].eqNullSafe(d[dk])
    out = f.join(d, cond, how).drop(f["__salt"])
    return out if how in SIDE_ONLY else out.drop(d["__salt"])


def join_dim(fact: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "inner", *, null_safe: bool = True,
             max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, dim_rows: int | None = None,
             salt_buckets: int = 0) -> DataFrame:
    """Fact x dimension join (J1' inner, J2' left, J4-J8 left, J3 semi) with the
    dimension broadcast when its size is proven small.

    Beyond the bound it is a shuffle join (AQE splits skewed partitions); with
    ``salt_buckets > 1`` it is a salted join instead (``salted_join``; missing keys
    are spread as well) for inner, left, semi and anti joins. Key columns appear once in the output (from the fact side)."""
    keys = list(keys)
    d = broadcast_checked(dim, max_broadcast_rows, known_rows=dim_rows)
    if salt_buckets > 1 and d is dim and how in ("inner", "left", "left_outer", "leftouter", *SIDE_ONLY):
        dr = dim.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[c for c in dim.columns if c not in keys])
        out = salted_join(fact, dr, [(k, f"__k_{k}") for k in keys], how, salt_buckets)
        return out if how in SIDE_ONLY else out.drop(*[f"__k_{k}" for k in keys])
    if not null_safe:
        return fact.join(d, keys, how)
    dr = d.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[c for c in dim.columns if c not in keys])
    cond = None
    for k in keys:
        c = fact[k].eqNullSafe(dr[f"__k_{k}"])
        cond = c if cond is None else cond & c
    out = fact.join(dr, cond, how)
    if how in SIDE_ONLY:
        return out
    return out.drop(*[f"__k_{k}" for k in keys])


def semi_join(left: DataFrame, right: DataFrame, keys: Sequence[str], *, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
              salt_buckets: int = 0) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right`` (missing keys match)."""
    return join_dim(left, right.select(*keys).distinct(), keys, "left_semi", max_broadcast_rows=max_broadcast_rows,
                    salt_buckets=salt_buckets)


def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str], *, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
              salt_buckets: int = 0) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right`` (missing keys match)."""
    return join_dim(left, right.select(*keys).distinct(), keys, "left_anti", max_broadcast_rows=max_broadcast_rows,
                    salt_buckets=salt_buckets)


def marked_numbers(df: DataFrame, number_col: str) -> DataFrame:
    """The distinct numbers (0 and up) in a column, as ``number_col``, through one 64-bit word for each 64 numbers: a hash aggregate
    whose tasks send no more words than the numbers' range holds, however many rows they have. (Spark's own bitmap aggregate
    can't be hashed and would sort every task's rows.)"""
    n = F.col(number_col)
    bit = F.expr(f"shiftleft(cast(1 as bigint), cast(`{number_col}` % 64 as int))")
    words = df.where(n.isNotNull()).groupBy(F.expr(f"`{number_col}` div 64").alias("__word")).agg(F.bit_or(bit).alias("__bits"))
    each = words.withColumn("__at", F.explode(F.sequence(F.lit(0), F.lit(63))))
    return each.where(F.getbit("__bits", F.col("__at")) == 1).select((F.col("__word") * 64 + F.col("__at")).alias(number_col))


def full_outer_with_dim(fact: DataFrame, dim: DataFrame, keys: Sequence[str], *,
                        max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, dim_rows: int | None = None,
                        salt_buckets: int = 0) -> DataFrame:
    """J1 / J2 faithful full outer join of a large fact table with a small dimension.

    Spark ignores a broadcast hint on FULL OUTER and would shuffle the whole fact
    table. Same result, no fact shuffle, one pass over the facts. Runs jobs: the
    numbered dimension and the joined rows are written once.

    1. the dimension's rows get numbers
    2. fact LEFT JOIN broadcast(dim), the number carried along and written
       (map-side; the only pass over the fact)
    3. the numbers that occur, from the written number column alone, as words of
       bits (``marked_numbers``); the other dimension rows are those without a match
    4. union by name; columns missing on a side are NULL.
    Missing keys match each other (the reference's join semantics). Beyond the
    bound step 2 is a shuffle join, salted with ``salt_buckets > 1``.
    """
    keys = list(keys)
    if dim_rows is None:
        dim_rows = max_broadcast_rows if row_count_at_most(dim, max_broadcast_rows) else max_broadcast_rows + 1
    numbered = materialize(dim.withColumn("__n", F.monotonically_increasing_id()))
    joined = materialize(join_dim(fact, numbered, keys, "left", max_broadcast_rows=max_broadcast_rows, dim_rows=dim_rows,
                                  salt_buckets=salt_buckets))
    dim_only = join_dim(numbered, marked_numbers(joined.select("__n"), "__n"), ["__n"], "left_anti",
                        max_broadcast_rows=max_broadcast_rows, dim_rows=dim_rows)
    return joined.drop("__n").unionByName(dim_only.drop("__n"), allowMissingColumns=True)


def full_outer_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Literal full outer join with null-safe keys (for two sides of similar size,
    and for the equivalence tests of the rewrite). Shuffles both sides."""
    keys = list(keys)
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = c if cond is None else cond & c
    j = left.join(r, cond, "full")
    return j.select(*[F.coalesce(left[k], r[f"__r_{k}"]).alias(k) for k in keys],
                    *[left[c] for c in left.columns if c not in keys],
                    *[r[c] for c in right.columns if c not in keys])


def expand_literal_grid(df: DataFrame, grid: Sequence[dict]) -> DataFrame:
    """Every row of ``df`` times a fixed parameter grid.

    The grid is a driver-side list of parameter rows (bounded by construction),
    so the product is a ``Generate`` over a literal array - no join, no shuffle,
    output linear in ``df``."""
    if not grid:
        return df.limit(0)
    names = list(grid[0].keys())
    arr = F.array(*[F.struct(*[F.lit(g[n]).alias(n) for n in names]) for g in grid])
    return df.withColumn("__g", F.explode(arr)).select(*df.columns, *[F.col(f"__g.{n}").alias(n) for n in names])


def parameter_grid(**lists) -> list[dict]:
    """J9 ``expand_grid``: cartesian product of parameter lists, first varies slowest."""
    rows = [dict()]
    for name, values in lists.items():
        rows = [{**r, name: v} for r in rows for v in values]
    return rows


def cross_with_bounded(df: DataFrame, small: DataFrame, *, max_rows: int = 10_000) -> DataFrame:
    """Distinct rows of ``df`` x distinct rows of ``small`` (``tidyr::expand``).
    ``small`` is broadcast when it holds at most ``max_rows`` rows; beyond, the
    product is planned without a hint, with the same rows."""
    return df.distinct().crossJoin(broadcast_checked(small.distinct(), max_rows))
