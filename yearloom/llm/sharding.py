"""Shard placement by a permutation-filled lookup table.

Every shard has its own permutation of the slots of a prime-sized table, drawn
from a hash of its name. Shards take turns: on its turn a shard claims the first
slot of its permutation that is still free (a shard of weight w takes w turns a
round), until the table is full. A row's key is hashed to a slot and the slot
names the shard, so placement is one broadcast lookup, every shard gets nearly
its weight's share of the slots, and a change of the shard list moves few slots.

Defined results: a null key hashes like the text ``\\N``, equal keys always share
a shard, an empty table gives no rows, and other columns pass through (a column
that has the name of an added one is replaced).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_SIZE = 65_537  # prime; also the proven row bound of the broadcast


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def _digest(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big")


def fill_table(shards: dict[str, int] | list[str], size: int = TABLE_SIZE) -> list[int]:
    """Slot -> index of its shard in ``shards`` (names, or name -> whole weight)."""
    weights = dict.fromkeys(shards, 1) if not isinstance(shards, dict) else shards
    if not weights or any(w < 1 or w != int(w) for w in weights.values()):
        raise ValueError("shards: at least one name, and whole weights of 1 or more")
    if not _is_prime(size) or size < sum(weights.values()):
        raise ValueError("size must be a prime no smaller than the sum of the weights")
    start = [_digest(n, "offset") % size for n in weights]
    step = [_digest(n, "skip") % (size - 1) + 1 for n in weights]
    turn = [0] * len(weights)
    table = [-1] * size
    free = size
    while free:
        for k, weight in enumerate(weights.values()):
            for _ in range(min(weight, free)):
                slot = (start[k] + turn[k] * step[k]) % size
                while table[slot] >= 0:
                    turn[k] += 1
                    slot = (start[k] + turn[k] * step[k]) % size
                table[slot] = k
                turn[k] += 1
                free -= 1
    return table


def table_frame(spark: SparkSession, shards: dict[str, int] | list[str], size: int = TABLE_SIZE) -> DataFrame:
    """The filled table as rows (slot, shard); exactly ``size`` rows."""
    names = list(shards)
    filled = fill_table(shards, size)
    slots = ",".join(map(str, filled))
    labels = F.array(*[F.lit(n) for n in names])
    one = spark.range(1, numPartitions=1).select(F.split(F.lit(slots), ",").alias("t"))
    return one.select(F.posexplode("t").alias("slot", "k")).select(
        F.col("slot").cast("int").alias("slot"), F.element_at(labels, F.col("k").cast("int") + 1).alias("shard"))


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.lit("\\N"))), F.lit(size)).cast("int")


def place(df: DataFrame, key: str, shards: dict[str, int] | list[str], size: int = TABLE_SIZE) -> DataFrame:
    """``df`` with ``slot`` (int) and ``shard`` (string). No shuffle: one broadcast
    join with the table, whose row count is ``size``."""
    slot = slot_of(df[key], size)
    rest = [df[c] for c in dict.fromkeys(df.columns) if c.lower() not in ("slot", "shard")]
    placed = df.select(*rest, slot.alias("slot"))
    return placed.join(F.broadcast(table_frame(df.sparkSession, shards, size)), "slot").select(
        *[c for c in placed.columns if c != "slot"], "slot", "shard")


def moved_slots(before: dict[str, int] | list[str], after: dict[str, int] | list[str], size: int = TABLE_SIZE) -> int:
    """How many slots change their shard when the shard list changes."""
    a, b = list(before), list(after)
    return sum(a[x] != b[y] for x, y in zip(fill_table(before, size), fill_table(after, size)))


def write_shards(df: DataFrame, path: str, spread: int = 8) -> None:
    """Write placed rows as one folder per shard. A shard's rows are spread over
    ``spread`` tasks, so a shard of any size is never one task's work."""
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(spread))
    df.repartition(F.col("shard"), salt).write.partitionBy("shard").parquet(path)
