"""URL filters by a cascade of Bloom filters (DataFrame functions only).

A cascade answers exactly whether a key is listed, for every key of a known
universe (here: all keys the corpus can ask about). Level 1 encodes the listed
keys; level 2 encodes the universe's keys that level 1 wrongly accepts; level 3
the listed keys that level 2 wrongly accepts; and so on until a level has no
false positive. The filters travel as binary literals inside the expression, so
judging a URL needs no join.

Rules are (host, path) pairs. A URL can ask for ``suffix of its host + prefix of
its path``, one key for every label boundary and every path length that some rule
has; the longest listed key is the rule that wins (of two equally long, the one
with the longer host).

Defined results: a null URL, or one without ``://``, has an empty host and path and
fits no rule; repeated URLs are judged row by row; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearloom.session import local_frame, materialize

BUCKET_BITS = 32_768  # bits of one bitmap_construct_agg bitmap
BITS_PER_KEY = 10
PROBES = 4
MAX_FILTER_BYTES = 16 << 20  # largest filter carried as a literal
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _positions(key: Column, level: int, bits: int) -> list[Column]:
    first = F.pmod(F.xxhash64(F.lit(2 * level), key), F.lit(bits))
    step = F.pmod(F.xxhash64(F.lit(2 * level + 1), key), F.lit(bits))
    return [F.pmod(first + F.lit(j) * step, F.lit(bits)) for j in range(PROBES)]


class Level:
    """One Bloom filter: its number, its size in bits and its bytes."""

    def __init__(self, number: int, bits: int, data: bytes):
        self.number, self.bits, self.data = number, bits, data

    def test(self, key: Column) -> Column:
        data = F.lit(self.data)
        hit = None
        for p in _positions(key, self.number, self.bits):
            byte = F.conv(F.hex(F.substring(data, (F.floor(p / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
            bit = F.getbit(byte, (p % 8).cast("int")) == 1
            hit = bit if hit is None else hit & bit
        return hit


def _encode(keys: DataFrame, level: int, n: int) -> Level:
    buckets = max(1, -(-n * BITS_PER_KEY // BUCKET_BITS))
    bits = buckets * BUCKET_BITS
    at = keys.select(F.explode(F.array(*_positions(F.col("key"), level, bits))).alias("p"))
    rows = (at.select(F.floor(F.col("p") / BUCKET_BITS).cast("int").alias("bucket"), (F.col("p") % BUCKET_BITS).alias("bit"))
            .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap")).collect())  # bits / 8 bytes, checked by the caller
    data = bytearray(bits // 8)
    for r in rows:
        data[r["bucket"] * BUCKET_BITS // 8:(r["bucket"] + 1) * BUCKET_BITS // 8] = r["bitmap"]
    return Level(level, bits, bytes(data))


class Cascade:
    """Exact membership for the keys of a universe, as one expression."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    @property
    def bytes(self) -> int:
        return sum(len(x.data) for x in self.levels)

    def contains(self, key: Column) -> Column:
        answer = F.lit(len(self.levels) % 2 == 1)
        for x in reversed(self.levels):
            answer = F.when(x.test(key), answer).otherwise(F.lit(x.number % 2 == 0))
        return F.when(key.isNull(), F.lit(False)).otherwise(answer) if self.levels else F.lit(False)


def build_cascade(listed: DataFrame, universe: DataFrame, max_bytes: int = MAX_FILTER_BYTES) -> Cascade | None:
    """A cascade over the distinct non-null keys (column ``key``) of ``universe``.
    Runs a few jobs over distinct keys. None if a level would pass ``max_bytes``:
    the caller then joins."""
    keys = materialize(universe.select("key").where("key is not null").distinct())
    inside = materialize(listed.select("key").where("key is not null").distinct().join(keys, "key", "left_semi"))
    outside = keys.join(inside, "key", "left_anti")
    levels: list[Level] = []
    sides = [inside, outside]  # of the next level: keys to encode, keys it must not accept
    n = inside.count()
    while n:
        if n * BITS_PER_KEY > 8 * max_bytes:
            return None
        level = _encode(sides[0], len(levels) + 1, n)
        levels.append(level)
        wrong = materialize(sides[1].where(level.test(F.col("key"))))
        sides = [wrong, sides[0]]
        n = wrong.count()
    return Cascade(levels)


def rule_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """All keys that a URL can ask for, longest first."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    keys = F.flatten(F.transform(suffixes, lambda s: F.filter(
        F.array(*[F.when(F.length(path) >= n, F.struct((F.length(s) + n).alias("size"), F.length(s).alias("of_host"),
                                                       F.concat(s, F.substring(path, 1, n)).alias("key"))) for n in lengths]),
        lambda x: x.isNotNull())))
    ordered = F.reverse(F.array_sort(keys))
    return F.transform(F.when(host != "", ordered).otherwise(F.slice(ordered, 1, 0)), lambda x: x["key"])


def judge(pages: DataFrame, url: str, allow: list[tuple[str, str]], block: list[tuple[str, str]], blocked_hosts: DataFrame,
          max_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """``pages`` with host, path, rule (null where none fits) and verdict. Without a
    rule the verdict is ``block`` for the hosts in ``blocked_hosts`` (column ``key``),
    else ``allow``. Runs the jobs that build the cascades; input columns with the
    name of an added one are replaced."""
    spark = pages.sparkSession
    added = ("host", "path", "rule", "verdict")
    host, path = host_and_path(pages[url])
    rest = [pages[c] for c in dict.fromkeys(pages.columns) if c.lower() not in added]
    asked = pages.select(*rest, host.alias("host"), path.alias("path"))
    lengths = sorted({len(p) for _, p in [*allow, *block]}, reverse=True)
    keys = rule_keys(F.col("host"), F.col("path"), lengths) if lengths else F.array().cast("array<string>")

    universe = asked.select("host", "path").distinct().select(F.explode(keys).alias("key"))
    listed = {"allow": allow, "block": block}
    rows = {k: local_frame(spark, [(h + p,) for h, p in v], "key string") if v else spark.range(0).select(F.lit("").alias("key"))
            for k, v in listed.items()}
    cascades = {k: build_cascade(v, universe, max_bytes) for k, v in rows.items()}
    hosts = build_cascade(blocked_hosts, asked.select(F.col("host").alias("key")), max_bytes)
    if None in cascades.values():
        raise ValueError("the rule list passes max_bytes; raise it or pass the rules as blocked_hosts")

    found = F.transform(F.col("_keys"), lambda k: F.when(cascades["block"].contains(k), F.struct(k.alias("key"), F.lit("block").alias("verdict")))
                        .when(cascades["allow"].contains(k), F.struct(k.alias("key"), F.lit("allow").alias("verdict"))))
    first = F.get(F.filter(found, lambda x: x.isNotNull()), 0)
    if hosts is None:  # beyond the bound: one join with the list instead
        marked = asked.join(blocked_hosts.select(F.col("key").alias("host")).distinct().withColumn("_listed", F.lit(True)), "host", "left")
        unruled = F.coalesce(F.col("_listed"), F.lit(False))
    else:
        marked, unruled = asked, hosts.contains(F.col("host"))
    named = marked.withColumn("_keys", keys).withColumn("_first", first)
    return named.select(*[c for c in asked.columns], F.col("_first")["key"].alias("rule"),
                        F.coalesce(F.col("_first")["verdict"], F.when(unruled, "block").otherwise("allow")).alias("verdict"))
