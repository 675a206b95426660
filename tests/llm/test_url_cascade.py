import random

import pytest
from pyspark.sql import functions as F

from yearloom.llm import url_cascade as U

ALLOW = [("org", "/"), ("com", "/fr/")]
BLOCK = [("example.org", "/es/"), ("example.org", "/en/1"), ("com", "/de/")]


def brute(url, listed=()):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = rest
        for c in "/?#":
            host = host.split(c)[0]
        path = rest[len(host):]
        for c in "?#":
            path = path.split(c)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for rules, v in ((ALLOW, "allow"), (BLOCK, "block")) for h, p in rules
            if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[2], max(fits)[3]
    return host, path, None, "block" if host in listed else "allow"


URLS = [None, "", "no scheme", "http://", "http:///path", "HTTP://EXAMPLE.ORG/es/x", "http://example.org/en/12?x", "http://a.b.example.org/en/1",
        "http://notexample.org/es/", "http://x.org", "http://x.org?/es/", "http://x.com/fr/1#a", "http://x.com/de/", "http://com/de/", "http://x.com/d",
        "http://net/", "ftp://a.net/x?y://z.org/", "http://É.net/", "http://x.org/\n", "http://x..org/es/", "http://example.org/ES/"]


def test_rules_and_list(spark):
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(URLS + URLS[:4])], "page_id long, url string, host string, Rule string")
    listed = spark.createDataFrame([("net",), ("a.net",), ("never.seen",), (None,)], "key string")
    rows = {r.page_id: r for r in U.judge(pages, "url", ALLOW, BLOCK, listed).collect()}
    assert len(rows) == len(URLS) + 4
    for i, u in enumerate(URLS + URLS[:4]):
        assert (rows[i].host, rows[i].path, rows[i].rule, rows[i].verdict) == brute(u, {"net", "a.net"}), u


def test_beyond_the_bound_joins(spark):
    pages = spark.createDataFrame([(i, f"http://h{i}.net/") for i in range(40)], "page_id long, url string")
    listed = spark.createDataFrame([(f"h{i}.net",) for i in range(0, 40, 3)], "key string")
    assert U.build_cascade(listed, pages.select(F.concat(F.lit("h"), F.col("page_id"), F.lit(".net")).alias("key")), max_bytes=10) is None
    rows = U.judge(pages, "url", [], [], listed, max_bytes=10).collect()
    assert all((r.verdict == "block") == (r.page_id % 3 == 0) for r in rows) and len(rows) == 40


def test_empty_table_and_empty_lists(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    keys = spark.createDataFrame([], "key string")
    assert U.judge(none, "url", ALLOW, BLOCK, keys).count() == 0
    one = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert U.judge(one, "url", [], [], keys).first().verdict == "allow"


@pytest.mark.parametrize("bits", [3])
def test_cascade_is_exact_over_its_universe(spark, monkeypatch, bits):
    monkeypatch.setattr(U, "BITS_PER_KEY", bits)
    monkeypatch.setattr(U, "BUCKET_BITS", 64)  # few bits, so several levels are needed
    monkeypatch.setattr(U, "_encode", small_encode)
    rng = random.Random(bits)
    keys = [f"key {i}" for i in range(3000)]
    listed = set(rng.sample(keys, 400))
    universe = spark.createDataFrame([(k,) for k in keys] + [(keys[0],), (None,)], "key string")
    cascade = U.build_cascade(spark.createDataFrame([(k,) for k in [*listed, "not in the universe"]], "key string"), universe)
    assert len(cascade.levels) > 1
    rows = universe.where("key is not null").select("key", cascade.contains(F.col("key")).alias("x")).collect()
    assert all(r.x == (r.key in listed) for r in rows)
    assert not spark.range(1).select(cascade.contains(F.lit(None).cast("string")).alias("x")).first().x


def small_encode(keys, level, n):
    """Bits set by hand from the positions, for tiny filters."""
    buckets = max(1, -(-n * U.BITS_PER_KEY // 64))
    data = bytearray(buckets * 8)
    for r in keys.select(F.explode(F.array(*U._positions(F.col("key"), level, buckets * 64))).alias("p")).distinct().collect():
        data[r.p // 8] |= 1 << r.p % 8
    return U.Level(level, buckets * 64, bytes(data))


def test_encode_matches_positions(spark):
    keys = spark.createDataFrame([(f"k{i}",) for i in range(500)], "key string")
    level = U._encode(keys, 1, 50_000)
    want = {r.p for r in keys.select(F.explode(F.array(*U._positions(F.col("key"), 1, level.bits))).alias("p")).collect()}
    assert {i for i in range(level.bits) if level.data[i // 8] >> i % 8 & 1} == want and level.bits > U.BUCKET_BITS
    assert keys.where(~level.test(F.col("key"))).count() == 0


def test_no_python_and_no_join_in_the_plan(spark):
    from yearloom.llm import queries
    plan = queries.op8_url_filters(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan and "Arrow" not in plan
