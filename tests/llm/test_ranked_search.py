import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from yearloom.llm import ranked_search as R
from llm_fixtures import docs  # noqa: F401

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, items, top=50):
    """Sorted (item_id, rank, score, doc_id), scoring every document for every item."""
    own = [(i, Counter(terms(t))) for i, t in rows]
    own = [(i, c) for i, c in own if c]
    n, total = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in own:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in set(terms(text)) if t in c)
            if score > 0:
                found.append((-score, i is not None, i or 0, i))
        out += [(item, k + 1, -s, i) for k, (s, _, _, i) in enumerate(sorted(found)[:top])]
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.item_id, r["rank"], r.score, r.doc_id) for r in df.collect()), key=repr)


def corpus(rng, n):
    words = [f"w{k}" for k in range(300)] + ["É", "é", "ß", "日本", "X1"]
    common = ["the", "And", "of"]
    return [(k, " ".join(rng.choice(common) if rng.random() < .3 else words[int(len(words) * rng.random() ** 3)] for _ in range(rng.randrange(1, 80)))) for k in range(n)]


@pytest.fixture(scope="module")
def setting():
    rng = random.Random(4)
    rows = corpus(rng, 500)
    rows += [(1000 + k, rows[3][1]) for k in range(70)]  # copies: more ties than places
    items = [(k, " ".join(t for _, t in rng.sample(rows, 2))) for k in range(20)] + [(40, rows[3][1]), (41, "nowhere"), (42, None), (43, " ... "), (44, "the")]
    rng.shuffle(rows)
    return rows, items


@pytest.mark.parametrize("leaf", [1, 40, 1024])
@pytest.mark.parametrize("shard", [3000, R.SHARD_BYTES])
def test_ranks_equal_scoring_every_document(spark, docs, setting, monkeypatch, leaf, shard):
    monkeypatch.setattr(R, "LEAF_POSTINGS", leaf)
    monkeypatch.setattr(R.posting_lists, "__defaults__", (shard,))
    rows, items = setting
    table = spark.createDataFrame(items, "item_id long, text string")
    assert got(R.search(docs(*rows).repartition(3), table)) == brute(rows, items)


def test_blocks_of_items(spark, docs, setting):
    rows, items = setting
    table = spark.createDataFrame(items, "item_id long, text string")
    assert got(R.search(docs(*rows[:200]), table, top=7, max_block_terms=100)) == brute(rows[:200], items, 7)


def test_nulls_repeats_clashes_and_empty_tables(spark, docs):
    rows = [(None, "alpha beta"), (None, "alpha beta"), (7, "alpha beta"), (7, "alpha beta"), (7, "beta"), (8, None), (9, ""), (10, "!!"), (-3, "Alpha, BETA"), (11, "gamma")]
    items = [(1, "alpha"), (1, "beta gamma"), (None, "gamma"), (2, "alpha alpha")]
    df = docs(*rows).withColumn("item", F.lit("x")).withColumn("score", F.lit(0)).withColumn("rank", F.lit(0))
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(5)).withColumn("terms", F.lit(5))
    assert got(R.search(df, table)) == brute(rows, items)
    assert R.search(df.limit(0), table).count() == 0 and R.search(df, table.limit(0)).count() == 0


def test_very_long_text(spark, docs):
    rng = random.Random(9)
    rows = corpus(rng, 40) + [(99, " ".join(t for _, t in corpus(rng, 60_000))), (100, "the end")]
    items = [(0, rows[0][1] + " the"), (1, "w1 w2 X1")]
    assert len(rows[40][1]) > 4 * R.ta.BLOCK_BYTES
    assert got(R.search(docs(*rows), spark.createDataFrame(items, "item_id long, text string"))) == brute(rows, items)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 20), min_size=1, max_size=70), min_size=1, max_size=6), st.randoms())
def test_range_maxima(lists, rng):
    sizes = np.array([len(x) for x in lists])
    values = np.array([v for x in lists for v in x])
    starts = np.cumsum(sizes) - sizes
    table = R.RangeMaxima(values, starts, sizes)
    which = np.array([rng.randrange(len(lists)) for _ in range(40)])
    a = np.array([rng.randrange(int(sizes[w]) + 1) for w in which])
    b = np.array([rng.randrange(int(x), int(sizes[w]) + 1) for x, w in zip(a, which)])
    place = table.places(which, starts[which] + a, starts[which] + b)
    for w, x, y, p in zip(which, a, b, place):
        assert p == -1 if x == y else starts[w] + x <= p < starts[w] + y and values[p] == max(lists[w][x:y])


def test_search_prunes(setting):
    """A rare term beside a common one: most intervals are never looked at."""
    n = 4000
    figures = R.Collection(n, 10 * n, np.array([900, 5000]))
    shard = R.ShardBuilder()
    rare = np.arange(0, n, 40)
    shard.ids, shard.lengths, shard.rows = list(range(n)), [np.full(n, 10)], n
    shard.add(np.arange(n), np.zeros(n, np.int64))
    shard.add(rare, np.ones(len(rare), np.int64))
    whole = R.Shard(shard.row(), figures)
    for leaf, most in ((1, 150), (64, 150)):
        best = R.Best(50)
        old, R.LEAF_POSTINGS = R.LEAF_POSTINGS, leaf
        try:
            looked = R.search_shard(whole, np.array([0, 1]), best)
        finally:
            R.LEAF_POSTINGS = old
        assert sorted(best.id.tolist()) == rare[:50].tolist() and looked < n / 4


def test_length_figures_beyond_64_bits():
    lengths = np.array([1, 10**9, 3])
    assert R.length_figures(lengths, 10**12, 10**14).tolist() == [50 + 50 * n * 10**12 // 10**14 for n in lengths.tolist()]


def test_query_on_given_tables(spark):
    from yearloom.llm import queries
    sf = "/root/testdata/sf0.001"
    read = lambda t, c: [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(*c).collect()]
    assert got(queries.op13_ranked_search(spark, sf)) == brute(read("documents", ["doc_id", "text"]), read("benchmark", ["item_id", "text"]))
