import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yearloom.llm import hnsw_dedup as H

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


def brute(rows, threshold=.93):
    vectors = [np.array(v, np.float64) if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v) and l is not None else None
               for _, v, l in rows]
    vectors = [None if v is None else np.array(np.array(v, np.float32), np.float64) for v in vectors]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    n = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            u, v = vectors[a], vectors[b]
            if u is not None and v is not None and rows[a][2] == rows[b][2] and len(u) == len(v):
                if (u.tobytes() == v.tobytes()) or u @ v / (np.linalg.norm(u) * np.linalg.norm(v)) >= threshold:
                    n[a] += 1
                    n[b] += 1
                    x, y = find(a), find(b)
                    label[max(x, y)] = min(x, y)
    least = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, n[k], least.get(find(k), i), i is not None and i == least.get(find(k), i)) for k, (i, _, _) in enumerate(rows)), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


def clustered(seed=0, groups=25, dim=16):
    rng = np.random.default_rng(seed)
    rows, k = [], 0
    for g in range(groups):
        base = rng.normal(size=dim)
        for _ in range(rng.integers(1, 14)):
            rows.append([k * 3 % 997, (base + rng.normal(size=dim) * rng.choice([.02, .15, .3])).astype(np.float32).tolist(), int(g % 3)])
            k += 1
    return [tuple(r) for r in rows]


@pytest.mark.parametrize("shard", [4096, 40])
def test_against_brute_force(spark, shard):
    rows = clustered()
    assert result(H.dedup(spark.createDataFrame(rows, SCHEMA), shard_vectors=shard)) == brute(rows)


def test_huge_and_tiny_vectors(spark):
    """Their squares are beyond a double's range; cosines are those of the same vectors scaled."""
    shapes = [[1.0, 1.0, 0.0], [1.0, 1.01, 0.0], [1.0, 0.0, 1.0], [0.0, 1.0, 1.2], [0.0, 1.0, 1.0]]
    plain = [(10 * g + k, v, g) for g in range(4) for k, v in enumerate(shapes)]
    scale = [1.0, 1e200, 1e-200, 1.5e308 / 1.2]
    wild = [(i, [c * scale[g] for c in v], g) for i, v, g in plain] + [(50, [5e-324, 5e-324, 0.0], 9), (51, [1e300, 1e300, 0.0], 9)]
    out = H.dedup(spark.createDataFrame(wild, "vec_id long, embedding array<double>, label int"))
    want = result(H.dedup(spark.createDataFrame(plain, "vec_id long, embedding array<double>, label int")))
    assert result(out) == sorted([*want, (50, 1, 50, True), (51, 1, 50, False)], key=repr) and sum(n for _, n, _, _ in want) > 0


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 0), (2, v, 0), (2, v, 0), (3, v, 1), (4, v, None), (5, None, 0), (6, [], 0), (7, [0.0, 0.0, 0.0], 0), (8, [1.0, None, 3.0], 0),
            (9, [1.0, float("nan"), 3.0], 0), (10, [float("inf"), 2.0, 3.0], 0), (11, [1.0, 2.0], 0), (12, [1.0, 2.0], 0), (None, v, 0), (None, [9.0, -1.0, 0.5], 0),
            (13, [2.0, 4.0, 6.0], 0), (14, [-1.0, -2.0, -3.0], 0), (15, [1e30, 2e30, 3e30], 0), (16, [1e-30, 2e-30, 3e-30], 0), (17, [0.0, 1.0, 0.0], 2), (18, [-0.0, 1.0, -0.0], 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(H.dedup(df)) == brute(rows)
    clash = df.withColumn("cid", F.lit(1)).withColumn("vector", F.lit(2)).withColumn("kept", F.lit(3)).withColumn("n", F.lit(4))
    out = H.dedup(clash)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"] and out.count() == len(rows)
    assert H.dedup(df.limit(0)).count() == 0


def test_many_copies_and_a_dense_group(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=16)
    rows = [(k, base.astype(np.float32).tolist(), 1) for k in range(50, 150)]
    rows += [(k, (base + rng.normal(size=16) * .05).astype(np.float32).tolist(), 1) for k in range(200, 350)]
    rows += [(k, rng.normal(size=16).astype(np.float32).tolist(), 1) for k in range(400, 500)]
    assert result(H.dedup(spark.createDataFrame(rows, SCHEMA), shard_vectors=90)) == brute(rows)


@pytest.mark.parametrize("dim", [8, 48])
def test_graph_recall(dim):
    rng = np.random.default_rng(dim)
    base = rng.normal(size=(300, dim))
    x = np.concatenate([base, base[:200] + rng.normal(size=(200, dim)) * .1, base[:1] + rng.normal(size=(400, dim)) * .05, rng.normal(size=(600, dim))])
    rng.shuffle(x)
    units = H._units(x)
    graph = H.build(units)
    assert len(graph.layers) > 1 and (graph.layers[0] >= 0).any(1).all()
    true = units @ units.T >= .93
    found = np.zeros_like(true)
    for first, sims in H.audited_search(graph, units, .93):
        found[first:first + len(sims)] = sims >= .93
    assert not (found & ~true).any() and (found & true).sum() >= .99 * true.sum()


def test_beam_widens_until_the_audit_passes(monkeypatch):
    rng = np.random.default_rng(1)
    x = H._units(np.concatenate([rng.normal(size=(500, 8)), rng.normal(size=(1, 8)) + rng.normal(size=(60, 8)) * .05]))
    graph = H.build(x)
    graph.layers[0][:] = -1  # nothing can be reached: only the widest beam finds the pairs
    widths = []
    search = H.search
    monkeypatch.setattr(H, "search", lambda g, q, t, w: widths.append(w) or search(g, q, t, w))
    true = x @ x.T >= .93
    for first, sims in H.audited_search(graph, x, .93):
        assert ((sims >= .93) == true[first:first + len(sims)]).all()
    assert max(widths) >= len(x)


@pytest.mark.parametrize("own", [True, False])
def test_sparse_pairs_beside_a_dense_group(own):
    rng = np.random.default_rng(3)
    dense, pairs = rng.normal(size=(1, 16)) + rng.normal(size=(400, 16)) * .05, rng.normal(size=(100, 16))
    x = H._units(np.concatenate([dense, pairs, pairs + rng.normal(size=pairs.shape) * .05]))
    graph = H.build(x)
    for links in graph.layers:  # the pairs can't be reached
        links[links >= len(dense)] = -1
    true = x @ x.T >= .93
    assert true[:400].sum() > 100 * true[400:].sum()
    for first, sims in H.audited_search(graph, x, .93, *[np.arange(len(x))] * own):
        assert ((sims >= .93) == true[first:first + len(sims)])[max(0, 400 - first):].all()


def test_audit_takes_queries_with_few_finds_and_none_by_itself():
    finds = np.array([300] * 400 + [0] * 100)
    got = H.audited(finds, np.where(finds > 0, .99, .5), 128)
    assert (got >= 400).sum() == 100 and (got < 400).sum() >= 128


def test_one_vector_shards():
    graph = H.build(H._units(np.array([[1.0, 0.0]])))
    (first, sims), = H.audited_search(graph, graph.units, .93)
    assert first == 0 and sims.shape == (1, 1) and sims[0, 0] >= .99
