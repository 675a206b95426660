"""Near duplicates among embeddings by sharded small-world graphs.

Vectors of one label (and length) are compared with each other only. Equal vectors form a
class; distinct ones are dealt to shards of about ``SHARD_VECTORS``, and every shard builds a
hierarchical navigable small-world graph, written to the checkpoint folder. Each shard's
vectors, as a block of queries, then search every shard of their label: greedily down the
layers, by a beam in the lowest one, and on from every vector within ``SLACK`` of the
threshold to its neighbours, so all of a dense group is reached. Each search is audited: for
samples of the queries with many finds and of those with few, half of each those with the most
similar finds, it is held against all of the shard; if it found less than ``RECALL`` of any
query's pairs with others, the beam doubles and the search is repeated, at the widest over the
whole shard. Found pairs are verified by cosine in double precision; links give
components.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component, or
whose label is null, link with nothing; rows that repeat (also their ids) are vectors of their
own; a null id passes through and is never kept; an empty table gives no rows; other columns
are ignored. Classes are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.llm import textarrays as ta
from yearloom.llm.components import connected_components, forest
from yearloom.session import materialize, row_count_at_most

THRESHOLD = 0.93
SHARD_VECTORS = 4096
LINKS = 16  # of a node in the upper layers, twice as many in the lowest
BUILD_BEAM = 64
BEAM = 48
AT_ONCE = 512  # queries
EXPAND = 4  # beam entries expanded at a time
SLACK = 0.02
RECALL = 0.99
AUDITED = 256  # queries of each search with more than LINKS finds, and as many of the others
ROUNDING = 1e-4  # of similarities in single precision
MAX_BROADCAST_ROWS = 100_000


class Graph:
    """Layers of neighbour lists (-1: none) over unit vectors; layer 0 holds all."""

    def __init__(self, units: np.ndarray, layers: list[np.ndarray], entry: int):
        self.units, self.layers, self.entry = units, layers, entry


def beam(units: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int, sims: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best ``width`` nodes for each query, from its entries; ``sims`` [query, node] (-2: not seen) is filled on the way."""
    n = len(queries)
    rows = np.arange(n)
    first = np.einsum("qd,qed->qe", queries, units[entry])
    sims[rows[:, None], entry] = first
    ids = np.full((n, width), -1)
    best = np.full((n, width), -2.0, np.float32)
    k = min(width, entry.shape[1])
    order = np.argsort(-first, axis=1)[:, :k]
    ids[:, :k], best[:, :k] = np.take_along_axis(entry, order, 1), np.take_along_axis(first, order, 1)
    for r in range(1, k):  # an entry named twice counts once
        same = (ids[:, :r] == ids[:, r:r + 1]).any(1)
        best[same, r], ids[same, r] = -2, -1
    done = ids < 0
    live = rows
    while len(live):
        score = np.where(done[live], np.float32(-3), best[live])
        pick = np.argpartition(-score, min(EXPAND, width) - 1, axis=1)[:, :EXPAND]
        open_ = np.take_along_axis(score, pick, 1) > -2
        go = open_.any(1)
        live, pick, open_ = live[go], pick[go], open_[go]
        if not len(live):
            break
        at = np.where(open_, ids[live[:, None], pick], -1)
        done[live[:, None], pick] = True
        near = np.where(at[:, :, None] >= 0, links[at], -1).reshape(len(live), -1)
        near = np.sort(near, axis=1)
        fresh = near >= 0
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        fresh &= sims[live[:, None], near] <= -2
        near = np.where(fresh, near, -1)
        value = np.where(fresh, np.einsum("qd,qkd->qk", queries[live], units[near]), np.float32(-2))
        q, c = np.nonzero(fresh)
        sims[live[q], near[q, c]] = value[q, c]
        all_best = np.concatenate([best[live], value], axis=1)
        keep = np.argpartition(-all_best, width - 1, axis=1)[:, :width]
        best[live] = np.take_along_axis(all_best, keep, 1)
        ids[live] = np.take_along_axis(np.concatenate([ids[live], near], axis=1), keep, 1)
        done[live] = np.take_along_axis(np.concatenate([done[live], ~fresh], axis=1), keep, 1)
        done[live] |= ids[live] < 0
    return ids, best


def choose(units: np.ndarray, base: np.ndarray, ids: np.ndarray, sims: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` neighbours for each base vector among the candidates: nearest first, those nearer to a chosen one than to the
    base only if places remain."""
    order = np.argsort(-sims, axis=1, kind="stable")
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    n, k = ids.shape
    vectors = units[ids]
    closest = np.full((n, k), -2.0, np.float32)  # to the chosen so far
    rank = np.full((n, k), 2 * k)
    chosen = np.zeros(n, np.int64)
    for j in range(k):
        take = (ids[:, j] >= 0) & (chosen < count) & (sims[:, j] > closest[:, j])
        rows = np.flatnonzero(take)
        if len(rows):
            rank[rows, j] = chosen[rows]
            chosen[rows] += 1
            closest[rows] = np.maximum(closest[rows], np.einsum("nd,nkd->nk", vectors[rows, j], vectors[rows]))
    rest = (rank == 2 * k) & (ids >= 0)
    rank[rest] = k + np.nonzero(rest)[1] // 2
    order = np.argsort(rank, axis=1, kind="stable")[:, :count]
    out = np.full((n, count), -1)
    got = np.take_along_axis(np.where(rank < 2 * k, ids, -1), order, 1)
    out[:, :got.shape[1]] = got
    return out


def build(units: np.ndarray) -> Graph:
    """Insert the vectors in growing batches; a batch searches the graph so far and its own members."""
    n = len(units)
    draw = ((np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(np.float64) / (1 << 53)
    level = np.minimum((-np.log(draw + 1e-18) / np.log(LINKS)).astype(np.int64), 8)
    level[0] = level.max()
    layers = [np.full((n, LINKS * (2 if k == 0 else 1)), -1) for k in range(level[0] + 1)]
    at = 1
    while at < n:
        new = np.arange(at, min(n, at + min(at, 256)))
        entry = np.zeros((len(new), 1), np.int64)
        for k in range(int(level[0]), -1, -1):
            ids, best = beam(units, layers[k], units[new], entry, BUILD_BEAM if k <= level[new].max() else 1, np.full((len(new), n), -2, np.float32))
            entry = ids[np.arange(len(new)), best.argmax(1)][:, None]
            own = np.flatnonzero(level[new] >= k)
            if not len(own):
                continue
            inside = units[new[own]] @ units[new[own]].T
            np.fill_diagonal(inside, -2)
            cand = np.concatenate([ids[own], np.where(inside > -2, np.broadcast_to(new[own], inside.shape), -1)], axis=1)
            sims = np.concatenate([best[own], inside], axis=1)
            few = min(cand.shape[1], BUILD_BEAM)
            top = np.argpartition(-sims, few - 1, axis=1)[:, :few]
            picked = choose(units, units[new[own]], np.take_along_axis(cand, top, 1), np.take_along_axis(sims, top, 1), LINKS)
            layers[k][new[own], :LINKS] = picked
            _link_back(units, layers[k], new[own], picked)
        at += len(new)
    return Graph(units, layers, 0)


def _link_back(units: np.ndarray, links: np.ndarray, new: np.ndarray, picked: np.ndarray) -> None:
    source, target = np.repeat(new, picked.shape[1]), picked.ravel()
    use = target >= 0
    source, target = source[use], target[use]
    order = np.lexsort((source, target))
    source, target = source[order], target[order]
    nodes, start, count = np.unique(target, return_index=True, return_counts=True)
    width = links.shape[1]
    extra = np.full((len(nodes), int(count.max()) if len(count) else 0), -1)
    extra[np.repeat(np.arange(len(nodes)), count), np.arange(len(source)) - np.repeat(start, count)] = source
    every = np.concatenate([links[nodes], extra], axis=1)
    every = np.sort(every, axis=1)
    every[:, 1:][every[:, 1:] == every[:, :-1]] = -1
    for a in range(0, len(nodes), 256):
        part, ids = nodes[a:a + 256], every[a:a + 256]
        sims = np.where(ids >= 0, np.einsum("nd,nkd->nk", units[part], units[ids]), np.float32(-2))
        few = min(ids.shape[1], 2 * width)
        top = np.argpartition(-sims, few - 1, axis=1)[:, :few]
        links[part] = choose(units, units[part], np.take_along_axis(ids, top, 1), np.take_along_axis(sims, top, 1), width)


def search(graph: Graph, queries: np.ndarray, threshold: float, width: int) -> np.ndarray:
    """Similarities [query, node] of all nodes seen on the way (-2: not seen)."""
    units, n = graph.units, len(graph.units)
    sims = np.full((len(queries), n), -2, np.float32)
    if width >= n:
        return queries @ units.T
    entry = np.full((len(queries), 1), graph.entry)
    for k in range(len(graph.layers) - 1, 0, -1):
        ids, best = beam(units, graph.layers[k], queries, entry, 4, np.full((len(queries), n), -2, np.float32))
        entry = np.where(ids >= 0, ids, entry)
    beam(units, graph.layers[0], queries, entry, width, sims)
    spent = np.zeros((len(queries), n), bool)
    while True:
        q, node = np.nonzero((sims >= threshold - SLACK) & ~spent)
        if not len(q):
            return sims
        for a in range(0, len(q), 100_000):
            qa, na = q[a:a + 100_000], node[a:a + 100_000]
            spent[qa, na] = True
            near = graph.layers[0][na]
            key = np.unique((qa[:, None] * n + near)[near >= 0])
            q2, n2 = np.divmod(key, n)
            new = sims[q2, n2] <= -2
            q2, n2 = q2[new], n2[new]
            for b in range(0, len(q2), 50_000):
                sims[q2[b:b + 50_000], n2[b:b + 50_000]] = np.einsum("kd,kd->k", queries[q2[b:b + 50_000]], units[n2[b:b + 50_000]])


def audited(finds: np.ndarray, best: np.ndarray, share: int) -> np.ndarray:
    """Queries to audit: of those with more than ``LINKS`` finds, and of the others, the ``share`` with the best find and as many evenly
    spread ones."""
    out = [np.zeros(0, np.int64)]
    for group in (np.flatnonzero(finds > LINKS), np.flatnonzero(finds <= LINKS)):
        out += [group[np.argsort(-best[group])[:share]], group[::max(1, len(group) // share)]]
    return np.unique(np.concatenate(out))


def audited_search(graph: Graph, queries: np.ndarray, threshold: float, itself: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(first query, similarities) for blocks of queries; each block's beam widens until it passes the audit. ``itself``: the node that
    each query is (-1: none), which is no find."""
    width = BEAM
    itself = np.full(len(queries), -1) if itself is None else itself
    for a in range(0, len(queries), AT_ONCE):
        own, same = queries[a:a + AT_ONCE], itself[a:a + AT_ONCE]
        while True:
            sims = search(graph, own, threshold, width)
            if width >= len(graph.units):
                break
            others = sims.copy()
            here = np.flatnonzero(same >= 0)
            others[here, same[here]] = -2
            found = others >= threshold - ROUNDING
            every = audited(found.sum(1), others.max(1), max(1, AUDITED * len(own) // AT_ONCE // 2))
            true = own[every] @ graph.units.T >= threshold
            here = np.flatnonzero(same[every] >= 0)
            true[here, same[every][here]] = False
            if ((true & found[every]).sum(1) >= RECALL * true.sum(1)).all():
                break
            width *= 2
        yield a, sims


# --- Spark -----------------------------------------------------------------------------------------------------------

@ta.released
def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, vector): the vector's doubles as bytes, null where it can't link."""
    for batch in batches:
        ids, column, labels = batch.column(0), batch.column(1), batch.column(2)
        out: list[bytes | None] = [None] * batch.num_rows
        wide = column.cast(pa.list_(pa.float64()))
        values, offsets = wide.values, wide.offsets.to_numpy()
        flat = values.to_numpy(zero_copy_only=False)
        good = np.isfinite(flat)
        good &= ~values.is_null().to_numpy(zero_copy_only=False)
        here = wide.is_valid().to_numpy(zero_copy_only=False) & labels.is_valid().to_numpy(zero_copy_only=False)
        for r in np.flatnonzero(here).tolist():
            a, b = offsets[r], offsets[r + 1]
            if b > a and good[a:b].all() and (flat[a:b] != 0).any():
                out[r] = (flat[a:b] + 0.0).tobytes()
        yield pa.RecordBatch.from_arrays([ids, labels, pa.array(out, pa.binary())], names=["vec_id", "label", "vector"])


def _scaled(raw: np.ndarray) -> np.ndarray:
    """Vectors times a power of two of their own, the largest component between a half and one: products neither overflow nor vanish,
    and cosines stay the same to the last bit where neither happened."""
    return np.ldexp(raw, -np.frexp(np.abs(raw).max(1, keepdims=True))[1])


def _units(raw: np.ndarray) -> np.ndarray:
    raw = _scaled(raw)
    return (raw / np.linalg.norm(raw, axis=1, keepdims=True)).astype(np.float32)


@ta.released
def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard -> one row a shard: its classes, their sizes, vectors and graph."""
    def index(key: tuple, rows: list[tuple]) -> pa.RecordBatch:
        cids = np.array([r[0] for r in rows], np.int64)
        size = np.array([r[1] for r in rows], np.int64)
        raw = np.frombuffer(b"".join(r[2] for r in rows), np.float64).reshape(len(rows), -1)
        graph = build(_units(raw))
        layers = np.concatenate([x.astype(np.int32).ravel() for x in graph.layers])
        return pa.RecordBatch.from_pydict({
            "label": pa.array([key[0]], pa.string()), "dim": pa.array([key[1]], pa.int32()), "shard": pa.array([key[2]], pa.int32()),
            "shards": pa.array([key[3]], pa.int32()), "cids": pa.array([cids.tobytes()], pa.binary()), "sizes": pa.array([size.tobytes()], pa.binary()),
            "vectors": pa.array([raw.tobytes()], pa.binary()), "layers": pa.array([layers.tobytes()], pa.binary()),
            "n_layers": pa.array([len(graph.layers)], pa.int32())})

    key, rows = None, []
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in ("label", "dim", "shard", "shards", "cid", "n", "vector")]
        for *k, cid, n, vector in zip(*columns):
            if k != key and rows:
                yield index(key, rows)
                rows = []
            key = k
            rows.append((cid, n, vector))
    if rows:
        yield index(key, rows)


def _search_pairs(threshold: float):
    """(query block, shard) rows -> (a, null, links): links of class a in that shard; (a, b, 0): links that span what was found."""
    def one(r: dict) -> pa.RecordBatch:
        cids, sizes = np.frombuffer(r["cids"], np.int64), np.frombuffer(r["sizes"], np.int64)
        raw = _scaled(np.frombuffer(r["vectors"], np.float64).reshape(len(cids), -1))
        layers, at = [], 0
        flat = np.frombuffer(r["layers"], np.int32)
        for k in range(r["n_layers"]):
            width = LINKS * (2 if k == 0 else 1)
            layers.append(flat[at:at + len(cids) * width].reshape(len(cids), width).astype(np.int64))
            at += len(cids) * width
        graph = Graph(_units(raw), layers, 0)
        own = np.frombuffer(r["q_cids"], np.int64)
        query = _scaled(np.frombuffer(r["q_vectors"], np.float64).reshape(len(own), -1))
        norm, q_norm = np.linalg.norm(raw, axis=1), np.linalg.norm(query, axis=1)
        links, a, b = np.zeros(len(own), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for first, sims in audited_search(graph, _units(query), threshold, ta.lookup(cids, own)):
            q, node = np.nonzero(sims >= threshold - ROUNDING)
            q = q + first
            good = np.zeros(len(q), bool)
            for k in range(0, len(q), 50_000):
                qk, nk = q[k:k + 50_000], node[k:k + 50_000]
                good[k:k + 50_000] = np.einsum("kd,kd->k", query[qk], raw[nk]) / (q_norm[qk] * norm[nk]) >= threshold
            q, node = q[good], node[good]
            other = own[q] != cids[node]
            q, node = q[other], node[other]
            links += np.bincount(q, sizes[node], len(own)).astype(np.int64)
            nodes, roots = forest(np.concatenate([a, own[q]]), np.concatenate([b, cids[node]]))
            a, b = nodes[nodes != roots], roots[nodes != roots]
        return pa.RecordBatch.from_pydict({
            "a": pa.array(np.concatenate([own, a])), "b": pa.array(np.concatenate([np.zeros(len(own), np.int64), b]), mask=np.arange(len(own) + len(a)) < len(own)),
            "links": pa.array(np.concatenate([links, np.zeros(len(a), np.int64)]))})

    @ta.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield one(batch.slice(k, 1).to_pylist()[0])
    return run


def dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD,
          shard_vectors: int = SHARD_VECTORS) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id (the smallest id reachable) and kept of every row. Runs the jobs."""
    spark = vectors.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"), F.col(label_col).cast("string").alias("label"))
    rows = materialize(source.mapInArrow(_valid, "vec_id long, label string, vector binary").withColumn(
        "cid", F.when(F.col("vector").isNotNull(), F.xxhash64("label", "vector"))))
    usable = rows.where("cid is not null")
    classes = materialize(usable.groupBy("cid", "label", "vector").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"))
                          .withColumn("dim", (F.octet_length("vector") / 8).cast("int")))

    groups = classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / F.lit(shard_vectors)).cast("int").alias("shards"))
    few = F.broadcast(groups) if row_count_at_most(groups, MAX_BROADCAST_ROWS) else groups
    dealt = classes.join(few, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64(F.lit(7), "cid"), F.col("shards")).cast("int"))
    index = materialize(
        dealt.select("label", "dim", "shard", "shards", "cid", "n", "vector").repartition(parts, "label", "dim", "shard")
        .sortWithinPartitions("label", "dim", "shard", "cid")
        .mapInArrow(_shards, "label string, dim int, shard int, shards int, cids binary, sizes binary, vectors binary, layers binary, n_layers int"))
    blocks = index.select("label", "dim", F.col("shard").alias("block"), F.col("cids").alias("q_cids"), F.col("vectors").alias("q_vectors"),
                          F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    pairs = blocks.join(index.drop("shards"), ["label", "dim", "shard"]).repartition(parts, "label", "dim", "shard", "block")
    found = materialize(pairs.mapInArrow(_search_pairs(threshold), "a long, b long, links long"))

    links = found.where("b is null").groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links"))
    joined = connected_components(found.where("b is not null").select("a", "b"))
    roots = classes.select(F.col("cid").alias("node"), "least", "n").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = roots.groupBy("component").agg(F.min("least").alias("component_id"))
    labelled = roots.join(least, "component").join(links, F.col("node") == F.col("cid"), "left").select(
        F.col("node").alias("cid"), "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    out = rows.select("vec_id", "cid").join(labelled, "cid", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
