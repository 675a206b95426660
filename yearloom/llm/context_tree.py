"""Language-model scoring by context-tree weighting over bytes.

The model predicts the bytes of a text (A-Z lower-cased) and then an end mark, each
from up to ``DEPTH`` bytes before it (the text's start counts as start marks). A byte is
eight binary decisions; each has its own context tree. A tree node's Krichevsky-Trofimov
estimate is ``(n1 + 1/2) / (n + 1)``; its weighted probability is half its own block
probability plus half the product of its children's, which gives the share ``w`` of the
node's own estimate in the mixture over all depths:
``p = w_0 KT_0 + (1 - w_0)(w_1 KT_1 + (1 - w_1)( ... ))``.

Contexts with ``MIN_COUNT`` training bytes or more are nodes, however many these are (only a
caller's ``model_codes`` bounds them: the least count then doubles until their (context, byte)
pairs fit); the other contexts below a node count in its weighting as one child. A byte never
seen after a context gets the context's unseen probability, shared out as by the next shorter
context.

Training, as Spark jobs: tasks count (context, byte) pairs and words of their documents;
owners (by the last two bytes, by the word) add the counts up; weights go up the trees and
mixtures down inside the owners, and only the two top levels (at most 256 x 256 counts) meet
on the driver.

Scoring: tasks receive a cache of the largest contexts, whole, of about ``CACHED_CODES`` pairs.
It settles the bytes whose longest context it holds, as all shorter ones are then in it too.
The others go, packed, to the owners of their last ``DEALT`` bytes, which hold every node of
``DEALT`` bytes or more (shorter ones are broadcast), and come back as sums per document.

The base score needs every word's training count. Words with at least 1 / ``HEAVY_WORDS`` of the
tokens (so at most ``HEAVY_WORDS``) are broadcast; occurrences of the others go, packed, to the
words' owners, and come back as sums per document.

Defined results: a null text counts as empty (its end mark remains); a null document id, or a
null ``learn``, isn't learned from; with nothing learned every probability is that of empty
counts; rows are scored one by one; an empty table gives no rows; other columns are ignored.
Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearloom.llm import textarrays as ta
from yearloom.session import materialize

DEPTH = 6
MIN_COUNT = 8
CACHED_CODES = 1 << 21
DEALT = 3  # last bytes of a context that name the owner of its probabilities
HEAVY_WORDS = 1 << 18
BASE_ALPHA = 0.1
MARK = 255  # start and end mark: no byte of UTF-8 text
END_WORD = np.uint64(0x9D39247E33776D41)  # stands for the end among the words
HALF, LOG_HALF = math.lgamma(0.5), math.log(0.5)


# --- counting --------------------------------------------------------------------------------------------------------

def byte_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every byte and end mark of a block's rows: the ``DEPTH`` bytes before it (the nearest in the highest place) and itself in
    the lowest place; and the rows' offsets among these."""
    length = np.diff(offsets)
    rows = len(length)
    at = offsets[:-1] + np.arange(rows) * (DEPTH + 1) + DEPTH
    text = np.full(len(data) + rows * (DEPTH + 1), MARK, np.uint8)
    text[np.arange(len(data)) + np.repeat(at - offsets[:-1], length)] = ta.LOWER[data]
    n = len(text) - DEPTH
    code = np.zeros(n, np.uint64)
    for d in range(1, DEPTH + 1):
        code = (code << np.uint64(8)) | text[DEPTH - d:DEPTH - d + n]
    code = (code << np.uint64(8)) | text[DEPTH:]
    use = np.ones(n, bool)
    starts = at - DEPTH
    for d in range(DEPTH):  # positions of start marks are no outcomes
        k = starts + d - DEPTH
        use[k[k >= 0]] = False
    return code[use], offsets + np.arange(rows + 1)


def tally(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts (1 each, if not given)."""
    if counts is None:
        keys = np.sort(keys)
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        return keys[starts], np.diff(np.append(starts, len(keys)))
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(counts, starts)


class Tally:
    """Counts of keys, gathered in parts and joined now and then."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = self.joined = 0

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        self.parts.append(tally(keys, counts))
        self.held += len(self.parts[-1][0])
        if self.held > 2 * self.joined + 250_000:
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([k for k, _ in self.parts] or [np.zeros(0, np.uint64)])
        counts = np.concatenate([c for _, c in self.parts] or [np.zeros(0, np.int64)])
        self.parts = []  # not held while the join sorts
        keys, counts = tally(keys, counts)
        self.parts, self.held, self.joined = [(keys, counts)], len(keys), len(keys)
        return keys, counts


def pack(keys: np.ndarray) -> bytes:
    """Ascending keys as compressed differences."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return len(keys).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), "zstd", asbytes=True)


def unpack(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    planes = np.frombuffer(pa.decompress(raw[8:], 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    return len(counts).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(counts.astype(np.int64).view(np.uint8).reshape(-1, 8).T).tobytes(), "zstd", asbytes=True)


def unpack_counts(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    planes = np.frombuffer(pa.decompress(raw[8:], 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view(np.int64).ravel()


def pack_small(values: np.ndarray) -> bytes:
    """Integers under 2^32, compressed."""
    return len(values).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(values.astype(np.uint32).view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd", asbytes=True)


def unpack_small(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    planes = np.frombuffer(pa.decompress(raw[8:], 4 * n, "zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view(np.uint32).ravel()


def context(codes: np.ndarray, depth: int) -> np.ndarray:
    """The context of ``depth`` bytes of full codes."""
    return codes >> np.uint64(8 * (DEPTH + 1 - depth)) if depth else np.zeros(len(codes), np.uint64)


COUNTED = "kind string, owner int, keys binary, counts binary, n long, total long, sizes binary"


def _row(kind: str, owner: int, keys: np.ndarray, counts: np.ndarray, sizes: bytes = b"") -> tuple:
    return kind, owner, pack(keys), pack_counts(counts), len(keys), int(counts.sum()), sizes


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["kind", "owner", "keys", "counts", "n", "total", "sizes"]
    types = [pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)


def _deal(kind: str, keys: np.ndarray, counts: np.ndarray, owner: np.ndarray) -> Iterator[tuple]:
    order = np.argsort(owner, kind="stable")
    who, at = np.unique(owner[order], return_index=True)
    for o, a, b in zip(who.tolist(), at.tolist(), [*at[1:].tolist(), len(order)]):
        yield _row(kind, o, keys[order[a:b]], counts[order[a:b]])


def _count(owners: int):
    @ta.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, words, codes = ta.Powers(), Tally(), Tally()
        for batch in batches:
            column = batch.column(0).filter(batch.column(1).fill_null(False))
            for _, _, data, offsets in ta.blocks(column):
                words.add(ta.word_hashes(data, offsets, powers)[0])
                codes.add(byte_codes(data, offsets)[0])
            if len(column):
                words.add(np.array([END_WORD]), np.array([len(column)]))
        for kind, (keys, counts) in (("word", words.total()), ("code", codes.total())):
            part = keys if kind == "word" else context(keys, 2)
            for row in _deal(kind, keys, counts, (ta.mix(part) % np.uint64(owners)).astype(np.int32)):
                yield _batch([row])
    return run


@ta.released
def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """An owner's counts, summed; for codes also how many pairs there are at each depth (2 on) by the size of their contexts."""
    sums: dict[tuple[str, int], Tally] = {}
    for batch in batches:
        for row in batch.select(["kind", "owner", "keys", "counts"]).to_pylist():
            keys, counts = unpack(row["keys"]), unpack_counts(row["counts"])
            own = sums.setdefault((row["kind"], row["owner"]), Tally())
            own.add(keys, counts)
    for (kind, owner), own in sums.items():
        keys, counts = own.total()
        sizes = np.zeros((DEPTH + 1, 64), np.int64)
        if kind == "code":
            for d in range(2, DEPTH + 1):
                pairs, n = pair_counts(keys, counts, d)
                _, start, length = runs(pairs >> np.uint64(8))
                size = np.log2(np.add.reduceat(n, start)).astype(np.int64) if len(start) else start
                np.add.at(sizes[d], size, length)
        yield _batch([_row(kind, owner, keys, counts, sizes.tobytes())])


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], starts, np.diff(np.append(starts, len(keys)))


# --- trees -----------------------------------------------------------------------------------------------------------

def pair_counts(codes: np.ndarray, counts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(context of ``depth`` bytes, byte) pairs and their counts."""
    if depth == DEPTH:
        return codes, counts
    return tally((context(codes, depth) << np.uint64(8)) | (codes & np.uint64(255)), counts)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function for x >= 1/2, by Stirling's series after eight steps up."""
    y, low = x + 8.0, np.zeros_like(x)
    for k in range(8):
        low += np.log(x + k)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7) + 1 / (1188 * y ** 9) - low


def log_block(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov block probability."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - 2 * HALF - log_gamma(n0 + n1 + 1.0)


def bit_nodes(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Decision nodes of (context, byte) pairs: key (context, place in the byte's decision tree: 1 at the top), counts of 0 and 1; and
    the node of each of every pair's eight decisions [8, pair]."""
    byte = pairs & np.uint64(255)
    top = pairs & ~np.uint64(255)
    key = np.concatenate([top | (np.uint64(1) << np.uint64(k)) | (byte >> np.uint64(8 - k)) for k in range(8)])
    bit = np.concatenate([(byte >> np.uint64(7 - k)) & np.uint64(1) for k in range(8)])
    nodes, inverse = np.unique(key, return_inverse=True)
    weight = np.tile(counts, 8).astype(np.float64)
    n1 = np.bincount(inverse, weight * bit, len(nodes))
    return nodes, np.bincount(inverse, weight, len(nodes)) - n1, n1, inverse.reshape(8, -1)


def parent(nodes: np.ndarray) -> np.ndarray:
    """The same decision in the context one byte shorter."""
    return ((nodes >> np.uint64(16)) << np.uint64(8)) | (nodes & np.uint64(255))


def weigh(n0, n1, child_at, child_log, child0, child1):
    """ln weighted probability of nodes and the share of their own estimates; children (given by their parents' places) that are no
    nodes count as one child."""
    size = len(n0)
    rest0, rest1 = n0 - np.bincount(child_at, child0, size), n1 - np.bincount(child_at, child1, size)
    below = np.bincount(child_at, child_log, size) + log_block(rest0, rest1)
    own = log_block(n0, n1)
    both = np.logaddexp(own, below) + LOG_HALF
    return both, np.exp(own + LOG_HALF - both)


class Level:
    """The nodes of one depth."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, depth: int, least: int):
        self.depth = depth
        pairs, counts = pair_counts(codes, counts, depth)
        _, start, length = runs(pairs >> np.uint64(8))
        total = np.add.reduceat(counts, start) if len(start) else start
        keep = np.repeat(total >= least, length) if depth else np.ones(len(pairs), bool)
        self.pairs, self.counts = pairs[keep], counts[keep]
        self.nodes, self.n0, self.n1, self.path = bit_nodes(self.pairs, self.counts)
        self.kt = (self.n1 + 0.5) / (self.n0 + self.n1 + 1.0)

    def weigh(self, below: Level | None) -> None:
        if below is None:
            self.log, self.share = log_block(self.n0, self.n1), np.ones(len(self.nodes))
        else:
            self.log, self.share = weigh(self.n0, self.n1, ta.lookup(self.nodes, parent(below.nodes)), below.log, below.n0, below.n1)

    def mix(self, above: np.ndarray, left: np.ndarray) -> np.ndarray:
        """From the shorter depths' part of the mixture and what is left for this one: each pair's ln probability. Keeps the same for
        the nodes below."""
        p1 = above + left * self.kt
        self.above, self.left = above + left * self.share * self.kt, left * (1 - self.share)
        byte = self.pairs & np.uint64(255)
        out = np.zeros(len(self.pairs))
        for k in range(8):
            p = p1[self.path[k]]
            out += np.log(np.where((byte >> np.uint64(7 - k)) & np.uint64(1) == 1, p, 1 - p))
        return out


def model_key(keys: np.ndarray, depth: int, whole: bool) -> np.ndarray:
    """Table keys of pairs (or, if ``whole``, of contexts) of a depth; never 0."""
    tag = np.uint64((depth + 1) << 57 | whole << 56)
    return ta.mix(keys | tag if DEPTH < 7 else keys ^ ta.mix(np.array([tag]))[0])


def entries(level: Level, logs: np.ndarray, shorter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Table entries (key, ln): every pair's probability, and every context's factor for bytes unseen after it; and the context of each
    entry and its count. ``shorter``: the pairs' probabilities in the context one byte shorter."""
    contexts, start, length = runs(level.pairs >> np.uint64(8))
    if not len(contexts):
        return np.zeros(0, np.uint64), np.zeros(0, np.float32), contexts, start
    total = np.add.reduceat(level.counts, start)
    unseen = 1 - np.add.reduceat(np.exp(logs), start)
    other = 1 - np.add.reduceat(shorter, start)
    factor = np.log(np.maximum(unseen, 1e-12) / np.maximum(other, 1e-12))
    return (np.concatenate([model_key(level.pairs, level.depth, False), model_key(contexts, level.depth, True)]),
            np.concatenate([logs, np.minimum(factor, 0.0 + 700)]).astype(np.float32),
            np.concatenate([level.pairs >> np.uint64(8), contexts]), np.concatenate([np.repeat(total, length), total]))


def _levels(codes: np.ndarray, counts: np.ndarray, least: int) -> list[Level]:
    """Weighted levels DEPTH .. 2 of an owner's codes."""
    out: list[Level] = []
    for d in range(DEPTH, 1, -1):
        out.append(Level(codes, counts, d, least))
        out[-1].weigh(out[-2] if len(out) > 1 else None)
    return out


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for row in batch.select(["keys", "counts"]).to_pylist():
            yield unpack(row["keys"]), unpack_counts(row["counts"])


def _tops(least: int):
    """What the levels above depth 2 need of an owner: pairs of depth 1 with their counts, and sums over depth 2's nodes per node of depth 1."""
    @ta.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, counts in _codes(batches):
            pairs, n = pair_counts(codes, counts, 1)
            low = _levels(codes, counts, least)[-1]
            nodes, at = np.unique(parent(low.nodes), return_inverse=True)
            none = np.zeros(len(pairs))
            yield pa.RecordBatch.from_pydict({
                "node": pa.array([*[False] * len(pairs), *[True] * len(nodes)], pa.bool_()),
                "key": pa.array(np.concatenate([pairs, nodes]).astype(np.int64)),
                "n": pa.array(np.concatenate([n, np.zeros(len(nodes), np.int64)])),
                **{k: pa.array(np.concatenate([none, np.bincount(at, v, len(nodes))])) for k, v in (("log", low.log), ("n0", low.n0), ("n1", low.n1))}})
    return run


TABLE = "kind string, owner int, keys binary, logs binary"


def _entries(least: int, cached: int, top, owners: int):
    """Table entries of an owner's codes: those of contexts under ``DEALT`` bytes ("short"), of the others with ``cached`` training bytes
    or more ("cached"), and all the others by the owner of their last ``DEALT`` bytes ("model")."""
    @ta.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, above, left, pairs, logs = top.value
        for codes, counts in _codes(batches):
            rows, parts = [], []
            shorter_pairs, shorter_logs = pairs, logs
            upper_nodes, upper_above, upper_left = nodes, above, left
            for level in reversed(_levels(codes, counts, least)):
                at = ta.lookup(upper_nodes, parent(level.nodes))
                own = level.mix(upper_above[at], upper_left[at])
                shorter = np.exp(shorter_logs[ta.lookup(shorter_pairs, parent(level.pairs))])
                keys, values, contexts, sizes = entries(level, own, shorter)
                if level.depth < DEALT:
                    rows.append(("short", -1, keys, values))
                else:
                    large = sizes >= cached
                    rows.append(("cached", -1, keys[large], values[large]))
                    parts.append((keys, values, code_owner(contexts >> np.uint64(8 * (level.depth - DEALT)), owners)))
                shorter_pairs, shorter_logs = level.pairs, own
                upper_nodes, upper_above, upper_left = level.nodes, level.above, level.left
            keys, values, owner = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(owner, kind="stable")
            who, at = np.unique(owner[order], return_index=True)
            rows += [("model", o, keys[order[a:b]], values[order[a:b]]) for o, a, b in zip(who.tolist(), at.tolist(), [*at[1:].tolist(), len(order)])]
            types = (pa.string(), pa.int32(), pa.binary(), pa.binary())
            columns = zip(*[(kind, o, k.tobytes(), x.tobytes()) for kind, o, k, x in rows])
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], names=["kind", "owner", "keys", "logs"])
    return run


def code_owner(contexts: np.ndarray, owners: int) -> np.ndarray:
    """Owner of the probabilities after contexts of ``DEALT`` bytes."""
    return (ta.mix(contexts) % np.uint64(owners)).astype(np.int32)


def _joined(rows: pa.Table, kind: str) -> tuple[np.ndarray, np.ndarray]:
    use = [k for k, x in enumerate(rows["kind"].to_pylist()) if x == kind]
    return (np.frombuffer(b"".join(rows["keys"][k].as_py() for k in use), np.uint64),
            np.frombuffer(b"".join(rows["logs"][k].as_py() for k in use), np.float32))


def train(texts: DataFrame, model_codes: int | None = None, min_count: int = MIN_COUNT, heavy_words: int = HEAVY_WORDS, cached_codes: int = CACHED_CODES):
    """From ``texts`` (text, learn): the table of counts (one row an owner and kind), tokens N, distinct tokens V, the table of the byte
    model (by owner), and the broadcast byte model's cache, its entries of contexts under ``DEALT`` bytes, and the heavy words' counts.
    Runs the training jobs."""
    spark = texts.sparkSession
    owners = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = materialize(texts.mapInArrow(_count(owners), COUNTED).repartition(owners, "owner").mapInArrow(_add_up, COUNTED))
    words = counted.where("kind = 'word'")
    codes = counted.where("kind = 'code'")
    n, v = (x or 0 for x in words.agg(F.sum("total"), F.sum("n")).first())
    heavy = words.mapInArrow(_heavy(max(1, n // heavy_words)), "keys binary, counts binary").toArrow()  # at most heavy_words
    heavy_keys = np.concatenate([np.frombuffer(x, np.uint64) for x in heavy["keys"].to_pylist()] or [np.zeros(0, np.uint64)])
    heavy_counts = np.concatenate([np.frombuffer(x, np.int64) for x in heavy["counts"].to_pylist()] or [np.zeros(0, np.int64)])

    sizes = np.zeros((DEPTH + 1, 64), np.int64)
    for r in codes.select("sizes").toLocalIterator():  # one row an owner
        sizes += np.frombuffer(r["sizes"], np.int64).reshape(DEPTH + 1, 64)
    least = 1 << _step(sizes, min_count, model_codes) if model_codes is not None else min_count
    cached = 1 << _step(sizes, least, cached_codes)

    rows = codes.mapInArrow(_tops(least), "node boolean, key long, n long, log double, n0 double, n1 double").groupBy("node", "key").agg(
        *[F.sum(k).alias(k) for k in ("n", "log", "n0", "n1")]).orderBy("node", "key").toArrow()  # at most 2 x 256 x 256
    is_node = rows["node"].to_numpy(zero_copy_only=False)
    key, count = rows["key"].to_numpy().astype(np.uint64), rows["n"].to_numpy()
    pairs, counts = key[~is_node], count[~is_node]
    one = Level(*_as_codes(pairs, counts), 1, least)
    below = is_node & (ta.lookup(one.nodes, key) >= 0)
    at = ta.lookup(one.nodes, key[below])
    one.log, one.share = weigh(one.n0, one.n1, at, *(rows[k].to_numpy()[below] for k in ("log", "n0", "n1")))
    none = Level(*_as_codes(pairs, counts), 0, 0)
    none.weigh(one)
    full = np.arange(256, dtype=np.uint64)
    p1 = np.full(256, 0.5)
    p1[none.nodes.astype(np.int64)] = none.kt
    byte_logs = np.zeros(256)
    for k in range(8):
        p = p1[(1 << k) | (np.arange(256) >> (8 - k))]
        byte_logs += np.log(np.where((np.arange(256) >> (7 - k)) & 1 == 1, p, 1 - p))
    none.mix(np.zeros(len(none.nodes)), np.ones(len(none.nodes)))
    up = ta.lookup(none.nodes, parent(one.nodes))
    one_logs = one.mix(none.above[up], none.left[up])
    first = [(model_key(full, 0, False), byte_logs.astype(np.float32)), entries(one, one_logs, np.exp(byte_logs[(one.pairs & np.uint64(255)).astype(np.int64)]))[:2]]
    top = spark.sparkContext.broadcast((one.nodes, one.above, one.left, one.pairs, one_logs))
    table = materialize(codes.mapInArrow(_entries(least, cached, top, owners), TABLE))
    rest = table.where("kind <> 'model'").select("kind", "keys", "logs").toArrow()  # cached_codes pairs and their contexts, and depth 2
    short = [np.concatenate(x) for x in zip(*first, _joined(rest, "short"))]
    cache = [np.concatenate(x) for x in zip(short, _joined(rest, "cached"))]
    share = spark.sparkContext.broadcast
    return counted, n, v, table.where("kind = 'model'"), share(ta.hash_table(*cache)), share(tuple(short)), share(ta.hash_table(heavy_keys, heavy_counts))


def _step(sizes: np.ndarray, least: int, most: int) -> int:
    """log2 of the least power of two, ``least`` or more, such that contexts of that count have at most ``most`` pairs."""
    step = max(0, math.ceil(math.log2(least)))
    while step < 63 and sizes[:, step:].sum() > most:
        step += 1
    return step


def _as_codes(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of depth 1 in the form of full codes."""
    return ((pairs >> np.uint64(8)) << np.uint64(8 * DEPTH)) | (pairs & np.uint64(255)), counts


def _heavy(least: int):
    @ta.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, counts in _codes(batches):
            use = counts >= least
            yield pa.RecordBatch.from_pydict({"keys": pa.array([keys[use].tobytes()], pa.binary()), "counts": pa.array([counts[use].tobytes()], pa.binary())})
    return run


# --- scoring ---------------------------------------------------------------------------------------------------------

def code_logs(model: tuple[np.ndarray, np.ndarray], codes: np.ndarray, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """ln probability of the byte in each code, given its context; and, unless the table is ``whole``, which codes' longest context it
    lacks: these it can't settle (0)."""
    out, unsettled = np.zeros(len(codes)), np.zeros(len(codes), bool)
    todo, own = np.arange(len(codes)), codes
    for d in range(DEPTH, -1, -1):
        pairs = (context(own, d) << np.uint64(8)) | (own & np.uint64(255)) if d < DEPTH else own
        found, value = ta.table_get(model, model_key(pairs, d, False))
        out[todo[found]] += value[found]
        todo, own = todo[~found], own[~found]
        if not len(todo):
            break
        if d:
            found, value = ta.table_get(model, model_key(context(own, d), d, True))
            out[todo[found]] += value[found]
            if d == DEPTH and not whole:
                unsettled[todo[~found]] = True
                todo, own = todo[found], own[found]
    return out, unsettled


def _waiting(name: int, codes: np.ndarray, rows: np.ndarray, owners: int) -> Iterator[tuple]:
    """Codes and the rows they are in, packed for the codes' owners."""
    order = np.argsort(codes)
    codes, rows = codes[order], rows[order]
    tops, _, length = runs(context(codes, DEALT))
    owner = np.repeat(code_owner(tops, owners), length)
    order = np.argsort(owner, kind="stable")
    codes, rows, owner = codes[order], rows[order], owner[order]
    who, at = np.unique(owner, return_index=True)
    for o, a, b in zip(who.tolist(), at.tolist(), [*at[1:].tolist(), len(owner)]):
        distinct, _, count = runs(codes[a:b])
        yield ("code", name, o, pack(distinct), pack_small(count), pack_small(rows[a:b]), *[None] * 4)


SCORED = "kind string, batch long, owner int, a binary, b binary, c binary, d binary, e binary, f binary, g binary"


def _packed(kind: str, batch: int, owner: int, *arrays: np.ndarray) -> tuple:
    return (kind, batch, owner, *(x.tobytes() for x in arrays), *[None] * (7 - len(arrays)))


def _scored_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int32(), *[pa.binary()] * 7]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)],
                                      names=["kind", "batch", "owner", *"abcdefg"])


def _score(model, heavy, total: float, owners: int):
    """Rows of documents (packed by batch) with their model score and the heavy words' part of the base score; and the other words'
    occurrences and the codes that the cache can't settle, packed for their owners."""
    @ta.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, table, words = ta.Powers(), model.value, heavy.value
        end_known, end_count = ta.table_get(words, np.array([END_WORD]))
        part = TaskContext.get().partitionId()
        for k, batch in enumerate(batches):
            n = batch.num_rows
            name = part << 32 | k  # the same when a lost executor's task runs again
            ids, fold = batch.column(1), batch.column(2)
            tokens, known, score, base = np.ones(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
            rare, rows = [np.full(0, END_WORD)], [np.zeros(0, np.int32)]
            wait, wait_rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
            if end_known[0]:
                known += 1
                base += math.log10(end_count[0] + BASE_ALPHA) - total
            else:
                rare, rows = [np.full(n, END_WORD)], [np.arange(n, dtype=np.int32)]
            for first, end, data, offsets in ta.blocks(batch.column(0)):
                codes, at = byte_codes(data, offsets)
                logs, unsettled = code_logs(table, codes, False)
                score[first:end] = np.add.reduceat(logs, at[:-1]) / math.log(10)
                wait.append(codes[unsettled])
                wait_rows.append(np.repeat(np.arange(first, end, dtype=np.int32), np.add.reduceat(unsettled, at[:-1], dtype=np.int64)))
                hashes, _, _, counts = ta.word_hashes(data, offsets, powers)
                row = np.repeat(np.arange(first, end, dtype=np.int32), counts)
                found, count = ta.table_get(words, hashes)
                tokens[first:end] += counts
                known[first:end] += np.bincount(row[found] - first, minlength=end - first)
                base[first:end] += np.bincount(row[found] - first, np.log10(count[found] + BASE_ALPHA) - total, end - first)
                rare.append(hashes[~found])
                rows.append(row[~found])
            rare, rows = np.concatenate(rare), np.concatenate(rows)
            yield _scored_batch([_packed("doc", name, int(ta.mix(np.array([name], np.uint64))[0] % np.uint64(owners)), ids.cast(pa.int64()).fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False),
                                         fold.cast(pa.int8()).fill_null(2).to_numpy(zero_copy_only=False), tokens, known, score, base)])
            owner = (ta.mix(rare) % np.uint64(owners)).astype(np.int32)
            order = np.argsort(owner, kind="stable")
            who, at = np.unique(owner[order], return_index=True)
            for o, a, b in zip(who.tolist(), at.tolist(), [*at[1:].tolist(), len(order)]):
                yield _scored_batch([_packed("word", name, o, rare[order[a:b]], rows[order[a:b]])])
            for row in _waiting(name, np.concatenate(wait), np.concatenate(wait_rows), owners):
                yield _scored_batch([row])
    return run


def _settle(short, total: float):
    """Rows sorted by owner, each owner's part of the byte model and its word counts ahead of the codes and words that wait for them ->
    per batch and document, sums. Rows of documents pass."""
    @ta.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, parts, model = None, [], None
        keys, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                if r["owner"] != owner:
                    owner, parts, model = r["owner"], [short.value], None
                    keys, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
                if r["kind"] == "model":
                    parts.append((np.frombuffer(r["a"], np.uint64), np.frombuffer(r["b"], np.float32)))
                elif r["kind"] == "count":
                    keys, n = unpack(r["a"]), unpack_counts(r["b"])
                elif r["kind"] == "doc":
                    yield batch.slice(k, 1)
                elif r["kind"] == "word":
                    hashes, rows = np.frombuffer(r["a"], np.uint64), np.frombuffer(r["b"], np.int32)
                    at = ta.lookup(keys, hashes)
                    count = np.where(at >= 0, n[at] if len(n) else 0, 0)
                    docs, place = np.unique(rows, return_inverse=True)
                    yield _scored_batch([_packed("sum", r["batch"], 0, docs, np.bincount(place, count > 0, len(docs)).astype(np.int64),
                                                 np.bincount(place, np.log10(count + BASE_ALPHA) - total, len(docs)))])
                else:
                    if model is None:
                        model, parts = ta.hash_table(*(np.concatenate(x) for x in zip(*parts))), []
                    logs = np.repeat(code_logs(model, unpack(r["a"]), True)[0], unpack_small(r["b"]))
                    rows = unpack_small(r["c"])
                    sums = np.bincount(rows, logs) / math.log(10)
                    docs = np.flatnonzero(np.bincount(rows))
                    yield _scored_batch([("score", r["batch"], 0, pack_small(docs), sums[docs].tobytes(), *[None] * 5)])
    return run


def _finish(train_tokens: int):
    @ta.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: dict[int, tuple] = {}
        sums: dict[int, list] = {}
        codes: dict[int, list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                if r["kind"] == "doc":
                    docs[r["batch"]] = tuple(np.frombuffer(r[k], t).copy() for k, t in zip("abcdefg", (np.int64, bool, np.int8, np.int64, np.int64, float, float)))
                elif r["kind"] == "score":
                    codes.setdefault(r["batch"], []).append((r["a"], r["b"]))
                else:
                    sums.setdefault(r["batch"], []).append((np.frombuffer(r["a"], np.int32), np.frombuffer(r["b"], np.int64), np.frombuffer(r["c"], float)))
        for name, (ids, missing, fold, tokens, known, score, base) in docs.items():
            for rows, k, x in sums.get(name, ()):
                known[rows] += k
                base[rows] += x
            for rows, x in codes.get(name, ()):
                score[unpack_small(rows)] += np.frombuffer(x, float)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, mask=missing), "held_out": pa.array(fold == 0, mask=fold == 2), "n_tokens": pa.array(tokens),
                "n_known": pa.array(known), "train_tokens": pa.array(np.full(len(ids), train_tokens, np.int64)),
                "base_score": pa.array(base), "score": pa.array(score)})
    return run


def score_documents(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", model_codes: int | None = None,
                    min_count: int = MIN_COUNT, heavy_words: int = HEAVY_WORDS, cached_codes: int = CACHED_CODES) -> DataFrame:
    """doc_id, held_out (not ``learn``), n_tokens, n_known, train_tokens, base_score and score (log10 probabilities) of every row."""
    texts = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("doc_id"), learn.alias("learn"))
    counted, n, v, table, cache, short, heavy = train(texts.select("text", "learn"), model_codes, min_count, heavy_words, cached_codes)
    total = math.log10(n + BASE_ALPHA * (v + 1))
    owners = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # documents, waiting words and codes, and what they wait for: one shuffle, none of it written before
    columns = [c.split()[0] for c in SCORED.split(", ")]
    empty = {c: F.lit(None).cast("binary").alias(c) for c in columns[3:]}
    batch = F.lit(0).cast("long").alias("batch")
    counts = counted.where("kind = 'word'").select(F.lit("count").alias("kind"), batch, "owner", F.col("keys").alias("a"), F.col("counts").alias("b"),
                                                    *[empty[c] for c in "cdefg"])
    entries_ = table.select("kind", batch, "owner", F.col("keys").alias("a"), F.col("logs").alias("b"), *[empty[c] for c in "cdefg"])
    scored = texts.mapInArrow(_score(cache, heavy, total, owners), SCORED).unionByName(counts).unionByName(entries_)
    first = F.when(F.col("kind") == "model", 0).when(F.col("kind") == "count", 1).otherwise(2)
    settled = scored.repartition(owners, "owner").sortWithinPartitions("owner", first).mapInArrow(_settle(short, total), SCORED)
    return settled.repartition(owners, "batch").mapInArrow(
        _finish(n), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
