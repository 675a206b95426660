"""Ranked lexical search with range-maximum tables over posting lists.

Terms are maximal runs of letters, digits and characters beyond ASCII, A-Z lower-cased. A
document's score for a query is a sum of integer impacts, one for each of the query's terms it
holds (``impacts``). The queries are a stated set: their terms are broadcast in blocks, so only
posting lists that a query asks for are built.

1. Tasks cut the documents into shards of about ``SHARD_BYTES`` of text and write each shard's
   posting lists (a row a shard, packed arrays), with its numbers of documents and terms.
2. Sums over all shards give the collection's figures and each query term's document count.
3. Tasks read shards, compute impacts, and give every posting list a sparse table of the places of
   its range maxima. A query starts with the interval of all documents of the shard, bounded by the
   sum of its terms' range maxima. Best intervals first, each is split at the document with its
   largest impact: that document is scored, and the two sides get their own bounds; an interval
   with at most ``LEAF_POSTINGS`` postings is scored as a whole. Intervals bounded below the k-th
   score so far (in all shards of the task) are dropped, those that tie with it are not.
4. Each task's best k per query meet in two rounds of ranking, by task group and then by query.

Defined results: a null or term-less text is no document of the collection; a null or term-less
item has no results; items that share an id, and repeated rows, are ranked one by one; a null
document id counts as the smallest; empty tables give no rows; other columns are ignored. Long
texts are cut between terms. Terms are compared by a 64-bit hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yearloom.llm import textarrays as ta
from yearloom.session import materialize

TOP = 50
SHARD_BYTES = 16 << 20
SEARCH_BYTES = 64 << 20  # of posting lists in a search task, beyond the cluster's cores
MAX_BLOCK_TERMS = 1 << 20  # distinct terms of a block of items
LEAF_POSTINGS = 1024
AT_ONCE = 16  # intervals looked at together
RANK_GROUPS = 64

BREAK = np.ones(256, bool)
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    BREAK[_a:_b] = False

_SHARD = "documents long, terms long, ids binary, no_id binary, lengths binary, term binary, size binary, doc binary, tf binary"
_SHARD_FIELDS = pa.schema([("documents", pa.int64()), ("terms", pa.int64()), *((f, pa.binary()) for f in ("ids", "no_id", "lengths", "term", "size", "doc", "tf"))])


def impacts(w: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Impacts of postings: term weights, occurrences, and the documents' length figures."""
    return w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def length_figures(lengths: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """50 and 50 times each document's length in mean lengths, rounded down."""
    if len(lengths) and 50 * int(lengths.max()) * documents >= 1 << 63:
        return np.array([50 + 50 * n * documents // terms for n in lengths.tolist()], np.int64)
    return 50 + (50 * lengths * documents) // max(terms, 1)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


# --- queries ---------------------------------------------------------------------------------------------------------

@ta.released
def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = ta.Powers()
    for batch in batches:
        found: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
        for rows, _, data, offsets in ta.cut_blocks(batch.column(1), space=BREAK):
            hashes, *_, counts = ta.word_hashes(data, offsets, powers, BREAK)
            for r, own in zip(rows.tolist(), np.split(hashes, np.cumsum(counts)[:-1])):
                found[r].append(np.unique(own))
        terms = [np.unique(np.concatenate(x)).view(np.int64) if x else np.zeros(0, np.int64) for x in found]
        yield pa.RecordBatch.from_pydict({"item_id": batch.column(0), "terms": pa.array(terms, pa.list_(pa.int64()))})


def query_table(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Items with their distinct terms, numbered and written once."""
    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    own = materialize(rows.mapInArrow(_item_terms, "item_id long, terms array<long>").where("size(terms) > 0"))
    return materialize(own.withColumn("item", F.monotonically_increasing_id()))


@dataclass
class Queries:
    """A block of items: the distinct terms of all (ascending hashes), and each one's terms."""

    items: list[int]
    terms: np.ndarray
    of_item: list[np.ndarray]


def query_blocks(queries: DataFrame, max_terms: int) -> Iterator[Queries]:
    """Blocks of items with about ``max_terms`` terms each; one block in memory at a time."""
    total = queries.agg(F.sum(F.size("terms"))).first()[0] or 0
    n = max(1, -(-total // max_terms))
    for k in range(n):
        rows = queries.select("item", "terms").where(F.pmod(F.xxhash64("item"), F.lit(n)) == k).toArrow().sort_by("item")
        if rows.num_rows:
            own = [np.array(t, np.int64).view(np.uint64) for t in rows["terms"].to_pylist()]
            terms = np.unique(np.concatenate(own))
            yield Queries(rows["item"].to_pylist(), terms, [np.searchsorted(terms, t) for t in own])


# --- posting lists ---------------------------------------------------------------------------------------------------

class ShardBuilder:
    """Posting lists of successive documents, for the query terms."""

    def __init__(self):
        self.documents = self.terms = self.bytes = self.rows = 0
        self.ids: list[int | None] = []
        self.lengths: list[np.ndarray] = []
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, doc: np.ndarray, term: np.ndarray) -> None:
        keys, counts = np.unique((term << 32) | doc, return_counts=True)
        self.keys.append(keys)
        self.counts.append(counts)

    def row(self) -> dict:
        lengths = np.concatenate(self.lengths) if self.lengths else np.zeros(0, np.int64)
        keys = np.concatenate(self.keys) if self.keys else np.zeros(0, np.int64)
        counts = np.concatenate(self.counts) if self.counts else np.zeros(0, np.int64)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        tf = np.add.reduceat(counts, first) if len(keys) else counts  # pieces of one long text add up
        term, doc = keys[first] >> 32, keys[first] & 0xFFFFFFFF
        held, doc = np.unique(doc, return_inverse=True)  # documents without any query term need no place
        terms, size = np.unique(term, return_counts=True)
        ids = [self.ids[d] for d in held.tolist()]
        return {"documents": int((lengths > 0).sum()), "terms": int(lengths.sum()), "ids": np.array([i or 0 for i in ids], np.int64).tobytes(),
                "no_id": np.array([i is None for i in ids], bool).tobytes(), "lengths": lengths[held].astype(np.int64).tobytes(),
                "term": terms.astype(np.int32).tobytes(), "size": size.astype(np.int32).tobytes(), "doc": doc.astype(np.int32).tobytes(),
                "tf": tf.astype(np.int32).tobytes()}


def _shards(raw, shard_bytes: int):
    @ta.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, powers, shard = raw.value, ta.Powers(), ShardBuilder()
        table = ta.hash_table(hashes, np.arange(len(hashes)))
        for batch in batches:
            docs = batch.column(1).to_pylist()
            before = -1
            for rows, _, data, offsets in ta.cut_blocks(batch.column(0), space=BREAK):
                new = rows != before if rows[0] == before else np.ones(len(rows), bool)
                if shard.bytes >= shard_bytes and new[0]:
                    yield pa.RecordBatch.from_pylist([shard.row()], _SHARD_FIELDS)
                    shard = ShardBuilder()
                words, *_, counts = ta.word_hashes(data, offsets, powers, BREAK)
                found, term = ta.table_get(table, words)
                local = shard.rows - (not new[0]) + np.arange(len(rows))
                shard.add(np.repeat(local, counts)[found], term[found])
                shard.ids += [docs[r] for r in rows[new].tolist()]
                if new[0]:
                    shard.lengths.append(counts.astype(np.int64))
                else:
                    shard.lengths[-1] = shard.lengths[-1].copy()
                    shard.lengths[-1][-1] += counts[0]
                shard.rows += int(new.sum())
                shard.bytes += len(data)
                before = rows[-1]
        if shard.rows:
            yield pa.RecordBatch.from_pylist([shard.row()], _SHARD_FIELDS)
    return run


def posting_lists(docs: DataFrame, terms: np.ndarray, id_col: str, text_col: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Shards of posting lists for these terms (ascending hashes), written once."""
    raw = docs.sparkSession.sparkContext.broadcast(terms)
    texts = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("doc_id"))
    return materialize(texts.mapInArrow(_shards(raw, shard_bytes), _SHARD))


@ta.released
def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: np.ndarray = np.zeros(0, np.int64)
    for batch in batches:
        for term, size in zip(batch.column(0), batch.column(1)):
            own, n = np.frombuffer(term.as_py(), np.int32), np.frombuffer(size.as_py(), np.int32)
            if len(own):
                total = np.pad(total, (0, max(0, int(own[-1]) + 1 - len(total))))
                total[own] += n
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"term": pa.array(held, pa.int64()), "df": pa.array(total[held], pa.int64())})


@dataclass
class Collection:
    """Figures of all documents: their number, their terms, and the query terms' weights."""

    documents: int
    terms: int
    weights: np.ndarray


def collection(postings: DataFrame, n_terms: int) -> Collection:
    documents, terms = postings.agg(F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()
    counts = postings.select("term", "size").mapInArrow(_document_counts, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    weights = np.zeros(n_terms, np.int64)
    weights[counts["term"].to_numpy()] = [weight(documents, df) for df in counts["df"].to_pylist()]
    return Collection(documents, terms, weights)


# --- search ----------------------------------------------------------------------------------------------------------

class RangeMaxima:
    """Sparse tables over several lists side by side in one array: the place of the maximum of every run of 2^k values of a list."""

    def __init__(self, values: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        self.values = values
        list_of = np.repeat(np.arange(len(starts)), sizes)
        local = np.arange(len(values)) - np.repeat(starts, sizes)
        place = np.arange(len(values), dtype=np.int32)
        self.levels, self.bases = [place], [starts.astype(np.int64)]
        step = 1
        while len(sizes) and 2 * step <= sizes.max():
            here = local + 2 * step <= sizes[list_of]
            at = np.flatnonzero(here)
            left, right = place[at], place[at + step]
            place = np.where(values[right] > values[left], right, left)
            list_of, local = list_of[at], local[at]
            self.levels.append(place)
            self.bases.append(np.searchsorted(list_of, np.arange(len(starts))))
            step *= 2
        self.flat = np.concatenate(self.levels)
        level_at = np.cumsum([0] + [len(x) for x in self.levels])[:-1]
        self.base = np.stack([b + a for a, b in zip(level_at, self.bases)])  # level x list
        self.starts = starts
        del self.levels, self.bases

    def places(self, lists: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place of the largest value of each list in the places from a to b (-1 where a = b)."""
        size = b - a
        level = np.frexp(np.maximum(size, 1).astype(np.float64))[1] - 1
        base = self.base[level, lists] - self.starts[lists]
        some = size > 0
        left = self.flat[np.where(some, base + a, 0)]
        right = self.flat[np.where(some, base + b - (1 << level), 0)]
        return np.where(some, np.where(self.values[right] > self.values[left], right, left), -1)


class Shard:
    """A shard's posting lists with impacts and their range maxima."""

    def __init__(self, row: dict, figures: Collection):
        self.ids, self.no_id = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["no_id"], bool)
        self.term, self.size = np.frombuffer(row["term"], np.int32), np.frombuffer(row["size"], np.int32).astype(np.int64)
        self.doc = np.frombuffer(row["doc"], np.int32)
        self.starts = np.cumsum(self.size) - self.size
        m = length_figures(np.frombuffer(row["lengths"], np.int64), figures.documents, figures.terms)
        tf = np.frombuffer(row["tf"], np.int32).astype(np.int64)
        self.impact = impacts(np.repeat(figures.weights[self.term], self.size), tf, m[self.doc])
        self.maxima = RangeMaxima(self.impact, self.starts, self.size)
        self.line = np.repeat(np.arange(len(self.term)), self.size) * (len(self.ids) + 1) + self.doc  # ascending: list, document

    def split(self, lists: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For each interval's document: the first place of each list with that document or a later one."""
        return np.searchsorted(self.line, lists[None, :] * (len(self.ids) + 1) + at[:, None])


class Best:
    """A query's best documents so far."""

    def __init__(self, k: int):
        self.k = k
        self.score = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        self.known = np.zeros(0, bool)
        self.least = 1  # scores below it can't be among the best any more

    def add(self, score: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        good = score >= self.least
        if not good.any():
            return
        self.score, self.id = np.concatenate([self.score, score[good]]), np.concatenate([self.id, ids[good]])
        self.known = np.concatenate([self.known, ~no_id[good]])
        if len(self.score) > self.k:
            order = np.lexsort((self.id, self.known, -self.score))[:self.k]
            self.score, self.id, self.known = self.score[order], self.id[order], self.known[order]
        if len(self.score) == self.k:
            self.least = max(1, int(self.score.min()))


def search_shard(shard: Shard, terms: np.ndarray, best: Best) -> int:
    """Add the shard's documents to a query's best ones; returns how many intervals were looked at."""
    lists = ta.lookup(shard.term, terms.astype(np.int32))
    lists = lists[lists >= 0]
    if not len(lists):
        return 0
    a, b = shard.starts[lists][None, :], (shard.starts + shard.size)[lists][None, :]
    place = shard.maxima.places(np.broadcast_to(lists, a.shape), a, b)
    bound = shard.impact[place].sum(1)
    looked = 0
    while True:
        live = bound >= best.least
        if not live.all():
            a, b, place, bound = a[live], b[live], place[live], bound[live]
        if not len(bound):
            return looked
        if len(bound) > AT_ONCE:
            top = np.argpartition(-bound, AT_ONCE)[:AT_ONCE]
            rest = np.ones(len(bound), bool)
            rest[top] = False
            now_a, now_b, now_place = a[top], b[top], place[top]
            a, b, place, bound = a[rest], b[rest], place[rest], bound[rest]
        else:
            now_a, now_b, now_place = a, b, place
            a, b, place, bound = a[:0], b[:0], place[:0], bound[:0]
        looked += len(now_a)
        size = now_b - now_a
        leaf = size.sum(1) <= LEAF_POSTINGS
        if leaf.any():
            n, start = size[leaf].ravel(), now_a[leaf].ravel()
            total = np.cumsum(n)
            at = np.arange(total[-1]) + np.repeat(start - (total - n), n)
            docs, inverse = np.unique(shard.doc[at], return_inverse=True)
            score = np.zeros(len(docs), np.int64)
            np.add.at(score, inverse, shard.impact[at])
            best.add(score, shard.ids[docs], shard.no_id[docs])
            now_a, now_b, now_place = now_a[~leaf], now_b[~leaf], now_place[~leaf]
        if not len(now_a):
            continue
        impact = np.where(now_place >= 0, shard.impact[now_place], -1)
        doc = shard.doc[now_place[np.arange(len(now_a)), impact.argmax(1)]].astype(np.int64)
        middle = np.clip(shard.split(lists, doc), now_a, now_b)
        own = (middle < now_b) & (shard.doc[np.minimum(middle, len(shard.doc) - 1)] == doc[:, None])
        best.add(np.where(own, shard.impact[np.minimum(middle, len(shard.doc) - 1)], 0).sum(1), shard.ids[doc], shard.no_id[doc])
        child_a, child_b = np.concatenate([now_a, middle + own]), np.concatenate([middle, now_b])
        child = shard.maxima.places(np.broadcast_to(lists, child_a.shape), child_a, child_b)
        value = np.where(child >= 0, shard.impact[child], 0).sum(1)
        a, b, place, bound = np.concatenate([a, child_a]), np.concatenate([b, child_b]), np.concatenate([place, child]), np.concatenate([bound, value])


def _search(raw, top: int):
    @ta.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, figures = raw.value
        best = [Best(top) for _ in queries.items]
        group = TaskContext.get().partitionId() % RANK_GROUPS
        for batch in batches:
            for k in range(batch.num_rows):
                shard = Shard(batch.slice(k, 1).to_pylist()[0], figures)
                for terms, own in zip(queries.of_item, best):
                    search_shard(shard, terms, own)
        for item, own in zip(queries.items, best):
            if len(own.score):
                yield pa.RecordBatch.from_pydict({
                    "item": pa.array([item] * len(own.score), pa.int64()), "task_group": pa.array([group] * len(own.score), pa.int32()),
                    "doc_id": pa.array(own.id, pa.int64(), mask=~own.known), "score": pa.array(own.score, pa.int64())})
    return run


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
           top: int = TOP, max_block_terms: int = MAX_BLOCK_TERMS) -> DataFrame:
    """Every item's ``top`` best documents: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    queries = query_table(items, item_id, item_text)
    found = spark.createDataFrame([], "item long, task_group int, doc_id long, score long")
    for block in query_blocks(queries, max_block_terms):
        postings = posting_lists(docs, block.terms, id_col, text_col)
        figures = collection(postings, len(block.terms))
        size = postings.agg(F.sum(F.octet_length("doc"))).first()[0] or 0
        tasks = max(spark.sparkContext.defaultParallelism, -(-2 * size // SEARCH_BYTES))
        raw = spark.sparkContext.broadcast((block, figures))
        found = found.union(postings.coalesce(tasks).mapInArrow(_search(raw, top), "item long, task_group int, doc_id long, score long"))
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    for keys in (["item", "task_group"], ["item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return found.join(queries.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
