"""Line deduplication with two Bloom filters.

1. Every task hashes the keys of its long lines (distinct within a document) and
   sends the hashes, packed, to the owner of their part of the hash space. The
   owner fills two Bloom filters: a hash already in the once-seen filter enters the
   twice-seen filter.
2. The twice-seen filter is broadcast (its size is a parameter's bound, whatever
   the corpus). Only lines that it suspects are shuffled: a digest of the key, and
   per task at most ``min_docs`` of the largest documents that hold it. They
   give the exact number of documents (up to ``min_docs``) and the document that
   keeps the line.
3. Lines with a confirmed key go, except in the keeping document. Up to
   ``max_broadcast_keys`` confirmed keys are broadcast; beyond, the suspected
   occurrences join them (salted, for keys with very many occurrences).

A full filter only suspects more; the result stays exact.

Defined results: a null text stays null and counts as one empty line; a null
document id counts as one document, smaller than all others; rows that share a
document id count as one document; an empty table gives no rows; other columns
pass through (one with the name of an added column is replaced).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yearloom.llm import textarrays as ta
from yearloom.session import materialize, row_count_at_most

MIN_CHARS = 20
MIN_DOCS = 3
BITS_PER_LINE = 16
PROBES = 4
MAX_FILTER_BYTES = 64 << 20
MAX_BROADCAST_KEYS = 1_000_000
SEGMENTS = 64  # parts of the hash space, each filled by one owner
SALTS = 16
NO_ID = -(1 << 63)


def _line_spans(data: np.ndarray, offsets: np.ndarray):
    """Rows' numbers of lines, and every line's start, end, and stripped start and end."""
    breaks = np.flatnonzero(data == 10)
    counts = ta.per_row(breaks, offsets) + 1
    rows = np.repeat(np.arange(len(counts)), counts)
    starts, ends = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
    last = np.cumsum(counts) - 1
    first = last - counts + 1
    inner = np.ones(len(rows), bool)
    inner[last] = False
    ends[inner], ends[last] = breaks, offsets[1:]
    inner[:] = True
    inner[first] = False
    starts[inner], starts[first] = breaks + 1, offsets[:-1]
    solid = np.flatnonzero(~ta.SPACE[data])
    at = np.searchsorted(solid, starts)
    until = np.searchsorted(solid, ends)
    full = until > at
    left, right = starts.copy(), starts.copy()
    left[full], right[full] = solid[at[full]], solid[until[full] - 1] + 1
    return counts, rows, starts, ends, left, right


def _long_lines(data, offsets, min_chars, powers):
    """As ``_line_spans``, with the positions of the lines that count and their hashes."""
    counts, rows, starts, ends, left, right = _line_spans(data, offsets)
    points = ta.code_points(data)
    long = np.flatnonzero(points[right] - points[left] >= min_chars)
    hashes = ta.span_hashes(ta.prefix_sums(data, powers), left[long], right[long], powers)
    return counts, rows, starts, ends, left, right, long, hashes


def _probes(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    step = ta.mix(hashes) | np.uint64(1)
    return [(hashes + np.uint64(j) * step) % np.uint64(bits) for j in range(PROBES)]


def _suspected(twice: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes are in the twice-seen filter (bytes, one row a segment)."""
    segment = (hashes >> np.uint64(58)).astype(np.int64)
    found = np.ones(len(hashes), bool)
    for p in _probes(hashes, 8 * twice.shape[1]):
        found &= (twice[segment, (p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


def _hash_blocks(min_chars: int):
    @ta.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = ta.Powers()
        for batch in batches:
            once, lines = [], 0
            for _, _, data, offsets in ta.blocks(batch.column(0)):
                counts, rows, *_, long, hashes = _long_lines(data, offsets, min_chars, powers)
                lines += int(counts.sum())
                order = np.lexsort((hashes, rows[long]))
                h, r = hashes[order], rows[long][order]
                once.append(h[np.concatenate([[True], (h[1:] != h[:-1]) | (r[1:] != r[:-1])])] if len(h) else h)
            h, n = np.unique(np.concatenate(once or [np.zeros(0, np.uint64)]), return_counts=True)
            cuts = np.searchsorted(h, np.arange(SEGMENTS, dtype=np.uint64) << np.uint64(58)).tolist() + [len(h)]
            some = [k for k in range(SEGMENTS) if cuts[k + 1] > cuts[k]]
            yield pa.RecordBatch.from_pydict({
                "segment": pa.array(some, pa.int32()),
                "n": pa.array([cuts[k + 1] - cuts[k] for k in some], pa.int64()),
                "hashes": pa.array([h[cuts[k]:cuts[k + 1]].tobytes() for k in some], pa.binary()),
                "again": pa.array([np.packbits(n[cuts[k]:cuts[k + 1]] > 1).tobytes() for k in some], pa.binary())})
    return run


def _fill(bits: int):
    """Blocks of one segment after another -> its twice-seen filter."""
    @ta.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for segment, n, raw, again in zip(*(batch.column(k).to_pylist() for k in ("segment", "n", "hashes", "again"))):
                once, twice = filters.setdefault(segment, (np.zeros(bits, bool), np.zeros(bits, bool)))
                probes = _probes(np.frombuffer(raw, np.uint64), bits)
                seen = np.unpackbits(np.frombuffer(again, np.uint8), count=n).astype(bool)
                seen |= np.logical_and.reduce([once[p] for p in probes])
                for p in probes:
                    once[p] = True
                    twice[p[seen]] = True
        yield pa.RecordBatch.from_pydict({
            "segment": pa.array(list(filters), pa.int32()),
            "bits": pa.array([np.packbits(t, bitorder="little").tobytes() for _, t in filters.values()], pa.binary())})
    return run


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)


def _digest(data: np.ndarray, left: int, right: int) -> bytes:
    return hashlib.blake2b(ta.LOWER[data[left:right]].tobytes(), digest_size=16).digest()


def _suspects(bloom, min_chars: int, min_docs: int | None):
    """Rows (digest, doc_id) of the suspected lines. With ``min_docs`` a task keeps each key's ``min_docs`` largest ids."""
    @ta.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, twice = ta.Powers(), bloom.value
        found: dict[bytes, list[int]] = {}
        for batch in batches:
            ids = _ids(batch.column(1))
            every: set[tuple[bytes, int]] = set()
            for first, _, data, offsets in ta.blocks(batch.column(0)):
                _, rows, _, _, left, right, long, hashes = _long_lines(data, offsets, min_chars, powers)
                for k in long[_suspected(twice, hashes)].tolist():
                    key, doc = _digest(data, left[k], right[k]), int(ids[first + rows[k]])
                    if min_docs is None:
                        every.add((key, doc))
                        continue
                    held = found.setdefault(key, [])
                    if doc not in held:
                        held.append(doc)
                        if len(held) > min_docs:
                            held.remove(min(held))
            if every:
                yield pa.RecordBatch.from_pydict({"digest": pa.array([k for k, _ in every], pa.binary()),
                                                  "doc": pa.array([d for _, d in every], pa.int64())})
        pairs = [(k, d) for k, held in found.items() for d in held]
        yield pa.RecordBatch.from_pydict({"digest": pa.array([k for k, _ in pairs], pa.binary()),
                                          "doc": pa.array([d for _, d in pairs], pa.int64())})
    return run


def _confirmed_arrays(digests: list[bytes], keepers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Confirmed digests in two halves, ascending, and their keeping documents."""
    halves = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    return halves[order, 0], halves[order, 1], keepers[order]


def _keeper(keys: tuple[np.ndarray, np.ndarray, np.ndarray], digest: bytes) -> int | None:
    high, low = np.frombuffer(digest, np.uint64)
    for k in range(int(np.searchsorted(keys[0], high)), len(keys[0])):
        if keys[0][k] != high:
            return None
        if keys[1][k] == low:
            return int(keys[2][k])
    return None


def _drop(bloom, confirmed, names: list[str], text_at: int, id_at: int, min_chars: int, drops_at: int | None):
    """Rows with the confirmed lines left out, and their counts of lines before and dropped. With ``drops_at`` the digests
    to drop come with the row, in that column, which goes."""
    @ta.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, twice = ta.Powers(), bloom.value
        keys = confirmed.value if confirmed is not None else None
        for batch in batches:
            column, ids = batch.column(text_at), _ids(batch.column(id_at))
            own = [set(x or ()) for x in batch.column(drops_at).to_pylist()] if drops_at is not None else None
            n_lines, n_dropped, new = np.zeros(len(column), np.int64), np.zeros(len(column), np.int64), {}
            for first, _, data, offsets in ta.blocks(column):
                counts, rows, starts, ends, left, right, long, hashes = _long_lines(data, offsets, min_chars, powers)
                n_lines[first:first + len(counts)] = counts
                gone: dict[int, set[int]] = {}
                for k in long[_suspected(twice, hashes)].tolist():
                    row, digest = int(rows[k]), _digest(data, left[k], right[k])
                    if own is not None:
                        out = digest in own[first + row]
                    else:
                        keeper = _keeper(keys, digest)
                        out = keeper is not None and keeper != ids[first + row]
                    if out:
                        gone.setdefault(row, set()).add(k)
                begin = np.cumsum(counts) - counts
                for row, lines in gone.items():
                    n_dropped[first + row] = len(lines)
                    new[first + row] = b"\n".join(data[starts[k]:ends[k]].tobytes() for k in range(begin[row], begin[row] + counts[row])
                                                  if k not in lines).decode()
            if new:
                texts = column.to_pylist()
                for row, text in new.items():
                    texts[row] = text
                column = pa.array(texts, column.type)
            kept = [column if k == text_at else batch.column(k) for k in range(batch.num_columns) if k != drops_at]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(n_lines), pa.array(n_dropped)], names=names)
    return run


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                max_filter_bytes: int = MAX_FILTER_BYTES, max_broadcast_keys: int = MAX_BROADCAST_KEYS) -> DataFrame:
    """``docs`` without repeated lines, plus ``n_lines`` (before) and ``n_dropped``.
    A key is a line stripped of ``[\\x20\\x09-\\x0D]`` and with A-Z lower-cased; keys of at least ``min_chars`` code points
    in at least ``min_docs`` documents stay only in the largest document id. Runs the jobs that find those keys."""
    spark = docs.sparkSession
    added = ("n_lines", "n_dropped")
    docs = docs.select(*[docs[c] for c in dict.fromkeys(docs.columns) if c.lower() not in added])
    texts = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("doc"))

    blocks = materialize(texts.select("text").mapInArrow(_hash_blocks(min_chars), "segment int, n long, hashes binary, again binary"))
    lines = blocks.agg(F.sum("n")).first()[0] or 0
    bits = min(max(lines * BITS_PER_LINE, 1 << 16), 8 * max_filter_bytes) // SEGMENTS // 8 * 8
    owners = min(SEGMENTS, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    parts = blocks.repartition(owners, "segment").mapInArrow(_fill(bits), "segment int, bits binary").collect()  # at most max_filter_bytes
    twice = np.zeros((SEGMENTS, bits // 8), np.uint8)
    for r in parts:
        twice[r["segment"]] = np.frombuffer(r["bits"], np.uint8)
    bloom = spark.sparkContext.broadcast(twice)

    pairs = texts.mapInArrow(_suspects(bloom, min_chars, min_docs), "digest binary, doc long").distinct()
    confirmed = materialize(pairs.groupBy("digest").agg(F.count("doc").alias("n"), F.max("doc").alias("keeper"))
                            .where(F.col("n") >= min_docs).select("digest", "keeper"))

    schema = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType(), False), T.StructField("n_dropped", T.LongType(), False)])
    names = schema.fieldNames()
    text_at, id_at = docs.columns.index(text_col), docs.columns.index(id_col)
    if row_count_at_most(confirmed, max_broadcast_keys):
        rows = confirmed.toArrow()
        keys = spark.sparkContext.broadcast(_confirmed_arrays(rows["digest"].to_pylist(), rows["keeper"].to_numpy()))
        return docs.mapInArrow(_drop(bloom, keys, names, text_at, id_at, min_chars, None), schema)

    places = texts.mapInArrow(_suspects(bloom, min_chars, None), "digest binary, doc long").distinct()
    salted = places.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)))
    spread = confirmed.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    drops = (salted.join(spread, ["digest", "salt"]).where("doc <> keeper").groupBy("doc").agg(F.collect_set("digest").alias("_drops"))
             .withColumnRenamed("doc", "_doc"))
    joined = docs.join(drops, F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)) == drops["_doc"], "left").drop("_doc")
    return joined.mapInArrow(_drop(bloom, None, names, text_at, id_at, min_chars, len(joined.columns) - 1), schema)
