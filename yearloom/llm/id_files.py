"""Token-id files with Elias-Fano encoded document boundaries.

A file holds the ids of successive documents in one array of 2- or 4-byte numbers (the narrowest
that holds the vocabulary), and behind it a footer with two ascending lists as Elias-Fano codes:
the documents' ends in the array, and the document ids less the smallest. A list of ``n`` numbers
up to ``u`` takes about ``2 + log2(u / n)`` bits a number: the low ``l = floor(log2(u / n))`` bits of
each side by side, the rest as gaps in unary. ``select`` finds a number by itself: the place of
every ``SELECT_STEP``-th one is kept (32 bits), and the few bytes from there on are counted. So a
document is found and read from a file of any length without a table of 64-bit offsets.

Layout, little-endian: ids; footer (``FOOTER`` numbers, then per list: low bits, unary bits, select
places); the footer's length (8 bytes); ``MAGIC``.

Writing: documents are sorted over the cluster (ascending id), and every task writes its run of
them, opening a new file after ``file_ids`` ids; it holds the boundaries of one file, and the ids of
one document. Names carry a number of their own for each attempt, and only files that a finished
task reported are in the manifest, a Parquet table beside them. A file's place in the order is its
task's and its own number; the ids before it are added up in two levels over the manifest.

Defined results: a null text is empty and has the end id alone; documents with a null id come
first, in the order of their texts' hashes, as do others that share an id; repeated rows are
written one by one; an empty table gives an empty manifest; other columns are ignored. Ids beyond
a signed 64-bit number can't occur. Texts of any length are encoded in pieces.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yearloom.llm import textarrays as ta
from yearloom.llm import word_ids

MAGIC = b"idfile01"
FOOTER = "<QQQqB7x"  # documents, ids, documents without an id, smallest id, bytes an id
LIST = "<QQQ"  # numbers, low bits of each, bytes of the unary part
SELECT_STEP = 256
FILE_IDS = 32 << 20
READ_IDS = 1 << 22
GROUP_FILES = 1024
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


@dataclass
class EliasFano:
    """An ascending list of whole numbers from 0 up."""

    n: int
    bits: int
    low: np.ndarray  # packed low bits
    high: np.ndarray  # unary part, one bit a number and one a step of the high part
    places: np.ndarray  # bit numbers of ones 0, SELECT_STEP, 2 SELECT_STEP ... in the unary part

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        values = values.astype(np.uint64)
        bits = max(0, int(values[-1]) // n).bit_length() - 1 if n and int(values[-1]) >= n else 0
        lows = values & np.uint64((1 << bits) - 1)
        low = np.zeros(-(-n * bits // 8), np.uint8)
        for a in range(0, n, 1 << 16):  # eight numbers fill whole bytes
            own = lows[a:a + (1 << 16)]
            packed = np.packbits((own[:, None] >> np.arange(bits, dtype=np.uint64)).astype(np.uint8).ravel() & 1, bitorder="little")
            low[a * bits // 8:a * bits // 8 + len(packed)] = packed
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(ones[-1]) // 8 + 1) if n else 0, np.uint8)
        np.bitwise_or.at(high, ones >> 3, (1 << (ones & 7)).astype(np.uint8))
        if n and ones[-1] >= 1 << 32:
            raise ValueError("too many numbers for one list")
        return cls(n, bits, low, high, ones[::SELECT_STEP].astype("<u4"))

    def to_bytes(self) -> bytes:
        return struct.pack(LIST, self.n, self.bits, len(self.high)) + self.low.tobytes() + self.high.tobytes() + self.places.tobytes()

    @classmethod
    def from_bytes(cls, raw: memoryview) -> tuple[EliasFano, memoryview]:
        n, bits, size = struct.unpack_from(LIST, raw)
        a = struct.calcsize(LIST)
        b = a + -(-n * bits // 8)
        c = b + size
        d = c + 4 * -(-n // SELECT_STEP)
        return cls(n, bits, np.frombuffer(raw[a:b], np.uint8), np.frombuffer(raw[b:c], np.uint8), np.frombuffer(raw[c:d], "<u4")), raw[d:]

    def select(self, k: int) -> int:
        """Bit number of one ``k`` in the unary part."""
        place = int(self.places[k // SELECT_STEP])
        left = k % SELECT_STEP
        byte = place >> 3
        first = int(self.high[byte]) >> (place & 7) << (place & 7)
        while left >= (ones := first.bit_count()):
            left -= ones
            chunk = _ONES[self.high[byte + 1:byte + 65]]
            total = np.cumsum(chunk)
            skip = int(np.searchsorted(total, left, "right"))
            left -= int(total[skip - 1]) if skip else 0
            byte += skip + 1
            first = int(self.high[byte]) if skip < len(chunk) else 0
            if skip == len(chunk):
                byte -= 1  # go on with the next bytes
        for _ in range(left):
            first &= first - 1
        return byte * 8 + (first & -first).bit_length() - 1

    def __getitem__(self, k: int) -> int:
        if not 0 <= k < self.n:
            raise IndexError(k)
        a = k * self.bits
        raw = int.from_bytes(self.low[a >> 3:(a + self.bits + 7) >> 3].tobytes(), "little")
        return (self.select(k) - k) << self.bits | (raw >> (a & 7)) & ((1 << self.bits) - 1)

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        out = ((ones - np.arange(self.n)).astype(np.uint64)) << np.uint64(self.bits)
        if self.bits:
            lows = np.unpackbits(self.low, bitorder="little", count=self.n * self.bits).reshape(self.n, self.bits)
            for k in range(self.bits):
                out |= lows[:, k].astype(np.uint64) << np.uint64(k)
        return out


class Writer:
    """One file: documents' ids as they come, the footer at the end."""

    def __init__(self, stream, width: int):
        self.stream, self.type = stream, np.dtype("<u2" if width == 2 else "<u4")
        self.ids: list[int | None] = []
        self.ends: list[int] = []
        self.size = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.stream.write(np.ascontiguousarray(ids.astype(self.type)))
        self.size += len(ids)
        self.ids.append(doc_id)
        self.ends.append(self.size)

    def close(self) -> None:
        known = np.array([i for i in self.ids if i is not None], np.int64)
        least = int(known[0]) if len(known) else 0
        footer = struct.pack(FOOTER, len(self.ids), self.size, len(self.ids) - len(known), least, self.type.itemsize)
        footer += EliasFano.encode(np.array(self.ends, np.uint64)).to_bytes()
        footer += EliasFano.encode(known.astype(np.uint64) - np.uint64(least % (1 << 64))).to_bytes()
        self.stream.write(footer + struct.pack("<Q", len(footer)) + MAGIC)
        self.stream.close()


class IdFile:
    """An open file; ``document(k)`` reads one document's ids, ``documents()`` all of them in turn."""

    def __init__(self, stream):
        self.stream = stream
        size = stream.size()
        stream.seek(size - 16)
        tail = stream.read(16)
        if tail[8:] != MAGIC:
            raise ValueError("not a file of token ids, or not a whole one")
        length = struct.unpack("<Q", tail[:8])[0]
        stream.seek(size - 16 - length)
        raw = memoryview(stream.read(length))
        self.n, self.size, self.nulls, self.least, width = struct.unpack_from(FOOTER, raw)
        self.type = np.dtype("<u2" if width == 2 else "<u4")
        self.ends, raw = EliasFano.from_bytes(raw[struct.calcsize(FOOTER):])
        self.ids, _ = EliasFano.from_bytes(raw)

    def read(self, a: int, b: int) -> np.ndarray:
        self.stream.seek(a * self.type.itemsize)
        return np.frombuffer(self.stream.read((b - a) * self.type.itemsize), self.type)

    def doc_id(self, k: int) -> int | None:
        return None if k < self.nulls else self.least + self.ids[k - self.nulls]

    def document(self, k: int) -> np.ndarray:
        return self.read(self.ends[k - 1] if k else 0, self.ends[k])

    def doc_ids(self) -> pa.Array:
        known = (self.ids.all() + np.uint64(self.least % (1 << 64))).view(np.int64)
        return pa.array(np.concatenate([np.zeros(self.nulls, np.int64), known]), mask=np.arange(self.n) < self.nulls)

    def documents(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(number, start, ids) of every document, from reads of about ``READ_IDS`` ids."""
        ends = self.ends.all().astype(np.int64)
        k = 0
        while k < self.n:
            a = int(ends[k - 1]) if k else 0
            last = max(k + 1, int(np.searchsorted(ends, a + READ_IDS, "right")))
            ids = self.read(a, int(ends[last - 1]))
            for j in range(k, last):
                b = int(ends[j - 1]) if j else 0
                yield j, b, ids[b - a:int(ends[j]) - a]
            k = last


def _place(uri: str):
    """File system and path of a folder's URI (file, hdfs, s3, ...), as seen by the task."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else uri.replace("file:", "file://", 1))


def _writing(raw, end_id: int, folder: str, width: int, file_ids: int):
    @ta.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids.Encoder(raw.value, end_id)
        system, path = _place(folder)
        part, writer, name, found = TaskContext.get().partitionId(), None, "", []

        def finish():
            writer.close()
            found.append((part, len(found), name, len(writer.ids), writer.size))

        for batch in batches:
            docs = batch.column(1).to_pylist()
            for r, ids in encoder.texts(batch.column(0)):
                if writer is None:
                    name = f"part-{part:06d}-{len(found):04d}-{uuid.uuid4().hex}.ids"
                    system.create_dir(path, recursive=True)
                    writer = Writer(system.open_output_stream(f"{path}/{name}"), width)
                writer.add(docs[r], ids)
                if writer.size >= file_ids:
                    finish()
                    writer = None
        if writer is not None:
            finish()
        yield pa.RecordBatch.from_pylist([dict(zip(("part", "number", "file", "n_docs", "n_ids"), x)) for x in found], pa.schema(
            [("part", pa.int32()), ("number", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))
    return run


def write_ids(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str, id_col: str = "doc_id", text_col: str = "text",
              file_ids: int = FILE_IDS) -> DataFrame:
    """Encode ``docs`` and write their files into ``folder`` (a URI that all executors reach). Returns the manifest, written to
    ``folder/manifest`` last: part, number, file, n_docs, n_ids."""
    spark = docs.sparkSession
    with open(tokenizer_path, "rb") as f:  # a few MB; tasks get it by broadcast
        rules = word_ids.learn_rules(f.read())
    raw = spark.sparkContext.broadcast(rules)
    whole, _ = word_ids._tokenizers(rules.json)
    width = 2 if max(end_id, *whole.get_vocab().values()) < 1 << 16 else 4
    texts = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("doc_id"))
    ordered = texts.withColumn("row", F.monotonically_increasing_id()).orderBy("doc_id", F.xxhash64("text"), "row").drop("row")
    written = ordered.mapInArrow(_writing(raw, end_id, folder, width, file_ids), "part int, number int, file string, n_docs long, n_ids long")
    written.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest plus ``start``: the ids in all files before this one. Added up within groups of parts, then over the groups."""
    group = F.expr(f"part div {GROUP_FILES}")
    sums = manifest.groupBy(group.alias("g")).agg(F.sum("n_ids").alias("n"))
    heads = sums.select("g", F.coalesce(F.sum("n").over(Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("head"))
    own = Window.partitionBy("g").orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    inside = manifest.withColumn("g", group).withColumn("inside", F.coalesce(F.sum("n_ids").over(own), F.lit(0)))
    return inside.join(heads, "g").withColumn("start", F.col("head") + F.col("inside")).drop("g", "head", "inside")


def _reading(folder: str, with_ids: bool):
    @ta.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _place(folder)
        for batch in batches:
            for f in batch.to_pylist():
                with system.open_input_file(f"{path}/{f['file']}") as stream:
                    file = IdFile(stream)
                    if (file.n, file.size) != (f["n_docs"], f["n_ids"]):
                        raise ValueError(f"{f['file']} isn't the file of the manifest")
                    ids, rows = file.doc_ids(), []

                    def out():
                        first = rows[0][0]
                        own = {"doc_id": ids.slice(first, len(rows)), "start": pa.array([f["start"] + x[1] for x in rows], pa.int64()),
                               "n_tokens": pa.array([x[2] for x in rows], pa.int64()), "ids_crc32": pa.array([x[3] for x in rows], pa.int64())}
                        if with_ids:
                            own["ids"] = pa.array([x[4] for x in rows], pa.list_(pa.int32()))
                        return pa.RecordBatch.from_pydict(own)

                    held = 0
                    for k, start, own in file.documents():
                        rows.append((k, start, len(own), zlib.crc32(own.astype("<u4").tobytes()), own.astype(np.int32) if with_ids else None))
                        held += 1 + (len(own) >> 8 if with_ids else 0)
                        if held >= 10_000:
                            yield out()
                            rows, held = [], 0
                    if rows:
                        yield out()
    return run


def read_ids(manifest: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """Every document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, ids."""
    spark = manifest.sparkSession
    files = with_starts(manifest).select("file", "n_docs", "n_ids", "start")
    spread = files.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), F.xxhash64("file"))
    return spread.mapInArrow(_reading(folder, with_ids), "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)
