"""Benchmark decontamination by the q-gram lemma.

Texts are compared in a plain form: A-Z lower-cased, every run of ASCII characters that
are neither letters nor digits as one space. Lengths are code points of that form. A benchmark
item leaks into a document if a window of ``w`` of its characters (the whole item, if shorter than
``WINDOW``) aligns with the document with at most ``e`` edits, ``e`` a share ``EDIT_RATE`` of ``w``. By
the q-gram lemma such a window shares at least ``w - q + 1 - q e`` q-grams with the document, on
diagonals that differ by at most ``e``. Items under ``SHORT_ITEM`` must occur as they are, between
word ends.

Per task, with the items' q-grams broadcast: positions with a known q-gram are found for
whole blocks; those in stretches too poor in them are dropped; the rest are counted in
overlapping bands of ``2 (e + 1)`` diagonals, per item, so that any alignment within the budget
runs inside one band. Runs of places where enough of them lie within ``w + e`` characters are
candidates: banded alignment along all diagonals of the band tries the windows at both ends of a
candidate, and where these fail every window that could hold enough of its q-grams.

Items are broadcast in blocks of about ``MAX_ITEM_BYTES`` of text, one pass over the
documents a block.

Defined results: null or empty texts leak nothing; null items and those shorter than ``Q`` in the
plain form are skipped; items with a null id are searched as well, and reported with a null id;
items that share an id (or have none) count as one (in different blocks of a large table: regions
of their different texts are reported one by one); repeated rows are judged one by one; an empty
table of documents or items gives no matches; other columns pass through unread.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.llm import textarrays as ta
from yearloom.session import materialize

Q = 8
WINDOW = 80
EDIT_RATE = 0.075
SHORT_ITEM = 25
MAX_ITEM_BYTES = 16 << 20
FILTER_BITS = 22
ALIGN_AT_ONCE = 20_000
CANDIDATES_AT_ONCE = 2_000

_PLAIN = np.full(256, 0x20, np.uint8)
for _a, _b in ((48, 58), (97, 123), (128, 256)):
    _PLAIN[_a:_b] = np.arange(_a, _b)
_PLAIN[65:91] = np.arange(97, 123)


def plain(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Plain forms of a block of texts: their bytes, row offsets, and each byte's place in the block."""
    form = _PLAIN[data]
    word = form != 0x20
    keep = word.copy()
    keep[1:] |= word[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    keep[first] = word[first]
    at = np.flatnonzero(keep)
    return form[at], np.searchsorted(at, offsets), at


def code_point_form(form: np.ndarray, offsets: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``plain``'s result by code points instead of bytes (place: of each one's first byte)."""
    if not len(form) or form.max() < 128:
        return form, offsets, place
    at = np.flatnonzero((form & 0xC0) != 0x80)
    return np.frombuffer(form.tobytes().decode().encode("utf-32-le"), np.uint32), np.searchsorted(at, offsets), place[at]


def qgrams(form: np.ndarray) -> np.ndarray:
    """The 8 code points from each position on as one number (0 for the last seven)."""
    x = form.astype(np.uint64)
    out = np.zeros(len(form), np.uint64)
    if len(form) >= Q:
        x = x[:-1] * np.uint64(0x9E3779B97F4A7C15) + x[1:]
        x = x[:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + x[2:]
        out[:len(form) - Q + 1] = ta.mix(x[:-4] * np.uint64(0xD6E8FEB86659FD93) + x[4:])
    return out


def budget(length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window, edits and least number of shared q-grams for items of these lengths."""
    w = np.minimum(length, WINDOW)
    e = np.where(length < SHORT_ITEM, 0, np.minimum((w * EDIT_RATE).astype(np.int64), (w - Q) // Q))
    return w, e, w - Q + 1 - Q * e


@dataclass
class Items:
    """An index of plain items' q-grams. ``keys`` numbers the items' ids; items of one id share a number."""

    ids: list
    keys: np.ndarray
    form: np.ndarray
    offsets: np.ndarray

    @classmethod
    def from_texts(cls, ids: list, column: pa.Array) -> Items:
        data, offsets = ta.string_buffers(column)
        form, at, _ = code_point_form(*plain(data, offsets))
        numbers: dict = {}
        keys = np.array([numbers.setdefault(i, len(numbers)) for i in ids], np.int64)
        return cls(list(numbers), keys, form, at)

    def __post_init__(self):
        length = np.diff(self.offsets)
        last = self.form[np.maximum(self.offsets[1:] - 1, 0)] if len(self.form) else np.zeros(len(length), np.uint8)
        self.length = length - ((length > 0) & (last == 0x20))  # a separator at the end is no part of the item
        self.w, self.e, self.t = budget(self.length)
        grams = qgrams(self.form)
        at = np.arange(len(grams))
        item = np.searchsorted(self.offsets, at, "right") - 1
        ok = at + Q <= self.offsets[item] + self.length[item]
        order = np.argsort(grams[ok], kind="stable")
        grams, self.item, self.place = grams[ok][order], item[ok][order], (at - self.offsets[item])[ok][order]
        self.starts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.zeros(0, np.int64)
        self.count = np.diff(np.append(self.starts, len(grams)))
        self.grams = grams[self.starts]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.slot(self.grams)] = True
        used = self.length >= Q
        self.least = int(self.t[used].min()) if used.any() else 1
        self.reach = int((self.w + self.e)[used].max()) if used.any() else 0

    @staticmethod
    def slot(grams: np.ndarray) -> np.ndarray:
        return (grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _dense(rows: np.ndarray, at: np.ndarray, least: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For hits sorted by (row, at): which begin a stretch of ``least`` hits within ``reach`` positions of one row, and where that
    stretch (of all hits within reach) ends."""
    step = int(at.max()) + int(reach.max()) + 2 if len(at) else 1
    line = rows * step + at
    end = np.searchsorted(line, line + reach - Q, "right")
    return end - np.arange(len(line)) >= least, end


def _cover(n: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, begin, 1)
    np.add.at(edge, end, -1)
    return np.cumsum(edge[:-1]) > 0


def window_edits(items: Items, form: np.ndarray, item: np.ndarray, begin: np.ndarray, row_start: np.ndarray, row_end: np.ndarray,
                 low: np.ndarray) -> np.ndarray:
    """Least edits between the item windows that begin at ``begin`` and the document (its characters ``row_start`` to ``row_end``), along
    the ``2 (e + 1)`` diagonals from ``low`` on (a diagonal: place in the document less place in the item). Windows of one length and
    budget; those that pass it on the way are given up (and get a number above it)."""
    w, e = int(items.w[item[0]]), int(items.e[item[0]])
    out = np.full(len(item), e + 1, np.int64)
    far = np.int16(9999)
    lanes = np.arange(2 * e + 2, dtype=np.int16)
    source, start, high = items.offsets[item] + begin, row_start[:, None], row_end[:, None]
    first = (row_start + begin + low)[:, None] + lanes
    todo, cost = np.arange(len(item)), np.zeros((len(item), len(lanes)), np.int16)
    for i in range(w):
        at = first + i
        inside = (at >= start) & (at < high)
        same = inside & (form[np.minimum(np.maximum(at, 0), len(form) - 1)] == items.form[source + i][:, None])
        new = np.where(inside, cost + ~same, far)  # match or replace
        new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + 1)  # a letter of the item is missing in the document
        cost = np.minimum.accumulate(new - lanes, axis=1) + lanes  # further letters in the document
        if i % 8 == 7:
            alive = cost.min(1) <= e
            if not alive.all():
                todo, cost, source, start, high, first = (x[alive] for x in (todo, cost, source, start, high, first))
                if not len(todo):
                    return out
    out[todo] = cost.min(1)
    return out


def _between_words(items: Items, form: np.ndarray, item: np.ndarray, at: np.ndarray, row_start: np.ndarray, row_end: np.ndarray) -> np.ndarray:
    """Whether a short item that begins at ``at`` has word ends on both sides."""
    end = at + items.w[item]
    before = (at <= row_start) | (form[np.maximum(at - 1, 0)] == 0x20)
    return before & ((end >= row_end) | (form[np.minimum(end, len(form) - 1)] == 0x20))


def _least_edits(items: Items, form: np.ndarray, item: np.ndarray, begin: np.ndarray, row_start: np.ndarray, row_end: np.ndarray, low: np.ndarray) -> np.ndarray:
    """``window_edits`` for windows of any length; above the budget where a short item isn't a whole word or several."""
    out = np.empty(len(item), np.int64)
    shape = items.w[item] * (WINDOW + 1) + items.e[item]  # items below the short length have no edits
    for one in np.unique(shape):
        same = np.flatnonzero(shape == one)
        for a in range(0, len(same), ALIGN_AT_ONCE):
            k = same[a:a + ALIGN_AT_ONCE]
            out[k] = window_edits(items, form, item[k], begin[k], row_start[k], row_end[k], low[k])
    return out


def find_regions(items: Items, data: np.ndarray, offsets: np.ndarray, rows_only: bool = False) -> list[tuple[int, int, int, int, int]]:
    """(row, id number, first byte, first byte of the last character, edits) of every leak into a block's rows; with ``rows_only`` no more
    than it takes to name the rows."""
    form, rows_at, place = code_point_form(*plain(data, offsets))
    grams = qgrams(form)
    hit = np.flatnonzero(items.filter[Items.slot(grams)])
    gram = ta.lookup(items.grams, grams[hit])
    row = np.searchsorted(rows_at, hit, "right") - 1
    ok = (gram >= 0) & (hit + Q <= rows_at[np.minimum(row + 1, len(rows_at) - 1)])
    hit, gram, row = hit[ok], gram[ok], row[ok]
    begins, end = _dense(row, hit, np.full(len(hit), items.least), np.full(len(hit), items.reach))
    alive = _cover(len(hit), np.flatnonzero(begins), end[begins])
    hit, gram, row = hit[alive], gram[alive], row[alive]
    if not len(hit):
        return []

    # every (position, item position) pair, in the two bands that hold its diagonal
    n = items.count[gram]
    total = np.cumsum(n)
    entry = np.repeat(items.starts[gram] - (total - n), n) + np.arange(total[-1])
    hit, row, item, off = np.repeat(hit, n), np.repeat(row, n), items.item[entry], items.place[entry]
    wide = items.e[item] + 1
    band = (hit - rows_at[row] - off + (1 << 40)) // wide
    group = row * len(items.keys) + item
    hit, off, group, band = np.concatenate([hit, hit]), np.concatenate([off, off]), np.concatenate([group, group]), np.concatenate([band, band - 1])
    order = np.lexsort((hit, band, group))
    hit, off, group, band = hit[order], off[order], group[order], band[order]
    new = np.concatenate([[True], (group[1:] != group[:-1]) | (band[1:] != band[:-1])])
    once = new | np.concatenate([[True], hit[1:] != hit[:-1]])  # positions count once in a band
    hit, off, group, band, number = hit[once], off[once], group[once], band[once], np.cumsum(new)[once]
    row, item = np.divmod(group, len(items.keys))
    begins, end = _dense(number, hit, items.t[item], items.w[item] + items.e[item])
    first = np.flatnonzero(begins)
    if not len(first):
        return []

    # candidates: runs of such places in a band, each within reach of the one before
    far = (number[first[1:]] != number[first[:-1]]) | (hit[first[1:]] > hit[first[:-1]] + (items.w + items.e)[item[first[:-1]]])
    head = np.flatnonzero(np.concatenate([[True], far]))
    tail = np.append(head[1:], len(first)) - 1
    a, z = first[head], end[first[tail]] - 1  # first and last hit of each candidate
    item, row = item[a], row[a]
    low = band[a] * (items.e[item] + 1) - (1 << 40)
    room = items.length[item] - items.w[item]
    start, stop = rows_at[row], rows_at[row + 1]
    best = np.full(len(a), 1 << 30)

    def align(k: np.ndarray, begin: np.ndarray) -> None:
        edits = _least_edits(items, form, item[k], begin, start[k], stop[k], low[k])
        short = np.flatnonzero((items.length[item[k]] < SHORT_ITEM) & (edits == 0))
        if len(short):  # no edits: the diagonal is one of two
            j = k[short]
            whole = np.zeros(len(j), bool)
            for lane in range(2):
                at = start[j] + low[j] + lane
                inside = (at >= start[j]) & (at + items.w[item[j]] <= stop[j])
                same = inside & (window_matches(items, form, item[j], np.where(inside, at, 0)))
                whole |= same & _between_words(items, form, item[j], at, start[j], stop[j])
            edits[short[~whole]] = 1 << 30
        np.minimum.at(best, k, edits)

    every = np.arange(len(a))
    align(np.concatenate([every, every]), np.concatenate([np.clip(off[a], 0, room), np.clip(off[z] + Q - items.w[item], 0, room)]))
    pair = row if rows_only else row * len(items.ids) + items.keys[item]
    found = best <= items.e[item]
    todo = np.flatnonzero(~found & (room > 0))
    if rows_only:
        todo = todo[~np.isin(row[todo], row[found])]
    # windows that can hold enough of a candidate's q-grams begin so far before its first and after its last place
    slack = 2 * (items.e[item] + 1)
    lowest = np.minimum.reduceat(off[first], head) - Q * items.e[item] - slack
    highest = np.maximum.reduceat(off[first], head) + slack
    lowest, highest = np.clip(lowest, 0, room), np.clip(highest, 0, room)
    for k in range(0, len(todo), CANDIDATES_AT_ONCE):
        own = todo[k:k + CANDIDATES_AT_ONCE]
        size = highest[own] - lowest[own] + 1
        last = np.cumsum(size)
        align(np.repeat(own, size), np.arange(last[-1]) - np.repeat(last - size - lowest[own], size))
    found = np.flatnonzero(best <= items.e[item])

    # candidates of one id that overlap are one region
    out: list[tuple[int, int, int, int, int]] = []
    upto = -1
    for k in found[np.lexsort((hit[a[found]], pair[found]))].tolist():
        x, y, one = int(hit[a[k]]), int(hit[z[k]]) + Q - 1, (int(row[k]), int(items.keys[item[k]]))
        if out and out[-1][:2] == one and x <= upto:
            upto = max(upto, y)
            out[-1] = (*one, out[-1][2], int(place[upto]), min(out[-1][4], int(best[k])))
        else:
            upto = y
            out.append((*one, int(place[x]), int(place[y]), int(best[k])))
    return out


def window_matches(items: Items, form: np.ndarray, item: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the first window of each item stands at ``at`` as it is."""
    same = np.ones(len(item), bool)
    for i in range(int(items.w[item].max()) if len(item) else 0):
        inside = i < items.w[item]
        same &= ~inside | (form[np.minimum(at + i, len(form) - 1)] == items.form[np.minimum(items.offsets[item] + i, len(items.form) - 1)])
    return same


def _matches(raw):
    @ta.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(*raw.value)
        for batch in batches:
            rows, found = [], []
            for first, _, data, offsets in ta.blocks(batch.column(0)):
                points = None
                for r, i, a, b, edits in find_regions(items, data, offsets):
                    points = ta.code_points(data) if points is None else points
                    base = points[offsets[r]]
                    rows.append(first + r)
                    found.append((items.ids[i], int(points[a] - base), int(points[b] - base) + 1, edits))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(1).take(pa.array(rows, pa.int64())), "item_id": pa.array([x[0] for x in found], pa.int64()),
                "start": pa.array([x[1] for x in found], pa.int64()), "end": pa.array([x[2] for x in found], pa.int64()),
                "edits": pa.array([x[3] for x in found], pa.int32())})
    return run


def _without(raw, text_at: int):
    @ta.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(*raw.value)
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            for first, _, data, offsets in ta.blocks(batch.column(text_at)):
                for r, *_ in find_regions(items, data, offsets, rows_only=True):
                    clean[first + r] = False
            yield batch.filter(pa.array(clean))
    return run


def item_blocks(items: DataFrame, id_col: str, text_col: str, max_item_bytes: int) -> Iterator:
    """Plain items as broadcasts (what ``Items`` holds), in blocks of about ``max_item_bytes`` of whole rows."""
    usable = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text is not null").distinct()
    n = max(1, -(-(usable.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // max_item_bytes))
    if n > 1:  # rows are dealt by a number of their own, so rows of one id are spread as well
        usable = materialize(usable.withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n))))
    for k in range(n):
        own = (usable.where(F.col("part") == k) if n > 1 else usable).select("id", "text").toArrow()
        one = Items.from_texts(own["id"].to_pylist(), own["text"].combine_chunks())
        yield items.sparkSession.sparkContext.broadcast((one.ids, one.keys, one.form, one.offsets))


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
          max_item_bytes: int = MAX_ITEM_BYTES) -> DataFrame:
    """One row for every region of a document that an item leaks into: doc_id, item_id, start and end (code points) of the region, which
    holds the matched q-grams around a window within the budget, and the least edits of the windows aligned there."""
    texts = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("doc_id"))
    schema = "doc_id long, item_id long, start long, end long, edits int"
    found = None
    for block in item_blocks(items, item_id, item_text, max_item_bytes):
        own = texts.mapInArrow(_matches(block), schema)
        found = own if found is None else found.union(own)
    return found


def without_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                  max_item_bytes: int = MAX_ITEM_BYTES) -> DataFrame:
    """The rows of ``docs`` that no item leaks into."""
    for block in item_blocks(items, item_id, item_text, max_item_bytes):
        docs = docs.mapInArrow(_without(block, docs.columns.index(text_col)), docs.schema)
    return docs
