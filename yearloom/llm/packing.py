"""Best-fit packing of tokenised documents into sequences.

Tokenising: a task encodes each distinct run of characters once and joins the runs' ids
(``word_ids``). Only documents longer than a sequence are cut, into pieces of the
sequence's length.

Packing: pieces are dealt evenly into groups of about ``GROUP_PIECES``, and each group
is packed by vector best fit. A bin has three residual capacities: tokens, documents
and attention cost (the sum of squared piece lengths). Pieces come longest first; each
goes to the bin, among those with room in every dimension, of the least weighted norm
of the residual capacities that remain (or the largest weighted dot product of demand
and residual); a new bin is opened where none has room.

Defined results: a null text is empty and yields one piece, the separator alone; rows
that repeat are packed one by one; a null document id stays null; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.llm import textarrays as ta
from yearloom.llm import word_ids
from yearloom.session import materialize

SEQUENCE_TOKENS = 2048
SEPARATOR = 0
GROUP_PIECES = 65_536
WEIGHTS = (1.0, 0.001, 0.001)  # of tokens, documents, attention cost


def _pieces(raw, length: int, with_ids: bool):
    @ta.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids.Encoder(raw.value, SEPARATOR)
        for batch in batches:
            row, piece, start, size, crc, own_ids = [], [], [], [], [], []
            for r, ids in encoder.texts(batch.column(0)):
                ids = ids.astype("<u4", copy=False)
                for k, a in enumerate(range(0, len(ids), length)):
                    cut = ids[a:a + length]
                    row.append(r)
                    piece.append(k)
                    start.append(a)
                    size.append(len(cut))
                    crc.append(zlib.crc32(cut))
                    if with_ids:
                        own_ids.append(cut.astype(np.int32))
            out = {"doc_id": batch.column(1).take(pa.array(row, pa.int64())), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
                   "length": pa.array(size, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}
            if with_ids:
                out["ids"] = pa.array(own_ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(out)
    return run


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                     length: int = SEQUENCE_TOKENS, with_ids: bool = False) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids."""
    with open(tokenizer_path, "rb") as f:  # a few MB; tasks get it by broadcast
        rules = docs.sparkSession.sparkContext.broadcast(word_ids.learn_rules(f.read()))
    texts = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("doc_id"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return texts.mapInArrow(_pieces(rules, length, with_ids), schema)


def best_fit(lengths: np.ndarray, capacities: tuple[int, int, int], weights: tuple[float, float, float] = WEIGHTS,
             score: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece, by vector best fit over pieces in order of falling length."""
    order = np.argsort(-lengths, kind="stable")
    cap = np.array(capacities, np.float64)
    scale = np.array(weights) / cap ** 2
    room = np.zeros((4, len(lengths) + 1), np.int64)  # open bins by rising room: tokens, documents, attention cost, number
    n, bins = 0, 0
    into, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for k, size in zip(order.tolist(), lengths[order].tolist()):
        need = (size, 1, size * size)
        if any(x > c for x, c in zip(need, capacities)):
            raise ValueError("a piece passes a bin's capacity")
        low = int(np.searchsorted(room[0, :n], size))
        at = -1
        if low < n:
            t, d, a = (room[j, low:n] - need[j] for j in range(3))
            if score == "norm":
                value = scale[0] * t * t + scale[1] * d * d + scale[2] * a * a.astype(np.float64)
            else:
                value = -(scale[0] * need[0] * room[0, low:n] + scale[1] * need[1] * room[1, low:n] + scale[2] * need[2] * room[2, low:n].astype(np.float64))
            value = np.where((d >= 0) & (a >= 0), value, np.inf)
            best = int(np.argmin(value))
            if value[best] < np.inf:
                at = low + best
        if at < 0:
            state = [*(c - x for c, x in zip(capacities, need)), bins]
            offset[k], into[k], bins = 0, bins, bins + 1
            new = int(np.searchsorted(room[0, :n], state[0]))
            room[:, new + 1:n + 1] = room[:, new:n].copy()
            n += 1
        else:
            state = [*(int(room[j, at]) - need[j] for j in range(3)), int(room[3, at])]
            offset[k], into[k] = capacities[0] - room[0, at], state[3]
            new = int(np.searchsorted(room[0, :n], state[0]))
            room[:, new + 1:at + 1] = room[:, new:at].copy()
        room[:, new] = state
    return into, offset


def pack(pieces: DataFrame, tokens: int = SEQUENCE_TOKENS, documents: int | None = None, attention: int | None = None,
         weights: tuple[float, float, float] = WEIGHTS, score: str = "norm", group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (with a ``length``) plus ``sequence_id`` and ``offset``. The limits on documents and on attention cost
    bind only if given; a piece that fills a sequence, or whose own attention cost passes the limit, is a sequence by itself.
    Writes the pieces once, and counts them."""
    caps = (tokens, documents or tokens, attention or tokens * tokens)
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    numbered = materialize(pieces.select(*columns, F.monotonically_increasing_id().alias("_row")))
    whole = (F.col("length") >= tokens) | (F.col("length") * F.col("length") > caps[2])
    alone, rest = numbered.where(whole), numbered.where(~whole)
    groups = max(1, -(-rest.count() // group_pieces))

    def fit(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("_row", ignore_index=True)
        into, offset = best_fit(own["length"].to_numpy(np.int64), caps, weights, score)
        return pd.DataFrame({"_row": own["_row"], "sequence_id": own["_group"].to_numpy(np.int64) * (1 << 32) + into, "offset": offset})

    dealt = rest.select("_row", "length", F.pmod(F.xxhash64("_row"), F.lit(groups)).alias("_group"))
    placed = dealt.groupBy("_group").applyInPandas(fit, "_row long, sequence_id long, offset long")
    packed = rest.join(placed, "_row")
    single = alone.withColumns({"sequence_id": -1 - F.col("_row"), "offset": F.lit(0).cast("long")})
    return packed.unionByName(single).drop("_row")


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", tokens: int = SEQUENCE_TOKENS, **limits) -> DataFrame:
    """Tokenise and pack: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(tokenized_pieces(docs, tokenizer_path, id_col, text_col, tokens), tokens, **limits)


def sequences(packed: DataFrame) -> DataFrame:
    """Sequences' token ids, from packed pieces that carry ``ids`` (at most one sequence's tokens a row)."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"),
                        F.transform("parts", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["piece"].alias("piece"), p["offset"].alias("offset"))).alias("pieces"))
