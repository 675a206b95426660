"""Language identification by multilingual mixture inference.

Training: byte trigrams of words (with their bounds) of a bounded sample of labelled
documents give every language smoothed trigram likelihoods, hashed to ``BUCKETS``.

Inference: a document's words are draws from a mixture of languages, each word's
likelihood in a language being that of its trigrams. Expectation-maximisation estimates
the proportions; the set of languages is the one of largest penalised likelihood among
the sets of the k most likely languages (each further language costs
``PENALTY + log(words) / 2``). The prediction is the language of the largest proportion
in that set, the score its proportion.

A document is accepted (``accepted``) if it has a letter and the mixture inferred for it explains
its words better than drawing each trigram evenly from all buckets would, by penalised likelihood;
how many languages it is in doesn't matter. Texts under ``JUDGED_WORDS`` words are too short to tell, and
need a letter only.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and so is every
text if nothing was learned (``accepted`` then keeps all texts with a letter); ties go to the label that sorts first; rows are judged one by
one; labels and ids that are null are never learned from; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yearloom.llm import textarrays as ta

BUCKETS = 1 << 18
SMOOTHING = 0.5
SAMPLE_DOCS = 2000  # labelled documents learned from, per language
PENALTY = 10.0  # nats for each further language
MAX_LABELS = 256  # languages learned: those with the most labelled documents (a model has BUCKETS floats for each)
JUDGED_WORDS = 20
UNKNOWN = "und"
MAX_STEPS = 60
TOLERANCE = 0.01  # nats still to gain

# bytes that count as letters, lower-cased: a-z and all of multi-byte characters; others separate words
_LETTER = np.full(256, 0x20, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the trigram around each letter byte, the first letter of each word among them, and words per row."""
    n = _LETTER[data].astype(np.uint32)
    letter = n != 0x20
    edge = np.zeros(len(n) + 1, bool)
    edge[offsets] = True
    before, after = np.full(len(n), 0x20, np.uint32), np.full(len(n), 0x20, np.uint32)
    before[1:], after[:-1] = n[:-1], n[1:]
    before[edge[:-1]] = 0x20
    after[edge[1:]] = 0x20
    at = np.flatnonzero(letter)
    code = (before[at] << 16) | (n[at] << 8) | after[at]
    bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - 18)
    first = before[at] == 0x20
    return bucket.astype(np.int64), np.flatnonzero(first), ta.per_row(at[first], offsets)


def _count(labels: list[str]):
    place = {x: k for k, x in enumerate(labels)}

    @ta.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(labels), BUCKETS), np.int64)
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for first, _, data, offsets in ta.blocks(batch.column(0)):
                for k in range(len(offsets) - 1):
                    own = data[offsets[k]:offsets[k + 1]]
                    bucket, _, _ = _trigrams(own, np.array([0, len(own)]))
                    counts[place[langs[first + k]]] += np.bincount(bucket, minlength=BUCKETS)
        lang, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict({"lang": pa.array(lang, pa.int32()), "bucket": pa.array(bucket, pa.int32()), "n": pa.array(counts[lang, bucket])})
    return run


def train(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_docs: int = SAMPLE_DOCS) -> tuple[list[str], np.ndarray]:
    """Labels (ascending; the ``MAX_LABELS`` most frequent) and log-likelihoods [bucket, label] from at most ``sample_docs`` rows a label,
    taken by the hash of their id among those with ``learn``. What comes to the driver is bounded by labels x buckets."""
    usable = docs.where(learn & F.col(id_col).isNotNull() & F.col(lang_col).isNotNull())
    keys = usable.select(F.col(text_col).alias("text"), F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.xxhash64(id_col).alias("h"))
    most = keys.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LABELS)
    counts = {r["lang"]: r["n"] for r in most.collect()}
    labels = sorted(counts)
    if not labels:
        return [], np.zeros((BUCKETS, 0), np.float32)
    # about four times the sample by the hash's size, of which the exact sample is ranked: few rows reach the ranking
    limits = docs.sparkSession.createDataFrame([(x, min(1.0, 4 * sample_docs / counts[x])) for x in labels], "lang string, part double")
    near = keys.join(F.broadcast(limits), "lang").where(F.pmod("h", F.lit(1 << 20)) < F.col("part") * (1 << 20))
    order = Window.partitionBy("lang").orderBy("h", "doc_id", F.xxhash64("text"))  # rows, not ids: repeated ones count one by one
    texts = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sample_docs).select("text", "lang")
    rows = texts.mapInArrow(_count(labels), "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((BUCKETS, len(labels)))
    counts[rows["bucket"].to_numpy(), rows["lang"].to_numpy()] = rows["n"].to_numpy()
    return labels, np.log((counts + SMOOTHING) / (counts.sum(0) + SMOOTHING * BUCKETS)).astype(np.float32)


def _mix(lik: np.ndarray, start: np.ndarray, count: np.ndarray, share: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``steps`` rounds of expectation-maximisation for all documents at once: shares, log-likelihoods at the shares
    before the last round, and bounds on what further rounds could add to them."""
    for _ in range(steps):
        weighted = np.repeat(share, count, axis=0) * lik
        total = weighted.sum(1)
        gain = np.add.reduceat(lik / total[:, None], start, axis=0)
        value = np.add.reduceat(np.log(total), start)
        bound = np.where(share > 0, gain, 0).max(1) - count
        share = share * gain / count[:, None]
    return share, value, bound


def _settle(lik: np.ndarray, count: np.ndarray, share: np.ndarray, goal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares and log-likelihoods after convergence; the latter -inf for documents that certainly stay below ``goal``."""
    value = np.full(len(count), -np.inf)
    todo, rows, length, steps = np.arange(len(count)), lik, count, 0
    while len(todo):
        first = np.cumsum(length) - length
        share[todo], reached, bound = _mix(rows, first, length, share[todo], 4)
        steps += 4
        open_ = reached + bound > goal[todo]
        done = open_ & ((bound < TOLERANCE) | (steps >= MAX_STEPS))
        value[todo[done]] = reached[done]
        left = open_ & ~done
        if not left.all():
            rows, length, todo = rows[np.repeat(left, length)], length[left], todo[left]
    return share, value


def infer(logs: np.ndarray, count: np.ndarray, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """Most likely label and its share, for documents of ``count`` (1 or more) words each; ``logs`` [word, label]."""
    return mixtures(logs, count, penalty)[:2]


def mixtures(logs: np.ndarray, count: np.ndarray, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``infer``, and the penalised log-likelihood of each document's mixture."""
    n_docs, n_langs = len(count), logs.shape[1]
    start = np.cumsum(count) - count
    single = np.add.reduceat(logs, start, axis=0, dtype=np.float64)
    best, share = single.argmax(1), np.ones(n_docs)
    if n_langs == 1:
        return best, share, single[:, 0]
    top = logs.max(1, keepdims=True)
    lik = np.exp((logs - top).astype(np.float64)) + 1e-300
    base = np.add.reduceat(top[:, 0], start, dtype=np.float64)
    fine = penalty + 0.5 * np.log(count)
    reached = single.max(1) - base  # the best penalised likelihood so far
    every, value = _settle(lik, count, np.full((n_docs, n_langs), 1 / n_langs), reached + fine)
    docs = np.flatnonzero(value > -np.inf)  # of the others, one language is certain to win
    order = np.argsort(-every[docs], axis=1, kind="stable")
    for k in range(2, n_langs + 1):
        if not len(docs):
            break
        some = np.zeros((len(docs), n_langs))
        use = order[:, :k]
        np.put_along_axis(some, use, np.take_along_axis(every[docs], use, 1) + 1e-12, 1)
        own = np.zeros(n_docs, bool)
        own[docs] = True
        part, value = _settle(lik[np.repeat(own, count)], count[docs], some / some.sum(1, keepdims=True), reached[docs] + (k - 1) * fine[docs])
        better = np.flatnonzero(value - (k - 1) * fine[docs] > reached[docs])
        won = docs[better]
        reached[won] = (value - (k - 1) * fine[docs])[better]
        best[won], share[won] = part[better].argmax(1), np.minimum(1.0, part[better].max(1))
    return best, share, reached + base


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode())


def explained_batch(column: pa.Array, labels: list[str], model: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Which texts have a letter and, if they are long enough to tell, a mixture of languages that explains their words better than even
    draws would."""
    out = np.zeros(len(column), bool)
    for first, _, data, offsets in ta.blocks(column):
        bucket, word, count = _trigrams(data, offsets)
        ascii_letter = (_LETTER[data] < 128) & (_LETTER[data] != 0x20)
        sure = ta.per_row(np.flatnonzero(ascii_letter), offsets) > 0
        known = np.array([bool(c) and (bool(s) or _has_letter(data[offsets[k]:offsets[k + 1]].tobytes())) for k, (c, s) in enumerate(zip(count, sure))], bool)
        judged = known & (count >= JUDGED_WORDS)
        if labels and judged.any():
            gain = np.add.reduceat(model[bucket] + np.float32(np.log(BUCKETS)), word, axis=0)  # of words, over even draws
            known[judged] = mixtures(gain[np.repeat(judged, count)], count[judged], penalty)[2] > 0
        out[first:first + len(count)] = known
    return out


def predict_batch(column: pa.Array, labels: list[str], model: np.ndarray, penalty: float = PENALTY) -> tuple[list[str], np.ndarray]:
    langs, scores = [UNKNOWN] * len(column), np.zeros(len(column))
    for first, _, data, offsets in ta.blocks(column) if labels else ():
        bucket, word, count = _trigrams(data, offsets)
        ascii_letter = (_LETTER[data] < 128) & (_LETTER[data] != 0x20)
        sure = ta.per_row(np.flatnonzero(ascii_letter), offsets) > 0
        known = np.array([bool(c) and (bool(s) or _has_letter(data[offsets[k]:offsets[k + 1]].tobytes())) for k, (c, s) in enumerate(zip(count, sure))], bool)
        if not known.any():
            continue
        logs = np.add.reduceat(model[bucket], word, axis=0)
        best, share = infer(logs[np.repeat(known, count)], count[known], penalty)
        for k, b, s in zip(np.flatnonzero(known).tolist(), best.tolist(), share.tolist()):
            langs[first + k], scores[first + k] = labels[b], s
    return langs, scores


def _predict(labels: list[str], model, penalty: float):
    @ta.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = predict_batch(batch.column(0), labels, model.value, penalty)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(1), "lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores)})
    return run


def _accept(labels: list[str], model, text_at: int, penalty: float):
    @ta.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(explained_batch(batch.column(text_at), labels, model.value, penalty)))
    return run


def identify(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             sample_docs: int = SAMPLE_DOCS, penalty: float = PENALTY) -> DataFrame:
    """doc_id, lang_pred and score of every row; ``learn`` says which labelled rows may be learned from."""
    labels, model = train(docs, learn, id_col, text_col, lang_col, sample_docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x labels floats
    return docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("doc_id")).mapInArrow(
        _predict(labels, shared, penalty), f"doc_id {docs.schema[id_col].dataType.simpleString()}, lang_pred string, score double")


def accepted(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             sample_docs: int = SAMPLE_DOCS, penalty: float = PENALTY) -> DataFrame:
    """The rows of ``docs`` whose words the inferred mixture of languages explains; all rows with a letter, if there is no label to learn from."""
    labels, model = train(docs, learn, id_col, text_col, lang_col, sample_docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_accept(labels, shared, docs.columns.index(text_col), penalty), docs.schema)
