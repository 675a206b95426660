import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from yearloom.llm import context_tree as C
from yearloom.llm import textarrays as ta
from llm_fixtures import docs  # noqa: F401


def symbols(text):
    """(context nearest byte first, byte) of every byte and the end mark."""
    data = [C.MARK] * C.DEPTH + list((text or "").encode().lower()) + [C.MARK]
    return [(tuple(reversed(data[k - C.DEPTH:k])), data[k]) for k in range(C.DEPTH, len(data))]


class Brute:
    """Context-tree weighting with dictionaries: one tree for each of a byte's 255 decisions."""

    def __init__(self, texts, least):
        self.n = {}  # (context, decision) -> [zeros, ones]
        size = Counter()
        seen = {}
        for text in texts:
            for context, byte in symbols(text):
                for d in range(C.DEPTH + 1):
                    size[context[:d]] += 1
                    seen.setdefault(context[:d], set()).add(byte)
                    for k in range(8):
                        self.n.setdefault((context[:d], (1 << k) | byte >> 8 - k), [0, 0])[byte >> 7 - k & 1] += 1
        self.kept = {s for s in size if not s or size[s] >= least}
        self.seen = seen
        self.log, self.share = {}, {}
        children = {}
        for s, v in self.n:
            if s and s in self.kept:
                children.setdefault((s[:-1], v), []).append((s, v))
        for key in sorted((k for k in self.n if k[0] in self.kept), key=lambda k: -len(k[0])):
            own = self.block(*self.n[key])
            if len(key[0]) == C.DEPTH:
                self.log[key], self.share[key] = own, 1.0
                continue
            rest = [x - sum(self.n[c][b] for c in children.get(key, ())) for b, x in enumerate(self.n[key])]
            below = sum(self.log[c] for c in children.get(key, ())) + self.block(*rest)
            self.log[key] = np.logaddexp(own, below) - math.log(2)
            self.share[key] = math.exp(own - math.log(2) - self.log[key])

    @staticmethod
    def block(n0, n1):
        return math.lgamma(n0 + .5) + math.lgamma(n1 + .5) - 2 * math.lgamma(.5) - math.lgamma(n0 + n1 + 1)

    def seen_byte(self, context, d, byte):
        """Probability of a byte seen after the context of d bytes (any byte, at d = 0): product of mixtures over depths 0 .. d."""
        p = 1.0
        for k in range(8):
            v = (1 << k) | byte >> 8 - k
            mixture, left = 0.0, 1.0
            for j in range(d + 1):
                n0, n1 = self.n.get((context[:j], v), (0, 0))
                share = 1.0 if j == d else self.share[context[:j], v]
                mixture += left * share * (n1 + .5) / (n0 + n1 + 1)
                left *= 1 - share
            p *= mixture if byte >> 7 - k & 1 else 1 - mixture
        return p

    def byte(self, context, byte, d=None):
        d = max(j for j in range(C.DEPTH + 1) if context[:j] in self.kept) if d is None else d
        if d == 0 or byte in self.seen[context[:d]]:
            return self.seen_byte(context, d, byte)
        unseen = 1 - sum(self.seen_byte(context, d, b) for b in self.seen[context[:d]])
        other = 1 - sum(self.byte(context, b, d - 1) for b in self.seen[context[:d]])
        return unseen / other * self.byte(context, byte, d - 1)

    def text(self, text):
        return sum(math.log10(self.byte(*x)) for x in symbols(text))


def is_learned(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 != 0


def base(rows):
    count, out = Counter(), []
    for i, text in rows:
        if is_learned(i):
            count.update((text or "").encode().lower().split())
            count[None] += 1
    n, v = sum(count.values()), len(count)
    for i, text in rows:
        tokens = (text or "").encode().lower().split() + [None]
        out.append((i, len(tokens), sum(count[t] > 0 for t in tokens), n,
                    sum(math.log10((count[t] + .1) / (n + .1 * (v + 1))) for t in tokens)))
    return out


def learn():
    return F.crc32(F.col("doc_id").cast("string")) % 10 != 0


ROWS = [(i, t) for i, t in enumerate(["The cat sat on the mat.", "the dog sat on THE log", "", None, "a cat, a dog", "\n\t ", "été à la mer", "the cat sat", "dog dog dog dog",
                                      "the theory of the thing", "unrelated: 12345", "The cat sat on the mat."] * 3)] + [(None, "the lost cat"), (3, "the cat again"), (3, "the cat again")]


def check(df, rows, model=None):
    got = sorted((tuple(r) for r in df.select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "held_out").collect()), key=repr)
    want = sorted(((*b, model.text(t) if model else None, None if i is None else not is_learned(i)) for b, (i, t) in zip(base(rows), rows)), key=repr)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:4] == w[:4] and g[6] == w[6] and abs(g[4] - w[4]) < 1e-9
        if model:
            assert abs(g[5] - w[5]) < 1e-4 * max(1, abs(w[5]))


@pytest.mark.parametrize("least", [1, 8])
def test_scores_against_brute_force(docs, least):
    model = Brute([t for i, t in ROWS if is_learned(i)], least)
    check(C.score_documents(docs(*ROWS).repartition(3), learn(), min_count=least), ROWS, model)


def test_model_bound_doubles_the_least_count(docs):
    small = C.score_documents(docs(*ROWS), learn(), min_count=1, model_codes=60)
    sizes = {least: Brute([t for i, t in ROWS if is_learned(i)], least) for least in (2, 4, 8, 16, 32, 64)}
    pairs = {k: sum(len(m.seen[s]) for s in m.kept if len(s) > 1) for k, m in sizes.items()}
    check(small, ROWS, sizes[min(k for k in pairs if pairs[k] <= 60)])


@pytest.mark.parametrize("cached", [0, 60])
def test_contexts_beyond_the_cache_are_scored_too(docs, cached):
    model = Brute([t for i, t in ROWS if is_learned(i)], 1)
    check(C.score_documents(docs(*ROWS).repartition(3), learn(), min_count=1, cached_codes=cached), ROWS, model)


def test_model_grows_with_the_corpus(docs, spark):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice("abcdefghijklmnop ") for _ in range(300))) for i in range(60)]
    cached = C.train(docs(*rows).select("text", F.lit(True).alias("learn")), min_count=1, cached_codes=500)
    kept = [len(r["keys"]) // 8 for r in cached[3].collect()]
    assert sum(kept) > 10 * (cached[4].value[0] != 0).sum()
    model = Brute([t for i, t in rows if is_learned(i)], 1)
    check(C.score_documents(docs(*rows), learn(), min_count=1, cached_codes=500), rows, model)


def test_probabilities_add_up_to_one():
    rng = random.Random(1)
    texts = ["".join(rng.choice("abé .") for _ in range(rng.randrange(60))) for _ in range(40)]
    model = Brute(texts, 3)
    for context, _ in symbols("ab é b..a zz"):
        assert abs(sum(model.byte(context, b) for b in range(256)) - 1) < 1e-9


def test_rare_words_only(docs):
    check(C.score_documents(docs(*ROWS), learn(), heavy_words=1), ROWS)


def test_nothing_learned_empty_table_and_clashes(docs):
    df = docs(*ROWS).withColumn("score", F.lit(1)).withColumn("learn", F.lit(True)).withColumn("batch", F.lit(1))
    rows = C.score_documents(df, F.lit(False)).collect()
    assert len(rows) == len(ROWS) and all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in rows)
    assert all(abs(r.score + (len((dict(ROWS[:36]).get(r.doc_id) or "").encode()) + 1) * 8 * math.log10(2)) < 1e-6 for r in rows if r.doc_id not in (None, 3))
    assert C.score_documents(df.limit(0), learn()).count() == 0


def test_long_text(docs):
    rows = [(1, "abc def " * 120_000), (2, "x"), (4, None)]
    got = {r.doc_id: r for r in C.score_documents(docs(*rows), F.lit(True)).collect()}
    assert got[1].n_tokens == 240_001 and got[1].score > -2000


def test_packed_keys_and_codes():
    keys = np.unique(np.random.default_rng(1).integers(0, 2 ** 63, 1000).astype(np.uint64))
    assert (C.unpack(C.pack(keys)) == keys).all() and len(C.unpack(C.pack(keys[:0]))) == 0
    data, offsets = ta.string_buffers(pa.array(["aB", "", "xyzxyzxyz"]))
    codes, at = C.byte_codes(data, offsets)
    assert at.tolist() == [0, 3, 4, 14]
    want = [c for t in ("aB", "", "xyzxyzxyz") for c in symbols(t)]
    assert [(tuple(int(c) >> 8 * (C.DEPTH - d) & 255 for d in range(C.DEPTH)), int(c) & 255) for c in codes] == want
    x = np.array([.5, 1, 1.5, 3, 1000.5, 1e7])
    assert np.allclose(C.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-13, atol=1e-12)


def test_held_out_documents_beat_the_base(spark):
    from yearloom.llm import queries
    sf = "/root/testdata/sf0.01"
    rows = [r for r in queries.op3_lm_scoring(spark, sf).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
