import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from yearloom.llm import packing as P
from llm_fixtures import docs  # noqa: F401

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def check(rows, packed, tokenizer, tokens=2048):
    """Pieces are those of the whole texts' ids; sequences are full, gapless and within the limit."""
    want = []
    for i, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        want += [(i, k, a, len(ids[a:a + tokens]), zlib.crc32(ids[a:a + tokens].tobytes())) for k, a in enumerate(range(0, len(ids), tokens))]
    got = packed.collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= tokens
    return len(sequences), sum(r.length for r in got)


TEXTS = ["", None, " \t\n", "Hello, world! It's a test's don't WE'LL", "<|endoftext|>", "a<|endoftext|>b <|STARTOFTEXT|> <|startoftext|>x", "<|", "é à Ünïcödé İ K ǅ",
         "école café ́x", "a b c　d", "漢字かな한국어 русский", "x1y22z333 4.5,6;7", "don't.stop,now...!?;:", "under_score __", "😀👍🏽 ok",
         "\x1c\x1d a\x85b", "'s 't 're", "word " * 9000, "supercalifragilistic" * 400, "0123456789" * 900, "A.B.C. e.g., (x)", "ﬁ ﬂ ½", "</w> a</w>"]


def test_ids_equal_whole_text_encoding(docs, tokenizer):
    rows = list(enumerate(TEXTS)) + [(None, "no id"), (3, "again"), (3, "again")]
    check(rows, P.pack_documents(docs(*rows), PATH), tokenizer)


def test_random_words(docs, tokenizer):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice(["Foo", "bar", "é", " ", " ", "\n", ",", ".", "'s", "9", "zż"]) for _ in range(rng.randrange(400)))) for i in range(150)]
    check(rows, P.pack_documents(docs(*rows), PATH), tokenizer)


def test_few_sequences(spark):
    from yearloom.llm import queries
    packed = queries.op10_packing(spark, "/root/testdata/sf0.01").collect()
    total = sum(r.length for r in packed)
    assert len({r.sequence_id for r in packed}) <= -(-total // 2048) * 1.01 + 1


def test_groups_clashing_columns_and_empty(docs, tokenizer):
    rng = random.Random(4)
    rows = [(i, "a " * rng.randrange(1, 3000)) for i in range(60)]
    df = docs(*rows).withColumn("offset", F.lit(1)).withColumn("sequence_id", F.lit(2)).withColumn("_row", F.lit(3)).withColumn("length", F.lit(4))
    n, total = check(rows, P.pack_documents(df, PATH, group_pieces=7), tokenizer)
    assert n <= 1.5 * total / 2048 + 7
    assert P.pack_documents(df.limit(0), PATH).count() == 0


def test_sequences_hold_the_ids(docs, tokenizer):
    rows = [(i, f"text number {i} " * (i + 1)) for i in range(40)]
    packed = P.pack(P.tokenized_pieces(docs(*rows), PATH, length=100, with_ids=True), 100)
    whole = {i: tokenizer.encode(t, add_special_tokens=False).ids + [0] for i, t in rows}
    for s in P.sequences(packed).collect():
        assert len(s.ids) <= 100
        for p in s["pieces"]:
            own = whole[p.doc_id][p.piece * 100:p.piece * 100 + 100]
            assert s.ids[p.offset:p.offset + len(own)] == own


@pytest.mark.parametrize("limits", [{"documents": 2}, {"attention": 300 ** 2}, {"documents": 3, "attention": 400 ** 2}])
def test_limits_bind(docs, limits):
    """Sequences keep to the limits, and need more room for it."""
    rng = random.Random(9)
    rows = [(i, "a " * rng.choice([3, 20, 90, 250, 380])) for i in range(200)]
    packed = P.pack_documents(docs(*rows), PATH, tokens=512, **limits).collect()
    assert len(packed) == len(rows)
    sequences = {}
    for r in packed:
        sequences.setdefault(r.sequence_id, []).append(r.length)
    for own in sequences.values():
        assert sum(own) <= 512 and len(own) <= limits.get("documents", 512)
        assert len(own) == 1 or sum(x * x for x in own) <= limits.get("attention", 512 ** 2)
    free = P.pack_documents(docs(*rows), PATH, tokens=512).select("sequence_id").distinct().count()
    assert len(sequences) > free


def brute_fit(lengths, caps, weights, score):
    bins, into = [], {}
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        need = (lengths[k], 1, lengths[k] ** 2)
        fits = []
        for b, room in enumerate(bins):
            if all(r >= n for r, n in zip(room, need)):
                value = (sum(w * ((r - n) / c) ** 2 for w, r, n, c in zip(weights, room, need, caps)) if score == "norm"
                         else -sum(w * r * n / c ** 2 for w, r, n, c in zip(weights, room, need, caps)))
                fits.append((value, b))
        if fits:
            b = min(fits)[1]
        else:
            b = len(bins)
            bins.append(caps)
        into[k] = b
        bins[b] = tuple(r - n for r, n in zip(bins[b], need))
    return bins, into


@pytest.mark.parametrize("score", ["norm", "dot"])
@pytest.mark.parametrize("caps", [(100, 100, 10_000), (100, 3, 10_000), (100, 100, 4_500), (100, 4, 5_000)])
def test_best_fit(caps, score):
    rng = np.random.default_rng(7)
    lengths = np.minimum(rng.integers(1, 66, 400), int(caps[2] ** .5))
    weights = (1.0, .3, .2)
    into, offset = P.best_fit(lengths, caps, weights, score)
    bins, _ = brute_fit(lengths.tolist(), caps, weights, score)
    assert abs(into.max() + 1 - len(bins)) <= max(2, .02 * len(bins))  # ties may fall either way
    for b in range(into.max() + 1):
        own = np.flatnonzero(into == b)
        assert lengths[own].sum() <= caps[0] and len(own) <= caps[1] and (lengths[own] ** 2).sum() <= caps[2]
        order = own[np.argsort(offset[own])]
        assert offset[order].tolist() == (np.cumsum(lengths[order]) - lengths[order]).tolist()


def test_best_fit_rejects_what_no_bin_holds():
    with pytest.raises(ValueError):
        P.best_fit(np.array([5]), (4, 4, 100))
    into, offset = P.best_fit(np.zeros(0, np.int64), (4, 4, 16))
    assert len(into) == len(offset) == 0
