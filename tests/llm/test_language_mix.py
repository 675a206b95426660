import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from yearloom.llm import language_mix as L
from llm_fixtures import docs  # noqa: F401

VOWELS = {"aa": "the and of that with which from have this are for not", "bb": "der die und nicht von mit ist auch eine werden zwischen sich",
          "cc": "que los para una por con las del como pero todos muy"}


def text(rng, lang, n):
    return " ".join(rng.choice(VOWELS[lang].split()) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(1)
    return [(i, text(rng, lang, rng.randrange(20, 60)), lang) for i, lang in enumerate(list(VOWELS) * 40)]


def by_id(df):
    return {r.doc_id: (r.lang_pred, r.score) for r in df.collect()}


def test_mixtures(docs, labelled):
    rng = random.Random(2)
    mixed = [(1000, text(rng, "aa", 80) + "\n" + text(rng, "bb", 40), None), (1001, text(rng, "cc", 30) + text(rng, "aa", 30) + text(rng, "bb", 60), None),
             (1002, text(rng, "cc", 200) + " the", None), (1003, "und", None)]
    got = by_id(L.identify(docs(*labelled, *mixed), F.lit(True)))
    assert got[1000][0] == "aa" and abs(got[1000][1] - 2 / 3) < .03
    assert got[1001][0] == "bb" and abs(got[1001][1] - .5) < .03
    assert got[1002] == ("cc", 1.0)  # one foreign word doesn't pay for a language
    assert got[1003] == ("bb", 1.0)
    assert all(got[i][0] == lang for i, _, lang in labelled)


def test_learns_only_from_the_rows_it_may(docs, labelled):
    wrong = [(5000 + i, t, "zz") for i, t, _ in labelled]
    got = by_id(L.identify(docs(*labelled, *wrong), F.col("doc_id") < 5000))
    assert {p for p, _ in got.values()} <= set(VOWELS)
    none = by_id(L.identify(docs(*labelled), F.lit(False)))
    assert set(none.values()) == {("und", 0.0)}


def test_nulls_empties_letters_and_ties(spark, docs, labelled):
    rows = [(2000, None, "aa"), (2001, "", "aa"), (2002, "12 .. \n !", "aa"), (2003, "“…” — №", None), (2004, "漢字", None), (2005, "é", None),
            (None, "the and of that", "aa"), (2006, "the " * 200_000, None), (7, "the and of", "aa"), (7, "der die und", "bb"), (2007, "qqq", None), (2008, "x", None)]
    df = docs(*labelled, *rows).withColumn("score", F.lit(5)).withColumn("lang_pred", F.lit("no")).withColumn("h", F.lit(1))
    out = L.identify(df, F.lit(True))
    got = by_id(out)
    assert out.count() == len(labelled) + len(rows)
    for i in (2000, 2001, 2002, 2003):
        assert got[i] == ("und", 0.0)
    assert all(got[i][0] in VOWELS and 0 < got[i][1] <= 1 for i in (2004, 2005, 2007, 2008))
    assert got[2006] == ("aa", 1.0) and got[None][0] == "aa"
    assert by_id(L.identify(df.limit(0), F.lit(True))) == {}
    kept = L.accepted(df, F.lit(True))
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {r[0] for r in labelled + rows} - {2000, 2001, 2002, 2003}


def test_accepted(docs, labelled):
    """Any mixture of the languages is kept, however even; long texts that none of them explains go."""
    own = {}
    for _, text, lang in labelled:
        own.setdefault(lang, []).append(text)
    three = " ".join(" ".join(t.split()[:40]) for texts in list(own.values())[:3] for t in texts[:1])
    rng = np.random.default_rng(1)
    noise = " ".join("".join(chr(0x4e00 + x) for x in rng.integers(0, 5000, 3)) for _ in range(60))
    rows = [(9001, three, None), (9002, noise, None), (9003, noise[:30], None), (9004, "123 !", None)]
    kept = {r.doc_id for r in L.accepted(docs(*labelled, *rows), F.lit(True)).collect()}
    assert kept == {r[0] for r in labelled} | {9001, 9003}
    unlabelled = docs(*[(i, t, None) for i, t, _ in labelled + rows])
    assert {r.doc_id for r in L.accepted(unlabelled.withColumn("lang", F.lit(None).cast("string")), F.lit(True)).collect()} == {r[0] for r in labelled} | {9001, 9002, 9003}


def test_accepted_by_the_inferred_mixture():
    """Words that a language each explains a little, but no mixture: half of each explains a word worse than even draws."""
    model = np.full((L.BUCKETS, 2), -np.log(L.BUCKETS), np.float32)
    at = {w: L._trigrams(np.frombuffer(w.encode(), np.uint8), np.array([0, 1]))[0][0] for w in "xyz"}
    model[at["x"]] += (.3, -5)
    model[at["y"]] += (-5, .3)
    model[at["z"]] += (3, -5)
    column = pa.array(["x y " * 20, "x " * 40, "z y " * 20, "x y " * 9, "y " * 40 + "x", None, "1 " * 40])
    assert L.explained_batch(column, ["a", "b"], model).tolist() == [False, True, True, True, True, False, False]
    assert L.explained_batch(column, ["a"], model[:, :1]).tolist() == [False, True, False, True, False, False, False]
    assert L.explained_batch(column, [], model[:, :0]).tolist() == [True] * 5 + [False] * 2


def test_repeated_ids_stay_within_the_sample(docs, labelled):
    """A row count, not an id, is what the bound counts."""
    rows = [(1, f"{t} {k}", lang) for k, (_, t, lang) in enumerate(labelled * 3)]
    labels, model = L.train(docs(*rows), F.lit(True), sample_docs=2)
    words = np.exp(-model.min(0)) * L.SMOOTHING - L.SMOOTHING * L.BUCKETS  # letters learned from, by label
    longest = max(len(t) for _, t, _ in rows)
    assert labels == sorted(VOWELS) and (words < 2.5 * longest).all()


def test_sample_bound(docs, labelled):
    few, _ = L.train(docs(*labelled), F.lit(True), sample_docs=3)
    assert few == sorted(VOWELS)
    got = by_id(L.identify(docs(*labelled), F.lit(True), sample_docs=3))
    assert sum(got[i][0] == lang for i, _, lang in labelled) >= .95 * len(labelled)


def brute_mixture(lik, steps=4000):
    pi = np.full(lik.shape[1], 1 / lik.shape[1])
    for _ in range(steps):
        r = lik * pi
        pi = (r / r.sum(1, keepdims=True)).mean(0)
    return pi, np.log(lik @ pi).sum()


@pytest.mark.parametrize("seed", range(4))
def test_inference_against_all_sets(seed):
    rng = np.random.default_rng(seed)
    count, logs = np.array([1, 5, 60, 200, 120]), []
    for n, mix in zip(count, ([1, 0, 0], [0, 1, 0], [.6, .4, 0], [.5, .2, .3], [0, .97, .03])):
        own = rng.choice(3, n, p=mix)
        x = rng.normal(-30, 2, (n, 3))
        x[np.arange(n), own] += rng.choice([1, 6, 12], n)
        logs.append(x)
    best, share = L.infer(np.concatenate(logs).astype(np.float32), count)
    for k, x in enumerate(logs):
        fine = L.PENALTY + .5 * np.log(count[k])
        full = brute_mixture(np.exp(x - x.max(1, keepdims=True)))[0]
        order = np.argsort(-full)
        options = []
        for size in (1, 2, 3):
            use = np.sort(order[:size]) if size > 1 else np.array([x.sum(0).argmax()])
            pi, value = brute_mixture(np.exp(x[:, use] - x.max(1, keepdims=True)) + 0)
            options.append((value - (size - 1) * fine, use[pi.argmax()], pi.max()))
        want = max(options, key=lambda o: o[0])
        assert best[k] == want[1] and abs(share[k] - want[2]) < .02


def test_held_out_accuracy(spark):
    from yearloom.llm import queries
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(sf + "/documents.parquet").collect()}
    rows = [r for r in queries.op1_language_id(spark, sf).collect() if r.held_out]
    assert len(rows) > 150 and sum(r.lang_pred == truth[r.doc_id] for r in rows) >= .98 * len(rows)
