import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from yearloom.llm import id_files as I
from yearloom.session import scratch_dir
from llm_fixtures import docs  # noqa: F401

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def brute(rows, tokenizer, end=1):
    """(doc_id, start, n_tokens, crc) of every row, in ascending doc_id order."""
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def write_and_read(spark, df, name, **kw):
    folder = f"{scratch_dir(spark)}/{name}-{random.getrandbits(64):x}"
    manifest = I.write_ids(df, PATH, 1, folder, **kw)
    return manifest, I.read_ids(manifest, folder, with_ids=True), folder


@settings(max_examples=120, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 40), st.integers(0, 10_000), st.integers(0, 2**62)), max_size=700), st.integers(1, 5))
def test_elias_fano_holds_any_ascending_list(values, times):
    values = sorted(values * times)
    code = I.EliasFano.encode(np.array(values, np.uint64))
    back, rest = I.EliasFano.from_bytes(memoryview(code.to_bytes() + b"rest"))
    assert bytes(rest) == b"rest" and back.all().tolist() == values
    assert [back[k] for k in range(len(values))] == values


def test_elias_fano_is_near_minimal():
    rng = np.random.default_rng(1)
    values = np.cumsum(rng.integers(0, 800, 100_000)).astype(np.uint64)
    code = I.EliasFano.encode(values)
    assert len(code.to_bytes()) * 8 < len(values) * (2 + np.log2(values[-1] / len(values)) + 0.2) + 200
    gap = np.concatenate([np.arange(5), [1 << 22], np.arange(3000) + (1 << 22)]).astype(np.uint64)  # a long run of zero bytes between ones
    code = I.EliasFano.encode(gap)
    assert [code[k] for k in range(0, 3006, 7)] == gap[::7].tolist()


def test_files_hold_every_document_in_order(spark, docs, tokenizer):
    rng = random.Random(5)
    texts = ["", None, "Hello, world!", "İSTANBUL, é", "<|endoftext|> x", "word " * 700, "a\nb"]
    rows = [(k * 7 - 300, rng.choice(texts)) for k in range(120)]
    rng.shuffle(rows)
    for kw in ({}, {"file_ids": 500}):
        manifest, got, folder = write_and_read(spark, docs(*rows).repartition(5), "ids", **kw)
        out = got.orderBy("start").collect()
        assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in out] == brute(rows, tokenizer)
        assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in out)
        files = manifest.orderBy("part", "number").collect()
        assert sum(f.n_docs for f in files) == len(rows) and (not kw or len(files) > 10)
        system, path = I._place(folder)
        with system.open_input_file(f"{path}/{files[0].file}") as stream:
            one = I.IdFile(stream)
            for k in (0, one.n - 1):
                assert (one.doc_id(k), one.document(k).tolist()) == (out[k].doc_id, out[k].ids)


def test_null_and_shared_ids_repeats_and_clashing_columns(spark, docs, tokenizer):
    rows = [(None, "no id"), (None, None), (3, "again"), (3, "again"), (3, "other"), (-5, "first"), (2**62, "last"), (-(2**62), "least")]
    df = docs(*rows).withColumn("start", F.lit(1)).withColumn("row", F.lit("x")).withColumn("ids", F.lit(2)).withColumn("part", F.lit(3))
    _, got, _ = write_and_read(spark, df, "ids")
    out = got.orderBy("start").collect()
    assert [r.doc_id for r in out] == [None, None, -(2**62), -5, 3, 3, 3, 2**62]
    assert sorted(((r.doc_id, r.ids) for r in out), key=repr) == sorted(
        ((i, tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in rows), key=repr)
    assert [r.start for r in out] == np.cumsum([0] + [r.n_tokens for r in out])[:-1].tolist()
    manifest, none, _ = write_and_read(spark, df.limit(0), "ids")
    assert none.count() == 0 and manifest.count() == 0


def test_very_long_text_is_cut_at_white_space(spark, docs, tokenizer):
    text = " ".join(random.Random(2).choices(["alpha", "Beta,", "don't", "é"], k=700_000)) + "x" * 3_000
    _, got, _ = write_and_read(spark, docs((1, text), (2, "b")), "ids")
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got.orderBy("start").collect()] == brute([(1, text), (2, "b")], tokenizer)


def test_only_whole_files_of_the_manifest_are_read(spark, docs):
    manifest, got, folder = write_and_read(spark, docs((1, "one"), (2, "two")), "ids")
    system, path = I._place(folder)
    with system.open_output_stream(f"{path}/part-000000-0000-lost.ids") as f:
        f.write(b"left by a lost task")
    assert sorted(r.doc_id for r in got.collect()) == [1, 2]
    name = manifest.first().file
    with system.open_input_file(f"{path}/{name}") as f:
        whole = f.read()
    with system.open_output_stream(f"{path}/{name}") as f:
        f.write(whole[:-3])
    with pytest.raises(Exception, match="whole"):
        got.collect()


def test_starts_over_many_groups(spark, monkeypatch):
    monkeypatch.setattr(I, "GROUP_FILES", 3)
    rng = random.Random(1)
    rows = [(p, k, f"{p}-{k}", 1, rng.randrange(1, 9)) for p in range(20) for k in range(p % 3)]
    got = I.with_starts(spark.createDataFrame(rows, "part int, number int, file string, n_docs long, n_ids long"))
    before = dict(zip([r[2] for r in rows], np.cumsum([0] + [r[4] for r in rows]).tolist()))
    assert {r.file: r.start for r in got.collect()} == {f: before[f] for f in (r[2] for r in rows)}


def test_query_equals_whole_encoding(spark, tokenizer):
    from yearloom.llm import queries
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(sf + "/documents.parquet").collect()]
    got = queries.op11_token_files(spark, sf).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == brute(rows, tokenizer)
