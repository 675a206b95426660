import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from yearloom.llm import textarrays as ta

texts = st.lists(st.one_of(st.none(), st.text(alphabet="aB \t\n\x0b\x0c\r\x1c éß😀.,", max_size=30)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_words_are_those_of_bytes_split(rows):
    data, offsets = ta.string_buffers(pa.array(rows, pa.string()))
    hashes, starts, ends, counts = ta.word_hashes(data, offsets, ta.Powers())
    want = [w for x in rows for w in (x or "").encode().split()]
    assert [data[a:b].tobytes() for a, b in zip(starts, ends)] == want
    assert counts.tolist() == [len((x or "").encode().split()) for x in rows]
    seen = {}
    for w, h in zip(want, hashes.tolist()):
        assert seen.setdefault(w.lower(), h) == h  # equal words, equal hashes, wherever they stand
    assert len(set(seen.values())) == len(seen)


def test_blocks_cover_all_rows_and_long_rows():
    rows = ["x" * n for n in (5, 0, 40, 3, 3, 100, 0)] + [None]
    column = pa.array(["skip"] + rows).slice(1)
    got = [(a, b, data.tobytes().decode(), offsets.tolist()) for a, b, data, offsets in ta.blocks(column, 10)]
    assert [g[0] for g in got] + [8] == [0] + [g[1] for g in got]
    assert "".join(g[2] for g in got) == "".join(x or "" for x in rows)
    assert list(ta.blocks(pa.array([], pa.string()))) == []


def test_long_texts_hash_alike_anywhere():
    word = "w" * 50_000
    data, offsets = ta.string_buffers(pa.array(["a" * 1_500_000 + " " + word, word]))
    hashes, *_ = ta.word_hashes(data, offsets, ta.Powers())
    assert hashes[1] == hashes[2] != hashes[0]


@pytest.mark.parametrize("size", [1, 5])
def test_shingles(size):
    rows = ["a b c d e f", "a b c d e f a b c d e f", "", "a b", "b a", "a a a a a a a a"]
    data, offsets = ta.string_buffers(pa.array(rows))
    words, _, _, counts = ta.word_hashes(data, offsets, ta.Powers())
    got = ta.shingle_hashes(words, counts, size)
    for x, h in zip(rows, got):
        w = x.split()
        want = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
        assert len(h) == len(want) and (np.diff(h.astype(object)) > 0).all()
    assert set(got[0].tolist()) <= set(got[1].tolist())
    if size == 5:
        assert got[3].tolist() != got[4].tolist()


@settings(max_examples=50, deadline=None)
@given(st.sets(st.integers(1, 2 ** 64 - 1), max_size=200), st.lists(st.integers(1, 2 ** 64 - 1), max_size=50))
def test_hash_table(keys, others):
    keys = ta.mix(np.array(sorted(keys), np.uint64))
    keys = keys[keys != 0]
    table = ta.hash_table(keys, np.arange(1, len(keys) + 1))
    asked = np.concatenate([keys, ta.mix(np.array(others, np.uint64))])
    found, values = ta.table_get(table, asked)
    place = {k: i + 1 for i, k in enumerate(keys.tolist())}
    assert found.tolist() == [k in place for k in asked.tolist()]
    assert values.tolist() == [place.get(k, 0) for k in asked.tolist()]


def test_hash_table_with_colliding_slots():
    keys = np.arange(1, 400, dtype=np.uint64)  # not mixed: all begin in the same slot
    found, values = ta.table_get(ta.hash_table(keys, keys * np.uint64(2)), np.arange(1, 500, dtype=np.uint64))
    assert found.sum() == 399 and (values[:399] == keys * 2).all()
