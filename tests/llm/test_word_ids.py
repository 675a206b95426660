import json
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from yearloom.llm import word_ids as W

public_tokenizers = pytest.importorskip("public_tokenizers")
WORD_BPE = open(public_tokenizers.path("word_bpe_49k.json"), "rb").read()
PIECES = ["Foo", "bar", "\u0130", "\u0130,", "BELED\u0130YES\u0130", "\u00e9", "e\u0301", "\u0301", "\ufb01", "\ufb02x", "\u00df", "\u1e9e", "\u03a3", "a\u03a3", "\u01c5", "\u212a",
          "1", "23", "\u00b2", "\u00bd", "\u0663", " ", " ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "\u3000", ",", ".", "...", "'s", "'LL", "'", "-", "_", "\u0416", "\u4e2d", "\u0e01\u0e33",
          "\U0001f600", "<", "|", "<|", "<|endoftext|>", "<|STARTOFTEXT|>", "</w>", "\x00", "\u0387", "\u0345", "\u00aa", "\u02b0"]
TEXTS = st.lists(st.one_of(st.sampled_from(PIECES), st.characters(exclude_categories=["Cs"])), max_size=40).map("".join)


def encoders():
    """The tokeniser as it is, without lower-casing, and one whose words depend on the white space before them."""
    from tokenizers import Tokenizer
    cased = json.loads(WORD_BPE)
    cased["normalizer"]["normalizers"] = [n for n in cased["normalizer"]["normalizers"] if n["type"] != "Lowercase"]
    spaced = json.loads(open(public_tokenizers.path("byte_bpe_50k.json")).read())
    out = []
    for raw in (WORD_BPE, json.dumps(cased).encode(), json.dumps(spaced).encode()):
        out.append((Tokenizer.from_str(raw.decode()), W.Encoder(W.learn_rules(raw), 7)))
    return out


ENCODERS = encoders()


def whole(tokenizer, texts):
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [7] for t in texts]


def test_rules_are_told_apart():
    plain, cased, spaced = (e.rules for _, e in ENCODERS)
    assert plain.by_run and plain.lower and cased.by_run and not cased.lower and not spaced.by_run
    kinds = {c: int(plain.classes[ord(c)]) for c in "aZ1.'\u00e9\u0130\u0301 \u03a3\x85\u00b2"}
    assert kinds == {"a": 1, "Z": 1, "1": 2, ".": 3, "'": 4, "\u00e9": 1, "\u0130": 4, "\u0301": 4, " ": 0, "\u03a3": 4, "\x85": 4, "\u00b2": 2}


@pytest.mark.parametrize("which", range(3))
def test_ids_equal_whole_text_encoding(which):
    tokenizer, encoder = ENCODERS[which]

    @settings(max_examples=400, deadline=None)
    @given(st.lists(TEXTS, max_size=5))
    def holds(texts):
        got = list(encoder.texts(pa.array(texts, pa.string())))
        assert [r for r, _ in got] == list(range(len(texts)))
        assert [ids.tolist() for _, ids in got] == whole(tokenizer, texts)

    holds()


def test_dotted_capital_i():
    tokenizer, encoder = ENCODERS[0]
    texts = ["\u0130STANBUL BELED\u0130YES\u0130, dedi.", "SAL\u0130.", "\u00e9, \u0130, caf\u00e9", None, ""]
    assert [x.tolist() for _, x in encoder.texts(pa.array(texts))] == whole(tokenizer, texts)


def test_small_cache_small_blocks_and_cut_rows(monkeypatch):
    monkeypatch.setattr(W, "CACHED_RUNS", 40)
    monkeypatch.setattr(W, "BLOCK_BYTES", 300)
    monkeypatch.setattr(W, "RUNS_PER_CALL", 7)
    rng = random.Random(3)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(400))) for _ in range(60)] + ["x" * 900, None, " " * 900]
    for tokenizer, encoder in ENCODERS[:2]:
        encoder.reset()
        got = list(encoder.texts(pa.array(texts)))
        assert [ids.tolist() for _, ids in got] == whole(tokenizer, texts) and len(encoder.hashes) <= 400
