"""Token ids of whole texts, where every distinct run of a text's characters is encoded once.

White space parts words, and words part into runs of letters, single digits and runs of signs
wherever the tokeniser's own rules do the same. ``learn_rules`` finds that out by trying: a
character counts as a letter, digit or sign only if the tokeniser treats it so in a set of probe
words and keeps its shape apart from lower-casing. A word with any other character (apostrophes,
combining marks, letters that change under normalisation, everything from U+0590 on) or with the
beginning of an added token is encoded as a whole. For a tokeniser whose words depend on the
white space around them, or whose pieces don't tell where a word ends, whole texts are encoded.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from yearloom.llm import textarrays as ta

LETTER, DIGIT, SIGN, ODD = 1, 2, 3, 4
CODE_POINTS = 0x590  # runs are told apart below this; all take at most two bytes
CACHED_RUNS = 600_000  # a task's cache starts anew beyond this
RUNS_PER_CALL = 500
BLOCK_BYTES = 1 << 20
TEXTS_PER_CALL = 64
EXACT_VALUES = ta.mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Rules:
    """What ``learn_rules`` found out about a tokeniser."""

    json: bytes
    by_run: bool = False
    lower: bool = False
    classes: np.ndarray = field(default_factory=lambda: np.full(CODE_POINTS, ODD, np.uint8))
    marks: tuple[tuple[int, int], ...] = ()  # first two bytes, lower-cased, of added tokens


def _tokenizers(json: bytes):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks run side by side already
    from tokenizers import Tokenizer

    whole = Tokenizer.from_str(json.decode())
    bare = Tokenizer(whole.model)
    if whole.pre_tokenizer is not None:
        bare.pre_tokenizer = whole.pre_tokenizer
    return whole, bare


def _ids(tokenizer, texts: list[str]) -> list[list[int]]:
    return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _kind(c: str) -> int:
    kind = unicodedata.category(c)[0]
    return {"L": LETTER, "N": DIGIT, "M": ODD, "Z": ODD}.get(kind, SIGN)


def _runs(word: str) -> list[str]:
    out: list[str] = []
    for c in word:
        if out and _kind(c) == _kind(out[-1][-1]) != DIGIT:
            out[-1] += c
        else:
            out.append(c)
    return out


def learn_rules(json: bytes) -> Rules:
    """Try the tokeniser (its JSON file's bytes) on probe words."""
    rules = Rules(json)
    whole, bare = _tokenizers(json)
    added = whole.get_added_tokens_decoder().values()
    if not getattr(whole.model, "end_of_word_suffix", None) or any(t.lstrip or t.rstrip or t.single_word or set(t.content) & set(" \t\n\v\f\r") for t in added):
        return rules
    words = ["Ab1.", "don't", "éß", "İ,", "x", "漢字", "<|", "́a", "9"]
    alone = [i for ids in _ids(whole, words) for i in ids]
    if any(ids != alone for ids in _ids(whole, [a + s.join(words) + a for s in (" ", "\t", "\n", "\v", "\f", "\r", " \n ") for a in ("", s)])):
        return rules
    letters = [chr(c) for c in range(65, 91)]
    rules.lower = all(a == b for a, b in zip(_ids(whole, letters), _ids(whole, [c.lower() for c in letters])))
    probes: dict[int, list[str]] = {}
    for c in map(chr, range(CODE_POINTS)):
        shape = c.lower() if rules.lower else c
        if len(shape) == 1 and _kind(c) == _kind(shape) != ODD and unicodedata.normalize("NFC", c) == c and ord(c) not in (9, 10, 11, 12, 13):
            probes[ord(c)] = [c, f"a{c}", f"a{c}b", f"{c}{c}", f"1{c}.", f".{c}1", f"a{c}s", f"b{c}ll", f"{c}re"]
    split = {w: _runs(w.lower() if rules.lower else w) for own in probes.values() for w in own}
    runs = list({r for own in split.values() for r in own})
    by_run = dict(zip(runs, _ids(bare, runs)))
    by_word = dict(zip(split, _ids(whole, list(split))))
    for c, own in probes.items():
        if by_word[own[0]] and all(by_word[w] == [i for r in split[w] for i in by_run[r]] for w in own):
            rules.classes[c] = _kind(chr(c))
    rules.classes[[0x20, *range(9, 14)]] = 0
    for t in added:
        start = ta.LOWER[np.frombuffer(t.content.encode(), np.uint8)].tolist()
        if len(start) == 1:
            rules.classes[start[0]] = ODD
        else:
            rules.marks += ((start[0], start[1]),)
    rules.by_run = bool((rules.classes[97:123] == LETTER).all())
    return rules


class Encoder:
    """Ids of texts, each distinct run encoded once while it is cached."""

    def __init__(self, rules: Rules, end_id: int):
        self.rules, self.end = rules, end_id
        self.whole, self.bare = _tokenizers(rules.json)
        self.powers = ta.Powers()
        self.ascii = np.full(256, ODD, np.uint8)
        self.ascii[:128] = rules.classes[:128]
        self.values = ta.BYTE_VALUES if rules.lower else EXACT_VALUES
        if rules.by_run:
            vocabulary, suffix = self.whole.get_vocab(), self.whole.model.end_of_word_suffix
            self.ends_run = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends_run[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.reset()

    def reset(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def runs(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all runs of a block, and which are whole words with an odd character."""
        kind = self.ascii[data]
        lead = np.flatnonzero((data >= 0xC2) & (data <= 0xD6))
        if len(lead):
            point = ((data[lead] & 0x1F).astype(np.int64) << 6) | (data[lead + 1] & 0x3F)
            kind[lead] = kind[lead + 1] = self.rules.classes[point]
        for a, b in self.rules.marks:
            low = ta.LOWER[data]
            kind[np.flatnonzero((low[:-1] == a) & (low[1:] == b))] = ODD
        starts, ends, _ = ta.word_spans(data, offsets)
        odd = np.zeros(len(data) + 1, np.int32)
        np.cumsum(kind == ODD, out=odd[1:])
        bad = np.flatnonzero(odd[ends] > odd[starts])
        if len(bad):
            step = np.zeros(len(data) + 1, np.int8)
            step[starts[bad]] += 1
            step[ends[bad]] -= 1
            kind[np.cumsum(step[:-1], dtype=np.int8) > 0] = ODD
        begins = kind != 0
        begins[1:] &= (kind[1:] != kind[:-1]) | ((kind[1:] == DIGIT) & ((data[1:] & 0xC0) != 0x80))
        begins[starts] = True  # a row's first word too
        first = np.flatnonzero(begins)
        close = np.append(first[1:], len(data))
        return first, np.minimum(close, ends[np.searchsorted(ends, first, "right")]) if len(first) else close[:0], kind[first] == ODD

    def learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, odd: np.ndarray, hashes: np.ndarray) -> None:
        """Encode new runs (ascending hashes); like ones side by side, which is faster."""
        n = len(starts)
        ids: list[np.ndarray] = []
        count = np.zeros(n, np.int64)
        even = np.flatnonzero(~odd)
        head = np.zeros(len(even), np.uint64)
        for k in range(4):
            head = (head << np.uint64(8)) | data[np.minimum(starts[even] + k, len(data) - 1)].astype(np.uint64)
        even = even[np.argsort(head, kind="stable")]
        size = ends[even] - starts[even] + 1
        total = np.cumsum(size)
        text = np.full(int(total[-1]) if len(total) else 0, 0x20, np.uint8)
        inside = np.arange(len(text)) - np.repeat(total - size, size)
        letters = inside < np.repeat(size - 1, size)
        text[letters] = data[(np.repeat(starts[even], size) + inside)[letters]]
        cuts = np.concatenate([np.arange(0, len(even), RUNS_PER_CALL), [len(even)]]) if len(even) else np.zeros(1, np.int64)
        edge = np.concatenate([[0], total])[cuts].tolist()
        texts = [text[a:b].tobytes().decode() for a, b in zip(edge, edge[1:])]
        if self.rules.lower:
            texts = [t.lower() for t in texts]
        order: list[np.ndarray] = []
        for k, t in enumerate(texts):
            own = even[cuts[k]:cuts[k + 1]]
            got = np.array(_ids(self.bare, [t])[0], np.uint32)
            last = np.flatnonzero(self.ends_run[got]) + 1
            if len(last) == len(own) and last[-1] == len(got):
                ids.append(got)
                count[own] = np.diff(last, prepend=0)
                order.append(own)
            else:
                odd[own] = True  # not as told: one by one
        rest = np.flatnonzero(odd)
        for k in range(0, len(rest), RUNS_PER_CALL):
            own = rest[k:k + RUNS_PER_CALL]
            got = _ids(self.whole, [data[a:b].tobytes().decode() for a, b in zip(starts[own].tolist(), ends[own].tolist())])
            count[own] = [len(x) for x in got]
            ids.append(np.array([i for x in got for i in x], np.uint32))
            order.append(own)
        row = np.concatenate(order)
        at = np.empty(n, np.int64)
        at[row] = len(self.ids) + np.cumsum(count[row]) - count[row]
        self.ids = np.concatenate([self.ids, *ids])
        place = np.searchsorted(self.hashes, hashes)  # both ascending
        self.hashes, self.at, self.count = (np.insert(x, place, y) for x, y in ((self.hashes, hashes), (self.at, at), (self.count, count)))

    def block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block of texts, and the rows' offsets among them."""
        starts, ends, odd = self.runs(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        hashes = ta.span_hashes(ta.prefix_sums(data, self.powers, self.values), starts, ends, self.powers)
        if odd.any() and self.rules.lower:  # special strings keep their case
            hashes[odd] = ~ta.span_hashes(ta.prefix_sums(data, self.powers, EXACT_VALUES), starts[odd], ends[odd], self.powers)
        known, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        place = ta.lookup(self.hashes, known)
        new = np.flatnonzero(place < 0)
        if len(new):
            if len(self.hashes) + len(new) > CACHED_RUNS:
                self.reset()
                new = np.arange(len(known))
            own = first[new]
            self.learn(data, starts[own], ends[own], odd[own], known[new])
            place = ta.lookup(self.hashes, known)
        count = self.count[place][inverse]
        total = np.cumsum(count)
        spread = np.repeat(self.at[place][inverse] - (total - count), count) + np.arange(total[-1])
        return self.ids[spread], np.concatenate([[0], total])[np.searchsorted(starts, offsets)]

    def texts(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """Every row's number and ids, the end id last (nulls as empty)."""
        if not self.rules.by_run:
            for first in range(0, len(column), TEXTS_PER_CALL):
                own = [t or "" for t in column.slice(first, TEXTS_PER_CALL).to_pylist()]
                for r, ids in enumerate(_ids(self.whole, own)):
                    yield first + r, np.array([*ids, self.end], np.uint32)
            return
        end = np.array([self.end], np.uint32)
        parts: list[np.ndarray] = []
        for rows, done, data, offsets in ta.cut_blocks(column, BLOCK_BYTES):
            ids, at = self.block(data, offsets)
            for r, last, a, b in zip(rows.tolist(), done.tolist(), at.tolist(), at[1:].tolist()):
                parts.append(ids[a:b])
                if last:
                    yield r, np.concatenate([*parts, end])
                    parts = []
