"""Token ids of whole texts with a ``tokenizers`` vocabulary file.

The library encodes the pre-tokens of a text one by one, and words repeat.  So
a batch of texts is cut into pre-tokens here, by byte classes and with numpy;
the library encodes each pre-token that the worker has not met yet; and a
text's ids are its pre-tokens' ids in a row.  The cutting follows the patterns
of the vocabulary files for characters on whose class all Unicode versions
agree (printable ASCII, white space, À to ÿ).  A text with any other
character, a text that quotes an added token of the file (the library makes it
that token), and any text of a vocabulary with other patterns, goes through
the library whole.
"""

from __future__ import annotations

import json

import numpy as np

from lodgeflow.llm.bytewords import run_hashes, text_bytes
from lodgeflow.llm.shared import slices

#: Pre-tokens remembered per Python worker (about 40 bytes each); beyond it
#: the store starts anew.
MAX_PIECES = 1_000_000
#: Characters that are cut and looked up at a time.
SLICE = 1_000_000

_END, _LETTER, _DIGIT, _OTHER, _SPACE, _UNSURE = range(6)
_CLASS = np.full(256, _UNSURE, dtype=np.uint8)
_CLASS[0] = _END
_CLASS[9:14] = _SPACE
_CLASS[33:127] = _OTHER
_CLASS[32] = _SPACE
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
#: What follows an apostrophe in a contraction (fixed values).
_SHORT = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


def _classes(data: np.ndarray) -> np.ndarray:
    """Class of each byte; À to ÿ are 0xC3 and a second byte."""
    kind = _CLASS[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    second = data[lead + 1]
    accent = np.where((second == 0x97) | (second == 0xB7), _OTHER, _LETTER)  # × and ÷
    kind[lead], kind[lead + 1] = accent, accent
    return kind


def _cut(data: np.ndarray, kind: np.ndarray, spaces: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the pre-tokens.  ``spaces``: they are kept, the
    last one before a word belongs to the word, and digits stay together;
    otherwise white space is dropped and each digit stands alone."""
    start = np.ones(len(data), dtype=bool)
    start[1:] = kind[1:] != kind[:-1]
    if spaces:
        word = np.flatnonzero((kind[1:] != _SPACE) & (kind[1:] != _END) & (kind[:-1] == _SPACE)) + 1
        start[word - 1] = True
        start[word[data[word - 1] == 32]] = False
    else:
        start[kind == _DIGIT] = True
    padded = np.concatenate([data, np.zeros(4, dtype=np.uint8)])
    lone = np.flatnonzero((data == 39) & start)
    lone = lone[(kind[np.minimum(lone + 1, len(kind) - 1)] == _LETTER)]
    for tail in _SHORT:
        fits = np.ones(len(lone), dtype=bool)
        for k, c in enumerate(tail):
            fits &= padded[lone + 1 + k] == c
        here = lone[fits]
        start[here + 1] = False
        after = here + 1 + len(tail)
        start[after[kind[np.minimum(after, len(kind) - 1)] == _LETTER]] = True
    starts = np.flatnonzero(start)
    lengths = np.diff(np.append(starts, len(data)))
    keep = kind[starts] != _END
    if not spaces:
        keep &= kind[starts] != _SPACE
    return starts[keep], lengths[keep]


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        added = kind.get("added_tokens") or ()
        self.added = [x["content"] for x in added if x["content"]]
        pre, normal = kind["pre_tokenizer"] or {}, kind["normalizer"] or {}
        self.cuts = self.lower = False
        if pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and not normal:
            self.cuts = True
        elif ([x["type"] for x in pre.get("pretokenizers", ())] == ["Split", "ByteLevel"]
              and [x["type"] for x in normal.get("normalizers", ())] == ["NFC", "Replace", "Lowercase"]):
            self.cuts = self.lower = True
        if any(x.get("normalized") for x in added):
            self.cuts = False  # found in the normalized text, which is the library's
        if self.cuts:
            [[self.zero]] = self._library(["\0"])
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)  # hashes, ascending
        self.first = np.zeros(0, dtype=np.int64)
        self.count = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype="<u4")

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and id counts of words.  A zero byte between two words is a
        pre-token of its own, so many words go to the library as one text."""
        texts = ["\0".join(pieces[a:a + 100]) + "\0" for a in range(0, len(pieces), 100)]
        ids = np.array([i for x in self._library(texts) for i in x], dtype="<u4")
        ends = np.flatnonzero(ids == self.zero)
        if len(ends) != len(pieces):
            raise ValueError("the vocabulary does not keep a zero byte apart")
        count = np.diff(ends, prepend=-1) - 1
        return np.delete(ids, ends), count

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        word = np.array([p[-1].isalpha() and p[0] != "'" for p in pieces])
        ids, count = self._words([p for p, w in zip(pieces, word) if w])
        hashes = np.concatenate([hashes[word], hashes[~word]])
        rest = self._library([p for p, w in zip(pieces, word) if not w])
        count = np.concatenate([count, np.fromiter(map(len, rest), dtype=np.int64, count=len(rest))])
        first = len(self.ids) + np.cumsum(count) - count
        self.ids = np.concatenate([self.ids, ids, np.array([i for x in rest for i in x], dtype="<u4")])
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        self.first = np.concatenate([self.first, first])[order]
        self.count = np.concatenate([self.count, count])[order]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out: list[bytes] = []
        for a, b in slices(texts, SLICE):
            out += self._encode(texts[a:b])
        return out

    def _encode(self, texts: list[str]) -> list[bytes]:
        data, begins = text_bytes(texts)
        kind = _classes(data)
        inner = np.flatnonzero(kind == _END)  # a zero inside a text is not its end
        sure = np.ones(len(texts), dtype=bool)
        sure[np.searchsorted(begins, np.flatnonzero(kind == _UNSURE), "right") - 1] = False
        if len(inner) > len(texts):
            inner = np.setdiff1d(inner, begins[1:] - 1)
            sure[np.searchsorted(begins, inner, "right") - 1] = False
        if not self.cuts:
            sure[:] = False
        for token in self.added:
            sure[[k for k, t in enumerate(texts) if token in t]] = False
        if self.lower:
            data = data.copy()
            data[(data >= 65) & (data < 91)] += 32
            lead = np.flatnonzero(data[:-1] == 0xC3) + 1
            data[lead[(data[lead] < 0x9F) & (data[lead] != 0x97)]] += 32
        starts, lengths = _cut(data, kind, not self.lower)
        owner = np.searchsorted(begins, starts, "right") - 1
        keep = sure[owner]
        starts, lengths, owner = starts[keep], lengths[keep], owner[keep]
        hashes, at, piece = np.unique(run_hashes(data, starts, lengths), return_index=True, return_inverse=True)
        if len(self.known) > MAX_PIECES:
            self._forget()
        if len(hashes):
            place = np.searchsorted(self.known, hashes)
            new = np.ones(len(hashes), dtype=bool)
            inside = place < len(self.known)
            new[inside] = self.known[place[inside]] != hashes[inside]
            if new.any():
                raw = data.tobytes()
                self._learn(hashes[new], [raw[s:s + n].decode() for s, n in
                                          zip(starts[at[new]].tolist(), lengths[at[new]].tolist())])
                place = np.searchsorted(self.known, hashes)
            place = place[piece]
            count, first = self.count[place], self.first[place]
        else:
            count = first = np.zeros(0, dtype=np.int64)
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(first - ends + count, count) + np.arange(total)].tobytes()
        per_text = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum(np.bincount(owner, weights=count, minlength=len(texts)).astype(np.int64), out=per_text[1:])
        cuts = (4 * per_text).tolist()
        out = [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        whole = np.flatnonzero(~sure).tolist()
        for k, x in zip(whole, self._library([texts[k] for k in whole])):
            out[k] = np.array(x, dtype="<u4").tobytes()
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
