"""Token ids of many texts with a given byte-level tokenizer file.

A text is cut at every single blank between two characters that are not white space, and at a mark such as a comma after a
letter. Byte-level tokenizers start a new piece there whatever stands around it (of marks this is tried first), so the ids of the parts, put
together, are those of the whole text; each different part is encoded once and remembered. Parts are found and told apart as bytes; new ones that
are cut on both sides are encoded many at a time as one text, whose ids fall to the parts by the bytes they stand for.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from .batches import raw

#: File of the byte-level vocabulary that the queries use, by its name in the package of public tokenizers.
BYTE_BPE = "byte_bpe_50k.json"
#: Parts that are remembered before some are forgotten, about 100 MB.
REMEMBERED = 400_000
#: Parts encoded at once; an encoding is far larger than its ids.
AT_ONCE = 1_000
#: Bytes and rows of a list of texts: in a longer list more parts are looked up once for all their places.
LIST_BYTES, LIST_ROWS = 1 << 23, 1 << 13

_BLANK = "\u0120"
# Characters that stand for bytes in byte-level vocabularies: those in print for themselves, the others by turns from U+0100 on.
_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_WRITTEN = {b: 0x100 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTED)}
# Letters before this one are the same in all versions of Unicode that are in use.
_BEYOND = "\u0250"
_MARK, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_MARK[[ord(c) for c in ".,;:!?"]] = True
_LETTER[65:91] = _LETTER[97:123] = True
# Bytes that a character next to a cut may start with: neither white space nor the lead of a character that may be.
_FIRM = np.ones(256, bool)
_FIRM[:0x21] = _FIRM[0x7F] = False
_FIRM[0x80:0xC0] = False
_FIRM[[0xC2, 0xE1, 0xE2, 0xE3]] = False


def public_path(name: str = BYTE_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _cuts(data: np.ndarray, offsets: np.ndarray, at_marks: bool) -> np.ndarray:
    """Places of the blanks, and of the marks if wanted, at which a text is cut."""
    at = np.flatnonzero(data[1:-1] == 0x20) + 1
    lead = at - 1
    late = np.flatnonzero(data[lead] >= 0x80)
    for _ in range(3):  # back to the first byte of the character before
        some = lead[late]
        lead[late] = some - ((data[some] >= 0x80) & (data[some] < 0xC0) & (some > 0))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    blanks = at[_FIRM[data[lead]] & _FIRM[data[at + 1]] & ~edge[at] & ~edge[at + 1]]
    if not at_marks:
        return blanks
    marks = np.flatnonzero(_MARK[data[1:]] & _LETTER[data[:-1]]) + 1
    return np.concatenate([blanks, marks[~edge[marks]]])


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str) -> Encoder:
    """Encoder of a worker process, which keeps what it remembers from one task to the next; one at a time."""
    about = os.stat(path)
    key = (path, about.st_size, about.st_mtime_ns)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(path)
    return _encoders[key]


class Encoder:
    """Encodes lists of texts; remembers up to ``REMEMBERED`` parts, then forgets those that were asked for in one list only."""

    def __init__(self, path: str):
        # Spark runs one encoder per core; threads of its own would only add memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        added = {i: len(t.content.encode()) for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        size = max(self.tokenizer.get_vocab_size(), *(i + 1 for i in added), 1)
        self.bytes_of = np.array([added[i] if i in added else len(self.tokenizer.id_to_token(i) or "") for i in range(size)])
        # Whether a blank with the letters after it is a piece of its own, also before a mark, and the blank is written as a letter.
        byte_level = self.tokenizer.normalizer is None and self.tokenizer.pre_tokenizer is not None
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(" ab Cd.,e \u00e9\u00c0\u0131") if byte_level else []
        written = [_BLANK + "ab", _BLANK + "Cd", ".,", "e", _BLANK + "\u00c3\u00a9\u00c3\u0122\u00c4\u00b1"]
        self.model = self.tokenizer.model if [x for x, _ in pieces] == written else None
        self.known: dict[bytes, int] = {}  # number of each part, in the order of the dictionary
        self.ids = np.zeros(0, np.uint32)  # of all parts, by number
        self.sizes = np.zeros(0, np.int32)
        self.asked = np.zeros(0, np.int32)  # lists that had the part

    @property
    def width(self) -> int:
        """Bytes an id needs."""
        return 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4

    def _forget(self) -> None:
        """Keeps what was asked for again, the most frequent half of ``REMEMBERED`` at most."""
        keep = np.flatnonzero(self.asked > 1)
        if len(keep) > REMEMBERED // 2:
            keep = np.sort(keep[np.argsort(-self.asked[keep], kind="stable")[: REMEMBERED // 2]])
        parts = list(self.known)
        self.known = {parts[i]: n for n, i in enumerate(keep.tolist())}
        begins = np.cumsum(self.sizes, dtype=np.int64) - self.sizes
        self.ids = self.ids[_spread(begins[keep], self.sizes[keep])]
        self.sizes = self.sizes[keep]
        self.asked = np.zeros(len(keep), np.int32)

    def _remember(self, parts: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        n = len(self.known)
        self.known.update(zip(parts, range(n, n + len(parts))))
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])
        self.sizes = np.concatenate([self.sizes, sizes.astype(np.int32)])
        self.asked = np.concatenate([self.asked, np.zeros(len(parts), np.int32)])

    def _learn(self, parts: list[bytes]) -> None:
        """Encode parts one by one."""
        for begin in range(0, len(parts), AT_ONCE):
            some = parts[begin : begin + AT_ONCE]
            found = [x.ids for x in self.tokenizer.encode_batch_fast([p.decode() for p in some], add_special_tokens=False)]
            self._remember(some, np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found]))

    def _learn_inner(self, parts: list[bytes]) -> None:
        """Encode parts that are cut on both sides, many as one text; a blank and letters are one piece, which needs the model alone."""
        if self.model is not None:
            tokenize, words, others, found, sizes = self.model.tokenize, [], [], [], []
            for x in parts:
                word = x[1:].decode()
                if not word.isalpha() or not (word.isascii() or max(word) < _BEYOND):
                    others.append(x)
                    continue
                tokens = tokenize(_BLANK + (word if word.isascii() else x[1:].decode("latin-1").translate(_WRITTEN)))
                found += [t.id for t in tokens]
                sizes.append(len(tokens))
                words.append(x)
            self._remember(words, np.array(found, np.uint32), np.array(sizes, np.int32))
            parts = others
        packed, counted, done, apart = [], [], [], []
        for begin in range(0, len(parts), AT_ONCE):
            some = parts[begin : begin + AT_ONCE]
            ids = np.array(self.tokenizer.encode_batch_fast([b"".join(some).decode()], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.cumsum([len(p) for p in some])
            reached = np.cumsum(self.bytes_of[ids])
            last = np.searchsorted(reached, ends)
            if not len(reached) or reached[-1] != ends[-1] or (reached[last] != ends).any():
                apart += some  # a tokenizer that changes texts, or joins over a cut
                continue
            packed.append(ids)
            counted.append(np.diff(last + 1, prepend=0))
            done += some
        if done:
            self._remember(done, np.concatenate(packed), np.concatenate(counted))
        self._learn(apart)

    def encode(self, texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each; null is empty."""
        data, offsets = raw(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()))
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        cuts = _cuts(data, offsets, self.model is not None)
        begin = np.zeros(len(data) + 1, bool)
        begin[offsets] = begin[cuts] = True
        begin[-1] = False
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(data))
        # Parts lie one behind the other, so they are a column of byte strings as they stand.
        column = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)]
        ).dictionary_encode()
        codes, (joined, at) = column.indices.to_numpy(), raw(column.dictionary.cast(pa.large_binary()))
        joined, at = joined.tobytes(), at.tolist()
        different = [joined[b:e] for b, e in zip(at, at[1:])]
        number = list(map(self.known.get, different))
        if None in number:
            cut = np.zeros(len(data) + 1, bool)
            cut[cuts] = True
            inner = np.zeros(len(different), bool)
            inner[codes[cut[starts] & cut[ends] & (data[starts] == 0x20)]] = True  # what is cut on both sides anywhere
            if len(self.known) + number.count(None) > REMEMBERED:
                self._forget()
                number = list(map(self.known.get, different))
            new = [i for i, n in enumerate(number) if n is None]
            self._learn_inner([different[i] for i in new if inner[i]])
            self._learn([different[i] for i in new if not inner[i]])
            for i in new:
                number[i] = self.known[different[i]]
        number = np.array(number, np.int64)
        self.asked[number] += 1
        begins = (np.cumsum(self.sizes, dtype=np.int64) - self.sizes)[number]
        each = self.sizes[number][codes]
        owner = np.searchsorted(starts, offsets)  # first part of each text
        counts = np.diff(np.concatenate(([0], np.cumsum(each, dtype=np.int64)))[owner])
        return self.ids[_spread(begins[codes], each)], counts


def _spread(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of runs that start at ``begins``."""
    ends = np.cumsum(sizes, dtype=np.int64)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - (ends - sizes), sizes)
