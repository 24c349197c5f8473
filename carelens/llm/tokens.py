"""Token ids of whole texts in Arrow tasks: each distinct word piece goes through the tokenizer once per worker."""

from __future__ import annotations

import os
import unicodedata

import numpy as np

from carelens.llm.common import Rolling, mix64

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")



def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Where this machine, and every executor like it, has a vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


_SYMBOLS = 0x2070
_SPACE, _LETTER, _NUMBER, _OTHER, _UNSURE = range(5)
#: White space within the first symbols, as the word-splitting pattern of byte-level BPE sees it.
_WHITE = {*range(9, 14), 32, 0x85, 0xA0, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F}


def _kinds() -> np.ndarray:
    out = np.full(_SYMBOLS, _UNSURE, np.uint8)
    for c in (*range(0x250), *range(0x2000, _SYMBOLS)):
        kind = unicodedata.category(chr(c))
        out[c] = _SPACE if c in _WHITE else _LETTER if kind[0] == "L" else _NUMBER if kind[0] == "N" else _OTHER
    out[ord("'")] = _UNSURE  # contractions split by a rule of their own
    out[0x2065] = _UNSURE
    return out


def _letters() -> np.ndarray:
    """Byte-level BPE writes a visible Latin-1 character as itself and every other byte as the next letter from 256."""
    out = np.arange(256, dtype=np.uint16)
    hidden = np.array([b for b in range(256) if not (33 <= b < 127 or 161 <= b and b != 173)])
    out[hidden] = 256 + np.arange(len(hidden))
    return out


class Encoder:
    """ids of texts as `tokenizers` gives them, with byte-level BPE and no special tokens.

    Such a tokenizer splits a text into words by kind of character and merges within words only. Texts of common
    characters are split here for a whole batch at once and only words not met before are given to the tokenizer; any
    text with another character or an apostrophe goes to the tokenizer whole. `most` bounds the words kept.
    """

    SLOTS = 1 << 21

    def __init__(self, path: str, most: int = 3_000_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.most = most
        self.model, self.letters = self.tokenizer.model, _letters()
        self.kinds, self.hashes = _kinds(), Rolling(_SYMBOLS, 11)
        self._reset()

    def _reset(self) -> None:
        self.keys = np.zeros(self.SLOTS, np.uint64)
        self.words = np.zeros(self.SLOTS, np.int32)
        self.at = np.zeros(1024, np.int64)  # where each word's ids start
        self.size = np.zeros(1024, np.int32)
        self.ids = np.zeros(8192, np.uint32)
        self.n_words = self.n_ids = 0
        self._store([[0]])  # word 0 is the end of a document

    def _store(self, found: list[list[int]]) -> np.ndarray:
        sizes = np.fromiter(map(len, found), np.int32, len(found))
        total = int(sizes.sum())
        while self.n_words + len(found) > len(self.at):
            self.at, self.size = np.resize(self.at, 2 * len(self.at)), np.resize(self.size, 2 * len(self.size))
        while self.n_ids + total > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        new = np.arange(self.n_words, self.n_words + len(found))
        self.size[new] = sizes
        self.at[new] = self.n_ids + np.cumsum(sizes) - sizes
        self.ids[self.n_ids : self.n_ids + total] = np.fromiter((i for x in found for i in x), np.uint32, total)
        self.n_words += len(found)
        self.n_ids += total
        return new

    def _encode_texts(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, lettered: str, a: np.ndarray, b: np.ndarray) -> list[list[int]]:
        """Words go to the merge step at once, their bytes written as letters."""
        merge = self.model.tokenize
        return [[t.id for t in merge(lettered[i:j])] for i, j in zip(a.tolist(), b.tolist(), strict=True)]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each text followed by id 0, and where each text's ids start."""
        if self.n_words > self.most:
            self._reset()
        try:
            text = data.tobytes().decode("utf-8")
        except UnicodeDecodeError:  # not valid everywhere: broken bytes become U+FFFD
            bits = [data[a:b].tobytes().decode("utf-8", "replace").encode() for a, b in zip(offsets, offsets[1:], strict=False)]
            text = b"".join(bits).decode("utf-8")
            data, offsets = np.frombuffer(b"".join(bits), np.uint8), np.cumsum([0, *map(len, bits)])
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        heads = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
        ends = heads[offsets]  # text i is points[ends[i]:ends[i+1]]
        kind = self.kinds[np.minimum(points, _SYMBOLS - 1)]
        kind[points >= _SYMBOLS] = _UNSURE
        unsure = np.zeros(len(points) + 1, np.int64)
        np.cumsum(kind == _UNSURE, out=unsure[1:])
        whole = np.flatnonzero(unsure[ends[1:]] > unsure[ends[:-1]])  # texts for the tokenizer itself
        starts = self._starts(points, kind, ends)
        if len(whole):
            inside = np.zeros(len(points) + 1, np.int32)
            np.add.at(inside, ends[whole], 1)
            np.add.at(inside, ends[whole + 1], -1)
            starts &= np.cumsum(inside)[:-1] == 0
            starts[ends[whole]] = True
        first = np.flatnonzero(starts)
        last = np.append(first[1:], len(points))
        word = np.empty(len(first), np.int64)
        plain = np.ones(len(first), bool)
        if len(whole):
            spots = np.searchsorted(first, ends[whole])
            plain[spots] = False
            word[spots] = self._store(self._encode_texts([text[a:b] for a, b in zip(ends[whole], ends[whole + 1], strict=True)]))
        a, b = first[plain], last[plain]
        sums = self.hashes.sums(np.minimum(points, _SYMBOLS - 1))
        lettered = self.letters[data].tobytes().decode("utf-16-le")  # a letter for each byte
        bytes_at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        word[plain] = self._lookup(mix64(self.hashes.of(sums, a, b)), lettered, bytes_at[a], bytes_at[b])
        # A text's words, then the end of the document.
        bounds = np.searchsorted(first, ends)
        word = np.insert(word, bounds[1:], 0)
        sizes = self.size[word].astype(np.int64)
        upto = np.zeros(len(word) + 1, np.int64)
        np.cumsum(sizes, out=upto[1:])
        ids = self.ids[np.repeat(self.at[word] - upto[:-1], sizes) + np.arange(upto[-1])]
        return ids, upto[bounds + np.arange(len(bounds))]

    @staticmethod
    def _starts(points: np.ndarray, kind: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where words start. One plain space before a word belongs to it; of other white space before a word the last
        character stands alone; white space at the end of a text is one word."""
        n = len(points)
        out = np.zeros(n, bool)
        if not n:
            return out
        white = kind == _SPACE
        new = np.ones(n, bool)  # the kind differs from the one before, or a text starts
        new[1:] = kind[1:] != kind[:-1]
        begin = ends[:-1][ends[:-1] < ends[1:]]
        new[begin] = True
        after_space = np.zeros(n, bool)
        after_space[1:] = points[:-1] == 32
        after_space[begin] = False
        out = new & (white | ~after_space)
        before_word = np.zeros(n, bool)
        before_word[:-1] = white[:-1] & ~white[1:]
        before_word[ends[1:][ends[1:] > ends[:-1]] - 1] = False
        return out | before_word

    def _lookup(self, keys: np.ndarray, lettered: str, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        slots = (keys >> np.uint64(43)).astype(np.int64)
        out = self.words[slots].astype(np.int64)
        missing = np.flatnonzero(self.keys[slots] != keys)
        if len(missing):
            _, at, back = np.unique(keys[missing], return_index=True, return_inverse=True)
            at = missing[at]
            new = self._store(self._encode_words(lettered, a[at], b[at]))
            out[missing] = new[back]
            place, one = np.unique(slots[at], return_index=True)  # of words that share a slot one is kept
            self.keys[place], self.words[place] = keys[at[one]], new[one]
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file; a worker keeps it between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
