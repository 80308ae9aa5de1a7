"""Numpy helpers that run inside tasks: hashing, shingles, character grams, word caches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

# Words kept in a worker's cache before it starts afresh; bounds memory, never results.
CACHE_WORDS = 200_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x100000001B3)


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser over an array of unsigned 64-bit values."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


class WordCodes(dict):
    """Word bytes to 64-bit codes, remembered up to ``CACHE_WORDS`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code

    def of(self, text: bytes | None) -> np.ndarray:
        """Codes of the words of one text: A-Z lower-cased, split at space and 09-0D."""
        words = text.lower().split() if text else []
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_codes(words: np.ndarray, width: int) -> np.ndarray:
    """Code of every run of ``width`` words; fewer words make one shingle, none make none."""
    width = min(width, len(words))
    if width == 0:
        return words
    last = len(words) - width + 1
    out = words[:last]
    for i in range(1, width):
        out = mix64(out) * _STEP + words[i : i + last]
    return mix64(out + np.uint64(width))


def utf8(column) -> list[bytes | None]:
    """Texts of an Arrow column as bytes, nulls kept."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


class CharGrams:
    """Character runs inside words: every letter with the ``order - 1`` signs before it.

    A word is padded at its start and closed by an end sign, so no run crosses words.
    """

    def __init__(self, words: list[str], order: int):
        pad = "\x02" * (order - 1)
        text = "".join([f"{pad}{w}\x03" for w in words])
        signs = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(sizes + order) - sizes - order
        #: Position of each predicted sign (letters and the end sign), and its word.
        self.word = np.repeat(np.arange(len(words)), sizes + 1)
        within = np.arange(len(self.word)) - np.repeat(np.cumsum(sizes + 1) - sizes - 1, sizes + 1)
        self.at = starts[self.word] + order - 1 + within
        self.within = within
        self.raw, self._signs = signs, mix64(signs)
        self.first = np.append(np.flatnonzero(within == 0), len(within))

    def runs(self, length: int, rows: np.ndarray) -> list[str]:
        """The runs of ``length`` signs that end at the given positions."""
        signs = self.raw[self.at[rows, None] + np.arange(1 - length, 1)].astype(np.uint32)
        whole = signs.tobytes().decode("utf-32-le", "surrogatepass")
        return [whole[i : i + length] for i in range(0, len(whole), length)]

    def codes(self, length: int, back: int = 0) -> np.ndarray:
        """Codes of the runs of ``length`` signs that end ``back`` signs before each position."""
        out = np.full(len(self.at), length, np.uint64)
        for i in range(length):
            out = out * _STEP + self._signs[self.at - back - i]
        return mix64(out)


class WordScores(dict):
    """Word to row of a score table that grows by whole batches of unseen words."""

    def __init__(self, score: Callable[[list[str]], np.ndarray], width: int):
        super().__init__()
        self._score, self._width = score, width
        self._table, self._new = np.zeros((0, width)), []

    def __missing__(self, word: str) -> int:
        row = self[word] = len(self)
        self._new.append(word)
        return row

    def rows(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of all words of all texts, and where each text starts."""
        if len(self) >= CACHE_WORDS:
            self.clear()
            self._table = np.zeros((0, self._width))
        ends = np.cumsum([0] + [len(t) for t in texts])
        ids = np.fromiter((self[w] for t in texts for w in t), np.int64, ends[-1])
        if self._new:
            self._table = np.concatenate([self._table, self._score(self._new)])
            self._new = []
        return self._table[ids], ends


def segment_sum(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of ``values`` rows between consecutive ``ends``; empty segments give zero."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)])
    return total[ends[1:]] - total[ends[:-1]]


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in batches that stay small when single texts are very long."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


# Everything in ASCII that is no letter parts words; other signs stay with theirs.
_PARTS = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))


def letter_words(text: str | None) -> list[bytes]:
    """Lower-cased words of one text as UTF-8, parted at all ASCII signs but letters."""
    return text.lower().encode("utf-8", "replace").translate(_PARTS).split() if text else []


def gram_codes(signs: np.ndarray) -> np.ndarray:
    """Codes of equally long sign runs, one per row; equal to ``CharGrams.codes``."""
    mixed = mix64(signs.astype(np.uint64))
    out = np.full(len(signs), signs.shape[1], np.uint64)
    for i in range(signs.shape[1] - 1, -1, -1):
        out = out * _STEP + mixed[:, i]
    return mix64(out)


def sign_matrix(grams: list[str], length: int) -> np.ndarray:
    """Code points of equally long strings, one string per row."""
    raw = "".join(grams).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, np.uint32).reshape(len(grams), length)
