"""Byte-level BPE over whole batches of text.

The tokenizers library encodes every distinct piece of text once; numpy finds the pieces and
puts their ids together. A piece is what the vocabulary's split pattern yields, and BPE never
merges across pieces, so the ids are those the library gives for the whole text.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import accumulate, chain, pairwise, repeat

import numpy as np
import pandas as pd

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Classes of code points in the split pattern
# '(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
OTHER, LETTER, NUMBER, SPACE, UNSURE = range(5)
# Blocks whose classes have long been settled. A text with other code points is split by the
# library, whose Unicode version may differ from Python's.
_SETTLED = [(0x0000, 0x052F), (0x1E00, 0x1FFE), (0x2000, 0x2064), (0x2070, 0x218B), (0x2190, 0x23F3),
            (0x2460, 0x2BFF), (0x3000, 0x30FF), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3), (0xFF01, 0xFFBE)]
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

_MULTIPLIER = 0x9E3779B97F4A7C15
CHUNK_CHARS = 1 << 20
CACHED_PIECES = 400_000


@lru_cache(1)
def _classes() -> np.ndarray:
    found = np.full(0x110000, UNSURE, np.uint8)
    for first, last in _SETTLED:
        for point in range(first, last + 1):
            kind = unicodedata.category(chr(point))
            if kind != "Cn":
                found[point] = {"L": LETTER, "N": NUMBER}.get(kind[0], OTHER)
    found[_WHITE] = SPACE
    return found


@lru_cache(2)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def split_points(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray | None:
    """Where pieces start in texts laid end to end; None if the classes are unsure.

    ``points`` are code points, ``text_starts`` the first positions of non-empty texts.
    """
    kinds = _classes()[points]
    if (kinds == UNSURE).any():
        return None
    n = len(points)
    first = np.zeros(n, bool)
    first[text_starts] = True
    cut = first.copy()
    cut[1:] |= kinds[1:] != kinds[:-1]
    # A space belongs to the word after it; the last of several white spaces stands apart.
    after = np.flatnonzero((kinds[1:] != SPACE) & (kinds[:-1] == SPACE) & ~first[1:]) + 1
    cut[after - 1] = True
    cut[after] = points[after - 1] != 0x20
    # An apostrophe that starts a piece takes s, t, m, d, re, ve or ll with it.
    mark = np.flatnonzero(cut[:-1] & (points[:-1] == 0x27) & (kinds[1:] == LETTER) & ~first[1:])
    if len(mark):
        one, two = points[mark + 1], points[np.minimum(mark + 2, n - 1)]
        two = np.where((mark + 2 < n) & ~first[np.minimum(mark + 2, n - 1)], two, 0)
        size = np.where(np.isin(one, [0x73, 0x74, 0x6D, 0x64]), 2, 0)
        size[((one == 0x72) | (one == 0x76)) & (two == 0x65) | (one == 0x6C) & (two == 0x6C)] = 3
        mark, size = mark[size > 0], size[size > 0]
        cut[mark + 1] = False
        end = mark + size
        cut[end[end < n]] = True
    return np.flatnonzero(cut)


class Pieces:
    """The pieces of a batch of texts and which of them are the same string."""

    def __init__(self, text: str, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray, firsts: np.ndarray):
        self.starts, self.ends, self.codes = starts, ends, codes
        self.distinct = [text[a:b] for a, b in zip(starts[firsts].tolist(), ends[firsts].tolist(), strict=True)]


def distinct_pieces(text: str, points: np.ndarray, starts: np.ndarray) -> Pieces:
    """Give equal pieces one code; found by a hash, confirmed by comparing all code points."""
    n = len(points)
    ends = np.append(starts[1:], n)
    if not len(starts):
        return Pieces(text, starts, ends, starts, starts)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * _powers(_MULTIPLIER, _room(n))[:n], out=sums[1:])
    inverse = _powers(pow(_MULTIPLIER, -1, 1 << 64), _room(n))
    hashes = (sums[ends] - sums[starts]) * inverse[starts]
    codes, _ = pd.factorize(hashes)
    firsts = np.empty(codes.max() + 1, np.int64)
    firsts[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    sizes = ends - starts
    model = starts[firsts][codes]
    same = np.array_equal(sizes, sizes[firsts][codes]) and np.array_equal(
        points, points[np.arange(n) + np.repeat(model - starts, sizes)]
    )
    if not same:  # two strings met in one hash
        words = [text[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        codes, _ = pd.factorize(np.array(words, object))
        firsts[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return Pieces(text, starts, ends, codes, firsts)


def _room(n: int) -> int:
    return CHUNK_CHARS if n <= CHUNK_CHARS else 1 << n.bit_length()


def chunks(texts: Sequence[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHUNK_CHARS characters; a longer text is a range of its own."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > CHUNK_CHARS:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def ragged(offsets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions offset, offset + 1 ... of each run, one run after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(offsets - ends + sizes, sizes)


class Pool:
    """Arrays of small integers by string, kept between batches up to a bound.

    ``make`` gets the strings not known yet and returns all their values, one string after
    the other, and how many each has.
    """

    def __init__(self, make, dtype, bound: int = CACHED_PIECES):
        self.make, self.dtype, self.bound = make, dtype, bound
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.values = np.empty(1 << 16, self.dtype)
        self.offsets = np.zeros(1, np.int64)
        self.uses = np.zeros(0, np.int32)

    def _keep_used(self) -> None:
        """Make room: only strings met in several batches stay, at most half the bound."""
        least = 2
        while np.count_nonzero(self.uses >= least) > self.bound // 2:
            least *= 2
        kept = np.flatnonzero(self.uses >= least)
        words = list(self.index)  # in order of their rows
        sizes = np.diff(self.offsets)[kept]
        self.values = self.values[ragged(self.offsets[kept], sizes)]
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        self.uses = np.ones(len(kept), np.int32)
        self.index = dict(zip([words[i] for i in kept.tolist()], range(len(kept)), strict=True))

    def rows(self, words: list[str]) -> np.ndarray:
        """Row numbers of the distinct ``words``."""
        if len(self.index) + len(words) > self.bound:
            self._keep_used()
        found = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = [words[i] for i in missing.tolist()]
            values, sizes = self.make(new)
            old, first = len(self.offsets) - 1, int(self.offsets[-1])
            if first + len(values) > len(self.values):
                self.values = np.concatenate([self.values[:first], np.empty(first // 2 + 2 * len(values), self.dtype)])
            self.values[first : first + len(values)] = values
            self.offsets = np.concatenate([self.offsets, first + np.cumsum(sizes)])
            self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int32)])
            self.index.update(zip(new, range(old, old + len(new)), strict=True))
            found[missing] = np.arange(old, old + len(new))
        self.uses[found] += 1
        return found


@lru_cache(1)
def _byte_letters() -> np.ndarray:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = np.zeros(256, np.uint32)
    letters[shown] = shown
    hidden = np.flatnonzero(letters == 0)
    letters[hidden] = 256 + np.arange(len(hidden))
    return letters


def byte_strings(words: list[str]) -> list[str]:
    """Each word as its bytes' letters."""
    joined = np.frombuffer("".join(words).encode("utf-8", "surrogatepass"), np.uint8)
    letters = _byte_letters()[joined].tobytes().decode("utf-32-le")
    if len(letters) == sum(map(len, words)):
        sizes = map(len, words)
    else:
        sizes = [len(w.encode("utf-8", "surrogatepass")) for w in words]
    ends = list(accumulate(sizes, initial=0))
    return [letters[a:b] for a, b in pairwise(ends)]


class Encoder:
    """Ids of whole texts as the tokenizers library gives them for a byte-level BPE file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.model = self.library.model
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.pool = Pool(self._encode_words, np.uint32)

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, list[int]]:
        tokenize = self.model.tokenize
        ids = [[token.id for token in tokenize(m)] for m in byte_strings(words)]
        return np.fromiter(chain.from_iterable(ids), np.uint32), list(map(len, ids))

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and how many each text has."""
        parts, sizes = [], np.zeros(len(texts), np.int64)
        for begin, end in chunks(texts):
            ids, sizes[begin:end] = self._chunk(texts[begin:end])
            parts.append(ids)
        return (np.concatenate(parts) if parts else np.empty(0, np.uint32)), sizes

    def _chunk(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = None
        if not any(s in joined for s in self.specials):
            starts = split_points(points, np.unique(bounds[:-1][lengths > 0]))
        if starts is None:
            if len(texts) > 1:
                done = [self._chunk([t]) for t in texts]
                return np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])
            ids = np.array(self.library.encode(joined, add_special_tokens=False).ids, np.uint32)
            return ids, np.array([len(ids)])
        pieces = distinct_pieces(joined, points, starts)
        rows = self.pool.rows(pieces.distinct)[pieces.codes]
        offsets = self.pool.offsets[rows]
        counts = self.pool.offsets[rows + 1] - offsets
        total = np.concatenate([[0], np.cumsum(counts)])
        at = total[np.searchsorted(starts, bounds)]
        return self.pool.values[ragged(offsets, counts)], np.diff(at)


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """One encoder for each vocabulary and worker."""
    return Encoder(path)
