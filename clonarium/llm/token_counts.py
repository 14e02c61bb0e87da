"""Token counts of every prefix of every text (operator 3).

For byte-level BPE the last token of a prefix settles its count: with t the last token of a
prefix of length i, count(i) = count(i - len(t)) + 1, and t is the one token ending at i that
BPE leaves standing after the last token of the prefix of length i - len(t). The dynamic
programme walks each distinct piece once; a text's counts are the sums over its pieces. They
are stored next to the text, so that truncation and budget questions need no encoding.

Null text counts as empty; an empty text has no tokens and no stored counts. Repeated rows are
answered one by one, a null id stays null, other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from clonarium.llm.bpe import Encoder, Pool, byte_strings, chunks, distinct_pieces, ragged, split_points
from clonarium.llm.common import documents

COUNTS_SCHEMA = "doc_id long, n_bytes long, n_chars long, prefix_counts binary"
# Bounds of a worker's memory: the length and number of prefixes, and pieces and pairs of tokens.
_REMEMBERED_LENGTH, _SHORT, _REMEMBERED, _PIECES, _PAIRS = 24, 5, 400_000, 300_000, 400_000


_BYTES = [bytes((i,)) for i in range(256)]
_IS_FIRST_BYTE = bytes(not 0x80 <= b < 0xC0 for b in range(256))


class PrefixCounter:
    """Counts at every prefix, for texts in batches."""

    def __init__(self, path: str):
        self.encoder = Encoder(path)
        vocabulary = self.encoder.library.get_vocab(with_added_tokens=False)
        # For each ending of a token the tokens that it ends with, the longest first.
        self.suffixes: dict[str, tuple[tuple[int, int], ...]] = {"": ()}
        for suffix in sorted({t[i:] for t in vocabulary for i in range(len(t))}, key=len):
            shorter = self.suffixes[suffix[1:]]
            number = vocabulary.get(suffix)
            self.suffixes[suffix] = shorter if number is None else ((len(suffix), number), *shorter)
        del self.suffixes[""]
        self.letters = {n: t for t, n in vocabulary.items()}
        self.follows: dict[int, bool] = {}
        self.seen: dict[str, tuple[int, bytes]] = {}
        self.pool = Pool(self._words, np.int32, _PIECES)

    def _stands(self, before: int, token: int) -> bool:
        """Whether BPE leaves ``token`` as it is right after ``before`` (-1: at the start)."""
        pair = before << 32 | token
        known = self.follows.get(pair)
        if known is None:
            if len(self.follows) > _PAIRS:
                self.follows.clear()
            wanted = [token] if before < 0 else [before, token]
            found = self.encoder.model.tokenize("".join(self.letters[t] for t in wanted))
            known = self.follows[pair] = [t.id for t in found] == wanted
        return known

    def _prefixes(self, letters: str) -> bytes | list[int]:
        """The count at each byte of one piece."""
        n = len(letters)
        if n > _REMEMBERED_LENGTH:
            return self._walk(letters)
        seen, ending_of, follow = self.seen, self.suffixes.get, self.follows.get
        known, unknown = 0, n + 1  # with a prefix all its prefixes are remembered
        while unknown - known > 1:
            middle = (known + unknown) // 2
            if letters[:middle] in seen:
                known = middle
            else:
                unknown = middle
        last, counts = seen[letters[:known]] if known else (-1, b"")
        for i in range(known + 1, n + 1):
            ending, begin = (), i - 1
            while begin >= 0 and (longer := ending_of(letters[begin:i])) is not None:
                ending = longer
                begin -= 1
            for size, token in ending:
                begin = i - size
                before = seen[letters[:begin]][0] if begin else -1
                stands = follow(before << 32 | token)
                if self._stands(before, token) if stands is None else stands:
                    last, count = token, (counts[begin - 1] if begin else 0) + 1
                    break
            else:
                last, count = self._encoded(letters[:i])
            counts += _BYTES[count]
            seen[letters[:i]] = last, counts
        return counts

    def _walk(self, letters: str) -> list[int]:
        """The same for a long piece, whose prefixes are not remembered."""
        states = [(-1, 0)]
        for i in range(1, len(letters) + 1):
            for size, token in self._ending(letters, i):
                last, count = states[i - size]
                if self._stands(last, token):
                    states.append((token, count + 1))
                    break
            else:
                states.append(self._encoded(letters[:i]))
        return [count for _, count in states[1:]]

    def _ending(self, letters: str, i: int) -> tuple[tuple[int, int], ...]:
        """(size, token) of the tokens that end at ``i``, the longest first."""
        ending, begin = (), i - 1
        while begin >= 0 and (longer := self.suffixes.get(letters[begin:i])) is not None:
            ending = longer
            begin -= 1
        return ending

    def _encoded(self, letters: str) -> tuple[int, int]:
        found = self.encoder.model.tokenize(letters)
        return found[-1].id, len(found)

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.seen) > _REMEMBERED:  # the short ones are shared by many words
            self.seen = {k: v for k, v in self.seen.items() if len(k) <= _SHORT}
        parts, long = [], []
        for word, letters in zip(words, byte_strings(words), strict=True):
            counts = self._prefixes(letters)
            if len(letters) > len(word):  # a character counts at its last byte
                last = word.encode("utf-8", "surrogatepass")[1:].translate(_IS_FIRST_BYTE) + b"\1"
                counts = type(counts)(compress(counts, last))
            if word in ("'re", "'ve", "'ll"):  # cut short it is an apostrophe and a letter
                counts = bytes((counts[0], counts[0] + self._prefixes(word[1])[0], counts[2]))
            if type(counts) is list:
                long.append((len(parts), counts))
                counts = bytes(len(counts))
            parts.append(counts)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        values = np.frombuffer(b"".join(parts), np.uint8).astype(np.int32)
        ends = np.cumsum(sizes)
        for place, counts in long:
            values[ends[place] - sizes[place] : ends[place]] = counts
        return values, sizes

    def counts(self, texts: list[str]) -> Iterator[np.ndarray]:
        """For each text the number of tokens of its first 1, 2 ... characters."""
        for begin, end in chunks(texts):
            group = texts[begin:end]
            lengths = np.fromiter(map(len, group), np.int64, len(group))
            joined = "".join(group)
            bounds = np.concatenate([[0], np.cumsum(lengths)])
            fast = None
            if not any(s in joined for s in self.encoder.specials):
                fast = self._ordinary(joined, bounds[:-1][lengths > 0], None)
            if fast is None:
                yield from map(self._any, group)
            else:
                yield from (fast[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))

    def _any(self, text: str) -> np.ndarray:
        """Counts of one text that may hold special tokens or code points of unsure class."""
        parts, base, begin = [], 0, 0
        while begin < len(text):
            at = [(p, -len(s), s) for s in self.encoder.specials if (p := text.find(s, begin)) >= 0]
            end, _, special = min(at, default=(len(text), 0, ""))
            # A special token that is cut short is ordinary text.
            part = text[begin:end] + special[:-1]
            counts = np.empty(0, np.int32)
            if part:
                pieces = self.encoder.library.pre_tokenizer.pre_tokenize_str(part)
                starts = np.array([span[0] for _, span in pieces], np.int64)
                counts = self._ordinary(part, np.zeros(1, np.int64), starts)
            parts.append(counts + base)
            if special:
                base += (int(counts[end - begin - 1]) if end > begin else 0) + 1
                parts.append(np.array([base], np.int32))
            begin = end + len(special)
        return np.concatenate(parts) if parts else np.empty(0, np.int32)

    def _ordinary(self, joined: str, text_starts: np.ndarray, starts: np.ndarray | None) -> np.ndarray | None:
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        if starts is None:
            starts = split_points(points, text_starts)
            if starts is None:
                return None
        if not len(points):
            return np.empty(0, np.int32)
        pieces = distinct_pieces(joined, points, starts)
        rows = self.pool.rows(pieces.distinct)[pieces.codes]
        offsets, ends = self.pool.offsets[rows], self.pool.offsets[rows + 1]
        totals = self.pool.values[ends - 1].astype(np.int64)
        before = np.cumsum(totals) - totals
        of_text = np.searchsorted(text_starts, starts, "right") - 1
        before -= before[np.searchsorted(starts, text_starts)][of_text]
        sizes = ends - offsets
        out = self.pool.values[ragged(offsets, sizes)] + np.repeat(before, sizes).astype(np.int32)
        self._white_runs(joined, points, pieces, before, of_text, out)
        return out

    def _white_runs(self, joined, points, pieces, before, of_text, out) -> None:
        """A prefix that ends with several white spaces keeps them in one piece."""
        starts, ends = pieces.starts, pieces.ends
        white = np.array([w.isspace() and not w.strip(_SPACES) for w in pieces.distinct], bool)[pieces.codes]
        opener = np.isin(points[starts], _SPACE_POINTS)
        pair = np.flatnonzero(white[:-1] & opener[1:] & (of_text[:-1] == of_text[1:]))
        if len(pair):
            runs = [joined[a : b + 1] for a, b in zip(starts[pair].tolist(), ends[pair].tolist(), strict=True)]
            distinct = list(dict.fromkeys(runs))
            values, sizes = self._words(distinct)
            whole = dict(zip(distinct, values[np.cumsum(sizes) - 1].tolist(), strict=True))
            out[ends[pair]] = before[pair] + np.array([whole[r] for r in runs])


_SPACES = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_SPACE_POINTS = np.array([ord(c) for c in _SPACES], np.uint32)


@lru_cache(2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


@lru_cache(1)
def _compressor() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=1)


@lru_cache(1)
def _decompressor() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def pack(counts: np.ndarray) -> bytes:
    """Differences of the counts, compressed; the first byte is their width."""
    steps = np.diff(counts, prepend=np.int32(0))
    width = np.int8 if not len(steps) or (steps.min() >= -128 and steps.max() <= 127) else np.int32
    return bytes([np.dtype(width).itemsize]) + _compressor().compress(steps.astype(width).tobytes())


def unpack(stored: bytes) -> np.ndarray:
    steps = np.frombuffer(_decompressor().decompress(stored[1:]), np.dtype(f"i{stored[0]}"))
    return np.cumsum(steps, dtype=np.int64)


def prefix_counts(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_chars`` and the stored counts of every text."""

    def count(batches):
        counter_here = counter(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(map(pack, counter_here.counts(texts)), pa.binary(), size=len(texts)),
                ],
                names=["doc_id", "n_bytes", "n_chars", "prefix_counts"],
            )

    return documents(docs).mapInArrow(count, COUNTS_SCHEMA)


def budget_answers(counted: DataFrame, limit: int) -> DataFrame:
    """From stored counts alone: all tokens, whether over ``limit``, the characters that fit.

    ``limit_chars`` is the longest prefix of at most ``limit`` tokens.
    """

    def answer(batches):
        for batch in batches:
            rows = batch.to_pydict()
            every = [unpack(s) for s in rows["prefix_counts"]]
            n_tokens = [int(c[-1]) if len(c) else 0 for c in every]
            fitting = [np.flatnonzero(c <= limit) for c in every]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(rows["doc_id"], pa.int64()),
                    "n_bytes": pa.array(rows["n_bytes"], pa.int64()),
                    "n_tokens": pa.array(n_tokens, pa.int64()),
                    "over_limit": pa.array([n > limit for n in n_tokens]),
                    "limit_chars": pa.array([int(f[-1]) + 1 if len(f) else 0 for f in fitting], pa.int64()),
                }
            )

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, limit_chars long"
    return counted.mapInArrow(answer, schema)
