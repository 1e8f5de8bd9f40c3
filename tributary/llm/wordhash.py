"""64-bit hashes of the words of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# White space that separates words: space and the controls 9 to 13.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    p[:1] = 1
    return np.cumprod(p, dtype=np.uint64)


class Words:
    """The words of some texts: ``starts``/``ends`` into ``data`` (lower-cased A-Z), their ``hashes``,
    and ``offsets``, by which words ``offsets[i]:offsets[i + 1]`` belong to text ``i``.
    """

    def __init__(self, texts: list[bytes]) -> None:
        joined = b" ".join(texts) + b" "
        self.data = data = _LOWER[np.frombuffer(joined, dtype=np.uint8)]
        space = np.concatenate(([True], _SPACE[data]))
        edge = np.flatnonzero(space[1:] != space[:-1])
        self.starts, self.ends = edge[0::2], edge[1::2]
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.offsets = np.searchsorted(self.starts, np.concatenate(([0], np.cumsum(lengths + 1))))
        # Hash of bytes s..e: sum of byte value times base^(position - s), from prefix sums (mod 2^64).
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * _powers(_BASE, len(data)), dtype=np.uint64)))
        back = _powers(_BASE_INVERSE, len(data) + 1)[self.starts]
        self.hashes = mix((sums[self.ends] - sums[self.starts]) * back + (self.ends - self.starts).astype(np.uint64))


def word_hash(word: bytes) -> int:
    """Hash of one word, the same as ``Words`` gives."""
    return int(Words([word]).hashes[0])


def text_chunks(batches: Iterator[pa.RecordBatch], text: str, size: int = 1 << 21) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with the UTF-8 of their texts (null: empty), about ``size`` bytes at a time.

    A text longer than that is a slice of its own, so memory follows the longest text and not the batch.
    """
    for batch in batches:
        column = batch.column(text).cast(pa.large_binary())
        start, total, texts = 0, 0, []
        for i, value in enumerate(column):
            t = value.as_py() or b""
            if texts and total + len(t) > size:
                yield batch.slice(start, i - start), texts
                start, total, texts = i, 0, []
            texts.append(t)
            total += len(t)
        if texts:
            yield batch.slice(start, len(texts)), texts
