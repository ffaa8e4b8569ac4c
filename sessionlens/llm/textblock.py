"""Vectorised word splitting and rolling hashes over Arrow text batches.

A *block* is a run of documents whose texts together stay near a byte target
(one longer document is a block of its own), so the memory of a task depends
on the block target and the longest document, never on a partition.

Words are maximal runs of bytes of one class. Both word definitions in use
cut only at ASCII bytes, so working on UTF-8 bytes gives the same words as
working on code points.

Hashes are 64 bit: a prefix sum of ``TABLE[byte] * BASE**i`` gives every
word (or line) hash by one subtraction, wrapping modulo 2**64; a finaliser
spreads the bits. Two different words, shingles or windows are taken as
equal only when 64-bit hashes collide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
BLOCK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.default_rng(20240229).integers(1, 2**64, 256, dtype=U64)

# byte classes: True where the byte belongs to a word
SPACE_WORDS = np.ones(256, bool)
SPACE_WORDS[[0x20, *range(0x09, 0x0E)]] = False
ALNUM_WORDS = np.zeros(256, bool)
ALNUM_WORDS[0x30:0x3A] = True
ALNUM_WORDS[0x61:0x7B] = True
ALNUM_WORDS[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int, name: str) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, grown by doubling and kept."""
    have = _powers.get(name)
    if have is None or len(have) < n:
        out = np.ones(1, U64)
        while len(out) < n:
            out = np.concatenate([out, out * U64(pow(base, len(out), 1 << 64))])
        _powers[name] = have = out
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (two xor-shift multiply rounds)."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte span [start, end) of ``data``."""
    if len(start) == 0:
        return np.zeros(0, U64)
    prefix = np.zeros(len(data) + 1, U64)
    np.cumsum(_TABLE[data] * _power(_BASE, len(data), "up"), out=prefix[1:])
    inv = _power(_INV, len(data) + 1, "down")
    return mix((prefix[end] - prefix[start]) * inv[start] + (end - start).astype(U64))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Order-sensitive hash of every n consecutive entries (may be empty)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    out = np.zeros(m, U64)
    for k in range(n):
        out = out * U64(0xD6E8FEB86659FD93) + words[k:k + m]
    return mix(out + U64(n))


@dataclass
class Block:
    """Texts of consecutive rows, with their words.

    ``rows`` is the first row's number in the batch; ``doc`` gives each word's
    text number within the block; ``first[i]:first[i+1]`` are text i's words.
    """

    rows: int
    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end)

    def windows(self, n: int) -> np.ndarray:
        """Word indices at which an n-word window inside one text starts."""
        w = len(self.doc) - n + 1
        if w <= 0:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.doc[:w] == self.doc[n - 1:n - 1 + w])


def split_block(texts: list[bytes], word: np.ndarray = SPACE_WORDS, lower: bool = False,
                rows: int = 0) -> Block:
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    if lower:
        data = LOWER[data]
    mask = word[data]
    padded = np.zeros(len(data) + 2, bool)
    padded[1:-1] = mask
    begin = mask & ~padded[:-2]
    finish = mask & ~padded[2:]
    edge = offsets[1:-1]
    inner = edge[(edge > 0) & (edge < len(data))]
    begin[inner] |= mask[inner]
    finish[inner - 1] |= mask[inner - 1]
    start = np.flatnonzero(begin)
    end = np.flatnonzero(finish) + 1
    doc = np.searchsorted(offsets, start, side="right") - 1
    first = np.searchsorted(start, offsets, side="left")
    return Block(rows, data, offsets, start, end, doc, first)


def utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """Column of strings as UTF-8 bytes; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    return [b"" if x is None else x for x in column.to_pylist()]


def blocks(texts: list[bytes], word: np.ndarray = SPACE_WORDS, lower: bool = False,
           target: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of near ``target`` bytes, in row order."""
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) <= target):
            size += len(texts[to])
            to += 1
        yield split_block(texts[at:to], word, lower, at)
        at = to


def code_points(data: np.ndarray) -> np.ndarray:
    """Prefix count of code points: entry i counts those starting before byte i."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def covered(n: int, start: np.ndarray, length: int) -> np.ndarray:
    """Mask of length n: True inside any [s, s + length)."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, start, 1)
    np.add.at(edge, np.minimum(start + length, n), -1)
    return np.cumsum(edge[:n]) > 0


def signed(h: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark longs."""
    return h.view(np.int64)
