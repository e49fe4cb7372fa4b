"""Texts of Arrow batches as byte arrays, their words and their hashes, a bounded block of whole documents at a time.

Inside a task only. Spark deals out and shuffles the rows; these helpers replace loops over characters by numpy calls.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U = np.uint64
BLOCK_BYTES = 1 << 18
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CODES = np.random.default_rng(20240229).integers(0, 2**64, 256, dtype=U)
_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, np.ndarray] = {}


def small_batches(spark: SparkSession, size: str = "4m") -> None:
    """From now on this session hands rows to Python in batches of at most ``size``, or of one longer row."""
    spark.conf.set(BATCH_BYTES, size)


def with_tag(docs: DataFrame) -> DataFrame:
    """doc_id, text and a tag that tells rows of one doc_id with different texts apart."""
    return docs.select("doc_id", "text", F.xxhash64("text").bitwiseAND(0xFFFFFF).cast("int").alias("tag"))


@dataclass
class Block:
    """Whole documents laid end to end: ``rows`` are their places in the batch, document i is data[starts[i]:ends[i]]."""

    rows: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of at most ``limit`` bytes, or of one longer document. A null text is empty."""
    array = pc.fill_null(texts, "").cast(pa.large_binary())
    _, offsets, data = array.buffers()
    places = np.frombuffer(offsets, dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(array):
        last = max(first + 1, int(np.searchsorted(places, places[first] + limit, side="right")) - 1)
        own = places[first : last + 1] - places[first]
        yield Block(np.arange(first, last), whole[places[first] : places[last]], own[:-1], own[1:])
        first = last


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return _LOWER[data]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(29))


def _power_table(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        table = np.full(max(n, 4 * BLOCK_BYTES), base, dtype=U)
        table[0] = 1
        known = np.cumprod(table)
        if n <= 16 * BLOCK_BYTES:
            _powers[base] = known
    return known[:n]


class Rolling:
    """64-bit hashes of any slices of a symbol array, from one pass of prefix sums."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols) + 1
        self.sums = np.zeros(n, dtype=U)
        np.cumsum(symbols * _power_table(_BASE, n)[:-1], out=self.sums[1:])
        self.undo = _power_table(pow(_BASE, -1, 2**64), n)

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.undo[start]

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k symbols from each place on."""
        return mixed((self.sums[k:] - self.sums[:-k]) * self.undo[: len(self.undo) - k])


def byte_symbols(data: np.ndarray) -> np.ndarray:
    return _CODES[data]


@dataclass
class Words:
    """Word i is data[start[i]:end[i]]; document j has the words first[j] to last[j] - 1."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    last: np.ndarray


def words(block: Block, separator: np.ndarray = _SEPARATOR) -> Words:
    """Runs of bytes other than space and U+0009 to U+000D (or another table); no word crosses documents."""
    inside = ~separator[block.data]
    n = len(inside)
    edge = np.zeros(n + 1, dtype=bool)
    edge[block.starts] = True
    edge[n] = True
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(start, end, np.searchsorted(start, block.starts), np.searchsorted(start, block.ends))


def word_hashes(data: np.ndarray, w: Words) -> np.ndarray:
    if not len(w.start):
        return np.zeros(0, dtype=U)
    return mixed(Rolling(_CODES[data]).raw(w.start, w.end) + (w.end - w.start).astype(U))


def spaced(data: np.ndarray, w: Words) -> tuple[np.ndarray, Words]:
    """The words with exactly one space after each, and where they are there."""
    size = w.end - w.start
    ends = np.cumsum(size + 1)
    starts = ends - size - 1
    out = data[np.minimum(np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(w.start - starts, size + 1), max(len(data) - 1, 0))]
    out[ends - 1] = 32
    return out, Words(starts, ends - 1, w.first, w.last)


# The primes of XXH64.
_P1, _P2, _P3 = U(0x9E3779B185EBCA87), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9)
_P4, _P5 = U(0x85EBCA77C2B2AE63), U(0x27D4EB2F165667C5)


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << U(r)) | (x >> U(64 - r))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * _P2, 31) * _P1


def xxh64(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of the slices of a byte array, all at once; slices over 256 bytes one by one."""
    out = np.zeros(len(start), dtype=U)
    size = end - start
    long = np.flatnonzero(size > 256)
    raw = data.tobytes() if len(long) else b""
    for i in long:
        out[i] = xxhash.xxh64_intdigest(raw[start[i] : end[i]], seed)
    short = np.flatnonzero(size <= 256)
    if not len(short):
        return out
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    lanes = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
    at, left = start[short].copy(), size[short].copy()
    s = U(seed)
    with np.errstate(over="ignore"):
        h = np.full(len(short), s + _P5, dtype=U)
        big = np.flatnonzero(left >= 32)
        if len(big):
            v = [np.full(len(big), x, dtype=U) for x in (s + _P1 + _P2, s + _P2, s, s - _P1)]
            live = np.arange(len(big))
            while len(live):
                own = big[live]
                for k in range(4):
                    v[k][live] = _round(v[k][live], lanes[at[own] + 8 * k])
                at[own] += 32
                left[own] -= 32
                live = live[left[own] >= 32]
            total = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
            for k in range(4):
                total = (total ^ _round(np.zeros(len(big), dtype=U), v[k])) * _P1 + _P4
            h[big] = total
        h += size[short].astype(U)
        while len(own := np.flatnonzero(left >= 8)):
            h[own] = _rotl(h[own] ^ _round(np.zeros(len(own), dtype=U), lanes[at[own]]), 27) * _P1 + _P4
            at[own] += 8
            left[own] -= 8
        if len(own := np.flatnonzero(left >= 4)):
            h[own] = _rotl(h[own] ^ ((lanes[at[own]] & U(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
            at[own] += 4
            left[own] -= 4
        while len(own := np.flatnonzero(left >= 1)):
            h[own] = _rotl(h[own] ^ ((lanes[at[own]] & U(0xFF)) * _P5), 11) * _P1
            at[own] += 1
            left[own] -= 1
        h = (h ^ (h >> U(33))) * _P2
        h = (h ^ (h >> U(29))) * _P3
        out[short] = h ^ (h >> U(32))
    return out


def shingle_bounds(w: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, word after the last, and document of every shingle; a shorter document is one shingle, an empty one none."""
    count = w.last - w.first
    shingles = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    doc = np.repeat(np.arange(len(count)), shingles)
    rank = np.arange(len(doc)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    first = w.first[doc] + rank
    return first, np.minimum(first + size, w.last[doc]), doc
