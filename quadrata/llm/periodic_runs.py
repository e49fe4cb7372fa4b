"""Periodic runs of words by an enhanced suffix array and the branching-tandem test.

A branching square is a stretch ww whose two copies of w are followed by different words; its suffixes i and i + |w| then lie
in different children of one interval of the longest-common-prefix array, the one of depth |w|. So of every interval it is
enough to look at the suffixes of all children but the largest, and to ask the inverse suffix array whether the suffix |w|
words before or after lies in the interval too: n log n questions, and no tree is built. Each maximal run ends with exactly
one branching square of its period; all its other squares are rotations of that one, so rotating it to the left until a word
differs gives the run.

Everything happens inside the row of a document: no shuffle, one pass over the table. A run of 12 words or more repeats at
least six words, and every word of it lies in some six words that the document holds twice; so the array is built only over
stretches of such words, each with an alphabet of its own. Words are compared as such, not by hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from quadrata.llm.blocks import Block, Rolling, U, Words, blocks, mixed, spaced, word_hashes, words

LENGTH, REPEATS = 12, 2
SCHEMA = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
_LISTS = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))


def _ranges(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges [first, first + size) one after the other, and which range each is from."""
    own = np.repeat(np.arange(len(size)), size)
    return np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size) + first[own], own


def _covered(data: np.ndarray, w: Words, gram: int) -> np.ndarray:
    """Which words lie in a stretch of ``gram`` words that their document holds more than once.

    Stretches are compared by hash here: equal ones have equal hashes, and a false match only keeps more words.
    """
    n = len(w.start)
    out = np.zeros(n, dtype=bool)
    if n < 2 * gram:
        return out
    grams = Rolling(word_hashes(data, w)).grams(gram)
    doc = np.repeat(np.arange(len(w.first)), w.last - w.first)
    place = np.flatnonzero(doc[: len(grams)] == doc[gram - 1 :])
    keys = mixed(grams[place] + mixed(doc[place].astype(U)))
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    again = np.zeros(len(keys), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, place[again], 1)
    np.add.at(edges, place[again] + gram, -1)
    out[:] = np.cumsum(edges[:-1]) > 0
    return out


class SuffixArray:
    """Enhanced suffix array of several stretches of symbols at once; no suffix reaches beyond its stretch.

    names[k][i] is equal for two places exactly if the same 2**k symbols follow them, within their stretches.
    """

    def __init__(self, symbols: np.ndarray, stretch: np.ndarray):
        n = len(symbols)
        self.stop = np.searchsorted(stretch, stretch, side="right")
        self.names = []
        name = self._dense(stretch.astype(np.int64) * (int(symbols.max()) + 1) + symbols)
        width = 1
        while True:
            self.names.append(name)
            if int(name.max()) == n - 1:
                break
            then = np.arange(n) + width
            tail = np.where(then < self.stop, name[np.minimum(then, n - 1)].astype(np.int64) + 1, 0)
            name = self._dense(name.astype(np.int64) * (n + 1) + tail)
            width *= 2
        self.rank = name
        self.order = np.empty(n, dtype=np.int64)
        self.order[name] = np.arange(n)
        self.common = np.zeros(n + 1, dtype=np.int64)  # of neighbours in the order; between stretches 0
        self.common[1:n] = self.after(self.order[:-1], self.order[1:])

    @staticmethod
    def _dense(keys: np.ndarray) -> np.ndarray:
        order = np.argsort(keys)
        out = np.empty(len(keys), dtype=np.int32)
        out[order] = np.cumsum(np.append(0, np.diff(keys[order]) != 0))
        return out

    def after(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many equal symbols follow places a and b, which differ."""
        size = np.zeros(len(a), dtype=np.int64)
        last = len(self.stop) - 1
        for k in range(len(self.names) - 1, -1, -1):
            x, y = a + size, b + size
            inside = (x < self.stop[a]) & (y < self.stop[b])
            same = inside & (self.names[k][np.minimum(x, last)] == self.names[k][np.minimum(y, last)])
            size += same.astype(np.int64) << k
        return size

    def before(self, a: np.ndarray, b: np.ndarray, first: np.ndarray) -> np.ndarray:
        """How many equal symbols precede places a < b, not before ``first``."""
        size = np.zeros(len(a), dtype=np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            x = a - size - (1 << k)
            inside = x >= first
            x = np.maximum(x, 0)
            same = inside & (self.names[k][x] == self.names[k][x + (b - a)])
            size += same.astype(np.int64) << k
        return size

    def intervals(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, left, right) of every place of the order that shares something with the place before it.

        Its interval from left up to right is the widest one that shares as much: nearest smaller values on both sides, by
        halving steps over a table of minima.
        """
        table = [self.common]
        while len(table[-1]) > 1 << (len(table) - 1):
            step = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-step], table[-1][step:]))
        at = np.flatnonzero(self.common[:-1] > 0)
        depth = self.common[at]
        low, high = at - 1, at + 1  # all in (low, at] and in [at, high) are at least the depth
        for k in range(len(table) - 1, -1, -1):
            step = 1 << k
            begin = low - step + 1
            low = np.where((begin >= 0) & (table[k][np.maximum(begin, 0)] >= depth), low - step, low)
            ok = high < len(table[k])
            high = np.where(ok & (table[k][np.minimum(high, len(table[k]) - 1)] >= depth), high + step, high)
        return at, low, high


def runs(symbols: np.ndarray, stretch: np.ndarray, length: int = LENGTH, repeats: int = REPEATS) -> np.ndarray:
    """Rows (start, end, period) of the maximal runs of at least max(length, repeats * period) symbols, by start.

    ``stretch`` numbers the stretches that a run has to stay in, in ascending order; ``repeats`` is 2 or more.
    """
    none = np.zeros((0, 3), dtype=np.int64)
    n = len(symbols)
    if n < 2:
        return none
    array = SuffixArray(symbols, stretch)
    at, low, high = array.intervals()
    if not len(at):
        return none
    # Places of one interval follow each other and cut it into children, beginning at low and at each of the places.
    order = np.lexsort((at, high, low))
    at, low, high = at[order], low[order], high[order]
    fresh = np.append(True, (low[1:] != low[:-1]) | (high[1:] != high[:-1]))
    heads = np.flatnonzero(fresh)
    begin = np.insert(at, heads, low[heads])
    owner = np.cumsum(np.insert(fresh.astype(np.int64), heads, 0)) - 1  # the head itself counts in its own interval
    owner[heads + np.arange(len(heads))] = np.arange(len(heads))
    finish = np.append(begin[1:], 0)
    lasts = np.append(heads[1:] + np.arange(1, len(heads)) - 1, len(begin) - 1)
    finish[lasts] = high[heads]
    size = finish - begin
    largest = np.lexsort((-size, owner))[np.append(True, np.diff(np.sort(owner)) != 0)]
    small = np.ones(len(size), dtype=bool)
    small[largest] = False
    depth, left, right = array.common[at[heads]], low[heads], high[heads]
    found = []
    own = np.flatnonzero(small)
    budget = max(1 << 20, 4 * n)
    cuts = np.searchsorted(np.cumsum(size[own]), np.arange(budget, int(size[own].sum()) + budget, budget), side="right")
    for s, e in zip(np.append(0, cuts[:-1]), cuts):
        part = own[s : max(e, s + 1)] if s < len(own) else own[:0]
        if not len(part):
            continue
        places, child = _ranges(begin[part], size[part])
        box = owner[part][child]
        i, d = array.order[places], depth[box]
        for first in (i, i - d):
            other = i + d if first is i else first
            inside = (first >= 0) & (first + d < n)
            rank = array.rank[np.clip(other, 0, n - 1)]
            inside &= (rank >= left[box]) & (rank < right[box])
            a, p = first[inside], d[inside]
            stop = array.stop[a]
            apart = (a + 2 * p >= stop) | (array.names[0][np.minimum(a + p, n - 1)] != array.names[0][np.minimum(a + 2 * p, n - 1)])
            found.append(np.stack([a[apart], p[apart]], axis=1))
    squares = np.unique(np.concatenate(found), axis=0) if found else none[:, :2]
    a, p = squares[:, 0], squares[:, 1]
    first = np.searchsorted(stretch, stretch[a], side="left")
    start, end = a - array.before(a, a + p, first), a + 2 * p
    keep = end - start >= np.maximum(length, repeats * p)
    start, end, p = start[keep], end[keep], p[keep]
    order = np.lexsort((p, end, start))  # a square of a square ends in the same run as its root; the smallest period counts
    start, end, p = start[order], end[order], p[order]
    fresh = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])) if len(p) else np.zeros(0, dtype=bool)
    out = np.stack([start[fresh], end[fresh], p[fresh]], axis=1)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _codes(data: np.ndarray, w: Words) -> np.ndarray:
    """A number per word, equal for equal words."""
    line, laid = spaced(data, w)
    offsets = pa.array(np.append(laid.start, len(line)).astype(np.int64)).buffers()[1]
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(laid.start), [None, offsets, pa.py_buffer(line.tobytes())])
    return pc.dictionary_encode(column).indices.to_numpy().astype(np.int64)


def _block_runs(block: Block, length: int, repeats: int):
    """For each document of the block: number of words, runs as rows (start, length, period), and the kept words."""
    w = words(block)
    n = w.last - w.first
    if not len(w.start):
        return n, np.zeros((0, 3), dtype=np.int64), np.zeros(0, dtype=np.int64), [b""] * len(n)
    inside = _covered(block.data, w, length // 2)
    doc = np.repeat(np.arange(len(n)), n)
    line, laid = spaced(block.data, w)
    found, keep = np.zeros((0, 3), dtype=np.int64), np.ones(len(doc), dtype=bool)
    if inside.any():
        at = np.flatnonzero(inside)
        codes = _codes(block.data, Words(w.start[at], w.end[at], w.first, w.last))
        stretch = np.cumsum(np.append(0, (np.diff(at) != 1) | (np.diff(doc[at]) != 0)))
        found = runs(codes, stretch, length, repeats)
        found[:, 1] = at[found[:, 1] - 1] + 1
        found[:, 0] = at[found[:, 0]]
        edges = np.zeros(len(doc) + 1, dtype=np.int64)
        np.add.at(edges, found[:, 0] + found[:, 2], 1)
        np.add.at(edges, found[:, 1], -1)
        keep = np.cumsum(edges[:-1]) == 0
    size = laid.end - laid.start + 1
    spent = np.append(0, np.cumsum(np.where(keep, size, 0)))
    text = line[np.repeat(keep, size)].tobytes() if not keep.all() else line.tobytes()
    kept = [text[spent[a] : max(spent[b] - 1, spent[a])] for a, b in zip(w.first, w.last)]
    owner = doc[found[:, 0]]
    rows = np.stack([found[:, 0] - w.first[owner], found[:, 1] - found[:, 0], found[:, 2]], axis=1)
    return n, rows, owner, kept


def _collapse(length: int, repeats: int):
    def run(batches):
        for batch in batches:
            for block in blocks(batch.column("text")):
                n, rows, owner, kept = _block_runs(block, length, repeats)
                offsets = np.append(0, np.cumsum(np.bincount(owner, minlength=len(n))))
                values = pa.StructArray.from_arrays([pa.array(rows[:, k].copy()) for k in range(3)], fields=list(_LISTS.value_type))
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)
                ids = batch.column("doc_id").slice(int(block.rows[0]), len(block.rows))
                texts = pa.array(kept, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([ids, pa.array(n.astype(np.int64)), lists, texts], ["doc_id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, length: int = LENGTH, repeats: int = REPEATS) -> DataFrame:
    """(doc_id, n_words, runs, collapsed), one row per row of ``docs`` (doc_id bigint, text; more is ignored).

    Words are runs of characters other than space and U+0009 to U+000D, compared as they are. ``runs`` holds (start, length,
    period) of every maximal stretch of at least max(``length``, ``repeats`` * period) words that has that smallest period, by
    start and then period; starts count words from 0. ``collapsed`` is the text without the words that a run holds after its
    first period, the others joined by one space. Null and empty texts have no words, no runs and an empty ``collapsed``;
    repeated rows and null ids are rows like any other. One document has to fit into a task, with about 150 bytes a word of
    those that repeat.
    """
    if length < 2 or repeats < 2:
        raise ValueError("a run has at least two words and two periods")
    return docs.select("doc_id", "text").mapInArrow(_collapse(length, repeats), SCHEMA)
