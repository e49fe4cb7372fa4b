"""Strings of a fixed length that also start in an earlier document, found through groups of suffixes that share a prefix.

Only suffixes at content-chosen places (anchors) are shipped: the anchor of a window of ``length`` symbols is its leftmost
smallest gram, so equal windows have equal anchors at the same offset, and all windows of one anchor lie side by side.
One run of such windows with its text is a context. The steps:

1. grams of all anchors with the smallest and largest document each: those of two documents or more survive,
2. contexts of surviving anchors, one per different text and task, meet by their gram; the given resolver (a suffix tree or
   a Burrows-Wheeler transform) finds the first document of every window of the group,
3. all occurrences of contexts that lose something join these answers; documents collect their spans.

Survivor sets travel as bit arrays of a fixed size, which may pass too much but never lose anything. Equal contexts are
folded before any shuffle, so copies do not make a group large; a gram with more than ``hot`` occurrences is refined to
prefixes of the full length. Nothing but the bit arrays reaches the driver.

Rows without doc_id are never earlier than any other and lose nothing. Rows that repeat a doc_id are judged one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrata.llm import bitmap
from quadrata.llm.blocks import Block, Rolling, U, blocks, byte_symbols, mixed, word_hashes, words
from quadrata.session import cut_lineage

Resolver = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, int], np.ndarray]
_FLUSH_BYTES = 32 << 20
_RESOLVE_BYTES = 1 << 18
_RESOLVE_ROWS = 30_000


@dataclass(frozen=True)
class Unit:
    """What a symbol is. ``gram``: symbols of an anchor; larger ones meet less often by chance, smaller ones are fewer."""

    words: bool
    length: int
    gram: int


class Runs:
    """Runs of windows of a block that share an anchor: windows low to high, its document, the gram and the context hash."""

    def __init__(self, block: Block, unit: Unit):
        self.block, self.unit = block, unit
        if unit.words:
            w = words(block)
            symbols, first, last = word_hashes(block.data, w), w.first, w.last
            self.begin, self.finish = w.start, w.end
        else:
            symbols, first, last = byte_symbols(block.data), block.starts, block.ends
            self.begin = self.finish = None
        n, length, gram = len(symbols), unit.length, unit.gram
        self.first = first
        if n < length:
            self.low = self.high = self.doc = np.zeros(0, dtype=np.int64)
            self.key = self.context = np.zeros(0, dtype=U)
            return
        rolling = Rolling(symbols)
        self.rolling = rolling
        grams = rolling.grams(gram)
        anchor = _leftmost_smallest(grams, length - gram + 1)
        limit = np.repeat(last, last - first)[: len(anchor)]
        valid = np.arange(length, len(anchor) + length) <= limit
        fresh = np.ones(len(anchor), dtype=bool)
        fresh[1:] = (anchor[1:] != anchor[:-1]) | (limit[1:] != limit[:-1]) | (valid[1:] != valid[:-1])
        low = np.flatnonzero(fresh)
        high = np.append(low[1:], len(anchor)) - 1
        kept = valid[low]
        self.low, self.high = low[kept], high[kept]
        self.doc = np.searchsorted(last, self.low, side="right")
        self.key = mixed(grams[anchor[self.low]] ^ U(0x5851F42D4C957F2D))  # the smallest of many, so spread it again
        self.context = mixed(rolling.raw(self.low, self.high + length) + (self.high - self.low).astype(U))

    def only(self, keep: np.ndarray) -> Runs:
        for name in ("low", "high", "doc", "key", "context"):
            setattr(self, name, getattr(self, name)[keep])
        return self

    def refined(self, hot: np.ndarray) -> Runs:
        """The runs marked hot as single windows, whose whole text is the prefix they are grouped by."""
        if not hot.any():
            return self
        size = np.where(hot, self.high - self.low + 1, 1)
        at = np.repeat(np.arange(len(size)), size)
        step = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
        hot, low = hot[at], self.low[at]
        self.low = np.where(hot, low + step, low)
        self.high = np.where(hot, self.low, self.high[at])
        self.doc = self.doc[at]
        whole = mixed(self.rolling.raw(self.low, self.low + self.unit.length) ^ U(0xA5A5A5A5A5A5A5A5))
        self.key = np.where(hot, whole, self.key[at])
        self.context = np.where(hot, whole, self.context[at])
        return self

    def texts(self) -> tuple[np.ndarray, np.ndarray]:
        """The texts of all runs laid end to end, and their sizes."""
        end = self.high + self.unit.length
        if self.unit.words:
            return _gather(self.block.data, self.begin[self.low], self.finish[end - 1])
        return _gather(self.block.data, self.low, end)

    def places(self) -> np.ndarray:
        """Number of each first window inside its document."""
        return self.low - self.first[self.doc]


def _gather(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = end - start
    total = np.cumsum(size)
    return data[np.arange(int(total[-1]) if len(total) else 0) + np.repeat(start - (total - size), size)], size


def _leftmost_smallest(grams: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest value of every ``width`` neighbours; values count by their leading bits."""
    place_bits = U(max(24, int(len(grams)).bit_length()))
    m = (grams >> place_bits << place_bits) | np.arange(len(grams), dtype=U)
    span = 1
    while span * 2 <= width:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    if span < width:
        m = np.minimum(m[: len(m) - (width - span)], m[width - span :])
    return (m & ((U(1) << place_bits) - U(1))).astype(np.int64)


def _scan(batches: Iterator[pa.RecordBatch], unit: Unit) -> Iterator[tuple[pa.RecordBatch, np.ndarray, Runs]]:
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        for block in blocks(batch.column("text")):
            runs = Runs(block, unit)
            if len(runs.low):
                yield batch, ids[block.rows], runs


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _grams(unit: Unit):
    def run(batches):
        for _, ids, runs in _scan(batches, unit):
            yield pa.RecordBatch.from_arrays([pa.array(_signed(runs.key)), pa.array(ids[runs.doc])], ["key", "doc_id"])

    return run


def _contexts(unit: Unit, repeated, hot):
    """Contexts of surviving grams, each different one once per task (or per _FLUSH_BYTES of them) with its documents."""

    def folded(key, context, low, high, size) -> tuple[np.ndarray, list[np.ndarray]]:
        """The first place of each different context, and the other columns with the smallest and largest document."""
        order = np.argsort(context, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(context[order].view(np.int64)) != 0))
        own = order[first]
        return own, [key[own], context[own], np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first), size[own]]

    def as_batch(parts: list[tuple]) -> pa.RecordBatch:
        *columns, data, width = (np.concatenate(column) for column in zip(*parts))
        own, (key, context, low, high, size) = folded(*columns)
        places = np.concatenate([[0], np.cumsum(width)]).astype(np.int32)
        text = pa.Array.from_buffers(pa.binary(), len(width), [None, pa.py_buffer(places), pa.py_buffer(data)]).take(pa.array(own))
        columns = [pa.array(key.view(np.int64)), pa.array(context.view(np.int64)), pa.array(low), pa.array(high), pa.array(size.astype(np.int32)), text]
        return pa.RecordBatch.from_arrays(columns, ["key", "context", "low_doc", "high_doc", "windows", "text"])

    def run(batches):
        held: list[tuple] = []
        size = 0
        for _, ids, runs in _scan(batches, unit):
            runs.only(bitmap.holds(repeated.value, runs.key))
            runs.refined(bitmap.holds(hot.value, runs.key))
            if not len(runs.low):
                continue
            docs = ids[runs.doc]
            own, columns = folded(runs.key, runs.context, docs, docs, runs.high - runs.low + 1)
            runs.only(own)
            held.append((*columns, *runs.texts()))
            size += len(held[-1][5]) + 48 * len(held[-1][0])
            if size >= _FLUSH_BYTES:
                yield as_batch(held)
                held, size = [], 0
        if held:
            yield as_batch(held)

    return run


def _cut(keys: np.ndarray, sizes: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes that keep equal keys together."""
    edge = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    total = np.concatenate([[0], np.cumsum(sizes)])
    part = total[edge] // limit
    first = edge[np.append(True, part[1:] != part[:-1])]
    return list(zip(first.tolist(), [*first[1:].tolist(), len(keys)]))


def _answers(unit: Unit, resolve: Resolver):
    """Rows sorted by key and context: runs of windows with the first document of each, for contexts that lose something."""
    kind = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("base", pa.int64())])

    def answer(rows: pa.Table) -> pa.RecordBatch:
        key, context, low, high, size = (rows[c].to_numpy() for c in ("key", "context", "low_doc", "high_doc", "windows"))
        fresh = np.append(True, (key[1:] != key[:-1]) | (context[1:] != context[:-1]))
        own = np.flatnonzero(fresh)
        low, high = np.minimum.reduceat(low, own), np.maximum.reduceat(high, own)
        key, context, size = key[own], context[own], size[own].astype(np.int64)
        start = np.cumsum(size) - size
        base = np.repeat(low, size)
        same = np.append(False, key[1:] == key[:-1])
        same[:-1] |= same[1:]
        inside = np.flatnonzero(same)
        if len(inside):
            texts = rows["text"].take(pa.array(own[inside])).combine_chunks().cast(pa.large_binary())
            _, places, data = texts.buffers()
            places = np.frombuffer(places, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data = np.frombuffer(data, dtype=np.uint8)
            for a, b in _cut(key[inside], np.diff(places), _RESOLVE_BYTES):
                part = inside[a:b]
                at = places[a : b + 1] - places[a]
                found = resolve(data[places[a] : places[b]], at[:-1], at[1:], size[part], low[part], unit.length)
                span = size[part]
                where = np.arange(len(found)) + np.repeat(start[part] - (np.cumsum(span) - span), span)
                base[where] = np.minimum(base[where], found)
        doc = np.repeat(np.arange(len(own)), size)
        loses = base < high[doc]
        first = np.flatnonzero(np.append(True, (base[1:] != base[:-1]) | (doc[1:] != doc[:-1])))
        last = np.append(first[1:], len(base)) - 1
        first, last = first[loses[first]], last[loses[first]]
        owner = doc[first]
        named, counts = np.unique(owner, return_counts=True)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        parts = [(first - start[owner]).astype(np.int32), (last - start[owner]).astype(np.int32), base[first]]
        runs = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(x) for x in parts], fields=list(kind)))
        return pa.RecordBatch.from_arrays([pa.array(context[named]), runs], ["context", "runs"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count < _RESOLVE_ROWS:
                continue
            rows = pa.Table.from_batches(held)
            key = rows["key"].to_numpy()
            edge = np.flatnonzero(key[1:] != key[:-1])
            if len(edge):
                cut = int(edge[-1]) + 1
                yield answer(rows.slice(0, cut))
                held = rows.slice(cut).combine_chunks().to_batches()
                count -= cut
        if count:
            yield answer(pa.Table.from_batches(held))

    return run


def _occurrences(unit: Unit, repeated, hot, losing):
    def run(batches):
        for batch, ids, runs in _scan(batches, unit):
            runs.only(bitmap.holds(repeated.value, runs.key))
            runs.refined(bitmap.holds(hot.value, runs.key))
            runs.only(bitmap.holds(losing.value, runs.context))
            tags = batch.column("tag").to_numpy(zero_copy_only=False)[runs.block.rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(_signed(runs.context)), pa.array(ids[runs.doc]), pa.array(tags[runs.doc]), pa.array(runs.places().astype(np.int32))],
                ["context", "doc_id", "tag", "low"],
            )

    return run


def repeated_spans(docs: DataFrame, unit: Unit, resolve: Resolver, hot: int = 200_000, bits: int = bitmap.BITS) -> DataFrame:
    """(doc_id, tag, spans): symbols covered by a window that also starts in a smaller doc_id, in symbols of the unit.

    Spans of a document may touch or overlap. Documents that lose nothing have no row. ``docs`` has doc_id, text, tag.
    """
    context = docs.sparkSession.sparkContext
    docs = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    bare = docs.select("doc_id", "text")
    grams = (
        bare.mapInArrow(_grams(unit), "key bigint, doc_id bigint")
        .groupBy("key")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n"))
        .where("low < high")
    )
    both = cut_lineage(grams.select("key", (F.col("n") > hot).alias("is_hot")))
    repeated = context.broadcast(bitmap.build(both, "key", bits))
    hot_keys = context.broadcast(bitmap.build(both.where("is_hot"), "key", min(bits, 24)))
    answers = cut_lineage(
        bare.mapInArrow(_contexts(unit, repeated, hot_keys), "key bigint, context bigint, low_doc bigint, high_doc bigint, windows int, text binary")
        .repartition("key")
        .sortWithinPartitions("key", "context")
        .mapInArrow(_answers(unit, resolve), "context bigint, runs array<struct<first: int, last: int, base: bigint>>")
    )
    losing = context.broadcast(bitmap.build(answers, "context", bits))
    places = docs.select("doc_id", "text", "tag").mapInArrow(
        _occurrences(unit, repeated, hot_keys, losing), "context bigint, doc_id bigint, tag int, low int"
    )
    spans = places.join(answers, "context").select(
        "doc_id", "tag", "low", F.inline(F.filter("runs", lambda r: r["base"] < F.col("doc_id")))
    )
    ends = spans.select("doc_id", "tag", F.struct((F.col("low") + F.col("first")).alias("start"), (F.col("low") + F.col("last") + unit.length).alias("end")).alias("span"))
    return ends.groupBy("doc_id", "tag").agg(F.collect_list("span").alias("spans"))


def apply_spans(docs: DataFrame, spans: DataFrame, finish, schema: str) -> DataFrame:
    """mapInArrow of ``finish`` over (doc_id, text, spans). Only the texts of documents with spans are shuffled."""
    spans = cut_lineage(spans)
    concerned, rest = bitmap.split(docs, ["doc_id", "tag"], spans)
    own = concerned.join(spans, ["doc_id", "tag"], "left").select("doc_id", "text", "spans")
    empty = F.lit(None).cast("array<struct<start: int, end: int>>").alias("spans")
    return own.mapInArrow(finish, schema).unionByName(rest.select("doc_id", "text", empty).mapInArrow(finish, schema))


def span_ranges(lists: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Starts and ends of the spans of every row; none for null."""
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    flat = lists.flatten()
    starts, ends = (flat.field(name).to_numpy() for name in ("start", "end"))
    to = np.cumsum(size)
    return [(starts[a:b], ends[a:b]) for a, b in zip((to - size).tolist(), to.tolist())]


def within(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n symbols lie in a span."""
    edge = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


def covered(spans: list[dict] | None, n: int) -> np.ndarray:
    """The same for spans as a list."""
    return within(np.array([s["start"] for s in spans or []], dtype=np.int64), np.array([s["end"] for s in spans or []], dtype=np.int64), n)
