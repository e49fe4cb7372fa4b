"""Benchmark decontamination by SimHash of item-sized windows.

For every item length, windows of that many words run over every document. A window can only be as similar to an item as
asked if enough of its shingles occur in items of that length at all; that count is exact arithmetic on bit arrays and
loses nothing. Windows that pass are fingerprinted and meet items through eight blocks of their fingerprints: within
RADIUS bits at least one block differs in two bits or fewer, and items are listed under all such values. Pairs within the
radius are verified by the weighted Jaccard similarity of their shingle counts.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrata.llm import bitmap
from quadrata.llm.blocks import U, Block, Rolling, blocks, byte_symbols, mixed, words
from quadrata.session import cut_lineage

SHINGLE, SIMILARITY = 5, 0.8
BLOCKS, NEAR = 8, 2
RADIUS = BLOCKS * (NEAR + 1) - 1
_SEPARATOR = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _shingles(block: Block, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Rolling | None]:
    """Hash of the shingle at each word, how many words and which first word each document has, and the words' hashes.

    A document of fewer words than a shingle has one, of all its words; places too near the end of a document hold zero.
    """
    w = words(block, _SEPARATOR)
    counts = w.last - w.first
    n = len(w.start)
    out, rolling = np.zeros(n, dtype=U), None
    if n:
        symbols = mixed(Rolling(byte_symbols(block.data)).raw(w.start, w.end) + (w.end - w.start).astype(U))
        rolling = Rolling(symbols)
        end = np.minimum(np.arange(n) + size, np.repeat(w.last, counts))
        full = end - np.arange(n) == size
        alone = np.zeros(n, dtype=bool)
        alone[w.first[(counts > 0) & (counts < size)]] = True
        keep = np.flatnonzero(full | alone)
        out[keep] = mixed(rolling.raw(keep, end[keep]) + (end[keep] - keep).astype(U))
    return out, counts, w.first, rolling


def _of_size(h: np.ndarray, size: int) -> np.ndarray:
    return mixed(h ^ U(size * 0x9E3779B97F4A7C15 % 2**64))


def _fingerprints(hashes: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """SimHash of ``length`` hashes from each start on, by prefix sums of their bits."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(hashes) + 1, 64), dtype=np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    over = (sums[starts + length] - sums[starts]) * 2 > length
    return np.packbits(over, axis=1, bitorder="little").reshape(-1).view(U)


def _items(size: int):
    def run(batches):
        for batch in batches:
            ids = batch.column("item_id").to_pylist()
            rows = []
            for block in blocks(pc.utf8_lower(batch.column("text"))):
                h, counts, first, _ = _shingles(block, size)
                for row, n, f in zip(block.rows.tolist(), counts.tolist(), first.tolist()):
                    if n:
                        own = h[f : f + max(1, n - size + 1)]
                        print_ = _fingerprints(own, np.zeros(1, dtype=int), len(own))[0]
                        rows.append((ids[row], n, int(np.int64(print_.view(np.int64))), own.view(np.int64).tolist(), _of_size(own, n).view(np.int64).tolist()))
            columns = list(zip(*rows)) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["item_id", "size", "item_print", "item_shingles", "sized"])

    return run


def _windows(size: int, similarity: float, lengths: list[int], any_size, own_size):
    share = similarity / (1 + similarity)

    def run(batches):
        for batch in batches:
            out = []
            for block in blocks(pc.utf8_lower(batch.column("text"))):
                h, counts, first, rolling = _shingles(block, size)
                if not len(h):
                    continue
                last = np.repeat(first + counts, counts)
                for length in (n for n in lengths if n < size):  # items shorter than a shingle: one hash is all of them
                    at = np.flatnonzero((np.arange(len(h)) + length <= last) & (np.repeat(counts, counts) > length))
                    whole = mixed(rolling.raw(at, at + length) + U(length))
                    found = bitmap.holds(any_size.value, whole) & bitmap.holds(own_size.value, _of_size(whole, length))
                    doc = np.searchsorted(first + counts, at[found], side="right")
                    for d, s, p in zip(doc.tolist(), (at[found] - first[doc]).tolist(), whole[found].view(np.int64).tolist()):
                        out.append((int(block.rows[d]), length, s, length, p, [p]))
                member = bitmap.holds(any_size.value, h)
                total = np.concatenate([[0], np.cumsum(member)])
                hit = np.flatnonzero(total[first + counts] > total[first])
                for d in hit.tolist():
                    f, n = int(first[d]), int(counts[d])
                    own = h[f : f + max(1, n - size + 1)]
                    sums = total[f : f + len(own) + 1] - total[f]
                    for length in (x for x in lengths if x >= size or x == n):
                        wide = min(length, n)  # a shorter document is one window
                        a, b = max(1, wide - size + 1), max(1, length - size + 1)
                        least = int(np.ceil(share * (a + b) - 1e-9))
                        if a < least:
                            continue
                        starts = np.flatnonzero(sums[a:] - sums[:-a] >= least)
                        if not len(starts):
                            continue
                        low, high = int(starts[0]), int(starts[-1]) + a
                        sized = np.concatenate([[0], np.cumsum(bitmap.holds(own_size.value, _of_size(own[low:high], length)))])
                        starts = starts[sized[starts - low + a] - sized[starts - low] >= least]
                        if len(starts):
                            prints = _fingerprints(own[low:high], starts - low, a).view(np.int64)
                            row = int(block.rows[d])
                            out += [(row, length, s, wide, p, own[s : s + a].view(np.int64).tolist()) for s, p in zip(starts.tolist(), prints.tolist())]
            if out:
                row, length, start, wide, prints, shingles = zip(*out)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(at), batch.column("tag").take(at), pa.array(length, pa.int32()), pa.array(start, pa.int32()),
                        pa.array(wide, pa.int32()), pa.array(prints, pa.int64()), pa.array(shingles, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "tag", "size", "start", "n_words", "print", "shingles"],
                )

    return run


def _verified(batches):
    for batch in batches:
        result = []
        for a, b in zip(batch.column("shingles"), batch.column("item_shingles")):
            (x, n), (y, m) = (np.unique(v.values.to_numpy(), return_counts=True) for v in (a, b))
            _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
            common = int(np.minimum(n[i], m[j]).sum())
            result.append(common / (int(n.sum()) + int(m.sum()) - common))
        yield batch.drop_columns(["shingles", "item_shingles"]).append_column("similarity", pa.array(result, pa.float64()))


def _within(bits: int, most: int) -> list[int]:
    return [sum(1 << i for i in c) for k in range(most + 1) for c in itertools.combinations(range(bits), k)]


def leaks(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, bits: int = 24) -> DataFrame:
    """(doc_id, tag, item_id, start, n_words, similarity): for each document and item the most similar window, if similar enough.

    ``docs``: doc_id, text, tag; ``benchmark``: item_id, text. Words are runs of letters, digits and characters beyond ASCII, in
    lower case; similarity is the sum of smaller over the sum of larger shingle counts. Items or windows of fewer words than
    a shingle count as one shingle; a document shorter than an item is one window. Null and empty texts have no words and
    match nothing. Of equally similar windows the first is returned; repeated items are reported once per item_id.
    The different item lengths are collected, of which there are at most as many as words in the longest item.
    """
    context = docs.sparkSession.sparkContext
    shape = "item_id bigint, size int, item_print bigint, item_shingles array<bigint>, sized array<bigint>"
    items = cut_lineage(benchmark.select("item_id", "text").mapInArrow(_items(shingle), shape))
    lengths = [r["size"] for r in items.select("size").distinct().sort("size").collect()]
    any_size = context.broadcast(bitmap.build(items.select(F.explode("item_shingles").alias("h")), "h", bits))
    own_size = context.broadcast(bitmap.build(items.select(F.explode("sized").alias("h")), "h", bits))
    shape = "doc_id bigint, tag int, size int, start int, n_words int, print bigint, shingles array<bigint>"
    windows = docs.select("doc_id", "text", "tag").mapInArrow(_windows(shingle, similarity, lengths, any_size, own_size), shape)
    windows = cut_lineage(windows)
    for used in (any_size, own_size):
        used.destroy()
    width = 64 // BLOCKS
    part = lambda value, i: F.shiftright(value, width * i).bitwiseAND((1 << width) - 1)
    every = range(BLOCKS)
    blocks_of = lambda value: F.array(*[F.struct(F.lit(i).alias("block"), part(value, i).alias("value")) for i in every])
    listed = (
        items.select("item_id", "size", "item_print", F.inline(blocks_of(F.col("item_print"))))
        .withColumn("mask", F.explode(F.lit(_within(width, NEAR))))
        .select("item_id", "size", "item_print", "block", F.col("value").bitwiseXOR(F.col("mask").cast("bigint")).alias("value"))
    )
    asked = windows.select("doc_id", "tag", "size", "start", "print", F.inline(blocks_of(F.col("print"))))
    pairs = (
        asked.join(listed, ["size", "block", "value"])
        .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
        .select("doc_id", "tag", "size", "start", "item_id")
        .distinct()
    )
    key = ["tag", "size", "start"]
    same = [F.col(f"p.{k}") == F.col(f"w.{k}") for k in key] + [F.col("p.doc_id").eqNullSafe(F.col("w.doc_id"))]
    checked = (
        pairs.alias("p")
        .join(windows.alias("w"), same)
        .join(items.alias("i"), (F.col("p.item_id").eqNullSafe(F.col("i.item_id"))) & (F.col("p.size") == F.col("i.size")))
        .select("p.doc_id", "p.tag", "p.item_id", "p.start", "w.n_words", "w.shingles", "i.item_shingles")
        .mapInArrow(_verified, "doc_id bigint, tag int, item_id bigint, start int, n_words int, similarity double")
        .where(F.col("similarity") >= similarity)
    )
    best = F.max_by(F.struct("start", "n_words", "similarity"), F.struct("similarity", -F.col("start"))).alias("b")
    return checked.groupBy("doc_id", "tag", "item_id").agg(best).select("doc_id", "tag", "item_id", "b.*")
