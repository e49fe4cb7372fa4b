"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints differ in at most r bits exactly if some value lies within r/2 bits of both. Every fingerprint stands for
all variants within that half radius, and variants meet by value. The shuffle is on the leading bits of the variants: a
fingerprint is sent once to each value its variants have there, and the task spells out the variants below it, a bounded
part of them at a time. Fingerprints that meet on a variant are all within r of each other, so linking each with the first
one loses no link; a group of n costs n links and not n squared.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrata.llm.blocks import U, blocks, lowered, shingle_bounds, spaced, with_tag, words, xxh64
from quadrata.llm.components import components
from quadrata.session import cut_lineage

SHINGLE, RADIUS = 4, 4
_TASK_VARIANTS = 1 << 21


def _simhash(shingle: int):
    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            parts = [np.zeros(0, dtype=U)]
            for block in blocks(batch.column("text")):
                data, w = spaced(lowered(block.data), words(block))
                first, after, doc = shingle_bounds(w, shingle)
                out = np.zeros(len(block.rows), dtype=U)
                if len(first):
                    h = xxh64(data, w.start[first], w.end[after - 1])
                    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    starts = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
                    counts = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
                    size = np.diff(np.append(starts, len(doc)))
                    packed = np.packbits(counts * 2 > size[:, None], axis=1, bitorder="little")
                    out[doc[starts]] = packed.reshape(-1).view(U)
                parts.append(out)
            prints = pa.array(np.concatenate(parts).view(np.int64))
            yield pa.RecordBatch.from_arrays([ids, batch.column("tag"), prints], ["doc_id", "tag", "fingerprint"])

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, tag, fingerprint): a bit is 1 if it is set in over half of the XXH64 (seed 42) of the word shingles, repeats included.

    A-Z is lower-cased. A text of fewer words is one shingle; a text without words (or null) has fingerprint zero.
    """
    return with_tag(docs).mapInArrow(_simhash(shingle), "doc_id bigint, tag int, fingerprint bigint")


def _masks(bits: int, most: int) -> list[int]:
    return [sum(1 << i for i in c) for k in range(most + 1) for c in itertools.combinations(range(bits), k)]


class _Ball:
    """Meets the variants of the fingerprints of one task group."""

    def __init__(self, half: int):
        self.half = half
        self.masks: dict[tuple[int, int], np.ndarray] = {}
        self.slices = np.array([bin(i).count("1") for i in range(64)])

    def below(self, bits: int, most: int) -> np.ndarray:
        if (bits, most) not in self.masks:
            self.masks[bits, most] = np.array(_masks(bits, most), dtype=U)
        return self.masks[bits, most]

    def links(self, low: np.ndarray, left: np.ndarray, bits: int, index: np.ndarray, out: list) -> None:
        """Pairs of places of values that share a variant. low: the last ``bits`` bits; left: flips each may still make."""
        if len(low) < 2:
            return
        room = 64 - bits
        count = sum(math.comb(bits, k) * int(np.count_nonzero(left >= k)) for k in range(self.half + 1))
        if bits and (count > _TASK_VARIANTS or len(low) > 1 << room):
            step = min(6, bits)
            head = (low >> U(bits - step)).astype(np.int64)
            rest = low & ((U(1) << U(bits - step)) - U(1))
            for value in range(1 << step):
                distance = self.slices[head ^ value]
                near = np.flatnonzero(distance <= left)
                self.links(rest[near], (left - distance)[near], bits - step, index[near], out)
            return
        width = U(max(1, int(len(low) - 1).bit_length()))
        parts = []
        for k in range(self.half + 1):
            own = np.flatnonzero(left == k)
            if len(own):
                variants = low[own][:, None] ^ self.below(bits, k)[None, :]
                parts.append(((variants << width) | own.astype(U)[:, None]).ravel() if bits else own.astype(U))
        met = np.sort(np.concatenate(parts))
        value, place = met >> width, (met & ((U(1) << width) - U(1))).astype(np.int64)
        if not bits:
            value = np.zeros(len(met), dtype=U)
        same = np.flatnonzero(value[1:] == value[:-1]) + 1
        if len(same):
            fresh = np.append(True, value[1:] != value[:-1])
            head = place[np.maximum.accumulate(np.where(fresh, np.arange(len(met)), 0))]
            pairs = np.unique(np.stack([index[place[same]], index[head[same]]], axis=1), axis=0)
            out.append(pairs[pairs[:, 0] != pairs[:, 1]])


def _roots(pairs: np.ndarray, n: int) -> np.ndarray:
    """Smallest place that each of n places is linked to."""
    root = np.arange(n)
    while True:
        a, b = root[pairs[:, 0]], root[pairs[:, 1]]
        if (a == b).all():
            return root
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(root, hop := root[root]):
            root = hop


def _meet(lead: int, half: int, radius: int):
    def run(batches):
        ball = _Ball(half)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        current = None

        def finish():
            values = np.concatenate([h[0] for h in held])
            left = np.concatenate([h[1] for h in held])
            order = np.argsort(values)
            values, left = values[order], left[order]
            found: list[np.ndarray] = []
            ball.links(values & ((U(1) << U(64 - lead)) - U(1)), left, 64 - lead, np.arange(len(values)), found)
            if not found:
                return None
            pairs = np.concatenate(found)
            apart = np.bitwise_count(values[pairs[:, 0]] ^ values[pairs[:, 1]])
            root = _roots(pairs[apart <= radius], len(values))
            moved = np.flatnonzero(root != np.arange(len(root)))
            return pa.RecordBatch.from_arrays([pa.array(values[moved].view(np.int64)), pa.array(values[root[moved]].view(np.int64))], ["a", "b"])

        for batch in batches:
            keys = batch.column("key").to_numpy()
            values = batch.column("fingerprint").to_numpy().view(U)
            left = batch.column("left").to_numpy().astype(np.int64)
            cuts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
            for s, e in zip(cuts[:-1], cuts[1:]):
                if s == e:
                    continue
                if held and keys[s] != current:
                    if (links := finish()) is not None:
                        yield links
                    held = []
                current = keys[s]
                held.append((values[s:e], left[s:e]))
        if held and (links := finish()) is not None:
            yield links

    return run


def ball_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links that connect exactly the distinct ``fingerprint`` values joined by steps of at most ``radius`` bits."""
    if radius % 2:
        raise ValueError("the radius must be even, so that all who meet on a variant are linked")
    half = radius // 2
    variants = prints.count() * sum(math.comb(64, k) for k in range(half + 1))
    lead = min(24, max(6, math.ceil(math.log2(max(2, variants / _TASK_VARIANTS)))))
    masks = F.explode(F.lit(_masks(lead, half))).alias("mask")
    sent = prints.select("fingerprint", masks).select(
        F.shiftrightunsigned("fingerprint", 64 - lead).bitwiseXOR(F.col("mask")).alias("key"),
        "fingerprint",
        (half - F.bit_count("mask")).alias("left"),
    )
    return sent.repartition("key").sortWithinPartitions("key").mapInArrow(_meet(lead, half, radius), "a bigint, b bigint")


def near_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, tag, fingerprint, component_id), one row per row of ``docs`` (doc_id, text; more is ignored).

    Fingerprints link at ``radius`` or fewer differing bits; component_id is the smallest doc_id that can be reached. Texts
    without words have fingerprint zero and link like any other. A null doc_id is never a component_id unless alone.
    """
    prints = cut_lineage(fingerprints(docs, shingle))
    distinct = cut_lineage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("low")))
    found = cut_lineage(components(ball_links(distinct.select("fingerprint"), radius), "a", "b"))
    rooted = distinct.join(found, distinct["fingerprint"] == found["node"], "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), "low"
    )
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lowest, "root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select("doc_id", "tag", "fingerprint", "component_id")
