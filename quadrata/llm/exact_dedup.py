"""Exact dedup by progressive refinement: length, then a hash of the beginning, then a hash of the whole text."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrata.llm import bitmap
from quadrata.llm.blocks import with_tag
from quadrata.session import cut_lineage

PREFIX_BYTES = 256


def _sizes_and_texts(batch: pa.RecordBatch) -> tuple[pa.Array, pa.Array, np.ndarray]:
    text = pc.fill_null(batch.column("text"), "")
    sizes = pc.binary_length(text.cast(pa.binary())).to_numpy(zero_copy_only=False).astype(np.int64)
    return batch.column("doc_id"), text, sizes


def _length_hash(size: int) -> int:
    return xxhash.xxh64_intdigest(int(size).to_bytes(8, "little"))


def _length_hashes(sizes: np.ndarray) -> np.ndarray:
    known = {int(s): _length_hash(s) for s in np.unique(sizes)}
    return np.array([known[s] for s in sizes.tolist()], dtype=np.uint64)


def _prefix_hash(raw: bytes) -> int:
    """Hash of the length and the first bytes of a normalised text."""
    return xxhash.xxh64_intdigest(len(raw).to_bytes(8, "little") + raw[:PREFIX_BYTES].lower())


def _lengths(batches):
    for batch in batches:
        _, _, sizes = _sizes_and_texts(batch)
        yield pa.RecordBatch.from_arrays([pa.array(_length_hashes(sizes).view(np.int64))], ["h"])


def _prefixes(lengths):
    def run(batches):
        for batch in batches:
            _, text, sizes = _sizes_and_texts(batch)
            left = bitmap.holds(lengths.value, _length_hashes(sizes))
            hashes = [_prefix_hash(t.encode()) for t in text.filter(pa.array(left)).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(hashes, dtype=np.uint64).view(np.int64))], ["h"])

    return run


def _wholes(lengths, prefixes, digest_all: bool):
    def run(batches):
        for batch in batches:
            ids, text, sizes = _sizes_and_texts(batch)
            left = bitmap.holds(lengths.value, _length_hashes(sizes))
            digests, survives = [], []
            for raw, maybe in zip((t.encode() for t in text.to_pylist()), left.tolist()):
                maybe = maybe and bool(bitmap.holds(prefixes.value, np.array([_prefix_hash(raw)], dtype=np.uint64))[0])
                survives.append(maybe)
                digests.append(hashlib.sha256(raw.lower()).hexdigest() if maybe or digest_all else None)
            columns = [ids, batch.column("tag"), pa.array(digests, pa.string()), pa.array(survives, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "tag", "text_sha256", "survives"])

    return run


def exact_groups(docs: DataFrame, digest_all: bool = False, bits: int = bitmap.BITS) -> DataFrame:
    """(doc_id, tag, keep_id, group_size, kept, text_sha256), one row per row of ``docs`` (doc_id, text; more is ignored).

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal texts the largest doc_id stays.
    Groups of one length, then of one length and beginning, survive if they have two rows; only survivors are hashed whole,
    so text_sha256 is null elsewhere unless ``digest_all``. Survivor sets are bit arrays of a fixed size: what they pass
    needlessly is sorted out by the whole hash. Rows that repeat doc_id and text stay or go together; a null doc_id stays
    only in a group that has no other.
    """
    context = docs.sparkSession.sparkContext
    rows = with_tag(docs)
    again = lambda hashes: bitmap.build(hashes.groupBy("h").count().where("count > 1"), "h", bits)
    lengths = context.broadcast(again(rows.mapInArrow(_lengths, "h bigint")))
    prefixes = context.broadcast(again(rows.mapInArrow(_prefixes(lengths), "h bigint")))
    shape = "doc_id bigint, tag int, text_sha256 string, survives boolean"
    hashed = cut_lineage(rows.mapInArrow(_wholes(lengths, prefixes, digest_all), shape))  # asked three times below
    for used in (lengths, prefixes):
        used.destroy()
    groups = (
        hashed.where("survives")
        .groupBy("text_sha256")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    some = hashed.where("survives").join(groups, "text_sha256")
    rest = hashed.where("not survives").withColumns({"keep_id": F.col("doc_id"), "group_size": F.lit(1).cast("bigint")})
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    columns = ["doc_id", "tag", "keep_id", "group_size", kept.alias("kept"), "text_sha256"]
    return some.select(columns).unionByName(rest.select(columns))
