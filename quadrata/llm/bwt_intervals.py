"""Substring dedup over bytes: threshold-bounded interval expansion on a Burrows-Wheeler transform.

For each group of contexts (see :mod:`quadrata.llm.repeats`) the transform of their bytes is expanded breadth first: the
intervals of strings of length l, extended backwards by one byte each, are those of length l + 1. Levels come by increasing
length and stop at the minimum length, where every interval holds the starts of one repeated string.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from quadrata.llm.blocks import with_tag
from quadrata.llm.repeats import Unit, apply_spans, repeated_spans, span_ranges, within

LENGTH, GRAM = 50, 16


def suffix_array(text: np.ndarray, depth: int, table: int = 14) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of a byte array in the order of their first ``depth`` bytes or more, the end counting as smallest; and, by
    place, the first place with the same first ``table`` (7 or 14) bytes. Only suffixes that still tie are sorted again."""
    n = len(text)
    key = np.zeros(n, dtype=np.uint64)
    padded = np.concatenate([text, np.zeros(8, dtype=np.uint8)])
    for k in range(7):  # seven bytes, and one for how many there were
        key = (key << np.uint64(8)) | padded[k : k + n]
    key = (key << np.uint64(8)) | np.minimum(np.arange(n, 0, -1), 7).astype(np.uint64)
    order = np.argsort(key)
    key = key[order]
    slots = np.arange(n)  # the places that still tie, and the sort keys there
    head = np.zeros(n, dtype=np.int64)  # by place, the first place of the same string
    rank = np.empty(n, dtype=np.int64)
    step, grouped = 7, None
    while True:
        fresh = np.ones(len(slots), dtype=bool)
        fresh[1:] = key[1:] != key[:-1]
        head[slots] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(slots)), 0))]
        rank[order[slots]] = head[slots]
        if step >= table and grouped is None:
            grouped = head.copy()
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        slots = slots[tied]
        if grouped is not None and (step >= depth or not len(slots)):
            return order, grouped
        own = order[slots]
        later = np.where(own + step < n, rank[np.minimum(own + step, n - 1)] + 1, 0)
        key = rank[own] * (n + 1) + later
        again = np.argsort(key)
        order[slots], key = own[again], key[again]
        step *= 2


def expand(order: np.ndarray, text: np.ndarray, grouped: np.ndarray, start: int, length: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that share their first ``length`` bytes with another one, and the number of each one's interval.

    ``wanted`` marks where the search sets out: the suffixes that are ``length`` - ``start`` bytes behind those asked for. No
    other one can become one of these, as each step goes one byte back.

    ``order`` is the suffix array; ``grouped`` holds the intervals of all strings of ``start`` bytes, the table from which the
    search sets out. The last-to-first mapping sends the place of a suffix to that of the suffix one byte longer. Backward
    extension of all intervals of a level at once: a place takes the interval of the suffix that starts one byte later, and
    two neighbours stay together if these intervals and their own first bytes agree. Places alone in their interval cannot
    share a longer string and leave the search.
    """
    n = len(text)
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    live = np.flatnonzero(wanted[order])
    interval = grouped[live]
    shared = np.bincount(interval, minlength=n)[interval] > 1
    live, interval = live[shared], interval[shared]
    back = np.full(n, -1, dtype=np.int64)
    for _ in range(start, length):
        suffix = order[live]
        able = suffix > 0
        to = place[suffix[able] - 1]  # the last-to-first mapping
        back[to] = interval[able]
        at = np.sort(to)
        own, head = back[at], text[order[at]]
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = (own[1:] != own[:-1]) | (head[1:] != head[:-1])
        number = np.cumsum(fresh) - 1
        shared = np.bincount(number)[number] > 1 if len(at) else fresh
        live, interval = at[shared], number[shared]
        if not len(live):
            break
    return order[live], interval


def first_documents(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, windows: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """For all windows of all contexts, one after another, the smallest document in their interval."""
    owner = np.repeat(np.arange(len(starts)), ends - starts)
    offset = np.arange(len(text)) - starts[owner]
    window = offset < windows[owner]
    answer = docs[owner]
    table = 14 if length >= 14 else 7
    if length < table:
        raise ValueError("the least length is seven bytes")
    order, grouped = suffix_array(text, length, table)
    wanted = (offset >= length - table) & (offset < length - table + windows[owner])
    suffix, interval = expand(order, text, grouped, table, length, wanted)
    inside = window[suffix]
    suffix, interval = suffix[inside], interval[inside]
    if len(suffix):
        first = np.full(int(interval.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(first, interval, docs[owner[suffix]])
        answer[suffix] = np.minimum(answer[suffix], first[interval])
    return answer[window]


def _finish(batches):
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
    for batch in batches:
        rows = []
        texts = pc.fill_null(batch.column("text"), "").cast(pa.binary()).to_pylist()
        for doc_id, raw, (starts, ends) in zip(batch.column("doc_id").to_pylist(), texts, span_ranges(batch.column("spans"))):
            if not len(starts):
                rows.append((doc_id, len(raw), 0, 0, raw, hashlib.sha256(raw).hexdigest()))
                continue
            gone = within(starts, ends, len(raw))
            kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
            count = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[0])
            rows.append((doc_id, len(raw), int(gone.sum()), count, kept, hashlib.sha256(kept).hexdigest()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_bytes", "kept_sha256"])


def drop_repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, **options) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_bytes, kept_sha256), one row per row of ``docs`` (doc_id, text).

    A byte of the UTF-8 text goes if a ``length``-byte string over it also starts in a document with a smaller doc_id. Spans
    are maximal removed runs; the rest need not be valid UTF-8 and stays binary. Null texts are empty; shorter texts and rows
    without doc_id lose nothing; rows that repeat a doc_id do not count as earlier.
    """
    docs = with_tag(docs)
    spans = repeated_spans(docs, Unit(False, length, min(gram, length)), first_documents, **options)
    return apply_spans(docs, spans, _finish, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_bytes binary, kept_sha256 string")
