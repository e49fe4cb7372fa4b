"""Substring dedup over words: prefix-partitioned suffix trees.

Suffixes are dealt to groups by a prefix: the words of their anchor, or all the words of a window where that prefix is too
common (see :mod:`quadrata.llm.repeats`). In each group the suffix tree is built over word numbers; its internal nodes at
least ``length`` words deep are the repeats, and every leaf below such a node learns the first document of the node.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quadrata.llm.blocks import Block, with_tag, word_hashes, words
from quadrata.llm.repeats import Unit, apply_spans, covered, repeated_spans

LENGTH, GRAM = 50, 20


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Rank of every suffix by its first ``depth`` symbols or more, by doubling; equal ones share a rank."""
    _, rank = np.unique(symbols, return_inverse=True)
    rank = rank.astype(np.int64)
    step = 1
    while step < depth:
        later = np.zeros(len(rank), dtype=np.int64)
        later[:-step] = rank[step:] + 1
        _, rank = np.unique(rank * (len(rank) + 2) + later, return_inverse=True)
        step *= 2
    return rank


def tree_intervals(symbols: np.ndarray, limits: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Leaves in order and the number of the highest internal node of depth ``length`` or more above each.

    ``limits``: symbols left to each suffix before its context ends. Neighbouring leaves hang below one such node exactly
    if their common prefix, read off the tree's edges, is ``length`` long; a leaf that hangs alone has a node of its own.
    Suffixes with fewer symbols left run over into the next context; they come last, each with a node of its own, since
    between two equal windows they would part them.
    """
    order = np.argsort(suffix_order(symbols, length), kind="stable")
    fits = limits[order] >= length
    order, short = order[fits], order[~fits]
    a, b = order[:-1], order[1:]
    common = np.zeros(len(a), dtype=np.int64)
    live = np.arange(len(a))
    for k in range(length):
        live = live[symbols[a[live] + k] == symbols[b[live] + k]]
        common[live] = k + 1
    apart = np.concatenate([common < length, np.ones(len(short), dtype=bool)])
    leaves = np.concatenate([order, short])
    return leaves, np.concatenate([[0], np.cumsum(apart[: len(leaves) - 1])])[: len(leaves)]


def first_documents(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, windows: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """For all windows of all contexts, one after another, the smallest document below their node."""
    block = Block(np.arange(len(starts)), data, starts, ends)
    w = words(block)
    symbols = word_hashes(block.data, w)
    counts = w.last - w.first
    limits = np.repeat(w.last, counts) - np.arange(len(symbols))
    order, node = tree_intervals(symbols, limits, length)
    owner = np.repeat(np.arange(len(starts)), counts)
    first = np.full(node[-1] + 1 if len(node) else 0, np.iinfo(np.int64).max)
    np.minimum.at(first, node, docs[owner[order]])
    answer = np.empty(len(symbols), dtype=np.int64)
    answer[order] = first[node]
    return answer[np.arange(len(symbols)) - w.first[owner] < windows[owner]]


def _finish(batches):
    for batch in batches:
        rows = []
        for doc_id, text, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans"))):
            data = np.frombuffer((text or "").encode(), dtype=np.uint8)
            w = words(Block(np.zeros(1, dtype=int), data, np.zeros(1, dtype=int), np.array([len(data)]))) if len(data) else None
            n = len(w.start) if w else 0
            gone = covered(spans, n)
            raw = data.tobytes()
            kept = b" ".join([raw[s:e] for s, e in zip(w.start[~gone].tolist(), w.end[~gone].tolist())]) if n else b""
            rows.append((doc_id, n, int(gone.sum()), kept.decode(), hashlib.sha256(kept).hexdigest()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))], ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"])


def drop_repeated_words(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, **options) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, kept_sha256), one row per row of ``docs`` (doc_id, text; more is ignored).

    Words are runs of characters other than space and U+0009 to U+000D. A word goes if a window of ``length`` words over it
    also starts in a document with a smaller doc_id; within one document repeats stay. Null and empty texts have no words;
    shorter texts lose nothing; rows without doc_id lose nothing; rows that repeat a doc_id do not count as earlier.
    """
    docs = with_tag(docs)
    spans = repeated_spans(docs, Unit(True, length, min(gram, length)), first_documents, **options)
    return apply_spans(docs, spans, _finish, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, kept_sha256 string")
