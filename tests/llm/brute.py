"""Plain single-process versions of what the operators return, for small inputs."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def starts_earlier(sequences: dict, length: int) -> dict:
    """For each (doc_id, sequence) in a list: which places are covered by a window that starts in a smaller doc_id."""
    first = {}
    for doc, seq in sequences:
        for i in range(len(seq) - length + 1):
            key = tuple(seq[i : i + length]) if not isinstance(seq, bytes) else seq[i : i + length]
            if doc is not None:
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, seq in sequences:
        gone = [False] * len(seq)
        for i in range(len(seq) - length + 1):
            key = tuple(seq[i : i + length]) if not isinstance(seq, bytes) else seq[i : i + length]
            if doc is not None and first[key] < doc:
                gone[i : i + length] = [True] * length
        out.append(gone)
    return out


def words_removed(docs, length: int):
    sequences = [(d, WORD.findall(t or "")) for d, t in docs]
    rows = []
    for (doc, seq), gone in zip(sequences, starts_earlier(sequences, length)):
        kept = " ".join(w for w, g in zip(seq, gone) if not g)
        rows.append((doc, len(seq), sum(gone), sha(kept.encode())))
    return rows


def bytes_removed(docs, length: int):
    sequences = [(d, (t or "").encode()) for d, t in docs]
    rows = []
    for (doc, seq), gone in zip(sequences, starts_earlier(sequences, length)):
        kept = bytes(b for b, g in zip(seq, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        rows.append((doc, len(seq), sum(gone), spans, sha(kept)))
    return rows
