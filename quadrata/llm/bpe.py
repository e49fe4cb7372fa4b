"""Byte-level BPE: pre-tokens found by class arrays and a scan of transition functions, cached merging, exact decoding.

The pattern that cuts texts into pre-tokens is run as an automaton of eight states. Each character is a function from state
to state; functions compose associatively, so a block of text is cut into rows whose functions are composed side by side,
the rows are combined by doubling, and a last pass reads off where tokens start. No regular expression is involved.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quadrata.llm.blocks import blocks

# The characters with the Unicode property White_Space.
WHITE_SPACE = (
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007,
    0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
# Endings that an apostrophe is joined to, by their length.
ENDINGS = {1: ("s", "t", "m", "d"), 2: ("re", "ve", "ll")}

LETTER, NUMBER, OTHER, SPACE = range(4)
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, IN_SPACES, TWO_TO_COME, ONE_TO_COME = range(8)
# Symbols: the classes, an apostrophe with an ending of one or two letters, and space joined to what follows, within or at
# the end of a run of white space, or alone before other text.
S_ENDING1, S_ENDING2, S_JOINED, S_WITHIN, S_ALONE, SYMBOLS = 3, 4, 5, 6, 7, 8
_ROW = 64
_CACHE = 200_000
_SHORT = 64


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a token starts, by symbol (plus 8 at the start of a text) and state."""
    step = np.zeros((2 * SYMBOLS, 8), dtype=np.uint8)
    starts = np.ones((2 * SYMBOLS, 8), dtype=bool)
    for symbol, state in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS)):
        step[symbol] = state
        starts[symbol, [state, AFTER_SPACE]] = False
    step[LETTER, TWO_TO_COME], step[LETTER, ONE_TO_COME] = ONE_TO_COME, FRESH
    starts[LETTER, [TWO_TO_COME, ONE_TO_COME]] = False
    for symbol, state in ((S_ENDING1, ONE_TO_COME), (S_ENDING2, TWO_TO_COME)):
        step[symbol] = state
        step[symbol, [IN_OTHERS, AFTER_SPACE]] = IN_OTHERS
        starts[symbol, [IN_OTHERS, AFTER_SPACE]] = False
    step[S_JOINED], step[S_WITHIN], step[S_ALONE] = AFTER_SPACE, IN_SPACES, FRESH
    starts[S_WITHIN, IN_SPACES] = False
    step[SYMBOLS:] = step[:SYMBOLS, FRESH, None]
    return step, starts


STEP, STARTS = _automaton()


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], dtype=np.uint8)
    table[list(WHITE_SPACE)] = SPACE
    return table


def _symbols(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Symbol of every code point; ``first`` marks where texts start."""
    kind = classes()[codes]
    n = len(codes)
    follows = np.zeros(n, dtype=np.uint8)  # the class of the next character; white space at the end of a text
    follows[:-1] = kind[1:]
    follows[:-1][first[1:]] = SPACE
    follows[-1:] = SPACE
    out = kind.copy()
    space = kind == SPACE
    out[space] = np.where(follows[space] == SPACE, S_WITHIN, np.where(codes[space] == 0x20, S_JOINED, S_ALONE))
    quote = np.flatnonzero(codes == 0x27)
    if len(quote):
        padded = np.concatenate([codes, np.zeros(2, dtype=codes.dtype)])
        edge = np.concatenate([first, np.ones(2, dtype=bool)])
        near = ~edge[quote + 1]
        far = near & ~edge[quote + 2]
        for ending in ENDINGS[2]:
            out[quote[far & (padded[quote + 1] == ord(ending[0])) & (padded[quote + 2] == ord(ending[1]))]] = S_ENDING2
        for ending in ENDINGS[1]:
            out[quote[near & (padded[quote + 1] == ord(ending))]] = S_ENDING1
    return out + np.where(first, SYMBOLS, 0).astype(np.uint8)


def token_starts(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether a pre-token starts at each code point."""
    n = len(codes)
    rows = -(-n // _ROW)
    symbols = np.zeros(rows * _ROW, dtype=np.int64)
    symbols[:n] = _symbols(codes, first)
    base = np.ascontiguousarray(symbols.reshape(rows, _ROW).T) * 8
    step, starts = STEP.ravel(), STARTS.ravel()
    whole = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    for column in base:  # the function of each row
        whole = step[column[:, None] + whole]
    span = 1
    while span < rows:  # the function of all rows up to each, by doubling
        whole[span:] = np.take_along_axis(whole[span:], whole[:-span].astype(np.int64), axis=1)
        span *= 2
    state = np.concatenate([[FRESH], whole[:-1, FRESH]]).astype(np.uint8)
    found = np.empty((_ROW, rows), dtype=bool)
    for k, column in enumerate(base):
        at = column + state
        found[k] = starts[at]
        state = step[at]
    return found.T.ravel()[:n]


class Vocabulary:
    """Ranks of byte strings from a file of base64 tokens and ranks, and what is known of earlier pre-tokens."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        size = max(self.ranks.values()) + 1
        self.texts = [b""] * size
        for token, rank in self.ranks.items():
            self.texts[rank] = token
        self.lengths = np.array([len(t) for t in self.texts], dtype=np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.joined = np.frombuffer(b"".join(self.texts), dtype=np.uint8)
        self.known: dict[bytes, bytes] = {}  # lately met pre-tokens, at most _CACHE
        self.older: dict[bytes, bytes] = {}  # those before them

    def merged(self, piece: bytes) -> bytes:
        """Ids of a pre-token as little-endian 32-bit integers: the lowest rank is merged first, leftmost on ties."""
        ranks = self.ranks
        if piece in ranks:
            return ranks[piece].to_bytes(4, "little")
        n = len(piece)
        if n <= _SHORT:
            return self._merged_short(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ends = list(range(1, n + 1))  # part i is piece[i:ends[i]]; 0 marks a part merged away
        heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i] if ends[i] else n
            if j >= n or ends[j] - i != size:
                continue  # one of the two has changed since
            ends[i], ends[j] = ends[j], 0
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < n:
                    end = ends[after[left]]
                    if (r := ranks.get(piece[left:end])) is not None:
                        heapq.heappush(heap, (r, left, end - left))
        return b"".join(ranks[piece[i : ends[i]]].to_bytes(4, "little") for i in range(n) if ends[i])

    def _merged_short(self, piece: bytes) -> bytes:
        """The same for few bytes, where a plain search for the lowest rank is faster than a heap."""
        ranks, none = self.ranks, len(self.texts)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [ranks.get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while pairs and (low := min(pairs)) < none:
            i = pairs.index(low)
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        return b"".join([ranks[part].to_bytes(4, "little") for part in parts])

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        known = self.known
        out = list(map(known.get, pieces))
        for i, ids in enumerate(out):
            if ids is None:
                piece = pieces[i]
                ids = known.get(piece)
                if ids is None:
                    ids = self.older.get(piece) or self.merged(piece)
                    if len(known) >= _CACHE:
                        self.known, self.older = {}, known
                        known = self.known
                    if len(piece) <= 256:
                        known[piece] = ids
                out[i] = ids
        return out

    def decode(self, ids: bytes, offsets: bytes) -> bytes:
        """Bytes of the ids, each laid at its offset."""
        tokens = np.frombuffer(ids, dtype="<u4").astype(np.int64)
        places = np.frombuffer(offsets, dtype="<u4").astype(np.int64)
        size = self.lengths[tokens]
        source = np.arange(int(size.sum())) + np.repeat(self.begins[tokens] - (np.cumsum(size) - size), size)
        target = np.arange(len(source)) + np.repeat(places - (np.cumsum(size) - size), size)
        out = np.empty(len(source), dtype=np.uint8)
        out[target] = self.joined[source]
        return out.tobytes()


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _encode(path: str):
    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            for block in blocks(batch.column("text")):
                raw = block.data.tobytes()
                codes = np.frombuffer(raw.decode().encode("utf-32-le"), dtype=np.uint32)
                width = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
                at = np.cumsum(width) - width  # the first byte of each code point
                first = np.zeros(len(codes), dtype=bool)
                filled = block.ends > block.starts
                first[np.searchsorted(at, block.starts[filled])] = True
                cut = at[token_starts(codes, first)] if len(codes) else at
                encoded = vocab.encode([raw[s:e] for s, e in zip(cut.tolist(), [*cut[1:].tolist(), len(raw)])])
                low, high = np.searchsorted(cut, block.starts), np.searchsorted(cut, block.ends)
                ids = [b"".join(encoded[a:b]) for a, b in zip(low.tolist(), high.tolist())]
                sizes = [vocab.lengths[np.frombuffer(own, dtype="<u4")] for own in ids]
                offsets = [(np.cumsum(size) - size).astype("<u4").tobytes() for size in sizes]
                count = pa.array([len(x) // 4 for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(block.rows)), count, pa.array(ids, pa.binary()), pa.array(offsets, pa.binary())],
                    ["doc_id", "n_tokens", "ids", "offsets"],
                )

    return run


_DECODED_ROWS = 128


def _decode(path: str):
    def run(batches):
        vocab = vocabulary(path)
        for whole in batches:
            for at in range(0, whole.num_rows, _DECODED_ROWS):
                batch = whole.slice(at, _DECODED_ROWS)
                ids, offsets = batch.column("ids").to_pylist(), batch.column("offsets").to_pylist()
                texts = [vocab.decode(i, o) for i, o in zip(ids, offsets)]
                digests = pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("n_tokens"), digests, pa.array(texts, pa.binary())], ["doc_id", "n_tokens", "ids_sha256", "decoded"]
                )

    return run


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, offsets), one row per row of ``docs`` (doc_id, text; more is ignored).

    ``ids`` and ``offsets`` (the first byte of each token in the text) are little-endian unsigned 32-bit integers. Null and
    empty texts have none. Special tokens are ordinary text. ``path``: the rank file, readable on every executor.
    """
    return docs.select("doc_id", "text").mapInArrow(_encode(path), "doc_id bigint, n_tokens bigint, ids binary, offsets binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded): the bytes that ids and offsets stand for."""
    rows = encoded.select("doc_id", "n_tokens", "ids", "offsets")
    return rows.mapInArrow(_decode(path), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded binary")
