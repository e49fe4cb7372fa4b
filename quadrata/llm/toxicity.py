"""Toxicity: maximum-scoring segments of token log-odds, aggregated by extreme-value calibration.

A token scores the log-odds of the rates of texts that hold it under a Dirichlet prior; the prior of a word follows the rates of its first
bytes, so inflected forms of a known stem score too. The linear-time scan of Ruzzo and Tompa finds every maximal segment of
a document. Karlin-Altschul statistics of the non-toxic labelled documents turn segment scores into expected counts; their
sum over segments is mapped to a probability by a logistic curve.

Word and prefix counts live in hash tables of fixed sizes (WORD_BITS, PREFIX_BITS), which are all that is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrata.llm.blocks import U, Rolling, blocks, byte_symbols, mixed, with_tag, words
from quadrata.session import cut_lineage

WORD_BITS, PREFIX_BITS, PREFIX = 20, 18, 4
FIT_ROWS = 100_000
# Chosen by cross-validation over the four learning remainders of sf0.1; no held-out label took part.
PRIOR, PREFIX_PRIOR, LEAST = 4.0, 2.5, 4
DRIFT, LOWEST, HIGHEST = 1.5, -2.0, 6.0
_STEP = 0.25  # width of the bins of token scores
_BINS = int((HIGHEST - LOWEST) / _STEP) + 1
_CURVE_BINS = 400
_SEPARATOR = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


@dataclass(frozen=True)
class Model:
    """Log-odds of words; of their first bytes where a word is rare."""

    word: np.ndarray
    seen: np.ndarray
    prefix: np.ndarray


def _features(block) -> tuple[np.ndarray, np.ndarray, object]:
    """Buckets of all words of a block and of their first bytes."""
    w = words(block, _SEPARATOR)
    if not len(w.start):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), w
    rolling = Rolling(byte_symbols(block.data))
    size = w.end - w.start
    whole = mixed(rolling.raw(w.start, w.end) + size.astype(U))
    short = np.minimum(size, PREFIX)
    head = mixed(rolling.raw(w.start, w.start + short) + short.astype(U) + U(1 << 40))
    return (whole >> U(64 - WORD_BITS)).astype(np.int64), (head >> U(64 - PREFIX_BITS)).astype(np.int64), w


def _count(batches):
    tables = np.zeros((2, (1 << WORD_BITS) + (1 << PREFIX_BITS)), dtype=np.int64)
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
        for block in blocks(pc.utf8_lower(batch.column("text"))):
            word, prefix, w = _features(block)
            doc = np.repeat(np.arange(len(block.rows)), w.last - w.first)
            both = np.concatenate([word, prefix + (1 << WORD_BITS)])
            once = np.unique(np.concatenate([doc, doc]) * tables.shape[1] + both)  # repeats in a text count once
            label = toxic[block.rows][once // tables.shape[1]]
            for c in (0, 1):
                np.add.at(tables[c], once[label == c] % tables.shape[1], 1)
    used = np.flatnonzero(tables.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(tables[0, used]), pa.array(tables[1, used])], ["bucket", "n0", "n1"])


def learn(labelled: DataFrame) -> Model:
    """Token scores from (text, toxic). Without both classes every token scores zero."""
    counts = (
        labelled.select("text", "toxic")
        .mapInArrow(_count, "bucket int, n0 bigint, n1 bigint")
        .groupBy("bucket")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .toArrow()
    )
    table = np.zeros((2, (1 << WORD_BITS) + (1 << PREFIX_BITS)))
    for c in (0, 1):
        table[c, counts["bucket"].to_numpy()] = counts[f"n{c}"].to_numpy()
    word, prefix = table[:, : 1 << WORD_BITS], table[:, 1 << WORD_BITS :]
    total = word.sum(axis=1)
    if not total.all():
        zero = np.zeros(1 << WORD_BITS, dtype=np.float32)
        return Model(zero, zero > 1, zero[: 1 << PREFIX_BITS])
    share = total / total.sum()
    rates = (prefix + PREFIX_PRIOR * share[:, None]) / total[:, None]
    odds = np.log(rates[1] / rates[0])
    odds[prefix.sum(axis=0) < LEAST] = 0
    even = (word + PRIOR * share[:, None]) / total[:, None]
    return Model(np.log(even[1] / even[0]).astype(np.float32), word.sum(axis=0) >= LEAST, odds.astype(np.float32))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score) of a sequence, left to right, in linear time (Ruzzo, Tompa 1999)."""
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    up = scores > 0
    edge = np.diff(np.concatenate([[False], up, [False]]).astype(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    held: list[list] = []  # start, end, sum before, sum after, last earlier one with a smaller sum before
    for s, e, low, high in zip(begin.tolist(), end.tolist(), sums[begin].tolist(), sums[end].tolist()):
        j = len(held) - 1
        while True:
            while j >= 0 and held[j][2] >= low:
                j = held[j][4]
            if j < 0 or held[j][3] >= high:
                break
            s, low = held[j][0], held[j][2]
            del held[j:]
            j = len(held) - 1
        held.append([s, e, low, high, j])
    return [(s, e, high - low) for s, e, low, high, _ in held]


def _segments(model):
    def run(batches):
        m = model.value
        for batch in batches:
            sizes, found, bins = [], [], []
            for block in blocks(pc.utf8_lower(batch.column("text"))):
                word, prefix, w = _features(block)
                odds = np.where(m.seen[word], m.word[word], m.prefix[prefix])
                score = np.clip(odds, LOWEST, HIGHEST).astype(np.float64)
                place = ((score - LOWEST) / _STEP).astype(np.int64)
                score -= DRIFT
                for first, last in zip(w.first.tolist(), w.last.tolist()):
                    sizes.append(last - first)
                    own = maximal_segments(score[first:last])
                    found.append([{"start": s, "end": e, "score": x} for s, e, x in own])
                    bins.append(np.bincount(place[first:last], minlength=_BINS).astype(np.int32).tolist())
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tag"), pa.array(sizes, pa.int32()), pa.array(found, kind), pa.array(bins, pa.list_(pa.int32()))],
                ["doc_id", "tag", "n_words", "segments", "bins"],
            )

    return run


def segments(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, tag, n_words, segments, bins): every maximal segment in words, and how the word scores are spread; checkpointed."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    shape = "doc_id bigint, tag int, n_words int, segments array<struct<start: int, end: int, score: double>>, bins array<int>"
    scanned = cut_lineage(docs.select("doc_id", "text", "tag").mapInArrow(_segments(shared), shape))
    shared.destroy()
    return scanned


def gumbel(bins: np.ndarray) -> float:
    """Lambda of the background: the positive root of sum p(s) exp(lambda s) = 1."""
    if not bins.sum():
        return 1.0
    p = bins / bins.sum()
    s = LOWEST + _STEP * (np.arange(_BINS) + 0.5) - DRIFT
    if (p * s).sum() >= 0 or not p[s > 0].any():
        return 1.0
    low, high = 0.0, 1.0
    while (p * np.exp(high * s)).sum() < 1 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (p * np.exp(middle * s)).sum() < 1 else (low, middle)
    return max(high, 0.05)


def logistic(x: np.ndarray, n: np.ndarray, ones: np.ndarray) -> tuple[float, float]:
    """Intercept and slope for counts of labels by value, by Newton steps with a slight ridge."""
    beta = np.zeros(2)
    design = np.stack([np.ones_like(x), x], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (ones - n * p) - 1e-3 * beta
        curve = (design * (n * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        move = np.clip(np.linalg.solve(curve, slope), -5, 5)
        beta = beta + move
        if np.abs(move).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, tag, held_out, score, predicted, passages), one row per row of ``docs`` (doc_id, text; more is ignored).

    ``labels`` (doc_id, toxic): rows whose crc32(doc_id as text) mod 5 is 0 are held out, null labels are ignored, of several
    labels of a doc_id the largest counts. Token scores are fitted on at most ``fit_rows`` labelled rows, those with the smallest
    hashes; the background and the curve use all. Only texts are inputs of a score. Null and empty texts have no segment and get the
    lowest score of the curve; a null doc_id has no label. passages: the segments expected less than once in a hundred such
    documents, with their expected counts. Without labels of both classes every score is the share of label 1, or 0.
    """
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    docs = with_tag(docs)
    learned = cut_lineage(labels.where(~held_out & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    # A bound on the hash first, so that the limit merges little more than it keeps, however many labels there are.
    share = min(1.0, (1.1 * fit_rows + 1000) / max(learned.count(), 1))
    low = learned.where(F.xxhash64("doc_id") <= -(1 << 63) + min(int(share * (1 << 64)), (1 << 64) - 1))
    # Broadcast of at most fit_rows ids and labels, so that no text is shuffled to be counted.
    fitted = low.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    model = learn(docs.join(F.broadcast(fitted), "doc_id"))
    scanned = segments(docs, model)
    known = scanned.join(learned, "doc_id")
    background = known.where("toxic = 0")
    spread = background.select(F.posexplode("bins").alias("bin", "n")).groupBy("bin").agg(F.sum("n").alias("n")).collect()
    bins = np.zeros(_BINS)
    for row in spread:
        bins[row["bin"]] = row["n"]
    rate = gumbel(bins)
    level = 3.0 / rate  # K is set so that as many background segments reach this score as are expected to
    found = background.select(F.sum(F.size(F.filter("segments", lambda s: s["score"] >= level))), F.sum("n_words")).first()
    scale = max(float(found[0] or 0), 0.5) / max(float(found[1] or 0), 1.0) * float(np.exp(rate * level))
    log_expected = lambda s: F.lit(float(np.log(scale))) + F.log(F.col("n_words")) - rate * s["score"]
    # log(1 + 1 / expected), for any size of it
    rarity = lambda e: F.greatest(-e, F.lit(0.0)) + F.log1p(F.exp(-F.abs(e)))
    evidence = F.aggregate("segments", F.lit(0.0), lambda total, s: total + rarity(log_expected(s)))
    scored = scanned.withColumn("evidence", F.log1p(evidence))
    bin_of = F.least(F.floor(F.col("evidence") * 50), F.lit(_CURVE_BINS))
    points = scored.join(learned, "doc_id").groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"), F.sum("toxic").alias("ones")).collect()
    x, n, ones = (np.array([float(p[k]) for p in points]) for k in ("bin", "n", "ones"))
    start, slope = logistic((x + 0.5) / 50, n, ones) if len(points) else (-30.0, 0.0)
    score = 1 / (1 + F.exp(-(F.lit(start) + F.lit(slope) * F.col("evidence"))))
    passages = F.transform(
        F.filter("segments", lambda s: F.exp(log_expected(s)) < 0.01),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.exp(log_expected(s)).alias("expected")),
    )
    return scored.select(
        "doc_id", "tag", held_out.alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), passages.alias("passages")
    )
