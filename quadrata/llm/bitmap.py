"""Set of hashes as a bit array of a fixed size: small enough to send anywhere, however many hashes it holds.

It may answer yes for a hash that is not in it, never no for one that is. Whoever asks must give right results either way;
a fuller array only saves less work.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 27  # 16 MB
ROW_BITS = 23  # for broadcast joins: at most 131,072 rows


def _place(h: Column, bits: int) -> Column:
    return F.shiftrightunsigned(h, 64 - bits)


def rows(df: DataFrame, h: Column, bits: int = ROW_BITS) -> DataFrame:
    """(word, bits) of the 64-bit hashes ``h``: at most 2**(bits - 6) rows, folded before the shuffle."""
    place = _place(h, bits)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(63).cast("int"))
    words = df.where(h.isNotNull()).select(F.shiftrightunsigned(place, 6).cast("int").alias("word"), bit.alias("bit"))
    return words.groupBy("word").agg(F.bit_or("bit").alias("bits"))


def build(df: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """The array on the driver, of 2**(bits - 3) bytes whatever ``df`` holds."""
    words = rows(df, F.col(column), bits).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def holds(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each hash whether it may be in the set."""
    bits = int(np.log2(len(bitmap))) + 6
    place = hashes.astype(np.uint64) >> np.uint64(64 - bits)
    return (bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to differ from all the columns."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def split(df: DataFrame, keys: list[str], members: DataFrame, bits: int = ROW_BITS) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` whose keys may be among those of ``members``, and rows whose keys surely are not.

    Only the first part needs a shuffle to be joined with ``members``. The broadcast side has 2**(bits - 6) rows at most.
    Columns of any other name stay as they are.
    """
    word, held = unused(df.columns, "word", "bits")
    h = F.xxhash64(*keys)
    place = _place(h, bits)
    small = F.broadcast(rows(members, h, bits).toDF(word, held))
    joined = df.join(small, F.shiftrightunsigned(place, 6).cast("int") == F.col(word), "left")
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(63).cast("int"))
    hit = F.coalesce(F.col(held).bitwiseAND(mask) != 0, F.lit(False))
    own = [F.col(f"`{c}`") for c in df.columns]
    return joined.where(hit).select(own), joined.where(~hit).select(own)
