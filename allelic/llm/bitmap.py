"""Bitmaps of sets of 64-bit hashes, made by Spark's bitmap aggregate.

A bitmap says "perhaps" of any hash of its set and nearly always "no" of
others.  It is used where a wrong "perhaps" costs work and changes no result.
Its size is fixed by the number of hashes up to 2**28 bits (32 MB), so what is
collected and broadcast is bounded; beyond, it says "perhaps" more often.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST_BITS, MOST_BITS = 15, 28


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit numbers that spreads them."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def bits_for(n: int) -> int:
    """Bits of a bitmap of ``n`` hashes, a power of two."""
    return 1 << min(MOST_BITS, max(LEAST_BITS, (32 * n).bit_length()))


def places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each hash."""
    mask = np.uint64(bits - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(32)) & mask).astype(np.int64)


def place_rows(rows: DataFrame, col: str, bits: int) -> DataFrame:
    """A row ``bit`` for each place of the hashes (long) in ``col``."""
    low = F.col(col).bitwiseAND(F.lit(bits - 1))
    high = F.shiftrightunsigned(F.col(col), 32).bitwiseAND(F.lit(bits - 1))
    return rows.select(F.explode(F.array(low.cast("long"), high.cast("long"))).alias("bit"))


def collect(rows: DataFrame, bits: int) -> np.ndarray:
    """The bitmap of the places in the column ``bit``, as bytes."""
    out = np.zeros(bits // 8, np.uint8)
    nth = F.col("bit") + 1  # Spark numbers bits from 1
    # dealt by bucket first: else each task sends a part of the bitmap for each bucket
    rows = rows.select(F.bitmap_bucket_number(nth).alias("bucket"), F.bitmap_bit_position(nth).alias("at")).repartition("bucket")
    parts = rows.groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("part"))
    for r in parts.collect():  # bits / 8 bytes
        part = np.frombuffer(r.part, np.uint8)
        at = (r.bucket - 1) * len(part)
        out[at:at + len(part)] = part[:len(out) - at]
    return out


def hits(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether each hash is perhaps in the set."""
    a, b = places(h, 8 * len(bitmap))
    at = lambda x: bitmap[x >> 3] >> (x & 7).astype(np.uint8)
    return (at(a) & at(b) & 1).astype(bool)
