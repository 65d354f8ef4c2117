"""A bit map of 64-bit keys of bounded size, to leave out early what cannot have a partner.

It only ever lets too much through. When it fills up, more rows pass and are sorted out by the exact joins that follow, so
results do not depend on its size. It is built by Spark (one row per word of 64 bits) and has at most 2^MOST_BITS bits (32 MB).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import brief_shuffles

MOST_BITS = 28
LEAST_BITS = 20
BITS_PER_KEY = 24
_SHIFTS = (0, 12, 24, 36)


def build(keys: DataFrame, key: str, number: int) -> Broadcast:
    """The map of a column of uniformly spread 64-bit keys; number: about how many."""
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(number, 1) * BITS_PER_KEY))))
    places = F.array(*[F.shiftrightunsigned(F.col(key), s).bitwiseAND(F.lit((1 << bits) - 1)) for s in _SHIFTS])
    words = keys.select(F.explode(places).alias("p")).groupBy(F.shiftright("p", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))).alias("bits"))
    with brief_shuffles(keys.sparkSession):
        found = words.toArrow()
    out = np.zeros((1 << bits) >> 6, np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast((bits, out))


def test(map_: tuple[int, np.ndarray], keys: np.ndarray) -> np.ndarray:
    bits, words = map_
    left = np.arange(len(keys))
    for s in _SHIFTS:
        place = (keys[left] >> np.uint64(s)) & np.uint64((1 << bits) - 1)
        left = left[(words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1]
    out = np.zeros(len(keys), bool)
    out[left] = True
    return out
