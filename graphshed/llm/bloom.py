"""Bloom filters sized by what they hold, up to a bound, built by summed aggregations and tested in numpy.

They only ever save work: a row that passes is checked exactly afterwards.
What is too much for the bound gets no filter, and callers join instead.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27
#: Bits for each value, unless that is over the bound; below FEWEST a filter lets too much through.
WANTED, FEWEST = 16, 6
PROBES = 3


def bits_for(values: int, most_bits: int = MOST_BITS) -> int | None:
    """Bits of a filter of so many values; None if the bound is too low for them."""
    if values * FEWEST > most_bits:
        return None
    return min(most_bits, max(LEAST_BITS, 1 << (WANTED * values - 1).bit_length() if values else 0))


def _probe(value: Column, i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(value, F.lit(1000 + i)), F.lit(bits))


def build(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """The filter of a column's values, null as a value of its own: bits / 64 words at most reach the driver."""
    bit = F.explode(F.array(*(_probe(F.col(column), i, bits) for i in range(PROBES)))).alias("bit")
    words = df.select(bit).groupBy(F.shiftright("bit", 6).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(bit % 64))")).alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out.view(np.uint64)


def probes(column: str, bits: int) -> Column:
    """The bits of a row's value, for ``passing``."""
    return F.array(*(_probe(F.col(column), i, bits) for i in range(PROBES)))


def passing(words: np.ndarray, probed: pa.Array) -> np.ndarray:
    """Whether all bits of each row are set."""
    at = probed.flatten().to_numpy().reshape(-1, PROBES)
    return ((words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).all(axis=1)
