"""A bounded set of hashes that tasks can look up: one bit for each residue.

It never misses a member; it may take another value for one. Whoever uses it
only drops what can't matter, so a false member costs work, not results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each member, so that about one value in BITS_EACH is a false member.
BITS_EACH = 32
#: Largest bitmap: 64 MB to each worker. With more members than it holds at BITS_EACH, more values are false members.
MAX_BITS = 1 << 29
MIN_BITS = 1 << 16


class Bitmap:
    def __init__(self, members: DataFrame, value: Column, bits_each: int = BITS_EACH):
        """``value``: a column of hashes (longs), of which the low bits are kept."""
        spark = members.sparkSession
        wanted = max(MIN_BITS, min(MAX_BITS, members.count() * bits_each))
        self.size = 1 << (wanted - 1).bit_length()
        at = F.pmod(value, F.lit(self.size)) + 1  # the built-in functions count from 1
        chunks = (
            members.select(at.alias("at"))
            .groupBy(F.bitmap_bucket_number("at").alias("chunk"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
        )
        bits = np.zeros(self.size // 8, np.uint8)
        for row in chunks.toLocalIterator():
            part = np.frombuffer(row.bits, np.uint8)
            begin = (row.chunk - 1) * 4096
            bits[begin : begin + len(part)] = part[: len(bits) - begin]
        self._bits = spark.sparkContext.broadcast(bits)

    def __contains__(self, value: int) -> bool:
        return bool(self.has(np.array([value & (1 << 64) - 1], np.uint64))[0])

    def has(self, values: np.ndarray) -> np.ndarray:
        """For each of some hashes (uint64), whether it may be a member."""
        at = values & np.uint64(self.size - 1)
        return (self._bits.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def column(self, value: Column) -> Column:
        """Whether each of a column of hashes may be a member."""

        def look_up(values: pa.Array) -> pa.Array:
            return pa.array(self.has(values.to_numpy(zero_copy_only=False).view(np.uint64)))

        return F.arrow_udf(look_up, "boolean")(value)
