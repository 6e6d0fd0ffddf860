"""Sets of hashes as bitmaps of bounded size, for tasks to look at before rows travel."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bits of a bitmap: 16 a number, within these bounds (128 KB and 32 MB).
LEAST_BITS, MOST_BITS = 20, 28


class Living:
    """Numbers in a bitmap by their lowest bits: it may say yes too often but never no."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(8 * len(bits) - 1)

    @classmethod
    def of(cls, shared) -> Living:
        """From a broadcast bitmap."""
        return cls(np.frombuffer(shared.value, np.uint8))

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & self.mask
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap_bits(count: int) -> int:
    """The bitmap's size for so many numbers, as a power of two."""
    return min(max(LEAST_BITS, (16 * count).bit_length()), MOST_BITS)


def bitmap(numbers: DataFrame, bits: int) -> bytes:
    """A column of 64-bit numbers as the bits of `Living`, 2**bits of them; built on executors, in pages."""
    at = numbers.select((F.col(numbers.columns[0]).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))).alias("at"))
    pages = at.groupBy(F.shiftright("at", 15).alias("page")).agg(F.expr("bitmap_construct_agg(at & 32767)").alias("bits"))
    made = np.zeros(1 << (bits - 3), np.uint8)
    for row in pages.collect():  # at most 2**(MOST_BITS - 15) pages of 4 KB
        made[row["page"] << 12 : (row["page"] + 1) << 12] = np.frombuffer(row["bits"], np.uint8)
    return made.tobytes()
