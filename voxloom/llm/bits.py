"""Sets of 64-bit hashes as bits: bounded in size, never missing a member."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits for each member, as long as the set has fewer than ``MOST`` bits.
ROOM = 32
#: Exponents of the least and the greatest number of bits: 4 KB and 64 MB.
LEAST, MOST = 15, 29

_PAGE = 1 << 15


class Bits:
    """Says of every member that it is one, and of few others; the fuller, the more."""

    def __init__(self, log2: int):
        self.log2 = log2
        self.bytes = np.zeros(1 << (log2 - 3), np.uint8)

    def put(self, page: int, bits: bytes) -> None:
        at = page * (_PAGE // 8)
        own = np.frombuffer(bits, np.uint8)[: len(self.bytes) - at]
        self.bytes[at : at + len(own)] |= own

    def has(self, codes: np.ndarray) -> np.ndarray:
        place = codes >> np.uint64(64 - self.log2)
        return (self.bytes[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bits_of(hashes: DataFrame, column: str, most: int = MOST) -> Bits:
    """The set of a column of hashes, which must be well mixed.  The bits are set by an aggregate,
    and at most ``2 ** (most - 3)`` bytes of pages reach the driver, however many members there are.
    """
    log2 = min(max((ROOM * hashes.count()).bit_length(), LEAST), most)
    place = hashes.select(F.shiftrightunsigned(F.col(column), 64 - log2).alias("place"))
    pages = place.groupBy(F.shiftright("place", 15).alias("page")).agg(F.bitmap_construct_agg(F.col("place").bitwiseAND(_PAGE - 1)).alias("bits"))
    found = Bits(log2)
    for r in pages.toLocalIterator():
        found.put(r.page, bytes(r.bits))
    return found
