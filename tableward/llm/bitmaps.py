"""Sets of hashes as bitmaps of bounded size: what is in the set is found, and some of what is not."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits for each hash; the least and the largest power of two of bits in all; and that of one part.
SPARSE, FEWEST, MOST, PART = 32, 16, 27, 15


class Bitmap:
    """Hashes that may be there; all others are not."""

    def __init__(self, bits: int, parts: dict[int, bytes]):
        self.bits, self.raw = bits, np.zeros((1 << bits) // 8, np.uint8)
        width = 1 << (PART - 3)
        for at, part in parts.items():
            self.raw[at * width : (at + 1) * width] = np.frombuffer(part, np.uint8)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - self.bits)
        return (self.raw[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def collect(hashes: DataFrame, count: int) -> Bitmap:
    """The bitmap of ``count`` hashes, the only column of a frame, well spread longs.

    Its size follows their number up to 2^MOST bits, 16 MB, whatever comes; each part is
    put together by a task.  With very many hashes it holds nearly everything, so it may
    only ever spare work that an exact step after it would do too.
    """
    bits = min(max((count * SPARSE).bit_length(), FEWEST), MOST)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(64 - bits)
            part, bit = at >> np.uint64(PART), at & np.uint64((1 << PART) - 1)
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(bit.astype(np.int32))], names=["part", "bit"])

    def packed(table: pa.Table) -> pa.Table:
        flags = np.zeros(1 << PART, np.uint8)
        flags[table.column("bit").to_numpy()] = 1
        return pa.table({"part": table.column("part")[:1], "bits": pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())})

    parts = hashes.mapInArrow(placed, "part int, bit int").distinct().groupBy(F.col("part")).applyInArrow(packed, "part int, bits binary")
    return Bitmap(bits, {r.part: bytes(r.bits) for r in parts.collect()})
