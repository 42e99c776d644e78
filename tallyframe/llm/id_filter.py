"""A Bloom filter over ids, of bounded size, to pick rows without shuffling them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyframe.llm import arrays as A
from tallyframe.llm import mail as M

LEAST_BITS, MOST_BITS, SALTS, SLICES = 16, 30, (31, 32, 33), 64


class IdFilter:
    """Never misses an id that was added; may pass others (more of them beyond ``MOST_BITS``)."""

    def __init__(self, ids: DataFrame, count: int):
        """``ids``: one column of longs; ``count``: how many, roughly."""
        bits = self.bits = min(MOST_BITS, max(LEAST_BITS, (16 * count).bit_length()))
        width = bits - (SLICES.bit_length() - 1)

        def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                cell = np.concatenate([self.cells(b.column(0).to_numpy(), s) for s in SALTS])
                part = (cell >> A.U64(width)).astype(np.int64)
                yield from M.deal(part, SLICES, 0, (cell & A.U64((1 << width) - 1)).astype(np.uint32)).to_batches()

        def merge(key: int, table: pa.Table) -> pa.Table:
            seen = np.zeros(1 << width, bool)
            for _, (low,) in M.received(table):
                seen[low] = True
            return M.messages([(key, 0, M.pack(np.packbits(seen)))])

        self.map = np.zeros((1 << bits) // 8, np.uint8)
        for r in M.answer(ids.mapInArrow(positions, M.MESSAGES), merge).collect():  # 2**bits / 8 bytes at most
            size = (1 << width) // 8
            self.map[r["__tf_to"] * size : (r["__tf_to"] + 1) * size] = M.unpack(r["__tf_payload"])[0]

    def cells(self, ids: np.ndarray, salt: int) -> np.ndarray:
        return A.mix(ids.astype(np.int64).view(A.U64), salt) >> A.U64(64 - self.bits)

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        out = np.ones(len(ids), bool)
        for s in SALTS:
            c = self.cells(ids, s)
            out &= (self.map[(c >> A.U64(3)).astype(np.int64)] >> (7 - (c & A.U64(7))).astype(np.uint8)) & 1 == 1
        return out
