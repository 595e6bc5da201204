"""Arrays of fixed size over all rows of a table, and small helpers around them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .words import mix

_BLOCK = 1 << 13
# Tasks whose blocks are merged at a time, so that no merge gets the blocks of all tasks.
_TASKS = 64

Fill = Callable[[np.ndarray, pa.RecordBatch], None]


def fixed_array(df: DataFrame, size: int, kind: str, fill: Fill, merge: Callable) -> np.ndarray:
    """One array of ``size`` numbers, filled by every task and merged element by element.

    What each task sends, and what comes to the driver, has that fixed size. Blocks are merged in three levels: of
    ``_TASKS`` tasks, of as many such groups, then of all, which leaves 200 blocks to a merge for 800,000 tasks.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.zeros(size, kind)
        for batch in batches:
            fill(whole, batch)
        blocks = [(i, whole[i : i + _BLOCK]) for i in range(0, size, _BLOCK) if whole[i : i + _BLOCK].any()]
        if blocks:
            yield _blocks(blocks, TaskContext.get().partitionId() // _TASKS)

    def merged(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x.as_py(), kind) for x in table.column("data")]
        block, tasks = (table.column(c)[0].as_py() for c in ("block", "tasks"))
        return pa.Table.from_batches([_blocks([(block, reduce(merge, parts))], tasks // _TASKS)])

    def _blocks(blocks, group: int) -> pa.RecordBatch:
        columns = [pa.array([b for b, _ in blocks]), pa.array([group] * len(blocks), pa.int64())]
        return pa.RecordBatch.from_arrays([*columns, pa.array([x.tobytes() for _, x in blocks], pa.binary())], ["block", "tasks", "data"])

    schema = "block bigint, tasks bigint, data binary"
    parts = df.mapInArrow(partial, schema)
    for _ in range(2):
        parts = parts.groupBy("block", "tasks").applyInArrow(merged, schema)
    out = np.zeros(size, kind)
    for row in parts.groupBy("block").applyInArrow(merged, schema).collect():
        part = np.frombuffer(row["data"], kind)
        out[row["block"] : row["block"] + len(part)] = part
    return out


def saturating_sum(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a + np.minimum(b, np.iinfo(a.dtype).max - a)


# --- a filter of hashes ----------------------------------------------------------------------------

_PLACES = 4
_LARGEST = 1 << 28


class HashFilter:
    """Tells of a 64-bit hash whether it may be in a set. ``bits`` is a power of two."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words

    @staticmethod
    def bits_for(count: int) -> int:
        """About 16 bits a hash, at most 32 MB in all; fuller filters let more through and miss none."""
        return min(_LARGEST, max(1 << 13, 1 << (16 * count).bit_length()))

    @staticmethod
    def _at(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        # Places from the halves of a hash that is scrambled once more.
        scrambled = mix(hashes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        step = (scrambled >> np.uint64(32)) | np.uint64(1)
        at = (scrambled[None, :] + step[None, :] * np.arange(_PLACES, dtype=np.uint64)[:, None]) & np.uint64(bits - 1)
        return (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))

    @classmethod
    def of(cls, df: DataFrame, count: int) -> HashFilter:
        """From a table of ``count`` rows whose only column holds hashes."""
        bits = cls.bits_for(count)

        def fill(whole: np.ndarray, batch: pa.RecordBatch) -> None:
            word, bit = cls._at(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits)
            np.bitwise_or.at(whole, word.ravel(), bit.ravel())

        return cls(fixed_array(df, bits // 64, "u8", fill, np.bitwise_or))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        word, bit = self._at(hashes, 64 * len(self.words))
        return ((self.words[word] & bit) != 0).all(axis=0)
