"""Best-fit packing of token ids into sequences of a fixed length.

Documents stream through each task and go online to the open sequence with the least free space that still
takes them. Open sequences are bounded in number and filed by free space in a bitset, so the best fit is
one shift and one lowest set bit; when a further one is needed, the fullest closes first. A piece knows its
sequence and place as soon as it is placed: tasks keep no ids, need no shuffle, and memory does not grow.

Each task packs what it reads, so sequences never span tasks: at most ``open_bins`` per task stay less full
than they could be.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import encoder
from .words import slices

SEQUENCE = 2048
# Sequences of one task are numbered from its partition number times this.
PER_TASK = 1 << 40


@dataclass
class OpenBins:
    """``place`` gives each length a bin and an offset in it."""

    capacity: int
    limit: int
    opened: int = 0
    count: int = 0
    mask: int = 0
    by_free: dict[int, list[int]] = field(default_factory=dict)

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.mask ^= 1 << free
        self.count -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.mask >> length
        if fitting:
            free = (fitting & -fitting).bit_length() - 1 + length
            number = self._take(free)
        else:
            if self.count == self.limit:
                self._take((self.mask & -self.mask).bit_length() - 1)
            free, number = self.capacity, self.opened
            self.opened += 1
        rest = free - length
        if rest:
            self.by_free.setdefault(rest, []).append(number)
            self.mask |= 1 << rest
            self.count += 1
        return number, self.capacity - free


@dataclass(frozen=True)
class Packing:
    """``look_ahead``: so many last pieces wait and are placed longest first."""

    tokenizer: str
    sequence: int = SEQUENCE
    open_bins: int = 8192
    look_ahead: int = 1000


def cut(n: int, most: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document of ``n`` ids; only the first may be shorter than ``most``."""
    first = n if n <= most else n % most or most
    return [(0, first)] + [(start, most) for start in range(first, n, most)]


def _rows(keys: pa.Array, texts: pa.Array, packing: Packing, row: int) -> Iterator[list]:
    """Key, piece, start, length, ids and row number of every piece of a batch whose first row has number ``row``."""
    done = 0
    for part in slices(texts):
        ids, bounds = encoder(packing.tokenizer).flat(part, end=True)
        edge = bounds.tolist()
        for key, lo, hi in zip(keys[done : done + len(part)].to_pylist(), edge, edge[1:]):
            for piece, (start, length) in enumerate(cut(hi - lo, packing.sequence)):
                yield [key, piece, start, length, ids[lo + start : lo + start + length].tobytes(), row]
            row += 1
        done += len(part)


def pack(df: DataFrame, packing: Packing, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every piece of every document with its place in a sequence.

    Columns: the key, ``piece``, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit), ``sequence_id``,
    ``offset`` and ``row``, a number of the input row, by which the pieces of rows with equal keys are told apart.
    A null text is an empty one, whose only id is the end id. Rows with null or repeated keys are packed like any
    other; no further column of the input is used.
    """
    kind = df.schema[key].dataType.simpleString()
    schema = (
        f"`{key}` {kind}, piece int, start bigint, length bigint, ids binary, "
        "sequence_id bigint, offset bigint, row bigint"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(packing.sequence, packing.open_bins)
        base = row = TaskContext.get().partitionId() * PER_TASK
        waiting: list[list] = []
        kinds = None

        def placed(rows: list[list]) -> Iterator[pa.RecordBatch]:
            columns = [*zip(*[
                (k, piece, start, n, ids, base + number, offset, of)
                for k, piece, start, n, ids, of in sorted(rows, key=lambda r: -r[3])
                for number, offset in [bins.place(n)]
            ])]
            if columns:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

        names = [key, "piece", "start", "length", "ids", "sequence_id", "offset", "row"]
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            kinds = [keys.type, pa.int32(), *[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 3]
            whole: list[list] = []
            for piece in _rows(keys, texts, packing, row):
                (waiting if piece[3] < packing.sequence else whole).append(piece)
                if len(waiting) >= packing.look_ahead or len(whole) >= packing.look_ahead:
                    yield from placed(whole + waiting)
                    waiting, whole = [], []
            row += batch.num_rows
            yield from placed(whole)
        yield from placed(waiting)

    return df.select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInArrow(run, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """The ids of each sequence on end, from the result of ``pack``; a sequence has a bounded number of ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    joined = F.aggregate("parts", F.lit(b""), lambda ids, p: F.concat(ids, p["ids"]))
    return pieces.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.aggregate("parts", F.lit(0).cast("bigint"), lambda n, p: n + p["length"]).alias("length"), joined.alias("ids")
    )
