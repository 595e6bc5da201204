"""Rows packed by column while they are moved.

Where all rows of a table are brought together by a few values, a shuffle writes each row by itself. Here each task first packs its
rows of one value into Parquet bytes, and those are shuffled: about a third of the bytes for rows with many texts that repeat.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.rows import quoted

# So many bytes of rows a task holds before it packs them.
HELD = 64 << 20
# Types that are the same after Arrow and Parquet.
_TYPES = (T.IntegralType, T.FloatType, T.DoubleType, T.DecimalType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
_ROWS = "__rows"


def can_pack(df: DataFrame) -> bool:
    return all(isinstance(f.dataType, _TYPES) for f in df.schema.fields)


def _parts(held: Sequence[pa.RecordBatch], places: Sequence[int], names: Sequence[str]) -> pa.RecordBatch:
    """Rows with equal values in some columns packed together, with these values."""
    table = pa.Table.from_batches(held)
    code = np.zeros(table.num_rows, np.int64)
    for i in places:
        values = pc.dictionary_encode(table.column(i).combine_chunks(), null_encoding="encode").indices.to_numpy().astype(np.int64)
        code = np.unique(code * (values.max() + 1) + values, return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    table, starts = table.take(pa.array(order)), np.flatnonzero(np.diff(code[order], prepend=-1))
    packed = []
    for start, end in zip(starts, [*starts[1:], len(order)]):
        sink = pa.BufferOutputStream()
        pq.write_table(table.slice(start, end - start), sink, compression="zstd", write_statistics=False)
        packed.append(sink.getvalue().to_pybytes())
    values = [table.column(i).take(pa.array(starts)).combine_chunks() for i in places]
    return pa.RecordBatch.from_arrays([*values, pa.array(packed, pa.binary())], names=[*names, _ROWS])


def gathered_packed(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of equal values brought together as ``gathered`` does, and not sorted."""
    schema = df.schema
    places = [schema.names.index(c) for c in by]
    names = [f"__by{i}" for i in range(len(by))]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
            if size >= HELD:
                yield _parts(held, places, names)
                held, size = [], 0
        if held:
            yield _parts(held, places, names)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in batch.column(batch.num_columns - 1):
                yield from pq.read_table(pa.BufferReader(rows.as_buffer())).to_batches(max_chunksize=10_000)

    fields = [T.StructField(n, schema.fields[i].dataType) for n, i in zip(names, places)]
    packed = df.mapInArrow(pack, T.StructType([*fields, T.StructField(_ROWS, T.BinaryType())]))
    return packed.hint("rebalance", *names).mapInArrow(unpack, schema)
