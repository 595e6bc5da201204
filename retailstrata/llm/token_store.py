"""Token ids of documents in raw binary shards with a minimal perfect hash index.

A shard holds a range of keys in ascending order in two files. The payload is nothing but ids, little-endian,
two bytes each where the vocabulary allows it. The index maps a key to its slot by a minimal perfect hash:
levels of bit arrays, each twice as long as the keys left over; a key stays at the first level where it has a
place to itself, and its slot is the number of places taken before that one. A slot stores a fingerprint of
its key, which tells strangers, and the offset and number of ids. A lookup reads one place in few levels, one
slot and its ids, however large the shard.

Documents of equal keys are told apart by their occurrence number. A list of the shards, one row each, is
written last; shards of failed or duplicate task attempts are not on it.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tokens import encoder
from .words import mix, slices

MAGIC = b"TOKSTOR1"
_LEVELS = 40
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def key_hash(keys: np.ndarray, occurrence: np.ndarray, missing: np.ndarray) -> np.ndarray:
    """64-bit hash of key, occurrence number and whether the key is null (its number is then not used)."""
    value = np.where(missing, 0, keys).astype(np.int64).view(np.uint64)
    return mix(mix(value + _GOLDEN) + occurrence.astype(np.uint64) * np.uint64(2) + missing.astype(np.uint64) + _GOLDEN)


def _position(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(hashes + np.uint64((level + 1) * int(_GOLDEN) % (1 << 64))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Numbers 0 to n-1 for n distinct 64-bit hashes. ``rest`` are those that no level could place, as a rule none."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray) -> None:
        self.levels, self.rest = levels, rest
        self._before, taken = [], 0
        for bits in levels:
            count = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])
            self._before.append(taken + count)
            taken += int(count[-1])
        self._placed = taken

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        levels = []
        while len(hashes) and len(levels) < _LEVELS:
            words = -(-2 * len(hashes) // 64)
            at = _position(hashes, len(levels), 64 * words)
            alone = np.bincount(at, minlength=64 * words)[at] == 1
            bits = np.zeros(words, np.uint64)
            np.bitwise_or.at(bits, at[alone] >> 6, np.uint64(1) << (at[alone] & 63).astype(np.uint64))
            levels.append(bits)
            hashes = hashes[~alone]
        return cls(levels, np.sort(hashes))

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash; for a hash it was not built with, any number or -1."""
        out = np.full(len(hashes), -1, np.int64)
        left = np.arange(len(hashes))
        for level, bits in enumerate(self.levels):
            at = _position(hashes[left], level, 64 * len(bits))
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (bits[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(bits[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1)))
            out[left[hit]] = self._before[level][word[hit]] + below
            left = left[~hit]
        if len(self.rest) and len(left):
            i = np.minimum(np.searchsorted(self.rest, hashes[left]), len(self.rest) - 1)
            out[left] = np.where(self.rest[i] == hashes[left], self._placed + i, -1)
        return out


# --- one shard ------------------------------------------------------------------------------------


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def _occurrences(keys: np.ndarray, missing: np.ndarray) -> np.ndarray:
    """How many equal keys stand before each; keys are in order, nulls first."""
    n = len(keys)
    new = np.ones(n, bool)
    new[1:] = (missing[1:] != missing[:-1]) | (~missing[1:] & (keys[1:] != keys[:-1]))
    return np.arange(n) - np.maximum.accumulate(np.where(new, np.arange(n), 0))


def _index_bytes(keys: np.ndarray, missing: np.ndarray, lengths: np.ndarray, width: int) -> bytes:
    hashes = key_hash(keys, _occurrences(keys, missing), missing)
    table = PerfectHash.build(hashes)
    slot = table.number(hashes)
    offsets = np.cumsum(lengths) - lengths
    slots = np.zeros(len(keys), [("fingerprint", "<u4"), ("offset", "<u8"), ("n", "<u8")])
    slots["fingerprint"][slot] = (hashes >> np.uint64(32)).astype(np.uint32)
    slots["offset"][slot], slots["n"][slot] = offsets, lengths
    head = {"docs": len(keys), "width": width, "levels": [len(x) for x in table.levels], "rest": len(table.rest)}
    text = json.dumps(head).encode()
    parts = [MAGIC, len(text).to_bytes(4, "little"), text, *[x.astype("<u8").tobytes() for x in table.levels]]
    parts += [table.rest.astype("<u8").tobytes(), slots.tobytes(), keys.astype("<i8").tobytes(), missing.tobytes()]
    return b"".join(parts)


class Shard:
    """Keyed access to one shard."""

    def __init__(self, folder: str, name: str) -> None:
        self._files, root = _open(folder)
        with self._files.open_input_stream(f"{root}/{name}.idx") as f:
            data = io.BytesIO(f.read())
        if data.read(8) != MAGIC:
            raise ValueError(f"{name}.idx is no index of a token store")
        head = json.loads(data.read(int.from_bytes(data.read(4), "little")))

        def take(kind, n: int) -> np.ndarray:
            kind = np.dtype(kind)
            return np.frombuffer(data.read(kind.itemsize * n), kind)

        levels = [take("<u8", n) for n in head["levels"]]
        self._hash = PerfectHash(levels, take("<u8", head["rest"]))
        self._slots = take([("fingerprint", "<u4"), ("offset", "<u8"), ("n", "<u8")], head["docs"])
        self.keys, self.missing = take("<i8", head["docs"]), take(bool, head["docs"])
        self._width, self._payload = head["width"], f"{root}/{name}.ids"

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each key is there, the offset of its ids in the payload, and their number."""
        if not len(self._slots):
            zero = np.zeros(len(hashes), np.int64)
            return zero.astype(bool), zero, zero
        number = self._hash.number(hashes)
        slot = self._slots[np.maximum(number, 0)]
        there = (number >= 0) & (slot["fingerprint"] == (hashes >> np.uint64(32)).astype(np.uint32))
        return there, slot["offset"].astype(np.int64), slot["n"].astype(np.int64)

    def ids(self, offsets: np.ndarray, counts: np.ndarray) -> Iterator[np.ndarray]:
        """The ids of each place as unsigned 32-bit integers. Places that follow each other are read at once."""
        ends = offsets + counts
        apart = np.flatnonzero(offsets[1:] != ends[:-1]) + 1
        with self._files.open_input_file(self._payload) as f:
            for some in np.split(np.arange(len(offsets)), apart) if len(offsets) else []:
                lo, hi = int(offsets[some[0]]), int(ends[some[-1]])
                raw = f.read_at((hi - lo) * self._width, lo * self._width)
                run = np.frombuffer(raw, f"<u{self._width}").astype("<u4")
                yield from np.split(run, ends[some[:-1]] - lo)

    def get(self, key: int | None, occurrence: int = 0) -> np.ndarray | None:
        """The ids of a document, or None if the shard has no such key."""
        one = key_hash(np.array([key or 0]), np.array([occurrence]), np.array([key is None]))
        there, offset, n = self.places(one)
        return next(self.ids(offset, n)) if there[0] else None


# --- the store ------------------------------------------------------------------------------------

_LIST = "shard int, name string, docs bigint, tokens bigint, nulls bigint, first_key bigint, last_key bigint"


def write_store(df: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text") -> None:
    """Write every row's ids, an end id after each document, in ascending order of the key.

    ``folder`` is a URI of a file system that driver and executors share. Keys are whole numbers; rows with a
    null key come first, rows with equal keys are ordered by their text. A null text is an empty one. Range
    partitioning by key and text hash makes the shards, so a key that many rows share is spread over several.
    """

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _open(folder)
        number = TaskContext.get().partitionId()
        name = f"shard-{number:07d}-{uuid4().hex[:12]}"
        encode = encoder(tokenizer)
        width = 2 if encode.size <= 1 << 16 else 4
        keys, missing, lengths = [], [], []
        files.create_dir(root, recursive=True)
        with files.open_output_stream(f"{root}/{name}.ids") as out:
            for batch in batches:
                column, texts = batch.column(0), batch.column(1)
                keys.append(column.fill_null(0).to_numpy(zero_copy_only=False))
                missing.append(column.is_null().to_numpy(zero_copy_only=False))
                for part in slices(texts):
                    ids, bounds = encode.flat(part, end=True)
                    lengths.append(np.diff(bounds))
                    out.write(ids.astype(f"<u{width}").tobytes())
        if keys:
            counts = np.concatenate([np.zeros(0, np.int64), *lengths])
            with files.open_output_stream(f"{root}/{name}.idx") as out:
                out.write(_index_bytes(np.concatenate(keys), np.concatenate(missing), counts, width))
            known = np.concatenate(keys)[~np.concatenate(missing)]
            row = {"shard": number, "name": name, "docs": len(counts), "tokens": int(counts.sum()), "nulls": len(counts) - len(known)}
            row |= {"first_key": int(known[0]), "last_key": int(known[-1])} if len(known) else {"first_key": None, "last_key": None}
            kinds = [("shard", pa.int32()), ("name", pa.string())]
            kinds += [(c, pa.int64()) for c in ("docs", "tokens", "nulls", "first_key", "last_key")]
            yield pa.RecordBatch.from_pylist([row], pa.schema(kinds))

    rows = df.select(F.col(f"`{key}`").cast("bigint").alias("key"), F.col(f"`{text}`").alias("text"))
    order = ["key", F.xxhash64("text"), F.length("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    shards = sorted(ordered.mapInArrow(shard, _LIST).collect(), key=lambda r: r["shard"])  # one row for each shard
    files, root = _open(folder)
    files.create_dir(root, recursive=True)
    with files.open_output_stream(f"{root}/shards.json") as out:
        out.write(json.dumps([r.asDict() for r in shards]).encode())


def shard_list(folder: str) -> list[dict]:
    """The shards in key order with the number of ids in all shards before each."""
    files, root = _open(folder)
    with files.open_input_stream(f"{root}/shards.json") as f:
        shards = json.loads(f.read())
    start = 0
    for s in shards:
        s["start"] = start
        start += s["tokens"]
    return shards


def lookup(folder: str, key: int | None) -> list[np.ndarray]:
    """The ids of every document with that key. Only shards whose range of keys holds it are opened."""
    found = []
    for s in shard_list(folder):
        there = s["nulls"] > 0 if key is None else s["first_key"] is not None and s["first_key"] <= key <= s["last_key"]
        if there:
            shard, i = Shard(folder, s["name"]), 0
            while (ids := shard.get(key, i)) is not None:
                found.append(ids)
                i += 1
    return found


def read_store(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of the store, found through the index of its shard.

    Columns: ``key``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids`` (little-endian unsigned
    32-bit integers). Order of rows is not kept.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(folder, row["name"])
                hashes = key_hash(shard.keys, _occurrences(shard.keys, shard.missing), shard.missing)
                there, offsets, counts = shard.places(hashes)
                if not there.all():
                    raise ValueError(f"{row['name']}: keys without ids")
                for i in range(0, len(hashes), 500):
                    part = slice(i, i + 500)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(shard.keys[part], mask=shard.missing[part]),
                            pa.array(row["start"] + offsets[part]),
                            pa.array(counts[part]),
                            pa.array([ids.tobytes() for ids in shard.ids(offsets[part], counts[part])], pa.binary()),
                        ],
                        ["key", "start", "n_tokens", "ids"],
                    )

    shards = shard_list(folder)
    rows = spark.createDataFrame([(s["name"], s["start"]) for s in shards], "name string, start bigint")
    return rows.repartition(max(1, len(shards))).mapInArrow(read, "key bigint, start bigint, n_tokens bigint, ids binary")

