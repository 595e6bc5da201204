"""Groups of documents whose sets of word n-grams are similar by Jaccard, found exactly.

Two sets are linked when ``share_above * intersection >= share_below * union``. The steps:

1. *Rarity.* Occurrences of all n-grams are counted in a fixed number of counters by hash, summed over all
   tasks. The counts only order n-grams, so shared counters cost time, never a link.
2. *Sets.* Each document becomes its set of distinct n-grams, rarest first, and the set's fingerprint; equal sets
   are one set from here on.
3. *Prefixes.* Two linked sets share one of their rarest n-grams, within a prefix whose length follows from the
   set's size. Prefix n-grams are shuffled once and those that only one set has are gone.
4. *Leaders.* In each prefix n-gram's group every set is paired with the smallest one. Pairs that pass the
   length, positional and suffix filters are verified, and the links joined into components. This is repeated a
   few times with leaders drawn at random and only for sets of other components than theirs.
5. *Rest.* Pairs of sets that share a prefix n-gram but lie in different components are the only ones that could
   still add anything. They pass the same filters, in large groups also a comparison of parities, and are verified
   too; links are joined again.

A group of copies thus needs one pair for each member, not all pairs, and still no link between different
components is missed. The suffix filter bounds the overlap by the numbers of n-grams in fixed hash ranges.
Verification intersects whole sets, once for each pair. Steps hand over through tables in the shared folder.

N-grams, and fingerprints of sets, are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fnmatch import fnmatch
from functools import reduce
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rows import dedup
from ..sources.scratch import remove, shared_folder
from .arrays import fixed_array, saturating_sum
from .session import bounded_batches
from .words import Words, mix, ngrams, slices, words_of

# Counters of step 1 and bits of the filter of needed documents: fixed sizes, 2 MB each, whatever the input.
COUNTERS = 1 << 19
FILTER_BITS = 1 << 24
# Hash ranges of the suffix filter, and 64-bit words of the parities that tell sets of large groups apart.
RANGES = 128
PARITIES = 16
# From so many members on, a group's sets are compared by parities before pairs are made of them.
LARGE_GROUP = 8
# Sets a task remembers so as not to send a repeated one again.
REMEMBERED = 200_000
# A prefix n-gram with a count above this many times the mean is dealt to several tasks.
SPREAD_ABOVE = 16
# Rounds with drawn leaders; what they leave is settled in full after them.
LEADER_ROUNDS = 2
LEADERS = 8
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Similarity:
    n: int = 5
    share_above: int = 100
    share_below: int = 75

    def prefix(self, size: np.ndarray) -> np.ndarray:
        """So many of the rarest n-grams of a set hold one of every set linked with it."""
        return size - -((-self.share_below * size) // self.share_above) + 1


# --- sets of a batch ------------------------------------------------------------------------------


def _shingles(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every n-gram; a text of fewer words is one n-gram of all its words."""
    at, value = ngrams(w, n)
    row = w.row[at]
    words = w.per_row()
    short = np.flatnonzero((words > 0) & (words < n))
    if len(short):
        first = np.searchsorted(w.row, short)
        whole = np.zeros(len(short), np.uint64)
        for k in range(n - 1):
            inside = words[short] > k
            whole[inside] = mix(whole[inside] * _ODD + w.hash[first[inside] + k])
        row = np.concatenate([row, short])
        # The number of words keeps these apart from n-grams and from each other.
        value = np.concatenate([value, mix(whole + words[short].astype(np.uint64))])
    return row, value


def _sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and hash of every distinct n-gram, in order of both, and the size of each row's set."""
    w = words_of(texts, lower=True)
    row, value = _shingles(w, n)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    row, value = row[new], value[new]
    return row, value, np.bincount(row, minlength=w.rows)


def _fingerprints(row: np.ndarray, value: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of each set as a signed integer."""
    total = np.zeros(len(value) + 1, np.uint64)
    np.cumsum(mix(value ^ _ODD), dtype=np.uint64, out=total[1:])
    edge = np.concatenate([[0], np.cumsum(size)])
    return mix((total[edge[1:]] - total[edge[:-1]]) + size.astype(np.uint64) * _ODD).view(np.int64)


def _ranges(row: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    """How many n-grams of each set lie in each hash range; the largest number stands for any larger one as well."""
    at = row * RANGES + (value >> np.uint64(64 - RANGES.bit_length() + 1)).astype(np.int64)
    return np.minimum(np.bincount(at, minlength=RANGES * rows), 65535).astype("<u2").reshape(-1, RANGES)


def _parity(row: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    """For each hash remainder whether an odd number of n-grams has it, as bits of signed integers.

    Two sets differ in at least as many n-grams as in bits.
    """
    bits = np.bincount(row * (64 * PARITIES) + (value % np.uint64(64 * PARITIES)).astype(np.int64), minlength=64 * PARITIES * rows) & 1
    return np.packbits(bits.astype(np.uint8).reshape(-1, 8), axis=1, bitorder="little").ravel().view(np.int64)


# --- arrays of fixed size over all rows -----------------------------------------------------------


def _count(n: int) -> Callable[[np.ndarray, pa.RecordBatch], None]:
    def fill(whole: np.ndarray, batch: pa.RecordBatch) -> None:
        for part in slices(batch.column(0)):
            _, value = _shingles(words_of(part, lower=True), n)
            at = (value % np.uint64(COUNTERS)).astype(np.int64)
            whole[:] = saturating_sum(whole, np.bincount(at, minlength=COUNTERS).astype(whole.dtype))

    return fill


def _bits(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Four places of the filter for each hash."""
    at = np.concatenate([mix(ids.view(np.uint64) + np.uint64(k * int(_ODD) % (1 << 64))) for k in range(4)]) % np.uint64(FILTER_BITS)
    return (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))


def _mark(whole: np.ndarray, batch: pa.RecordBatch) -> None:
    word, bit = _bits(batch.column(0).to_numpy(zero_copy_only=False))
    np.bitwise_or.at(whole, word, bit)


def _marked(whole: np.ndarray, ids: np.ndarray) -> np.ndarray:
    word, bit = _bits(ids)
    return ((whole[word] & bit) != 0).reshape(4, -1).all(axis=0)


# --- tables ---------------------------------------------------------------------------------------

SETS = "key {key}, n_shingles bigint, set_id bigint, ranges binary, parity array<bigint>, prefix binary, spread binary"


def _set_rows(counts, like: Similarity) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row for each document; the prefix is left out where this task has sent it already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counts.value
        mean = max(1.0, counter.mean())
        sent: set[int] = set()
        for batch in batches:
            keys, done = batch.column(0), 0
            for part in slices(batch.column(1)):
                row, value, size = _sets(part, like.n)
                count = counter[(value % np.uint64(COUNTERS)).astype(np.int64)]
                order = np.lexsort((value, count, row))
                ids = _fingerprints(row, value, size)
                edge = np.concatenate([[0], np.cumsum(size)])
                ranges, parity = _ranges(row, value, len(size)), _parity(row, value, len(size))
                rare = value[order].astype("<u8")
                parts = np.ceil(np.log2(np.maximum(1, count[order] / (SPREAD_ABOVE * mean)))).astype(np.uint8)
                length = np.where(size > 0, like.prefix(size), 0)
                prefix, spread = [], []
                for i, (set_id, lo, n) in enumerate(zip(ids.tolist(), edge.tolist(), length.tolist())):
                    fresh = n and set_id not in sent
                    if fresh:
                        if len(sent) >= REMEMBERED:
                            sent.clear()
                        sent.add(set_id)
                    prefix.append(rare[lo : lo + n].tobytes() if fresh else b"")
                    spread.append(parts[lo : lo + n].tobytes() if fresh else b"")
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.slice(done, len(size)),
                        pa.array(size.astype(np.int64)),
                        pa.array(ids, mask=size == 0),
                        pa.array([r.tobytes() for r in ranges], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1, dtype=np.int32) * PARITIES), pa.array(parity)),
                        pa.array(prefix, pa.binary()),
                        pa.array(spread, pa.binary()),
                    ],
                    ["key", "n_shingles", "set_id", "ranges", "parity", "prefix", "spread"],
                )
                done += len(size)

    return run


PREFIX = "token bigint, part int, set_id bigint, size bigint, pos int"


def _prefix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 500):
            some = batch.slice(i, 500)
            sent = some.column("prefix").to_pylist()
            lengths = np.array([len(p) // 8 for p in sent])
            tokens = np.frombuffer(b"".join(sent), "<i8")
            spread = np.frombuffer(b"".join(some.column("spread").to_pylist()), np.uint8)
            ids = np.repeat(some.column("set_id").fill_null(0).to_numpy(zero_copy_only=False), lengths)
            sizes = np.repeat(some.column("size").to_numpy(zero_copy_only=False), lengths)
            pos = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            # A frequent n-gram's sets are dealt by the last bits of their fingerprints; -1 tells there are more parts.
            part = np.where(spread > 0, ids & ((1 << spread.astype(np.int64)) - 1), -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens), pa.array(part.astype(np.int32)), pa.array(ids), pa.array(sizes), pa.array(pos.astype(np.int32))],
                ["token", "part", "set_id", "size", "pos"],
            )


SHARED = "token bigint, set_id bigint, size bigint, pos int, leader bigint, leader_size bigint, leader_pos int"
_NAMES = ("token", "part", "set_id", "size", "pos")


def _shared_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows in order of token, part, size and set: those of n-grams with several sets, with the first of them.

    Only the last row, and the first of its group, are carried from batch to batch.
    """
    held: dict[str, np.ndarray] | None = None  # the last row, not yet sent
    first: dict[str, np.ndarray] | None = None  # the first row of its group

    def send(rows: dict, lead: dict, keep: np.ndarray) -> pa.RecordBatch:
        names = ["token", "set_id", "size", "pos"]
        columns = [pa.array(rows[n][keep]) for n in names] + [pa.array(lead[n][keep]) for n in names[1:]]
        return pa.RecordBatch.from_arrays(columns, [*names, "leader", "leader_size", "leader_pos"])

    def flush(last: bool, new: dict | None) -> Iterator[pa.RecordBatch]:
        nonlocal held, first
        rows = {n: np.concatenate([x[n] for x in (held, new) if x is not None]) for n in _NAMES}
        fresh = np.ones(len(rows["token"]), bool)  # equal sets are one row
        same_group = (rows["token"][1:] == rows["token"][:-1]) & (rows["part"][1:] == rows["part"][:-1])
        fresh[1:] = ~(same_group & (rows["set_id"][1:] == rows["set_id"][:-1]))
        rows = {n: x[fresh] for n, x in rows.items()}
        count = len(rows["token"])
        starts = np.ones(count, bool)
        starts[1:] = (rows["token"][1:] != rows["token"][:-1]) | (rows["part"][1:] != rows["part"][:-1])
        open_before = first is not None and first["token"][0] == rows["token"][0] and first["part"][0] == rows["part"][0]
        if open_before:
            starts[0] = False
        group = np.cumsum(starts) - (0 if open_before else 1)
        heads = {n: np.concatenate([first[n] if open_before else rows[n][:0], rows[n][starts]]) for n in _NAMES}
        lead = {n: heads[n][group] for n in _NAMES}
        ends = np.ones(count, bool)
        ends[:-1] = starts[1:]
        several = ~(starts & ends) | (rows["part"] >= 0)
        if not last:
            # Whether the last row is alone in its group shows with the next one.
            held = {n: x[-1:] for n, x in rows.items()}
            alone = starts[-1]
            first = None if alone else {n: x[-1:] for n, x in lead.items()}
            several[-1] = False
        if several.any():
            yield send(rows, lead, several)

    for batch in batches:
        if batch.num_rows:
            yield from flush(False, {n: batch.column(n).to_numpy(zero_copy_only=False) for n in _NAMES})
    if held is not None:
        yield from flush(True, None)


ARRAYS = "set_id bigint, shingles binary"


def _array_rows(needed, n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Whole sets of the documents whose key's hash the filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = needed.value
        for batch in batches:
            wanted = _marked(bits, batch.column(0).to_numpy(zero_copy_only=False))
            for part in slices(batch.column(1).filter(pa.array(wanted))):
                row, value, size = _sets(part, n)
                some, edge = np.flatnonzero(size), np.concatenate([[0], np.cumsum(size)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(_fingerprints(row, value, size)[some]),
                        pa.array([value[edge[i] : edge[i + 1]].tobytes() for i in some], pa.binary()),
                    ],
                    ["set_id", "shingles"],
                )

    return run


# --- pairs ----------------------------------------------------------------------------------------


def _most(a: pa.Array, b: pa.Array) -> pa.Array:
    """An upper bound of the intersection: in each hash range no more than the smaller number."""
    x, y = (np.frombuffer(b"".join(v.to_pylist()), "<u2").reshape(-1, RANGES).astype(np.int64) for v in (a, b))
    # The largest number may stand for any.
    least = np.minimum(np.where(x == 65535, 1 << 40, x), np.where(y == 65535, 1 << 40, y))
    return pa.array(least.sum(axis=1))


def _common(a: pa.Array, b: pa.Array) -> pa.Array:
    def common(x: bytes, y: bytes) -> int:
        both = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
        both.sort()
        return int(np.count_nonzero(both[1:] == both[:-1]))

    return pa.array([common(x.as_py(), y.as_py()) for x, y in zip(a, b)], pa.int64())


def _other(path: str) -> list[Column]:
    names = {"set_id": "other", "size": "other_size", "pos": "other_pos", "root": "other_root"}
    return [F.col(path.format(c)).alias(name) for c, name in names.items()]


class _Work:
    """Tables of one run in the shared folder."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.folder = spark, f"{shared_folder(spark)}/tables-{uuid4().hex}"
        self.names: list[str] = []
        bounded_batches(spark)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        self.names.append(name)
        return self.spark.read.parquet(path)

    def drop(self, *patterns: str) -> None:
        """Delete tables that nothing reads any more, by file name patterns."""
        for name in [n for n in self.names if any(fnmatch(n, p) for p in patterns)]:
            remove(self.spark, f"{self.folder}/{name}")
            self.names.remove(name)


def _least(like: Similarity) -> Column:
    return F.ceil(like.share_below * (F.col("size") + F.col("other_size")) / (like.share_above + like.share_below))


def _near(like: Similarity) -> Column:
    """Length and positional filter: what the sets have from their places on must suffice."""
    left = F.least(F.col("size") - F.col("pos"), F.col("other_size") - F.col("other_pos"))
    fits = like.share_above * F.least("size", "other_size") >= like.share_below * F.greatest("size", "other_size")
    return fits & (left >= _least(like))


def _passing(rows: DataFrame, like: Similarity) -> DataFrame:
    """Distinct pairs (a, b) of rows with set, size and position of both that pass the length and positional filters."""
    return rows.where(_near(like)).select(
        F.least("set_id", "other").alias("a"), F.greatest("set_id", "other").alias("b")
    ).distinct()


def _filtered(pairs: DataFrame, sets: DataFrame, like: Similarity) -> DataFrame:
    """Pairs that the suffix filter leaves."""

    def side(name: str) -> DataFrame:
        return sets.select(F.col("set_id").alias(name), F.col("size").alias(f"size_{name}"), F.col("ranges").alias(f"ranges_{name}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    least = F.ceil(like.share_below * (F.col("size_a") + F.col("size_b")) / (like.share_above + like.share_below))
    return both.withColumn("most", F.arrow_udf(_most, "bigint")("ranges_a", "ranges_b")).where(F.col("most") >= least).select("a", "b", "size_a", "size_b")


def _across(mixed: DataFrame, sets: DataFrame, like: Similarity, work: _Work) -> DataFrame:
    """Rows of two sets of one group that lie in different components.

    In large groups their parities must not differ in more bits than linked sets of their sizes do in n-grams.
    """
    small = mixed.where(F.col("members") < LARGE_GROUP).withColumn("parity", F.lit(None).cast("array<bigint>"))
    large = mixed.where(F.col("members") >= LARGE_GROUP).join(sets.select("set_id", "parity"), "set_id")
    rows = work.keep(small.unionByName(large).drop("members"), "apart")
    other = rows.select("token", *_other("{}"), F.col("parity").alias("other_parity"))
    differ = reduce(Column.__add__, [F.bit_count(F.col("parity")[i].bitwiseXOR(F.col("other_parity")[i])) for i in range(PARITIES)])
    fits = F.col("size") + F.col("other_size") - 2 * _least(like) >= F.coalesce(differ, F.lit(0))
    return rows.join(other, "token").where("root <> other_root and set_id < other").where(_near(like)).where(fits)


def _verified(pairs: DataFrame, documents: DataFrame, sets: DataFrame, like: Similarity, work: _Work) -> DataFrame:
    """The pairs that are linked. Of each set the document with the smallest key is read again."""
    spark = work.spark
    ids = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
    keys = ids.join(sets.select("set_id", "smallest"), "set_id").select(F.xxhash64("smallest"))
    needed = spark.sparkContext.broadcast(fixed_array(keys, FILTER_BITS // 64, "u8", _mark, np.bitwise_or))
    arrays = documents.select(F.xxhash64("key"), "text").mapInArrow(_array_rows(needed, like.n), ARRAYS)
    arrays = arrays.join(ids, "set_id").groupBy("set_id").agg(F.first("shingles").alias("shingles"))

    def side(name: str) -> DataFrame:
        return arrays.select(F.col("set_id").alias(name), F.col("shingles").alias(f"set_{name}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("common", F.arrow_udf(_common, "bigint")("set_a", "set_b"))
    linked = like.share_above * F.col("common") >= like.share_below * (F.col("size_a") + F.col("size_b") - F.col("common"))
    return both.where(linked).select("a", "b")


def components(edges: DataFrame, work: _Work, name: str) -> DataFrame:
    """``node`` and ``root`` of every node of the edges (a, b): equal roots for connected nodes.

    In each round every node points to its smallest neighbour, if that is smaller, and the edges are redrawn
    between the nodes pointed to, until none is left. Fingerprints are random, so a constant share of the nodes
    goes in a round on average, in chains as well.
    """
    edges = work.keep(edges.where("a <> b"), f"{name}-edges-0")
    roots, i = None, 0
    while not edges.isEmpty():
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to"))
        point = work.keep(point.select(F.col("a").alias("node"), "to"), f"{name}-point-{i}")
        # One step further on is cheap here and shortens chains.
        on = point.select(F.col("node").alias("to"), F.col("to").alias("next"))
        point = point.join(on, "to", "left").select("node", F.coalesce("next", "to").alias("to"))
        if roots is None:
            roots = point.select("node", F.col("to").alias("root"))
        else:
            roots = roots.join(point.withColumnRenamed("node", "root"), "root", "left").select(
                "node", F.coalesce("to", "root").alias("root")
            )
        i += 1
        moved = edges.join(point.select(F.col("node").alias("a"), F.col("to").alias("ra")), "a")
        moved = moved.join(point.select(F.col("node").alias("b"), F.col("to").alias("rb")), "b")
        edges = moved.where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        edges = work.keep(edges, f"{name}-edges-{i}")
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return work.keep(roots, f"{name}-roots")


def similar_documents(df: DataFrame, like: Similarity = Similarity(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of the input: the key, ``n_shingles`` and ``component_id``.

    Words are runs without white space, A-Z in lower case. ``n_shingles`` is the size of the set of distinct
    n-grams; a text with fewer words is one n-gram of all of them; one without words, or null, has none and is
    linked with nothing. ``component_id`` is the smallest key that links lead to, its own included. Rows with
    equal keys are documents of their own that share a name; a null key is nobody's smallest.
    """
    spark = df.sparkSession
    work = _Work(spark)
    documents = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    counts = fixed_array(documents.select("text"), COUNTERS, "u4", _count(like.n), saturating_sum)
    shared_counts = spark.sparkContext.broadcast(counts)
    schema = SETS.format(key=df.schema[key].dataType.simpleString())
    rows = work.keep(documents.mapInArrow(_set_rows(shared_counts, like), schema), "sets")
    sets = rows.where("set_id is not null").groupBy("set_id").agg(
        F.first("n_shingles").alias("size"), F.first("ranges").alias("ranges"), F.first("parity").alias("parity"), F.min("key").alias("smallest")
    )
    sets = work.keep(sets, "distinct-sets")

    prefixes = rows.where("length(prefix) > 0").select("set_id", F.col("n_shingles").alias("size"), "prefix", "spread")
    prefixes = prefixes.mapInArrow(_prefix_rows, PREFIX)
    ordered = prefixes.repartition("token", "part").sortWithinPartitions("token", "part", "size", "set_id")
    shared = work.keep(ordered.mapInArrow(_shared_rows, SHARED), "shared")

    led = shared.where("set_id <> leader").withColumnsRenamed(
        {"leader": "other", "leader_size": "other_size", "leader_pos": "other_pos"}
    )
    tested = work.keep(_filtered(_passing(led, like), sets, like), "pairs-0")
    links = work.keep(_verified(tested, documents, sets, like, work), "links-0")
    roots = components(links, work, "round-0")

    for i in range(1, LEADER_ROUNDS + 2):
        last = i > LEADER_ROUNDS
        member = shared.select("token", "set_id", "size", "pos").join(roots.withColumnRenamed("node", "set_id"), "set_id", "left")
        member = work.keep(member.withColumn("root", F.coalesce("root", "set_id")), f"members-{i}")
        draws = [F.min(F.struct(F.xxhash64("set_id", F.lit(i), F.lit(k)), "set_id", "size", "pos", "root")) for k in range(LEADERS)]
        mixed = member.groupBy("token").agg(
            F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("set_id").alias("members"), F.array_distinct(F.array(*draws)).alias("leads")
        ).where("lo < hi")
        if last:
            near = _across(member.join(mixed.select("token", "members"), "token"), sets, like, work)
        else:
            leads = mixed.select("token", F.explode("leads").alias("lead")).select("token", *_other("lead.{}"))
            near = member.join(leads, "token").where("root <> other_root")
        pairs = _passing(near, like).join(tested.select("a", "b"), ["a", "b"], "left_anti")
        pairs = work.keep(_filtered(pairs, sets, like), f"pairs-{i}")
        if pairs.isEmpty():
            continue
        more = work.keep(_verified(pairs, documents, sets, like, work), f"links-{i}")
        tested, links = tested.unionAll(pairs), links.unionAll(more)
        roots = components(links, work, f"round-{i}")

    # The result reads the sets and the last round's components only.
    work.drop("shared", "members-*", "pairs-*", "links-*", "apart", "*-point-*")
    named = sets.select("set_id", "smallest").join(roots.withColumnRenamed("node", "set_id"), "set_id", "left")
    named = named.withColumn("root", F.coalesce("root", "set_id"))
    least = named.groupBy("root").agg(F.min("smallest").alias("component"))
    component = named.join(least, "root").select("set_id", "component")
    out = rows.select("key", "n_shingles", "set_id").join(component, "set_id", "left")
    return out.select(
        F.col("key").alias(key), "n_shingles", F.when(F.col("set_id").isNull(), F.col("key")).otherwise(F.col("component")).alias("component_id")
    )


def one_of_each_group(df: DataFrame, like: Similarity = Similarity(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of the smallest key of each group of similar documents, with the columns they had.

    Of rows with equal keys one stays, the smallest by its other columns. A row without a key names no document to
    keep in its place, so it stays.
    """
    found = similar_documents(df.where(F.col(f"`{key}`").isNotNull()), like, key, text)
    stays = F.max((F.col(key) == F.col("component_id")).cast("int")) == 1
    keys = found.groupBy(F.col(key).alias("__key")).agg(stays.alias("__stays"), F.count("*").alias("__rows"))

    def of(rows: Column) -> DataFrame:
        return df.join(keys.where(F.col("__stays") & rows).select("__key"), df[f"`{key}`"] == F.col("__key"), "left_semi")

    repeated = dedup(of(F.col("__rows") > 1), [key])
    return of(F.col("__rows") == 1).unionByName(repeated).unionByName(df.where(F.col(f"`{key}`").isNull()))
