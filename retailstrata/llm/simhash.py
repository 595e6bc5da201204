"""Groups of documents whose 64-bit similarity fingerprints differ in few bits, found exactly.

A fingerprint's bit is set where more than half of a text's word n-grams (repeats included) have it set in their
XXH64 hash. Equal fingerprints are one from there on. Links between the rest are found by the generalised
pigeonhole principle:

1. *Partitions.* The 64 bits are divided into groups, each taking in the bits that go most with those it has, by
   correlations counted over all fingerprints. Groups of bits that say the same leave the others more selective.
2. *Thresholds.* If two fingerprints differ in at most t bits and thresholds of m groups sum to t - m + 1, then in some
   group they differ in no more bits than its threshold. -1 leaves a group out. Every fingerprint gets thresholds
   of its own: those of the least estimated number of probes and candidates, by dynamic programming over the
   groups. Estimates come from counters of fixed size and decide about work only, never about results.
3. *Probes.* Each fingerprint is filed under its value in every group, and looks up all values within its
   threshold. Candidates are verified on the spot, as the fingerprint is all there is to compare.
4. *Large buckets.* A value that very many fingerprints share makes no pairs. Its members, and those that look it up,
   meet at points half way: two fingerprints within t bits have such a point within t / 2 bits of both, every
   fingerprint has a fixed number of them, and those that meet at a point are linked with one of them. So the
   members of a large group of near copies need a fixed number of rows each, and no link is lost.

Links are joined into components. Steps hand over through tables in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import fixed_array, saturating_sum
from .ngram_join import _Work, components
from .words import WHITE, lower_ascii, mix, slices, spaced_words, text_bytes

BITS = 64
SEED = 42
# Counters of the estimates, 4 MB whatever the input.
COUNTERS = 1 << 20
# Hashes whose bits are unpacked at a time, and fingerprints whose thresholds are chosen at a time.
_HASHES = 1 << 13
_ROWS = 1 << 12


@dataclass(frozen=True)
class Nearness:
    """``n``: words of an n-gram; ``bits``: the most bits in which linked fingerprints differ; ``large``: the largest
    bucket whose fingerprints are compared one by one; ``groups``: of bits, by default as many as promise the least work."""

    n: int = 3
    bits: int = 2
    large: int = 64
    groups: int | None = None


# --- fingerprints ---------------------------------------------------------------------------------


def _set_bits(values: np.ndarray) -> np.ndarray:
    """A row of 64 zeros and ones for each value, the lowest bit first."""
    return np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _of_bits(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits.astype(np.uint8), axis=1, bitorder="little").view("<u8").ravel()


def batch_fingerprints(texts: pa.Array, n: int) -> np.ndarray:
    """The fingerprint of each text. A null text is an empty one."""
    import xxhash

    data, bounds = text_bytes(texts)
    w, rows = spaced_words(lower_ascii(data), bounds, WHITE), len(bounds) - 1
    words = np.bincount(w.row, minlength=rows)
    first = np.cumsum(words) - words
    # Each n-gram is a byte range that begins at a word; texts of fewer words have one with all of them.
    at = np.flatnonzero(np.arange(len(w.row)) - first[w.row] < np.maximum(words - n + 1, 1)[w.row])
    last = at + np.minimum(words[w.row[at]], n) - 1
    row, raw = w.row[at], w.data.tobytes()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros((rows, BITS), np.int64)
    for i in range(0, len(at), _HASHES):
        part = slice(i, i + _HASHES)
        spans = zip(w.start[at[part]].tolist(), w.end[last[part]].tolist())
        bits = _set_bits(np.array([digest(raw[s:e], SEED) for s, e in spans], np.uint64))
        own = row[part]
        edge = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        ones[own[edge]] += np.add.reduceat(bits, edge, axis=0, dtype=np.int64)
    return _of_bits(2 * ones > np.bincount(row, minlength=rows)[:, None])


def fingerprints(df: DataFrame, n: int = Nearness.n, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``fingerprint`` (as a signed integer) of every row. A text without words, or null, has zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [batch_fingerprints(part, n) for part in slices(batch.column(1))]
            values = np.concatenate([np.zeros(0, "<u8"), *found]).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["key", "fingerprint"])

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, fingerprint bigint")


# --- groups of bits and their thresholds -------------------------------------------------------------


def correlated_groups(together: np.ndarray, total: int, m: int) -> list[list[int]]:
    """The bits in ``m`` groups of nearly equal size. ``together``: how often two bits are both set."""
    share = together / max(total, 1)
    own = np.diag(share)
    spread = np.sqrt(own * (1 - own))
    strength = np.abs(share - np.outer(own, own)) / np.maximum(np.outer(spread, spread), 1e-12)
    np.fill_diagonal(strength, 0)
    left, groups = list(range(BITS)), []
    for i in range(m):
        group = [max(left, key=lambda b: (strength[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < (BITS + i) // m:
            best = max(left, key=lambda b: (strength[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def _ball(width: int, radius: int) -> int:
    return sum(comb(width, r) for r in range(radius + 1))


def number_of_groups(total: int, bits: int) -> int:
    """The number of groups of the least work, were fingerprints spread evenly."""

    def work(m: int) -> float:
        width, rest = BITS // m, bits - m + 1
        high, extra = divmod(rest, m)
        balls = [_ball(width, high + (i < extra)) for i in range(m)]
        return sum(b * (1 + total / 2.0**width) for b in balls)

    return min(range(1, bits + 2), key=work)


def values_in(values: np.ndarray, group: list[int]) -> np.ndarray:
    """The bits of a group as one number."""
    out = np.zeros(len(values), np.uint64)
    for k, bit in enumerate(group):
        out |= ((values >> np.uint64(bit)) & np.uint64(1)) << np.uint64(k)
    return out


def _flips(width: int, radius: int) -> np.ndarray:
    """All ways to change exactly ``radius`` of ``width`` bits."""
    return np.array([sum(1 << b for b in chosen) for chosen in combinations(range(width), radius)], np.uint64)


def _counter(part: int, value: np.ndarray) -> np.ndarray:
    return (mix(value + np.uint64((part + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) % np.uint64(COUNTERS)).astype(np.int64)


def choose_thresholds(values: np.ndarray, groups: list[list[int]], bits: int, counts: np.ndarray) -> np.ndarray:
    """A threshold for each fingerprint and group, the cheapest that sum to ``bits - groups + 1``, by dynamic programming."""
    m, goal = len(groups), bits - len(groups) + 1
    cost = np.zeros((len(values), m, bits + 2))  # by threshold + 1; leaving a group out costs nothing
    for i, group in enumerate(groups):
        own, sum_ = values_in(values, group), np.zeros(len(values))
        for t in range(min(goal + m - 1, bits) + 1):
            flips = _flips(len(group), t)
            at = _counter(i, (own[:, None] ^ flips[None, :]).ravel()).reshape(len(own), -1)
            sum_ = sum_ + counts[at].sum(axis=1, dtype=np.float64) + len(flips)
            cost[:, i, t + 1] = sum_
    # best[s]: least cost of the groups so far with thresholds + 1 that sum to s.
    need = goal + m
    best = np.full((len(values), need + 1), np.inf)
    best[:, 0] = 0
    taken = np.zeros((len(values), m, need + 1), np.int8)
    for i in range(m):
        options = np.full((len(values), need + 1, need + 1), np.inf)
        for t in range(min(need, bits + 1) + 1):
            options[:, t, t:] = best[:, : need + 1 - t] + cost[:, i, t, None]
        taken[:, i] = options.argmin(axis=1)
        best = options.min(axis=1)
    out, left = np.zeros((len(values), m), np.int64), np.full(len(values), need)
    for i in range(m - 1, -1, -1):
        t = taken[np.arange(len(values)), i, left]
        out[:, i], left = t - 1, left - t
    return out


# --- rows of tasks ---------------------------------------------------------------------------------

FILED = "part int, value bigint, fingerprint bigint"


def _batch(part: np.ndarray, value: np.ndarray, fingerprint: np.ndarray, last: str) -> pa.RecordBatch:
    columns = [pa.array(part.astype(np.int32)), pa.array(value.view(np.int64)), pa.array(fingerprint.view(np.int64))]
    return pa.RecordBatch.from_arrays(columns, ["part", "value", last])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        yield from (values[i : i + _ROWS] for i in range(0, len(values), _ROWS))


def _filed(batches: Iterator[pa.RecordBatch], groups: list[list[int]]) -> Iterator[pa.RecordBatch]:
    for values in _chunks(batches):
        for i, group in enumerate(groups):
            yield _batch(np.full(len(values), i), values_in(values, group), values, "fingerprint")


def _probes(batches: Iterator[pa.RecordBatch], groups: list[list[int]], bits: int, counts) -> Iterator[pa.RecordBatch]:
    for values in _chunks(batches):
        chosen = choose_thresholds(values, groups, bits, counts.value)
        for i, group in enumerate(groups):
            own = values_in(values, group)
            for t in range(int(chosen[:, i].max()) + 1):
                some, flips = chosen[:, i] >= t, _flips(len(group), t)
                looked_up = (own[some][:, None] ^ flips[None, :]).ravel()
                yield _batch(np.full(len(looked_up), i), looked_up, np.repeat(values[some], len(flips)), "fingerprint")


def _halfway(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Points near each fingerprint; those within half the bits, rounded down, are its inner ones."""
    for values in _chunks(batches):
        for r in range(bits - bits // 2 + 1):
            flips = _flips(BITS, r)
            points = (values[:, None] ^ flips[None, :]).ravel()
            inner = np.full(len(points), r <= bits // 2)
            columns = [pa.array(points.view(np.int64)), pa.array(np.repeat(values, len(flips)).view(np.int64)), pa.array(inner)]
            yield pa.RecordBatch.from_arrays(columns, ["point", "fingerprint", "inner"])


def _add_together(whole: np.ndarray, batch: pa.RecordBatch) -> None:
    bits = _set_bits(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)).astype(np.float64)
    whole += (bits.T @ bits).astype(np.int64).ravel()


def _add_values(whole: np.ndarray, batch: pa.RecordBatch, groups: list[list[int]]) -> None:
    values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
    for i, group in enumerate(groups):
        whole[:] = saturating_sum(whole, np.bincount(_counter(i, values_in(values, group)), minlength=COUNTERS).astype(whole.dtype))


# --- links -----------------------------------------------------------------------------------------


def links(distinct: DataFrame, near: Nearness, work: _Work) -> DataFrame:
    """Pairs (a, b) of fingerprints that differ in at most ``near.bits`` bits: enough of them that their components
    are those of all such pairs. ``distinct`` is a stored table with one column ``fingerprint``."""
    total = distinct.count()
    m = near.groups or number_of_groups(total, near.bits)
    together = fixed_array(distinct, BITS * BITS, "i8", _add_together, np.add).reshape(BITS, BITS)
    groups = correlated_groups(together, total, m)
    counts = fixed_array(distinct, COUNTERS, "u4", partial(_add_values, groups=groups), saturating_sum)
    shared = work.spark.sparkContext.broadcast(counts)

    filed = distinct.mapInArrow(partial(_filed, groups=groups), FILED)
    probes = work.keep(distinct.mapInArrow(partial(_probes, groups=groups, bits=near.bits, counts=shared), FILED), "probes")
    shared.destroy()
    bucket = ["part", "value"]
    large = work.keep(filed.groupBy(*bucket).count().where(F.col("count") > near.large).select(*bucket), "large")
    few = [rows.join(large, bucket, "left_anti") for rows in (probes, filed)]
    candidates = few[0].join(few[1].withColumnRenamed("fingerprint", "other"), bucket).where("fingerprint < other")
    # A pair may come up in several groups, or from both sides in other orders of size: once is enough.
    differing = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("other")))
    pairs = candidates.where(differing <= near.bits).select(F.col("fingerprint").alias("a"), F.col("other").alias("b")).distinct()

    many = [rows.join(large, bucket, "left_semi").select("fingerprint") for rows in (probes, filed)]
    crowded = work.keep(many[0].unionAll(many[1]).distinct(), "crowded")
    near_points = crowded.mapInArrow(partial(_halfway, bits=near.bits), "point bigint, fingerprint bigint, inner boolean")
    # No more than a ball's number of fingerprints meet at a point.
    met = near_points.groupBy("point").agg(
        F.min(F.when(F.col("inner"), F.col("fingerprint"))).alias("a"), F.collect_list("fingerprint").alias("there")
    )
    stars = met.where("a is not null and size(there) > 1").select("a", F.explode("there").alias("b")).where("a <> b").distinct()
    return work.keep(pairs.unionAll(stars), "links")


def near_duplicates(df: DataFrame, near: Nearness = Nearness(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of the input: the key, ``fingerprint`` (16 hexadecimal digits) and ``component_id``.

    Words are runs without white space, A-Z in lower case; an n-gram is hashed with single spaces between its words.
    A text of fewer words is one n-gram of all of them; one without words, or null, has fingerprint zero and is linked
    like any other. ``component_id`` is the smallest key that links lead to, its own included. Rows with equal keys are
    documents of their own that share a name; a null key is nobody's smallest, and a group of null keys alone has null.
    """
    work = _Work(df.sparkSession)
    rows = work.keep(fingerprints(df, near.n, key, text), "fingerprints")
    sets = work.keep(rows.groupBy("fingerprint").agg(F.min("key").alias("smallest")), "distinct")
    roots = components(links(sets.select("fingerprint"), near, work), work, "near")
    named = sets.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    named = named.withColumn("root", F.coalesce("root", "fingerprint"))
    least = named.groupBy("root").agg(F.min("smallest").alias("component_id"))
    component = work.keep(named.join(least, "root").select("fingerprint", "component_id"), "components")
    work.drop("distinct", "probes", "large", "crowded", "links", "near-*")
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return rows.join(component, "fingerprint").select(
        F.col("key").alias(key), digits.alias("fingerprint"), "component_id"
    )
