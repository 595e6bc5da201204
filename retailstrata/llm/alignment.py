"""Which tokens of two tokenizers stand for the same bytes of a text, and how often pairs of ids meet in a corpus.

Both tokenizers cut the same bytes. Each side is an incidence matrix of tokens by bytes, A and B, in compressed rows.

* A x B' gives the overlap links: token pairs with the number of bytes they share. Two neighbouring tokens of A
  belong together when the last partner of the one is the first of the other; where they differ, both sides end.
  These cuts divide the text into groups, the shortest stretches that both tokenizers agree on.
* With the incidences of tokens by groups instead of bytes the product gives the shared-group links. Its rows are
  taken for the distinct ids of each document, so entries count the linked occurrences of an id pair.

Products are worked out row by row in blocks of bounded size. Documents' pairs are stored and counted over the
corpus after each task has counted its own. Counts of the most frequent pairs, of a bounded number, go to every task;
the rest, each in few documents, are joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .csr import Csr
from .ngram_join import _Work
from .packing import PER_TASK
from .tokens import ChunkTable, encoder
from .words import slices, text_bytes

# Pairs whose counts every task gets: 16 bytes each, in order.
FREQUENT = 1 << 20
# Pairs of documents that are counted together before they are shuffled.
COUNTED = 1 << 20


@dataclass(frozen=True)
class Tokenizers:
    """Files: ``a`` of the tokenizers library (byte-level), ``b`` of sentencepiece (which puts a space before a text)."""

    a: str
    b: str


class Vocabulary:
    """The bytes of every id, on end."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.n = np.array([len(t) for t in tokens], np.int64)
        self.at = np.cumsum(self.n) - self.n
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.size = len(tokens)

    def join(self, ids: np.ndarray) -> np.ndarray:
        n = self.n[ids]
        return self.data[np.repeat(self.at[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


def _byte_of() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable Latin-1 for itself, others from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pieces(ChunkTable):
    """Ids of a sentencepiece model for texts that begin with a space, as the library puts there itself.

    No piece of the usual models goes on after a space that follows something else, so nothing is merged across the
    beginning of a run of spaces: texts are cut there. Models with other pieces get texts whole.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self._space = self.model.piece_to_id("▁")
        self._apart = not any("▁" in p.lstrip("▁") for p in self.pieces)

    def _chunks(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        start = np.zeros(len(data), bool)
        if self._apart:
            space = data == 0x20
            start = space.copy()
            start[1:] &= ~space[:-1]
        start[bounds[:-1][np.diff(bounds) > 0]] = True
        at = np.flatnonzero(start)
        return at, np.append(at[1:], len(data))[: len(at)], np.zeros(len(at), bool)

    def _learn(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, alone: np.ndarray) -> np.ndarray:
        raw = data.tobytes()
        found = self.model.encode([raw[s + 1 : e].decode() for s, e in zip(start.tolist(), end.tolist())], num_threads=1)
        # The library puts no space before an empty text.
        found = [x or [self._space] for x in found]
        ids = np.fromiter(chain.from_iterable(found), np.int64)
        return self._add(ids, np.array([len(x) for x in found], np.int64))


class Pair:
    """Both tokenizers in one Python worker."""

    def __init__(self, files: Tokenizers) -> None:
        self._a = encoder(files.a, True)
        of = _byte_of()
        names = [""] * self._a.size
        for token, i in self._a._tokenizer.get_vocab().items():
            names[i] = token
        self.a = Vocabulary([bytes(of[c] for c in t) if all(c in of for c in t) else t.encode() for t in names])
        self._b = Pieces(files.b)
        byte = [self._b.model.is_byte(i) for i in range(len(self._b.pieces))]
        self.b = Vocabulary([bytes([int(p[3:5], 16)]) if raw else p.replace("▁", " ").encode() for p, raw in zip(self._b.pieces, byte)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both sides on end, and how many of them each text has. No text may be empty or null."""
        spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts.cast(pa.large_string()), pa.scalar("", pa.large_string()))
        (a, of_a), (b, of_b) = self._a.flat(spaced), self._b.flat(spaced)
        return a.astype(np.int64), np.diff(of_a), b.astype(np.int64), np.diff(of_b)


@lru_cache(maxsize=2)
def _pair(files: Tokenizers) -> Pair:
    return Pair(files)


@dataclass
class Aligned:
    """Tokens of texts on end: for each its id, row and group; ``overlaps`` of A's tokens with B's; the number of groups."""

    a: np.ndarray
    a_row: np.ndarray
    a_group: np.ndarray
    b: np.ndarray
    b_row: np.ndarray
    b_group: np.ndarray
    overlaps: Csr
    groups: int


def _same_bytes(pair: Pair, texts: pa.Array, a, own_a, b, own_b) -> np.ndarray:
    """Whether both sides' tokens give back a space and the text."""
    data, bounds = text_bytes(texts)
    size = np.diff(bounds) + 1
    rows = np.arange(len(size))
    expected = np.full(int(size.sum()), 0x20, np.uint8)
    start = np.cumsum(size) - size
    expected[np.arange(len(data)) + np.repeat(rows + 1, size - 1)] = data
    ok = np.ones(len(size), bool)
    for vocabulary, ids, own in ((pair.a, a, own_a), (pair.b, b, own_b)):
        row = np.repeat(rows, own)
        ok &= np.bincount(row, vocabulary.n[ids], len(size)).astype(np.int64) == size
    for vocabulary, ids, own in ((pair.a, a, own_a), (pair.b, b, own_b)):
        joined = vocabulary.join(ids[np.repeat(ok, own)])
        there = np.repeat(ok, size)
        wrong = np.bincount(np.repeat(rows, size)[there][joined != expected[there]], minlength=len(size))
        ok &= wrong == 0
    return ok


def _token_bytes(vocabulary: Vocabulary, ids: np.ndarray, total: int) -> Csr:
    return Csr.incidence(vocabulary.n[ids], np.arange(total), total)


def align(pair: Pair, texts: pa.Array) -> tuple[np.ndarray, Aligned]:
    """The tokens and groups of texts, and which rows have tokens."""
    rows = len(texts)
    filled = pc.fill_null(pc.greater(pc.binary_length(texts), 0), False).to_numpy(zero_copy_only=False)
    a, own_a, b, own_b = pair.encode(texts.filter(pa.array(filled)))
    ok = _same_bytes(pair, texts.filter(pa.array(filled)), a, own_a, b, own_b)
    a, b = a[np.repeat(ok, own_a)], b[np.repeat(ok, own_b)]
    there = np.flatnonzero(filled)[ok]
    a_row, b_row = np.repeat(there, own_a[ok]), np.repeat(there, own_b[ok])
    total = int(pair.a.n[a].sum())
    overlaps = _token_bytes(pair.a, a, total).times(_token_bytes(pair.b, b, total).transposed())
    # Neighbours are cut apart where the last partner of the one is not the first of the other.
    cut = np.ones(len(a), bool)
    if len(a):
        edge = overlaps.indptr[1:-1]
        cut[1:] = overlaps.indices[edge - 1] != overlaps.indices[edge]
    a_group = np.cumsum(cut) - 1
    b_group = np.zeros(len(b), np.int64)
    b_group[overlaps.indices] = np.repeat(a_group, np.diff(overlaps.indptr))
    has = np.zeros(rows, bool)
    has[there] = True
    return has, Aligned(a, a_row, a_group, b, b_row, b_group, overlaps, int(a_group[-1]) + 1 if len(a) else 0)


def group_links(found: Aligned, size_a: int, size_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, id of A, id of B and number of linked occurrences of every id pair of a row that shares a group."""
    # One row of the left matrix for each distinct id of a text, in order of text and id.
    key = found.a_row * size_a + found.a
    order = np.argsort(key, kind="stable")
    new = np.ones(len(key), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    number = np.cumsum(new) - 1
    left = Csr.counted(number, found.a_group[order], int(new.sum()), max(found.groups, 1))
    right = Csr.counted(found.b_group, found.b, max(found.groups, 1), size_b)
    linked = left.times(right)
    row, a = np.divmod(key[order][new], size_a)
    of = linked.row_of()
    return row[of], a[of], linked.indices, linked.data


@lru_cache(maxsize=4)
def _digits(most: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of all numbers below ``most``, with room for one character more, and how many each has."""
    numbers = np.arange(most)
    count, width = np.ones(most, np.int64), len(str(most - 1))
    for k in range(1, width):
        count += numbers >= 10**k
    table = np.zeros((most, width + 1), np.uint8)
    for k in range(width):
        table[:, k] = 48 + numbers // 10 ** np.maximum(count - 1 - k, 0) % 10
    return table, count


def _groups_text(found: Aligned, rows: int) -> pa.Array:
    """For each text ``a1,a2|b1;a3|b2,b3``: the ids of each group on both sides."""
    n_a, n_b = (np.bincount(g, minlength=found.groups) for g in (found.a_group, found.b_group))
    before_a, before_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    count = len(found.a) + len(found.b)
    ids, row, sign = np.empty(count, np.int64), np.empty(count, np.int64), np.full(count, ord(","), np.uint8)
    at_a = np.arange(len(found.a)) + before_b[found.a_group]
    at_b = np.arange(len(found.b)) + (before_a + n_a)[found.b_group]
    ids[at_a], ids[at_b], row[at_a], row[at_b] = found.a, found.b, found.a_row, found.b_row
    sign[before_a + before_b + n_a - 1] = ord("|")
    sign[before_a + before_b + n_a + n_b - 1] = ord(";")
    table, length_of = _digits(10 ** len(str(int(ids.max(initial=0)))))
    digits, width = length_of[ids], table.shape[1]
    chars = table[ids]
    chars[np.arange(count), digits] = sign
    last = np.zeros(count, bool)
    last[:-1] = row[1:] != row[:-1]
    last[-1:] = True
    length = digits + ~last
    data = chars[np.arange(width) < length[:, None]]
    size = np.zeros(rows, np.int64)
    np.add.at(size, row, length)
    bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(rows, pa.py_buffer(bounds), pa.py_buffer(data))


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
_COLUMNS = "key {key}, row bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, pairs binary, times binary"


def _binary(values: np.ndarray, row: np.ndarray, rows: int) -> pa.Array:
    edge = np.searchsorted(row, np.arange(rows + 1)) * values.dtype.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), rows, [None, pa.py_buffer(edge.astype(np.int64)), pa.py_buffer(values)]).cast(pa.binary())


def alignments(df: DataFrame, files: Tokenizers, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of the input: ``key`` and its alignment.

    ``row`` is a number of the row. ``n_a`` and ``n_b`` count tokens, ``n_groups`` groups, ``n_links`` the pairs of an A
    and a B token in one group. ``groups`` lists the ids of every group. ``pairs`` are the distinct linked id pairs
    in order, each as id of A times the size of B's vocabulary plus id of B, 64-bit little-endian; ``times`` (32-bit)
    tells how many occurrences of each are linked. A text that is null or empty, or that either side's tokens do not
    give back, has no tokens: zeros and empty values.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, row = _pair(files), TaskContext.get().partitionId() * PER_TASK
        for batch in batches:
            done = 0
            for part in slices(batch.column(1), 1 << 19):
                n = len(part)
                _, found = align(pair, part)
                of, a, b, times = group_links(found, pair.a.size, pair.b.size)
                group_row = found.a_row[np.concatenate([[True], found.a_group[1:] != found.a_group[:-1]])] if len(found.a) else found.a_row
                links = np.zeros(n, np.int64)
                np.add.at(links, of, times)
                counts = [np.bincount(x, minlength=n).astype(np.int64) for x in (found.a_row, found.b_row, group_row)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(done, n),
                        pa.array(np.arange(row, row + n)),
                        *map(pa.array, counts),
                        pa.array(links),
                        _groups_text(found, n).cast(pa.string()),
                        _binary((a * pair.b.size + b).astype("<i8"), of, n),
                        _binary(times.astype("<u4"), of, n),
                    ],
                    ["key", "row", *_NUMBERS, "groups", "pairs", "times"],
                )
                row, done = row + n, done + n

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, _COLUMNS.format(key=kind))


# --- counts over the corpus --------------------------------------------------------------------------


def _flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a binary column, and how many each row has."""
    n = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.frombuffer(b"".join(column.to_pylist()), kind), n // np.dtype(kind).itemsize


def _pieces(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Parts of batches with about ``most`` pairs, at least one row each."""
    for batch in batches:
        yield from (batch.slice(i, n) for i, n in _cuts(batch.column("pairs"), 8 * most))


def _cuts(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    i = 0
    for part in slices(column, most):
        yield i, len(part)
        i += len(part)


def _own_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []
    size = 0

    def send() -> pa.RecordBatch:
        pairs, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], ["pair", "n"])

    for part in _pieces(batches, COUNTED):
        held.append(_flat(part.column("pairs"), "<i8")[0])
        size += len(held[-1])
        if size >= COUNTED:
            yield send()
            held, size = [], 0
    if size:
        yield send()


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair`` and in how many documents (``n``) it is linked."""
    return aligned.select("pairs").mapInArrow(_own_counts, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def _least_frequent(counts: DataFrame, most: int) -> int:
    """The smallest power of two so that no more than ``most`` pairs have a larger or equal count."""
    by_size = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).count().collect()  # 63 rows at most
    left = sum(r["count"] for r in by_size)
    for power, count in sorted(map(tuple, by_size)):
        if left <= most:
            return 1 << power
        left -= count
    return 1 << 62


def _sums(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    edge = np.concatenate([[0], np.cumsum(n)])
    return total[edge[1:]] - total[edge[:-1]]


def _known(shared, size_b: int, rest: bool):
    """Sums over the pairs that ``shared`` holds counts of, or the rows of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = shared.value
        for part in _pieces(batches, COUNTED // 4):
            own, n = _flat(part.column("pairs"), "<i8")
            times = _flat(part.column("times"), "<u4")[0].astype(np.int64)
            at = np.minimum(np.searchsorted(pairs, own), max(len(pairs) - 1, 0))
            there = pairs[at] == own if len(pairs) else np.zeros(len(own), bool)
            if rest:
                row = np.repeat(part.column("row").to_numpy(), n)
                columns = [pa.array(row[~there]), pa.array(own[~there]), pa.array(times[~there])]
                yield pa.RecordBatch.from_arrays(columns, ["row", "pair", "times"])
            else:
                count = np.where(there, counts[at], 0) if len(pairs) else np.zeros(len(own), np.int64)
                highest = there & (count == best[own // size_b])
                sums = [pa.array(_sums(np.where(highest, times, 0), n)), pa.array(_sums(times * count, n))]
                yield pa.RecordBatch.from_arrays([part.column("row"), *sums], ["row", "n_best", "count_sum"])

    return run


def corpus_alignment(df: DataFrame, files: Tokenizers, key: str = "doc_id", text: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """One row for each row of the input: the key, the counts of ``alignments``, ``groups_sha256`` and what the corpus says.

    The count of an id pair is the number of rows that have it linked. ``n_best`` are the links whose count is the
    highest of any pair with their A id, ties included; ``count_sum`` adds the counts of all links. The digest is empty for
    a text without tokens. Rows with null or repeated keys are documents like any other.
    """
    work = _Work(df.sparkSession)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    rows = work.keep(alignments(df, files, key, text).select("key", "row", *_NUMBERS, digest, "pairs", "times"), "aligned")
    counts = work.keep(pair_counts(rows), "counts")

    pair = _pair(files)
    size_b = pair.b.size
    best = np.zeros(pair.a.size, np.int64)  # one number for each id of a vocabulary
    a = F.expr(f"cast(pair div {size_b} as int)")
    for r in counts.groupBy(a.alias("a")).agg(F.max("n").alias("n")).collect():
        best[r["a"]] = r["n"]
    known = counts.where(F.col("n") >= _least_frequent(counts, frequent)).toArrow()
    pairs, n = (known.column(c).to_numpy() for c in ("pair", "n"))
    order = np.argsort(pairs)
    shared = df.sparkSession.sparkContext.broadcast((pairs[order], n[order], best))

    sums = rows.select("row", "pairs", "times").mapInArrow(_known(shared, size_b, False), "row bigint, n_best bigint, count_sum bigint")
    rare = rows.select("row", "pairs", "times").mapInArrow(_known(shared, size_b, True), "row bigint, pair bigint, times bigint")
    highest = df.sparkSession.createDataFrame(pa.table({"a": np.arange(len(best), dtype=np.int32), "best": best}))
    of_rare = rare.join(counts, "pair").join(F.broadcast(highest), a == F.col("a"))
    of_rare = of_rare.select(
        "row", F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum")
    )
    both = sums.unionAll(of_rare).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    base = rows.select(F.col("key").alias(key), "row", *_NUMBERS, "groups_sha256")
    return base.join(both, "row").select(key, *_NUMBERS, "n_best", "count_sum", "groups_sha256")
