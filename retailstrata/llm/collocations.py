"""Phrases whose words go together more often than their parts would by chance, per language.

1. *Summaries.* N-grams of one word up to the longest phrase are dealt to partitions by hash. Each task sends
   what it counted, and each partition merges that into one Misra-Gries summary: a bounded number of counters; when
   there are more, the largest count that leaves too many is taken off all of them and those at zero go. The
   capacity exceeds the partition's n-grams divided by the threshold, so what was taken off in all stays below
   it, and every n-gram that reaches the threshold keeps a counter. How much was taken off is known, so counters
   that cannot reach the threshold with it are left out.
2. *Exact counts.* The texts are read again, and only n-grams that a filter of the survivors lets through are sent
   with their words and added up exactly. The summaries, and hashes shared by several n-grams, let too much through
   at most; those below the threshold go now.
3. *Scores* follow from counts of phrases and their parts, which are as frequent as the phrases and so counted too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import HashFilter
from .ngram_join import _Work
from .words import Spaced, lower_ascii, mix, slices, span_hashes, spaced_words, text_bytes

_ODD = np.uint64(0x9E3779B97F4A7C15)
# Fixed characters: those that end a piece, and those between words.
ENDS_PIECE = ".,;:!?\n\x0b\x0c\r"
BETWEEN_WORDS = " \t"
NO_LANGUAGE = "und"
# N-grams that a task counts together, and rows a partition takes before it merges.
COUNTED = 1 << 21
_TAKEN = 1 << 18
# Bits of a hash that tell n-grams of a partition apart in its summary.
_KEY_BITS = 40
# Parts of a language that are ranked on their own first.
_RANKED_APART = 32


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_ENDS, _WHITE = _table(ENDS_PIECE), _table(BETWEEN_WORDS)


@dataclass(frozen=True)
class Mining:
    """``longest``: words of a phrase; ``least``: occurrences of a phrase; ``inside``: percent of a phrase's occurrences
    inside one longer phrase from which on it is left out; ``top``: phrases a language."""

    longest: int = 3
    least: int = 10
    inside: int = 50
    top: int = 2000


# --- n-grams of a batch ------------------------------------------------------------------------------


def _seeds(langs: pa.Array) -> np.ndarray:
    """A hash of each row's language."""
    coded = pc.fill_null(langs, NO_LANGUAGE).dictionary_encode()
    own = np.array([xxhash.xxh64_intdigest(x.encode()) for x in coded.dictionary.to_pylist()], np.uint64)
    return own[coded.indices.to_numpy()] if len(own) else np.zeros(0, np.uint64)


def _grams(w: Spaced, seeds: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length the first words and the hashes of all n-grams."""
    words = span_hashes(w.data, w.start, w.end)
    at, value = np.arange(len(words)), mix(words ^ seeds[w.row])
    yield 1, at, value
    for n in range(2, longest + 1):
        keep = at + n - 1 < len(words)
        keep[keep] = w.joined[at[keep] + n - 1]
        at = at[keep]
        value = mix(value[keep] * _ODD + words[at + n - 1] + np.uint64(n))
        yield n, at, value


def _words(texts: pa.Array) -> Spaced:
    data, bounds = text_bytes(texts)
    return spaced_words(lower_ascii(data), bounds, _WHITE, _ENDS)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, Spaced]]:
    """Languages and words of parts of batches."""
    for batch in batches:
        done = 0
        for part in slices(batch.column(1)):
            yield batch.column(0).slice(done, len(part)), _words(part)
            done += len(part)


def _part_and_key(values: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    return (values >> np.uint64(_KEY_BITS)) % np.uint64(parts), values & np.uint64((1 << _KEY_BITS) - 1)


def _ids(part: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Partition and key as one hash."""
    return mix(key + part.astype(np.uint64) * _ODD)


# --- summaries --------------------------------------------------------------------------------------


class Summary:
    """Misra-Gries counters of 64-bit keys for a threshold. ``taken_off``: what each count may lack at most.

    ``capacity`` is what is expected to suffice. It grows with what was counted to stay above that divided by the
    threshold, and where taking off more could lose a key that reaches the threshold nothing is taken off.
    """

    def __init__(self, capacity: int, least: int) -> None:
        self.capacity, self.least = capacity, least
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.mass = self.taken_off = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Take in another summary's counters, or plain counts."""
        self.mass += int(counts.sum())
        keys, counts = np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts])
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        first = np.ones(len(keys), bool)
        first[1:] = keys[1:] != keys[:-1]
        at = np.flatnonzero(first)
        self.keys, self.counts = keys[at], np.add.reduceat(counts, at) if len(at) else counts
        self.capacity = max(self.capacity, self.mass // self.least + 1)
        if len(self.keys) > self.capacity:
            rank = len(self.keys) - self.capacity - 1
            off = int(np.partition(self.counts, rank)[rank])
            if self.taken_off + off < self.least:
                self.taken_off += off
                keep = self.counts > off
                self.keys, self.counts = self.keys[keep], self.counts[keep] - off

    def may_reach(self) -> np.ndarray:
        """Every key that was counted ``least`` times, and few others."""
        return self.keys[self.counts + self.taken_off >= self.least]


_COUNTS = "part int, low binary, high binary, counts binary"


def _count(parts: int, longest: int):
    """Counts of a task's n-grams, for each partition in one row."""

    def send(held: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        part, key = _part_and_key(values, parts)
        order = np.argsort(part, kind="stable")
        part, key, counts = part[order], key[order], counts[order].astype("<u4")
        own, edge = np.unique(part, return_index=True)
        edge = [*edge.tolist(), len(part)]
        low, high = key.astype("<u4"), (key >> np.uint64(32)).astype(np.uint8)
        columns = [pa.array([x[i:j].tobytes() for i, j in zip(edge, edge[1:])], pa.binary()) for x in (low, high, counts)]
        return pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), *columns], ["part", "low", "high", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for langs, w in _batches(batches):
            for _, _, values in _grams(w, _seeds(langs), longest):
                held.append(values)
                size += len(values)
                if size >= COUNTED:
                    yield send(held)
                    held, size = [], 0
        if size:
            yield send(held)

    return run


def _survive(capacity: int, least: int):
    """The ids of a partition's n-grams that may reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary, part, held, size = Summary(capacity, least), None, [], 0

        def merge() -> None:
            summary.add(*(np.concatenate(x) for x in zip(*held)))

        for batch in batches:
            for row in batch.to_pylist():
                if part not in (None, row["part"]):
                    raise RuntimeError("a task got several partitions of n-grams")
                part = row["part"]
                high = np.frombuffer(row["high"], np.uint8).astype(np.uint64) << np.uint64(32)
                held.append((np.frombuffer(row["low"], "<u4") | high, np.frombuffer(row["counts"], "<u4").astype(np.int64)))
                size += len(high)
                if size >= max(_TAKEN, len(summary.keys)):
                    merge()
                    held, size = [], 0
        if size:
            merge()
        if part is not None:
            keys = summary.may_reach()
            yield pa.RecordBatch.from_arrays([pa.array(_ids(np.full(len(keys), part), keys).view(np.int64))], ["id"])

    return run


def _exact(shared, parts: int, longest: int):
    """N-grams that the filter lets through, with their words and counts of a part of a batch; words = 0: all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        survivors = shared.value
        for langs, w in _batches(batches):
            langs = pc.fill_null(langs, NO_LANGUAGE)
            raw = w.data.tobytes()
            total = np.bincount(w.row, minlength=len(langs))
            rows = np.flatnonzero(total)
            out = [(rows, np.zeros(len(rows), np.int64), [b""] * len(rows), total[rows])]
            for n, at, values in _grams(w, _seeds(langs), longest):
                some = survivors.has(_ids(*_part_and_key(values, parts)))
                at, values = at[some], values[some]
                _, first, counts = np.unique(values, return_index=True, return_counts=True)
                first = at[first]
                spans = zip(w.start[first].tolist(), w.end[first + n - 1].tolist())
                out.append((w.row[first], np.full(len(first), n), [raw[s:e] for s, e in spans], counts))
            for row, n, phrases, counts in out:
                yield pa.RecordBatch.from_arrays(
                    [langs.take(pa.array(row)), pa.array(n.astype(np.int32)), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(counts.astype(np.int64))],
                    ["lang", "words", "phrase", "n"],
                )

    return run


def frequent_ngrams(df: DataFrame, mining: Mining, work: _Work, lang: str = "lang", text: str = "text") -> DataFrame:
    """``lang``, ``words``, ``phrase`` and exact count ``n`` of every n-gram that reaches the threshold.

    A row with no words and an empty phrase has the number of all words of its language.
    """
    spark = work.spark
    rows = df.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Two bytes a word, with what ends it, are the fewest, so there are no more n-grams than this.
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0))).first()[0]
    capacity = mining.longest * size // 2 // mining.least // parts + 1
    counted = rows.mapInArrow(_count(parts, mining.longest), _COUNTS).repartitionById(parts, "part")
    survivors = work.keep(counted.mapInArrow(_survive(capacity, mining.least), "id bigint"), "survivors")
    shared = spark.sparkContext.broadcast(HashFilter.of(survivors, survivors.count()))
    found = rows.mapInArrow(_exact(shared, parts, mining.longest), "lang string, words int, phrase string, n bigint")
    total = found.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    kept = work.keep(total.where((F.col("words") == 0) | (F.col("n") >= mining.least)), "frequent")
    shared.destroy()
    work.drop("survivors")
    return kept


# --- scores ------------------------------------------------------------------------------------------


def _scored(frequent: DataFrame) -> DataFrame:
    """Candidates with the cut of the lowest score, the earliest of equal ones."""
    parts = F.split("phrase", " ")
    cuts = frequent.where("words >= 2").select("*", parts.alias("parts"), F.explode(F.expr("sequence(1, words - 1)")).alias("cut"))
    cuts = cuts.select(
        "lang", "words", "phrase", F.col("n").alias("a"), "cut",
        F.array_join(F.expr("slice(parts, 1, cut)"), " ").alias("first"),
        F.array_join(F.expr("slice(parts, cut + 1, words - cut)"), " ").alias("rest"),
    )

    def of(name: str, count: str) -> DataFrame:
        return frequent.where("words >= 1").select("lang", F.col("phrase").alias(name), F.col("n").alias(count))

    both = cuts.join(of("first", "l"), ["lang", "first"]).join(of("rest", "r"), ["lang", "rest"])
    # Decimals of 38 digits hold the products exactly up to counts of 10 to the power 16.
    wide = [F.col(c).cast("decimal(38,0)") for c in ("a", "l", "r")]
    score = F.call_function("div", wide[0] * wide[0] * F.lit(1_000_000).cast("decimal(38,0)"), wide[1] * wide[2])
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r"))
    return both.groupBy("lang", "phrase", "words", "a").agg(lowest.alias("best")).select("lang", "phrase", "words", "a", "best.l", "best.r", "best.score")


def _inside_longer(frequent: DataFrame) -> DataFrame:
    """For each shorter phrase the largest count of a longer one that holds its words."""
    inner = F.expr(
        "flatten(transform(sequence(2, words - 1), k -> "
        "transform(sequence(1, words - k + 1), i -> array_join(slice(split(phrase, ' '), i, k), ' '))))"
    )
    return frequent.where("words >= 3").select("lang", F.explode(inner).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("longer"))


def collocations(df: DataFrame, mining: Mining = Mining(), lang: str = "lang", text: str = "text") -> DataFrame:
    """Each language's best phrases: ``lang``, ``rank`` (from 1), ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A-Z are lower-cased; texts are split into pieces at ``ENDS_PIECE`` and those into words at ``BETWEEN_WORDS``. A
    null text is an empty one, a null language is ``und``. ``n`` are the words of the language, ``a`` the occurrences
    of a phrase, ``l`` and ``r`` those of its two parts at the cut of the lowest ``score``, a million times a squared
    by l and r, rounded down. Phrases whose words lie in a longer frequent one ``inside`` percent of the time or more
    are left out. Order: score, then a, descending, then the phrase's bytes.
    """
    work = _Work(df.sparkSession)
    frequent = frequent_ngrams(df, mining, work, lang, text)
    scored = _scored(frequent).join(_inside_longer(frequent), ["lang", "phrase"], "left")
    kept = scored.where(F.coalesce(100 * F.col("longer") < mining.inside * F.col("a"), F.lit(True)))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    apart = F.pmod(F.xxhash64("phrase"), F.lit(_RANKED_APART))
    for by in ([F.col("lang"), apart], [F.col("lang")]):  # what is not among the first of its part is not of the whole
        kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= mining.top)
    words = frequent.where("words = 0").select("lang", F.col("n"))
    return kept.join(words, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle(mining: Mining = Mining()) -> str:
    """The result in DuckDB's dialect over ``documents``."""
    upper = "".join(map(chr, range(65, 91)))
    return f"""WITH pieces AS (
  SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words), range(1, {mining.longest + 1}) AS lengths(k)
  WHERE i + k - 1 <= len(w) GROUP BY ALL),
totals AS (SELECT lang, cast(sum(f) AS BIGINT) AS n FROM grams WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f FROM grams WHERE k >= 2 AND f >= {mining.least}),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, l.f AS l, r.f AS r, cut,
    cast((1000000::HUGEINT * c.f * c.f) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
  JOIN grams l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : cut], ' ')
  JOIN grams r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1 : c.k], ' ')),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_phrases AS (
  SELECT lang, array_to_string(w[i : i + len - 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT *, unnest(range(1, k)) AS i FROM candidates), range(2, {mining.longest}) AS lengths(len)
  WHERE len < k AND i + len - 1 <= k GROUP BY ALL),
kept AS (
  SELECT s.* FROM scored s LEFT JOIN inner_phrases p ON s.lang = p.lang AND s.phrase = p.phrase
  WHERE p.longer IS NULL OR 100 * p.longer < {mining.inside} * s.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= {mining.top}"""
