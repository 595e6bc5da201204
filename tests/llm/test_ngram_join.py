"""Similarity groups against brute force over all pairs."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from retailstrata.llm import ngram_join
from retailstrata.llm.ngram_join import Similarity, one_of_each_group, similar_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None, n: int = 5) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute(rows, n: int = 5) -> list:
    sets = [(key, shingles(text, n)) for key, text in rows]
    group = list(range(len(sets)))

    def find(i: int) -> int:
        while group[i] != i:
            i = group[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            common = len(a & b)
            if common and 100 * common >= 75 * (len(a) + len(b) - common):
                group[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (key, _) in enumerate(sets):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return sorted(((k, len(s), least.get(find(i)) if s else k) for i, (k, s) in enumerate(sets)), key=str)


def near_copies(rng: random.Random, groups: int, size: int, length: int) -> list[str]:
    """Groups of texts that differ from their first one in a few words, all with a passage in common."""
    words = [f"w{i}" for i in range(3000)]
    passage = " ".join(rng.choice(words) for _ in range(12))
    out = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(length)]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randint(0, max(1, length // 20))):
                text[rng.randrange(len(text))] = rng.choice(words)
            out.append(" ".join(text) + " " + passage)
    return out


def result(df, **options) -> list:
    return sorted((tuple(r) for r in similar_documents(df, **options).collect()), key=str)


def test_equals_brute_force_on_the_given_documents(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert result(df) == brute(df.select("doc_id", "text").collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force_on_near_copies(spark, seed, monkeypatch):
    monkeypatch.setattr(ngram_join, "LARGE_GROUP", 3)
    monkeypatch.setattr(ngram_join, "SPREAD_ABOVE", 0.01)
    monkeypatch.setattr(ngram_join, "REMEMBERED", 10)
    monkeypatch.setattr(ngram_join, "LEADER_ROUNDS", seed - 1)
    rng = random.Random(seed)
    texts = near_copies(rng, 6, 12, 80) + near_copies(rng, 1, 60, 40) + ["a b c"] * 3 + ["A b C", "a b", None, "", " \n", "x"]
    rng.shuffle(texts)
    rows = [(i * 3 % 1009, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = result(df)
    assert got == brute(rows)
    assert max(Counter(r[2] for r in got).values()) > 5


def test_similarity_at_the_limit(spark):
    # 30 and 40 n-grams, 30 in common: exactly 0.75. One less in common is too few.
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words[:34])), (2, " ".join(words[:44])), (3, " ".join(words[:33] + ["z"])), (4, " ".join(["q", *words[1:44]]))]
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_odd_rows(spark):
    long = " ".join(f"w{i % 7919}" for i in range(60_000))
    rows = [(None, "a b c d e f"), (7, "A B C D E F"), (7, "A B C D E F"), (3, long), (9, long + " end"), (4, None), (5, ""), (None, None), (None, "lonely words")]
    df = spark.createDataFrame(rows, "doc_id int, text string").withColumns({c: F.lit(1) for c in ("key", "set_id", "size", "component_id")})
    assert result(df) == brute(rows)
    assert similar_documents(df.limit(0)).count() == 0


def test_one_of_each_group_stays(spark):
    rows = [(2, "a b c d e f", 1), (1, "A b c d e f", 2), (1, "A b c d e f", 2), (3, "other words are here now", 3), (None, "a b c d e f", 4), (5, None, 5), (6, None, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    out = one_of_each_group(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["n_chars"]) for r in out.collect()) == [(0, 4), (1, 2), (3, 3), (5, 5), (6, 6)]


def test_filters_never_lose_a_linked_pair():
    like, rng = Similarity(), random.Random(7)
    words = [f"w{i}" for i in range(400)]
    for _ in range(300):
        a = [rng.choice(words) for _ in range(rng.randint(1, 120))]
        b = list(a)
        for _ in range(rng.randint(0, 8)):
            b[rng.randrange(len(b))] = rng.choice(words)
        row, value, size = ngram_join._sets(pa.array([" ".join(a), " ".join(b)]), 5)
        common = len(np.intersect1d(value[row == 0], value[row == 1]))
        if 100 * common < 75 * (size.sum() - common):
            continue
        ranges = pa.array([x.tobytes() for x in ngram_join._ranges(row, value, 2)])
        assert ngram_join._most(ranges[:1], ranges[1:])[0].as_py() >= common
        parity = ngram_join._parity(row, value, 2).view(np.uint64).reshape(2, -1)
        assert np.bitwise_count(parity[0] ^ parity[1]).sum() <= size.sum() - 2 * common
        order = np.random.default_rng(1).permutation(1 << 16)
        first = [sorted(value[row == r], key=lambda v: (order[v & 0xFFFF], v))[: like.prefix(size)[r]] for r in (0, 1)]
        assert set(first[0]) & set(first[1])
        assert like.prefix(size)[0] == size[0] - -(-75 * size[0] // 100) + 1
