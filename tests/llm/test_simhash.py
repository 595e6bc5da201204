"""Fingerprints and their groups against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SF_DIR
from retailstrata.llm import simhash
from retailstrata.llm.simhash import Nearness, near_duplicates

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_fingerprint(text: str | None, n: int = 3) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    grams = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, bits: int = 2, fingerprint=plain_fingerprint) -> list[tuple]:
    """(key, hexadecimal digits, smallest key reachable) of every row, by comparing all fingerprints."""
    found = [(k, fingerprint(t)) for k, t in rows]
    distinct = sorted({f for _, f in found})
    parent = {f: f for f in distinct}

    def top(f):
        while parent[f] != f:
            f = parent[f]
        return f

    values = np.array(distinct, np.uint64)
    for i, f in enumerate(distinct):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= bits):
            parent[top(distinct[i + 1 + j])] = top(f)
    least: dict = {}
    for k, f in found:
        if k is not None:
            least[top(f)] = min(k, least.get(top(f), k))
    return [(k, f"{f:016x}", least.get(top(f))) for k, f in found]


def same(df, rows, bits: int = 2) -> None:
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(brute(rows, bits), key=repr)


def test_fingerprints_equal_the_definition():
    rng = random.Random(1)
    texts = ["", None, "a", "A b", "a\tb\x0bc\nd", "é Ü ß", "\xa0 x", " ".join(rng.choice("abcdef") for _ in range(300)), "x" * 5000]
    texts += [" ".join(rng.choice(["Aa", "b", "  ", "ö", "\n", "\x0c"]) for _ in range(rng.randint(1, 30))) for _ in range(300)]
    found = simhash.batch_fingerprints(pa.array(texts), 3)
    assert found.tolist() == [plain_fingerprint(t) for t in texts]


def test_fingerprints_in_small_blocks(monkeypatch):
    monkeypatch.setattr(simhash, "_HASHES", 7)
    texts = ["a b c d e f g h i j k l m n o p", "", "x y", "q r s t u v w x y z " * 20]
    assert simhash.batch_fingerprints(pa.array(texts), 3).tolist() == [plain_fingerprint(t) for t in texts]


def test_documents(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    same(near_duplicates(df), df.select("doc_id", "text").collect())


def grown(rng: random.Random, n: int, tries: int) -> list[int]:
    """Fingerprints in chains and clusters around a few centres, and some alone."""
    out = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(tries):
        f = rng.choice(out)
        for b in rng.sample(range(64), rng.choice([1, 1, 2, 3, 4])):
            f ^= 1 << b
        out.append(f)
    return out


@pytest.mark.parametrize("bits,groups,large", [(0, None, 64), (1, None, 1), (1, 2, 3), (2, None, 64), (2, 1, 64), (2, 2, 3), (2, None, 1), (3, None, 3)])
def test_links_of_given_fingerprints(spark, tmp_path, bits, groups, large):
    rng = random.Random(bits)
    values = sorted(set(grown(rng, 20, 120)))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    spark.createDataFrame([(v,) for v in signed], "fingerprint long").write.parquet(f"{tmp_path}/f")
    distinct = spark.read.parquet(f"{tmp_path}/f")
    work = simhash._Work(spark)
    near = Nearness(bits=bits, large=large, groups=min(groups, bits + 1) if groups else None)
    found = simhash.links(distinct, near, work)
    for a, b in found.collect():
        assert ((a ^ b) & ((1 << 64) - 1)).bit_count() <= bits
    roots = dict(simhash.components(found, work, "t").collect())
    own: dict = {}
    for v in signed:
        own.setdefault(roots.get(v, v), set()).add(v % (1 << 64))
    expected: dict = {}
    for k, _, c in brute([(v, v) for v in values], bits, lambda t: t):
        expected.setdefault(c, set()).add(k)
    assert sorted(map(sorted, own.values())) == sorted(map(sorted, expected.values()))


def test_thresholds_are_the_cheapest():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 1 << 63, 40).astype(np.uint64)
    groups = [list(range(0, 20)), list(range(20, 45)), list(range(45, 64))]
    counts = rng.integers(0, 1000, simhash.COUNTERS).astype("u4")
    chosen = simhash.choose_thresholds(values, groups, 2, counts)
    assert (chosen.sum(axis=1) == 0).all() and (chosen >= -1).all()

    def cost(v: int, i: int, t: int) -> int:
        own, width = simhash.values_in(np.array([v], np.uint64), groups[i])[0], len(groups[i])
        flips = np.concatenate([simhash._flips(width, r) for r in range(t + 1)]) if t >= 0 else np.zeros(0, np.uint64)
        return int(counts[simhash._counter(i, own ^ flips)].sum()) + len(flips)

    options = [(a, b, -a - b) for a in range(-1, 3) for b in range(-1, 3) if -1 <= -a - b <= 2]
    for v, own in zip(values.tolist(), chosen.tolist()):
        costs = {o: sum(cost(v, i, t) for i, t in enumerate(o)) for o in options}
        assert costs[tuple(own)] == min(costs.values())


def test_groups_take_in_bits_that_go_together():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2, (2000, 4))
    order = rng.permutation(64)
    bits = np.empty((2000, 64), int)
    for i, b in enumerate(order):
        bits[:, b] = base[:, i % 4] ^ (rng.random(2000) < 0.05)
    groups = simhash.correlated_groups(bits.T @ bits, 2000, 4)
    place = {b: i % 4 for i, b in enumerate(order.tolist())}
    assert sorted(map(len, groups)) == [16] * 4 and all(len({place[b] for b in g}) == 1 for g in groups)


def test_number_of_groups_follows_the_input():
    assert simhash.number_of_groups(100_000, 2) == 3 and simhash.number_of_groups(10**9, 2) == 2
    assert simhash.number_of_groups(10, 0) == 1


def test_odd_rows(spark):
    rows = [(5, None), (3, ""), (9, " \t"), (None, "a b c d"), (7, "A  b\nc d"), (7, "other words here now"), (None, "alone in here"), (1, "w " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id int, text string").withColumns({c: F.lit("x") for c in ("key", "fingerprint", "component_id", "part")})
    same(near_duplicates(df), rows)
    assert near_duplicates(df.limit(0)).count() == 0
    same(near_duplicates(df.unionAll(df)), rows * 2)


def test_registered_query(spark):
    from retailstrata.llm import queries

    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    same(queries.all_queries()["op12_simhash"](spark, SF_DIR).select("doc_id", "fingerprint", "component_id"), df.select("doc_id", "text").collect())


def test_arrays_over_many_tasks(spark, monkeypatch):
    """All levels of merging: more tasks than are merged at a time, twice over."""
    from retailstrata.llm import arrays

    monkeypatch.setattr(arrays, "_TASKS", 3)
    monkeypatch.setattr(arrays, "_BLOCK", 4)

    def fill(whole, batch):
        np.add.at(whole, batch.column(0).to_numpy() % 10, 1)

    found = arrays.fixed_array(spark.range(0, 1000, 1, 31), 10, "i8", fill, np.add)
    assert found.tolist() == [100] * 10
    hashes = spark.range(500).select(F.xxhash64("id").alias("h"))
    kept = arrays.HashFilter.of(hashes, 500)
    there = np.array([r["h"] for r in hashes.collect()]).view(np.uint64)
    assert kept.has(there).all() and kept.has(there + np.uint64(1)).mean() < 0.02
