"""Nearest neighbours: true distances, recall against brute force, ties, copies and odd vectors."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from retailstrata.llm.ann import Block, Cuts, Search, chi_square, neighbours, projection


def brute(rows: dict, query: int, k: int = 10) -> list:
    own = np.array(rows[query], float)
    found = sorted((math.sqrt(((np.array(v, float) - own) ** 2).sum()), i) for i, v in rows.items() if i != query)
    return found[:k]


def by_query(out) -> dict:
    found: dict = {}
    for r in sorted(out.collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    return found


def recall(found: dict, rows: dict, queries: list[int]) -> float:
    hits = 0
    for q in queries:
        expected = brute(rows, q)
        assert [r for r, *_ in found[q]] == list(range(1, len(expected) + 1))
        assert [x[1:] for x in found[q]] == sorted(x[1:] for x in found[q])
        for _, score, i in found[q]:
            assert score == pytest.approx(float(np.linalg.norm(np.array(rows[i], float) - np.array(rows[q], float))), abs=1e-12)
        hits += len({i for _, i in expected} & {i for *_, i in found[q]})
    return hits / sum(len(brute(rows, q)) for q in queries)


@pytest.mark.parametrize("search", [Search(), Search(block=40, sample=200)], ids=["one block", "many"])
def test_recall_on_the_given_vectors(spark, search):
    df = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = dict(df.select("vec_id", "embedding").collect())
    queries = [i for i in rows if i % 25 == 0]
    found = by_query(neighbours(df, F.col("vec_id") % 25 == 0, search))
    assert recall(found, rows, queries) >= 0.9


def test_recall_on_clusters(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((20, 32)) * 10
    rows = {i: (centres[i % 20] + rng.standard_normal(32)).astype(np.float32).tolist() for i in range(3000)}
    df = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<float>")
    found = by_query(neighbours(df, F.col("vec_id") % 100 == 0, Search(block=200, sample=500)))
    assert recall(found, rows, list(range(0, 3000, 100))) >= 0.9


def test_copies_and_ties(spark):
    rows = {i: [1.0, 0.0] for i in range(40)} | {100: [0.0, 1.0], 101: [2.0, 1.0], 102: [0.0, -1.0], 103: [5.0, 5.0]}
    df = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<float>")
    found = by_query(neighbours(df.union(df), F.col("vec_id").isin(0, 3, 39, 100), Search(block=2)))
    for q in (0, 3, 39, 100):
        assert [x[1:] for x in found[q]] == [(pytest.approx(d), i) for d, i in brute(rows, q)]


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0]), (1, [1.0, 3.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [None, 1.0]),
        (7, []), (8, [1.0]), (None, [1.0, 2.0]), (100, [0.0, 0.0]), (200, [4.0, 6.0]), (300, None),
    ]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<double>").withColumns({c: F.lit(1) for c in ("id", "part", "score", "rank")})
    found = by_query(neighbours(df, F.col("vec_id") % 100 == 0))
    assert found == {0: [(1, 1.0, 1), (2, 5.0, 200)], 200: [(1, math.sqrt(18), 1), (2, 5.0, 0)]}
    assert neighbours(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert neighbours(df, F.lit(False)).count() == 0
    assert neighbours(df.where("vec_id = 0"), F.lit(True)).count() == 0


def test_chi_square():
    assert chi_square(np.array([0.0, 1e6]), 8).tolist() == [0.0, 1.0]
    drawn = (np.random.default_rng(1).standard_normal((200_000, 8)) ** 2).sum(axis=1)
    for x in (2.0, 7.34, 15.5):
        assert chi_square(x, 8) == pytest.approx((drawn <= x).mean(), abs=0.005)


def test_parts_and_distances_to_them():
    rng = np.random.default_rng(2)
    points = rng.standard_normal((500, 4))
    cuts = Cuts.fit(points, 16)
    part = cuts.part_of(points)
    assert cuts.parts == 16 and set(part) == set(range(16))
    for p in points[:20]:
        apart = ((points - p) ** 2).sum(axis=1)
        for bound in (0.0, 0.3, 2.0, 1e9):
            near = cuts.near(p, lambda squared: squared > bound)
            assert set(part[apart <= bound]) <= set(near) and len(near) == len(set(near))
        assert sorted(near) == list(range(16)) and len(cuts.near(p, lambda squared: squared > 0.05)) < 16
    assert Cuts.fit(points[:0], 1).part_of(points).tolist() == [0] * 500


def test_parts_and_sample_grow_with_the_vectors(spark):
    search = Search()
    assert [search.parts_for(n) for n in (0, 1, 10_000, 10_001, 10**8, 10**10)] == [1, 1, 1, 2, 10_000, 1 << 16]
    assert [search.sample_for(n) for n in (10, 10**8, 10**12)] == [20_000, 80_000, 8 << 16]
    rng = np.random.default_rng(7)
    rows = {i: rng.standard_normal(6).tolist() for i in range(4000)}
    df = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>")
    # Few of the vectors fit the tree, and it has many parts of several blocks.
    found = by_query(neighbours(df, F.col("vec_id") % 200 == 0, Search(block=50, parts=16, sample=60, sample_per_part=4)))
    assert recall(found, rows, list(range(0, 4000, 200))) >= 0.9


def test_blocks_index_every_vector():
    rng = np.random.default_rng(4)
    vectors = np.concatenate([rng.standard_normal((300, 6)), np.ones((200, 6))])
    search = Search(k=500)
    directions = projection(6, search)
    block = Block(vectors, [[i] for i in range(500)], directions)
    assert len(block.search(vectors[0], None, float("inf"), directions, search)) == 500
