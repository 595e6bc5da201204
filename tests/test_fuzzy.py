"""Texts within a few edits against all pairs."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from retailstrata.operators import fuzzy


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def misspelled(rng: random.Random, word: str) -> str:
    out = list(word)
    for _ in range(rng.randint(0, 3)):
        at = rng.randint(0, len(out))
        out[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "é", " "])
    return "".join(out)


@pytest.mark.parametrize("most, each", [(1, 1000), (2, 1000), (2, 2)])
def test_pairs_equal_all_pairs(spark, most, each):
    rng = random.Random(most)
    texts = [None, "", "a", *(misspelled(rng, w) for w in ["golden lace 17", "blue", "ab", "aa", "résumé"] * 14)]
    df = spark.createDataFrame([(t, 1) for t in texts], "name string, text int")
    counts = Counter(t for t in texts if t is not None)
    own = sorted(counts)
    expected = {(a, b, d, counts[a], counts[b]) for a in own for b in own if a < b and (d := edits(a, b)) <= most}
    found = fuzzy.similar_texts(df, "name", most, each)
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert fuzzy.similar_texts(df.limit(0), "name", most).count() == 0


def test_nearest_known_texts(spark):
    rng = random.Random(9)
    known = ["golden lace", "golden face", "blue", "glue", "ab"]
    texts = [*(misspelled(rng, rng.choice(known)) for _ in range(80)), "far away", None, "", "olden lace", "clue"]
    df, listed = spark.createDataFrame([(t,) for t in texts], "t string"), spark.createDataFrame([(k,) for k in [*known, None, "ab"]], "k string")
    expected = []
    for t in {t for t in texts if t is not None and t not in known}:
        near = sorted((edits(t, k), k) for k in known if edits(t, k) <= 2)
        best = [k for d, k in near if d == near[0][0]]
        expected.append((t, best[0], near[0][0], len(best)) if near else (t, None, None, 0))
    assert sorted(map(tuple, fuzzy.nearest_known(df, "t", listed, 2).collect())) == sorted(expected)


def test_no_pair_is_made_but_by_a_shared_text(spark):
    df = spark.createDataFrame([("a",)], "t string")
    for out in (fuzzy.similar_texts(df, "t", 2), fuzzy.nearest_known(df, "t", df, 2)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_no_side_is_broadcast_however_small_it_is_thought_to_be(spark):
    df = spark.createDataFrame([("a",)], "t string")
    for out in (fuzzy.similar_texts(df, "t", 2), fuzzy.nearest_known(df, "t", df, 2)):
        assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
