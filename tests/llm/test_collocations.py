"""Phrases against brute force, the summaries' guarantee, and the registered query against its SQL."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from oracle_check import compare, duck_connection
from retailstrata.llm import collocations as c
from retailstrata.llm.collocations import Mining, Summary, collocations

LOWER = str.maketrans({chr(x): chr(x + 32) for x in range(65, 91)})


def brute(rows, mining: Mining) -> list[tuple]:
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, mining.longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        chosen = {p: n for p, n in f.items() if len(p) >= 2 and n >= mining.least}
        longer = defaultdict(int)
        for p, n in chosen.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(n, longer[p[i : i + k]])
        found = []
        for p, a in chosen.items():
            if 100 * longer[p] >= mining.inside * a:
                continue
            score, _, le, r = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), le, r))
        for rank, (score, a, p, le, r) in enumerate(sorted(found)[: mining.top], 1):
            out.append((lang, rank, p.decode(), -a, le, r, total[lang], -score))
    return sorted(out)


def texts(rng: random.Random, n: int) -> list[tuple]:
    words = ["a", "B", "cc", "ça", "d", "new york", "new york city", "x\ty", "e", "\xa0"]
    ends = [" ", " ", " ", "  ", ", ", ". ", "\n", "! ", "\t"]
    return [(rng.choice(["en", "en", None, "und", "fr"]), "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randint(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize("mining", [Mining(least=3), Mining(longest=4, least=4, inside=70, top=15), Mining(longest=2, least=1)])
def test_phrases(spark, mining):
    rows = texts(random.Random(7), 200) + [("en", None), (None, ""), ("de", " .. "), ("en", "word " * 3000)]
    df = spark.createDataFrame(rows, "lang string, text string").withColumns({x: F.lit(1) for x in ("n", "a", "words", "phrase", "part")})
    found = collocations(df.repartition(5), mining)
    assert sorted(map(tuple, found.collect())) == brute(rows, mining)
    assert {t for _, t in found.dtypes} == {"string", "bigint"}


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(c, "COUNTED", 50)
    monkeypatch.setattr(c, "_TAKEN", 20)
    rows = texts(random.Random(8), 60)
    df = spark.createDataFrame(rows, "lang string, text string")
    work = c._Work(spark)
    mining = Mining(least=5)
    kept = c.frequent_ngrams(df, mining, work)
    f = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 4):
                f.update(("und" if lang is None else lang, k, " ".join(words[i : i + k])) for i in range(len(words) - k + 1))
    found = {(r["lang"], r["words"], r["phrase"]): r["n"] for r in kept.where("words > 0").collect()}
    assert found == {k: n for k, n in f.items() if n >= 5}


def test_a_table_without_rows(spark):
    df = spark.createDataFrame([], "lang string, text string, doc_id long")
    assert collocations(df).count() == 0


@pytest.mark.parametrize("capacity", [1, 5, 40, 10_000])
def test_summaries_keep_what_reaches_the_threshold(capacity):
    rng = np.random.default_rng(capacity)
    for least in (2, 10, 50):
        whole, counts = Summary(capacity, least), Counter()
        for _ in range(40):
            keys = rng.zipf(1.3, 300).clip(max=5000).astype(np.uint64)
            own, n = np.unique(keys, return_counts=True)
            whole.add(own, n)
            counts.update(keys.tolist())
        kept = set(whole.may_reach().tolist())
        assert {k for k, n in counts.items() if n >= least} <= kept
        assert whole.taken_off < least and whole.capacity > whole.mass // least
        held = dict(zip(whole.keys.tolist(), whole.counts.tolist()))
        assert all(n - whole.taken_off <= held.get(k, 0) <= n for k, n in counts.items())


def test_summaries_are_bounded_and_merge():
    rng = np.random.default_rng(1)
    merged, mass = Summary(2000, 10), 0
    for _ in range(10):
        one = Summary(2000, 10)
        for _ in range(4):
            keys, n = np.unique(rng.integers(0, 100_000, 500).astype(np.uint64), return_counts=True)
            one.add(keys, n)
        assert len(one.keys) <= 2000
        mass += one.mass
        merged.add(one.keys, one.counts)
        assert len(merged.keys) <= 2000
    assert merged.taken_off > 0 and mass == 20_000


def test_the_registered_query_equals_its_sql(spark):
    from retailstrata.llm import queries

    query, sql = queries.all_queries()["op11_collocations"], queries.all_oracles()["op11_collocations"]
    assert compare(query(spark, SF_DIR), duck_connection(SF_DIR), sql) is None
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert sorted(map(tuple, query(spark, SF_DIR).collect())) == brute(df.select("lang", "text").collect(), Mining())


def test_large_counts_are_scored_exactly(spark):
    big = 3 * 10**12
    rows = [("en", 1, "x", big + 7), ("en", 1, "y", big + 1), ("en", 2, "x y", big - 1), ("en", 0, "", 10**14)]
    frequent = spark.createDataFrame(rows, "lang string, words int, phrase string, n long")
    assert c._scored(frequent).first()["score"] == 1_000_000 * (big - 1) ** 2 // ((big + 7) * (big + 1))
