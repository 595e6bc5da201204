"""The stages against brute-force versions, and the whole run."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import pytest
from test_ngram_join import brute as brute_groups
from test_pii import brute as brute_pii
from test_repetition import brute as brute_quality
from test_tokens import check_pieces, plain

import corpus_pipeline
from conftest import SF_DIR
from retailstrata.llm import mixing, packing


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What each stage returns, written and read again."""
    folder, docs = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        found.append(docs)
    return found


def test_columns(steps):
    documents = steps[0].columns
    assert all(df.columns == documents for df in steps[1:-1])
    assert steps[-1].columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "row"]


def test_quality_keeps_what_passes(spark, steps):
    kept = {r["doc_id"] for r in steps[1].collect()}
    labels = dict(spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "quality").collect())
    for doc, text in steps[0].select("doc_id", "text").collect():
        failed = brute_quality(text)[-1]
        assert not (failed and doc in kept)
        if labels.get(doc) == 1 and not failed:
            assert doc in kept
        if labels.get(doc) == 0 and sum(text.count(c) for c in "#*$%&|<>") > 0.1 * len(text):
            assert doc not in kept


def test_one_of_each_group(steps):
    expected = {c for _, _, c in brute_groups(steps[1].select("doc_id", "text").collect())}
    assert sorted(r["doc_id"] for r in steps[2].collect()) == sorted(expected)


def test_no_identifiers_left(steps):
    before = dict(steps[2].select("doc_id", "text").collect())
    for doc, text, n in steps[3].select("doc_id", "text", "n_chars").collect():
        assert brute_pii(text) == [] and n == len(text)
        if not brute_pii(before[doc]):
            assert text == before[doc]


def test_mixing_and_packing(spark, steps):
    mixed = steps[4].collect()
    assert Counter(r["doc_id"] for r in mixed) == Counter(r["doc_id"] for r in mixing.mix(steps[3]).collect())
    # Copies of a document have equal keys, so the pieces are checked under keys of their own.
    texts = {i: r["text"] for i, r in enumerate(mixed)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    options = packing.Packing(corpus_pipeline.public_tokenizers.path(corpus_pipeline.TOKENIZER))
    check_pieces(packing.pack(df, options).collect(), texts, 2048)
    ids = sum(len(plain(t)) + 1 for t in texts.values())
    rows = steps[5].collect()
    assert sum(r["length"] for r in rows) == ids
    by_sequence = Counter()
    for r in rows:
        by_sequence[r["sequence_id"]] += r["length"]
    # Copies can be put together again: the pieces of a row follow each other.
    of_row: dict = {}
    for r in rows:
        of_row.setdefault((r["row"], r["doc_id"]), []).append(r)
    assert Counter(d for _, d in of_row) == Counter(r["doc_id"] for r in mixed) and len({n for n, _ in of_row}) == len(mixed)
    for pieces in of_row.values():
        at = 0
        for i, r in enumerate(sorted(pieces, key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (i, at)
            at += r["length"]
    assert max(by_sequence.values()) <= 2048 and len(by_sequence) <= 1.1 * ids / 2048 + 8


def brute_copies(docs) -> Counter:
    """Copies of each document by the definition: the distribution's value at the number hashed from its key."""
    sizes = Counter()
    for r in docs:
        sizes[r["source"]] += len(r["text"] or "")
    weights = {s: n**0.7 if n else 0.0 for s, n in sizes.items()}
    out = Counter()
    for r in docs:
        size = sizes[r["source"]]
        rate = weights[r["source"]] / sum(weights.values()) * sum(sizes.values()) / size if size else 1.0
        assert rate <= 64
        at = int(hashlib.md5(f"17:{r['doc_id']}:1".encode()).hexdigest()[:13], 16) / 2**52
        n, term = 0, math.exp(-rate)
        total = term
        while total <= at:
            n += 1
            term *= rate / n
            total += term
        out[r["doc_id"]] += n
    return +out


def test_source_weights_equal_the_definition(spark, steps):
    assert Counter(r["doc_id"] for r in steps[4].collect()) == brute_copies(steps[3].collect())


def test_odd_documents_go_through_every_stage(spark):
    """Null and empty texts, null keys and sources, repeated rows, long texts; no rows at all."""
    long = " ".join(f"w{i} x{i % 97}" for i in range(30_000))
    good = " ".join(f"word{i} and{i * 7 % 101}" for i in range(200))
    rows = [(1, None, "en", "a", None), (2, "", "en", None, 0), (None, good, None, "a", 5), (3, good, "en", "b", 5), (3, good, "en", "b", 5), (4, long, "fr", "b", len(long)), (5, good + " tail", "en", None, 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    names = [name for name, _ in corpus_pipeline.STAGES]
    for first in (rows, []):
        docs, kept = spark.createDataFrame(first, schema), {}
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, SF_DIR).collect()
            kept[name] = Counter(r["doc_id"] for r in found)
            if name != names[-1]:
                docs = spark.createDataFrame([tuple(r) for r in found], schema)
        if first:
            assert kept["quality"] == {None: 1, 3: 2, 4: 1, 5: 1}, "texts without words go"
            assert kept["near_duplicates"] == {None: 1, 3: 1, 4: 1} == kept["personal_data"]
            assert set(kept["source_weights"]) == set(kept["packed"]) <= {None, 3, 4}
        else:
            assert not any(kept.values())


def test_run(spark, steps):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.columns == steps[-1].columns and out.count() > 0
