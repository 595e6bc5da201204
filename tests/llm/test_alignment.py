"""Alignments and their counts against brute force; the sparse products against dense ones."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_DIR
from retailstrata.llm import alignment, csr
from retailstrata.llm.alignment import Tokenizers, corpus_alignment

FILES = Tokenizers(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
A = Tokenizer.from_file(FILES.a)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=FILES.b)


def byte_level() -> dict[str, int]:
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    out, extra = {chr(b): b for b in own}, 256
    for b in range(256):
        if b not in own:
            out[chr(extra)] = b
            extra += 1
    return out


BYTE = byte_level()


def b_bytes(i: int) -> bytes:
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def plain(text: str | None) -> list[tuple[list[int], list[int]]]:
    """The groups of a text: ids of both sides."""
    if not text:
        return []
    encoding = A.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(BYTE[c] for c in t)) for i, t in zip(encoding.ids, encoding.tokens)]
    b = [(i, b_bytes(i)) for i in B.encode(text)]
    if not b"".join(t for _, t in a) == b"".join(t for _, t in b) == (" " + text).encode():
        return []
    groups, i, j, end_a, end_b = [([], [])], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if end_a <= end_b and i < len(a):
            end_a += len(a[i][1])
            groups[-1][0].append(a[i][0])
            i += 1
        else:
            end_b += len(b[j][1])
            groups[-1][1].append(b[j][0])
            j += 1
        if end_a == end_b and (i < len(a) or j < len(b)):
            groups.append(([], []))
    return groups


def brute(rows) -> list[tuple]:
    docs = [(k, plain(t)) for k, t in rows]
    links = [[(x, y) for a, b in groups for x in a for y in b] for _, groups in docs]
    count = Counter(p for own in links for p in set(own))
    best: dict = {}
    for (x, _), n in count.items():
        best[x] = max(n, best.get(x, 0))
    out = []
    for (k, groups), own in zip(docs, links):
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            k, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(own),
            sum(count[p] == best[p[0]] for p in own), sum(count[p] for p in own),
            hashlib.sha256(said.encode()).hexdigest() if groups else "",
        ))
    return out


def same(df, rows) -> None:
    assert df.columns[1:] == ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(brute(rows), key=repr)


ODD = [
    None, "", " ", "  ", "a", " a", "a\nb", "<|endoftext|> x<|endoftext|>", "<s> </s> <unk> <0x41>", "▁x", "日本語テスト。", "🙂🙂 🙂", "ﬁ Ａ é é", "a\x00b",
    "x" * 300, "abababab" * 50, "  lead and trail  ", "tab\tand\r\nline", "don't, won't; 12345 3.14", "ſ ß İ ​ \xa0",
]


def test_odd_texts(spark):
    rows = [*enumerate(ODD), (None, "a b"), (3, "a b"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id int, text string").withColumns({c: F.lit("x") for c in ("key", "row", "pairs", "n", "groups")})
    same(corpus_alignment(df, FILES), rows)
    assert corpus_alignment(df.limit(0), FILES).count() == 0


@pytest.mark.parametrize("frequent", [1 << 20, 500, 0])
def test_documents(spark, frequent):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    same(corpus_alignment(df, FILES, frequent=frequent), df.select("doc_id", "text").collect())


def test_many_parts_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(csr, "EXPANDED", 10)
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab é日\n.x▁") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    pair = alignment.Pair(FILES)
    has, found = alignment.align(pair, pa.array(texts))
    said = alignment._groups_text(found, len(texts)).to_pylist()
    for text, own, there in zip(texts, said, has):
        groups = plain(text)
        assert there == bool(groups)
        assert own == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def test_pieces_equal_the_library():
    rng = random.Random(6)
    texts = ["".join(rng.choice(["a", "b c", " ", "  ", "é", "日", "\n", ".", "\t", "the", "x" * 20, "\x00", "<unk>"]) for _ in range(rng.randint(1, 30))) for _ in range(2000)]
    own = alignment.Pieces(FILES.b)
    for _ in range(2):
        ids, bounds = own.flat(pa.array([" " + t for t in texts]))
        for t, lo, hi in zip(texts, bounds, bounds[1:]):
            assert ids[lo:hi].tolist() == B.encode(t), repr(t)


def test_overlap_links_count_shared_bytes():
    pair = alignment.Pair(FILES)
    text = "unbelievable tokenizers, don't they?"
    _, found = alignment.align(pair, pa.array([text]))
    ends = [np.cumsum(v.n[ids]) for v, ids in ((pair.a, found.a), (pair.b, found.b))]
    starts = [e - v.n[ids] for e, (v, ids) in zip(ends, ((pair.a, found.a), (pair.b, found.b)))]
    shared = np.minimum(ends[0][:, None], ends[1][None, :]) - np.maximum(starts[0][:, None], starts[1][None, :])
    dense = np.zeros(shared.shape, int)
    dense[found.overlaps.row_of(), found.overlaps.indices] = found.overlaps.data
    assert (dense == np.maximum(shared, 0)).all()


def test_products_equal_dense_ones(monkeypatch):
    monkeypatch.setattr(csr, "EXPANDED", 17)
    rng = np.random.default_rng(1)
    for _ in range(20):
        n, m, k = rng.integers(1, 30, 3)
        a, b = rng.integers(0, 3, (n, m)) * rng.integers(0, 2, (n, m)), rng.integers(0, 3, (m, k)) * rng.integers(0, 2, (m, k))

        def sparse(x):
            row, column = np.nonzero(x)
            return csr.Csr(np.searchsorted(row, np.arange(len(x) + 1)), column, x[row, column], x.shape[1])

        def dense(x):
            out = np.zeros((x.rows, x.columns), int)
            out[x.row_of(), x.indices] = x.data
            return out

        assert (dense(sparse(a).times(sparse(b))) == a @ b).all()
        assert (dense(sparse(a).transposed()) == a.T).all()


def test_registered_query(spark):
    from retailstrata.llm import queries

    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    same(queries.all_queries()["op13_alignment"](spark, SF_DIR), df.select("doc_id", "text").collect())
