"""Token ids against plain encoding, the store's round trip and index, and packing."""

from __future__ import annotations

import math
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_DIR
from retailstrata.llm import token_store, tokens
from retailstrata.llm.packing import OpenBins, Packing, cut, pack, sequences

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)


def plain(text: str | None) -> np.ndarray:
    return np.array(PLAIN.encode(text or "", add_special_tokens=False).ids, "<u4")


ODD = [
    "", " ", "  ", "a.", "a  b", "a\n\nb \n c", " lead", "trail  ", "\t\tx", "it's I'll don't 'S, a's.", "<|endoftext|> x, <|endoftext|>.",
    "é, x. 12, 3. ß.", "x\ny, z.\nw", "a,. b., c,,", "²., ³,", "a\xa0 b", "a \xa0  b", "x　 y", "日本語 テスト。", "🙂 🙂🙂",
    "a" * 500 + " " + "1" * 300, "\x1c a", "foo\r\n\r\nbar", "\x85 z  ", "ſ ß İ", "a\x0b b", "x" * 60 + ", " + "y" * 70 + ". z", "word, " * 3, "\n", "a\n",
]


def test_encoding_equals_the_library():
    rng = random.Random(3)
    parts = [" ", " ", "\n", "a", "be", "é", ",", ".", "'s", "12", "x" * 50, "<|endoftext|>", "日", "\xa0", "-", "Q"]
    parts += ["\t", "\r", "'", "\u2019", "\u200b", "\x1d", "\u2028", "\u3000", "ab.c", "))"]
    texts = ODD + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    encoded = tokens.encoder(PATH).encode(texts)
    for text, ids in zip(texts, encoded):
        assert ids == plain(text).tobytes(), repr(text)


def test_the_cache_is_bounded(monkeypatch):
    for name, value in {"PLACES": 64, "MOST_ENTRIES": 100, "MOST_IDS": 200, "MOST_LONG_BYTES": 500, "TOGETHER": 5}.items():
        monkeypatch.setattr(tokens, name, value)
    own = tokens.Encoder(PATH)
    texts = [f"w{i} x{i}, y{i}. {'long' * 5}{i}" for i in range(500)]
    for _ in range(2):
        assert own.encode(texts) == [plain(t).tobytes() for t in texts]
        assert own._entries < 120 and own._used < 250 and len(own._long) < 10


def test_special_strings_as_plain_text():
    own = tokens.encoder(PATH, True)
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    texts = ["<|endoftext|>", "a<|endoftext|> b", "x <|endoftext|>, y"]
    assert own.encode(texts) == [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_ends_are_put_between_texts():
    ids, bounds = tokens.encoder(PATH).flat(pa.array(["a b", None, "", "c"]), end=True)
    expected = [np.append(plain(t), 0) for t in ("a b", None, "", "c")]
    assert ids.tolist() == np.concatenate(expected).tolist()
    assert np.diff(bounds).tolist() == [len(x) for x in expected]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"))


# --- packing --------------------------------------------------------------------------------------


def test_cut():
    assert cut(1, 4) == [(0, 1)] and cut(4, 4) == [(0, 4)]
    assert cut(5, 4) == [(0, 1), (1, 4)] and cut(8, 4) == [(0, 4), (4, 4)] and cut(9, 4) == [(0, 1), (1, 4), (5, 4)]


def test_best_fit_equals_a_plain_search():
    rng = random.Random(5)
    for limit in (1, 3, 50):
        bins, open_, opened = OpenBins(32, limit), {}, 0
        for _ in range(2000):
            n = rng.randint(1, 32)
            number, offset = bins.place(n)
            fitting = [free for free in open_.values() if free >= n]
            if fitting:
                assert open_.get(number) == min(fitting) == 32 - offset
            else:
                assert number == opened and offset == 0
                opened += 1
                if len(open_) == limit:
                    fullest = min(open_.values())
                    left = [b for ids in bins.by_free.values() for b in ids]
                    gone = [b for b in open_ if b not in left and b != number]
                    assert len(gone) == 1 and open_.pop(gone[0]) == fullest
            open_[number] = 32 - offset - n
            if not open_[number]:
                del open_[number]


def check_pieces(rows, texts: dict, most: int) -> int:
    """Pieces make up the documents and fill their sequences without gaps; the number of sequences."""
    by_key, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_key[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_key) == set(texts)
    for key, pieces in by_key.items():
        ids, at = np.append(plain(texts[key]), 0).astype("<u4"), 0
        for i, r in enumerate(sorted(pieces, key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (i, at) and (i == 0 or r["length"] == most)
            assert r["ids"] == ids[at : at + r["length"]].tobytes()
            at += r["length"]
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= most
    return len(by_sequence)


def test_documents_are_packed_well(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = dict(df.select("doc_id", "text").collect())
    rows = pack(df, Packing(PATH)).collect()
    used = check_pieces(rows, texts, 2048)
    assert used <= 1.02 * math.ceil(sum(r["length"] for r in rows) / 2048) + 1
    few = pack(df.repartition(3), Packing(PATH, sequence=100, open_bins=4, look_ahead=7)).collect()
    check_pieces(few, texts, 100)


def test_odd_rows_are_packed(spark):
    rows = [(1, None), (2, ""), (3, "a b c " * 5000), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(0) for c in ("piece", "ids", "offset")})
    check_pieces(pack(df, Packing(PATH)).collect(), dict(rows), 2048)
    assert pack(df.limit(0), Packing(PATH)).count() == 0
    twice = pack(df.union(df), Packing(PATH)).where("doc_id = 3").collect()
    by_row = defaultdict(list)
    for r in twice:
        by_row[r["row"]].append(r)
    assert len(by_row) == 2
    for pieces in by_row.values():
        check_pieces(pieces, {3: rows[2][1]}, 2048)


def test_sequences_hold_their_pieces_on_end(spark):
    df = spark.createDataFrame([(i, "abc " * (i % 50)) for i in range(100)], "doc_id long, text string")
    pieces = pack(df, Packing(PATH, sequence=64)).persist()
    joined = {r["sequence_id"]: r for r in sequences(pieces).collect()}
    for r in pieces.collect():
        s = joined[r["sequence_id"]]
        assert len(s["ids"]) == 4 * s["length"] <= 256
        assert s["ids"][4 * r["offset"] : 4 * (r["offset"] + r["length"])] == r["ids"]
    pieces.unpersist()


# --- store ----------------------------------------------------------------------------------------


def test_perfect_hash_numbers_every_key_once():
    for n in (0, 1, 2, 63, 64, 65, 5000):
        keys = np.arange(n) * 7 - 100
        hashes = token_store.key_hash(keys, np.zeros(n, np.int64), np.zeros(n, bool))
        table = token_store.PerfectHash.build(hashes)
        assert sorted(table.number(hashes).tolist()) == list(range(n))


def test_perfect_hash_with_keys_left_over(monkeypatch):
    monkeypatch.setattr(token_store, "_LEVELS", 1)
    hashes = token_store.key_hash(np.arange(1000), np.zeros(1000, np.int64), np.zeros(1000, bool))
    table = token_store.PerfectHash.build(hashes)
    assert len(table.rest) > 100 and sorted(table.number(hashes).tolist()) == list(range(1000))
    strangers = token_store.key_hash(np.arange(1000, 2000), np.zeros(1000, np.int64), np.zeros(1000, bool))
    assert (table.number(strangers) < 1000).all()


def test_store_round_trip(spark, tmp_path):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text", "doc_id", F.lit(1).alias("key"))
    folder = f"file://{tmp_path}/store"
    token_store.write_store(df.repartition(5), folder, PATH)
    found = {r["key"]: r for r in token_store.read_store(spark, folder).collect()}
    start = 0
    for key, text in sorted(df.select("doc_id", "text").collect()):
        ids = np.append(plain(text), 0).astype("<u4")
        assert (found[key]["start"], found[key]["n_tokens"], found[key]["ids"]) == (start, len(ids), ids.tobytes())
        start += len(ids)
    assert len(found) == df.count()
    payload = sum(p.stat().st_size for p in (tmp_path / "store").glob("*.ids"))
    assert payload == 2 * start
    shards = token_store.shard_list(folder)
    one = token_store.Shard(folder, shards[0]["name"])
    key = int(one.keys[0])
    assert one.get(key).tobytes() == found[key]["ids"]
    assert one.get(10**12) is None and one.get(None) is None and one.get(key, 1) is None
    for some in (key, int(one.keys[-1])):
        assert [x.tobytes() for x in token_store.lookup(folder, some)] == [found[some]["ids"]]
    assert token_store.lookup(folder, 10**12) == []


def test_store_with_odd_rows(spark, tmp_path):
    rows = [(5, "b"), (5, "b"), (5, "a"), (None, "n"), (None, None), (-3, ""), (7, "x y " * 40_000)]
    folder = f"file://{tmp_path}/store"
    token_store.write_store(spark.createDataFrame(rows, "doc_id int, text string"), folder, PATH)
    out = sorted(token_store.read_store(spark, folder).collect(), key=lambda r: r["start"])
    assert [r["key"] for r in out] == [None, None, -3, 5, 5, 5, 7]
    assert sum(r["n_tokens"] for r in out[:-1]) == out[-1]["start"]
    texts = sorted((-(10**9) if k is None else k, np.append(plain(t), 0).astype("<u4").tobytes()) for k, t in rows)
    assert texts == sorted((-(10**9) if r["key"] is None else r["key"], r["ids"]) for r in out)
    assert sorted(x.tobytes() for x in token_store.lookup(folder, 5)) == sorted(x for k, x in texts if k == 5)
    assert sorted(x.tobytes() for x in token_store.lookup(folder, None)) == sorted(x for k, x in texts if k == -(10**9))
    token_store.write_store(spark.createDataFrame([], "doc_id long, text string"), f"file://{tmp_path}/none", PATH)
    assert token_store.read_store(spark, f"file://{tmp_path}/none").count() == 0


def test_digests_of_the_registered_query(spark):
    from retailstrata.llm import queries

    texts = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: r["ids_crc32"] for r in queries.token_files(spark, SF_DIR).collect()}
    assert found == {k: zlib.crc32(np.append(plain(t), 0).astype("<u4").tobytes()) for k, t in texts}
