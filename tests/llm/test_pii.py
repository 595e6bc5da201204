"""Plain identifiers against their patterns, disguised ones by example, and masking."""

from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from retailstrata.llm.pii import KINDS, find_pii, mask_pii, masked, spans_of

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def brute(text: str) -> list:
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def test_plain_identifiers_equal_the_patterns():
    rng = random.Random(2)
    parts = ["a", "B", "@", "@", ".", ".", "1", "2", "55", "+1", "-", " ", "é", "4111 1111 1111 1111", "+1 (464) 555-9887", "255.1.", "%", "(", ")", "256", "٣"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert [s[:3] for s in spans_of(text) if s[3]] == brute(text), text


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("to john.doe (at) example (dot) com now", "email", "john.doe (at) example (dot) com"),
        ("to j [at] mail.example.org.", "email", "j [at] mail.example.org"),
        ("john at mail dot example dot org!", "email", "john at mail dot example dot org"),
        ("mail j@b dot com please", "email", "j@b dot com"),
        ("je suis jоhn@exаmple.com ici", "email", "jоhn@exаmple.com"),
        ("ＪＯ＠ｅｘ．ｃｏｍ", "email", "ＪＯ＠ｅｘ．ｃｏｍ"),
        ("x sp\u200bam@ex.com", "email", "sp\u200bam@ex.com"),
        ("call plus one five five five one two three four five six seven", "phone", "plus one five five five one two three four five six seven"),
        ("card four one one one 1111 1111 one one one one ok", "card", "four one one one 1111 1111 one one one one"),
        ("host １２７.0.0.1", "ip", "１２７.0.0.1"),
        ("tel plus un deux trois quatre cinq six sept huit neuf zéro fin", "phone", "plus un deux trois quatre cinq six sept huit neuf zéro"),
        ("Tel. plus vier neun drei null fünf sechs sieben acht eins zwo", "phone", "plus vier neun drei null fünf sechs sieben acht eins zwo"),
        ("más tres cuatro seis cero cero uno dos tres nueve ocho.", "phone", "más tres cuatro seis cero cero uno dos tres nueve ocho"),
        ("john arroba example punto com", "email", "john arroba example punto com"),
        ("jean [arobase] exemple [point] fr", "email", "jean [arobase] exemple [point] fr"),
        ("hans (ät) mail.beispiel (Punkt) de", "email", "hans (ät) mail.beispiel (Punkt) de"),
    ],
)
def test_disguises(text, kind, found):
    added = [(k, text[lo:hi]) for k, lo, hi, base in spans_of(text) if not base]
    assert (kind, found) in added


@pytest.mark.parametrize(
    "text",
    ["look at this dot here", "the cat at home", "one two three", "слово и дело", "Ελληνικά", "", None, "at dot at dot", "one two three four five six seven eight nine", "point final et arroba", "un deux trois quatre cinq six sept huit",
     "au point de vue arobase", "el punto es, arroba y punto com", "unun deuxx", "eins zwei drei vier fünf sechs sieben acht neun null"],
)
def test_plain_prose_has_no_identifiers(text):
    assert spans_of(text) == []


WORDS = {
    "en": ("zero one two three four five six seven eight nine", "plus", "at", "dot"),
    "fr": ("zéro un deux trois quatre cinq six sept huit neuf", "plus", "arobase", "point"),
    "de": ("null eins zwei drei vier fünf sechs sieben acht neun", "plus", "at", "punkt"),
    "es": ("cero uno dos tres cuatro cinco seis siete ocho nueve", "más", "arroba", "punto"),
}


@pytest.mark.parametrize("lang", WORDS)
def test_most_disguises_of_a_corpus_are_found_and_prose_is_left_alone(spark, lang):
    """Texts with one identifier each in a disguise drawn at random, and texts with the same words and none."""
    rng = random.Random(lang)
    digits, plus, at, dot = WORDS[lang]
    digits = digits.split()

    def prose(n):
        return " ".join(rng.choice(["lorem", "ipsum", "dolor,", "amet.", "Sit", digits[rng.randint(0, 9)], dot, at, "12"]) + rng.choice(["", "", " und"]) for _ in range(n))

    def spell(number):
        return rng.choice([" ", "-", " "]).join(digits[int(d)] if rng.random() < 0.7 else d for d in number)

    def disguised(kind):
        if kind == "email":
            name, host = rng.choice(["john.doe", "a_b", "m.muster"]), rng.choice(["example", "mail.example", "my-host"])
            way = rng.randint(0, 4)
            if way == 0:
                return f"{name} ({at}) {host}.com"
            if way == 1:
                return f"{name} [{at}] {host} [{dot}] org"
            if way == 2:
                return f"{name} {at} {host.replace('.', f' {dot} ')} {dot} com"
            if way == 3:
                return f"{name}@{host} {dot} net"
            return f"{name}@{host}.com".replace("o", "о").replace("e", "е")
        if kind == "phone":
            return f"{plus} " + spell(rng.choice("123456789") + "".join(rng.choice("0123456789") for _ in range(rng.randint(9, 12))))
        number = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        last = next(d for d in "0123456789" if luhn(number + d))
        return spell(number + last)

    kinds = [rng.choice(["email", "phone", "card"]) for _ in range(300)]
    texts = [(f"{prose(8)} ; {d} ; {prose(8)}", d) for d in map(disguised, kinds)]
    rows = [(i, t) for i, (t, _) in enumerate(texts)] + [(1000 + i, prose(16)) for i in range(300)]
    found = {r["i"]: r["s"] for r in spark.createDataFrame(rows, "i int, t string").select("i", find_pii(F.col("t")).alias("s")).collect()}
    hits = 0
    for i, (text, d) in enumerate(texts):
        spans = {(s["kind"], text[s["start"] : s["end"]].strip()) for s in found[i]}
        hits += any(k == kinds[i] and x.endswith(d) and len(x) <= len(d) + 12 for k, x in spans)
    assert hits >= 0.95 * len(texts)
    assert sum(bool(found[1000 + i]) for i in range(300)) <= 3


def test_time_follows_length():
    start = time.perf_counter()
    for part in ("1", "a", "1.", "+1", "one ", "1 ", "a(at)b", "b dot ", "-", "@", "a@", "+", "."):
        spans_of(part * (200_000 // len(part)) + "@ dot (at)")
    assert time.perf_counter() - start < 60


def test_masking():
    assert masked("a é b@c.de 1.2.3.4 x") == "a é [EMAIL] [IP] x"
    assert masked("sp\u200bam@ex.com") == "[EMAIL]"
    assert masked(None) is None and masked("") == ""


def test_spans_and_masked_rows_in_spark(spark):
    rows = [(1, "b@c.de", 9), (1, "b@c.de", 9), (2, None, None), (3, "", 0), (None, "é b@c.de", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars int").withColumn("spans", F.lit("old"))
    found = df.select("doc_id", find_pii(F.col("text")).alias("found")).collect()
    assert [[tuple(s) for s in r["found"]] for r in found] == [[("email", 0, 6, True)]] * 2 + [[], [], [("email", 2, 8, True)]]
    out = mask_pii(df)
    assert out.dtypes == df.dtypes
    assert [tuple(r)[:3] for r in out.collect()] == [(1, "[EMAIL]", 7), (1, "[EMAIL]", 7), (2, None, None), (3, "", 0), (None, "é [EMAIL]", 9)]
    assert mask_pii(df.limit(0)).count() == 0
    assert mask_pii(df.drop("n_chars")).columns == ["doc_id", "text", "spans"]
