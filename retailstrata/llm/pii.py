"""Personal data in whole texts, also where it is written in disguise.

Plain identifiers are found by patterns in the text itself. A second pass looks for disguised ones:
transducers rewrite look-alike letters, spelled-out digits and words for "at" and "dot" (in English, French, German
and Spanish), keeping for each rewritten character the span of the source it came from; identifiers found in the
rewritten text are mapped back.
Every span is in code points of the source text, end exclusive.

Texts are judged one by one inside an Arrow UDF: no shuffle, memory follows the batch. All patterns run in
time proportional to the text, whatever it holds.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Span = tuple[str, int, int, bool]

# Kinds in the order in which spans with the same start are listed.
KINDS = ("email", "ip", "card", "phone")
SCHEMA = "array<struct<kind:string,start:int,end:int,base:boolean>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

# The patterns of plain identifiers. Possessive forms of the same languages, so that a long run
# of digits or letters is passed once.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def _luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[-1::-2]))) % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def plain_identifiers(text: str) -> Iterator[tuple[str, int, int]]:
    """Per kind the leftmost matches that don't overlap; those that fail its rule are dropped."""
    if "@" in text:
        yield from (("email", *span) for span in _emails(text))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(map(_byte, m[0].split("."))):
                yield "ip", *m.span()
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
                yield "card", *m.span()
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_digits(m[0])) <= 15:
                    yield "phone", *m.span()


# --- disguises ------------------------------------------------------------------------------------

# Letters of other scripts that look like Latin ones.
_LOOKALIKE = dict(
    zip(
        "аеорсухкмнтвіјѕԁһԛԝАВЕКМНОРСТХУІЈЅαενορτυχικΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
        "aeopcyxkmhtbijsdhqwABEKMHOPCTXYIJSaevoptuxikABEZHIKMNOPTYX",
        strict=True,
    )
)
# Invisible characters.
_INVISIBLE = dict.fromkeys("­​‌‍⁠﻿", "")
# The digits from zero on in English, French, German and Spanish, and other words for some of them.
_DIGIT_WORDS = {
    word: str(i)
    for words in (
        "zero one two three four five six seven eight nine",
        "zéro un deux trois quatre cinq six sept huit neuf",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
    )
    for i, word in enumerate(words.split())
} | {"oh": "0", "une": "1", "ein": "1", "zwo": "2", "fuenf": "5"}
_PLUS_WORDS = ("plus", "más", "mas")
_AT_WORDS = ("at", "ät", "arobase", "arobas", "arroba", "klammeraffe")
_DOT_WORDS = ("dot", "point", "punkt", "punto")


def _any_of(words: Iterable[str]) -> str:
    return "(?:" + "|".join(sorted(words, key=lambda w: (-len(w), w))) + ")"


_WORD, _PLUS, _AT_WORD, _DOT_WORD = map(_any_of, (_DIGIT_WORDS, _PLUS_WORDS, _AT_WORDS, _DOT_WORDS))
# No letter or digit before, and none after.
_FREE, _ENDS = r"(?<![^\W_])", r"(?![^\W\d_])"

_ODD_LETTER = re.compile("[" + "".join(_LOOKALIKE) + "".join(_INVISIBLE) + "！-～٠-٩۰-۹०-९]")
# A run of at least seven digits of which some are spelled, with an optional "plus" before it.
_SPELLED = re.compile(rf"(?i){_FREE}(?:(?:{_PLUS}|\+)[\x20-]?)?(?:(?:{_WORD}|[0-9]){_ENDS}[\x20-]{{0,2}}){{6,}}(?:{_WORD}|[0-9]){_ENDS}")
_SPELLED_GATE = re.compile(rf"(?i)(?<![^\W\d_]){_WORD}{_ENDS}[\x20-]{{0,2}}(?:{_WORD}{_ENDS}|[0-9])")
_DIGIT_OR_WORD = re.compile(rf"(?i){_PLUS}|{_WORD}|[0-9+]|[\x20-]+")
# A bracketed word, or the bare words for "at" and "dot" together.
_AT = rf"\x20{{0,2}}[(\[{{<]\x20?(?:{_AT_WORD}|@)\x20?[)\]}}>]\x20{{0,2}}"
_DOT = rf"\x20{{0,2}}[(\[{{<]\x20?(?:{_DOT_WORD}|\.)\x20?[)\]}}>]\x20{{0,2}}"
_BARE_DOT = rf"\x20{{1,2}}{_DOT_WORD}\x20{{1,2}}"
_LABEL = r"[A-Za-z0-9-]{1,63}+"
# Endings that the bare words are taken for an address with.
_ENDING = r"(?:com|org|net|edu|gov|info|biz|io|co|de|fr|es|uk|eu|ch|nl|mx|ar|example|test)(?![a-z0-9-])"
_DISGUISED = re.compile(
    rf"(?i)(?<=[a-z0-9._%+-])(?P<at>{_AT})(?P<domain>{_LABEL}(?:(?:{_DOT}|{_BARE_DOT}|\.){_LABEL})+)"
    rf"|(?<=[a-z0-9._%+-])(?P<bare>\x20{{1,2}}{_AT_WORD}\x20{{1,2}})(?P<spoken>{_LABEL}(?:(?:{_DOT}|{_BARE_DOT}){_LABEL})*(?:{_DOT}|{_BARE_DOT}){_ENDING})"
    rf"|(?<=[a-z0-9._%+-])@(?P<half>{_LABEL}(?:(?:{_DOT}|{_BARE_DOT}|\.){_LABEL})*(?:{_DOT}|{_BARE_DOT}){_ENDING})"
)
_ANY_DOT = re.compile(rf"(?i){_DOT}|{_BARE_DOT}")
_AT_GATE = re.compile(rf"(?i)[(\[{{<]\x20?(?:{_AT_WORD}|@|{_DOT_WORD}|\.)\x20?[)\]}}>]|\x20{_DOT_WORD}\x20")


class _Rewritten:
    """A text with, for every character, the source span it stands for."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.start = list(range(len(text)))
        self.end = list(range(1, len(text) + 1))
        self.changed = [False] * len(text)

    def replace(self, edits: Iterable[tuple[int, int, str]]) -> None:
        """Put new texts for the given spans; each new character stands for the whole span."""
        text, start, end, changed, done = [], [], [], [], 0
        for lo, hi, new in edits:
            text += [self.text[done:lo], new]
            start += self.start[done:lo] + [self.start[lo]] * len(new)
            end += self.end[done:lo] + [self.end[hi - 1]] * len(new)
            changed += self.changed[done:lo] + [True] * len(new)
            if not new and changed:
                changed[-1] = True
            done = hi
        if text:
            self.text = "".join(text) + self.text[done:]
            self.start, self.end = start + self.start[done:], end + self.end[done:]
            self.changed = changed + self.changed[done:]


def _letters(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _ODD_LETTER.finditer(text):
        c = m[0]
        if c in _INVISIBLE:
            new = ""
        elif "！" <= c <= "～":
            new = chr(ord(c) - 0xFEE0)
        else:
            new = _LOOKALIKE.get(c) or str(unicodedata.digit(c))
        yield m.start(), m.end(), new


def _spelled(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _SPELLED.finditer(text):
        first = True
        for part in _DIGIT_OR_WORD.finditer(text, m.start(), m.end()):
            word = part[0].lower()
            if word.strip(" -"):
                new = "+" if word == "+" or word in _PLUS_WORDS else _DIGIT_WORDS.get(word, word)
                if new != part[0]:
                    yield part.start(), part.end(), new
                first = False
            elif not first:
                yield part.start(), part.end(), ""


def _at_and_dot(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _DISGUISED.finditer(text):
        sign = "at" if m["at"] else "bare"
        if m[sign]:
            yield *m.span(sign), "@"
        domain = "domain" if m["domain"] else "spoken" if m["spoken"] else "half"
        for dot in _ANY_DOT.finditer(text, *m.span(domain)):
            yield *dot.span(), "."


def disguised_identifiers(text: str) -> list[tuple[str, int, int]]:
    """Source spans of identifiers that show only after rewriting."""
    gates = (_ODD_LETTER, _letters), (_AT_GATE, _at_and_dot), (_SPELLED_GATE, _spelled)
    form = None
    for gate, rewrite in gates:
        if gate.search(form.text if form else text):
            form = form or _Rewritten(text)
            form.replace(rewrite(form.text))
    if form is None or not any(form.changed):
        return []
    found = []
    for kind, start, end in plain_identifiers(form.text):
        if any(form.changed[start:end]):
            found.append((kind, form.start[start], max(form.end[start:end])))
    return found


def spans_of(text: str | None) -> list[Span]:
    """All spans by start, kind and end; plain ones are marked. A disguised one inside a plain one is not added."""
    if not text:
        return []
    plain = list(plain_identifiers(text))
    spans = [(*s, True) for s in plain]
    for kind, start, end in disguised_identifiers(text):
        if not any(lo <= start and end <= hi for _, lo, hi in plain):
            spans.append((kind, start, end, False))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def masked(text: str | None, template: str = "[{}]") -> str | None:
    """The text with every span replaced by its kind; overlapping spans become one of the first kind."""
    spans = spans_of(text)
    if not spans:
        return text
    out, done, i = [], 0, 0
    while i < len(spans):
        kind, start, end, _ = spans[i]
        while i + 1 < len(spans) and spans[i + 1][1] < end:
            i += 1
            end = max(end, spans[i][2])
        out += [text[done:start], template.format(kind.upper())]
        done = end
        i += 1
    return "".join(out) + text[done:]


def find_pii(text: Column) -> Column:
    """Array of (kind, start, end, base), ordered by start, then kind as listed in ``KINDS``, then end.

    ``base`` is false for spans found only through a disguise. Null and empty texts give an empty array.
    """

    @F.arrow_udf(SCHEMA)
    def find(texts: pa.Array) -> pa.Array:
        return pa.array([spans_of(t.as_py()) for t in texts], _ARROW)

    return find(text)


def mask_pii(df: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """Every row with its identifiers replaced by ``[EMAIL]``, ``[IP]``, ``[CARD]`` or ``[PHONE]``.

    Null texts stay null. The column ``n_chars``, where there is one, is set to the new length of the text.
    """

    @F.arrow_udf("string")
    def mask(texts: pa.Array) -> pa.Array:
        return pa.array([masked(t.as_py()) for t in texts], pa.string())

    out = df.withColumn(text, mask(df[f"`{text}`"]))
    if n_chars in df.columns:
        kind = df.schema[n_chars].dataType
        out = out.withColumn(n_chars, F.char_length(F.col(f"`{text}`")).cast(kind))
    return out
