"""URL filters: pattern rules found through their rarest literal token.

A rule is a regular expression; the literal tokens that every fitting url holds follow from it. Each rule
is filed under the one of its tokens that is rarest in the urls at hand; a url fetches the rules filed
under its own tokens, and only those are run. Built-in expressions only.

Regular expressions see ``host + path`` of a url: the host is what stands between the first ``://`` and the
next ``/``, ``?``, ``#`` or the end, in lower case (A-Z), the path what follows it up to ``?``, ``#`` or the end.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from re import _parser  # the parse tree of a pattern; tests hold it against the library's matching

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
TARGET = "__target"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The index is broadcast up to this size; a longer list of rules is joined by shuffling the tokens.
BROADCAST_BYTES = 32 << 20


_SEPARATOR, _ANY = "separator", "any"


def _items(parsed, lowered: bool) -> list[str]:
    """What every text that a parsed pattern fits holds in order: characters, places between tokens, and what is unknown."""
    out: list[str] = []
    for kind, value in parsed:
        name = str(kind)
        if name == "LITERAL":
            out.append(chr(value).translate(str.maketrans(UPPER, LOWER)))
        elif name == "AT":
            out.append(_SEPARATOR if str(value) in ("AT_BEGINNING", "AT_BEGINNING_STRING", "AT_END_STRING", "AT_END") else _ANY)
        elif name == "IN":
            out.append(_SEPARATOR if _no_token_character(value, lowered) else _ANY)
        elif name == "SUBPATTERN":
            out += _items(value[3], lowered)
        elif name == "BRANCH":
            out.append(_SEPARATOR if all(_between(_items(x, lowered)) for x in value[1]) else _ANY)
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            least, _, inner = value
            repeated = _items(inner, lowered)
            ends = bool(repeated) and _is_separator(repeated[-1])
            # Left out, it leaves what stands before it.
            out.append(_SEPARATOR if ends and (least > 0 or (out and _is_separator(out[-1]))) else _ANY)
        else:
            out.append(_ANY)
    return out


def _is_separator(item: str) -> bool:
    return item == _SEPARATOR or (len(item) == 1 and not re.fullmatch("[a-z0-9]", item))


def _between(items: list[str]) -> bool:
    return bool(items) and all(map(_is_separator, items))


def _no_token_character(chosen, lowered: bool) -> bool:
    """Whether a class holds no letter of a-z, in either case (``lowered``: there are no others), and no digit."""
    negated = bool(chosen) and str(chosen[0][0]) == "NEGATE"
    there: set[str] = set()
    for kind, value in chosen[negated:]:
        if str(kind) == "LITERAL":
            there.add(chr(value))
        elif str(kind) == "RANGE":
            there.update(chr(c) for c in range(value[0], min(value[1], 127) + 1))
        else:
            return False
    tokens = set(LOWER + "0123456789" + ("" if lowered else UPPER))
    return tokens <= there if negated else not tokens & there


def literals_of(pattern: str, lowered: bool = True) -> tuple[str, ...]:
    """Tokens (runs of a-z and 0-9) that every fitting url, ``lowered`` or not, holds whole, as the pattern itself tells.

    The pattern is parsed, not searched: alternatives, options and classes give no literal, and a run of characters that
    may go on in the url is none either.
    """
    items = [_ANY, *_items(_parser.parse(pattern), lowered), _ANY]
    found, run, whole = [], "", False
    for before, item in zip(items, items[1:]):
        if len(item) == 1 and not _is_separator(item):
            whole = _is_separator(before) if not run else whole
            run += item
        else:
            if run and whole and _is_separator(item):
                found.append(run)
            run = ""
    return tuple(dict.fromkeys(found))


@dataclass(frozen=True)
class Rule:
    """``text`` names a site rule and is reported; a pattern rule has none and only gives a verdict.

    ``literals`` are taken from the pattern. Given ones must be among those, or the rule could be missed.
    """

    pattern: str
    literals: tuple[str, ...] | None = None
    verdict: str = "block"
    text: str | None = None

    def __post_init__(self) -> None:
        if self.verdict not in (ALLOW, BLOCK):
            raise ValueError(f"not a verdict: {self.verdict!r}")
        own = literals_of(self.pattern, self.text is None)
        if self.literals is None:
            object.__setattr__(self, "literals", own)
        elif not set(self.literals) <= set(own):
            raise ValueError(f"{self.pattern!r} does not need {sorted(set(self.literals) - set(own))}")


def _escaped(text: str) -> str:
    return "".join(c if c.isalnum() or c in "/_" else f"[{c}]" if c not in "^\\[]" else "\\" + c for c in text)


def _lowered(text: str) -> str:
    return text.translate(str.maketrans(UPPER, LOWER))


def site_rule(host: str, path: str, verdict: str) -> Rule:
    """Fits the host, in any case, and all its subdomains where the path starts with ``path``."""
    return Rule(f"^(?:[^/]*[.])?{_escaped(_lowered(host) + path)}", None, verdict, _lowered(host) + path)


def word_rule(word: str, verdict: str = BLOCK) -> Rule:
    """Fits a url that has the word, or words with signs between, in any case between separators."""
    if not re.search("[A-Za-z0-9]", word):
        raise ValueError(f"no letter or digit in {word!r}")
    return Rule(f"(?:^|[^a-z0-9]){_escaped(_lowered(word))}(?:[^a-z0-9]|$)", None, verdict)


def parse_rules(lines: Iterable[str]) -> list[Rule]:
    """Rules of a list, one a line: ``allow`` or ``block``, then a site as host and path, ``word`` and a word, or
    ``pattern`` and a regular expression over the lower-cased host and path. Empty lines and those after ``#`` are none.
    """
    out = []
    for number, line in enumerate(lines, 1):
        parts = line.strip().split(None, 2)
        if not parts or parts[0].startswith("#"):
            continue
        try:
            if len(parts) == 3 and parts[1] == "word":
                out.append(word_rule(parts[2], parts[0]))
            elif len(parts) == 3 and parts[1] == "pattern":
                out.append(Rule(parts[2], None, parts[0]))
            elif len(parts) == 2 and "/" in parts[1]:
                host, path = parts[1].split("/", 1)
                out.append(site_rule(host, f"/{path}", parts[0]))
            else:
                raise ValueError("neither a site with a path, nor a word or pattern")
        except (ValueError, re.error) as error:
            raise ValueError(f"line {number}, {line.strip()!r}: {error}") from None
    return out


def read_rules(spark: SparkSession, path: str) -> list[Rule]:
    """Rules of a text file at any path that Spark reads, in the form of ``parse_rules``."""
    whole = spark.read.option("wholetext", "true").text(path)
    return parse_rules("\n".join(r["value"] for r in whole.collect()).split("\n"))


SITE_RULES = (
    site_rule("com", "/", ALLOW),
    site_rule("example.com", "/en/", BLOCK),
    site_rule("www.example.com", "/en/", ALLOW),
    site_rule("net", "/es/", BLOCK),
    site_rule("net", "/fr/", BLOCK),
)
WORD_RULES = tuple(map(word_rule, ("casino", "porn", "xxx", "viagra", "warez", "torrent", "malware", "phishing")))
DEFAULT_RULES = SITE_RULES + WORD_RULES


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null url and for one without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def url_tokens(target: Column) -> Column:
    """Distinct runs of a-z and 0-9, and the empty token, under which rules without literals are filed."""
    return F.array_union(F.split(F.translate(target, UPPER, LOWER), "[^a-z0-9]+"), F.array(F.lit("")))


def _small(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    size = sum(len(r.pattern) + sum(map(len, r.literals)) + 64 for r in rules)
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def _rarest(targets: DataFrame, rules: Sequence[Rule]) -> list[tuple[str, int]]:
    """Token and number of each rule. What is collected is one count for each literal of the rules."""
    spark = targets.sparkSession
    literals = sorted({t for r in rules for t in r.literals})
    if not literals:
        return [("", i) for i in range(len(rules))]
    known = _small(spark.createDataFrame([(t,) for t in literals], "token string"), rules)
    found = targets.select(F.explode(url_tokens(F.col(TARGET))).alias("token"))
    counts = dict(found.join(known, "token").groupBy("token").count().collect())
    return [(min(r.literals, key=lambda t: (counts.get(t, 0), t), default=""), i) for i, r in enumerate(rules)]


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES, url: str = "url") -> DataFrame:
    """Every row with ``host``, ``path``, ``rule`` and ``verdict`` added.

    Among fitting site rules the longest wins; ``rule`` is its text. Without one ``rule`` is null and the
    verdict is ``block`` if a pattern rule that blocks fits, else ``allow``. A url that is null or has no ``://``
    has empty host and path, and only rules that fit the empty text apply. Repeated rows and urls stay
    as they are. Columns of these names that the input has already are replaced.
    """
    host, path = host_and_path(F.col(f"`{url}`"))
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    rows = pages.select(*[F.col(f"`{c}`") for c in kept], host.alias("host"), path.alias("path"))
    if not rules:
        return rows.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(ALLOW)})
    rows = rows.withColumn(TARGET, F.concat("host", "path"))
    targets = rows.select(TARGET)
    filed = [(t, i, rules[i].pattern, rules[i].text, rules[i].verdict) for t, i in _rarest(targets, rules)]
    index = rows.sparkSession.createDataFrame(filed, "token string, number int, pattern string, text string, rule_verdict string")
    candidates = targets.select(TARGET, F.explode(url_tokens(F.col(TARGET))).alias("token")).join(_small(index, rules), "token")
    lowered = F.translate(TARGET, UPPER, LOWER)
    fits = F.rlike(F.when(F.col("text").isNotNull(), F.col(TARGET)).otherwise(lowered), F.col("pattern"))
    order = F.struct(
        F.col("text").isNotNull().alias("site"),
        F.coalesce(F.length("text"), F.lit(0)).alias("length"),
        (F.col("rule_verdict") == BLOCK).alias("blocks"),
        F.col("text"),
        F.col("rule_verdict"),
    )
    best = candidates.where(fits).groupBy(TARGET).agg(F.max(order).alias("__best"))
    return (
        rows.join(best, TARGET, "left")
        .withColumns({"rule": F.col("__best.text"), "verdict": F.coalesce("__best.rule_verdict", F.lit(ALLOW))})
        .drop("__best", TARGET)
    )


def oracle(site: Sequence[Rule] = SITE_RULES, words: Sequence[Rule] = WORD_RULES) -> str:
    """The same for the columns of ``pages`` in DuckDB's dialect."""

    def quote(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    longest = sorted(site, key=lambda r: -len(r.text or ""))
    fits = [f"regexp_matches(target, {quote(r.pattern)})" for r in longest]
    rule = " ".join(f"WHEN {f} THEN {quote(r.text or '')}" for f, r in zip(fits, longest))
    verdict = " ".join(f"WHEN {f} THEN {quote(r.verdict)}" for f, r in zip(fits, longest))
    blocked = " OR ".join(f"regexp_matches(low, {quote(r.pattern)})" for r in words) or "false"
    return f"""WITH rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
parts AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rest),
targets AS (SELECT *, host || path AS target, translate(host || path, '{UPPER}', '{LOWER}') AS low FROM parts)
SELECT page_id, host, path, CASE {rule} END AS "rule", CASE {verdict} WHEN {blocked} THEN 'block' ELSE 'allow' END AS verdict
FROM targets"""
