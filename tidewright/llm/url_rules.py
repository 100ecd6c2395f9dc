"""URL filters: host and path rules, and pattern rules indexed by their rarest literal token.

Each pattern rule lists literal tokens that every URL it matches holds. The rule is filed under the one that is rarest among the
URLs at hand; a URL's own tokens fetch the rules filed under them, and only those run their regular expressions. Everything is
DataFrame functions within a row: no shuffle, so no host is too large. The index is one literal, as large as the list of rules, with an array
of places by the tokens' CRC-32: a lookup doesn't depend on how many rules there are. Rules may come from a table (pattern_rules), of MOST_RULES rows
at most; more are an error, as the index travels with the plan.

Of host rules the longest that fits wins; host and path together name a rule, so two of equal length that both fit are the same one. Very long
URLs are whole: their tokens are distinct ones.

Host and path: a null URL, or one without ://, has neither. Such a URL gets the method's default, allow. Rows that repeat give
equal rows; columns beside page_id and url are ignored; an empty table gives an empty table (each rule then goes under its first token).
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class HostRule:
    """Fits a host and its subdomains, and paths that start with path. The longest that fits wins."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class PatternRule:
    """A regular expression on the lower-cased URL; tokens: literals, of a-z and 0-9, that stand in each URL it matches."""

    name: str
    pattern: str
    tokens: tuple[str, ...]


HOST_RULES = (
    HostRule("com", "/", "allow"),
    HostRule("example.com", "/en/", "block"),
    HostRule("www.example.com", "/en/", "allow"),
    HostRule("net", "/es/", "block"),
    HostRule("net", "/fr/", "block"),
)
#: Words that as a whole part of a host tell what it sells.
HOST_WORDS = ("casino", "poker", "jackpot", "lottery", "betting", "pills", "payday", "replica", "escort", "adult", "xxx", "warez", "torrent", "keygen", "crack")
PATTERN_RULES = (
    PatternRule("spam farms", r"://([^/?#]*\.)?spam-farm\.", ("spam", "farm")),
    PatternRule("pill shops", r"://([^/?#]*\.)?cheap-pills\.", ("cheap", "pills")),
    PatternRule("betting", r"://([^/?#]*\.)?free-bets\.", ("free", "bets")),
    *(PatternRule(f"hosts with {word}", rf"://([^/?#]*[.-])?{word}[.-]", (word,)) for word in HOST_WORDS),
    PatternRule("sign-in pages", r"://[^/?#]*/(user|account)/login\b", ("login",)),
    PatternRule("calendars", r"/calendar/[0-9]{4}/[0-9]{2}/", ("calendar",)),
)
#: Pattern rules at most.
MOST_RULES = 100_000


def pattern_rules(table: DataFrame) -> list[PatternRule]:
    """Rules from a table (name, pattern, tokens array<string>), in order of their names. Rows with a null, or without a token, are an error."""
    rows = table.select("name", "pattern", "tokens").limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} pattern rules")
    if any(r["name"] is None or r["pattern"] is None or not r["tokens"] for r in rows):
        raise ValueError("a pattern rule lacks its name, pattern or tokens")
    return sorted((PatternRule(r["name"], r["pattern"], tuple(r["tokens"])) for r in rows), key=lambda r: r.name)


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    whole = F.coalesce(F.col(url), F.lit(""))
    host = F.translate(F.regexp_extract(whole, _URL, 1), _UPPER, _LOWER)
    return host, F.regexp_extract(whole, _URL, 2)


def tokens(url: str = "url") -> Column:
    """The distinct literal tokens of a URL, ASCII and lower case."""
    lowered = F.translate(F.coalesce(F.col(url), F.lit("")), _UPPER, _LOWER)
    return F.array_distinct(F.array_remove(F.split(lowered, "[^a-z0-9]+"), ""))


def host_verdict(rules: Sequence[HostRule] = HOST_RULES) -> tuple[Column, Column]:
    """The name and the verdict of the longest rule that fits columns host and path; null if none does."""
    name = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def token_counts(urls: DataFrame, wanted: Sequence[str]) -> dict[str, int]:
    """How many rows hold each wanted token; one row per wanted token comes to the driver."""
    found = urls.select(F.explode(tokens()).alias("token")).where(F.col("token").isin(list(wanted))).groupBy("token").count()
    return {r["token"]: r["count"] for r in found.collect()}


def index_rules(rules: Sequence[PatternRule], counts: dict[str, int]) -> dict[str, list[PatternRule]]:
    """The rules by their rarest token; the first at equal counts."""
    index: dict[str, list[PatternRule]] = {}
    for r in rules:
        index.setdefault(min(r.tokens, key=lambda t: counts.get(t, 0)), []).append(r)
    return index


def candidates(index: dict[str, list[PatternRule]]) -> Column:
    """The rules (name, pattern) that the tokens in column url_tokens fetch.

    The index is parsed once, when the plan is made: places by CRC-32 of a token, each with the few tokens that share it.
    """
    places: list[list[dict]] = [[] for _ in range(2 * len(index) + 1)]
    for token, rules in index.items():
        places[zlib.crc32(token.encode()) % len(places)].append({"token": token, "rules": [{"name": r.name, "pattern": r.pattern} for r in rules]})
    kind = "array<array<struct<token:string,rules:array<struct<name:string,pattern:string>>>>>"
    filed = F.from_json(F.lit(json.dumps(places)), kind)
    fetched = F.transform("url_tokens", lambda t: F.filter(F.get(filed, F.pmod(F.crc32(t.cast("binary")), F.lit(len(places))).cast("int")), lambda e: e["token"] == t))
    return F.flatten(F.transform(F.flatten(fetched), lambda e: e["rules"]))


def pattern_hits() -> Column:
    """The names of the rules in column fetched that match column url."""
    lowered = F.translate(F.coalesce(F.col("url"), F.lit("")), _UPPER, _LOWER)
    return F.transform(F.filter("fetched", lambda r: F.rlike(lowered, r["pattern"])), lambda r: r["name"])


def judge(pages: DataFrame, host_rules: Sequence[HostRule] = HOST_RULES, pattern_rules: Sequence[PatternRule] = PATTERN_RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, hits and n_candidates (rules whose regular expression ran): a host rule decides; where none fits, a page that a
    pattern rule hits is blocked."""
    urls = pages.select("page_id", "url")
    wanted = sorted({t for r in pattern_rules for t in r.tokens})
    index = index_rules(pattern_rules, token_counts(urls, wanted) if wanted else {})
    host, path = host_and_path()
    df = urls.select("page_id", "url", host.alias("host"), path.alias("path"), tokens().alias("url_tokens"))
    name, verdict = host_verdict(host_rules)
    fetched = candidates(index) if index else F.expr("cast(array() as array<struct<name:string,pattern:string>>)")
    df = df.select("page_id", "url", "host", "path", name.alias("rule"), verdict.alias("ruled"), fetched.alias("fetched"))
    df = df.select("page_id", "host", "path", "rule", "ruled", F.size("fetched").alias("n_candidates"), pattern_hits().alias("hits"))
    return df.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.size("hits") > 0, "block").otherwise("allow")).alias("verdict"), "hits", "n_candidates")
