"""URL filters: pattern rules, each found by its rarest literal token; only fetched rules run their regular expression."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from classweave.llm.frames import columns, free_name

#: Rule sets up to this many rules are broadcast; the index of a larger one is joined by a shuffle.
BROADCAST_RULES = 100_000

_TOKEN = "[0-9a-z]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A pattern over host followed by path, in lower case, with the literal tokens that every match contains whole.

    `name` is None for a pattern that gives a verdict only where no named rule fits. Of several named rules that fit,
    the one of the greatest `weight` holds, then the one whose name sorts first.
    """

    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    name: str | None = None
    weight: int = 0


def prefix_rule(verdict: str, name: str) -> Rule:
    """A rule like `example.com/en/`: its host and all subdomains, and paths that start with its path; longer ones win."""
    host, slash, path = name.partition("/")
    path = slash + path
    # A path may stop inside a token of the URL, so its last token counts only if something ends it.
    literal = f"{host}{path if re.search('[^0-9a-z]$', path) else path.rpartition('/')[0] + '/'}"
    return Rule(rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}", tuple(re.findall(_TOKEN, literal.lower())), verdict, name, len(name))


def word_rule(verdict: str, *words: str) -> Rule:
    """A pattern for these words next to each other in the host, each whole."""
    body = "[-.]".join(map(re.escape, words))
    return Rule(rf"^(?:[^/]*[-.])?{body}(?:[-.][^/]*)?(?:/|$)", tuple(words), verdict)


# The agreed rules.
NAMED_RULES = (
    prefix_rule("allow", "com/"),
    prefix_rule("block", "example.com/en/"),
    prefix_rule("allow", "www.example.com/en/"),
    prefix_rule("block", "net/es/"),
    prefix_rule("block", "net/fr/"),
)
#: Hosts that name what they sell or do; what a filter for training text leaves out.
WORD_RULES = tuple(
    word_rule("block", *words)
    for words in (
        ("casino",), ("poker",), ("free", "bets"), ("betting",), ("jackpot",), ("slots",),
        ("adult",), ("porn",), ("xxx",), ("escort",),
        ("cheap", "pills"), ("viagra",), ("payday", "loans"),
        ("spam", "farm"), ("link", "farm"), ("ads", "track"), ("adserver",), ("tracker",), ("malware",), ("warez",),
    )
)
RULES = NAMED_RULES + WORD_RULES


def host_of(url: Column) -> Column:
    """What stands after the first :// up to / ? # or the end, A-Z lower-cased; empty for null or without ://."""
    rest = F.substring_index(_after_scheme(url), "/", 1)
    rest = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return F.translate(rest, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end; empty for null or without ://."""
    rest = F.substring_index(F.substring_index(_after_scheme(url), "?", 1), "#", 1)
    slash = F.instr(rest, "/")
    return F.when(slash > 0, F.substring(rest, slash, F.length(rest))).otherwise("")


def _after_scheme(url: Column) -> Column:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _tokens(target: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.translate(target, _UPPER, _LOWER), F.lit(_TOKEN), F.lit(0)))


def rule_index(urls: DataFrame, target: str, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with its rarest literal token: the one that the fewest of these URLs contain, then the first.

    Only tokens of rules are counted, combined within each task, so the counts are as few as those tokens.
    """
    spark = urls.sparkSession
    schema = "rule int, pattern string, verdict string, name string, weight int, tokens array<string>"
    listed = spark.createDataFrame([(i, r.pattern, r.verdict, r.name, r.weight, list(r.tokens)) for i, r in enumerate(rules)], T._parse_datatype_string(schema))
    wanted = sorted({t for r in rules for t in r.tokens})
    tokens = _small(spark.createDataFrame([(t,) for t in wanted], "token string"), len(wanted))
    counts = urls.select(F.explode(_tokens(F.col(target))).alias("token")).join(tokens, "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    each = listed.select("rule", "pattern", "verdict", "name", "weight", F.explode("tokens").alias("token")).join(counts, "token", "left")
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)), F.col("token")))["token"]
    return each.groupBy("rule", "pattern", "verdict", "name", "weight").agg(rarest.alias("token"))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_RULES else df


def filter_urls(pages: DataFrame, url_col: str = "url", rules: Sequence[Rule] = RULES, default: str = "allow") -> DataFrame:
    """All columns of `pages`, and behind them host, path, rule and verdict (underscores appended where `pages` has the name).

    Distinct URLs are split into tokens; each token fetches the rules that it indexes, and only those run their regular
    expression over host and path. `rule` is the named rule that holds, else null. The verdict is that rule's; else block
    if a pattern fits that blocks; else `default`. A null or empty URL, or one without ://, has an empty host and path,
    fits no rule and gets `default`. Repeated URLs are judged once and joined back; equal rows stay as many as they are.
    """
    names = {n: free_name(pages.columns, n) for n in ("host", "path", "rule", "verdict")}
    no_tokens = [r for r in rules if not r.tokens]
    if no_tokens:
        raise ValueError(f"a rule needs a literal token: {no_tokens[0]}")
    parts = pages.withColumn(names["host"], host_of(F.col(url_col))).withColumn(names["path"], path_of(F.col(url_col)))
    key, found, decided = (free_name(parts.columns, n) for n in ("_target", "_found", "_verdict"))
    parts = parts.withColumn(key, F.concat(names["host"], names["path"]))
    if not rules:
        return parts.drop(key).withColumn(names["rule"], F.lit(None).cast("string")).withColumn(names["verdict"], F.lit(default))
    targets = parts.select(F.col(key).alias("target")).where("target != ''").distinct()
    index = _small(rule_index(targets, "target", rules), len(rules))
    fetched = targets.select("target", F.explode(_tokens(F.col("target"))).alias("token")).join(index, "token")
    fits = fetched.where(F.expr("regexp_like(target, pattern)"))
    best = F.min(F.when(F.col("name").isNotNull(), F.struct((-F.col("weight")).alias("w"), F.col("name").alias("name"), F.col("verdict").alias("verdict"))))
    blocked = F.max(F.col("name").isNull() & (F.col("verdict") == "block"))
    judged = fits.groupBy("target").agg(best.alias("best"), blocked.alias("blocked"))
    judged = judged.select(
        F.col("target").alias(found), F.col("best.name").alias(names["rule"]),
        F.coalesce("best.verdict", F.when(F.col("blocked"), "block"), F.lit(default)).alias(decided),
    )
    out = parts.join(judged, F.col(key) == F.col(found), "left")
    return out.select(*columns(pages.columns), names["host"], names["path"], names["rule"], F.coalesce(decided, F.lit(default)).alias(names["verdict"]))
