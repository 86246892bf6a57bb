"""URL filter by explicit rules and by association rules mined from labelled URLs.

A URL is a set of tokens: each label of its host with its distance from the end, each segment of its path (numbers are one token), its file
ending, each part of its query, and whether it has a fragment. The longest explicit rule (host and path prefix) that fits decides. The URLs
that some explicit rule fits are also the labelled examples. Their token sets, each with its label and one for each page, are mined by FP-growth;
combinations of up to ``MAX_TOKENS`` tokens that come with a label often enough (``MIN_SUPPORT``, ``MIN_CONFIDENCE``) become rules, and
those to which a part of their tokens gives the same label with at least their confidence are pruned.

A URL without an explicit rule gets the label of the mined rule that fits with the highest confidence (then support, then fewer tokens, then by name);
without any, ``DEFAULT``. The rules stand in an inverted index: each token counts towards the rules that need it, and a rule fits when all of its tokens were met.

For mining, a URL has its ``MINED_TOKENS`` most telling tokens, by how far the share of labels with the token is from the share overall; so a set of
tokens has a bounded number of combinations, and the rules are at most that number divided by ``MIN_SUPPORT``, however many rows there
are. Matching uses all tokens. A repeated URL, or a pattern of which only the numbers differ, counts once for each of its pages.

Defined cases: a null URL or one without ``://`` has an empty host and path and the one token ``none``; without labelled URLs no rule is mined and ``DEFAULT``
decides; a URL that explicit rules of equal length fit gets the first of them by name; repeated rows are judged each; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from itertools import combinations

import pandas as pd
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
DEFAULT = "allow"
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.8
MAX_TOKENS = 3
MINED_TOKENS = 12
_LABEL = "label="
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(text: Column) -> Column:
    return F.translate(text, _CAPITALS, _CAPITALS.lower())


def _rest(url: Column) -> Column:
    """What follows the first ``://``, empty without it."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    rest = _rest(url)
    return _lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def url_tokens(url: Column) -> Column:
    host, path = url_parts(url)
    rest = _rest(url)
    labels = F.filter(F.reverse(F.split(host, r"\.")), lambda x: x != "")
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    plain = F.transform(segments, lambda x: F.regexp_replace(_lower(x), r"\.[a-z0-9]{1,8}$", ""))
    named = F.transform(plain, lambda x, i: F.concat(F.lit("path"), i.cast("string"), F.lit("="), F.when(x.rlike("^[0-9]+$"), "#").otherwise(x)))
    ending = F.regexp_extract(_lower(path), r"(\.[a-z0-9]{1,8})$", 1)
    query = F.filter(F.split(F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1), "&"), lambda x: x != "")
    tokens = F.concat(
        F.transform(labels, lambda x, i: F.concat(F.lit("host"), i.cast("string"), F.lit("="), x)),
        named,
        F.when(ending != "", F.array(F.concat(F.lit("ending="), ending))).otherwise(F.array()),
        F.transform(query, lambda x: F.concat(F.lit("query="), x)),
        F.when(F.contains(rest, F.lit("#")), F.array(F.lit("fragment"))).otherwise(F.array()),
    )
    return F.when(rest != "", F.array_sort(F.array_distinct(tokens))).otherwise(F.array(F.lit("none")))


def explicit_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, prefix, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), [-ord(c) for c in r[0] + r[1]])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(prefix)
        rule, verdict = F.when(fits, name + prefix).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def mine(examples: DataFrame, each_row: bool = False) -> list[tuple[tuple[str, ...], str, float, float]]:
    """``tokens, label, confidence, support`` of the rules of ``examples`` (``tokens, label``), best first.

    Shares are of the rows with ``each_row``, of the different rows without.
    """
    times = F.count(F.lit(1)) if each_row else F.lit(1).cast("long")
    sets = materialize(examples.groupBy("tokens", "label").agg(times.alias("n")), "url_examples")
    n = sets.agg(F.sum("n")).first()[0]
    if not n:
        return []
    least = max(1, math.ceil(MIN_SUPPORT * n))
    by_label = {r["label"]: r["n"] for r in sets.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    # At most (tokens of a set) / MIN_SUPPORT tokens are left.
    counted = sets.select("label", "n", F.explode("tokens").alias("token")).groupBy("token", "label").agg(F.sum("n").alias("n"))
    kept = counted.withColumn("all", F.sum("n").over(Window.partitionBy("token"))).where(F.col("all") >= least).collect()
    telling: dict[str, float] = defaultdict(float)
    for r in kept:
        share = by_label[r["label"]] / n
        telling[r["token"]] = max(telling[r["token"]], abs(r["n"] / r["all"] - share) * math.sqrt(r["all"]))

    @F.pandas_udf("array<string>")
    def most_telling(tokens: pd.Series) -> pd.Series:
        return tokens.map(lambda own: sorted((t for t in own if t in telling), key=lambda t: (-telling[t], t))[:MINED_TOKENS])

    rows = examples if each_row else sets
    items = rows.select(F.array_append(most_telling("tokens"), F.concat(F.lit(_LABEL), "label")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=MIN_SUPPORT, minConfidence=MIN_CONFIDENCE, numPartitions=int(examples.sparkSession.conf.get("spark.sql.shuffle.partitions"))).fit(items)
    found = model.associationRules.where(F.col("consequent")[0].startswith(_LABEL) & (F.size("antecedent") <= MAX_TOKENS))
    rules = [(tuple(sorted(r["antecedent"])), r["consequent"][0].removeprefix(_LABEL), r["confidence"], r["support"]) for r in found.select("antecedent", "consequent", "confidence", "support").collect()]
    return prune(rules)


def prune(rules: list[tuple[tuple[str, ...], str, float, float]]) -> list[tuple[tuple[str, ...], str, float, float]]:
    """Without rules to which a part of their tokens gives the same label with at least their confidence; best first."""
    confidence = {(tokens, label): c for tokens, label, c, _ in rules}
    kept = [r for r in rules if not any(confidence.get((part, r[1]), -1.0) >= r[2] for k in range(1, len(r[0])) for part in combinations(r[0], k))]
    return sorted(kept, key=lambda r: (-r[2], -r[3], len(r[0]), r[0], r[1]))


class RuleIndex:
    """From a token to the rules that need it; rules are numbered from the best."""

    def __init__(self, rules: list[tuple[tuple[str, ...], str, float, float]]):
        self.labels, self.sizes = [r[1] for r in rules], [len(r[0]) for r in rules]
        self.of: dict[str, list[int]] = defaultdict(list)
        for number, (tokens, *_) in enumerate(rules):
            for token in tokens:
                self.of[token].append(number)

    def best(self, tokens) -> int | None:
        met: dict[int, int] = defaultdict(int)
        for token in set(tokens):
            for number in self.of.get(token, ()):
                met[number] += 1
        return min((number for number, count in met.items() if count == self.sizes[number]), default=None)

    def verdict(self, tokens) -> str:
        number = self.best(tokens)
        return DEFAULT if number is None else self.labels[number]


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for each row of ``pages``."""
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"), url_tokens(F.col("url")).alias("tokens"))
    rule, says = explicit_rule(F.col("host"), F.col("path"), rules)
    known = parts.select("*", rule.alias("rule"), says.alias("says"))
    index = RuleIndex(mine(known.where("rule IS NOT NULL").select("tokens", F.col("says").alias("label")), each_row=True))
    shared = pages.sparkSession.sparkContext.broadcast(index)  # bounded: see mine

    @F.pandas_udf("string")
    def by_method(tokens: pd.Series) -> pd.Series:
        return tokens.map(shared.value.verdict)

    return known.select("page_id", "host", "path", "rule", F.coalesce("says", by_method("tokens")).alias("verdict"))
