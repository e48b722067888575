"""URL filtering by pattern rules that are indexed by their rarest literal token.

A rule is a regular expression over ``host + path``. It is filed under the one of its literal tokens that
fewest URLs contain; the tokens of a URL fetch its candidate rules, and only those expressions run.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, UPPER

_TOKEN = re.compile(r"[0-9A-Za-z]+")
_FOLD = str.maketrans(UPPER, LOWER)
#: A rule list is configuration held by every task; more rules than this are refused.
MAX_RULES = 200_000


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for what ``pattern`` matches; ``name`` is shown in results.

    ``tokens`` are literal tokens that every match contains whole. ``rank`` orders fitting rules: host and path
    rules rank by length and beat patterns, which rank below zero.
    """

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: tuple[int, int]
    explicit: bool = True


def host_rule(verdict: str, site: str) -> Rule:
    """A rule such as ``block example.com/en/``: the host, all its subdomains, paths that start so."""
    host, slash, path = site.partition("/")
    if not slash:
        raise ValueError(f"a rule needs a host and a path: {site!r}")
    whole = _TOKEN.findall(host) + _TOKEN.findall(path[: path.rfind("/") + 1])
    return Rule(site, verdict, rf"(?:[^/]*\.)?{re.escape(site)}", tuple(whole), (len(site), len(host)))


def word_rule(verdict: str, word: str) -> Rule:
    """A pattern: ``word`` as a whole token of the host, on its own or between dots and hyphens."""
    return Rule(f"*{word}*", verdict, rf"(?:[^/]*[.-])?{re.escape(word)}(?:[.-][^/]*)?(?:/|\Z)", (word,), (-1, len(word)), False)


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z folded) and path of a URL; both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = re.search(r"[?#]", rest)
    rest = rest[: end.start()] if end else rest
    host, slash, path = rest.partition("/")
    return host.translate(_FOLD), slash + path


def token_counts(df: DataFrame, rules: Iterable[Rule], url: str = "url") -> dict[str, int]:
    """How many URLs contain each literal token of the rules; at most one entry per token of the rule list."""
    wanted = sorted({token for rule in rules for token in rule.tokens})
    if not wanted:
        return {}
    lower = F.translate(F.coalesce(F.col(url), F.lit("")), UPPER, LOWER)
    tokens = df.select(F.explode(F.array_distinct(F.split(lower, "[^0-9a-z]+"))).alias("token"))
    counted = tokens.where(F.col("token").isin([t.lower() for t in wanted])).groupBy("token").count().collect()
    found = {row["token"]: row["count"] for row in counted}
    return {token: found.get(token.lower(), 0) for token in wanted}


def index_rules(rules: Iterable[Rule], counts: dict[str, int]) -> tuple[dict[str, list[Rule]], list[Rule]]:
    """Rules by their rarest token, and those without a literal token, which every URL must try."""
    index: dict[str, list[Rule]] = {}
    always = []
    for rule in rules:
        if rule.tokens:
            index.setdefault(min(rule.tokens, key=lambda t: (counts.get(t, 0), -len(t), t)), []).append(rule)
        else:
            always.append(rule)
    return index, always


def judge_urls(df: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """``df`` plus ``host, path, rule, verdict``; existing columns of these names are replaced.

    The fitting rule of highest rank decides (longest; equal lengths: the longer host). ``rule`` names explicit
    rules only; patterns and ``default`` decide the rest. Null URLs and URLs without ``://`` have an empty host and path and
    get the default. Every row is kept, repeated ones too; nothing is shuffled.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    index, always = index_rules(rules, token_counts(df, rules, url))

    def judge(urls: pd.Series) -> pd.DataFrame:
        patterns = {rule: re.compile(rule.pattern) for rule in [*always, *(r for rs in index.values() for r in rs)]}

        def one(value):
            host, path = split_url(value)
            key = host + path
            candidates = [*always]
            for token in set(_TOKEN.findall(key)):
                candidates += index.get(token, ())
            fitting = [rule for rule in candidates if patterns[rule].match(key)]
            best = max(fitting, key=lambda r: (r.rank, r.name), default=None)
            return host, path, best.name if best and best.explicit else None, best.verdict if best else default

        return pd.DataFrame([one(u) for u in urls], columns=["host", "path", "rule", "verdict"], dtype=object)

    def batches(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for values in series:
            yield judge(values)

    judged = F.pandas_udf(batches, "host string, path string, rule string, verdict string")
    kept = [c for c in df.columns if c.lower() not in {"host", "path", "rule", "verdict"} or c == url]
    out = df.select(*[F.col(f"`{c}`") for c in kept], judged(F.col(f"`{url}`").cast("string")).alias("judged__"))
    return out.select(*[F.col(f"`{c}`") for c in kept], "judged__.host", "judged__.path", "judged__.rule", "judged__.verdict")


#: The rules of the query, longest match wins.
SITE_RULES = [
    host_rule("allow", "com/"),
    host_rule("block", "example.com/en/"),
    host_rule("allow", "www.example.com/en/"),
    host_rule("block", "net/es/"),
    host_rule("block", "net/fr/"),
]
#: Words that mark a host as spam when no explicit rule fits.
SPAM_WORDS = ["casino", "pills", "spam", "poker", "viagra", "porn", "xxx", "payday", "warez"]
