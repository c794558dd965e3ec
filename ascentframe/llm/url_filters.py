"""URL filters by a bit-parallel wildcard automaton (operator 5).

All glob rules are packed into one row of bits, one bit for each literal. A step over a character shifts the row, keeps
what the character allows (Shift-And), and lets states stay whose wildcard accepts it. All patterns run at once over each
URL, and all URLs of a batch at once, one character a step. In a rule `*` stands for any characters but a slash, `**` for
any, `?` for one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import IntegerType

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """`glob` is matched against "." + host + path; of the rules that match, the one of the highest rank decides."""

    name: str | None
    glob: str
    verdict: str
    rank: int


def path_rule(name: str, verdict: str) -> Rule:
    """Rule of a host and the beginning of a path: fits the host, its subdomains, and longer paths; longest wins."""
    return Rule(name, f"*.{name}**", verdict, 1000 + len(name))


#: Rules by host and path.
LISTED = (
    path_rule("org/", "allow"),
    path_rule("example.org/es/", "block"),
    path_rule("example.org/en/1", "block"),
    path_rule("com/fr/", "allow"),
    path_rule("com/de/", "block"),
)
#: Globs for what no listed rule fits: hosts and paths of advertising, gambling and pill shops.
GENERAL = tuple(
    Rule(None, glob, "block", 1)
    for glob in (
        "*spam*", "*spam*/**", "*casino*", "*casino*/**", "*cheap-pills*", "*cheap-pills*/**", "*doubleclick*",
        "*doubleclick*/**", "*.ads-*", "*.ads-*/**", "*.ads.*", "*.ads.*/**", "*-ads.*", "*-ads.*/**",
        "*/porn/**", "*/**/porn/**", "*/**.exe", "*/**wp-login**",
    )
)
RULES = LISTED + GENERAL
OTHERWISE = "allow"


class Automaton:
    """Masks of a rule list over 64-bit words; position 0 of every rule is its start state."""

    def __init__(self, globs: list[str]):
        states: list[tuple[str | None, bool]] = []  # the literal that leads into a state (None: any character), start?
        stays: dict[int, str] = {}
        starts, ends = [], []
        for glob in globs:
            starts.append(len(states))
            states.append((None, True))
            k = 0
            while k < len(glob):
                if glob[k] == "*":
                    double = glob[k : k + 2] == "**"
                    at = len(states) - 1
                    stays[at] = "any" if double or stays.get(at) == "any" else "inner"
                    k += 1 + double
                else:
                    states.append((None if glob[k] == "?" else glob[k], False))
                    k += 1
            ends.append(len(states) - 1)
        literals = sorted({c for c, _ in states if c} | {"/"})
        self.known = np.array([ord(c) for c in literals], np.uint32)  # class k + 1; all other characters are class 0
        self.width = -(-len(states) // 64)
        self.enter = np.zeros((len(literals) + 1, self.width), np.uint64)
        self.stay = np.zeros_like(self.enter)
        self.start = np.zeros(self.width, np.uint64)
        for at, (literal, start) in enumerate(states):
            word, bit = at // 64, np.uint64(1) << np.uint64(at % 64)
            if start:
                self.start[word] |= bit
            for k in range(len(literals) + 1):
                c = literals[k - 1] if k else None
                if not start and (literal is None or literal == c):
                    self.enter[k, word] |= bit
                if stays.get(at) == "any" or (stays.get(at) == "inner" and c != "/"):
                    self.stay[k, word] |= bit
        self.ends = np.array(ends)

    def run(self, texts: list[str]) -> np.ndarray:
        """Which rules match each whole text, as a boolean table (texts, rules)."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-sizes, kind="stable")
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        found = np.minimum(np.searchsorted(self.known, points), len(self.known) - 1)
        classes = np.where(self.known[found] == points, found + 1, 0)
        first = (np.cumsum(sizes) - sizes)[order]
        state = np.repeat(self.start[None, :], len(texts), axis=0)
        live = sizes[order]
        one, top = np.uint64(1), np.uint64(63)
        for step in range(int(live[0]) if len(live) else 0):
            n = int(np.searchsorted(-live, -step, "left"))  # texts longer than `step`; shorter ones keep their last state
            kinds, now = classes[first[:n] + step], state[:n]
            shifted = now << one
            shifted[:, 1:] |= now[:, :-1] >> top
            state[:n] = (shifted & self.enter[kinds]) | (now & self.stay[kinds])
        matched = np.empty((len(texts), len(self.ends)), bool)
        matched[order] = (state[:, self.ends // 64] >> (self.ends % 64).astype(np.uint64)) & one != 0
        return matched


@cache
def _automaton(globs: tuple[str, ...]) -> Automaton:
    return Automaton(list(globs))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _chosen(rules: tuple[Rule, ...]):
    """Number of the deciding rule for canonical URLs; -1 if none matches. Ties go to blocking rules, then to the first."""
    order = sorted(range(len(rules)), key=lambda k: (-rules[k].rank, rules[k].verdict != "block", k))

    def choose(urls: pd.Series) -> pd.Series:
        matched = _automaton(tuple(rules[k].glob for k in order)).run(list(urls))
        best = np.where(matched.any(axis=1), np.array([*order, 0])[matched.argmax(axis=1)], -1)
        return pd.Series(best.astype("int32"))

    return pandas_udf(choose, IntegerType())


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of each row of `pages`.

    The rule is the name of the deciding rule, NULL if that has none or no rule matches; the verdict is the deciding
    rule's, else `allow`. NULL urls and urls without `://` have an empty host and path, which no listed rule fits. Rows
    are independent: nothing is shuffled, repeated rows come out repeatedly.
    """
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    number = _chosen(rules)(F.concat(F.lit("."), "host", "path"))
    names = F.array(*[F.lit(r.name).cast("string") for r in rules])
    verdicts = F.array(*[F.lit(r.verdict) for r in rules])
    return parts.withColumn("number", number).select(
        "page_id",
        "host",
        "path",
        F.when(F.col("number") >= 0, F.get(names, F.col("number"))).alias("rule"),
        F.when(F.col("number") >= 0, F.get(verdicts, F.col("number"))).otherwise(F.lit(OTHERWISE)).alias("verdict"),
    )
