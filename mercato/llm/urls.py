"""URL filter with a weighted vocabulary.

An Aho-Corasick automaton finds every term of the vocabulary in one pass over a
URL.  A hit counts only between boundaries: the characters beside it are not
letters or digits.  One hit of a strict term blocks; so do soft terms when the
summed weight of the *distinct* ones reaches a threshold.  Host rules, where one
fits, have the last word.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.tables import lower_ascii

STRICT_TERMS = ("porn", "xxx", "casino", "free-bets", "escort", "viagra")
SOFT_TERMS = {"bet": 1, "bets": 1, "free": 1, "win": 1, "bonus": 1, "poker": 2, "adult": 2, "sexy": 2, "pills": 1, "cheap": 1, "crack": 2, "warez": 2, "torrent": 1}
SOFT_THRESHOLD = 3
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))


def host_of(url: Column) -> Column:
    """Host in lower case; empty for null or without ``://``."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty for null or without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none fits.

    Order of length, then of the rule itself; a rule fits its host and all subdomains.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    fits = [(F.concat(F.lit("."), host).endswith(F.lit("." + h)) & path.startswith(F.lit(p)), h + p, v) for h, p, v in ordered]
    rule = reduce(lambda rest, r: F.when(r[0], r[1]).otherwise(rest), reversed(fits), F.lit(None).cast("string"))
    verdict = reduce(lambda rest, r: F.when(r[0], r[2]).otherwise(rest), reversed(fits), F.lit(None).cast("string"))
    return rule, verdict


def term_hits(strict: Sequence[str], soft: Mapping[str, int]):
    """A pandas UDF: URL to the distinct strict and soft terms it contains."""
    vocabulary = {t.lower(): (True, 0) for t in strict} | {t.lower(): (False, int(w)) for t, w in soft.items() if t not in strict}

    @F.pandas_udf("strict_hits long, soft_hits long, soft_weight long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term, kind in vocabulary.items():
            automaton.add_word(term, (term, *kind))
        if vocabulary:
            automaton.make_automaton()
        for urls in batches:
            rows = []
            for url in urls:
                text = (url or "") if vocabulary else ""
                found, hits = {}, 0
                for last, (term, is_strict, weight) in automaton.iter(text) if text else ():
                    first = last - len(term) + 1
                    if (first and text[first - 1].isalnum()) or (last + 1 < len(text) and text[last + 1].isalnum()):
                        continue
                    hits += is_strict
                    if not is_strict:
                        found[term] = weight
                rows.append((hits, len(found), sum(found.values())))
            yield pd.DataFrame(rows, columns=["strict_hits", "soft_hits", "soft_weight"], dtype="int64")

    return count


def filter_urls(
    pages: DataFrame,
    url: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    strict: Sequence[str] = STRICT_TERMS,
    soft: Mapping[str, int] = SOFT_TERMS,
    threshold: int = SOFT_THRESHOLD,
) -> DataFrame:
    """All rows and columns, and a struct column ``judged``.

    ``judged`` has host, path, rule, strict_hits, soft_hits (distinct), soft_weight
    and verdict ("allow" or "block").  A null URL has empty host and path, no hits
    and verdict "allow".  Rows are judged one by one, so repeated rows and columns
    of any name pass through; an existing column ``judged`` is replaced.
    """
    where = F.col(f"`{url}`")
    host, path = host_of(where), path_of(where)
    rule, verdict = fitting_rule(F.col("judged.host"), F.col("judged.path"), rules)
    # Letters beyond ASCII keep their case rules out of the vocabulary: only A-Z is folded.
    hits = term_hits(strict, soft)(lower_ascii(where))
    own = F.when((F.col("judged.hits.strict_hits") > 0) | (F.col("judged.hits.soft_weight") >= threshold), "block").otherwise("allow")
    found = pages.withColumn("judged", F.struct(host.alias("host"), path.alias("path"), hits.alias("hits")))
    return found.withColumn(
        "judged",
        F.struct(
            F.col("judged.host").alias("host"), F.col("judged.path").alias("path"), rule.alias("rule"),
            F.col("judged.hits.strict_hits").alias("strict_hits"), F.col("judged.hits.soft_hits").alias("soft_hits"),
            F.col("judged.hits.soft_weight").alias("soft_weight"), F.coalesce(verdict, own).alias("verdict"),
        ),
    )
