"""Personal data by bootstrapped contextual extraction, with Spark expressions only.

Fixed patterns find e-mail addresses, IP addresses, payment cards and phone numbers;
these are the seeds.  Every token with at least six digits is a candidate, seed or
not.  The words around a candidate are its lexical patterns: the two words before
it, and the word before with the word after.  Patterns and candidates form a graph
that is scored in rounds: a pattern by the mean score of its distinct candidates, a
candidate by the patterns it occurs in.  Patterns that enough distinct seeds support
and whose score is high mark their other candidates as identifiers too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.tables import bind, stored, text_key

# The four kinds in the order of ties.
KINDS = ("email", "ip", "card", "phone")
FOUND = "identifier"

# The rules' patterns, written so that Java finds the same matches without going back: a match can only begin
# where a run begins or the last match ended (\G), and runs are possessive since what follows is not in them.
_LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# A word (no blank inside) with six digits or more.
CANDIDATE = r"(?:(?<![^\x20\x09-\x0D])|\G)(?:[^0-9\x20\x09-\x0D]*+[0-9]){6}[^\x20\x09-\x0D]*+"

MIN_DIGITS = 6
#: Distinct seeds that must support a pattern, the score it must have, and the rounds of scoring.
SUPPORT = 3
CONFIDENCE = 0.8
ROUNDS = 3
#: Code points on either side in which context words are looked for.
CONTEXT = 80


def located(text: Column, pattern: str) -> Column:
    """Matches of a pattern in order: start, end (code points, end exclusive) and the text between."""

    def walk(both: Column) -> Column:
        between, matches = both["between"], both["matches"]
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,match:string>>").alias("found"))

        def step(state: Column, i: Column) -> Column:
            begin = state["at"] + F.length(F.get(between, i))
            match = F.get(matches, i)
            end = begin + F.length(match)
            return F.struct(
                end.alias("at"),
                F.concat(state["found"], F.array(F.struct(begin.alias("start"), end.alias("end"), match.alias("match")))).alias("found"),
            )

        places = F.when(F.size(matches) > 0, F.sequence(F.lit(0), F.size(matches) - 1)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(places, start, step)["found"]

    held = F.struct(F.split(text, pattern, -1).alias("between"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"))
    return bind(held, walk)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def worth(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(F.transform(places, worth), F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid_ip(match: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
    return match.rlike(rf"^{part}(?:\.{part}){{3}}$")


def base_spans(text: Column) -> Column:
    """Array of (start, rank, end) of the four fixed kinds, sorted; ``text`` must not be null."""
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    # The cheap condition in front spares most texts the search.
    kinds = [
        (EMAIL, F.contains(text, F.lit("@")), lambda m: F.lit(True)),
        (IP, text.rlike(r"[0-9]\.[0-9]++\.[0-9]"), lambda m: _valid_ip(m)),
        (CARD, text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"), lambda m: F.length(_digits(m)).between(12, 19) & _luhn(_digits(m))),
        (PHONE, text.rlike(r"\+[0-9]"), lambda m: F.length(_digits(m)).between(9, 15)),
    ]

    def spans(rank: int, pattern: str, may: Column, keep: Callable[[Column], Column]) -> Column:
        found = F.filter(F.when(may, located(text, pattern)).otherwise(none), lambda s: keep(s["match"]))
        return F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end")))

    return F.sort_array(F.concat(*[spans(rank, *kind) for rank, kind in enumerate(kinds)]))


def candidates(text: Column, base: Column) -> Column:
    """Array of start, end, value, seed and patterns of the candidate tokens of a text."""
    word = r"[^\x20\x09-\x0D]+"

    def describe(s: Column) -> Column:
        lead = F.length(F.regexp_extract(s["match"], "^[^0-9A-Za-z]*", 0))
        tail = F.length(F.regexp_extract(s["match"], "[^0-9A-Za-z]*$", 0))
        start, end = s["start"] + lead, s["end"] - tail
        left_at = F.greatest(s["start"] - CONTEXT, F.lit(0))
        left = F.lower(F.substring(text, left_at + 1, s["start"] - left_at))
        right = F.lower(F.substring(text, s["end"] + 1, F.lit(CONTEXT)))
        two = F.regexp_extract(left, rf"({word}\s+{word})\s*$", 1)
        one = F.regexp_extract(left, rf"({word})\s*$", 1)
        following = F.regexp_extract(right, rf"^\s*({word})", 1)
        patterns = F.filter(
            F.array(
                F.when(two != "", F.concat(F.lit("<< "), F.regexp_replace(two, r"\s+", " "))),
                F.when((one != "") & (following != ""), F.concat(F.lit("<> "), one, F.lit(" "), following)),
            ),
            lambda p: p.isNotNull(),
        )
        return F.struct(
            start.alias("start"), end.alias("end"), F.substring(text, start + 1, end - start).alias("value"),
            F.exists(base, lambda b: (b["start"] < end) & (b["end"] > start)).alias("seed"), patterns.alias("patterns"),
        )

    return F.transform(located(text, CANDIDATE), describe)


def confident_patterns(occurrences: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """Patterns (column ``pattern``) that mark identifiers, from rows (pattern, value, seed)."""
    edges = stored(occurrences.groupBy("pattern", "value").agg(F.max("seed").alias("seed")), "edges")
    score = edges.groupBy("value").agg(F.max(F.col("seed").cast("double")).alias("score"))
    for number in range(rounds):
        scored = edges.join(score, "value")
        patterns = stored(
            scored.groupBy("pattern").agg(F.avg("score").alias("confidence"), F.count_if("seed").alias("seeds")).filter(F.col("seeds") >= support),
            "patterns",
        )
        if number + 1 < rounds:
            # A candidate that no good pattern contains keeps 0; several patterns add up.
            miss = F.sum(F.log1p(-F.least(F.coalesce("confidence", F.lit(0.0)), F.lit(0.99))))
            score = edges.join(patterns, "pattern", "left").groupBy("value").agg(
                F.when(F.max("seed"), 1.0).otherwise(1 - F.exp(miss)).alias("score")
            )
    return patterns.filter(F.col("confidence") >= confidence).select("pattern")


def find_personal_data(documents: DataFrame, text: str = "text", support: int = SUPPORT, confidence: float = CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """All rows and columns plus ``spans``: sorted array of start, rank and end.

    ``rank`` counts KINDS from 0; the last, 4, is an identifier found by context, which
    never overlaps a span of the fixed kinds.  Null and empty texts have no spans.
    Rows are found by their text, so repeated rows, null keys and columns of any name
    are no matter; an existing column ``spans`` is replaced.
    """
    held = documents.select(F.struct("*").alias("row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    some = F.col("t").rlike(CANDIDATE)
    rich = held.filter(some).withColumn("key", text_key(F.col("t"))).withColumn("base", base_spans(F.col("t")))
    told = stored(rich.select("key", F.explode(candidates(F.col("t"), F.col("base"))).alias("c")).distinct(), "candidates")
    seen = told.select("key", "c.start", "c.end", "c.value", "c.seed", F.explode("c.patterns").alias("pattern"))
    good = confident_patterns(seen.select("pattern", "value", "seed"), support, confidence, rounds)
    extra = (
        seen.filter("NOT seed").join(good, "pattern", "left_semi")
        .groupBy("key").agg(F.collect_set(F.struct("start", F.lit(len(KINDS)).alias("rank"), "end")).alias("extra"))
    )
    none = F.array().cast("array<struct<start:int,rank:int,end:int>>")
    with_extra = rich.join(extra, "key", "left").select("row", F.sort_array(F.concat("base", F.coalesce("extra", none))).alias("spans"))
    plain = held.filter(~some).select("row", base_spans(F.col("t")).alias("spans"))
    fields = [F.col("row")[c].alias(c) for c in documents.columns if c != "spans"]
    return with_extra.unionByName(plain).select(*fields, "spans")


def kind_of(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k) for k in (*KINDS, FOUND)]), rank + 1)


def written(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", kind_of(s["rank"]), s["start"], s["end"])))


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans the first stays."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, s: Column) -> Column:
        kept = F.concat(
            state["out"], F.array(F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.concat(F.lit("<"), F.upper(kind_of(s["rank"])), F.lit(">")))
        )
        inside = s["start"] < state["at"]
        return F.struct(
            F.when(inside, F.greatest(state["at"], s["end"])).otherwise(s["end"]).alias("at"), F.when(inside, state["out"]).otherwise(kept).alias("out")
        )

    done = F.aggregate(spans, start, step)
    rest = lambda d: F.concat(F.array_join(d["out"], ""), F.substring(text, d["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, bind(done, rest)).otherwise(text)


def hide_personal_data(documents: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """The rows with all their columns, personal data in the text replaced by its kind.

    ``length`` names a column that holds the text's code points; it follows the text.
    """
    held = documents.select(F.struct("*").alias("row"), F.col(f"`{text}`").alias("t"))
    hidden = find_personal_data(held, "t").select("row", redact(F.col("t"), F.col("spans")).alias("t"))
    columns = [F.col("t").alias(c) if c == text else F.length("t").cast("long").alias(c) if c == length else F.col("row")[c].alias(c) for c in documents.columns]
    return hidden.select(*columns)
