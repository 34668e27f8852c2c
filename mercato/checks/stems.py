"""Registered queries over stems.  The SQL runs the same endings as regular expressions, one stage after the other;
whether they are right for the language is a matter of the word families in the tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.checks.registry import check
from mercato.functions import stemming
from mercato.functions.text import STOP_WORDS, WORD_BREAK, folded
from mercato.operators.filters import may_be_in
from mercato.session import settled


def _stage(column: str, endings: list[stemming.Ending], otherwise: str) -> str:
    cases = []
    for e in endings:
        pattern = f"^(.{{{e.least},}}){e.text}$"
        spared = f" AND {column} NOT IN ({', '.join(repr(x) for x in e.exceptions)})" if e.exceptions else ""
        cases.append(f"WHEN regexp_matches({column}, '{pattern}'){spared} THEN regexp_replace({column}, '{pattern}', '\\1{e.to}')")
    return f"CASE {' '.join(cases)} ELSE {otherwise} END"


# Each different word is stemmed once.
OCCURRENCES = f"""SELECT doc_id, unnest(list_filter(string_split_regex(strip_accents(lower(coalesce(text, ''))), '{WORD_BREAK}'),
    lambda w: w <> '' AND w NOT IN ({", ".join(repr(w) for w in STOP_WORDS)}))) AS w FROM documents"""
STEMS = f"""SELECT word, {_stage("w", stemming.NOUN, _stage("w", stemming.VERB, _stage("w", stemming.VOWEL, "w")))} AS stem
    FROM (SELECT word, {_stage("w", stemming.AUGMENTATIVE, "w")} AS w
    FROM (SELECT word, CASE WHEN ends_with(w, 'a') THEN {_stage("w", stemming.FEMININE, "w")} ELSE w END AS w
    FROM (SELECT word, {_stage("w", stemming.ADVERB, "w")} AS w
    FROM (SELECT w AS word, CASE WHEN ends_with(w, 's') THEN {_stage("w", stemming.PLURAL, "w")} ELSE w END AS w FROM (SELECT DISTINCT w FROM o)))))"""


@check(
    "stem_frequency",
    "",
    f"""WITH o AS MATERIALIZED ({OCCURRENCES}) SELECT stem, count(*) AS words, count(DISTINCT w) AS forms, count(DISTINCT doc_id) AS documents
    FROM o JOIN ({STEMS}) ON w = word GROUP BY 1""",
)
def _(m):
    """Words, different forms and documents of each stem, over all documents."""
    docs = m.table("documents").select("doc_id", F.split(folded(F.coalesce("text", F.lit(""))), WORD_BREAK).alias("all"))
    wanted = (F.col("word") != "") & ~F.col("word").isin(list(STOP_WORDS))
    # A row tells which of its words are new to the document, unless other rows have its doc_id: few, told apart below.
    again = settled(m.table("documents").groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id", F.lit(True).alias("again")), "repeated")
    marked = stemming.bound(F.sort_array("all"), lambda ws: F.transform(ws, lambda w, i: F.struct(w.alias("word"), ((i == 0) | (F.get(ws, i - 1) != w)).alias("new"))))
    words = docs.join(again, "doc_id", "left").select("doc_id", "again", F.inline(marked)).where(wanted)
    known = words.groupBy("word").agg(
        F.count("*").alias("n"), F.count_if(F.col("new") & F.col("doc_id").isNotNull()).alias("documents"), F.coalesce(F.bool_or("again"), F.lit(False)).alias("again")
    )
    # Written: else a filter on the stem moves below the counts, and each occurrence is stemmed.
    known = settled(known.withColumn("stem", stemming.stemmed(F.col("word"))), "stems")
    totals = known.groupBy("stem").agg(F.sum("n").alias("words"), F.count("*").alias("forms"), F.max("documents").alias("documents"), F.bool_or("again").alias("again"))
    # A stem of one form has that word's documents.  Those of others are counted; a frequent stem is spread over them.
    forms = known.select("word", "stem").join(totals.where("forms > 1 OR again").select("stem"), "stem", "left_semi")
    own = docs.where("doc_id IS NOT NULL").select("doc_id", F.explode(F.array_distinct("all")).alias("word")).where(wanted)
    apart = may_be_in(own, "word", forms).join(forms, "word").select("stem", "doc_id").distinct().groupBy("stem").agg(F.count("*").alias("apart"))
    return totals.join(apart, "stem", "left").select("stem", "words", "forms", F.coalesce("apart", "documents").alias("documents"))
