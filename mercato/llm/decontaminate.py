"""Benchmark decontamination with SimHash windows, Spark expressions only.

Benchmark items and texts are compared in windows of the item's own length in words.

* Places.  A window can reach the threshold only if it holds some of the item's
  rarest shingles, those that make up just over a quarter of its weight.  Where a
  text has such a shingle, the window that lines it up with the item is fingerprinted.
* Fingerprints.  Each window and item gets a 64-bit SimHash of its words.  The bits
  form four blocks; two fingerprints within RADIUS = 15 differ by at most 3 bits in
  some block.  Items are entered under every block value within 2 bits, windows
  looked up under every value within 1, so every such pair meets.  A few long words
  can move a fingerprint further than that, and inserted words can make a window best
  that no shingle lines up; so every window that holds one of an item's rarest
  shingles also meets that item, whatever its fingerprint.
* Check.  Met pairs are compared by their distinct five-word shingles, each weighing
  as many as it has letters: weight in common over weight in all.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mercato.llm.tables import bind, stored, text_key

SHINGLE_WORDS = 5
PERCENT = 75
BLOCKS, BLOCK_BITS = 4, 16
RADIUS = 4 * BLOCKS - 1
#: Rows up to which a side is broadcast, of some 50 bytes each; beyond, the join shuffles.
SMALL_ROWS = 200_000


def small(df: DataFrame) -> DataFrame:
    """A stored table, broadcast only if it has few rows."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def plain_words(text: Column) -> Column:
    """Runs of letters and digits in lower case."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(words, lambda w: w != "")


def _per_shingle(words: Column, code: Callable[[Column], Column]) -> Column:
    """``code`` of each window of five words, in order."""

    def windows(held: Column) -> Column:
        n = F.size(held)
        places = F.when(n >= SHINGLE_WORDS, F.sequence(F.lit(1), n - SHINGLE_WORDS + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: code(F.slice(held, i, F.lit(SHINGLE_WORDS))))

    return bind(words, windows)


def _key(part: Column) -> Column:
    return F.xxhash64(part).bitwiseAND(F.lit(-256).cast("long"))


def shingle_keys(words: Column) -> Column:
    """Hash of each five-word window, in order; the low 8 bits are left free."""
    return _per_shingle(words, _key)


def weighted_shingles(words: Column) -> Column:
    """Distinct shingles: the key, with the number of letters (at most 255) in its low 8 bits."""
    return F.array_distinct(_per_shingle(words, _weighted))


def _weighted(part: Column) -> Column:
    return _key(part).bitwiseOR(F.least(F.length(F.array_join(part, "")), F.lit(255)).cast("long"))


def weight_of(shingles: Column) -> Column:
    return F.aggregate(shingles, F.lit(0).cast("long"), lambda a, s: a + s.bitwiseAND(F.lit(255).cast("long")))


def simhash(words: Column) -> Column:
    """64-bit SimHash of the words, each weighing as many as it has letters."""
    features = F.transform(words, lambda w: F.struct(F.xxhash64(w).alias("h"), F.length(w).alias("w")))

    def fingerprint(held: Column) -> Column:
        def bit(b: Column) -> Column:
            mask = F.call_function("shiftleft", F.lit(1).cast("long"), b)
            vote = F.aggregate(held, F.lit(0), lambda a, f: a + F.when(f["h"].bitwiseAND(mask) != 0, f["w"]).otherwise(-f["w"]))
            return F.when(vote > 0, mask).otherwise(F.lit(0).cast("long"))

        return F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(63)), bit), F.lit(0).cast("long"), lambda a, m: a.bitwiseOR(m))

    return bind(features, fingerprint)


def block_values(fingerprint: Column, distance: int) -> Column:
    """Array of (block, value): every value of each block within a number of bits."""
    flips = [sum(1 << b for b in bits) for d in range(distance + 1) for bits in combinations(range(BLOCK_BITS), d)]
    masks = F.array(*[F.lit(m) for m in flips])
    blocks = []
    for k in range(BLOCKS):
        own = F.shiftrightunsigned(fingerprint, k * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int")
        blocks.append(_flipped(masks, own, k))
    return F.concat(*blocks)


def _flipped(masks: Column, own: Column, block: int) -> Column:
    return F.transform(masks, lambda m: F.struct(F.lit(block).alias("block"), own.bitwiseXOR(m).alias("value")))


def _items(benchmark: DataFrame, key: str, text: str) -> DataFrame:
    words = plain_words(F.col(f"`{text}`"))
    rows = benchmark.select(F.col(f"`{key}`").alias("item"), words.alias("words")).filter(F.size("words") >= SHINGLE_WORDS)
    return stored(
        rows.select("item", F.monotonically_increasing_id().alias("number"), F.size("words").alias("length"), shingle_keys(F.col("words")).alias("keys"), weighted_shingles(F.col("words")).alias("shingles"), simhash(F.col("words")).alias("print")),
        "items",
    )


def _anchors(items: DataFrame) -> DataFrame:
    """(key, place, length, number): the rarest shingles of each item, of just over a quarter of its weight."""
    weighted = items.select("number", "length", "keys", weight_of(F.col("shingles")).alias("total"), F.explode("shingles").alias("s"))
    single = weighted.select("number", "length", "total", "keys", F.col("s").bitwiseAND(F.lit(-256)).alias("key"), F.col("s").bitwiseAND(F.lit(255).cast("long")).alias("weight"))
    often = single.groupBy("key").agg(F.count("*").alias("often"))
    order = W.partitionBy("number").orderBy("often", "key").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("weight").over(order), F.lit(0))
    rare = single.join(often, "key").withColumn("before", before).filter(100 * F.col("before") <= (100 - PERCENT) * F.col("total"))
    place = F.array_position("keys", F.col("key")).cast("int") - 1
    return rare.select("key", place.alias("place"), "length", "number").distinct()


def _all_windows(hits: DataFrame, words: DataFrame, items: DataFrame) -> DataFrame:
    """(text_key, item, common, all) of every window of an item's length that holds one of its rarest shingles.

    A window belongs to the first such shingle in it, so each is compared once.
    """
    span = F.col("length") - SHINGLE_WORDS
    before = F.lag("at").over(W.partitionBy("text_key", "number").orderBy("at"))
    places = hits.select("text_key", "number", "length", "at").distinct().withColumn("low", F.greatest(F.col("at") - span, F.coalesce(before + 1, F.col("at") - span)))
    held = stored(places.groupBy("text_key").agg(F.collect_list(F.struct("number", "length", "at", "low")).alias("places")), "places")
    begin = F.greatest(F.col("p.low"), F.lit(0))
    parts = words.join(small(held), "text_key").select("text_key", "words", F.explode("places").alias("p")).select(
        "text_key", "p.*", begin.alias("begin"), F.slice("words", begin + 1, F.col("p.at") + F.col("p.length") - begin).alias("part")
    ).dropDuplicates(["text_key", "number", "at"])
    met = parts.join(small(items.select("number", "item", "shingles")), "number").withColumn("found", _per_shingle(F.col("part"), _weighted))
    # The shingles of all its windows together must hold enough of the item.
    enough = 100 * weight_of(F.array_intersect("found", "shingles")) >= PERCENT * weight_of(F.col("shingles"))

    def window(start: Column) -> Column:
        first = F.greatest(start, F.lit(0))
        found = F.array_distinct(F.slice("found", first - F.col("begin") + 1, F.greatest(span + 1 - (first - start), F.lit(0))))
        return bind(found, lambda f: F.struct(weight_of(F.array_intersect(f, F.col("shingles"))).alias("common"), weight_of(f).alias("own")))

    compared = met.filter(enough).select("text_key", "item", "shingles", F.explode(F.transform(F.sequence("low", "at"), window)).alias("w"))
    return compared.select("text_key", "item", "w.common", (F.col("w.own") + weight_of(F.col("shingles")) - F.col("w.common")).alias("all"))


def find_leaks(documents: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(text_key, item, similarity) of every text that holds a benchmark item, once per distinct text and item.

    ``text_key`` is `tables.text_key` of the text; similarity is the best of its
    windows, at least 0.75.  Null and empty texts hold nothing.  Items of fewer than
    five words, null ones included, have no shingle and are found nowhere; items that
    are repeated or equal are each reported.  A window is cut off at the ends of its text.
    """
    items = _items(benchmark, item_key, item_text)
    anchors = stored(_anchors(items), "anchors")
    texts = documents.select(F.col(f"`{text}`").alias("t")).filter(F.col("t").isNotNull())
    placed = texts.select(text_key(F.col("t")).alias("text_key"), F.posexplode(shingle_keys(plain_words(F.col("t")))).alias("at", "key"))
    hits = stored(placed.join(small(anchors), "key").select("text_key", "at", (F.col("at") - F.col("place")).alias("start"), "length", "number").distinct(), "hits")
    windows = stored(
        hits.select("text_key", "start", "length").distinct()
        .groupBy("text_key").agg(F.collect_list(F.struct("start", "length")).alias("windows")),
        "windows",
    )
    words = texts.select(text_key(F.col("t")).alias("text_key"), "t").join(small(windows), "text_key").select(
        "text_key", "windows", plain_words(F.col("t")).alias("words")
    )
    begin = F.greatest(F.col("w.start"), F.lit(0))
    cut = words.select("text_key", "words", F.explode("windows").alias("w")).select(
        "text_key", "w.start", "w.length", F.slice("words", begin + 1, F.col("w.start") + F.col("w.length") - begin).alias("part")
    ).dropDuplicates(["text_key", "start", "length"])
    looked = stored(cut.select("text_key", "start", "length", weighted_shingles(F.col("part")).alias("found"), simhash(F.col("part")).alias("print")), "prints")
    entries = items.select("item", "length", "shingles", "print", F.explode(block_values(F.col("print"), 2)).alias("b")).select("item", "length", "shingles", F.col("print").alias("own"), "b.*")
    queries = looked.select("*", F.explode(block_values(F.col("print"), 1)).alias("b")).select("text_key", "start", "length", "found", "print", "b.*")
    near = F.bit_count(F.col("print").bitwiseXOR(F.col("own"))) <= RADIUS
    met = queries.join(entries, ["block", "value", "length"]).filter(near).select("text_key", "item", "found", "shingles")
    placed_by = hits.select("text_key", "start", "length", "number").distinct().join(looked, ["text_key", "start", "length"]).join(items.select("number", "item", "shingles"), "number")
    met = met.unionByName(placed_by.select("text_key", "item", "found", "shingles"))
    common = weight_of(F.array_intersect("found", "shingles"))
    scored = met.withColumn("common", common).withColumn("all", weight_of(F.col("found")) + weight_of(F.col("shingles")) - F.col("common"))
    scored = scored.select("text_key", "item", "common", "all").unionByName(_all_windows(hits, words.select("text_key", "words"), items))
    return (
        scored.filter(100 * F.col("common") >= PERCENT * F.col("all"))
        .groupBy("text_key", "item").agg(F.max(F.col("common") / F.col("all")).alias("similarity"))
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text holds no benchmark item; see `find_leaks`.

    Rows are found by their text: null texts, null keys and repeated rows stay as they are.
    """
    leaks = stored(find_leaks(documents, benchmark, text, item_key, item_text).select("text_key").distinct(), "leaks")
    held = documents.select(F.struct("*").alias("row"), text_key(F.col(f"`{text}`")).alias("text_key"))
    return held.join(small(leaks), "text_key", "left_anti").select("row.*")
