"""The registered queries of the operators, and their SQL counterparts for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm import chat, crossentropy, decontaminate, jaccard, negatives, packing, passages, pii, repair, rules, tokens, topk, urls
from mercato.llm.tables import ship_package, stored, text_key
from mercato.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(ship_package(configure(spark)), folder)
        if sql:
            ORACLES[name] = sql
        return build

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as byte sequences, each ended by one separator."""
    documents = table(spark, folder, "documents")
    sized = documents.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("n_tokens"))
    return packing.pack_documents(sized)


def _boundary(term: str) -> str:
    return rf"(^|[^0-9A-Za-z]){term}($|[^0-9A-Za-z])"


def _urls_sql() -> str:
    strict = " OR ".join(f"regexp_matches(u, '{_boundary(t)}')" for t in urls.STRICT_TERMS)
    soft = " + ".join(f"CASE WHEN regexp_matches(u, '{_boundary(t)}') THEN {w} ELSE 0 END" for t, w in urls.SOFT_TERMS.items())
    ordered = sorted(urls.RULES, key=lambda r: -len(r[0] + r[1]))
    fits = lambda then: "CASE " + " ".join(f"WHEN ends_with('.' || host, '.{h}') AND starts_with(path, '{p}') THEN '{then((h, p, v))}'" for h, p, v in ordered) + " END"
    return f"""WITH p AS (SELECT page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS u,
            CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        q AS (SELECT page_id, u, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p)
        SELECT page_id, host, path, {fits(lambda r: r[0] + r[1])} AS rule,
            coalesce({fits(lambda r: r[2])}, CASE WHEN {strict} OR {soft} >= {urls.SOFT_THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict
        FROM q"""


@query("op2_url_filter", _urls_sql())
def url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = urls.filter_urls(table(spark, folder, "pages").select("page_id", "url"))
    return judged.select("page_id", *[F.col(f"judged.{c}") for c in ("host", "path", "rule", "verdict")])


_ESCAPED = "replace(replace({}, '\\', '\\b'), '<|', '\\c')"
_CHAT_SQL = f"""WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
    steps AS (SELECT *, row_number() OVER w AS k, lag(role) OVER w AS before FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
    sized AS (SELECT *, length({_ESCAPED.format("text")}) + CASE WHEN before = role THEN {len(chat.NEXT)}
        ELSE {len(chat.OPEN + chat.SAYS + chat.DONE)} + length({_ESCAPED.format("role")}) END AS chars FROM steps)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
        CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(chars) AS BIGINT) AS formatted_chars
    FROM sized GROUP BY conv_id"""


@query("op3_chat_formatting", _CHAT_SQL)
def chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    own = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.explode(F.array(*[F.struct(F.lit(k).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(said).alias("text")) for k, r in enumerate(("user", "assistant"))])).alias("said"),
    ).select("conv_id", "said.*")
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    done = chat.format_conversations(turns)
    rows = chat.read_back(F.col("formatted"))
    read = done.select(
        "conv_id", F.length("formatted").cast("long").alias("formatted_chars"), rows.alias("rows"),
        chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    joined = F.concat_ws("", F.transform("rows", lambda r: F.concat(r["role"], F.lit("\n"), r["text"], F.lit("\n"))))
    return read.select(
        "conv_id", F.size("rows").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )


@query("op4_benchmark_decontamination")
def benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document and benchmark item that it holds."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    leaks = stored(decontaminate.find_leaks(documents, table(spark, folder, "benchmark")), "leaks")
    keyed = documents.select("doc_id", text_key(F.col("text")).alias("text_key"))
    return keyed.join(decontaminate.small(leaks), "text_key").select("doc_id", F.col("item").alias("item_id"), "similarity")


@query("op5_token_counts")
def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    counted = tokens.count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


_WORDS_SQL = r"""list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"""

_JACCARD_SQL = f"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS_SQL.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents),
    sets AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END)) AS s FROM w),
    classes AS (SELECT s, min(doc_id) AS c, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
    items AS (SELECT c, n, unnest(s) AS x FROM classes),
    often AS (SELECT x, count(*) AS f FROM items GROUP BY x HAVING count(*) > 1),
    pairs AS (SELECT a.c AS a, b.c AS b, a.n + b.n AS n, count(*) AS i
        FROM (SELECT * FROM items SEMI JOIN often USING (x)) a JOIN (SELECT * FROM items SEMI JOIN often USING (x)) b ON a.x = b.x AND a.c <> b.c GROUP BY ALL),
    links AS (SELECT a, b FROM pairs WHERE 100 * i >= 75 * (n - i)),
    reach AS (SELECT c AS node, c AS root FROM classes UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node),
    roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
    SELECT doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(root, doc_id) AS component_id
    FROM sets LEFT JOIN classes ON sets.s = classes.s LEFT JOIN roots ON node = c"""


@query("op6_ngram_jaccard_join", _JACCARD_SQL)
def ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.link_documents(table(spark, folder, "documents"))


@query("op7_substring_dedup")
def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of at least 50 words that repeat across documents."""
    return passages.find_passages(table(spark, folder, "documents"))


_UPPER_PAIRS = "len(regexp_extract_all(' ' || t, '[^A-Za-z][A-Z]{2}'))"

_RULES_SQL = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    w AS (SELECT r, doc_id, t, {_WORDS_SQL.format("t")} AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
    windows AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM w, unnest(range(1, len(ws) - 1)) AS u(i)),
    again AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
    covered AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM again) GROUP BY r),
    s AS (SELECT doc_id, t, len(ls) AS n_lines, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN covered USING (r)),
    b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR 10 * n_symbols > n_words
        OR word_chars > 12 * n_words OR word_chars < 2 * n_words OR 2 * n_dup_lines > n_lines
        OR 2 * {_UPPER_PAIRS} > n_words OR 3 * len(regexp_extract_all(t, '!')) > n_words) AS kept FROM b"""


@query("op8_quality_rules", _RULES_SQL)
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = rules.judge_quality(table(spark, folder, "documents").select("doc_id", "text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *[F.col(f"quality.{c}").alias(c) for c in names])


@query("op9_personal_data")
def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, folder, "documents").select("doc_id", "text"))
    count = lambda rank: F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long")
    base = F.filter("spans", lambda s: s["rank"] < len(pii.KINDS))
    return found.select(
        "doc_id", *[count(rank).alias(f"n_{kind}") for rank, kind in enumerate(pii.KINDS)],
        F.sha2(pii.written(base), 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans"),
    )


@query("op10_cross_entropy_difference")
def cross_entropy_difference(spark: SparkSession, folder: str) -> DataFrame:
    good = table(spark, folder, "labels").filter("quality = 1").select("doc_id")
    return crossentropy.score_documents(table(spark, folder, "documents"), good)


_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
_WHOLE = "list_transform(embedding, lambda x: floor({} * CAST(x AS DOUBLE)))"
_SCORE = "CAST(list_dot_product(a.v, b.v) AS BIGINT)"

_TOPK_SQL = f"""WITH e AS (SELECT row_number() OVER () AS r, vec_id, {_WHOLE.format(1024)} AS v FROM embeddings WHERE {_FINITE}),
    scored AS (SELECT a.r, a.vec_id AS query_id, b.vec_id, {_SCORE} AS score FROM e a JOIN e b ON a.r <> b.r WHERE a.vec_id % 100 = 0)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank, vec_id, score
    FROM scored QUALIFY rank <= 10"""


@query("op11_topk_search", _TOPK_SQL)
def topk_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten highest inner products of every hundredth vector with all others."""
    return topk.search(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024)


_NEGATIVES_SQL = f"""WITH e AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS l, {_WHOLE.format(256)} AS v
        FROM embeddings WHERE label IS NOT NULL AND {_FINITE}),
    scored AS (SELECT a.r AS ar, a.vec_id AS anchor_id, b.r, b.vec_id, a.l = b.l AS same, {_SCORE} AS score FROM e a JOIN e b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
    p AS (SELECT ar, r, vec_id AS positive_id, score AS positive_score FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id NULLS LAST) <= 5)
    SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.ar, p.r ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank,
        vec_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN scored s ON p.ar = s.ar AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score QUALIFY rank <= 10"""


@query("op12_hard_negatives", _NEGATIVES_SQL)
def hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh label is moved by one first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, scale=256, label=moved)


@query("op13_conversation_repair")
def conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.repair(repair.damage(table(spark, folder, "conversations")))
