"""Exploratory and profiling jobs."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions.dates import days_floor
from mercato.functions.numeric import count_where, mean, percent, round_half_up
from mercato.functions.ordering import top_k
from mercato.operators.profile import as_text, literal_rows, numeric_columns, top_values, unpivot, unpivot_row, value_counts, with_share
from mercato.operators.quantiles import exact_quantiles, quantile_columns

PURCHASE = "order_purchase_timestamp"
DELIVERED_AT = "order_delivered_customer_date"
ESTIMATE = "order_estimated_delivery_date"
DATE_COLUMNS = [PURCHASE, "order_approved_at", "order_delivered_carrier_date", DELIVERED_AT, ESTIMATE]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTHS = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
QUARTILES = {0.25: "p25", 0.5: "p50", 0.75: "p75"}


# -- column profiles --------------------------------------------------------


def describe_numeric(df: DataFrame, columns: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum per numeric column."""
    names = columns or numeric_columns(df)
    long = unpivot({n: F.col(n).cast("double") for n in names}, df)
    moments = long.groupBy("column").agg(
        F.count("value").alias("count"),
        round_half_up(F.avg("value"), 4).alias("mean"),
        round_half_up(F.stddev_samp("value"), 4).alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = quantile_columns(exact_quantiles(long, ["column"], "value", list(QUARTILES), approx, few_groups=True), ["column"], QUARTILES)
    shown = [round_half_up(F.col(n), 6).alias(n) for n in QUARTILES.values()]
    return moments.join(quartiles, "column", "left").select("column", "count", "mean", "std", "min", *shown, "max")


def describe_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, distinct values, most frequent value and its frequency per column.

    Values are counted once; everything else follows from the counts.
    """
    long = unpivot({n: as_text(df, n) for n in columns}, df)
    counts = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("n"))
    # Smallest of (minus frequency, value): ties for the top go to the smallest value.
    found = counts.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count("*").alias("unique"),
        F.max("n").alias("freq"),
        F.min(F.struct((-F.col("n")).alias("rank"), "value")).alias("best"),
    )
    blank = literal_rows(df.sparkSession, ["column"], [(n,) for n in columns])
    return blank.join(found, "column", "left").select(
        "column",
        F.coalesce("count", F.lit(0)).alias("count"),
        F.coalesce("unique", F.lit(0)).alias("unique"),
        F.col("best.value").alias("top"),
        "freq",
    )


def describe_all(df: DataFrame, approx: bool = False) -> DataFrame:
    """Both profiles in one table: text columns have no moments, numeric ones no top value."""
    numbers = numeric_columns(df)
    texts = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.NumericType)]
    parts = []
    if texts:
        parts.append(describe_text(df, texts))
    if numbers:
        parts.append(describe_numeric(df, numbers, approx))
    order = ["column", "count", "unique", "top", "freq", "mean", "std", "min", "p25", "p50", "p75", "max"]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return both.select(*[F.col(c) if c in both.columns else F.lit(None).cast("double").alias(c) for c in order])


def column_info(df: DataFrame) -> DataFrame:
    """Non-NULL count and type per column."""
    row = df.agg(*[F.count(F.col(n)).alias(f"n_{n}") for n in df.columns])
    info = unpivot_row(row, df.columns, "column", non_null="n_")
    kinds = dict(df.dtypes)
    kind = reduce(lambda c, n: F.when(F.col("column") == n, F.lit(kinds[n])).otherwise(c), df.columns, F.lit(None).cast("string"))
    return info.withColumn("dtype", kind)


def dtype_counts(df: DataFrame) -> DataFrame:
    """Columns per type."""
    return column_info(df).groupBy("dtype").agg(F.count("*").alias("n"))


def null_profile(df: DataFrame, table: str) -> DataFrame:
    """Columns with NULLs, how many and what percentage."""
    row = df.agg(F.count("*").alias("_rows"), *[F.count(F.when(F.col(n).isNull(), 1)).alias(f"n_{n}") for n in df.columns])
    structs = [F.struct(F.lit(n).alias("column"), F.col(f"n_{n}").alias("nulls")) for n in df.columns]
    long = row.select(F.lit(table).alias("table"), "_rows", F.inline(F.array(*structs)))
    kept = long.where(F.col("nulls") > 0).withColumn("null_pct", percent(F.col("nulls"), F.col("_rows"), 4))
    return kept.drop("_rows").orderBy(F.desc("nulls"), "column")


def duplicate_profile(df: DataFrame, table: str) -> DataFrame:
    """Rows that repeat an earlier row in every column, NULLs being equal."""
    # Texts enter the shuffle as 256-bit digests, not as a whole.
    kinds = dict(df.dtypes)
    keys = [F.unhex(F.sha2(F.col(c), 256)).alias(c) if kinds[c] == "string" else F.col(c) for c in df.columns]
    copies = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    totals = copies.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates")
    )
    return totals.select(
        F.lit(table).alias("table"), "rows", "duplicates", percent(F.col("duplicates"), F.col("rows"), 2).alias("duplicate_pct")
    )


def quality_profile(df: DataFrame, table: str) -> dict[str, DataFrame]:
    """The whole quality sheet of one table: columns, types, NULLs, duplicates."""
    return {
        "columns": column_info(df),
        "types": dtype_counts(df),
        "nulls": null_profile(df, table),
        "duplicates": duplicate_profile(df, table),
    }


# -- relationships ----------------------------------------------------------


def relationship_cardinality(tables: Mapping[str, DataFrame], keys: Mapping[str, list[str]]) -> DataFrame:
    """Row count and distinct count per key column, one row per metric."""
    parts = []
    for name, df in tables.items():
        columns = keys[name]
        row = df.agg(F.count("*").alias("n_rows"), *[F.count_distinct(c).alias(f"n_{c}") for c in columns])
        structs = [F.struct(F.lit("rows").alias("metric"), F.col("n_rows").alias("value"))]
        structs += [F.struct(F.lit(f"distinct {c}").alias("metric"), F.col(f"n_{c}").alias("value")) for c in columns]
        parts.append(row.select(F.lit(name).alias("table"), F.inline(F.array(*structs))))
    return reduce(DataFrame.unionByName, parts)


def orphan_keys(child: DataFrame, parent: DataFrame, key: str, relation: str) -> DataFrame:
    """Distinct non-NULL child keys that the parent lacks."""
    used = child.select(key).where(F.col(key).isNotNull()).distinct()
    # Distinct on both sides: a hot parent key would otherwise sit in one
    # partition, and the join keeps the partitioning of the distinct.
    missing = used.join(parent.select(key).distinct(), key, "left_anti")
    return missing.agg(F.count("*").alias("orphans")).select(F.lit(relation).alias("relation"), "orphans")


# -- time -------------------------------------------------------------------


def date_features(orders: DataFrame) -> DataFrame:
    """Parse the five date columns and split the purchase time into its parts."""
    parsed = orders
    for name in DATE_COLUMNS:
        if isinstance(orders.schema[name].dataType, T.StringType):
            parsed = parsed.withColumn(name, F.to_timestamp_ntz(F.col(name)))
    ts = F.col(PURCHASE)
    return parsed.withColumns(
        {
            "year": F.year(ts),
            "month": F.month(ts),
            "month_name": F.date_format(ts, "MMMM"),
            "day": F.day(ts),
            "dayofweek": F.weekday(ts),
            "dayofweek_name": F.date_format(ts, "EEEE"),
            "quarter": F.quarter(ts),
        }
    )


def date_range(df: DataFrame, column: str = PURCHASE) -> DataFrame:
    """First and last value and the whole days between."""
    ends = df.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    return ends.withColumn("days", days_floor(F.col("last"), F.col("first")))


def orders_by_month(orders: DataFrame) -> DataFrame:
    """Orders per calendar month."""
    months = orders.where(F.col(PURCHASE).isNotNull()).groupBy(F.date_format(PURCHASE, "yyyy-MM").alias("year_month"))
    return months.agg(F.count("*").alias("num_orders")).orderBy("year_month")


def orders_by_year(orders: DataFrame) -> DataFrame:
    """Orders per year."""
    years = orders.where(F.col(PURCHASE).isNotNull()).groupBy(F.year(PURCHASE).alias("year"))
    return years.agg(F.count("*").alias("total_orders")).orderBy("year")


def _over_domain(df: DataFrame, label: Column, domain: list[str], name: str) -> DataFrame:
    """Counts for every value of a fixed domain, in its order; a missing value has no count."""
    counts = value_counts(df.select(label.alias(name)), name)
    names = literal_rows(df.sparkSession, ["position", name], list(enumerate(domain)))
    return names.join(counts, name, "left").orderBy("position").select(name, "position", "n")


def orders_by_weekday(orders: DataFrame) -> DataFrame:
    """Orders per weekday, Monday to Sunday."""
    return _over_domain(orders, F.date_format(PURCHASE, "EEEE"), WEEKDAYS, "weekday")


def orders_by_month_name(orders: DataFrame) -> DataFrame:
    """Orders per month of the year, January to December."""
    return _over_domain(orders, F.date_format(PURCHASE, "MMMM"), MONTHS, "month_name")


def delivery_time_features(orders: DataFrame) -> DataFrame:
    """Delivery days, estimated days and their difference, each rounded down first."""
    return orders.withColumns(
        {
            "delivery_time": days_floor(F.col(DELIVERED_AT), F.col(PURCHASE)),
            "estimated_delivery_time": days_floor(F.col(ESTIMATE), F.col(PURCHASE)),
        }
    ).withColumn("delivery_delay", F.col("delivery_time") - F.col("estimated_delivery_time"))


def delivery_time_summary(orders: DataFrame) -> DataFrame:
    """Delivery figures of delivered orders; shares are of all delivered orders.

    Day counts have few distinct values, so the built-in median stays small.
    """
    timed = delivery_time_features(orders.where(F.col("order_status") == "delivered"))
    on_time, late = count_where(F.col("delivery_delay") <= 0), count_where(F.col("delivery_delay") > 0)
    return timed.agg(
        F.count("*").alias("delivered_orders"),
        mean(F.col("delivery_time"), 1).alias("mean_delivery_days"),
        F.median("delivery_time").alias("median_delivery_days"),
        mean(F.col("delivery_delay"), 1).alias("mean_delay_days"),
        on_time.alias("on_time_orders"),
        percent(on_time, F.count("*"), 1).alias("on_time_pct"),
        late.alias("late_orders"),
        percent(late, F.count("*"), 1).alias("late_pct"),
    )


def delivery_time_histogram(orders: DataFrame) -> DataFrame:
    """Delivered orders per day count, for the actual and the estimated time."""
    timed = delivery_time_features(orders.where(F.col("order_status") == "delivered"))
    series = {"actual": F.col("delivery_time"), "estimated": F.col("estimated_delivery_time")}
    return value_counts(unpivot(series, timed, "series", "days"), "series", "days")


# -- places and products ----------------------------------------------------


def top_customer_states(customers: DataFrame, n: int = 15) -> DataFrame:
    return top_values(customers, "customer_state", n)


def top_seller_states(sellers: DataFrame, n: int = 15) -> DataFrame:
    return top_values(sellers, "seller_state", n)


def top_cities(customers: DataFrame, n: int = 20) -> DataFrame:
    return top_values(customers, "customer_city", n)


def geo_sample(df: DataFrame, key: list[str], n: int = 5000, seed: int = 42) -> DataFrame:
    """A repeatable random sample: the ``n`` rows with the smallest keyed hash; rows with equal keys by all their columns."""
    ticket = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))
    return top_k(df.withColumn("_ticket", ticket), n, [F.col("_ticket").asc()], [*key, *[c for c in df.columns if c not in key]]).drop("_ticket")


def geo_cardinality(geolocation: DataFrame) -> DataFrame:
    """Distinct zip prefixes, states and cities."""
    return geolocation.agg(
        F.count_distinct("geolocation_zip_code_prefix").alias("unique_zips"),
        F.count_distinct("geolocation_state").alias("unique_states"),
        F.count_distinct("geolocation_city").alias("unique_cities"),
    )


def top_categories(items: DataFrame, products: DataFrame, translation: DataFrame, n: int = 20) -> DataFrame:
    """Categories by items sold; items without a translated category are left out.

    Items are counted per product before they meet the product table.
    """
    sold = items.groupBy("product_id").agg(F.count("*").alias("items"))
    named = sold.join(products.select("product_id", "product_category_name"), "product_id", "left").join(
        translation, "product_category_name", "left"
    )
    counts = (
        named.where(F.col("product_category_name_english").isNotNull())
        .groupBy(F.col("product_category_name_english").alias("category"))
        .agg(F.sum("items").alias("n"))
    )
    return top_k(counts, n, [F.col("n").desc()], ["category"])


def product_summary(products: DataFrame) -> DataFrame:
    """Distinct products and categories, products without a category."""
    return products.agg(
        F.count_distinct("product_id").alias("unique_products"),
        F.count_distinct("product_category_name").alias("unique_categories"),
        F.count(F.when(F.col("product_category_name").isNull(), 1)).alias("uncategorised"),
    )


def trimmed_histogram(df: DataFrame, columns: list[str], q: float = 0.99, bins: int = 50) -> DataFrame:
    """Equal-width bins per column after dropping values above the exact ``q`` quantile.

    The last bin is closed; empty bins are listed with zero.
    """
    long = unpivot({n: F.col(n).cast("double") for n in columns}, df).where(F.col("value").isNotNull())
    # Limits and ends have one row per named column, so they can be broadcast.
    limits = exact_quantiles(long, ["column"], "value", [q], few_groups=True).select("column", F.col("quantile").alias("limit"))
    kept = long.join(F.broadcast(limits), "column").where(F.col("value") <= F.col("limit"))
    counts = kept.groupBy("column", "value").agg(F.count("*").alias("n"))
    ends = counts.groupBy("column").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    flat = F.col("low") == F.col("high")
    ends = ends.select(
        "column",
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
    )
    width = (F.col("high") - F.col("low")) / bins
    place = F.least(F.floor((F.col("value") - F.col("low")) / (F.col("high") - F.col("low")) * bins), F.lit(bins - 1))
    filled = counts.join(F.broadcast(ends), "column").groupBy("column", place.cast("int").alias("bin")).agg(F.sum("n").alias("n"))
    grid = ends.select("column", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "low", width.alias("width"))
    return grid.join(filled, ["column", "bin"], "left").select(
        "column",
        "bin",
        round_half_up(F.col("low") + F.col("bin") * F.col("width"), 6).alias("bin_start"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


# -- payments, reviews, headline figures ------------------------------------


def payment_type_distribution(payments: DataFrame) -> DataFrame:
    """Payments per type with their share."""
    return with_share(value_counts(payments, "payment_type"), 1).orderBy(F.col("n").desc(), "payment_type")


def value_stats(df: DataFrame, key: str, value: str, few_groups: bool = False) -> DataFrame:
    """Mean, exact median and sum per key, to two decimals."""
    kept = df.where(F.col(key).isNotNull())
    sums = kept.groupBy(key).agg(mean(F.col(value), 2).alias("mean"), F.round(F.sum(value), 2).alias("sum"))
    medians = exact_quantiles(kept, [key], value, [0.5], few_groups=few_groups).select(key, round_half_up(F.col("quantile"), 2).alias("median"))
    return sums.join(medians, key, "left").select(key, "mean", "median", "sum")


def payment_value_by_type(payments: DataFrame) -> DataFrame:
    """Payment values per type; there are five types at most."""
    return value_stats(payments, "payment_type", "payment_value", few_groups=True)


def review_score_distribution(reviews: DataFrame) -> DataFrame:
    """Reviews per score, in score order."""
    return value_counts(reviews, "review_score").orderBy("review_score")


def review_score_summary(reviews: DataFrame) -> DataFrame:
    """Average and median score and the shares of good, bad and neutral reviews."""
    score, rows = F.col("review_score"), F.count("*")
    return reviews.agg(
        mean(score, 2).alias("mean_score"),
        F.median(score).alias("median_score"),
        percent(count_where(score >= 4), rows, 1).alias("positive_pct"),
        percent(count_where(score <= 2), rows, 1).alias("negative_pct"),
        percent(count_where(score == 3), rows, 1).alias("neutral_pct"),
    )


def order_status_distribution(orders: DataFrame) -> DataFrame:
    return top_values(orders, "order_status")


def key_metrics(
    orders: DataFrame, customers: DataFrame, products: DataFrame, sellers: DataFrame, items: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Nine headline figures as (metric, value) text pairs."""
    delivered = percent(count_where(F.col("order_status") == "delivered"), F.count("*"), 1)
    period = F.concat(F.date_format(F.min(PURCHASE), "yyyy-MM-dd"), F.lit(" to "), F.date_format(F.max(PURCHASE), "yyyy-MM-dd"))
    sheets = [
        (
            orders,
            {
                "total orders": F.count("*"),
                "date range": period,
                "delivery success rate": F.concat(delivered.cast("decimal(5,1)").cast("string"), F.lit("%")),
            },
        ),
        (
            customers,
            {
                "unique customers": F.count_distinct("customer_unique_id"),
                "states covered": F.count_distinct("customer_state"),
            },
        ),
        (products, {"total products": F.count_distinct("product_id")}),
        (sellers, {"total sellers": F.count_distinct("seller_id")}),
        (items, {"items sold": F.count("*")}),
        (reviews, {"average score": mean(F.col("review_score"), 2).cast("decimal(5,2)")}),
    ]
    parts = []
    for df, metrics in sheets:
        row = df.agg(*[v.cast("string").alias(k) for k, v in metrics.items()])
        pairs = [F.struct(F.lit(k).alias("metric"), F.col(f"`{k}`").alias("value")) for k in metrics]
        parts.append(row.select(F.inline(F.array(*pairs))))
    return reduce(DataFrame.unionByName, parts)
