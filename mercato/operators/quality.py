"""Declarative rules that report violations instead of rejecting rows.

Every rule returns rows ``(table, rule, key, observed)``.  A check passes on
NULL, as in SQL.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def key_text(keys: list[str]) -> Column:
    """Key columns joined by ``|``; a NULL part is shown as empty."""
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])


def _report(bad: DataFrame, table: str, rule: str, keys: list[str], observed: Column) -> DataFrame:
    return bad.select(
        F.lit(table).alias("table"),
        F.lit(rule).alias("rule"),
        key_text(keys).alias("key"),
        observed.cast("string").alias("observed"),
    )


def _check(df: DataFrame, table: str, rule: str, keys: list[str], passes: Column, observed: Column) -> DataFrame:
    return _report(df.where(~passes), table, rule, keys, observed)


def rule_regex(df: DataFrame, table: str, keys: list[str], column: str, pattern: str) -> DataFrame:
    """Text must match the pattern."""
    return _check(df, table, f"{column} regex", keys, F.col(column).rlike(pattern), F.col(column))


def rule_min(df: DataFrame, table: str, keys: list[str], column: str, low: float, strict: bool = False) -> DataFrame:
    """Number must be at least ``low``, or above it when ``strict``."""
    passes = F.col(column) > low if strict else F.col(column) >= low
    return _check(df, table, f"{column} min", keys, passes, F.col(column))


def rule_between(df: DataFrame, table: str, keys: list[str], column: str, low: float, high: float) -> DataFrame:
    """Number must lie in the closed range."""
    return _check(df, table, f"{column} between", keys, F.col(column).between(low, high), F.col(column))


def rule_in_set(df: DataFrame, table: str, keys: list[str], column: str, allowed: list[str]) -> DataFrame:
    """Value must be one of the allowed ones."""
    return _check(df, table, f"{column} in set", keys, F.col(column).isin(list(allowed)), F.col(column))


def rule_not_null(df: DataFrame, table: str, keys: list[str], column: str) -> DataFrame:
    """Value must be present."""
    return _report(df.where(F.col(column).isNull()), table, f"{column} not null", keys, F.lit(None))


def rule_length(
    df: DataFrame, table: str, keys: list[str], column: str, low: int | None = None, high: int | None = None
) -> DataFrame:
    """Text length in characters must lie in the closed range; either end may be open."""
    length = F.char_length(F.col(column))
    passes = F.lit(True)
    if low is not None:
        passes = passes & (length >= low)
    if high is not None:
        passes = passes & (length <= high)
    return _check(df, table, f"{column} length", keys, passes, length)


def rule_order(df: DataFrame, table: str, keys: list[str], earlier: str, later: str) -> DataFrame:
    """``later`` must not come before ``earlier``."""
    return _check(df, table, f"{later} >= {earlier}", keys, F.col(later) >= F.col(earlier), F.col(later))


def rule_unique(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """The key must not repeat; rows with a NULL key part never clash."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    repeated = df.where(present).groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    return _report(repeated, table, f"{','.join(keys)} unique", keys, F.col("_n"))


def rule_foreign_key(child: DataFrame, table: str, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Every non-NULL child key must exist in the parent.

    Both sides collapse to one row per key before the join, so a hot key costs
    one row; ``observed`` is the number of child rows behind it.
    """
    used = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    known = parent.select(F.col(parent_key).alias(key)).distinct()
    return _report(used.join(known, key, "left_anti"), table, f"{key} foreign key", [key], F.col("_n"))


# -- several rules in one pass ----------------------------------------------


@dataclass(frozen=True)
class Rule:
    """One named rule of a table; the functions below build them.

    A row rule has ``bad``, the condition of a violation.  A key rule has ``key`` columns
    instead and either demands that they are unique or that they are in ``parent``.
    """

    name: str
    keys: tuple[str, ...]
    observed: Column | None = None
    bad: Column | None = None
    parent: DataFrame | None = field(default=None, compare=False)


def _row_rule(name: str, keys: list[str], passes: Column, observed: Column) -> Rule:
    return Rule(name, tuple(keys), observed, ~passes)


def matches(keys: list[str], column: str, pattern: str) -> Rule:
    """As :func:`rule_regex`."""
    return _row_rule(f"{column} regex", keys, F.col(column).rlike(pattern), F.col(column))


def at_least(keys: list[str], column: str, low: float, strict: bool = False) -> Rule:
    """As :func:`rule_min`."""
    return _row_rule(f"{column} min", keys, F.col(column) > low if strict else F.col(column) >= low, F.col(column))


def between(keys: list[str], column: str, low: float, high: float) -> Rule:
    """As :func:`rule_between`."""
    return _row_rule(f"{column} between", keys, F.col(column).between(low, high), F.col(column))


def one_of(keys: list[str], column: str, allowed: list[str]) -> Rule:
    """As :func:`rule_in_set`."""
    return _row_rule(f"{column} in set", keys, F.col(column).isin(list(allowed)), F.col(column))


def present(keys: list[str], column: str) -> Rule:
    """As :func:`rule_not_null`."""
    return Rule(f"{column} not null", tuple(keys), F.lit(None), F.col(column).isNull())


def long_between(keys: list[str], column: str, low: int | None = None, high: int | None = None) -> Rule:
    """As :func:`rule_length`."""
    length = F.char_length(F.col(column))
    ends = [length >= low if low is not None else F.lit(True), length <= high if high is not None else F.lit(True)]
    return _row_rule(f"{column} length", keys, ends[0] & ends[1], length)


def in_order(keys: list[str], earlier: str, later: str) -> Rule:
    """As :func:`rule_order`."""
    return _row_rule(f"{later} >= {earlier}", keys, F.col(later) >= F.col(earlier), F.col(later))


def unique(keys: list[str]) -> Rule:
    """As :func:`rule_unique`."""
    return Rule(f"{','.join(keys)} unique", tuple(keys))


def known(key: str, parent: DataFrame, parent_key: str) -> Rule:
    """As :func:`rule_foreign_key`."""
    return Rule(f"{key} foreign key", (key,), parent=parent.select(F.col(parent_key).alias(key)))


def check_rules(df: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """The violations of all rules, row for row those of the single rule functions, from one scan of ``df``.

    Each row turns into its violations of row rules and its keys for the key rules;
    equal ones collapse before the one shuffle, so a hot key costs a row per task.  Keys
    of unique rules that came once and keys that a parent has are dropped after it.
    Each parent is read once.
    """
    numbered = list(enumerate(rules))
    text = lambda keys: F.array(*[F.col(k).cast("string") for k in keys])
    entry = lambda n, keys, observed: F.struct(F.lit(n).alias("no"), text(keys).alias("key"), observed.cast("string").alias("observed"))
    entries = []
    for n, rule in numbered:
        if rule.bad is not None:
            entries.append(F.when(rule.bad, entry(n, rule.keys, rule.observed)))
        else:
            there = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in rule.keys])
            entries.append(F.when(there, entry(n, rule.keys, F.lit(None))))
    found = df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).groupBy("e").agg(F.count("*").alias("n")).select("e.*", "n")
    foreign = [(n, rule) for n, rule in numbered if rule.parent is not None]
    if foreign:
        # Keys are compared as the child's type shows them.
        kinds = dict(df.dtypes)
        parents = [
            rule.parent.where(F.col(rule.keys[0]).isNotNull())
            .select(F.lit(n).alias("no"), F.array(F.col(rule.keys[0]).cast(kinds[rule.keys[0]]).cast("string")).alias("key")).distinct()
            for n, rule in foreign
        ]
        found = found.join(reduce(DataFrame.unionAll, parents), ["no", "key"], "left_anti")
    keyed = [n for n, rule in numbered if rule.bad is None]
    once = [n for n, rule in numbered if rule.bad is None and rule.parent is None]
    kept = found.where(~F.col("no").isin(once) | (F.col("n") > 1)) if once else found
    by_key = F.col("no").isin(keyed) if keyed else F.lit(False)
    copies = F.when(by_key, 1).otherwise(F.col("n").cast("int"))
    name = F.element_at(F.array(*[F.lit(rule.name) for rule in rules]), F.col("no") + 1)
    return kept.select(
        F.lit(table).alias("table"), name.alias("rule"), F.concat_ws("|", F.transform("key", lambda k: F.coalesce(k, F.lit("")))).alias("key"),
        F.when(by_key, F.col("n").cast("string")).otherwise(F.col("observed")).alias("observed"), F.explode(F.array_repeat(F.lit(0), copies)).alias("_copy"),
    ).drop("_copy")


def observe_rules(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, Observation]:
    """``df`` with ``_violations``, the names of the row rules that a row breaks, and their counts to come.

    The counts are filled in by the caller's own action on the rows, so marking and
    counting take no pass of their own.  Key rules look beyond a row and need `check_rules`.
    """
    if any(rule.bad is None for rule in rules):
        raise ValueError("rules on keys look beyond a row: use check_rules")
    counts = Observation()
    marked = df.withColumn("_violations", F.array_compact(F.array(*[F.when(rule.bad, F.lit(rule.name)) for rule in rules])))
    metrics = [F.count(F.when(F.array_contains("_violations", rule.name), 1)).alias(rule.name) for rule in rules]
    return marked.observe(counts, F.count("*").alias("rows"), *metrics), counts


def violation_counts(reports: list[DataFrame]) -> DataFrame:
    """Violations per table and rule over several reports."""
    rows = reduce(DataFrame.unionByName, reports)
    return rows.groupBy("table", "rule").agg(F.count("*").alias("violations"))


def rule_checklist(reports: dict[str, DataFrame]) -> DataFrame:
    """One requirement per rule report: ``met`` when the report is empty."""
    parts = [
        report.agg(F.count("*").alias("violations")).select(
            F.lit(number).alias("requirement_id"), F.lit(text).alias("requirement_description"), "violations"
        )
        for number, (text, report) in enumerate(reports.items(), start=1)
    ]
    rows = reduce(DataFrame.unionByName, parts)
    return rows.withColumn("status", F.when(F.col("violations") == 0, "met").otherwise("open"))


def payment_reconciliation(items: DataFrame, payments: DataFrame, tol: float = 0.01) -> DataFrame:
    """Orders whose payments do not add up to price plus freight."""
    due = items.groupBy("order_id").agg(F.sum(F.col("price") + F.col("freight_value")).alias("due"))
    paid = payments.groupBy("order_id").agg(F.sum("payment_value").alias("paid"))
    gap = F.coalesce(F.col("paid"), F.lit(0)) - F.coalesce(F.col("due"), F.lit(0))
    return due.join(paid, "order_id", "full_outer").withColumn("difference", gap).where(F.abs("difference") > tol)


def migration_count_check(old: DataFrame, new: DataFrame) -> DataFrame:
    """Row counts before and after a move, with a verdict."""
    counts = old.agg(F.count("*").alias("old_rows")).select("old_rows", new.agg(F.count("*")).scalar().alias("new_rows"))
    return counts.withColumn(
        "result", F.when(F.col("old_rows") == F.col("new_rows"), F.lit("OK")).otherwise(F.lit("MISMATCH"))
    )


#: Column that holds a document as it was read, as VARIANT.
DOCUMENT = "_document"


@dataclass(frozen=True)
class Field:
    """Constraint on one (possibly nested) field of a document.

    ``kind`` is the JSON type.  It is checked on the document as it was read where that
    is at hand (column ``_document``, see ``sources.io.read_documents``), or on a field
    held as VARIANT; a typed column alone has lost what did not fit.
    """

    path: str
    required: bool = False
    low: float | None = None
    high: float | None = None
    allowed: tuple[str, ...] | None = None
    min_length: int | None = None
    max_length: int | None = None
    item_low_length: int | None = None
    kind: str | None = None
    within: str | None = None


# Variant schema prefixes of each document type name.
VARIANT_KINDS = {
    "string": ("STRING",),
    "int": ("BIGINT",),
    "double": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"),
    "bool": ("BOOLEAN",),
    "object": ("OBJECT",),
    "array": ("ARRAY",),
    "date": ("TIMESTAMP", "DATE"),
}


def _kind_fits(raw: Column, kind: str) -> Column:
    shape = F.schema_of_variant(raw)
    if kind == "date":  # JSON writes a date as text
        text = F.try_variant_get(raw, "$", "string")
        return F.coalesce(shape.startswith("STRING") & F.try_to_timestamp(text).isNotNull(), F.lit(False))
    return reduce(lambda a, b: a | b, [shape.startswith(p) for p in VARIANT_KINDS[kind]])


def _field_problems(rule: Field, document: Column | None, held_as_variant: bool) -> list[Column]:
    value = F.col(rule.path)
    raw = value if held_as_variant else None
    if document is not None:
        raw = F.try_variant_get(document, "$." + rule.path, "variant")
    problems: list[Column] = []

    def add(bad: Column, what: str) -> None:
        problems.append(F.when(bad, F.lit(f"{rule.path}: {what}")))

    missing = value.isNull() if document is None else raw.isNull() | F.is_variant_null(raw)
    if rule.required:
        absent = missing
        if rule.within:  # required inside an optional sub-document
            absent = missing & F.col(rule.within).isNotNull()
        add(absent, "required")
    if rule.kind is not None and raw is not None:
        add(~missing & ~_kind_fits(raw, rule.kind), f"not {rule.kind}")
    if rule.low is not None:
        add(value < rule.low, f"below {rule.low:g}")
    if rule.high is not None:
        add(value > rule.high, f"above {rule.high:g}")
    if rule.allowed is not None:
        add(~value.isin(list(rule.allowed)), "not allowed")
    if rule.min_length is not None:
        add(F.char_length(value) < rule.min_length, "too short")
    if rule.max_length is not None:
        add(F.char_length(value) > rule.max_length, "too long")
    if rule.item_low_length is not None:
        add(F.exists(value, lambda e: e.isNull() | (F.char_length(e) < rule.item_low_length)), "bad item")
    return problems


def validate_documents(df: DataFrame, rules: list[Field], mode: str = "warn") -> DataFrame:
    """Check nested documents in one projection.

    ``warn`` keeps every row and adds ``_violations``; ``error`` keeps only
    the rows without a violation.
    """
    if mode not in ("warn", "error"):
        raise ValueError("mode must be 'warn' or 'error'")
    document = F.col(DOCUMENT) if DOCUMENT in df.columns else None
    variant = {rule.path: df.select(rule.path).schema[0].dataType.simpleString() == "variant" for rule in rules if rule.kind}
    problems = [p for rule in rules for p in _field_problems(rule, document, variant.get(rule.path, False))]
    found = F.array_compact(F.array(*problems))
    if mode == "warn":
        return df.withColumn("_violations", found)
    return df.where(F.size(found) == 0)
