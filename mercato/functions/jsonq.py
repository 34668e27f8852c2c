"""Queries on semi-structured attributes held as VARIANT.

Where the pattern is known when the plan is built, each test becomes a conjunction
of typed variant extractions that Spark runs inside the scan stage.  A pattern that is
a column itself is compared level by level (:func:`contains_column`).
"""

from __future__ import annotations

import decimal
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC_SCHEMA = r"^(BIGINT|DECIMAL|DOUBLE|FLOAT)"


def parsed(text: Column) -> Column:
    """JSON text as VARIANT; malformed text becomes NULL."""
    return F.try_parse_json(text)


def _step(key: str) -> str:
    quote = '"' if "'" in key else "'"
    return f"[{quote}{key}{quote}]"


def _at(value: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(value, path, kind)


def _scalar_matches(value: Column, path: str, wanted: object) -> Column:
    found = _at(value, path, "variant")
    kind = F.schema_of_variant(found)
    if wanted is None:
        return F.is_variant_null(found)
    if isinstance(wanted, bool):
        return (kind == "BOOLEAN") & (_at(value, path, "boolean") == F.lit(wanted))
    if isinstance(wanted, str):
        return (kind == "STRING") & (_at(value, path, "string") == F.lit(wanted))
    number = F.lit(decimal.Decimal(str(wanted)).normalize().to_eng_string()).cast("decimal(38,10)")
    return kind.rlike(NUMERIC_SCHEMA) & (_at(value, path, "decimal(38,10)") == number)


def _element_test(wanted: object) -> Callable[[Column], Column]:
    return lambda element: F.coalesce(_contains(element, "$", wanted), F.lit(False))


def _contains(value: Column, path: str, pattern: object) -> Column:
    if isinstance(pattern, Mapping):
        found = F.schema_of_variant(_at(value, path, "variant")).startswith("OBJECT")
        for key, wanted in pattern.items():
            found = found & _contains(value, path + _step(key), wanted)
        return found
    if isinstance(pattern, Sequence) and not isinstance(pattern, str):
        elements = _at(value, path, "array<variant>")
        found = elements.isNotNull()
        for wanted in pattern:
            found = found & F.exists(elements, _element_test(wanted))
        return found
    return _scalar_matches(value, path, pattern)


def contains(value: Column, pattern: object) -> Column:
    """Typed recursive containment: the string "220" does not match the number 220.

    A scalar pattern is also found inside a top-level array.
    """
    found = _contains(value, "$", pattern)
    if not isinstance(pattern, (Mapping, list, tuple)):
        found = F.coalesce(found, F.lit(False)) | F.coalesce(_contains(value, "$", [pattern]), F.lit(False))
    return F.coalesce(found, F.lit(False))


def _same_scalar(value: Column, pattern: Column) -> Column:
    kinds = F.schema_of_variant(value), F.schema_of_variant(pattern)
    typed = lambda kind: F.try_variant_get(value, "$", kind) == F.try_variant_get(pattern, "$", kind)
    numbers = kinds[0].rlike(NUMERIC_SCHEMA) & kinds[1].rlike(NUMERIC_SCHEMA)
    # Numbers beyond the decimals compare as doubles.
    return (
        (F.is_variant_null(value) & F.is_variant_null(pattern))
        | ((kinds[0] == "BOOLEAN") & (kinds[1] == "BOOLEAN") & typed("boolean"))
        | ((kinds[0] == "STRING") & (kinds[1] == "STRING") & typed("string"))
        | (numbers & F.coalesce(typed("decimal(38,10)"), typed("double")))
    )


def _covers(value: Column, pattern: Column, depth: int) -> Column:
    """Containment of one variant in another for patterns of up to ``depth`` levels of objects and arrays."""
    shape = lambda v: F.substring(F.schema_of_variant(v), 1, 5)  # noqa: E731  OBJEC, ARRAY or a scalar's
    scalar = ~shape(value).isin("OBJEC", "ARRAY") & ~shape(pattern).isin("OBJEC", "ARRAY") & _same_scalar(value, pattern)
    if depth == 0:
        deep = F.raise_error(F.lit("the pattern has more levels than contains_column was asked for")).cast("boolean")
        return F.when(shape(pattern).isin("OBJEC", "ARRAY"), deep).otherwise(scalar)
    fields = lambda v: F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))
    items = lambda v: F.try_variant_get(v, "$", "array<variant>")
    yes = lambda test: F.coalesce(test, F.lit(False))
    objects = F.forall(fields(pattern), lambda p: F.exists(fields(value), lambda v: (v["key"] == p["key"]) & yes(_covers(v["value"], p["value"], depth - 1))))
    arrays = F.forall(items(pattern), lambda p: F.exists(items(value), lambda v: yes(_covers(v, p, depth - 1))))
    same = lambda kind: (shape(value) == kind) & (shape(pattern) == kind)
    return F.when(same("OBJEC"), objects).when(same("ARRAY"), arrays).otherwise(scalar)


def contains_column(value: Column, pattern: Column, depth: int = 3) -> Column:
    """Whether each row's ``value`` contains its ``pattern``, both VARIANT.

    The meaning is that of :func:`contains`: every key of an object is there and its value
    contained, every element of an array is contained in some element, scalars are equal
    with their type; a scalar is also found inside a top-level array.  Elements are compared
    as wholes, so two elements never share out one pattern between them.  A NULL on
    either side is no match; a pattern of more than ``depth`` levels is an error.
    """
    element = F.exists(F.try_variant_get(value, "$", "array<variant>"), lambda v: F.coalesce(_same_scalar(v, pattern), F.lit(False)))
    return F.coalesce(_covers(value, pattern, depth), F.lit(False)) | F.coalesce(element, F.lit(False))


def has_key(value: Column, key: str) -> Column:
    """Top-level key present (a JSON null counts), or an array that holds the string."""
    as_member = F.exists(
        _at(value, "$", "array<variant>"),
        lambda e: (F.schema_of_variant(e) == "STRING") & (F.try_variant_get(e, "$", "string") == F.lit(key)),
    )
    return F.coalesce(_at(value, "$" + _step(key), "variant").isNotNull(), F.lit(False)) | F.coalesce(
        as_member, F.lit(False)
    )


def has_any_key(value: Column, keys: list[str]) -> Column:
    """At least one of the keys is present."""
    found = F.lit(False)
    for key in keys:
        found = found | has_key(value, key)
    return found


def has_all_keys(value: Column, keys: list[str]) -> Column:
    """Every one of the keys is present."""
    found = F.lit(True)
    for key in keys:
        found = found & has_key(value, key)
    return found


def text_at(value: Column, key: str) -> Column:
    """Value of a top-level key as text; JSON null and a missing key are both NULL."""
    return _at(value, "$" + _step(key), "string")


def int_at(value: Column, key: str, safe: bool = False) -> Column:
    """Value of a top-level key as an integer; bad text is an error unless ``safe``."""
    text = text_at(value, key)
    return text.try_cast("int") if safe else text.cast("int")


def keys_of(text: Column) -> Column:
    """Top-level keys of a JSON text."""
    return F.json_object_keys(text)
