import datetime as dt

import pytest
from pyspark.sql import functions as F

from mercato.functions import dates, jsonq, numeric, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def stamp(value):
    return F.lit(value).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "later, earlier, expected",
    [
        ("2017-03-07 23:00:00", "2017-03-10 00:00:00", (-2, -3, -3)),
        ("2017-03-08 00:00:00", "2017-03-10 01:00:00", (-2, -2, -3)),
        ("2017-03-11 01:00:00", "2017-03-10 23:00:00", (0, 1, 0)),
        ("2017-03-12 00:00:00", "2017-03-10 00:00:00", (2, 2, 2)),
    ],
)
def test_three_day_counts(spark, later, earlier, expected):
    a, b = stamp(later), stamp(earlier)
    counts = (dates.days_trunc(a, b), dates.days_calendar(a, b), dates.days_floor(a, b))
    assert tuple(one(spark, c) for c in counts) == expected


def test_months(spark):
    assert one(spark, dates.month_label(stamp("2017-06-30 23:59:59"))) == "2017_06"
    assert one(spark, dates.month_start(stamp("2017-06-30 23:59:59"))) == dt.datetime(2017, 6, 1)


def test_rounding_is_half_away_from_zero(spark):
    assert float(one(spark, numeric.round_half_up(F.lit(2.675), 2))) == 2.68
    assert float(one(spark, numeric.round_half_up(F.lit(-0.125), 2))) == -0.13


def test_percent_of_nothing_is_null(spark):
    assert one(spark, numeric.percent(F.lit(1), F.lit(0), 2)) is None


def contained(spark, document, pattern):
    return one(spark, jsonq.contains(jsonq.parsed(F.lit(document)), pattern))


@pytest.mark.parametrize(
    "document, pattern, expected",
    [
        ('{"voltage": "220V", "x": 1}', {"voltage": "220V"}, True),
        ('{"voltage": 220}', {"voltage": "220"}, False),
        ('{"voltage": "220"}', {"voltage": 220}, False),
        ('{"voltage": 220.0}', {"voltage": 220}, True),
        ('{"w": null}', {"w": None}, True),
        ("{}", {"w": None}, False),
        ('{"ok": true}', {"ok": True}, True),
        ('{"ok": 1}', {"ok": True}, False),
        ('{"a": ["x", "y"]}', {"a": ["y"]}, True),
        ('{"a": ["x", "y"]}', {"a": ["y", "z"]}, False),
        ('{"a": "x"}', {"a": ["x"]}, False),
        ('{"a": [{"b": 1, "c": 2}]}', {"a": [{"b": 1}]}, True),
        ('{"a": {"b": {"c": "d"}, "e": 1}}', {"a": {"b": {"c": "d"}}}, True),
        ('{"a": {"b": {"c": "d"}}}', {"a": {"b": {}}}, True),
        ('{"a": [1]}', {"a": {}}, False),
        ('["x", "y"]', ["y"], True),
        ('["x", "y"]', "y", True),
        ('"y"', "y", True),
        ("not json", {"a": 1}, False),
        (None, {"a": 1}, False),
        ('{"it\'s": "fine"}', {"it's": "fine"}, True),
    ],
)
def test_containment(spark, document, pattern, expected):
    assert contained(spark, document, pattern) is expected


@pytest.mark.parametrize(
    "document, expected",
    [('{"w": null}', True), ('{"w": 1}', True), ('{"x": {"w": 1}}', False), ('["w"]', True), ('["v"]', False), (None, False)],
)
def test_key_existence(spark, document, expected):
    assert one(spark, jsonq.has_key(jsonq.parsed(F.lit(document)), "w")) is expected


def test_any_and_all_keys(spark):
    value = jsonq.parsed(F.lit('{"a": 1, "b": null}'))
    assert one(spark, jsonq.has_any_key(value, ["z", "b"])) is True
    assert one(spark, jsonq.has_all_keys(value, ["a", "b"])) is True
    assert one(spark, jsonq.has_all_keys(value, ["a", "z"])) is False


def test_text_of_null_and_missing_is_null(spark):
    value = jsonq.parsed(F.lit('{"a": null, "n": 7}'))
    assert one(spark, jsonq.text_at(value, "a")) is None
    assert one(spark, jsonq.text_at(value, "b")) is None
    assert one(spark, jsonq.text_at(value, "n")) == "7"


def test_integer_cast_is_strict_unless_safe(spark):
    value = jsonq.parsed(F.lit('{"w": "soon"}'))
    assert one(spark, jsonq.int_at(value, "w", safe=True)) is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, jsonq.int_at(value, "w"))


def test_tokens_fold_and_drop_stop_words(spark):
    found = one(spark, text.tokens(F.lit("Produto de ótima QUALIDADE, não é?")))
    assert found == ["produto", "otima", "qualidade"]


def test_forms_share_one_stem():
    forms = text.word_forms("qualidade dos produtos")
    assert {"qualidade", "qualidades", "produto", "produtos"} <= set(forms)
    assert len({text.stem(f) for f in forms}) == 2


def test_score_counts_weighted_words(spark):
    docs = spark.createDataFrame(
        [("Ótimo produto", "produto bom, produtos bons"), ("nada", "aqui"), (None, "produto")], "title STRING, message STRING"
    )
    scores = docs.select(text.text_score({"title": 10, "message": 5}, "produto").alias("s")).collect()
    assert [r["s"] for r in scores] == [20.0, 0.0, 5.0]


def plain_contains(value, pattern, top=True):
    if isinstance(pattern, dict):
        return isinstance(value, dict) and all(k in value and plain_contains(value[k], p, False) for k, p in pattern.items())
    if isinstance(pattern, list):
        return isinstance(value, list) and all(any(plain_contains(v, p, False) for v in value) for p in pattern)
    if top and isinstance(value, list):
        return any(not isinstance(v, (dict, list)) and plain_contains(v, pattern, False) for v in value)
    return not isinstance(value, (dict, list)) and isinstance(value, bool) == isinstance(pattern, bool) and isinstance(value, str) == isinstance(pattern, str) and (value is None) == (pattern is None) and value == pattern


def test_containment_of_a_column(spark):
    import itertools
    import json

    documents = [
        {}, {"a": 1}, {"a": 1.0, "b": "1"}, {"a": "1"}, {"a": None}, {"a": True}, {"a": {"b": [1, 2, {"c": 3}]}, "z": "z"}, {"a": {"b": [2, 1]}}, {"a": {}}, {"a": {"b": []}},
        [], [1, 2], [2, 1, 1], ["1"], [[1], [2]], [{"a": 1}, {"b": 2}], [{"a": 1, "b": 2}], [None], 1, 1.5, 1e300, "x", "1", True, False, None, {"it's": 1}, {"a.b": 1}, [1, [1, 2]],
    ]
    pairs = list(itertools.product(documents, documents))
    df = spark.createDataFrame([(i, json.dumps(v), json.dumps(p)) for i, (v, p) in enumerate(pairs)], "i INT, v STRING, p STRING")
    found = df.select("i", jsonq.contains_column(jsonq.parsed(F.col("v")), jsonq.parsed(F.col("p")), depth=4).alias("fits")).collect()
    wrong = [pairs[r.i] for r in found if r.fits != plain_contains(*pairs[r.i])]
    assert not wrong


def test_containment_of_nothing_and_of_too_deep_patterns(spark):
    df = spark.createDataFrame([("{}", None), (None, "{}"), ("{", "{}")], "v STRING, p STRING")
    assert [r[0] for r in df.select(jsonq.contains_column(jsonq.parsed(F.col("v")), jsonq.parsed(F.col("p")))).collect()] == [False] * 3
    deep = spark.createDataFrame([('{"a": {"b": 1}}', '{"a": {"b": 1}}')], "v STRING, p STRING")
    assert deep.select(jsonq.contains_column(jsonq.parsed(F.col("v")), jsonq.parsed(F.col("p")), depth=2)).first()[0]
    with pytest.raises(Exception, match="more levels"):
        deep.select(jsonq.contains_column(jsonq.parsed(F.col("v")), jsonq.parsed(F.col("p")), depth=1)).collect()
