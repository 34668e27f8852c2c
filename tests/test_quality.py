from decimal import Decimal
from functools import reduce

import pytest
from shop_data import at

from mercato.operators import filters, quality
from mercato.sources.schemas import PAYMENT_TYPES, STATE_PATTERN, ZIP_PATTERN


def keys(df):
    return sorted((r["key"], r["observed"]) for r in df.collect())


@pytest.fixture(scope="module")
def customers(spark):
    data = [("1", "12345", "SP"), ("2", "1234", "SP"), ("3", "12345", "sp"), ("4", None, None), ("4", "99999", "RJ")]
    return spark.createDataFrame(data, "id STRING, zip STRING, state STRING")


@pytest.fixture(scope="module")
def payments(spark):
    data = [("o1", 1, "boleto", 1, Decimal("5")), ("o1", 1, "cash", 25, Decimal("0")), ("o2", 1, None, None, None), ("zz", 1, "voucher", 24, Decimal("-1"))]
    return spark.createDataFrame(data, "order_id STRING, seq INT, type STRING, installments INT, value DECIMAL(10,2)")


def test_checks_pass_on_null(customers, payments):
    assert keys(quality.rule_regex(customers, "c", ["id"], "zip", ZIP_PATTERN)) == [("2", "1234")]
    assert keys(quality.rule_regex(customers, "c", ["id"], "state", STATE_PATTERN)) == [("3", "sp")]
    assert keys(quality.rule_length(customers, "c", ["id"], "zip", 5, 5)) == [("2", "4")]
    assert keys(quality.rule_length(customers, "c", ["id"], "zip", high=4)) == [("1", "5"), ("3", "5"), ("4", "5")]
    assert keys(quality.rule_between(payments, "p", ["order_id"], "installments", 1, 24)) == [("o1", "25")]
    assert keys(quality.rule_in_set(payments, "p", ["order_id"], "type", PAYMENT_TYPES)) == [("o1", "cash")]
    assert keys(quality.rule_min(payments, "p", ["order_id"], "value", 0)) == [("zz", "-1.00")]
    assert keys(quality.rule_min(payments, "p", ["order_id"], "value", 0, strict=True)) == [("o1", "0.00"), ("zz", "-1.00")]


def test_not_null_unique_foreign_key(spark, customers, payments):
    assert keys(quality.rule_not_null(customers, "c", ["id"], "zip")) == [("4", None)]
    assert keys(quality.rule_unique(customers, "c", ["id"])) == [("4", "2")]
    assert keys(quality.rule_unique(payments, "p", ["order_id", "seq"])) == [("o1|1", "2")]
    orders = spark.createDataFrame([("o1",), ("o2",), (None,)], "order_id STRING")
    assert keys(quality.rule_foreign_key(payments, "p", "order_id", orders, "order_id")) == [("zz", "1")]
    assert keys(quality.rule_foreign_key(payments, "p", "type", orders, "order_id")) == [("boleto", "1"), ("cash", "1"), ("voucher", "1")]


def test_order_of_dates(spark):
    data = [("a", at("2020-01-02"), at("2020-01-01")), ("b", at("2020-01-02"), None), ("c", at("2020-01-02"), at("2020-01-02"))]
    df = spark.createDataFrame(data, "k STRING, bought TIMESTAMP_NTZ, approved TIMESTAMP_NTZ")
    assert [k for k, _ in keys(quality.rule_order(df, "o", ["k"], "bought", "approved"))] == ["a"]


def test_counts_and_checklist(customers):
    zips = quality.rule_regex(customers, "c", ["id"], "zip", ZIP_PATTERN)
    states = quality.rule_in_set(customers, "c", ["id"], "state", ["SP", "sp", "RJ"])
    counts = quality.violation_counts([zips, states, zips]).collect()
    assert [(r["rule"], r["violations"]) for r in counts] == [("zip regex", 2)]
    found = quality.rule_checklist({"zips": zips, "states": states}).orderBy("requirement_id").collect()
    assert [(r["requirement_description"], r["status"]) for r in found] == [("zips", "open"), ("states", "met")]


def test_reconciliation_covers_both_sides(shop):
    found = {r["order_id"]: r["difference"] for r in quality.payment_reconciliation(shop.items, shop.payments).collect()}
    assert found["fan"] == Decimal("-2.00") and found["open1"] == Decimal("500.00") and found["early"] == Decimal("-5.50")


def test_count_check(spark):
    old = spark.range(3)
    assert quality.migration_count_check(old, spark.range(3)).first()["result"] == "OK"
    assert quality.migration_count_check(old, spark.range(2)).first()["result"] == "MISMATCH"


def test_not_in_is_null_aware(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x INT")
    listed = lambda *v: spark.createDataFrame([(i,) for i in v], "y INT")
    values = lambda out: sorted((r["x"] is None, r["x"]) for r in out.collect())
    assert values(filters.not_in(df, "x", listed(1), "y")) == [(False, 2)]
    assert values(filters.not_in(df, "x", listed(1, None), "y")) == []
    assert values(filters.not_in(df, "x", listed(1).where("y > 5"), "y")) == [(False, 1), (False, 2), (True, None)]


def test_like_any_and_exists(spark):
    df = spark.createDataFrame([("orders_gin",), ("orders_brin",), ("plain",)], "n STRING")
    assert filters.like_any(df, "n", ["%gin%", "%brin%"]).count() == 2
    assert filters.unless_exists(df, spark.range(0)).count() == 3
    assert filters.unless_exists(df, spark.range(2)).count() == 0


def everything(customers, payments, orders):
    pairs = [
        (customers, "c", [
            (quality.matches(["id"], "zip", ZIP_PATTERN), quality.rule_regex(customers, "c", ["id"], "zip", ZIP_PATTERN)),
            (quality.matches(["id"], "state", STATE_PATTERN), quality.rule_regex(customers, "c", ["id"], "state", STATE_PATTERN)),
            (quality.long_between(["id"], "zip", 5, 5), quality.rule_length(customers, "c", ["id"], "zip", 5, 5)),
            (quality.long_between(["id"], "zip", high=4), quality.rule_length(customers, "c", ["id"], "zip", high=4)),
            (quality.present(["id", "zip"], "zip"), quality.rule_not_null(customers, "c", ["id", "zip"], "zip")),
            (quality.unique(["id"]), quality.rule_unique(customers, "c", ["id"])),
            (quality.unique(["id", "zip"]), quality.rule_unique(customers, "c", ["id", "zip"])),
        ]),
        (payments, "p", [
            (quality.at_least(["order_id"], "value", 0), quality.rule_min(payments, "p", ["order_id"], "value", 0)),
            (quality.between(["order_id"], "installments", 1, 24), quality.rule_between(payments, "p", ["order_id"], "installments", 1, 24)),
            (quality.one_of(["order_id"], "type", PAYMENT_TYPES), quality.rule_in_set(payments, "p", ["order_id"], "type", PAYMENT_TYPES)),
            (quality.known("order_id", orders, "order_id"), quality.rule_foreign_key(payments, "p", "order_id", orders, "order_id")),
            (quality.known("type", orders, "order_id"), quality.rule_foreign_key(payments, "p", "type", orders, "order_id")),
            (quality.unique(["order_id", "seq"]), quality.rule_unique(payments, "p", ["order_id", "seq"])),
        ]),
    ]
    return pairs


def shown(reports):
    return sorted((tuple(r) for report in reports for r in report.collect()), key=str)


def test_rules_in_one_pass_report_what_single_rules_do(spark, customers, payments):
    orders = spark.createDataFrame([("o1",), ("o2",), (None,)], "order_id STRING")
    # Repeated rows break a rule once each.
    for copies in (1, 3):
        twice = [reduce(type(df).unionAll, [df] * copies) for df in (customers, payments)]
        for df, table, rules in everything(*twice, orders):
            assert shown([quality.check_rules(df, table, [r for r, _ in rules])]) == shown([single for _, single in rules])


def test_rules_on_an_empty_table(customers):
    rules = [quality.matches(["id"], "zip", ZIP_PATTERN), quality.unique(["id"])]
    assert quality.check_rules(customers.limit(0), "c", rules).count() == 0


def test_one_scan_for_all_rules(spark, customers, tmp_path, capsys):
    customers.write.parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    rules = [quality.matches(["id"], "zip", ZIP_PATTERN), quality.present(["id"], "state"), quality.unique(["id"]), quality.unique(["zip"])]
    quality.violation_counts([quality.check_rules(stored, "c", rules)]).explain()
    assert capsys.readouterr().out.count("FileScan") == 1


def test_counts_come_with_the_write(customers, tmp_path):
    rules = [quality.matches(["id"], "zip", ZIP_PATTERN), quality.matches(["id"], "state", STATE_PATTERN)]
    marked, counts = quality.observe_rules(customers, rules)
    marked.write.parquet(str(tmp_path / "marked"))
    assert counts.get == {"rows": 5, "zip regex": 1, "state regex": 1}
    assert sorted(v for r in marked.collect() for v in r["_violations"]) == ["state regex", "zip regex"]
    with pytest.raises(ValueError, match="check_rules"):
        quality.observe_rules(customers, [quality.unique(["id"])])


def test_rows_that_may_be_listed(spark):
    """All listed rows pass and hardly any other, whatever the integer type; a filter that is full lets all through."""
    df = spark.range(20_000).selectExpr("id", "CAST(id AS INT) AS key").unionAll(spark.sql("SELECT 7L, CAST(NULL AS INT)"))
    listed = spark.range(0, 20_000, 100).selectExpr("id AS key").unionAll(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    found = {r["key"] for r in filters.may_be_in(df, "key", listed).collect()}
    assert found >= set(range(0, 20_000, 100)) and len(found) < 220 and None not in found
    assert len({r["key"] for r in filters.may_be_in(df, "key", listed, bits=64).collect()} & set(range(0, 20_000, 100))) == 200
    assert filters.may_be_in(df, "key", listed.limit(0)).count() == 0
