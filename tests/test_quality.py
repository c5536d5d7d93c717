from datetime import date

import pytest
from pyspark.sql import functions as F

from tallybook.functions.numbers import money_sum
from tallybook.operators.profile import (
    compare,
    duplicate_count,
    is_empty,
    missing_categories,
    null_checks,
    null_profile,
    null_profile_by_partition,
    one_row,
    reconcile,
)
from tallybook.plans.quality import Check, account_check, alerts, long_report, quality_report
from tallybook.plans.status import daily_status
from tallybook.schemas import ACCOUNTS, TABLE_STATS, struct

D0, D1 = date(2024, 1, 2), date(2024, 1, 1)


def one(df):
    got = df.collect()
    assert len(got) == 1
    return got[0].asDict()


def frame(spark, rows):
    return spark.createDataFrame(rows, "partition_date date, k string, v double, tags array<string>")


def test_profiles(spark):
    df = frame(spark, [(D0, None, 1.0, []), (D0, "a", None, None), (D1, "a", None, ["x"])])
    checks = null_checks({"null_k": "k", "null_v": "v"}) | {"null_tags": is_empty(F.col("tags"))}
    assert one(null_profile(df, checks, total="total_rows")) == {"null_k": 1, "null_v": 2, "null_tags": 2, "total_rows": 3}
    assert one(null_profile(df.where("false"), checks, total="n")) == {"null_k": 0, "null_v": 0, "null_tags": 0, "n": 0}
    assert one(null_profile_by_partition(df, null_checks({"null_v": "v"}))) == {"partitions_null": "2024-01-01; 2024-01-02", "null_v": 2}
    assert one(null_profile_by_partition(df, null_checks({"null_d": "partition_date"})))["partitions_null"] is None


def test_compare(spark):
    df = frame(spark, [(D0, "a", 11.0, None), (D0, "a", None, None), (D0, "b", None, None), (D1, "a", 10.0, None), (date(2023, 1, 1), "z", 9.0, None)])
    args = {"counts": {"rows": F.count(F.lit(1))}, "distinct": {"keys": "k"}, "sums": {"v": money_sum(F.col("v"))}, "nulls": null_checks({"null_v": "v"})}
    got = one(compare(df, "partition_date", D0, D1, **args))
    assert (got["total_rows_0d"], got["total_rows_1d"], got["total_rows_diff"]) == (3, 1, 2)
    assert (got["total_keys_0d"], got["total_keys_diff"], got["null_v"]) == (2, 1, 2)
    assert (got["total_v_pct_chg"], got["total_v_pct_chg_abs"]) == (10.0, 10.0)
    # a day that is not there counts zero, and a change against nothing is unknown
    got = one(compare(df, "partition_date", D0, date(2020, 1, 1), **args))
    assert (got["total_rows_1d"], got["total_keys_1d"], got["total_v_1d"], got["total_v_pct_chg"]) == (0, 0, None, None)
    zero = frame(spark, [(D0, "a", 5.0, None), (D1, "a", 0.0, None)])
    assert one(compare(zero, "partition_date", D0, D1, **args))["total_v_pct_chg_abs"] is None


def test_duplicates_and_reconcile(spark):
    df = frame(spark, [(D0, None, 1.0, None), (D0, None, 2.0, None), (D0, "a", 3.0, None), (None, "a", 3.0, None), (None, "a", 3.0, None)])
    assert one(duplicate_count(df, ["partition_date", "k"])) == {"duplicates": 2}
    dated = F.col("partition_date").isNotNull()
    assert one(duplicate_count(df, ["partition_date", "k"], dated, "n")) == {"n": 1}
    a = spark.createDataFrame([(0.1,), (0.2,)], "amount double")
    b = spark.createDataFrame([(0.25,)], "amount double")
    assert one(reconcile(a, b)) == {"total_value_0d": 0.3, "total_value_source": 0.25, "total_value_diff": 0.05}
    assert one(one_row(a.agg(F.max("amount").alias("x")), b.agg(F.max("amount").alias("y")))) == {"x": 0.2, "y": 0.25}


def test_sums_keep_small_parts_and_large_values(spark):
    many = spark.range(1000).select(F.lit(0.004).alias("amount"))
    large = spark.createDataFrame([(1e17,), (2e17,)], "amount double")
    assert one(many.agg(money_sum(F.col("amount")).alias("x"))) == {"x": 4.0}
    assert one(large.agg(money_sum(F.col("amount")).alias("x"))) == {"x": 3e17}


def test_missing_categories(spark):
    tx = spark.createDataFrame([("B", "2"), ("A", "1"), ("A", "1"), ("C", "skip"), (None, "3"), ("D", None)], "category_raw string, subcategory_raw string")
    budget = spark.createDataFrame([("B", "2")], "category_raw string, subcategory_raw string")
    got = one(missing_categories(tx, budget, ["skip"]))
    assert got == {"missing_categories": "A - 1", "missing_categories_count": 1}
    none = one(missing_categories(tx.where("category_raw = 'B'"), budget))
    assert none == {"missing_categories": None, "missing_categories_count": 0}


def report(spark, **metrics):
    values = ", ".join(f"CAST({'NULL' if v is None else v} AS DOUBLE) AS {k}" for k, v in metrics.items())
    return spark.sql(f"SELECT DATE'2024-01-02' AS partition_0d, DATE'2024-01-01' AS partition_1d, {values}")


def fired(df):
    return {(r.check, r.rule) for r in df.collect()}


def test_alert_rules(spark):
    check = {"x": Check(diff_excluded=("value",), pct=("value",))}
    quiet = report(spark, null_a=0, null_b=None, total_n_diff=0, total_value_diff=5, total_value_pct_chg_abs=10)
    assert fired(alerts({"x": quiet}, checks=check)) == set()  # ten percent exactly is no alert
    unknown = report(spark, null_a=0, total_n_diff=0, total_value_pct_chg_abs=None)
    assert fired(alerts({"x": unknown}, checks=check)) == set()
    loud = report(spark, null_a=1, null_b=0, total_n_diff=1, total_m_diff=-1, total_n_0d=4, total_value_0d=3, total_value_pct_chg_abs=10.01)
    got = alerts({"x": loud}, checks=check)
    assert fired(got) == {("x", "null"), ("x", "diff"), ("x", "pct")}
    shown = {(r.rule, r.metric): (r.value, r.total) for r in got.collect()}
    assert shown == {
        ("null", "null_a"): (1.0, 1.0), ("null", "null_b"): (0.0, 1.0),
        ("diff", "total_n_diff"): (1.0, 2.0), ("diff", "total_m_diff"): (-1.0, 2.0), ("diff", "total_n_0d"): (4.0, 2.0),
        ("pct", "total_value_0d"): (3.0, 10.01), ("pct", "total_value_pct_chg_abs"): (10.01, 10.01),
    }
    assert ("x", "diff") not in fired(alerts({"x": loud}, signed=True, checks=check))
    assert ("x", "pct") not in fired(alerts({"x": loud}, pct=11, checks=check))


def test_empty_and_missing_alerts(spark):
    empty = report(spark, null_a=0, total_rows=0)
    assert fired(alerts({"x": empty}, checks={"x": Check(empty=True)})) == {("x", "empty")}
    assert fired(alerts({"x": report(spark, null_a=0, total_rows=3)}, checks={"x": Check(empty=True)})) == set()
    gap = report(spark, null_a=0, missing_categories_count=2).withColumn("missing_categories", F.lit("A - 1; B - 2"))
    got = alerts({"x": gap}, checks={"x": Check(missing=True)}).collect()
    assert [(r.rule, r.value, r.detail) for r in got] == [("missing", 2.0, "A - 1; B - 2")]


def accounts(spark, rows):
    schema = type(ACCOUNTS)([*ACCOUNTS.fields, struct(("partition_date", "date")).fields[0]])
    return spark.createDataFrame([{"partition_date": d, "item_id": i, "account_id": a, "account_source": s, "products": p, "balance": {"current": b}} for d, i, a, s, p, b in rows], schema)


def test_account_check(spark):
    df = accounts(spark, [(D0, "i", "a", "BANK", ["x"], 2.0), (D0, "i", None, "BANK", [], 3.0), (D0, "j", None, "CRYPTO", None, None), (D1, "i", "a", "BANK", ["x"], 4.0)])
    got = one(account_check(df, D0, D1))
    assert got["null_account_id"] == 1 and got["null_products"] == 1 and got["null_balance_current"] == 1
    assert (got["total_items_diff"], got["total_accounts_diff"], got["total_account_value_pct_chg"]) == (1, 2, 25.0)
    # the newest days are found by the report itself
    same = one(quality_report({"accounts": df})["accounts"])
    assert same == got
    with pytest.raises(ValueError, match="fewer than 2"):
        quality_report({"accounts": df.where("partition_date = DATE'2024-01-02'")})
    long = {r.metric: r.value for r in long_report({"accounts": account_check(df, D0, D1)}).collect()}
    assert long["total_items_diff"] == 1.0 and "partition_0d" not in long


def test_daily_status(spark):
    stats = spark.createDataFrame(
        [
            ("ledger", "tx_20240101", 0, 1000, 5, 10), ("ledger", "tx_20240102", 0, 86_400_000, 6, 2048),
            ("ledger", "temp_cursors", 0, 0, 1, 1), ("budget_values", "budget_202312", 0, 0, 1, 1), ("budget_values", "budget_202401", 0, 0, 2, 1),
        ],
        TABLE_STATS,
    )
    got = [(r.partition_date, r.table_id, r.last_modified_time, r.row_count, r.table_size) for r in daily_status(stats).collect()]
    assert got == [
        ("20240102", "tx_20240102", "1970-01-02 00:00:00", 6, "2 KB"),
        ("202401", "budget_202401", "1970-01-01 00:00:00", 2, "1 B"),
        (None, "temp_cursors", "1970-01-01 00:00:00", 1, "1 B"),
    ]
