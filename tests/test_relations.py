"""Joins, dedup, rules and budgets on rows that matter."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallybook.operators.budgeting import (
    actuals,
    balance_rows,
    budget_totals,
    budget_vs_actual,
    categorize,
    with_balance,
)
from tallybook.operators.dedup import apply_tombstones, current_view, latest_by
from tallybook.operators.joins import enrich, existing_keys, missing_keys
from tallybook.operators.rules import apply_rules, load_rules, resolve_name, with_rules
from tallybook.operators.shape import conform, union_all
from tallybook.plans.mart import MartRules, account_balances, account_labels, positions
from tallybook.schemas import ACCOUNTS, HOLDINGS, struct


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_null_keys_group_in_dedup_but_never_join(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1), ("a", 3)], "k string, v int")
    assert rows(latest_by(df, ["k"], [F.desc("v")])) == [("a", 3), (None, 2)]
    dim = spark.createDataFrame([(None, "x"), ("a", "y")], "k string, name string")
    assert {tuple(r) for r in enrich(df, dim, ["k"]).collect()} == {
        (None, 1, None), (None, 2, None), ("a", 1, "y"), ("a", 3, "y"),
    }
    assert rows(missing_keys(df, dim, ["k"])) == [(None, 1), (None, 2)]


def test_required_lookup(spark):
    dim = spark.createDataFrame([("a", "y")], "k string, name string")
    ok = spark.createDataFrame([("a",), (None,)], "k string")
    assert enrich(ok, dim, ["k"], required=True).count() == 2
    bad = spark.createDataFrame([("z",)], "k string")
    with pytest.raises(Exception, match="no match for key z"):
        enrich(bad, dim, ["k"], required=True).collect()


def test_existing_keys(spark):
    new = spark.createDataFrame([("p1", "a1"), (None, "a2"), ("p3", None), ("p4", "a4"), (None, None)], "p string, a string")
    old = spark.createDataFrame([("p1", None), (None, "a2"), (None, None), ("p1", "a9")], "p string, a string")
    assert rows(existing_keys(new, old, ["p", "a"])) == [("p1", "a1"), (None, "a2")]
    assert rows(existing_keys(new, old, ["a"]).select("p", "a")) == [(None, "a2")]


D = [date(2024, 1, d) for d in range(1, 10)]


def test_tombstones(spark):
    tx = spark.createDataFrame([(k, D[4]) for k in ("none", "early", "same", "late", "two", "null", "both")], "t string, d date")
    removed = spark.createDataFrame(
        [("early", D[3]), ("same", D[4]), ("late", D[5]), ("two", D[6]), ("two", D[2]), ("null", None), ("both", None), ("both", D[2]), ("other", D[0])],
        "t string, date_removed date",
    )
    kept = apply_tombstones(tx, removed, ["t"], "d")
    assert sorted(r.t for r in kept.collect()) == ["both", "early", "none", "two"]


def test_current_view(spark):
    versions = spark.createDataFrame(
        [
            ("i", "a", "t1", D[1], "ADDED", D[1], None, 1),
            ("i", "a", "t1", D[1], "MODIFIED", D[1], None, 2),  # equal time: the modified one
            ("i", "a", "t2", D[1], "ADDED", D[1], datetime(2024, 1, 2, 5), 3),
            ("i", "a", "t2", D[2], "MODIFIED", D[1], None, 4),  # its day starts earlier
            ("i", "a", "t3", D[1], "ADDED", D[1], None, 5),
            ("i", "a", "t4", D[1], "ADDED", D[1], None, 6),  # removed, then added again
            ("i", "a", "t4", D[5], "ADDED", D[5], None, 7),
        ],
        "item_id string, account_id string, transaction_id string, partition_date date, status string, transaction_date date, transaction_datetime timestamp_ntz, v int",
    ).selectExpr("*", "1.0D amount", "CAST(NULL AS BIGINT) feed_page", "CAST(NULL AS BIGINT) feed_place")
    gone = spark.createDataFrame([("i", "a", "t3", D[2]), ("i", "a", "t4", D[3])], "item_id string, account_id string, transaction_id string, date_removed date")
    got = {r.transaction_id: r.v for r in current_view(versions, gone).collect()}
    assert got == {"t1": 2, "t2": 3, "t4": 7}


def test_one_position_per_security_and_day(spark):
    def h(account, sid, day, price_day, value, ticker=None, name="n"):
        return {"item_id": "i", "account_id": account, "institution_value": value, "institution_price_date": price_day,
                "partition_date": day, "security": {"security_id": sid, "name": name, "ticker_symbol": ticker}}

    schema = type(HOLDINGS)([*HOLDINGS.fields, struct(("partition_date", "date")).fields[0]])
    df = spark.createDataFrame(
        [
            h("a", "s", D[0], D[0], 1.0), h("b", "s", D[0], D[0], 2.0, "T"), h("b", "s", D[1], D[0], 9.0),
            h("a", None, D[0], D[0], 3.0, name=None), h("b", None, D[0], D[0], 4.0, name=None), h("c", None, D[0], None, 5.0, name=None),
        ],
        schema,
    )
    got = {(r.security_id, r.partition_date): (r.account_id, r.institution_value, r.ticker_symbol) for r in positions(df).collect()}
    assert got == {("s", D[0]): ("b", 2.0, "T"), ("s", D[1]): ("b", 9.0, "n"), (None, D[0]): ("b", 4.0, None)}
    per_account = positions(df, ("security_id", "partition_date", "account_id"))
    assert per_account.count() == 6


def test_account_labels(spark):
    def a(item, account, name, kind, subtype, bank, current, day):
        return {"item_id": item, "account_id": account, "account_name": name, "account_type": kind, "account_subtype": subtype,
                "institution_name": bank, "balance": {"current": current, "currency_code": "USD"}, "partition_date": day}

    schema = type(ACCOUNTS)([*ACCOUNTS.fields, struct(("partition_date", "date")).fields[0]])
    df = spark.createDataFrame(
        [
            a("i", "1", "Savings 7", "investment", "529", "Blue Bank", 1.0, D[0]),
            a("i", "2", "Joint", "credit", "credit card", "Blue Bank", 7.0, D[0]),
            a("x", None, "BTC", "investment", "cryptocurrency", None, 2.0, D[0]),
            a("x", None, "ETH", "investment", "cryptocurrency", None, 3.0, D[1]),
            a("i", "3", "n", "depository", "money market and more", "Green Bank", None, D[0]),
            a("i", "4", "n", "loan", "auto", "Elsewhere", 4.0, D[0]),
        ],
        schema,
    )
    bank, coin = ({"col": c, "op": "eq", "value": v} for c, v in (("institution_name", "Blue Bank"), ("account_subtype", "cryptocurrency")))
    saved = {"col": "account_name", "op": "like", "value": "Savings %"}
    rules = MartRules(
        account_name=[{"when": bank, "then": "Blue"}, {"when": coin, "then": "Crypto"}],
        account_subname=[
            {"when": {"all": [bank, saved]}, "then": "Saved"},
            {"when": {"any": [bank, coin]}, "then": {"col": "account_name"}},
            {"when": {"col": "institution_name", "op": "in", "value": ["Green Bank"]}, "then": {"col": "subtype_title"}},
        ],
    )
    b = account_balances(df, rules)
    got = {(r.item_id, r.account_id, r.account_subname): (r.account_name, r.account_type, r.actual_amount) for r in b.collect()}
    # rules see the stored account name, not the label beside them
    assert got == {
        ("i", "1", "Saved"): ("Blue", "Investment", 1.0),
        ("i", "2", "Joint"): ("Blue", "Credit", -7.0),
        ("x", None, "BTC"): ("Crypto", "Investment", 2.0),
        ("x", None, "ETH"): ("Crypto", "Investment", 3.0),
        ("i", "3", "Money Market and More"): ("Green Bank", "Depository", None),
        ("i", "4", "Elsewhere"): ("Elsewhere", "Loan", 4.0),
    }
    newest = account_labels(b)
    assert newest.count() == 5 and newest.where("account_id IS NULL").first().account_subname == "ETH"


def test_rules_first_match_and_nulls(spark):
    df = spark.createDataFrame([("a", -1.0), ("a", 0.0), ("a", None), (None, 1.0), ("B", 2.0)], "m string, x double")
    rules = [
        {"when": {"all": [{"col": "m", "op": "eq", "value": "a"}, {"col": "x", "op": "lt", "value": 0}]}, "then": "in"},
        {"when": {"all": [{"col": "m", "op": "eq", "value": "a"}, {"col": "x", "op": "gt", "value": 0}]}, "then": "out"},
        {"when": {"col": "m", "op": "not_in", "value": ["a"]}, "then": "other"},
        {"when": {"col": "m", "op": "eq", "value": "b", "fold": True}, "then": "never: an earlier rule matched"},
    ]
    got = df.select(apply_rules(rules, F.lit("raw"))).collect()
    assert [r[0] for r in got] == ["in", "raw", "raw", "raw", "other"]
    with pytest.raises(ValueError, match="unknown rule operator"):
        apply_rules([{"when": {"col": "m", "op": "near", "value": 1}, "then": "x"}], F.lit(1))
    assert apply_rules([], F.lit("raw")) is not None


def test_rules_file(tmp_path):
    path = tmp_path / "r.json"
    path.write_text('[{"when": {"col": "m", "op": "eq", "value": "a"}, "then": "x"}]')
    assert load_rules(str(path))[0]["then"] == "x"


def test_resolve_name(spark):
    df = spark.createDataFrame(
        [("clean", ["c"], "r"), (None, ["c"], "r"), (None, [], "ACME DES:X"), (None, None, "ACME"), (None, None, None), (None, [None], "")],
        "clean string, parties array<string>, raw string",
    )
    rules = [{"when": {"col": "raw", "op": "regex", "value": "DES:"}, "then": {"col": "raw", "extract": "^(.*?)(?: DES:|$)"}}]
    got = df.select(resolve_name(F.col("clean"), F.col("parties"), rules, F.col("raw"))).collect()
    assert [r[0] for r in got] == ["clean", "c", "ACME", "ACME", None, ""]


def test_union_and_conform(spark):
    a = spark.createDataFrame([(1, "2024-01-02")], "a int, d string")
    b = spark.createDataFrame([("x", "not a date", 2)], "z string, d string, a int")
    both = union_all(a, None, b)
    schema = struct(("d", "date"), ("a", "string"), ("new", "double"))
    assert rows(conform(both, schema)) == [(None, "2", None), (date(2024, 1, 2), "1", None)]


M = date(2024, 1, 1)
BUDGET = "transaction_month date, transaction_date date, category_raw string, subcategory_raw string, category string, subcategory string, detail_category string, budget_amount double"


def test_budget_vs_actual(spark):
    budget = spark.createDataFrame(
        [
            (M, M, "r1", "s1", "Food", "Out", None, 10.0),
            (M, M, "r2", "s2", "Food", "Out", "null", 20.0),
            (M, M, "r3", "s3", "Food", "Out", "Cafe", 30.0),
            (M, M, "r4", "s4", "Transfer", "x", None, 40.0),
            (M, M, "r5", "s5", None, "x", None, 50.0),
        ],
        BUDGET,
    )
    tx = spark.createDataFrame(
        [("t1", M, "r1", "s1", -1.25), ("t1", M, "r1", "s1", -1.25), ("t2", M, "r2", "s2", 5.0), ("t3", M, "r4", "s4", 9.0), ("t4", M, "zz", "zz", 3.0), ("t5", None, "r1", "s1", 7.0)],
        "transaction_id string, transaction_month date, category_updated string, subcategory_updated string, actual_amount double",
    )
    spent = actuals(categorize(tx, budget))
    lines = budget_vs_actual(budget_totals(budget), spent)
    got = {(r.category, r.detail_category): (r.budget_amount, r.actual_amount, r.transactions_count) for r in lines.collect()}
    # NULL details meet, a literal 'null' is a value, a NULL category goes
    assert got == {("Food", None): (10.0, -2.5, 1), ("Food", "null"): (20.0, 5.0, 1), ("Food", "Cafe"): (30.0, 0.0, 0)}
    total = balance_rows(lines).first()
    assert (total.category, total.budget_amount, total.actual_amount, total.transactions_count) == ("Balance", 60.0, 2.5, 0)
    assert with_balance(lines).count() == 4


def test_long_rule_lists_are_looked_up(spark):
    """First match over a lookup table and a CASE, on several columns, NULLs and repeated values."""
    rules = [{"when": {"col": "x", "op": "gt", "value": 90}, "then": "big"}]
    rules += [{"when": {"col": "m", "op": "eq", "value": f"m{k}"}, "then": f"M{k}"} for k in range(60)]
    rules += [{"when": {"col": "m", "op": "in", "value": ["m1", "late"]}, "then": "IN"}]
    rules += [{"when": {"col": "n", "op": "eq", "value": "n1"}, "then": "N1"}, {"when": {"col": "x", "op": "lt", "value": 0}, "then": "small"}]
    data = [("m1", "n1", 1.0), ("late", "n1", 1.0), ("m2", None, 95.0), (None, "n1", -1.0), (None, None, -1.0), (None, None, None), ("z", "z", 1.0)]
    df = spark.createDataFrame(data, "m string, n string, x double")
    long = [r.v for r in with_rules(df, rules, F.lit("raw"), "v").collect()]
    assert sorted(long) == sorted(r.v for r in df.select(apply_rules(rules, F.lit("raw")).alias("v")).collect())
    assert with_rules(df, rules, F.lit("raw"), "v").columns == ["m", "n", "x", "v"]


def test_sample_rules_use_the_grammar(spark):
    import tallybook.rules

    rules = MartRules.load(f"{list(tallybook.rules.__path__)[0]}/sample.json")
    df = spark.createDataFrame([("REF 7 x", None, 1.0)], "name_raw string, merchant_name_raw string, amount double")
    got = df.withColumn("merchant_name", F.col("merchant_name_raw")).withColumn("category_raw", F.lit("c"))
    assert got.select(apply_rules(rules.merchant, F.col("name_raw"))).first()[0] == "7"
    assert got.select(apply_rules(rules.subcategory, F.lit("s"))).first()[0] == "TICKETS"


IDLE = [{"when": {"col": "s", "op": op, "value": f"idle{k}{tail}"}, "then": f"x{k}"} for k, (op, tail) in enumerate([("eq", ""), ("startswith", ""), ("like", "%")] * 20)]


def rule(op, value, then, col="s", **more):
    return {"when": {"col": col, "op": op, "value": value, **more}, "then": then}


@pytest.mark.parametrize(
    "rules",
    [
        [rule("eq", "a", None), rule("in", ["b", "ab"], True), rule("startswith", "ab", False)],
        [rule("like", "ab%", 1), rule("eq", "abc", 2.5), rule("startswith", "a", 3), rule("eq", "é", None)],
        [rule("startswith", "", "all"), rule("eq", "a", "late")],
        [rule("like", "%", 1), rule("like", "a_c%", 2)],
        [rule("like", "a\\\\_%", 1), rule("like", "%b", 2), rule("like", "a%b%", 3), rule("like", "ab", 4)],
        [rule("eq", "A", "fold", fold=True), rule("eq", "a", {"col": "st.f"}), rule("startswith", "b", {"col": "s", "extract": "(.)$"})],
        [rule("eq", "1", 1, col="n"), rule("gt", 1, 7, col="n"), rule("startswith", "a", None)],
        [rule("eq", "a", "first"), rule("present", False, "none"), rule("eq", "a", "second"), rule("startswith", "abc", "p")],
        [{"when": {"any": [{"col": "s", "op": "eq", "value": "b"}, {"col": "n", "op": "lt", "value": 1}]}, "then": "any"}, rule("startswith", "日本", "jp")],
        [rule("eq", "in", "x", col="st.f"), rule("startswith", "o", "y", col="st.f")],
    ],
)
@pytest.mark.parametrize("first", [True, False])
def test_a_rule_list_means_the_same_at_any_length(spark, rules, first):
    """With idle rules before or after: the same rows and the same type as the short list, as one CASE."""
    texts = ["a", "ab", "abc", "A", "b", "é", "", None, "日本語", "a_b", "idle", "a\nb"]
    rows = [(t, k % 3, ("in" if k % 2 else "out",)) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "s string, n int, st struct<f string>")
    texts_only = {type(r["then"]) for r in rules} == {str}
    idle = [r if texts_only else r | {"then": rules[0]["then"]} for r in IDLE]
    default = F.lit("none") if texts_only else F.lit(None)
    long = with_rules(df, idle + rules if first else rules + idle, default, "v")
    short = with_rules(df, rules, default, "v")
    assert long.schema["v"].dataType == short.schema["v"].dataType
    assert sorted(map(str, long.collect())) == sorted(map(str, short.collect()))
