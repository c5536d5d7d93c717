"""The whole pipeline on the smallest tables."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from tallybook.plans.mart import MartRules, build_mart, live_transactions, mart_parts
from tallybook.plans.pipelines import (
    MART_INPUTS,
    Ledger,
    accounts_snapshot,
    drop_newest,
    load_budget,
    load_investments,
    load_mart,
    load_transactions,
    missing_dependencies,
    run_checks,
    run_retention,
    run_status,
)
from tallybook.plans.quality import alerts
from tallybook.schemas import MART
from tallybook.session import stage
from tallybook.sources.tables import partition_days
from workload.ingest import (
    account_pages,
    holding_pages,
    institutions,
    supplier_balances,
    sync_pages,
    trade_pages,
)
from workload.ledger_rules import RULES
from workload.tables import ledger as ledger_tables

SF = "/root/testdata/sf0.001"
AS_OF = date(2001, 8, 1)


@pytest.fixture(scope="module")
def tables(spark):
    return ledger_tables(spark, SF)


def test_rows_of_parts_and_unique_keys(spark, tables):
    parts = mart_parts(tables, AS_OF, RULES)
    mart = stage(build_mart(tables, AS_OF, RULES), "mart")
    assert mart.schema.simpleString() == MART.simpleString()
    counts = {r[0]: r[1] for r in mart.groupBy("metric_category").count().collect()}
    assert counts == {k: v.count() for k, v in parts.items()} and len(counts) == 4
    tx = mart.where("metric_category = 'TRANSACTIONS'")
    assert tx.count() == tx.select("transaction_id").distinct().count()
    held = mart.where("metric_category = 'INVESTMENTS'")
    assert held.count() == held.select("transaction_id", "transaction_date").distinct().count()
    agg = mart.where("metric_category = 'TRANSACTIONS_AGG'").groupBy(
        "transaction_month", (F.col("category") == "Balance").alias("b")
    ).agg(F.round(F.sum("actual_amount"), 2).alias("x"), F.round(F.sum("budget_amount"), 2).alias("y"))
    per = {}
    for r in agg.collect():
        per.setdefault(r.transaction_month, {})[r.b] = (r.x, r.y)
    assert per and all(v[True] == v[False] for v in per.values())


def test_staged_mart_is_the_same(spark, tables):
    a = build_mart(tables, AS_OF, RULES)
    b = build_mart(tables, AS_OF, RULES, stage=lambda df: stage(df, "tx"))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_daily_jobs(spark, tables, tmp_path):
    """Landed pages to loaded tables to the mart and its checks, the last day run twice."""
    store = Ledger(spark, str(tmp_path))
    before, day = date(2001, 7, 31), AS_OF
    balances, rates = supplier_balances(spark, SF)
    cursors = spark.createDataFrame([("item-1", ""), ("gone", "x")], "item_id string, next_cursor string")
    store.load("cursors", cursors, partition=before)
    for month in (date(2001, 7, 1), date(2001, 8, 1)):
        load_budget(store, tables["budget_values"].where(F.col("partition_date") == F.lit(month)), month)
    for today in (before, day, day):
        snapshot = accounts_snapshot(account_pages(spark, SF), institutions(spark, SF), balances, rates)
        store.load("financial_accounts", snapshot, partition=today)
        load_investments(store, holding_pages(spark, SF), trade_pages(spark, SF), today)
    required = {"financial_accounts": day, "budget_values": date(2001, 8, 1)}
    assert missing_dependencies(store, required).count() == 0
    late = missing_dependencies(store, required | {"cursors": day}).collect()
    assert [(r.table, r.exists) for r in late] == [("cursors", False)]
    for _ in range(2):
        load_transactions(store, sync_pages(spark, SF), day)
    pages = sync_pages(spark, SF)
    assert store.read("transactions").count() == pages.where("size(added) + size(modified) > 0").count()
    assert store.read("removed_transactions").count() == pages.where("size(removed) > 0").count()
    newest = {r.item_id: r.next_cursor for r in store.read("cursors", day).collect()}
    assert newest["gone"] == "x" and newest["item-1"].startswith("cursor-")
    assert set(newest) == {r[0] for r in pages.select("item_id").distinct().collect()} | {"gone"}
    for today in (before, day, day):
        stored = load_mart(store, today, today, RULES)
    fresh = build_mart({n: store.read(n) for n in MART_INPUTS}, AS_OF, RULES)
    stored = stored.drop("built_on")
    assert stored.count() > 0
    assert stored.exceptAll(fresh).isEmpty() and fresh.exceptAll(stored).isEmpty()

    reports = run_checks(store)
    mart = reports["mart"].first()
    assert (mart.partition_0d, mart.partition_1d, mart.partition_fin_accts) == (day, before, day)
    assert mart.total_account_value_diff == 0 and mart.null_repeated_account_ids == 0
    assert reports["accounts"].first().total_accounts_diff == 0
    raised = {(r.check, r.rule) for r in alerts(reports).collect()}
    assert ("accounts", "diff") not in raised and ("transactions", "missing") in raised

    status = {r.table_id: r.row_count for r in run_status(store).collect()}
    assert status["transactions_20010801"] == store.read("transactions").count()
    assert status["budget_values_200108"] > 0 and status["temp_cursors"] == pages.select("item_id").distinct().count()

    # an empty reload is a partition of its own, and the check of the day sees it
    load_transactions(store, pages.where("false"), day)
    assert store.read("removed_transactions", day).count() == 0
    raised = {(r.check, r.rule) for r in alerts(run_checks(store)).collect()}
    assert ("tombstones", "empty") in raised

    assert run_retention(store, ["cursors", "metric_mart"], date(2001, 8, 30), 30) == 2
    assert partition_days(spark, store.path("cursors")) == [day]
    assert drop_newest(store, ["cursors", "transactions"]) == 2
    assert partition_days(spark, store.path("transactions")) == []


def test_jobs_on_an_empty_ledger(spark, tables, tmp_path):
    """The first run of everything: nothing is there before."""
    store, day = Ledger(spark, str(tmp_path)), AS_OF
    assert missing_dependencies(store, {"cursors": day}).first().exists is False
    with pytest.raises(ValueError, match="not there or empty: financial_accounts"):
        load_investments(store, holding_pages(spark, SF), trade_pages(spark, SF), day, required={"financial_accounts": day})
    pages = sync_pages(spark, SF)
    load_transactions(store, pages, day)
    assert store.read("cursors", day).count() == pages.select("item_id").distinct().count()
    snapshot = accounts_snapshot(account_pages(spark, SF), institutions(spark, SF))
    store.load("financial_accounts", snapshot, partition=day)
    load_budget(store, tables["budget_values"].where("partition_date = DATE'2001-08-01'"), date(2001, 8, 17))
    load_budget(store, tables["budget_values"].where("partition_date = DATE'2001-08-01'"), date(2001, 8, 1))
    assert store.days("budget_values") == [date(2001, 8, 1)]
    kinds = [("item-1", ["investments"]), ("item-2", ["transactions"]), ("item-3", ["investments", "auth"])]
    items = spark.createDataFrame(kinds, "item_id string, products array<string>")
    trades = trade_pages(spark, SF)
    load_investments(store, holding_pages(spark, SF), trades, day, items, window=(3650, 0), required={"financial_accounts": day})
    assert {r[0] for r in store.read("investment_holdings").select("item_id").distinct().collect()} == {"item-1", "item-3"}
    dated = store.read("investment_transactions").agg(F.min("investment_date"), F.max("investment_date")).first()
    assert date(1991, 8, 1) <= dated[0] and dated[1] <= day
    assert load_mart(store, day, day).where("metric_category = 'TRANSACTIONS'").count() > 0


def test_no_rules_by_default(spark, tables):
    assert MartRules() == MartRules([], [], [], [], [], [])
    mart = build_mart(tables, AS_OF)
    assert mart.where("metric_category = 'TRANSACTIONS' AND category_updated <> category_raw").isEmpty()


def test_transactions_are_placed_once(spark, tables):
    """Tombstones and the choice of a version share one exchange of the transactions."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        live = live_transactions(tables["transactions"], tables["removed_transactions"], AS_OF)
        plan = live._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning") == 2, plan


# ------------------------------------------------------------------ incomplete feeds


def feed(spark, *pages):
    """Sync pages ``(item, number, has_more, added, removed)``."""
    from tallybook.schemas import SYNC_PAGE

    def element(i):
        return {"account_id": "a", "transaction_id": i, "amount": 1.0, "date": "2001-08-01"}

    rows = [
        {"item_id": item, "page": n, "added": [element(i) for i in added], "modified": [], "has_more": more,
         "removed": [{"account_id": "a", "transaction_id": i} for i in removed], "next_cursor": f"{item}{n}"}
        for item, n, more, added, removed in pages
    ]
    return spark.createDataFrame([json.dumps(r) for r in rows], "string").select(
        F.from_json("value", SYNC_PAGE).alias("p")
    ).select("p.*")


def state(store, day):
    ids = {r.transaction_id for r in store.read("transactions", day).collect()}
    gone = {r.transaction_id for r in store.read("removed_transactions", day).collect()}
    return ids, gone, {r.item_id: r.next_cursor for r in store.read("cursors", day).collect()}


def test_an_item_with_a_gap_is_held_back(spark, tmp_path):
    """A gap, a doubled page, and the late page in a rerun."""
    store, before, day = Ledger(spark, str(tmp_path)), date(2001, 7, 31), AS_OF
    cursors = spark.createDataFrame([("i", "i-old"), ("j", "j-old"), ("idle", "x")], "item_id string, next_cursor string")
    store.load("cursors", cursors, partition=before)
    landed = [
        ("i", 1, True, ["i1"], []), ("i", 3, False, ["i3"], ["i9"]),
        ("j", 1, True, ["j1"], []), ("j", 1, True, ["j1"], []), ("j", 2, False, ["j2"], ["j9"]),
        ("new", 1, True, ["n1"], []),
    ]
    late = load_transactions(store, feed(spark, *landed), day)
    assert {tuple(r) for r in late.collect()} == {("i", 2, 2, "between"), ("new", 2, None, "after")}
    assert late.collect() == store.read("missing_pages", day).drop("partition_date").collect()
    assert state(store, day) == ({"j1", "j2"}, {"j9"}, {"i": "i-old", "j": "j2", "idle": "x", "new": ""})
    assert store.read("transactions", day).count() == 2
    # what was held back comes with the missing page, and nothing twice
    whole = feed(spark, *landed, ("i", 2, True, ["i2"], []), ("new", 2, False, [], []))
    assert load_transactions(store, whole, day).isEmpty()
    want = {"i1", "i2", "i3", "j1", "j2", "n1"}, {"i9", "j9"}, {"i": "i3", "j": "j2", "idle": "x", "new": "new2"}
    assert state(store, day) == want and store.read("transactions", day).count() == 6
    # the next day starts from these cursors
    after = date(2001, 8, 2)
    load_transactions(store, feed(spark, ("i", 2, False, ["i4"], [])), after)
    assert state(store, after) == (set(), set(), want[2])


def test_trades_of_incomplete_items_are_held_back(spark, tmp_path):
    from tallybook.schemas import TRADES_PAGE

    def page(item, n, total, *ids):
        trades = [{"account_id": "a", "investment_transaction_id": i, "date": "2001-08-01"} for i in ids]
        return {"item": {"item_id": item}, "page": n, "investment_transactions": trades, "securities": [], "total_investment_transactions": total}

    rows = [page("i", 1, 3, "x", "y"), page("i", 1, 3, "x", "y"), page("j", 1, 2, "u"), page("j", 2, 2, "v"), page("k", 1, 0)]
    trades = spark.createDataFrame([json.dumps(r) for r in rows], "string").select(F.from_json("value", TRADES_PAGE).alias("p")).select("p.*")
    store, none = Ledger(spark, str(tmp_path)), holding_pages(spark, SF).where("false")
    late = load_investments(store, none, trades, AS_OF)
    assert [tuple(r) for r in late.collect()] == [("i", 2, 3)]
    got = store.read("investment_transactions", AS_OF).collect()
    assert sorted(r.investment_transaction_id for r in got) == ["u", "v"]


def test_marts_of_two_days_share_their_positions(spark, monkeypatch):
    """They are the same on both days: found, labelled and stored once."""
    from tallybook.plans import mart
    from workload.pipelines import stored_marts

    found, real = [], mart.positions
    monkeypatch.setattr(mart, "positions", lambda *a, **k: found.append(1) or real(*a, **k))
    stored = stored_marts(spark, SF)
    assert len(found) == 1
    for day in (AS_OF, date(2001, 7, 31)):
        fresh = build_mart(ledger_tables(spark, SF), day, RULES)
        kept = stored.where(F.col("built_on") == F.lit(day)).drop("built_on")
        assert kept.exceptAll(fresh).isEmpty() and fresh.exceptAll(kept).isEmpty()


def test_stored_labels_are_those_of_holders(spark, tables):
    """Accounts that hold nothing and holders without an account add no label."""
    from tallybook.plans.mart import held_positions, stored_labels

    labels = stored_labels(tables, RULES)
    key = ["item_id", "account_id"]
    holders = {tuple(r) for r in tables["investment_holdings"].select(*key).distinct().collect()}
    accounts = {tuple(r) for r in tables["financial_accounts"].select(*key).distinct().collect()}
    got = [tuple(r) for r in labels.select(*key).collect()]
    assert len(got) == len(set(got)) and set(got) == {k for k in holders & accounts if None not in k}
    assert 0 < len(got) < len(accounts)
    held = held_positions(tables["investment_holdings"], labels)
    parts = mart_parts(tables, AS_OF, RULES)["INVESTMENTS"].select(*held.columns)
    assert held.exceptAll(parts).isEmpty() and parts.exceptAll(held).isEmpty()


def test_each_query_stores_its_own_marts(spark):
    """What one query of a session wrote is no input of the next one."""
    from workload.pipelines import stored_marts

    first, second = ({f.rsplit("/", 2)[0] for f in stored_marts(spark, SF).inputFiles()} for _ in range(2))
    assert first and second and not first & second
