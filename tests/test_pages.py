import json
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallybook.operators.joins import initial_cursors, last_cursors, merge_cursors
from tallybook.schemas import ACCOUNT_PAGE, HOLDINGS_PAGE, SYNC_PAGE, TRADES_PAGE, TRANSACTIONS
from tallybook.sources import pages as P
from tallybook.sources.balances import value_balances
from tallybook.sources.budget import budget_for, read_budget


def land(spark, tmp_path, docs, schema):
    path = tmp_path / "pages"
    path.mkdir(exist_ok=True)
    for i, d in enumerate(docs):
        (path / f"{i}.json").write_text(json.dumps(d))
    return P.read_pages(spark, str(path), schema)


def test_accounts(spark, tmp_path):
    page = {
        "accounts": [
            {"account_id": "a1", "mask": "1", "name": "n", "official_name": None, "type": "credit", "subtype": "credit card",
             "balances": {"available": None, "current": 5.5, "limit": 9, "iso_currency_code": "USD", "unofficial_currency_code": None}},
            {"persistent_account_id": "p2", "account_id": "a2", "balances": {"current": 1}},
        ],
        "item": {"item_id": "i", "institution_id": "ins", "update_type": "background",
                 "consent_expiration_time": "2025-01-02T03:04:05Z", "products": ["x"], "billed_products": []},
    }
    names = spark.createDataFrame([("ins", "Bank")], "institution_id string, institution_name string")
    pages = land(spark, tmp_path, [page, {"accounts": [], "item": {"item_id": "j"}}], ACCOUNT_PAGE)
    got = {r.account_id: r for r in P.normalize_accounts(pages, names).collect()}
    assert set(got) == {"a1", "a2"}
    a = got["a1"]
    assert (a.item_id, a.account_source, a.institution_name, a.balance.limit) == ("i", "BANK", "Bank", 9.0)
    assert a.persistent_account_id is None and got["a2"].persistent_account_id == "p2"
    assert a.consent_expiration_time == datetime(2025, 1, 2, 3, 4, 5)
    assert a.products == ["x"] and a.billed_products == []
    assert P.normalize_accounts(pages).select("institution_name").distinct().collect()[0][0] is None


def tx(i, **more):
    base = {"account_id": "a", "transaction_id": f"t{i}", "amount": 1.5, "date": "2024-01-02", "pending": False,
            "datetime": "2024-01-02T23:00:00-05:00", "name": "N", "merchant_name": None, "counterparties": [{"name": "c", "type": "m"}],
            "category_info": {"primary": "P", "detailed": "P_D"}, "location": {"lat": 1.0, "lon": 2.0}, "payment_meta": {"payee": "x"}}
    return base | more


def sync(item, page, added=(), modified=(), removed=(), cursor="c"):
    return {"item_id": item, "page": page, "added": list(added), "modified": list(modified), "removed": list(removed), "has_more": False, "next_cursor": cursor}


def test_transactions_and_tombstones(spark, tmp_path):
    gone = {"account_id": "a", "transaction_id": "t9"}
    pages = land(spark, tmp_path, [
        sync("i", 1, [tx(1)], [tx(2, datetime=None, counterparties=None)], [gone, gone], "c1"),
        sync("i", 2, removed=[gone], cursor="c2"),
        sync("j", 1, cursor="d1"),
    ], SYNC_PAGE)
    got = {r.transaction_id: r for r in P.normalize_transactions(pages).collect()}
    assert {k: v.status for k, v in got.items()} == {"t1": "ADDED", "t2": "MODIFIED"}
    assert got["t1"].transaction_datetime == datetime(2024, 1, 2, 23)  # the zone is dropped
    assert got["t1"].transaction_date == date(2024, 1, 2) and got["t2"].transaction_datetime is None
    assert got["t1"].counterparties[0].name == "c" and got["t2"].counterparties is None
    assert got["t1"].location.longitude == 2.0 and got["t1"].merchant.name == "N"
    assert [f.name for f in P.normalize_transactions(pages).schema] == TRANSACTIONS.names
    dead = P.normalize_tombstones(pages, date(2024, 1, 3)).collect()
    assert [tuple(r) for r in dead] == [("i", "a", "t9", date(2024, 1, 3))]
    cut = pages.withColumn("has_more", (F.col("item_id") == "j") | (F.col("page") == 1))
    assert {tuple(r) for r in P.feed_complete(cut).collect()} == {("i", 2, True), ("j", 1, False)}
    # landing twice changes nothing, a gap or a missing first page does
    assert {tuple(r) for r in P.feed_complete(cut.union(cut)).collect()} == {("i", 2, True), ("j", 1, False)}
    gap = cut.withColumn("page", F.when(F.col("page") == 2, 3).otherwise(F.col("page")))
    assert {tuple(r) for r in P.feed_complete(gap).collect()} == {("i", 2, False), ("j", 1, False)}
    late = cut.where("page = 2")
    assert P.feed_complete(late).first().complete is False and P.feed_complete(late, first=None).first().complete is True
    # an item whose pages hold only removals, or nothing, moves its cursor too
    assert {tuple(r) for r in last_cursors(pages).collect()} == {("i", "c2"), ("j", "d1")}


def test_cursor_merge(spark):
    old = spark.createDataFrame([("i", "1"), ("k", "2")], "item_id string, next_cursor string")
    new = spark.createDataFrame([("i", "9"), ("n", "8")], "item_id string, next_cursor string")
    got = merge_cursors(new, old)
    assert {tuple(r) for r in got.collect()} == {("i", "9"), ("n", "8"), ("k", "2")}
    assert {tuple(r) for r in initial_cursors(old).collect()} == {("i", ""), ("k", "")}


SECURITY = {"security_id": "s", "iso_currency_code": "USD", "name": "S", "type": "equity", "option_contract": None}
OPTION = SECURITY | {"security_id": "o", "option_contract": {"contract_type": "put", "expiration_date": "2024-05-06", "strike_price": 3}}


def holding(sid):
    return {"account_id": "a", "institution_value": 2.0, "institution_price_as_of": "2024-01-02", "security_id": sid}


def test_holdings(spark, tmp_path):
    page = {"item": {"item_id": "i"}, "holdings": [holding("s"), holding("o"), holding(None)], "securities": [SECURITY, OPTION]}
    pages = land(spark, tmp_path, [page, {"item": {"item_id": "j"}, "holdings": [], "securities": []}], HOLDINGS_PAGE)
    got = {r.security.security_id: r for r in P.normalize_holdings(pages).collect()}
    assert set(got) == {"s", "o", None}
    assert got["s"].security.option_contract is not None  # a struct of NULLs
    assert got["s"].security.option_contract.contract_type is None
    assert got["o"].security.option_contract.expiration_date == date(2024, 5, 6)
    assert got[None].security.name is None
    assert got["s"].institution_price_date == date(2024, 1, 2)


def test_unknown_security(spark, tmp_path):
    page = {"item": {"item_id": "i"}, "holdings": [holding("x"), holding("s")], "securities": [SECURITY]}
    pages = land(spark, tmp_path, [page], HOLDINGS_PAGE)
    with pytest.raises(Exception, match="unknown security id x"):
        P.normalize_holdings(pages).collect()
    flags = P.normalize_holdings(pages, unknown="flag").select("unknown_security", "security.name")
    assert {tuple(r) for r in flags.collect()} == {(True, None), (False, "S")}


def test_trades_find_securities_on_other_pages(spark, tmp_path):
    def trade(i, sid):
        return {"investment_transaction_id": i, "date": "2024-01-02", "name": "buy", "amount": 1.0, "security_id": sid}

    pages = land(spark, tmp_path, [
        {"item": {"item_id": "i"}, "investment_transactions": [trade("1", "s")], "securities": [SECURITY], "total_investment_transactions": 3},
        {"item": {"item_id": "i"}, "investment_transactions": [trade("2", "s"), trade("3", None)], "securities": [SECURITY, OPTION], "total_investment_transactions": 3},
        {"item": {"item_id": "j"}, "investment_transactions": [trade("4", "o")], "securities": [OPTION], "total_investment_transactions": 2},
    ], TRADES_PAGE)
    got = {r.investment_transaction_id: r.security.name for r in P.normalize_trades(pages).collect()}
    assert got == {"1": "S", "2": "S", "3": None, "4": "S"}
    numbered = pages.withColumn("page", F.when(F.size("securities") == 2, 2).otherwise(1).cast("bigint"))
    keyed = numbered.withColumn("item_id", F.col("item.item_id"))
    rows, done = P.merge_pages(keyed, "investment_transactions", ["item_id"], "total_investment_transactions")
    twice, _ = P.merge_pages(keyed.union(keyed), "investment_transactions", ["item_id"], "total_investment_transactions")
    assert rows.count() == twice.count() == 4
    assert {(r.item_id, r.received, r.expected, r.complete) for r in done.collect()} == {("i", 3, 3, True), ("j", 1, 2, False)}


def test_product_filter(spark):
    items = spark.createDataFrame([("i", ["a", "b"]), ("j", ["c"]), ("k", None)], "item_id string, products array<string>")
    assert [r.item_id for r in P.with_product(items, ["b", "z"]).collect()] == ["i"]
    assert P.with_product(items, []).count() == 0


def test_balances_keep_large_counts_exact(spark):
    df = spark.createDataFrame(
        [("x", "ETH", "123456789012345678901"), ("x", "ETH", "1"), ("y", "BTC", "150000000"), ("z", "BTC", None)],
        "address string, unit string, raw_amount string",
    )
    rates = spark.createDataFrame([("ETH", 2.0), ("BTC", 10.0)], "unit string, usd_rate double")
    got = {r.item_id: r for r in value_balances(df, rates).collect()}
    assert got["y"].balance.available == 1.5 and got["y"].balance.current == 15.0
    assert got["x"].balance.available == pytest.approx(123.456789012345678902, rel=1e-15)
    assert got["z"].balance.current is None
    assert (got["x"].account_id, got["x"].account_source, got["x"].products) == (None, "CRYPTO", [])


def test_budget_backfill(spark, tmp_path):
    month = date(2024, 1, 1)
    lines = [
        {"category_raw": "A", "subcategory_raw": "1", "category": "a", "subcategory": "x", "budget_amount": 1.0, "backfill": {"2024-01-01": 7.0}},
        {"category_raw": "A", "subcategory_raw": "2", "category": "a", "subcategory": "x", "budget_amount": 2.0, "backfill": {"2024-02-01": 7.0}},
        {"category_raw": "A", "subcategory_raw": "3", "category": "a", "subcategory": "x", "budget_amount": 3.0, "backfill": {"2024-01-01": None}},
        {"category_raw": "A", "subcategory_raw": "4", "category": "a", "subcategory": "x", "budget_amount": 4.0},
    ]
    path = tmp_path / "budget.json"
    path.write_text("\n".join(json.dumps(x) for x in lines))
    got = {r.subcategory_raw: r for r in budget_for(read_budget(spark, str(path)), month).collect()}
    assert {k: v.budget_amount for k, v in got.items()} == {"1": 7.0, "2": 2.0, "3": None, "4": 4.0}
    assert got["1"].detail_category is None and "backfill" not in got["1"].asDict()


def test_the_last_page_names_a_security(spark, tmp_path):
    pages = [
        {"item": {"item_id": "i"}, "page": k, "investment_transactions": [], "securities": [SECURITY | {"name": f"n{k}"}, SECURITY | {"name": f"m{k}"}]}
        for k in range(9)
    ]
    raw = land(spark, tmp_path, pages, TRADES_PAGE)
    for n in range(1, 5):
        assert [r.security.name for r in P.securities_of(raw.repartition(n)).collect()] == ["m8"]


def test_holdings_take_the_last_entry_of_their_page(spark, tmp_path):
    page = {"item": {"item_id": "i"}, "holdings": [holding("s")], "securities": [SECURITY | {"name": "old"}, SECURITY | {"name": "new"}]}
    assert P.normalize_holdings(land(spark, tmp_path, [page], HOLDINGS_PAGE)).first().security.name == "new"


def test_equal_versions_do_not_depend_on_partitions(spark, tmp_path):
    from tallybook.operators.dedup import current_view

    pages = land(spark, tmp_path, [sync("i", k, modified=[tx(1, amount=float(k), datetime=None)]) for k in range(8)], SYNC_PAGE)
    gone = P.normalize_tombstones(pages, date(2024, 1, 3))
    for n in range(1, 5):
        versions = P.normalize_transactions(pages).withColumn("partition_date", F.lit(date(2024, 1, 3))).repartition(n)
        assert current_view(versions, gone).first().amount == 7.0


# ------------------------------------------------------------------ missing pages


def numbered(spark, rows):
    return spark.createDataFrame(rows, "item_id string, page bigint, has_more boolean")


def missing(pages, **k):
    return {tuple(r) for r in P.missing_pages(pages, **k).collect()}


def test_missing_pages_of_every_kind(spark):
    rows = [
        ("whole", 1, True), ("whole", 2, True), ("whole", 2, False), ("whole", 3, False),
        ("gap", 1, True), ("gap", 4, True), ("gap", 4, True), ("gap", 5, True), ("gap", 9, False),
        ("late", 3, False), ("open", 1, True), ("unsaid", 1, None), ("low", 0, True), ("low", 1, False),
        ("blank", 1, False), ("blank", None, False), ("none", None, False), (None, 2, False),
    ]
    want = {
        ("gap", 2, 3, "between"), ("gap", 6, 8, "between"), ("late", 1, 2, "before"), ("open", 2, None, "after"),
        ("unsaid", 2, None, "after"), ("low", 0, 0, "outside"), ("blank", None, None, "unnumbered"),
        ("none", None, None, "unnumbered"), (None, 1, 1, "before"),
    }
    pages = numbered(spark, rows)
    assert missing(pages) == missing(pages.union(pages)) == want
    assert missing(pages, first=None) == {r for r in want if r[3] not in ("before", "outside")}
    assert missing(pages.where("false")) == set()
    # an item is complete if and only if nothing of it is missing
    held = {r[0] for r in want if r[3] != "unnumbered"}
    done = {r.item_id: r.complete for r in P.feed_complete(pages.where("page IS NOT NULL")).collect()}
    assert {k for k, v in done.items() if not v} == held


def test_islands_of_a_hot_key(spark):
    """Runs that cross blocks of any size are one, at negative numbers too."""
    from tallybook.operators.islands import gaps, islands

    numbers = [*range(-25, 40), *range(41, 43), *range(60, 200), 10_000]
    rows = [("hot", n) for n in numbers for _ in range(2)] + [(f"k{n}", n) for n in range(30)] + [(None, 1), (None, 3)]
    df = spark.createDataFrame(rows, "k string, n bigint")
    for block in (1, 7, 100, 10_000):
        runs = islands(df, ["k"], "n", block)
        got = {tuple(r) for r in runs.where("k = 'hot'").collect()}
        assert got == {("hot", -25, 39), ("hot", 41, 42), ("hot", 60, 199), ("hot", 10_000, 10_000)}
        assert runs.where("k <> 'hot'").count() == 30
        holes = {("hot", 40, 40), ("hot", 43, 59), ("hot", 200, 9999), (None, 2, 2)}
        assert {tuple(r) for r in gaps(runs, ["k"]).collect()} == holes


def test_pages_without_a_number_are_not_thrown_together(spark):
    pages = numbered(spark, [("i", None, True), ("i", None, False), ("i", None, False), ("i", 1, True), ("i", 1, False)])
    assert P.once(pages, ["item_id"], "page").count() == 3


def test_a_trade_page_that_lands_twice_counts_once(spark, tmp_path):
    trade = {"account_id": "a", "date": "2024-01-02", "amount": 1.0, "security_id": "s"}
    page = {"item": {"item_id": "i"}, "page": 1, "securities": [SECURITY], "total_investment_transactions": 3,
            "investment_transactions": [trade | {"investment_transaction_id": x} for x in "xy"]}
    raw = land(spark, tmp_path, [page, page, page | {"page": 2, "investment_transactions": []}], TRADES_PAGE)
    assert P.normalize_trades(raw).count() == 2
    once = P.trade_pages_once(raw)
    assert P.normalize_trades(once, repeated=False).count() == 2
    assert {tuple(r) for r in P.incomplete_trades(once).collect()} == {("i", 2, 3)}
    assert P.trade_pages_once(raw.drop("page")).count() == 3


def below_exchange(df):
    """The part of the plan that feeds the deepest shuffle."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("Exchange ")[-1]


def test_copies_of_a_page_meet_before_their_text_is_made(spark):
    """A shuffle of pages with their texts, sorted in each task before it, took more disk than there was."""
    rows = [(f"i{n % 50}", n // 50, n % 2 == 0) for n in range(2000)]
    pages = numbered(spark, rows + rows[:900])
    kept = P.once(pages, ["item_id"], "page")
    assert sorted(tuple(r) for r in kept.collect()) == sorted(tuple(r) for r in numbered(spark, rows).collect())
    fed = below_exchange(kept)
    assert "Aggregate" not in fed and "Sort " not in fed


def test_pages_are_made_once_of_lines_that_are_numbered(spark):
    """No page crosses the shuffle that numbers it, and copies of pages are no plans of their own."""
    from workload.ingest import trade_pages, trades_landed_twice

    sf_dir = "/root/testdata/sf0.001"
    plan = trade_pages(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "array(" in plan.split("Window ")[0] and "array(" not in plan.split("Window ")[1]
    twice = trades_landed_twice(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    # one for the trades and one for the securities, which share their shuffles
    assert "Union" not in twice and twice.count("Window ") == 2


def test_every_line_and_part_is_a_page_of_its_own(spark, tmp_path):
    """Parts that come twice make two pages of a line, which are no copies of each other."""
    from workload.ingest import trade_pages

    for name, n in (("lineitem", 1), ("part", 2)):
        rows = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        rows.select("*", F.explode(F.array(*[F.lit(i) for i in range(n)])).alias("copy")).drop("copy").write.parquet(
            str(tmp_path / f"{name}.parquet")
        )
    pages = trade_pages(spark, str(tmp_path)).select("item.item_id", "page")
    assert pages.count() == pages.distinct().count() > spark.read.parquet(str(tmp_path / "lineitem.parquet")).count()


def test_securities_of_trades_are_never_broadcast(spark):
    """They grow with the pages, and the text that pages are read from hides their size."""
    from workload.ingest import normalize_trades

    df = normalize_trades(spark, "/root/testdata/sf0.001")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin" in plan and "security_id" not in "".join(x for x in plan.splitlines() if "BroadcastHashJoin" in x)


def test_one_security_per_pair_crosses_the_shuffle_as_text(spark, tmp_path):
    """Every value of a security comes back from its text."""
    odd = SECURITY | {"name": 'a "b" \\ \n é 😀', "close_price": 0.1 + 0.2, "option_contract": {}, "cusip": ""}
    page = {"item": {"item_id": "i"}, "page": 1, "securities": [odd], "investment_transactions": []}
    raw = land(spark, tmp_path, [page, page | {"page": 2, "securities": []}], TRADES_PAGE)
    found = P.securities_of(raw)
    (got,) = found.collect()
    (want,) = raw.where("page = 1").select(P.security_struct(F.col("securities")[0]).alias("s")).collect()
    assert got.security == want.s and got.security.name == odd["name"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "max_by" not in plan


def odd_trade_pages():
    """Pages whose copies differ by a value, or by a field that one of them lacks."""
    trade = {"account_id": "a", "date": "2024-01-02", "name": "n", "quantity": 2.0, "amount": 0.1 + 0.2, "security_id": "s"}
    odd = SECURITY | {"name": 'a "b" \\ \n \u2028 é 😀', "close_price": 1e-300, "option_contract": {}, "cusip": "", "sedol": "0"}
    page = {"item": {"item_id": "i"}, "page": 1, "securities": [odd, OPTION], "investment_transactions": [trade], "total_investment_transactions": 3}
    lack = {k: v for k, v in trade.items() if k != "name"}
    copies = [
        page, page, page | {"investment_transactions": [lack]}, page | {"investment_transactions": [trade | {"amount": -0.0}]},
        page | {"securities": [odd | {"name": None}, OPTION]}, page | {"securities": [OPTION, odd]}, page | {"securities": []},
        page | {"investment_transactions": [None, trade]}, page | {"investment_transactions": None}, page | {"total_investment_transactions": 10},
        page | {"securities": [odd | {k: None for k in ("ticker_symbol", "type", "option_contract")}]}, page | {"securities": [odd | {"cusip": None}]},
    ]
    others = [{"page": 1}, {"item": {}, "page": 1}, {"item": {"item_id": "i"}}, {"item": {"item_id": "i"}}, page | {"page": None}]
    pairs = [[copies[a] | {"page": n}, copies[b] | {"page": n}] for n, (a, b) in enumerate(((a, b) for a in range(12) for b in range(a)), 2)]
    return copies + others + sum(pairs, [])


def test_of_copies_the_one_with_the_largest_text_counts(spark, tmp_path):
    """Whatever of a page's copies differs, the text under short names is as large as the text itself."""
    (tmp_path / "all.json").write_text("\n".join(json.dumps(d) for d in odd_trade_pages()))
    raw = P.read_pages(spark, str(tmp_path / "all.json"), TRADES_PAGE)
    keyed = raw.withColumn("_item", F.col("item.item_id"))
    want = P.once(keyed, ["_item"], "page").drop("_item")
    kept = P.trade_pages_once(raw)
    assert kept.columns == raw.columns and kept.schema.simpleString() == raw.schema.simpleString()
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, want.collect()))
    assert kept.count() == 1 + 66 + 1 + 2  # then the pages without an item, and those without a number, two of them copies
    # a page with a value that its text doesn't hold whole stays as it is
    timed = raw.withColumn("landed", F.lit("2024-01-02 03:04:05.123456").cast("timestamp"))
    assert P.trade_pages_once(timed).select("landed").distinct().first().landed == datetime(2024, 1, 2, 3, 4, 5, 123456)


def test_trade_pages_cross_the_shuffle_as_text_alone(spark, tmp_path):
    """Crossing as structs, mostly of NULLs, they took half as much again, and more than twice when sorted."""
    raw = land(spark, tmp_path, odd_trade_pages()[:3], TRADES_PAGE)
    plan = P.trade_pages_once(raw)._jdf.queryExecution().optimizedPlan().toString()
    crossing = plan.split("RepartitionByExpression")[1].split("Project [")[1].splitlines()[0]
    assert re.findall(r" AS (\w+)#", crossing) == ["_item", "_page"] and "max_by" not in plan


def test_an_id_alone_needs_no_text_of_a_security(spark, tmp_path):
    trade = {"account_id": "a", "date": "2024-01-02", "amount": 1.0, "security_id": "s", "investment_transaction_id": "1"}
    page = {"item": {"item_id": "i"}, "page": 1, "securities": [SECURITY, OPTION], "investment_transactions": [trade, trade | {"security_id": None}]}
    raw = land(spark, tmp_path, [page, page | {"page": 2, "securities": []}], TRADES_PAGE)
    ids = P.normalize_trades(raw, repeated=False).select("item_id", "security.security_id")
    plan = ids._jdf.queryExecution().optimizedPlan().toString()
    assert "max(" not in plan and "named_struct(page" not in plan
    assert sorted(map(tuple, ids.collect()), key=str) == [("i", "s")] * 2 + [("i", None)] * 2
    # other fields are those of the newest entry, and an unknown id is found out by its id alone too
    assert {r.name for r in P.normalize_trades(raw, repeated=False).select("security.name").collect()} == {"S", None}
    lost = land(spark, tmp_path, [page | {"securities": [OPTION]}, page | {"page": 2, "securities": []}], TRADES_PAGE)
    with pytest.raises(Exception, match="unknown security id s"):
        P.normalize_trades(lost, repeated=False).select("security.security_id").collect()


def test_a_security_that_is_null_stays_null(spark, tmp_path):
    page = {"item": {"item_id": "i"}, "page": 1, "securities": [SECURITY, OPTION], "investment_transactions": []}
    known = P.securities_of(land(spark, tmp_path, [page], TRADES_PAGE))
    trades = spark.createDataFrame([("i", "s"), ("i", "o"), ("i", None)], "item_id string, security_id string")
    some = known.withColumn("security", F.when(F.col("security_id") == "s", F.col("security")))
    got = P.attach_security(trades, some).select("security", F.col("security.name").alias("n"))
    assert sorted((r.security is None, r.n) for r in got.collect() if r.n or r.security is None) == [(False, "S"), (True, None)]
    every = P.attach_security(trades, known).collect()
    assert {r.security.name for r in every} == {"S", None} and len(every) == 3 and all(r.security for r in every)


def test_pages_are_dealt_out_by_their_size(spark):
    """A fixed number of tasks grows with the rows: at 6 GB each of them read 2.5 GB."""
    from tallybook.session import configure
    from workload.ingest import as_json, holding_pages

    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB"}
    old = {k: spark.conf.get(k, None) for k in conf}
    configure(spark)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = spark.range(0, 40_000, 1, 8).select(F.struct(F.md5(F.col("id").cast("string")).alias("item_id")).alias("item"))
        parts = as_json(rows, HOLDINGS_PAGE).select(F.spark_partition_id().alias("p")).distinct().count()
        assert parts > 2 * spark.sparkContext.defaultParallelism
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    # lines are dealt out, not the pages made of them
    plan = holding_pages(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "array(" not in plan.split("RebalancePartitions")[1]
