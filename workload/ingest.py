"""A18-A30: landed pages, securities, balances, budgets."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybook.operators.shape import union_all
from tallybook.schemas import ACCOUNT_PAGE, HOLDINGS_PAGE, SYNC_PAGE, TRADES_PAGE
from tallybook.sources import pages as landed
from tallybook.sources.balances import value_balances
from tallybook.sources.budget import budget_for
from tallybook.sources.partitions import window_filter
from workload.registry import query
from workload.tables import budget, cte, table, with_


def dealt(df: DataFrame) -> DataFrame:
    """Rows in tasks of the session's advisory size, as many as the rows need.

    The tables come as one row group, and a scan of it is one task.
    """
    return df.hint("rebalance")


def as_json(df: DataFrame, schema, deal: bool = True) -> DataFrame:
    """Rows through JSON text and back, as they would be landed and read.

    Rows are dealt out before they become text, unless ``deal=False`` says that they are already;
    each text is parsed once, in a generator that no later projection takes apart.
    """
    names = [F.col(n) for n in schema.names if n in df.columns]
    text = (dealt(df) if deal else df).select(F.to_json(F.struct(*names)).alias("line"))
    return text.select(F.inline(F.array(F.from_json("line", schema))))


def _clock(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def account_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per customer: a checking account, and a credit card for some."""
    key = F.col("c_custkey")

    def account(prefix: str, kind: str, subtype: Column, current: Column) -> Column:
        return F.struct(
            F.concat(F.lit(prefix), key).alias("account_id"),
            F.substring("c_name", -4, 4).alias("mask"),
            F.col("c_name").alias("name"),
            F.lit(kind).alias("type"),
            subtype.alias("subtype"),
            F.struct(current.alias("current"), F.lit("USD").alias("iso_currency_code")).alias("balances"),
        )

    checking = account("chk-", "depository", F.lower("c_mktsegment"), F.col("c_acctbal"))
    card = account("crd-", "credit", F.lit("credit card"), F.lit(25.5))
    accounts = F.when(F.col("c_mktsegment") == "BUILDING", F.array(checking, card)).otherwise(F.array(checking))
    item = F.struct(
        F.concat(F.lit("item-"), key).alias("item_id"),
        F.concat(F.lit("ins_"), F.col("c_nationkey") + 3).alias("institution_id"),
        F.lit("background").alias("update_type"),
        F.lit("2025-03-04T05:06:07Z").alias("consent_expiration_time"),
        F.array(F.lit("transactions"), F.lit("auth")).alias("products"),
        F.array().cast("array<string>").alias("billed_products"),
    )
    pages = table(spark, sf_dir, "customer").select(accounts.alias("accounts"), item.alias("item"))
    return as_json(pages, ACCOUNT_PAGE)


def institutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("ins_"), "n_nationkey").alias("institution_id"), F.col("n_name").alias("institution_name")
    )


cte(
    "page_accounts",
    """
SELECT 'item-' || c_custkey AS item_id, a.prefix || c_custkey AS account_id,
       right(c_name, 4) AS account_mask, c_name AS account_name, a.kind AS account_type,
       CASE a.kind WHEN 'credit' THEN 'credit card' ELSE lower(c_mktsegment) END AS account_subtype,
       'BANK' AS account_source, 'ins_' || (c_nationkey + 3) AS institution_id,
       n.n_name AS institution_name,
       CAST(CASE a.kind WHEN 'credit' THEN 25.5 ELSE c_acctbal END AS DOUBLE) AS current_balance,
       'USD' AS currency_code, 2 AS n_products, 0 AS n_billed
FROM customer JOIN (VALUES ('chk-', 'depository'), ('crd-', 'credit')) a(prefix, kind)
  ON a.kind = 'depository' OR c_mktsegment = 'BUILDING'
LEFT JOIN nation n ON n.n_nationkey = c_nationkey + 3
""",
)


@query(
    "a18_normalize_accounts",
    with_(
        "page_accounts",
        "SELECT *, 'background' AS update_type, '2025-03-04 05:06:07' AS consent FROM page_accounts",
    ),
)
def normalize_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = account_pages(spark, sf_dir)
    return flat_accounts(landed.normalize_accounts(pages, institutions(spark, sf_dir)))


def flat_accounts(accounts: DataFrame) -> DataFrame:
    return accounts.select(
        "item_id",
        "account_id",
        "account_mask",
        "account_name",
        "account_type",
        "account_subtype",
        "account_source",
        "institution_id",
        "institution_name",
        F.col("balance.current").alias("current_balance"),
        F.col("balance.currency_code").alias("currency_code"),
        F.size("products").alias("n_products"),
        F.size("billed_products").alias("n_billed"),
        "update_type",
        _clock(F.col("consent_expiration_time")).alias("consent"),
    )


def sync_pages(spark: SparkSession, sf_dir: str, name: str = "o_orderkey", **more: Column) -> DataFrame:
    """One page per order: added, modified or removed by its status; an item's pages are numbered.

    ``name`` is the column that names the transaction; ``more`` are columns to add.
    """
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    element = SYNC_PAGE["added"].dataType.elementType
    party = element["counterparties"].dataType.elementType
    clerk = F.concat(F.lit("Clerk "), F.col("o_custkey") % 7)

    def struct(layout, **given: Column) -> Column:
        return F.struct(
            *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in layout]
        )

    first = struct(party, name=clerk, type=F.lit("merchant"))
    second = struct(party, name=F.lit("Second"))
    none = F.array().cast(element["counterparties"].dataType)
    t = struct(
        element,
        account_id=F.concat(F.lit("acct-"), "o_custkey"),
        transaction_id=F.concat(F.lit("tx-"), name),
        amount=price,
        date=F.date_format("o_orderdate", "yyyy-MM-dd"),
        datetime=F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T06:07:08-05:00")),
        iso_currency_code=F.lit("USD"),
        merchant_name=F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")),
        name=F.concat(F.lit("ORDER "), key),
        pending=price < 50000,
        category_info=struct(
            element["category_info"].dataType,
            primary=F.col("o_orderpriority"),
            detailed=F.concat_ws("_", "o_orderpriority", "o_orderstatus"),
        ),
        counterparties=F.when(price > 200000, F.array(first, second)).otherwise(none),
        location=struct(element["location"].dataType, city=clerk, lat=price / 1024),
        payment_meta=struct(element["payment_meta"].dataType, payee=clerk),
    )
    status = F.col("o_orderstatus")
    empty = F.array().cast(SYNC_PAGE["added"].dataType)
    gone = F.struct(
        F.concat(F.lit("acct-"), "o_custkey").alias("account_id"),
        F.concat(F.lit("tx-"), name).alias("transaction_id"),
    )
    no_gone = F.array().cast(SYNC_PAGE["removed"].dataType)
    by_item = Window.partitionBy(F.col("o_custkey") % 40)
    numbered = table(spark, sf_dir, "orders").withColumns(
        {"page": F.row_number().over(by_item.orderBy(key)).cast("bigint"), "pages": F.count("*").over(by_item)}
    )
    return numbered.select(
        F.concat(F.lit("item-"), F.col("o_custkey") % 40).alias("item_id"),
        "page",
        F.when(status == "O", F.array(t)).otherwise(empty).alias("added"),
        F.when(status == "F", F.array(t)).otherwise(empty).alias("modified"),
        F.when(status == "P", F.array(gone, gone)).otherwise(no_gone).alias("removed"),
        (F.col("page") < F.col("pages")).alias("has_more"),
        F.concat(F.lit("cursor-"), key).alias("next_cursor"),
        *[c.alias(n) for n, c in more.items()],
    )


@query(
    "a19_normalize_transactions",
    """
SELECT 'item-' || (o_custkey % 40) AS item_id, 'acct-' || o_custkey AS account_id,
       'tx-' || o_orderkey AS transaction_id, o_totalprice < 50000 AS is_pending,
       CASE o_orderstatus WHEN 'O' THEN 'ADDED' ELSE 'MODIFIED' END AS status,
       CAST(o_orderdate AS DATE) AS transaction_date,
       strftime(o_orderdate, '%Y-%m-%d') || ' 06:07:08' AS transaction_clock,
       o_totalprice AS amount, 'USD' AS currency_code, o_orderpriority AS category_raw,
       o_orderpriority || '_' || o_orderstatus AS subcategory_raw,
       NULLIF(o_orderpriority, '5-LOW') AS merchant_name, 'ORDER ' || o_orderkey AS name_raw,
       CASE WHEN o_totalprice > 200000 THEN 'Clerk ' || (o_custkey % 7) END AS counterparty_name,
       CASE WHEN o_totalprice > 200000 THEN 2 ELSE 0 END AS n_counterparties,
       'Clerk ' || (o_custkey % 7) AS city, o_totalprice / 1024 AS latitude,
       'Clerk ' || (o_custkey % 7) AS payee
FROM orders WHERE o_orderstatus <> 'P'""",
)
def normalize_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = as_json(sync_pages(spark, sf_dir), SYNC_PAGE)
    return landed.normalize_transactions(pages).select(
        "item_id",
        "account_id",
        "transaction_id",
        "is_pending",
        "status",
        "transaction_date",
        _clock(F.col("transaction_datetime")).alias("transaction_clock"),
        "amount",
        "currency_code",
        F.col("category_info.primary").alias("category_raw"),
        F.col("category_info.detailed").alias("subcategory_raw"),
        "merchant.merchant_name",
        F.col("merchant.name").alias("name_raw"),
        F.get("counterparties", F.lit(0))["name"].alias("counterparty_name"),
        F.size("counterparties").alias("n_counterparties"),
        "location.city",
        "location.latitude",
        "payment_meta.payee",
    )


@query(
    "a20_tombstones",
    """
SELECT 'item-' || (o_custkey % 40) AS item_id, 'acct-' || o_custkey AS account_id,
       'tx-' || o_orderkey AS transaction_id, DATE '2001-08-01' AS date_removed
FROM orders WHERE o_orderstatus = 'P'""",
)
def tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = as_json(sync_pages(spark, sf_dir), SYNC_PAGE)
    return landed.normalize_tombstones(pages, date(2001, 8, 1))


def _raw_security(layout) -> Column:
    given = {
        "security_id": F.concat(F.lit("sec-"), "p_partkey"),
        "iso_currency_code": F.lit("USD"),
        "close_price": F.col("p_retailprice"),
        "close_price_as_of": F.lit("2001-08-01"),
        "is_cash_equivalent": F.col("p_size") == 1,
        "name": F.col("p_name"),
        "ticker_symbol": F.upper("p_brand"),
        "type": F.col("p_type"),
        "option_contract": F.when(
            F.col("p_size") >= 10,
            F.struct(
                F.lit("call").alias("contract_type"),
                F.lit("2002-01-31").alias("expiration_date"),
                F.col("p_size").cast("double").alias("strike_price"),
                F.col("p_brand").alias("underlying_security_ticker"),
            ),
        ),
    }
    return F.struct(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in layout])


def _element(layout, **given: Column) -> Column:
    return F.struct(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in layout])


def _lines_with_parts(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Order lines, as read or the ``lines`` given, with their part."""
    lines = table(spark, sf_dir, "lineitem") if lines is None else lines
    parts = table(spark, sf_dir, "part")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")


def _security_id() -> Column:
    """Lines with return flag A report no security."""
    return F.when(F.col("l_returnflag") != "A", F.concat(F.lit("sec-"), "l_partkey"))


def holding_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = HOLDINGS_PAGE["holdings"].dataType.elementType
    security = HOLDINGS_PAGE["securities"].dataType.elementType
    row = _element(
        held,
        account_id=F.concat(F.lit("acct-"), "l_suppkey"),
        cost_basis=F.col("l_extendedprice") * 0.5,
        institution_price=F.col("p_retailprice"),
        institution_price_as_of=F.date_format("l_shipdate", "yyyy-MM-dd"),
        institution_value=F.col("l_extendedprice"),
        iso_currency_code=F.lit("USD"),
        quantity=F.col("l_quantity"),
        security_id=_security_id(),
    )
    # lines are dealt out before they meet their part and become pages, which are many times as wide
    return _lines_with_parts(spark, sf_dir, dealt(table(spark, sf_dir, "lineitem"))).select(
        F.struct(F.concat(F.lit("item-"), "l_suppkey").alias("item_id")).alias("item"),
        F.array(row).alias("holdings"),
        F.array(_raw_security(security)).alias("securities"),
    )


_SECURITY_SQL = """
       CASE WHEN l_returnflag <> 'A' THEN 'sec-' || l_partkey END AS security_id,
       CASE WHEN l_returnflag <> 'A' THEN p_name END AS security_name,
       CASE WHEN l_returnflag <> 'A' THEN upper(p_brand) END AS ticker_symbol,
       CASE WHEN l_returnflag <> 'A' THEN DATE '2001-08-01' END AS close_price_date,
       CASE WHEN l_returnflag <> 'A' AND p_size >= 10 THEN CAST(p_size AS DOUBLE) END AS strike_price
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey"""


def _flat_security(df: DataFrame, *columns) -> DataFrame:
    return df.select(
        *columns,
        F.col("security.security_id").alias("security_id"),
        F.col("security.name").alias("security_name"),
        F.col("security.ticker_symbol").alias("ticker_symbol"),
        F.col("security.close_price_date").alias("close_price_date"),
        F.col("security.option_contract.strike_price").alias("strike_price"),
    )


@query(
    "a21_normalize_holdings",
    f"""
SELECT 'item-' || l_suppkey AS item_id, 'acct-' || l_suppkey AS account_id,
       l_extendedprice * 0.5 AS cost_basis, p_retailprice AS institution_price,
       CAST(l_shipdate AS DATE) AS institution_price_date, l_extendedprice AS institution_value,
       l_quantity AS quantity, {_SECURITY_SQL}""",
)
def normalize_holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = landed.normalize_holdings(as_json(holding_pages(spark, sf_dir), HOLDINGS_PAGE, deal=False))
    return _flat_security(
        rows, "item_id", "account_id", "cost_basis", "institution_price", "institution_price_date",
        "institution_value", "quantity",
    )


def trade_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    trade = TRADES_PAGE["investment_transactions"].dataType.elementType
    security = TRADES_PAGE["securities"].dataType.elementType
    row = _element(
        trade,
        account_id=F.concat(F.lit("acct-"), "l_suppkey"),
        investment_transaction_id=F.concat_ws("-", "l_orderkey", "l_linenumber"),
        date=F.date_format("l_shipdate", "yyyy-MM-dd"),
        name=F.col("p_name"),
        quantity=F.col("l_quantity"),
        amount=F.col("l_extendedprice"),
        price=F.col("p_retailprice"),
        fees=F.col("l_tax"),
        type=F.col("l_returnflag"),
        subtype=F.col("l_linestatus"),
        iso_currency_code=F.lit("USD"),
        security_id=_security_id(),
    )
    # order and line number don't name a line: some have several
    by_item = Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    # bare rows are numbered: a page made before would cross the shuffle, with many times the bytes
    numbered = _lines_with_parts(spark, sf_dir).withColumn("page", F.row_number().over(by_item).cast("bigint"))
    return numbered.select(
        F.struct(F.concat(F.lit("item-"), "l_suppkey").alias("item_id")).alias("item"),
        "page",
        F.array(row).alias("investment_transactions"),
        F.array(_raw_security(security)).alias("securities"),
        F.lit(1).cast("bigint").alias("total_investment_transactions"),
    )


@query(
    "a22_normalize_trades",
    f"""
SELECT 'item-' || l_suppkey AS item_id, 'acct-' || l_suppkey AS account_id,
       l_orderkey || '-' || l_linenumber AS investment_transaction_id,
       CAST(l_shipdate AS DATE) AS investment_date, p_name AS investment_name,
       l_quantity AS quantity, l_extendedprice AS amount, p_retailprice AS price, l_tax AS fees,
       l_returnflag AS investment_type, l_linestatus AS investment_subtype, {_SECURITY_SQL}""",
)
def normalize_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = as_json(trade_pages(spark, sf_dir), TRADES_PAGE, deal=False)
    rows = landed.normalize_trades(pages, repeated=False)
    return _flat_security(
        rows, "item_id", "account_id", "investment_transaction_id", "investment_date", "investment_name",
        "quantity", "amount", "price", "fees", "investment_type", "investment_subtype",
    )


@query(
    "a22_page_landed_twice",
    """
SELECT 'item-' || l_suppkey AS item_id, l_orderkey || '-' || l_linenumber AS investment_transaction_id,
       l_extendedprice AS amount, 'sec-' || l_partkey AS security_id
FROM lineitem WHERE l_returnflag <> 'A'""",
)
def trades_landed_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third page lands again, as it is or with its name left out."""
    pages = trade_pages(spark, sf_dir).where(F.col("investment_transactions")[0]["security_id"].isNotNull())
    whole = F.col("investment_transactions")
    cut = F.transform(whole, lambda t: t.withField("name", F.lit(None).cast("string")))
    copies = F.when(F.col("page") % 3 == 0, F.array(whole, whole, cut)).otherwise(F.array(whole))
    # a page is given out as often as it lands, so pages are made once
    pages = pages.withColumn("investment_transactions", F.explode(copies))
    rows = landed.normalize_trades(as_json(pages, TRADES_PAGE, deal=False))
    return rows.select(
        "item_id", "investment_transaction_id", "amount", F.col("security.security_id").alias("security_id")
    )


@query(
    "a23_security_struct",
    """
SELECT 'sec-' || p_partkey AS security_id, 'USD' AS currency_code, p_retailprice AS close_price,
       DATE '2001-08-01' AS close_price_date, p_size = 1 AS is_cash_equivalent, p_name AS "name",
       CASE WHEN p_size >= 10 THEN 'call' END AS contract_type,
       CASE WHEN p_size >= 10 THEN DATE '2002-01-31' END AS expiration_date,
       CASE WHEN p_size >= 10 THEN CAST(p_size AS DOUBLE) END AS strike_price,
       TRUE AS has_contract_struct
FROM part""",
)
def security_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = HOLDINGS_PAGE["securities"].dataType.elementType
    raw = table(spark, sf_dir, "part").select(_raw_security(layout).alias("s"))
    s = raw.select(landed.security_struct(F.col("s")).alias("s"))
    return s.select(
        "s.security_id",
        "s.currency_code",
        "s.close_price",
        "s.close_price_date",
        "s.is_cash_equivalent",
        "s.name",
        "s.option_contract.contract_type",
        "s.option_contract.expiration_date",
        "s.option_contract.strike_price",
        F.col("s.option_contract").isNotNull().alias("has_contract_struct"),
    )


@query(
    "a23_security_conflict",
    """
SELECT 'item-' || l_suppkey AS item_id, 'sec-' || (l_partkey % 50) AS security_id,
       arg_max(p_name, l_orderkey * 10 + l_linenumber) AS security_name
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
)
def security_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that name one security differently: the last page counts."""
    layout = TRADES_PAGE["securities"].dataType.elementType
    security = _element(
        layout, security_id=F.concat(F.lit("sec-"), F.col("l_partkey") % 50), name=F.col("p_name")
    )
    pages = _lines_with_parts(spark, sf_dir).where("p_name IS NOT NULL").select(
        F.struct(F.concat(F.lit("item-"), "l_suppkey").alias("item_id")).alias("item"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("page"),
        F.array(security).alias("securities"),
    )
    found = landed.securities_of(pages)
    return found.select("item_id", "security_id", F.col("security.name").alias("security_name"))


def turn_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of at most five turns; (conv_id, turn) is unique, so a page stays that small."""
    element = F.struct("turn", "role", "text")
    return (
        table(spark, sf_dir, "conversations")
        .withColumn("page", F.floor(F.col("turn") / 5))
        .groupBy("conv_id", "page")
        .agg(F.collect_list(element).alias("items"), (F.max("turn") + 1).alias("announced"))
    )


@query("a24_page_merge", 'SELECT conv_id, turn, role, text FROM conversations')
def page_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = landed.merge_pages(turn_pages(spark, sf_dir), "items", ["conv_id"], "announced")
    return rows.select("conv_id", "element.turn", "element.role", "element.text")


@query(
    "a24_page_completeness",
    """
SELECT conv_id, COUNT(DISTINCT turn // 5) AS pages, COUNT(*) AS received,
       max(turn) + 1 AS expected, COUNT(*) >= max(turn) + 1 AS complete
FROM conversations GROUP BY conv_id""",
)
def page_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, done = landed.merge_pages(turn_pages(spark, sf_dir), "items", ["conv_id"], "announced")
    return done


@query(
    "a24_page_landed_twice",
    """
SELECT conv_id, COUNT(DISTINCT turn // 5) AS pages, COUNT(*) AS received, max(turn) + 1 AS expected,
       COUNT(*) >= max(turn) + 1 AS complete
FROM conversations GROUP BY conv_id""",
)
def page_landed_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = turn_pages(spark, sf_dir)
    _, done = landed.merge_pages(pages.unionAll(pages), "items", ["conv_id"], "announced")
    return done


@query(
    "a24_missing_page",
    """
SELECT conv_id, COUNT(DISTINCT p) AS pages, max(p) + 1 = COUNT(DISTINCT p) AS complete
FROM (SELECT conv_id, turn // 5 + CASE WHEN conv_id % 3 = 0 AND turn >= 5 THEN 1 ELSE 0 END AS p FROM conversations)
GROUP BY conv_id""",
)
def missing_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the conversations skip a page number; the last page says that it is the last."""
    skipped = ((F.col("conv_id") % 3 == 0) & (F.col("page") >= 1)).cast("bigint")
    pages = turn_pages(spark, sf_dir).withColumn("page", F.col("page") + skipped)
    last = pages.groupBy("conv_id").agg(F.max("page").alias("last"))
    more = pages.join(last, "conv_id").withColumn("has_more", F.col("page") < F.col("last"))
    return landed.feed_complete(more, "conv_id", first=0)


@query(
    "a24_missing_ranges",
    """
WITH numbered AS (
  SELECT conv_id, turn // 3 + CASE WHEN conv_id % 3 = 0 AND turn >= 6 THEN 2 WHEN conv_id % 5 = 0 THEN 1 ELSE 0 END AS p,
         conv_id % 7 = 0 AS more
  FROM conversations),
pages AS (SELECT DISTINCT conv_id, p, more FROM numbered),
edges AS (SELECT *, lead(p) OVER (PARTITION BY conv_id ORDER BY p) AS following FROM pages)
SELECT conv_id, p + 1 AS first_page, following - 1 AS last_page, 'between' AS reason FROM edges WHERE following > p + 1
UNION ALL
SELECT conv_id, 0, min(p) - 1, 'before' FROM pages GROUP BY conv_id HAVING min(p) > 0
UNION ALL
SELECT conv_id, max(p) + 1, NULL, 'after' FROM pages WHERE more GROUP BY conv_id""",
)
def missing_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations in pages of three turns; some skip two pages, begin late, or announce more."""
    late = F.when((F.col("conv_id") % 3 == 0) & (F.col("turn") >= 6), 2).when(F.col("conv_id") % 5 == 0, 1).otherwise(0)
    pages = table(spark, sf_dir, "conversations").select(
        "conv_id", (F.floor(F.col("turn") / 3) + late).alias("page"), (F.col("conv_id") % 7 == 0).alias("has_more")
    )
    return landed.missing_pages(pages, "conv_id", first=0)


@query(
    "a25_product_filter",
    """
SELECT doc_id, lang, source, n_chars FROM documents
WHERE lang IN ('de', 'es') OR source IN ('src1', 'src7')""",
)
def product_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", "n_chars", F.array("lang", "source").alias("products")
    )
    return landed.with_product(items, ["de", "es", "src1", "src7"]).drop("products")


cte(
    "valued",
    """
SELECT 'addr-' || s_nationkey AS item_id, unit AS account_name,
       CAST(SUM(raw) AS DOUBLE) / scale AS available, CAST(SUM(raw) AS DOUBLE) / scale * usd_rate AS current_balance
FROM (SELECT s_nationkey, CASE WHEN s_suppkey % 2 = 0 THEN 'BTC' ELSE 'ETH' END AS unit,
             CAST(round(s_acctbal * 100) AS HUGEINT) *
             CASE WHEN s_suppkey % 2 = 0 THEN 10000::HUGEINT ELSE 100000000000000::HUGEINT END AS raw
      FROM supplier)
JOIN (VALUES ('BTC', 1e8, 60000.5::DOUBLE), ('ETH', 1e18, 3000.25::DOUBLE)) r(unit, scale, usd_rate) USING (unit)
GROUP BY s_nationkey, unit, scale, usd_rate
""",
)


def supplier_balances(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Raw token counts per supplier, the nation as address, and the rates."""
    even = F.col("s_suppkey") % 2 == 0
    cents = F.round(F.col("s_acctbal") * 100).cast("decimal(20,0)")
    per_cent = F.when(even, F.lit(10**4)).otherwise(F.lit(10**14)).cast("decimal(16,0)")
    balances = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("addr-"), "s_nationkey").alias("address"),
        F.when(even, "BTC").otherwise("ETH").alias("unit"),
        (cents * per_cent).alias("raw_amount"),
    )
    rates = spark.sql("SELECT * FROM VALUES ('BTC', 60000.5D), ('ETH', 3000.25D) AS r(unit, usd_rate)")
    return balances, rates


@query("a26_balance_valuation", with_("valued", "SELECT * FROM valued"))
def balance_valuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_balances(*supplier_balances(spark, sf_dir)).select(
        "item_id",
        "account_name",
        F.col("balance.available").alias("available"),
        F.col("balance.current").alias("current_balance"),
    )


@query(
    "a27_union_by_name",
    """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment,
       CAST(NULL AS INTEGER) AS nation FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_acctbal, NULL, s_nationkey FROM supplier""",
)
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey id", "c_name name", "c_acctbal balance", "c_mktsegment segment"
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_nationkey nation", "s_suppkey id", "s_name name", "s_acctbal balance"
    )
    return union_all(customers, None, suppliers)


MONTH = date(1998, 5, 1)


@query(
    "a28_budget_source",
    with_(
        "budget",
        """
SELECT category_raw, subcategory_raw, category, subcategory, detail_category, budget_amount
FROM budget WHERE transaction_month = DATE '1998-05-01'""",
    ),
)
def budget_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = budget(spark, sf_dir).where(F.col("transaction_month") == F.lit(MONTH))
    return budget_for(rows, MONTH)


@query(
    "a29_backfill_override",
    with_(
        "budget",
        """
SELECT category_raw, subcategory_raw, category, subcategory, detail_category,
       CASE WHEN transaction_month <= DATE '1998-05-01' AND subcategory = 'HOUSEHOLD' THEN 777.0
            WHEN transaction_month <= DATE '1998-05-01' AND subcategory = 'MACHINERY' THEN NULL
            ELSE budget_amount END AS budget_amount
FROM budget""",
    ),
)
def backfill_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = F.col("transaction_month") <= F.lit(MONTH)
    key = F.when(old, F.lit(MONTH)).otherwise(F.lit(date(1900, 1, 1)))
    amount = F.when(F.col("subcategory") == "HOUSEHOLD", F.lit(777.0))
    backfill = F.when(
        F.col("subcategory").isin("HOUSEHOLD", "MACHINERY"), F.create_map(key, amount)
    )
    return budget_for(budget(spark, sf_dir).withColumn("backfill", backfill), MONTH)


@query(
    "a30_date_window",
    """
SELECT event_id, user_id, value, CAST(ts AS DATE) AS event_date FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-20' - 6 AND DATE '2024-01-20' - 5""",
)
def date_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "value", F.to_date("ts").alias("event_date")
    )
    return window_filter(rows, "event_date", date(2024, 1, 20), 6, 5)
