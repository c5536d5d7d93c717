"""Landed JSON pages to typed tables."""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.operators.islands import gaps, islands
from tallybook.operators.joins import enrich
from tallybook.operators.shape import conform
from tallybook.schemas import ACCOUNTS, HOLDINGS, SECURITY, TOMBSTONES, TRADES, TRANSACTIONS

# Fixed values of the account source and the transaction status.
BANK_SOURCE = "BANK"
ADDED = "ADDED"
MODIFIED = "MODIFIED"


def read_pages(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON document per line, declared schema, no inference pass."""
    return spark.read.schema(schema).json(path)


def wall_clock(text: Column) -> Column:
    """ISO time as TIMESTAMP_NTZ; the zone is dropped, the clock reading kept."""
    return F.regexp_replace(text, r"(Z|[+-]\d{2}:?\d{2})$", "").try_cast("timestamp_ntz")


def normalize_accounts(raw: DataFrame, institutions: DataFrame | None = None) -> DataFrame:
    """One row per account; attributes of the item are copied to each."""
    a, item = F.col("a"), F.col("item")
    rows = raw.select("item", F.explode("accounts").alias("a")).select(
        item["item_id"].alias("item_id"),
        a["persistent_account_id"].alias("persistent_account_id"),
        a["account_id"].alias("account_id"),
        a["mask"].alias("account_mask"),
        a["name"].alias("account_name"),
        a["official_name"].alias("account_official_name"),
        a["type"].alias("account_type"),
        a["subtype"].alias("account_subtype"),
        F.lit(BANK_SOURCE).alias("account_source"),
        item["institution_id"].alias("institution_id"),
        F.struct(
            a["balances"]["available"].alias("available"),
            a["balances"]["current"].alias("current"),
            a["balances"]["limit"].alias("limit"),
            a["balances"]["iso_currency_code"].alias("currency_code"),
            a["balances"]["unofficial_currency_code"].alias("unofficial_currency_code"),
        ).alias("balance"),
        item["update_type"].alias("update_type"),
        wall_clock(item["consent_expiration_time"]).alias("consent_expiration_time"),
        item["products"].alias("products"),
        item["billed_products"].alias("billed_products"),
    )
    if institutions is not None:
        rows = enrich(rows, institutions.select("institution_id", "institution_name"), ["institution_id"])
    return conform(rows, ACCOUNTS)


def normalize_transactions(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Added and modified transactions of sync pages, in one pass over the pages.

    ``keep`` names columns of the page to carry along.
    """

    def tagged(name: str, status: str) -> Column:
        return F.transform(
            F.coalesce(F.col(name), F.array().cast(raw.schema[name].dataType)),
            lambda t: F.struct(F.lit(status).alias("status"), t.alias("t")),
        )

    feed = F.concat(tagged("added", ADDED), tagged("modified", MODIFIED))
    page = F.col("page") if "page" in raw.columns else F.lit(None)
    rows = raw.select("item_id", page.alias("_page"), *keep, F.posexplode(feed).alias("_place", "f"))
    t = F.col("f.t")
    schema = T.StructType([*TRANSACTIONS.fields, *[raw.schema[k] for k in keep]])

    def part(struct: str, *names: str) -> Column:
        return F.struct(*[t[struct][n].alias(n) for n in names])

    return conform(
        rows.select(
            "item_id",
            t["account_id"].alias("account_id"),
            t["transaction_id"].alias("transaction_id"),
            t["pending_transaction_id"].alias("pending_transaction_id"),
            t["pending"].alias("is_pending"),
            t["account_owner"].alias("account_owner"),
            F.col("f.status").alias("status"),
            t["date"].alias("transaction_date"),
            wall_clock(t["datetime"]).alias("transaction_datetime"),
            t["authorized_date"].alias("authorized_date"),
            wall_clock(t["authorized_datetime"]).alias("authorized_datetime"),
            t["amount"].alias("amount"),
            t["iso_currency_code"].alias("currency_code"),
            t["unofficial_currency_code"].alias("unofficial_currency_code"),
            part("category_info", "primary", "detailed", "confidence_level").alias(
                "category_info"
            ),
            t["payment_channel"].alias("payment_channel"),
            F.struct(
                t["merchant_entity_id"].alias("entity_id"),
                t["merchant_name"].alias("merchant_name"),
                t["name"].alias("name"),
                t["website"].alias("website"),
            ).alias("merchant"),
            t["counterparties"].alias("counterparties"),
            F.struct(
                *[t["location"][n].alias(n) for n in ("address", "city", "region", "postal_code")],
                t["location"]["lat"].alias("latitude"),
                t["location"]["lon"].alias("longitude"),
            ).alias("location"),
            t["check_number"].alias("check_number"),
            t["payment_meta"].alias("payment_meta"),
            t["transaction_code"].alias("transaction_code"),
            F.col("_page").alias("feed_page"),
            F.col("_place").alias("feed_place"),
            *keep,
        ),
        schema,
    )


def normalize_tombstones(raw: DataFrame, removed_on: date | Column) -> DataFrame:
    """Removed transactions of sync pages, stamped with a date, exact copies dropped."""
    day = removed_on if isinstance(removed_on, Column) else F.lit(removed_on)
    r = F.col("r")
    rows = raw.select("item_id", day.alias("date_removed"), F.explode("removed").alias("r")).select(
        "item_id",
        r["account_id"].alias("account_id"),
        r["transaction_id"].alias("transaction_id"),
        "date_removed",
    )
    return conform(rows.distinct(), TOMBSTONES)


def security_struct(s: Column, security_id: Column | None = None) -> Column:
    """A landed security as the stored struct; a missing contract is a struct of NULLs.

    ``security_id`` may give its id from elsewhere.
    """
    contract = s["option_contract"]
    return F.struct(
        (s["security_id"] if security_id is None else security_id).alias("security_id"),
        s["iso_currency_code"].alias("currency_code"),
        s["unofficial_currency_code"].alias("unofficial_currency_code"),
        s["close_price"].alias("close_price"),
        s["close_price_as_of"].try_cast("date").alias("close_price_date"),
        wall_clock(s["update_datetime"]).alias("update_datetime"),
        *[
            s[n].alias(n)
            for n in (
                "cusip",
                "institution_id",
                "institution_security_id",
                "is_cash_equivalent",
                "isin",
                "market_identifier_code",
                "name",
            )
        ],
        F.struct(
            contract["contract_type"].alias("contract_type"),
            contract["expiration_date"].try_cast("date").alias("expiration_date"),
            contract["strike_price"].alias("strike_price"),
            contract["underlying_security_ticker"].alias("underlying_security_ticker"),
        ).alias("option_contract"),
        *[s[n].alias(n) for n in ("proxy_security_id", "sedol", "ticker_symbol", "type")],
    )


def _null_security() -> Column:
    return F.struct(
        *[
            (
                F.struct(*[F.lit(None).cast(g.dataType).alias(g.name) for g in f.dataType])
                if isinstance(f.dataType, T.StructType)
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in SECURITY
        ]
    )


def securities_of(raw: DataFrame) -> DataFrame:
    """(item_id, security_id, security) of landed pages, one row per pair.

    A page repeats the dictionary of its item, so pairs are reduced before the shuffle. Where
    pages differ, the last page counts, and on it the last place. A security crosses the shuffle
    as its JSON text, which settles ties too: the struct is mostly NULLs.
    """
    page = F.col("page") if "page" in raw.columns else F.lit(0)
    item = F.col("item.item_id").alias("item_id")
    rows = raw.select(item, page.alias("page"), F.posexplode("securities").alias("place", "s"))
    rows = rows.where(F.col("s.security_id").isNotNull())
    newest = F.max(F.struct("page", "place", F.to_json("s").alias("text"))).alias("newest")
    last = rows.groupBy("item_id", F.col("s.security_id").alias("security_id")).agg(newest)
    # parsed once, as an array's element, which no later projection takes apart; a query that reads
    # no more of a security than its id is spared the text, since the id is the key
    parsed = F.element_at(F.from_json("newest.text", T.ArrayType(rows.schema["s"].dataType)), 1)
    found = last.select("item_id", "security_id", parsed.alias("s"))
    return found.select("item_id", "security_id", security_struct(F.col("s"), F.col("security_id")).alias("security"))


def attach_security(
    df: DataFrame,
    securities: DataFrame,
    on: tuple[str, ...] = ("item_id", "security_id"),
    unknown: str = "error",
) -> DataFrame:
    """Look up ``security`` by id and drop ``security_id``.

    A NULL id gets a struct of NULLs.  An id the dictionary lacks fails the job, or
    with ``unknown="flag"`` is marked in a boolean column ``unknown_security``.
    """
    found = securities.select(*on, "security", F.lit(True).alias("_hit"))
    whole = securities.schema["security"].nullable
    return _known_security(df.join(found, list(on), "left"), unknown, whole)


def _known_security(df: DataFrame, unknown: str, whole: bool = True) -> DataFrame:
    """``whole=False``: a security that is found is never NULL, and is taken field by field.

    Then the join carries no more fields than the query reads.
    """
    hit = F.coalesce("_hit", F.lit(False))
    missing = ~hit & F.col("security_id").isNotNull()
    empty = _null_security()
    if unknown == "flag":
        df = df.withColumn("unknown_security", missing)
    else:
        message = F.concat(F.lit("unknown security id "), F.col("security_id"))
        empty = F.when(missing, F.raise_error(message).cast(SECURITY)).otherwise(empty)
    found = F.col("security")
    if whole:
        security = F.when(hit, found).otherwise(empty)
    else:
        names = df.schema["security"].dataType.names
        security = F.struct(*[F.when(hit, found[n]).otherwise(empty[n]).alias(n) for n in names])
    return df.withColumn("security", security).drop("_hit", "security_id")


def normalize_holdings(raw: DataFrame, unknown: str = "error") -> DataFrame:
    """Positions with their security, which stands on the same page: no join is needed."""

    def position(h: Column) -> Column:
        # the ids are made once a page; a lookup compares ids only and evaluates nothing
        at = F.array_position("ids", h["security_id"]).cast("int")
        return F.struct(h.alias("h"), F.try_element_at("newest", F.nullif(at, F.lit(0))).alias("s"))

    h, s = F.col("p.h"), F.col("p.s")
    newest = F.reverse("securities")  # a later entry of one id counts
    pages = raw.select("item", "holdings", newest.alias("newest")).withColumn(
        "ids", F.transform("newest", lambda s: s["security_id"])
    )
    found = pages.select(
        F.col("item.item_id").alias("item_id"), F.explode(F.transform("holdings", position)).alias("p")
    )
    rows = found.select(
        "item_id",
        h["account_id"].alias("account_id"),
        h["cost_basis"].alias("cost_basis"),
        h["institution_price"].alias("institution_price"),
        h["institution_price_as_of"].alias("institution_price_date"),
        wall_clock(h["institution_price_datetime"]).alias("institution_price_datetime"),
        h["institution_value"].alias("institution_value"),
        h["iso_currency_code"].alias("currency_code"),
        h["unofficial_currency_code"].alias("unofficial_currency_code"),
        h["quantity"].alias("quantity"),
        h["vested_quantity"].alias("vested_quantity"),
        h["vested_value"].alias("vested_value"),
        h["security_id"].alias("security_id"),
        security_struct(s).alias("security"),
        s.isNotNull().alias("_hit"),
    )
    return _typed(_known_security(rows, unknown), HOLDINGS, unknown)


def normalize_trades(raw: DataFrame, unknown: str = "error", repeated: bool = True) -> DataFrame:
    """Trades of all offset pages; securities may stand on any page of the item.

    A page that landed twice counts once; ``repeated=False`` says that the pages are unique already.
    """
    if repeated:
        raw = trade_pages_once(raw)
    i = F.col("i")
    rows = raw.select(
        F.col("item.item_id").alias("item_id"), F.explode("investment_transactions").alias("i")
    ).select(
        "item_id",
        i["account_id"].alias("account_id"),
        i["investment_transaction_id"].alias("investment_transaction_id"),
        i["date"].alias("investment_date"),
        i["name"].alias("investment_name"),
        i["quantity"].alias("quantity"),
        i["amount"].alias("amount"),
        i["price"].alias("price"),
        i["fees"].alias("fees"),
        i["type"].alias("investment_type"),
        i["subtype"].alias("investment_subtype"),
        i["iso_currency_code"].alias("currency_code"),
        i["unofficial_currency_code"].alias("unofficial_currency_code"),
        i["security_id"].alias("security_id"),
    )
    # merged whatever their size is taken for: they grow with the pages, and Spark counts a text as 20 bytes
    securities = securities_of(raw).hint("merge")
    return _typed(attach_security(rows, securities, unknown=unknown), TRADES, unknown)


def _typed(df: DataFrame, schema: T.StructType, unknown: str) -> DataFrame:
    if unknown == "flag":
        schema = T.StructType([*schema.fields, T.StructField("unknown_security", T.BooleanType())])
    return conform(df, schema)


def once(pages: DataFrame, key: list[str], order: str) -> DataFrame:
    """Each page of a key once, however often it landed; the copy with the largest text counts.

    Pages without a number are the same only if all of them is.

    Copies meet before their text is made: the shuffle carries a page once and without its text,
    and a page without a number goes by the text that it has in common with its copies.
    """
    columns = F.struct(*[F.col(c) for c in pages.columns])
    unnumbered = F.when(F.col(order).isNull(), F.to_json(columns)).alias("_text")
    groups = [*key, order, "_text"]
    placed = pages.select("*", unnumbered).repartition(*groups)
    first = placed.groupBy(*groups).agg(F.max_by(columns, F.to_json(columns)).alias("_kept"))
    return first.select("_kept.*")


#: Types whose values come back from JSON text as they were.
_JSON_TYPES = (T.StringType, T.BooleanType, T.IntegerType, T.LongType, T.DoubleType)


def _comes_back(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return len(set(kind.names)) == len(kind.names) and all(_comes_back(f.dataType) for f in kind)
    return _comes_back(kind.elementType) if isinstance(kind, T.ArrayType) else isinstance(kind, _JSON_TYPES)


def _nullable(kind: T.DataType, short: bool = False) -> T.DataType:
    """The type with NULL allowed everywhere; ``short`` gives fields their rank as a name.

    Ranks have one width and follow the order that names have in a text, the quote behind them
    included, so of two texts the same one is larger under either names.
    """
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType, short))
    if not isinstance(kind, T.StructType):
        return kind
    ranked = sorted(kind.names, key=lambda n: json.dumps(n, ensure_ascii=False)[1:].encode())
    width = len(f"{len(ranked) - 1:x}")
    names = {n: f"{i:0{width}x}" if short else n for i, n in enumerate(ranked)}
    return T.StructType([T.StructField(names[f.name], _nullable(f.dataType, short)) for f in kind])


def trade_pages_once(raw: DataFrame) -> DataFrame:
    """Each offset page of an item once; pages of a table without page numbers stay as they are.

    As ``once``, but a page crosses the shuffle and is sorted as its text alone, under short names:
    the struct is mostly NULLs and takes half as much again on disk, and more than twice in memory.
    """
    if "page" not in raw.columns:
        return raw
    item = F.col("item.item_id").alias("_item")
    if not _comes_back(raw.schema):
        return once(raw.select("*", item), ["_item"], "page").drop("_item")
    short = _nullable(raw.schema, short=True)
    text = F.to_json(F.struct(*[F.col(c) for c in raw.columns]).cast(short)).alias("_page")
    texts = raw.select(item, "page", text)
    groups = ["_item", "page", F.when(F.col("page").isNull(), F.col("_page"))]
    kept = texts.repartition(*groups).groupBy(*groups).agg(F.max("_page").alias("_kept"))
    # parsed once, in a generator that no later projection takes apart
    return kept.select(F.inline(F.array(F.from_json("_kept", short).cast(_nullable(raw.schema)))))


def merge_pages(
    pages: DataFrame, items: str, key: list[str], total: str | None = None, order: str = "page"
) -> tuple[DataFrame, DataFrame]:
    """Elements of all pages, and per key how many arrived of how many announced.

    A page that landed twice counts once.
    """
    pages = once(pages, key, order)
    rows = pages.select(*key, F.explode(items).alias("element"))
    received = F.sum(F.size(F.coalesce(F.col(items), F.array()))).alias("received")
    expected = (F.max(total) if total else F.lit(None).cast("bigint")).alias("expected")
    done = pages.groupBy(*key).agg(
        F.count(F.lit(1)).alias("pages"), received, expected
    )
    complete = F.coalesce(F.col("received") >= F.col("expected"), F.lit(True))
    return rows, done.withColumn("complete", complete)


def feed_complete(
    pages: DataFrame, key: str = "item_id", order: str = "page", first: int | None = 1
) -> DataFrame:
    """Per item: pages landed, and whether none is missing and the last says that no more follow.

    Pages are numbered from ``first`` on without gaps; None takes the smallest that landed.
    """
    distinct = F.count_distinct(order)
    begin = F.min(order) if first is None else F.lit(first)
    whole = (F.max(order) - begin + 1 == distinct) & (F.min(order) >= begin)
    # of copies of the last page one that announces more is believed
    more = F.max(F.struct(F.col(order), F.col("has_more")))["has_more"]
    complete = F.coalesce(whole & ~more, F.lit(False)).alias("complete")
    return pages.groupBy(key).agg(distinct.alias("pages"), complete)


def with_product(items: DataFrame, products: list[str], col: str = "products") -> DataFrame:
    """Items that have any of the products; asking for none keeps none."""
    if not products:
        return items.where(F.lit(False))
    return items.where(F.arrays_overlap(F.col(col), F.array(*[F.lit(p) for p in products])))


def missing_pages(
    pages: DataFrame, key: str = "item_id", order: str = "page", more: str = "has_more", first: int | None = 1
) -> DataFrame:
    """``key, first_page, last_page, reason``: ranges of pages that an item lacks; none if it is whole.

    ``before``: pages from ``first`` on (None: the smallest that landed) up to the first one there;
    ``between``: pages between two that landed; ``after``: the last page announces more, or doesn't say
    whether it does, so the range has no end; ``outside``: pages that landed are numbered below
    ``first``; ``unnumbered``: a page has no number and may be any. Copies of a page count once.
    """
    between = gaps(islands(pages, [key], order), [key])
    n = F.col(order)
    least = F.min(order).alias("least")
    last = F.max(F.when(n.isNotNull(), F.struct(n.alias("n"), F.col(more).alias("more")))).alias("last")
    lost = F.max(n.isNull()).alias("lost")
    ends = pages.groupBy(key).agg(least, last, lost)

    def span(reason: str, from_, to, when) -> Column:
        row = F.struct(
            from_.cast("bigint").alias("first_page"), to.cast("bigint").alias("last_page"), F.lit(reason).alias("reason")
        )
        return F.when(when, row)

    none, numbered = F.lit(None), F.col("least").isNotNull()
    begin = F.col("least") if first is None else F.lit(first)
    ranges = F.array(
        span("before", begin, F.col("least") - 1, numbered & (F.col("least") > begin)),
        span("outside", F.col("least"), begin - 1, numbered & (F.col("least") < begin)),
        span("after", F.col("last.n") + 1, none, numbered & F.coalesce(F.col("last.more"), F.lit(True))),
        span("unnumbered", none, none, F.col("lost")),
    )
    at_ends = ends.select(key, F.inline(F.filter(ranges, lambda r: r.isNotNull())))
    inside = between.select(key, F.col("first").alias("first_page"), F.col("last").alias("last_page"), F.lit("between").alias("reason"))
    return inside.unionByName(at_ends)


def hold_back(pages: DataFrame, late: DataFrame, item: Column | None = None, key: str = "item_id") -> DataFrame:
    """Pages of the items that ``late`` doesn't name; a NULL item may be held back too."""
    named = late.select(F.col(key).alias("_late")).distinct()
    return pages.join(named, (F.col(key) if item is None else item).eqNullSafe(F.col("_late")), "left_anti")


def incomplete_trades(raw: DataFrame) -> DataFrame:
    """``item_id, received, expected`` of the items whose pages hold fewer trades than they announce."""
    keyed = raw.select(F.col("item.item_id").alias("item_id"), "investment_transactions", "total_investment_transactions")
    received = F.sum(F.size(F.coalesce("investment_transactions", F.array()))).alias("received")
    totals = keyed.groupBy("item_id").agg(received, F.max("total_investment_transactions").alias("expected"))
    return totals.where("received < expected")
