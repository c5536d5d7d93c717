"""Table layouts, all columns nullable.  ``partition_date`` is the partition column."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Partition suffix formats and their grain.
GRAIN_FORMATS = {
    "day": "yyyyMMdd",
    "month": "yyyyMM",
    "hour": "yyyyMMddHH",
    "hour_t": "yyyyMMdd'T'HH",
}
GRAIN_LENGTHS = {"day": 8, "month": 6, "hour": 10, "hour_t": 11}


_SIMPLE = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "clock": T.TimestampNTZType(),
    "texts": T.ArrayType(T.StringType()),
}


def struct(*columns: tuple[str, str | T.DataType]) -> T.StructType:
    """Columns as ("name name ...", type); several names share a type."""
    fields = []
    for names, kind in columns:
        kind = _SIMPLE[kind] if isinstance(kind, str) else kind
        fields += [T.StructField(n, kind) for n in names.split()]
    return T.StructType(fields)


BALANCE = struct(
    ("available current limit", "double"), ("currency_code unofficial_currency_code", "string")
)
OPTION_CONTRACT = struct(
    ("contract_type", "string"),
    ("expiration_date", "date"),
    ("strike_price", "double"),
    ("underlying_security_ticker", "string"),
)
SECURITY = struct(
    ("security_id currency_code unofficial_currency_code", "string"),
    ("close_price", "double"),
    ("close_price_date", "date"),
    ("update_datetime", "clock"),
    ("cusip institution_id institution_security_id", "string"),
    ("is_cash_equivalent", "boolean"),
    ("isin market_identifier_code name", "string"),
    ("option_contract", OPTION_CONTRACT),
    ("proxy_security_id sedol ticker_symbol type", "string"),
)
COUNTERPARTY = struct(("entity_id name type confidence_level logo_url website", "string"))
CATEGORY = struct(("primary detailed confidence_level", "string"))
MERCHANT = struct(("entity_id merchant_name name website", "string"))
LOCATION = struct(("address city region postal_code", "string"), ("latitude longitude", "double"))
PAYMENT_META = struct(
    (
        "reference_number ppd_id by_order_of payee payer payment_method payment_processor reason",
        "string",
    )
)

BUDGET_VALUES = struct(
    ("category_raw subcategory_raw category subcategory detail_category", "string"),
    ("budget_amount", "double"),
)
# What a budget file holds before a month is chosen; JSON has text keys only.
BUDGET_SOURCE = T.StructType(
    [*BUDGET_VALUES.fields, T.StructField("backfill", T.MapType(T.StringType(), T.DoubleType()))]
)
ACCOUNTS = struct(
    ("item_id persistent_account_id account_id account_mask account_name", "string"),
    ("account_official_name account_type account_subtype account_source", "string"),
    ("institution_id institution_name", "string"),
    ("balance", BALANCE),
    ("update_type", "string"),
    ("consent_expiration_time", "clock"),
    ("products billed_products", "texts"),
)
CURSORS = struct(("item_id next_cursor", "string"))
MISSING_PAGES = struct(("item_id", "string"), ("first_page last_page", "bigint"), ("reason", "string"))
INCOMPLETE_TRADES = struct(("item_id", "string"), ("received expected", "bigint"))
TRANSACTIONS = struct(
    ("item_id account_id transaction_id pending_transaction_id", "string"),
    ("is_pending", "boolean"),
    ("account_owner status", "string"),
    ("transaction_date", "date"),
    ("transaction_datetime", "clock"),
    ("authorized_date", "date"),
    ("authorized_datetime", "clock"),
    ("amount", "double"),
    ("currency_code unofficial_currency_code", "string"),
    ("category_info", CATEGORY),
    ("payment_channel", "string"),
    ("merchant", MERCHANT),
    ("counterparties", T.ArrayType(COUNTERPARTY)),
    ("location", LOCATION),
    ("check_number", "string"),
    ("payment_meta", PAYMENT_META),
    ("transaction_code", "string"),
    # where in the feed a version stood, so that versions have a full order
    ("feed_page feed_place", "bigint"),
)
TOMBSTONES = struct(("item_id account_id transaction_id", "string"), ("date_removed", "date"))
HOLDINGS = struct(
    ("item_id account_id", "string"),
    ("cost_basis institution_price", "double"),
    ("institution_price_date", "date"),
    ("institution_price_datetime", "clock"),
    ("institution_value", "double"),
    ("currency_code unofficial_currency_code", "string"),
    ("quantity vested_quantity vested_value", "double"),
    ("security", SECURITY),
)
TRADES = struct(
    ("item_id account_id investment_transaction_id", "string"),
    ("investment_date", "date"),
    ("investment_name", "string"),
    ("quantity amount price fees", "double"),
    ("investment_type investment_subtype", "string"),
    ("currency_code unofficial_currency_code", "string"),
    ("security", SECURITY),
)
MART = struct(
    ("partition_date", "date"),
    ("metric_category item_id account_id account_name account_subname account_type", "string"),
    ("transaction_id", "string"),
    ("transaction_date transaction_month", "date"),
    ("transaction_type", "string"),
    ("budget_amount", "double"),
    ("transactions_count", "bigint"),
    ("actual_amount", "double"),
    ("currency_code category_raw subcategory_raw category_updated", "string"),
    ("subcategory_updated category subcategory detail_category final_category", "string"),
    ("full_category payment_channel merchant_name merchant_name_raw", "string"),
    ("counterparty_name_raw name_raw merchant_type", "string"),
    ("institution_price quantity cost_basis", "double"),
    ("security_type security_name ticker_symbol", "string"),
)
TABLE_STATS = struct(
    ("dataset_id table_id", "string"),
    ("creation_time last_modified_time row_count size_bytes", "bigint"),
)


@dataclass(frozen=True)
class Table:
    """A table family: one logical table, partitioned by day, month or hour.

    ``required`` names the columns that must not be NULL, by kind of row: "" stands for every
    row, other kinds are tests that the checks define.
    """

    name: str
    schema: T.StructType
    grain: str | None = "day"
    comment: str = ""
    partition_col: str = "partition_date"
    required: dict[str, str] = field(default_factory=dict)


TABLES = {
    t.name: t
    for t in (
        Table(
            "budget_values", BUDGET_VALUES, "month", "category map and monthly budget",
            required={"": "category_raw subcategory_raw category subcategory"},
        ),
        Table(
            "financial_accounts", ACCOUNTS, "day", "account balances per day",
            required={
                "": "item_id account_name account_type account_subtype account_source balance.current "
                "balance.currency_code",
                "bank": "account_id institution_id institution_name update_type products billed_products",
            },
        ),
        Table(
            "cursors", CURSORS, "day", "change-feed cursor per item",
            required={"": "item_id next_cursor"},
        ),
        Table("temp_cursors", CURSORS, None, "cursors of the running job"),
        Table("missing_pages", MISSING_PAGES, "day", "ranges of pages that kept an item from loading"),
        Table("incomplete_trades", INCOMPLETE_TRADES, "day", "items with fewer trades than announced"),
        Table(
            "transactions", TRANSACTIONS, "day", "added and modified transactions",
            required={
                "": "item_id account_id transaction_id is_pending status transaction_date amount currency_code "
                "category_info.primary category_info.detailed category_info.confidence_level payment_channel "
                "merchant.name"
            },
        ),
        Table(
            "removed_transactions", TOMBSTONES, "day", "removed transactions",
            required={"": "item_id account_id transaction_id date_removed"},
        ),
        Table(
            "investment_holdings", HOLDINGS, "day", "positions per day",
            required={
                "": "item_id account_id institution_price institution_price_date institution_value quantity "
                "currency_code security.security_id security.currency_code security.is_cash_equivalent "
                "security.name security.type"
            },
        ),
        Table(
            "investment_transactions", TRADES, "day", "investment trades",
            required={
                "": "item_id account_id investment_transaction_id investment_date investment_name quantity amount "
                "price fees investment_type investment_subtype currency_code"
            },
        ),
        # a mart row has a date of its own, so the build day is the partition
        Table(
            "metric_mart", MART, "day", "one wide table of all metrics", "built_on",
            required={
                "": "partition_date metric_category transaction_date transaction_month actual_amount",
                "ACCOUNTS": "item_id account_name account_subname account_type currency_code",
                "INVESTMENTS": "item_id account_id account_name account_subname account_type currency_code "
                "transaction_id institution_price quantity security_name security_type",
                "TRANSACTIONS": "item_id account_id account_name account_subname account_type currency_code "
                "transaction_id transaction_type payment_channel merchant_name name_raw category_raw "
                "subcategory_raw category_updated subcategory_updated category subcategory final_category "
                "full_category",
                "TRANSACTIONS_AGG": "budget_amount transactions_count category final_category full_category",
                "LINE": "subcategory",
            },
        ),
    )
}

# ---------------------------------------------------------------- landed JSON pages

_RAW_SECURITY = struct(
    ("security_id iso_currency_code unofficial_currency_code", "string"),
    ("close_price", "double"),
    ("close_price_as_of update_datetime cusip institution_id", "string"),
    ("institution_security_id", "string"),
    ("is_cash_equivalent", "boolean"),
    ("isin market_identifier_code name", "string"),
    (
        "option_contract",
        struct(
            ("contract_type expiration_date", "string"),
            ("strike_price", "double"),
            ("underlying_security_ticker", "string"),
        ),
    ),
    ("proxy_security_id sedol ticker_symbol type", "string"),
)
_RAW_TRANSACTION = struct(
    ("account_id account_owner", "string"),
    ("amount", "double"),
    ("authorized_date authorized_datetime check_number", "string"),
    ("counterparties", T.ArrayType(COUNTERPARTY)),
    ("date datetime iso_currency_code", "string"),
    (
        "location",
        struct(("address city region postal_code", "string"), ("lat lon", "double")),
    ),
    ("merchant_entity_id merchant_name name payment_channel", "string"),
    ("payment_meta", PAYMENT_META),
    ("pending", "boolean"),
    ("pending_transaction_id", "string"),
    ("category_info", CATEGORY),
    ("transaction_code transaction_id unofficial_currency_code website", "string"),
)
_RAW_ACCOUNT = struct(
    ("persistent_account_id account_id mask name official_name type subtype", "string"),
    (
        "balances",
        struct(
            ("available current limit", "double"),
            ("iso_currency_code unofficial_currency_code", "string"),
        ),
    ),
)
_RAW_HOLDING = struct(
    ("account_id", "string"),
    ("cost_basis institution_price", "double"),
    ("institution_price_as_of institution_price_datetime", "string"),
    ("institution_value", "double"),
    ("iso_currency_code unofficial_currency_code", "string"),
    ("quantity vested_quantity vested_value", "double"),
    ("security_id", "string"),
)
_RAW_TRADE = struct(
    ("account_id investment_transaction_id date name", "string"),
    ("quantity amount price fees", "double"),
    ("type subtype iso_currency_code unofficial_currency_code security_id", "string"),
)
_ITEM = struct(("item_id", "string"))
ACCOUNT_PAGE = struct(
    ("accounts", T.ArrayType(_RAW_ACCOUNT)),
    (
        "item",
        struct(
            ("item_id institution_id update_type consent_expiration_time", "string"),
            ("products billed_products", "texts"),
        ),
    ),
)
# One landed file per response; ``item_id`` and ``page`` are put in by the lander.
SYNC_PAGE = struct(
    ("item_id", "string"),
    ("page", "bigint"),
    ("added modified", T.ArrayType(_RAW_TRANSACTION)),
    ("removed", T.ArrayType(struct(("account_id transaction_id", "string")))),
    ("has_more", "boolean"),
    ("next_cursor", "string"),
)
HOLDINGS_PAGE = struct(
    ("item", _ITEM),
    ("holdings", T.ArrayType(_RAW_HOLDING)),
    ("securities", T.ArrayType(_RAW_SECURITY)),
)
TRADES_PAGE = struct(
    ("item", _ITEM),
    ("page", "bigint"),
    ("investment_transactions", T.ArrayType(_RAW_TRADE)),
    ("securities", T.ArrayType(_RAW_SECURITY)),
    ("total_investment_transactions", "bigint"),
)
