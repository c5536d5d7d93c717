"""Rules for the ledger that the test tables are turned into, written from what they hold."""

from tallybook.plans.mart import MartRules

_LARGE = {"any": [{"col": "amount", "op": "gt", "value": 400000}, {"col": "amount", "op": "lt", "value": -400000}]}
_MOVE = {"col": "name_raw", "op": "startswith", "value": "MOVE"}
_GROCERS = {"col": "merchant_name_raw", "op": "in", "value": ["Merchant 3", "Merchant 4"]}

RULES = MartRules(
    account_name=[
        {"when": {"col": "account_source", "op": "eq", "value": "CRYPTO"}, "then": "Wallet"},
        {"when": {"col": "institution_name", "op": "eq", "value": "Bank 1"}, "then": "First"},
    ],
    account_subname=[
        {"when": {"col": "account_name", "op": "like", "value": "Savings %"}, "then": "Savings"},
        {"when": {"col": "account_type", "op": "in", "value": ["loan", "credit"]}, "then": {"col": "subtype_title"}},
    ],
    category=[
        {"when": _MOVE, "then": "EXCLUDE_CATEGORY"},
        {"when": _LARGE, "then": "LARGE"},
        {"when": _GROCERS, "then": "FOOD"},
    ],
    subcategory=[
        {"when": _MOVE, "then": "EXCLUDE_CATEGORY"},
        {"when": _GROCERS, "then": "FOOD_MARKET"},
        {"when": _LARGE, "then": "LARGE_ANY"},
        {
            "when": {
                "all": [
                    {"col": "subcategory_raw", "op": "eq", "value": "GOODS_TOOLS"},
                    {"col": "merchant_name_raw", "op": "not_in", "value": ["Merchant 7"]},
                ]
            },
            "then": "GOODS_BOOKS",
        },
    ],
    merchant=[
        {
            "when": {"col": "name_raw", "op": "regex", "value": "^ref [0-9]+"},
            "then": {"col": "name_raw", "extract": "^(ref [0-9]+)"},
        },
        {"when": {"col": "name_raw", "op": "eq", "value": "weekly basket", "fold": True}, "then": "Basket"},
    ],
    recode=[
        {
            "when": {
                "all": [
                    {"col": "category", "op": "eq", "value": "Hobby"},
                    {"col": "merchant_name", "op": "like", "value": "Merchant 1%"},
                ]
            },
            "then": "Gifts",
        }
    ],
)

#: Raw subcategories that no budget line maps on purpose.
UNMAPPED = ["MOVES_SAVINGS"]
