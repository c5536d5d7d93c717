"""Token balances to account rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.operators.shape import conform
from tallybook.schemas import ACCOUNTS

# Smallest units per whole token.
UNIT_SCALE = {"BTC": 1e8, "ETH": 1e18}
TOKEN_SOURCE = "CRYPTO"


def value_balances(
    balances: DataFrame, rates: DataFrame, scale: dict[str, float] | None = None
) -> DataFrame:
    """Account rows for (address, unit, raw_amount) × (unit, usd_rate).

    Raw amounts are added as decimals of 38 digits before scaling, so large counts of
    the smallest unit stay exact.
    """
    per_address = balances.groupBy("address", "unit").agg(
        F.sum(F.col("raw_amount").cast("decimal(38,0)")).cast("double").alias("raw")
    )
    scales = UNIT_SCALE if scale is None else scale
    divisor = F.coalesce(*[F.when(F.col("unit") == u, F.lit(float(s))) for u, s in scales.items()])
    valued = per_address.join(rates, "unit", "left").withColumn("amount", F.col("raw") / divisor)
    none = F.lit(None).cast("string")
    rows = valued.select(
        F.col("address").alias("item_id"),
        F.col("unit").alias("account_name"),
        F.col("unit").alias("account_official_name"),
        F.lit("investment").alias("account_type"),
        F.lit("cryptocurrency").alias("account_subtype"),
        F.lit(TOKEN_SOURCE).alias("account_source"),
        none.alias("institution_id"),
        F.struct(
            F.col("amount").alias("available"),
            (F.col("amount") * F.col("usd_rate")).alias("current"),
            F.lit(None).cast("double").alias("limit"),
            F.lit("USD").alias("currency_code"),
            F.col("unit").alias("unofficial_currency_code"),
        ).alias("balance"),
        F.array().cast("array<string>").alias("products"),
        F.array().cast("array<string>").alias("billed_products"),
    )
    return conform(rows, ACCOUNTS)
