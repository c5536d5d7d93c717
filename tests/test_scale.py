"""Plan properties that matter when a key holds much of a table."""

from pyspark.sql import functions as F

from tallybook.operators.budgeting import actuals
from tallybook.operators.dedup import latest_by
from tallybook.operators.joins import enrich


def hot(spark, n=60_000):
    """A third of all rows under one key, another third under NULL."""
    i = F.col("id")
    key = F.when(i % 3 == 0, F.lit(7)).when(i % 3 == 1, F.lit(None)).otherwise(i)
    pad = F.repeat(F.md5(i.cast("string")), 4)
    return spark.range(0, n, 1, 8).select(key.cast("bigint").alias("k"), i.alias("v"), pad.alias("pad"))


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def settings(spark, **conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return old


def test_hot_and_null_keys_are_split_in_a_join(spark):
    old = settings(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.shuffle.partitions": "16",
        },
    )
    try:
        dim = spark.range(0, 60_000, 1, 8).select(F.col("id").alias("k"), (F.col("id") * 2).alias("name"))
        joined = enrich(hot(spark), dim, ["k"])
        # an aggregate on the same key must not keep the hot partition in one piece
        longest = F.max(F.length("pad"))
        counted = joined.groupBy("k").agg(F.count("name").alias("n"), longest.alias("longest"))
        rows, plan = final_plan(counted)
        got = {r.k: r.n for r in rows}
        assert got[7] == 20_000 and got[None] == 0 and got[2] == 1
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_dedup_sends_one_row_per_key_and_task(spark):
    newest = latest_by(hot(spark).where("k = 7 OR k IS NULL"), ["k"], [F.desc("v")])
    rows, plan = final_plan(newest)
    assert {r.k: r.v for r in rows} == {7: 59_997, None: 59_998}
    assert plan.count("WindowGroupLimit") >= 2
    partial = [line for line in plan.splitlines() if "WindowGroupLimit" in line and "Partial" in line]
    assert partial


def test_distinct_count_shuffles_on_the_counted_value(spark):
    month = F.lit("2024-01-01").cast("date")
    tx = hot(spark).repartition(8).select(
        month.alias("transaction_month"),
        F.lit("c").alias("category"),
        F.lit("s").alias("subcategory"),
        F.lit(None).cast("string").alias("detail_category"),
        F.col("v").cast("double").alias("actual_amount"),
        F.col("v").alias("transaction_id"),
    )
    rows, plan = final_plan(actuals(tx))
    assert rows[0].transactions_count == 60_000
    # one group holds everything, yet its ids are spread over the reducers first
    exchange = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("transaction_id" in line for line in exchange), plan
    assert "partial_sum" in plan


def test_unique_ids_are_counted_without_a_shuffle_of_their_own(spark):
    month = F.lit("2024-01-01").cast("date")
    tx = hot(spark).select(
        month.alias("transaction_month"), F.lit("c").alias("category"), F.lit("s").alias("subcategory"),
        F.lit(None).cast("string").alias("detail_category"), F.col("v").cast("double").alias("actual_amount"),
        F.col("v").alias("transaction_id"),
    )
    rows, plan = final_plan(actuals(tx, unique=True))
    assert rows[0].transactions_count == 60_000
    assert plan.split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1
