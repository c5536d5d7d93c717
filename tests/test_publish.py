"""Loads that fail or die leave the old content, and a reader sees old or new."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tallybook.plans import mart
from tallybook.schemas import struct
from tallybook.sources import publish
from tallybook.sources.partitions import scan
from tallybook.sources.tables import list_partitions, partition_days, write

SCHEMA = struct(("id", "bigint"))
DAY, OTHER = date(2024, 1, 2), date(2024, 1, 3)


def load(spark, root, n, day=DAY, **k):
    write(spark.range(n), root, SCHEMA, "TRUNCATE", day, **k)


def counts(spark, root):
    return {r[0]: r[1] for r in scan(spark, root, SCHEMA).groupBy("partition_date").count().collect()}


def broken(spark):
    return spark.range(9).select(F.when(F.col("id") == 5, F.raise_error("broken").cast("bigint")).otherwise(F.col("id")).alias("id"))


def test_a_failed_load_leaves_the_old_partition(spark, tmp_path):
    root = str(tmp_path / "t")
    load(spark, root, 3)
    load(spark, root, 4, OTHER)
    with pytest.raises(Exception, match="broken"):
        write(broken(spark), root, SCHEMA, "TRUNCATE", DAY)
    assert counts(spark, root) == {DAY: 3, OTHER: 4}
    load(spark, root, 0)
    assert counts(spark, root) == {OTHER: 4} and partition_days(spark, root) == [DAY, OTHER]
    assert list((tmp_path / "t" / publish.HIDDEN).iterdir()) == []


def test_a_failed_load_leaves_a_whole_table(spark, tmp_path):
    root = str(tmp_path / "t")
    write(spark.range(3), root, SCHEMA, grain=None)
    with pytest.raises(Exception, match="broken"):
        write(broken(spark), root, SCHEMA, grain=None)
    assert spark.read.parquet(root).count() == 3
    write(spark.read.schema(SCHEMA).parquet(root).where("id > 0"), root, SCHEMA, grain=None)
    assert spark.read.parquet(root).count() == 2  # a table may be replaced by what was read from it


def test_nothing_is_seen_while_it_is_built(spark, tmp_path):
    root = str(tmp_path / "t")
    load(spark, root, 3)
    with publish.publishing(spark, f"{root}/partition_date={DAY}") as path:
        spark.range(7).write.parquet(path)
        assert counts(spark, root) == {DAY: 3}
        assert list_partitions(spark, root).count() == 1
    assert counts(spark, root) == {DAY: 7}


@pytest.mark.parametrize("dies_at", [1, 2, 3])
def test_a_driver_that_dies_between_renames(spark, tmp_path, monkeypatch, dies_at):
    """Before the old folder is moved the old content stands; after it the new one is put in place."""
    root, moves = str(tmp_path / "t"), []
    load(spark, root, 3)

    def move(fs, source, target):
        moves.append(source)
        if len(moves) == dies_at:
            raise KeyboardInterrupt
        assert fs.rename(source, target)

    monkeypatch.setattr(publish, "_move", move)
    with pytest.raises(KeyboardInterrupt):
        load(spark, root, 8)
    monkeypatch.undo()
    assert publish.repair_table(spark, root) == (dies_at == 3)
    assert counts(spark, root) == {DAY: 8 if dies_at == 3 else 3}
    assert publish.repair_table(spark, root) == 0 and partition_days(spark, root) == [DAY]
    load(spark, root, 5)
    assert counts(spark, root) == {DAY: 5}


def test_a_mart_that_dies_between_its_writes(spark, tmp_path, monkeypatch):
    """Detail rows are written, then the aggregate fails: the old mart stands, whole."""
    from tests.test_mart import AS_OF, RULES, SF
    from workload.tables import ledger

    tables, root = ledger(spark, SF), str(tmp_path / "mart")

    def kinds(df):
        return {r[0]: r[1] for r in df.groupBy("metric_category").count().collect()}

    whole = kinds(mart.write_mart(tables, AS_OF, root, rules=RULES))
    assert whole["TRANSACTIONS_AGG"] > 0 and whole["TRANSACTIONS"] > 0

    def dies(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(mart, "aggregate_lines", dies)
        with pytest.raises(RuntimeError, match="killed"):
            mart.write_mart(tables, AS_OF, root, rules=RULES)
    assert kinds(scan(spark, root, mart.MART, partition=AS_OF, col="built_on")) == whole
    assert kinds(mart.write_mart(tables, AS_OF, root, rules=RULES)) == whole
