from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallybook.schemas import struct
from tallybook.sources import partitions as P
from tallybook.sources.tables import (
    copy,
    create_as,
    create_empty,
    drop_partitions,
    drop_table,
    list_partitions,
    partition_days,
    register,
    sql,
    write,
)
from tallybook.schemas import Table

SCHEMA = struct(("id", "bigint"), ("v", "double"))
DAYS = [date(2024, 1, d) for d in (1, 2, 3)]


def rows(spark, days=DAYS, per=2):
    data = [(i, float(i), d) for d in days for i in range(per)]
    return spark.createDataFrame(data, "id bigint, v double, partition_date date")


@pytest.fixture
def root(spark, tmp_path):
    path = str(tmp_path / "t")
    write(rows(spark), path, SCHEMA)
    return path


def counts(spark, root):
    df = P.scan(spark, root, SCHEMA).groupBy("partition_date").count()
    return {r[0]: r[1] for r in df.collect()}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_partition(spark, root):
    one = P.scan(spark, root, SCHEMA, partition=DAYS[1])
    assert one.count() == 2
    assert "PartitionFilters: [isnotnull(partition_date" in plan(one)


def test_latest_prunes_at_run_time(spark, root):
    newest = P.latest(P.scan(spark, root, SCHEMA), 2)
    assert {(r.partition_date, r.age) for r in newest.collect()} == {(DAYS[2], 0), (DAYS[1], 1)}
    assert "dynamicpruning" in plan(newest)
    last = P.latest_partition(P.scan(spark, root, SCHEMA))
    assert {r.partition_date for r in last.collect()} == {DAYS[2]}


def test_latest_two_needs_two(spark, root):
    one = P.scan(spark, root, SCHEMA, partition=DAYS[0])
    assert P.latest(one, 1).count() == 2
    with pytest.raises(Exception, match="fewer than 2"):
        P.latest(one, 2).collect()


def test_range_bounds(spark, root):
    df = P.scan(spark, root, SCHEMA)

    def days(**k):
        return sorted({r.partition_date for r in P.in_range(df, **k).collect()})

    assert days(start="2024-01-02") == DAYS[1:]
    assert days(end="20240102") == DAYS[:1]
    assert days(start=DAYS[0], end=DAYS[2]) == DAYS[:2]
    for bad in (
        {},
        {"start": "2024-01-02", "end": "2024-01-02"},
        {"start": "2024-01"},
        {"start": "2024-01-01", "grain": "week"},
    ):
        with pytest.raises(ValueError):
            P.in_range(df, **bad)


def test_month_and_hour_grain(spark, tmp_path):
    months = spark.createDataFrame([(1, 1.0, date(2024, m, 1)) for m in (1, 2, 3)], "id bigint, v double, partition_date date")
    path = str(tmp_path / "m")
    write(months, path, SCHEMA, grain="month")
    got = P.in_range(P.scan(spark, path, SCHEMA, "month"), "2024-02", grain="month")
    assert got.count() == 2
    hours = spark.createDataFrame([(1, 1.0, datetime(2024, 1, 1, h)) for h in (1, 2)], "id bigint, v double, partition_date timestamp_ntz")
    path = str(tmp_path / "h")
    write(hours, path, SCHEMA, grain="hour")
    got = P.scan(spark, path, SCHEMA, "hour", datetime(2024, 1, 1, 2))
    assert got.count() == 1


def test_sharded_folders(spark, tmp_path):
    for d in DAYS:
        rows(spark, [d]).drop("partition_date").write.parquet(f"{tmp_path}/ev_{d:%Y%m%d}")
    df = P.scan_sharded(spark, str(tmp_path), "ev", SCHEMA)
    assert {(r[0], r[1]) for r in df.groupBy("partition_date").count().collect()} == {(d, 2) for d in DAYS}
    assert df.where(F.col("partition_date") == F.lit(DAYS[0])).count() == 2


def test_truncate_replaces_only_its_partition(spark, root):
    write(rows(spark, [DAYS[0]], 5).drop("partition_date"), root, SCHEMA, "TRUNCATE", DAYS[0])
    assert counts(spark, root) == {DAYS[0]: 5, DAYS[1]: 2, DAYS[2]: 2}
    write(rows(spark, [DAYS[0]], 1), root, SCHEMA, "APPEND")
    assert counts(spark, root)[DAYS[0]] == 6


def test_empty_disposition(spark, root):
    write(rows(spark, [date(2024, 2, 1)]), root, SCHEMA, "EMPTY")
    with pytest.raises(ValueError, match="already holds rows"):
        write(rows(spark, [DAYS[0]]), root, SCHEMA, "EMPTY")
    with pytest.raises(ValueError, match="already holds rows"):
        write(rows(spark, [DAYS[0]]).drop("partition_date"), root, SCHEMA, "EMPTY", DAYS[0])
    with pytest.raises(ValueError, match="disposition"):
        write(rows(spark), root, SCHEMA, "REPLACE")
    assert len(counts(spark, root)) == 4


def test_retention(spark, tmp_path):
    days = [date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 31)]
    path = str(tmp_path / "t")
    write(rows(spark, days), path, SCHEMA)
    listed = list_partitions(spark, path)
    assert [r[0] for r in listed.collect()] == days
    old = P.retention_candidates(listed, date(2024, 1, 31), 30)
    assert [r[0] for r in old.collect()] == [date(2024, 1, 1)]
    assert drop_partitions(spark, path, old) == 1
    assert set(counts(spark, path)) == set(days[1:])
    with pytest.raises(FileNotFoundError, match="no partition 2024-01-01"):
        drop_partitions(spark, path, old)
    assert drop_table(spark, path)


def test_dependency_report(spark):
    listing = spark.createDataFrame([(DAYS[0], 3), (DAYS[1], 0)], "partition_date date, row_count bigint")
    want = spark.createDataFrame([(d,) for d in DAYS], "partition_date date")
    got = {tuple(r) for r in P.dependency_report(want, listing).collect()}
    assert got == {(DAYS[0], True, True), (DAYS[1], True, False), (DAYS[2], False, False)}


def test_empty_table_and_copy(spark, root, tmp_path):
    path = str(tmp_path / "e")
    create_empty(spark, path, SCHEMA, None)
    empty = P.scan(spark, path, SCHEMA, None)
    assert empty.count() == 0 and empty.columns == ["id", "v"]
    target = str(tmp_path / "copy")
    copy(spark, root, target, SCHEMA)
    copy(spark, root, target, SCHEMA)
    assert counts(spark, target) == counts(spark, root)


def test_create_as_and_parameters(spark, root, tmp_path):
    source = Table("ledger_rows", SCHEMA, comment="all rows")
    register(spark, root, source)
    target = Table("ledger_day", SCHEMA, comment="one day's rows")
    text = "SELECT id, v * :factor AS v FROM IDENTIFIER(:t) WHERE partition_date = :day"
    args = {"t": "ledger_rows", "factor": 10, "day": DAYS[1]}
    got = create_as(spark, text, args, str(tmp_path / "ctas"), Table("ledger_day", SCHEMA, comment="one day"), partition=DAYS[1])
    assert sorted(tuple(r) for r in got.collect()) == [(0, 0.0, DAYS[1]), (1, 10.0, DAYS[1])]
    assert spark.catalog.getTable("ledger_day").description == "one day"
    assert sql(spark, text, args).count() == 2
    assert target.comment


def test_table_stats_reads_no_column(spark, root):
    stats = P.table_stats(P.scan(spark, root, SCHEMA), P.stored_files(spark, root), "d", "t")
    r = stats.first()
    assert (r.dataset_id, r.table_id, r.row_count) == ("d", "t", 6)
    assert r.size_bytes > 0 and r.last_modified_time >= r.creation_time
    assert "ReadSchema: struct<>" in plan(stats)


def test_partition_stats(spark, root):
    create_empty(spark, root, SCHEMA, partition=date(2024, 1, 9))
    name = F.concat(F.lit("t_"), F.date_format("partition_date", "yyyyMMdd"))
    stats = P.table_stats(P.scan(spark, root, SCHEMA), P.stored_files(spark, root), "d", name, "partition_date")
    got = {r.table_id: (r.row_count, r.size_bytes > 0) for r in stats.collect()}
    assert got == {f"t_{d:%Y%m%d}": (2, True) for d in DAYS} | {"t_20240109": (0, True)}


def test_truncate_with_nothing_leaves_an_empty_partition(spark, root):
    write(rows(spark).where("false"), root, SCHEMA, "TRUNCATE", DAYS[0])
    assert counts(spark, root) == {DAYS[1]: 2, DAYS[2]: 2}
    assert partition_days(spark, root) == DAYS
    create_empty(spark, root, SCHEMA, partition=date(2024, 1, 9))
    create_empty(spark, root, SCHEMA, partition=DAYS[1], disposition="APPEND")
    with pytest.raises(ValueError, match="already holds rows"):
        create_empty(spark, root, SCHEMA, partition=DAYS[1], disposition="EMPTY")
    assert counts(spark, root) == {DAYS[1]: 2, DAYS[2]: 2}
    assert partition_days(spark, root)[-1] == date(2024, 1, 9)
    with pytest.raises(ValueError, match="needs the partition"):
        create_empty(spark, root, SCHEMA)


@pytest.mark.parametrize(
    "grain,values,kept",
    [
        ("day", [date(2024, 1, 1), date(2024, 1, 2)], [date(2024, 1, 1), date(2024, 1, 2)]),
        ("month", [date(2024, 5, 1), date(2024, 5, 17), date(2024, 6, 30)], [date(2024, 5, 1), date(2024, 6, 1)]),
        ("hour", [datetime(2024, 1, 1, 5), datetime(2024, 1, 1, 5, 59), datetime(2024, 1, 1, 23)], [datetime(2024, 1, 1, 5), datetime(2024, 1, 1, 23)]),
    ],
)
def test_listing_and_dropping_by_grain(spark, tmp_path, grain, values, kept):
    path, kind = str(tmp_path / grain), "timestamp_ntz" if grain == "hour" else "date"
    data = spark.createDataFrame([(k, 1.0, v) for k, v in enumerate(values)] + [(99, 1.0, None)], f"id bigint, v double, partition_date {kind}")
    write(data, path, SCHEMA, grain=grain)
    assert partition_days(spark, path, grain=grain) == kept
    assert P.scan(spark, path, SCHEMA, grain, values[1]).count() == sum(P.at_grain(v, grain) == P.at_grain(values[1], grain) for v in values)
    write(data.where("id = 0"), path, SCHEMA, "TRUNCATE", values[1], grain)
    assert P.scan(spark, path, SCHEMA, grain, values[1]).count() == 1
    listed = list_partitions(spark, path, grain=grain)
    assert drop_partitions(spark, path, listed) == len(kept)
    assert partition_days(spark, path, grain=grain) == []
    assert P.scan(spark, path, SCHEMA, grain).count() == 1  # the row without a partition


def test_sharded_range_reads_its_folders_only(spark, tmp_path):
    for d in DAYS:
        rows(spark, [d]).drop("partition_date").coalesce(1).write.parquet(f"{tmp_path}/ev_{d:%Y%m%d}")
    rows(spark, DAYS[:1]).drop("partition_date").write.parquet(f"{tmp_path}/ev_other_20240101")
    one = P.scan_sharded(spark, str(tmp_path), "ev", SCHEMA, start="20240102", end="20240103")
    assert len(one.inputFiles()) == 1 and {r.partition_date for r in one.collect()} == {DAYS[1]}
    assert P.scan_sharded(spark, str(tmp_path), "ev", SCHEMA, start="2025").count() == 0
    assert P.scan_sharded(spark, str(tmp_path), "ev", SCHEMA).count() == 6


def test_comment_with_an_apostrophe_and_a_second_registration(spark, root):
    first = Table("ledger_quoted", SCHEMA, comment="one day's rows")
    assert register(spark, root, first).count() == 6
    assert register(spark, root, first).count() == 6
    assert spark.catalog.getTable("ledger_quoted").description == "one day's rows"
