import json
import random

from tallybook.operators.dedup import current_view, frontier, version_order
from tallybook.schemas import SYNC_PAGE
from tallybook.sources.pages import normalize_tombstones, normalize_transactions
from tallybook.streaming import feed
from pyspark.sql import functions as F


def tx(i, amount, day="2024-01-02", clock=None):
    return {"account_id": "a", "transaction_id": f"t{i}", "amount": amount, "date": day, "datetime": clock, "pending": False}


def page(name, day, n, added=(), modified=(), removed=()):
    gone = [{"account_id": "a", "transaction_id": f"t{i}"} for i in removed]
    return name, {"partition_date": day, "item_id": "i", "page": n, "added": list(added), "modified": list(modified), "removed": gone, "has_more": False, "next_cursor": f"c{n}"}


def drop(folder, *pages):
    folder.mkdir(exist_ok=True)
    for name, doc in pages:
        (folder / f"{name}.json").write_text(json.dumps(doc))


def run(spark, tmp_path, **k):
    q = feed.start_feed(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"), **k)
    assert q.awaitTermination(120)


def state(spark, tmp_path):
    return {r.transaction_id: r.amount for r in feed.current(spark, str(tmp_path / "out")).collect()}


# the modification lands before the transaction it changes, a removal before its addition
PAGES = [
    page("p1", "2024-01-03", 1, [], [tx(1, 11.0, clock="2024-01-02T09:00:00Z")], [3]),
    page("p2", "2024-01-02", 2, [tx(1, 10.0, clock="2024-01-02T08:00:00Z"), tx(2, 20.0), tx(3, 30.0)]),
    page("p3", "2024-01-04", 3, [tx(4, 40.0, "2024-01-04")], [tx(2, 21.0)]),
]


def test_feed_equals_batch(spark, tmp_path):
    drop(tmp_path / "in", *PAGES)
    run(spark, tmp_path, max_files=1)
    assert state(spark, tmp_path) == {"t1": 11.0, "t2": 21.0, "t4": 40.0}
    raw = spark.read.schema(feed._LANDED).json(str(tmp_path / "in"))
    batch = current_view(normalize_transactions(raw, keep=("partition_date",)), normalize_tombstones(raw, F.col("partition_date")))
    got = feed.current(spark, str(tmp_path / "out")).select(*batch.columns)
    assert got.exceptAll(batch).isEmpty() and batch.exceptAll(got).isEmpty()
    assert set(SYNC_PAGE.names) <= set(raw.columns)


def test_feed_resumes_and_replays(spark, tmp_path):
    drop(tmp_path / "in", *PAGES[:2])
    run(spark, tmp_path)
    assert state(spark, tmp_path) == {"t1": 11.0, "t2": 20.0}
    drop(tmp_path / "in", PAGES[2])
    run(spark, tmp_path)
    after = state(spark, tmp_path)
    assert after == {"t1": 11.0, "t2": 21.0, "t4": 40.0}
    assert [tuple(r) for r in feed.cursors(spark, str(tmp_path / "out")).collect()] == [("i", "c3")]
    # a batch that runs again after a failure overwrites itself
    raw = spark.read.schema(feed._LANDED).json(str(tmp_path / "in" / "p3.json"))
    feed.apply_batch(raw, 1, str(tmp_path / "out"))
    assert state(spark, tmp_path) == after
    versions = spark.read.parquet(str(tmp_path / "out" / "versions"))
    assert versions.groupBy("batch_id").count().orderBy("batch_id").collect()[1][1] == 2


# ------------------------------------------------------------------ compaction


def random_pages(seed, n):
    """Versions of few transactions with dates that contradict their clocks, and tombstones, in any order."""
    r = random.Random(seed)

    def date(r):
        return f"2024-01-{r.randint(1, 9):02d}"

    out = []
    for k in range(n):
        version = [tx(r.randint(1, 4), float(k), r.choice([date(r), None]), r.choice([None, f"{date(r)}T0{r.randint(0, 9)}:00:00Z"])) for _ in range(2)]
        for v in version:
            v["account_id"] = r.choice("ab")
        name, doc = page(f"p{k}", date(r), r.randint(1, 5), version[:1], version[1:])
        gone = {"account_id": r.choice("ab"), "transaction_id": f"t{r.randint(1, 4)}"}
        out.append((name, doc | {"removed": [gone] if r.random() < 0.4 else [], "next_cursor": f"c{k}"}))
        if r.random() < 0.1:
            out[-1][1]["partition_date"] = None
    return out


def landed(spark, folder, pages):
    folder.mkdir(parents=True, exist_ok=True)
    drop(folder / "raw", *pages)
    return spark.read.schema(feed._LANDED).json(str(folder / "raw"))


def as_rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_compacted_view_equals_the_whole_history(spark, tmp_path):
    """The same batches with compactions between them and without, read after each."""
    for seed in range(2):
        plain, folded = str(tmp_path / f"plain{seed}"), str(tmp_path / f"folded{seed}")
        pages = random_pages(seed, 24)
        for batch in range(6):
            raw = landed(spark, tmp_path / f"s{seed}b{batch}", pages[batch * 4 : batch * 4 + 4])
            for dst in (plain, folded):
                feed.apply_batch(raw, batch, dst)
            if batch % 2:
                assert feed.compact(spark, folded) == batch and feed.compact(spark, folded) == batch
                feed.clean(spark, folded, keep=1)
            assert as_rows(feed.current(spark, folded)) == as_rows(feed.current(spark, plain)), (seed, batch)
            assert as_rows(feed.cursors(spark, folded)) == as_rows(feed.cursors(spark, plain))
        assert feed.bases(spark, folded) == [5] and feed.bases(spark, plain) == []


def test_a_read_touches_the_base_and_newer_batches_only(spark, tmp_path):
    dst = str(tmp_path / "out")
    for batch, p in enumerate(PAGES):
        feed.apply_batch(landed(spark, tmp_path / str(batch), [p]), batch, dst)
        if batch == 1:
            feed.compact(spark, dst)
    plan = feed.current(spark, dst)._jdf.queryExecution().executedPlan().toString()
    files = {f.split("/out/")[1].rsplit("/", 1)[0] for f in feed.current(spark, dst).inputFiles()}
    assert "bases/upto=1/versions" in files
    assert plan.count("batch_id#") and "PartitionFilters: [isnotnull(batch_id" in plan
    read = spark.read.parquet(f"{dst}/versions").where("batch_id > 1")
    assert {f.split("batch_id=")[1][0] for f in read.inputFiles()} >= {"2"}
    # once cleaned, the older folders are gone and the state is the same
    before = as_rows(feed.current(spark, dst))
    assert feed.clean(spark, dst, keep=1) == 6
    assert as_rows(feed.current(spark, dst)) == before


def test_an_unfinished_base_is_not_read(spark, tmp_path):
    dst = str(tmp_path / "out")
    for batch, p in enumerate(PAGES):
        feed.apply_batch(landed(spark, tmp_path / str(batch), [p]), batch, dst)
    want = as_rows(feed.current(spark, dst))
    feed.compact(spark, dst)
    marker = tmp_path / "out" / "bases" / "upto=2" / feed.MARKER
    marker.unlink()
    spark.createDataFrame([], "a int").write.mode("overwrite").parquet(f"{dst}/bases/upto=2/versions")
    assert feed.bases(spark, dst) == [] and as_rows(feed.current(spark, dst)) == want
    assert feed.compact(spark, dst) == 2 and as_rows(feed.current(spark, dst)) == want


def test_frontier_of_a_hot_key(spark):
    """A third of the versions share one key: few are left, and they give the same winner."""
    rows = [("i", "a", f"t{k}" if k % 3 else None, f"2024-01-{1 + k % 5:02d}", k) for k in range(3000)]
    df = spark.createDataFrame(rows, "item_id string, account_id string, transaction_id string, day string, feed_page long")
    df = df.selectExpr(
        "item_id", "account_id", "transaction_id", "date(day) transaction_date", "date(day) partition_date",
        "cast(null as timestamp_ntz) transaction_datetime", "'ADDED' status", "feed_page", "0L feed_place", "1D amount",
    )
    kept = frontier(df, ["item_id", "account_id", "transaction_id"], "transaction_date", version_order())
    hot = kept.where("transaction_id IS NULL")
    assert [(r.feed_page, str(r.transaction_date)) for r in hot.collect()] == [(2994, "2024-01-05")]
    assert kept.count() == 2001
