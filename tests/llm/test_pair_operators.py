"""Operators on pairs of texts and vectors, against brute force on small tables."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallybook.llm import common, graph_index, minhash, multi_index

SF = "/root/testdata/sf0.001"


def groups(nodes, links):
    """Smallest reachable node of each node."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_cycles(spark):
    random = np.random.default_rng(3)
    links = [(k, k + 1) for k in range(100, 160)] + [(200, k) for k in range(201, 280)] + [(300, 301), (301, 302), (302, 300), (5, 5)]
    links += [tuple(map(int, random.integers(1000, 1400, 2))) for _ in range(250)]
    got = {r["id"]: r["root"] for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == groups(nodes, [x for x in links if x[0] != x[1]])
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_hashes_follow_words_alone():
    texts = ["a B  c", "c\tb\na", "", " a ", "aé É"]
    data = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, data)])
    hashes, starts, ends, edges = common.word_hashes(np.frombuffer(b"".join(data), dtype=np.uint8), bounds)
    words = [re.findall("[^\x20\x09-\x0d]+", t) for t in texts]
    assert list(np.diff(edges)) == [len(w) for w in words]
    flat = ["".join(c.lower() if c.isascii() else c for c in w) for row in words for w in row]
    assert len(set(hashes.tolist())) == len(set(flat))
    assert all((hashes[i] == hashes[j]) == (flat[i] == flat[j]) for i in range(len(flat)) for j in range(len(flat)))


# ------------------------------------------------------------------ near-duplicate texts


def shingle_set(text):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def near_by_definition(rows):
    sets = [(d, shingle_set(t)) for d, t in rows]
    by_shingle, pairs = {}, set()
    for k, (_, s) in enumerate(sets):
        for x in s:
            by_shingle.setdefault(x, []).append(k)
    for ks in by_shingle.values():
        pairs.update((a, b) for i, a in enumerate(ks) for b in ks[i + 1 :])
    links = [
        (sets[a][0], sets[b][0])
        for a, b in pairs
        if 100 * len(sets[a][1] & sets[b][1]) >= 75 * len(sets[a][1] | sets[b][1])
    ]
    roots = groups({d for d, _ in rows}, links)
    return sorted((d, len(s), roots[d], roots[d] == d) for d, s in sets)


def edited(words, random, n):
    words = list(words)
    for _ in range(n):
        words[int(random.integers(len(words)))] = f"new{int(random.integers(10**9))}"
    return " ".join(words)


def rows_with_copies():
    random = np.random.default_rng(9)
    rows = []
    for group in range(25):
        base = [f"w{int(x)}" for x in random.integers(0, 5000, int(random.integers(8, 150)))]
        for _ in range(int(random.integers(1, 9))):
            rows.append(edited(base, random, int(random.integers(0, 1 + len(base) // 12))))
    rows += ["same exact text"] * 40 + ["SAME  exact\ttext", "one", "", None, " \n", "Ä b", "ä b"]
    order = random.permutation(len(rows))
    return [(k, rows[i]) for k, i in enumerate(order)]


def run_near(spark, rows):
    table = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, class string, n int")
    return sorted(map(tuple, minhash.near_duplicates(table).collect()))


def test_near_duplicates_by_definition(spark):
    rows = rows_with_copies()
    assert run_near(spark, rows) == near_by_definition(rows)


def test_near_duplicates_of_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = sorted(map(tuple, minhash.near_duplicates(docs).collect()))
    assert got == near_by_definition([tuple(r) for r in docs.collect()])


def test_near_duplicates_without_a_common_pivot(spark, monkeypatch):
    """A chain: neighbours link, distant ones don't; and a crowd that shares many bands and has to
    be compared in several cells."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    words = [f"c{k}" for k in range(200)]
    rows = []
    for k in range(20):
        rows.append((k, " ".join(words[4 * k : 4 * k + 100])))
    crowd = [f"x{k}" for k in range(60)]
    rows += [(1000 + k, " ".join(crowd + [f"y{k}z{j}" for j in range(22)])) for k in range(40)]
    assert run_near(spark, rows) == near_by_definition(rows)


@pytest.mark.parametrize("block", [7, 1024])
def test_near_duplicates_of_a_star_and_a_crowd_around_it(spark, monkeypatch, block):
    """Leaves link with the centre and not with each other; around them, texts just below the threshold
    to all, of which some pairs link."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "ROWS_AT_ONCE", 5)
    random = np.random.default_rng(2)
    base = [f"s{k}" for k in range(120)]

    def changed(places, mark):
        return " ".join(f"{mark}x{k}" if k in places else w for k, w in enumerate(base))

    rows = [(500, " ".join(base))]
    rows += [(501 + k, changed({5 + 3 * k, 60 + k, 110}, f"l{k}")) for k in range(18)]
    for k in range(70):
        places = set(random.choice(120, int(random.integers(5, 11)), replace=False).tolist())
        rows.append((600 + 2 * k, changed(places, f"c{k}")))
        if k % 5 == 0:
            rows.append((601 + 2 * k, changed(places | {1}, f"c{k}")))
    want = near_by_definition(rows)
    sizes = sorted((sum(w[2] == r for w in want) for r in {w[2] for w in want}), reverse=True)
    assert sizes[0] >= 19 and sizes.count(1) > 10 and 2 in sizes
    assert run_near(spark, rows) == want


def test_survivors_of_cells_are_met_once(spark, monkeypatch):
    """Whatever the blocks, the pairs that go on to the exact check are the same."""
    docs = spark.createDataFrame(rows_with_copies(), "doc_id long, text string")
    found = []
    for block in (3, 1024):
        monkeypatch.setattr(minhash, "BLOCK", block)
        classes = minhash._sets(docs, True).where("n > 0").groupBy("class").agg(F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("data").alias("data"))
        held = classes.select("class", "data", "n", F.col("n").alias("common"))
        named = minhash._bands(classes).select("bucket", "band", "class", (F.col("class") % 3).alias("root"))
        sets = minhash._sets(docs, False).where("n > 0").dropDuplicates(["class"]).select("class", "data")
        pairs = minhash._cells(named, held, sets)
        found.append(sorted(map(tuple, pairs.collect())))
    assert found[0] == found[1] and len(set(found[0])) == len(found[0]) > 0


def test_near_duplicates_shared_and_null_ids(spark):
    long = " ".join(f"q{k}" for k in range(40))
    rows = [(1, long), (1, "other text"), (2, "other text"), (3, long + " end"), (None, long), (None, None), (7, "alone")]
    got = run_near_nulls(spark, rows)
    assert {r for r in got if r[0] in (1, 2, 3)} == {(1, 36, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 37, 1, False)}
    assert (None, 36, None, False) in got and (None, 0, None, False) in got and (7, 1, 7, True) in got
    table = spark.createDataFrame(rows, "doc_id long, text string")
    kept = minhash.drop_near_duplicates(table).collect()
    # a text that only shares its id with another one isn't lost
    assert sorted(str(r["doc_id"]) for r in kept) == ["1", "1", "7", "None", "None"]
    assert {r["text"] for r in kept} == {long, "other text", "alone", None}
    again = minhash.drop_near_duplicates(table.union(table).union(spark.createDataFrame([(8, ""), (8, "")], table.schema)))
    assert sorted(str(r["doc_id"]) for r in again.collect()) == ["1", "1", "7", "8", "8", *["None"] * 4]


def run_near_nulls(spark, rows):
    return [tuple(r) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()]


def test_near_duplicates_empty_table(spark):
    table = spark.createDataFrame([], "doc_id long, text string, kept string")
    assert minhash.near_duplicates(table).count() == 0 and minhash.drop_near_duplicates(table).schema == table.schema


def test_posterior_bound_keeps_true_pairs():
    random = np.random.default_rng(0)
    for compared in range(minhash.BATCH, 201, minhash.BATCH):
        least = minhash.least_matches(compared, 0.75, minhash.MISS)
        assert (random.binomial(compared, 0.75, 200_000) < least).mean() < 1e-4
        assert least > 0.35 * compared


# ------------------------------------------------------------------ near-duplicate vectors

KIND = "vec_id long, embedding array<float>, label int, class string, vector int"


def vectors():
    random = np.random.default_rng(4)
    rows = []
    for k in range(60):
        base = random.normal(size=16)
        for _ in range(int(random.integers(1, 12))):
            v = base + random.normal(size=16) * random.choice([0, 0.02, 0.05, 0.08]) * np.linalg.norm(base) / 4
            rows.append(((v * random.choice([1, 1, 2.5])).tolist(), int(random.integers(3)) if k % 5 else None))
    rows += [([1.0] * 16, 1)] * 30 + [([0.0] * 16, 1), (None, 1), ([float("nan")] * 16, 1), ([float("inf")] * 16, 1)]
    rows += [([1.0, None] * 8, 1), ([], 1), ([1.0, 2.0], 1), ([2.0, 4.0], 1), ([3.0], 1), ([5.0], 1), ([-1.0], 1)]
    order = random.permutation(len(rows))
    return [(k, rows[i][0], rows[i][1], "x", 7) for k, i in enumerate(order)]


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def test_vector_links_by_definition(spark):
    rows = vectors()
    data = [(i, np.float32(v).astype(float) if usable(v) else None, label) for i, v, label, *_ in rows]
    links = [
        (a, b)
        for n, (a, x, p) in enumerate(data)
        for b, y, q in data[n + 1 :]
        if x is not None and y is not None and p is not None and p == q and len(x) == len(y)
        and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98
    ]
    roots = groups({r[0] for r in rows}, links)
    degree = {r[0]: sum(r[0] in link for link in links) for r in rows}
    want = sorted((i, degree[i], roots[i], roots[i] == i) for i in roots)
    got = sorted(map(tuple, multi_index.near_duplicates(spark.createDataFrame(rows, KIND)).collect()))
    assert got == want


@pytest.mark.parametrize("cell", [4, 64])
def test_vector_links_of_the_table(spark, cell, monkeypatch):
    monkeypatch.setattr(multi_index, "CELL", cell)
    monkeypatch.setattr(multi_index, "BLOCK", 2 * cell)
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = table.collect()
    x = np.array([r["embedding"] for r in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    labels = np.array([r["label"] for r in rows])
    linked = (x @ x.T >= 0.98) & (labels[:, None] == labels[None, :])
    ids = np.array([r["vec_id"] for r in rows])
    links = [(int(ids[i]), int(ids[j])) for i, j in zip(*np.nonzero(np.triu(linked, 1)))]
    roots = groups(set(ids.tolist()), links)
    want = sorted((int(i), int(n) - 1, roots[int(i)], roots[int(i)] == int(i)) for i, n in zip(ids, linked.sum(axis=1)))
    assert sorted(map(tuple, multi_index.near_duplicates(table).collect())) == want


def test_walk_visits_every_cell_within_the_limit():
    random = np.random.default_rng(8)
    one, two = random.random(9), random.random(7)
    got = list(multi_index.walk(one, two, 0.8))
    sums = [one[i] + two[j] for i, j in got]
    assert sums == sorted(sums)
    assert set(got) == {(i, j) for i in range(9) for j in range(7) if one[i] + two[j] <= 0.8}


def test_vectors_empty_and_null_ids(spark):
    assert multi_index.near_duplicates(spark.createDataFrame([], KIND)).count() == 0
    rows = [(None, [1.0, 2.0], 1, "", 0), (4, [1.0, 2.0], 1, "", 0), (4, [1.0, 2.0], 1, "", 0), (9, [2.0, 4.0], 1, "", 0)]
    got = sorted(map(str, map(tuple, multi_index.near_duplicates(spark.createDataFrame(rows, KIND)).collect())))
    assert got == ["(4, 3, 4, True)", "(4, 3, 4, True)", "(9, 3, 4, False)", "(None, 3, None, False)"]


# ------------------------------------------------------------------ nearest neighbours


def exact_neighbours(rows, k=20, every=20):
    out = {}
    for q, x in rows:
        if q % every == 0:
            scores = sorted((-float(x @ y), v) for v, y in rows if v != q and len(y) == len(x))
            out[q] = scores[:k]
    return out


@pytest.mark.parametrize("shard", [150, 8192])
def test_neighbours_reach_recall(spark, shard, monkeypatch):
    monkeypatch.setattr(graph_index, "SHARD", shard)
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], np.array(r["embedding"], dtype=np.float64)) for r in table.collect()]
    want, found, total = exact_neighbours(rows), 0, 0
    got = {}
    by_id = dict(rows)
    for r in graph_index.search(table).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
        assert r["score"] == pytest.approx(float(by_id[r["query_id"]] @ by_id[r["vec_id"]]), abs=1e-12)
    assert set(got) == set(want)
    for q, near in got.items():
        near.sort()
        assert [n[0] for n in near] == list(range(1, 21))
        assert near == sorted(near, key=lambda n: (-n[2], n[1]))
        found += len({n[1] for n in near} & {v for _, v in want[q]})
        total += 20
    assert found / total >= 0.97


@pytest.mark.parametrize("n", [8192, 20000])
@pytest.mark.parametrize("kind", ["unit", "gaussian", "log-normal"])
def test_neighbours_of_any_length(spark, kind, n):
    """Recall against brute force over full shards, for vectors without any clusters."""
    random = np.random.default_rng(n)
    x = random.normal(size=(n, 64))
    if kind == "unit":
        x /= np.linalg.norm(x, axis=1)[:, None]
    if kind == "log-normal":
        x *= np.exp(random.normal(size=n))[:, None]
    table = spark.createDataFrame(pa.table({"vec_id": np.arange(n), "embedding": list(x)}))
    got = {}
    for r in graph_index.search(table, every=80).select("query_id", "vec_id").collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    found = 0
    for q in range(0, n, 80):
        scores = x @ x[q]
        scores[q] = -np.inf
        found += len(got[q] & set(np.argsort(-scores)[:20].tolist()))
    assert found / (20 * len(range(0, n, 80))) >= 0.95


def test_neighbours_of_extreme_lengths(spark):
    """Squares beyond the range of a double, beside vectors near zero."""
    random = np.random.default_rng(8)
    x = random.normal(size=(60, 4)) * 10.0 ** random.choice([-150, -70, 0, 1, 70, 150], 60)[:, None]
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    want = exact_neighbours(list(enumerate(x)), k=59)
    got = {}
    for r in graph_index.search(table, k=59).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q, near in got.items():
        assert [v for _, v, _ in sorted(near)] == [v for _, v in want[q]]
    assert set(got) == {0, 20, 40}


def test_neighbours_odd_rows(spark):
    """Few candidates, ties, copies, other lengths, unusable vectors, repeated rows."""
    rows = [(20 * k, [float(k % 3), 1.0]) for k in range(30)] + [(7, None), (9, [0.0, 0.0]), (11, [1.0, None]), (40, [2.0, 1.0])]
    rows += [(13, [float("inf"), 1.0]), (None, [1.0, 1.0]), (15, [1.0, 2.0, 3.0]), (600, [1.0, 0.0, 0.0])]
    kind = "vec_id long, embedding array<float>, size string, rank int"
    table = spark.createDataFrame([(i, v, "x", 0) for i, v in rows], kind)
    got = {}
    for r in graph_index.search(table).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    plain = {i: np.float32(v).astype(float) for i, v in rows if i is not None and usable(v)}
    want = exact_neighbours(sorted(plain.items()))
    assert set(got) == {q for q in want if want[q]}
    for q, near in got.items():
        assert [(-s, v) for _, v, s in sorted(near)] == want[q]
    assert got[600] == [(1, 15, 1.0)]
    assert graph_index.search(table.limit(0)).count() == 0
    assert graph_index.search(table.where("vec_id = 20")).count() == 0
