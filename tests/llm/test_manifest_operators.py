"""Merkle manifest, token counts and source divergence, against brute force on small tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallybook.llm import divergence, merkle, token_counts

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")

ODD = [
    None, "", " ", "  a  b\nc ", "a \nb", "it's  a <|endoftext|> test", "<|endoftext|><|endoftext|>", "é é x", "x" * 3000,
    "A\tb c", "\x1c\x1d a\x1fb \x85 c d　 e", "don't,'s x'LL 'tis", "日本語 テキスト 🙂🙂", "word " * 4000,
    "١٢٣ ½ Ⅷ ʰ́ ​﻿", "\U0001d7d8\U00010400 \U0002a6d6 \U000e0041", "a\r\n\r\n  b", "naïve Ǆ ﬁ ß", "the " * 9,
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def table(spark, rows):
    """Rows, and other columns whose names the operators use themselves."""
    extra = ", idx long, tree string, total long, block long, term string, n long, rank string, nodes string"
    wide = [(*r, 7, "t", 3, 1, "q", 2, "r", "s") for r in rows]
    return spark.createDataFrame(wide, DOCS + extra)


# ------------------------------------------------------------------ manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def grown(nodes):
    """All levels of a tree of ``nodes``."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][k : k + 8])) for k in range(0, len(levels[-1]), 8)])
    return levels


def walked(levels, k):
    """Place and others of each run on the way from node ``k`` to the root."""
    out = []
    for level in levels[:-1]:
        run = level[k // 8 * 8 : k // 8 * 8 + 8]
        out.append((k % 8, run[: k % 8] + run[k % 8 + 1 :]))
        k //= 8
    return out


def manifest_by_definition(rows):
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    order = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"]))
    trees = {x: sorted([r for r in rows if r["lang"] == x], key=order) for x in langs}
    levels = {x: grown([leaf_of(r, r["text"]) for r in trees[x]]) for x in langs}
    top = grown([levels[x][-1][0] for x in langs])
    out = []
    for place, x in enumerate(langs):
        for k, r in enumerate(trees[x]):
            node = leaf_of(r, r["text"])
            path = walked(levels[x], k) + walked(top, place)
            proof = sha("".join(s for _, others in path for s in others))
            text = r["text"]
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            found = leaf_of(r, text)
            for at, others in path:
                found = sha("".join([*others[:at], found, *others[at:]]))
            out.append((r["doc_id"], node, levels[x][-1][0], top[-1][0], proof, found, found == top[-1][0]))
    return out


def as_sorted(rows):
    return sorted([tuple(r) for r in rows], key=lambda r: [(v is None, v) for v in r])


def test_manifest_by_definition(docs):
    want = manifest_by_definition(docs.collect())
    got = merkle.manifest(docs).collect()
    assert as_sorted(got) == as_sorted(want)
    assert {r["verified"] for r in got} == {True, False}


@pytest.mark.parametrize("sizes", [(1,), (8, 1), (9, 64, 65), (513, 1, 2, 3, 1, 1, 1, 7, 1)])
def test_manifest_of_trees_of_any_size(spark, sizes):
    """One lang holds most rows; single leaves, full runs and a last run of one."""
    rows = []
    for lang, size in enumerate(sizes):
        name = [None, "", "é", "z", "Z", "\U0001f642", "zz", "a", "b"][lang]
        rows += [(len(rows) * 7919 % 100_003 + k, f"Text {lang} {k}", name, f"s{k % 3}", k) for k in range(size)]
    df = table(spark, rows)
    assert as_sorted(merkle.manifest(df).collect()) == as_sorted(manifest_by_definition(df.collect()))


def test_manifest_nulls_ties_and_repeated_rows(spark):
    rows = [(None, None, None, None, None)] * 3 + [(5, t, "en", None, k) for k, t in enumerate(ODD)] + [(5, "A", "en", "s", 1)] * 9
    df = table(spark, rows + [(2**62, "B", "x", "s", None), (-3, "", "x", "", 0)])
    got = merkle.manifest(df).collect()
    assert as_sorted(got) == as_sorted(manifest_by_definition(df.collect()))
    assert merkle.manifest(df.where("doc_id = 77")).collect() == []


def test_manifest_siblings_prove_a_leaf():
    """Proof and fold of single nodes of a tree, without tables."""
    levels = grown([sha(str(k)) for k in range(70)])
    for k in (0, 7, 8, 63, 64, 69):
        path = walked(levels, k)
        args = [at for at, _ in path], ["".join(others) for _, others in path]
        assert merkle.folded(levels[0][k], *args) == levels[-1][0]
        assert merkle.folded(sha("other"), *args) != levels[-1][0]


# ------------------------------------------------------------------ token counts


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_token_counts_are_those_of_the_library(spark, docs, path):
    rows = [(k, t, "en", "s", 0) for k, t in enumerate([*ODD, *ODD])]
    both = table(spark, rows).select("doc_id", "text").union(docs.selectExpr("doc_id + 100", "text"))
    tokenizer = Tokenizer.from_file(path)
    want = []
    for r in both.collect():
        text = r["text"] or ""
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        want.append((r["doc_id"], len(text.encode()), n, n > 512))
    assert as_sorted(token_counts.count_tokens(both, path).collect()) == as_sorted(want)


def test_token_counts_of_random_characters(spark):
    """Characters of all planes, classes mixed, so that pre-tokens of every kind occur."""
    random = np.random.default_rng(5)
    pools = [range(0x20, 0x7F), range(0, 0x180), range(0x2000, 0x2100), range(0x3000, 0x3100), range(0, 0xD800), range(0x10000, 0x30000)]
    texts = ["".join(chr(random.choice(pools[random.integers(len(pools))])) for _ in range(60)) for _ in range(400)]
    tokenizer = Tokenizer.from_file(BYTES)
    want = [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    df = table(spark, [(k, t, None, None, None) for k, t in enumerate(texts)])
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(df, BYTES).collect()}
    assert [got[k] for k in range(len(texts))] == want


def test_whole_tokens_are_proven():
    tokenizer = Tokenizer.from_file(BYTES)
    proven = token_counts.whole_tokens(BYTES)
    assert 40_000 < len(proven) <= 50_257
    assert all(len(tokenizer.encode(s, add_special_tokens=False).ids) == 1 for s in proven[::97])


def test_token_counts_forget_and_take_long_texts_in_parts(spark, docs, monkeypatch):
    want = as_sorted(token_counts.count_tokens(docs, BYTES).collect())
    monkeypatch.setattr(token_counts, "REMEMBERED", 5)
    monkeypatch.setattr(token_counts, "LONG_TEXT", 100)
    assert as_sorted(token_counts.count_tokens(docs, BYTES).collect()) == want
    assert token_counts.count_tokens(docs.limit(0), BYTES).collect() == []


# ------------------------------------------------------------------ divergence


def divergence_by_definition(rows):
    words = {}
    for r in rows:
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", r["text"] or "")
        found = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in found]
        words.setdefault((r["lang"] or ""), {}).setdefault((r["source"] or ""), []).append(found)
    out = []
    for lang, sources in words.items():
        holds = Counter(w for docs in sources.values() for d in docs for w in set(d))
        kept = {w for w, n in holds.items() if n >= 3}
        counts = {s: Counter(w for d in docs for w in d if w in kept) for s, docs in sources.items()}
        whole = sum(counts.values(), Counter())

        def share(c):
            total = sum(c.values())
            return {w: 1 + 10**9 * (c[w] + 1) // (total + len(kept)) for w in kept}

        shares, q = {s: share(c) for s, c in counts.items()}, share(whole)
        for s, p in shares.items():
            pairs = [(sum((p[w] - o[w]) ** 2 // o[w] for w in kept), t) for t, o in shares.items() if t != s]
            terms = [((p[w] - q[w]) ** 2 // q[w], w) for w in kept if counts[s][w] and p[w] > q[w]]
            for part, found, upto in (("pair", pairs, None), ("term", terms, 200)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:upto]
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(ranked)]
    return out


COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


@pytest.fixture(params=["as it is", "small blocks"])
def blocks(request, monkeypatch):
    """Blocks so small that pairs lie in cells on and off the diagonal, and terms in many."""
    if request.param == "small blocks":
        for name, value in (("GROUPS", 3), ("TERMS", 20), ("HELD", 50), ("CHUNK", 64)):
            monkeypatch.setattr(divergence, name, value)


def test_divergence_by_definition(docs, blocks):
    got = divergence.divergence(docs).select(COLUMNS).collect()
    assert as_sorted(got) == as_sorted(divergence_by_definition(docs.collect()))


def test_divergence_nulls_ties_and_odd_texts(spark, blocks):
    """A lang without kept terms, a group without terms, a lang with one source, null and empty names."""
    rows = [(k, t, None if k % 2 else "", None if k % 3 else "", 1) for k, t in enumerate([*ODD, *ODD, *ODD])]
    rows += [(1, "Ab aB ab. x_y é", "de", f"s{k % 4}", 1) for k in range(9)] + [(2, "12 34", "de", "none", 1)]
    rows += [(3, f"once{k} twice", "few", f"t{k}", 1) for k in range(2)] + [(4, "a a a", "one", "s", 1)] * 5
    df = table(spark, rows)
    got = divergence.divergence(df).select(COLUMNS).collect()
    assert as_sorted(got) == as_sorted(divergence_by_definition(df.collect()))
    assert {r["value"] for r in got if r["lang"] == "few"} == {0}
    assert divergence.divergence(df.where("doc_id = 77")).collect() == []


def test_divergence_of_many_sources_with_a_hot_one(spark, blocks):
    rows = [(k, f"w{k % 7} W{k % 11} all {'hot ' * (k % 3)}", "en", "hot" if k % 3 == 0 else f"s{k % 40}", 1) for k in range(400)]
    df = table(spark, rows)
    got = divergence.divergence(df).select(COLUMNS).collect()
    assert as_sorted(got) == as_sorted(divergence_by_definition(df.collect()))


def test_shares_are_exact():
    counts = np.array([[0, 1, 10**9, 8 * 10**14]])
    total, terms = np.array([9 * 10**14]), 12345
    want = [1 + 10**9 * (int(c) + 1) // (9 * 10**14 + terms) for c in counts[0]]
    assert divergence.shares(counts, total, terms)[0].tolist() == want
