"""Secret scan with corpus-wide ownership.

Every text is searched for three base kinds (assignments to password-like names, access key ids,
long hexadecimal runs) and for bare tokens that look random. Values are hashed, and for each hash
the corpus is asked in how many repositories and by how many owners it occurs. A value that many
owners hold is a copied example; one that few hold is live. Base spans are always reported, bare
tokens only where they are live.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lookup, stage
from .spans import replace_texts

KINDS = ("assign", "access", "hex", "token")
#: From so many owners on, a value is an example that is copied about.
EXAMPLE_OWNERS = 3
#: Bits a character of a bare token must carry, and its least length.
TOKEN_BITS, TOKEN_LENGTH = 3.5, 24

# Fixed patterns of the three base kinds.
ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
# Anything an assignment's name can hold, in either case: texts without it aren't searched for one.
NAME = re.compile(r"(?ai:passw|secret|token|key)")
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % TOKEN_LENGTH)


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """``(start, kind, end, value)`` of the base kinds, by start, then kind."""
    found = []
    if NAME.search(text):
        found += [(m.start(), 0, m.end(), m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


def looks_random(token: str) -> bool:
    """Digits, small and capital letters mixed, and as many bits a character as random text has."""
    if not (re.search("[0-9]", token) and re.search("[a-z]", token) and re.search("[A-Z]", token)):
        return False
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values()) >= TOKEN_BITS


def bare_tokens(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Random-looking tokens that touch no base span."""
    found = []
    for m in TOKEN.finditer(text):
        if looks_random(m[0]) and all(m.end() <= s[0] or m.start() >= s[2] for s in base):
            found.append((m.start(), 3, m.end(), m[0]))
    return found


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[s[1]]}:{s[0]}:{s[2]}" for s in spans)


SPAN = "struct<start:int, kind:int, stop:int, value:string>"


def _scan(docs: DataFrame, repository: str, owner: str) -> DataFrame:
    """One row for each row of docs: base counts and digest, and all candidate spans."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32()), ("value", pa.string())]))
        for batch in batches:
            counts, digests, spans = ([], [], []), [], []
            for text in batch.column(4).to_pylist():
                base = base_spans(text or "")
                for k in range(3):
                    counts[k].append(sum(s[1] == k for s in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                both = sorted(base + bare_tokens(text or "", base))
                values = [hashlib.blake2b(s[3].encode(), digest_size=16).hexdigest() for s in both]
                spans.append([dict(zip(("start", "kind", "stop", "value"), (*s[:3], v))) for s, v in zip(both, values)])
            columns = [*batch.columns[:4], *(pa.array(x, pa.int64()) for x in counts), pa.array(digests, pa.string()), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "key", "repository", "owner", "n_assign", "n_access", "n_hex", "base_sha256", "found"]
    schema = f"doc_id {kind}, key long, repository string, owner string, n_assign long, n_access long, "
    schema += f"n_hex long, base_sha256 string, found array<{SPAN}>"
    columns = ["doc_id", F.xxhash64("doc_id", "text").alias("key")]
    columns += [F.col(repository).cast("string").alias("repository"), F.col(owner).cast("string").alias("owner")]
    return docs.select(*columns, "text").mapInArrow(scan, schema)


def ownership(found: DataFrame) -> DataFrame:
    """``value, n_repositories, n_owners`` over all ``found(value, repository, owner)``.

    Distinct pairs are made first, so a value that a third of all rows hold is no single group.
    A null owner or repository counts as one of its own.
    """
    pairs = found.select("value", F.coalesce("repository", F.lit("")).alias("r"), F.coalesce("owner", F.lit("")).alias("o"))
    repositories = pairs.select("value", "r").distinct().groupBy("value").agg(F.count("*").alias("n_repositories"))
    owners = pairs.select("value", "o").distinct().groupBy("value").agg(F.count("*").alias("n_owners"))
    return repositories.join(owners, "value")


def scan(docs: DataFrame, repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """Secrets of ``docs(doc_id, text)`` and the columns that name a repository and an owner.

    One row for each row of docs: ``doc_id, key, n_assign, n_access, n_hex, base_sha256, spans,
    n_live, n_examples, live``. ``key`` is a hash of doc_id and text, ``live`` lists start and end
    of live spans. A null or empty text has no spans; equal starts are ordered by kind; repeated
    rows give equal rows; other columns are ignored.
    """
    scanned = _scan(docs, repository, owner).withColumn("row", F.monotonically_increasing_id())
    scanned = stage(scanned, "secrets")  # from here on a row keeps its number
    found = scanned.select("row", "repository", "owner", F.explode("found").alias("s"))
    found = found.select("row", "repository", "owner", "s.*")
    judged = lookup(found.drop("repository", "owner"), ownership(found), ["value"], "inner")
    example = F.col("n_owners") >= EXAMPLE_OWNERS
    judged = judged.where(~((F.col("kind") == KINDS.index("token")) & example))
    names = F.array(*map(F.lit, KINDS))
    text = F.concat_ws(":", F.get(names, F.col("kind")), F.col("start"), F.col("stop"))
    item = F.struct("start", "kind", "stop", text.alias("text"), (~example).alias("live"))
    rows = judged.groupBy("row").agg(F.sort_array(F.collect_list(item)).alias("items"))
    both = scanned.drop("found", "repository", "owner").join(rows, "row", "left")
    items = F.coalesce("items", F.array().cast("array<struct<start:int,kind:int,stop:int,text:string,live:boolean>>"))
    live = F.filter(items, lambda x: x["live"])
    return both.select(
        "doc_id", "key", "n_assign", "n_access", "n_hex", "base_sha256",
        F.array_join(F.transform(items, lambda x: x["text"]), ",").alias("spans"),
        F.size(live).cast("long").alias("n_live"),
        (F.size(items) - F.size(live)).cast("long").alias("n_examples"),
        F.transform(live, lambda x: F.struct(x["start"], x["stop"])).alias("live"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every live secret replaced by ``mark``; examples, rows and columns stay.

    Overlapping live spans become one mark; ``n_chars``, if there, follows the new text.
    """
    live = scan(docs).where("n_live > 0").select("key", "live").dropDuplicates(["key"])
    texts = docs.select(F.xxhash64("doc_id", "text").alias("key"), "text")
    hit = texts.join(live, "key").dropDuplicates(["key"]).select("key", "text", "live")

    def hide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                parts, at = [], 0
                for span in spans:
                    start, stop = span["start"], span["stop"]
                    if start >= at:
                        parts += [text[at:start], mark]
                    at = max(at, stop)
                out.append("".join(parts) + text[at:])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["key", "text"])

    return replace_texts(docs, hit.mapInArrow(hide, "key long, text string"))
