"""Token counts of whole texts, without making the tokens of what is one token as it stands.

Before any text is read, every string of the vocabulary is encoded alone; those that come back as one
token are proven, and a pre-token among them counts one. Only other pre-tokens are merged, each once as
long as it is remembered.

Pre-tokens are cut by the published pattern of the vocabulary. The library's cut differs from it where
the two disagree on the class of a character, so every character of the first two planes is tried in
both. A text with any other character, or with a special string, is given to the library whole.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Merged pre-tokens that a task remembers, and the length beyond which none is.
REMEMBERED, LONGEST = 500_000, 64
#: Characters of a text beyond which its pre-tokens are not listed at once.
LONG_TEXT = 1 << 20
#: Characters that are tried: the first two planes.
TRIED = 0x20000

# Fixed value: the published pattern of this kind of vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _by_pattern(path: str) -> bool:
    """Whether a file cuts by PATTERN and nothing else touches the text."""
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    cut = made.get("pre_tokenizer") or {}
    return (
        made.get("normalizer") is None
        and made["model"]["type"] == "BPE"
        and not made.get("truncation")
        and not made.get("padding")
        and cut.get("type") == "ByteLevel"
        and cut.get("use_regex", True)
        and not cut.get("add_prefix_space", True)
    )


def _lengths(tokenizer, texts: list[str]) -> list[int]:
    return [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def whole_tokens(path: str) -> list[str]:
    """Strings of the vocabulary that encode alone as the one token they are.

    A token that is part of a character has no string and can't be a pre-token.
    """
    tokenizer = _load(path)
    strings = [tokenizer.decode([k], skip_special_tokens=False) for k in range(tokenizer.get_vocab_size())]
    found = tokenizer.encode_batch_fast(strings, add_special_tokens=False)
    return [s for k, (s, e) in enumerate(zip(strings, found)) if s and e.ids == [k]]


def unproven_characters(path: str) -> list[tuple[int, int]]:
    """Ranges of characters that the library may cut otherwise than PATTERN.

    Each character is put between letters, digits, marks and blanks, in both ways of cutting.
    """
    import regex

    tokenizer, pattern = _load(path), regex.compile(PATTERN)
    around = "a{0}b {0}1{0} .{0}{0}! {0}  {0}\n{0} c"
    odd = []
    for block in range(0, TRIED, 256):
        texts = {k: around.format(chr(k)) for k in range(block, block + 256) if not 0xD800 <= k < 0xE000}
        for k, text in texts.items():
            own = [m.span() for m in pattern.finditer(text)]
            if own != [span for _, span in tokenizer.pre_tokenizer.pre_tokenize_str(text)]:
                odd.append(k)
    ranges: list[tuple[int, int]] = []
    for k in [*odd, *range(0xD800, 0xE000)]:
        ranges.append((k, k))
    ranges.append((TRIED, 0x10FFFF))
    return _joined(sorted(ranges))


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in ranges:
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


class _Lengths(dict):
    """Tokens of a pre-token; the first use of one that isn't proven merges it."""

    def __init__(self, tokenizer, proven: list[str]) -> None:
        super().__init__(dict.fromkeys(proven, 1))
        self.tokenizer, self.proven = tokenizer, proven

    def __missing__(self, piece: str) -> int:
        n = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= LONGEST:
            if len(self) >= len(self.proven) + REMEMBERED:
                self.clear()
                self.update(dict.fromkeys(self.proven, 1))
            self[piece] = n
        return n


def count_tokens(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row of ``docs(doc_id, text)``.

    As many tokens as the library gives for the whole text without added special tokens; special
    strings in a text are the one token that they are by default. A null text is an empty one: no
    bytes, no tokens, not over the limit. Rows with the same doc_id stay rows of their own; other
    columns are ignored; an empty table has no rows. A file of another kind is counted by the library.
    """
    special = [t.content for t in _load(path).get_added_tokens_decoder().values()]
    known = whole_tokens(path) if _by_pattern(path) else None
    odd = unproven_characters(path) if known else []
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        import regex

        tokenizer = _load(path)
        lengths = _Lengths(tokenizer, known or [])
        pieces = regex.compile(PATTERN)
        ranges = "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in odd)
        strange = re.compile("|".join([*map(re.escape, special), *([f"[{ranges}]"] if ranges else [])]) or r"(?!)")

        def count(text: str) -> int:
            if known is None or strange.search(text):
                return _lengths(tokenizer, [text])[0]
            if len(text) > LONG_TEXT:
                return sum(lengths[m.group()] for m in pieces.finditer(text))
            return sum(map(lengths.__getitem__, pieces.findall(text)))

        for batch in batches:
            texts = batch.column(1).fill_null("")
            sizes = pc.binary_length(texts).cast(pa.int64())
            n = np.fromiter((count(t.as_py()) for t in texts), dtype=np.int64, count=len(texts))
            columns = [batch.column(0), sizes, pa.array(n), pa.array(n > limit)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
