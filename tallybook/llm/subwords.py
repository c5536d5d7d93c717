"""Token ids of whole texts by a public tokenizer, computed once for each distinct word of a task."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A word without white space or control characters of its own, maybe after one blank.
_PLAIN = r"^ ?[^\s\v\x01\x1c-\x1f\x85\p{Z}]+$"
#: Characters of text encoded together, and distinct words that a worker remembers; beyond them it
#: forgets those that it met once. Texts that can't be cut count as words, so their bytes are bounded too.
PART = 6_000_000
REMEMBERED = 600_000
REMEMBERED_BYTES = 64_000_000
#: Words that are given to the library as one text.
TOGETHER = 100


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of a file; it keeps what it knows for the worker's next task."""
    import tokenizers

    # functions travel by value, so what a worker keeps can't be a global of this module
    kept = vars(tokenizers).setdefault("_word_encoders", {})
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]


class WordEncoder:
    """Same ids as ``encode(text, add_special_tokens=False)`` of the ``tokenizers`` library.

    No token of the two vocabularies spans the end of a letter run before common punctuation, a
    line break between other characters, or a space after a character other than white space.
    Texts are cut at such places and every distinct piece is encoded once; a text that holds the
    mark of a cut, a space after white space, or the string of a special token is one piece, so the
    library's own rules decide what a special string becomes.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.uncut = "|".join([r"\x1f|[\s\v\x1c-\x1e\x85\p{Z}] ", *map(re.escape, special)])
        self.special = "|".join(map(re.escape, special)) or None
        self.largest = max(self.tokenizer.get_vocab().values(), default=0)
        # between words stands what is always one token: a line break, or where white space is
        # dropped a control character
        self.between = next(x for x in ("\n", " \x01 ") if len(self._ids([f"a{x}b"])[0]) == 3)
        self.mark = self._ids([f"a{self.between}b"])[0][1]
        # where case is dropped anyway, words that differ in it alone are one
        upper = [f"{a}{chr(k)} {chr(k)}{a}" for k in range(65, 91) for a in "ax1"]
        self.lower = self._ids(upper) == self._ids([t.lower() for t in upper])
        self.forget()

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def forget(self) -> None:
        self.words = pa.array([], pa.string())
        self.pool = np.zeros(0, dtype=np.uint32)
        self.starts = np.zeros(0, dtype=np.int32)
        self.lengths = np.zeros(0, dtype=np.int32)
        self.met = np.zeros(0, dtype=np.int64)

    def trim(self) -> None:
        """Forget the words that were met once; all of them if most were met again."""
        keep = self.met > 1
        words = self.words.filter(pa.array(keep))
        if 2 * len(words) > REMEMBERED or 2 * words.nbytes > REMEMBERED_BYTES:
            self.forget()
            return
        self.words = words
        self.pool = _gather(self.pool, self.starts[keep], self.lengths[keep])
        self.lengths = self.lengths[keep]
        self.starts = (np.cumsum(self.lengths) - self.lengths).astype(np.int32)
        self.met = np.ones(len(words), dtype=np.int64)

    def _flat(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after the other, and how many each has."""
        plain = pc.match_substring_regex(words, _PLAIN)
        if self.special:
            plain = pc.and_not(plain, pc.match_substring_regex(words, self.special))
        simple = words.filter(plain)
        edges = pa.array(np.append(np.arange(0, len(simple), TOGETHER), len(simple)), pa.int32())
        joined = pc.binary_join(pa.ListArray.from_arrays(edges, simple), self.between).to_pylist()
        joined = self._ids([text + self.between for text in joined])
        ids = np.concatenate([np.zeros(0, np.uint32), *(np.array(x, dtype=np.uint32) for x in joined)])
        ends = np.flatnonzero(ids == self.mark)
        if len(ends) != len(simple):  # a mark was merged with a neighbour: each word on its own
            parts = [np.array(x, dtype=np.uint32) for x in self._ids(words.to_pylist())]
            lengths = np.array([len(x) for x in parts], dtype=np.int32)
            return np.concatenate([np.zeros(0, np.uint32), *parts]), lengths
        begins = np.concatenate((np.zeros(1, ends.dtype), ends + 1))[:-1]
        rest = [np.array(x, dtype=np.uint32) for x in self._ids(words.filter(pc.invert(plain)).to_pylist())]
        order = np.argsort(~np.asarray(plain), kind="stable")  # the simple ones, then the rest
        lengths = np.zeros(len(words), dtype=np.int32)
        lengths[order] = np.concatenate((ends - begins, [len(x) for x in rest])).astype(np.int32)
        starts = np.zeros(len(words), dtype=np.int64)
        sizes = np.cumsum([0, *(len(x) for x in rest)])[:-1]
        starts[order] = np.concatenate((begins, len(ids) + sizes))
        return _gather(np.concatenate([ids, *rest]), starts, lengths), lengths

    def learn(self, words: pa.Array) -> np.ndarray:
        """Slot of each word; the new ones are encoded."""
        # what is known comes first, so a word's place in the dictionary is its slot
        both = pa.chunked_array([self.words.cast(words.type), words]).dictionary_encode()
        found = both.chunk(both.num_chunks - 1)
        new = found.dictionary[len(self.words) :]
        if len(new):
            flat, lengths = self._flat(new)
            starts = len(self.pool) + np.cumsum(lengths) - lengths
            self.starts = np.concatenate((self.starts, starts.astype(np.int32)))
            self.lengths = np.concatenate((self.lengths, lengths))
            self.pool = np.concatenate((self.pool, flat))
            self.words = found.dictionary
        return np.asarray(found.indices)

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, in order; a null text is empty."""
        texts = texts.fill_null("")
        sizes = np.asarray(pc.binary_length(texts)).astype(np.int64)
        at = 0
        while at < len(texts):
            upto = at + 1 + int(np.searchsorted(np.cumsum(sizes[at + 1 :]) + sizes[at], PART, side="right"))
            yield from self._part(texts.slice(at, upto - at))
            at = upto

    def _part(self, texts: pa.Array) -> list[np.ndarray]:
        if len(self.words) > REMEMBERED or self.words.nbytes > REMEMBERED_BYTES:
            self.trim()
        plain = pc.ascii_lower(texts) if self.lower else texts
        whole = pc.match_substring_regex(plain, self.uncut)
        if self.lower:  # a mark may compose with a small letter and not with its capital
            whole = pc.or_(whole, pc.match_substring_regex(texts, r"[A-Z]\p{M}"))
        cut = pc.replace_substring(pc.if_else(whole, "", plain), " ", "\x1f ")
        cut = pc.replace_substring_regex(cut, r"(\p{L})([.,;:!?])", "\\1\x1f\\2")
        cut = pc.replace_substring_regex(cut, r"([.!?])\n(\p{L})", "\\1\x1f\n\x1f\\2")
        cut = pc.split_pattern(cut, "\x1f")
        bounds = np.asarray(cut.offsets).astype(np.int64)
        bounds -= bounds[0]
        pieces, rows = cut.flatten(), np.flatnonzero(np.asarray(whole))
        if len(rows):
            uncut = np.zeros(len(pieces), dtype=bool)
            uncut[bounds[rows]] = True
            pieces = pc.replace_with_mask(pieces, pa.array(uncut), texts.filter(whole))
        slots = self.learn(pieces)
        self.met = np.bincount(slots, minlength=len(self.starts)) + np.pad(self.met, (0, len(self.starts) - len(self.met)))
        lengths = self.lengths[slots]
        ids = _gather(self.pool, self.starts[slots], lengths)
        at = np.concatenate((np.zeros(1, np.int64), np.cumsum(lengths, dtype=np.int64)))[bounds]
        return [ids[a:b] for a, b in zip(at[:-1], at[1:])]


def _gather(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``pool`` that begin at ``starts``, one after the other."""
    ends = np.cumsum(lengths, dtype=starts.dtype)
    where = np.repeat(starts - (ends - lengths), lengths)
    where += np.arange(len(where), dtype=where.dtype)
    return pool[where]
