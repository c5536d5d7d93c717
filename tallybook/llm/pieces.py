"""Encoding into the pieces of a SentencePiece model, and decoding.

An Aho-Corasick automaton over all pieces reports, at each end position, every piece that ends
there, the longest first and its suffixes by output links. One pass relaxes the best score of each
position with them; walking back gives the segmentation with the highest sum of scores. A character
that is no piece falls back to its bytes.

Blanks become U+2581 and one is put in front. Pieces hold it only at their beginning, or hold
nothing else, so a text is segmented run by run: blanks with what follows them up to the next
blank. Distinct runs of a task are segmented once.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLANK = "▁"
#: Stands for a BLANK of the text itself, which is encoded by its bytes; no valid text holds it.
LITERAL = "\udc81"
#: Distinct runs remembered by a task.
REMEMBERED = 400_000
_RUNS = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")


class Pieces:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.automaton = ahocorasick.Automaton()
        self.bytes_of: list[bytes] = []
        self.byte_ids = [0] * 256
        self.is_byte = np.zeros(model.get_piece_size(), dtype=bool)
        least = 0.0
        for k in range(model.get_piece_size()):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                self.byte_ids[int(piece[3:5], 16)] = k
                self.is_byte[k] = True
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
                continue
            self.bytes_of.append(piece.replace(BLANK, " ").encode())
            if not (model.is_control(k) or model.is_unknown(k) or model.is_unused(k)):
                if BLANK in piece.lstrip(BLANK):
                    raise ValueError(f"piece {piece!r} holds a blank after other characters")
                least = min(least, model.get_score(k))
                self.automaton.add_word(piece, (k, len(piece), model.get_score(k)))
        self.automaton.make_automaton()
        self.fallback = least - 10.0
        self.known: dict[str, bytes] = {}

    def segment(self, run: str) -> list[int]:
        """Ids of the best segmentation of one run."""
        n = len(run)
        best: list[float | None] = [0.0] + [None] * n
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        single = [False] * n
        settled = 0  # characters before this one have met all pieces that end there

        def settle(upto: int) -> None:
            nonlocal settled
            while settled < upto:
                if not single[settled]:
                    score = best[settled] + self.fallback
                    if best[settled + 1] is None or score > best[settled + 1]:
                        best[settled + 1], back[settled + 1] = score, (settled, -1)
                settled += 1

        for end, (k, size, score) in self.automaton.iter(run):
            settle(end)
            start = end + 1 - size
            single[end] |= size == 1
            score += best[start]
            if best[end + 1] is None or score > best[end + 1]:
                best[end + 1], back[end + 1] = score, (start, k)
        settle(n)
        ids: list[int] = []
        while n:
            start, k = back[n]
            if k >= 0:
                ids.append(k)
            else:
                raw = (BLANK if run[start] == LITERAL else run[start]).encode()
                ids += [self.byte_ids[b] for b in reversed(raw)]
            n = start
        return ids[::-1]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text; none for an empty one."""
        if not text:
            return np.zeros(0, dtype=np.uint32)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        runs = _RUNS.findall(BLANK + text.replace(BLANK, LITERAL).replace(" ", BLANK))
        known = self.known
        for run in [r for r in set(runs) if r not in known]:
            known[run] = np.array(self.segment(run), dtype="<u4").tobytes()
        return np.frombuffer(b"".join([known[run] for run in runs]), dtype="<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: one blank in front goes, bytes that are no UTF-8 become U+FFFD."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        return raw.removeprefix(b" ").decode(errors="replace")


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` for each row of ``docs(doc_id, text)``; a null text has no ids.

    Equal scores are settled for the longer last piece. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(path)
        for batch in batches:
            ids = [pieces.encode(t or "").astype(np.int32) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` for each row of ``encoded(doc_id, ids)``; null ids are an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(path)
        for batch in batches:
            texts = [pieces.decode(np.array(ids or [], dtype=np.int64)) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, n_byte_tokens, ids_crc32, text_crc32, same`` for each row of docs.

    Encodes each text and decodes the ids again; ``same`` says that this gave the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(path)
        for batch in batches:
            out: list[tuple] = []
            for text in batch.column(1).to_pylist():
                ids = pieces.encode(text or "")
                back = pieces.decode(ids)
                sums = zlib.crc32(ids.tobytes()), zlib.crc32(back.encode())
                out.append((len(ids), int(pieces.is_byte[ids].sum()), *sums, back == (text or "")))
            kinds = [pa.int64()] * 4 + [pa.bool_()]
            columns = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    names = ["doc_id", "n_tokens", "n_byte_tokens", "ids_crc32", "text_crc32", "same"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, n_byte_tokens long, ids_crc32 long, text_crc32 long, same boolean"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
