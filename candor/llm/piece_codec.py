"""SentencePiece encoding by a prefix table, and decoding.

For each prefix of a text the encoding of that prefix ends in one certain piece. The table stores this last piece per prefix: an automaton over the
vocabulary lists the pieces that end at a place, and of these exactly one fits, the one that forms a stable pair with the last piece of the prefix
before it. A pair is stable if merging its joined text from characters gives the pair back. Each test depends on two pieces only, so their answers are
kept. The ids are then read backwards from the last prefix: linear work, no queue of merges.

Where no piece of the vocabulary holds a space mark behind another character, merging never crosses the start of a run of spaces; the text is cut there and
each distinct part is encoded once per task.

Defined cases: NULL and empty texts have the end id alone and decode to the empty string. Characters outside the vocabulary become their UTF-8 bytes.
Rows are independent, so repeated rows and repeated ids give repeated results; columns other than `doc_id` and `text` are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candor.llm.common import Memo, kept_in_worker, small_batches, text_of

MARK = "▁"
SCHEMA = "doc_id long, ids array<int>, decoded string"
#: Codes of what can end a prefix: code points up to here are characters, then come pieces; START is before the first character.
PIECE, START = 1 << 21, 1 << 23
#: Answers of pair tests that a worker remembers.
STABLE = 600_000
_LETTERS, _MARKS = "[A-Za-zÀ-ÖØ-öø-ÿ]+", ".,!?;:|"
_WORD_END = re.compile(rf"[A-Za-zÀ-ÖØ-öø-ÿ][{_MARKS}]")


class PrefixTable:
    """Encodes texts with the vocabulary and the scores of a SentencePiece model of the merge type."""

    def __init__(self, model_path: str) -> None:
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=model_path)
        size = self.library.get_piece_size()
        special = (self.library.is_byte, self.library.is_control, self.library.is_unknown)
        self.id = {self.library.id_to_piece(i): i for i in range(size) if not any(test(i) for test in special)}
        self.score = {p: self.library.get_score(i) for p, i in self.id.items()}
        self.bytes = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.end_id = self.library.eos_id()
        self.text = {i: p for p, i in self.id.items()}
        self.matches = ahocorasick.Automaton()
        for piece, i in self.id.items():
            self.matches.add_word(piece, (len(piece), i))
        self.matches.make_automaton()
        # By the code of the last piece of a prefix, shifted, and the id of the next one.
        self.stable: dict[int, bool] = {}
        part = r" *[^ \n]+| +|\n" if not any("\n" in p for p in self.id) else " *[^ ]+| +"
        cut = not any(MARK in p.lstrip(MARK) for p in self.id)
        # Nor does merging go from a Latin word to the mark after it where no piece holds both.
        if not any(_WORD_END.search(p) for p in self.id):
            part = rf" *{_LETTERS}(?=[{_MARKS}])|{part}"
        self.parts = re.compile(part if cut else r"(?s).+")
        self.memo = Memo(lambda parts: [np.array(self._part(p), "<i4").tobytes() for p in parts], limit=150_000)

    def _merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging, best score first and leftmost first among equals: what stability is defined by."""
        symbols = list(text)
        while len(symbols) > 1:
            pairs = [(-self.score[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in self.score]
            if not pairs:
                break
            _, i = min(pairs)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        return symbols

    def _fits(self, before: int, piece: int) -> bool:
        """Whether a piece can follow the last piece of a prefix, found by merging both texts."""
        if len(self.stable) > STABLE:
            # A bounded memory; an answer that is gone is found again.
            self.stable.clear()
        head, tail = ("" if before == START else self._text_of(before)), self.text[piece]
        known = self.stable[before << 24 | piece] = self._merged(head + tail) == ([head, tail] if head else [tail])
        return known

    def _text_of(self, code: int) -> str:
        return self.text[code - PIECE] if code >= PIECE else chr(code)

    def _codes(self, text: str) -> list[int]:
        """The pieces of an escaped text: PIECE + id, or the code point of a character that stands alone."""
        last = [-1] * (len(text) + 1)
        last[0], done, stable = START, 1, self.stable
        for end, (size, piece) in self.matches.iter(text):
            at = end + 1
            while done < at:
                # No piece of the vocabulary ends here in the encoding: the character stands alone.
                if last[done] < 0:
                    last[done] = ord(text[done - 1])
                done += 1
            if last[at] < 0:
                before = last[at - size]
                fits = stable.get(before << 24 | piece)
                if self._fits(before, piece) if fits is None else fits:
                    last[at] = PIECE + piece
        for at in range(done, len(text) + 1):
            if last[at] < 0:
                last[at] = ord(text[at - 1])
        found, at = [], len(text)
        while at:
            found.append(code := last[at])
            at -= len(self.text[code - PIECE]) if code >= PIECE else 1
        return found[::-1]

    def pieces(self, text: str) -> list[str]:
        """The pieces of an escaped text."""
        return [self._text_of(code) for code in self._codes(text)]

    def _part(self, part: str) -> list[int]:
        ids: list[int] = []
        for code in self._codes(part.replace(" ", MARK)):
            if code >= PIECE:
                ids.append(code - PIECE)
            else:
                ids.extend([self.bytes[b] for b in chr(code).encode()])
        return ids

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text with the end id."""
        parts = [self.parts.findall(" " + t.replace(MARK, " ")) if t else [] for t in texts]
        return [np.frombuffer(ids, "<i4").tolist() + [self.end_id] for ids in self.memo.joined(parts)]

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """`doc_id`, `ids` with the end id, and `decoded`, the text that the ids decode to. One pass without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One per worker, so that later tasks find what earlier ones have stored.
        codec = kept_in_worker(model_path, lambda: PrefixTable(model_path))
        for batch in small_batches(batches, "text", 1 << 20, model_path):
            ids = codec.encode(batch.column("text").to_pylist())
            decoded = pa.array([codec.decode(i) for i in ids], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), decoded], ["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text")).mapInArrow(run, SCHEMA)
