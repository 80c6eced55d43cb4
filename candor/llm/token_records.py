"""Token ids as length-delimited binary records with checksums, and a separate offset index for shuffled reads.

A record file is a run of frames in ascending `doc_id` order. A frame is

    length of the payload      unsigned 64 bit, little-endian
    masked CRC-32 of those 8 bytes     unsigned 32 bit
    payload
    masked CRC-32 of the payload       unsigned 32 bit
    one newline byte           added by Spark's text writer, which writes the frames

and a payload is one serialized sequence: a flag byte (1: the document has an id), the bytes per token id (2, or 4 for ids over 65 535),
the document id as signed 64 bit, and the ids. A checksum is masked by rotating it right by 15 bits and adding a constant, so that the checksum of
data that holds checksums stays strong. Spark's own writer puts the files in place, so a lost executor or a repeated task leaves no partial file,
and any file system that Spark knows will do.

The index is a Parquet table with a row per record: file number, byte offset and length, document id, token count, checksum of the ids and the
number of tokens before the record in its file. Sums per file (one row per file) make those counts global.

Ids are those of the library's `encode(text, add_special_tokens=False)` as it is: where a text holds the content of an added token, such as `<|endoftext|>`, that token's id stands.

Defined cases: NULL or empty text is the end id alone. NULL ids come first. Rows with the same id are ordered by a hash of their text; repeated rows
are repeated records. An empty table makes an index without rows. Other columns are not read.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candor.llm.common import Memo, kept_in_worker, small_batches, text_of

MASK_DELTA = 0xA282EAD8
HEAD, PAYLOAD_HEAD = struct.Struct("<QI"), struct.Struct("<BBq")
INDEX_SCHEMA = "part long, offset long, length long, doc_id long, n_tokens long, ids_crc32 long, start_in_part long"

#: Text is cut before spaces, and between a Latin word and the punctuation or line end after it; no pre-token reaches over such a place, so the
#: pieces can be encoded one by one. Texts with a space before other white space, with a separator of their own or with what Python and the tokenizers
#: library see differently are encoded in one go.
_WORD_END, _CUT = r"([A-Za-zÀ-ÖØ-öø-ÿ])([.,!?;:|\n])", "\x01"
_WHOLE = r"[\x01\x1c-\x1f]| [\s\x0B\x{85}\p{Z}]"
_SPACE_AND_WORD = re.compile(r" [A-Za-zÀ-ÖØ-öø-ÿ]+")
#: The same word's bytes as characters, and what would have to stand in a token that reaches into the next word.
_TWO_WORDS = re.compile(r"[A-Za-z\x80-\xbf\xc3 ]*[A-Za-z\x80-\xbf\xc3] [A-Za-z\x80-\xbf\xc3 ]*")

def _byte_characters() -> dict[int, str]:
    """The character of each byte in a byte-level vocabulary: itself where it is printable, else the next one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(256 + k) for k, b in enumerate(others)}


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def payload_at(content: bytes, offset: int) -> bytes:
    """The payload of the frame at a byte offset; raises if a checksum is wrong."""
    length, check = HEAD.unpack_from(content, offset)
    if masked(content[offset : offset + 8]) != check:
        raise ValueError(f"wrong length checksum at byte {offset}")
    start = offset + HEAD.size
    payload = content[start : start + length]
    if len(payload) != length or masked(payload) != struct.unpack_from("<I", content, start + length)[0]:
        raise ValueError(f"wrong payload checksum at byte {offset}")
    return payload


def pack(doc_id: int | None, ids: np.ndarray) -> bytes:
    width = 2 if not len(ids) or int(ids.max()) < 65536 else 4
    return PAYLOAD_HEAD.pack(doc_id is not None, width, doc_id or 0) + ids.astype(f"<u{width}").tobytes()


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    known, width, doc_id = PAYLOAD_HEAD.unpack_from(payload)
    return (doc_id if known else None), np.frombuffer(payload, f"<u{width}", offset=PAYLOAD_HEAD.size).astype("<u4")


class Encoder:
    """Ids of whole texts as the tokenizers library gives them, each distinct piece of text encoded once.

    The pieces of a batch of texts are made distinct, and only those that are new to the memory reach the library: words many at a time through the
    vocabulary's own model, the rest through the whole tokenizer.

    added_tokens: the contents of the vocabulary's added tokens in a text are these tokens, as by the library's default; otherwise they are text like any other.
    """

    def __init__(self, tokenizer_path: str, added_tokens: bool = False) -> None:
        # Tasks share the cores already.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        # Pieces hold no added token: where they count, a text with one is encoded in one go.
        self.tokenizer.encode_special_tokens = not added_tokens
        self.model, self.characters = self.tokenizer.model, _byte_characters()
        # A byte-level token has one character per byte.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.n_bytes[i] = len(token)
        # Where no token could reach from one word into the next, no merge does, and words can go through the model in one string.
        byte_of = {c: b for b, c in self.characters.items()}
        self.joins_words = not any(_TWO_WORDS.fullmatch(token.translate(str.maketrans(byte_of))) for token in vocabulary)
        self.memo = Memo(self._segments)
        contents = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added_tokens else []
        self.whole = "|".join([_WHOLE, *map(re.escape, contents)])

    def _segments(self, pieces: list[str]) -> list[bytes]:
        words = [p for p in pieces if _SPACE_AND_WORD.fullmatch(p)] if self.joins_words else []
        known = {"": b""}
        for some in ([w for w in words if w.isascii()], [w for w in words if not w.isascii()]):
            known.update(zip(some, self._encoded(self._ids_of_words, some, 200)))
        rest = [p for p in pieces if p not in known]
        known.update(zip(rest, self._encoded(self._ids_of_pieces, rest, 2000)))
        return [known[p] for p in pieces]

    def _ids_of_words(self, words: list[str]) -> list[int]:
        text = "".join(words)
        # Latin letters of one byte are their own characters.
        text = text.replace(" ", self.characters[32]) if text.isascii() else text.encode().decode("latin-1").translate(self.characters)
        return [t.id for t in self.model.tokenize(text)]

    def _ids_of_pieces(self, pieces: list[str]) -> list[int]:
        return self.tokenizer.encode_batch_fast([pieces], is_pretokenized=True, add_special_tokens=False)[0].ids

    def _encoded(self, ids_of: Callable[[list[str]], list[int]], pieces: list[str], at_once: int) -> Iterator[bytes]:
        """The ids of each piece. Many pieces are one call; the bytes that the ids stand for tell where each piece ends."""
        for k in range(0, len(pieces), at_once):
            some = pieces[k : k + at_once]
            ids = np.array(ids_of(some), "<u4")
            ends = np.searchsorted(np.cumsum(self.n_bytes[ids]), np.cumsum([len(p.encode()) for p in some])) + 1
            data, start = ids.tobytes(), 0
            for end in ends.tolist():
                yield data[4 * start : 4 * end]
                start = end

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        whole = pc.match_substring_regex(texts, self.whole)
        marked = pc.replace_substring_regex(pc.if_else(whole, "", texts), _WORD_END, rf"\1{_CUT}\2")
        pieces = pc.split_pattern(pc.replace_substring(marked, " ", _CUT + " "), _CUT)
        coded = pieces.flatten().dictionary_encode()
        known = self.memo.values(coded.dictionary.to_pylist())
        lengths = np.fromiter(map(len, known), np.int64, len(known)) // 4
        # The ids of all pieces in their order: from the place of each piece in the pool on.
        place = coded.indices.to_numpy()
        n = lengths[place]
        ends = np.cumsum(n)
        ids = np.frombuffer(b"".join(known), "<u4")[np.arange(n.sum()) + np.repeat((np.cumsum(lengths) - lengths)[place] - ends + n, n)]
        # Each text has one piece at least.
        last = pieces.offsets.to_numpy()[1:] - pieces.offsets[0].as_py() - 1
        out = np.split(ids, ends[last[:-1]]) if len(texts) else []
        for i in np.flatnonzero(whole.to_numpy(False)):
            out[i] = np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, "<u4")
        return out


def write_records(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0, partitions: int | None = None) -> None:
    """Writes `doc_id`, `text` rows as record files below `folder`/records, in ascending doc_id order over all files.

    partitions: number of files; by default two for each input partition. One range shuffle of the texts orders them; a hash of the text is part of
    the range, so that an id that many rows share is spread.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"))
    parts = partitions or 2 * max(1, rows.rdd.getNumPartitions())
    order = [F.col("doc_id"), F.xxhash64("text")]

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One per worker, so that later tasks find the pieces of earlier ones.
        encoder, end = kept_in_worker(tokenizer_path, lambda: Encoder(tokenizer_path, added_tokens=True)), np.array([end_id], "<u4")
        for batch in small_batches(batches, "text", 4 << 20, tokenizer_path):
            ids = encoder.ids(batch.column("text"))
            out = [frame(pack(i, np.concatenate((x, end)))) for i, x in zip(batch.column("doc_id").to_pylist(), ids)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ordered.mapInArrow(frames, "frame binary").select(F.col("frame").cast("string")).write.option("lineSep", "\n").text(f"{folder}/records")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/records")
    return files.select(F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("long").alias("part"), "content")


def _frames(part: int, content: bytes) -> Iterator[tuple[int, int, bytes]]:
    offset = 0
    while offset < len(content):
        payload = payload_at(content, offset)
        length = HEAD.size + len(payload) + 4
        yield offset, length, payload
        offset += length + 1


def write_index(spark: SparkSession, folder: str) -> DataFrame:
    """Reads all record files back, checks every checksum, writes the offset index to `folder`/index and returns it with global starts."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c.split()[0], pa.int64()) for c in INDEX_SCHEMA.split(", ")])
        for batch in batches:
            for part, content in zip(batch.column("part").to_pylist(), batch.column("content")):
                rows, start = [], 0
                for offset, length, payload in _frames(part, content.as_py()):
                    doc_id, ids = unpack(payload)
                    rows.append((part, offset, length, doc_id, len(ids), zlib.crc32(ids.tobytes()), start))
                    start += len(ids)
                columns = list(zip(*rows)) or [[]] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    _files(spark, folder).mapInArrow(entries, INDEX_SCHEMA).write.parquet(f"{folder}/index")
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The offset index with `start`, the number of tokens before a record in the whole corpus. The running sum is over files, not records."""
    index = spark.read.schema(INDEX_SCHEMA).parquet(f"{folder}/index")
    files = index.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = files.select("part", (F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")).alias("before"))
    return index.join(before, "part").withColumn("start", F.col("before") + F.col("start_in_part")).drop("before")


def fetch_records(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """Shuffled reads: `wanted` has index rows (`part`, `offset`, `length`) and any other columns; returns them with `ids`.

    Only the wanted byte ranges go from the files to Python. The ranges of a file meet its bytes in one row, so a file is the unit of memory.
    """
    ranges = wanted.groupBy("part").agg(F.collect_list(F.struct(*[F.col(c) for c in wanted.columns if c != "part"])).alias("ranges"))
    cut = (
        _files(spark, folder)
        .join(ranges, "part")
        .select("part", "content", F.explode("ranges").alias("range"))
        .select("part", "range.*", F.expr("substring(content, cast(range.offset + 1 as int), cast(range.length as int))").alias("frame"))
    )

    @F.pandas_udf("array<int>")
    def ids_of(frames):
        return frames.map(lambda f: unpack(payload_at(f, 0))[1].astype("int32"))

    return cut.withColumn("ids", ids_of("frame")).drop("frame")
