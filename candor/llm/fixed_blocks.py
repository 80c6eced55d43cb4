"""Removes repeated passages, found with fixed-block anchors.

A passage repeats if a window of WINDOW words occurs at two places, in one document or in two. Every window that long holds a block of BLOCK words that
starts at a multiple of BLOCK, since 2 * BLOCK - 1 <= WINDOW.

1. Documents are packed into chunks of a few megabytes of text, each one row, and the chunks are checkpointed, so that each later step sees the same ones.
2. Index and probe. Each chunk sends the hashes of all its rolling BLOCK-word windows, each distinct one once, with two marks: it is also a reference block
   here, and it occurs more than once here. The hashes go sorted and delta-coded to the task of their range. That task finds the hashes that are a reference
   block somewhere and occur at two places or more, and answers every chunk with one bit per hash sent. A hit extends to both sides: each WINDOW-word
   window with a hit inside may be part of a repeat.
3. Extension. For these windows 96-bit hashes of all WINDOW words are sent in the same way, and the answer says which of them occur elsewhere. The union of
   such windows is the union of all maximal exact repeats of at least WINDOW words. Windows that occur twice in one chunk need no answer.
4. The words of these windows are removed.

A hash is sent once by a chunk however often it occurs there, so the group of a very common passage has at most one entry per chunk: no pairs, no group
that holds all its places. The ranges of the second hash spread evenly as well. Shuffled are hashes (about 3 bytes a word) and the chunks, compressed.

Exactness: step 2 can only let too much through; step 3 decides by 96 bits of a hash of all words, with the odds of one false match in 10^13 windows at about
10^-3. Nothing is sampled or capped.

Defined cases: NULL and empty texts have no words and no rows are lost: one row comes out per row, also for repeated rows and ids. Rows that repeat remove each
other's words if they have WINDOW words or more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candor.llm.common import small_batches, text_of
from candor.session import scratch_root

WINDOW = 35
BLOCK = 18
CHUNK_BYTES = 6 << 20
#: About this many hashes are compared in one call. A chunk sends one row per range, so for far larger corpora both sizes should grow.
RANGE_HASHES = 1 << 21
#: Bytes hashed at a time.
SLICE = 1 << 20
#: Bits by which the hashes of step 2 are longer than needed to tell that many windows apart.
SPARE_BITS = 10
CHUNK_SCHEMA = "ids array<long>, lengths array<int>, data binary, n_bytes long"
SENT_SCHEMA = "range long, chunk long, keys binary"
ANSWER_SCHEMA = "chunk long, range long, bits binary"
OUT_SCHEMA = "doc_id long, n_words long, n_removed long, kept string"

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers."""
    x = x + np.uint64(seed)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(0, n - 1), base, np.uint64)]))[:n]


#: Fixed odd multipliers and their inverses modulo 2^64.
_BASES = tuple((b, pow(b, -1, 1 << 64)) for b in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


class Words:
    """The words of a chunk: where they are, to which document they belong, and hashes of runs of them."""

    def __init__(self, data: bytes, lengths: list[int]) -> None:
        self.data = np.frombuffer(data, np.uint8)
        ends = np.cumsum(np.array(lengths, np.int64) + 1)
        # Documents are joined by one newline each, so no word reaches over.
        space = _SPACE[self.data]
        edges = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
        self.first, self.last = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
        self.doc = np.searchsorted(ends, self.first, side="right")
        self.count = np.bincount(self.doc, minlength=len(lengths))
        self.start = np.cumsum(self.count) - self.count
        self.place = np.arange(len(self.first)) - self.start[self.doc]
        self._word: dict[int, np.ndarray] = {}

    def _hashes(self, k: int) -> np.ndarray:
        """One hash per word, from a polynomial over scrambled bytes."""
        if k in self._word:
            return self._word[k]
        base, inverse = _BASES[k]
        out = np.empty(len(self.first), np.uint64)
        with np.errstate(over="ignore"):
            table = _mix(np.arange(256, dtype=np.uint64) * _ODD, 1 + k)
            cuts = np.unique(np.searchsorted(self.first, np.arange(0, len(self.data), SLICE)))
            longest = max((int(self.last[j - 1] - self.first[i]) for i, j in zip(cuts, np.append(cuts[1:], len(self.first))) if j > i), default=0)
            power, back = _powers(base, longest), _powers(inverse, longest + 1)
            for i, j in zip(cuts, np.append(cuts[1:], len(self.first))):
                if j > i:
                    low = self.first[i]
                    total = np.zeros(int(self.last[j - 1] - low) + 1, np.uint64)
                    np.cumsum(table[self.data[low : self.last[j - 1]]] * power[: len(total) - 1], out=total[1:])
                    first = self.first[i:j] - low
                    out[i:j] = _mix((total[self.last[i:j] - low] - total[first]) * back[first], 7 + k)
        self._word[k] = out
        return out

    def windows(self, size: int, k: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of `size` words inside one document, and their hashes."""
        words = self._hashes(k)
        n = len(words)
        at = np.flatnonzero(self.place + size <= self.count[self.doc]) if n else np.zeros(0, np.int64)
        with np.errstate(over="ignore"):
            base, inverse = _BASES[1 - k]
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * _powers(base, n))])
            return at, _mix((total[at + size] - total[at]) * _powers(inverse, n + 1)[at], 77 + size + k)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, their counts, and the index of each key's own among them."""
    values, own, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return values, counts, own


def _delta_coded(values: np.ndarray) -> bytes:
    """Ascending numbers as differences of 7 bits a byte, the last byte of each marked."""
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    size = np.ones(len(gaps), np.int64)
    for k in range(1, 10):
        size += gaps >= np.uint64(1 << (7 * k))
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(int(size.max()) if len(size) else 0):
        has = size > k
        out[ends[has] - 1 - k] = (gaps[has] >> np.uint64(7 * k)) & np.uint64(127)
    out[ends - 1] |= 128
    return out.tobytes()


def _delta_read(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(raw & 128) + 1
    size = np.diff(ends, prepend=0)
    gaps = np.zeros(len(ends), np.uint64)
    for k in range(int(size.max()) if len(size) else 0):
        has = size > k
        gaps[has] |= (raw[ends[has] - 1 - k] & np.uint8(127)).astype(np.uint64) << np.uint64(7 * k)
    return np.cumsum(gaps)


def _range_of(values: np.ndarray, ranges: int) -> np.ndarray:
    """Cuts of ascending hashes into `ranges` equal parts of the 64-bit numbers: where each part begins."""
    edges = [np.uint64(k * (1 << 64) // ranges) for k in range(ranges)]
    return np.append(np.searchsorted(values, np.array(edges, np.uint64)), len(values))


def pack(docs: DataFrame) -> DataFrame:
    """The chunks: `chunk`, ids and byte lengths of the documents, and their texts, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", CHUNK_BYTES):
            texts = [t.encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
            data = b"\n".join(texts) + b"\n"
            row = {"ids": batch.column("doc_id").to_pylist(), "lengths": [len(t) for t in texts], "data": pa.compress(data, "zstd", asbytes=True), "n_bytes": len(data)}
            kinds = [("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("data", pa.binary()), ("n_bytes", pa.int64())]
            yield pa.RecordBatch.from_pylist([row], schema=pa.schema(kinds))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"))
    return rows.mapInArrow(run, CHUNK_SCHEMA).withColumn("chunk", F.monotonically_increasing_id())


def _words(row: dict) -> Words:
    return Words(pa.decompress(row["data"], row["n_bytes"], "zstd", asbytes=True), row["lengths"])


def _first_keys(words: Words, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct window hashes of `bits` bits, their marks, window starts, and which of the hashes each window has."""
    at, keys = words.windows(BLOCK)
    keys = keys & ~np.uint64((1 << (64 - bits)) - 1)
    values, counts, own = _distinct(keys)
    block = np.zeros(len(values), bool)
    block[own[words.place[at] % BLOCK == 0]] = True
    marks = block.astype(np.uint64) * np.uint64(2) + (counts > 1).astype(np.uint64)
    return values, marks, at, own


def _sent(row: dict, ranges: int, bits: int) -> list[tuple[int, int, bytes]]:
    values, marks, _, _ = _first_keys(_words(row), bits)
    cuts = _range_of(values, ranges)
    # The marks take the two lowest of bits + 2 bits, and each range counts from its beginning.
    shift = 62 - bits
    shorter = (values >> np.uint64(shift)) | marks
    return [
        (r, row["chunk"], _delta_coded(shorter[cuts[r] : cuts[r + 1]] - np.uint64((r << 64) // ranges >> shift & ~3)))
        for r in range(ranges) if cuts[r + 1] > cuts[r]
    ]


def _answers(keys: list[np.ndarray]) -> list[np.ndarray]:
    """For the keys that each chunk sent: those that are a block anywhere and occur at two places or more."""
    together = np.concatenate(keys)
    values, own = np.unique(together >> np.uint64(2), return_inverse=True)
    times = np.bincount(own) + np.bincount(own, (together & np.uint64(1)) > 0, len(values))
    block = np.bincount(own, (together & np.uint64(2)) > 0, len(values)) > 0
    hit = ((times > 1) & block)[own]
    return np.split(hit, np.cumsum([len(k) for k in keys])[:-1])


def _candidates(words: Words, answers: dict[int, bytes], ranges: int, bits: int) -> np.ndarray:
    """Starts of the windows of WINDOW words that hold a hit."""
    values, _, at, own = _first_keys(words, bits)
    cuts = _range_of(values, ranges)
    hit = np.zeros(len(values), bool)
    for r, packed in answers.items():
        n = cuts[r + 1] - cuts[r]
        hit[cuts[r] : cuts[r + 1]] = np.unpackbits(np.frombuffer(packed, np.uint8), count=n).astype(bool)
    places = at[hit[own]]
    n = len(words.first)
    # A hit at p is inside the windows that start from p - (WINDOW - BLOCK) to p.
    ahead = np.bincount(np.maximum(0, places - (WINDOW - BLOCK)), minlength=n + 1) - np.bincount(places + 1, minlength=n + 1)[: n + 1]
    inside = np.cumsum(ahead[:n]) > 0
    starts = np.flatnonzero(words.place + WINDOW <= words.count[words.doc]) if n else np.zeros(0, np.int64)
    return starts[inside[starts]]


#: What is sent of a window of WINDOW words: 96 bits of hash and where it starts.
_LONG = np.dtype([("a", "<u8"), ("b", "<u4"), ("at", "<u4")])


def _long_keys(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows of WINDOW words with the two parts of their 96-bit hash."""
    at, a = words.windows(WINDOW, 0)
    _, b = words.windows(WINDOW, 1)
    return at, a, (b >> np.uint64(32)).astype(np.uint32)


def _rows(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


_SENT = (["range", "chunk", "keys"], [pa.int64(), pa.int64(), pa.binary()])
_ANSWER = (["chunk", "range", "bits"], [pa.int64(), pa.int64(), pa.binary()])


def deduplicate(docs: DataFrame) -> DataFrame:
    """`doc_id`, `n_words`, `n_removed` and `kept`, the words that stay joined by one space, for every row of `docs`."""
    spark = docs.sparkSession
    scratch_root(spark)
    chunks = pack(docs).checkpoint()
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    # About one window per six bytes.
    ranges = max(1, int(total // (6 * RANGE_HASHES)))
    width = min(62, max(20, int(total // 6).bit_length() + SPARE_BITS))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield from _rows(_sent(batch.slice(k, 1).to_pylist()[0], ranges, width), *_SENT).to_batches()

    def answer(table: pa.Table) -> pa.Table:
        chunk, own = table.column("chunk").to_pylist(), table.column("range")[0].as_py()
        hits = _answers([_delta_read(k) for k in table.column("keys").to_pylist()])
        return _rows([(c, own, np.packbits(h).tobytes()) for c, h in zip(chunk, hits) if h.any()], *_ANSWER)

    def extend(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        bits = dict(zip(right.column("range").to_pylist(), right.column("bits").to_pylist()))
        for row in left.to_pylist() if bits else []:
            words = _words(row)
            starts = _candidates(words, bits, ranges, width)
            at, a, b = _long_keys(words)
            chosen = np.searchsorted(at, starts)
            a, b = a[chosen], b[chosen]
            order = np.lexsort((b, a))
            fresh = np.ones(len(order), bool)
            fresh[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
            where = order[fresh]
            cuts = _range_of(a[where], ranges)
            sent = np.empty(len(where), _LONG)
            sent["a"], sent["b"], sent["at"] = a[where], b[where], starts[where]
            out.extend((r, row["chunk"], sent[cuts[r] : cuts[r + 1]].tobytes()) for r in range(ranges) if cuts[r + 1] > cuts[r])
        return _rows(out, *_SENT)

    def decide(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(k, _LONG) for k in table.column("keys").to_pylist()]
        together = np.concatenate(parts)
        order = np.lexsort((together["b"], together["a"]))
        a, b = together["a"][order], together["b"][order]
        same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        twice = np.zeros(len(together), bool)
        twice[order] = np.append(same, False) | np.append(False, same)
        rows = []
        for chunk, part, hit in zip(table.column("chunk").to_pylist(), parts, np.split(twice, np.cumsum([len(p) for p in parts])[:-1])):
            if hit.any():
                rows.append((chunk, table.column("range")[0].as_py(), part["at"][hit].tobytes()))
        return _rows(rows, *_ANSWER)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        elsewhere = [np.frombuffer(b, "<u4") for b in right.column("bits").to_pylist()]
        tables = [_removed(row, np.concatenate(elsewhere) if elsewhere else np.zeros(0, np.uint32)) for row in left.to_pylist()]
        return pa.concat_tables(tables)

    sent = chunks.select("ids", "lengths", "data", "n_bytes", "chunk").mapInArrow(send, SENT_SCHEMA)
    answers = sent.groupBy("range").applyInArrow(answer, ANSWER_SCHEMA)
    longer = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(extend, SENT_SCHEMA)
    repeats = longer.groupBy("range").applyInArrow(decide, ANSWER_SCHEMA)
    return chunks.groupBy("chunk").cogroup(repeats.groupBy("chunk")).applyInArrow(finish, OUT_SCHEMA)


def _removed(row: dict, elsewhere: np.ndarray) -> pa.Table:
    """The result rows of a chunk. elsewhere: starts of windows that other chunks hold as well."""
    words = _words(row)
    n = len(words.first)
    at, a, b = _long_keys(words)
    repeated = np.zeros(len(at), bool)
    if len(at):
        order = np.lexsort((b, a))
        same = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
        group = np.concatenate([[0], np.cumsum(~same)])
        found = np.zeros(len(at), bool)
        found[np.searchsorted(at, elsewhere)] = True
        # A group counts if it has two places here, or one that is elsewhere as well.
        good = (np.bincount(group) > 1) | (np.bincount(group, found[order]) > 0)
        repeated[order] = good[group]
    starts = at[repeated]
    ahead = np.bincount(starts, minlength=n + 1) - np.bincount(starts + WINDOW, minlength=n + 1)[: n + 1]
    gone = np.cumsum(ahead[:n]) > 0 if n else np.zeros(0, bool)
    removed = np.bincount(words.doc[gone], minlength=len(row["ids"]))
    keep = np.flatnonzero(~gone)
    # The kept words with the byte after each, which becomes a space, cut at documents.
    inside = np.zeros(len(words.data) + 2, np.int8)
    inside[words.first[keep]] += 1
    inside[words.last[keep] + 1] -= 1
    data = words.data.copy()
    data[words.last[keep]] = 32
    blob = data[np.cumsum(inside[: len(data)], dtype=np.int8).astype(bool)].tobytes()
    kept = np.bincount(words.doc[keep], words.last[keep] - words.first[keep] + 1, len(row["ids"])).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(kept)])
    texts = [blob[s : max(s, e - 1)].decode("utf-8", "surrogatepass") for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.table([pa.array(c, k) for c, k in zip((row["ids"], words.count, removed, texts), kinds)], names=["doc_id", "n_words", "n_removed", "kept"])
