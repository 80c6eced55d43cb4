"""Best-fit packing of documents into sequences of a fixed number of tokens, by bin completion.

Only lengths matter for packing, and a piece has one of at most `capacity` lengths. So the corpus is first reduced to how many pieces there are of each length (at
most 2048 numbers), and the packing is found for these counts: a list of patterns, each a filling of one sequence and how often it is used. The search takes the largest length that is
left, enumerates the fillings of the space beside it, drops those that another filling dominates (its documents fit into the other's places), and
branches over the rest, least waste first. A branch ends where its waste, or the lower bound for what is left, can't beat the best packing known, which at
the start is that of best-fit decreasing. It stops as soon as a packing meets the lower bound of the whole.

The search is the only step that doesn't grow with the corpus. Tokens, pieces, the numbering of pieces of equal length and their places are Spark jobs. Pieces are numbered
inside each task and length; sums per task make the numbers global, so a length that a third of all pieces have is spread like any other.

`effort` bounds the branches that the search looks at. It never drops a piece; it only decides how long a better packing is looked for.

Defined cases: a NULL or empty text is the end id alone. Rows without id and rows with the same id are documents of their own. Texts longer than the capacity are cut into
pieces of exactly that many tokens, with the rest, if any, as their first piece. An empty table gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candor.llm.common import kept_in_worker, small_batches, text_of
from candor.llm.token_records import Encoder
from candor.session import scratch_path

CAPACITY = 2048
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, part int, rank long"
#: Fillings a branch keeps, and places the enumeration of fillings looks at.
FILLINGS, LOOKS = 8, 400


def write_pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their token ids, written to the shared folder. `rank` numbers the pieces of one length inside `part`, the task that made them."""
    spark = docs.sparkSession

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = kept_in_worker(tokenizer_path, lambda: Encoder(tokenizer_path, added_tokens=True)), np.array([end_id], "<u4")
        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in small_batches(batches, "text", 4 << 20, tokenizer_path):
            rows = []
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), encoder.ids(batch.column("text"))):
                ids = np.concatenate((found, end))
                first = (len(ids) - 1) % capacity + 1
                for k, stop in enumerate(range(first, len(ids) + 1, capacity)):
                    start = max(0, stop - capacity) if k else 0
                    data, length = ids[start:stop].tobytes(), stop - start
                    rows.append((doc_id, k, start, length, zlib.crc32(data), data, part, seen[length]))
                    seen[length] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], [c.split()[0] for c in PIECES.split(", ")])

    path = scratch_path(spark, "pieces")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"))
    rows.mapInArrow(cut, PIECES).write.parquet(path)
    return spark.read.parquet(path)


_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]


# --- the search ----------------------------------------------------------------------------------------

Filling = tuple[tuple[int, int], ...]  # (length, how many), largest first
Pattern = tuple[int, Filling]  # how many sequences, and what each holds


def lower_bound(counts: np.ndarray) -> int:
    """Sequences that any packing needs. For every k: what is over capacity - k stands alone, what is over half stands apart, and what is k or longer needs room."""
    capacity = len(counts) - 1
    lengths = np.arange(capacity + 1)
    n_up_to, tokens_up_to = np.cumsum(counts), np.cumsum(counts * lengths)
    total, half = int(n_up_to[-1]), capacity // 2
    best = -(-int(tokens_up_to[-1]) // capacity)
    k = np.arange(0, half + 1)
    alone = total - n_up_to[capacity - k]
    apart = n_up_to[capacity - k] - n_up_to[half]
    room = apart * capacity - (tokens_up_to[capacity - k] - tokens_up_to[half])
    small = tokens_up_to[half] - np.concatenate(([0], tokens_up_to))[k]
    more = np.maximum(0, -((room - small) // capacity))
    return max(best, int((alone + apart + more).max()))


def best_fit_decreasing(counts: np.ndarray) -> list[Pattern]:
    """Longest first, each into the fullest sequence that has room. Sequences that look alike are handled together."""
    capacity = len(counts) - 1
    # By room left: (how many, filling) of sequences that are alike.
    open_: dict[int, list[tuple[int, tuple[tuple[int, int], ...]]]] = {}
    rooms: list[int] = []
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        rooms = sorted(r for r, alike in open_.items() if alike)
        for room in rooms:
            while left and room >= length and open_[room]:
                many, filling = open_[room].pop()
                # The fullest sequence stays the fullest until the length no longer fits.
                each = min(room // length, left)
                used = min(many, left // each)
                left -= used * each
                open_.setdefault(room - each * length, []).append((used, (*filling, (length, each))))
                if many > used:
                    open_[room].append((many - used, filling))
        each = capacity // length
        if left >= each:
            open_.setdefault(capacity - each * length, []).append((left // each, ((length, each),)))
        if left % each:
            open_.setdefault(capacity - left % each * length, []).append((1, ((length, left % each),)))
    return [pattern for alike in open_.values() for pattern in alike]


def fits_into(small: list[int], places: list[int]) -> bool:
    """Whether the lengths can be shared out over the places. Both descend; small lists only."""
    if not small:
        return True
    return any(
        fits_into(small[1:], sorted([*places[:i], place - small[0], *places[i + 1 :]], reverse=True))
        for i, place in enumerate(places)
        if place >= small[0] and place not in places[:i]
    )


def fillings(lengths: list[int], counts: np.ndarray, room: int) -> list[Filling]:
    """Undominated fillings of a room with what is left, least waste first, then fewer and longer pieces. `lengths` descend.

    Looks at the longest pieces first, at most `LOOKS` places; a filling that is full ends the search, because what comes after has shorter pieces.
    """
    found: list[tuple[int, int, Filling]] = []
    looks = 0

    def extend(at: int, space: int, taken: tuple[tuple[int, int], ...]) -> bool:
        nonlocal looks
        looks += 1
        maximal = True
        while at < len(lengths) and looks < LOOKS:
            length = lengths[at]
            at += 1
            most = min(int(counts[length]), space // length) if length <= space else 0
            if not most:
                continue
            # Something fits, so what is taken so far is not a whole filling.
            maximal = False
            for many in ((most, 1) if 1 < most < 4 else (most,)):
                if extend(at, space - many * length, (*taken, (length, many))):
                    return True
        if maximal and taken:
            found.append((space, sum(k for _, k in taken), taken))
        return maximal and space == 0

    extend(0, room, ())
    found.sort(key=lambda f: (f[0], f[1], tuple(-x for pair in f[2] for x in pair)))
    kept: list[tuple[list[int], Filling]] = []
    for _, _, filling in found:
        flat = [length for length, k in filling for _ in range(k)]
        if len(kept) < FILLINGS and not any(len(flat) <= 12 and fits_into(flat, other) for other, _ in kept):
            kept.append((flat, filling))
    return [filling for _, filling in kept] or [()]


@dataclass
class _Branch:
    """A place in the search: what to take next, and what was taken to get here."""

    choices: list[Pattern]
    waste: int
    used: int
    taken: Pattern | None = None
    next: int = field(default=0)


def complete(counts: np.ndarray, effort: int = 20_000) -> list[Pattern]:
    """Patterns that hold every piece, `counts[l]` of each length l, in as few sequences as the search finds."""
    counts = counts.astype(np.int64).copy()
    capacity, tokens = len(counts) - 1, int((counts * np.arange(len(counts))).sum())
    best = best_fit_decreasing(counts)
    fewest, floor = sum(m for m, _ in best), lower_bound(counts)

    def choices() -> list[Pattern]:
        lengths = np.flatnonzero(counts)[::-1].tolist()
        largest = lengths[0]
        counts[largest] -= 1
        out = []
        for rest in fillings([x for x in lengths if x <= capacity - largest], counts, capacity - largest):
            filling = ((largest, 1), *rest) if not rest or rest[0][0] != largest else ((largest, 1 + rest[0][1]), *rest[1:])
            out.append(filling)
        counts[largest] += 1
        patterns = []
        for filling in out:
            most = min(int(counts[length]) // k for length, k in filling)
            # As often as it goes, or once, after which the same length is looked at again.
            patterns.extend((m, filling) for m in dict.fromkeys((most, 1)))
        return patterns

    def apply(pattern: Pattern, sign: int) -> None:
        many, filling = pattern
        for length, k in filling:
            counts[length] += sign * many * k

    if fewest == floor or not tokens:
        return best
    path = [_Branch(choices(), 0, 0)]
    looked = 0
    while path and fewest > floor and looked < effort:
        branch = path[-1]
        if branch.next == len(branch.choices):
            path.pop()
            if branch.taken:
                apply(branch.taken, 1)
            continue
        pattern = branch.choices[branch.next]
        branch.next += 1
        looked += 1
        many, filling = pattern
        waste = branch.waste + many * (capacity - sum(length * k for length, k in filling))
        used = branch.used + many
        # One sequence fewer than the best packing may waste no more than this.
        if waste > (fewest - 1) * capacity - tokens:
            continue
        apply(pattern, -1)
        if not counts.any():
            # All packed, and by the test above in fewer sequences than before.
            fewest, best = used, [b.taken for b in path if b.taken] + [pattern]
            apply(pattern, 1)
        elif used + lower_bound(counts) >= fewest:
            apply(pattern, 1)
        else:
            path.append(_Branch(choices(), waste, used, pattern))
    return best


# --- places --------------------------------------------------------------------------------------------

@dataclass
class Plan:
    """Where the r-th piece of each length goes. Rows ascend by length and first rank; their number depends on the patterns, not on the corpus."""

    key: np.ndarray  # length * 2^48 + first rank
    each: np.ndarray  # pieces of this length per sequence
    sequence: np.ndarray  # first sequence of the pattern
    offset: np.ndarray  # of the first of them in the sequence
    sequences: int


def plan(patterns: list[Pattern]) -> Plan:
    given: dict[int, int] = {}
    rows, sequence = [], 0
    for many, filling in patterns:
        offset = 0
        for length, each in filling:
            rows.append(((length << 48) + given.get(length, 0), each, sequence, offset))
            given[length] = given.get(length, 0) + many * each
            offset += length * each
        sequence += many
    columns = np.array(sorted(rows), np.int64).reshape(len(rows), 4).T
    return Plan(*columns, sequence)


def length_counts(pieces: DataFrame, capacity: int = CAPACITY) -> np.ndarray:
    """How many pieces there are of each length: `capacity` numbers, whatever the corpus."""
    counts = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    return counts


def place(pieces: DataFrame, where: Plan) -> DataFrame:
    """Adds `sequence_id` and `offset` to pieces (`part`, `length`, `rank` and any other columns)."""
    per_task = pieces.groupBy("part", "length").agg(F.max("rank").alias("last"))
    before = F.sum(F.col("last") + 1).over(Window.partitionBy("length").orderBy("part")) - F.col("last") - 1
    starts = per_task.select(F.col("part").alias("_part"), F.col("length").alias("_length"), before.alias("_before"))
    numbered = pieces.join(starts, (F.col("part") == F.col("_part")) & (F.col("length") == F.col("_length"))).withColumn("rank", F.col("rank") + F.col("_before"))
    rows = numbered.drop("_part", "_length", "_before", "part")
    schema = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            key = (length << 48) + rank
            at = np.searchsorted(where.key, key, "right") - 1
            nth = key - where.key[at]
            sequence = where.sequence[at] + nth // where.each[at]
            offset = where.offset[at] + nth % where.each[at] * length
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(offset)], [*batch.schema.names, "sequence_id", "offset"])

    return rows.mapInArrow(run, f"{schema}, sequence_id long, offset long").drop("rank")


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = CAPACITY, effort: int = 20_000, with_ids: bool = True) -> DataFrame:
    """All pieces with their ids and places: `doc_id`, `piece`, `start`, `length`, `ids_crc32`, `ids`, `sequence_id`, `offset`."""
    pieces = write_pieces(docs, tokenizer_path, end_id, capacity)
    where = plan(complete(length_counts(pieces, capacity), effort))
    return place(pieces if with_ids else pieces.drop("ids"), where)


def sequences(packed: DataFrame) -> DataFrame:
    """`sequence_id`, `ids` (little-endian, 32 bit) and `doc_ids` of each sequence. A group holds no more tokens than the capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id")))
    joined = packed.groupBy("sequence_id").agg(parts.alias("_parts"))
    ids = F.aggregate("_parts", F.lit(b""), lambda done, p: F.concat(done, p["ids"]))
    return joined.select("sequence_id", ids.alias("ids"), F.transform("_parts", lambda p: p["doc_id"]).alias("doc_ids"))
