"""Product codes of vectors, learned by exact integer rounds with LAESA pivots.

A vector is cut into equal parts, and each part position has a codebook of a few entries that rounds of assignment and averaging improve. All of it is integer
arithmetic, so that results don't depend on how the rows are dealt out.

The pivots are the entries that the codebooks start from. Distances from every part to the pivots of its position are computed once and stored with the
vectors. The entries move, but after each round the distances between pivots and entries are few; the triangle inequality then bounds the distance between a part and an
entry from below, for every entry. A part tries its entries in ascending order of that bound and stops when the bound exceeds the best distance found;
only what is tried is evaluated, exactly and in integers. Bounds are floating point with a margin for rounding, so no entry that could win or tie is skipped.

Only codebooks and the sums for their next round pass through the driver: entries times dimension, whatever the number of vectors. Sums are first taken per task.

Defined cases: rows whose vector is NULL or holds a NULL, a NaN or an infinity are dropped. Of equal ids the smaller vector comes first when the first entries are taken, and rows
without an id come last; each is a row of the result. With fewer vectors than entries a codebook has fewer. The dimension is that of the
first vector; vectors of another length are returned without code and error and have no part in the codebooks. A dimension that 8 does not divide
is cut as evenly as possible, at floor(part * dimension / 8). Components too large for 64-bit distances take the same steps with integers of any size; an error or a sum of errors
beyond 64 bits is NULL. An empty table gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candor.session import scratch_path

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Rows that one step of a task looks at.
BLOCK = 4096
#: Below these sizes squared distances of a part fit in 64 bits.
_LARGEST = 2**62
#: What a bound gives away for rounding: pivot distances are stored with 24 bits.
_SLACK = 2.0**-20

Codebooks = list[np.ndarray]  # one array of entries x width per part


def kept(vectors: DataFrame) -> DataFrame:
    """`vec_id`, `label` and `vector` of the rows whose vector is whole."""
    kind = dict(vectors.dtypes)["embedding"]
    vector = F.col("embedding") if kind == "array<float>" else F.col("embedding").cast("array<double>")
    rows = vectors.select("vec_id", "label", vector.alias("vector"))
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return rows.where(F.col("vector").isNotNull() & whole)


def integers(values: np.ndarray) -> np.ndarray:
    """floor(4096 x), in 64 bits where squared distances of a part are sure to fit, else as Python integers."""
    width = values.shape[1] if values.ndim > 1 else len(values)
    if not values.size or (4 * width) * (SCALE * float(np.abs(values).max()) + 1) ** 2 < _LARGEST:
        return np.floor(values * SCALE).astype(np.int64)
    out = np.empty(values.shape, object)
    out.ravel()[:] = [math.floor(Fraction(x) * SCALE) for x in values.ravel().tolist()]
    return out


def _cuts(dimension: int) -> list[int]:
    return [p * dimension // PARTS for p in range(PARTS + 1)]


def _parts(values: np.ndarray) -> list[np.ndarray]:
    cuts = _cuts(values.shape[1])
    return [values[:, a:b] for a, b in zip(cuts, cuts[1:])]


def _joint(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as Python integers unless the distances between them fit in 64 bits."""
    if a.dtype != object and b.dtype != object:
        largest = max((int(np.abs(x).max()) for x in (a, b) if x.size), default=0)
        if 4 * max(1, a.shape[-1]) * largest**2 < _LARGEST:
            return a, b
    return a.astype(object), b.astype(object)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows."""
    a, b = _joint(a, b)
    return ((a - b) ** 2).sum(axis=-1) if a.shape[-1] else np.zeros(np.broadcast_shapes(a.shape[:-1], b.shape[:-1]), np.int64)


def _root(distances: np.ndarray) -> np.ndarray:
    if distances.dtype != object:
        return np.sqrt(distances.astype(np.float64))
    # Of integers beyond floating point nothing is known.
    return np.array([math.sqrt(d) if d < 10**300 else math.nan for d in distances.ravel()], np.float64).reshape(distances.shape)


def pivot_distances(parts: list[np.ndarray], pivots: Codebooks) -> np.ndarray:
    """Distances of each row's parts to the pivots of their position, row by row: part, then pivot."""
    columns = [_root(squared(part, pivot)) for part, book in zip(parts, pivots) for pivot in book]
    with np.errstate(over="ignore"):
        return np.stack(columns, 1).astype(np.float32)


def nearest(part: np.ndarray, to_pivots: np.ndarray, book: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index of and squared distance to the nearest entry for each row of one part, and how many distances were evaluated."""
    between = np.stack([_root(squared(pivots, entry)) for entry in book], 1)
    bound = np.zeros((len(part), len(book)))
    for k in range(len(pivots)):
        known, entry = to_pivots[:, k, None].astype(np.float64), between[None, k]
        with np.errstate(invalid="ignore"):
            step = np.abs(known - entry) - _SLACK * (known + entry)
        # An unknown distance bounds nothing.
        np.fmax(bound, step, out=bound)
    order = np.argsort(bound, axis=1, kind="stable")
    best_index = order[:, 0].copy()
    best = squared(part, book[best_index])
    evaluated, left = len(part), np.arange(len(part))
    for k in range(1, len(book)):
        entry = order[left, k]
        # Bounds ascend along the order: what stops here needs no further entry.
        going = ~(bound[left, entry] > _root(best[left]) * (1 + _SLACK))
        left, entry = left[going], entry[going]
        if not len(left):
            break
        distance = squared(part[left], book[entry])
        evaluated += len(left)
        better = (distance < best[left]) | (distance == best[left]) & (entry < best_index[left])
        if distance.dtype == object:
            best = best.astype(object)
        best[left[better]], best_index[left[better]] = distance[better], entry[better]
    return best_index, best, evaluated


def _blocks(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray | None]]:
    """Runs of rows with their vectors; None for rows whose vectors have another length."""
    for batch in batches:
        same = np.array([len(v) for v in batch.column("vector")], np.int64) == dimension
        for chosen, usable in ((same, True), (~same, False)):
            rows = batch.filter(pa.array(chosen))
            for start in range(0, rows.num_rows, BLOCK):
                block = rows.slice(start, BLOCK)
                values = block.column("vector").flatten().to_numpy(zero_copy_only=False) if usable else None
                yield block, values.astype(np.float64).reshape(block.num_rows, dimension) if usable else None


def _pivots_of(block: pa.RecordBatch, pivots: Codebooks) -> list[np.ndarray]:
    n = len(pivots[0])
    table = block.column("to_pivots").flatten().to_numpy(zero_copy_only=False).reshape(block.num_rows, PARTS, n)
    return [table[:, p] for p in range(PARTS)]


def first_entries(rows: DataFrame, entries: int = ENTRIES) -> Codebooks:
    """The parts of the vectors with the smallest ids, ascending. At most `entries` vectors reach the driver."""
    ordered = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector")
    first = ordered.select(F.size("vector").alias("n")).first()
    if first is None:
        return []
    found = [r.vector for r in ordered.where(F.size("vector") == first.n).limit(entries).select("vector").collect()]
    return _parts(integers(np.array(found, np.float64).reshape(len(found), first.n)))


def with_pivots(rows: DataFrame, pivots: Codebooks) -> DataFrame:
    """The rows with their pivot distances (`to_pivots`), written to the shared folder: they are read once a round."""
    spark, dimension = rows.sparkSession, sum(b.shape[1] for b in pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, values in _blocks(batches, dimension):
            far = None if values is None else pivot_distances(_parts(integers(values)), pivots)
            lists = pa.nulls(block.num_rows, pa.list_(pa.float32())) if far is None else pa.array(list(far), pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*block.columns, lists], [*block.schema.names, "to_pivots"])

    path = scratch_path(spark, "pivot_distances")
    schema = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    rows.mapInArrow(run, f"{schema}, to_pivots array<float>").write.parquet(path)
    return spark.read.parquet(path)


def _sums(rows: DataFrame, pivots: Codebooks, books: Codebooks) -> DataFrame:
    """Per task, part and entry: how many parts chose it and their sums, as decimal text of any length."""
    dimension = sum(b.shape[1] for b in pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((PARTS, len(books[0])), np.int64)
        totals = [[[0] * b.shape[1] for _ in b] for b in books]
        for block, values in _blocks(batches, dimension):
            if values is None:
                continue
            for p, (part, far) in enumerate(zip(_parts(integers(values)), _pivots_of(block, pivots))):
                index, _, _ = nearest(part, far, books[p], pivots[p])
                counts[p] += np.bincount(index, minlength=len(books[p]))
                for e in np.unique(index):
                    totals[p][e] = [a + int(b) for a, b in zip(totals[p][e], part[index == e].sum(axis=0))]
        found = [(p, int(e), int(counts[p, e]), [str(x) for x in totals[p][e]]) for p, e in zip(*np.nonzero(counts))]
        columns = list(zip(*found)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.list_(pa.string()))], ["part", "entry", "n", "sums"]
        )

    return rows.mapInArrow(run, "part int, entry int, n long, sums array<string>")


def improved(rows: DataFrame, pivots: Codebooks, books: Codebooks) -> Codebooks:
    """One round: every part goes to its nearest entry, and used entries become the floor of their parts' mean."""

    def added(key: tuple, table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        n = sum(r["n"] for r in rows)
        mean = [str(sum(int(r["sums"][j]) for r in rows) // n) for j in range(len(rows[0]["sums"]))]
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "entry": pa.array([key[1].as_py()], pa.int32()), "mean": pa.array([mean], pa.list_(pa.string()))})

    means = _sums(rows, pivots, books).groupBy("part", "entry").applyInArrow(added, "part int, entry int, mean array<string>")
    new = [b.astype(object) for b in books]
    for row in means.collect():
        new[row["part"]][row["entry"]] = [int(x) for x in row["mean"]]
    return [_narrow(b) for b in new]


def _narrow(book: np.ndarray) -> np.ndarray:
    return book.astype(np.int64) if all(abs(x) < 2**31 for x in book.ravel()) else book


def train(rows: DataFrame, pivots: Codebooks, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks after a number of rounds from the pivots on. `rows` as `with_pivots` gives them."""
    books = [_narrow(b) for b in pivots]
    for _ in range(rounds):
        books = improved(rows, pivots, books)
    return books


def codebooks_sha256(books: Codebooks) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def codes(rows: DataFrame, pivots: Codebooks, books: Codebooks) -> DataFrame:
    """`vec_id`, `label`, `code` (two hex digits a part) and `error`, the squared distance to what the code stands for."""
    dimension = sum(b.shape[1] for b in pivots)
    label = dict(rows.dtypes)["label"]
    vec_id = dict(rows.dtypes)["vec_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, values in _blocks(batches, dimension):
            names, errors = [None] * block.num_rows, [None] * block.num_rows
            if values is not None:
                found = [nearest(part, far, book, pivot) for part, far, book, pivot in zip(_parts(integers(values)), _pivots_of(block, pivots), books, pivots)]
                indexes = np.stack([index for index, _, _ in found], 1)
                names = ["".join(f"{i:02x}" for i in row) for row in indexes.tolist()]
                errors = [e if e < 2**63 else None for e in map(sum, zip(*[[int(d) for d in best] for _, best, _ in found]))]
            yield pa.RecordBatch.from_arrays([block.column("vec_id"), block.column("label"), pa.array(names, pa.string()), pa.array(errors, pa.int64())], ["vec_id", "label", "code", "error"])

    # Written, since errors are summed per label before they meet the rows again.
    path = scratch_path(rows.sparkSession, "vector_codes")
    rows.select("vec_id", "label", "vector", "to_pivots").mapInArrow(run, f"vec_id {vec_id}, label {label}, code string, error long").write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def label_errors(coded: DataFrame) -> DataFrame:
    """Adds `label_error`, the errors summed over rows of the same label, those without label together."""
    key = F.concat_ws(":", F.col("label").isNull().cast("string"), F.col("label").cast("string"))
    sums = coded.groupBy(key.alias("_key")).agg(F.try_sum(F.col("error").cast("decimal(38,0)")).alias("_sum"))
    # A new key expression: both sides of the join are plain shuffles, and a hot label can be split.
    sums = sums.select(F.concat("_key", F.lit("")).alias("_label"), F.expr("try_cast(_sum as bigint)").alias("label_error"))
    return coded.join(sums, key == F.col("_label"), "left").drop("_label")


def compress(vectors: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> tuple[DataFrame, Codebooks]:
    """Codes of all whole vectors (`codes`) and the codebooks they refer to; vectors come in `vec_id`, `embedding`, `label`."""
    rows = kept(vectors)
    pivots = first_entries(rows, entries)
    if not pivots:
        # No whole vector at all: the codebooks are empty, and so is the result.
        return rows.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")), []
    stored = with_pivots(rows, pivots)
    books = train(stored, pivots, rounds)
    return codes(stored, pivots, books), books


def decompress(code: str, books: Codebooks) -> list[int]:
    """The integer components that a code stands for."""
    return [int(x) for p, book in enumerate(books) for x in book[int(code[2 * p : 2 * p + 2], 16)]]
