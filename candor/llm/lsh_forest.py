"""Near-duplicate documents with an LSH forest over minhash signatures.

1. Shingles. A document is the set of its distinct runs of `size` words (A-Z in lower case), as 64-bit hashes. Documents with equal sets are one class; only its
   smallest id goes on.
2. Forest. A signature has TREES * DEPTH minhash values. Each tree reads them from another place on, and all classes are sorted in the order of each tree, dealt
   out by ranges of that order. Neighbours whose common prefix has DEPTH values or more are candidates. A region, a run of rows with such a prefix, is tied
   together at its first row and goes on as long as its rows agree in all of their DEPTH values, however many there are (the depth is fixed); where a region reaches over a range, its parts are tied too.
   Pairs of similarity 0.8 meet in one tree at least with odds of 1 - 3 * 10^-6.
3. Exact links. Tied classes are components of candidates. Each goes with its full shingle sets to one task, and there links are decided by intersection and
   union. A row of intersections against all members costs the postings of its shingles; the most central member is first, then only members outside the largest
   component can add a link, so a group of near copies costs little more than one row each. A component of more than GROUP_BYTES of sets is cut into blocks, one task
   for each two blocks, so no task holds more than two of them, and no link is lost.
4. Components of the links, by their smallest id.

Copies are never expanded into pairs, and no group is collected beyond GROUP_BYTES.

Defined cases: NULL and empty texts, and texts without a word, are linked with nothing. Texts of fewer than `size` words are one shingle. Rows that share an id are
judged each by its own set; sets with the same smallest id are tied. Rows with a NULL id are linked with nothing. Columns other than `doc_id` and `text` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candor.llm.common import small_batches, text_of
from candor.llm.components import components
from candor.llm.fixed_blocks import Words
from candor.session import scratch_root

TREES, DEPTH = 24, 4
SIMILARITY = 80
GROUP_BYTES = 32 << 20
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_FUNCTIONS = np.random.default_rng(20240229).integers(0, 1 << 32, (TREES * DEPTH, 2), dtype=np.uint32) | np.array([0, 1], np.uint32)


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    encoded = [t.encode("utf-8", "surrogatepass").translate(_LOWER) for t in texts]
    words = Words(b"\n".join(encoded) + b"\n", [len(t) for t in encoded])
    at, hashes = words.windows(size)
    doc = words.doc[at]
    for shorter in range(1, size):
        # Texts of so many words have one shingle, all of them.
        first, own = words.windows(shorter)
        whole = words.count[words.doc[first]] == shorter
        doc, hashes = np.concatenate([doc, words.doc[first][whole]]), np.concatenate([hashes, own[whole]])
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    doc, hashes = doc[fresh], hashes[fresh]
    edges = np.searchsorted(doc, np.arange(len(texts) + 1))
    return [hashes[s:e] for s, e in zip(edges[:-1].tolist(), edges[1:].tolist())]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Low 16 bits of each minhash value; a row per set, none of them empty."""
    lengths = np.fromiter(map(len, sets), np.int64, len(sets))
    x = np.concatenate(sets)
    x = (x ^ (x >> np.uint64(32))).astype(np.uint32)
    starts = np.cumsum(lengths) - lengths
    out = np.empty((len(sets), TREES * DEPTH), np.uint16)
    for k, (mask, factor) in enumerate(_FUNCTIONS):
        out[:, k] = np.minimum.reduceat((x ^ mask) * factor, starts).astype(np.uint16)
    return out


def _signed(docs: DataFrame, size: int) -> DataFrame:
    """`doc_id`, `n_shingles`, `key` of the set and `signature` (NULL for an empty set) of every row, and a hash of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 4 << 20):
            sets = shingle_sets(batch.column("text").to_pylist(), size)
            full = [k for k, s in enumerate(sets) if len(s)]
            rows: list[bytes | None] = [None] * len(sets)
            for k, row in zip(full, signatures([sets[k] for k in full]) if full else ()):
                rows[k] = row.tobytes()
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(map(len, sets), pa.int64()), pa.array(keys, pa.binary()), pa.array(rows, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_shingles", "key", "signature"])

    text = text_of(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, key binary, signature binary")


def _orders(classes: DataFrame) -> DataFrame:
    """A row per class and tree: the first DEPTH values of the tree's order in `high`, as many more in `low`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(n, TREES, DEPTH)
            packed = np.zeros((n, TREES), np.int64)
            for k in range(DEPTH):
                packed = packed << 16 | values[:, :, k].astype(np.int64)
            columns = (np.tile(np.arange(TREES), n), packed.ravel(), np.roll(packed, -1, axis=1).ravel(), np.repeat(batch.column("id").to_numpy(), TREES))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["tree", "high", "low", "id"])

    return classes.select("id", "signature").mapInArrow(run, "tree long, high long, low long, id long")


def _ties(classes: DataFrame) -> DataFrame:
    """Candidate edges `a`, `b`: every class of a region with the first one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["a", "b", "tree", "high"], [pa.int64()] * 4
        last: tuple | None = None
        borders: list[tuple] = []
        for batch in batches:
            tree, high, ids = (batch.column(c).to_numpy() for c in ("tree", "high", "id"))
            if not len(ids):
                continue
            fresh = np.ones(len(ids), bool)
            fresh[1:] = (tree[1:] != tree[:-1]) | (high[1:] != high[:-1])
            if last is not None and (tree[0], high[0]) == last[:2]:
                fresh[0] = False
            heads = np.maximum.accumulate(np.where(fresh, np.arange(len(ids)), -1))
            head = np.where(heads >= 0, ids[heads], last[2] if last else 0)
            if last is None:
                borders.append((tree[0], high[0], ids[0]))
            last = (tree[-1], high[-1], head[-1])
            rest = ~fresh
            if rest.any():
                empty = pa.nulls(int(rest.sum()), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(head[rest]), pa.array(ids[rest]), empty, empty], names)
        if last is not None:
            borders.append(last)
            columns = ([int(b[2]) for b in borders], [int(b[2]) for b in borders], [int(b[0]) for b in borders], [int(b[1]) for b in borders])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    order = ["tree", "high", "low", "id"]
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _orders(classes).repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(run, "a long, b long, tree long, high long").checkpoint()
    # Two rows per range at most: the first and the last region of each, tied to the same region in other ranges.
    border = rows.where("tree IS NOT NULL")
    across = border.join(border.groupBy("tree", "high").agg(F.min("a").alias("first")), ["tree", "high"]).select(F.col("first").alias("a"), "b")
    return rows.where("tree IS NULL").select("a", "b").union(across)


def links_within(ids: list[int], sets: list[np.ndarray], similarity: int = SIMILARITY) -> np.ndarray:
    """For each member the smallest id of the component that the exact links among all members make."""
    n = len(ids)
    names = np.array(ids, np.int64)
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def tie(i: int, j: int) -> None:
        a, b = root(i), root(j)
        if a != b:
            a, b = (a, b) if names[a] <= names[b] else (b, a)
            parent[b] = a

    of_id: dict[int, int] = {}
    for i, x in enumerate(ids):
        tie(of_id.setdefault(x, i), i)
    lengths = np.fromiter(map(len, sets), np.int64, n)
    member = np.repeat(np.arange(n), lengths)
    _, own = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(own, kind="stable")
    posting = member[order]
    times = np.bincount(own)
    start = np.cumsum(times) - times
    place = np.cumsum(lengths) - lengths

    def row(i: int) -> None:
        mine = own[place[i] : place[i] + lengths[i]]
        size = times[mine]
        where = np.repeat(start[mine] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        common = np.bincount(posting[where], minlength=n)
        for j in np.flatnonzero(100 * common >= similarity * (lengths + lengths[i] - common)):
            tie(i, int(j))

    central = np.argsort(-np.add.reduceat(times[own], place) / lengths, kind="stable")
    row(int(central[0]))
    done = {int(central[0])}
    while True:
        label = np.array([root(i) for i in range(n)])
        largest = np.bincount(label).argmax()
        # A link between two components has an end outside the largest one.
        outside = [int(i) for i in central if label[i] != largest and int(i) not in done]
        if not outside:
            return names[label]
        # A few at a time, as each may join the largest with many others.
        for i in outside[: max(1, len(outside) // 8)]:
            row(i)
            done.add(i)


def _resolved(docs: DataFrame, tied: DataFrame, size: int, similarity: int) -> DataFrame:
    """Exact components `node`, `component` of the classes in `tied` (`node`, `component`, `n_shingles`)."""
    groups = tied.groupBy("component").agg(F.sum("n_shingles").alias("n"))
    blocks = F.ceil(F.col("n") * 8 / F.lit(GROUP_BYTES)).cast("long")
    members = tied.select("node", "component").join(groups.select("component", blocks.alias("blocks")), "component")
    rows = docs.select(F.col("doc_id").cast("long").alias("node"), text_of(F.col("text")).alias("text")).join(members, "node")
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    # One task for a component of one block, else one for each two blocks.
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    schema = "node long, component long, one long, two long, data binary"

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 4 << 20):
            data = pa.array([s.tobytes() for s in shingle_sets(batch.column("text").to_pylist(), size)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("node", "component", "own", "blocks")), data], ["node", "component", "own", "blocks", "data"])

    with_sets = rows.select("node", "text", "component", own.alias("own"), "blocks").mapInArrow(sets, "node long, component long, own long, blocks long, data binary")
    spread = with_sets.select("*", other).select("node", "component", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "data")

    def resolve(table: pa.Table) -> pa.Table:
        data = [np.frombuffer(b, np.uint64) for b in table.column("data").to_pylist()]
        keep = [k for k, s in enumerate(data) if len(s)]
        ids = table.column("node").to_pylist()
        found = links_within([ids[k] for k in keep], [data[k] for k in keep], similarity) if keep else []
        return pa.table([pa.array([ids[k] for k in keep], pa.int64()), pa.array(found, pa.int64())], names=["node", "component"])

    links = spread.select(*[c.split()[0] for c in schema.split(", ")]).groupBy("component", "one", "two").applyInArrow(resolve, "node long, component long")
    links = links.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(links)


def near_duplicates(docs: DataFrame, size: int = 4, similarity: int = SIMILARITY) -> DataFrame:
    """`doc_id`, `text_hash`, `n_shingles`, `component_id` and `kept` of every row of `docs`."""
    scratch_root(docs.sparkSession)
    signed = _signed(docs, size).checkpoint()
    full = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = full.groupBy("key").agg(F.min("doc_id").alias("id"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n_shingles")).checkpoint()
    # Different sets of one id are one document too.
    tied = components(_ties(classes)).join(classes.groupBy(F.col("id").alias("node")).agg(F.sum("n_shingles").alias("n_shingles")), "node")
    linked = _resolved(docs, tied, size, similarity)
    of_key = classes.select("key", "id").join(linked, F.col("id") == F.col("node"), "left").select("key", F.coalesce("component", "id").alias("of_set"))
    # A document takes the component of its set; copies of a set meet here, so this is the join that a hot set skews.
    found = signed.drop("signature").join(of_key, "key", "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("of_set")).otherwise(F.col("doc_id"))
    out = found.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_first(docs: DataFrame, size: int = 5, similarity: int = SIMILARITY) -> DataFrame:
    """All columns of the row that stays of each near-duplicate group: the one with the smallest id, one of them if several rows have that id and text.

    Rows with a NULL id are linked with nothing and stay. Rows are told apart by id and text.
    """
    found = near_duplicates(docs, size, similarity).where("NOT kept").select(F.col("doc_id").alias("__gone_id"), F.col("text_hash").alias("__gone_hash")).distinct()
    marked = docs.withColumn("__id", F.col("doc_id").cast("long")).withColumn("__hash", F.xxhash64(text_of(F.col("text"))))
    kept = marked.join(found, (F.col("__id") == F.col("__gone_id")) & (F.col("__hash") == F.col("__gone_hash")), "left_anti")
    again = F.when(F.col("__id").isNull(), F.monotonically_increasing_id())
    return kept.withColumn("__again", again).dropDuplicates(["__id", "__hash", "text", "__again"]).drop("__id", "__hash", "__again")
