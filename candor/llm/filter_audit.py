"""How filters act together: what each one removes in every order of application, from decision diagrams of their failures.

Every document has a mask with one bit per filter that it fails. Per part (a group of documents, such as a language) the masks and their counts become a
zero-suppressed decision diagram: a node asks one filter, its branches lead to what passes and what fails, a node whose failing branch is empty is left out,
and every node carries the counts below it. The path on which all filters pass, followed in the diagram's own order, gives the steps of that order: the
failing branch next to the path is what the filter removes there. All other orders follow by swapping two neighbouring levels at a time, each swap changing
only the nodes of the upper level.

Masks are counted before anything is grouped by part, so a diagram is made from at most 2^n rows however many documents a part has. The number of orders
is n!, so n should stay below about eight.

Defined cases: a NULL text is the empty text: too short, and identical to other empty texts. A NULL language is the part ''. A document without an id is identical to nothing and has
no labels; ids that repeat are documents of their own, and none of them is smaller than the other. A label counts if any label row of that id has it. An empty table has no parts and no rows. Texts of any length are read
whole, a few megabytes of words at a time. Other columns are not read, whatever their names. Identity of texts is decided by SHA-256.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candor.llm.common import small_batches, text_of
from candor.session import scratch_path

#: The filters of `failures`, in the order of their bits.
FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT = 200, 50, 3
SYMBOLS = "[#$%&*|]"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
SCHEMA = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"

#: Words are taken from runs of so many bytes, each to the end of its last word.
_RUN = re.compile(rb"(?s).{1,4194304}[^\x20\x09-\x0D]*")


def _words(text: bytes) -> tuple[int, int]:
    """Words and distinct words."""
    n, distinct = 0, set()
    for run in _RUN.finditer(text):
        # Of bytes, exactly the six white-space characters are separators.
        words = run[0].split()
        n += len(words)
        distinct.update(words)
    return n, len(distinct)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        texts = batch.column("text")
        masks, digests = [], []
        for text, n_chars, symbols in zip(texts.cast(pa.binary()), pc.utf8_length(texts).to_pylist(), pc.match_substring_regex(texts, SYMBOLS).to_pylist()):
            raw = text.as_py()
            n_words, n_distinct = _words(raw)
            capitals = len(raw) - len(raw.translate(None, CAPITALS))
            fails = (n_words < MIN_WORDS, 100 * n_distinct < MIN_DISTINCT_PERCENT * n_words, 100 * capitals > MAX_CAPITAL_PERCENT * n_chars, symbols)
            masks.append(sum(1 << i for i, fail in enumerate(fails) if fail))
            digests.append(hashlib.sha256(raw).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), pa.array(digests, pa.binary()), pa.array(masks, pa.int32())], ["doc_id", "part", "digest", "mask"]
        )


def failures(docs: DataFrame) -> DataFrame:
    """`doc_id`, `part` and `mask`, the failed filters of each document, from `doc_id`, `lang`, `text`.

    Texts are read once; what is shuffled is a short row per document. Each text's smallest id meets the documents by text and id together, so that a
    text with very many copies is spread.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text_of(F.col("text")).alias("text"))
    path = scratch_path(spark, "filter_masks")
    rows.mapInArrow(_measured, "doc_id long, part string, digest binary, mask int").write.parquet(path)
    measured = spark.read.parquet(path)
    # A new key expression, so that both sides of the join are plain shuffles and a hot id can be split.
    first = measured.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("first")).select(F.concat("digest", F.lit(b"")).alias("digest"), "first")
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    joined = measured.join(first, (measured["digest"] == first["digest"]) & (F.col("doc_id") == F.col("first")), "left")
    return joined.select("doc_id", "part", (F.col("mask") + F.when(copy, 1 << FILTERS.index("E")).otherwise(0)).alias("mask"))


def counted(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """`part`, `mask` and how many documents have it: all, good ones and toxic ones. `labels`: `doc_id`, `quality`, `toxic`."""
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad"))
    # As above: ids by an expression of their own, for a hot id among the documents.
    marks = marks.select((F.col("id") + F.lit(0).cast("long")).alias("id"), "good", "bad")
    marked = failed.join(marks, F.col("doc_id") == F.col("id"), "left")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return marked.groupBy("part", "mask").agg(F.count("*").alias("n"), total("good").alias("good"), total("bad").alias("toxic"))


Counts = tuple[int, ...]


class Diagram:
    """A zero-suppressed decision diagram over failure masks with counts, in an order of filters that neighbouring swaps change."""

    def __init__(self, masks: dict[int, Counts], n_filters: int) -> None:
        self.order = list(range(n_filters))
        self.zero: Counts = tuple(0 for _ in next(iter(masks.values()), ()))
        # Node 0 is the empty set. A node is [filter, node if it passes, node if it fails]; a leaf has counts only.
        self.nodes: list[list[int] | None] = [None]
        self.counts: list[Counts] = [self.zero]
        self.known: list[dict[tuple[int, int], int]] = [{} for _ in self.order]
        self.root = self._build(masks, 0)

    def _build(self, masks: dict[int, Counts], level: int) -> int:
        if not masks:
            return 0
        if level == len(self.order):
            (counts,) = masks.values()
            return self._add(None, counts)
        bit = 1 << self.order[level]
        passing, failing = ({m: c for m, c in masks.items() if bool(m & bit) == fails} for fails in (False, True))
        return self._node(self.order[level], self._build(passing, level + 1), self._build(failing, level + 1))

    def _add(self, node: list[int] | None, counts: Counts) -> int:
        self.nodes.append(node)
        self.counts.append(counts)
        return len(self.nodes) - 1

    def _node(self, name: int, passes: int, fails: int) -> int:
        if not fails:
            return passes
        found = self.known[name].get((passes, fails))
        if found is None:
            found = self._add([name, passes, fails], tuple(map(sum, zip(self.counts[passes], self.counts[fails]))))
            self.known[name][passes, fails] = found
        return found

    def _branches(self, at: int, name: int) -> tuple[int, int]:
        node = self.nodes[at]
        return (node[1], node[2]) if node and node[0] == name else (at, 0)

    def swap(self, level: int) -> None:
        """Exchanges the filters of a level and the next one. A changed node keeps its place, so nothing above it has to change."""
        upper, lower = self.order[level : level + 2]
        self.order[level : level + 2] = lower, upper
        for (passes, fails), at in list(self.known[upper].items()):
            (pp, pf), (fp, ff) = self._branches(passes, lower), self._branches(fails, lower)
            if pf or ff:
                del self.known[upper][passes, fails]
                branches = self._node(upper, pp, fp), self._node(upper, pf, ff)
                self.nodes[at] = [lower, *branches]
                self.known[lower][branches] = at
        self._forget()

    def _forget(self) -> None:
        """Nodes that nothing leads to any more go from the tables."""
        reached, ahead = set(), [self.root]
        while ahead:
            at = ahead.pop()
            if at not in reached and self.nodes[at]:
                reached.add(at)
                ahead.extend(self.nodes[at][1:])
        for table in self.known:
            for key in [k for k, at in table.items() if at not in reached]:
                del table[key]

    def steps(self) -> list[tuple[int, Counts, Counts]]:
        """Filter, counts removed and counts kept, along the path on which all pass."""
        at, out = self.root, []
        for name in self.order:
            at, fails = self._branches(at, name)
            out.append((name, self.counts[fails], self.counts[at]))
        return out


def neighbour_swaps(n: int) -> Iterator[int]:
    """Levels to swap one after the other so that every order of n filters comes up once: the last one wanders through each order of the others."""
    if n < 2:
        return
    inner, down = neighbour_swaps(n - 1), True
    while True:
        yield from (range(n - 2, -1, -1) if down else range(n - 1))
        step = next(inner, None)
        if step is None:
            return
        # At the front it shifts the others by one.
        yield step + 1 if down else step
        down = not down


def audit_part(masks: dict[int, Counts], names: str) -> list[tuple]:
    """Rows of one part without its name, from (all, good, toxic) counts per mask."""
    diagram = Diagram(masks, len(names))
    orders = [(tuple(diagram.order), diagram.steps())]
    for level in neighbour_swaps(len(names)):
        diagram.swap(level)
        orders.append((tuple(diagram.order), diagram.steps()))
    # Alone at the front a filter removes all that fail it, at the end what only it removes.
    fails = {path[0][0]: path[0][1][0] for _, path in orders}
    alone = {path[-1][0]: path[-1][1][0] for _, path in orders}
    shapley = [sum(removed[0] for _, path in orders for name, removed, _ in path if name == i) for i in range(len(names))]
    return [
        ("".join(names[i] for i in order), step, kept[0], removed[0], fails[name] - removed[0], alone[name], removed[1], removed[2], shapley[name])
        for order, path in orders
        for step, (name, removed, kept) in enumerate(path, 1)
    ]


def audit(masks: DataFrame, names: str = FILTERS) -> DataFrame:
    """All steps of all orders per part, from `part`, `mask`, `n`, `good`, `toxic`."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        counts = {int(m): (int(n), int(g), int(t)) for m, n, g, t in zip(rows["mask"], rows["n"], rows["good"], rows["toxic"])}
        out = pd.DataFrame(audit_part(counts, names), columns=[c.split()[0] for c in SCHEMA.split(", ")][1:])
        out.insert(0, "part", rows["part"].iloc[0])
        return out

    return masks.groupBy("part").applyInPandas(run, SCHEMA)
