"""Benchmark decontamination: every passage of every document queries a BM25 index of the test items with block-max pruning.

Index. Items are cut into segments of at most CHUNK words, the documents of the index. A posting is the BM25 weight of a term in a segment, divided by
the sum of the weights of the segment: a passage that holds all terms of a segment scores 1. Segments form blocks, and for each term and block the largest
weight is kept.

Query. A document is cut into chunks of CHUNK words and a passage is two chunks that follow each other, so each segment that occurs in a document lies
whole in a passage. The block maxima of the terms of a passage bound the score of every segment of a block; blocks below the threshold are passed over for
all passages at once. In the others a document-at-a-time search with pivots (WAND) finds every segment at or above the threshold, not only the best.

Check. An item found is contamination if word trigrams of its question and of its answer occur in the document around one of the passages that found it, at least
QUESTION_SHARE and ANSWER_SHARE of them; every passage found is checked. Items have `question` and `answer`; for items of one text, `split_item` takes its last sentence as the answer.

Scale. Documents are only mapped, nothing is shuffled. The items are a stated query set: they are taken GROUP items at a time, one pass over the
documents each, so an index in a task never holds more; document frequencies are those of its group.

Defined cases: NULL and empty texts match nothing; items without words are left out; NULL item ids are kept as NULL. Repeated rows are judged each for itself.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candor.llm.common import small_batches
from candor.session import scratch_path

CHUNK = 64
BLOCKS = 64
THRESHOLD = 0.6
QUESTION_SHARE, ANSWER_SHARE = 0.7, 0.5
GRAM = 3
GROUP = 5000
K1, B = 1.2, 0.75
SCHEMA = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
_TOKEN = re.compile(r"[^\W_]+")


def words_in(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of an item that is one text: its last sentence answers, or its last quarter if it is only one sentence."""
    cut = max((m.end() for m in re.finditer(r"[.!?]\s+|\n", text.rstrip())), default=0)
    if not cut or not words_in(text[:cut]) or not words_in(text[cut:]):
        places = [m.start() for m in _TOKEN.finditer(text)]
        cut = places[-max(1, len(places) // 4)] if len(places) > 1 else 0
    return (text[:cut], text[cut:]) if cut else (text, text)


def grams(words: list[str]) -> set[tuple[str, ...]]:
    n = min(GRAM, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


@dataclass
class Item:
    item_id: int | None
    length: int
    question: set
    answer: set


@dataclass
class Statistics:
    """What weights depend on besides the segment itself. It covers all items, so an item scores alike whichever index it is in."""

    segments: int
    mean_length: float
    frequency: dict[str, int]


def segments_of(question: str, answer: str) -> list[list[str]]:
    """The words of an item in segments of about equal length, at most CHUNK words each."""
    q, a = words_in(question), words_in(answer)
    # An item of one part has it as question and as answer.
    both = q if question == answer else q + a
    pieces = -(-len(both) // CHUNK)
    size = -(-len(both) // max(1, pieces))
    return [both[k * size : (k + 1) * size] for k in range(pieces)]


def statistics_of(items: list[tuple[int | None, str, str]]) -> Statistics:
    found = [s for _, question, answer in items for s in segments_of(question, answer)]
    return Statistics(len(found), sum(map(len, found)) / max(1, len(found)), Counter(t for s in found for t in set(s)))


class BlockMaxIndex:
    def __init__(self, items: list[tuple[int | None, str, str]], statistics: Statistics | None = None) -> None:
        """statistics: of all items, where these are only some of them."""
        known = statistics or statistics_of(items)
        self.items: list[Item] = []
        segments: list[list[str]] = []
        self.owner: list[int] = []
        for item_id, question, answer in items:
            own = segments_of(question, answer)
            if not own:
                continue
            segments += own
            self.owner += [len(self.items)] * len(own)
            q, a = words_in(question), words_in(answer)
            self.items.append(Item(item_id, sum(map(len, own)), grams(q or a), grams(a or q)))
        self.term: dict[str, int] = {}
        postings: list[list[tuple[int, float]]] = []
        for k, segment in enumerate(segments):
            weight = {}
            for t, tf in Counter(segment).items():
                idf = np.log(1 + (known.segments - known.frequency[t] + 0.5) / (known.frequency[t] + 0.5))
                weight[t] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(segment) / known.mean_length))
            total = sum(weight.values())
            for t, w in weight.items():
                at = self.term.setdefault(t, len(postings))
                if at == len(postings):
                    postings.append([])
                postings[at].append((k, w / total))
        self.postings = postings
        self.block = max(1, -(-len(segments) // BLOCKS))
        self.maxima = np.zeros((len(postings), -(-len(segments) // self.block)), np.float32)
        for t, row in enumerate(postings):
            for k, w in row:
                self.maxima[t, k // self.block] = max(self.maxima[t, k // self.block], w)

    def search(self, terms: list[int], block: int, threshold: float) -> list[tuple[int, float]]:
        """All segments of a block that reach the threshold, by WAND over the postings of the distinct terms."""
        low, high = block * self.block, (block + 1) * self.block
        lists = []
        for t in terms:
            row = [p for p in self.postings[t] if low <= p[0] < high]
            if row:
                lists.append([row, 0, max(w for _, w in row)])
        found = []
        while lists:
            lists.sort(key=lambda x: x[0][x[1]][0])
            bound, pivot = 0.0, None
            for x in lists:
                bound += x[2]
                if bound >= threshold:
                    pivot = x[0][x[1]][0]
                    break
            if pivot is None:
                break
            if lists[0][0][lists[0][1]][0] == pivot:
                score = 0.0
                for x in lists:
                    if x[0][x[1]][0] != pivot:
                        break
                    score += x[0][x[1]][1]
                    x[1] += 1
                if score >= threshold:
                    found.append((pivot, score))
            else:
                for x in lists:
                    if x[0][x[1]][0] >= pivot:
                        break
                    while x[1] < len(x[0]) and x[0][x[1]][0] < pivot:
                        x[1] += 1
            lists = [x for x in lists if x[1] < len(x[0])]
        return found

    def matches(self, texts: list[str], threshold: float = THRESHOLD) -> Iterator[tuple[int, int | None, float, float, float]]:
        """(row, item id, score, question overlap, answer overlap) of each item found in each text."""
        tokens = [words_in(t) for t in texts]
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        chunks = -(-lengths // CHUNK)
        first_chunk = np.cumsum(chunks) - chunks
        n_chunks = int(chunks.sum())
        if not n_chunks or not self.items:
            return
        terms = np.fromiter(map(self.term.get, chain.from_iterable(tokens), repeat(-1)), np.int64, int(lengths.sum()))
        place = np.arange(len(terms)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        chunk = np.repeat(first_chunk, lengths) + place // CHUNK
        known = terms >= 0
        keys = np.unique(chunk[known] * len(self.postings) + terms[known])
        if not len(keys):
            return
        chunk, terms = np.divmod(keys, len(self.postings))
        starts = np.flatnonzero(np.diff(chunk, prepend=-1))
        bound = np.zeros((n_chunks + 1, self.maxima.shape[1]), np.float32)
        bound[chunk[starts]] = np.add.reduceat(self.maxima[terms], starts)
        row_of = np.repeat(np.arange(len(texts)), chunks)
        follows = np.append(row_of[1:] == row_of[:-1], False)
        passage = bound[:-1] + bound[1:] * follows[:, None]
        # Bounds are sums of 32-bit floats; the margin keeps them bounds.
        places: dict[tuple[int, int], dict[int, float]] = {}
        edge = np.append(starts, len(chunk))
        at_chunk = dict(zip(chunk[starts].tolist(), range(len(starts))))
        for c, block in zip(*(x.tolist() for x in np.nonzero(passage >= threshold - 1e-4))):
            own: set[int] = set()
            for d in (c, c + 1)[: 1 + bool(follows[c])]:
                if (k := at_chunk.get(d)) is not None:
                    own.update(terms[edge[k] : edge[k + 1]].tolist())
            row = int(row_of[c])
            for segment, score in self.search(sorted(own), block, threshold):
                at = places.setdefault((row, self.owner[segment]), {})
                at[c - int(first_chunk[row])] = max(score, at.get(c - int(first_chunk[row]), 0.0))
        for (row, item_at), at in sorted(places.items()):
            item, words = self.items[item_at], tokens[row]
            windows = [(max(0, c * CHUNK - item.length), min(len(words), (c + 2) * CHUNK + item.length)) for c in sorted(at)]
            shares = zip(*(_shares(words, part, windows) for part in (item.question, item.answer)))
            # A place that passes goes before one that doesn't, then the higher score, then the earlier place.
            _, score, _, found = max((contaminated(*found), at[c], -c, found) for c, found in zip(sorted(at), shares))
            yield row, item.item_id, score, *found


def _shares(words: list[str], part: set, windows: list[tuple[int, int]]) -> list[float]:
    """For each window of the words, which are in order, the share of the grams of `part` that it holds. Each word is looked at once, however many windows hold it."""
    n = len(next(iter(part)))
    inside: Counter[tuple[str, ...]] = Counter()
    known: deque[tuple[int, tuple[str, ...]]] = deque()
    out, at = [], 0
    for low, high in windows:
        for i in range(max(at, low), high - n + 1):
            if (gram := tuple(words[i : i + n])) in part:
                known.append((i, gram))
                inside[gram] += 1
        at = max(at, high - n + 1)
        while known and known[0][0] < low:
            gram = known.popleft()[1]
            inside[gram] -= 1
            if not inside[gram]:
                del inside[gram]
        out.append(len(inside) / len(part))
    return out


def contaminated(question: float, answer: float) -> bool:
    return question >= QUESTION_SHARE and answer >= ANSWER_SHARE


def _texts(rows: list) -> list[tuple[int | None, str, str]]:
    """(item id, question, answer) of rows with `question` and `answer`, or with `text`."""
    return [(r[0], *((r[1] or "", r[2] or "") if len(r) == 3 else split_item(r[1] or ""))) for r in rows]


def statistics(items: DataFrame) -> tuple[DataFrame, int, float]:
    """Document frequencies over all items of the terms of each group (`part`, `term`, `frequency`), the number of segments and their mean length."""

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in batch.schema.names]
            found = [(g, s) for g, item in zip(columns[0], _texts(list(zip(*columns[1:])))) for s in segments_of(*item[1:])]
            # The length is counted once per segment, at its first term.
            rows = [(g, t, 0 if k else len(s), not k) for g, s in found for k, t in enumerate(set(s))]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(list(zip(*rows)) or [()] * 4, kinds)], ["part", "term", "words", "first"])

    path = scratch_path(items.sparkSession, "item_terms")
    items.mapInArrow(terms, "part long, term string, words long, first boolean").write.parquet(path)
    rows = items.sparkSession.read.parquet(path)
    total = rows.agg(F.count_if("first").alias("segments"), F.sum("words").alias("words")).first()
    frequency = rows.groupBy("term").agg(F.count("*").alias("frequency"))
    return rows.select("part", "term").distinct().join(frequency, "term"), total.segments, (total.words or 0) / max(1, total.segments)


def indexes(items: DataFrame) -> Iterator[BlockMaxIndex]:
    """Indexes of at most about GROUP items each, from `item_id` with `question` and `answer`, or with `text`. Weights are those of all items together."""
    groups = -(-items.count() // GROUP)
    if not groups:
        return
    parts = ["question", "answer"] if "question" in items.columns else ["text"]
    rows = items.select(F.pmod(F.xxhash64("item_id", *parts), F.lit(groups)).alias("_part"), "item_id", *parts)
    frequencies, segments, mean = statistics(rows)
    for g in range(groups):
        # One group of the stated query set at a time.
        texts = _texts(rows.where(F.col("_part") == g).select("item_id", *parts).collect())
        known = {r.term: r.frequency for r in frequencies.where(F.col("part") == g).collect()}
        yield BlockMaxIndex(sorted(texts, key=lambda t: (t[0] is not None, t[0] or 0, t[1:])), Statistics(segments, mean, known))


def find(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """A row for each document and item whose question and answer both occur in it."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))

    def scan(index: BlockMaxIndex) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in small_batches(batches, "text", 4 << 20):
                ids = batch.column("doc_id").to_pylist()
                texts = [t or "" for t in batch.column("text").to_pylist()]
                found = [(ids[i], *rest) for i, *rest in index.matches(texts, threshold) if contaminated(*rest[-2:])]
                columns = list(zip(*found)) or [()] * 5
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in SCHEMA.split(", ")])

        return rows.mapInArrow(run, SCHEMA)

    scans = [scan(index) for index in indexes(items)]
    return reduce(DataFrame.unionAll, scans) if scans else rows.sparkSession.createDataFrame([], SCHEMA)


def remove(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All rows and columns of `docs` but the contaminated rows. Row by row, so ids may be NULL or repeat."""
    for index in indexes(items):

        def run(batches: Iterator[pa.RecordBatch], index: BlockMaxIndex = index) -> Iterator[pa.RecordBatch]:
            for batch in small_batches(batches, "text", 4 << 20):
                bad = {i for i, *rest in index.matches([t or "" for t in batch.column("text").to_pylist()], threshold) if contaminated(*rest[-2:])}
                yield batch.filter(pa.array([i not in bad for i in range(batch.num_rows)])) if bad else batch

        docs = docs.mapInArrow(run, docs.schema)
    return docs
