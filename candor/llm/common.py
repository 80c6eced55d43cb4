"""Helpers that several operators of the pipeline share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word in the contracts of these operators: a run of anything but these six white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: Python tasks look at about this many bytes of text at a time, whatever the size of the Arrow batches.
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """The quarter of the documents that no model here learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def words_of(text: Column) -> Column:
    """Words of a text as an array; none for NULL."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def text_of(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


#: What a Python worker keeps from task to task: one object, of the operator that ran last.
_KEPT: dict[str, object] = {}


def kept_in_worker(name: str, build: Callable[[], object]):
    """The object of that name, built if this worker does not have it. All others go."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = build()
    return _KEPT[name]


def small_batches(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES, keep: str = "") -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches into runs of rows whose texts hold about `limit` bytes; a longer text is a batch of its own.

    First drops what the worker still keeps from other operators than `keep`.
    """
    if keep not in _KEPT:
        _KEPT.clear()
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = size = 0
        for i, n in enumerate(lengths):
            if size and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if batch.num_rows > start:
            yield batch.slice(start)


class Memo:
    """Bounded memory of a function of short strings, filled for many strings at once.

    Entries are of two ages. When `limit` young ones are there they become the old ones, and old ones that nobody asked for since then go; that costs time
    but never changes a value.
    """

    def __init__(self, compute: Callable[[list[str]], list[bytes]], limit: int = 250_000) -> None:
        self.compute, self.limit = compute, limit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def values(self, keys: list[str]) -> list[bytes]:
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        found = list(map(young.get, keys))
        missing = {keys[i] for i, v in enumerate(found) if v is None}
        if missing:
            for k in missing & old.keys():
                young[k] = old[k]
            fresh = [k for k in missing if k not in old]
            young.update(zip(fresh, self.compute(fresh)))
            found = [young[keys[i]] if v is None else v for i, v in enumerate(found)]
        return found

    def joined(self, rows: list[list[str]]) -> list[bytes]:
        """For each row the values of its strings, one after the other."""
        found = self.values([k for row in rows for k in row])
        at, out = 0, []
        for row in rows:
            out.append(b"".join(found[at : at + len(row)]))
            at += len(row)
        return out
