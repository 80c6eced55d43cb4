"""Secret scans with an incremental ledger of blobs.

A text version is a blob, addressed by the SHA-256 of its bytes. Rules come in packs with a version and a digest of the rules; a changed rule changes the digest,
and what the pack scanned before counts as missing. The ledger has a row for each (blob, pack) that was ever
scanned, with the spans found, also if there are none; a scan takes only the pairs that are missing and each distinct blob once, however many documents
hold it. Findings then go back to every document, or to every version of it, through the address.

The ledger is a stored table that only grows. `advance` scans what landed and is not in it, and appends the rows that it made. A batch that is scanned again after a
failure, or by two jobs at once, may leave a pair twice; both rows say the same, and `findings` takes their spans once.

Shuffles: one of the distinct unseen texts by address (copies meet inside each task first), one of the narrow rows (doc_id, address) against the findings.
Findings are an aggregate by address, so they join on a new expression of it: only between two plain shuffles can adaptive execution split the address that a third of
all rows may share.

Defined cases: NULL text is the empty blob and has no spans. Repeated rows and repeated ids give repeated results. Very long texts are one blob each, scanned as a whole
by one task. Empty tables give empty ledgers and results. Other columns stay with `redact` and are not read elsewhere; names that start with `__ledger` are reserved.
Offsets count code points, the end is exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from candor.llm.common import small_batches, text_of
from candor.operators.joins import fresh

LEDGER_SCHEMA = "blob string, pack string, rules string, spans array<struct<kind: string, start: int, end: int>>"


@dataclass(frozen=True)
class Rule:
    """Leftmost matches that don't overlap; a match counts if group `group` has at least `least` characters."""

    kind: str
    pattern: str
    least: int
    group: int = 0
    flags: int = 0


@dataclass(frozen=True)
class Pack:
    version: str
    rules: Sequence[Rule]

    @property
    def digest(self) -> str:
        """Address of the rules themselves: a scan by other rules under the same version doesn't count."""
        return hashlib.sha256(repr(tuple(self.rules)).encode()).hexdigest()[:16]


#: A private key from its first line to its END line; nothing between them has five dashes in a row. Without an END line, to the last of the header and base64 lines
#: that follow, or of long base64 runs in the same line. Line ends may be written as escapes, as in JSON.
_END_OF_LINE = r"(?:[ \t\"',]*(?:\r?\n|(?:\\++r)?\\++n))"
_PEM = (
    r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY(?: BLOCK)?-----"
    r"(?:(?:[^-]|-(?!----))*+-----END [A-Z ]{0,30}PRIVATE KEY(?: BLOCK)?-----"
    rf"|(?:{_END_OF_LINE}++[ \t>]*[A-Za-z][A-Za-z-]*:[ \t][^\n\\]*+)*+"
    rf"(?:(?:{_END_OF_LINE}++[ \t>\"']*|[ \t]+)[A-Za-z0-9+/]{{40,}}+=*+|{_END_OF_LINE}++[ \t>\"']*[A-Za-z0-9+/]++=*+(?=[ \t\"',;]*(?:[\r\n]|\\+[rn]|\Z)))*+)"
)
#: Fixed patterns.
BASE = Pack("base-1", (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, re.ASCII | re.IGNORECASE),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
))
MORE = Pack("more-1", (
    Rule("pem", _PEM, 1),
    Rule("forge", r"\b(?:ghp|gho|ghs|ghu|glpat)[_-][A-Za-z0-9_-]{20,}", 1, 0, re.ASCII),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 1, 0, re.ASCII),
    Rule("chat", r"\bxox[abprs]-[A-Za-z0-9-]{10,}", 1, 0, re.ASCII),
))
PACKS = (BASE, MORE)
#: Order of kinds that start at the same place.
KINDS = tuple(rule.kind for pack in PACKS for rule in pack.rules)


def scan_text(text: str, pack: Pack, compiled: dict[Rule, re.Pattern]) -> list[tuple[str, int, int]]:
    spans = []
    for rule in pack.rules:
        for m in compiled[rule].finditer(text):
            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                spans.append((rule.kind, m.start(), m.end()))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def _compiled(pack: Pack) -> dict[Rule, re.Pattern]:
    """Patterns of a pack. A lone run of a class is searched with its least length: its matches of that length are the same ones."""
    return {r: re.compile(r.pattern[:-1] + f"{{{r.least},}}" if re.fullmatch(r"\[[^\]]+\]\+", r.pattern) else r.pattern, r.flags) for r in pack.rules}


def blob_of(text: Column) -> Column:
    return F.sha2(text_of(text).cast("binary"), 256)


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER_SCHEMA)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at `path`; an empty one where none was written yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return empty_ledger(spark)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def advance(docs: DataFrame, path: str, packs: Sequence[Pack] = PACKS) -> DataFrame:
    """Scans the (blob, pack) pairs of `docs.text` that the ledger at `path` lacks, appends them, and returns the ledger as it is then.

    Rows appear in the ledger when the job commits, so a lost executor repeats tasks and a lost job repeats the batch.
    """
    spark = docs.sparkSession
    scan_unseen(docs, stored(spark, path), packs).write.mode("append").parquet(path)
    return stored(spark, path)


def _current(ledger: DataFrame, packs: Sequence[Pack]) -> DataFrame:
    """The rows of a ledger that the present rules of the packs have made. A ledger without digests has none."""
    if "rules" not in ledger.columns:
        return ledger.where(F.lit(False))
    return ledger.where(reduce(or_, [(F.col("pack") == p.version) & (F.col("rules") == p.digest) for p in packs], F.lit(False)))


def scan_unseen(docs: DataFrame, ledger: DataFrame | None = None, packs: Sequence[Pack] = PACKS) -> DataFrame:
    """The ledger rows of all (blob, pack) pairs of `docs.text` that `ledger` lacks."""
    blobs = docs.select(blob_of(F.col("text")).alias("blob"), text_of(F.col("text")).alias("text"))
    unseen = blobs.groupBy("blob").agg(F.first("text").alias("text"))
    if ledger is None:
        unseen = unseen.withColumn("seen", F.array().cast("array<string>"))
    else:
        done = _current(ledger, packs).groupBy("blob").agg(F.collect_set("pack").alias("seen"))
        missing = F.array(*[F.lit(p.version) for p in packs])
        unseen = unseen.join(done, "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
        unseen = unseen.where(F.size(F.array_except(missing, "seen")) > 0)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = {p.version: _compiled(p) for p in packs}
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in small_batches(batches, "text", 2 << 20):
            out: tuple[list, list, list, list] = ([], [], [], [])
            for blob, text, seen in zip(*(batch.column(c).to_pylist() for c in ("blob", "text", "seen"))):
                for pack in packs:
                    if pack.version not in seen:
                        spans = scan_text(text, pack, compiled[pack.version])
                        for column, value in zip(out, (blob, pack.version, pack.digest, [dict(zip(("kind", "start", "end"), s)) for s in spans])):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string()), pa.array(out[3], kind)], ["blob", "pack", "rules", "spans"])

    return unseen.select("blob", "text", "seen").mapInArrow(scan, LEDGER_SCHEMA)


def findings(ledger: DataFrame, packs: Sequence[Pack] = PACKS) -> DataFrame:
    """Per blob, the spans of the given packs in order of their start."""
    order = F.array(*[F.lit(k) for k in KINDS])
    ranked = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    found = _current(ledger, packs).groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list(ranked))).alias("spans"))
    return found.select("blob", F.transform(F.sort_array("spans"), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))


def locate(docs: DataFrame, ledger: DataFrame, packs: Sequence[Pack] = PACKS, path: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The `path` columns, `blob` and `spans` of every row of `docs`, from a ledger that covers its blobs. Rows may be versions of a document: name what tells them apart in `path`."""
    rows = docs.select(*path, blob_of(F.col("text")).alias("blob"))
    found = findings(ledger, packs).select(fresh(F.col("blob")).alias("__ledger_blob"), F.col("spans").alias("__ledger_spans"))
    spans = F.coalesce("__ledger_spans", F.array().cast("array<struct<kind: string, start: int, end: int>>"))
    return rows.join(found, F.col("blob") == F.col("__ledger_blob"), "left").select(*path, "blob", spans.alias("spans"))


def mask_text(text: str, spans: Sequence[tuple[int, int]], mask: str = "[secret]") -> str:
    """The text with every span, or run of spans that overlap, replaced by `mask`. Spans are in order of their start."""
    out, at = [], 0
    for start, end in spans:
        if start >= at:
            out += (text[at:start], mask)
        at = max(at, end)
    return "".join([*out, text[at:]])


@F.pandas_udf(StringType())
def _masked(text: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
    return pd.Series([None if a is None else mask_text(t, list(zip(a, b))) for t, a, b in zip(text, starts, ends)], dtype=object)


def redact(docs: DataFrame, ledger: DataFrame, packs: Sequence[Pack] = PACKS) -> DataFrame:
    """All rows and columns of `docs`, with the secrets in `text` masked. Texts without one are unchanged, NULL stays NULL.

    Only texts with spans are sent to Python.
    """
    found = findings(ledger, packs).where(F.size("spans") > 0).select(fresh(F.col("blob")).alias("__ledger_blob"), F.col("spans").alias("__ledger_spans"))
    joined = docs.withColumn("__ledger_own", blob_of(F.col("text"))).join(found, F.col("__ledger_own") == F.col("__ledger_blob"), "left")
    hit = F.col("__ledger_spans").isNotNull()
    masked = _masked(F.when(hit, F.col("text")), F.col("__ledger_spans.start"), F.col("__ledger_spans.end"))
    return joined.withColumn("text", F.when(hit, masked).otherwise(F.col("text"))).select(*docs.columns)
