"""Language identification in two steps: the family first, then one-versus-one linear support vector machines inside it.

Features are the relative frequencies of hashed byte trigrams of the whole lower-cased text, so a linear score is the mean weight of its trigrams: a task
looks each trigram up once per machine and never builds a feature vector. Training takes at most `per_language` labelled documents of each language, chosen
by a hash of their id; only their features that are not zero (6 bytes each) reach the driver. It holds them as one table of 16 KB a document and, while a machine
is trained, one copy of the rows that this machine compares.

Evidence. The scores of the machines compare the learned languages with each other only, so their largest is never small. Whether a text is in any of them is
told by its fit: the mean over its trigrams of the log of their share in the language found, against an even share. A text whose fit stays below LEAST_FIT, two
standard errors allowed, is in no learned language: `lang_pred` is still the nearest one, but its score is 0.

Defined cases: NULL text, or text without a letter, is `und` with score 0. NULL languages are not learned from; with one language learned every
text with a letter gets it, with none `und`. Rows are independent; ties go to the language that comes first in alphabetic order. Columns other than
`doc_id`, `text` and, for training, `lang` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candor.llm.common import held_out, small_batches

BUCKETS = 4096
PER_LANGUAGE = 1000
UNKNOWN = "und"
#: Held-out labelled documents lie above 1, sentences of languages that were not learned and random letters below 0, but for near relations (Portuguese for Spanish).
LEAST_FIT = 0.4
#: Part of an even distribution in the shares of a language, for trigrams that its sample lacks.
EVEN = 0.1

#: Fixed: families of language codes. A code that isn't listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "tt"),
    "indo-aryan": ("hi", "ur", "bn", "mr", "ne", "gu", "pa"),
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}


def _fold_table() -> np.ndarray:
    """Bytes to features: ASCII letters in lower case, other ASCII to space, the rest as it is."""
    fold = np.arange(256, dtype=np.uint8)
    fold[:128] = 32
    for b in range(ord("a"), ord("z") + 1):
        fold[b] = fold[b - 32] = b
    return fold


FOLD = _fold_table()


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all trigrams of the texts, each text between two spaces, and the first and last position of each text."""
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" " + b"  ".join(encoded) + b" ", np.uint8)
    lengths = np.fromiter(map(len, encoded), np.int64, len(encoded)) + 2
    ends = np.cumsum(lengths)
    folded = FOLD[data]
    # Capital letters of Latin-1 are the byte 0xC3 and one 32 below their small letter.
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    capital = after[(data[after] >= 0x80) & (data[after] <= 0x9E)]
    folded[capital] += 32
    a, b, c = folded[:-2].astype(np.uint32), folded[1:-1].astype(np.uint32), folded[2:].astype(np.uint32)
    buckets = ((a << 16 | b << 8 | c) * np.uint32(2654435761)) >> np.uint32(20)
    return buckets.astype(np.uint16), ends - lengths, ends - 2


def frequencies(texts: list[str]) -> np.ndarray:
    buckets, first, last = trigrams(texts)
    out = np.zeros((len(texts), BUCKETS), np.float32)
    for i, (s, e) in enumerate(zip(first, last)):
        if e > s:
            out[i] = np.bincount(buckets[s:e], minlength=BUCKETS) / (e - s)
    return out


#: A feature that is not zero, with its bucket counted from the last one. Rows of these, by ascending bucket, have as bytes the order of the whole vectors as bytes.
FEATURE = np.dtype([("from_last", ">u2"), ("share", "<f4")])
#: Rows of a table that are looked at together where a copy of all of them is not wanted.
ROWS = 256


def packed(vector: np.ndarray) -> bytes:
    """The features of a vector that are not zero."""
    at = np.flatnonzero(vector)
    out = np.empty(len(at), FEATURE)
    out["from_last"], out["share"] = len(vector) - 1 - at, vector[at]
    return out.tobytes()


def unpacked(rows: list[bytes]) -> np.ndarray:
    """The vectors of `packed` rows, as one table."""
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for vector, row in zip(x, rows):
        features = np.frombuffer(row, FEATURE)
        vector[BUCKETS - 1 - features["from_last"].astype(np.int64)] = features["share"]
    return x


def train_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, steps: int = 100, rows: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, by accelerated gradient steps. y is 1 or -1; classes weigh the same.

    `rows`: those of `x` that `y` speaks of, all by default. They are copied once.
    """
    rows = np.arange(len(x)) if rows is None else rows
    y = y.astype(np.float32)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    squares = np.empty(len(rows), x.dtype)
    for s in range(0, len(rows), ROWS):
        part = x[rows[s : s + ROWS]]
        squares[s : s + ROWS] = np.einsum("ij,ij->i", part, part)
    scale = np.float32(1 / max(1e-9, float(np.sqrt(weight @ squares))))
    table = np.empty((len(rows), x.shape[1] + 1), np.float32)
    for s in range(0, len(rows), ROWS):
        table[s : s + ROWS, :-1] = x[rows[s : s + ROWS]] * scale
    table[:, -1] = 1
    x = table
    step, penalty = np.float32(1 / (4 + penalty)), np.float32(penalty)
    w = v = np.zeros(x.shape[1], np.float32)
    for k in range(steps):
        slack = np.maximum(0, 1 - y * (x @ v))
        fresh = v + step * (2 * ((weight * y * slack) @ x) - penalty * v)
        v = fresh + np.float32(k / (k + 3)) * (fresh - w)
        w = fresh
    return w[:-1] * scale, float(w[-1])


def fit(logs: np.ndarray) -> float:
    """The mean of the log shares of a text's trigrams and two standard errors: what its language can at best be taken to give."""
    return float(logs.mean() + 2 * logs.std() / np.sqrt(len(logs))) if len(logs) else -np.inf


@dataclass
class Machine:
    first: str
    second: str
    weights: np.ndarray
    bias: float


@dataclass
class Model:
    """families: the languages of each; machines decide between two families, or between two languages of one family. usual: per language the log shares of trigrams."""

    families: dict[str, list[str]]
    between: list[Machine]
    within: dict[str, list[Machine]]
    usual: dict[str, np.ndarray]

    @classmethod
    def fit(cls, x: np.ndarray, langs: list[str], family: Mapping[str, str] = FAMILY) -> Model:
        langs_array = np.array(langs, dtype=object)
        families: dict[str, list[str]] = {}
        for code in sorted(set(langs)):
            families.setdefault(family.get(code, code), []).append(code)
        families = dict(sorted(families.items()))

        def machine(a: str, b: str, in_a: np.ndarray, in_b: np.ndarray) -> Machine:
            rows = np.flatnonzero(in_a | in_b)
            return Machine(a, b, *train_svm(x, np.where(in_a[rows], 1.0, -1.0), rows=rows))

        members = {f: np.isin(langs_array, codes) for f, codes in families.items()}
        between = [machine(f, g, members[f], members[g]) for f, g in combinations(families, 2)]
        within = {f: [machine(a, b, langs_array == a, langs_array == b) for a, b in combinations(codes, 2)] for f, codes in families.items()}
        usual = {code: np.log((1 - EVEN) * BUCKETS * x[langs_array == code].mean(axis=0, dtype=np.float64) + EVEN) for code in sorted(set(langs))}
        return cls(families, between, within, usual)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        buckets, first, last = trigrams(texts)
        cuts = np.ravel(np.column_stack([first, last]))
        # The last two trigrams of a text reach into the next one; every second sum holds only those.
        cuts = np.minimum(cuts, max(0, len(buckets) - 1))
        n = np.maximum(1, last - first)

        def margins(machines: list[Machine], names: list[str]) -> np.ndarray:
            out = np.zeros((len(texts), len(names)))
            for m in machines:
                value = np.add.reduceat(m.weights.astype(np.float64)[buckets], cuts)[::2] / n + m.bias
                out[:, names.index(m.first)] += value
                out[:, names.index(m.second)] -= value
            return out

        def chosen(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            best = scores.argmax(axis=1)
            power = np.exp(2 * (scores - scores.max(axis=1, keepdims=True)))
            return best, power[np.arange(len(best)), best] / power.sum(axis=1)

        names = list(self.families)
        family, sure = chosen(margins(self.between, names))
        langs, score = np.empty(len(texts), dtype=object), np.zeros(len(texts))
        for k, name in enumerate(names):
            rows = np.flatnonzero(family == k)
            best, inside = chosen(margins(self.within[name], self.families[name])[rows])
            langs[rows] = np.array(self.families[name], dtype=object)[best]
            score[rows] = sure[rows] * inside
        for i, (s, e) in enumerate(zip(first, last)):
            if fit(self.usual[langs[i]][buckets[s:e]]) < LEAST_FIT:
                score[i] = 0
        return list(langs), score


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """Fits on at most about `per_language` documents of each language that are not held out; None without labelled documents."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(v) for code, n in counts.items() for v in (code, min(1.0, per_language / n))])[F.col("lang")]
    sample = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000).select("lang", "text")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 2 << 20):
            rows = frequencies(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(map(packed, rows), pa.binary())], ["lang", "vector"])

    rows = sample.mapInArrow(vectors, "lang string, vector binary").collect()
    # Order must not depend on how the tasks were scheduled.
    rows.sort(key=lambda r: (r["lang"], bytes(r["vector"])))
    langs = [r["lang"] for r in rows]
    x = unpacked([r["vector"] for r in rows])
    del rows
    return Model.fit(x, langs)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """`doc_id`, `held_out`, `lang_pred` and `score` of every row, from its whole text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 2 << 20):
            texts = batch.column("text").to_pylist()
            langs, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if t is not None]
            if model is not None and known:
                found, score[known] = model.predict([texts[i] for i in known])
                for i, code in zip(known, found):
                    langs[i] = code
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"]
            )

    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model | None, least_score: float) -> DataFrame:
    """All rows and columns of `docs` whose text has a language with at least that score. Row by row, so ids may be NULL or repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 2 << 20):
            score = model.predict(batch.column("text").to_pylist())[1] if model is not None and batch.num_rows else np.zeros(batch.num_rows)
            yield batch.filter(pa.array(score >= least_score))

    return docs.where(F.col("text").rlike(r"\p{L}")).mapInArrow(run, docs.schema)
