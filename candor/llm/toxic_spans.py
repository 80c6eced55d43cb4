"""Toxic spans by a linear-chain conditional random field with two tags, and document scores from its marginals.

Token labels. The labels are per document, so tokens of toxic training documents are labelled by how strongly their features (the folded word and its
beginnings) lean to toxic documents; tokens of the other documents are all clean. The field is trained on these sequences by gradient steps on the
conditional likelihood; forward-backward gives the gradient.

Scores. Forward-backward over the whole text gives each token the probability of the toxic tag. A logistic function of the expected number of toxic tokens
and of the largest marginal, fitted on the training documents, is the score. Tokens at 0.5 or more are the offending spans.

Forward-backward is a product of 2 x 2 matrices along all tokens of a batch; where a document starts the matrix forgets what was before. The product is
taken in lanes side by side, then across lanes, so the work is linear and stays in numpy however long or short the texts are.

Training takes at most about TOXIC_DOCS toxic and CLEAN_DOCS clean labelled documents, chosen by a hash of their id; held-out documents are never among them.
The model is broadcast by closure: it holds at most the features of that sample.

Defined cases: NULL and empty texts have no tokens, no spans and the score of a text without evidence. Without both labels in the training rows every score
is 0. A document with several label rows counts as toxic if one says so. Rows are independent; columns other than `doc_id` and `text` are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candor.llm.common import held_out, small_batches, text_of

TOXIC_DOCS, CLEAN_DOCS = 1500, 3000
BEGINNINGS = range(3, 8)
THRESHOLD = 0.3
_TOKEN = re.compile(r"[^\W_]+")
SCHEMA = "doc_id long, score double, spans array<struct<start: int, end: int>>"


def folded(text: str) -> str:
    """Lower case with every character and token in its place. U+0130 is the only character whose lower case is longer, by a mark that would split its token."""
    return text.replace("\u0130", "i").lower()


def features_of(word: str) -> list[str]:
    return [word, *(f"{word[:k]}*" for k in BEGINNINGS if k < len(word))]


def marginals(emission: np.ndarray, first: np.ndarray, moves: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per token the probability of tag 1, and the expected number of moves between tags.

    emission: log weight of tag 1 against tag 0. first: where a sequence starts. moves, start: weights above 0.
    """
    n = len(emission)
    if not n:
        return np.zeros(0), np.zeros((2, 2))
    lanes = min(4096, max(1, n // 64))
    steps = -(-n // lanes)
    size = lanes * steps

    def laid(values: np.ndarray, fill: float) -> np.ndarray:
        out = np.full(size, fill, float)
        out[:n] = values
        return np.ascontiguousarray(out.reshape(lanes, steps).T)

    power = np.exp(np.clip(emission, -30, 30))
    top = np.maximum(1, power)
    w0, w1, fresh = laid(1 / top, 1), laid(power / top, 1), laid(first, 0).astype(bool)
    real = laid(np.ones(n), 0).astype(bool)

    def matrix(t: int) -> tuple[np.ndarray, ...]:
        f, r = fresh[t], real[t]
        m = [np.where(f, start[j], moves[i, j]) * (w1[t] if j else w0[t]) for i in (0, 1) for j in (0, 1)]
        return m if r.all() else [np.where(r, x, float(k in (0, 3))) for k, x in enumerate(m)]

    a, b, c, d = np.ones(lanes), np.zeros(lanes), np.zeros(lanes), np.ones(lanes)
    for t in range(steps):
        m00, m01, m10, m11 = matrix(t)
        a, b, c, d = a * m00 + b * m10, a * m01 + b * m11, c * m00 + d * m10, c * m01 + d * m11
        total = a + b + c + d
        a, b, c, d = a / total, b / total, c / total, d / total
    before, after = np.empty((lanes, 2)), np.empty((lanes, 2))
    x0, x1 = 0.5, 0.5
    for k in range(lanes):
        before[k] = x0, x1
        x0, x1 = x0 * a[k] + x1 * c[k], x0 * b[k] + x1 * d[k]
        x0, x1 = x0 / (x0 + x1), x1 / (x0 + x1)
    x0, x1 = 0.5, 0.5
    for k in range(lanes - 1, -1, -1):
        after[k] = x0, x1
        x0, x1 = a[k] * x0 + b[k] * x1, c[k] * x0 + d[k] * x1
        x0, x1 = x0 / (x0 + x1), x1 / (x0 + x1)

    alpha0, alpha1 = np.empty((steps, lanes)), np.empty((steps, lanes))
    x0, x1 = before.T
    for t in range(steps):
        m00, m01, m10, m11 = matrix(t)
        x0, x1 = x0 * m00 + x1 * m10, x0 * m01 + x1 * m11
        total = x0 + x1
        alpha0[t], alpha1[t] = x0, x1 = x0 / total, x1 / total
    out, pairs = np.empty((steps, lanes)), np.zeros((2, 2))
    y0, y1 = after.T
    for t in range(steps - 1, -1, -1):
        p1 = alpha1[t] * y1
        out[t] = p1 / (alpha0[t] * y0 + p1)
        m00, m01, m10, m11 = matrix(t)
        x0, x1 = (alpha0[t - 1], alpha1[t - 1]) if t else before.T
        inside = real[t] & ~fresh[t]
        each = [x0 * m00 * y0, x0 * m01 * y1, x1 * m10 * y0, x1 * m11 * y1]
        weight = inside / np.maximum(1e-300, each[0] + each[1] + each[2] + each[3])
        pairs += np.array([(e * weight).sum() for e in each]).reshape(2, 2)
        y0, y1 = m00 * y0 + m01 * y1, m10 * y0 + m11 * y1
        total = y0 + y1
        y0, y1 = y0 / total, y1 / total
    return out.T.ravel()[:n], pairs


def _starts(lengths: np.ndarray) -> np.ndarray:
    """Marks the first token of every sequence that has one."""
    first = np.zeros(int(lengths.sum()), bool)
    first[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    return first


def _summaries(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per document: 1, log of 1 + the expected number of toxic tokens, the largest marginal."""
    out = np.zeros((len(lengths), 3))
    out[:, 0] = 1
    has = lengths > 0
    if has.any():
        at = (np.cumsum(lengths) - lengths)[has]
        out[has, 1] = np.log1p(np.add.reduceat(p, at))
        out[has, 2] = np.maximum.reduceat(p, at)
    return out


@dataclass
class Field:
    weights: dict[str, float]
    bias: float
    moves: np.ndarray
    start: np.ndarray
    calibration: np.ndarray
    known: dict[str, float] = field(default_factory=dict, repr=False)

    def emission(self, word: str) -> float:
        get = self.weights.get
        return self.bias + sum(get(f, 0.0) for f in features_of(word))

    def emissions(self, words: list[str]) -> np.ndarray:
        """Kept per distinct word; the memory is bounded by starting afresh."""
        if len(self.known) > 400_000:
            self.known.clear()
        known = self.known
        for w in set(words) - known.keys():
            known[w] = self.emission(w)
        return np.fromiter(map(known.__getitem__, words), np.float64, len(words))

    def score(self, texts: list[str]) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
        tokens = [_TOKEN.findall(folded(t)) for t in texts]
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        p, _ = marginals(self.emissions([w for row in tokens for w in row]), _starts(lengths), self.moves, self.start)
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        at = np.cumsum(lengths) - lengths
        hits = np.flatnonzero(p >= 0.5)
        rows = np.searchsorted(np.cumsum(lengths), hits, side="right")
        for i in np.unique(rows):
            places = [m.span() for m in _TOKEN.finditer(texts[i])]
            spans[i] = [places[k - at[i]] for k in hits[rows == i]]
        return 1 / (1 + np.exp(-np.clip(_summaries(p, lengths) @ self.calibration, -30, 30))), spans


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        w = w + np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
    return w


def fit(texts: list[str], toxic: list[int], steps: int = 40, rate: float = 0.3) -> Field | None:
    """Trains on whole texts with document labels; None unless both labels occur."""
    y_doc = np.array(toxic, dtype=float)
    n_toxic, n_clean = int(y_doc.sum()), int((1 - y_doc).sum())
    if not n_toxic or not n_clean:
        return None
    # Words and features become numbers at once; each string is kept once.
    vocabulary: dict[str, int] = {}
    names: dict[str, int] = {}
    features: list[np.ndarray] = []
    words: list[np.ndarray] = []
    present: dict[bool, list[np.ndarray]] = {True: [], False: []}
    for text, label in zip(texts, toxic):
        row = _TOKEN.findall(folded(text))
        for w in row:
            if w not in vocabulary:
                vocabulary[w] = len(vocabulary)
                features.append(np.array([names.setdefault(f, len(names)) for f in features_of(w)], np.int32))
        ids = np.fromiter(map(vocabulary.__getitem__, row), np.int32, len(row))
        words.append(ids)
        if len(ids):
            present[bool(label)].append(np.unique(np.concatenate([features[i] for i in np.unique(ids)])))
    in_toxic, in_clean = (np.bincount(np.concatenate(present[k] or [np.zeros(0, np.int32)]), minlength=len(names)) for k in (True, False))
    lean = np.log((in_toxic + 0.5) / (n_toxic + 1)) - np.log((in_clean + 0.5) / (n_clean + 1))
    telling = (in_toxic >= max(4, n_toxic // 100)) & (lean > 3)
    rows_a = np.repeat(np.arange(len(features)), np.fromiter(map(len, features), np.int64, len(features)))
    columns_a = np.concatenate(features) if features else np.zeros(0, np.int32)
    del features, present
    tagged = np.bincount(rows_a, telling[columns_a], len(vocabulary)) > 0
    common = (in_toxic + in_clean >= 3)[columns_a]
    rows_a, columns_a = rows_a[common], columns_a[common]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    word = np.concatenate(words)
    first = _starts(lengths)
    y = tagged[word] & np.repeat(y_doc > 0, lengths)
    pair = (2 * y[:-1] + y[1:])[~first[1:]]
    seen = np.bincount(pair, minlength=4).reshape(2, 2).astype(float)

    theta = np.zeros(len(names) + 1)
    theta[-1] = -4.0
    log_moves, start = np.zeros((2, 2)), np.ones(2)
    m = v = np.zeros(len(theta) + 4)
    y_float, n_words = y.astype(float), len(vocabulary)
    for k in range(1, steps + 1):
        by_word = np.bincount(rows_a, theta[columns_a], n_words) + theta[-1]
        p, expected = marginals(by_word[word], first, np.exp(log_moves), start)
        slope = np.bincount(word, y_float - p, n_words)
        g = np.concatenate([np.bincount(columns_a, slope[rows_a], len(names)), [slope.sum()], (seen - expected).ravel()])
        g[: len(names)] -= 0.1 * theta[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-3)
        theta = theta + move[:-4]
        log_moves = np.clip(log_moves + move[-4:].reshape(2, 2), -6, 6)
    by_word = np.bincount(rows_a, theta[columns_a], n_words) + theta[-1]
    p, _ = marginals(by_word[word], first, np.exp(log_moves), start)
    calibration = _logistic(_summaries(p, lengths), y_doc)
    weights = {f: float(theta[i]) for f, i in names.items() if abs(theta[i]) > 0.02}
    return Field(weights, float(theta[-1]), np.exp(log_moves), start, calibration)


def train(docs: DataFrame, labels: DataFrame, toxic_docs: int = TOXIC_DOCS, clean_docs: int = CLEAN_DOCS) -> Field | None:
    """Fits on a bounded sample of the labelled documents that are not held out. Only that sample reaches the driver."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    if not counts.get(0) or not counts.get(1):
        return None
    share = F.when(F.col("toxic") == 1, F.lit(min(1.0, toxic_docs / counts[1]))).otherwise(F.lit(min(1.0, clean_docs / counts[0])))
    chosen = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"))
    # At most toxic_docs + clean_docs rows of two numbers.
    rows = texts.join(F.broadcast(chosen), "doc_id").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    return fit([r["text"] for r in rows], [r["toxic"] for r in rows])


def score(docs: DataFrame, model: Field | None) -> DataFrame:
    """`doc_id`, `score` and the offending `spans` (code points, end exclusive) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 4 << 20):
            texts = batch.column("text").to_pylist()
            scores, spans = (np.zeros(len(texts)), [[]] * len(texts)) if model is None else model.score(texts)
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            rows = pa.array([[{"start": s, "end": e} for s, e in row] for row in spans], kind)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64()), rows], ["doc_id", "score", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text")).mapInArrow(run, SCHEMA)
