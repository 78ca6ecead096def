"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades 0 .. K-1 share one weight per hashed text feature; ordered thresholds cut the score:
P(grade > k) = sigmoid(score - threshold_k).  From them come the expected grade and the
tail probability by which documents are selected.

The model is fitted on a bounded sample of graded documents: the ``max_train`` ids with the
smallest hash.  Features of the sample are computed where the documents are, the fit runs
in one task over that bounded table, and the driver gets the weights (a fixed size).  Every
document is scored over its whole text.

Features are sets: words and runs of punctuation, the first letters of longer words, and
shape (how often a word repeats the one before it, how many words are distinct, capitals,
punctuation, each in steps).  Features in fewer than ``MIN_DOCS`` sampled
documents, or whose presence hardly depends on the grade there, get no weight.

Defined results: null and empty texts have only shape features; rows repeated with one id
count once in the fit (of different texts the one with the smallest hash) and are scored each; contradicting grades of one id count as the
lowest; null grades and grades of unknown documents are ignored; with fewer than two
different grades, or no telling feature, there is nothing to learn, and every document gets the top grade; an empty
table gives an empty result.  Columns of the input that clash with the added ones are
replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogprep.llm._common import hash_sample, read_table, saved

BITS = 18
MAX_TRAIN = 8192
MIN_DOCS = 3
ROUNDS = 200
LEAST_G = 45.0
L2 = 1.0
KEEP_AT = 0.5
KEEP_CLEAN = 0.98
HELD_OUT = 8
PREFIX = 5
_TOKEN = re.compile(r"[^\W_]+|[^\w\s]+")
_STEPS = (0.0, 0.02, 0.05, 0.1, 0.2, 0.4, 0.6, 0.8)


def _step(x: float) -> int:
    return sum(x > s for s in _STEPS)


def feature_ids(text: str | None, bits: int = BITS) -> np.ndarray:
    """Hashed ids of the text's features, each once."""
    text = text or ""
    tokens = _TOKEN.findall(text)
    low = [t.lower() for t in tokens]
    names = set(low)
    names |= {"<" + t[:PREFIX] for t in names if len(t) > PREFIX}
    n = max(1, len(tokens))
    spaced = text.split()
    again = sum(map(str.__eq__, spaced, spaced[1:])) / max(1, len(spaced))
    marks = sum(not t[0].isalnum() for t in tokens) / n
    caps = sum(t.isupper() and len(t) > 1 for t in tokens) / n
    distinct = 1 - len(set(low)) / n if len(tokens) >= 20 else 0.0
    shape = (("again", again), ("marks", marks), ("caps", caps), ("same", distinct))
    names |= {f">{k}{i}" for k, v in shape for i in range(_step(v))}
    mask = (1 << bits) - 1
    return np.unique(np.fromiter((crc32(t.encode("utf-8", "surrogatepass")) & mask for t in names), np.int64, len(names)))


@dataclass
class Model:
    """Weights by feature id, the ordered thresholds, and the tail probability from which
    documents are kept."""

    weights: np.ndarray
    thresholds: np.ndarray
    bits: int = BITS
    keep_at: float = KEEP_AT

    def score(self, text: str | None) -> float:
        return float(self.weights[feature_ids(text, self.bits)].sum())

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for every k, by row."""
        return _sigmoid(scores[:, None] - self.thresholds[None, :])


def _neutral(top: int, bits: int) -> Model:
    """Gives every document the top grade: where there is nothing to learn."""
    return Model(np.zeros(1 << bits, np.float32), np.full(max(1, top), -40.0, np.float32), bits)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def telling(flat: np.ndarray, grade: np.ndarray, docs_of: np.ndarray, size: int, min_docs: int,
            least: float = LEAST_G) -> np.ndarray:
    """Which features' presence depends on the grade: likelihood ratio (G) of at least
    ``least``.  Random words, by far the most, would else add noise to long texts."""
    k = len(docs_of)
    seen = np.bincount(flat * k + grade, minlength=size * k).reshape(size, k).astype(np.float64)
    n, total = seen.sum(axis=1), docs_of.sum()
    g = np.zeros(size)
    for has, part in ((seen, n), (docs_of - seen, total - n)):
        with np.errstate(divide="ignore", invalid="ignore"):
            x = has * np.log(has * total / (part[:, None] * docs_of[None, :]))
        g += 2 * np.nan_to_num(x, nan=0.0, posinf=0.0, neginf=0.0).sum(axis=1)
    return (n >= min_docs) & (g >= least)


def fit(ids: list[np.ndarray], grades: np.ndarray, bits: int = BITS, rounds: int = ROUNDS, l2: float = L2,
        min_docs: int = MIN_DOCS) -> Model:
    """Maximum likelihood with an L2 penalty, by Adam over all rows; thresholds are a first
    one and positive steps, so they stay ordered."""
    kinds = np.unique(grades)
    if len(kinds) < 2:
        return _neutral(int(grades.max(initial=0)), bits)
    top = int(grades.max())
    flat, rows = np.concatenate(ids), np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    keep = telling(flat, grades[rows], np.bincount(grades, minlength=top + 1), 1 << bits, min_docs)
    if not keep.any():
        return _neutral(int(grades.max()), bits)
    flat, rows = flat[keep[flat]], rows[keep[flat]]
    used, col = np.unique(flat, return_inverse=True)
    n = len(ids)
    # each grade weighs alike, so that a rare one is learnt too
    share = n / (len(kinds) * np.bincount(grades, minlength=top + 1).clip(1))[grades]
    p = [np.zeros(len(used)), np.array([-1.0]), np.zeros(top - 1)]  # weights, first threshold, log steps
    m, v = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p]
    for step in range(1, rounds + 1):
        theta = p[1][0] + np.r_[0.0, np.cumsum(np.exp(p[2]))]
        s = np.bincount(rows, p[0][col], n)
        f = np.c_[np.ones(n), _sigmoid(s[:, None] - theta[None, :]), np.zeros(n)]  # P(grade >= k)
        hi, lo = f[np.arange(n), grades], f[np.arange(n), grades + 1]
        like = np.maximum(hi - lo, 1e-9)
        slope = f * (1 - f)
        dhi, dlo = slope[np.arange(n), grades], slope[np.arange(n), grades + 1]
        ds = -share * (dhi - dlo) / like
        dtheta = np.zeros(top)
        np.add.at(dtheta, grades[grades > 0] - 1, (share * dhi / like)[grades > 0])
        np.add.at(dtheta, grades[grades < top], -(share * dlo / like)[grades < top])
        tail = np.cumsum(dtheta[::-1])[::-1]
        grad = [np.bincount(col, ds[rows], len(used)) + l2 * p[0], np.array([tail[0]]), tail[1:] * np.exp(p[2])]
        for x, g, a, b in zip(p, grad, m, v):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            x -= 0.1 * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)
    weights = np.zeros(1 << bits, np.float32)
    weights[used] = p[0]
    return Model(weights, (p[1][0] + np.r_[0.0, np.cumsum(np.exp(p[2]))]).astype(np.float32), bits)


def calibrated(ids: list[np.ndarray], grades: np.ndarray, bits: int = BITS) -> Model:
    """A model fitted on all but every ``HELD_OUT``-th row.  It keeps documents whose top grade
    is more likely than not (``KEEP_AT``), or from a lower probability on if otherwise less than
    ``KEEP_CLEAN`` of the held-out rows of the top grade stayed."""
    held = np.arange(len(ids)) % HELD_OUT == HELD_OUT - 1
    model = fit([x for x, h in zip(ids, held) if not h], grades[~held], bits)
    model.bits = bits
    clean = np.array([model.weights[x].sum() for x, h, g in zip(ids, held, grades) if h and g == grades.max()])
    if len(clean) and model.weights.any():
        model.keep_at = min(KEEP_AT, float(np.quantile(model.tails(clean)[:, -1], 1 - KEEP_CLEAN, method="lower")))
    return model


def train(docs: DataFrame, graded: DataFrame, bits: int = BITS, max_train: int = MAX_TRAIN) -> Model:
    """Fit on at most ``max_train`` graded documents.  ``graded``: doc_id, grade."""
    one = graded.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))
    sample = saved(hash_sample(saved(one, "grades"), max_train, "doc_id"), "graded")

    def features(batches):
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("int64"), "th": b["th"].astype("int64"), "grade": b["grade"].astype("int32"),
                                "ids": [feature_ids(t, bits) for t in b["text"]]})

    def fitted(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("doc_id").reset_index(drop=True)
        model = calibrated([np.asarray(x, dtype=np.int64) for x in df["ids"]], df["grade"].to_numpy(dtype=np.int64), bits)
        return pd.DataFrame({"weights": [model.weights.tobytes()], "thresholds": [model.thresholds.tobytes()], "keep_at": [model.keep_at]})

    picked = docs.select("doc_id", "text", F.xxhash64("text").alias("th")).join(F.broadcast(sample), "doc_id")
    # of different texts under one id, the one with the smallest hash
    rows = (picked.mapInPandas(features, "doc_id long, th long, grade int, ids array<long>")
            .groupBy("doc_id").agg(F.min(F.struct("th", "grade", "ids")).alias("one")).select("doc_id", "one.grade", "one.ids")
            .withColumn("all", F.lit(1)).groupBy("all").applyInPandas(fitted, "weights binary, thresholds binary, keep_at double").collect())
    if not rows:
        return _neutral(1, bits)
    return Model(np.frombuffer(rows[0].weights, np.float32), np.frombuffer(rows[0].thresholds, np.float32), bits, rows[0].keep_at)


def grade(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, expected_grade, tail (probability of the top grade), keep for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^bits weights, whatever the input

    @F.pandas_udf("expected_grade double, tail double, keep boolean")
    def graded(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        tails = m.tails(np.fromiter((m.score(t) for t in texts), np.float64, len(texts)))
        return pd.DataFrame({"expected_grade": tails.sum(axis=1), "tail": tails[:, -1], "keep": tails[:, -1] >= m.keep_at})

    return docs.select("doc_id", graded("text").alias("g")).select("doc_id", "g.*")


def select(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that the classifier keeps, columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def keep(texts: pd.Series) -> pd.Series:
        m = shared.value
        tails = m.tails(np.fromiter((m.score(t) for t in texts), np.float64, len(texts)))
        return pd.Series(tails[:, -1] >= m.keep_at)

    return docs.where(keep("text"))


def graded_labels(labels: DataFrame) -> DataFrame:
    """Grades from the labels: 0 poor, 1 good but toxic, 2 good."""
    return labels.select("doc_id", F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1)
                         .when((F.col("quality") == 1) & (F.col("toxic") == 0), 2).alias("grade"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return grade(docs, train(docs, graded_labels(read_table(spark, sf_dir, "labels"))))
