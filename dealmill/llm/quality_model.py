"""Quality classifier from weak labels: overlapping heuristics, EM for their accuracies, a hashed linear scorer.

Heuristic labellers vote good, bad or nothing on every document; no given label is read.  Expectation-
maximisation over the counts of all vote patterns (at most ``3 ** labellers`` of them, whatever the size of
the corpus) estimates how often each labeller votes what on good and on bad documents.  The posterior of each
pattern labels a sample of at most about ``TRAIN_DOCS`` documents, chosen by hash, on which a logistic model
over hashed byte trigrams is trained; it scores every whole text.

A null text is empty; it has no trigrams and gets the score of the bias alone.  Null ids, repeated rows and
further columns make no difference.  An empty table gives no rows; where no labeller tells documents apart,
all posteriors agree and so do the scores.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType

from dealmill.llm.common import WORD, hash_line, small_batches, stored, whole_text

TRAIN_DOCS = 6000
SLOTS = 2048
KEEP = 0.5
_PIECE = 1 << 20


def labellers(text: Column) -> dict[str, Column]:
    """Name to vote: 1 good, -1 bad, 0 nothing."""
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    chars = F.greatest(F.char_length(text), F.lit(1)).cast("double")
    words = F.split(text, r"[\x20\x09-\x0D]+")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    distinct = lambda a: F.size(F.array_distinct(a)) / F.greatest(F.size(a), F.lit(1)).cast("double")
    vote = lambda bad, good: F.when(bad, -1).when(good, 1).otherwise(0)
    symbols, upper = count("[#*$%&|<>]") / chars, count("[A-ZÀ-ÖØ-Þ]") / chars
    marks = count(r"[!?#*$%&|<>=_~^\\]") / chars
    echoes = count(r"(?<!\S)(\S+)\s+\1(?!\S)") / F.greatest(F.size(words), F.lit(1)).cast("double")
    commas = count("[.,;:]") / chars
    return {
        "symbols": vote(symbols > 0.06, symbols < 0.01),
        "capitals": vote(upper > 0.3, upper < 0.1),
        "marks": vote(marks > 0.06, marks < 0.02),
        "words": vote((F.size(words) >= 20) & (distinct(words) < 0.25), F.lit(False)),
        "echoes": vote(echoes > 0.04, echoes < 0.01),
        "lines": vote((F.size(lines) >= 4) & (distinct(lines) < 0.6), F.lit(False)),
        "stops": vote(F.lit(False), (commas > 0.005) & (commas < 0.05)),
    }


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of "good" for each pattern of votes, and P(vote | class) as (class, labeller, vote + 1)."""
    # Start from the suspicion that any vote for "bad" is right.
    good = np.where((patterns < 0).any(axis=1), 0.1, np.where((patterns > 0).any(axis=1), 0.9, 0.5))
    hot = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)
    for _ in range(rounds):
        weight = np.stack([(1 - good) * counts, good * counts])
        table = np.einsum("cp,plv->clv", weight, hot) + 0.5
        table /= table.sum(axis=2, keepdims=True)
        prior = (weight.sum(axis=1) + 1.0) / (weight.sum() + 2.0)
        logs = np.log(prior)[:, None] + np.einsum("clv,plv->cp", np.log(table), hot)
        good = 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
    return good, table


def features(text: str) -> np.ndarray:
    """Square roots of the shares of hashed byte trigrams, and in the last slot how likely two trigrams are the same."""
    data = np.frombuffer(text.encode(), np.uint8)
    total = np.zeros(SLOTS, np.int64)
    for at in range(0, max(0, len(data) - 2), _PIECE):
        b = data[at : at + _PIECE + 2].astype(np.uint32)
        total += np.bincount((b[:-2] * 73856093 ^ b[1:-1] * 19349663 ^ b[2:] * 83492791) >> 7 & (SLOTS - 1), minlength=SLOTS)
    n = int(total.sum())
    twice = float((total * (total - 1)).sum()) / max(1, n * (n - 1))
    return np.append(np.sqrt(total / max(1, n)), 4.0 * np.sqrt(twice)).astype(np.float32)


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 300, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model for soft labels ``y``, by full gradients with momentum."""
    w, b = np.zeros(x.shape[1], np.float64), 0.0
    first, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, rounds + 1):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w.astype(np.float32) + b, -40, 40)))
        gradient = np.append(x.T @ (p - y).astype(np.float32) / max(1, len(y)) + decay * w, (p - y).mean() if len(y) else 0.0)
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = 0.3 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w.astype(np.float32), float(b)


def train(df: DataFrame, text: str = "text", sample: int = TRAIN_DOCS) -> tuple[np.ndarray, float]:
    """Weights and bias learnt from all votes and a sample of texts."""
    docs = df.select(whole_text(text).alias("t"))
    names = list(labellers(F.col("t")))
    voted = stored(docs.select(F.xxhash64("t").alias("h"), *(v.alias(n) for n, v in labellers(F.col("t")).items())))
    seen = voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).toPandas()
    patterns, counts = seen[names].to_numpy(np.int64).reshape(-1, len(names)), seen["n"].to_numpy(float)
    good, _ = estimate(patterns, counts)
    posterior = {tuple(p): g for p, g in zip(patterns.tolist(), good, strict=True)}
    # Texts by hash below a line that so many pass on average; equal texts are taken once.
    line = hash_line(sample, counts.sum())
    chosen = docs.withColumn("h", F.xxhash64("t")).where(F.col("h") <= line).dropDuplicates(["h"])

    @F.pandas_udf(BinaryType())
    def vector(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t).tobytes() for t in texts], dtype=object)

    votes = [v.alias(n) for n, v in labellers(F.col("t")).items()]
    rows = chosen.select(*votes, vector(F.col("t")).alias("x")).toPandas()
    x = np.stack([np.frombuffer(v, np.float32) for v in rows["x"]]) if len(rows) else np.zeros((0, SLOTS + 1), np.float32)
    y = np.array([posterior[tuple(p)] for p in rows[names].to_numpy(np.int64).tolist()], float)
    return fit(x, y)


def scorer(df: DataFrame, text: str = "text") -> Column:
    """Column with the score (0 to 1) of ``text``, by a model trained on ``df``."""
    small_batches(df.sparkSession)
    w, b = train(df, text)

    @F.pandas_udf(DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        z = np.array([features(t) @ w for t in texts], float) + b
        return pd.Series(1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))))

    return score(whole_text(text))


def classify(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, kept) of every row."""
    scored = df.select(F.col(doc_id).alias("doc_id"), scorer(df, text).alias("score"))
    return scored.withColumn("kept", F.col("score") >= KEEP)


def keep_good(df: DataFrame) -> DataFrame:
    """Rows of ``df`` whose text the classifier accepts."""
    return df.withColumn("__score", scorer(df)).where(F.col("__score") >= KEEP).select(*df.columns)
