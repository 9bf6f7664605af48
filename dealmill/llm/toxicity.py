"""Toxicity by a subsequence string kernel, Nystroem landmarks and a support vector machine.

Kernel: a word is the bag of its three-letter subsequences, gaps allowed within ``SPAN`` letters; each weighs
``DECAY`` per letter it spans.  The kernel of two words is the normalised product of their bags, so inserted
or missing letters lower it only a little.  A sentence, and a text, is as near to a landmark as its nearest
word, hence a text is as toxic as its sentences are.  Nearness k enters as ``exp(SHARP * (k - 1))``.

Landmarks are the words that tell toxic from other labelled texts best; words that do so by fewer than
``EVIDENCE`` standard errors are taken only if there are no others.  Nystroem features (nearness times the
inverse root of the landmarks' kernel matrix) feed a linear machine with hinge loss; its margins become
scores by a logistic fit.  A labelled text is learnt a second time with a letter inserted in each of these landmarks,
so the machine knows how near a disguised insult is.
Landmarks and model are learnt from at most about ``TRAIN_DOCS`` labelled documents, chosen by hash; every whole
text is scored.

Single letters that follow one another are read as a word too.  A null or empty text has no words and gets
the score of no nearness.  Without labels of both kinds, or any word in the labelled texts, every score is 0.
Repeated rows, null ids and other columns, whatever their names, make no difference; of several texts with one
labelled id the first in order is learnt.  An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType

from dealmill.llm.common import hash_line, small_batches

TRAIN_DOCS = 6000
LANDMARKS = 64
EVIDENCE, SEEN = 4.0, 3
SPAN, DECAY, SHARP = 6, 0.75, 10.0
LONGEST = 24
REMEMBERED = 25_600_000
_CELLS = 1 << 22
_PIECE = 20_000
_SPELLED = re.compile(r"(?<!\S)(?:[^\W\d_][^\w\s]?\s){3,}[^\W\d_](?!\w)")
# Signs that stand for letters.
_LOOKS = dict(zip("013457@$!", "oieastasi", strict=True))
_OUTER = "#*$%&|<>!?.,;:()[]{}\"'-_=+/\\"


class _Codes(dict):
    """Code point to the character whose number is its code; filled as characters are met."""

    def __missing__(self, point: int) -> str:
        c = _LOOKS.get(chr(point), chr(point))
        self[point] = "" if c in "-_.*#'" else chr(ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % 5)
        return self[point]


_CODES = _Codes()


def codes(word: str) -> np.ndarray:
    """Letters as 1 to 26, others as 27 to 31; look-alikes as their letters; outer marks left out."""
    return np.frombuffer(word.lower().strip(_OUTER).translate(_CODES).encode("latin-1"), np.uint8).astype(np.int64)


@lru_cache
def _places(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights of the subsequences of a word of ``length`` letters."""
    places = [(i, i + j, i + k) for i in range(length) for j, k in combinations(range(1, SPAN), 2) if i + k < length]
    places = np.array(places, np.int64).reshape(-1, 3)
    return places, (DECAY ** (places[:, 2] - places[:, 0] + 1)).astype(np.float32)


def _bags(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, subsequence) numbers of three letters, and weights scaled to norm 1."""
    places, weight = _places(words.shape[1])
    found = words[:, places[:, 0]] << 10 | words[:, places[:, 1]] << 5 | words[:, places[:, 2]]
    return found, weight / np.sqrt((weight**2).sum() or 1.0)


class Nearness:
    """Nearness of words to landmarks; remembers the words it has met."""

    def __init__(self, landmarks: list[str]):
        self.table = np.zeros((1 << 15, max(1, len(landmarks))), np.float32)
        for j, landmark in enumerate(landmarks):
            found, weight = _bags(codes(landmark)[None, :LONGEST])
            np.add.at(self.table[:, j], found[0], weight)
            norm = np.sqrt((self.table[:, j] ** 2).sum())
            self.table[:, j] /= norm or 1.0
        self.shared = self.table.any(axis=1)
        self.remembered = REMEMBERED // self.table.shape[1]
        self.rows = np.zeros((1024, self.table.shape[1]), np.float32)
        self.known: dict[str, int] = {}

    def _learn(self, words: list[str]) -> None:
        first = len(self.known)
        while first + len(words) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        by_length: dict[int, tuple[list[int], list[np.ndarray]]] = {}
        for i, word in enumerate(words, first):
            self.known[word] = i
            code = codes(word)
            self.rows[i] = 0
            for at in range(0, max(1, len(code) - LONGEST // 2), LONGEST // 2) if len(code) > LONGEST else (0,):
                window = code[at : at + LONGEST]
                if len(window) >= 3:
                    at_length = by_length.setdefault(len(window), ([], []))
                    at_length[0].append(i)
                    at_length[1].append(window)
        for length, (places, windows) in by_length.items():
            step = max(1, _CELLS // (len(_places(length)[0]) * self.rows.shape[1]))
            for k in range(0, len(places), step):
                found, weight = _bags(np.stack(windows[k : k + step]))
                word, at = np.nonzero(self.shared[found])
                if not len(word):
                    continue
                first_of = np.flatnonzero(np.diff(word, prepend=-1))
                near = np.add.reduceat(self.table[found[word, at]] * weight[at, None], first_of, axis=0)
                rows = np.array(places[k : k + step])[word[first_of]]
                if length == LONGEST:  # a long word has several windows of this length, but one of each other
                    np.maximum.at(self.rows, rows, np.minimum(near, 1.0))
                else:
                    self.rows[rows] = np.maximum(self.rows[rows], np.minimum(near, 1.0))

    def _numbers(self, words: list[str]) -> list[int]:
        """Rows of the words, after new ones among them are learnt in one go."""
        known = self.known
        found = list(map(known.get, words))
        if None in found:
            new = list({w for w, i in zip(words, found, strict=True) if i is None})
            if len(known) + len(new) > self.remembered:
                known.clear()
                new = list(set(words))
            self._learn(new)
            found = list(map(known.get, words))
        return found

    def of_all(self, texts: Iterable[str]) -> np.ndarray:
        """Greatest nearness of any word of each text to each landmark, one row per text."""
        words, starts, of = [], [], []

        def flush() -> None:
            if words:
                numbers = self._numbers(words)  # may make the table of rows anew
                np.maximum.at(block, of, np.maximum.reduceat(self.rows[numbers], starts, axis=0))
            words.clear(), starts.clear(), of.clear()

        texts = list(texts)
        block = np.zeros((len(texts), self.rows.shape[1]), np.float32)
        for i, text in enumerate(texts):
            text = text.lower()
            own = set(text.split())
            own.update("".join(c for c in m[0] if c.isalpha()) for m in _SPELLED.finditer(text))
            own = list(own)
            for at in range(0, len(own), _PIECE):
                starts.append(len(words)), of.append(i)
                words += own[at : at + _PIECE]
                if len(words) >= _PIECE:
                    flush()
        flush()
        return block

    def of(self, text: str) -> np.ndarray:
        return self.of_all([text])[0]


@lru_cache(maxsize=2)
def _nearness(landmarks: tuple[str, ...]) -> Nearness:
    return Nearness(list(landmarks))


def _bare(word: str) -> str:
    return "".join(c for c in word.lower() if c.isalpha())


def disguised(text: str, sure: set[str]) -> str | None:
    """``text`` with a letter inserted in each word of ``sure`` of four letters or more; null where it has none."""
    words, hit = text.split(), False
    for i, word in enumerate(words):
        word = _bare(word)
        if len(word) >= 4 and word in sure:
            draw = zlib.crc32((word + text[:50]).encode("utf-8", "replace"))
            at = 1 + draw % (len(word) - 1)
            words[i], hit = word[:at] + chr(97 + (draw >> 8) % 26) + word[at:], True
    return " ".join(words) if hit else None


def fit(near: np.ndarray, toxic: np.ndarray, landmarks: list[str], rounds: int = 2000, decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights on sharpened nearness and bias, whose sum is the log-odds of "toxic"."""
    of = Nearness(landmarks)
    kernel = np.exp(SHARP * (np.stack([of.of(z) for z in landmarks]) - 1.0)).astype(float)
    values, vectors = np.linalg.eigh((kernel + kernel.T) / 2)
    root = vectors @ np.diag(np.maximum(values, 1e-2) ** -0.5) @ vectors.T
    x = np.exp(SHARP * (near.astype(float) - 1.0)) @ root
    y = np.where(toxic, 1.0, -1.0)
    share = np.where(toxic, 0.5 / toxic.sum(), 0.5 / (~toxic).sum())
    w, b, mean_w, mean_b = np.zeros(x.shape[1]), 0.0, np.zeros(x.shape[1]), 0.0
    for step in range(1, rounds + 1):
        active = share * y * (y * (x @ w + b) < 1)
        rate = 2.0 / step**0.5
        w, b = w - rate * (decay * w - x.T @ active), b + rate * active.sum()
        mean_w, mean_b = mean_w + (w - mean_w) * 2 / (step + 1), mean_b + (b - mean_b) * 2 / (step + 1)
    margin = x @ mean_w + mean_b
    # Logistic fit of the margins, by Newton steps with a little ridge.
    design, target, odds = np.stack([margin, np.ones_like(margin)], axis=1), toxic.astype(float), np.zeros(2)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ odds, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        odds = odds + np.linalg.solve(hessian, design.T @ (target - p) - 1e-3 * odds)
    return odds[0] * (root @ mean_w), float(odds[0] * mean_b + odds[1])


def train(df: DataFrame, labels: DataFrame, sample: int = TRAIN_DOCS) -> tuple[list[str], np.ndarray, float]:
    """Landmarks, weights and bias from labelled texts (doc_id, text; doc_id, toxic)."""
    given = labels.select("doc_id", "toxic").where("doc_id is not null and toxic is not null")
    n = given.count()
    line = hash_line(sample, n)
    chosen = given.where(F.xxhash64("doc_id") <= line).groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    # About ``sample`` rows of two small columns, whatever the size of the table.
    docs = df.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t")).join(F.broadcast(chosen), "doc_id")
    # One text for each labelled id, however many rows have it.
    docs = docs.groupBy("doc_id").agg(F.first("toxic").alias("toxic"), F.min("t").alias("t"))
    words = docs.select("toxic", F.explode(F.array_distinct(F.split(F.regexp_replace(F.lower("t"), r"[^\p{L}\s]", ""), r"\s+"))).alias("word"))
    words = words.where(F.length("word").between(3, LONGEST)).groupBy("word").agg(
        F.count_if("toxic").cast("double").alias("a"), F.count_if(~F.col("toxic")).cast("double").alias("b")
    )
    totals = {r["toxic"]: r["n"] for r in docs.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(totals) < 2:
        return [], np.zeros(1), -40.0
    n_a, n_b = float(totals[True]), float(totals[False])
    a, b, share = F.col("a") / n_a, F.col("b") / n_b, (F.col("a") + F.col("b")) / (n_a + n_b)
    error = F.sqrt(share * (1 - share) * (1 / n_a + 1 / n_b))
    telling = (a - b) / F.sqrt(b + 0.01)
    is_sure = (F.col("a") >= SEEN) & (a - b >= EVIDENCE * error)
    best = words.orderBy(telling.desc(), "word").limit(LANDMARKS).select("word", is_sure.alias("sure")).collect()
    sure = {r["word"] for r in best if r["sure"]}
    # Words of chance would tell the disguised copies from clean texts by themselves; they serve only where no word is sure.
    landmarks = [r["word"] for r in best if not sure or r["sure"]]
    if not landmarks:
        return [], np.zeros(1), -40.0
    rows = docs.select("toxic", F.explode(_near(F.col("t"), landmarks, sure)).alias("x")).toPandas()
    near = np.stack([np.frombuffer(x, np.float32) for x in rows["x"]])
    return landmarks, *fit(near, rows["toxic"].to_numpy(bool), landmarks)


def _near(text: Column, landmarks: list[str], sure: set[str]) -> Column:
    """Nearness of a text, and of its disguised copy where it has words of ``sure``."""

    @F.pandas_udf(ArrayType(BinaryType()))
    def near(texts: pd.Series) -> pd.Series:
        of = _nearness(tuple(landmarks))
        both = [[t for t in (text, disguised(text, sure)) if t is not None] for text in texts]
        rows = iter(of.of_all(t for pair in both for t in pair))
        return pd.Series([[next(rows).tobytes() for _ in pair] for pair in both], dtype=object)

    return near(text)


def score(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row of ``df``, by a model learnt from ``labels`` (doc_id, toxic)."""
    small_batches(df.sparkSession)
    docs = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    landmarks, w, b = train(docs, labels)

    @F.pandas_udf(DoubleType())
    def scores(texts: pd.Series) -> pd.Series:
        of = _nearness(tuple(landmarks))
        z = (np.exp(SHARP * (of.of_all(texts) - 1.0)) @ w).astype(float) + b
        return pd.Series(1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))))

    return docs.select("doc_id", scores(F.col("text")).alias("score"))
