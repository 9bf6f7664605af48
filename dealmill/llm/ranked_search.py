"""Ranked lexical search by the Best Position Algorithm over impact lists.

Every stored partition of documents gives shards of at most ``POSTINGS`` postings.  A shard holds, for every term
of the queries, its impact list: documents by falling share of the score.  For a query its lists are read
from the top in rounds, and each document met is looked up in all lists of the query at once.  Those
look-ups mark positions as seen, read or not; the best position of a list is the end of its unbroken run of
seen positions from the top.  No document unseen can score above the sum of the shares at the best
positions.  Reading stops when that sum is strictly below the ``k``-th best score, so ties are never cut; or
when all lists are read.  The best ``k`` of every shard are then ranked over all shards.

Queries are dealt by hash to blocks of about ``BLOCK_CHARS`` characters of text, and every block is held against all
documents, so what is sent to the tasks is bounded; shards are built where the documents lie, without a shuffle.

Null and empty texts have no terms, are never found, and do not count as documents.  A query without terms
has no rows.  Repeated query rows are answered one by one, under whatever item_id they have; repeated documents
and null ids are documents of their own, equal scores by ascending doc_id, null last.  Texts of any length are read whole.  Empty
tables give no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealmill.llm.common import small_batches, stored, whole_text

TOP = 10
BLOCK_CHARS = 4_000_000
POSTINGS = 2_000_000
FIRST_DEPTH = 32
# What a term is; scale of the weight and of the share, length weight in hundredths.
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_SCALE, _LENGTH = 1000, 90


def terms(text: str | None) -> list[str]:
    """Terms of a text with repeats."""
    return _TERM.findall((text or "").translate(_LOWER))


def counted(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(doc_id, n, term, tf) of every row: its terms with repeats, and numbers and counts of those in ``vocabulary``."""
    number = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def count(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = number.value
        for batch in texts:
            n, term, tf = [], [], []
            for text in batch:
                found = terms(text)
                n.append(len(found))
                hits = Counter(map(known.get, found))
                hits.pop(None, None)
                term.append(np.fromiter(hits.keys(), np.int32, len(hits)))
                tf.append(np.fromiter(hits.values(), np.int32, len(hits)))
            yield pd.DataFrame({"n": n, "term": pd.Series(term, dtype=object), "tf": pd.Series(tf, dtype=object)})

    of = F.pandas_udf(count, "n long, term array<int>, tf array<int>")
    return docs.select("doc_id", of("text").alias("c")).select("doc_id", "c.n", "c.term", "c.tf")


def weights(df: dict[int, int], n_docs: int, size: int) -> np.ndarray:
    """Weight of every term number, by how many documents hold it."""
    return np.array([math.floor(_SCALE * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(size)], np.int64)


def shares(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What one term adds to the score of one document, in 64-bit integers."""
    m = 100 - _LENGTH + (_LENGTH * n * n_docs) // n_terms
    return weight * ((10**9 * tf) // (1000 * tf + 8 * m))


class Shard:
    """Impact lists of some documents, each also in document order for direct access."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, share: np.ndarray, doc_ids: np.ndarray):
        self.doc_ids = doc_ids  # documents are numbered in the order of their ids, so ties go by number
        falling = np.lexsort((doc, -share, term))
        self.doc, self.share, by_term = doc[falling], share[falling], term[falling]
        self.terms, self.begin, self.size = np.unique(by_term, return_index=True, return_counts=True)
        # Direct access: (list, document) in order, and the position it has in its list.
        place = np.arange(len(falling)) - np.repeat(self.begin, self.size)
        lists = np.repeat(np.arange(len(self.terms)), self.size)
        key = lists * len(doc_ids) + self.doc
        order = np.argsort(key)
        self.key, self.place = key[order], place[order]

    def direct(self, lists: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, shares) of documents (columns) in lists (rows); -1 and 0 where a list lacks a document."""
        wanted = lists[:, None] * len(self.doc_ids) + docs[None, :]
        at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
        has = self.key[at] == wanted
        place = np.where(has, self.place[at], -1)
        share = np.where(has, self.share[np.minimum(self.begin[lists][:, None] + place, len(self.share) - 1)], 0)
        return place, share

    def best(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores, positions read) of the ``k`` best documents for the term numbers of ``query``."""
        at = np.searchsorted(self.terms, query)
        lists = at[(at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == query)]
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(lists):
            return docs, scores, 0
        begin, size = self.begin[lists], self.size[lists]
        seen = [np.zeros(s, bool) for s in size]
        met = np.zeros(len(self.doc_ids), bool)
        best_position = np.zeros(len(lists), np.int64)  # seen from the top
        depth, read = FIRST_DEPTH, np.zeros(len(lists), np.int64)
        while True:
            new = [self.doc[b + r : b + min(depth, s)] for b, r, s in zip(begin, read, size, strict=True)]
            read = np.minimum(depth, size)
            fresh = np.unique(np.concatenate(new))
            fresh = fresh[~met[fresh]]
            met[fresh] = True
            place, share = self.direct(lists, fresh)
            for i, flags in enumerate(seen):
                flags[place[i][place[i] >= 0]] = True
                flags[: read[i]] = True
                rest = flags[best_position[i] :]
                best_position[i] += len(rest) if rest.all() else int(np.argmin(rest))
            docs, scores = np.concatenate([docs, fresh]), np.concatenate([scores, share.sum(axis=0)])
            keep = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[keep], scores[keep]
            # The share at the best position bounds that of every document not seen in the list.
            bounds = np.where(best_position < size, self.share[begin + np.minimum(best_position, size) - 1], 0)
            if (best_position >= size).all() or (len(scores) == k and bounds.sum() < scores[-1]):
                found = scores > 0
                return docs[found], scores[found], int(read.sum())
            depth *= 2


def _shards(batches: Iterator[pd.DataFrame], postings: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(doc_ids, has_id, n, term, tf, row of each posting) of a partition, cut by number of postings."""
    held: list[pd.DataFrame] = []
    size = 0

    def cut() -> tuple[np.ndarray, ...]:
        rows = pd.concat(held, ignore_index=True)
        has_id = rows["doc_id"].notna().to_numpy(bool)
        ids = rows["doc_id"].fillna(0).to_numpy(np.int64)
        lengths = rows["term"].map(len).to_numpy(np.int64)
        row = np.repeat(np.arange(len(rows)), lengths)
        return ids, has_id, rows["n"].to_numpy(np.int64), np.concatenate(rows["term"].tolist()), np.concatenate(rows["tf"].tolist()), row

    for batch in batches:
        batch = batch[batch["term"].map(len) > 0]
        for at in range(0, len(batch), 1000):
            part = batch.iloc[at : at + 1000]
            held.append(part)
            size += int(part["term"].map(len).sum())
            if size >= postings:
                yield cut()
                held, size = [], 0
    if held:
        yield cut()


def _search_block(docs: DataFrame, items: list[tuple[int, list[str]]], k: int, postings: int) -> DataFrame:
    """(place, doc_id, score): the ``k`` best documents of every shard for every query (place, its terms)."""
    vocabulary = sorted({t for _, words in items for t in words})
    number = {t: i for i, t in enumerate(vocabulary)}
    found = stored(counted(docs, vocabulary))
    totals = found.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    n_docs, n_terms = int(totals[0]), int(totals[1] or 1)
    # One row per term of the block at most.
    df = {r[0]: r[1] for r in found.select(F.explode("term").alias("t")).groupBy("t").count().collect()}
    asked = [(place, np.array(sorted({number[t] for t in words}), np.int64)) for place, words in items]
    shared = docs.sparkSession.sparkContext.broadcast((weights(df, n_docs, len(vocabulary)), asked))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weight, queries = shared.value
        for ids, has_id, n, term, tf, row in _shards(batches, postings):
            order = np.lexsort((ids, ~has_id))
            place_of = np.empty(len(order), np.int64)
            place_of[order] = np.arange(len(order))
            share = shares(weight[term], tf.astype(np.int64), n[row], n_docs, n_terms)
            shard = Shard(term.astype(np.int64), place_of[row], share, ids[order])
            known = has_id[order]
            for place, query in queries:
                best, scores, _ = shard.best(query, k)
                if len(best):
                    doc_id = pd.Series(shard.doc_ids[best], dtype="Int64").where(pd.Series(known[best]))
                    yield pd.DataFrame({"place": place, "doc_id": doc_id, "score": scores})

    return found.select("doc_id", "n", "term", "tf").mapInPandas(search, "place long, doc_id long, score long")


def search(
    documents: DataFrame, items: DataFrame, k: int = TOP, block: int = BLOCK_CHARS, postings: int = POSTINGS,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` highest-scoring rows of ``documents`` for every row of ``items``."""
    spark = documents.sparkSession
    small_batches(spark)
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    asked = items.select(F.col(item_id).alias("item_id"), whole_text(item_text).alias("text"))
    asked = stored(asked.withColumn("place", F.monotonically_increasing_id()))
    size = asked.agg(F.sum(F.char_length("text"))).first()[0]
    if size is None:
        return asked.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.col("place").alias("score"))
    blocks = 1 + size // block
    results = []
    for number in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("place"), F.lit(blocks)) == number).select("place", "text").collect()
        if rows:
            results.append(_search_block(docs, [(r["place"], terms(r["text"])) for r in rows], k, postings))
    found = reduce(DataFrame.unionByName, results)
    order = Window.partitionBy("place").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("place", "item_id"), "place").select("item_id", "rank", "doc_id", "score")
