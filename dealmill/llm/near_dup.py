"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: 3-word shingles (A-Z lower-cased, repeats included, joined by one space; a shorter text is one
shingle) vote with their XXH64 (seed 42) on 64 bits.  Two fingerprints link at ``RADIUS`` or fewer bits.

Candidates: bit i has a vector m(i) in {0,1}^(r+1).  For each non-zero v, a table compares only the bits
with <m(i), v> = 1.  Any r bits leave a non-zero v orthogonal to all their vectors, so every pair within
the radius agrees in some table: nothing is missed, and no bit sampling is left to luck.

Equal fingerprints are folded first.  A bucket is checked in chunks of ``BUCKET`` fingerprints, pair of
chunks by pair of chunks, and gives a spanning forest of its links, never all pairs.  Groups of links then
grow together (see ``components``).

Nulls and empty texts have fingerprint 0 and link like any other.  A null doc_id takes part in linking; a
component without any doc_id has a null id.  Repeated rows give repeated rows.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from dealmill.llm.common import components, row_key, salted_lookup, small_batches, stored, whole_text

RADIUS = 3
SHINGLE = 3
SEED = 42
BUCKET = 1024
_PIECE = 1 << 15

_digest = partial(xxhash.xxh64_intdigest, seed=SEED)


def text_fingerprint(text: str) -> int:
    """64-bit SimHash of one text, unsigned; long texts vote piece by piece."""
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        words = [b" ".join(words), *[b""] * (SHINGLE - 1)]
        shingles, n = iter(words[:1]), 1
    else:
        n = len(words) - SHINGLE + 1
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False))
    votes, left = np.zeros(64, np.int64), n
    while left:
        size = min(left, _PIECE)
        hashes = np.fromiter(map(_digest, (s for s, _ in zip(shingles, range(size), strict=False))), np.uint64, size)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.uint32)
        left -= size
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(text: Column) -> Column:
    @F.pandas_udf(LongType())
    def of(texts: pd.Series) -> pd.Series:
        values = np.fromiter(map(text_fingerprint, texts), np.uint64, len(texts))
        return pd.Series(values.view(np.int64))

    return of(text)


def masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """One mask of compared bits per table, ``2 ** (radius + 1) - 1`` of them."""
    vectors = 2 ** (radius + 1) - 1
    return [sum(1 << i for i in range(bits) if ((i % vectors + 1) & v).bit_count() % 2) for v in range(1, vectors + 1)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _forest(x: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect whatever is connected within ``x`` (distinct fingerprints)."""
    found = []
    while x.size:
        todo, x = [x[0]], x[1:]
        while todo and x.size:
            u = todo.pop()
            near = np.bitwise_count(x ^ u) <= radius
            if near.any():
                todo.extend(x[near])
                found.extend((int(u), int(v)) for v in x[near])
                x = x[~near]
    return found


def links(fingerprints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(a, b) links that connect the distinct longs of column ``fp`` wherever ``radius`` bits or fewer differ."""
    keys = [F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k")) for t, m in enumerate(masks(radius))]
    keyed = fingerprints.select("fp", F.explode(F.array(*keys)).alias("at")).select("fp", "at.t", "at.k")
    sizes = keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = keyed.join(sizes, ["t", "k"]).withColumn("parts", F.ceil(F.col("n") / bucket).cast("int"))
    mine = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    pairs = parts.withColumn("mine", mine).withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    groups = pairs.groupBy("t", "k", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")).agg(
        F.collect_list("fp").alias("fps")
    )

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [pair for fps in batch["fps"] for pair in _forest(np.asarray(fps, np.int64).view(np.uint64), radius)]
            ends = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pd.DataFrame({"a": ends[:, 0], "b": ends[:, 1]})

    return groups.where(F.size("fps") > 1).select("fps").mapInPandas(link, "a long, b long").distinct()


def _rooted(docs: DataFrame, first: Column) -> DataFrame:
    """(fp, first, root): one row per fingerprint with the aggregate ``first`` and a root that its component shares."""
    folded = stored(docs.groupBy("fp").agg(first.alias("first")))
    roots = components(links(folded.select("fp"))).withColumnRenamed("node", "fp")
    return folded.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    small_batches(df.sparkSession)
    docs = stored(df.select(F.col(doc_id).alias("doc_id"), _fingerprints(whole_text(text)).alias("fp")))
    rooted = _rooted(docs, F.min("doc_id"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    named = salted_lookup(docs, classes, ["fp"], "doc_id")
    return named.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_group(df: DataFrame) -> DataFrame:
    """One row of ``df`` per component: that with the smallest doc_id, null last; equal ids by a hash of the row."""
    small_batches(df.sparkSession)
    keyed = df.withColumn("__key", row_key(df))
    docs = keyed.select(
        F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__key").alias("row"), _fingerprints(whole_text()).alias("fp")
    )
    least = _rooted(docs, F.min("row")).groupBy("root").agg(F.min("first").alias("row"))
    return keyed.join(least.select("row.__key"), "__key", "left_semi").dropDuplicates(["__key"]).select(*df.columns)
