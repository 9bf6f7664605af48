"""Removal of long repeated byte strings by induced suffix sorting.

Two equal strings of ``LENGTH`` bytes hold the same smallest hash of a ``GRAM``-byte substring at the same place
(an anchor), so only suffixes at anchors are sorted outright: by Spark's external sort, which merges sorted
runs on disk through a priority queue, group by group of equal substrings.  The order of the suffixes that
start one, two, ... bytes earlier is induced from it: tuples (byte before, rank) sort a step's suffixes, and
the common-prefix value of two neighbours is one more than the least between them in the step before.  A suffix
whose common prefix reaches ``LENGTH`` starts a repeated string.  A task streams its groups in chunks, so a
shard may be far larger than memory.

An anchor whose substring is very frequent is cut into ``HOT_RANGES`` ranges of starts, each keyed by all the
bytes that strings starting there have in common, which splits the group by content.

Equal texts are folded to one: texts of ``LENGTH`` bytes or more that occur twice are removed whole.  A null
text is empty, shorter texts keep everything.  Ids are only passed through.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealmill.llm.common import small_batches, stored, whole_text

LENGTH = 400
GRAM = 32
HOT, HOT_RANGES = 50_000, 16
_CHUNK = 16_384
_PIECE = 1 << 18


def _rolled(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` (a power of two) bytes, from hashes of half as many."""
    h, width, factor = data.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    while width < size:
        h = h[:-width] * np.uint64(factor) + h[width:]
        factor = factor * factor % (1 << 64) | 1
        width *= 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Places of the leftmost smallest hash in every string of ``length`` bytes, and these hashes."""
    places, values = [], []
    window = length - gram + 1
    for at in range(0, len(data) - length + 1, _PIECE):
        h = _rolled(np.frombuffer(data, np.uint8)[at : at + _PIECE + length - 1], gram)
        # Prefix minima within blocks from the right, and from the left, give every window's minimum.
        n = len(h) - window + 1
        padded = np.concatenate([h, np.full(-len(h) % window, ~np.uint64(0))]).reshape(-1, window)
        left = np.minimum.accumulate(padded, axis=1).ravel()
        right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(right[:n], left[window - 1 : window - 1 + n])
        # Windows of one smallest hash follow one another; a new anchor begins where it changes or is left behind.
        last = -1
        changes = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
        ends = np.append(changes[1:], n)
        for begin, end in zip(changes.tolist(), ends.tolist(), strict=True):
            hits = np.flatnonzero(h[begin : end + window - 1] == least[begin]) + begin
            # The leftmost hit at or after a start is that window's anchor.
            chosen = np.unique(hits[np.searchsorted(hits, np.arange(begin, end))]) if len(hits) > 1 else hits
            chosen = chosen[chosen > last]
            if len(chosen):
                last = int(chosen[-1])
                places.append(chosen + at)
                values.append(h[chosen])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    places, first = np.unique(np.concatenate(places), return_index=True)
    return places, np.concatenate(values)[first]


def _range_min(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least of values[first..last], for many ranges (first <= last)."""
    if not len(first):
        return np.zeros(0, values.dtype)
    level = np.frexp((last - first + 1).astype(float))[1] - 1
    tables = [values]
    for j in range(int(level.max())):
        t = tables[-1]
        tables.append(np.minimum(t[: len(t) - (1 << j)], t[1 << j :]))
    out = np.empty(len(first), values.dtype)
    for j in np.unique(level):
        at = level == j
        out[at] = np.minimum(tables[j][first[at]], tables[j][last[at] - (1 << int(j)) + 1])
    return out


def induced(groups: np.ndarray, bases: list[bytes], lefts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest number of bytes before each base at which a repeated string starts; -1 for none.

    ``bases`` are sorted within each of the ``groups``, which follow one another; ``lefts`` are the bytes before
    a base, the nearest first.
    """
    n = len(bases)
    size = np.array([len(b) for b in bases])
    matrix = np.frombuffer(b"".join(b.ljust(length, b"\0") for b in bases), np.uint8).reshape(n, length)
    reach = np.array([len(x) for x in lefts])
    steps = int(reach.max(initial=0))
    before = np.frombuffer(b"".join(x.ljust(steps, b"\0") for x in lefts), np.uint8).reshape(n, steps)
    differ = matrix[1:] != matrix[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    common = np.minimum(common, np.minimum(size[1:], size[:-1]))
    lcp = np.append(0, np.where(groups[1:] == groups[:-1], common, 0))  # with the suffix before in the order
    order, least, most = np.arange(n), np.full(n, -1), np.full(n, -1)
    for step in range(steps + 1):
        hit = lcp >= length
        hit[:-1] |= hit[1:]
        hits = order[hit]
        least[hits] = np.where(least[hits] < 0, step, least[hits])
        most[hits] = step
        # A suffix may go on if a neighbour shares enough to reach the length in the steps left.
        near = np.maximum(lcp, np.append(lcp[1:], 0))
        going = np.flatnonzero((near >= length - (steps - step)) & (reach[order] > step))
        if step == steps or len(going) < 2:
            break
        key = groups[order[going]] * 256 + before[order[going], step]
        sort = np.argsort(key, kind="stable")
        going, key = going[sort], key[sort]
        twins = np.flatnonzero(key[1:] == key[:-1]) + 1
        new = np.zeros(len(going), lcp.dtype)
        new[twins] = 1 + _range_min(lcp, going[twins - 1] + 1, going[twins])
        order, lcp = order[going], new
    return least, most


def _key(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2")


def _emit_anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per text and hash, with all its places there."""
    for batch in batches:
        rows = []
        for k1, k2, t in zip(batch["k1"], batch["k2"], batch["t"], strict=True):
            places, values = anchors(t.encode())
            order = np.argsort(values, kind="stable")
            values, places = values[order], places[order]
            cuts = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else []
            rows.extend((int(v), k1, k2, at) for v, at in zip(values[cuts].view(np.int64), np.split(places, cuts[1:]), strict=True) if len(at))
        yield pd.DataFrame(rows, columns=["h", "k1", "k2", "at"])


def _emit_suffixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Suffixes to sort.  One that a text holds twice with all that matters before and after it stands for all
    its places, and what it covers (``end`` is set) needs no sorting: periodic texts stay small."""
    whole, last = LENGTH - GRAM, None
    for batch in batches:
        rows = []
        for k1, k2, t, groups in zip(batch["k1"], batch["k2"], batch["t"], batch["places"], strict=True):
            if (k1, k2) == last:
                continue  # a copy of the text before
            last, data = (k1, k2), t.encode()
            seen: dict[tuple, list[int]] = {}
            for places in groups:
                cuts = [whole * i // HOT_RANGES for i in range(HOT_RANGES)] + [whole + 1] if places["hot"] else [0, whole + 1]
                for at in map(int, places["at"]):
                    for a, b in zip(cuts, cuts[1:], strict=False):
                        start, end = at - a, at - (b - 1) + LENGTH  # what strings starting at - b + 1 ... at - a share
                        if start >= 0 and end <= len(data):
                            left = data[max(0, at - b + 1) : start][::-1]
                            key = (xxhash.xxh64_intdigest(data[start:end], seed=a) - (1 << 63), data[start : start + LENGTH], left)
                            seen.setdefault(key, []).append(start)
            for (group, base, left), starts in seen.items():
                rows.append((group, base, left, k1, k2, starts[0], None))
                if len(starts) > 1 and len(base) + len(left) >= LENGTH:
                    begin = np.sort(np.array(starts)) - len(left)
                    split = np.flatnonzero(begin[1:] > begin[:-1] + len(base) + len(left)) + 1
                    rows.extend((group, None, None, k1, k2, int(x[0]), int(x[-1]) + len(base) + len(left)) for x in np.split(begin, split))
        frame = pd.DataFrame(rows, columns=["g", "base", "before", "k1", "k2", "at", "end"])
        yield frame.astype({"end": "Int64"})


def _induce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def spans(chunk: pd.DataFrame) -> pd.DataFrame:
        groups = np.cumsum(np.append(False, chunk["g"].to_numpy()[1:] != chunk["g"].to_numpy()[:-1]))
        least, most = induced(groups, list(map(bytes, chunk["base"])), list(map(bytes, chunk["before"])))
        hit = least >= 0
        at = chunk["at"].to_numpy()[hit]
        return pd.DataFrame({
            "k1": chunk["k1"].to_numpy()[hit], "k2": chunk["k2"].to_numpy()[hit], "first": at - most[hit], "end": at - least[hit] + LENGTH
        })

    held: list[pd.DataFrame] = []
    for batch in batches:
        done = batch["base"].isna()
        if done.any():
            yield batch.loc[done, ["k1", "k2", "at", "end"]].rename(columns={"at": "first"})
            batch = batch[~done]
        if not len(batch):
            continue
        held.append(batch)
        if sum(map(len, held)) >= _CHUNK:
            rows = pd.concat(held, ignore_index=True)
            whole = int(np.searchsorted(rows["g"].to_numpy(), rows["g"].iloc[-1]))  # the last group may go on
            if whole:
                yield spans(rows[:whole])
            held = [rows[whole:].reset_index(drop=True)]
    if held:
        yield spans(pd.concat(held, ignore_index=True))


def _merged(spans: Column) -> Column:
    """Sorted spans joined where they meet."""
    none = F.array().cast("array<struct<first:bigint,end:bigint>>")

    def add(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["first"].alias("first"), F.greatest(last["end"], span["end"]).alias("end"))
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))
        meets = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= span["first"])
        return F.when(meets, joined).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(spans, none, add)


def repeated_spans(df: DataFrame, text: str = "text") -> DataFrame:
    """(k1, k2, spans): maximal runs of repeated bytes, by the two hashes of a text; texts without any are left out."""
    docs = df.select(*_key(whole_text(text)), whole_text(text).alias("t"))
    long = docs.where(F.octet_length("t") >= LENGTH)
    found = long.mapInPandas(_emit_anchors, "h long, k1 long, k2 long, at array<long>")
    same = Window.partitionBy("h")
    place = F.struct("k1", "k2")
    counted = found.select("*", F.min(place).over(same).alias("a"), F.max(place).over(same).alias("b"), F.count(F.lit(1)).over(same).alias("n"))
    # Several texts have the hash, or one has it at several places; copies of a text give the same rows.
    twice = counted.where("a <> b or size(at) > 1").groupBy("k1", "k2").agg(
        F.collect_set(F.struct("h", "at", (F.col("n") > HOT).alias("hot"))).alias("places")
    )
    suffixes = long.join(twice, ["k1", "k2"]).select("k1", "k2", "t", "places").mapInPandas(
        _emit_suffixes, "g long, base binary, before binary, k1 long, k2 long, at long, end long"
    )
    ordered = suffixes.repartition("g").sortWithinPartitions("g", "base")
    spans = ordered.mapInPandas(_induce, "k1 long, k2 long, first long, end long")
    spans = spans.groupBy("k1", "k2").agg(F.sort_array(F.collect_set(F.struct("first", "end"))).alias("spans"))
    return spans.select("k1", "k2", _merged(F.col("spans")).alias("spans"))


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row: removed runs and the bytes that are left."""
    small_batches(df.sparkSession)
    docs = df.select(F.col(doc_id).alias("doc_id"), *_key(whole_text(text)), whole_text(text).alias("t"))
    copied = docs.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    # Stored: a row per text that has anything to remove.
    of = stored(repeated_spans(df, text).join(copied, ["k1", "k2"], "full"))
    n = F.octet_length("t").cast("long")
    rows = docs.join(of, ["k1", "k2"], "left").withColumn("n_bytes", n)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("n_bytes").alias("end")))
    spans = F.when((F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH), whole).otherwise(
        F.coalesce("spans", F.array().cast("array<struct<first:bigint,end:bigint>>"))
    )
    rows = rows.withColumn("spans", spans).withColumn("bytes", F.col("t").cast("binary"))
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").cast("binary").alias("out"))
    cut = lambda a, b: F.substring(F.col("bytes"), (a + 1).cast("int"), (b - a).cast("int"))
    kept = F.aggregate(
        "spans", begin,
        lambda done, s: F.struct(s["end"].alias("at"), F.concat(done["out"], cut(done["at"], s["first"])).alias("out")),
        lambda done: F.concat(done["out"], cut(done["at"], F.col("n_bytes"))),
    )
    return rows.select("doc_id", "n_bytes", "spans", kept.alias("kept"))


def digest(removed: DataFrame) -> DataFrame:
    """Counts and hash of ``remove_repeats``."""
    total = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["first"])
    return removed.select(
        "doc_id", "n_bytes", total.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
