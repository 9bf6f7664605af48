"""SimHash fingerprints of 128 bits in SQL functions, and tables that find all within a Hamming radius.

Terms are pairs of adjacent words (one word alone: that word), each weighing as much as it occurs.  A term's
two hashes vote on the bits.  Votes are packed: ``h >> j & 0x0001000100010001`` holds four bits 16 bits apart,
so 16 sums of longs count 64 bits; texts are counted in pieces short enough for such a lane.

A null text is empty; no words give fingerprint 0.  Rows of equal doc_id and text are one place in the order
of documents; a null doc_id comes after all others, equal ids in the order of a hash of their texts.  An empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealmill.llm.common import WORD, salted_lookup, stored, whole_text

BITS = 128
_LANE = 0x0001000100010001
_PIECE = 16384


def _hashes(words: str) -> Column:
    """Hashes of the pairs of adjacent words in an array column."""
    several = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(1))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1)),
    )
    return F.when(F.size(words) > 0, several).otherwise(F.array().cast("array<bigint>"))


def simhash(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` and ``fp`` (array of two longs), one row per row of ``texts``; the keys tell rows apart.

    No shuffle happens where ``texts`` is already partitioned by some of the keys.
    """
    words = texts.select(*keys, F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"))
    terms = words.select(*keys, F.posexplode_outer(_hashes("words")).alias("i", "h0"))
    terms = terms.withColumn("piece", F.floor(F.coalesce("i", F.lit(0)) / _PIECE)).withColumn(
        "h1", F.when(F.col("h0").isNotNull(), F.xxhash64("h0", F.lit(1)))
    )
    lanes = [
        F.sum(F.shiftrightunsigned(h, j).bitwiseAND(F.lit(_LANE))).alias(f"{h}_{j}") for h in ("h0", "h1") for j in range(16)
    ]
    pieces = terms.groupBy(*keys, "piece").agg(F.count("h0").alias("n"), *lanes)
    # Lane l of the sum for j counts bit 16 l + j.
    lane_counts = lambda lane: lambda s: F.shiftrightunsigned(s, 16 * lane).bitwiseAND(F.lit(0xFFFF))
    votes = F.concat(*(
        F.transform(
            F.array(*(F.coalesce(F.col(f"{h}_{j}"), F.lit(0).cast("long")) for j in range(16))),
            lane_counts(lane),
        )
        for h in ("h0", "h1") for lane in range(4)
    ))
    counted = pieces.select(*keys, "n", votes.alias("v")).groupBy(*keys).agg(F.sum("n").alias("n"), F.collect_list("v").alias("vs"))
    none = F.array_repeat(F.lit(0).cast("long"), BITS)
    total = F.aggregate("vs", none, lambda a, v: F.zip_with(a, v, lambda x, y: x + y))
    counted = counted.select(*keys, "n", F.when(F.size("vs") == 1, F.get("vs", F.lit(0))).otherwise(total).alias("v"))

    def half(first: int) -> Column:
        ones = F.transform(
            F.slice("v", first + 1, 64),
            lambda x, i: F.when(2 * x > F.col("n"), F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")),
        )
        return F.aggregate(ones, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))

    return counted.select(*keys, F.array(half(0), half(64)).alias("fp"))


def distance(a: Column, b: Column) -> Column:
    """Differing bits of two fingerprints."""
    return sum((F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(2)), F.lit(0))


def likeness(a: Column, b: Column) -> Column:
    return F.lit(1.0) - distance(a, b).cast("double") / F.lit(float(BITS))


def as_text(fp: Column) -> Column:
    """Fingerprint as 32 hex digits."""
    return F.concat(*(F.lower(F.lpad(F.hex(F.get(fp, F.lit(i))), 16, "0")) for i in (1, 0)))


def within(queries: DataFrame, fingerprints: DataFrame, radius: int) -> DataFrame:
    """(query, match, distance): all pairs of fingerprints of the two tables (columns ``fp``) within ``radius`` bits.

    The bits are cut into radius + 2 blocks, of which any such pair shares two; each pair of blocks is a table
    whose key is those blocks put first.  Equal fingerprints are folded before.
    """
    n_blocks = radius + 2
    edges = [BITS * i // n_blocks for i in range(n_blocks + 1)]
    digits = F.concat(*(F.lpad(F.bin(F.get("fp", F.lit(i))), 64, "0") for i in (1, 0)))
    block = [F.substring("digits", edges[i] + 1, edges[i + 1] - edges[i]) for i in range(n_blocks)]
    keys = [F.concat(F.lit(f"{i}-{j}:"), block[i], block[j]) for i in range(n_blocks) for j in range(i)]

    def keyed(df: DataFrame, name: str) -> DataFrame:
        folded = df.select("fp").distinct().withColumn("digits", digits)
        return folded.select(F.col("fp").alias(name), F.explode(F.array(*keys)).alias("key"))

    found = keyed(queries, "query").join(keyed(fingerprints, "match"), "key")
    found = found.withColumn("distance", distance(F.col("query"), F.col("match"))).where(F.col("distance") <= radius)
    return found.select("query", "match", "distance").distinct()


def _chain(df: DataFrame) -> DataFrame:
    """(id, h, n_chars, next_id, next_h): every document and the next one in descending order of ids."""
    order = [F.col("id").desc_nulls_last(), F.col("h").desc()]
    keys = df.select("id", "h", "n_chars").distinct()
    ordered = stored(keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    here = Window.partitionBy("part").orderBy(*order)
    following = F.struct(F.col("id").alias("id"), F.col("h").alias("h"))
    ordered = ordered.withColumn("next", F.lead(following).over(here)).withColumn("place", F.row_number().over(here))
    # First document of each part: as many rows as parts.
    heads = ordered.where("place = 1").select("part", following.alias("head"))
    parts = Window.orderBy("part")
    heads = heads.withColumn("following", F.lead("head").over(parts)).withColumn(
        "following", F.coalesce("following", F.first("head").over(parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    chained = ordered.join(heads.select("part", "following"), "part").withColumn("next", F.coalesce("next", "following"))
    return stored(chained.select("id", "h", "n_chars", F.col("next.id").alias("next_id"), F.col("next.h").alias("next_h")))


def edited_fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text (second half from the next document), and likenesses."""
    docs = df.select(F.col(doc_id).alias("id"), whole_text(text).alias("t"))
    # (k, h) stands for a document in joins; k is never null.
    docs = docs.withColumn("k", F.xxhash64("id")).withColumn("h", F.xxhash64("t"))
    length = F.char_length("t").cast("long").alias("n_chars")
    chain = _chain(docs.select("id", "h", length))
    # What each document gives to the one before it is cut before it moves.
    wants = chain.select(
        F.xxhash64("next_id").alias("w_id"), F.col("next_h").alias("w_h"), F.floor(F.col("n_chars") / 2).cast("int").alias("want"),
        F.xxhash64("id").alias("to_id"), F.col("h").alias("to_h"),
    )
    gives = docs.join(wants, (docs["k"] == wants["w_id"]) & (docs["h"] == wants["w_h"]))
    gives = gives.select("to_id", "to_h", F.substring(F.col("t"), F.lit(1), F.col("want")).alias("given")).dropDuplicates(["to_id", "to_h"])
    # Both joins move the same columns of the documents by the same keys, so Spark moves them once.
    both = docs.join(gives, (docs["k"] == gives["to_id"]) & (docs["h"] == gives["to_h"])).select("k", "h", "t", "given", length)
    head = F.substring(F.col("t"), F.lit(1), (F.col("n_chars") - F.floor(F.col("n_chars") / 2)).cast("int"))
    both = both.select("k", "h", "n_chars", "t", F.concat(head, "given").alias("edited")).withColumn("row", F.monotonically_increasing_id())
    both = both.select(
        "k", "row", "h", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("t").alias("x")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("x")))).alias("e"),
    ).select("k", "row", "h", "n_chars", "edited_sha256", "e.which", "e.x")
    # The rows lie by (k, h) already: neither grouping moves them again.
    prints = simhash(both, ["k", "h", "row", "n_chars", "edited_sha256", "which"], "x")
    prints = prints.groupBy("k", "h", "row", "n_chars", "edited_sha256").agg(
        F.max(F.when(F.col("which") == 0, F.col("fp"))).alias("fp"), F.max(F.when(F.col("which") == 1, F.col("fp"))).alias("edited_fp")
    )
    prints = stored(prints)
    links = chain.select("id", F.xxhash64("id").alias("l_id"), F.col("h").alias("l_h"), F.xxhash64("next_id").alias("next_id"), "next_h")
    nexts = prints.select(F.col("k").alias("x_id"), F.col("h").alias("x_h"), F.col("fp").alias("next_fp")).dropDuplicates(["x_id", "x_h"])
    done = prints.join(links, (prints["k"] == links["l_id"]) & (prints["h"] == links["l_h"])).join(
        nexts, (F.col("next_id") == F.col("x_id")) & (F.col("next_h") == F.col("x_h"))
    )
    return done.select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
