"""Helpers of the training-data operators: reading, stored steps, joins on hot keys, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealmill.session import checkpoint_dir

# Fixed value: a word is a run of anything but ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def row_key(df: DataFrame) -> Column:
    """Hash of all columns of a row: the same for rows that agree in every column, and never null."""
    return F.md5(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns))))


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder, without its lineage."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(checkpoint_dir(spark))
    return df.checkpoint(eager=True)


def hash_line(sample: int, rows: float) -> int:
    """Value that about ``sample`` of ``rows`` 64-bit hashes do not exceed."""
    return min(2**63 - 1, int((2.0 * min(1.0, sample / max(1.0, rows)) - 1.0) * 2.0**63))


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, so that very long texts do not pile up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def salted_lookup(rows: DataFrame, parents: DataFrame, keys: list[str], spread: str, salts: int = 16) -> DataFrame:
    """``rows`` left joined to the one row of ``parents`` with the same keys (nulls match nulls).

    Every key is cut into ``salts`` parts by a hash of ``spread``, a column that tells rows apart, and
    the parent row repeated once per part: a key with a third of all rows fills no single task.
    """
    left = rows.withColumn("__salt", F.pmod(F.xxhash64(F.col(spread)), F.lit(salts)).cast("int"))
    right = parents.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    for i, key in enumerate(keys):
        right = right.withColumnRenamed(key, f"__key{i}")
    match = left["__salt"] == right["__salt"]
    for i, key in enumerate(keys):
        match = match & left[key].eqNullSafe(right[f"__key{i}"])
    joined = left.join(right, match, "left")
    return joined.drop(left["__salt"]).drop(right["__salt"]).drop(*(f"__key{i}" for i in range(len(keys))))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): root is the smallest node of its component.

    Alternating stars: a round links all larger neighbours of a node to its smallest neighbour, then all
    smaller ones; rounds grow with the logarithm of the longest chain.  Every round is stored.
    """
    current = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    seen = None
    for _ in range(max_rounds):
        mark = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = mark
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
