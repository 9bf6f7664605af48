"""CSV records found in many tasks at once, and rows numbered in the order of their files.

A line break inside quotes does not end a record, and whether a line starts inside quotes depends on all lines
before it.  Every line is therefore read as a function of two values: what it ends in when it starts outside
quotes, and when it starts inside.  Such functions compose: a line either fixes the state, keeps it or flips it.  They
are composed over the lines of a split first, then over the splits of a file; so a file is read by many
tasks, and each line learns where it starts from one row per split.

Numbers work the same way: rows are counted per split, counts are summed over the splits of a file and over
files, and a row's number is the sum before its split and its place in the split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_SPLIT = ["__file", "__block"]


def placed(scan: DataFrame) -> DataFrame:
    """The rows of a file scan with __file, __block (start of the split) and __seq, which rises within a split."""
    return scan.select(
        "*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__seq"),
    )


def sum_before(column: str, by: list[str], order: list[str]) -> Column:
    """Sum of ``column`` over the earlier rows in ``order``, 0 on the first."""
    earlier = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(earlier), F.lit(0))


def offsets(splits: DataFrame) -> DataFrame:
    """``splits`` (__file, __block, rows) with ``offset``: rows of earlier files, and of earlier splits of the file.

    Files are ordered as a whole by path: one row per file, which the driver lists for any scan.
    """
    files = splits.groupBy("__file").agg(F.sum("rows").alias("__of_file"))
    files = files.withColumn("__before", sum_before("__of_file", [], ["__file"])).select("__file", "__before")
    inner = splits.withColumn("__within", sum_before("rows", ["__file"], ["__block"]))
    return inner.join(files, "__file").withColumn("offset", F.col("__before") + F.col("__within")).drop("__before", "__within")


def numbered(rows: DataFrame, counted: DataFrame) -> DataFrame:
    """``rows`` of ``placed`` with dense ``id`` from 1 on, in the order of files and of rows in a file.

    ``counted`` is a scan of the same files by the same options, of which only row counts are used.  Should the two
    scans ever be cut differently (the number of cores changed in between), the job stops with an error.
    """
    splits = counted.groupBy(*_SPLIT).agg(F.count(F.lit(1)).alias("rows"), F.min("__seq").alias("__first"))
    # One row per split, which the driver lists for the scan anyway; the rows themselves stay where they were read.
    joined = rows.join(F.broadcast(offsets(splits)), _SPLIT, "left")
    place = F.col("__seq") - F.col("__first")
    sound = F.coalesce((place >= 0) & (place < F.col("rows")), F.lit(False))
    changed = F.raise_error(F.concat(F.lit("splits changed while rows were numbered: "), F.col("__file")))
    number = F.when(sound, F.col("offset") + place + 1).otherwise(changed.cast("long"))
    return joined.withColumn("id", number).drop(*_SPLIT, "__seq", "rows", "__first", "offset")


def _ends_inside(line: Column, inside: bool) -> Column:
    """Is a quote open where ``line`` ends, given whether one was where it starts?

    States: 0 before a field or after a closing quote, 1 inside quotes, 2 in a field without quotes.  A quote opens
    only at the start of a field; right after a closing quote it is an escaped one; in a bare field it is text.
    """
    before_quotes = F.split(line, '"', -1)
    before_quotes = F.slice(before_quotes, 1, F.size(before_quotes) - 1)

    def step(state: Column, text: Column) -> Column:
        opens = text.endswith(",") | ((state == 0) & (text == ""))
        return F.when(state == 1, F.lit(0)).when(opens, F.lit(1)).otherwise(F.lit(2))

    return F.aggregate(before_quotes, F.lit(int(inside)), step) == 1


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all files with their place and ``from_out``, ``from_in``: is a quote open at the end of the line?"""
    found = placed(spark.read.option("lineSep", "\n").text(path))
    quoted = F.col("value").contains('"')
    return found.withColumn("from_out", F.when(quoted, _ends_inside(F.col("value"), False)).otherwise(F.lit(False))).withColumn(
        "from_in", F.when(quoted, _ends_inside(F.col("value"), True)).otherwise(F.lit(True))
    )


def has_open_lines(spark: SparkSession, path: str) -> bool:
    """Does any line end inside quotes that it opened?"""
    return not lines(spark, path).where("from_out").isEmpty()


def _carried(rows: DataFrame, by: list[str], order: str) -> DataFrame:
    """``rows`` with in_out, in_in: the state in which each row starts, given how its group starts.

    ``from_out`` and ``from_in`` give the state after a row for each state before it.  What counts is the last earlier row
    that fixes the state, and how many rows since then flip it.
    """
    earlier = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    fixes, flips = F.col("from_out") == F.col("from_in"), F.col("from_out") & ~F.col("from_in")
    rows = rows.withColumn("__flips", F.coalesce(F.count_if(flips).over(earlier), F.lit(0)))
    known = F.last(F.when(fixes, F.struct(F.col("from_out").alias("state"), F.col("__flips").alias("flips"))), ignorenulls=True)
    rows = rows.withColumn("__known", known.over(earlier))

    def state(start: bool) -> Column:
        since = F.col("__flips") - F.coalesce(F.col("__known.flips"), F.lit(0))
        return F.coalesce(F.col("__known.state"), F.lit(start)) != (since % 2 == 1)

    return rows.withColumn("in_out", state(False)).withColumn("in_in", state(True)).drop("__flips", "__known")


def records(spark: SparkSession, path: str) -> DataFrame:
    """(__file, ordinal, id, record): CSV records in the order of files; ordinal 1 of a file is its header.

    ``id`` counts all records but headers from 1 on.  Lines of blanks are no records.  A quote that is never closed
    makes the rest of its file one record.  Records of one line stay where their split was read; only records of
    several lines are put together by a further shuffle.
    """
    found = _carried(lines(spark, path), _SPLIT, "__seq")
    full = F.col("value").rlike(r"[^\x00-\x20]")
    after = lambda before: F.when(F.col(before), F.col("from_in")).otherwise(F.col("from_out"))
    splits = found.groupBy(*_SPLIT).agg(
        F.max_by(after("in_out"), "__seq").alias("from_out"), F.max_by(after("in_in"), "__seq").alias("from_in"),
        F.count_if(full & ~F.col("in_out")).alias("__out_rows"), F.count_if(full & ~F.col("in_in")).alias("__in_rows"),
    )
    splits = _carried(splits, ["__file"], "__block").select(
        *_SPLIT, F.col("in_out").alias("__inside"),
        F.when(F.col("in_out"), F.col("__in_rows")).otherwise(F.col("__out_rows")).alias("rows"),
    )
    splits = splits.withColumn("__within", sum_before("rows", ["__file"], ["__block"]))
    # Every file begins with one record that is its header.
    files = splits.groupBy("__file").agg(F.greatest(F.sum("rows") - 1, F.lit(0)).alias("__data"))
    files = files.withColumn("__before", sum_before("__data", [], ["__file"])).select("__file", "__before")

    inside = F.when(F.col("__inside"), F.col("in_in")).otherwise(F.col("in_out"))
    joined = found.join(splits.drop("rows").join(files, "__file"), _SPLIT).withColumn("__inside", inside)
    starts = full & ~F.col("__inside")
    here = Window.partitionBy(*_SPLIT).orderBy("__seq").rowsBetween(Window.unboundedPreceding, 0)
    joined = joined.withColumn("ordinal", F.col("__within") + F.count_if(starts).over(here)).where(full | F.col("__inside"))
    open_after = F.when(F.col("__inside"), F.col("from_in")).otherwise(F.col("from_out"))
    whole = ~F.col("__inside") & ~open_after
    single = joined.where(whole).select("__file", "__before", "ordinal", F.col("value").alias("record"))
    parts = F.array_sort(F.collect_list(F.struct("__block", "__seq", "value")))
    several = joined.where(~whole).groupBy("__file", "__before", "ordinal").agg(
        F.array_join(F.transform(parts, lambda x: x["value"]), "\n").alias("record")
    )
    both = single.unionByName(several)
    ended = F.col("record").endswith("\r")
    record = F.when(ended, F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return both.select("__file", "ordinal", (F.col("__before") + F.col("ordinal") - 1).alias("id"), record.alias("record"))
