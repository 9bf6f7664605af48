"""Quality rules whose thresholds follow each language and source.

Every document gets counts and rates.  Mergeable quantile sketches per (lang, source) give the quartiles of
each rate, backed by those of the language and the corpus where rows are few; a rate may lie ``SPREADS``
interquartile ranges (and at least a small step) beyond its median.
Documents outside of any bound, or failing the two fixed base rules, are not kept.

A null text has no words and fails.  Null lang or source is a group of its own.  Repeated rows count as often
as they occur.  A doc_id that is null or repeated makes no difference.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealmill.llm.common import BLANK, WORD, salted_lookup, stored, whole_text

SPREADS = 6.0
BACK_OFF = 5.0
# Rate to (least step above the median, is a low value bad too).  Steps are in the unit of the rate.
RATES = {
    "symbol_rate": (0.08, False),
    "upper_rate": (0.20, False),
    "mark_rate": (0.08, False),
    "dup_line_rate": (0.25, False),
    "repeat_rate": (0.25, False),
    "word_length": (2.5, True),
}
UPPER, MARKS = "[A-ZÀ-ÖØ-Þ]", "[!-/:-@\\[-`{-~]"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SALTS = 32


def _repeat_words(df: DataFrame) -> DataFrame:
    """``df`` with n_repeat_words, the words of column ``words`` inside 3-word windows found twice or more.

    Windows are found by a sort of longs (hash above, place below) and then compared word by word.
    """
    df = df.withColumn("bits", F.length(F.bin(F.size("words").cast("long"))))
    packed = F.transform(
        F.slice("words", 1, F.greatest(F.size("words") - 2, F.lit(0))),
        lambda w, i: F.call_function(
            "shiftleft", F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)), F.col("bits")
        ).bitwiseOR(i.cast("long")),
    )
    df = df.withColumn("packed", F.sort_array(packed))
    top = lambda x: F.call_function("shiftright", x, F.col("bits"))
    twin = lambda x, i: (top(x) == top(F.get("packed", i + 1))) | (top(x) == top(F.get("packed", i - 1)))
    df = df.withColumn("likely", F.filter("packed", twin)).drop("packed")
    low = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bits")) - 1

    def window(x: Column) -> Column:
        at = x.bitwiseAND(low).cast("int")
        return F.struct(F.array(*(F.get("words", at + i) for i in range(3))).alias("w"), at.alias("at"))

    df = df.withColumn("windows", F.when(F.size("likely") > 0, F.array_sort(F.transform("likely", window))))
    same = lambda x, i: (x["w"] == F.get("windows", i + 1)["w"]) | (x["w"] == F.get("windows", i - 1)["w"])
    places = F.sort_array(F.transform(F.filter("windows", same), lambda x: x["at"]))
    df = df.withColumn("places", places).drop("windows", "likely", "bits")
    steps = F.transform("places", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("places", i + 1) - x, F.lit(3))))
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("places")


def measure(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """doc_id, lang, source, the counts and the rates of every row."""
    docs = df.select(
        F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"), whole_text(text).alias("t")
    )
    docs = docs.withColumn("words", F.regexp_extract_all("t", F.lit(WORD), F.lit(0)))
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(WORD))
    docs = docs.withColumn("lines", lines)
    count = lambda pattern: F.regexp_count(F.col("t"), F.lit(pattern)).cast("long")
    docs = docs.select(
        "doc_id", "lang", "source", "words",
        F.size("words").cast("long").alias("n_words"),
        (F.char_length("t") - count(BLANK)).cast("long").alias("word_chars"),
        count("[#*$%&|<>]").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        count(UPPER).alias("n_upper"),
        count(MARKS).alias("n_marks"),
    )
    docs = _repeat_words(docs).drop("words")
    rate = lambda top, bottom: F.when(F.col(bottom) > 0, F.col(top).cast("double") / F.col(bottom).cast("double"))
    return docs.select(
        "doc_id", "lang", "source", *COUNTS,
        rate("n_symbols", "word_chars").alias("symbol_rate"),
        rate("n_upper", "word_chars").alias("upper_rate"),
        rate("n_marks", "word_chars").alias("mark_rate"),
        rate("n_dup_lines", "n_lines").alias("dup_line_rate"),
        rate("n_repeat_words", "n_words").alias("repeat_rate"),
        rate("word_chars", "n_words").alias("word_length"),
    )


def thresholds(measured: DataFrame, spreads: float = SPREADS) -> DataFrame:
    """(lang, source, <rate>_low, <rate>_high), one row per group.

    Quartiles of every group, language and the corpus come from sketches that merge upwards (one ROLLUP).  A
    language's are mixed with the corpus's, then a group's with its language's, each counting as its rows
    against ``BACK_OFF`` rows of the level above.  The spread is twice the narrower half of the interquartile range, so
    junk on one side of the median, up to half of a source, does not widen the bounds that should catch it.
    """
    sketched = measured.rollup("lang", "source").agg(
        F.grouping_id().alias("level"), F.count(F.lit(1)).cast("double").alias("n"),
        *(F.percentile_approx(r, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.lit(10000)).alias(r) for r in RATES),
    )
    named = lambda level, prefix: sketched.where(F.col("level") == level).select(
        "lang", "source", *(F.col(c).alias(f"{prefix}_{c}") for c in ("n", *RATES))
    )
    corpus, languages, groups = named(3, "c").drop("lang", "source"), named(1, "l").drop("source"), named(0, "g")
    # One row for the corpus, one per language: what they add to the group's row.
    levels = languages.join(F.broadcast(corpus)).withColumnRenamed("lang", "__lang")
    joined = groups.join(levels, F.col("lang").eqNullSafe(F.col("__lang")))

    def mixed(own: str, above: Column, rate: str, i: int) -> Column:
        mine, n = F.coalesce(F.get(f"{own}_{rate}", F.lit(i)), above), F.col(f"{own}_n")
        return (n * mine + F.lit(BACK_OFF) * F.coalesce(above, mine)) / (n + F.lit(BACK_OFF))

    bounds = []
    for r, (step, both) in RATES.items():
        q1, q2, q3 = (mixed("g", mixed("l", F.get(f"c_{r}", F.lit(i)), r, i), r, i) for i in range(3))
        reach = F.greatest(F.lit(2 * spreads) * F.least(q2 - q1, q3 - q2), F.lit(step))
        bounds += [(q2 - reach if both else F.lit(None).cast("double")).alias(f"{r}_low"), (q2 + reach).alias(f"{r}_high")]
    return joined.select("lang", "source", *bounds)


def judge(df: DataFrame, spreads: float = SPREADS, **columns: str) -> DataFrame:
    """doc_id, counts, base_failed and kept of every row."""
    # Read for the thresholds and for the verdict; rows are told apart by their place, as ids may be null or repeated.
    measured = stored(measure(df, **columns).withColumn("row", F.monotonically_increasing_id()))
    bounded = salted_lookup(measured, thresholds(measured, spreads), ["lang", "source"], "row", _SALTS)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    inside = F.lit(True)
    for r in RATES:
        inside &= F.coalesce(F.col(r) <= F.col(f"{r}_high"), F.lit(True)) & F.coalesce(F.col(r) >= F.col(f"{r}_low"), F.lit(True))
    return bounded.select("doc_id", *COUNTS, failed.alias("base_failed"), (~failed & inside).alias("kept"))
