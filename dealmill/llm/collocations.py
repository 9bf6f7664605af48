"""Phrases of two to five words that stand together more often than their parts would by chance.

Top-order marginalisation: every word opens one window of ``LONGEST`` words, padded with nulls where its
piece of text ends.  Only these windows are counted; ROLLUP over the window's columns sums them to all shorter
prefixes, so one count per window serves phrases of every length, and the words of the language.

Windows are shortened before they are counted where a phrase across the next word cannot reach ``LEAST``
occurrences: sketches of at most ``2 ** SKETCH_BITS`` hashed counters say which pairs, then which three words, are
too rare for certain.  Words that share a counter only leave windows longer than need be: the result does not
depend on the sketches.  Their size is bounded, as every task gets them, so beyond some billions of words
they fill up and save less and less; windows are then counted as they are.

A null text is empty, a null language is ``und``.  Repeated rows count as often as they occur, whatever their
ids.  Texts are counted whole, whatever their length.  Equal scores are ordered by occurrences and phrase.
An empty table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealmill.llm.common import stored, whole_text

LONGEST = 5
LEAST = 100
TOP = 2000
SKETCH_BITS = 26
SKETCHED = (2, 3)
# Signs that end a piece of text; A to Z and tab, and what they become.
ENDS = r"[.,;:!?\x0A-\x0D]"
_FROM, _TO = "ABCDEFGHIJKLMNOPQRSTUVWXYZ\t", "abcdefghijklmnopqrstuvwxyz "
_EXACT = "decimal(38,0)"
_WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]


def windows(df: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, w1 .. w5) of every word: it and its followers in its piece, null beyond the end."""
    pieces = df.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.explode(F.split(F.translate(whole_text(text), _FROM, _TO), ENDS, -1)).alias("piece"),
    )
    pieces = pieces.select("lang", F.trim("piece").alias("piece")).where("piece <> ''")
    words = pieces.select("lang", F.split("piece", " +", -1).alias("words"))
    # The words beside themselves, each column one word ahead of the last.
    ahead = [F.slice("words", 1 + i, F.greatest(F.size("words") - i, F.lit(0))).alias(w) for i, w in enumerate(_WORDS)]
    return words.select("lang", F.inline(F.arrays_zip(*ahead)))


def _counter(words: list[str], bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64("lang", *words), 64 - bits)


def sketch(opened: DataFrame, size: int, least: int, bits: int) -> DataFrame:
    """One row, one array of longs: bit b is set if phrases of ``size`` words whose hash is b occur ``least`` times or more."""
    words = _WORDS[:size]
    counters = opened.where(F.col(words[-1]).isNotNull()).groupBy(_counter(words, bits).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    often = counters.where(F.col("n") >= least)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("b").bitwiseAND(F.lit(63)).cast("int"))
    set_bits = often.groupBy(F.shiftright("b", 6).alias("at")).agg(F.bit_or(bit).alias("word"))
    # One entry for each of the 2 ** (bits - 6) longs, set or not, in their order.
    places = opened.sparkSession.range(1 << (bits - 6)).select(F.col("id").alias("at"), F.lit(0).cast("long").alias("word"))
    return set_bits.unionByName(places).groupBy("at").agg(F.bit_or("word").alias("word")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]).alias("words")
    )


def shortened(opened: DataFrame, size: int, least: int, bits: int) -> DataFrame:
    """Windows cut before the first word that ends ``size`` words too rare, together, for certain."""
    often = stored(sketch(opened, size, least, bits)).select("words").scalar()

    def is_often(words: list[str]) -> Column:
        b = _counter(words, bits)
        word = F.get(often, F.shiftright(b, 6).cast("int"))
        bit = F.call_function("shiftrightunsigned", word, b.bitwiseAND(F.lit(63)).cast("int"))
        return F.col(words[-1]).isNotNull() & (bit.bitwiseAND(F.lit(1)) == 1)

    # Flags of their own, so that each is computed once.
    last = {w: _WORDS[i - size + 1 : i + 1] for i, w in enumerate(_WORDS) if i >= size - 1}
    flagged = opened.withColumns({f"often_{w}": is_often(words) for w, words in last.items()})
    columns, kept = [], F.lit(True)
    for w in _WORDS:
        kept = kept & F.col(f"often_{w}") if w in last else kept
        columns.append(F.when(kept, F.col(w)).alias(w))
    return flagged.select("lang", *columns)


def phrase_counts(df: DataFrame, least: int = LEAST, **columns: str) -> DataFrame:
    """(lang, size, phrase, f) of all phrases with ``least`` occurrences, and of size 0 (all words of the language)."""
    opened = windows(df, **columns)
    # A counter for about every third character, which is about two for every word.
    n = df.agg(F.sum(F.char_length(whole_text(columns.get("text", "text"))))).first()[0] or 0
    bits = min(SKETCH_BITS, max(16, (n // 3).bit_length()))
    for size in SKETCHED:
        opened = shortened(opened, size, least, bits)
    counted = opened.groupBy("lang", *_WORDS).agg(F.count(F.lit(1)).alias("n"))
    rolled = counted.rollup("lang", *_WORDS).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    # The grouping id of a prefix of k words has the LONGEST - k lowest bits set.
    size = F.lit(None).cast("int")
    for k in range(LONGEST + 1):
        size = F.when(F.col("level") == (1 << (LONGEST - k)) - 1, F.lit(k)).otherwise(size)
    rolled = rolled.withColumn("size", size).where(F.col("size").isNotNull())
    # A prefix that ends in padding is no phrase.
    words = [F.when(F.col("size") >= i, F.col(w)) for i, w in enumerate(_WORDS, 1)]
    whole = reduce(lambda a, b: a & b, ((F.col("size") < i) | F.col(w).isNotNull() for i, w in enumerate(_WORDS, 1)))
    rolled = rolled.where(whole & ((F.col("size") == 0) | (F.col("f") >= least)))
    return rolled.select("lang", "size", F.array_compact(F.array(*words)).alias("words"), "f")


def _phrase(words: Column) -> Column:
    return F.array_join(words, " ")


def collocations(df: DataFrame, least: int = LEAST, top: int = TOP, **columns: str) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language."""
    counts = stored(phrase_counts(df, least, **columns))
    totals = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    counts = counts.where("size > 0").select("lang", "size", "words", _phrase(F.col("words")).alias("phrase"), "f")
    candidates = counts.where("size > 1")

    # Parts of every cut, looked up among the counted phrases.
    cuts = candidates.select(
        "lang", "phrase", F.col("f").alias("a"), "words", "size", F.explode(F.expr("sequence(1, size - 1)")).alias("k")
    ).select(
        "lang", "phrase", "a", "k", _phrase(F.expr("slice(words, 1, k)")).alias("first"),
        _phrase(F.expr("slice(words, k + 1, size - k)")).alias("rest"),
    )
    parts = lambda key, f: counts.select("lang", F.col("phrase").alias(key), F.col("f").alias(f))
    cuts = cuts.join(parts("first", "l"), ["lang", "first"]).join(parts("rest", "r"), ["lang", "rest"]).join(totals, "lang")
    exact = lambda c: F.col(c).cast(_EXACT)
    cuts = cuts.withColumn("top", (F.lit(1000).cast(_EXACT) * exact("a") * exact("n")).cast(_EXACT))
    cuts = cuts.withColumn("bottom", (exact("l") * exact("r")).cast(_EXACT)).withColumn("score", F.expr("top div bottom"))
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # The longest count of any longer candidate around a phrase.
    longer = candidates.where("size > 2").select("lang", "words", "size", "f")
    longer = longer.select("lang", "words", "size", "f", F.explode(F.expr("sequence(2, size - 1)")).alias("m"))
    longer = longer.select("lang", "words", "f", "m", F.explode(F.expr("sequence(1, size - m + 1)")).alias("at"))
    around = longer.groupBy("lang", _phrase(F.expr("slice(words, at, m)")).alias("phrase")).agg(F.max("f").alias("around"))
    kept = scored.join(around, ["lang", "phrase"], "left").where(F.coalesce(F.col("around") < F.col("a"), F.lit(True)))

    first = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    return ranked.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("a").cast("long").alias("a"),
        F.col("cut.l").cast("long").alias("l"), F.col("cut.r").cast("long").alias("r"), F.col("n").cast("long").alias("n"),
        F.col("cut.score").cast("long").alias("score"),
    )
