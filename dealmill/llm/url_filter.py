"""URL filter: rules first, then a ratio of two character language models.

Rules allow or block a host (with its subdomains) and a path prefix; the longest that fits wins.  URLs that
rules decide train two variable-order Markov models, accepted and rejected.  Each order mixes its counts with
the next lower order; an unseen context adds nothing.  Counts are exact: a table with a row for every context and
character, which grows with the URLs and is joined, never held whole by a task.  A URL is allowed when
the difference of log-likelihoods per byte reaches a line calibrated on a fifth of the decided URLs that is held out
from counting.

A null URL, and one without ``://``, has an empty host and path; null is scored as empty, with difference 0.
Without examples of both kinds every undecided URL is allowed.  Repeated rows count as often as they occur, under
whatever page_id, and URLs of any length are counted whole.  An empty table gives no rows; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealmill.llm.common import salted_lookup, stored

# Verdict, host and path of each rule.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
ORDERS = 5
MODELS = ["rejected", "accepted"]
STRENGTH = 2.0
BINS = 400
_UNIT = 1e9
_SPAN = 4.0  # differences per character are binned from -_SPAN to _SPAN


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL."""
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[\s\S]*?://([\s\S]*)$", 1)
    host = F.regexp_extract(after, "^[^/?#]*", 0)
    path = F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def rule_of(host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits, as host and path in one, and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, of, prefix in sorted(RULES, key=lambda r: len(r[1] + r[2])):
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(prefix)
        rule, verdict = F.when(fits, of + prefix).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _strings(urls: DataFrame, *columns: str) -> DataFrame:
    """(columns, gram): for each byte of ``url`` the ``ORDERS`` bytes that end with it, zeros before the start."""
    data = F.encode("url", "UTF-8")
    ends = F.when(F.octet_length(data) > 0, F.sequence(F.lit(1), F.octet_length(data)))
    padded = urls.select(*columns, F.concat(F.lit(bytearray(ORDERS - 1)), data).alias("data"), ends.alias("ends"))
    grams = F.transform("ends", lambda i: F.substring(F.col("data"), i, F.lit(ORDERS)))
    return padded.select(*columns, F.explode(grams).alias("gram"))


def _keys() -> list[Column]:
    """Of a gram, for every order: key of the last byte with its context (J), and of the context alone (C)."""
    out = []
    for order in range(ORDERS):
        start = F.lit(ORDERS - order)
        joint, context = F.substring("gram", start, F.lit(order + 1)), F.substring("gram", start, F.lit(order))
        for kind, key in (("J", joint), ("C", context)):
            out.append(F.struct(F.lit(f"{kind}{order}").alias("part"), F.concat(F.lit(f"{kind}{order}".encode()), key).alias("key")))
    return out


def count_strings(examples: DataFrame) -> DataFrame:
    """(key, rejected, accepted): exact counts of every context and character over examples (url, accepted, n).

    Only the longest strings are counted in the URLs; their counts are summed to those of shorter ones.
    """
    grams = _strings(examples, "accepted", "n").groupBy("gram").agg(
        *(F.sum(F.when(F.col("accepted") == (k == 1), F.col("n")).otherwise(0)).alias(name) for k, name in enumerate(MODELS))
    )
    keyed = grams.select(*MODELS, F.explode(F.array(*_keys())).alias("k")).select(*MODELS, "k.key")
    return keyed.groupBy("key").agg(*(F.sum(m).alias(m) for m in MODELS))


def log_ratios(urls: DataFrame, counts: DataFrame) -> DataFrame:
    """(url, log_ratio) of distinct ``urls``: accepted minus rejected log-likelihood, per byte; 0 for an empty URL.

    What a byte adds depends on it and the bytes of its context alone, so it is computed once per distinct
    string and looked up.  Hot strings, and the short contexts that many strings share, are cut into salted parts.
    Values are added up as whole numbers of ``_UNIT``, so the order of addition makes no difference.
    """
    urls = stored(urls.withColumn("id", F.monotonically_increasing_id()))  # long URLs are not carried along
    places = stored(_strings(urls, "id"))
    asked = places.select("gram").distinct().select("gram", F.explode(F.array(*_keys())).alias("k")).select("gram", "k.part", "k.key")
    found = salted_lookup(asked, counts, ["key"], "gram")
    names = [f"{kind}{order}" for order in range(ORDERS) for kind in "JC"]
    wide = found.groupBy("gram").agg(
        *(F.coalesce(F.max(F.when(F.col("part") == n, F.col(m))), F.lit(0)).cast("double").alias(f"{n}_{m}") for n in names for m in MODELS)
    )
    p = {m: F.lit(1.0 / 256) for m in MODELS}
    for order in range(ORDERS):
        wide = wide.withColumns({
            f"p{order}_{m}": (F.col(f"J{order}_{m}") + STRENGTH * p[m]) / (F.col(f"C{order}_{m}") + STRENGTH) for m in MODELS
        })
        p = {m: F.col(f"p{order}_{m}") for m in MODELS}
    value = F.round((F.log(p["accepted"]) - F.log(p["rejected"])) * _UNIT).cast("long")
    values = wide.select("gram", value.alias("value"))
    added = salted_lookup(places.withColumn("spread", F.monotonically_increasing_id()), values, ["gram"], "spread")
    summed = added.groupBy("id").agg((F.sum("value") / F.count(F.lit(1)) / _UNIT).alias("log_ratio"))
    return urls.join(summed, "id", "left").select("url", F.coalesce("log_ratio", F.lit(0.0)).alias("log_ratio"))


def threshold(bins: np.ndarray) -> float:
    """The difference that best splits (kind, bin) counts, by the mean of both rates of right decisions."""
    rejected, accepted = bins / np.maximum(1, bins.sum(axis=1, keepdims=True))
    rates = np.cumsum(np.append(0.0, rejected)) + np.append(0.0, np.cumsum(accepted[::-1]))[::-1]
    best = np.flatnonzero(rates >= rates.max() - 1e-12)
    return float((best[0] + best[-1]) / 2 / BINS * 2 * _SPAN - _SPAN)


def judge(df: DataFrame, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, log_ratio) of every row; log_ratio is null where a rule decides."""
    pages = df.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("given"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"))
    host, path = parts(F.col("given"))
    pages = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, by_rule = rule_of(F.col("host"), F.col("path"))
    pages = stored(pages.select("page_id", "url", "host", "path", rule.alias("rule"), by_rule.alias("by_rule")))
    open_, held = F.col("by_rule").isNull(), F.pmod(F.xxhash64("url"), F.lit(5)) == 0
    decided = pages.where(~open_).groupBy("url", (F.col("by_rule") == "allow").alias("accepted")).agg(F.count(F.lit(1)).alias("n"))
    examples = decided.where(~held)
    scored = stored(log_ratios(pages.where(open_ | held).select("url").distinct(), count_strings(examples)))
    kinds = {r["accepted"] for r in examples.where("url <> ''").select("accepted").distinct().collect()}
    if len(kinds) == 2:
        place = F.least(F.lit(BINS - 1), F.greatest(F.lit(0), F.floor((F.col("log_ratio") + _SPAN) / (2 * _SPAN) * BINS)))
        seen = decided.where(held).join(scored, "url").groupBy("accepted", place.alias("bin")).agg(F.sum("n").alias("n")).collect()
        bins = np.zeros((2, BINS))
        for r in seen:  # at most two rows per bin
            bins[int(r["accepted"]), r["bin"]] = r["n"]
        line = threshold(bins)
    else:
        line = -np.inf
    rows = pages.where(open_).withColumn("spread", F.monotonically_increasing_id())
    ratios = salted_lookup(rows, scored, ["url"], "spread")
    ratios = ratios.withColumn("verdict", F.when(F.col("log_ratio") >= F.lit(line), "allow").otherwise("block"))
    ruled = pages.where(~open_).withColumn("log_ratio", F.lit(None).cast("double")).withColumn("verdict", F.col("by_rule"))
    columns = ["page_id", "host", "path", "rule", "verdict", "log_ratio"]
    return ruled.select(*columns).unionByName(ratios.select(*columns))
