"""Secret scan: credential spans of whole texts, weighed by how many owners have the same value.

Base kinds are found by pattern.  ``token`` spans are added: long runs of token characters that hold digits
and letters and no base span, kept only where the value looks live.  Every candidate value is hashed; a value
is *live* when at most ``MAX_OWNERS`` owners have it, in at most ``MAX_REPOSITORIES`` repositories, else a widely
copied *example*.

A null text is empty and has no spans; null owners and repositories count as one owner or repository of their
own; rows of the same doc_id are scanned one by one; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealmill.llm.common import row_key, salted_lookup, stored, whole_text

_ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
# Kind, pattern, group that is the value, least length of that value; in the order of the kinds.
BASE_KINDS = [
    ("assign", _ASSIGN, 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]{32,}", 0, 32),
]
ADDED_KIND = ("token", "[A-Za-z0-9+/_=-]{24,}", 0, 24)
KINDS = [*BASE_KINDS, ADDED_KIND]
MAX_OWNERS = 2
MAX_REPOSITORIES = 20


def _found(text: str, pattern: str, group: int) -> Column:
    """Matches of a pattern with the lengths of what lies before each; null where there are none."""
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x))
    hits = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(group)) if group else hits
    return F.when(F.col(text).rlike(pattern), F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), values.alias("value")))


def candidates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """One row per row of ``df``: row, doc_id, and for each kind an array of matches."""
    docs = df.select(
        F.col(doc_id).alias("doc_id"), F.col(repository).alias("repository"), F.col(owner).alias("owner"),
        whole_text(text).alias("t"),
    )
    found = docs.select("doc_id", "repository", "owner", *(_found("t", p, g).alias(k) for k, p, g, _ in KINDS))
    return found.withColumn("row", F.monotonically_increasing_id())


def _spans(scanned: DataFrame) -> DataFrame:
    """One row per span that is long enough: row, start, kind_no, kind, end, value and its hash."""
    parts = []
    for number, (kind, _, _, least) in enumerate(KINDS):
        one = scanned.where(F.col(kind).isNotNull()).select("row", "repository", "owner", F.posexplode(kind).alias("k", "m"))
        before = Window.partitionBy("row").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
        ends = F.sum(F.col("m.gap") + F.coalesce(F.char_length("m.hit"), F.lit(0))).over(before)
        one = one.withColumn("end", ends.cast("long")).where(F.col("m.hit").isNotNull())
        one = one.where(F.char_length("m.value") >= least)
        if kind == ADDED_KIND[0]:
            one = one.where(F.col("m.value").rlike("[0-9]") & F.col("m.value").rlike("[A-Za-z]"))
        parts.append(
            one.select(
                "row", "repository", "owner", F.lit(number).alias("kind_no"), F.lit(kind).alias("kind"),
                (F.col("end") - F.char_length("m.hit")).alias("start"), "end",
                F.sha2("m.value", 256).alias("hash"),
            )
        )
    spans = parts[0]
    for part in parts[1:]:
        spans = spans.unionByName(part)
    # An added span that touches a base span says nothing new.
    base = F.col("kind_no") < len(BASE_KINDS)
    order = Window.partitionBy("row").orderBy("start", "kind_no")
    last_end = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    next_start = F.min(F.when(base, F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    spans = spans.withColumn("last_end", last_end).withColumn("next_start", next_start)
    alone = (F.coalesce("last_end", F.lit(0)) <= F.col("start")) & (F.coalesce(F.col("next_start") >= F.col("end"), F.lit(True)))
    return spans.where(base | alone).drop("last_end", "next_start")


def ownership(spans: DataFrame) -> DataFrame:
    """(hash, n_repositories, n_owners): how widely each candidate value is spread over the corpus."""
    pairs = spans.groupBy("hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    key = lambda *c: F.to_json(F.struct(*c), {"ignoreNullFields": "false"})  # noqa: E731  nulls count as a value
    owners = pairs.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    n_owners = owners.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"))
    repositories = pairs.select("hash", key("repository").alias("r")).distinct()
    return repositories.groupBy("hash").agg(F.count(F.lit(1)).alias("n_repositories")).join(n_owners, "hash")


def scan(df: DataFrame, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES, **columns: str) -> DataFrame:
    """(doc_id, found) of every row.

    ``found`` is an array of spans by start and kind, with a flag ``live`` and the counts n_repositories and n_owners.
    """
    scanned = stored(candidates(df, **columns))
    spans = stored(_spans(scanned))
    judged = salted_lookup(spans, ownership(spans), ["hash"], "row")
    judged = judged.withColumn("live", (F.col("n_owners") <= max_owners) & (F.col("n_repositories") <= max_repositories))
    judged = judged.where((F.col("kind_no") < len(BASE_KINDS)) | F.col("live"))
    grouped = judged.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind_no", "end", "kind", "live", "n_repositories", "n_owners"))).alias("found")
    )
    return scanned.select("row", "doc_id").join(grouped, "row", "left").select(
        "doc_id", F.coalesce("found", F.array().cast(grouped.schema["found"].dataType)).alias("found")
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts, hash and text of the spans of ``scan``."""
    joined = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    base = F.filter("found", lambda s: s["kind_no"] < len(BASE_KINDS))
    count = lambda test: F.size(F.filter("found", test)).cast("long")
    of_kind = lambda number: lambda s: s["kind_no"] == number
    return found.select(
        "doc_id",
        *(count(of_kind(number)).alias(f"n_{kind}") for number, (kind, *_) in enumerate(BASE_KINDS)),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
        count(lambda s: s["live"]).alias("n_live"),
        count(lambda s: ~s["live"]).alias("n_example"),
    )


def redact(df: DataFrame, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """``df`` (columns of documents) with live spans replaced by ``<kind>``; texts without any stay as they are.

    Overlapping spans are replaced by the first one's kind.  n_chars is set anew where a text changes.  Rows
    find their spans by a hash of all columns, so null and repeated ids make no difference.
    """
    keyed = df.withColumn("__key", row_key(df))
    cuts = scan(keyed, max_owners, max_repositories, doc_id="__key")
    cuts = cuts.select(F.col("doc_id").alias("__key"), F.filter("found", lambda s: s["live"]).alias("__cuts"))
    cuts = cuts.where(F.size("__cuts") > 0).dropDuplicates(["__key"])
    rows = keyed.join(cuts, "__key", "left")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(done: Column, span: Column) -> Column:
        kept = F.substring(F.col("text"), (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        new = F.concat(done["out"], F.array(kept, F.concat(F.lit("<"), span["kind"], F.lit(">"))))
        return F.struct(
            F.greatest(done["at"], span["end"]).alias("at"), F.when(span["start"] >= done["at"], new).otherwise(done["out"]).alias("out")
        )

    def finish(done: Column) -> Column:
        rest = F.substring(F.col("text"), (done["at"] + 1).cast("int"), F.char_length("text"))
        return F.concat(F.concat_ws("", done["out"]), rest)

    text = F.when(F.col("__cuts").isNull(), F.col("text")).otherwise(F.aggregate("__cuts", start, step, finish))
    rows = rows.withColumn("text", text).withColumn(
        "n_chars", F.when(F.col("__cuts").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(df.schema["n_chars"].dataType))
    )
    return rows.select(*df.columns)
