"""Parquet tables: raw and typed tables in numbered, published versions, and a work area."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone
from itertools import count

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealmill.schemas import (
    ACTIONS, CORE_SCHEMAS, CORE_TABLES, FACT_DATES, LABELS, PRIMARY_KEYS, RAW_TABLES, raw_schema,
)

_DIGITS = 12

# Of stored tables: a third smaller than Spark's default.
COMPRESSION = "zstd"

# Rows of the issue log in a file.
ROWS_PER_FILE = 250_000


def _join(*parts: str) -> str:
    return "/".join([parts[0].rstrip("/"), *parts[1:]])


def content_hash(df: DataFrame) -> Column:
    """Sum of row hashes: the same for the same rows in any order, and mergeable over parts of a table."""
    return F.coalesce(F.sum(F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))


class WorkArea:
    """Tables kept between steps in shared storage, so that a lost executor costs no lineage."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self._numbers = count()

    def keep(self, df: DataFrame) -> DataFrame:
        """Store ``df`` and give it back as a scan of what was stored."""
        path = _join(self.root, f"{next(self._numbers):04d}")
        df.write.parquet(path, compression=COMPRESSION)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Delete all that was kept here."""
        delete(self.spark, self.root)


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def delete(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.delete(hadoop_path, True)


class Version:
    """Raw and typed tables of one load, invisible to readers until published.

    Every write observes what it writes (rows, content hash) in the writing job itself; issues by type and reaction are
    counted in the stored log.  ``publish`` puts these figures next to the version, where readers find them without reading a table.
    """

    def __init__(self, store: TableStore, name: str):
        self.store, self.name = store, name
        self.figures: dict[str, dict[str, dict]] = {"raw": {}, "core": {}}
        self.issues: list[list] = []

    def _write(self, layer: str, table: str, df: DataFrame) -> None:
        seen = Observation()
        dates = [c for t, c in FACT_DATES if t == table and layer == "core"]
        latest = [F.to_date(F.max(c)).cast("string").alias(f"latest_{c}") for c in dates]
        # The observation is the last step before the writer, so a task run twice is counted once.
        observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), content_hash(df).alias("hash"), *latest)
        observed.write.mode("overwrite").parquet(self.store.path(layer, self.name, table), compression=COMPRESSION)
        figures = seen.get
        self.figures[layer][table] = {"rows": figures["rows"], "hash": str(figures["hash"])}
        if dates:
            self.figures[layer][table]["latest"] = {c: figures[f"latest_{c}"] for c in dates}

    def write_raw(self, table: str, df: DataFrame) -> None:
        self._write("raw", table, df)

    def write(self, table: str, df: DataFrame) -> None:
        """Write a typed table range-sorted by its key: the files in their order hold the keys in theirs."""
        typed = self._typed(table, df)
        self._write("core", table, typed.repartitionByRange(PRIMARY_KEYS[table]).sortWithinPartitions(PRIMARY_KEYS[table]))
        if table == "data_quality_issues":
            self._count_issues()

    def write_log(self, log: DataFrame, rows: int | None = None, rows_per_file: int = ROWS_PER_FILE) -> None:
        """Write the issue log in the order of its ids.

        A log whose ids are 1 to ``rows`` is laid out first: the file of a row follows from its id, so the log is not sampled
        for the bounds of ranges.  Without ``rows`` its tasks must hold its rows in order already, as those of ``numbered_log`` do.
        """
        placed = self._typed("data_quality_issues", log)
        if rows is not None:
            files = max(1, -(-rows // rows_per_file))
            placed = placed.repartitionById(files, F.expr(f"cast((id - 1) div {rows_per_file} as int)")).sortWithinPartitions("id")
        self._write("core", "data_quality_issues", placed)
        self._count_issues()

    def raw_rows(self, table: str) -> int:
        """Rows of a raw table that was written."""
        return self.figures["raw"][table]["rows"]

    def _count_issues(self) -> None:
        # One pass over two columns of the stored log; a count per type observed on every row takes longer than the write.
        log = self.store.core("data_quality_issues", self.name)
        self.issues = [list(r) for r in log.groupBy("issue_type", "action").count().collect()]

    @staticmethod
    def _typed(table: str, df: DataFrame) -> DataFrame:
        return df.select(*(F.col(f.name).cast(f.dataType) for f in CORE_SCHEMAS[table]))

    def raw_tables(self) -> dict[str, DataFrame]:
        return {table: self.store.raw(table, self.name) for table in RAW_TABLES}

    def tables(self) -> dict[str, DataFrame]:
        return {table: self.store.core(table, self.name) for table in CORE_TABLES}

    def publish(self) -> int:
        """Make this the version readers see; returns its number."""
        return self.store.publish({"version": self.name, "figures": self.figures, "issues": self.issues})

    def discard(self) -> None:
        """Delete what this load wrote; it was never published."""
        for layer in ("raw", "core"):
            delete(self.store.spark, self.store.path(layer, self.name))


class TableStore:
    """Raw and typed tables under one root folder.

    A load replaces all tables at once: it writes a new version next to the one in use and then
    publishes it, so that readers never meet half a load.

    Published versions are numbered.  A number is taken by creating its manifest, which fails if another load has
    taken it meanwhile; the next one is tried then.  The greatest number is what readers see: the
    order is that of publishing, whatever the clocks of the loading machines say.  This needs a file system on which
    creating a file without overwriting is atomic.  A manifest cut short by a crash is passed over.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def path(self, *parts: str) -> str:
        return _join(self.root, *parts)

    def begin_version(self) -> Version:
        """A version with a name of its own; the time in it is for readers only."""
        stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S")
        return Version(self, f"{stamp}-{uuid.uuid4().hex}")

    # manifests --------------------------------------------------------------

    def _numbers(self) -> list[int]:
        """Numbers taken so far, the greatest first."""
        fs, folder = _fs(self.spark, self.path("published"))
        if not fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(folder)]
        return sorted((int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit()), reverse=True)

    def _manifest_path(self, number: int) -> str:
        return self.path("published", f"{number:0{_DIGITS}d}.json")

    def _create(self, number: int, content: str) -> bool:
        """Create the manifest of ``number``; False if there is one."""
        fs, path = _fs(self.spark, self._manifest_path(number))
        try:
            out = fs.create(path, False)
        except Py4JJavaError as error:
            if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        try:
            out.write(bytearray(content.encode()))
        finally:
            out.close()
        return True

    def publish(self, manifest: dict) -> int:
        content, number = json.dumps(manifest), max(self._numbers(), default=0) + 1
        while not self._create(number, content):
            number += 1
        return number

    def _read_manifest(self, number: int) -> dict | None:
        fs, path = _fs(self.spark, self._manifest_path(number))
        data = fs.open(path)
        try:
            content = self.spark._jvm.org.apache.commons.io.IOUtils.toString(data, "UTF-8")
        finally:
            data.close()
        try:
            return json.loads(content)
        except ValueError:
            return None

    def manifest(self, version: str | None = None) -> dict:
        """Number, version, figures and issue counts of the published load, or of a named version."""
        for number in self._numbers():
            found = self._read_manifest(number)
            if found is not None and version in (None, found["version"]):
                return found | {"number": number}
        raise FileNotFoundError(f"no load was published under {self.root}" + (f" as {version}" if version else ""))

    def current_version(self) -> str:
        return self.manifest()["version"]

    # tables -----------------------------------------------------------------

    def raw(self, table: str, version: str | None = None) -> DataFrame:
        return self._read("raw", table, raw_schema(table), version)

    def core(self, table: str, version: str | None = None) -> DataFrame:
        """Typed table of the published (or a named) version; unknown names are a KeyError."""
        return self._read("core", table, CORE_SCHEMAS[table], version)

    def _read(self, layer: str, table: str, schema: T.StructType, version: str | None) -> DataFrame:
        version = self.current_version() if version is None else version
        return self.spark.read.schema(schema).parquet(self.path(layer, version, table))

    def tables(self) -> dict[str, DataFrame]:
        """All typed tables of the published version."""
        version = self.current_version()
        return {table: self.core(table, version) for table in CORE_TABLES}

    # what the manifest knows: no table is read ----------------------------------

    def _rows(self, rows: list[tuple], schema: str) -> DataFrame:
        return self.spark.createDataFrame(rows, schema)

    def summary(self, version: str | None = None) -> DataFrame:
        """(kind, name, rows): typed tables, then issues by reaction, as ``run_summary`` counts them."""
        found = self.manifest(version)
        loaded = [("table", t, found["figures"]["core"][t]["rows"]) for t in RAW_TABLES]
        by_action = [("issues", a, sum(n for _, x, n in found["issues"] if x == a)) for a in ACTIONS]
        return self._rows(loaded + by_action, "kind string, name string, rows long")

    def quality_by_type(self) -> DataFrame:
        """(issue_type, action, count) of the issue log."""
        return self._rows([tuple(x) for x in sorted(self.manifest()["issues"])], "issue_type string, action string, count long")

    def table_counts(self) -> DataFrame:
        """(name, label, count) of every typed table, in the order of the data model."""
        core = self.manifest()["figures"]["core"]
        return self._rows([(t, LABELS[t], core[t]["rows"]) for t in CORE_TABLES], "name string, label string, count long")

    def cutoff_date(self) -> DataFrame:
        """(cutoff_date): the latest day on which anything happened, in session time when the load was written."""
        core = self.manifest()["figures"]["core"]
        days = [core[t]["latest"][c] for t, c in FACT_DATES]
        latest = max((d for d in days if d), default=None)
        return self._rows([(latest,)], "day string").select(F.col("day").cast("date").alias("cutoff_date"))

    def first_rows(self, table: str, limit: int) -> DataFrame:
        """Rows among which are the ``limit`` rows of smallest key: only the first files of the typed table are opened."""
        folder = self.path("core", self.current_version(), table)
        fs, path = _fs(self.spark, folder)
        names = [status.getPath().getName() for status in fs.listStatus(path)]
        files = sorted((n for n in names if n.startswith("part-")), key=lambda n: int(n.split("-")[1]))
        reader, taken = self.spark.read.schema(CORE_SCHEMAS[table]), 1
        while True:
            df = reader.parquet(*(_join(folder, n) for n in files[:taken]))
            if taken >= len(files) or df.count() >= limit:  # a count reads the footers
                return df
            taken *= 4

    def verify(self) -> DataFrame:
        """(layer, table, rows, written, intact): what every table of the published version holds against what was written.

        One damaged, lost, added or exchanged row changes the sum of row hashes.
        """
        found = self.manifest()
        parts = []
        for layer, read in (("raw", self.raw), ("core", self.core)):
            for table, figures in found["figures"][layer].items():
                df = read(table, found["version"])
                held = df.agg(F.count(F.lit(1)).alias("rows"), content_hash(df).cast("string").alias("hash"))
                intact = (F.col("rows") == figures["rows"]) & (F.col("hash") == figures["hash"])
                parts.append(held.select(
                    F.lit(layer).alias("layer"), F.lit(table).alias("table"), "rows",
                    F.lit(figures["rows"]).cast("long").alias("written"), intact.alias("intact"),
                ))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    # cleaning up ------------------------------------------------------------

    def _version_folders(self) -> set[str]:
        found = set()
        for layer in ("raw", "core"):
            fs, folder = _fs(self.spark, self.path(layer))
            if fs.exists(folder):
                found |= {status.getPath().getName() for status in fs.listStatus(folder)}
        return found

    def _drop(self, versions: set[str]) -> int:
        for version in versions:
            Version(self, version).discard()
        return len(versions)

    def drop_superseded(self) -> int:
        """Delete the tables of all versions published before the current one; returns how many."""
        current = self.manifest()
        earlier = (self._read_manifest(n) for n in self._numbers() if n < current["number"])
        return self._drop(({m["version"] for m in earlier if m} & self._version_folders()) - {current["version"]})

    def drop_unpublished(self) -> int:
        """Delete what crashed loads left behind; only while no load is running.  Returns how many."""
        published = {m["version"] for m in map(self._read_manifest, self._numbers()) if m}
        return self._drop(self._version_folders() - published)

    # work -----------------------------------------------------------------

    def begin_work(self, shared_folder: str) -> WorkArea:
        return WorkArea(self.spark, _join(shared_folder, f"load-{uuid.uuid4().hex}"))
