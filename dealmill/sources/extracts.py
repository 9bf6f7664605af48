"""Text extracts: CSV files whose cells all stay text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealmill.schemas import RAW_COLUMNS, RAW_TABLES
from dealmill.session import at_once
from dealmill.sources.records import has_open_lines, numbered, placed, records

# Fixed value: how the extract files are named.
DEFAULT_TEMPLATE = "Таблица выгрузки Битрикс - {table}.csv"

_CSV = {
    "header": "true",
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


# Raw text of a row that is not as wide as its header.
_UNEVEN = "__uneven"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does any file match ``path`` (a file, a folder or a glob) on its file system?"""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    matches = fs.globStatus(hadoop_path)
    return matches is not None and len(matches) > 0


def _parsed_records(spark: SparkSession, path: str, header: list[str], schema: T.StructType) -> DataFrame:
    """id and cells of every record, line breaks inside quotes and all."""
    found = records(spark, path)
    # Line ends inside quotes stay as they are.
    options = {k: v for k, v in _CSV.items() if k not in ("header", "encoding")}
    options |= {"multiLine": "true", "columnNameOfCorruptRecord": _UNEVEN}
    names = F.from_csv(F.ltrim(F.col("record"), F.lit("\ufeff")), ", ".join(f"`{i}` string" for i in range(len(header))), options)
    other = F.raise_error(F.concat(F.lit("header differs from that of other files: "), F.col("__file"))).cast("boolean")
    same = F.when(F.to_json(names) == F.to_json(F.struct(*(F.lit(h).alias(str(i)) for i, h in enumerate(header)))), F.lit(False))
    data = F.when(F.col("ordinal") > 1, F.lit(True)).otherwise(F.coalesce(same, other))
    cells = F.from_csv("record", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)
    return found.where(data).select("id", cells.alias("c")).select("id", "c.*")


def read_extract(
    spark: SparkSession, table: str, path: str, multi_line: bool | str = "auto"
) -> DataFrame:
    """One extract as ``id`` plus text columns; empty cells are NULL, blanks within quotes stay.

    ``path`` may be a file, a folder of files or a glob.  Files are always read split by split.  Without line breaks
    inside quotes a line is a record (``multi_line=False``); with them records are found by
    composing the quotes of lines over splits (``True``, see ``records``), which shuffles the text.  ``"auto"``
    looks for such line breaks first, at the price of one pass over the text.

    A row with fewer cells than the header is filled up with NULL; one with more is an error when it is read.

    ``id`` counts rows from 1 on in the order of files (by path) and of rows in a file, whatever the size of splits.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no extract for table {table}: {path}")
    if multi_line == "auto":
        multi_line = has_open_lines(spark, path)
    reader = spark.read.options(**_CSV)

    header = reader.csv(path).columns
    unknown = set(header) - set(RAW_COLUMNS[table])
    if unknown:
        raise ValueError(f"extract {path} has columns unknown to table {table}: {sorted(unknown)}")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    wide = T.StructType([*schema.fields, T.StructField(_UNEVEN, T.StringType())])
    if multi_line:
        cells = _parsed_records(spark, path, header, wide)
    else:
        # Without pruning every row is split whole, and one that is not as wide as the header shows in _UNEVEN.
        reader = reader.option("enforceSchema", "false").option("columnNameOfCorruptRecord", _UNEVEN)
        scan = reader.schema(wide).option("columnPruning", "false").csv(path)
        cells = numbered(placed(scan), placed(spark.read.options(**_CSV).schema(schema).csv(path)))
    separators = F.length(F.regexp_replace(F.regexp_replace(_UNEVEN, r'"[^"]*"', ""), "[^,]", ""))
    too_wide = F.raise_error(F.concat(F.lit(f"{path}, table {table}: row wider than the header: "), F.col(_UNEVEN)))
    # The first column takes part because a scan of _UNEVEN alone is not allowed.
    fits = F.when(separators >= len(header), too_wide.cast("boolean")).otherwise(F.length(F.coalesce(header[0], F.lit(""))) >= 0)
    cells = cells.where(F.col(_UNEVEN).isNull() | fits)
    return cells.select(
        "id",
        *(
            F.col(name) if name in header else F.lit(None).cast("string").alias(name)
            for name in RAW_COLUMNS[table]
        ),
    )


def read_extracts(
    spark: SparkSession,
    folder: str,
    path_template: str = DEFAULT_TEMPLATE,
    multi_line: bool | str = "auto",
) -> dict[str, DataFrame]:
    """All 13 extracts of ``folder``; a missing one is an error."""
    found: dict[str, DataFrame] = {}

    def read(table: str) -> None:
        found[table] = read_extract(spark, table, f"{folder.rstrip('/')}/{path_template.format(table=table)}", multi_line)

    # Each file's header is read for its columns.
    at_once(read, RAW_TABLES)
    return {table: found[table] for table in RAW_TABLES}
