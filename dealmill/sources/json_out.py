"""Rows as JSON text: amounts as strings, dates and times in ISO form, NULLs written out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_safe(name: str, kind: T.DataType) -> Column:
    """One column in the form it takes inside a JSON document."""
    cell = F.col(f"`{name}`")
    if isinstance(kind, T.DecimalType):
        return cell.cast("string").alias(name)
    if isinstance(kind, T.DateType):
        return F.date_format(cell, "yyyy-MM-dd").alias(name)
    if isinstance(kind, T.TimestampType):
        whole = F.date_trunc("second", cell) == cell
        return (
            F.when(whole, F.date_format(cell, "yyyy-MM-dd'T'HH:mm:ssxxx"))
            .otherwise(F.date_format(cell, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))
            .alias(name)
        )
    return cell


def to_json_rows(df: DataFrame) -> DataFrame:
    """One ``json`` text column, keys in column order."""
    safe = F.struct(*(json_safe(f.name, f.dataType) for f in df.schema))
    return df.select(F.to_json(safe, {"ignoreNullFields": "false"}).alias("json"))


def write_json_rows(df: DataFrame, path: str) -> None:
    """One JSON document per line, written in parallel."""
    to_json_rows(df).write.mode("overwrite").text(path)
