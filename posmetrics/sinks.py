"""Results and records as rows of text, CSV, JSON and Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from posmetrics.operators.listing import iso_text

_NESTED = (T.ArrayType, T.MapType, T.StructType)
_TIMES = (T.TimestampType, T.TimestampNTZType)


def flatten_nested(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs become JSON text; the rest stays typed."""
    return df.select(
        *(
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, _NESTED) else F.col(f.name)
            for f in df.schema.fields
        )
    )


def as_text(df: DataFrame) -> DataFrame:
    """Times as ISO text and nested values as JSON, as flat files hold them."""
    return flatten_nested(df).select(
        *(
            iso_text(F.col(f.name)).alias(f.name) if isinstance(f.dataType, _TIMES) else F.col(f.name)
            for f in df.schema.fields
        )
    )


def render(df: DataFrame, fmt: str = "dataframe") -> DataFrame:
    """``dataframe``, or one line of text per row as ``json`` or ``csv`` (no header)."""
    if fmt == "dataframe":
        return df
    row = F.struct(*as_text(df).columns)
    if fmt == "json":
        line = F.to_json(row, {"ignoreNullFields": "false"})
    elif fmt == "csv":
        line = F.to_csv(row, {"quote": '"', "escape": '"'})
    else:
        raise ValueError(f"cannot render {fmt!r}")
    return as_text(df).select(line.alias("line"))


def write_csv(df: DataFrame, path: str) -> None:
    """Header, comma, double quotes. Without rows there is only the header."""
    _csv_writer(as_text(df)).csv(path)


def _csv_writer(df: DataFrame):
    return df.write.mode("overwrite").options(header=True, quote='"', escape='"', emptyValue='""')


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_parquet(df: DataFrame, path: str) -> None:
    """Snappy; types are kept, also without rows."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
