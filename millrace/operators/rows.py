"""Records to text rows, and rows to tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ConfigError, DataError
from ..functions.json_encode import encode, encode_schemaless
from ..plans.config import SINK_CODEC
from ..plans.routing import table_for
from ..plans.schema import Schema


def build_rows(df: DataFrame, form: str = "json", schema: Schema | None = None, column: str = "value", absent: tuple[str, ...] = ()) -> DataFrame:
    """Add ``row``; records without a value (tombstones) go, empty texts stay.

    csv: the value is the row and must be text. json: the value encoded under ``schema``, else under the schema that the
    column's type and metadata give; a plain text is a JSON string, it is not parsed. Null fields named in ``absent``
    are left out.
    """
    kind = df.schema[column].dataType
    value = F.col(column)
    if form == "csv":
        if not isinstance(kind, T.StringType):
            raise DataError(f"{kind.simpleString()} cannot be cast to string")
        row = value
    elif form == "json":
        if isinstance(kind, T.VariantType):
            row = encode_schemaless(value, kind)
        else:
            row = encode(value, schema or Schema.from_data_type(kind, metadata=df.schema[column].metadata), SINK_CODEC, absent)
    else:
        raise ConfigError("data format are not support")
    return df.filter(value.isNotNull()).withColumn("row", row)


def route(df: DataFrame, tables: dict[str, str], topic: str = "topic") -> DataFrame:
    """Add ``tbl``, the table of each row's topic."""
    return df.withColumn("tbl", table_for(F.col(topic), tables))


def row_bytes(df: DataFrame) -> DataFrame:
    """tbl, n_rows, n_bytes: what a load of the rows amounts to (UTF-8)."""
    return df.groupBy("tbl").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.octet_length("row")).alias("n_bytes"))
