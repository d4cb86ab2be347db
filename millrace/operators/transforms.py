"""Record transforms: change-capture tags, time strings, unwrapping, and chains of them."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.decimals import let
from ..functions.json_decode import wrap
from ..functions.json_encode import encode
from ..plans.schema import NAME, SCHEMA, TIME, Schema

OP_FIELD = "__op"
#: Of each operation: the side of the envelope that is tagged, and the tag (0 upserts, 1 deletes).
OPERATIONS = {"c": ("after", 0), "u": ("after", 0), "d": ("before", 1)}
DAY_MS = 86_400_000
#: End of the schema names of change-capture envelopes, fixed by the envelope format.
ENVELOPE_NAME = ".Envelope"


def _struct(df: DataFrame, column: str) -> T.StructType | None:
    kind = df.schema[column].dataType
    return kind if isinstance(kind, T.StructType) else None


def _rebuilt(value: Column, kind: T.StructType, changed: dict[str, Column]) -> Column:
    """A struct with some fields changed or added at its end; null stays null. Written as a choice, so that a later step
    refers to it instead of having it copied into each of its own fields."""
    fields = [changed[f.name].alias(f.name) if f.name in changed else value.getField(f.name).alias(f.name, metadata=f.metadata) for f in kind.fields]
    added = [c.alias(n) for n, c in changed.items() if n not in kind.names]
    return F.when(value.isNotNull(), F.struct(*fields, *added))


def with_fields(df: DataFrame, column: str, changed: dict[str, Column]) -> DataFrame:
    """``df`` with fields of a struct column changed or added. The column's metadata stays."""
    field = df.schema[column]
    return df.withColumn(column, _rebuilt(F.col(column), field.dataType, changed)).withMetadata(column, field.metadata)


def schema_name(metadata: dict) -> str | None:
    """The schema name that field metadata hold."""
    return metadata.get(NAME) or (json.loads(metadata[SCHEMA]).get("name") if SCHEMA in metadata else None)


def is_envelope(name: str | None) -> bool:
    """Change-capture envelopes are told by the name of their schema."""
    return bool(name) and name.endswith(ENVELOPE_NAME)


def _taggable(kind: T.StructType | None, name: str | None) -> list[str]:
    """The sides that can be tagged: structs that have no tag yet, in a named envelope with a text ``op``."""
    if kind is None or not is_envelope(name) or "op" not in kind.names or not isinstance(kind["op"].dataType, T.StringType):
        return []
    return [s for s in ("after", "before") if s in kind.names and isinstance(kind[s].dataType, T.StructType) and OP_FIELD not in kind[s].dataType.names]


def tag_operations(df: DataFrame, column: str = "value") -> DataFrame:
    """Append ``__op`` to ``after`` (c, u: 0) or ``before`` (d: 1) of change-capture envelopes.

    An envelope is a struct column whose schema name (field metadata ``connect.name``, or the schema kept there) ends in
    ``.Envelope``; all else is returned as it is. A column has one type, so both sides are widened; ``__op`` is null
    wherever a record is left as it is (other operations, a null operation, a null side). Rows that are built with
    ``absent=("__op",)`` and :func:`encode_tagged` print such records without the key.
    """
    kind = _struct(df, column)
    sides = _taggable(kind, schema_name(df.schema[column].metadata))
    if not sides:
        return df
    value, changed = F.col(column), {}
    for side in sides:
        tag = F.coalesce(*[F.when(value["op"] == op, F.lit(t)) for op, (s, t) in OPERATIONS.items() if s == side])
        changed[side] = _rebuilt(value[side], kind[side].dataType, {OP_FIELD: tag})
    return with_fields(df, column, changed)


def encode_tagged(value: Column, schema: Schema) -> Column:
    """JSON text of an untagged envelope as tagging leaves it: each branch is encoded under its own schema."""
    fields = dict(schema.fields) if is_envelope(schema.name) else {}
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for op, (side, tag) in OPERATIONS.items():
        own = fields.get(side)
        if own is None or own.type != "struct" or OP_FIELD in dict(own.fields):
            continue
        changed = Schema("struct", own.optional, own.name, own.version, own.doc, own.parameters, fields=(*own.fields, (OP_FIELD, Schema("int32"))))
        whole = Schema("struct", schema.optional, schema.name, fields=tuple((n, changed if n == side else s) for n, s in schema.fields))
        tagged = encode(value.withField(side, value[side].withField(OP_FIELD, F.lit(tag))), whole)
        out = out.when((value["op"] == op) & value[side].isNotNull(), tagged)
    return out.otherwise(encode(value, schema))


def format_millis(millis: Column, pattern: str = "HH:mm:ss") -> Column:
    """Milliseconds of a day as text; hours are not cut at 24, a minus sign goes in front. Null stays null.

    ``HH:mm:ss.SSS`` adds milliseconds, any other pattern is ``HH:mm:ss``. The least 32-bit number is printed as what it
    is, where 32-bit negation would overflow.
    """
    x = millis.cast("bigint")
    a = F.abs(x)

    def two(number: Column) -> Column:
        return F.lpad(number.cast("string"), 2, "0")

    hours, minutes, seconds = F.call_function("div", a, F.lit(3_600_000)), F.call_function("div", a, F.lit(60_000)) % 60, F.call_function("div", a, F.lit(1000)) % 60
    parts = [F.when(x < 0, F.lit("-")).otherwise(F.lit("")), F.when(hours < 10, F.lit("0")).otherwise(F.lit("")), hours.cast("string"), F.lit(":"), two(minutes), F.lit(":"), two(seconds)]
    if pattern == "HH:mm:ss.SSS":
        parts += [F.lit("."), F.lpad((a % 1000).cast("string"), 3, "0")]
    spelled = F.concat(*parts)
    return F.when(millis.isNotNull(), spelled)


def parse_fields(text: str | None) -> list[str]:
    """Names split at commas with blanks around; blanks before the first and after the last name belong to them."""
    if not text:
        return []
    names = re.split(r"\s*,\s*", text)
    while names and not names[-1]:
        names.pop()
    return names


def _time_text(value: Column, kind: T.DataType, pattern: str) -> Column:
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return format_millis(value, pattern)
    if isinstance(kind, T.LongType):
        return format_millis(wrap(value, 32), pattern)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return format_millis(F.unix_millis(value.cast("timestamp")) % DAY_MS, pattern)
    if isinstance(kind, T.DateType):
        return format_millis(F.unix_date(value).cast("bigint") * DAY_MS % DAY_MS, pattern)
    return value.cast("string")


def times_to_text(df: DataFrame, column: str | None = "value", fields: str | list[str] = "", pattern: str = "HH:mm:ss") -> DataFrame:
    """Time fields of a struct column (``column=None``: of the frame itself) as text.

    Without ``fields`` every top-level field that is marked as a time is converted, with them exactly those named,
    whatever their type. Nested fields are left alone. With nothing to convert the frame is returned as it is.
    """
    kind = df.schema if column is None else _struct(df, column)
    if kind is None:
        return df
    names = parse_fields(fields) if isinstance(fields, str) else list(fields)
    chosen = [f for f in kind.fields if (f.name in names if names else f.metadata.get(NAME) == TIME and not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)))]
    if not chosen:
        return df
    if column is None:
        return df.withColumns({f.name: _time_text(F.col(f"`{f.name}`"), f.dataType, pattern) for f in chosen})
    # bound, so that the texts are a step of their own: with all steps in one, the generated method is too long to compile
    made = let(F.col(column), lambda v: _rebuilt(v, kind, {f.name: _time_text(v.getField(f.name), f.dataType, pattern) for f in chosen}))
    return df.withColumn(column, made).withMetadata(column, df.schema[column].metadata)


def unwrap(df: DataFrame, column: str = "value") -> DataFrame:
    """The row state of an envelope: ``after``, or ``before`` of a delete, with ``__deleted`` as text.

    An adapter for the step that stands between tagging and the sink; run :func:`times_to_text` after it, since that
    looks at top-level fields only.
    """
    value, kind = F.col(column), _struct(df, column)["after"].dataType
    deleted = F.when(value["op"] == "d", F.lit("true")).otherwise(F.lit("false"))
    return df.withColumn(column, _rebuilt(F.coalesce(value["after"], value["before"]), kind, {"__deleted": deleted}))


def chain(*transforms: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Transforms in their declared order as one."""

    def run(df: DataFrame) -> DataFrame:
        for step in transforms:
            df = df.transform(step)
        return df

    return run
