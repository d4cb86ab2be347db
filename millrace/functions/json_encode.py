"""Schema-directed JSON encoding: one native expression for a whole record, built at plan time.

A subtree without maps of non-string keys becomes native values and one ``to_json``; a subtree with such a map is
spliced from texts, because its pairs hold different types.
"""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.config import SINK_CODEC, CodecConfig
from ..plans.schema import DATE, DECIMAL, TIME, TIMESTAMP, Schema
from .decimals import decimal_to_bytes

_KEEP = {"ignoreNullFields": "false"}


def _text_of(value: Column) -> Column:
    """The JSON text of any value that ``to_json`` can hold in an array, scalars and nulls included."""
    whole = F.to_json(F.array(value), _KEEP)
    return F.substring(whole, F.lit(2), F.length(whole) - 2)


def _has_pairs(schema: Schema) -> bool:
    if schema.type == "map":
        return schema.keys.type != "string" or _has_pairs(schema.values)
    if schema.type == "array":
        return _has_pairs(schema.items)
    return any(_has_pairs(s) for _, s in schema.fields)


def _default(schema: Schema) -> Column:
    """A schema's default as a value of its Spark type (defaults are kept as JSON)."""
    from .json_decode import decode_value

    return decode_value(schema, F.parse_json(F.lit(json.dumps(schema.default))), CodecConfig(), where="default")


def _with_null_rule(schema: Schema, value: Column, config: CodecConfig, where: str) -> Column:
    if schema.default is not None and config.replace_null_with_default:
        return F.coalesce(value, _default(schema))
    if schema.optional:
        return value
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(F.lit(f"{where} is null, but it is required and has no default")))


def _logical(schema: Schema, value: Column, config: CodecConfig) -> Column | None:
    if schema.name == DECIMAL:
        return value if config.decimal_format == "NUMERIC" else F.base64(decimal_to_bytes(value, schema.scale))
    if schema.name == DATE:
        return F.unix_date(value)
    if schema.name == TIMESTAMP:
        return F.unix_millis(value.cast("timestamp"))
    if schema.name == TIME:
        return value
    return None


def _native(schema: Schema, value: Column, config: CodecConfig, where: str) -> Column:
    """A value whose ``to_json`` is right."""
    value = _with_null_rule(schema, value, config, where)
    found = _logical(schema, value, config)
    if found is not None:
        return found
    if schema.type == "array":
        return F.transform(value, lambda x: _native(schema.items, x, config, f"{where}[]"))
    if schema.type == "map":
        return F.transform_values(value, lambda _, x: _native(schema.values, x, config, f"{where}{{}}"))
    if schema.type == "struct":
        fields = [_native(s, value[n], config, f"{where}.{n}").alias(n) for n, s in schema.fields]
        made = F.struct(*fields) if fields else F.from_json(F.lit("{}"), T.StructType())
        return F.when(value.isNotNull(), made)
    return value


def _text(schema: Schema, value: Column, config: CodecConfig, where: str) -> Column:
    """JSON text, ``null`` for null."""
    if not _has_pairs(schema):
        native = _native(schema, value, config, where)
        return F.coalesce(F.to_json(native, _KEEP), F.lit("null")) if schema.type == "struct" else _text_of(native)
    value = _with_null_rule(schema, value, config, where)
    if schema.type == "array":
        body = F.concat(F.lit("["), F.array_join(F.transform(value, lambda x: _text(schema.items, x, config, f"{where}[]")), ","), F.lit("]"))
    elif schema.type == "struct":
        parts = [F.concat(F.lit(("," if i else "") + json.dumps(n, ensure_ascii=False) + ":"), _text(s, value[n], config, f"{where}.{n}")) for i, (n, s) in enumerate(schema.fields)]
        body = F.concat(F.lit("{"), *parts, F.lit("}"))
    elif schema.keys.type == "string":
        entry = lambda e: F.concat(_text_of(e["key"]), F.lit(":"), _text(schema.values, e["value"], config, f"{where}{{}}"))
        body = F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(value), entry), ","), F.lit("}"))
    else:
        pair = lambda e: F.concat(F.lit("["), _text(schema.keys, e["key"], config, f"{where}<key>"), F.lit(","), _text(schema.values, e["value"], config, f"{where}{{}}"), F.lit("]"))
        body = F.concat(F.lit("["), F.array_join(F.transform(F.map_entries(value), pair), ","), F.lit("]"))
    return F.when(value.isNotNull(), body).otherwise(F.lit("null"))


def encode(value: Column, schema: Schema, config: CodecConfig = SINK_CODEC, absent: tuple[str, ...] = ()) -> Column:
    """JSON text of a value of any type, scalars too. A null value: ``null`` if optional, its default or an error.

    Fields of a struct that are named in ``absent`` are left out where they are null: records of one column then print as
    if each had a type of its own.
    """
    named = [n for n, _ in schema.fields if n in absent]
    if not named:
        return _text(schema, value, config, "value")
    without = replace(schema, fields=tuple((n, s) for n, s in schema.fields if n != named[0]))
    return F.when(value[named[0]].isNull(), encode(value, without, config, absent)).otherwise(encode(value, schema, config, tuple(named[1:])))


def encode_schemaless(value: Column, kind: T.DataType) -> Column:
    """JSON text of a value without schema: VARIANT or a type to infer one from. Null stays null."""
    if isinstance(kind, T.VariantType):
        return F.to_json(value)
    return F.when(value.isNotNull(), encode(value, Schema.from_data_type(kind)))


def envelope(payload: Column, schema: Schema | None) -> Column:
    """``{"schema":…,"payload":…}`` around encoded text."""
    head = json.dumps(schema.to_json_schema() if schema else None, ensure_ascii=False, separators=(",", ":"))
    return F.concat(F.lit(f'{{"schema":{head},"payload":'), F.coalesce(payload, F.lit("null")), F.lit("}"))


def to_bytes(value: Column, schema: Schema | None, kind: T.DataType | None = None, config: CodecConfig | None = None) -> Column:
    """Topic bytes of a value: enveloped where the codec's schemas are on. No schema and no value: null."""
    config = config or CodecConfig()
    text = encode(value, schema, config) if schema else encode_schemaless(value, kind)
    if config.schemas_enable:
        wrapped = envelope(text, schema)
        text = wrapped if schema else F.when(value.isNotNull(), wrapped)
    elif not schema:
        text = F.when(value.isNotNull(), text)
    return text.cast("binary")


def headers_to_bytes(headers: Column, schema: Schema, config: CodecConfig | None = None) -> Column:
    """An array of (key, value) headers with encoded values; names are left alone."""
    return F.transform(headers, lambda h: F.struct(h["key"].alias("key"), to_bytes(h["value"], schema, config=config).alias("value")))
