"""Schema-directed JSON decoding: VARIANT in, typed values out, with the record format's own coercions.

Scalars are lenient (text read as a number is 0, a fraction is cut, integers keep their low bits), containers and logical
types are strict and raise. Each node of a value is taken out of its parent once and bound, so the plan grows with the
schema and not with the product of its levels.

Variants keep the members of an object sorted by name: an object that is read as an array gives its values in that order.
Of numbers beyond 38 digits, which variants hold as doubles, no low bits are known; they give 0.
"""

from __future__ import annotations

import json
from dataclasses import replace
from functools import lru_cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import DataError
from ..plans.config import CodecConfig
from ..plans.schema import DATE, DECIMAL, TIME, TIMESTAMP, Schema
from .decimals import bytes_to_decimal, let

_WHOLE = "decimal(38,0)"


def parse(text: Column) -> Column:
    """A VARIANT of JSON text. Of a key that is given twice the last value counts; the session is set to allow it."""
    session = SparkSession.getActiveSession()
    if session is not None:
        session.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return F.parse_json(text)


def _fail(message: str, kind: Column) -> Column:
    return F.raise_error(F.concat(F.lit(message + ", not "), kind))


def _is_number(kind: Column) -> Column:
    return kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")


def wrap(value: Column, bits: int) -> Column:
    """The low ``bits`` bits of a long as a signed number."""
    top = 1 << (bits - 1)
    return value.bitwiseAND(F.lit((1 << bits) - 1)).bitwiseXOR(F.lit(top)) - F.lit(top)


def _low_bits(whole: Column) -> Column:
    """The low 64 bits of a whole decimal as a signed long."""
    word, half = (F.lit(str(1 << n)).cast(_WHOLE) for n in (64, 63))
    return let(F.pmod(whole, word).cast(_WHOLE), lambda rest: (rest - F.when(rest >= half, word).otherwise(F.lit(0).cast(_WHOLE))).cast("bigint"))


def _integer(value: Column, kind: Column) -> Column:
    """The whole part of a number, beyond 64 bits its low ones; 0 for anything else."""
    zero = F.lit(0).cast("bigint")
    large = F.coalesce(F.try_variant_get(value, "$", "decimal(38,9)"), F.try_variant_get(value, "$", _WHOLE))
    whole = F.when(large < 0, F.ceil(large)).otherwise(F.floor(large)).cast(_WHOLE)
    known = F.try_variant_get(value, "$", "bigint")
    return F.when(_is_number(kind), F.coalesce(known, _low_bits(whole), zero)).otherwise(zero)


def _scalar(schema: Schema, value: Column, kind: Column) -> Column:
    if schema.type == "boolean":
        return F.when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean")).otherwise(F.lit(False))
    if schema.type in ("int8", "int16", "int32"):
        return wrap(_integer(value, kind), int(schema.type[3:])).cast(schema.data_type())
    if schema.type == "int64":
        return _integer(value, kind)
    if schema.type in ("float", "double"):
        return F.when(_is_number(kind), F.try_variant_get(value, "$", "double")).otherwise(F.lit(0.0)).cast(schema.data_type())
    text = F.when(kind == "STRING", F.try_variant_get(value, "$", "string"))
    if schema.type == "string":
        return text
    if schema.type == "bytes":
        return F.to_binary(text, F.lit("base64"))
    raise DataError(f"Unknown schema type: {schema.type}")


def _logical(schema: Schema, value: Column, kind: Column) -> Column | None:
    if schema.name == DECIMAL:
        number = F.try_variant_get(value, "$", f"decimal(38,{schema.scale})")
        data = bytes_to_decimal(F.to_binary(F.when(kind == "STRING", F.try_variant_get(value, "$", "string")), F.lit("base64")), schema.scale)
        return F.when(_is_number(kind), number).when(kind == "STRING", data).otherwise(_fail("A decimal is read from numeric or bytes values", kind))
    number = F.try_variant_get(value, "$", "bigint")
    if schema.name in (DATE, TIME):
        what, low, high = schema.name.rpartition(".")[2].lower(), -(2**31), 2**31 - 1
        made = F.date_from_unix_date(number.cast("int")) if schema.name == DATE else number.cast("int")
        return F.when((kind == "BIGINT") & number.between(low, high), made).otherwise(_fail(f"A {what} is read from an integer of 32 bits", kind))
    if schema.name == TIMESTAMP:
        return F.when(kind == "BIGINT", F.timestamp_millis(number)).otherwise(_fail("A timestamp is read from an integral number", kind))
    return None


def _container(schema: Schema, value: Column, kind: Column, config: CodecConfig, where: str) -> Column:
    items, is_object, is_array = F.try_variant_get(value, "$", "array<variant>"), kind.startswith("OBJECT"), kind.startswith("ARRAY")
    members = F.try_variant_get(value, "$", "map<string,variant>")
    if schema.type == "array":
        # the format reads the values of whatever has some: of an object its members' ones, of a scalar none
        found = F.coalesce(F.when(is_array, items).when(is_object, F.map_values(members)), F.array().cast("array<variant>"))
        return F.transform(found, lambda x: decode_value(schema.items, x, config, f"{where}[]"))
    if schema.type == "struct":
        fields = [decode_value(s, F.try_variant_get(value, _path(n), "variant"), config, f"{where}.{n}").alias(n) for n, s in schema.fields]
        return F.when(is_object, F.struct(*fields)).otherwise(_fail("Structs are read from JSON objects", kind))
    if schema.keys.type == "string":
        made = F.transform_values(members, lambda _, x: decode_value(schema.values, x, config, f"{where}{{}}"))
        return F.when(is_object, made).otherwise(_fail("Maps with text keys are read from JSON objects", kind))

    def pair(entry: Column) -> Column:
        both = F.try_variant_get(entry, "$", "array<variant>")
        made = F.struct(decode_value(schema.keys, both[0], config, f"{where}<key>").alias("key"), decode_value(schema.values, both[1], config, f"{where}{{}}").alias("value"))
        wrong = F.when(~F.schema_of_variant(entry).startswith("ARRAY"), _fail("A map entry has to be an array tuple", F.schema_of_variant(entry)))
        return wrong.when(F.size(both) != 2, _fail("A map entry has to be of length 2", F.size(both).cast("string"))).otherwise(made)

    def last_of_each_key(pairs: Column) -> Column:
        keys = F.transform(pairs, lambda e: e["key"])
        return F.filter(pairs, lambda e, i: F.array_position(F.slice(keys, i + 2, F.size(keys)), e["key"]) == 0)

    made = F.map_from_entries(let(F.transform(items, pair), last_of_each_key))
    return F.when(is_array, made).otherwise(_fail("Maps with other than text keys are read from a JSON array of tuples", kind))


def _path(name: str) -> str:
    return f"$[{json.dumps(name, ensure_ascii=False)}]" if '"' not in name else f"$['{name}']"


def decode_value(schema: Schema, value: Column, config: CodecConfig | None = None, where: str = "value") -> Column:
    """A typed value from a VARIANT. JSON null and an absent field are null: the default, null or an error."""
    config = config or CodecConfig()
    if schema.default is not None and config.replace_null_with_default:
        missing = decode_value(_plain(schema), parse(F.lit(json.dumps(schema.default))), config, f"{where} default")
    elif schema.optional:
        missing = F.lit(None)
    else:
        missing = F.raise_error(F.lit(f"{where} is null, and its {schema.type} schema is required and has no default"))

    def known(v: Column, kind: Column) -> Column:
        made = _logical(schema, v, kind)
        if made is None:
            made = _container(schema, v, kind, config, where) if schema.type in ("array", "map", "struct") else _scalar(schema, v, kind)
        return F.when(kind.isNull() | (kind == "VOID"), missing).otherwise(made)

    return let(value, lambda v: let(F.schema_of_variant(v), lambda kind: known(v, kind))).cast(_nullable(schema.data_type()))


def _nullable(kind: T.DataType) -> T.DataType:
    """The type with null allowed everywhere inside, as every computed value may be; field metadata stays."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(_nullable(kind.keyType), _nullable(kind.valueType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True, f.metadata) for f in kind.fields])
    return kind


def _plain(schema: Schema) -> Schema:
    return replace(schema, default=None)


def decode(text: Column, schema: Schema, config: CodecConfig | None = None) -> Column:
    """A typed value from JSON text under a schema. Malformed JSON raises."""
    return decode_value(schema, parse(text), config)


def decode_schemaless(text: Column) -> Column:
    """A VARIANT of a whole document: integers stay whole, other numbers exact, keys are sorted, of equal ones the last."""
    return parse(text)


_ENVELOPE = 'A message with a schema is an object of "schema" and "payload", without additional fields'


def _checked(text: Column) -> Column:
    keys = F.array_distinct(F.json_object_keys(text))
    good = (F.size(keys) == 2) & F.array_contains(keys, "schema") & F.array_contains(keys, "payload")
    message = _ENVELOPE
    return F.when(text.isNull(), text).when(F.coalesce(good, F.lit(False)), text).otherwise(F.raise_error(F.lit(message)))


def from_bytes(data: Column, schema: Schema | None = None, config: CodecConfig | None = None) -> Column:
    """A value from topic bytes; null bytes (a tombstone) are null.

    Schemas on: the payload of an envelope of exactly ``schema`` and ``payload``, typed by ``schema``, or a VARIANT where that
    is None. Schemas off: the whole document as a VARIANT (or typed, if a schema is given all the same).
    """
    config = config or CodecConfig()
    text = data.cast("string")
    document = parse(_checked(text) if config.schemas_enable else text)
    payload = F.try_variant_get(document, "$.payload", "variant") if config.schemas_enable else document
    if schema is None:
        return payload
    return F.when(data.isNotNull(), decode_value(schema, payload, config))


def headers_from_bytes(headers: Column, schema: Schema | None = None, config: CodecConfig | None = None) -> Column:
    """An array of (key, value) headers with decoded values; names are left alone."""
    return F.transform(headers, lambda h: F.struct(h["key"].alias("key"), from_bytes(h["value"], schema, config).alias("value")))


@lru_cache(maxsize=16)
def _schemas(size: int):
    """A cache of that many parsed schemas, by their text."""
    return lru_cache(maxsize=size)(Schema.from_json_schema)


def envelope_schema(text: str, config: CodecConfig | None = None) -> Schema | None:
    """The schema that one message carries, for building the plan of its topic; so many as the codec caches are kept."""
    document = json.loads(text)
    if not isinstance(document, dict) or set(document) != {"schema", "payload"}:
        raise DataError(_ENVELOPE)
    return _schemas((config or CodecConfig()).schemas_cache_size)(json.dumps(document["schema"], sort_keys=True))
