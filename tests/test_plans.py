"""Delimiters, topic maps, settings and schemas."""

import pytest
from pyspark.sql import types as T

from millrace.errors import ConfigError, DataError
from millrace.functions.delimiter import parse_delimiter
from millrace.plans.config import CodecConfig, SinkConfig, validate, with_defaults
from millrace.plans.routing import parse_topic_map, topic_map, valid_table_name
from millrace.plans.schema import DATE, DECIMAL, Schema

GOOD = {"store.http.url": "a:1,b:2", "store.database.name": "db", "store.username": "u", "store.password": ""}


@pytest.mark.parametrize("text,want", [(None, "\n"), ("", "\n"), (",", ","), (r"\x0A", "\n"), (r"\X0102", "\x01\x02"), (r"\xE4", "￤"), ("x0A", "x0A")])
def test_delimiters(text, want):
    assert parse_delimiter(text, "\n") == want


@pytest.mark.parametrize("text,error", [(r"\x", "empty"), (r"\x0", "length"), (r"\xZZ", "format"), (r"\x01\x02", "format")])
def test_bad_delimiters(text, error):
    with pytest.raises(ConfigError, match=error):
        parse_delimiter(text)


@pytest.mark.parametrize("text,want", [("a:t1,b:t2", {"a": "t1", "b": "t2"}), (" a : t1 ", {"a": "t1"}), ("a:tb:", {"a": "tb"}), ("a:tb,", {"a": "tb"}), ("a", None), ("a:b:c", None), ("", None), ("a:t,b", None)])
def test_topic_maps(text, want):
    assert parse_topic_map(text) == want


@pytest.mark.parametrize("text", ["a:t", "a:t1,a:t2"])
def test_bad_topic_maps(text):
    with pytest.raises(ConfigError):
        parse_topic_map(text)


def test_malformed_map_means_identity():
    assert topic_map("a") == {} and topic_map(None) == {}


@pytest.mark.parametrize("name,ok", [("ab", 1), ("db.tb", 1), ("aa.bb.cc", 1), ("a1$", 1), ("a", 0), ("1a", 0), ("c.d.e", 0), ("aa.bb.cc.dd", 0), ("ab\n", 0)])
def test_table_names(name, ok):
    assert valid_table_name(name) is bool(ok)


def test_settings_defaults_and_prefixes():
    c = SinkConfig.from_dict({**GOOD, "sink.properties.Strip": "Yes", "sink.properties.row_delimiter": r"\x02"})
    assert (c.endpoints, c.format, c.row_delimiter, c.max_bytes, c.interval_ms, c.connect_timeout_ms, c.max_retries) == (("a:1", "b:2"), "json", "\n", 67108864, 1000, 100, 3)
    assert c.load_properties["strip"] == "Yes" and c.load_properties["format"] == "json"
    vendor = {k.replace("store.", "other."): v for k, v in GOOD.items()}
    assert SinkConfig.from_dict({**vendor, "sink.properties.format": "CSV", "sink.properties.row_delimiter": r"\x02"}).row_delimiter == "\x02"
    assert with_defaults({})["sink.maxretries"] == "3"


def test_settings_errors():
    assert validate({})["store.password"] == ["You must specify store.password"]
    assert not any(validate(GOOD).values())
    for key, value in (("bufferflush.maxbytes", "1"), ("connect.timeoutms", "99"), ("bufferflush.intervalms", "x"), ("sink.maxretries", "-2"), ("store.username", "")):
        assert validate({**GOOD, key: value})[key]
    with pytest.raises(ConfigError, match="not support"):
        SinkConfig.from_dict({**GOOD, "sink.properties.format": "avro"})


def test_codec_settings():
    assert CodecConfig.from_dict({}) == CodecConfig() and CodecConfig().decimal_format == "BASE64"
    assert CodecConfig.from_dict({"decimal.format": "numeric", "schemas.enable": "false"}) == CodecConfig(False, 1000, "NUMERIC", True)
    with pytest.raises(ConfigError):
        CodecConfig(decimal_format="x")


def test_schema_round_trip():
    s = Schema(
        "struct", name="r", version=2, doc="d", parameters={"p": "q"},
        fields=(("a", Schema("array", True, items=Schema("int8"))), ("m", Schema("map", keys=Schema("int32"), values=Schema("string", True))), ("d", Schema("bytes", name=DECIMAL, parameters={"scale": "2"})), ("x", Schema("int32", name=DATE, default=7))),
    )
    assert Schema.from_json_schema(s.to_json_schema()) == s
    kind = s.data_type()
    assert kind["d"].dataType == T.DecimalType(38, 2) and kind["x"].dataType == T.DateType() and not kind["m"].nullable
    assert Schema.from_data_type(kind, False).fields == s.fields


@pytest.mark.parametrize(
    "node,error",
    [({}, "'type'"), ({"type": "array"}, "element type"), ({"type": "map", "values": {"type": "int8"}}, "key type"), ({"type": "map", "keys": {"type": "int8"}}, "value type"), ({"type": "struct"}, "not an array"), ({"type": "struct", "fields": [{"type": "int8"}]}, "field name"), ({"type": "x"}, "Unknown"), ({"type": "int8", "parameters": {"a": 1}}, "string values")],
)
def test_schema_errors(node, error):
    with pytest.raises(DataError, match=error):
        Schema.from_json_schema(node)


def test_only_true_is_optional():
    assert Schema.from_json_schema({"type": "int8", "optional": True}).optional
    assert not Schema.from_json_schema({"type": "int8", "optional": "true"}).optional and not Schema.from_json_schema({"type": "int8"}).optional
