"""JSON encoding and decoding against the fixture vectors."""

import json
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.errors import DataError
from millrace.functions import json_decode as dec
from millrace.functions import json_encode as enc
from millrace.functions.decimals import bytes_to_decimal, decimal_to_bytes
from millrace.operators import rows
from millrace.plans.config import CodecConfig
from millrace.plans.schema import DATE, DECIMAL, TIME, TIMESTAMP, Schema

RECORD = T.StructType([T.StructField("id", T.ByteType(), False), T.StructField("name", T.StringType())])


def one(spark, column, **kw):
    return spark.range(1).select(column.alias("x"), **kw).first()["x"]


def decoded(spark, text, schema, config=None):
    return one(spark, dec.decode(F.lit(text), schema, config))


@pytest.mark.parametrize("value,want", [((1, "myRecord"), '{"id":1,"name":"myRecord"}'), ((1, None), '{"id":1,"name":null}')])
def test_struct_rows(spark, value, want):
    df = spark.createDataFrame([(value,), (None,)], T.StructType([T.StructField("value", RECORD)]))
    assert [r.row for r in rows.build_rows(df).collect()] == [want]


def test_text_in_json_mode_is_a_json_string(spark):
    df = spark.createDataFrame([('{"name":"北京","code":1}',), (None,), ("",)], "value string")
    assert [r.row for r in rows.build_rows(df).collect()] == ['"{\\"name\\":\\"北京\\",\\"code\\":1}"', '""']
    assert [r.row for r in rows.build_rows(df, "csv").collect()] == ['{"name":"北京","code":1}', ""]


def test_csv_needs_text(spark):
    with pytest.raises(DataError, match="cannot be cast to"):
        rows.build_rows(spark.range(1).withColumnRenamed("id", "value"), "csv")


def test_decimal_envelope_to_row(spark):
    message = json.dumps({"schema": {"type": "bytes", "name": DECIMAL, "version": 1, "parameters": {"scale": "2"}}, "payload": "AJw="})
    schema = dec.envelope_schema(message)
    value = dec.from_bytes(F.lit(message).cast("binary"), schema)
    assert one(spark, enc.encode(value, schema)) == "1.56"


def test_schemaless_round_trip(spark):
    text = '{"elements":[{"elName":"a","age":1}],"name":"n","id":3}'
    back = one(spark, enc.to_bytes(dec.from_bytes(F.lit(text).cast("binary"), None, CodecConfig(schemas_enable=False)), None, T.VariantType(), CodecConfig(schemas_enable=False)))
    assert json.loads(bytes(back)) == json.loads(text)


@pytest.mark.parametrize(
    "sql,want",
    [("map(1, 'a')", '[[1,"a"]]'), ("map('a', 1)", '{"a":1}'), ("date_from_unix_date(20067)", "20067"), ("timestamp_millis(1704067798778)", "1704067798778"), ("X'00FF9C'", '"AP+c"'), ("cast('100.00' AS decimal(10,2))", "100.00"), ("array(1, null)", "[1,null]"), ("named_struct('m', map(1, cast('1.50' AS decimal(5,2))))", '{"m":[[1,1.50]]}'), ("double('NaN')", '"NaN"'), ("true", "true")],
)
def test_encode_types(spark, sql, want):
    df = spark.sql(f"SELECT {sql} AS value")
    assert rows.build_rows(df).first().row == want


def test_base64_decimal(spark):
    schema = Schema("bytes", name=DECIMAL, parameters={"scale": "4"})
    assert one(spark, enc.encode(F.lit(Decimal("10.2345")).cast("decimal(38,4)"), schema, CodecConfig())) == '"AY/J"'


def test_nulls_and_defaults(spark):
    null = F.lit(None).cast("int")
    with pytest.raises(Exception, match="required"):
        one(spark, enc.encode(null, Schema("int32")))
    assert one(spark, enc.encode(null, Schema("int32", True))) == "null"
    assert one(spark, enc.encode(null, Schema("int32", True, default=5), CodecConfig())) == "5"
    assert one(spark, enc.encode(null, Schema("int32", True, default=5))) == "null"
    assert one(spark, enc.to_bytes(F.lit(None).cast("string"), None, T.StringType())) is None


def test_envelope_text(spark):
    made = bytes(one(spark, enc.to_bytes(F.lit(3), Schema("int32")))).decode()
    assert made == '{"schema":{"type":"int32","optional":false},"payload":3}'


@pytest.mark.parametrize(
    "text,schema,want",
    [
        ("300", Schema("int8"), 44), ("128", Schema("int8"), -128), ("70000", Schema("int16"), 4464), ('"12"', Schema("int32"), 0), ("1.9", Schema("int64"), 1), ('"x"', Schema("boolean"), False), ("true", Schema("boolean"), True),
        ("5", Schema("string", True), None), ('"AP+c"', Schema("bytes"), bytearray(b"\x00\xff\x9c")), ("[1,2]", Schema("array", items=Schema("int32")), [1, 2]), ('{"a":1}', Schema("map", keys=Schema("string"), values=Schema("int64")), {"a": 1}),
        ('[[1,"a"],[2,"b"],[1,"c"]]', Schema("map", keys=Schema("int32"), values=Schema("string")), {1: "c", 2: "b"}), ("1.5", Schema("bytes", name=DECIMAL, parameters={"scale": "2"}), Decimal("1.50")), ("5", Schema("int32", name=TIME), 5), ("null", Schema("int32", True, default=9), 9), ("null", Schema("int32", True), None), ("2.5", Schema("float"), 2.5),
    ],
)
def test_decode(spark, text, schema, want):
    assert decoded(spark, text, schema) == want


@pytest.mark.parametrize(
    "text,schema,error",
    [
        ("{", Schema("int8"), "MALFORMED"), ("null", Schema("int8"), "required"), ('{"1":"a"}', Schema("map", keys=Schema("int32"), values=Schema("string")), "array of tuples"), ("[[1,2,3]]", Schema("map", keys=Schema("int32"), values=Schema("int32")), "length 2"), ("[1]", Schema("map", keys=Schema("int32"), values=Schema("int32")), "array tuple"),
        ("[1]", Schema("map", keys=Schema("string"), values=Schema("int32")), "JSON objects"), ("1", Schema("struct", fields=(("a", Schema("int8")),)), "JSON objects"), ("true", Schema("bytes", name=DECIMAL, parameters={"scale": "0"}), "numeric or bytes"), ('"x"', Schema("int32", name=DATE), "integer"), ("1.5", Schema("int64", name=TIMESTAMP), "integral"),
    ],
)
def test_decode_errors(spark, text, schema, error):
    with pytest.raises(Exception, match=error):
        decoded(spark, text, schema)


@pytest.mark.parametrize("message", ['{"schema":null}', '{"schema":null,"payload":1,"x":2}', "[1]", "3"])
def test_envelopes_are_exact(spark, message):
    with pytest.raises(Exception, match="additional fields"):
        one(spark, dec.from_bytes(F.lit(message).cast("binary"), Schema("int32", True)))


def test_struct_extra_and_absent_fields(spark):
    schema = Schema("struct", fields=(("a", Schema("int32")), ("b", Schema("string", True))))
    assert decoded(spark, '{"a":1,"z":9}', schema).asDict() == {"a": 1, "b": None}
    with pytest.raises(Exception, match="required"):
        decoded(spark, '{"b":"x"}', schema)


def test_tombstone_and_headers(spark):
    assert one(spark, dec.from_bytes(F.lit(None).cast("binary"), Schema("int32"))) is None
    off = CodecConfig(schemas_enable=False)
    headers = F.array(F.struct(F.lit("k").alias("key"), F.lit(7).alias("value")))
    coded = enc.headers_to_bytes(headers, Schema("int32"), off)
    assert one(spark, dec.headers_from_bytes(coded, Schema("int32"), off))[0].asDict() == {"key": "k", "value": 7}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(10**37), 10**37), min_size=1, max_size=40))
def test_decimal_bytes_round_trip(spark, numbers):
    numbers += [0, 1, -1, 127, 128, -128, -129, 2**63, -(2**63), 2**64, -(2**64), 2**63 - 1]
    df = spark.createDataFrame([(Decimal(n),) for n in numbers], "d decimal(38,0)")
    for r in df.select("d", decimal_to_bytes(F.col("d"), 0).alias("b"), bytes_to_decimal(decimal_to_bytes(F.col("d"), 0), 0).alias("back")).collect():
        n = int(r.d)
        size = max(1, (n if n >= 0 else ~n).bit_length() // 8 + 1)
        assert bytes(r.b) == n.to_bytes(size, "big", signed=True) and r.back == r.d


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-128, 127), st.one_of(st.none(), st.text(st.characters(exclude_categories=["Cs"]), max_size=20))), min_size=1, max_size=20))
def test_decode_of_encode_is_the_value(spark, values):
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("value", RECORD, False)]))
    schema = Schema.from_data_type(RECORD, False)
    back = df.select("value", dec.decode(enc.encode(F.col("value"), schema), schema).alias("back")).collect()
    assert all(r.value == r.back for r in back)
