"""Change-capture tags, time strings and unwrapping."""

import json
from dataclasses import replace

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import transforms as tr
from millrace.plans.schema import NAME, TIME, Schema

STATE = T.StructType([T.StructField("id", T.ByteType()), T.StructField("name", T.StringType())])
ENVELOPE = T.StructType([T.StructField("before", STATE), T.StructField("after", STATE), T.StructField("op", T.StringType())])


def envelopes(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], T.StructType([T.StructField("value", ENVELOPE, True, {NAME: "t.Envelope"})]))


CASES = [
    (((1, "a"), (1, "b"), "u"), None, 0), ((None, (1, "a"), "c"), None, 0), (((1, "a"), None, "d"), 1, None), ((None, (1, "a"), "r"), None, None), ((None, (1, "a"), None), None, None), (((1, "a"), None, "c"), None, None), ((None, (1, "a"), "d"), None, None),
]


def test_tags(spark):
    got = tr.tag_operations(envelopes(spark, *[c[0] for c in CASES])).select("value.before.__op", F.col("value.after.__op").alias("after")).collect()
    assert [tuple(r) for r in got] == [c[1:] for c in CASES]


def test_tagged_text_leaves_others_as_they_are(spark):
    df = envelopes(spark, *[c[0] for c in CASES])
    for (value, before, after), r in zip(CASES, df.select(tr.encode_tagged(F.col("value"), replace(Schema.from_data_type(ENVELOPE), name="t.Envelope")).alias("j")).collect()):
        j = json.loads(r.j)
        for side, tag, state in (("before", before, value[0]), ("after", after, value[1])):
            assert j[side] == (state and {"id": state[0], "name": state[1], **({} if tag is None else {"__op": tag})})


def test_not_an_envelope(spark):
    unnamed = envelopes(spark, CASES[0][0]).withMetadata("value", {NAME: "t.Value"})
    assert tr.tag_operations(unnamed) is unnamed
    for df in (spark.range(1).withColumnRenamed("id", "value"), spark.sql("SELECT named_struct('op', 1, 'after', named_struct('a', 1)) AS value"), spark.sql("SELECT named_struct('op', 'c', 'after', named_struct('__op', 1)) AS value")):
        assert tr.tag_operations(df) is df


def test_null_record(spark):
    assert tr.tag_operations(envelopes(spark, None)).first().value is None


def test_unwrap(spark):
    got = tr.chain(tr.tag_operations, tr.unwrap)(envelopes(spark, CASES[0][0], CASES[2][0])).select("value.*").collect()
    assert [tuple(r) for r in got] == [(1, "b", 0, "false"), (1, "a", 1, "true")]


TIMES = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("t", T.IntegerType(), True, {NAME: TIME}), T.StructField("u", T.IntegerType(), True, {NAME: TIME}), T.StructField("x", T.DoubleType(), False)])


def timed(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], T.StructType([T.StructField("value", TIMES)]))


def test_marked_times(spark):
    got = tr.times_to_text(timed(spark, (1, 64957000, None, 1.0), None))
    assert [r.value and tuple(r.value) for r in got.collect()] == [(1, "18:02:37", None, 1.0), None]
    assert [f.dataType.simpleString() for f in got.schema["value"].dataType] == ["int", "string", "string", "double"]


def test_named_times(spark):
    got = tr.times_to_text(timed(spark, (1, 64957123, 5, 1.5)), fields="t , x,nope", pattern="HH:mm:ss.SSS").first().value
    assert tuple(got) == (1, "18:02:37.123", 5, "1.5")


def test_nothing_to_convert(spark):
    df = envelopes(spark, CASES[0][0])
    assert tr.times_to_text(df) is df and tr.times_to_text(timed(spark, None), fields="nope").columns == ["value"]


def test_long_wraps_text_stays_dates_and_stamps(spark):
    df = spark.sql("SELECT named_struct('l', 4294967297L, 's', 'abc', 'd', date'1970-01-02', 'ts', timestamp'1969-12-31 23:59:59.5') AS value")
    assert tuple(tr.times_to_text(df, fields="l,s,d,ts", pattern="HH:mm:ss.SSS").first().value) == ("00:00:00.001", "abc", "00:00:00.000", "-00:00:00.500")


@pytest.mark.parametrize("ms,plain,full", [(0, "00:00:00", "00:00:00.000"), (86399999, "23:59:59", "23:59:59.999"), (-500, "-00:00:00", "-00:00:00.500"), (90000000, "25:00:00", "25:00:00.000"), (-(2**31), "-596:31:23", "-596:31:23.648"), (None, None, None), (43200000, "12:00:00", "12:00:00.000"), (1000, "00:00:01", "00:00:01.000")])
def test_clock(spark, ms, plain, full):
    n = F.lit(ms).cast("int")
    got = spark.range(1).select(tr.format_millis(n).alias("a"), tr.format_millis(n, "HH:mm:ss.SSS").alias("b"), tr.format_millis(n, " HH:mm:ss.SSS").alias("c")).first()
    assert tuple(got) == (plain, full, plain)


@given(st.lists(st.text("ab", min_size=1, max_size=3), max_size=4))
def test_field_lists(names):
    assert tr.parse_fields(" , ".join(names)) == names
