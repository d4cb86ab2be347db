"""Flush rule, retry limit and streaming delivery."""

import time

import pytest
from pyspark.sql import functions as F

from millrace.plans.config import SinkConfig
from millrace.sources.records import broker_options, broker_stream, file_stream
from millrace.streaming.delivery import FlushPolicy, Pipeline, RetryExceeded, RetryGate, TableWriter
from millrace.streaming.store import Files, shared_folder

GOOD = {"store.http.url": "a:1", "store.database.name": "db", "store.username": "u", "store.password": "", "store.topic2table.map": "x:t_x"}


def test_flush_rule():
    policy, flushed = FlushPolicy(100, 1000), []
    flush = lambda: flushed.append(1)
    assert policy.pre_commit({0: 1}, 5000, flush) == {0: 1}
    policy.add(99)
    assert policy.pre_commit({0: 2}, 5999, flush) == {}
    policy.add(1)
    assert policy.pre_commit({0: 3}, 5999, flush) == {0: 3}
    assert policy.pre_commit({0: 4}, 6999, flush) == {0: 4} and len(flushed) == 3
    with pytest.raises(ZeroDivisionError):
        policy.pre_commit({}, 9000, lambda: 1 / 0)
    assert (policy.buffered, policy.flushed_at_ms) == (0, 9000)


def test_retry_limit_is_passed_by_the_fourth_failure():
    gate = RetryGate(3)
    for _ in range(3):
        gate.failed(ValueError("x"))
        gate.check()
    gate.failed(ValueError("x"))
    with pytest.raises(RetryExceeded):
        gate.check()
    gate.succeeded()
    gate.check()
    endless = RetryGate(-1, failures=10**6)
    endless.check()


class Failing(TableWriter):
    """Fails the first ``times`` deliveries."""

    def __init__(self, path, config, times):
        super().__init__(path, config)
        self.times, self.seen = times, []

    def write(self, rows, batch):
        self.seen.append(batch)
        if len(self.seen) <= self.times:
            raise OSError("store is away")
        return super().write(rows, batch)


def stream(spark, folder, n=20):
    spark.range(n).select(F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("topic"), F.when(F.col("id") % 5 != 0, F.concat(F.lit("r"), "id")).alias("value")).write.mode("overwrite").parquet(f"{folder}/in")
    return lambda: spark.readStream.schema("topic string, value string").parquet(f"{folder}/in")


def test_replay_of_the_same_batch(spark, tmp_path):
    config = SinkConfig.from_dict({**GOOD, "sink.properties.format": "csv", "sink.properties.row_delimiter": r"\x02\x03".replace(r"\x03", "03")})
    writer = Failing(str(tmp_path / "out"), config, 3)
    Pipeline(config, writer, str(tmp_path / "ck")).run(stream(spark, tmp_path), once=True)
    assert set(writer.seen[:4]) == {0} and len(writer.seen) == 4
    got = sorted((r.tbl, r.row) for r in writer.read(spark).collect())
    assert got == sorted(("t_x" if i % 2 == 0 else "y", f"r{i}") for i in range(20) if i % 5)


def test_too_many_failures(spark, tmp_path):
    config = SinkConfig.from_dict({**GOOD, "sink.properties.format": "csv", "sink.maxretries": "1"})
    writer = Failing(str(tmp_path / "out"), config, 99)
    with pytest.raises(RetryExceeded):
        Pipeline(config, writer, str(tmp_path / "ck")).run(stream(spark, tmp_path), once=True)
    assert len(writer.seen) == 2


CSV = SinkConfig.from_dict({**GOOD, "sink.properties.format": "csv", "bufferflush.intervalms": "3600000"})


def test_batches_are_staged_until_the_flush_is_due(spark, tmp_path):
    """The first batch flushes; later ones wait for the size or the interval, or for the end of the pipeline."""
    writer = TableWriter(str(tmp_path / "out"), CSV)
    pipeline = Pipeline(CSV, writer, str(tmp_path / "ck"))
    rows = lambda n: spark.createDataFrame([("t_x", f"r{n}")], "tbl string, row string")
    seen = []
    for n in range(3):
        pipeline._deliver(rows(n), n)
        seen.append(sorted(r.row for r in writer.read(spark).collect()))
    assert seen == [["r0"], ["r0"], ["r0"]] and writer.staged(spark) == [1, 2]
    pipeline.policy.add(CSV.max_bytes)
    pipeline._deliver(rows(3), 3)
    assert sorted(r.row for r in writer.read(spark).collect()) == ["r0", "r1", "r2", "r3"] and writer.staged(spark) == []
    assert len(Files(spark).names(f"{writer.path}/commits")) == 2


def test_a_new_pipeline_commits_what_was_staged(spark, tmp_path):
    writer = TableWriter(str(tmp_path / "out"), CSV)
    writer.write(spark.createDataFrame([("t_x", "left")], "tbl string, row string"), 7)
    Pipeline(CSV, writer, str(tmp_path / "ck")).run(stream(spark, tmp_path), once=True)
    rows = [r.row for r in writer.read(spark).collect()]
    assert rows.count("left") == 1 and len(rows) == 17


def test_stop_ends_and_commits(spark, tmp_path):
    writer = TableWriter(str(tmp_path / "out"), CSV)
    pipeline = Pipeline(CSV, writer, str(tmp_path / "ck"), scan_ms=100)
    query = pipeline.start(stream(spark, tmp_path)())
    query.processAllAvailable()
    spark.createDataFrame([("x", "late")], "topic string, value string").write.mode("append").parquet(f"{tmp_path}/in")
    query.processAllAvailable()
    assert writer.staged(spark)
    pipeline.stop()
    assert not query.isActive and writer.staged(spark) == [] and "late" in {r.row for r in writer.read(spark).collect()}


def test_replayed_batches_and_odd_tables(spark, tmp_path):
    writer = TableWriter(str(tmp_path / "out"), CSV)
    assert writer.read(spark).collect() == [] and writer.commit(spark) == []
    rows = spark.createDataFrame([("007", "a"), ("10", "b"), (None, "c")], "tbl string, row string")
    for _ in range(2):
        writer.write(rows, 0)
        writer.write(rows, 0)
        writer.commit(spark)
    assert sorted(map(repr, map(tuple, writer.read(spark).collect()))) == sorted(map(repr, [("007", "a"), ("10", "b"), (None, "c")]))
    writer.write(rows.limit(0), 1)
    writer.commit(spark)
    assert writer.read(spark).count() == 3 and writer.committed(spark).count() == 2


def test_broker_source_through_a_stand_in(spark, tmp_path):
    """Size and interval of a flush reach the source; its stream runs through the pipeline."""
    config = SinkConfig.from_dict({**GOOD, "bufferflush.intervalms": "2000"})
    options = broker_options("b:1", ["t1", "t2"], config, record_bytes=512)
    assert options["subscribe"] == "t1,t2" and options["minOffsetsPerTrigger"] == str(67108864 // 512) and options["maxTriggerDelay"] == "2000ms"
    records = lambda: broker_stream(spark, "b:1", ["x"], config, {"rowsPerBatch": "5", "numPartitions": "1"}, form="rate-micro-batch")
    assert set(records().columns) == {"timestamp", "value"}
    writer = TableWriter(str(tmp_path / "out"), config)
    pipeline = Pipeline(config, writer, str(tmp_path / "ck"), transform=lambda df: df.withColumn("topic", F.lit("x")), scan_ms=100)
    query = pipeline.start(records())
    until = time.time() + 60
    while not writer.committed(spark).take(1) and time.time() < until:
        time.sleep(0.2)
    pipeline.stop()
    got = [r.row for r in writer.read(spark).collect()]
    assert len(got) % 5 == 0 and set(got) >= {"0", "1", "2", "3", "4"} and not query.isActive


def test_file_stream_of_records(spark, tmp_path):
    spark.createDataFrame([(b"k", b"v", "x", 0, 1, None)], "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp").write.parquet(f"{tmp_path}/in")
    writer = TableWriter(str(tmp_path / "out"), CSV)
    Pipeline(CSV, writer, str(tmp_path / "ck"), transform=lambda df: df.withColumn("value", F.col("value").cast("string"))).run(lambda: file_stream(spark, f"{tmp_path}/in", CSV), once=True)
    assert [tuple(r) for r in writer.read(spark).collect()] == [("t_x", "v")]


def test_files_and_shared_folder(spark, tmp_path):
    files, path = Files(spark), f"file://{tmp_path}/a/b"
    files.write(path, "one")
    files.write(path, "two \u00e9")
    assert files.read(path) == "two \u00e9" and files.names(f"file://{tmp_path}/a") == ["b"] or files.names(f"file://{tmp_path}/a") == [".b.crc", "b"]
    files.delete(path)
    assert not files.exists(path) and files.size(path) == 0 and files.names(f"file://{tmp_path}/none") == []
    assert shared_folder(spark).startswith("file://")
