"""Streams of records with the columns key, value, topic, partition, offset, timestamp."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..plans.config import SinkConfig

#: Columns of a record stream, which the broker source has by itself.
RECORD = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"


def broker_options(servers: str, topics: list[str], config: SinkConfig, record_bytes: int = 1024) -> dict[str, str]:
    """Options of the broker source. A batch starts when the flush size or the flush interval is reached; the broker counts
    records, so the size is divided by what a record takes on average (``record_bytes``)."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "includeHeaders": "true",
        "minOffsetsPerTrigger": str(max(1, config.max_bytes // record_bytes)),
        "maxTriggerDelay": f"{config.interval_ms}ms",
    }


def broker_stream(spark: SparkSession, servers: str, topics: list[str], config: SinkConfig, options: dict | None = None, record_bytes: int = 1024, form: str = "kafka") -> DataFrame:
    """Records of topics. Partitions go to executors by themselves.

    Needs Spark's connector for the broker on the class path (``form``: the source's name, if it is another one).
    """
    return spark.readStream.format(form).options(**{**broker_options(servers, topics, config, record_bytes), **(options or {})}).load()


def file_stream(spark: SparkSession, path: str, config: SinkConfig, schema=RECORD, form: str = "parquet", options: dict | None = None) -> DataFrame:
    """Records from files that appear in a folder, at most the flush size in one batch."""
    return spark.readStream.format(form).schema(schema).options(**{"maxBytesPerTrigger": str(config.max_bytes), **(options or {})}).load(path)
