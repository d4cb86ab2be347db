"""Delivery: flushes, retries and tables written batch by batch."""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.rows import build_rows, route
from ..operators.transforms import OP_FIELD
from ..plans.config import SinkConfig
from ..plans.schema import Schema
from .store import Files

log = logging.getLogger(__name__)


@dataclass
class FlushPolicy:
    """When staged rows are committed: at a size or after a time, whichever is first; the first call flushes."""

    max_bytes: int
    interval_ms: int
    buffered: int = 0
    flushed_at_ms: int = 0

    def add(self, n_bytes: int) -> None:
        self.buffered += n_bytes

    def due(self, now_ms: int) -> bool:
        return self.buffered >= self.max_bytes or now_ms - self.flushed_at_ms >= self.interval_ms

    def pre_commit(self, offsets: dict, now_ms: int, flush: Callable[[], None]) -> dict:
        """The offsets that may be committed: none while no flush is due. Counters start anew even if the flush fails."""
        if not self.due(now_ms):
            return {}
        try:
            flush()
        finally:
            self.buffered, self.flushed_at_ms = 0, now_ms
        return offsets


class RetryExceeded(RuntimeError):
    """More failures in a row than allowed."""


@dataclass
class RetryGate:
    """Counts failures in a row. With a limit of 3, the attempt after the fourth failure is refused; -1 never refuses."""

    limit: int
    failures: int = 0
    error: BaseException | None = None

    def check(self) -> None:
        if self.limit != -1 and self.failures > self.limit:
            raise RetryExceeded(f"{self.failures} failures in a row, {self.limit} allowed") from self.error

    def failed(self, error: BaseException) -> None:
        self.failures, self.error = self.failures + 1, error

    def succeeded(self) -> None:
        self.failures, self.error = 0, None


class TableWriter:
    """Two-phase delivery of batches as text files, in any store that Spark writes to.

    ``write`` stages the rows of a batch under ``path/rows/batch=<id>/attempt=<label>/tbl=<table>/``, one job for all
    tables, and notes the attempt under ``path/staged``. ``commit`` makes staged batches visible together: one small file
    under ``path/commits`` names their attempts, with the endpoints, the database and the load properties they are
    loaded with. ``abort`` removes a staged batch. Readers see committed attempts only, of each batch the one that was
    committed last, so a delivery that happens at least once is seen once.
    """

    ROWS = T.StructType([T.StructField("value", T.StringType()), T.StructField("batch", T.LongType()), T.StructField("attempt", T.StringType()), T.StructField("tbl", T.StringType())])

    def __init__(self, path: str, config: SinkConfig):
        self.path, self.config = path.rstrip("/"), config

    def write(self, rows: DataFrame, batch: int) -> int:
        """Stage a batch; returns its bytes."""
        files, attempt = Files(rows.sparkSession), uuid.uuid4().hex
        to = f"{self.path}/rows/batch={batch}/attempt={attempt}"
        out = rows.select(F.col("row").alias("value"), "tbl").write.partitionBy("tbl").mode("overwrite")
        out.options(**self.load_options()).option("lineSep", self.config.row_delimiter).text(to)
        self.abort(rows.sparkSession, batch)  # what a failed attempt has staged
        size = files.size(to)
        files.write(f"{self.path}/staged/{batch}", f"{attempt} {size}")
        return size

    def load_options(self) -> dict[str, str]:
        """Load properties for the writer of the files; those that it does not know pass it by."""
        return {k: v for k, v in self.config.load_properties.items() if k not in ("format", "row_delimiter", "path", "linesep")}

    def staged(self, spark: SparkSession) -> list[int]:
        """Batches that are staged and not yet committed."""
        return sorted(int(n) for n in Files(spark).names(f"{self.path}/staged") if n.isdigit())

    def commit(self, spark: SparkSession) -> list[int]:
        """Make all staged batches visible at once; returns them. Safe to repeat."""
        files, batches = Files(spark), self.staged(spark)
        if batches:
            load = {"endpoints": self.config.endpoints, "database": self.config.database, "properties": self.config.load_properties}
            at = time.time_ns()
            notes = {b: files.read(f"{self.path}/staged/{b}").split() for b in batches}
            lines = [json.dumps({"batch": b, "attempt": attempt, "bytes": int(size), "at": at, **load}) for b, (attempt, size) in notes.items()]
            files.write(f"{self.path}/commits/{at}-{uuid.uuid4().hex}.json", "\n".join(lines) + "\n")
            for b in batches:
                files.delete(f"{self.path}/staged/{b}")
        return batches

    def abort(self, spark: SparkSession, batch: int) -> None:
        """Remove a staged batch."""
        files, note = Files(spark), f"{self.path}/staged/{batch}"
        if files.exists(note):
            files.delete(f"{self.path}/rows/batch={batch}/attempt={files.read(note).split()[0]}")
            files.delete(note)

    def committed(self, spark: SparkSession) -> DataFrame:
        """batch, attempt (the last one of each), bytes, endpoints, database and properties of what is visible."""
        kind = "batch long, attempt string, bytes long, at long, endpoints array<string>, database string, properties map<string,string>"
        if not Files(spark).exists(f"{self.path}/commits"):
            return spark.createDataFrame([], kind).drop("at")
        found = spark.read.schema(kind).json(f"{self.path}/commits")
        last = found.groupBy("batch").agg(F.max_by(F.struct("attempt", "bytes", "endpoints", "database", "properties"), "at").alias("x"))
        return last.select("batch", "x.*")

    def read(self, spark: SparkSession) -> DataFrame:
        """tbl, row of everything committed. Table names are texts, whatever they look like; a row without a table (null or
        empty) has a null one."""
        committed = self.committed(spark)
        if not committed.filter("bytes > 0").take(1):
            return spark.createDataFrame([], "tbl string, row string")
        rows = spark.read.schema(self.ROWS).option("lineSep", self.config.row_delimiter).text(f"{self.path}/rows")
        return rows.join(committed.select("batch", "attempt"), ["batch", "attempt"], "left_semi").select("tbl", F.col("value").alias("row"))


class Pipeline:
    """A record stream through transforms, rows and routing into a writer.

    Every micro-batch is staged as it comes; staged batches are committed together when :class:`FlushPolicy` says so, at a
    size or after the interval, and whatever is left when the query ends. ``scan_ms`` is how often the stream is looked at.
    A restarted pipeline commits what an earlier one had staged: the query replays only batches that it had not taken.
    """

    def __init__(self, config: SinkConfig, writer, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None, schema: Schema | None = None, absent: tuple[str, ...] = (OP_FIELD,), scan_ms: int | None = None):
        self.config, self.writer, self.checkpoint = config, writer, checkpoint
        self.transform, self.schema, self.absent = transform or (lambda df: df), schema, absent
        self.scan_ms = config.interval_ms if scan_ms is None else scan_ms
        self.gate, self.policy = RetryGate(config.max_retries), FlushPolicy(config.max_bytes, config.interval_ms)
        self.query: StreamingQuery | None = None
        self.stopped = False

    def rows(self, records: DataFrame) -> DataFrame:
        """tbl and row of every record that has a value. All narrow: nothing is shuffled."""
        return route(build_rows(self.transform(records), self.config.format, self.schema, absent=self.absent), self.config.tables)

    def _deliver(self, batch: DataFrame, number: int) -> None:
        self.policy.add(self.writer.write(batch.select("tbl", "row"), number) or 0)
        self.policy.pre_commit({"batch": number}, time.time_ns() // 1_000_000, lambda: self.writer.commit(batch.sparkSession))
        self.gate.succeeded()

    def start(self, records: DataFrame, once: bool = False) -> StreamingQuery:
        """Start the query; ``once`` takes what is there and ends. Offsets are committed after a batch is staged."""
        self.session = records.sparkSession
        self.writer.commit(self.session)
        writer = self.rows(records).writeStream.foreachBatch(self._deliver).option("checkpointLocation", self.checkpoint)
        writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{self.scan_ms} milliseconds")
        self.query = writer.start()
        return self.query

    def stop(self) -> None:
        """End the query and commit what is staged."""
        self.stopped = True
        if self.query is not None:
            self.query.stop()
            self.writer.commit(self.session)

    def run(self, records: Callable[[], DataFrame], once: bool = False, pause_s: float = 0.0) -> None:
        """Keep the query going: a failure restarts it from the last commit, until failures in a row pass the limit.

        Delivered batches reset the count. Returns when the stream ends or :meth:`stop` is called.
        """
        while not self.stopped:
            self.gate.check()
            query = None
            try:
                stream = records()
                query = self.start(stream, once)
                query.awaitTermination()
                self.writer.commit(stream.sparkSession)
                return
            except Exception as error:  # noqa: BLE001  whatever ended the query counts as a failed flush
                self.gate.failed(error)
                log.warning("delivery failed (%d in a row): %s", self.gate.failures, error)
                time.sleep(pause_s)
            finally:
                if query is not None and query.isActive:
                    query.stop()
