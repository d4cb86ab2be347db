"""What the training-data operators share: scratch tables, bounded joins, word helpers, decisions on whole rows.

Scratch tables are listed as they are made. :func:`discard` removes one as soon as a later written table has taken its
place, :func:`release` removes all that are left, once results are written.
"""

from __future__ import annotations

import sys
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from math import ceil, log2
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..streaming.store import shared_folder

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: At most this many keys count as heavy in :func:`join_classes`.
HEAVY_KEYS = 1000

#: A :class:`KeyFilter` has so many bits a key, up to its greatest size (32 MB).
FILTER_BITS, FILTER_MOST = 16, 1 << 28

#: Bytes of a batch that goes to a Python worker; Spark's own limit is ten times that.
ARROW_BYTES = 6 << 20
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ARROW, _ARROW_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", ("67108864", "67108864b", "64MB")

#: Scratch folders and catalog tables that exist, by application.
_made: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/millrace/{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_table(spark: SparkSession, name: str) -> tuple[str, str]:
    """Name and path of a catalog table that is scratch."""
    path, table = scratch_path(spark, name), f"millrace_{name}_{uuid.uuid4().hex}"
    _made[spark.sparkContext.applicationId].append(f"table:{table}")
    return table, path


@contextmanager
def written_once(spark: SparkSession):
    """While a table is written, let Spark drop the shuffle files of the write at its end: nothing runs that plan again."""
    try:
        before = spark.conf.get(_CLEANUP)
    except Exception:  # noqa: BLE001  a version without the setting drops them when the driver collects its garbage
        yield
        return
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back: lineage ends, lost executors cost nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with written_once(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._millrace_path = path
    return out


def _remove(spark: SparkSession, what: str) -> None:
    if what.startswith("table:"):
        spark.sql(f"DROP TABLE IF EXISTS {what[6:]}")
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(what)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Remove stored tables that nothing will read again, as what was made of them is stored itself."""
    for df in tables:
        made, path = _made.get(df.sparkSession.sparkContext.applicationId, []), getattr(df, "_millrace_path", None)
        if path in made:
            made.remove(path)
            _remove(df.sparkSession, path)


def scratch_mark(spark: SparkSession) -> int:
    """How much scratch there is now, for :func:`release`."""
    return len(_made.get(spark.sparkContext.applicationId, []))


def write_bucketed(df: DataFrame, name: str, key: str = "chunk") -> DataFrame:
    """Store ``df`` in one file a bucket of ``key``: joins on it leave the table where it is. Costs one shuffle of it."""
    spark = df.sparkSession
    table, path = scratch_table(spark, name)
    buckets = parallelism(spark)
    with written_once(spark):
        df.repartition(buckets, key).write.bucketBy(buckets, key).option("path", path).option("compression", "zstd").format("parquet").saveAsTable(table)
    return spark.table(table)


def release(spark: SparkSession, since: int = 0, keep: tuple[str, ...] = ()) -> int:
    """Remove the scratch tables that this application's operators have made (from ``since`` on) and return how many.

    To be called once the operators' results are written or collected: results are lazy and read scratch tables.
    """
    made = _made.get(spark.sparkContext.applicationId, [])
    gone = [x for x in made[since:] if x not in keep]
    for what in sorted(gone, key=lambda x: not x.startswith("table:")):
        _remove(spark, what)
    made[since:] = [x for x in made[since:] if x in keep]
    return len(gone)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def parallelism(spark: SparkSession) -> int:
    """Shuffle partitions of the session, which the deployment sizes to its data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def words(text: Column) -> Column:
    """The words of a text as an array (null text: no words)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. Where every character is ASCII, ``lower`` does just that and is faster."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


def join_classes(rows: DataFrame, classes: DataFrame, key: list[str], size: str, total: int, how: str = "inner") -> DataFrame:
    """Join rows to classes that are unique in ``key``, where ``size`` is the number of a class's rows.

    A class with over ``total / HEAVY_KEYS`` rows is heavy; there can be no more than HEAVY_KEYS of those, so
    they are broadcast and their rows stay where they are. All others meet in a shuffle join in which no key
    holds over a thousandth of the rows.
    """
    floor = max(1, total // HEAVY_KEYS)
    heavy = classes.filter(F.col(size) > floor)
    light = classes.filter(F.col(size) <= floor)
    if not heavy.take(1):
        return rows.join(light, key, how)
    marks = F.broadcast(heavy.select(*key))
    own = rows.join(F.broadcast(heavy), key, "inner")
    rest = rows.join(marks, key, "left_anti").join(light, key, how)
    return own.unionByName(rest)


def quoted(name: str) -> Column:
    """The column of exactly this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(docs: DataFrame) -> Column:
    """All columns in one struct, so that no name can meet one of an operator's own."""
    return F.struct(*[quoted(c).alias(c) for c in docs.columns])


def row_mark(docs: DataFrame) -> Column:
    """A 64-bit hash of a whole row, nulls and nested values of any type included."""
    nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    parts = [F.to_json(F.struct(quoted(f.name).alias("x")), {"ignoreNullFields": "false"}) if isinstance(f.dataType, nested) else quoted(f.name) for f in docs.schema.fields]
    nulls = F.concat(*[F.when(quoted(c).isNull(), "0").otherwise("1") for c in docs.columns])
    return F.xxhash64(nulls, *parts)


class KeyFilter:
    """A bitmap of hashed keys, of a bounded size, that tells in place which rows cannot have one of the keys.

    ``keys`` holds longs in its column ``key`` (a stored table), ``count`` is their number. A clear bit is certain; a
    set one may be another key's, which an exact step behind it has to settle. The more keys beyond the greatest size,
    the more rows go to that step, in the end all of them.
    """

    def __init__(self, keys: DataFrame, count: int):
        self.slots = 1 << max(15, min(FILTER_MOST.bit_length() - 1, ceil(log2(max(1, FILTER_BITS * count)))))
        slot = self._slot(F.col("key"))
        bitmaps = keys.select(F.call_function("bitmap_bucket_number", slot).alias("__bucket"), F.call_function("bitmap_bit_position", slot).alias("bit"))
        self.bitmaps = bitmaps.groupBy("__bucket").agg(F.call_function("bitmap_construct_agg", F.col("bit")).alias("__bits"))

    def _slot(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.slots))

    def mark(self, rows: DataFrame, key: Column, name: str = "listed") -> DataFrame:
        """``rows`` (of own column names) with the boolean ``name``. Nothing is shuffled."""
        rows = rows.withColumn("__slot", self._slot(key)).withColumn("__bucket", F.call_function("bitmap_bucket_number", F.col("__slot")))
        at = F.call_function("bitmap_bit_position", F.col("__slot"))
        byte = F.conv(F.hex(F.substring("__bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        bit = F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
        marked = rows.join(F.broadcast(self.bitmaps), "__bucket", "left")
        return marked.withColumn(name, F.coalesce(bit, F.lit(False))).drop("__slot", "__bucket", "__bits")


def keep_decided(docs: DataFrame, id_col: str, decided: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``decided`` drops, all columns kept.

    ``decided`` (a stored table) has the rows of all groups of more than one row, once each: doc_id, mark (as
    :func:`row_mark` has it) and the boolean kept. Of equal rows that are kept one stays. All rows that are not listed,
    which a :class:`KeyFilter` tells, stay where they are; of the others equal ones meet (combined on the map side
    first) and the dropped ones go.
    """
    key = F.xxhash64("doc_id", "mark")
    listed = KeyFilter(decided.select(key.alias("key")), decided.count())
    rows = docs.select(whole_row(docs).alias("row"), quoted(id_col).cast("long").alias("doc_id"), row_mark(docs).alias("mark"))
    rows = listed.mark(rows, key)
    stay = rows.filter(~F.col("listed")).select("row.*")
    once = rows.filter("listed").groupBy("doc_id", "mark").agg(F.first("row").alias("row"))
    gone = decided.filter(~F.col("kept")).select(F.col("doc_id").alias("gone_id"), F.col("mark").alias("gone_mark"))
    once = once.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("mark") == F.col("gone_mark")), "left_anti")
    return stay.unionByName(once.select("row.*"))


def fresh() -> None:
    """In a Python worker that an earlier stage has used: drop the word caches that it holds."""
    tokens = sys.modules.get(f"{__package__}.tokens")
    if tokens is not None:
        tokens.forget()


def text_slices(batch, column: int, chars: int):
    """(first row, texts) of an Arrow batch, in even slices of at most about ``chars`` bytes or one text each: no more are
    Python objects at once."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    n = max(1, ceil(ends[-1] / chars)) if len(ends) else 0
    cuts = np.searchsorted(ends, ends[-1] * np.arange(1, n) / n) + 1 if n else []
    bounds = np.unique(np.r_[0, cuts, batch.num_rows]).astype(np.int64).tolist()
    for at, to in zip(bounds, bounds[1:]):
        yield at, batch.column(column).slice(at, to - at).to_pylist()
        pa.default_memory_pool().release_unused()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once a context; Arrow batches of the session hold ``ARROW_BYTES``
    at most unless it has a limit of its own."""
    context = spark.sparkContext
    if spark.conf.get(_ARROW) in _ARROW_DEFAULT:
        spark.conf.set(_ARROW, str(ARROW_BYTES))
    if getattr(context, "_millrace_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="millrace-")) / "millrace.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    context._millrace_shipped = True
