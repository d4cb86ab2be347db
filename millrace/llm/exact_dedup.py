"""Exact deduplication through an extendible-hash index in shared files (DataFrame functions only).

How it works
    1. Every text is lower-cased (A-Z) and gets a 64-bit key (xxHash64) and its SHA-256; these rows are stored. Keys are
       counted with map-side combining, so a group of copies that holds a third of all rows is a row a map task.
    2. The directory starts with one bucket. While a bucket holds more than ``bucket_rows`` keys it is split, doubling
       the directory when the bucket's local depth has reached the global one. It is stored with the index, has at most
       ``2 ** MAX_DEPTH`` entries and is broadcast; the top bits of a key lead to its bucket, a contiguous range of keys.
    3. A text whose key no other row has cannot have a copy: it becomes an entry without its text being moved (a bitmap of
       bounded size tells in place, with few false alarms). All other texts are routed through the directory to the
       owner of their bucket and key, equal ones combined on the map side first. Owners compare the bytes: texts that
       differ under one key are links of a chain, never merged.
    4. Entries (bucket, key, link of the chain, SHA-256, size, row that stays, rows) are written in ranges of bucket and
       key to shared files, and every row is answered from them: the directory leads it to its bucket, the key to its
       chain, the SHA-256 to its link. Entries of over a thousandth of the rows are broadcast (there are at most a
       thousand), all others meet in a shuffle join.

    Where ``2 ** MAX_DEPTH`` buckets of ``bucket_rows`` are not enough, buckets grow beyond that; their entries are still
    cut by ranges of keys, so no task holds a bucket for its size.

Defined results
    null text: as the empty text. null doc_id: a row like any other, smaller than every id (it stays only if all ids
    of its group are null). Repeated rows: copies of each other; each is returned. Empty table: no rows. Extra
    columns: ignored here, kept by :func:`drop_duplicates`, whatever their names and types.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import KeyFilter, join_classes, keep_decided, lower_ascii, materialize, parallelism, quoted, row_mark, scratch_path

#: The directory never has over 2 ** MAX_DEPTH entries, whatever the corpus.
MAX_DEPTH = 16
#: Keys that a bucket holds before it is split.
BUCKET_ROWS = 4_096


def split_buckets(counts: dict[int, int], depth: int, capacity: int) -> tuple[list[int], list[tuple[int, int, int]]]:
    """Grow an extendible-hash directory.

    ``counts``: texts by the top ``depth`` bits of their keys. Returns the directory over those ``2 ** depth`` cells
    (bucket number of each) and, for each bucket, its local depth, first cell and number of texts. A bucket with a
    single cell is not split further: what is over its capacity is chained in its file.
    """
    prefix = [0]
    for cell in range(1 << depth):
        prefix.append(prefix[-1] + counts.get(cell, 0))
    buckets, todo = [], [(0, 0)]
    while todo:
        local, first = todo.pop()
        width = 1 << (depth - local)
        held = prefix[first + width] - prefix[first]
        if held > capacity and width > 1:
            todo += [(local + 1, first + width // 2), (local + 1, first)]
        else:
            buckets.append((local, first, held))
    directory = [0] * (1 << depth)
    for number, (local, first, _) in enumerate(buckets):
        for cell in range(first, first + (1 << (depth - local))):
            directory[cell] = number
    return directory, buckets


def _cell(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth).cast("int") if depth else F.lit(0)


class DedupIndex:
    """The written index under ``path``: ``directory`` (cell, bucket, local_depth) and ``entries`` (bucket, key, link,
    text_sha256, n_bytes, keep_id, group_size)."""

    def __init__(self, path: str, depth: int, buckets: list, directory: DataFrame, entries: DataFrame, total: int):
        self.path, self.depth, self.buckets, self.directory, self.entries, self.total = path, depth, buckets, directory, entries, total

    @property
    def global_depth(self) -> int:
        return max((local for local, _, _ in self.buckets), default=0)

    def look_up(self, rows: DataFrame) -> DataFrame:
        """``rows`` (key, text_sha256 and others) with keep_id and group_size of their entries."""
        routed = route(rows, self.directory, self.depth)
        entries = self.entries.select("bucket", "key", "text_sha256", "keep_id", "group_size")
        return join_classes(routed, entries, ["bucket", "key", "text_sha256"], "group_size", self.total)


def route(rows: DataFrame, directory: DataFrame, depth: int) -> DataFrame:
    """``rows`` with the bucket that the directory has for their key."""
    cells = F.broadcast(directory.select("cell", "bucket"))  # 2 ** MAX_DEPTH rows at most
    return rows.withColumn("cell", _cell(F.col("key"), depth)).join(cells, "cell").drop("cell")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_bits: int = 64) -> DataFrame:
    """doc_id, normalised text and key of every row."""
    norm = F.coalesce(lower_ascii(quoted(text_col)), F.lit(""))
    key = F.shiftleft(F.xxhash64("norm"), 64 - key_bits) if key_bits < 64 else F.xxhash64("norm")
    return docs.select(quoted(id_col).alias("doc_id"), norm.alias("norm")).select("doc_id", "norm", key.alias("key"))


def summarized(docs: DataFrame, id_col: str, text_col: str, key_bits: int = 64) -> DataFrame:
    """A stored table without texts: doc_id, key, text_sha256, n_bytes and the row's mark."""
    norm = F.coalesce(lower_ascii(quoted(text_col)), F.lit(""))
    rows = docs.select(quoted(id_col).alias("doc_id"), norm.alias("norm"), row_mark(docs).alias("mark"))
    key = F.shiftleft(F.xxhash64("norm"), 64 - key_bits) if key_bits < 64 else F.xxhash64("norm")
    return materialize(rows.select("doc_id", key.alias("key"), F.sha2("norm", 256).alias("text_sha256"), F.octet_length("norm").cast("long").alias("n_bytes"), "mark"), "rows")


def build_index(docs: DataFrame, bucket_rows: int = BUCKET_ROWS, id_col: str = "doc_id", text_col: str = "text", key_bits: int = 64, rows: DataFrame | None = None) -> DedupIndex:
    """Index all texts of ``docs`` (``rows``: its :func:`summarized`). ``key_bits`` under 64 makes keys collide, for tests
    of the chains."""
    spark = docs.sparkSession
    rows = summarized(docs, id_col, text_col, key_bits) if rows is None else rows
    keys = materialize(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "keys")
    total, distinct, repeated = keys.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.count_if(F.col("n") > 1)).first()
    depth = min(MAX_DEPTH, max(0, ceil(log2(max(1, distinct / bucket_rows))) + 3))
    counts = {r[0]: r[1] for r in keys.groupBy(_cell(F.col("key"), depth).alias("c")).count().collect()}  # <= 2 ** MAX_DEPTH
    cells, buckets = split_buckets(counts, depth, bucket_rows)
    path = scratch_path(spark, "index")
    table = [(cell, number, buckets[number][0]) for cell, number in enumerate(cells)]
    spark.createDataFrame(table, "cell int, bucket int, local_depth int").coalesce(1).write.parquet(f"{path}/directory")
    directory = spark.read.parquet(f"{path}/directory")

    shared = KeyFilter(keys.filter("n > 1").select("key"), repeated)
    alone = route(shared.mark(rows, F.col("key")).filter(~F.col("listed")), directory, depth)
    alone = alone.select("bucket", "key", F.lit(0).alias("link"), "text_sha256", "n_bytes", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    texts = route(shared.mark(keyed(docs, id_col, text_col, key_bits), F.col("key")).filter("listed"), directory, depth)
    owned = texts.groupBy("bucket", "key", "norm").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    links = materialize(owned.select("bucket", "key", F.sha2("norm", 256).alias("text_sha256"), F.octet_length("norm").cast("long").alias("n_bytes"), "keep_id", "group_size"), "links")
    in_chain = F.row_number().over(Window.partitionBy("bucket", "key").orderBy("text_sha256")) - 1
    entries = alone.unionByName(links.withColumn("link", in_chain))
    owners = max(1, min(parallelism(spark), len(buckets)))
    ranged = entries.repartitionByRange(owners, "bucket", "key").sortWithinPartitions("bucket", "key", "link")
    ranged.write.option("compression", "zstd").parquet(f"{path}/entries")
    return DedupIndex(path, depth, buckets, directory, spark.read.parquet(f"{path}/entries"), total)


def exact_duplicates(docs: DataFrame, bucket_rows: int = BUCKET_ROWS, id_col: str = "doc_id", text_col: str = "text", key_bits: int = 64) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = summarized(docs, id_col, text_col, key_bits)
    found = build_index(docs, bucket_rows, id_col, text_col, key_bits, rows).look_up(rows)
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_duplicates(docs: DataFrame, bucket_rows: int = BUCKET_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts (the one with the largest doc_id), all columns kept.

    Where several rows share both the text and that doc_id, the one whose whole row hashes lowest stays. Rows without a
    copy are not moved.
    """
    rows = summarized(docs, id_col, text_col)
    found = build_index(docs, bucket_rows, id_col, text_col, rows=rows).look_up(rows).filter("group_size > 1")
    text, ours = ["bucket", "key", "text_sha256"], F.col("doc_id").eqNullSafe(F.col("keep_id"))
    alike = materialize(found.groupBy(*text, "doc_id", "mark").agg(F.first(ours).alias("ours"), F.count(F.lit(1)).alias("n")), "alike")
    own = alike.filter("ours")
    least = materialize(own.groupBy(*text).agg(F.min("mark").alias("least"), F.count(F.lit(1)).alias("marks")), "least")
    own = join_classes(own, least, text, "marks", own.count()).select("doc_id", "mark", (F.col("mark") == F.col("least")).alias("kept"))
    decided = alike.filter("NOT ours").select("doc_id", "mark", F.lit(False).alias("kept")).unionByName(own)
    return keep_decided(docs, id_col, materialize(decided, "decided"))
