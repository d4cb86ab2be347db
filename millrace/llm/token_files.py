"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

File format
    A token file is a folder of Parquet shards (any store that Spark writes to holds it). Row ``part, block`` is one
    block of whole documents in ascending doc_id order; blocks follow each other by (part, block). A row holds
    ``n_docs``, ``n_ids``, ``start_in_part`` (ids before the block in its part) and ``payload``:

        magic  b"MRT1" | n_docs u32 | n_ids u32 | control bytes u32 | all little-endian
        for each document: doc_id i64, count u32, null flag u8 (column by column)
        control bytes: two bits an id, four ids a byte, low bits first: bytes of the id less one; each document
        starts a new control byte
        data bytes: the ranks, little-endian, as long as their control bits say

    ``dictionary`` (a Parquet folder beside it) maps rank to id; ranks go by falling frequency in the file, so most ids
    take one byte. Decoding looks control bytes up in a 256 x 4 table and gathers data bytes with numpy.

How it is written
    Documents are tokenized once into a stored table of packed ids. That table is read once to count ids (as many sums as
    the vocabulary has) and once to be range-partitioned and sorted by doc_id; each task codes its range block by block
    and writes it. Every stage runs one Python worker a task, works on a batch's ids as one array, and holds one batch
    and one block at a time; word caches live in the tokenizing stage only.

Defined results
    null text: the end id alone. null doc_id: first in order. Repeated doc_ids: all kept, in a fixed order. Empty table:
    a file without blocks, no rows. Very long texts: one block can hold one document of any length. Extra columns:
    ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialize, parallelism, quoted, scratch_path, ship, text_slices
from .tokens import END_ID, SLICE_BYTES, encoder, forget, library, tokenizer_path

MAGIC = b"MRT1"
#: A block closes at so many ids (a longer document has a block of its own).
BLOCK_IDS = 500_000

#: Of each control byte: the lengths of its four ids.
LENGTHS = np.array([[(c >> s & 3) + 1 for s in (0, 2, 4, 6)] for c in range(256)], dtype=np.uint8)


def code_ranks(ranks: np.ndarray, counts: np.ndarray | None = None) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit numbers; of documents with ``counts`` numbers each, whose control bytes
    each start anew."""
    ranks = np.ascontiguousarray(ranks, dtype="<u4")
    counts = np.array([len(ranks)]) if counts is None else counts
    size = 1 + (ranks > 0xFF).view(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    quads = -(-counts // 4)
    spare = np.cumsum(4 * quads - counts) - (4 * quads - counts)  # unused slots before each document
    slots = np.zeros(4 * int(quads.sum()), dtype=np.uint8)
    slots[np.arange(len(ranks)) + np.repeat(spare, counts)] = size - 1
    slots = slots.reshape(-1, 4)
    control = slots[:, 0] | slots[:, 1] << 2 | slots[:, 2] << 4 | slots[:, 3] << 6
    at = np.cumsum(size, dtype=np.int64) - size
    data = np.empty(int(at[-1]) + int(size[-1]) if len(at) else 0, dtype=np.uint8)
    data[at] = ranks
    more = np.arange(len(ranks))
    for k in (1, 2, 3):
        more = more[size[more] > k]
        data[at[more] + k] = ranks[more] >> np.uint32(8 * k)
    return control.astype(np.uint8).tobytes(), data.tobytes()


def decode_ranks(control: np.ndarray, data: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of documents with ``counts`` ids each, whose control bytes each start anew."""
    quads = -(-counts // 4)
    slots = np.ones(4 * len(control), dtype=bool)
    spare = 4 * quads - counts  # 0 to 3 unused slots at each document's end
    ends = np.cumsum(4 * quads)
    for k in (1, 2, 3):
        slots[ends[spare >= k] - k] = False
    size = LENGTHS[control].reshape(-1)[slots]
    at = np.cumsum(size, dtype=np.int64) - size
    out = data[at].astype(np.uint32)
    more = np.arange(len(size))
    for k in (1, 2, 3):
        more = more[size[more] > k]
        out[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def pack_block(ids: list, counts: list[int], controls: list[bytes], datas: list[bytes]) -> bytes:
    control = b"".join(controls)
    head = struct.pack("<4sIII", MAGIC, len(ids), sum(counts), len(control))
    return b"".join(
        [head, np.array([i or 0 for i in ids], dtype="<i8").tobytes(), np.array(counts, dtype="<u4").tobytes(), np.array([i is None for i in ids], dtype=np.uint8).tobytes(), control, *datas]
    )


def flat_ids(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, number of ids of each row) of a binary column, without a copy."""
    if not len(column):
        return np.zeros(0, dtype=kind), np.zeros(0, dtype=np.int64)
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    ends = np.frombuffer(column.buffers()[1], wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(kind), np.diff(ends) // np.dtype(kind).itemsize


def unpack_block(payload: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """doc_ids, counts and ranks of a block."""
    magic, n, _, n_control = struct.unpack_from("<4sIII", payload)
    if magic != MAGIC:
        raise ValueError("not a token block")
    ids = np.frombuffer(payload, "<i8", n, 16)
    counts = np.frombuffer(payload, "<u4", n, 16 + 8 * n).astype(np.int64)
    nulls = np.frombuffer(payload, np.uint8, n, 16 + 12 * n)
    control = np.frombuffer(payload, np.uint8, n_control, 16 + 13 * n)
    data = np.frombuffer(payload, np.uint8, -1, 16 + 13 * n + n_control)
    return [None if z else int(i) for i, z in zip(ids, nulls)], counts, decode_ranks(control, data, counts)


def _encoded(docs: DataFrame, tokenizer: str, wide: bool) -> DataFrame:
    end, kind = END_ID.to_bytes(4, "little"), "<u4" if wide else "<u2"

    def encode(batches):
        for batch in batches:
            for at, part in text_slices(batch, 1, SLICE_BYTES):
                found = [np.frombuffer(x + end, "<u4").astype(kind).tobytes() for x in encoder(tokenizer).encode(part)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), pa.array(found, pa.binary())], names=["doc_id", "ids"])

    return docs.mapInArrow(encode, "doc_id long, ids binary")


class TokenFile:
    """A written token file: ``path`` and, by part, the number of ids before it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        totals = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()  # a row a written partition
        self.base, total = {}, 0
        for part, n in totals:
            self.base[part] = total
            total += n
        self.n_ids = total

    def read(self) -> DataFrame:
        """One row a document, decoded: doc_id, start, ids (little-endian unsigned 32-bit)."""
        return self._decoded("ids binary", lambda flat, counts: [pa.array([flat[e - c : e].tobytes() for e, c in zip(np.cumsum(counts), counts)], pa.binary())])

    def digests(self) -> DataFrame:
        """One row a document from its decoded ids: doc_id, start, n_tokens, ids_crc32."""

        def made(flat, counts):
            data, ends = memoryview(flat.tobytes()), np.cumsum(counts)
            crcs = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip((ends - counts).tolist(), ends.tolist())]
            return [pa.array(counts, pa.int64()), pa.array(crcs, pa.int64())]

        return self._decoded("n_tokens long, ids_crc32 long", made)

    def _decoded(self, columns: str, made) -> DataFrame:
        base = self.base
        ranked = self.spark.read.parquet(f"{self.path}/dictionary").orderBy("rank").collect()  # as many rows as the vocabulary at most
        back = np.array([r["id"] for r in ranked], dtype="<u4")
        names = ["doc_id", "start", *(c.split()[0] for c in columns.split(", "))]

        def decode(batches):
            forget()
            for batch in batches:
                for i in range(batch.num_rows):
                    part, before, payload = (batch.column(k)[i].as_py() for k in range(3))
                    ids, counts, ranks = unpack_block(payload)
                    starts = base[part] + before + np.cumsum(counts) - counts
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), *made(back[ranks], counts)], names=names)

        return self.spark.read.parquet(f"{self.path}/blocks").select("part", "start_in_part", "payload").mapInArrow(decode, f"doc_id long, start long, {columns}")


def write_token_file(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> TokenFile:
    spark = docs.sparkSession
    ship(spark)
    vocabulary = max(library(tokenizer).get_vocab_size(with_added_tokens=True), END_ID + 1)
    wide = vocabulary > 1 << 16
    kind = "<u4" if wide else "<u2"
    found = materialize(_encoded(docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).alias("text")), tokenizer, wide), "ids")

    def count(batches):
        forget()
        total = np.zeros(vocabulary, dtype=np.int64)
        for batch in batches:
            total += np.bincount(flat_ids(batch.column(0), kind)[0], minlength=vocabulary)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["id", "n"])

    counted = found.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()  # at most the vocabulary
    order = [r["id"] for r in sorted(counted, key=lambda r: (-r["n"], r["id"]))]
    spark.createDataFrame([(i, int(x)) for i, x in enumerate(order)], "rank long, id long").coalesce(1).write.parquet(f"{path}/dictionary")
    rank = np.zeros(vocabulary, dtype=np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)

    def blocks(batches):
        from pyspark import TaskContext

        forget()
        part, block, before = TaskContext.get().partitionId(), 0, 0
        held: list[list] = [[], [], [], []]  # ids, counts, control and data bytes

        def close():
            nonlocal block, before, held
            row = [[part], [block], [len(held[0])], [sum(held[1])], [before], [pack_block(*held)]]
            block, before, held = block + 1, before + sum(held[1]), [[], [], [], []]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, kinds)], names=["part", "block", "n_docs", "n_ids", "start_in_part", "payload"])

        size = 0
        for batch in batches:
            ids, (flat, counts) = batch.column(0).to_pylist(), flat_ids(batch.column(1), kind)
            ends, at = np.cumsum(counts), 0
            while at < len(ids):
                # as many documents as the block takes yet, one at least if it is empty
                fits = int(np.searchsorted(ends, BLOCK_IDS - size + (ends[at - 1] if at else 0), side="right"))
                to = max(fits, at + (not held[0]))
                if to == at:
                    yield close()
                    size = 0
                    continue
                control, data = code_ranks(rank[flat[ends[at] - counts[at] : ends[to - 1]]], counts[at:to])
                for column, x in zip(held, (ids[at:to], counts[at:to].tolist(), [control], [data])):
                    column += x
                size += int(counts[at:to].sum())
                at = to
        if held[0]:
            yield close()

    ranged = found.repartitionByRange(parallelism(spark), "doc_id").sortWithinPartitions("doc_id", "ids")
    written = ranged.mapInArrow(blocks, "part int, block int, n_docs long, n_ids long, start_in_part long, payload binary")
    written.write.option("compression", "none").parquet(f"{path}/blocks")
    discard(found)
    return TokenFile(spark, path)


def token_rows(docs: DataFrame, path: str | None = None, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write a token file and read it back: doc_id, start, n_tokens, ids_crc32 of every document."""
    path = path or scratch_path(docs.sparkSession, "tokens")
    file = write_token_file(docs, path, tokenizer or tokenizer_path("word_bpe_49k.json"), id_col, text_col)
    return file.digests()
