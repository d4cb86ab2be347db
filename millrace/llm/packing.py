"""Best-fit packing: pieces of documents into sequences of at most ``capacity`` tokens.

How it works
    Documents are tokenized where they lie; only piece rows (numbers) are kept. A document with more than ``capacity``
    tokens is cut into full pieces, the first of which may be shorter. Pieces are dealt at random, by a hash, to groups
    of about ``group_rows``; each group runs best-fit decreasing with a segment tree over remaining capacities: every
    piece goes to the open sequence it fits tightest, found in log2(capacity) steps. A group leaves only a few
    sequences part filled, so the number of groups does not show in the total.

Defined results
    null text: the empty text, which is the end id alone. null or repeated doc_id: rows are packed like any others, each
    with its own pieces. Ties: equal lengths go in an order fixed by the written piece table. Empty table: no rows. Very
    long texts: cut, never dropped. Extra columns: ignored.
"""

from __future__ import annotations

import zlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, quoted, ship, text_slices
from .tokens import END_ID, encoder, tokenizer_path

CAPACITY = 1024
#: Bytes of text that are encoded in one go.
SLICE_BYTES = 2_000_000
PIECES = "doc_id long, uid long, piece int, start long, length long, ids_crc32 long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class OpenBins:
    """Open sequences by remaining capacity under a segment tree; a leaf is one capacity."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = [False] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, remaining: int, number: int) -> None:
        self.bins[remaining].append(number)
        node = remaining + self.leaves
        while node and not self.tree[node]:
            self.tree[node] = True
            node >>= 1

    def tightest(self, length: int) -> int:
        """The least remaining capacity >= length of an open sequence, -1 if there is none."""
        node, tree = length + self.leaves, self.tree
        if tree[node]:
            return length
        while node > 1:
            if not node & 1 and tree[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if tree[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return -1

    def take(self, remaining: int) -> int:
        number = self.bins[remaining].pop()
        if not self.bins[remaining]:
            node = remaining + self.leaves
            self.tree[node] = False
            node >>= 1
            while node:
                self.tree[node] = self.tree[2 * node] or self.tree[2 * node + 1]
                node >>= 1
        return number


def best_fit(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[int], list[int]]:
    """For pieces in decreasing length: the sequence and the offset of each."""
    bins, sequence, offset, opened = OpenBins(capacity), [], [], 0
    for length in lengths:
        remaining = bins.tightest(length)
        if remaining < 0:
            number, remaining, opened = opened, capacity, opened + 1
        else:
            number = bins.take(remaining)
        sequence.append(number)
        offset.append(capacity - remaining)
        if remaining > length:
            bins.put(remaining - length, number)
    return sequence, offset


def cut_pieces(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all full but perhaps the first."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))] if n else []


def document_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of every document; ids are END_ID-terminated."""

    ship(docs.sparkSession)

    def cut(batches):
        from pyspark import TaskContext

        encode, uid, end = encoder(tokenizer).encode, TaskContext.get().partitionId() << 33, END_ID.to_bytes(4, "little")
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at, part in text_slices(batch, 1, SLICE_BYTES):
                rows = []
                for k, data in enumerate(encode(part)):
                    data += end
                    uid += 1
                    for piece, (start, length) in enumerate(cut_pieces(len(data) // 4, capacity)):
                        rows.append((ids[at + k], uid, piece, start, length, zlib.crc32(data[4 * start : 4 * (start + length)])))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    names=["doc_id", "uid", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).alias("text")).mapInArrow(cut, PIECES)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, group_rows: int = 50_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = materialize(document_pieces(docs, tokenizer or tokenizer_path("byte_bpe_50k.json"), capacity, id_col, text_col), "pieces")
    groups = max(1, -(-pieces.count() // group_rows))

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "uid", "piece"], ascending=[False, True, True], kind="stable")
        number, offset = best_fit(rows["length"].tolist(), capacity)
        base = int(rows["group"].iloc[0]) << 32
        return rows.assign(sequence_id=[base + n for n in number], offset=offset)[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("uid", "piece"), F.lit(groups)))
    return dealt.groupBy("group").applyInPandas(fit, PACKED)
