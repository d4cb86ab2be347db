"""SimHash near-duplicates: fingerprints that differ in few bits, joined over segment popcounts.

How it works
    1. Documents are fingerprinted where they lie: a 64-bit vote over the XXH64 of all word shingles.
    2. Equal fingerprints become one class, however many documents share them.
    3. A fingerprint is embedded as the bit counts of its segments. The Manhattan distance of two embeddings never
       exceeds the Hamming distance of the fingerprints. Counts are kept in unary, so that distance is a popcount too.
    4. Grid range-join: within a distance of 4, one half of the segments differs by 2 at most, so two such halves have
       a grid cell within distance 1 of both. Each class is put in the cells around each of its halves. A cell's members
       meet in one task, sorted, and are compared by the lower bound first and then exactly, in whole arrays; a cell
       leaves a spanning forest of its links, one row a member at most, never its pairs.
    5. Cells with over ``CROWD`` members, counted beforehand, never meet in one task: their members go to all points
       within 2 bits of them. Two fingerprints within 4 bits always share such a point and two that share one are within
       4 bits, so linking every member to its point's least member keeps all components, with rows in proportion to the
       members.
    6. Components are found by star contraction over stored tables.

Defined results
    null text: as the empty text, fingerprint zero. Fewer words than a shingle: the whole sequence is the shingle. null
    doc_id: a row like any other; component_id ignores it, and is null if a component has no id. Repeated rows: each
    returned. Empty table: no rows. Extra columns: ignored here, kept by :func:`one_of_each_group`.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, join_classes, keep_decided, materialize, parallelism, quoted, row_mark, ship, text_slices
from .components import connected_components

DISTANCE = 4
WIDTH = 4
SEED = 42
#: A cell with more members is linked through points instead of being held in one task.
CROWD = 2_000
#: Bytes of texts that are Python objects at once.
SLICE_BYTES = 2_000_000
#: Members that are compared in one go (whole cells).
CELL_ROWS = 50_000
_LOW_BITS = 0x5555555555555555
_WEIGHT = np.uint64(1) << np.arange(64, dtype=np.uint64)


def shingle_hashes(text: str | None, width: int = WIDTH, seed: int = SEED) -> np.ndarray:
    """XXH64 of every shingle of a text, repeats included."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxh64_intdigest(joined, seed)], dtype=np.uint64)
    ends = list(accumulate(map((1).__add__, map(len, words))))
    return np.array([xxh64_intdigest(joined[a : b - 1], seed) for a, b in zip([0, *ends], ends[width - 1 :])], dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is 1 if it is set in over half of the hashes."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        counts += np.unpackbits(hashes[at : at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(_WEIGHT[2 * counts > len(hashes)].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: Column | None = None) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) and, where it is given, the long ``mark`` of each row."""
    ship(docs.sparkSession)
    marks = [] if mark is None else [mark.alias("mark")]

    def run(batches):
        fresh()
        for batch in batches:
            found = np.array([fingerprint(shingle_hashes(t)) for _, part in text_slices(batch, 1, SLICE_BYTES) for t in part], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64), pa.int64()), *batch.columns[2:]], names=["doc_id", "fp", "mark"][: batch.num_columns])

    rows = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).alias("text"), *marks)
    return rows.mapInArrow(run, "doc_id long, fp long" + ", mark long" * len(marks))


def unary_counts(fp: Column, fine: bool) -> Column:
    """The bit counts of all segments in unary. One-bit segments: the fingerprint itself."""
    if fine:
        return fp
    low, high = fp.bitwiseAND(F.lit(_LOW_BITS)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(_LOW_BITS))
    return low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _moved(own: Column, fine: bool):
    """The cell one step from ``own`` at a bit, as a function of the bit; null where counts have no such step."""

    def near(i: Column) -> Column:
        moved = own.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))
        if fine:
            return moved
        # in unary the first bit of a segment may change while the second is 0, the second while the first is 1
        first = i % 2 == 0
        other = F.call_function("shiftrightunsigned", own, F.when(first, i + 1).otherwise(i - 1)).bitwiseAND(F.lit(1))
        return F.when(other == F.when(first, 0).otherwise(1), moved)

    return near


def cells(counts: Column, fine: bool) -> Column:
    """The grid cells within a distance of 1 of either half of an embedding, as an array of longs."""
    found = []
    for half in (0, 1):
        own = F.shiftrightunsigned(counts, 32 * half).bitwiseAND(F.lit(0xFFFFFFFF)).bitwiseOR(F.lit(half << 32))
        found.append(F.concat(F.array(own), F.transform(F.sequence(F.lit(0), F.lit(31)), _moved(own, fine))))
    return F.filter(F.concat(*found), lambda c: c.isNotNull())


def embedded(fps: np.ndarray, fine: bool) -> np.ndarray:
    """:func:`unary_counts` of an array of fingerprints."""
    if fine:
        return fps
    low, high = fps & np.uint64(_LOW_BITS), fps >> np.uint64(1) & np.uint64(_LOW_BITS)
    return low | high | (low & high) << np.uint64(1)


def _join_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of the pairs (a, b) in ``root``, which holds every place's root (the least place) before and after."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not (root[root] == root).all():
            root[:] = root[root]


def cell_forest(cell: np.ndarray, fps: np.ndarray, fine: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): a spanning forest of the links inside each cell. Rows are sorted by cell; ``fps`` are unsigned.

    Members are compared with the one d places on, for every d: members that are joined already are passed over, the
    others take the lower bound and then the exact distance. Memory is in proportion to the members.
    """
    n = len(cell)
    change = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1], True]) if n else np.zeros(1, dtype=np.int64)
    end = np.repeat(change[1:], np.diff(change))
    counts, root, left, d = embedded(fps, fine), np.arange(n), np.arange(n), 1
    while len(left := left[left + d < end[left]]):
        i = left[root[left] != root[left + d]]
        i = i[np.bitwise_count(counts[i] ^ counts[i + d]) <= DISTANCE]
        i = i[np.bitwise_count(fps[i] ^ fps[i + d]) <= DISTANCE]
        _join_roots(root, i, i + d)
        d += 1
    joined = np.flatnonzero(root != np.arange(n))
    return fps[root[joined]], fps[joined]


def _forests(fine: bool):
    def run(batches):
        fresh()
        held = [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)]

        def edges(cell, fps):
            a, b = cell_forest(cell, fps, fine)
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64), pa.int64()) for x in (a, b)], names=["a", "b"])

        for batch in batches:
            cell = np.concatenate([held[0], batch.column(0).to_numpy()])
            fps = np.concatenate([held[1], batch.column(1).to_numpy().view(np.uint64)])
            cut = int(np.searchsorted(cell, cell[-1])) if len(cell) >= CELL_ROWS else 0  # the last cell may go on
            if cut:
                yield edges(cell[:cut], fps[:cut])
            held = [cell[cut:], fps[cut:]]
        yield edges(*held)

    return run


def links(classes: DataFrame, crowd: int = CROWD, fine: bool = False) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp, a stored table) that keep all links' components.

    Segments are two bits wide whatever the number of fingerprints; ``fine`` takes one-bit segments, with equal links.
    """
    spark = classes.sparkSession
    ship(spark)
    held = classes.repartition(parallelism(spark), "fp").select("fp", unary_counts(F.col("fp"), fine).alias("counts"))
    put = held.select("fp", F.explode(cells(F.col("counts"), fine)).alias("cell"))
    crowded = put.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowd)
    crowded = materialize(crowded.select("cell"), "crowded")
    busy = bool(crowded.take(1))
    light = put.join(crowded, "cell", "left_anti") if busy else put
    light = light.select("cell", "fp").repartition(parallelism(spark), "cell").sortWithinPartitions("cell", "fp")
    edges = light.mapInArrow(_forests(fine), "a long, b long").distinct()
    if busy:
        members = materialize(put.join(crowded, "cell", "left_semi").select("fp").distinct(), "members")
        signed = [m - (1 << 64) if m >> 63 else m for m in (0, *(1 << i for i in range(64)), *(1 << i | 1 << j for i, j in combinations(range(64), 2)))]
        points = members.select("fp", F.explode(F.transform(F.lit(signed), lambda m: F.col("fp").bitwiseXOR(m))).alias("point"))
        least = points.groupBy("point").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1")  # 2,081 members at most
        edges = edges.unionByName(points.join(least, "point").select(F.col("fp").alias("a"), "b").filter("a <> b")).distinct()
    return edges


def labelled_rows(rows: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``rows`` (a stored table with doc_id and fp) with label, unlike for each component, and its component_id."""
    classes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "classes")
    labels = connected_components(links(classes, crowd))
    labelled = classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    labelled = materialize(labelled, "labelled")
    groups = labelled.groupBy("label").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("members"))
    named = join_classes(labelled, groups, ["label"], "members", labelled.count())
    named = materialize(named.select("fp", "n", "label", "component_id"), "named")
    return join_classes(rows, named, ["fp"], "n", rows.count())


def near_duplicates(docs: DataFrame, crowd: int = CROWD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document."""
    found = labelled_rows(materialize(fingerprints(docs, id_col, text_col), "fingerprints"), crowd)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, all columns kept: the one of least doc_id.

    A row without an id stays only where its whole component has none. Of rows that share the least id the one of least
    fingerprint stays, then the one whose whole row hashes lowest; of rows that are equal throughout, one. Rows that are
    alone in their component are not moved.
    """
    found = labelled_rows(materialize(fingerprints(docs, id_col, text_col, row_mark(docs)), "fingerprints"))
    alike = materialize(found.groupBy("label", "doc_id", "fp", "mark").agg(F.count(F.lit(1)).alias("n")), "alike")
    first = alike.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", "mark")).alias("first"), F.sum("n").alias("members"), F.count(F.lit(1)).alias("kinds"))
    groups = materialize(first.filter("members > 1"), "groups")
    several = join_classes(alike, groups, ["label"], "kinds", alike.count())
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark"))
    return keep_decided(docs, id_col, materialize(several.select("doc_id", "mark", kept.alias("kept")), "decided"))
