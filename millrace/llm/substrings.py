"""Suffix-array deduplication: every byte covered by a 100-byte string that also starts earlier goes.

How it works
    Suffixes need to be told apart to a depth of ``SPAN`` bytes only, and the suffix array is refined bucket by bucket:

    1. Texts become stored chunks, bucketed by number, so that they are never shuffled again. The initial buckets
       are q-grams (``GRAM`` bytes, hashed). Of the q-grams inside each SPAN-byte string only the least hash, the
       leftmost of equals, stands for it: equal strings are stood for at the same offset, and one q-gram in about 31
       is enough to find all of them.
    2. A bucket with one suffix in the whole corpus needs no refining. In the others, suffixes that are stood for by one
       q-gram form a segment; equal segments (by a 96-bit digest) are one class, of which the earliest stays.
    3. Where a bucket holds several classes, the suffixes of the classes' earliest segments are refined by
       bucket-pointer refinement, across all chunks: the bucket of a suffix to depth 2 * GRAM is its own bucket and the
       one that its suffix GRAM bytes on lies in. Buckets that are down to one suffix in the whole corpus are done; the
       others are refined once more, by the bucket SPAN - GRAM bytes on, to depth SPAN, reusing the pointers.
    4. The earliest suffix of each final bucket stays, all others mark their SPAN bytes.

    Chunks ask owners of hash ranges, many keys to a row, through the tree of :mod:`exchange`. A chunk settles its own
    repeats first, so that a passage that a third of all documents share reaches its owner once a chunk, or once for many
    chunks where there is more than one level. Counts, first places and answers are all that moves; no text does.

Defined results
    null text: empty. Texts under SPAN bytes: nothing removed. null doc_id: before all ids; rows with equal ids: in an order
    fixed by the stored chunks. Empty table: no rows. Very long texts: cut into overlapping parts, result unchanged. Extra
    columns: ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parallelism, quoted, scratch_table, ship, text_slices, written_once
from .exchange import ASKED, FAN, SEVERAL, Rule, answers_of, gathered, pack_bits, pack_counts, pack_keys, resolve, table_of, unpack_bits, unpack_counts, unpack_keys

SPAN, GRAM = 100, 40
CHUNK_CHARS = 2_000_000
#: Longer texts are cut into parts that overlap by SPAN - 1 bytes.
PART_BYTES = 1 << 19
#: Parts of so many bytes in all are worked on together; their places fit in the low bits of a q-gram's rank.
RUN_BYTES, PLACE_BITS = 1 << 19, 26
OWNER_KEYS = 1_000_000
#: To tell lone q-grams from others their top 48 bits do: a chance meeting only makes a candidate.
GRAM_SHIFT = np.uint64(16)
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE ** i and its inverse modulo 2 ** 64, up to n."""
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for base in (_BASE, inverse):
        power, top = np.ones(1, dtype=np.uint64), base
        while len(power) < n:
            power = np.concatenate([power, power * np.uint64(top)])
            top = top * top % (1 << 64)
        out.append(power[:n].copy())
    return out[0], out[1]


_cached: list = [np.ones(0, dtype=np.uint64), np.ones(0, dtype=np.uint64)]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes that start at each place (the last GRAM - 1 places: none)."""
    n = len(data)
    if n < GRAM:
        return np.zeros(0, dtype=np.uint64)
    if len(_cached[0]) < n + 1:
        _cached[:] = _powers(max(n + 1, 1 << 20))
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _cached[0][:n], out=sums[1:])
    h = (sums[GRAM:] - sums[:-GRAM]) * _cached[1][: n - GRAM + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def spread(hashes: np.ndarray) -> np.ndarray:
    """Hashes mixed once more, one to one: the least of many hashes are small, and owners of ranges would not share them
    evenly."""
    h = hashes * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def window_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row: block minima from the left and the right."""
    n = len(values)
    padded = np.full(-(-n // width) * width + width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    left = np.minimum.accumulate(rows, axis=1).reshape(-1)
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def parts_of(texts: list) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The parts of texts, the text of each part and where in its text it starts."""
    parts, owner, start = [], [], []
    for k, t in enumerate(texts):
        data = t if isinstance(t, bytes) else (t or "").encode("utf-8", "surrogatepass")
        for at in range(0, max(1, len(data) - SPAN + 1), PART_BYTES):
            parts.append(data[at : at + PART_BYTES + SPAN - 1])
            owner.append(k)
            start.append(at)
    return parts, np.array(owner, dtype=np.int64), np.array(start, dtype=np.int64)


class Segments:
    """What stands for the SPAN-byte strings of a chunk: ``gram`` hash, first string ``first`` (place in the chunk's
    joined parts) and the number of strings ``many`` of each segment; ``hashes`` of all places, which is all that there is
    with ``hashes_only``."""

    def __init__(self, parts: list[bytes], hashes_only: bool = False):
        self.hashes_only, self.data = hashes_only, b"".join(parts)
        flat = np.frombuffer(self.data, dtype=np.uint8)
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        ends = np.cumsum(sizes)
        self.part_start = ends - sizes
        found, self.hashes = [], np.zeros(len(flat), dtype=np.uint64)
        at = 0
        while at < len(parts):
            to = at + 1
            while to < len(parts) and ends[to] - self.part_start[at] < RUN_BYTES:
                to += 1
            found.append(self._run(flat, int(self.part_start[at]), int(ends[to - 1]), ends[at:to], sizes[at:to]))
            at = to
        self.gram, self.first, self.many = (np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)]

    def _run(self, flat, start, end, ends, sizes):
        none = (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
        h = gram_hashes(flat[start:end])
        self.hashes[start : start + len(h)] = h
        width = SPAN - GRAM + 1
        if len(h) < width or self.hashes_only:
            return none
        low = np.uint64((1 << PLACE_BITS) - 1)
        least = window_least((h & ~low) | np.arange(len(h), dtype=np.uint64), width) & low
        valid = np.zeros(end - start + 1, dtype=np.int64)
        long = sizes >= SPAN
        first, last = (ends - sizes - start)[long], (ends - SPAN - start)[long]
        valid[first] += 1
        np.subtract.at(valid, last + 1, 1)
        valid = np.cumsum(valid)[: len(least)] > 0
        begin = np.zeros(len(least), dtype=bool)
        begin[first] = True
        places = np.flatnonzero(valid)
        if not len(places):
            return none
        anchor = least[places].astype(np.int64)
        change = np.r_[True, anchor[1:] != anchor[:-1]] | begin[places]
        at = np.flatnonzero(change)
        return spread(h[anchor[at]]), places[at] + start, np.diff(np.r_[at, len(places)])


def _doc_key(ids: list) -> np.ndarray:
    return np.array([-(1 << 63) if i is None else i for i in ids], dtype=np.int64)


def earliest(hi: np.ndarray, lo: np.ndarray, doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): rows by key and then by (doc, place), and which of them begin a key."""
    order = np.lexsort((place, doc, lo, hi))
    hi, lo = hi[order], lo[order]
    return order, np.r_[True, (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])] if len(hi) else np.zeros(0, dtype=bool)


def refine(bucket: np.ndarray, pointed: np.ndarray) -> np.ndarray:
    """The refined buckets, as 64-bit identifiers that all chunks share: a suffix's own bucket and the one that a later
    offset of it points to."""
    h = bucket * np.uint64(0x9E3779B97F4A7C15) ^ (pointed * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(7))
    h ^= pointed + (h >> np.uint64(31))
    h *= np.uint64(0x165667B19E3779F9)
    return h ^ (h >> np.uint64(33))


def _rest(bucket: np.ndarray, pointed: np.ndarray) -> np.ndarray:
    """32 more bits of the identifier of a final bucket."""
    h = (bucket ^ (pointed << np.uint64(21) | pointed >> np.uint64(43))) * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h >> np.uint64(32)


def _beside(df: DataFrame, name: str, buckets: int) -> DataFrame:
    """Store chunks, or what joins with them made, in buckets by chunk: nothing is shuffled, here or in later joins.

    A task writes a file for each bucket that its chunks fall in, so files are as many as chunks at most; with a shuffle
    before they would be as many as buckets, but texts would move and executors held 3,679 MB in the tool's run.
    """
    spark = df.sparkSession
    table, path = scratch_table(spark, name)
    with written_once(spark):
        df.write.bucketBy(buckets, "chunk").option("path", path).option("compression", "zstd").format("parquet").saveAsTable(table)
    return spark.table(table)


def _batch(rows: dict, kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds)], names=list(rows))


def _pack_places(lo: np.ndarray, doc: np.ndarray) -> bytes:
    """What goes with keys: the documents once, then of each key its document's number and the rest of its digest."""
    docs, number = np.unique(doc, return_inverse=True)
    head = zlib.compress(np.diff(docs, prepend=0).tobytes(), 1)
    kind = "<u2" if len(docs) <= 1 << 16 else "<u4"
    return b"".join([len(head).to_bytes(4, "little"), len(docs).to_bytes(4, "little"), head, number.astype(kind).tobytes(), lo.astype("<u4").tobytes()])


def _unpack_places(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    head, docs = (int.from_bytes(data[i : i + 4], "little") for i in (0, 4))
    ids = np.cumsum(np.frombuffer(zlib.decompress(data[8 : 8 + head]), np.int64))
    width = 2 if docs <= 1 << 16 else 4
    n = (len(data) - 8 - head) // (width + 4)
    return np.frombuffer(data, "<u4", n, 8 + head + width * n), ids[np.frombuffer(data, f"<u{width}", n, 8 + head)]


def _asking(chunk: int, keys: np.ndarray, rest: bytes) -> pa.RecordBatch:
    """One row of :data:`exchange.ASKED` of sorted keys and what goes with them."""
    return table_of(ASKED, {"member": [chunk], "kind": [0], "keys": [pack_keys(keys)], "rest": [rest]})


def _firsts(keys: list, values: list):
    """Of all places of a key (two hashes) the earliest: the least document, then the first member."""
    hi, number = np.concatenate(keys), np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    lo, doc = (np.concatenate([v[i] for v in values]) for i in range(2))
    order = np.lexsort((number, doc, lo, hi))  # a member sends its earliest place only
    first = np.r_[True, (np.diff(hi[order]) != 0) | (np.diff(lo[order]) != 0)] if len(hi) else np.zeros(0, dtype=bool)
    flags, place = np.zeros(len(hi), dtype=bool), np.empty(len(hi), dtype=np.int64)
    lead = order[first]
    flags[lead] = True
    place[order] = np.cumsum(first) - 1
    ends = np.cumsum([0, *map(len, keys)])
    spans = list(zip(ends, ends[1:]))
    return hi[lead], (lo[lead], doc[lead]), [flags[a:b] for a, b in spans], [place[a:b] for a, b in spans], len(lead)


#: Is a member's place of a key the earliest of all members' places?
FIRST = Rule(_unpack_places, lambda v: _pack_places(*v), lambda v, a, b: (v[0][a:b], v[1][a:b]), _firsts, lambda own, back: own & back, pack_bits, unpack_bits)


def _rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _ids_at(row: dict, owner: np.ndarray, part: np.ndarray) -> np.ndarray:
    return _doc_key(row["doc_ids"])[owner[part]]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_chars: int = CHUNK_CHARS, owner_keys: int = OWNER_KEYS, fan: int = FAN) -> DataFrame:
    """doc_id, n_bytes, spans (removed [start, end) pairs) and kept (the remaining bytes) of every document."""
    return _apply(docs, id_col, text_col, chunk_chars, owner_keys, fan, digest=False)


def removed_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_chars: int = CHUNK_CHARS, owner_keys: int = OWNER_KEYS, fan: int = FAN) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    return _apply(docs, id_col, text_col, chunk_chars, owner_keys, fan, digest=True)


def _apply(docs: DataFrame, id_col: str, text_col: str, chunk_chars: int, owner_keys: int, fan: int, digest: bool) -> DataFrame:
    spark = docs.sparkSession
    ship(spark)
    buckets = parallelism(spark)

    def cut(batches):
        from pyspark import TaskContext

        chunk, held_ids, held, size = TaskContext.get().partitionId() << 32, [], [], 0

        def close():
            nonlocal chunk, held_ids, held, size
            grams, counts = np.unique(Segments(parts_of(held)[0]).gram >> GRAM_SHIFT << GRAM_SHIFT, return_counts=True)
            rows = {"chunk": [chunk], "doc_ids": [held_ids], "sizes": [[len(d) for d in held]], "text": [zlib.compress(b"".join(held), 1)], "grams": [pack_keys(grams >> GRAM_SHIFT)], "counts": [pack_counts(counts)], "n": [len(grams)]}
            chunk, held_ids, held, size = chunk + 1, [], [], 0
            return _batch(rows, [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.int64()])

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at, texts in text_slices(batch, 1, chunk_chars):
                for i, t in enumerate(texts):
                    if held and size + len(t or "") > chunk_chars:
                        yield close()
                    held_ids.append(ids[at + i])
                    held.append((t or "").encode("utf-8", "surrogatepass"))
                    size += len(t or "")
        if held:
            yield close()

    source = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).alias("text"))
    chunks = _beside(source.mapInArrow(cut, "chunk long, doc_ids array<long>, sizes array<long>, text binary, grams binary, counts binary, n long"), "chunks", buckets)
    members, n_keys = chunks.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    owners = max(buckets, -(-n_keys // owner_keys))

    def ask(asking: DataFrame, rule: Rule) -> DataFrame:
        return resolve(asking, members, owners, rule, fan)

    def texts_of(row):
        data, sizes = zlib.decompress(row["text"]), np.array(row["sizes"], dtype=np.int64)
        ends = np.cumsum(sizes)
        return [data[e - n : e] for n, e in zip(sizes.tolist(), ends.tolist())]

    def opened(row, **how):
        texts = texts_of(row)
        parts, owner, start = parts_of(texts)
        return texts, owner, start, Segments(parts, **how)

    # 1. which q-gram buckets hold more than one suffix
    def ask_grams(batches):
        for row in _rows(batches):
            keys, counts = unpack_keys(row["grams"]) << GRAM_SHIFT, unpack_counts(row["counts"])
            if len(counts):
                yield _asking(row["chunk"], keys, pack_counts(counts))

    several = ask(chunks.select("chunk", "grams", "counts").mapInArrow(ask_grams, ASKED), SEVERAL)

    # 2. segments of those buckets, and the earliest of each class of equal segments
    def candidates(batches):
        from xxhash import xxh3_128_digest

        for row in _rows(batches):
            _, owner, _, segments = opened(row)
            short = segments.gram >> GRAM_SHIFT
            keys, bits = np.unique(short), answers_of(row["got"], 0, SEVERAL)
            keep = np.flatnonzero(bits[np.searchsorted(keys, short)]) if len(keys) else np.zeros(0, dtype=np.int64)
            first, many = segments.first[keep], segments.many[keep]
            view = memoryview(segments.data)
            digests = np.frombuffer(b"".join([xxh3_128_digest(view[a : a + n + SPAN - 1]) for a, n in zip(first.tolist(), many.tolist())]), dtype=np.uint64).reshape(-1, 2)
            part = np.searchsorted(segments.part_start, first, side="right") - 1
            doc = _ids_at(row, owner, part)
            table = np.concatenate([segments.gram[keep].view(np.int64), digests[:, 0].view(np.int64), digests[:, 1].view(np.int64), doc, first, many])
            yield _batch({"chunk": [row["chunk"]], "table": [zlib.compress(table.tobytes(), 1)]}, [pa.int64(), pa.binary()])

    found = chunks.select("chunk", "doc_ids", "sizes", "text").join(gathered(several, "chunk", "got").hint("shuffle_hash"), "chunk", "left")
    state = _beside(found.mapInArrow(candidates, "chunk long, table binary"), "segments", buckets)

    def columns(row):
        gram, hi, lo, doc, first, many = np.frombuffer(zlib.decompress(row["table"]), np.int64).reshape(6, -1)
        lo = lo & 0xFFFFFFFF  # digests of 96 bits
        return gram.view(np.uint64), hi.view(np.uint64), lo, doc, first, many

    def ask_segments(batches):
        for row in _rows(batches):
            _, hi, lo, doc, first, _ = columns(row)
            order, leads = earliest(hi, lo, doc, first)
            own = order[leads]
            if len(own):
                yield _asking(row["chunk"], hi[own], _pack_places(lo[own], doc[own]))

    leading = ask(state.mapInArrow(ask_segments, ASKED), FIRST)

    def leaders(row):
        """Which of a chunk's segments are the earliest of their class in the whole corpus."""
        gram, hi, lo, doc, first, many = columns(row)
        order, leads = earliest(hi, lo, doc, first)
        lead = np.zeros(len(hi), dtype=bool)
        lead[order[leads][answers_of(row["lead"], 0, FIRST)]] = True
        return gram, doc, first, many, lead

    # 3. buckets with several classes
    def ask_classes(batches):
        for row in _rows(batches):
            gram, _, _, _, lead = leaders(row)
            keys, counts = np.unique(gram[lead], return_counts=True)
            if len(keys):
                yield _asking(row["chunk"], keys, pack_counts(counts))

    led = state.join(gathered(leading, "chunk", "lead").hint("shuffle_hash"), "chunk", "left")
    mixed = ask(led.mapInArrow(ask_classes, ASKED), SEVERAL)

    # 4. refine the suffixes of those to twice the q-gram, and see which buckets still hold several
    def suffixes(batches):
        for row in _rows(batches):
            gram, doc, first, many, lead = leaders(row)
            spans = np.stack([first[~lead], first[~lead] + many[~lead]])
            keys, bits = np.unique(gram[lead]), answers_of(row["mix"], 0, SEVERAL)
            again = np.flatnonzero(lead)[bits[np.searchsorted(keys, gram[lead])]] if len(keys) else np.zeros(0, dtype=np.int64)
            n = many[again]
            places = np.repeat(first[again] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            hashes = opened(row, hashes_only=True)[3].hashes if len(places) else np.zeros(0, dtype=np.uint64)
            bucket = refine(hashes[places], hashes[places + GRAM])
            last = hashes[places + SPAN - GRAM]
            table = np.concatenate([places, np.repeat(doc[again], n), bucket.view(np.int64), last.view(np.int64)])
            yield _batch({"chunk": [row["chunk"]], "spans": [zlib.compress(spans.astype(np.int64).tobytes(), 1)], "table": [zlib.compress(table.tobytes(), 1)]}, [pa.int64(), pa.binary(), pa.binary()])

    known = led.join(gathered(mixed, "chunk", "mix").hint("shuffle_hash"), "chunk", "left").join(chunks.select("chunk", "doc_ids", "sizes", "text"), "chunk")
    halves = _beside(known.mapInArrow(suffixes, "chunk long, spans binary, table binary"), "suffixes", buckets)

    def suffix_columns(row):
        places, docs_of, bucket, last = np.frombuffer(zlib.decompress(row["table"]), np.int64).reshape(4, -1)
        return places, docs_of, bucket.view(np.uint64), last.view(np.uint64)

    def ask_halves(batches):
        for row in _rows(batches):
            keys, counts = np.unique(suffix_columns(row)[2], return_counts=True)
            if len(keys):
                yield _asking(row["chunk"], keys, pack_counts(counts))

    deeper = ask(halves.mapInArrow(ask_halves, ASKED), SEVERAL)

    # 5. refine those to the whole string, and settle what the chunk knows by itself
    def finals(batches):
        for row in _rows(batches):
            places, docs_of, bucket, last = suffix_columns(row)
            keys, number = np.unique(bucket, return_inverse=True)
            going = answers_of(row["deep"], 0, SEVERAL)[number] if len(keys) else np.zeros(0, dtype=bool)
            places, docs_of, bucket, last = places[going], docs_of[going], bucket[going], last[going]
            hi, lo = refine(bucket, last), _rest(bucket, last)
            order, leads = earliest(hi, lo, docs_of, places)
            lost, own = places[order[~leads]], order[leads]
            spans = np.concatenate([np.frombuffer(zlib.decompress(row["spans"]), np.int64).reshape(2, -1), np.stack([lost, lost + 1])], axis=1)
            place = places[own]
            rows = {"chunk": [row["chunk"]], "spans": [zlib.compress(spans.astype(np.int64).tobytes(), 1)], "keys": [pack_keys(hi[own])], "rest": [_pack_places(lo[own], docs_of[own])], "place": [place.astype("<u4" if not len(place) or int(place.max()) < 1 << 32 else "<u8").tobytes()]}
            yield _batch(rows, [pa.int64(), *[pa.binary()] * 4])

    half_known = halves.join(gathered(deeper, "chunk", "deep").hint("shuffle_hash"), "chunk", "left")
    refined = _beside(half_known.mapInArrow(finals, "chunk long, spans binary, keys binary, rest binary, place binary"), "finals", buckets)

    def ask_suffixes(batches):
        for row in _rows(batches):
            if len(row["keys"]) > 1:
                yield table_of(ASKED, {"member": [row["chunk"]], "kind": [0], "keys": [row["keys"]], "rest": [row["rest"]]})

    winners = ask(refined.select("chunk", "keys", "rest").mapInArrow(ask_suffixes, ASKED), FIRST)

    # 6. mark and cut
    def finish(batches):
        for row in _rows(batches):
            texts = texts_of(row)
            parts, owner, start = parts_of(texts)
            part_start = np.cumsum([0, *map(len, parts)])[:-1]
            spans = np.frombuffer(zlib.decompress(row["spans"]), np.int64).reshape(2, -1)
            n_keys = len(unpack_keys(row["keys"]))
            place = np.frombuffer(row["place"], f"<u{len(row['place']) // n_keys if n_keys else 4}").astype(np.int64)
            lost = place[~answers_of(row["won"], 0, FIRST)] if len(place) else place
            begins, ends = np.r_[spans[0], lost], np.r_[spans[1], lost + 1] + SPAN - 1
            part = np.searchsorted(part_start, begins, side="right") - 1
            shift = start[part] - part_start[part]
            sizes = np.array(row["sizes"], dtype=np.int64)
            base = np.cumsum(sizes) - sizes
            begins, ends = begins + shift + base[owner[part]], ends + shift + base[owner[part]]
            depth = np.zeros(int(sizes.sum()) + 1, dtype=np.int64)
            np.add.at(depth, begins, 1)
            np.subtract.at(depth, ends, 1)
            gone = np.cumsum(depth)[:-1] > 0
            whole = np.frombuffer(b"".join(texts), dtype=np.uint8)
            out = {"doc_id": row["doc_ids"], "n_bytes": sizes.tolist(), "spans": [], "kept": []}
            for a, n in zip(base.tolist(), sizes.tolist()):
                mine = gone[a : a + n]
                edges = np.flatnonzero(np.diff(np.r_[False, mine, False])).reshape(-1, 2)
                out["spans"].append(edges.tolist())
                out["kept"].append(whole[a : a + n][~mine].tobytes())
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.binary()]
            if digest:
                spans_of = out.pop("spans")
                out["n_removed"] = [sum(b - a for a, b in s) for s in spans_of]
                out["n_spans"] = [len(s) for s in spans_of]
                out["kept_sha256"] = [hashlib.sha256(k).hexdigest() for k in out.pop("kept")]
                kinds = [pa.int64()] * 4 + [pa.string()]
            yield _batch(out, kinds)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" if digest else "doc_id long, n_bytes long, spans array<array<long>>, kept binary"
    marked = chunks.select("chunk", "doc_ids", "sizes", "text").join(refined.drop("rest"), "chunk").join(gathered(winners, "chunk", "won").hint("shuffle_hash"), "chunk", "left")
    return marked.mapInArrow(finish, schema)
