"""Quality classifier: a byte-level convolutional network in numpy.

How it works
    A text's bytes are cut into chunks of ``CHUNK`` bytes that overlap by half and cover the whole document. Learned
    filters run over every position of every chunk: each of the ``WIDTH`` byte positions under a filter adds the learned
    weight of the byte class it sees, and the result is rectified. Filters are max-pooled within the chunk, a learned
    layer turns the pooled values into the chunk's score, and the chunks' scores are averaged and squashed into one
    probability. Scoring works out the filters once a position, by tables of neighbouring byte classes, and takes the
    maxima of overlapping chunks from those of the half chunks they share. A text's score depends on nothing but the text
    and the weights: sums run in double precision, within the text, in a fixed order.

    Training is by gradient descent (Adam) on a bounded sample: at most ``SAMPLE_ROWS`` labelled documents, those with
    the lowest hash of their id (half of each label where there are as many), of any length; of each at most
    ``SAMPLE_CHUNKS`` chunks drawn over its whole length, which executors cut, so that some 9 MB reach the driver. Scoring
    has no bounds: it covers every byte of every document. The fitted weights are a few kilobytes.

Defined results
    null text and texts without a word: score 0, as there is nothing to keep. null label: not learned from. Repeated labels
    of an id: learned from as often. No labels at all: every other score is 0.5. null or repeated doc_id: rows like any
    others. Very long texts: scored in slices, result unchanged. Extra columns: ignored here, kept by :func:`keep_good`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, quoted, ship, text_slices

CHUNK, STRIDE, WIDTH = 256, 128, 6
FILTERS, SAMPLE_ROWS, SAMPLE_CHUNKS, EPOCHS, RATE = 24, 3_000, 12, 12, 0.01
#: Bytes of text that are scored in one go (or one text).
SLICE_BYTES = 250_000
#: Byte classes: 128 of ASCII, 16 of continuation bytes and 16 of lead bytes, so that few labels are enough.
CLASSES = 160
PAD = 0
#: Half chunks that go through the filters together when scoring.
BLOCKS = 64


def byte_classes(data: bytes) -> np.ndarray:
    """Bytes as class numbers: ASCII is itself, continuation and lead bytes of longer characters have 16 classes each."""
    found = np.frombuffer(data, dtype=np.uint8)
    return np.where(found < 128, found, np.where(found < 192, 128, 144) + (found & 15)).astype(np.uint8)


def padded(text: str | None) -> np.ndarray:
    """The byte classes of a whole text, padded to whole chunks."""
    found = byte_classes((text or "").encode("utf-8", "surrogatepass"))
    n = max(1, -(-max(0, len(found) - (CHUNK - STRIDE)) // STRIDE))
    out = np.full((n - 1) * STRIDE + CHUNK, PAD, dtype=np.uint8)
    out[: len(found)] = found
    return out


def chunks(text: str | None) -> np.ndarray:
    """The overlapping chunks of a whole text, padded at its end: (n, CHUNK)."""
    return np.lib.stride_tricks.sliding_window_view(padded(text), CHUNK)[::STRIDE]


def sampled(text: str | None, seed: int) -> np.ndarray:
    """At most ``SAMPLE_CHUNKS`` chunks of a text, drawn over its whole length."""
    rows = chunks(text)
    if len(rows) <= SAMPLE_CHUNKS:
        return rows
    return rows[np.sort(np.random.default_rng(seed).choice(len(rows), SAMPLE_CHUNKS, replace=False))]


class Network:
    """``table`` (WIDTH, CLASSES, FILTERS), ``bias`` (FILTERS), ``out`` (FILTERS), ``base`` scalar."""

    def __init__(self, table, bias, out, base):
        self.table, self.bias, self.out, self.base, self.pairs = table, bias, out, base, None

    @classmethod
    def start(cls, seed: int = 7) -> Network:
        draw = np.random.default_rng(seed)
        return cls(draw.normal(0, 0.3, (WIDTH, CLASSES, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32), draw.normal(0, 0.3, FILTERS).astype(np.float32), np.float32(0))

    def filtered(self, rows: np.ndarray) -> np.ndarray:
        """Filter values at every position of every chunk: (chunks, positions, FILTERS)."""
        positions = CHUNK - WIDTH + 1
        value = self.table[0][rows[:, :positions]]
        for k in range(1, WIDTH):
            value += self.table[k][rows[:, k : k + positions]]
        return value

    def pooled(self, rows: np.ndarray) -> np.ndarray:
        return np.maximum(self.filtered(rows).max(axis=1) + self.bias, 0)

    def weigh(self, pooled: np.ndarray) -> np.ndarray:
        """The scores of chunks; each one's sum runs on its own."""
        return (pooled.astype(np.float64) * self.out).sum(axis=1) + float(self.base)

    def chunk_scores(self, rows: np.ndarray) -> np.ndarray:
        return np.concatenate([self.weigh(self.pooled(rows[i : i + 256])) for i in range(0, len(rows), 256)])

    def pooled_texts(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each half chunk of padded texts: the filters' maxima over its positions, and over those that a chunk which
        ends with it has."""
        if self.pairs is None:
            first, second = np.divmod(np.arange(CLASSES * CLASSES), CLASSES)
            self.pairs = [self.table[k][first] + self.table[k + 1][second] for k in range(0, WIDTH, 2)]
        blocks = len(flat) // STRIDE
        codes = np.append(flat, np.zeros(WIDTH, dtype=np.uint8)).astype(np.intp)
        codes = codes[:-1] * CLASSES + codes[1:]
        whole, last = np.empty((blocks, FILTERS), np.float32), np.empty((blocks, FILTERS), np.float32)
        for at in range(0, blocks, BLOCKS):
            to = min(blocks, at + BLOCKS)
            value = self.pairs[0].take(codes[at * STRIDE : to * STRIDE], axis=0)
            for k in (2, 4):
                value += self.pairs[k // 2].take(codes[at * STRIDE + k : to * STRIDE + k], axis=0)
            value = value.reshape(to - at, STRIDE, FILTERS)
            last[at:to] = value[:, : STRIDE - WIDTH + 1].max(axis=1)
            whole[at:to] = np.maximum(last[at:to], value[:, STRIDE - WIDTH + 1 :].max(axis=1))
        return whole, last

    def score(self, texts: list) -> np.ndarray:
        """The probability of each text; half chunks of many texts go through the filters together."""
        cut = [padded(t) for t in texts]
        if not cut:
            return np.zeros(0)
        whole, last = self.pooled_texts(np.concatenate(cut))
        blocks = np.array([len(c) // STRIDE for c in cut])
        ends = np.cumsum(blocks)
        inside = np.ones(len(whole), dtype=bool)
        inside[ends - 1] = False  # no chunk begins with a text's last half chunk
        begin = np.flatnonzero(inside)
        chunk = self.weigh(np.maximum(np.maximum(whole[begin], last[begin + 1]) + self.bias, 0))
        starts = ends - blocks - np.arange(len(cut))
        mean = np.add.reduceat(chunk, starts) / (blocks - 1)
        score = 1 / (1 + np.exp(-np.clip(mean, -30, 30)))
        return np.where([bool(t and t.strip(" \t\n\v\f\r")) for t in texts], score, 0.0)


def loss(net: Network, rows: np.ndarray, owner: np.ndarray, sizes: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, dict]:
    """The weighted log loss of documents (chunk i is of document ``owner[i]``) and its gradient by each parameter."""
    value = net.filtered(rows)
    top = value.argmax(axis=1)
    best = np.take_along_axis(value, top[:, None, :], axis=1)[:, 0, :] + net.bias
    pool = np.maximum(best, 0)
    logit = np.clip(np.bincount(owner, pool @ net.out, len(sizes)) / sizes + net.base, -30, 30)
    chance = 1 / (1 + np.exp(-logit))
    total = -(weight * np.where(y == 1, np.log(chance), np.log(1 - chance))).sum() / len(sizes)
    error = (chance - y) * weight / len(sizes)
    each = (error / sizes)[owner].astype(np.float32)
    back = each[:, None] * net.out * (best > 0)
    grown = np.zeros_like(net.table)
    for k in range(WIDTH):
        seen = np.take_along_axis(rows, top + k, axis=1)
        np.add.at(grown[k], (seen, np.arange(FILTERS)[None, :]), back)
    return float(total), {"table": grown, "bias": back.sum(axis=0), "out": pool.T @ each, "base": np.float32(error.sum())}


def fit(cut: list, labels: list[int], epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> Network:
    """Adam on the log loss of whole-document probabilities, documents (arrays of chunks) in batches of 32."""
    net, draw = Network.start(seed), np.random.default_rng(seed)
    if len(set(labels)) < 2:
        net.out[:] = 0
        net.base = np.float32(0 if not labels else 4 if labels[0] else -4)
        return net
    y = np.array(labels, dtype=np.float32)
    share = y.mean()
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    # balanced while learning, moved back to the observed share of label 1 in the end
    state = {k: [np.zeros_like(getattr(net, k)), np.zeros_like(getattr(net, k))] for k in ("table", "bias", "out", "base")}
    step = 0
    for epoch in range(epochs):
        order = draw.permutation(len(cut))
        pace = rate * (1 - epoch / epochs)
        for b in range(0, len(order), 32):
            docs = order[b : b + 32]
            rows = np.concatenate([cut[i] for i in docs])
            sizes = np.array([len(cut[i]) for i in docs])
            owner = np.repeat(np.arange(len(docs)), sizes)
            _, gradient = loss(net, rows, owner, sizes, y[docs], weight[docs])
            gradient["table"] += 1e-5 * net.table
            step += 1
            for name, g in gradient.items():
                m, v = state[name]
                m[...] = 0.9 * m + 0.1 * g
                v[...] = 0.999 * v + 0.001 * g * g
                setattr(net, name, (getattr(net, name) - pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32))
    net.base = np.float32(net.base + np.log(share / (1 - share)))
    return net


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> list:
    """At most ``rows`` labels, half of each where possible, by lowest hash of the id, and their documents as (chunks,
    quality); fixed by the data. Documents under a repeated id count as often, up to twice the rows, by hash."""
    marked = labels.filter(F.col("quality").isNotNull()).select(F.col("doc_id").alias("label_id"), F.col("quality").cast("int").alias("quality"))
    marked = marked.filter(F.crc32(F.col("label_id").cast("string").cast("binary")) % 3 != 1)
    low = F.xxhash64("label_id", F.lit(11))
    chosen = marked.filter("quality = 1").orderBy(low, "label_id").limit(rows // 2).unionByName(marked.filter("quality = 0").orderBy(low, "label_id").limit(rows - rows // 2))

    def cut(batches):
        fresh()
        for batch in batches:
            seeds = batch.column(0).to_pylist()
            found = [sampled(t, seeds[at + i] & 0xFFFFFFFF).tobytes() for at, part in text_slices(batch, 2, SLICE_BYTES) for i, t in enumerate(part)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["low", "quality", "chunks"])

    texts = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("label_id"))
    texts = texts.select(F.xxhash64("label_id", F.lit(11), "text").alias("low"), "quality", "text")
    found = texts.mapInArrow(cut, "low long, quality int, chunks binary").orderBy("low", "quality", "chunks").limit(2 * rows).collect()
    return [(np.frombuffer(r["chunks"], np.uint8).reshape(-1, CHUNK), r["quality"]) for r in found]


def learned(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Network:
    """The network that the labels of a sample of ``docs`` give."""
    ship(docs.sparkSession)
    sample = training_rows(docs, labels, id_col=id_col, text_col=text_col)
    return fit([c for c, _ in sample], [q for _, q in sample])


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    return score_documents(docs, learned(docs, labels, id_col, text_col), id_col, text_col)


def _batch_scores(batch, column: int, net: Network) -> np.ndarray:
    return np.concatenate([np.zeros(0), *(net.score(part) for _, part in text_slices(batch, column, SLICE_BYTES))])


def score_documents(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def run(batches):
        fresh()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_batch_scores(batch, 1, net), pa.float64())], names=["doc_id", "score"])

    scored = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    return scored.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that the classifier rejects (score under 0.5), all columns kept."""
    net = learned(docs, labels, id_col, text_col)
    at = docs.columns.index(text_col)

    def run(batches):
        fresh()
        for batch in batches:
            yield batch.filter(pa.array(_batch_scores(batch, at, net) >= 0.5))

    # under plain names, as mapInArrow takes no others
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
