"""Language-model scores from a weighted backoff automaton over corpus-wide n-gram counts.

The model
    A trigram model with a Dirichlet prior at every state. States are the histories seen in training: a root, one for each
    word (and the start of a text), one for each pair of neighbours. A state of count C has an arc for each token x seen
    c times behind it, of weight ``log10((c + m p(x)) / (C + m))``, where p is the probability one state down (``MU``
    is m at words, ``MU_PAIR`` at pairs), and a failure arc of weight ``log10(m / (C + m))`` to its history without
    the first token. The root has an arc for every token, of weight log10 of ``(count + 1) / (N + V + 1)``. A text is one
    left-to-right traversal that carries the state: a token follows its arc, or else failure arcs until there is one, and
    the arc leads to the state of the longest history seen. All weights leaving a state sum to one.

How it is distributed
    1. Texts become chunks of at most about ``CHUNK_CHARS`` characters (or one text): streams of chunk-local word
       numbers and the sorted 64-bit hashes of the chunk's words, stored once, bucketed by chunk.
    2. Each chunk asks for the counts of its distinct words and pairs, adding what its training texts hold, through the
       tree of :mod:`exchange`: a word that makes up a third of all tokens is one key a chunk.
    3. It asks for its distinct triples in the same way, but only where both their pairs are in other chunks too: all
       others are its own, and it has counted them.
    4. A chunk builds the part of the automaton that its texts can reach and runs them through it. No table of all n-grams
       is ever in one place.

Defined results
    null text: as the empty text, the end token alone. null doc_id: trained on, not held out. Repeated rows: counted and
    returned as often. Nothing to train on: N is 0, every word unknown. Empty table: no rows. Extra columns: ignored.
    Two words with the same 64-bit hash would share a count, as would two pairs or triples with the same 56 bits.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parallelism, quoted, ship, text_slices, write_bucketed
from .exchange import ASKED, FAN, answers_of, gathered, pack_counts, pack_keys, resolve, table_of, unpack_counts, unpack_keys  # noqa: F401

MU, MU_PAIR = 1000.0, 20.0
HELD_MODULUS, HELD_REMAINDER = 7, 2
CHUNK_CHARS = 4_000_000
#: Tokens for each owner of keys.
OWNER_TOKENS = 3_000_000
#: Tokens of a text that are walked in one lane; later ones start in the state that the two tokens before lead to.
LANE = 512
_END, _START = b" end", b" start"
#: Pairs and triples are keyed by the top 56 bits of their hashes.
_TOP = np.uint64(0xFFFFFFFFFFFFFF00)


def _hash(words) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.array([xxh64_intdigest(w) for w in words], dtype=np.uint64)


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of ordered pairs of hashes."""
    key = left * np.uint64(0x9E3779B97F4A7C15) + (right ^ (left >> np.uint64(29)))
    key ^= key >> np.uint64(31)
    key *= np.uint64(0xBF58476D1CE4E5B9)
    return (key ^ (key >> np.uint64(32))) & _TOP


def read_chunk(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sizes in tokens, stream of word numbers, sorted word hashes) of texts."""
    numbers: dict[bytes, int] = {}
    stream, sizes = [], []
    for t in texts:
        words = (t or "").encode("utf-8", "surrogatepass").lower().split()
        words.append(_END)
        stream += [numbers.setdefault(w, len(numbers)) for w in words]
        sizes.append(len(words))
    hashes = _hash(numbers)
    sorted_hashes, place = np.unique(hashes, return_inverse=True)
    return np.array(sizes, dtype=np.int64), place[np.array(stream, dtype=np.int64)].astype(np.uint32), sorted_hashes


def _is_held(ids: list) -> np.ndarray:
    return np.array([i is not None and zlib.crc32(str(i).encode()) % HELD_MODULUS == HELD_REMAINDER for i in ids], dtype=bool)


class Chunk:
    """A chunk's tokens and its distinct pairs: ``pair[i]`` is the number of the pair (token before, token i)."""

    def __init__(self, row: dict):
        self.sizes = np.array(row["sizes"], dtype=np.int64)
        self.stream = np.frombuffer(zlib.decompress(row["stream"]), "<u4").astype(np.int64)
        self.words = unpack_keys(row["words"])
        self.first = np.cumsum(self.sizes) - self.sizes
        self.trained = np.repeat(~_is_held(row["doc_ids"]), self.sizes)
        right = self.words[self.stream]
        left = np.empty_like(right)
        left[1:] = right[:-1]
        left[self.first] = _hash([_START])[0]
        self.pairs, self.pair = np.unique(pair_keys(left, right), return_inverse=True)

    def triples(self) -> tuple[np.ndarray, np.ndarray]:
        """(sorted keys, number of each token's triple); the first token of a text has none and the number -1."""
        later = np.ones(len(self.stream), dtype=bool)
        later[self.first] = False
        at = np.flatnonzero(later)
        keys, place = np.unique(pair_keys(self.pairs[self.pair[at - 1]], self.words[self.stream[at]]), return_inverse=True)
        number = np.full(len(self.stream), -1, dtype=np.int64)
        number[at] = place
        return keys, number

    def open_triples(self, number: np.ndarray, many: int, pair_values: np.ndarray) -> np.ndarray:
        """Which triples other chunks may hold too: both their pairs are shared."""
        at = np.flatnonzero(number >= 0)
        shared = (pair_values & 1).astype(bool)
        out = np.zeros(many, dtype=bool)
        out[number[at]] = shared[self.pair[at - 1]] & shared[self.pair[at]]
        return out


CHUNKS = "chunk long, doc_ids array<long>, sizes array<int>, stream binary, words binary"


def chunked(docs: DataFrame, id_col: str, text_col: str, chars: int) -> DataFrame:
    def cut(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held_ids, held_texts, size = [], [], 0

        def close():
            nonlocal number, held_ids, held_texts, size
            sizes, stream, hashes = read_chunk(held_texts)
            row = {"chunk": [number], "doc_ids": [held_ids], "sizes": [sizes.tolist()], "stream": [zlib.compress(stream.astype("<u4").tobytes(), 1)], "words": [pack_keys(hashes)]}
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary())
            number, held_ids, held_texts, size = number + 1, [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row.values(), kinds)], names=list(row))

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at, texts in text_slices(batch, 1, chars):
                for i, t in enumerate(texts):
                    if held_ids and size + len(t or "") > chars:
                        yield close()
                    held_ids.append(ids[at + i])
                    held_texts.append(t)
                    size += len(t or "")
        if held_ids:
            yield close()

    return docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).alias("text")).mapInArrow(cut, CHUNKS)


def _rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def ask(chunks: DataFrame) -> DataFrame:
    """Each chunk's distinct words (kind 0) and pairs (kind 1) with twice their counts in its training texts."""

    def requests(batches):
        for row in _rows(batches):
            c = Chunk(row)
            for kind, keys, at in ((0, c.words, c.stream), (1, c.pairs, c.pair)):
                counts = 2 * np.bincount(at[c.trained], minlength=len(keys))
                yield table_of(ASKED, {"member": [row["chunk"]], "kind": [kind], "keys": [pack_keys(keys)], "rest": [pack_counts(counts)]})

    return chunks.mapInArrow(requests, ASKED)


def ask_triples(known: DataFrame) -> DataFrame:
    """Each chunk's triples that other chunks may hold."""

    def requests(batches):
        for row in _rows(batches):
            c = Chunk(row)
            keys, number = c.triples()
            wanted = c.open_triples(number, len(keys), answers_of(row["got"], 1))
            if wanted.any():
                counts = 2 * np.bincount(number[c.trained & (number >= 0)], minlength=len(keys))
                yield table_of(ASKED, {"member": [row["chunk"]], "kind": [2], "keys": [pack_keys(keys[wanted])], "rest": [pack_counts(counts[wanted])]})

    return known.mapInArrow(requests, ASKED)


class Automaton:
    """The states and arcs that a chunk's texts can reach.

    States: 0 the root, 1 the start, then a state a word, then a state a pair. ``fail_to`` and ``fail_cost`` are their
    failure arcs. Arcs are by n-gram: ``arc[k]`` costs of n-grams of k + 1 tokens (NaN: no such arc) and ``to`` the state
    after an n-gram's last pair. ``seen`` tells the states that exist.
    """

    def __init__(self, chunk: Chunk, number: np.ndarray, words, pairs, triples, n: int, v: int, starts: int, mu: float, mu_pair: float):
        stream, pair, first = chunk.stream, chunk.pair, chunk.first
        n_words, n_pairs = len(words), len(pairs)
        self.pair_state = 2 + n_words
        before = np.empty(len(stream), dtype=np.int64)  # the state of the token before
        before[1:] = 2 + stream[:-1]
        before[first] = 1
        # of each pair the state it starts from and the token it ends with
        left, right = np.zeros(n_pairs, dtype=np.int64), np.zeros(n_pairs, dtype=np.int64)
        left[pair], right[pair] = before, stream
        count = np.concatenate([[0, starts], words, pairs])
        prior = np.concatenate([np.full(2 + n_words, mu), np.full(n_pairs, mu_pair)])
        self.fail_to = np.concatenate([np.zeros(2 + n_words, dtype=np.int64), 2 + right])
        with np.errstate(divide="ignore"):
            self.fail_cost = np.log10(prior / (count + prior))
            unigram = (words + 1) / (n + v + 1)
            bigram = (pairs + mu * unigram[right]) / (count[left] + mu)
            self.arc = [np.log10(unigram), np.where(pairs > 0, np.log10(bigram), np.nan)]
            last, history = np.zeros(len(triples), dtype=np.int64), np.zeros(len(triples), dtype=np.int64)
            at = np.flatnonzero(number >= 0)
            last[number[at]], history[number[at]] = pair[at], pair[at - 1]
            trigram = (triples + mu_pair * bigram[last]) / (pairs[history] + mu_pair)
            # one more at the end stands for the texts' first tokens, which have no triple
            self.arc.append(np.append(np.where(triples > 0, np.log10(trigram), np.nan), np.nan))
        # the longest history seen: the pair, else its last token, else nothing
        self.to = np.where(pairs > 0, self.pair_state + np.arange(n_pairs), np.where(words[right] > 0, 2 + right, 0))

    def walk(self, stream: np.ndarray, pair: np.ndarray, triple: np.ndarray, begin: np.ndarray, length: np.ndarray, state: np.ndarray) -> np.ndarray:
        """The log probability of each lane: token after token of all lanes, longest lanes first, the state carried."""
        order = np.argsort(-length, kind="stable")
        begin, length, state = begin[order], length[order], state[order].copy()
        total, live = np.zeros(len(begin)), len(begin)
        for t in range(int(length[0]) if live else 0):
            live = int(np.searchsorted(-length, -t, side="left"))
            at, now = begin[:live] + t, state[:live]
            cost = np.zeros(live)
            arc = np.where(now >= self.pair_state, self.arc[2][triple[at]], np.nan)
            failed = np.isnan(arc) & (now >= self.pair_state)
            cost[failed] += self.fail_cost[now[failed]]
            now = np.where(failed, self.fail_to[now], now)
            arc = np.where(np.isnan(arc) & (now > 0), self.arc[1][pair[at]], arc)
            failed = np.isnan(arc) & (now > 0)
            cost[failed] += self.fail_cost[now[failed]]
            arc = np.where(np.isnan(arc), self.arc[0][stream[at]], arc)
            total[:live] += cost + arc
            state[:live] = self.to[pair[at]]
        out = np.empty_like(total)
        out[order] = total
        return out

    def scores(self, chunk: Chunk, number: np.ndarray) -> np.ndarray:
        """The log probability of each text. A text is walked in lanes; one that begins inside a text is entered in the
        state that the traversal has there, which the pair before it tells."""
        lanes = -(-chunk.sizes // LANE)
        text = np.repeat(np.arange(len(lanes)), lanes)
        within = (np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)) * LANE
        begin = chunk.first[text] + within
        length = np.minimum(LANE, chunk.sizes[text] - within)
        state = np.where(within > 0, self.to[chunk.pair[begin - 1]], 1)
        return np.bincount(text, weights=self.walk(chunk.stream, chunk.pair, number, begin, length, state), minlength=len(lanes))


def score(docs: DataFrame, mu: float = MU, id_col: str = "doc_id", text_col: str = "text", chunk_chars: int = CHUNK_CHARS, owner_tokens: int = OWNER_TOKENS, mu_pair: float = MU_PAIR, fan: int = FAN) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    spark = docs.sparkSession
    ship(spark)
    chunks = write_bucketed(chunked(docs, id_col, text_col, chunk_chars), "chunks")
    held = F.crc32(F.col("d").cast("string").cast("binary")) % HELD_MODULUS == HELD_REMAINDER
    each = chunks.select("chunk", F.explode(F.arrays_zip(F.col("doc_ids").alias("d"), F.col("sizes").alias("s"))).alias("x")).select("x.d", "x.s").withColumn("trained", ~F.coalesce(held, F.lit(False)))
    tokens, n, starts = each.agg(F.coalesce(F.sum("s"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("trained"), F.col("s"))), F.lit(0)), F.count_if("trained")).first()
    members, owners = chunks.count(), max(parallelism(spark), -(-tokens // owner_tokens))
    answers = resolve(ask(chunks), members, owners, fan=fan)
    v = answers.filter("kind = 0").agg(F.coalesce(F.sum("distinct"), F.lit(0))).first()[0]
    known = chunks.join(gathered(answers, "chunk", "got").hint("shuffle_hash"), "chunk")
    more = resolve(ask_triples(known), members, owners, fan=fan)

    def run(batches):
        for row in _rows(batches):
            c = Chunk(row)
            keys, number = c.triples()
            words, pairs = answers_of(row["got"], 0), answers_of(row["got"], 1)
            triples = np.bincount(number[c.trained & (number >= 0)], minlength=len(keys))
            wanted = c.open_triples(number, len(keys), pairs)
            triples[wanted] = answers_of(row["more"], 2) >> 1
            model = Automaton(c, number, words >> 1, pairs >> 1, triples, n, v, starts, mu, mu_pair)
            known_tokens = np.add.reduceat(((words >> 1)[c.stream] > 0).astype(np.int64), c.first)
            base = np.add.reduceat(model.arc[0][c.stream], c.first)
            columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(_is_held(row["doc_ids"])), pa.array(c.sizes, pa.int64()), pa.array(known_tokens, pa.int64()), pa.array(base, pa.float64()), pa.array(model.scores(c, number), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    scored = known.join(gathered(more, "chunk", "more").hint("shuffle_hash"), "chunk", "left")
    scored = scored.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
