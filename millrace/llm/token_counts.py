"""Token counts by rank-synchronous array merging.

How it works
    A text is cut into words; each word's count is worked out once per cache and a text's count is the sum over its
    words. The words of a batch that are new are normalised and cut into pre-tokens, whose symbols lie in one ragged
    numpy array. In each round every pre-token finds the lowest-ranked pair it holds (one lookup for all pairs, one
    segmented minimum), merges all occurrences of that pair at once, and pre-tokens without a pair left drop out with
    the number of their symbols. Where a merge can make a pair that ranks before the merge itself, only its first
    occurrence is merged in a round, so the order is the library's in every case.

Defined results
    null text: 0 tokens and 0 bytes. Special strings in a text are one token each, as the library has them by default.
    Very long texts and words: no truncation. null or repeated doc_id: rows like any others. Empty table: no rows.
    Extra columns: ignored.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import quoted, ship, text_slices
from .tokens import SLICE_BYTES, WordCache, folded_early, library, shown_bytes, tokenizer_path, word_end_pieces

#: Words of ASCII and Latin-1 letters, which normal form C leaves alone and whose lower case is one character each.
_PLAIN_WORD = re.compile(r"[!-~\xc0-\xd6\xd8-\xf6\xf8-\xff]+").fullmatch
#: The pre-token pattern over those.
_PLAIN_CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[!-/:-@\[-`{-~]+| ").findall

LIMIT = 2048
#: Words whose counts one generation of the cache holds; there are two.
CACHE_WORDS = 200_000
NONE = np.int64(1) << 60


class MergeTable:
    """Pairs of symbols, their ranks and what they become."""

    def __init__(self, vocab: dict[str, int], merges: list):
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.width = max(vocab.values()) + 1
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        keys = left * self.width + right
        # of a pair that is listed twice the last rank counts
        last = len(keys) - 1 - np.unique(keys[::-1], return_index=True)[1]
        self.keys, self.ranks = keys[last], last
        self.made = made
        first_use = np.full(self.width, NONE)
        np.minimum.at(first_use, left, np.arange(len(pairs)))
        np.minimum.at(first_use, right, np.arange(len(pairs)))
        self.one_at_a_time = first_use[made] < np.arange(len(pairs))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def count(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The number of symbols that each sequence is left with; the sequences lie in a row."""
        counts = sizes.copy()
        live = np.flatnonzero(sizes > 1)
        symbols = symbols[np.repeat(sizes > 1, sizes)]
        owner = np.repeat(np.arange(len(live)), sizes[live])
        while len(live):
            rank = np.full(len(symbols), NONE)
            same = owner[1:] == owner[:-1]
            at = np.flatnonzero(same)
            rank[at] = self.rank(symbols[at], symbols[at + 1])
            starts = np.flatnonzero(np.r_[True, ~same])
            least = np.minimum.reduceat(rank, starts)
            going = least < NONE
            counts[live] = np.diff(np.r_[starts, len(symbols)])
            keep = going[owner]
            number = np.cumsum(going) - 1
            symbols, rank, owner = symbols[keep], rank[keep], number[owner[keep]]
            live, least = live[going], least[going]
            if not len(live):
                break
            hit = np.flatnonzero(rank == least[owner])
            single = self.one_at_a_time[rank[hit]]
            if single.any():
                first = np.r_[True, owner[hit[1:]] != owner[hit[:-1]]]
                hit = hit[first | ~single]
            # of hits in a row (a symbol with itself) every other one, from the left
            run = np.r_[True, np.diff(hit) != 1]
            begin = np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - begin) % 2 == 0]
            symbols[hit] = self.made[rank[hit]]
            stay = np.ones(len(symbols), dtype=bool)
            stay[hit + 1] = False
            symbols, owner = symbols[stay], owner[stay]
        return counts


class TokenCounter:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.tokenizer, self.vocab = library(path), model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.table = MergeTable(self.vocab, model["merges"])
        char_of = shown_bytes()
        self.byte_of = {c: b for b, c in char_of.items()}
        self.inner = np.array([self.vocab[char_of[b]] for b in range(256)], dtype=np.int64)
        self.final = np.array([self.vocab[char_of[b] + self.suffix] for b in range(256)], dtype=np.int64)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.cache = WordCache(self.compute, CACHE_WORDS)

    def pretokens(self, text: str) -> list[str]:
        return [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(text))]

    def compute(self, words: list[str]) -> list[int]:
        """Counts of new words: plain ones are lower-cased and cut together, others go through the library's normaliser."""
        counts, pieces, owner, plain = [0] * len(words), [], [], []
        for k, text in enumerate(words):
            if "<|" not in text and _PLAIN_WORD(text):
                plain.append(k)
                continue
            parts = [text]
            for mark in self.special:
                split = [p.split(mark) for p in parts]
                counts[k] += sum(len(p) - 1 for p in split)
                parts = [x for p in split for x in p]
            for piece in (p for part in parts if part for p in self.pretokens(part)):
                pieces.append(bytes(map(self.byte_of.__getitem__, piece)))
                owner.append(k)
        at = 0
        for piece in _PLAIN_CUT(" ".join([words[k] for k in plain]).lower()):
            if piece == " ":
                at += 1
            else:
                pieces.append(piece.encode())
                owner.append(plain[at])
        if pieces:
            distinct = dict.fromkeys(pieces)
            distinct = dict(zip(distinct, self.table.count(*self.symbols(list(distinct)))))
            total = np.bincount(owner, weights=[distinct[p] for p in pieces], minlength=len(words))
            counts = [a + int(b) for a, b in zip(counts, total)]
        return counts

    def symbols(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The first symbols of pre-tokens, one a byte, and how many each has; the last one carries the word end."""
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        flat = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        symbols = self.inner[flat]
        last = np.cumsum(sizes) - 1
        symbols[last] = self.final[flat[last]]
        return symbols, sizes

    def count(self, texts: list) -> list[int]:
        """The number of tokens of each text (None: 0)."""
        out, plain = np.zeros(len(texts), dtype=np.int64), []
        for i, t in enumerate(texts):
            if t and "<|" in t:
                words = word_end_pieces(t)
                out[i] = sum(map(self.cache.holding(set(words)).__getitem__, words))
            elif t:
                plain.append(i)
        if plain:
            lists = pc.ascii_split_whitespace(pa.array([texts[i] for i in plain], pa.large_string()))
            coded = lists.values.dictionary_encode()
            words = folded_early(coded.dictionary).to_pylist()
            known = self.cache.holding(set(words))
            each = np.fromiter((known[w] for w in words), dtype=np.int64, count=len(words))
            ends = np.r_[0, np.cumsum(each[coded.indices.to_numpy()])]
            out[plain] = np.diff(ends[lists.offsets.to_numpy()])
        return out.tolist()


@lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def token_counts(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document. Nothing is shuffled."""
    path = tokenizer or tokenizer_path("word_bpe_49k.json")
    ship(docs.sparkSession)

    def count(batches):
        for batch in batches:
            counts = [n for _, part in text_slices(batch, 2, SLICE_BYTES) for n in counter(path).count(part)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(quoted(id_col).cast("long").alias("doc_id"), F.coalesce(F.octet_length(quoted(text_col)), F.lit(0)).cast("long").alias("n_bytes"), quoted(text_col).alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
