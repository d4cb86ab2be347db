"""Exact library tokenization at the cost of its distinct words.

Both vocabularies cut a text into pre-tokens that never cross the boundaries used here, so a text's ids are the ids of
its words in a row, and only words that were not met lately go through the library. Caches hold a bounded number of
words and live as long as the Python worker.
"""

from __future__ import annotations

import gc
import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that one generation of a cache holds; there are two generations.
CACHE_WORDS = 400_000
#: The same of words with special strings or odd white space, which are Python objects.
ODD_WORDS = 50_000
#: Letters before an end, kept likewise: most words are letters alone, and those are in the cache of words.
CACHE_HEADS = 60_000
#: Ends of words (punctuation, mostly) that are kept for good.
CACHE_TAILS = 20_000
#: Id that ends each document.
END_ID = 2
#: Bytes of text that are encoded in one go.
SLICE_BYTES = 3_000_000


def shown_bytes() -> dict[int, str]:
    """The byte-level alphabet: printable characters stand for themselves, other bytes for characters from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_SHOWN = shown_bytes()


class WordCache:
    """A two-generation map from word to value; ``compute`` gets the list of words that are in neither."""

    def __init__(self, compute, limit: int):
        self.compute, self.limit, self.new, self.old = compute, limit, {}, {}

    def holding(self, words: set) -> dict:
        """A dict with a value for each of ``words``."""
        if len(self.new) > self.limit:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        absent = []
        for w in words.difference(new):
            value = old.get(w)
            if value is None:
                absent.append(w)
            else:
                new[w] = value
        for i in range(0, len(absent), 16_384):
            part = absent[i : i + 16_384]
            new.update(zip(part, self.compute(part)))
        return new


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: The same as patterns of Arrow: a letter, and plain punctuation after which both vocabularies cut.
_LETTER, _AFTER = "[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]", "[!-&(-/:-@\\[-`{-~]"
#: Letters, with the space before them: one pre-token of either vocabulary.
_LETTERS = re.compile(r" ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+").fullmatch
#: White space where the plain cut at single spaces and newlines does not hold.
_ODD_RUNS = ("  ", "\n\n", " \n", "\n ")
_ODD_CHARS = tuple(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")
_PLAIN = re.compile(r" ?[^ \n]+|\n")
_SAFE = re.compile(r"(?<=\S)(?= \S)")
#: Letters that plain punctuation follows: both vocabularies cut there, so the two parts can be looked up apart.
_HEAD = re.compile(r" ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+(?=[!-&(-/:-@\[-`{-~])").match
#: Words without combining marks and other characters that may compose with the one before them.
_NO_MARKS = re.compile("[\0-\u02ff]+").fullmatch


def is_odd(text: str) -> bool:
    return text[0] in " \n" or text[-1] in " \n" or any(r in text for r in _ODD_RUNS) or any(c in text for c in _ODD_CHARS)


def byte_level_pieces(text: str) -> list[str]:
    """Cut a text where no pre-token of a byte-level BPE (words with their leading space) can cross."""
    if not text:
        return []
    return _SAFE.split(text) if is_odd(text) else _PLAIN.findall(text)


def fold_early(word: str) -> str:
    """``word`` with A-Z in lower case where no mark may follow them (marks start at U+0300): the library composes before
    it folds, and some letters compose with a mark in lower case only. Other words are left as they are."""
    if word.isascii():
        return word.lower()
    return word.encode().lower().decode() if _NO_MARKS(word) else word


def folded_early(words: pa.Array) -> pa.Array:
    """:func:`fold_early` of an Arrow array of words."""
    return pc.if_else(pc.match_substring_regex(words, "[^\\x00-\\x{2ff}]"), words, pc.ascii_lower(words))


def word_end_pieces(text: str) -> list[str]:
    """Cut a text at ASCII white space, which a BPE with word ends drops. Case is folded early where that is safe."""
    words = [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").split()]
    return words if "<|" in text else list(map(fold_early, words))


class Ragged:
    """Lists of ids in a row, as one Arrow array."""

    def __init__(self, sizes: np.ndarray, flat: np.ndarray):
        self.lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(flat, pa.uint32()))

    @classmethod
    def of(cls, datas: list[bytes]) -> Ragged:
        return cls(np.fromiter(map(len, datas), dtype=np.int64, count=len(datas)) // 4, np.frombuffer(b"".join(datas), dtype="<u4"))

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.lists.offsets.to_numpy()).astype(np.int64)

    def taken(self, places: np.ndarray) -> np.ndarray:
        """The ids of the lists at some places, in that order."""
        return self.lists.take(pa.array(places)).flatten().to_numpy()


class IdCache:
    """A two-generation map from words to their ids in Arrow arrays, some 40 bytes a word."""

    def __init__(self, compute, limit: int):
        self.compute, self.limit = compute, limit
        self.new, self.old = ((pa.array([], pa.large_string()), Ragged(np.zeros(0, np.int64), np.zeros(0, np.uint32))) for _ in range(2))

    @staticmethod
    def _places(words: pa.Array, among: pa.Array) -> np.ndarray:
        """The place of each word among others, -1 where it is not there."""
        return pc.fill_null(pc.index_in(words, value_set=among), -1).to_numpy() if len(among) else np.full(len(words), -1, dtype=np.int32)

    def places(self, words: pa.Array) -> tuple[np.ndarray, Ragged]:
        """Where the ids of each word are among the lists that are returned with them."""
        if len(self.new[0]) > self.limit:
            self.old, self.new = self.new, (pa.array([], pa.large_string()), Ragged(np.zeros(0, np.int64), np.zeros(0, np.uint32)))
        at = self._places(words, self.new[0]).copy()
        missing = np.flatnonzero(at < 0)
        if len(missing):
            asked = words.take(pa.array(missing))
            absent = pc.unique(asked)
            before = self._places(absent, self.old[0])
            kept, unknown = np.flatnonzero(before >= 0), np.flatnonzero(before < 0)
            parts = [self.new[1].lists, self.old[1].lists.take(pa.array(before[kept]))]
            if len(unknown):
                parts.append(self.compute(absent.take(pa.array(unknown))).lists)
            added = absent.take(pa.array(np.r_[kept, unknown]))
            base, lists = len(self.new[0]), Ragged(np.zeros(0, np.int64), np.zeros(0, np.uint32))
            lists.lists = pa.concat_arrays(parts)
            self.new = (pa.concat_arrays([self.new[0], added]), lists)
            at[missing] = base + self._places(asked, added)
        return at, self.new[1]


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, words: int = CACHE_WORDS):
        self.tokenizer = library(path)
        # word ends: white space is dropped; otherwise a word carries its leading space
        self.suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None) or ""
        self.word_ends = bool(self.suffix)
        self.cut = word_end_pieces if self.word_ends else byte_level_pieces
        self.cache, self.odd = IdCache(self.new_words, words), WordCache(self.compute, ODD_WORDS)
        self.heads, self.old_heads, self.tails = {}, {}, {}
        # ids that end a pre-token, or that begin one with its space
        self.edge = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True) + 1, dtype=bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.edge[i] = token.endswith(self.suffix) if self.word_ends else token.startswith(_SHOWN[0x20])
        self.newline = self.whole(["\n"])[0]

    def whole(self, words: list[str]) -> list[bytes]:
        """Ids of words by the library, one by one."""
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def letters(self, parts: list[str]) -> list[bytes]:
        """Ids of parts of letters (with the space before them, where words carry it). Each is one pre-token, so the
        library gets them in one text; its ids are told apart where a pre-token ends or begins."""
        spaced = self.word_ends or all(p[0] == " " for p in parts)
        if len(parts) > 1 and spaced:
            ids = np.array(self.tokenizer.encode_batch_fast([(" " if self.word_ends else "").join(parts)], add_special_tokens=False)[0].ids, dtype="<u4")
            edges = np.flatnonzero(self.edge[ids])
            if len(edges) == len(parts):
                data, ends = ids.tobytes(), (4 * (edges + 1) if self.word_ends else 4 * np.append(edges[1:], len(ids))).tolist()
                return [data[x:y] for x, y in zip([0, *ends], ends)]
        return self.whole(parts)

    def compute(self, words: list[str]) -> list[bytes]:
        """Ids of new words by the library: letters together, what follows them once, anything else the whole way."""
        if len(self.heads) > CACHE_HEADS:
            self.old_heads, self.heads = self.heads, {}
        tails, heads, old = self.tails, self.heads, self.old_heads
        plain, rest = [], []  # words of letters; (place, bytes before, letters, what follows) of others
        spaced = self.word_ends
        for i, word in enumerate(words):
            if _LETTERS(word) and (spaced or word[0] == " "):
                plain.append(i)
                continue
            before = b""
            if word[:1] == "\n" and word[1:2].strip():
                before, word = self.newline, word[1:]
            found = None if "<|" in word else _HEAD(word)
            if found:
                head = found.group()
                rest.append((i, before, head, word[len(head) :]))
            else:
                rest.append((i, before, "", word))
        out: list = [b""] * len(words)
        for i, data in zip(plain, self.letters([words[i] for i in plain]) if plain else ()):
            out[i] = data
        needed = list({h for _, _, h, _ in rest if h and h not in heads})
        absent = [h for h in needed if h not in old]
        heads.update((h, old[h]) for h in needed if h in old)
        spaces = [h for h in absent if spaced or h[0] == " "]
        heads.update(zip(spaces, self.letters(spaces) if spaces else ()))
        others = [h for h in absent if not (spaced or h[0] == " ")]
        heads.update(zip(others, self.whole(others) if others else ()))
        new = list({t for _, _, h, t in rest if not (h and t in tails)})
        made = dict(zip(new, self.whole(new) if new else ()))
        for i, before, head, tail in rest:
            if head:
                data = tails[tail] if tail in tails else made[tail]
                out[i] = before + heads[head] + data
                if len(tails) < CACHE_TAILS:
                    tails[tail] = data
            else:
                out[i] = before + made[tail]
        return out

    def spaced_letters(self, words: pa.Array) -> Ragged:
        """Ids of words of letters, each with a space before it where words carry one, by one call of the library."""
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.string())), " ")[0].as_py() if len(words) else ""
        text = joined if self.word_ends else " " + joined
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids if joined else [], dtype=np.uint32)
        edges = np.flatnonzero(self.edge[ids])
        if len(edges) != len(words):
            return Ragged.of(self.whole(words.to_pylist() if self.word_ends else [" " + w for w in words.to_pylist()]))
        return Ragged(np.diff(edges, prepend=-1) if self.word_ends else np.diff(np.append(edges, len(ids))), ids)

    def new_words(self, words: pa.Array) -> Ragged:
        """Ids of new words of plain texts: letters go to the library together, what follows letters once, others whole.

        Where words carry their space, all but those that begin with a newline have one before them.
        """
        only = pc.match_substring_regex(words, f"^{_LETTER}+$").to_numpy(zero_copy_only=False)
        split = pc.extract_regex(words, f"(?s)^(?P<head>{_LETTER}+)(?P<tail>{_AFTER}.*)$")
        cut = split.is_valid().to_numpy(zero_copy_only=False)
        plain, ended, other = np.flatnonzero(only), np.flatnonzero(cut), np.flatnonzero(~only & ~cut)
        heads, tails = (pc.struct_field(split, i).take(pa.array(ended)).cast(pa.large_string()).dictionary_encode() for i in (0, 1))
        letters = self.spaced_letters(pa.concat_arrays([words.take(pa.array(plain)), heads.dictionary]))
        follow = Ragged.of(self.compute(tails.dictionary.to_pylist()) if len(tails.dictionary) else [])
        rest = words.take(pa.array(other)).to_pylist()
        rest = Ragged.of(self.compute(rest if self.word_ends else [w if w[:1] == "\n" else " " + w for w in rest]) if rest else [])
        # words in their order: one list, or two for letters and what follows them
        n_letters, n_follow = len(letters.lists), len(follow.lists)
        lists, many = Ragged(np.zeros(0, np.int64), np.zeros(0, np.uint32)), np.ones(len(words), dtype=np.int64)
        lists.lists = pa.concat_arrays([letters.lists, follow.lists, rest.lists])
        many[ended] = 2
        begin = np.cumsum(many) - many
        places = np.empty(int(many.sum()), dtype=np.int64)
        places[begin[plain]] = np.arange(len(plain))
        places[begin[ended]] = len(plain) + heads.indices.to_numpy()
        places[begin[ended] + 1] = n_letters + tails.indices.to_numpy()
        places[begin[other]] = n_letters + n_follow + np.arange(len(other))
        sizes = lists.sizes[places]
        return Ragged(np.add.reduceat(sizes, begin) if len(words) else sizes, lists.taken(places))

    def plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each) of texts whose words Arrow can cut."""
        if self.word_ends:
            lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        else:
            # a newline starts a piece and a first one stands before every text, so all other pieces follow a space
            lists = pc.split_pattern(pa.array(["\n" + t.replace("\n", " \n") for t in texts], pa.large_string()), " ")
        coded = lists.values.dictionary_encode()
        at, known = self.cache.places(folded_early(coded.dictionary) if self.word_ends else coded.dictionary)
        at = at[coded.indices.to_numpy()]
        ids, ends = known.taken(at), np.r_[0, np.cumsum(known.sizes[at])]
        counts = np.diff(ends[lists.offsets.to_numpy()])
        if not self.word_ends:
            first = np.cumsum(counts) - counts
            keep = np.ones(len(ids), dtype=bool)
            keep[first] = False
            ids, counts = ids[keep], counts - 1
        return ids, counts

    def encode(self, texts: list) -> list[bytes]:
        """The ids of each text (None: empty), END_ID not included."""
        out, plain = [b""] * len(texts), []
        for i, t in enumerate(texts):
            if not t:
                continue
            if "<|" in t or not self.word_ends and is_odd(t):
                pieces = self.cut(t)
                known = self.odd.holding(set(pieces))
                out[i] = b"".join(map(known.__getitem__, pieces))
            else:
                plain.append(i)
        if plain:
            ids, counts = self.plain([texts[i] for i in plain])
            data, end = ids.tobytes(), 0
            for i, n in zip(plain, (4 * counts).tolist()):
                out[i] = data[end : end + n]
                end += n
        return out


@lru_cache(maxsize=4)
def encoder(path: str, words: int = CACHE_WORDS) -> Encoder:
    return Encoder(path, words)


def forget() -> None:
    """Drop this worker's tokenizers and caches: a stage that needs none should not hold them."""
    encoder.cache_clear()
    library.cache_clear()
    gc.collect()
