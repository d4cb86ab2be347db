"""Each training-data operator against brute force, SQL or held-out labels, and its edge cases."""

import hashlib
import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import types as T

from millrace.llm import exact_dedup, mixing, packing, quality, quality_rules, queries, scoring, simhash, substrings, token_counts, token_files
from millrace.llm.components import connected_components
from millrace.llm.tokens import END_ID, byte_level_pieces, encoder, library, tokenizer_path

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_words", T.StringType()), T.StructField("key", T.IntegerType()), T.StructField("kept", T.StringType())])
WORDS = ["the", "Cat", "sat,", "on", "a", "mät", "and", "#x", "ran", "off", "it's", "中文", "12", "<|endoftext|>", "é"]


def corpus(seed=1, n=60):
    """Random texts, copies, nulls, empties, a long text, repeated rows and a null id, with clashing extra columns."""
    draw = random.Random(seed)
    texts = [" ".join(draw.choice(WORDS) + draw.choice(["", "", str(i)]) for i in range(draw.randrange(0, 90))) for _ in range(n)]
    texts += [texts[3], texts[3].upper(), texts[5] + " tail", None, "", "   \n\t ", "x", "a b c d e", " ".join(draw.choice(WORDS) + str(i % 700) for i in range(4000)), "a" * 5000, "  two  spaces \n\n", "line one\nline one\nline two\n"]
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, "clash", i, "yes") for i, t in enumerate(texts)]
    return rows + [rows[4], (None, "no id here at all", None, "s1", None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(corpus(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "empty.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


def fold(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def tokens_of(text):
    return (text or "").encode().split()


LABELS = "doc_id long, quality int"
RUNS = {
    "op1": lambda d: quality_rules.judge(d),
    "op2": lambda d: scoring.score(d),
    "op3": lambda d: token_files.token_rows(d),
    "op4": lambda d: exact_dedup.exact_duplicates(d),
    "op5": lambda d: quality.quality_scores(d, d.sparkSession.createDataFrame([], LABELS)),
    "op6": lambda d: token_counts.token_counts(d),
    "op7": lambda d: simhash.near_duplicates(d),
    "op8": lambda d: packing.pack(d),
    "op9": lambda d: substrings.removed_digest(d),
    "op10": lambda d: mixing.mix(d),
}


@pytest.mark.parametrize("name", RUNS)
def test_empty_table(empty, name):
    assert RUNS[name](empty).collect() == []


@pytest.mark.parametrize("name", ["op1_quality_rules", "op4_exact_dedup", "op10_mixing"])
@pytest.mark.parametrize("odd", [False, True])
def test_against_sql(spark, small, tmp_path, docs, name, odd):
    folder = small
    if odd:
        folder = str(tmp_path)
        docs.dropDuplicates(["doc_id"]).coalesce(1).write.parquet(f"{folder}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet{'/*.parquet' if odd else ''}'")
    got, want = queries.queries()[name](spark, folder), con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in want.description]
    rows = sorted(repr([r[c] for c in names]) for r in got.collect())
    assert rows == sorted(repr(list(r)) for r in want.fetchall())


def test_rules_slow_path_agrees(spark):
    """The exact path for clashing windows gives the same as counting in Python."""
    from pyspark.sql import functions as F

    draw = random.Random(5)
    texts = [[draw.choice("abcd") for _ in range(draw.randrange(2, 60))] for _ in range(60)]
    want = []
    for w in texts:
        seen = Counter(zip(w, w[1:], w[2:]))
        want.append(len({p + k for p in range(len(w) - 2) if seen[tuple(w[p : p + 3])] > 1 for k in range(3)}))
    df = spark.createDataFrame([(w,) for w in texts], "__w array<string>")
    good = "CASE WHEN size(__w) < 3 THEN array() ELSE transform(sequence(0, size(__w) - 3), i -> xxhash64(__w[i], __w[i + 1], __w[i + 2])) END"
    for hashes in (good, "CASE WHEN size(__w) < 3 THEN array() ELSE transform(sequence(0, size(__w) - 3), i -> 7L * (i % 2) * 1048576L) END"):
        got = df.withColumn("__h", F.expr(hashes)).select(F.expr(quality_rules.repeated_words_sql())).collect()
        assert [r[0] for r in got] == want


def test_bad_hosts_lose_only_failing_documents(spark):
    good = " ".join(f"word{i}" for i in range(80))
    bad = " ".join(f"#{i}$" for i in range(80))
    rows = [(i, bad if i % 20 else good, None, "bad", None, None, None) for i in range(400)] + [(1000 + i, good, None, f"h{i % 9}", None, None, None) for i in range(400)] + [(5000, bad, None, "h1", None, None, None)]
    kept = {r.doc_id: (r.kept, r.base_failed) for r in quality_rules.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(kept[i] == (i % 20 == 0, False) for i in range(400))
    assert kept[5000] == (True, False) and all(kept[1000 + i][0] for i in range(400))


def test_the_worst_of_many_hosts_is_flagged(spark):
    """A host with far more failures than the others is flagged though no rule fails for half of its documents; hosts that
    are alike are not."""
    good, bad = " ".join(f"word{i}" for i in range(80)), " ".join(f"#{i}$" for i in range(80))
    rows = [(1000 * h + i, bad if i % 10 < (4 if h == 7 else 1) else good, None, f"h{h}", None, None, None) for h in range(30) for i in range(60)]
    got = quality_rules.judge(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.host for r in got if r.host_flagged} == {"=h7"}
    assert all(r.kept == (not (r.host_flagged and r.any_rule)) for r in got) and sum(not r.kept for r in got) == 24


@pytest.mark.parametrize("chars,owner,fan,lane", [(6_000_000, 3_000_000, 256, 512), (300, 50, 256, 7), (300, 50, 3, 512)])
def test_scores_against_a_dictionary_model(docs, monkeypatch, chars, owner, fan, lane):
    monkeypatch.setattr(scoring, "LANE", lane)
    rows = docs.select("doc_id", "text").collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    single, pair, triple, starts = Counter(), Counter(), Counter(), 0
    for r in rows:
        if not held(r.doc_id):
            w = [*fold(r.text).encode().split(), "end"]
            single.update(w)
            pair.update(zip(["start", *w], w))
            triple.update(zip(["start", *w], w, w[1:]))
            starts += 1
    n, v = sum(single.values()), len(single)

    def chance(a, b, c):
        p = (single[c] + 1) / (n + v + 1)
        p = (pair[b, c] + scoring.MU * p) / ((starts if b == "start" else single[b]) + scoring.MU)
        return p if a is None else (triple[a, b, c] + scoring.MU_PAIR * p) / (pair[a, b] + scoring.MU_PAIR)

    want = []
    for r in rows:
        w = [*fold(r.text).encode().split(), "end"]
        base = [math.log10((single[x] + 1) / (n + v + 1)) for x in w]
        full = [math.log10(chance(a, b, c)) for a, b, c in zip([None, "start", *w], ["start", *w], w)]
        want.append((r.doc_id, held(r.doc_id), len(w), sum(single[x] > 0 for x in w), n, round(sum(base), 6), round(sum(full), 6)))
    got = [(*r[:5], round(r[5], 6), round(r[6], 6)) for r in scoring.score(docs, chunk_chars=chars, owner_tokens=owner, fan=fan).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert sum(w[6] for w in want if w[1]) > sum(w[5] for w in want if w[1])


def test_weights_leaving_a_state_sum_to_one(spark, tmp_path):
    """Over the whole vocabulary, arcs and failure paths of every state carry a probability of one in all."""
    texts = ["a b a c", "a b", "c c a b a"]
    words = sorted({x for t in texts for x in t.split()})
    n, v, starts = 14, 4, 3
    chunk = scoring.Chunk({"sizes": [5, 3, 6], "doc_ids": [None] * 3, "words": scoring.pack_keys((made := scoring.read_chunk(texts))[2]), "stream": zlib.compress(made[1].astype("<u4").tobytes())})
    keys, number = chunk.triples()
    count = lambda at, m: np.bincount(at, minlength=m)
    model = scoring.Automaton(chunk, number, count(chunk.stream, 4), count(chunk.pair, len(chunk.pairs)), count(number[number >= 0], len(keys)), n, v, starts, 200.0, 20.0)
    unigram = 10 ** model.arc[0]
    assert unigram.sum() + 1 / (n + v + 1) == pytest.approx(1)  # the rest is kept for unknown tokens
    for state in range(1, 2 + 4):
        left = 1 if state == 1 else state
        arcs = {int(chunk.stream[i]): 10 ** model.arc[1][chunk.pair[i]] for i in range(len(chunk.stream)) if (1 if i in chunk.first else 2 + chunk.stream[i - 1]) == left}
        rest = 10 ** model.fail_cost[state]
        assert sum(arcs.values()) + rest * (1 - sum(unigram[x] for x in arcs)) == pytest.approx(1) or not arcs
    assert len(words) == 3


def test_key_and_count_packing():
    for keys in ([], [5], [0, 1, 2**64 - 1], sorted({random.Random(i).getrandbits(64) for i in range(1000)}), list(range(300))):
        assert scoring.unpack_keys(scoring.pack_keys(np.array(keys, dtype=np.uint64))).tolist() == keys
    for counts in ([], [0, 255], [256], [70_000, 2**40]):
        assert scoring.unpack_counts(scoring.pack_counts(np.array(counts, dtype=np.int64))).tolist() == counts


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_cached_ids_are_the_library_s(name):
    draw = random.Random(2)
    parts = [" ", "  ", "\n", "\n\n", " \n", "\t", "a", "Bc", "é", "É", "'s", "'S", "12", "!!", "<|endoftext|>", "<|STARTOFTEXT|>", "\xa0", "\x1c", "İ", "ß", "中文", "́", "ΣΑΣ", "ﬁ", " ", "😀", ",", "<", "|>", ".'s", "≠"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(0, 30))) for _ in range(1500)] + [r[1] for r in corpus()]
    path = tokenizer_path(name)
    want = [np.array(e.ids, "<u4").tobytes() for e in library(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert encoder(path).encode(texts) == want
    assert "".join(byte_level_pieces("a b\nc  d")) == "a b\nc  d"
    if name.startswith("word"):
        assert token_counts.counter(path).count(texts) == [len(w) // 4 for w in want]


def test_letters_that_compose_in_lower_case_only():
    path = tokenizer_path("word_bpe_49k.json")
    texts = [f"An {a}{b} {c}{m}{d} End" for c, m in zip("JHTWY", "\u030c\u0331\u0308\u030a\u030a") for a, b, d in [("Word", "s", "a"), ("\xc9t", "\xc9", "Ab"), ("x", "y", "\u0327\u030c")]] + ["T\u0327\u0308 \u1e6a\u0308 <|J\u030c"]
    want = [np.array(e.ids, "<u4").tobytes() for e in library(path).encode_batch(texts, add_special_tokens=False)]
    assert encoder(path).encode(texts) == want
    assert token_counts.counter(path).count(texts) == [len(w) // 4 for w in want]


def test_merges_that_rank_before_their_parts():
    """Where a merge makes a symbol that an earlier merge uses, occurrences go one by one, as in the reference order."""
    vocab = {s: i for i, s in enumerate(["a", "b", "c", "bc", "abc", "abcabc", "ab"])}
    merges = [("b", "c"), ("abc", "abc"), ("a", "bc"), ("a", "b")]
    table = token_counts.MergeTable(vocab, merges)

    def slow(ids):
        ids, rank, made = list(ids), {(vocab[a], vocab[b]): i for i, (a, b) in enumerate(merges)}, {(vocab[a], vocab[b]): vocab[a + b] for a, b in merges}
        while True:
            found = min(((rank[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in rank), default=None)
            if not found:
                return len(ids)
            i = found[1]
            ids[i : i + 2] = [made[ids[i], ids[i + 1]]]

    draw = random.Random(3)
    seqs = [[draw.randrange(3) for _ in range(draw.randrange(1, 14))] for _ in range(300)]
    sizes = np.array([len(s) for s in seqs])
    assert table.one_at_a_time.any()
    assert table.count(np.array([x for s in seqs for x in s]), sizes).tolist() == [slow(s) for s in seqs]


def test_token_counts_of_a_table(docs):
    path = tokenizer_path("word_bpe_49k.json")
    rows = docs.select("doc_id", "text").collect()
    want = [(r.doc_id, len((r.text or "").encode()), n := len(library(path).encode(r.text or "", add_special_tokens=False).ids), n > 2048) for r in rows]
    assert sorted(map(repr, map(tuple, token_counts.token_counts(docs).collect()))) == sorted(map(repr, want))


def test_token_file_round_trip(docs, monkeypatch):
    path = tokenizer_path("word_bpe_49k.json")
    monkeypatch.setattr(token_files, "BLOCK_IDS", 400)
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    want, at = [], 0
    for r in rows:
        ids = [*library(path).encode(r.text or "", add_special_tokens=False).ids, END_ID]
        want.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(repr, map(tuple, token_files.token_rows(docs).collect()))) == sorted(map(repr, want))


def test_variable_length_codes():
    draw = np.random.default_rng(1)
    lists = [draw.integers(0, 2 ** draw.choice([4, 8, 16, 24, 32]), draw.integers(0, 50), dtype=np.uint64).astype(np.uint32) for _ in range(200)]
    coded = [token_files.code_ranks(x) for x in lists]
    block = token_files.pack_block([None, *range(1, 200)], [len(x) for x in lists], [c for c, _ in coded], [d for _, d in coded])
    ids, counts, ranks = token_files.unpack_block(block)
    assert ids == [None, *range(1, 200)] and counts.tolist() == [len(x) for x in lists] and (ranks == np.concatenate(lists)).all()


def test_exact_dedup_with_colliding_keys(docs):
    want = {}
    for r in docs.collect():
        want.setdefault(fold(r.text), []).append(r.doc_id)
    expect = sorted(repr((i, max((x for x in g if x is not None), default=None), len(g), hashlib.sha256(t.encode()).hexdigest())) for t, g in want.items() for i in g)
    for bits in (64, 3):
        got = exact_dedup.exact_duplicates(docs, bucket_rows=4, key_bits=bits).collect()
        assert sorted(repr((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in got) == expect
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(want)


def test_directory_doubles_until_buckets_fit():
    directory, buckets = exact_dedup.split_buckets({0: 10, 1: 3, 7: 2}, 3, 5)
    assert [b[2] for b in buckets] == [10, 3, 0, 2] and directory == [0, 1, 2, 2, 3, 3, 3, 3]


@pytest.mark.parametrize("crowd", [2000, 1])
def test_near_duplicates_against_all_pairs(docs, crowd):
    rows = docs.select("doc_id", "text").collect()
    fps = np.array([simhash.fingerprint(simhash.shingle_hashes(fold(r.text))) for r in rows], dtype=np.uint64)
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 4):
            label[root(i)] = root(int(j))
    least = {}
    for i, r in enumerate(rows):
        k = root(i)
        least[k] = min((x for x in (least.get(k), r.doc_id) if x is not None), default=None)
    want = sorted(repr((r.doc_id, f"{int(f):016x}", least[root(i)])) for i, (r, f) in enumerate(zip(rows, fps)))
    assert sorted(repr(tuple(r)) for r in simhash.near_duplicates(docs, crowd=crowd).collect()) == want


def test_one_row_of_each_group_stays(spark):
    """Null and repeated ids: one row a component, whatever the ids of other components are."""
    draw = random.Random(8)
    text = [" ".join("".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(60)) for _ in range(6)]
    rows = [(None, text[0], "a"), (None, text[0], "b"), (None, text[0], "b"), (None, text[1], None), (3, text[1], "a"), (5, text[1], "a"), (7, text[2], "a"), (7, text[2], "b"), (7, text[3], "a"), (6, text[3], "a"), (9, text[4], "a"), (9, text[4], "a"), (6, text[5], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = simhash.one_of_each_group(docs)
    kept = {r.text: tuple(r) for r in got.collect()}
    assert got.columns == docs.columns and got.count() == len(kept) == 6 and set(kept.values()) <= set(rows)
    assert [kept[t][0] for t in text] == [None, 3, 7, 6, 9, 6]
    assert {tuple(r) for r in simhash.one_of_each_group(docs.repartition(2)).collect()} == set(kept.values())


@pytest.mark.parametrize("crowd", [10**6, 2])
def test_links_keep_components_of_planted_clusters(spark, tmp_path, crowd):
    draw = random.Random(4)
    fps = set()
    for _ in range(30):
        x = draw.getrandbits(64)
        for _ in range(8):
            for b in draw.sample(range(64), draw.randrange(0, 6)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long").write.parquet(f"{tmp_path}/fp")
    classes = spark.read.parquet(f"{tmp_path}/fp")
    near = {x: {y for y in fps if (x ^ y).bit_count() <= 4} for x in fps}

    def reach(x):
        seen, todo = {x}, [x]
        while todo:
            for y in near[todo.pop()] - seen:
                seen.add(y)
                todo.append(y)
        return seen

    for fine in (False, True):
        labels = {r.node % (1 << 64): r.label for r in connected_components(simhash.links(classes, crowd, fine)).collect()}
        for x in fps:
            group = reach(x)
            if len(group) > 1:
                assert {y for y, v in labels.items() if v == labels[x]} == group
            else:
                assert x not in labels


def test_segments_are_two_bits_wide_at_any_size(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(3,), (5,), (1 << 40,)], "fp long").write.parquet(f"{tmp_path}/fp")
    monkeypatch.setattr(simhash, "FINE_FROM", 2, raising=False)
    widths, counts = [], simhash.unary_counts
    monkeypatch.setattr(simhash, "unary_counts", lambda fp, fine: widths.append(fine) or counts(fp, fine))
    assert sorted(map(tuple, simhash.links(spark.read.parquet(f"{tmp_path}/fp")).collect())) == [(3, 5), (3, 1 << 40), (5, 1 << 40)]
    assert widths == [False]


def test_a_cell_leaves_a_forest_not_its_pairs():
    """Linked components are the brute-force ones and a cell of n members leaves n - 1 edges at most."""
    draw = random.Random(9)
    base = draw.getrandbits(64)
    near = {base ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) for _ in range(300)}
    far = {draw.getrandbits(64) for _ in range(200)}
    cells = sorted((c, x) for c, group in enumerate((near, far, near | far, set(list(near)[:1]))) for x in group)
    cell, fps = np.array([c for c, _ in cells]), np.array([x for _, x in cells], dtype=np.uint64)
    a, b = simhash.cell_forest(cell, fps)
    assert len(a) == 2 * (len(near) - 1) and set(a.tolist()) | set(b.tolist()) == near
    a, b = simhash.cell_forest(cell[:0], fps[:0])
    assert len(a) == len(b) == 0


def test_near_groups_leave_edges_in_proportion(spark, tmp_path):
    """Edges out of the grid join follow the number of members of a near group, not its square."""
    draw, made = random.Random(10), []
    base = draw.getrandbits(64)
    for n in (150, 300, 600):
        fps = set()
        while len(fps) < n:
            x = base
            for bit in draw.sample(range(64), 2):
                x ^= 1 << bit
            fps.add(x - (1 << 64) if x >> 63 else x)
        spark.createDataFrame([(x,) for x in fps], "fp long").write.parquet(f"{tmp_path}/fp{n}")
        edges = simhash.links(spark.read.parquet(f"{tmp_path}/fp{n}"))
        made.append(edges.count())
        assert {r.label for r in connected_components(edges).collect()} == {min(fps)}
    assert made[2] < 2.6 * made[1] < 2.6 * 2.6 * made[0]


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    assert Counter(r.label for r in connected_components(edges).collect()) == {0: 201, 500: 2}


def test_packing_is_whole_and_tight(docs):
    path = tokenizer_path("byte_bpe_50k.json")
    got = packing.pack(docs).toPandas()
    assert got.groupby("sequence_id").length.sum().max() <= 1024
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert (g.offset.values == np.r_[0, g.length.cumsum().values[:-1]]).all()
    want = []
    for r in docs.select("doc_id", "text").collect():
        ids = np.array([*library(path).encode(r.text or "", add_special_tokens=False).ids, END_ID], "<u4")
        want += [(r.doc_id, i, s, n, zlib.crc32(ids[s : s + n].tobytes())) for i, (s, n) in enumerate(packing.cut_pieces(len(ids)))]
    assert sorted(map(repr, want)) == sorted(repr((None if pd.isna(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32)) for r in got.itertuples())
    assert got.sequence_id.nunique() <= math.ceil(got.length.sum() / 1024) + 2


def test_best_fit_takes_the_tightest():
    draw = random.Random(6)
    lengths = sorted((draw.randrange(1, 101) for _ in range(500)), reverse=True)
    sequence, offset = packing.best_fit(lengths, 100)
    left = []
    for n, s, o in zip(lengths, sequence, offset):
        fits = [x for x in left if x >= n]
        if fits:
            assert 100 - o == min(fits)
            left.remove(100 - o)
        else:
            assert o == 0
        left.append(100 - o - n)
    assert packing.cut_pieces(2050) == [(0, 2), (2, 1024), (1026, 1024)] and packing.cut_pieces(1024) == [(0, 1024)]


def repeats(rows):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (t or "").encode()
        mark = np.zeros(len(b) + 1, dtype=int)
        for s in range(len(b) - 99):
            if b[s : s + 100] in seen:
                mark[s] += 1
                mark[s + 100] -= 1
            seen.add(b[s : s + 100])
        gone = np.cumsum(mark)[:-1] > 0
        out.append(repr((i, len(b), int(gone.sum()), int((np.diff(np.r_[False, gone].astype(int)) == 1).sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())))
    return sorted(out)


@pytest.mark.parametrize("chars,part,owner,fan", [(2_000_000, 1 << 24, 10**6, 256), (2500, 1 << 24, 10**6, 256), (3000, 700, 10, 256), (1500, 1 << 24, 10, 3)])
def test_repeats_against_all_substrings(spark, monkeypatch, chars, part, owner, fan):
    monkeypatch.setattr(substrings, "PART_BYTES", part)
    draw = random.Random(7)
    words = ["".join(draw.choice("abcdé") for _ in range(draw.randint(1, 8))) for _ in range(300)]
    text = lambda a, b: " ".join(draw.choice(words) for _ in range(draw.randint(a, b)))
    passages, rows = [text(15, 60) for _ in range(5)], []
    for i in range(90):
        t = text(0, 80)
        if draw.random() < 0.6:
            t += draw.choice(passages) + text(0, 30)
        if draw.random() < 0.1 and rows:
            t = draw.choice(rows)[1]
        if draw.random() < 0.1:
            t += draw.choice(["a", "xyz", "line of text\n"]) * draw.randint(20, 150)
        rows.append((draw.randrange(10**6) * 100 + i, t))
    rows += [(-5, None), (None, passages[0]), (7, "")]
    got = substrings.removed_digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), chunk_chars=chars, owner_keys=owner, fan=fan).collect()
    assert sorted(repr(tuple(r)) for r in got) == repeats(rows)


def test_repeats_of_odd_rows(docs):
    rows = [r for r in docs.select("doc_id", "text").collect()]
    unique = {r.doc_id: r.text for r in rows}
    got = substrings.remove_repeats(docs.dropDuplicates(["doc_id"])).collect()
    assert {r.doc_id: r.n_bytes for r in got} == {i: len((t or "").encode()) for i, t in unique.items()}
    assert all(len(bytes(r.kept)) == r.n_bytes - sum(b - a for a, b in r.spans) for r in got)


def test_classifier_on_held_out_labels(spark, small):
    folder = small.replace("sf0.001", "sf0.01")
    got = queries.op5_quality_classifier(spark, folder).toPandas()
    labels = pd.read_parquet(f"{folder}/labels.parquet")
    held = got[got.held_out].merge(labels, on="doc_id")
    good, bad = held[held.quality == 1].score.values, held[held.quality == 0].score.values
    assert (good[:, None] > bad[None]).mean() > 0.9
    assert ((got.score >= 0.5).astype(int) == got.predicted).all() and got.score.between(0, 1).all()


def test_chunks_cover_whole_texts():
    for n in (0, 1, 255, 256, 257, 384, 385, 5000):
        rows = quality.chunks("x" * n)
        seen = np.zeros(len(rows) * quality.STRIDE + quality.CHUNK, dtype=bool)
        for i, r in enumerate(rows):
            seen[i * quality.STRIDE : i * quality.STRIDE + quality.CHUNK] |= r != quality.PAD
        assert seen.sum() == n and seen[:n].all()


def test_filters_see_every_position():
    net = quality.Network.start()
    net.table[:] = -1
    for k, c in enumerate(b"qualit"):
        net.table[k, c] = 1
    net.out[:] = 1
    ends = quality.CHUNK - quality.WIDTH
    found = [float(net.chunk_scores(quality.chunks("x" * i + "qualit" + "x" * (ends - i)))[0]) for i in range(ends + 1)]
    assert found == [6.0 * quality.FILTERS] * (ends + 1)


def test_mix_meets_targets_in_many_blocks(spark, docs):
    rows = docs.select("doc_id", "text", "source").collect()
    got = mixing.mix(docs, block_rows=5).collect()
    assert sorted(repr((r.doc_id, r.size, r.source)) for r in got) == sorted(repr((r.doc_id, len(tokens_of(r.text)), r.source)) for r in rows)
    again = mixing.mix(docs.repartition(5), block_rows=1000).collect()
    assert sorted(repr((r.doc_id, r.taken)) for r in got) == sorted(repr((r.doc_id, r.taken)) for r in again)
    total, most = sum(r.size for r in got), max(r.size for r in got)
    assert sum(r.taken for r in got) <= total and all(r.taken % r.size == 0 and r.taken <= 3 * r.size for r in got if r.size)
    for source in {r.source for r in got}:
        own = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 2 * most
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns and sum(len(tokens_of(r.text)) for r in mixed.collect()) <= total
