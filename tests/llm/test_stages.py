"""Each pipeline stage on nulls, empty and very long texts, repeated rows and ids, empty tables and clashing names."""

import random
from collections import Counter

import pytest
from pyspark.sql import types as T

from millrace.llm import common, exact_dedup, mixing, packing, quality, simhash

CLASH = ["__id", "__kept", "__n", "__mark", "__row", "__times", "row", "mark", "key", "listed", "cell", "bucket", "uid", "a`b", "own_source"]
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in CLASH]
    + [T.StructField("m", T.MapType(T.StringType(), T.IntegerType())), T.StructField("s", T.StructType([T.StructField("x", T.ArrayType(T.IntegerType()))]))]
)


def row(i, text, lang="en", source="s0", extra="e", m=None):
    return (i, text, lang, source, *[extra] * len(CLASH), m if m is not None else {"a": 1, "b": 2}, ([1, 2],))


def rows():
    draw = random.Random(3)
    words = ["".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    texts = [" ".join(draw.choice(words) for _ in range(80)) for _ in range(12)]
    t, other = texts[0], texts[1]
    out = [row(100 + i, x, source=f"s{i % 3}") for i, x in enumerate(texts[2:])]
    out += [row(1, t), row(5, t), row(5, other), row(5, other), row(None, t), row(None, t, extra=None), row(7, t.upper())]
    out += [row(20, texts[2], m={}), row(21, None), row(22, None, source=None), row(23, ""), row(24, "  \n "), row(None, None)]
    out += [row(30, " ".join(draw.choice(words) for _ in range(30_000))), row(31, "x" * 50_000), row(31, "x" * 50_000), row(31, "x" * 50_000, extra=None)]
    return out


def key(r):
    return repr(tuple(r))


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stages") / "docs.parquet")
    spark.createDataFrame(rows(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def good(docs):
    labels = docs.sparkSession.createDataFrame([(100 + i, i % 2) for i in range(10)] + [(None, 1), (21, None)], "doc_id long, quality int")
    return quality.keep_good(docs, labels)


STAGES = {"quality": good, "exact": exact_dedup.drop_duplicates, "near": simhash.one_of_each_group, "mix": mixing.mix_documents}


@pytest.mark.parametrize("name", STAGES)
def test_stage_keeps_columns_and_takes_an_empty_table(none, name):
    out = STAGES[name](none)
    assert out.columns == none.columns and out.collect() == []


@pytest.mark.parametrize("name", STAGES)
def test_stage_returns_rows_as_they_are(docs, name):
    out = STAGES[name](docs)
    have = Counter(map(key, docs.collect()))
    got = Counter(map(key, out.collect()))
    assert out.columns == docs.columns and set(got) <= set(have)
    if name != "mix":
        assert all(n <= have[k] for k, n in got.items())


def test_pack_takes_clashing_names(docs):
    assert packing.pack(docs).filter("piece = 0").count() == docs.count()


def fold(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def test_exact_stage_keeps_one_row_of_each_text(docs):
    best = {}
    for r in docs.collect():
        best.setdefault(fold(r.text), []).append(r.doc_id)
    got = {}
    for r in exact_dedup.drop_duplicates(docs).collect():
        assert fold(r.text) not in got
        got[fold(r.text)] = r.doc_id
    assert got == {t: max((i for i in ids if i is not None), default=None) for t, ids in best.items()}


def test_near_stage_keeps_one_row_of_each_component(docs):
    all_rows = docs.collect()
    fps = [simhash.fingerprint(simhash.shingle_hashes(r.text)) for r in all_rows]
    group = list(range(len(fps)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= simhash.DISTANCE:
                group[root(i)] = root(j)
    want = {}
    for i, r in enumerate(all_rows):
        want.setdefault(root(i), []).append(r.doc_id)
    kept = simhash.one_of_each_group(docs).collect()
    assert Counter(r.doc_id for r in kept) == Counter(min((i for i in ids if i is not None), default=None) for ids in want.values())
    assert len(kept) == len(want)


def test_a_near_copy_under_the_kept_id_goes(spark):
    """(1, T), (5, T), (5, other): of the first text 1 stays, and 5 stays with the other text only."""
    draw = random.Random(4)
    t, other = (" ".join("".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(60)) for _ in range(2))
    docs = spark.createDataFrame([(1, t), (5, t), (5, other)], "doc_id long, text string")
    assert sorted(map(tuple, simhash.one_of_each_group(docs).collect())) == sorted([(1, t), (5, other)])


def test_mix_stage_takes_what_the_mix_takes(docs):
    got = Counter((r.doc_id, r.text) for r in mixing.mix_documents(docs).collect())
    total = sum(len((r.text or "").split()) for r in docs.collect())
    assert sum(len(t.split()) * n for (_, t), n in got.items()) <= total
    assert not any(t is None or not t.split() for _, t in got)
    once = docs.dropDuplicates(["doc_id"]).filter("doc_id IS NOT NULL")
    want = {r.doc_id: r.taken // r.size for r in mixing.mix(once).collect() if r.taken}
    assert Counter(r.doc_id for r in mixing.mix_documents(once).collect()) == want


def test_mix_with_many_sources_by_join(docs, monkeypatch):
    want = sorted(repr(tuple(r)) for r in mixing.mix_documents(docs).collect())
    monkeypatch.setattr(mixing, "SOURCES_SENT", 0)
    assert sorted(repr(tuple(r)) for r in mixing.mix_documents(docs).collect()) == want


def test_blocks_of_blocks(docs, monkeypatch):
    want = sorted(repr(tuple(r)[:6]) for r in mixing.mix(docs, block_rows=1).collect())
    monkeypatch.setattr(mixing, "BLOCKS_SUMMED", 2)
    assert sorted(repr(tuple(r)[:6]) for r in mixing.mix(docs, block_rows=1).collect()) == want


def test_key_filter_misses_nothing(spark, tmp_path):
    spark.range(500).selectExpr("id * 7919 AS key").write.parquet(f"{tmp_path}/keys")
    keys = spark.read.parquet(f"{tmp_path}/keys")
    marked = common.KeyFilter(keys, 500).mark(spark.range(8000), common.F.col("id")).collect()
    listed = {i * 7919 for i in range(500)}
    assert all(r.listed for r in marked if r.id in listed) and sum(r.listed for r in marked) < 400
    full = common.KeyFilter(keys.limit(0), 0).mark(spark.range(10), common.F.col("id"))
    assert not any(r.listed for r in full.collect())


def test_index_splits_chains_and_answers(spark, tmp_path):
    """Splits and chains on the query's own path: 4-bit keys, buckets of 3, entries found through the directory."""
    spark.createDataFrame([(i, f"text {i % 40}") for i in range(100)], "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    index = exact_dedup.build_index(docs, bucket_rows=3, key_bits=4)
    entries = index.entries.collect()
    assert len(entries) == 40 and max(e.link for e in entries) > 0 and len({e.bucket for e in entries}) > 2
    assert index.global_depth == max(r.local_depth for r in index.directory.collect()) > 1
    by_key = {}
    for e in entries:
        by_key.setdefault((e.bucket, e.key), []).append(e.link)
    assert all(sorted(links) == list(range(len(links))) for links in by_key.values()) and len({k for _, k in by_key}) == len(by_key)
    assert all(r.group_size == (3 if r.doc_id % 40 < 20 else 2) for r in exact_dedup.exact_duplicates(docs, bucket_rows=3, key_bits=4).collect())


def test_release_removes_scratch(spark, docs):
    since = common.scratch_mark(spark)
    out = exact_dedup.exact_duplicates(docs).collect()
    assert out and common.scratch_mark(spark) > since
    assert common.release(spark, since) > 0 and common.scratch_mark(spark) == since


def plain_score(net, text):
    """The network position by position, in Python floats."""
    import numpy as np

    logit, rows = 0.0, quality.chunks(text)
    for row in rows:
        for f in range(quality.FILTERS):
            best = max(sum(float(net.table[k, row[p + k], f]) for k in range(quality.WIDTH)) for p in range(quality.CHUNK - quality.WIDTH + 1))
            logit += max(0.0, best + float(net.bias[f])) * float(net.out[f]) / len(rows)
    return 1 / (1 + float(np.exp(-(logit + float(net.base)))))


def test_scores_are_the_plain_convolution(docs):
    net = quality.Network.start()
    net.bias[:] = [i / 50 for i in range(quality.FILTERS)]
    net.base += 0.25
    texts = ["a", "Ein Wörtchen", "x" * 128, "ab" * 128, "中文 text " * 30, "\ttabs\n" * 70]
    assert net.score(texts) == pytest.approx([plain_score(net, t) for t in texts], abs=1e-5)
    assert net.score([None, "", " \n"]).tolist() == [0, 0, 0]


def test_a_score_does_not_depend_on_what_is_scored_with_it():
    draw = random.Random(2)
    net = quality.Network.start()
    texts = ["".join(draw.choice("abc dé\n") for _ in range(draw.randrange(1, 2000))) for _ in range(60)]
    alone = [net.score([t])[0] for t in texts]
    assert net.score(texts).tolist() == alone and net.score(texts[::-1]).tolist() == alone[::-1]


def test_gradient_is_the_slope_of_the_loss():
    import numpy as np

    draw, net = np.random.default_rng(5), quality.Network.start()
    net.table, net.bias, net.out = (x.astype(np.float64) for x in (net.table, net.bias, net.out))
    net.base = np.float64(0.1)
    cut = [quality.chunks(t) for t in ("some words here", "x" * 700, "other 中文")]
    rows, sizes = np.concatenate(cut), np.array([len(c) for c in cut])
    owner, y, weight = np.repeat(np.arange(3), sizes), np.array([1.0, 0.0, 1.0]), np.array([0.7, 1.3, 0.7])
    _, gradient = quality.loss(net, rows, owner, sizes, y, weight)
    for name in ("bias", "out", "table"):
        values, slope = getattr(net, name), gradient[name]
        steep = np.argsort(-np.abs(slope).ravel())[:5]
        for i in [*steep, *draw.integers(0, values.size, 3)]:
            old, ends = values.flat[i], []
            for h in (1e-5, -1e-5):
                values.flat[i] = old + h
                ends.append(quality.loss(net, rows, owner, sizes, y, weight)[0])
            values.flat[i] = old
            assert (ends[0] - ends[1]) / 2e-5 == pytest.approx(slope.flat[i], rel=1e-2, abs=1e-5)


def test_long_documents_are_learned_from(spark):
    """A long document is sampled by chunks, not passed over, and repeated ids do not push others out."""
    rows = [(i, ("good words " if i % 2 else "#$% ") * (40_000 if i < 4 else 60)) for i in range(40)] + [(0, "#$% ")] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    got = quality.training_rows(docs, labels, rows=10)
    assert len(got) <= 20 and {q for _, q in got} == {0, 1} and all(len(c) <= quality.SAMPLE_CHUNKS for c, _ in got)
    assert sum(len(c) == quality.SAMPLE_CHUNKS for c, _ in quality.training_rows(docs, labels)) >= 1


def test_classifier_takes_odd_rows(docs):
    labels = docs.sparkSession.createDataFrame([(100 + i, i % 2) for i in range(10)], "doc_id long, quality int")
    got = quality.quality_scores(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    again = quality.quality_scores(docs.repartition(5), labels).collect()
    assert sorted(repr(tuple(r)) for r in got) == sorted(repr(tuple(r)) for r in again)
    assert all(r.score == 0 for r in got if r.doc_id in (21, 22, 23, 24))


@pytest.mark.parametrize("owners,fan", [(5, 256), (5, 2), (60, 4), (64, 8)])
def test_tree_exchange_adds_up(spark, tmp_path, owners, fan):
    import numpy as np

    from millrace.llm import exchange

    draw = np.random.default_rng(owners)
    pool = np.unique(draw.integers(0, 2**64, 400, dtype=np.uint64))
    members = {m: (k := np.sort(draw.choice(pool, 60, replace=False)), draw.integers(0, 400, len(k))) for m in range(30)}
    rows = [(m, kind, bytearray(exchange.pack_keys(k)), bytearray(exchange.pack_counts(2 * c * (kind + 1)))) for m, (k, c) in members.items() for kind in (0, 1)]
    spark.createDataFrame(rows, exchange.ASKED).write.parquet(f"{tmp_path}/asked")
    answers = exchange.resolve(spark.read.parquet(f"{tmp_path}/asked"), 30, owners, fan=fan)
    got = {r.member: r.got for r in exchange.gathered(answers, "member", "got").collect()}
    for kind in (0, 1):
        total, holders = {}, {}
        for k, c in members.values():
            for x, n in zip(k.tolist(), c.tolist()):
                total[x], holders[x] = total.get(x, 0) + n * (kind + 1), holders.get(x, 0) + 1
        for m, (k, _) in members.items():
            assert exchange.answers_of(got[m], kind).tolist() == [2 * total[x] + (holders[x] > 1) for x in k.tolist()]
        assert sum(r.distinct for r in answers.filter(f"kind = {kind}").collect()) == sum(n > 0 for n in total.values())


def test_exchange_rows_follow_the_members(spark, tmp_path, monkeypatch):
    """When members and owners double together, the pieces that move double, they do not quadruple."""
    import numpy as np

    from millrace.llm import exchange

    made, split = [], exchange._split
    monkeypatch.setattr(exchange, "_split", lambda *a: made.append(split(*a)) or made[-1])
    draw, moved = np.random.default_rng(1), []
    for n in (16, 32, 64):
        rows = [(m, 0, bytearray(exchange.pack_keys(np.unique(draw.integers(0, 2**64, 300, dtype=np.uint64)))), bytearray(exchange.pack_counts(np.full(300, 2)))) for m in range(n)]
        spark.createDataFrame(rows, exchange.ASKED).write.parquet(f"{tmp_path}/asked{n}")
        made.clear()
        monkeypatch.setattr(exchange, "discard", lambda *a: None)
        exchange.resolve(spark.read.parquet(f"{tmp_path}/asked{n}"), n, n, fan=4)
        moved.append(sum(x.count() for x in made))
    assert moved[2] < 3.2 * moved[1] < 3.2 * 3.2 * moved[0]


def test_rules_take_repeated_ids(docs):
    from millrace.llm import quality_rules

    got = quality_rules.judge(docs).collect()
    assert sorted(repr(r.doc_id) for r in got) == sorted(repr(r.doc_id) for r in docs.select("doc_id").collect())
    single = {r.n_words for r in quality_rules.judge(docs.filter("doc_id = 31 AND m IS NOT NULL")).collect()}
    assert {r.n_words for r in got if r.doc_id == 31} == single == {1}


def test_repeats_of_repeated_rows(spark):
    """Of rows that are equal throughout one keeps what no earlier row has, however they are dealt."""
    from millrace.llm import substrings

    from test_operators import repeats

    draw = random.Random(12)
    texts = ["".join(draw.choice("abcd ") for _ in range(draw.randrange(90, 400))) for _ in range(8)]
    rows = [(i % 5, texts[i % 5]) for i in range(20)] + [(None, texts[6])] * 3 + [(9, texts[7] + texts[6])] * 2
    got = substrings.removed_digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), chunk_chars=300).collect()
    assert sorted(repr(tuple(r)) for r in got) == repeats(rows)


def test_mix_of_ties_does_not_depend_on_the_deal(spark):
    rows = [(i % 7, "a b c " * (1 + i % 3), f"s{i % 2}") for i in range(80)] + [(None, "x y", None)] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    runs = [sorted(repr((r.doc_id, r.size, r.source, r.taken)) for r in mixing.mix(docs.repartition(n), block_rows=b).collect()) for n, b in ((2, 2000), (5, 3))]
    assert runs[0] == runs[1] and len(runs[0]) == len(rows)


def test_scores_of_repeated_rows(spark):
    from millrace.llm import scoring

    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b"), (9, "a b c")], "doc_id long, text string")
    got = scoring.score(docs).collect()
    assert len(got) == 4 and len({(r.score, r.base_score) for r in got if r.doc_id is not None}) == 1
