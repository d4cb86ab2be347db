"""The corpus pipeline against its stages' own rules."""

import corpus_pipeline
from millrace.llm import mixing, simhash


def test_pipeline_stage_by_stage(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "mixing", "best_fit_packing"]
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small)
        out.write.parquet(f"{tmp_path}/{name}")
        rows = [r.asDict() for r in spark.read.parquet(f"{tmp_path}/{name}").collect()]
        if name != "best_fit_packing":
            assert out.columns == columns
            docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append(rows)
    good, exact, near, mixed, packed = seen
    fold = lambda t: "".join(c.lower() if c.isascii() else c for c in t)
    best = {}
    for r in good:
        best[fold(r["text"])] = max(best.get(fold(r["text"]), -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in exact) == sorted(best.values())
    fps = [(r["doc_id"], simhash.fingerprint(simhash.shingle_hashes(r["text"]))) for r in exact]
    group = {i: i for i, _ in fps}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in fps:
        for j, b in fps:
            if i < j and (a ^ b).bit_count() <= simhash.DISTANCE:
                x, y = sorted((root(i), root(j)))
                group[y] = x
    assert sorted(r["doc_id"] for r in near) == sorted(i for i in group if root(i) == i)
    taken = {r.doc_id: r.taken // r.size for r in mixing.mix(spark.read.parquet(f"{tmp_path}/simhash_near_dedup")).collect() if r.taken}
    times = {}
    for r in mixed:
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert times == taken
    pieces = {}
    for r in packed:
        pieces[r["doc_id"]] = pieces.get(r["doc_id"], 0) + (r["piece"] == 0)
    assert pieces == times


def test_run_is_the_stages(spark, small):
    assert corpus_pipeline.run(spark, small).count() > 0
