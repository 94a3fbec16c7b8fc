"""The pipeline against a brute-force version of its decisions, stage by stage."""

import re

import corpus_pipeline as cp
import pytest
from foliospark.llm import decontam, exact_dedup, ngram_join, packing, queries, toxicity

D = "/root/testdata/sf0.001"


def test_pipeline(spark):
    from llm_brute import best_fit, near_keep, toxicity_scores

    docs = spark.read.parquet(f"{D}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    sources = {r.doc_id: r.source for r in docs.collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{D}/labels.parquet").collect() if r.toxic is not None}
    toxic = {i for i, x in toxicity_scores(rows, labels, toxicity.Params()).items() if x >= 0.5}
    assert toxic == {r.doc_id for r in toxicity.score(docs, spark.read.parquet(f"{D}/labels.parquet")).collect() if r.predicted}
    kept = {i: t for i, t in rows.items() if i not in toxic}
    best = {}
    for i, t in kept.items():
        k = re.sub("[\x20\x09-\x0d]", "", t)
        best[k] = min(best.get(k, (0, 10**9)), (-len(t), i))
    kept = {i: kept[i] for _, i in best.values()}
    kept = near_keep(kept)
    items = {r.item_id: r.text for r in spark.read.parquet(f"{D}/benchmark.parquet").collect()}
    found = decontam.brute_force(kept, items)
    kept = {i: t for i, t in kept.items() if found[i][2] == 0 or (found[i][2] < 2 and found[i][1] < 8)}
    out = cp.run(spark, D).collect()
    assert {r.doc_id for r in out} == set(kept)
    want = best_fit({i: (t, sources[i]) for i, t in kept.items()}, packing.CAPACITY)
    assert {(r.doc_id, r.piece): (r.first_token, r.n_tokens, r.bin_id, r.bin_offset, r.bin_tokens) for r in out} == want
    assert [n for n, _ in cp.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard", "decontamination", "best_fit_packing"]


def test_pipeline_of_odd_tables(spark, tmp_path):
    """Null ids and texts, repeated rows, one id for two texts, very long texts, extra columns; then no rows at all."""
    base = " ".join(f"w{i}" for i in range(50))
    rows = [(1, base, "s"), (2, base + " ", "s"), (3, base + " more", None), (None, "x y", "t"), (None, None, "t"), (4, "", "t"), (5, "long " * 30_000, "u"), (5, "other text", "u"), (6, "q r s", "v"), (6, "q r s", "v")]
    docs = spark.createDataFrame([(i, t, "en", s, 0, "b", 1) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long, bin_id string, piece int")
    tables = {"documents": docs, "labels": spark.createDataFrame([(1, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int"), "benchmark": spark.createDataFrame([(1, "q r"), (2, "q r s"), (3, None)], "item_id long, text string")}
    for empty in (False, True):
        d = f"{tmp_path}/{empty}"
        for name, t in tables.items():
            (t.where("false") if empty else t).write.parquet(f"{d}/{name}.parquet")
        out = cp.run(spark, d).collect()
        if empty:
            assert out == []
        else:
            assert sorted({(r.doc_id or 0, r.n_tokens) for r in out}) == [(0, 3), (2, 51), (4, 1), (5, 3), (5, 1329), (5, 2048)]
            assert sum(r.n_tokens for r in out if r.doc_id == 5) == 30_004


def test_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    for _, stage in cp.STAGES[:-1]:
        assert stage(spark, docs, D).columns == docs.columns


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_run(spark, name):
    df = queries.QUERIES[name](spark, D)
    if name in queries.ORACLE:
        from compare import duck, sides

        ours, theirs = sides(df, duck(D), queries.ORACLE[name])
        assert ours == theirs
    else:
        assert df.count() > 0
