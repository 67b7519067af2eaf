"""The pipeline's stages, one after the other, against plain rules for what each may drop."""

from collections import Counter

import corpus_pipeline
from millrace.llm import cube, decontaminate, jaccard_join
from millrace.llm.workspace import written


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, rows = docs.columns, docs.collect()
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, sf_dir), name)
        found[name] = docs
        if name != "tokens":
            assert docs.columns == columns
        if name == "language_id":
            assert docs.count() >= 0.97 * len(rows)
        if name == "near_duplicates":
            linked = jaccard_join.linked(before).collect()
            assert sorted(r.doc_id for r in docs.collect()) == sorted({r.component_id for r in linked})
        if name == "decontamination":
            benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
            bad = {r.doc_id for r in decontaminate.judged(before, benchmark).where("contaminated").collect()}
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in before.collect()} - bad
        if name == "mixing":
            want = {r.doc_id: r.copies for r in cube.mixed(before).collect() if r.copies}
            assert Counter(r.doc_id for r in docs.collect()) == want
    tokens = found["tokens"].orderBy("start").collect()
    assert [r.doc_id for r in tokens] == sorted(r.doc_id for r in found["mixing"].collect())
    assert all(a.start + a.n_tokens == b.start for a, b in zip(tokens[:-1], tokens[1:], strict=True))
