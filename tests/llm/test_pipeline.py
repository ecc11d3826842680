"""The pipeline's stages on the small test table, against plain Python where there is a plain answer."""

import re

import corpus_pipeline
from areapanel.llm.shingles import shingle_sets
from areapanel.session import write_scratch


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, inputs = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        inputs.append(docs)
        docs = write_scratch(stage(spark, docs, sf_dir), "stage")
        if i < 4:
            assert docs.columns == columns
    first, second, third, fourth, last = ({r.doc_id: r.text for r in d.collect()} for d in inputs)
    assert len(second) >= 0.99 * len(first)
    same = {}
    for k, t in second.items():
        same.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), []).append(k)
    assert set(third) == {min(v) for v in same.values()}
    keys = sorted(third)
    sets = dict(zip(keys, (set(s.tolist()) for s in shingle_sets([third[k].encode() for k in keys], 5)), strict=True))
    for i, a in enumerate(keys):  # what goes has a link to an earlier one or through one; what stays has none to what stays
        for b in keys[:i]:
            if a in fourth and b in fourth:
                both = len(sets[a] & sets[b])
                assert 100 * both < 80 * (len(sets[a]) + len(sets[b]) - both)
    assert set(last) == set(fourth) and not any(re.search(r"@mail\d", t) for t in last.values())
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == set(last)
