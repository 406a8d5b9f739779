"""The whole pipeline against a plain version of its stages."""

import re

import corpus_pipeline
from sheafmill.llm import packing, private_terms, quality_rules
from test_operators import gapless, linked_slowly, slow_fingerprint


def test_pipeline(spark, sf_dir, documents):
    rows = {r.doc_id: r.text for r in documents.collect()}
    model = quality_rules.fit(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = {k: t for k, t in rows.items() if quality_rules.assess(t.encode(), model)[-1]}
    groups = {}
    for k, t in rows.items():
        groups.setdefault(re.sub(r"[ \t-\r]", "", t), []).append((-len(t), k))
    kept = {min(g)[1] for g in groups.values()}
    rows = {k: t for k, t in rows.items() if k in kept}
    prints = {k: slow_fingerprint(t) for k, t in rows.items()}
    root, least = linked_slowly(set(prints.values())), {}
    for k in sorted(rows):
        least.setdefault(root[prints[k]], k)
    rows = {k: t for k, t in rows.items() if k in least.values()}
    clean = private_terms.sanitise(spark.createDataFrame(list(rows.items()), "doc_id long, text string"))
    coder = packing.coder(packing.VOCABULARY)
    want = {r.doc_id: len(coder.ids(r.text)) // 4 + 1 for r in clean.collect()}
    got = corpus_pipeline.run(spark, sf_dir).toPandas()
    assert got.groupby("doc_id").length.sum().to_dict() == want
    gapless(got)
