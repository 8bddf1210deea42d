"""The pipeline against plain versions of its stages, and on awkward tables."""

import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm.test_operators import DOC, docs_of, encoder, plain_join, plain_leaks, plain_line_dedup
from tests.llm.test_quality import plain_verdicts

SF = "/root/testdata/sf0.001"


def test_run_matches_plain_stages(spark):
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    good = [(i, t) for (i, t, _), (kept, _) in zip(docs, plain_verdicts([x[1:] for x in docs]), strict=True) if kept]
    lines = {i: x for (i, _), x in plain_line_dedup(good).items() if x.strip()}
    classes = {d: c for d, c, _ in plain_join(sorted(lines.items()))}
    single = {i: x for i, x in lines.items() if classes[i] == i}
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {i: x for i, x in single.items() if i not in {a for a, *_ in plain_leaks(single.items(), bench)}}
    assert {i: r.text for i, r in got.items()} == left
    enc = encoder()
    assert all(r.n_tokens == len(enc.encode_ordinary(r.text)) and r.n_chars == len(r.text) for r in got.values())


def test_stages_keep_columns_and_survive_awkward_rows(spark):
    d = docs_of(spark, [None, "", "short", "x\n" * 50]).withColumn("row", F.lit(1)).withColumn("kept", F.lit("a"))
    d = d.unionByName(spark.createDataFrame([(None, None, None, None, None)], DOC).withColumn("row", F.lit(1)).withColumn("kept", F.lit("a")))
    for frame in (d, d.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SF)
            out.collect()
            assert out.columns[: len(frame.columns)] == frame.columns, name
            assert name == "encoding" or out.columns == frame.columns
