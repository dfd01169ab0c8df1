import re
from collections import Counter

import corpus_pipeline
from loomtext.llm import packing, secrets


def test_stages_do_what_they_say(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        docs = stage(spark, docs, sf)
        assert docs.columns == columns, name
        after = docs.collect()
        assert not Counter(r["doc_id"] for r in after) - Counter(r["doc_id"] for r in before), name
        if name == "secrets":
            assert len(after) == len(before)
            assert not any(secrets.base_spans(r["text"]) for r in after)
            assert all(r["n_chars"] == len(r["text"]) for r in after)
        if name == "decontamination":
            shingles = lambda t: {tuple(w[i : i + 5]) for w in [re.findall(r"\w+", t.lower())] for i in range(max(1, len(w) - 4))}
            items = [shingles(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            leaks = {r["doc_id"] for r in before for s in [shingles(r["text"])] if any(len(i & s) >= 0.8 * len(i) for i in items)}
            assert {r["doc_id"] for r in before} - {r["doc_id"] for r in after} == leaks
        docs = spark.createDataFrame(after, docs.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in after}
    fill = Counter()
    for r in packed:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= packing.CAPACITY


def test_odd_documents_go_through(spark, odd, none, tmp_path):
    for k, (rows, least) in enumerate(((odd, 5), (none, 0))):
        folder = tmp_path / str(k)
        rows.write.parquet(str(folder / "documents.parquet"))
        spark.createDataFrame([(1, 1, 0)], "doc_id long, quality long, toxic long").write.parquet(str(folder / "labels.parquet"))
        spark.createDataFrame([], "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
        got = corpus_pipeline.run(spark, str(folder)).collect()
        assert len({r["doc_id"] for r in got}) >= least
