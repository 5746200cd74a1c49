"""The pipeline's stages on odd rows and against a brute-force version."""

import functools
import re
from collections import Counter

import corpus_pipeline as pipeline
from tests.conftest import SF_SMALL
from tests.llm.test_llm_dedup import fingerprint, groups


def test_contract():
    assert [n for n, _ in pipeline.STAGES] == ["quality", "exact_copies", "near_copies", "pii", "packing"]


def test_copies_on_odd_rows(spark, odd, none):
    kept = pipeline.exact_copies(spark, odd, SF_SMALL)
    assert kept.columns == odd.columns
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    rows = odd.collect()
    assert Counter(norm(r.text) for r in kept.collect()) == Counter({norm(r.text): 1 for r in rows})
    near = pipeline.near_copies(spark, odd, SF_SMALL)
    assert near.columns == odd.columns
    assert near.count() == len(set(groups([fingerprint(r.text) for r in rows])))
    for stage in (pipeline.exact_copies, pipeline.near_copies, pipeline.pii):
        assert stage(spark, none, SF_SMALL).count() == 0
    assert pipeline.pii(spark, odd, SF_SMALL).columns == odd.columns


def test_quality_and_packing_on_odd_rows(spark, odd, none, tmp_path, monkeypatch):
    monkeypatch.setattr(pipeline, "train", functools.partial(pipeline.train, steps=3))
    rows = Counter(map(tuple, odd.collect()))
    for name, quality in (("one kind", "0"), ("both", "doc_id % 2")):
        spark.range(20).selectExpr("id AS doc_id", f"CAST({quality.replace('doc_id', 'id')} AS INT) AS quality").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        kept = pipeline.quality(spark, odd, f"{tmp_path}/{name}")
        assert kept.columns == odd.columns
        got = Counter(map(tuple, kept.collect()))
        assert got == rows if name == "one kind" else not got - rows
        assert pipeline.quality(spark, none, f"{tmp_path}/{name}").count() == 0
    packed = pipeline.packing(spark, odd, SF_SMALL)
    lengths = packed.groupBy("sequence_id").sum("length").collect()
    assert len(lengths) and all(r[1] <= 2048 for r in lengths)
    assert packed.count() >= odd.count()
    assert pipeline.packing(spark, none, SF_SMALL).count() == 0


def test_run(spark, monkeypatch):
    monkeypatch.setattr(pipeline, "train", functools.partial(pipeline.train, steps=60))
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    scored = pipeline.quality(spark, docs, SF_SMALL).collect()
    by_text = {}
    for r in sorted(scored, key=lambda r: r.doc_id):
        by_text.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), r)
    rows = sorted(by_text.values(), key=lambda r: r.doc_id)
    label = groups([fingerprint(r.text) for r in rows])
    want = {rows[i].doc_id for i in set(label)}
    got = pipeline.run(spark, SF_SMALL)
    assert {r.doc_id for r in got.select("doc_id").distinct().collect()} == want
    assert len(want) > 0.5 * docs.count()
