"""Stages and run() of the pipeline against brute force on the given tables."""

import re

import pytest

from llm_helpers import brute
from pixwave.session import shared_dir

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages(spark, sf_dir):
    from pixwave.llm import mixture, quality_crf, simhash_dedup
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        path = shared_dir(spark, f"test-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        out = spark.read.parquet(path)
        after = {r.doc_id: r for r in out.collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns and out.count() == len(after)
        if name == "quality_crf":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
            wrong = [i for i, q in labels.items() if i in before and (i in after) != bool(q)]
            assert len(wrong) <= 0.05 * len(labels)
        elif name == "simhash_dedup":
            ids = sorted(before)
            prints = [simhash_dedup.fingerprint_of((before[i].text or "").encode(), 4) for i in ids]
            root = brute.components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
            assert set(after) == {ids[r] for r in root}
        elif name == "substring_dedup":
            ids = sorted(before)
            for i, (w, gone) in zip(ids, brute.kept_words([before[i].text for i in ids], 35)):
                want = b" ".join(x for x, g in zip(w, gone) if not g).decode() if any(gone) else before[i].text
                assert after[i].text == want and after[i].n_chars == len(want)
        elif name == "decontaminate":
            token = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
            items = [token(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            known = {tuple(w[k:k + 13]) for w in items for k in range(len(w) - 12)}
            has = lambda t: any(tuple(w[k:k + 13]) in known for w in [token(t)] for k in range(len(w) - 12))
            assert set(after) == {i for i, r in before.items() if not has(r.text)}
        else:
            assert set(after) == set(before)
            assert all(r["size"] == len(brute.words(before[i].text)) and r.taken <= 2 * r["size"] for i, r in after.items())
        if name != corpus_pipeline.STAGES[-1][0]:
            docs = out
    assert mixture and quality_crf
    final = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id: tuple(r) for r in final.collect()} == {i: tuple(r) for i, r in after.items()}


def test_stages_take_messy_rows(spark, sf_dir):
    """Null, empty, repeated and unnamed rows, and extra columns, go through every stage."""
    texts = ["Plain words in a line that goes on for a while and ends. " * 2, "Another text altogether, of a few words."]
    docs = brute.messy(spark, texts)
    own = {(r.n_words, r.bucket, r.score) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        assert {(r.n_words, r.bucket, r.score) for r in out.collect()} <= own, name
        path = shared_dir(spark, f"test-{name}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()


def test_stages_take_no_rows(spark, sf_dir):
    docs = brute.empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0
