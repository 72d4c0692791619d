import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tagstream.llm.mixing import mix
from tagstream.llm.quality import classify
from tests.llm.tables import DOCS, clashing
from tests.llm.test_decontaminate import shingles
from tests.llm.test_simhash import groups, slow_fingerprint
from tests.llm.test_topics import with_a_rare_subject

DATA = "/root/testdata/sf0.001"

needs_tables = pytest.mark.skipif(not Path(DATA).exists(), reason="needs the given tables")


def slow(spark, sf_dir):
    """Stage by stage in Python; the model's scores and the draws come from the operators."""
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = {r.doc_id for r in classify(frame, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect() if r.predicted}
    rows = sorted((r for r in frame.collect() if r.doc_id in good), key=lambda r: r.doc_id)
    yield {r.doc_id for r in rows}
    rows = [rows[i] for i in sorted(set(groups([slow_fingerprint(r.text) for r in rows], 2)))]
    yield {r.doc_id for r in rows}
    items = [s for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect() if (s := shingles(r.text))]
    rows = [r for r in rows if not any(len(s & shingles(r.text)) >= 0.8 * len(s) for s in items)]
    yield {r.doc_id for r in rows}
    chosen = {r.doc_id for r in mix(spark.createDataFrame(rows, frame.schema)).collect() if r.selected}
    rows = [r for r in rows if r.doc_id in chosen]
    yield {r.doc_id for r in rows}
    tokenizer, start, out = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, set()
    for r in rows:
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
        out.add((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    yield out


@needs_tables
def test_stages_and_run(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, want = docs.columns, None
    for (name, stage), want in zip(corpus_pipeline.STAGES, slow(spark, DATA)):
        path = str(tmp_path / name)
        stage(spark, docs, DATA).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
            assert {r.doc_id for r in docs.collect()} == want, name
    got = {(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in corpus_pipeline.run(spark, DATA).collect()}
    assert got == want and len(want) > 50


@needs_tables
def test_stages_take_odd_tables(spark, tmp_path):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (None, None, None, None, None), (2, "", "en", None, 0), (3, "x" * 300_000, None, "s", 9)]
    for case, own in (("odd", rows), ("empty", [])):
        docs = clashing(spark.createDataFrame(own, DOCS))
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{case}-{name}")
            stage(spark, docs, DATA).write.parquet(path)
            docs = spark.read.parquet(path)
            if name != "token_output":
                assert docs.columns == columns
        assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_source_mixing_takes_its_topics_from_all_documents(spark):
    """A rare subject has a topic of its own, whose damped share holds all of its documents."""
    frame, rare = with_a_rare_subject(spark, 8)
    kept = {r.doc_id for r in corpus_pipeline.source_mixing(spark, frame, "").collect()}
    assert rare <= kept and 0.4 * frame.count() < len(kept) < 0.8 * frame.count()
