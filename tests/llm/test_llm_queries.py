"""The registered queries against their oracles, and the pipeline stage by stage."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from harness import compare
from tallyloom.llm import decontamination, jaccard, mixing, quality_rules, secret_scan
from tallyloom.llm.common import read, stored
from tallyloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, sf_dir, name):
    assert compare.difference(QUERIES[name](spark, sf_dir), compare.duck(sf_dir), ORACLES[name]) is None


def test_pipeline_stages_take_effect(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    bench = read(spark, sf_dir, "benchmark")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, before, sf_dir), name)
        assert after.columns == docs.columns, name
        ids_before = {r.doc_id for r in before.select("doc_id").collect()}
        ids_after = {r.doc_id for r in after.select("doc_id").collect()}
        if name == "quality_rules":
            wanted = {r.doc_id for r in quality_rules.judged(before).where("kept").collect()}
        elif name == "ngram_jaccard":
            wanted = {r.component_id for r in jaccard.components(before).collect()}
        elif name == "decontamination":
            wanted = {r.doc_id for r in decontamination.contamination(before, bench).where("not contaminated").collect()}
        else:
            wanted = ids_before
            assert secret_scan.scan(after).where("n_assign + n_access + n_hex > 0").count() == 0
            assert after.where(F.char_length("text") != F.col("n_chars")).count() == 0
        assert ids_after == wanted, name
        before = after
    mixed = corpus_pipeline.STAGES[-1][1](spark, before, sf_dir)
    assert mixed.columns == [*docs.columns, "block", "place", "epoch"]
    plain = mixing.mix(before, repetitions=1.25).select("doc_id", "block", "place", "epoch")
    assert sorted(mixed.select("doc_id", "block", "place", "epoch").collect()) == sorted(plain.collect())


def test_pipeline_removes_near_copies_from_four_fifths_on(spark, sf_dir):
    base = [f"w{i}" for i in range(1000)]
    scattered = [f"x{i}" for i in range(1000)]
    changed = [f"new{i}" if i % 46 == 20 else w for i, w in enumerate(scattered)]
    unlike = [f"y{i}" for i in range(1000)]
    texts = [
        (1, base), (2, base + [f"v{i}" for i in range(220)]),  # 0.82
        (3, scattered), (4, changed),  # 0.80 on five words
        (5, unlike), (6, unlike + [f"z{i}" for i in range(270)]),  # 0.79
    ]
    rows = [(doc_id, " ".join(words), "en", "a", 0) for doc_id, words in texts]
    docs = spark.createDataFrame(rows, read(spark, sf_dir, "documents").schema)
    kept = corpus_pipeline.near_duplicates(spark, docs, sf_dir)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 5, 6]


def test_pipeline_of_odd_rows(spark, sf_dir):
    def prose(name, n=40):
        return " ".join(f"{name}word{i}" for i in range(n))

    secret = 'token = "c2VjcmV0MTIzNDU2Nzg5"'
    texts = [
        (1, None), (2, ""), (3, " \n"), (4, prose("a")), (4, prose("a")), (None, prose("a")), (9, prose("a")), (None, prose("b")),
        (None, prose("b")), (5, f"{prose('c')} {secret}"), (6, prose("d", 30_000)), (7, "too short"), (8, prose("e")),
    ]
    rows = [(i, text, None if i == 8 else "en", None if i == 8 else "s", 0, place, "x", "y", 1) for place, (i, text) in enumerate(texts)]
    names = "block long, place string, Row_Key string, epoch int"
    docs = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {names}")
    after = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, after, sf_dir), name)
        assert after.columns == docs.columns, name
    left = {(r.doc_id, (r.text or "")[:2]) for r in after.collect()}
    assert left == {(4, "aw"), (None, "bw"), (5, "cw"), (6, "dw"), (8, "ew")} and after.count() == 5
    redacted = after.where("doc_id = 5").first()
    assert redacted.text.endswith('<assign>"') and redacted.n_chars == len(redacted.text) and redacted.source == "s"
    mixed = corpus_pipeline.mixture(spark, after, sf_dir)
    assert mixed.columns == [*docs.columns, "block_", "place_", "epoch_"]
    found = {(r.doc_id, r.block, r.source) for r in mixed.collect()}
    assert found <= {(r.doc_id, r.block, r.source) for r in after.collect()} and {r[2] for r in found} == {None, "s"}


def test_rows_that_differ_in_other_columns_stay_apart_in_the_mixture(spark):
    docs = spark.createDataFrame([(1, "a b c", "en", "s"), (1, "a b c", "de", "s"), (1, "a b c", "de", "s")], "doc_id long, text string, lang string, source string")
    mixed = mixing.mix_texts(docs, repetitions=1.0).collect()
    assert sorted(r.lang for r in mixed) == ["de", "de", "en"]


def test_pipeline_of_an_empty_table(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0


def test_native_operators_run_no_python(spark, sf_dir):
    docs, bench = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    for df in (decontamination.contamination(docs, bench), mixing.mix(docs, repetitions=1.25)):
        plan = df._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|ArrowEval", plan)
