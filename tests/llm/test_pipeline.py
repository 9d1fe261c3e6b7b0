"""The pipeline: every stage on a small corpus with planted cases, odd rows and empty tables."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm.test_operators import DOCS, prose, removal_by_force

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(11)
    base = [(i, " ".join(str(rng.random()) for _ in range(80)), "en", "a", 1) for i in range(12)]
    rows = base + [(50, base[3][1], "en", "a", 1), (51, base[4][1] + " end", "en", "a", 1), (51, base[4][1] + " end", "en", "a", 1)]
    rows += [(60, None, None, None, None), (61, "", "en", "a", 0), (None, prose(rng, 90), None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def test_near_duplicates_leave_one_of_each_group(spark, corpus):
    got = [r["doc_id"] for r in cp.near_duplicate_filter(spark, corpus, SF).collect()]
    assert sorted(x for x in got if x is not None) == [*range(12), 60] and got.count(None) == 1


def test_near_duplicates_leave_one_row_of_each_group_whatever_its_id(spark):
    rng = random.Random(12)
    a, b, c, d, e = (" ".join(str(rng.random()) for _ in range(80)) for _ in range(5))
    # two clean rows without an id, one that is a copy, an id with three texts of which one is a copy of a smaller id's, twins
    rows = [(None, a), (None, b), (None, c), (None, c + " end"), (1, d), (None, d), (7, e), (7, d), (7, a + " end"), (9, e), (9, e)]
    docs = spark.createDataFrame([(k, t, "en", str(i), 1) for i, (k, t) in enumerate(rows)], DOCS)
    got = {r["source"] for r in cp.near_duplicate_filter(spark, docs, SF).collect()}
    assert len(got) == 5 and got >= {"1", "4", "6", "8"} and len(got & {"2", "3"}) == 1


def test_repeats_are_cut(spark, corpus):
    rows = [(r["doc_id"], r["text"] or "") for r in corpus.collect()]
    want = sorted(str((k, n - gone)) for k, n, gone, _, _ in removal_by_force(rows, 200))
    got = cp.repeat_filter(spark, corpus, SF)
    assert got.columns == corpus.columns
    assert sorted(str((r["doc_id"], len((r["text"] or "").encode()))) for r in got.collect()) == want


def test_repeats_keep_replacement_characters_of_the_text(spark):
    rng = random.Random(13)
    line = " ".join(str(rng.random()) for _ in range(30))
    # the first byte of \u4e2d and \u4e00 is the same, the last one of \u6f22 and \u5b22 too: a repeat cuts into these characters
    rows = [(1, f"one \ufffd two \u6f22{line}\u4e2d\ufffd end"), (2, f"other \u5b22{line}\u4e00 tail \ufffd")]
    docs = spark.createDataFrame([(k, t, "en", "a", len(t)) for k, t in rows], DOCS)
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in cp.repeat_filter(spark, docs, SF).collect()}
    assert got == {1: ("one \ufffd two \ufffd end", 15), 2: ("other  tail \ufffd", 13)}


def test_stages_run_on_an_empty_table(spark, corpus):
    for _, stage in cp.STAGES:
        assert stage(spark, corpus.limit(0), SF).count() == 0


def test_stages_keep_columns_of_any_name(spark, corpus):
    names = ("__row", "__node", "__digest", "__root", "__sketch", "row", "digest", "spans", "first", "quality_score", "label")
    docs = corpus
    for name in names:
        docs = docs.withColumn(name, F.lit("clash"))
    for label, stage in cp.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns, label
        assert all(r[n] == "clash" for r in got.collect() for n in names), label
    assert cp.tokenize(spark, docs, SF).count() == docs.count()


def test_odd_rows_pass_all_stages(spark, corpus):
    """NULLs, empty texts, repeated rows: the quality, benchmark and token stages treat them as their docstrings say."""
    clean = cp.benchmark_filter(spark, corpus, SF)
    assert sorted(map(str, clean.collect())) == sorted(map(str, corpus.collect()))
    done = {(r["doc_id"], r["n_tokens"], r["round_trip"]) for r in cp.tokenize(spark, corpus, SF).collect()}
    assert {(60, 0, True), (61, 0, True)} <= done and all(r[2] for r in done)
    kept = cp.quality_filter(spark, corpus, SF)
    assert kept.columns == corpus.columns and kept.count() <= corpus.count()


def test_run_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    done = cp.run(spark, SF)
    rows = done.collect()
    assert all(r["round_trip"] for r in rows) and len({r["doc_id"] for r in rows}) == len(rows)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in rows}
    items = [re.sub(r"\s+", " ", r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = {r["doc_id"]: re.sub(r"\s+", " ", r["text"] or "") for r in docs.collect()}
    held = {k for k, t in texts.items() if any(i in t for i in items)}
    assert not held & kept
    good = {k for k, q in labels.items() if q == 1} - held
    assert len(good & kept) > 0.85 * len(good)
