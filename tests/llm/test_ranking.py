"""Block-Max MaxScore against scoring every document."""

from __future__ import annotations

import math
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from spotshare.llm import queries, ranking

DOCS = "doc_id long, text string"


def terms_of(text):
    lowered = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain_search(docs, items, k):
    held = [(i, terms_of(t)) for i, t in docs]
    held = [(i, t) for i, t in held if t]
    n, total = len(held), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for i, t in held:
            m = 100 - 25 + 25 * len(t) * n // total
            score = 0
            for x in terms_of(text):
                tf = t.count(x)
                if tf:
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * (1_000_000_000 * tf // (1000 * tf + 12 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(12)
    words = ["the", "of", "And", *(f"w{i}" for i in range(40)), "é漢", "x1", "über", "42"]
    weights = [60, 40, 30, *(40 / (i + 1) for i in range(40)), 2, 2, 1, 1]
    prose = lambda n: " ".join(rng.choices(words, weights, k=n))
    rows = [(i, prose(rng.choice([1, 3, 10, 30, 80]))) for i in range(700)]
    rows += [(i, "the same w39 text w39") for i in range(800, 840)] + [(5, "w39 w39"), (5, "w39 w39"), (None, "w39 W39"), (None, None)]
    rows += [(900, None), (901, ""), (902, " -\n.\x00!"), (903, "w7 " * 40_000), (904, "q" * 3000 + "-w8"), (905, "a-b_c'd\x7fe")]
    items = [(i, prose(rng.randrange(1, 25))) for i in range(25)]
    items += [(50, "w39"), (51, None), (52, ""), (53, "?!"), (54, "nowhere"), (55, "w39 w39 the"), (55, "w38 E d"), (None, "w37 42"), (56, "q" * 3000)]
    return rows, items


@pytest.mark.parametrize("shard_bytes,k", [(1 << 25, 20), (6000, 20), (6000, 3)])
def test_search_equals_scoring_everything(spark, corpus, shard_bytes, k):
    rows, items = corpus
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    for name in ("term", "query", "score", "shard", "rank", "key"):
        docs, asked = docs.withColumn(name, F.lit("clash")), asked.withColumn(name, F.lit("clash"))
    got = ranking.search(ranking.build_index(docs, shard_bytes), asked, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_search(rows, items, k)


def test_queries_in_blocks_and_nothing(spark, corpus, monkeypatch):
    rows, items = corpus
    docs, asked = spark.createDataFrame(rows[:200], DOCS), spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(ranking, "QUERY_TERMS", 10)
    assert sorted(map(tuple, ranking.search(ranking.build_index(docs), asked).collect()), key=str) == plain_search(rows[:200], items, 20)
    none = ranking.build_index(docs.where("1 = 0"))
    assert ranking.search(none, asked).count() == 0
    assert ranking.search(ranking.build_index(docs), asked.where("1 = 0")).count() == 0


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(ranking, "CHUNK_BYTES", 50)
    text = ("some words é漢 " * 40 + "x" * 300 + " end").encode()
    parts = list(ranking._slices(text))
    assert b"".join(parts) == text and len(parts) > 5
    assert [t for p in parts for t in terms_of(p.decode())] == terms_of(text.decode())


def test_blocks_are_rejected_before_they_are_unpacked():
    rng = np.random.default_rng(3)
    n_docs = 20_000
    lengths = rng.integers(5, 60, n_docs)
    m = 75 + 25 * lengths * n_docs // int(lengths.sum())
    m_of = lambda n: 75 + 25 * n.astype(np.int64) * n_docs // int(lengths.sum())
    common, rare = np.arange(0, n_docs, 2), rng.choice(n_docs, 60, replace=False)
    rare.sort()
    lists = []
    for docs in (common, rare):
        tf = rng.integers(1, 4, len(docs))
        term = np.zeros(len(docs), dtype=np.int64)
        lists.append(ranking._List(ranking._packed(term, np.array([0]), docs, tf, lengths)[0], m_of, m))
    found, scores = ranking._candidates([(lists[0], 700), (lists[1], 6000)], n_docs, 20, 0)
    assert len(lists[0].unpacked) < len(lists[0].header) and lists[0].whole is None
    full = np.zeros(n_docs, dtype=np.int64)
    for part, w in ((lists[0], 700), (lists[1], 6000)):
        docs, impacts = part.all()
        full[docs] += w * impacts
    assert (full[found] == scores).all() and np.sort(scores)[-20:].tolist() == np.sort(full)[-20:].tolist()


def test_sql_equals_the_query(spark):
    sf, duck = "/root/testdata/sf0.001", duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    want = duck.execute(f"SELECT item_id, rank, doc_id, score FROM ({queries.ORACLES['op12_ranked_search']})").fetchall()
    assert want and sorted(map(tuple, queries.QUERIES["op12_ranked_search"](spark, sf).collect())) == sorted(want)
