"""The prefix trie of conversations against a plain trie."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from spotshare.llm import conversations, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_trie(rows):
    talks = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            talks.setdefault(conv, []).append(((turn is not None, turn or 0, digest), (role, text)))
    talks = {c: [t for _, t in sorted(v)] for c, v in talks.items()}
    built = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(c / 20) * 20 if c < 0 else c % 20
        built[c] = tuple(talks.get(c - base, [])[:h] + own[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = []
    for node, held in members.items():
        under = [k for k in members if k[: len(node)] == node]
        words = lambda k: len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        ends = ",".join(str(c) for c in sorted(held) if len(built[c]) == len(node))
        childless = [k for k in under if not any(len(o) == len(k) + 1 and o[:-1] == k for o in under)]
        out.append((
            min(held), len(node), min(members[node[:-1]]) if node else None, len(held), sum(len(k) == len(node) + 1 for k in under),
            len(childless), sum((len(members[k]) - 1) * words(k) for k in under), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def odd_rows():
    rng = random.Random(11)
    said = ["", "yes", "no way", "a b  c\td", "é 漢", None, "word " * 3]
    rows = []
    for c in [*range(0, 150), -5, -20, -41, 10**12, 10**12 + 3]:
        if c in (40, 60):  # two blocks without their first conversation
            continue
        for t in range(rng.choice([1, 1, 2, 2, 3, 4, 5])):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(said)))
    rows += [(7, None, "user", "first of all"), (7, None, "user", "first of all"), (8, 0, "user", "tie"), (8, 0, "user", "other tie"),
             (9, 0, None, None), (None, 0, "user", "nobody"), (None, None, None, None), (3, 1, "user", "x " * 50_000)]
    rows += [(200, t, "user", f"turn {t}") for t in range(700)]  # a conversation that spans tasks
    rows += [(201, t, "user", f"turn {t}") for t in range(650)]
    rng.shuffle(rows)
    return rows


def test_trie_equals_a_plain_trie(spark):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for name in ("node", "nth", "row", "depth", "digest", "words", "part", "base"):
        docs = docs.withColumn(name, F.lit("clash"))
    short = [r for r in rows if r[0] is None or r[0] < 200 or r[0] > 300]
    want = plain_trie(short)
    assert found(conversations.prefix_trie(docs.where("conv_id IS NULL OR conv_id < 200 OR conv_id > 300"))) == want
    long_ = [(c, t, r, x) for c, t, r, x in rows if c in (200, 201) and t < 120]
    assert found(conversations.prefix_trie(docs.where("conv_id IN (200, 201) AND turn < 120"))) == plain_trie(long_)


@pytest.mark.parametrize("tasks", [1, 7])
def test_trie_does_not_depend_on_the_number_of_tasks(spark, tasks):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    want = found(conversations.prefix_trie(docs))
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(conversations.prefix_trie(docs)) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len([r for r in want if r[1] == 700]) == 1


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert conversations.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    lonely = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(lonely, 0, "user", "taken away")]
    assert found(conversations.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == plain_trie(rows)


def test_sql_equals_the_query(spark):
    sf = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet')")
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    want = duck.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLES['op11_conversation_trie']})").fetchall()
    assert found(queries.QUERIES["op11_conversation_trie"](spark, sf)) == sorted(want, key=str)
