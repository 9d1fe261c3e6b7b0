"""The dataset source: round trips, commit log, merge on read, part bounds, filters, outcomes."""

import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from spotshare.sources import dataset

SCHEMA = "id BIGINT, name STRING, day DATE, at TIMESTAMP, price DECIMAL(10,2), rate DOUBLE, ok BOOLEAN"


@pytest.fixture(autouse=True)
def registered(spark):
    dataset.register(spark)


def write(df, path, mode="append", **options):
    df.write.format("spotshare").mode(mode).options(path=path, **options).save()


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def odd(spark, n=40):
    texts = ["", None, 'quo"te', "a,b", "line\nbreak\r\nx", " é漢 ", "\\", "NULL", "'"]
    return spark.range(n).select(
        "id", F.element_at(F.array(*(F.lit(t) for t in texts)), (F.col("id") % len(texts) + 1).cast("int")).alias("name"),
        F.expr("CASE WHEN id % 5 > 0 THEN date_add(DATE'2020-01-01', CAST(id AS INT)) END").alias("day"),
        F.expr("timestamp_micros(1580000000123456 + id)").alias("at"), F.expr("CAST(id / 7 AS DECIMAL(10,2))").alias("price"),
        F.expr("CASE WHEN id % 4 > 0 THEN id / 3.0D END").alias("rate"), F.expr("id % 2 = 0").alias("ok"))


def test_round_trip(spark, tmp_path):
    df = odd(spark)
    write(df.repartition(3), str(tmp_path), maxBytes="300")
    back = spark.read.format("spotshare").load(str(tmp_path))
    assert back.schema.simpleString() == spark.createDataFrame([], SCHEMA).schema.simpleString()
    assert rows_of(back) == rows_of(df)
    uri = spark.read.format("spotshare").options(path=f"file://{tmp_path}", taskBytes="400").load()
    assert rows_of(uri) == rows_of(df) and uri.rdd.getNumPartitions() > 3
    parts = dataset.manifests(str(tmp_path))[0]["parts"]
    assert [p["number"] for p in parts] == list(range(1, len(parts) + 1))
    assert all(p["bytes"] <= 300 or p["rows"] == 1 for p in parts) and sum(p["rows"] for p in parts) == 40
    assert all(os.path.getsize(f"{tmp_path}/{p['file']}") == p["bytes"] for p in parts)


def test_chain_of_operations(spark, tmp_path):
    path = str(tmp_path)
    frame = lambda *rows: spark.createDataFrame(list(rows), "id long, name string")
    write(frame((9, "gone")), path)
    write(frame((1, "a"), (2, "b"), (None, "n")), path, "overwrite")
    write(frame((2, "b again"), (3, "c")), path)
    write(frame((2, "B"), (4, "d"), (4, "d last"), (None, "other")).coalesce(1), path, operation="upsert", key="id")
    write(frame((2, "after")), path)
    want = [(1, "a"), (None, "n"), (3, "c"), (2, "B"), (4, "d last"), (None, "other"), (2, "after")]
    assert rows_of(dataset.resolved(spark, path)) == sorted(want, key=str)
    write(frame((1, "z")), path, operation="upsert", key="id", upload="named")
    write(frame((1, "not again")), path, operation="upsert", key="id", upload="named")
    assert (1, "z") in rows_of(dataset.resolved(spark, path)) and len(dataset.manifests(path)) == 6
    held = [f for folder, _, names in os.walk(f"{path}/uploads/named") for f in names]
    assert len(held) == sum(len(m["parts"]) for m in dataset.manifests(path) if m["upload"] == "named")
    with pytest.raises(Exception, match="different keys"):
        write(frame((1, "z")), path, operation="upsert", key="name")
        dataset.resolved(spark, path)


def test_uncommitted_parts_are_not_seen(spark, tmp_path):
    path = str(tmp_path)
    df = spark.range(0, 100, 1, 4).withColumn("name", F.lit("x"))
    write(df, path, upload="first")
    bad = df.withColumn("name", F.when(F.col("id") == 80, F.raise_error(F.lit("broken row")).cast("string")).otherwise("y"))
    with pytest.raises(PySparkException):
        write(bad, path, upload="second")
    (tmp_path / "uploads/first/000009-000000-stray.csv").write_text("1,stray\n")
    assert rows_of(dataset.resolved(spark, path)) == rows_of(df)
    found = {r["upload"]: (r["committed"], r["ok"], r["n_rows"]) for r in dataset.verdicts(spark, path).collect()}
    assert found == {"first": (True, True, 100), "second": (False, False, 0)}
    write(df.where("id < 10"), path, upload="some are empty")
    assert {r["upload"]: r["ok"] for r in dataset.verdicts(spark, path).collect()}["some are empty"]


def test_damaged_parts_fail(spark, tmp_path):
    path = str(tmp_path)
    write(spark.range(10).withColumn("name", F.lit("abc")), path)
    part = dataset.manifests(path)[0]["parts"][0]["file"]
    text = (tmp_path / part).read_text()
    (tmp_path / part).write_text(text.replace("abc", "abd", 1))
    with pytest.raises(Exception, match="not what was committed"):
        dataset.resolved(spark, path).collect()


def test_filters_leave_out_parts(spark, tmp_path):
    path = str(tmp_path)
    write(spark.range(0, 1000, 1, 4).withColumn("name", F.lit("x" * 20)), path, maxBytes="2000")
    for low, high, n in ((500, 500, 1), (991, None, 9), (None, 4, 5), (-5, -1, 0), (2000, None, 0)):
        found = dataset.rows_between(spark, path, "id", low, high)
        assert found.count() == n
        reader = dataset.DatasetReader({"path": path, "taskbytes": "1", "between": json.dumps({"id": [low, high]})}, found.schema)
        assert len(reader.partitions()) <= 2
    assert dataset.rows_between(spark, path, "name", "y").count() == 0
    assert len(dataset.DatasetReader({"path": path, "taskbytes": "1"}, found.schema).partitions()) > 10


def test_refused(spark, tmp_path):
    df = spark.range(3)
    for options in ({"operation": "merge"}, {"operation": "upsert"}, {"operation": "upsert", "key": "none"}):
        with pytest.raises(Exception, match="operation|key"):
            write(df, str(tmp_path), **options)
    write(df, str(tmp_path))
    with pytest.raises(Exception, match="other columns"):
        write(df.withColumn("more", F.lit(1)), str(tmp_path))
    with pytest.raises(Exception, match="no dataset"):
        spark.read.format("spotshare").load(f"{tmp_path}/none").collect()
    assert json.loads(dataset.manifests(str(tmp_path))[0]["metadata"])["objects"][0]["fields"][0]["name"] == "id"


def test_empty_upload(spark, tmp_path):
    write(spark.range(0), str(tmp_path))
    assert dataset.resolved(spark, str(tmp_path)).count() == 0
    assert dataset.verdicts(spark, str(tmp_path)).first()["ok"]
