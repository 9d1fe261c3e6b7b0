"""Key chunks of equal depth: whole, balanced, read by range, taken up after a failure."""

import pytest
from pyspark.sql import functions as F

from spotshare.plans import chunks
from spotshare.sources import files


def counted(df, key, plan):
    return [chunks.rows_of(df, key, c).count() for c in plan]


@pytest.mark.parametrize("key,loose", [("id * id", 1.02), ("id", 1.02), ("CASE WHEN id % 3 = 0 THEN 500000 ELSE id END", 1.1), ("-id * 1000003", 1.02)])
def test_chunks_are_balanced_and_whole(spark, key, loose):
    df = spark.range(40_000).select(F.expr(key).alias("key"), F.col("id").alias("row")).cache()
    plan = chunks.plan(df, "key", 2000)
    sizes = counted(df, "key", plan)
    assert sum(sizes) == 40_000 and len(plan) >= 20
    assert max(sizes) <= 2000 * loose
    assert df.select(F.count_distinct("row")).first()[0] == 40_000


def test_chunks_hold_every_row_once(spark):
    rows = [(k, i) for i, k in enumerate([None] * 30 + [5] * 40 + [-(2**63)] * 3 + [2**63 - 1] * 25 + list(range(100)))]
    df = spark.createDataFrame(rows, "key long, row long").unionAll(spark.createDataFrame([(7, 1), (7, 1)], "key long, row long"))
    plan = chunks.plan(df, "key", 10)
    found = [tuple(r) for c in plan for r in chunks.rows_of(df, "key", c).collect()]
    assert sorted(found, key=str) == sorted(map(tuple, df.collect()), key=str)
    assert chunks.plan(df.where("1 = 0"), "key", 10) == []
    assert len(chunks.plan(df, "key", 10**6)) == 2
    small = df.select(F.expr("CAST(row % 100 AS TINYINT)").alias("key"), "row")
    assert sum(counted(small, "key", chunks.plan(small, "key", 30))) == df.count()
    for bad in (("key", 0), ("text", 5)):
        with pytest.raises(ValueError):
            chunks.plan(df.withColumn("text", F.lit("a")), *bad)


def test_ranges_reach_the_scan(spark, tmp_path):
    spark.range(1000).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    text = chunks.rows_of(df, "id", chunks.plan(df, "id", 100)[4])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id," in text and "LessThanOrEqual(id," in text


def test_extraction_goes_on(spark, tmp_path, monkeypatch):
    df, path = spark.range(1000).withColumn("x", F.col("id") * 2), f"{tmp_path}/out"
    real = chunks.rows_of

    def broken(frame, key, chunk):
        if chunk.low is not None and chunk.low > 500:
            raise OSError("lost")
        return real(frame, key, chunk)

    monkeypatch.setattr(chunks, "rows_of", broken)
    with pytest.raises(OSError):
        chunks.extract(df, "id", 100, path)
    with pytest.raises(ValueError, match="not finished"):
        chunks.read(spark, path, df.schema)
    before = set(files.listed(spark, path))
    monkeypatch.setattr(chunks, "rows_of", real)
    plan = chunks.extract(df, "id", 100, path)
    assert len(plan) == 10 and before and before <= set(files.listed(spark, path))
    back = chunks.read(spark, path, df.schema)
    assert sorted(map(tuple, back.select("id", "x").collect())) == [(i, 2 * i) for i in range(1000)]
    assert {r["chunk_id"] for r in back.select("chunk_id").distinct().collect()} == set(range(10))
    with pytest.raises(ValueError, match="begun"):
        chunks.extract(df, "id", 50, path)
