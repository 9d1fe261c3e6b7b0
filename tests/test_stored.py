"""Batches applied to stored tables: what is rewritten, retries, failures on the way."""

import pytest
from pyspark.sql import functions as F

from spotshare.sources import files, stored

ROWS = "id long, name string, month string"


@pytest.fixture
def table(spark, tmp_path):
    path = f"{tmp_path}/t a"  # names with spaces, and values that are escaped in folder names
    rows = [(i, f"n{i}", f"2020-0{i % 3 + 1}") for i in range(12)] + [(50, "odd", "a b:c%"), (51, "none", None)]
    assert stored.apply_batch(spark, path, spark.createDataFrame(rows, ROWS), "insert", "id", "base", "month")
    return path


def rows_of(spark, path):
    return sorted(map(tuple, stored.read(spark, path).collect()), key=str)


def names(spark, path):
    return {files.below(spark, path, f) for f in files.listed(spark, path)}


def test_upsert_rewrites_only_its_partitions(spark, table):
    before = names(spark, table)
    assert {n.split("/")[1].split("_")[0] for n in before} == {"base"}
    source = spark.createDataFrame([(0, "new", "2020-01"), (99, "fresh", "2020-09")], ROWS)
    assert stored.apply_batch(spark, table, source, "upsert", "id", "b1")
    after = names(spark, table)
    assert {n for n in before if "2020-01" not in n} == {n for n in after if "/base_" in n}
    want = [(0, "new", "2020-01"), (99, "fresh", "2020-09")] + [(i, f"n{i}", f"2020-0{i % 3 + 1}") for i in range(1, 12)]
    assert rows_of(spark, table) == sorted(want + [(50, "odd", "a b:c%"), (51, "none", None)], key=str)
    assert not stored.apply_batch(spark, table, source.withColumn("name", F.lit("not read")), "upsert", "id", "b1")
    assert names(spark, table) == after and stored.batches(spark, table) == {"base": "insert", "b1": "upsert"}


def test_update_moves_rows_and_empties_partitions(spark, table):
    source = spark.createDataFrame([(50, "2020-02"), (51, "2020-02"), (1000, "2020-07")], "id long, month string")
    assert stored.apply_batch(spark, table, source, "update", "id", "b1")
    found = rows_of(spark, table)
    assert (50, "odd", "2020-02") in found and (51, "none", "2020-02") in found and len(found) == 14
    assert not any("=a b" in n or "HIVE_DEFAULT" in n for n in names(spark, table))
    only_names = spark.createDataFrame([(50, "renamed")], "id long, name string")
    assert stored.apply_batch(spark, table, only_names, "update", "id", "b2")
    assert (50, "renamed", "2020-02") in rows_of(spark, table)


@pytest.mark.parametrize("fails_at", ["move", "delete", "put_text"])
@pytest.mark.parametrize("operation", ["insert", "upsert"])
def test_failed_batch_is_taken_up(spark, table, monkeypatch, fails_at, operation):
    source = spark.createDataFrame([(100, "a", "2020-01"), (101, "b", "2020-02"), (102, "c", "2020-03")], ROWS)
    real, calls = getattr(files, fails_at), []

    def broken(session, path, *rest):
        calls.append(path)
        if (fails_at == "move" and len(calls) == 2) or (fails_at == "delete" and path.endswith("rows")) or (fails_at == "put_text" and path.endswith("done")):
            raise OSError("lost")
        return real(session, path, *rest)

    monkeypatch.setattr(files, fails_at, broken)
    with pytest.raises(OSError):
        stored.apply_batch(spark, table, source, operation, "id", "b1")
    monkeypatch.setattr(files, fails_at, real)
    assert stored.apply_batch(spark, table, source, operation, "id", "b1")
    found = rows_of(spark, table)
    assert len(found) == 17 and len(set(found)) == 17


def test_failure_before_the_plan_changes_nothing(spark, table):
    before = rows_of(spark, table), names(spark, table)
    twice = spark.createDataFrame([(1, "x", "2020-01"), (1, "y", "2020-01")], ROWS)
    with pytest.raises(Exception, match="not unique"):
        stored.apply_batch(spark, table, twice, "upsert", "id", "b1")
    assert (rows_of(spark, table), names(spark, table)) == before
    assert stored.apply_batch(spark, table, twice.limit(1), "upsert", "id", "b1")


def test_located_reads_only_named_partitions(spark, table):
    source = spark.createDataFrame([(0, "new", "2020-01")], ROWS)
    assert stored.apply_batch(spark, table, source, "upsert", "id", "b1", located=True)
    assert (0, "new", "2020-01") in rows_of(spark, table) and len(rows_of(spark, table)) == 14
    rows = stored.read(spark, table).where(stored._among("month", ["2020-01", None]))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((month" in plan and "PushedFilters: []" in plan


def test_refused_batches(spark, table, tmp_path):
    source = spark.createDataFrame([(1, "x", "2020-01")], ROWS)
    for bad in (dict(operation="merge"), dict(batch="a/b"), dict(partition_by="name"), dict(source=source.withColumn("more", F.lit(1))),
                dict(source=source.drop("month")), dict(source=source.drop("id"))):
        asked = dict(path=table, source=source, operation="upsert", key="id", batch="b1") | bad
        with pytest.raises(ValueError):
            stored.apply_batch(spark, **asked)
    with pytest.raises(ValueError):
        stored.apply_batch(spark, f"{tmp_path}/none", source, "update", "id", "b1", "month")
    with pytest.raises(ValueError):
        stored.read(spark, f"{tmp_path}/none")
