"""What the driver holds of a plan's lookup sides."""

import random

import pytest

from pyspark.sql import functions as F

from spotshare.operators import intervals
from spotshare.operators.intervals import last_match
from spotshare.plans import share_job, staging
from workload import share
from workload.views import view

DAY = 86400
SF = "/root/testdata/sf0.001"


def strategies(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_sides_of_a_plan_share_the_bound(spark):
    df = spark.range(100).selectExpr("id AS __code")
    def hint(side):
        return "broadcast" if "broadcast" in side._jdf.queryExecution().logical().toString() else "merge"
    assert hint(staging.join_side(df)) == "broadcast"
    each = 100 * (16 + staging.TABLE_ROW_BYTES)
    with staging.one_plan(2 * each):
        assert [hint(staging.join_side(d)) for d in (df, df, df.limit(1))] == ["broadcast", "broadcast", "merge"]
    with staging.one_plan(2 * each - 1):
        assert [hint(staging.join_side(d)) for d in (df, df, df.limit(1))] == ["broadcast", "merge", "broadcast"]
    assert hint(staging.join_side(df)) == "broadcast"


def test_share_table_is_one_plan(spark, monkeypatch):
    """All sides of the table draw on the same bytes: with none left, none is broadcast."""
    monkeypatch.setattr(share_job, "one_plan", lambda: staging.one_plan(0), raising=False)
    out = share_job.share_table(view(spark, SF, "fcts_mercado_lineal"), share.dimensions(spark, SF), policy="any", children_channel=3)
    assert "strategy=broadcast" not in strategies(out)


def test_a_long_segment_is_broadcast_once(spark, monkeypatch):
    """100 keys that are valid for 2,400 days are 100 rows of the side, not one for each 512 days."""
    monkeypatch.setattr(staging.join_side, "__defaults__", (100, staging.MAX_BROADCAST_BYTES))
    dim = spark.range(100).selectExpr("id AS k", "id AS ord", "0L AS fecha_ini", f"2400L * {DAY} AS fecha_fin")
    fact = spark.range(100).selectExpr("id AS k", f"(id * 30 - 300) * {DAY} AS fecha_dia")
    out = last_match(fact, dim, {"k": "k"}, {"v": F.col("ord")}, "w")
    assert "strategy=broadcast" in strategies(out)
    assert {r["k"]: r["w"] and r["w"]["v"]["v"] for r in out.collect()} == {k: k if 0 < k * 30 - 300 < 2400 else None for k in range(100)}


def test_many_blocks_are_not_broadcast(spark, tmp_path):
    """A small file of 20,000 rows makes 400,000 blocks, which the planner takes for as small as the file."""
    spark.range(20000).selectExpr("id AS k", "id AS ord", f"id % 9 * {DAY} AS fecha_ini", f"(2000 + id % 300) * {DAY} AS fecha_fin").write.parquet(f"{tmp_path}/dim")
    dim = spark.read.parquet(f"{tmp_path}/dim")
    out = intervals.resolve(dim, {"k": F.col("k")}, {"ord": F.col("ord")})
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.where("__first <= 1000 AND __until > 1000 AND __bucket = 1").count() == 20000
    few = intervals.resolve(dim.where("k < 100"), {"k": F.col("k")}, {"ord": F.col("ord")})
    assert "strategy=merge" not in strategies(few)


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("whole", [1000, 64])
def test_whole_and_spread_segments_equal_a_loop(spark, monkeypatch, whole, broadcast):
    """Keys of one and of many segments, some over several buckets, NULL keys, doubled rows and gaps."""
    monkeypatch.setattr(intervals, "WHOLE_SEGMENTS", whole, raising=False)
    if not broadcast:
        monkeypatch.setattr(staging.join_side, "__defaults__", (0, 0))
    rng = random.Random(11)
    rows = [(rng.choice([0, 0, 0, 1, 2, None]), (a := rng.randrange(3000)) * DAY, (a + rng.choice([1, 2, 9, 700, 1800])) * DAY, i) for i in range(90)]
    rows += [(3, 10 * DAY, 3000 * DAY, 90), (3, 10 * DAY, 3000 * DAY, 90)]
    days = [(k, d * DAY) for k in (0, 1, 2, 3, 4, None) for d in (-1, 0, 10, 11, *range(40, 4900, 83), 511, 512, 513)]
    dim = spark.createDataFrame(rows, "k BIGINT, fecha_ini BIGINT, fecha_fin BIGINT, ord BIGINT")
    fact = spark.createDataFrame(days, "k BIGINT, fecha_dia BIGINT")
    out = last_match(fact, dim, {"k": "k"}, {"v": F.col("ord")}, "w")
    assert ("strategy=broadcast" in strategies(out)) == broadcast
    assert len({day for r in rows if r[0] == 0 for day in r[1:3]}) > 64
    assert ("__bucket" in strategies(out)) == (not broadcast or whole == 64)
    found = sorted(((r["k"], r["fecha_dia"], r["w"] and r["w"]["v"]["v"]) for r in out.collect()), key=str)
    want = [(k, d, max((r[3] for r in rows if k is not None and r[0] == k and r[1] < d < r[2]), default=None)) for k, d in days]
    assert found == sorted(want, key=str)
