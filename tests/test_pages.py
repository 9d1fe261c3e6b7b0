"""Deep pages of a layout that is made once, and chains of pages."""

import json

import pytest
from pyspark.sql import functions as F, types as T

from spotshare.plans import layout
from spotshare.sources import files, pagechain


def files_read(df):
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().apply("numFiles").value()


def test_pages_of_a_layout(spark, tmp_path):
    path = f"{tmp_path}/laid"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.lit("x").alias("v")).unionAll(spark.range(300).select(F.lit(500), F.lit("hot")))
        layout.lay_out(df, ["k"], path)
        made = files.listed(spark, path)
        assert len({f.split("part=")[1].split("/")[0] for f in made}) == 8
        want = sorted([i for i in range(1000)] + [500] * 300)
        for offset, limit in ((0, 10), (640, 100), (1290, 50), (1300, 5), (123, 0), (0, 5000)):
            layout.lay_out(df, ["k"], path)
            rows = layout.page(spark, path, limit, offset)
            assert [(r["position"], r["k"]) for r in sorted(rows.collect(), key=lambda r: r["position"])] == list(enumerate(want))[offset : offset + limit]
            if 0 < limit <= 100 and offset < 1300:
                assert files_read(layout.page(spark, path, limit, offset)) <= 2
        assert files.listed(spark, path) == made
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    layout.lay_out(df.where("1 = 0"), ["k"], f"{tmp_path}/none")
    assert layout.page(spark, f"{tmp_path}/none", 10, 0).count() == 0
    for bad in (lambda: layout.page(spark, f"{tmp_path}/missing", 1, 0), lambda: layout.page(spark, path, -1, 0),
                lambda: layout.lay_out(df.withColumn("part", F.lit(1)), ["k"], f"{tmp_path}/clash")):
        with pytest.raises(ValueError):
            bad()


def chain(spark, rows):
    found = pagechain.ranked(spark.createDataFrame(rows, "url string, next string")).collect()
    return {r["url"]: r["page"] for r in found}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 8, 37])
def test_chains_are_ranked(spark, n):
    names = [f"/p/{(i * 17) % 41}" for i in range(n)]
    assert chain(spark, list(zip(names, [*names[1:], None]))[::-1]) == {name: i for i, name in enumerate(names)}


@pytest.mark.parametrize("rows,message", [
    ([("a", "b")], "lost: b"), ([("a", "b"), ("b", None), ("b", None)], "twice: b"), ([("a", "c"), ("b", "c"), ("c", None)], "follow two others: c"),
    ([("a", "b"), ("b", "a")], "circle: a, b"), ([("a", None), ("b", "c"), ("c", "b")], "circle: b, c"), ([("a", None), ("b", None)], "several pages: a, b"),
    ([(None, "a"), ("a", None)], "without an address"), ([("a", "a")], "circle: a")])
def test_broken_chains_are_named(spark, rows, message):
    with pytest.raises(pagechain.BrokenChain, match=message):
        chain(spark, rows)


def test_records_keep_their_order(spark, tmp_path):
    record = T.StructType.fromDDL("Id STRING, Name STRING")
    pages = [{"url": f"/p/{i}", "nextRecordsUrl": f"/p/{i + 1}" if i < 4 else None, "totalSize": 14,
              "records": [{"Id": 10 * i + k, "Name": f"n{k}", "attributes": {"type": "x"}} for k in range(3 if i < 4 else 2)]} for i in range(5)]
    for i, p in zip((3, 0, 4, 1, 2), pages):
        (tmp_path / f"{i}.json").write_text(json.dumps(p, indent=1))
    rows = pagechain.read_chain(spark, str(tmp_path), record, multi_line=True).orderBy("page", "place").collect()
    assert [(r["page"], r["place"], r["Id"]) for r in rows] == [(i, k, str(10 * i + k)) for i in range(5) for k in range(3 if i < 4 else 2)]
    (tmp_path / "4.json").write_text(json.dumps(pages[2] | {"records": []}))
    with pytest.raises(pagechain.BrokenChain, match="hold 11 records and state 14"):
        pagechain.read_chain(spark, str(tmp_path), record, multi_line=True)
