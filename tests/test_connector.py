import json

import pytest
from pyspark.sql import Row, functions as F, types as T

from spotshare.functions.csvtext import csv_header, csv_row
from spotshare.operators import conform, infer, merge, paging, sizing, status
from spotshare.plans import staging
from spotshare.sources import connector, export, metadata, options, records, tables


def texts(spark, **columns):
    names = list(columns)
    return spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"`{n}` STRING" for n in names))


# -- entities ------------------------------------------------------------------------------------------------------


def test_conform_types(spark):
    for name, entity in conform.ENTITIES.items():
        raw = spark.createDataFrame([tuple("1" for _ in entity.columns)], ", ".join(f"{conform.raw_name(entity, c)} STRING" for c in entity.columns))
        out = conform.conform(raw, name)
        assert tuple(out.columns) == entity.columns + tuple(entity.doubles)
        kinds = dict(out.dtypes)
        assert kinds["fecha_ini"] == kinds["fecha_fin"] == "timestamp"
        codes = {k for c, k in kinds.items() if c.startswith("cod_") or c == "flag"}
        assert codes <= ({"bigint"} if name == "cat_cadenas_n2" else {"int"})
    assert kinds["des_cadena_n"] == "string"
    assert len(conform.ENTITIES) == 12


def test_conform_values(spark):
    raw = texts(spark, NAME=["7", "7.0", "", "x", None], Activo__c=["a"] * 5, DES_EVENTO__c=["d"] * 5,
                FECHA_FIN__c=["2019-01-05T00:00:00.000Z", "2019-01-05", "n/a", "", None], fecha_ini__c=["2019-01-05"] * 5,
                INDICE__c=["1.5", "1", "", "x", None])
    out = conform.conform(raw, "cat_eventos").withColumn("fecha_fin", F.col("fecha_fin").cast("bigint")).collect()
    assert [r["cod_evento"] for r in out] == [7, 7, None, None, None]
    assert [r["fecha_fin"] for r in out] == [1546646400, 1546646400, None, None, None]
    assert [(r["indice"], r["indice_"]) for r in out] == [("1.5", 1.5), ("1", 1.0), ("", None), ("x", None), (None, None)]


# -- pages, records, schemas ---------------------------------------------------------------------------------------

PAGE = {"totalSize": 4, "done": False, "nextRecordsUrl": "/p/2", "records": [
    {"attributes": {"type": "A"}, "Id": 1, "Name": "x", "Owner": {"attributes": {"type": "U"}, "Name": "o", "Role": {"Name": "r"}}},
    {"attributes": {"type": "A"}, "Id": 2.5, "Name": None, "Owner": None, "Extra": True}]}


@pytest.mark.parametrize("field", [records.PLAIN, records.WRAPPED])
def test_pages_are_flattened(spark, tmp_path, field):
    for i in range(2):
        page = PAGE | {"done": i == 1} if field == records.PLAIN else {"results": {"records": PAGE["records"]}}
        (tmp_path / f"{i}.json").write_text(json.dumps(page, indent=1))
    flat = records.flatten(records.read_pages(spark, str(tmp_path), field, multi_line=True))
    assert sorted(flat.columns) == ["Extra", "Id", "Name", "Owner.Name", "Owner.Role.Name"]
    rows = [tuple(r) for r in flat.select("Id", "Name", "`Owner.Name`", "`Owner.Role.Name`", "Extra").collect()]
    assert sorted(rows, key=str) == sorted([("1", "x", "o", "r", None), ("2.5", None, None, None, "true")] * 2, key=str)


@pytest.mark.parametrize("broken", ["short", "unfinished", "truncated"])
def test_lost_pages_fail(spark, tmp_path, broken):
    pages = [PAGE, PAGE | {"done": broken != "unfinished", "records": PAGE["records"][: 1 if broken == "short" else 2]}]
    for i, page in enumerate(pages):
        text = json.dumps(page)
        (tmp_path / f"{i}.json").write_text(text[:-40] if broken == "truncated" and i else text)
    schema = T.StructType.fromDDL("totalSize STRING, done STRING, records ARRAY<STRUCT<Id: STRING>>")
    with pytest.raises(Exception, match="incomplete|[Mm]alformed|MALFORMED|FAILED_READ"):
        records.read_pages(spark, str(tmp_path), schema=schema).collect()


def test_inferred_types(spark):
    df = texts(
        spark, i=["1", "-2", "", None], l=["1", "3000000000", "", ""], d=["1", "2.5", "1e3", ""], wide=["1", "99999999999999999999", "", ""],
        t=["2019-01-05 10:00:00", "2019-1-5 1:00:00.5", "", ""], b=["true", "FALSE", "", ""], s=["x", "1", "", ""], mixed=["1", "true", "", ""],
        it=["1", "2019-01-05 10:00:00", "", ""], none=["", None, "", ""], one=["1", "t", "", ""], year=["2019", "2020", "", ""], dot=["1.0", "", "", ""])
    found = {r["column"]: r["type"] for r in infer.infer_columns(df).collect()}
    assert found == dict(i="int", l="bigint", d="double", wide="double", t="timestamp", b="boolean", s="string", mixed="string", it="string",
                         none="string", one="string", year="int", dot="double")
    dated = texts(spark, d=["05/01/2019", "06/01/2019"])
    assert infer.infer_columns(dated, "dd/MM/yyyy").first()["type"] == "timestamp"
    assert infer.infer_columns(dated).first()["type"] == "string"


def test_schema_applied(spark):
    schema = T._parse_datatype_string(
        "by TINYINT, sh SMALLINT, i INT, l BIGINT, f FLOAT, d DOUBLE, bo BOOLEAN, de DECIMAL(20,2), ts TIMESTAMP, da DATE, s STRING, gone STRING, gone_i INT")
    df = texts(spark, by=["1", ""], sh=["2", "x"], i=["3", "1.5"], l=["4", ""], f=["1.5", ""], d=["2.5", "abc"], bo=["TRUE", "1"],
               de=["1,234,567.89", ""], ts=["2019-01-05 10:00:00.5", "2019"], da=["2019-01-05", ""], s=["a b&c", ""])
    out = infer.apply_schema(df, schema, encode=["s"]).collect()
    assert out[0]["de"].to_eng_string() == "1234567.89" and out[0]["s"] == "a+b%26c" and out[0]["bo"] is True
    assert out[0]["ts"].microsecond == 500000 and str(out[0]["da"]) == "2019-01-05"
    assert tuple(out[1]) == (None,) * 10 + ("", "", None)
    with pytest.raises(ValueError, match="unsupported"):
        infer.apply_schema(df, T._parse_datatype_string("i ARRAY<INT>"))


def test_ragged_maps(spark):
    df = spark.createDataFrame([Row(m={"a": "1", "b": "x"}), Row(m={"a": "2.5"}), Row(m={"c": "true"}), Row(m={})], "m MAP<STRING, STRING>")
    assert sorted(r[0] for r in infer.union_of_keys(df, "m").collect()) == ["a", "b", "c"]
    schema = infer.to_schema(infer.infer_map(df, "m"))
    assert schema.simpleString() == "struct<a:double,b:string,c:boolean>"
    assert [tuple(r) for r in infer.apply_schema(df, schema, "m").collect()] == [(1.0, "x", None), (2.5, "", None), (None, "", True), (None, "", None)]


def test_csv_batches(spark, tmp_path):
    path = str(tmp_path / "b")
    rows = spark.createDataFrame([(1, 'a "q", b\nc', 1), (2, " pad ", 1), (3, "r\r\ns", 2), (4, "no", 3)], "id INT, v STRING, batch_id INT")
    export.export_batches(rows, path, by="batch_id")
    states = spark.createDataFrame([(1, "Completed"), (2, "Completed"), (3, "Failed")], "batch_id INT, state STRING")
    schema = T._parse_datatype_string("id INT, v STRING, batch_id INT")
    out = records.read_csv_batches(spark, path, states, schema).select("id", "v").collect()
    assert sorted(tuple(r) for r in out) == [(1, 'a "q", b c'), (2, " pad "), (3, "r s")]
    inferred = records.read_csv_batches(spark, path, states, infer=True)
    assert dict(inferred.dtypes)["id"] == "int"
    # an unfinished batch is not opened at all; another order of columns and a broken row of a finished one fail
    (tmp_path / "b" / "batch_id=3" / "bad.csv").write_text('"id\n"""')
    assert records.read_csv_batches(spark, path, states, schema).count() == 3
    assert records.read_csv_batches(spark, path, states.where("false"), schema).count() == 0
    (tmp_path / "b" / "batch_id=2" / "swapped.csv").write_text("v,id\nx,9\n")
    with pytest.raises(Exception):
        records.read_csv_batches(spark, path, states, schema).collect()


def test_upsert_checks_keys_and_names(spark):
    target = spark.createDataFrame([("a", 1)], "k STRING, v INT")
    twice = spark.createDataFrame([("x", 1), ("x", 2)], "k STRING, v INT")
    for empty in (target.where("1=0"), spark.createDataFrame([], target.schema)):
        with pytest.raises(Exception, match="not unique"):
            merge.upsert(empty, twice, "k").collect()
    source = spark.createDataFrame([("a", 5), ("b", 6)], "K STRING, V INT")
    out = merge.upsert(target, source, "K")
    assert out.columns == ["k", "v"] and sorted(map(tuple, out.collect())) == [("a", 5), ("b", 6)]


def test_month_is_replaced_without_a_catalog_entry(spark, tmp_path):
    path = str(tmp_path / "share")
    spark.createDataFrame([(1, "2019-01"), (2, "2019-02")], "v INT, fecha_part STRING").write.partitionBy("fecha_part").parquet(path)
    tables.save_table(spark.createDataFrame([(9, "2019-02")], "v INT, fecha_part STRING"), "loose_share", path, partition_by="fecha_part", replace_partitions=True)
    assert sorted(map(tuple, spark.table("loose_share").collect())) == [(1, "2019-01"), (9, "2019-02")]
    tables.save_table(spark.createDataFrame([(7, "2019-01")], "v INT, fecha_part STRING"), "loose_share", str(tmp_path / "other"), partition_by="fecha_part", replace_partitions=True)
    assert sorted(map(tuple, spark.table("loose_share").collect())) == [(7, "2019-01"), (9, "2019-02")]


def test_batch_files_keep_the_bound_in_folders(spark, tmp_path):
    rows = spark.range(2000).selectExpr("id", "id % 2 AS part", "repeat('x', 20) AS v")
    export.export_batches(rows, str(tmp_path / "bound"), max_bytes=4000, by="part")
    sizes = [f.stat().st_size for f in (tmp_path / "bound").rglob("*.csv")]
    assert max(sizes) <= 4000 + 20 and len(sizes) > 4


# -- paging --------------------------------------------------------------------------------------------------------


def test_pages(spark):
    df = spark.range(0, 2500, 1, 7).withColumn("key", (F.col("id") * 7919) % 2500)
    out = paging.pages(df, ["key"], 1000).collect()
    assert sorted((r["key"], r["position"]) for r in out) == [(i, i) for i in range(2500)]
    assert {r["page"] for r in out if r["last_page"]} == {2}
    assert [sum(r["page"] == p for r in out) for p in range(3)] == [1000, 1000, 500]
    assert sorted(r["key"] for r in paging.page(df, ["key"], 10, 2495).collect()) == [2495, 2496, 2497, 2498, 2499]
    with pytest.raises(ValueError):
        paging.pages(df, ["key"], 0)


def test_chunks(spark):
    df = spark.createDataFrame([(k,) for k in (9007199254740993, 9007199254740994, 9007199254741093, 9007199254741192)], "k BIGINT")
    assert sorted(r["chunk_id"] for r in paging.key_chunks(df, "k", 100).collect()) == [0, 0, 1, 1]
    ranges = {r["chunk_id"]: (r["n_rows"]) for r in paging.chunk_ranges(df, "k", 100).collect()}
    assert ranges == {0: 2, 1: 2}


# -- CSV and exports -----------------------------------------------------------------------------------------------


def test_csv_rows(spark):
    df = spark.sql("""SELECT 1 AS i, 'a"b' AS s, 'x,y' AS c, 'p\nq' AS n, CAST(NULL AS STRING) AS z, '' AS e, 1.5D AS d, true AS b,
      TIMESTAMP '2019-01-05 00:00:00' AS t, CAST(2.50 AS DECIMAL(5,2)) AS m""")
    assert df.select(csv_row(df)).first()[0] == '1,"a""b","x,y","p\nq",,,1.5,true,2019-01-05 00:00:00.0,2.50'
    assert csv_header(df) == "i,s,c,n,z,e,d,b,t,m"


def test_sizes(spark):
    df = spark.range(1000).selectExpr("id", "'ñ' AS v")
    size = sizing.table_size(df).first()
    assert size["n_rows"] == 1000 and size["n_bytes"] == sum(len(str(i)) + 1 + 2 for i in range(1000))
    assert [sizing.bundle_count(n, 10) for n in (0, 10, 11, 19, 20, 35)] == [1, 1, 2, 2, 3, 4]
    assert sizing.size_repartition(df, 1000).rdd.getNumPartitions() == size["n_bytes"] // 1000 + 1
    assert tuple(sizing.table_size(df.limit(0)).first()) == (0, 0)


def test_dataset_export(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b\n"), (2, None)], "id BIGINT, v STRING")
    path = str(tmp_path / "d")
    export.export_dataset(df, path, "ds")
    assert (tmp_path / "d" / "data" / "_SUCCESS").exists()
    back = spark.read.schema(df.schema).options(multiLine=True, quote='"', escape='"').csv(f"{path}/data").collect()
    assert sorted(tuple(r) for r in back) == [(1, "a,b\n"), (2, None)]
    text = spark.read.text(f"{path}/metadata", wholetext=True).first()[0]
    assert [f["type"] for f in json.loads(text)["objects"][0]["fields"]] == ["Numeric", "Text"]


def test_metadata():
    field = T.StructField("c", T.DoubleType())
    assert metadata.field_metadata(field, "ds") | {} == {
        "description": "", "fullyQualifiedName": "ds.c", "label": "c", "name": "c", "isSystemField": False, "isUniqueId": False,
        "isMultiValue": False, "type": "Numeric", "precision": 18, "defaultValue": 0, "scale": 2}
    own = {"double": {"type": "Numeric", "precision": 9, "scale": 7}}
    with pytest.raises(ValueError, match="scale"):
        metadata.field_metadata(field, "ds", own)
    assert metadata.field_metadata(T.StructField("a", T.ArrayType(T.StringType())), "ds")["type"] == "Text"
    assert metadata.field_metadata(T.StructField("t", T.DateType()), "ds")["format"] == "yyyy-MM-dd"


# -- merges and tables ---------------------------------------------------------------------------------------------


def test_merges(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (None, "n", 9)], "k INT, v STRING, w INT")
    source = spark.createDataFrame([(2, None), (3, "c"), (None, "m")], "k INT, v STRING")

    def out(df):
        return sorted((tuple(r) for r in df.collect()), key=str)

    assert out(merge.insert(target, source)) == sorted([(1, "a", 1), (2, "b", 2), (None, "n", 9), (2, None, None), (3, "c", None), (None, "m", None)], key=str)
    assert out(merge.update(target, source, "k")) == sorted([(1, "a", 1), (2, None, 2), (None, "n", 9)], key=str)
    assert out(merge.upsert(target, source, "k")) == sorted([(1, "a", 1), (2, None, 2), (None, "n", 9), (3, "c", None), (None, "m", None)], key=str)
    for apply in (merge.update, merge.upsert):
        with pytest.raises(Exception, match="not unique"):
            apply(target, source.union(source), "k").collect()
    with pytest.raises(ValueError):
        merge.apply(target, source, "delete", "k")


def test_write_modes():
    assert [tables.dataset_mode(m, u) for m, u in (("append", True), ("Overwrite", False), ("append", False), ("ignore", False))] == ["upsert", "overwrite", "append", "append"]
    assert [tables.object_operation(m, u) for m, u in (("append", True), ("overwrite", False), ("Append", False), (None, False))] == ["upsert", "update", "insert", "insert"]


def test_month_table(spark):
    path = staging.new_folder(spark, "t")
    name = "months_" + path[-32:]
    first = spark.createDataFrame([(1, "2019-01"), (2, "2019-02")], "v INT, fecha_part STRING")
    tables.save_table(first, name, path, partition_by="fecha_part")
    tables.save_table(spark.createDataFrame([(9, "2019-02")], "v INT, fecha_part STRING"), name, path, partition_by="fecha_part", replace_partitions=True)
    read = tables.read_table(spark, {"share": name}, "share")
    assert sorted(tuple(r) for r in read.collect()) == [(1, "2019-01"), (9, "2019-02")]
    tables.save_table(first, name, path, partition_by="fecha_part")
    assert spark.table(name).count() == 2
    assert "PartitionFilters: [isnotnull(fecha_part" in spark.table(name).where("fecha_part = '2019-01'")._jdf.queryExecution().executedPlan().toString()
    spark.sql(f"DROP TABLE {name}")
    assert tables.read_table(spark, {"share": path}, "share").count() == 2
    assert tables.register_view(first) == "fctd_share_grps" and spark.table("fctd_share_grps").count() == 2


# -- statuses and options ------------------------------------------------------------------------------------------


def test_statuses(spark):
    batches = spark.createDataFrame(
        [(1, "Completed", 0), (1, "InProgress", 0), (1, "Failed", 0), (2, "Completed", 3), (2, "Queued", 0), (3, "Queued", 0), (4, "Completed", 0)],
        "job_id INT, state STRING, number_records_failed BIGINT")
    found = {r["job_id"]: (r["status"], r["ok"]) for r in status.job_status(batches).collect()}
    assert found == {1: ("failed", False), 2: ("failed", False), 3: ("pending", False), 4: ("complete", True)}
    states = ["Completed", "CompletedWithWarnings", "NotProcessed", "Other", None, "Failed", "New", "Queued", "InProgress"]
    df = spark.createDataFrame([(s,) for s in states], "s STRING")
    assert [r[0] for r in df.select(status.upload_status(F.col("s"))).collect()] == ["ok"] * 5 + ["failed"] + ["pending"] * 3


def test_options():
    assert options.exactly_one({"a": "x"}, "a", "b") == "a"
    for bad in ({}, {"a": "x", "b": "y"}):
        with pytest.raises(ValueError):
            options.exactly_one(bad, "a", "b")
    assert options.flag({"f": "true"}, "f") is True and options.flag({}, "f") is False
    with pytest.raises(ValueError, match="true or false"):
        options.flag({"f": "yes"}, "f")
    with pytest.raises(ValueError, match="valid integer"):
        options.integer({"n": "x"}, "n")
    with pytest.raises(ValueError, match="must not be empty"):
        options.required({}, "object", "for bulk")


def test_connector(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "0.json").write_text(json.dumps(PAGE | {"totalSize": 2, "done": True}))
    base = {"recordPages": str(pages)}
    assert dict(connector.load(spark, base).dtypes)["Id"] == "string"
    assert dict(connector.load(spark, base | {"inferSchema": "true"}).dtypes)["Id"] == "double"
    schema = T._parse_datatype_string("Id DOUBLE, Missing INT")
    assert sorted(tuple(r) for r in connector.load(spark, base, schema).collect()) == [(1.0, None), (2.5, None)]
    with pytest.raises(ValueError):
        connector.load(spark, base | {"resultPages": "x"})
    with pytest.raises(ValueError, match="object"):
        connector.load(spark, base | {"bulk": "true"})
    with pytest.raises(ValueError, match="metadata"):
        connector.save(connector.load(spark, base), {"dataset": "d", "path": "x", "upsert": "true"})
    target = spark.createDataFrame([("1", "old")], "Id STRING, Name STRING")
    source = connector.load(spark, base).select("Id", "Name")
    assert sorted(tuple(r) for r in connector.save(source, {"object": "o", "upsert": "true"}, target=target).collect()) == [("1", "x"), ("2.5", "")]
    assert connector.save(source, {"object": "o"}, "overwrite", target).count() == 1
    assert connector.save(source, {"object": "o"}, "append", target).count() == 3
    connector.save(source, {"dataset": "d", "path": str(tmp_path / "ds")})
    assert (tmp_path / "ds" / "data" / "_SUCCESS").exists()


def test_broadcast_needs_a_proven_size(spark):
    df = spark.range(100).selectExpr("id AS __code")
    def hinted(side):
        return side._jdf.queryExecution().logical().toString()
    assert "broadcast" in hinted(staging.join_side(df))
    assert "merge" in hinted(staging.join_side(df, max_rows=99))
    assert "merge" in hinted(staging.join_side(df, max_bytes=100))


class _Session:
    """Settings of a session."""

    def __init__(self, **conf):
        self.conf = {k.replace("_", "."): v for k, v in conf.items()}


def test_shared_folder():
    warehouse = {"spark_sql_warehouse_dir": "/w/house"}
    assert staging.shared_folder(_Session(spark_checkpoint_dir="hdfs:///shared/", **warehouse)) == "hdfs:///shared"
    assert staging.shared_folder(_Session(**warehouse)) == "/w/house"


def test_bundles_shrink_without_a_shuffle(spark):
    df = spark.range(0, 4000, 1, 16).withColumn("x", F.expr("repeat('a', 20)")).withColumn("nothing", F.lit(None))
    few = sizing.size_repartition(df, 40_000)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Range (" not in plan and "Coalesce" in plan
    assert few.rdd.getNumPartitions() == sizing.bundle_count(sizing.table_size(df).first()["n_bytes"], 40_000) > 1
    many = sizing.size_repartition(df, 1000)
    assert "Exchange" in many._jdf.queryExecution().executedPlan().toString() and many.rdd.getNumPartitions() > 60
    assert few.count() == many.count() == 4000
    drawn = sizing.size_repartition(df.withColumn("r", F.rand()), 40_000)
    assert sorted(drawn.collect()) == sorted(drawn.collect())


def test_options_reach_commit_log_and_stored_tables(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "Id long, name string")
    given = {"dataset": "d", "path": f"{tmp_path}/d", "commitLog": "true"}
    connector.save(rows, given)
    for _ in range(2):
        connector.save(spark.createDataFrame([(2, "B"), (3, "c")], rows.schema), given | {"upsert": "true", "metadata": "{}", "upload": "u"})
    back = connector.load(spark, {"committed": f"{tmp_path}/d"})
    assert sorted(map(tuple, back.collect())) == [(1, "a"), (2, "B"), (3, "c")]
    connector.save(rows, given | {"upload": "again"}, "overwrite")
    assert connector.load(spark, {"committed": f"{tmp_path}/d"}).count() == 2
    with pytest.raises(ValueError):
        connector.load(spark, {"committed": f"{tmp_path}/d", "recordPages": "x"})
    kept = {"object": "o", "path": f"{tmp_path}/o", "partitionBy": "name"}
    connector.save(rows, kept | {"batch": "first"})
    new = spark.createDataFrame([(2, "a"), (9, "z")], rows.schema)
    for _ in range(2):
        table = connector.save(new, kept | {"batch": "second", "upsert": "true"})
    assert sorted(map(tuple, table.collect())) == [(1, "a"), (2, "a"), (9, "z")]
    with pytest.raises(ValueError):
        connector.save(rows, kept)
