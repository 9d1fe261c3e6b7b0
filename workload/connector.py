"""Connector queries: entities, records, schemas, pages, CSV, merges, tables, statuses; each with its SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from spotshare.functions.csvtext import csv_header, csv_row
from spotshare.functions.temporal import current_month
from spotshare.operators import conform as conform_ops, infer, merge, paging, sizing, status
from spotshare.plans import chunks, layout
from spotshare.plans.staging import new_folder
from spotshare.sources import connector, dataset, export, pagechain, records, stored, tables
from workload.share import query
from workload.views import TABLES, table, view

# -- dimension entities --------------------------------------------------------------------------------------------

# Entity: (driver table, key column) the raw text rows are derived from.
RAW_FROM = {
    "linea_negocio": ("part", "p_partkey"), "agrup_cadenas": ("supplier", "s_suppkey"), "parametros": ("part", "p_partkey"),
    "coeficientes": ("customer", "c_custkey"), "configuraciones": ("orders", "o_orderkey"), "eventos": ("customer", "c_custkey"),
    "cat_cadenas_n2": ("supplier", "s_suppkey"), "cat_cadenas_n1": ("supplier", "s_suppkey"), "cat_cadenas_n0": ("part", "p_partkey"),
    "cat_eventos": ("events", "event_id"), "cat_coeficientes": ("customer", "c_custkey"), "cat_nuevas_cadenas": ("orders", "o_orderkey"),
}
_CODE = """CASE WHEN {k} % 6 = {i} % 6 THEN '' WHEN {k} % 11 = {i} % 11 THEN concat(CAST({k} % 97 + {i} AS STRING), '.0')
  WHEN {k} % 13 = {i} % 13 THEN 'n/a' WHEN {k} % 17 = 5 THEN '99999999999' ELSE CAST({k} % 97 + {i} AS STRING) END"""
_DAY = """CASE WHEN {k} % 8 = {i} % 8 THEN NULL WHEN {k} % 9 = {i} % 9 THEN 'n/a'
  WHEN {k} % 5 = 0 THEN concat('2001-0', CAST({k} % 9 + 1 AS STRING), '-15T00:00:00.000Z')
  ELSE concat('1999-1', CAST({k} % 3 AS STRING), '-0', CAST({k} % 9 + 1 AS STRING)) END"""
_TEXT = "CASE WHEN {k} % 19 = {i} % 19 THEN NULL ELSE concat('texto ', CAST({k} % 50 + {i} AS STRING), '.5') END"
_NUMBER_TEXT = "CASE WHEN {k} % 7 = 0 THEN 'x' ELSE concat(CAST({k} % 50 AS STRING), '.5') END"


def _raw_text(column: str, index: int, key: str) -> str:
    if column.startswith("fecha_"):
        return _DAY.format(k=key, i=index)
    if column.startswith("cod_") or column == "flag":
        return _CODE.format(k=key, i=index)
    return (_NUMBER_TEXT if column == "indice" else _TEXT).format(k=key, i=index)


def raw_sql(name: str) -> str:
    """Raw text rows of an entity: suffixed names in mixed case, blanks, bad codes and bad days."""
    entity = conform_ops.ENTITIES[name]
    source, key = RAW_FROM[name]
    columns = [
        f"{_raw_text(c, i, key)} AS {'Name' if c == entity.named else c.upper() + '__c'}" for i, c in enumerate(entity.columns)
    ]
    return f"SELECT {', '.join(columns)} FROM {source}"


def raw(spark: SparkSession, sf: str, name: str) -> DataFrame:
    table(spark, sf, RAW_FROM[name][0]).createOrReplaceTempView(RAW_FROM[name][0])
    return spark.sql(raw_sql(name))


def _conformed_sql(name: str) -> str:
    entity = conform_ops.ENTITIES[name]
    parts = []
    for column in entity.columns:
        source = "Name" if column == entity.named else f"{column}__c"
        if column.startswith("fecha_"):
            parts.append(f"CAST(epoch(CAST(try_strptime(substring({source}, 1, 10), '%Y-%m-%d') AS TIMESTAMP)) AS BIGINT) AS {column}")
        elif column.startswith("cod_") or column == "flag":
            kind = "BIGINT" if column == "cod_grupo_n2" and entity.named else "INTEGER"
            parts.append(f"TRY_CAST(regexp_extract({source}, '^([+-]?[0-9]+)(\\.[0-9]*)?$', 1) AS {kind}) AS {column}")
        else:
            parts.append(f"{source} AS {column}")
    if name == "cat_eventos":
        parts.append("TRY_CAST(INDICE__c AS DOUBLE) AS indice_")
    return f"WITH r AS ({raw_sql(name)}) SELECT {', '.join(parts)} FROM r"


def _epochs(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c, kind in df.dtypes if kind == "timestamp"})


def _register_conform(name: str) -> None:
    @query(f"conform_{name}", _conformed_sql(name))
    def run(spark, sf):
        return _epochs(conform_ops.conform(raw(spark, sf, name), name))


for _name in RAW_FROM:
    _register_conform(_name)


# -- record pages --------------------------------------------------------------------------------------------------

_CUSTOMERS = """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, n_name AS nation_n_name, r_name AS nation_region_r_name
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
PAGE_ROWS = 500


def _write_pages(spark: SparkSession, sf: str, field: str) -> str:
    """Customers with nested nation and region as JSON pages of at most 500 records (the key is unique)."""
    note = F.struct(F.lit("record").alias("type"), F.concat(F.lit("/c/"), F.col("c_custkey")).alias("url"))
    rows = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    nation = F.struct(note.alias("attributes"), F.col("n_name"), F.struct("r_name").alias("region"))
    record = F.struct(note.alias("attributes"), "c_custkey", "c_name", nation.alias("nation"))
    pages = rows.groupBy(F.call_function("div", F.col("c_custkey"), F.lit(PAGE_ROWS)).alias("page")).agg(
        F.collect_list(record).alias("records")
    )
    # every page states how many records there are in all; the last one says so
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.call_function("div", F.col("c_custkey"), F.lit(PAGE_ROWS))).alias("last")).first()
    body = F.struct(F.lit(seen["n"]).alias("totalSize"), (F.col("page") == F.lit(seen["last"])).alias("done"), F.col("records"))
    if field == records.WRAPPED:
        body = F.struct(F.struct(F.col("records")).alias("results"))
    path = new_folder(spark, "pages")
    pages.select(F.to_json(body).alias("value")).write.text(path)
    return path


def _flat_pages(spark: SparkSession, sf: str, field: str) -> DataFrame:
    flat = records.flatten(records.read_pages(spark, _write_pages(spark, sf, field), field))
    return flat.toDF(*[c.replace(".", "_") for c in flat.columns])


@query("read_record_pages", _CUSTOMERS)
def read_record_pages(spark, sf):
    return _flat_pages(spark, sf, records.PLAIN)


@query("flatten_records", _CUSTOMERS)
def flatten_records(spark, sf):
    return _flat_pages(spark, sf, records.WRAPPED)


@query("connector_load", _CUSTOMERS)
def connector_load(spark, sf):
    loaded = connector.load(spark, {"recordPages": _write_pages(spark, sf, records.PLAIN)})
    return loaded.toDF(*[c.replace(".", "_") for c in loaded.columns])


# -- text maps -----------------------------------------------------------------------------------------------------

TEXT_FIELDS = {
    "code": "CAST(o_orderkey AS STRING)",
    "big": "CAST(o_orderkey * 10000000019 AS STRING)",
    "price": "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)",
    "day": "concat(substring(CAST(o_orderdate AS STRING), 1, 10), ' 00:00:00')",
    "urgent": "CASE WHEN o_orderpriority LIKE '1%' THEN 'true' ELSE 'FALSE' END",
    "note": "CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 10 = 1 THEN '' ELSE o_orderpriority END",
    "mixed": "CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey AS STRING) ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END",
    "odd": "CASE WHEN o_orderkey % 3 = 0 THEN 'true' ELSE CAST(o_custkey AS STRING) END",
    "amount": "concat(CAST(o_custkey AS STRING), ',500.25')",
    "blank": "''",
    "rare": "CASE WHEN o_orderkey % 100 = 7 THEN CAST(o_custkey AS STRING) ELSE NULL END",
}
TEXT_SCHEMA = "code INT, big BIGINT, price DOUBLE, day TIMESTAMP, urgent BOOLEAN, note STRING, mixed DOUBLE, odd INT, amount DECIMAL(18,2), absent STRING, rare INT"
_TEXT_ROWS = f"SELECT o_orderkey, {', '.join(f'{sql} AS {name}' for name, sql in TEXT_FIELDS.items())} FROM orders"
_PAIRS = " UNION ALL ".join(f"SELECT '{name}' AS \"column\", {name} AS v FROM r" for name in TEXT_FIELDS)


def text_maps(spark: SparkSession, sf: str) -> DataFrame:
    """``o_orderkey, fields``: one text map for each order; absent values are absent keys."""
    pairs = ", ".join(f"'{name}', {sql}" for name, sql in TEXT_FIELDS.items())
    fields = f"map_filter(map({pairs}), (k, v) -> v IS NOT NULL) AS fields"
    return table(spark, sf, "orders").selectExpr("o_orderkey", fields)


@query("union_of_keys", f"""WITH r AS ({_TEXT_ROWS}) SELECT DISTINCT "column" FROM ({_PAIRS}) WHERE v IS NOT NULL
UNION SELECT DISTINCT concat('props.', unnest(json_keys(props))) FROM events""")
def union_of_keys(spark, sf):
    props = table(spark, sf, "events").select(F.from_json("props", "map<string,string>").alias("fields"))
    keys = infer.union_of_keys(props, "fields").select(F.concat(F.lit("props."), "column").alias("column"))
    return infer.union_of_keys(text_maps(spark, sf), "fields").union(keys)


_TYPED = f"""WITH r AS ({_TEXT_ROWS}), typed AS (SELECT "column", CASE WHEN v IS NULL OR v = '' THEN NULL
  WHEN regexp_full_match(v, '[+-]?[0-9]+') AND TRY_CAST(v AS INTEGER) IS NOT NULL THEN 1
  WHEN regexp_full_match(v, '[+-]?[0-9]+') AND TRY_CAST(v AS BIGINT) IS NOT NULL THEN 2
  WHEN regexp_full_match(v, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN 3
  WHEN regexp_full_match(v, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}} [0-9]{{1,2}}:[0-9]{{1,2}}:[0-9]{{1,2}}(\\.[0-9]+)?') THEN 4
  WHEN lower(v) IN ('true', 'false') THEN 5 ELSE 6 END AS k FROM ({_PAIRS})),
kinds AS (SELECT "column", CASE WHEN max(k) <= 3 THEN CASE max(k) WHEN 1 THEN 'int' WHEN 2 THEN 'bigint' ELSE 'double' END
  WHEN min(k) = 4 AND max(k) = 4 THEN 'timestamp' WHEN min(k) = 5 AND max(k) = 5 THEN 'boolean' ELSE 'string' END AS type
  FROM typed GROUP BY "column")"""


@query("infer_schema", f'{_TYPED} SELECT "column", type FROM kinds')
def infer_schema(spark, sf):
    present = infer.infer_map(text_maps(spark, sf), "fields")
    return present


@query("infer_columns", f'{_TYPED} SELECT "column", type FROM kinds')
def infer_columns(spark, sf):
    maps = text_maps(spark, sf)
    return infer.infer_columns(maps.select(*(F.try_element_at("fields", F.lit(c)).alias(c) for c in TEXT_FIELDS)))


@query("apply_schema", f"""WITH r AS ({_TEXT_ROWS}) SELECT o_orderkey, TRY_CAST(code AS INTEGER) AS code, TRY_CAST(big AS BIGINT) AS big,
  TRY_CAST(price AS DOUBLE) AS price, CAST(epoch(CAST(day AS TIMESTAMP)) AS BIGINT) AS day, lower(urgent) = 'true' AS urgent,
  coalesce(note, '') AS note, TRY_CAST(mixed AS DOUBLE) AS mixed, CASE WHEN odd = 'true' THEN NULL ELSE CAST(odd AS INTEGER) END AS odd,
  CAST(CAST(replace(amount, ',', '') AS DECIMAL(18,2)) AS DOUBLE) AS amount, '' AS absent, TRY_CAST(rare AS INTEGER) AS rare FROM r""")
def apply_schema(spark, sf):
    schema = T.StructType.fromDDL(TEXT_SCHEMA)
    typed = infer.apply_schema(text_maps(spark, sf), schema, "fields", keep=["o_orderkey"])
    return _epochs(typed).withColumn("amount", F.col("amount").cast("double"))


@query("url_encode_fields", """SELECT page_id, replace(replace(replace(url_encode(url), '%20', '+'), '%2A', '*'), '~', '%7E') AS url,
  replace(replace(replace(url_encode(html), '%20', '+'), '%2A', '*'), '~', '%7E') AS html FROM pages""")
def url_encode_fields(spark, sf):
    return infer.url_encode_columns(table(spark, sf, "pages"), ["url", "html"])


# -- metadata ------------------------------------------------------------------------------------------------------

_META = "STRUCT<objects: ARRAY<STRUCT<fields: ARRAY<STRUCT<name: STRING, label: STRING, fullyQualifiedName: STRING, type: STRING, precision: INT, scale: INT, defaultValue: INT, format: STRING>>>>>"


@query("schema_metadata", f"""{_TYPED} SELECT "column" AS name, "column" AS label, concat('orders.', "column") AS fullyQualifiedName,
  CASE WHEN type IN ('int', 'bigint', 'double') THEN 'Numeric' WHEN type = 'timestamp' THEN 'Date' ELSE 'Text' END AS type,
  CASE WHEN type IN ('int', 'bigint', 'double') THEN 18 END AS "precision",
  CASE WHEN type IN ('int', 'bigint') THEN 0 WHEN type = 'double' THEN 2 END AS scale,
  CASE WHEN type IN ('int', 'bigint', 'double') THEN 0 END AS defaultValue,
  CASE WHEN type = 'timestamp' THEN 'yyyy-MM-dd HH:mm:ss' END AS format FROM kinds""")
def schema_metadata(spark, sf):
    """Infer the schema of the records, export them as a dataset, read the written metadata."""
    maps = text_maps(spark, sf)
    typed = infer.apply_schema(maps, infer.to_schema(infer.infer_map(maps, "fields")), "fields")
    path = new_folder(spark, "dataset")
    export.export_dataset(typed, path, "orders")
    text = spark.read.text(f"{path}/metadata", wholetext=True)
    fields = text.select(F.explode(F.from_json("value", _META)["objects"][0]["fields"]).alias("f"))
    return fields.select("f.*")


# -- pages and chunks ----------------------------------------------------------------------------------------------


@query("page_limit_offset", """WITH p AS (SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders)
SELECT o_orderkey, o_custkey, position, position // 1000 AS page, position // 1000 = (SELECT max(position) // 1000 FROM p) AS last_page FROM p""")
def page_limit_offset(spark, sf):
    return paging.pages(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], 1000)


@query("page_single", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 500 OFFSET 1500")
def page_single(spark, sf):
    return paging.page(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], 500, 1500)


@query("deep_pages", """WITH p AS (SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS position, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, o_custkey, position, i AS page FROM p, range(1, 11) AS r(i) WHERE position >= i * n // 11 AND position < i * n // 11 + 25""")
def deep_pages(spark, sf):
    """Ten pages all over the orders, each asked of a layout that only the first call makes."""
    orders, path = table(spark, sf, "orders").select("o_orderkey", "o_custkey"), new_folder(spark, "layout")
    n, found = orders.count(), []
    for i in range(1, 11):
        layout.lay_out(orders, ["o_custkey", "o_orderkey"], path)
        found.append(layout.page(spark, path, 25, i * n // 11).withColumn("page", F.lit(i).cast("long")))
    return reduce(DataFrame.unionByName, found)


@query("page_chain", f"""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, row_number() OVER (ORDER BY c_custkey DESC) - 1 AS position FROM customer""")
def page_chain(spark, sf):
    """Customers by falling key in pages that only name their successors; each record's position follows from the ranks of the pages."""
    path, rows = new_folder(spark, "pages"), 50
    numbered = paging.positioned(table(spark, sf, "customer").select("c_custkey", "c_name"), [F.desc("c_custkey")])
    n = numbered.count()
    page = F.call_function("div", F.col("position"), F.lit(rows))
    records_ = F.transform(F.array_sort(F.collect_list(F.struct("position", "c_custkey", "c_name"))), lambda r: F.struct(r.c_custkey, r.c_name))
    pages = numbered.groupBy(page.alias("page")).agg(records_.alias("records"))

    def address(number):
        return F.concat(F.lit("/pages/"), F.md5(number.cast("string")))

    following = F.when((F.col("page") + 1) * rows < n, address(F.col("page") + 1))
    body = F.struct(address(F.col("page")).alias("url"), following.alias("nextRecordsUrl"), F.lit(n).alias("totalSize"), "records")
    pages.select(F.to_json(body).alias("value")).write.text(path)
    found = pagechain.read_chain(spark, path, T.StructType.fromDDL("c_custkey STRING, c_name STRING"))
    return found.select("c_custkey", "c_name", (F.col("page") * rows + F.col("place")).alias("position"))


@query("key_chunks", """WITH c AS (SELECT o_orderkey, (o_orderkey - (SELECT min(o_orderkey) FROM orders)) // 2500 AS chunk_id FROM orders)
SELECT chunk_id, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key, count(*) AS n_rows FROM c GROUP BY chunk_id""")
def key_chunks(spark, sf):
    return paging.chunk_ranges(table(spark, sf, "orders"), "o_orderkey", 2500)


# Keys with quadratic gaps, of which one holds a third of all rows and some are missing.
_SKEWED = """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 777 WHEN o_orderkey % 101 = 1 THEN NULL ELSE o_orderkey * o_orderkey END AS skewed FROM orders"""


@query("depth_chunks", f"""WITH s AS ({_SKEWED}) SELECT o_orderkey, skewed, true AS balanced FROM s""")
def depth_chunks(spark, sf):
    """A skewed table extracted in eight or nine chunks, twice; each row with whether its chunk is within a tenth of the mean, or smaller."""
    table(spark, sf, "orders").createOrReplaceTempView("orders")
    rows, path = spark.sql(_SKEWED), new_folder(spark, "chunks")
    size = rows.count() // 8 + 1
    for _ in range(2):
        chunks.extract(rows, "skewed", size, path)
    found = chunks.read(spark, path, rows.schema)
    held = found.groupBy("chunk_id").agg((F.count(F.lit(1)) <= 1.1 * size).alias("balanced"))
    return found.join(held, "chunk_id").drop("chunk_id")


# -- CSV -----------------------------------------------------------------------------------------------------------


def _csv_sql(*columns: str) -> str:
    return " || ',' || ".join(
        f"""CASE WHEN {c} IS NULL THEN '' WHEN contains({c}, '"') OR contains({c}, chr(10)) OR contains({c}, ',')
        THEN '"' || replace({c}, '"', '""') || '"' ELSE {c} END""" if c in ("text", "lang", "source") else f"coalesce(CAST({c} AS VARCHAR), '')"
        for c in columns
    )


_DOC_ROW = _csv_sql("doc_id", "text", "lang", "source", "n_chars")
_DOC_SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@query("csv_encode_rows", f"SELECT doc_id, {_DOC_ROW} AS line FROM documents")
def csv_encode_rows(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", csv_row(docs).alias("line"))


@query("csv_export", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_export(spark, sf):
    """Export as a dataset and read the parts back."""
    path = new_folder(spark, "dataset")
    export.export_dataset(table(spark, sf, "documents"), path, "documents")
    reader = spark.read.schema(_DOC_SCHEMA).options(multiLine=True, quote='"', escape='"', mode="FAILFAST")
    return reader.csv(f"{path}/data")


@query("csv_batches_read", r"""SELECT doc_id, regexp_replace(text, '\r\n|\r|\n', ' ', 'g') AS text, lang, doc_id // 100 AS batch_id FROM documents
WHERE (doc_id // 100) % 4 IN (0, 1)""")
def csv_batches_read(spark, sf):
    """Write headed batches, then read the completed ones."""
    batch = F.call_function("div", F.col("doc_id"), F.lit(100))
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", batch.alias("batch_id"))
    path = new_folder(spark, "batches")
    export.export_batches(docs, path, by="batch_id")
    kind = F.col("batch_id") % 4
    state = F.when(kind == 2, "Failed").when(kind == 3, "InProgress").otherwise("Completed")
    batches = docs.select("batch_id", state.alias("state")).distinct()
    schema = T.StructType.fromDDL("doc_id BIGINT, text STRING, lang STRING, batch_id BIGINT")
    return records.read_csv_batches(spark, path, batches, schema)


@query("table_size_bytes", f"SELECT count(*) AS n_rows, CAST(sum(strlen({_DOC_ROW})) AS BIGINT) AS n_bytes FROM documents")
def table_size_bytes(spark, sf):
    return sizing.table_size(table(spark, sf, "documents"))


@query("size_repartition", "SELECT doc_id, n_chars FROM documents")
def size_repartition(spark, sf):
    return sizing.size_repartition(table(spark, sf, "documents"), 1024 * 1024).select("doc_id", "n_chars")


@query("size_partitions", f"""WITH s AS (SELECT count(*) AS n_rows, sum(strlen({_DOC_ROW})) AS b FROM documents)
SELECT n_rows, CAST(CASE WHEN b <= 262144 THEN 1 ELSE b // 262144 + 1 END AS BIGINT) AS n_parts FROM s""")
def size_partitions(spark, sf):
    """How many partitions a bound of 256 KiB makes, and the rows in them."""
    parts = sizing.size_repartition(table(spark, sf, "documents"), 262144).groupBy(F.spark_partition_id().alias("part"))
    return parts.agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_parts"))


@query("bundle_bound", f"""SELECT count(*) AS n_rows, true AS bounded, CAST(sum(strlen({_DOC_ROW}) + 1) AS BIGINT) >= 131072 AS many FROM documents""")
def bundle_bound(spark, sf):
    """Documents put together to bundles of 128 KiB and uploaded as parts: none is over the bound unless it is one row."""
    dataset.register(spark)
    path = new_folder(spark, "uploads")
    docs = table(spark, sf, "documents").repartition(40)
    sizing.size_repartition(docs, 131072).write.format(dataset.NAME).mode("append").options(path=path, maxBytes=131072).save()
    parts = spark.createDataFrame([(p["rows"], p["bytes"]) for m in dataset.manifests(path) for p in m["parts"]], "rows BIGINT, bytes BIGINT")
    return parts.agg(F.sum("rows").alias("n_rows"), F.bool_and(F.expr("bytes <= 131072 OR rows = 1")).alias("bounded"), (F.count(F.lit(1)) > 1).alias("many"))


@query("csv_header", "SELECT 'doc_id,text,lang,source,n_chars' AS header, count(*) AS n_rows FROM documents")
def csv_header_query(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(csv_header(docs)).alias("header"), "n_rows")


@query("csv_batches_sized", "SELECT doc_id, lang, source, n_chars FROM documents")
def csv_batches_sized(spark, sf):
    """Headed batches of bounded size, read back."""
    path = new_folder(spark, "batches")
    export.export_batches(table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars"), path, 65536)
    reader = spark.read.schema("doc_id BIGINT, lang STRING, source STRING, n_chars BIGINT").options(header=True, enforceSchema=False)
    return reader.options(quote='"', escape='"', mode="FAILFAST").csv(path)


# -- merges and tables ---------------------------------------------------------------------------------------------

# Every customer is in the target; in the source two thirds have new keys.
_TARGET = "SELECT * FROM customer"
_NEW_KEY = "CASE WHEN c_custkey % 3 = 0 THEN c_custkey ELSE c_custkey + 1000000000 END AS c_custkey"
_SOURCE = f"SELECT {_NEW_KEY}, c_name, c_acctbal + 1000 AS c_acctbal FROM customer"
_MERGED = """SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, CASE WHEN s.c_custkey IS NOT NULL THEN s.c_name ELSE t.c_name END AS c_name,
  t.c_nationkey, CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal, t.c_mktsegment"""


def _merge_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    customer = table(spark, sf, "customer")
    return customer, customer.selectExpr(_NEW_KEY, "c_name", "c_acctbal + 1000 AS c_acctbal")


@query("merge_insert", f"SELECT * FROM ({_TARGET}) UNION ALL SELECT c_custkey, c_name, NULL, c_acctbal, NULL FROM ({_SOURCE})")
def merge_insert(spark, sf):
    return merge.insert(*_merge_sides(spark, sf))


@query("merge_update", f"{_MERGED} FROM ({_TARGET}) t LEFT JOIN ({_SOURCE}) s ON t.c_custkey = s.c_custkey")
def merge_update(spark, sf):
    return merge.update(*_merge_sides(spark, sf), "c_custkey")


@query("merge_upsert", f"{_MERGED} FROM ({_TARGET}) t FULL JOIN ({_SOURCE}) s ON t.c_custkey = s.c_custkey")
def merge_upsert(spark, sf):
    return merge.upsert(*_merge_sides(spark, sf), "c_custkey")


@query("merge_upsert_empty_target", f"SELECT c_custkey, c_name, NULL AS c_nationkey, c_acctbal, NULL AS c_mktsegment FROM ({_SOURCE})")
def merge_upsert_empty_target(spark, sf):
    target, source = _merge_sides(spark, sf)
    return merge.upsert(target.where("1 = 0"), source, "c_custkey")


@query("object_operation", f"{_MERGED} FROM ({_TARGET}) t LEFT JOIN ({_SOURCE}) s ON t.c_custkey = s.c_custkey")
def object_operation(spark, sf):
    """Records applied to a keyed object by options; overwriting means to update."""
    target, source = _merge_sides(spark, sf)
    return connector.save(source, {"object": "customer", "externalIdFieldName": "c_custkey"}, "overwrite", target)


# Orders kept by month; the first batch changes two months and adds a third, the second moves rows of a fourth there.
_BY_MONTH = """SELECT o_orderkey, o_custkey, CAST(floor(o_totalprice) AS BIGINT) AS price, substring(CAST(o_orderdate AS STRING), 1, 7) AS month FROM orders"""
_RAISED = f"""SELECT o_orderkey, o_custkey, price + 100 AS price, month FROM ({_BY_MONTH}) m WHERE month IN ('1995-03', '1996-07') AND o_orderkey % 2 = 0
  UNION ALL SELECT o_orderkey + 1000000000, o_custkey, price, '1999-02' FROM ({_BY_MONTH}) m WHERE month = '1997-01' AND o_custkey % 5 = 0"""
_MOVED = f"SELECT o_orderkey, '1999-02' AS month FROM ({_BY_MONTH}) m WHERE month = '1995-05' AND o_orderkey % 2 = 1"


@query("stored_batches", f"""WITH base AS ({_BY_MONTH}), raised AS ({_RAISED}), moved AS ({_MOVED}),
  first AS (SELECT coalesce(r.o_orderkey, b.o_orderkey) AS o_orderkey, coalesce(r.o_custkey, b.o_custkey) AS o_custkey,
    coalesce(r.price, b.price) AS price, coalesce(r.month, b.month) AS month FROM base b FULL JOIN raised r ON b.o_orderkey = r.o_orderkey),
  second AS (SELECT f.o_orderkey, o_custkey, price, coalesce(m.month, f.month) AS month FROM first f LEFT JOIN moved m ON f.o_orderkey = m.o_orderkey)
  SELECT *, CASE WHEN month IN ('1995-05', '1999-02') THEN 'moved' WHEN month IN ('1995-03', '1996-07') THEN 'raised' ELSE 'base' END AS file_of FROM second""")
def stored_batches(spark, sf):
    """Two batches applied to a table kept by month, one of them three times; files that no batch touches are those of the first load."""
    table(spark, sf, "orders").createOrReplaceTempView("orders")
    path = new_folder(spark, "stored")
    stored.apply_batch(spark, path, spark.sql(_BY_MONTH), "insert", "o_orderkey", "base", "month")
    for batch, sql, operation in (("raised", _RAISED, "upsert"), ("raised", _RAISED, "upsert"), ("moved", _MOVED, "update"), ("raised", _RAISED, "upsert")):
        stored.apply_batch(spark, path, spark.sql(sql), operation, "o_orderkey", batch)
    return stored.read(spark, path).withColumn("file_of", F.regexp_extract("_metadata.file_name", "^[a-z]+", 0))


_CHAIN = "SELECT c_custkey, c_name, CAST(floor(c_acctbal) AS BIGINT) AS balance FROM customer"


@query("dataset_chain", f"""WITH base AS ({_CHAIN}),
  raised AS (SELECT c_custkey, c_name, balance + 1000 AS balance FROM base WHERE c_custkey % 3 = 0
    UNION ALL SELECT c_custkey + 1000000000, c_name, balance FROM base WHERE c_custkey % 7 = 0)
  SELECT * FROM base WHERE c_custkey % 3 <> 0 AND c_custkey % 2 = 0 UNION ALL SELECT * FROM base WHERE c_custkey % 3 <> 0 AND c_custkey % 5 = 0
  UNION ALL SELECT * FROM raised UNION ALL SELECT c_custkey, 'after', balance FROM base WHERE c_custkey % 11 = 0""")
def dataset_chain(spark, sf):
    """Uploads that are replaced, added to, upserted and added to again, one of them sent twice and one that fails, after all of them."""
    dataset.register(spark)
    table(spark, sf, "customer").createOrReplaceTempView("customer")
    base = spark.sql(_CHAIN)
    new = base.where("c_custkey % 7 = 0").withColumn("c_custkey", F.col("c_custkey") + 1000000000)
    raised = base.where("c_custkey % 3 = 0").withColumn("balance", F.col("balance") + 1000).unionByName(new)
    path = new_folder(spark, "uploads")

    def upload(rows, mode="append", **options):
        rows.write.format(dataset.NAME).mode(mode).options(path=path, **options).save()

    upload(base.withColumn("c_name", F.lit("replaced")))
    upload(base.where("c_custkey % 2 = 0"), "overwrite")
    upload(base.where("c_custkey % 5 = 0"))
    for _ in range(2):
        upload(raised, operation="upsert", key="c_custkey", upload="raised")
    upload(base.where("c_custkey % 11 = 0").withColumn("c_name", F.lit("after")))
    _broken_upload(base, path)
    return dataset.resolved(spark, path)


def _broken_upload(rows: DataFrame, path: str) -> None:
    """An upload that fails at one of its rows, after others may have been written."""
    first = rows.agg(F.max("c_custkey")).scalar()
    broken = rows.withColumn("c_name", F.when(F.col("c_custkey") == first, F.raise_error(F.lit("broken record")).cast("string")).otherwise("never"))
    try:
        broken.write.format(dataset.NAME).mode("append").options(path=path, upload="broken").save()
    except PySparkException as error:
        if "broken record" not in str(error):
            raise


@query("dataset_source", "SELECT doc_id, text, lang, n_chars FROM documents WHERE doc_id BETWEEN 20 AND 120")
def dataset_source(spark, sf):
    """Documents through the data source and back, in parts of 64 KiB, of which only those that may hold the asked ids are read."""
    dataset.register(spark)
    path = new_folder(spark, "uploads")
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "n_chars")
    docs.write.format(dataset.NAME).mode("append").options(path=path, maxBytes=65536).save()
    return dataset.rows_between(spark, path, "doc_id", 20, 120)


@query("upload_verdicts", """SELECT 'whole' AS upload, true AS committed, true AS ok, count(*) AS n_rows FROM customer
  UNION ALL SELECT 'partly empty', true, true, count(*) FROM customer WHERE c_custkey < 10 UNION ALL SELECT 'broken', false, false, 0""")
def upload_verdicts(spark, sf):
    """The folded outcomes of real writes: a failing task turns the verdict, tasks without rows don't."""
    dataset.register(spark)
    table(spark, sf, "customer").createOrReplaceTempView("customer")
    rows, path = spark.sql(_CHAIN), new_folder(spark, "uploads")
    for name, part in (("whole", rows.repartition(4)), ("partly empty", rows.where("c_custkey < 10").repartition(4, "c_custkey"))):
        part.write.format(dataset.NAME).mode("append").options(path=path, upload=name).save()
    _broken_upload(rows, path)
    return dataset.verdicts(spark, path)


@query("register_view", "SELECT * FROM supplier")
def register_view(spark, sf):
    return spark.table(tables.register_view(table(spark, sf, "supplier"), "registered_supplier"))


@query("current_month", "SELECT o_orderkey, strftime(current_date, '%Y-%m') AS process_month FROM orders")
def current_month_query(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", current_month("UTC").alias("process_month"))


def _saved(spark: SparkSession, steps: list[tuple[DataFrame, str]]) -> DataFrame:
    """Run the writes on one external table and read its files back."""
    path = new_folder(spark, "table")
    name = "saved_" + path[-32:]
    for df, mode in steps:
        tables.save_table(df, name, path, mode)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path)


@query("table_append", "SELECT * FROM supplier UNION ALL SELECT * FROM supplier")
def table_append(spark, sf):
    supplier = table(spark, sf, "supplier")
    return _saved(spark, [(supplier, "overwrite"), (supplier, "append")])


@query("table_overwrite", "SELECT * REPLACE (s_suppkey + 1 AS s_suppkey) FROM supplier")
def table_overwrite(spark, sf):
    supplier = table(spark, sf, "supplier")
    return _saved(spark, [(supplier, "overwrite"), (supplier.withColumn("s_suppkey", F.expr("s_suppkey + 1")), "overwrite")])


@query("write_dimension", _conformed_sql("agrup_cadenas"))
def write_dimension(spark, sf):
    return _epochs(_saved(spark, [(conform_ops.conform(raw(spark, sf, "agrup_cadenas"), "agrup_cadenas"), "overwrite")]))


# -- statuses ------------------------------------------------------------------------------------------------------


@query("batch_status", """SELECT job_id, count(*) AS n_batches, CAST(sum(number_records_failed) AS BIGINT) AS n_failed_records,
  CASE WHEN bool_or(state = 'Failed' OR number_records_failed > 0) THEN 'failed'
    WHEN bool_or(state IN ('InProgress', 'Queued')) THEN 'pending' ELSE 'complete' END AS status,
  bool_and(state = 'Completed' AND number_records_failed = 0) AS ok FROM batches GROUP BY job_id""", "batches")
def batch_status(spark, sf):
    return status.job_status(view(spark, sf, "batches"))


_UPLOADS = """SELECT event_id, CASE event_id % 10 WHEN 0 THEN 'Completed' WHEN 1 THEN 'CompletedWithWarnings' WHEN 2 THEN 'Failed'
  WHEN 3 THEN 'InProgress' WHEN 4 THEN 'New' WHEN 5 THEN 'NotProcessed' WHEN 6 THEN 'Queued' WHEN 7 THEN 'Other' ELSE NULL END AS status FROM events"""


@query("dataset_status", f"""SELECT event_id, status, CASE WHEN status = 'Failed' THEN 'failed'
  WHEN status IN ('New', 'Queued', 'InProgress') THEN 'pending' ELSE 'ok' END AS verdict FROM ({_UPLOADS})""")
def dataset_status(spark, sf):
    table(spark, sf, "events").createOrReplaceTempView("events")
    return spark.sql(_UPLOADS).withColumn("verdict", status.upload_status(F.col("status")))
