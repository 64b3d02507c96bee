"""Queries over typed views of order documents."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow import fixtures as fx
from docflow.functions import extract as X
from docflow.functions.trees import tag_tree
from docflow.operators import latest, retention, views
from docflow.plans.changelog import CHANGELOG
from docflow.plans.registry import query
from docflow.sources.specs import read_specs, spec_views

EVENT = [views.Field("value", "number"), views.Field("event_type", "string", column_name="kind"), views.Field("k", "number")]


#: The folder of the spec files that come with these queries. A worker may import this by a relative path.
SPECS = Path(__file__).absolute().with_name("specs").as_uri()


def order_spec(spark: SparkSession) -> list[views.Field]:
    return read_specs(spark, [f"{SPECS}/shop-*.json"])["shop_order"]


def column(key: str, make, sql: str) -> None:
    """A query of one extracted column, `x`, for each order."""

    @query(key, f"SELECT o_orderkey, {sql} AS x FROM orders")
    def run(spark: SparkSession, d: str) -> DataFrame:
        v = fx.order_docs(spark, d).select(F.col("document_id").cast("bigint").alias("o_orderkey"), X.parsed("data").alias("v"))
        return v.select("o_orderkey", make(F.col("v")).alias("x"))


column("F01", lambda v: F.concat_ws("|", X.json_scalar(v, ["status"]), F.coalesce(X.json_scalar(v, ["ship"]), F.lit("-")), F.coalesce(X.json_scalar(v, ["items"]), F.lit("-")), F.coalesce(X.json_scalar(v, ["note"]), F.lit("-"))), "o_orderstatus || '|-|-|-'")
column("F02", lambda v: X.json_value(v, ["ship", "priority"]), "'\"' || o_orderpriority || '\"'")
column("F03", lambda v: X.doc_string(v, ["ship", "priority"]), "o_orderpriority")
column("F05", lambda v: X.doc_boolean(v, ["even"]), "o_orderkey % 2 = 0")
column("F06", lambda v: F.unix_micros(X.doc_timestamp(v, ["placed"])), "epoch_us(CAST(o_orderdate AS TIMESTAMP))")
column("F07", lambda v: X.doc_geopoint(v, ["loc"])["longitude"].cast("bigint") * 1000 + X.doc_number(v, ["loc", "_latitude"]).cast("bigint"), "o_custkey % 180 * 1000 + o_custkey % 90")
column("F09", lambda v: X.doc_null(v, ["note"]), "CAST(NULL AS VARCHAR)")
column("F11", lambda v: X.doc_number(v, ["ship", "by", "cust"]), "CAST(o_custkey AS DECIMAL(38, 9))")


@query("F08", "SELECT o_orderkey, coalesce(string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_linenumber, l_partkey, l_quantity, l_returnflag), '') AS x FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def arrays(spark: SparkSession, d: str) -> DataFrame:
    v = fx.order_docs(spark, d).select(F.col("document_id").cast("bigint").alias("o_orderkey"), X.parsed("data").alias("v"))
    return v.select("o_orderkey", F.array_join(X.doc_array(F.col("v"), ["items"]), ",").alias("x"))


@query("F10", "SELECT o_orderkey, count(l_partkey) AS n_lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def stringified(spark: SparkSession, d: str) -> DataFrame:
    """The subtree's text, parsed again to compare its size."""
    v = fx.order_docs(spark, d).select(F.col("document_id").cast("bigint").alias("o_orderkey"), X.parsed("data").alias("v"))
    text = X.doc_stringified_map(F.col("v"), ["lines"])
    return v.select("o_orderkey", F.coalesce(F.json_array_length(text), F.lit(0)).cast("bigint").alias("n_lines"))


LINES = "SELECT CAST(o_orderkey AS VARCHAR) AS document_id, l_linenumber, l_partkey, l_quantity, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, l_returnflag) - 1 AS i FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey"


@query("F12", f"SELECT document_id, CASE WHEN l_partkey IS NOT NULL THEN i END AS lines_index, CAST(l_partkey AS DECIMAL(38, 9)) AS lines_part, CAST(l_quantity AS DECIMAL(38, 9)) AS lines_qty FROM ({LINES})")
def array_maps(spark: SparkSession, d: str) -> DataFrame:
    spec = [views.Field("lines", "array_map", (views.Field("part", "number"), views.Field("qty", "number")))]
    return views.schema_changelog(fx.order_docs(spark, d), spec).select("document_id", F.col("lines_index").cast("bigint").alias("lines_index"), "lines_part", "lines_qty")


@query("J09", f"SELECT document_id, count(l_partkey) AS n, CAST(coalesce(sum(l_quantity), 0) AS DECIMAL(38, 9)) AS qty FROM ({LINES}) GROUP BY 1")
def unnested_maps(spark: SparkSession, d: str) -> DataFrame:
    log = fx.order_docs(spark, d).select("document_id", X.parsed("data").alias("v"))
    rows = views.unnest_array_map(log, "v", ["lines"], "lines", (views.Field("qty", "number"),))
    return rows.groupBy("document_id").agg(F.count("lines_index").alias("n"), F.coalesce(F.sum("lines_qty"), F.lit(0)).cast(X.NUMBER).alias("qty"))


@query("J08", f"SELECT document_id, CASE WHEN l_partkey IS NOT NULL THEN i END AS items_index, CAST(l_partkey AS VARCHAR) AS items_member FROM ({LINES})")
def unnested(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.order_docs(spark, d).select("document_id", X.doc_array(X.parsed("data"), ["items"]).alias("items"))
    return views.unnest_array(rows, "items").select("document_id", F.col("items_index").cast("bigint").alias("items_index"), "items_member")


@query("F14", "SELECT o_orderkey, o_orderstatus AS state FROM orders")
def renamed(spark: SparkSession, d: str) -> DataFrame:
    return views.rename_columns(fx.table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), {"o_orderstatus": "state"})


@query("F15", "SELECT 'order_status' AS name, 'state of the order' AS comment, count(*) AS n_rows, count(o_orderstatus) AS n_filled FROM orders")
def described(spark: SparkSession, d: str) -> DataFrame:
    """The descriptions that a view's columns carry, read from its schema, with their columns' counts over the whole view."""
    view = views.schema_changelog(fx.order_docs(spark, d), order_spec(spark), arrays=False)
    told = [(f.name, f.metadata["comment"]) for f in view.schema if "comment" in f.metadata]
    counted = view.agg(F.count("*").alias("n_rows"), *(F.count(n).alias(n) for n, _ in told))
    rows = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(c).alias("comment"), "n_rows", F.col(n).alias("n_filled")) for n, c in told))
    return counted.select(F.explode(rows).alias("t")).select("t.*")


@query("F16", "SELECT o_orderkey, CASE WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) THEN 'timestamp,geopoint,map,array,array_map,null,boolean,string,number' ELSE 'timestamp,geopoint,map,null,null,null,boolean,string,number' END AS tags, 'timestamp' AS placed_type, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000Z') AS placed, CAST(o_custkey % 180 AS DOUBLE) AS longitude, 'customers/' || o_custkey AS owner, CAST(o_custkey AS BIGINT) AS cust, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000Z') AS deep FROM orders")
def tagged(spark: SparkSession, d: str) -> DataFrame:
    """Types of the fields, and the whole document in tagged form: times, points and references in it, in a map and in an array too."""
    docs = fx.order_docs(spark, d)
    cust = F.split("path", "/")[1]
    inner = F.concat(F.lit(',"more":{"list":[1,{"owner":{"_path":{"segments":["customers","'), cust, F.lit('"]}},"at":'), F.get_json_object("data", "$.placed"), F.lit("}]}}"))
    whole = docs.withColumn("data", F.concat(F.expr("substring(data, 1, length(data) - 1)"), inner))
    v = whole.select(F.col("document_id").cast("bigint").alias("o_orderkey"), X.parsed("data").alias("v"))
    names = ("placed", "loc", "ship", "items", "lines", "note", "even", "status", "total")
    v = v.select("o_orderkey", F.concat_ws(",", *(views.tag_types(F.try_variant_get("v", f"$.{n}", "variant")) for n in names)).alias("tags"), tag_tree(F.col("v")).alias("t"))
    got = lambda path, kind, name: F.try_variant_get("t", path, kind).alias(name)
    return v.select(
        "o_orderkey", "tags", got("$.placed._type", "string", "placed_type"), got("$.placed.value", "string", "placed"), got("$.loc.longitude", "double", "longitude"),
        got("$.more.list[1].owner.path", "string", "owner"), got("$.ship.by.cust", "long", "cust"), got("$.more.list[1].at.value", "string", "deep"),
    )


@query("F17", "SELECT * FROM (VALUES ('even', 'boolean'), ('items', 'array'), ('lines', 'array_map'), ('loc', 'geopoint'), ('note', 'null'), ('placed', 'timestamp'), ('ship', 'map'), ('status', 'string'), ('total', 'number')) t(name, type)")
def inferred(spark: SparkSession, d: str) -> DataFrame:
    spec = views.infer_field_spec(fx.order_docs(spark, d))
    return spark.createDataFrame([(f.name, f.type) for f in spec], "name string, type string")


VIEW = f"""SELECT document_id, CAST(o_orderkey AS BIGINT) AS id, o_orderstatus AS order_status, CAST(o_totalprice AS DECIMAL(38, 9)) AS total, o_orderkey % 2 = 0 AS even,
    epoch_us(CAST(o_orderdate AS TIMESTAMP)) AS placed_us, CAST(o_custkey % 90 AS DECIMAL(38, 9)) AS loc_latitude, o_orderpriority AS ship_priority,
    CAST(o_custkey AS DECIMAL(38, 9)) AS ship_by_cust, CASE WHEN l_partkey IS NOT NULL THEN i END AS items_index, CAST(l_partkey AS VARCHAR) AS items_member
FROM ({LINES}) l JOIN orders ON CAST(o_orderkey AS VARCHAR) = document_id"""


def _flat(view: DataFrame) -> DataFrame:
    return view.select(
        "document_id", F.col("document_id").cast("bigint").alias("id"), "order_status", "total", "even", F.unix_micros("placed").alias("placed_us"),
        "loc_latitude", "ship_priority", "ship_by_cust", F.col("items_index").cast("bigint").alias("items_index"), "items_member",
    )


@query("V01", VIEW)
def typed_changelog(spark: SparkSession, d: str) -> DataFrame:
    """By a spec file, one of those that a glob names."""
    return _flat(views.schema_changelog(fx.order_docs(spark, d), order_spec(spark)))


@query("V02", VIEW)
def typed_latest(spark: SparkSession, d: str) -> DataFrame:
    """The latest view of a folder's spec, under its name."""
    made = spec_views(fx.order_docs(spark, d), read_specs(spark, [SPECS]), "orders")
    return _flat(made["orders_schema_shop_order_latest"])


@query("V03", f"WITH {CHANGELOG}, n AS (SELECT * FROM changelog QUALIFY row_number() OVER (PARTITION BY document_name ORDER BY timestamp DESC, event_id DESC) = 1) SELECT document_id, operation, CAST(value AS DECIMAL(38, 9)) AS value, kind, CAST(k AS DECIMAL(38, 9)) AS k FROM n WHERE operation <> 'DELETE'")
def typed_from_latest(spark: SparkSession, d: str) -> DataFrame:
    view = views.schema_latest_from_latest(latest.latest_incremental(fx.changelog(spark, d)), EVENT)
    return view.select("document_id", "operation", "value", "kind", "k")


@query("Q01", "SELECT CAST(o_orderkey AS VARCHAR) AS document_id, epoch_us(CAST(o_orderdate AS TIMESTAMP)) AS placed_us FROM orders")
def recent(spark: SparkSession, d: str) -> DataFrame:
    """Orders by their time, newest first."""
    view = views.schema_latest(fx.order_docs(spark, d), [views.Field("placed", "timestamp")])
    return view.orderBy(F.desc("placed")).select("document_id", F.unix_micros("placed").alias("placed_us"))


@query("Q02", f"SELECT document_id, CAST(l_partkey AS VARCHAR) AS items_member FROM ({LINES}) WHERE i = 0 AND l_partkey IS NOT NULL")
def first_items(spark: SparkSession, d: str) -> DataFrame:
    view = views.schema_latest(fx.order_docs(spark, d), [views.Field("items", "array")])
    return view.where("items_index = 0").select("document_id", "items_member")


@query("Q04", f"SELECT DISTINCT document_id, CAST(l_partkey AS VARCHAR) AS items_member FROM ({LINES})")
def members(spark: SparkSession, d: str) -> DataFrame:
    view = views.schema_latest(fx.order_docs(spark, d), [views.Field("items", "array"), views.Field("ship", "stringified_map")])
    return view.select("document_id", "items_member").distinct()


@query("Q05", "SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_type <> 'error' THEN CAST(value AS DECIMAL(38, 9)) END AS value, CAST(NULL AS DECIMAL(38, 9)) AS kind FROM events WHERE user_id = 7")
def typed_lookup(spark: SparkSession, d: str) -> DataFrame:
    """One document's changes; a field read as another type shows NULL."""
    spec = [views.Field("value", "number"), views.Field("event_type", "number", column_name="kind")]
    log = fx.changelog(spark, d).where(F.col("document_name") == f"{fx.ROOT}users/7")
    view = views.schema_changelog(log.withColumn("document_id", F.col("event_id")), spec)
    return view.select(F.col("document_id").alias("event_id"), "value", "kind")


@query("A05", f"SELECT 'projects/demo/databases/(default)/documents/customers/' || o_custkey || '/orders/' || o_orderkey AS document_name, m AS max_index FROM orders JOIN (SELECT document_id, max(CASE WHEN l_partkey IS NOT NULL THEN i END) AS m FROM ({LINES}) GROUP BY 1) ON document_id = CAST(o_orderkey AS VARCHAR)")
def counts(spark: SparkSession, d: str) -> DataFrame:
    view = views.schema_latest(fx.order_docs(spark, d), [views.Field("items", "array")])
    return retention.max_index_per_doc(view, "items").select("document_name", F.col("max_index").cast("bigint").alias("max_index"))


@query("X01", f"SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(38, 9)) AS total, o_orderkey % 2 = 0 AS even, epoch_us(CAST(o_orderdate AS TIMESTAMP)) AS placed_us, CAST(o_custkey % 90 AS DECIMAL(38, 9)) AS latitude, CAST(o_custkey % 180 AS DECIMAL(38, 9)) AS longitude, coalesce(items, '') AS items FROM orders LEFT JOIN (SELECT document_id, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY i) AS items FROM ({LINES}) GROUP BY 1) ON document_id = CAST(o_orderkey AS VARCHAR)")
def sql_functions(spark: SparkSession, d: str) -> DataFrame:
    """The extraction functions as SQL functions of a session."""
    views.register_functions(spark)
    fx.order_docs(spark, d).createOrReplaceTempView("order_docs_x01")
    return spark.sql("""SELECT CAST(document_id AS BIGINT) AS o_orderkey, doc_number(data, 'total') AS total, doc_boolean(data, 'even') AS even,
        unix_micros(doc_timestamp(data, 'placed')) AS placed_us, doc_geopoint(data, 'loc').latitude AS latitude, doc_geopoint(data, 'loc').longitude AS longitude,
        array_join(doc_array(data, 'items'), ',') AS items FROM order_docs_x01""")
