"""Queries over the changelog of events and over document trees."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow import fixtures as fx
from docflow.functions import paths
from docflow.functions.extract import doc_number, expire_at, json_scalar, parsed
from docflow.operators import capture, latest, named, retention
from docflow.plans.registry import query
from docflow.sources import tables

AS_OF = "2024-02-20"

CHANGELOG = """changelog AS (
    SELECT ts AS timestamp, CAST(event_id AS VARCHAR) AS event_id,
        'projects/demo/databases/(default)/documents/users/' || user_id AS document_name,
        CASE event_type WHEN 'signup' THEN 'CREATE' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS operation,
        CAST(user_id AS VARCHAR) AS document_id, CASE WHEN event_type <> 'error' THEN value END AS value,
        CASE WHEN event_type <> 'error' THEN event_type END AS kind,
        CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k
    FROM events
)"""
TIED = CHANGELOG.replace("ts AS timestamp", "date_trunc('day', ts) AS timestamp")
NULLED = CHANGELOG.replace("ts AS timestamp", "CASE WHEN event_id % 7 <> 0 THEN ts END AS timestamp")
SHOWN = "document_name, document_id, operation, epoch_us(timestamp) AS ts_us, event_id, value, kind, k"
TREE = """tree AS (
    SELECT 'regions/' || n_regionkey || '/nations/' || n_nationkey AS path, CAST(NULL AS VARCHAR) AS owner FROM nation
    UNION ALL SELECT 'regions/' || n_regionkey || '/nations/' || n_nationkey || '/suppliers/' || s_suppkey, NULL FROM supplier JOIN nation ON s_nationkey = n_nationkey
    UNION ALL SELECT 'customers/' || o_custkey || '/orders/' || o_orderkey, CAST(o_orderkey % 1000 AS VARCHAR) FROM orders
)"""


def shown(log: DataFrame, *more: str) -> DataFrame:
    """Changelog rows with their payload's scalars in place of its text."""
    v = log.withColumn("_v", parsed("data"))
    scalars = (json_scalar(F.col("_v"), ["value"]).cast("double").alias("value"), json_scalar(F.col("_v"), ["event_type"]).alias("kind"), json_scalar(F.col("_v"), ["k"]).cast("bigint").alias("k"))
    return v.select("document_name", "document_id", "operation", F.unix_micros("timestamp").alias("ts_us"), "event_id", *scalars, *more)


NEWEST = "SELECT * FROM changelog QUALIFY row_number() OVER (PARTITION BY document_name ORDER BY coalesce(timestamp, TIMESTAMP '1970-01-01') DESC, event_id DESC) = 1"


@query("A01", f"WITH {CHANGELOG}, n AS ({NEWEST}) SELECT {SHOWN} FROM n")
def latest_with_deletes(spark: SparkSession, d: str) -> DataFrame:
    return shown(latest.latest_incremental(fx.changelog(spark, d)))


@query("A02", f"WITH {CHANGELOG}, n AS ({NEWEST}) SELECT {SHOWN} FROM n WHERE operation <> 'DELETE'")
def latest_live(spark: SparkSession, d: str) -> DataFrame:
    return shown(latest.latest_materialized(fx.changelog(spark, d)))


@query("J01", f"WITH {NULLED}, m AS (SELECT document_name AS d, max(coalesce(timestamp, TIMESTAMP '1970-01-01')) AS t FROM changelog GROUP BY 1) SELECT DISTINCT document_name, document_id, operation, epoch_us(timestamp) AS ts_us FROM changelog JOIN m ON document_name = d AND coalesce(timestamp, TIMESTAMP '1970-01-01') = t WHERE operation <> 'DELETE'")
def latest_join(spark: SparkSession, d: str) -> DataFrame:
    return shown(latest.latest_by_join(fx.with_null_times(fx.changelog(spark, d)))).select("document_name", "document_id", "operation", "ts_us")


@query("W01", f"WITH {CHANGELOG} SELECT {SHOWN} FROM changelog QUALIFY row_number() OVER (PARTITION BY document_name ORDER BY timestamp DESC) = 1 AND operation <> 'DELETE'")
def latest_window(spark: SparkSession, d: str) -> DataFrame:
    return shown(latest.latest_by_window(fx.changelog(spark, d)))


@query("W02", f"WITH {TIED} SELECT {SHOWN} FROM changelog QUALIFY rank() OVER (PARTITION BY document_name ORDER BY timestamp DESC) = 1 AND operation <> 'DELETE'")
def latest_rank(spark: SparkSession, d: str) -> DataFrame:
    return shown(latest.latest_by_rank(fx.tied(fx.changelog(spark, d))))


@query("P15", f"WITH {CHANGELOG} SELECT {SHOWN} FROM changelog WHERE operation <> 'DELETE'")
def live_rows(spark: SparkSession, d: str) -> DataFrame:
    return shown(latest.live_only(fx.changelog(spark, d)))


@query("A03", f"WITH {CHANGELOG} SELECT document_name, operation, min(event_id) AS event_id FROM changelog GROUP BY 1, 2")
def any_values(spark: SparkSession, d: str) -> DataFrame:
    return latest.any_value(fx.changelog(spark, d), ["document_name", "operation"], ["event_id"])


@query("A04", f"WITH {TIED} SELECT DISTINCT document_name, operation, epoch_us(timestamp) AS ts_us FROM changelog")
def dedup(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.tied(fx.changelog(spark, d)).select("document_name", "operation", F.unix_micros("timestamp").alias("ts_us"))
    return latest.dedup_rows(rows, rows.columns)


STALE = f"WITH {CHANGELOG}, m AS (SELECT document_name AS d, max(timestamp) AS t FROM changelog GROUP BY 1), j AS (SELECT * FROM changelog JOIN m ON document_name = d)"


@query("J02", f"{STALE} SELECT DISTINCT document_name, epoch_us(timestamp) AS ts_us FROM j WHERE timestamp <> t AND timestamp < TIMESTAMP '2024-01-20'")
def stale(spark: SparkSession, d: str) -> DataFrame:
    rows = retention.stale_versions(fx.changelog(spark, d), retention.month_before(AS_OF))
    return rows.select("document_name", F.unix_micros("timestamp").alias("ts_us"))


@query("J03", f"WITH {CHANGELOG} SELECT {SHOWN} FROM changelog WHERE operation <> 'DELETE'")
def deleted_by_key(spark: SparkSession, d: str) -> DataFrame:
    log = fx.changelog(spark, d)
    return shown(retention.delete_matching(log, log.where("operation = 'DELETE'")))


@query("Q06", f"{STALE} SELECT {SHOWN} FROM j WHERE timestamp = t OR timestamp >= TIMESTAMP '2024-01-20'")
def keep_latest(spark: SparkSession, d: str) -> DataFrame:
    return shown(retention.retain_keep_latest(fx.changelog(spark, d), AS_OF))


@query("Q07", f"WITH {CHANGELOG} SELECT {SHOWN} FROM changelog WHERE timestamp >= TIMESTAMP '2024-01-20'")
def keep_recent(spark: SparkSession, d: str) -> DataFrame:
    return shown(retention.retain_all(fx.changelog(spark, d), AS_OF))


@query("Q08", f"{STALE} SELECT {SHOWN} FROM j WHERE (timestamp = t AND operation <> 'DELETE') OR timestamp >= TIMESTAMP '2024-01-20'")
def drop_deletes(spark: SparkSession, d: str) -> DataFrame:
    return shown(retention.retain_drop_deletes(fx.changelog(spark, d), AS_OF))


@query("P16", f"WITH {CHANGELOG} SELECT {SHOWN} FROM changelog WHERE document_id = '7'")
def history(spark: SparkSession, d: str) -> DataFrame:
    return shown(latest.document_history(fx.changelog(spark, d), f"{fx.ROOT}users/7"))


@query("W03", "SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) <= 5")
def last_five(spark: SparkSession, d: str) -> DataFrame:
    return latest.keep_last_n(fx.table(spark, d, "events").select("user_id", "event_id"), "user_id", "event_id", 5)


@query("W04", "SELECT user_id, event_id, CAST((row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 20 AS BIGINT) AS batch FROM events")
def batches(spark: SparkSession, d: str) -> DataFrame:
    return latest.batch_rows(fx.table(spark, d, "events").select("user_id", "event_id"), "user_id", "event_id", 20)


# Capture: changes are each event against the same document's event before it.

def changes(spark: SparkSession, d: str) -> DataFrame:
    log = fx.changelog(spark, d, old_data=True)
    path = F.concat(F.lit("users/"), "document_id")
    return log.select("timestamp", "event_id", path.alias("after_path"), path.alias("before_path"), F.col("old_data").alias("before"), F.col("data").alias("after"))


OLD = f"WITH {CHANGELOG}, o AS (SELECT *, CASE WHEN operation <> 'CREATE' THEN lag(value) OVER (PARTITION BY document_name ORDER BY timestamp, event_id) END AS old_value FROM changelog), c AS (SELECT *, CASE WHEN value IS NULL THEN 'DELETE' WHEN old_value IS NULL THEN 'CREATE' ELSE 'UPDATE' END AS change FROM o)"


@query("P01", f"{OLD} SELECT event_id, change FROM c")
def change_types(spark: SparkSession, d: str) -> DataFrame:
    return changes(spark, d).select("event_id", capture.change_type(F.col("before"), F.col("after")).alias("change"))


@query("P02", "SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS document_id FROM events")
def document_ids(spark: SparkSession, d: str) -> DataFrame:
    e = fx.table(spark, d, "events")
    path = F.concat(F.lit("users/"), F.col("user_id").cast("string"))
    after = F.when(F.col("event_type") != "error", path)
    return e.select(F.col("event_id").cast("string").alias("event_id"), paths.document_id(path, after).alias("document_id"))


@query("P03", f"WITH {TREE} SELECT path, 'projects/p/databases/d/documents/' || path AS document_name FROM tree")
def document_names(spark: SparkSession, d: str) -> DataFrame:
    return fx.tree(spark, d).select("path", paths.document_name("p", "d", F.col("path")).alias("document_name"))


@query("P04", f"{OLD} SELECT event_id, value AS new_value, CASE WHEN change <> 'CREATE' THEN old_value END AS old_value FROM c")
def payloads(spark: SparkSession, d: str) -> DataFrame:
    data, old = capture.select_payload(F.col("before"), F.col("after"))
    value = lambda c: json_scalar(parsed(c), ["value"]).cast("double")
    return changes(spark, d).select("event_id", value(data).alias("new_value"), value(old).alias("old_value"))


@query("P05", """SELECT c_custkey, c_name AS name, c_custkey % 2 = 0 AS even, TRUE AS keeps_null, FALSE AS has_bytes,
    '{"tags":{"a":{"n":' || c_custkey || '}},"blobs":{},"lists":[[{"n":' || c_custkey || '},{"n":null}],[]],"pages":[[],[]]}' AS nested FROM customer""")
def serialized(spark: SparkSession, d: str) -> DataFrame:
    """Documents with bytes as a field, in maps, in structs within maps and lists, and in lists of lists."""
    raw = F.encode("c_name", "UTF-8")
    pair = lambda n: F.struct(n.alias("n"), raw.alias("raw"))
    key = F.col("c_custkey")
    lists = F.array(F.array(pair(key), pair(F.nullif(key, key))), F.array_except(F.array(pair(key)), F.array(pair(key))))
    nested = F.struct(
        F.create_map(F.lit("a"), pair(key)).alias("tags"), F.create_map(F.lit("raw"), raw).alias("blobs"), lists.alias("lists"), F.array(F.array(raw), F.array(raw, raw)).alias("pages")
    )
    doc = F.struct(F.col("c_name").alias("name"), (key % 2 == 0).alias("even"), F.lit(None).cast("string").alias("none"), raw.alias("raw"), nested.alias("nested"))
    rows = fx.table(spark, d, "customer").select("c_custkey", doc.alias("doc"))
    v = rows.select("c_custkey", capture.serialize_document(rows, "doc").alias("j")).select("*", parsed("j").alias("v"))
    return v.select(
        "c_custkey", json_scalar(F.col("v"), ["name"]).alias("name"), json_scalar(F.col("v"), ["even"]).cast("boolean").alias("even"), F.contains(F.schema_of_variant("v"), F.lit("none: VOID")).alias("keeps_null"),
        F.contains(F.schema_of_variant("v"), F.lit("raw")).alias("has_bytes"), F.regexp_extract("j", '"nested":(.*)[}]$', 1).alias("nested"),
    )


@query("P06", "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer FROM orders")
def params(spark: SparkSession, d: str) -> DataFrame:
    t = fx.order_docs(spark, d).select("path", "document_id")
    p = F.to_json(paths.path_params("customers/{customer}/orders/{documentId}", F.col("path")))
    return t.select(F.col("document_id").cast("bigint").alias("o_orderkey"), F.get_json_object(p, "$.customer").alias("customer"))


@query("P07", f"WITH {TREE} SELECT path FROM tree WHERE path LIKE 'regions/%/nations/%/suppliers/%'")
def template_matches(spark: SparkSession, d: str) -> DataFrame:
    t = fx.tree(spark, d)
    return t.where(paths.matches_template("regions/{r}/nations/{n}/suppliers", F.col("path"))).select("path")


@query("P08", f"WITH {TREE} SELECT path, path AS relative FROM tree")
def relative(spark: SparkSession, d: str) -> DataFrame:
    return fx.tree(spark, d).select("path", paths.relative_path(F.concat(F.lit(fx.ROOT), "path")).alias("relative"))


@query("P09", "SELECT o_orderkey, epoch_us(CAST(o_orderdate AS TIMESTAMP)) AS placed_us, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS placed_day FROM orders")
def partition_values(spark: SparkSession, d: str) -> DataFrame:
    o = fx.order_docs(spark, d)
    value = lambda kind: capture.partition_value(F.col("data"), F.lit(None).cast("string"), F.col("operation"), "placed", kind)
    return o.select(F.col("document_id").cast("bigint").alias("o_orderkey"), F.unix_micros(value("timestamp")).alias("placed_us"), value("date").cast("string").alias("placed_day"))


@query("P13", f"WITH {CHANGELOG} SELECT event_id, lower(operation) AS operation FROM changelog")
def transformed(spark: SparkSession, d: str) -> DataFrame:
    hook = lambda df: df.withColumn("operation", F.lower("operation"))
    return capture.user_transform(fx.changelog(spark, d).select("event_id", "operation"), hook)


@query("P17", "SELECT CAST(o_orderkey AS VARCHAR) AS document_id FROM orders WHERE o_custkey = 7")
def by_param(spark: SparkSession, d: str) -> DataFrame:
    rows = capture.import_collection(fx.order_docs(spark, d), "demo", "customers/{customer}/orders", group=True)
    return latest.filter_path_param(rows, "customer", "7").select("document_id")


@query("P18", f"WITH {CHANGELOG} SELECT {SHOWN} FROM changelog WHERE CAST(timestamp AS DATE) = DATE '2024-01-05'")
def by_partition(spark: SparkSession, d: str) -> DataFrame:
    log = fx.changelog(spark, d).withColumn("day", F.to_date("timestamp"))
    return shown(latest.filter_partition(log, "day", "2024-01-05"))


@query("P19", "SELECT p_partkey FROM part WHERE p_brand LIKE '%#1%' AND p_brand <> 'Brand#12'")
def allowed(spark: SparkSession, d: str) -> DataFrame:
    o = fx.objects(spark, d)
    folder = F.concat(F.lit("/"), paths.dir_name(F.col("name")))
    return o.where(paths.path_allowed(folder, ["/img/Brand-1*"], ["/img/Brand-12"])).select(F.col("object_id").alias("p_partkey"))


@query("P21", "SELECT p_partkey, '/img/' || replace(p_brand, '#', '-') AS posix FROM part")
def posix(spark: SparkSession, d: str) -> DataFrame:
    p = fx.table(spark, d, "part")
    path = F.concat(F.lit("C:\\img\\"), F.replace("p_brand", F.lit("#"), F.lit("-")))
    return p.select("p_partkey", paths.posix_path(path, drop_drive=True).alias("posix"))


@query("S03", "SELECT 'projects/demo/databases/(default)/documents/customers/' || o_custkey || '/orders/' || o_orderkey AS document_name, CAST(o_orderkey AS VARCHAR) AS document_id, 'IMPORT' AS operation, '' AS event_id, CAST(0 AS BIGINT) AS ts_us, CAST(o_custkey AS VARCHAR) AS customer FROM orders")
def imported(spark: SparkSession, d: str) -> DataFrame:
    rows = capture.import_collection(fx.order_docs(spark, d), "demo", "customers/{customer}/orders", group=True)
    return rows.select("document_name", "document_id", "operation", "event_id", F.unix_micros("timestamp").alias("ts_us"), F.get_json_object("path_params", "$.customer").alias("customer"))


@query("S04", f"WITH {TREE} SELECT path, 'group' AS how FROM tree WHERE path LIKE 'customers/%/orders/%' UNION ALL SELECT path, 'collection' FROM tree WHERE regexp_matches(path, '^regions/1/nations/[^/]+$')")
def scans(spark: SparkSession, d: str) -> DataFrame:
    t = fx.tree(spark, d)
    group = capture.scan_collection_group(t, "orders").select("path", F.lit("group").alias("how"))
    return group.unionByName(capture.scan_collection(t, "regions/1/nations").select("path", F.lit("collection").alias("how")))


@query("S05", f"WITH {TREE} SELECT path FROM tree WHERE path >= 'customers/2' AND path < 'customers/5' ORDER BY path LIMIT 100")
def range_scan(spark: SparkSession, d: str) -> DataFrame:
    return capture.scan_path_range(fx.tree(spark, d), "customers/2", "customers/5", 100).select("path")


@query("S06", f"WITH {TREE} SELECT path FROM tree WHERE path > 'customers/5'")
def resumed(spark: SparkSession, d: str) -> DataFrame:
    return capture.resume_after(fx.tree(spark, d), "customers/5").select("path")


@query("S07", "SELECT CAST(event_id AS VARCHAR) AS insert_id, 'quota' AS error_details FROM events WHERE event_type = 'error'")
def dead(spark: SparkSession, d: str) -> DataFrame:
    failed = fx.changelog(spark, d).where("operation = 'DELETE'")
    return tables.dead_letter(failed, "quota").select("insert_id", "error_details")


@query("S09", "SELECT 'x.v1.onError' AS type, CAST(event_id AS VARCHAR) AS subject FROM events WHERE event_type = 'error' UNION ALL SELECT 'x.v1.onSuccess', CAST(event_id AS VARCHAR) FROM events WHERE event_type NOT IN ('error', 'click')")
def lifecycle(spark: SparkSession, d: str) -> DataFrame:
    e = fx.table(spark, d, "events")
    phase = F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "click", "start").otherwise("success")
    rows = e.select(phase.alias("phase"), F.col("event_id").cast("string").alias("subject"), F.col("props").alias("data"))
    return capture.lifecycle_events(rows, "x.v1", ["x.v1.onError", "x.v1.onSuccess"]).select("type", "subject")


@query("S12", f"WITH {CHANGELOG} SELECT event_id, CAST(NULL AS VARCHAR) AS old_data, document_id, CAST(NULL AS VARCHAR) AS path_params FROM changelog")
def evolved(spark: SparkSession, d: str) -> DataFrame:
    return tables.evolve_changelog(fx.changelog(spark, d), "placed").select("event_id", "old_data", "document_id", "path_params")


@query("S13", "SELECT coalesce(c.c_custkey, k) AS c_custkey, CASE WHEN k % 8 = 0 THEN 'new' ELSE c_name END AS c_name, CASE WHEN k IS NOT NULL THEN k % 5 END AS extra, CASE WHEN k % 8 = 4 THEN NULL ELSE c_nationkey END AS nation, CASE WHEN k % 8 = 0 THEN 0 ELSE c_acctbal END AS balance, CASE WHEN k IS NOT NULL THEN 'x' END AS tag, CASE WHEN c.c_custkey IS NOT NULL THEN 'kept' END AS kept FROM customer c FULL JOIN (SELECT c_custkey AS k FROM customer WHERE c_custkey % 4 = 0 UNION ALL SELECT -1) u ON c.c_custkey = k")
def merged(spark: SparkSession, d: str) -> DataFrame:
    """Columns and nested fields: an update sets a leaf beside others that stay, sets one to null, and leaves the rest."""
    source = fx.table(spark, d, "customer")
    k = F.col("c_custkey")
    account = F.struct(F.col("c_acctbal").cast("double").alias("balance"), F.col("c_nationkey").cast("long").alias("nation"))
    c = source.select("c_custkey", "c_name", F.parse_json(F.to_json(F.struct(account.alias("account"), F.lit("kept").alias("kept")))).alias("data"))
    u = source.where(k % 4 == 0).select("c_custkey").unionByName(spark.range(1).select(F.lit(-1).cast(source.schema["c_custkey"].dataType).alias("c_custkey")))
    change = F.when(F.pmod(k, F.lit(8)) == 0, F.lit('{"account": {"balance": 0}, "tag": "x"}')).when(F.pmod(k, F.lit(8)) == 4, F.lit('{"account": {"nation": null}, "tag": "x"}')).otherwise(F.lit('{"tag": "x"}'))
    u = u.select("c_custkey", F.when(F.pmod(k, F.lit(8)) == 0, "new").alias("c_name"), (k % 5).alias("extra"), F.parse_json(change).alias("data"))
    made = tables.merge_documents(c, u, "c_custkey")
    got = lambda path, kind: F.try_variant_get("data", path, kind)
    return made.select("c_custkey", "c_name", "extra", got("$.account.nation", "long").alias("nation"), got("$.account.balance", "double").alias("balance"), got("$.tag", "string").alias("tag"), got("$.kept", "string").alias("kept"))


@query("A06", "SELECT count(*) AS imports FROM orders")
def imports(spark: SparkSession, d: str) -> DataFrame:
    rows = capture.import_collection(fx.order_docs(spark, d), "demo", "orders")
    return retention.count_imports(capture.union_imports(fx.changelog(spark, d), rows))


@query("A07", f"WITH {TREE}, c AS (SELECT regexp_replace(regexp_replace(path, '/[^/]*$', ''), '/[0-9]+', '', 'g') AS collection, owner FROM tree) SELECT collection, count(*) AS n_before, count(*) FILTER (WHERE owner IS NULL OR owner <> '7') AS n_after, count(*) FILTER (WHERE owner IS NULL OR owner <> '7') - count(*) AS difference FROM c GROUP BY 1")
def reconciled(spark: SparkSession, d: str) -> DataFrame:
    t = fx.tree(spark, d).withColumn("collection", F.regexp_replace(paths.collection_path(F.col("path")), "/[0-9]+", ""))
    return retention.reconcile_counts(t, t.where("owner is null or owner <> '7'"))


@query("J12", f"WITH {TREE} SELECT path, owner FROM tree WHERE path IN (SELECT 'customers/' || o_custkey || '/orders/' || o_orderkey FROM orders WHERE o_orderkey % 11 = 0)")
def by_paths(spark: SparkSession, d: str) -> DataFrame:
    wanted = fx.order_docs(spark, d).where(F.col("document_id").cast("bigint") % 11 == 0).select("path")
    return named.docs_by_path(fx.tree(spark, d), wanted)


@query("U03", f"WITH {CHANGELOG} SELECT operation, count(*) AS n FROM (SELECT operation FROM changelog UNION ALL SELECT 'IMPORT' FROM orders) GROUP BY 1")
def both_logs(spark: SparkSession, d: str) -> DataFrame:
    rows = capture.import_collection(fx.order_docs(spark, d), "demo", "orders")
    return capture.union_imports(fx.changelog(spark, d), rows).groupBy("operation").agg(F.count("*").alias("n"))


@query("Q09", f"WITH {TREE} SELECT * FROM (SELECT path, 'first' AS how FROM tree ORDER BY path LIMIT 50) UNION ALL SELECT * FROM (SELECT path, 'sample' FROM tree ORDER BY md5('7:' || path) < md5('7'), md5('7:' || path), path LIMIT 50)")
def few_docs(spark: SparkSession, d: str) -> DataFrame:
    t = fx.tree(spark, d)
    first = retention.limit_first(t, 50).select("path", F.lit("first").alias("how"))
    return first.unionByName(retention.sample_docs(t, 50, 7).select("path", F.lit("sample").alias("how")))


@query("F18", "SELECT o_orderkey, epoch_us(CAST(o_orderdate AS TIMESTAMP) + INTERVAL 2 WEEK) AS weeks_us, epoch_us(CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 MONTH) AS month_us FROM orders")
def expiry(spark: SparkSession, d: str) -> DataFrame:
    at = F.col("o_orderdate").cast("timestamp")
    return fx.table(spark, d, "orders").select("o_orderkey", F.unix_micros(expire_at(at, "week", 2)).alias("weeks_us"), F.unix_micros(expire_at(at, "month", 1)).alias("month_us"))


@query("F20", f"WITH {TREE} SELECT path, 'document' AS kind FROM tree UNION ALL SELECT regexp_replace(path, '/[^/]*$', ''), 'collection' FROM tree")
def kinds(spark: SparkSession, d: str) -> DataFrame:
    t = fx.tree(spark, d).select("path")
    every = t.unionByName(t.select(paths.collection_path(F.col("path")).alias("path")))
    return every.select("path", paths.subtree_kind(F.col("path")).alias("kind"))


# Named queries over typed orders.
ORDERS = "o AS (SELECT o_orderkey AS id, o_orderstatus AS status, CAST(o_totalprice AS DOUBLE) AS total, o_custkey AS cust, [o_orderstatus, o_orderpriority] AS tags FROM orders)"


def typed_orders(spark: SparkSession, d: str) -> DataFrame:
    o = fx.table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").cast("double").alias("total"), F.col("o_custkey").alias("cust"), F.array("o_orderstatus", "o_orderpriority").alias("tags"))


def _named(key: str, conditions: list[dict], sql: str, params: dict | None = None, given: dict | None = None) -> None:
    @query(key, f"WITH {ORDERS} SELECT id, status, total, cust FROM o {sql}")
    def run(spark: SparkSession, d: str) -> DataFrame:
        return named.named_query(typed_orders(spark, d), {"conditions": conditions, "params": params or {}}, given).select("id", "status", "total", "cust")


_named("N01", [{"where": ["total", ">=", "$least"]}, {"where": ["status", "!=", "F"]}], "WHERE total >= 100000 AND status <> 'F'", {"least": {"type": "float", "required": True}}, {"least": "100000"})
_named("N02", [{"where": ["tags", "array-contains", "O"]}, {"where": ["tags", "array-contains-any", "1-URGENT,2-HIGH"]}], "WHERE list_contains(tags, 'O') AND list_has_any(tags, ['1-URGENT', '2-HIGH'])")
_named("N03", [{"where": ["cust", "in", "1,2,3,4,5,6,7,8,9"]}, {"where": ["status", "not-in", "F,P"]}], "WHERE cust BETWEEN 1 AND 9 AND status NOT IN ('F', 'P')")
_named("N05", [{"orderBy": ["total", "desc"]}], "WHERE total IS NOT NULL")
_named("N06", [{"orderBy": ["id", "asc"]}, {"offset": 20}, {"limit": 30}], "ORDER BY id LIMIT 30 OFFSET 20")
_named("N07", [{"orderBy": ["id", "asc"]}, {"limitToLast": 25}], "ORDER BY id DESC LIMIT 25")
_named("N08", [{"orderBy": ["cust", "asc"]}, {"orderBy": ["id", "desc"]}, {"startAfter": [10, 500]}, {"endAt": [90]}], "WHERE (cust > 10 OR (cust = 10 AND id < 500)) AND cust <= 90")


@query("P14", "SELECT o_orderkey, o_orderstatus FROM orders")
def excepted(spark: SparkSession, d: str) -> DataFrame:
    from docflow.operators.views import except_columns

    o = fx.table(spark, d, "orders")
    return except_columns(o, [c for c in o.columns if c not in ("o_orderkey", "o_orderstatus")])


@query("X02", f"WITH {CHANGELOG} SELECT event_id, value * 2 AS doubled FROM changelog WHERE value IS NOT NULL")
def hooked(spark: SparkSession, d: str) -> DataFrame:
    """A user's hook in batches: it gets rows and returns rows."""

    def fn(batches):
        for b in batches:
            v = b["data"].map(lambda x: None if x is None else json.loads(x)["value"])
            yield b.assign(doubled=v.astype("float64") * 2)[["event_id", "doubled"]]

    log = fx.changelog(spark, d).select("event_id", "data").where("data is not null")
    return capture.user_transform(log, lambda df: df.mapInPandas(fn, "event_id string, doubled double")).where("doubled is not null")


@query("F21", "SELECT DISTINCT 'counters/' || event_type AS counter FROM events")
def counter_paths(spark: SparkSession, d: str) -> DataFrame:
    return fx.shards(spark, d).select(paths.counter_path(F.col("shard_path")).alias("counter")).distinct()


@query("F04", "SELECT CAST(o_orderkey AS VARCHAR) AS document_id, CAST(o_totalprice AS DECIMAL(38, 9)) AS total FROM orders")
def numbers(spark: SparkSession, d: str) -> DataFrame:
    return fx.order_docs(spark, d).select("document_id", doc_number(parsed("data"), ["total"]).alias("total"))
