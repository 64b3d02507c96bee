"""Document fixtures derived by Spark from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ROOT = "projects/demo/databases/(default)/documents/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def changelog(spark: SparkSession, sf_dir: str, old_data: bool = False) -> DataFrame:
    """events as a changelog of users; old_data, which needs a window, only on demand."""
    e = table(spark, sf_dir, "events")
    operation = F.when(F.col("event_type") == "signup", "CREATE").when(F.col("event_type") == "error", "DELETE").otherwise("UPDATE")
    k = F.get_json_object("props", "$.k").cast("bigint").alias("k")
    payload = F.when(F.col("event_type") != "error", F.to_json(F.struct("value", "event_type", k)))
    log = e.select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(F.lit(f"{ROOT}users/"), F.col("user_id").cast("string")).alias("document_name"),
        operation.alias("operation"),
        payload.alias("data"),
        F.col("user_id").cast("string").alias("document_id"),
    )
    if old_data:
        w = Window.partitionBy("document_name").orderBy("timestamp", "event_id")
        log = log.withColumn("old_data", F.when(F.col("operation") != "CREATE", F.lag("data").over(w)))
    return log


def tied(log: DataFrame) -> DataFrame:
    """The changelog with timestamps cut to the day."""
    return log.withColumn("timestamp", F.date_trunc("day", "timestamp"))


def with_null_times(log: DataFrame) -> DataFrame:
    return log.withColumn("timestamp", F.when(F.col("event_id").cast("bigint") % 7 != 0, F.col("timestamp")))


def order_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their lines as documents: path, document_id, timestamp, operation, data."""
    lines = table(spark, sf_dir, "lineitem")
    item = F.struct("l_linenumber", F.col("l_partkey").alias("part"), F.col("l_quantity").cast("double").alias("qty"), F.col("l_returnflag").alias("flag"))
    lines = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(item)).alias("l"))
    d = table(spark, sf_dir, "orders").join(lines, "o_orderkey", "left")
    seconds = F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    doc = F.struct(
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total"),
        (F.col("o_orderkey") % 2 == 0).alias("even"),
        F.struct(seconds.alias("_seconds"), F.lit(0).alias("_nanoseconds")).alias("placed"),
        F.transform("l", lambda x: x["part"]).alias("items"),
        F.transform("l", lambda x: F.struct(x["part"].alias("part"), x["qty"].alias("qty"))).alias("lines"),
        F.struct(F.col("o_orderpriority").alias("priority"), F.struct(F.col("o_custkey").alias("cust")).alias("by")).alias("ship"),
        F.struct((F.col("o_custkey") % 90).alias("_latitude"), (F.col("o_custkey") % 180).alias("_longitude")).alias("loc"),
        F.lit(None).cast("string").alias("note"),
    )
    path = F.concat(F.lit("customers/"), F.col("o_custkey").cast("string"), F.lit("/orders/"), F.col("o_orderkey").cast("string"))
    return d.select(
        path.alias("path"),
        F.concat(F.lit(ROOT), path).alias("document_name"),
        F.col("o_orderkey").cast("string").alias("document_id"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        F.lit("CREATE").alias("operation"),
        F.to_json(doc, {"ignoreNullFields": "false"}).alias("data"),
    )


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document paths of nations, suppliers and orders, with an owner field: path, owner."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nations = nation.select(F.concat_ws("/", F.lit("regions"), "n_regionkey", F.lit("nations"), "n_nationkey").alias("path"), F.lit(None).cast("string").alias("owner"))
    suppliers = supplier.join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))  # 25 nations
    suppliers = suppliers.select(F.concat_ws("/", F.lit("regions"), "n_regionkey", F.lit("nations"), "n_nationkey", F.lit("suppliers"), "s_suppkey").alias("path"), F.lit(None).cast("string").alias("owner"))
    orders = table(spark, sf_dir, "orders").select(F.concat_ws("/", F.lit("customers"), "o_custkey", F.lit("orders"), "o_orderkey").alias("path"), (F.col("o_orderkey") % 1000).cast("string").alias("owner"))
    return nations.unionByName(suppliers).unionByName(orders)


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter shards of events: shard_path and nested data.

    Beside hits, stats.k and a label there are a leaf eight levels down, a name with a dot beside the
    same path, and a field that is a number or an object by the user's parity.
    """
    e = table(spark, sf_dir, "events")
    k = F.coalesce(F.get_json_object("props", "$.k").cast("bigint"), F.lit(0).cast("bigint"))
    g = e.groupBy("event_type", "user_id").agg(F.count("*").alias("hits"), F.sum(k).alias("k"))
    deep = F.col("hits")
    for name in "hgfedcb":
        deep = F.struct(deep.alias(name))
    even = F.col("user_id") % 2 == 0
    plain = F.to_json(F.struct("hits", F.struct(F.col("k").alias("k")).alias("stats"), F.col("event_type").alias("label"), deep.alias("deep"), F.col("hits").alias("x.y"), F.struct(F.lit(1).alias("y")).alias("x")))
    flip = F.when(even, F.lit('"flip":2')).otherwise(F.lit('"flip":{"n":3}'))
    data = F.concat(F.lit("{"), flip, F.lit(","), F.substring(plain, 2, 1 << 30))
    path = F.concat(F.lit("counters/"), F.col("event_type"), F.lit("/_counter_shards_/"), F.lpad(F.lower(F.hex("user_id")), 8, "0"))
    return g.select(path.alias("shard_path"), data.alias("data"))


def partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial shards of lines: shard_path and data {_updates_: [{_id_, _data_}]}, one for each flag and line number."""
    li = table(spark, sf_dir, "lineitem")
    g = li.groupBy("l_returnflag", "l_linenumber", (F.col("l_orderkey") % 12).alias("u")).agg(F.count("*").alias("hits"), F.sum("l_quantity").cast("bigint").alias("k"))
    one = F.struct(F.col("u").cast("string").alias("_id_"), F.struct("hits", F.struct("k").alias("stats")).alias("_data_"))
    g = g.groupBy("l_returnflag", "l_linenumber").agg(F.array_sort(F.collect_list(one), lambda a, b: F.when(a["_id_"] < b["_id_"], -1).when(a["_id_"] > b["_id_"], 1).otherwise(0)).alias("_updates_"))
    path = F.concat(F.lit("counters/"), "l_returnflag", F.lit("/_counter_shards_/"), F.lpad(F.col("l_linenumber").cast("string"), 5, "\t"))
    return g.select(path.alias("shard_path"), F.to_json(F.struct("_updates_")).alias("data"))


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored objects of parts: name, contentType, contentEncoding, contentDisposition, cacheControl, metadata."""
    p = table(spark, sf_dir, "part")
    ext = F.element_at(F.array(F.lit("png"), F.lit("jpg"), F.lit("txt")), (F.col("p_size") % 3 + 1).cast("int"))
    kind = F.element_at(F.array(F.lit("image/png"), F.lit("image/jpeg"), F.lit("text/plain")), (F.col("p_size") % 3 + 1).cast("int"))
    name = F.concat(F.lit("img/"), F.replace("p_brand", F.lit("#"), F.lit("-")), F.lit("/"), F.col("p_partkey").cast("string"), F.lit("."), ext)
    meta = F.map_filter(
        F.create_map(F.lit("resizedImage"), F.when(F.col("p_size") % 10 == 0, "true"), F.lit("resizeFailed"), F.when(F.col("p_size") % 11 == 0, "true"), F.lit("owner"), F.col("p_brand")),
        lambda _, v: v.isNotNull(),
    )
    return p.select(
        F.col("p_partkey").alias("object_id"),
        name.alias("name"),
        kind.alias("contentType"),
        F.when(F.col("p_size") % 13 == 0, "gzip").alias("contentEncoding"),
        F.concat(F.lit("inline; filename*=utf-8''"), F.col("p_partkey").cast("string"), F.lit(".x")).alias("contentDisposition"),
        F.lit("private").alias("cacheControl"),
        meta.alias("metadata"),
        F.col("p_size").alias("size"),
    )


def _texts(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    langs = F.when(F.col("doc_id") % 5 == 0, F.array(F.lit("it"), F.lit("en"), F.lit("it")))
    existing = F.when(F.col("doc_id") % 3 == 0, F.create_map(F.lit("fr"), F.lit("kept"))).otherwise(F.create_map().cast("map<string,string>"))
    return d.select("doc_id", F.col("text").alias("input"), langs.alias("languages"), existing.alias("existing"), *more)


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to translate: doc_id, input, languages, existing (map)."""
    return _texts(spark, sf_dir)


def texts_or_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """texts, the input a VARIANT: for every third document of two an object with a title, the body, and a number; existing a map of maps."""
    t = _texts(spark, sf_dir, "source")
    nested = F.col("doc_id") % 6 == 3
    fields = F.to_variant_object(F.struct(F.col("source").alias("title"), F.col("input").alias("body"), F.col("doc_id").alias("n")))
    had = F.when(F.size("existing") > 0, F.create_map(F.when(nested, "body").otherwise(""), "existing"))
    return t.select("doc_id", F.when(nested, fields).otherwise(F.col("input").cast("variant")).alias("input"), "languages", had.alias("existing"))


def link_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL fields before and after a change: page_id, before, after."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    r = F.col("page_id") % 4
    return p.select("page_id", F.when(r != 3, F.col("url")).alias("before"), F.when(r == 0, F.col("url")).when(r == 1, F.concat("url", F.lit("&v=2"))).when(r == 3, F.col("url")).alias("after"))


def mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as mail queue documents, some of them invalid."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    text = lambda x: x.cast("string")
    uids = F.when(k % 5 != 4, F.array(text(c), F.lit("nobody"), text(c + 1)))
    template = F.when(k % 3 == 0, F.struct(F.element_at(F.array(F.lit("receipt"), F.lit("notice"), F.lit("gone")), (k % 3 + k % 4 % 3 + 1).cast("int")).alias("name"), F.create_map(F.lit("status"), "o_orderstatus", F.lit("total"), F.lit("<5>")).alias("data")))
    message = F.when(
        (k % 3 != 0) | (k % 2 == 0),
        F.struct(F.when(k % 7 != 0, F.concat(F.lit("Order "), text(k))).alias("subject"), F.when(k % 2 == 0, F.lit("plain")).alias("text"), F.when(k % 11 == 0, F.lit("<b>rich</b>")).alias("html")),
    )
    state = F.element_at(F.array(F.lit(None), F.lit("PENDING"), F.lit("PROCESSING"), F.lit("RETRY"), F.lit("SUCCESS"), F.lit("ERROR")), (k % 6 + 1).cast("int"))
    lease = F.when(k % 6 == 2, F.col("o_orderdate").cast("timestamp"))
    return o.select(
        k.alias("mail_id"),
        F.when(k % 4 == 0, F.array(F.concat(F.lit("To-"), text(c), F.lit("@x.org")))).alias("to"),
        F.when(k % 9 == 0, F.array(F.lit("CC@x.org"), F.lit("cc@x.org"))).alias("cc"),
        F.lit(None).cast("array<string>").alias("bcc"),
        uids.alias("toUids"),
        F.when(k % 8 == 0, F.array(text(c + 2))).alias("ccUids"),
        F.lit(None).cast("array<string>").alias("bccUids"),
        message.alias("message"),
        template.alias("template"),
        F.when(state.isNotNull(), F.struct(state.alias("state"), F.lit(0).alias("attempts"), lease.alias("leaseExpireTime"), F.lit(None).cast("string").alias("error"), (F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 9 DAYS")).alias("expireAt"))).alias("delivery"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as users with an email; some have none."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    email = F.when(F.col("c_custkey") % 6 == 0, "").otherwise(F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@x.org")))
    return c.select(F.col("c_custkey").cast("string").alias("uid"), email.alias("email"), "c_name")


def templates(spark: SparkSession) -> DataFrame:
    """Three mail templates and a partial; a fixed dimension of four rows."""
    rows = [
        ("receipt", False, "Receipt {{status}}", "<p>{{total}} {{{total}}} {{> foot}}</p>", "{{total}}"),
        ("notice", False, None, "<i>{{missing}}{{status}}</i>", ""),
        ("foot", True, None, "<hr>{{status}}", "--"),
    ]
    return spark.createDataFrame(rows, "name string, partial boolean, subject string, html string, text string")
