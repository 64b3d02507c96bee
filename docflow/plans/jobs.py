"""Queries of counters, erasure, enrichment, objects, mail and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docflow import fixtures as fx
from docflow.functions.extract import parsed
from docflow.operators import counters, enrich, erase, latest, mail, objects
from docflow.plans.changelog import CHANGELOG, TREE, shown
from docflow.plans.registry import query
from docflow.plans.runs import landing, run_stream

# Counters. Shards are (event_type, user); partials are (returnflag, line number).
SHARDS = "s AS (SELECT event_type, user_id, count(*) AS hits, CAST(sum(coalesce(CAST(json_extract_string(props, '$.k') AS BIGINT), 0)) AS BIGINT) AS k FROM events GROUP BY 1, 2)"
PARTIALS = "p AS (SELECT l_returnflag AS f, l_linenumber AS n, l_orderkey % 12 AS u, count(*) AS hits, CAST(sum(l_quantity) AS BIGINT) AS k FROM lineitem GROUP BY 1, 2, 3)"


# Of the field that is a number for even users and an object for odd ones, what the last kind gave counts.
TURNS = "w AS (SELECT *, max(user_id) FILTER (WHERE user_id % 2 = 0) OVER (PARTITION BY event_type) AS even, max(user_id) FILTER (WHERE user_id % 2 = 1) OVER (PARTITION BY event_type) AS odd FROM s)"


def _leaf_rows(source: str, counter: str) -> str:
    return f"SELECT 'counters/' || {counter} AS counter, 'hits' AS leaf, hits AS value FROM {source} UNION ALL SELECT 'counters/' || {counter}, 'stats/k', k FROM {source}"


SHARD_MORE = "SELECT 'counters/' || event_type AS counter, 'deep/b/c/d/e/f/g/h' AS leaf, hits AS value FROM s UNION ALL SELECT 'counters/' || event_type, 'x.y', hits FROM s UNION ALL SELECT 'counters/' || event_type, 'x/y', 1 FROM s"
FLIPS = "SELECT 'counters/' || event_type AS counter, CASE WHEN user_id % 2 = 0 THEN 'flip' ELSE 'flip/n' END AS leaf, CASE WHEN user_id % 2 = 0 THEN 2 ELSE 3 END AS value FROM "
ALL_SHARD_ROWS = f"{_leaf_rows('s', 'event_type')} UNION ALL {SHARD_MORE} UNION ALL {FLIPS} s"
SHARD_ROWS = f"{_leaf_rows('s', 'event_type')} UNION ALL {SHARD_MORE} UNION ALL {FLIPS} w WHERE user_id > coalesce(CASE WHEN user_id % 2 = 0 THEN odd ELSE even END, -1)"
PARTIAL_ROWS = _leaf_rows("p", "f")
SHARDS = f"{SHARDS}, {TURNS}"


def slashed(rows: DataFrame) -> DataFrame:
    """Leaves as text for comparison."""
    return rows.withColumn("leaf", F.array_join("leaf", "/"))


def stored(spark: SparkSession, d: str) -> DataFrame:
    """Stored counters of each event type: hits 10, a field of its own, and a number where shards hold an object."""
    e = fx.table(spark, d, "events").select(F.concat(F.lit("counters/"), "event_type").alias("counter")).distinct()
    held = [(["hits"], 10.0), (["kept"], 5.0), (["stats"], 7.0)]
    return e.select("counter", F.inline(F.array(*(F.struct(F.lit(n).alias("leaf"), F.lit(v).alias("value")) for n, v in held))))


STORED = "c AS (SELECT DISTINCT 'counters/' || event_type AS counter, unnest(['hits', 'kept']) AS leaf FROM events), c2 AS (SELECT counter, leaf, CASE leaf WHEN 'hits' THEN 10.0 ELSE 5.0 END AS value FROM c)"


def unreadable(spark: SparkSession, d: str) -> DataFrame:
    """Shards of each event type: broken JSON, one nested 20,000 deep, a number of 400 digits beside one that counts, and one nested 50 deep."""
    e = fx.table(spark, d, "events").select("event_type").distinct()
    deep = lambda n: F.concat(F.repeat(F.lit('{"d":'), n), F.lit("1"), F.repeat(F.lit("}"), n))
    data = F.array(F.lit('{"hits":'), deep(20_000), F.concat(F.lit('{"long":'), F.repeat(F.lit("9"), 400), F.lit(',"more":1}')), deep(50))
    path = F.concat(F.lit("counters/"), "event_type", F.lit("/_counter_shards_/zz"), F.col("n").cast("string"))
    return e.select("event_type", F.posexplode(data).alias("n", "data")).select(path.alias("shard_path"), "data")


MORE_SHARDS = "SELECT DISTINCT 'counters/' || event_type AS counter, unnest(['more', repeat('d/', 49) || 'd']) AS leaf, 1 AS value FROM events"


@query("A08", f"WITH {SHARDS} SELECT counter, leaf, CAST(sum(value) AS DOUBLE) AS value FROM ({SHARD_ROWS} UNION ALL {MORE_SHARDS} UNION ALL SELECT DISTINCT 'counters/' || event_type, unnest(['not read', 'in store']), unnest([3, 5]) FROM events) GROUP BY 1, 2")
def summed(spark: SparkSession, d: str) -> DataFrame:
    """Sums of all that can be read, how many shards of a counter could not be, in whole or in part, and how many are in store after that.

    Two shards of each counter come while the others are summed.
    """
    shards = fx.shards(spark, d).unionByName(unreadable(spark, d))
    came = fx.table(spark, d, "events").select("event_type").distinct().select("event_type", F.explode(F.array(F.lit("1"), F.lit("2"))).alias("n"))
    came = came.select(F.concat(F.lit("counters/"), "event_type", F.lit("/_counter_shards_/new"), "n").alias("shard_path"), F.lit('{"hits":1}').alias("data"))
    unread = counters.unread(shards)
    lost = unread.groupBy("counter").agg(F.countDistinct("shard_path").cast("double").alias("value"))
    stays = counters.remaining(shards.unionByName(came), shards, unread).groupBy(counters.counter_path(F.col("shard_path")).alias("counter")).agg(F.count("*").cast("double").alias("value"))
    sums = slashed(counters.sum_leaves(counters.drop_overridden(counters.shard_leaves(shards))))
    return sums.unionByName(lost.select("counter", F.lit("not read").alias("leaf"), "value")).unionByName(stays.select("counter", F.lit("in store").alias("leaf"), "value"))


@query("A09", f"WITH {PARTIALS} SELECT counter, leaf, CAST(-sum(value) AS DOUBLE) AS value FROM ({PARTIAL_ROWS}) GROUP BY 1, 2")
def subtracted(spark: SparkSession, d: str) -> DataFrame:
    return slashed(counters.subtract_leaves(counters.partial_leaves(fx.partials(spark, d))))


@query("A10", f"WITH {SHARDS}, {STORED} SELECT counter, leaf, CAST(sum(value) AS DOUBLE) AS value FROM ({SHARD_ROWS} UNION ALL SELECT counter, leaf, value FROM c2) GROUP BY 1, 2")
def applied(spark: SparkSession, d: str) -> DataFrame:
    return slashed(counters.apply_counter(stored(spark, d), counters.sum_leaves(counters.drop_overridden(counters.shard_leaves(fx.shards(spark, d))))))


@query("A11", f"WITH {SHARDS}, {PARTIALS}, {STORED} SELECT counter, leaf, CAST(sum(value) AS DOUBLE) AS value FROM ({SHARD_ROWS} UNION ALL {PARTIAL_ROWS} UNION ALL SELECT counter, leaf, value FROM c2) GROUP BY 1, 2")
def aggregated(spark: SparkSession, d: str) -> DataFrame:
    return slashed(counters.aggregate_counters(stored(spark, d), fx.partials(spark, d), fx.shards(spark, d)))


@query("A12", f"WITH {SHARDS}, h AS (SELECT event_type, user_id, hits, k, substr(lpad(lower(to_hex(user_id)), 8, '0'), 1, 4) AS part, max(user_id) FILTER (WHERE user_id % 2 = 0) OVER p AS even, max(user_id) FILTER (WHERE user_id % 2 = 1) OVER p AS odd FROM s WINDOW p AS (PARTITION BY event_type, substr(lpad(lower(to_hex(user_id)), 8, '0'), 1, 4))) SELECT 'counters/' || event_type || '/_counter_shards_/' || lpad(part, 5, chr(9)) AS aggregate, leaf, CAST(sum(value) AS DOUBLE) AS value FROM (SELECT event_type, part, unnest(['hits', 'stats/k', 'deep/b/c/d/e/f/g/h', 'x.y', 'x/y']) AS leaf, unnest([hits, k, hits, hits, 1]) AS value FROM h UNION ALL SELECT event_type, part, CASE WHEN user_id % 2 = 0 THEN 'flip' ELSE 'flip/n' END, CASE WHEN user_id % 2 = 0 THEN 2 ELSE 3 END FROM h WHERE user_id > coalesce(CASE WHEN user_id % 2 = 0 THEN odd ELSE even END, -1)) GROUP BY 1, 2")
def rolled_up(spark: SparkSession, d: str) -> DataFrame:
    return slashed(counters.partial_rollup(fx.shards(spark, d), 4))


@query("A13", f"WITH {PARTIALS}, n AS (SELECT f, n, count(*) AS c FROM p GROUP BY 1, 2) SELECT 'counters/' || f || '/_counter_shards_/' || lpad(CAST(n AS VARCHAR), 5, chr(9)) AS shard_path, c AS n_updates, CASE WHEN c > 10 THEN 'compact' ELSE 'keep' END AS action, CASE WHEN c > 10 THEN leaf END AS leaf, CAST(CASE WHEN c > 10 THEN v END AS DOUBLE) AS value FROM n JOIN (SELECT f, n, unnest(['hits', 'stats/k']) AS leaf, unnest([sum(hits), sum(k)]) AS v FROM p GROUP BY f, n) USING (f, n) WHERE c > 10 OR leaf = 'hits'")
def compacted(spark: SparkSession, d: str) -> DataFrame:
    rows = slashed(counters.compact_partials(fx.partials(spark, d)))
    return rows.withColumn("n_updates", F.col("n_updates").cast("bigint"))


@query("A14", f"WITH {SHARDS}, {PARTIALS}, {STORED} SELECT counter, CAST(sum(CASE WHEN leaf = 'hits' THEN value ELSE 0 END) AS DOUBLE) AS value FROM ({SHARD_ROWS} UNION ALL {PARTIAL_ROWS} UNION ALL SELECT counter, leaf, value FROM c2) GROUP BY 1")
def counter_now(spark: SparkSession, d: str) -> DataFrame:
    return counters.read_counter(stored(spark, d), fx.shards(spark, d), fx.partials(spark, d), "hits")


@query("A15", "SELECT 'counters/' || event_type AS counter, 'stats/n' AS leaf, CAST(count(*) AS DOUBLE) AS value FROM events GROUP BY 1")
def incremented(spark: SparkSession, d: str) -> DataFrame:
    e = fx.table(spark, d, "events").select(F.concat(F.lit("counters/"), "event_type").alias("counter"), F.col("user_id").cast("string").alias("shard"), F.lit("stats.n").alias("field"), F.lit(1).alias("amount"))
    return slashed(counters.sum_leaves(counters.increments(e)))


@query("U01", f"WITH {SHARDS}, {PARTIALS} SELECT counter, leaf, count(*) AS n FROM ({ALL_SHARD_ROWS} UNION ALL {PARTIAL_ROWS}) GROUP BY 1, 2")
def unioned(spark: SparkSession, d: str) -> DataFrame:
    return slashed(counters.union_leaves(fx.shards(spark, d), fx.partials(spark, d))).groupBy("counter", "leaf").agg(F.count("*").alias("n"))


# Erasure. Customers with keys divisible by ten are gone.
def gone(spark: SparkSession, d: str) -> DataFrame:
    return fx.table(spark, d, "customer").where("c_custkey % 10 = 0").select(F.col("c_custkey").cast("string").alias("uid"))


GONE = "gone AS (SELECT CAST(c_custkey AS VARCHAR) AS uid FROM customer WHERE c_custkey % 10 = 0)"
FOUND = """hits AS (
    SELECT split_part(path, '/', 2) AS uid, path, 'x' AS r FROM tree WHERE FALSE
    UNION ALL SELECT split_part(path, '/', -1), path, 'document' FROM tree WHERE split_part(path, '/', -1) IN (SELECT uid FROM gone) AND length(path) - length(replace(path, '/', '')) < 6
    UNION ALL SELECT owner, path, 'field' FROM tree WHERE owner IN (SELECT uid FROM gone) AND length(path) - length(replace(path, '/', '')) < 6
)"""


@query("D01", f"WITH {TREE}, {GONE} SELECT path FROM tree WHERE NOT (path LIKE 'customers/%' AND split_part(path, '/', 2) IN (SELECT uid FROM gone))")
def erased(spark: SparkSession, d: str) -> DataFrame:
    return erase.erase_paths(fx.tree(spark, d), gone(spark, d), "customers/{UID},people/{UID}/x").select("path")


@query("D02", f"WITH {TREE}, {GONE}, {FOUND} SELECT DISTINCT uid, path, r AS reason FROM hits")
def discovered(spark: SparkSession, d: str) -> DataFrame:
    return erase.discover(fx.tree(spark, d), gone(spark, d), ["owner"])


@query("U02", f"WITH {TREE}, {GONE}, {FOUND} SELECT DISTINCT uid, path FROM (SELECT uid, path FROM hits UNION ALL SELECT split_part(path, '/', 2), path FROM tree WHERE path LIKE 'customers/%' AND split_part(path, '/', 2) IN (SELECT uid FROM gone))")
def all_hits(spark: SparkSession, d: str) -> DataFrame:
    t, g = fx.tree(spark, d), gone(spark, d)
    return erase.union_hits(erase.discover(t, g, ["owner"]), erase.matched_paths(t, g, "customers/{UID}"))


@query("D03", f"WITH {TREE}, {GONE}, {FOUND} SELECT DISTINCT uid, path, contains(path, uid) OR coalesce(contains(owner, uid), FALSE) AS valid FROM hits JOIN tree USING (path)")
def validated(spark: SparkSession, d: str) -> DataFrame:
    t = fx.tree(spark, d)
    hits = erase.discover(t, gone(spark, d), ["owner"]).select("uid", "path").distinct()
    return erase.erasable(hits, t, ["owner"])


@query("P20", f"WITH {TREE} SELECT path, contains(path, '77') OR coalesce(contains(owner, '77'), FALSE) AS valid FROM tree")
def erasable_for(spark: SparkSession, d: str) -> DataFrame:
    t = fx.tree(spark, d)
    return erase.erasable(t.select(F.lit("77").alias("uid"), "path"), t, ["owner"]).select("path", "valid")


OBJECT_NAMES = "o AS (SELECT p_partkey, 'users/' || (p_partkey % 500) || CASE p_partkey % 3 WHEN 0 THEN '/' || p_partkey WHEN 1 THEN '-avatar.png' ELSE '' END AS name FROM part)"


@query("D04", f"WITH {GONE}, {OBJECT_NAMES} SELECT p_partkey, 'prefix' AS mode FROM o WHERE NOT EXISTS (SELECT 1 FROM gone WHERE starts_with(name, 'users/' || uid)) UNION ALL SELECT p_partkey, 'segments' FROM o WHERE split_part(name, '/', 2) NOT IN (SELECT uid FROM gone)")
def erased_objects(spark: SparkSession, d: str) -> DataFrame:
    """Objects in folders of users, beside them and named like them: by prefix all that begin with a target go."""
    tail = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("/"), F.col("p_partkey").cast("string"))).when(F.col("p_partkey") % 3 == 1, "-avatar.png").otherwise("")
    o = fx.table(spark, d, "part").select("p_partkey", F.lit("main").alias("bucket"), F.concat(F.lit("users/"), (F.col("p_partkey") % 500).cast("string"), tail).alias("name"))
    stay = [erase.erase_objects(o, gone(spark, d), "{DEFAULT}/users/{UID},other/{UID}", "main", mode).select("p_partkey", F.lit(mode).alias("mode")) for mode in ("prefix", "segments")]
    return stay[0].unionByName(stay[1])


@query("D05", f"WITH {GONE} SELECT user_id, event_id FROM events WHERE CAST(user_id AS VARCHAR) NOT IN (SELECT uid FROM gone)")
def erased_tree(spark: SparkSession, d: str) -> DataFrame:
    n = fx.table(spark, d, "events").select("user_id", "event_id", F.concat_ws("/", F.lit("rooms"), "user_id", "event_id").alias("path"))
    return erase.erase_tree(n, gone(spark, d), "rooms/{UID}").select("user_id", "event_id")


@query("D06", f"WITH {TREE}, {GONE}, {FOUND} SELECT DISTINCT uid, path, 'document' AS kind FROM hits")
def audited(spark: SparkSession, d: str) -> DataFrame:
    return erase.erasure_audit(fx.tree(spark, d), gone(spark, d), ["owner"])


@query("J07", f"WITH {TREE}, {GONE}, {FOUND}, parts AS (SELECT path, unnest([array_to_string(string_split(path, '/')[1:n], '/') for n in [2, 4, 6] if n <= len(string_split(path, '/'))]) AS p FROM tree) SELECT path FROM tree WHERE path NOT IN (SELECT path FROM parts WHERE p IN (SELECT path FROM hits))")
def without_users(spark: SparkSession, d: str) -> DataFrame:
    return erase.erase_users(fx.tree(spark, d), gone(spark, d), ["owner"]).select("path")


@query("F19", f"WITH {GONE} SELECT uid, 'users/' || uid AS target FROM gone UNION ALL SELECT uid, 'a/' || uid || '/b/' || uid FROM gone")
def substituted(spark: SparkSession, d: str) -> DataFrame:
    return erase.target_paths(gone(spark, d), "users/{UID},a/{UID}/b/{UID}")


SEARCHED = "found AS (SELECT uid, path FROM tree JOIN gone ON path = 'customers/' || uid || '/orders/' || uid UNION SELECT uid, path FROM tree, gone WHERE path = 'regions/1/nations/1')"


@query("X03", f"WITH {TREE}, {GONE}, {FOUND}, {SEARCHED}, valid AS (SELECT uid, path FROM found WHERE contains(path, uid) UNION SELECT uid, path FROM hits), parts AS (SELECT path, unnest([array_to_string(string_split(path, '/')[1:n], '/') for n in [2, 4, 6] if n <= len(string_split(path, '/'))]) AS p FROM tree) SELECT uid, path, 'document' AS kind FROM valid UNION SELECT uid, path, 'invalid' FROM found WHERE NOT contains(path, uid) UNION ALL SELECT NULL, path, 'stays' FROM tree WHERE path NOT IN (SELECT path FROM parts WHERE p IN (SELECT path FROM valid))")
def custom_search(spark: SparkSession, d: str) -> DataFrame:
    """A user's own search beside the built-in one: what it names is checked, told, and erased with what is below.

    It names an order of each user that may not exist, and for all the same document, which is none of theirs.
    """

    def search(uids):
        return [[f"customers/{u}/orders/{u}", "regions/1/nations/1"] for u in uids]

    t, g = fx.tree(spark, d), gone(spark, d)
    audit = erase.erasure_audit(t, g, ["owner"], search=search)
    stays = erase.erase_users(t, g, ["owner"], search=search)
    return audit.unionByName(stays.select(F.lit(None).cast("string").alias("uid"), "path", F.lit("stays").alias("kind")))


# Enrichment. The stub translator upper-cases and appends the language.
def stub(batch):
    return batch["input"].str.upper() + ":" + batch["lang"]


LANGS = "CASE WHEN doc_id % 5 = 0 THEN ['it', 'en'] ELSE ['en', 'fr', 'de'] END"
TEXTS = f"t AS (SELECT doc_id, text AS input, {LANGS} AS langs, doc_id % 3 = 0 AS has FROM documents)"


@query("T01", "SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'run' WHEN doc_id % 4 = 1 THEN 'clear' WHEN doc_id % 4 = 2 THEN 'none' ELSE 'run' END AS action FROM documents WHERE text IS NOT NULL UNION ALL SELECT doc_id, 'none' FROM documents WHERE text IS NULL")
def gated(spark: SparkSession, d: str) -> DataFrame:
    t = fx.table(spark, d, "documents").select("doc_id", "text")
    r = F.col("doc_id") % 4
    before = F.when(r != 0, F.col("text"))
    after = F.when(r == 1, F.lit(None)).when(r == 3, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    kind = F.when(r == 0, "CREATE").otherwise("UPDATE")
    return t.select("doc_id", enrich.translate_gate(kind, before, after, F.lit("en"), F.lit("en")).alias("action"))


@query("T02", f"WITH {TEXTS} SELECT doc_id, array_to_string(langs, ',') AS langs FROM t")
def languages(spark: SparkSession, d: str) -> DataFrame:
    return fx.texts(spark, d).select("doc_id", F.array_join(enrich.target_languages(F.col("languages"), ["en", "fr", "de", "en"]), ",").alias("langs"))


@query("J10", f"WITH {TEXTS} SELECT doc_id, unnest(langs) AS lang FROM t")
def fanned_out(spark: SparkSession, d: str) -> DataFrame:
    return enrich.fan_out(fx.texts(spark, d), enrich.target_languages(F.col("languages"), ["en", "fr", "de"])).select("doc_id", "lang")


@query("J11", f"WITH {TEXTS} SELECT doc_id, array_to_string(list_filter(langs, lambda x: NOT (has AND x = 'fr')), ',') AS langs FROM t")
def pending(spark: SparkSession, d: str) -> DataFrame:
    t = fx.texts(spark, d)
    langs = enrich.target_languages(F.col("languages"), ["en", "fr", "de"])
    return t.select("doc_id", F.array_join(enrich.pending_languages(langs, F.col("existing")), ",").alias("langs"))


NESTED_TEXTS = f"""n AS (SELECT doc_id, doc_id % 3 = 0 AS has, doc_id % 6 = 3 AS nested, text, source, {LANGS} AS langs FROM documents), items AS (
    SELECT doc_id, has, '' AS field, text AS input, unnest(langs) AS lang FROM n WHERE NOT nested AND text IS NOT NULL
    UNION ALL SELECT doc_id, FALSE, 'title', source, unnest(langs) FROM n WHERE nested
    UNION ALL SELECT doc_id, has, 'body', text, unnest(langs) FROM n WHERE nested
    UNION ALL SELECT doc_id, FALSE, 'n', NULL, unnest(langs) FROM n WHERE nested
)"""
MADE = "upper(replace(input, 'ß', 'ss')) || ':' || lang AS output"


def _told(df: DataFrame) -> DataFrame:
    fields = df.select("doc_id", F.explode("translations").alias("field", "m"))
    return fields.select("doc_id", "field", F.explode("m").alias("lang", "output"))


def _languages() -> F.Column:
    return enrich.target_languages(F.col("languages"), ["en", "fr", "de"])


@query("T03", f"WITH {NESTED_TEXTS} SELECT doc_id, field, lang, {MADE} FROM items UNION ALL SELECT doc_id, '', 'fr', 'kept' FROM n WHERE NOT nested AND text IS NULL AND has")
def translated(spark: SparkSession, d: str) -> DataFrame:
    return _told(enrich.translate_fields(fx.texts_or_maps(spark, d), stub, _languages()))


BACKFILLED = f"WITH {NESTED_TEXTS} SELECT doc_id, field, lang, {MADE} FROM items WHERE NOT (has AND lang = 'fr') UNION ALL SELECT doc_id, CASE WHEN nested THEN 'body' ELSE '' END, 'fr', 'kept' FROM n WHERE has"


@query("T04", BACKFILLED)
def backfilled(spark: SparkSession, d: str) -> DataFrame:
    return _told(enrich.translate_fields(fx.texts_or_maps(spark, d), stub, _languages(), missing_only=True))


@query("A18", f"WITH {TEXTS}, n AS (SELECT doc_id, lang, upper(replace(input, 'ß', 'ss')) || ':' || lang AS output FROM (SELECT doc_id, input, has, unnest(langs) AS lang FROM t) WHERE input IS NOT NULL AND NOT (has AND lang = 'fr')) SELECT doc_id, field, lang, output FROM (SELECT * FROM n UNION ALL SELECT doc_id, 'fr', 'kept' FROM t WHERE has), (VALUES (''), ('plain')) f(field)")
def folded(spark: SparkSession, d: str) -> DataFrame:
    """The same translations folded into a map of each document, and into a map of maps."""
    t = fx.texts(spark, d)
    langs = enrich.pending_languages(_languages(), F.col("existing"))
    rows = enrich.fan_out(t.where("input is not null"), langs).select("doc_id", "lang", F.concat(F.upper("input"), F.lit(":"), "lang").alias("output"), F.lit(None).cast("string").alias("error"))
    plain = enrich.fold_translations(t, rows, keep=True).select("doc_id", F.create_map(F.lit("plain"), "translations").alias("translations"))
    nested = t.withColumn("existing", F.when(F.size("existing") > 0, F.create_map(F.lit(""), "existing")))
    return _told(plain).unionByName(_told(enrich.fold_fields(nested, rows.withColumn("field", F.lit("")), keep=True)))


@query("A17", "SELECT count(*) FILTER (WHERE doc_id % 7 <> 0) AS n_success, count(*) FILTER (WHERE doc_id % 7 = 0) AS n_error, 'WARNING' AS status FROM documents")
def summary(spark: SparkSession, d: str) -> DataFrame:
    return enrich.backfill_summary(fx.table(spark, d, "documents").select((F.col("doc_id") % 7 == 0).cast("int").alias("n_errors")))


@query("T06", "SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'none' WHEN 1 THEN 'run' WHEN 2 THEN 'clear' ELSE 'run' END AS action FROM pages WHERE url IS NOT NULL UNION ALL SELECT page_id, 'none' FROM pages WHERE url IS NULL")
def url_gated(spark: SparkSession, d: str) -> DataFrame:
    c = fx.link_changes(spark, d)
    kind = F.when(F.col("before").isNull(), "CREATE").otherwise("UPDATE")
    return c.select("page_id", enrich.url_gate(kind, F.col("before"), F.col("after")).alias("action"))


def shorten(batch):
    import hashlib

    return [hashlib.md5(u.encode()).hexdigest()[:8] for u in batch["url"]]


@query("T07", "SELECT page_id, substr(md5(url), 1, 8) AS short_url FROM pages")
def shortened(spark: SparkSession, d: str) -> DataFrame:
    return enrich.enrich_urls(fx.table(spark, d, "pages").select("page_id", "url"), shorten).select("page_id", "short_url")


@query("T08", "SELECT c_custkey, upper(c_name) AS upper, how FROM customer, (VALUES ('backfill'), ('stream')) t(how) WHERE c_custkey % 3 <> 0")
def uppercased(spark: SparkSession, d: str) -> DataFrame:
    from docflow.streaming.streams import uppercase_stream

    c = fx.table(spark, d, "customer").select("c_custkey", F.col("c_name").alias("original"), F.when(F.col("c_custkey") % 3 == 0, "done").alias("upper"))
    streamed = run_stream(spark, c, "parquet", lambda df, sink, at: uppercase_stream(df, at, sink))
    every = enrich.uppercase_backfill(c, per_pass=None).select("c_custkey", "upper", F.lit("backfill").alias("how"))
    return every.unionByName(streamed.select("c_custkey", "upper", F.lit("stream").alias("how")))


@query("F24", "SELECT conv_id, turn, upper(replace(text, 'ß', 'ss')) AS upper FROM conversations")
def upper(spark: SparkSession, d: str) -> DataFrame:
    return enrich.uppercase(fx.table(spark, d, "conversations"), "text").select("conv_id", "turn", "upper")


# Objects.
FILES = """f AS (
    SELECT *, 'img/' || replace(p_brand, '#', '-') AS dir, ['png', 'jpg', 'txt'][p_size % 3 + 1] AS ext FROM part
), ok AS (SELECT * FROM f WHERE ext <> 'txt' AND p_size % 13 <> 0 AND p_size % 10 <> 0 AND p_size % 11 <> 0)"""


@query("I01", f"WITH {FILES} SELECT p_partkey AS object_id FROM ok WHERE p_brand LIKE 'Brand#1%'")
def to_resize(spark: SparkSession, d: str) -> DataFrame:
    return objects.should_resize(fx.objects(spark, d), include=["/img/Brand-1*"]).select("object_id")


VARIANTS = f"WITH {FILES} SELECT p_partkey AS object_id, format, box, dir || '/thumbs/' || p_partkey || '_' || box || CASE format WHEN 'false' THEN '.' || ext ELSE '.webp' END AS target FROM (SELECT *, unnest(['webp', 'false']) AS format FROM ok) a, (VALUES ('200x100'), ('64x64')) b(box)"


@query("I02", VARIANTS)
def variants(spark: SparkSession, d: str) -> DataFrame:
    return objects.plan_variants(objects.should_resize(fx.objects(spark, d)), ["200x100", "64x64", "64x64"], ["webp", "false"], "thumbs").select("object_id", "format", "box", "target")


@query("F22", f"WITH {FILES} SELECT p_partkey AS object_id, CASE ext WHEN 'txt' THEN p_partkey || '.txt_64x64' ELSE p_partkey || '_64x64.gif' END AS file_name FROM f")
def variant_names(spark: SparkSession, d: str) -> DataFrame:
    return fx.objects(spark, d).select("object_id", objects.variant_name(F.col("name"), F.lit("64x64"), F.lit("gif")).alias("file_name"))


@query("F23", "SELECT p_partkey AS object_id, 'inline; filename*=utf-8''new.png' AS disposition, 'max-age=60' AS cache, 'true' AS resized, p_brand AS owner FROM part".replace("''new", "''''new"))
def variant_headers(spark: SparkSession, d: str) -> DataFrame:
    made = fx.objects(spark, d).select("object_id", *objects.variant_metadata(F.lit("new.png"), cache_control="max-age=60"))
    return made.select("object_id", F.col("contentDisposition").alias("disposition"), F.col("cacheControl").alias("cache"), F.col("metadata")["resizedImage"].alias("resized"), F.col("metadata")["owner"].alias("owner"))


@query("I03", "SELECT p_partkey, CAST(round((p_size * 10) * least(1.0, 200.0 / (p_size * 10), 100.0 / (p_size * 4))) AS INT) AS width, CAST(round((p_size * 4) * least(1.0, 200.0 / (p_size * 10), 100.0 / (p_size * 4))) AS INT) AS height FROM part")
def sizes(spark: SparkSession, d: str) -> DataFrame:
    p = fx.table(spark, d, "part")
    fit = objects.fitted(F.col("p_size") * 10, F.col("p_size") * 4, objects.parse_size(F.lit("200x100")))
    return p.select("p_partkey", fit.alias("s")).select("p_partkey", "s.width", "s.height")


@query("A19", "SELECT p_size AS object_id, bool_or(p_partkey % 17 = 0) AS failed FROM part GROUP BY 1")
def outcomes(spark: SparkSession, d: str) -> DataFrame:
    r = fx.table(spark, d, "part").select(F.col("p_size").alias("object_id"), (F.col("p_partkey") % 17 != 0).alias("success"))
    return objects.resize_outcome(r)


@query("I04", f"WITH {FILES} SELECT p_partkey AS object_id, dir || '/failed/' || p_partkey || '.' || ext AS target FROM f")
def failed(spark: SparkSession, d: str) -> DataFrame:
    return objects.route_failed(fx.objects(spark, d), "./failed/").select("object_id", "target")


@query("I05", "SELECT p_partkey AS object_id, CASE WHEN p_size % 3 = 2 THEN 'failed' WHEN p_size % 3 = 1 THEN 'placeholder' ELSE 'pass' END AS verdict FROM part")
def screened(spark: SparkSession, d: str) -> DataFrame:
    def fn(rows):
        if (rows["contentType"] == "text/plain").any():
            raise ValueError("not an image")
        return rows["contentType"] == "image/png"

    return objects.screen_content(fx.objects(spark, d), fn)


@query("I06", "SELECT p_size AS object_id FROM part GROUP BY 1 HAVING NOT bool_or(p_partkey % 17 = 0)")
def cleaned(spark: SparkSession, d: str) -> DataFrame:
    return objects.cleanup_plan(outcomes(spark, d), "on_success")


@query("S14", "SELECT p_size AS object_id, CAST(sum(length(coalesce(p_name, '')) + 1) AS VARCHAR) AS size, '' AS none FROM part GROUP BY 1")
def listed(spark: SparkSession, d: str) -> DataFrame:
    """Objects that Spark writes, listed, and their sizes as text metadata."""
    from docflow.sources.tables import scan_objects, text_metadata

    path = landing(spark, "objects")
    fx.table(spark, d, "part").select("p_size", F.coalesce("p_name", F.lit("")).alias("p_name")).write.partitionBy("p_size").text(path)
    found = scan_objects(spark, f"{path}/*/*.txt").select(F.regexp_extract("name", r"p_size=(\d+)/", 1).cast("int").alias("object_id"), "size")
    sums = found.groupBy("object_id").agg(F.sum("size").alias("size"))
    made = sums.select("object_id", text_metadata(F.create_map(F.lit("size"), "size", F.lit("none"), F.lit(None).cast("bigint"))).alias("m"))
    return made.select("object_id", F.col("m")["size"].alias("size"), F.col("m")["none"].alias("none"))


# Mail.
MAIL = """m AS (
    SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS status, o_orderdate AS placed, o_orderkey % 5 <> 4 AS by_uid,
        CASE WHEN o_orderkey % 3 = 0 THEN ['receipt', 'notice', 'gone'][o_orderkey % 4 % 3 + 1] END AS template,
        o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0 AS has_message, CASE WHEN o_orderkey % 7 <> 0 THEN 'Order ' || o_orderkey END AS subject,
        o_orderkey % 2 = 0 OR o_orderkey % 11 = 0 AS has_text
    FROM orders
), u AS (SELECT c_custkey AS c, lower(replace(c_name, '#', '.')) || '@x.org' AS email FROM customer WHERE c_custkey % 6 <> 0)"""


@query("M01", f"WITH {MAIL} SELECT k AS mail_id, array_to_string(list_filter([CASE WHEN NOT by_uid AND k % 4 <> 0 AND k % 9 <> 0 AND k % 8 <> 0 THEN 'no recipient' END, CASE WHEN NOT has_message AND template IS NULL THEN 'no message, template or sendGrid' END, CASE WHEN has_message AND template IS NULL AND subject IS NULL THEN 'message without subject' END, CASE WHEN has_message AND template IS NULL AND NOT has_text THEN 'message without text or html' END], lambda x: x IS NOT NULL), '|') AS errors FROM m")
def mail_errors(spark: SparkSession, d: str) -> DataFrame:
    return mail.validate_mail(fx.mail(spark, d)).select("mail_id", F.array_join("errors", "|").alias("errors"))


@query("J04", f"WITH {MAIL} SELECT k AS mail_id, array_to_string(list_filter([CASE WHEN k % 4 = 0 THEN 'To-' || m.c || '@x.org' END, CASE WHEN by_uid THEN a.email END, CASE WHEN by_uid THEN b.email END], lambda x: x IS NOT NULL), ',') AS recipients, array_to_string(list_filter([CASE WHEN k % 9 = 0 THEN 'CC@x.org' END, CASE WHEN k % 9 = 0 THEN 'cc@x.org' END, CASE WHEN k % 8 = 0 THEN g.email END], lambda x: x IS NOT NULL), ',') AS copies FROM m LEFT JOIN u a ON a.c = m.c LEFT JOIN u b ON b.c = m.c + 1 LEFT JOIN u g ON g.c = m.c + 2")
def recipients(spark: SparkSession, d: str) -> DataFrame:
    r = mail.resolve_recipients(fx.mail(spark, d), fx.users(spark, d))
    return r.select("mail_id", F.array_join("to", ",").alias("recipients"), F.array_join("cc", ",").alias("copies"))


@query("J05", f"WITH {MAIL}, l AS (SELECT k, unnest(CASE WHEN by_uid THEN [CAST(c AS VARCHAR), 'nobody', CAST(c + 1 AS VARCHAR)] ELSE [] END || CASE WHEN k % 8 = 0 THEN [CAST(c + 2 AS VARCHAR)] ELSE [] END) AS uid FROM m) SELECT DISTINCT k AS mail_id, uid FROM l WHERE uid NOT IN (SELECT CAST(c AS VARCHAR) FROM u)")
def missing(spark: SparkSession, d: str) -> DataFrame:
    return mail.missing_uids(fx.mail(spark, d), fx.users(spark, d))


@query("J06", f"WITH {MAIL} SELECT k AS mail_id, CASE template WHEN 'receipt' THEN 'Receipt {{{{status}}}}' END AS t_subject, CASE template WHEN 'gone' THEN 'unknown template gone' END AS template_error FROM m")
def templated(spark: SparkSession, d: str) -> DataFrame:
    return mail.apply_templates(fx.mail(spark, d), fx.templates(spark)).select("mail_id", "t_subject", "template_error")


@query("F27", f"WITH {MAIL} SELECT k AS mail_id, CASE template WHEN 'receipt' THEN 'Receipt ' || status END AS r_subject, CASE template WHEN 'receipt' THEN '<p>&lt;5&gt; <5> <hr>' || status || '</p>' WHEN 'notice' THEN '<i>' || status || '</i>' END AS r_html, CASE template WHEN 'receipt' THEN '<5>' WHEN 'notice' THEN '' END AS r_text FROM m WHERE template IS NOT NULL")
def rendered(spark: SparkSession, d: str) -> DataFrame:
    return mail.render_template(mail.apply_templates(fx.mail(spark, d), fx.templates(spark)), fx.templates(spark))


@query("F28", f"WITH {MAIL} SELECT k AS mail_id, CASE WHEN template = 'receipt' THEN 'Receipt ' || status WHEN has_message THEN subject END AS subject, CASE WHEN template = 'receipt' THEN '<5>' WHEN template = 'notice' THEN '' WHEN has_message AND k % 2 = 0 THEN 'plain' END AS text FROM m")
def merged_messages(spark: SparkSession, d: str) -> DataFrame:
    m, t = fx.mail(spark, d), fx.templates(spark)
    joined = m.join(mail.render_template(mail.apply_templates(m, t), t), "mail_id", "left")
    out = mail.merge_message(F.col("message"), {"subject": F.col("r_subject"), "text": F.col("r_text")})
    return joined.select("mail_id", out.alias("o")).select("mail_id", "o.subject", "o.text")


@query("F26", "SELECT o_orderkey AS mail_id, CASE o_orderkey % 4 WHEN 0 THEN 'a' WHEN 1 THEN 'a,b' WHEN 2 THEN '' END AS r FROM orders")
def normalized(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    raw = F.when(k % 4 == 0, F.lit('"a"')).when(k % 4 == 1, F.lit('["a","b"]')).when(k % 4 == 2, F.lit("null")).otherwise(F.lit('["a",5]'))
    return fx.table(spark, d, "orders").select(k.alias("mail_id"), F.array_join(mail.normalize_recipients(parsed(raw)), ",").alias("r"))


@query("A16", "SELECT o_orderkey AS mail_id, array_to_string(list_filter([CASE WHEN o_orderkey % 4 = 0 THEN 'to-' || o_custkey || '@x.org' END, CASE WHEN o_orderkey % 9 = 0 THEN 'cc@x.org' END], lambda x: x IS NOT NULL), ',') AS accepted FROM orders")
def accepted(spark: SparkSession, d: str) -> DataFrame:
    m = fx.mail(spark, d)
    return m.select("mail_id", F.array_join(mail.accepted_recipients(m), ",").alias("accepted"))


@query("U04", "SELECT o_orderkey AS mail_id, CAST(CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END + CASE WHEN o_orderkey % 9 = 0 THEN 2 ELSE 0 END AS BIGINT) AS n FROM orders")
def all_lists(spark: SparkSession, d: str) -> DataFrame:
    none = F.array().cast("array<string>")
    return fx.mail(spark, d).select("mail_id", F.size(F.concat(F.coalesce("to", none), F.coalesce("cc", none))).cast("bigint").alias("n"))


NOW = "1997-01-01 00:00:00"


@query("M02", f"WITH {MAIL} SELECT k AS mail_id, CASE k % 6 WHEN 0 THEN CASE WHEN has_message OR template IS NOT NULL THEN 'PENDING' END WHEN 1 THEN 'PROCESSING' WHEN 3 THEN 'PROCESSING' WHEN 2 THEN CASE WHEN CAST(placed AS TIMESTAMP) < TIMESTAMP '{NOW}' THEN 'ERROR' END END AS next, k % 6 IN (1, 3) AS attempt, CASE WHEN k % 6 IN (1, 3) THEN epoch_us(TIMESTAMP '{NOW}') + 60000000 WHEN k % 6 = 2 AND CAST(placed AS TIMESTAMP) < TIMESTAMP '{NOW}' THEN epoch_us(CAST(placed AS TIMESTAMP)) END AS lease_us, CASE WHEN k % 6 = 0 AND (has_message OR template IS NOT NULL) THEN epoch_us(TIMESTAMP '{NOW}' + INTERVAL 3 DAY) WHEN k % 6 IN (1, 3) OR (k % 6 = 2 AND CAST(placed AS TIMESTAMP) < TIMESTAMP '{NOW}') THEN epoch_us(CAST(placed AS TIMESTAMP) + INTERVAL 9 DAY) END AS expire_us, CASE WHEN k % 6 = 0 AND (has_message OR template IS NOT NULL) THEN epoch_us(TIMESTAMP '{NOW}') END AS start_us FROM m")
def transitions(spark: SparkSession, d: str) -> DataFrame:
    t = mail.mail_transition(fx.mail(spark, d), F.lit(NOW).cast("timestamp"), ("day", 3))
    return t.select("mail_id", F.col("next.state").alias("next"), "attempt", F.unix_micros("next.leaseExpireTime").alias("lease_us"), F.unix_micros("next.expireAt").alias("expire_us"), F.unix_micros("next.startTime").alias("start_us"))


@query("M03", f"WITH {MAIL} SELECT k AS mail_id, CASE WHEN template = 'receipt' THEN 'Receipt ' || status WHEN has_message THEN subject END AS subject, coalesce(template = 'gone', FALSE) AS unknown, NOT (k % 4 = 0 OR k % 9 = 0 OR (by_uid AND (a.c IS NOT NULL OR b.c IS NOT NULL)) OR (k % 8 = 0 AND g.c IS NOT NULL)) AS nobody FROM m LEFT JOIN u a ON a.c = m.c LEFT JOIN u b ON b.c = m.c + 1 LEFT JOIN u g ON g.c = m.c + 2")
def prepared(spark: SparkSession, d: str) -> DataFrame:
    p = mail.prepare_mail(fx.mail(spark, d), fx.templates(spark), fx.users(spark, d))
    return p.select("mail_id", F.col("message.subject").alias("subject"), F.array_contains("errors", "unknown template gone").alias("unknown"), F.array_contains("errors", "no recipient after resolution").alias("nobody"))


@query("M04", f"WITH {MAIL}, p AS (SELECT k, k % 4 = 0 AS direct, k % 9 = 0 AS copied, placed FROM m WHERE k % 6 = 2) SELECT k AS mail_id, CASE WHEN NOT direct AND NOT copied THEN 'ERROR' WHEN k % 5 = 1 THEN 'ERROR' ELSE 'SUCCESS' END AS state, 1 AS attempts, CASE WHEN (direct OR copied) AND k % 5 <> 1 THEN CAST(CAST(direct AS INT) AS VARCHAR) || ':' || CAST(2 * CAST(copied AS INT) AS VARCHAR) || ':0' END AS info, CASE WHEN NOT direct AND NOT copied THEN 'Failed to deliver email. Expected at least 1 recipient.' WHEN k % 5 = 1 THEN 'refused' END AS error, epoch_us(TIMESTAMP '{NOW}') AS end_us, epoch_us(CAST(placed AS TIMESTAMP) + INTERVAL 9 DAY) AS expire_us, CAST(NULL AS BIGINT) AS lease_us FROM p")
def delivered(spark: SparkSession, d: str) -> DataFrame:
    """The sender tells how many recipients of each kind it was given; it refuses some mail."""

    def send(batch):
        if (batch["mail_id"] % 5 == 1).any():
            raise ValueError("refused")
        return batch["to"].str.len().astype(str) + ":" + batch["cc"].str.len().astype(str) + ":" + batch["bcc"].str.len().astype(str)

    sent = mail.deliver(fx.mail(spark, d), send, F.lit(NOW).cast("timestamp"))
    us = lambda c: F.unix_micros(f"delivery.{c}")
    return sent.select("mail_id", "delivery.state", "delivery.attempts", "delivery.info", "delivery.error", us("endTime").alias("end_us"), us("expireAt").alias("expire_us"), us("leaseExpireTime").alias("lease_us"))


@query("M05", "SELECT o_orderkey AS mail_id, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS n FROM orders")
def attachments(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    one = F.create_map(F.lit("filename"), F.when(k % 2 == 0, "a.txt"), F.lit("unknown"), F.lit("x"))
    return fx.table(spark, d, "orders").select(k.alias("mail_id"), F.size(mail.clean_attachments(F.array(one))).alias("n"))


@query("M06", "SELECT o_orderkey AS mail_id FROM orders WHERE CAST(o_orderdate AS TIMESTAMP) + INTERVAL 3 DAY < TIMESTAMP '1996-01-01'")
def expired(spark: SparkSession, d: str) -> DataFrame:
    from docflow.functions.extract import expire_at

    o = fx.table(spark, d, "orders").select(F.col("o_orderkey").alias("mail_id"), F.struct(expire_at(F.col("o_orderdate").cast("timestamp"), "day", 3).alias("expireAt")).alias("delivery"))
    return mail.expired_mail(o, F.lit("1996-01-01").cast("timestamp")).select("mail_id")


# Streams and sinks, over files that Spark derives from the tables.
@query("S02", f"WITH {CHANGELOG} SELECT event_id, count(*) AS n FROM changelog GROUP BY 1")
def appended(spark: SparkSession, d: str) -> DataFrame:
    """Every event twice in one batch, and once more in the next, there without its time."""
    from docflow.sources.snapshots import append_once

    path, log = landing(spark, "changelog"), fx.changelog(spark, d)
    append_once(log.where("event_id % 5 <> 0").unionByName(log.where("event_id % 5 <> 0")), path, 1, buckets=16)
    append_once(log.withColumn("timestamp", F.lit(None).cast("timestamp")), path, 2, buckets=16)
    return spark.read.parquet(path).groupBy("event_id").agg(F.count("*").alias("n"))


@query("S08", f"WITH {TREE} SELECT path AS value FROM tree WHERE owner = '7'")
def failed_paths(spark: SparkSession, d: str) -> DataFrame:
    from docflow.sources.tables import write_failed_paths

    path = landing(spark, "failed")
    write_failed_paths(fx.tree(spark, d).where("owner = '7'"), path)
    return spark.read.text(path)


@query("S10", f"WITH {CHANGELOG} SELECT strftime(timestamp, '%Y-%m-%d') AS day, strftime(timestamp, '%Y-%m-%d') AS folder, count(*) AS n FROM changelog GROUP BY ALL")
def partitioned(spark: SparkSession, d: str) -> DataFrame:
    from docflow.sources.tables import partition_strategy, write_partitioned

    path = landing(spark, "partitioned")
    write_partitioned(fx.changelog(spark, d), path, *partition_strategy("TIMESTAMP", "DAY"))
    # The day of each row's time, and that of the folder which holds it.
    folder = F.regexp_extract("_metadata.file_path", "/timestamp_day=([^/]*)/", 1)
    return spark.read.parquet(path).groupBy(F.date_format("timestamp", "yyyy-MM-dd").alias("day"), folder.alias("folder")).agg(F.count("*").alias("n"))


@query("S11", f"WITH {CHANGELOG} SELECT document_id, count(*) AS n, TRUE AS apart FROM changelog GROUP BY 1")
def clustered(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each document after clustering, and whether the files' ranges of keys lie apart."""
    from docflow.sources.tables import write_clustered

    path = landing(spark, "clustered")
    write_clustered(fx.changelog(spark, d), path, ["document_id", "timestamp"])
    stored = spark.read.parquet(path)
    key = F.struct("document_id", "timestamp")
    ranges = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    # A row for each file; the one before it in order of keys must end before it begins.
    before = F.lag("hi").over(Window.orderBy("lo"))
    apart = ranges.select((before.isNull() | (before < F.col("lo"))).alias("apart")).agg(F.every("apart")).first()[0]
    return stored.groupBy("document_id").agg(F.count("*").alias("n")).withColumn("apart", F.lit(apart))


@query("S16", f"WITH {CHANGELOG} SELECT document_name, epoch_us(timestamp) AS ts_us, TRUE AS stale, TRUE AS left_alone FROM changelog QUALIFY row_number() OVER (PARTITION BY document_name ORDER BY timestamp DESC, event_id DESC) = 1 AND operation <> 'DELETE'")
def refreshed(spark: SparkSession, d: str) -> DataFrame:
    """Three refreshes of a stored state; a third of the events comes late, and a few documents last."""
    from docflow.sources.snapshots import Snapshot

    log, path = fx.changelog(spark, d), landing(spark, "changelog")
    shot = Snapshot(spark, path, landing(spark, "latest"), buckets=16)
    late, last = F.col("event_id").cast("long") % 3 == 0, F.col("document_id").cast("long") % 50 == 0
    for part in (log.where(~late & ~last), log.where(late & ~last), log.where(last)):
        part.write.mode("append").parquet(path)
        shot.refresh_if_stale("1 HOUR", now=F.lit("2999-01-01").cast("timestamp"))
    stale = shot.stale("1 HOUR", now=F.lit("2999-01-01").cast("timestamp"))
    left = shot.refresh_if_stale("1 DAY") is None
    return shot.read().select("document_name", F.unix_micros("timestamp").alias("ts_us"), F.lit(stale).alias("stale"), F.lit(left).alias("left_alone"))


@query("S17", f"WITH {CHANGELOG} SELECT operation, count(*) AS n, 'users_raw_changelog,users_raw_latest||users_raw_latest' AS made FROM changelog WHERE operation <> 'DELETE' GROUP BY 1")
def registered(spark: SparkSession, d: str) -> DataFrame:
    """Views made at first, at a repetition (none), and after one of them has changed (that one)."""
    from docflow.sources.tables import register_views

    for name in ("users_raw_changelog", "users_raw_latest"):
        spark.catalog.dropTempView(name)
    log = fx.changelog(spark, d)
    views = {"users_raw_changelog": log, "users_raw_latest": log.where("operation = 'CREATE'")}
    made = [register_views(spark, views), register_views(spark, views), register_views(spark, views | {"users_raw_latest": log.where("operation <> 'DELETE'")})]
    told = "|".join(",".join(sorted(m)) for m in made)
    return spark.table("users_raw_latest").groupBy("operation").agg(F.count("*").alias("n")).withColumn("made", F.lit(told))


@query("N10", "SELECT name, n, TRUE AS fresh, FALSE AS late, FALSE AS early FROM (SELECT 'big' AS name, count(*) AS n FROM orders WHERE o_totalprice >= 200000 UNION ALL SELECT 'open', count(*) FROM orders WHERE o_orderstatus = 'O')")
def bundle(spark: SparkSession, d: str) -> DataFrame:
    from docflow.operators.named import fresh, materialize, named_query

    o = fx.table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").cast("double").alias("total"), F.col("o_orderstatus").alias("status"))
    path = landing(spark, "bundle")
    materialize({"big": named_query(o, {"conditions": [{"where": ["total", ">=", 200000]}]}), "open": named_query(o, {"conditions": [{"where": ["status", "==", "O"]}]})}, path)
    counted = [spark.read.parquet(f"{path}/{n}").agg(F.lit(n).alias("name"), F.count("*").alias("n")) for n in ("big", "open")]
    both = counted[0].unionByName(counted[1])
    # Whether the results may be used: as of then, long after, and if only later ones count.
    cached = spark.read.parquet(f"{path}/big")
    for name, window in {"fresh": ("2001-01-01", "1 HOUR"), "late": ("2999-01-01", "1 HOUR"), "early": ("2001-01-01", "1 HOUR", "2999-01-01")}.items():
        both = both.crossJoin(fresh(cached, *window).withColumnRenamed("fresh", name))
    return both


@query("S01", f"WITH {CHANGELOG} SELECT operation, count(*) AS n FROM changelog GROUP BY 1")
def streamed_source(spark: SparkSession, d: str) -> DataFrame:
    rows = run_stream(spark, fx.changelog(spark, d), "json", lambda df, sink, at: df.writeStream.option("checkpointLocation", at).trigger(availableNow=True).foreachBatch(sink).start())
    return rows.groupBy("operation").agg(F.count("*").alias("n"))


@query("R01", "SELECT 'projects/demo/databases/(default)/documents/users/' || user_id AS document_name, CAST(event_id AS VARCHAR) AS event_id FROM events")
def streamed_changelog(spark: SparkSession, d: str) -> DataFrame:
    from docflow.streaming.streams import stream_changelog

    path = F.concat(F.lit("users/"), "document_id")
    changes = fx.changelog(spark, d).select("timestamp", "event_id", path.alias("before_path"), path.alias("after_path"), F.lit(None).cast("string").alias("before"), F.col("data").alias("after"))
    out = landing(spark, "r01")
    # The later half of the events arrives first; half of those come once more with the rest, without their time, and all in the end.
    late = F.col("event_id").cast("long") % 2 == 0
    again = changes.where(F.col("event_id").cast("long") % 4 == 1).withColumn("timestamp", F.lit(None).cast("timestamp"))
    moved = changes.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 90 DAYS"))
    run_stream(spark, [changes.where(~late), changes.where(late).unionByName(again), moved], "parquet", lambda df, sink, at: stream_changelog(df, at, out, "demo"))
    return spark.read.parquet(out).select("document_name", "event_id")


LATEST = f"WITH {CHANGELOG} SELECT document_name, document_id, operation, epoch_us(timestamp) AS ts_us, event_id, value, kind, k FROM changelog QUALIFY row_number() OVER (PARTITION BY document_name ORDER BY timestamp DESC, event_id DESC) = 1"


@query("R02", LATEST)
def streamed_latest(spark: SparkSession, d: str) -> DataFrame:
    from docflow.streaming.streams import stream_latest

    log = fx.changelog(spark, d)
    late = F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0
    rows = run_stream(spark, [log.where(~late), log.where(late)], "parquet", lambda df, sink, at: stream_latest(df, at, sink))
    # Each document's last output.
    last = rows.groupBy("document_name").agg(F.max_by(F.struct(*(c for c in rows.columns if c not in ("document_name", "_batch"))), "_batch").alias("r"))
    return shown(last.select("document_name", "r.*"))


@query("R08", LATEST)
def late_safe(spark: SparkSession, d: str) -> DataFrame:
    """The same rows in another order of arrival have the same latest state."""
    from docflow.streaming.streams import latest_late_safe

    return shown(latest_late_safe(fx.changelog(spark, d).repartition(F.xxhash64("event_id"))))


@query("R03", f"WITH {SHARDS}, {STORED} SELECT counter, leaf, CAST(sum(value) AS DOUBLE) AS value FROM ({SHARD_ROWS} UNION ALL SELECT counter, leaf, value FROM c2) GROUP BY 1, 2")
def streamed_counters(spark: SparkSession, d: str) -> DataFrame:
    """Stored counters as the first state, then the shards of three ranges of users, one batch after another."""
    from docflow.sources.tables import read_changes
    from docflow.streaming.streams import stream_counters, stream_updates

    shards, out, base = fx.shards(spark, d), landing(spark, "r03"), landing(spark, "r03-updates")
    user = F.conv(F.element_at(F.split("shard_path", "/"), -1), 16, 10).cast("long")
    parts = [shards.where(user < 40), shards.where((user >= 40) & (user < 700)), shards.where(user >= 700)]
    run_stream(spark, parts, "parquet", lambda df, sink, at: stream_updates(df, at, base))
    emitted = []

    def sink(batch: DataFrame, epoch: int) -> None:
        emitted.append(epoch)
        batch.write.mode("overwrite").parquet(f"{out}/batch={epoch}")

    # The file source takes one batch's update after another, in the order of their writing.
    updates = read_changes(spark, base, "counter string, leaf array<string>, value double, reset boolean, batch long", "parquet")
    stream_counters(updates, landing(spark, "r03-checkpoint"), sink, stored(spark, d)).awaitTermination()
    changed = spark.read.parquet(out)
    last = changed.groupBy("counter", "leaf").agg(F.max_by("value", "batch").alias("value")).where("value IS NOT NULL")
    kept = stored(spark, d).join(changed.select("counter", "leaf").distinct(), ["counter", "leaf"], "left_anti")
    return slashed(last.unionByName(kept.select("counter", "leaf", "value")))


@query("R04", "SELECT CAST(user_id AS VARCHAR) AS parent, lpad(CAST(event_id AS VARCHAR), 12, '0') AS key FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) > 5")
def streamed_trim(spark: SparkSession, d: str) -> DataFrame:
    from docflow.streaming.streams import stream_keep_last_n

    c = fx.table(spark, d, "events").select(F.col("user_id").cast("string").alias("parent"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("key"))
    return run_stream(spark, c, "parquet", lambda df, sink, at: stream_keep_last_n(df, at, 5, sink)).select("parent", "key")


@query("R05", "SELECT o_orderkey AS mail_id, CASE WHEN o_orderkey % 3 = 0 THEN 'SUCCESS' ELSE 'ERROR' END AS state, CASE WHEN o_orderkey % 3 = 2 THEN 0 ELSE 1 END AS attempts, CASE WHEN o_orderkey % 3 = 2 THEN 'Message processing lease expired.' END AS error FROM orders")
def streamed_mail(spark: SparkSession, d: str) -> DataFrame:
    """All mail starts, a third is sent and a third fails; the leases of the rest run out by their timers.

    What is told of mail that was sent already changes nothing.
    """
    from docflow.streaming.streams import stream_mail

    o = fx.table(spark, d, "orders").select(F.col("o_orderkey").alias("mail_id"))
    events = F.when(F.col("mail_id") % 3 == 0, F.array(F.lit("start"), F.lit("sent"))).when(F.col("mail_id") % 3 == 1, F.array(F.lit("start"), F.lit("failed"))).otherwise(F.array(F.lit("start")))
    told = o.select("mail_id", F.posexplode(events).alias("seq", "event"))
    again = o.where("mail_id % 3 = 0").select("mail_id", F.lit(9).alias("seq"), F.lit("failed").alias("event"))
    # Batches without data would follow one another for as long as the stream runs, as time goes on.
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    held = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        rows = run_stream(spark, [told, again], "parquet", lambda df, sink, at: stream_mail(df, at, sink, lease_ms=1))
    finally:
        spark.conf.set(key, held)
    return rows.groupBy("mail_id").agg(F.max_by(F.struct("state", "attempts", "error"), "_batch").alias("r")).select("mail_id", "r.*")


@query("R06", "SELECT CAST(event_id AS VARCHAR) AS event_id, value, CAST(CASE WHEN event_id % 3 = 0 THEN 2 ELSE 0 END AS INT) AS attempts, FALSE AS final FROM events WHERE event_id % 3 < 2 UNION ALL SELECT CAST(event_id AS VARCHAR), value, 3, TRUE FROM events WHERE event_id % 3 = 2")
def retried(spark: SparkSession, d: str) -> DataFrame:
    """A sink that fails twice for a third of the rows and always for another third."""
    from docflow.streaming.streams import DEAD, dead_letters, retry_loop, until_drained

    failed = fx.table(spark, d, "events").select(F.col("event_id").cast("string").alias("event_id"), "value")
    dead, final, out = landing(spark, "dead"), landing(spark, "final"), landing(spark, "sent")
    dead_letters(failed).write.parquet(f"{dead}/first")

    def write(rows: DataFrame, epoch: int) -> DataFrame:
        third = F.col("event_id").cast("long") % 3
        fails = (third == 2) | ((third == 0) & (F.col("attempts") < 2))
        rows.where(~fails).write.mode("overwrite").parquet(f"{out}/batch={epoch}")
        return rows.where(fails)

    until_drained(retry_loop(spark, dead, final, landing(spark, "checkpoint"), failed.schema, write, buckets=16))
    sent = spark.read.schema("event_id string, value double, attempts int").parquet(out).withColumn("final", F.lit(False))
    lost = spark.read.schema(DEAD).parquet(final).select(F.from_json("payload", failed.schema).alias("r"), "attempts").select("r.*", "attempts")
    return sent.select("event_id", "value", "attempts", "final").unionByName(lost.withColumn("final", F.lit(True)))


@query("R07", "SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-15 11:59:30'")
def quiet(spark: SparkSession, d: str) -> DataFrame:
    from docflow.streaming.streams import quiet_for

    e = fx.table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("updated_at"))
    return quiet_for(e, now=F.lit("2024-01-15 12:00:00").cast("timestamp")).select("event_id")


@query("X04", "SELECT page_id, substr(md5(url), 1, 8) AS short_url, CAST(NULL AS VARCHAR) AS error FROM pages")
def called_back(spark: SparkSession, d: str) -> DataFrame:
    p = fx.table(spark, d, "pages").select("page_id", "url")
    made = enrich.call_batches(p.where("url IS NOT NULL"), shorten, ["url"], "short_url")
    return p.join(made, "url", "left").select("page_id", "short_url", "error")
