"""Operator cases that the tables do not hold: ties, nulls, malformed values, limits."""

import pytest
from pyspark.sql import functions as F

from docflow.functions import extract as X
from docflow.functions import paths
from docflow.operators import capture, counters, erase, enrich, latest, mail, named, objects, retention, views
from docflow.sources import tables

LOG = "document_name string, document_id string, timestamp timestamp, event_id string, operation string, data string"


def log(spark, rows):
    return spark.createDataFrame([(n, n, t, e, o, d) for n, t, e, o, d in rows], "document_name string, document_id string, t string, event_id string, operation string, data string").withColumn("timestamp", F.col("t").cast("timestamp")).drop("t")


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_latest_forms_agree_without_ties_and_differ_as_documented_with_them(spark):
    rows = [("a", "2024-01-01", "1", "CREATE", "{}"), ("a", "2024-01-02", "2", "UPDATE", '{"v":2}'), ("b", "2024-01-01", "3", "CREATE", "{}"), ("b", "2024-01-03", "4", "DELETE", None)]
    forms = [latest.latest_materialized, latest.latest_by_join, latest.latest_by_window, latest.latest_by_rank]
    got = [sorted((r.document_name, r.event_id) for r in f(log(spark, rows)).collect()) for f in forms]
    assert got == [[("a", "2")]] * 4
    tied = log(spark, [("a", "2024-01-01", "1", "UPDATE", "x"), ("a", "2024-01-01", "2", "CREATE", "y")])
    assert latest.latest_by_rank(tied).count() == 2
    assert latest.latest_by_join(tied).count() == 2
    assert [r.event_id for r in latest.latest_incremental(tied).collect()] == ["2"]


def test_null_timestamps_count_as_the_epoch(spark):
    rows = log(spark, [("a", None, "1", "UPDATE", "x"), ("a", None, "2", "UPDATE", "y")])
    assert latest.latest_by_join(rows).count() == 1
    assert latest.latest_incremental(rows).first().event_id == "2"
    mixed = log(spark, [("a", None, "9", "UPDATE", "x"), ("a", "2024-01-01", "2", "UPDATE", "y")])
    assert latest.latest_incremental(mixed).first().event_id == "2"


def test_retention_keeps_latest_and_month_edge(spark):
    rows = log(spark, [("a", "2024-01-01", "1", "CREATE", "{}"), ("a", "2024-01-02", "2", "DELETE", None), ("b", "2024-03-01", "3", "CREATE", "{}")])
    assert {r.event_id for r in retention.retain_keep_latest(rows, "2024-03-15").collect()} == {"2", "3"}
    assert {r.event_id for r in retention.retain_all(rows, "2024-03-15").collect()} == {"3"}
    assert {r.event_id for r in retention.retain_drop_deletes(rows, "2024-03-15").collect()} == {"3"}


def test_retention_keeps_rows_without_document_or_time_and_drops_ties_of_a_last_deletion(spark):
    rows = log(
        spark,
        [("a", "2024-01-01", "1", "CREATE", "{}"), ("a", "2024-01-02", "2", "DELETE", None), ("a", "2024-01-02", "3", "UPDATE", "{}"), ("a", None, "4", "UPDATE", "{}"), (None, "2024-01-01", "5", "CREATE", "{}")]
        + [(None, "2024-01-02", "6", "DELETE", None), ("b", "2024-01-02", "7", None, "{}"), ("c", None, "8", "DELETE", None)],
    )
    kept = lambda df: {r.event_id for r in df.collect()}
    assert kept(retention.retain_keep_latest(rows, "2024-03-15")) == {"2", "3", "4", "5", "6", "7", "8"}
    assert kept(retention.retain_drop_deletes(rows, "2024-03-15")) == {"4", "5", "6", "7", "8"}
    assert retention.retain_drop_deletes(rows, "2024-03-15").columns == rows.columns
    assert retention.stale_versions(rows, retention.month_before("2024-03-15"), drop_deletes=True).count() == 2


def test_screening_gives_whole_batches_and_retries_the_rows_of_a_failing_one(spark):
    def fn(rows):
        if (rows["name"] == "bad").any():
            raise ValueError("no")
        return rows["name"] != "dim"

    made = spark.createDataFrame([(1, "ok", "image/png"), (2, "bad", "image/png"), (3, "dim", "image/png")], "object_id long, name string, contentType string").coalesce(1)
    assert {r.object_id: r.verdict for r in objects.screen_content(made, fn).collect()} == {1: "pass", 2: "failed", 3: "placeholder"}


@pytest.mark.parametrize(
    ("text", "number", "boolean", "array"),
    [
        ('{"x": 1.5}', 1.5, None, []),
        ('{"x": "yes"}', None, None, []),
        ('{"x": true}', None, True, []),
        ('{"x": [1, "a", null, {"b": 2.0}]}', None, None, ["1", "a", "null", '{"b":2}']),
        ('{"x": null}', None, None, []),
        ("no json", None, None, []),
        (None, None, None, []),
        ('{"x": 1e40}', None, None, []),
    ],
)
def test_extraction(spark, text, number, boolean, array):
    v = X.parsed(F.lit(text))
    r = spark.range(1).select(X.doc_number(v, ["x"]).cast("double").alias("n"), X.doc_boolean(v, ["x"]).alias("b"), X.doc_array(v, ["x"]).alias("a")).first()
    assert (r.n, r.b, r.a) == (number, boolean, array)


def test_timestamp_rounds_to_milliseconds(spark):
    v = X.parsed(F.lit('{"t": {"_seconds": 10, "_nanoseconds": 1500000}, "q": "x.y", "a b\'c": 3}'))
    assert value(spark, F.unix_millis(X.doc_timestamp(v, ["t"]))) == 10002
    assert value(spark, X.doc_timestamp(v, ["q"])) is None
    assert value(spark, X.json_scalar(v, ["a b'c"])) == "3"


@pytest.mark.parametrize(
    ("path", "include", "want"),
    [("/images", ["/images"], True), ("/images/a", ["/images"], True), ("/images2", ["/images"], False), ("/users/u-1/pic", ["/users/*/pic"], True), ("/test", ["/users/*/pic"], False), ("/a.b", ["/a.b"], True), ("/axb", ["/a.b"], False)],
)
def test_path_globs(spark, path, include, want):
    assert value(spark, paths.path_allowed(F.lit(path), include)) is want


def test_relative_path(spark):
    assert value(spark, paths.relative_path(F.lit("projects/p/databases/d/documents/a/b"))) == "a/b"
    assert value(spark, paths.relative_path(F.lit("a/b/c"))) == "a/b/c"
    with pytest.raises(Exception, match="not a document path"):
        value(spark, paths.relative_path(F.lit("projects/p/databases/d/documents/a")))


def test_unknown_field_type_is_an_error(spark):
    with pytest.raises(ValueError, match="unknown field type"):
        views.schema_changelog(log(spark, []), [views.Field("a", "int")])


def test_several_arrays_give_their_product(spark):
    rows = log(spark, [("a", "2024-01-01", "1", "CREATE", '{"p": [1, 2], "q": ["x", "y", "z"], "e": []}')])
    spec = [views.Field(n, "array") for n in "pqe"]
    assert views.schema_latest(rows, spec).count() == 6
    assert {f.name for f in views.infer_field_spec(rows)} == {"p", "q", "e"}


def test_counter_conflicts_keep_the_later_kind(spark):
    rows = spark.createDataFrame([("c/x/_s_/1", '{"a": 3, "n": "no", "z": [1, 2]}'), ("c/x/_s_/2", '{"a": {"b": 2}}')], "shard_path string, data string")
    kept = counters.sum_leaves(counters.drop_overridden(counters.shard_leaves(rows)))
    assert {(".".join(r.leaf), r.value) for r in kept.collect()} == {("a.b", 2.0), ("z.0", 1.0), ("z.1", 2.0)}
    turned = rows.withColumn("shard_path", F.translate("shard_path", "12", "21"))
    kept = counters.sum_leaves(counters.drop_overridden(counters.shard_leaves(turned)))
    assert {(".".join(r.leaf), r.value) for r in kept.collect()} == {("a", 3.0), ("z.0", 1.0), ("z.1", 2.0)}


def test_counter_leaves_at_any_depth_and_with_dots(spark):
    deep = '{"a":' * 60 + "5" + "}" * 60
    rows = spark.createDataFrame([("c/x/_s_/1", deep), ("c/x/_s_/2", '{"a.b": 1, "b": {"c": true, "d": null}}'), ("c/x/_s_/3", '{"b": {"b": 2}}'), ("c/x/_s_/4", None), ("c/x/_s_/5", "no json")], "shard_path string, data string")
    assert {(tuple(r.leaf), r.value) for r in counters.shard_leaves(rows).collect()} == {(("a",) * 60, 5.0), (("a.b",), 1.0), (("b", "b"), 2.0)}


def test_what_cannot_be_summed_is_told(spark):
    rows = [("c/x/_s_/1", '{"a": 1'), ("c/x/_s_/2", '{"a":' * 20_000 + "1" + "}" * 20_000), ("c/x/_s_/3", '{"a": %s, "b": 2, "s": "7", "t": true}' % ("9" * 400)), ("c/x/_s_/4", '{"a": NaN}'), ("c/x/_s_/5", None), ("c/x/_s_/6", "7"), ("c/x/_s_/7", '{"b": 1}')]
    shards = spark.createDataFrame(rows, "shard_path string, data string")
    assert {(tuple(r.leaf), r.value) for r in counters.sum_leaves(counters.shard_leaves(shards)).collect()} == {(("b",), 3.0)}
    told = {(r.shard_path[-1], r.error) for r in counters.unread(shards).collect()}
    assert told == {("1", counters.NO_JSON), ("2", counters.NO_JSON), ("4", counters.NO_JSON), ("3", counters.NO_NUMBER)}
    more = shards.unionByName(spark.createDataFrame([("c/x/_s_/8", "{}")], "shard_path string, data string"))
    assert {r.shard_path[-1] for r in counters.remaining(more, shards).collect()} == {"1", "2", "3", "4", "8"}


def test_stored_numbers_give_way_to_objects(spark):
    stored = spark.createDataFrame([("c/x", ["a"], 5.0), ("c/x", ["k"], 1.0), ("c/y", ["o", "p"], 2.0)], "counter string, leaf array<string>, value double")
    update = spark.createDataFrame([("c/x", ["a", "b"], 3.0), ("c/y", ["o"], 4.0)], "counter string, leaf array<string>, value double")
    assert {(r.counter, tuple(r.leaf), r.value) for r in counters.apply_counter(stored, update).collect()} == {("c/x", ("a", "b"), 3.0), ("c/x", ("k",), 1.0), ("c/y", ("o",), 4.0)}


def test_erasure_takes_what_is_below_valid_hits(spark):
    docs = spark.createDataFrame([("u/7", None), ("u/7/x/1", None), ("u/7/x/1/y/2", None), ("n/5", "7"), ("n/5/z/1", None), ("7/q", None), ("7/q/r/s", None), ("k/8", None)], "path string, owner string")
    users = spark.createDataFrame([("7",)], "uid string")
    assert {r.path for r in erase.erase_users(docs, users, ["owner"]).collect()} == {"k/8"}
    assert {r.path for r in erase.erase_users(docs, users, ["owner"], mode="shallow").collect()} == {"u/7/x/1", "u/7/x/1/y/2", "n/5/z/1", "k/8"}
    assert {(r.path, r.kind) for r in erase.erasure_audit(docs, users, ["owner"]).collect()} == {("u/7", "document"), ("n/5", "document"), ("7", "collection")}


MAIL = "mail_id long, to array<string>, cc array<string>, message struct<subject:string>, delivery struct<state:string,attempts:int,leaseExpireTime:timestamp,error:string,expireAt:timestamp>"


def test_mail_keeps_its_other_fields(spark):
    import datetime as dt

    at = dt.datetime(2024, 5, 1)
    now = F.lit("2024-04-01").cast("timestamp")
    df = spark.createDataFrame([(1, ["a"], None, ("s",), ("PENDING", 2, None, "e", at)), (2, ["a"], None, ("s",), ("PROCESSING", 0, dt.datetime(2024, 3, 1), None, at)), (3, ["a"], None, None, None), (4, ["a"], None, ("s",), None)], MAIL)
    got = {r.mail_id: r.next for r in mail.mail_transition(df, now, ("day", 1)).collect()}
    assert (got[1].state, got[1].attempts, got[1].error, got[1].expireAt) == ("PROCESSING", 2, "e", at)
    assert (got[2].state, got[2].error, got[2].leaseExpireTime, got[2].expireAt) == ("ERROR", mail.LEASE_ERROR, dt.datetime(2024, 3, 1), at)
    assert got[3] is None
    assert (got[4].state, got[4].expireAt) == ("PENDING", dt.datetime(2024, 4, 2))


def test_only_mail_in_process_is_sent(spark):
    rows = [(1, ["a"], ["c", "d"], ("s",), ("PROCESSING", 1, None, "old", None)), (2, ["a"], None, ("s",), ("SUCCESS", 1, None, None, None)), (3, None, [], ("s",), ("PROCESSING", 0, None, None, None)), (4, ["bad"], None, ("s",), ("PROCESSING", 0, None, None, None)), (5, ["a"], None, ("s",), None)]

    def send(batch):
        if any("bad" in x for x in batch["to"]):
            raise ValueError("refused")
        return batch["to"].str.len() + 10 * batch["cc"].str.len()

    got = {r.mail_id: r.delivery for r in mail.deliver(spark.createDataFrame(rows, MAIL), send).collect()}
    assert {i: (d.state, d.attempts, d.info, d.error) for i, d in got.items()} == {1: ("SUCCESS", 2, "21", None), 3: ("ERROR", 1, None, mail.NOBODY), 4: ("ERROR", 1, None, "refused")}
    assert all(d.endTime for d in got.values())


def test_late_events_are_kept_and_repeated_ones_are_not(spark, tmp_path):
    from docflow.streaming.streams import stream_changelog

    def change(event_id, at):
        return ("u/a", "u/a", "{}", '{"v":1}', event_id, at)

    schema = "before_path string, after_path string, before string, after string, event_id string, timestamp string"
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in ([change("1", "2024-01-02")], [change("2", "2024-01-01"), change("1", "2024-01-02"), change("2", "2024-01-01")]):
        spark.createDataFrame(rows, schema).withColumn("timestamp", F.col("timestamp").cast("timestamp")).write.mode("append").parquet(source)
        stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
        stream_changelog(stream, str(tmp_path / "cp"), out, "p").awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == ["1", "2"]


@pytest.mark.parametrize(("shard", "level", "want"), [("12345678", 4, "\t1234"), ("12345678", 1, "\t\t\t\t1"), ("\t\t\t12", 2, "\t\t\t\t1"), ("\t1234", 4, "\t\t123")])
def test_aggregate_paths(spark, shard, level, want):
    assert value(spark, counters.aggregate_path(F.lit(f"c/x/_s_/{shard}"), level)) == f"c/x/_s_/{want}"


def test_compaction(spark):
    updates = lambda *xs: '{"_updates_": [' + ",".join(f'{{"_id_": "{i}", "_data_": {x}}}' for i, x in enumerate(xs)) + "]}"
    rows = spark.createDataFrame([("c/x/_s_/1", updates(*['{"a": 1}'] * 11)), ("c/x/_s_/2", updates('{"a": 1}', '{"a": -1}')), ("c/x/_s_/3", updates('{"a": 4}')), ("c/x/_s_/4", "{}")], "shard_path string, data string")
    got = {(r.shard_path[-1], r.action, r.value) for r in counters.compact_partials(rows).collect()}
    assert got == {("1", "compact", 11.0), ("2", "delete", None), ("3", "keep", None), ("4", "delete", None)}


def test_named_query_parameters(spark):
    df = spark.createDataFrame([(1, "5", None), (2, "6", True)], "id long, s string, b boolean")
    assert named.named_query(df, {"conditions": [{"where": ["s", "==", "'5'"]}]}).count() == 1
    with pytest.raises(ValueError, match="required"):
        named.named_query(df, {"params": {"p": {"required": True}}})
    assert [r.id for r in named.named_query(df, {"conditions": [{"orderBy": ["b"]}]}).collect()] == [2]
    with pytest.raises(ValueError, match="limitToLast"):
        named.named_query(df, {"conditions": [{"limitToLast": 1}]})


def test_translation_failures_keep_successes(spark):
    df = spark.createDataFrame([(1, "good", {"fr": "old"}), (2, "bad", {}), (3, None, {"de": "x"})], "doc_id long, input string, existing map<string,string>")

    def fn(batch):
        if (batch["input"] == "bad").any():
            raise ValueError("no")
        return batch["input"] + batch["lang"]

    got = {r.doc_id: (r.translations, r.n_errors) for r in enrich.translate(df, fn, F.array(F.lit("fr"), F.lit("en")), missing_only=True).collect()}
    assert got == {1: ({"fr": "old", "en": "gooden"}, 0), 2: ({}, 2), 3: ({"de": "x"}, 0)}


@pytest.mark.parametrize(
    ("doc", "want"),
    [
        ("{}", ["no recipient", "no message, template or sendGrid"]),
        ('{"to": ["a"], "message": {"subject": "s", "text": "t"}}', []),
        ('{"to": ["a"], "message": {"text": "t"}}', ["message without subject"]),
        ('{"toUids": ["", "u"], "message": {"subject": "s"}}', ["message without text or html", "empty uid in toUids"]),
        ('{"cc": ["a"], "template": {"name": ""}}', ["template without name"]),
        ('{"bcc": ["a"], "template": {"name": "t"}, "message": {}}', []),
        ('{"to": ["a"], "sendGrid": {"dynamicTemplateData": {"a": "b"}}}', ["dynamic data without templateId"]),
    ],
)
def test_mail_validation(spark, doc, want):
    schema = "to array<string>, cc array<string>, bcc array<string>, toUids array<string>, message struct<subject:string,text:string,html:string>, template struct<name:string>, sendGrid struct<templateId:string,dynamicTemplateData:map<string,string>>"
    df = spark.createDataFrame([(doc,)], "d string").select(F.from_json("d", schema).alias("m")).select("m.*")
    assert mail.validate_mail(df).first().errors == want


def test_template_rendering():
    partials = {"foot": "-{{x.y}}-", "self": "{{> self}}"}
    assert mail.render_text("{{a}} {{{a}}} {{> foot}} {{none}}{{> no}}", {"a": "<&", "x": {"y": 1}}, partials, True) == "&lt;&amp; <& -1- "
    assert mail.render_text("{{a}}", {"a": "<&"}, partials, False) == "<&"
    assert mail.render_text(None, {}, partials, True) is None
    chain = {f"p{i}": f"{{{{> p{i + 1}}}}}" for i in range(30)} | {"p30": "end"}
    assert mail.render_text("{{> p0}}", {}, chain, True) == "end"
    with pytest.raises(ValueError, match="itself"):
        mail.render_text("{{> self}}", {}, partials, True)


@pytest.mark.parametrize(
    ("name", "folder", "want"),
    [("a/b/x.png", "failed", "a/b/failed/x.png"), ("x.png", "failed", "failed/x.png"), ("a/x.png", "../out", None), ("a/x.png", "in/../../out", None), ("a/x.png", "", "a/x.png")],
)
def test_failed_paths_stay_inside(spark, name, folder, want):
    assert value(spark, objects.failed_path(F.lit(name), folder)) == want


def test_variant_names_and_sizes(spark):
    name = lambda n, f: value(spark, objects.variant_name(F.lit(n), F.lit("9x9"), F.lit(f)))
    assert [name("d/a.png", "jpeg"), name("d/a.PNG", "false"), name("d/a", "png"), name("d/a.xyz", "png"), name("d/a.b.gif", "webp")] == ["a_9x9.jpeg", "a_9x9.PNG", "a_9x9", "a.xyz_9x9", "a.b_9x9.webp"]
    assert value(spark, objects.parse_size(F.lit("200,100")))["height"] == 100
    assert value(spark, objects.parse_size(F.lit("200"))) is None


def test_partition_strategies():
    assert tables.partition_strategy("NONE", None) == (None, None)
    assert tables.partition_strategy("FIELD", "HOUR", "d", "DATE") == (None, None)
    assert tables.partition_strategy("FIELD", "DAY", "timestamp", "DATETIME") == (None, None)
    with pytest.raises(ValueError, match="granularity"):
        tables.partition_strategy("TIMESTAMP", "WEEK")
    with pytest.raises(ValueError, match="field"):
        tables.partition_strategy("FIELD", "DAY")


def test_clustering_limits(spark, tmp_path):
    df = spark.range(5).withColumn("a", F.array("id"))
    with pytest.raises(ValueError, match="four"):
        tables.write_clustered(df, str(tmp_path / "x"), list("abcde"))
    tables.write_clustered(df, str(tmp_path / "y"), ["a"])
    assert spark.read.parquet(str(tmp_path / "y")).count() == 5


def test_imports_give_way_to_later_changes(spark):
    docs = spark.createDataFrame([("users/a", "{}"), ("users/a/b/c", "{}")], "path string, data string")
    rows = capture.import_collection(docs, "p", "users")
    live = log(spark, [("projects/p/databases/(default)/documents/users/a", "2024-01-01", "1", "UPDATE", '{"v":1}')])
    both = capture.union_imports(live, rows)
    assert both.count() == 3
    assert {r.event_id for r in latest.latest_materialized(both).collect()} == {"1", ""}


def test_capture_of_a_change(spark):
    rows = spark.createDataFrame([(None, "u/a", None, "{}"), ("u/a", "u/a", "{}", "{}"), ("u/a", None, "{}", None)], "before_path string, after_path string, before string, after string")
    made = capture.changelog_rows(rows.withColumn("timestamp", F.current_timestamp()).withColumn("event_id", F.lit("1")), "p", template="u/{documentId}")
    assert [(r.operation, r.data, r.old_data, r.document_id, r.path_params) for r in made.collect()] == [("CREATE", "{}", None, "a", "{}"), ("UPDATE", "{}", "{}", "a", "{}"), ("DELETE", None, "{}", "a", "{}")]


def test_screening_is_dealt_out_whatever_the_files(spark):
    made = spark.createDataFrame([(i, "n", "image/png") for i in range(40)], "object_id long, name string, contentType string").coalesce(1)
    judged = objects.screen_content(made, lambda b: [True] * len(b))
    assert judged.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
    assert sorted(tuple(r) for r in judged.collect()) == [(i, "pass") for i in range(40)]


def test_only_tied_documents_are_looked_through_for_repeated_rows(spark):
    spec = [views.Field("a", "array"), views.Field("s", "string")]
    rows = [("x", 1, '{"a": [1, 2], "s": "k"}'), ("x", 1, '{"a": [1, 3], "s": "k"}'), ("x", 0, '{"a": [9]}'), ("y", 1, '{"a": [4, 4]}'), ("z", 2, '{"a": []}'), ("z", 2, '{"a": []}')]
    log = spark.createDataFrame([(n, n, t, "CREATE", d) for n, t, d in rows], "document_name string, document_id string, timestamp int, operation string, data string")
    log = log.withColumn("timestamp", F.timestamp_seconds("timestamp"))
    view = views.schema_latest(log, spec)
    got = sorted(((r.document_id, r.a_index, r.a_member) for r in view.collect()), key=repr)
    assert got == sorted([("x", 0, "1"), ("x", 1, "2"), ("x", 1, "3"), ("y", 0, "4"), ("y", 1, "4"), ("z", None, None)], key=repr)
    plan = view._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Union") < plan.index("Aggregate") and plan.count("Aggregate") == 1
