"""Object prefixes, a user's own search, maps of texts, ids that are texts."""

import pytest
from pyspark.sql import functions as F

from docflow.operators import enrich, erase, mail, objects


def test_objects_go_by_raw_prefix(spark):
    names = ["users/7/a.png", "users/7-avatar.png", "users/70/b", "users/7", "users/8", "x/users/7", "other/7/c"]
    held = spark.createDataFrame([(b, n) for b in ("main", "shop") for n in names], "bucket string, name string")
    users = spark.createDataFrame([("7",), ("300",)], "uid string")

    def left(templates, **options):
        return {(r.bucket, r.name) for r in erase.erase_objects(held, users, templates, "main", **options).collect()}

    every = {("main", n) for n in names} | {("shop", n) for n in names}
    assert every - left("{DEFAULT}/users/{UID}") == {("main", n) for n in ("users/7/a.png", "users/7-avatar.png", "users/70/b", "users/7")}
    assert every - left("{DEFAULT}/users/{UID}/,shop/other/{UID}/") == {("main", "users/7/a.png"), ("shop", "other/7/c")}
    assert every - left("{DEFAULT}/users/{UID}-avatar") == {("main", "users/7-avatar.png")}
    assert every - left("{DEFAULT}/users/{UID}/", mode="segments") == {("main", "users/7/a.png"), ("main", "users/7")}
    assert every - left("shop") == {("shop", n) for n in names}  # a bucket alone is all of it
    assert erase.erase_objects(held, users.limit(0), "{DEFAULT}/users/{UID}", "main").count() == 14


def test_a_search_is_checked_and_told(spark):
    docs = spark.createDataFrame([("a/1/b/2/c/3/d/7", None), ("a/1/b/2/c/3/d/7/e/1", None), ("k/1", None), ("k/2", "7"), ("z/9", None)], "path string, owner string")
    users = spark.createDataFrame([("7",), ("8",)], "uid string")

    def search(uids):
        return [["a/1/b/2/c/3/d/7", "k/1", "k/2", "not/there"] if u == "7" else None for u in uids]

    told = {(r.uid, r.path, r.kind) for r in erase.erasure_audit(docs, users, ["owner"], search=search).collect()}
    assert told == {("7", "a/1/b/2/c/3/d/7", "document"), ("7", "k/1", "invalid"), ("7", "k/2", "document")}
    assert {r.path for r in erase.erase_users(docs, users, ["owner"], search=search).collect()} == {"k/1", "z/9"}
    assert {r.path for r in erase.erase_users(docs, users, ["owner"]).collect()} == {r.path for r in docs.collect()} - {"k/2"}
    with pytest.raises(Exception, match="a list of paths for each uid"):
        erase.erase_users(docs, users, ["owner"], search=lambda uids: []).collect()


def test_maps_of_texts(spark):
    rows = [(1, '"one"', None), (2, '{"a": "x", "b": 5, "c": null, "d": {"e": "deep"}}', {"a": {"de": "kept", "it": "old"}, "gone": {"it": "old"}}), (3, None, {"": {"de": "kept"}}), (4, "{}", None), (5, "7", None), (6, '{"a": "bad"}', None)]
    df = spark.createDataFrame(rows, f"doc_id long, data string, existing {enrich.NESTED}").withColumn("input", F.try_parse_json("data"))
    langs = F.array(F.lit("de"), F.lit("fr"))

    def fn(batch):
        if (batch["input"] == "bad").any():
            raise ValueError("refused")
        return batch["input"] + ":" + batch["lang"]

    def run(**options):
        return {r.doc_id: (r.translations, r.n_errors) for r in enrich.translate_fields(df, fn, langs, **options).collect()}

    none = {"de": None, "fr": None}
    got = run()
    assert got[1] == ({"": {"de": "one:de", "fr": "one:fr"}}, 0)
    assert got[2] == ({"a": {"de": "x:de", "fr": "x:fr"}, "b": none, "c": none, "d": none}, 0)
    assert got[3] == ({"": {"de": "kept"}}, 0) and got[4] == ({}, 0) and got[5] == ({}, 0)
    assert got[6] == ({"a": {}}, 2)
    kept = run(missing_only=True)
    assert kept[2][0]["a"] == {"de": "kept", "it": "old", "fr": "x:fr"} and kept[2][0]["gone"] == {"it": "old"}


def logging_translator(log):
    def fn(batch):
        with open(log, "a") as f:
            f.writelines(f"{t}:{x}\n" for t, x in zip(batch["input"], batch["lang"], strict=True))
        return batch["input"] + ":" + batch["lang"]

    return fn


def test_each_text_is_sent_once_in_each_language(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(enrich, "BATCH_BYTES", 3)  # a batch is a text, so what was made is kept from batch to batch
    rows = [(i, f'"{"ab"[i % 2]}"', ["de", "fr"] if i % 3 else ["it"], None) for i in range(40)]
    rows += [(100 + i, f'{{"x": "a", "y": "c{i % 2}", "z": 7}}', ["de"], {"x": {"de": "kept"}} if i == 1 else None) for i in range(4)]
    df = spark.createDataFrame(rows, f"doc_id long, data string, languages array<string>, existing {enrich.NESTED}").withColumn("input", F.parse_json("data")).repartition(7)
    got = {r.doc_id: r.translations for r in enrich.translate_fields(df, logging_translator(str(tmp_path / "log")), F.col("languages"), missing_only=True).collect()}
    assert sorted((tmp_path / "log").read_text().split()) == ["a:de", "a:fr", "a:it", "b:de", "b:fr", "b:it", "c0:de", "c1:de"]
    assert all(got[i] == {"": {x: f"{'ab'[i % 2]}:{x}" for x in rows[i][2]}} for i in range(40))
    assert all(got[100 + i] == {"x": {"de": "kept" if i == 1 else "a:de"}, "y": {"de": f"c{i % 2}:de"}, "z": {"de": None}} for i in range(4))


@pytest.mark.parametrize("whole", [True, False])
def test_what_was_made_of_a_text_is_not_shuffled(spark, whole):
    texts = spark.range(400).select(F.col("id").alias("doc_id"), F.concat_ws("", F.transform(F.sequence(F.lit(1), F.lit(300)), lambda i: F.md5(F.concat("id", F.lit(" "), i.cast("string"))))).alias("input"))
    made = spark.createDataFrame(texts.toPandas()).repartition(4)  # 9,600 characters each, which do not shrink below half
    df = made.select("doc_id", "input" if whole else F.col("input").cast("variant").alias("input"), F.lit(None).cast("map<string,string>" if whole else enrich.NESTED).alias("existing")).localCheckpoint()
    written = lambda: sum(x.apply(i).totalShuffleWrite() for x in [spark.sparkContext._jsc.sc().statusStore().executorList(False)] for i in range(x.size()))
    before = written()
    translate = enrich.translate if whole else enrich.translate_fields
    told = translate(df, lambda b: b["input"] + b["lang"], F.array(*map(F.lit, ("de", "en", "fr"))))
    assert told.select(F.sum(F.length(told.translations.cast("string"))).alias("n")).first().n > 3 * 400 * 9600
    assert written() - before < 1.3 * 400 * 9600


def test_names_that_would_not_end():
    enrich.check_names("text", "translated", ["en"])
    for field, output in (("text", "text"), ("out.en", "out")):
        with pytest.raises(ValueError):
            enrich.check_names(field, output, ["en", "de"])


def test_ids_may_be_texts(spark):
    rows = [("m1", {"subject": "s"}, ["a@x"], "PROCESSING"), ("m2", {"subject": "s"}, ["a@x"], "PENDING")]
    df = spark.createDataFrame(rows, "mail_id string, message map<string,string>, to array<string>, state string")
    df = df.withColumn("delivery", F.struct("state", F.lit(0).alias("attempts"), F.lit(None).cast("timestamp").alias("leaseExpireTime"), F.lit(None).cast("string").alias("error"))).drop("state")
    assert [(r.mail_id, r.delivery.state) for r in mail.deliver(df, lambda b: ["ok"] * len(b)).collect()] == [("m1", "SUCCESS")]
    held = spark.createDataFrame([("o1", "n", "image/png")], "object_id string, name string, contentType string")
    assert [r.object_id for r in objects.screen_content(held, lambda b: [True] * len(b)).collect()] == ["o1"]
