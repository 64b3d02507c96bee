"""Merging and tagging of nested documents."""

import json

import pytest
from pyspark.sql import functions as F

from docflow.functions import trees
from docflow.sources import tables


def run(spark, column, *texts):
    df = spark.createDataFrame([texts], ", ".join(f"c{i} string" for i in range(len(texts)))).select(*(F.try_parse_json(f"c{i}").alias(f"c{i}") for i in range(len(texts))))
    told = df.select(F.to_json(column).alias("x")).first().x
    return None if told is None else json.loads(told)


MERGES = [
    ('{"a": {"b": 1, "c": {"d": 2}}, "k": [1, 2]}', '{"a": {"c": {"e": 3}}, "k": [9]}', {"a": {"b": 1, "c": {"d": 2, "e": 3}}, "k": [9]}),
    ('{"a": {"b": 1}, "x": 5}', '{"a": null}', {"a": None, "x": 5}),
    ('{"a": 1}', '{"a": {"b": 2}}', {"a": {"b": 2}}),
    ('{"a": {"b": 2}}', '{"a": 1}', {"a": 1}),
    (None, '{"a": 1}', {"a": 1}),
    ('{"a": 1}', None, {"a": 1}),
    ('{"a": {}}', '{"a": {}}', {"a": {}}),
]


@pytest.mark.parametrize("old,new,want", MERGES)
def test_merge(spark, old, new, want):
    assert run(spark, trees.merge_trees(F.col("c0"), F.col("c1")), old, new) == want


def test_merge_at_the_deepest_level(spark):
    deep = lambda leaf: '{"n":' * 19 + leaf + "}" * 19
    assert run(spark, trees.merge_trees(F.col("c0"), F.col("c1")), deep('{"a": 1}'), deep('{"b": 2}')) == json.loads(deep('{"a": 1, "b": 2}'))


def test_tags(spark):
    doc = {
        "at": {"_seconds": 86400, "_nanoseconds": 5_000_000},
        "where": {"_latitude": 1, "_longitude": 2.5},
        "who": {"_path": {"segments": ["users", "7"]}, "_firestore": {}},
        "list": [{"at": {"_seconds": 0, "_nanoseconds": 0}}, [1, "x", None], True],
        "plain": {"_seconds": 1},
        "none": None,
    }
    got = run(spark, trees.tag_tree(F.col("c0")), json.dumps(doc))
    assert got == {
        "at": {"_type": "timestamp", "value": "1970-01-02T00:00:00.005Z"},
        "where": {"_type": "geopoint", "latitude": 1.0, "longitude": 2.5},
        "who": {"_type": "reference", "path": "users/7"},
        "list": [{"at": {"_type": "timestamp", "value": "1970-01-01T00:00:00.000Z"}}, [1, "x", None], True],
        "plain": {"_seconds": 1},
        "none": None,
    }
    assert run(spark, trees.tag_tree(F.col("c0")), None) is None and run(spark, trees.tag_tree(F.col("c0")), "7") == 7


def test_documents_merge_in_structs_and_trees(spark):
    old = spark.sql("SELECT 1 AS id, named_struct('a', 1, 'b', named_struct('c', 2, 'd', 3)) AS s, parse_json('{\"x\": {\"y\": 1}}') AS v UNION ALL SELECT 2, NULL, NULL")
    new = spark.sql("SELECT 1 AS id, named_struct('b', named_struct('d', 9), 'e', 5) AS s, parse_json('{\"x\": {\"z\": null}}') AS v UNION ALL SELECT 3, named_struct('b', named_struct('d', 7), 'e', 6), NULL")
    got = {r.id: (r.s, r.v) for r in tables.merge_documents(old, new, "id").select("id", F.to_json("s").alias("s"), F.to_json("v").alias("v")).collect()}
    assert json.loads(got[1][0]) == {"a": 1, "b": {"c": 2, "d": 9}, "e": 5} and json.loads(got[1][1]) == {"x": {"y": 1, "z": None}}
    assert got[2] == (None, None) and json.loads(got[3][0]) == {"b": {"d": 7}, "e": 6}


def test_a_value_is_taken_apart_once_at_each_level(spark):
    plan = spark.sql("SELECT parse_json('{}') AS v").select(trees.tag_tree(F.col("v"), 1).alias("t"))._jdf.queryExecution().analyzed().toString()
    assert plan.lower().count("maptype(") + plan.lower().count("map<") == 1
    empty = '{"a": {}, "b": [], "c": [{}, []]}'
    assert run(spark, trees.tag_tree(F.col("c0")), empty) == json.loads(empty)


@pytest.mark.parametrize("levels", [9, 10, 20, 45, 900])
def test_tags_at_any_depth(spark, levels):
    deep = lambda *leaves: '{"n":[0,' * (levels // 2) + '{"n":' * (levels % 2) + "[" + ",".join(leaves) + "]" + "}" * (levels % 2) + "]}" * (levels // 2)
    raw = deep('{"_seconds": 0, "_nanoseconds": 999999999}', '{"_latitude": 1, "_longitude": 2}', '{"_path": {"segments": ["a", "b"]}, "more": {}}', "12345678901234567890.5")
    want = deep('{"_type":"timestamp","value":"1970-01-01T00:00:00.999Z"}', '{"_type":"geopoint","latitude":1.0,"longitude":2.0}', '{"_type":"reference","path":"a/b"}', "12345678901234567890.5")
    told = spark.createDataFrame([(raw,)], "c string").select(F.to_json(trees.tag_tree(F.parse_json("c"))).alias("x")).first().x
    assert told == want


def test_tags_are_in_utc_and_leave_other_values(spark):
    docs = ['{"t": {"_seconds": 253402300800, "_nanoseconds": 0}}', '{"t": {"_seconds": -62167219201, "_nanoseconds": 0}}', '{"t": {"_seconds": 1.9, "_nanoseconds": "0"}, "x": "\\u00fc\\"\\n"}', '{"t": {"_seconds": "x", "_nanoseconds": 0}}']
    want = ["+010000-01-01T00:00:00.000Z", "-000001-12-31T23:59:59.000Z", "1970-01-01T00:00:01.000Z", None]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(d,) for d in docs], "c string").select(trees.tag_tree(F.parse_json("c")).alias("v"))
        got = df.select(F.try_variant_get("v", "$.t.value", "string").alias("t"), F.try_variant_get("v", "$.x", "string").alias("x")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r.t for r in got] == want and [r.x for r in got] == [None, None, 'ü"\n', None]
    kinds = spark.sql("SELECT to_variant_object(named_struct('d', date'2020-01-01', 'f', 1.5D)) AS v").select(F.schema_of_variant(trees.tag_tree(F.col("v"))).alias("k")).first().k
    assert kinds == "OBJECT<d: DATE, f: DOUBLE>"


def test_tags_of_the_first_levels_only(spark):
    time = '{"_seconds": 0, "_nanoseconds": 0}'
    got = run(spark, trees.tag_tree(F.col("c0"), 2), f'{{"a": {time}, "b": {{"c": {time}}}}}')
    assert got == {"a": {"_type": "timestamp", "value": "1970-01-01T00:00:00.000Z"}, "b": {"c": json.loads(time)}}
