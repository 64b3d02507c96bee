"""Field specs from files, and documents with bytes."""

import json

import pytest

from docflow.operators import capture
from docflow.operators.views import Field
from docflow.sources import specs


def put(path, *fields):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps({"fields": list(fields)}))


@pytest.mark.parametrize("path,want", [("/a/user-info.json", "user_info"), ("a.b-c.json", "a.b_c"), ("hdfs://n/x/plain", "plain")])
def test_names(path, want):
    assert specs.spec_name(path) == want


def test_lists_globs_folders_and_the_last_of_a_name(spark, tmp_path):
    put(tmp_path / "one" / "user-info.json", {"name": "a", "type": "string"})
    put(tmp_path / "one" / "pets.json", {"name": "p", "type": "map", "fields": [{"name": "q", "type": "number"}]})
    put(tmp_path / "two" / "user_info.json", {"name": "b", "type": "boolean", "column_name": "c", "description": "d"})
    one, two = tmp_path / "one", tmp_path / "two"
    user, pets = [Field("a", "string")], [Field("p", "map", (Field("q", "number"),))]
    late = [Field("b", "boolean", (), "c", "d")]
    assert specs.read_specs(spark, [str(one)]) == {"pets": pets, "user_info": user}
    assert specs.read_specs(spark, [f"{one}/*.json , {two}/user_info.json"]) == {"pets": pets, "user_info": late}
    assert specs.read_specs(spark, [str(two), f"{one}/u*"]) == {"user_info": user}
    assert specs.read_specs(spark, [f"{one}/none-*.json", "", f"{tmp_path}/absent"]) == {}


@pytest.mark.parametrize("text", ["{", "[]", '{"fields": [{"type": "string"}]}', '{"fields": 5}'])
def test_a_file_that_is_no_spec_is_named(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(ValueError, match="bad.json is not a field spec"):
        specs.read_specs(spark, [str(tmp_path)])


def test_views_of_specs(spark):
    log = spark.createDataFrame([("d/1", "1", "2024-01-01", "e", "CREATE", '{"a": "x"}'), ("d/1", "1", "2024-01-02", "f", "UPDATE", '{"a": "y"}')], "document_name string, document_id string, timestamp string, event_id string, operation string, data string")
    made = specs.spec_views(log, {"s": [Field("a", "string")]}, "log")
    assert [r.a for r in made["log_schema_s_changelog"].orderBy("timestamp").collect()] == ["x", "y"]
    assert [r.a for r in made["log_schema_s_latest"].collect()] == ["y"]


def test_bytes_are_left_out_at_any_depth(spark):
    kind = "struct<raw: binary, only: struct<raw: binary>, m: map<string, struct<n: int, raw: binary>>, mm: map<string, map<string, binary>>, l: array<array<struct<n: int, raw: binary>>>, b: array<binary>, t: array<array<string>>, none: map<string, binary>>"
    raw = bytearray(b"x")
    row = (raw, (raw,), {"k": (1, raw), "z": None}, {"k": {"raw": raw}}, [[(2, raw), None], None, []], [raw, None], [["a", None]], None)
    df = spark.createDataFrame([(row,), (None,)], f"doc {kind}")
    got = [r.j for r in df.select(capture.serialize_document(df, "doc").alias("j")).collect()]
    assert json.loads(got[0]) == {"only": {}, "m": {"k": {"n": 1}, "z": None}, "mm": {"k": {}}, "l": [[{"n": 2}, None], None, []], "b": [], "t": [["a", None]], "none": None}
    assert got[1] is None


def test_plain_documents_stay(spark):
    df = spark.createDataFrame([((1, [None, "a"]),)], "doc struct<a: int, b: array<string>>")
    assert df.select(capture.serialize_document(df, "doc").alias("j")).first().j == '{"a":1,"b":[null,"a"]}'
