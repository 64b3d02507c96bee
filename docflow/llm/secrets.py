"""Secret scans with multipart credential linking, in built-in column expressions only.

Strong parts (key assignments, access identifiers, long hexadecimal runs) are reported on their own.
Weak parts (bare 40-character keys, identifier assignments, endpoints) are reported only where
complementary parts co-occur within `scope` code points: a bare key needs an access identifier, an
identifier assignment needs a secret, an endpoint needs both. Parts are joined as intervals: each
covers cells of its text, probes cover the cells that their scope reaches, and an equi-join on
(text, cell) with the distance as residual is taken as a semi-join, so partners are never paired out.

Positions come from the pieces between matches, which `split` gives, as Spark has no function that
lists match positions.

Defined cases: null texts are empty and have no spans; overlapping strong parts are all reported; a
weak part that overlaps a strong one is not; rows that repeat a doc_id are told apart by their text,
and rows that repeat both have equal results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import own_columns, private, settle

# Kinds in the order of reports, the role that each plays, and the roles that a weak kind needs.
KINDS = ("assign", "access", "hex", "key", "ident", "endpoint")
ROLES = {"assign": "secret", "access": "access", "hex": "secret", "key": "secret", "ident": "access", "endpoint": "endpoint"}
NEEDS = {"key": ("access",), "ident": ("secret",), "endpoint": ("access", "secret")}

PATTERNS = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{24,}",
    "key": r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])",
    "ident": r"""(?i)(?:access_?key_?id|client_?id|account_?id|login|user_?name)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}""",
    "endpoint": r"""(?:https?|s3|jdbc:[a-z]+|redis|mongodb|postgres(?:ql)?|mysql|amqps?)://[^\x00-\x20"'<>\x7F]+""",
}

SPANS = "array<struct<kind:int,start:int,end:int>>"


def _spans(text: Column, kind: str, only_if: Column, group: int = 0, least: int = 0) -> Column:
    """Spans of the leftmost non-overlapping matches; those whose group is shorter than least are dropped."""
    pattern = F.lit(PATTERNS[kind])
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    part = F.regexp_extract_all(text, pattern, F.lit(group)) if group else whole
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["between"])
        end = start + F.char_length(x["whole"])
        own = F.array(F.struct(F.lit(KINDS.index(kind)).alias("kind"), start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(F.char_length(x["part"]) >= least, F.concat(acc["spans"], own)).otherwise(acc["spans"]).alias("spans"))

    zipped = F.arrays_zip(F.slice(F.split(text, PATTERNS[kind], -1), F.lit(1), F.size(whole)).alias("between"), whole.alias("whole"), part.alias("part"))
    return F.when(only_if & text.rlike(PATTERNS[kind]), F.aggregate(zipped, zero, step)["spans"]).otherwise(F.array().cast(SPANS))


def found_parts(documents: DataFrame) -> DataFrame:
    """doc_id, text_key, strong and weak: the parts of each text before linking."""
    text = F.coalesce("text", F.lit(""))
    pairs = F.contains(F.col("t"), F.lit("=")) | F.contains(F.col("t"), F.lit(":"))
    keyed = documents.select("doc_id", text.alias("t"), text_key(text).alias("text_key"))
    strong = keyed.select(
        "doc_id",
        "text_key",
        "t",
        F.concat(
            _spans(F.col("t"), "assign", pairs, group=2, least=6),
            _spans(F.col("t"), "access", F.contains(F.col("t"), F.lit("AKIA")), least=20),
            _spans(F.col("t"), "hex", F.lit(True), least=24),
        ).alias("strong"),
        _spans(F.col("t"), "ident", pairs).alias("ident"),
    )
    some = (F.size("strong") > 0) | (F.size("ident") > 0)
    key = _spans(F.col("t"), "key", some)
    endpoint = _spans(F.col("t"), "endpoint", some & F.contains(F.col("t"), F.lit("://")))
    return strong.select("doc_id", "text_key", F.array_sort("strong").alias("strong"), F.concat("ident", key, endpoint).alias("weak"))


def text_key(text: Column) -> Column:
    """Tells texts apart that share a doc_id."""
    return F.struct(F.xxhash64(text).alias("hash"), F.char_length(text).alias("chars"))


def linked_parts(parts: DataFrame, scope: int = 200, cell: int = 400) -> DataFrame:
    """doc_id, text_key, linked: the weak parts whose complements lie within the scope."""
    cells = lambda lo, hi: F.explode(F.sequence(F.floor(lo / cell), F.floor(hi / cell)))
    named = lambda f: F.element_at(F.lit([f(k) for k in KINDS]), F.col("p.kind") + 1)
    some = parts.where(F.size("weak") > 0)
    every = some.select("doc_id", "text_key", F.explode(F.concat("strong", "weak")).alias("p")).distinct()
    every = every.select("doc_id", "text_key", "p", named(lambda k: ROLES[k]).alias("role"))
    others = every.select(
        F.col("doc_id").alias("o_id"), F.col("text_key").alias("o_key"), F.col("p").alias("o"), F.col("role").alias("o_role"), cells(F.col("p.start"), F.col("p.end")).alias("o_cell")
    )
    weak = every.where(F.col("p.kind") >= KINDS.index("key")).select("doc_id", "text_key", "p", cells(F.col("p.start") - scope, F.col("p.end") + scope).alias("cell"))
    near = F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("text_key") == F.col("o_key")) & (F.col("cell") == F.col("o_cell"))
    strong = F.col("o.kind") < KINDS.index("key")
    covered = weak.join(others, near & strong & (F.col("o.start") < F.col("p.end")) & (F.col("p.start") < F.col("o.end")), "left_semi")
    covered = covered.select("doc_id", "text_key", "p").distinct().withColumn("needed", F.lit(-1))
    needs = F.element_at(F.lit([list(NEEDS.get(k, ())) for k in KINDS]), F.col("p.kind") + 1)
    wanting = weak.select("*", F.explode(needs).alias("need"))
    met = wanting.join(others, near & (F.col("need") == F.col("o_role")) & (F.col("o.start") <= F.col("p.end") + scope) & (F.col("p.start") <= F.col("o.end") + scope), "left_semi")
    met = met.select("doc_id", "text_key", "p", "need").distinct()
    counted = met.select("doc_id", "text_key", "p", F.lit(1).alias("needed")).unionByName(covered)
    counted = counted.groupBy("doc_id", "text_key", "p").agg(F.sum(F.when(F.col("needed") > 0, 1).otherwise(0)).alias("met"), F.min("needed").alias("least"))
    linked = counted.where((F.col("least") > 0) & (F.col("met") == F.size(needs)))
    return linked.groupBy("doc_id", "text_key").agg(F.collect_list("p").alias("linked"))


def scan(documents: DataFrame, scope: int = 200) -> DataFrame:
    """doc_id, text_key, strong, spans: strong parts, and all reported parts in order."""
    parts = settle(found_parts(documents), "parts")
    linked = settle(linked_parts(parts, scope), "linked").withColumnsRenamed({"doc_id": "l_id", "text_key": "l_key"})
    joined = parts.join(linked, F.col("doc_id").eqNullSafe(F.col("l_id")) & (F.col("text_key") == F.col("l_key")), "left")
    every = F.concat("strong", F.coalesce("linked", F.array().cast(SPANS)))
    ordered = F.array_sort(every, lambda a, b: F.when(_place(a) < _place(b), -1).when(_place(a) > _place(b), 1).otherwise(0))
    strong = F.array_sort("strong", lambda a, b: F.when(_place(a) < _place(b), -1).when(_place(a) > _place(b), 1).otherwise(0))
    return joined.select("doc_id", "text_key", strong.alias("strong"), ordered.alias("spans"))


def _place(p: Column) -> Column:
    return F.struct(p["start"], p["kind"], p["end"])


def told(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda p: F.concat_ws(":", F.element_at(F.lit(list(KINDS)), p["kind"] + 1), p["start"].cast("string"), p["end"].cast("string"))), ",")


def report(documents: DataFrame) -> DataFrame:
    """Counts of the strong kinds, the digest of their spans, and all spans."""
    count = lambda k: F.size(F.filter("strong", lambda p: p["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return scan(documents).select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(told(F.col("strong")), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each span, or run of overlapping spans, replaced by the mark."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("kept"))

    def step(acc: Column, p: Column) -> Column:
        apart = F.concat(acc["kept"], F.array(F.substring(text, acc["at"] + 1, p["start"] - acc["at"]), F.lit(mark)))
        return F.struct(F.greatest(acc["at"], p["end"]).alias("at"), F.when((p["start"] >= acc["at"]), apart).otherwise(acc["kept"]).alias("kept"))

    def finish(acc: Column) -> Column:
        return F.concat(F.array_join(acc["kept"], ""), F.substring(text, acc["at"] + 1, 2147483647))

    return F.aggregate(spans, zero, step, finish)


def redact(documents: DataFrame) -> DataFrame:
    """The documents with every reported span replaced, n_chars counted anew where the text changed."""
    s_id, s_key, s_spans, own_key = private(documents, "s_id", "s_key", "spans", "key")
    found = scan(documents).where(F.size("spans") > 0).distinct()
    found = settle(found.select(F.col("doc_id").alias(s_id), F.col("text_key").alias(s_key), F.col("spans").alias(s_spans)), "spans")
    key = text_key(F.coalesce("text", F.lit("")))
    joined = documents.withColumn(own_key, key).join(found, F.col("doc_id").eqNullSafe(F.col(s_id)) & (F.col(own_key) == F.col(s_key)), "left")
    text = F.when(F.col(s_spans).isNull(), F.col("text")).otherwise(redacted(F.col("text"), F.col(s_spans)))
    kept = joined.withColumn("text", text)
    if "n_chars" in documents.columns:
        kept = kept.withColumn("n_chars", F.when(F.col(s_spans).isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long")))
    return kept.select(*own_columns(documents))
