"""Chat formatting by schema fingerprint.

A record's fingerprint is the hash of those of its nested field paths that any mapping of the registry
reads, so that ids, names, sources and other fields beside them change nothing. It selects a declarative
mapping; the mapping is a list of fields, or an array with a role and a text path, and compiles to
column expressions. The result is the canonical form, an array of (role, text) turns. A template then marks the turns and escapes every
control string in texts and roles with a backslash, which the reader undoes.

All of it is built-in expressions, so a conversation is formatted where its rows meet.

Defined cases: null texts and roles are empty; turns are ordered by (turn, role, text), nulls first; a
null conv_id is one conversation; a text given as an array of parts is its text parts, joined; a record
whose paths fit no mapping, or fit several, or that is no JSON, has null turns and `layout` null, so
that it can be counted; a JSON object too large for a VARIANT (128 MiB) is an
error, not null; an empty table has no rows.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import private

TURNS = "array<struct<role:string,text:string>>"
#: Shorter JSON always fits a VARIANT of 128 MiB: a value takes at most 4 times the bytes of its text.
LARGE = 1 << 24


def _text(record: Column, path: str) -> Column:
    """The text at a path: a string, or the text parts of an array; null where the path has none."""
    found = F.try_variant_get(record, path, "variant")
    parts = F.try_variant_get(record, path, "array<variant>")
    joined = F.array_join(F.transform(parts, lambda p: F.coalesce(F.try_variant_get(p, "$.text", "string"), F.when(~_is(p, "OBJECT"), F.try_variant_get(p, "$", "string")), F.lit(""))), "")
    return F.when(_is(found, "ARRAY"), joined).otherwise(F.try_variant_get(record, path, "string"))


def _is(value: Column, kind: str) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(value), F.lit(kind)), F.lit(False))


@dataclass(frozen=True)
class FieldTurns:
    """A turn for each (role, paths) with a value; several paths of a role are one text, one below another."""

    fields: tuple[tuple[str, tuple[str, ...]], ...]

    @property
    def paths(self) -> tuple[str, ...]:
        return tuple(p for _, paths in self.fields for p in paths)

    def turns(self, record: Column) -> Column:
        def turn(role: str, paths: tuple[str, ...]) -> Column:
            first, *more = (_text(record, f"$.{p}") for p in paths)
            text = first
            for x in more:
                text = F.when(F.coalesce(x, F.lit("")) == "", text).otherwise(F.concat_ws("\n\n", text, x))
            return F.when(text.isNotNull(), F.struct(F.lit(role).alias("role"), text.alias("text")))

        return F.array_compact(F.array(*(turn(*x) for x in self.fields))).cast(TURNS)


@dataclass(frozen=True)
class ArrayTurns:
    """A turn for each element of an array; role names are translated by `roles`."""

    array: str
    role: str
    text: str
    roles: dict[str, str] = field(default_factory=dict)
    system: str = ""

    @property
    def paths(self) -> tuple[str, ...]:
        return (self.array, f"{self.array}[*].{self.role}", f"{self.array}[*].{self.text}", *([self.system] if self.system else []))

    def turns(self, record: Column) -> Column:
        def turn(x: Column) -> Column:
            role = F.coalesce(F.try_variant_get(x, f"$.{self.role}", "string"), F.lit(""))
            named = role
            for old, new in self.roles.items():
                named = F.when(role == old, F.lit(new)).otherwise(named)
            return F.struct(named.alias("role"), F.coalesce(_text(x, f"$.{self.text}"), F.lit("")).alias("text"))

        made = F.transform(F.try_variant_get(record, f"$.{self.array}", "array<variant>"), turn).cast(TURNS)
        if not self.system:
            return made
        first = _text(record, f"$.{self.system}")
        return F.concat(F.when(first.isNotNull(), F.array(F.struct(F.lit("system").alias("role"), first.alias("text")))).otherwise(F.array()).cast(TURNS), made)


@dataclass(frozen=True)
class Layout:
    """A record layout: its name, its mapping, and the sets of paths that a record may have of all mapped ones."""

    name: str
    mapping: FieldTurns | ArrayTurns
    shapes: tuple[tuple[str, ...], ...]


def _shapes(needed: tuple[str, ...], *optional: str) -> tuple[tuple[str, ...], ...]:
    """The needed paths with every choice of the optional ones."""
    return tuple((*needed, *chosen) for n in range(len(optional) + 1) for chosen in combinations(optional, n))


def _array_shapes(array: str, role: str, text: str, *optional: str) -> tuple[tuple[str, ...], ...]:
    return (*_shapes((array, f"{array}[*].{role}", f"{array}[*].{text}"), *optional), *_shapes((array,), *optional))


def _pair(name: str, user: str, assistant: str, *more: str) -> Layout:
    """A layout of one exchange: a user field, further text of the user, and the assistant's field."""
    mapping = FieldTurns((("system", ("system",)), ("user", (user, *more)), ("assistant", (assistant,))))
    return Layout(name, mapping, _shapes((user, assistant), "system", *more))


LAYOUTS = (
    Layout("messages", ArrayTurns("messages", "role", "content", system="system"), _array_shapes("messages", "role", "content", "system")),
    Layout("sharegpt", ArrayTurns("conversations", "from", "value", {"human": "user", "gpt": "assistant"}, system="system"), _array_shapes("conversations", "from", "value", "system")),
    Layout("conversations", ArrayTurns("conversations", "role", "content", system="system"), _shapes(("conversations", "conversations[*].role", "conversations[*].content"), "system")),
    _pair("prompt", "prompt", "completion"),
    _pair("response", "prompt", "response"),
    _pair("instruction", "instruction", "output", "input"),
    _pair("instruction_response", "instruction", "response", "context"),
    _pair("question", "question", "answer"),
)


def mapped_paths(layouts: tuple[Layout, ...]) -> list[str]:
    return sorted({p for x in layouts for p in x.mapping.paths})


def fingerprint(record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """SHA-256 of the nested paths that the record has of those that the layouts read."""

    def there(path: str) -> Column:
        array, _, inner = path.partition("[*].")
        if not inner:
            return F.try_variant_get(record, f"$.{path}", "variant").isNotNull()
        return F.exists(F.try_variant_get(record, f"$.{array}", "array<variant>"), lambda x: F.try_variant_get(x, f"$.{inner}", "variant").isNotNull())

    paths = F.array(*(F.when(F.coalesce(there(p), F.lit(False)), F.lit(p)) for p in mapped_paths(layouts)))
    return F.when(_is(record, "OBJECT"), F.sha2(F.array_join(paths, "\n"), 256))


def known_fingerprints(layout: Layout) -> list[str]:
    return [hashlib.sha256("\n".join(sorted(s)).encode()).hexdigest() for s in layout.shapes]


def canonical(records: DataFrame, column: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Adds fingerprint, layout and turns to records that hold JSON text."""
    # A large record that is a JSON object and yet has no VARIANT would lose its turns.
    lost = (F.octet_length(column) >= LARGE) & F.json_object_keys(column).isNotNull()
    refused = F.raise_error(F.concat(F.lit("a record is too large for a VARIANT; bytes: "), F.octet_length(column).cast("string"))).cast("string")
    value = F.coalesce(F.try_parse_json(column), F.parse_json(F.when(lost, refused)))
    (held,) = private(records, "v")
    parsed = records.withColumn(held, value)
    parsed = parsed.withColumn("fingerprint", fingerprint(F.col(held), layouts))
    name = turns = None
    for layout in layouts:
        known = F.col("fingerprint").isin(*known_fingerprints(layout))
        made = layout.mapping.turns(F.col(held))
        name = F.when(known, layout.name) if name is None else name.when(known, layout.name)
        turns = F.when(known, made) if turns is None else turns.when(known, made)
    return parsed.withColumn("layout", name).withColumn("turns", turns).drop(held)


@dataclass(frozen=True)
class Template:
    """Control strings that mark turns, and those of other templates that texts must not smuggle in."""

    start: str = "<|im_start|>"
    text: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    foreign: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    trained_role: str = "assistant"

    def escape(self, text: Column) -> Column:
        """A backslash doubles backslashes and splits each control string after its first character."""
        marks = "|".join(["(?<=<)(?=\\|)", *(f"(?<={_quoted(x[0])})(?={_quoted(x[1:])})" for x in self.foreign)])
        return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), marks, "\\\\")

    @staticmethod
    def unescape(text: Column) -> Column:
        return F.regexp_replace(text, r"(?s)\\(.)", "$1")

    def formatted(self, turns: Column) -> Column:
        piece = F.transform(turns, lambda t: F.concat(F.lit(self.start), self.escape(t["role"]), F.lit(self.text), self.escape(t["text"]), F.lit(self.end)))
        return F.array_join(piece, "")

    def mask(self, turns: Column) -> Column:
        """Code point spans (start, end) of the trained role's texts in the formatted string."""
        marks = len(self.start) + len(self.text)
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

        def step(acc: Column, t: Column) -> Column:
            begin = acc["at"] + F.lit(marks) + F.char_length(self.escape(t["role"]))
            stop = begin + F.char_length(self.escape(t["text"]))
            own = F.array(F.struct(begin.alias("start"), stop.alias("end")))
            return F.struct((stop + len(self.end)).alias("at"), F.when(t["role"] == self.trained_role, F.concat(acc["spans"], own)).otherwise(acc["spans"]).alias("spans"))

        return F.aggregate(turns, zero, step)["spans"]

    def read(self, formatted: Column) -> Column:
        """The turns that a formatted string holds."""
        pieces = F.filter(F.split(formatted, _quoted(self.end)), lambda p: F.startswith(p, F.lit(self.start)))

        def turn(p: Column) -> Column:
            halves = F.split(F.substring(p, len(self.start) + 1, 2147483647), _quoted(self.text), 2)
            return F.struct(self.unescape(halves[0]).alias("role"), self.unescape(halves[1]).alias("text"))

        return F.transform(pieces, turn)

    def masked_text(self, formatted: Column, mask: Column) -> Column:
        """All text under the mask, unescaped."""
        return F.array_join(F.transform(mask, lambda s: self.unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")


def _quoted(x: str) -> str:
    return "".join("\\" + c if not c.isalnum() else c for c in x)


def records_of(conversations: DataFrame) -> DataFrame:
    """conv_id and record: each conversation as JSON, in the layout that its roles fit."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    roles = F.array_join(F.transform("t", lambda t: F.to_json(F.struct(t["role"].alias("r")))), "")
    shape = {k: "".join(json.dumps({"r": r}, separators=(",", ":")) for r in k) for k in (("user", "assistant"), ("system", "user", "assistant"))}
    text = lambda i: F.col("t")[i]["text"]
    plain = F.forall("t", lambda t: t["role"].isin("user", "assistant")) & (F.pmod("conv_id", F.lit(2)) == 0)
    gpt = F.transform("t", lambda t: F.struct(F.when(t["role"] == "user", "human").otherwise("gpt").alias("from"), t["text"].alias("value")))
    messages = F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))
    record = (
        F.when(roles == shape["user", "assistant"], F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("completion"))))
        .when(roles == shape["system", "user", "assistant"], F.to_json(F.struct(text(0).alias("system"), text(1).alias("instruction"), text(2).alias("output"))))
        .when(plain, F.to_json(F.struct(gpt.alias("conversations"))))
        .otherwise(F.to_json(F.struct(messages.alias("messages"))))
    )
    return grouped.select("conv_id", record.alias("record"))


def format_conversations(records: DataFrame, template: Template = Template()) -> DataFrame:  # noqa: B008
    """conv_id, layout, turns, formatted and loss_mask of records(conv_id, record)."""
    made = canonical(records)
    return made.select("conv_id", "fingerprint", "layout", "turns", template.formatted(F.col("turns")).alias("formatted"), template.mask(F.col("turns")).alias("loss_mask"))


def digests(formatted: DataFrame, template: Template = Template()) -> DataFrame:  # noqa: B008
    """What can be read back from formatted and loss_mask alone."""
    told = formatted.select("conv_id", "formatted", template.read(F.col("formatted")).alias("t"), template.masked_text(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    joined = F.array_join(F.transform("t", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return told.select(
        "conv_id",
        F.size("t").cast("long").alias("n_turns"),
        F.sha2(joined, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
