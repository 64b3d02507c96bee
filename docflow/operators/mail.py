"""Mail queue: validation, recipients, templates, delivery states."""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.extract import expire_at
from docflow.operators.enrich import Batch

DIRECT = ("to", "cc", "bcc")
BY_UID = ("toUids", "ccUids", "bccUids")
PARTS = ("subject", "html", "text", "amp")
ATTACHMENT_KEYS = ("filename", "content", "path", "contentType", "cid", "encoding", "raw", "href", "httpHeaders", "contentDisposition")
LEASE = "INTERVAL 60 SECONDS"
LEASE_ERROR = "Message processing lease expired."


def _has(df: DataFrame, name: str) -> bool:
    return name in df.columns


def validation_errors(df: DataFrame) -> Column:
    """What is wrong with each queue document, as an array of messages; empty if nothing is."""

    def filled(c: str) -> Column:
        return F.coalesce(F.size(c) > 0, F.lit(False))

    some = F.lit(False)
    for c in (*DIRECT, *BY_UID):
        if _has(df, c):
            some = some | filled(c)
    none = F.lit(None)
    message = F.col("message") if _has(df, "message") else none
    template = F.col("template") if _has(df, "template") else none
    grid = F.col("sendGrid") if _has(df, "sendGrid") else none
    checks = [
        F.when(~some, "no recipient"),
        F.when(message.isNull() & template.isNull() & grid.isNull(), "no message, template or sendGrid"),
    ]
    if _has(df, "template"):
        checks.append(F.when(template.isNotNull() & (F.coalesce(template["name"], F.lit("")) == ""), "template without name"))
    if _has(df, "message"):
        names = df.schema["message"].dataType.names
        part = lambda n: F.coalesce(message[n], F.lit("")) if n in names else F.lit("")
        plain = message.isNotNull() & template.isNull()
        checks.append(F.when(plain & (message["subject"].isNull() if "subject" in names else F.lit(True)), "message without subject"))
        checks.append(F.when(plain & (part("text") == "") & (part("html") == ""), "message without text or html"))
    if _has(df, "sendGrid"):
        checks.append(F.when(grid["dynamicTemplateData"].isNotNull() & (F.coalesce(grid["templateId"], F.lit("")) == ""), "dynamic data without templateId"))
    for c in BY_UID:
        if _has(df, c):
            checks.append(F.when(F.exists(c, lambda x: F.coalesce(x, F.lit("")) == ""), f"empty uid in {c}"))
    return F.array_compact(F.array(*checks))


def validate_mail(df: DataFrame) -> DataFrame:
    return df.withColumn("errors", validation_errors(df))


def normalize_recipients(value: Column) -> Column:
    """A VARIANT string or array of strings as an array; NULL if a member is of another kind."""
    kind = F.schema_of_variant(value)
    items = F.try_variant_get(value, "$", "array<variant>")
    strings = F.forall(items, lambda x: F.schema_of_variant(x) == "STRING")
    none = F.array().cast("array<string>")
    return (
        F.when(value.isNull() | (kind == "VOID"), none)
        .when(kind == "STRING", F.array(F.try_variant_get(value, "$", "string")))
        .when(kind.startswith("ARRAY") & F.coalesce(strings, F.lit(False)), F.transform(items, lambda x: F.try_variant_get(x, "$", "string")))
    )


def accepted_recipients(df: DataFrame) -> Column:
    """All recipients, lower-cased, each once."""
    none = F.array().cast("array<string>")
    lists = [F.coalesce(c, none) for c in DIRECT if c in df.columns]
    return F.array_distinct(F.transform(F.concat(*lists), lambda x: F.lower(x)))


def _uid_rows(mail: DataFrame) -> DataFrame:
    lists = [F.struct(F.lit(k).alias("kind"), F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda u, i: F.struct(i.alias("pos"), u.alias("uid"))).alias("uids")) for k, c in zip(DIRECT, BY_UID, strict=True) if c in mail.columns]
    return mail.select("mail_id", F.explode(F.array(*lists)).alias("l")).select("mail_id", "l.kind", F.inline("l.uids"))


def resolve_recipients(mail: DataFrame, users: DataFrame) -> DataFrame:
    """mail with to, cc, bcc extended by the emails of their uid lists, in order; missing ones are left out.

    Spark chooses how to join users, as they may be many; only uid and email are read of them.
    """
    emails = users.select("uid", "email").where(F.col("email") != "")
    found = _uid_rows(mail).join(emails, "uid").groupBy("mail_id", "kind").agg(F.array_sort(F.collect_list(F.struct("pos", "email"))).alias("r"))
    wide = found.groupBy("mail_id").agg(*(F.first(F.when(F.col("kind") == k, F.transform("r", lambda x: x["email"])), ignorenulls=True).alias(f"_{k}") for k in DIRECT))
    none = F.array().cast("array<string>")
    joined = mail.join(wide, "mail_id", "left")
    for k in DIRECT:
        direct = F.coalesce(k, none) if k in mail.columns else none
        joined = joined.withColumn(k, F.concat(direct, F.coalesce(f"_{k}", none)))
    return joined.drop(*(f"_{k}" for k in DIRECT), *BY_UID)


def missing_uids(mail: DataFrame, users: DataFrame) -> DataFrame:
    """mail_id, uid of listed uids without a user, or whose user has no email."""
    good = users.where(F.col("email") != "").select("uid")
    return _uid_rows(mail).select("mail_id", "uid").distinct().join(good, "uid", "left_anti").select("mail_id", "uid")


def apply_templates(mail: DataFrame, templates: DataFrame) -> DataFrame:
    """mail with the columns t_subject, t_html, t_text of its template and template_error where there is none.

    Spark broadcasts templates by their size if they are few.
    """
    known = templates.where(~F.coalesce("partial", F.lit(False))).select(F.col("name").alias("_t"), *(F.col(p).alias(f"t_{p}") for p in PARTS if p in templates.columns))
    joined = mail.join(known, F.col("template")["name"] == F.col("_t"), "left")
    unknown = F.col("template").isNotNull() & F.col("_t").isNull()
    return joined.withColumn("template_error", F.when(unknown, F.concat(F.lit("unknown template "), F.col("template")["name"]))).drop("_t")


_TAG = re.compile(r"\{\{\{\s*([\w.]+)\s*\}\}\}|\{\{>\s*([\w-]+)\s*\}\}|\{\{\s*([\w.]+)\s*\}\}")


def render_text(template: str | None, data: dict, partials: dict[str, str], escape: bool, within: tuple[str, ...] = ()) -> str | None:
    """Variables and partials of a template; missing variables are empty, {{{x}}} is never escaped.

    Partials nest to any depth; one that takes in itself is an error.
    """
    if template is None:
        return template

    def one(m: re.Match) -> str:
        if m[2]:
            if m[2] in within:
                raise ValueError(f"partial {m[2]} takes in itself")
            return render_text(partials.get(m[2]) or "", data, partials, escape, (*within, m[2])) or ""
        value = data
        for key in (m[1] or m[3]).split("."):
            value = value.get(key) if isinstance(value, dict) else None
        if value is None:
            return ""
        shown = {True: "true", False: "false"}.get(value) if isinstance(value, bool) else str(value)
        return html.escape(shown) if escape and m[3] else shown

    return _TAG.sub(one, template)


def render_rows(df: DataFrame, templates: DataFrame) -> DataFrame:
    """apply_templates' rows with r_ columns, the rendered parts; html and amp are escaped, subject and text are not.

    Rows pass through as they are, so that nothing is joined back. Partials are a dimension: more than
    `PARTIALS` of them is an error.
    """
    rows = templates.where(F.coalesce("partial", F.lit(False))).limit(PARTIALS + 1).collect()
    if len(rows) > PARTIALS:
        raise ValueError(f"more than {PARTIALS} partials")
    partials = {p: {r["name"]: r[p] for r in rows if p in r.asDict()} for p in PARTS}
    parts = [p for p in PARTS if f"t_{p}" in df.columns]
    wanted = F.struct(F.to_json(F.when(F.col("template").isNotNull() & F.col("template_error").isNull(), F.col("template")["data"])).alias("d"), *(f"t_{p}" for p in parts))

    @F.pandas_udf(", ".join(f"r_{p} string" for p in parts))
    def run(batch: pd.DataFrame) -> pd.DataFrame:
        data = [json.loads(d) if d else {} for d in batch["d"]]
        return pd.DataFrame({f"r_{p}": [render_text(t, d, partials[p], p in ("html", "amp")) for t, d in zip(batch[f"t_{p}"], data, strict=True)] for p in parts})

    return df.withColumn("_r", run(wanted)).select(*df.columns, "_r.*")


def render_template(df: DataFrame, templates: DataFrame) -> DataFrame:
    """mail_id and rendered parts of those of apply_templates' rows that have a template."""
    made = render_rows(df.where(F.col("template").isNotNull()), templates)
    return made.select("mail_id", *(c for c in made.columns if c.startswith("r_")))


#: Most partials that rendering takes along.
PARTIALS = 10_000


def merge_message(message: Column, rendered: dict[str, Column]) -> Column:
    """The message with rendered parts in place of its own; a NULL part keeps it, an empty one does not."""
    return F.struct(*(F.coalesce(r, message[p]).alias(p) for p, r in rendered.items()))


def clean_attachments(attachments: Column) -> Column:
    """Attachments (maps) with known keys that have a value; empty ones are dropped."""
    kept = F.transform(attachments, lambda a: F.map_filter(a, lambda k, v: k.isin(*ATTACHMENT_KEYS) & v.isNotNull()))
    return F.filter(kept, lambda a: F.size(a) > 0)


def prepare_mail(mail: DataFrame, templates: DataFrame, users: DataFrame) -> DataFrame:
    """mail_id, to, cc, bcc, message, errors: validated, templates merged, recipients resolved.

    Mail of an unknown template, or without any recipient after resolution, has an error. mail_id names one document.
    """
    checked = apply_templates(validate_mail(mail), templates)
    rendered = render_rows(checked, templates)
    joined = resolve_recipients(rendered, users)
    own = mail.schema["message"].dataType.names
    parts = {p: F.col(f"r_{p}") for p in PARTS if f"r_{p}" in rendered.columns and p in own}
    nobody = (F.size("to") == 0) & (F.size("cc") == 0) & (F.size("bcc") == 0)
    more = F.array_compact(F.array("template_error", F.when(nobody, "no recipient after resolution")))
    return joined.select("mail_id", *DIRECT, merge_message(F.col("message"), parts).alias("message"), F.array_distinct(F.concat("errors", more)).alias("errors"))


#: What the states' transitions set; a delivery that lacks one of these fields gets it.
DELIVERY = {"startTime": "timestamp", "endTime": "timestamp", "state": "string", "attempts": "int", "leaseExpireTime": "timestamp", "error": "string", "expireAt": "timestamp"}


def delivery_of(df: DataFrame) -> Column:
    """The delivery with all fields of its own and of DELIVERY, so that a change of one keeps the rest."""
    kind = df.schema["delivery"].dataType.names
    d = F.col("delivery")
    own = [F.col("delivery")[n].cast(DELIVERY[n]).alias(n) if n in DELIVERY else F.col("delivery")[n].alias(n) for n in kind]
    return F.when(d.isNotNull(), F.struct(*own, *(F.lit(None).cast(t).alias(n) for n, t in DELIVERY.items() if n not in kind)))


def sendable(df: DataFrame) -> Column:
    """Whether there is anything to send: a message, a template or sendGrid."""
    held = F.lit(False)
    for c in ("message", "template", "sendGrid"):
        if _has(df, c):
            held = held | F.col(c).isNotNull()
    return held


def mail_transition(df: DataFrame, now: Column, ttl: tuple[str, int] | None = None) -> DataFrame:
    """Adds next (the delivery that follows, NULL if nothing changes) and attempt (whether to send now).

    A new document starts as PENDING if it has anything to send, with an expiry if there is a ttl. PENDING
    and RETRY are taken up with a lease; a lease that ran out is an ERROR. All other fields stay.
    """
    d = delivery_of(df)
    state = F.col("delivery")["state"]
    names = [f.name for f in df.select(d.alias("d")).schema["d"].dataType.fields]
    kinds = {f.name: f.dataType for f in df.select(d.alias("d")).schema["d"].dataType.fields}
    expire = expire_at(now, *ttl) if ttl else F.lit(None).cast("timestamp")
    begun = {"startTime": now.cast("timestamp"), "state": F.lit("PENDING"), "attempts": F.lit(0), "expireAt": expire}
    start = F.struct(*(begun.get(n, F.lit(None)).cast(kinds[n]).alias(n) for n in names))
    run = d.withField("state", F.lit("PROCESSING")).withField("leaseExpireTime", (now + F.expr(LEASE)).cast("timestamp"))
    lost = d.withField("state", F.lit("ERROR")).withField("error", F.lit(LEASE_ERROR))
    fresh = F.col("delivery").isNull() & sendable(df)
    after = F.when(fresh, start).when(state.isin("PENDING", "RETRY"), run).when((state == "PROCESSING") & (F.col("delivery")["leaseExpireTime"] < now), lost)
    return df.withColumn("next", after).withColumn("attempt", F.coalesce(state.isin("PENDING", "RETRY"), F.lit(False)))


def deliver(df: DataFrame, fn: Batch, now: Column | None = None) -> DataFrame:
    """mail_id, delivery after sending the mail that is PROCESSING; mail in other states is not sent.

    fn gets a batch with mail_id, message (JSON), to, cc and bcc, and returns what the transport says of
    each. If a batch fails, its mail is sent one by one, and those that fail again have the error; mail
    without a recipient is an error without being sent. SUCCESS or ERROR, one attempt more, no lease, and
    the time; all other fields stay.
    """
    schema = f"mail_id {df.schema['mail_id'].dataType.simpleString()}, state string, info string, error string"

    def one_by_one(batch: pd.DataFrame) -> Iterator[tuple[str, str | None, str | None]]:
        for i in range(len(batch)):
            try:
                yield "SUCCESS", str(list(fn(batch.iloc[i : i + 1]))[0]), None
            except Exception as e:  # noqa: BLE001  the sender may raise anything; it becomes the mail's error
                yield "ERROR", None, str(e)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            nobody = batch["n"] == 0
            for part, rows in ((batch[nobody], [("ERROR", None, NOBODY)] * int(nobody.sum())), (batch[~nobody].drop(columns="n"), None)):
                if not len(part):
                    continue
                if rows is None:
                    try:
                        rows = [("SUCCESS", str(x), None) for x in fn(part)]
                    except Exception:  # noqa: BLE001  told apart row by row
                        rows = list(one_by_one(part))
                yield pd.DataFrame({"mail_id": part["mail_id"].to_numpy(), "state": [r[0] for r in rows], "info": [r[1] for r in rows], "error": [r[2] for r in rows]})

    none = F.array().cast("array<string>")
    lists = [(F.coalesce(c, none) if _has(df, c) else none).alias(c) for c in DIRECT]
    due = df.where(F.col("delivery")["state"] == "PROCESSING")
    source = due.select("mail_id", F.to_json("message").alias("message"), *lists).withColumn("n", F.size("to") + F.size("cc") + F.size("bcc"))
    sent = source.mapInPandas(run, schema).withColumnsRenamed({"state": "s_state", "info": "s_info", "error": "s_error"})
    held = delivery_of(df)
    made = held.withField("state", F.col("s_state")).withField("info", F.col("s_info")).withField("error", F.col("s_error"))
    made = made.withField("attempts", F.coalesce(F.col("delivery")["attempts"], F.lit(0)).cast("int") + 1).withField("leaseExpireTime", F.lit(None).cast("timestamp"))
    made = made.withField("endTime", now if now is not None else F.current_timestamp())
    return due.select("mail_id", "delivery").join(sent, "mail_id").select("mail_id", made.alias("delivery"))


NOBODY = "Failed to deliver email. Expected at least 1 recipient."


def expired_mail(df: DataFrame, now: Column) -> DataFrame:
    return df.where(F.col("delivery")["expireAt"] < now)
