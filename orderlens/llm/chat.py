"""Chat formatting by schema fingerprints.

A record is one JSON object of any layout. Its nested field paths are hashed to
a fingerprint; a fingerprint selects a declarative ``Layout`` that says where
the turns are, and the layout turns the record into canonical turns. Turns are
then rendered with markers, and every character that could begin a control
string inside a text is escaped, so the rendering can be read back exactly.

Defined cases: a record that is null, is not valid JSON, is no object, is nested too
deeply to be read or has no known layout has no turns and a null ``layout`` (the first
four also a null fingerprint); a null role or text is empty; a turn whose text field is
absent is left out where the layout calls it optional (an empty instruction input). A
message that is no object is a turn with an empty role. Of a text that is a list, the
strings and the ``text`` of its items are joined; any other value is its JSON. A lone
surrogate becomes U+FFFD. Rows of ``records`` without a ``conv_id`` are one conversation,
repeated rows repeated turns; an empty table gives an empty table. Columns that carry the
name of a result (``chat``, ``formatted``, ``loss_spans``) are replaced, all others kept.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template: markers, and escapes in the order they are applied.
TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("[", "&#91;"), ("]", "&#93;"))

TURNS = "array<struct<role:string,text:string>>"
CANONICAL = f"fingerprint string, layout string, turns {TURNS}"


def plain_text(value) -> str:
    """The text of any JSON value."""
    if value is None:
        return ""
    if isinstance(value, list):
        return "".join(plain_text(v["text"] if isinstance(v, dict) and "text" in v else v) for v in value)
    if not isinstance(value, str):
        value = json.dumps(value, ensure_ascii=False)
    try:
        value.encode()
    except UnicodeEncodeError:
        value = value.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    return value


def parse(raw: str | None) -> tuple[dict, set[str]] | None:
    """A record and its field paths; none if it is null, not valid, too deep or no object."""
    try:
        record = json.loads(raw) if raw is not None else None
        return (record, field_paths(record)) if isinstance(record, dict) else None
    except (ValueError, RecursionError):
        return None


@dataclass(frozen=True)
class Layout:
    """Where a record keeps its turns.

    ``each`` names an array of messages with ``role`` and ``text`` fields;
    ``single`` lists (role, fields) pairs, whose fields are joined by an empty line.
    Role names are translated by ``roles``; other names stay as they are.
    """

    name: str
    each: str = ""
    role: str = ""
    text: str = ""
    single: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict[str, str] = field(default_factory=dict)
    optional: tuple[str, ...] = ()

    def paths(self) -> frozenset[str]:
        if self.each:
            return frozenset({f"{self.each}[].{self.role}", f"{self.each}[].{self.text}"})
        return frozenset(f for _, fields in self.single for f in fields if f not in self.optional)

    def turns(self, record: dict) -> list[dict]:
        if self.each:
            return [self._message(m) for m in record.get(self.each) or ()]
        found = []
        for role, fields in self.single:
            values = [record.get(f) for f in fields
                      if f not in self.optional or record.get(f)]
            if values:
                found.append({"role": role, "text": "\n\n".join(map(plain_text, values))})
        return found

    def _message(self, message) -> dict:
        if not isinstance(message, dict):
            return {"role": "", "text": plain_text(message)}
        role = plain_text(message.get(self.role))
        return {"role": self.roles.get(role, role), "text": plain_text(message.get(self.text))}


# The layouts in common use, the most specific first.
LAYOUTS = (
    Layout("messages", each="messages", role="role", text="content"),
    Layout("turns", each="turns", role="role", text="text"),
    Layout("conversations", each="conversations", role="from", text="value",
           roles={"human": "user", "gpt": "assistant"}),
    Layout("instruction", single=(("system", ("system",)), ("user", ("instruction", "input")),
                                  ("assistant", ("output",))), optional=("system", "input")),
    Layout("prompt-completion", single=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt-response", single=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("question-answer", single=(("user", ("question",)), ("assistant", ("answer",)))),
)


def field_paths(value, path: str = "") -> set[str]:
    """Nested field paths of a parsed record; ``[]`` stands for the items of an array."""
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in field_paths(v, f"{path}.{k}" if path else k)}
    if isinstance(value, list):
        return {p for v in value for p in field_paths(v, f"{path}[]")} or {f"{path}[]"}
    return {path}


def fingerprint(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode("utf-8", "surrogatepass")).hexdigest()[:16]


def canonical(
    records: DataFrame, column: str = "record", layouts: tuple[Layout, ...] = LAYOUTS
) -> DataFrame:
    """``records`` plus a struct ``chat`` (fingerprint, layout, turns) read from JSON in ``column``.

    The layout is looked up by fingerprint; only the first record of each
    fingerprint is compared with the layouts' own paths.
    """

    @F.pandas_udf(CANONICAL)
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known: dict[str, Layout | None] = {}
        for batch in batches:
            rows = []
            for raw in batch:
                parsed = parse(raw)
                if parsed is None:
                    rows.append((None, None, []))
                    continue
                record, paths = parsed
                key = fingerprint(paths)
                if key not in known:
                    known[key] = next((x for x in layouts if x.paths() <= paths), None)
                layout = known[key]
                rows.append((key, layout.name if layout else None,
                             layout.turns(record) if layout else []))
            yield pd.DataFrame(rows, columns=["fingerprint", "layout", "turns"])

    return records.withColumn("chat", read(F.col(column)))


def escape(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def render(chats: DataFrame, turns: str = "chat.turns") -> DataFrame:
    """Adds ``formatted`` and ``loss_spans``: (start, length) in code points of each assistant text."""
    parts = F.transform(F.col(turns), lambda t: F.struct(
        F.concat(F.lit(TURN), escape(t["role"]), F.lit(BODY)).alias("head"),
        escape(t["text"]).alias("body"), (t["role"] == "assistant").alias("loss")))
    empty = F.lit(None).cast("array<struct<start:bigint,length:bigint>>")
    start = F.struct(F.lit(0).cast("long").alias("at"),
                     F.coalesce(empty, F.array().cast("array<struct<start:bigint,length:bigint>>"))
                     .alias("spans"))

    def step(state: Column, part: Column) -> Column:
        begin = state["at"] + F.char_length(part["head"])
        size = F.char_length(part["body"])
        span = F.array(F.struct(begin.cast("long").alias("start"), size.cast("long").alias("length")))
        return F.struct((begin + size + len(END)).cast("long").alias("at"),
                        F.when(part["loss"], F.concat(state["spans"], span))
                        .otherwise(state["spans"]).alias("spans"))

    own = "_parts"
    while own in map(str.lower, chats.columns):
        own = f"_{own}"
    text = F.concat_ws("", F.transform(own, lambda p: F.concat(p["head"], p["body"], F.lit(END))))
    return (chats.withColumn(own, parts)
            .withColumn("formatted", text)
            .withColumn("loss_spans", F.aggregate(own, start, step, lambda s: s["spans"]))
            .drop(own))


def read_back(formatted: Column) -> Column:
    """The turns of a rendered chat, unescaped."""
    blocks = F.split(formatted, r"<\|turn\|>")
    return F.transform(F.slice(blocks, 2, F.greatest(F.size(blocks) - 1, F.lit(0))), lambda b: F.struct(
        unescape(F.substring_index(b, BODY, 1)).alias("role"),
        unescape(F.substring_index(F.substring_index(b, BODY, -1), END, 1)).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.concat_ws("", F.transform(spans, lambda s: unescape(
        F.substr(formatted, s["start"].cast("int") + 1, s["length"].cast("int")))))


def records(rows: DataFrame) -> DataFrame:
    """One JSON record (``turns`` layout) per ``conv_id`` from rows by turn; ties by role and text."""
    message = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"),
                       F.coalesce("text", F.lit("")).alias("text"))
    return (rows.groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(message)).alias("m"))
            .select("conv_id", F.to_json(F.struct(F.transform(
                "m", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
                .alias("turns"))).alias("record")))
