"""Chat formatting: layouts recognised by a fingerprint of their field paths, mapped to turns, rendered with a mask.

Layouts. A record's layout is the sorted list of its nested field paths, arrays
written as []. Its SHA-256 is the fingerprint, which selects a mapping: a small
declaration of where roles and texts are. Data frames are recognised by their
schema (`to_turns`), JSON texts record by record (`json_to_turns`), so that one
file may hold many layouts. A record of unknown layout is an error for a frame
and a row of its own, with its fingerprint and no turns, for JSON.

Template. `<|im_start|>` role `<|im_sep|>` text `<|im_end|>` newline. Where a role or
text holds a control string, a backslash is put after its first character, and
backslashes are doubled; dropping each escaping backslash gives the text back.
A turn is rendered by itself, so a conversation of any length is never gathered:
its text is its turns' renderings in order. The loss mask is the span of each
assistant text within its rendering.

Cases. Null texts and roles are empty. Turns sort by number, then role, then text;
null numbers come first. Repeated turns are all rendered. A null conversation id is an
id like others. Other columns are not used. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import json
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import partitions, small_batches

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Control strings of this and of common templates (fixed values).
CONTROL = (START, SEP, END, "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")


class Mapping(NamedTuple):
    """Where turns are: one row a turn (`flat`), fields that are turns (`fields`), or a list of turns (`items`)."""

    kind: str
    #: flat and items: names of role and text. fields: role by field, in order; "a+b" joins two fields by a blank line.
    role: str = ""
    text: str = ""
    items: str = ""
    fields: tuple[tuple[str, str], ...] = ()
    number: str = ""


#: Role names of layouts that list turns (fixed values); flat rows keep theirs.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}

#: Field paths and mapping of known layouts.
LAYOUTS: tuple[tuple[tuple[str, ...], Mapping], ...] = (
    (("conv_id", "role", "text", "turn"), Mapping("flat", role="role", text="text", number="turn")),
    (("conv_id", "completion", "prompt"), Mapping("fields", fields=(("user", "prompt"), ("assistant", "completion")))),
    (("conv_id", "prompt", "response"), Mapping("fields", fields=(("user", "prompt"), ("assistant", "response")))),
    (("conv_id", "input", "instruction", "output"), Mapping("fields", fields=(("user", "instruction+input"), ("assistant", "output")))),
    (("conv_id", "instruction", "output"), Mapping("fields", fields=(("user", "instruction"), ("assistant", "output")))),
    (("conv_id", "messages[].content", "messages[].role"), Mapping("items", items="messages", role="role", text="content")),
    (("conv_id", "conversations[].from", "conversations[].value"), Mapping("items", items="conversations", role="from", text="value")),
)


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


def schema_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Paths of all leaves of a schema."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, f"{at}[]")
    return [at]


def value_paths(value, at: str = "") -> list[str]:
    """Paths of all leaves of a parsed JSON value."""
    if isinstance(value, dict):
        return [p for k, v in value.items() for p in value_paths(v, f"{at}.{k}" if at else k)]
    if isinstance(value, list):
        return [p for v in value for p in value_paths(v, f"{at}[]")]
    return [at]


REGISTRY: dict[str, Mapping] = {fingerprint(paths): mapping for paths, mapping in LAYOUTS}


def _role(role: Column) -> Column:
    role = F.coalesce(role.cast("string"), F.lit(""))
    return reduce(lambda e, kv: e.when(role == kv[0], kv[1]), ROLES.items(), F.when(F.lit(False), "")).otherwise(role)


def to_turns(df: DataFrame, conv_id: str = "conv_id", registry: dict[str, Mapping] | None = None) -> DataFrame:
    """(conv_id, turn, role, text) of a frame whose layout is known; further columns have to be dropped first."""
    registry = REGISTRY if registry is None else registry
    mark = fingerprint(schema_paths(df.schema))
    if mark not in registry:
        raise ValueError(f"no mapping for layout {mark}: {sorted(schema_paths(df.schema))}")
    m = registry[mark]
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    if m.kind == "flat":
        return df.select(F.col(conv_id), F.col(m.number).cast("long").alias("turn"), text(F.col(m.role)).alias("role"), text(F.col(m.text)).alias("text"))
    if m.kind == "items":
        turns = F.transform(m.items, lambda x, i: F.struct(i.cast("long").alias("turn"), _role(x[m.role]).alias("role"), text(x[m.text]).alias("text")))
    else:
        joined = lambda names: F.concat_ws("\n\n", *[F.when(F.col(n) != "", F.col(n)) for n in names.split("+")]) if "+" in names else F.col(names)
        turns = F.array(*[F.struct(F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), text(joined(f)).alias("text")) for i, (r, f) in enumerate(m.fields)])
    return df.select(F.col(conv_id), F.explode(turns).alias("t")).select(conv_id, "t.turn", "t.role", "t.text")


def _turns_of(value: dict, m: Mapping) -> list[tuple[str, str]]:
    if m.kind == "flat":
        return [(value.get(m.role), value.get(m.text))]
    if m.kind == "items":
        return [(x.get(m.role), x.get(m.text)) for x in value[m.items]]
    return [(r, "\n\n".join(v for n in f.split("+") if (v := value.get(n)))) for r, f in m.fields]


def json_to_turns(df: DataFrame, record: str = "record", registry: dict[str, Mapping] | None = None) -> DataFrame:
    """(fingerprint, conv_id, turn, role, text) of JSON records of any mix of layouts; unknown ones keep a row without a turn."""
    small_batches(df.sparkSession)
    known = REGISTRY if registry is None else registry

    def run(batches):
        for batch in batches:
            rows = []
            for raw in batch.column("record"):
                try:
                    value = json.loads(raw.as_py() or "null")
                except ValueError:
                    value = None
                mark = fingerprint(value_paths(value))
                conv = value.get("conv_id") if isinstance(value, dict) else None
                m = known.get(mark)
                if m is None:
                    rows.append((mark, conv, None, None, raw.as_py()))
                    continue
                for i, (role, text) in enumerate(_turns_of(value, m)):
                    at = value.get(m.number) if m.number else i
                    role = role if m.kind == "flat" else ROLES.get(role, role)
                    rows.append((mark, conv, at, role or "", "" if text is None else str(text)))
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            names = ["fingerprint", "conv_id", "turn", "role", "text"]
            yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return df.select(F.col(record).cast("string").alias("record")).mapInArrow(run, "fingerprint string, conv_id long, turn long, role string, text string")


def _quoted(text: str) -> str:
    return "".join("\\" + c if c in "|[]()<>/.*+?" else c for c in text)


def escape(text: Column) -> Column:
    """Backslashes doubled, one put after the first character of each control string."""
    within = "|".join(f"(?<={_quoted(c[0])})(?={_quoted(c[1:])})" for c in CONTROL)
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), within, r"\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_turns(turns: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """`turns` plus formatted, and the loss mask within it: loss_start (from 0) and loss_length, in characters."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    named, said = escape(role), escape(text)
    learnt = role.isin(*trained)
    return turns.withColumn("formatted", F.concat(F.lit(START), named, F.lit(SEP), said, F.lit(END + "\n"))).withColumns(
        {
            "loss_start": F.when(learnt, F.length(named) + len(START) + len(SEP)),
            "loss_length": F.when(learnt, F.length(said)),
        }
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Role, text and loss text of renderings, from the renderings and the mask alone."""
    body = F.substring(F.col("formatted"), F.lit(len(START) + 1), F.length("formatted") - len(START) - len(END) - 1)
    at = F.instr(F.col("formatted"), SEP) - len(START)
    return formatted.withColumns(
        {
            "role": unescape(F.substring(body, F.lit(1), at - 1)),
            "text": unescape(F.substring(body, at + len(SEP), F.length(body))),
            "loss_text": F.when(
                F.col("loss_start").isNotNull(), unescape(F.substring(F.col("formatted"), F.col("loss_start") + 1, F.col("loss_length")))
            ),
        }
    )


def digest_conversations(turns: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """Per conversation: counts and digests of its turns, streamed in order; a worker holds one turn and two hash states.

    A digest over a whole conversation has to see it in order, so one conversation is
    one task's stream; it is sorted by Spark, which spills, and not gathered.
    """
    small_batches(turns.sparkSession)
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches):
        at, state = None, None

        def row(state):
            n, turn_hash, chars, loss_hash, size = state
            return (at, n, turn_hash.hexdigest(), chars, loss_hash.hexdigest(), size)

        def out(rows):
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = [c.split()[0] for c in schema.split(", ")]
            return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

        for batch in batches:
            rows = []
            for t in batch.to_pylist():
                if state is None or t["conv_id"] != at:
                    if state is not None:
                        rows.append(row(state))
                    at, state = t["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{t['role']}\n{t['text']}\n".encode())
                if t["loss_text"] is not None:
                    state[2] += len(t["loss_text"])
                    state[3].update(t["loss_text"].encode())
                state[4] += t["chars"]
            if rows:
                yield out(rows)
        if state is not None:
            yield out([row(state)])

    columns = turns.select(F.col(conv_id).cast("long").alias("conv_id"), "turn", "role", "text", "loss_text", F.length("formatted").alias("chars"))
    dealt = columns.repartition(partitions(turns.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(run, schema)
