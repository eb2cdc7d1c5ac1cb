"""Chat formatting: records of many layouts, told apart by a hash of their field paths."""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import chunked

TURN_START, TURN_END = "<|im_start|>", "<|im_end|>\n"
# Control strings of common chat templates; none may stand in a formatted text.
CONTROL = (
    "<|im_start|>",
    "<|im_end|>",
    "<|endoftext|>",
    "<s>",
    "</s>",
    "[INST]",
    "[/INST]",
    "<<SYS>>",
    "<</SYS>>",
)
CONTROL_PATTERN = re.compile("|".join(map(re.escape, CONTROL)))
TURN_PATTERN = re.compile(r"<\|im_start\|>((?:[^\\\n]|\\.)*)\n(.*?)<\|im_end\|>\n", re.DOTALL)
# Role names of common layouts and what they are called here.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatgpt": "assistant"}


@dataclass(frozen=True)
class Each:
    """One turn for every entry of a list."""

    items: str
    role: str
    text: str

    def paths(self):
        return {f"{self.items}[].{self.role}", f"{self.items}[].{self.text}"}

    def turns(self, record):
        for entry in record.get(self.items) or ():
            role = plain((entry or {}).get(self.role))
            yield ROLES.get(role, role), plain((entry or {}).get(self.text))


@dataclass(frozen=True)
class One:
    """One turn of a given role, from one or more fields; empty ones are passed over."""

    role: str
    fields: tuple[str, ...]
    between: str = "\n\n"

    def paths(self):
        return set(self.fields)

    def turns(self, record):
        yield self.role, self.between.join(filter(None, (plain(record.get(f)) for f in self.fields)))


@dataclass(frozen=True)
class Layout:
    name: str
    rules: tuple = field(default_factory=tuple)

    def paths(self):
        return set().union(*(rule.paths() for rule in self.rules))

    def turns(self, record):
        return [turn for rule in self.rules for turn in rule.turns(record)]


USER, ANSWER = "user", "assistant"
LAYOUTS = (
    Layout("messages", (Each("messages", "role", "content"),)),
    Layout("conversations", (Each("conversations", "from", "value"),)),
    Layout("turns", (Each("turns", "role", "text"),)),
    Layout("system_conversations", (One("system", ("system",)), Each("conversations", "from", "value"))),
    Layout("instruction", (One(USER, ("instruction",)), One(ANSWER, ("output",)))),
    Layout("instruction_input", (One(USER, ("instruction", "input")), One(ANSWER, ("output",)))),
    Layout("instruction_response", (One(USER, ("instruction",)), One(ANSWER, ("response",)))),
    Layout("instruction_context", (One(USER, ("instruction", "context")), One(ANSWER, ("response",)))),
    Layout("prompt_completion", (One(USER, ("prompt",)), One(ANSWER, ("completion",)))),
    Layout("prompt_response", (One(USER, ("prompt",)), One(ANSWER, ("response",)))),
    Layout("question_answer", (One(USER, ("question",)), One(ANSWER, ("answer",)))),
    Layout("system_question", (One("system", ("system_prompt",)), One(USER, ("question",)), One(ANSWER, ("response",)))),
)


def plain(value) -> str:
    """A field as text; a missing one is empty, a nested one its JSON."""
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, sort_keys=True)


def field_paths(value, prefix: str = "") -> set[str]:
    """Paths of all leaves: a.b for fields, a[].b for the fields of list entries."""
    if isinstance(value, dict):
        return set().union(*(field_paths(v, f"{prefix}.{k}" if prefix else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union(*(field_paths(v, prefix + "[]") for v in value))
    return {prefix}


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


KNOWN_PATHS = frozenset().union(*(layout.paths() for layout in LAYOUTS))
BY_FINGERPRINT = {fingerprint(layout.paths()): layout for layout in LAYOUTS}


def layout_of(record) -> tuple[str, Layout | None]:
    """Fingerprint of a record's known field paths and the layout it names; other fields, such as
    ids or metadata, have no say."""
    mark = fingerprint(field_paths(record) & KNOWN_PATHS)
    return mark, BY_FINGERPRINT.get(mark)


def escaped(text: str) -> str:
    """A backslash doubles, and one is put behind the first character of each control string."""
    return CONTROL_PATTERN.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def formatted(turns) -> tuple[str, list[tuple[int, int]]]:
    """The turns as one text, and where in it the assistant's words stand: what a loss counts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = TURN_START + escaped(role).replace("\n", "\\\n") + "\n"
        body = escaped(text)
        if role == ANSWER:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, TURN_END]
        at += len(head) + len(body) + len(TURN_END)
    return "".join(parts), spans


def read_back(text: str) -> list[tuple[str, str]]:
    return [(unescaped(role), unescaped(body)) for role, body in TURN_PATTERN.findall(text)]


FORMATTED = "key string, fingerprint string, layout string, formatted string, loss array<struct<lo:int,hi:int>>"
READ = "key string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
SPANS = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))


def format_batch(batches):
    for batch in chunked(batches, "record"):
        rows = []
        for line in batch.column(1).to_pylist():
            try:
                record = json.loads(line or "{}")
            except ValueError:
                record = {}
            mark, layout = layout_of(record if isinstance(record, dict) else {})
            text, spans = formatted(layout.turns(record) if layout else [])
            rows.append((mark, layout.name if layout else None, text, [{"lo": a, "hi": b} for a, b in spans]))
        columns = list(zip(*rows))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.string()) for c in columns[:3]), pa.array(columns[3], SPANS)],
            ["key", "fingerprint", "layout", "formatted", "loss"],
        )


def read_batch(batches):
    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    for batch in chunked(batches, "formatted"):
        rows = []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            text = text or ""
            turns = read_back(text)
            learnt = "".join(unescaped(text[s["lo"] : s["hi"]]) for s in spans or ())
            whole = "".join(f"{role}\n{body}\n" for role, body in turns)
            rows.append((len(turns), digest(whole), len(learnt), digest(learnt), len(text)))
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))],
            ["key", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
        )


def format_records(records: DataFrame) -> DataFrame:
    """JSON records (key string, record string) as chat texts: key, fingerprint, layout, formatted, loss.

    The hash of a record's field paths picks one of ``LAYOUTS``; loss holds the places of the
    assistant's words as code points, end exclusive. Missing texts are empty. A record of no known layout,
    or that is missing or not a JSON object, has a missing layout and an empty text. Repeated records
    stay repeated, an empty table gives an empty result, further columns are left out.
    """
    return records.select(F.col("key").cast("string"), "record").mapInArrow(format_batch, FORMATTED)


def read_formatted(texts: DataFrame) -> DataFrame:
    """What a reader of the formatted texts finds: turns, the text under the loss mask, lengths."""
    return texts.select("key", "formatted", "loss").mapInArrow(read_batch, READ)


def conversation_records(rows: DataFrame) -> DataFrame:
    """Rows by turn (conv_id, turn, role, text) as one JSON record of messages for each conversation.

    Turns are ordered by turn, then role, then text, missing ones first; a missing role or text is
    empty; rows without conv_id form one conversation. A conversation is one record, so it has to
    fit a task.
    """
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("content"),
    )
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    messages = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    return turns.select(
        F.col("conv_id").cast("string").alias("key"), F.to_json(F.struct(messages.alias("messages"))).alias("record")
    )
