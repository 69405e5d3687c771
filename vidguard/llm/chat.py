"""Chat formatting by schema fingerprints.

A record's layout is the hash of its sorted nested field paths. Each known fingerprint selects a
declarative mapping: where the turns are and how their fields and role names read. Canonical turns
are rendered with a template whose marks cannot occur in a text: control strings in texts get a
backslash after their first character (and backslashes are doubled), which ``unescape`` undoes.
"""

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tables

# Marks of the template, and strings that other chat formats read as control (fixed values).
OPEN, MID, END = "<|turn:", "|>", "<|end|>"
_CONTROL = re.compile(
    r"<(?=\||/?s>|</?SYS>>|/?(?:start|end)_of_turn>)|\|(?=>)"
    r"|\[(?=/?(?:INST|SYS|AVAILABLE_TOOLS|TOOL_CALLS)\])")
_ESCAPED = re.compile(r"\\(\\?)")
DIGESTS = ("conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant",
         "model": "assistant", "ai": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns.

    ``turns``: path of an array of messages with ``role`` and ``text`` field names; or ``fixed``:
    (role, path) pairs for single fields, empty ones left out where ``optional``.
    """

    name: str
    turns: str | None = None
    role: str = "role"
    text: str = "content"
    fixed: tuple[tuple[str, str], ...] = ()
    optional: frozenset[str] = field(default_factory=frozenset)


MAPPINGS: dict[tuple[str, ...], Mapping] = {
    ("messages[].content", "messages[].role"): Mapping("messages", "messages"),
    ("turns[].role", "turns[].text", "turns[].turn"): Mapping("rows", "turns", text="text"),
    ("conversations[].from", "conversations[].value"):
        Mapping("from_value", "conversations", "from", "value"),
    ("prompt", "response"): Mapping(
        "prompt_response", fixed=(("user", "prompt"), ("assistant", "response"))),
    ("prompt", "completion"): Mapping(
        "prompt_completion", fixed=(("user", "prompt"), ("assistant", "completion"))),
    ("input", "instruction", "output"): Mapping(
        "instruction_input", fixed=(("user", "instruction"), ("user", "input"),
                                    ("assistant", "output")), optional=frozenset({"input"})),
    ("instruction", "output"): Mapping(
        "instruction", fixed=(("user", "instruction"), ("assistant", "output"))),
    ("question", "answer"): Mapping(
        "question_answer", fixed=(("user", "question"), ("assistant", "answer"))),
}


def field_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Leaf paths of a type; ``[]`` marks an array. Metadata columns are not part of a layout."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields
                for p in field_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, at + "[]")
    return [at]


def fingerprint(paths: list[str] | tuple[str, ...]) -> int:
    """Hash of the sorted field paths of a layout."""
    return xxhash.xxh3_64_intdigest("\n".join(sorted(paths)))


BY_FINGERPRINT = {fingerprint(paths): m for paths, m in MAPPINGS.items()}


def escape(text: str) -> str:
    return _CONTROL.sub(r"\g<0>\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _role(name: Column) -> Column:
    lower = F.lower(F.coalesce(name, F.lit("")))
    known = F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])
    return F.coalesce(known[lower], F.coalesce(name, F.lit("")))


def canonical_turns(records: DataFrame, layout: tuple[str, ...] | None = None) -> DataFrame:
    """Adds ``turns``: array of (role, text), by the mapping the layout's fingerprint selects.

    ``layout``: the columns that hold the record (all but ``conv_id`` if not given). Null texts are
    empty, null roles an empty name, null arrays no turns. An unknown layout raises ValueError.
    """
    layout = layout or tuple(c for c in records.columns if c != "conv_id")
    paths = field_paths(records.select(*layout).schema)
    mapping = BY_FINGERPRINT.get(fingerprint(paths))
    if mapping is None:
        raise ValueError(f"no mapping for the layout {sorted(paths)}")

    def turn(role: Column, text: Column) -> Column:
        return F.struct(role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))

    if mapping.turns:
        turns = F.transform(F.coalesce(F.col(mapping.turns), F.array()), lambda m: turn(
            _role(m[mapping.role]), m[mapping.text]))
    else:
        made = [F.when(F.lit(path not in mapping.optional) | (F.length(path) > 0),
                       turn(F.lit(role), F.col(path))) for role, path in mapping.fixed]
        turns = F.filter(F.array(*made), lambda m: m.isNotNull())
    return records.withColumn("turns", turns)


def _key(name: str) -> str:
    """A field name as one step of a path: separators inside it are escaped."""
    return re.sub(r"[\\.\[]", r"\\\g<0>", name)


def value_paths(value, at: str = "") -> set[str]:
    """Leaf paths of a decoded JSON value; elements of an array share one path."""
    if isinstance(value, dict):
        return set().union(*(value_paths(v, f"{at}.{_key(k)}" if at else _key(k))
                             for k, v in value.items()))
    if isinstance(value, list):
        return set().union(*(value_paths(v, at + "[]") for v in value))
    return {at}


_DECLARED = frozenset(p for paths in MAPPINGS for p in paths)
_ARRAYS = {m.turns: frozenset(paths) for paths, m in MAPPINGS.items() if m.turns}


def mapping_of(record) -> Mapping | None:
    """The mapping of a decoded record, by the fingerprint of its declared field paths.

    Paths that no mapping declares are metadata. An array of messages without elements, or null, stands
    for all paths declared below it. None for what is no object, or an array of other things.
    """
    if not isinstance(record, dict):
        return None
    paths = value_paths(record) & _DECLARED
    for name, below in _ARRAYS.items():
        if name in record:
            if not record[name] and (record[name] is None or isinstance(record[name], list)):
                paths |= below
            elif not isinstance(record[name], list) or not all(
                    isinstance(m, dict) for m in record[name]):
                return None
    return BY_FINGERPRINT.get(fingerprint(tuple(paths)))


def turns_of(record: dict, mapping: Mapping) -> list[tuple[str, str]]:
    """Canonical turns of a decoded record of the mapping's layout."""

    def shown(value) -> str:
        text = "" if value is None else value if isinstance(value, str) else json.dumps(value)
        # half of a surrogate pair is no character: it becomes U+FFFD
        return text.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace")

    if mapping.turns:
        return [(ROLES.get(shown(m.get(mapping.role)).lower(), shown(m.get(mapping.role))),
                 shown(m.get(mapping.text))) for m in record[mapping.turns] or []]
    pairs = [(role, path, shown(record[path])) for role, path in mapping.fixed]
    return [(role, text) for role, path, text in pairs if text or path not in mapping.optional]


def from_json_records(records: DataFrame, column: str = "record") -> DataFrame:
    """conv_id, layout, turns, unmapped of JSON texts in mixed layouts, each read by its own mapping.

    A text that is no JSON object (or nested too deeply to be read), or of an unknown layout, has layout
    null, no turns, and comes back whole in ``unmapped``; else ``unmapped`` is null, as for a null text.
    Fields that no mapping declares are left out as metadata. Rows are independent.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            names, turns, left = [], [], []
            for body in pdf["body"]:
                try:
                    record = json.loads(body or "")
                    known = mapping_of(record)
                    read = turns_of(record, known) if known else []
                except (ValueError, RecursionError):
                    known, read = None, []
                names.append(known.name if known else None)
                left.append(None if known else body)
                turns.append([{"role": r, "text": t} for r, t in read])
            yield pd.DataFrame({"conv_id": pdf["conv_id"], "layout": names, "turns": turns,
                                "unmapped": left})

    return tables.through_python(
        records.select("conv_id", F.col(column).alias("body")), run,
        "conv_id string, layout string, turns array<struct<role string, text string>>, "
        "unmapped string", ("conv_id",))


def render_one(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """Formatted conversation, and code-point spans (end exclusive) of its assistant texts."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = OPEN + escape(role) + MID, escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        out += head, body, END
        at += len(head) + len(body) + len(END)
    return "".join(out), spans


def read_one(formatted: str) -> list[tuple[str, str]]:
    """Turns of a formatted conversation; the marks cannot occur inside names or texts."""
    turns = []
    for piece in formatted.split(END)[:-1]:
        role, text = piece.removeprefix(OPEN).split(MID, 1)
        turns.append((unescape(role), unescape(text)))
    return turns


def render(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss of ``turns(conv_id, turns)``.

    ``loss``: (start, end) code-point spans of assistant texts in ``formatted``, end exclusive.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = [render_one([(t["role"], t["text"]) for t in ts]) for ts in pdf["turns"]]
            yield pd.DataFrame({"conv_id": pdf["conv_id"], "formatted": [f for f, _ in made], "loss": [
                [{"start": a, "end": b} for a, b in spans] for _, spans in made]})

    return tables.through_python(
        turns.select("conv_id", "turns"), run,
        "conv_id string, formatted string, loss array<struct<start long, end long>>", ("conv_id",))


def conversations_as_records(rows: DataFrame) -> DataFrame:
    """One record per conv_id from rows (conv_id, turn, role, text), turns in order.

    Rows that repeat a turn follow in the order of role and text; null turns come first.
    """
    message = F.struct("turn", "role", "text")
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(message)).alias("turns"))


def as_mixed_records(rows: DataFrame) -> DataFrame:
    """conv_id and a JSON record of each conversation, in one of four layouts, with metadata.

    What collecting from several sources gives: a hash of conv_id picks messages, from/value pairs or the
    rows themselves; a user turn and its answer may also be prompt and response. No text is changed.
    """
    turns, extra = F.col("turns"), F.struct(F.lit("chat").alias("kind"), F.size("turns").alias("n"))

    def pairs(role: str, text: str) -> Column:
        return F.transform(turns, lambda t: F.struct(t["role"].alias(role), t["text"].alias(text)))

    def body(*fields: Column) -> Column:
        return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})

    layout = F.pmod(F.xxhash64("conv_id", F.lit("layout")), F.lit(4))
    single = (F.size(turns) == 2) & F.coalesce(
        (turns[0]["role"] == "user") & (turns[1]["role"] == "assistant"), F.lit(False))
    record = F.when((layout == 0) & single, body(
        F.get(turns, F.lit(0))["text"].alias("prompt"), F.get(turns, F.lit(1))["text"].alias("response"),
        extra.alias("meta")))
    record = record.when(layout <= 1, body(pairs("role", "content").alias("messages"), extra.alias("meta")))
    record = record.when(layout == 2, body(F.col("conv_id").alias("id"), pairs("from", "value").alias(
        "conversations")))
    return conversations_as_records(rows).select(
        "conv_id", record.otherwise(body(turns.alias("turns"), extra.alias("meta"))).alias("record"))


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, formatted, loss of turn rows, through the layout's mapping."""
    records = conversations_as_records(rows.select("conv_id", "turn", "role", "text"))
    return render(canonical_turns(records))


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted texts say when read back: turns, loss text and sizes per conversation."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for conv, text, spans in zip(pdf["conv_id"], pdf["formatted"], pdf["loss"]):
                turns = read_one(text)
                told = "".join(f"{role}\n{body}\n" for role, body in turns)
                loss = "".join(unescape(text[s["start"]:s["end"]]) for s in spans)
                rows.append((conv, len(turns), sha256(told.encode()).hexdigest(), len(loss),
                             sha256(loss.encode()).hexdigest(), len(text)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in DIGESTS.split(", ")])

    return tables.through_python(
        formatted.select("conv_id", "formatted", "loss"), run, DIGESTS, ("conv_id",))
