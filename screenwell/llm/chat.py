"""Conversations to training text with a loss mask, and back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenwell.llm.template import Template

CONTROLS = ["[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[/TURN]"]
CHAT = """
{%- for turn in turns -%}
  {%- if turn.role == 'user' -%} [INST]{{ ' ' ~ turn.text | escape }} [/INST]
  {%- elif turn.role == 'assistant' -%} <s>{% generation %}{{ turn.text | escape }}{% endgeneration %}</s>
  {%- elif turn.role == 'system' -%} <<SYS>>{{ turn.text | escape }}<</SYS>>
  {%- else -%} [ROLE]{{ turn.role | escape }}[/ROLE]{{ turn.text | escape }}[/TURN]
  {%- endif -%}
{%- endfor -%}
"""
TURN = re.compile(r"\[INST\] (?P<user>.*?) \[/INST\]|<s>(?P<assistant>.*?)</s>|<<SYS>>(?P<system>.*?)<</SYS>>"
                  r"|\[ROLE\](?P<role>.*?)\[/ROLE\](?P<text>.*?)\[/TURN\]", re.S)
PIECE, BATCH = 1 << 20, 1 << 22


def escaper(controls: list[str]) -> Callable[[str], str]:
    """Puts a backslash after every backslash and after the first letter of each control string, so
    that none is left; ``unescaped`` takes them away. Control strings have no backslash and at
    least two letters."""
    if any(len(c) < 2 or "\\" in c for c in controls):
        raise ValueError("control strings need two letters and no backslash")
    pattern = re.compile("|".join([r"\\", *(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in controls)]))
    return lambda value: pattern.sub(r"\g<0>\\", value or "")


def unescaped(value: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", value)


def chat_template(source: str = CHAT, controls: list[str] = CONTROLS, constants: dict | None = None) -> Template:
    return Template(source, constants, {"escape": escaper(controls)})


def parsed(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn in a text of the ``CHAT`` template."""
    at = 0
    while at < len(text):
        found = TURN.match(text, at)
        if not found:
            raise ValueError(f"no turn at {text[at:at + 40]!r}")
        kind = found.lastgroup
        yield (unescaped(found["role"]), unescaped(found["text"])) if kind == "text" else (kind, unescaped(found[kind]))
        at = found.end()


def rows_of(batches: Iterable) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def format_conversations(conversations: DataFrame, source: str = CHAT, controls: list[str] = CONTROLS,
                         constants: dict | None = None, limit: int = PIECE) -> DataFrame:
    """(conv_id, piece, text, generated) for ``conversations`` (conv_id, turn, role, text).

    ``generated`` lists the (start, end) code points of the piece that the template marks as
    generated. A conversation is one piece, or several that follow each other and end after the
    turn that reaches ``limit`` code points, so that a very long one is streamed through its task
    and never held. Its turns have to pass one task in their order; the sort before spills.

    Rows of a conversation are ordered by turn, role and text, nulls first; repeated rows are turns
    like others. Null texts and roles are empty, a null conv_id is a conversation of its own. Other
    columns are not read. An empty table gives an empty one. The template is compiled here, so that
    a faulty one fails at once, and again in each task.
    """
    chat_template(source, controls, constants)
    kind = conversations.schema["conv_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        template = chat_template(source, controls, constants)
        held, size = [], 0

        def emit():
            return pa.RecordBatch.from_arrays([
                pa.array([h[0] for h in held], conv_type), pa.array([h[1] for h in held], pa.int64()), pa.array([h[2] for h in held], pa.string()),
                pa.array([[{"start": a, "end": b} for a, b in h[3]] for h in held],
                         pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], ["conv_id", "piece", "text", "generated"])

        conv_type, batches = None, iter(batches)
        first = next(batches, None)
        if first is None:
            return
        conv_type = first.column(0).type
        chained = (b for part in ([first], batches) for b in part)
        for conv, rows in groupby(rows_of(chained), key=lambda r: r[0]):
            turns = ({"turn": r[1], "role": r[2] or "", "text": r[3] or ""} for r in rows)
            for i, (text, spans) in enumerate(template.pieces(turns, limit)):
                held.append((conv, i, text, spans))
                size += len(text)
                if size > BATCH:
                    yield emit()
                    held, size = [], 0
        if held:
            yield emit()

    ordered = conversations.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "role", "text")
    return ordered.mapInArrow(run, f"conv_id {kind}, piece long, text string, generated array<struct<start:long,end:long>>")


def read_back(formatted: DataFrame, ordered: bool = False) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from the output of
    ``format_conversations`` with its own template: turns are parsed from the text, the loss is what
    the generated spans hold, unescaped.

    ``ordered`` says that the pieces come straight from ``format_conversations``; a stored table is
    grouped and sorted again. Digests take the pieces in order and hold nothing but their state.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    if not ordered:
        formatted = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "piece")

    def run(batches):
        import pyarrow as pa

        conv_type, out = None, []

        def emit():
            columns = list(zip(*out, strict=True))
            kinds = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                              ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        conv_type = first.column(0).type
        for conv, rows in groupby(rows_of(b for part in ([first], batches) for b in part), key=lambda r: r[0]):
            turns, loss, n, lost, size = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for _, _, text, spans in rows:
                size += len(text)
                for role, value in parsed(text):
                    turns.update(f"{role}\n{value}\n".encode("utf-8", "replace"))
                    n += 1
                for span in spans:
                    value = unescaped(text[span["start"]:span["end"]])
                    loss.update(value.encode("utf-8", "replace"))
                    lost += len(value)
            out.append((conv, n, turns.hexdigest(), lost, loss.hexdigest(), size))
            if len(out) >= 10_000:
                yield emit()
                out = []
        if out:
            yield emit()

    return formatted.select("conv_id", "piece", "text", "generated").mapInArrow(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def with_control_case(conversations: DataFrame) -> DataFrame:
    """``conversations`` and number -7, whose two turns consist of control strings."""
    text = "</s>[INST] ok [/INST]"
    extra = conversations.sparkSession.createDataFrame(
        [(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").union(extra)
